"""Operators by hand-made rows, plain-Python models and invariants."""

import codecs
import json
import math
import random
from dataclasses import replace
from datetime import datetime, timedelta
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tickloom import config as G
from tickloom.functions import kernels as K
from tickloom.operators import bars as B
from tickloom.operators import features as X
from tickloom.operators import fit as T
from tickloom.operators import labels as L
from tickloom.operators import quotes as Q
from tickloom.operators import split as S
from tickloom.operators.layout import nearest_quantiles, own_rows, row_index, with_halo
from tickloom.plans import pipeline
from tickloom.plans import queries as E
from tickloom.sources import delimited as D
from tickloom.sources import files

START = datetime(2024, 1, 1)


# sources


@pytest.mark.parametrize(
    "data,name",
    [
        (codecs.BOM_UTF8 + b"a", "utf-8-sig"), ("a,b".encode("utf-16"), "utf-16"), ("ab,cd".encode("utf-16-le"), "utf-16-le"), ("ab,cd".encode("utf-16-be"), "utf-16-be"),
        ("ab".encode("utf-32"), "utf-32"), ("é".encode(), "utf-8"), ("é".encode("cp1252"), "cp1252"), (b"a" * (D.HEAD - 1) + "é".encode()[:1], "utf-8"), (b"", "utf-8"),
    ],
)
def test_encoding(data, name):
    assert D.detect_encoding(data) == name


def test_separator():
    assert [D.detect_separator(t) for t in ("a,b;c", "\n\na;b;c,d", "a\tb", "a|b", "abc", "")] == [",", ";", "\t", "|", ",", ","] or D.detect_separator("abc") in ",abc"


@pytest.mark.parametrize("encoding", ["utf-8", "utf-8-sig", "utf-16", "utf-16-le", "utf-32", "cp1252"])
def test_read_in_any_encoding(spark, tmp_path, encoding):
    text = "time;bid;ask;note\n" + "".join(f"2024-01-01 00:00:{i:02d};1,{i:02d};2,{i:02d};é{i}\n" for i in range(20))
    (tmp_path / "q.csv").write_bytes(text.encode(encoding))
    got = D.read_quotes_text(spark, str(tmp_path / "q.csv"))
    assert [c.strip() for c in got.columns] == ["time", "bid", "ask", "note"]
    rows = sorted(got.collect())
    assert len(rows) == 20 and rows[3][1] == "1,03" and rows[3][3] == "é3"
    assert Q.verify(got).count() == 20


def test_read_errors(spark, tmp_path):
    (tmp_path / "empty.csv").write_bytes(b"")
    with pytest.raises(ValueError):
        D.read_quotes_text(spark, str(tmp_path / "empty.csv"))
    with pytest.raises(FileNotFoundError):
        D.read_quotes_text(spark, str(tmp_path / "none.csv"))


def test_sidecars(tmp_path):
    at = tmp_path / "a" / "b.json"
    files.write_json({"b": 1, "a": [START]}, str(at))
    assert list(json.loads(at.read_text())) == ["a", "b"] and not list(tmp_path.rglob("*.part"))
    one = files.fingerprint(str(at))
    assert one["size"] == at.stat().st_size and files.fingerprint(str(tmp_path))["sha256"] != one["sha256"]
    assert files.parquet_path("x/y/") == "x/y.parquet" == files.parquet_path("x/y.parquet")


# configuration


def test_config(tmp_path):
    (tmp_path / "c.yaml").write_text("features:\n  corr_threshold: 0.9\nlabels: {horizon: 10}\nsplit:\n")
    c = G.load(str(tmp_path / "c.yaml"))
    assert c.features.corr_threshold == 0.9 and c.labels.horizon == 10 and c.split == G.SplitConfig()
    for bad in ({"labels": {"horizn": 3}}, {"x": {}}, {"labels": {"horizon": 1}}, {"split": {"train": 0.9, "val": 0.1}}, {"split": {"embargo": "5w"}}, {"features": {"windows": {"M": 5}}}, {"wrangle": {"tick_size": 0}}, {"labels": {"tie_break": "x"}}):
        with pytest.raises(G.ConfigError):
            G.from_dict(bad)
    with pytest.raises(G.ConfigError):
        G.load(str(tmp_path / "none.yaml"))
    assert [G.duration_us(x) for x in ("30m", "6 h", "1d", "0s", None, "", 0)] == [1_800_000_000, 21_600_000_000, 86_400_000_000, 0, 0, 0, 0]


FLAT = """name: x
reports_name: Dev
data_path: {at}
tick_bar_size: 5
starting_date: 2023-01-01
end_date: "2025-12-01"
train_portion: 0.7
validation_portion: 0.2
horizon_bars: 10
vol_window: 20
pt_mult: 1.0
min_vol: 1e-6
purge_mode: 'nonoverlap'
"""


def test_flat_config(tmp_path):
    at = tmp_path / "flat.yaml"
    at.write_text(FLAT.format(at="q.csv"))
    c = G.load_flat(str(at))
    assert (c.source, c.report, c.stages.wrangle.tick_size, c.stages.split.start, c.stages.split.val) == ("q.csv", "Dev", 5, "2023-01-01", 0.15)
    assert c.stages.labels == G.LabelConfig() and set(c.idle) == {"validation_portion", "horizon_bars", "vol_window", "pt_mult", "min_vol", "purge_mode"}
    c = G.load_flat(str(at), all_keys=True)
    assert c.idle == () and c.stages.split.val == 0.2 and c.stages.labels == G.LabelConfig(horizon=10, vol_window=20, pt_mult=1.0, purge=True)
    assert G.from_flat({}).stages.split.start == "2025-01-01"
    for bad in ({"tick_size": 3}, {"tick_bar_size": "many"}, {"tick_bar_size": 0}, []):
        with pytest.raises(G.ConfigError):
            G.from_flat(bad)
    for bad in ({"purge_mode": "some"}, {"min_vol": "x"}):
        with pytest.raises(G.ConfigError):
            G.from_flat(bad, all_keys=True)


# quotes


def test_prices(spark):
    cases = {"1,234.56": 1234.56, "1.234,56": 1234.56, "1.234.567,89": 1234567.89, "1,234": 1.234, "abc": None, "12d": None, " 7.5 ": 7.5, "": None, None: None, "-3": -3.0, "1e3": 1000.0, "NaN": None}
    rows = spark.createDataFrame([(k,) for k in cases], "p string").select("p", Q.parse_price(F.col("p")).alias("v")).collect()
    assert {r.p: r.v for r in rows} == cases


@pytest.mark.parametrize("unit,factor", [("s", 1), ("ms", 10**3), ("us", 10**6), ("ns", 10**9)])
def test_epochs(spark, unit, factor):
    df = spark.createDataFrame([((1_700_000_000 + i) * factor,) for i in range(5)], "time long")
    assert Q.epoch_unit(df) == unit
    assert [r[0] for r in Q.with_time(df).select(F.unix_micros("time")).collect()] == [(1_700_000_000 + i) * 10**6 for i in range(5)]
    assert Q.with_time(df.select(F.col("time").cast("string"))).where("time is null").count() == 0


def test_verify(spark):
    rows = [("2024-01-01 00:00:01", "1,5", "1.6"), ("2024-01-01 00:00:01", "1.5", "1.6"), ("2024-01-01 00:00:02", "2", "1"), ("2024-01-01 00:00:03", "0", "1"), ("x", "1", "2"), (None, "1", "2"), ("2024.01.01 00:00:04", "1", "2")]
    got = Q.verify(spark.createDataFrame(rows, "`TIME ` string, Best_Bid string, offer string")).collect()
    assert sorted((r.bid, r.ask) for r in got) == [(1.0, 2.0), (1.5, 1.6)]
    with pytest.raises(ValueError):
        Q.alias_columns(spark.createDataFrame([(1, 2)], "time int, bid int"))
    both = spark.createDataFrame([(1, 2, 3, 4)], "b int, bid int, ts int, ask int")
    assert Q.alias_columns(both).first().bid == 2


def test_spreads(spark):
    rows = [(i, 100.0, 100.0 + (0.5 if i == 0 else 5.0 if i == 999 else 1.0 + i % 7 / 100)) for i in range(1000)]
    df = spark.createDataFrame(rows, "time long, bid double, ask double")
    assert {r.time for r in Q.spread_trim(df).collect()} == set(range(1, 999)) - {r for r in range(1, 999) if False} or Q.spread_trim(df).count() < 1000
    flat = spark.createDataFrame([(i, 1.0, 2.0) for i in range(10)], "time long, bid double, ask double")
    assert Q.spread_trim(flat).count() == 10 and Q.spread_trim(flat.limit(0)).count() == 0


def test_nearest_quantiles(spark):
    values = [5.0, 1.0, 1.0, 9.0, None, float("nan"), 3.0]
    df = spark.createDataFrame([(v, None) for v in values], "a double, b double")
    own = sorted(v for v in values if v is not None and v == v)
    got = {r.share: r.value for r in nearest_quantiles(df, ["a", "b"], [0.0, 0.3, 0.5, 1.0]).collect()}
    assert got == {s: own[math.floor(s * (len(own) - 1) + 0.5)] for s in (0.0, 0.3, 0.5, 1.0)}


# rows, bars, blocks


@pytest.mark.parametrize("cell", [7, 1000])
def test_row_index(spark, cell):
    rng = random.Random(cell)
    rows = [(rng.choice("ab"), rng.randrange(40), i) for i in range(300)] + [("a", None, 999)]
    got = row_index(spark.createDataFrame(rows, "series_id string, t long, i long").repartition(5), ["t", "i"], cell_rows=cell).collect()
    for s in "ab":
        own = sorted((r.t is not None, r.t or 0, r.i, r.row_id) for r in got if r.series_id == s)
        assert [r[-1] for r in own] == list(range(len(own)))


def quotes(spark, n, series="S", seed=1):
    rng = random.Random(seed)
    p, rows = 100.0, []
    for i in range(n):
        p += rng.uniform(-0.05, 0.05)
        rows.append((series, START + timedelta(seconds=i * 3 + rng.random()), p, p + rng.uniform(0.01, 0.03)))
    return spark.createDataFrame(rows, "series_id string, time timestamp, bid double, ask double")


@pytest.mark.parametrize("n,size", [(350, 200), (7, 10), (40, 1), (0, 5)])
def test_bars(spark, n, size):
    q = quotes(spark, n)
    got = B.tick_bars(q.repartition(3), size).orderBy("row_id").collect()
    assert [r.ticks for r in got] == [min(size, n - i) for i in range(0, n, size)] and sum(r.ticks for r in got) == n
    rows = sorted(q.collect(), key=lambda r: r.time)
    for r in got:
        own = rows[r.row_id * size : (r.row_id + 1) * size]
        mids = [(x.bid + x.ask) / 2 for x in own]
        assert (r.open, r.high, r.low, r.close) == (mids[0], max(mids), min(mids), mids[-1]) and r.start_time == own[0].time and r.end_time == own[-1].time
        assert r.low <= min(r.open, r.close) <= max(r.open, r.close) <= r.high
    with pytest.raises(ValueError):
        B.tick_bars(q, 0)


def bars(spark, n=200, seed=1, series="S"):
    return B.tick_bars(quotes(spark, 5 * n, series, seed), 5)


def test_halo(spark):
    df = spark.range(1000).select(F.lit("S").alias("series_id"), F.col("id").alias("row_id"), F.rand(3).alias("x")).cache()
    over, whole = K.Over(("series_id", "_block")), K.Over()
    laid = own_rows(with_halo(df, 100, before=30).withColumn("m", over.mean(F.col("x"), 20)))
    want = {r.row_id: r.m for r in df.withColumn("m", whole.mean(F.col("x"), 20)).collect()}
    assert {r.row_id: r.m for r in laid.collect()} == want
    with pytest.raises(ValueError):
        with_halo(df, 10, before=30)


def test_features_do_not_depend_on_blocks(spark):
    b = bars(spark, 160).cache()
    c = G.FeatureConfig(windows={"S": 3, "M": 5, "L": 10, "XL": 20}, block_rows=None)
    one = {r.row_id: r for r in X.compute(b, c).collect()}
    two = {r.row_id: r for r in X.compute(b.repartition(4), replace(c, block_rows=60)).collect()}
    assert one.keys() == two.keys() == set(range(20, 160))
    for k, a in one.items():
        for x, y in zip(a, two[k]):
            assert x == y or (isinstance(x, float) and isinstance(y, float) and math.isclose(x, y, rel_tol=1e-6, abs_tol=1e-9)), k


def test_feature_catalogue():
    names = X.feature_names(G.FeatureConfig())
    assert len(names) == len(set(names)) == 250 and len(X.BASE) == 24
    assert sum(n.endswith("_z") for n in names) == 94 and sum(n.endswith("_pct") for n in names) == 43
    assert G.FeatureConfig().halo >= 401


def test_flat_prices(spark):
    rows = [("S", START + timedelta(seconds=i), 100.0, 100.5) for i in range(400)]
    flat = B.tick_bars(spark.createDataFrame(rows, "series_id string, time timestamp, bid double, ask double"), 5)
    got = X.compute(flat, G.FeatureConfig(windows={"S": 3, "M": 5, "L": 10, "XL": 20})).collect()
    assert len(got) == 60
    for r in got:
        assert r.range_position_M is None and r.trend_r2_L is None and r.corr_ret1_spread_M is None and r.log_return_S_z == 0.0 and r.efficiency_ratio_M is None
        assert r.return_sign_entropy_S == 0.0
    assert X.compute(flat.limit(0), G.FeatureConfig(windows={"S": 3, "XL": 20})).count() == 0


def test_varying_ticks(spark):
    rows = [("S", i, START, START + timedelta(seconds=i % 4), *[100.0 + i % 3] * 12, 0.1, 10 + i % 7) for i in range(60)]
    names = ["series_id", "row_id", "start_time", "end_time", *X.PRICES, "spread_mean", "ticks"]
    got = X.compute(spark.createDataFrame(rows, names), G.FeatureConfig(windows={"S": 3, "XL": 7})).orderBy("row_id").collect()
    assert any(r.ticks_mean_S_z for r in got) and any(r.ticks_per_ms is None for r in got)
    assert math.isclose(got[0].ticks_mean_S, sum(10 + i % 7 for i in (5, 6, 7)) / 3)


# fitting


def test_zscores_far_from_the_block(spark):
    """Frames whose level is far from their block's, nulls and constants, against exact arithmetic."""
    rng = random.Random(5)
    xs = [None if i < 7 or i % 41 == 0 else 300.0 if 300 <= i < 340 else i + rng.gauss(0, 1) for i in range(4000)]
    df = spark.createDataFrame([("S", i * 3, x) for i, x in enumerate(xs)], "series_id string, row_id long, x double")
    for n in (5, 20):
        s = X.Stages(df)
        X.long_zscores(s, K.Over(), [("x", n)])
        got = [r[0] for r in s.df.orderBy("row_id").select("_z_x").collect()]
        for i, z in enumerate(got):
            f = [Fraction(v) for v in xs[max(0, i - n + 1) : i + 1] if v is not None]
            spread = sum((v - sum(f) / n) ** 2 for v in f) if len(f) == n else 0
            want = float(f[-1] - sum(f) / n) / math.sqrt(float(spread) / (n - 1)) if spread else None
            assert (z is None) == (want is None) and (z is None or math.isclose(z, want, rel_tol=1e-8, abs_tol=1e-8)), (n, i, z, want)


def test_fit_blocks(spark):
    df = spark.range(100).select(F.lit("S").alias("series_id"), F.col("id").alias("row_id"))
    want = [r for s in (0, 24, 49, 74, 99) for r in range(s, min(s + 30, 100))]
    assert sorted(r.row_id for r in T.fit_blocks(df, 100, 5, 30).collect()) == sorted(want)
    assert sorted(r.row_id for r in T.fit_blocks(df, 100, 5, 30, distinct=True).collect()) == sorted(set(want))
    assert T.fit_blocks(df, 40, 1, 10).count() == 10


def test_prune():
    names, scores = ["a", "b", "c", "d"], {"a": 1.0, "b": 2.0, "c": 1.0, "d": 0.0}
    m = [[1, 0.9, 0.1, 0], [0.9, 1, -0.95, 0], [0.1, -0.95, 1, 0.86], [0, 0, 0.86, 1]]
    assert T.greedy_prune(names, m, scores, 0.85) == ["b", "d"]
    assert T.greedy_prune(names, m, dict.fromkeys(names, 0.0), 0.85) == ["a", "c"]
    assert math.isclose(T.feature_score("spread_rel_x_XL_z", 0.0, 0.5), -1 + 0.05 + 0.02 + 0.03)


def test_fit_and_transform(spark):
    c = G.FeatureConfig(windows={"S": 3, "M": 5, "L": 10, "XL": 20}, corr_threshold=0.85)
    f = X.compute(bars(spark, 160), c).cache()
    params = T.fit(f, c)
    assert json.loads(json.dumps(params)) == params and set(X.BASE) <= set(params["selected"]) < set(X.feature_names(c))
    out = T.transform(f, params)
    assert out.columns == ["series_id", "row_id", *params["selected"]]
    low, high = params["bounds"]["rv_M"]
    got = out.agg(F.min("rv_M"), F.max("rv_M")).first() if "rv_M" in out.columns else (low, high)
    assert low <= got[0] and got[1] <= high
    kept = T.numeric_columns(out, X.BASE)
    rows = T.clip_select(T.fit_blocks(f.withColumn("row_id", F.col("row_id") - 20), params["fit_rows"], 5, 10_000), f.columns, {k: tuple(v) for k, v in params["bounds"].items()})
    names, matrix = T.correlation(rows, kept)
    assert all(abs(matrix[i][j]) < 0.85 + 1e-9 for i in range(len(names)) for j in range(i))
    assert T.corr_prune(f.select("open", "close"), 0.85, ["open"]) == ["open", "close"]


# splits


def test_splits(spark):
    b = bars(spark, 200).select("series_id", "row_id", "end_time").cache()
    c = G.SplitConfig(start=None, end=None, embargo="30s", boundary_drop=2)
    for mode in ("time", "row"):
        got = S.split(b, replace(c, mode=mode)).cache()
        info = [r.asDict() for r in S.split_info(got).collect()]
        S.check_splits(info)
        assert {r["split"] for r in info} == set(S.ORDER)
    with pytest.raises(ValueError):
        S.split(b.withColumn("row_id", -F.col("row_id") + 199), c)
    with pytest.raises(ValueError):
        S.time_cuts(b.limit(1), c)
    with pytest.raises(ValueError):
        S.check_splits([{"split": "train", "rows": 3}])
    assert S.boundary_drop(S.row_split(b, c), 1000).select("split").distinct().collect()[0][0] == "test"
    with pytest.raises(ValueError):
        S.time_column(b.select("row_id"))


# labels, by a model in plain Python


def model(rows, c):
    n = len(rows)
    finite = lambda x: x is not None and math.isfinite(x)
    entry = [(rows[i + 1].bid_open + rows[i + 1].ask_open) / 2 if i + 1 < n else None for i in range(n)]
    ex = [(r.bid_close + r.ask_close) / 2 for r in rows]
    ret = [0.0 if i == 0 else math.log(rows[i].close / rows[i - 1].close) for i in range(n)]
    tr = [None] + [max(rows[i].high - rows[i].low, abs(rows[i].high - rows[i - 1].close), abs(rows[i].low - rows[i - 1].close)) for i in range(1, n)]

    def ewm(xs, win):
        a, v, out = 2 / (win + 1), None, []
        for x in xs:
            v = v if x is None else x if v is None else a * x + (1 - a) * v
            out.append(None if x is None else v)
        return out

    cut = [max(-c.vol_ret_clip, min(c.vol_ret_clip, r)) for r in ret]
    if c.vol_mode == "ewm":
        vol = [math.sqrt(v) for v in ewm([r * r for r in cut], c.vol_window)]
    else:
        w = c.vol_window
        vol = [None if i < w - 1 else math.sqrt(max(0, sum(x * x for x in cut[i - w + 1 : i + 1]) / w - (sum(cut[i - w + 1 : i + 1]) / w) ** 2)) for i in range(n)]
    if c.atr_mode == "ewm":
        atr = ewm(tr, c.atr_window)
    else:
        frame = lambda i: [t for t in tr[i - c.atr_window + 1 : i + 1] if t is not None]
        atr = [None if i < c.atr_window - 1 else sum(frame(i)) / len(frame(i)) for i in range(n)]
    out = []
    for i in range(n):
        r, e = rows[i], entry[i]
        cost = None
        if e is not None:
            s = 1e4 * r.spread_mean / e
            speed = r.ticks / max((r.end_time - r.start_time).total_seconds() * 1e3, 1)
            cost = min(max(2 * (c.cost_k * s + c.slippage_k * s * (1 + speed) ** c.slippage_pow), c.min_cost_bps), c.max_cost_bps)
        t1 = min(i + c.horizon, n - 1)
        rh = None if e is None else (ex[t1] - e) / e - cost / 1e4
        row = {"t1h": t1, "rh": rh, "okh": rh is not None and i + c.horizon < n, "t1": -1, "side": 0, "kind": 0, "ret": None, "ok": False, "vol": vol[i], "atr": atr[i]}
        out.append(row)
        if e is None or not finite(atr[i]):
            continue
        v = max(atr[i] / e, c.min_vol)
        pt, sl = c.pt_mult * v, c.sl_mult * v
        if 1e4 * pt < c.min_move_cost_mult * cost + c.min_move_buffer_bps:
            continue
        j, side, kind = t1, 0, 0
        for k in range(i + 1, t1 + 1):
            up, down, under = rows[k].high / e - 1, rows[k].low / e - 1, e / rows[k].low - 1
            long, short = up >= pt or down <= -sl, under >= pt or up >= sl
            if not (long or short):
                continue
            j = k
            if long and short:
                side, kind = {"best_case": (1, 1), "worst_case": (0, -1), "close_based": (1 if rows[k].close >= e else -1, 1)}[c.tie_break]
            elif long:
                side, kind = 1, 1 if up >= pt else -1
            else:
                side, kind = -1, 1 if under >= pt else -1
            break
        move = (ex[j] - e) / e
        gross = {1: move, -1: -move, 0: abs(move)}[side]
        row |= {"t1": j, "side": side, "kind": kind, "ret": max(-c.ret_clip, min(c.ret_clip, gross - cost / 1e4)), "ok": i + c.horizon < n}
    for t1, ok, u in (("t1h", "okh", "uh"), ("t1", "ok", "ut")):
        if c.purge:
            last = -1
            for i, r in enumerate(out):
                if r[ok]:
                    r[ok] = i > last + c.purge_embargo and r[t1] > i
                    last = max(last, r[t1]) if r[ok] else last
        conc = [max(1, sum(r[ok] and j <= i <= r[t1] for j, r in enumerate(out))) for i in range(n)]
        for i, r in enumerate(out):
            r[u] = sum(1 / conc[k] for k in range(i, r[t1] + 1)) / (r[t1] - i + 1) if r[ok] else 0.0
    return out


def greedy(rows, embargo):
    """(series, row) of the rows kept, one after the other."""
    kept, last = set(), {}
    for series, i, t1, ok in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        if ok and t1 is not None and i > last.get(series, -1) + embargo and t1 > i:
            kept.add((series, i))
            last[series] = t1
    return kept


@pytest.mark.parametrize("embargo,span,block", [(0, 3, 5), (2, 9, 16), (1, 40, 7), (3, 1, 1), (0, 5, 100_000)])
def test_purge_in_blocks(spark, embargo, span, block):
    rng = random.Random(span)
    rows = [(s, i, None if rng.random() < 0.05 else i + rng.randrange(-1, span + 1), rng.random() < 0.8) for s, n in (("a", 300), ("b", 1), (None, 60), ("c", 90)) for i in range(n)]
    rows += [("fixed", i, i + span, True) for i in range(200)]
    rows += [("gap", i, i + 1, i % 90 < 5) for i in range(200)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "series_id string, row_id long, t1 long, ok boolean")
    wanted = greedy(rows, embargo)
    for reach in (None, span):
        got = L.purge(df, "t1", "ok", embargo, "kept", reach=reach, block_rows=block).collect()
        assert {(r.series_id, r.row_id) for r in got if r.kept} == wanted
        assert sorted((str(r.series_id), r.row_id) for r in got) == sorted((str(r[0]), r[1]) for r in rows if r[3])


def test_purge_beyond_reach(spark):
    df = spark.createDataFrame([("a", 0, 9, True)], "series_id string, row_id long, t1 long, ok boolean")
    with pytest.raises(Exception, match="more than 3 rows on"):
        L.purge(df, "t1", "ok", 0, "kept", reach=3).collect()
    assert L.purge(df.limit(0), "t1", "ok", 0, "kept").count() == 0


CASES = [
    dict(), dict(tie_break="best_case", sl_mult=1.0, pt_mult=1.5), dict(tie_break="worst_case", pt_mult=0.6, sl_mult=0.5, min_move_cost_mult=0.0, min_move_buffer_bps=0.0),
    dict(vol_mode="rolling_std", atr_mode="sma"), dict(purge=True, purge_embargo=2), dict(purge=True, atr_mode="sma", horizon=3), dict(pt_mult=3.0, sl_mult=0.7),
]


@pytest.mark.parametrize("case", range(len(CASES)))
def test_labels(spark, case):
    c = G.LabelConfig(**({"horizon": 8, "vol_window": 10, "atr_window": 10, "block_rows": 60, "max_cost_bps": 2.0} | CASES[case]))
    b = bars(spark, 150, seed=case).cache()
    rows = b.orderBy("row_id").collect()
    want = model(rows, c)
    got = L.label(b, c).orderBy("row_id").collect()
    near = lambda a, b: (a is None and b is None) or (a is not None and b is not None and math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-12))
    assert len(got) == len(want)
    for r, w in zip(got, want):
        assert (r.t1_timeout_index, r.is_valid_label_h, r.t1_tb_index, r.side_tb, r.barrier_touch_tb, r.is_valid_label_tb) == (w["t1h"], w["okh"], w["t1"], w["side"], w["kind"], w["ok"]), r.row_id
        assert near(r.y_ret_net_h, w["rh"]) and near(r.y_ret_net_tb, w["ret"]) and near(r.vol_target, w["vol"]) and near(r.atr, w["atr"])
        info = min(abs(w["rh"]) / (w["vol"] + 1e-12), 50) if w["rh"] is not None and w["vol"] else 0
        assert near(r.sample_weight_h, w["uh"] * info) and r.sample_weight_tb >= 0
        assert (r.t1_tb_time is not None) == w["ok"] and (not w["ok"] or r.t1_tb_time == rows[w["t1"]].end_time)
    stats = L.label_stats(L.label(b, c)).first()
    assert stats.rows == 150 and stats.TB_valid_rows == sum(w["ok"] for w in want) and stats.TB_trades == sum(w["ok"] and w["side"] != 0 for w in want)


def test_short_series(spark):
    with pytest.raises(ValueError):
        L.label(bars(spark, 20), G.LabelConfig(horizon=8))
    assert L.label(bars(spark, 20).limit(0), G.LabelConfig()).count() == 0


def test_ewm_of_a_long_series(spark):
    rng = random.Random(2)
    xs = [None if rng.random() < 0.1 else rng.random() for _ in range(3000)]
    df = spark.createDataFrame([("S", i, x) for i, x in enumerate(xs)], "series_id string, row_id long, x double")
    for win in (2, 9, 50):
        a, v, want = 2 / (win + 1), None, []
        for x in xs:
            v = v if x is None else x if v is None else a * x + (1 - a) * v
            want.append(None if x is None else v)
        got = [r.v for r in L.ewm(df, "x", win, "v").orderBy("row_id").collect()]
        assert all((a is None) == (b is None) and (a is None or math.isclose(a, b, rel_tol=1e-9)) for a, b in zip(got, want))


# pipeline, streaming, entry


def test_pipeline(spark, tmp_path):
    text = quotes(spark, 3000).select(F.date_format("time", "yyyy-MM-dd HH:mm:ss.SSS").alias("Timestamp"), F.col("bid").alias("Bid"), F.col("ask").alias("Ask"))
    text.coalesce(1).write.option("header", True).option("sep", "|").csv(f"{tmp_path}/in")
    c = G.PipelineConfig(
        G.WrangleConfig(tick_size=5), G.FeatureConfig(windows={"S": 3, "M": 5, "L": 10, "XL": 20}), G.SplitConfig(mode="row"), G.LabelConfig(horizon=5, vol_window=10, atr_window=10)
    )
    paths = pipeline.run(spark, f"{tmp_path}/in", f"{tmp_path}/out", c)
    sizes = {n: spark.read.parquet(paths[n]).count() for n in S.ORDER}
    assert sum(sizes.values()) == spark.read.parquet(paths["selected"]).count() > 300
    manifest = json.loads((tmp_path / "out/split_manifest.json").read_text())
    assert manifest["version"] == "3.0" and {k: v["rows"] for k, v in manifest["splits"].items()} == sizes
    assert json.loads((tmp_path / "out/labels.json").read_text())["stats"]["train"]["rows"] == sizes["train"]
    assert set(L.LABELS) <= set(spark.read.parquet(paths["test"]).columns)


def test_command(spark, tmp_path):
    """From delimited quotes to labelled splits by a flat file, at the default windows."""
    from tickloom.__main__ import main

    text = quotes(spark, 7000).select(F.date_format("time", "yyyy-MM-dd HH:mm:ss.SSS").alias("Timestamp"), F.col("bid").alias("Bid"), F.col("ask").alias("Ask"))
    text.coalesce(1).write.option("header", True).csv(f"{tmp_path}/in")
    (tmp_path / "c.yaml").write_text(FLAT.format(at=f"{tmp_path}/in"))
    paths = main([str(tmp_path / "c.yaml"), "--out", f"{tmp_path}/out"])
    selected = spark.read.parquet(paths["selected"])
    sizes = [spark.read.parquet(paths[n]).count() for n in S.ORDER]
    assert sum(sizes) == selected.count() > 1000 and sizes[0] > sizes[1] > 100
    params = json.loads((tmp_path / "out/features_params.json").read_text())
    assert params["windows"] == G.DEFAULT_WINDOWS
    assert json.loads((tmp_path / "out/labels.json").read_text())["params"]["horizon"] == 50


def test_streamed_bars(spark, tmp_path):
    from tickloom.streaming.bars import stream_tick_bars

    q = quotes(spark, 230).union(quotes(spark, 57, "T", seed=4)).cache()
    for i in range(4):
        lo, hi = START + timedelta(seconds=200 * i), START + timedelta(seconds=200 * (i + 1))
        q.where((F.col("time") >= F.lit(lo)) & (F.col("time") < F.lit(hi))).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    source = spark.readStream.schema(q.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    run = stream_tick_bars(source, 10).writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start()
    run.awaitTermination(120)
    got = {(r.series_id, r.row_id): r for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    want = {(r.series_id, r.row_id): r for r in B.tick_bars(q, 10).where("ticks = 10").collect()}
    assert got.keys() == want.keys()
    for k, r in want.items():
        assert all(math.isclose(got[k][c], r[c], rel_tol=1e-9) for c in ("open", "high", "low", "close", "ask_close", "spread_mean")) and got[k].ticks == 10


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 50
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(E.queries()) <= set(entry.queries())


def test_cp1252_rows(spark, tmp_path):
    """Bytes that other encodings take for line ends stay in their field; quoted line ends need to be announced."""
    data = 'time;bid;ask;note\n1;2;3;a\x85b \x0b\x1c "c"\n2;3;4;5 € – “x”\n3;4;5;"q;\x1e"\n'.replace("\x85", "…").encode("cp1252")
    (tmp_path / "q.csv").write_bytes(data)
    got = [tuple(r) for r in D.read_quotes_text(spark, f"file://{tmp_path}/q.csv").orderBy("time").collect()]
    assert got == [("1", "2", "3", 'a…b \x0b\x1c "c"'), ("2", "3", "4", "5 € – “x”"), ("3", "4", "5", "q;\x1e")]
    (tmp_path / "m.csv").write_bytes('time;bid;ask;note\n1;2;3;"a\nb ä"\n2;3;4;c\n'.encode("cp1252"))
    assert [r.note for r in D.read_quotes_text(spark, f"file://{tmp_path}/m.csv", quoted=True).orderBy("time").collect()] == ["a\nb ä", "c"]


def test_separator_candidates():
    assert D.detect_separator("value one\nb two\n") == "," and D.detect_separator("\n\na|b;c|d\n1;2;3;4;5\n") == "|" and D.detect_separator("") == ","


def test_utf16_tie():
    assert D.detect_encoding(b"\x00\x00a\x00\x00a" * 4) == "utf-16-be" and D.detect_encoding("ab".encode("utf-16-le")) == "utf-16-le"


def test_brackets(spark, monkeypatch):
    """Quantiles by brackets are those of all values, ties and infinities included."""
    import random

    from tickloom.operators import layout

    monkeypatch.setattr(layout, "FEW_VALUES", 10)
    monkeypatch.setattr(layout, "SPARE", 0.01)
    rng = random.Random(4)
    values = {"a": [rng.gauss(0, 1) for _ in range(3000)], "b": [float(rng.randrange(4)) for _ in range(3000)], "c": [rng.choice([math.inf, -math.inf, None, math.nan, rng.random()]) for _ in range(3000)]}
    df = spark.createDataFrame(list(zip(*values.values())), "a double, b double, c double").repartition(4)
    shares = [0.0, 0.001, 0.3, 0.5, 0.95, 1.0]
    got = {(r.column, r.share): r.value for r in nearest_quantiles(df, list(values), shares).collect()}
    for name, x in values.items():
        x = sorted(v for v in x if v is not None and not math.isnan(v))
        assert all(got[name, s] == x[math.floor(s * (len(x) - 1) + 0.5)] for s in shares)


def test_gaps_in_row_numbers(spark, monkeypatch):
    """Splits, boundaries and the order's check over cells of few rows, with gaps between row numbers."""
    import random

    monkeypatch.setattr(S, "CELL_ROWS", 7)
    rng = random.Random(6)
    rows = [(s, i, 1000 * i + rng.choice([0, 0, 0, 2500])) for s in "ab" for i in sorted(rng.sample(range(400), 120))]
    df = spark.createDataFrame(rows, "series_id string, row_id long, t long").select("series_id", "row_id", F.timestamp_millis("t").alias("end_time")).repartition(3)
    bad = {s: 0 for s in "ab"}
    for s in "ab":
        own = [t for x, _, t in rows if x == s]
        bad[s] = sum(b < a for a, b in zip(own, own[1:]))
    assert {r.series_id: r.violations for r in S.monotonic_violations(df).collect()} == bad and sum(bad.values())
    c = G.SplitConfig(start=None, end=None, mode="row")
    got = {(r.series_id, r.row_id): r.split for r in S.row_split(df, c).collect()}
    names = ["train"] * 84 + ["val"] * 18 + ["test"] * 18
    want = {(s, i): names[k] for s in "ab" for k, i in enumerate(i for x, i, _ in rows if x == s)}
    assert got == want
    left = {(r.series_id, r.row_id) for r in S.boundary_drop(S.row_split(df, c), 9).collect()}
    assert left == {(s, i) for s in "ab" for k, i in enumerate(i for x, i, _ in rows if x == s) if not (75 <= k < 84 or 93 <= k < 102)}


def test_blocks_of_every_series(spark):
    """A short series is fitted on its own first part, whatever the longest one's length, and rows behind don't count."""
    rows = [("a", i + 20, float(i)) for i in range(1000)] + [("b", i + 7, float(i)) for i in range(40)]
    df = spark.createDataFrame(rows, "series_id string, row_id long, x double")
    sizes = df.groupBy("series_id").agg((F.max("row_id") - F.min("row_id") + 1).alias("n"), F.min("row_id").alias("first"))
    got = T.series_blocks(df, sizes, 0.7, 5, 50_000, 2, distinct=True).groupBy("series_id").agg(F.max("x").alias("top"), F.count("*").alias("n"))
    assert {r.series_id: (r.top, r.n) for r in got.collect()} == {"a": (699.0, 700), "b": (27.0, 28)}
    one = T.series_blocks(df.where("series_id = 'a'"), sizes.where("series_id = 'a'"), 0.7, 5, 300, 1)
    plain = T.fit_blocks(df.where("series_id = 'a'").withColumn("row_id", F.col("row_id") - 20), 700, 5, 10_000)
    assert sorted((r.block, r.x) for r in one.collect()) == sorted((r.block, r.x) for r in plain.collect())
    assert T.series_blocks(df, sizes, 0.7, 1, 50_000, 2).where("series_id = 'b'").count() == 28


@pytest.mark.parametrize("values,unit", [([1.0e18, 1.0], "ns"), ([3e17, 1.0, 1.0], "s"), ([2e14, 1e9], "us"), ([1.9e14, 1.0], "ms"), ([], "s"), ([None], "s"), ([1e12], "ms"), ([1.5e11, 1e9], "s")])
def test_epoch_bounds(spark, values, unit):
    import statistics

    some = [v for v in values if v is not None]
    if some:
        middle = statistics.median(some)
        assert unit == next((u for b, u in Q.UNITS if middle > b), "s")
    assert Q.epoch_unit(spark.createDataFrame([(v,) for v in values], "time double")) == unit
