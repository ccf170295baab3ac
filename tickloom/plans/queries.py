"""The engine's queries over the driver's tables, and the SQL that DuckDB must agree with.

Quotes are made from events: one series, a price from the value and a spread that varies. Doubles are rounded, since both
engines sum in orders of their own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import FeatureConfig, LabelConfig, SplitConfig
from ..functions import kernels as K
from ..functions.safe import ln, zero
from ..operators import bars as B
from ..operators import features as X
from ..operators import fit as T
from ..operators import labels as L
from ..operators import quotes as Q
from ..operators import split as S
from ..operators.layout import BLOCK, nearest_quantiles, own_rows, row_index, with_halo
from ..sources.files import scan
from . import oracle as O

Query = Callable[[SparkSession, str], DataFrame]
REGISTERED: dict[str, tuple[Query, str | None]] = {}

FEATURES = FeatureConfig(block_rows=500)
LABELS = LabelConfig(horizon=O.H, vol_window=O.WIN, atr_window=O.WIN, block_rows=100)
SPLIT = SplitConfig(start=None, end=None)
W = 20


def query(sql: str | None):
    def register(f: Query) -> Query:
        REGISTERED[f.__name__] = (f, sql)
        return f

    return register


def events(spark: SparkSession, at: str) -> DataFrame:
    return spark.read.parquet(f"{at}/events.parquet")


def quotes(spark: SparkSession, at: str) -> DataFrame:
    price = F.lit(100.0) + F.col("value") / F.lit(100.0)
    wave = (31 * F.col("event_id") * F.col("event_id") + 7 * F.col("event_id")) % 97
    return events(spark, at).select(F.lit("S").alias("series_id"), "event_id", "event_type", F.col("ts").alias("time"), price.alias("bid"), (price + F.lit(0.001) * (10 + wave)).alias("ask"))


def bars(spark: SparkSession, at: str, size: int = O.SIZE) -> DataFrame:
    return B.tick_bars(quotes(spark, at), size)


def r6(c: Column | str, digits: int = 6) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, digits) + F.lit(0.0)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[r6(c, digits).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes])


# scans, cleaning


@query("SELECT event_id, ts, value FROM events WHERE value > 5e1")
def parquet_scan(spark, at):
    return scan(spark, f"{at}/events.parquet", ["event_id", "ts", "value"]).where(F.col("value") > 50.0)


@query("SELECT event_id, ts AS time, value FROM events")
def parquet_zstd_sink(spark, at):
    from ..sources.files import sink
    from .scratch import scratch

    path = sink(events(spark, at).select("event_id", F.col("ts").alias("time"), "value"), f"{scratch(spark)}/sink")
    return spark.read.parquet(path)


@query("SELECT event_id, round(value, 6) + 0e0 AS value, event_type FROM events")
def csv_scan(spark, at):
    """Events written as a delimited file, found out and read back."""
    from ..sources.delimited import read_quotes_text
    from .scratch import scratch

    path = f"{scratch(spark)}/events.csv"
    events(spark, at).select("event_id", "value", "event_type").write.option("header", True).option("sep", ";").csv(path)
    text = read_quotes_text(spark, path)
    return text.select(F.col("event_id").cast("long").alias("event_id"), r6(Q.parse_price(F.col("value"))).alias("value"), "event_type")


@query(f"WITH {O.QUOTES} SELECT time, round(bid, 6) AS bid, round(ask, 6) AS ask FROM quotes")
def alias_columns(spark, at):
    named = quotes(spark, at).select(F.col("time").alias(" Timestamp "), F.col("bid").alias("PX_BID"), F.col("ask").alias("Offer"), "event_type")
    return rounded(Q.alias_columns(named))


@query("SELECT event_id, value FROM events WHERE event_id % 7 <> 0 AND value IS NOT NULL")
def drop_nulls(spark, at):
    return Q.drop_nulls(events(spark, at).select("event_id", F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("value")), ["value"])


@query("SELECT event_id, round(CAST(event_id % 9000 + 1000 AS DOUBLE) + (event_id % 100) / 1e2, 6) + 0e0 AS price FROM events WHERE event_id % 5 <> 4 UNION ALL SELECT event_id, NULL FROM events WHERE event_id % 5 = 4")
def parse_price(spark, at):
    """The same number in four notations, and one that is none."""
    whole, cents = F.col("event_id") % 9000 + 1000, F.lpad((F.col("event_id") % 100).cast("string"), 2, "0")
    text = whole.cast("string")
    grouped = lambda g: F.concat(F.expr("left(text, length(text) - 3)"), F.lit(g), F.expr("right(text, 3)"))
    rows = events(spark, at).select("event_id", text.alias("text"), cents.alias("cents"))
    kind = F.col("event_id") % 5
    shown = (
        F.when(kind == 0, F.concat(grouped(","), F.lit("."), "cents"))
        .when(kind == 1, F.concat(grouped("."), F.lit(","), "cents"))
        .when(kind == 2, F.concat("text", F.lit(","), "cents"))
        .when(kind == 3, F.concat(F.lit(" "), "text", F.lit("."), "cents", F.lit(" ")))
        .otherwise(F.concat("text", F.lit("d")))
    )
    return rows.select("event_id", r6(Q.parse_price(shown)).alias("price"))


@query("SELECT event_id, epoch_us(ts) AS us, epoch_us(ts) // 1000 * 1000 AS ms FROM events")
def epoch_infer(spark, at):
    """Microseconds and milliseconds, told apart by their median."""
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    rows = events(spark, at).select("event_id", us.alias("a"), F.floor(us / F.lit(1000)).cast("long").alias("b"))
    read = Q.with_time(Q.with_time(rows, "a"), "b")
    return read.select("event_id", F.unix_micros("a").alias("us"), F.unix_micros("b").alias("ms"))


@query("SELECT event_id, CASE WHEN event_id % 4 <> 3 THEN epoch_us(date_trunc('second', ts)) END AS us FROM events")
def parse_time(spark, at):
    """ISO, dotted, slashed, and none."""
    t = F.col("ts")
    kind = F.col("event_id") % 4
    shown = F.when(kind == 0, F.date_format(t, "yyyy-MM-dd HH:mm:ss")).when(kind == 1, F.date_format(t, "yyyy.MM.dd HH:mm:ss")).when(kind == 2, F.date_format(t, "yyyy/MM/dd HH:mm:ss")).otherwise(F.lit("soon"))
    return events(spark, at).select("event_id", F.unix_micros(Q.parse_time(shown)).alias("us"))


@query(f"WITH {O.QUOTES}, q AS (SELECT event_id, bid - 1e2 - (event_id % 3) AS bid, ask - 1e2 AS ask FROM quotes) SELECT event_id, round(bid, 6) + 0e0 AS bid, round(ask, 6) + 0e0 AS ask FROM q WHERE bid > 0 AND ask > 0 AND bid <= ask")
def quote_filter(spark, at):
    shifted = quotes(spark, at).select("event_id", (F.col("bid") - F.lit(100.0) - F.col("event_id") % 3).alias("bid"), (F.col("ask") - F.lit(100.0)).alias("ask"))
    return rounded(Q.quote_filter(shifted))


@query("SELECT event_id, value AS bid, value + 1e0 AS ask FROM events WHERE event_id % 10 > 1")
def finite_filter(spark, at):
    odd = F.when(F.col("event_id") % 10 == 0, F.lit(float("nan"))).when(F.col("event_id") % 10 == 1, F.lit(float("inf"))).otherwise(F.col("value"))
    return Q.finite_filter(events(spark, at).select("event_id", odd.alias("bid"), (F.col("value") + F.lit(1.0)).alias("ask")))


@query(f"WITH {O.QUOTES} SELECT epoch_us(time) AS us, round(bid, 6) AS bid, round(ask, 6) AS ask FROM quotes ORDER BY time, bid, ask")
def sort_time(spark, at):
    return rounded(Q.sort_time(quotes(spark, at)).select(F.unix_micros(F.col("time").cast("timestamp")).alias("us"), "bid", "ask"))


@query("SELECT DISTINCT date_trunc('hour', ts) AS time, round(floor(value / 1e1), 6) AS bid, round(floor(value / 1e1) + 1, 6) AS ask FROM events")
def dedup(spark, at):
    v = F.floor(F.col("value") / F.lit(10.0)).cast("double")
    return Q.dedup(events(spark, at).select(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("time"), v.alias("bid"), (v + F.lit(1.0)).alias("ask")))


@query(
    f"WITH {O.QUOTES}, s AS (SELECT *, ask - bid AS spread FROM quotes), b AS (SELECT {O.nearest('s', 'spread', 0.01)} AS a, {O.nearest('s', 'spread', 0.99)} AS z) SELECT event_id, round(ask - bid, 6) AS spread FROM s, b WHERE z <= a OR (spread >= a AND spread <= z)"
)
def spread_trim(spark, at):
    return Q.spread_trim(quotes(spark, at)).select("event_id", r6(F.col("ask") - F.col("bid")).alias("spread"))


@query("SELECT event_id, ts AS end_time FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-20'")
def date_filter(spark, at):
    return S.date_filter(events(spark, at).select("event_id", F.col("ts").alias("end_time")), "2024-01-05", "2024-01-20")


# rows and bars


@query("SELECT event_type AS series_id, event_id, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS row_id FROM events")
def row_index_query(spark, at):
    return row_index(events(spark, at).select(F.col("event_type").alias("series_id"), "event_id", "ts"), ["ts", "event_id"], cell_rows=500).select("series_id", "event_id", "row_id")


@query(f"WITH {O.TICKS} SELECT tick_id, tick_id // {O.SIZE} AS bar_id FROM ticks")
def tick_bar_key(spark, at):
    return B.number_ticks(quotes(spark, at)).select("tick_id", B.bar_key(F.col("tick_id"), O.SIZE).alias("bar_id"))


@query(f"WITH {O.BARS} SELECT {O.BAR_COLUMNS} FROM bars")
def tick_bars(spark, at):
    return rounded(bars(spark, at))


@query(
    f"WITH {O.QUOTES}, ticks AS (SELECT event_type, time, bid, ask, (bid + ask) / 2 AS mid, row_number() OVER (PARTITION BY event_type ORDER BY time, bid, ask) - 1 AS tick_id FROM quotes), bars AS (SELECT event_type AS series_id, tick_id // 10 AS row_id, {O._BAR} FROM ticks GROUP BY event_type, tick_id // 10) SELECT {O.BAR_COLUMNS} FROM bars"
)
def tick_bars_by_series(spark, at):
    return rounded(B.tick_bars(quotes(spark, at).withColumn("series_id", F.col("event_type")), 10))


@query(f"WITH {O.BARS} SELECT row_id, (epoch_us(end_time) - epoch_us(start_time)) / 1e3 AS duration_ms FROM bars")
def duration_ms(spark, at):
    return bars(spark, at).select("row_id", B.duration_ms().alias("duration_ms"))


# kernels


def returns(spark, at) -> tuple[DataFrame, K.Over]:
    """Bars with lc, r, dp and r_lag, in blocks with halos; own() takes the own rows."""
    over = K.Over(BLOCK)
    b = with_halo(bars(spark, at), 200, before=100).withColumn("lc", ln(F.col("close")))
    b = b.withColumns({"r": zero(F.col("lc") - over.lag(F.col("lc"))), "dp": F.col("close") - over.lag(F.col("close"))})
    return b.withColumn("r_lag", over.lag(F.col("r"))), over


def kernel(spark, at, make: Callable[[K.Over], dict[str, Column]], digits: int = 6) -> DataFrame:
    b, over = returns(spark, at)
    made = make(over)
    return rounded(own_rows(b.withColumns(made)).select("row_id", *made), digits)


@query(O.over_returns({"mean": O.mean("close", W), "total": O.total("close", W), "least": O.low("close", W), "most": O.high("close", W), "std": O.std("close", W)}))
def rolling_basic(spark, at):
    c = F.col("close")
    return kernel(spark, at, lambda o: {"mean": o.mean(c, W), "total": o.sum(c, W), "least": o.least(c, W), "most": o.most(c, W), "std": o.std(c, W)})


@query(O.over_returns({"log_return_1": "r", "log_return_5": O.zero(f"lc - {O.lag('lc', 5)}"), "delta": f"r - {O.lag('r')}"}))
def lag_returns(spark, at):
    lc, r = F.col("lc"), F.col("r")
    return kernel(spark, at, lambda o: {"log_return_1": r, "log_return_5": zero(lc - o.lag(lc, 5)), "delta": r - o.lag(r)})


@query(O.over_returns({"z": O.zs("close", W)}))
def zscore(spark, at):
    return kernel(spark, at, lambda o: {"z": o.zscore(F.col("close"), W)})


@query(O.over_returns({"z": O.zero(O.zs("spread_mean", W)), "pct": O.pct(O.zs("spread_mean", W))}))
def normalize_anchor(spark, at):
    return kernel(spark, at, lambda o: dict(zip(("z", "pct"), K.normalized(o, F.col("spread_mean"), W))))


@query(O.over_returns({"pct": O.pct(O.zs("close", W))}))
def pct_from_z(spark, at):
    return kernel(spark, at, lambda o: {"pct": K.pct_from_z(o.zscore(F.col("close"), W))})


@query(O.over_returns({"v": O.clip(O.div(f"close - {O.low('close', W)}", f"{O.high('close', W)} - {O.low('close', W)}"), "0e0", "1e0")}))
def range_position(spark, at):
    return kernel(spark, at, lambda o: {"v": o.range_position(F.col("close"), W)})


@query(O.over_returns({"v": O.rv("r", W)}))
def realized_vol(spark, at):
    return kernel(spark, at, lambda o: {"v": o.realized_vol(F.col("r"), W)})


@query(O.over_returns({"v": O.corr("r", "spread_mean", W)}))
def rolling_corr(spark, at):
    return kernel(spark, at, lambda o: {"v": o.corr(F.col("r"), F.col("spread_mean"), W)})


@query(O.over_returns({"v": f"1e6 * {O.cov('r', 'spread_mean', W)}"}))
def rolling_cov(spark, at):
    return kernel(spark, at, lambda o: {"v": F.lit(1e6) * o.cov(F.col("r"), F.col("spread_mean"), W)})


@query(O.over_returns({"v": f"1e6 * {O.var('r', W)}"}))
def rolling_var(spark, at):
    return kernel(spark, at, lambda o: {"v": F.lit(1e6) * o.var(F.col("r"), W)})


@query(O.over_returns({"v": O.slope("close", W)}))
def trend_slope(spark, at):
    return kernel(spark, at, lambda o: {"v": o.trend_slope(F.col("close"), W)})


@query(O.over_returns({"v": O.r2("close", W)}))
def trend_r2(spark, at):
    return kernel(spark, at, lambda o: {"v": o.trend_r2(F.col("close"), W)})


@query(O.over_returns({"v": O.div(O.cov("r", "r_lag", W), O.var("r_lag", W))}))
def ar1_phi(spark, at):
    return kernel(spark, at, lambda o: {"v": o.ar1_phi(F.col("r"), F.col("r_lag"), W)})


@query(O.over_returns({"v": O.halflife(O.div(O.cov("r", "r_lag", W), O.var("r_lag", W)))}))
def ar1_halflife(spark, at):
    return kernel(spark, at, lambda o: {"v": K.ar1_halflife(o.ar1_phi(F.col("r"), F.col("r_lag"), W))})


@query(O.over_returns({"v": O.div(f"abs(close - {O.lag('close', W)})", O.total("abs(dp)", W))}))
def efficiency_ratio(spark, at):
    return kernel(spark, at, lambda o: {"v": o.efficiency_ratio(F.col("close"), o.lag(F.col("close"), W), F.abs("dp"), W)})


@query(f"WITH {O.RETURNS}, {O.stage('d', 'c', {'r5': O.zero('lc - ' + O.lag('lc', 5))})}, {O.stage('e', 'd', {'v': O.div(O.var('r5', W), '5e0 * ' + O.var('r', W))})} SELECT row_id, {O.rounded(['v'])} FROM e")
def variance_ratio(spark, at):
    b, over = returns(spark, at)
    b = b.withColumn("r5", zero(F.col("lc") - over.lag(F.col("lc"), 5)))
    return rounded(own_rows(b.withColumn("v", over.variance_ratio(F.col("r"), F.col("r5"), W, 5))).select("row_id", "v"))


@query(O.over_returns({"v": O.entropy("r", W)}))
def sign_entropy(spark, at):
    return kernel(spark, at, lambda o: {"v": o.sign_entropy(F.col("r"), W)})


@query(O.features(FEATURES.windows))
def features_full(spark, at):
    """Means of the spreads are often halves of the last digit, so all doubles are moved off them before they are rounded."""
    df = X.compute(bars(spark, at), FEATURES).drop("series_id", "start_time", "end_time")
    return df.select(*[r6(F.col(c) + F.lit(O.NUDGE)).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes])


# fitting

FIT = ["r", "spread_mean", "close"]


def fit_frame(spark, at) -> DataFrame:
    b, _ = returns(spark, at)
    return own_rows(b).select("series_id", "row_id", *FIT)


_FIT_ROWS = f"k AS (SELECT CAST(floor(count(*) * {FEATURES.fit_fraction}e0) AS BIGINT) AS n FROM c)"
_FIT_SPANS = f"v AS (SELECT i AS block, (n - 1) * i // {FEATURES.fit_blocks - 1} AS s, n FROM k, range({FEATURES.fit_blocks}) x(i))"


@query(f"WITH {O.RETURNS}, {_FIT_ROWS}, {_FIT_SPANS} SELECT block::INT AS block, row_id, round(close, 6) AS close FROM c JOIN v ON row_id >= s AND row_id < least(s + {FEATURES.fit_sample_rows // FEATURES.fit_blocks}, n)")
def fit_blocks(spark, at):
    """The blocks that fit() samples for the bounds."""
    rows = fit_frame(spark, at)
    blocks = T.series_blocks(rows, T.series_sizes(rows), FEATURES.fit_fraction, FEATURES.fit_blocks, FEATURES.fit_sample_rows, 1)
    return blocks.select("block", "row_id", r6("close").alias("close"))


@query("SELECT 'value' AS column, share, value FROM (" + " UNION ALL ".join(f"SELECT {s}e0 AS share, {O.nearest('events', 'value', s)} AS value" for s in (0.01, 0.5, 0.95, 0.99)) + ")")
def quantile_nearest(spark, at):
    return nearest_quantiles(events(spark, at), ["value"], [0.01, 0.5, 0.95, 0.99])


_BOUNDS = " UNION ALL ".join(f"SELECT '{c}' AS column, {O.nearest('c', c, 0.05)} AS low, {O.nearest('c', c, 0.95)} AS high" for c in FIT)


@query(f"WITH {O.RETURNS} SELECT \"column\", round(low, 6) + 0e0 AS low, round(high, 6) + 0e0 AS high FROM ({_BOUNDS})")
def clip_bounds(spark, at):
    return rounded(T.clip_bounds(fit_frame(spark, at), FIT, 0.05, 0.95))


@query(f"WITH {O.RETURNS}, bnd AS (SELECT {', '.join(f'{O.nearest("c", x, s)} AS {x}_{n}' for x in FIT for s, n in ((0.05, 'low'), (0.95, 'high')))}) SELECT row_id, {', '.join(f'round(least(greatest(c.{x}, {x}_low), {x}_high), 6) + 0e0 AS {x}' for x in FIT)} FROM c, bnd")
def clip_select(spark, at):
    rows = fit_frame(spark, at)
    bounds = {r.column: (r.low, r.high) for r in T.clip_bounds(rows, FIT, 0.05, 0.95).collect()}
    return rounded(T.clip_select(rows, ["row_id", *FIT], bounds))


@query("SELECT 'value' AS column, round(avg(CASE WHEN event_id % 7 = 0 THEN 1e0 ELSE 0e0 END), 6) AS null_rate FROM events")
def null_rate(spark, at):
    rows = events(spark, at).select(F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("value"))
    nulls, _ = T.null_rates_and_variances(rows, ["value"])
    return rounded(spark.createDataFrame(list(nulls.items()), "column string, null_rate double"))


@query(f"WITH {O.RETURNS} SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS column, round(1e6 * var_samp({c}), 4) AS variance FROM c" for c in FIT) + ")")
def feature_variance(spark, at):
    _, variances = T.null_rates_and_variances(fit_frame(spark, at), FIT)
    return rounded(spark.createDataFrame([(c, 1e6 * v) for c, v in variances.items()], "column string, variance double"), 4)


SCORED = ["close_z", "rv_XL", "spread_rel_x_pct", "r_1"]


@query(f"WITH {O.RETURNS} SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{n}' AS column, round(ln(1e0 + greatest(var_samp({c}), 0e0)) + {plus}e0, 6) AS score FROM c" for n, c, plus in zip(SCORED, ("close", "dp", "spread_mean", "r"), ("0.05", "0.02", "0.05", "0.02"))) + ")")
def feature_score(spark, at):
    b, _ = returns(spark, at)
    rows = own_rows(b).select(*[F.col(c).alias(n) for n, c in zip(SCORED, ("close", "dp", "spread_mean", "r"))])
    _, variances = T.null_rates_and_variances(rows, SCORED)
    return rounded(spark.createDataFrame([(n, T.feature_score(n, variances[n], 0.0)) for n in SCORED], "column string, score double"))


CORR = ["r", "r_lag", "dp", "spread_mean", "close", "open"]


def corr_frame(spark, at) -> DataFrame:
    b, _ = returns(spark, at)
    return own_rows(b).select(*CORR)


@query(f"WITH {O.RETURNS}, z AS (SELECT {', '.join(f'coalesce({c}, 0e0) AS {c}' for c in CORR)} FROM c) SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) + 0e0 AS corr FROM z" for a in CORR for b in CORR if a < b) + ")")
def corr_matrix(spark, at):
    names, matrix = T.correlation(corr_frame(spark, at), CORR)
    return rounded(spark.createDataFrame([(a, b, matrix[i][j]) for i, a in enumerate(names) for j, b in enumerate(names) if a < b], "a string, b string, corr double"))


@query(f"WITH {O.RETURNS}, z AS (SELECT {', '.join(f'coalesce({c}, 0e0) AS {c}' for c in CORR)} FROM c) SELECT a, b FROM (" + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS x FROM z" for i, a in enumerate(CORR) for b in CORR[i + 1 :]) + ") WHERE abs(x) >= 0.85e0")
def corr_prune(spark, at):
    """The pairs that pruning has to decide."""
    names, matrix = T.correlation(corr_frame(spark, at), CORR)
    return spark.createDataFrame([(a, b) for i, a in enumerate(names) for j, b in enumerate(names) if i < j and abs(matrix[i][j]) >= 0.85], "a string, b string")


@query(None)
def fit_transform(spark, at):
    """All features fitted, pruned and clipped; tests hold the choice against a plain model."""
    from ..sources.files import sink
    from .scratch import scratch

    features = spark.read.parquet(sink(X.compute(bars(spark, at), FEATURES), f"{scratch(spark)}/features"))  # computed once
    return T.transform(features, T.fit(features, FEATURES))


# splitting


def dated(spark, at) -> DataFrame:
    return bars(spark, at).select("series_id", "row_id", "end_time", "close")


@query(f"WITH {O.BARS}, l AS (SELECT series_id, end_time, lag(end_time) OVER (ORDER BY (row_id * 7) % 11, row_id) AS p FROM bars) SELECT series_id, sum(CASE WHEN end_time < p THEN 1 ELSE 0 END)::BIGINT AS violations FROM l GROUP BY series_id")
def monotonic_check(spark, at):
    mixed = dated(spark, at).withColumn("row_id", (F.col("row_id") * 7) % 11 * F.lit(1_000_000_000) + F.col("row_id"))
    return S.monotonic_violations(mixed)


_CUTS = f"{O.BARS}, m AS (SELECT min(epoch_us(end_time)) AS a, max(epoch_us(end_time)) AS z FROM bars), k AS (SELECT a + CAST(floor((z - a) * 0.7e0) AS BIGINT) AS c1, a + CAST(floor((z - a) * 0.85e0) AS BIGINT) AS c2 FROM m)"
_SPLITS = f"{_CUTS}, t AS (SELECT *, epoch_us(end_time) AS us FROM bars, k), s AS (SELECT *, CASE WHEN us < c1 - 21600000000 THEN 'train' WHEN us >= c1 + 21600000000 AND us < c2 - 21600000000 THEN 'val' WHEN us >= c2 + 21600000000 THEN 'test' END AS split FROM t)"


@query(f"WITH {_SPLITS} SELECT row_id, split FROM s WHERE split IS NOT NULL")
def time_split(spark, at):
    return S.time_split(dated(spark, at), SplitConfig(embargo="6h")).select("row_id", "split")


@query(f"WITH {O.BARS}, n AS (SELECT count(*) AS n FROM bars) SELECT row_id, CASE WHEN row_id < floor(n * 0.7e0) THEN 'train' WHEN row_id < floor(n * 0.7e0) + floor(n * 0.15e0) THEN 'val' ELSE 'test' END AS split FROM bars, n")
def row_split(spark, at):
    return S.row_split(dated(spark, at), SPLIT).select("row_id", "split")


@query(f"WITH {O.BARS}, n AS (SELECT count(*) AS n FROM bars), s AS (SELECT row_id, CASE WHEN row_id < floor(n * 0.7e0) THEN 'train' WHEN row_id < floor(n * 0.7e0) + floor(n * 0.15e0) THEN 'val' ELSE 'test' END AS split FROM bars, n), r AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY row_id DESC) AS k FROM s) SELECT row_id, split FROM r WHERE split = 'test' OR k > 5")
def boundary_drop(spark, at):
    return S.boundary_drop(S.row_split(dated(spark, at), SPLIT), 5).select("row_id", "split")


@query(f"WITH {_SPLITS} SELECT split, count(*) AS rows, min(end_time) AS time_min, max(end_time) AS time_max FROM s WHERE split IS NOT NULL GROUP BY split")
def split_info(spark, at):
    return S.split_info(S.time_split(dated(spark, at), SplitConfig(embargo="6h")))


# labels


def prepared(spark, at) -> DataFrame:
    return L.prepared(bars(spark, at), LABELS)


def labelled_rows(spark, at, config: LabelConfig = LABELS) -> DataFrame:
    return L.label_rows(L.prepared(bars(spark, at), config), config)


LABEL = f"WITH RECURSIVE {O.LABEL_BASE}"


@query(f"{LABEL} SELECT row_id, round(r, 8) + 0e0 AS r FROM l5")
def log_return_label(spark, at):
    return prepared(spark, at).select("row_id", r6("_r", 8).alias("r"))


@query(f"{LABEL} SELECT row_id, round(1e3 * vol, 6) + 0e0 AS vol FROM l5")
def ewm_vol(spark, at):
    return prepared(spark, at).select("row_id", r6(F.lit(1e3) * F.col("vol_target")).alias("vol"))


@query(f"WITH {O.BARS}, l AS (SELECT *, CASE WHEN row_id = 0 THEN 0e0 ELSE ln(close) - ln({O.lag('close')}) END AS r FROM bars), c AS (SELECT row_id, least(greatest(r, -0.02e0), 0.02e0) AS r FROM l) SELECT row_id, round(1e3 * {O.gate('stddev_pop(r)', 'r', W)}, 6) + 0e0 AS vol FROM c")
def rolling_std_pop(spark, at):
    own = L.prepared(bars(spark, at), LabelConfig(horizon=O.H, vol_window=W, atr_window=W, vol_mode="rolling_std", block_rows=100))
    return own.select("row_id", r6(F.lit(1e3) * F.col("vol_target")).alias("vol"))


@query(f"{LABEL} SELECT row_id, round(atr, 6) + 0e0 AS atr FROM l5")
def atr_ewm(spark, at):
    return prepared(spark, at).select("row_id", r6("atr").alias("atr"))


@query(f"WITH {O.BARS}, l AS (SELECT row_id, {O.TR} AS tr FROM bars) SELECT row_id, round(CASE WHEN row_id >= {W - 1} THEN avg(tr) OVER {O.back(W)} END, 6) + 0e0 AS atr FROM l")
def atr_sma(spark, at):
    own = L.prepared(bars(spark, at), LabelConfig(horizon=O.H, vol_window=W, atr_window=W, atr_mode="sma", block_rows=100))
    return own.select("row_id", r6("atr").alias("atr"))


@query(f"{LABEL} SELECT row_id, round(1e3 * atr_ret, 6) + 0e0 AS atr_ret FROM l5")
def atr_ret(spark, at):
    return labelled_rows(spark, at).select("row_id", r6(F.lit(1e3) * F.col("atr_ret")).alias("atr_ret"))


@query(f"{LABEL} SELECT row_id, round(cost, 6) + 0e0 AS cost FROM l5")
def cost_bps(spark, at):
    return labelled_rows(spark, at).select("row_id", r6("cost_bps_h").alias("cost"))


@query(f"{LABEL} SELECT row_id, t1, round(1e3 * ret_h, 6) + 0e0 AS ret, ok_h AS ok FROM l5")
def fwd_return_h(spark, at):
    return labelled_rows(spark, at).select("row_id", F.col("t1_timeout_index").alias("t1"), r6(F.lit(1e3) * F.col("y_ret_net_h")).alias("ret"), F.col("is_valid_label_h").alias("ok"))


@query(f"{LABEL} SELECT row_id, CASE WHEN ret_h > 0 THEN 1 WHEN ret_h <= 0 THEN 0 ELSE -1 END AS y FROM l5")
def up_down(spark, at):
    return labelled_rows(spark, at).select("row_id", F.col("y_up_h").cast("int").alias("y"))


def _barrier(spark, at, tie):
    from dataclasses import replace

    own = labelled_rows(spark, at, replace(LABELS, tie_break=tie))
    return own.select("row_id", F.col("t1_tb_index").alias("t1"), F.col("barrier_touch_tb").cast("int").alias("kind"), F.col("side_tb").cast("int").alias("side"), r6(F.lit(1e3) * F.col("y_ret_net_tb")).alias("ret"), F.col("is_valid_label_tb").alias("ok"))


def _barrier_sql(tie):
    return f"WITH RECURSIVE {O.barrier(tie)} SELECT row_id, t1_tb AS t1, CASE WHEN placed THEN kind ELSE 0 END AS kind, CASE WHEN placed THEN side ELSE 0 END AS side, round(1e3 * ret_tb, 6) + 0e0 AS ret, ok_tb AS ok FROM h5"


@query(_barrier_sql("close"))
def triple_barrier(spark, at):
    return _barrier(spark, at, "close_based")


@query(_barrier_sql("worst"))
def triple_barrier_worst(spark, at):
    return _barrier(spark, at, "worst_case")


@query(_barrier_sql("best"))
def triple_barrier_best(spark, at):
    return _barrier(spark, at, "best_case")


@query(f"WITH RECURSIVE {O.WEIGHTED} SELECT row_id, round(uniq_h, 6) + 0e0 AS uniq_h, round(uniq_tb, 6) + 0e0 AS uniq_tb FROM w")
def uniqueness(spark, at):
    rows = L.uniqueness(labelled_rows(spark, at), "t1_timeout_index", "is_valid_label_h", "uniq_h", LABELS)
    rows = L.uniqueness(rows, "t1_tb_index", "is_valid_label_tb", "uniq_tb", LABELS)
    return rows.select("row_id", r6("uniq_h").alias("uniq_h"), r6("uniq_tb").alias("uniq_tb"))


@query(
    f"WITH RECURSIVE {O.barrier()}, v AS (SELECT row_id, t1_tb FROM h5 WHERE ok_tb AND t1_tb > row_id), p AS (SELECT row_id, t1_tb FROM v WHERE row_id = (SELECT min(row_id) FROM v WHERE row_id > 1) UNION ALL SELECT n.row_id, n.t1_tb FROM p, LATERAL (SELECT row_id, t1_tb FROM v WHERE v.row_id > p.t1_tb + 2 ORDER BY row_id LIMIT 1) n) SELECT row_id, row_id IN (SELECT row_id FROM p) AS kept FROM h5 WHERE ok_tb"
)
def purge(spark, at):
    return L.purge(labelled_rows(spark, at), "t1_tb_index", "is_valid_label_tb", 2, "kept").select("row_id", "kept")


@query(f"WITH RECURSIVE {O.WEIGHTED} SELECT row_id, round(w_h, 6) + 0e0 AS w_h, round(w_tb, 6) + 0e0 AS w_tb FROM w")
def sample_weight(spark, at):
    return L.label(bars(spark, at), LABELS, check=False).select("row_id", r6("sample_weight_h").alias("w_h"), r6("sample_weight_tb").alias("w_tb"))


@query(
    f"""WITH RECURSIVE {O.WEIGHTED} SELECT row_id, round(1e3 * vol, 6) + 0e0 AS vol_target, round(atr, 6) + 0e0 AS atr, round(1e3 * atr_ret, 6) + 0e0 AS atr_ret, t1 AS t1_timeout_index,
  CASE WHEN ok_h THEN time_h END AS t1_timeout_time, round(1e3 * ret_h, 6) + 0e0 AS y_ret_net_h, CASE WHEN ret_h > 0 THEN 1 WHEN ret_h <= 0 THEN 0 ELSE -1 END AS y_up_h, round(cost, 6) + 0e0 AS cost_bps_h,
  round(w_h, 6) + 0e0 AS sample_weight_h, ok_h AS is_valid_label_h, t1_tb AS t1_tb_index, CASE WHEN ok_tb THEN time_at END AS t1_tb_time, CASE WHEN placed THEN kind ELSE 0 END AS barrier_touch_tb,
  CASE WHEN placed THEN side ELSE 0 END AS side_tb, round(1e3 * ret_tb, 6) + 0e0 AS y_ret_net_tb, CASE WHEN ok_tb AND ret_tb > 0 THEN 1 ELSE 0 END AS y_meta_execute_tb,
  round(CASE WHEN begun THEN cost END, 6) + 0e0 AS cost_bps_tb, round(w_tb, 6) + 0e0 AS sample_weight_tb, ok_tb AS is_valid_label_tb FROM w"""
)
def labels_full(spark, at):
    own = L.label(bars(spark, at), LABELS, check=False).select("row_id", *L.LABELS)
    thousandths = {"vol_target", "atr_ret", "y_ret_net_h", "y_ret_net_tb"}
    kinds = dict(own.dtypes)
    shown = [F.col(c).cast("int").alias(c) if kinds[c] == "tinyint" else r6(F.lit(1e3) * F.col(c) if c in thousandths else c).alias(c) if kinds[c] == "double" else F.col(c) for c in own.columns]
    return own.select(*shown)


def _stat(ok, x):
    return f"avg(CASE WHEN {ok} THEN ({x})::DOUBLE END)"


@query(
    f"""WITH RECURSIVE {O.WEIGHTED}, vh AS (SELECT ret_h, cost FROM w WHERE ok_h), vt AS (SELECT ret_tb, cost FROM w WHERE ok_tb), s AS (SELECT count(*) AS rows, count(*) FILTER (ok_h) AS H_valid_rows, 1e3 * {_stat('ok_h', 'ret_h')} AS H_ret_mean,
  1e3 * stddev_samp(CASE WHEN ok_h THEN ret_h END) AS H_ret_std, {_stat('ok_h', 'ret_h > 0')} AS H_hit_rate, {_stat('ok_h', 'cost')} AS H_cost_bps_mean, {_stat('ok_h', 'w_h')} AS H_w_mean, count(*) FILTER (ok_tb) AS TB_valid_rows,
  1e3 * {_stat('ok_tb', 'ret_tb')} AS TB_ret_mean, 1e3 * stddev_samp(CASE WHEN ok_tb THEN ret_tb END) AS TB_ret_std, {_stat('ok_tb', 'ret_tb > 0')} AS TB_hit_rate, {_stat('ok_tb', 'cost')} AS TB_cost_bps_mean, {_stat('ok_tb', 'w_tb')} AS TB_w_mean,
  count(*) FILTER (ok_tb AND side <> 0) AS TB_trades, {_stat('ok_tb', 'ret_tb > 0')} AS TB_meta_execute_rate, {_stat('ok_tb', 'kind = 1')} AS TB_tp_rate, {_stat('ok_tb', 'kind = -1')} AS TB_sl_rate, {_stat('ok_tb', 'kind = 0')} AS TB_timeout_rate FROM w)
  SELECT * REPLACE ({', '.join(f'round({c}, 6) + 0e0 AS {c}' for c in 'H_ret_mean H_ret_std H_hit_rate H_cost_bps_mean H_w_mean TB_ret_mean TB_ret_std TB_hit_rate TB_cost_bps_mean TB_w_mean TB_meta_execute_rate TB_tp_rate TB_sl_rate TB_timeout_rate'.split())}),
  round(TB_trades / greatest(rows, 1)::DOUBLE, 6) + 0e0 AS TB_trade_rate, round(1e3 * {O.nearest('vh', 'ret_h', 0.5)}, 6) + 0e0 AS H_ret_p50, round({O.nearest('vh', 'cost', 0.95)}, 6) + 0e0 AS H_cost_bps_p95,
  round(1e3 * {O.nearest('vt', 'ret_tb', 0.5)}, 6) + 0e0 AS TB_ret_p50, round({O.nearest('vt', 'cost', 0.95)}, 6) + 0e0 AS TB_cost_bps_p95 FROM s"""
)
def label_stats(spark, at):
    own = L.label_stats(L.label(bars(spark, at), LABELS, check=False))
    thousandths = {"H_ret_mean", "H_ret_std", "TB_ret_mean", "TB_ret_std", "H_ret_p50", "TB_ret_p50"}
    return rounded(own.select(*[(F.lit(1e3) * F.col(c)).alias(c) if c in thousandths else F.col(c) for c in own.columns]))


def queries() -> dict[str, Query]:
    return {name.removesuffix("_query"): f for name, (f, _) in REGISTERED.items()}


def oracle_sql() -> dict[str, str]:
    return {name.removesuffix("_query"): sql for name, (_, sql) in REGISTERED.items() if sql}
