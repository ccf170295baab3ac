"""The feature catalogue, in stages over one layout of windows.

Each stage is one select whose windows share a partitioning and an order, so bars are exchanged and sorted once: lags of
prices, what follows from them, rolling kernels, lags of these, and normalisation by z-scores. A kernel that several
features use is computed once under a name of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import FeatureConfig
from ..functions import kernels as K
from ..functions.safe import div, finite, ln, lit, zero
from .bars import duration_ms
from .layout import BLOCK, own_rows, with_halo
from .quotes import require

PRICES = "open high low close bid_open bid_high bid_low bid_close ask_open ask_high ask_low ask_close".split()
BASE = ["start_time", "end_time", *PRICES, "spread_mean", "ticks", "duration_ms", "ticks_per_ms", "log_return_1_per_ms", "mid", "microprice_proxy", "log_return_1", "spread_rel_return_1", "spread_rel_range_1"]
KEYS = ["series_id", "row_id"]
#: Names of windows that the groups beyond the per-window family use; the lags of the variance ratios.
TREND, AUTOCORR, MEAN_REVERSION, CROSS = ("M", "L", "XL"), ("S", "M"), ("M", "L"), ("M", "L")
VARIANCE_LAGS = {"M": 5, "L": 10}


class Stages:
    """Columns by stage; the same name is added once."""

    def __init__(self, df: DataFrame):
        self.df, self.new = df, {}

    def add(self, name: str, value: Column) -> Column:
        self.new.setdefault(name, value)
        return F.col(name)

    def next(self) -> None:
        self.df = self.df.select("*", *[v.alias(k) for k, v in self.new.items()])
        self.new = {}


def catalogue(config: FeatureConfig) -> list[tuple[str, str, int, bool, bool]]:
    """(name, group, rows by which it is normalised, z?, pct?) of all features beyond the base columns, in output order."""
    wins, anchor = config.windows, config.anchor_rows
    out = [(n, "base", anchor, True, K.is_heavy_tail(n)) for n in ("microprice_proxy", "spread_rel_return_1", "spread_rel_range_1", "ticks_per_ms", "log_return_1_per_ms")]
    family = ["log_return", "delta_log_return", "rv", "range_position", "range_width", "spread_mean", "spread_change", "spread_vol", "ticks_mean", "ticks_change", "tick_imbalance", "bid_change", "ask_change", "bid_ask_pressure", "efficiency_ratio", "return_sign_entropy"]
    with_pct = {"rv", "range_width", "spread_mean", "spread_change", "spread_vol", "bid_ask_pressure", "efficiency_ratio", "return_sign_entropy"}
    out += [(f"{f}_{w}", "window", anchor, True, f in with_pct) for w in wins for f in family]
    out += [(f"{f}_{w}", "trend", anchor, True, False) for w in TREND if w in wins for f in ("trend_slope", "trend_r2", "trend_strength")]
    out += [(f"return_autocorr_{w}", "autocorr", anchor, True, False) for w in AUTOCORR if w in wins]
    out += [(f"{f}_{w}", "reversion", anchor, True, True) for w in MEAN_REVERSION if w in wins for f in ("ar1_phi", "mean_reversion_halflife")]
    out += [(f"{f}_{w}", "cross", wins[w], True, False) for w in CROSS if w in wins for f in ("corr_ret1_rvS", "corr_ret1_spread", "corr_rvS_spread")]
    out += [(f"rv_change_{w}", "cross", wins[w], True, True) for w in CROSS if w in wins]
    out += [(f"variance_ratio_{w}_k{k}", "cross", wins[w], True, True) for w, k in VARIANCE_LAGS.items() if w in wins]
    return out


def feature_names(config: FeatureConfig) -> list[str]:
    """The output's feature columns in order: base, then each feature followed by its normalised forms."""
    out = list(BASE)
    for name, group, _, z, pct in catalogue(config):
        out += [name] * (group != "base") + [f"{name}_z"] * z + [f"{name}_pct"] * pct
    return out


def base_features(bars: DataFrame, over: K.Over) -> Stages:
    s = Stages(bars.select(*KEYS, *[c for c in bars.columns if c.startswith("_")], "start_time", "end_time", *[F.col(c).cast("double").alias(c) for c in (*PRICES, "spread_mean", "ticks")]))
    s.add("_lc", ln(F.col("close")))
    s.add("mid", (F.col("bid_close") + F.col("ask_close")) / lit(2))
    s.add("duration_ms", duration_ms())
    s.next()
    s.add("microprice_proxy", F.col("mid") - F.col("close"))
    s.add("ticks_per_ms", div(F.col("ticks"), F.col("duration_ms")))
    s.add("spread_rel_range_1", div(F.col("high") - F.col("low"), F.col("spread_mean")))
    s.add("log_return_1", zero(F.col("_lc") - over.lag(F.col("_lc"))))
    s.add("_dp", F.col("close") - over.lag(F.col("close")))
    return s


def long_zscores(s: Stages, over: K.Over, asked: list[tuple[str, int]]) -> None:
    """_z_<name>: the z-score of a column over so many rows, at a cost per row that doesn't grow with them.

    Frames are differences of running sums. The values are taken from a centre that is near them: that of a stretch of as many rows
    as the frame, the value at its start. So a frame meets two centres at most, and its rows before the last start (_m of them) are
    moved to the present one; sums lose nothing to a level far from that of the frame. A spread that is no more than rounding
    leaves of the sums, or of the values, is zero, and its z-score null.
    """
    w = f"(PARTITION BY {', '.join(over.keys)} ORDER BY {over.order}"
    every, running, row = f"{w} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)", f"{w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)", f"{w})"
    # as text: a call per stage instead of one per operation
    value = "CASE WHEN NOT isnan({0}) AND abs({0}) < double('Infinity') THEN {0} END"
    start = "_place % {0} = 0"
    steps = [
        lambda x, n: [f"coalesce(last(CASE WHEN {start.format(n)} THEN {value.format(x)} END, true) OVER {running}, first({value.format(x)}, true) OVER {every}) AS _c_{x}"],
        lambda x, n: [f"{value.format(x)} - _c_{x} AS _d_{x}"],
        lambda x, n: [f"count(_d_{x}) OVER {running} AS _n_{x}", f"coalesce(sum(_d_{x}) OVER {running}, 0D) AS _s_{x}", f"coalesce(sum(_d_{x} * _d_{x}) OVER {running}, 0D) AS _q_{x}"],
        lambda x, n: [
            f"lag(struct(_n_{x} AS n, _s_{x} AS s, _q_{x} AS q, _c_{x} AS c), {n}) OVER {row} AS _l_{x}",
            f"last(CASE WHEN {start.format(n)} THEN struct(_n_{x} - int(_d_{x} IS NOT NULL) AS n, _s_{x} - coalesce(_d_{x}, 0D) AS s) END, true) OVER {running} AS _a_{x}",
        ],
        lambda x, n: [
            f"nullif(_n_{x} - coalesce(_l_{x}.n, 0), 0) AS _nw_{x}", f"_s_{x} - coalesce(_l_{x}.s, 0D) AS _sw_{x}", f"_q_{x} - coalesce(_l_{x}.q, 0D) AS _qw_{x}",
            f"double(_a_{x}.n - coalesce(_l_{x}.n, 0)) AS _m_{x}", f"_a_{x}.s - coalesce(_l_{x}.s, 0D) AS _sm_{x}", f"coalesce(_l_{x}.c - _c_{x}, 0D) AS _by_{x}",
        ],
        lambda x, n: [f"_sw_{x} + _m_{x} * _by_{x} AS _st_{x}", f"_qw_{x} + _by_{x} * (2 * _sm_{x} + _m_{x} * _by_{x}) AS _qt_{x}"],
        lambda x, n: [f"_qt_{x} - _st_{x} * _st_{x} / _nw_{x} AS _v_{x}"],
        lambda x, n: [f"CASE WHEN _nw_{x} >= {n} AND _v_{x} > 1e-13D * greatest(_q_{x}, _qt_{x}) AND _v_{x} > 1e-28D * _nw_{x} * _c_{x} * _c_{x} THEN (_d_{x} - _st_{x} / _nw_{x}) / sqrt(_v_{x} / (_nw_{x} - 1)) END AS _z_{x}"],
    ]
    s.df = s.df.selectExpr("*", f"row_number() OVER {row} - 1 AS _place")
    for step in steps:
        s.df = s.df.selectExpr("*", *[e for name, rows in asked for e in step(name, rows)])


def compute(bars: DataFrame, config: FeatureConfig, drop_first: bool = True) -> DataFrame:
    """series_id, row_id and feature_names(): one row per bar, without the first max(windows) bars of a series.

    Infinite and NaN values are null. Extra columns of bars aren't read. An empty table gives no rows.
    """
    require(bars, [*KEYS, "start_time", "end_time", *PRICES, "spread_mean", "ticks"])
    wins, over = config.windows, K.Over(BLOCK)
    laid = with_halo(bars.select(*KEYS, "start_time", "end_time", *PRICES, "spread_mean", "ticks"), config.block_rows, before=config.halo, spread=True)
    s = base_features(laid, over)
    close, lc, spread, ticks = F.col("close"), F.col("_lc"), F.col("spread_mean"), F.col("ticks")
    for name, w in wins.items():
        s.add(f"log_return_{name}", zero(lc - over.lag(lc, w)))
        s.add(f"bid_change_{name}", zero(F.col("bid_close") - over.lag(F.col("bid_close"), w)))
        s.add(f"ask_change_{name}", zero(F.col("ask_close") - over.lag(F.col("ask_close"), w)))
        s.add(f"_back_{name}", over.lag(close, w))
    for name, k in VARIANCE_LAGS.items():
        if name in wins:
            s.add("_lr1", lc - over.lag(lc))
            s.add(f"_lr{k}", lc - over.lag(lc, k))
    s.next()

    r = F.col("log_return_1")
    s.add("spread_rel_return_1", div(r, spread))
    s.add("log_return_1_per_ms", div(r, F.col("duration_ms")))
    s.add("_sign", zero(F.signum("_dp")))
    s.add("_r_lag", over.lag(r))
    for name in wins:
        s.add(f"delta_log_return_{name}", zero(F.col(f"log_return_{name}") - over.lag(F.col(f"log_return_{name}"))))
        s.add(f"bid_ask_pressure_{name}", F.col(f"ask_change_{name}") - F.col(f"bid_change_{name}"))
    s.next()

    for name, w in wins.items():
        s.add(f"rv_{name}", over.realized_vol(r, w))
        s.add(f"range_position_{name}", over.range_position(close, w))
        s.add(f"range_width_{name}", over.most(close, w) - over.least(close, w))
        s.add(f"spread_mean_{name}", over.mean(spread, w))
        s.add(f"spread_vol_{name}", over.std(spread, w))
        s.add(f"ticks_mean_{name}", over.mean(ticks, w))
        s.add(f"tick_imbalance_{name}", over.sum(F.col("_sign"), w) / lit(w))
        s.add(f"efficiency_ratio_{name}", over.efficiency_ratio(close, F.col(f"_back_{name}"), F.abs("_dp"), w))
        s.add(f"return_sign_entropy_{name}", over.sign_entropy(r, w))
        if name in TREND:
            s.add(f"trend_slope_{name}", over.trend_slope(close, w))
            s.add(f"trend_r2_{name}", over.trend_r2(close, w))
        if name in AUTOCORR:
            s.add(f"return_autocorr_{name}", over.corr(r, F.col("_r_lag"), w))
        if name in MEAN_REVERSION:
            s.add(f"ar1_phi_{name}", over.ar1_phi(r, F.col("_r_lag"), w))
        if name in CROSS:
            s.add(f"corr_ret1_spread_{name}", over.corr(r, spread, w))
        if name in VARIANCE_LAGS:
            k = VARIANCE_LAGS[name]
            s.add(f"variance_ratio_{name}_k{k}", over.variance_ratio(zero(F.col("_lr1")), zero(F.col(f"_lr{k}")), w, k))
    s.next()

    for name, w in wins.items():
        s.add(f"spread_change_{name}", zero(F.col(f"spread_mean_{name}") - over.lag(F.col(f"spread_mean_{name}"))))
        s.add(f"ticks_change_{name}", zero(F.col(f"ticks_mean_{name}") - over.lag(F.col(f"ticks_mean_{name}"))))
        if name in TREND:
            s.add(f"trend_strength_{name}", div(F.col(f"trend_slope_{name}"), F.col(f"rv_{name}")))
        if name in MEAN_REVERSION:
            s.add(f"mean_reversion_halflife_{name}", K.ar1_halflife(F.col(f"ar1_phi_{name}")))
        if name in CROSS:
            s.add(f"corr_ret1_rvS_{name}", over.corr(r, F.col("rv_S"), w))
            s.add(f"corr_rvS_spread_{name}", over.corr(F.col("rv_S"), spread, w))
            s.add(f"rv_change_{name}", zero(F.col(f"rv_{name}") - over.lag(F.col(f"rv_{name}"), w)))
    s.next()

    long_zscores(s, over, [(name, rows) for name, _, rows, z, pct in catalogue(config) if z or pct])
    for name, _, _, z, pct in catalogue(config):
        if z:
            s.add(f"{name}_z", zero(F.col(f"_z_{name}")))
        if pct:
            s.add(f"{name}_pct", K.pct_from_z(F.col(f"_z_{name}")))
    s.next()

    out = own_rows(s.df)
    if drop_first:
        out = out.where(F.col("row_id") >= max(wins.values()))
    times = {"start_time", "end_time"}
    return out.select(*KEYS, *[F.col(c) if c in times else finite(F.col(c)).alias(c) for c in feature_names(config)])
