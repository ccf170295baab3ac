"""Forward-looking labels: net return after H bars, a two-sided triple barrier with costs, weights, and greedy purging.

Values that are undefined are null; validity flags are the contract. Row numbers of a series must be dense from 0
(reindex() makes them so, after a split). Windows run over blocks with halos, so a series may have any length.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import LabelConfig
from ..functions.kernels import Over
from ..functions.safe import clip, div, finite, lit, ln, zero
from .bars import duration_ms as bar_duration
from .layout import BLOCK, flag, own_rows, row_index, with_halo
from .quotes import require

NEEDED = "start_time end_time open high low close bid_open bid_close ask_open ask_close spread_mean ticks".split()
LABELS = (
    "vol_target atr atr_ret t1_timeout_index t1_timeout_time y_ret_net_h y_up_h cost_bps_h sample_weight_h is_valid_label_h "
    "t1_tb_index t1_tb_time barrier_touch_tb side_tb y_ret_net_tb y_meta_execute_tb cost_bps_tb sample_weight_tb is_valid_label_tb"
).split()


#: Row numbers of a block of the purge.
PURGE_ROWS = 1 << 15


def reindex(df: DataFrame) -> DataFrame:
    return row_index(df.withColumnRenamed("row_id", "_old"), ["_old"]).drop("_old")


def log_return(over: Over) -> Column:
    """ln of the close over the previous one; 0 for the first row."""
    now = ln(F.col("close"))
    first = F.lag(F.lit(1)).over(over.all).isNull()
    return F.when(first, lit(0)).otherwise(now - over.lag(now))


def true_range(over: Over) -> Column:
    """max(high - low, |high - previous close|, |low - previous close|); null for the first row."""
    before = over.lag(F.col("close"))
    h, low = F.col("high"), F.col("low")
    tr = F.greatest(h - low, F.abs(h - before), F.abs(low - before))
    return F.when(before.isNotNull() & h.isNotNull() & low.isNotNull() & (tr >= 0), tr)


def ewm(df: DataFrame, value: str, rows: int, out: str) -> DataFrame:
    """out: v = alpha x + (1 - alpha) v, alpha = 2 / (rows + 1), begun with the first non-null x; null where x is.

    A running sum of x / (1 - alpha)^k, k counting the values of a block, scaled back at each row: linear, and without
    cancellation for values of one sign. A block's halo is so long that what came before it weighs less than 1e-16, and a
    block so short that no power overflows.
    """
    alpha = 2.0 / (rows + 1.0)
    decay = -math.log1p(-alpha)
    halo, block = math.ceil(37 / decay), max(1, math.floor(300 / decay))
    over = Over(BLOCK)
    running = over.all.rowsBetween(Window.unboundedPreceding, 0)
    laid = with_halo(df, block, before=halo)
    laid = laid.withColumn("_k", F.when(F.col(value).isNotNull(), F.count(value).over(running)))
    weight = F.when(F.col("_k") == 1, lit(1)).otherwise(lit(alpha))
    laid = laid.withColumn("_t", F.col(value) * weight * F.exp(F.col("_k") * lit(decay)))
    laid = laid.withColumn(out, F.when(F.col("_k").isNotNull(), F.sum("_t").over(running) * F.exp(F.col("_k") * lit(-decay))))
    return own_rows(laid).drop("_k", "_t")


def slippage_bps(spread_bps: Column, ticks: Column, duration: Column, config: LabelConfig) -> Column:
    speed = F.greatest(ticks / F.greatest(duration, lit(1)), lit(0))
    return F.greatest(lit(config.slippage_k) * spread_bps * F.pow(lit(1) + speed, lit(config.slippage_pow)), lit(0))


def cost_bps(entry: Column, spread: Column, ticks: Column, duration: Column, config: LabelConfig) -> Column:
    spread_bps = lit(1e4) * (spread / F.greatest(entry, lit(1e-12)))
    one_way = lit(config.cost_k) * spread_bps + slippage_bps(spread_bps, ticks, duration, config)
    whole = lit(2 if config.roundtrip else 1) * one_way
    return F.when(entry.isNotNull() & spread.isNotNull() & ticks.isNotNull(), clip(whole, config.min_cost_bps, config.max_cost_bps))


def volatility(df: DataFrame, config: LabelConfig) -> DataFrame:
    """vol_target of _r, returns clipped to +-vol_ret_clip: EWM of squares, or a population deviation."""
    df = df.withColumn("_rc", clip(F.col("_r"), -config.vol_ret_clip, config.vol_ret_clip))
    if config.vol_mode == "ewm":
        out = ewm(df.withColumn("_r2", F.col("_rc") * F.col("_rc")), "_r2", config.vol_window, "_v")
        return out.withColumn("vol_target", F.sqrt("_v")).drop("_rc", "_r2", "_v")
    laid = with_halo(df, config.block_rows, before=config.vol_window)
    return own_rows(laid.withColumn("vol_target", Over(BLOCK).std_pop(F.col("_rc"), config.vol_window))).drop("_rc")


def atr(df: DataFrame, config: LabelConfig) -> DataFrame:
    """atr of _tr: EWM, or the mean of the values of a frame of rows, from row atr_window - 1 on."""
    if config.atr_mode == "ewm":
        return ewm(df, "_tr", config.atr_window, "atr")
    laid = with_halo(df, config.block_rows, before=config.atr_window)
    mean = F.avg("_tr").over(Over(BLOCK).back(config.atr_window))
    return own_rows(laid.withColumn("atr", F.when(F.col("row_id") >= config.atr_window - 1, mean)))


def prepared(bars: DataFrame, config: LabelConfig) -> DataFrame:
    """The bars' columns that labels need, with _r, _tr, vol_target and atr."""
    require(bars, ["series_id", "row_id", *NEEDED])
    duration = finite(F.col("duration_ms").cast("double")) if "duration_ms" in bars.columns else bar_duration()
    prices = [c for c in NEEDED if not c.endswith("_time")]
    slim = bars.select("series_id", "row_id", "start_time", "end_time", *[finite(F.col(c).cast("double")).alias(c) for c in prices], duration.alias("_duration"))
    over = Over(BLOCK)
    laid = with_halo(slim, config.block_rows, before=1)
    first = own_rows(laid.withColumns({"_r": log_return(over), "_tr": true_range(over)}))
    return atr(volatility(first, config), config)


def _lead(x: Column, k: int) -> Column:
    return F.lead(x, k).over(Over(BLOCK).all)


def label_rows(df: DataFrame, config: LabelConfig) -> DataFrame:
    """All labels but weights. df: from prepared()."""
    h, over = config.horizon, Over(BLOCK)
    laid = with_halo(df, config.block_rows, after=h + 1)
    laid = laid.withColumn("_ex", (F.col("bid_close") + F.col("ask_close")) / lit(2))
    ahead = over.all.rowsBetween(1, h)
    bar = F.struct("row_id", "high", "low", "close", F.col("_ex").alias("ex"), "end_time")
    laid = laid.withColumns(
        {"_entry": (_lead(F.col("bid_open"), 1) + _lead(F.col("ask_open"), 1)) / lit(2), "_ahead": F.collect_list(bar).over(ahead), "_full": _lead(F.col("row_id"), h).isNotNull()}
    )
    own = own_rows(laid)
    entry = F.col("_entry")
    own = own.withColumns(
        {
            "atr_ret": F.when(entry > 0, div(F.col("atr"), entry)),
            "cost_bps_h": cost_bps(entry, F.col("spread_mean"), F.col("ticks"), F.col("_duration"), config),
            "_end": F.try_element_at("_ahead", F.lit(-1)),
        }
    )
    ex = F.when(F.col("_end").isNull(), F.col("_ex")).otherwise(F.col("_end.ex"))
    ret = F.when((entry > 0) & (ex > 0), (ex - entry) / entry - F.col("cost_bps_h") / lit(1e4))
    own = own.withColumn("t1_timeout_index", F.coalesce(F.col("_end.row_id"), F.col("row_id"))).withColumn("y_ret_net_h", ret)
    own = own.withColumns({"y_up_h": up_down(F.col("y_ret_net_h")), "is_valid_label_h": flag(F.col("y_ret_net_h").isNotNull() & F.col("_full"))})
    return barrier(own, config)


def up_down(ret: Column) -> Column:
    return F.when(ret > 0, 1).when(ret <= 0, 0).otherwise(-1).cast("byte")


def barrier(df: DataFrame, config: LabelConfig) -> DataFrame:
    """The first bar ahead that touches a level of either side decides; none, the horizon's end."""
    entry = F.col("_entry")
    v = F.greatest(F.col("atr_ret"), lit(config.min_vol))
    begun = flag((entry > 0) & F.col("atr_ret").isNotNull() & (F.size("_ahead") > 0))
    df = df.withColumn("cost_bps_tb", F.when(begun, F.col("cost_bps_h")))
    pt, sl = lit(config.pt_mult) * v, lit(config.sl_mult) * v
    worth = begun & flag(lit(1e4) * pt >= lit(config.min_move_cost_mult) * F.col("cost_bps_tb") + lit(config.min_move_buffer_bps))
    df = df.withColumns({"_pt": pt, "_sl": sl, "_worth": worth})

    def sides(b: Column) -> dict[str, Column]:
        up, down = b["high"] / F.col("_entry") - lit(1), b["low"] / F.col("_entry") - lit(1)
        under = F.try_divide(F.col("_entry"), b["low"]) - lit(1)
        return {"long_pt": up >= F.col("_pt"), "long_sl": down <= -F.col("_sl"), "short_pt": under >= F.col("_pt"), "short_sl": up >= F.col("_sl")}

    def touched(b: Column) -> Column:
        s = sides(b)
        return flag(s["long_pt"] | s["long_sl"] | s["short_pt"] | s["short_sl"])

    df = df.withColumn("_hit", F.when(F.col("_worth"), F.try_element_at(F.filter("_ahead", touched), F.lit(1))))
    s = {k: flag(c) for k, c in sides(F.col("_hit")).items()}
    long, short = s["long_pt"] | s["long_sl"], s["short_pt"] | s["short_sl"]
    hit = F.col("_hit").isNotNull()
    if config.tie_break == "best_case":
        tie_side, tie_type = F.lit(1), F.lit(1)
    elif config.tie_break == "close_based":
        good = flag(F.col("_hit.close") > 0)
        tie_side = F.when(~good, 0).when(F.col("_hit.close") >= entry, 1).otherwise(-1)
        tie_type = F.when(good, 1).otherwise(-1)
    else:
        tie_side, tie_type = F.lit(0), F.lit(-1)
    side = F.when(~hit, 0).when(long & ~short, 1).when(short & ~long, -1).otherwise(tie_side)
    kind = F.when(~hit, 0).when(long & ~short, F.when(s["long_pt"], 1).otherwise(-1)).when(short & ~long, F.when(s["short_pt"], 1).otherwise(-1)).otherwise(tie_type)
    at = F.when(hit, F.col("_hit")).otherwise(F.col("_end"))
    df = df.withColumns({"_side": side, "_kind": kind, "_at": at})
    ok = flag(F.col("_worth") & (F.col("_at.ex") > 0))
    move = (F.col("_at.ex") - entry) / entry
    gross = F.when(F.col("_side") == 1, move).when(F.col("_side") == -1, -move).otherwise(F.abs(move))
    net = clip(gross - F.col("cost_bps_tb") / lit(1e4), -config.ret_clip, config.ret_clip)
    df = df.withColumns(
        {
            "t1_tb_index": F.when(ok, F.col("_at.row_id")).otherwise(F.lit(-1).cast("long")),
            "barrier_touch_tb": F.when(ok, F.col("_kind")).otherwise(0).cast("byte"),
            "side_tb": F.when(ok, F.col("_side")).otherwise(0).cast("byte"),
            "y_ret_net_tb": F.when(ok, net),
            "is_valid_label_tb": flag(ok & F.col("_full") & net.isNotNull()),
        }
    )
    return df.withColumns({"_end_time": F.col("_end.end_time"), "_tb_time": F.col("_at.end_time")}).drop("_hit", "_at", "_ahead", "_end", "_side", "_kind", "_worth", "_pt", "_sl", "_ex")


def purge(df: DataFrame, t1: str, valid: str, embargo: int, out: str, reach: int | None = None, block_rows: int = PURGE_ROWS) -> DataFrame:
    """series_id, row_id, out: of the valid rows, those that a greedy pass keeps: each begins after the end of the last one kept
    plus the embargo, and ends after it begins. Rows without an end aren't kept.

    The pass depends on what is before a row only through the end of the last row kept. So a block of block_rows row numbers
    first says where a pass ends that enters it at any row, all blocks at once; a series' blocks are then walked by these
    steps, which tells each block how it is entered; and the blocks mark their rows, all at once again. reach: no row ends more
    than so many rows on (an error if one does); a block then has about reach + embargo steps, else at most a step a row.
    """
    ends = F.col(t1).cast("long")
    slim = df.select("series_id", F.col("row_id").cast("long").alias("row_id"), ends.alias("t1"), F.floor(F.col("row_id") / block_rows).cast("long").alias("_block"), F.col(valid).alias("valid"))
    dealt = slim.where("valid").drop("valid").repartition("series_id", "_block")  # both readings share this exchange

    def steps(key: tuple, block: pa.Table) -> pa.Table:
        rows, ends, after = _purge_chain(block, embargo)
        if reach is not None and (ends - rows > reach).any():
            raise ValueError(f"a row of series {key[0].as_py()} ends more than {reach} rows on")
        last = np.where(after < len(rows), after, np.arange(len(rows)))
        while len(last) and (last[last] != last).any():
            last = last[last]
        exits = ends[last]
        if reach is not None:
            some = 1 + np.searchsorted(rows, key[1].as_py() * block_rows - 1 + reach + embargo, "right")
            rows, exits = rows[:some], exits[:some]
        ends_run = np.append(exits[1:] != exits[:-1], True)[: len(exits)]  # entries in a row with one exit are one step
        rows, exits = rows[ends_run], exits[ends_run]
        return pa.table({"series_id": pa.array([key[0].as_py()] * len(rows), pa.string()), "_block": pa.array([key[1].as_py()] * len(rows), pa.int64()), "upto": rows, "exit": exits})

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, last, entered = None, -1, False
        for batch in batches:
            found = []
            for series, block, upto, exit_ in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if at is None or series != at[0]:
                    last = -1
                if (series, block) != at:
                    at, entered = (series, block), False
                    found.append((series, block, last))
                if not entered and upto > last + embargo:
                    last, entered = exit_, True
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], k) for i, k in enumerate((pa.string(), pa.int64(), pa.int64()))], ["series_id", "_block", "last"])

    def mark(block: pa.Table, entry: pa.Table) -> pa.Table:
        rows, _, after = _purge_chain(block, embargo)
        kept = []
        if len(rows):
            i = int(np.searchsorted(rows, entry.column("last")[0].as_py() + embargo, "right"))
            while i < len(rows):
                kept.append(rows[i])
                i = int(after[i])
        marks = np.isin(block.column("row_id").to_numpy(), np.array(kept, np.int64))
        return pa.table({"series_id": block.column("series_id"), "row_id": block.column("row_id"), out: marks})

    found = dealt.groupBy("series_id", "_block").applyInArrow(steps, "series_id string, _block long, upto long, exit long")
    entries = found.repartition("series_id").sortWithinPartitions("series_id", "_block", "upto").mapInArrow(walk, "series_id string, _block long, last long")
    pairs = dealt.groupBy("series_id", "_block").cogroup(entries.groupBy("series_id", "_block"))
    return pairs.applyInArrow(mark, f"series_id string, row_id long, {out} boolean")


def _purge_chain(block: pa.Table, embargo: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers and ends of the rows that a pass may keep, in order, and the place of the row that it would keep next after each."""
    rows, ends = block.column("row_id").to_numpy(), block.column("t1").fill_null(-1).to_numpy()
    order = np.argsort(rows, kind="stable")
    rows, ends = rows[order], ends[order]
    rows, ends = rows[ends > rows], ends[ends > rows]
    return rows, ends, np.searchsorted(rows, ends + embargo, "right")


def uniqueness(df: DataFrame, t1: str, valid: str, out: str, config: LabelConfig) -> DataFrame:
    """out: the mean of 1 / concurrency over [row_id, t1] of valid rows, else 0. A row's concurrency is the number of valid
    labels that span it, at least 1; labels span the horizon at most, so frames of that length see all of them."""
    h, over = config.horizon, Over(BLOCK)
    laid = with_halo(df, config.block_rows, before=h, after=h)
    spans = F.collect_list(F.when(F.col(valid), F.col(t1)).otherwise(F.lit(-1))).over(over.all.rowsBetween(-h, 0))
    laid = laid.withColumn("_open", spans)
    laid = laid.withColumn("_share", lit(1) / F.greatest(F.size(F.filter("_open", lambda t: t >= F.col("row_id"))), F.lit(1)))
    laid = laid.withColumn("_shares", F.collect_list("_share").over(over.all.rowsBetween(0, h)))
    n = (F.col(t1) - F.col("row_id") + 1).cast("int")
    total = F.aggregate(F.slice("_shares", F.lit(1), F.greatest(n, F.lit(1))), lit(0), lambda a, x: a + x)
    return own_rows(laid.withColumn(out, F.when(F.col(valid), total / n).otherwise(lit(0))).drop("_open", "_share", "_shares"))


def sample_weight(unique: Column, ret: Column, scale: Column, cap: float) -> Column:
    usable = F.when(scale > 0, scale)
    return unique * clip(zero(F.abs(ret) / (usable + lit(1e-12))), 0, cap)


def label(bars: DataFrame, config: LabelConfig, check: bool = True) -> DataFrame:
    """bars' columns and LABELS, for rows numbered densely from 0 within a series."""
    if check:
        short = bars.groupBy("series_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") < config.least_rows).limit(1).collect()
        if short:
            raise ValueError(f"series {short[0].series_id} has {short[0].n} rows, labels need {config.least_rows}")
    rows = label_rows(prepared(bars, config), config)
    if config.purge:
        for t1, valid in (("t1_timeout_index", "is_valid_label_h"), ("t1_tb_index", "is_valid_label_tb")):
            kept = purge(rows, t1, valid, config.purge_embargo, "_kept", reach=config.horizon)
            rows = rows.join(kept, ["series_id", "row_id"], "left").withColumn(valid, flag(F.col("_kept"))).drop("_kept")
    rows = uniqueness(rows, "t1_timeout_index", "is_valid_label_h", "_uniq_h", config)
    rows = uniqueness(rows, "t1_tb_index", "is_valid_label_tb", "_uniq_tb", config)
    rows = rows.withColumns(
        {
            "sample_weight_h": sample_weight(F.col("_uniq_h"), F.col("y_ret_net_h"), F.col("vol_target"), config.weight_cap),
            "sample_weight_tb": sample_weight(F.col("_uniq_tb"), F.col("y_ret_net_tb"), F.col("atr_ret"), config.weight_cap),
            "y_meta_execute_tb": F.when(F.col("is_valid_label_tb") & (F.col("y_ret_net_tb") > 0), 1).otherwise(0).cast("byte"),
            "t1_timeout_time": F.when(F.col("is_valid_label_h"), F.col("_end_time")),
            "t1_tb_time": F.when(F.col("is_valid_label_tb"), F.col("_tb_time")),
        }
    )
    own = rows.select("series_id", "row_id", *LABELS)
    kept = [c for c in bars.columns if c not in LABELS]
    return bars.select(*kept).join(own, ["series_id", "row_id"])


def label_stats(labelled: DataFrame) -> DataFrame:
    """One row: counts, means, deviations, nearest quantiles, hit and trade rates; a stat of no valid rows is null."""
    from .layout import nearest_quantiles

    h, tb = F.col("is_valid_label_h"), F.col("is_valid_label_tb")
    mean = lambda ok, x: F.avg(F.when(ok, x.cast("double")))
    col = F.col
    out = labelled.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(h).alias("H_valid_rows"), mean(h, col("y_ret_net_h")).alias("H_ret_mean"), F.stddev_samp(F.when(h, col("y_ret_net_h"))).alias("H_ret_std"),
        mean(h, col("y_ret_net_h") > 0).alias("H_hit_rate"), mean(h, col("cost_bps_h")).alias("H_cost_bps_mean"), mean(h, col("sample_weight_h")).alias("H_w_mean"),
        F.count_if(tb).alias("TB_valid_rows"), mean(tb, col("y_ret_net_tb")).alias("TB_ret_mean"), F.stddev_samp(F.when(tb, col("y_ret_net_tb"))).alias("TB_ret_std"),
        mean(tb, col("y_ret_net_tb") > 0).alias("TB_hit_rate"), mean(tb, col("cost_bps_tb")).alias("TB_cost_bps_mean"), mean(tb, col("sample_weight_tb")).alias("TB_w_mean"),
        F.count_if(tb & (col("side_tb") != 0)).alias("TB_trades"), mean(tb, col("y_meta_execute_tb")).alias("TB_meta_execute_rate"),
        *[mean(tb, col("barrier_touch_tb") == v).alias(f"TB_{n}_rate") for n, v in (("tp", 1), ("sl", -1), ("timeout", 0))],
    )
    out = out.withColumn("TB_trade_rate", F.col("TB_trades") / F.greatest(F.col("rows"), F.lit(1)))
    asked = {"H_ret": F.when(h, col("y_ret_net_h")), "H_cost_bps": F.when(h, col("cost_bps_h")), "TB_ret": F.when(tb, col("y_ret_net_tb")), "TB_cost_bps": F.when(tb, col("cost_bps_tb"))}
    q = nearest_quantiles(labelled.select(*[c.alias(n) for n, c in asked.items()]), list(asked), [0.5, 0.95])
    wanted = [(n, 0.5 if n.endswith("ret") else 0.95) for n in asked]
    points = q.agg(*[F.max(F.when((F.col("column") == n) & (F.col("share") == s), F.col("value"))).alias(f"{n}_p{round(s * 100)}") for n, s in wanted])
    return out.crossJoin(F.broadcast(points))  # a row by a row
