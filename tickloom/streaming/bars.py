"""Tick bars over arriving quotes: an incomplete last bar is carried from batch to batch, a series by a key of its own.

Quotes of a series must arrive in the order of time, as the batch reader's input does; within a micro-batch they are sorted.
The state of a series is its open bar, whatever the stream's length.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.bars import BAR_COLUMNS

PRICES = [c for c in BAR_COLUMNS if c not in ("start_time", "end_time", "spread_mean", "ticks")]
OUT = "series_id string, row_id long, start_time timestamp, end_time timestamp, " + ", ".join(f"{c} double" for c in PRICES) + ", spread_mean double, ticks long"
#: The open bar: its number, its ticks so far, and the columns as they stand (spread_mean as a sum).
STATE = "row_id long, ticks long, start_us long, end_us long, spread double, " + ", ".join(f"{c} double" for c in PRICES)


def _merged(a: dict | None, b: dict) -> dict:
    """One open bar from an earlier and a later part."""
    if a is None or not a["ticks"]:
        return b
    out = {"ticks": a["ticks"] + b["ticks"], "start_us": a["start_us"], "end_us": b["end_us"], "spread": a["spread"] + b["spread"]}
    for c in PRICES:
        kind = c.rsplit("_", 1)[-1]
        out[c] = {"open": lambda x, y: x, "high": max, "low": min, "close": lambda x, y: y}[kind](a[c], b[c])
    return out


def _part(rows: pd.DataFrame) -> dict:
    out = {"ticks": len(rows), "start_us": int(rows["us"].iloc[0]), "end_us": int(rows["us"].iloc[-1]), "spread": float((rows["ask"] - rows["bid"]).sum())}
    for source, prefix in (("mid", ""), ("bid", "bid_"), ("ask", "ask_")):
        v = rows[source]
        out |= {f"{prefix}open": float(v.iloc[0]), f"{prefix}high": float(v.max()), f"{prefix}low": float(v.min()), f"{prefix}close": float(v.iloc[-1])}
    return out


def _update(size: int):
    names = [x.strip().split(" ")[0] for x in STATE.split(",")]

    def update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = dict(zip(names, state.get)) if state.exists else {"row_id": 0, "ticks": 0}
        number, bar = now.pop("row_id"), now if now["ticks"] else None
        rows = pd.concat(batches).sort_values(["us", "bid", "ask"], kind="stable").reset_index(drop=True)
        rows["mid"] = (rows["bid"] + rows["ask"]) / 2
        done, at = [], 0
        while at < len(rows):
            take = min(size - (bar["ticks"] if bar else 0), len(rows) - at)
            bar = _merged(bar, _part(rows.iloc[at : at + take]))
            at += take
            if bar["ticks"] == size:
                stamp = lambda us: pd.Timestamp(us, unit="us")
                done.append({"series_id": key[0], "row_id": number, "start_time": stamp(bar["start_us"]), "end_time": stamp(bar["end_us"]), **{c: bar[c] for c in PRICES}, "spread_mean": bar["spread"] / size, "ticks": size})
                number, bar = number + 1, None
        held = bar or {"ticks": 0, "start_us": 0, "end_us": 0, "spread": 0.0, **dict.fromkeys(PRICES, 0.0)}
        state.update(tuple([number, *[held[n] for n in names[1:]]]))
        yield pd.DataFrame(done, columns=["series_id", "row_id", *BAR_COLUMNS])

    return update


def stream_tick_bars(quotes: DataFrame, size: int = 200) -> DataFrame:
    """A streaming DataFrame of complete bars, for quotes with series_id, time, bid, ask."""
    if size < 1:
        raise ValueError("a bar has one tick at least")
    rows = quotes.select("series_id", F.unix_micros(F.col("time").cast("timestamp")).alias("us"), F.col("bid").cast("double").alias("bid"), F.col("ask").cast("double").alias("ask"))
    return rows.groupBy("series_id").applyInPandasWithState(_update(size), OUT, STATE, "append", GroupStateTimeout.NoTimeout)
