"""Ticks to bars of a fixed number of ticks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .layout import row_index

BAR_COLUMNS = "start_time end_time open high low close bid_open bid_high bid_low bid_close ask_open ask_high ask_low ask_close spread_mean ticks".split()


def mid(bid: Column, ask: Column) -> Column:
    return (bid + ask) / F.lit(2.0)


def number_ticks(quotes: DataFrame) -> DataFrame:
    """series_id, tick_id, time, bid, ask, mid: ticks of a series in the order of time, bid, ask. One series if none is named."""
    if "series_id" not in quotes.columns:
        quotes = quotes.withColumn("series_id", F.lit("S"))
    ticks = row_index(quotes.select("series_id", "time", "bid", "ask"), ["time", "bid", "ask"], out="tick_id")
    return ticks.withColumn("mid", mid(F.col("bid"), F.col("ask")))


def bar_key(tick_id: Column, size: int) -> Column:
    return F.floor(tick_id / F.lit(float(size))).cast("long")


def aggregate_bars(ticks: DataFrame, size: int) -> DataFrame:
    """series_id, row_id (the bar's number) and the 16 bar columns; the last bar of a series may be short.

    One aggregation with a map-side combine: firsts and lasts are taken by tick_id, so nothing is sorted.
    """
    if size < 1:
        raise ValueError("a bar has one tick at least")
    keyed = ticks.withColumn("row_id", bar_key(F.col("tick_id"), size))
    prices = []
    for source, prefix in (("mid", ""), ("bid", "bid_"), ("ask", "ask_")):
        prices += [
            F.min_by(source, "tick_id").alias(f"{prefix}open"), F.max(source).alias(f"{prefix}high"), F.min(source).alias(f"{prefix}low"), F.max_by(source, "tick_id").alias(f"{prefix}close"),
        ]
    out = keyed.groupBy("series_id", "row_id").agg(
        F.min("time").alias("start_time"), F.max("time").alias("end_time"), *prices, F.avg(F.col("ask") - F.col("bid")).alias("spread_mean"), F.count(F.lit(1)).alias("ticks")
    )
    return out.select("series_id", "row_id", *BAR_COLUMNS)


def tick_bars(quotes: DataFrame, size: int = 200) -> DataFrame:
    return aggregate_bars(number_ticks(quotes), size)


def duration_ms() -> Column:
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    return (micros("end_time") - micros("start_time")).cast("double") / F.lit(1000.0)
