"""Chronological splits: by time with an embargo, or by rows; checks and the manifest's figures."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import SplitConfig
from .layout import CELL_ROWS, numbered

ORDER = ("train", "val", "test")


def time_column(df: DataFrame) -> str:
    for c in ("end_time", "start_time"):
        if c in df.columns:
            return c
    raise ValueError(f"neither end_time nor start_time among {df.columns}")


def date_filter(df: DataFrame, start: str | None, end: str | None, column: str | None = None) -> DataFrame:
    """Rows with a time in [start, end). The column keeps its type, so the bounds reach the Parquet scan."""
    column = column or time_column(df)
    kind = dict(df.dtypes)[column]
    out = df.where(F.col(column).isNotNull())
    if start:
        out = out.where(F.col(column) >= F.lit(start).cast(kind))
    if end:
        out = out.where(F.col(column) < F.lit(end).cast(kind))
    return out


def monotonic_violations(df: DataFrame, rows: int | None = None, column: str | None = None) -> DataFrame:
    """series_id, violations: rows, in the order of row_id, whose time is before their predecessor's."""
    column = column or time_column(df)
    head = df if rows is None else df.where(F.col("row_id") < F.lit(rows))
    head = head.select("series_id", "row_id", F.col(column).alias("_t"), F.floor(F.col("row_id") / CELL_ROWS).alias("_cell"))
    # within cells by a window each, between them by their first and last rows
    before = F.lag("_t").over(Window.partitionBy("series_id", "_cell").orderBy("row_id"))
    cells = head.withColumn("_bad", F.coalesce((F.col("_t") < before).cast("long"), F.lit(0))).groupBy("series_id", "_cell")
    cells = cells.agg(F.sum("_bad").alias("_bad"), F.min_by("_t", "row_id").alias("_first"), F.max_by("_t", "row_id").alias("_last"))
    back = F.col("_first") < F.lag("_last").over(Window.partitionBy("series_id").orderBy("_cell"))
    cells = cells.withColumn("_bad", F.col("_bad") + F.coalesce(back.cast("long"), F.lit(0)))
    return cells.groupBy("series_id").agg(F.sum("_bad").alias("violations"))


def check_monotonic(df: DataFrame, rows: int | None = None) -> None:
    bad = monotonic_violations(df, rows).where("violations > 0").limit(1).collect()
    if bad:
        raise ValueError(f"times go back {bad[0].violations} times in series {bad[0].series_id}")


def _micros(column: str):
    return F.unix_micros(F.col(column).cast("timestamp"))


def time_cuts(df: DataFrame, config: SplitConfig) -> tuple[int, int]:
    """The two cuts in microseconds, from one aggregation."""
    low, high = df.agg(F.min(_micros(time_column(df))), F.max(_micros(time_column(df)))).first()
    if low is None or high <= low:
        raise ValueError("the rows span no time")
    return low + int((high - low) * config.train), low + int((high - low) * (config.train + config.val))


def time_split(df: DataFrame, config: SplitConfig) -> DataFrame:
    """Adds split: train before the first cut, val up to the second, test from there; rows within the embargo of a cut go."""
    first, second = time_cuts(df, config)
    e, t = config.embargo_us, _micros(time_column(df))
    split = F.when(t < first - e, "train").when((t >= first + e) & (t < second - e), "val").when(t >= second + e, "test")
    return df.withColumn("split", split).where(F.col("split").isNotNull())


def row_split(df: DataFrame, config: SplitConfig) -> DataFrame:
    """Adds split by the place of a row in its series: floor(n * train), floor(n * val), the rest."""
    sizes = df.groupBy("series_id").agg(F.count(F.lit(1)).alias("_n"), F.min("row_id").alias("_first"), F.max("row_id").alias("_last"))
    joined = df.join(F.broadcast(sizes) if sizes.limit(10_001).count() <= 10_000 else sizes, "series_id")
    dense = sizes.where(F.col("_last") - F.col("_first") + 1 != F.col("_n")).limit(1).count() == 0
    if not dense:
        joined = numbered(joined, ["series_id"], F.floor(F.col("row_id") / CELL_ROWS), ["row_id"], "_place")
    place = F.col("row_id") - F.col("_first") if dense else F.col("_place")
    train, val = F.floor(F.col("_n") * F.lit(config.train)), F.floor(F.col("_n") * F.lit(config.val))
    split = F.when(place < train, "train").when(place < train + val, "val").otherwise("test")
    return joined.withColumn("split", split).drop("_n", "_first", "_last", "_place")


def boundary_drop(df: DataFrame, k: int) -> DataFrame:
    """Without the last k rows of train and of val of each series."""
    if k == 0:
        return df
    back = numbered(df, ["series_id", "split"], -F.floor(F.col("row_id") / CELL_ROWS), [F.col("row_id").desc()], "_back")
    return back.where((F.col("split") == "test") | (F.col("_back") >= k)).drop("_back")


def split(df: DataFrame, config: SplitConfig) -> DataFrame:
    if config.monotonic_check:
        check_monotonic(df, config.monotonic_rows)
    own = date_filter(df, config.start, config.end)
    out = time_split(own, config) if config.mode == "time" else row_split(own, config)
    return boundary_drop(out, config.boundary_drop)


def split_info(df: DataFrame) -> DataFrame:
    """split, rows, time_min, time_max: one aggregation for all splits."""
    c = time_column(df)
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("rows"), F.min(c).alias("time_min"), F.max(c).alias("time_max"))


def check_splits(info: list) -> None:
    """All three have rows, and each ends before the next begins."""
    by = {r["split"]: r for r in info}
    empty = [s for s in ORDER if s not in by or not by[s]["rows"]]
    if empty:
        raise ValueError(f"empty splits: {empty}")
    for a, b in zip(ORDER, ORDER[1:]):
        if by[a]["time_max"] >= by[b]["time_min"]:
            raise ValueError(f"{a} ends at {by[a]['time_max']}, {b} begins at {by[b]['time_min']}")


def manifest(info: list, config: SplitConfig, source: dict, column: str, paths: dict[str, str]) -> dict:
    return {
        "version": "3.0", "features_source_path": source.get("path"), "input_fingerprint": source, "time_col": column, "date_filter": [config.start, config.end], "split_mode": config.mode,
        "embargo_duration": config.embargo, "boundary_drop": config.boundary_drop, "monotonic_check": config.monotonic_check, "portions": {"train": config.train, "val": config.val, "test": 1 - config.train - config.val},
        "paths": paths, "splits": {r["split"]: {"rows": r["rows"], "time_min": str(r["time_min"]), "time_max": str(r["time_max"])} for r in info},
    }


def epoch(us: int) -> datetime:
    return datetime(1970, 1, 1) + timedelta(microseconds=us)
