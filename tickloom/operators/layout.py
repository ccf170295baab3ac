"""Row numbers and windows for series of any length: no step puts a whole series into one task."""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a cell of row numbering, about; cells at most.
CELL_ROWS, CELLS = 200_000, 1 << 16


def numbered(df: DataFrame, keys: list[str], cell: Column, by: list, out: str) -> DataFrame:
    """out: 0, 1, ... within equal keys, in the order of `by`, which `cell` follows. Cells are counted (a map-side combine), their
    starts come from a window over the small table of cells, and only the rows of one cell are numbered in one task."""
    dealt = df.withColumn("_cell", cell)
    counts = dealt.groupBy(*keys, "_cell").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate([*keys, "_cell"])], F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    same = [dealt[k].eqNullSafe(starts[f"_k{i}"]) for i, k in enumerate([*keys, "_cell"])]
    joined = dealt.join(starts, reduce(lambda a, b: a & b, same))
    within = F.row_number().over(Window.partitionBy(*keys, "_cell").orderBy(*by)) - 1
    return joined.withColumn(out, (F.col("_start") + within).cast("long")).drop("_cell", "_start", *[f"_k{i}" for i in range(len(keys) + 1)])


def _cell_of(value: Column, cuts: list) -> Column:
    """How many of the ascending cuts aren't above the value, by two searches over about a root of them each."""
    step = math.isqrt(len(cuts)) + 1
    upto = lambda some: F.size(F.filter(some, lambda c: c <= value))
    coarse = upto(F.lit(np.array(cuts[::step])))
    fine = upto(F.slice(F.lit(np.array(cuts)), F.greatest(coarse - 1, F.lit(0)) * step + 1, F.lit(step)))
    return F.when(coarse == 0, F.lit(0)).otherwise((coarse - 1) * step + fine)


def row_index(df: DataFrame, by: list[str], series: str = "series_id", out: str = "row_id", cell_rows: int = CELL_ROWS) -> DataFrame:
    """out: 0, 1, ... within a series, in the order of `by`, whose first column is a time or a number and leads the order.

    The values of that column are cut at quantiles into cells, as many as the rows ask for; a cell's rows are numbered by a
    window of its own and moved up by the rows of the series' earlier cells. Nulls come first. The first column's equal values
    share a cell.
    """
    lead = F.col(by[0])
    kind = dict(df.dtypes)[by[0]]
    number = F.unix_micros(lead.cast("timestamp")) if kind.startswith("timestamp") else lead.cast("double")
    wanted = min(CELLS, -(-df.count() // cell_rows))
    cuts = []
    if wanted > 1:
        shares = F.lit(np.arange(1, wanted) / wanted)
        cuts = sorted(set(df.agg(F.percentile_approx(number, shares, max(10_000, 10 * wanted))).first()[0] or []))
    if not cuts:
        return df.withColumn(out, (F.row_number().over(Window.partitionBy(series).orderBy(*by)) - 1).cast("long"))
    return numbered(df, [series], F.when(number.isNull(), F.lit(-1)).otherwise(_cell_of(number, cuts)), by, out)


def with_halo(df: DataFrame, block_rows: int | None, before: int = 0, after: int = 0, spread: bool = False) -> DataFrame:
    """_block and _own: each row in its block, and as a guest (_own false) in the blocks whose frames reach it. spread: deal the
    blocks to all shuffle partitions, however small they are, for windows that cost far more than their bytes suggest.

    Windows partitioned by (series_id, _block) then see `before` rows before and `after` rows behind each own row. Drop the
    guests with own_rows(). Copies are (before + after) / block_rows of the rows.
    """
    if block_rows is None:
        return df.withColumn("_block", F.lit(0).cast("long")).withColumn("_own", F.lit(True))
    if block_rows < max(before, after):
        raise ValueError("a block must hold the rows of its halo")
    block = F.floor(F.col("row_id") / block_rows)
    first = F.floor(F.greatest(F.col("row_id") - after, F.lit(0)) / block_rows)
    last = F.floor((F.col("row_id") + before) / block_rows)
    laid = df.withColumn("_block", F.explode(F.sequence(first, last))).withColumn("_own", F.col("_block") == block)
    return laid.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *BLOCK) if spread else laid


def own_rows(df: DataFrame) -> DataFrame:
    return df.where("_own").drop("_block", "_own")


BLOCK = ("series_id", "_block")


#: Accuracy of the sketch that brackets quantiles, the share of ranks that a bracket has to spare on either side, and how many
#: values of a column are a bracket by themselves.
ACCURACY, SPARE, FEW_VALUES = 20_000, 2.5e-4, 100_000


def nearest_quantiles(df: DataFrame, columns: list[str], shares: list[float], bounded: bool = False) -> DataFrame:
    """column, share, value: of n values that aren't null or NaN, the one at rank round(share * (n - 1)), halves up.

    Columns become rows. A sketch per column brackets each quantile; then the values within a bracket are counted one by one and
    those below it only in number, so the window that finds the rank runs over a small share of the distinct values
    (2 * SPARE). bounded: df is a sample of bounded size, whose distinct values may meet as they are.
    """
    if not columns:
        return df.sparkSession.createDataFrame([], "column string, share double, value double")
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("double").alias("value")) for c in columns])
    long = df.select(F.explode(pairs).alias("p")).select("p.column", "p.value").where(F.col("value").isNotNull() & ~F.isnan("value"))
    aims = [float(s) for s in shares]
    if bounded:
        met = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
        counted = met.select("column", F.explode(F.array(*map(F.lit, aims))).alias("share"), "value", "n")
    else:
        ends = [min(1.0, max(0.0, s + d)) for s in aims for d in (-SPARE, SPARE)]
        sketch = long.groupBy("column").agg(F.count(F.lit(1)).alias("_all"), F.percentile_approx("value", ends, ACCURACY).alias("_q"))
        few = F.col("_all") <= FEW_VALUES
        low = lambda i, s: F.when(few | F.lit(s <= SPARE), F.lit(-math.inf)).otherwise(F.col("_q")[2 * i])
        high = lambda i, s: F.when(few | F.lit(s >= 1 - SPARE), F.lit(math.inf)).otherwise(F.col("_q")[2 * i + 1])
        spans = F.array(*[F.struct(F.lit(s).alias("share"), low(i, s).alias("low"), high(i, s).alias("high")) for i, s in enumerate(aims)])
        spans = F.broadcast(sketch.select(F.col("column").alias("_c"), spans.alias("_spans")))  # a row per column
        # copies of a value are counted before a row is made for every share
        met = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")).join(spans, F.col("column") == F.col("_c"))
        met = met.select("column", "value", "n", F.explode("_spans").alias("s")).where(F.col("value") <= F.col("s.high"))
        inside = F.when(F.col("value") >= F.col("s.low"), F.col("value"))  # null: below the bracket
        counted = met.groupBy("column", F.col("s.share").alias("share"), inside.alias("value")).agg(F.sum("n").alias("n"))
    w = Window.partitionBy("column", "share")
    total = long.groupBy("column").agg(F.count(F.lit(1)).alias("_total"))
    ranked = counted.select("column", "share", "value", F.sum("n").over(w.orderBy(F.col("value").asc_nulls_first())).alias("upto"))
    ranked = ranked.join(F.broadcast(total), "column")
    aim = F.floor(F.col("share") * (F.col("_total") - 1) + 0.5)
    return ranked.where(F.col("upto") > aim).groupBy("column", "share").agg(F.min("value").alias("value"))


def flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))
