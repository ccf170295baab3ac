"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks.

Size is the number of words of a text (null: 0). Sources in code-point order, null last, weigh 5, 2, 1 and again; they
share 150 % of all words; a target stops at twice its source's size and the excess is shared by weight until none is above.
Slot k of the schedule takes the point frac((k + 1) / golden ratio) through the cumulative targets to a source; the r-th
slot of a source takes the r-th block of its documents, laid out in hashed order, and starts over after the last block.
Null and empty texts have size 0 and are never taken; null ids are hashed like any other; repeated rows are rows of their
own; an empty table gives no rows. Only doc_id, text and source are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_PASSES = 2
#: Blocks are as large as makes about 2^20 slots, at most BLOCK words: small inputs get finer blocks, large ones more slots.
BLOCK = 1024
SLOTS = 1 << 20
GOLDEN = 0.6180339887498949
#: Documents of a source that meet in one task when their order is made; cells of slots.
CELL_ROWS = 2_000
#: Cells of the unit interval by which slots meet sources.
GRID = 4096


def sized(docs: DataFrame) -> DataFrame:
    """row_no, doc_id, key, source, size: all that is kept of the texts."""
    return docs.select(
        F.monotonically_increasing_id().alias("row_no"), F.col("doc_id").cast("long").alias("doc_id"), C.text_key().alias("key"), F.col("source").cast("string").alias("source"), C.n_words(C.text_of()).alias("size")
    )


def source_targets(rows: DataFrame) -> DataFrame:
    """source, rank, source_size, weight, target: a row per source. Sharing the excess again and again ends at one level
    of words per weight, found here by a running sum over the sources in the order in which they reach their caps."""
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*[F.lit(float(w)) for w in WEIGHTS])
    out = sizes.withColumn("rank", F.row_number().over(order) - 1)
    out = out.withColumn("weight", F.element_at(weights, (F.col("rank") % len(WEIGHTS) + 1).cast("int")))
    out = out.withColumn("cap", (MAX_PASSES * F.col("source_size")).cast("double"))
    every = Window.partitionBy()
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    out = out.withColumn("total", SHARE * F.sum("source_size").over(every))
    capped = F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    free = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    out = out.withColumn("level", (F.col("total") - capped) / free)
    # the first source, in that order, that its level leaves below its cap fixes the level of all after it
    first = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), "rank", "level"))).over(every)
    out = out.withColumn("at", first)
    return out.select(
        "source", "rank", "source_size", "n_docs", "weight", F.least(F.col("cap"), F.coalesce(F.col("at.level"), F.col("cap")) * F.col("weight")).alias("target")
    )


def schedule(targets: DataFrame, slots: int) -> DataFrame:
    """slot, rank (of the source), nth: the how-manieth slot of its source, from 0."""
    spark = targets.sparkSession
    w = Window.orderBy("rank")
    upto = F.sum("target").over(w)
    whole = F.sum("target").over(Window.partitionBy())
    spans = targets.where("target > 0").select("rank", "target", ((upto - F.col("target")) / whole).alias("lo"), (upto / whole).alias("hi"), F.max("rank").over(Window.partitionBy()).alias("top"))
    spans = spans.withColumn("hi", F.when(F.col("rank") == F.col("top"), F.lit(2.0)).otherwise(F.col("hi")))
    first = F.floor(F.col("lo") * GRID).cast("int")
    last = F.least(F.floor(F.col("hi") * GRID).cast("int"), F.lit(GRID - 1))
    spans = spans.withColumn("grid", F.explode(F.sequence(first, F.greatest(first, last)))).select("rank", "lo", "hi", "grid")
    x = (F.col("id") + 1) * GOLDEN
    points = spark.range(slots).select(F.col("id").alias("slot"), (x - F.floor(x)).alias("u"))
    points = points.withColumn("grid", F.floor(F.col("u") * GRID).cast("int"))
    hit = points.join(spans, "grid").where((F.col("u") >= F.col("lo")) & (F.col("u") < F.col("hi")))
    hit = hit.select("slot", "rank", F.floor(F.col("slot") / CELL_ROWS).alias("cell"), F.lit(1).alias("one"))
    return C.running_sum(hit, ["rank"], "cell", [F.col("slot")], "one", "nth").select("slot", "rank", "nth")


def mix(rows: DataFrame, targets: DataFrame, words: int) -> DataFrame:
    """slot, row_no, doc_id, from_word, to_word: the words of each document that each slot of the schedule takes.

    rows: from sized(); targets: from source_targets(); words: all words. Each (source, block) has at most MAX_PASSES
    slots, so a hot source's blocks spread over all tasks. Reruns give the same mix.
    """
    block = max(1, min(BLOCK, words // SLOTS))
    slots = int(round(SHARE * words / block))
    plan = schedule(targets, slots)
    docs = rows.where("size > 0").join(targets.select("source", "rank", "source_size", "n_docs").withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    cells = F.greatest(F.lit(1), F.ceil(F.col("n_docs") / CELL_ROWS))
    docs = docs.withColumn("place", F.xxhash64("doc_id", "size")).withColumn("cell", F.pmod(F.shiftright("place", 20), cells))
    docs = C.running_sum(docs.select("row_no", "doc_id", "size", "source_size", "rank", "place", "cell"), ["rank"], "cell", [F.col("place"), F.col("doc_id"), F.col("row_no")], "size", "start")
    parts = docs.withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block))))
    lo = F.greatest(F.col("block") * block, F.col("start")) - F.col("start")
    hi = F.least((F.col("block") + 1) * block, F.col("start") + F.col("size")) - F.col("start")
    parts = parts.select("row_no", "doc_id", "rank", "block", lo.alias("from_word"), hi.alias("to_word"))
    blocks = targets.select("rank", F.ceil(F.col("source_size") / block).alias("n_blocks"))
    taken = plan.join(blocks, "rank").where(F.col("nth") < MAX_PASSES * F.col("n_blocks"))
    taken = taken.select("slot", "rank", (F.col("nth") % F.col("n_blocks")).alias("block"))
    return parts.join(taken, ["rank", "block"]).select("slot", "row_no", "doc_id", "from_word", "to_word")


def mix_counts(docs: DataFrame) -> DataFrame:
    """row_no, doc_id, key, size, source_size, target, taken: a row per document; taken counts repeated words again."""
    rows = C.spool(sized(docs), "sizes")
    targets = C.spool(source_targets(rows), "targets")
    words = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    took = mix(rows, targets, words).groupBy("row_no").agg(F.sum(F.col("to_word") - F.col("from_word")).alias("taken"))
    same = targets.select(F.col("source").alias("_s"), "source_size", "target")
    out = rows.join(same, F.col("source").eqNullSafe(F.col("_s"))).join(took, "row_no", "left")
    return out.select("row_no", "doc_id", "key", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def resample(docs: DataFrame) -> DataFrame:
    """docs mixed: a document is there as often as the mix takes it, rounded (0 to MAX_PASSES times), with all its columns."""
    counts = mix_counts(docs).groupBy("doc_id", "key").agg((F.sum("taken") / F.greatest(F.sum("size"), F.lit(1))).alias("share"))
    many, nth = C.free_names(docs, "_times", "_nth")
    times = C.spool(counts.select("doc_id", "key", F.floor(F.col("share") + 0.5).cast("int").alias(many)), "times")
    joined = C.matching(docs, times.where(F.col(many) > 0), "inner")
    return joined.withColumn(nth, F.explode(F.sequence(F.lit(1), F.col(many)))).select(*docs.columns)
