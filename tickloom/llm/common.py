"""Helpers that the training-data operators share: tables, the shared folder, spooling, skew-proof joins, prefix sums."""

from __future__ import annotations

import atexit
import gc
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space of all contracts: blank and the control characters 9 to 13.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
#: A key is hot if it holds at least one HOT-th of the rows, so there are at most HOT hot keys: a proven bound for a broadcast.
HOT = 1000
#: Rows of 16 bytes that are broadcast at most.
FEW = 50_000

#: What a Python worker keeps from task to task: one operator's memory at a time.
_held: dict[tuple, object] = {}


def hold(key: tuple, make):
    """The worker's own make(), kept until another operator runs in the worker."""
    if key not in _held:
        release()
        _held[key] = make()
    return _held[key]


def release() -> None:
    if _held:
        _held.clear()
        gc.collect()
        trim()


def trim() -> None:
    """Give freed memory back to the system, where the C library can."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def slices(batches: Iterator, rows: int = 256) -> Iterator:
    """Batches cut into smaller ones, so that what a worker makes of a batch stays small."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


_spools: list[tuple[SparkSession, str]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; a temporary one only on local masters that set none."""
    at = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if at:
        return at.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    at = "file://" + tempfile.mkdtemp(prefix="tickloom-")
    spark.conf.set("spark.checkpoint.dir", at)
    _spools.append((spark, at))
    return at


def fresh_path(spark: SparkSession, tag: str) -> str:
    """A new path in the shared folder, removed when the driver ends."""
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    _spools.append((spark, path))
    return path


def remove(spark: SparkSession, path: str) -> None:
    at, fs = _file(spark, path)
    fs.delete(at, True)


def _file(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def read_small(spark: SparkSession, path: str) -> str | None:
    """A small file's text by Spark's file systems; None if there is none."""
    at, fs = _file(spark, path)
    if not fs.exists(at):
        return None
    stream = fs.open(at)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_small(spark: SparkSession, path: str, text: str) -> None:
    """Written beside the path and renamed over it, so that no half of it is ever read."""
    at, fs = _file(spark, path)
    beside = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    stream = fs.create(beside, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    context = spark.sparkContext._jvm.org.apache.hadoop.fs.FileContext.getFileContext(beside.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    option = spark.sparkContext._gateway.new_array(getattr(spark.sparkContext._jvm, "org.apache.hadoop.fs.Options$Rename"), 1)
    option[0] = getattr(spark.sparkContext._jvm, "org.apache.hadoop.fs.Options$Rename").OVERWRITE
    context.rename(beside, at, option)


@atexit.register
def _sweep() -> None:
    for spark, path in _spools:
        try:
            remove(spark, path)
        except Exception:  # the session has ended already, and with it what could remove files
            return


def spool(df: DataFrame, tag: str) -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends there, and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = fresh_path(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_of(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def n_words(text: Column) -> Column:
    """Maximal runs of non-blank characters."""
    trimmed = F.regexp_replace(text, rf"\A{SPACE}|{SPACE}\z", "")  # $ would also match before a line separator at the end
    return F.when(F.length(trimmed) == 0, F.lit(0)).otherwise(F.size(F.split(trimmed, SPACE))).cast("long")


def words_of(text: Column) -> Column:
    """The words in order; none for blank texts."""
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def text_key() -> Column:
    """With doc_id, what a row is found by again in another reading of its table; equal for rows that repeat both."""
    return F.xxhash64(F.length(text_of()), text_of())


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, with as many underscores behind each as make it one that df hasn't."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def matching(docs: DataFrame, decided: DataFrame, how: str, mark: str = "") -> DataFrame:
    """docs joined to decided by (doc_id, key): by broadcast if that is FEW rows at most, else by a sort-merge join. Rows that
    repeat both are one key, so each key may be in decided once. mark: keep the key of docs under this name."""
    names = free_names(docs, "_mark", "_id", "_key")
    own = decided.withColumnsRenamed({"doc_id": names[1], "key": names[2]})
    own = F.broadcast(own) if own.count() <= FEW else own.hint("merge")
    marked = docs.withColumn(names[0], text_key())
    same = marked[names[0]].eqNullSafe(own[names[2]]) & marked["doc_id"].cast("long").eqNullSafe(own[names[1]])
    out = marked.join(own, same, how).drop(*names[1:])
    return out.withColumnRenamed(names[0], mark) if mark else out.drop(names[0])


def keep(docs: DataFrame, decided: DataFrame) -> DataFrame:
    """The rows of docs that decided (doc_id, key, kept) keeps. Of rows that repeat an id and a text one stays if any is kept."""
    per = spool(decided.groupBy("doc_id", "key").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n")), "decided")
    (mark,) = free_names(docs, "_mark")
    out = matching(docs, per.where(~F.col("kept")).select("doc_id", "key"), "left_anti", mark)
    if per.where("kept and n > 1").limit(1).count():
        out = out.dropDuplicates(["doc_id", mark])
    return out.select(*docs.columns)


def hex64(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def attach(rows: DataFrame, entries: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """rows joined to the one entry of their key. entries[size] counts the rows of the key, total all rows.

    Keys with over a HOT-th of the rows (at most HOT of them, whatever the input) are joined by broadcast, so no task
    gets a hot key's rows; the rest goes through a sort-merge join, where no key is large.
    """
    limit = max(2, -(-total // HOT))
    hot = F.broadcast(entries.where(F.col(size) >= limit))
    marked = rows.join(hot.withColumn("_hot", F.lit(True)), key, "left")
    warm = marked.where(F.col("_hot")).drop("_hot")
    cold = marked.where(F.col("_hot").isNull()).select(*rows.columns)
    cold = cold.join(entries.where(F.col(size) < limit).hint("merge"), key)
    return warm.unionByName(cold)


def running_sum(df: DataFrame, group: list[str], cell: str, order: list[Column], value: str, out: str) -> DataFrame:
    """Adds out: the sum of value over the earlier rows of the same group, in the order (cell, order); exclusive.

    No window spans a whole group: cells are summed first (a map-side combine), the cells' starts come from a window over
    the small table of cells, and only the rows of one (group, cell) meet in a task. Nulls are a group of their own.
    """
    from pyspark.sql import Window

    cells = df.groupBy(*group, cell).agg(F.sum(value).alias("_sum"))
    w = Window.partitionBy(*group).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    starts = cells.withColumn("_start", F.coalesce(F.sum("_sum").over(w), F.lit(0))).drop("_sum")
    starts = starts.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate([*group, cell])], "_start")
    same = None
    for i, c in enumerate([*group, cell]):
        e = df[c].eqNullSafe(starts[f"_k{i}"])
        same = e if same is None else same & e
    inner = Window.partitionBy(*group, cell).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    within = F.coalesce(F.sum(value).over(inner), F.lit(0))
    joined = df.join(starts, same).drop(*[f"_k{i}" for i in range(len(group) + 1)])
    return joined.withColumn(out, (F.col("_start") + within).cast("long")).drop("_start")


def open_fs(path: str):
    """The file system of a shared path, and the path in it: for workers that write or read files of their own format."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))


#: Parts of a cell at most, where an id that many rows share is cut further.
TIE_PARTS = 1 << 12


def id_cells(df: DataFrame, rows: int, splitters: int = 255, most: int = 65536, ties: Column | None = None) -> Column:
    """A number that ascends with doc_id and that about so many rows share; below 0 for null. At most `most` cells in all.

    Quantiles of the ids give ranges of equal weight, each cut into cells of equal width. Reads the ids alone. ties: a hash, a long,
    by which null ids, and ids that hold more than a range's weight, are cut into parts of about `rows` rows, at most TIE_PARTS of
    them; cells then ascend with (doc_id, ties), null ids first. Without it, null ids are the cell -1 and no id is cut.
    """
    ids = df.select(F.col("doc_id").cast("long").alias("doc_id"))
    shares = [(i + 1) / (splitters + 1) for i in range(splitters)]
    found, n, top, known = ids.agg(F.percentile_approx("doc_id", shares, 10000), F.count(F.lit(1)), F.max("doc_id"), F.count("doc_id")).first()
    found = found or []
    cuts = sorted(set(found))
    fine = max(1, min(most // (splitters + 1), -(-n // (rows * (len(cuts) + 1)))))
    stride = max(1, (len(cuts) + 1) * rows // max(n, 1)) if fine == 1 else 1
    parts_of = lambda size: max(1, min(TIE_PARTS - 1, -(-size // rows)))
    hot = {c: parts for c in cuts if ties is not None and (parts := parts_of(found.count(c) * known // (splitters + 1))) > 1}
    cuts = sorted({*cuts[stride - 1 :: stride], *hot})  # small inputs need fewer ranges
    above = F.array(*[F.lit(int(c)).cast("long") for c in [*cuts, (top or 0) + 1]])
    at = F.size(F.filter(above, lambda c: c <= F.col("doc_id")))
    left = F.when(at > 0, F.try_element_at(above, F.greatest(at, F.lit(1))))
    part = F.floor((F.col("doc_id") - left) / F.greatest(F.try_element_at(above, at + 1) - left, F.lit(1)) * fine)
    cell = at * fine + F.coalesce(F.least(part, F.lit(fine - 1)), F.lit(0))
    if ties is None:
        return F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(cell).cast("long")
    # ties >> 12 has 52 bits, so the product below is exact enough to ascend and doesn't overflow
    cut = lambda parts: F.floor((F.shiftright(ties, 12) + F.lit(1 << 51)) / F.lit(float(1 << 52)) * parts)
    # an id that many rows share is the first of its cell; the cell's other ids come behind all its parts
    behind = F.lit(TIE_PARTS - 1) if hot else F.lit(0)
    sub = behind
    for c, parts in hot.items():
        sub = F.when(F.col("doc_id") == c, cut(parts)).otherwise(sub)
    missing = cut(parts_of(n - known)) - TIE_PARTS
    return F.when(F.col("doc_id").isNull(), missing).otherwise(cell * TIE_PARTS + sub).cast("long")
