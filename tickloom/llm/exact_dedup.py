"""Exact dedup by a persistent digest index, bucketed and sorted by hash.

Texts are equal when they are identical after deleting white space (blank, 9 to 13). Null texts count as empty, and so
do blank ones; all of them are one group. Of equal texts the one with the most code points in the original stays, then
the smallest doc_id; null ids come last; of rows that repeat an id and a text one stays. Other columns are not read, so
their names can't clash. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

ENTRY = "digest BINARY, keep_id BIGINT, keep_row BIGINT, n_points BIGINT, group_size BIGINT, batch STRING"
#: Index rows that a bucket is made for.
BUCKET_ROWS = 2_000_000
#: Appends after which a bucket's files are merged into one sorted file again.
APPENDS = 16
#: The file that names the index's table: a folder and its buckets. Spark's readers pass over names that begin like that.
HEAD = "_head.json"


def digests(docs: DataFrame) -> DataFrame:
    """row_no, doc_id, key, n_points (code points of the original) and the SHA-256 of the normalised text: the only use of texts."""
    text = C.text_of()
    return docs.select(
        F.monotonically_increasing_id().alias("row_no"),
        F.col("doc_id").cast("long").alias("doc_id"),
        C.text_key().alias("key"),
        F.length(text).cast("long").alias("n_points"),
        F.unhex(F.sha2(F.regexp_replace(text, C.SPACE, "").cast("binary"), 256)).alias("digest"),
    )


class DigestIndex:
    """One row per digest ever seen, in a Parquet table clustered and sorted by digest at a path in shared storage.

    The same path opened again, in another session too, continues the index: the number of buckets is kept with it, and asking
    for another one is an error. A batch costs one aggregation of its own digests and a sort-merge anti-join in which only the
    batch is shuffled: the index side is read by bucket. Batches have names. A batch that is run again, after a failure at
    whatever point, gives the same result and adds only what is missing. One batch writes at a time.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark, self.path = spark, path.rstrip("/")
        head = C.read_small(spark, f"{self.path}/{HEAD}")
        if head is None:
            self._point("entries-0", buckets or 4)
        else:
            self._open(**json.loads(head))
        if buckets not in (None, self.buckets):
            raise ValueError(f"the index at {path} has {self.buckets} buckets, not {buckets}")

    def _point(self, folder: str, buckets: int, appends: int = 0) -> None:
        C.write_small(self.spark, f"{self.path}/{HEAD}", json.dumps({"folder": folder, "buckets": buckets, "appends": appends}))
        self._open(folder, buckets, appends)

    def _open(self, folder: str, buckets: int, appends: int) -> None:
        self.folder, self.buckets, self.appends = folder, buckets, appends
        self.name = self._table(folder, buckets)

    def _table(self, folder: str, buckets: int) -> str:
        name = "digest_index_" + hashlib.md5(f"{self.path}/{folder}".encode()).hexdigest()
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({ENTRY}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{self.path}/{folder}'"
        )
        self.spark.catalog.refreshTable(name)  # another session may have written
        return name

    def entries(self) -> DataFrame:
        return self.spark.table(self.name)

    def compact(self, buckets: int | None = None) -> None:
        """One sorted file per bucket, in a new folder that the head then names; more buckets, if asked for."""
        buckets, before = buckets or self.buckets, self.folder
        folder = f"entries-{int(before.rpartition('-')[2]) + 1}"
        C.remove(self.spark, f"{self.path}/{folder}")  # what a compaction that failed has left
        name = self._table(folder, buckets)
        rows = self.spark.read.schema(self.entries().schema).parquet(f"{self.path}/{before}")  # as files: of the table, no exchange would be made
        rows.repartition(buckets, "digest").write.insertInto(name)
        self._point(folder, buckets)
        C.remove(self.spark, f"{self.path}/{before}")

    def dedup(self, docs: DataFrame, batch: str) -> DataFrame:
        """Digests of the batch that the index lacks are appended; returns a row per document of the batch.

        doc_id, keep_id, group_size, kept, text_sha256. group_size counts the batch's rows of the digest and those that
        brought it into the index. A row whose digest came with another batch isn't kept.
        """
        rows = C.spool(digests(docs), "digests")
        # the complement turns an order round, for the least long too
        best = F.max(F.struct("n_points", F.bitwise_not("doc_id").alias("id"), F.bitwise_not("row_no").alias("row"))).alias("b")
        groups = rows.groupBy("digest").agg(best, F.count(F.lit(1)).alias("group_size"))
        groups = groups.select("digest", F.bitwise_not("b.id").alias("keep_id"), F.bitwise_not("b.row").alias("keep_row"), F.col("b.n_points").alias("n_points"), "group_size")
        groups = C.spool(groups, "groups")
        there = self.entries().select("digest", F.col("keep_id").alias("old_id"), F.col("group_size").alias("before"), F.col("batch").alias("by"))
        # an entry of the same batch is what an earlier run of it has left: it is there, but not known before
        known = F.col("by").isNotNull() & (F.col("by") != batch)
        entries = groups.join(there.hint("merge"), "digest", "left").select(
            "digest",
            F.when(known, F.col("old_id")).otherwise(F.col("keep_id")).alias("keep_id"),
            F.when(~known, F.col("keep_row")).alias("keep_row"),
            (F.col("group_size") + F.when(known, F.col("before")).otherwise(F.lit(0))).alias("group_size"),
        )
        entries = C.spool(entries, "entries")  # before the append, which would make every digest a known one
        fresh = groups.join(there.select("digest").hint("merge"), "digest", "left_anti").withColumn("batch", F.lit(batch))
        fresh.select(*self.entries().columns).repartition(self.buckets, "digest").write.insertInto(self.name)
        if self.appends + 1 >= APPENDS:
            self.compact()
        else:
            self._point(self.folder, self.buckets, self.appends + 1)
        total = rows.count()
        return C.attach(rows, entries, "digest", "group_size", total).select(
            "doc_id",
            "keep_id",
            "group_size",
            F.coalesce(F.col("row_no") == F.col("keep_row"), F.lit(False)).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
            "row_no",
            "key",
        )


def exact_dedup(docs: DataFrame, index_path: str | None = None, batch: str | None = None) -> DataFrame:
    """All of docs as a batch, which has a name, against the index at index_path; or against a new one, which knows nothing."""
    spark = docs.sparkSession
    if index_path is not None:
        if batch is None:
            raise ValueError("a batch for an index that stays needs a name")
        return DigestIndex(spark, index_path).dedup(docs, batch)
    buckets = max(4, -(-docs.count() // BUCKET_ROWS))
    return DigestIndex(spark, C.fresh_path(spark, "digest-index"), buckets).dedup(docs, batch or "0")
