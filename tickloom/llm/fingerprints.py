"""Document fingerprints: SimHash by weighted votes, and permuted block tables for all fingerprints within a radius.

Terms are pairs of adjacent words (split at blank and 9 to 13) and the last word by itself, so that a one-word text has a
term; a term votes with its number of occurrences. A bit is 1 if over half of the weight votes for it. Null, empty and
blank texts have no term and fingerprint 0. Equal texts have equal fingerprints. Only doc_id and text are read. Repeated
rows stay rows of their own; null ids come last in descending order; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

BITS = 64
#: Two 32-bit counters to a long: bit i and bit i + 32 are counted by one sum.
LANES = 0x0000000100000001
LOW = 0xFFFFFFFF
#: Documents to a cell of neighbours in id order; splitters of ids. The broadcast of the cells' heads has a row each, 65,536 at most.
CELL_ROWS, SPLITTERS = 2048, 255


def terms(text: Column) -> Column:
    words = F.split(F.btrim(text, F.lit(" \t\n\x0b\f\r")), C.SPACE)
    return F.arrays_zip(words.alias("a"), F.slice(words, 2, F.greatest(F.size(words), F.lit(1))).alias("b"))


def fingerprints(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """keys and fingerprint. The keys must tell rows apart; counters are combined on the map side, texts aren't shuffled."""
    # a blank text splits to one empty word, whose hash is left out of the count but not of the row
    pairs = rows.select(*keys, F.explode(terms(F.col(text))).alias("t"))
    real = F.col("t.a") != ""
    hashed = pairs.select(*keys, F.when(real, F.xxhash64("t.a", "t.b")).alias("h"))
    sums = [F.sum(F.shiftrightunsigned("h", i).bitwiseAND(F.lit(LANES))).alias(f"s{i}") for i in range(32)]
    votes = hashed.groupBy(*keys).agg(F.count("h").alias("n"), *sums)
    bits = []
    for i in range(32):
        for at, count in ((i, F.col(f"s{i}").bitwiseAND(F.lit(LOW))), (i + 32, F.shiftrightunsigned(f"s{i}", 32))):
            bits.append(F.when(2 * count > F.col("n"), F.shiftleft(F.lit(1).cast("long"), at)).otherwise(F.lit(0).cast("long")))
    tree = bits
    while len(tree) > 1:
        tree = [reduce(lambda a, b: a.bitwiseOR(b), tree[i : i + 2]) for i in range(0, len(tree), 2)]
    return votes.select(*keys, tree[0].alias("fingerprint"))


def likeness(a: Column, b: Column) -> Column:
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def block_masks(radius: int, agree: int) -> list[int]:
    """Of radius + agree blocks at least agree are equal in two fingerprints within the radius: a mask for each choice of them."""
    n = radius + agree
    edges = [BITS * i // n for i in range(n + 1)]
    blocks = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    return [signed(sum(c)) for c in combinations(blocks, agree)]


def within(queries: DataFrame, corpus: DataFrame, radius: int = 3, agree: int = 2) -> DataFrame:
    """query, match, distance for all pairs of distinct fingerprints (column fingerprint) within the radius; exact.

    Each table keeps the bits of one choice of blocks in front; here that is an equi-join on the kept bits. A pair is
    reported by the first table in which it meets, so no distinct step follows. More agreeing blocks make longer keys:
    2 give 25 bits at radius 3, 3 give 32 bits. Copies are joined once: fingerprints are made distinct before.
    """
    masks = block_masks(radius, agree)
    tables = lambda c: F.explode(F.array(*[F.struct(F.lit(i).alias("no"), F.col(c).bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(masks)]))
    side = lambda df, c: df.select(F.col("fingerprint").alias(c)).where(F.col(c).isNotNull()).distinct().select(c, tables(c).alias("t")).select(c, "t.no", "t.key")
    q, m = side(queries, "query"), side(corpus, "match")
    x = F.col("query").bitwiseXOR(F.col("match"))
    earlier = reduce(lambda a, b: a | b, [(F.col("no") > i) & (x.bitwiseAND(F.lit(k)) == 0) for i, k in enumerate(masks)])
    out = q.join(m, ["no", "key"]).where((F.bit_count(x) <= radius) & ~earlier)
    return out.select("query", "match", F.bit_count(x).alias("distance"))


def with_next(docs: DataFrame) -> DataFrame:
    """row_no, next_no, doc_id, text, next_text: each document and the next one in descending order of ids, the first after the last.

    Ids are dealt into cells by quantiles; the first document of a cell is also put, as a guest, at the end of the cell
    before, so that a window over cells sees every neighbour. Texts are shuffled once.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row_no"), F.col("doc_id").cast("long").alias("doc_id"), C.text_of().alias("text"))
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    cell = C.id_cells(docs, CELL_ROWS, SPLITTERS)
    heads = ids.groupBy(cell.alias("cell")).agg(F.max("doc_id").alias("head"))
    order = Window.orderBy("cell")
    lowest = F.min("cell").over(Window.partitionBy())
    heads = F.broadcast(heads.select("head", F.coalesce(F.lead("cell").over(order), lowest).alias("guest_of")))
    both = rows.withColumn("cell", cell).join(heads, rows["doc_id"].eqNullSafe(F.col("head")), "left")
    places = F.filter(F.array(F.struct(F.col("cell"), F.lit(0).alias("guest")), F.struct(F.col("guest_of").alias("cell"), F.lit(1).alias("guest"))), lambda p: p["cell"].isNotNull())
    dealt = both.select("row_no", "doc_id", "text", F.explode(places).alias("p")).select("row_no", "doc_id", "text", "p.cell", "p.guest")
    w = Window.partitionBy("cell").orderBy("guest", F.col("doc_id").desc_nulls_last(), F.xxhash64("text"), "row_no")
    seen = dealt.select("row_no", "doc_id", "text", "guest", F.lead("row_no").over(w).alias("next_no"), F.lead("text").over(w).alias("next_text"))
    return seen.where("guest = 0").drop("guest")


def count_within(rows: DataFrame, radius: int, every: int) -> DataFrame:
    """row_no, n_within: for rows whose id is divisible by `every`, how many different fingerprints of all rows (row_no, doc_id,
    fingerprint) are within the radius of theirs, which is one of them."""
    asked = rows.where(F.col("doc_id") % every == 0).select("row_no", "fingerprint")
    counts = within(asked, rows, radius).groupBy("query").agg(F.count(F.lit(1)).alias("n_within"))
    sizes = asked.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("size"))
    entries = C.spool(sizes.join(counts, sizes["fingerprint"] == counts["query"]).drop("query"), "within")
    return C.attach(asked, entries, "fingerprint", "size", asked.count()).select("row_no", "n_within")


def fingerprint_edits(docs: DataFrame, radius: int = 3, every: int = 100) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_within.

    The edited text has the last third of the code points (rounded down) replaced by as many from the next document's start.
    n_within: by the block tables, see count_within; null for rows that aren't asked for, those without an id among them.
    """
    rows = with_next(docs)
    n = F.length("text")
    k = F.floor(n / 3).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), n - k), F.substr("next_text", F.lit(1), k))
    rows = rows.select("row_no", "next_no", "doc_id", n.cast("long").alias("n_chars"), "text", edited.alias("edited"))
    rows = rows.withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256))
    keys = ["row_no", "next_no", "doc_id", "n_chars", "edited_sha256"]
    kinds = rows.select(*keys, F.explode(F.array(F.struct(F.lit(0).alias("kind"), F.col("text").alias("body")), F.struct(F.lit(1).alias("kind"), F.col("edited").alias("body")))).alias("k"))
    prints = fingerprints(kinds.select(*keys, "k.kind", "k.body"), [*keys, "kind"], "body")
    own = C.spool(prints, "prints")
    plain = own.where("kind = 0").drop("kind")
    changed = own.where("kind = 1").select("row_no", F.col("fingerprint").alias("edited_print"))
    following = plain.select(F.col("row_no").alias("next_no"), F.col("fingerprint").alias("next_print"))
    out = plain.join(changed, "row_no").join(following, "next_no").join(count_within(plain, radius, every), "row_no", "left")
    return out.select(
        "doc_id", "n_chars", "edited_sha256", C.hex64(F.col("fingerprint")).alias("fingerprint"), C.hex64(F.col("edited_print")).alias("edited_fingerprint"),
        likeness(F.col("fingerprint"), F.col("edited_print")).alias("near_edited"), likeness(F.col("fingerprint"), F.col("next_print")).alias("near_next"),
        "n_within",
    )
