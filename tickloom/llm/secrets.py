"""Secret scans by a trigram inverted index.

Each rule's regular expression is turned into a Boolean trigram query (an OR of ANDs). The index has a posting (trigram,
doc_id) for every trigram of every lower-cased text, sorted by trigram in each file, so that a rule, an older or a new one,
reads the postings that it asks for alone; a rule's candidates are the documents in the intersection of an alternative's
postings, and its expression runs on those alone. A rule without a mandatory trigram scans all texts. Matches are leftmost and don't
overlap within a kind; start and end count code points, the end exclusive. Null and empty texts have no spans; rows with
null or repeated ids are scanned as rows of their own; other columns aren't read; an empty table gives no rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

#: Strings of a run, alternatives of a query, characters of a class that are followed one by one. Beyond them a part of
#: the query is left out: it then lets more documents through, never fewer.
RUN, ALTERNATIVES, CLASS = 48, 64, 4
#: Matches of a text whose places are listed at a time.
TOGETHER = 256


@dataclass(frozen=True)
class Rule:
    """group, least: a match counts only if that group has so many code points (matches that fail still use up their text)."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


#: The base rules, then those that this method adds.
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]+", 0, 16),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
BASE = ("assign", "access", "hex")

ANY: frozenset = frozenset([frozenset()])


def _smallest(query: frozenset) -> frozenset:
    """Without alternatives that another one implies."""
    return frozenset(a for a in query if not any(b < a for b in query))


def _both(a: frozenset, b: frozenset) -> frozenset:
    out = _smallest(frozenset(x | y for x in a for y in b))
    return out if len(out) <= ALTERNATIVES else min(a, b, key=len) if ANY not in (a, b) else a | b


def _of_strings(strings: set[str]) -> frozenset:
    return _smallest(frozenset(frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings))


def _walk(items) -> tuple[set[str] | None, frozenset]:
    """Of a sequence of parsed items: all its strings if they are few, else None, and its query."""
    run: set[str] = {""}
    query, whole = ANY, True
    for op, arg in items:
        name, one, inner = str(op), None, ANY
        if name == "LITERAL":
            one = {chr(arg).lower()}
        elif name == "IN":
            one = _class(arg)
        elif name == "SUBPATTERN":
            one, inner = _walk(arg[-1])
        elif name == "BRANCH":
            parts = [_walk(p) for p in arg[1]]
            if all(p[0] is not None for p in parts):
                one = set().union(*[p[0] for p in parts])
            inner = _smallest(frozenset().union(*[p[1] for p in parts]))
        elif name in ("MAX_REPEAT", "MIN_REPEAT"):
            least, most, body = arg
            own, part = _walk(body)
            if own is not None and most == 1 and least == 0:
                one = own | {""}
            elif own is not None and least == most == 1:
                one = own
            inner = part if least else ANY
        if one is not None and len(run) * len(one) <= RUN:
            run = {a + b for a in run for b in one}
            continue
        query, whole = _both(_both(query, _of_strings(run)), inner), False
        run = {""} if one is None else one
    return (run, _of_strings(run)) if whole else (None, _both(query, _of_strings(run)))


def _class(items) -> set[str] | None:
    out: set[str] = set()
    for op, arg in items:
        if str(op) == "LITERAL":
            out.add(chr(arg).lower())
        elif str(op) == "RANGE" and arg[1] - arg[0] < CLASS:
            out |= {chr(c).lower() for c in range(arg[0], arg[1] + 1)}
        else:
            return None
    return out if len(out) <= CLASS * 2 else None


def trigram_query(pattern: str) -> list[list[str]] | None:
    """The OR of ANDs of trigrams, in lower case, that every text with a match satisfies; None if there is no such condition."""
    query = _walk(re._parser.parse(pattern))[1]
    return None if frozenset() in query else sorted(sorted(a) for a in query)


def postings(docs: DataFrame) -> DataFrame:
    """trigram, doc_id, each once per row, of all trigrams: one pass over the characters of a text."""
    joined = lambda a, b: F.concat(a, b)
    behind = lambda c, n: F.slice(c, n + 1, F.size(c))
    threes = lambda c: F.array_distinct(F.filter(F.zip_with(F.zip_with(c, behind(c, 1), joined), behind(c, 2), joined), lambda t: t.isNotNull()))
    # as the variable of a function, so that a text is split into its characters once
    found = F.get(F.transform(F.array(F.split(F.lower(C.text_of()), "")), threes), 0)
    return docs.select(F.explode(found).alias("trigram"), F.col("doc_id").cast("long").alias("doc_id"))


def write_index(docs: DataFrame, path: str) -> DataFrame:
    """The postings of docs at a path in shared storage, sorted within files; texts stay where they are read."""
    postings(docs).sortWithinPartitions("trigram", "doc_id").write.parquet(path)
    return docs.sparkSession.read.schema("trigram string, doc_id long").parquet(path)


def candidates(index: DataFrame, rules=RULES) -> DataFrame:
    """doc_id, kinds: the documents that satisfy the trigram query of a rule, with those rules."""
    spark = index.sparkSession
    asked = [(r.kind, i, t, len(a)) for r in rules for i, a in enumerate(trigram_query(r.pattern) or []) for t in a]
    wanted = F.broadcast(spark.createDataFrame(asked, "kind string, alternative int, trigram string, n int"))
    met = index.where(F.col("trigram").isin(sorted({t for _, _, t, _ in asked}))).join(wanted, "trigram").groupBy("doc_id", "kind", "alternative", "n").agg(F.count_distinct("trigram").alias("has"))
    return met.where("has = n").groupBy("doc_id").agg(F.collect_set("kind").alias("kinds"))


def spans(text: Column, rule: Rule, at: int) -> Column:
    """array<struct<start, kind, stop>> of the matches of a rule: the texts between matches give their places."""
    pattern = F.lit(rule.pattern)
    between = F.transform(F.split(text, rule.pattern, -1), lambda g: F.length(g))
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    counted = found if rule.group == 0 else F.regexp_extract_all(text, pattern, F.lit(rule.group))
    rows = F.arrays_zip(between.alias("gap"), F.transform(found, lambda m: F.length(m)).alias("size"), F.transform(counted, lambda m: F.length(m)).alias("counts"))
    none = F.array().cast("array<struct<start:int,kind:int,stop:int>>")

    def step(acc: Column, r: Column) -> Column:
        start = acc["at"] + r["gap"]
        stop = start + F.coalesce(r["size"], F.lit(0))
        own = F.array(F.struct(start.alias("start"), F.lit(at).alias("kind"), stop.alias("stop")))
        return F.struct(stop.alias("at"), F.when(r["counts"] >= rule.least, F.concat(acc["out"], own)).otherwise(acc["out"]).alias("out"))

    def part(done: Column, k: Column) -> Column:
        """The next TOGETHER matches, from where the last ones ended: only their own list is copied as it grows."""
        begun = F.coalesce(F.get(done, F.size(done) - 1)["at"], F.lit(0))
        own = F.aggregate(F.slice(rows, k * TOGETHER + 1, F.lit(TOGETHER)), F.struct(begun.alias("at"), none.alias("out")), step)
        return F.concat(done, F.array(own))

    empty = F.array().cast("array<struct<at:int,out:array<struct<start:int,kind:int,stop:int>>>>")
    parts = F.aggregate(F.sequence(F.lit(0), F.floor((F.size(found)) / TOGETHER).cast("int")), empty, part)
    return F.flatten(F.transform(parts, lambda p: p["out"]))


def scan(docs: DataFrame, rules=RULES, index: DataFrame | None = None) -> DataFrame:
    """doc_id, text, spans: array<struct<start, kind, stop>> by start, then by the rules' order; kind is the rule's place.
    index: from write_index() of the same documents (or more of them); else one is made."""
    asked = {r.kind: trigram_query(r.pattern) for r in rules}
    index = index or write_index(docs, C.fresh_path(docs.sparkSession, "postings"))
    few = C.spool(candidates(index, rules), "candidates")
    small = few.select(F.col("doc_id").alias("_id"), "kinds")
    if few.count() <= C.FEW:
        small = F.broadcast(small)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), C.text_of().alias("text"))
    rows = rows.join(small, F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    none = F.array().cast("array<struct<start:int,kind:int,stop:int>>")
    parts = []
    for i, r in enumerate(rules):
        quick = _quick(r)
        runs = F.col("text").rlike(quick) if asked[r.kind] is None else F.coalesce(F.array_contains("kinds", r.kind), F.lit(False)) & F.col("text").rlike(quick)
        parts.append(F.when(runs, spans(F.col("text"), r, i)).otherwise(none))
    return rows.select("doc_id", "text", F.array_sort(F.concat(*parts)).alias("spans"))


def _quick(rule: Rule) -> str:
    """A test that every text with a counted match passes: the length that a match must have, where all of it counts."""
    if rule.group == 0 and rule.least > 1 and rule.pattern.endswith("]+"):
        head = rule.pattern[: rule.pattern.rindex("[")]
        return f"{rule.pattern[:-1]}{{{max(1, rule.least - len(head))},}}"
    return rule.pattern


def secret_digests(docs: DataFrame, rules=RULES) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans: a row per document."""
    found = scan(docs, rules)
    names = F.array(*[F.lit(r.kind) for r in rules])
    shown = lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["stop"])
    base = [i for i, r in enumerate(rules) if r.kind in BASE]
    own = F.filter("spans", lambda s: s["kind"].isin(base))
    count = lambda i: F.size(F.filter("spans", lambda s: s["kind"] == i)).cast("long")
    return found.select(
        "doc_id",
        *[count(i).alias(f"n_{rules[i].kind}") for i in base],
        F.sha2(F.array_join(F.transform(own, shown), ",").cast("binary"), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", shown), ",").alias("spans"),
    )
