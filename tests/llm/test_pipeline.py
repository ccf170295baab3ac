"""The pipeline's stages against brute force, each on what its predecessor kept."""

import random
import re
from array import array
from collections import Counter

import pytest

import corpus_pipeline as P
from tickloom.llm import bpe, mixing
from tickloom.llm import simhash_vp as S
from tickloom.llm import toxicity as X


def squeeze(t):
    return re.sub("[ \t-\r]", "", t or "")


def shingles(t):
    w = (t or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Planted: exact copies, near copies, toxic documents, odd rows; labels for some."""
    rng = random.Random(8)
    vocab = [f"word{i}" for i in range(3000)]
    rows, toxic = [], set()
    for i in range(200):
        words = [rng.choice(vocab) for _ in range(rng.choice([30, 200, 500]))]
        if i % 9 == 0:
            toxic.add(len(rows))
            for _ in range(4):
                words.insert(rng.randrange(len(words)), rng.choice(["idiot", "moron", "scum", "quxel"]))
        rows.append(" ".join(words))
        if i % 10 == 1:
            rows.append("\n".join(words))
        if i % 10 == 2 and len(words) > 100:
            words[rng.randrange(50, len(words))] = "changed"
            rows.append(" ".join(words))
    docs = [(i, t, "en", f"src{i % 4 if i % 3 else 0}", len(t), "x") for i, t in enumerate(rows)]
    docs += [(9000, None, None, None, None, "y"), (9001, "", "en", None, 0, "y"), (9002, "last " * 9000, "en", "src1", 1, "z"), (9003, rows[5], "en", "src1", 1, "z"), (9003, rows[5], "en", "src1", 1, "z")]
    at = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long, _mark string").write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i in toxic)) for i in range(len(rows)) if i % 4], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return at, docs, toxic


def test_stages(spark, corpus):
    at, rows, toxic = corpus
    docs = spark.read.parquet(f"{at}/documents.parquet")
    names = docs.columns
    steps = []
    for name, stage in P.STAGES:
        docs = P.C.spool(stage(spark, docs, at), "step")
        steps.append(docs.collect())
        assert name == "bpe" or docs.columns == names
    clean, single, apart, mixed, tokens = steps
    # toxicity: what the scorer rejects goes, and that is the planted documents
    kept = {r.doc_id for r in clean}
    gone = {r[0] for r in rows} - kept
    assert len(gone & toxic) >= 0.9 * len(toxic) and len(gone - toxic) <= 3
    # exact dedup: the longest original, then the smallest id, of each group
    best = {}
    for r in clean:
        key = (-len(r.text or ""), r.doc_id)
        best[squeeze(r.text)] = min(best.get(squeeze(r.text), key), key)
    assert sorted(r.doc_id for r in single) == sorted(i for _, i in best.values())
    # near-dedup: no two similar ones are left, and one of each group is
    found = {r.doc_id: shingles(r.text) for r in apart}
    ids = sorted(found)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            assert len(found[a] & found[b]) < 0.8 * len(found[a] | found[b]) or not found[a]
    for r in single:
        own = shingles(r.text)
        if r.doc_id not in found:
            assert any(len(own & f) >= 0.8 * len(own | f) for f in found.values())
    # mixing: as often as the mix takes a document
    frame = spark.createDataFrame(apart, docs_schema(spark, at))
    taken = {r.doc_id: int(r.taken / max(r.size, 1) + 0.5) for r in mixing.mix_counts(frame).collect()}
    assert Counter(r.doc_id for r in mixed) == Counter({i: n for i, n in taken.items() if n})
    assert set(taken.values()) <= {0, 1, 2}
    # tokens
    encode = bpe.Encoder(P.RANKS, P.PATTERN).encode
    texts = {r.doc_id: r.text for r in apart}
    assert len(tokens) == len(mixed)
    for r in tokens:
        assert bytes(r.ids) == encode(texts[r.doc_id] or "") and r.exact and r.n_tokens == len(array("I", bytes(r.ids)))


def docs_schema(spark, at):
    return spark.read.parquet(f"{at}/documents.parquet").schema


def test_run(spark, corpus):
    at, rows, _ = corpus
    got = P.run(spark, at)
    assert got.columns == ["doc_id", "lang", "source", "n_tokens", "ids", "exact"] and got.count() > 100
    assert P.ORACLE_SQL is None and [n for n, _ in P.STAGES] == ["toxicity", "exact dedup", "simhash near-dedup", "mixing", "bpe"]


def test_nothing(spark, corpus, tmp_path):
    at, _, _ = corpus
    for t in ("documents", "labels"):
        spark.read.parquet(f"{at}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0


def test_model_of_the_stage(spark, corpus):
    at, _, _ = corpus
    model = X.fit(spark.read.parquet(f"{at}/documents.parquet"), spark.read.parquet(f"{at}/labels.parquet"))
    assert "quxel" in model.words or any("quxel".startswith(s) for s in model.stems)
    plan = S.similarity_plan()
    assert plan.sure < 78 < plan.radius and len(S.masks(plan)) == 40
