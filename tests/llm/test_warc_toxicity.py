"""WARC round trips and the loser tree; the toxicity grammar, and accuracy on held-out rows."""

import gzip
import hashlib
import math
import random
import zlib

import pytest

from tickloom.llm import common as C
from tickloom.llm import toxicity as X
from tickloom.llm import warc as W


def test_loser_tree():
    rng = random.Random(1)
    for k in [0, 1, 2, 3, 5, 8, 13]:
        runs = [sorted(rng.randrange(50) for _ in range(rng.randrange(20))) for _ in range(k)]
        assert list(W.LoserTree(map(iter, runs))) == sorted(x for r in runs for x in r)


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", 0) for i, u, h in rows], "page_id long, url string, html string, digest string, refers_to int").repartition(4)


def make():
    rng = random.Random(4)
    big = ["é" * 500 + f"\r\n\r\n{i}" for i in range(6)]
    rows = [(i, f"http://{'www.' * (i % 2)}h{i % 5}.Example.com:{80 + i % 2}/p{i % 7}?q=1#f", rng.choice([*big, *big, "small", "", None, "x" * 999, "y" * 1000])) for i in range(200)]
    return [*rows, (None, None, big[0]), (None, "not a url [", "odd"), (900, "u", big[1]), (900, "u", big[1]), (901, "", "z" * 200_000), (5, "u", "z" * 200_000)]


@pytest.mark.parametrize("fan", [2, 64])
def test_round_trip(spark, monkeypatch, fan):
    monkeypatch.setattr(W, "RUN", 9)
    rows, out = make(), C.fresh_path(spark, "warc")
    runs = W.write_archives(pages(spark, rows), out)
    assert runs.count() > 10
    history = W.merge_runs(runs, out, fan, range_captures=20)
    ordered = [(r.url_key, r.timestamp) for r in history.orderBy("range_no", "nth").collect()]
    assert ordered == sorted(ordered) and len(ordered) == len(rows) and history.select("range_no").distinct().count() > 3
    got = W.read_records(history).collect()
    best = {}
    for i, _, h in rows:
        if i is not None and len((h or "").encode()) >= 1000:
            best[h] = max(best.get(h, i), i)
    want = []
    for i, _, h in rows:
        data = (h or "").encode()
        refers = best.get(h) if best.get(h) != i else None
        want.append((str(i), len(data), hashlib.sha1(data).hexdigest(), "revisit" if refers is not None else "response", refers))
    key = lambda r: tuple(map(str, r))
    assert sorted([(str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got], key=key) == sorted(want, key=key)


def test_archives_are_gzip_members(spark):
    row = {"page_id": 7, "url": "http://a.b/c", "payload": b"body"}
    data = zlib.compressobj(1, zlib.DEFLATED, 31)
    packed = data.compress(W.record(7, "http://a.b/c", b"body", None)) + data.flush()
    assert gzip.decompress(packed).startswith(b"WARC/1.1\r\nWARC-Type: response")
    found = W.parse(gzip.decompress(packed))
    assert all(found[k] == v for k, v in row.items()) and W.parse(W.record(8, None, b"x" * 2000, 7))["payload_bytes"] == 2000
    with pytest.raises(ValueError):
        W.parse(W.record(7, "u", b"body", None).replace(b"body", b"bodi"))


def test_no_pages(spark):
    assert W.round_trip(pages(spark, []), C.fresh_path(spark, "warc")).count() == 0


def test_url_keys():
    assert W.url_key("https://www.B.a:443/X?y#z") == "a,b)/x?y" == W.url_key("http://b.a/x?Y")
    assert W.url_key("http://b.a:81") == "a,b:81)/" and W.url_key(None) == "-"


def test_grammar():
    def clause(text):
        return X.Scorer(X.Model()).features(text)[1]

    assert clause("you are an idiot") > clause("what an idiot") > clause("he is not an idiot") > 0 == clause("a kind word")
    assert clause("the report said: idiot") == clause("idiot") > clause("he said that you idiot there") / 1.5
    assert clause("i will kill you") > clause("i kill time") and clause("not a b c idiot") == clause("idiot")
    assert X.Scorer(X.Model()).features("you are fine. idiot")[1] == clause("idiot")
    assert clause("") == 0


def by_hand(words):
    """A clause's score without machines: each insult and threat word looks for what aims, negates or intends it."""
    kinds, n = [X.FIXED.get(w, X.O) for w in words], len(words)
    insult = [k == X.I1 and X.N not in kinds[max(0, i - X.REACH) : i] for i, k in enumerate(kinds)]
    aimed, reach = [False] * n, -1
    for i in range(n):
        if kinds[i] == X.T:
            reach = i + X.AIM
        elif insult[i] and i <= reach:
            aimed[i], reach = True, max(reach, i + X.BACK)
    for i in range(n):
        if insult[i] and not aimed[i]:
            after = [j for j in range(i + 1, min(n, i + 1 + X.BACK)) if kinds[j] == X.T or insult[j]]
            aimed[i] = bool(after) and kinds[after[0]] == X.T
    base = 0.0
    for i in range(n):
        if insult[i]:
            base += 0.5 if aimed[i] else 0.25
        elif kinds[i] == X.I1:
            base += 0.1
        elif kinds[i] == X.K and X.W in kinds[:i]:
            base += 2
    return base * (1.5 if X.T in kinds else 1) * (0.4 if X.R in kinds else 1)


def test_clauses_by_hand():
    rng = random.Random(5)
    some = ["you", "not", "said", "will", "kill", "idiot", "scum", "word", "other", "are"]
    scorer = X.Scorer(X.Model())
    for _ in range(4000):
        clauses = [rng.choices(some, k=rng.randrange(1, 12)) for _ in range(rng.randrange(1, 4))]
        scores = [by_hand(c) for c in clauses]
        got = scorer.features(". ".join(" ".join(c) for c in clauses))
        assert got[1] == pytest.approx(max(scores), abs=1e-12), clauses
        assert math.exp(got[0]) + math.exp(got[4]) - 2 == pytest.approx(sum(scores), abs=1e-9), clauses


def test_lone_words_are_no_match():
    scorer = X.Scorer(X.Model())
    alone, aimed = scorer.features("idiot idiot idiot"), scorer.features("you idiot, you scum like them")
    assert alone[0] == alone[2] == alone[3] == 0 < alone[4] and aimed[4] == aimed[5] == 0 < aimed[0]
    assert scorer.score("idiot idiot idiot") < 0.2 < 0.5 < scorer.score("you idiot. you worthless scum. i will kill you")
    assert scorer.features("kill time") == (0,) * 6


def test_composition():
    flip = X.Machine(0, lambda s, a: (s, 1 - a, 0.5))
    count = X.Machine(0, lambda s, a: (min(2, s + a), a, float(a)))
    table = flip.then(count).table(range(2))
    state, outs, weight = 0, [], 0.0
    for a in [0, 1, 0, 0]:
        state, out, w = table[state][a]
        outs.append(out)
        weight += w
    assert outs == [1, 0, 1, 1] and weight == 4 * 0.5 + 3 and len(table) == 3


def test_scores(spark, sf):
    docs, labels = spark.read.parquet(f"{sf[:-5]}0.1/documents.parquet"), spark.read.parquet(f"{sf[:-5]}0.1/labels.parquet")
    rows = X.score_documents(docs, X.fit(docs, labels)).join(labels, "doc_id").where("held_out").collect()
    hit = sum((r.score >= 0.5) == (r.toxic == 1) for r in rows) / len(rows)
    pos, neg = [r.score for r in rows if r.toxic], [r.score for r in rows if not r.toxic]
    auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / len(pos) / len(neg)
    assert hit > 0.97 and auc > 0.94
    for r in rows[:200]:
        assert r.predicted == (r.score >= 0.5) and (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) == r.held_out


def test_odd_rows(spark):
    odd = [(1, None), (2, ""), (3, "\n\n"), (None, "idiot"), (3, "you idiot scum, you worthless moron! " * 9), (5, "word " * 30000)]
    docs = spark.createDataFrame([(i, t, 1.0) for i, t in odd], "doc_id long, text string, score double")
    none = spark.createDataFrame([], "doc_id long, toxic int, score int")
    got = X.score_documents(docs, X.fit(docs, none)).collect()
    assert len(got) == 6 and all(0 < r.score < 1 for r in got)
    assert [r.predicted for r in got if r.doc_id == 3] == [0, 1]
    some = spark.createDataFrame([(1, 1, None), (None, 1, 1), (2, None, 1), (3, 0, 1)], "doc_id long, toxic int, score int")
    assert X.score_documents(docs, X.fit(docs, some)).count() == 6
    assert X.score_documents(docs.limit(0), X.fit(docs.limit(0), some)).count() == 0
