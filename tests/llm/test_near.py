"""SimHash near-dedup against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash

from tickloom.llm import simhash_vp as S
from tickloom.llm.components import components


def brute_print(text):
    words = [w for w in re.split("[ \t-\r]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")) if w]
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(nodes, near):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if near(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "q", 1) for i, t in rows], "doc_id long, text string, print string, key int").repartition(3)


def make(seed, n=60):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(n):
        words = [rng.choice(vocab) for _ in range(rng.choice([0, 1, 2, 3, 5, 40, 200, 600]))]
        rows.append(" ".join(words))
        for _ in range(rng.randint(0, 3)):
            words = list(words)
            for _ in range(rng.randint(0, 2)):
                if words:
                    words[rng.randrange(len(words))] = rng.choice(vocab).upper()
            rows.append("\t ".join(words))
    rng.shuffle(rows)
    return [*enumerate(rows), (None, None), (None, "W1 w2"), (5, "w9"), (3, rows[3])]


def test_op2(spark):
    from tickloom.llm.common import hex64  # noqa: F401

    rows = make(1)
    got = S.near_groups(frame(spark, rows), leaf=16).collect()
    assert len(got) == len(rows)
    prints = sorted({brute_print(t) for _, t in rows})
    root = brute_groups(prints, lambda a, b: (a ^ b).bit_count() <= 3)
    ids = {}
    for i, t in rows:
        if i is not None:
            r = root[brute_print(t)]
            ids[r] = min(ids.get(r, i), i)
    want = sorted((str(i), f"{brute_print(t):016x}", ids.get(root[brute_print(t)])) for i, t in rows)
    assert sorted((str(r.doc_id), bytes(r.print).hex(), r.component_id) for r in got) == want
    firsts = {r.first_row for r in got}
    assert len(firsts) == len(set(root.values())) and firsts <= {r.row_no for r in got}
    assert S.near_groups(frame(spark, [])).count() == 0


@pytest.mark.parametrize("bands", [1, 2, 3, 4])
def test_bands_and_boundaries(spark, bands):
    """All links survive sharding, whatever the band's radius; with fewer bands than four, fingerprints go to several leaves."""
    rng = random.Random(bands)
    base = [rng.getrandbits(64) for _ in range(60)]
    values = {b ^ sum(1 << x for x in rng.sample(range(64), rng.randint(0, 6))) for b in base for _ in range(8)} | {0, (1 << 64) - 1, 1}
    nodes = sorted(values)
    classes = spark.createDataFrame([(i, v.to_bytes(8, "big")) for i, v in enumerate(nodes)], "node long, print binary")
    plan = S.Plan(bands=bands)
    got = {r.node: r.root for r in components(S.links(classes, plan, len(nodes), leaf=20)).collect()}
    want = brute_groups(list(range(len(nodes))), lambda a, b: (nodes[a] ^ nodes[b]).bit_count() <= 3)
    assert {i: got.get(i, i) for i in want} == want


def test_large_groups(monkeypatch):
    monkeypatch.setattr(S, "LARGE", 50)
    rng = np.random.default_rng(4)
    mask = (1 << 16) - 1
    x = (rng.integers(0, 1 << 48, 400, dtype=np.uint64) << np.uint64(16)) | np.uint64(7)
    x = np.concatenate([x, x[:200] ^ (np.uint64(1) << rng.integers(16, 64, 200).astype(np.uint64))])
    near = lambda a, b: int(x[a] ^ x[b]).bit_count() <= 3
    want = brute_groups(list(range(len(x))), near)
    root = {i: i for i in want}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in S.shard_links(x.reshape(-1, 1), mask, 0, 3):
        assert near(a, b)
        p, q = find(a), find(b)
        root[max(p, q)] = min(p, q)
    assert {i: find(i) for i in want} == want


def test_components(spark):
    rng = random.Random(9)
    chain = [(i, i + 1) for i in range(1000, 1100)]
    edges = chain + [(rng.randrange(300), rng.randrange(300)) for _ in range(150)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = {frozenset(e) for e in edges}
    nodes = sorted({n for e in edges for n in e if e[0] != e[1]})
    assert got == brute_groups(nodes, lambda a, b: frozenset((a, b)) in linked)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_similarity(spark):
    """Near copies of a similarity of 0.9 or more meet; texts that share half of their shingles don't."""
    rng = random.Random(3)
    vocab = [f"v{i}" for i in range(5000)]
    rows, pairs, apart = [], [], []
    for i in range(40):
        words = [rng.choice(vocab) for _ in range(rng.choice([80, 300, 1000]))]
        near, far = list(words), list(words)
        for k in range(max(1, len(words) // 100)):
            near[rng.randrange(len(words))] = f"x{i}{k}"
        far[: len(words) // 3] = [rng.choice(vocab) for _ in range(len(words) // 3)]
        rows += [(3 * i, " ".join(words)), (3 * i + 1, " ".join(near)), (3 * i + 2, " ".join(far))]
        pairs.append((3 * i, 3 * i + 1))
        apart.append((3 * i, 3 * i + 2))
    group = {r.doc_id: r.component_id for r in S.near_groups(frame(spark, rows), S.similarity_plan(), leaf=50).collect()}
    assert all(group[a] == group[b] for a, b in pairs)
    assert all(group[a] != group[b] for a, b in apart)


def template_family(seed, members=150, pairs=12, own=7, changed=4):
    """Texts that share a template, about 0.6 alike, and with each of the first ones one that is 0.85 alike or more."""
    rng = random.Random(seed)
    template, rows, near = [f"t{i}" for i in range(300)], [], []
    for i in range(members):
        words = list(template)
        for at in rng.sample(range(0, 300, 6), own):
            words[at] = f"o{i}_{at}"
        rows.append((2 * i, " ".join(words)))
        if i < pairs:
            words = [*words]
            for at in rng.sample(range(300), changed):
                words[at] = f"p{i}_{at}"
            rows.append((2 * i + 1, " ".join(words)))
            near.append((2 * i, 2 * i + 1))
    return rows, near


def jaccard(one, two):
    a, b = (set(S.hashes(t, 5).tolist()) for t in (one, two))
    return len(a & b) / len(a | b)


@pytest.mark.parametrize("small", [48, 4])
def test_template_family(spark, monkeypatch, small):
    """Links that the shingle sets refuse don't hide the true ones: groups are those of brute force over all pairs."""
    rows, near = template_family(7)
    text = dict(rows)
    assert all(jaccard(text[a], text[b]) >= 0.85 for a, b in near)
    links = brute_groups(sorted(text), lambda a, b: jaccard(text[a], text[b]) >= 0.8)
    plan = S.similarity_plan()
    prints = np.stack([np.frombuffer(S.fingerprint(t, plan), ">u8").astype(np.uint64) for _, t in rows])
    met = set()
    monkeypatch.setattr(S, "SMALL", small)
    for w, mask in S.masks(plan):
        x = np.roll(prints, -w, axis=1)
        sure, asked = S.sure_links(x, mask, plan)
        open_ = np.array(sorted(asked.tolist()), np.int64)
        unsure = [(open_[u], open_[v]) for u, partners in S.unsure_links(x[open_], open_, mask, plan) for v in partners.tolist()]
        met |= {tuple(sorted((rows[a][0], rows[b][0]))) for a, b in [*np.array(sure).tolist(), *unsure]}
    true = [p for p in near if links[p[0]] == links[p[1]]]
    assert len(true) == len(near) and all(tuple(p) in met for p in near)
    group = {r.doc_id: r.component_id for r in S.near_groups(frame(spark, rows), plan, leaf=50).collect()}
    assert group == links


def test_large_template_family(spark):
    """Band groups over SMALL, of loosely similar texts: no true pair is lost."""
    rows, near = template_family(8, 4000, 200)
    group = {r.doc_id: r.component_id for r in S.near_groups(frame(spark, rows), S.similarity_plan()).collect()}
    assert [p for p in near if group[p[0]] != group[p[1]]] == []


def test_few_shingles(spark):
    """Short texts with a word more or less, down to a similarity of exactly 0.8, are grouped as by brute force."""
    rng = random.Random(11)
    rows = []
    for i in range(150):
        words = [f"s{i}_{k}" for k in range(rng.choice([3, 5, 6, 8, 8, 8, 9, 12, 20, 28]))]
        rows += [" ".join(words), " ".join([*words, "more"]), " ".join([*words, "quite", "other", "ones"])]
    rows += ["the same first words of all and then " + f"c{i}" for i in range(60)]
    rows = [*enumerate(rows)]
    sets = [set(S.hashes(t, 5).tolist()) for _, t in rows]
    want = brute_groups([i for i, _ in rows], lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]))
    got = {r.doc_id: r.component_id for r in S.near_groups(frame(spark, rows), S.similarity_plan()).collect()}
    assert got == want


def test_trees_prune_and_overlap():
    """A pair within the radius meets in some leaf, rows at a boundary go to two, and most branches are pruned."""
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 20_000, dtype=np.uint64) << np.uint64(1)
    mask = (1 << 32) - 1
    tree = S.Tree(base, mask, 500, 0, radius=1)
    flipped = base ^ (np.uint64(1) << rng.integers(0, 32, len(base)).astype(np.uint64))
    leaves = [set() for _ in range(2 * len(base))]
    for leaf, idx in tree.route(np.concatenate([base, flipped])):
        for i in idx.tolist():
            leaves[i].add(leaf)
    assert tree.leaves > 30 and all(leaves[i] & leaves[i + len(base)] for i in range(len(base)))
    copies = sum(map(len, leaves)) / len(leaves)
    assert 1.2 < copies < 4


@pytest.mark.parametrize("size", [300, 3000])
def test_shards(size):
    """Random prints, a dense family and chains, against all pairs."""
    rng = np.random.default_rng(size)
    x = rng.integers(0, 1 << 63, size, dtype=np.uint64)
    centre = x[0]
    family = [int(centre) ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 4), replace=False)) for _ in range(size // 3)]
    chain = [int(x[1]) ^ ((1 << k) - 1) for k in range(0, 60, 3)]
    x = np.unique(np.concatenate([x, np.array(family + chain, np.uint64)]))
    near = np.bitwise_count(x[:, None] ^ x[None, :]) <= 3
    halves = [((1 << 32) - 1), ((1 << 32) - 1) << 32]
    root = list(range(len(x)))

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for mask in halves:
        for a, b in S.shard_links(x.reshape(-1, 1), mask, 1, 3):
            assert near[a, b]
            p, q = find(a), find(b)
            root[max(p, q)] = min(p, q)
    assert all(find(a) == find(b) for a, b in np.argwhere(near))


def test_wide_groups(monkeypatch):
    """Cut by further bits, a large group of unlike texts gives the pairs that comparing all gives."""
    rng = np.random.default_rng(2)
    plan = S.similarity_plan()
    base = rng.integers(0, 1 << 63, (3000, 8), dtype=np.uint64)
    near = base[:600].copy()
    for row in near:
        for bit in rng.choice(512, 78, replace=False):
            row[bit // 64] ^= np.uint64(1) << np.uint64(bit % 64)
    x = np.concatenate([base, near])
    x[:, 0] &= ~np.uint64(0xFFF)
    asked = [(a, b) for a in range(600) for b in [3000 + a] if len(S._bits(x, np.array([a]), np.array([b]), plan)[0])]
    found, dense = S._met(x, 0xFFF, plan)
    met = set(map(tuple, found[:, :2].tolist())) | {(b, a) for a, b in found[:, :2].tolist()}
    assert len(asked) > 550 and sum(p in met for p in asked) >= 0.99 * len(asked) and max(map(len, dense), default=0) < 100
    monkeypatch.setattr(S, "WIDE", 10_000)
    found, dense = S._met(x, 0xFFF, plan)
    assert len(dense) == 1 and len(dense[0]) == len(x)
