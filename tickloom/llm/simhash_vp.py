"""SimHash near-dedup by vantage-point trees over Hamming distance.

Texts are lower-cased (A-Z), words are what blank and 9 to 13 leave, and a text's features are its shingles of words,
hashed by XXH64 with seed 42; a text with fewer words is one feature, a blank or null one has none and fingerprint zero. A
bit of the fingerprint is 1 if it is set in over half of the features' hashes. Fingerprints within the radius are linked, and
a group is what links connect. Rows that repeat an id are rows of their own; null ids come after all others as a group's
smallest id; an empty table gives no rows; only doc_id and text are read.

Search: fingerprints are made distinct first, so copies are never paired. The bits are cut into two halves; of two
fingerprints within radius 3 some half differs in at most one bit, the half's radius. Each half has a vantage-point tree
over the Hamming distance on its bits, fitted on a bounded sample; its leaves are the shards. A fingerprint goes down to its
own leaf, and where it lies inside a boundary by less than the radius, to the outer side too: by the triangle bound
|d(x, v) - d(y, v)| <= d(x, y) a pair within the radius then meets in some leaf, and all other branches are pruned. A shard
goes on in the same way, by smaller trees over the half and, where that has nothing left to tell apart, over all
bits with the whole radius. What is left is compared, and links are reported, of dense groups a spanning forest of them only.

Near copies by similarity of shingle sets (the pipeline's stage) take the same way with longer fingerprints: over 5-word
shingles each of the 512 bits of two texts of Jaccard similarity s differs with probability acos(2 s / (1 + s)) / pi. Two texts
meet if one of 40 bands of 12 or 13 bits is equal, which at s = 0.8 happens for 99.5 % of pairs (a radius that a whole word would
need leaves a tree nothing to prune; that of these bands is 0, so their trees only deal). Of equal bands, a large group of unlike
texts is cut again and again by further bits drawn from all the others, as often as makes all but MISS of the similar pairs meet, so
the comparisons of a text don't grow with the texts as such. A pair that meets is compared on 128 bits, then on all. Pairs whose bits are three deviations on the near side of 0.8 are linked, those as far on the other
side aren't, and for what is left between, unless sure links connect it, the shingle sets themselves are compared. Shards hold all
bits, so they report trees of sure links alone, and which fingerprints have a link that is left between to another tree, in the
first band only that such a pair has in common. These go back to those shards with their shingle sets and the numbers of their
groups of sure links, and every pair of two groups is settled by its sets there, unless links found before connect it. Reported
are, again, trees: no step writes the pairs of a group.

The formula is one for large sets. Pairs of which a text has at most FEW shingles are settled by the sets alone: of two sets of
n and more shingles and similarity s, the first n - ceil(s n) + 1 by the order of hashes have one in common (likewise the
other's), so they meet at one of these, and are compared there.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from .components import components

SEED = 42
#: Fingerprints by which the trees are fitted, at most, and about how many a leaf is to hold.
SAMPLE, LEAF = 1 << 18, 2048
#: Shingles whose bits are counted at a time.
BLOCK = 8192
#: Rows of a shard that are compared with each other at once; more are parted by a tree first.
LARGE = 256
#: Groups of equal bands over this size, of which less than DENSE of the pairs are near, are cut by further bits, into parts of
#: about PART rows, and so often that a pair of the plan's similarity is missed with probability MISS.
WIDE, DENSE, PART, MISS = 1024, 0.25, 16, 1e-4
#: Groups of equal bands up to this size are compared in whole, larger ones by a search that takes out what it reaches.
SMALL = 48
#: Sets up to this size are compared without fingerprints.
FEW = 24


@dataclass(frozen=True)
class Plan:
    """words: 64-bit words of a fingerprint. bands: a word each has so many. radius: over all bits. near: bits that two words
    (a band's own and the next one) may differ in before a pair is compared as a whole; None: one word, which is all.
    similarity: pairs within the radius but beyond `sure` bits are held to this similarity of their shingle sets."""

    shingle: int = 3
    words: int = 1
    bands: int = 2
    radius: int = 3
    distinct: bool = False
    near: int | None = None
    sure: int | None = None
    similarity: float | None = None


EXACT = Plan()


def similarity_plan(similarity: float = 0.8, shingle: int = 5, words: int = 8, bands: int = 5) -> Plan:
    """Radii at which a pair of the similarity is within the bits with three deviations to spare, on either side."""
    bit = math.acos(2 * similarity / (1 + similarity)) / math.pi
    width, other = 64 * words, 128 - -(-64 // bands)
    spread = lambda n: math.sqrt(n * bit * (1 - bit))
    return Plan(shingle, words, bands, round(width * bit + 3 * spread(width)), True, round(other * bit + 3 * spread(other)), round(width * bit - 3 * spread(width)), similarity)


def hashes(text: str, shingle: int) -> np.ndarray:
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    starts = [0]
    for w in words:
        starts.append(starts[-1] + len(w) + 1)
    last = max(1, len(words) - shingle + 1)
    ends = starts[min(shingle, len(words)) :]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a : b - 1], SEED) for a, b in zip(starts[:last], ends)], np.uint64)


def _mixed(h: np.ndarray, word: int) -> np.ndarray:
    """The hash itself for word 0, else another hash of it (a multiply-xorshift finaliser)."""
    if word == 0:
        return h
    h = h + np.uint64(word * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def features(text: str, plan: Plan) -> np.ndarray:
    h = hashes(text, plan.shingle)
    return np.unique(h) if plan.distinct else h


def fingerprint(text: str, plan: Plan) -> bytes:
    """The words of the fingerprint, each big-endian."""
    return _print(features(text, plan), plan)


def _print(h: np.ndarray, plan: Plan) -> bytes:
    counts = np.zeros((plan.words, 64), np.int64)
    for i in range(0, len(h), BLOCK):
        part = h[i : i + BLOCK]
        for w in range(plan.words):
            bits = np.unpackbits(_mixed(part, w).astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
            counts[w] += bits.sum(axis=0, dtype=np.int32)
    return np.packbits(2 * counts > len(h), axis=1).tobytes()


def fingerprints(docs: DataFrame, plan: Plan) -> DataFrame:
    """row_no, doc_id, key (of the text), print, few (with a similarity, the sorted shingles of a set that a set of FEW can be
    similar to): a row per document."""
    text = C.text_of()
    rows = docs.select(F.monotonically_increasing_id().alias("row_no"), F.col("doc_id").cast("long").alias("doc_id"), C.text_key().alias("key"), text.alias("text"))

    most = 0 if plan.similarity is None else int(FEW / plan.similarity + 1e-9)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        C.release()
        for batch in batches:
            prints, few = [], []
            for t in batch.column(3):
                h = features(t.as_py(), plan)
                prints.append(_print(h, plan))
                few.append(h.tobytes() if 0 < len(h) <= most else None)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(prints, pa.binary()), pa.array(few, pa.binary())], ["row_no", "doc_id", "key", "print", "few"])

    return rows.mapInArrow(run, "row_no long, doc_id long, key long, print binary, few binary")


ALL = (1 << 64) - 1


def _bound(own: np.ndarray, mask: int, radius: int, rng) -> tuple[int, int, np.ndarray, np.ndarray] | None:
    """A vantage point, a bound on the distance from it, and who goes inside (d <= bound) and outside (d > bound - radius, so that
    what lies at the boundary goes to both); the best of a few. None if no boundary saves a sixth of the comparisons."""
    best, least = None, 5 / 6 * len(own) ** 2
    for v in rng.choice(own, min(4, len(own)), replace=False):
        d = np.bitwise_count((own ^ v) & np.uint64(mask)).astype(np.int16)
        middle = int(np.median(d))
        for bound in (middle - 1, middle, middle + radius):
            inside, outside = d <= bound, d > bound - radius
            cost = int(inside.sum()) ** 2 + int(outside.sum()) ** 2
            if cost < least and inside.any() and outside.any():
                best, least = (int(v), bound, inside, outside), cost
    return best


class Tree:
    """A vantage-point tree over d(x, v) = bits of (x ^ v) & mask. Children below zero are leaves."""

    def __init__(self, values: np.ndarray, mask: int, leaf: int, seed: int, radius: int = 0):
        rng = np.random.default_rng(seed)
        self.mask, self.radius, self.leaves = np.uint64(mask), radius, 0
        points, bounds, children = [], [], []
        todo = [(values, None, 0)]
        while todo:
            own, parent, side = todo.pop()
            split = _bound(own, mask, radius, rng) if len(own) > leaf else None
            if split is None:
                self.leaves += 1
                at = -self.leaves
            else:
                at = len(points)
                points.append(split[0])
                bounds.append(split[1])
                children.append([0, 0])
                todo += [(own[split[2]], at, 0), (own[split[3]], at, 1)]
            if parent is not None:
                children[parent][side] = at
        self.points, self.bounds = np.array(points, np.uint64), np.array(bounds, np.int16)
        self.children = np.array(children, np.int32).reshape(-1, 2)

    def route(self, x: np.ndarray) -> list[tuple[int, np.ndarray]]:
        """(leaf, positions in x): each x in its own leaf and, from inside, in all that lie within the radius. Two within the radius
        of each other are in one leaf together: at a node both are inside, or both outside, or the inner one goes along."""
        if not len(self.points):
            return [(0, np.arange(len(x)))]
        out, todo = [], [(0, np.arange(len(x)))]
        while todo:
            at, idx = todo.pop()
            if not len(idx):
                continue
            if at < 0:
                out.append((-at - 1, idx))
                continue
            d = np.bitwise_count((x[idx] ^ self.points[at]) & self.mask).astype(np.int16)
            inside, outside = self.children[at].tolist()
            todo += [(inside, idx[d <= self.bounds[at]]), (outside, idx[d > self.bounds[at] - self.radius])]
        return out


def masks(plan: Plan) -> list[tuple[int, int]]:
    """(word, mask) of all bands."""
    edges = [64 * i // plan.bands for i in range(plan.bands + 1)]
    return [(w, ((1 << (b - a)) - 1) << a) for w in range(plan.words) for a, b in zip(edges, edges[1:])]


def fit_trees(classes: DataFrame, plan: Plan, n: int, leaf: int) -> list[Tree]:
    """A tree per band, fitted on the driver on at most SAMPLE fingerprints, 64 bits each of the band's word. The sample only
    decides where the boundaries lie; every fingerprint is dealt and searched."""
    share = min(1.0, SAMPLE / plan.words / max(n, 1))
    got = classes.select("print").sample(fraction=share, seed=SEED).limit(SAMPLE // plan.words).toArrow().column(0)
    some = np.frombuffer(b"".join(v.as_py() for v in got), ">u8").astype(np.uint64).reshape(-1, plan.words)
    per_leaf = max(1, int(leaf * share))
    return [Tree(some[:, w], mask, per_leaf, i, _band_radius(plan)) for i, (w, mask) in enumerate(masks(plan))]


def _band_radius(plan: Plan) -> int:
    """One word: what some band of a pair within the radius is within. More words: a band is to be equal."""
    return plan.radius // plan.bands if plan.words == 1 else 0


def _centre(x: np.ndarray) -> int:
    """The row nearest to the majority of all rows' bits: of copies of one text, that text or what is most like it."""
    bits = np.unpackbits(x.astype(">u8").view(np.uint8).reshape(len(x), -1), axis=1)
    middle = np.packbits(2 * bits.sum(axis=0, dtype=np.int64) > len(x)).view(">u8").astype(np.uint64)
    return int(np.bitwise_count(x ^ middle).sum(axis=1, dtype=np.int64).argmin())


def forest(x: np.ndarray, limit: int) -> list[tuple[int, int]]:
    """Links that connect what links of at most limit bits connect, as trees, the first one from the centre: x has a row of words
    each. What a member reaches is taken out of the search, so a dense group costs a few passes."""
    if not len(x):
        return []
    order = np.arange(len(x))
    first = _centre(x)
    left, out = np.concatenate([[first], order[order != first]]), []
    while len(left):
        todo, left = [left[0]], left[1:]
        while todo and len(left):
            u = todo.pop()
            near = np.bitwise_count(x[left] ^ x[u]).sum(axis=1, dtype=np.int64) <= limit
            found, left = left[near], left[~near]
            out += [(int(u), int(f)) for f in found]
            todo += list(found)
    return out


def _equal_groups(values: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Positions sorted by value, without those whose value is alone, of groups of at most SMALL; and the larger groups."""
    order = np.argsort(values, kind="stable")
    cuts = np.flatnonzero(np.diff(values[order])) + 1
    starts, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(order)]])
    sizes = ends - starts
    large = [order[a:b] for a, b in zip(starts[sizes > SMALL], ends[sizes > SMALL])]
    return order[np.repeat((sizes > 1) & (sizes <= SMALL), sizes)], large


def _spanning(pairs: np.ndarray) -> np.ndarray:
    """Of links, in the order of their distances, those that join two trees: each row keeps its nearest link."""
    root: dict[int, int] = {}

    def find(n: int) -> int:
        while (up := root.get(n, n)) != n:
            root[n] = n = root.get(up, up)
        return n

    keep = []
    for i, (a, b) in enumerate(pairs.tolist()):
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
            keep.append(i)
    return pairs[keep]


def shard_links(x: np.ndarray, mask: int, band_radius: int, limit: int) -> np.ndarray:
    """Links of at most limit bits as pairs of positions, enough to connect all that have any, of rows whose band (in word 0) is
    within its radius. Rows are parted by vantage points as by a tree, over the band, then over all bits; the parts are compared."""
    rng = np.random.default_rng(len(x))
    out, todo = [np.zeros((0, 2), np.int64)], [(np.arange(len(x)), mask, band_radius)]
    while todo:
        idx, by, radius = todo.pop()
        own = x[idx, 0]
        if len(idx) <= LARGE:
            near = np.bitwise_count(own[:, None] ^ own[None, :]) <= limit
            if near.sum() <= 8 * len(idx):
                out.append(idx[np.argwhere(np.triu(near, 1))])
                continue
        elif split := _bound(own, by, radius, rng):
            todo += [(idx[split[2]], by, radius), (idx[split[3]], by, radius)]
            continue
        elif by != ALL:
            todo.append((idx, ALL, limit))
            continue
        out.append(idx[np.array(forest(x[idx], limit), np.int64).reshape(-1, 2)])
    return np.concatenate(out)


def links(classes: DataFrame, plan: Plan, n: int, leaf: int = LEAF) -> DataFrame:
    """a, b: nodes whose fingerprints, of one word, are within the radius; enough links to connect all that are. classes: node, print."""
    bands, band_radius, limit = masks(plan), _band_radius(plan), plan.radius

    def solve(key, shard):
        nodes, x, _ = _members(shard)
        at = shard_links(x, bands[key[0].as_py() % len(bands)][1], band_radius, limit)
        return pa.table({"a": nodes[at[:, 0]], "b": nodes[at[:, 1]]})

    dealt = deal(classes.select("node", "print", F.col("node").alias("root")), plan, fit_trees(classes, plan, n, leaf))
    return dealt.groupBy("shard").applyInArrow(solve, "a long, b long")


def deal(classes: DataFrame, plan: Plan, trees: list[Tree]) -> DataFrame:
    """shard, node, root, own: the words of the fingerprint from the band's on. classes: node, print, root."""
    bands, words = masks(plan), plan.words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            nodes, roots = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            x = np.frombuffer(b"".join(v.as_py() for v in batch.column(1)), ">u8").astype(np.uint64).reshape(-1, words)
            for b, (w, _) in enumerate(bands):
                for leaf_no, idx in trees[b].route(x[:, w]):
                    own = np.roll(x[idx], -w, axis=1).tobytes()
                    own = pa.FixedSizeBinaryArray.from_buffers(pa.binary(8 * words), len(idx), [None, pa.py_buffer(own)]).cast(pa.binary())
                    columns = [pa.array(np.full(len(idx), leaf_no * len(bands) + b, np.int64)), pa.array(nodes[idx]), pa.array(roots[idx]), own]
                    yield pa.RecordBatch.from_arrays(columns, ["shard", "node", "root", "own"])

    return classes.select("node", "print", "root").mapInArrow(run, "shard long, node long, root long, own binary")


def _members(shard: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nodes, fingerprints and roots, in the order of nodes, so that bands choose the same links where they can."""
    nodes = shard.column("node").to_numpy()
    x = np.frombuffer(b"".join(v.as_py() for v in shard.column("own")), np.uint64).reshape(len(nodes), -1)
    order = np.argsort(nodes, kind="stable")
    return nodes[order], x[order], shard.column("root").to_numpy()[order]


def _bits(x: np.ndarray, left: np.ndarray, right: np.ndarray | int, plan: Plan) -> tuple[np.ndarray, np.ndarray]:
    """Positions in left whose rows are within the plan's radii of those of right, and their bits."""
    at = np.flatnonzero(np.bitwise_count(x[left, :2] ^ x[right, :2]).sum(axis=1, dtype=np.int64) <= plan.near)
    bits = np.bitwise_count(x[left[at]] ^ (x[right[at]] if isinstance(right, np.ndarray) else x[right])).sum(axis=1, dtype=np.int64)
    return at[bits <= plan.radius], bits[bits <= plan.radius]


def _small_pairs(x: np.ndarray, values: np.ndarray, order: np.ndarray, plan: Plan) -> np.ndarray:
    """All pairs within the radii in small groups, with their bits: compared at all distances in the sorted order, each at once."""
    out = [np.zeros((0, 3), np.int64)]
    for step in range(1, min(SMALL, len(order))):
        left, right = order[:-step], order[step:]
        same = values[left] == values[right]
        if not same.any():
            break
        left, right = left[same], right[same]
        at, bits = _bits(x, left, right, plan)
        out.append(np.column_stack([left[at], right[at], bits]))
    return np.concatenate(out)


def _first(x: np.ndarray, left: np.ndarray, right: np.ndarray | int, mask: int, word: int | None, plan: Plan) -> np.ndarray:
    """Of pairs with this band equal, those without an equal band before it; x begins with the band's word. No word: all."""
    ok = np.ones(len(left), bool)
    if word is None or not len(left):
        return ok
    apart = x[left] ^ (x[right] if isinstance(right, np.ndarray) else x[right])
    for w, m in masks(plan):
        if (w, m) == (word, mask):
            break
        ok &= (apart[:, (w - word) % plan.words] & np.uint64(m)) != 0
    return ok


def _sure_forest(x: np.ndarray, group: np.ndarray, mask: int, word: int | None, plan: Plan) -> tuple[list[tuple[int, int]], list[int]]:
    """Trees that connect what sure links connect in a group, and the rows with an unsure link to another tree. A tree's rows are
    compared with all that is left when they are reached, so every pair of rows in two trees is compared."""
    left, out, open_ = group, [], []
    while len(left):
        todo, left = [int(left[0])], left[1:]
        tree, loose = [], []
        while todo and len(left):
            u = todo.pop()
            tree.append(u)
            at, bits = _bits(x, left, u, plan)
            found = left[at[bits <= plan.sure]].tolist()
            loose.append(left[at[bits > plan.sure]])
            left = np.delete(left, at[bits <= plan.sure])
            out += [(u, f) for f in found]
            todo += found
        for u, near in zip(tree, loose):
            near = near[np.isin(near, left)]
            near = near[_first(x, near, u, mask, word, plan)]
            if len(near):
                open_ += [u, *near.tolist()]
    return out, open_


def _unlike(x: np.ndarray, group: np.ndarray, plan: Plan) -> bool:
    """Is the group large, and are few of its pairs near, by a sample? It decides how pairs are found, not which."""
    if len(group) <= WIDE:
        return False
    some = x[np.random.default_rng(len(group)).choice(group, 128, replace=False)]
    near = np.bitwise_count(some[:, None, :2] ^ some[None, :, :2]).sum(axis=2, dtype=np.int64) <= plan.near
    return near.mean() < DENSE


def _cut(x: np.ndarray, group: np.ndarray, plan: Plan) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """A large group cut by bits drawn from the words without the band, once and again: the pairs within the radii, with their
    bits, of the small parts, and the parts that are still large."""
    equal = 1 - math.acos(2 * plan.similarity / (1 + plan.similarity)) / math.pi
    drawn = max(1, (len(group) // PART).bit_length() - 1)
    rng, own = np.random.default_rng(drawn), x[group]
    for _ in range(math.ceil(math.log(MISS) / math.log1p(-(equal**drawn)))):
        at = rng.choice(64 * (x.shape[1] - 1), drawn, replace=False)
        values = np.zeros(len(group), np.uint64)
        for w in np.unique(at // 64).tolist():
            picked = sum(1 << int(b) for b in at[at // 64 == w] % 64)
            values = _mixed(values ^ (own[:, w + 1] & np.uint64(picked)), w + 1)
        order, large = _equal_groups(values)
        pairs = _small_pairs(own, values, order, plan)
        pairs[:, :2] = group[pairs[:, :2]]
        yield pairs, [group[g] for g in large]


def _met(x: np.ndarray, mask: int, plan: Plan) -> tuple[np.ndarray, list[np.ndarray]]:
    """Pairs within the radii, with their bits, of rows of equal bands, from small groups; the groups that are still to be compared."""
    values = x[:, 0] & np.uint64(mask)
    order, large = _equal_groups(values)
    found, dense = [_small_pairs(x, values, order, plan)], []
    for group in large:
        if not _unlike(x, group, plan):
            dense.append(group)
            continue
        for pairs, parts in _cut(x, group, plan):
            found.append(pairs)
            dense += parts
    return np.concatenate(found), dense


def sure_links(x: np.ndarray, mask: int, plan: Plan, word: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows that connect what sure links connect among rows of equal bands; the rows with an unsure link to another tree
    (with the band's word: only if no band before is equal too)."""
    found, dense = _met(x, mask, plan)
    pairs = np.unique(found, axis=0)
    pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0], pairs[:, 2]))]
    sure = pairs[:, 2] <= plan.sure
    tree = _spanning(pairs[sure, :2])
    root = _tree_of(len(x), tree)
    unsure = pairs[~sure, :2]
    unsure = unsure[root[unsure[:, 0]] != root[unsure[:, 1]]]
    out, open_ = [tree], [unsure[_first(x, unsure[:, 0], unsure[:, 1], mask, word, plan)].reshape(-1)]
    for group in dense:
        own, asked = _sure_forest(x, group, mask, word, plan)
        out.append(np.array(own, np.int64).reshape(-1, 2))
        open_.append(np.array(asked, np.int64))
    return np.concatenate(out), np.unique(np.concatenate(open_))


def _tree_of(n: int, pairs: np.ndarray) -> np.ndarray:
    root = np.arange(n)
    for a, b in pairs.tolist():
        while root[a] != a:
            a = root[a]
        while root[b] != b:
            b = root[b]
        root[max(a, b)] = min(a, b)
    while (root[root] != root).any():
        root = root[root]
    return root


def unsure_links(x: np.ndarray, roots: np.ndarray, mask: int, plan: Plan, word: int | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """All pairs of rows within the radii that have equal bands (with the band's word: and no equal band before) and different
    roots: a row and its partners."""
    found, dense = _met(x, mask, plan)
    pairs = np.unique(found[:, :2], axis=0)
    pairs = pairs[roots[pairs[:, 0]] != roots[pairs[:, 1]]]
    pairs = pairs[_first(x, pairs[:, 0], pairs[:, 1], mask, word, plan)]
    if len(pairs):
        for own in np.split(pairs, np.flatnonzero(np.diff(pairs[:, 0])) + 1):
            yield int(own[0, 0]), own[:, 1]
    for group in dense:
        for i, u in enumerate(group[:-1].tolist()):
            left = group[i + 1 :]
            left = left[roots[left] != roots[u]]
            left = left[_bits(x, left, u, plan)[0]]
            left = left[_first(x, left, u, mask, word, plan)]
            if len(left):
                yield u, left


def settled(pairs: Iterator[tuple[int, np.ndarray]], roots: np.ndarray, sets: list[np.ndarray], least: float) -> list[tuple[int, int]]:
    """Links (pairs of rows) that connect, beyond equal roots, what pairs whose sets have at least the similarity connect."""
    ids = np.unique(np.concatenate([np.zeros(0, np.uint64), *sets]), return_inverse=True)[1]
    ends = np.cumsum([len(v) for v in sets])
    own = [ids[e - len(v) : e] for v, e in zip(sets, ends)]
    marked = np.zeros(len(ids) + 1, bool)
    up: dict[int, int] = {}

    def find(n: int) -> int:
        while (to := up.get(n, n)) != n:
            up[n] = n = up.get(to, to)
        return n

    out = []
    for u, partners in pairs:
        marked[own[u]] = True
        at = find(int(roots[u]))
        for v in partners.tolist():
            to = find(int(roots[v]))
            if at == to:
                continue
            common = int(np.count_nonzero(marked[own[v]]))
            if common >= least * (len(own[u]) + len(own[v]) - common):
                out.append((u, v))
                at, up[max(at, to)] = min(at, to), min(at, to)
        marked[own[u]] = False
    return out


def few_forest(sets: list[np.ndarray], least: float) -> list[tuple[int, int]]:
    """Trees that connect what pairs of at least the similarity connect; the sets hold no value twice."""
    sizes = np.array([len(v) for v in sets], np.int64)
    left, out = np.arange(len(sets)), []
    table = np.zeros((len(sets), sizes.max(initial=0)), np.uint64)
    for i, v in enumerate(sets):
        table[i, : len(v)] = v
    held = np.arange(table.shape[1]) < sizes[:, None]
    while len(left) > 1:
        todo, left = [int(left[0])], left[1:]
        while todo and len(left):
            u = todo.pop()
            common = (np.isin(table[left], sets[u]) & held[left]).sum(axis=1)
            near = common >= least * (sizes[left] + sizes[u] - common)
            found, left = left[near].tolist(), left[~near]
            out += [(u, f) for f in found]
            todo += found
    return out


def few_links(few: DataFrame, plan: Plan, n: int) -> DataFrame:
    """a, b: nodes whose sets have the plan's similarity; enough to connect all that have. few: node, few (sorted shingles)."""
    least, shards = plan.similarity, n // LEAF + 1

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {"shard": [], "gram": [], "node": [], "own": []}
            for node, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                h = np.frombuffer(own, np.uint64)
                for gram in h[: len(h) - math.ceil(least * len(h) - 1e-9) + 1].tolist():
                    out["shard"].append(gram % shards)
                    out["gram"].append(gram - (1 << 63))
                    out["node"].append(node)
                    out["own"].append(own)
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("shard", pa.int64()), ("gram", pa.int64()), ("node", pa.int64()), ("own", pa.binary())]))

    def solve(key, shard):
        grams, nodes, own = shard.column("gram").to_numpy(), shard.column("node").to_numpy(), shard.column("own")
        order = np.lexsort((nodes, grams))
        a, b = [], []
        for group in np.split(order, np.flatnonzero(np.diff(grams[order])) + 1):
            if len(group) > 1:
                for x, y in few_forest([np.frombuffer(own[int(i)].as_py(), np.uint64) for i in group], least):
                    a.append(nodes[group[x]])
                    b.append(nodes[group[y]])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return few.select("node", "few").mapInArrow(prefixes, "shard long, gram long, node long, own binary").groupBy("shard").applyInArrow(solve, "a long, b long")


def similar_links(docs: DataFrame, classes: DataFrame, plan: Plan, n: int, leaf: int = LEAF) -> DataFrame:
    """a, b: nodes of texts of the plan's similarity; enough links to connect all that meet. classes: node, doc_id, key, print, few."""
    short = few_links(classes.where("few is not null"), plan, n)
    classes = classes.where(F.coalesce(F.length("few"), F.lit(8 * FEW + 1)) > 8 * FEW)  # the rest is settled
    trees, bands = fit_trees(classes, plan, n, leaf), masks(plan)

    def first(key, shard):
        nodes, x, _ = _members(shard)
        number = key[0].as_py()
        word, mask = bands[number % len(bands)]
        at, asked = sure_links(x, mask, plan, word)
        none = np.full(len(at), -1, np.int64)
        return pa.table({"a": np.concatenate([nodes[at[:, 0]], nodes[asked]]), "b": np.concatenate([nodes[at[:, 1]], nodes[asked]]), "shard": np.concatenate([none, np.full(len(asked), number, np.int64)])})

    def second(key, shard):
        shard = shard.sort_by("node")
        word, mask = bands[key[0].as_py() % len(bands)]
        nodes, roots = shard.column("node").to_numpy(), shard.column("root").to_numpy()
        x = np.frombuffer(b"".join(v.as_py() for v in shard.column("print")), ">u8").astype(np.uint64).reshape(len(nodes), -1)
        x = np.roll(x, -word, axis=1)
        sets = [np.frombuffer(v.as_py(), np.uint64) for v in shard.column("own")]
        at = np.array(settled(unsure_links(x, roots, mask, plan, word), roots, sets, plan.similarity), np.int64).reshape(-1, 2)
        return pa.table({"a": nodes[at[:, 0]], "b": nodes[at[:, 1]]})

    alone = classes.select("node", "print", F.col("node").alias("root"))
    found = C.spool(deal(alone, plan, trees).groupBy("shard").applyInArrow(first, "a long, b long, shard long"), "links")
    sure = C.spool(found.where("shard < 0").select("a", "b").union(short), "sure")
    asked = found.where("shard >= 0").select(F.col("a").alias("node"), "shard")
    sets = shingle_sets(docs, classes.join(asked.select("node").distinct(), "node"), plan)
    open_ = asked.join(classes.select("node", "print"), "node").join(components(sure), "node", "left").join(sets, "node")
    open_ = open_.select("shard", "node", F.coalesce("root", "node").alias("root"), "print", "own")
    settled_ = open_.groupBy("shard").applyInArrow(second, "a long, b long")
    return C.spool(sure.union(settled_), "links")


def shingle_sets(docs: DataFrame, nodes: DataFrame, plan: Plan) -> DataFrame:
    """node, own (sorted hashes of the shingles, 8 bytes each): the sets of the texts of nodes (node, doc_id, key)."""
    wanted = C.spool(nodes.select("doc_id", "key", "node"), "asked")
    texts = C.matching(docs.select("doc_id", "text"), wanted, "inner").select("node", C.text_of().alias("text"))
    shingle = plan.shingle

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.slices(batches):
            own = [np.unique(hashes(t.as_py(), shingle)).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own, pa.binary())], ["node", "own"])

    return C.spool(texts.mapInArrow(sets, "node long, own binary").dropDuplicates(["node"]), "shingles")


def near_groups(docs: DataFrame, plan: Plan = EXACT, leaf: int = LEAF) -> DataFrame:
    """row_no, doc_id, key, print, component_id (the group's smallest doc_id), group (a number of the group), first_row (the row_no
    of the row that stands for it: the smallest doc_id, then the first of its rows): a row per document."""
    rows = C.spool(fingerprints(docs, plan), "prints")
    total = rows.count()
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_no"))
    classes = rows.groupBy("print").agg(first.alias("first"), F.min(F.struct("row_no", "doc_id", "key", "few")).alias("row"), F.count(F.lit(1)).alias("size"))
    classes = C.spool(classes.select("print", "first", F.col("row.row_no").alias("node"), F.col("row.doc_id").alias("doc_id"), F.col("row.key").alias("key"), F.col("row.few").alias("few"), "size"), "classes")
    if plan.similarity is None:
        found = C.spool(links(classes, plan, classes.count(), leaf), "links")
    else:
        found = similar_links(docs, classes, plan, classes.count(), leaf)
    linked = components(found).withColumnRenamed("root", "group")
    joined = C.spool(classes.drop("doc_id", "key", "few").join(linked, "node", "left").withColumn("group", F.coalesce("group", "node")), "grouped")
    heads = joined.groupBy("group").agg(F.min("first").alias("head"))
    known = joined.join(heads, "group").select("print", "size", "group", F.col("head.doc_id").alias("component_id"), F.col("head.row_no").alias("first_row"))
    return C.attach(rows.drop("few"), C.spool(known, "known"), "print", "size", total).drop("size")
