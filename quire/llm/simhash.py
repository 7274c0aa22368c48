"""SimHash near-duplicates: 64-bit fingerprints joined through vantage-point trees."""

from __future__ import annotations

import pickle

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm import textblocks as tb
from quire.llm.common import discard, give_back, map_arrow, materialize, tune
from quire.llm.components import connected_components

SHINGLE = 3
SEED = 42
RADIUS = 3
#: Distinct fingerprints that the upper trees are built from, at most, and the leaves they have, about, where there are trees below them.
TREE_SAMPLE = 1 << 15
TOP_LEAVES = 1 << 10
#: Distinct fingerprints a shard should hold, the points of a sample that stand for them in a lower tree, and the most leaves of
#: all lower trees together, about (32 bytes each are sent to the tasks); beyond that, shards hold more.
SHARD = 8192
LEAF_SAMPLE = 32
MAX_LEAVES = 1 << 20
#: Rows that a task compares, about.
TASK_ROWS = 1 << 13
#: Shards over MAX_SHARD rows whose numbers are sent to every task, at most; more are joined.
MAX_LARGE = 100_000
#: A shard beyond this many rows is compared in blocks by several tasks.
MAX_SHARD = 1 << 16
#: Rows below which a task stops splitting its shard and compares all.
LEAF = 256
_SLICE = 1 << 16


def _fingerprints(column: pa.Array, shingle: int) -> np.ndarray:
    raw, offsets = tb.buffer(column)
    data = tb.ASCII_LOWER[raw]
    mask = tb.NOT_BLANK[data]
    start, end, first = tb.runs(mask, offsets)
    size = end - start
    n = len(start)
    # all words of the batch, each followed by one blank
    flat = np.full(int(size.sum()) + n, 0x20, np.uint8)
    flat[np.arange(int(size.sum())) + np.repeat(np.arange(n), size)] = data[mask]
    begin = np.cumsum(size) - size + np.arange(n)
    stop = begin + size
    flat = flat.tobytes()
    words = np.diff(first)
    count = np.maximum(words - shingle + 1, np.minimum(words, 1))
    bounds = np.concatenate([[0], np.cumsum(count)])
    doc = np.repeat(np.arange(len(words)), count)
    head = first[:-1][doc] + np.arange(bounds[-1]) - bounds[:-1][doc]
    tail = np.minimum(head + shingle, first[1:][doc]) - 1
    votes = np.zeros((len(words), 64), np.int64)
    digest = xxhash.xxh64_intdigest
    for a in range(0, len(head), _SLICE):  # bounded whatever the length of a text
        b = min(a + _SLICE, len(head))
        h = np.array([digest(flat[x:y], SEED) for x, y in zip(begin[head[a:b]].tolist(), stop[tail[a:b]].tolist(), strict=True)], np.uint64)
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        part = doc[a:b]
        cut = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        votes[part[cut]] += np.add.reduceat(bits, cut, axis=0, dtype=np.int32)
    on = 2 * votes > count[:, None]
    return np.packbits(on, axis=1, bitorder="little").view(np.uint64).ravel().view(np.int64)


def fingerprints(docs: DataFrame, keep: list[str], shingle: int = SHINGLE) -> DataFrame:
    """The `keep` columns of each document and its fingerprint `fp` (64 bits in a signed long).

    ASCII capitals are lowered, words are runs of anything but blank and tab to carriage return, shingles are `shingle`
    consecutive words joined by blanks, repeats included (fewer words: all of them; none, or null text: fingerprint 0).
    A bit is set if it is set in over half of the shingles' XXH64 hashes.
    """
    tune(docs.sparkSession)

    def make():
        return lambda batch: {"fp": pa.array(_fingerprints(batch.column(batch.schema.get_field_index("text")), shingle))}

    return map_arrow(docs, make, [("fp", T.LongType())], keep)


def _halves(fp: np.ndarray) -> list[np.ndarray]:
    u = fp.astype(np.int64).view(np.uint64)
    return [(u & np.uint64(0xFFFFFFFF)).astype(np.uint32), (u >> np.uint64(32)).astype(np.uint32)]


def _vantage(points: np.ndarray, reach: int, rng: np.random.Generator) -> tuple[np.uint32, int, int] | None:
    """The point and radius that leave the smaller largest side, copies included; None if no split helps."""
    best = None
    for v in rng.choice(points, size=min(8, len(points)), replace=False):
        d = np.bitwise_count(points ^ v)
        r = int(np.median(d))
        for radius in {r, max(r - 1, 0)}:
            left = int((d <= radius).sum())
            right = len(points) - left + int(((d <= radius) & (d > radius - reach)).sum())
            if left and left < len(points) and (best is None or max(left, right) < best[2]):
                best = (v, radius, max(left, right))
    return best


class Tree:
    """A vantage-point tree over one 32-bit half; leaves are shards.

    If two fingerprints differ in at most 3 bits, one of their halves differs in at most 1. In that half's tree each
    point lives in one leaf (inside or outside of each vantage point's radius). By the triangle bound a partner's
    distance to the vantage point differs by at most `reach`, so an inside point within `reach` of the radius is also
    copied outside, and a copy goes to every side that its ball touches. Every close pair then meets in a leaf.
    """

    def __init__(self, points: np.ndarray, reach: int, smallest: int, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        self.reach = reach
        self.vantage, self.radius, self.child = [], [], []  # child: inside, outside; leaf l as -1 - l
        self.leaves = 0
        if len(points):
            self._grow(points, smallest, rng, 40)
        if not self.vantage:
            self.leaves = 1
        self._freeze()

    def _freeze(self) -> None:
        self.vantage, self.radius = np.array(self.vantage, np.uint32), np.array(self.radius, np.int64)
        self.child = np.array(self.child, np.int64).reshape(-1, 2)

    def graft(self, lower: dict[int, Tree]) -> None:
        """Put a tree in the place of each leaf that `lower` has one for."""
        vantage, radius, child = [self.vantage], [self.radius], [self.child.copy()]
        nodes, leaves = len(self.vantage), 0

        def below(leaf: int) -> int:
            nonlocal nodes, leaves
            tree = lower.get(leaf)
            if tree is None or not len(tree.vantage):
                leaves += 1
                return -leaves
            root = nodes
            vantage.append(tree.vantage)
            radius.append(tree.radius)
            child.append(np.where(tree.child < 0, tree.child - leaves, tree.child + root))
            nodes += len(tree.vantage)
            leaves += tree.leaves
            return root

        top = child[0]
        for at in range(len(top)):
            for side in (0, 1):
                if top[at, side] < 0:
                    top[at, side] = below(int(-1 - top[at, side]))
        if not len(top):
            below(0)
        self.vantage, self.radius, self.child = np.concatenate(vantage), np.concatenate(radius), np.concatenate(child)
        self.leaves = leaves

    def _grow(self, points: np.ndarray, smallest: int, rng: np.random.Generator, depth: int) -> int:
        split = _vantage(points, self.reach, rng) if len(points) > smallest and depth else None
        if split is None or split[2] > 0.9 * len(points):
            self.leaves += 1
            return -self.leaves
        at = len(self.vantage)
        self.vantage.append(split[0])
        self.radius.append(split[1])
        self.child.append([0, 0])
        d = np.bitwise_count(points ^ split[0])
        self.child[at][0] = self._grow(points[d <= split[1]], smallest, rng, depth - 1)
        self.child[at][1] = self._grow(points[d > split[1]], smallest, rng, depth - 1)
        return at

    def route(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index into `points`, leaf and whether it is a copy, for each place a point goes to."""
        n = len(points)
        idx, copy = np.arange(n), np.zeros(n, bool)
        node = np.full(n, 0 if len(self.vantage) else -1)
        vantage, radius, child = self.vantage, self.radius, self.child
        done = []
        while len(idx):
            leaf = node < 0
            done.append((idx[leaf], -1 - node[leaf], copy[leaf]))
            idx, node, copy = idx[~leaf], node[~leaf], copy[~leaf]
            if not len(idx):
                break
            d = np.bitwise_count(points[idx] ^ vantage[node]).astype(int)
            inside = np.where(copy, d <= radius[node] + self.reach, d <= radius[node])
            outside = d > radius[node] - self.reach  # homes outside, and whoever may have a partner there
            twice = inside & outside & ~copy
            parts = [(idx[inside], child[node[inside], 0], copy[inside]), (idx[outside], child[node[outside], 1], (copy | twice)[outside])]
            idx, node, copy = (np.concatenate(x) for x in zip(*parts, strict=True))
        return tuple(np.concatenate(x) for x in zip(*done, strict=True))


def _spanning(fp: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Edges of a forest that joins all points linked by chains of at most `radius` bits each."""
    edges: list[tuple[int, int]] = []
    left = np.arange(len(fp))
    while len(left) > 1:
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            now, front = front[:128], front[128:]
            near = np.bitwise_count(fp[now][:, None] ^ fp[left][None, :]) <= radius
            got = near.any(axis=0)
            if got.any():
                edges += zip(now[near[:, got].argmax(axis=0)].tolist(), left[got].tolist(), strict=True)
                front, left = np.concatenate([front, left[got]]), left[~got]
    return edges


def _shard_edges(fp: np.ndarray, half: np.ndarray, home: np.ndarray, radius: int, reach: int, rng: np.random.Generator) -> list[tuple[int, int]]:
    """Edges among the rows of one shard, splitting it further by vantage points while that helps."""
    if len(fp) > LEAF:
        split = _vantage(half, reach, rng)
        if split is not None:
            v, r, _ = split
            d = np.bitwise_count(half ^ v).astype(int)
            inside = np.where(home, d <= r, d <= r + reach)
            outside = d > r - reach
            if max(inside.sum(), outside.sum()) <= 0.85 * len(fp):  # else its copies outweigh what the split saves
                out = []
                for side, home_here in ((inside, home), (outside, home & (d > r))):
                    at = np.flatnonzero(side)
                    if home_here[at].any():
                        out += [(at[a], at[b]) for a, b in _shard_edges(fp[at], half[at], home_here[at], radius, reach, rng)]
                return out
    return _spanning(fp, radius)


def _forest(nodes: DataFrame, total: int, reach: int) -> list[Tree]:
    """The shard trees of the two halves.

    The upper trees are built from a bounded sample. Where that is too small to tell all shards apart, a lower tree is
    built for each of their leaves, in a task of its own, from a sample of a fixed share of all fingerprints.
    """
    sample = np.array([r.fp for r in nodes.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(TREE_SAMPLE).collect()], np.int64)
    shard = max(SHARD, -(-total // MAX_LEAVES))
    trees = [Tree(h, reach, max(4, int(max(shard, total / TOP_LEAVES) * len(sample) / max(total, 1)))) for h in _halves(sample)]
    if total <= shard * TOP_LEAVES:
        return trees
    upper = nodes.sparkSession.sparkContext.broadcast(trees)

    def place(batches):
        for batch in batches:
            for side, (tree, half) in enumerate(zip(upper.value, _halves(batch.column(0).to_numpy()), strict=True)):
                at, leaf, copy = tree.route(half)
                yield pa.RecordBatch.from_arrays([pa.array(half[at[~copy]].astype(np.int64)), pa.array((leaf[~copy] * 2 + side).astype(np.int64))], names=["half", "shard"])

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = Tree(pdf["half"].to_numpy().astype(np.uint32), reach, LEAF_SAMPLE)
        return pd.DataFrame({"shard": [int(pdf["shard"].iloc[0])], "tree": [pickle.dumps(tree)]})

    some = nodes.select("fp").where(F.pmod(F.xxhash64("fp"), F.lit(1 << 30)) < int(min(1.0, LEAF_SAMPLE / shard) * (1 << 30)))
    grown = some.mapInArrow(place, "half long, shard long").groupBy("shard").applyInPandas(grow, "shard long, tree binary")
    lower: list[dict[int, Tree]] = [{}, {}]
    for r in grown.collect():  # about MAX_LEAVES leaves at most
        lower[r.shard & 1][r.shard >> 1] = pickle.loads(r.tree)
    for tree, below in zip(trees, lower, strict=True):
        tree.graft(below)
    return trees


def _links(nodes: DataFrame, radius: int) -> DataFrame:
    """Edges (u, v) between distinct fingerprints (column fp) that connect all pairs of at most `radius` differing bits."""
    spark = nodes.sparkSession
    reach = radius // 2  # of two halves, one differs in at most half of the bits
    trees = spark.sparkContext.broadcast(_forest(nodes, nodes.count(), reach))

    def route(batches):
        for batch in batches:
            fp = batch.column(0).to_numpy()
            for side, (tree, half) in enumerate(zip(trees.value, _halves(fp), strict=True)):
                at, leaf, copy = tree.route(half)
                yield pa.RecordBatch.from_arrays([pa.array(fp[at]), pa.array((leaf * 2 + side).astype(np.int64)), pa.array(~copy)], names=["fp", "shard", "home"])

    routed = materialize(nodes.select("fp").mapInArrow(route, "fp long, shard long, home boolean"), "simhash-shards")
    sizes = routed.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"))
    large = materialize(sizes.where(F.col("rows") > MAX_SHARD).select("shard", F.ceil(F.col("rows") / MAX_SHARD).cast("int").alias("blocks")), "simhash-large")
    many = large.count()
    blocks = F.coalesce("blocks", F.lit(1))
    placed = routed.join(F.broadcast(large) if many <= MAX_LARGE else large, "shard", "left") if many else routed.withColumn("blocks", F.lit(1))
    placed = placed.select("fp", "shard", "home", blocks.alias("blocks"), F.pmod(F.xxhash64("fp"), blocks).cast("int").alias("block"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    placed = placed.select("fp", "shard", "home", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        fp = pdf["fp"].to_numpy()
        side = int(pdf["shard"].iloc[0]) & 1
        u = fp.view(np.uint64)
        rng = np.random.default_rng(1)
        give_back()
        e = np.array(_shard_edges(u, _halves(fp)[side], pdf["home"].to_numpy(), radius, reach, rng), np.int64).reshape(-1, 2)
        return pd.DataFrame({"u": fp[e[:, 0]], "v": fp[e[:, 1]]})

    # the work follows the rows, which are small: partitions by rows, not merged by their bytes
    placed = placed.repartition(max(1, routed.count() // TASK_ROWS), "shard", "i", "j")
    edges = placed.groupBy("shard", "i", "j").applyInPandas(compare, "u long, v long")
    edges._quire_uses = [routed, large]
    return edges


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: doc_id, fp (signed long) and component_id, and the `keep` columns last.

    Fingerprints of at most `radius` differing bits are linked; component_id is the smallest doc_id reachable over
    links. Copies share a fingerprint and are folded first, so they never meet as pairs. The distinct fingerprints are
    dealt to shards by vantage-point trees; each shard emits a spanning forest of its links, and components are found
    by star contraction. Texts without words (null ones too) have fingerprint zero and are linked like any other.
    Null ids get the component of their fingerprint (null if no row of the component has an id); repeated rows each
    have a result; an empty table gives an empty result; columns not named in `keep` are ignored.
    """
    prints = materialize(fingerprints(docs, ["doc_id", *keep], shingle), "simhash")
    nodes = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-nodes")
    links = _links(nodes, radius)
    comp = connected_components(links)
    for table in links._quire_uses:
        discard(table)
    rooted = nodes.join(comp, nodes.fp == comp.node, "left").select("fp", "first_id", F.coalesce("component", "fp").alias("component"))
    least = rooted.groupBy("component").agg(F.min("first_id").alias("component_id"))
    verdict = rooted.join(least, "component").select("fp", "component_id")
    return prints.join(verdict, "fp").select("doc_id", "fp", "component_id", *keep)


def fingerprint_hex(fp: str = "fp"):
    """The fingerprint as 16 lower-case hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
