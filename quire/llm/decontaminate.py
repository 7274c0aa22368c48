"""Benchmark decontamination by winnowed word fingerprints."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm import textblocks as tb
from quire.llm.common import map_arrow, materialize, named, tune

WINDOW = 13
#: Words of a fingerprinted gram.
GRAM = 5
#: Benchmarks of at most this many bytes of text are sent to every task; larger ones are joined by shuffle.
MAX_BROADCAST_BYTES = 8 << 20
_SPAN = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])


def winnow(grams: np.ndarray, window: int) -> np.ndarray:
    """Indexes of the smallest gram of each `window` consecutive ones (the rightmost of equals).

    Two texts that share window + k - 1 words share all grams of one such window, so they select the same gram of it.
    """
    n = len(grams) - window + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    best, at = grams[:n].copy(), np.arange(n)
    for j in range(1, window):
        other = grams[j : j + n]
        take = other <= best
        best = np.where(take, other, best)
        at = np.where(take, np.arange(j, j + n), at)
    keep = np.zeros(len(grams), bool)
    keep[at] = True
    return np.flatnonzero(keep)


class Words:
    """The words of a batch of texts: lower-cased bytes, spans, hashes, and each text's range of words."""

    def __init__(self, column: pa.Array) -> None:
        raw, offsets = tb.buffer(column)
        self.data = tb.ASCII_LOWER[raw]
        self.start, self.end, self.first = tb.runs(tb.ALNUM_OR_WIDE[self.data], offsets)
        self.hash = tb.span_hash(tb.prefix(self.data), self.start, self.end)

    def spelled(self, a: int, b: int) -> list[bytes]:
        raw = self.data[self.start[a] : self.end[b - 1]].tobytes() if b > a else b""
        base = self.start[a] if b > a else 0
        return [raw[s - base : e - base] for s, e in zip(self.start[a:b], self.end[a:b], strict=True)]


def _grouped(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Word index of each start of k words inside one text, and the hash of these k words."""
    h = tb.gram_hash(words.hash, k)
    room = np.repeat(words.first[1:], np.diff(words.first)) - np.arange(len(h))
    at = np.flatnonzero(room >= k)
    return at, h[at]


def _anchors(words: Words, window: int, short: tuple[int, ...]) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(length, places, hashes) of what a text can be found by: winnowed grams (length 0), and all spans as long as a short item."""
    gram = min(GRAM, window)
    grams = tb.gram_hash(words.hash, gram)
    # winnowed over the whole batch: a window that reaches into the next text can only select more
    places = winnow(grams[: max(0, len(grams) - gram + 1)], window - gram + 1)
    out = [(0, places, grams[places])]
    for k in short:
        at, h = _grouped(words, k)
        out.append((k, at, h ^ np.uint64((k * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)))
    return out


def _places(words: Words, anchors: list[tuple[int, np.ndarray, np.ndarray]], window: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of every window that a found anchor may stand for; all inside one text."""
    starts, lengths = [], []
    for k, at, _ in anchors:
        if not k:
            gram = min(GRAM, window)
            doc = np.searchsorted(words.first, at, side="right") - 1
            s = at[:, None] - np.arange(window - gram + 1)
            fits = (s >= words.first[doc][:, None]) & (s + window <= words.first[doc + 1][:, None])
            at = np.unique(s[fits])
        starts.append(at)
        lengths.append(np.full(len(at), k or window))
    return np.concatenate(starts), np.concatenate(lengths)


def _runs(doc: np.ndarray, item: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Windows of each document and item as maximal covered runs (those that overlap or touch are one)."""
    if not len(doc):
        return doc, item, start, end
    order = np.lexsort((start, item, doc))
    doc, item, start, end = doc[order], item[order], start[order], end[order]
    # all windows of an item have one length, so the ends ascend as well
    new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (start[1:] > end[:-1])])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc)) - 1
    return doc[first], item[first], start[first], end[last]


def _table(bounds: np.ndarray, doc: np.ndarray, item: np.ndarray, start: np.ndarray, end: np.ndarray) -> dict[str, pa.Array]:
    """Result columns from covered runs (word indexes of the batch), ordered by document, item and start."""
    rows = len(bounds) - 1
    depth = np.zeros(bounds[-1] + 1, np.int64)
    np.add.at(depth, start, 1)
    np.add.at(depth, end, -1)
    n_hit = tb.row_sums(np.cumsum(depth[:-1]) > 0, bounds)
    once = np.concatenate([[True], (doc[1:] != doc[:-1]) | (item[1:] != item[:-1])]) if len(doc) else np.zeros(0, bool)
    base = bounds[doc]
    at = lambda d: pa.array(np.searchsorted(d, np.arange(rows + 1)).astype(np.int32))
    spans = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (item, start - base, end - base)], names=["item_id", "start", "end"])
    return {
        "n_words": pa.array(np.diff(bounds)),
        "n_hit": pa.array(n_hit),
        "items": pa.ListArray.from_arrays(at(doc[once]), pa.array(item[once], pa.int64())),
        "spans": pa.ListArray.from_arrays(at(doc), spans),
    }


class Index:
    """Winnowed fingerprints of the benchmark, and the hash and place of each of its windows for the extension of hits."""

    def __init__(self, ids: list[int], texts: list[str | None], window: int = WINDOW) -> None:
        words = Words(pa.array(texts, pa.string()))
        counts = np.diff(words.first)
        self.window = window
        self.short = tuple(int(k) for k in np.unique(counts[(counts > 0) & (counts < window)]))
        long_rows = np.flatnonzero(counts >= window)
        # only whole items of their length count as short ones
        anchors = [_anchors(words, window, ())[0][2]]
        hashes, places, owners = [], [], []
        at, h = _grouped(words, window)
        hashes.append(h)
        places.append(at)
        for k in self.short:
            at, h = _grouped(words, k)
            whole = np.isin(at, words.first[:-1][counts == k])
            hashes.append(h[whole] ^ np.uint64((k * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF))
            places.append(at[whole])
            anchors.append(hashes[-1])
        self.anchor = np.unique(np.concatenate(anchors)) if len(long_rows) or self.short else np.zeros(0, np.uint64)
        self.sieve = np.zeros(1 << 16, bool)
        self.sieve[(self.anchor & np.uint64(0xFFFF)).astype(np.int64)] = True
        hashes, places = np.concatenate(hashes), np.concatenate(places)
        owners = np.array(ids, np.int64)[np.searchsorted(words.first, places, side="right") - 1] if len(ids) else places
        order = np.lexsort((places, owners, hashes))
        hashes, places, owners = hashes[order], places[order], owners[order]
        new = np.concatenate([[True], hashes[1:] != hashes[:-1]]) if len(hashes) else np.zeros(0, bool)
        again = np.concatenate([[True], new[1:] | (owners[1:] != owners[:-1])]) if len(hashes) else np.zeros(0, bool)
        #: per distinct window: hash, a place where it stands, and the range of its items
        self.hash, self.place = hashes[new], places[new]
        self.item = owners[again]
        self.bounds = np.append(np.cumsum(again)[new] - 1, len(self.item)) if len(hashes) else np.zeros(1, np.int64)
        self.words = words

    def find(self, words: Words) -> tuple[np.ndarray, ...]:
        """Document, item id, start and end (word indexes of the batch) of every covered run."""
        none = np.zeros(0, np.int64)
        if not len(self.hash) or not len(words.hash):
            return none, none, none, none
        live = []
        for k, at, h in _anchors(words, self.window, self.short):
            maybe = np.flatnonzero(self.sieve[(h & np.uint64(0xFFFF)).astype(np.int64)])
            spot = np.searchsorted(self.anchor, h[maybe])
            spot[spot == len(self.anchor)] = 0
            good = maybe[self.anchor[spot] == h[maybe]]
            live.append((k, at[good], h[good]))
        start, length = _places(words, live, self.window)
        if not len(start):
            return none, none, none, none
        key = np.zeros(len(start), np.uint64)
        for k in np.unique(length):
            own = length == k
            mark = np.uint64(0 if k == self.window else (int(k) * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
            key[own] = _hash_at(words, start[own], int(k)) ^ mark
        spot = np.searchsorted(self.hash, key)
        spot[spot == len(self.hash)] = 0
        found = np.flatnonzero(self.hash[spot] == key)
        start, length, spot = start[found], length[found], spot[found]
        same = _equal(words, start, self.words, self.place[spot], length)
        start, length, spot = start[same], length[same], spot[same]
        many = self.bounds[spot + 1] - self.bounds[spot]
        row = np.repeat(np.arange(len(start)), many)
        entry = np.repeat(self.bounds[spot], many) + np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
        start, length = start[row], length[row]
        doc = np.searchsorted(words.first, start, side="right") - 1
        return _runs(doc, self.item[entry], start, start + length)


def _hash_at(words: Words, start: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each start."""
    acc = np.zeros(len(start), np.uint64)
    for j in range(k):
        acc = acc * np.uint64(0x100000001B3) + words.hash[start + j]
    return tb.mix(acc)


def _equal(a: Words, at: np.ndarray, b: Words, to: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether the words from `at` in a and from `to` in b are the same bytes."""
    row = np.repeat(np.arange(len(at)), length)
    step = np.arange(len(row)) - np.repeat(np.cumsum(length) - length, length)
    p, q = at[row] + step, to[row] + step
    size = a.end[p] - a.start[p]
    good = size == b.end[q] - b.start[q]
    out = np.ones(len(at), bool)
    out[row[~good]] = False
    p, q, row, size = p[good], q[good], row[good], size[good]
    inside = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    differ = a.data[np.repeat(a.start[p], size) + inside] != b.data[np.repeat(b.start[q], size) + inside]
    out[np.repeat(row, size)[differ]] = False
    return out


_FIELDS = [("n_words", T.LongType()), ("n_hit", T.LongType()), ("items", T.ArrayType(T.LongType())), ("spans", T.ArrayType(_SPAN))]


def overlap(docs: DataFrame, benchmark: DataFrame, keep: list[str], window: int = WINDOW, max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Words of each document that lie in a passage of `window` words shared with a benchmark item.

    Returns the `keep` columns of `docs` with n_words, n_hit, items (ids of items found, ascending) and spans (item_id and
    the range of document words that the item's windows cover). A kept column of such a name gives way to the result. An
    item of fewer words is one window as a whole; items without words match nothing. Null text has no words. Items without
    an id are ignored. An empty table on either side gives no hits. Equal item ids are pooled. Repeated document rows are
    each annotated.

    Winnowed grams of both sides meet; where one is shared, the windows around it are looked up and compared byte by
    byte, which extends the hit to all of the shared span. Short items are looked up as a whole by their length, so they
    don't touch the grams of the others. The benchmark is sent to the tasks only if its text is at most
    `max_broadcast_bytes`, which is checked; otherwise both sides meet in shuffled joins (see _overlap_by_join).
    """
    tune(docs.sparkSession)
    bench = benchmark.where(F.col("item_id").isNotNull() & F.col("text").isNotNull()).select(F.col("item_id").cast("long"), "text")
    size = bench.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    if size > max_broadcast_bytes:
        return _overlap_by_join(docs, bench, keep, window)
    rows = bench.collect()
    index = docs.sparkSession.sparkContext.broadcast(Index([r.item_id for r in rows], [r.text for r in rows], window))

    def make():
        def work(batch: pa.RecordBatch) -> dict:
            words = Words(batch.column(batch.schema.get_field_index("text")))
            return _table(words.first, *index.value.find(words))

        return work

    return map_arrow(docs, make, _FIELDS, keep)


_SHORT = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _overlap_by_join(docs: DataFrame, bench: DataFrame, keep: list[str], window: int) -> DataFrame:
    """The same result for a benchmark of any size, by two joins on fingerprints.

    The first finds, for each distinct text, the anchors that the benchmark has too (no pairs, only the anchors). The
    second joins the digests (MD5 of the words) of the windows around these with those of the benchmark's windows, so a
    row stands for a true hit. Documents are identified by the MD5 of their text, so copies are compared once; equal
    items are folded as well, and the text moves once, to the anchors found in it.
    """
    folded = bench.groupBy(F.md5("text").alias("item")).agg(F.first("text").alias("text"), F.collect_set("item_id").alias("ids"))
    folded = materialize(folded, "items")
    lengths = folded.select(F.size(F.regexp_extract_all("text", F.lit(_SHORT), F.lit(0))).alias("n")).where((F.col("n") > 0) & (F.col("n") < window))
    short = tuple(sorted(r.n for r in lengths.distinct().collect()))  # fewer than `window` numbers

    def anchors(whole: bool):
        def make():
            def work(batch: pa.RecordBatch) -> dict:
                words = Words(batch.column(batch.schema.get_field_index("text")))
                owner, value = [], []
                for k, at, h in _anchors(words, window, short):
                    doc = np.searchsorted(words.first, at, side="right") - 1
                    if whole:  # an item of k words is found by all of them, any other by its grams
                        own = np.diff(words.first)[doc] == k if k else np.diff(words.first)[doc] >= window
                        doc, h = doc[own], h[own]
                    owner.append(doc)
                    value.append(h)
                owner, value = np.concatenate(owner), np.concatenate(value).view(np.int64)
                order = np.lexsort((value, owner))
                owner, value = owner[order], value[order]
                new = np.concatenate([[True], (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])]) if len(owner) else np.zeros(0, bool)
                cuts = np.searchsorted(owner[new], np.arange(batch.num_rows + 1)).astype(np.int32)
                return {"anchors": pa.ListArray.from_arrays(pa.array(cuts), pa.array(value[new]))}

            return work

        return make

    longs = T.ArrayType(T.LongType())
    texts = docs.select(F.md5(F.coalesce("text", F.lit(""))).alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    theirs = map_arrow(folded, anchors(True), [("anchors", longs)], []).select(F.explode("anchors").alias("anchor")).distinct()
    ours = map_arrow(texts, anchors(False), [("anchors", longs)], ["key"]).select("key", F.explode("anchors").alias("anchor"))
    live = ours.join(theirs, "anchor").groupBy("key").agg(F.collect_set("anchor").alias("live"))
    live = materialize(live, "anchors")
    window_type = T.ArrayType(T.StructType([T.StructField("digest", T.BinaryType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType())]))

    def windows(whole: bool):
        def make():
            def work(batch: pa.RecordBatch) -> dict:
                column = batch.column(batch.schema.get_field_index("text"))
                wanted = None if whole else batch.column(batch.schema.get_field_index("live"))
                out = []
                for i in range(batch.num_rows):
                    words = Words(column.slice(i, 1))
                    n = len(words.hash)
                    if whole:
                        k = min(n, window)
                        start = np.arange(n - k + 1) if n else np.zeros(0, np.int64)
                        length = np.full(len(start), k)
                    else:
                        mine = wanted[i].values.to_numpy()
                        found = [(k, at[np.isin(h.view(np.int64), mine)], None) for k, at, h in _anchors(words, window, short)]
                        start, length = _places(words, found, window)
                    spelled = words.spelled(0, n)
                    out.append([{"digest": hashlib.md5(b" ".join(spelled[s : s + k])).digest(), "start": int(s), "length": int(k)} for s, k in zip(start, length, strict=True)])
                return {"windows": out}

            return work

        return make

    mine = map_arrow(texts.dropDuplicates(["key"]).join(live, "key"), windows(False), [("windows", window_type)], ["key"], read=("text", "live"))
    mine = mine.select("key", F.explode("windows").alias("w")).select("key", F.col("w.digest").alias("digest"), F.col("w.start").alias("start"), F.col("w.length").alias("length"))
    items = map_arrow(folded, windows(True), [("windows", window_type)], ["item"]).select("item", F.explode("windows.digest").alias("digest")).distinct()
    hits = mine.join(items, "digest").join(folded.select("item", F.explode("ids").alias("item_id")), "item")
    found = materialize(hits.groupBy("key").agg(F.collect_set(F.struct("item_id", "start", "length")).alias("found")), "hits")

    def merge():
        def work(batch: pa.RecordBatch) -> dict:
            lists = batch.column(batch.schema.get_field_index("found"))
            flat = lists.flatten()
            doc = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
            item, start, length = (flat.field(n).to_numpy().astype(np.int64) for n in ("item_id", "start", "length"))
            reach = np.zeros(batch.num_rows, np.int64)
            np.maximum.at(reach, doc, start + length)
            first = np.concatenate([[0], np.cumsum(reach)])
            start = start + first[doc]
            out = _table(first, *_runs(doc, item, start, start + length))
            return {n: out[n] for n, _ in _FIELDS[1:]}

        return work

    def count():
        return lambda batch: {"n_words": pa.array(np.diff(Words(batch.column(batch.schema.get_field_index("text"))).first))}

    names = [f"__quire_{i}" for i in range(len(keep))]
    rows = docs.select(*[named(c).alias(n) for c, n in zip(keep, names, strict=True)], "text", F.md5(F.coalesce("text", F.lit(""))).alias("__quire_key"))
    counted = map_arrow(rows, count, _FIELDS[:1], [*names, "__quire_key"])
    made = map_arrow(found, merge, _FIELDS[1:], ["key"], read=("found",)).withColumnRenamed("key", "__quire_key")
    joined = counted.join(made, "__quire_key", "left")
    results = {"n_words": F.col("n_words"), "n_hit": F.coalesce("n_hit", F.lit(0))}
    results |= {n: F.coalesce(n, F.array().cast(t)) for n, t in _FIELDS[2:]}
    return joined.select(*[F.col(n).alias(c) for c, n in zip(keep, names, strict=True) if c not in results], *[v.alias(n) for n, v in results.items()])


def contaminated(n_hit: str = "n_hit", n_words: str = "n_words"):
    """At least a twentieth of the words, and one at least, lie in shared passages."""
    return (F.col(n_hit) > 0) & (20 * F.col(n_hit) >= F.col(n_words))


def items_digest(items: str = "items"):
    """SHA-256 of the item ids, sorted as strings and joined by commas."""
    return F.sha2(F.array_join(F.array_sort(F.transform(F.col(items), lambda x: x.cast("string"))), ","), 256)
