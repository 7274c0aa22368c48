"""Repeated substrings by a depth-limited radix sort of suffixes, and their removal."""

from __future__ import annotations

import hashlib
import pickle

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm import textblocks as tb
from quire.llm.common import discard, give_back, map_arrow, materialize, named, tune

#: Threshold in bytes: repeated strings of this length are removed.
DEPTH = 50
#: Bytes of the first radix digit: the gram with the smallest hash among those of a window.
DIGIT = 24
#: Bytes of text of a block, the unit that first digits are folded in; small enough for a row of it to be no burden on the JVM.
BLOCK = 384 << 10
#: Bytes of text per bucket of the first pass (hashes only) and of the further ones (the bytes that repeat).
DIGIT_BUCKET = 32 << 20
BUCKET = 6 << 20
#: A first digit that more than HOT blocks hold, and more than a quarter of all, is folded by groups of FAN blocks, level by level,
#: before all of it meets; a rarer one would hardly meet itself in such a group.
HOT = 64
FAN = 64


def _rolling(sums: np.ndarray, width: int) -> np.ndarray:
    """Hash of the `width` bytes from each position (slices only: this runs over every byte)."""
    h = sums[width:] - sums[:-width]
    h *= tb.inverse_powers(len(h))
    return tb.mix(h)


def _sliding_min(values: np.ndarray, span: int) -> np.ndarray:
    """Minimum of each `span` values that follow each other, by doubling."""
    width = 1
    while 2 * width <= span:
        values = np.minimum(values[:-width], values[width:])
        width *= 2
    return values if width == span else np.minimum(values[: len(values) - (span - width)], values[span - width :])


class Suffixes:
    """All windows of `depth` bytes of a block of texts (start, text), and runs of neighbours with one first digit."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, depth: int, digit: int) -> None:
        self.data = data
        self.sums = tb.prefix(data)
        count = np.maximum(np.diff(offsets) - depth + 1, 0)
        self.doc = np.repeat(np.arange(len(count)), count)
        self.at = np.arange(len(self.doc)) + np.repeat(offsets[:-1] - np.cumsum(count) + count, count)
        if not len(self.at):
            self.gram, self.anchor, self.spot = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
            return
        gram = _sliding_min(_rolling(self.sums, digit), depth - digit + 1)[self.at]
        new = np.concatenate([[True], (gram[1:] != gram[:-1]) | (self.doc[1:] != self.doc[:-1])])
        self.anchor = np.cumsum(new) - 1
        self.gram, self.spot = gram[new], self.doc[new]


def smaller(data: np.ndarray, sums: np.ndarray, at: np.ndarray, doc: np.ndarray, depth: int) -> np.ndarray:
    """For each window, whether the same bytes also start in a document of smaller id.

    Two most-significant-digit passes of half the depth each: after the first, groups of one document are settled; only
    the rest is ordered by the second digit. Members of a group are compared with its first one byte by byte.
    """
    out = np.zeros(len(at), bool)
    if not len(at):
        return out
    half = depth // 2
    digit = tb.span_hash(sums, at, at + half)
    order = np.argsort(digit, kind="stable")
    d = digit[order]
    new = np.concatenate([[True], d[1:] != d[:-1]])
    group = np.cumsum(new) - 1
    begin = np.flatnonzero(new)
    low, high = np.minimum.reduceat(doc[order], begin), np.maximum.reduceat(doc[order], begin)
    live = (low < high)[group]
    order, group = order[live], group[live]
    if not len(order):
        return out
    second = tb.span_hash(sums, at[order] + half, at[order] + depth)
    again = np.lexsort((doc[order], second, group))
    order, group, second = order[again], group[again], second[again]
    new = np.concatenate([[True], (group[1:] != group[:-1]) | (second[1:] != second[:-1])])
    head = order[np.flatnonzero(new)][np.cumsum(new) - 1]
    later = doc[order] > doc[head]
    order, head = order[later], head[later]
    words = np.ndarray((len(data) - 7,), "<u8", np.ascontiguousarray(data), strides=(1,))  # the 8 bytes from each position
    same = np.ones(len(order), bool)
    for k in [*range(0, depth - 7, 8), depth - 8]:
        same &= words[at[order] + k] == words[at[head] + k]
    out[order[same]] = True
    if not same.all():  # windows of equal hashes and unequal bytes: settle their groups by the bytes themselves
        for h in np.unique(head[~same]):
            members = np.append(order[head == h], h)
            least: dict[bytes, int] = {}
            texts = [data[at[i] : at[i] + depth].tobytes() for i in members]
            for i, t in zip(members, texts, strict=True):
                least[t] = min(least.get(t, doc[i]), doc[i])
            for i, t in zip(members, texts, strict=True):
                out[i] = doc[i] > least[t]
    return out


def _ranges(at: np.ndarray, doc: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows (ascending in each document, contiguous ones adjacent) as ranges: document, start, end."""
    if not len(at):
        return doc, at, at
    new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (at[1:] != at[:-1] + 1)])
    first = np.flatnonzero(new)
    return doc[first], at[first], at[np.append(first[1:], len(at)) - 1] + depth


_BLOCKS = "block long, ids array<long>, keys array<binary>, starts array<long>, lengths array<long>, copy_keys array<binary>, data binary"


def _blocks(docs: DataFrame, depth: int, size: int) -> DataFrame:
    """Documents packed into blocks of about `size` bytes; a longer text is cut into overlapping pieces of that size."""

    def pack(batches):
        part, count = TaskContext.get().partitionId(), 0
        held: list[tuple] = []
        bytes_held = 0

        def flush():
            nonlocal held, bytes_held, count
            cols = list(zip(*held, strict=True))
            row = [[(part << 32) + count], [list(cols[0])], [list(cols[1])], [list(cols[2])], [[len(x) for x in cols[3]]], [list(cols[4])], [b"".join(cols[3])]]
            types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.binary()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.binary()), pa.binary()]
            count, held, bytes_held = count + 1, [], 0
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types, strict=True)], names=["block", "ids", "keys", "starts", "lengths", "copy_keys", "data"])

        for batch in batches:
            raw, offsets = tb.buffer(batch.column(1))
            for i, doc in enumerate(batch.column(0).to_pylist()):
                text = raw[offsets[i] : offsets[i + 1]].tobytes()
                key = hashlib.md5(text).digest()
                for a in range(0, max(len(text), 1), size):
                    piece = text[a : a + size + depth - 1]
                    if a and len(piece) < depth:
                        break
                    held.append((doc, key, a, piece, key if len(text) >= depth and not a else b""))
                    bytes_held += len(piece)
                    if bytes_held >= size:
                        yield flush()
        if held:
            yield flush()

    return materialize(docs.select("doc_id", "text").mapInArrow(pack, _BLOCKS), "blocks")


def _rows(batch: pa.RecordBatch):
    """Rows one at a time: a block is large."""
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def _open(row: dict, depth: int, digit: int) -> tuple[Suffixes, np.ndarray, np.ndarray]:
    data = np.frombuffer(row["data"], np.uint8)
    lengths = np.array(row["lengths"], np.int64)
    return Suffixes(data, np.concatenate([[0], np.cumsum(lengths)]), depth, digit), np.array(row["ids"], np.int64), np.array(row["starts"], np.int64)


def _dealt(grams: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct grams ordered by bucket, the buckets that hold any, and their bounds."""
    unique = np.sort(grams)
    unique = unique[np.concatenate([[True], unique[1:] != unique[:-1]])] if len(unique) else unique
    bucket = (unique % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    used, first = np.unique(bucket[order], return_index=True)
    return unique[order], used, np.append(first, len(unique))


def _shared_digits(blocks: DataFrame, buckets: int, depth: int, digit: int) -> DataFrame:
    """First pass: for each block and bucket, which of its first digits other blocks hold too, and which texts are copies.

    Only the digits' hashes move, 4 bytes each (the bucket gives the rest; a chance match costs work, not exactness).
    """

    def emit(batches):
        for batch in batches:
            for row in _rows(batch):
                s, ids, _ = _open(row, depth, digit)
                grams, used, bounds = _dealt(s.gram, buckets)
                short = (grams // np.uint64(buckets) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
                held = {int(b): (bounds[i], bounds[i + 1]) for i, b in enumerate(used)}
                whole: dict[int, list[tuple[bytes, int]]] = {}
                for k, least in _least_copies(row["copy_keys"], ids).items():
                    whole.setdefault(int.from_bytes(k[:8], "little") % buckets, []).append((k, least))
                out = [[], [], [], [], []]
                for b in sorted(held.keys() | whole.keys()):  # occupied buckets only
                    lo, hi = held.get(b, (0, 0))
                    mine = whole.get(b, [])
                    values = (b, row["block"], short[lo:hi].tobytes(), b"".join(k for k, _ in mine), np.array([i for _, i in mine], np.int64).tobytes())
                    for o, v in zip(out, values, strict=True):
                        o.append(v)
                if out[0]:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(out[0], pa.int32()), pa.array(out[1], pa.int64()), *[pa.array(o, pa.binary()) for o in out[2:]]],
                        names=["bucket", "block", "digits", "copy_keys", "ids"],
                    )

    hot = max(HOT, blocks.count() // 4)

    def match(pdf: pd.DataFrame) -> pd.DataFrame:
        sizes = np.array([len(x) // 4 for x in pdf["digits"]])
        every = np.frombuffer(b"".join(pdf["digits"]), np.uint32)
        order = np.argsort(every, kind="stable")
        d = every[order]
        equal = np.zeros(len(d) + 1, bool)
        equal[1:-1] = d[1:] == d[:-1]
        flag = np.zeros(len(d), bool)
        flag[order] = equal[1:] | equal[:-1]
        wide = np.isin(every, np.unique(d[hot:][d[hot:] == d[:-hot]])) if len(d) > hot else np.zeros(len(d), bool)
        cuts = np.concatenate([[0], np.cumsum(sizes)])
        least: dict[bytes, int] = {}
        rows = []
        for keys, ids in zip(pdf["copy_keys"], pdf["ids"], strict=True):
            own = [(keys[16 * i : 16 * i + 16], d_) for i, d_ in enumerate(np.frombuffer(ids, np.int64).tolist())]
            rows.append(own)
            for k, d_ in own:
                least[k] = min(least.get(k, d_), d_)
        bits = lambda f, i: np.packbits(f[cuts[i] : cuts[i + 1]]).tobytes() if f[cuts[i] : cuts[i + 1]].any() else b""
        found = pd.DataFrame(
            {
                "block": pdf["block"].to_numpy(),
                "bucket": pdf["bucket"].to_numpy(),
                "shared": [bits(flag, i) for i in range(len(sizes))],
                "hot": [bits(wide, i) for i in range(len(sizes))],
                "copies": [b"".join(k for k, d_ in own if d_ > least[k]) for own in rows],
            }
        )
        give_back()
        return found[(found["shared"] != b"") | (found["copies"] != b"")]

    rows = blocks.mapInArrow(emit, "bucket int, block long, digits binary, copy_keys binary, ids binary")
    return rows.groupBy("bucket").applyInPandas(match, "block long, bucket int, shared binary, hot binary, copies binary")


def _least_copies(keys: list[bytes], ids: np.ndarray) -> dict[bytes, int]:
    """The smallest document of each whole text of a block; those above it are copies whatever the other blocks hold."""
    least: dict[bytes, int] = {}
    for k, i in zip(keys, ids.tolist(), strict=True):
        if k:
            least[k] = min(least.get(k, i), i)
    return least


#: Ranges that repeat (the first four), and windows that no smaller document in reach holds, which go on to the next level.
_RANGES = "block long, piece int, start long, end long, bucket long, salt long, rest binary"
_REST = ["data", "size", "ids", "pieces", "starts", "blocks"]
_MOVED = [
    ("bucket", pa.int32()), ("salt", pa.int32()), ("block", pa.int64()), ("data", pa.binary()), ("size", pa.binary()), ("ids", pa.binary()), ("pieces", pa.binary()), ("starts", pa.binary()), ("found", pa.binary()),
]


def _strings(data: np.ndarray, a: np.ndarray, size: np.ndarray) -> bytes:
    """The bytes of all data[a : a + size], one behind the other."""
    return data[np.repeat(a - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))].tobytes()


def _compare(pdf: pd.DataFrame, depth: int, buckets: int) -> pd.DataFrame:
    """Settle the windows of one bucket (or of a group of blocks in it): ranges of those that repeat, and the rest if there are `buckets`.

    The rest is dealt to buckets by another digit (the gram of smallest hash under another hash), so that different windows
    of one hot digit part and neighbours mostly stay together.
    """
    give_back()
    if "rest" in pdf:
        pdf = pd.DataFrame([pickle.loads(x) for x in pdf["rest"]], columns=_REST).assign(salt=pdf["salt"].to_numpy())
    join = lambda c, t: np.frombuffer(b"".join(pdf[c]), t)
    data, size, ids, piece, start = join("data", np.uint8), join("size", np.int32).astype(np.int64), join("ids", np.int64), join("pieces", np.int32), join("starts", np.int64)
    block = join("blocks", np.int64) if "blocks" in pdf else np.repeat(pdf["block"].to_numpy(), [len(x) // 4 for x in pdf["size"]])
    begin = np.cumsum(size) - size
    many = size - depth + 1
    run = np.repeat(np.arange(len(size)), many)
    at = np.arange(len(run)) - np.repeat(np.cumsum(many) - many, many) + begin[run]
    sums = tb.prefix(data)
    done = smaller(data, sums, at, ids[run], depth)
    r, a, b = _ranges(at[done], run[done], depth)
    out = {"block": [block[r]], "piece": [piece[r]], "start": [a - begin[r] + start[r]], "end": [b - begin[r] + start[r]]}
    if "found" in pdf:
        known = join("found", np.int64).reshape(-1, 3)
        out["block"].append(np.repeat(pdf["block"].to_numpy(), [len(x) // 24 for x in pdf["found"]]))
        for c, name in enumerate(("piece", "start", "end")):
            out[name].append(known[:, c])
    settled = pd.DataFrame({k: np.concatenate(v).astype(np.int32 if k == "piece" else np.int64) for k, v in out.items()})
    settled = settled.assign(bucket=None, salt=None, rest=None)
    if not buckets or done.all():
        return settled
    at, run = at[~done], run[~done]
    grams = _sliding_min(tb.mix(_rolling(sums, depth // 2) ^ np.uint64(0x5851F42D4C957F2D)), depth - depth // 2 + 1)
    to = (grams[at] % np.uint64(buckets)).astype(np.int64)
    new = np.concatenate([[True], (run[1:] != run[:-1]) | (at[1:] != at[:-1] + 1) | (to[1:] != to[:-1])])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    r, a, z, to = run[first], at[first], at[last] + depth - at[first], to[first]
    order = np.argsort(to, kind="stable")
    r, a, z, to = r[order], a[order], z[order], to[order]
    cuts = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1], [True]]))
    salt, rest = int(pdf["salt"].iloc[0]), []
    for i, j in zip(cuts, cuts[1:], strict=False):
        q = r[i:j]
        parts = (_strings(data, a[i:j], z[i:j]), z[i:j].astype(np.int32).tobytes(), ids[q].tobytes(), piece[q].astype(np.int32).tobytes(), (a[i:j] - begin[q] + start[q]).tobytes(), block[q].tobytes())
        rest.append((None, None, None, None, int(to[i]), salt, pickle.dumps(parts)))
    return pd.concat([settled.astype(object), pd.DataFrame(rest, columns=settled.columns, dtype=object)], ignore_index=True)


def _repeats(blocks: DataFrame, shared: DataFrame, digit_buckets: int, buckets: int, salts: int, depth: int, digit: int) -> DataFrame:
    """Further passes: ranges of pieces that repeat a document of smaller id.

    Windows of a shared first digit are settled inside their block where it can be done; of the rest, the bytes move to
    the digit's bucket as runs of neighbouring windows, and are settled there; those of a hot digit to one of `salts`
    groups of blocks of its bucket, where all but the first of each are settled and the first ones are left.
    """
    flags = shared.groupBy("block").agg(F.collect_list(F.struct("bucket", "shared", "hot", "copies")).alias("flags"))

    def settle(batches):
        for batch in batches:
            for row in _rows(batch):
                s, ids, starts = _open(row, depth, digit)
                grams, used, bounds = _dealt(s.gram, digit_buckets)
                place_of = {int(b): i for i, b in enumerate(used)}
                marked, hot = np.zeros(len(grams), bool), np.zeros(len(grams), bool)
                taken: set[bytes] = set()
                for f in row["flags"] or []:
                    i = place_of.get(f["bucket"])
                    for bits, to in ((f["shared"], marked), (f["hot"], hot)):
                        if bits:
                            to[bounds[i] : bounds[i + 1]] = np.unpackbits(np.frombuffer(bits, np.uint8), count=bounds[i + 1] - bounds[i]).astype(bool)
                    taken |= {f["copies"][j : j + 16] for j in range(0, len(f["copies"]), 16)}
                least = _least_copies(row["copy_keys"], ids)
                copy = np.array([bool(k) and (k in taken or i > least[k]) for k, i in zip(row["copy_keys"], ids.tolist(), strict=True)], bool)
                # a text of several pieces is a copy as a whole
                whole = {row["keys"][i] + ids[i].tobytes() for i in np.flatnonzero(copy)}
                copy |= np.array([k + i.tobytes() in whole for k, i in zip(row["keys"], ids, strict=True)], bool) if whole else False
                order = np.argsort(grams)
                place = order[np.searchsorted(grams[order], s.gram)]
                # digits of several documents of this block
                spot = s.spot
                held = ~copy[spot]
                low, high = np.full(len(grams), np.iinfo(np.int64).max), np.full(len(grams), np.iinfo(np.int64).min)
                np.minimum.at(low, place[held], ids[spot[held]])
                np.maximum.at(high, place[held], ids[spot[held]])
                take = (marked | (low < high))[place][s.anchor] & ~copy[s.doc]
                w = np.flatnonzero(take)
                done = smaller(s.data, s.sums, s.at[w], ids[s.doc[w]], depth)
                local = w[done]
                begin = np.concatenate([[0], np.cumsum(row["lengths"])])
                piece, a, b = _ranges(s.at[local], s.doc[local], depth)
                found = np.stack([piece, a - begin[piece] + starts[piece], b - begin[piece] + starts[piece]], axis=1).astype(np.int64)
                full = np.flatnonzero(copy)
                found = np.concatenate([found, np.stack([full, starts[full], starts[full] + np.array(row["lengths"])[full]], axis=1).astype(np.int64)])
                # the rest moves: neighbouring windows of one digit as one string
                w = w[~done & marked[place][s.anchor[w]]]
                out = [[] for _ in _MOVED]
                if len(w):
                    new = np.concatenate([[True], (s.at[w][1:] != s.at[w][:-1] + 1) | (s.anchor[w][1:] != s.anchor[w][:-1])])
                    first = np.flatnonzero(new)
                    last = np.append(first[1:], len(w)) - 1
                    bucket = (s.gram[s.anchor[w[first]]] % np.uint64(buckets)).astype(np.int64)
                    bucket = 2 * bucket + hot[place][s.anchor[w[first]]]
                    by = np.argsort(bucket, kind="stable")
                    bucket, first, last = bucket[by], first[by], last[by]
                    a, size = s.at[w[first]], s.at[w[last]] + depth - s.at[w[first]]
                    piece = s.doc[w[first]]
                    cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]]))
                    salt = int(tb.mix(np.array([row["block"]], np.uint64))[0]) % salts
                    for i, j in zip(cuts, cuts[1:], strict=False):
                        b, q = int(bucket[i]), piece[i:j]
                        values = (
                            b >> 1, salt if b & 1 else -1, row["block"], _strings(s.data, a[i:j], size[i:j]), size[i:j].astype(np.int32).tobytes(), ids[q].tobytes(), q.astype(np.int32).tobytes(),
                            (a[i:j] - begin[q] + starts[q]).tobytes(), b"",
                        )
                        for o, v in zip(out, values, strict=True):
                            o.append(v)
                if len(found):
                    for o, v in zip(out, (row["block"] % buckets, -1, row["block"], b"", b"", b"", b"", b"", found.tobytes()), strict=True):
                        o.append(v)
                if out[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(o, t) for o, (_, t) in zip(out, _MOVED, strict=True)], names=[n for n, _ in _MOVED])

    kinds = {pa.int32(): "int", pa.int64(): "long", pa.binary(): "binary"}
    moved = blocks.join(flags, "block", "left").mapInArrow(settle, ", ".join(f"{n} {kinds[t]}" for n, t in _MOVED))

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        return _compare(pdf, depth, 0 if pdf["salt"].iloc[0] < 0 else buckets)

    return moved.groupBy("bucket", "salt").applyInPandas(compare, _RANGES)


def _folded(ranges: DataFrame, salts: int, buckets: int, depth: int) -> DataFrame:
    """One level up: what FAN groups of blocks have left of the hot digits meets; in the last level (one group) all is settled."""

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        return _compare(pdf, depth, buckets if salts > 1 else 0)

    left = ranges.where(F.col("rest").isNotNull()).select("bucket", (F.col("salt") % salts).alias("salt"), "rest")
    return left.groupBy("bucket", "salt").applyInPandas(compare, _RANGES)


def repeated_spans(docs: DataFrame, depth: int = DEPTH, digit: int = DIGIT, block: int = BLOCK, digit_bucket: int = DIGIT_BUCKET, bucket: int = BUCKET) -> DataFrame:
    """Byte ranges (doc_id, text_key, start, end) covered by strings of `depth` bytes that a document of smaller id holds too.

    Ranges of one document may overlap or touch. text_key is the MD5 of the text; rows without an id have no ranges.
    """
    tune(docs.sparkSession)
    if not isinstance(docs.schema["doc_id"].dataType, T.IntegralType):
        raise ValueError("doc_id must be an integer column")
    if not 8 <= digit <= depth // 2 or depth < 16:
        raise ValueError("depth must be 16 at least and digit 8 to half the depth")
    docs = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long"), "text")
    blocks = _blocks(docs, depth, block)
    total = blocks.agg(F.coalesce(F.sum(F.octet_length("data")), F.lit(0))).first()[0]
    digit_buckets, buckets = max(8, -(-total // digit_bucket)), max(8, -(-total // bucket))
    shared = materialize(_shared_digits(blocks, digit_buckets, depth, digit), "digits")
    salts = -(-blocks.count() // FAN)
    ranges = materialize(_repeats(blocks, shared, digit_buckets, buckets, salts, depth, digit), "ranges")
    discard(shared)
    level, bounds = ranges, ["block", "piece", "start", "end"]
    ranges = ranges.where(F.col("rest").isNull()).select(*bounds)
    while not level.where(F.col("rest").isNotNull()).isEmpty():
        salts = -(-salts // FAN)
        level = materialize(_folded(level, salts, buckets, depth), "hot-ranges")
        ranges = ranges.unionByName(level.where(F.col("rest").isNull()).select(*bounds))
    named = blocks.select("block", F.posexplode(F.arrays_zip("ids", "keys")).alias("piece", "doc"))
    return ranges.join(named, ["block", "piece"]).select(F.col("doc.ids").alias("doc_id"), F.col("doc.keys").alias("text_key"), "start", "end")


def suffix_dedup(docs: DataFrame, keep: list[str], depth: int = DEPTH, with_text: bool = True, **sizes: int) -> DataFrame:
    """Remove every byte that lies in a `depth`-byte string which also starts in a document of smaller id.

    Texts are UTF-8 bytes; strings are judged on the input and never cross documents. Returns the `keep` columns with
    n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256 and, if asked for, `kept` (bytes, as removal may cut a
    character) and `spans` (start and end of the removed runs).

    The windows of all documents are sorted only as deep as `depth`, most significant digit first. The first digit is the
    gram of smallest hash inside the window, so neighbouring windows share it and few digits stand for all windows; its
    pass moves hashes only and leaves out every window whose digit is unique. The further digits are compared in the
    digit's bucket, where equal groups are exactly the repeated windows; a digit that many blocks hold is first folded by
    groups of blocks, where one of each window is left. Copies of a whole text are found in the first pass. Each block of
    texts folds its own repeats and copies before anything moves.

    Null text is empty. Rows with null id are returned whole and nobody's repeats count against them. Rows of equal ids
    don't count as smaller; repeated rows get equal results. An empty table gives an empty result.
    """
    spans = repeated_spans(docs, depth, **sizes)
    spans = spans.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("start", "end")).alias("__quire_spans"))
    spans = spans.select(F.col("doc_id").alias("__quire_id"), F.col("text_key").alias("__quire_key"), "__quire_spans")
    cols = [named(c) for c in dict.fromkeys([*keep, "text"])]
    rows = docs.select(*cols, F.col("doc_id").cast("long").alias("__quire_own"), F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("__quire_text"))
    joined = rows.join(spans, (F.col("__quire_own") == F.col("__quire_id")) & (F.col("__quire_text") == F.col("__quire_key")), "left").select(*cols, "__quire_spans")
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    fields = [("n_bytes", T.LongType()), ("n_removed", T.LongType()), ("n_spans", T.LongType()), ("kept_sha256", T.StringType())]
    fields += [("kept", T.BinaryType()), ("spans", T.ArrayType(span))] if with_text else []

    def make():
        def work(batch: pa.RecordBatch) -> dict:
            raw, offsets = tb.buffer(batch.column(batch.schema.get_field_index("text")))
            listed = batch.column(batch.schema.get_field_index("__quire_spans"))
            out = {n: [] for n, _ in fields}
            for i in range(batch.num_rows):
                text = raw[offsets[i] : offsets[i + 1]]
                got = listed[i].values if listed[i].is_valid else None
                runs = np.zeros((0, 2), np.int64)
                if got is not None and len(got):
                    pairs = np.stack([got.field(0).to_numpy(), got.field(1).to_numpy()], axis=1)
                    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
                    reach = np.maximum.accumulate(pairs[:, 1])
                    new = np.concatenate([[True], pairs[1:, 0] > reach[:-1]])
                    at = np.flatnonzero(new)
                    runs = np.stack([pairs[at, 0], reach[np.append(at[1:], len(reach)) - 1]], axis=1)
                ends = np.concatenate([[0], runs.ravel(), [len(text)]])
                kept = b"".join(text[a:b].tobytes() for a, b in zip(ends[::2], ends[1::2], strict=True))
                values = [len(text), len(text) - len(kept), len(runs), hashlib.sha256(kept).hexdigest()]
                values += [kept, [{"start": int(a), "end": int(b)} for a, b in runs]] if with_text else []
                for n, v in zip(out, values, strict=True):
                    out[n].append(v)
            return out

        return work

    return map_arrow(joined, make, fields, keep, read=("text", "__quire_spans"))
