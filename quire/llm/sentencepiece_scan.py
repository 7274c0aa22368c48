"""SentencePiece encoding and decoding: best segmentation by scores, with a max-plus scan for giant documents."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm import textblocks as tb
from quire.llm.common import map_arrow, materialize, tune

#: A model file in SentencePiece format; a parameter of every function here.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Documents of more characters than GIANT are split into chunks of CHUNK characters.
GIANT = 1 << 16
CHUNK = 1 << 14
#: Scores up to this one mean that the piece is never made by merging.
NO_MERGE = -100_000_000
_CACHE = 150_000
#: A model file of more bytes is not sent to the tasks.
MAX_MODEL = 64 << 20
_NONE = -(1 << 60)
_UNIT = re.compile(r"\n| ?[^ \n]+| ")


class Vocabulary:
    """Pieces with integer scores; blanks stand for the model's blank mark.

    A character that no piece holds becomes its UTF-8 bytes' pieces, at the score of the worst piece less ten (as the
    library does for unigram models). The model's pieces of several blank marks have a score of minus a billion, which stands
    for "never merged"; they are left out, and a single blank mark with that score counts as one worse than the worst other. A blank mark that stands in the text itself is encoded by its bytes, so
    decoding restores every text.
    """

    def __init__(self, path: str = MODEL, proto: bytes | None = None) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path) if proto is None else sentencepiece.SentencePieceProcessor(model_proto=proto)
        self.bytes: list[bytes] = []
        self.byte_id = [0] * 256
        self.pieces: dict[str, tuple[int, int] | None] = {}
        worst = 0
        for i in range(model.get_piece_size()):
            piece, raw = model.id_to_piece(i), b""
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_id[value] = i
                raw = bytes([value])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                plain = piece.replace("▁", " ")
                raw = plain.encode()
                if not (len(plain) > 1 and not plain.strip(" ")):
                    score = round(model.get_score(i))
                    self.pieces[plain] = (i, score)
                    if score > NO_MERGE:
                        worst = min(worst, score)
            self.bytes.append(raw)
        worst -= 1
        self.pieces = {p: (i, max(score, worst)) for p, (i, score) in self.pieces.items()}
        self.unknown = worst - 10
        self.longest = max(map(len, self.pieces))
        if any(" " in p[1:] or "\n" in p for p in self.pieces):
            raise ValueError("a piece reaches across a blank or a line end; words are not independent in this model")
        #: whether two bytes stand side by side in a piece; where they don't, no piece can reach across (continuation bytes aside)
        self.joined = np.zeros((256, 256), bool)
        self.joined[:, 0x80:0xC0] = True
        for p in self.pieces:
            raw = p.encode()
            self.joined[list(raw[:-1]), list(raw[1:])] = True
        for p in list(self.pieces):  # beginnings of pieces, so that a search can stop
            for k in range(1, len(p)):
                self.pieces.setdefault(p[:k], None)

    def forward(self, text: str, entry: list[int], starts: int) -> tuple[list[int], list[tuple[int, int]]]:
        """Best score of reaching each position, and the step that reaches it: (start, piece id, or -1 for bytes).

        entry: scores of standing at positions 0, 1, ... before any piece of this text; pieces start at positions below
        `starts`. Of equal scores the smallest start wins, an entry (step (-1, -1)) before all.
        """
        n = len(text)
        best, step = [_NONE] * (n + 1), [(-1, -1)] * (n + 1)
        best[: len(entry)] = entry[: n + 1]
        get = self.pieces.get
        for i in range(min(starts, n)):
            base = best[i]
            if base == _NONE:
                continue
            alone = False
            for j in range(i + 1, min(n, i + self.longest) + 1):
                got = get(text[i:j], 0)
                if got == 0:
                    break
                if got is not None:
                    if j == i + 1:
                        alone = True
                    if base + got[1] > best[j]:
                        best[j], step[j] = base + got[1], (i, got[0])
            if not alone and base + self.unknown > best[i + 1]:
                best[i + 1], step[i + 1] = base + self.unknown, (i, -1)
        return best, step

    def trace(self, text: str, step: list[tuple[int, int]], at: int, stop: int = 0) -> tuple[list[int], int]:
        """Piece ids on the way back from `at`, in order, and the position where the way began (at or before `stop`)."""
        out: list[int] = []
        while at > stop and step[at][0] >= 0:
            i, piece = step[at]
            out += [piece] if piece >= 0 else [self.byte_id[b] for b in reversed(text[i:at].encode("utf-8", "surrogatepass"))]
            at = i
        return out[::-1], at

    def unit(self, text: str) -> tuple[list[int], int]:
        """Ids and score of a text that nothing reaches into or out of."""
        best, step = self.forward(text, [0], len(text))
        return self.trace(text, step, len(text))[0], best[len(text)]


_vocabulary: dict[str, Vocabulary] = {}
_units: dict[str, dict[bytes, tuple[np.ndarray, int]]] = {}


def vocabulary(path: str, proto: bytes | None = None) -> Vocabulary:
    """The worker's copy of a model, made once, from the file's bytes where they are given."""
    if path not in _vocabulary:
        _vocabulary[path] = Vocabulary(path, proto)
        _units[path] = {}
    return _vocabulary[path]


def _fields(message: bytes):
    """Number and value (an integer or bytes) of each field of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value, shift = 0, 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(message):
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
        else:
            size = varint() if tag & 7 == 2 else {1: 8, 5: 4}[tag & 7]
            yield tag >> 3, message[at : at + size]
            at += size


def merges(proto: bytes) -> bool:
    """Whether a model file was made for merging pairs (BPE): trainer_spec is field 2, its model_type field 3, BPE is 2."""
    return any(n == 3 and v == 2 for m, spec in _fields(proto) if m == 2 for n, v in _fields(spec))


def _read(spark, model: str, allow_merges: bool):
    """The model's bytes as a broadcast: the driver reads the file, workers need not have it. Refuses over MAX_MODEL bytes."""
    with open(model, "rb") as f:
        proto = f.read(MAX_MODEL + 1)
    if len(proto) > MAX_MODEL:
        raise ValueError(f"the model file is larger than {MAX_MODEL} bytes")
    if merges(proto) and not allow_merges:
        raise ValueError("a model for merging pairs: its library orders merges by score, which no sum of scores gives; allow_merges=True takes the scores as they are")
    return spark.sparkContext.broadcast(proto)


def _unit(path: str, raw: bytes) -> tuple[np.ndarray, int]:
    cache = _units[path]
    got = cache.get(raw)
    if got is None:
        if len(cache) >= _CACHE:
            cache.clear()
        ids, score = _vocabulary[path].unit(raw.decode("utf-8"))
        got = cache[raw] = (np.array(ids, np.int32), score)
    return got


def _encode_batch(path: str, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All ids of a batch, the bounds of each text's ids, and whether decoding gives each text back.

    No piece holds two bytes side by side that `joined` rules out, so texts fall into units there (at every blank at least);
    each distinct unit is segmented once and its ids are gathered.
    """
    v = vocabulary(path)
    raw, offsets = tb.buffer(column)
    some = np.diff(offsets) > 0
    data = np.insert(raw, offsets[:-1][some], 0x20)  # the blank before the first word
    offsets = offsets + np.concatenate([[0], np.cumsum(some)])
    rows = len(column)
    if not len(data):
        return np.zeros(0, np.int32), np.zeros(rows + 1, np.int64), np.ones(rows, bool)
    cut = np.ones(len(data), bool)
    cut[1:] = ~v.joined[data[:-1], data[1:]]
    cut[offsets[:-1][some]] = True
    start = np.flatnonzero(cut)
    end = np.append(start[1:], len(data))
    h = tb.span_hash(tb.prefix(data), start, end)
    _, once, back = np.unique(h, return_index=True, return_inverse=True)
    flat = data.tobytes()
    found = [_unit(path, flat[s:e])[0] for s, e in zip(start[once].tolist(), end[once].tolist(), strict=True)]
    size = np.array([len(f) for f in found])
    base = np.cumsum(size) - size
    pool = np.concatenate(found)
    many = size[back]
    first = np.cumsum(many) - many
    ids = pool[np.repeat(base[back] - first, many) + np.arange(int(many.sum()))]
    bounds = np.append(first, len(ids))[np.searchsorted(start, offsets)]
    # decode again and compare byte by byte; this also excludes collisions of the word hashes
    spelled, lengths = _spell(v, ids)
    ends = np.concatenate([[0], np.cumsum(lengths)])[bounds]
    good = np.diff(ends) == np.diff(offsets)
    if len(spelled) == len(data) and good.all():
        wrong = np.flatnonzero(spelled != data)
        good[np.searchsorted(offsets, wrong, side="right") - 1] = False
    else:
        good = np.array([spelled[ends[i] : ends[i + 1]].tobytes() == flat[offsets[i] : offsets[i + 1]] for i in range(rows)])
    if not good.all():
        parts = [ids[bounds[i] : bounds[i + 1]] if good[i] else np.array(v.unit(flat[offsets[i] : offsets[i + 1]].decode())[0], np.int32) for i in range(rows)]
        ids, bounds = np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        good = np.array([b"".join(v.bytes[k] for k in p.tolist()) == flat[offsets[i] : offsets[i + 1]] for i, p in enumerate(parts)])
    return ids, bounds, good


_tables: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}


def _spell(v: Vocabulary, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes that pieces stand for, concatenated, and the length of each."""
    if id(v) not in _tables:
        size = np.array([len(b) for b in v.bytes])
        _tables[id(v)] = (np.frombuffer(b"".join(v.bytes), np.uint8), np.cumsum(size) - size, size)
    pool, base, size = _tables[id(v)]
    many = size[ids]
    first = np.cumsum(many) - many
    return pool[np.repeat(base[ids] - first, many) + np.arange(int(many.sum()))], many


def _outputs(ids: np.ndarray, bounds: np.ndarray, good: np.ndarray, null: np.ndarray, with_ids: bool) -> dict:
    raw = ids.astype("<i4")
    out = {
        "n_tokens": pa.array(np.diff(bounds)),
        "ids_sha256": [hashlib.sha256(raw[bounds[i] : bounds[i + 1]].tobytes()).hexdigest() for i in range(len(good))],
        "round_trip": pa.array(good),
    }
    if with_ids:
        offsets = pa.array(bounds.astype(np.int32))
        if null.any():
            offsets = pa.array(bounds.astype(np.int32), mask=np.append(null, False))
        out["ids"] = pa.ListArray.from_arrays(offsets, pa.array(ids))
    return out


def _split(text: str, size: int) -> tuple[int, list[str], int]:
    """Where the first word of a chunk begins that nothing reaches into, the words up to the last one, and its begin."""
    first = next((m.start() for m in re.finditer(r"[ \n]", text[:size])), -1)
    if first < 0:
        return -1, [], -1
    last = max(text.rfind(" ", first, size), text.rfind("\n", first, size))
    return first, _UNIT.findall(text[first:last]), last


def transfer(v: Vocabulary, path: str, text: str, size: int) -> np.ndarray:
    """Max-plus matrix of one chunk: best score from each entry (characters into it) to each exit (characters beyond it).

    text: the chunk's `size` characters and those that its pieces may reach into.
    """
    s = v.longest
    out = np.full((s, s), _NONE, np.int64)
    first, words, last = _split(text, size)
    if first >= 0:
        middle = sum(_unit(path, w.encode("utf-8", "surrogatepass"))[1] for w in words)
        tail, _ = v.forward(text[last : size + s - 1], [0], size - last)
        exits = np.array([tail[size - last + b] if size - last + b < len(tail) else _NONE for b in range(s)])
        for a in range(min(s, first + 1)):
            head = v.forward(text[a:first], [0], first - a)[0][first - a]
            out[a] = np.where(exits == _NONE, _NONE, head + middle + exits)
    else:
        for a in range(min(s, size)):
            best, _ = v.forward(text[a : size + s - 1], [0], size - a)
            out[a] = [best[size - a + b] if size - a + b < len(best) else _NONE for b in range(s)]
    for a in range(size, s):  # an entry behind a chunk shorter than a piece
        out[a] = _NONE
        out[a][a - size] = 0
    return out


def compose(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product of two transfer matrices; associative."""
    out = (a[:, :, None] + b[None, :, :]).max(axis=1)
    return np.where(out < _NONE // 2, _NONE, out)


def entries(matrices: list[np.ndarray]) -> list[np.ndarray]:
    """Score vector on entering each chunk: products of all matrices before it, taken pairwise up and down a tree."""
    if not matrices:
        return []
    start = np.full((1, matrices[0].shape[0]), _NONE, np.int64)
    start[0, 0] = 0

    def down(lo: int, hi: int, vector: np.ndarray, out: list[np.ndarray]) -> None:
        if hi - lo == 1:
            out.append(vector[0])
            return
        mid = (lo + hi) // 2
        down(lo, mid, vector, out)
        down(mid, hi, compose(vector, up(lo, mid)), out)

    known: dict[tuple[int, int], np.ndarray] = {}

    def up(lo: int, hi: int) -> np.ndarray:
        if (lo, hi) not in known:
            known[lo, hi] = matrices[lo] if hi - lo == 1 else compose(up(lo, (lo + hi) // 2), up((lo + hi) // 2, hi))
        return known[lo, hi]

    out: list[np.ndarray] = []
    down(0, len(matrices), start, out)
    return out


def backtrace(v: Vocabulary, path: str, text: str, size: int, entry: np.ndarray) -> tuple[list[int], list[list[int]], list[int]]:
    """For every exit of a chunk: shared ids, ids behind them, and the entry that the way came from.

    Needs only the chunk and its entry scores, so chunks are traced apart from each other.
    """
    s = v.longest
    start = [int(x) for x in entry]
    first, words, last = _split(text, size)
    if first >= 0:
        head, step = v.forward(text[:first], start[: first + 1], first)
        ids, came = v.trace(text, step, first)
        for w in words:
            ids += _unit(path, w.encode("utf-8", "surrogatepass"))[0].tolist()
        part = text[last : size + s - 1]
        best, step = v.forward(part, [0], size - last)
        tails = [v.trace(part, step, size - last + b)[0] if size - last + b < len(best) and best[size - last + b] != _NONE else [] for b in range(s)]
        return ids, tails, [came] * s
    part = text[: size + s - 1]
    best, step = v.forward(part, start, size)
    tails, came = [], []
    for b in range(s):
        ok = size + b < len(best) and best[size + b] != _NONE
        ids, at = v.trace(part, step, size + b) if ok else ([], 0)
        tails.append(ids)
        came.append(at)
    return [], tails, came


def _giants(docs: DataFrame, path: str, proto, chunk: int) -> DataFrame:
    """text_key, ids and round_trip of each distinct giant text, encoded in chunks that different tasks work on."""
    texts = docs.select(F.md5("text").alias("text_key"), "text").groupBy("text_key").agg(F.first("text").alias("text"))

    def split(batches):
        reach = vocabulary(path, proto.value).longest - 1
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                text = " " + text
                rows = [(key, i, min(chunk, len(text) - a), text[a : a + chunk + reach]) for i, a in enumerate(range(0, len(text), chunk))]
                for a in range(0, len(rows), 64):
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows[a : a + 64], strict=True)], names=["text_key", "i", "size", "chunk"])

    chunks = materialize(texts.mapInArrow(split, "text_key string, i long, size long, chunk string").repartition("text_key", "i"), "chunks")

    def matrices():
        def work(batch: pa.RecordBatch) -> dict:
            v = vocabulary(path, proto.value)
            rows = zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("size", "chunk")), strict=True)
            return {"matrix": [transfer(v, path, text, size).tobytes() for size, text in rows]}

        return work

    def scan(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("i")
        s = int(round((len(pdf["matrix"].iloc[0]) // 8) ** 0.5))
        vectors = entries([np.frombuffer(m, np.int64).reshape(s, s) for m in pdf["matrix"]])
        return pd.DataFrame({"text_key": pdf["text_key"].to_numpy(), "i": pdf["i"].to_numpy(), "entry": [x.tobytes() for x in vectors]})

    made = map_arrow(chunks, matrices, [("matrix", T.BinaryType())], ["text_key", "i"], read=("size", "chunk"))
    entered = made.groupBy("text_key").applyInPandas(scan, "text_key string, i long, entry binary")

    def traces():
        def work(batch: pa.RecordBatch) -> dict:
            v = vocabulary(path, proto.value)
            core, tails, came = [], [], []
            for size, text, entry in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("size", "chunk", "entry")), strict=True):
                x, y, z = backtrace(v, path, text, size, np.frombuffer(entry, np.int64))
                core.append(x)
                tails.append(y)
                came.append(z)
            return {"core": core, "tails": tails, "came": came}

        return work

    ints = T.ArrayType(T.IntegerType())
    traced = map_arrow(chunks.join(entered, ["text_key", "i"]), traces, [("core", ints), ("tails", T.ArrayType(ints)), ("came", ints)], ["text_key", "i"], read=("size", "chunk", "entry"))

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("i")
        exit_, parts = 0, []
        for core, tails, came in zip(pdf["core"][::-1], pdf["tails"][::-1], pdf["came"][::-1], strict=True):
            parts.append(np.concatenate([np.asarray(core, np.int32), np.asarray(tails[exit_], np.int32)]))
            exit_ = int(came[exit_])
        return pd.DataFrame({"text_key": [pdf["text_key"].iloc[0]], "ids": [np.concatenate(parts[::-1])]})

    return traced.groupBy("text_key").applyInPandas(join, "text_key string, ids array<int>")


def encode(
    docs: DataFrame, keep: list[str], model: str = MODEL, giant: int = GIANT, chunk: int = CHUNK, with_ids: bool = True, allow_merges: bool = True
) -> DataFrame:
    """The `keep` columns with n_tokens, ids_sha256 (of little-endian 32-bit ids), round_trip and, if asked for, ids.

    The ids are the segmentation with the largest sum of piece scores (of equal ones, the one whose last piece is longest,
    and so on to the front), which SentencePiece calls unigram inference, over the given model's pieces. Texts of up to
    `giant` characters are encoded in one task, word by word. Longer ones are split into chunks anywhere; each chunk's task
    gives a matrix of best scores between the states at its two ends, the matrices are composed, and each chunk is traced
    back on its own from its entry scores; the result is the same. Models for merging pairs have scores that rank merges;
    the library would give other ids for them, and allow_merges=False refuses them. round_trip says that decoding gives the text back.

    Null text has null ids, no tokens and the digest of nothing; an empty text has no ids. Rows are independent: repeated
    rows get equal results, an empty table an empty one. A column of `keep` with the name of a result gives way to it.
    """
    tune(docs.sparkSession)
    if chunk < 32:
        raise ValueError("chunk must be 32 at least")
    proto = _read(docs.sparkSession, model, allow_merges)
    fields = [("n_tokens", T.LongType()), ("ids_sha256", T.StringType()), ("round_trip", T.BooleanType())]
    fields += [("ids", T.ArrayType(T.IntegerType()))] if with_ids else []
    small = docs.where(F.col("text").isNull() | (F.length("text") <= giant))

    def words():
        def work(batch: pa.RecordBatch) -> dict:
            vocabulary(model, proto.value)
            column = batch.column(batch.schema.get_field_index("text"))
            return _outputs(*_encode_batch(model, column), np.asarray(column.is_null()), with_ids)

        return work

    done = map_arrow(small, words, fields, keep)
    large = docs.where(F.length("text") > giant)
    found = _giants(large, model, proto, chunk)
    large = large.withColumn("__quire_key", F.md5("text")).join(found.select(F.col("text_key").alias("__quire_key"), F.col("ids").alias("__quire_ids")), "__quire_key")

    def check():
        def work(batch: pa.RecordBatch) -> dict:
            v = vocabulary(model, proto.value)
            column = batch.column(batch.schema.get_field_index("__quire_ids"))
            ids = [np.array(x, np.int32) for x in column.to_pylist()]
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            good = np.array([_spell(v, x)[0].tobytes() == (" " + t).encode() for x, t in zip(ids, texts, strict=True)], bool)
            bounds = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int64)
            return _outputs(np.concatenate(ids), bounds, good, np.zeros(len(ids), bool), with_ids)

        return work

    return done.unionByName(map_arrow(large, check, fields, keep, read=("text", "__quire_ids")))


def decode(tokens: DataFrame, keep: list[str], model: str = MODEL, ids: str = "ids") -> DataFrame:
    """The `keep` columns with `text`, what the ids stand for; null ids give null. Ids out of range raise an error."""
    tune(tokens.sparkSession)
    proto = _read(tokens.sparkSession, model, True)  # decoding is the same for every kind

    def make():
        def work(batch: pa.RecordBatch) -> dict:
            v = vocabulary(model, proto.value)
            rows = batch.column(batch.schema.get_field_index(ids)).to_pylist()
            return {"text": [None if x is None else b"".join(v.bytes[i] for i in x).decode("utf-8", "replace")[1:] for x in rows]}

        return work

    return map_arrow(tokens, make, [("text", T.StringType())], keep, read=(ids,))
