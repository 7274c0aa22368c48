"""Language identification: word frequencies first, shorter and shorter character n-grams for unseen words."""

from __future__ import annotations

import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm import textblocks as tb
from quire.llm.common import discard, held_out, map_arrow, materialize, tune

#: Training rows per language, about, and the characters taken of each.
TRAIN_PER_LANGUAGE = 1500
TRAIN_CHARS = 6_000
#: Entries of the tables of words and of n-grams of each order, and numbers (entries times languages) of a table, at most.
MAX_WORDS = 100_000
MAX_GRAMS = 50_000
MAX_CELLS = 20_000_000
SMOOTH = 0.1
ORDERS = (4, 3, 2, 1)
_EDGE = 0x20
UNKNOWN = "und"
_letter: np.ndarray | None = None
_lower: np.ndarray | None = None


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Per code point: whether it is a letter, and its lower-case form where that is one code point."""
    global _letter, _lower
    if _letter is None:
        _lower = np.arange(0x110000, dtype=np.uint32)
        letter = np.zeros(0x110000, bool)
        for c in range(0x110000):
            ch = chr(c)
            if ch.isalpha():
                letter[c] = True
                low = ch.lower()
                if len(low) == 1:
                    _lower[c] = ord(low)
            elif unicodedata.category(ch)[0] == "M" and c < 0x20000:
                letter[c] = False
        _letter = letter
    return _letter, _lower


class Letters:
    """The words (runs of letters, lower-cased) of a batch as code points, with hashes."""

    def __init__(self, column: pa.Array) -> None:
        letter, lower = _tables()
        raw, offsets = tb.code_points(*tb.buffer(column))
        self.data = lower[raw]
        self.start, self.end, self.first = tb.runs(letter[raw], offsets)
        self.sums = tb.prefix(self.data)
        self.hash = tb.span_hash(self.sums, self.start, self.end)


def _edged(words: Letters, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the chosen words, each between two edge marks: data, start and end (edges included)."""
    size = words.end[which] - words.start[which]
    total = int(size.sum())
    stop = np.cumsum(size + 2)
    start = stop - size - 2
    data = np.full(int(stop[-1]) if len(stop) else 0, _EDGE, np.uint32)
    inner = np.arange(total) - np.repeat(np.cumsum(size) - size, size)
    data[np.repeat(start + 1, size) + inner] = words.data[np.repeat(words.start[which], size) + inner]
    return data, start, stop


class Model:
    """Log frequencies per language of words and of character n-grams, by hash.

    counts: for words (order 0) and each n-gram order the sorted keys and a count per key and language; mass: all counts
    of the order per language, those of other keys included; kinds: how many distinct keys the order has in all.
    """

    def __init__(self, languages: list[str], counts: dict[int, tuple[np.ndarray, np.ndarray]], mass: dict[int, np.ndarray], kinds: dict[int, int]) -> None:
        self.languages = languages
        none = np.zeros(0, np.uint64), np.zeros((0, len(languages)))
        tables = {}
        for n in (0, *ORDERS):
            keys, c = counts.get(n, none)
            tables[n] = keys, np.log((c + SMOOTH) / (np.maximum(mass.get(n, 0), 1) + SMOOTH * max(kinds.get(n, 0), 1)))
        self.word_keys, self.word_scores = tables[0]
        self.grams = [tables[n] for n in ORDERS]
        self.floor = np.log(np.full(len(languages), 1.0 / max(len(languages), 1))) if languages else np.zeros(0)


def _counts(column: pa.Array, lang: np.ndarray) -> tuple[np.ndarray, ...]:
    """Order, key, language number and count of every word and n-gram of a batch of texts in these languages."""
    words = Letters(column)
    own = np.repeat(lang, np.diff(words.first))
    unique, once, back = np.unique(words.hash, return_index=True, return_inverse=True)
    pair, many = np.unique(back * (lang.max(initial=0) + 1) + own, return_counts=True)
    word, own = pair // (lang.max(initial=0) + 1), pair % (lang.max(initial=0) + 1)
    parts = [(np.zeros(len(word), np.int64), unique[word], own, many)]
    data, start, stop = _edged(words, once)
    sums = tb.prefix(data)
    for n in ORDERS:  # from each distinct word, as often as it stands in each language
        at, owner = _positions(start[word], stop[word], n)
        key = tb.span_hash(sums, at, at + n)
        order = np.lexsort((own[owner], key))
        k, o, w = key[order], own[owner][order], many[owner][order]
        new = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (o[1:] != o[:-1])])) if len(k) else np.zeros(0, np.int64)
        parts.append((np.full(len(new), n), k[new], o[new], np.add.reduceat(w, new) if len(new) else w))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _positions(start: np.ndarray, stop: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """All n-gram starts within the spans, and the span each is in."""
    many = np.maximum(stop - start - n + 1, 0)
    owner = np.repeat(np.arange(len(start)), many)
    return start[owner] + np.arange(len(owner)) - (np.cumsum(many) - many)[owner], owner


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    return at, keys[at] == wanted


def _predict(model: Model, column: pa.Array) -> dict:
    words = Letters(column)
    rows, count = len(column), len(model.languages)
    if not count:
        return {"lang_pred": [UNKNOWN] * rows, "score": np.zeros(rows)}
    unique, once, back = np.unique(words.hash, return_index=True, return_inverse=True)
    at, known = _find(model.word_keys, unique)
    score = np.zeros((len(unique), count))
    score[known] = model.word_scores[at[known]]
    rare = np.flatnonzero(~known)
    if len(rare):
        data, start, stop = _edged(words, once[rare])
        sums = tb.prefix(data)
        # the longest known n-gram that ends at each character; a shorter one costs a constant factor
        ends, owner = _positions(start + 1, stop, 1)
        best = np.tile(model.floor, (len(ends), 1))
        open_ = np.ones(len(ends), bool)
        for (keys, table), n in zip(model.grams, ORDERS, strict=True):
            i = np.flatnonzero(open_ & (ends + 1 - n >= start[owner]))
            hit, found = _find(keys, tb.span_hash(sums, ends[i] + 1 - n, ends[i] + 1))
            best[i[found]] = table[hit[found]] + np.log(0.4) * (ORDERS[0] - n)
            open_[i[found]] = False
        total = np.zeros((len(rare), count))
        np.add.at(total, owner, best)
        score[rare] = total / (stop - start - 1)[:, None]  # per character, so that a guess weighs less than a known word
    doc_score = np.zeros((rows, count))
    for j in range(count):
        doc_score[:, j] = tb.row_sums(score[back, j], words.first)
    n = np.diff(words.first)
    top = doc_score.argmax(axis=1)
    # posterior of the mean evidence over the square root of the length: long texts do not saturate at once
    scaled = doc_score / np.sqrt(np.maximum(n, 1))[:, None]
    p = np.exp(scaled - scaled.max(axis=1, keepdims=True))
    p = p[np.arange(rows), top] / p.sum(axis=1)
    named = np.array(model.languages, object)[top]
    named[n == 0] = UNKNOWN
    return {"lang_pred": pa.array(named.tolist(), pa.string()), "score": pa.array(np.where(n == 0, 0.0, p))}


def training_rows(docs: DataFrame, folds: int, fold: int, per_language: int, max_chars: int) -> DataFrame:
    """About `per_language` labelled texts of each language outside the held-out fold, chosen by a hash of their id.

    The share taken of each language follows from its row count, so no language's rows meet in a task and none is left
    out, however rare it is or long its texts are: of a text over `max_chars` characters, a stretch of that length
    is taken, at a place given by a hash of the id.
    """
    ids = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull() & ~held_out("doc_id", folds, fold))
    share = ids.groupBy("lang").agg((per_language / F.count(F.lit(1))).alias("share"))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(1 << 30)
    rows = ids.join(F.broadcast(share), "lang").where(place < F.col("share"))  # a row for each language
    at = F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.greatest(F.length("text") - max_chars, F.lit(0)) + 1) + 1
    text = F.when(F.length("text") > max_chars, F.substring(F.col("text"), at, F.lit(max_chars))).otherwise(F.col("text"))
    return rows.select("lang", text.alias("text"))


def fit(docs: DataFrame, folds: int = 4, fold: int = 2, per_language: int = TRAIN_PER_LANGUAGE, max_chars: int = TRAIN_CHARS, cells: int = MAX_CELLS) -> Model:
    """Count words and n-grams in the tasks that hold the sample, sum them by key, and keep the commonest of each order.

    Only the kept counts come to the driver: at most MAX_WORDS words of two occurrences and MAX_GRAMS n-grams of each order,
    and fewer where there are many languages, so that no table has over `cells` numbers.
    """
    rows = materialize(training_rows(docs, folds, fold, per_language, max_chars), "language-sample")
    languages = sorted(r.lang for r in rows.select("lang").distinct().collect())  # as many as there are languages
    number = docs.sparkSession.sparkContext.broadcast({x: i for i, x in enumerate(languages)})

    def count(batches):
        for batch in batches:
            lang = np.array([number.value[x] for x in batch.column(0).to_pylist()], np.int64)
            order, key, own, many = _counts(batch.column(1), lang)
            yield pa.RecordBatch.from_arrays([pa.array(order.astype(np.int32)), pa.array(key.view(np.int64)), pa.array(own.astype(np.int32)), pa.array(many)], names=["order", "key", "lang", "n"])

    counted = rows.mapInArrow(count, "order int, key long, lang int, n long").groupBy("order", "key", "lang").agg(F.sum("n").alias("n"))
    counted = materialize(counted, "language-counts")
    discard(rows)
    mass = {n: np.zeros(len(languages)) for n in (0, *ORDERS)}
    for r in counted.groupBy("order", "lang").agg(F.sum("n").alias("n")).collect():  # orders times languages
        mass[r.order][r.lang] = r.n
    totals = counted.groupBy("order", "key").agg(F.sum("n").alias("n"))
    kinds = {r.order: r["count"] for r in totals.groupBy("order").count().collect()}
    kept = None
    for n in (0, *ORDERS):
        most = max(1, min(MAX_GRAMS if n else MAX_WORDS, cells // max(len(languages), 1)))
        top = totals.where((F.col("order") == n) & (F.col("n") >= (1 if n else 2))).orderBy(F.col("n").desc(), "key").limit(most).select("order", "key")
        kept = top if kept is None else kept.unionByName(top)
    table = counted.join(kept, ["order", "key"]).toArrow()
    discard(counted)
    order, key, lang, n = (table.column(c).to_numpy() for c in ("order", "key", "lang", "n"))
    counts = {}
    for o in np.unique(order):
        mine = order == o
        keys, at = np.unique(key[mine].view(np.uint64), return_inverse=True)
        c = np.zeros((len(keys), len(languages)))
        c[at, lang[mine]] = n[mine]
        counts[int(o)] = keys, c
    return Model(languages, counts, mass, kinds)


def identify(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The `keep` columns with lang_pred and score.

    Every word (a run of letters, lower-cased) adds its log frequency per language; a word outside the table adds the
    mean over its characters of the longest known n-gram ending there (4 to 1 characters, edges marked), each step down
    costing a constant. lang_pred is the best language, `und` with score 0 if the text is null or has no letter (or
    nothing was learned); score is the share of the best one among the languages. Ties go to the first name.
    """
    tune(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        return lambda batch: _predict(shared.value, batch.column(batch.schema.get_field_index("text")))

    return map_arrow(docs, make, [("lang_pred", T.StringType()), ("score", T.DoubleType())], keep)


def language_id(
    docs: DataFrame, folds: int = 4, fold: int = 2, per_language: int = TRAIN_PER_LANGUAGE, max_chars: int = TRAIN_CHARS
) -> DataFrame:
    """Learn from the labelled rows outside the held-out fold and predict every row: doc_id, held_out, lang_pred, score.

    The model is fitted on a bounded sample (about `per_language` texts of at most `max_chars` characters for each language), so its
    tables are bounded and sent to the tasks; prediction covers all rows and whole texts.
    """
    tune(docs.sparkSession)
    return identify(docs, fit(docs, folds, fold, per_language, max_chars), ["doc_id"]).select("doc_id", held_out("doc_id", folds, fold).alias("held_out"), "lang_pred", "score")
