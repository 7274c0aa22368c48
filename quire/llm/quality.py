"""Quality classifier: random Fourier features of document statistics, ridge regression, isotonic calibration."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm import textblocks as tb
from quire.llm.common import discard, held_out, labelled_sample, map_arrow, materialize, tune

FEATURES = 256
RIDGE = 1e-3
#: Labelled rows of each class taken for fitting, at most, and the longest text among them.
TRAIN_PER_CLASS = 6000
TRAIN_CHARS = 40_000
#: Partitions of the sample's statistics, and rows of it that the kernel's width is taken from.
FIT_PARTITIONS = 8
WIDTH_ROWS = 2000
_UPPER = tb.byte_table(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LETTER = tb.byte_table(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
_DIGIT = tb.byte_table(b"0123456789")
_WIDE = tb.byte_table(bytes(range(0x80, 0x100)))
_BLANK = ~tb.NOT_BLANK
_END = tb.byte_table(b".!?")
_LINE = tb.byte_table(b"\n")
_SIGN = ~(_LETTER | _DIGIT | _WIDE | _BLANK)
STATISTICS = (
    "log_bytes", "log_words", "mean_word", "spread_word", "upper", "digit", "wide", "sign", "blank", "sentence", "comma", "bang", "bar", "colon", "slash", "angle", "hash", "line", "line_words",
    "distinct_words", "top_word", "distinct_pairs", "distinct_triples", "distinct_lines", "short_words", "long_words", "capitalised", "shouted", "punctuated",
)


def statistics(column: pa.Array) -> np.ndarray:
    """One row of STATISTICS for each text of the batch (null is empty); every share is 0 for an empty text."""
    data, offsets = tb.buffer(column)
    rows = len(column)
    size = np.diff(offsets).astype(float)
    safe = np.maximum(size, 1)
    histogram = np.zeros((rows, 256))
    doc = np.repeat(np.arange(rows), np.diff(offsets))
    histogram += np.bincount(doc * 256 + data, minlength=rows * 256).reshape(rows, 256)

    def share(table: np.ndarray) -> np.ndarray:
        return histogram[:, table].sum(axis=1) / safe

    def byte(c: str) -> np.ndarray:
        return histogram[:, ord(c)] / safe

    start, end, first = tb.runs(tb.NOT_BLANK[data], offsets)
    count = np.diff(first)
    some = np.maximum(count, 1)
    length = (end - start).astype(float)
    mean = tb.row_sums(length, first) / some
    spread = np.sqrt(np.maximum(tb.row_sums(length**2, first) / some - mean**2, 0))
    h = tb.span_hash(tb.prefix(tb.ASCII_LOWER[data]), start, end)
    owner = np.repeat(np.arange(rows), count)

    def distinct(keys: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct keys of each row, and the count of its commonest."""
        if not len(keys):
            return np.zeros(rows), np.zeros(rows)
        order = np.lexsort((keys, own))
        k, o = keys[order], own[order]
        new = np.concatenate([[True], (k[1:] != k[:-1]) | (o[1:] != o[:-1])])
        at = np.flatnonzero(new)
        many = np.diff(np.append(at, len(k)))
        most = np.zeros(rows)
        np.maximum.at(most, o[at], many)
        return np.bincount(o[at], minlength=rows).astype(float), most

    words, top = distinct(h, owner)
    grams = []
    for k in (2, 3):
        g = tb.gram_hash(h, k)[: max(0, len(h) - k + 1)]
        own = owner[: len(g)]
        inside = owner[k - 1 :] == own if len(g) else np.zeros(0, bool)
        d, _ = distinct(g[inside], own[inside])
        grams.append(d / np.maximum(count - k + 1, 1))
    ls, le, lf = tb.runs(~_LINE[data], offsets)
    lines = np.diff(lf)
    dl, _ = distinct(tb.span_hash(tb.prefix(data), ls, le), np.repeat(np.arange(rows), lines))
    upper = np.concatenate([[0], np.cumsum(_UPPER[data])])
    caps = upper[end] - upper[start]
    last = data[end - 1] if len(end) else np.zeros(0, np.uint8)
    cap_first = _UPPER[data[start]] if len(start) else np.zeros(0, bool)
    part = lambda flags: tb.row_sums(flags.astype(float), first) / some
    return np.stack(
        [
            np.log1p(size), np.log1p(count), mean, spread, share(_UPPER), share(_DIGIT), share(_WIDE), share(_SIGN), share(_BLANK), share(_END), byte(","), byte("!"), byte("|"), byte(":"), byte("/"),
            byte("<") + byte(">"), byte("#"), share(_LINE), np.log1p(count / np.maximum(lines, 1)),
            words / some, top / some, grams[0], grams[1], dl / np.maximum(lines, 1), part(length <= 3), part(length > 14), part(cap_first), part((caps >= 2) & (caps * 2 >= length)), part(_SIGN[last]),
        ],
        axis=1,
    )


class Projection:
    """Standardised statistics mapped to cosines whose inner products approximate a Gaussian kernel.

    x: rows that the kernel's width is taken from (the median distance of pairs of them).
    """

    def __init__(self, mean: np.ndarray, scale: np.ndarray, x: np.ndarray, features: int = FEATURES, seed: int = 11) -> None:
        rng = np.random.default_rng(seed)
        self.mean, self.scale = mean, np.maximum(scale, 1e-6)
        z = self._standard(x)
        a, b = rng.integers(0, len(z), 4000), rng.integers(0, len(z), 4000)
        width = max(float(np.median(np.sqrt(((z[a] - z[b]) ** 2).sum(axis=1)))), 1e-3)
        self.frequency = rng.normal(0, 1 / width, (x.shape[1], features))
        self.phase = rng.uniform(0, 2 * np.pi, features)

    def _standard(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -6, 6)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.sqrt(2 / len(self.phase)) * np.cos(self._standard(x) @ self.frequency + self.phase)
        return np.concatenate([z, np.ones((len(x), 1))], axis=1)


def isotonic(score: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the weighted non-decreasing fit of y on score (pool adjacent violators); ties of score are pooled first."""
    weight = np.ones(len(y)) if weight is None else weight
    x, back = np.unique(score, return_inverse=True)
    w = np.bincount(back, weights=weight)
    v = np.bincount(back, weights=weight * y) / w
    blocks: list[list[float]] = []  # value, weight, first, last
    for i in range(len(x)):
        blocks.append([v[i], w[i], x[i], x[i]])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            b, a = blocks.pop(), blocks.pop()
            blocks.append([(a[0] * a[1] + b[0] * b[1]) / (a[1] + b[1]), a[1] + b[1], a[2], b[3]])
    knots = np.array([k for b in blocks for k in ((b[2], b[0]), (b[3], b[0]))])
    return knots[:, 0], knots[:, 1]


class Model:
    def __init__(self, projection: Projection, weight: np.ndarray, knots: tuple[np.ndarray, np.ndarray]) -> None:
        self.projection, self.weight, self.knots = projection, weight, knots

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.projection(x) @ self.weight, *self.knots), 0, 1)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), len(STATISTICS))


def fit(docs: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0, per_class: int = TRAIN_PER_CLASS, max_chars: int = TRAIN_CHARS) -> Model | None:
    """Fit on at most `per_class` rows of each class outside the held-out fold; None if a class is missing.

    The sample's statistics (29 numbers a row) are one table in a few partitions. Their scales are aggregates of it, the
    kernel's width comes from its first rows, and the normal equations are summed where the rows are: each partition
    gives one matrix. Rows are weighted so that the sample's class shares equal those of the labels. Calibration is
    isotonic on the fitted scores, with the same weights.
    """
    spark = docs.sparkSession
    sample = labelled_sample(docs, labels, "quality", per_class, folds, fold, max_chars)

    def make():
        return lambda batch: {"x": pa.array(list(statistics(batch.column(batch.schema.get_field_index("text")))), pa.list_(pa.float64()))}

    stats = map_arrow(sample, make, [("x", T.ArrayType(T.DoubleType()))], ["doc_id", "y"])
    stats = materialize(stats.repartition(FIT_PARTITIONS, "doc_id").sortWithinPartitions("doc_id", "x"), "quality-sample")
    moments = stats.select("y", F.posexplode("x").alias("at", "v")).groupBy("at").agg(F.avg("v").alias("mean"), F.stddev_pop("v").alias("scale")).orderBy("at").collect()
    counts = {r.y: r["count"] for r in stats.groupBy("y").count().collect()}
    if len(counts) < 2:
        return None
    shares = {r.quality: r["count"] for r in labels.where(F.col("quality").isin(0, 1) & ~held_out("doc_id", folds, fold)).groupBy("quality").count().collect()}
    per_row = np.array([shares[k] / counts[k] for k in (0, 1)])
    per_row = per_row * sum(counts.values()) / sum(shares[k] for k in (0, 1))
    first = stats.orderBy(F.xxhash64("doc_id"), "doc_id", "x").limit(WIDTH_ROWS).collect()
    projection = Projection(np.array([r.mean for r in moments]), np.array([r.scale for r in moments]), np.array([r.x for r in first]))
    shared = spark.sparkContext.broadcast((projection, per_row))
    width = FEATURES + 1

    def sums(batches):
        projection, per_row = shared.value
        gram, rhs = np.zeros((width, width)), np.zeros(width)
        for batch in batches:
            y = batch.column(1).to_numpy()
            z = projection(_matrix(batch.column(0)))
            weighted = z * per_row[y][:, None]
            gram += z.T @ weighted
            rhs += weighted.T @ y
        yield pa.RecordBatch.from_arrays([pa.array([gram.ravel()], pa.list_(pa.float64())), pa.array([rhs], pa.list_(pa.float64()))], names=["gram", "rhs"])

    parts = stats.select("x", "y").mapInArrow(sums, "gram array<double>, rhs array<double>").collect()  # a matrix for each of the few partitions
    gram = sum(np.array(p.gram).reshape(width, width) for p in parts)
    rhs = sum(np.array(p.rhs) for p in parts)
    solved = np.linalg.solve(gram + RIDGE * sum(counts.values()) * np.diag([*np.ones(FEATURES), 0.0]) / 10, rhs)
    weights = spark.sparkContext.broadcast(solved)

    def make_fitted():
        return lambda batch: {"fitted": pa.array(shared.value[0](_matrix(batch.column(batch.schema.get_field_index("x")))) @ weights.value)}

    rows = map_arrow(stats, make_fitted, [("fitted", T.DoubleType())], ["y"], read=("x",)).collect()  # at most 2 * per_class pairs of numbers
    discard(stats)
    y = np.array([r.y for r in rows])
    return Model(projection, solved, isotonic(np.array([r.fitted for r in rows]), y.astype(float), per_row[y]))


def quality_scores(docs: DataFrame, model: Model | None, keep: list[str]) -> DataFrame:
    """The `keep` columns with `score`, the calibrated chance of label 1, for every whole text (0.5 without a model)."""
    tune(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        def work(batch: pa.RecordBatch) -> dict:
            if shared.value is None:
                return {"score": np.full(batch.num_rows, 0.5)}
            return {"score": pa.array(shared.value.score(statistics(batch.column(batch.schema.get_field_index("text")))))}

        return work

    return map_arrow(docs, make, [("score", T.DoubleType())], keep)


def quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, folds: int = 5, fold: int = 0, per_class: int = TRAIN_PER_CLASS) -> DataFrame:
    """doc_id, held_out, score and predicted (1 if score >= threshold) for every row of `docs`.

    Labels outside the held-out fold train the model; lang, source and doc_id never enter a score. Null and empty texts
    are scored by their (zero) statistics; repeated rows get equal scores; an empty table gives an empty result.
    """
    tune(docs.sparkSession)
    scored = quality_scores(docs, fit(docs, labels, folds, fold, per_class), ["doc_id"])
    return scored.select("doc_id", held_out("doc_id", folds, fold).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
