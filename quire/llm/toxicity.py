"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm import textblocks as tb
from quire.llm.common import fit_in_task, held_out, labelled_sample, map_arrow, tune

#: Labelled rows of each class taken for fitting, at most, and the longest text among them.
TRAIN_PER_CLASS = 3000
TRAIN_CHARS = 6_000
#: Word and beginning lengths (bytes) of lexicon entries, tried in this order; 0 is the whole word.
LEVELS = (0, 6, 5, 4, 3)
#: An entry stands in at least so many toxic documents, with this log odds ratio and z, where a document that k better
#: entries mark counts as MARKED ** k.
MARKED = 0.25
MIN_TOXIC = 5
MIN_ODDS = 2.0
MIN_Z = 4.5
MAX_LEXICON = 2000
MAX_CHAINS = 20_000
#: Tokens to each side of a lexicon token that are decoded with it; all others are background.
CONTEXT = 2
_HALF = 5


class Tokens:
    def __init__(self, column: pa.Array) -> None:
        self.raw, offsets = tb.buffer(column)
        data = tb.ASCII_LOWER[self.raw]
        self.start, self.end, self.first = tb.runs(tb.ALNUM_OR_WIDE[data], offsets)
        self.sums = tb.prefix(data)
        self.offsets = offsets
        self.owner = np.repeat(np.arange(len(column)), np.diff(self.first))

    def keys(self, level: int, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        """Hash of each token (level 0), or of its first `level` bytes; 0 for tokens that are not longer than that."""
        start, end = self.start[at], self.end[at]
        if not level:
            return tb.span_hash(self.sums, start, end)
        long = end - start > level
        key = np.zeros(len(start), np.uint64)
        key[long] = tb.span_hash(self.sums, start[long], start[long] + level)
        return key


class Lexicon:
    """Words and word beginnings that mark toxic documents; a token's entry is its word, else its longest beginning."""

    def __init__(self, tokens: Tokens, y: np.ndarray) -> None:
        toxic, clean = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
        row = np.zeros(len(y), int)
        row[toxic], row[clean] = np.arange(len(toxic)), np.arange(len(clean))
        key, level, holds = [np.zeros(0, np.uint64)], [np.zeros(0, int)], [np.zeros((len(toxic), 0), bool)]
        others = [np.zeros(0)]
        for n in LEVELS:
            k = tokens.keys(n)
            use = k != 0
            pair = np.unique(np.stack([k[use], tokens.owner[use].astype(np.uint64)], axis=1), axis=0)
            keys, back = np.unique(pair[:, 0], return_inverse=True)
            bad = y[pair[:, 1].astype(int)] == 1
            t = np.bincount(back, weights=bad, minlength=len(keys))
            c = np.bincount(back, weights=~bad, minlength=len(keys))
            good = np.flatnonzero((t >= MIN_TOXIC) & (_odds(t, c, len(toxic), len(clean)) > MIN_ODDS))
            if len(good) > MAX_LEXICON:
                good = good[np.argsort(-t[good], kind="stable")[:MAX_LEXICON]]
            place = np.full(len(keys), -1)
            place[good] = np.arange(len(good))
            inside = bad & (place[back] >= 0)
            m = np.zeros((len(toxic), len(good)), bool)
            m[row[pair[inside, 1].astype(int)], place[back[inside]]] = True
            key.append(keys[good])
            level.append(np.full(len(good), n))
            holds.append(m)
            others.append(c[good])
        key, level, holds, c = np.concatenate(key), np.concatenate(level), np.concatenate(holds, axis=1), np.concatenate(others)
        # documents that a better entry marks count for less: words that merely stand beside one are left out
        left, chosen = np.ones(len(toxic)), []
        holds = holds.astype(np.float32)
        while len(key) and len(chosen) < MAX_LEXICON:
            t = left @ holds
            n1, n0 = max(left.sum(), 1.0), max(len(clean), 1)
            pooled = (t + c + 0.5) / (n1 + n0 + 1)
            z = (t / n1 - c / n0) / np.sqrt(pooled * (1 - pooled) * (1 / n1 + 1 / n0))
            z[chosen] = -1
            z[(t < MIN_TOXIC) | (_odds(t, c, n1, n0) <= MIN_ODDS)] = -1
            best = int(z.argmax())
            if z[best] < MIN_Z or best in chosen:
                break
            chosen.append(best)
            left[holds[:, best] > 0] *= MARKED
        self.size = len(chosen)
        self.levels = {}
        for n in LEVELS:
            at = np.array([i for i in chosen if level[i] == n], int)
            order = np.argsort(key[at])
            entry = np.array([i for i, j in enumerate(chosen) if level[j] == n], int)
            if len(at):
                keys = key[at][order]
                sieve = np.zeros(1 << 16, bool)
                sieve[(keys & np.uint64(0xFFFF)).astype(int)] = True
                self.levels[n] = (keys, entry[order], sieve)

    def ids(self, tokens: Tokens) -> np.ndarray:
        """The entry of each token, -1 for none."""
        out = np.full(len(tokens.start), -1)
        for n, (keys, entry, sieve) in self.levels.items():
            k = tokens.keys(n)
            maybe = np.flatnonzero(sieve[(k & np.uint64(0xFFFF)).astype(np.int64)] & (out < 0))
            at = np.searchsorted(keys, k[maybe])
            at[at == len(keys)] = 0
            same = keys[at] == k[maybe]
            out[maybe[same]] = entry[at[same]]
        return out


def _odds(t: np.ndarray, c: np.ndarray, nt: float, nc: float) -> np.ndarray:
    """Smoothed log odds ratio of two document counts."""
    return np.log((t + 0.5) / (np.maximum(nt - t, 0) + 0.5)) - np.log((c + 0.5) / (np.maximum(nc - c, 0) + 0.5))


class Field:
    """Two states (clean, toxic): a weight per lexicon token and a bias for toxic, and transition weights."""

    def __init__(self, size: int) -> None:
        self.token = np.zeros(size + 1)  # the last one is the background, kept at zero
        self.bias = -2.0
        self.step = np.zeros((2, 2))

    def fit(self, ids: np.ndarray, labels: np.ndarray, rounds: int = 80, rate: float = 0.15, decay: float = 1e-4) -> None:
        """Maximise the conditional likelihood of equally long chains (ids: -1 is background) by Adam."""
        n, length = ids.shape
        if not n:
            return
        seen_token = np.bincount(ids[labels == 1], minlength=len(self.token)).astype(float) if (labels == 1).any() else np.zeros(len(self.token))
        pairs = np.zeros((2, 2))
        np.add.at(pairs, (labels[:, :-1], labels[:, 1:]), 1)
        ones = float((labels == 1).sum())
        first, second = np.zeros(len(self.token) + 5), np.zeros(len(self.token) + 5)
        for k in range(1, rounds + 1):
            node, edge = self._expect(ids)
            grad = np.concatenate([
                (seen_token - np.bincount(ids.ravel(), weights=node.ravel(), minlength=len(self.token))) / n - decay * self.token,
                [(ones - node.sum()) / n / length],
                ((pairs - edge) / n / length - decay * self.step).ravel(),
            ])
            first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad**2
            move = rate * (first / (1 - 0.9**k)) / (np.sqrt(second / (1 - 0.99**k)) + 1e-8)
            self.token += move[: len(self.token)]
            self.token[-1] = 0
            self.bias += move[len(self.token)]
            self.step += move[-4:].reshape(2, 2)

    def _expect(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Marginals of toxic per token, and the summed pair marginals."""
        n, length = ids.shape
        emit = np.exp(np.clip(self.bias + self.token[ids], -30, 30))
        m = np.exp(self.step)
        alpha, beta = np.zeros((length, n, 2)), np.ones((length, n, 2))
        alpha[0] = np.stack([m[0, 0] * np.ones(n), m[0, 1] * emit[:, 0]], axis=1)
        alpha[0] /= alpha[0].sum(axis=1, keepdims=True)
        for i in range(1, length):
            a = alpha[i - 1] @ m
            a[:, 1] *= emit[:, i]
            alpha[i] = a / a.sum(axis=1, keepdims=True)
        for i in range(length - 2, -1, -1):
            b = beta[i + 1].copy()
            b[:, 1] *= emit[:, i + 1]
            b = b @ m.T
            beta[i] = b / b.sum(axis=1, keepdims=True)
        p = alpha * beta
        node = (p[..., 1] / p.sum(axis=2)).T
        edge = np.zeros((2, 2))
        for i in range(length - 1):
            right = beta[i + 1].copy()
            right[:, 1] *= emit[:, i + 1]
            joint = alpha[i][:, :, None] * m[None] * right[:, None, :]
            edge += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        return node, edge

    def marginals(self, ids: np.ndarray, gap: np.ndarray, tail: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Chance of toxic at each event of whole documents, background tokens between events included exactly.

        gap: background tokens before each event; tail: those behind a document's last; bounds: events of each document.
        A run of g background tokens acts as the g-th power of one 2x2 matrix, taken by its eigenvalues.
        """
        m = np.exp(self.step)
        back = m * np.array([1.0, np.exp(self.bias)])
        values, vectors = np.linalg.eig(back)
        order = np.argsort(-np.abs(values))
        values, vectors = np.real(values[order]), np.real(vectors[:, order])
        inverse = np.linalg.inv(vectors)
        p1, p2 = np.outer(vectors[:, 0], inverse[0]), np.outer(vectors[:, 1], inverse[1])
        ratio = values[1] / values[0]

        def power(g: np.ndarray) -> np.ndarray:
            return p1 + (ratio ** g.astype(float))[:, None, None] * p2

        emit = np.exp(np.clip(self.bias + self.token[ids], -30, 30))
        move = power(gap) @ m
        move[:, :, 1] *= emit[:, None]
        docs, many = len(bounds) - 1, np.diff(bounds)
        alpha = np.zeros((len(ids), 2))
        beta = np.zeros((len(ids), 2))
        state = np.tile([1.0, 0.0], (docs, 1))
        order = np.argsort(-many, kind="stable")
        alive = np.searchsorted(-many[order], -np.arange(1, many.max(initial=0) + 1), side="right")
        for k, live in enumerate(alive):
            d = order[:live]
            at = bounds[d] + k
            s = np.einsum("ni,nij->nj", state[d], move[at])
            state[d] = alpha[at] = s / s.sum(axis=1, keepdims=True)
        state = power(tail).sum(axis=2)
        for k, live in enumerate(alive):
            d = order[:live]
            at = bounds[d + 1] - 1 - k
            beta[at] = state[d] / state[d].sum(axis=1, keepdims=True)
            state[d] = np.einsum("nij,nj->ni", move[at], beta[at])
        p = alpha * beta
        return p[:, 1] / np.maximum(p.sum(axis=1), 1e-300)


def _evidence(p: np.ndarray, kind: np.ndarray, bounds: np.ndarray, words: np.ndarray) -> np.ndarray:
    """What the document score is made of: the likeliest token, expected toxic tokens, their rate and variety."""
    docs = len(words)
    owner = np.repeat(np.arange(docs), np.diff(bounds))
    top = np.zeros(docs)
    np.maximum.at(top, owner, p)
    total = tb.row_sums(p, bounds)
    sure = p >= 0.5
    pair = np.unique(np.stack([owner[sure], kind[sure]], axis=1), axis=0) if sure.any() else np.zeros((0, 2), int)
    variety = np.bincount(pair[:, 0], minlength=docs).astype(float)
    rate = total / np.maximum(words, 1)
    return np.stack([top, np.log1p(total), np.log1p(100 * rate), np.log1p(variety), np.ones(docs)], axis=1)


class Model:
    """Lexicon, field and the logistic link from evidence to score."""

    def __init__(self, texts: list[str], y: np.ndarray, prior: float) -> None:
        tokens = Tokens(pa.array(texts, pa.string()))
        self.lexicon = Lexicon(tokens, y)
        self.field = Field(self.lexicon.size)
        ids = self.lexicon.ids(tokens)
        label = ((ids >= 0) & (y[tokens.owner] == 1)).astype(int) if len(texts) else np.zeros(0, int)
        self.field.fit(*self._chains(tokens, ids, label))
        self.link = np.zeros(5)
        if len(set(y)) < 2:
            self.link[-1] = -5.0  # nothing learned: no document is called toxic
        else:
            x = _evidence(*self._decode(tokens)[:3], np.diff(tokens.first))
            weight = np.where(y == 1, prior / y.mean(), (1 - prior) / (1 - y.mean()))
            for _ in range(50):  # Newton's method
                p = 1 / (1 + np.exp(-x @ self.link))
                g = x.T @ (weight * (y - p)) - 1e-2 * self.link
                h = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(5)
                self.link += np.linalg.solve(h, g)

    def _chains(self, tokens: Tokens, ids: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Windows of tokens around lexicon tokens, within a document: training chains of one length."""
        at = np.flatnonzero(ids >= 0)
        if len(at) > MAX_CHAINS:
            at = at[np.linspace(0, len(at) - 1, MAX_CHAINS).astype(int)]
        place = at[:, None] + np.arange(-_HALF, _HALF + 1)[None]
        doc = tokens.owner[at] if len(at) else at
        out = (place < tokens.first[doc][:, None]) | (place >= tokens.first[doc + 1][:, None])
        place = np.where(out, 0, place)
        none = out if len(at) else np.zeros((0, 2 * _HALF + 1), bool)
        if not len(at):
            return np.zeros((0, 2 * _HALF + 1), int), np.zeros((0, 2 * _HALF + 1), int)
        last = self.lexicon.size
        got = np.where(none | (ids[place] < 0), last, ids[place])
        return got, np.where(none, 0, label[place])

    def _decode(self, tokens: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Marginals, lexicon ids, bounds per document and token indexes of all events of a batch."""
        ids = self.lexicon.ids(tokens)
        hit = np.flatnonzero(ids >= 0)
        near = np.zeros(len(ids), bool)
        for k in range(-CONTEXT, CONTEXT + 1):
            to = hit + k
            ok = (to >= 0) & (to < len(ids))
            ok[ok] = tokens.owner[to[ok]] == tokens.owner[hit[ok]]
            near[to[ok]] = True
        event = np.flatnonzero(near)
        bounds = np.searchsorted(event, tokens.first)
        before = np.empty(len(event), np.int64)
        if len(event):
            before[1:] = event[:-1]
            before[0] = -1
            lead = bounds[:-1][np.diff(bounds) > 0]
            before[lead] = tokens.first[tokens.owner[event[lead]]] - 1
        gap = event - before - 1
        tail = np.zeros(len(bounds) - 1, np.int64)
        some = np.flatnonzero(np.diff(bounds) > 0)
        tail[some] = tokens.first[some + 1] - 1 - event[bounds[some + 1] - 1]
        kind = np.where(ids[event] < 0, self.lexicon.size, ids[event])
        return self.field.marginals(kind, gap, tail, bounds), kind, bounds, event

    def score(self, column: pa.Array) -> tuple[np.ndarray, list[list[dict]]]:
        """Scores, and the spans (code points) of runs of tokens that are toxic with a chance of one half or more."""
        tokens = Tokens(column)
        p, kind, bounds, event = self._decode(tokens)
        x = _evidence(p, kind, bounds, np.diff(tokens.first))
        points = np.concatenate([[0], np.cumsum((tokens.raw & 0xC0) != 0x80)])
        spans: list[list[dict]] = [[] for _ in range(len(column))]
        last = (-1, -2)
        for i in np.flatnonzero(p >= 0.5):
            doc, t = int(tokens.owner[event[i]]), int(event[i])
            zero = points[tokens.offsets[doc]]
            s, e = int(points[tokens.start[t]] - zero), int(points[tokens.end[t]] - zero)
            if last == (doc, t - 1):
                spans[doc][-1] |= {"end": e, "chance": max(spans[doc][-1]["chance"], float(p[i]))}
            else:
                spans[doc].append({"start": s, "end": e, "chance": float(p[i])})
            last = (doc, t)
        return 1 / (1 + np.exp(-x @ self.link)), spans


def fit(docs: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0, per_class: int = TRAIN_PER_CLASS, max_chars: int = TRAIN_CHARS) -> Model:
    """Fit on at most `per_class` documents of each label outside the held-out fold.

    Labels are per document, so tokens are labelled from them: tokens that toxic documents hold significantly more often
    (or word beginnings) are toxic where they stand in a toxic document, all others are clean. The field then learns token, bias and
    transition weights from these labelled tokens.
    """
    tune(docs.sparkSession)
    rows = labelled_sample(docs, labels, "toxic", per_class, folds, fold, max_chars).select("text", "y")
    share = labels.where(F.col("toxic").isin(0, 1) & ~held_out("doc_id", folds, fold)).agg(F.avg("toxic")).first()[0]
    prior = float(share or 0.5)
    return fit_in_task(rows, lambda columns: Model(columns.get("text", []), np.array(columns.get("y", []), int), prior))


_SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("chance", T.DoubleType())])


def toxicity_scores(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The `keep` columns with `score` and `toxic_spans` (start, end in code points, chance) of every whole text.

    Forward-backward runs over each document as one chain. Null and empty texts have no tokens: their score is that of
    no evidence. Rows are independent; without training rows of both labels every score is near zero.
    """
    tune(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        def work(batch: pa.RecordBatch) -> dict:
            score, spans = shared.value.score(batch.column(batch.schema.get_field_index("text")))
            return {"score": pa.array(score), "toxic_spans": spans}

        return work

    fields = [("score", T.DoubleType()), ("toxic_spans", T.ArrayType(_SPAN))]
    return map_arrow(docs, make, fields, keep)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, folds: int = 5, fold: int = 0) -> DataFrame:
    """doc_id, held_out, score, predicted (1 if score >= threshold) and toxic_spans for every row of `docs`.

    Labels outside the held-out fold train the model; lang, source and doc_id never enter a score. Null ids are scored
    and never held out; repeated rows get equal scores; an empty table gives an empty result.
    """
    scored = toxicity_scores(docs, fit(docs, labels, folds, fold), ["doc_id"])
    return scored.select("doc_id", held_out("doc_id", folds, fold).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "toxic_spans")
