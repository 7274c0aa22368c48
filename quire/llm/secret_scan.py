"""Secret scanning: fixed patterns, and a battery of randomness tests over every long token."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm import textblocks as tb
from quire.llm.common import map_arrow, materialize, named, tune

#: The patterns of the base kinds.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
KINDS = ("assign", "access", "hex", "random")
_ASSIGN = re.compile(ASSIGN, re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(ACCESS)
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
_KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
#: Tokens shorter than this are not tested: the battery has no power there.
MIN_TOKEN = 20
#: Share of false finds accepted among all random tokens of the collection.
FALSE_SHARE = 0.01
#: A test rejects uniform characters below this chance; a token that any of them rejects is not random.
REJECT = 0.001
#: Share of capitals among the letters of names that join capitalised words.
CAPITALS = 0.2
_TOKEN = re.compile(r"[A-Za-z0-9+/_-]{%d,}={0,2}" % MIN_TOKEN)
_CHARS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
_TOKEN_BYTES = tb.byte_table(_CHARS.encode())
_HEX_BYTES = tb.byte_table(b"0123456789abcdef")
#: Alphabets: the smallest (of equals the first) that holds all characters is the inferred encoding.
ENCODINGS = (
    ("decimal", "0123456789"),
    ("hex", "0123456789abcdef"),
    ("HEX", "0123456789ABCDEF"),
    ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("lower36", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("base62", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64url", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
    ("upper36", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("lower", "abcdefghijklmnopqrstuvwxyz"),
    ("upper", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
)
_BY_SIZE = [(name, {c: i for i, c in enumerate(alphabet)}) for name, alphabet in sorted(ENCODINGS, key=lambda e: len(e[1]))]
#: Usual shares of the letters a to z in English text, in thousandths.
LETTERS = (82, 15, 28, 43, 127, 22, 20, 61, 70, 2, 8, 40, 24, 67, 75, 19, 1, 60, 63, 91, 28, 10, 24, 2, 20, 1)
#: Characters of made-up running text that the reference starts from: lower-case letters, capitals, digits and signs in these shares.
PRIOR = 5_000
_SHARES = (0.95, 0.03, 0.015, 0.005)


def _upper(z: float) -> float:
    """Chance that a standard normal exceeds z."""
    return 0.5 * math.erfc(z / math.sqrt(2))


def _chi_tail(x: float, df: float) -> float:
    """Chance that a chi-squared variable exceeds x (Wilson and Hilferty's cube-root approximation)."""
    if x <= 0:
        return 1.0
    return _upper(((x / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df)))


def measures(token: str) -> tuple[str, int, int, float, float, float] | None:
    """Encoding, alphabet size, length and the statistics of the battery's three tests; None if no alphabet fits.

    Chi-squared distance from equal shares of all characters; changes between the alphabet's halves (one less than the
    runs), and the sum of products of neighbouring values, both standardised under uniform characters.
    """
    body = token.rstrip("=")
    for name, place in _BY_SIZE:
        if body and all(c in place for c in body):
            break
    else:
        return None
    k, n = len(place), len(body)
    v = np.array([place[c] for c in body])
    chi = float((np.bincount(v, minlength=k) ** 2).sum()) * k / n - n
    if n < 2:
        return name, k, n, chi, 0.0, 0.0
    high = 2 * v >= k
    rate = _changes(k)
    runs = (float((high[1:] != high[:-1]).sum()) - (n - 1) * rate) / math.sqrt((n - 1) * rate * (1 - rate))
    u = (v - (k - 1) / 2) / math.sqrt((k * k - 1) / 12)
    return name, k, n, chi, runs, float((u[1:] * u[:-1]).sum()) / math.sqrt(n - 1)


def _changes(k: int) -> float:
    """Chance that two uniform characters lie in different halves of an alphabet of k."""
    high = (k - (k + 1) // 2) / k
    return 2 * high * (1 - high)


def battery(token: str) -> tuple[str, float, float, float] | None:
    """The inferred encoding and the p-values of three tests for a token of uniform random characters.

    Chi-squared uniformity of the alphabet (as a gamma variable of the statistic's exact mean and variance, so that short
    tokens count), runs in the alphabet's halves, and serial correlation of neighbouring values. Padding at the end is left
    out; None if no alphabet fits.
    """
    got = measures(token)
    if got is None:
        return None
    name, k, n, chi, runs, serial = got
    scale = max(n - 1, 1) / n
    return name, _chi_tail(chi / scale, (k - 1) / scale), min(1.0, 2 * _upper(abs(runs))), min(1.0, 2 * _upper(abs(serial)))


class Reference:
    """What the battery's statistics look like in running text, from the pairs of neighbouring characters of a collection.

    pairs: counts of each two token characters that stand side by side, in the order of the token alphabet.
    """

    def __init__(self, pairs: np.ndarray | None = None) -> None:
        letters = np.array(LETTERS, float) / sum(LETTERS)
        single = np.concatenate([_SHARES[1] * letters, _SHARES[0] * letters, np.full(10, _SHARES[2] / 10), np.full(4, _SHARES[3] / 4)])
        plain = PRIOR * np.outer(single, single) + (0 if pairs is None else pairs)
        # letters without their case, and with capitals as often as where capitalised words are joined
        pair = plain[:26, :26] + plain[:26, 26:52] + plain[26:52, :26] + plain[26:52, 26:52]
        shouted, joined = plain.copy(), plain.copy()
        shouted[:26, :26] = shouted[26:52, 26:52] = pair
        shouted[:26, 52:] = shouted[26:52, 52:] = plain[:26, 52:] + plain[26:52, 52:]
        shouted[52:, :26] = shouted[52:, 26:52] = plain[52:, :26] + plain[52:, 26:52]
        for case, share in zip(((0, 0), (0, 26), (26, 0), (26, 26)), (0.0, CAPITALS, CAPITALS, 1 - 2 * CAPITALS), strict=True):
            joined[case[0] : case[0] + 26, case[1] : case[1] + 26] = pair * share
        self.moments = [self._moments(shouted, joined), self._moments(shouted, plain)]

    @staticmethod
    def _moments(one_case: np.ndarray, mixed: np.ndarray) -> dict[str, tuple[float, ...]]:
        """Per encoding: sums of squared and cubed shares, share of changes between halves, mean and variance of neighbours' products."""
        out = {}
        for name, alphabet in ENCODINGS:
            total = mixed if "a" in alphabet and "A" in alphabet else one_case
            at = np.array([_CHARS.index(c) for c in alphabet])
            both = total[np.ix_(at, at)]
            both = both / both.sum()
            p, k = both.sum(axis=1), len(at)
            half = 2 * np.arange(k) >= k
            u = (np.arange(k) - (k - 1) / 2) / math.sqrt((k * k - 1) / 12)
            product = np.outer(u, u)
            serial = float((both * product).sum())
            change = float(both[half[:, None] != half[None]].sum())
            out[name] = (float((p**2).sum()), float((p**3).sum()), change, serial, float((both * product**2).sum()) - serial**2)
        return out

    def chance(self, token: str) -> float:
        """Chance that running text of this length and alphabet looks as random as the token does; 1 if a test rejects it.

        Every statistic is compared with its mean and spread in running text, and the three are combined with the
        distances between running text and uniform characters as weights (Stouffer's method), so the tests that tell
        the two apart at this length count most. Of plain text and text of joined capitalised words the larger chance counts.
        """
        got = measures(token)
        if got is None or got[2] < 2 or min(battery(token)[1:]) < REJECT:
            return 1.0
        return max(self._chance(m[got[0]], *got[1:]) for m in self.moments)

    @staticmethod
    def _chance(moments: tuple[float, ...], k: int, n: int, chi: float, runs: float, serial: float) -> float:
        p2, p3, change, product, spread = moments
        # coincidences of n independent characters have this mean and variance exactly; their cube root is nearly normal
        pairs = n * (n - 1) * p2
        var = 2 * n * (n - 1) * (p2 + 2 * (n - 2) * p3 - (2 * n - 3) * p2**2)
        wide = var / (9 * pairs**2)
        root = lambda u: (max(u, 0.0) / pairs) ** (1 / 3)
        rate = _changes(k)
        unit = math.sqrt(rate * (1 - rate))
        tests = [
            (root((chi + n - k) * n / k), 1 - wide, math.sqrt(wide), root(n * (n - 1) / k)),
            (runs, math.sqrt(n - 1) * (change - rate) / unit, math.sqrt(max(change * (1 - change), 1e-9)) / unit, 0.0),
            (serial, math.sqrt(n - 1) * product, math.sqrt(max(spread, 1e-9)), 0.0),
        ]
        z = weight = 0.0
        for x, mean, sd, random in tests:
            far = (mean - random) / sd
            z += far * (x - mean) / sd
            weight += far**2
        return _upper(-z / math.sqrt(weight)) if weight > 1e-12 else 1.0


def _candidates(text: str, reference: Reference) -> tuple[list[tuple[float, int, int, str]], int, int]:
    """(log chance less log length, start, end, encoding) of tokens and their parts, best first, without overlaps.

    Also how many were tested, and their summed length. A token ends at an equals sign; of a token with slashes, dashes or
    underscores the parts between them are tested too, as a secret may stand in a path or behind a prefix.
    """
    out, tested, total = [], 0, 0
    for m in _TOKEN.finditer(text):
        spans = {(m.start(), m.end())}
        for signs in ("/", "-_", "/+-_"):
            spans |= {(m.start() + x.start(), m.start() + x.end()) for x in re.finditer(f"[^{re.escape(signs)}]{{{MIN_TOKEN},}}", m[0])}
        for s, e in sorted(spans):
            tested += 1
            total += e - s
            chance = reference.chance(text[s:e])
            if chance < 1:
                out.append((math.log(max(chance, 1e-300)) - math.log(e - s), s, e, measures(text[s:e])[0]))
    kept: list[tuple[float, int, int, str]] = []
    for c in sorted(out):
        if all(c[2] <= k[1] or k[2] <= c[1] for k in kept):
            kept.append(c)
    return kept, tested, total


def limit(counts: dict[int, int], tested: int, total: int, false_share: float) -> float:
    """The largest score (log chance less log length) that the step-up rule of Benjamini and Hochberg accepts.

    counts: candidates by score, in bins of 1 / BINS. Each chance is weighted by the token's length over the mean length,
    so longer tokens get more of the error budget; the expected share of false finds is at most `false_share`.
    """
    best, seen = -math.inf, 0
    for b in sorted(counts):
        seen += counts[b]
        edge = (b + 1) / BINS
        if edge + math.log(total / tested) <= math.log(false_share * seen / tested):
            best = edge
    return best


BINS = 64


def _bin(score: float) -> int:
    return math.floor(score * BINS)


def random_tokens(text: str, false_share: float = FALSE_SHARE, reference: Reference | None = None) -> list[tuple[int, int, str]]:
    """Spans and encodings of the random tokens of one text, under the rule for a collection of this text alone."""
    found, tested, total = _candidates(text, reference or Reference())
    top = limit(Counter(_bin(c[0]) for c in found), tested, total, false_share)
    return sorted((s, e, name) for score, s, e, name in found if score < top)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, index of the kind) of the pattern matches, by start, then kind."""
    out = [(m.start(), m.end(), 0) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), m.end(), 1) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), m.end(), 2) for m in _HEX.finditer(text)]
    return sorted(out, key=lambda x: (x[0], x[2]))


def _suspects(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows that may hold a match: those with a keyword, an access prefix or a long enough run of token characters."""
    out = np.zeros(len(offsets) - 1, bool)

    def mark(at: np.ndarray) -> None:
        out[np.searchsorted(offsets, at, side="right") - 1] = True

    for table, least in ((_TOKEN_BYTES, MIN_TOKEN), (_HEX_BYTES, 24)):
        start, end, _ = tb.runs(table[data], offsets)
        mark(start[end - start >= least])
    low = tb.ASCII_LOWER[data].tobytes()
    for word in _KEYWORDS:
        at = low.find(word)
        hits = []
        while at >= 0:
            hits.append(at)
            at = low.find(word, at + 1)
        if hits:
            mark(np.array(hits))
    raw = data.tobytes()
    at = raw.find(b"AKIA")
    while at >= 0:
        mark(np.array([at]))
        at = raw.find(b"AKIA", at + 1)
    return out


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, e, k in spans)


_SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("kind_no", T.IntegerType()), T.StructField("end", T.LongType()), T.StructField("encoding", T.StringType()), T.StructField("score", T.DoubleType())])
_FIELDS = [
    ("n_assign", T.LongType()), ("n_access", T.LongType()), ("n_hex", T.LongType()), ("base_sha256", T.StringType()),
    ("spans", T.ArrayType(_SPAN)), ("tested", T.LongType()), ("tested_length", T.LongType()),
]


def fit_reference(docs: DataFrame) -> Reference:
    """The reference of all texts: pairs of neighbouring token characters, summed in each task, then over all of them."""
    place = np.full(256, len(_CHARS))
    place[list(_CHARS.encode())] = np.arange(len(_CHARS))
    width = len(_CHARS) + 1

    def count(batches):
        pairs = np.zeros(width * width, np.int64)
        for batch in batches:
            data, offsets = tb.buffer(batch.column(0))
            code = place[data]
            both = code[:-1] * width + code[1:]
            both[offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))] - 1] = width * width - 1  # between two texts
            pairs += np.bincount(both, minlength=width * width)
        some = np.flatnonzero(pairs)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(pairs[some])], names=["pair", "n"])

    rows = docs.select("text").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect()  # at most 67 x 67 rows
    total = np.zeros(width * width)
    for r in rows:
        total[r.pair] = r.n
    return Reference(total.reshape(width, width)[:-1, :-1])


def secret_scan(docs: DataFrame, keep: list[str], false_share: float = FALSE_SHARE) -> DataFrame:
    """The `keep` columns of each document with the secrets in its whole text.

    n_assign, n_access, n_hex count the pattern matches (leftmost, not overlapping, per kind); base_sha256 is the digest of
    their `kind:start:end` list; `spans` lists these and the random tokens that overlap none of them, by start, then kind;
    `found` is the same as structs, with the inferred encoding of random tokens. Offsets are code points, ends exclusive.

    Random tokens are found by the battery: a token that no test rejects as uniform characters of its encoding is compared
    with running text, whose statistics come from all texts, and the step-up rule over the tokens of all documents
    bounds the share of false finds. So a row's random spans depend on the table, its base spans on its text alone.
    Null text is empty; repeated rows get equal results, and an empty table an empty one. A kept column with the name of a
    result gives way to it.
    """
    tune(docs.sparkSession)
    nothing = hashlib.sha256(b"").hexdigest()
    reference = docs.sparkSession.sparkContext.broadcast(fit_reference(docs))

    def make():
        def work(batch: pa.RecordBatch) -> dict:
            column = batch.column(batch.schema.get_field_index("text"))
            suspects = _suspects(*tb.buffer(column))
            out = {n: [] for n, _ in _FIELDS}
            for i in range(batch.num_rows):
                row = (0, 0, 0, nothing, [], 0, 0)
                if suspects[i]:
                    text = column[i].as_py()
                    base = base_spans(text)
                    outside = text
                    for s, e, _ in base:  # what a pattern has found is not tested
                        outside = outside[:s] + " " * (e - s) + outside[e:]
                    more, tested, total = _candidates(outside, reference.value)
                    spans = [{"start": s, "kind_no": k, "end": e} for s, e, k in base]
                    spans += [{"start": s, "kind_no": 3, "end": e, "encoding": name, "score": score} for score, s, e, name in more]
                    counts = np.bincount([k for *_, k in base], minlength=3)
                    row = (int(counts[0]), int(counts[1]), int(counts[2]), hashlib.sha256(_joined(base).encode()).hexdigest(), spans, tested, total)
                for k, v in zip(out, row, strict=True):
                    out[k].append(v)
            return out

        return work

    results = ["n_assign", "n_access", "n_hex", "base_sha256", "spans", "found"]
    names = {f"__quire_{i}": c for i, c in enumerate(keep) if c not in results}
    scanned = map_arrow(docs.select(*[named(c).alias(n) for n, c in names.items()], "text"), make, _FIELDS, list(names))
    scanned = materialize(scanned, "secrets")
    tested = scanned.agg(F.coalesce(F.sum("tested"), F.lit(0)).alias("n"), F.coalesce(F.sum("tested_length"), F.lit(0)).alias("total")).first()
    scores = scanned.select(F.explode("spans.score").alias("score")).where(F.col("score").isNotNull())
    # scores lie between -700 and 0: a bounded number of bins
    counts = {r.bin: r["count"] for r in scores.groupBy(F.floor(F.col("score") * BINS).alias("bin")).count().collect()}
    top = limit(counts, tested.n, tested.total, false_share)
    kinds = F.array(*map(F.lit, KINDS))
    kept = F.array_sort(F.filter("spans", lambda x: x["score"].isNull() | (x["score"] < F.lit(top))))
    found = F.transform(kept, lambda x: F.struct(kinds[x["kind_no"]].alias("kind"), x["start"].alias("start"), x["end"].alias("end"), x["encoding"].alias("encoding")))
    listed = scanned.withColumn("found", found)
    spans = F.array_join(F.transform("found", lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    return listed.select(*[F.col(n).alias(c) for n, c in names.items()], *results[:4], spans.alias("spans"), "found")
