"""The thin queries over the driver's tables, one for each corpus operator, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.decontaminate import contaminated, items_digest, overlap
from quire.llm.exact_dedup import exact_dedup
from quire.llm.language_id import language_id
from quire.llm.line_dedup import line_dedup
from quire.llm.quality import quality
from quire.llm.secret_scan import secret_scan
from quire.llm.sentencepiece_scan import encode
from quire.llm.simhash import fingerprint_hex, near_duplicates
from quire.llm.suffix_dedup import suffix_dedup
from quire.llm.toxicity import toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup(_table(spark, sf_dir, "documents").select("doc_id", "text"), counts=True)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted", F.size("toxic_spans").cast("long").alias("n_spans"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = overlap(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), ["doc_id"])
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), items_digest().alias("items_sha256"), contaminated().alias("contaminated")
    )


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(_table(spark, sf_dir, "documents"), ["doc_id"], with_text=False)


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(_table(spark, sf_dir, "documents"), ["doc_id"], with_ids=False)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(_table(spark, sf_dir, "documents"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(_table(spark, sf_dir, "documents"), keep="max").select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", fingerprint_hex().alias("fingerprint"), "component_id")


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(_table(spark, sf_dir, "documents"), ["doc_id"]).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_toxicity": op2_toxicity,
    "op3_decontaminate": op3_decontaminate,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_language_id": op6_language_id,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_quality": op8_quality,
    "op9_simhash": op9_simhash,
    "op10_secret_scan": op10_secret_scan,
}

_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_ASCII_LOWER = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL: dict[str, str] = {
    "op1_line_dedup": r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, i - 1 AS line_no, lines[i] AS line FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM d)),
m AS (SELECT *, string_split(masked, ' ') AS toks FROM (
    SELECT doc_id, line_no, regexp_replace(trim(regexp_replace(line, '[ \t\r\f\x0B]+', ' ', 'g')), '[^ ]*[0-9][^ ]*', '<*>', 'g') AS masked FROM l)
  WHERE masked <> ''),
k AS (SELECT doc_id, line_no, masked, toks, len(toks) || ' ' || array_to_string(toks[1:3], ' ') AS leaf FROM m),
forms AS (SELECT leaf, masked, any_value(toks) AS toks, count(*) AS n FROM k GROUP BY leaf, masked),
wide AS (SELECT leaf FROM forms GROUP BY leaf HAVING count(*) >= 2 AND sum(n) >= 3),
spread AS (SELECT leaf, pos, token, sum(n) AS n FROM (
    SELECT leaf, n, unnest(range(4, len(toks) + 1)) AS pos, unnest(toks[4:]) AS token FROM forms SEMI JOIN wide USING (leaf)) GROUP BY ALL),
template AS (SELECT leaf, pos, token FROM spread QUALIFY row_number() OVER (PARTITION BY leaf, pos ORDER BY n DESC, token) = 1),
agree AS (SELECT f.leaf, f.masked, len(any_value(f.toks)) - 3 AS tail, count(*) AS same
    FROM forms f JOIN template t ON f.leaf = t.leaf AND f.toks[t.pos] = t.token GROUP BY f.leaf, f.masked),
merged AS (SELECT masked, leaf FROM agree WHERE 10 * same >= 7 * tail),
keyed AS (SELECT k.doc_id, k.line_no, coalesce('leaf ' || g.leaf, 'line ' || k.masked) AS key FROM k LEFT JOIN merged g USING (masked)),
often AS (SELECT key, min(doc_id * 1000000000 + line_no) AS first FROM keyed GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
dropped AS (SELECT doc_id, line_no FROM keyed JOIN often USING (key) WHERE doc_id * 1000000000 + line_no <> first),
kept AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY line_no) AS text FROM l ANTI JOIN dropped USING (doc_id, line_no) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.lines) AS BIGINT) AS n_lines, CAST((SELECT count(*) FROM dropped x WHERE x.doc_id = d.doc_id) AS BIGINT) AS n_dropped,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
""",
    "op3_decontaminate": f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_ASCII_LOWER.format("text")}, '{_WORDS}') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_ASCII_LOWER.format("text")}, '{_WORDS}') AS w FROM benchmark),
g AS (SELECT item_id, w, least(len(w), 13) AS k FROM b WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS s
            FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM g)),
sizes AS (SELECT DISTINCT k FROM windows),
places AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS s
           FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d CROSS JOIN sizes WHERE len(w) >= k)),
hits AS (SELECT p.doc_id, p.k, p.i, x.item_id FROM places p JOIN windows x ON x.k = p.k AND x.s = p.s),
covered AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + k)) AS pos FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
          FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(c.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(i.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(i.ids, '')) AS items_sha256,
       coalesce(c.n_hit, 0) > 0 AND 20 * coalesce(c.n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN covered c USING (doc_id) LEFT JOIN items i USING (doc_id)
""",
    "op4_suffix_dedup": """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
w AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM (SELECT doc_id, h, unnest(range(0, n - 49)) AS i FROM d WHERE n >= 50)),
least AS (SELECT s, min(doc_id) AS m FROM w GROUP BY s),
hits AS (SELECT w.doc_id, w.i FROM w JOIN least USING (s) WHERE m < w.doc_id),
marked AS (SELECT *, CASE WHEN i > lag(i, 1, -1000) OVER (PARTITION BY doc_id ORDER BY i) + 50 THEN 1 ELSE 0 END AS new FROM hits),
numbered AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM marked),
runs AS (SELECT doc_id, run, min(i) AS a, max(i) + 50 AS b FROM numbered GROUP BY doc_id, run),
ends AS (SELECT doc_id, a, b FROM runs UNION ALL SELECT doc_id, n, n FROM d),
parts AS (SELECT e.doc_id, e.a, e.b, substr(d.h, 2 * p + 1, 2 * (e.a - p)) AS part FROM (
  SELECT *, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a, b) AS p FROM ends) e JOIN d USING (doc_id)),
kept AS (SELECT doc_id, string_agg(part, '' ORDER BY a, b) AS h, sum(b - a) AS n_removed, count(*) - 1 AS n_spans FROM parts GROUP BY doc_id)
SELECT d.doc_id, CAST(d.n AS BIGINT) AS n_bytes, CAST(n_removed AS BIGINT) AS n_removed, CAST(n_spans AS BIGINT) AS n_spans, sha256(unhex(kept.h)) AS kept_sha256
FROM d JOIN kept USING (doc_id)
""",
    "op7_exact_dedup": """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(text) AS text_sha256
FROM d WINDOW w AS (PARTITION BY text)
""",
}
