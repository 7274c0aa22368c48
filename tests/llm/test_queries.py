import glob
import hashlib
import os

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quire.llm.queries import QUERIES, SQL
from quire.llm.sentencepiece_scan import decode

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in glob.glob(f"{DATA}/*.parquet"):
        c.sql(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return c


def rows(names, values):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([repr(tuple(r[i] for i in order)) for r in values])


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    df, want = QUERIES[name](spark, DATA), duck.sql(SQL[name])
    assert rows(df.columns, df.collect()) == rows(want.columns, want.fetchall())


CONTRACT = {
    "op1_line_dedup": ["doc_id", "n_lines", "n_dropped", "kept_sha256"],
    "op2_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op3_decontaminate": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    "op4_suffix_dedup": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op5_sentencepiece": ["doc_id", "n_tokens", "ids_sha256", "round_trip"],
    "op6_language_id": ["doc_id", "held_out", "lang_pred", "score"],
    "op7_exact_dedup": ["doc_id", "keep_id", "group_size", "kept", "text_sha256"],
    "op8_quality": ["doc_id", "held_out", "score", "predicted"],
    "op9_simhash": ["doc_id", "fingerprint", "component_id"],
    "op10_secret_scan": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
}


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_contract_columns(spark, name):
    assert QUERIES[name](spark, DATA).columns[: len(CONTRACT[name])] == CONTRACT[name]


def test_pipeline(spark, duck):
    """Each stage against the plain result of its own input."""
    from tests.llm.test_operators import brute_components, brute_fingerprint, brute_overlap

    docs = spark.read.parquet(f"{DATA}/documents.parquet").withColumn("score", F.lit(1)).withColumn("fp", F.lit("x")).cache()
    (_, toxic), (_, lines), (_, near), (_, clean), (_, tokens) = corpus_pipeline.STAGES
    a = toxic(spark, docs, DATA).cache()
    bad = {r.doc_id for r in QUERIES["op2_toxicity"](spark, DATA).where("predicted = 1").collect()}
    assert {r.doc_id for r in a.collect()} == {r.doc_id for r in docs.collect()} - bad
    b = lines(spark, a, DATA).cache()
    plain = duckdb.connect()
    plain.register("documents", a.select("doc_id", "text").toPandas())
    want = {r[0]: r[3] for r in plain.sql(f"select doc_id, n_lines, n_dropped, kept_sha256 from ({SQL['op1_line_dedup']})").fetchall()}
    got = {r.doc_id: r for r in b.collect()}
    assert {i: hashlib.sha256(r.text.encode()).hexdigest() for i, r in got.items()} == want and all(r.n_chars == len(r.text) for r in got.values())
    c = near(spark, b, DATA).cache()
    prints = {r.doc_id: brute_fingerprint(r.text) for r in b.collect()}
    group = brute_components(set(prints.values()))
    least = {}
    for i, p in prints.items():
        least[group[p]] = min(i, least.get(group[p], i))
    assert {r.doc_id for r in c.collect()} == set(least.values())
    d = clean(spark, c, DATA).cache()
    items = [tuple(r) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").select("item_id", "text").collect()]
    kept = {r.doc_id for r in c.collect() for n, hit, _ in [brute_overlap(r.text, items)] if not (hit and 20 * hit >= n)}
    assert {r.doc_id for r in d.collect()} == kept
    assert a.columns == b.columns == c.columns == d.columns == docs.columns
    e = tokens(spark, d, DATA)
    texts = {r.doc_id: r.text for r in d.collect()}
    assert {r.doc_id: r.text for r in decode(e, ["doc_id"]).collect()} == texts and e.where("not round_trip").count() == 0


def test_pipeline_on_odd_rows(spark, tmp_path):
    odd = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "x", "en", "s", 1), (3, "x", "en", "s", 1), (None, "y y y", None, None, 5), (4, "word " * 3000, "en", "s", 15000)]
    spark.createDataFrame(odd, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"file://{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"file://{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"file://{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, f"file://{tmp_path}").collect()
    assert sorted([r.doc_id or -1 for r in got]) == [-1, 1, 3, 4]


def test_near_dedup_stage_on_repeated_and_missing_ids(spark):
    one, two = (" ".join(f"{w}{i * i}" for i in range(80)) for w in "ab")
    rows = [(1, one), (7, one), (7, two), (8, one), (8, one), (None, one), (None, two), (None, two)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.text) for r in corpus_pipeline.near_dedup_stage(spark, docs, DATA).collect()]
    assert sorted(got, key=repr) == sorted([(1, one), (7, two), (None, one), (None, two), (None, two)], key=repr)


def test_decontamination_stage_rejects_long_documents_with_one_passage(spark, tmp_path):
    """One shared passage rejects a document of any length; parts of a passage and other documents stay."""
    item = " ".join(f"item{k}" for k in range(20))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"file://{tmp_path}/benchmark.parquet")
    filler = " ".join(f"own{k}" for k in range(2000))
    rows = [(1, f"{filler} {item} {filler}"), (2, f"{filler} {' '.join(item.split()[:12])} {filler}"), (3, item), (4, filler), (5, None), (6, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.decontamination_stage(spark, docs, f"file://{tmp_path}").collect()) == [2, 4, 5, 6]


def test_stages_take_any_column_name(spark):
    """Columns with dots, backquotes and the names of results pass through every stage unchanged."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(30)
    for name in ("meta.url", "a`b", "score", "n_hit", "items", "dropped", "__quire_key2"):
        docs = docs.withColumn(name, F.concat(F.lit(name), F.col("doc_id").cast("string")))
    docs = docs.cache()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, DATA)
        assert out.columns == docs.columns
        assert all(r["meta.url"] == f"meta.url{r.doc_id}" and r["n_hit"] == f"n_hit{r.doc_id}" for r in out.collect())
    assert {r.doc_id for r in corpus_pipeline.STAGES[-1][1](spark, docs, DATA).collect()} == {r.doc_id for r in docs.collect()}


def test_finished_stages_are_deleted(spark):
    from quire.llm.common import tables

    before = set(tables(spark))
    out = corpus_pipeline.run(spark, DATA)
    left = [p for p in tables(spark) if p not in before]
    assert sum("stage-" in p for p in left) == 1 and not any("simhash" in p or "line" in p for p in left)
    assert out.count() > 0


def test_no_private_folder_on_a_cluster(monkeypatch):
    from types import SimpleNamespace

    from quire.llm import common

    none = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d: d, set=lambda k, v: None), sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_dir(none)
    none.sparkContext.master = "local[4]"
    assert common.shared_dir(none).startswith("file://")
