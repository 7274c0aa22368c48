import re

from pyspark.sql import functions as F

from quire.operators import triples as tr
from quire.sinks.files import ntriples, turtle, upload_plan

TS = "2025-05-26T13:36:25"


def test_counts(spark):
    d = spark.createDataFrame([("1891", "i", None, 1, None), ("1892", "i2", "T", 2, "m")], "diary string, image string, title string, idx int, iiif_manifest string")
    counts = {r.graph_key: r["count"] for r in tr.diary_triples(d).groupBy("graph_key").count().collect()}
    assert counts == {"1891": 9, "1892": 10}
    p = spark.createDataFrame([("d", 7, "t", "i", "W", None)], "diary string, page int, text string, image string, location_wkt string, location_name string")
    assert tr.page_triples(p, TS).count() == 21
    dates = spark.createDataFrame([("d", 7, "1891-08-07", "$$HEADER$$_", "x")], "diary string, page int, object string, predicate string, original_text string")
    assert tr.page_date_triples(dates).count() == 8
    golden = tr.page_date_triples(dates, profile="golden")
    assert golden.count() == 12
    assert "August 07, 1891" in {r.object for r in golden.collect()}
    a = spark.createDataFrame([("d", "1", 7, "art", "f", ["l", "", None], 1, 0, 2, None)], "diary string, id string, page int, type string, fulltext string, permalinks array<string>, para_index int, start int, end int, annotator string")
    assert tr.annotation_triples(a, TS).count() == 37
    assert tr.annotation_triples(a, TS, random_ids=True).count() == 37
    source = lambda g: g.where("predicate like '%hasSource'").first().object
    assert source(tr.annotation_triples(a, TS)) == "https://example.org/diary/d/document/7"
    assert source(tr.annotation_triples(a, TS, compat_source=True)) == "https://example.org//diary/d/document/7"
    days = spark.createDataFrame([("d", 1, "1891-08-07", 7)], "diary string, day int, date string, page int")
    assert tr.day_triples(days).count() == 6


def test_sets_and_uris(spark):
    d = spark.createDataFrame([("1891", "i", None, 1, None)] * 3, "diary string, image string, title string, idx int, iiif_manifest string")
    g = tr.diary_triples(d)
    assert tr.union_graphs(g, g).count() == 9
    plan = [(r.method, r.graph_uri) for r in upload_plan(g, "x").orderBy("step").collect()]
    assert plan == [("DELETE", "https://example.org/resource/diary/1891/context"), ("POST", "https://example.org/resource/diary/1891/context")]


def test_serialisation(spark):
    p = spark.createDataFrame([("d", 7, 'a "b"\n\\c', "https://i.example.org/1")], "diary string, page int, text string, image string")
    g = tr.page_triples(p, TS)
    lines = {r.value for r in ntriples(g).collect()}
    assert len(lines) == 20
    assert '<https://example.org/resource/diary/d/page/7> <http://www.w3.org/1999/02/22-rdf-syntax-ns#value> "a \\"b\\"\\n\\\\c"^^<http://www.w3.org/2001/XMLSchema#string> .' in lines
    body = turtle(g).first().body
    assert "@prefix crm: <http://www.cidoc-crm.org/cidoc-crm/> ." in body and 'rdfs:label "7"^^xsd:string' in body


def test_graphs_of_two_diaries_stay_apart(spark):
    """Annotation, day and page numbers repeat between diaries; the key keeps their graphs apart."""
    a = spark.createDataFrame([(d, "0", 1, "art", "f", ["l"], 1, 0, 2, None) for d in "de"], "diary string, id string, page int, type string, fulltext string, permalinks array<string>, para_index int, start int, end int, annotator string")
    keys = lambda g: {r.graph_key for r in g.select("graph_key").distinct().collect()}
    assert keys(tr.annotation_triples(a, TS, key=F.concat_ws("/", "diary", "id"))) == {"d/0", "e/0"}
    assert tr.annotation_triples(a, TS, key=F.concat_ws("/", "diary", "id")).groupBy("graph_key").count().where("count = 37").count() == 2
    days = spark.createDataFrame([(d, 1, "1891-08-07", 7) for d in "de"], "diary string, day int, date string, page int")
    assert keys(tr.day_triples(days, key=F.concat_ws("/", "diary", "day"))) == {"d/1", "e/1"}
    dates = spark.createDataFrame([(d, 7, "1891-08-07", "$$HEADER$$_", "x") for d in "de"], "diary string, page int, object string, predicate string, original_text string")
    assert keys(tr.page_date_triples(dates, key=F.concat_ws("/", "diary", "page"))) == {"d/7", "e/7"}


def each_row_its_own_graph(build, rows, key):
    """Triples of rows that were filled one by one: graph keys with their triples, each once."""
    numbered = rows.coalesce(1).withColumn("row", F.monotonically_increasing_id()).cache()
    keys = {str(r.row): r.k for r in numbered.select("row", key.cast("string").alias("k")).collect()}
    return {(keys[r.graph_key], *r[2:]) for r in build(numbered, F.col("row")).collect()}


def test_rows_of_one_graph_give_each_triple_once(spark):
    """Repeated rows, several rows of a graph that share some triples, parts that a row lacks."""
    dates = spark.createDataFrame(
        [(d, page, f"1891-08-0{day}", "$$HEADER$$_", text) for d in "dea" for page in (1, 2, None) for day in (7, 8, 7, 9) for text in ("x", None, "y")],
        "diary string, page int, object string, predicate string, original_text string",
    )
    annotations = spark.createDataFrame(
        [(d, str(i), page, "art", text, [link, "m"], 1, 0, 2, None) for d in "de" for i in range(2) for page in (1, 2) for text in ("f", None) for link in "lmm"],
        "diary string, id string, page int, type string, fulltext string, permalinks array<string>, para_index int, start int, end int, annotator string",
    )
    for build, rows, names in (
        (lambda r, k: tr.page_date_triples(r, key=k), dates, ("page", F.concat_ws("/", "diary", "page"), F.lit("one"))),
        (lambda r, k: tr.page_date_triples(r, profile="golden", key=k), dates, ("page", F.concat_ws("/", "diary", "page"), F.lit("one"))),
        (lambda r, k: tr.annotation_triples(r, TS, key=k), annotations, ("id", F.concat_ws("/", "diary", "id"))),
    ):
        for key in names:
            key = F.col(key) if isinstance(key, str) else key
            got = [(r.graph_key, *r[2:]) for r in build(rows, key).collect()]
            assert len(got) == len(set(got)) and set(got) == each_row_its_own_graph(build, rows, key)


def test_page_dates_shuffle_rows_not_triples(spark):
    dates = spark.createDataFrame([("d", 7, "1891-08-07", "$$HEADER$$_", "x")], "diary string, page int, object string, predicate string, original_text string")
    dealt_by = shuffle_keys(tr.page_date_triples(dates))
    assert dealt_by and not [x for x in dealt_by if "subject" in x]


def test_days_shuffle_rows_not_triples(spark):
    """One kept number of partitions, by graph: few large ones, or triples in place of rows, would fill a task's memory."""
    days = spark.range(1000).selectExpr("'d' diary", "id day", "'1891-08-07' date", "id page")
    graphs = tr.day_triples(days)
    assert {x.split("#")[0] for x in shuffle_keys(graphs)} == {"graph_key"}
    plan = graphs._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and "ENSURE_REQUIREMENTS" not in plan
    assert graphs.count() == 6000


def shuffle_keys(df):
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", df._jdf.queryExecution().executedPlan().toString())
