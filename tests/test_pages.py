from pyspark.sql import functions as F

from quire.operators import pages as pg
from quire.schemas import PARAGRAPHS


def paragraphs(spark, *texts, diary="d", style="text"):
    rows = [(diary, i, t, [{"value": t, "type": style, "start_position": 0, "end_position": len(t)}]) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, PARAGRAPHS)


def built(spark, *texts, **kw):
    pages = pg.sectionize(pg.split_markers(paragraphs(spark, *texts)), **kw)
    return [(r.page, r.text) for r in pages.orderBy("ord").collect()]


def test_split_fixed_and_compat(spark):
    rows = paragraphs(spark, "a[1]b[2]c")
    texts = lambda df: [r.text for r in df.orderBy("seq", "sub").collect()]
    assert texts(pg.split_markers(rows)) == ["a", "[1]", "b", "[2]", "c"]
    assert texts(pg.split_markers(rows, compat_dup=True)) == ["a", "[1]", "b a[1]b", "[2]", "c"]


def test_runs_keep_styles_and_get_offsets(spark):
    runs = [{"value": "A", "type": "bold", "start_position": 0, "end_position": 1}, {"value": "B[1]C", "type": "text", "start_position": 1, "end_position": 6}]
    out = pg.split_markers(spark.createDataFrame([("d", 0, "AB[1]C", runs)], PARAGRAPHS)).orderBy("sub").collect()
    assert [r.text for r in out] == ["A B", "[1]", "C"]
    assert [(r.value, r.type, r.start_position, r.end_position) for r in out[0].runs] == [("A", "bold", 0, 1), ("B", "text", 2, 3)]


def test_sections(spark):
    assert built(spark, "pre", "[1]", "a", "b", "[2]", "[1]", "z") == [(2, ""), (1, "a\nb")]
    assert built(spark, "no marker") == []
    assert built(spark, "[12 verso]") == []
    assert built(spark, "[1]", "[]", "x") == [(1, "[]\nx")]


def test_many_diaries_do_not_mix(spark):
    rows = paragraphs(spark, "[1]", "x", diary="a").unionByName(paragraphs(spark, "[1]", "y", diary="b"))
    got = {(r.diary, r.text) for r in pg.sectionize(pg.split_markers(rows)).collect()}
    assert got == {("a", "x"), ("b", "y")}


def test_custom_marker(spark):
    assert built(spark, "<7>", "x", "[1]", "y", marker=r"<\d+>") == [(7, "x\n[1]\ny")]


def test_limit_gaps_and_issues(spark):
    pages = pg.sectionize(pg.split_markers(paragraphs(spark, "[0]", "x", "[3]", "y")))
    assert [r.page for r in pg.limit_pages(pages, 1).collect()] == [0]
    assert sorted(r.page for r in pg.missing_pages(pages).collect()) == [1, 2]
    assert {r.message for r in pg.page_issues(pages).collect()} == {"MISSING"}
    assert pg.missing_pages(pages.where("false")).count() == 0
    assert pg.unusable_markers(paragraphs(spark, "[]", "[p]", "[1]")).count() == 2


def test_images_and_locations(spark):
    pages = spark.createDataFrame([("d", 0), ("d", 1), ("d", 2), ("d", 9)], "diary string, page int")
    images = spark.createDataFrame([("d", 0, "i0"), ("d", 1, "i1")], "diary string, canvas_pos int, image string")
    assert {(r.page, r.image) for r in pg.join_images(pages, images).collect()} == {(0, "i0"), (1, "i0"), (2, "i1"), (9, None)}
    spots = spark.createDataFrame([("d", 1, 1, "P1", "n1", "Q1"), ("d", 2, 1, "P2", "n2", "Q2"), ("d", 3, 1, None, "n3", "Q3")], "diary string, row_no int, page int, wkt string, name string, link_id string")
    got = pg.join_locations(pages, spots).where("page = 1").first()
    assert (got.location_wkt, got.location_link) == ("P2", "https://www.wikidata.org/wiki/Q2")


def test_one_shuffle_by_diary(spark):
    plan = pg.split_markers(paragraphs(spark, "[1]"))._jdf.queryExecution().toString()
    assert "Exchange" not in plan
    assert F is not None
