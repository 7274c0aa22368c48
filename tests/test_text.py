import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quire.functions import text as tx
from quire.functions.dates import date_parser, fuzzy_date, page_metadata


def col(spark, values, fn, schema="v string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {schema}")
    return [r[0] for r in rows.select("i", fn(F.col("v")).alias("x")).orderBy("i").select("x").collect()]


def test_marker_pieces(spark):
    got = col(spark, ["a[1]b[2]c", "a[x]b", "[12 verso]", "", None, "[p3]"], tx.marker_pieces)
    assert got == [["a", "[1]", "b", "[2]", "c"], ["a[x]b"], ["[12 verso]"], [], None, ["[p3]"]]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text("ab[]p12 x", max_size=12), min_size=1, max_size=30))
def test_pieces_join_to_the_text(spark, values):
    assert ["".join(x) for x in col(spark, values, tx.marker_pieces)] == values


def test_page_markers(spark):
    values = ["[0255]", "[p12]", "[1234]", "[0001]", "[]", "[p]", "[12 verso]", "x\n[12]", None]
    assert col(spark, values, tx.is_page_marker) == [True, True, False, True, False, False, False, False, False]
    assert col(spark, values, lambda c: tx.is_page_marker(c, multiline=True))[7]
    assert col(spark, values, tx.page_index)[:4] == [255, 12, None, 1]


def test_footnotes_and_tokens(spark):
    assert col(spark, ["x ----f1---- y ----é2---- z --------"], tx.footnote_ids) == [["f1", "é2", ""]]
    assert col(spark, ["one two, three four.", "a", "", None], tx.last_tokens) == [[",", "three", "four", "."], ["a"], [], None]


def test_types(spark):
    assert col(spark, ["PERSON", "NORP", "GPE", "DATE", "X", None], tx.normalize_entity_type) == ["person", "organization", "location", "date", "", ""]
    assert col(spark, ["visual arts", "organization / group", "book"], tx.normalize_sheet_type) == ["visual_art", "organization", "book"]
    assert col(spark, ["ORG", "GPE", None], tx.is_allowed_entity) == [True, False, False]


def test_blank_and_strip(spark):
    assert col(spark, [" ", " x ", "", None], tx.not_blank) == [False, True, False, False]
    assert col(spark, ["  x "], tx.stripped) == ["x"]


def test_cleaning(spark):
    assert col(spark, ["a[0012]b"], lambda c: tx.prefix_numbers(tx.isolate_numbers(c))) == ["a\n[p12]\nb"]
    assert col(spark, ["a\n  \nb"], tx.drop_blank_lines) == ["a\nb"]
    marked = col(spark, ["x\nFriday, May 5, 1891 y", "$$HEADER$$_May 5, 1891"], tx.mark_day_lines)
    assert marked == ["x\n$$HEADER$$_Friday, May 5, 1891 y", "$$HEADER$$_May 5, 1891"]
    assert col(spark, ["<a>"], tx.square_brackets) == ["[a]"]


def test_links_and_dates(spark):
    assert col(spark, ['<a class="x" href="/y">', "<a href='z'>", "none"], tx.extract_href) == ["/y", "z", None]
    assert col(spark, ["on 7 Aug 1891 in"], tx.extract_date) == ["7 Aug 1891"]
    assert col(spark, ["p. 12, 345 and 1903"], tx.last_page_number) == [1903]


@pytest.mark.parametrize(
    ("text", "want"),
    [("Aug. 12. 91", dt.date(1991, 8, 12)), (". 91 Hotel", dt.date(1991, 5, 26)), ("August 7 1891. Antwerp", dt.date(1891, 8, 7)), ("Sunday May 1. 1892.Albergo", None), ("Monday August 17. 9", None), (None, None)],
)
def test_fuzzy_dates(spark, text, want):
    assert col(spark, [text], lambda c: fuzzy_date(c, dt.date(2025, 5, 26), 1880, 1999)) == [want]


_WORDS = "Mon TUESDAY wed Thu friday Sat sunday Jan february Mar april May JUNE jul August sep Sept. Oct november Dec x Mayor nan inf a pm utc m of 7 91 1891 ٣ ² M\x00ay é \u212a 10:30 + -".split(" ")


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from([*_WORDS, " ", ".", ",", "/"]), max_size=8), st.sampled_from(["", " "]))
def test_lines_without_a_date_word_are_not_parsed(words, between):
    """What is skipped without parsing holds no date for the parser either."""
    from dateutil import parser

    text, start = between.join(words), dt.datetime(2025, 5, 26)
    try:
        want = parser.parse(text, fuzzy=True, default=start).date()
    except (parser.ParserError, OverflowError, ValueError, TypeError):
        want = None
    assert date_parser(start)(text) == want


_PAGES = "diary string, page int, content array<struct<text:string>>"


def test_first_date_of_a_page(spark):
    """The first line in range, wherever it stands; rows of one page count as one; pages without a date or a text have no row."""
    lines = {1: ["none", None, "May 1 2020", "Aug. 12. 91", "Aug. 13. 91"], 2: ["no date"], 3: None, 4: [], 5: ["August 7 1891. Antwerp" + "x" * 60]}
    rows = [("d", page, ts if ts is None else [(t,) for t in ts]) for page, ts in lines.items()] + [("d", 1, [("x",), ("May 2 1892",)])]
    got = page_metadata(spark.createDataFrame(rows, _PAGES), dt.date(2025, 5, 26), "golden").collect()
    cut = "August 7 1891. Antwerp" + "x" * 28 + "..."
    assert sorted((r.page, r.pos, r.object, r.original_text) for r in got) == [(1, 1, "1892-05-02", "May 2 1892..."), (5, 0, "1891-08-07", cut)]


@pytest.mark.parametrize("profile", ["code", "golden"])
def test_dates_are_parsed_once(spark, profile):
    """The filter on the result must not bring a second pass of the parser."""
    pages = spark.createDataFrame([("d", 1, [("May 1 1892",)])], _PAGES)
    plan = page_metadata(pages, dt.date(2025, 5, 26), profile)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_html(spark):
    page = spark.sql("select array(named_struct('runs', array(named_struct('value','A<','type','bold'), named_struct('value','B','type','text'), named_struct('value','S','type','strike')))) c")
    assert page.select(tx.render_html("c")).first()[0] == "<html>\n\t<body>\n\t\t<p><b>A<</b>BS</p>\n\t</body>\n</html>"
    assert "<b>A&lt;</b>" in page.select(tx.render_html("c", escape=True)).first()[0]
