from pyspark.sql import functions as F

from quire.operators import entities as en
from quire.operators import notes as nt

RUNS = "array<struct<value:string,type:string,start_position:int,end_position:int>>"


def page(spark, *texts, diary="d", number=1):
    content = [(t, []) for t in texts]
    return spark.createDataFrame([(diary, number, number, "\n".join(texts), content)], f"diary string, page int, ord long, text string, content array<struct<text:string,runs:{RUNS}>>")


NOTE = "diary string, id int, page int, type string, value string, annotator string, link_id string"


def test_notes_match_first_paragraph(spark):
    notes = spark.createDataFrame([("d", 0, 1, "art", "NIGHT", None, ""), ("d", 1, 1, "art", "absent", "X", ""), ("d", 2, 2, "art", "night", "X", ""), ("d", 3, 1, "book", "night", "X", ""), ("d", 4, 1, "art", "", "Me", "")], NOTE)
    got = {r.id: r for r in nt.match_notes(notes, page(spark, "day", "the night", "night")).collect()}
    assert set(got) == {"0", "4"}
    assert (got["0"].para_index, got["0"].start, got["0"].end, got["0"].annotator) == (2, 4, 9, "admin")
    assert (got["4"].start, got["4"].annotator) == (0, "me")
    assert {r.key for r in nt.rejected_notes(notes, nt.match_notes(notes, page(spark, "the night"))).collect()} == {"1", "2", "3"}


def test_linked_notes(spark):
    notes = spark.createDataFrame([("d", 0, 1, "x", "Night", "A", "Q1"), ("d", 1, 1, "x", "night", "A", None)], NOTE)
    got = {r.id: r for r in nt.match_linked_notes(notes, page(spark, "the Night", "the Night night")).collect()}
    assert got["0"].permalinks == ["https://www.wikidata.org/wiki/Q1"] and got["0"].para_index == 1
    assert got["1"].permalinks == [] and (got["1"].para_index, got["1"].start) == (2, 10)


def test_sheet_notes_fall_back_to_the_descriptor(spark):
    columns = ("diary", "Entity No.", "Diary Page", "Entity Type", "Entity (Value)", "Note 1 Descriptor", *[f"DIsambiguation URL {i}" for i in (1, 2, 3)])
    sheet = [("d", "7", "p. 001", "visual arts", value, note, "u1", "", None) for value, note in (("night", "n"), ("", "n"), (None, "n"), ("", None), ("absent", "n"))]
    got = nt.match_sheet_notes(spark.createDataFrame(sheet, ", ".join(f"`{c}` string" for c in columns)), page(spark, "day", "the night")).collect()
    assert sorted((r.fulltext, r.para_index, r.start, r.end) for r in got) == [("", 1, 0, 0), ("n", 1, 0, 0), ("n", 1, 0, 0), ("night", 2, 4, 9)]


def test_people_filter_keeps_missing_ids(spark):
    people = spark.createDataFrame([("person", None, 100), ("person", "None", 100), ("person", "Q", 72), ("place", "Q", 100), ("person", "Q2", 90)], "Type string, `Wikidata ID` string, `Page #` int")
    assert [(r["Wikidata ID"], r["Page #"]) for r in nt.people_on_pages(people).collect()] == [("Q2", 90), (None, 100)]


def test_footnotes(spark):
    pages = spark.createDataFrame([("d", 1, "one x ----f1---- y ----f2---- z")], "diary string, page int, text string")
    known = spark.createDataFrame([("f2", "note", "t", ["a", "b"])], "footnote_id string, fulltext string, type string, permalinks array<string>")
    got = nt.footnote_references(pages, known).collect()
    assert [(r.footnote_id, r.last_tokens, r.permalinks) for r in got] == [("f2", ["-", "-", "-", "y"], "a, b")]
    assert nt.footnote_references(pages, known, compat_stop=True).count() == 0


def test_cleaned_footnotes(spark):
    notes = spark.createDataFrame([("d", 1, "k", "The (x", "t", "a, b")], "diary string, page int, footnote_id string, before string, type string, permalinks string")
    got = nt.cleaned_footnotes(page(spark, "a", "see the (x----k---- y"), notes).first()
    assert (got.para_index, got.start, got.end, got.fulltext, got.permalinks) == (2, 4, 10, "the (x", ["a", "b"])


def test_numbering_and_columns(spark):
    notes = spark.createDataFrame([("d", 9, 0), ("d", 1, 1), ("d", 1, 2)], "diary string, page int, row_no int")
    assert [(r.row_no, r.id) for r in nt.limit_notes(nt.number_notes(notes), 2).orderBy("id").collect()] == [(1, 0), (2, 1)]
    sheet = spark.createDataFrame([("7", "art", None)], "`Page #` string, Type string, Entry string")
    got = nt.rename_note_columns(sheet, "1891").first()
    assert (got.page, got.type, got.value, got.annotator) == ("7", "art", "", None)


def test_days(spark):
    t = spark.createDataFrame([("d", 1, "x"), ("d", 2, "Friday,1891"), ("d", 3, None), ("d", 4, "May,1892")], "diary string, page int, text string")
    days = nt.running_day(t, ["diary"], ["page"])
    assert [r.day for r in days.orderBy("page").collect()] == [0, 1, 1, 2]
    assert [(r.day, r.image_link) for r in nt.day_table(days, "v/").orderBy("day").collect()] == [(1, "v/2i"), (2, "v/4i")]


def test_entities(spark):
    extract = en.capitalised({"Van Eyck": "ORG", "Bruges": "GPE"})
    got = [(r.id, r.type, r.fulltext, r.para_index, r.start) for r in en.extract_entities(page(spark, "in Bruges saw Van Eyck", "met Mary Smith"), extract).orderBy("id").collect()]
    assert got == [("1", "organization", "Van Eyck", 1, 14), ("2", "person", "Mary Smith", 2, 4)]


def test_responses(spark):
    rows = spark.createDataFrame([("d", 1, '[{"Mona":{"offset":3,"paragraph":1}}]'), ("d", 2, "broken")], "diary string, page int, response string")
    assert [(r.name, r.start, r.para_index) for r in en.parse_responses(rows).collect()] == [("Mona", 3, 1)]
    assert rows.select(en.extraction_prompt(F.lit("T"))).first()[0].endswith("\nT")
