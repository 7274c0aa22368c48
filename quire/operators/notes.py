"""Curated notes, footnotes, people and days, and their joins with pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from quire.functions.text import find, footnote_ids, image_link, is_day_title, last_page_number, last_tokens, normalize_sheet_type
from quire.schemas import NOTE_COLUMNS

WIKIDATA = "https://www.wikidata.org/wiki/"


def people_on_pages(people: DataFrame, first: int = 73, last: int = 176, type_col: str = "Type", id_col: str = "Wikidata ID", page_col: str = "Page #") -> DataFrame:
    """Persons with an id other than 'None' (a missing one counts as other) on a range of pages, by page."""
    keep = (F.col(f"`{type_col}`") == "person") & ~F.col(f"`{id_col}`").eqNullSafe("None") & F.col(f"`{page_col}`").between(first, last)
    return people.where(keep).orderBy(F.col(f"`{page_col}`"))


def rename_note_columns(notes: DataFrame, diary: str) -> DataFrame:
    """Logical column names for a diary's note sheet; nulls become empty strings. Unknown diaries are an error."""
    mapping = NOTE_COLUMNS[diary]
    return notes.select(*[F.coalesce(F.col(f"`{physical}`"), F.lit("")).alias(logical) if physical in notes.columns else F.lit(None).cast("string").alias(logical) for logical, physical in mapping.items()])


def number_notes(notes: DataFrame, row_col: str = "row_no") -> DataFrame:
    """Notes with `id`, their 0-based position by page, then source row, within the diary."""
    return notes.withColumn("id", F.row_number().over(Window.partitionBy("diary").orderBy("page", row_col)) - 1)


def limit_notes(notes: DataFrame, limit: int = -1) -> DataFrame:
    return notes if limit == -1 else notes.where(F.col("id") < limit)


def _match(notes: DataFrame, pages: DataFrame, ignore_case: bool) -> DataFrame:
    """Notes with the first paragraph of their page that contains their value; others are dropped.

    An equi-join on (diary, page); the containment test runs inside the page's array, so nothing is exploded.
    """
    texts = pages.select("diary", "page", F.transform("content", lambda p: p["text"]).alias("texts"))
    joined = notes.join(texts, ["diary", "page"])
    offsets = F.transform("texts", lambda t: find(t, F.col("value"), ignore_case))
    first = F.filter(F.transform(offsets, lambda o, i: F.struct(o.alias("start"), i.alias("i"))), lambda x: x["start"] >= 0)
    joined = joined.withColumn("hit", F.get(first, F.lit(0))).where("hit is not null")
    # a repeated paragraph has the position of the first equal one
    return joined.select(
        *[c for c in notes.columns], F.array_position("texts", F.get("texts", F.col("hit.i"))).cast("int").alias("para_index"),
        F.col("hit.start").cast("int").alias("start"), (F.col("hit.start") + F.length("value")).cast("int").alias("end"),
    )


def _annotation(matched: DataFrame, permalinks: Column, annotator: Column, kind: Column | None = None) -> DataFrame:
    return matched.select(
        "diary", F.col("id").cast("string").alias("id"), "page", (F.col("type") if kind is None else kind).alias("type"), F.col("fulltext"),
        permalinks.alias("permalinks"), "para_index", "start", "end", annotator.alias("annotator"),
    )


def match_notes(notes: DataFrame, pages: DataFrame, only_type: str | None = "art") -> DataFrame:
    """Annotations of notes (diary, id, page, type, value, annotator) found in their page, whatever the case of letters."""
    kept = notes if only_type is None else notes.where(F.col("type") == only_type)
    found = _match(kept.withColumn("fulltext", F.col("value")), pages, ignore_case=True)
    return _annotation(found, F.array().cast("array<string>"), F.lower(F.coalesce("annotator", F.lit("admin"))))


def match_linked_notes(notes: DataFrame, pages: DataFrame) -> DataFrame:
    """As match_notes for all types, letter cases apart, with a permalink built from link_id."""
    found = _match(notes.withColumn("fulltext", F.col("value")), pages, ignore_case=False)
    links = F.when(F.coalesce("link_id", F.lit("")) != "", F.array(F.concat(F.lit(WIKIDATA), F.col("link_id")))).otherwise(F.array().cast("array<string>"))
    return _annotation(found, links, F.lower(F.coalesce("annotator", F.lit("admin"))))


def match_sheet_notes(sheet: DataFrame, pages: DataFrame) -> DataFrame:
    """Annotations of the second sheet layout: page cell, entity or descriptor, three permalinks, normalised types."""
    notes = sheet.select(
        "diary", F.col("`Entity No.`").alias("id"), last_page_number("`Diary Page`").alias("page"), normalize_sheet_type("`Entity Type`").alias("type"),
        F.coalesce(F.col("`Entity (Value)`"), F.lit("")).alias("value"),
        F.coalesce(F.nullif(F.col("`Entity (Value)`"), F.lit("")), F.col("`Note 1 Descriptor`"), F.lit("")).alias("fulltext"),
        F.array(*[F.coalesce(F.col(f"`DIsambiguation URL {i}`"), F.lit("")) for i in (1, 2, 3)]).alias("links"),
    ).where("page is not null")
    return _annotation(_match(notes, pages, ignore_case=False), F.col("links"), F.lit(None).cast("string"))


def rejected_notes(notes: DataFrame, matched: DataFrame) -> DataFrame:
    """Issues for notes that no page or paragraph holds."""
    left = notes.withColumn("id", F.col("id").cast("string")).join(matched.select("diary", "id"), ["diary", "id"], "left_anti")
    return left.select(F.lit("notes").alias("stage"), "diary", F.col("id").alias("key"), F.lit("not found in its page").alias("message"))


def footnote_references(pages: DataFrame, footnotes: DataFrame, compat_stop: bool = False) -> DataFrame:
    """Footnote markers of pages joined with the footnotes: diary, page, pos, footnote_id, last_tokens, text, type, permalinks.

    pages: diary, page, text. footnotes: footnote_id, fulltext, type, permalinks (array or null). last_tokens are the four
    tokens before the marker's first occurrence. compat_stop: nothing after a page's first unknown id.
    """
    marks = pages.select("diary", "page", F.col("text").alias("page_text"), F.posexplode(footnote_ids("text")).alias("pos", "footnote_id"))
    joined = marks.join(footnotes.withColumn("known", F.lit(True)), "footnote_id", "left")
    if compat_stop:
        before = Window.partitionBy("diary", "page").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        joined = joined.withColumn("missed", F.max(F.col("known").isNull()).over(before)).where("not missed")
    joined = joined.where("known")
    mark = F.concat(F.lit("----"), F.col("footnote_id"), F.lit("----"))
    before = F.substr(F.col("page_text"), F.lit(1), F.greatest(F.instr(F.col("page_text"), mark) - 1, F.lit(0)))
    return joined.select(
        "diary", "page", "pos", "footnote_id", last_tokens(before).alias("last_tokens"), F.col("fulltext").alias("text"), "type",
        F.coalesce(F.array_join("permalinks", ", "), F.lit("")).alias("permalinks"),
    )


def cleaned_footnotes(pages: DataFrame, footnotes: DataFrame) -> DataFrame:
    """Cleaned footnotes placed in their paragraph: annotations with 1-based paragraph index.

    footnotes: diary, page, footnote_id, before, type, permalinks (comma-separated). The paragraph is the first that holds the
    footnote's marker, the span is the first match of `before` (a literal text, letter case apart) in it.
    """
    texts = pages.select("diary", "page", F.transform("content", lambda p: p["text"]).alias("texts"))
    joined = footnotes.join(texts, ["diary", "page"])
    mark = F.concat(F.lit("----"), F.col("footnote_id"), F.lit("----"))
    holds = F.filter(F.transform("texts", lambda t, i: F.struct(t.alias("t"), i.alias("i"))), lambda x: F.instr(x["t"], mark) > 0)
    joined = joined.withColumn("para", F.get(holds, F.lit(0))).withColumn("start", find(F.col("para.t"), F.col("before"), ignore_case=True)).where("start >= 0")
    return joined.select(
        "diary", F.col("footnote_id").alias("id"), "page", "type", F.substr("para.t", F.col("start") + 1, F.length("before")).alias("fulltext"),
        F.split("permalinks", ", ").alias("permalinks"), (F.col("para.i") + 1).cast("int").alias("para_index"), F.col("start").cast("int").alias("start"),
        (F.col("start") + F.length("before")).cast("int").alias("end"), F.lit(None).cast("string").alias("annotator"),
    )


def running_day(table: DataFrame, partition: list[str], order: list[str]) -> DataFrame:
    """`day`: how many day titles there are up to each row of its partition."""
    w = Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return table.withColumn("day", F.sum(is_day_title("text").cast("int")).over(w).cast("int"))


def day_table(table: DataFrame, link_prefix: str) -> DataFrame:
    """Day titles: day, day_title, page, image_link."""
    return table.where(is_day_title("text")).select("day", F.col("text").alias("day_title"), "page", image_link("page", link_prefix).alias("image_link"))


def people_table(entities: DataFrame) -> DataFrame:
    """Persons among extracted entities: day, text, description, page, p, start, end."""
    return entities.where(F.col("type") == "PERSON").select("day", "text", "description", "page", "p", "start", "end")
