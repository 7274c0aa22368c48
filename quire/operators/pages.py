"""From styled paragraphs to pages: marker splitting, sectionising, gaps, limits, images."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from quire.functions.text import MARKER, is_isolated_marker, is_page_marker, marker_pieces, page_index


def split_markers(paragraphs: DataFrame, marker: str = MARKER, compat_dup: bool = False) -> DataFrame:
    """Put every page marker into a paragraph of its own: diary, seq, sub, text, runs.

    Markers are looked for in each run; `sub` numbers the parts of a paragraph. Run styles are copied, offsets are those in
    the new text (runs joined by blanks). One pass of array functions per row: no shuffle. compat_dup repeats, before the
    second and later markers of a run, all of the run's text that stands before them. Paragraphs without runs vanish.
    """

    def pieces(run: Column) -> Column:
        parts = marker_pieces(run["value"], marker)

        def styled(value: Column) -> Column:
            return F.struct(value.alias("value"), run["type"].alias("type"), is_isolated_marker(value, marker).alias("marker"))

        if not compat_dup:
            return F.transform(parts, styled)

        def again(value: Column, i: Column) -> Column:
            before = F.slice(parts, 1, i)
            repeated = F.struct(F.array_join(before, "").alias("value"), run["type"].alias("type"), F.lit(False).alias("marker"))
            twice = is_isolated_marker(value, marker) & F.exists(before, lambda x: is_isolated_marker(x, marker))
            return F.when(twice, F.array(repeated, styled(value))).otherwise(F.array(styled(value)))

        return F.flatten(F.transform(parts, again))

    flat = F.flatten(F.transform("runs", pieces))
    kind = "array<struct<marker:boolean,runs:array<struct<value:string,type:string,marker:boolean>>>>"

    def fold(done: Column, piece: Column) -> Column:
        last = F.element_at(done, -1)
        fresh = (F.size(done) == 0) | piece["marker"] | F.try_element_at(done, F.lit(-1))["marker"]
        single = F.array(F.struct(piece["marker"].alias("marker"), F.array(piece).alias("runs")))
        grown = F.array(F.struct(last["marker"].alias("marker"), F.array_append(last["runs"], piece).alias("runs")))
        return F.when(fresh, F.concat(done, single)).otherwise(F.concat(F.slice(done, 1, F.size(done) - 1), grown))

    groups = F.aggregate(flat, F.array().cast(kind), fold)
    out = paragraphs.select("diary", "seq", F.posexplode(groups).alias("sub", "part"))
    return out.select("diary", "seq", "sub", joined_text("part.runs").alias("text"), with_offsets("part.runs").alias("runs"))


def joined_text(runs: Column | str) -> Column:
    """Run values joined by blanks."""
    return F.array_join(F.transform(runs, lambda r: r["value"]), " ")


def with_offsets(runs: Column | str) -> Column:
    """Runs with start and end positions in their joined text."""
    runs = F.col(runs) if isinstance(runs, str) else runs

    def place(r: Column, i: Column) -> Column:
        start = F.aggregate(F.slice(runs, 1, i), F.lit(0), lambda n, x: n + F.length(x["value"]) + 1)
        return F.struct(r["value"].alias("value"), r["type"].alias("type"), start.alias("start_position"), (start + F.length(r["value"])).alias("end_position"))

    return F.transform(runs, place)


def sectionize(paragraphs: DataFrame, marker: str | None = None, multiline: bool = False, order: tuple[str, ...] = ("seq", "sub")) -> DataFrame:
    """Pages: diary, page, ord, text, content (paragraphs in order).

    A marker owns all paragraphs up to the next one; text before the first marker is dropped, as are markers and empty
    paragraphs. A page number that occurs twice keeps the content of its first marker and the place of its last. The only
    shuffle is by diary; the window sorts within it, so any number of diaries run in parallel and a large one spills.
    """
    rows = paragraphs.where("text is not null and text <> ''").withColumn("at", F.struct(*order)).withColumn("mark", is_page_marker("text", marker, multiline))
    up_to_here = Window.partitionBy("diary").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("owner", F.last(F.when(F.col("mark"), F.struct("at", page_index("text", marker).alias("page"))), ignorenulls=True).over(up_to_here))
    rows = rows.withColumn("number", F.sum(F.col("mark").cast("long")).over(up_to_here)).where("owner is not null")
    paragraph = F.when(~F.col("mark"), F.struct("at", F.struct("text", "runs").alias("paragraph")))
    pages = rows.groupBy("diary", "number", F.col("owner.page").alias("page")).agg(F.array_sort(F.collect_list(paragraph)).alias("items"))
    once = pages.groupBy("diary", "page").agg(F.min_by("items", "number").alias("items"), F.max("number").alias("ord"))
    content = F.transform("items", lambda x: x["paragraph"])
    return once.select("diary", "page", "ord", F.array_join(F.transform(content, lambda p: p["text"]), "\n").alias("text"), content.alias("content"))


def limit_pages(pages: DataFrame, limit: int = -1) -> DataFrame:
    """The first `limit` pages of each diary in their order; -1 is all."""
    if limit == -1:
        return pages
    return pages.withColumn("at", F.row_number().over(Window.partitionBy("diary").orderBy("ord"))).where(F.col("at") <= limit).drop("at")


def missing_pages(pages: DataFrame) -> DataFrame:
    """Page numbers below each diary's largest one that it does not have: diary, page."""
    seen = pages.groupBy("diary").agg(F.max("page").alias("top"), F.collect_set("page").alias("seen"))
    gaps = F.when(F.col("top") > 0, F.array_except(F.sequence(F.lit(0), F.col("top") - 1), "seen"))
    return seen.select("diary", F.explode(gaps).alias("page"))


def unusable_markers(paragraphs: DataFrame) -> DataFrame:
    """Issues for markers without a number, which stay content: stage, diary, key, message."""
    bad = paragraphs.where(F.col("text").rlike(r"\A\[p?\]\z"))
    return bad.select(F.lit("markers").alias("stage"), "diary", F.col("seq").cast("string").alias("key"), F.concat(F.lit("marker without a number: "), "text").alias("message"))


def page_issues(pages: DataFrame) -> DataFrame:
    """Issues for missing pages."""
    return missing_pages(pages).select(F.lit("pages").alias("stage"), "diary", F.col("page").cast("string").alias("key"), F.lit("MISSING").alias("message"))


def canvases(manifests: DataFrame) -> DataFrame:
    """Images of each manifest in order: diary, canvas_pos, image."""
    listed = manifests.select("diary", F.posexplode(F.col("sequences")[0]["canvases"]).alias("canvas_pos", "canvas"))
    return listed.select("diary", "canvas_pos", F.get(F.col("canvas.images"), F.lit(0))["resource"]["@id"].alias("image"))


def join_images(pages: DataFrame, images: DataFrame) -> DataFrame:
    """Pages with `image`: page n has the n-th canvas, pages 0 and 1 both the first; null beyond the last."""
    keyed = pages.withColumn("canvas_pos", F.greatest(F.col("page") - 1, F.lit(0)))
    return keyed.join(images, ["diary", "canvas_pos"], "left").drop("canvas_pos")


def front_images(images: DataFrame) -> DataFrame:
    return images.where("canvas_pos = 0").select("diary", "image")


def join_locations(pages: DataFrame, locations: DataFrame, link_prefix: str = "https://www.wikidata.org/wiki/") -> DataFrame:
    """Pages with location_wkt, location_name, location_link; of several rows for a page the last (by row_no) counts.

    locations: diary, row_no, page, wkt, name, link_id. Rows without WKT are skipped.
    """
    last = locations.where("wkt is not null").groupBy("diary", "page").agg(F.max_by(F.struct("wkt", "name", "link_id"), "row_no").alias("at"))
    last = last.select(
        "diary", "page", F.col("at.wkt").alias("location_wkt"), F.col("at.name").alias("location_name"), F.concat(F.lit(link_prefix), F.col("at.link_id")).alias("location_link")
    )
    return pages.join(last, ["diary", "page"], "left")
