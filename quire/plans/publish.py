"""The publication of diaries: from word-processor files to pages, HTML and triples."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.text import MARKER
from quire.functions.dates import page_metadata
from quire.operators.entities import Extractor, extract_entities
from quire.operators.notes import footnote_references, match_notes, rejected_notes
from quire.operators.pages import canvases, front_images, join_images, join_locations, limit_pages, page_issues, sectionize, split_markers, unusable_markers
from quire.operators.triples import Space, annotation_triples, day_triples, diary_triples, page_date_triples, page_triples, union_graphs
from quire.sinks import files
from quire.sources.documents import docx_issues, read_docx, read_manifests


@dataclass(frozen=True)
class Options:
    """marker: what isolates a marker; page_marker: what makes a page (default: the exact one); titles etc. by diary.

    default_date: the date that lenient parsing fills gaps from; without one, pages get no dates. entities: annotate
    extracted entities where there are no notes; only_type: the type of notes that become annotations (None: all).
    """

    run_ts: str = "1970-01-01T00:00:00"
    space: Space = field(default_factory=Space)
    marker: str = MARKER
    page_marker: str | None = None
    limit: int = -1
    title: str | None = None
    index: int | None = None
    iiif_manifest: str | None = None
    compat: bool = False
    escape_html: bool = False
    default_date: dt.date | None = None
    date_profile: str = "code"
    entities: bool = False
    extractor: Extractor | None = None
    only_type: str | None = "art"


def build_pages(paragraphs: DataFrame, options: Options = Options()) -> DataFrame:
    """Pages of styled paragraphs."""
    parts = split_markers(paragraphs, options.marker, options.compat)
    return limit_pages(sectionize(parts, options.page_marker, options.compat), options.limit)


def build_annotations(pages: DataFrame, notes: DataFrame | None, options: Options = Options()) -> DataFrame:
    """Annotations of curated notes (diary, id, page, type, value, annotator) if there are any, else of extracted entities."""
    return extract_entities(pages, options.extractor) if notes is None else match_notes(notes, pages, options.only_type)


def build_triples(pages: DataFrame, images: DataFrame, options: Options = Options(), annotations: DataFrame | None = None, days: DataFrame | None = None) -> DataFrame:
    """Graphs of diaries, of pages whose image is known with their dates, and of annotations and days (diary, day, date, page).

    All are keyed <diary>/<name>, as page, annotation and day numbers repeat between diaries.
    """
    fronts = front_images(images).select(
        "diary", "image", F.lit(options.title).cast("string").alias("title"), F.lit(options.index).cast("int").alias("idx"), F.lit(options.iiif_manifest).cast("string").alias("iiif_manifest")
    )
    fronts = fronts.join(pages.select("diary").distinct(), "diary", "left_semi")
    illustrated = join_images(pages, images)
    whole = diary_triples(fronts, options.space, F.concat_ws("/", "diary", "diary"))
    by_page = F.concat_ws("/", "diary", "page")
    graphs = [whole, page_triples(illustrated.where("image is not null"), options.run_ts, options.space, by_page)]
    if options.default_date:
        graphs.append(page_date_triples(page_metadata(pages, options.default_date, options.date_profile), options.space, options.date_profile, by_page))
    if annotations is not None:
        graphs.append(annotation_triples(annotations, options.run_ts, options.space, key=F.concat_ws("/", "diary", "id")))
    if days is not None:
        graphs.append(day_triples(days, options.space, F.concat_ws("/", "diary", "day")))
    return union_graphs(*graphs)


def publish(
    spark: SparkSession, docx: str, manifests: str, out: str, options: Options = Options(), notes: DataFrame | None = None, footnotes: DataFrame | None = None,
    locations: DataFrame | None = None, days: DataFrame | None = None, send: Callable[[str, str, str | None], None] | None = None,
) -> DataFrame:
    """Read, build and write everything under `out`; returns the issues (stage, diary, key, message).

    Tables that are given take part: notes (or, with options.entities, extracted entities) as annotation graphs, footnotes as a
    table, locations in the page graphs, days as graphs. With `send`, all graphs are also sent to a store (see files.upload).
    Pages feed five sinks and are kept for them once (spilling to disk where memory ends).
    """
    paragraphs = read_docx(spark, docx)
    images = canvases(read_manifests(spark, manifests))
    pages = build_pages(paragraphs, options)
    pages = (join_locations(pages, locations) if locations is not None else pages).persist()
    files.write_json(split_markers(paragraphs, options.marker, options.compat), f"{out}/vectors")
    files.write_json(pages, f"{out}/pages")
    files.write_page_texts(pages, out)
    files.write_page_html(pages, out, options.escape_html)
    annotations = build_annotations(pages, notes, options) if notes is not None or options.entities else None
    triples = build_triples(pages, images, options, annotations, days)
    files.write_ntriples(triples, f"{out}/triples")
    files.write_turtle(triples, out, options.space)
    if footnotes is not None:
        files.write_footnotes(footnote_references(pages, footnotes), f"{out}/footnotes")
    if send is not None:
        for row in pages.select("diary").distinct().collect():  # the diaries of one publication
            files.upload(triples.where(F.substring_index("graph_key", "/", 1) == row.diary).withColumn("graph_key", F.regexp_extract("graph_key", "([^/]*)$", 1)), row.diary, send, options.space)
    lost = join_images(pages, images).where("image is null").select(F.lit("images").alias("stage"), "diary", F.col("page").cast("string").alias("key"), F.lit("no canvas").alias("message"))
    issues = docx_issues(spark, docx).unionByName(page_issues(pages)).unionByName(lost).unionByName(unusable_markers(split_markers(paragraphs, options.marker)))
    if notes is not None:
        used = notes if options.only_type is None else notes.where(F.col("type") == options.only_type)
        issues = issues.unionByName(rejected_notes(used, annotations).select("stage", "diary", "key", "message"))
    files.write_csv(issues, f"{out}/issues", ["stage", "diary", "key", "message"])
    pages.unpersist()
    return spark.read.option("header", True).csv(f"{out}/issues")
