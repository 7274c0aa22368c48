"""Command line: publish diaries."""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators.notes import number_notes, rename_note_columns
from quire.operators.triples import Space
from quire.plans.publish import Options, publish
from quire.sinks.files import http_store
from quire.sources.documents import download, read_credentials, read_locations, read_notes


def _notes(spark: SparkSession, path: str, diary: str) -> DataFrame:
    """The numbered notes of a sheet in the first layout, for one diary."""
    rows = rename_note_columns(read_notes(spark, path), "1891").withColumn("page", F.col("page").try_cast("int"))
    rows = number_notes(rows.withColumn("diary", F.lit(diary)).withColumn("row_no", F.monotonically_increasing_id()))
    return rows.select("diary", "id", "page", "type", "value", "annotator")


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="quire", description="Turn transcribed diaries into pages, HTML and triples.")
    p.add_argument("-d", "--diary", action="append", required=True, help="diary to publish; may be repeated")
    p.add_argument("--input", required=True, help="folder with <diary>/<diary>.docx and <diary>/<diary>.json")
    p.add_argument("--output", required=True)
    p.add_argument("--base", default=Space().base, help="base address of the graphs, ending in a slash")
    p.add_argument("-t", "--title")
    p.add_argument("-i", "--index", type=int)
    p.add_argument("--iiif", dest="iiif_manifest", help="address of the IIIF manifest")
    p.add_argument("-r", "--regex", help="pattern of page markers")
    p.add_argument("--limit", type=int, default=-1, help="first pages only")
    p.add_argument("--compat", action="store_true", help="repeat text before second markers, as older runs did")
    p.add_argument("--notes", help="CSV of curated notes in the first layout, annotated in the pages that hold them")
    p.add_argument("--locations", help="CSV of the locations of pages")
    p.add_argument("--default-date", type=dt.date.fromisoformat, help="date that incomplete dates in the pages are filled from; without it pages get no dates")
    p.add_argument("--entities", action="store_true", help="annotate extracted entities where there are no notes")
    p.add_argument("--fetch", metavar="ADDRESS", help="download each document from here first; {diary} stands for its name")
    p.add_argument("-u", "--upload", action="store_true", help="replace the graphs in the store of the credentials")
    p.add_argument("-c", "--credentials", default="store", help="section of the credentials file")
    p.add_argument("--credentials-file", default="credentials.ini", help="ini file with username, password and endpoint")
    a = p.parse_args(argv)
    send = http_store(**read_credentials(a.credentials_file, a.credentials)) if a.upload else None
    spark = SparkSession.builder.appName("quire").getOrCreate()
    now = dt.datetime.now().replace(microsecond=0).isoformat()
    options = Options(now, Space(a.base), page_marker=a.regex, limit=a.limit, title=a.title, index=a.index, iiif_manifest=a.iiif_manifest, compat=a.compat, default_date=a.default_date, entities=a.entities)
    for diary in a.diary:
        if a.fetch:
            download(a.fetch.format(diary=diary), f"{a.input}/{diary}/{diary}.docx")
        notes = _notes(spark, a.notes, diary) if a.notes else None
        places = read_locations(spark, a.locations, diary) if a.locations else None
        publish(spark, f"{a.input}/{diary}/{diary}.docx", f"{a.input}/{diary}/{diary}.json", a.output, options, notes, locations=places, send=send).show(truncate=False)


if __name__ == "__main__":
    main()
