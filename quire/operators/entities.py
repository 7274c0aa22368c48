"""Entity extraction with a pluggable extractor."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from quire.functions.text import is_allowed_entity, normalize_entity_type
from quire.workers import share_package

#: Takes a text, gives (start, end, label) with offsets in code points.
Extractor = Callable[[str], Iterable[tuple[int, int, str]]]

#: The request that a language model is given, one page's text at a time; parse_responses reads the shape it asks for.
PROMPT = (
    "Find every person, place and work of art that this page mentions. Reply with a JSON array alone, one object for each mention: the key is the name as it is "
    'written, the value says where it stands, as in [{{"Santa Croce": {{"offset": 42, "paragraph": 3}}}}]. Count paragraphs from 1, and offsets in characters from '
    "the beginning of their paragraph, from 0. The page:\n{text}"
)


def capitalised(dictionary: dict[str, str] | None = None, default: str = "PERSON") -> Extractor:
    """The default extractor: sequences of two or more capitalised words, and the dictionary's names with their labels."""
    pattern = re.compile(r"\b[A-ZÀ-Þ][\w’'-]+(?:\s+[A-ZÀ-Þ][\w’'-]+)+")
    names = dictionary or {}
    listed = re.compile("|".join(rf"\b{re.escape(n)}\b" for n in sorted(names, key=len, reverse=True))) if names else None

    def extract(text: str) -> list[tuple[int, int, str]]:
        found = [(m.start(), m.end(), names[m[0]]) for m in listed.finditer(text)] if listed else []
        free = [(m.start(), m.end(), default) for m in pattern.finditer(text) if all(m.end() <= a or b <= m.start() for a, b, _ in found)]
        return sorted(found + free)

    return extract


def extract_entities(pages: DataFrame, extractor: Extractor | None = None) -> DataFrame:
    """Entities of allowed types: diary, id, page, type, fulltext, permalinks, para_index (1-based), start, end, annotator.

    Paragraphs go to the extractor in Arrow batches. id counts from 1 within the diary by page order, paragraph and start.
    """
    share_package(pages.sparkSession)
    extract = extractor or capitalised()
    paragraphs = pages.select("diary", "page", "ord", F.transform("content", lambda p: p["text"]).alias("texts"))
    lines = paragraphs.select("diary", "page", "ord", F.posexplode("texts").alias("pos", "text"), "texts")
    lines = lines.select("diary", "page", "ord", "pos", F.array_position("texts", F.col("text")).cast("int").alias("para_index"), "text")

    def run(batches):
        for batch in batches:
            text = batch.column(5).to_pylist()
            rows = [(i, s, e, label, t[s:e]) for i, t in enumerate(text) if t for s, e, label in extract(t)]
            at = pa.array([r[0] for r in rows], pa.int64())
            kept = [batch.column(i).take(at) for i in range(5)]
            new = [pa.array([r[k] for r in rows], t) for k, t in ((1, pa.int32()), (2, pa.int32()), (3, pa.string()), (4, pa.string()))]
            yield pa.RecordBatch.from_arrays([*kept, *new], names=["diary", "page", "ord", "pos", "para_index", "start", "end", "label", "fulltext"])

    found = lines.mapInArrow(run, "diary string, page int, ord long, pos int, para_index int, start int, end int, label string, fulltext string")
    found = found.where(is_allowed_entity("label"))
    numbered = found.withColumn("id", F.row_number().over(Window.partitionBy("diary").orderBy("ord", "pos", "start")))
    return numbered.select(
        "diary", F.col("id").cast("string").alias("id"), "page", normalize_entity_type("label").alias("type"), "fulltext", F.array().cast("array<string>").alias("permalinks"),
        "para_index", "start", "end", F.lit(None).cast("string").alias("annotator"),
    )


def extraction_prompt(text: Column | str) -> Column:
    """The request for a language model, for responses to be supplied from outside."""
    head, tail = PROMPT.format(text="\0").split("\0")
    return F.concat(F.lit(head), F.col(text) if isinstance(text, str) else text, F.lit(tail))


def parse_responses(responses: DataFrame) -> DataFrame:
    """Supplied responses (diary, page, response) as rows: diary, page, name, start, para_index; broken JSON gives none."""
    parsed = F.from_json("response", "array<map<string,struct<offset:int,paragraph:int>>>")
    items = responses.select("diary", "page", F.explode(parsed).alias("item")).select("diary", "page", F.explode("item").alias("name", "at"))
    return items.select("diary", "page", "name", F.col("at.offset").alias("start"), F.col("at.paragraph").alias("para_index"))
