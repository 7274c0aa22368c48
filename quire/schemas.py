"""Schemas of the engine's relations."""

from __future__ import annotations

from pyspark.sql import types as T


_BASIC = {"string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "boolean": T.BooleanType()}


def _struct(**fields: str | T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, _BASIC[t] if isinstance(t, str) else t) for n, t in fields.items()])


def _strings(*names: str) -> T.StructType:
    return _struct(**dict.fromkeys(names, "string"))


RUNS = T.ArrayType(_struct(value="string", type="string", start_position="int", end_position="int"))
PARAGRAPHS = _struct(diary="string", seq="int", text="string", runs=RUNS)
STYLED = _struct(
    diary="string", seq="int", text="string", styled_runs=T.ArrayType(_struct(text="string", bold="boolean", italic="boolean", underline="boolean", strikethrough="boolean"))
)
PAGES = _struct(diary="string", page="int", ord="bigint", text="string", content=T.ArrayType(_struct(text="string", runs=RUNS)))
_RESOURCE = _struct(resource=_strings("@id"))
MANIFEST = _struct(sequences=T.ArrayType(_struct(canvases=T.ArrayType(_struct(images=T.ArrayType(_RESOURCE))))))
NOTES = _strings("Page #", "Type", "Entry", "Paragraph #", "Start", "End", "Annotator", "Wikidata ID", "WKT")
NOTES_SHEET = _strings(
    "Diary Page", "Entity (Value)", "Authority Name", "Entity No.", "Entity Type", "Note 1 Descriptor", "Note 2 Context", "DIsambiguation URL 1", "DIsambiguation URL 2", "DIsambiguation URL 3"
)
ANNOTATIONS = _struct(
    diary="string", id="string", page="int", type="string", fulltext="string", permalinks=T.ArrayType(T.StringType()), para_index="int", start="int", end="int", annotator="string"
)
TRIPLES = _strings("graph_kind", "graph_key", "subject", "predicate", "object", "object_kind", "datatype")
ISSUES = _strings("stage", "diary", "key", "message")

# The columns of a curated note sheet, logical name to header, by diary.
NOTE_COLUMNS = {
    "1891": {
        "page": "Page #", "type": "Type", "value": "Entry", "paragraph": "Paragraph #", "start": "Start", "end": "End", "annotator": "Annotator",
        "permalinks": "Wikidata ID", "location_wkt": "WKT", "location_name": "Entry", "location_link": "Wikidata ID",
    },
}

# The header of the footnote table.
FOOTNOTE_HEADER = ["Page number", "footnote id", "Last 4 words before footnote", "Footnote text", "Type", "Permalinks"]

# Per diary the image id, the page-marker dialect and the title.
DIARY_CONFIG = [
    ("1891", 420756309, r"\[\s*\d+\s*[\s\w,’‘]{3,}\]", "Diary 1, August 1891 - November 1893"),
    ("1915", 491567726, r"\[[0-9]+\][\s]*", None),
    ("1927", 491567726, r"^[\s]*\[[0-9]+\][\s]*$", None),
    ("1933", 493343490, r"^[\s]*\[[0-9]+\][\s]*", None),
    ("1903", 493312270, r"\[\s*\d+\s*\]", None),
    ("1894-95", 420765526, r"\[\s*\d+\s*\]", None),
    ("1895", 493295736, r"\[\s*\d+\s*[\s\w,’‘.]*\]", None),
    ("1897", 420766084, r"\[\s*\d+\s*[\s\w,’‘.]*\]", None),
]
