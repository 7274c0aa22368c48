"""Column functions over text: markers, footnotes, normalisers, searching, cleaning, rendering."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns and mappings whose results must agree with existing transcriptions.
MARKER = r"\[p?\d+[^\]]*\]"
EXACT_MARKER = r"\[p?0*\d{0,3}\]"
FOOTNOTE = r"(?U)-{4}\w*-{4}"
HEADER_SENTINEL = "$$HEADER$$_"
HREF = r"<a\s+(?:[^>]*?\s+)?href=([\"'])(.*?)\1"
FOOTNOTE_LINK = r"footnote\d+"
DATE = (
    r"(\b\d{1,2}\D{0,3})?\b(?:Jan(?:uary)?|Feb(?:ruary)?|Mar(?:ch)?|Apr(?:il)?|May|Jun(?:e)?|Jul(?:y)?|Aug(?:ust)?|Sep(?:tember)?|Oct(?:ober)?|(Nov|Dec)(?:ember)?)"
    r"\D?(\d{1,2}\D?)?\D?((18[7-9]\d|20\d{2})|\d{2})"
)
DAY_LINES = (
    r"(?m)^(?!\$\$HEADER\$\$_)(.*?\b(?:January|February|March|April|May|June|July|August|September|October|November|December)\s+\d{1,2},\s+\d{4})",
    r"(?m)^(?!\$\$HEADER\$\$_)(.*?\b(?:Jan.|Feb.|Mar.|Apr.|May|June|Jul.|Aug.|Sept.|Oct.|Nov.|Dec.)\s+\d{1,2},\s+\d{4})",
)
DAY_TITLE = r",[0-9]{4}$"
ENTITY_TYPES = {"PERSON": "person", "ORG": "organization", "NORP": "organization", "FAC": "location", "GPE": "location", "LOC": "location", "DATE": "date"}
ALLOWED_ENTITIES = ("PERSON", "ORG", "LOC")
SHEET_TYPES = {"organization / group": "organization", "visual art": "visual_art", "visual arts": "visual_art"}
STYLE_TAGS = {"bold": "b", "italic": "i", "underline": "u"}

_MARK = "\u0001"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _mapped(value: Column, table: dict[str, str], default: Column) -> Column:
    out = None
    for k, v in table.items():
        out = F.when(value == k, v) if out is None else out.when(value == k, v)
    return out.otherwise(default)


def marker_pieces(text: Column | str, marker: str = MARKER) -> Column:
    """The text cut before and after every page marker; empty pieces are left out."""
    marked = F.regexp_replace(_col(text), f"({marker})", f"{_MARK}$1{_MARK}")
    return F.filter(F.split(marked, _MARK, -1), lambda x: x != "")


def is_isolated_marker(piece: Column | str, marker: str = MARKER) -> Column:
    return _col(piece).rlike(rf"\A(?:{marker})\z")


def is_page_marker(text: Column | str, marker: str | None = None, multiline: bool = False) -> Column:
    """Whether a paragraph is a page marker; it must hold a digit. multiline: one line of it suffices."""
    pattern = marker or EXACT_MARKER
    exact = rf"(?m)^(?:{pattern})$" if multiline else rf"\A(?:{pattern})\z"
    return F.coalesce(_col(text).rlike(exact) & page_index(text, marker).isNotNull(), F.lit(False))


def page_index(text: Column | str, marker: str | None = None) -> Column:
    """The first number of the first marker in a text, null if there is none."""
    found = F.regexp_extract(_col(text), f"({marker or EXACT_MARKER})", 1)
    return F.regexp_extract(found, r"\d+", 0).try_cast("int")


def footnote_ids(text: Column | str) -> Column:
    """Footnote markers `----id----` of a text, in order, with their ids stripped out."""
    return F.transform(F.regexp_extract_all(_col(text), F.lit(FOOTNOTE), 0), lambda m: F.replace(m, F.lit("----"), F.lit("")))


def last_tokens(text: Column | str, n: int = 4) -> Column:
    """The last n tokens: runs of word characters, or single signs."""
    tokens = F.regexp_extract_all(_col(text), F.lit(r"(?U)\w+|[^\w\s]"), 0)
    return F.slice(tokens, F.greatest(F.size(tokens) - (n - 1), F.lit(1)), n)


def normalize_entity_type(label: Column | str) -> Column:
    return _mapped(_col(label), ENTITY_TYPES, F.lit(""))


def normalize_sheet_type(value: Column | str) -> Column:
    return _mapped(_col(value), SHEET_TYPES, _col(value))


def is_allowed_entity(label: Column | str) -> Column:
    return F.coalesce(_col(label).isin(*ALLOWED_ENTITIES), F.lit(False))


def find(text: Column | str, value: Column | str, ignore_case: bool = False) -> Column:
    """Offset of the first occurrence in code points, -1 if there is none."""
    a, b = _col(text), _col(value)
    return (F.instr(F.lower(a), F.lower(b)) if ignore_case else F.instr(a, b)) - 1


def not_blank(text: Column | str) -> Column:
    """Whether there is anything but white space (no-break space included)."""
    return F.coalesce(_col(text).rlike(r"(?U)\S"), F.lit(False))


def stripped(text: Column | str) -> Column:
    """Without white space (no-break space included) at both ends."""
    return F.regexp_replace(_col(text), r"(?U)\A\s+|\s+\z", "")


def isolate_numbers(text: Column | str) -> Column:
    """Page notations such as [0012] on lines of their own."""
    return F.regexp_replace(_col(text), r"(\[0+[\d]+\])", "\n$1\n")


def prefix_numbers(text: Column | str) -> Column:
    """[00 and [0 to [p."""
    return F.replace(F.replace(_col(text), F.lit("[00"), F.lit("[p")), F.lit("[0"), F.lit("[p"))


def drop_blank_lines(text: Column | str) -> Column:
    return F.regexp_replace(_col(text), r"(?m)^\s*$\n", "")


def mark_day_lines(text: Column | str) -> Column:
    """The header sentinel before every line that holds a full date."""
    out = _col(text)
    for pattern in DAY_LINES:
        out = F.regexp_replace(out, pattern, HEADER_SENTINEL.replace("$", r"\$") + "$1")
    return out


def square_brackets(text: Column | str) -> Column:
    return F.translate(_col(text), "<>", "[]")


def plain_spaces(text: Column | str) -> Column:
    return F.translate(_col(text), " ", " ")


def clean_transcript(text: Column | str) -> Column:
    """All cleaning steps in their order."""
    return mark_day_lines(drop_blank_lines(prefix_numbers(isolate_numbers(square_brackets(plain_spaces(text))))))


def extract_href(html: Column | str) -> Column:
    """The target of the first link, null if there is none."""
    return F.nullif(F.regexp_extract(_col(html), HREF, 2), F.lit(""))


def extract_date(text: Column | str) -> Column:
    return F.nullif(F.regexp_extract(_col(text), DATE, 0), F.lit(""))


def is_day_title(text: Column | str) -> Column:
    return F.coalesce(_col(text).rlike(DAY_TITLE), F.lit(False))


def matches_dialect(text: Column | str, pattern: Column | str) -> Column:
    """Whether the text matches the pattern of its row."""
    return F.coalesce(F.regexp_like(_col(text), _col(pattern)), F.lit(False))


def last_page_number(cell: Column | str) -> Column:
    """The last number of three digits or more in a cell."""
    return F.element_at(F.regexp_extract_all(_col(cell), F.lit(r"\d{3,}"), 0), -1).try_cast("int")


def _escaped(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def render_html(content: Column | str, escape: bool = False) -> Column:
    """A page of paragraphs with styled runs as HTML; strike and plain runs have no tag."""

    def styled(r: Column) -> Column:
        value = _escaped(r["value"]) if escape else r["value"]
        out = None
        for style, tag in STYLE_TAGS.items():
            shown = F.concat(F.lit(f"<{tag}>"), value, F.lit(f"</{tag}>"))
            out = F.when(r["type"] == style, shown) if out is None else out.when(r["type"] == style, shown)
        return out.otherwise(value)

    body = F.transform(_col(content), lambda p: F.concat(F.lit("\n\t\t<p>"), F.array_join(F.transform(p["runs"], styled), ""), F.lit("</p>")))
    return F.concat(F.lit("<html>\n\t<body>"), F.array_join(body, ""), F.lit("\n\t</body>\n</html>"))


def image_link(page: Column | str, prefix: str) -> Column:
    """Viewer link of a page: prefix, page number, `i`."""
    return F.concat(F.lit(prefix), _col(page).cast("string"), F.lit("i"))


def image_url(image_id: Column | str, prefix: str, suffix: str = "/full/full/0/default.jpg") -> Column:
    return F.concat(F.lit(prefix), _col(image_id).cast("string"), F.lit(suffix))


def iri(template: str, *parts: Column | str) -> Column:
    """A printf-style template filled with columns."""
    return F.format_string(template, *[_col(p).cast("string") for p in parts])
