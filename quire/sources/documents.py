"""Sources: word-processor files, text, manifests, note sheets, credentials."""

from __future__ import annotations

import configparser
import io
import zipfile
import zlib
from pathlib import Path
from urllib.request import urlopen
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions.text import not_blank
from quire.schemas import MANIFEST, NOTES, NOTES_SHEET, PARAGRAPHS, STYLED
from quire.workers import share_package

_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
_OFF = {"0", "false", "off", "none"}
#: What a file that is no archive, damaged, encrypted, of an unknown method or without a readable body raises.
_UNREADABLE = (zipfile.BadZipFile, zlib.error, EOFError, NotImplementedError, RuntimeError, KeyError, ElementTree.ParseError)


def _on(properties: ElementTree.Element | None, tag: str) -> bool:
    node = properties.find(_W + tag) if properties is not None else None
    return node is not None and node.get(f"{_W}val", "1").lower() not in _OFF


def _run_text(run: ElementTree.Element) -> str:
    out = []
    for node in run:
        if node.tag == f"{_W}t":
            out.append(node.text or "")
        elif node.tag == f"{_W}tab":
            out.append("\t")
        elif node.tag in (f"{_W}br", f"{_W}cr"):
            out.append("\n")
        elif node.tag == f"{_W}noBreakHyphen":
            out.append("-")
    return "".join(out)


def _body(content: bytes) -> list[ElementTree.Element]:
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        root = ElementTree.fromstring(z.read("word/document.xml"))
    body = root.find(f"{_W}body")
    return [] if body is None else body.findall(f"{_W}p")


def _parse(content: bytes) -> list[tuple[str, list[dict]]]:
    """Paragraphs of the body: stripped text, and runs that are not blank; a paragraph without such runs is left out.

    A run has the first style that applies of bold, italic, underline, strike; offsets count kept runs only.
    """
    out = []
    for para in _body(content):
        runs, at, text = [], 0, []
        for run in para.findall(f"{_W}r"):
            value = _run_text(run)
            text.append(value)
            if value.strip():
                props = run.find(f"{_W}rPr")
                style = next((name for tag, name in (("b", "bold"), ("i", "italic"), ("u", "underline"), ("strike", "strike")) if _on(props, tag)), "text")
                runs.append({"value": value, "type": style, "start_position": at, "end_position": at + len(value)})
                at += len(value)
        if runs:
            out.append(("".join(text).strip(), runs))
    return out


def _parse_styled(content: bytes) -> list[tuple[str, list[dict]]]:
    """Paragraphs with text: unstripped text, and styled runs with independent flags."""
    out = []
    for para in _body(content):
        texts, styled = [], []
        for run in para.iter(f"{_W}r"):
            value = "".join(t.text or "" for t in run.findall(f"{_W}t"))
            if value:
                texts.append(value)
                props = run.find(f"{_W}rPr")
                flags = {name: _on(props, tag) for tag, name in (("b", "bold"), ("i", "italic"), ("u", "underline"), ("strike", "strikethrough"))}
                if any(flags.values()):
                    styled.append({"text": value, **flags})
        if texts:
            out.append(("".join(texts), styled))
    return out


def _files(spark: SparkSession, path: str, glob: str) -> DataFrame:
    share_package(spark)
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", "content")


def _diary_of(path: str) -> str:
    from urllib.parse import unquote

    return unquote(path.rsplit("/", 1)[-1].rsplit(".", 1)[0])


def _read_docx(spark: SparkSession, path: str, parse, schema: T.StructType) -> DataFrame:
    last = schema.names[-1]

    def run(batches):
        for pdf in batches:
            rows = []
            for name, content in zip(pdf["path"], pdf["content"], strict=True):
                try:
                    found = parse(content)
                except _UNREADABLE:
                    continue  # listed by docx_issues
                rows += [(_diary_of(name), i, text, runs) for i, (text, runs) in enumerate(found)]
            yield pd.DataFrame(rows, columns=["diary", "seq", "text", last])

    return _files(spark, path, "*.docx").mapInPandas(run, schema)


def read_docx(spark: SparkSession, path: str) -> DataFrame:
    """Paragraphs of all .docx files of a folder (or one file): diary (file name), seq, text, runs."""
    return _read_docx(spark, path, _parse, PARAGRAPHS)


def read_docx_styled(spark: SparkSession, path: str) -> DataFrame:
    """As read_docx, with raw text and runs of independent style flags."""
    return _read_docx(spark, path, _parse_styled, STYLED)


def docx_issues(spark: SparkSession, path: str) -> DataFrame:
    """Issues for files that are no readable .docx."""

    def run(batches):
        for pdf in batches:
            rows = []
            for name, content in zip(pdf["path"], pdf["content"], strict=True):
                try:
                    _body(content)
                except _UNREADABLE as error:
                    rows.append(("docx", _diary_of(name), name, str(error)))
            yield pd.DataFrame(rows, columns=["stage", "diary", "key", "message"])

    return _files(spark, path, "*.docx").mapInPandas(run, "stage string, diary string, key string, message string")


def to_text(paragraphs: DataFrame) -> DataFrame:
    """One text per diary, paragraphs joined by line ends."""
    return paragraphs.groupBy("diary").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "text"))), lambda x: x["text"]), "\n").alias("text"))


def to_xml(paragraphs: DataFrame) -> DataFrame:
    """As to_text, each paragraph in <p> tags."""
    return to_text(paragraphs.withColumn("text", F.concat(F.lit("<p>"), "text", F.lit("</p>")))).withColumnRenamed("text", "xml")


def lines_to_paragraphs(texts: DataFrame, key: str = "diary", text: str = "text") -> DataFrame:
    """Lines as paragraphs of one plain run each: diary, seq, text, runs."""
    lines = texts.select(F.col(key).cast("string").alias("diary"), F.posexplode(F.split(F.col(text), "\n", -1)).alias("seq", "text"))
    run = F.struct(F.col("text").alias("value"), F.lit("text").alias("type"), F.lit(0).alias("start_position"), F.length("text").alias("end_position"))
    return lines.withColumn("runs", F.when(not_blank("text"), F.array(run)).otherwise(F.array().cast(PARAGRAPHS["runs"].dataType)))


def read_text_lines(spark: SparkSession, path: str, keep_ends: bool = False) -> DataFrame:
    """Lines of text files with stable numbers: diary, seq, text. keep_ends leaves the line ends on."""
    whole = read_text_files(spark, path).select(F.col("key").alias("diary"), "text")
    pattern = "(?<=\n)" if keep_ends else "\n"
    lines = whole.select("diary", F.posexplode(F.split("text", pattern, -1)).alias("seq", "text"), F.size(F.split("text", pattern, -1)).alias("n"))
    return lines.where("not (seq = n - 1 and text = '')").select("diary", "seq", "text")


def read_text_files(spark: SparkSession, path: str, suffix: str = ".txt") -> DataFrame:
    """Whole text files: key (name without suffix), text."""
    name = F.regexp_extract(F.url_decode(F.input_file_name()), r"([^/]+)$", 1)
    whole = spark.read.option("pathGlobFilter", f"*{suffix}").text(path, wholetext=True)
    return whole.select(F.replace(name, F.lit(suffix), F.lit("")).alias("key"), F.col("value").alias("text"))


def read_manifests(spark: SparkSession, path: str) -> DataFrame:
    """IIIF presentation manifests, one file per diary: diary, sequences."""
    name = F.regexp_extract(F.url_decode(F.input_file_name()), r"([^/]+)\.json$", 1)
    return spark.read.schema(MANIFEST).option("multiLine", True).json(path).select(name.alias("diary"), "sequences")


def read_notes(spark: SparkSession, path: str, sheet: bool = False) -> DataFrame:
    """A note sheet as CSV with a header, all columns strings; `sheet` is the second layout."""
    return spark.read.schema(NOTES_SHEET if sheet else NOTES).option("header", True).option("multiLine", True).option("escape", '"').csv(path)


def read_people(spark: SparkSession, path: str) -> DataFrame:
    """A tab-separated people table with a header, its page column as a number."""
    table = spark.read.option("header", True).option("sep", "\t").csv(path)
    return table.withColumn("Page #", F.col("`Page #`").try_cast("int"))


def read_locations(spark: SparkSession, path: str, diary: str) -> DataFrame:
    """A location sheet: diary, row_no, page, wkt, name, link_id."""
    table = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return table.select(
        F.lit(diary).alias("diary"), F.monotonically_increasing_id().alias("row_no"), F.col("`Page #`").try_cast("int").alias("page"), F.col("WKT").alias("wkt"),
        F.col("Entry").alias("name"), F.col("`Wikidata ID`").alias("link_id"),
    )


def read_credentials(path: str, section: str) -> dict[str, str]:
    """Username, password and endpoint of a section of an ini file; for sink options only."""
    config = configparser.ConfigParser(interpolation=None)
    if not config.read(path):
        raise FileNotFoundError(path)
    return {k: config.get(section, k) for k in ("username", "password", "endpoint")}


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in the file system that Spark reads it from."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def download(address: str, target: str, timeout: float = 60) -> None:
    """Save what an address answers as a local file, whole or not at all; an answer other than success is an error."""
    with urlopen(address, timeout=timeout) as answer:
        body = answer.read()
    beside = Path(f"{target}.part")
    beside.parent.mkdir(parents=True, exist_ok=True)
    beside.write_bytes(body)
    beside.replace(target)
