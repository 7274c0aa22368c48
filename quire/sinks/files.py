"""Sinks: one file per page or graph, tables, N-Triples, and the graph store behind an interface."""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator
from pathlib import Path
from urllib.error import HTTPError
from urllib.parse import quote, unquote, urlparse
from urllib.request import Request, urlopen

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.text import render_html
from quire.operators.triples import Space, graph_uri
from quire.schemas import FOOTNOTE_HEADER
from quire.workers import share_package


def write_named_texts(rows: DataFrame, root: str) -> None:
    """Write each row (name, body) as the UTF-8 file root/name, from the tasks that hold the rows.

    `root` is a folder that all executors mount, as a path or file: address; any other address is an error. A file appears whole or not at all (written beside, then moved), so that
    repeated tasks do no harm; existing files are replaced.
    """
    share_package(rows.sparkSession)
    if re.match(r"(?!file:)[A-Za-z][A-Za-z0-9+.-]*:", root):
        raise ValueError(f"files can be written to a mounted folder only, not to {root}")
    base = unquote(urlparse(root).path) if root.startswith("file:") else root

    def write(part: Iterator) -> None:
        for row in part:
            target = Path(base, row["name"])
            if not target.resolve().is_relative_to(Path(base).resolve()):
                raise ValueError(f"name leaves the folder: {row['name']}")
            target.parent.mkdir(parents=True, exist_ok=True)
            beside = target.with_name(f".{target.name}.{id(row)}.part")
            beside.write_text(row["body"] or "", encoding="utf-8", newline="")
            beside.replace(target)

    rows.select("name", "body").foreachPartition(write)


def _file(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def write_page_texts(pages: DataFrame, root: str) -> None:
    """txt/<page>.txt under each diary's folder; an empty page gives an empty file."""
    write_named_texts(pages.where("text is not null").select(_file(F.col("diary"), "/txt/", F.col("page"), ".txt").alias("name"), F.col("text").alias("body")), root)


def write_page_html(pages: DataFrame, root: str, escape: bool = False, second_root: str | None = None) -> None:
    """html/<diary>_<page>.html under each diary's folder, and file/<diary>_<page>.html under the second root if given."""
    body = render_html("content", escape).alias("body")
    name = (F.col("diary"), "_", F.col("page"), ".html")
    write_named_texts(pages.select(_file(F.col("diary"), "/html/", *name).alias("name"), body), root)
    if second_root:
        write_named_texts(pages.select(_file("file/", *name).alias("name"), body), second_root)


def write_json(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)


def write_csv(rows: DataFrame, path: str, columns: list[str], sep: str = ",") -> None:
    """The named columns with a header."""
    rows.select(*[F.col(f"`{c}`") for c in columns]).write.mode("overwrite").option("header", True).option("sep", sep).option("escape", '"').csv(path)


def write_xlsx(rows: DataFrame, path: str, columns: list[str]) -> None:
    """One spreadsheet file, built on the driver: for small tables, and only where a spreadsheet engine is installed."""
    rows.select(*columns).toPandas().to_excel(path, index=False)


def write_footnotes(references: DataFrame, path: str) -> None:
    """The footnote table with its row index (by diary, page and position) as CSV."""
    from pyspark.sql import Window

    index = F.row_number().over(Window.partitionBy("diary").orderBy("page", "pos")) - 1
    values = [F.col("page"), F.col("footnote_id"), F.concat(F.lit("["), F.array_join("last_tokens", ", "), F.lit("]")), F.col("text"), F.col("type"), F.col("permalinks")]
    table = references.select("diary", index.alias("index"), *[v.alias(h) for v, h in zip(values, FOOTNOTE_HEADER, strict=True)])
    table.write.mode("overwrite").partitionBy("diary").option("header", True).option("escape", '"').csv(path)


def _escaped(text: Column) -> Column:
    for a, b in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def ntriples(triples: DataFrame) -> DataFrame:
    """One N-Triples line per row: graph_kind, graph_key, value."""
    literal = F.concat(F.lit('"'), _escaped(F.col("object")), F.lit('"'), F.coalesce(F.concat(F.lit("^^<"), F.col("datatype"), F.lit(">")), F.lit("")))
    node = F.when(F.col("object_kind") == "iri", F.concat(F.lit("<"), F.col("object"), F.lit(">"))).otherwise(literal)
    return triples.select("graph_kind", "graph_key", F.concat(F.lit("<"), "subject", F.lit("> <"), "predicate", F.lit("> "), node, F.lit(" .")).alias("value"))


def write_ntriples(triples: DataFrame, path: str) -> None:
    """N-Triples text files, one folder per graph kind."""
    ntriples(triples).select("graph_kind", "value").write.mode("overwrite").partitionBy("graph_kind").text(path)


def turtle(triples: DataFrame, space: Space = Space()) -> DataFrame:
    """One Turtle document per graph: graph_kind, graph_key, body. A graph (a page, an annotation) is small."""
    share_package(triples.sparkSession)
    prefixes = space.prefixes()

    def name(iri: str) -> str:
        for p, base in prefixes.items():
            rest = iri[len(base) :] if iri.startswith(base) else ""
            if rest and all(c.isalnum() or c in "_-" for c in rest):
                return f"{p}:{rest}"
        return f"<{quote(iri, safe=':/?#[]@!$&()*+,;=%~-._' + chr(39))}>"

    def term(row) -> str:
        if row.object_kind == "iri":
            return name(row.object)
        text = row.object.replace("\\", "\\\\").replace('"', '\\"').replace("\n", "\\n").replace("\r", "\\r").replace("\t", "\\t")
        return f'"{text}"' + (f"^^{name(row.datatype)}" if isinstance(row.datatype, str) else "")

    def serialise(pdf: pd.DataFrame) -> pd.DataFrame:
        lines = [f"@prefix {p}: <{b}> ." for p, b in sorted(prefixes.items())]
        for subject, group in pdf.sort_values(["subject", "predicate", "object"]).groupby("subject", sort=True):
            parts = [f"{name(p)} " + ", ".join(term(r) for r in g.itertuples()) for p, g in group.groupby("predicate", sort=True)]
            lines += ["", f"{name(subject)} " + " ;\n    ".join(parts) + " ."]
        return pd.DataFrame({"graph_kind": [pdf["graph_kind"].iloc[0]], "graph_key": [pdf["graph_key"].iloc[0]], "body": ["\n".join(lines) + "\n"]})

    return triples.groupBy("graph_kind", "graph_key").applyInPandas(serialise, "graph_kind string, graph_key string, body string")


def write_turtle(triples: DataFrame, root: str, space: Space = Space()) -> None:
    """ttl/<kind>/<key>.ttl, one file per graph; a key <diary>/<name> goes to <diary>/ttl/<kind>/<name>.ttl."""
    folder = F.regexp_extract("graph_key", r"^(.*/)?[^/]*$", 1)
    name = F.concat(folder, F.lit("ttl/"), "graph_kind", F.lit("/"), F.regexp_extract("graph_key", r"([^/]*)$", 1), F.lit(".ttl"))
    write_named_texts(turtle(triples, space).select(name.alias("name"), "body"), root)


def upload_plan(triples: DataFrame, diary: str, base: str = Space().base) -> DataFrame:
    """What an upload would do: for each graph a delete, then a post: step, method, graph_uri, file."""
    graphs = triples.select("graph_kind", "graph_key").distinct()
    uri = graph_uri("graph_kind", F.lit(diary), "graph_key", base)
    graphs = graphs.select("graph_kind", "graph_key", uri.alias("graph_uri"), _file("ttl/", F.col("graph_kind"), "/", F.col("graph_key"), ".ttl").alias("file"))
    steps = F.array(*[F.struct(F.lit(i).alias("step"), F.lit(m).alias("method")) for i, m in enumerate(("DELETE", "POST"))])
    return graphs.select(F.inline(steps), "graph_uri", "file")


def upload(triples: DataFrame, diary: str, send: Callable[[str, str, str | None], None], space: Space = Space()) -> None:
    """Replace each graph in a store: send("DELETE", uri, None), then send("POST", uri, turtle), from the tasks.

    `send` is the caller's transport with its credentials; there is no default, so nothing is sent by accident.
    """
    rows = turtle(triples, space).select(graph_uri("graph_kind", F.lit(diary), "graph_key", space.base).alias("uri"), "body")

    def run(part: Iterator) -> None:
        for row in part:
            send("DELETE", row["uri"], None)
            send("POST", row["uri"], row["body"])

    rows.foreachPartition(run)


def http_store(endpoint: str, username: str, password: str, timeout: float = 60) -> Callable[[str, str, str | None], None]:
    """A transport for `upload`: requests of the graph store protocol (endpoint?graph=<uri>) with basic authentication.

    A graph that the store does not hold may be deleted; any other refusal raises an error. Nothing is sent before a call.
    """
    login = "Basic " + base64.b64encode(f"{username}:{password}".encode()).decode()

    def send(method: str, uri: str, body: str | None) -> None:
        data = None if body is None else body.encode()
        request = Request(f"{endpoint}?graph={quote(uri, safe='')}", data, {"Authorization": login, "Content-Type": "text/turtle; charset=utf-8"}, method=method)
        try:
            urlopen(request, timeout=timeout).close()
        except HTTPError as refused:
            if method != "DELETE" or refused.code != 404:
                raise

    return send
