"""RDF graphs as relations: each graph kind is a template that a row fills with triples."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.text import HEADER_SENTINEL

# Vocabularies that graph consumers expect.
PLATFORM = "http://www.researchspace.org/resource/system/"
LDP = "http://www.w3.org/ns/ldp#"
CRM = "http://www.cidoc-crm.org/cidoc-crm/"
CRMDIG = "http://www.ics.forth.gr/isl/CRMdig/"
PROV = "http://www.w3.org/ns/prov#"
OA = "http://www.w3.org/ns/oa#"
OWL = "http://www.w3.org/2002/07/owl#"
RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
RDFS = "http://www.w3.org/2000/01/rdf-schema#"
XSD = "http://www.w3.org/2001/XMLSchema#"
IMAGE_CLASS = "http://www.researchspace.org/ontology/EX_Digital_Image"
TEXT_DOCUMENTS = "http://www.researchspace.org/resource/TextDocuments"
ADMIN = "http://www.researchspace.org/resource/admin"
USER = "http://www.researchspace.org/resource/user/"


@dataclass(frozen=True)
class Space:
    """Addresses of a publication: base (ending in a slash), from which resources and the ontology follow."""

    base: str = "https://example.org/"

    @property
    def resource(self) -> str:
        return f"{self.base}resource/"

    @property
    def ontology(self) -> str:
        return f"{self.base}ontology/"

    def prefixes(self) -> dict[str, str]:
        return {
            "Platform": PLATFORM, "crm": CRM, "crmdig": CRMDIG, "ldp": LDP, "prov": PROV, "oa": OA, "owl": OWL, "rdf": RDF, "rdfs": RDFS, "xsd": XSD,
            "onto": self.ontology,
        }


def _c(x: Column | str) -> Column:
    return F.lit(x) if isinstance(x, str) else x


def _cat(*parts: Column | str) -> Column:
    return F.concat(*[_c(p).cast("string") for p in parts])


def _iri(s: Column | str, p: str, o: Column | str) -> Column:
    return _triple(s, p, o, "iri", None)


def _lit(s: Column | str, p: str, o: Column | str, datatype: str | None = "string") -> Column:
    return _triple(s, p, o, "literal", datatype)


def _triple(s: Column | str, p: str, o: Column | str, kind: str, datatype: str | None) -> Column:
    return F.struct(
        _c(s).alias("subject"), F.lit(p).alias("predicate"), _c(o).cast("string").alias("object"), F.lit(kind).alias("object_kind"),
        F.lit(XSD + datatype if datatype else None).cast("string").alias("datatype"),
    )


def _build(rows: DataFrame, kind: str, key: Column | str, template: list[Column], inputs: Sequence[str]) -> DataFrame:
    """Fill the template for every row, each triple of a graph once; triples without an object are optional parts that the row lacks.

    `inputs` are the columns that the template reads. Equal triples lie in one graph, so rows are dealt by graph, before
    they are filled: a row is narrower than its triples. The first row of a graph gives all its triples; of the others only those that
    the first lacks are compared with each other. No two parts of a template may give the same triple for one row.
    """
    key = F.col(key) if isinstance(key, str) else key
    # a number of partitions that adaptive execution keeps: by its size, it would deal these narrow rows to a few tasks
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = rows.select(key.cast("string").alias("graph_key"), *inputs).repartition(parts, "graph_key")
    in_graph = Window.partitionBy("graph_key").orderBy(*inputs)
    opening = F.first(F.struct(*inputs)).over(in_graph.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    numbered = keyed.withColumn("opens", F.lag(F.lit(True)).over(in_graph).isNull()).withColumn("opening", opening)
    filled = F.array(*template)
    first = numbered.where("opens").select("graph_key", F.inline(filled))
    # twice the template: on the row's own columns, then on those of the graph's first row
    rest = numbered.where("not opens").select("graph_key", filled.alias("own"), "opening.*").select("graph_key", F.inline(F.array_except("own", filled)))
    full = first.unionByName(rest.dropDuplicates()).where("object is not null and subject is not null")
    return full.select(F.lit(kind).alias("graph_kind"), "*")


def diary_triples(diaries: DataFrame, space: Space = Space(), key: Column | str = "diary") -> DataFrame:
    """Graphs of diaries (diary, image, title, idx, iiif_manifest): nine triples, ten with a manifest; `key` names the graph."""
    d, image = _cat(space.resource, "diary/", F.col("diary")), F.col("image")
    label = F.concat_ws(", ", _cat("Diary ", F.coalesce(F.col("idx").cast("string"), F.lit("None"))), F.col("title"))
    template = [
        _iri(f"{PLATFORM}fileContainer", f"{LDP}contains", d),
        _iri(d, f"{RDF}type", f"{CRM}E22_Man-Made-Object"),
        _iri(d, f"{CRM}P2_has_type", f"{space.ontology}Diary"),
        _lit(d, f"{RDFS}label", label),
        _lit(d, f"{space.ontology}order", F.coalesce(F.col("idx").cast("string"), F.lit("None")), "integer"),
        _lit(d, f"{space.ontology}is_published", "true", "boolean"),
        _lit(d, f"{space.ontology}iiif-manifest", F.nullif(F.col("iiif_manifest"), F.lit(""))),
        _iri(d, f"{CRM}P183i_has_representation", image),
        _iri(image, f"{RDF}type", f"{CRM}E38_Image"),
        _iri(image, f"{RDF}type", IMAGE_CLASS),
    ]
    return _build(diaries, "diary", key, template, ("diary", "image", "title", "idx", "iiif_manifest"))


def page_triples(pages: DataFrame, run_ts: str, space: Space = Space(), key: Column | str = "page") -> DataFrame:
    """Graphs of pages (diary, page, text, image, location_*): 20 triples and one per location part.

    `key` names the graph; page numbers are unique within a diary only.
    """
    number = F.col("page").cast("string")
    p, d = _cat(space.resource, "diary/", F.col("diary"), "/page/", number), _cat(space.resource, "diary/", F.col("diary"))
    f, name, image = _cat(space.base, "diary/", F.col("diary"), "/document/", number), _cat(F.col("diary"), "_", number, ".html"), F.col("image")
    template = [
        _iri(f"{PLATFORM}fileContainer", f"{LDP}contains", f),
        _iri(f, f"{RDF}type", f"{PLATFORM}File"),
        _iri(f, f"{RDF}type", f"{LDP}Resource"),
        _iri(f, f"{RDF}type", f"{space.ontology}Document"),
        _lit(f, f"{RDFS}label", _cat("LDP Container of document file of ", name)),
        _iri(f, f"{PLATFORM}fileContext", TEXT_DOCUMENTS),
        _lit(f, f"{PLATFORM}fileName", name),
        _lit(f, f"{PLATFORM}mediaType", "form-data"),
        _lit(f, f"{PROV}generatedAtTime", run_ts, "dateTime"),
        _iri(f, f"{PROV}wasAttributedTo", ADMIN),
        _iri(p, f"{CRM}P129i_is_subject_of", f),
        _iri(image, f"{RDF}type", f"{CRM}E38_Image"),
        _iri(image, f"{RDF}type", IMAGE_CLASS),
        _iri(p, f"{CRM}P183i_has_representation", image),
        _iri(p, f"{RDF}type", f"{space.ontology}Page"),
        _iri(p, f"{RDF}type", f"{CRM}E22_Man-Made_Object"),
        _lit(p, f"{RDFS}label", number),
        _lit(p, f"{space.ontology}index", number, "integer"),
        _iri(p, f"{space.ontology}part_of", d),
        _lit(p, f"{RDF}value", F.col("text")),
    ]
    located = {"location_wkt": "hasLocationWkt", "location_name": "hasLocationName", "location_link": "hasLocationLink"}
    located = {column: name_ for column, name_ in located.items() if column in pages.columns}
    template += [_lit(p, f"{space.ontology}{name_}", F.col(column), None) for column, name_ in located.items()]
    return _build(pages, "document", key, template, ("diary", "page", "image", *located, "text"))


def page_date_triples(dates: DataFrame, space: Space = Space(), profile: str = "code", key: Column | str = "page") -> DataFrame:
    """Production dates of pages (diary, page, object as ISO date, predicate, original_text).

    Eight triples a date in the profile "code"; twelve in "golden", where production nodes lie outside the resources, carry a
    label, a confidence and the original text, and the document is linked to the date. Other predicates than the header's
    become plain literals. `key` names the graph; it must be the key of the page's own graph.
    """
    number = F.col("page").cast("string")
    golden = profile == "golden"
    p, f = _cat(space.resource, "diary/", F.col("diary"), "/page/", number), _cat(space.base, "diary/", F.col("diary"), "/document/", number)
    made = _cat(space.base if golden else space.resource, "diary/", F.col("diary"), "/page/", number, "/production")
    span, day = _cat(made, "/timespan" if golden else "/date"), _cat(space.resource, "date/", F.col("object"))
    label = F.date_format(F.to_date("object"), "MMMM dd, yyyy" if golden else "yyyy MMMM dd")
    template = [
        _iri(p, f"{CRM}P108i_was_produced_by", made),
        _iri(made, f"{RDF}type", f"{CRM}E12_Production"),
        _iri(made, f"{CRM}P4_has_time-span", span),
        _iri(span, f"{RDF}type", f"{CRM}E52_Time_Span"),
        _iri(span, f"{CRM}P86_falls_within", day),
        _iri(day, f"{RDF}type", f"{CRM}E52_Time_Span"),
        _lit(day, f"{RDFS}label", label),
        _lit(day, f"{RDF}value", F.col("object"), "date"),
    ]
    if golden:
        template += [
            _lit(made, f"{RDFS}label", _cat("Production of page ", F.col("diary"), "_", number)),
            _lit(span, f"{space.ontology}date_confidence", "medium"),
            _lit(span, f"{space.ontology}original_date_text", F.col("original_text")),
            _iri(f, f"{space.ontology}has_date", day),
        ]
    return _build(dates.where(F.col("predicate") == HEADER_SENTINEL), "document", key, template, ("diary", "page", "object", *(("original_text",) if golden else ())))


def annotation_triples(
    annotations: DataFrame, run_ts: str, space: Space = Space(), compat_source: bool = False, random_ids: bool = False, key: Column | str = "id"
) -> DataFrame:
    """Graphs of annotations (diary, id, page, type, fulltext, permalinks, para_index, start, end, annotator): 36 triples
    and one per permalink that is not empty.

    Inner nodes are named by a hash of annotation and role, so a rerun gives the same graph; random_ids uses UUIDs (drawn
    once per row). compat_source repeats the doubled slash of older source addresses. `key` names the graph; ids are unique
    within a diary only, so several diaries need their name in it.
    """
    rows = annotations
    roles = ("event", "target", "range", "start", "start-offset", "end", "end-offset")
    if random_ids:
        for r in roles:
            rows = rows.withColumn(f"uid_{r}", F.uuid())
    uid = lambda r: F.col(f"`uid_{r}`") if random_ids else F.sha2(_cat(F.col("diary"), "|", F.col("id"), "|", r), 256)
    a = _cat(space.resource, "diary/", F.col("diary"), "/annotation/", F.col("id"))
    c, b = _cat(a, "/container"), _cat(a, "/body")
    source = _cat(space.base + ("/" if compat_source else ""), "diary/", F.col("diary"), "/document/", F.col("page").cast("string"))
    user = _cat(USER, F.coalesce("annotator", F.lit("admin")))
    event, target, range_ = _cat(source, "/annotation-event-", uid("event")), _cat(source, "/range-source-", uid("target")), _cat(source, "/range-", uid("range"))
    start, end = _cat(source, "/xpath-", uid("start")), _cat(source, "/xpath-", uid("end"))
    start_at, end_at = _cat(source, "/offset-", uid("start-offset")), _cat(source, "/offset-", uid("end-offset"))
    changed, path = _cat(event, "/modifiedAt"), _cat("/p[", F.col("para_index").cast("string"), "]")
    first, last = F.col("start").cast("string"), F.col("end").cast("string")
    template = [
        _iri(f"{PLATFORM}formContainer", f"{LDP}contains", c),
        _iri(c, f"{RDF}type", f"{LDP}Resource"),
        _iri(c, f"{RDF}type", f"{PROV}Entity"),
        _lit(c, f"{RDFS}label", _cat("LDP Container of annotation in diary ", F.col("diary"), " number ", F.col("id"))),
        _iri(c, f"{PROV}wasAttributedTo", user),
        _lit(c, f"{PROV}generatedAtTime", run_ts, "dateTime"),
        _iri(a, f"{RDF}type", f"{OA}Annotation"),
        _iri(a, f"{RDF}type", f"{CRMDIG}D29_Annotation_Object"),
        _iri(event, f"{RDF}type", f"{CRMDIG}D30_Annotation_Event"),
        _iri(event, f"{CRM}P14_carried_out_by", user),
        _iri(a, f"{CRMDIG}L48i_was_annotation_created_by", event),
        _lit(changed, f"{CRM}P81b_begin_of_the_end", run_ts, "dateTime"),
        _lit(changed, f"{CRM}P81a_end_of_the_begin", run_ts, "dateTime"),
        _iri(event, f"{CRM}P4_has_time-span", changed),
        _iri(target, f"{RDF}type", f"{OA}SpecificResource"),
        _lit(target, f"{RDF}value", F.col("fulltext"), None),
        _iri(target, f"{OA}hasSource", source),
        _iri(a, f"{OA}hasTarget", target),
        _iri(range_, f"{RDF}type", f"{OA}RangeSelector"),
        _iri(target, f"{OA}hasSelector", range_),
        _lit(start, f"{RDF}value", path, None),
        _iri(range_, f"{OA}hasStartSelector", start),
        _iri(start_at, f"{RDF}type", f"{OA}TextPositionSelector"),
        _lit(start_at, f"{OA}start", first, "nonNegativeInteger"),
        _lit(start_at, f"{OA}end", first, "nonNegativeInteger"),
        _iri(start, f"{OA}refinedBy", start_at),
        _iri(end, f"{RDF}type", f"{OA}XPathSelector"),
        _lit(end, f"{RDF}value", path, None),
        _iri(range_, f"{OA}hasEndSelector", end),
        _iri(end_at, f"{RDF}type", f"{OA}TextPositionSelector"),
        _lit(end_at, f"{OA}start", last, "nonNegativeInteger"),
        _lit(end_at, f"{OA}end", last, "nonNegativeInteger"),
        _iri(end, f"{OA}refinedBy", end_at),
        _iri(b, f"{RDF}type", _cat(space.ontology, F.col("type"))),
        _lit(b, f"{RDFS}label", F.col("fulltext")),
        _iri(a, f"{OA}hasBody", b),
    ]
    key = F.col(key) if isinstance(key, str) else key
    inputs = ("diary", "id", "page", "type", "para_index", "start", "end", "annotator", "fulltext", *(f"uid_{r}" for r in roles if random_ids))
    graph = _build(rows, "annotation", key, template, inputs)
    links = rows.select("diary", "id", key.alias("key"), F.explode(F.filter("permalinks", lambda x: x != "")).alias("permalink"))
    return graph.unionByName(_build(links, "annotation", "key", [_iri(b, f"{OWL}sameAs", F.col("permalink"))], ("diary", "id", "permalink")))


def day_triples(days: DataFrame, space: Space = Space(), key: Column | str = "day") -> DataFrame:
    """Graphs of days (diary, day, date, page): six triples; `key` names the graph, as day numbers repeat between diaries."""
    node = _cat(space.resource, "diary/", F.col("diary"), "/day/", F.col("day").cast("string"))
    diary = _cat(space.resource, "diary/", F.col("diary"))
    template = [
        _iri(node, f"{RDF}type", f"{CRM}E22_Man-Made_Object"),
        _iri(node, f"{CRM}P2_has_type", f"{space.ontology}Day"),
        _lit(node, f"{RDFS}label", _cat("Day #", F.col("day").cast("string"), " (", F.col("date").cast("string"), ")")),
        _iri(node, f"{CRM}P46i_forms_part_of", diary),
        _lit(node, f"{space.ontology}order", F.col("day").cast("string"), "integer"),
        _iri(node, f"{CRM}P62i_is_depicted_by", _cat(diary, "/page/", F.col("page").cast("string"))),
    ]
    return _build(days, "day", key, template, ("diary", "day", "date", "page"))


def union_graphs(*graphs: DataFrame) -> DataFrame:
    """All triples of several graph kinds as one relation, each once."""
    out = graphs[0]
    for g in graphs[1:]:
        out = out.unionByName(g)
    return out.dropDuplicates()


def graph_uri(kind: Column | str, diary: Column | str, key: Column | str, base: str = Space().base) -> Column:
    """Address of a named graph in the store, by its kind."""
    kind, diary, key = (F.col(x) if isinstance(x, str) else x for x in (kind, diary, key))
    root = base.rstrip("/")
    return (
        F.when(kind == "diary", _cat(root, "/resource/diary/", key, "/context"))
        .when(kind == "annotation", _cat(root, "/diary/", diary, "/annotation/", key, "/container/context"))
        .otherwise(_cat(root, "/diary/", diary, "/", kind, "/", key, "/context"))
    )
