"""Line deduplication with a log-template tree; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import discard, materialize, named, tune

MIN_DOCS = 3
DEPTH = 3
#: A line joins its leaf's template if this share of the tokens behind the leading ones agree with it (in tenths).
AGREE_TENTHS = 7
FIELD = "<*>"
_BLANKS = r"[ \t\r\f\x0B]+"


def _flat(line):
    """The line with blanks collapsed; lines that need no change are only searched."""
    blanks = line.contains("  ")
    for c in "\t\r\f\x0b":
        blanks = blanks | line.contains(c)
    return F.trim(F.when(blanks, F.regexp_replace(line, _BLANKS, " ")).otherwise(line))


def _masked(flat):
    """Every token that holds a digit replaced by a variable field."""
    # anchored at token starts, so that a very long token is read once
    return F.when(flat.rlike("[0-9]"), F.regexp_replace(flat, r"(?<![^ ])[^ 0-9]*+[0-9][^ ]*", FIELD)).otherwise(flat)


def _text_key(text="text"):
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit(""))))


def _lines(docs: DataFrame, depth: int) -> DataFrame:
    """One row per line that is not blank: document, line number, masked line's digest and its leaf of the tree."""
    # the digest of the text in a step of its own: beside the generator it would be computed for every line
    rows = docs.select("doc_id", _text_key().alias("text_key"), "text")
    rows = rows.select("doc_id", "text_key", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("line_no", "line"))
    # blank lines are told by the line itself: a filter on the masked form would compute it twice
    rows = rows.where(F.btrim("line", F.lit(" \t\r\f\x0b")) != "").select("doc_id", "text_key", "line_no", _flat(F.col("line")).alias("flat"))
    rows = rows.select("doc_id", "text_key", "line_no", _masked(F.col("flat")).alias("masked"))
    tokens = F.length("masked") - F.length(F.replace("masked", F.lit(" "), F.lit(""))) + 1
    return rows.select(
        "doc_id", "text_key", "line_no", F.unhex(F.md5("masked")).alias("m"), F.xxhash64(tokens, F.substring_index("masked", " ", depth)).alias("leaf")
    )


def _keyed(docs: DataFrame, min_docs: int, depth: int, agree_tenths: int) -> DataFrame:
    """Lines (doc_id, text_key, line_no) with the template `key` each belongs to; those that cannot recur are left out.

    A template lies within one leaf, so a leaf of fewer than `min_docs` lines is done with at once: its lines stay.
    """
    lines = materialize(_lines(docs, depth), "lines")
    leaves = lines.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"), F.min("m").alias("low"), F.max("m").alias("high")).where(F.col("n") >= min_docs)
    live = materialize(lines.join(leaves.select("leaf", (F.col("low") != F.col("high")).alias("several")), "leaf"), "live-lines")
    discard(lines)
    # leaves in which there is something to generalise: one example of each masked form is read back from its document
    seen = live.where("several").groupBy("leaf", "m").agg(F.count(F.lit(1)).alias("rows"), F.min(F.struct("doc_id", "text_key", "line_no")).alias("at"))
    wanted = seen.groupBy(F.col("at.doc_id").alias("doc_id"), F.col("at.text_key").alias("text_key")).agg(
        F.collect_list(F.struct(F.col("at.line_no").alias("line_no"), "leaf", "m", "rows")).alias("wanted")
    )
    wanted = materialize(wanted, "line-examples")
    texts = docs.select(F.col("doc_id").alias("own_id"), _text_key().alias("own_key"), "text")
    found = wanted.join(texts, F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("text_key") == F.col("own_key")))
    found = _with_lines(found.select("wanted", "text"), "text")
    forms = found.select(F.explode(F.transform("wanted", lambda w: F.struct(w["leaf"], w["m"], w["rows"], F.col("__quire_lines")[w["line_no"]].alias("line")))).alias("form"))
    forms = forms.select("form.leaf", "form.m", "form.rows", _flat(F.col("form.line")).alias("flat"))
    forms = forms.select("leaf", "m", "rows", _masked(F.col("flat")).alias("masked")).dropDuplicates(["m"])  # rows of one id and text give an example each
    forms = materialize(forms.select("leaf", "m", "rows", F.split("masked", " ").alias("tokens")), "line-forms")
    template = materialize(_templates(forms, "leaf", depth), "leaf-templates")  # a plain table on this side lets a large leaf's forms be split among tasks
    judged = forms.join(template, "leaf").withColumn("agrees", _agrees(depth, agree_tenths))
    merged = judged.where("agrees").select("m", F.unhex(F.md5(F.concat(F.lit("leaf "), F.col("leaf").cast("string")))).alias("leaf_key"))
    # a tail so short that no position may differ can follow its own form only
    tail = F.size("tokens") - depth
    rest = judged.where(~F.col("agrees") & (10 * (tail - 1) >= agree_tenths * tail) & _may_share(depth, agree_tenths))
    rest = materialize(rest.select("leaf", "m", "rows", "tokens"), "line-rest")
    further = _further(rest, min_docs, depth, agree_tenths)
    merged = merged if further is None else merged.unionByName(further)
    return live.join(merged, "m", "left").select("doc_id", "text_key", "line_no", F.coalesce("leaf_key", "m").alias("key"))


def _with_lines(rows: DataFrame, text: str) -> DataFrame:
    """The rows with their text's lines in __quire_lines.

    A generator of one row holds the array as a value of its own; as a plain expression the optimizer would move it into the
    functions that pick lines, which then split the text once for each line.
    """
    return rows.select("*", F.explode_outer(F.array(F.split(text, "\n", -1))).alias("__quire_lines"))


def _spread(forms: DataFrame, by: str, depth: int) -> DataFrame:
    """The rows and forms that hold each token at each position behind the leading tokens."""
    spread = forms.select(by, "rows", F.posexplode("tokens").alias("pos", "token")).where(F.col("pos") >= depth)
    return spread.groupBy(by, "pos", "token").agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("forms"))


def _bit(token):
    return F.xxhash64(token).bitwiseAND(F.lit(63)).cast("int")


def _templates(forms: DataFrame, by: str, depth: int) -> DataFrame:
    """Each leaf or group by position: its template, which is the commonest token (the smallest of equals); whether tokens differ
    there; and the bits of the tokens that several forms have there, which is 8 bytes however large the group is."""
    bit = F.when(F.col("forms") >= 2, F.call_function("shiftleft", F.lit(1).cast("long"), _bit("token"))).otherwise(F.lit(0).cast("long"))
    common = _spread(forms, by, depth).groupBy(by, "pos").agg(
        F.min_by("token", F.struct(-F.col("rows"), F.col("token"))).alias("token"), (F.count(F.lit(1)) >= 2).alias("differ"), F.bit_or(bit).alias("shared")
    )
    places = common.groupBy(by).agg(F.array_sort(F.collect_list(F.struct("pos", "token", "differ", "shared"))).alias("places"))
    return places.select(by, F.col("places.token").alias("template"), F.col("places.differ").alias("differ"), F.col("places.shared").alias("shared"))


def _places(depth: int, against: str, holds):
    """At how many positions behind the leading ones `holds` is true of the token and the entry of `against`."""
    tail = F.slice("tokens", depth + 1, F.greatest(F.size("tokens") - depth, F.lit(0)))
    return F.size(F.filter(F.zip_with(tail, F.col(against), holds), lambda x: x))


def _agrees(depth: int, agree_tenths: int):
    return 10 * _places(depth, "template", lambda a, b: a == b) >= agree_tenths * (F.size("tokens") - depth)


def _may_share(depth: int, agree_tenths: int):
    """False of forms that cannot follow any template together with another form of their leaf or group.

    Two forms that both agree with one template in `a` of `t` positions have the same token in 2a - t positions at least. A form
    whose tokens are not held by several forms in as many positions has no such partner. Bits that tokens have in common
    only let a form stay.
    """
    tail = F.size("tokens") - depth
    least = F.ceil(F.lit(agree_tenths) * tail / 10)
    return _places(depth, "shared", lambda a, b: F.getbit(b, _bit(a)) == 1) >= 2 * least - tail


def _further(rest: DataFrame, min_docs: int, depth: int, agree_tenths: int) -> DataFrame | None:
    """m and leaf_key of the forms that follow a further template of their leaf; `rest` are those the first one left.

    In each round every group of forms (at first a leaf) gets a template; the forms that do not agree with it go on by
    their token at one position: of those at which the group differs, the one where these forms differ least, so that mixed
    templates come apart before a field is split. Forms that have no partner in their group end, as does a group of one form
    or of too few lines; so lines of prose that happen to begin alike do not go through the rounds. Each round fixes a
    position, so there are at most as many as a line has tokens, and all groups share a round.
    """
    found, old = None, []
    groups = rest.withColumn("group", F.col("leaf"))
    while True:
        large = groups.groupBy("group").agg(F.count(F.lit(1)).alias("n"), F.sum("rows").alias("lines")).where((F.col("n") >= 2) & (F.col("lines") >= min_docs))
        groups = materialize(groups.join(large.select("group"), "group"), "line-groups")
        for table in old:
            discard(table)
        if groups.isEmpty():
            break
        template = materialize(_templates(groups, "group", depth), "group-templates")
        judged = groups.join(template, "group").withColumn("agrees", _agrees(depth, agree_tenths))
        new = judged.where("agrees").groupBy("leaf", "group", "template").agg(F.count(F.lit(1)).alias("n"), F.sum("rows").alias("lines"))
        new = materialize(new.where((F.col("n") >= 2) & (F.col("lines") >= min_docs)).select("leaf", "template", "lines"), "further-templates")
        found = new if found is None else found.unionByName(new)
        left = judged.where(~F.col("agrees") & _may_share(depth, agree_tenths)).select("leaf", "m", "rows", "tokens", "group")
        places = _spread(left, "group", depth).groupBy("group", "pos").agg(F.sum(F.col("forms") * F.col("forms")).alias("weight"))
        places = places.join(template, "group").where(F.col("differ")[F.col("pos") - depth])
        split = places.groupBy("group").agg(F.min_by("pos", F.struct(-F.col("weight"), F.col("pos"))).alias("pos"))
        split = materialize(split, "group-splits")  # the next groups are read twice
        old = [groups, template, split]
        groups = left.join(split, "group").withColumn("group", F.xxhash64("group", "pos", F.col("tokens")[F.col("pos")])).drop("pos")
    if found is None:
        return None
    found = found.groupBy("leaf", "template").agg(F.sum("lines").alias("lines"))
    # of all templates of its leaf that a form agrees with, the one of most lines: a split through a field is undone here
    pairs = rest.join(found, "leaf").where(_agrees(depth, agree_tenths))
    best = pairs.groupBy("leaf", "m").agg(F.min_by("template", F.struct(-F.col("lines"), F.col("template"))).alias("template"))
    key = F.concat(F.lit("leaf "), F.col("leaf").cast("string"), F.lit(" "), F.array_join("template", " "))
    return materialize(best.select("m", F.unhex(F.md5(key)).alias("leaf_key")), "further-forms")


def recurring_lines(docs: DataFrame, min_docs: int = MIN_DOCS, depth: int = DEPTH, agree_tenths: int = AGREE_TENTHS) -> DataFrame:
    """For each document with lines to drop: doc_id, text_key and `dropped`, their numbers in ascending order."""
    tune(docs.sparkSession)
    keyed = _keyed(docs, min_docs, depth, agree_tenths)
    per_doc = keyed.groupBy("key", "doc_id").agg(F.min("line_no").alias("line_no"))
    often = (
        per_doc.groupBy("key")
        .agg(F.count(F.lit(1)).alias("docs"), F.min(F.struct("doc_id", "line_no")).alias("first"))
        .where(F.col("docs") >= min_docs)
        .select("key", "first")
    )
    often = materialize(often, "templates")  # a plain table on this side lets a hot template's lines be split among tasks
    first = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("line_no") == F.col("first.line_no"))
    return keyed.join(often, "key").where(~first).groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_set("line_no")).alias("dropped"))


def line_dedup(docs: DataFrame, min_docs: int = MIN_DOCS, depth: int = DEPTH, agree_tenths: int = AGREE_TENTHS, counts: bool = False) -> DataFrame:
    """Drop the lines whose template recurs in `min_docs` documents or more; the first occurrence stays.

    Lines (split at line feeds) go down a tree of fixed depth: token count, then the `depth` leading tokens, where a
    token with a digit is a variable field. In a leaf with several forms, the commonest token of each further position
    makes the leaf's template; forms that agree with it in `agree_tenths` tenths of these positions belong to it. The
    others are split further until they share a template (of those they agree with, the one of most lines) or are
    templates of their own. A template that lines of `min_docs` distinct doc_ids follow is dropped everywhere
    but at its first line (smallest doc_id, then line number), so nothing vanishes from the whole collection.

    Returns all columns of `docs` with the new `text`, and n_lines and n_dropped if `counts` (they replace columns of
    these names). Null text stays null and has no lines; blank lines are neither counted nor dropped; a text that loses
    all lines becomes empty. Rows with null id count as one document. Repeated rows get equal results. Counting folds
    before each shuffle; a template that a third of all lines follow is one row per task.
    """
    drops = recurring_lines(docs, min_docs, depth, agree_tenths).select(
        F.col("doc_id").alias("__quire_id"), F.col("text_key").alias("__quire_key"), F.col("dropped").alias("__quire_dropped")
    )
    cols = docs.columns
    lines = F.col("__quire_lines")
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__quire_dropped"))
    joined = docs.withColumn("__quire_own", _text_key()).join(
        drops, F.col("doc_id").eqNullSafe(F.col("__quire_id")) & (F.col("__quire_own") == F.col("__quire_key")), "left"
    )
    joined = _with_lines(joined, "text")
    hit = F.col("__quire_dropped").isNotNull() & F.col("text").isNotNull()
    extra = {}
    if counts:
        extra = {
            "n_lines": F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long"),
            "n_dropped": F.when(hit, F.size("__quire_dropped")).otherwise(0).cast("long"),
        }
    text = F.when(hit, F.array_join(F.transform(kept, lambda i: lines[i]), "\n")).otherwise(F.col("text"))
    return joined.select(*[text.alias(c) if c == "text" else named(c) for c in cols if c not in extra], *[v.alias(k) for k, v in extra.items()])
