"""Structural metrics that are measured instead of constant (an option; the defaults stay constants).

* list depth: a fold over a document's item lines with a stack of their indentations;
* images without alternative text, block tags behind text on one line: patterns;
* anchors: links and headings of all documents exploded to rows, and the links that no
  document or heading answers found by an anti-join, so that a link into another document
  is looked up there.

The measured fields take the place of the constants in the metrics of an assessment, and
readiness and risk are scored again; their weights fire at last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.regex import WORD
from ..functions.text import let
from ..options import AssessOptions
from .scoring import readiness_score, risk_score

LIST_DEPTH_OK, DEEP = 3, 4  # deepest list that is still fine, and beyond which a document counts as deeply nested
ITEM = r"(?d)\A([ ]*)(?:[-*+]|\d{1,9}[.)])[ \t]+\S"
IMAGE_WITHOUT_ALT = r"!\[[ \t]*\]\("
BLOCK_BEHIND_TEXT = r"(?imd)^[^\n<]*[^\s<][^\n<]*<(?:div|table|p|ul|ol|pre|blockquote|h[1-6])\b"
LINK = r"(?<!!)\[[^\[\]\n]*\]\(([^()\s]+)"
SCHEME = r"\A(?:[A-Za-z][A-Za-z0-9+.-]*:|//)"
TASKS = 200  # of a shuffle, at least; Spark would join its small compressed parts to a few large tasks
FIELDS = ("lists_depth_ok", "images_with_alt", "deep_nesting", "unresolved_anchors", "mixed_inline_blocks")


def list_depth(text: Column) -> Column:
    """Depth of the deepest list: items indented further than the one before lie in it; text at the margin ends a list."""
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(ITEM) | x.rlike(r"\A\S"))
    marks = F.transform(lines, lambda x: F.when(x.rlike(ITEM), F.length(F.regexp_extract(x, ITEM, 1))).otherwise(-1))

    def step(state, indent):
        # what is indented as far or further has ended
        open_ = F.filter(state["stack"], lambda s: s < indent)
        stack = F.when(indent < 0, F.array().cast("array<int>")).otherwise(F.concat(open_, F.array(indent)))
        return F.struct(stack.alias("stack"), F.greatest(state["deepest"], F.size(stack)).alias("deepest"))

    start = F.struct(F.array().cast("array<int>").alias("stack"), F.lit(0).alias("deepest"))
    return F.aggregate(marks, start, step, lambda s: s["deepest"])


def _dealt(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt out by ``keys`` over a number of tasks that is not reduced, so that none sorts much."""
    return df.repartition(max(TASKS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))), *keys)


def slug(title: Column) -> Column:
    """The anchor of a heading: lower case, blanks as hyphens, without other marks."""
    return F.replace(F.regexp_replace(F.lower(title), rf"[^ \-{WORD[1:-1]}]", ""), F.lit(" "), F.lit("-"))


def anchors(documents: DataFrame) -> DataFrame:
    """``(path, anchor)``: the headings of every document; a slug that repeats gets ``-1``, ``-2``."""
    heads = documents.select("path", F.posexplode_outer(F.filter("section_list", lambda s: s["level"] > 0)).alias("k", "s")).filter("k is not null")
    of_slug = Window.partitionBy("path", "slug").orderBy("k")
    again = F.row_number().over(of_slug) - 1
    named = _dealt(heads.select("path", "k", slug(F.col("s.title")).alias("slug")), "path").withColumn("again", again)
    return named.select("path", F.when(F.col("again") > 0, F.concat_ws("-", "slug", F.col("again").cast("string"))).otherwise(F.col("slug")).alias("anchor"))


def _resolved(path: Column, target: Column) -> Column:
    """The path that a relative link names, from the folder of its document."""
    folder = F.regexp_extract(path, r"(?s)\A(.*/)?[^/]*\z", 1)
    parts = F.split(F.concat(folder, target), "/", -1)

    def step(done, part):
        up = (part == "..") & (F.size(done) > 0) & (F.element_at(F.concat(done, F.array(F.lit(""))), 1) != "..")
        return F.when(part.isin(".", ""), done).when(up, F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))).otherwise(F.concat(done, F.array(part)))

    return F.when(target == "", path).otherwise(F.array_join(F.aggregate(parts, F.array().cast("array<string>"), step), "/"))


def unresolved(documents: DataFrame) -> DataFrame:
    """``(path)`` of the documents with a relative link that leads to no document or no heading."""
    links = documents.select("path", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(LINK), 1))).alias("link")).filter(~F.col("link").rlike(SCHEME))
    file, anchor = F.substring_index("link", "#", 1), F.regexp_extract("link", "#(.*)", 1)
    asked = links.select("path", _resolved(F.col("path"), file).alias("target"), F.lower(anchor).alias("anchor"))
    # a document itself is the anchor without a name
    known = anchors(documents).unionByName(documents.select("path", F.lit("").alias("anchor")))
    known = known.select(F.col("path").alias("target"), "anchor")
    place = ("target", "anchor")
    # merged: the estimate for a small file of long texts would have all anchors sent to every task
    lost = _dealt(asked, *place).join(_dealt(known, *place).hint("merge"), list(place), "left_anti").select("path")
    return _dealt(lost, "path").distinct()


def measured(assessed: DataFrame, opts: AssessOptions = AssessOptions()) -> DataFrame:
    """``assessed`` (see ``assess_documents``) with measured metrics for Markdown documents, scored again."""
    documents = assessed.filter(F.col("fmt") == "md").select("path", F.coalesce("text", F.lit("")).alias("text"), "section_list")
    lost = unresolved(documents).withColumn("__lost", F.lit(True))
    text = F.coalesce("text", F.lit(""))
    is_md = F.col("fmt") == "md"
    fields = lambda d: F.col("metrics").withField("lists_depth_ok", d <= LIST_DEPTH_OK).withField("deep_nesting", d > DEEP)
    metrics = let(list_depth(text), fields).withField("images_with_alt", ~text.rlike(IMAGE_WITHOUT_ALT)).withField("mixed_inline_blocks", text.rlike(BLOCK_BEHIND_TEXT))
    # measured before the join, which then need not carry the texts
    joined = assessed.withColumn("metrics", F.when(is_md, metrics).otherwise(F.col("metrics"))).join(lost.hint("merge"), "path", "left")
    metrics = F.col("metrics").withField("unresolved_anchors", F.coalesce("__lost", F.lit(False)))
    staged = joined.withColumn("metrics", F.when(is_md, metrics).otherwise(F.col("metrics"))).drop("__lost")
    return staged.withColumns({
        "topicization_readiness": F.when(is_md, readiness_score(F.col("metrics"), opts)).otherwise(F.col("topicization_readiness")),
        "conversion_risk": F.when(is_md, risk_score(F.col("metrics"), opts)).otherwise(F.col("conversion_risk")),
    })
