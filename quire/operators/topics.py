"""DocBook → topic XML, topic references and the ordered map.

The map of a large corpus is never built as one string in one task: it is an
ordered table of text fragments (header, one line per topic, footer) that a
sink writes in order (``sources.sinks.write_fragments``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.paths import relative_path, stem
from ..functions.text import let, py_strip, remove_tags, xml_escape
from ..options import MAP_FOOTER, MAP_HEADER, TOPIC_ID, TOPIC_TEMPLATES, UNTITLED

TITLE_RE = r"(?iud)<title>(.*?)</title>"
PARA_RE = r"(?isu)<para>(.*?)</para>"


def extract_title(docbook: Column) -> Column:
    """First ``<title>…</title>`` on one line (case-insensitive), else ``Untitled``."""
    return F.when(docbook.rlike(TITLE_RE), F.regexp_extract(docbook, TITLE_RE, 1)).otherwise(F.lit(UNTITLED))


def extract_body(docbook: Column, fallback_chars: int | None = None) -> Column:
    """All ``<para>`` contents (stripped) as ``<p>`` elements; without any, the tag-free
    text, escaped, in one ``<p>`` (its first ``fallback_chars`` characters if given)."""
    docbook = F.coalesce(docbook, F.lit(""))
    plain = remove_tags(docbook)
    if fallback_chars is not None:
        plain = F.substring(plain, 1, fallback_chars)
    fallback = F.concat(F.lit("<p>"), xml_escape(plain), F.lit("</p>"))
    return let(
        F.regexp_extract_all(docbook, F.lit(PARA_RE), 1),
        lambda paras: F.when(
            F.size(paras) > 0,
            F.array_join(F.transform(paras, lambda p: F.concat(F.lit("<p>"), py_strip(p), F.lit("</p>"))), ""),
        ).otherwise(fallback),
    )


def build_topic(title: Column, body: Column, topic_type: Column, topic_id: str = TOPIC_ID) -> Column:
    """Topic XML for a known type (title escaped, body verbatim); null for an unknown type."""
    expr = None
    for kind, (open_, mid, close) in TOPIC_TEMPLATES.items():
        xml = F.concat(F.lit(open_.format(id=topic_id)), xml_escape(title), F.lit(mid), body, F.lit(close))
        expr = F.when(topic_type == kind, xml) if expr is None else expr.when(topic_type == kind, xml)
    return expr


def topic_type_error(topic_type: Column) -> Column:
    """Error text for a type without a template (null when the type is known)."""
    known = ", ".join(sorted(TOPIC_TEMPLATES))
    return F.when(
        ~topic_type.isin(*TOPIC_TEMPLATES) | topic_type.isNull(),
        F.concat(F.lit("Unknown topic_type '"), F.coalesce(topic_type, F.lit("None")),
                 F.lit(f"'. Expected one of: {known}")),
    )


def topic_file_name(path: Column, topic_type: Column) -> Column:
    """``<stem>_<type>.dita``."""
    return F.concat(stem(path), F.lit("_"), topic_type, F.lit(".dita"))


def topicref(topic_path: Column, map_dir: Column) -> Column:
    """``  <topicref href="…" />`` with the topic path relative to the map's folder."""
    return F.concat(F.lit('  <topicref href="'), relative_path(topic_path, map_dir), F.lit('" />'))


def map_fragments(topics: DataFrame, title: str, map_dir: str) -> DataFrame:
    """Ordered fragments of the map: header, one line per topic path (sorted, duplicates
    kept), footer.  ``(part, k1, k2, k3, fragment)``; concatenated in key order they
    are the map document."""
    spark = topics.sparkSession
    one = spark.range(1)
    esc_title = title.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")
    key = lambda part: [F.lit(part).cast("bigint").alias("part"), F.lit("").alias("k1"), F.lit(0).cast("bigint").alias("k2"), F.lit("").alias("k3")]
    header = one.select(*key(0), F.lit(MAP_HEADER.format(title=esc_title)).alias("fragment"))
    refs = topics.select(
        F.lit(1).cast("bigint").alias("part"),
        F.col("topic_path").alias("k1"),
        F.lit(0).cast("bigint").alias("k2"),
        F.lit("").alias("k3"),
        F.concat(topicref(F.col("topic_path"), F.lit(map_dir)), F.lit("\n")).alias("fragment"),
    )
    # refs end with newlines, then the footer: with no topic an empty line remains.  The
    # count is part of the plan and reads no more than the filter of the topics needs.
    count = topics.agg(F.count(F.lit(1)).alias("n"))
    footer = count.select(*key(2), F.when(F.col("n") > 0, MAP_FOOTER[1:]).otherwise(MAP_FOOTER).alias("fragment"))
    return header.unionByName(refs).unionByName(footer)
