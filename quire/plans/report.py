"""Assessment report: a summary table and the near-duplicate clusters, as ordered
HTML fragments ``(part, k1, k2, k3, fragment)``.

No cluster member list is gathered in one row: every member is its own fragment
keyed by (leader, member), so a cluster holding a third of the corpus is written
by many tasks.  Concatenated in key order the fragments are the report page; each ends
with a line break (white space between elements, without meaning in HTML).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import html_escape

# FIXED VALUES: the report page around the summary rows and the cluster list.
REPORT_HEAD = """<!doctype html>
<html>
<head>
  <meta charset="utf-8">
  <title>Assessment Report</title>
  <style>
    body { font-family: system-ui, sans-serif; max-width: 1200px; margin: 0 auto; padding: 1rem; }
    table { border-collapse: collapse; width: 100%; }
    td, th { border: 1px solid #ddd; padding: 6px 10px; text-align: left; }
    th { background: #f4f4f4; }
  </style>
</head>
<body>
<h1>Assessment Report</h1>
<h2>Summary</h2>
<p>Total files: """
REPORT_TABLE_OPEN = """</p>
<table>
  <thead>
    <tr><th>File</th><th>Bytes</th><th>Sections</th><th>Readiness</th><th>Risk</th></tr>
  </thead>
  <tbody>"""
REPORT_MIDDLE = """</tbody>
</table>
<h2>Near-Duplicate Clusters</h2>
"""
REPORT_NO_DUPLICATES = "<p>No near-duplicates found.</p>"
REPORT_TAIL = """
</body>
</html>"""


def report_summary(inv: DataFrame) -> DataFrame:
    """``(path, size, sections, readiness, risk)`` per document."""
    return inv.select(
        "path",
        "size",
        "sections",
        F.col("topicization_readiness").alias("readiness"),
        F.col("conversion_risk").alias("risk"),
    )


def _frag(part: int, k1, k2: int, k3, fragment):
    return [
        F.lit(part).cast("bigint").alias("part"),
        (k1 if not isinstance(k1, str) else F.lit(k1)).alias("k1"),
        F.lit(k2).cast("bigint").alias("k2"),
        (k3 if not isinstance(k3, str) else F.lit(k3)).alias("k3"),
        fragment.alias("fragment"),
    ]


def report_fragments(inv: DataFrame, key_leader: DataFrame) -> DataFrame:
    """Ordered fragments of the report page from the inventory and ``(key, leader)``."""
    summary = report_summary(inv)
    line = F.lit("\n")
    count = summary.agg(F.count(F.lit(1)).alias("n"))
    head = count.select(*_frag(0, "", 0, "", F.concat(F.lit(REPORT_HEAD), F.col("n").cast("string"), F.lit(REPORT_TABLE_OPEN), line)))
    row = F.concat(
        F.lit("<tr><td>"), html_escape(F.col("path")), F.lit("</td><td>"),
        F.col("size").cast("string"), F.lit("</td><td>"),
        F.col("sections").cast("string"), F.lit("</td><td>"),
        F.col("readiness").cast("string"), F.lit("</td><td>"),
        F.col("risk").cast("string"), F.lit("</td></tr>"), line,
    )
    rows = summary.select(*_frag(1, F.col("path"), 0, "", row))

    members = key_leader.filter(F.col("key") != F.col("leader"))
    dup_rows = members.select(*_frag(3, F.col("leader"), 1, F.col("key"), F.concat(F.lit(", "), html_escape(F.col("key")), line)))
    # one distinct over the leaders gives both the opening and the closing fragment
    bounds = members.select("leader").distinct().select(
        "leader",
        F.explode(F.array(
            F.struct(F.lit(0).cast("bigint").alias("k2"), F.concat(F.lit("<li>"), html_escape(F.col("leader")), line).alias("f")),
            F.struct(F.lit(2).cast("bigint").alias("k2"), F.concat(F.lit("</li>"), line).alias("f")),
        )).alias("b"),
    ).select(
        F.lit(3).cast("bigint").alias("part"), F.col("leader").alias("k1"), F.col("b.k2").alias("k2"),
        F.lit("").alias("k3"), F.col("b.f").alias("fragment"),
    )
    some = members.agg(F.count(F.lit(1)).alias("n"))  # of the materialized cluster table
    list_open = F.when(F.col("n") > 0, "<ul>\n").otherwise(REPORT_NO_DUPLICATES + "\n")
    middle = some.select(*_frag(2, "", 0, "", F.concat(F.lit(REPORT_MIDDLE), list_open)))
    tail = some.select(*_frag(4, "", 0, "", F.concat(F.when(F.col("n") > 0, "</ul>").otherwise(""), F.lit(REPORT_TAIL), line)))
    out = head
    for df in (rows, middle, bounds, dup_rows, tail):
        out = out.unionByName(df)
    return out
