"""Document corpora derived from the driver's parquet tables.

Each corpus is written once as plain SQL select-expressions that both Spark and
DuckDB accept, so the correctness oracle builds exactly the same input rows.
No grouping is needed: every source row is one document, so no key (brand,
conversation, source) can pile a third of the data into one task.

* ``documents``      → Markdown files ``docs/<source>/<doc_id>.md`` (prose, one
  ``Document`` section each, exact and near copies for dedupe)
* ``conversations``  → one Markdown file per turn with a two-level heading
* ``part``           → one Markdown "product guide" per part with ordered steps,
  a pipe table, links, images and (for some sizes) a heading jump
* ``pages``          → HTML files ``pages/<page_id>.html``
* ``benchmark``      → plain ``.txt`` files (generic route)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

NL = "chr(10)"

CORPUS_SQL: dict[str, tuple[str, str, str]] = {
    # name: (table, path expression, text expression)
    "documents": (
        "documents",
        "concat('docs/', source, '/', cast(doc_id as string), '.md')",
        "text",
    ),
    "conversations": (
        "conversations",
        "concat('conversations/', cast(conv_id as string), '/', lpad(cast(turn as string), 4, '0'), '_', role, '.md')",
        f"concat('# Conversation ', cast(conv_id as string), {NL}, '## ', role, ' ', cast(turn as string), {NL}, {NL}, text)",
    ),
    "part": (
        "part",
        "concat('parts/', p_brand, '/', cast(p_partkey as string), '.md')",
        "concat("
        f"'# ', p_name, {NL}, {NL}, 'Guide for the ', p_name, ' (', p_type, ').', {NL}, {NL}, "
        # the first section decides a document's topic type: some are tasks, some references
        f"CASE p_size % 5 WHEN 1 THEN concat('1. Open the ', p_name, ' box.', {NL}, '2. Press the button and run it.', {NL}, {NL}) "
        f"WHEN 2 THEN concat('| part | brand |', {NL}, '| --- | --- |', {NL}, '| ', p_name, ' | ', p_brand, ' |', {NL}, {NL}) ELSE '' END, "
        f"'## Steps', {NL}, {NL}, "
        f"CASE WHEN p_size % 3 = 0 THEN '' ELSE concat('1. Open the ', p_name, ' box.', {NL}, "
        f"'2. Press the ', p_brand, ' button.', {NL}, '3) Check size ', cast(p_size as string), '.', {NL}, {NL}) END, "
        f"'- keep the ', p_type, ' label', {NL}, {NL}, "
        f"'## Options', {NL}, {NL}, "
        f"'| type | size |', {NL}, '| --- | --- |', {NL}, "
        f"'| ', p_type, ' | ', cast(p_size as string), ' |', {NL}, {NL}, "
        f"CASE WHEN p_size % 2 = 0 THEN concat('Parameters: size ', cast(p_size as string), {NL}, {NL}) ELSE '' END, "
        f"CASE WHEN p_size % 7 = 0 THEN concat('#### Notes', {NL}, {NL}, 'See [spec](http://parts.example/', "
        f"cast(p_partkey as string), ') and ![', p_name, '](img/', cast(p_partkey as string), '.png).', {NL}) "
        f"ELSE concat('See [spec](http://parts.example/', cast(p_partkey as string), ').', {NL}) END"
        ")",
    ),
    "pages": (
        "pages",
        "concat('pages/', cast(page_id as string), '.html')",
        "html",
    ),
    "benchmark": (
        "benchmark",
        "concat('bench/', cast(item_id as string), '.txt')",
        "text",
    ),
}

# Guides with the block structure that the converters read, made of the parts' columns
GUIDE_SQL = {
    "md": (
        "concat('guides/', cast(p_partkey as string), '.md')",
        "concat("
        f"'---', {NL}, 'title: ', p_name, {NL}, '---', {NL}, '# ', p_name, {NL}, {NL}, 'The **', p_type, '** box has `', p_brand, '` & [a spec][s', "
        f"cast(p_size % 3 as string), '].', {NL}, {NL}, '```sh', {NL}, '# run ', p_name, {NL}, 'if x < ', cast(p_size as string), '; then', {NL}, '```', {NL}, "
        f"'- open *', p_type, '*', {NL}, '  1. lid', {NL}, '  2. ', p_brand, {NL}, '- close', {NL}, {NL}, '> note: ', p_name, {NL}, '> - keep', {NL}, {NL}, "
        f"'| part | size |', {NL}, '| --- | ---: |', {NL}, '| ', p_name, ' | ', cast(p_size as string), ' |', {NL}, '| a', chr(92), '|b |', {NL}, {NL}, "
        f"CASE WHEN p_size % 2 = 0 THEN concat('Underlined ', p_brand, {NL}, '---', {NL}, {NL}, 'end') ELSE concat('    indented ', cast(p_size as string)) END, "
        f"{NL}, {NL}, '[s0]: http://zero.example/', cast(p_partkey as string), {NL}, '[S1]: <http://one.example/?a=1&b=2> ', chr(34), 'x', chr(34), {NL})",
    ),
    # lists of 0 to 5 levels, links to its own and the next part's headings, images with and without a text
    "linked": (
        "concat('linked/', cast(p_partkey as string), '.md')",
        "concat("
        f"'# Part ', cast(p_partkey as string), {NL}, {NL}, '## Set up', {NL}, {NL}, '## Set up', {NL}, {NL}, "
        f"CASE WHEN p_size % 6 >= 1 THEN concat('- a', {NL}) ELSE '' END, CASE WHEN p_size % 6 >= 2 THEN concat('  - b', {NL}) ELSE '' END, "
        f"CASE WHEN p_size % 6 >= 3 THEN concat('    - c', {NL}) ELSE '' END, CASE WHEN p_size % 6 >= 4 THEN concat('      1. d', {NL}) ELSE '' END, "
        f"CASE WHEN p_size % 6 >= 5 THEN concat('         - e', {NL}, '- f', {NL}) ELSE '' END, {NL}, "
        f"CASE WHEN p_size % 2 = 0 THEN '![a text](x.png)' ELSE '![ ](x.png)' END, {NL}, {NL}, 'See [up](#set-up-1), [next](../linked/./', "
        f"cast(p_partkey + 1 as string), '.md#part-', cast(p_partkey + 1 as string), ') and [web](http://x.example/#y).', {NL}, {NL}, "
        f"CASE WHEN p_size % 7 = 0 THEN concat('[bad](#nowhere)', {NL}) ELSE '' END, "
        f"CASE WHEN p_size % 5 = 0 THEN concat('text <div>block</div>', {NL}) ELSE '' END)",
    ),
    "html": (
        "concat('guides/', cast(p_partkey as string), '.html')",
        "concat('<h2>', p_name, ' &mdash; caf&eacute;</h2><p>Size&nbsp;', cast(p_size as string), ' &#169; &#x2019; <b>', p_brand, "
        "'</b> <a class=x href=\"http://parts.example/?a=1&amp;b=', cast(p_partkey as string), '\">spec</a>', "
        "'<ul><li>one<ul><li>', p_type, '</ul><li>two</ul><table><tr><th>part<th>size<tr><td>', p_name, '<td>', cast(p_size as string), "
        f"'</table><pre>  run ', p_name, {NL}, {NL}, '  x &lt; 1</pre>')",
    ),
}


def guides(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """``(path, text)``: one structured guide per part, of one of the kinds of ``GUIDE_SQL``."""
    path_sql, text_sql = GUIDE_SQL[kind]
    return spread(read_table(spark, sf_dir, "part")).selectExpr(f"{path_sql} AS path", f"{text_sql} AS text")


ALL_CORPORA = ("documents", "conversations", "part", "pages", "benchmark")


_READS: dict = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet table of the folder; the DataFrame (not data) is reused per session."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _READS:
        _READS[key] = spark.read.parquet(path)
    return _READS[key]


SPREAD_BYTES = 256 << 20


def spread(df: DataFrame, factor: int = 2) -> DataFrame:
    """Spread a small input over the cluster's cores before CPU-heavy per-row work.

    Text work costs far more CPU per byte than the scan, so an input of a few row groups
    would leave cores idle, and a row group cannot be split on reading.  Only inputs of
    at most ``SPREAD_BYTES`` by the planner's statistics are dealt out; a larger one is
    never shuffled here, however many cores there are (set
    ``spark.sql.files.maxPartitionBytes`` for smaller splits).  Meant for one table: the
    splits of a union say nothing about those of each of its tables.
    """
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    if int(str(size)) > SPREAD_BYTES:
        return df
    target = df.sparkSession.sparkContext.defaultParallelism * factor
    return df.repartition(target) if df.rdd.getNumPartitions() < target else df


def corpus(spark: SparkSession, sf_dir: str, names=ALL_CORPORA) -> DataFrame:
    """``(path string, text string)`` for the named derived corpora, unioned.

    Each table is spread by itself: the union of all has many partitions, however few row
    groups one table lies in.  Its columns are dealt out, not the longer texts made of them.
    """
    out = None
    for name in names:
        table, path_sql, text_sql = CORPUS_SQL[name]
        df = spread(read_table(spark, sf_dir, table)).selectExpr(f"{path_sql} AS path", f"{text_sql} AS text")
        out = df if out is None else out.unionByName(df)
    return out


def corpus_sql(names=ALL_CORPORA) -> str:
    """The same corpus as one DuckDB ``SELECT`` (tables are views of the same parquet)."""
    parts = []
    for name in names:
        table, path_sql, text_sql = CORPUS_SQL[name]
        parts.append(f"SELECT {path_sql} AS path, {text_sql} AS text FROM {table}")
    return "\nUNION ALL\n".join(parts)


def docbook_sql_expr() -> tuple[str, str]:
    """DocBook-like intermediates from ``documents`` lines (exact input for topic operators).

    First line → ``<title>``; every further line → ``<para>``.  Text is taken raw
    (not escaped), as a converter's output would be read back.
    Returns (path expression, docbook expression) valid in Spark SQL; the DuckDB
    form is in the oracle module.
    """
    return (
        "concat('docs/', source, '/', cast(doc_id as string), '.md')",
        "concat('<article><title>', split_part(text, chr(10), 1), '</title>', "
        "array_join(transform(split(text, chr(10)), (l, i) -> CASE WHEN i = 0 THEN '' ELSE concat('<para>', l, '</para>') END), ''), "
        "'</article>')",
    )


def docbook_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(path, docbook, doc_id)`` built from the ``documents`` table."""
    path_sql, xml_sql = docbook_sql_expr()
    return spread(read_table(spark, sf_dir, "documents").selectExpr(f"{path_sql} AS path", f"{xml_sql} AS docbook", "doc_id"))
