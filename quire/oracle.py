"""DuckDB statements that recompute each registered query independently.

They are deliberately written another way than the Spark operators: Markdown
sections come from numbered lines and a running heading count, verb hits from
token equality, ladders from ``lag`` over section rows.  RE2 has no look-around,
so word boundaries become token comparisons.
"""

from __future__ import annotations

from .functions.regex import LINE_BREAK_CHARS, PY_SPACE_CHARS, WS, WS_INLINE, char_class
from .options import (
    REFERENCE_MARKERS,
    RISK_WEIGHTS,
    TARGET_SECTION_TOKENS,
    TASK_KEYWORDS,
    TASK_LANDMARKS,
    TOPICIZATION_WEIGHTS,
)
from .sources.tables import corpus_sql

ORACLE: dict[str, str] = {}

WORDS = r"[\p{L}\p{N}_]+"


def sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


WS_CHARS_SQL = sql_str(PY_SPACE_CHARS)


def strip(x: str) -> str:
    return f"trim({x}, {WS_CHARS_SQL})"


def untag(x: str) -> str:
    return f"regexp_replace({x}, '<[^>]+>', '', 'g')"


def count_re(x: str, pattern: str) -> str:
    return f"len(regexp_extract_all({x}, {sql_str(pattern)}))"


LB_CLASS = char_class(LINE_BREAK_CHARS)
FMT = (
    "CASE WHEN lower(path) LIKE '%.md' THEN 'md' "
    "WHEN lower(path) LIKE '%.html' OR lower(path) LIKE '%.htm' THEN 'html' ELSE 'generic' END"
)
HTML_HEADING = r"(?is)<h([1-6])(?:[^>]*)>(.*?)</h[1-6]>"

CORPUS = f"corpus AS (SELECT path, coalesce(text, '') AS text, {FMT} AS fmt FROM ({corpus_sql()}))"

# Markdown: numbered lines (str.splitlines), heading flag, running section number.
MD_SECTIONS = f"""
md_norm AS (
  SELECT path, regexp_replace(text, {sql_str(chr(13) + chr(10) + '|' + LB_CLASS)}, chr(10), 'g') AS t
  FROM corpus WHERE fmt = 'md'),
md_lines AS (
  SELECT path, CASE WHEN t = '' THEN []::VARCHAR[]
                    WHEN suffix(t, chr(10)) THEN string_split(t, chr(10))[1:-2]
                    ELSE string_split(t, chr(10)) END AS lines
  FROM md_norm),
md_u AS (
  SELECT path, unnest(lines) AS line, unnest(generate_series(1, len(lines))) AS ln FROM md_lines),
md_h AS (
  SELECT path, ln, line, regexp_matches(line, {sql_str('^#{1,6}' + WS_INLINE)}) AS is_head FROM md_u),
md_s AS (
  SELECT *, sum(is_head::INT) OVER (PARTITION BY path ORDER BY ln) AS sec FROM md_h),
md_g AS (
  SELECT path, sec,
    coalesce(max(CASE WHEN is_head THEN length(regexp_extract(line, '^(#{{1,6}})', 1)) END), 0) AS level,
    coalesce(max(CASE WHEN is_head THEN {strip("regexp_extract(line, " + sql_str('^#{1,6}' + WS_INLINE + '+(.*)$') + ", 1)")} END), 'Document') AS title,
    {strip("coalesce(string_agg(CASE WHEN is_head THEN NULL ELSE line END, chr(10) ORDER BY ln), '')")} AS content
  FROM md_s GROUP BY path, sec),
md_sections AS (
  SELECT path, (row_number() OVER (PARTITION BY path ORDER BY sec) - 1)::BIGINT AS section_index,
         level::BIGINT AS level, title, content
  FROM md_g)"""

HTML_SECTIONS = f"""
html_parts AS (
  SELECT path,
    regexp_extract_all(text, {sql_str(HTML_HEADING)}, 1) AS lv,
    regexp_extract_all(text, {sql_str(HTML_HEADING)}, 2) AS ti,
    regexp_split_to_array(text, {sql_str(HTML_HEADING)}) AS pc
  FROM corpus WHERE fmt = 'html'),
html_pre AS (
  SELECT path, 0 AS k, 0 AS level, 'Document' AS title, {strip(untag('pc[1]'))} AS content
  FROM html_parts WHERE {strip(untag('pc[1]'))} <> ''),
html_heads AS (
  SELECT path, k, CAST(lv[k] AS INT) AS level, {strip(untag('ti[k]'))} AS title, {strip(untag('pc[k + 1]'))} AS content
  FROM (SELECT *, unnest(generate_series(1, len(lv))) AS k FROM html_parts)),
html_sections AS (
  SELECT path, (row_number() OVER (PARTITION BY path ORDER BY k) - 1)::BIGINT AS section_index,
         level::BIGINT AS level, title, content
  FROM (SELECT * FROM html_pre UNION ALL SELECT * FROM html_heads))"""

GENERIC_SECTIONS = """
generic_sections AS (
  SELECT path, 0::BIGINT AS section_index, 0::BIGINT AS level, 'Document' AS title, text AS content
  FROM corpus WHERE fmt = 'generic')"""

ORDERED = "(?m)^" + WS + r"*\p{Nd}+[.)]" + WS + "+"
UNORDERED = "(?m)^" + WS + "*[-*+]" + WS + "+"
PIPE_ROW = "(?m)^" + WS + r"*\|.*\|" + WS + "*$"
IMAGE = r"!\[([^\]]*)\]\(([^)]+)\)"
LINK = r"\[([^\]]+)\]\(([^)]+)\)"


def _in_list(words) -> str:
    return "(" + ", ".join(sql_str(w.lower()) for w in words) + ")"


FEATURES = f"""
sec_all AS (
  SELECT * FROM md_sections UNION ALL SELECT * FROM html_sections),
feat AS (
  SELECT path, section_index, level, title, content,
    {count_re('content', WORDS)}::BIGINT AS tokens,
    {count_re('content', ORDERED)}::BIGINT AS ordered_lists,
    {count_re('content', UNORDERED)}::BIGINT AS unordered_lists,
    {count_re('content', PIPE_ROW)}::BIGINT AS tables,
    {count_re('content', IMAGE)}::BIGINT AS images,
    {count_re('content', LINK)}::BIGINT AS links,
    ({' OR '.join(f"contains(lower(title), {sql_str(k)})" for k in TASK_LANDMARKS)}) AS has_steps_title,
    len(list_filter(regexp_extract_all(content, {sql_str(WORDS)}), lambda x: lower(x) IN {_in_list(TASK_KEYWORDS)}))::BIGINT AS verb_hits,
    ({' + '.join(f"contains(lower(content), {sql_str(k)})::BIGINT" for k in REFERENCE_MARKERS)}) AS reference_markers
  FROM sec_all),
feat2 AS (
  SELECT *, verb_hits / greatest(tokens, 1) AS imperative_density,
    CASE WHEN ordered_lists > 0 AND (verb_hits / greatest(tokens, 1) > 0.005 OR has_steps_title) THEN 'task'
         WHEN tables > 0 OR reference_markers > 0 THEN 'reference' ELSE 'concept' END AS pred
  FROM feat)"""

TW, RW = TOPICIZATION_WEIGHTS, RISK_WEIGHTS
LO, HI = TARGET_SECTION_TOKENS
DOCS = f"""
ladder AS (
  SELECT path, bool_and(coalesce(greatest(level, 1) - greatest(prev, 1) <= 1, true)) AS ok
  FROM (SELECT path, level, lag(level) OVER (PARTITION BY path ORDER BY section_index) AS prev FROM feat2)
  GROUP BY path),
agg AS (
  SELECT path, count(*) AS n, sum(tokens) AS tok, bool_and(tables <= 1) AS simple, bool_or(tables > 1) AS complex,
         string_agg(pred, ',' ORDER BY section_index) AS preds
  FROM feat2 GROUP BY path),
metrics AS (
  SELECT c.path,
    coalesce(l.ok, true) AS heading_ladder_valid,
    (coalesce(a.tok, 0) // greatest(coalesce(a.n, 0), 1))::BIGINT AS avg_section_tokens,
    coalesce(a.simple, true) AS tables_simple,
    true AS lists_depth_ok, true AS images_with_alt, false AS deep_nesting,
    coalesce(a.complex, false) AS complex_tables,
    false AS unresolved_anchors, false AS mixed_inline_blocks,
    coalesce(a.n, 0)::BIGINT AS sections, coalesce(a.preds, '') AS pred_types
  FROM corpus c LEFT JOIN ladder l USING (path) LEFT JOIN agg a USING (path)
  WHERE c.fmt <> 'generic'),
scores AS (
  SELECT path,
    least(100, greatest(0,
      CASE WHEN heading_ladder_valid THEN {TW['heading_ladder_valid']} ELSE 0 END
      + CASE WHEN avg_section_tokens BETWEEN {LO} AND {HI} THEN {TW['avg_section_len_target']} ELSE 0 END
      + CASE WHEN tables_simple THEN {TW['tables_simple']} ELSE 0 END
      + CASE WHEN lists_depth_ok THEN {TW['lists_depth_ok']} ELSE 0 END
      + CASE WHEN images_with_alt THEN {TW['images_with_alt']} ELSE 0 END))::BIGINT AS topicization_readiness,
    least(100, greatest(0,
      CASE WHEN deep_nesting THEN {RW['deep_nesting']} ELSE 0 END
      + CASE WHEN complex_tables THEN {RW['complex_tables']} ELSE 0 END
      + CASE WHEN unresolved_anchors THEN {RW['unresolved_anchors']} ELSE 0 END
      + CASE WHEN mixed_inline_blocks THEN {RW['mixed_inline_blocks']} ELSE 0 END))::BIGINT AS conversion_risk,
    sections, pred_types, avg_section_tokens, heading_ladder_valid, complex_tables
  FROM metrics
  UNION ALL
  SELECT path, 50, 50, 1, '', NULL, NULL, NULL FROM corpus WHERE fmt = 'generic')"""

BASE = "WITH " + ",".join([CORPUS, MD_SECTIONS, HTML_SECTIONS, GENERIC_SECTIONS, FEATURES, DOCS])


def q(name: str, select: str) -> None:
    ORACLE[name] = BASE + "\n" + select


q("md_sections", "SELECT path, section_index, level, title, content FROM md_sections")
q("html_sections", "SELECT path, section_index, level, title, content FROM html_sections")
q(
    "section_rows",
    "SELECT s.path, c.fmt, s.section_index, s.level, s.title, s.content FROM "
    "(SELECT * FROM md_sections UNION ALL SELECT * FROM html_sections UNION ALL SELECT * FROM generic_sections) s "
    "JOIN corpus c USING (path)",
)
q("route_format", "SELECT path, fmt FROM corpus")
q(
    "assess_generic",
    "SELECT path, 1::BIGINT AS sections, 'Document' AS title, text AS content, 50::BIGINT AS topicization_readiness, "
    "50::BIGINT AS conversion_risk, 0::BIGINT AS n_predictions FROM corpus WHERE fmt = 'generic'",
)
q("token_count", f"SELECT path, {count_re('text', WORDS)}::BIGINT AS tokens FROM corpus")
q(
    "section_features",
    "SELECT path, section_index, tokens, ordered_lists, unordered_lists, tables, images, links, has_steps_title, "
    "imperative_density, reference_markers FROM feat2",
)
CONFIDENCE = "CASE pred WHEN 'task' THEN 0.85 WHEN 'reference' THEN 0.80 ELSE 0.60 END::DOUBLE"
REASONS = (
    "CASE pred WHEN 'task' THEN 'ordered list + imperative/steps' WHEN 'reference' THEN 'tables or reference markers' "
    "ELSE 'expository default' END"
)
q("imperative_density", "SELECT path, section_index, verb_hits, tokens, imperative_density FROM feat2")
q(
    "predict_topic",
    "SELECT path, section_index, title, pred, "
    "CASE pred WHEN 'task' THEN 0.85 WHEN 'reference' THEN 0.80 ELSE 0.60 END::DOUBLE AS confidence, "
    "CASE pred WHEN 'task' THEN 'ordered list + imperative/steps' WHEN 'reference' THEN 'tables or reference markers' "
    "ELSE 'expository default' END AS reasons FROM feat2",
)
q("heading_ladder", "SELECT path, heading_ladder_valid FROM metrics")
q(
    "doc_metrics",
    "SELECT path, heading_ladder_valid, avg_section_tokens, tables_simple, lists_depth_ok, images_with_alt, "
    "deep_nesting, complex_tables, unresolved_anchors, mixed_inline_blocks FROM metrics",
)
q("readiness_score", "SELECT path, topicization_readiness FROM scores")
q("risk_score", "SELECT path, conversion_risk FROM scores")
q(
    "inventory",
    "SELECT s.path, strlen(c.text)::BIGINT AS size, sha256(c.text) AS sha256, s.sections, s.topicization_readiness, "
    "s.conversion_risk, s.pred_types, coalesce(l.predictions, '') AS predictions, md5(coalesce(r.raw, '')) AS raw_sections_md5, s.avg_section_tokens, s.heading_ladder_valid, s.complex_tables "
    "FROM scores s JOIN corpus c USING (path) LEFT JOIN (SELECT path, string_agg(concat_ws('|', section_index, title, pred, "
    f"{CONFIDENCE}, {REASONS}), chr(10) ORDER BY section_index) AS predictions FROM feat2 GROUP BY path) l USING (path) "
    "LEFT JOIN (SELECT path, string_agg(title || chr(1) || content, chr(2) ORDER BY section_index) AS raw FROM ("
    "SELECT path, section_index, title, content FROM md_sections UNION ALL SELECT path, section_index, title, content FROM html_sections "
    "UNION ALL SELECT path, section_index, title, content FROM generic_sections) GROUP BY path) r USING (path)",
)
q("fingerprint", "SELECT path, strlen(text)::BIGINT AS size, sha256(text) AS sha256 FROM corpus")


# ---------------------------------------------------------------- near duplicates
from .operators.dedupe import PRIME, SENTINEL, permutation_params  # noqa: E402
from .options import DUPLICATE_THRESHOLD, MINHASH_NUM_PERM, SHINGLE_NGRAM, AssessOptions  # noqa: E402


def dedupe_ctes(
    tag: str, n: int, threshold: float, num_perm: int, seed: int, scope: str = "first_section", only: str = "TRUE"
) -> str:
    """Signatures, representatives, all-pairs edges (brute force) and the greedy walk."""
    params = "[" + ", ".join(f"{{'a': {a}, 'b': {b}}}" for a, b in permutation_params(num_perm, seed)) + "]"
    if scope == "document":
        items = f"{tag}_items AS (SELECT path AS key, text FROM corpus WHERE {only}),"
    else:
        items = f"""{tag}_items AS (
  SELECT c.path AS key, coalesce(s.content, CASE WHEN c.fmt = 'generic' THEN c.text END, '') AS text
  FROM corpus c LEFT JOIN (SELECT path, content FROM md_sections WHERE section_index = 0
                           UNION ALL SELECT path, content FROM html_sections WHERE section_index = 0) s USING (path)),"""
    return f"""
{items}
{tag}_tok AS (
  SELECT key, list_transform(regexp_extract_all(text, {sql_str(WORDS)}), lambda x: lower(x)) AS tk FROM {tag}_items),
{tag}_sh AS (
  SELECT key, CASE WHEN len(tk) >= {n}
    THEN list_transform(generate_series(1, len(tk) - {n} + 1), lambda i: array_to_string(tk[i:i + {n - 1}], ' '))
    ELSE []::VARCHAR[] END AS sh FROM {tag}_tok),
{tag}_hs AS (
  SELECT key, sh, list_transform(list_distinct(sh), lambda s: ('0x' || substr(md5(s), 1, 8))::BIGINT % {PRIME}) AS hs
  FROM {tag}_sh),
{tag}_sig AS (
  SELECT key, sh, list_transform({params},
    lambda ab: coalesce(list_min(list_transform(hs, lambda h: (h * ab.a + ab.b) % {PRIME})), {SENTINEL}::BIGINT)) AS sig
  FROM {tag}_hs),
{tag}_reps AS (SELECT sig, min(key) AS rep FROM {tag}_sig GROUP BY sig),
{tag}_pairs AS (
  SELECT x.rep AS a, y.rep AS b,
    len(list_filter(generate_series(1, len(x.sig)), lambda i: x.sig[i] = y.sig[i])) / len(x.sig) AS similarity
  FROM {tag}_reps x JOIN {tag}_reps y ON x.rep < y.rep),
{tag}_edges AS (SELECT * FROM {tag}_pairs WHERE similarity >= {threshold!r}),
{tag}_nodes AS (
  SELECT rep, row_number() OVER (ORDER BY rep) AS rn
  FROM (SELECT a AS rep FROM {tag}_edges UNION SELECT b FROM {tag}_edges)),
{tag}_smaller AS (SELECT b AS rep, list(a) AS sm FROM {tag}_edges GROUP BY b),
{tag}_walk(i, leaders) AS (
  SELECT 0, []::VARCHAR[]
  UNION ALL
  SELECT w.i + 1, CASE WHEN list_has_any(w.leaders, coalesce(s.sm, []::VARCHAR[])) THEN w.leaders
                       ELSE list_append(w.leaders, n.rep) END
  FROM {tag}_walk w JOIN {tag}_nodes n ON n.rn = w.i + 1 LEFT JOIN {tag}_smaller s ON s.rep = n.rep),
{tag}_leaders AS (SELECT unnest(leaders) AS leader FROM {tag}_walk WHERE i = (SELECT max(i) FROM {tag}_walk)),
{tag}_rep_leader AS (
  SELECT r.rep, coalesce(m.leader, r.rep) AS leader, coalesce(m.similarity, 1.0) AS similarity
  FROM {tag}_reps r LEFT JOIN (
    SELECT b AS rep, min(a) AS leader, arg_min(similarity, a) AS similarity
    FROM {tag}_edges JOIN {tag}_leaders ON a = leader GROUP BY b) m USING (rep)),
{tag}_key_leader AS (
  SELECT s.key, rl.leader, rl.similarity FROM {tag}_sig s JOIN {tag}_reps r USING (sig) JOIN {tag}_rep_leader rl USING (rep))"""


_D = AssessOptions()
DEDUPE = dedupe_ctes("dd", SHINGLE_NGRAM, DUPLICATE_THRESHOLD, MINHASH_NUM_PERM, _D.minhash_seed)
DEDUPE_LOOSE = dedupe_ctes("dl", 3, 0.7, MINHASH_NUM_PERM, _D.minhash_seed)
BASE_DD = BASE + "," + DEDUPE


DEDUPE_DOC = dedupe_ctes("dw", SHINGLE_NGRAM, DUPLICATE_THRESHOLD, MINHASH_NUM_PERM, _D.minhash_seed, scope="document")


def qd(name: str, select: str, loose: bool = False, extra: str = "") -> None:
    ORACLE[name] = (
        "WITH RECURSIVE" + BASE_DD[len("WITH"):] + ("," + DEDUPE_LOOSE if loose else "") + extra + "\n" + select
    )


qd(
    "shingles",
    "SELECT key, len(sh)::BIGINT AS n_shingles, len(list_distinct(sh))::BIGINT AS n_distinct, "
    "md5(array_to_string(sh, '|')) AS digest FROM dd_sh",
)
qd("minhash_signature", "SELECT key, array_to_string(sig, ',') AS sig FROM dd_sig")
qd(
    "signature_similarity",
    "SELECT x.key AS a, y.key AS b, "
    "len(list_filter(generate_series(1, len(x.sig)), lambda i: x.sig[i] = y.sig[i])) / len(x.sig) AS similarity "
    "FROM documents d1 JOIN documents d2 ON d2.doc_id = d1.doc_id + 1 "
    "JOIN dd_sig x ON x.key = concat('docs/', d1.source, '/', CAST(d1.doc_id AS VARCHAR), '.md') "
    "JOIN dd_sig y ON y.key = concat('docs/', d2.source, '/', CAST(d2.doc_id AS VARCHAR), '.md')",
)
qd("near_dup_clusters", "SELECT key, leader FROM dd_key_leader")
qd("near_dup_clusters_loose", "SELECT key, leader FROM dl_key_leader", loose=True)
qd("near_dup_clusters_document", "SELECT key, leader FROM dw_key_leader", extra="," + DEDUPE_DOC)
DEDUPE_TEMPLATED = dedupe_ctes("dt", 3, 0.7, MINHASH_NUM_PERM, _D.minhash_seed, scope="document", only="path LIKE 'parts/%'")
qd("near_dup_clusters_templated", "SELECT key, leader FROM dt_key_leader", extra="," + DEDUPE_TEMPLATED)
qd("near_dup_pairs", "SELECT leader AS a, key AS b, similarity FROM dd_key_leader WHERE key <> leader")
qd("clusters", "SELECT leader, count(*)::BIGINT AS size FROM dd_key_leader GROUP BY leader")
qd(
    "cluster_members",
    "SELECT leader, (row_number() OVER (PARTITION BY leader ORDER BY key) - 1)::BIGINT AS position, key FROM dl_key_leader",
    loose=True,
)
qd(
    "report_duplicates",
    "SELECT leader, count(*)::BIGINT AS size FROM dd_key_leader GROUP BY leader HAVING count(*) > 1",
)


# ---------------------------------------------------------------- conversion side
from .options import MAP_FOOTER, MAP_HEADER, TOPIC_TEMPLATES, UNTITLED  # noqa: E402
from .plans.report import REPORT_HEAD, REPORT_MIDDLE, REPORT_NO_DUPLICATES, REPORT_TABLE_OPEN, REPORT_TAIL  # noqa: E402


def xml_esc(x: str) -> str:
    return f"replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


def html_esc(x: str) -> str:
    return f"replace(replace({xml_esc(x)}, '\"', '&quot;'), '''', '&#x27;')"


def unesc(x: str) -> str:
    for name, char in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("#39", "'"), ("copy", "©"), ("middot", "·"), ("amp", "&")):
        x = f"replace({x}, '&{name};', {sql_str(char)})"
    return x


def base_name(p: str) -> str:
    return f"regexp_extract({p}, '[^/]*$')"


def _dot(name: str) -> str:
    # 1-based position of the last '.', 0 when there is none
    return f"(CASE WHEN strpos({name}, '.') = 0 THEN 0 ELSE length({name}) - strpos(reverse({name}), '.') + 1 END)"


def suffix_of(p: str) -> str:
    n = base_name(p)
    d = _dot(n)
    return f"(CASE WHEN {d} > 1 AND {d} < length({n}) THEN substr({n}, {d}) ELSE '' END)"


def stem_of(p: str) -> str:
    n = base_name(p)
    d = _dot(n)
    return f"(CASE WHEN {d} > 1 AND {d} < length({n}) THEN substr({n}, 1, {d} - 1) ELSE {n} END)"


# Patterns and word lists that must equal the operators'
TITLE_PAT = "(?i)<title>(.*?)</title>"
PARA_PAT = "(?is)<para>(.*?)</para>"


def title_of(db: str) -> str:
    return (f"(CASE WHEN regexp_matches({db}, {sql_str(TITLE_PAT)}) THEN regexp_extract({db}, {sql_str(TITLE_PAT)}, 1) "
            f"ELSE {sql_str(UNTITLED)} END)")


def body_of(db: str) -> str:
    paras = f"regexp_extract_all({db}, {sql_str(PARA_PAT)}, 1)"
    fallback = f"'<p>' || {xml_esc(untag(db))} || '</p>'"
    return (f"(CASE WHEN len({paras}) > 0 THEN array_to_string(list_transform({paras}, "
            f"lambda p: '<p>' || {strip('p')} || '</p>'), '') ELSE {fallback} END)")


def topic_xml(title: str, body: str, ttype: str) -> str:
    whens = " ".join(
        f"WHEN {sql_str(k)} THEN {sql_str(o.format(id='t1'))} || {xml_esc(title)} || {sql_str(m)} || {body} || {sql_str(c)}"
        for k, (o, m, c) in TOPIC_TEMPLATES.items()
    )
    return f"(CASE {ttype} {whens} END)"


def type_error(ttype: str) -> str:
    known = ", ".join(sorted(TOPIC_TEMPLATES))
    types = ", ".join(sql_str(k) for k in TOPIC_TEMPLATES)
    tail = sql_str("'. Expected one of: " + known)
    return (f"(CASE WHEN {ttype} IN ({types}) THEN NULL "
            f"ELSE 'Unknown topic_type ''' || coalesce({ttype}, 'None') || {tail} END)")


def toks_lower(x: str) -> str:
    return f"list_transform(regexp_extract_all({x}, {sql_str(WORDS)}), lambda t: lower(t))"


NOT_W = r"[^\p{L}\p{N}_]"
# Fixed values
TASK_WORDS = ["step", "click", "select", "open", "run", "press", "type"]
REF_WORDS = ["parameters", "syntax", "options", "defaults"]


def classify_sql(stem: str, db: str, plan: str | None, ruled: bool) -> str:
    toks = toks_lower(db)
    parts = []
    if ruled:
        parts += [
            f"WHEN regexp_full_match({stem}, '2.') THEN 'task'",
            f"WHEN regexp_full_match({stem}, '[13].*5') THEN 'reference'",
            f"WHEN regexp_full_match({stem}, '4[^0-4]') THEN 'concept'",
            f"WHEN list_contains({toks}, 'nicht') THEN 'reference'",
            f"WHEN regexp_matches(lower({db}), 'end[\\[&.]') THEN 'reference'",
            f"WHEN contains(lower({db}), 'parameters:') THEN 'reference'",
            f"WHEN contains(lower({db}), 'procedure') THEN 'task'",
        ]
    if plan is not None:
        hint = strip(f"lower({plan})")
        parts.append(f"WHEN {plan} IS NOT NULL AND {hint} IN ('concept', 'task', 'reference') THEN {hint}")
    parts.append(f"WHEN list_has_any({toks}, {TASK_WORDS!r}) THEN 'task'")
    parts.append(
        f"WHEN list_has_any({toks}, {REF_WORDS!r}) OR regexp_matches(lower({db}), "
        f"{sql_str('(^|' + NOT_W + ')table of(' + NOT_W + '|$)')}) THEN 'reference'"
    )
    return "(CASE " + " ".join(parts) + " ELSE 'concept' END)"


def comps(p: str) -> str:
    return f"list_filter(string_split({p}, '/'), lambda x: x <> '' AND x <> '.')"


def rel_path(t: str, b: str) -> str:
    tc, bc = comps(t), comps(b)
    n = f"least(len({tc}), len({bc}))"
    common = (f"coalesce(list_position(list_transform(generate_series(1, {n}), lambda i: ({tc})[i] = ({bc})[i]), false) - 1, {n})")
    return f"(repeat('../', len({bc}) - {common}) || array_to_string(({tc})[{common} + 1:], '/'))"


def topicref_sql(t: str, b: str) -> str:
    return f"('  <topicref href=\"' || {rel_path(t, b)} || '\" />')"


BLOCK_BREAK_PAT = "\\n(?:" + WS_INLINE + "*\\n)+"


def paras_sql(content: str) -> str:
    blocks = f"list_filter(list_transform(regexp_split_to_array(coalesce({content}, ''), {sql_str(BLOCK_BREAK_PAT)}), lambda b: {strip('b')}), lambda b: b <> '')"
    return f"array_to_string(list_transform({blocks}, lambda b: '<para>' || {xml_esc('b')} || '</para>'), '')"


BRACKETS = r"\[([^\[\]]*)\]\(([^()\s]*)\)"
IMAGE_XML = r'<inlinemediaobject><imageobject><imagedata fileref="\2"/></imageobject><textobject><phrase>\1</phrase></textobject></inlinemediaobject>'
LINK_XML = r'<ulink url="\2">\1</ulink>'


def inline_sql(x: str) -> str:
    """Escaped text with its inline images and links (the corpora hold no other inline markup)."""
    images = f"regexp_replace({xml_esc(x)}, {sql_str('!' + BRACKETS)}, {sql_str(IMAGE_XML)}, 'g')"
    return f"regexp_replace({images}, {sql_str(BRACKETS)}, {sql_str(LINK_XML)}, 'g')"


def item_sql(line: str) -> str:
    text = strip(f"regexp_replace({line}, '^ {{0,3}}([-*+]|[0-9]+[.)])[ \\t]+', '')")
    return f"'<listitem><para>' || {inline_sql(text)} || '</para></listitem>'"


def cells_sql(row: str) -> str:
    inner = f"regexp_replace(regexp_replace(trim({row}), '^[|]', ''), '[|]$', '')"
    entries = f"list_transform(string_split({inner}, '|'), lambda c: '<entry>' || {inline_sql('trim(c)')} || '</entry>')"
    return f"('<row>' || array_to_string({entries}, '') || '</row>')"


HEADING_TEXT = strip("regexp_extract(txt, '^ {0,3}#{1,6}(.*)$', 1)")
# The Markdown corpora hold flat lists, pipe tables, headings and paragraphs: lines of one kind side by side make a block.
MD_BLOCKS = f"""
md_k AS (
  SELECT path, ln, line, CASE
    WHEN regexp_matches(line, '^ {{0,3}}#{{1,6}}([ \t]|$)') THEN 'h' WHEN trim(line, ' ' || chr(9)) = '' THEN 'b'
    WHEN regexp_matches(line, '^ {{0,3}}[-*+][ \t]') THEN 'u' WHEN regexp_matches(line, '^ {{0,3}}[0-9]{{1,9}}[.][ \t]') THEN 'o.'
    WHEN regexp_matches(line, '^ {{0,3}}[0-9]{{1,9}}[)][ \t]') THEN 'o)' WHEN line LIKE '|%' THEN 't' ELSE 'p' END AS kind
  FROM md_u),
md_n AS (
  SELECT *, sum(CASE WHEN kind = 'h' OR kind IS DISTINCT FROM prev THEN 1 ELSE 0 END) OVER (PARTITION BY path ORDER BY ln) AS grp
  FROM (SELECT *, lag(kind) OVER (PARTITION BY path ORDER BY ln) AS prev FROM md_k)),
md_blk AS (
  SELECT path, grp, kind, string_agg(line, chr(10) ORDER BY ln) AS txt, list(line ORDER BY ln) AS ls
  FROM md_n WHERE kind <> 'b' GROUP BY path, grp, kind),
md_xml AS (
  SELECT path, grp, kind, count(*) FILTER (WHERE kind = 'h') OVER (PARTITION BY path ORDER BY grp) AS heads, CASE
    WHEN kind = 'h' THEN '<section><title>' || {inline_sql(HEADING_TEXT)} || '</title>'
    WHEN kind = 'u' THEN '<itemizedlist>' || array_to_string(list_transform(ls, lambda l: {item_sql('l')}), '') || '</itemizedlist>'
    WHEN kind IN ('o.', 'o)') THEN '<orderedlist' || CASE WHEN regexp_extract(txt, '^ {{0,3}}([0-9]+)', 1) = '1' THEN ''
      ELSE ' startingnumber="' || regexp_extract(txt, '^ {{0,3}}([0-9]+)', 1) || '"' END || '>'
      || array_to_string(list_transform(ls, lambda l: {item_sql('l')}), '') || '</orderedlist>'
    WHEN kind = 't' THEN '<table><tgroup cols="' || CAST(len(string_split(trim(ls[1], '|'), '|')) AS VARCHAR) || '"><thead>' || {cells_sql('ls[1]')}
      || '</thead><tbody>' || array_to_string(list_transform(ls[3:], lambda r: {cells_sql('r')}), '') || '</tbody></tgroup></table>'
    WHEN {strip('txt')} = '' THEN '' ELSE '<para>' || {inline_sql(strip('txt'))} || '</para>' END AS xml
  FROM md_blk)"""


# Parts of a page that are no text, and tags that end a paragraph
NO_TEXT_PAT = r"(?is)<!--.*?-->|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>"
PARAGRAPH_TAGS = (
    "address article aside blockquote body br caption dd div dl dt figure footer form head header hr html li main nav "
    "ol p pre section table tbody td tfoot th thead title tr ul"
).split()


def block_lines(raw: str) -> str:
    pattern = "(?is)</?(" + "|".join(PARAGRAPH_TAGS) + r")\b[^>]*>"
    return f"regexp_replace({raw}, {sql_str(pattern)}, chr(10) || chr(10), 'g')"


DOCBOOK_DOCS = (
    "docbook_docs AS (SELECT concat('docs/', source, '/', CAST(doc_id AS VARCHAR), '.md') AS path, doc_id, "
    "'<article><title>' || split_part(text, chr(10), 1) || '</title>' || "
    "array_to_string(list_transform((string_split(text, chr(10)))[2:], lambda l: '<para>' || l || '</para>'), '') "
    "|| '</article>' AS docbook FROM documents)"
)

# the pages have one list, of links
NAV = '<li><a href="([^"]*)">([^<]*)</a></li>'

CONVERT = f"""
{DOCBOOK_DOCS},{MD_BLOCKS},
md_inter AS (
  SELECT c.path, '<article>' || coalesce(string_agg(CASE WHEN x.kind = 'h' AND x.heads > 1 THEN '</section>' ELSE '' END || x.xml, '' ORDER BY x.grp), '')
    || CASE WHEN max(x.heads) > 0 THEN '</section>' ELSE '' END || '</article>' AS docbook
  FROM corpus c LEFT JOIN md_xml x USING (path) WHERE c.fmt = 'md' GROUP BY c.path),
hx_parts AS (
  SELECT path,
    regexp_extract_all(t, {sql_str(HTML_HEADING)}, 1) AS lv,
    regexp_extract_all(t, {sql_str(HTML_HEADING)}, 2) AS ti,
    regexp_split_to_array(t, {sql_str(HTML_HEADING)}) AS pc
  FROM (SELECT path, regexp_replace(text, {sql_str(NO_TEXT_PAT)}, '', 'g') AS t FROM corpus WHERE fmt = 'html')),
hx AS (
  SELECT path, 0 AS k, 0 AS level, '' AS title, pc[1] AS raw FROM hx_parts WHERE {strip(untag('pc[1]'))} <> ''
  UNION ALL
  SELECT path, k, CAST(lv[k] AS INT), {strip(untag('ti[k]'))}, pc[k + 1]
  FROM (SELECT *, unnest(generate_series(1, len(lv))) AS k FROM hx_parts)),
hx_list AS (
  SELECT path, k, level, title, split_part(r, '<ul>', 1) AS before, CASE WHEN contains(r, '<ul>') THEN split_part(split_part(r, '<ul>', 2), '</ul>', 1) END AS items,
    CASE WHEN contains(r, '<ul>') THEN split_part(r, '</ul>', 2) ELSE '' END AS after
  FROM (SELECT *, regexp_replace(raw, '\\n\\s*\\n', chr(10), 'g') AS r FROM hx)),
html_inter AS (
  SELECT c.path, '<article>' || coalesce(string_agg(
    CASE WHEN s.level > 0 THEN '<section><title>' || {xml_esc(strip(unesc('s.title')))} || '</title>' ELSE '' END
    || {paras_sql(unesc(untag(block_lines('s.before'))))}
    || CASE WHEN s.items IS NULL THEN '' ELSE '<itemizedlist>' || array_to_string(list_transform(generate_series(1, len(regexp_extract_all(s.items, {sql_str(NAV)}))),
      lambda i: '<listitem><para><ulink url="' || {xml_esc(unesc("regexp_extract_all(s.items, " + sql_str(NAV) + ", 1)[i]"))} || '">'
      || {xml_esc(unesc("regexp_extract_all(s.items, " + sql_str(NAV) + ", 2)[i]"))} || '</ulink></para></listitem>'), '') || '</itemizedlist>' END
    || {paras_sql(unesc(untag(block_lines('s.after'))))}
    || CASE WHEN s.level > 0 THEN '</section>' ELSE '' END, '' ORDER BY s.k), '') || '</article>' AS docbook
  FROM corpus c LEFT JOIN hx_list s USING (path) WHERE c.fmt = 'html' GROUP BY c.path),
routed AS (
  SELECT path, lower({suffix_of('path')}) AS ext,
    CASE lower({suffix_of('path')}) WHEN '.md' THEN 'pandoc-md' WHEN '.html' THEN 'pandoc-html'
      WHEN '.htm' THEN 'pandoc-html' WHEN '.docx' THEN 'pandoc-docx' END AS handler
  FROM corpus),
extracted AS (
  SELECT r.path, r.handler, coalesce(m.docbook, h.docbook) AS docbook,
    CASE WHEN r.handler IS NULL THEN 'No extractor registered for extension: ''' || r.ext || ''''
         WHEN r.handler NOT IN ('pandoc-md', 'pandoc-html') THEN 'Handler ''' || r.handler || ''' converts binary documents, which this engine does not read'
    END AS error
  FROM routed r LEFT JOIN md_inter m ON m.path = r.path AND r.handler = 'pandoc-md'
                LEFT JOIN html_inter h ON h.path = r.path AND r.handler = 'pandoc-html'),
plans AS (
  SELECT c.path AS source, {base_name('c.path')} AS basename,
    coalesce(f.pred, 'concept') AS default_topic_type, s.conversion_risk AS risk, s.topicization_readiness AS readiness,
    s.pred_types AS section_types,
    to_json({{'source': c.path, 'chunking': {{'level': 1, 'nested_topics': true}}, 'default_topic_type': coalesce(f.pred, 'concept'),
      'sections': coalesce(l.sections, []), 'risk': s.conversion_risk, 'readiness': s.topicization_readiness}})::VARCHAR AS json
  FROM corpus c LEFT JOIN (
    SELECT path, list({{'index': section_index, 'title': title, 'pred': pred, 'confidence': {CONFIDENCE}, 'reasons': [{REASONS}]}}
      ORDER BY section_index) AS sections FROM feat2 GROUP BY path) l USING (path) JOIN scores s USING (path) LEFT JOIN (SELECT path, pred FROM feat2 WHERE section_index = 0) f USING (path)),
e2e_topics AS (
  SELECT x.path, t.topic_type, 'dita/topics/' || {stem_of('x.path')} || '_' || t.topic_type || '.dita' AS topic_path,
    {topic_xml(title_of('x.docbook'), body_of('x.docbook'), 't.topic_type')} AS xml
  FROM extracted x JOIN (
    SELECT e.path, {classify_sql(stem_of('e.path'), 'e.docbook', 'p.default_topic_type', False)} AS topic_type
    FROM extracted e LEFT JOIN plans p ON p.source = e.path WHERE e.error IS NULL) t USING (path)
  WHERE x.error IS NULL),
ruled_all AS (
  SELECT d.path, 'dita/topics/' || {stem_of('d.path')} || '_' || {classify_sql(stem_of('d.path'), 'd.docbook', 'p.default_topic_type', True)} || '.dita' AS topic_path
  FROM docbook_docs d LEFT JOIN plans p ON p.source = d.path),
ruled_topics AS (
  SELECT d.path, t.topic_type,
    CASE WHEN d.doc_id % 97 <> 0 THEN 'dita/topics/' || {stem_of('d.path')} || '_' || t.topic_type || '.dita' END AS topic_path,
    CASE WHEN d.doc_id % 97 <> 0 THEN {topic_xml(title_of('d.docbook'), body_of('d.docbook'), 't.topic_type')} END AS xml,
    CASE WHEN d.doc_id % 97 = 0 THEN 'No intermediate document for ' || d.path END AS error
  FROM docbook_docs d JOIN (
    SELECT d2.path, CASE WHEN d2.doc_id % 97 <> 0 THEN {classify_sql(stem_of('d2.path'), 'd2.docbook', 'p.default_topic_type', True)} END AS topic_type
    FROM docbook_docs d2 LEFT JOIN plans p ON p.source = d2.path) t USING (path))"""


def map_sql(topics: str, title: str) -> str:
    esc = title.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")
    return f"""
SELECT 0::BIGINT AS part, '' AS k1, 0::BIGINT AS k2, '' AS k3, {sql_str(MAP_HEADER.format(title=esc))} AS fragment
UNION ALL
SELECT 1, topic_path, 0, '', {topicref_sql('topic_path', "'dita'")} || chr(10) FROM {topics}
UNION ALL
SELECT 2, '', 0, '', CASE WHEN count(*) > 0 THEN {sql_str(MAP_FOOTER[1:])} ELSE {sql_str(MAP_FOOTER)} END FROM {topics}"""


BASE_CV = BASE_DD + "," + CONVERT


def qc(name: str, select: str) -> None:
    ORACLE[name] = "WITH RECURSIVE" + BASE_CV[len("WITH"):] + "\n" + select


qc(
    "path_parts",
    "SELECT path, " + base_name("path") + " AS basename, " + stem_of("path") + " AS stem, " + suffix_of("path") + " AS suffix FROM ("
    "SELECT path FROM corpus UNION ALL "
    "SELECT concat('docs/', source, '/.', CAST(doc_id AS VARCHAR)) FROM documents UNION ALL "
    "SELECT concat('docs/', source, '/', CAST(doc_id AS VARCHAR), '.tar.gz') FROM documents)",
)
qc(
    "route_handler",
    "SELECT path, ext, CASE ext WHEN '.md' THEN 'pandoc-md' WHEN '.html' THEN 'pandoc-html' WHEN '.htm' THEN 'pandoc-html' "
    "WHEN '.docx' THEN 'pandoc-docx' END AS handler, "
    "CASE WHEN ext NOT IN ('.md', '.html', '.htm', '.docx') THEN 'No extractor registered for extension: ''' || ext || '''' END AS error "
    "FROM (SELECT path, lower(" + suffix_of("path") + ") AS ext FROM (SELECT concat('in/', source, '/', CAST(doc_id AS VARCHAR), "
    "CASE doc_id % 6 WHEN 0 THEN '.md' WHEN 1 THEN '.HTML' WHEN 2 THEN '.htm' WHEN 3 THEN '.docx' WHEN 4 THEN '.xyz' ELSE '' END) AS path "
    "FROM documents))",
)
qc("docbook_title", f"SELECT path, {title_of('docbook')} AS title FROM docbook_docs")
qc("docbook_body", f"SELECT path, {body_of('docbook')} AS body FROM docbook_docs")
qc(
    "build_topic",
    "SELECT path, topic_type, " + topic_xml(title_of("docbook"), body_of("docbook"), "topic_type") + " AS xml, "
    + type_error("topic_type") + " AS error FROM (SELECT *, CASE WHEN doc_id % 50 = 0 THEN 'bogus' "
    "ELSE ['concept', 'task', 'reference'][doc_id % 3 + 1] END AS topic_type FROM docbook_docs)",
)
qc(
    "classify_topic",
    "SELECT path, " + classify_sql(stem_of("path"), "docbook", "plan_type", True) + " AS topic_type FROM "
    "(SELECT *, CASE doc_id % 3 WHEN 0 THEN ' Task ' WHEN 1 THEN 'bogus' END AS plan_type FROM docbook_docs)",
)
qc(
    "topicref",
    "SELECT topic_path, map_dir, " + topicref_sql("topic_path", "map_dir") + " AS ref FROM ("
    "SELECT 'dita/topics/' || CAST(doc_id AS VARCHAR) || '_concept.dita' AS topic_path, "
    "CASE WHEN doc_id % 5 = 0 THEN 'out/maps' WHEN doc_id % 2 = 0 THEN 'dita' ELSE 'dita/topics' END AS map_dir FROM documents)",
)
qc(
    "conversion_plan",
    "SELECT source, basename || '.conversion_plan.json' AS plan_file, default_topic_type, 1::BIGINT AS chunk_level, "
    "true AS nested_topics, risk, readiness, section_types, json FROM plans",
)
qc("plan_collisions", "SELECT basename, count(*)::BIGINT AS n FROM plans GROUP BY basename HAVING count(*) > 1")
qc("plan_join", "SELECT d.path, p.default_topic_type AS plan_type FROM docbook_docs d LEFT JOIN plans p ON p.source = d.path")
qc(
    "plan_join_basename",
    "SELECT d.path, p.plan_type FROM docbook_docs d LEFT JOIN (SELECT basename, arg_max(default_topic_type, source) AS plan_type "
    "FROM plans GROUP BY basename) p ON p.basename = " + base_name("d.path"),
)
qc("md_to_intermediate", "SELECT path, docbook FROM md_inter")
qc("html_to_intermediate", "SELECT path, docbook FROM html_inter")
qc("extract_stage", "SELECT path, handler, md5(docbook) AS docbook_md5, error FROM extracted")
qc("transform_stage", "SELECT path, topic_type, topic_path, xml, error FROM ruled_topics")
qc(
    "assess_stage",
    "SELECT p.source AS path, p.default_topic_type, p.risk AS conversion_risk, p.readiness AS topicization_readiness, k.leader "
    "FROM plans p JOIN dd_key_leader k ON k.key = p.source",
)
qc(
    "end_to_end",
    "SELECT x.path, t.topic_type, t.topic_path, md5(t.xml) AS xml_md5, x.error AS extract_error "
    "FROM extracted x LEFT JOIN e2e_topics t USING (path)",
)
qc("topics", "SELECT path, topic_path, topic_type, xml FROM e2e_topics")
qc(
    "extract_user_converter",
    "SELECT x.path, CASE WHEN r.ext = '.txt' THEN 'text-lines' ELSE x.handler END AS handler, "
    "md5(CASE WHEN r.ext = '.txt' THEN '<article>' || array_to_string(list_transform(list_filter(string_split(c.text, chr(10)), "
    "lambda l: l <> ''), lambda l: '<para>' || " + xml_esc("l") + " || '</para>'), '') || '</article>' ELSE x.docbook END) AS docbook_md5, "
    "CASE WHEN r.ext = '.txt' THEN NULL ELSE x.error END AS error "
    "FROM extracted x JOIN routed r USING (path) JOIN corpus c USING (path)",
)
qc("transform_bucketed", "SELECT path, topic_type, topic_path, xml, error FROM ruled_topics")
LONG_WORD = "regexp_matches(c.text, '[A-Za-z]{14}')"
qc(
    "extract_failing_converter",
    "SELECT x.path, CASE WHEN r.ext = '.txt' THEN 'python-lines' ELSE x.handler END AS handler, "
    f"md5(CASE WHEN r.ext = '.txt' THEN CASE WHEN NOT {LONG_WORD} THEN '<article>' || array_to_string(list_transform(list_filter(string_split(c.text, chr(10)), "
    "lambda l: l <> ''), lambda l: '<para>' || " + xml_esc("l") + " || '</para>'), '') || '</article>' END ELSE x.docbook END) AS docbook_md5, "
    f"CASE WHEN r.ext = '.txt' THEN CASE WHEN {LONG_WORD} THEN 'a word is too long' END ELSE x.error END AS error "
    "FROM extracted x JOIN routed r USING (path) JOIN corpus c USING (path)",
)
_PY = toks_lower("docbook")
qc(
    "classify_python_rule",
    f"SELECT path, CASE WHEN regexp_matches(docbook, '\\p{{Nd}}7') OR list_contains({_PY}, 'que') THEN 'reference' "
    "WHEN contains(lower(docbook), 'procedure') THEN 'task' "
    f"ELSE {classify_sql('path', 'docbook', None, False)} END AS topic_type FROM docbook_docs",
)
qc("topic_type_counts", "SELECT topic_type, count(*)::BIGINT AS n FROM e2e_topics GROUP BY topic_type")
qc("topic_map", map_sql("e2e_topics", "Documentation Set"))
qc("topic_count", "SELECT count(*)::BIGINT AS topic_count FROM e2e_topics")
qc("load_stage", map_sql("ruled_all", "Docs & Notes"))
qc("errors_split", "SELECT 'extract' AS stage, path, error FROM extracted WHERE error IS NOT NULL")
qc(
    "run_summary",
    "SELECT 'files_found' AS metric, count(*)::BIGINT AS value FROM corpus "
    "UNION ALL SELECT 'extract_ok', count(*) FILTER (WHERE error IS NULL) FROM extracted "
    "UNION ALL SELECT 'extract_failed', count(*) FILTER (WHERE error IS NOT NULL) FROM extracted "
    "UNION ALL SELECT 'topics', count(*) FROM e2e_topics "
    "UNION ALL SELECT 'transform_failed', 0",
)
qc(
    "report_summary",
    "SELECT c.path, strlen(c.text)::BIGINT AS size, s.sections, s.topicization_readiness AS readiness, "
    "s.conversion_risk AS risk FROM corpus c JOIN scores s USING (path)",
)
_ROW = (
    "'<tr><td>' || " + html_esc("c.path") + " || '</td><td>' || CAST(strlen(c.text) AS VARCHAR) || '</td><td>' || "
    "CAST(s.sections AS VARCHAR) || '</td><td>' || CAST(s.topicization_readiness AS VARCHAR) || '</td><td>' || "
    "CAST(s.conversion_risk AS VARCHAR) || '</td></tr>'"
)
qc(
    "report_html",
    f"""SELECT 0::BIGINT AS part, '' AS k1, 0::BIGINT AS k2, '' AS k3,
  {sql_str(REPORT_HEAD)} || CAST(count(*) AS VARCHAR) || {sql_str(REPORT_TABLE_OPEN + chr(10))} AS fragment FROM corpus
UNION ALL
SELECT 1, c.path, 0, '', {_ROW} || chr(10)
FROM corpus c JOIN scores s USING (path)
UNION ALL
SELECT 2, '', 0, '', {sql_str(REPORT_MIDDLE)} || CASE WHEN count(*) > 0 THEN '<ul>' ELSE {sql_str(REPORT_NO_DUPLICATES)} END || chr(10)
FROM (SELECT DISTINCT leader FROM dd_key_leader WHERE key <> leader)
UNION ALL
SELECT 3, leader, 0, '', '<li>' || {html_esc('leader')} || chr(10) FROM (SELECT DISTINCT leader FROM dd_key_leader WHERE key <> leader)
UNION ALL
SELECT 3, leader, 1, key, ', ' || {html_esc('key')} || chr(10) FROM dd_key_leader WHERE key <> leader
UNION ALL
SELECT 3, leader, 2, '', '</li>' || chr(10) FROM (SELECT DISTINCT leader FROM dd_key_leader WHERE key <> leader)
UNION ALL
SELECT 4, '', 0, '', CASE WHEN count(*) > 0 THEN '</ul>' ELSE '' END || {sql_str(REPORT_TAIL + chr(10))}
FROM (SELECT DISTINCT leader FROM dd_key_leader WHERE key <> leader)""",
)
# What the converters must make of the guides: written from the parts' columns, without any parsing.
_N, _T, _B = xml_esc("p_name"), xml_esc("p_type"), xml_esc("p_brand")
ORACLE["md_blocks"] = f"""SELECT concat('guides/', CAST(p_partkey AS VARCHAR), '.md') AS path,
  '<article><section><title>' || {_N} || '</title><para>The <emphasis role="strong">' || {_T} || '</emphasis> box has <literal>' || {_B}
  || '</literal> &amp; ' || CASE p_size % 3 WHEN 0 THEN '<ulink url="http://zero.example/' || CAST(p_partkey AS VARCHAR) || '">a spec</ulink>'
    WHEN 1 THEN '<ulink url="http://one.example/?a=1&amp;b=2">a spec</ulink>' ELSE '[a spec][s2]' END
  || '.</para><programlisting language="sh"># run ' || {_N} || chr(10) || 'if x &lt; ' || CAST(p_size AS VARCHAR)
  || '; then</programlisting><itemizedlist><listitem><para>open <emphasis>' || {_T} || '</emphasis></para><orderedlist><listitem><para>lid</para></listitem>'
  || '<listitem><para>' || {_B} || '</para></listitem></orderedlist></listitem><listitem><para>close</para></listitem></itemizedlist>'
  || '<blockquote><para>note: ' || {_N} || '</para><itemizedlist><listitem><para>keep</para></listitem></itemizedlist></blockquote>'
  || '<table><tgroup cols="2"><thead><row><entry>part</entry><entry>size</entry></row></thead><tbody><row><entry>' || {_N} || '</entry><entry>'
  || CAST(p_size AS VARCHAR) || '</entry></row><row><entry>a|b</entry><entry></entry></row></tbody></tgroup></table>'
  || CASE WHEN p_size % 2 = 0 THEN '</section><section><title>Underlined ' || {_B} || '</title><para>end</para>'
    ELSE '<programlisting>indented ' || CAST(p_size AS VARCHAR) || '</programlisting>' END || '</section></article>' AS docbook FROM part"""
ORACLE["html_structure"] = f"""SELECT concat('guides/', CAST(p_partkey AS VARCHAR), '.html') AS path,
  '<article><section><title>' || {_N} || ' — café</title><para>Size' || chr(160) || CAST(p_size AS VARCHAR) || ' © ’ <emphasis role="strong">' || {_B}
  || '</emphasis> <ulink url="http://parts.example/?a=1&amp;b=' || CAST(p_partkey AS VARCHAR) || '">spec</ulink></para>'
  || '<itemizedlist><listitem><para>one</para><itemizedlist><listitem><para>' || {_T} || '</para></listitem></itemizedlist></listitem><listitem><para>two</para></listitem></itemizedlist>'
  || '<informaltable><tbody><tr><td><para>part</para></td><td><para>size</para></td></tr><tr><td><para>' || {_N} || '</para></td><td><para>'
  || CAST(p_size AS VARCHAR) || '</para></td></tr></tbody></informaltable><programlisting>  run ' || {_N} || chr(10) || chr(10)
  || '  x &lt; 1</programlisting></section></article>' AS docbook FROM part"""
# Of the linked guides: the text of each section is short, so that no document gets the bonus for its length.
_LOST = "(p_size % 7 = 0 OR p_partkey + 1 NOT IN (SELECT p_partkey FROM part))"
ORACLE["measured_metrics"] = f"""SELECT concat('linked/', CAST(p_partkey AS VARCHAR), '.md') AS path,
  p_size % 6 <= 3 AS lists_depth_ok, p_size % 2 = 0 AS images_with_alt, p_size % 6 > 4 AS deep_nesting, {_LOST} AS unresolved_anchors,
  p_size % 5 = 0 AS mixed_inline_blocks,
  ({TW['heading_ladder_valid']} + {TW['tables_simple']} + CASE WHEN p_size % 6 <= 3 THEN {TW['lists_depth_ok']} ELSE 0 END
    + CASE WHEN p_size % 2 = 0 THEN {TW['images_with_alt']} ELSE 0 END)::BIGINT AS topicization_readiness,
  (CASE WHEN p_size % 6 > 4 THEN {RW['deep_nesting']} ELSE 0 END + CASE WHEN {_LOST} THEN {RW['unresolved_anchors']} ELSE 0 END
    + CASE WHEN p_size % 5 = 0 THEN {RW['mixed_inline_blocks']} ELSE 0 END)::BIGINT AS conversion_risk FROM part"""
ORACLE["decode_text"] = (
    "SELECT concat('docs/', source, '/', CAST(doc_id AS VARCHAR), '.md') AS path, "
    "true AS round_trip, "
    "CASE WHEN doc_id % 2 = 0 OR regexp_matches(text, '[^\\x{00}-\\x{ff}]') THEN true ELSE NOT regexp_matches(text, '[\\x{80}-\\x{ff}]') END AS valid_utf8, "
    "length(text)::BIGINT AS n_chars FROM documents"
)
