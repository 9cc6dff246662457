"""Plain option objects with the defaults every operator uses.

The word lists, weights, ranges and templates below are FIXED VALUES: they must
equal the ones of the tool we re-implement, otherwise scores, predictions and
XML differ.  They are stated here once, in their natural order.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values (must stay equal to the reference behaviour)
# ---------------------------------------------------------------------------
TASK_KEYWORDS = ("click", "run", "open", "select", "type", "press")
TASK_LANDMARKS = ("prerequisites", "steps", "results", "troubleshooting")
REFERENCE_MARKERS = ("parameters", "options", "syntax", "defaults")

TOPICIZATION_WEIGHTS = {
    "heading_ladder_valid": 10,
    "avg_section_len_target": 15,
    "tables_simple": 10,
    "lists_depth_ok": 10,
    "images_with_alt": 5,
}
RISK_WEIGHTS = {
    "deep_nesting": 20,
    "complex_tables": 25,
    "unresolved_anchors": 15,
    "mixed_inline_blocks": 10,
}
TARGET_SECTION_TOKENS = (50, 500)

# Prediction rule outputs: (type, confidence, reason)
PRED_TASK = ("task", 0.85, "ordered list + imperative/steps")
PRED_REFERENCE = ("reference", 0.80, "tables or reference markers")
PRED_CONCEPT = ("concept", 0.60, "expository default")
IMPERATIVE_DENSITY_MIN = 0.005

# Near-duplicate defaults of the assess configuration.
SHINGLE_NGRAM = 7
MINHASH_NUM_PERM = 64
DUPLICATE_THRESHOLD = 0.88

# Placeholder scores of files that are neither Markdown nor HTML.
GENERIC_READINESS = 50
GENERIC_RISK = 50

# Topic types and heuristics used by the transform classifier.
TOPIC_TYPES = ("concept", "task", "reference")
TASK_HEURISTIC_WORDS = ("step", "click", "select", "open", "run", "press", "type")
REFERENCE_HEURISTIC_WORDS = ("table of", "parameters", "syntax", "options", "defaults")

TOPIC_TEMPLATES = {
    "concept": ('<concept id="{id}"><title>', "</title><conbody>", "</conbody></concept>"),
    "task": ('<task id="{id}"><title>', "</title><taskbody>", "</taskbody></task>"),
    "reference": ('<reference id="{id}"><title>', "</title><refbody>", "</refbody></reference>"),
}
TOPIC_ID = "t1"
MAP_HEADER = (
    '<?xml version="1.0" encoding="UTF-8"?>\n'
    '<!DOCTYPE map PUBLIC "-//OASIS//DTD DITA Map//EN" "map.dtd">\n'
    "<map>\n"
    "  <title>{title}</title>\n"
)
MAP_FOOTER = "\n</map>\n"
MAP_TITLE = "Documentation Set"
UNTITLED = "Untitled"
CHUNKING_LEVEL = 1
CHUNKING_NESTED = True

# Extension → handler name (default registry) and the optional extra handler.
DEFAULT_HANDLERS = {
    ".md": "pandoc-md",
    ".html": "pandoc-html",
    ".htm": "pandoc-html",
    ".docx": "pandoc-docx",
}
OPTIONAL_HANDLERS = ("oxygen-docx",)
DEFAULT_EXTENSIONS = (".md", ".docx", ".html")


@dataclass(frozen=True)
class AssessOptions:
    """Options of the assess operators (defaults = the reference's config)."""

    task_keywords: tuple[str, ...] = TASK_KEYWORDS
    task_landmarks: tuple[str, ...] = TASK_LANDMARKS
    reference_markers: tuple[str, ...] = REFERENCE_MARKERS
    topicization_weights: dict = field(default_factory=lambda: dict(TOPICIZATION_WEIGHTS))
    risk_weights: dict = field(default_factory=lambda: dict(RISK_WEIGHTS))
    target_section_tokens: tuple[int, int] = TARGET_SECTION_TOKENS
    ngram: int = SHINGLE_NGRAM
    num_perm: int = MINHASH_NUM_PERM
    threshold: float = DUPLICATE_THRESHOLD
    # 'first_section' compares section 0 like the reference; 'document' uses the whole text.
    dedupe_scope: str = "first_section"
    minhash_seed: int = 20240607


@dataclass(frozen=True)
class Rule:
    """A classification rule: glob on the stem (filename rules) or regex (content rules)."""

    pattern: str
    type: str


@dataclass(frozen=True)
class ConvertOptions:
    """Options of the extract / transform / load operators."""

    rules_by_filename: tuple[Rule, ...] = ()
    rules_by_content: tuple[Rule, ...] = ()
    handler_overrides: dict = field(default_factory=dict)
    optional_handlers: tuple[str, ...] = ()
    map_title: str = MAP_TITLE
    topics_dir: str = "dita/topics"
    map_dir: str = "dita"
    # Converters of further handlers: name → function from the text column to an intermediate,
    # or an ``operators.routing.BatchConverter`` that runs Python code and may fail.
    handlers: dict = field(default_factory=dict)
    # Plan lookup key: 'path' (exact) or 'basename' (reference behaviour, collisions overwrite).
    plan_key: str = "path"
