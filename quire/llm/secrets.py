"""Secret scan: fixed patterns, and character Markov models compared by log-likelihood ratio.

Two models of order 2 give the probability of a character after the two before it.  One is
trained on samples labelled random: the values that the fixed patterns find in the
documents, and strings of a seeded generator over the usual key alphabets.  The other is
trained on samples labelled ordinary: all text that no fixed pattern marks, and a short
list of identifiers as they occur in code.  A candidate is a run of 20 or more key
characters, or what fixed patterns leave of such a run.  It becomes a ``random`` span when
the sum of its log-likelihood ratios passes the threshold (a prior odds of one in a
billion by default) and their mean per character passes ``least_rate``: long compounds gather
a high sum slowly, random strings have 3.5 and more.  A trigram that repeats in a run counts once,
so that rules and runs of one character are no evidence.

The counts of the documents come from one pass over all of them, summed per partition and
then by trigram; the table has at most ``len(ALPHABET)`` cubed rows, whatever the input.
"""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_batches, ready

# The base patterns and least lengths, in the order that settles ties
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 6, 20, 24
KINDS = ("assign", "access", "hex", "random")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")
LEAST_CANDIDATE = 20
MARKS = "+/_=-"
KEY_CHARS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-."
OTHER_LETTER, BREAK = len(KEY_CHARS), len(KEY_CHARS) + 1
SYMBOLS = len(KEY_CHARS) + 2
CODES = np.full(256, BREAK, dtype=np.int64)
CODES[128:] = OTHER_LETTER
CODES[[ord(c) for c in KEY_CHARS]] = range(len(KEY_CHARS))

THRESHOLD = math.log(1e9)
LEAST_RATE = 3.3  # nats a character
GENERATED = 4000  # strings of the seeded generator
IDENTIFIER_WEIGHT = 50
GENERATOR_ALPHABETS = (KEY_CHARS[:62], KEY_CHARS[:64], KEY_CHARS[26:62], KEY_CHARS[:26] + KEY_CHARS[52:62], "0123456789abcdef")
IDENTIFIERS = (
    "getElementById setTimeoutInterval max_connections_per_host read_timeout_seconds application/json "
    "text/html-utf-8 user_id_2 created_at_utc file_name_v1 index_of_first_element http2_server_push "
    "README_first.md requirements-dev.txt src/main/resources/config_local.yaml test_case_01_empty_input "
    "utf8_general_ci sha256_digest base64_encoded ipv4_address x86_64-linux-gnu python3_version "
    "MAX_BUFFER_SIZE_BYTES DEFAULT_RETRY_COUNT_3 2024-01-31T12-00-00 chapter-12-section-3 "
    "docs/guide/install/index.html com/service/user/UserRepository.java en/latest/api/reference/page-3 "
    "usr/local/share/data/file.txt a/b/c/d/e/f/1/2/3 de/produkte/liste/seite-4 www.w3.org/2001/XMLSchema "
    "user.name+tag1 key=value1 width=640/height=480 a_b_c_d_e_1_2 v1.2.3-beta-4 news/2020/05/17/story-title "
    "some-very-long-page-title-with-words-2021 img_20190817_142233 order_item_price_2dp "
    "abcdefghijklmnopqrstuvwxyz0123456789 ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789 ABSTRACT_FACTORY_BEAN_PROVIDER "
    "Kraftfahrzeughaftpflichtversicherung Schifffahrtsgesellschaft Bundesausbildungsgesetz verantwoordelijkheidsgevoel "
    "anticonstitutionnellement desproporcionadamente internationalization getElementsByTagNameNS "
).split()


# --------------------------------------------------------------------------- base patterns
def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind number, end)`` of the fixed patterns, sorted."""
    out = []
    lowered = text.lower()
    if any(w in lowered for w in ASSIGN_WORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_ASSIGN]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    if has_long_chunk(text, LEAST_HEX):
        out += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= LEAST_HEX]
    return sorted(out)


def has_long_chunk(text: str, least: int) -> bool:
    """Whether some run without white space is that long (no span holds white space but an assignment)."""
    return max(map(len, text.split()), default=0) >= least


def without(text: str, spans: list[tuple[int, int, int]], filler: str) -> str:
    """The text with every stretch covered by spans replaced by ``filler``."""
    parts, at = [], 0
    for start, _, end in sorted(spans):
        if start >= at:
            parts += (text[at:start], filler)
        at = max(at, end)
    return "".join((*parts, text[at:]))


# --------------------------------------------------------------------------- training
def trigram_counts(texts: list[str]) -> np.ndarray:
    """Counts of symbol trigrams, texts kept apart by breaks."""
    codes = CODES[np.frombuffer("\n\n".join(["", *texts, ""]).encode("utf-8"), dtype=np.uint8)]
    grams = (codes[:-2] * SYMBOLS + codes[1:-1]) * SYMBOLS + codes[2:]
    return np.bincount(grams, minlength=SYMBOLS**3)


def generated_strings(n: int = GENERATED, seed: int = 11) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choices(GENERATOR_ALPHABETS[i % len(GENERATOR_ALPHABETS)], k=rng.randint(20, 64))) for i in range(n)]


def train(docs: DataFrame) -> np.ndarray:
    """Log-likelihood ratio (random against ordinary) of every trigram, from all documents."""

    def count(batches):
        total = np.zeros((2, SYMBOLS**3), dtype=np.int64)
        for batch in batches:
            ordinary, found, held = [], [], 0
            for text in batch["text"].dropna():
                spans = base_spans(text)
                found += [text[s:e].rsplit("=", 1)[-1].strip(" \"':") for s, _, e in spans]
                # candidates have no label: they train neither model
                ordinary.append(without(text, spans + candidates(text, spans), "\n"))
                held += len(text)
                if held > 4_000_000:
                    total[0] += trigram_counts(ordinary)
                    ordinary, held = [], 0
            total[0] += trigram_counts(ordinary)
            total[1] += trigram_counts(found)
        for label in (0, 1):
            grams = np.flatnonzero(total[label])
            yield pd.DataFrame({"label": label, "gram": grams, "n": total[label][grams]})

    rows = map_batches(docs.select("text"), count, "label int, gram bigint, n bigint")
    counts = np.zeros((2, SYMBOLS**3))
    summed = rows.groupBy("label", "gram").agg(F.sum("n").alias("n")).toPandas()  # at most 2 * SYMBOLS ** 3 rows
    counts[summed["label"], summed["gram"]] = summed["n"]
    counts[0] += IDENTIFIER_WEIGHT * trigram_counts(list(IDENTIFIERS))
    counts[1] += trigram_counts(generated_strings())
    return log_probabilities(counts[1]) - log_probabilities(counts[0])


def log_probabilities(counts: np.ndarray) -> np.ndarray:
    """Smoothed log P(third | first two): trigram counts backed off to bigram and unigram shares."""
    tri = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    uni = (tri.sum((0, 1)) + 1) / (tri.sum() + SYMBOLS)
    bi = tri.sum(0)
    bi = (bi + 2 * uni) / (bi.sum(1, keepdims=True) + 2)
    return np.log((tri + 2 * bi[None]) / (tri.sum(2, keepdims=True) + 2)).ravel().astype(np.float32)


# --------------------------------------------------------------------------- scanning
def candidates(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """``(start, 3, end)`` of long key-like runs, and of what the spans in ``taken`` leave of them."""
    if not has_long_chunk(text, LEAST_CANDIDATE):
        return []
    out = []
    for m in CANDIDATE.finditer(text):
        at, end = m.span()
        inside = [t for t in taken if t[0] < end and at < t[2]]
        for start, _, stop in sorted(inside):
            # marks between a span and the rest of its run belong to neither
            before = text[at:start].rstrip(MARKS)
            out.append((at, at + len(before)))
            at = max(at, stop)
            while at < end and text[at] in MARKS:
                at += 1
        out.append((at, end))
    return [(a, 3, b) for a, b in out if b - a >= LEAST_CANDIDATE]


def log_ratio(run: str, ratio: np.ndarray) -> float:
    """Log-likelihood ratio, random against ordinary, of a run of key characters; each of its trigrams once."""
    c = CODES[np.frombuffer(run.encode(), dtype=np.uint8)]
    return float(ratio[np.unique((c[:-2] * SYMBOLS + c[1:-1]) * SYMBOLS + c[2:])].sum())


def random_spans(text: str, ratio: np.ndarray, threshold: float, taken: list[tuple[int, int, int]], least_rate: float = LEAST_RATE) -> list[tuple[int, int, int]]:
    """The candidates that the models call random."""
    return [c for c in candidates(text, taken) if log_ratio(text[c[0] : c[2]], ratio) >= max(threshold, least_rate * (c[2] - c[0]))]


def secret_spans(docs: DataFrame, ratio: np.ndarray | None = None, threshold: float = THRESHOLD, filler: str = "[secret]",
                 keep: tuple[str, ...] = (), least_rate: float = LEAST_RATE) -> DataFrame:
    """``docs``' ``doc_id`` and ``keep`` columns, with ``spans`` and ``redacted``, one row per input row.

    ``spans``: ``array<struct<kind, start, end>>`` in code points (end exclusive), sorted
    by start, then by the order of ``KINDS``; ``redacted``: the text with every covered
    stretch replaced by ``filler``.  Only the text travels to Python, and a text comes back
    only if it changed.  A null text has no spans and stays null; null ids and repeated rows
    are kept; an empty table gives no rows.  ``keep`` must not name the new columns.
    """
    if {"spans", "redacted"} & set(keep):
        raise ValueError("keep must not hold spans or redacted")
    ready(docs.sparkSession)
    ratio = train(docs) if ratio is None else ratio

    def scan(texts: pd.Series) -> pd.DataFrame:
        spans, redacted = [], []
        for text in texts:
            base = base_spans(text) if isinstance(text, str) else []
            found = sorted(base + random_spans(text, ratio, threshold, base, least_rate)) if isinstance(text, str) else []
            spans.append([{"kind": KINDS[k], "start": s, "end": e} for s, k, e in found])
            redacted.append(without(text, found, filler) if found else None)
        return pd.DataFrame({"spans": spans, "redacted": redacted})

    # not deterministic: both fields come from one call
    scanned = F.pandas_udf(scan, "spans array<struct<kind: string, start: bigint, end: bigint>>, redacted string").asNondeterministic()
    found = docs.select(*dict.fromkeys(["doc_id", *keep]), F.col("text").alias("__quire_text"), scanned("text").alias("__quire_found"))
    kept = [F.col(f"`{c}`") for c in dict.fromkeys(["doc_id", *keep])]
    return found.select(*kept, F.col("__quire_found.spans").alias("spans"), F.coalesce("__quire_found.redacted", "__quire_text").alias("redacted"))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of the spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
