"""Toxicity by weak supervision.

Many voters look at a document: lexicon voters (groups of words and word beginnings that
are over-represented in toxic labelled rows, and a general insult list) and pattern
voters (several hits, density, threats, insults in the second person, shouting, masked
words, capitals).  A generative label model over the latent label is fitted by EM to the
counts of all documents' vote patterns: first with independent voters, then voters whose
residual correlation is high are put into one block with a joint distribution, so that
agreeing copies of one signal do not count twice.  Its posteriors are the training labels
of a logistic regression on the votes and hit counts, which scores every document.

Work and bounds: the lexicon comes from at most ``fit_rows`` labelled rows, copies of one
text counted once; the label model sees all documents, as at most ``2 ** voters`` counts;
the regression is fitted on at most ``fit_rows`` documents.  Two narrow passes over the
texts, no shuffle of texts.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, bounded_sample, map_batches, map_pandas

FIT_ROWS = 12_000
MAX_TERMS = 96
LEXICON_GROUPS = 6
LEAST_LIFT = 30.0
STEMS = (4, 5, 6)
PRIOR = 0.1  # toxic share assumed without labels

WORDS = re.compile(r"[^\W\d_]+").findall
# General voters, independent of the labels
INSULTS = frozenset(
    "idiot idiots moron morons stupid dumb dumbass loser losers scum trash garbage worthless pathetic disgusting "
    "imbecile cretin retard fool clown pig swine bastard bitch asshole shithead fuck fucking fucker crap jerk "
    "scumbag lowlife vermin degenerate subhuman".split()
)
THREAT_VERBS = ("kill", "hurt", "beat", "destroy", "burn", "hang")
THREAT = re.compile(rf"\b(?:{'|'.join(THREAT_VERBS)})\s+(?:you|yourself|them|him|her|those|these)\b")
SECOND_PERSON = re.compile(r"\byou(?:'re| are)?\s+(?:(?:such|so|a|an|all|really|fucking)\s+){0,3}(\w+)")
SHOUT = re.compile(r"!{2,}")
MASKED = re.compile(r"[a-z][*#$%&@]{2,}")


SEEN_WORDS = 400_000


@dataclass
class Lexicon:
    """``words`` and ``stems`` (beginnings of one of the lengths ``STEMS``) to the number of their voter group."""

    words: dict[str, int] = field(default_factory=dict)
    stems: dict[str, int] = field(default_factory=dict)
    seen: set[str] = field(default_factory=set, repr=False)  # words looked up before; emptied at a fixed size
    known: dict[str, int | None] = field(default_factory=dict, repr=False)  # hits among them, with their group

    def hits(self, words: set[str]) -> set[str]:
        """The words that the lexicon or the insult list has; their groups are in ``known``."""
        if len(self.seen) > SEEN_WORDS:
            self.seen.clear()
        fresh = words - self.seen
        for w in fresh:
            group = self.words.get(w)
            if group is None:
                group = next((g for k in STEMS if len(w) > k and (g := self.stems.get(w[:k])) is not None), None)
            if group is not None or w in INSULTS:
                self.known[w] = group
        self.seen |= fresh
        return words & self.known.keys()


VOTERS = (*(f"lexicon_{i}" for i in range(LEXICON_GROUPS)), "insults", "several", "dense", "threat", "second_person", "shout", "masked", "capitals")
#: Voters that are about toxicity; the others may turn out to say nothing.
LEANING = np.array([1] * (LEXICON_GROUPS + 5) + [0] * 3)
STATS = ("log_hits", "distinct", "density")


def features(text: str, lexicon: Lexicon) -> np.ndarray:
    """Votes (0 or 1 each) and hit statistics of one text; an empty text gives zeros."""
    out = np.zeros(len(VOTERS) + len(STATS))
    lowered = text.lower()
    words = WORDS(lowered)
    if not words:
        return out
    hits = lexicon.hits(set(words))
    for w in hits:
        if (group := lexicon.known[w]) is not None:
            out[group] = 1
        if w in INSULTS:
            out[LEXICON_GROUPS] = 1
    n = sum(map(hits.__contains__, words)) if hits else 0
    # each pattern is tried only where one of its characters or words occurs
    votes = (
        len(hits) >= 2,
        n >= 0.01 * len(words),
        any(v in lowered for v in THREAT_VERBS) and bool(THREAT.search(lowered)),
        bool(hits) and "you" in lowered and any(m.group(1) in hits for m in SECOND_PERSON.finditer(lowered)),
        "!!" in text and len(SHOUT.findall(text)) >= 3,
        any(c in text for c in "*#$%&@") and len(MASKED.findall(text)) >= 3,
        sum(map(text.count, "AEIOU")) > 0.08 * len(text),
    )
    out[LEXICON_GROUPS + 1 : len(VOTERS)] = votes
    out[len(VOTERS) :] = math.log1p(n), min(len(hits), 10) / 10, min(10 * n / len(words), 1.0)
    return out


# --------------------------------------------------------------------------- lexicon
def terms(text: str) -> set[str]:
    """Distinct words, and beginnings (marked by a hyphen) of longer ones."""
    words = {w for w in WORDS(text.lower()) if 3 <= len(w) <= 40}
    return words | {f"{w[:k]}-" for w in words for k in STEMS if len(w) > k}


def family(text: str) -> int:
    """Smallest hash of three-word runs: equal for copies and for most near copies."""
    w = text.lower().split()
    runs = zip(w, w[1:], w[2:], strict=False) if len(w) > 2 else [w]
    return min(xxhash.xxh64_intdigest(" ".join(r)) for r in runs) - (1 << 63)


def mine_lexicon(rows: DataFrame) -> Lexicon:
    """The terms with the largest excess among toxic rows of ``(text, label)``; bounded tables only."""
    keyed = map_pandas(
        rows.select("text", "label").dropna(), lambda b: b.assign(family=[family(t) for t in b["text"]]), "text string, label int, family bigint"
    )
    single = keyed.groupBy("family", "label").agg(F.min("text").alias("text")).persist()
    try:
        sizes = {r["label"]: r["count"] for r in single.groupBy("label").count().collect()}
        n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
        if not n1 or not n0:
            return Lexicon()
        least = max(3, math.ceil(0.02 * n1))

        def count(label: int, among: frozenset | None):
            def per_partition(batches):
                total = Counter()
                for b in batches:
                    for t in b["text"]:
                        total.update(terms(t) if among is None else terms(t) & among)
                if total:  # an empty string column has no Arrow form
                    yield pd.DataFrame({"term": list(total.keys()), "n": list(total.values())})

            counted = map_batches(single.filter(F.col("label") == label), per_partition, "term string, n bigint")
            return counted.groupBy("term").agg(F.sum("n").alias("n"))

        toxic = dict(count(1, None).filter(F.col("n") >= least).toPandas().itertuples(index=False))
        clean = dict(count(0, frozenset(toxic)).toPandas().itertuples(index=False))
    finally:
        single.unpersist()
    ranked = []
    for term, c1 in toxic.items():
        lift = (c1 + 0.5) / (n1 + 1) / ((clean.get(term, 0) + 0.5) / (n0 + 1))
        # a small sample cannot show the whole lift: half a clean hit is assumed
        if lift >= min(LEAST_LIFT, 0.5 * (c1 + 0.5) / (n1 + 1) / (0.5 / (n0 + 1))) and lift > 3:
            ranked.append((-c1 * math.log(lift), term))
    words, stems = {}, {}
    for _, term in sorted(ranked):
        n = len(words) + len(stems)
        if n == MAX_TERMS or any(term[:k] in stems for k in STEMS):
            continue
        (stems if term.endswith("-") else words)[term.rstrip("-")] = n % LEXICON_GROUPS
    return Lexicon(words, stems)


# --------------------------------------------------------------------------- label model
@dataclass
class LabelModel:
    prior: float
    blocks: list[list[int]]  # voters with one joint distribution
    tables: list[np.ndarray]  # per block: (2, 2 ** len(block)) probabilities of its patterns

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """P(toxic | votes) for rows of 0/1 votes."""
        logs = np.tile(np.log([1 - self.prior, self.prior]), (len(votes), 1))
        for block, table in zip(self.blocks, self.tables, strict=True):
            logs += np.log(table[:, pattern_of(votes[:, block])]).T
        return 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -500, 500)))


def pattern_of(votes: np.ndarray) -> np.ndarray:
    return votes.astype(np.int64) @ (1 << np.arange(votes.shape[1]))


def fit_label_model(votes: np.ndarray, n: np.ndarray, prior: float, anchors: np.ndarray | None = None, rounds: int = 60,
                    correlated: float = 0.15) -> LabelModel:
    """EM over distinct vote patterns with their counts; see the module's text.

    ``anchors``: per pattern, the labelled rows of either class (two rows).  They enter
    each M-step as known cases with half the weight of all documents, so that the latent
    label cannot turn into another split of the corpus.
    """
    m = votes.shape[1]
    known = np.zeros((2, len(n))) if anchors is None or not anchors.sum() else anchors * (0.5 * n.sum() / anchors.sum())
    fire = (n @ votes + 1) / (n.sum() + 2)
    start = [np.array([[1 - b, b], [1 - a, a]]) for a, b in zip(np.where(LEANING, 0.6, fire), np.where(LEANING, 0.02, fire), strict=True)]
    model = LabelModel(prior, [[j] for j in range(m)], start)
    model = _em(model, votes, n, known, rounds)
    # residual correlation of voters within the classes
    p1 = model.posterior(votes)
    residual = np.zeros((m, m))
    for w in (n * p1, n * (1 - p1)):
        if w.sum() > 0:
            centred = votes - (w @ votes) / w.sum()
            residual += (centred * w[:, None]).T @ centred
    scale = np.sqrt(np.outer(np.diag(residual), np.diag(residual)))
    linked = np.divide(residual, scale, out=np.zeros_like(residual), where=scale > 0) > correlated
    blocks, left = [], set(range(m))
    while left:
        block, queue = set(), [min(left)]
        while queue:
            j = queue.pop()
            if j in left and len(block) < 10:
                left.discard(j)
                block.add(j)
                queue += [int(k) for k in np.flatnonzero(linked[j]) if k in left]
        blocks.append(sorted(block))
    joint = LabelModel(model.prior, blocks, _tables(blocks, votes, n, p1, known))
    return _em(joint, votes, n, known, rounds)


def _tables(blocks, votes, n, p1, known) -> list[np.ndarray]:
    out = []
    for block in blocks:
        pattern, size = pattern_of(votes[:, block]), 1 << len(block)
        share = np.bincount(pattern, n, size)
        base = (share + 1) / (share.sum() + size)
        table = np.stack([np.bincount(pattern, n * w + k, size) for w, k in zip((1 - p1, p1), known, strict=True)])
        out.append((table + base) / (table.sum(1, keepdims=True) + 1))
    return out


def _em(model: LabelModel, votes, n, known, rounds: int) -> LabelModel:
    for _ in range(rounds):
        p1 = model.posterior(votes)
        prior = float(np.clip((n @ p1 + 2) / (n.sum() + 20), 0.001, 0.5))
        model = LabelModel(prior, model.blocks, _tables(model.blocks, votes, n, p1, known))
    return model


# --------------------------------------------------------------------------- classifier
def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 25) -> np.ndarray:
    """Weights (intercept last) of a ridge logistic regression on soft labels, by Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(penalty), x.T @ (p - y) + penalty * w)
        w -= np.clip(step, -5, 5)
    return w


@dataclass
class ToxicityModel:
    lexicon: Lexicon
    labels: LabelModel | None
    weights: np.ndarray

    def scores(self, texts) -> np.ndarray:
        x = np.array([features(t, self.lexicon) for t in texts]).reshape(len(texts), -1)
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> ToxicityModel:
    """Model from ``docs(doc_id, text)`` and ``labels(doc_id, label)`` (only rows that may be learnt from).

    Rows with a null id or label teach nothing; a null text counts as empty; of rows that
    share an id one teaches.  Without labels of both kinds the general voters alone decide;
    without documents every score is the prior.
    """
    known = labels.dropna().groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))
    known = bounded_sample(known, F.col("doc_id"), fit_rows, "toxicity-labels")
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(known), "doc_id")
    # at most fit_rows rows: of those that share an id one teaches
    scratch = Scratch(docs.sparkSession)
    rows = scratch.table(rows.groupBy("doc_id", "label").agg(F.min("text").alias("text")).select("text", "label"), "toxicity-rows")
    try:
        return _fit(docs, rows, known)
    finally:
        scratch.drop("toxicity-rows")


def _fit(docs: DataFrame, rows: DataFrame, known: DataFrame) -> ToxicityModel:
    """The model from all documents and the labelled ``rows(text, label)``."""
    lexicon = mine_lexicon(rows)
    share = known.agg(F.avg("label")).first()[0]
    prior = float(np.clip(PRIOR if share is None else share, 0.01, 0.5))

    def votes(batches):
        total = Counter()
        for b in batches:
            for t in b["text"].fillna(""):
                total[int(pattern_of(features(t, lexicon)[None, : len(VOTERS)])[0])] += 1
        yield pd.DataFrame({"pattern": list(total.keys()), "n": list(total.values())})

    counted = map_batches(docs.select("text"), votes, "pattern int, n bigint").groupBy("pattern").agg(F.sum("n").alias("n"))
    table = counted.toPandas()  # at most 2 ** len(VOTERS) rows
    if table.empty:
        return ToxicityModel(lexicon, None, np.append(np.zeros(len(VOTERS) + len(STATS)), math.log(prior / (1 - prior))))
    patterns, n = table["pattern"].to_numpy(np.int64), table["n"].to_numpy(float)
    every = (patterns[:, None] >> np.arange(len(VOTERS))) & 1
    names = [*VOTERS, *STATS, "label"]
    sample = map_pandas(
        rows,
        lambda b: pd.DataFrame(np.array([[*features(t, lexicon), y] for t, y in zip(b["text"], b["label"], strict=True)]).reshape(len(b), -1), columns=names),
        ", ".join(f"{c} double" for c in names),
    ).toPandas().to_numpy(float)
    x, y = sample[:, :-1], sample[:, -1]
    row_of = {int(p): i for i, p in enumerate(patterns)}
    at = np.array([row_of[int(p)] for p in pattern_of(x[:, : len(VOTERS)])], dtype=np.int64)
    anchors = np.stack([np.bincount(at[y == c], minlength=len(n)) for c in (0, 1)]).astype(float)
    model = fit_label_model(every, n, prior, anchors)
    if not len(x):  # no labelled rows: the patterns themselves, without statistics
        x = np.hstack([every, np.zeros((len(n), len(STATS)))])
    return ToxicityModel(lexicon, model, logistic(x, model.posterior(x[:, : len(VOTERS)])))
