"""Quality classifier: random Fourier features, ridge normal equations, isotonic calibration.

Every text becomes a short vector of document statistics.  Random Fourier features of the
standardised vector approximate a Gaussian kernel; ridge scores come from the normal
equations, whose matrices are summed per partition and then on the driver (one matrix per
partition of at most ``PARTS``).  Scores of labelled rows kept out of the fit give a
monotone (pool adjacent violators) map from score to probability.

At most ``fit_rows`` labelled rows are used; all documents are scored in one narrow pass.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, map_batches, map_pandas

FIT_ROWS = 40_000
FEATURES = 300
RIDGE = 1.0
BANDWIDTH = 0.12  # of the Gaussian kernel: exp(-BANDWIDTH / 2 * squared distance)
PARTS = 16
CALIBRATION = 4  # one labelled row in so many calibrates

TAIL = re.compile(r"[^\w\s.,;:?!'\")\]]$")


def _bytes(chars: str) -> np.ndarray:
    out = np.zeros(256)
    out[[ord(c) for c in chars]] = 1
    return out


UPPER = _bytes("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
LOWER = _bytes("abcdefghijklmnopqrstuvwxyz")
GROUPS = np.stack([
    _bytes("0123456789"), _bytes(" "), _bytes("\n"), _bytes(".,;:?"), _bytes("!"), _bytes("|"), _bytes("#$%&*+@^~<>={}[]\\/_"),
    np.r_[np.zeros(128), np.ones(128)],
]).T
STATS = (
    "log_chars", "upper", "digits", "blanks", "lines", "stops", "exclaims", "bars", "symbols", "beyond_ascii", "word_length", "word_spread",
    "distinct_words", "top_word", "distinct_pairs", "short_words", "long_words", "odd_tails", "repeated_lines", "repeated_first_words",
    "words_per_line", "entropy", "log_words",
)


def statistics(text: str) -> np.ndarray:
    """The document statistics; zeros for an empty text."""
    out = np.zeros(len(STATS))
    if not text:
        return out
    counts = np.bincount(np.frombuffer(text.encode("utf-8"), dtype=np.uint8), minlength=256).astype(float)
    n = counts.sum()
    upper, lower = counts @ UPPER, counts @ LOWER
    out[0], out[1], out[2:10] = np.log1p(n), upper / (upper + lower + 1), counts @ GROUPS / n
    share = counts[counts > 0] / n
    out[21] = -(share * np.log(share)).sum()
    words = text.split()
    if not words:
        return out
    k = len(words)
    lengths = np.fromiter(map(len, words), dtype=float, count=k)
    known = Counter(words)
    lines = [x for x in text.split("\n") if x]
    seen = Counter(lines)
    out[10], out[11] = lengths.mean(), lengths.std()
    out[12], out[13] = len(known) / k, max(known.values()) / k
    out[14] = len(set(zip(words, words[1:], strict=False))) / max(1, k - 1)
    out[15], out[16] = (lengths <= 3).mean(), (lengths >= 13).mean()
    out[17] = sum(c for w, c in known.items() if TAIL.search(w)) / k
    out[18] = sum(len(x) * c for x, c in seen.items() if c > 1) / max(1, sum(map(len, lines)))
    out[19] = 1 - len({x[:20] for x in seen}) / len(seen)
    out[20], out[22] = np.log1p(k / len(lines)), np.log1p(k)
    return out


def isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: centres and means of the blocks, both increasing."""
    order = np.argsort(score, kind="stable")
    blocks: list[list[float]] = []  # [mean, weight, sum of scores]
    for s, v in zip(score[order], y[order], strict=True):
        blocks.append([float(v), 1.0, float(s)])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            m, w, t = blocks.pop()
            p = blocks[-1]
            blocks[-1] = [(p[0] * p[1] + m * w) / (p[1] + w), p[1] + w, p[2] + t]
    table = np.array(blocks)
    # a small pull to the overall mean keeps blocks of a few rows off 0 and 1
    mean = (table[:, 0] * table[:, 1] + 0.5 * y.mean()) / (table[:, 1] + 0.5)
    return table[:, 2] / table[:, 1], np.maximum.accumulate(mean)


@dataclass
class QualityModel:
    centre: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def fourier(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.centre) / self.scale, -6, 6)
        z = np.cos(x @ self.directions + self.phases) * np.sqrt(2 / len(self.phases))
        return np.hstack([z, np.ones((len(z), 1))])

    def scores(self, texts) -> np.ndarray:
        stats = np.array([statistics(t) for t in texts]).reshape(len(texts), -1)
        raw = self.fourier(stats) @ self.weights
        level = np.interp(raw, self.knots, self.levels)
        # the ridge score orders texts of one level, by less than any threshold matters
        return np.clip(level + 1e-6 * np.tanh(raw), 0, 1)


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, features: int = FEATURES, seed: int = 7) -> QualityModel:
    """Model from ``docs(doc_id, text)`` and ``labels(doc_id, label)`` (only rows that may be learnt from).

    Rows with a null id or label teach nothing, a null text counts as empty; of rows that
    share an id one teaches.  Without labelled rows every score is 0.5.
    """
    known = labels.dropna().groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))
    known = bounded_sample(known, F.col("doc_id"), fit_rows, "quality-labels")
    part = F.pmod(F.xxhash64(F.lit("calibrate"), "doc_id"), F.lit(CALIBRATION)) == 0
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(F.broadcast(known), "doc_id")  # at most fit_rows ids
    measured = map_pandas(
        rows.select("doc_id", "label", F.coalesce("text", F.lit("")).alias("text")),
        lambda b: b[["doc_id", "label"]].assign(stats=[statistics(t).tolist() for t in b["text"]]),
        "doc_id bigint, label int, stats array<double>",
    )
    # an id that several rows share teaches once; the scan stays as wide as the table, only these few rows are dealt to PARTS
    table = measured.groupBy("doc_id", "label").agg(F.min("stats").alias("stats")).coalesce(PARTS).withColumn("calibrate", part).persist()
    try:
        rng = np.random.default_rng(seed)
        moments = table.select(*(f(F.col("stats")[i]).alias(f"{f.__name__}{i}") for f in (F.avg, F.stddev_pop) for i in range(len(STATS)))).first()
        d = len(STATS)
        if moments[0] is None:
            zero = np.zeros(features + 1)
            return QualityModel(np.zeros(d), np.ones(d), np.zeros((d, features)), np.zeros(features), zero, np.zeros(1), np.full(1, 0.5))
        model = QualityModel(
            np.array(moments[:d]), np.maximum(np.array(moments[d:]), 1e-4), rng.normal(0, np.sqrt(BANDWIDTH), (d, features)),
            rng.uniform(0, 2 * np.pi, features), np.zeros(features + 1), np.zeros(1), np.zeros(1),
        )

        def partial(batches):
            total = np.zeros((features + 1, features + 2))
            for b in batches:
                if len(b):
                    z = model.fourier(np.stack(b["stats"].to_numpy()))
                    total += z.T @ np.hstack([z, b[["label"]].to_numpy(float)])
            yield pd.DataFrame({"sums": [total.tobytes()]})

        sums = map_batches(table.filter(~F.col("calibrate")), partial, "sums binary").collect()  # at most PARTS matrices
        total = sum(np.frombuffer(r.sums).reshape(features + 1, -1) for r in sums)
        model.weights = np.linalg.solve(total[:, :-1] + RIDGE * np.eye(features + 1) * np.r_[np.ones(features), 1e-6], total[:, -1])
        scored = map_pandas(
            table.filter("calibrate"),
            lambda b: pd.DataFrame({"y": b["label"].to_numpy(float), "s": (model.fourier(np.stack(b["stats"].to_numpy())) @ model.weights) if len(b) else []}),
            "y double, s double",
        ).toPandas()
        if scored.empty:  # a handful of labels: no calibration rows
            model.knots, model.levels = np.array([0.0, 1.0]), np.array([0.0, 1.0])
        else:
            model.knots, model.levels = isotonic(scored["s"].to_numpy(), scored["y"].to_numpy())
    finally:
        table.unpersist()
    return model
