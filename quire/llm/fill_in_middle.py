"""Fill-in-middle transformation as a pipeline of Arrow kernels.

A batch of texts is split into units (lines with their line feed) as list arrays, which are
flattened next to the indices of their parents.  A unit's ordinal is its place behind its
document's first unit; two cuts per document give it one of three roles (prefix, middle,
suffix).  For each role the units are filtered, rebuilt into one list per document and
joined; the output is the joined pieces behind their sentinels.  No step handles a single
document or unit: a batch is a handful of kernel calls, whatever the texts look like.

The cuts and the form come from a hash of the seed and the document's id, which Spark
computes; the same id always gets the same output.  Batches are worked on in slices of
``SLICE_BYTES``, so that memory is bounded by that and the longest text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ready

SEED = 7
SENTINELS = ("<P>", "<S>", "<M>")  # before the prefix, the suffix and the middle
RATE, SPM_RATE = 100, 50  # per cent: documents that are transformed, and of these suffix first
SLICE_BYTES = 16 << 20
PLAIN, PSM, SPM = "plain", "psm", "spm"
PREFIX_ROLE, MIDDLE_ROLE, SUFFIX_ROLE = 0, 1, 2
OUT = "n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


def hash_words(seed: int, doc_id: Column) -> list[Column]:
    """The first four 32-bit words of the hash of ``seed:id`` (a null id: nothing after the colon)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint").alias(f"h{k + 1}") for k in range(4)]


def check_sentinels(sentinels: tuple[str, str, str]) -> None:
    """Sentinels must be told apart wherever pieces are put together, else texts could not be rebuilt."""
    for a in sentinels:
        if not a:
            raise ValueError("a sentinel is empty")
        for b in sentinels:
            overlap = any(a[-k:] == b[:k] for k in range(1, min(len(a), len(b))))
            if overlap or (a is not b and a in b):
                raise ValueError(f"sentinels overlap: {a!r} and {b!r}")
    if len(set(sentinels)) < len(sentinels):
        raise ValueError("sentinels must differ")


def modulo(a: pa.Array, b: pa.Array) -> pa.Array:
    return pc.subtract(a, pc.multiply(pc.divide(a, b), b))


def units_of(text: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array, pa.Array]:
    """``(unit, parent, ordinal, n)``: the units of all texts with their document and place in it, and each text's count."""
    lists = pc.split_pattern(text, "\n")
    size = pc.cast(pc.list_value_length(lists), pa.int64())
    unit, parent = pc.list_flatten(lists), pc.cast(pc.list_parent_indices(lists), pa.int64())
    start = pc.subtract(pc.cumulative_sum(size), size)
    ordinal = pc.subtract(pa.array(range(len(unit)), pa.int64()), pc.take(start, parent))
    last = pc.equal(ordinal, pc.subtract(pc.take(size, parent), 1))
    # what follows the last line feed is a unit only if there is something
    kept = pc.invert(pc.and_(last, pc.equal(unit, "")))
    unit = pc.if_else(last, unit, pc.binary_join_element_wise(unit, "\n", ""))
    ends_open = pc.not_equal(pc.take(unit, pc.subtract(pc.cumulative_sum(size), 1)), "")
    n = pc.add(pc.subtract(size, 1), pc.cast(ends_open, pa.int64()))
    return unit.filter(kept), parent.filter(kept), ordinal.filter(kept), n


def pieces_of(text: pa.Array, h1: pa.Array, h2: pa.Array) -> tuple[pa.Array, list[pa.Array]]:
    """The number of units of each text, and its joined prefix, middle and suffix."""
    unit, parent, ordinal, n = units_of(text)
    places = pc.add(n, 1)
    one, other = modulo(h1, places), modulo(h2, places)
    cuts = pc.min_element_wise(one, other), pc.max_element_wise(one, other)
    inside = [pc.less(ordinal, pc.take(c, parent)) for c in cuts]
    role = pc.if_else(inside[0], PREFIX_ROLE, pc.if_else(inside[1], MIDDLE_ROLE, SUFFIX_ROLE))
    sizes = cuts[0], pc.subtract(cuts[1], cuts[0]), pc.subtract(n, cuts[1])
    joined = []
    for r, size in zip((PREFIX_ROLE, MIDDLE_ROLE, SUFFIX_ROLE), sizes, strict=True):
        offsets = pa.concat_arrays([pa.array([0], pa.int64()), pc.cumulative_sum(size)])
        lists = pa.ListArray.from_arrays(pc.cast(offsets, pa.int32()), unit.filter(pc.equal(role, r)))
        joined.append(pc.binary_join(lists, ""))
    return n, joined


def transform(batch: pa.RecordBatch, sentinels: tuple[str, str, str], rate: int, spm_rate: int) -> list[pa.Array]:
    """The columns of ``OUT`` for a batch with ``text, h1, h2, h3, h4``."""
    text = pc.fill_null(pc.cast(batch.column("text"), pa.string()), "")
    h1, h2, h3, h4 = (batch.column(f"h{k}") for k in range(1, 5))
    n, (prefix, middle, suffix) = pieces_of(text, h1, h2)
    hundred = pa.scalar(100, pa.int64())
    plain = pc.or_(pc.equal(text, ""), pc.greater_equal(modulo(h3, hundred), rate))
    for s in sentinels:
        plain = pc.or_(plain, pc.match_substring(text, s))
    form = pc.if_else(plain, PLAIN, pc.if_else(pc.less(modulo(h4, hundred), spm_rate), SPM, PSM))
    p, s, m = sentinels
    psm = pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, "")
    spm = pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, "")
    output = pc.if_else(plain, text, pc.if_else(pc.equal(form, SPM), spm, psm))
    none = pa.scalar(None, pa.int64())
    chars = [pc.if_else(plain, none, pc.cast(pc.utf8_length(x), pa.int64())) for x in (prefix, middle)]
    return [n, form, *chars, output]


def slices(batch: pa.RecordBatch, limit: int) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts have about ``limit`` bytes; a longer text comes alone."""
    size = pc.fill_null(pc.cast(pc.binary_length(batch.column("text")), pa.int64()), 0).to_pylist()
    start = held = 0
    for k, x in enumerate(size):
        if held and held + x > limit:
            yield batch.slice(start, k - start)
            start, held = k, 0
        held += x
    if start < batch.num_rows:
        yield batch.slice(start)


def fill_in_middle(docs: DataFrame, seed: int = SEED, sentinels: tuple[str, str, str] = SENTINELS, rate: int = RATE, spm_rate: int = SPM_RATE,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n, form, prefix_chars, middle_chars, output)``: one row per input row, in one pass without a shuffle.

    ``n`` counts a text's lines; ``form`` is ``plain`` (the text as it is), ``psm`` (prefix,
    suffix, middle) or ``spm`` (suffix, prefix, middle); the piece lengths are code points, null
    if plain.  A null or empty text gives an empty plain output, as does nothing to a text
    that holds a sentinel.  Rows with equal ids are cut by the same hash, a null id has one of
    its own; repeated rows are kept, an empty table gives no rows, texts of any length are
    taken whole, other columns are not read.
    """
    check_sentinels(sentinels)
    ready(docs.sparkSession)
    names = [c.split()[0] for c in OUT.split(", ")]

    def run(batches):
        for batch in batches:
            for part in slices(batch, SLICE_BYTES):
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *transform(part, sentinels, rate, spm_rate)], ["doc_id", *names])

    doc_id = F.col(id_col).cast("bigint")
    rows = docs.select(doc_id.alias("doc_id"), F.col(text_col).cast("string").alias("text"), *hash_words(seed, doc_id))
    return rows.mapInArrow(run, "doc_id bigint, " + OUT)


def restored(output: Column, form: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The exact text, rebuilt from output and form alone."""
    pattern = "|".join(map(re.escape, sentinels))

    def built(parts):
        # a leading empty part, then the pieces in the order of the form
        psm = F.concat(F.get(parts, 1), F.get(parts, 3), F.get(parts, 2))
        return F.when(form == PSM, psm).otherwise(F.concat(F.get(parts, 2), F.get(parts, 3), F.get(parts, 1)))

    return F.when(form == PLAIN, output).otherwise(built(F.split(output, pattern, -1)))
