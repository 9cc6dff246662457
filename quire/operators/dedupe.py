"""Near-duplicate detection: shingles → MinHash → lossless candidates by rare
positions → leader clustering, all as DataFrame jobs.

Clustering semantics (equal to a greedy pass over the keys in ascending order):
the first key not yet taken becomes a leader and takes every later untaken key
whose signature similarity to *the leader* is ≥ threshold.  Equivalently a key is
a member iff some smaller leader is similar to it, and its leader is the smallest
such leader; leaders form the lexicographically-first maximal independent set of
the similarity graph.

Scale plan
----------
* Signatures are made of the bytes of batches of texts by numpy, a slice of a text's
  shingles at a time, in one narrow pass: no strings of shingles, no exchange.  Only
  rows of a key that is not unique are merged.
* Equal signatures collapse to one representative by 128 bits of hash with map-side
  partial aggregation, so a group of exact copies holding a third of the data
  never lands in one task; equal signatures always share a cluster.
* Candidates share one of their rarest positions.  With ``need`` = the fewest equal positions
  that reach the threshold, two look-alikes agree in one of the ``num_perm - need + 1``
  rarest (position, value) pairs of either, if rarity is one order for the corpus.  No
  qualifying pair is missed, and what a template puts into many signatures makes no bucket.
* All pairs are never listed.  Only the smallest ``BLOCK`` undecided members of every bucket
  are compared with each other (twice as many each time, if any are left), in cells of two
  blocks of bounded size; a task returns for each at most ``NEAREST`` look-alikes, the smallest ones.
* Leader rounds work on these short lists alone, without signatures: a member with a leading
  look-alike follows; one leads if its look-alikes all follow and no bucket holds smaller
  ones that were left out.  The number of rounds is the longest chain of look-alikes.
* All others are then held against the new leaders of their buckets alone, so the work grows
  with members times leaders, not with the square of a bucket.  Members of earlier rounds are held
  against the new leaders below the one that they follow, so that every pair meets once.
* The state of a round is written as parquet to the shared checkpoint folder and the
  round before is deleted: sizes stay known to the planner, rounds stay equally fast.
"""

from __future__ import annotations

import logging
import random
import time
from functools import reduce
from unicodedata import category

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import let, tokens_lower
from ..options import AssessOptions
from ..session import WIDE_AGGREGATE_CONF, delete_path, scoped_conf, ship_package, write_and_read
from .numbering import numbered

try:  # a third less for short inputs, without the library's lookups
    from _md5 import md5
except ImportError:
    from hashlib import md5

PRIME = 2147483647  # 2^31 - 1, modulus of the affine permutations
SENTINEL = 2**63 - 1  # start value of every slot; stays for an empty shingle set
NO_VALUE = 2**32 - 1  # stands for it in 32 bits
PIECE = 1 << 20  # bytes of text that are cut into shingles at a time
HASHED = 8192  # shingles that are hashed at a time
SPACE = 32
# Latin letters, punctuation and currency signs: all Unicode versions agree on them, and each is one character in lower case
KNOWN_RANGES = ((0x0000, 0x012F), (0x0131, 0x017F), (0x2000, 0x206F), (0x20A0, 0x20CF))
KNOWN = r"\A[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in KNOWN_RANGES) + r"]*\z"
# a known character of a word in lower case, or a space; others as they are
WORD_CHARS = np.arange(KNOWN_RANGES[-1][1] + 1, dtype=np.uint32)
for _a, _b in KNOWN_RANGES:
    WORD_CHARS[_a : _b + 1] = [ord(chr(i).lower()) if chr(i) == "_" or category(chr(i))[0] in "LN" else SPACE for i in range(_a, _b + 1)]
SMALL_BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}
BLOCK = 1024  # members of a block; a cell compares two blocks
ASKED = 8192  # members of a block that is held against leaders
STEP = 128  # leaders that a member is held against at a time, smallest first
NEAREST = 16  # look-alikes that a comparison lists for a member

UNDECIDED, LEADER, MEMBER = 0, 1, 2
LOG = logging.getLogger("quire.dedupe")


# --------------------------------------------------------------------------- shingles & signatures
def shingles(text: Column, n: int) -> Column:
    """Lower-cased ``\\w+`` tokens joined by a space in sliding windows of ``n``; none if fewer."""
    if n < 1:
        raise ValueError("ngram must be >= 1")

    def grams(toks):
        count = F.size(toks) - n + 1
        return F.when(
            count > 0,
            F.transform(F.sequence(F.lit(1), count), lambda i: F.array_join(F.slice(toks, i, n), " ")),
        ).otherwise(F.array().cast("array<string>"))

    return let(tokens_lower(F.coalesce(text, F.lit(""))), grams)


def base_hash(shingle: Column) -> Column:
    """32 bits of MD5 of the UTF-8 shingle, reduced modulo the prime."""
    return F.conv(F.substring(F.md5(shingle), 1, 8), 16, 10).cast("bigint") % F.lit(PRIME)


def permutation_params(num_perm: int, seed: int) -> list[tuple[int, int]]:
    """Seeded ``(a, b)`` of the affine hashes ``(a*h + b) mod p`` (a ≥ 1)."""
    rng = random.Random(seed)
    return [(rng.randrange(1, PRIME), rng.randrange(0, PRIME)) for _ in range(num_perm)]


def minhash(shingle_array: Column, num_perm: int, seed: int) -> Column:
    """``array<bigint>`` of length ``num_perm``: per permutation the minimum over the
    distinct shingles; an empty set keeps the sentinel in every slot."""
    params = F.array(*[F.struct(F.lit(a).cast("bigint").alias("a"), F.lit(b).cast("bigint").alias("b"))
                       for a, b in permutation_params(num_perm, seed)])

    def per_perm(hashes):
        return F.transform(
            params,
            lambda ab: F.coalesce(
                F.array_min(F.transform(hashes, lambda h: (h * ab["a"] + ab["b"]) % F.lit(PRIME))),
                F.lit(SENTINEL).cast("bigint"),
            ),
        )

    return let(F.transform(F.array_distinct(shingle_array), base_hash), per_perm)


def signature_similarity(a: Column, b: Column) -> Column:
    """Share of equal positions (0.0 when the first signature is empty)."""
    eq = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: x))
    return F.when(F.size(a) > 0, eq / F.size(a)).otherwise(F.lit(0.0))


def signatures(items: DataFrame, opts: AssessOptions = AssessOptions()) -> DataFrame:
    """``(key, sig)`` from ``(key, text)``: one row per key; the texts of a repeated key count as one."""
    return _merged(_text_signatures(items, opts), opts.num_perm)


def _merged(sigs: DataFrame, num_perm: int) -> DataFrame:
    """The signature of several shingle sets together holds the least of each position."""
    mins = [F.min(F.get("sig", i)).alias(f"m{i}") for i in range(num_perm)]
    return sigs.groupBy("key").agg(*mins).select("key", F.array(*(f"m{i}" for i in range(num_perm))).alias("sig"))


def _text_signatures(items: DataFrame, opts: AssessOptions) -> DataFrame:
    """``(key, sig)`` for every row of ``(key, text)``: the values of :func:`minhash`, without strings of shingles or a shuffle.

    A text of well-known characters alone (``KNOWN``) travels as it is, another as its lower-cased
    tokens, which the JVM finds by its own Unicode properties.
    """
    ship_package(items.sparkSession)
    text = F.coalesce("text", F.lit(""))
    words = F.when(text.rlike(KNOWN), text).otherwise(F.array_join(tokens_lower(text), " "))
    n, params = opts.ngram, permutation_params(opts.num_perm, opts.minhash_seed)
    if n < 1:
        raise ValueError("ngram must be >= 1")

    def run(batches):
        for batch in batches:
            sig = text_signatures(batch.column(1), n, params)
            ends = np.arange(len(sig) + 1, dtype=np.int32) * len(params)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(ends, sig.reshape(-1))], ["key", "sig"])

    kind = items.schema["key"].dataType.simpleString()
    return items.select("key", F.concat(words, F.lit(" ")).alias("words")).mapInArrow(run, f"key {kind}, sig array<bigint>")


def text_signatures(texts: pa.Array, n: int, params: list[tuple[int, int]]) -> np.ndarray:
    """Signatures, a row for each of ``texts``, which end with a space; of characters that are not ``KNOWN``, all count as lower-case letters."""
    texts = texts.cast(pa.large_binary())
    at = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, dtype=np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)
    out = np.full((len(params), len(texts)), NO_VALUE, dtype=np.uint32)
    start = 0
    while start < len(texts):
        stop = max(start + 1, int(np.searchsorted(at, at[start] + PIECE, "right")) - 1)
        _sign(*_characters(data[at[start] : at[stop]], at[start : stop + 1] - at[start]), n, params, out[:, start:stop])
        start = stop
    sig = out.T.astype(np.int64)
    sig[sig == NO_VALUE] = SENTINEL
    return sig


def _characters(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of UTF-8 as characters in lower case, a space for what is not of a word, and the places ``at`` among them."""
    if not len(data) or data.max() < 128:
        return WORD_CHARS[data], at
    at = np.searchsorted(np.flatnonzero(data & 0xC0 != 0x80), at)
    chars = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), dtype=np.uint32)
    return np.where(chars < len(WORD_CHARS), WORD_CHARS[np.minimum(chars, len(WORD_CHARS) - 1)], chars), at


def _sign(piece: np.ndarray, at: np.ndarray, n: int, params: list[tuple[int, int]], out: np.ndarray) -> None:
    """Lowers the columns of ``out`` to the least hashes of the texts ``piece[at[i]:at[i + 1]]``."""
    space = piece == SPACE
    ends_token = space.copy()
    ends_token[1:] &= ~space[:-1]
    ends_token[:1] = False
    tokens = np.searchsorted(np.flatnonzero(ends_token), at)  # that end before a text's start
    raw = piece[~space | ends_token].tobytes().decode("utf-32-le").encode()  # one space after every token
    ends = np.flatnonzero(np.frombuffer(raw, dtype=np.uint8) == SPACE)
    starts = np.concatenate([[0], ends[:-1] + 1])
    text = np.repeat(np.arange(len(at) - 1), np.diff(tokens))
    first = np.flatnonzero(np.arange(len(ends)) + n <= tokens[1:][text])
    text, starts, ends = text[first], starts[first], ends[first + n - 1]
    for i in range(0, len(first), HASHED):
        # 32 bits of MD5 of a shingle, see base_hash
        found = zip(starts[i : i + HASHED].tolist(), ends[i : i + HASHED].tolist(), strict=True)
        digests = b"".join([md5(raw[a:b]).digest() for a, b in found])
        h = np.frombuffer(digests, dtype=">u4")[::4].astype(np.uint64) % np.uint64(PRIME)
        of = text[i : i + HASHED]
        cuts = np.concatenate([[0], np.flatnonzero(of[1:] != of[:-1]) + 1])
        of = of[cuts]
        for k, (a, b) in enumerate(params):
            # (a h + b) mod 2^31 - 1: both halves added are below twice the modulus
            x = h * np.uint64(a) + np.uint64(b)
            low = ((x & np.uint64(PRIME)) + (x >> np.uint64(31))).astype(np.uint32)
            low = np.minimum(low, low - np.uint32(PRIME))  # wraps around if smaller
            out[k, of] = np.minimum(out[k, of], np.minimum.reduceat(low, cuts))


# --------------------------------------------------------------------------- candidates
def required_matches(num_perm: int, threshold: float) -> int | None:
    """Fewest equal positions m with m / num_perm ≥ threshold (None if unreachable)."""
    for m in range(num_perm + 1):
        if m / num_perm >= threshold:
            return m
    return None


def _buckets(reps: DataFrame, num_perm: int, need: int) -> DataFrame:
    """``(rep, bucket)``: the ``num_perm - need + 1`` rarest (position, value) pairs of every signature.

    Two signatures with ``need`` equal positions share one of these, if rarity is one order
    for the whole corpus.  What a template puts into many signatures is frequent and thus
    mostly left out.  A bucket is a 64-bit hash; a collision only adds candidates (all
    are verified), never loses one.
    """
    tokens = F.transform("sig", lambda v, i: F.xxhash64(i, v))
    listed = reps.select("rep", F.explode(tokens).alias("bucket"))
    # a token of one signature alone is rarest, but leads nowhere
    frequent = listed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    kept = num_perm - need + 1
    # as many as fit behind the tokens that no other signature has
    found = listed.join(frequent, "bucket").groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("n", "bucket"))).alias("found"))
    first = F.slice("found", F.lit(1), F.greatest(F.lit(0), F.size("found") - F.lit(num_perm - kept)))
    return found.select("rep", F.explode(F.transform(first, lambda t: t["bucket"])).alias("bucket"))


def packed(sig: Column, num_perm: int) -> Column:
    """The signature as ``num_perm`` big-endian 32-bit integers; the sentinel becomes -1."""
    value = lambda v: F.when(v == SENTINEL, F.lit("FFFFFFFF")).otherwise(F.lpad(F.hex(v), 8, "0"))
    return F.unhex(F.concat(*(value(F.get(sig, i)) for i in range(num_perm))))


# --------------------------------------------------------------------------- clustering
def collapse_signatures(sigs: DataFrame) -> DataFrame:
    """``(s1, s2, sig, rep)``: one representative (smallest key) per distinct signature."""
    return sigs.groupBy("s1", "s2").agg(F.first("sig").alias("sig"), F.min("key").alias("rep"))


def _with_signature_id(sigs: DataFrame) -> DataFrame:
    """Adds 128 bits that stand for the signature in joins."""
    return sigs.withColumns({"s1": F.xxhash64(F.lit(1), "sig"), "s2": F.xxhash64(F.lit(2), "sig")})


def signature_table(items: DataFrame, opts: AssessOptions = AssessOptions()) -> DataFrame:
    """:func:`signatures`, computed once and read back from the shared folder; only the rows of repeated keys are shuffled."""
    with scoped_conf(items.sparkSession, SMALL_BATCHES):
        sigs = write_and_read(_text_signatures(items, opts), "signatures")[0]
    repeated = write_and_read(sigs.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("key").alias("twice")), "repeated")[0]
    if repeated.isEmpty():
        return sigs
    of_repeated = F.col("key").eqNullSafe(F.col("twice"))
    merged = _merged(sigs.join(repeated, of_repeated, "left_semi"), opts.num_perm)
    with scoped_conf(items.sparkSession, WIDE_AGGREGATE_CONF):
        return write_and_read(sigs.join(repeated, of_repeated, "left_anti").unionByName(merged), "signatures")[0]


def cluster_keys(items: DataFrame, opts: AssessOptions = AssessOptions()) -> DataFrame:
    """``(key, leader, similarity)`` for every key of ``(key, text)``.

    ``similarity`` is the signature similarity of the key to its leader (1.0 for
    leaders and for exact signature copies).
    """
    if opts.num_perm < 1:
        raise ValueError("num_perm must be >= 1")
    ship_package(items.sparkSession)
    sigs = signature_table(items, opts)
    need = required_matches(opts.num_perm, opts.threshold)
    if need is None:
        # nothing can reach the threshold, not even equal signatures
        return sigs.select("key", F.col("key").alias("leader"), F.lit(1.0).alias("similarity"))
    if need == 0:
        # everything is similar to everything: one cluster led by the smallest key
        # a one-row global aggregate (bounded) read back as literals
        first = sigs.groupBy().agg(F.min("key").alias("leader"), F.min_by("sig", "key").alias("lsig")).first()
        lsig = F.array(*[F.lit(v).cast("bigint") for v in (first["lsig"] or [])])
        return sigs.select(
            "key", F.lit(first["leader"]).alias("leader"), signature_similarity(lsig, F.col("sig")).alias("similarity")
        )
    sigs = _with_signature_id(sigs)
    reps, _ = write_and_read(collapse_signatures(sigs), "reps")
    rep_leader = _leader_rounds(reps, need, opts)
    # rep → leader, then every key through its signature: an inner join of one row per
    # signature, whose hot side adaptive execution may split
    of_sig = reps.select("s1", "s2", "rep").join(rep_leader, "rep", "left").select(
        "s1", "s2", F.coalesce("leader", "rep").alias("leader"), F.coalesce("similarity", F.lit(1.0)).alias("similarity")
    )
    out = sigs.select("key", "s1", "s2").join(of_sig, ["s1", "s2"])
    return write_and_read(out.select("key", "leader", "similarity"), "clusters")[0]


# --------------------------------------------------------------------------- leader rounds
def _cells(members: DataFrame) -> DataFrame:
    """Deal ``(bucket, rep, sig)`` out to cells of two blocks of a bucket."""
    sizes = members.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int").alias("blocks"), F.count(F.lit(1)).alias("n"))
    dealt = members.join(sizes.filter("n > 1").drop("n"), "bucket")
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cell = [F.col("bucket"), F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")]
    dealt = dealt.select(*cell, "block", "rep", "sig")
    return dealt.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high")


def _by_cell(cells: DataFrame, compared, num_perm: int, schema: str) -> DataFrame:
    """``compared(table, sig)`` for the rows of every cell (``bucket, low, high``); it yields rows of ``schema``."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches):
        held = None
        for batch in batches:
            table = batch if held is None else pd.concat([held, batch], ignore_index=True)
            keys = table[["bucket", "low", "high"]].to_numpy()
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
            last = int(cuts[-1]) if len(cuts) else 0
            yield from rows(table.iloc[:last], cuts[:-1])
            held = table.iloc[last:]
        if held is not None:
            yield from rows(held, np.array([], dtype=int))

    def rows(table, cuts):
        if not len(table):
            return
        sig = np.frombuffer(b"".join(table["sig"]), dtype=">i4").reshape(len(table), num_perm).astype(np.int32)
        columns = {c: table[c].to_numpy() for c in table.columns if c != "sig"}
        out = []
        for a, b in zip([0, *cuts], [*cuts, len(table)], strict=True):
            out += compared({c: v[a:b] for c, v in columns.items()}, sig[a:b])
        if out:
            yield pd.DataFrame(out, columns=names)

    return cells.mapInPandas(run, schema)


def _near(low_bytes, some, others):
    """Equal bytes of two lists of rows: a bound from above of their equal positions."""
    near = np.zeros((len(some), len(others)), dtype=np.uint8 if low_bytes.shape[1] < 256 else np.uint16)
    for p in range(low_bytes.shape[1]):
        near += low_bytes[some, p][:, None] == low_bytes[others, p][None, :]
    return near


def _look_alikes(members: DataFrame, need: int, num_perm: int) -> DataFrame:
    """``(rep, near)``: the ``NEAREST`` smallest smaller look-alikes of every one of ``members(bucket, rep, sig)``.

    ``near`` is an array of ``(near, similarity)`` in ascending order.  All members of a cell
    are compared; a cell returns at most ``NEAREST`` rows per member.
    """

    def compared(cell, sig):
        order = np.argsort(cell["rep"], kind="stable")
        rep, block, sig = cell["rep"][order], cell["block"][order], sig[order]
        every = np.arange(len(rep))
        # one byte of each value bounds the equal positions from above; pairs that reach
        # the bound are compared in full
        low_bytes = (sig % 251).astype(np.uint8)
        for at in range(0, len(rep), BLOCK):
            some = every[at : at + BLOCK]
            before = every[: at + len(some)]
            hits = (_near(low_bytes, some, before) >= need) & (before[None, :] < some[:, None])
            if cell["low"][0] != cell["high"][0]:
                hits &= block[before][None, :] != block[some][:, None]
            for i in np.flatnonzero(hits.any(1)):
                k, candidates, found = some[i], np.flatnonzero(hits[i]), 0
                for few in np.array_split(candidates, range(2 * NEAREST, len(candidates), 1024)):  # the first are mostly right
                    same = (sig[few] == sig[k]).sum(1)
                    for j in np.flatnonzero(same >= need)[: NEAREST - found]:
                        yield rep[k], rep[few[j]], same[j] / num_perm
                        found += 1
                    if found == NEAREST:
                        break

    found = _by_cell(_cells(members), compared, num_perm, "rep string, near string, similarity double")
    # several buckets find the same pair
    return found.groupBy("rep").agg(F.slice(F.sort_array(F.collect_set(F.struct("near", "similarity"))), 1, NEAREST).alias("near"))


def _smallest_leaders(asked: DataFrame, leaders: DataFrame, mem: DataFrame, sigs: DataFrame, need: int, num_perm: int) -> DataFrame:
    """``(rep, leader, similarity)``: the smallest of ``leaders(rep)`` below ``bound`` that is similar to one of ``asked(rep, bound)``.

    A bucket's leaders and those that ask are dealt out in blocks; a cell holds one of each.
    """
    lead = mem.join(leaders, "rep")
    sizes = lead.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int").alias("highs"), F.min("rep").alias("first"))
    ask = mem.join(asked, "rep").join(sizes, "bucket").filter("first < bound").drop("first")
    lows = ask.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / F.lit(ASKED)).cast("int").alias("lows"))
    block = lambda n: F.pmod(F.xxhash64("rep"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    ask = ask.join(lows, "bucket").withColumn("low", block("lows")).withColumn("high", each("highs"))
    lead = lead.join(sizes, "bucket").join(lows, "bucket").withColumn("high", block("highs")).withColumn("low", each("lows"))
    rows = ask.select("bucket", "low", "high", "rep", "bound").unionByName(lead.select("bucket", "low", "high", "rep", F.lit(None).cast("string").alias("bound")))
    cells = rows.join(sigs, "rep").repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high")

    def compared(cell, sig):
        rep, bound = cell["rep"], cell["bound"]
        leads = pd.isna(bound)
        lead, then = np.flatnonzero(leads), np.flatnonzero(~leads)
        lead, then = lead[np.argsort(rep[lead], kind="stable")], then[np.argsort(bound[then], kind="stable")]
        upto = np.searchsorted(rep[lead], bound[then])  # the leaders below a row's bound
        low_bytes = (sig % 251).astype(np.uint8)
        for at in range(0, len(then), BLOCK):
            some, ends = then[at : at + BLOCK], upto[at : at + BLOCK]
            for start in range(0, int(ends[-1]) if len(ends) else 0, STEP):
                few = lead[start : min(start + STEP, ends[-1])]
                hits = (_near(low_bytes, some, few) >= need) & (np.arange(start, start + len(few))[None, :] < ends[:, None])
                left = np.ones(len(some), dtype=bool)
                for i in np.flatnonzero(hits.any(1)):
                    candidates = few[np.flatnonzero(hits[i])]
                    same = (sig[candidates] == sig[some[i]]).sum(1)
                    right = np.flatnonzero(same >= need)
                    if len(right):  # in order: the first is the smallest
                        yield rep[some[i]], rep[candidates[right[0]]], same[right[0]] / num_perm
                        left[i] = False
                some, ends = some[left], ends[left]
                if not len(some):
                    break

    found = _by_cell(cells, compared, num_perm, "rep string, leader string, similarity double")
    return found.groupBy("rep").agg(F.min(F.struct("leader", "similarity")).alias("b")).select("rep", "b.leader", "b.similarity")


def _leader_rounds(reps: DataFrame, need: int, opts: AssessOptions) -> DataFrame:
    """``(rep, leader, similarity)`` of the representatives that share a bucket with another."""
    spark = reps.sparkSession
    written: dict[str, str] = {}

    def kept(df: DataFrame, name: str) -> DataFrame:
        """``df`` written and read back; a table that had the name is deleted after that."""
        table, path = write_and_read(df, name)
        if name in written:
            delete_path(spark, written[name])
        written[name] = path
        return table

    every = _buckets(reps, opts.num_perm, need)
    shared = every.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    mem = kept(every.join(shared, "bucket").select("bucket", "rep"), "buckets")
    per_rep = kept(mem.groupBy("rep").agg(F.count(F.lit(1)).alias("buckets")), "per-rep")
    sigs = kept(reps.join(per_rep, "rep", "left_semi").select("rep", packed(F.col("sig"), opts.num_perm).alias("sig")), "packed")
    open_ = sigs.select("rep")
    leaders, members = [], []
    window, rounds, started = BLOCK, 0, time.perf_counter()
    undecided = open_.count()
    while undecided:
        # the first of every bucket; a smaller look-alike of one that is so in all its buckets is among them
        place = F.row_number().over(Window.partitionBy("bucket").orderBy("rep"))
        first = kept(mem.join(open_, "rep").withColumn("place", place).filter(F.col("place") <= window).drop("place"), "first")
        closed = first.groupBy("rep").agg(F.count(F.lit(1)).alias("n")).join(per_rep, "rep").select("rep", (F.col("n") == F.col("buckets")).alias("closed"))
        lists = kept(_look_alikes(first.join(sigs, "rep"), need, opts.num_perm), "look-alikes")
        state = kept(closed.join(lists, "rep", "left").select("rep", "closed", "near", F.lit(UNDECIDED).alias("status")), "state")
        left, before = state.count(), None
        while left and left != before:
            rounds, before = rounds + 1, left
            state = kept(_decided(state), "state")
            left = state.filter(F.col("status") == UNDECIDED).count()
        leading = kept(state.filter(F.col("status") == LEADER).select("rep"), f"leaders-{len(leaders)}")
        leaders.append(leading)
        near = state.filter(F.col("status") == MEMBER).select("rep", F.explode("near").alias("n")).select("rep", "n.*")
        led = near.join(leading.select(F.col("rep").alias("near")), "near").groupBy("rep").agg(F.min(F.struct(F.col("near").alias("leader"), "similarity")).alias("b"))
        rest = open_.join(state.filter(F.col("status") != UNDECIDED), "rep", "left_anti")
        # who has a leader asks again if a smaller one may be new: one that is left out of its buckets' first ones, or any at all
        unsure = led.join(closed.filter(~F.col("closed")), "rep", "left_semi").select("rep", F.col("b")["leader"].alias("bound"))
        earlier = [m.select("rep", F.col("leader").alias("bound")) for m in members]
        asked = reduce(DataFrame.unionByName, [rest.select("rep", F.col("rep").alias("bound")), unsure, *earlier])
        taken = _smallest_leaders(asked, leading, mem, sigs, need, opts.num_perm)
        members.append(kept(led.select("rep", "b.leader", "b.similarity").unionByName(taken), f"members-{len(members)}"))
        open_ = kept(rest.join(members[-1], "rep", "left_anti"), "open")
        undecided = open_.count()
        LOG.info("window %d: %d undecided after %d rounds (%.1fs)", window, undecided, rounds, time.perf_counter() - started)
        window *= 2
    if not leaders:
        return sigs.select("rep", F.col("rep").alias("leader"), F.lit(1.0).alias("similarity"))
    both = reduce(DataFrame.unionByName, members).groupBy("rep").agg(F.min(F.struct("leader", "similarity")).alias("b"))
    result, _ = write_and_read(both.select("rep", "b.leader", "b.similarity"), "rep-leaders")
    for done in written.values():
        delete_path(spark, done)
    return result


def _decided(state: DataFrame) -> DataFrame:
    """One round: ``state(rep, closed, near, status)`` with those decided whose look-alikes allow it.

    A look-alike that leads makes a member.  If all look-alikes are members, or there are
    none, one whose list is complete leads; the list is not complete where it is cut at
    ``NEAREST`` or a bucket's first ones do not hold all smaller ones (``closed``).
    """
    open_ = state.filter(F.col("status") == UNDECIDED)
    asked = open_.select("rep", F.explode_outer("near").alias("n")).select("rep", F.col("n.near").alias("near"))
    known = state.select(F.col("rep").alias("near"), F.col("status").alias("of_near"))
    seen = asked.join(known, "near", "left").groupBy("rep").agg(
        F.count("near").alias("n"), F.count_if(F.col("of_near") == LEADER).alias("leading"), F.count_if(F.col("of_near") == MEMBER).alias("following")
    )
    leads = F.col("closed") & (F.col("following") == F.col("n")) & (F.col("n") < NEAREST)
    decided = F.when(F.col("leading") > 0, F.lit(MEMBER)).when(leads, F.lit(LEADER)).otherwise(F.lit(UNDECIDED))
    return state.filter(F.col("status") != UNDECIDED).unionByName(open_.drop("status").join(seen, "rep").select("rep", "closed", "near", decided.alias("status")))


# --------------------------------------------------------------------------- corpus helpers
def dedupe_items(assessed: DataFrame, scope: str = "first_section") -> DataFrame:
    """``(key, text)`` compared for duplicates: section 0's content (reference) or the whole text."""
    if scope == "document":
        text = F.coalesce(F.col("text"), F.lit(""))
    elif scope == "first_section":
        text = F.coalesce(F.get("raw_sections", 0)["content"], F.lit(""))
    else:
        raise ValueError(f"unknown dedupe scope {scope!r}")
    return assessed.select(F.col("path").alias("key"), text.alias("text"))


def cluster_table(key_leader: DataFrame) -> DataFrame:
    """``(leader, size)`` per cluster — bounded aggregate, no member lists."""
    return key_leader.groupBy("leader").agg(F.count(F.lit(1)).cast("bigint").alias("size"))


def cluster_members(key_leader: DataFrame) -> DataFrame:
    """``(leader, position, key)``: the members of every cluster in input order, the leader at 0.

    A leader is its cluster's smallest key, and input order is the order of the keys.
    """
    return numbered(key_leader.select("leader", "key"), ["leader"], ["key"]).select("leader", "position", "key")
