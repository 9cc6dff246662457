"""N-gram Jaccard join: documents linked by shared word shingles, and their components.

Two documents link when the Jaccard similarity of their shingle sets reaches a percentage.
The links are found by a grouped prefix join:

1.  Documents with equal sets form a class; one set stands for it.
2.  Tokens (64-bit shingle hashes) have one global order: a fixed share of all tokens
    first, rare ones before frequent ones, then the others by hash.  Linked sets share a
    token among the first ``n - ceil(t n) + 1`` of either.  Only the share is counted over
    the corpus, a slice of the hashes at a time.  A token of one class alone cannot be shared: a class whose prefix
    consists of such tokens is done.
3.  Classes of the same prefix and size are collapsed into one group.
4.  Candidates are found and verified in steps, as only components are wanted.  First
    every group's leader is held against its members, and every prefix token's pivot
    against the groups in its bucket that pass the size filter, expanded to their
    members: a linear number of pairs, which joins most families of near copies.  Then
    those members that are not connected with their bucket's pivot are held against the
    first ``PIVOTS`` of them and of the others in the bucket, and those that this leaves
    against all members of other components, if a pair passes the size filter and the
    overlap bound.  A pair is looked at in one of its buckets.  That
    bound counts what either set shares with the pivot and what else of it another set
    may have (counted tokens of one class alone cannot be shared), and in what bits the
    parities of the sets' tokens differ (a token in one set alone flips one bit, so sets
    differ by at least as many tokens).  Every pair that could link is thus verified or
    already connected: no component is torn.

Pairs are verified on the whole sets, which only the documents in pairs get.  Every intermediate result is written to the shared
folder; no pairs are listed within a class, and nothing is collected but counts.
"""

from __future__ import annotations

from functools import lru_cache, reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ROW_KEY, Scratch, keyed_rows, map_batches, materialize
from .components import components

WORDS = 3
PERCENT = 90
TIER = 5  # one token in so many, or more (see ``tier``), is counted over the corpus and comes first in the order
PIVOTS = 8  # members of a bucket, connected with its pivot and not, that what is not connected is held against before all others
SKETCH = 32  # prefix tokens that tell in which of its buckets a pair is looked at
BITS = 512  # parities of a set's tokens; they tell sets of up to about 1,000 tokens apart, longer ones meet the other bounds
SLICES, TEXT_SLICES = 8, 4  # what travels whole, tokens by hash and texts by row, goes in so many slices, whose shuffle files never lie together
SLICE_BYTES = 16 << 20  # by the planner's statistics; a smaller table needs fewer slices
CACHE_ENTRIES = 100_000
MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
SHIFT = np.uint64(29)


class WordHashes(dict):
    """64-bit hashes of words, remembered."""

    def __missing__(self, word: bytes) -> int:
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


@lru_cache(maxsize=1)
def word_hashes() -> WordHashes:
    return WordHashes()


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles (as signed integers); empty without words.

    ASCII letters are lower-cased; words are the runs between ASCII white space.  A text of
    fewer words than a shingle has its whole sequence as the only one.
    """
    # bytes.lower() and bytes.split() know ASCII only, which is what is asked for
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.empty(0, dtype=np.int64)
    known = word_hashes()
    if len(known) > CACHE_ENTRIES:
        known.clear()
    h = np.fromiter(map(known.__getitem__, found), dtype=np.uint64, count=len(found))
    k = min(words, len(h))
    out = np.full(len(h) - k + 1, k, dtype=np.uint64)
    for i in range(k):
        out = (out ^ h[i : len(h) - k + 1 + i]) * MIX[i % 3]
        out ^= out >> SHIFT
    out *= MIX[0]
    out ^= out >> SHIFT
    return np.unique(out).view(np.int64)


def prefix_length(n, percent: int):
    """Tokens of a set of ``n`` among which a linked set must share one."""
    return n - (n * percent + 99) // 100 + 1


def tier(percent: int) -> int:
    """One token in how many is counted: half as many again as a prefix holds.

    What is not counted is in a prefix only where a set has too few counted tokens.  Nothing tells there
    what is frequent, so that a common line would gather all such sets in one bucket.
    """
    return max(1, min(TIER, 200 // (3 * max(1, 100 - percent))))


def in_tier(tokens: np.ndarray, one_in: int) -> np.ndarray:
    return tokens.view(np.uint64) % np.uint64(one_in) == 0


def parities(tokens: np.ndarray) -> np.ndarray:
    """``BITS`` bits as 64-bit integers: whether an odd number of tokens falls on each."""
    odd = np.bincount((tokens.view(np.uint64) % np.uint64(BITS)).astype(np.int64), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def link_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id)``: one row per input row.

    ``component_id`` is the smallest id reachable by links, the row's own included.  A null
    or empty text, or one without words, has no shingles and links with nothing.  Rows
    that repeat an id are documents of their own with that id; a row with a null id links
    as any other, but is never the smallest; alone it has a null component.  An empty
    table gives no rows; other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    made, of_class = _classes(keyed_rows(rows), words, percent)
    least = of_class.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = of_class.join(least, "root").select("node", "component_id")
    return made.select("doc_id", "n", "node").join(named, "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def first_of_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component of ``docs``, all columns: the smallest id's (a null comes last), of equal ids any one.

    Rows are told apart by themselves, not by their ids.  Rows without shingles all stay.
    """
    keyed = keyed_rows(docs)
    made, of_class = _classes(keyed.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"), *ROW_KEY), words, percent)
    kept = of_class.groupBy("root").agg(F.min("first").alias("first")).select(*(F.col("first")[c].alias(c) for c in ROW_KEY))
    copies = made.filter("node is not null").select(*ROW_KEY).join(kept, list(ROW_KEY), "left_anti")
    return keyed.join(materialize(copies, "copies"), list(ROW_KEY), "left_anti").select(*docs.columns)


def _classes(rows: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """``rows(doc_id, text, ROW_KEY)`` with ``n`` and ``node`` for ``text``, and ``(node, doc_id, first, root)`` of their classes.

    ``first``: the null flag, id and key of the class's first row.
    """

    one_in = tier(percent)

    def sets(batches):
        for b in batches:
            n, node, toks, more, bits = [], [], [], [], []
            for text in b["text"]:
                h = shingle_hashes(text if isinstance(text, str) else None, words)
                first = in_tier(h, one_in)
                counted, p = h[first], prefix_length(len(h), percent)
                n.append(len(h))
                node.append(xxhash.xxh64_intdigest(h.tobytes()) - (1 << 63) if len(h) else None)
                toks.append(counted)
                bits.append(parities(h) if len(h) else None)
                more.append(h[~first][: max(0, p - len(counted))] if len(h) else h)
            kept = {c: b[c] for c in ("doc_id", *ROW_KEY)}
            yield pd.DataFrame({**kept, "n": n, "node": pd.array(node, dtype="Int64"), "toks": toks, "more": more, "bits": bits})

    scratch = Scratch(rows.sparkSession)
    schema = "doc_id bigint, " + ", ".join(f"{c} bigint" for c in ROW_KEY) + ", n bigint, node bigint, toks array<bigint>, more array<bigint>, bits array<bigint>"
    shingles = scratch.table(map_batches(rows, sets, schema), "shingles")
    made = materialize(shingles.select("doc_id", *ROW_KEY, "n", "node"), "nodes")  # what results read
    firsts = made.filter("node is not null").groupBy("node").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", *ROW_KEY)).alias("first"))
    common = _common_tokens(shingles, scratch)
    prefixes = scratch.table(_prefixes(shingles, common, percent), "prefixes")
    scratch.drop("shingles", *(f"common tokens {part}" for part in range(SLICES)))
    listed = prefixes.select("node", F.explode("prefix").alias("h"))
    shared = listed.groupBy("h").agg(F.count(F.lit(1)).alias("members")).filter("members > 1").select("h")
    buckets = scratch.table(listed.join(shared, "h"), "buckets")  # (h, node)

    roots = _roots(rows, firsts, prefixes.drop("prefix"), buckets, words, percent, scratch)
    of_class = firsts.join(roots, "node", "left").select("node", "first", F.col("first")["doc_id"].alias("doc_id"), F.coalesce("root", "node").alias("root"))
    of_class = materialize(of_class, "classes")
    scratch.drop(*list(scratch.paths))
    return made, of_class


def _slices(df: DataFrame, most: int) -> range:
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return range(min(most, 1 + size // SLICE_BYTES))


def _common_tokens(made: DataFrame, scratch: Scratch) -> DataFrame:
    """``(h, node, df)``: the counted tokens that more than one class has, of ``df`` rows.

    Every counted token of every row travels by its hash, which is more than the texts take:
    one slice of the hashes at a time, so that a slice's shuffle files are gone before the next.
    """
    slices = []
    parts = _slices(made, SLICES)
    for part in parts:
        listed = made.select("node", F.explode("toks").alias("h")).filter(F.pmod("h", F.lit(len(parts))) == part)
        counted = listed.groupBy("h").agg(F.count(F.lit(1)).alias("df"), F.min("node").alias("lo"), F.max("node").alias("hi"))
        several = counted.filter("lo < hi").select("h", "df")
        slices.append(scratch.table(listed.join(several, "h"), f"common tokens {part}"))
    return reduce(DataFrame.unionByName, slices)


def _prefixes(made: DataFrame, common: DataFrame, percent: int) -> DataFrame:
    """``(node, n, lone, bits, grp, prefix)``: the prefix tokens that more than one class may have."""
    ordered = common.groupBy("node").agg(F.sort_array(F.collect_set(F.struct("df", "h"))).alias("tier"))
    # the counted tokens stay behind: those that are not common are lone
    sizes = made.filter("node is not null").select("node", "n", "more", "bits", F.size("toks").alias("counted"))
    classes = sizes.groupBy("node").agg(*(F.first(c).alias(c) for c in ("n", "more", "bits", "counted")))
    joined = classes.join(ordered, "node", "left").withColumn("lone", F.col("counted").cast("bigint") - F.coalesce(F.size("tier"), F.lit(0)))
    length = F.expr(f"n - (n * {percent} + 99) div 100 + 1")  # prefix_length
    alive = joined.withColumn("left", (length - F.col("lone")).cast("int")).filter("left > 0")
    first = F.transform(F.slice("tier", F.lit(1), F.col("left")), lambda t: t["h"])
    prefix = F.concat(F.coalesce(first, F.array().cast("array<bigint>")), F.col("more"))
    return alive.select("node", "n", "lone", "bits", prefix.alias("prefix")).withColumn("grp", F.xxhash64("n", "prefix"))


def _roots(rows: DataFrame, firsts: DataFrame, heads: DataFrame, buckets: DataFrame, words: int, percent: int, scratch: Scratch) -> DataFrame:
    """``(node, root)`` of all classes that link with another; ``heads(node, n, lone, bits, grp)`` describes the classes."""
    placed = buckets.groupBy("node").agg(F.slice(F.sort_array(F.collect_set("h")), 1, SKETCH).alias("sketch"))
    members = scratch.table(placed.join(heads, "node"), "members")
    scratch.drop("prefixes")

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        return _common(pairs, rows, firsts, words, scratch, name)

    # first step: pivots of buckets with the groups that fit, expanded to their members
    rank = F.struct("lone", "node")
    groups = members.groupBy("grp").agg(F.min(rank)["node"].alias("leader"))
    in_group = members.join(groups, "grp").select(F.col("leader").alias("a"), F.col("node").alias("b"))
    lists = buckets.join(members.drop("sketch", "bits"), "node")
    pivots = scratch.table(lists.groupBy("h").agg(F.min(rank)["node"].alias("pivot"), F.min_by("n", rank).alias("pivot_n")), "pivots")
    fits = F.least("n", "pivot_n") * 100 >= F.greatest("n", "pivot_n") * percent
    posted = lists.groupBy("h", "grp", "n").agg(F.count(F.lit(1)).alias("size"))  # a group once in a bucket
    met = posted.join(pivots, "h").filter(fits).select("grp", "pivot").distinct()
    in_bucket = met.join(members.select("grp", "node"), "grp").select(F.col("pivot").alias("a"), F.col("node").alias("b"))
    first = verified(_ordered(in_group.unionByName(in_bucket)), "verified")
    links = first.filter(_linked(percent)).select("a", "b")
    roots = components(links, scratch, "first roots")

    # what others may share of a set: all but lone tokens, inside the pivot (unknown where sizes exclude a link) or outside
    placed = lists.join(pivots, "h")
    placed = placed.withColumns({"a": F.least("pivot", "node"), "b": F.greatest("pivot", "node")}).join(first.select("a", "b", "common"), ["a", "b"], "left")
    placed = placed.withColumn("open", F.col("n") - F.col("lone"))
    inside = F.when(F.col("node") == F.col("pivot"), F.col("open")).otherwise(F.col("common"))
    placed = placed.select("h", "pivot", "node", "n", "lone", "open", inside.alias("inside"))
    placed = placed.withColumn("outside", F.col("open") - F.col("inside"))

    # second step: what is not connected with its pivot, against the first such members of the bucket, and the first others
    placed = scratch.table(_unsettled(placed, roots), "placed")
    scratch.drop("pivots", "first roots")
    place = F.row_number().over(Window.partitionBy("h", F.col("root") != F.col("pivot_root")).orderBy("lone", "node"))
    near = placed.withColumn("place", place).filter(F.col("place") <= PIVOTS).drop("place")
    met = scratch.table(_met(placed, near, members, percent, False), "met")
    second = verified(met.join(first, ["a", "b"], "left_anti"), "more verified")
    links = links.unionByName(second.filter(_linked(percent)).select("a", "b"))
    roots = components(links, scratch, "second roots")
    # third step: what is still not connected, against all other components of the bucket
    left = scratch.table(_unsettled(placed.drop("root", "pivot_root"), roots), "left")
    scratch.drop("placed", "second roots", "buckets")
    met = scratch.table(_met(left, left, members, percent, True), "last met")
    scratch.drop("left")
    done = first.select("a", "b").unionByName(second.select("a", "b"))
    more = verified(met.join(done, ["a", "b"], "left_anti"), "last verified").filter(_linked(percent)).select("a", "b")
    return components(links.unionByName(more), scratch, "roots")


def _unsettled(placed: DataFrame, roots: DataFrame) -> DataFrame:
    """``placed(h, pivot, node, ...)`` with ``root`` and ``pivot_root``, of the buckets that hold what is not connected with their pivot."""
    placed = placed.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    at_pivot = roots.select(F.col("node").alias("pivot"), F.col("root").alias("pivot_root"))
    placed = placed.join(at_pivot, "pivot", "left").withColumn("pivot_root", F.coalesce("pivot_root", "pivot"))
    return placed.join(placed.filter("root != pivot_root").select("h").distinct(), "h")


def _met(placed: DataFrame, others: DataFrame, members: DataFrame, percent: int, once: bool) -> DataFrame:
    """Distinct ``(a, b)``: what is not connected with its pivot and those ``others`` of its bucket that pass all bounds.

    A pair is looked at in the bucket of the least common token of its sketches, which is that of the prefixes (bounds
    hold in every bucket; where the sketches have nothing in common, every bucket shows the pair).  ``once``: two such
    members of a bucket are among each other's ``others`` and need to meet from one side alone.
    """
    columns = ("node", "n", "root", "open", "inside", "outside", "bits", "before")

    def described(rows: DataFrame) -> DataFrame:
        before = F.filter("sketch", lambda t: t < F.col("h"))
        return rows.join(members.select("node", "bits", "sketch"), "node").withColumn("before", before).drop("sketch")

    strays = described(placed.filter("root != pivot_root")).select("h", *(F.col(c).alias(f"s_{c}") for c in columns))
    overlap = (F.col("n") + F.col("s_n")) * percent / (100 + percent) - 1e-6
    # a common token is in the pivot and both sets, or in both but not in the pivot
    through = F.when(F.col("inside").isNotNull() & F.col("s_inside").isNotNull(), F.least("inside", "s_inside") + F.least("outside", "s_outside"))
    bound = F.least(through, "open", "s_open")  # a null is passed over
    differing = sum(F.bit_count(F.col("bits")[i].bitwiseXOR(F.col("s_bits")[i])) for i in range(BITS // 64))
    tested = (
        (F.col("root") != F.col("s_root"))
        & (F.least("n", "s_n") * 100 >= F.greatest("n", "s_n") * percent)
        & (bound >= overlap)
        & ((F.col("n") + F.col("s_n") - differing) / 2 >= overlap)
        & ~F.arrays_overlap("before", "s_before")
    )
    if once:
        tested = ((F.col("root") == F.col("pivot_root")) | (F.col("node") > F.col("s_node"))) & tested
    met = strays.join(described(others), "h").filter(tested)
    return met.select(F.least("s_node", "node").alias("a"), F.greatest("s_node", "node").alias("b")).distinct()


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _common(pairs: DataFrame, rows: DataFrame, firsts: DataFrame, words: int, scratch: Scratch, name: str) -> DataFrame:
    """The table ``name``: ``pairs(a, b)`` with the sizes of the whole sets and of their intersection."""

    def whole(batches):
        for b in batches:
            yield pd.DataFrame({"node": b["node"], "tokens": [shingle_hashes(t, words) for t in b["text"]]})

    pairs = scratch.table(pairs, "pairs")
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    # the text of one row of each class in a pair
    wanted = firsts.join(nodes, "node", "left_semi").select("node", *(F.col("first")[c].alias(c) for c in ROW_KEY))
    wanted = scratch.table(wanted, "wanted")
    sliced = []
    parts = _slices(rows, TEXT_SLICES)
    for part in parts:  # all texts travel by their row's key: a slice of the rows at a time
        here = F.pmod(F.xxhash64(*ROW_KEY), F.lit(len(parts))) == part
        texts = rows.filter(here).join(wanted.filter(here), list(ROW_KEY)).select("node", "text")
        sliced.append(scratch.table(map_batches(texts, whole, "node bigint, tokens array<bigint>"), f"sets {part}"))
    sets = reduce(DataFrame.unionByName, sliced)
    left = sets.select(F.col("node").alias("a"), F.col("tokens").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("tokens").alias("y"))
    joined = pairs.join(left, "a").join(right, "b")
    out = joined.select("a", "b", F.size("x").alias("na"), F.size("y").alias("nb"), F.size(F.array_intersect("x", "y")).alias("common"))
    out = scratch.table(out, name)
    scratch.drop("pairs", "wanted", *(f"sets {part}" for part in range(TEXT_SLICES)))
    return out


def _linked(percent: int):
    return F.col("common") * (100 + percent) >= (F.col("na") + F.col("nb")) * percent
