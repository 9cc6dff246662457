"""Near-duplicate clustering against a plain greedy pass over the same signatures."""

import random
import struct
import time

import pytest
from pyspark.sql import functions as F

from quire.operators import dedupe
from quire.operators.dedupe import (
    SENTINEL,
    cluster_keys,
    required_matches,
    shingles,
    signature_similarity,
    signatures,
)
from quire.options import AssessOptions


def greedy(sigs: dict, threshold: float) -> dict:
    """Key → leader by the sequential definition (keys in ascending order)."""
    keys = sorted(sigs)
    leader, taken = {}, set()
    for i, a in enumerate(keys):
        if a in taken:
            continue
        taken.add(a)
        leader[a] = a
        for b in keys[i + 1:]:
            if b in taken:
                continue
            same = sum(x == y for x, y in zip(sigs[a], sigs[b]))
            if same / len(sigs[a]) >= threshold:
                taken.add(b)
                leader[b] = a
    return leader


def test_shingles(spark):
    df = spark.createDataFrame([("a b c d",), ("hello",), ("Hello WORLD",)], "t string")
    got = df.select(
        shingles(F.col("t"), 3).alias("n3"), shingles(F.col("t"), 5).alias("n5"), shingles(F.col("t"), 2).alias("n2")
    ).collect()
    assert got[0].n3 == ["a b c", "b c d"]
    assert got[1].n5 == []
    assert got[2].n2 == ["hello world"]


def test_similarity(spark):
    df = spark.createDataFrame([([1, 2, 3, 4], [1, 2, 9, 9]), ([], [])], "a array<bigint>, b array<bigint>")
    assert [r[0] for r in df.select(signature_similarity(F.col("a"), F.col("b"))).collect()] == [0.5, 0.0]


def test_rarest_positions_are_lossless(spark):
    """Every pair that reaches the threshold shares a bucket; a template's positions make none."""
    rng = random.Random(5)
    for num_perm, t in ((16, 0.5), (32, 0.7), (32, 1.0)):
        need = required_matches(num_perm, t)
        bases = [[rng.randrange(1000) for _ in range(num_perm)] for _ in range(4)]
        rows = []
        for i in range(120):
            sig = list(rng.choice(bases))
            for _ in range(rng.randrange(num_perm)):
                sig[rng.randrange(num_perm)] = rng.randrange(1000)
            rows.append((f"r{i}", sig))
        found = {}
        for r in dedupe._buckets(spark.createDataFrame(rows, "rep string, sig array<bigint>"), num_perm, need).collect():
            found.setdefault(r.rep, set()).add(r.bucket)
        assert all(len(v) <= num_perm - need + 1 for v in found.values())
        for i, (a, x) in enumerate(rows):
            for b, y in rows[:i]:
                if sum(p == q for p, q in zip(x, y, strict=True)) >= need:
                    assert found[a] & found[b]


def test_packed_signatures(spark):
    sig = [0, 1, 2**31 - 2, SENTINEL]
    row = spark.createDataFrame([(sig,)], "s array<bigint>").select(dedupe.packed(F.col("s"), 4)).first()[0]
    assert list(struct.unpack(">4i", row)) == [0, 1, 2**31 - 2, -1]


@pytest.mark.parametrize("nearest", [1, 2])
def test_cut_lists_are_compared_again(spark, monkeypatch, nearest):
    """Members with more look-alikes than a comparison lists, all of which follow."""
    monkeypatch.setattr(dedupe, "NEAREST", nearest)
    for seed in (3, 4):
        rows = _random_corpus(seed, 70)
        opts = AssessOptions(ngram=3, num_perm=32, threshold=0.5)
        items = spark.createDataFrame(rows, "key string, text string")
        sigs = {r.key: list(r.sig) for r in signatures(items, opts).collect()}
        assert {r.key: r.leader for r in cluster_keys(items, opts).collect()} == greedy(sigs, 0.5)


def test_fixture_clusters(spark):
    pangram = "the quick brown fox jumps over the lazy dog " * 3
    items = spark.createDataFrame(
        [("a", pangram), ("b", pangram), ("c", "completely different text about other things here")],
        "key string, text string",
    )
    opts = AssessOptions(ngram=5, num_perm=64, threshold=0.9)
    got = {r.key: r.leader for r in cluster_keys(items, opts).collect()}
    assert got == {"a": "a", "b": "a", "c": "c"}


def test_short_texts_share_the_sentinel(spark):
    items = spark.createDataFrame([("x", "too short"), ("y", ""), ("z", "also short")], "key string, text string")
    sig = signatures(items).collect()
    assert all(s.sig == [SENTINEL] * 64 for s in sig)
    assert {r.leader for r in cluster_keys(items).collect()} == {"x"}


def _random_corpus(seed: int, n: int):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(40)]
    bases = [[rng.choice(vocab) for _ in range(30)] for _ in range(6)]
    rows = []
    for i in range(n):
        words = list(rng.choice(bases))
        for _ in range(rng.randrange(0, 6)):
            words[rng.randrange(len(words))] = rng.choice(vocab)
        rows.append((f"k{i:03d}", " ".join(words)))
    return rows


def test_matches_greedy_with_whole_and_cut_buckets(spark, monkeypatch):
    """Random near-copies: whole buckets, buckets cut into cells and plain greedy agree."""
    for seed in (1, 2):
        rows = _random_corpus(seed, 60)
        items = spark.createDataFrame(rows, "key string, text string")
        for t in (0.5, 0.75):
            opts = AssessOptions(ngram=3, num_perm=32, threshold=t)
            sigs = {r.key: list(r.sig) for r in signatures(items, opts).collect()}
            want = greedy(sigs, t)
            exact = {r.key: r.leader for r in cluster_keys(items, opts).collect()}
            assert exact == want
            # buckets cut into many cells
            monkeypatch.setattr(dedupe, "BLOCK", 2)
            assert {r.key: r.leader for r in cluster_keys(items, opts).collect()} == want
            monkeypatch.undo()


def test_large_buckets_are_held_against_leaders_only(spark, monkeypatch):
    """Of a bucket's undecided members only the first ones are compared with each other; leaders come out as by greedy."""
    dealt, cells = [], dedupe._cells

    def watched(members):
        sizes = members.groupBy("bucket").count().groupBy().agg(F.max("count")).first()
        dealt.append(sizes[0])
        return cells(members)

    for name, value in (("_cells", watched), ("BLOCK", 4), ("ASKED", 3), ("STEP", 1)):
        monkeypatch.setattr(dedupe, name, value)
    rows = _random_corpus(9, 120)
    items = spark.createDataFrame(rows, "key string, text string")
    opts = AssessOptions(ngram=3, num_perm=32, threshold=0.5)
    sigs = {r.key: list(r.sig) for r in signatures(items, opts).collect()}
    assert {r.key: r.leader for r in cluster_keys(items, opts).collect()} == greedy(sigs, 0.5)
    assert dealt[0] <= 4 and all(n <= 4 << k for k, n in enumerate(dealt))


def test_members_are_held_against_a_leader_once(spark, monkeypatch):
    """Leaders of several windows: each call has the new ones alone, and the smallest leader is still found."""
    asked, smallest = [], dedupe._smallest_leaders

    def watched(ask, leaders, *rest):
        asked.append({r.rep for r in leaders.collect()})
        return smallest(ask, leaders, *rest)

    for name, value in (("_smallest_leaders", watched), ("BLOCK", 4), ("NEAREST", 2)):
        monkeypatch.setattr(dedupe, name, value)
    items = spark.createDataFrame(_random_corpus(12, 120), "key string, text string")
    opts = AssessOptions(ngram=3, num_perm=32, threshold=0.6)
    sigs = {r.key: list(r.sig) for r in signatures(items, opts).collect()}
    assert {r.key: r.leader for r in cluster_keys(items, opts).collect()} == greedy(sigs, 0.6)
    assert len(asked) > 1 and sum(map(len, asked)) == len(set().union(*asked))


def test_signatures_of_unique_keys_need_no_exchange(spark):
    """Known and unknown characters, long and repeated texts: the values of the column expression, in one narrow pass."""
    latin = "".join(chr(c) + ("b c" if c % 3 else " d ") for c in range(0x20, 0x250))
    rows = [("a", latin), ("b", latin[:900].replace("\u0130", "")), ("c", "\u2014 Caf\u00e9 \u201cGr\u00fc\u00dfe\u201d \u20ac5 \u00bd m\u00b2 a\u00d7b"), ("d", "\u65e5\u672c \u8a9e \u03a3\u0391\u03a3 \u0130x"), ("e", None),
            ("f", "a\x00b c\x1fd-e f,g;h\r\ni"), ("g", " \n"), ("h", "one two"), ("i", "word " * 3000), *_random_corpus(5, 20)]
    items = spark.createDataFrame(rows, "key string, text string")
    opts = AssessOptions(ngram=3, num_perm=16)
    want = {r.key: list(r.sig) for r in items.select("key", dedupe.minhash(shingles(F.col("text"), 3), 16, opts.minhash_seed).alias("sig")).collect()}
    assert {r.key: list(r.sig) for r in dedupe.signature_table(items, opts).collect()} == want
    assert "Exchange" not in dedupe._text_signatures(items, opts)._jdf.queryExecution().executedPlan().toString()


def test_texts_of_a_repeated_key_count_as_one(spark):
    rows = [("a", "p q r s"), ("a", "t u v"), (None, "k l m"), (None, "n o p"), ("b", "p q r s"), ("c", "")]
    items = spark.createDataFrame(rows, "key string, text string")
    opts = AssessOptions(ngram=3, num_perm=8)
    one = {r.key: list(r.sig) for r in signatures(spark.createDataFrame([(str(i), t) for i, (_, t) in enumerate(rows)], "key string, text string"), opts).collect()}
    both = lambda a, b: [min(x, y) for x, y in zip(one[a], one[b], strict=True)]
    want = {"a": both("0", "1"), None: both("2", "3"), "b": one["4"], "c": one["5"]}
    for table in (signatures(items, opts), dedupe.signature_table(items, opts)):
        assert sorted(((r.key, list(r.sig)) for r in table.collect()), key=repr) == sorted(want.items(), key=repr)


def test_every_key_in_one_cluster(spark):
    rows = _random_corpus(7, 40)
    items = spark.createDataFrame(rows, "key string, text string")
    out = cluster_keys(items, AssessOptions(ngram=3, num_perm=16, threshold=0.6))
    assert out.count() == 40
    assert out.select("key").distinct().count() == 40
    # a leader leads itself
    lead = {r.key: r.leader for r in out.collect()}
    assert all(lead[v] == v for v in lead.values())


def test_threshold_edges(spark):
    items = spark.createDataFrame([("a", "x y z w v u t s"), ("b", "x y z w v u t s")], "key string, text string")
    none = AssessOptions(threshold=1.5)
    assert {r.key: r.leader for r in cluster_keys(items, none).collect()} == {"a": "a", "b": "b"}
    everything = AssessOptions(threshold=0.0)
    assert {r.leader for r in cluster_keys(items, everything).collect()} == {"a"}


def test_hot_group_default_limit(spark):
    """A third of the corpus are near-copies of one text; the result is the greedy one."""
    rng = random.Random(11)
    vocab = [f"v{i}" for i in range(300)]
    hot = [rng.choice(vocab) for _ in range(60)]
    rows = []
    for i in range(240):
        if i % 3 == 0:
            words = list(hot)
            for _ in range(rng.randrange(0, 3)):
                words[rng.randrange(len(words))] = rng.choice(vocab)
        else:
            words = [rng.choice(vocab) for _ in range(60)]
        rows.append((f"d{i:04d}", " ".join(words)))
    items = spark.createDataFrame(rows, "key string, text string")
    opts = AssessOptions(ngram=3, num_perm=64, threshold=0.7)
    sigs = {r.key: list(r.sig) for r in signatures(items, opts).collect()}
    got = {r.key: r.leader for r in cluster_keys(items, opts).collect()}
    assert got == greedy(sigs, 0.7)


def test_column_minhash_equals_aggregate_signatures(spark):
    from quire.operators.dedupe import minhash

    rows = _random_corpus(3, 12) + [("empty", ""), ("short", "two words")]
    items = spark.createDataFrame(rows, "key string, text string")
    opts = AssessOptions(ngram=3, num_perm=16)
    by_col = {r.key: list(r.sig) for r in items.select(
        "key", minhash(shingles(F.col("text"), 3), 16, opts.minhash_seed).alias("sig")).collect()}
    by_agg = {r.key: list(r.sig) for r in signatures(items, opts).collect()}
    assert by_col == by_agg


def test_hot_signature(spark):
    """Many exact copies of one text."""
    rows = [(f"c{i:03d}", "same words repeated in every copy of this text") for i in range(30)]
    rows += _random_corpus(4, 30)
    items = spark.createDataFrame(rows, "key string, text string")
    opts = AssessOptions(ngram=3, num_perm=32, threshold=0.7)
    sigs = {r.key: list(r.sig) for r in signatures(items, opts).collect()}
    assert {r.key: r.leader for r in cluster_keys(items, opts).collect()} == greedy(sigs, 0.7)


@pytest.mark.parametrize("n", [100, 300])
def test_templated_documents_end_soon(spark, n):
    """Unlike documents of one template: large buckets, few look-alikes; rounds do not slow down."""
    rng = random.Random(n)
    vocab = [f"x{i}" for i in range(500)]
    template = [rng.choice(vocab) for _ in range(120)]
    rows = []
    for i in range(n):
        words = list(template)
        for at in range(0, 120, 9):
            words[at] = rng.choice(vocab)
        rows.append((f"t{i:05d}", " ".join(words)))
    items = spark.createDataFrame(rows, "key string, text string")
    opts = AssessOptions(ngram=3, num_perm=64, threshold=0.7)
    sigs = {r.key: list(r.sig) for r in signatures(items, opts).collect()}
    started = time.perf_counter()
    assert {r.key: r.leader for r in cluster_keys(items, opts).collect()} == greedy(sigs, 0.7)
    assert time.perf_counter() - started < 120
