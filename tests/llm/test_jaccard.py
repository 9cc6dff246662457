"""The n-gram join against brute force over all pairs."""

import re
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import jaccard
from quire.llm.common import Scratch
from quire.llm.components import components


def shingles(text, k=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else ({tuple(words)} if words else set())


def brute(texts, percent=90):
    sets = [shingles(t) for _, t in texts]
    root = list(range(len(texts)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a, b in combinations(range(len(texts)), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(texts):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted(((i, len(s), least.get(find(k))) for k, ((i, _), s) in enumerate(zip(texts, sets))), key=repr)


def run(spark, texts, **kw):
    docs = spark.createDataFrame([(*t, 7, "z") for t in texts], "doc_id long, text string, n long, node string").repartition(4)
    return sorted(map(tuple, jaccard.link_components(docs, **kw).collect()), key=repr)


def family(rng, base, copies, edits, words):
    for _ in range(copies):
        text = list(base)
        for _ in range(rng.integers(0, edits + 1)):
            at = rng.integers(0, len(text))
            kind = rng.integers(0, 3)
            if kind == 0:
                text[at] = rng.choice(words)
            elif kind == 1:
                text.insert(at, rng.choice(words))
            elif len(text) > 1:
                del text[at]
        yield " ".join(text)


def test_pairs_of_many_buckets_travel_once(spark, monkeypatch):
    """Near copies that share many buckets: each pair is one row of the second step."""
    rng, met, table = np.random.default_rng(8), [], Scratch.table

    def watched(self, df, name):
        out = table(self, df, name)
        if name == "met":
            met.append((out.count(), out.select(F.least("a", "b"), F.greatest("a", "b")).distinct().count()))
        return out

    monkeypatch.setattr(Scratch, "table", watched)
    words = [f"w{i}" for i in range(400)]
    texts = list(enumerate(family(rng, rng.choice(words, 150), 80, 8, words)))
    assert run(spark, texts, percent=80) == brute(texts, 80)
    assert met[0][0] == met[0][1] > 0


def test_a_pair_is_made_in_one_bucket(spark, monkeypatch):
    """The join on buckets makes a row for a pair, not one for each bucket that both are in."""
    rng, made, table = np.random.default_rng(8), [], Scratch.table

    def watched(self, df, name):
        if name in ("met", "last met"):
            # the rows below the step that leaves distinct ones
            distinct = df._jdf.queryExecution().analyzed()
            assert distinct.nodeName() in ("Distinct", "Deduplicate")
            below = spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, distinct.child())
            made.append((below.count(), df.count()))
        return table(self, df, name)

    monkeypatch.setattr(Scratch, "table", watched)
    words = [f"w{i}" for i in range(400)]
    texts = list(enumerate(family(rng, rng.choice(words, 150), 80, 8, words)))
    assert run(spark, texts, percent=80) == brute(texts, 80)
    assert sum(rows for rows, _ in made) <= 2 * sum(pairs for _, pairs in made)


def test_a_common_line_makes_no_bucket_and_hashes_travel_in_slices(spark, monkeypatch):
    """Unlike texts with one common line: enough rare tokens are counted that the line is in no prefix."""
    rng, rows, table = np.random.default_rng(4), {}, Scratch.table

    def watched(self, df, name):
        out = table(self, df, name)
        rows[name] = out.count()
        return out

    monkeypatch.setattr(Scratch, "table", watched)
    monkeypatch.setattr(jaccard, "SLICE_BYTES", 1)
    line = " ".join(f"line{i}" for i in range(30))
    texts = [(i, " ".join(f"v{w}" for w in rng.integers(0, 10**6, 300)) + " " + line) for i in range(200)]
    assert run(spark, texts, percent=80) == brute(texts, 80)
    assert rows["members"] <= 4
    common = [n for name, n in rows.items() if name.startswith("common tokens")]
    assert len(common) == jaccard.SLICES and sum(common) >= 200


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(60)]
    passage = " ".join(rng.choice(words, 50))
    texts = []
    for n, copies, edits in ((120, 60, 8), (40, 40, 3), (12, 20, 2), (200, 15, 15), (5, 8, 1)):
        texts += family(rng, list(rng.choice(words, n)), copies, edits, words)
    texts += [passage + " " + " ".join(rng.choice(words, rng.integers(1, 60))) for _ in range(40)]
    texts += [" ".join(rng.choice(words, rng.integers(0, 5))) for _ in range(30)] + [texts[0]] * 12
    rows = list(enumerate(map(str, texts)))
    rng.shuffle(rows)
    rows = [(int(i), t) for i, t in rows]
    assert run(spark, rows) == brute(rows)


def test_parities_never_exceed_the_difference():
    rng = np.random.default_rng(3)
    for n, extra in ((0, 1), (5, 0), (40, 3), (300, 40), (5000, 700)):
        both = rng.integers(-(2**63), 2**63, n)
        a, b = (np.unique(np.concatenate([both, rng.integers(-(2**63), 2**63, extra)])) for _ in range(2))
        flips = sum(int(x).bit_count() for x in (jaccard.parities(a) ^ jaccard.parities(b)).view(np.uint64))
        assert len(jaccard.parities(a)) * 64 == jaccard.BITS
        assert flips <= len(np.setxor1d(a, b)) and (flips - len(np.setxor1d(a, b))) % 2 == 0


def test_chain_of_links_and_second_step(spark):
    # b2 links with b1 only through documents that are not their bucket's pivot
    words = [f"t{i}" for i in range(400)]
    rows = [(i, " ".join(words[3 * i : 3 * i + 130])) for i in range(60)]
    assert run(spark, rows) == brute(rows)


def test_edge_cases(spark):
    rows = [
        (5, None), (6, ""), (7, " \n\t"), (8, "one"), (9, "ONE "), (10, "one two"), (11, "One\x0bTwo"), (12, "É é"), (13, "é é"),
        (3, "a b c d"), (3, "a b c d"), (2, "x y z"), (2, "p q r s"), (None, "a b c d"), (None, "lonely words here"), (20, "w " * 60_000), (21, "w " * 3),
    ]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows, percent=50) == brute(rows, 50)
    assert jaccard.link_components(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_components(spark):
    rng = np.random.default_rng(0)
    path = [(i, i + 1) for i in range(0, 70)]
    hub = [(100, 100 + i) for i in range(1, 50)]
    rest = [(int(a), int(b)) for a, b in rng.integers(200, 400, (120, 2))]
    links = path + hub + rest + [(500, 500)]
    root = {}

    def find(a):
        while root.setdefault(a, a) != a:
            a = root[a]
        return a

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long"), Scratch(spark), "roots").collect()}
    assert got == {a: find(a) for a in {n for p in links if p[0] != p[1] for n in p}}
    assert components(spark.createDataFrame([], "a long, b long"), Scratch(spark), "roots").filter(F.lit(True)).collect() == []
