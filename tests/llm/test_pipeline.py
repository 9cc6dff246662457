"""The pipeline's stages on planted cases, against plain versions."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as cp

WORDS = [a + b + c for a in ("ba", "de", "ki", "lo") for b in ("ra", "ne", "ti") for c in ("m", "sto", "lin", "va")]
INSULTS = ["idiot", "scum", "moron", "loser", "pathetic"]
KEY = "AKIA" + "Q7" * 8


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = np.random.default_rng(12)
    rows, labels = [], []
    for i in range(500):
        text = ". ".join(" ".join(rng.choice(WORDS, 9)) for _ in range(12)) + "."
        toxic = junk = 0
        if i % 10 == 3:
            w = text.split(" ")
            for at in rng.choice(len(w), 5, replace=False):
                w[at] = str(rng.choice(INSULTS))
            text, toxic = " ".join(w), 1
        elif i % 10 == 6:
            text, junk = " ".join(x + str(rng.choice(["$$$", "&&&", "###"])) for x in text.split(" ")), 1
        rows.append((i, text, "en", "s", len(text)))
        if i < 400:
            labels.append((i, 1 - junk, toxic))
    rows.append((600, rows[0][1], "en", "s", 1))  # an exact copy
    near = rows[1][1].split(" ")
    rows.append((601, " ".join([*near, "kinem"]), "en", "s", 1))  # a near copy
    rows.append((602, rows[2][1].replace(".", f" key {KEY}.", 1), "en", "s", 1))
    rows.append((603, None, None, None, None))
    rows.append((None, rows[4][1] + " lost one without an id at all " + rows[5][1], None, None, 1))
    path = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path), rows, {i: (q, t) for i, q, t in labels}


def test_stages_by_themselves(spark, corpus, tmp_path):
    path, rows, labels = corpus
    docs = spark.read.parquet(f"{path}/documents.parquet")
    seen = {}
    for k, (name, stage) in enumerate(cp.STAGES):
        before = {r.doc_id: r for r in docs.collect()}
        out = stage(spark, docs, path)
        assert k == len(cp.STAGES) - 1 or tuple(out.columns) == cp.COLUMNS
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        seen[name] = (before, {r.doc_id: r for r in docs.collect()} if k < 4 else docs.collect())
    before, after = seen["toxicity"]
    toxic = {i for i in range(500) if i % 10 == 3}
    assert not toxic & set(after) and set(before) - toxic == set(after)
    before, after = seen["quality"]
    junk = {i for i in range(500) if i % 10 == 6}
    assert not junk & set(after) and {i for i in before if i is not None and i < 600} - junk <= set(after)
    before, after = seen["near duplicates"]
    assert set(before) - set(after) == {600, 601, 602} & set(before) and None in after
    before, after = seen["secrets"]
    assert set(before) == set(after)
    assert not any(r.text and "AKIA" in r.text for r in after.values())
    assert all(r.n_chars == len(r.text) for r in after.values() if r.text is not None)
    before, pieces = seen["packing"]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for i, r in before.items():
        ids = np.array([*library.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4")
        mine = sorted((p.start, p.length, p.ids_crc32) for p in pieces if p.doc_id == i)
        assert sum(n for _, n, _ in mine) == len(ids)
        assert all(zlib.crc32(ids[s : s + n].tobytes()) == c for s, n, c in mine)


def test_secret_stage_blanks_keys(spark, corpus):
    path, rows, _ = corpus
    docs = spark.read.parquet(f"{path}/documents.parquet").filter("doc_id = 602")
    out = cp.blank_secrets(spark, docs, path).collect()[0]
    assert KEY not in out.text and "[secret]" in out.text and out.n_chars == len(out.text)


def test_run_equals_the_stages(spark, corpus):
    path, _, _ = corpus
    got = cp.run(spark, path).collect()
    by_doc = {}
    for p in got:
        by_doc.setdefault(p.doc_id, []).append((p.start, p.length, p.doc_tokens))
    assert 600 not in by_doc and 0 in by_doc and 3 not in by_doc and 6 not in by_doc
    for pieces in by_doc.values():
        assert sum(n for _, n, _ in pieces) == pieces[0][2]


def test_empty_table(spark, corpus, tmp_path):
    path, _, _ = corpus
    docs = spark.read.parquet(f"{path}/documents.parquet").limit(0)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{path}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    assert cp.run(spark, str(tmp_path)).collect() == []
