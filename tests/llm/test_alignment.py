"""Cross-tokenizer alignment against a plain version on the libraries' own tokens."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quire.llm import alignment
from quire.llm.packing import PATTERN
from quire.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
RANKS, JSON, MODEL = (public_tokenizers.path(n) for n in ("byte_bpe_50k.tiktoken", "byte_bpe_50k.json", "piece_bpe_32k.model"))
TEXTS = [
    None, "", " ", "a", "Hello, world!", " led by a blank", "two  blanks   three", "tabs\tand\nlines\r\n", "é日本語🎉 ﬁ", "▁mark", "<|endoftext|> and <s>",
    "x" * 5000, "#" * 3000, "ab " * 4000, "\0", "12345 67,890", "DON'T we'll", "Straße  ", "　wide", "é",
]


def plain_merge(a, b):
    out, i, j = [], 0, 0
    while i < len(a):
        same = a[i] == b[j]
        out.append((i, j, bool(same)))
        i, j = i + (a[i] <= b[j]), j + (b[j] <= a[i])
    return out


@given(st.lists(st.tuples(st.booleans(), st.booleans()), min_size=0, max_size=60), st.integers(1, 20))
@settings(max_examples=300, deadline=None)
def test_pieces_equal_a_plain_merge(cuts, piece):
    n = len(cuts) + 1
    a, b = (np.array([k + 1 for k, c in enumerate(cuts) if c[side]] + [n]) for side in (0, 1))
    got = alignment.overlaps(a, b, piece)
    assert list(zip(*(x.tolist() for x in got), strict=True)) == plain_merge(a.tolist(), b.tolist())
    cut_a, cut_b = alignment.split_merge(a, b, piece)
    work = np.diff(cut_a) + np.diff(cut_b)
    assert (work[:-1] == piece).all() and 0 <= work[-1] <= piece


def byte_decoder():
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    chars = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in shown)}
    return {c: b for b, c in chars.items()}


class Plain:
    """The contract, word for word, with the JSON file's library for A."""

    def __init__(self):
        self.a, self.b = Tokenizer.from_file(JSON), sentencepiece.SentencePieceProcessor(model_file=MODEL)
        self.a.encode_special_tokens = True
        self.chars = byte_decoder()

    def tokens(self, text):
        a = self.a.encode(" " + text, add_special_tokens=False).ids
        b = self.b.encode(text)
        a_bytes = [bytes(self.chars[c] for c in self.a.id_to_token(i)) for i in a]
        b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i in b for p in [self.b.id_to_piece(i)]]
        whole = (" " + text).encode()
        if not text or b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            return None
        return (a, np.cumsum([len(x) for x in a_bytes]).tolist()), (b, np.cumsum([len(x) for x in b_bytes]).tolist())

    def rows(self, docs):
        found, count = [], Counter()
        for doc_id, text in docs:
            both = self.tokens(text or "")
            if both is None:
                found.append((doc_id, None, 0, 0, ""))
                continue
            (a, ea), (b, eb) = both
            at_b = {e: j for j, e in enumerate(eb)}
            links = [(i, at_b[e]) for i, e in enumerate(ea) if e in at_b]
            groups, i0, j0 = [], 0, 0
            for i, j in links:
                groups.append(",".join(map(str, a[i0 : i + 1])) + "|" + ",".join(map(str, b[j0 : j + 1])))
                i0, j0 = i + 1, j + 1
            pairs = [(a[i], b[j]) for i, j in links]
            count.update(pairs)
            found.append((doc_id, pairs, len(a), len(b), hashlib.sha256(";".join(groups).encode()).hexdigest()))
        top = Counter()
        for (_, b), n in count.items():
            top[b] = max(top[b], n)
        out = []
        for doc_id, pairs, n_a, n_b, digest in found:
            p = pairs or []
            out.append((doc_id, n_a, n_b, len(p), len(p), digest, sum(count[x] == top[x[1]] for x in p), sum(count[x] for x in p)))
        return sorted(out, key=repr)


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum")


@pytest.fixture(scope="module")
def plain():
    return Plain()


@pytest.mark.parametrize("block_bytes,piece", [(1, 7), (3000, 100), (4 << 20, 1 << 16)])
def test_equals_a_plain_version(spark, plain, monkeypatch, block_bytes, piece):
    monkeypatch.setattr(alignment.align_block, "__defaults__", (piece,))
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(4, "Hello, world!"), (None, "Hello, world!"), (None, None), (4, "another text of 4")]
    docs = spark.createDataFrame([(*r, "clash", 1, b"x") for r in rows], "doc_id long, text string, pair string, block int, at binary").repartition(3)
    got = alignment.align(docs, RANKS, MODEL, block_bytes).select(*COLUMNS).collect()
    assert sorted(map(tuple, got), key=repr) == plain.rows(rows)


def test_whole_table_equals_a_plain_version(spark, plain):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op13_alignment"](spark, SF).select(*COLUMNS).collect()
    assert sorted(map(tuple, got), key=repr) == plain.rows(docs)


def test_empty_table(spark):
    assert alignment.align(spark.createDataFrame([], "doc_id long, text string"), RANKS, MODEL).collect() == []


def test_same_ids_as_the_json_file(plain):
    tok = alignment.tokenizers(RANKS, MODEL)
    texts = [t for t in TEXTS if t]
    assert PATTERN and [tok.a.encode(" " + t, disallowed_special=()) for t in texts] == [plain.a.encode(" " + t, add_special_tokens=False).ids for t in texts]
