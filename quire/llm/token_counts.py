"""Token counts by heap-and-linked-list byte-pair merging.

A word's symbols form a doubly linked list; a heap holds the mergeable adjacent pairs
by (rank, position).  Popping the lowest pair joins two symbols and offers the two new
neighbour pairs.  The count is the number of initial symbols minus the merges done: no
token identifiers are produced.

The vocabulary is a byte-level BPE with an end-of-word mark, read from a ``tokenizers``
JSON file (a parameter).  Text is normalised as that file says: NFC, white space as
separator, lower case character by character, then split into contractions, runs of
letters, single digits and runs of other characters.  Strings of special tokens inside a
text count as one token each, as the library does by default.

Every worker keeps the counts of chunks and words that it has seen, in dictionaries that
are emptied at a fixed size; they change the speed only.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from functools import lru_cache

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_pandas

OVER_LIMIT = 2048
CACHE_ENTRIES = 400_000
# Fixed value: the white space of the vocabulary's patterns.
SPACE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
ODD_SPACE = re.compile("[\x1c-\x1f]")  # white space for str.split() only


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in shown}
    for n, b in enumerate(b for b in range(256) if b not in out):
        out[b] = chr(256 + n)
    return [out[b] for b in range(256)]


class MergeCounter:
    """Counts tokens of texts under the vocabulary file at ``path``."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        ids = model["vocab"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.pairs = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.pairs[ids[a], ids[b]] = (rank, ids[a + b])
        symbols = byte_symbols()
        self.inner = [ids[s] for s in symbols]
        self.last = [ids[s + self.suffix] for s in symbols]
        special = [t["content"] for t in spec["added_tokens"] if t["special"]]
        self.special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self.special_strings = set(special)
        # Fixed value: the pattern that splits a chunk into words
        self.words = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}]+|[\p{{N}}]|[^{SPACE}\p{{L}}\p{{N}}]+").findall
        self.split = re.compile(f"[{SPACE}]+").split
        self.chunk_counts: dict[str, int] = {}
        self.word_counts: dict[str, int] = {}

    def merge_count(self, word: str) -> int:
        """Tokens of one word (not empty)."""
        raw = word.encode("utf-8")
        sym = [self.inner[b] for b in raw[:-1]]
        sym.append(self.last[raw[-1]])
        n = len(sym)
        pairs = self.pairs
        heap = [(*hit, i, sym[i], sym[i + 1]) for i in range(n - 1) if (hit := pairs.get((sym[i], sym[i + 1])))]
        # as entries: (rank, merged id, position, left id, right id); ranks are unique to a pair,
        # so equal ranks are settled by the position
        heapq.heapify(heap)
        prev, nxt = list(range(-1, n - 1)), list(range(1, n + 1))
        count = n
        while heap:
            _, new, i, left, right = heapq.heappop(heap)
            j = nxt[i] if sym[i] == left else n
            if j >= n or sym[j] != right:
                continue  # one side was merged meanwhile
            sym[i], sym[j] = new, -1
            nxt[i] = k = nxt[j]
            count -= 1
            if k < n:
                prev[k] = i
                if hit := pairs.get((new, sym[k])):
                    heapq.heappush(heap, (*hit, i, new, sym[k]))
            h = prev[i]
            if h >= 0 and (hit := pairs.get((sym[h], new))):
                heapq.heappush(heap, (*hit, h, sym[h], new))
        return count

    def chunk_count(self, chunk: str) -> int:
        """Tokens of a text without white space."""
        # a capital sigma at a word's end has a form of its own in str.lower()
        lowered = unicodedata.normalize("NFC", chunk).replace("Σ", "σ").lower()
        total = 0
        known = self.word_counts
        for word in self.words(lowered):
            got = known.get(word)
            if got is None:
                got = known[word] = self.merge_count(word)
            total += got
        return total

    def plain_count(self, text: str) -> int:
        chunks = text.split() if not ODD_SPACE.search(text) else [c for c in self.split(text) if c]
        known = self.chunk_counts
        for cache in (known, self.word_counts):
            if len(cache) > CACHE_ENTRIES:
                cache.clear()
        for chunk in set(chunks).difference(known):
            known[chunk] = self.chunk_count(chunk)
        return sum(map(known.__getitem__, chunks))

    def count(self, text: str) -> int:
        """Tokens of a whole text."""
        if self.special is None or "<|" not in text:
            return self.plain_count(text)
        return sum(1 if part in self.special_strings else self.plain_count(part) for part in self.special.split(text))


@lru_cache(maxsize=2)
def counter(path: str) -> MergeCounter:
    return MergeCounter(path)


def token_counts(docs: DataFrame, vocabulary: str, limit: int = OVER_LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)``: one row per input row, in one pass without a shuffle.

    A null text counts as empty: 0 bytes, 0 tokens.  Null ids and repeated rows are
    kept as they are.  Texts of any length are counted whole; an empty table gives no
    rows.  Other columns of ``docs`` are not read.
    """

    def count(batch):
        c = counter(vocabulary)
        texts = batch["text"].fillna("")
        batch["n_bytes"] = [len(t.encode("utf-8")) for t in texts]
        batch["n_tokens"] = [c.count(t) for t in texts]
        return batch[["doc_id", "n_bytes", "n_tokens"]]

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    out = map_pandas(rows, count, "doc_id bigint, n_bytes bigint, n_tokens bigint")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
