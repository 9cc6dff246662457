"""N-best segmentation into pieces of a SentencePiece model, and decoding.

A text is normalised as the model's file says for the public vocabulary: a blank is put
in front and blanks become the mark U+2581.  Its lattice has an edge for every piece at
every place; a character without a piece of its own has one edge that stands for its
UTF-8 byte pieces, at ``BYTE_PENALTY`` below the lowest score for each byte.  A path's
score is the sum of its pieces' scores; the N highest paths are wanted.

A forward Viterbi pass gives the best score of every prefix.  These are exact heuristics
for a backward A-star search from the end: a partial path's priority is its own score plus
the best score of the prefix left, so complete paths leave the queue best first.

No piece spans certain places (a mark after another character, or two characters that
stand side by side in no piece), so the lattice of a text is a chain of independent
units.  A unit's paths are found once and remembered; the N best paths of the text are
the N least sums of the units' losses against their best, again found best first.  Among
N paths only the N - 1 cheapest single changes can occur, which bounds that search.

The public model is a BPE model, so the highest-scored path is not always what its own
merge procedure picks; the pieces, ids, byte fallback and decoding are the model's.
"""

from __future__ import annotations

import heapq
import re
import zlib
from functools import lru_cache
from itertools import count, islice
from operator import add, itemgetter
from struct import pack

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_pandas

PATHS = 4
MARK = "▁"
BYTE_PENALTY = 10.0
CACHE_ENTRIES = 800_000
UNITS = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+").findall


class Segmenter:
    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        normal = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        # every beginning of a piece; its id and score if it is a piece itself
        self.edges: dict[str, tuple[int, float] | None] = {}
        beside = set()
        for i in normal:
            piece = model.id_to_piece(i)
            for k in range(1, len(piece)):
                self.edges.setdefault(piece[:k], None)
                beside.add(piece[k - 1 : k + 1])
            self.edges[piece] = (i, model.get_score(i))
        self.beside = beside
        # the pieces from their ends as a tree: character -> [score if a piece begins there, the characters before]
        self.endings: dict[str, list] = {}
        for piece, edge in self.edges.items():
            if edge:
                below = self.endings
                for char in reversed(piece):
                    step = below.setdefault(char, [None, {}])
                    below = step[1]
                step[0] = edge[1]
        self.packed = {piece: pack("<I", edge[0]) for piece, edge in self.edges.items() if edge}
        scores = [s[1] for s in self.edges.values() if s and s[1] > -1e8]  # runs of blanks are marked by a huge penalty
        self.byte_score = min(scores) - BYTE_PENALTY
        self.bytes = {int(model.id_to_piece(i)[3:5], 16): i for i in range(n) if model.is_byte(i)}
        self.decoded = [b""] * n
        for i in normal:
            self.decoded[i] = model.id_to_piece(i).encode()
        for b, i in self.bytes.items():
            self.decoded[i] = bytes([b])
        # stretch -> (best score, loss of the second path, ids of the best)
        self.units: dict[str, tuple[float, float, bytes]] = {}
        self.parts: dict[str, tuple[float, float, bytes]] = {}
        self.further: dict[str, list[tuple[float, bytes]]] = {}

    # ----------------------------------------------------------------- one stretch
    def byte_edge(self, char: str) -> tuple[tuple[int, ...], float]:
        raw = char.encode("utf-8", "replace")
        return tuple(self.bytes[b] for b in raw), self.byte_score * len(raw)

    def lattice(self, text: str) -> tuple[list[float], list[list[tuple[int, tuple[int, ...], float]]]]:
        """Best score of every prefix, and the edges ``(start, ids, score)`` into every place."""
        n = len(text)
        best = [0.0] + [-np.inf] * n
        into: list[list] = [[] for _ in range(n + 1)]
        edges = self.edges
        for i in range(n):
            here = best[i]
            for j in range(i + 1, n + 1):
                part = text[i:j]
                if part not in edges:
                    break
                if edge := edges[part]:
                    into[j].append((i, edge[:1], edge[1]))
                    if here + edge[1] > best[j]:
                        best[j] = here + edge[1]
            if not edges.get(text[i]):
                ids, score = self.byte_edge(text[i])
                into[i + 1].append((i, ids, score))
                best[i + 1] = max(best[i + 1], here + score)
        return best, into

    def paths(self, text: str):
        """All segmentations as ``(score, ids)``, best first: backward A-star on the Viterbi scores.

        Equal priorities (repeated characters have very many) go on where the least of the
        text is left, so that a path is finished before others of its score are begun.
        """
        best, into = self.lattice(text)
        turn = count()
        queue = [(-best[-1], len(text), 0, 0.0, None)]
        while queue:
            cost, at, _, tail, chain = heapq.heappop(queue)
            if at == 0:
                ids = []
                while chain:
                    ids += chain[0]
                    chain = chain[1]
                yield -cost, ids
                continue
            for start, piece, score in into[at]:
                heapq.heappush(queue, (-(best[start] + (tail + score)), start, next(turn), tail + score, (piece, chain)))

    def best_two(self, text: str) -> tuple[float, float, bytes]:
        """Best score, the second path's loss (infinite if there is none) and the best path's ids.

        One forward pass holds the best two scores of every prefix: a path to a place is the
        best or the second path to the place before, and an edge.  Of equal scores the
        longer last piece counts as the best.
        """
        n, back = len(text), text[::-1]
        best, second, came = [0.0], [-np.inf], [0]
        packed, endings = self.packed, self.endings
        for j in range(1, n + 1):
            first = other = -np.inf
            i, start, below = j, 0, endings
            if text[j - 1] not in packed:  # a byte edge
                start, cost = j - 1, self.byte_edge(text[j - 1])[1]
                first, other = best[start] + cost, second[start] + cost
            for char in back[n - j :]:
                step = below.get(char)
                if step is None:
                    break
                i -= 1
                cost, below = step
                if cost is not None:
                    score = best[i] + cost
                    if score >= first:
                        first, other, start = score, first, i
                    elif score > other:
                        other = score
                    score = second[i] + cost
                    if score > other:
                        other = score
            best.append(first)
            second.append(other)
            came.append(start)
        path, at = [], n
        while at:
            start = came[at]
            ids = packed.get(text[start:at])
            path.append(ids if ids is not None else b"".join(pack("<I", x) for x in self.byte_edge(text[start])[0]))
            at = start
        return best[n], best[n] - second[n], b"".join(reversed(path))

    def unit(self, word: str) -> tuple[float, float, bytes]:
        """``best_two`` of a stretch, put together from parts that no piece spans."""
        beside = self.beside
        whole = beside.issuperset(map(add, word, word[1:]))
        cuts = [0, len(word)] if whole else [0, *[k for k, two in enumerate(map(add, word, word[1:]), 1) if two not in beside], len(word)]
        found = []
        for a, b in zip(cuts, cuts[1:]):
            part = word[a:b]
            if (two := self.parts.get(part)) is None:
                two = self.parts[part] = self.best_two(part)
            found.append(two)
        if len(found) == 1:
            return found[0]
        scores, losses, ids = zip(*found)
        return sum(scores), min(losses), b"".join(ids)

    def losses(self, word: str, n: int) -> list[tuple[float, bytes]]:
        """``(loss against the best, ids)`` of up to ``n`` paths of a stretch after the best."""
        got = self.further.get(word)
        if got is None or len(got) < n:
            top = list(islice(self.paths(word), n + 1))
            got = self.further[word] = [(top[0][0] - score, np.array(ids, dtype="<u4").tobytes()) for score, ids in top[1:]]
        return got[:n]

    # ----------------------------------------------------------------- whole texts
    def chain(self, text: str) -> list[str]:
        """The text's independent stretches, each with its known best path."""
        words = text.split(" ")
        if MARK in text or not all(words):  # marks side by side: pieces may span them
            words = UNITS(MARK + text.replace(" ", MARK))
        else:
            words = [MARK + w for w in words]
        for cache in (self.units, self.parts, self.further):
            if len(cache) > CACHE_ENTRIES:
                cache.clear()
        for word in set(words).difference(self.units):
            self.units[word] = self.unit(word)
        return words

    def n_best(self, text: str, n: int = PATHS) -> list[tuple[float, bytes]]:
        """Up to ``n`` segmentations ``(score, ids as little-endian uint32)``, best first; none for an empty text."""
        if not text:
            return []
        words = self.chain(text)
        found = list(map(self.units.__getitem__, words))
        ids = list(map(itemgetter(2), found))
        top = sum(map(itemgetter(0), found))
        out = [(top, b"".join(ids))]
        if n == 1:
            return out
        # the cheapest single changes (loss, place, ids), then their least sums
        seconds = np.fromiter(map(itemgetter(1), found), dtype=float, count=len(found))
        changes = [(loss, at, other) for at in _least(seconds, n - 1) for loss, other in self.losses(words[at], n - 1)]
        changes = sorted(changes)[: n - 1]
        for loss, picked in _least_sums(changes, n - 1):
            other = list(ids)
            for at, part in picked:
                other[at] = part
            out.append((top - loss, b"".join(other)))
        return out

    def decode(self, ids: bytes) -> str:
        """Text of the ids; the blank put in front is taken away."""
        raw = b"".join(map(self.decoded.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))
        return raw.decode("utf-8", "replace").replace(MARK, " ").removeprefix(" ")


def _least(losses: np.ndarray, n: int) -> list[int]:
    """Places of the ``n`` least losses, ties to the earlier."""
    near = np.arange(len(losses)) if len(losses) <= n else np.flatnonzero(losses <= np.partition(losses, n - 1)[n - 1])
    return near[np.argsort(losses[near], kind="stable")][:n].tolist()


def _least_sums(changes: list[tuple[float, int, bytes]], n: int) -> list[tuple[float, tuple[tuple[int, bytes], ...]]]:
    """The ``n`` cheapest sets of changes, at most one for each place (changes are few and sorted)."""
    queue = [(c[0], (i,)) for i, c in enumerate(changes)]
    heapq.heapify(queue)
    out = []
    while queue and len(out) < n:
        loss, picked = heapq.heappop(queue)
        out.append((loss, tuple(changes[i][1:] for i in picked)))
        taken = {changes[i][1] for i in picked}
        for i in range(picked[-1] + 1, len(changes)):
            if changes[i][1] not in taken:
                heapq.heappush(queue, (loss + changes[i][0], (*picked, i)))
    return out


@lru_cache(maxsize=2)
def segmenter(path: str) -> Segmenter:
    return Segmenter(path)


def n_best_segmentations(docs: DataFrame, model: str, n: int = PATHS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, paths, round_trip)``: one row per input row, in one pass without a shuffle.

    ``paths``: ``array<struct<score double, n_tokens bigint, ids_crc32 bigint>>``, best first
    (fewer than ``n`` if the text has fewer segmentations; none for a null or empty text).
    ``round_trip`` tells whether the best path decodes to the text; a text that holds the
    blank mark itself does not, nor one with lone surrogates.  Null ids and repeated rows
    are kept; an empty table gives no rows; other columns are not read.
    """

    def run(batch):
        s = segmenter(model)
        paths, same = [], []
        for text in batch["text"].fillna(""):
            found = s.n_best(text, n)
            paths.append([{"score": p, "n_tokens": len(ids) // 4, "ids_crc32": zlib.crc32(ids)} for p, ids in found])
            same.append((s.decode(found[0][1]) if found else "") == text)
        return pd.DataFrame({"doc_id": batch["doc_id"], "paths": paths, "round_trip": same})

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return map_pandas(rows, run, "doc_id bigint, paths array<struct<score: double, n_tokens: bigint, ids_crc32: bigint>>, round_trip boolean")
