"""Cross-tokenizer alignment by merge-path partitioning.

Two vocabularies cut the same bytes into tokens A and B.  The ends of a block of documents
(each document behind the one before) are two sorted lists; merging them yields the overlaps
of A and B tokens in order.  The merge is cut by diagonals: on the diagonal ``d`` a binary
search finds how many of the first ``d`` merged ends come from A, for all diagonals at once.
So the merge falls into independent pieces of equal work, however long or short documents
are.  Each piece emits its overlaps, and which of them end together; an overlap that
two pieces share is stitched at their boundary.  Tokens that end together are linked and
close a group.

How often a pair of ids is linked is counted over the whole corpus.  A task sums up the
links of each block of documents before anything is shuffled; the corpus-wide counts come
back to the blocks that hold the pair, so what travels is a block's distinct pairs and not
every link.  Documents meet the answers of their own block, a bounded group.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_batches, materialize
from .packing import PATTERN

PIECE = 1 << 16  # merged ends of a piece
BLOCK_BYTES = 4 << 20  # text of the documents of a block; a longer text is a block of its own
MARK = "▁"
B_BITS = 32  # a pair is its A id, shifted, and its B id
DOCUMENT = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_overlaps bigint, groups_sha256 string"
STATE = "block bigint, " + DOCUMENT + ", at binary, times binary, pair bigint, n bigint"
RESULT = DOCUMENT + ", n_best bigint, count_sum bigint"


# --------------------------------------------------------------------------- the merge
def split_merge(a: np.ndarray, b: np.ndarray, piece: int) -> tuple[np.ndarray, np.ndarray]:
    """Places ``(i, j)`` in the sorted lists where pieces of the merge begin, and the ends; of equal values A's comes first."""
    diagonal = np.append(np.arange(0, len(a) + len(b), piece), len(a) + len(b))
    low, high = np.maximum(0, diagonal - len(b)), np.minimum(diagonal, len(a))
    while (low < high).any():
        middle = (low + high) // 2
        # is A's element there among the first d of the merge?
        open_ = low < high
        before = np.zeros(len(diagonal), dtype=bool)
        m = middle[open_]
        before[open_] = a[m] <= b[diagonal[open_] - m - 1]
        low, high = np.where(open_ & before, middle + 1, low), np.where(open_ & ~before, middle, high)
    return low, diagonal - low


def merge_piece(a: np.ndarray, b: np.ndarray, i0: int, i1: int, j0: int, j1: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The overlaps of one piece as ``(A index, B index, end together)``, in order.

    Every end closes an overlap with the token of the other side that covers it.  A B end
    that equals the A end before it closes none of its own: the two tokens end together.
    """
    x, y = a[i0:i1], b[j0:j1]
    behind = np.searchsorted(y, x, "left")  # B ends before each A end
    ahead = np.searchsorted(x, y, "right")  # A ends up to each B end
    tied = (ahead > 0) & (x[np.maximum(ahead - 1, 0)] == y) if len(x) else np.zeros(len(y), dtype=bool)
    together = (behind < len(y)) & (y[np.minimum(behind, len(y) - 1)] == x) if len(y) else np.zeros(len(x), dtype=bool)
    # each end's place in the merged piece; tied B ends leave theirs empty
    at_x, at_y = np.arange(len(x)) + behind, np.arange(len(y)) + ahead
    left, right = np.empty(len(x) + len(y), dtype=np.int64), np.empty(len(x) + len(y), dtype=np.int64)
    flag, used = np.zeros(len(left), dtype=bool), np.ones(len(left), dtype=bool)
    left[at_x], right[at_x], flag[at_x] = np.arange(i0, i1), j0 + behind, together
    left[at_y], right[at_y], used[at_y] = i0 + ahead, np.arange(j0, j1), ~tied
    return left[used], right[used], flag[used]


def overlaps(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All overlaps of tokens with the sorted ends ``a`` and ``b`` (the last ends are equal): pieces, stitched."""
    cut_a, cut_b = split_merge(a, b, piece)
    made = []
    for i0, i1, j0, j1 in zip(cut_a, cut_a[1:], cut_b, cut_b[1:], strict=False):
        left, right, together = merge_piece(a, b, i0, i1, j0, j1)
        if j1 > j0 and i0 > 0 and a[i0 - 1] == b[j0]:
            # the piece before ended with the A end that this piece's first B end equals
            made[-1][2][-1] = True
            left, right, together = left[1:], right[1:], together[1:]
        if len(left):
            made.append((left, right, together))
    if not made:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    return tuple(map(np.concatenate, zip(*made, strict=True)))


# --------------------------------------------------------------------------- the two tokenizers
class Tokenizers:
    """Ids of both vocabularies and the bytes of every id."""

    def __init__(self, ranks: str, model: str):
        import sentencepiece
        import tiktoken

        with open(ranks, "rb") as f:
            known = {base64.b64decode(x): int(y) for x, y in map(bytes.split, f)}
        self.a = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=known, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=model)
        self.a_bytes = [b""] * (max(known.values()) + 1)
        for token, i in known.items():
            self.a_bytes[i] = token
        n = self.b.get_piece_size()
        piece = self.b.id_to_piece
        self.b_bytes = [bytes([int(piece(i)[3:5], 16)]) if self.b.is_byte(i) else piece(i).replace(MARK, " ").encode() for i in range(n)]
        self.sizes = [np.fromiter(map(len, x), dtype=np.int64, count=len(x)) for x in (self.a_bytes, self.b_bytes)]
        # an id's text with what may follow it: another token of the group, the group's other side, the next group
        text = lambda n, mark: np.array([f"{i}{mark}" for i in range(n)], dtype=object)
        self.inner = [text(len(x), ",") for x in (self.a_bytes, self.b_bytes)]
        self.last = [text(len(self.a_bytes), "|"), text(n, ";")]

    def ids(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Both id lists of each text; ``None`` where the bytes of one are not the text's behind a blank."""
        found = []
        for text, b in zip(texts, self.b.encode(texts, num_threads=1), strict=True):
            whole = b" " + text.encode("utf-8")
            if not text or b"".join(map(self.b_bytes.__getitem__, b)) != whole:
                found.append(None)
                continue
            a = self.a.encode_to_numpy(" " + text, disallowed_special=()).astype(np.int64)
            b = np.array(b, dtype=np.int64)
            # a byte-level vocabulary loses nothing, so its lengths tell; a token without bytes would close no range
            same = self.sizes[0][a].sum() == len(whole) and self.sizes[1][b].all()
            found.append((a, b) if same else None)
        return found


@lru_cache(maxsize=1)
def tokenizers(ranks: str, model: str) -> Tokenizers:
    return Tokenizers(ranks, model)


# --------------------------------------------------------------------------- a block of documents
def align_block(tok: Tokenizers, doc_ids: list, texts: list[str], piece: int = PIECE) -> tuple[list[tuple], np.ndarray, np.ndarray]:
    """Rows of ``DOCUMENT`` with the places and numbers of their pairs, the block's distinct pairs and how often each is linked."""
    ids = tok.ids(texts)
    held = [x for x in ids if x is not None]
    empty = np.zeros(0, dtype=np.int64)
    a, b = (np.concatenate([x[side] for x in held]) if held else empty for side in (0, 1))
    ends = [np.cumsum(tok.sizes[side][x]) for side, x in enumerate((a, b))]
    left, right, together = overlaps(*ends, piece)
    link_a, link_b = left[together], right[together]
    pairs, at, n = np.unique(a[link_a] << B_BITS | b[link_b], return_inverse=True, return_counts=True)
    # the groups' tokens in order, A's before B's: where each token's text goes
    group = np.arange(len(link_a))
    text = np.empty(len(a) + len(b), dtype=object)
    for side, (x, link, other) in enumerate(((a, link_a, link_b), (b, link_b, link_a))):
        sizes = np.diff(link, prepend=-1)
        of_token = np.repeat(group, sizes)
        # before a group's A tokens stand all B tokens of the groups before; before its B tokens all its A tokens too
        shift = np.append(0, other[:-1] + 1) if side == 0 else other + 1
        place = np.arange(len(x)) + (shift[of_token] if len(x) else empty)
        text[place] = tok.inner[side][x]
        text[place[link]] = tok.last[side][x[link]]
    # documents: a document's last tokens end together
    sizes_a, sizes_b = ([len(x[side]) for x in held] for side in (0, 1))
    bound = [np.append(0, np.cumsum(s)).astype(np.int64) for s in (sizes_a, sizes_b)]
    of_links = np.searchsorted(link_a, bound[0])
    of_overlaps = np.searchsorted(left, bound[0])
    rows, k = [], 0
    for doc_id, x in zip(doc_ids, ids, strict=True):
        if x is None:
            rows.append((doc_id, 0, 0, 0, 0, 0, "", b"", b""))
            continue
        first, end = of_links[k], of_links[k + 1]
        some, times = np.unique(at[first:end], return_counts=True)
        joined = "".join(text[bound[0][k] + bound[1][k] : bound[0][k + 1] + bound[1][k + 1]])[:-1]
        digest = hashlib.sha256(joined.encode()).hexdigest()
        links = int(end - first)
        rows.append((doc_id, len(x[0]), len(x[1]), links, links, int(of_overlaps[k + 1] - of_overlaps[k]), digest,
                     some.astype("<u4").tobytes(), times.astype("<u4").tobytes()))
        k += 1
    return rows, pairs, n


def blocks(batch: pd.DataFrame, limit: int) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of runs of documents with about ``limit`` characters."""
    ids, texts, size = [], [], 0
    for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
        text = text if isinstance(text, str) else ""
        if size and size + len(text) > limit:
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(None if pd.isna(doc_id) else int(doc_id))
        texts.append(text)
        size += len(text) + 100
    if ids:
        yield ids, texts


def align(docs: DataFrame, ranks: str, model: str, block_bytes: int = BLOCK_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_overlaps, groups_sha256, n_best, count_sum)``: one row per input row.

    ``ranks`` is the rank file of byte-level vocabulary A, which cuts a blank and the text,
    ``model`` the piece model B, which puts the blank in front itself.  ``n_best`` counts the
    links whose pair is the most frequent of its B id in the corpus (ties included),
    ``count_sum`` sums up the corpus-wide numbers of the links' pairs.  A null or empty text,
    or one whose bytes A or B changes, has zeros and an empty digest.  Null and repeated ids
    and repeated rows are documents of their own; texts of any length are aligned whole; an
    empty table gives no rows; other columns are not read.
    """
    names = [c.split()[0] for c in STATE.split(", ")]
    whole = {c.split()[0] for c in STATE.split(", ") if c.endswith("bigint")}

    def none(column: str, n: int) -> pd.Series:
        return pd.Series([None] * n, dtype="Int64" if column in whole else object)

    def run(batches):
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        tok = tokenizers(ranks, model)
        for batch in batches:
            for doc_ids, texts in blocks(batch, block_bytes):
                rows, pairs, n = align_block(tok, doc_ids, texts)
                table = pd.DataFrame([(block, *r, None, None) for r in rows], columns=names)
                yield table.astype({"doc_id": "Int64", "pair": "Int64", "n": "Int64"})
                if len(pairs):
                    found = {"block": block, "pair": pairs, "n": n}
                    yield pd.DataFrame({c: found.get(c, none(c, len(pairs))) for c in names})
                block += 1

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    state = materialize(map_batches(rows, run, STATE), "alignment")
    pairs = state.filter(F.col("pair").isNotNull()).select("block", "pair", "n")
    documents = state.filter(F.col("pair").isNull()).select("block", *(c.split()[0] for c in DOCUMENT.split(", ")), "at", "times")
    # at most one row per pair of ids, whatever the corpus
    total = pairs.groupBy("pair").agg(F.sum("n").alias("total"))
    of_b = Window.partitionBy(F.col("pair").bitwiseAND(F.lit((1 << B_BITS) - 1)))  # at most as many rows as A has ids
    total = total.withColumn("best", F.col("total") == F.max("total").over(of_b))
    answers = pairs.select(F.col("block").alias("of_block"), "pair").join(total, "pair")
    return documents.groupBy("block").cogroup(answers.groupBy("of_block")).applyInPandas(_answer, RESULT)


def _answer(mine: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
    """The documents of a block with the corpus-wide numbers of their pairs, which they name by place."""
    answers = answers.sort_values("pair")
    total, best = answers["total"].to_numpy(np.int64), answers["best"].to_numpy(bool)
    n_best, count_sum = [], []
    for at, times in zip(mine["at"], mine["times"], strict=True):
        at, times = np.frombuffer(at, "<u4"), np.frombuffer(times, "<u4").astype(np.int64)
        n_best.append(int(times[best[at]].sum()) if len(at) else 0)
        count_sum.append(int((times * total[at]).sum()) if len(at) else 0)
    out = mine.drop(columns=["block", "at", "times"]).assign(n_best=n_best, count_sum=count_sum)
    return out.astype({"doc_id": "Int64"})
