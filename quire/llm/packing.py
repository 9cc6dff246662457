"""Bounded-space online packing of tokenized documents into fixed-length sequences.

Each partition keeps a fixed number of open windows.  A document is cut into whole
windows, which are emitted at once, and a rest.  The rest goes into the open window where
it fits best (least room left over).  When none fits, the fullest window is topped up
with the beginning of the rest and emitted, and the remainder is placed again; so an
emitted window is never short.  What is still open at the end of a partition is its
leftover: at most ``open_windows`` windows.  Leftovers are merged in rounds of a fixed
fan-in, by the same placement, until one group of at most ``open_windows`` windows is
left; their contents then end as sequences whose lengths are powers of two, which need
no padding.

Only piece descriptions are written for full windows; the ids themselves travel only for
leftovers (bounded per partition), since a merge may cut them anew.
"""

from __future__ import annotations

import base64
import zlib
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, materialize

LENGTH = 2048
OPEN_WINDOWS = 16
END_ID = 1
FAN_IN = 64
# A sequence id holds the round, the group (at first the partition) and a running number.
GROUP_BITS, ROUND_BITS = 32, 56
PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
WITH_IDS = PIECES + ", ids binary"
# Fixed value: the split pattern of the byte-level vocabulary
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Encoder:
    """Token ids of whole texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, ranks_path: str, specials: tuple[tuple[str, int], ...]):
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bpe = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=dict(specials))

    def encode(self, text: str) -> bytes:
        return self.bpe.encode_to_numpy(text, allowed_special="all").astype("<u4").tobytes()


@lru_cache(maxsize=2)
def encoder(ranks_path: str, specials: tuple[tuple[str, int], ...]) -> Encoder:
    return Encoder(ranks_path, specials)


class Packer:
    """Open windows of one partition; ``done`` collects (sequence, offset, piece) of emitted ones."""

    def __init__(self, length: int, windows: int):
        self.length, self.windows = length, windows
        self.open: list[list] = []  # [room, [(doc, start, doc_tokens, ids), ...]]
        self.done: list[list[tuple]] = []

    def place(self, doc, start: int, total: int, ids: bytes) -> None:
        while ids:
            n = len(ids) // 4
            if n >= self.length:
                cut = 4 * self.length
                self.done.append([(doc, start, total, ids[:cut])])
                ids, start = ids[cut:], start + self.length
                continue
            fitting = [w for w in self.open if w[0] >= n]
            if fitting:
                best = min(fitting, key=lambda w: w[0])
                best[0] -= n
                best[1].append((doc, start, total, ids))
                ids = b""
            elif len(self.open) < self.windows:
                self.open.append([self.length - n, [(doc, start, total, ids)]])
                return
            else:
                best = min(self.open, key=lambda w: w[0])
                cut, room = 4 * best[0], best[0]
                best[0] = 0
                best[1].append((doc, start, total, ids[:cut]))
                ids, start = ids[cut:], start + room
            if best[0] == 0:
                self.open = [w for w in self.open if w is not best]
                self.done.append(best[1])

    def close(self) -> None:
        """Cut what is open into sequences of power-of-two lengths."""
        pieces = [p for w in self.open for p in w[1]]
        self.open = []
        rest = sum(len(p[3]) // 4 for p in pieces)
        while rest:
            size = min(self.length, 1 << (rest.bit_length() - 1))
            rest -= size
            taken = []
            while size:
                doc, start, total, ids = pieces.pop(0)
                cut = min(size, len(ids) // 4)
                taken.append((doc, start, total, ids[: 4 * cut]))
                if cut < len(ids) // 4:
                    pieces.insert(0, (doc, start + cut, total, ids[4 * cut :]))
                size -= cut
            self.done.append(taken)


def _rows(sequences: list[list[tuple]], first_id: int, keep_ids: bool) -> pd.DataFrame:
    out = []
    for seq, pieces in enumerate(sequences, first_id):
        offset = 0
        for doc, start, total, ids in pieces:
            n = len(ids) // 4
            out.append((doc, start, n, zlib.crc32(ids), total, seq, offset, ids if keep_ids else None))
            offset += n
    frame = pd.DataFrame(out, columns=[c.split()[0] for c in WITH_IDS.split(", ")])
    return frame.astype({c: "Int64" for c in frame.columns[:-1]})


def pack(docs: DataFrame, ranks: str, specials: tuple[tuple[str, int], ...] = (("<|endoftext|>", 50256),), length: int = LENGTH,
         open_windows: int = OPEN_WINDOWS, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    ``ranks`` is the vocabulary's rank file.  Every document's ids end with ``end_id``; a
    null or empty text is that id alone.  Rows with equal or null ids are packed as
    documents of their own.  Very long texts become many whole windows.  An empty table
    gives no rows; other columns are not read.
    """
    if length < 1 or length & (length - 1):
        raise ValueError("length must be a power of two")
    end = end_id.to_bytes(4, "little")

    def first_pass(batches):
        from pyspark import TaskContext

        first, made = TaskContext.get().partitionId() << GROUP_BITS, 0
        enc, packer = encoder(ranks, specials), Packer(length, open_windows)
        for batch in batches:
            for doc, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = (enc.encode(text) if text else b"") + end
                packer.place(None if pd.isna(doc) else int(doc), 0, len(ids) // 4, ids)
            if packer.done:
                yield _rows(packer.done, first + made, False)
            made += len(packer.done)
            packer.done = []
        if packer.open:
            yield _rows([w[1] for w in packer.open], first + made, True)

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    state = materialize(map_batches(rows, first_pass, WITH_IDS), "pack")
    done = state.filter(F.col("ids").isNull()).drop("ids")
    group = F.shiftright("sequence_id", GROUP_BITS) % (1 << (ROUND_BITS - GROUP_BITS))
    for turn in range(1, 1 << (63 - ROUND_BITS)):
        left = state.filter(F.col("ids").isNotNull())
        top = left.agg(F.max(group)).first()[0]  # one row; as many groups as partitions at first
        if top is None:
            break
        merged = left.groupBy(F.floor(group / FAN_IN).alias("grp"))
        state = materialize(merged.applyInPandas(_merge(turn, top < FAN_IN, length, open_windows), WITH_IDS), "pack")
        done = done.unionByName(state.filter(F.col("ids").isNull()).drop("ids"))
    return done


def _merge(turn: int, last: bool, length: int, windows: int):
    """Place the leftovers of up to ``FAN_IN`` groups again; in the last round end them."""

    def merge(key, frame):
        packer = Packer(length, windows)
        for r in frame.sort_values(["sequence_id", "offset"]).itertuples(index=False):
            packer.place(None if pd.isna(r.doc_id) else int(r.doc_id), int(r.start), int(r.doc_tokens), r.ids)
        if last:
            packer.close()
        first = (turn << ROUND_BITS) + (int(key[0]) << GROUP_BITS)
        left = [w[1] for w in packer.open]
        return pd.concat([_rows(packer.done, first, False), _rows(left, first + len(packer.done), True)])

    return merge
