"""WARC archives with a Zstandard dictionary, written and read by Spark.

Every partition of pages becomes one archive file.  Its first records (at most
``SAMPLE_BYTES``) are held back to build a Zstandard dictionary, which is embedded in a
leading skippable frame; then every record is compressed by itself with that dictionary, so
that a reader who knows a record's place needs no other record.  The files are written by
Spark's text writer with its commit protocol, thus to any file system that Spark knows: a
row is the bytes of a frame, and the line separator is an empty skippable frame, which every
Zstandard reader passes over.

Equal payloads are archived once: of the pages that share one the smallest page id is the
``response``, the others are ``revisit`` records that refer to it.  Digests are compared, not
payloads; only digests and row keys are shuffled to find them, and a hot payload is dealt out
to ``DEALS`` parts.  The pages themselves are shuffled only if the revisits are too many for
Spark to send them to the pages.

An archive is as large as a partition (``spark.sql.files.maxPartitionBytes``) and is read in one
piece, frame by frame; the payloads read are digested again and compared with their headers.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .common import ROW_KEY, keyed_rows, map_batches, materialize, ready

LEVEL = 3
DICTIONARY_BYTES = 64 << 10
SAMPLE_BYTES = 2 << 20  # payload bytes of an archive's first records, from which its dictionary is built
LEAST_SAMPLES = 16  # with fewer records the dictionary is their plain content
OUTPUT_BYTES = 8 << 20  # payload bytes after which frames, or records read, are handed on
DEALS = 16
DATE = "1970-01-01T00:00:00Z"
# Fixed values of the formats
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE_MAGIC, SKIPPABLE_MASK, FRAME_MAGIC = 0x184D2A50, 0xFFFFFFF0, 0xFD2FB528
SEPARATOR = SKIPPABLE_MAGIC.to_bytes(4, "little") + bytes(4)  # an empty skippable frame; all of it is ASCII
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
DIGITS32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
CONTROL = re.compile(r"[\x00-\x20\x7f]")
READ = "page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string, payload binary"


# --------------------------------------------------------------------------- which pages are archived
def sha1_base32(data: Column) -> Column:
    """Upper-case base32 of the SHA-1 digest: 8 groups of 20 bits, 4 characters each."""
    digest = F.sha1(data)
    groups = [F.lpad(F.conv(F.substring(digest, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*groups), DIGITS32, BASE32)


def archived(pages: DataFrame, least_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(page_id, url, payload, digest, revisit, refers_to)``: one row per page, its record type decided.

    Of pages with one payload of at least ``least_bytes`` bytes the smallest id is the response
    (a null id comes last, of equal ids one row is taken); the others revisit it.
    """
    keyed = keyed_rows(pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(html_col), F.lit("")).cast("binary").alias("payload")))
    n = F.octet_length("payload")
    digests = keyed.filter(n >= least_bytes).select("page_id", *ROW_KEY, F.sha1("payload").alias("sha"), n.alias("n"))
    first = F.min(F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", *ROW_KEY)).alias("first")
    shared = digests.groupBy("sha", "n").agg(first, F.count(F.lit(1)).alias("pages")).filter("pages > 1").drop("pages")
    # a third of the pages may share one payload: they are dealt out, with a copy of their first page each
    dealt = digests.withColumn("deal", F.pmod(F.xxhash64(*ROW_KEY), F.lit(DEALS)))
    copies = shared.withColumn("deal", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(DEALS - 1).cast("bigint"))))
    met = dealt.join(copies, ["sha", "n", "deal"])
    others = met.filter((F.col(ROW_KEY[0]) != F.col("first")[ROW_KEY[0]]) | (F.col(ROW_KEY[1]) != F.col("first")[ROW_KEY[1]]))
    revisits = materialize(others.select(*ROW_KEY, F.lit(True).alias("revisit"), F.col("first.page_id").alias("refers_to")), "revisits")
    out = keyed.join(revisits, list(ROW_KEY), "left")
    return out.select("page_id", "url", "payload", sha1_base32(F.col("payload")).alias("digest"), F.coalesce("revisit", F.lit(False)).alias("revisit"), "refers_to")


# --------------------------------------------------------------------------- records and frames
def uri_of(page_id: int | None) -> str:
    """The name of a page's record; a page without an id has no name that others refer to."""
    return f"<urn:page:{page_id}>" if page_id is not None else f"<urn:uuid:{uuid.uuid4()}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """The bytes of one WARC record; a revisit has no block, its headers describe the full payload."""
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", uri_of(page_id)), ("WARC-Date", date)]
    if url is not None:  # blanks and control characters cannot stand in a header
        head.append(("WARC-Target-URI", CONTROL.sub(lambda m: f"%{ord(m.group()):02X}", url)))
    if revisit:
        head.append(("WARC-Profile", PROFILE))
        if refers_to is not None:
            head.append(("WARC-Refers-To", uri_of(refers_to)))
    block = b"" if revisit else payload
    head += [("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Payload-Length", len(payload)), ("Content-Type", "text/html"), ("Content-Length", len(block))]
    lines = b"\r\n".join([VERSION, *(f"{k}: {v}".encode("utf-8", "surrogatepass") for k, v in head)])
    return lines + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of a whole record; ``ValueError`` if it is none."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.split(b"\r\n")
    if first != VERSION or not gap:
        raise ValueError("not a WARC record")
    fields = dict(line.decode("utf-8", "surrogatepass").split(": ", 1) for line in lines)
    n = int(fields["Content-Length"])
    if rest[n:] != b"\r\n\r\n":
        raise ValueError("a WARC record has another length than its header says")
    return fields, rest[:n]


def skippable(magic: int, content: bytes) -> bytes:
    return magic.to_bytes(4, "little") + len(content).to_bytes(4, "little") + content


def frame_end(data: memoryview, at: int) -> int:
    """Where the Zstandard or skippable frame at ``at`` ends."""
    word = lambda i, n: int.from_bytes(data[i : i + n], "little")
    magic = word(at, 4)
    if magic & SKIPPABLE_MASK == SKIPPABLE_MAGIC:
        end = at + 8 + word(at + 4, 4)
    elif magic == FRAME_MAGIC:
        flags = data[at + 4]
        single = flags >> 5 & 1
        size_field = (1 if single else 0, 2, 4, 8)[flags >> 6]
        end = at + 5 + (1 - single) + (0, 1, 2, 4)[flags & 3] + size_field
        last = 0
        while not last and end < len(data):
            block = word(end, 3)
            last, kind, size = block & 1, block >> 1 & 3, block >> 3
            end += 3 + (1 if kind == 1 else size)
        end += 4 if flags >> 2 & 1 else 0
    else:
        raise ValueError(f"no frame at byte {at}")
    if end > len(data):
        raise ValueError("the archive ends inside a frame")
    return end


def frames(data: bytes) -> Iterator[tuple[int, int, int]]:
    """``(start, end, magic)`` of the frames of an archive."""
    view, at = memoryview(data), 0
    while at < len(view):
        end = frame_end(view, at)
        yield at, end, int.from_bytes(view[at : at + 4], "little")
        at = end


def dictionary_of(samples: list[bytes], size: int) -> bytes:
    """A dictionary of about ``size`` bytes built from whole records."""
    import zstandard

    if len(samples) >= LEAST_SAMPLES:
        try:
            return zstandard.train_dictionary(min(size, max(1024, sum(map(len, samples)) // 8)), samples).as_bytes()
        except zstandard.ZstdError:  # records with too little in common, or too small
            pass
    # what is nearest to the end of a plain dictionary is found at the least cost
    return b"".join(samples)[-size:]


class Writer:
    """Frames of one archive: the dictionary first, then a frame per record."""

    def __init__(self, samples: list[bytes], level: int, size: int):
        import zstandard

        content = dictionary_of(samples, size)
        self.head = skippable(DICTIONARY_MAGIC, content)
        dictionary = zstandard.ZstdCompressionDict(content) if len(content) >= 8 else None
        self.compressor = zstandard.ZstdCompressor(level=level, dict_data=dictionary, write_checksum=True, write_content_size=True)

    def frame(self, data: bytes) -> bytes:
        return self.compressor.compress(data)


def records_of(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """The records of an archive, one frame at a time."""
    import zstandard

    view = memoryview(data)
    opened = None
    for start, end, magic in frames(data):
        if magic == DICTIONARY_MAGIC and opened is None:
            content = bytes(view[start + 8 : end])
            opened = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(content) if len(content) >= 8 else None)
        elif magic == FRAME_MAGIC:
            if opened is None:
                raise ValueError("the archive does not begin with its dictionary")
            yield parse(opened.decompress(view[start:end]))


# --------------------------------------------------------------------------- writing and reading
def write_archives(pages: DataFrame, path: str, least_bytes: int = 0, level: int = LEVEL, dictionary_bytes: int = DICTIONARY_BYTES,
                   date: str = DATE, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """Archive ``pages`` in the new folder ``path``: one file per partition that has pages.

    The payload is the html in UTF-8, a null one is empty.  Null ids and urls, repeated rows
    and texts of any length are archived; an empty table gives a folder without archives;
    other columns are not read.
    """

    def run(batches):
        writer, held, size = None, [], 0
        out, pending = [], 0
        for batch in batches:
            for r in batch.itertuples(index=False):
                page_id = None if pd.isna(r.page_id) else int(r.page_id)
                refers_to = None if pd.isna(r.refers_to) else int(r.refers_to)
                data = record(page_id, r.url if isinstance(r.url, str) else None, bytes(r.payload), r.digest, refers_to, bool(r.revisit), date)
                if writer is None:
                    held.append(data)
                    size += len(data)
                    if size < SAMPLE_BYTES:
                        continue
                    writer = Writer(held, level, dictionary_bytes)
                    out, held = [writer.head, *map(writer.frame, held)], []
                else:
                    out.append(writer.frame(data))
                pending += len(out[-1])
                if pending >= OUTPUT_BYTES:
                    yield pd.DataFrame({"frame": out})
                    out, pending = [], 0
        if held:
            writer = Writer(held, level, dictionary_bytes)
            out = [writer.head, *map(writer.frame, held)]
        if out:
            yield pd.DataFrame({"frame": out})

    made = map_batches(archived(pages, least_bytes, id_col, url_col, html_col), run, "frame binary")
    # a string column holds any bytes; the writer puts the separator, an empty frame, behind each row
    made.select(F.col("frame").cast("string").alias("value")).write.option("lineSep", SEPARATOR.decode("ascii")).text(path)


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """``(page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload)``: one row per record.

    ``payload_bytes`` and ``payload_digest`` are those of the full payload; a revisit has a null
    payload.  Each stored payload is digested anew: a record that does not agree with its header
    raises ``ValueError``.  ``payloads`` false leaves the payload null.
    """
    ready(spark)
    page = re.compile(r"<urn:page:(-?\d+)>")

    def id_of(uri: str | None) -> int | None:
        m = page.fullmatch(uri or "")
        return int(m.group(1)) if m else None

    def run(batches):
        names = [c.split()[0] for c in READ.split(", ")]
        for batch in batches:
            out, size = [], 0
            for content in batch["content"]:
                for head, block in records_of(content):
                    kind, digest = head["WARC-Type"], head["WARC-Payload-Digest"].removeprefix("sha1:")
                    n = int(head["X-Payload-Length"])
                    if kind == "response":
                        if len(block) != n or base64.b32encode(hashlib.sha1(block).digest()).decode() != digest:
                            raise ValueError(f"the payload of {head['WARC-Record-ID']} does not agree with its header")
                    kept = block if payloads and kind == "response" else None
                    out.append((id_of(head["WARC-Record-ID"]), head.get("WARC-Target-URI"), kind, id_of(head.get("WARC-Refers-To")), n, digest, kept))
                    size += len(kept or b"") + 200
                    if size >= OUTPUT_BYTES:
                        yield _frame(out, names)
                        out, size = [], 0
            if out:
                yield _frame(out, names)

    # files without a byte come from partitions without pages
    files = spark.read.format("binaryFile").load(path).filter("length > 0").select("content")
    return files.mapInPandas(run, READ)


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=names).astype({"page_id": "Int64", "refers_to": "Int64"})


def archive_folder(spark: SparkSession) -> str:
    """A new folder's name in the session's shared folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/archives-{uuid.uuid4().hex}"
