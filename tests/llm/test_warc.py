"""WARC archives: exact round trips, record types against a plain version, the file format by other means."""

import base64
import hashlib
import io
import random

import pytest
import zstandard
from pyspark.sql import functions as F

from quire.llm import warc
from quire.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "page_id long, url string, html string, digest string, frame int, revisit string"


def page_rows():
    rng = random.Random(4)
    words = ["<p>", "</p>", "lorem", "ipsum", "é", "\r\n\r\n", "WARC/1.1", "\0", "🎉", " "]
    out = [(i, f"http://x/{i}", "".join(rng.choice(words) for _ in range(rng.randint(0, 400)))) for i in range(300)]
    hot = "<html>the same page</html>"
    out += [(10_000 - i, "http://hot/", hot) for i in range(200)]  # the smallest id comes last
    out += [(20_001, None, None), (20_000, "u", ""), (20_002, "a b\r\nX: y", "x"), (20_003, "u", "long " * 1_000_000)]
    out += [(20_004, "u", "x"), (20_004, "u", "x"), (None, "n", "x"), (None, None, "only without id"), (None, None, "only without id"), (30_000, "u", "\r\n\r\n")]
    return out


def table(spark, rows, parts=5):
    return spark.createDataFrame([(*r, "clash", 1, "clash") for r in rows], SCHEMA).repartition(parts)


def plain_version(rows, least=0):
    """Rows without the choice among equal ids: (page_id, bytes, digest), and per payload its smallest id."""
    seen = {}
    for i, _, html in rows:
        seen.setdefault((html or "").encode(), []).append(i)
    out = []
    for payload, ids in seen.items():
        known = sorted(i for i in ids if i is not None)
        ordered = known + [None] * (len(ids) - len(known))
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        for k, i in enumerate(ordered):
            revisit = k > 0 and len(payload) >= least
            out.append((i, len(payload), digest, "revisit" if revisit else "response", ordered[0] if revisit else None))
    return sorted(out, key=repr)


def read(spark, path, **kw):
    return warc.read_archives(spark, path, **kw)


@pytest.mark.parametrize("least", [0, 2])
def test_round_trip(spark, tmp_path, least):
    rows = page_rows()
    path = f"{tmp_path}/archives"
    warc.write_archives(table(spark, rows), path, least_bytes=least)
    got = read(spark, path).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=repr) == plain_version(rows, least)
    # every payload is archived once and comes back byte for byte
    stored = [bytes(r.payload) for r in got if r.record_type == "response"]
    assert set(stored) == {(h or "").encode() for _, _, h in rows}
    assert all(r.payload is None for r in got if r.record_type == "revisit")
    urls = {r.page_id: r.url for r in got}
    assert urls[20_001] is None and urls[20_002] == "a%20b%0D%0AX:%20y" and urls[5] == "http://x/5"


def test_files_are_plain_zstandard_with_a_leading_dictionary(spark, tmp_path):
    rows = page_rows()
    warc.write_archives(table(spark, rows, 3), f"{tmp_path}/a")
    files = [p for p in (tmp_path / "a").iterdir() if p.name.startswith("part-") and p.stat().st_size]
    assert 1 <= len(files) <= 3
    total = 0
    for p in files:
        data = p.read_bytes()
        assert data[:4] == bytes([0x5D, 0x2A, 0x4D, 0x18])
        n = int.from_bytes(data[4:8], "little")
        dictionary = zstandard.ZstdCompressionDict(data[8 : 8 + n])
        whole = zstandard.ZstdDecompressor(dict_data=dictionary).stream_reader(io.BytesIO(data), read_across_frames=True).read()
        records = [r for _, r in zip(range(10**6), warc.records_of(data))]
        assert whole.count(b"WARC-Record-ID: ") == len(records)
        total += len(records)
        # one record alone, by its place
        places = [(s, e) for s, e, m in warc.frames(data) if m == warc.FRAME_MAGIC]
        assert len(places) == len(records)
        s, e = places[len(places) // 2]
        alone = zstandard.ZstdDecompressor(dict_data=dictionary).decompress(data[s:e])
        assert warc.parse(alone) == records[len(places) // 2]
    assert total == len(rows)


def test_dictionary_makes_similar_records_smaller():
    rng = random.Random(1)
    template = b"<html><head><title>%d</title></head><body><div class='content main wide'>%d</div></body></html>"
    records = [template % (rng.randint(0, 10**9), rng.randint(0, 10**9)) for _ in range(400)]
    writer = warc.Writer(records[:200], 3, 16 << 10)
    assert len(writer.head) > 8 + 100
    mine = sum(len(writer.frame(r)) for r in records[200:])
    assert mine < 0.6 * sum(len(zstandard.ZstdCompressor(level=3).compress(r)) for r in records[200:])


def test_damaged_archives_are_noticed(spark, tmp_path):
    writer = warc.Writer([b"x"], 3, 1024)
    good = warc.record(1, "u", b"payload", base64.b32encode(hashlib.sha1(b"payload").digest()).decode(), None, False, warc.DATE)
    data = writer.head + warc.SEPARATOR + writer.frame(good) + warc.SEPARATOR
    assert list(warc.records_of(data))[0][1] == b"payload"
    with pytest.raises(ValueError):
        list(warc.records_of(data[: len(data) - 12]))
    with pytest.raises(ValueError):
        list(warc.records_of(writer.frame(good)))
    with pytest.raises(ValueError):
        list(warc.records_of(writer.head + b"no frame"))
    with pytest.raises(ValueError):
        warc.parse(good[:-1])
    bad = good.replace(b"payload\r\n", b"PAYLOAD\r\n")
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "part-0").write_bytes(writer.head + writer.frame(bad))
    with pytest.raises(Exception, match="does not agree"):
        read(spark, f"file://{tmp_path}/bad").collect()


def test_empty_table(spark, tmp_path):
    warc.write_archives(table(spark, []), f"{tmp_path}/none")
    assert read(spark, f"{tmp_path}/none").collect() == []


def test_digest_in_sql(spark):
    texts = ["", "a", "é", "x" * 1000]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(warc.sha1_base32(F.col("t").cast("binary"))).collect()
    assert [r[0] for r in got] == [base64.b32encode(hashlib.sha1(t.encode()).digest()).decode() for t in texts]


def test_query(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html").collect()
    got = QUERIES["op11_warc"](spark, SF)
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain_version([tuple(p) for p in pages])
