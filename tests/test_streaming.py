import os
import tempfile

from quire.streaming.assess import assess_stream, stream_corpus, write_inventory_stream


def test_stream_matches_batch(spark):
    root = tempfile.mkdtemp(prefix="quire-stream-", dir="/tmp")
    src = os.path.join(root, "in")
    os.makedirs(src)
    docs = {"a.md": "# A\n\n1. Open it\n2. Run it\n", "b.html": "<h1>B</h1><p>x</p>", "c.md": "plain"}
    for name, text in docs.items():
        with open(os.path.join(src, name), "w") as f:
            f.write(text)
    q = write_inventory_stream(
        assess_stream(stream_corpus(spark, src, [".md", ".html"])),
        os.path.join(root, "out"),
        os.path.join(root, "ckpt"),
    )
    q.awaitTermination(120)
    got = {os.path.basename(r.path): r for r in spark.read.parquet(os.path.join(root, "out")).collect()}
    assert set(got) == set(docs)
    assert [p.pred for p in got["a.md"].predictions] == ["task"]
    assert got["b.html"].sections == 1
