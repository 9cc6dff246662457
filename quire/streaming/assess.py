"""Incremental assessment of a folder with Structured Streaming.

The per-document assessment (sections, features, metrics, scores, predictions)
depends on one document only, so the very same projection runs on a streaming
``binaryFile`` source: new files are assessed as they arrive, with exactly-once
output through the checkpoint of the file sink.  Near-duplicate clustering is
*not* incremental — its leader order is global — so it runs as a batch job over
the accumulated inventory (``operators.dedupe.cluster_keys``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.paths import strip_scheme
from ..operators.inventory import assess_documents
from ..options import DEFAULT_EXTENSIONS, AssessOptions
from ..sources.files import decode_text


BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def stream_corpus(spark: SparkSession, root: str, extensions=DEFAULT_EXTENSIONS, max_files_per_trigger: int = 1000) -> DataFrame:
    """Streaming ``(path, size, content, text)`` of new files below ``root``."""
    exts = [e.lstrip(".") for e in extensions]
    glob = "*." + exts[0] if len(exts) == 1 else "*.{" + ",".join(exts) + "}"
    raw = (
        spark.readStream.format("binaryFile")
        .schema(BINARY_FILE_SCHEMA)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .load(root)
    )
    return raw.select(
        strip_scheme(F.col("path")).alias("path"),
        F.col("length").cast("bigint").alias("size"),
        "content",
        decode_text(F.col("content")).alias("text"),
    )


def assess_stream(corpus: DataFrame, opts: AssessOptions = AssessOptions()) -> DataFrame:
    """Streaming inventory rows (flat columns, ready for a file sink)."""
    a = assess_documents(corpus, opts)
    return a.select(
        "path",
        "size",
        "sha256",
        "sections",
        "topicization_readiness",
        "conversion_risk",
        "metrics",
        "predictions",
    )


def write_inventory_stream(inventory: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Append inventory rows as parquet; ``once`` processes what is there and stops."""
    writer = (
        inventory.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime="30 seconds")
    return writer.start()
