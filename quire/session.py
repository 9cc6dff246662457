"""Session helpers: a local session for tests / bench, and checkpoint-dir handling.

On a cluster the session is built by the caller; the library only *reads*
``spark.checkpoint.dir`` from it.  A machine-local temporary folder is used only
when the master is ``local[...]`` and nothing was configured (tests, bench).
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "quire") -> SparkSession:
    """Session for tests and the bench: local mode, UI off, AQE on."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", os.environ.get("QUIRE_DRIVER_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory of the session.

    Uses the directory already set on the context or ``spark.checkpoint.dir``.
    Only in local mode, when neither is set, a fresh folder under the system
    temp dir is taken.  On a cluster an unset directory is an error: lineage
    must be cut in shared storage, never on one machine's disk.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if sc.master.startswith("local"):
        path = tempfile.mkdtemp(prefix="quire-ckpt-")
        sc.setCheckpointDir(path)
        return sc.getCheckpointDir() or path
    raise RuntimeError(
        "spark.checkpoint.dir is not set; iterative operators need a shared "
        "checkpoint folder (e.g. on HDFS / object storage) to cut lineage."
    )


def write_and_read(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` into the shared checkpoint folder and read it back: ``(table, path)``.

    Cuts the lineage like ``checkpoint()``, but the table read back has the statistics of
    its files; a checkpointed plan keeps its old size estimate, which loops multiply.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder that :func:`write_and_read` made and no plan reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


class scoped_conf:
    """Temporarily set SQL confs for the jobs run inside the block, then restore them."""

    def __init__(self, spark: SparkSession, confs: dict[str, str]):
        self.spark, self.confs, self.saved = spark, dict(confs), {}

    def __enter__(self):
        for k, v in self.confs.items():
            self.saved[k] = self.spark.conf.get(k, None)
            self.spark.conf.set(k, v)
        return self

    def __exit__(self, *exc):
        for k, v in self.saved.items():
            if v is None:
                self.spark.conf.unset(k)
            else:
                self.spark.conf.set(k, v)
        return False


# The signature aggregate has one ``min`` per permutation; its generated method is
# larger than the default limit, and above it Spark silently runs the stage
# without whole-stage codegen (about 3-4x slower).
WIDE_AGGREGATE_CONF = {"spark.sql.codegen.hugeMethodLimit": "200000"}


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the session's Python workers this package, once per application.

    Workers import functions by module name, and find the package only if it is installed
    on their machines or lies in their working folder.  The zip holds source files only;
    Spark's own file server hands it out.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    target = os.path.join(tempfile.mkdtemp(prefix="quire-src-"), f"{root.name}.zip")
    with zipfile.ZipFile(target, "w") as z:
        for path in sorted(root.rglob("*.py")):
            z.write(path, path.relative_to(root.parent).as_posix())
    spark.sparkContext.addPyFile(target)
    _SHIPPED.add(app)
