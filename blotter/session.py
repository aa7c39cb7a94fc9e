"""Session helpers: a local session for tests/bench and the checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings meant for a large cluster run (pass them with spark-submit --conf).
# Partitions are sized by AQE from a large initial count; scans read 256 MB
# splits; skewed joins are split.
# spark.checkpoint.dir must name a shared folder (HDFS, S3, ABFS, ...).
CLUSTER_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8192",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.shuffle.partitions": "4000",
}

# Folders written inside the open ``scratch_tables`` blocks, innermost last.
_SCOPES: list[list[str]] = []

_NO_FOLDER = (
    "spark.checkpoint.dir is not set; point it at a shared folder "
    "(HDFS/S3/ABFS) so that written intermediate tables survive executor loss"
)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "blotter") -> SparkSession:
    """A local session configured the way the tests and the bench expect."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the session.

    On a cluster the folder comes from ``spark.checkpoint.dir`` (a shared file
    system).  Only a session whose executors are threads of the driver
    (``local``, ``local[...]``) gets a private folder without one, as tests do;
    any other session without one is a configuration error.
    """
    try:
        sc = spark.sparkContext
    except Exception:
        # Spark Connect: the folder is a setting of the server's session.
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            raise RuntimeError(_NO_FOLDER) from None
        return folder
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError(_NO_FOLDER)
    folder = tempfile.mkdtemp(prefix="blotter-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def write_out(df: DataFrame, name: str, outlives: bool = False) -> DataFrame:
    """Write ``df`` as Parquet below the checkpoint folder and read it back: it
    is evaluated once, its lineage is cut, and later readers fetch only the
    columns they need.  The table lives as long as the checkpoint folder, or, inside
    ``scratch_tables``, until its block ends; with ``outlives`` until the block
    around that one ends: the result that the inner tables were written for."""
    folder = f"{ensure_checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    if len(_SCOPES) > outlives:
        _SCOPES[-1 - outlives].append(folder)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


@contextmanager
def scratch_tables(spark: SparkSession) -> Iterator[None]:
    """Deletes, at its end, the intermediate tables that operators wrote inside.
    A result must be written, or collected, before the block ends:

        with scratch_tables(spark):
            write_result(jobs.top_crimes(incidents), path)

    Blocks may be nested, within one thread; the folders also go when the block ends with an error."""
    own: list[str] = []
    _SCOPES.append(own)
    try:
        yield
    finally:
        _SCOPES.pop()
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for folder in own:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)
