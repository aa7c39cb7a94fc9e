"""Writers for result DataFrames."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The mode of writing that keeps the old result until the new one is whole.
REPLACE = "replace"


def write_result(
    df: DataFrame,
    path: str | None,
    /,
    fmt: str = "parquet",
    mode: str = "errorifexists",
    partition_by: Sequence[str] = (),
    **options: str,
) -> None:
    """Write a result with any Spark data source.  Nested lists of structs are
    native in parquet, orc and json.  ``mode`` defaults to refusing to overwrite;
    ``"replace"`` writes beside an old result and puts the new one in its place
    when it is whole (see ``replacing``), where Spark's ``"overwrite"`` deletes first.
    A store connector takes its target from ``options`` with ``path=None``."""
    if mode == REPLACE:
        if path is None:
            raise ValueError("mode 'replace' needs a path")
        replacing(df.sparkSession, path, lambda staged: write_result(df, staged, fmt, partition_by=partition_by, **options))
        return
    writer = df.write.format(fmt).mode(mode).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path is None:
        writer.save()
    else:
        writer.save(path)


def write_lines(df: DataFrame, line: Column | str, path: str, mode: str = "errorifexists") -> None:
    """A text directory with one line per row; ``mode`` as in ``write_result``."""
    col = F.col(line) if isinstance(line, str) else line
    write_result(df.select(col.cast("string").alias("value")), path, "text", mode)


def replacing(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Runs ``write`` on a folder beside ``path`` and renames it to ``path`` at the end.

    A job that fails leaves the old result as it was and removes what it had
    written; so a rerun starts from the same state.  The old result may also be an input of the job.  Readers
    see the old result until two renames at the end.  The file system has to rename folders (HDFS,
    ABFS, local); an object store that copies on rename does this more slowly and not in one step."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path.rstrip("/"))
    fs, own = target.getFileSystem(conf), uuid.uuid4().hex
    target = fs.makeQualified(target)
    # A name with an underscore in front is not read when the folder above is.
    staged, old = (jvm.org.apache.hadoop.fs.Path(target.getParent(), f"_{target.getName()}-{kind}-{own}") for kind in ("next", "old"))
    try:
        write(staged.toString())
        had = fs.exists(target)
        if had and not fs.rename(target, old):
            raise OSError(f"{path} could not be moved aside")
        if not fs.rename(staged, target):
            if had:
                fs.rename(old, target)
            raise OSError(f"the new result could not be moved to {path}")
        if had:
            fs.delete(old, True)
    finally:
        fs.delete(staged, True)
