"""The folder that the driver and all executors see."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Where it is unset, a temporary folder if all tasks run in this process, else an error: each
    executor would write to its own disk and later reads would miss those files."""
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local[") and context.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if context.applicationId not in _LOCAL:
            _LOCAL[context.applicationId] = "file://" + tempfile.mkdtemp(prefix="sluice-shared-")
        folder = _LOCAL[context.applicationId]
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read back: computed once for several readers, and not again after a loss."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back._sluice_path = path
    return back


def discard(*tables: DataFrame | None) -> None:
    """Delete tables made by `written` that nothing will read again; what was made otherwise stays."""
    for df in tables:
        if df is not None and "_sluice_path" in vars(df):
            spark = df.sparkSession
            path = spark._jvm.org.apache.hadoop.fs.Path(df._sluice_path)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
