"""Write an intermediate result once and go on from the written table."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN_FOLDERS: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can read: ``spark.checkpoint.dir``.

    Only a local session, as in tests, may fall back to a folder of its own: one for the session.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN_FOLDERS:
        _OWN_FOLDERS[app] = tempfile.mkdtemp(prefix="fundspark-")
    return _OWN_FOLDERS[app]


def work_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder, removed when the application ends.

    Tables read lazily from it stay valid as long as the session that made them.
    """
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path


def materialise(df: DataFrame, name: str) -> DataFrame:
    """A table that later steps read again, column by column.

    Lost executors cost a re-read of the files, not a recomputation of everything upstream.
    """
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
