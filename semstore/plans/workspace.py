"""The folder all executors share, for tables that cut a lineage or stage a batch."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from semstore.errors import RecordError

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names; where it names none, a new temporary one on a single machine, else an error."""
    folder = spark.conf.get(SETTING, None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RecordError(f"set {SETTING} to a folder that all executors share")
    if not folder:
        folder = tempfile.mkdtemp(prefix="semstore-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used before."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it: it is computed once, and a lost executor costs no more than a read."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, in the file system that holds the path."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder through the file system that holds it; one that does not exist is passed over."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, so that it need not be installed there."""
    context = spark.sparkContext
    if getattr(context, "_semstore_shipped", False):
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="semstore-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._semstore_shipped = True
