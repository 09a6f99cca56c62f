"""Work tables in the folder every executor shares.

A work table cuts lineage: later reads come from committed files, so losing an executor never re-runs what
produced them, and Catalyst plans later joins on real file sizes instead of guesses.
"""

import re
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session. Only a local session may go without one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_folder(spark.conf.get("spark.app.id"))


@cache
def _local_folder(app_id: str) -> str:
    return tempfile.mkdtemp(prefix=f"credara-{app_id}-")


class Workspace:
    """Saves DataFrames as Parquet under the shared folder. A name saved again gets a new folder, so
    readers of the older one are never disturbed."""

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.root = folder or f"{shared_folder(spark)}/credara-{uuid.uuid4().hex[:12]}"

    def new_path(self, name: str) -> str:
        return f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"

    def save(self, name: str, df: DataFrame) -> DataFrame:
        path = self.new_path(name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self) -> None:
        """Delete everything saved here. DataFrames read from it stop working."""
        target = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)
