"""Tables that an operator or a report run writes for itself.

They live under the session's checkpoint directory, which every executor
shares. A frame handed out may still read its tables, so whatever has not been
deleted by then goes when the application ends.
"""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession

from kitwise.plans.session import ensure_checkpoint_dir

_folders: dict[str, tuple[object, object]] = {}


def delete(path: str, jvm, conf) -> None:
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(conf).delete(p, True)


@atexit.register
def delete_all() -> None:
    while _folders:
        path, (jvm, conf) = _folders.popitem()
        delete(path, jvm, conf)


class Folder:
    """A folder of Parquet tables."""

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark = spark
        self.path = f"{ensure_checkpoint_dir(spark)}/{purpose}-{uuid.uuid4().hex[:12]}"
        self._jvm, self._conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        _folders[self.path] = (self._jvm, self._conf)

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Write a table and read it back: the plan of what follows starts at its files."""
        df.write.parquet(f"{self.path}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{name}")

    def delete(self, name: str | None = None) -> None:
        """Delete one table, or the folder."""
        delete(f"{self.path}/{name}" if name else self.path, self._jvm, self._conf)
        if name is None:
            _folders.pop(self.path, None)
