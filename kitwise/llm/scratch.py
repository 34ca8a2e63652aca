"""Intermediate tables in the shared folder the cluster names in ``spark.checkpoint.dir``.

Every table an operator needs twice is written as Parquet there and read back:
the lineage ends at files that every executor sees, so a lost executor costs
its running tasks only. Intermediates are deleted as soon as nothing reads
them; the tables a returned DataFrame reads are deleted when the application
ends, or earlier by ``release``.
"""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession

from kitwise.plans.session import ensure_checkpoint_dir

_kept: list[tuple[object, object, str]] = []


def _delete(jvm, conf, path: str) -> None:
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(conf).delete(p, True)


def release() -> None:
    """Delete every scratch table of this application. Frames that read them can't be run afterwards."""
    while _kept:
        _delete(*_kept.pop())


atexit.register(release)


class Scratch:
    """A folder of Parquet tables for one run of one operator."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{ensure_checkpoint_dir(spark)}/kitwise-llm-{uuid.uuid4().hex}"
        sc = spark.sparkContext
        self._jvm, self._conf = sc._jvm, sc._jsc.hadoopConfiguration()
        self._names: set[str] = set()
        _kept.append((self._jvm, self._conf, self.folder))

    def save(self, df: DataFrame, name: str, compression: str | None = None, arrow_bytes: int | None = None) -> DataFrame:
        """Write a table and read it; Python functions of ``df`` get Arrow batches of about ``arrow_bytes`` each."""
        path = f"{self.folder}/{name}"
        setting = "spark.sql.execution.arrow.maxBytesPerBatch"
        before = self.spark.conf.get(setting)
        self.spark.conf.set(setting, arrow_bytes or before)
        try:
            df.write.parquet(path, compression=compression)
        finally:
            self.spark.conf.set(setting, before)
        self._names.add(name)
        return self.read(name, df.schema)

    def read(self, name: str, schema) -> DataFrame:
        """A table of this run as a frame of its own (for joins of a table with itself)."""
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{name}")

    def drop(self, *names: str) -> None:
        for name in names:
            _delete(self._jvm, self._conf, f"{self.folder}/{name}")
            self._names.discard(name)

    def keep_only(self, *names: str) -> None:
        """Delete every other table of this run."""
        self.drop(*sorted(self._names - set(names)))
