"""Publishing a dataset: readers see all of the old rows or all of the new ones.

Rows are written beside what is there, checked against its schema, and only
then put in its place. A write that dies leaves what was published before.
A frame may read the very dataset it replaces.

* ``publish_folder``: a plain Parquet folder, exchanged by two renames. If the
  driver dies between them, the next call (or ``restore``) puts the old folder back.
* ``publish_table``: a catalog table over version folders; the exchange is one
  catalog statement. The version before stays for queries that still read it.
* ``publish_partitions``: only the partitions that the new rows have are replaced
  (Spark's dynamic partition overwrite, committed when all tasks have ended).

An empty frame publishes an empty dataset, and replaces no partition.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

#: Table property that names the version folder before the current one.
PREVIOUS = "publish.previous"


class SchemaMismatch(ValueError):
    """The new rows don't have the published columns."""


def check_schema(new: StructType, old: StructType) -> list[str]:
    """The published columns in their order; an error if a name or type differs (case and nullability don't count)."""
    types = {f.name.lower(): f.dataType.simpleString() for f in new}
    published = {f.name.lower(): f.dataType.simpleString() for f in old}
    faults = [f"{n} is missing" for n in published if n not in types]
    faults += [f"{n} is new" for n in types if n not in published]
    faults += [f"{n} is {types[n]}, not {t}" for n, t in published.items() if types.get(n, t) != t]
    if len(types) != len(new):
        faults.append("a column name occurs twice")
    if faults:
        raise SchemaMismatch("; ".join(faults))
    return [f.name for f in old]


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _file_system(spark, path)
    fs.delete(p, True)


def _rename(spark: SparkSession, source: str, target: str) -> None:
    fs, s = _file_system(spark, source)
    if not fs.rename(s, _file_system(spark, target)[1]):
        raise OSError(f"{source} can't be renamed to {target}")


def _staged(df: DataFrame, path: str) -> None:
    try:
        df.write.parquet(path)
    except BaseException:
        _delete(df.sparkSession, path)
        raise


def restore(spark: SparkSession, path: str) -> bool:
    """Put back the folder of a publication that died between its two renames; whether there was one."""
    path = path.rstrip("/")
    fs, target = _file_system(spark, path)
    if fs.exists(target):
        return False
    left = fs.globStatus(_file_system(spark, f"{path}.old-*")[1]) or []
    if not len(left):
        return False
    newest = max(left, key=lambda s: s.getModificationTime())
    _rename(spark, newest.getPath().toString(), path)
    return True


def publish_folder(df: DataFrame, path: str, overwrite: bool = False) -> None:
    """Publish ``df`` as the Parquet folder ``path``; an existing one is refused unless ``overwrite``."""
    spark, path, run = df.sparkSession, path.rstrip("/"), uuid.uuid4().hex[:12]
    restore(spark, path)
    fs, target = _file_system(spark, path)
    exists = fs.exists(target)
    if exists and not overwrite:
        raise FileExistsError(path)
    if exists:
        df = df.select(*[f"`{c}`" for c in check_schema(df.schema, spark.read.parquet(path).schema)])
    _staged(df, f"{path}.staged-{run}")
    if exists:
        _rename(spark, path, f"{path}.old-{run}")
    _rename(spark, f"{path}.staged-{run}", path)
    if exists:
        _delete(spark, f"{path}.old-{run}")
    spark.catalog.refreshByPath(path)


def _described(spark: SparkSession, name: str) -> dict[str, str]:
    return {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}


def publish_table(df: DataFrame, name: str, folder: str, overwrite: bool = False) -> None:
    """Publish ``df`` as the catalog table ``name`` over a new version folder under ``folder``.

    An existing table is refused unless ``overwrite``, and always if its rows
    belong to the catalog (a managed table) or are partitioned.
    """
    spark, version = df.sparkSession, f"{folder.rstrip('/')}/version-{uuid.uuid4().hex[:12]}"
    if not spark.catalog.tableExists(name):
        _staged(df, version)
        spark.catalog.createTable(name, path=version, source="parquet", schema=df.schema)
        return
    if not overwrite:
        raise FileExistsError(name)
    about = _described(spark, name)
    if about.get("Type") != "EXTERNAL" or "# Partition Information" in about:
        raise ValueError(f"{name} is not a table of version folders")
    before = about["Location"]
    older = spark.sql(f"SHOW TBLPROPERTIES {name}").where(f"key = '{PREVIOUS}'").collect()
    _staged(df.select(*[f"`{c}`" for c in check_schema(df.schema, spark.table(name).schema)]), version)
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{_quoted(version)}'")
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{PREVIOUS}' = '{_quoted(before)}')")
    spark.catalog.refreshTable(name)
    for row in older:
        _delete(spark, row["value"])


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def publish_partitions(df: DataFrame, name: str, partition_by: Sequence[str]) -> None:
    """Replace the partitions of table ``name`` that ``df`` has rows for; the first call makes the table."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        df.write.format("parquet").partitionBy(*partition_by).saveAsTable(name)
        return
    parts = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    if [c.lower() for c in parts] != [c.lower() for c in partition_by]:
        raise SchemaMismatch(f"{name} is partitioned by {parts}, not {list(partition_by)}")
    rows = df.select(*[f"`{c}`" for c in check_schema(df.schema, spark.table(name).schema)])
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "dynamic")
    try:
        rows.write.mode("overwrite").insertInto(name)
    finally:
        spark.conf.set(setting, before)
