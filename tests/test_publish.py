"""Publications: all of the old rows or all of the new ones."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from kitwise.sources import publish
from kitwise.sources.publish import SchemaMismatch, publish_folder, publish_partitions, publish_table, restore


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def frame(spark, *values):
    return spark.createDataFrame(list(values), "part string, n int")


def dying(spark):
    """Rows of which one fails after others have been written."""
    return spark.range(0, 1000, 1, 4).select(
        F.lit("x").alias("part"), F.when(F.col("id") < 990, 1).otherwise(F.raise_error(F.lit("lost"))).cast("int").alias("n")
    )


@pytest.fixture
def table(spark):
    name = f"published_{uuid.uuid4().hex[:8]}"
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_folder_is_replaced_whole_or_not_at_all(spark, tmp_path):
    path = str(tmp_path / "report")
    publish_folder(frame(spark, ("A", 1)), path)
    with pytest.raises(FileExistsError):
        publish_folder(frame(spark, ("B", 2)), path)
    with pytest.raises(Exception, match="lost"):
        publish_folder(dying(spark), path, overwrite=True)
    assert rows(spark.read.parquet(path)) == [("A", 1)]
    publish_folder(spark.read.parquet(path).withColumn("n", F.col("n") + 1), path, overwrite=True)  # reads itself
    assert rows(spark.read.parquet(path)) == [("A", 2)]
    publish_folder(frame(spark), path, overwrite=True)
    assert rows(spark.read.parquet(path)) == []
    assert os.listdir(tmp_path) == ["report"]


def test_folder_comes_back_after_a_death_between_the_renames(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "report")
    publish_folder(frame(spark, ("A", 1)), path)
    rename = publish._rename

    def dies(spark, source, target):
        if ".staged-" in source:
            raise OSError("driver gone")
        rename(spark, source, target)

    monkeypatch.setattr(publish, "_rename", dies)
    with pytest.raises(OSError):
        publish_folder(frame(spark, ("B", 2)), path, overwrite=True)
    monkeypatch.undo()
    assert not os.path.exists(path)
    assert restore(spark, path) and not restore(spark, path)
    assert rows(spark.read.parquet(path)) == [("A", 1)]


def test_columns_must_agree(spark, tmp_path):
    path = str(tmp_path / "report")
    publish_folder(frame(spark, ("A", 1)), path)
    with pytest.raises(SchemaMismatch, match="n is bigint, not int; .*|n is bigint, not int"):
        publish_folder(spark.createDataFrame([("A", 1)], "part string, n long"), path, overwrite=True)
    with pytest.raises(SchemaMismatch, match="n is missing; m is new"):
        publish_folder(spark.createDataFrame([("A", 1)], "part string, m int"), path, overwrite=True)
    publish_folder(spark.createDataFrame([(7, "B")], "N int, part string"), path, overwrite=True)  # another order and case
    assert rows(spark.read.parquet(path)) == [("B", 7)]


def test_table_moves_from_version_to_version(spark, tmp_path, table):
    folder = str(tmp_path / "versions")
    publish_table(frame(spark, ("A", 1)), table, folder)
    with pytest.raises(FileExistsError):
        publish_table(frame(spark, ("B", 2)), table, folder)
    reader = spark.table(table)
    with pytest.raises(Exception, match="lost"):
        publish_table(dying(spark), table, folder, overwrite=True)
    assert rows(spark.table(table)) == [("A", 1)] and len(os.listdir(folder)) == 1
    publish_table(spark.table(table).withColumn("n", F.col("n") + 1), table, folder, overwrite=True)
    assert rows(spark.table(table)) == [("A", 2)]
    assert rows(reader) == [("A", 1)]  # a query planned before reads its version to the end
    publish_table(frame(spark, ("C", 3)), table, folder, overwrite=True)
    assert rows(spark.table(table)) == [("C", 3)] and len(os.listdir(folder)) == 2
    with pytest.raises(SchemaMismatch):
        publish_table(spark.range(1), table, folder, overwrite=True)


def test_partitions_replace_only_their_own(spark, table):
    schema = "n int, week string"
    publish_partitions(spark.createDataFrame([(1, "w1"), (2, "w2")], schema), table, ["week"])
    publish_partitions(spark.createDataFrame([("w2", 5), ("w3", 6)], "week string, n int"), table, ["week"])
    want = [(1, "w1"), (5, "w2"), (6, "w3")]
    assert rows(spark.table(table)) == want
    died = dying(spark).select("n", F.lit("w1").alias("week"))
    with pytest.raises(Exception, match="lost"):
        publish_partitions(died, table, ["week"])
    publish_partitions(spark.createDataFrame([], schema), table, ["week"])
    assert rows(spark.table(table)) == want
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
    with pytest.raises(SchemaMismatch):
        publish_partitions(spark.table(table), table, ["n"])
