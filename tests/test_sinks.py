import os

import pytest
from pyspark.errors import AnalysisException

from kitwise.sources.sinks import default_output_name, write_csv


def test_csv_written_and_not_overwritten(spark, tmp_path):
    df = spark.createDataFrame([("A", 1), (None, 2), ("", 3)], "PATH string, N int")
    out = str(tmp_path / "report")
    write_csv(df, out, single_file=True)
    part = [f for f in os.listdir(out) if f.startswith("part-")][0]
    text = open(os.path.join(out, part)).read().splitlines()
    assert text[0] == "PATH,N"
    # NULL is written as nothing, '' as "".
    assert sorted(text[1:]) == sorted(["A,1", ",2", '"",3'])
    with pytest.raises(AnalysisException):
        write_csv(df, out)
    write_csv(df, out, overwrite=True, header=False, delimiter=";")


def test_default_name():
    import datetime as dt

    assert default_output_name(dt.date(2026, 3, 11)) == "bom_capacity_report_20260311"
