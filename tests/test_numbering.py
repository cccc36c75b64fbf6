import pytest

from gridsieve.scale import number_in_order
from gridsieve.sinks.rawcopy import raw_copy
from gridsieve.sources.csvfiles import ReaderArgs, settle_types


def test_null_groups_are_numbered(spark):
    rows = [(None, 3), (None, 1), ("a", 2), ("a", 1), (None, 2)]
    found = number_in_order(spark.createDataFrame(rows, "g STRING, v INT"), ["g"], ["v"], "n").collect()
    assert sorted((r["g"] or "", r["v"], r["n"]) for r in found) == [("", 1, 1), ("", 2, 2), ("", 3, 3), ("a", 1, 1), ("a", 2, 2)]


def test_codes_are_not_numbers(spark):
    rows = [("12F", "1.5", "-3", "1e3"), ("13D", ".5", "+4", "2.")]
    frame = spark.createDataFrame(rows, "a STRING, b STRING, c STRING, d STRING")
    assert settle_types(frame, frame.columns, ReaderArgs()) == {"a": "string", "b": "double", "c": "bigint", "d": "double"}


def test_raw_copies_never_share_a_target(spark, tmp_path):
    files = spark.createDataFrame([("/a/x.bin", "x.bin"), ("/b/x.bin", "x.bin")], "path STRING, name STRING")
    with pytest.raises(ValueError):
        raw_copy(files, str(tmp_path))
