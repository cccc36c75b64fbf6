from datetime import datetime

import pytest

import gridsieve as gs
from gridsieve.sinks import rawcopy, writers
from gridsieve.sources.csvfiles import MISSING_TEXTS, ReaderArgs, UnsupportedArgument
from gridsieve.sources.paths import expand_path


def put(folder, **files):
    folder.mkdir(exist_ok=True)
    for name, text in files.items():
        data = text if isinstance(text, bytes) else text.encode()
        (folder / name.replace("__", ".")).write_bytes(data)
    return str(folder)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def status(files):
    return {r["path"].rsplit("/", 1)[1]: (r["status"], r["detail"]) for r in files.collect()}


DAY = datetime(2000, 1, 1)


def test_files_with_different_headers_and_problems(spark, tmp_path):
    path = put(
        tmp_path / "d",
        a__csv="time,q,x\n2000-01-01,1.5,8\n2000-01-02,,9\n",
        b__CSV="x,note,q,time\n7,\"a, b\",2,2000-01-03\n",
        c__txt="time,x\n2000-01-04,1\n",
        d__tsv="",
        e__dat=b"time,q,x\n2000-01-05,3,1\n2000-01-06,4,\xff\n",
        f__log="time,q,x\n2000-01-07,5,1\n",
        g__csv="time,q,x\n",
    )
    data, files = gs.scan_csv(spark, path, ["time", "q", "x"], "time")
    assert dict(data.dtypes) == {"time": "timestamp_ntz", "q": "double", "x": "bigint"}
    assert rows(data) == [
        (datetime(2000, 1, 1), 1.5, 8), (datetime(2000, 1, 2), None, 9), (datetime(2000, 1, 3), 2.0, 7),
    ]
    found = status(files)
    assert {n: s for n, (s, _) in found.items()} == {
        "a.csv": "read", "b.CSV": "read", "c.txt": "failed", "d.tsv": "failed", "e.dat": "failed", "g.csv": "read",
    }
    assert found["c.txt"][1] == "missing columns: q"
    assert "UTF-8" in found["e.dat"][1] and found["d.tsv"][1] == "no columns to read"


def test_pattern_directory_and_single_file(spark, tmp_path):
    path = put(tmp_path / "d e [1]", a__csv="v\n1\n", b__csv="v\n2\n", c__nc="v\n3\n")
    put(tmp_path / "d e [1]" / "sub", z__csv="v\n9\n")
    escaped = path.replace("[", "\\[").replace("]", "\\]")
    assert rows(gs.scan_csv(spark, f"{escaped}/*.csv", ["v"])[0]) == [(1,), (2,)]
    assert rows(gs.scan_csv(spark, escaped, ["v"])[0]) == [(1,), (2,)]
    assert rows(gs.scan_csv(spark, f"{escaped}/b.csv", ["v"])[0]) == [(2,)]
    names = {r["name"]: r["suffix"] for r in expand_path(spark, escaped).collect()}
    assert names == {"a.csv": ".csv", "b.csv": ".csv", "c.nc": ".nc"}


def test_nothing_to_read(spark, tmp_path):
    data, files = gs.scan_csv(spark, str(tmp_path / "absent" / "*.csv"), ["time", "v"], "time")
    assert data.columns == ["time", "v"] and data.count() == 0 and files.count() == 0


def test_reader_arguments(spark, tmp_path):
    text = "made by\nsomebody\n\n# a remark\nt;q;name\n# another\n20000101;1,5;'a;b'\n20000102;-99;made by\n"
    path = put(tmp_path / "d", a__txt=text, b__txt=text.replace("20000101", "20000103"))
    args = {"sep": ";", "decimal": ",", "comment": "#", "skiprows": "2", "na_values": "-99", "quotechar": "'"}
    data, files = gs.scan_csv(spark, path, ["t", "q", "name"], "t", args)
    assert {s for s, _ in status(files).values()} == {"read"}
    assert rows(data) == [
        (datetime(2000, 1, 1), 1.5, "a;b"), (datetime(2000, 1, 2), None, "made by"),
        (datetime(2000, 1, 2), None, "made by"), (datetime(2000, 1, 3), 1.5, "a;b"),
    ]


def test_header_behind_skipped_lines_of_several_splits(spark, tmp_path):
    """Lines behind the first split must not be taken for the preamble."""
    body = "".join(f"{i},{i * 2}\n" for i in range(20_000))
    path = put(tmp_path / "d", a__csv="x\na,b\na,b\n" + body)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        data, _ = gs.scan_csv(spark, path, ["a", "b"], args={"skiprows": 2})
        found = data.selectExpr("count(*)", "sum(a)", "sum(b)").first()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert tuple(found) == (20_000, 199990000, 399980000)


def test_other_encodings(spark, tmp_path):
    path = put(tmp_path / "d", a__csv="name,v\nMünchen,1\n".encode("latin-1"))
    data, _ = gs.scan_csv(spark, path, ["name", "v"], args={"encoding": "latin-1"})
    assert rows(data) == [("München", 1)]
    _, files = gs.scan_csv(spark, path, ["name", "v"])
    assert status(files)["a.csv"][0] == "failed"


def test_missing_values_and_settled_types(spark, tmp_path):
    path = put(
        tmp_path / "d",
        a__csv="i,d,b,s,e\n1,1e3,True,x,\n 2 ,NaN,False,1,\nNA,-0.5,None,NULL,\n",
        b__csv="i,d,b,s,e\n3,4,,2.5,\n",
    )
    data, _ = gs.scan_csv(spark, path, ["i", "d", "b", "s", "e"])
    assert dict(data.dtypes) == {"i": "bigint", "d": "double", "b": "boolean", "s": "string", "e": "double"}
    assert rows(data) == sorted(
        [
            (1, 1000.0, True, "x", None), (2, None, False, "1", None), (None, -0.5, None, None, None),
            (3, 4.0, None, "2.5", None),
        ],
        key=str,
    )
    typed, _ = gs.scan_csv(spark, path, ["i", "d"], types={"i": "double", "d": "double"})
    assert dict(typed.dtypes) == {"i": "double", "d": "double"}
    kept, _ = gs.scan_csv(spark, path, ["s"], args={"keep_default_na": "false"})
    assert ("NULL",) in rows(kept)


def test_unreadable_times_fail_the_entry(spark, tmp_path):
    path = put(tmp_path / "d", a__csv="t,v\n2000-01-01,1\nyesterday,2\n")
    data, _ = gs.scan_csv(spark, path, ["t", "v"], "t")
    with pytest.raises(Exception, match="not a time: yesterday"):
        data.collect()


def test_unsupported_arguments_are_named():
    with pytest.raises(UnsupportedArgument, match="'thousands'"):
        ReaderArgs.from_catalog({"thousands": ","})
    with pytest.raises(UnsupportedArgument, match="separator"):
        ReaderArgs.from_catalog({"sep": "[;,]"})
    assert ReaderArgs.from_catalog(None).na_values == MISSING_TEXTS
    assert ReaderArgs.from_catalog({"delimiter": "\t"}).sep == "\t"


def test_written_text_reads_back(spark, tmp_path):
    data = spark.sql(
        "SELECT * FROM VALUES (1.25D, timestamp_ntz '2000-01-01 00:00:00.000001', 'a \"q\", b'), "
        "(0.1D, timestamp_ntz '1999-12-31 23:59:59', NULL) AS t(v, time, s)"
    )
    target = str(tmp_path / "out.csv")
    writers.write_csv(data, target, "time")
    back, _ = gs.scan_csv(spark, target, ["v", "time", "s"], "time")
    assert rows(back) == rows(data)
    first = next((tmp_path / "out.csv").glob("part-*.csv")).read_text().splitlines()[0]
    assert first == "time,v,s"


def test_cell_table_is_written_once(spark, tmp_path):
    target = str(tmp_path / "cells")
    writers.write_cells(spark.range(5), target)
    writers.write_cells(spark.range(9), target)
    assert spark.read.parquet(target).count() == 5
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        writers.write_parquet(spark.range(1), target)


def test_partitioned_output_has_few_files(spark, tmp_path):
    data = spark.range(10_000).repartition(8).selectExpr("id % 5 AS entry_id", "id AS v")
    target = str(tmp_path / "out")
    writers.write_parquet(data, target, ["entry_id"])
    assert len(list((tmp_path / "out").glob("entry_id=*/*.parquet"))) <= 10
    assert spark.read.parquet(target).count() == 10_000


def test_raw_copies(spark, tmp_path):
    import hashlib

    source = put(tmp_path / "in", a__bin=b"\x00\x01" * 5_000_000, b__bin=b"")
    files = expand_path(spark, source)
    target = str(tmp_path / "out" / "raw")
    found = {r["path"].rsplit("/", 1)[1]: (r["length"], r["sha256"]) for r in rawcopy.raw_copy(files, target).collect()}
    for name in ("a.bin", "b.bin"):
        data = (tmp_path / "in" / name).read_bytes()
        assert (tmp_path / "out" / "raw" / name).read_bytes() == data
        assert found[name] == (len(data), hashlib.sha256(data).hexdigest())
    assert sorted(p.name for p in (tmp_path / "out" / "raw").iterdir()) == ["a.bin", "b.bin"]


def test_line_breaks_inside_quotes(spark, tmp_path):
    path = put(
        tmp_path / "d",
        a__csv='t,name,q\n2000-01-01,"a\nb",1\n2000-01-02,c,2\n',
        b__csv="t,name,q\n2000-01-03,12F,3\n",
    )
    data, files = gs.scan_csv(spark, path, ["t", "name", "q"], "t")
    assert dict(data.dtypes)["q"] == "bigint"
    assert rows(data) == [(datetime(2000, 1, 1), "a\nb", 1), (datetime(2000, 1, 2), "c", 2), (datetime(2000, 1, 3), "12F", 3)]
    assert status(files) == {"a.csv": ("read", "read with line breaks inside quotes"), "b.csv": ("read", None)}


def test_fields_parted_by_spaces_and_day_first_dates(spark, tmp_path):
    path = put(tmp_path / "d", a__txt="  date   q \n13.01.2000\t1.5\n 02.01.2000   2\n")
    data, files = gs.scan_csv(spark, path, ["date", "q"], "date", {"sep": r"\s+", "dayfirst": "True"})
    assert set(rows(data)) == {(datetime(2000, 1, 2), 2.0), (datetime(2000, 1, 13), 1.5)}
    assert status(files) == {"a.txt": ("read", None)}


def test_lines_that_are_too_long_exclude_a_file(spark, tmp_path):
    path = put(
        tmp_path / "d",
        a__csv="t,q\n2000-01-01,1,extra\n",
        b__csv='t,q\n2000-01-02,"2"\n',
        c__csv='t,q,r\n2000-01-03,3,\n',
        d__csv='t,q\n2000-01-04,"4",more\n',
        e__csv="t,q\n2000-01-05\n",
    )
    data, files = gs.scan_csv(spark, path, ["t", "q"], "t")
    found = status(files)
    assert {n: s for n, (s, _) in found.items()} == {
        "a.csv": "failed", "b.csv": "read", "c.csv": "read", "d.csv": "failed", "e.csv": "read",
    }
    assert "more fields" in found["a.csv"][1]
    assert rows(data) == [(datetime(2000, 1, 2), 2), (datetime(2000, 1, 3), 3), (datetime(2000, 1, 5), None)]


def test_skipped_lines_and_line_breaks_inside_quotes(spark, tmp_path):
    text = '"made\nby" someone\nt,name,q\n2000-01-01,"a\nb ""x""",1\n\n2000-01-02,c,\n'
    path = put(tmp_path / "d", a__csv=text)
    data, files = gs.scan_csv(spark, path, ["t", "name", "q"], "t", {"skiprows": 2})
    assert status(files) == {"a.csv": ("read", "read with line breaks inside quotes")}
    assert rows(data) == [(datetime(2000, 1, 1), 'a\nb "x"', 1), (datetime(2000, 1, 2), "c", None)]


def test_a_header_that_comes_again_makes_text(spark, tmp_path):
    path = put(tmp_path / "d", a__csv="v,w\n1,2\nv,w\n3,4\n")
    data, _ = gs.scan_csv(spark, path, ["v"])
    assert dict(data.dtypes) == {"v": "string"} and rows(data) == [("1",), ("3",), ("v",)]


def test_plans_do_not_grow_with_headers(spark, tmp_path):
    def make(folder, n_files, n_headers):
        folder.mkdir()
        for i in range(n_files):
            k = i % n_headers
            names = [f"x{j}" for j in range(k % 20)] + ["q"] + [f"y{k}"] + ["t"]
            values = ["0"] * (k % 20) + [str(i)] + ["z"] + ["2000-01-01"]
            (folder / f"f + {i:04}.csv").write_text(",".join(names) + "\n" + ",".join(values) + "\n")
        return gs.scan_csv(spark, str(folder), ["t", "q"], "t")

    few, _ = make(tmp_path / "few", 20, 20)
    many, files = make(tmp_path / "many", 1000, 200)
    assert files.where("status = 'read'").count() == 1000
    assert many.agg({"q": "sum"}).first()[0] == 999 * 500

    def operators(frame):
        return frame._jdf.queryExecution().optimizedPlan().numberedTreeString().count("\n")

    assert operators(many) == operators(few) < 20
