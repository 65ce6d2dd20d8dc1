"""CSV folders by header: names, not positions; records, not lines."""

import csv
import os

import pytest

from quarry.sources import catalogue as CAT
from quarry.sources import readers as RD


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        f.write(text)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_folder_glob_and_list_bind_by_name(spark, tmpdir_path):
    a, b = os.path.join(tmpdir_path, "in/a.csv"), os.path.join(tmpdir_path, "in/b.csv")
    _write(a, "id,amt\n1,10\n")
    _write(b, "amt,id\n20,2\n")
    _write(os.path.join(tmpdir_path, "in/empty.csv"), "")
    for path in (os.path.join(tmpdir_path, "in"), os.path.join(tmpdir_path, "in/*.csv"), [a, b]):
        got = RD.read_csv_by_name(spark, path, {"id": "long", "amt": "double"})
        assert _rows(got) == [(1, 10.0), (2, 20.0)]


def test_scans_are_those_of_the_headers(spark, tmpdir_path):
    heads = ["id,amt,note", "note,id", "id,extra,amt"]
    want = []
    for k in range(120):
        head = heads[k % 3].split(",")
        cells = {"id": str(k), "amt": f"{k}.5", "note": f"n{k}", "extra": "x"}
        _write(os.path.join(tmpdir_path, f"in/f{k:03}.csv"), ",".join(head) + "\n" + ",".join(cells[c] for c in head) + "\n")
        want.append((k, k + 0.5 if "amt" in head else None, f"n{k}" if "note" in head else None))
    found = CAT.layouts(spark, os.path.join(tmpdir_path, "in"))
    assert sorted(len(x.files) for x in found) == [40, 40, 40]
    got = RD.read_csv_by_name(spark, os.path.join(tmpdir_path, "in"), {"id": "long", "amt": "double", "note": "string"})
    assert got._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 3
    assert _rows(got) == sorted(want, key=str)


def test_large_file_is_read_in_splits_and_its_head_once(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "in/large.csv")
    _write(path, "id,amt\n" + "".join(f"{k},{k}\n" for k in range(50_000)))
    _write(os.path.join(tmpdir_path, "in/small.csv"), "amt,id\n7,-1\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        got = RD.read_csv_by_name(spark, os.path.join(tmpdir_path, "in"), {"id": "long", "amt": "double"})
        assert got.rdd.getNumPartitions() > 5
        assert got.count() == 50_001 and got.where("id = amt").count() == 50_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_odd_headers_keep_their_places(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "odd.csv")
    _write(path, "﻿a,,c.d,a, sp `x`,\"q,\"\"r\"\"\"\n1,2,3,4,5,6\n")
    (layout,) = CAT.layouts(spark, path)
    assert layout.names == ("a", "_c1", "c.d", "a.1", " sp `x`", 'q,"r"')
    got = RD.read_csv_by_name(spark, path, {n: "long" for n in ("c.d", "a.1", " sp `x`", 'q,"r"')}, keep_extra=True)
    assert _rows(got) == [(3, 4, 5, 6, "1", "2")]
    _write(os.path.join(tmpdir_path, "pre.csv"), "junk\n\na,,c\n1,2,3\n")
    pre = RD.read_csv_after_preamble(spark, os.path.join(tmpdir_path, "pre.csv"), 2)
    assert pre.columns == ["a", "_c1", "c"] and _rows(pre) == [("1", "2", "3")]


def test_records_with_line_breaks_behind_preambles(spark, tmpdir_path):
    first = "Title\n\"made\nby, hand\"\n\nName,\"Last\nvisit\",Id\n\"x\ny\",2020,1\n\nz,,\"3\"\"\"\n"
    second = ",,\nmade,,\n,,\nId,Name\n7,q\n"
    _write(os.path.join(tmpdir_path, "in/a.csv"), first)
    _write(os.path.join(tmpdir_path, "in/b.csv"), second)
    want = []
    for text in (first, second):  # what a CSV reader that knows records makes of them
        head, *rows = list(csv.reader(text.splitlines(keepends=True)))[3:]
        want += [{k: v or None for k, v in zip(head, r)} for r in rows if r]
    got = RD.read_csv_after_preamble(spark, os.path.join(tmpdir_path, "in"), 3)
    assert sorted(got.columns) == ["Id", "Last\nvisit", "Name"]
    assert sorted(str(sorted((k, v) for k, v in r.asDict().items() if v is not None)) for r in got.collect()) == \
        sorted(str(sorted((k, v) for k, v in r.items() if v is not None)) for r in want)


def test_broken_header_without_preamble_and_line_breaks_on_request(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "h.csv")
    _write(path, "id,\"two\nlines\"\n1,x\n2,\"a\nb\"\n")
    got = RD.read_csv_by_name(spark, path, {"id": "long", "two\nlines": "string"})
    assert _rows(got) == [(1, "x"), (2, "a\nb")]
    plain = os.path.join(tmpdir_path, "p.csv")
    _write(plain, "id,t\n1,\"x\ny\"\n")
    assert _rows(RD.read_csv_by_name(spark, plain, {"id": "long", "t": "string"}, multi_line=True)) == [(1, "x\ny")]


def test_no_header_at_all(spark, tmpdir_path):
    _write(os.path.join(tmpdir_path, "in/a.csv"), "")
    got = RD.read_csv_by_name(spark, os.path.join(tmpdir_path, "in"), {"id": "long", "t": "string"})
    assert got.count() == 0 and got.dtypes == [("id", "bigint"), ("t", "string")]
    stacked = RD.stack_yearly(spark, {2020: os.path.join(tmpdir_path, "in")}, {"id": "long"}, source_flag="f")
    assert stacked.count() == 0 and stacked.columns == ["id", "Year", "f"]


def test_yearly_folders(spark, tmpdir_path):
    _write(os.path.join(tmpdir_path, "2020/a.csv"), "CCN ,Beds\n1,10\n")
    _write(os.path.join(tmpdir_path, "2020/b.csv"), "Beds,CCN \n20,2\n")
    _write(os.path.join(tmpdir_path, "2021/a.csv"), "CCN \n3\n")
    got = RD.stack_yearly(spark, {y: os.path.join(tmpdir_path, str(y)) for y in (2020, 2021)}, {"k": "long", "Beds": "double"}, {"CCN ": "k"})
    assert _rows(got) == [(1, 10.0, 2020), (2, 20.0, 2020), (3, None, 2021)]


@pytest.mark.parametrize("lines, skip, want", [
    (["a,b"], 0, (["a", "b"], 1, False)), (["", "a"], 0, (["a"], 1, False)), (["x", "", "a"], 2, (["a"], 2, False)),
    (['"x', 'y"', "a"], 1, (["a"], 2, True)), (["x"], 1, None), ([], 0, None)])
def test_find_header(lines, skip, want):
    assert CAT.find_header(lines, skip) == want
