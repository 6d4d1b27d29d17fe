"""Delimited files against Python's csv module, and what a load rejects."""

from __future__ import annotations

import csv
import gzip
import io

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from phenolith.session import scratch_path
from phenolith.sources import delimited
from phenolith.sources import records as L
from conftest import d


@pytest.fixture(scope="module", autouse=True)
def small_splits(spark):
    """Files of a few hundred bytes in many splits."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "60")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


ODD = [
    'a\t"b ""c"" d"\te', 'x\\\ty\tz', '"tab\there"\t2\t3', '5" bandage\tp"q"\tr', '""\t"only"\t', '"ab"cd\t\\"\t""""', '1\t2\t3\t4\t5', 'short',
    '"a,b"\tc,d\t"\\"', "", "ünï\t\U0001F600\t' '",
]
BROKEN = ['"first\nsecond\n\nthird"\t1\t2', 'plain\t1\t2', '"x ""y\nz"" w"\t"\n"\t3', 'last\t"a\n"\t']


@pytest.mark.parametrize("lines", [ODD, BROKEN + ODD, BROKEN * 20])
def test_records_are_those_of_csv(spark, tmp_path, lines):
    for k in range(3):
        (tmp_path / f"part{k}.txt").write_text("\n".join(["h1\th2\th3", *lines[k:], f"end{k}\t\t"]) + "\n")
    want = []
    for k in range(3):
        with open(tmp_path / f"part{k}.txt") as f:
            want += [r for r in csv.reader(f, delimiter="\t") if r and r != ["h1", "h2", "h3"]]
    got = [r.cells for r in delimited.read_records(spark, str(tmp_path), "\t", skip="h1\th2\th3").collect()]
    assert sorted(got) == sorted(want)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(st.text(alphabet='ab",\\ \n\t\'', max_size=8), min_size=2, max_size=4), min_size=1, max_size=12), st.booleans())
def test_round_trip_of_any_cells(spark, tmp_path_factory, rows, quote_all):
    path = tmp_path_factory.mktemp("csv") / "f.csv"
    with open(path, "w", newline="") as f:
        csv.writer(f, quoting=csv.QUOTE_ALL if quote_all else csv.QUOTE_MINIMAL, lineterminator="\n").writerows(rows)
    with open(path) as f:
        want = [r for r in csv.reader(f) if r]
    assert sorted(r.cells for r in delimited.read_records(spark, str(path), ",").collect()) == sorted(want)


def test_wide_file_with_quotes(spark, tmp_path):
    rows = [["eid", "31-0.0", "20002-1.3", "22000"], ["1", 'say "hi", he', "a\\", ""], ["2", "two\nlines", '"', "7"], ["x3", "lost", "", ""], ["4", "", "", "8", "more"]]
    text = io.StringIO()
    csv.writer(text, lineterminator="\n").writerows(rows)
    plain, packed = tmp_path / "w.csv", tmp_path / "w.csv.gz"
    plain.write_text(text.getvalue())
    packed.write_bytes(gzip.compress(text.getvalue().encode()))
    for path in map(str, (plain, packed)):
        got = sorted(tuple(r) for r in L.wide_csv_to_long(spark, path).collect())
        assert got == [(1, 31, 0, 0, 'say "hi", he'), (1, 20002, 1, 3, "a\\"), (2, 31, 0, 0, "two\nlines"), (2, 20002, 1, 3, '"'), (2, 22000, 0, 0, "7"), (4, 22000, 0, 0, "8")]
        bad = sorted((r.line, r.column, r.value, r.reason) for r in L.wide_rejects(spark, path).collect())
        assert bad == [(5, "eid", "x3", "not an integer"), (6, None, "more", "beyond the header")]


def test_plan_does_not_grow_with_columns(spark, tmp_path):
    plans = []
    for n in (9, 9000):
        path = tmp_path / f"{n}.csv"
        path.write_text(",".join(["eid", *(f"{100 + k}-0.{k % 7}" for k in range(n))]) + "\n" + ",".join(["1", *("v" for _ in range(n))]) + "\n")
        long = L.wide_csv_to_long(spark, str(path))
        plans.append(long._jdf.queryExecution().executedPlan().toString().count("\n"))
        assert long.count() == n
    assert plans[0] == plans[1]


def test_rejects_have_file_line_column_and_reason(spark, tmp_path):
    rows = ["eid\tins_index\tepistart\tepiend\tadmidate\tdisdate\tnote"]
    rows += [f"{i}\t{i}\t01/02/2010\t\t\t\tn{i}" for i in range(1, 30)]
    rows += ['x\t1\t\t\t\t\t', '31\ty2\t31/02/2010\t""\t\t\t"a ""b"" c"', "32\t1\t\t\t\t\t\tmore\tcells", "33\t1", "34\t4\t\t\t\t\tok\\"]
    (tmp_path / "hesin.txt").write_text("\n".join(rows) + "\n")
    path, root = str(tmp_path / "hesin.txt"), scratch_path(spark, "loaded")
    assert L.load_table(spark, path, "hesin", root, None) == 5
    got = sorted((r.table, r.line, r.column or "", r.value, r.reason) for r in L.rejects(spark, root).collect())
    assert got == [
        ("hesin", 31, "eid", "x", "not an integer"), ("hesin", 32, "epistart", "31/02/2010", "not a date"),
        ("hesin", 32, "ins_index", "y2", "not an integer"), ("hesin", 33, "", "more\tcells", "beyond the header"),
        ("hesin", 34, "", "2", "fewer cells than the header")]
    table = {r.eid: r for r in spark.read.parquet(f"{root}/hesin").collect()}
    assert len(table) == 34 and table[31].note == 'a "b" c' and table[34].note == "ok\\" and table[1].epistart == d("2010-02-01")
    assert table[33].admidate is None and table[32].ins_index == 1


def test_written_files_are_read_by_csv(spark, tmp_path):
    rows = [(1, 'a "b"', "x\ty"), (2, "back\\", " lead and trail "), (3, "two\nlines", "'")]
    L.write_record_tsv(spark.createDataFrame(rows, "eid long, a string, b string").coalesce(1), str(tmp_path / "out"))
    [part] = (tmp_path / "out").glob("part-*")
    with open(part) as f:
        assert list(csv.reader(f, delimiter="\t")) == [["eid", "a", "b"], *[[str(e), a, b] for e, a, b in rows]]
