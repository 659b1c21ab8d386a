"""Every registered query against its SQL counterpart, and the shape of its plan."""

import contextlib
import io
import math
import re
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from courtside.catalog import ORACLE, QUERIES



@pytest.fixture(scope="module")
def db(sf_dir):
    connection = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def plain(value):
    return None if isinstance(value, float) and math.isnan(value) else value


def in_order(rows):
    return sorted(rows, key=lambda row: [(v is None, 0 if v is None else v) for v in row])


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, db, name):
    df = QUERIES[name](spark, sf_dir)
    check_plan(name, df)
    columns = sorted(df.columns)
    rows = [tuple(plain(r[c]) for c in columns) for r in df.collect()]
    assert rows
    if name not in ORACLE:
        return
    want = db.execute(ORACLE[name])
    heads = [d[0] for d in want.description]
    assert sorted(heads) == columns
    places = [heads.index(c) for c in columns]
    expected = [tuple(plain(r[i]) for i in places) for r in want.fetchall()]
    assert in_order(rows) == in_order(expected)


def check_plan(name, df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    for operator in ("PythonUDF", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
        assert operator not in plan
    # A window line ends in its partition keys and then its order, either of which may be absent.
    windows = re.findall(r"^\W*(?:\(\d+\) )?Window \[.*$", plan, re.M)
    assert all(has_partition_keys(line) or over_part_summaries(line) for line in windows), windows


def has_partition_keys(line):
    ending = re.search(r"\](?:, \[([^\[\]]+)\])?, \[([^\[\]]+)\]\s*$", line)
    return bool(ending) and (ending.group(1) is not None or not re.search(r" (ASC|DESC) ", ending.group(2)))


def over_part_summaries(line):
    """A window in the order of the parts alone sees one row per part of a cut table."""
    return bool(re.search(r"\], \[_part#\d+ ASC NULLS FIRST\]\s*$", line))


def test_window_lines_are_told_apart():
    assert has_partition_keys("+- Window [sum(a#1) x(b#2)], [k#3], [d#4 ASC NULLS FIRST]")
    assert has_partition_keys("+- Window [max(a#1) x()], [k#3]")
    assert not has_partition_keys("+- Window [sum(a#1) x(b#2)], [d#4 ASC NULLS FIRST]")
    assert not has_partition_keys("+- Window [max(a#1) x()]")


def test_entry(spark):
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())
    assert entry.entry(spark).columns == QUERIES["rolling_mean"](spark, entry.SMOKE_DIR).columns


def test_entry_without_a_library_of_the_corpus_queries():
    code = "import sys; sys.modules['zstandard'] = None; import __spark_entry__ as e; print(len(e.queries()), 'pipeline' in e.queries())"
    done = subprocess.run([sys.executable, "-c", code], cwd=Path(entry.__file__).parent, capture_output=True, text=True)
    assert done.stdout.split() == [str(len(QUERIES)), "False"], done.stderr


def test_filter_and_columns_reach_the_scan(spark, sf_dir):
    with contextlib.redirect_stdout(io.StringIO()) as printed:
        QUERIES["scan_filter"](spark, sf_dir).explain("formatted")
    plan = printed.getvalue()
    assert re.search(r"PushedFilters: \[.*LessThan\(l_shipdate.*\]", plan)
    assert "l_partkey" not in re.search(r"ReadSchema: .*", plan).group(0)


def test_chained_history_shares_one_shuffle(spark, sf_dir):
    for name in ("rolling_mean", "blend", "trend", "rolling_rate"):
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1, name
        assert plan.count("Sort [") == 1, name


def test_flattening_does_not_shuffle(spark):
    from courtside.sources import documents

    raw = documents.parse_documents(spark.createDataFrame([(1, "{}")], "match_id long, json string"))
    for rows in (documents.pbp_rows, documents.shot_rows, documents.box_rows):
        assert "Exchange" not in rows(raw)._jdf.queryExecution().executedPlan().toString()
