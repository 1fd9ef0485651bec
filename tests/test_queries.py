"""Queries with SQL give the rows that DuckDB gives, on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from trackloom.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return None if v != v else round(v, 5)
    return v


def rows(cols, records):
    return sorted((tuple(str(plain(r[c])) for c in cols) for r in records))


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_matches_sql(spark, duck, name):
    got = entry.queries()[name](spark, SF)
    want = duck.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in want.description]
    assert sorted(cols) == sorted(got.columns)
    assert rows(got.columns, [r.asDict() for r in got.collect()]) == rows(got.columns, [dict(zip(cols, r, strict=True)) for r in want.fetchall()])


def test_places_are_those_of_sql(spark, duck):
    """Halves at any size and sign, and what lies right beside them, are rounded as the SQL rounds them."""
    halves = [(2 * i + 1) / 2 / 10**4 for i in (*range(0, 40_000, 7), 123_456_789, 10**12)]
    values = [s * v for h in halves for v in (h, math.nextafter(h, 0), math.nextafter(h, 1e9)) for s in (1, -1)] + [0.0, -0.0, 0.49999999999999994e-4, 1e300, None]
    got = spark.createDataFrame([(v,) for v in values], "v double").select(catalog.to_places("v", 4).alias("r")).collect()
    want = duck.execute("select round(v, 4) from (select unnest(?::double[]) v)", [values]).fetchall()
    assert [str(r.r) for r in got] == [str(w[0]) for w in want]


def test_poses_are_rounded_as_sql_rounds(spark, tmp_path):
    """Of these users' poses one has a mean of 2.82325 and one of 6.63975, in shortest decimals."""
    c = duckdb.connect()
    c.execute(f"copy (select * from '/root/testdata/sf0.1/events.parquet' where user_id in (777, 1289, 428, 1204)) to '{tmp_path}/events.parquet' (format parquet)")
    c.execute(f"create view events as select * from '{tmp_path}/events.parquet'")
    want = c.execute(entry.oracle_sql()["d12_pose_spread"]).fetchall()
    got = entry.queries()["d12_pose_spread"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got)) == sorted(want) and len(want) == 2


def test_entry(spark):
    assert entry.entry(spark).count() == 4


def test_joins_have_keys(spark):
    for name in ("c1_person_object_contacts", "c15_best_container", "c9_m1_assess"):
        plan = entry.queries()[name](spark, SF)._jdf.queryExecution().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
