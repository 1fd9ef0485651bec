"""Upserts that are there as a whole or not at all."""

import pytest

from trackloom.sources import commits


def rows(df):
    return sorted((r.video_id is not None, r.video_id or 0, r.i, r.x) for r in df.collect())


def test_an_upsert_that_stops_leaves_the_table(spark, tmp_path):
    root, form = str(tmp_path / "t"), "video_id long, i int, x string"
    assert commits.current(spark, root) is None
    first = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c"), (None, 1, "d")], form)
    commits.upsert(root, first, ["i"])
    before = rows(commits.current(spark, root))
    assert before == [(False, 0, 1, "d"), (True, 1, 1, "a"), (True, 1, 2, "b"), (True, 2, 1, "c")]

    change = spark.createDataFrame([(1, 2, "B"), (3, 9, "n")], form)
    commits.stage(root, change, ["i"])  # killed between stage and commit
    assert rows(commits.current(spark, root)) == before
    broken = change.selectExpr("video_id", "if(i = 9, cast(raise_error('killed') as int), i) as i", "x")
    with pytest.raises(Exception, match="killed"):
        commits.upsert(root, broken, ["i"])
    assert rows(commits.current(spark, root)) == before

    want = [(False, 0, 1, "d"), (True, 1, 1, "a"), (True, 1, 2, "B"), (True, 2, 1, "c"), (True, 3, 9, "n")]
    assert rows(commits.upsert(root, change, ["i"])) == want
    assert rows(commits.upsert(root, spark.createDataFrame([(None, 1, "e")], form), ["i"])) == [(False, 0, 1, "e"), *want[1:]]
    assert commits.vacuum(spark, root) and not commits.vacuum(spark, root)
    assert rows(commits.current(spark, root)) == [(False, 0, 1, "e"), *want[1:]]


def test_an_empty_upsert(spark, tmp_path):
    root, form = str(tmp_path / "t"), "video_id long, i int, x string"
    commits.upsert(root, spark.createDataFrame([(1, 1, "a")], form), ["i"])
    assert rows(commits.upsert(root, spark.createDataFrame([], form), ["i"])) == [(True, 1, 1, "a")]
