import pytest
from pyspark.sql import functions as F

from trackloom.operators import events, reports
from trackloom.sources import answers


def one_by_one(sizes, limit):
    """Every open group takes one in turn; the order in which shares are dealt does not matter."""
    got = dict.fromkeys(sizes, 0)
    while sum(got.values()) < min(limit, sum(sizes.values())):
        for k in sorted(sizes):
            if got[k] < sizes[k] and sum(got.values()) < limit:
                got[k] += 1
    return got


@pytest.mark.parametrize("limit", [0, 1, 2, 5, 7, 11, 30, 100])
@pytest.mark.parametrize("sizes", [{"a": 3}, {"a": 1, "b": 9, "c": 4}, {"d": 5, "a": 5, "b": 5}, {"a": 0, "b": 2}])
def test_quotas(sizes, limit):
    assert reports.quotas(sizes, limit) == one_by_one(sizes, limit)


def test_draw_of_empty_and_null_groups(spark):
    df = spark.createDataFrame([("x", 1), (None, 2), ("x", 3), ("y", 4)], "g string, i long")
    assert sorted(r.i for r in reports.balanced_draw(df, "g", "i", 2).collect()) == [1, 4]
    assert reports.balanced_draw(df.where("i > 9"), "g", "i", 2).count() == 0


def test_labels(spark):
    labels = ("push chopper", "picture of a push chopper", "printed carton label")
    want = {"a push chopper": labels[0], "Push Chopper.": labels[0], "chopper picture": labels[1], "chopper": labels[0], "##on label": labels[2], "choppe": labels[1], " . ": "unmatched", "cup": "cup", None: None}
    df = spark.createDataFrame([(k,) for k in want], "span string")
    assert {r.span: r.label for r in df.withColumn("label", reports.resolved_label(F.col("span"), labels)).collect()} == want


def test_clause_windows(spark):
    rows = [([1.0, 2.0, 2.0, 3.0, 9.0], 0.0, 5.0, 3), ([1.0], 0.0, 5.0, 3), ([1.0], 0.0, 5.0, 1), ([], 0.0, 5.0, 2), ([1.0], 0.0, 5.0, 2)]
    df = spark.createDataFrame(rows, "c array<double>, s double, e double, n int")
    got = [r.w and [tuple(x) for x in r.w] for r in df.select(reports.clause_windows(F.col("c"), F.col("s"), F.col("e"), F.col("n")).alias("w")).collect()]
    assert got == [[(0.0, 2.0), (2.0, 3.0), (3.0, 5.0)], None, None, None, [(0.0, 1.0), (1.0, 5.0)]]


def test_profile_of_nested_fields(spark):
    df = spark.sql("select * from values (1, array(named_struct('a', 'x', 'b', array(1.5D, null))), map('k', 2)), (2, null, map()), (null, array(null, named_struct('a', 'y', 'b', null)), null) t(id, items, tags)")
    got = {r.path: r for r in reports.profile(df).collect()}
    counts = {k: (r.kind, r.n, r.n_null, r.lists, r.shortest, r.longest) for k, r in got.items()}
    assert counts["id"] == ("int", 3, 1, None, None, None) and got["id"].n_distinct == 2 and (got["id"].least, got["id"].most) == (1.0, 2.0)
    assert counts["items"] == ("array", 3, 1, 3, 1, 2) and got["items"].mean_length == 1.5
    assert counts["items[]"] == ("struct", 3, 1, None, None, None)
    assert counts["items[].a"] == ("string", 3, 1, None, None, None) and got["items[].a"].n_distinct == 2
    assert counts["items[].b"] == ("array", 3, 2, 2, 2, 2) and counts["items[].b[]"] == ("double", 2, 1, None, None, None)
    assert counts["tags"] == ("map", 3, 1, 1, 0, 1) and got["tags[].value"].most == 2.0 and got["tags[].key"].n == 1
    assert reports.profile(df.limit(0)).count() == 0


def test_profile_sketches(spark):
    r = {x.path: x for x in reports.profile(spark.range(0, 20_000, 1, 8).select((F.col("id") % 5000).alias("v"))).collect()}["v"]
    assert abs(r.n_distinct - 5000) < 400 and abs(r.median - 2500) < 60


def test_answers_are_whole_or_failed(spark):
    said = {1: ['[{"a": 1}, {"b": 2}]'], 2: ["no", "x [{\"a\": 1}, 7] y", '{"c": [3]} done'], 3: ["[]", "[1]", "{"], 4: [None, None, None]}

    def call(row, attempt):
        text = said[row["id"]][attempt - 1]
        if text is None:
            raise OSError("down")
        return text

    df = spark.createDataFrame([(k, "r") for k in said], "id long, row string")
    got = sorted((r.id, r.status, r.nth, r.row, r.attempts, bool(r.error)) for r in answers.answered(df, ["id"], call).collect())
    assert got == [(1, "SUCCESS", 0, '{"a": 1}', 1, False), (1, "SUCCESS", 1, '{"b": 2}', 1, False), (2, "SUCCESS", 0, '{"c": [3]}', 3, False), (3, "FAILED", 0, None, 3, True), (4, "FAILED", 0, None, 3, True)]
    assert answers.answered(df.limit(0), ["id"], call).count() == 0


def test_answers_go_on_where_a_run_stopped(spark, tmp_path):
    df = spark.range(40).select("id")
    path, log = str(tmp_path / "answers"), str(tmp_path / "log")

    def call(row, attempt):
        with open(log, "a") as f:
            f.write(f"{row['id']}\n")
        return '{"n": %d}' % row["id"]

    def stops(row, attempt):
        if row["id"] == 25:
            raise SystemExit("killed")  # no error of the call: the task dies with it
        return call(row, attempt)

    with pytest.raises(Exception):  # noqa: B017
        answers.answer_into(path, df, ["id"], stops, parts=5)
    before = spark.read.schema("id long, status string").parquet(path).count()
    done = set(open(log).read().split())
    open(log, "w").close()
    got = answers.answer_into(path, df, ["id"], call, parts=5)
    assert 0 < before < 40 and sorted((r.id, r.row) for r in got.collect()) == [(i, '{"n": %d}' % i) for i in range(40)]
    assert len(open(log).read().split()) == 40 - before and len(done) >= before


def test_interleave_by_brute_force(spark):
    rows = [("hot", i) for i in range(500)] + [("b", 7), ("b", 3), (None, 1), (None, 2), ("c", 0)]
    got = {(r.g, r.i): (r.turn, r.place) for r in events.interleave(spark.createDataFrame(rows, "g string, i long").repartition(5), "g", "i").collect()}
    turn = {(g, i): sum(h == g and j <= i for h, j in rows) for g, i in rows}
    order = {g: n for n, g in enumerate([None, "b", "c", "hot"])}
    assert got == {k: (t, sum(u == t and order[h] <= order[k[0]] for (h, _), u in turn.items())) for k, t in turn.items()}
    assert events.interleave(spark.createDataFrame([], "g string, i long"), "g", "i").count() == 0
