"""Captions, bindings, states and targets on single cases."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from trackloom.functions import lexicon as lx
from trackloom.operators import evaluation as va
from trackloom.operators import events as ev
from trackloom.plans.views import observations
from trackloom.sources import tables as st

#: (caption, objects, actions)
CAPTIONS = [
    ("unboxing the push chopper", ["push chopper"], ["REMOVE"]),
    ("unboxing the push chopper", None, ["PUSH"]),
    ("placing a digital thermometer on top of a red folder", [], ["PLACE"]),
    ("placing it on the holder", [], ["PLACE"]),
    ("placing the push chopper into the cardboard box and closing the lid", ["push chopper", "cardboard box"], ["INSERT", "CLOSE"]),
    ("opening and unpacking a cardboard box", ["cardboard box"], ["OPEN"]),
    ("removes the chopper from the box and then places the box back down", ["box", "chopper"], ["REMOVE", "PLACE"]),
    ("places the box, and the tape goes into the bag", ["box"], ["PLACE"]),
    ("picking up a cup, picking up a plate", ["cup"], ["PICK"]),
    ("folding the flaps and placing the box down", ["box"], ["UNKNOWN"]),
    ("let go of the lid", [], ["RELEASE"]),
    ("moving the pen out of the cup", [], ["REMOVE"]),
    ("resting near the box", ["box"], ["UNKNOWN"]),
    ("", [], ["UNKNOWN"]),
    (None, ["x"], ["UNKNOWN"]),
]


def test_actions_of_captions(spark):
    rows = spark.createDataFrame([(i, c, o) for i, (c, o, _) in enumerate(CAPTIONS)], "i long, c string, o array<string>")
    got = {r.i: r.v for r in rows.select("i", F.transform(lx.action_clauses(F.col("c"), F.col("o")), lambda a: a["verb"]).alias("v")).collect()}
    assert [got[i] for i in range(len(CAPTIONS))] == [v for _, _, v in CAPTIONS]


def test_blanking_keeps_offsets(spark):
    text = "unboxing the push chopper (new) from a box"
    got = spark.range(1).select(lx.blanked(F.lit(text), F.array(F.lit("box"), F.lit("Push Chopper"), F.lit("(new)"), F.lit(" ")))).first()[0]
    assert len(got) == len(text) and got.startswith("unboxing the              ") and got.endswith("from a    ")


@pytest.mark.parametrize(
    ("text", "objects", "at", "want"),
    [
        ("placing the push chopper back into the box", ["box", "push chopper"], 1, ["push chopper", "box"]),
        ("opening the box, then removing the chopper", ["box", "chopper"], 23, ["chopper", "box"]),
        ("from the cardboard box the cup is taken", ["cardboard box", "cup"], 0, ["cup", "cardboard box"]),
        ("waving", ["a", "b"], 1, ["a", "b"]),
    ],
)
def test_objects_in_order(spark, text, objects, at, want):
    assert spark.range(1).select(lx.ordered_objects(F.lit(text), F.array(*map(F.lit, objects)), F.lit(at))).first()[0] == want


OBS = "video_id long, segment_id string, observation_id long, status string, raw_action string, objects array<string>, actor string, visible_facts string, state_change string, confidence double, seg_start double, seg_end double, start_sec double, end_sec double"
TRACKS = "video_id long, segment_id string, track_id long, class_name string, n_points long, surface boolean"


def observed(spark, *rows):
    return spark.createDataFrame([(0, "s", i, "SUCCESS", *r, 0.5, 0.0, 8.0, None, None) for i, r in enumerate(rows)], OBS)


def test_clauses_bind_their_own_objects(spark):
    tracks = [(1, "Person", 5, False), (2, "person", 9, False), (3, "push chopper", 4, False), (13, "push chopper", 50, True), (6, "cardboard box", 7, False), (7, "dining table", 90, False)]
    tracks = spark.createDataFrame([(0, "s", *t) for t in tracks], TRACKS)
    o = observed(spark, ("placing the push chopper into the box and closing the lid", ["box", "push chopper"], "hand", None, None), ("pushing the dining table", ["dining table"], None, None, None), ("removes the chopper and then places the box down", ["box", "push chopper"], None, None, None))
    changes = spark.createDataFrame([(0, "s", x) for x in (2.0, 5.0)], "video_id long, segment_id string, sec double")
    got = {r.event_id: r for r in ev.extract(o, tracks, changes).collect()}
    assert (got["evt_0_0"].object_id, got["evt_0_0"].object_label, got["evt_0_0"].actor_id) == (3, "push chopper", 2)  # not the picture on the box, though it is longer
    assert (got["evt_0_1"].action, got["evt_0_1"].object_id, got["evt_0_1"].object_label) == ("CLOSE", None, None)
    assert (got["evt_0_0"].end_sec, got["evt_0_1"].start_sec, got["evt_0_1"].timing_source) == (5.0, 5.0, "CHANGE_POINT")
    assert (got["evt_1"].object_id, got["evt_1"].object_label, got["evt_1"].timing) == (None, "dining table", "SEGMENT")
    assert [got[f"evt_2_{i}"].object_id for i in (0, 1)] == [3, 6]
    bare = ev.extract(o, tracks.where("false")).where("observation_id = 1").first()
    assert (bare.actor_id, bare.n_people, bare.identity.status) == (None, 0, "UNRESOLVED")


#: (action, what is said, state before, state after) of a first event
STATES = [
    ("PICK", "the cup is held, lifted", "UNKNOWN", "IN_HAND"),
    ("PICK", "picked up from the shelf", "ON_SURFACE", "IN_HAND"),
    ("PICK", "it was not lifted, held down", "UNKNOWN", "UNKNOWN"),
    ("GRASP", "not lifted but held", "UNKNOWN", "IN_HAND"),
    ("PLACE", "was holding it, put down", "IN_HAND", "ON_SURFACE"),
    ("PLACE", "not placed", "UNKNOWN", "UNKNOWN"),
    ("OPEN", "", "UNKNOWN", "OPEN"),
    ("OPEN", "the lid was closed", "CLOSED", "OPEN"),
    ("OPEN", "it was already open", "UNKNOWN", "UNKNOWN"),
    ("CLOSE", "was open before", "OPEN", "CLOSED"),
    ("INSERT", "put in the box", "UNKNOWN", "UNKNOWN"),
]


def test_states_of_events(spark):
    identity = F.struct(F.lit(None).cast("long").alias("track"), F.col("name").alias("label"), F.lit("UNRESOLVED").alias("status"))
    rows = [(0, "s", i, 0, f"e{i}", a, said, f"o{i}", 0.0, 1.0, "EXACT") for i, (a, said, _, _) in enumerate(STATES)]
    rows += [(0, "s", 100 + i, 0, f"x{i}", a, "", "door", float(i), i + 1.0, "EXACT") for i, a in enumerate(("OPEN", "CLOSE", "PUSH", "OPEN"))]
    e = spark.createDataFrame(rows, "video_id long, segment_id string, observation_id long, clause long, event_id string, action string, said string, name string, start_sec double, end_sec double, timing string").withColumn("identity", identity)
    got = {r.event_id: (r.before, r.after) for r in ev.transitions(e).collect()}
    assert [got[f"e{i}"] for i in range(len(STATES))] == [(b, a) for _, _, b, a in STATES]
    assert [got[f"x{i}"] for i in range(4)] == [("UNKNOWN", "OPEN"), ("OPEN", "CLOSED"), ("CLOSED", "UNKNOWN"), ("UNKNOWN", "OPEN")]


def test_targets_of_events(spark):
    schema = "video_id long, event_id string, observation_id long, clause long, action string, actor string, actor_id long, n_people long, object_id long, object_label string, objects array<string>, timing string, start_sec double, end_sec double"
    rows = [(0, f"e{i}", i, 0, "PICK", None, None, n, o, name, objs, "EXACT", 0.0, 1.0) for i, (n, o, name, objs) in enumerate([(2, 7, "cup", ["x"]), (1, None, None, ["cup"]), (0, None, None, ["a", "b"]), (0, None, None, []), (0, None, None, ["z"])])]
    states = [("e4", "t1", None, "lid", "UNRESOLVED"), ("e4", "t2", 5, "box", "RESOLVED"), ("e4", "t3", 5, "carton", "RESOLVED"), ("e0", "t4", 7, "cup", "RESOLVED")]
    states = spark.createDataFrame([(0, *x) for x in states], "video_id long, event_id string, transition_id string, state_track long, state_label string, state_status string")
    links = ev.edges(spark.createDataFrame(rows, schema), states)
    got = sorted((r.event_id, r.target_id, r.actor_resolution, r.object_resolution, r.state_ids) for r in links.collect())
    assert got == [
        ("e0", "node_track_7", "AMBIGUOUS", "RESOLVED", ["t4"]),
        ("e1", "node_unresolved_1_cup", "UNRESOLVED", "UNRESOLVED", None),
        ("e2", "node_unresolved_2_multiple_ambiguous", "UNRESOLVED", "AMBIGUOUS", None),
        ("e3", "node_unresolved_3_unknown", "UNRESOLVED", "UNRESOLVED", None),
        ("e4", "node_track_5", "UNRESOLVED", "RESOLVED", ["t2", "t3"]),
        ("e4", "node_unresolved_4_lid", "UNRESOLVED", "UNRESOLVED", ["t1"]),
    ]
    roles = {r.node_id: r.role for r in ev.nodes(links).collect()}
    assert roles["node_unresolved_3_unknown"] == "PERSON"  # the first that names a node keeps it


def test_causes(spark):
    schema = "verdict string, got string, captions array<struct<raw_action:string>>"
    rows = [("TOP1", "X", None), ("MISS", "X", None), ("NO_EVENTS", None, []), ("MISS", "X", [("",)]), ("ANY_ONLY", "X", [("a",)]), ("MISS", "UNKNOWN", [("a",)]), ("NO_EVENTS", None, [("a",)]), ("MISS", "X", [("a",)])]
    df = spark.createDataFrame(rows, schema)
    assert [r[0] for r in df.select(va.cause(df)).collect()] == ["CORRECT", "UNKNOWN_CAUSE", "NO_SEGMENT", "VLM_FAILED", "RANKING", "UNMAPPED", "UNMAPPED", "WRONG_VERB"]


def test_labels_and_rows(spark):
    assert len(va.LABEL_ACTIONS) == 43
    df = spark.createDataFrame([("Putting [something] into  [something]",), ("Folding [something]",), (None,)], "t string")
    assert [r[0] for r in df.select(va.label_action(F.col("t"))).collect()] == ["INSERT", None, None]
    files = spark.createDataFrame([(1, '[{"a": 1}, 5]'), (2, '{"events": [{"a": 2}]}'), (3, "{broken"), (4, None), (5, '{"x": 1}')], "id long, text string")
    assert sorted(map(tuple, st.flattened(files, "text", "a long").collect())) == [(1, 1), (2, 2)]


def test_written_rows_come_back(spark, tmp_path):
    df = spark.createDataFrame([(0, "a"), (1, "b")], "video_id long, name string")
    st.write_rows(df, str(tmp_path / "out"))
    assert sorted(map(tuple, spark.read.json(str(tmp_path / "out")).select("video_id", "name").collect())) == [(0, "a"), (1, "b")]


def test_captions_are_read_once_and_by_all_cores(spark):
    sf_dir = "/root/testdata/sf0.001"
    for name in ("f2_h16_object_order", "h11_events", "h13_h14_action_clauses"):
        plan = entry.queries()[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
        assert not any("unbox|unpack" in line for line in plan.splitlines() if line.strip(" +-:").startswith("Filter"))
    assert observations(spark, sf_dir).rdd.getNumPartitions() == 4 * spark.sparkContext.defaultParallelism


def test_costly_parts_are_worked_out_once(spark):
    plan = lambda c: spark.range(1).selectExpr("'Open' t", "array(1D) c", "cast(id as int) n").select(c.alias("x"))._jdf.queryExecution().analyzed().toString().splitlines()[0]
    assert plan(ev.clause_windows(F.col("c"), F.lit(0.0), F.lit(2.0), F.col("n"))).count("array_distinct(") == 1
    assert plan(lx.evidence(F.lower("t"))).count("lower(") == 1
