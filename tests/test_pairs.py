"""Pairs of tracks in blocks: one block and many give what a loop over all pairs gives, and no pair is shuffled."""

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from trackloom.operators import media as m
from trackloom.operators import pairs as pr
from trackloom.operators import tracks as tr

COLUMNS = "video_id long, track_id long, class_name string, frame_index long, ts_sec double, x1 double, y1 double, x2 double, y2 double, conf double"


def points(seed: int) -> list[tuple]:
    rnd = random.Random(seed)
    out = []
    for video, track in itertools.product(range(2), range(14)):
        kind = ("person", "cup", "dining table")[track % 3]
        for frame in sorted(rnd.sample(range(30), 18)):
            x, y, w = rnd.choice((0.0, 5.0, 40.0)), rnd.choice((0.0, 5.0)), rnd.choice((4.0, 20.0, 60.0))
            out.append((video, track, kind, frame, frame / 30, x, y, x + w, y + w, rnd.choice((0.0, 0.9, 0.9, 0.9))))
    return out


def inside(a: tuple, b: tuple) -> bool:
    across, down = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    both, size = max(0, across) * max(0, down), (a[2] - a[0]) * (a[3] - a[1])
    return both == size and both / ((b[2] - b[0]) * (b[3] - b[1])) < 0.45


def by_pair(rows: list[tuple]) -> dict:
    frames, out = {}, {}
    for r in sorted((r for r in rows if r[9] > 0), key=lambda r: r[3]):
        frames.setdefault((r[0], r[3]), []).append(r)
    for (video, frame), here in frames.items():
        for a, b in itertools.permutations(here, 2):
            out.setdefault((video, a[1], b[1]), []).append((frame, inside(a[5:9], b[5:9])))
    return out


def turns(states: list[tuple]) -> list[tuple]:
    runs = [(list(v)) for _, v in itertools.groupby(states, key=lambda s: s[1])]
    long = [(v[0][0], v[0][1]) for v in runs if len(v) >= 2]
    return [b for a, b in itertools.pairwise(long) if a[1] != b[1]]


@pytest.mark.parametrize("most", [250_000, 40])
def test_pairs_match_a_loop(spark, monkeypatch, most):
    monkeypatch.setattr(pr, "BLOCK_POINTS", most)
    rows = points(most)
    df, want = spark.createDataFrame(rows, COLUMNS), by_pair(rows)
    got = {(r.video_id, r.inner_id, r.outer_id): (r.shared, r.n_inside) for r in m.enclosed_share(df).collect()}
    assert got == {k: (len(v), sum(s for _, s in v)) for k, v in want.items()}
    assert {(r.video_id, r.inner_id, r.outer_id) for r in tr.always_inside(df).collect()} == {k for k, v in want.items() if all(s for _, s in v)}
    flips = sorted((r.video_id, r.track_id, r.outer_id, r.frame_index, r.kind == "ENCLOSE_START") for r in tr.enclosure_changes(df).collect())
    assert flips == sorted((*k, *t) for k, v in want.items() for t in turns(v)) and flips
    both = {(r.video_id, r.track_id_a, r.track_id_b): r.shared for r in tr.shared_frames(df, same_class=False).collect()}
    assert both == {k: len(v) for k, v in want.items() if k[1] < k[2]}
    poses = {(r.video_id, r.track_id, r.outer_id): r.n for r in tr.pose_spread(df).collect()}
    assert poses == {k: len(v) for k, v in want.items() if k[1] % 3 != 2 and k[2] % 3 == 2}


@pytest.mark.parametrize("make", [tr.always_inside, tr.shared_frames, tr.best_container, tr.pose_spread, tr.enclosure_changes, m.enclosed_share])
def test_pairs_are_not_shuffled(spark, make):
    """Only blocks are dealt: no join of points with points, and nothing is aggregated or sorted by pair."""
    plan = make(spark.createDataFrame(points(1), COLUMNS))._jdf.queryExecution().optimizedPlan().toString()
    assert "inner_id" not in plan.split("FlatMapGroupsInArrow", 1)[1].split("\n", 1)[1]
    assert "FlatMapGroupsInArrow" in plan


@pytest.mark.parametrize("make", [tr.shared_frames, tr.pose_spread, tr.enclosure_changes, m.enclosed_share])
def test_groups_of_a_video_are_dealt_to_many_tasks(spark, monkeypatch, make):
    """However few bytes they have: their work is not by bytes, and no join leaves them where their video is."""
    monkeypatch.setattr(pr, "BLOCK_POINTS", 40)
    df = spark.createDataFrame([r for r in points(4) if r[0] == 0], COLUMNS)
    assert make(df).select(F.spark_partition_id()).distinct().count() > 2


@pytest.mark.parametrize(("pairs", "met", "strip"), [(1, 1, 1), (20, 9, 60), (1 << 16, 1 << 16, 1 << 25)])
def test_meetings_in_parts(monkeypatch, pairs, met, strip):
    """However many are told at a time, all meetings are told once, by track and frame, with what is_inside tells of them; frames and tracks may be on one side alone."""
    monkeypatch.setattr(pr, "PAIRS", pairs)
    monkeypatch.setattr(pr, "MEETINGS", met)
    monkeypatch.setattr(pr, "STRIP", strip)
    rnd = random.Random(5)
    rows = [(r[1], r[3], *r[5:9]) for r in points(5) if r[0] == 0]
    rows += [(99, f, *[v * (1 + rnd.choice((0, 1e-13, 1e-10, 1e-8))) for v in r[2:]]) for f, r in enumerate(rows[:30])] + [(77, 1000, 0.0, 0.0, 1.0, 1.0), (78, 5, 3.0, 3.0, 3.0, 9.0)]
    rows = [(*r, r[0] != 4, r[0] % 5 != 0) for r in rows]
    table = pa.table(dict(zip(("track_id", "frame_index", *pr.BOX, "_inner", "_outer"), map(list, zip(*rows, strict=True)), strict=True)))
    a, b = pr.Points(table, "_inner", ["track_id", "frame_index"]), pr.Points(table, "_outer", ["frame_index", "track_id"])
    got, parts = [], 0
    for part in pr.meetings(a, b, within=True, same=True):
        inner, outer = part.ids(part.pair)
        got += zip(inner.tolist(), part.frames(np.arange(len(part.pair))).tolist(), outer.tolist(), part.inside.tolist(), strict=True)
        parts += 1
    box = lambda r: [np.array([v]) for v in r[2:6]]
    want = [(i[0], i[1], o[0], bool(pr.is_inside(box(i), box(o))[0])) for i in rows for o in rows if i[6] and o[7] and i[1] == o[1]]
    assert got == sorted(want) and any(w[3] for w in want) and (parts == 1) == (strip > 60)


def test_seams_pair_no_frames(spark):
    """Shared frames are worked out for the seams alone: points meet by track, not by frame alone."""
    plan = m.seams(spark.createDataFrame(points(2), COLUMNS))._jdf.queryExecution().optimizedPlan().toString()
    assert "(frame_index" in plan and all("track_id" in line for line in plan.splitlines() if "Join" in line and "frame_index" in line)


def test_contact_frames_sum_up_contacts(spark):
    """Frames tell what a list of all contacts tells, of whichever size parts are."""
    rows = [(*r[:2], "person" if r[1] % 2 else "cup", *r[3:]) for r in points(3)]
    df = spark.createDataFrame(rows, COLUMNS)
    want = {}
    for r in tr.contacts(df).collect():
        want.setdefault((r.video_id, r.frame_index), []).append((r.person_id, r.object_id, r.kind))
    made = tr.contact_frames(df)
    assert "Join" not in made._jdf.queryExecution().optimizedPlan().toString()
    got = {(r.video_id, r.frame_index): (r.hits, r.people, r.things, (r.first_person, r.first_thing, r.first_kind)) for r in made.collect()}
    assert got == {k: (len(v), sorted({x[0] for x in v}), sorted({x[1] for x in v}), min(v)) for k, v in want.items()} and got
