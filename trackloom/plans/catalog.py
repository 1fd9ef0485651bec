"""Registered queries over the engine's operators, and the DuckDB SQL with the same rows."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackloom.operators import tracks
from trackloom.plans.views import DETECTIONS_SQL, NESTED_SQL, POINTS_SQL, detections, nested, track_points

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query by its function's name, with its SQL."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def to_places(c: str, places: int) -> Column:
    """A double to some places as the SQL does it: scaled first, then to the nearest whole number, halves away from zero.

    round() of Spark takes the shortest decimal of the double instead, so it differs where that one ends in 5 and the scaled one falls short of a half or reaches it.
    """
    scaled = F.abs(c) * 10.0**places
    whole = F.rint(scaled)
    return F.signum(c) * (whole + F.when(scaled - whole == 0.5, 1.0).otherwise(0.0)) / 10.0**places


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to six places."""
    return df.select(*[to_places(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


_IOU = "(greatest(0, least({a}.x2, {b}.x2) - greatest({a}.x1, {b}.x1)) * greatest(0, least({a}.y2, {b}.y2) - greatest({a}.y1, {b}.y1)))"


def _both(a: str, b: str) -> str:
    return _IOU.format(a=a, b=b)


def _area(a: str) -> str:
    return f"(({a}.x2 - {a}.x1) * ({a}.y2 - {a}.y1))"


def _iou(a: str, b: str) -> str:
    return f"({_both(a, b)} / ({_area(a)} + {_area(b)} - {_both(a, b)}))"


def _gap(a: str, b: str) -> str:
    across = f"greatest(0.0e0, {a}.x1 - {b}.x2, {b}.x1 - {a}.x2)"
    down = f"greatest(0.0e0, {a}.y1 - {b}.y2, {b}.y1 - {a}.y2)"
    return f"sqrt({across} * {across} + {down} * {down})"


def _inside(a: str, b: str) -> str:
    return f"({_iou(a, b)} < 0.45e0 and abs({_both(a, b)} - {_area(a)}) <= 1e-9 * {_area(a)})"


@query(f"with {POINTS_SQL} select video_id, track_id, frame_index, round(x2 - x1, 6) width, round(y2 - y1, 6) height, round((x2 - x1) * (y2 - y1), 6) area, round((x1 + x2) / 2, 6) cx, round((y1 + y2) / 2, 6) cy from pts")
def b4_box_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(tracks.box_columns(track_points(spark, sf_dir)).select("video_id", "track_id", "frame_index", "width", "height", "area", "cx", "cy"))


@query(f"""with {DETECTIONS_SQL} select rule, n::bigint n from (unpivot (select count(*) filter (x2 <= x1 or y2 <= y1) box_order, count(*) filter (not conf between 0 and 1) conf_range,
  count(*) filter (frame_index < 0) frame_negative, count(*) filter (x1 < 0) outside_left, count(*) filter (class_name is null) class_missing from det) on columns(*) into name rule value n)""")
def b6_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracks.violations(detections(spark, sf_dir))


_MOVED = f"""{POINTS_SQL},
c as (select *, (x1 + x2) / 2 cx, (y1 + y2) / 2 cy from pts),
mv as (select *, case when first_value(frame_index) over w5 < frame_index then
  sqrt((cx - first_value(cx) over w5) * (cx - first_value(cx) over w5) + (cy - first_value(cy) over w5) * (cy - first_value(cy) over w5)) / 1080.0e0 end moved
  from c window w5 as (partition by video_id, track_id order by frame_index range between 5 preceding and current row))"""
_HITS = f"""{_MOVED},
hit as (select p.video_id, p.frame_index, p.ts_sec, p.track_id person_id, o.track_id object_id, {_gap("p", "o")} / 1920.0e0 distance,
  case when {_iou("p", "o")} > 0.05e0 then 'overlap' else 'near' end kind
  from mv p join mv o on p.video_id = o.video_id and p.frame_index = o.frame_index and p.class_name = 'person' and o.class_name not in ('person', 'dining table')
  where ({_iou("p", "o")} > 0.05e0 or {_gap("p", "o")} / 1920.0e0 < 0.2e0) and (coalesce(p.moved, 0) > 0.05e0 or coalesce(o.moved, 0) > 0.05e0))"""
_SEGMENTS = f"""{_HITS},
iv as (select *, greatest(0.0e0, ts_sec - 0.05e0) s, least(24.0e0, ts_sec + 0.05e0) e from hit),
g1 as (select *, max(e) over (partition by video_id order by s, e, person_id, object_id rows between unbounded preceding and 1 preceding) pm from iv),
g2 as (select *, sum(case when pm is null or s > pm + 0.02e0 then 1 else 0 end) over (partition by video_id order by s, e, person_id, object_id rows between unbounded preceding and current row) isl from g1),
seg as (select video_id, isl::bigint island, min(s) start_sec, max(e) end_sec, min(frame_index) start_frame, max(frame_index) end_frame, count(*) hits, count(distinct person_id) persons,
  (select string_agg(o, ',' order by o) from (select distinct object_id::varchar o from g2 x where x.video_id = g2.video_id and x.isl = g2.isl)) objects,
  arg_min(person_id, (s, e, person_id, object_id)) first_person from g2 group by video_id, isl)"""


@query(f"with {_MOVED} select video_id, track_id, frame_index, round(moved, 6) moved from mv")
def e2_lookback_displacement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(tracks.moving(track_points(spark, sf_dir)).select("video_id", "track_id", "frame_index", "moved"))


@query(f"with {_HITS} select video_id, frame_index, person_id, object_id, kind, round(distance, 6) distance from hit")
def c1_person_object_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(tracks.contacts(track_points(spark, sf_dir)).select("video_id", "frame_index", "person_id", "object_id", "kind", "distance"))


@query(f"with {_SEGMENTS} select video_id, island, round(start_sec, 6) start_sec, round(end_sec, 6) end_sec, start_frame, end_frame, hits, persons, objects, first_person from seg")
def e5_candidate_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(tracks.segments(tracks.contact_frames(track_points(spark, sf_dir))))


@query(f"""with {_SEGMENTS}, n as (select *, case when end_sec - start_sec > 0.15e0 then ceil((end_sec - start_sec) / 0.15e0) else 1 end::int n from seg)
select video_id, island, part, round(start_sec + (end_sec - start_sec) / n * part, 6) part_start, round(start_sec + (end_sec - start_sec) / n * (part + 1), 6) part_end from (select *, unnest(range(n))::int part from n)""")
def b16_even_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = tracks.split_even(tracks.segments(tracks.contact_frames(track_points(spark, sf_dir))), 0.15)
    return rounded(cut.select("video_id", "island", "part", "part_start", "part_end"))


_STEPS = f"""{POINTS_SQL}, c as (select *, (x1 + x2) / 2 cx, (y1 + y2) / 2 cy from pts),
st as (select *, frame_index - lag(frame_index) over w gap, sqrt((cx - lag(cx) over w) * (cx - lag(cx) over w) + (cy - lag(cy) over w) * (cy - lag(cy) over w)) distance
  from c window w as (partition by video_id, track_id order by frame_index))"""


@query(f"with {_STEPS} select video_id, track_id, frame_index, gap, round(distance, 6) distance, round(distance / gap, 6) rate from st")
def e1_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(tracks.steps(track_points(spark, sf_dir)).select("video_id", "track_id", "frame_index", "gap", "distance", "rate"))


@query(f"""with {_STEPS}, t as (select video_id, track_id, count(*) n_points, sum(distance) length, max(ts_sec) - min(ts_sec) duration from st group by all)
select video_id, track_id, n_points, round(length, 6) length, round(duration, 6) duration, round(case when n_points > 1 and duration > 0 then length / duration end, 6) speed from t""")
def d6_trajectories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(tracks.trajectories(track_points(spark, sf_dir)))


@query(f"""with {_STEPS} select video_id, track_id, count(*) filter (conf > 0) n_seen, count(*) filter (conf <= 0) n_predicted, max(frame_index) - min(frame_index) + 1 span,
  round(100.0e0 * count(distinct frame_index) / (max(frame_index) - min(frame_index) + 1), 6) covered_pct,
  list_sort(list(gap) filter (gap is not null))[len(list(gap) filter (gap is not null)) // 2 + 1] median_gap from st group by video_id, track_id""")
def d3_d4_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(tracks.coverage(track_points(spark, sf_dir)))


@query(f"with {_STEPS} select class_name, case when gap <= 5 then '1-5' when gap <= 10 then '6-10' when gap <= 20 then '11-20' else '>20' end bucket, count(*) n from st where gap is not null group by all")
def d5_gap_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracks.gap_histogram(track_points(spark, sf_dir))


@query(f"""with {POINTS_SQL}, o as (select * from pts where conf > 0) select a.video_id, a.track_id track_id_a, b.track_id track_id_b, count(*) shared, round(avg({_iou("a", "b")}), 6) mean_iou
from o a join o b on a.video_id = b.video_id and a.frame_index = b.frame_index and a.class_name = b.class_name and a.track_id < b.track_id group by all""")
def c3_shared_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(tracks.shared_frames(track_points(spark, sf_dir)))


_PAIRS = f"""{POINTS_SQL}, o as (select * from pts where conf > 0),
pr as (select a.video_id, a.track_id inner_id, b.track_id outer_id, a.frame_index, {_inside("a", "b")} inside, {_both("a", "b")} / {_area("a")} part
  from o a join o b on a.video_id = b.video_id and a.frame_index = b.frame_index and a.track_id <> b.track_id)"""


NESTED_PAIRS_SQL = _PAIRS.replace(POINTS_SQL, NESTED_SQL).replace("from pts where conf > 0", "from nst where conf > 0")


@query(f"with {NESTED_PAIRS_SQL} select video_id, inner_id, outer_id, count(*) shared from pr group by all having bool_and(inside)")
def c4_always_inside(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracks.always_inside(nested(spark, sf_dir))


@query(f"with {_PAIRS} select video_id, frame_index, inner_id, outer_id, round(part, 6) part from (select *, row_number() over (partition by video_id, frame_index, inner_id order by part desc, outer_id) n from pr) where n = 1")
def c15_best_container(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(tracks.best_container(track_points(spark, sf_dir)))


def _flips(rows: str, keys: str, state: str, hits: int = 2) -> str:
    """Common table expressions that end in fl(keys, frame_index, state)."""
    return f"""r1 as (select *, case when lag({state}) over (partition by {keys} order by frame_index) is not distinct from {state} then 0 else 1 end ch from {rows}),
r2 as (select *, sum(ch) over (partition by {keys} order by frame_index) rn from r1),
r3 as (select {keys}, rn, any_value({state}) {state}, min(frame_index) frame_index from r2 group by {keys}, rn having count(*) >= {hits}),
fl as (select * from (select *, lag({state}) over (partition by {keys} order by frame_index) b from r3) where b is not null and b <> {state})"""


_MOTION = f"""{POINTS_SQL}, o as (select * from pts where conf > 0),
l as (select *, lag(x1) over w px1, lag(y1) over w py1, lag(x2) over w px2, lag(y2) over w py2, lag(frame_index) over w pf from o window w as (partition by video_id, track_id order by frame_index)),
m as (select video_id, track_id, frame_index, greatest(abs((x1 + x2) / 2 - (px1 + px2) / 2) / greatest(1e-6, (x2 - x1 + px2 - px1) / 2),
  abs((y1 + y2) / 2 - (py1 + py2) / 2) / greatest(1e-6, (y2 - y1 + py2 - py1) / 2)) / (frame_index - pf) > {tracks.still_ratio(0.45, 1.0)!r} moves from l where pf is not null),
{_flips("m", "video_id, track_id", "moves")}"""


@query(f"with {_MOTION} select video_id, track_id, frame_index, case when moves then 'MOVE_START' else 'MOVE_STOP' end kind from fl")
def e9_motion_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracks.motion_changes(track_points(spark, sf_dir))


@query(f"with {POINTS_SQL}, e as (select video_id, track_id, min(frame_index) a, max(frame_index) d from pts where conf > 0 group by all) select video_id, track_id, a frame_index, 'APPEAR' kind from e union all select video_id, track_id, d, 'DISAPPEAR' from e")
def e10_life_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracks.life_changes(track_points(spark, sf_dir))


@query(f"with {NESTED_PAIRS_SQL}, {_flips('pr', 'video_id, inner_id, outer_id', 'inside')} select video_id, inner_id track_id, outer_id, frame_index, case when inside then 'ENCLOSE_START' else 'ENCLOSE_END' end kind from fl")
def e11_enclosure_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracks.enclosure_changes(nested(spark, sf_dir))


_ALL_MOTION = _MOTION.replace(POINTS_SQL, NESTED_SQL).replace("from pts where conf > 0", "from nst where conf > 0 and lower(class_name) <> 'dining table'")
_ALL_FLIPS = _flips("prn", "video_id, inner_id, outer_id", "inside")
for _old in ("r1", "r2", "r3", "fl"):
    _ALL_FLIPS = re.sub(rf"\b{_old}\b", f"n{_old}", _ALL_FLIPS)


@query(f"""with {_ALL_MOTION}, prn as (select a.video_id, a.track_id inner_id, b.track_id outer_id, a.frame_index, {_inside("a", "b")} inside from o a join o b on a.video_id = b.video_id and a.frame_index = b.frame_index and a.track_id <> b.track_id),
{_ALL_FLIPS}, e as (select video_id, track_id, min(frame_index) a, max(frame_index) d from o group by all)
select video_id, track_id, frame_index, case when moves then 'MOVE_START' else 'MOVE_STOP' end kind from fl union all select video_id, track_id, a, 'APPEAR' from e union all select video_id, track_id, d, 'DISAPPEAR' from e
union all select video_id, inner_id, frame_index, case when inside then 'ENCLOSE_START' else 'ENCLOSE_END' end from nfl""")
def e12_change_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracks.change_points(nested(spark, sf_dir), exclude=("Dining Table",)).select("video_id", "track_id", "frame_index", "kind")


@query(f"with {POINTS_SQL} select class_name, count(*) n from pts group by all")
def d1_class_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracks.histogram(track_points(spark, sf_dir), "class_name")


@query(f"""with {DETECTIONS_SQL}, a as (select class_name, count(*) n from det where video_id < 8 group by 1), b as (select class_name, count(*) n from det where video_id >= 8 group by 1)
select class_name, coalesce(a.n, 0)::bigint n_a, coalesce(b.n, 0)::bigint n_b, (coalesce(b.n, 0) - coalesce(a.n, 0))::bigint change from a full join b using (class_name)""")
def g7_compare_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    det = detections(spark, sf_dir)
    return tracks.compare_counts(det.where("video_id < 8"), det.where("video_id >= 8"), "class_name")


@query(f"with {DETECTIONS_SQL} select video_id, count(*) detections, count(distinct frame_index) frames, round(count(*)::double / count(distinct frame_index), 6) per_frame, round(avg(conf), 6) conf_avg, round(min(conf), 6) conf_min, round(max(conf), 6) conf_max from det group by 1")
def d2_detection_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    det = detections(spark, sf_dir).groupBy("video_id").agg(F.count("*").alias("detections"), F.countDistinct("frame_index").alias("frames"), F.avg("conf").alias("conf_avg"), F.min("conf").alias("conf_min"), F.max("conf").alias("conf_max"))
    return rounded(det.withColumn("per_frame", F.col("detections") / F.col("frames")))


@query(f"with {POINTS_SQL}, f as (select video_id, frame_index, count(distinct track_id) n from pts group by all) select video_id, max(n) max_tracks from f group by 1")
def d21_busiest_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracks.busiest(track_points(spark, sf_dir))


@query(f"with {POINTS_SQL} select video_id, class_name, frame_index, track_id, round(conf, 6) conf from (select *, row_number() over (partition by video_id, class_name, frame_index order by conf desc, track_id) n from pts) where n = 1")
def g3_merge_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(tracks.merge_points(track_points(spark, sf_dir)).select("video_id", "class_name", "frame_index", "track_id", "conf"))


@query(f"""with {POINTS_SQL}, o as (select * from pts where conf > 0),
p as (select a.video_id, a.track_id, b.track_id outer_id, ((a.x1 + a.x2) / 2 - b.x1) / greatest(1e-6, b.x2 - b.x1) rx, ((a.y1 + a.y2) / 2 - b.y1) / greatest(1e-6, b.y2 - b.y1) ry
  from o a join o b on a.video_id = b.video_id and a.frame_index = b.frame_index and a.class_name <> 'dining table' and b.class_name = 'dining table'),
s as (select video_id, track_id, outer_id, count(*) n, avg(rx) mean_rx, avg(ry) mean_ry, stddev_pop(rx) dev_rx, stddev_pop(ry) dev_ry from p group by all)
select video_id, track_id, outer_id, n, round(mean_rx, 4) mean_rx, round(mean_ry, 4) mean_ry, case when greatest(dev_rx, dev_ry) <= 0.05 then 'PRINT' when greatest(dev_rx, dev_ry) <= 0.12 then 'LIKELY' else 'NOT' end verdict from s""")
def d12_pose_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = tracks.pose_spread(track_points(spark, sf_dir))
    return out.select("video_id", "track_id", "outer_id", "n", to_places("mean_rx", 4).alias("mean_rx"), to_places("mean_ry", 4).alias("mean_ry"), "verdict")


@query(f"""with {POINTS_SQL}, c as (select distinct video_id, frame_index from pts where conf > 0 and class_name = 'person'),
b as (select distinct video_id, frame_index boundary from pts where conf = 0),
p as (select b.video_id, boundary, c.frame_index, abs(boundary - c.frame_index) off, row_number() over (partition by b.video_id, boundary order by abs(boundary - c.frame_index), c.frame_index) n from b join c using (video_id))
select video_id, boundary, frame_index, off from p where n = 1""")
def c12_nearest_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = track_points(spark, sf_dir)
    bounds = p.where("conf = 0").select("video_id", F.col("frame_index").alias("boundary")).distinct()
    return tracks.nearest_change(bounds, p.where("conf > 0 and class_name = 'person'").select("video_id", "frame_index")).where("frame_index is not null")
