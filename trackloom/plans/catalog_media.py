"""Queries over frames, boxes, tracks and files; registered in the catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackloom.functions import lexicon as lx
from trackloom.operators import events as ev
from trackloom.operators import media as m
from trackloom.operators import sequential as sq
from trackloom.operators import tracks as tr
from trackloom.plans.catalog import _SEGMENTS, NESTED_PAIRS_SQL, _area, _both, _iou, query, rounded, to_places
from trackloom.plans.catalog_events import EVENTS_SQL, STATES_SQL, events, kept_events
from trackloom.plans.catalog_sequential import _LABELS
from trackloom.plans.views import DETECTIONS_SQL, NESTED_SQL, OBSERVATIONS_SQL, POINTS_SQL, detections, nested, observations, segment_changes, segment_tracks, table, track_points
from trackloom.sources import tables as st

#: Videos of the sampling plan: one for each user, with what a container tells; both engines read this.
_VIDEOS = "user_id video_id, case when user_id % 10 = 0 then 0 else n * 10 end frames, n * cast(0.4 as double) duration, case user_id % 4 when 0 then cast(29.97 as double) when 1 then cast(25.0 as double) when 2 then cast(30.0 as double) else cast(23.976 as double) end fps, user_id % 7 + 1 nth, 40 + user_id % 60 cap, cast(1.0 as double) + user_id % 3 * 10 target"


def videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count("*").alias("n"))
    v = n.selectExpr(*[x.strip() for x in _VIDEOS.split(", ")])
    return v.withColumn("n_frames", m.frame_count(F.col("frames"), F.col("duration"), F.col("fps")))


_VIDEOS_SQL = f"vid as (select *, case when frames > 0 then frames else floor(duration * fps) end::bigint n_frames from (select {_VIDEOS} from (select user_id, count(*) n from events group by 1)))"


@query(f"with {_VIDEOS_SQL} select video_id, n_frames, unnest(range(0, n_frames, nth)[1:cap]) frame_index from vid")
def b1_b2_every_nth_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = videos(spark, sf_dir)
    return v.select("video_id", "n_frames", F.explode(m.every_nth(F.col("n_frames"), F.col("nth"), F.col("cap"))).alias("frame_index"))


@query(f"""with recursive {_VIDEOS_SQL}, p as (select video_id, 0.0e0 p, fps / least(target, fps) step, n_frames, cap, 0 k from vid where n_frames > 0 union all select video_id, p + step, step, n_frames, cap, k + 1 from p where p + step < n_frames and k < 2 * cap + 1),
i as (select distinct video_id, cap, least(greatest(round_even(p, 0)::bigint, 0), n_frames - 1) frame_index from p) select video_id, frame_index from (select *, row_number() over (partition by video_id order by frame_index) n from i) where n <= cap""")
def b1_frames_by_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = videos(spark, sf_dir)
    return v.select("video_id", F.explode(m.by_rate(F.col("n_frames"), F.col("fps"), F.col("target"), F.col("cap"))).alias("frame_index"))


@query("""with f as (select user_id % 8 video_id, event_id % 500 frame_index, count(*) n from events group by 1, 2), v as (select video_id, unnest(range(0, 400 + video_id)) frame_index from (select distinct video_id from f))
select video_id, frame_index, coalesce(n, 0)::bigint n from v left join f using (video_id, frame_index)""")
def i2_every_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = table(spark, sf_dir, "events").groupBy((F.col("user_id") % 8).alias("video_id"), (F.col("event_id") % 500).alias("frame_index")).agg(F.count("*").alias("n"))
    n = f.select("video_id").distinct().withColumn("n_frames", 400 + F.col("video_id"))
    return m.every_frame(f, n).select("video_id", "frame_index", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


@query(f"with {DETECTIONS_SQL} select video_id, class_name, count(*) n from det where frame_index % 10 <> 3 group by 1, 2")
def b12_detections_of_good_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = detections(spark, sf_dir)
    frames = d.select("video_id", "frame_index").distinct().withColumn("status", F.when(F.col("frame_index") % 10 == 3, "ERROR").otherwise("OK"))
    return m.of_good_frames(d, frames).groupBy("video_id", "class_name").agg(F.count("*").alias("n"))


@query(f"""with {DETECTIONS_SQL}, c as (select video_id, frame_index, det_id, class_name, least(greatest(x1 - 100, 0), 1199) x1, least(greatest(y1, 0), 799) y1, least(greatest(x2 - 100, 0), 1200) x2, least(greatest(y2, 0), 800) y2 from det
  where lower(class_name) not in ('red widget') and lower(class_name) in ('person', 'blue widget', 'red widget', 'red gear', 'small bolt'))
select video_id, frame_index, det_id, class_name, round(x1, 6) x1, round(y1, 6) y1, round(x2, 6) x2, round(y2, 6) y2 from c where x2 > x1 and y2 > y1""")
def b13_b15_clean_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = detections(spark, sf_dir).withColumns({"x1": F.col("x1") - 100, "x2": F.col("x2") - 100})
    kept = m.clean_boxes(d, 1200.0, 800.0, decoys=("Red Widget",), allowed=("Person", "blue widget", "red widget", "red gear", "small bolt"))
    return rounded(kept.select("video_id", "frame_index", "det_id", "class_name", "x1", "y1", "x2", "y2"))


@query("select vec_id, round((a - c / 2) * 1920.0e0, 6) x1, round((b - d / 2) * 1080.0e0, 6) y1, round((a + c / 2) * 1920.0e0, 6) x2, round((b + d / 2) * 1080.0e0, 6) y2 from (select vec_id, embedding[1]::double a, embedding[2]::double b, abs(embedding[3]::double) c, abs(embedding[4]::double) d from embeddings)")
def b14_boxes_from_centres(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = [F.col("embedding")[i].cast("double") for i in range(4)]
    made = table(spark, sf_dir, "embeddings").select("vec_id", m.from_centre(e[0], e[1], F.abs(e[2]), F.abs(e[3]), 1920.0, 1080.0).alias("b"))
    return rounded(made.select("vec_id", "b.*"))


@query(f"""with {POINTS_SQL}, r as (select * from pts where conf > 0), o as (select a.video_id, a.frame_index, a.track_id, any_value(a.conf) conf, coalesce(max(case when b.track_id is not null then {_both('a', 'b')} / {_area('a')} end), 0.0e0) part
  from r a left join r b on a.video_id = b.video_id and a.frame_index = b.frame_index and b.class_name = 'cardboard box' where a.class_name = 'push chopper' group by 1, 2, 3)
select video_id, floor((frame_index % 120) / 30.0e0 / 0.5e0)::bigint bucket, count(*) n, round(avg(conf), 6) mean_conf, round(avg(part), 6) mean_part from o group by 1, 2""")
def b18_d13_bucket_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(m.bucket_means(track_points(spark, sf_dir), "push chopper", "cardboard box", 30.0, 0.5, 120))


_CROPS = f"{POINTS_SQL}, crp as (select video_id, frame_index, track_id, conf, round_even(x1, 0)::bigint x1, round_even(y1, 0)::bigint y1, round_even(x2, 0)::bigint x2, round_even(y2, 0)::bigint y2 from pts where conf > 0 and class_name = 'push chopper' and (frame_index % 120) / 30.0e0 >= 0.5e0 and (frame_index % 120) / 30.0e0 < 2.5e0)"


@query(f"with {_CROPS} select video_id, frame_index, track_id, round(conf, 6) conf, x1, y1, x2, y2 from crp")
def b21_crops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(m.crops(track_points(spark, sf_dir), "push chopper", 30.0, 0.5, 2.5, 120))


@query(f"""with {_CROPS}, f as (select video_id, list_sort(list_distinct(list(frame_index))) fs, count(*) n from crp group by 1), k as (select video_id, unnest(list_transform(range(0, 25), lambda i: fs[floor(i * (len(fs) / 25.0e0))::bigint + 1])) frame_index from f where n > 25),
r as (select crp.*, row_number() over (partition by video_id, frame_index order by track_id) rn from crp)
select video_id, frame_index, track_id from r where (video_id in (select video_id from f where n <= 25)) or (rn = 1 and (video_id, frame_index) in (select video_id, frame_index from k))""")
def e18_thinned_crops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.thinned(m.crops(track_points(spark, sf_dir), "push chopper", 30.0, 0.5, 2.5, 120), 25).select("video_id", "frame_index", "track_id")


@query(f"with {POINTS_SQL} select video_id, 'traj_' || track_id trajectory_id, track_id, row_number() over (partition by video_id, track_id order by frame_index) nth, frame_index, round(ts_sec, 6) ts_sec, round((x1 + x2) / 2, 6) cx, round((y1 + y2) / 2, 6) cy, round(conf, 6) conf from pts")
def b22_trajectory_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(m.trajectory_points(track_points(spark, sf_dir)))


@query(f"""with {POINTS_SQL}, c as (select *, (x1 + x2) / 2 cx, (y1 + y2) / 2 cy from pts where class_name = 'person' and video_id % 2 = 1),
s as (select *, first_value(cx) over w fx, first_value(cy) over w fy, first_value(frame_index) over w ff from c window w as (partition by video_id, track_id order by frame_index rows between unbounded preceding and current row)),
d as (select *, sqrt((cx - fx) * (cx - fx) + (cy - fy) * (cy - fy)) / 1080.0e0 moved from s) select video_id, frame_index, track_id person_id, round(moved, 6) moved from d where ff < frame_index and moved > 0.05e0""")
def e3_solo_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = track_points(spark, sf_dir)
    return rounded(m.solo_hits(p, p.where("video_id % 2 = 0").select("video_id")).drop("ts_sec"))


_WINDOWS = f"""{_SEGMENTS}, tg as (select video_id, isl::bigint island, arg_min(kind, (s, e, person_id, object_id)) "trigger" from g2 group by 1, 2),
n as (select *, case when end_sec - start_sec > 0.15e0 then ceil((end_sec - start_sec) / 0.15e0) else 1 end::int n from seg),
w as (select video_id, island, part, start_sec + (end_sec - start_sec) / n * part a, start_sec + (end_sec - start_sec) / n * (part + 1) b from (select *, unnest(range(n))::int part from n)),
wh as (select w.*, frame_index, person_id, object_id, ts_sec between a and b inn from w join g2 on g2.video_id = w.video_id and g2.isl = w.island),
wi as (select *, bool_or(inn) over (partition by video_id, island, part) any_in from wh),
wn as materialized (select video_id, island, part, a, b, min(frame_index) start_frame, max(frame_index) end_frame, count(*) n_hits, list_sort(list_distinct(list_concat(list(person_id), list(object_id)))) ids from wi where inn or not any_in group by 1, 2, 3, 4, 5)"""


@query(f"""with {_WINDOWS} select video_id, island, part, round(a, 6) start_sec, round(b, 6) end_sec, start_frame, end_frame, n_hits, array_to_string(ids, ',') track_ids, "trigger" from wn join tg using (video_id, island)""")
def e6_contact_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = m.contact_windows(tr.contact_frames(track_points(spark, sf_dir)), 0.15)
    return rounded(w.withColumn("track_ids", F.array_join(F.transform("track_ids", lambda x: x.cast("string")), ",")))


@query(f"with {_WINDOWS}, k as (select video_id, track_id, count(*) n_points from pts group by 1, 2), x as (select video_id, island, part, unnest(ids) track_id from wn) select video_id, island, part, track_id, n_points from x join k using (video_id, track_id)")
def c5_window_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = track_points(spark, sf_dir)
    return m.points_in(m.contact_windows(tr.contact_frames(p), 0.15), p)


@query(f"""with {POINTS_SQL}, v as (select video_id, max(frame_index) - min(frame_index) + 1 d from pts group by 1)
select video_id, track_id, max(frame_index) - min(frame_index) + 1 duration, max(frame_index) - min(frame_index) + 1 > 100 is_long, max(frame_index) - min(frame_index) + 1 = any_value(d) whole_video, count(*) filter (x1 < 0 or y1 < 0) n_negative, count(*) filter (x2 <= x1 or y2 <= y1) n_flat from pts join v using (video_id) group by 1, 2""")
def d20_track_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.track_report(track_points(spark, sf_dir))


@query(f"with {POINTS_SQL} select class_name, count(distinct (video_id, track_id)) n_tracks, count(*) n_detections, round(count(distinct (video_id, track_id)) / count(*), 6) ratio from pts where conf > 0 group by rollup (class_name)")
def d4_fragmentation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(m.fragmentation(track_points(spark, sf_dir)))


@query(f"""with {STATES_SQL}, {POINTS_SQL}, k as (select video_id, 'points' t, count(*) n from pts group by 1 union all select video_id, 'observations', count(*) from obs group by 1 union all select video_id, 'events', count(*) from ev group by 1 union all select video_id, 'transitions', count(*) from tr group by 1)
select video_id, coalesce(sum(n) filter (t = 'points'), 0)::bigint points, coalesce(sum(n) filter (t = 'observations'), 0)::bigint observations, coalesce(sum(n) filter (t = 'events'), 0)::bigint as events, coalesce(sum(n) filter (t = 'transitions'), 0)::bigint transitions from k group by 1""")
def d7_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = kept_events(spark, sf_dir)
    return m.run_summary({"points": track_points(spark, sf_dir), "observations": observations(spark, sf_dir), "events": e, "transitions": ev.transitions(e)})


_STAGES = "user_id % 40 run, event_id % 9 stage, event_id % 11 = 0 stub, event_id % 13 <> 0 enabled, case when event_id % 7 = 0 then null else event_id % 3 end upstream"


@query(f"""with s as (select *, case when stub or not enabled then 'SKIPPED' when upstream is null then 'ERROR' when upstream = 0 then 'SKIPPED' else 'OK' end status from (select {_STAGES} from events where event_id % 5 <> 0 or user_id % 40 > 20)),
g as (select run, count(*) filter (status = 'ERROR') e, count(*) filter (status = 'SKIPPED') s, count(*) filter (status = 'OK') o, count(*) n from s where run % 3 = 0 or status <> 'ERROR' group by 1)
select run, case when e > 0 then 'FAIL' when s > 0 and o > 0 then 'PARTIAL' when s = n then 'SKIPPED' else 'PASS' end overall from g""")
def b23_d10_stage_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").where("event_id % 5 <> 0 or user_id % 40 > 20").selectExpr(*[x.strip() for x in _STAGES.split(", ")])
    return m.overall(m.gated(rows).where("run % 3 = 0 or status <> 'ERROR'"), "run")


@query(f"""with {OBSERVATIONS_SQL}, d as (select video_id, max(sec) + 3 duration from chg group by 1), sp as (select c.video_id, duration, greatest(0.0e0, sec - 0.3e0) a, least(duration, sec + 0.3e0) b from chg c join d using (video_id)),
g as (select *, case when a <= max(b) over (partition by video_id order by a, b rows between unbounded preceding and 1 preceding) then 0 else 1 end o from sp where b > a), h as (select *, sum(o) over (partition by video_id order by a, b rows between unbounded preceding and current row) i from g),
k as (select video_id, any_value(duration) duration, max(b) - min(a) n from h group by video_id, i) select video_id, round(sum(n) / any_value(duration), 6) fraction from k group by 1""")
def e15_covered_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = segment_changes(spark, sf_dir).select("video_id", "sec").distinct()
    return rounded(m.covered_fraction(c, c.groupBy("video_id").agg((F.max("sec") + 3).alias("duration")), 0.3))


@query(f"""with {OBSERVATIONS_SQL}, b as (select distinct video_id, seg_start + 0.25e0 as loc from obs where substr(segment_id, 5)::bigint % 3 = 0), c as (select distinct video_id, sec from chg where floor(sec)::bigint % 4 <> 3), d as (select video_id, max(sec) + 3 duration from c group by 1),
bn as (select b.*, (select min(abs(sec - loc)) from c where c.video_id = b.video_id) off from b), cn as (select c.*, (select min(abs(sec - loc)) from b where b.video_id = c.video_id) off from c),
sp as (select c.video_id, duration, greatest(0.0e0, sec - 1.0e0) a, least(duration, sec + 1.0e0) b from c join d using (video_id)),
g as (select *, case when a <= max(b) over (partition by video_id order by a, b rows between unbounded preceding and 1 preceding) then 0 else 1 end o from sp where b > a), h as (select *, sum(o) over (partition by video_id order by a, b rows between unbounded preceding and current row) i from g),
k as (select video_id, any_value(duration) duration, max(b) - min(a) n from h group by video_id, i), f as (select video_id, sum(n) / any_value(duration) fraction from k group by 1)
select x.video_id, n_bounds, n_hit, n_points, n_spurious, round(fraction, 6) fraction, fraction >= 1.0e0 vacuous from (select video_id, count(*) n_bounds, count(*) filter (off <= 1.0e0) n_hit from bn group by 1) x join (select video_id, count(*) n_points, count(*) filter (off > 1.0e0) n_spurious from cn group by 1) y using (video_id) join f using (video_id)""")
def m9_change_point_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = segment_changes(spark, sf_dir).where("floor(sec) % 4 <> 3").select("video_id", "sec").distinct()
    b = observations(spark, sf_dir).where(F.substring("segment_id", 5, 20).cast("long") % 3 == 0).select("video_id", (F.col("seg_start") + 0.25).alias("at")).distinct()
    return rounded(m.change_point_scores(c, b, c.groupBy("video_id").agg((F.max("sec") + 3).alias("duration")), 1.0))


@query(f"with {_VIDEOS_SQL} select video_id, i::bigint nth, round(case when cap > 1 then duration * i / (cap - 1) else 0 end, 6) sec from (select *, unnest(range(0, cap)) i from vid)")
def e17_control_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = videos(spark, sf_dir).select("video_id", F.posexplode(m.grid(F.col("duration"), F.col("cap"))).alias("nth", "sec"))
    return rounded(v.withColumn("nth", F.col("nth").cast("long")))


_BESIDE = f"""{POINTS_SQL}, r as (select * from pts where conf > 0), bs as materialized (select a.video_id, a.frame_index, a.track_id inner_id, b.track_id outer_id, {_iou('a', 'b')} iou, {_area('a')} / {_area('b')} ratio, abs({_both('a', 'b')} - {_area('a')}) < 1e-6 inside
  from r a join r b on a.video_id = b.video_id and a.frame_index = b.frame_index and a.class_name = 'push chopper' and b.class_name = 'cardboard box')"""


_NESTED_BESIDE = _BESIDE.replace(POINTS_SQL, NESTED_SQL).replace("from pts where conf > 0", "from nst where conf > 0")


@query(f"with {_NESTED_BESIDE} select video_id, frame_index, inner_id, outer_id, round(iou, 6) iou, round(ratio, 6) ratio, case when ratio > 0.9e0 and iou > 0.5e0 then 'SAME PIXELS' when inside then 'contained' else 'separate' end verdict from bs")
def e19_inside_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(m.inside_verdicts(nested(spark, sf_dir), "push chopper", "cardboard box"))


@query(f"""with {_NESTED_BESIDE}, l as (select *, lag(inside) over (partition by video_id, outer_id order by frame_index, inner_id) b from bs where ratio <= 0.9e0)
select video_id, outer_id, min(frame_index) frame_index, arg_min(inner_id, (frame_index, inner_id)) inner_id from l where inside and not b group by 1, 2""")
def e19_containment_onsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.onsets(nested(spark, sf_dir), "push chopper", "cardboard box")


@query(f"with {NESTED_PAIRS_SQL} select video_id, inner_id, outer_id, count(*) shared, sum(inside::bigint)::bigint n_inside from pr group by all")
def h4_enclosed_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.enclosed_share(nested(spark, sf_dir))


@query(f"""with {POINTS_SQL}, t as (select video_id, class_name, track_id, min(frame_index) a, max(frame_index) b, min(frame_index) filter (conf > 0) f, max(frame_index) filter (conf > 0) l from pts group by 1, 2, 3),
q as (select *, lag(track_id) over w pt, lag(b) over w pb, lag(l) over w pl from t window w as (partition by video_id, class_name order by a, track_id)),
j as (select q.*, x, y, u, v from q join pts x on x.video_id = q.video_id and x.track_id = pt and x.frame_index = pl join pts y on y.video_id = q.video_id and y.track_id = q.track_id and y.frame_index = q.f
  join pts u on u.video_id = q.video_id and u.track_id = pt and u.frame_index = pb join pts v on v.video_id = q.video_id and v.track_id = q.track_id and v.frame_index = q.a),
s as (select o.video_id, o.track_id s1, p.track_id s2, count(*) shared, avg({_iou('o', 'p')}) mean from pts o join pts p on o.video_id = p.video_id and o.frame_index = p.frame_index and o.class_name = p.class_name and o.track_id < p.track_id where o.conf > 0 and p.conf > 0 group by 1, 2, 3)
select j.video_id, class_name, pt before_id, track_id after_id, f - pl blind, a - pb span, round({_iou('x', 'y')}, 6) real_iou, round(sqrt(((x.x1 + x.x2) / 2 - (y.x1 + y.x2) / 2) ** 2 + ((x.y1 + x.y2) / 2 - (y.y1 + y.y2) / 2) ** 2) / 2202.9e0, 6) real_distance,
  round({_iou('u', 'v')}, 6) ghost_iou, coalesce(shared, 0)::bigint shared, round(coalesce(mean, 0.0e0), 6) shared_iou from j left join s on s.video_id = j.video_id and s1 = least(pt, track_id) and s2 = greatest(pt, track_id)""")
def m10_seams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(m.seams(track_points(spark, sf_dir)))


@query()
def m10_seam_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(m.seam_outcomes(track_points(spark, sf_dir)))


_SHORT = 24
_VECTORS = f"lg as (select vec_id pos, embedding v from embeddings), sh as (select vec_id - 40 pos, list_transform(embedding, lambda x: x + 0.125::float) v from embeddings where vec_id between 40 and {39 + _SHORT}), sz as (select count(*) n from lg)"
_OFFSETS = f"""{_VECTORS}, ofs as materialized (select l.pos - s.pos off, sum(list_sum(list_transform(list_zip(l.v, s.v), lambda z: abs(z[1] - z[2])::double))) / sum(len(s.v)) score from lg l, sh s, sz where l.pos - s.pos between 0 and n - {_SHORT} group by 1)"""


def sequences(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The embeddings as frames of a long video, and a stretch of them, a little brighter, as a short one."""
    e = table(spark, sf_dir, "embeddings")
    long = e.select(F.col("vec_id").alias("pos"), F.col("embedding").alias("vector"))
    short = e.where(F.col("vec_id").between(40, 39 + _SHORT)).select((F.col("vec_id") - 40).alias("pos"), F.transform("embedding", lambda x: (x + F.lit(0.125).cast("float")).cast("float")).alias("vector"))
    return short, long


@query(f'with {_OFFSETS} select off::bigint as "offset", round(score, 5) score from ofs')
def d23_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    short, long = sequences(spark, sf_dir)
    return m.offsets(short, long).withColumn("score", to_places("score", 5))


@query(f"""with recursive {_OFFSETS}, p as (select 1 k, [arg_min(off, (score, off))] picked, min(score) score from ofs union all
  select k + 1, list_append(any_value(picked), arg_min(off, (ofs.score, off))), min(ofs.score) from p, ofs where k < 5 and len(list_filter(picked, lambda q: abs(q - off) < {_SHORT // 2})) = 0 group by k)
select k::bigint "rank", picked[-1]::bigint "offset", round(score, 5) score, (select score from p where k = 2) < 2 * (select score from p where k = 1) ambiguous from p""")
def d23_best_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    short, long = sequences(spark, sf_dir)
    return m.best_offsets(m.offsets(short, long), _SHORT // 2).withColumn("score", to_places("score", 5))


@query(f"""with {EVENTS_SQL}, l as (select *, case when lag(action) over w = action and lag(object_id) over w is not distinct from object_id then 0 else 1 end c from ev window w as (partition by video_id order by start_sec, observation_id, clause)),
r as (select *, sum(c) over (partition by video_id order by start_sec, observation_id, clause) r from l), n as (select video_id, action, object_id, count(*) n from r group by video_id, action, object_id, r) select video_id, action, object_id, max(n) longest from n group by 1, 2, 3""")
def e14_longest_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.longest_runs(events(spark, sf_dir))


@query(f"with recursive {_LABELS} select video_id, event_id, subject from sj")
def f4_state_subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = kept_events(spark, sf_dir)
    e = whole.where("not (action in ('OPEN', 'CLOSE') and object_id is not null)")
    labelled = whole.withColumn("stated", F.when(F.expr("action in ('OPEN', 'CLOSE') and object_id is not null"), F.lit(None)).otherwise(F.col("stated")))
    return sq.state_subjects(labelled).join(e.select("video_id", "event_id"), ["video_id", "event_id"], "left_semi").where("subject is not null")


@query(f"""with {OBSERVATIONS_SQL}, t as (select *, case when surface then null else track_id end track, case when track_id % 3 = 0 then null else class_name end as label from stk), k as (select *, coalesce(track::varchar, label, '') key from t),
f as (select video_id, segment_id, key, min(track_id) first, arg_max({{'t': track, 'l': label, 'n': track_id}}, track_id) last from k group by 1, 2, 3) select video_id, segment_id, string_agg(coalesce(last.t::varchar, '-') || ':' || coalesce(last.l, '-') || ':' || last.n, ',' order by first) targets from f group by 1, 2""")
def g4_target_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = segment_tracks(spark, sf_dir).withColumns({"track": F.when(~F.col("surface"), F.col("track_id")), "label": F.when(F.col("track_id") % 3 != 0, F.col("class_name"))})
    held = t.groupBy("video_id", "segment_id").agg(F.array_sort(F.collect_list(F.struct("track_id", "track", "label"))).alias("all"))
    told = F.transform(ev.one_each(F.col("all")), lambda x: F.concat_ws(":", F.coalesce(x["track"].cast("string"), F.lit("-")), F.coalesce(x["label"], F.lit("-")), x["track_id"].cast("string")))
    return held.select("video_id", "segment_id", F.array_join(told, ",").alias("targets"))


_NEEDED = ("actor", "active_hand", "objects", "raw_action", "start_time_sec", "end_time_sec", "state_change", "visible_facts", "inference", "uncertainty", "confidence")
_JSON = "concat('{' , case when event_id % 2 = 0 then '\"actor\": null, ' else '' end, case when event_id % 3 = 0 then '\"objects\": [], ' else '' end, case when event_id % 5 = 0 then '\"inference\": \"x\", \"uncertainty\": null, ' else '' end, '\"raw_action\": \"a\", \"confidence\": 0.5', case when event_id % 7 = 0 then '' else '}' end)"


@query(f"select event_id, array_to_string(list_filter([{', '.join(f"'{k}'" for k in _NEEDED)}], lambda k: not list_contains(case when json_valid(j) then json_keys(j) else [] end, k)), ',') missing from (select event_id, {_JSON} j from events)")
def b7_g8_missing_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.array_join(lx.missing_keys(F.expr(_JSON), _NEEDED), ",").alias("missing"))


_SAID = "case event_id % 7 when 0 then null when 1 then 'UNKNOWN' when 2 then '0.5' when 3 then '-0.01' when 4 then '2.25' when 5 then '8.02' else '11' end"
_SAID_END = "case event_id % 5 when 0 then null when 1 then '8.03' when 2 then '1.5' when 3 then '7' else '3e0' end"
_SNAP = "case when {t} < a and a - {t} <= 1 / 30.0e0 then a when {t} > b and {t} - b <= 1 / 30.0e0 then b else {t} end"


@query(f"""with r as (select event_id, {_SAID} s, {_SAID_END} e, (event_id // 4) * 8.0e0 a, (event_id // 4) * 8.0e0 + 8 b from events), n as (select *, a + try_cast(s as double) p0, a + try_cast(e as double) q0 from r), p as (select *, {_SNAP.format(t='p0')} p, {_SNAP.format(t='q0')} q from n),
f as (select *, (s is not null and p0 is null) or (e is not null and q0 is null) lost, coalesce(p < a or p > b, false) or coalesce(q < a or q > b, false) or coalesce(p > q, false) outside from p)
select event_id, round(case when not lost and not outside then p end, 6) start_sec, round(case when not lost and not outside then q end, 6) end_sec, case when lost then 'not a number' when outside then 'outside' when coalesce(p <> p0, false) or coalesce(q <> q0, false) then 'snapped' end note from f""")
def h19_absolute_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = F.expr("event_id div 4") * 8.0
    t = table(spark, sf_dir, "events").select("event_id", lx.absolute_timing(F.expr(_SAID), F.expr(_SAID_END), a, a + 8, F.lit(30.0)).alias("t"))
    return rounded(t.select("event_id", "t.*"))


@query("select event_id, coalesce(s > e, false) or coalesce(s < a or s > b, false) or coalesce(e < a or e > b, false) bad from (select event_id, case when event_id % 6 <> 0 then value end s, case when event_id % 7 <> 0 then value + event_id % 9 - 2 end e, 5.0e0 a, 60.0e0 b from events)")
def b8_bad_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, e = F.when(F.col("event_id") % 6 != 0, F.col("value")), F.when(F.col("event_id") % 7 != 0, F.col("value") + F.col("event_id") % 9 - 2)
    return table(spark, sf_dir, "events").select("event_id", lx.bad_times(s, e, F.lit(5.0), F.lit(60.0)).alias("bad"))


@query(f"""with {OBSERVATIONS_SQL}, c as (select observation_id, seg_end - seg_start d, list_transform(list_concat(['person', ' Push  Chopper'], objects), lambda p: trim(regexp_replace(lower(p), '\\s+', ' ', 'g'))) ps from obs)
select observation_id, array_to_string(list_filter(ps, lambda p, i: p <> '' and list_position(ps, p) = i), ' . ') || ' .' prompt, replace('a clip of {{d}} s', '{{d}}', printf('%.2f', d)) request from c""")
def h30_h31_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    phrases = F.concat(F.array(F.lit("person"), F.lit(" Push  Chopper")), F.col("objects"))
    return observations(spark, sf_dir).select("observation_id", lx.detector_prompt(phrases).alias("prompt"), lx.with_duration(F.lit("a clip of {d} s"), "{d}", F.col("seg_end") - F.col("seg_start")).alias("request"))


@query("""select event_id, case when n < 1024 then printf('%.1f B', n) when n < 1048576 then printf('%.1f KB', n / 1024) when n < 1073741824 then printf('%.1f MB', n / 1048576) else printf('%.1f GB', n / 1073741824) end size, chr((c & 255)::int) || chr(((c >> 8) & 255)::int) || chr(((c >> 16) & 255)::int) || chr(((c >> 24) & 255)::int) codec
from (select event_id, (event_id * event_id * 37 % 99991 * 331 ** (event_id % 3))::double + 0.26e0 n, 875967075 + event_id % 9 c from events)""")
def h35_a3_sizes_and_codecs(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.expr("cast(event_id * event_id * 37 % 99991 * power(331, event_id % 3) as double) + 0.26D")
    return table(spark, sf_dir, "events").select("event_id", lx.byte_size(n).alias("size"), m.fourcc(F.lit(875967075) + F.col("event_id") % 9).alias("codec"))


@query(f"with {POINTS_SQL} select video_id, track_id, class_name, frame_index, round(x1, 6) x1, round(y1, 6) y1, round(x2, 6) x2, round(y2, 6) y2, round(conf, 6) conf from pts where conf > 0")
def a9_a11_exported_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tracks written as nested text, some of it wrapped, and read back."""
    text = st.tracks_text(track_points(spark, sf_dir))
    wrapped = F.when(F.col("track_id") % 2 == 0, F.concat(F.lit('{"tracks": '), "text", F.lit("}"))).otherwise(F.col("text"))
    return rounded(st.observed_boxes(text.withColumn("text", wrapped)))


_FILES = "case when event_id % 10 = 0 then null when event_id % 10 = 1 then '[{\"raw_action\"' when event_id % 10 = 2 then '{\"other\": 1}' when event_id % 10 = 3 then concat('{\"observations\": [{\"raw_action\": \"x', event_id, '\", \"status\": \"SUCCESS\"}, 7]}') else concat('[{\"raw_action\": \"a', event_id, '\"}, {\"status\": \"FAILED\"}]') end"


@query(f"""select event_id, raw_action, status from (select event_id, case when event_id % 10 = 3 then ['x' || event_id] when event_id % 10 > 3 then ['a' || event_id, null] else [] end r, case when event_id % 10 = 3 then ['SUCCESS'] when event_id % 10 > 3 then [null, 'FAILED'] else [] end s from events), lateral (select unnest(r) raw_action, unnest(s) status)""")
def a15_flattened_captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "events").select("event_id", F.expr(_FILES).alias("text"))
    return st.flattened(files, "text", "raw_action string, status string")


@query("""with a as (select event_id id, event_type template, 0 s from events where event_id % 3 <> 0 union all select event_id, 'v ' || event_type, 1 from events where event_id % 2 = 0) select id, arg_max(template, (s, template)) template, max(s)::int split from a group by 1""")
def a14_last_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    train = e.where("event_id % 3 <> 0").select(F.col("event_id").alias("id"), F.col("event_type").alias("template"), F.lit(0).alias("split"))
    check = e.where("event_id % 2 = 0").select(F.col("event_id").alias("id"), F.concat(F.lit("v "), "event_type").alias("template"), F.lit(1).alias("split"))
    return st.last_split(train, check, key="id")


@query("""with a as (select user_id, row_number() over (partition by user_id, event_id // 60 order by event_id) attempt, event_id // 60 part, case when event_id % 4 = 0 then [1, 2] when event_id % 4 = 1 then [3] else [] end r, event_id from events),
b as (select user_id, part, arg_min(event_id, attempt) filter (len(r) > 0) e, arg_min(r, attempt) filter (len(r) > 0) r, count(*) n from a group by 1, 2)
select user_id, part, 'SUCCESS' status, case when len(r) = 1 then '{"n": ' else '{"n":' end || unnest(r) || case when len(r) = 1 then ', "e": ' else ',"e":' end || e || '}' "row", null error from b where e is not null union all select user_id, part, 'FAILED', null, 'no rows in ' || n || ' answers' from b where e is null""")
def j10_first_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("user_id", F.expr("event_id div 60").alias("part"), F.col("event_id").alias("attempt"))
    body = F.concat(F.lit('{"n": 1, "e": '), "attempt", F.lit("}"))
    more = F.concat(F.lit('{"n": 2, "e": '), "attempt", F.lit("}"))
    text = F.when(F.col("attempt") % 4 == 0, F.concat(F.lit("here: ["), body, F.lit(", "), more, F.lit("]"))).when(F.col("attempt") % 4 == 1, F.replace(body, F.lit('"n": 1'), F.lit('"n": 3'))).otherwise("sorry")
    return st.first_answers(e.withColumn("rows", lx.json_rows(lx.json_body(text))), ["user_id", "part"])


@query(f"with {OBSERVATIONS_SQL} select video_id, count(*) filter (class_name = 'person') people, count(*) filter (lower(class_name) = 'person') people_any_case, count(*) filter (class_name not in ('person', 'dining table')) things, count(*) filter (lower(class_name) not in ('person', 'dining table')) things_any_case from stk group by 1")
def b10_lower_case_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = lambda c: F.sum(F.when(c, 1).otherwise(0))
    t, plain = segment_tracks(spark, sf_dir), F.col("class_name")
    return t.groupBy("video_id").agg(n(plain == "person").alias("people"), n(F.lower(plain) == "person").alias("people_any_case"), n(~plain.isin(*tr.OBJECT_NOT)).alias("things"), n(~F.lower(plain).isin(*tr.OBJECT_NOT)).alias("things_any_case"))


def _assigned_sql(points: str, bounds: str, tag: str) -> str:
    """Common table expressions that end in g{tag}(video_id, i, j): the point of each bound, by the whole table of costs, from the last bound back."""
    return f"""pt{tag} as materialized (select video_id, sec, row_number() over (partition by video_id order by sec) - 1 a, count(*) over (partition by video_id) n from {points}),
bd{tag} as materialized (select video_id, loc, row_number() over (partition by video_id order by loc) - 1 i, count(*) over (partition by video_id) m from {bounds}),
vm{tag} as (select distinct bd{tag}.video_id, m, n from bd{tag} join (select distinct video_id, n from pt{tag}) using (video_id) where m <= n),
f{tag} as materialized (select video_id, m i, unnest(range(0, n + 1)) a, 0.0e0 as price, -1::bigint pick from vm{tag}
  union all select video_id, i, a, x.t, x.a from (select f.video_id, b.i, p.a, min({{'t': abs(p.sec - b.loc) + f.price, 'a': p.a}}) over (partition by f.video_id order by p.a desc rows between unbounded preceding and current row) x
    from f{tag} f join bd{tag} b on b.video_id = f.video_id and b.i = f.i - 1 join pt{tag} p on p.video_id = f.video_id and p.a = f.a - 1)),
g{tag} as (select video_id, i, pick j from f{tag} where i = 0 and a = 0 union all select n.video_id, n.i, n.pick from g{tag} c join f{tag} n on n.video_id = c.video_id and n.i = c.i + 1 and n.a = c.j + 1)"""


_BOUNDS = """lb as (select distinct video_id, seg_start + 0.25e0 as loc from obs union select distinct video_id, seg_start + 1.5e0 from obs where substr(segment_id, 5)::bigint % 3 = 0), ch as (select distinct video_id, sec from chg)"""


def labelled_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(video_id, at): a bound at each segment's start, and one more in every third."""
    o = observations(spark, sf_dir)
    third = o.where(F.substring("segment_id", 5, 20).cast("long") % 3 == 0)
    return o.select("video_id", (F.col("seg_start") + 0.25).alias("at")).union(third.select("video_id", (F.col("seg_start") + 1.5).alias("at"))).distinct()


@query(f"""with recursive {OBSERVATIONS_SQL}, {_BOUNDS}, {_assigned_sql("ch", "lb", "")}
select b.video_id, round(b.loc, 6) as "at", b.i::int nth, b.m::int n, round(p.sec, 6) point from bd b left join g on g.video_id = b.video_id and g.i = b.i left join pt p on p.video_id = b.video_id and p.a = g.j""")
def j9_assigned_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A change point of its own for each labelled bound, all changes of the video."""
    return rounded(sq.assigned(segment_changes(spark, sf_dir).select("video_id", "sec").distinct(), labelled_bounds(spark, sf_dir)))


_THIN = "substr(segment_id, 5)::bigint % 4 = 0"


@query(f"""with recursive {OBSERVATIONS_SQL}, lb as (select distinct video_id, seg_start + 0.25e0 as loc from obs where {_THIN}), ch as (select distinct video_id, sec from chg where {_THIN} and floor(sec)::bigint % 4 <> 3),
dr as (select video_id, max(sec) + 3 duration from ch group by 1), gr as (select video_id, unnest(list_transform(range(0, n), lambda i: case when n > 1 then duration * i / (n - 1) else 0.0e0 end)) sec from (select video_id, count(*) n from ch group by 1) join dr using (video_id)),
{_assigned_sql("ch", "lb", "")}, {_assigned_sql("gr", "lb", "2")},
o as (select b.video_id, count(*) n_bounds, sum((abs(sec - loc) <= 1)::int) n_ordered, count(*) filter (b.i > 0 and b.i < m - 1) n_inner, sum((abs(sec - loc) <= 1)::int) filter (b.i > 0 and b.i < m - 1) n_inner_hit from bd b left join g on g.video_id = b.video_id and g.i = b.i left join pt p on p.video_id = b.video_id and p.a = g.j group by 1),
e as (select b.video_id, sum((abs(sec - loc) <= 1)::int) n_grid_hit from bd2 b left join g2 g on g.video_id = b.video_id and g.i = b.i left join pt2 p on p.video_id = b.video_id and p.a = g.j group by 1)
select video_id, n_bounds, n_ordered::bigint n_ordered, n_inner, n_inner_hit::bigint n_inner_hit, n_grid_hit::bigint n_grid_hit, n_grid_hit >= n_ordered grid_as_good from o left join e using (video_id)""")
def m9_ordered_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = segment_changes(spark, sf_dir).where("cast(substring(segment_id, 5) as long) % 4 = 0 and floor(sec) % 4 <> 3").select("video_id", "sec").distinct()
    b = observations(spark, sf_dir).where("cast(substring(segment_id, 5) as long) % 4 = 0").select("video_id", (F.col("seg_start") + 0.25).alias("at")).distinct()
    return m.ordered_scores(c, b, c.groupBy("video_id").agg((F.max("sec") + 3).alias("duration")), 1.0)
