"""Queries over the sequential operators and the streaming twins; registered in the catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackloom.functions.lexicon import CLOSED_WORDS, OPEN_WORDS
from trackloom.operators import events as ev
from trackloom.operators import sequential as sq
from trackloom.plans.catalog import query, rounded
from trackloom.plans.catalog_events import EVENTS_SQL, MENTION, at, evidence, kept_events, score, scores
from trackloom.plans.views import DETECTIONS_SQL, HOUR_US, START_US, detections, table, track_points
from trackloom.streaming import windows
from trackloom.streaming.tracking import halves, replay


def _iou(a: str, b: str) -> str:
    both = f"greatest(0, least({a}.x2, {b}.x2) - greatest({a}.x1, {b}.x1)) * greatest(0, least({a}.y2, {b}.y2) - greatest({a}.y1, {b}.y1))"
    area = lambda x: f"({x}.x2 - {x}.x1) * ({x}.y2 - {x}.y1)"
    return f"{both} / ({area(a)} + {area(b)} - {both})"


_ROW = "{'c': -conf, 'd': det_id, 'x1': x1, 'y1': y1, 'x2': x2, 'y2': y2, 'conf': conf}"


@query(f"""with {DETECTIONS_SQL}, g as (select video_id, frame_index, class_name, list_sort(list({_ROW})) a from det group by all),
k as (select *, unnest(list_reduce(list_transform(a, lambda x: [x]), lambda acc, x: case when len(list_filter(acc, lambda k: {_iou('k', 'x[1]')} > 0.45e0)) = 0 then list_concat(acc, x) else acc end)) r from g)
select video_id, frame_index, r.d det_id, class_name, round(r.x1, 6) x1, round(r.y1, 6) y1, round(r.x2, 6) x2, round(r.y2, 6) y2, round(r.conf, 6) conf from k""")
def g1_suppressed_detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(sq.suppress(detections(spark, sf_dir)))


def seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The track points that were seen, as detections."""
    return track_points(spark, sf_dir).where("conf > 0").withColumn("det_id", F.col("track_id").cast("string")).drop("track_id")


@query()
def j1_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(sq.track(seen(spark, sf_dir)))


@query()
def i1_streamed_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tracks of j1 from a stream that stops halfway and goes on."""
    made = replay(halves(seen(spark, sf_dir), "frame_index"))
    return rounded(made.where(~F.col("late")).drop("late", "det_id"))


@query()
def j4_stitched_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sq.stitch(track_points(spark, sf_dir))


_LABELS = f"""{EVENTS_SQL},
lb as materialized (select video_id, lower(trim(object_label)) as label, arg_min(object_id, (start_sec, observation_id, clause)) track, row_number() over (partition by video_id order by min((start_sec, observation_id, clause))) nth from ev where object_label <> '' and object_id is not null group by 1, 2),
x0 as (select *, action in ('OPEN', 'CLOSE') and object_id is not null claims from ev),
x1 as materialized (select *, claims and coalesce(lag(action) over w = action and lag(object_id) over w is not distinct from object_id, false) again from x0 window w as (partition by video_id order by start_sec, observation_id, clause)),
sd as materialized (select *, case when {evidence('lower(visible_facts)')} is not null then lower(visible_facts) else lower(state_change) end own from x1 join (select observation_id, visible_facts, state_change from obs) using (observation_id) where not claims and stated is not null),
s1 as materialized (select *, {at('own', f"case when stated = 'OPEN' then '{OPEN_WORDS}' else '{CLOSED_WORDS}' end")} word from sd),
cn as (select distinct video_id, event_id, own, word, label from (select video_id, event_id, own, word, lower(trim(unnest(objects))) as label from s1 union all select s1.video_id, event_id, own, word, label from s1 join lb using (video_id))),
cm as materialized (select *, {MENTION} m from cn where label <> '' and contains(own, string_split(label, ' ')[-1])),
ct as (select c.*, coalesce((select track from lb where lb.video_id = c.video_id and lb.label = c.label), (select arg_max(track, ({score('c.label', 'lb.label')}, -nth)) from lb where lb.video_id = c.video_id and {score('c.label', 'lb.label')} > 0)) track from cm c where m > 0),
sj as (select video_id, event_id, arg_min(track, (abs(m - word), -length(label), track)) subject from ct where track is not null group by all),
it as (select video_id, object_id track, start_sec, observation_id, clause, event_id, action verb, null::varchar says, not again opens from x1 where claims
  union all select video_id, coalesce(subject, object_id), start_sec, observation_id, clause, event_id, null::varchar, stated, true from sd left join sj using (video_id, event_id)),
im as materialized (select *, row_number() over (partition by video_id, track order by start_sec, observation_id, clause) i from it where track is not null)"""
_NOT = "case verb when 'OPEN' then 'CLOSE' else 'OPEN' end"
_LEFT = "case {v} when 'OPEN' then 'OPEN' else 'CLOSED' end"


@query(f"""with recursive {_LABELS},
f as (select video_id, track, i, event_id, verb fixed, case when verb is null then says::varchar else {_LEFT.format(v='verb')} end state, verb last from im where i = 1
  union all select n.video_id, n.track, n.i, n.event_id, case when n.verb is null then null when not n.opens and f.last is not null then f.last when f.state = {_LEFT.format(v='n.verb')} then {_NOT.replace('verb', 'n.verb')} else n.verb end,
    case when n.verb is null then n.says when not n.opens and f.last is not null then f.state when f.state = {_LEFT.format(v='n.verb')} then {_LEFT.format(v='(' + _NOT.replace('verb', 'n.verb') + ')')} else {_LEFT.format(v='n.verb')} end,
    case when n.verb is null then f.last when not n.opens and f.last is not null then f.last when f.state = {_LEFT.format(v='n.verb')} then {_NOT.replace('verb', 'n.verb')} else n.verb end
  from f join im n on n.video_id = f.video_id and n.track = f.track and n.i = f.i + 1)
select ev.video_id, ev.event_id, action, coalesce(fixed, action) corrected, case when fixed <> action then 'STATE_UNSATISFIABLE' end source from ev left join (select * from f where fixed is not null) g using (video_id, event_id)""")
def j5_corrected_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sq.correct_states(kept_events(spark, sf_dir))


@query()
def j7_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = kept_events(spark, sf_dir)
    states = ev.transitions(e)
    tier = scores(spark, sf_dir, e, states, ev.edges(e, states)).select("video_id", "event_id", "tier")
    return sq.episodes(e.join(tier, ["video_id", "event_id"], "left"))


@query(f"select (floor((epoch_us(ts) - {START_US}) / {float(HOUR_US)} / 6))::bigint slot, event_type, count(*) n, round(sum(value), 4) total from events group by 1, 2")
def i5_tumbling_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("t", F.col("ts").cast("timestamp"))
    out = e.groupBy(F.window("t", "6 hours").alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
    slot = F.floor((F.unix_micros(F.col("w.start")) - START_US) / float(HOUR_US) / 6).cast("long")
    return out.select(slot.alias("slot"), "event_type", "n", "total")


@query(f"select (floor((epoch_us(ts) - {START_US}) / {float(HOUR_US)} / 6))::bigint slot, event_type, count(*) n, round(sum(value), 4) total from events group by 1, 2")
def i5_streamed_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The windows of i5 from a stream that stops halfway and goes on, each told once, when event time has passed it."""
    e = table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("at"), F.col("event_type").alias("kind"), "value")
    found, _ = windows.closed(halves(e.withColumn("_us", F.unix_micros("at")), "_us"), "6 hours", "1 hour")
    slot = F.floor((F.unix_micros("start") - START_US) / float(HOUR_US) / 6).cast("long")
    return found.select(slot.alias("slot"), F.col("kind").alias("event_type"), "n", F.round("total", 4).alias("total"))


@query("""with l as (select user_id, ts, case when ts < lag(ts) over w + interval 6 hours then 0 else 1 end o from events window w as (partition by user_id order by ts)),
s as (select user_id, ts, sum(o) over (partition by user_id order by ts) k from l) select user_id, epoch_us(min(ts)) start_us, count(*) n from s group by user_id, k""")
def i5_session_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("t", F.col("ts").cast("timestamp"))
    out = e.groupBy("user_id", F.session_window("t", "6 hours").alias("w")).agg(F.count("*").alias("n"))
    return out.select("user_id", F.unix_micros(F.col("w.start")).alias("start_us"), "n")
