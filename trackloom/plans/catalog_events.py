"""Queries over captions, events, states and the graph; registered in the catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackloom.functions import lexicon as lx
from trackloom.operators import events as ev
from trackloom.operators import sequential as sq
from trackloom.plans.catalog import query, rounded
from trackloom.plans.views import OBSERVATIONS_SQL, observations, segment_changes, segment_tracks, table
from trackloom.sources.tables import stored


def case(pairs: list[tuple[str, str]], other: str) -> str:
    return "case " + " ".join(f"when {c} then {v}" for c, v in pairs) + f" else {other} end"


def at(text: str, pattern: str) -> str:
    return f"length(string_split_regex({text}, {pattern})[1]) + 1"


def said(pattern: str) -> str:
    return "'" + pattern + "'"


_P = [(said(lx.stem_pattern(stems)), name) for stems, name in lx.STEMS]
_VERB = case([(f"regexp_matches(bl, {p})", f"'{n}'") for p, n in _P], "'UNKNOWN'")
_AT = case([(f"regexp_matches(bl, {p})", at("bl", p)) for p, _ in _P], "0")
_BETTER = case([(f"verb0 = '{b}' and regexp_matches(clause, '\\b({'|'.join(w)})')", f"'{n}'") for b, w, n in lx.PROMOTIONS], "verb0")
_DIRECTION = case([(f"verb = '{a}'", f"'{d}'") for a, d in lx.DIRECTIONS.items()], "'NONE'")
_BLANK = r"""list_reduce(list_prepend(txt, list_transform(list_sort(list_transform(list_distinct(list_transform(objects, lambda o: lower(trim(o)))), lambda o: {'a': -length(o), 'b': o})), lambda x: x.b)),
  lambda t, p: regexp_replace(t, '\b' || regexp_escape(p) || '\b', repeat(' ', length(p)), 'g'))"""
_NAME, _HEAD = r"'\b' || regexp_escape(lower(trim(label))) || '\b'", r"'\b' || regexp_escape(string_split(lower(trim(label)), ' ')[-1]) || '\b'"
MENTION = f"case when regexp_matches(own, {_NAME}) then {at('own', _NAME)} when regexp_matches(own, {_HEAD}) then {at('own', _HEAD)} else 0 end"


def score(label: str, name: str) -> str:
    a, b = f"lower(trim({label}))", f"lower(trim({name}))"
    return f"case when coalesce({a}, '') = '' or coalesce({b}, '') = '' then 0 when {a} = {b} then 3 when contains({a}, {b}) then 2 when contains({b}, {a}) then 1 else 0 end"


def evidence(text: str) -> str:
    return f"case when regexp_matches({text}, '{lx.OPEN_WORDS}') and not regexp_matches({text}, '{lx.CLOSED_WORDS}') then 'OPEN' when regexp_matches({text}, '{lx.CLOSED_WORDS}') and not regexp_matches({text}, '{lx.OPEN_WORDS}') then 'CLOSED' end"


#: Ends in act(observation_id, verb, pos, k, n): the actions of each caption of o1.
ACTIONS_SQL = f"""{OBSERVATIONS_SQL}, o1 as materialized (select *, lower(coalesce(raw_action, '')) low from obs where status = 'SUCCESS'),
c0 as (select observation_id, objects, string_split_regex(low, '{lx.BREAK_PATTERN}') ps, regexp_extract_all(low, '{lx.BREAK_PATTERN}') bs from o1),
c1 as (select observation_id, objects, i, ps[i] piece, 1 + coalesce(list_sum(list_transform(ps[1:i - 1], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(bs[1:i - 1], lambda x: length(x))), 0) pos
  from (select *, unnest(range(1, len(ps) + 1)) i from c0)),
c2 as (select observation_id, objects, i, trim(piece) txt, pos + length(piece) - length(ltrim(piece)) pos from c1 where trim(piece) <> '' union all select observation_id, objects, 0, low, 1 from o1),
c3 as (select *, coalesce({_BLANK}, txt) bl from c2),
c4 as materialized (select *, {_VERB} verb0, {_AT} at0 from c3),
c5 as (select *, string_split_regex(substr(bl, at0::bigint), '{lx.BREAK_PATTERN}')[1] clause from c4),
c6 as materialized (select *, {_BETTER} verb from c5),
c7 as (select *, lag(verb) over (partition by observation_id order by i) pv from c6 where i > 0 and verb <> 'UNKNOWN' and contains(txt, ' ')),
c8 as materialized (select observation_id, verb, pos + at0 - 1 pos, row_number() over (partition by observation_id order by i) - 1 k, count(*) over (partition by observation_id) n from c7 where pv is distinct from verb),
act as materialized (select * from c8 where n > 1 union all select observation_id, verb, at0, 0, 1 from c6 where i = 0 and observation_id not in (select observation_id from c8 where n > 1))"""

EVENTS_SQL = f"""{ACTIONS_SQL},
av as materialized (select o1.*, verb, pos, k, n, case when n > 1 then string_split_regex(substr(low, pos::bigint), '{lx.BREAK_PATTERN}')[1] else low end own, case when n > 1 then 1 else pos end vat from o1 join act using (observation_id)),
b1 as (select video_id, segment_id, observation_id, k, n, own, vat, unnest(objects) as label, unnest(range(1, len(objects) + 1)) nth from av),
b2 as (select *, {MENTION} m from b1),
b3 as materialized (select *, row_number() over (partition by observation_id, k order by m = 0, m > 0 and regexp_matches(rtrim(substr(own, 1, (m - 1)::bigint)), '{lx.LOCATIVE_PATTERN}'), m > 0 and vat > 0 and m < vat,
  case when m = 0 then 0 when vat > 0 then abs(m - vat) else m end, nth) rk, bool_or(m > 0) over (partition by observation_id, k) named from b2),
b4 as (select observation_id, k, track_id, label, row_number() over (partition by observation_id, k order by rk, {score('label', 'class_name')} desc, surface, n_points desc, track_id) rn
  from b3 join stk using (video_id, segment_id) where lower(class_name) not in ('person', 'dining table') and {score('label', 'class_name')} > 0 and (n = 1 or named)),
seg as (select video_id, segment_id, arg_max(track_id, (n_points, -track_id)) filter (lower(class_name) = 'person') actor_id, count(*) filter (class_name = 'person') n_people from stk group by all),
idn as (select observation_id, count(track_id) hits, any_value(track_id) hit from o1 left join stk on o1.video_id = stk.video_id and o1.segment_id = stk.segment_id and contains(lower(class_name), lower(objects[1])) group by 1),
win as (select video_id, segment_id, list_sort(list(sec)) secs from chg group by all),
e1 as (select av.*, bnd.track_id object_id, coalesce(bnd.label, fst.label) object_label, seg.actor_id, seg.n_people, hits, hit, list_filter(secs, lambda x: x > seg_start and x < seg_end) ins
  from av left join (select * from b4 where rn = 1) bnd using (observation_id, k) left join (select observation_id, k, label from b3 where rk = 1 and (n = 1 or named)) fst using (observation_id, k)
  left join seg using (video_id, segment_id) left join idn using (observation_id) left join win using (video_id, segment_id)),
e2 as (select *, case when n > 1 and len(ins) >= n - 1 then list_concat(list_concat([seg_start], list_transform(range(1, n::bigint), lambda j: ins[cast(floor(j * len(ins) / n) as bigint) + 1])), [seg_end]) end cuts from e1),
ev as materialized (select video_id, segment_id, observation_id, k clause, 'evt_' || observation_id || case when n > 1 then '_' || k else '' end event_id, verb as action, {_DIRECTION} direction, object_label, actor, actor_id, object_id, coalesce(n_people, 0) n_people,
  case when n > 1 then coalesce(cuts[k + 1], seg_start) else coalesce(start_sec, seg_start) end start_sec, case when n > 1 then coalesce(cuts[k + 2], seg_end) else coalesce(end_sec, seg_end) end end_sec,
  case when n = 1 and start_sec > seg_start + 0.05e0 and end_sec < seg_end - 0.05e0 then 'EXACT' else 'SEGMENT' end timing,
  case when n > 1 and cuts is not null then 'CHANGE_POINT' when n = 1 and start_sec > seg_start + 0.05e0 and end_sec < seg_end - 0.05e0 then 'VLM' else 'SEGMENT' end timing_source, confidence, objects, raw_action,
  coalesce({evidence('lower(visible_facts)')}, {evidence('lower(state_change)')}) stated, lower(coalesce(visible_facts, '') || ' ' || coalesce(state_change, '')) said,
  case when object_id is not null then object_id when hits = 1 and len(objects) > 0 then hit end state_track, case when object_id is not null then coalesce(object_label, objects[1]) else objects[1] end state_label,
  case when object_id is not null or (hits = 1 and len(objects) > 0) then 'RESOLVED' when hits > 1 and len(objects) > 0 then 'AMBIGUOUS' else 'UNRESOLVED' end state_status from e2)"""

_DENIED = " or ".join(f"(action = '{a}' and regexp_matches(said, '{p}'))" for a, p in lx.DENIALS.items())


def _of(verbs: tuple[str, ...]) -> str:
    return f"action in ({', '.join(said(v) for v in verbs)})"


_AFTER = case([(f"{_of(v)}" + (f" and regexp_matches(said, '{w}')" if w else ""), f"'{s}'") for v, s, w, _, _ in lx.STATE_RULES], "'UNKNOWN'")
_BEFORE = case([(f"{_of(v)} and regexp_matches(said, '{w}')", f"'{s}'") for v, _, _, s, w in lx.STATE_RULES], "'UNKNOWN'")
STATES_SQL = f"""{EVENTS_SQL}, t1 as (select *, {_DENIED} denied, {_AFTER} left0, {_BEFORE} found0 from ev),
t2 as (select *, case when denied then 'UNKNOWN' else left0 end as after from t1),
t3 as (select *, coalesce(lag(after) over (partition by video_id, segment_id, state_track, state_label order by start_sec, observation_id, clause), 'UNKNOWN') b0 from t2),
tr as materialized (select video_id, 'tr_' || event_id transition_id, event_id, segment_id, state_track, state_label, state_status, case when denied then 'UNKNOWN' when b0 <> 'UNKNOWN' then b0 else found0 end as before, after, start_sec, end_sec, timing from t3)"""


def _node(track: str, label: str) -> str:
    return f"coalesce('node_track_' || {track}, 'node_unresolved_' || observation_id || '_' || coalesce(nullif({label}, ''), 'unknown'))"


GRAPH_SQL = f"""{STATES_SQL},
g1 as (select e.*, coalesce(object_id, case when object_id is null then s.state_track end) to_track, case when object_id is not null then object_label else s.state_label end to_label, case when object_id is not null then 'RESOLVED' else s.state_status end to_status,
  case when actor_id is not null then 'RESOLVED' when n_people > 1 then 'AMBIGUOUS' else 'UNRESOLVED' end from_status, transition_id, s.state_track st_track, s.state_label st_label from ev e join tr s using (video_id, event_id)),
g2 as (select *, {_node('actor_id', 'actor')} source_id, {_node('to_track', 'to_label')} target_id from g1),
ed as materialized (select video_id, 'edge_' || event_id || '_' || source_id || '_' || target_id edge_id, event_id, observation_id, clause, source_id, target_id, action, from_status actor_resolution, to_status object_resolution, actor_id source_track, to_track target_track, actor source_label, to_label target_label,
  case when (to_track is not null and st_track = to_track) or (to_track is null and to_label <> '' and st_label = to_label) then transition_id else '' end state_ids, timing, start_sec, end_sec from g2),
sd as (select video_id, observation_id, clause, 0 side, source_id node_id, 'PERSON' as role, source_track track, source_label as label from ed union all select video_id, observation_id, clause, 1, target_id, 'OBJECT', target_track, target_label from ed),
nd as materialized (select video_id, node_id, role, track, label, degree from (select *, row_number() over (partition by video_id, node_id order by observation_id, clause, side) rn, count(*) over (partition by video_id, node_id) degree from sd) where rn = 1)"""
_STATEFUL = ", ".join(f"'{a}'" for a in lx.STATEFUL)
_MET = "case {c} when 'RESOLVED' then 1.0e0 when 'AMBIGUOUS' then 0.5e0 else 0.0e0 end"
SCORES_SQL = f"""{GRAPH_SQL}, tj as (select distinct video_id, track_id from stk where track_id % 9 <> 0),
q0 as (select e.video_id, e.event_id, e.action, e.confidence, e.timing, d.edge_id, d.actor_resolution ar, d.object_resolution orr, t.transition_id, d.source_track s, d.target_track g,
  case when before <> 'UNKNOWN' and after <> 'UNKNOWN' then 1.0e0 when before = 'UNKNOWN' and after = 'UNKNOWN' then 0.0e0 else 0.5e0 end state_evidence,
  case when e.action = 'UNKNOWN' then 0.0e0 else 1.0e0 end action_certainty, {_MET.format(c='d.actor_resolution')} actor_resolution, {_MET.format(c='d.object_resolution')} object_resolution, case when e.timing = 'EXACT' then 1.0e0 else 0.5e0 end timing_precision,
  (d.source_track is not null)::int + (d.target_track is not null)::int there, (x.track_id is not null)::int + (y.track_id is not null)::int backed, concat_ws(',', x.track_id, y.track_id) trajectory_tracks
  from ev e join ed d using (video_id, event_id) join tr t using (video_id, event_id) left join tj x on x.video_id = e.video_id and x.track_id = d.source_track left join tj y on y.video_id = e.video_id and y.track_id = d.target_track),
q1 as (select *, case when there = 0 then 0.0e0 else backed / there end trajectory_support from q0),
q2 as (select *, 0.0e0 + action_certainty * 0.1e0 + actor_resolution * 0.2e0 + object_resolution * 0.2e0 + state_evidence * 0.2e0 + timing_precision * 0.1e0 + trajectory_support * 0.2e0 score,
  concat_ws(', ', {', '.join(f"case when {k} = 0 then '{k}' end" for k in ev.WEIGHTS)}) zero from q1),
sc as materialized (select *, case when score >= 0.7e0 and zero = '' then 'AUTO_ACCEPT' when score >= 0.4e0 then 'HUMAN_REVIEW' else 'REJECT' end tier,
  concat_ws('; ', case when action = 'UNKNOWN' then 'action unknown' end, case when actor_resolution < 1 then 'actor ' || lower(ar) end, case when object_resolution < 1 then 'object ' || lower(orr) end, case when state_evidence < 1 then 'no full state evidence' end,
    case when timing <> 'EXACT' then 'timing not exact' end, case when there = 0 then 'no participants' when backed < there then 'participants without trajectory' end, case when score >= 0.7e0 and zero <> '' then 'capped: ' || zero end) reasons from q2)"""


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.extract(observations(spark, sf_dir), segment_tracks(spark, sf_dir), segment_changes(spark, sf_dir))


def kept_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events written once, for queries that read them several times."""
    return stored(events(spark, sf_dir), "events")


def trajectory_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment_tracks(spark, sf_dir).where("track_id % 9 <> 0").select("video_id", "track_id").distinct()


def scores(spark: SparkSession, sf_dir: str, e: DataFrame, states: DataFrame, links: DataFrame) -> DataFrame:
    return ev.quality(e, links, states, trajectory_tracks(spark, sf_dir))


@query(f"with {EVENTS_SQL} select video_id, event_id, action, direction, object_label, actor_id, object_id, round(start_sec, 6) start_sec, round(end_sec, 6) end_sec, timing, timing_source, round(confidence, 6) confidence from ev")
def h11_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(events(spark, sf_dir).select("video_id", "event_id", "action", "direction", "object_label", "actor_id", "object_id", "start_sec", "end_sec", "timing", "timing_source", "confidence"))


@query(f"with {ACTIONS_SQL} select observation_id, k clause, n n_clauses, verb, pos::bigint as verb_at from act")
def h13_h14_action_clauses(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = observations(spark, sf_dir).where("status = 'SUCCESS'").withColumn("acts", lx.action_clauses(F.col("raw_action"), F.col("objects")))
    return o.select("observation_id", F.size("acts").cast("long").alias("n_clauses"), F.posexplode_outer("acts").alias("k", "a")).select("observation_id", F.col("k").cast("long").alias("clause"), "n_clauses", "a.verb", F.col("a.at").cast("long").alias("verb_at"))


@query(f"with {ACTIONS_SQL} select observation_id, bl as blanked from c3 where i = 0")
def h9_blanked_captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observations(spark, sf_dir).where("status = 'SUCCESS'").select("observation_id", lx.blanked(F.lower("raw_action"), F.col("objects")).alias("blanked"))


@query(f"with {EVENTS_SQL} select observation_id, k clause, string_agg(label, ' > ' order by rk) ordered, bool_or(named) named from b3 group by all")
def f2_h16_object_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = observations(spark, sf_dir).where("status = 'SUCCESS' and size(objects) > 0").withColumn("low", F.lower(F.coalesce("raw_action", F.lit(""))))
    found = o.select("observation_id", F.posexplode_outer(lx.read_actions(F.col("low"), F.col("objects"))).alias("k", "a"))
    return found.select("observation_id", F.col("k").cast("long").alias("clause"), F.array_join("a.ordered", " > ").alias("ordered"), "a.named")


@query(f"with {EVENTS_SQL} select segment_id, actor_id, n_people from seg")
def f1_segment_actors(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = segment_tracks(spark, sf_dir).groupBy("video_id", "segment_id").agg(F.collect_list(F.struct("track_id", "class_name", "n_points")).alias("tracks"))
    return t.select("segment_id", ev.actor_of(F.col("tracks")).alias("actor_id"), F.size(F.filter("tracks", lambda x: x["class_name"] == "person")).cast("long").alias("n_people"))


@query(f"with {STATES_SQL} select video_id, transition_id, segment_id, state_track, state_label, state_status, before, after from tr")
def j6_state_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.transitions(events(spark, sf_dir)).select("video_id", "transition_id", "segment_id", "state_track", "state_label", "state_status", "before", "after")


@query(f"with {GRAPH_SQL} select video_id, edge_id, event_id, source_id, target_id, action, actor_resolution, object_resolution, state_ids from ed")
def k3_graph_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = kept_events(spark, sf_dir)
    return ev.edges(e, ev.transitions(e)).select("video_id", "edge_id", "event_id", "source_id", "target_id", "action", "actor_resolution", "object_resolution", F.array_join("state_ids", ",").alias("state_ids"))


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = kept_events(spark, sf_dir)
    return ev.edges(e, ev.transitions(e))


@query(f"with {GRAPH_SQL} select * from nd")
def g5_graph_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.nodes(links(spark, sf_dir))


@query(f"with {GRAPH_SQL} select video_id, role, count(*) nodes, sum(degree)::bigint degree, max(degree) max_degree from nd group by 1, 2")
def k5_role_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.nodes(links(spark, sf_dir)).groupBy("video_id", "role").agg(F.count("*").alias("nodes"), F.sum("degree").alias("degree"), F.max("degree").alias("max_degree"))


_PARTS = ", ".join(f"round({k}, 6) {k}" for k in ev.WEIGHTS)


@query(f"with {SCORES_SQL} select video_id, event_id, action, round(confidence, 6) confidence, {_PARTS}, round(score, 6) score, tier, reasons, edge_id, transition_id transition_ids, trajectory_tracks from sc")
def d8_quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = kept_events(spark, sf_dir)
    states = ev.transitions(e)
    return rounded(scores(spark, sf_dir, e, states, ev.edges(e, states)))


@query(f"with {SCORES_SQL} select video_id, count(*) filter (tier = 'AUTO_ACCEPT') n_high, count(*) filter (tier = 'HUMAN_REVIEW') n_medium, 0::bigint n_low, count(*) filter (tier = 'REJECT') n_rejected from sc group by 1")
def d11_quality_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = kept_events(spark, sf_dir)
    states = ev.transitions(e)
    return ev.tiers(scores(spark, sf_dir, e, states, ev.edges(e, states)))


TEMPORAL_SQL = f"""{EVENTS_SQL}, p1 as (select *, max(end_sec) over (partition by video_id order by start_sec, end_sec, event_id rows between unbounded preceding and 1 preceding) pm from ev),
p2 as (select *, sum(case when pm is null or start_sec > pm + 2.0e0 then 1 else 0 end) over (partition by video_id order by start_sec, end_sec, event_id rows between unbounded preceding and current row) n from p1)"""


@query(f"with {TEMPORAL_SQL} select video_id, n::bigint episode, round(min(start_sec), 6) start_sec, round(max(end_sec), 6) end_sec, count(*) n_events, 'ie_' || left(sha256(string_agg(event_id, '-' order by start_sec, end_sec, event_id)), 8) episode_id from p2 group by video_id, n")
def j7_temporal_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ev.temporal_episodes(events(spark, sf_dir)))


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Events and what is made of them, each written once in the shared folder, for queries that need most of them.

    So that the rules of integrity have something to find, some rows are broken on the way: ids without an event,
    times out of order, roles turned round. Episodes are those of time alone.
    """
    e = kept_events(spark, sf_dir)
    states = stored(ev.transitions(e), "states")
    made = stored(ev.edges(e, states), "edges")
    members = ev.s.islands(e, ["video_id"], "start_sec", "end_sec", 2.0, ["event_id"], ev.s.STRETCH_SEC).select("video_id", "event_id", F.col("island").alias("episode"))
    whole = stored(ev.gathered(members, e, states, made), "episodes")
    return {"events": e, "states": states, "links": made, "points": ev.nodes(made), "scores": scores(spark, sf_dir, e, states, made), "whole": whole}


_GONE = "observation_id % 97 = 0"
_WHOLE = f"""p1 as (select *, max(end_sec) over (partition by video_id order by start_sec, end_sec, event_id rows between unbounded preceding and 1 preceding) pm from ev),
p2 as (select *, sum(case when pm is null or start_sec > pm + 2.0e0 then 1 else 0 end) over (partition by video_id order by start_sec, end_sec, event_id rows between unbounded preceding and current row) n from p1),
wh as materialized (select video_id, n, 'ie_' || left(sha256(string_agg(event_id, '-' order by start_sec, end_sec, event_id)), 8) episode_id, min(start_sec) + 2.5e0 start_sec, max(end_sec) end_sec from p2 group by 1, 2)"""
_TIMES = "(start_sec > end_sec or start_sec < 0 or end_sec < 0)"
#: The tables with the breaks that broken() makes, then (rule, item) of each rule.
_BROKEN = f"""{SCORES_SQL}, {_WHOLE}, xe as materialized (select * replace (case when observation_id % 89 = 0 then end_sec + 1 else start_sec end as start_sec) from ev where not {_GONE}),
xt as materialized (select t.* replace (case when observation_id % 83 = 0 then -1.0e0 else t.start_sec end as start_sec) from tr t join ev using (video_id, event_id) where observation_id % 79 <> 0),
xd as materialized (select * replace (case when observation_id % 73 = 0 then end_sec + 1 else start_sec end as start_sec) from ed where observation_id % 71 <> 0),
xn as materialized (select * replace (case when degree % 5 = 4 then case role when 'PERSON' then 'OBJECT' else 'PERSON' end else role end as role) from nd where degree % 7 <> 6),
rl as (select video_id, 'event_bounds' as rule, event_id item_id from xe where {_TIMES}
union all select video_id, 'transition_event_missing', transition_id from xt where (video_id, event_id) not in (select video_id, event_id from xe)
union all select video_id, 'transition_bounds', transition_id from xt where {_TIMES}
union all select video_id, 'transition_segment_timing', transition_id from xt where timing = 'SEGMENT'
union all select video_id, 'transition_unknown_state', transition_id from xt where before = 'UNKNOWN' or after = 'UNKNOWN'
union all select video_id, 'edge_event_missing', edge_id from xd where (video_id, event_id) not in (select video_id, event_id from xe)
union all select video_id, 'edge_source_missing', edge_id from xd where (video_id, source_id) not in (select video_id, node_id from xn)
union all select video_id, 'edge_target_missing', edge_id from xd where (video_id, target_id) not in (select video_id, node_id from xn)
union all select video_id, 'edge_source_role', edge_id from xd where (video_id, source_id) in (select video_id, node_id from xn where role <> 'PERSON')
union all select video_id, 'edge_target_role', edge_id from xd where (video_id, target_id) in (select video_id, node_id from xn where role <> 'OBJECT')
union all select video_id, 'edge_actor_unresolved', edge_id from xd where actor_resolution <> 'RESOLVED'
union all select video_id, 'edge_object_unresolved', edge_id from xd where object_resolution <> 'RESOLVED'
union all select video_id, 'edge_bounds', edge_id from xd where {_TIMES}
union all select video_id, 'edge_segment_timing', edge_id from xd where timing = 'SEGMENT'
union all select video_id, 'score_event_missing', event_id from sc where (video_id, event_id) not in (select video_id, event_id from xe)
union all select video_id, 'episode_bounds', episode_id from wh where {_TIMES}
union all select p.video_id, 'episode_event_missing', episode_id from p2 p join wh using (video_id, n) where (p.video_id, event_id) not in (select video_id, event_id from xe)
union all select p.video_id, 'episode_event_outside', episode_id from p2 p join wh using (video_id, n) join xe x on x.video_id = p.video_id and x.event_id = p.event_id where x.start_sec < wh.start_sec or x.end_sec > wh.end_sec
union all select p.video_id, 'episode_edge_missing', episode_id from p2 p join wh using (video_id, n) join ed d on d.video_id = p.video_id and d.event_id = p.event_id where (d.video_id, d.edge_id) not in (select video_id, edge_id from xd)
union all select p.video_id, 'episode_transition_missing', episode_id from p2 p join wh using (video_id, n) join tr t on t.video_id = p.video_id and t.event_id = p.event_id where (t.video_id, t.transition_id) not in (select video_id, transition_id from xt))"""
_SEVERITY = case([(f"rule = '{r}'", f"'{s}'") for r, s in ev.RULES.items()], "''")


def broken(t: dict[str, DataFrame]) -> DataFrame:
    """The issues of tables with some rows taken out or bent, so that each rule has something to find."""
    bent = lambda df, n, value: df.withColumn("start_sec", F.when(F.col("observation_id") % n == 0, value).otherwise(F.col("start_sec")))
    e = bent(t["events"].where(f"not {_GONE}"), 89, F.col("end_sec") + 1)
    numbered = t["states"].join(t["events"].select("video_id", "event_id", "observation_id"), ["video_id", "event_id"])
    states = bent(numbered.where("observation_id % 79 <> 0"), 83, F.lit(-1.0))
    made = bent(t["links"].where("observation_id % 71 <> 0"), 73, F.col("end_sec") + 1)
    role = F.when(F.col("degree") % 5 == 4, F.when(F.col("role") == "PERSON", "OBJECT").otherwise("PERSON")).otherwise(F.col("role"))
    points = t["points"].where("degree % 7 <> 6").withColumn("role", role)
    return ev.issues(e, states, made, points, t["scores"], t["whole"].withColumn("start_sec", F.col("start_sec") + 2.5))


@query(f"with {_BROKEN} select video_id, rule, {_SEVERITY} severity, count(*) n, count(distinct item_id) n_items from rl group by all")
def l_integrity_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return broken(tables(spark, sf_dir)).groupBy("video_id", "rule", "severity").agg(F.count("*").alias("n"), F.countDistinct("item_id").alias("n_items"))


@query(f"with {_BROKEN}, h as (select video_id, count(*) filter (s = 'ERROR') n_errors, count(*) filter (s = 'WARNING') n_warnings, count(*) filter (s = 'INFO') n_infos from (select video_id, {_SEVERITY} s from rl) group by 1) select *, case when n_errors > 0 then 'CRITICAL' when n_warnings > 0 then 'WARNING' else 'HEALTHY' end dataset_health from h")
def d10_dataset_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.health(broken(tables(spark, sf_dir)))


@query(f"""with {GRAPH_SQL}, {_WHOLE}, r as (select p.video_id, episode_id, p.start_sec, p.end_sec, p.event_id, case when p.action = 'UNKNOWN' or coalesce(nd.label, '') = '' then p.action else p.action || ' ' || nd.label end said
  from p2 p join wh using (video_id, n) join ed d using (video_id, event_id) left join nd on nd.video_id = p.video_id and nd.node_id = target_id)
select video_id, episode_id, count(*) n_events, string_agg(said, '; ' order by start_sec, end_sec, event_id) said from r group by all""")
def c16_h33_episode_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    return ev.preview(t["whole"], t["events"], t["links"], t["points"])


@query(f"with {EVENTS_SQL}, t as (select event_id, action, row_number() over (partition by action order by event_id) turn from ev) select *, row_number() over (partition by turn order by action) place from t")
def e16_interleave(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ev.interleave(events(spark, sf_dir).select("event_id", "action"), "action", "event_id")
    return found.select("event_id", "action", F.col("turn").cast("long").alias("turn"), F.col("place").cast("long").alias("place"))


@query("""select event_id, json_extract_string(b, '$.k')::bigint k from (select event_id, trim(case when regexp_extract(t, '(?is)```(?:json)?\\s*(.*?)```', 1) <> '' then regexp_extract(t, '(?is)```(?:json)?\\s*(.*?)```', 1) else regexp_extract(t, '(?s)([\\[{].*[\\]}])', 1) end) b
  from (select event_id, case event_id % 3 when 0 then 'Sure:' || chr(10) || '```json' || chr(10) || props || chr(10) || '```' when 1 then 'answer ' || props || ' done' else props end t from events))""")
def h20_h21_json_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("props")
    t = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("Sure:\n```json\n"), p, F.lit("\n```"))).when(F.col("event_id") % 3 == 1, F.concat(F.lit("answer "), p, F.lit(" done"))).otherwise(p)
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object(lx.json_body(t), "$.k").cast("long").alias("k"))


@query(f"""with {OBSERVATIONS_SQL}, s as (select distinct video_id, round(seg_start * 100)::bigint a, round(seg_end * 100)::bigint b, segment_id from obs),
p as (select video_id, round(seg_start * 100)::bigint a, round(seg_end * 100)::bigint b, observation_id from obs where video_id >= 4 or round(seg_start)::bigint % 40 <> 0),
j as (select video_id, segment_id, observation_id from s left join p using (video_id, a, b))
select *, bool_or(observation_id is null) over (partition by video_id) run_failed from j""")
def c6_replay_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = observations(spark, sf_dir)
    prior = o.where("video_id >= 4 or cast(round(seg_start) as long) % 40 <> 0")
    return sq.replayed(prior, o.select("video_id", "segment_id", "seg_start", "seg_end").distinct())
