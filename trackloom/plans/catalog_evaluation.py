"""Queries over evaluation tables: events against labels, clips against their wording; registered in the catalog."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackloom.functions import lexicon as lx
from trackloom.operators import evaluation as va
from trackloom.plans.catalog import query, rounded
from trackloom.plans.catalog_events import EVENTS_SQL, case, events, kept_events, said, score
from trackloom.plans.views import OBSERVATIONS_SQL, clips, observations, table
from trackloom.sources import commits
from trackloom.sources.tables import shared_dir

#: Directions of labels, by observation_id modulo their number.
_STATED = (None, "INTO", "NONE", "ONTO", "out_of")
_ACT = "case when observation_id % 15 = 0 then 'PICK' when observation_id % 15 = 3 then 'JUGGLE' when observation_id % 15 = 6 then {opp} else action end"
_OPPOSITE = case([(f"action = '{a}'", f"'{b}'") for a, b in lx.ANTONYMS.items()], "'PUSH'")
_SAID = "case observation_id % 5 " + " ".join(f"when {i} then {'null' if x is None else said(x)}" for i, x in enumerate(_STATED)) + " end"
#: Labels of the evaluation: every third event, moved by half a second, some with another action.
_TRUTH = f"""tt as materialized (select video_id, event_id label_id, start_sec + 0.5e0 t_start, end_sec + 0.5e0 t_end, {_ACT.format(opp=_OPPOSITE)} truth_action, object_label truth_object, case when observation_id % 2 = 0 then 'cardboard box' end truth_target, {_SAID} truth_direction from ev where observation_id % 3 = 0)"""


def truth(e: DataFrame) -> DataFrame:
    act = F.expr(_ACT.format(opp=_OPPOSITE))
    rows = e.where("observation_id % 3 = 0")
    return rows.select(
        "video_id", F.col("event_id").alias("label_id"), (F.col("start_sec") + 0.5).alias("t_start"), (F.col("end_sec") + 0.5).alias("t_end"), act.alias("truth_action"), F.col("object_label").alias("truth_object"), F.expr("case when observation_id % 2 = 0 then 'cardboard box' end").alias("truth_target"), F.expr(_SAID).alias("truth_direction")
    )


_BACK = case([(f"truth_action = '{a}'", f"'{b}'") for a, b in lx.ANTONYMS.items()], "null")
_MINE = case([(f"action = '{a}'", f"'{d}'") for a, d in lx.DIRECTIONS.items()], "null")
_TURN = case([(f"wanted = '{a}'", f"'{b}'") for a, b in lx.OPPOSITE_DIRECTIONS.items()], "null")
_WORDS = ", ".join(map(said, va.VOCABULARY))
_ON = " or ".join(f"{score('object_label', c)} > 0" for c in ("truth_object", "truth_target"))
ASSESS_SQL = f"""{EVENTS_SQL}, {_TRUTH},
a0 as (select e.video_id, e.event_id, e.action, e.object_label, e.start_sec, e.end_sec, label_id, t_start, t_end, truth_action, truth_object, truth_target, upper(trim(truth_direction)) stated, least(e.end_sec, t_end) - greatest(e.start_sec, t_start) > 0 hit
  from ev e join tt on e.video_id = tt.video_id and least(e.end_sec + 1.0e0, t_end) - greatest(e.start_sec - 1.0e0, t_start) > 0),
a1 as (select *, bool_or(hit) over (partition by video_id, event_id) any_hit, coalesce({_ON}, false) named from a0),
a2 as (select *, bool_or(named) over (partition by video_id, event_id) any_named from a1 where hit or not any_hit),
a3 as materialized (select *, action = truth_action same, greatest(0.0e0, least(end_sec, t_end) - greatest(start_sec, t_start)) size from a2 where named or not any_named),
a4 as (select video_id, event_id, count(*) n, bool_or(same) same, bool_or(coalesce(action = {_BACK}, false)) turned, bool_or(hit) hit, bool_or(truth_action in ({_WORDS})) worded,
  arg_min({{'a': t_start, 'b': t_end}}, (not same, case when same then 0.0e0 else -size end, t_start, label_id)) "on",
  arg_min(stated, (not same, t_start, label_id)) filter (stated not in ('', 'NONE') or (same and stated <> '')) wanted from a3 group by 1, 2),
a5 as (select ev.video_id, ev.event_id, action, n, same, turned, hit, worded, wanted, {_MINE} mine, greatest(abs(start_sec - "on".a), abs(end_sec - "on".b)) boundary_error from ev left join a4 using (video_id, event_id)),
asd as materialized (select video_id, event_id, action, case when n is null then 'UNMATCHED' when same then 'EXACT' when turned then 'REVERSED' when not worded then 'NOT_IN_VOCABULARY' else 'OTHER' end verdict,
  case when n > 1 then 'AMBIGUOUS x' || n when hit then 'PRECISE' when n = 1 then 'NEAR' end attribution, coalesce(n, 0)::bigint n_covered, boundary_error,
  case when boundary_error <= 1.0e0 then 'WITHIN_TOL' when boundary_error is not null then 'OUTSIDE_TOL' else 'N/A' end timing_verdict,
  case when mine is null or wanted is null or wanted in ('', 'NONE') then 'N/A' when mine = wanted then 'SAME' when {_TURN} = mine then 'REVERSED' else 'OTHER' end direction_verdict from a5)"""


def assessed(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = kept_events(spark, sf_dir)
    return va.assess(e, truth(e))


@query(f"with {ASSESS_SQL} select video_id, event_id, action, verdict, attribution, n_covered, round(boundary_error, 6) boundary_error, timing_verdict, direction_verdict from asd")
def c9_m1_assess(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(assessed(spark, sf_dir))


@query(f"with {ASSESS_SQL} select verdict, attribution, timing_verdict, direction_verdict, action, count(*) n from asd group by all")
def d16_verdict_tallies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assessed(spark, sf_dir).groupBy("verdict", "attribution", "timing_verdict", "direction_verdict", "action").agg(F.count("*").alias("n"))


@query(f"""with {EVENTS_SQL}, {_TRUTH}, h as (select distinct tt.video_id, label_id from tt join ev on ev.video_id = tt.video_id and least(end_sec, t_end) - greatest(start_sec, t_start) > 0)
select truth_action, count(*) n, count(h.label_id) covered, round(count(h.label_id) / count(*), 6) ceiling from tt left join h using (video_id, label_id) group by 1""")
def d16_recall_ceiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = kept_events(spark, sf_dir)
    return rounded(va.recall_ceiling(e, truth(e)))


@query(f"""with {EVENTS_SQL}, {_TRUTH}, p as (select e.video_id, e.event_id, least(end_sec, t_end) - greatest(start_sec, t_start) bth, end_sec - start_sec + t_end - t_start total from ev e join tt on e.video_id = tt.video_id and e.action = truth_action
  and least(end_sec, t_end) - greatest(start_sec, t_start) > 0 and ({_ON} or not exists (select 1 from tt t2 where t2.video_id = e.video_id and least(e.end_sec, t2.t_end) - greatest(e.start_sec, t2.t_start) > 0 and ({_ON.replace('truth_', 't2.truth_')}))))
select video_id, event_id, round(max(bth / (total - bth)), 6) iou from p group by 1, 2""")
def m12_span_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = kept_events(spark, sf_dir)
    return rounded(va.span_scores(e, truth(e)))


@query(f"with {EVENTS_SQL}, {_TRUTH} select truth_action, action, count(*) n from tt join ev on label_id = event_id and tt.video_id = ev.video_id where truth_action <> action group by 1, 2 order by n desc, truth_action, action limit 15")
def d15_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = kept_events(spark, sf_dir)
    t = truth(e).select(F.col("video_id").alias("v"), "label_id", "truth_action")
    return va.confusion(t.join(e, (F.col("v") == F.col("video_id")) & (F.col("label_id") == F.col("event_id"))).select("truth_action", "action"), "truth_action", "action", 15)


_EXPANDED = "select video_id, event_id label_id, case when event_id % 7 = 0 then '' when event_id % 7 = 1 then null else 'PICK' end truth_action, value t_start, value + 1.5e0 t_end, event_id % 4 + 1 repeats from (select *, user_id % 8 video_id from events)"


@query(f"select video_id, label_id, copy, round(t_start + copy * 6.5e0, 6) t_start, round(t_end + copy * 6.5e0, 6) t_end from (select *, unnest(range(0, repeats)) copy from ({_EXPANDED})) where truth_action <> ''")
def b17_expanded_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "events").selectExpr("user_id % 8 video_id", "event_id label_id", "case when event_id % 7 = 0 then '' when event_id % 7 = 1 then null else 'PICK' end truth_action", "value t_start", "value + 1.5D t_end", "event_id % 4 + 1 repeats")
    return rounded(va.expanded(t, F.col("repeats"), F.lit(6.5)).select("video_id", "label_id", "copy", "t_start", "t_end"))


@query(f"with {OBSERVATIONS_SQL} select video_id, observation_id from obs where status = 'SUCCESS' and (case when observation_id % 41 = 0 then 'LOCAL_MODEL' else 'API' end = 'LOCAL_MODEL' or contains(lower(case when observation_id % 43 = 0 then 'Stub-1' else 'big' end), 'stub'))")
def m5_stub_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = observations(spark, sf_dir).withColumns({"backend": F.expr("case when observation_id % 41 = 0 then 'LOCAL_MODEL' else 'API' end"), "model_name": F.expr("case when observation_id % 43 = 0 then 'Stub-1' else 'big' end")})
    return va.refused(o).select("video_id", "observation_id")


_NORMAL = "trim(regexp_replace(regexp_replace(template, '[\\[\\]]', '', 'g'), '\\s+', ' ', 'g'))"
_LABELS = "(values " + ", ".join(f"('{k}', '{v}')" for k, v in va.LABEL_ACTIONS.items()) + ") la(name, truth_action)"
_TOLD = " ".join(f"when contains(lo, ' {w} ') then '{d}'" for w, d in lx.TEMPLATE_WORDS)
_GOT = case([(f"got = '{a}'", f"'{d}'") for a, d in lx.DIRECTIONS.items()], "null")
#: Ends in rec: a row for each labelled clip with its answer.
RECORDS_SQL = f"""{EVENTS_SQL}, bst as (select video_id, segment_id, count(*) n, list(action order by observation_id, clause) verbs, arg_min({{'a': action, 'r': raw_action}}, (-coalesce(confidence, 0), start_sec, observation_id, clause)) best from ev group by 1, 2),
cps as (select video_id, segment_id, list({{'o': observation_id, 'raw_action': raw_action, 'objects': objects, 'status': status, 'error_reason': error_reason}} order by observation_id) captions from obs group by 1, 2),
r1 as (select clp.video_id, clp.segment_id, template, truth_action, exit_code, seconds, has_output, case when has_output then best.a end got, case when has_output then coalesce(n, 0) else 0 end n_events, case when has_output then coalesce(verbs, []) else [] end all_verbs,
  case when has_output then best.r end raw_action, captions, ' ' || lower(regexp_replace(template, '[\\[\\]]', '', 'g')) || ' ' lo from clp join {_LABELS} on name = {_NORMAL} left join bst using (video_id, segment_id) left join cps using (video_id, segment_id)),
r2 as (select *, case {_TOLD} end wanted, {_GOT} mine from r1),
rec as materialized (select *, case when not has_output then 'NO_OUTPUT' when got is null then 'NO_EVENTS' when got = truth_action then 'TOP1' when list_contains(all_verbs, truth_action) then 'ANY_ONLY' else 'MISS' end verdict,
  case when got is null or mine is null or wanted is null then 'N/A' when mine = wanted then 'SAME' when {_TURN} = mine then 'REVERSED' else 'OTHER' end direction from r2),
rcz as materialized (select * replace (case when substr(segment_id, 5)::bigint % 19 = 0 then null when substr(segment_id, 5)::bigint % 29 = 0 then [] else captions end as captions) from rec),
cau as materialized (select *, case when verdict = 'TOP1' then 'CORRECT' when captions is null then 'UNKNOWN_CAUSE' when len(captions) = 0 then 'NO_SEGMENT' when len(list_filter(captions, lambda c: coalesce(c.raw_action, '') <> '')) = 0 then 'VLM_FAILED'
  when verdict = 'ANY_ONLY' then 'RANKING' when coalesce(got, 'UNKNOWN') = 'UNKNOWN' then 'UNMAPPED' else 'WRONG_VERB' end cause from rcz)"""


def answered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return va.records(clips(spark, sf_dir), events(spark, sf_dir), observations(spark, sf_dir))


def partly(r: DataFrame) -> DataFrame:
    """The records, some without captions, as older runs have them."""
    n = F.substring("segment_id", 5, 20).cast("long")
    return r.withColumn("captions", F.when(n % 19 == 0, F.lit(None)).when(n % 29 == 0, F.slice("captions", 1, 0)).otherwise(F.col("captions")))


@query(f"with {RECORDS_SQL} select video_id, segment_id, template, truth_action, exit_code, round(seconds, 6) as seconds, n_events, got, array_to_string(all_verbs, ',') all_verbs, raw_action, verdict, direction, coalesce(len(captions), 0) n_captions from rec")
def m6_clip_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = answered(spark, sf_dir)
    return rounded(r.withColumn("n_captions", F.coalesce(F.size("captions"), F.lit(0)).cast("long")).withColumn("all_verbs", F.array_join("all_verbs", ",")).drop("captions"))


@query(f"""with {RECORDS_SQL}, w as (select truth_action, got, count(*) k from rec where verdict = 'MISS' group by 1, 2), ww as (select truth_action, arg_min(got, (-k, got)) common_wrong, max(k) common_n from w group by 1)
select truth_action, count(*) n, count(*) filter (verdict = 'TOP1') top1, count(*) filter (verdict in ('TOP1', 'ANY_ONLY')) any_hit, count(*) filter (verdict = 'MISS') miss, count(*) filter (verdict in ('NO_EVENTS', 'NO_OUTPUT')) no_event, count(*) filter (exit_code <> 0) failed,
  round(avg((verdict = 'TOP1')::int), 6) rate, any_value(common_wrong) common_wrong, any_value(common_n) common_n from rec left join ww using (truth_action) group by 1""")
def d14_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(va.accuracy(answered(spark, sf_dir)))


@query(f"""with {RECORDS_SQL}, a as (select truth_action, avg((verdict = 'TOP1')::int) rate from rec group by 1)
select count(*) n, round(100.0e0 * avg((verdict = 'TOP1')::int), 6) micro, (select round(100.0e0 * avg(rate), 6) from a) macro, round(100.0e0 * avg((verdict in ('TOP1', 'ANY_ONLY'))::int), 6) any_hit, count(*) filter (verdict in ('NO_EVENTS', 'NO_OUTPUT')) no_event, count(*) filter (exit_code <> 0) failed from rec""")
def d14_headline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(va.headline(answered(spark, sf_dir)))


@query(f"""with {RECORDS_SQL}, c as (select cause, count(*) n from cau group by 1), t as (select sum(n) total, coalesce(sum(n) filter (cause = 'CORRECT'), 0) r from c)
select cause, n, round(100.0e0 * n / total, 6) share, round(case when cause not in ('CORRECT', 'UNKNOWN_CAUSE') then 100.0e0 * (r + n) / total end, 6) headroom from c, t""")
def m7_d17_cause_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(va.cause_shares(partly(answered(spark, sf_dir))))


_SIGN = "case when regexp_matches(e, '\\b([0-9]{3}\\s+[A-Z][A-Z_]+)') then regexp_replace(regexp_extract(e, '\\b([0-9]{3}\\s+[A-Z][A-Z_]+)', 1), '\\s+', ' ', 'g') else left(e, 56) end"


@query(f"""with {RECORDS_SQL}, c as (select unnest(captions) c from rcz), s as (select 'asked' signature from c union all select 'failed' from c where coalesce(c.raw_action, '') = '' or c.status <> 'SUCCESS' union all select {_SIGN} from (select c.error_reason e from c) where coalesce(e, '') <> '')
select signature, count(*) n from s group by 1""")
def d18_h29_reliability(spark: SparkSession, sf_dir: str) -> DataFrame:
    return va.reliability(partly(answered(spark, sf_dir)))


@query(f"""with {RECORDS_SQL}, o as (select video_id, segment_id, list_filter(list_transform(captions, lambda c: c.error_reason), lambda e: coalesce(e, '') <> '') own from rcz),
x as (select video_id, segment_id, list(error_reason order by error_reason) run from obs where error_reason is not null group by 1, 2)
select video_id, segment_id, array_to_string(case when len(own) > 0 then own else coalesce(run, []) end, '; ') reasons from o left join x using (video_id, segment_id)""")
def a16_failure_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = va.reasons(partly(answered(spark, sf_dir)), observations(spark, sf_dir))
    return found.withColumn("reasons", F.array_join("reasons", "; "))


@query(f"with {RECORDS_SQL} select truth_action, segment_id, got, cause, left(coalesce(nullif(raw_action, ''), list_filter(captions, lambda c: coalesce(c.raw_action, '') <> '')[1].raw_action, ''), 60) caption from cau")
def m13_h37_appendix(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = partly(answered(spark, sf_dir))
    return r.select("truth_action", "segment_id", "got", va.cause(r).alias("cause"), F.left(va.caption_of(F.col("raw_action"), F.col("captions")), F.lit(60)).alias("caption"))


#: Ends in rmp: the clips whose answer has a caption, read again with the objects of that caption; some recorded answers are old.
_REMAP = f"""{RECORDS_SQL}, m0 as (select video_id, segment_id, truth_action, raw_action, case when substr(segment_id, 5)::bigint % 6 = 0 then 'MOVE' else got end was, list_filter(captions, lambda c: c.raw_action is not distinct from rcz.raw_action)[1].o oid from rcz where coalesce(raw_action, '') <> ''),
m1 as (select m0.*, c6.verb now, (select array_to_string(list(verb order by k), ',') from act where act.observation_id = oid) verbs, (select max(n) from act where act.observation_id = oid) n from m0 join c6 on c6.observation_id = oid and c6.i = 0),
rmp as (select *, case when n = 1 then case when was <> truth_action and now = truth_action then 'FIXED' when was = truth_action and now <> truth_action then 'BROKEN' when was <> now then 'CHANGED' else 'SAME' end end outcome from m1)"""


def remapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = partly(answered(spark, sf_dir)).where("captions is not null and size(captions) > 0")
    old = F.when(F.substring("segment_id", 5, 20).cast("long") % 6 == 0, "MOVE").otherwise(F.col("got"))
    return va.remapped(r.withColumn("recorded", old), "recorded")


@query(f"with {_REMAP} select video_id, segment_id, truth_action, was, now, verbs, outcome from rmp")
def m8_remapped_clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remapped(spark, sf_dir).withColumn("verbs", F.array_join("verbs", ",")).drop("raw_action")


@query(f"with {_REMAP} select video_id, segment_id, truth_action, verbs, raw_action, coalesce(list_contains(string_split(verbs, ','), truth_action), false) hit from rmp where n > 1")
def m13_several_verbs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return va.several_verbs(remapped(spark, sf_dir)).withColumn("verbs", F.array_join("verbs", ","))


@query(f"with {_REMAP} select truth_action, count(*) n, count(*) filter (was = truth_action) was, count(*) filter (now = truth_action) now, count(*) filter (now = truth_action) - count(*) filter (was = truth_action) delta from rmp where outcome is not null group by 1")
def m8_remap_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return va.remap_table(remapped(spark, sf_dir))


@query(f"with {RECORDS_SQL} select video_id, segment_id, round(seconds, 6) as seconds from rec order by seconds desc, video_id, segment_id limit 5")
def f8_slowest_clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(va.slowest(answered(spark, sf_dir)))


@query(f"""with {OBSERVATIONS_SQL}, l as (select video_id, segment_id, template from clp where substr(segment_id, 5)::bigint % 11 <> 0)
select case when l.template is null then 'unlabelled' when truth_action is null then 'excluded' else 'usable' end outcome, truth_action as action, count(*) n from clp left join l using (segment_id) left join {_LABELS} on name = {_NORMAL.replace('template', 'l.template')} group by 1, 2""")
def b20_c13_usable_clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = clips(spark, sf_dir)
    labels = c.where(F.substring("segment_id", 5, 20).cast("long") % 11 != 0).select("segment_id", "template")
    return va.usable(c.select("segment_id"), labels, "segment_id", "template")


@query(f"with {OBSERVATIONS_SQL} select name as template from {_LABELS} where name not in (select {_NORMAL} from clp)")
def g9_unlisted_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return va.unlisted(clips(spark, sf_dir), "template")


@query(f"""with {OBSERVATIONS_SQL}, n as (select segment_id, template || '!' as template, seconds + 1 as seconds from clp where exit_code = 1)
select segment_id, template, seconds from n union all select segment_id, template, seconds from clp where segment_id not in (select segment_id from n)""")
def g6_upserted_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = clips(spark, sf_dir).select("segment_id", "template", "seconds", "exit_code")
    new = old.where("exit_code = 1").select("segment_id", F.concat("template", F.lit("!")).alias("template"), (F.col("seconds") + 1).alias("seconds"))
    return va.upsert(old.drop("exit_code"), new, ["segment_id"])


@query(f"""with {OBSERVATIONS_SQL}, n as (select video_id, segment_id, template || '!' as template, seconds + 1 as seconds from clp where exit_code = 1)
select video_id, segment_id, template, seconds from n union all select video_id, segment_id, template, seconds from clp where segment_id not in (select segment_id from n)""")
def a8_committed_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results written to a table in the shared folder, then changed by an upsert, and read back."""
    old = clips(spark, sf_dir).select("video_id", "segment_id", "template", "seconds", "exit_code")
    new = old.where("exit_code = 1").select("video_id", "segment_id", F.concat("template", F.lit("!")).alias("template"), (F.col("seconds") + 1).alias("seconds"))
    root = f"{shared_dir(spark).rstrip('/')}/results-{uuid.uuid4().hex}"
    commits.upsert(root, old.drop("exit_code"), ["segment_id"])
    return commits.upsert(root, new, ["segment_id"]).select("video_id", "segment_id", "template", "seconds")


@query(f"with {OBSERVATIONS_SQL} select segment_id from clp where substr(segment_id, 5)::bigint % 3 <> 0")
def i6_clips_to_do(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = clips(spark, sf_dir)
    return va.undone(c, c.where(F.substring("segment_id", 5, 20).cast("long") % 3 == 0), ["segment_id"]).select("segment_id")


@query("""select event_id, case when contains(lo, ' out of ') then 'OUT_OF' when contains(lo, ' off of ') then 'OFF' when contains(lo, ' into ') then 'INTO' when contains(lo, ' onto ') then 'ONTO' end direction,
  trim(regexp_replace(regexp_replace(w, '[\\[\\]]', '', 'g'), '\\s+', ' ', 'g')) template
from (select *, ' ' || lower(regexp_replace(w, '[\\[\\]]', '', 'g')) || ' ' lo from (select event_id, case event_id % 4 when 0 then 'Putting  [something] into [something]' when 1 then 'Taking [one of many]  out of [something]' when 2 then 'Pushing [something] off of [something]' else 'Holding [something]' end w from events))""")
def h26_h28_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = ("Putting  [something] into [something]", "Taking [one of many]  out of [something]", "Pushing [something] off of [something]", "Holding [something]")
    w = table(spark, sf_dir, "events").select("event_id", F.element_at(F.array(*map(F.lit, words)), (F.col("event_id") % 4 + 1).cast("int")).alias("w"))
    return w.select("event_id", lx.template_direction(F.col("w")).alias("direction"), lx.normal_template(F.col("w")).alias("template"))


@query(f"with {OBSERVATIONS_SQL} select status, segment_id, count(*) n, count(raw_action) with_text, round(avg(confidence), 6) mean_confidence from obs group by 1, 2")
def d18_observation_reliability(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = observations(spark, sf_dir)
    return rounded(o.groupBy("status", "segment_id").agg(F.count("*").alias("n"), F.count("raw_action").alias("with_text"), F.avg("confidence").alias("mean_confidence")))
