"""Queries over captions checked against the rest of their observation; registered in the catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackloom.functions import corroboration as co
from trackloom.plans.catalog import query, rounded
from trackloom.plans.views import OBSERVATIONS_SQL, observations

#: What a model infers and is unsure of, by observation_id modulo their number.
_INFERRED = "case observation_id % 7 when 0 then 'the object was moved' when 1 then 'the hand moves up' when 2 then 'the hand is lifted but did not move' when 3 then 'it failed to go in' when 4 then 'look closely' end"
_UNSURE = "case observation_id % 17 when 3 then 'the lid is Occluded' when 5 then 'unclear' when 7 then 'the box may be moved without care' end"
#: Captions of several tenses beside those of the view.
_CAPTION = "case observation_id % 11 when 1 then 'PLACED the cup, then let go' when 2 then 'shutting the drawer and stirring, and tapped it' when 3 then 'no placement was observed' when 4 then ' unknown ' when 5 then 'the person carries and then slides it' when 6 then 'examining the label' else raw_action end"


def _said(field: str, pattern: str, there: bool) -> str:
    return f"{'' if there else 'not '}regexp_matches({field}, '{pattern.replace(chr(39), chr(39) * 2)}')"


def _verbs(name: str) -> str:
    return _said("c", co.verb_pattern(*co.VERBS[name]), True)


_DECIDED = f"""case when {_said('u', co.UNSEEN, True)} then 'UNKNOWN'
 when {_said('c', co.INTO, True)} and {_verbs('insert')} then case when {_said('c', co.NEGATED, True)} or {_said('e', co.NEGATED, True)} then 'UNKNOWN' else 'INSERT' end
 when {_said('c', co.OUT_OF, True)} and {_verbs('remove')} then case when {_said('c', co.NEGATED, True)} or {_said('e', co.NEGATED, True)} then 'UNKNOWN' else 'REMOVE' end
 when {_verbs('release')} then 'RELEASE'
 when {_verbs('pick')} then case when {_said('e', co.UPWARD, True)} and {_said('e', co.UNMOVED, False)} then 'PICK' else 'UNKNOWN' end
 when {_verbs('grasp')} then case when {_said('e', co.NOT_HELD, True)} then 'UNKNOWN' when {_said('f', co.UPWARD, True)} then 'PICK' else 'GRASP' end
 when {_verbs('place')} then case when {_said('e', co.NOT_PLACED, True)} then 'UNKNOWN' else 'PLACE' end
 when {_verbs('open')} then case when contains(f, 'already open') or contains(s, 'already open') then 'UNKNOWN' else 'OPEN' end
 when {_verbs('close')} then case when contains(f, 'already closed') or contains(s, 'already closed') then 'UNKNOWN' else 'CLOSE' end
 when contains(c, ' is open') or contains(c, ' is closed') then 'UNKNOWN'
 when {_verbs('move')} then case when {_said('e', co.OBJECT_MOVED, True)} then 'MOVE' else 'UNKNOWN' end
 when {_verbs('push')} then 'PUSH' when {_verbs('pull')} then 'PULL' when {_verbs('tool')} then 'USE_TOOL' when {_verbs('touch')} then 'TOUCH'
 when {_verbs('inspect')} then case when {_said('e', co.LOOKED, True)} then 'INSPECT' else 'UNKNOWN' end else 'UNKNOWN' end"""


@query(f"""with {OBSERVATIONS_SQL}, o0 as (select *, {_CAPTION} caption, lower(coalesce(visible_facts, '')) f, lower(coalesce(state_change, '')) s, lower(coalesce({_INFERRED}, '')) n, lower(coalesce({_UNSURE}, '')) u from obs),
o1 as (select *, lower(coalesce(caption, '')) low, f || ' ' || n || ' ' || u e, coalesce(caption, '') = '' or upper(trim(caption)) = 'UNKNOWN' missing from o0),
p0 as (select *, list_filter(list_transform(string_split_regex(low, '{co.CLAUSES}'), lambda x: trim(x)), lambda x: x <> '') ps from o1),
p1 as (select *, unnest(range(1, len(ps) + 1)) i, unnest(ps) c from p0 where len(ps) > 1 and not missing),
p2 as materialized (select observation_id, i, {_DECIDED} act from p1),
p3 as (select observation_id, i, act, lag(act) over (partition by observation_id order by i) prior from p2 where act <> 'UNKNOWN'),
p4 as materialized (select observation_id, act, row_number() over (partition by observation_id order by i) - 1 k, count(*) over (partition by observation_id) > 1 parted from p3 where prior is distinct from act),
w0 as (select *, low c from o1 where observation_id not in (select observation_id from p4)),
w1 as (select observation_id, case when missing then 'UNKNOWN' else {_DECIDED} end act, 0 k, false parted from w0),
al as (select * from p4 union all select * from w1)
select observation_id, k::int clause, act as action, case when parted or start_sec is null or end_sec is null then 'SEGMENT' else 'EXACT' end timing,
  round(case when parted or start_sec is null or end_sec is null then seg_start else start_sec end, 6) start_sec, round(case when parted or start_sec is null or end_sec is null then seg_end else end_sec end, 6) end_sec,
  round(coalesce(confidence, 0), 6) confidence from al join o1 using (observation_id)""")
def h25_corroborated_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = observations(spark, sf_dir).withColumns({"caption": F.expr(_CAPTION), "inference": F.expr(_INFERRED), "uncertainty": F.expr(_UNSURE)})
    found = co.corroborated_actions(F.col("caption"), F.col("visible_facts"), F.col("state_change"), F.col("inference"), F.col("uncertainty"))
    rows = o.select("observation_id", "seg_start", "seg_end", "start_sec", "end_sec", "confidence", F.posexplode(found).alias("clause", "x"))
    whole = F.col("x.parted") | F.col("start_sec").isNull() | F.col("end_sec").isNull()
    return rounded(
        rows.select(
            "observation_id",
            "clause",
            "x.action",
            F.when(whole, "SEGMENT").otherwise("EXACT").alias("timing"),
            F.when(whole, F.col("seg_start")).otherwise(F.col("start_sec")).alias("start_sec"),
            F.when(whole, F.col("seg_end")).otherwise(F.col("end_sec")).alias("end_sec"),
            F.coalesce("confidence", F.lit(0.0)).alias("confidence"),
        )
    )
