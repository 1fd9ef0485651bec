"""Queries over profiles, balanced draws, clause windows and label resolution; registered in the catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackloom.operators import reports
from trackloom.plans.catalog import query, to_places
from trackloom.plans.views import OBSERVATIONS_SQL, observations, segment_changes, table
from trackloom.sources import answers

DRAWN = 300
LABELS = ("push chopper", "red widget", "widget", "large blue gear", "bolt", "picture of a red widget", "gear box")


@query(f"""with {OBSERVATIONS_SQL}, l as (select 'status' field, status value from obs union all select 'raw_action', raw_action from obs
union all select 'visible_facts', visible_facts from obs union all select 'actor', actor from obs)
select field, value, count(*) n, round(count(*) / sum(count(*)) over (partition by field), 6) share from l group by 1, 2""")
def d19_field_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = reports.field_histogram(observations(spark, sf_dir), ("status", "raw_action", "visible_facts", "actor"))
    return found.withColumn("share", to_places("share", 6))


@query(f"""with c as (select event_type, count(*) c from events group by 1),
s as (select l, sum(least(c, l)) s from c, range(0, {DRAWN + 1}) t(l) group by l),
m as (select l, s from s where s <= {DRAWN} order by l desc limit 1),
q as (select event_type, least(c, l) + case when c > l and row_number() over (partition by c > l order by event_type) <= {DRAWN} - s then 1 else 0 end quota from c, m),
r as (select *, row_number() over (partition by event_type order by event_id) nth from events)
select event_id, user_id, r.event_type from r join q on r.event_type = q.event_type and nth <= quota""")
def d22_balanced_draw(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    return reports.balanced_draw(rows, "event_type", "event_id", DRAWN)


@query(f"""with {OBSERVATIONS_SQL}, g as (select video_id, segment_id, min(seg_start) s, min(seg_end) e, min(observation_id) % 3 + 2 n from obs group by 1, 2),
x as (select g.*, (select list(sec) from chg where chg.segment_id = g.segment_id) x from g),
c as (select *, list_sort(list_distinct(list_filter(x, lambda v: v > s and v < e))) i from x),
b as (select segment_id, n, list_concat([s], list_transform(range(1, n), lambda j: i[cast(floor(j * len(i) / n) as bigint) + 1]), [e]) b from c where len(i) >= n - 1)
select segment_id, clause, b[clause + 1] from_sec, b[clause + 2] to_sec from b, lateral (select unnest(range(0, n)) clause)""")
def e13_clause_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    seg = observations(spark, sf_dir).groupBy("video_id", "segment_id").agg(F.min("seg_start").alias("s"), F.min("seg_end").alias("e"), (F.min("observation_id") % 3 + 2).alias("n"))
    found = seg.join(segment_changes(spark, sf_dir).groupBy("segment_id").agg(F.collect_set("sec").alias("changes")), "segment_id")
    cut = reports.clause_windows(F.col("changes"), F.col("s"), F.col("e"), F.col("n"))
    return found.select("segment_id", F.posexplode(cut).alias("clause", "w")).select("segment_id", F.col("clause").cast("long").alias("clause"), "w.from_sec", "w.to_sec")


@query(f"""with v as (select label, pos from (values {", ".join(f"('{v}', {i})" for i, v in enumerate(LABELS))}) t(label, pos)),
t as (select p_partkey, p_name, trim(trim(trim(lower(p_name)), '.')) span from part),
w as (select span, label, pos, list_distinct(regexp_extract_all(span, '[a-z0-9]+')) a, list_distinct(regexp_extract_all(label, '[a-z0-9]+')) b from (select distinct span from t), v),
j as (select span, label, pos, len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))) score from w),
best as (select span, arg_max(label, (score, -pos)) label from j where score > 0 group by 1),
part_of as (select span, arg_max(label, (length(label), -pos)) label from w where contains(span, label) or contains(label, span) group by 1)
select p_partkey, p_name, case when span = '' then 'unmatched' when span in (select label from v) then span else coalesce(best.label, part_of.label, span) end label
from t left join best using (span) left join part_of using (span)""")
def h10_span_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", "p_name", reports.resolved_label(F.col("p_name"), LABELS).alias("label"))


@query(f"""with {OBSERVATIONS_SQL}, o as (select *, case when event_n % 3 <> 0 then {{'low': seg_start, 'high': end_sec, 'names': objects}} end span from (select *, observation_id event_n from obs)),
u as (select unnest(objects) x from obs), w as (select unnest(span.names) x from o where span is not null)
select 'objects' as path, 'array' as kind, count(*) n, count(*) filter (objects is null) n_null, null::double as least, null::double as most, sum(len(objects))::bigint lists, min(len(objects))::int shortest, max(len(objects))::int longest from o
union all select 'objects[]', 'string', count(*), count(*) filter (x is null), null, null, null, null, null from u
union all select 'actor', 'string', count(*), count(*) filter (actor is null), null, null, null, null, null from o
union all select 'confidence', 'double', count(*), count(*) filter (confidence is null), min(confidence), max(confidence), null, null, null from o
union all select 'span', 'struct', count(*), count(*) filter (span is null), null, null, null, null, null from o
union all select 'span.low', 'double', count(*), count(*) filter (span.low is null), min(span.low), max(span.low), null, null, null from o
union all select 'span.high', 'double', count(*), count(*) filter (span.high is null), min(span.high), max(span.high), null, null, null from o
union all select 'span.names', 'array', count(*), count(*) filter (span.names is null), null, null, sum(len(span.names))::bigint, min(len(span.names))::int, max(len(span.names))::int from o
union all select 'span.names[]', 'string', count(*), count(*) filter (x is null), null, null, null, null, null from w""")
def d19_nested_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = observations(spark, sf_dir)
    span = F.when(F.col("observation_id") % 3 != 0, F.struct(F.col("seg_start").alias("low"), F.col("end_sec").alias("high"), F.col("objects").alias("names")))
    found = reports.profile(o.select("objects", "actor", "confidence", span.alias("span")))
    return found.select("path", "kind", "n", "n_null", "least", "most", "lists", "shortest", "longest")


def flaky(row: dict, attempt: int) -> str:
    """A stand-in for a model: some rows are answered at once, others after one or two failures of two kinds, some never."""
    if attempt <= row["user_id"] % 5:
        if attempt % 2:
            raise RuntimeError("503")
        return "sorry"
    return "here: " + str([{"n": row["n"]}] * (1 + row["part"] % 2)).replace("'", '"')


@query("""with r as (select user_id, event_id // 600 part, count(*) n from events group by 1, 2)
select user_id, part, 'SUCCESS' status, i::int nth, '{"n": ' || n || '}' "row", (user_id % 5 + 1)::int attempts, null error from (select *, unnest(range(0, 1 + part % 2)) i from r where user_id % 5 < 3)
union all select user_id, part, 'FAILED', 0, null, 3, 'call: 503' from r where user_id % 5 >= 3""")
def j10_retried_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "events").groupBy("user_id", F.expr("event_id div 600").alias("part")).agg(F.count("*").alias("n"))
    return answers.answered(r, ["user_id", "part"], flaky)
