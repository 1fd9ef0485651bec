"""Projections of star-schema and event tables onto the engine's relations, for queries over tables without boxes or captions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trackloom.sources.tables import spread

START_US = 1_704_067_200_000_000
HOUR_US = 3_600_000_000
FPS = 30.0
FRAME_W, FRAME_H = 1920.0, 1080.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def track_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One box for each user and hour: (video_id, track_id, class_name, frame_index, ts_sec, x1..y2, conf)."""
    ev = table(spark, sf_dir, "events").select("event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"), "user_id", "event_type", "value")
    frame = F.floor((F.col("us") - START_US) / float(HOUR_US)).cast("long")
    kind = F.element_at(F.array(*map(F.lit, ("person", "person", "cardboard box", "push chopper", "dining table"))), (F.col("user_id") % 5 + 1).cast("int"))
    first = F.row_number().over(Window.partitionBy("user_id", "frame_index").orderBy("event_id"))
    p = ev.withColumn("frame_index", frame).repartition("user_id").withColumn("_nth", first).where("_nth = 1")  # dealt once, for this window and those by track
    cx = 200.0 + (F.col("user_id") * 9.0) % 1200 + F.col("value")
    cy = 300.0 + F.col("value") * 0.5
    w, h = 40.0 + F.col("event_id") % 60, 40.0 + F.col("event_id") % 45
    return p.select(
        (F.col("user_id") % 8).alias("video_id"),
        F.col("user_id").alias("track_id"),
        kind.alias("class_name"),
        "frame_index",
        (F.col("frame_index") / FPS).alias("ts_sec"),
        (cx - w / 2).alias("x1"),
        (cy - h / 2).alias("y1"),
        (cx + w / 2).alias("x2"),
        (cy + h / 2).alias("y2"),
        F.when(F.col("event_type") == "error", 0.0).otherwise(0.5 + (F.col("event_id") % 50) / 100.0).alias("conf"),
    )


POINTS_SQL = f"""pts0 as (select *, cast(floor((epoch_us(ts) - {START_US}) / {float(HOUR_US)}) as bigint) frame_index,
  row_number() over (partition by user_id, cast(floor((epoch_us(ts) - {START_US}) / {float(HOUR_US)}) as bigint) order by event_id) nth from events),
pts1 as (select *, 200.0e0 + (user_id * 9.0e0) % 1200 + value cx, 300.0e0 + value * 0.5e0 cy, 40.0e0 + event_id % 60 w, 40.0e0 + event_id % 45 h from pts0 where nth = 1),
pts as (select user_id % 8 video_id, user_id track_id,
  case user_id % 5 when 2 then 'cardboard box' when 3 then 'push chopper' when 4 then 'dining table' else 'person' end class_name,
  frame_index, frame_index / 30.0e0 ts_sec, cx - w / 2 x1, cy - h / 2 y1, cx + w / 2 x2, cy + h / 2 y2,
  case when event_type = 'error' then 0.0e0 else 0.5e0 + (event_id % 50) / 100.0e0 end conf from pts1)"""


def nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Track points in which boxes of one class often lie in those of another: boxes of the cardboard box are enlarged, all others halved and moved to a few places."""
    p = track_points(spark, sf_dir)
    w, h = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    big, shift = F.col("class_name") == "cardboard box", F.col("frame_index") % 5 * 30.0
    x, y = F.when(big, 0.0).otherwise(shift), F.when(big, 0.0).otherwise(10.0)
    return p.withColumns({"x1": x, "y1": y, "x2": x + F.when(big, w + 60).otherwise(w / 2), "y2": y + F.when(big, h + 60).otherwise(h / 2)})


NESTED_SQL = POINTS_SQL + """, nst as (select * replace (case when class_name = 'cardboard box' then 0.0e0 else frame_index % 5 * 30.0e0 end as x1, case when class_name = 'cardboard box' then 0.0e0 else 10.0e0 end as y1,
  case when class_name = 'cardboard box' then x2 - x1 + 60 else frame_index % 5 * 30.0e0 + (x2 - x1) / 2 end as x2, case when class_name = 'cardboard box' then y2 - y1 + 60 else 10.0e0 + (y2 - y1) / 2 end as y2) from pts)"""


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One box for each order line: (video_id, frame_index, det_id, class_name, x1..y2, conf); det_id is unique up to repeated lines."""
    line, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    x1, y1 = F.col("l_partkey") % 1600 + 0.0, F.col("l_suppkey") % 100 * 9.0
    return line.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        (F.col("l_orderkey") % 16).alias("video_id"),
        F.col("l_orderkey").alias("frame_index"),
        F.concat_ws("-", "l_linenumber", "l_partkey", "l_suppkey").alias("det_id"),
        F.when(F.col("l_linenumber") % 2 == 1, "person").otherwise(F.col("p_name")).alias("class_name"),
        x1.alias("x1"),
        y1.alias("y1"),
        (x1 + 20 + 8 * F.col("l_quantity")).alias("x2"),
        (y1 + 20.0 + 8 * F.col("p_size")).alias("y2"),
        (0.5 + 5 * F.col("l_discount")).alias("conf"),
    )


DETECTIONS_SQL = """det as (select l_orderkey % 16 video_id, l_orderkey frame_index, concat_ws('-', l_linenumber, l_partkey, l_suppkey) det_id,
  case when l_linenumber % 2 = 1 then 'person' else p_name end class_name, l_partkey % 1600 + 0.0e0 x1, l_suppkey % 100 * 9.0e0 y1,
  l_partkey % 1600 + 0.0e0 + 20 + 8 * l_quantity x2, l_suppkey % 100 * 9.0e0 + 20.0e0 + 8 * p_size y2, 0.5e0 + 5 * l_discount conf
  from lineitem join part on l_partkey = p_partkey)"""

#: Captions of the observation view, by event_id modulo their number; {} is the first object's name.
CAPTIONS = (
    "picking up the {}",
    "placing the {} into the cardboard box",
    "placing the {} into the cardboard box and closing the lid",
    "removing the {} out of the cardboard box, then placing the box on the table",
    "placing the {} on the red folder",
    "resting near the {}",
    "unboxing the push chopper from the cardboard box",
    "opening and unpacking the cardboard box",
    "from the box, the {} is pushed and pushed, then dropped and picked up",
)
FACTS = (None, "the lid is open", "the cardboard box is closed", "the lid was open and is closed now", "nothing changes", "the {} is held in hand, lifted off table", "the {} was put on table", "an open cardboard box beside the {}")
SAID = (None, "opened the closed {}", None, "kept holding it", "already open", "was open before")
REASONS = ("gateway said 503 UNAVAILABLE: try again", "no json in a very long answer that goes on and on and on and on and on", "error 429 RESOURCE_EXHAUSTED")
#: What the objects of a caption are, by event_id modulo their number.
OBJECTS = (("{}",), ("cardboard box", "{}"), ("{}", "cardboard box", "push chopper"), (), ("push chopper", "box"))
#: Wordings of labelled clips, by the clip's number modulo their number.
TEMPLATES = ("Putting [something] into [something]", "Taking [something]  out of [something]", "Picking [something] up", "Folding [something]", "Pushing [something] off of [something]", "Putting [something] onto [something]", "Closing [something]")


def _chosen(options: tuple, key: str, quote=lambda o: "null" if o is None else "'" + o + "'") -> str:
    """SQL that both engines read: the option of a number modulo their count."""
    return f"case {key} % {len(options)} " + " ".join(f"when {i} then {quote(o)}" for i, o in enumerate(options)) + " end"


def _list_of(brackets: str):
    def quote(labels: tuple) -> str:
        inner = ", ".join("p_name" if x == "{}" else f"'{x}'" for x in labels)
        return brackets.replace("..", inner) if labels else f"cast({brackets.replace('..', '')} as {'array<string>' if brackets.startswith('array') else 'varchar[]'})"

    return quote


def _observed(brackets: str, whole: str, text: str) -> str:
    """The columns of the observation view; the dialects differ in lists and whole division."""
    n = f"({whole})"
    names = lambda options: f"replace({_chosen(options, 'event_id')}, '{{}}', p_name)"
    return f"""{n} % 8 video_id, concat('seg_', {n}) segment_id, event_id observation_id, case when event_type = 'error' then 'FAILED' else 'SUCCESS' end status,
  {names(CAPTIONS)} raw_action, {_chosen(OBJECTS, 'event_id', _list_of(brackets))} objects, case when event_id % 4 <> 0 then 'person' end actor,
  {names(FACTS)} visible_facts, {names(SAID)} state_change, case when event_type = 'error' then {_chosen(REASONS, 'event_id')} end error_reason,
  (event_id % 100) / cast(100 as double) confidence, {n} * cast(8 as double) seg_start, {n} * cast(8 as double) + 8 seg_end,
  case when event_id % 13 <> 0 then {n} * cast(8 as double) + event_id % 5 end start_sec, case when event_id % 13 <> 0 then {n} * cast(8 as double) + event_id % 5 + 1 + event_id % 3 end end_sec"""


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A caption for each event: (video_id, segment_id, observation_id, status, raw_action, objects, actor, visible_facts, state_change, error_reason, confidence, seg_start, seg_end, start_sec, end_sec).

    Four events in turn are a segment. Times are those that the caption gives, null for some.
    """
    ev, part = table(spark, sf_dir, "events"), table(spark, sf_dir, "part")
    n = max(1, part.count())
    keyed = ev.select("event_id", "event_type").withColumn("p_partkey", F.col("event_id") % n)
    both = spread(keyed.join(part.select("p_partkey", "p_name"), "p_partkey"))
    columns = _observed("array(..)", "event_id div 4", "string")
    return both.selectExpr(*_columns(columns))


def _columns(text: str) -> list[str]:
    """A list of columns cut at the commas outside brackets and quotes."""
    out, depth, quoted, at = [], 0, False, 0
    for i, c in enumerate(text):
        quoted ^= c == "'"
        if not quoted:
            depth += (c in "([") - (c in ")]")
            if c == "," and not depth:
                out.append(text[at:i])
                at = i + 1
    return [*out, text[at:]]


def segment_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tracks of each segment: (video_id, segment_id, track_id, class_name, n_points, surface). A surface is a marking on another object."""
    ev = table(spark, sf_dir, "events").select("event_id", "user_id")
    points = ev.groupBy("user_id").agg(F.count("*").alias("n_points"))
    kind = F.element_at(F.array(*map(F.lit, ("person", "Person", "cardboard box", "push chopper", "dining table"))), (F.col("user_id") % 5 + 1).cast("int"))
    number = F.expr("event_id div 4")
    rows = ev.select((number % 8).alias("video_id"), F.concat(F.lit("seg_"), number).alias("segment_id"), "user_id").distinct().join(points, "user_id")
    return rows.select("video_id", "segment_id", F.col("user_id").alias("track_id"), kind.alias("class_name"), "n_points", (F.col("user_id") % 7 == 0).alias("surface"))


def segment_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seconds at which something changes in a segment: (video_id, segment_id, sec)."""
    number = F.expr("event_id div 4")
    return table(spark, sf_dir, "events").select((number % 8).alias("video_id"), F.concat(F.lit("seg_"), number).alias("segment_id"), (number * 8.0 + F.col("event_id") % 7 + 0.5).alias("sec"))


def clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A labelled clip for each segment: (video_id, segment_id, template, exit_code, seconds, has_output)."""
    number = F.expr("event_id div 4")
    seg = table(spark, sf_dir, "events").select(number.alias("n")).distinct()
    template = F.expr(_chosen(TEMPLATES, "n"))
    return seg.select(
        (F.col("n") % 8).alias("video_id"),
        F.concat(F.lit("seg_"), "n").alias("segment_id"),
        template.alias("template"),
        F.when(F.col("n") % 23 == 0, 1).otherwise(0).alias("exit_code"),
        (20.0 + F.col("n") * 7 % 31).alias("seconds"),
        (F.col("n") % 17 != 0).alias("has_output"),
    )


OBSERVATIONS_SQL = f"""obs as (select {_observed('[..]', 'event_id // 4', 'varchar')} from events join part on p_partkey = event_id % (select count(*) from part)),
stk as (select distinct (event_id // 4) % 8 video_id, 'seg_' || (event_id // 4) segment_id, user_id track_id,
  case user_id % 5 when 0 then 'person' when 1 then 'Person' when 2 then 'cardboard box' when 3 then 'push chopper' else 'dining table' end class_name,
  count(*) over (partition by user_id) n_points, user_id % 7 = 0 surface from events),
chg as (select distinct (event_id // 4) % 8 video_id, 'seg_' || (event_id // 4) segment_id, (event_id // 4) * 8.0e0 + event_id % 7 + 0.5e0 sec from events),
clp as (select distinct (event_id // 4) % 8 video_id, 'seg_' || (event_id // 4) segment_id, {_chosen(TEMPLATES, '(event_id // 4)')} as template,
  case when (event_id // 4) % 23 = 0 then 1 else 0 end exit_code, 20.0e0 + (event_id // 4) * 7 % 31 as seconds, (event_id // 4) % 17 <> 0 has_output from events)"""
