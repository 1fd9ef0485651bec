"""Statistics, segments and change points of track points: (video_id, track_id, class_name, frame_index, ts_sec, x1, y1, x2, y2, conf)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackloom.functions import geometry as g
from trackloom.functions import sequences as s
from trackloom.operators import pairs as pr

PERSON = "person"
OBJECT_NOT = ("person", "dining table")
TRACK = ["video_id", "track_id"]


def observed(points: DataFrame) -> DataFrame:
    """Points that a detector saw; predicted ones have confidence 0."""
    return points.where(F.col("conf") > 0)


def box_columns(points: DataFrame) -> DataFrame:
    b = g.box()
    return points.withColumns({"width": g.width(b), "height": g.height(b), "area": g.area(b), "cx": g.centre_x(b), "cy": g.centre_y(b)})


def violations(points: DataFrame) -> DataFrame:
    """(rule, n): how many points break each rule of the schema."""
    rules = {
        "box_order": (F.col("x2") <= F.col("x1")) | (F.col("y2") <= F.col("y1")),
        "conf_range": ~F.col("conf").between(0, 1),
        "frame_negative": F.col("frame_index") < 0,
        "outside_left": F.col("x1") < 0,
        "class_missing": F.col("class_name").isNull(),
    }
    sums = points.agg(*[F.sum(F.when(c, 1).otherwise(0)).alias(k) for k, c in rules.items()])
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("rule"), F.coalesce(F.col(k), F.lit(0)).cast("long").alias("n")) for k in rules]))
    return sums.select(pairs.alias("r")).select("r.rule", "r.n")


def moving(points: DataFrame, lookback: int = 5, frame_h: float = 1080.0) -> DataFrame:
    """Adds `moved`: the shift of the centre against the first point of the last `lookback` frames, in frame heights; null for a single point."""
    b = g.box()
    w = Window.partitionBy(*TRACK).orderBy("frame_index").rangeBetween(-lookback, 0)
    p = points.withColumns({"_cx": g.centre_x(b), "_cy": g.centre_y(b)})
    p = p.withColumns({f"_first{k}": F.first(k).over(w) for k in ("_cx", "_cy", "frame_index")})
    dx, dy = F.col("_cx") - F.col("_first_cx"), F.col("_cy") - F.col("_first_cy")
    shift = F.when(F.col("_firstframe_index") < F.col("frame_index"), F.sqrt(dx * dx + dy * dy) / frame_h)
    return p.select(*points.columns, shift.alias("moved"))


def contacts(points: DataFrame, min_iou: float = 0.05, max_gap: float = 0.2, frame_w: float = 1920.0, frame_h: float = 1080.0, need_motion: float | None = 0.05) -> DataFrame:
    """Person and object in the same frame that overlap or are near, one of them moving: (video_id, frame_index, ts_sec, person_id, object_id, kind, distance).

    A track has one class, so people and objects are parted first; motion is worked out once for each point of
    either, and the two meet in a join on the frame. Boxes are plain columns there: the arithmetic of a pair is
    then one short compiled loop, which took a third of the time that it took on structs.
    """
    b = ("x1", "y1", "x2", "y2")

    def side(rows: DataFrame, name: str) -> DataFrame:
        p = moving(rows, frame_h=frame_h) if need_motion is not None else rows.withColumn("moved", F.lit(None).cast("double"))
        return p.select("video_id", "frame_index", "ts_sec", F.col("track_id").alias(f"{name}_id"), F.col("moved").alias(f"_{name}"), *[F.col(c).alias(f"_{name}_{c}") for c in b])

    people = side(points.where(F.col("class_name") == PERSON), "person")
    things = side(points.where(~F.col("class_name").isin(*OBJECT_NOT)), "object").drop("ts_sec")
    pairs = people.join(things, ["video_id", "frame_index"])
    pb, ob = (F.struct(*[F.col(f"_{name}_{c}").alias(c) for c in b]) for name in ("person", "object"))
    overlap = g.iou(pb, ob)
    distance = g.gap(pb, ob) / max(frame_w, frame_h)
    kind = F.when(overlap > min_iou, "overlap").when(distance < max_gap, "near")
    if need_motion is not None:
        pairs = pairs.where((F.coalesce("_person", F.lit(0.0)) > need_motion) | (F.coalesce("_object", F.lit(0.0)) > need_motion))
    pairs = pairs.select("video_id", "frame_index", "ts_sec", "person_id", "object_id", kind.alias("kind"), distance.alias("distance"))
    return pairs.where(F.col("kind").isNotNull())


def contact_frames(points: DataFrame, min_iou: float = 0.05, max_gap: float = 0.2, frame_w: float = 1920.0, frame_h: float = 1080.0, need_motion: float | None = 0.05) -> DataFrame:
    """What contacts() finds, a row for each frame instead of one for each pair; as pairs.contacts_by_frame() tells it."""

    def side(rows: DataFrame, person: bool) -> DataFrame:
        p = moving(rows, frame_h=frame_h) if need_motion is not None else rows.withColumn("moved", F.lit(0.0))
        return p.select("video_id", "frame_index", "ts_sec", F.col("track_id").cast("long").alias("track_id"), *pr.BOX, F.coalesce("moved", F.lit(0.0)).alias("moved"), F.lit(person).alias("is_person"))

    both = side(points.where(F.col("class_name") == PERSON), True).unionByName(side(points.where(~F.col("class_name").isin(*OBJECT_NOT)), False))
    return pr.contacts_by_frame(both, min_iou, max_gap, max(frame_w, frame_h), need_motion)


def segments(frames: DataFrame, pad: float = 0.05, gap: float = 0.02, end_of_video: float = 24.0) -> DataFrame:
    """Padded hits, as contact_frames() tells them, merged into segments: one row for each island of a video."""
    spans = frames.withColumns({"s": F.greatest(F.lit(0.0), F.col("ts_sec") - pad), "e": F.least(F.lit(end_of_video), F.col("ts_sec") + pad)})
    first = F.struct("s", "e", "first_person", "first_thing")
    all_of = lambda c: F.array_distinct(F.flatten(F.collect_list(c)))
    parts = {"start_sec": F.min("s"), "end_sec": F.max("e"), "start_frame": F.min("frame_index"), "end_frame": F.max("frame_index"), "hits": F.sum("hits"), "_people": all_of("people"), "_things": all_of("things"), "_first": F.min(first)}
    whole = {
        **{k: F.min(k) for k in ("start_sec", "start_frame")},
        **{k: F.max(k) for k in ("end_sec", "end_frame")},
        "hits": F.sum("hits"),
        "persons": F.size(all_of("_people")).cast("long"),
        "objects": F.array_join(F.array_sort(F.transform(all_of("_things"), lambda x: x.cast("string"))), ","),
        "first_person": F.min("_first")["first_person"],
    }
    return s.merged_islands(spans, ["video_id"], "s", "e", gap, ["frame_index"], s.STRETCH_SEC, parts, whole)


def split_even(spans: DataFrame, longest: float) -> DataFrame:
    """Spans longer than `longest` cut into equal parts; a longest of 0 or less cuts nothing."""
    total = F.col("end_sec") - F.col("start_sec")
    n = F.when((F.lit(longest) > 0) & (total > longest), F.ceil(total / longest)).otherwise(1).cast("int")
    cut = spans.withColumn("_n", n).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    step = total / F.col("_n")
    return cut.withColumns({"part_start": F.col("start_sec") + step * F.col("part"), "part_end": F.col("start_sec") + step * (F.col("part") + 1)}).drop("_n")


def steps(points: DataFrame) -> DataFrame:
    """Adds gap (frames), distance and rate against the previous point of the track."""
    w = Window.partitionBy(*TRACK).orderBy("frame_index")
    b = box_columns(points)
    dx, dy = F.col("cx") - F.lag("cx").over(w), F.col("cy") - F.lag("cy").over(w)
    b = b.withColumns({"gap": F.col("frame_index") - F.lag("frame_index").over(w), "distance": F.sqrt(dx * dx + dy * dy)})
    return b.withColumn("rate", F.col("distance") / F.col("gap"))


def trajectories(points: DataFrame) -> DataFrame:
    """Length, duration and mean speed of each track; no speed for one point or no time."""
    out = steps(points).groupBy(*TRACK).agg(F.count("*").alias("n_points"), F.sum("distance").alias("length"), (F.max("ts_sec") - F.min("ts_sec")).alias("duration"))
    return out.withColumn("speed", F.when((F.col("n_points") > 1) & (F.col("duration") > 0), F.col("length") / F.col("duration")))


def coverage(points: DataFrame) -> DataFrame:
    """Seen and predicted points, covered share of the span, and the upper median gap of each track."""
    out = steps(points).groupBy(*TRACK).agg(
        F.sum(F.when(F.col("conf") > 0, 1).otherwise(0)).alias("n_seen"),
        F.sum(F.when(F.col("conf") > 0, 0).otherwise(1)).alias("n_predicted"),
        (F.max("frame_index") - F.min("frame_index") + 1).alias("span"),
        F.countDistinct("frame_index").alias("frames"),
        F.array_sort(F.collect_list("gap")).alias("_gaps"),
    )
    middle = F.get("_gaps", F.floor(F.size("_gaps") / 2).cast("int"))
    return out.select(*TRACK, "n_seen", "n_predicted", "span", (100.0 * F.col("frames") / F.col("span")).alias("covered_pct"), middle.alias("median_gap"))


def gap_histogram(points: DataFrame) -> DataFrame:
    bucket = F.when(F.col("gap") <= 5, "1-5").when(F.col("gap") <= 10, "6-10").when(F.col("gap") <= 20, "11-20").otherwise(">20")
    return steps(points).where("gap is not null").groupBy("class_name", bucket.alias("bucket")).agg(F.count("*").alias("n"))


def shared_frames(points: DataFrame, same_class: bool = True) -> DataFrame:
    """Pairs of tracks seen in the same frames: how many, and their mean overlap."""
    keys = ["video_id", *(["class_name"] if same_class else [])]
    return pr.mean_overlaps(observed(points), keys).select("video_id", "track_id_a", "track_id_b", "shared", "mean_iou")


def always_inside(points: DataFrame, min_shared: int = 1) -> DataFrame:
    """Ordered pairs of tracks of which one lies in the other in every frame they share."""
    return pr.enclosed(observed(points), ["video_id"], max(1, min_shared)).drop("n_inside")


def best_container(points: DataFrame) -> DataFrame:
    """For each point seen the track that holds most of it, the least id on a tie."""
    return pr.containers(observed(points))


def pose_spread(points: DataFrame, outer_class: str = "dining table") -> DataFrame:
    """How steady objects lie in an outer class's box: mean and deviation of the relative pose, and a verdict."""
    name = outer_class.replace("'", "''")
    out = pr.pose_moments(observed(points), ["video_id"], f"class_name <> '{name}'", f"class_name = '{name}'")
    worst = F.greatest("dev_rx", "dev_ry")
    return out.withColumn("verdict", F.when(worst <= 0.05, "PRINT").when(worst <= 0.12, "LIKELY").otherwise("NOT"))


def still_ratio(iou_from: float, stride: float) -> float:
    """The shift, per frame, that still leaves an overlap of iou_from between boxes a stride apart."""
    return (1 - iou_from) / (1 + iou_from) / stride


def motion_changes(points: DataFrame, min_hits: int = 2, iou_from: float = 0.45, stride: float = 1.0) -> DataFrame:
    w = Window.partitionBy(*TRACK).orderBy("frame_index")
    p = observed(points).select(*TRACK, "frame_index", g.box().alias("b"))
    p = p.withColumns({"_b": F.lag("b").over(w), "_f": F.lag("frame_index").over(w)}).where("_b is not null")
    rate = g.displacement_ratio(F.col("_b"), F.col("b")) / (F.col("frame_index") - F.col("_f"))
    found = s.flips(p.withColumn("moves", rate > still_ratio(iou_from, stride)), TRACK, "frame_index", "moves", min_hits)
    return found.select("video_id", "track_id", "frame_index", F.when(F.col("moves"), "MOVE_START").otherwise("MOVE_STOP").alias("kind"))


def life_changes(points: DataFrame) -> DataFrame:
    ends = observed(points).groupBy(*TRACK).agg(F.min("frame_index").alias("APPEAR"), F.max("frame_index").alias("DISAPPEAR"))
    return ends.select(*TRACK, F.explode(F.array(*[F.struct(F.col(k).alias("frame_index"), F.lit(k).alias("kind")) for k in ("APPEAR", "DISAPPEAR")])).alias("c")).select(*TRACK, "c.frame_index", "c.kind")


def enclosure_changes(points: DataFrame, min_hits: int = 2) -> DataFrame:
    found = pr.inside_flips(observed(points), ["video_id"], min_hits)
    return found.select("video_id", F.col("inner_id").alias("track_id"), "outer_id", "frame_index", F.when(F.col("inside"), "ENCLOSE_START").otherwise("ENCLOSE_END").alias("kind"))


def change_points(points: DataFrame, exclude: tuple[str, ...] = (), min_hits: int = 2) -> DataFrame:
    """All changes of tracks whose class isn't excluded (in either case): (video_id, frame_index, kind, track_id)."""
    p = points.where(~F.lower("class_name").isin(*[c.lower() for c in exclude])) if exclude else points
    cols = ["video_id", "frame_index", "kind", "track_id"]
    return motion_changes(p, min_hits).select(*cols).unionByName(life_changes(p).select(*cols)).unionByName(enclosure_changes(p, min_hits).select(*cols))


def histogram(df: DataFrame, *by: str | Column) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("n"))


def compare_counts(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Counts by key in two runs, missing ones 0, and their difference."""
    left, right = a.groupBy(key).agg(F.count("*").alias("n_a")), b.groupBy(key).agg(F.count("*").alias("n_b"))
    both = left.join(right, key, "full").select(key, F.coalesce("n_a", F.lit(0)).cast("long").alias("n_a"), F.coalesce("n_b", F.lit(0)).cast("long").alias("n_b"))
    return both.withColumn("change", F.col("n_b") - F.col("n_a"))


def busiest(points: DataFrame) -> DataFrame:
    """The most tracks in one frame of each video."""
    return points.groupBy("video_id", "frame_index").agg(F.countDistinct("track_id").alias("n")).groupBy("video_id").agg(F.max("n").alias("max_tracks"))


def merge_points(points: DataFrame) -> DataFrame:
    """One point for each frame of a video and class: the most confident, then the least track."""
    best = Window.partitionBy("video_id", "class_name", "frame_index").orderBy(F.desc("conf"), "track_id")
    return points.withColumn("_nth", F.row_number().over(best)).where("_nth = 1").drop("_nth")


def nearest_change(boundaries: DataFrame, changes: DataFrame) -> DataFrame:
    """For each boundary (video_id, boundary) the nearest change frame of its video, the earlier on a tie.

    Both go into one ordered pass over the video; a boundary looks at the last change before it and the
    first after it, so no pairs are made.
    """
    rows = boundaries.select("video_id", F.col("boundary").alias("at"), F.lit(None).cast("long").alias("change")).unionByName(changes.select("video_id", F.col("frame_index").alias("at"), F.col("frame_index").alias("change")).distinct())
    w = Window.partitionBy("video_id").orderBy("at")
    low = F.last("change", ignorenulls=True).over(w.rangeBetween(Window.unboundedPreceding, 0))
    back = Window.partitionBy("video_id").orderBy(F.desc("at"))  # a frame that only grows is one pass
    high = F.last("change", ignorenulls=True).over(back.rangeBetween(Window.unboundedPreceding, 0))
    out = rows.withColumns({"_low": low, "_high": high}).where("change is null").distinct()
    nearer = F.when(F.col("_high").isNull() | (F.col("at") - F.col("_low") <= F.col("_high") - F.col("at")), F.col("_low")).otherwise(F.col("_high"))
    return out.select("video_id", F.col("at").alias("boundary"), nearer.alias("frame_index"), F.abs(nearer - F.col("at")).alias("off"))
