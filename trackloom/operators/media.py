"""Frames, boxes and tracks: sampling plans, cleaning, folds over copies, windows of contacts, reports and diagnostics."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackloom.functions import geometry as g
from trackloom.functions import sequences as s
from trackloom.operators import pairs as pr
from trackloom.operators.sequential import assigned, stitch
from trackloom.operators.tracks import TRACK, box_columns, observed, split_even
from trackloom.sources.tables import stored


def fourcc(code: Column) -> Column:
    """A codec's four letters, the low byte first."""
    return F.concat(*[F.chr(F.shiftright(code, 8 * i).bitwiseAND(255)) for i in range(4)])


def frame_count(frames: Column, duration: Column, fps: Column) -> Column:
    """The number of frames, from the duration where the container doesn't tell."""
    return F.when(F.coalesce(frames, F.lit(0)) > 0, frames).otherwise(F.floor(duration * fps)).cast("long")


def every_nth(frames: Column, n: Column, cap: Column) -> Column:
    """array<long>: frames 0, n, 2n, ..., the first `cap` of them."""
    none = F.array().cast("array<bigint>")
    return F.when(frames > 0, F.slice(F.sequence(F.lit(0).cast("long"), frames - 1, n), F.lit(1), cap)).otherwise(none)


def by_rate(frames: Column, fps: Column, target: Column, cap: Column) -> Column:
    """array<long>: frames at a target rate, never faster than the video: places are added up step by step and rounded half to even, each frame once, at most `cap`."""
    step = fps / F.least(target, fps)
    zero = F.struct(F.lit(0.0).alias("at"), F.array().cast("array<bigint>").alias("out"))

    def take(acc: Column, _: Column) -> Column:
        frame = F.least(F.greatest(F.bround(acc["at"], 0).cast("long"), F.lit(0).cast("long")), frames - 1)
        fresh = (acc["at"] < frames) & (F.size(acc["out"]) < cap) & ~F.coalesce(F.get(acc["out"], F.size(acc["out"]) - 1) == frame, F.lit(False))
        return F.struct((acc["at"] + step).alias("at"), F.when(fresh, F.array_append(acc["out"], frame)).otherwise(acc["out"]).alias("out"))

    turns = F.sequence(F.lit(1).cast("long"), F.greatest(F.lit(1).cast("long"), F.least(F.ceil(frames / step) + 1, cap * 2 + 2).cast("long")))
    return F.when(frames > 0, F.aggregate(turns, zero, take, lambda acc: acc["out"])).otherwise(F.array().cast("array<bigint>"))


def every_frame(frames: DataFrame, n_frames: DataFrame) -> DataFrame:
    """The rows of frames (video_id, frame_index, ...), and an empty one for each frame below n_frames (video_id, n_frames) that has none."""
    whole = n_frames.where("n_frames > 0").select("video_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_frames").cast("long") - 1)).alias("frame_index"))
    return whole.join(frames, ["video_id", "frame_index"], "left")


def of_good_frames(detections: DataFrame, frames: DataFrame) -> DataFrame:
    """The detections of frames (video_id, frame_index, status) that were decoded."""
    return detections.join(frames.where("status = 'OK'").select("video_id", "frame_index").distinct(), ["video_id", "frame_index"], "left_semi")


def from_centre(cx: Column, cy: Column, w: Column, h: Column, frame_w: float, frame_h: float) -> Column:
    """A box in pixels from a centre and size in parts of the frame."""
    return F.struct(*[(e * side).alias(k) for k, e, side in (("x1", cx - w / 2, frame_w), ("y1", cy - h / 2, frame_h), ("x2", cx + w / 2, frame_w), ("y2", cy + h / 2, frame_h))])


def clean_boxes(detections: DataFrame, frame_w: float, frame_h: float, decoys: tuple[str, ...] = (), allowed: tuple[str, ...] | None = None) -> DataFrame:
    """Detections within the frame: boxes clamped, those left without area dropped, as are empty labels, decoys and, with a list of allowed classes, all others."""
    rows = detections.where((F.coalesce("class_name", F.lit("")) != "") & ~F.lower("class_name").isin(*[d.lower() for d in decoys]) if decoys else F.coalesce("class_name", F.lit("")) != "")
    if allowed is not None:
        rows = rows.where(F.lower("class_name").isin(*[a.lower() for a in allowed]))
    rows = rows.withColumn("_b", g.clamped(g.box(), frame_w, frame_h)).withColumns({c: F.col(f"_b.{c}") for c in ("x1", "y1", "x2", "y2")})
    return rows.drop("_b").where("x2 > x1 and y2 > y1")


def folded(frame: Column, period: Column | None) -> Column:
    """A frame's place in the clip that a video repeats."""
    return frame if period is None else F.pmod(frame, period)


def bucket_means(points: DataFrame, subject: str, container: str, fps: float, bucket_sec: float, period: int | None = None) -> DataFrame:
    """(video_id, bucket, n, mean_conf, mean_part): real detections of a class by time in the clip, and how much of them the best container on their frame holds."""
    real = observed(points).select("video_id", "frame_index", "track_id", "class_name", "conf", g.box().alias("b"))
    own = real.where(F.col("class_name") == subject)
    held = own.join(real.where(F.col("class_name") == container).select("video_id", "frame_index", F.col("b").alias("ob")), ["video_id", "frame_index"], "left")
    best = held.groupBy("video_id", "frame_index", "track_id").agg(F.first("conf").alias("conf"), F.coalesce(F.max(F.when(F.col("ob").isNotNull(), g.containment(F.col("b"), F.col("ob")))), F.lit(0.0)).alias("part"))
    bucket = F.floor(folded(F.col("frame_index"), F.lit(period) if period else None) / fps / bucket_sec).cast("long")
    return best.groupBy("video_id", bucket.alias("bucket")).agg(F.count("*").alias("n"), F.avg("conf").alias("mean_conf"), F.avg("part").alias("mean_part"))


def crops(points: DataFrame, class_name: str, fps: float, start: float, end: float, period: int | None = None) -> DataFrame:
    """Real detections of a class whose second in the clip lies in [start, end), with whole-pixel boxes."""
    sec = folded(F.col("frame_index"), F.lit(period) if period else None) / fps
    rows = observed(points).where((F.col("class_name") == class_name) & (sec >= start) & (sec < end))
    return rows.select("video_id", "frame_index", "track_id", "conf", *[F.bround(F.col(c), 0).cast("long").alias(c) for c in ("x1", "y1", "x2", "y2")])


def thinned(rows: DataFrame, most: int) -> DataFrame:
    """At most `most` rows of each video, one a frame (the least track), at an even stride over its frames; all rows of a video that has no more."""
    sums = rows.groupBy("video_id").agg(F.count("*").alias("_all"), F.countDistinct("frame_index").alias("_frames"))
    w = Window.partitionBy("video_id")
    nth = F.dense_rank().over(w.orderBy("frame_index")) - 1
    first = F.row_number().over(Window.partitionBy("video_id", "frame_index").orderBy("track_id"))
    r = rows.join(sums, "video_id").withColumns({"_nth": nth, "_first": first})
    step = F.col("_frames") / most
    # Frame k is taken if int(i * step) is k for some i, that is if a multiple of step lies in [k, k + 1).
    i = F.ceil(F.col("_nth") / step)
    taken = F.exists(F.sequence(F.greatest(i - 1, F.lit(0)), i + 1), lambda j: (F.floor(j * step) == F.col("_nth")) & (j < most))
    return r.where((F.col("_all") <= most) | (taken & (F.col("_first") == 1))).drop("_all", "_frames", "_nth", "_first")


def trajectory_points(points: DataFrame) -> DataFrame:
    """A track's points as a trajectory: ids, order, centre and confidence; nothing is filled in."""
    nth = F.row_number().over(Window.partitionBy(*TRACK).orderBy("frame_index"))
    return box_columns(points).select("video_id", F.concat(F.lit("traj_"), "track_id").alias("trajectory_id"), "track_id", nth.cast("long").alias("nth"), "frame_index", "ts_sec", "cx", "cy", "conf")


def solo_hits(points: DataFrame, hits: DataFrame, threshold: float = 0.05, frame_h: float = 1080.0) -> DataFrame:
    """(video_id, frame_index, ts_sec, person_id, moved): people far from where their track began, in videos without any contact."""
    p = points.where("class_name = 'person'").join(hits.select("video_id").distinct(), "video_id", "left_anti")
    w = Window.partitionBy(*TRACK).orderBy("frame_index").rowsBetween(Window.unboundedPreceding, 0)
    c = box_columns(p).withColumns({"_x": F.first("cx").over(w), "_y": F.first("cy").over(w), "_f": F.first("frame_index").over(w)})
    dx, dy = F.col("cx") - F.col("_x"), F.col("cy") - F.col("_y")
    c = c.withColumn("moved", F.sqrt(dx * dx + dy * dy) / frame_h)
    return c.where((F.col("_f") < F.col("frame_index")) & (F.col("moved") > threshold)).select("video_id", "frame_index", "ts_sec", F.col("track_id").alias("person_id"), "moved")


def contact_windows(frames: DataFrame, longest: float, pad: float = 0.05, gap: float = 0.02, end_of_video: float = 24.0) -> DataFrame:
    """Segments of contacts, as contact_frames() tells them, cut into windows: (video_id, island, part, start_sec, end_sec, trigger, start_frame, end_frame, n_hits, track_ids).

    A window has the hits inside it, both ends included, so one on a cut is in two windows; a window without any has those
    of its segment. trigger is the kind of the segment's first hit. Frames are written once, and windows meet their times alone.
    """
    spans = frames.withColumns({"s": F.greatest(F.lit(0.0), F.col("ts_sec") - pad), "e": F.least(F.lit(end_of_video), F.col("ts_sec") + pad)})
    kept = stored(spans, "contact_frames")
    marked = s.islands(kept, ["video_id"], "s", "e", gap, ["frame_index"], s.STRETCH_SEC).withColumn("island", F.col("island").cast("long"))
    ids = F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.array_union("people", "things")))))
    told = [F.min("frame_index").alias("start_frame"), F.max("frame_index").alias("end_frame"), F.sum("hits").alias("n_hits"), ids.alias("track_ids")]
    whole = marked.groupBy("video_id", "island").agg(F.min("s").alias("start_sec"), F.max("e").alias("end_sec"), F.min_by("first_kind", F.struct("s", "e", "first_person", "first_thing")).alias("trigger"))
    key = ["video_id", "island", "part"]
    windows = split_even(whole, longest).select(*key, "part_start", "part_end", "trigger")
    times = marked.select("video_id", "island", "frame_index", "ts_sec")
    inside = windows.select(*key, "part_start", "part_end").join(times, ["video_id", "island"]).where(F.col("ts_sec").between(F.col("part_start"), F.col("part_end"))).select(*key, "frame_index", "ts_sec")
    own = inside.join(kept.select("video_id", "frame_index", "ts_sec", "hits", "people", "things"), ["video_id", "frame_index", "ts_sec"]).groupBy(*key).agg(*told)
    without = windows.join(inside.select(*key).distinct(), key, "left_anti").join(marked.groupBy("video_id", "island").agg(*told), ["video_id", "island"])
    both = windows.join(own, key).unionByName(without)
    return both.withColumnsRenamed({"part_start": "start_sec", "part_end": "end_sec"})


def points_in(windows: DataFrame, points: DataFrame) -> DataFrame:
    """(video_id, island, part, track_id, n_points): the tracks that each window names, with all their points counted."""
    n = points.groupBy(*TRACK).agg(F.count("*").alias("n_points"))
    return windows.select("video_id", "island", "part", F.explode("track_ids").alias("track_id")).join(n, TRACK)


def track_report(points: DataFrame, long_from: int = 100) -> DataFrame:
    """(video_id, track_id, duration, is_long, whole_video, n_negative, n_flat): long tracks, those as long as the video, and suspicious boxes."""
    flags = points.groupBy(*TRACK).agg(
        F.min("frame_index").alias("_a"),
        F.max("frame_index").alias("_b"),
        F.sum(F.when((F.col("x1") < 0) | (F.col("y1") < 0), 1).otherwise(0)).alias("n_negative"),
        F.sum(F.when((F.col("x2") <= F.col("x1")) | (F.col("y2") <= F.col("y1")), 1).otherwise(0)).alias("n_flat"),
    )
    ends = points.groupBy("video_id").agg((F.max("frame_index") - F.min("frame_index") + 1).alias("_video"))
    r = flags.withColumn("duration", F.col("_b") - F.col("_a") + 1).join(ends, "video_id")
    return r.select(*TRACK, "duration", (F.col("duration") > long_from).alias("is_long"), (F.col("duration") == F.col("_video")).alias("whole_video"), "n_negative", "n_flat")


def fragmentation(points: DataFrame) -> DataFrame:
    """(class_name, n_tracks, n_detections, ratio) for each class and, with a null class, for all: tracks for each real detection."""
    sums = observed(points).rollup("class_name").agg(F.countDistinct("video_id", "track_id").alias("n_tracks"), F.count("*").alias("n_detections"))
    return sums.withColumn("ratio", F.col("n_tracks") / F.col("n_detections"))


def run_summary(counts: dict[str, DataFrame]) -> DataFrame:
    """(video_id, table, n) for each table of a run; a video without rows in a table has 0 there."""
    parts = [df.groupBy("video_id").agg(F.count("*").alias("n")).withColumn("table", F.lit(name)) for name, df in counts.items()]
    rows = parts[0]
    for more in parts[1:]:
        rows = rows.unionByName(more)
    return rows.groupBy("video_id").pivot("table", list(counts)).agg(F.sum("n")).select("video_id", *[F.coalesce(name, F.lit(0)).cast("long").alias(name) for name in counts])


def gated(stages: DataFrame) -> DataFrame:
    """Adds status to stages (stage, stub, enabled, upstream): SKIPPED where switched off or without anything to do, ERROR where what comes before is missing (null), else OK."""
    status = F.when(F.col("stub") | ~F.col("enabled"), "SKIPPED").when(F.col("upstream").isNull(), "ERROR").when(F.col("upstream") == 0, "SKIPPED").otherwise("OK")
    return stages.withColumn("status", status)


def overall(statuses: DataFrame, key: str) -> DataFrame:
    """(key, overall) of stage statuses: FAIL, PARTIAL, SKIPPED or PASS; no stages at all count as skipped."""
    n = lambda v: F.sum(F.when(F.col("status") == v, 1).otherwise(0))
    sums = statuses.groupBy(key).agg(n("ERROR").alias("e"), n("WARNING").alias("w"), n("SKIPPED").alias("s"), n("OK").alias("o"), F.count("status").alias("all"))
    verdict = F.when(F.col("e") > 0, "FAIL").when((F.col("s") > 0) & (F.col("o") + F.col("w") > 0), "PARTIAL").when((F.col("w") > 0) & (F.col("s") == 0), "PARTIAL").when(F.col("s") == F.col("all"), "SKIPPED").otherwise("PASS")
    return sums.select(key, verdict.alias("overall"))


def covered_fraction(changes: DataFrame, durations: DataFrame, tolerance: float) -> DataFrame:
    """(video_id, fraction): the part of each video that lies within the tolerance of some change. changes: (video_id, sec), durations: (video_id, duration)."""
    spans = changes.join(durations, "video_id").select("video_id", "duration", F.greatest(F.lit(0.0), F.col("sec") - tolerance).alias("a"), F.least(F.col("duration"), F.col("sec") + tolerance).alias("b")).where("b > a")
    ends = {"duration": F.first("duration"), "a": F.min("a"), "b": F.max("b")}
    each = s.merged_islands(spans, ["video_id"], "a", "b", 0.0, [], s.STRETCH_SEC, ends, ends).withColumn("n", F.col("b") - F.col("a"))
    sums = each.groupBy("video_id").agg((F.sum("n") / F.first("duration")).alias("fraction"))
    return durations.where("duration > 0").select("video_id").join(sums, "video_id", "left").select("video_id", F.coalesce("fraction", F.lit(0.0)).alias("fraction"))


def grid(duration: Column, n: Column) -> Column:
    """n times spread evenly from 0 to the duration; only 0 for a single one."""
    return F.when(n > 1, F.transform(F.sequence(F.lit(0).cast("long"), F.greatest(n.cast("long") - 1, F.lit(1).cast("long"))), lambda i: duration * i / (n - 1))).otherwise(F.array(F.lit(0.0)))


def onsets(points: DataFrame, inner: str, outer: str, same_from: float = 0.9) -> DataFrame:
    """(video_id, outer_id, frame_index, inner_id): where an object is first wholly inside an outer one after it was outside; boxes of almost its size are the outer one again and don't count."""
    rows = _beside(points, inner, outer).where(F.col("ratio") <= same_from)
    w = Window.partitionBy("video_id", "outer_id").orderBy("frame_index", "inner_id")
    flips = rows.withColumn("_before", F.lag("inside").over(w)).where(F.col("inside") & ~F.col("_before"))
    return flips.groupBy("video_id", "outer_id").agg(F.min(F.struct("frame_index", "inner_id")).alias("f")).select("video_id", "outer_id", "f.frame_index", "f.inner_id")


def _beside(points: DataFrame, inner: str, outer: str) -> DataFrame:
    p = observed(points).select("video_id", "frame_index", "track_id", "class_name", g.box().alias("b"))
    a = p.where(F.col("class_name") == inner).select("video_id", "frame_index", F.col("track_id").alias("inner_id"), F.col("b").alias("ib"))
    b = p.where(F.col("class_name") == outer).select("video_id", "frame_index", F.col("track_id").alias("outer_id"), F.col("b").alias("ob"))
    ib, ob = F.col("ib"), F.col("ob")
    both = a.join(b, ["video_id", "frame_index"])
    return both.select("video_id", "frame_index", "inner_id", "outer_id", g.iou(ib, ob).alias("iou"), (g.area(ib) / g.area(ob)).alias("ratio"), (F.abs(g.intersection(ib, ob) - g.area(ib)) < 1e-6).alias("inside"))


def inside_verdicts(points: DataFrame, inner: str, outer: str) -> DataFrame:
    """(video_id, frame_index, inner_id, outer_id, iou, ratio, verdict) of two classes on shared frames: SAME PIXELS, contained or separate."""
    verdict = F.when((F.col("ratio") > 0.9) & (F.col("iou") > 0.5), "SAME PIXELS").when(F.col("inside"), "contained").otherwise("separate")
    return _beside(points, inner, outer).withColumn("verdict", verdict).drop("inside")


def seams(points: DataFrame, diagonal: float = 2202.9) -> DataFrame:
    """Each fragment beside the next of its class, by start: how long nothing was seen, the gap of the spans, overlap and distance of the last and first real boxes, overlap of the outermost points, and shared frames."""
    real = F.when(F.col("conf") > 0, F.col("frame_index"))
    b = g.box()
    parts = points.groupBy("video_id", "class_name", "track_id").agg(
        F.min("frame_index").alias("start"), F.max("frame_index").alias("end"), F.min(real).alias("first"), F.max(real).alias("last"), F.min_by(b, real).alias("first_box"), F.max_by(b, real).alias("last_box"), F.min_by(b, "frame_index").alias("head"), F.max_by(b, "frame_index").alias("tail")
    )
    w = Window.partitionBy("video_id", "class_name").orderBy("start", "track_id")
    prior = {f"_{c}": F.lag(c).over(w) for c in ("track_id", "end", "last", "last_box", "tail")}
    pairs = parts.withColumns(prior).where("_track_id is not null and _last is not null and first is not null")
    seen = observed(points).select("video_id", "frame_index", "track_id", b.alias("_box"))
    end = lambda name: seen.select("video_id", "frame_index", F.col("track_id").alias(name), F.col("_box").alias(f"{name}_box"))
    met = pairs.select("video_id", "_track_id", "track_id").join(end("_track_id"), ["video_id", "_track_id"]).join(end("track_id"), ["video_id", "track_id", "frame_index"])
    shared = met.groupBy("video_id", "_track_id", "track_id").agg(F.count("*").alias("shared"), F.avg(g.iou(F.col("_track_id_box"), F.col("track_id_box"))).alias("mean_iou"))
    pairs = pairs.join(shared, ["video_id", "_track_id", "track_id"], "left")
    return pairs.select(
        "video_id",
        "class_name",
        F.col("_track_id").alias("before_id"),
        F.col("track_id").alias("after_id"),
        (F.col("first") - F.col("_last")).alias("blind"),
        (F.col("start") - F.col("_end")).alias("span"),
        g.iou(F.col("_last_box"), F.col("first_box")).alias("real_iou"),
        (g.centre_distance(F.col("_last_box"), F.col("first_box")) / diagonal).alias("real_distance"),
        g.iou(F.col("_tail"), F.col("head")).alias("ghost_iou"),
        F.coalesce("shared", F.lit(0)).cast("long").alias("shared"),
        F.coalesce("mean_iou", F.lit(0.0)).alias("shared_iou"),
    )


def seam_outcomes(points: DataFrame, diagonal: float = 2202.9, **options) -> DataFrame:
    """seams() with what stitching made of each: the entity of the later fragment, and whether both are of it (merged)."""
    own = stitch(points, diagonal=diagonal, **options).select("video_id", "track_id", "entity_id")
    side = lambda name: own.select("video_id", F.col("track_id").alias(f"{name}_id"), F.col("entity_id").alias(f"_{name}"))
    both = seams(points, diagonal).join(side("before"), ["video_id", "before_id"]).join(side("after"), ["video_id", "after_id"])
    return both.withColumn("merged", F.col("_before") == F.col("_after")).withColumnRenamed("_after", "entity_id").drop("_before")


#: Vectors in a block of offsets(); a side is broadcast up to so many bytes.
BLOCK, BROADCAST_BYTES = 64, 16 << 20


def offsets(short: DataFrame, long: DataFrame) -> DataFrame:
    """(offset, score): the mean absolute difference of two sequences of vectors (pos, vector) for every place of the short one that lies wholly in the long one.

    Both are cut into blocks of consecutive vectors. A pair of blocks gives, for each diagonal, the sum of its
    differences; these are summed over pairs by offset, in the tasks first. Only blocks move: the short side to all
    tasks if its bytes, counted before, are few, else each pair's blocks meet by their numbers.
    """
    told = short.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("size"), F.max("pos").alias("last")).first()
    n_short, n_long = told["n"], long.count()

    def blocks(df: DataFrame, name: str) -> DataFrame:
        held = F.array_sort(F.collect_list(F.struct("pos", F.col("vector").cast("array<double>").alias("v"))))
        rows = df.groupBy(F.floor(F.col("pos") / BLOCK).alias(name)).agg(held.alias("_held"))
        return rows.select(name, F.transform("_held", lambda x: x["pos"]).alias(f"{name}_pos"), F.flatten(F.transform("_held", lambda x: x["v"])).alias(f"{name}_values"))

    few = n_short * 8 * max(1, told["size"] or 0) <= BROADCAST_BYTES
    shorts = blocks(short, "s")
    numbers = F.sequence(F.lit(0).cast("long"), F.lit((told["last"] or 0) // BLOCK).cast("long"))
    pairs = blocks(long, "l").withColumn("s", F.explode(numbers)).join(F.broadcast(shorts) if few else shorts, "s")

    def diagonals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                at_l, at_s = np.array(row["l_pos"], np.int64), np.array(row["s_pos"], np.int64)
                x, y = np.array(row["l_values"]).reshape(len(at_l), -1), np.array(row["s_values"]).reshape(len(at_s), -1)
                gaps = np.abs(x[:, None] - y[None]).sum(axis=2).ravel()
                where = (at_l[:, None] - at_s[None]).ravel()
                inside = (where >= 0) & (where <= n_long - n_short)
                found, which = np.unique(where[inside], return_inverse=True)
                sums, n = np.bincount(which, gaps[inside], len(found)), np.bincount(which, minlength=len(found)) * x.shape[1]
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(sums), pa.array(n)], ["offset", "gap", "n"])

    sums = pairs.select("l_pos", "l_values", "s_pos", "s_values").mapInArrow(diagonals, "offset long, gap double, n long")
    return sums.groupBy("offset").agg((F.sum("gap") / F.sum("n")).alias("score"))


def best_offsets(scores: DataFrame, apart: int, top: int = 5) -> DataFrame:
    """(rank, offset, score, ambiguous): the best offsets at least `apart` from each other, a report of `top` rows; ambiguous if the second is within twice the best.

    An offset shuts out fewer than two times `apart` others, so the best of the list are among so many for each row of the report.
    """
    found: list[tuple[int, float]] = []
    for r in scores.orderBy("score", "offset").limit(max(1, 2 * apart) * top).collect():
        if len(found) < top and all(abs(r["offset"] - at) >= apart for at, _ in found):
            found.append((r["offset"], r["score"]))
    unclear = len(found) > 1 and found[1][1] < 2 * found[0][1]
    return scores.sparkSession.createDataFrame([(i + 1, o, sc, unclear) for i, (o, sc) in enumerate(found)], "rank long, offset long, score double, ambiguous boolean")


def longest_runs(events: DataFrame) -> DataFrame:
    """(video_id, action, object_id, longest): the most events in a row, by time, of one action on one object."""
    order = Window.partitionBy("video_id").orderBy("start_sec", "observation_id", "clause")
    same = (F.lag("action").over(order) == F.col("action")) & F.lag("object_id").over(order).eqNullSafe(F.col("object_id"))
    numbered = events.withColumn("_new", F.when(F.coalesce(same, F.lit(False)), 0).otherwise(1)).withColumn("_run", F.sum("_new").over(order))
    runs = numbered.groupBy("video_id", "action", "object_id", "_run").agg(F.count("*").alias("_n"))
    return runs.groupBy("video_id", "action", "object_id").agg(F.max("_n").alias("longest"))


def change_point_scores(changes: DataFrame, bounds: DataFrame, durations: DataFrame, tolerance: float) -> DataFrame:
    """(video_id, n_bounds, n_hit, n_points, n_spurious, fraction, vacuous): how many labelled bounds have a change near, and how many changes no bound.

    changes: (video_id, sec), bounds: (video_id, at). Looking for the nearest is one ordered pass over a video's bounds
    and changes. vacuous: the changes are so dense that any bounds would do.
    """
    rows = bounds.select("video_id", "at", F.lit("bound").alias("kind")).unionByName(changes.select("video_id", F.col("sec").alias("at"), F.lit("change").alias("kind")))
    w, back = Window.partitionBy("video_id").orderBy("at"), Window.partitionBy("video_id").orderBy(F.desc("at"))

    def nearest(kind: str) -> Column:
        other = F.when(F.col("kind") == kind, F.col("at"))
        low, high = (F.last(other, ignorenulls=True).over(x.rangeBetween(Window.unboundedPreceding, 0)) for x in (w, back))
        return F.least(F.col("at") - low, high - F.col("at"))

    r = rows.withColumns({"_change": nearest("change"), "_bound": nearest("bound")})
    n = lambda c: F.sum(F.when(c, 1).otherwise(0))
    is_bound = F.col("kind") == "bound"
    sums = r.groupBy("video_id").agg(n(is_bound).alias("n_bounds"), n(is_bound & (F.col("_change") <= tolerance)).alias("n_hit"), n(~is_bound).alias("n_points"), n(~is_bound & (F.col("_bound") > tolerance)).alias("n_spurious"))
    return sums.join(covered_fraction(changes, durations, tolerance), "video_id", "left").withColumn("vacuous", F.col("fraction") >= 1.0)


def ordered_scores(changes: DataFrame, bounds: DataFrame, durations: DataFrame, tolerance: float) -> DataFrame:
    """(video_id, n_bounds, n_ordered, n_inner, n_inner_hit, n_grid_hit, grid_as_good): bounds that have a change point of their own near, in order.

    The first and last bound of a video are its edges, which any track reaches, so inner ones are counted apart.
    As a control as many times, spread evenly from 0 to the duration, take the place of the changes. All
    counts of hits are null if there are fewer changes than bounds.
    """
    hit = (F.abs(F.col("point") - F.col("at")) <= tolerance).cast("long")
    inner = (F.col("nth") > 0) & (F.col("nth") < F.col("n") - 1)
    own = assigned(changes, bounds).groupBy("video_id").agg(F.count("*").alias("n_bounds"), F.sum(hit).alias("n_ordered"), F.sum(inner.cast("long")).alias("n_inner"), F.when(F.count("point") > 0, F.coalesce(F.sum(F.when(inner, hit)), F.lit(0))).alias("n_inner_hit"))
    sums = changes.groupBy("video_id").agg(F.count("sec").alias("_n")).join(durations, "video_id")
    even = sums.where("duration > 0").select("video_id", F.explode(grid(F.col("duration"), F.col("_n"))).alias("sec"))
    other = assigned(even, bounds.join(sums.where("duration > 0").select("video_id"), "video_id", "left_semi")).groupBy("video_id").agg(F.sum(hit).alias("n_grid_hit"))
    return own.join(other, "video_id", "left").withColumn("grid_as_good", F.col("n_grid_hit") >= F.col("n_ordered"))


def enclosed_share(points: DataFrame) -> DataFrame:
    """(video_id, inner_id, outer_id, shared, n_inside): on how many of their shared frames one track lies in another."""
    return pr.enclosed(observed(points), ["video_id"])
