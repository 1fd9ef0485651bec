"""The tracker over a stream of detections, with its tracks as the state of each video."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from trackloom.operators.sequential import BOX, POINT_COLUMNS, TRACK, TRACK_SCHEMA, Follower, patience_of, together
from trackloom.sources.tables import shared_dir

#: What the stream gives: points of tracks, and detections that came too late, with det_id and without a track.
OUT_SCHEMA = TRACK_SCHEMA + ", det_id string, late boolean"
#: Keeping state by key and field needs this store; it is Spark's own.
STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


class Tracking(StatefulProcessor):
    """A video's live tracks, one entry each in a map, and a clock of its last frame and number of tracks."""

    def __init__(self, iou_from: float, patience: int, frame_w: float, frame_h: float, idle_ms: int | None) -> None:
        self.options, self.idle_ms = (iou_from, patience, frame_w, frame_h), idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.clock = handle.getValueState("clock", "last long, count long")
        self.tracks = handle.getMapState("tracks", "number long", "label string, hits long, misses long, place array<double>, speed array<double>, cov array<double>")

    def load(self) -> Follower:
        follower = Follower(*self.options)
        if self.clock.exists():
            follower.last, follower.count = self.clock.get()
        held = sorted((number, *rest) for (number,), rest in self.tracks.iterator())
        for k, column in zip(TRACK, zip(*held, strict=True), strict=False):
            shape, kind = TRACK[k]
            follower.live[k] = np.array([*column], kind).reshape(len(held), *shape)
        return follower

    def save(self, follower: Follower) -> None:
        live = follower.live
        alive = set(live["number"].tolist())
        for (number,) in list(self.tracks.keys()):
            if number not in alive:
                self.tracks.removeKey((number,))
        for number, *rest in zip(*[live[k].reshape(len(alive), -1).tolist() if live[k].ndim > 1 else live[k].tolist() for k in TRACK], strict=True):
            self.tracks.updateValue((number,), tuple(rest))
        self.clock.update((follower.last, follower.count))

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        follower, all_rows = self.load(), pd.concat(list(rows))
        late = all_rows[all_rows["frame_index"] <= follower.last] if follower.last is not None else all_rows.iloc[:0]
        fresh = all_rows.drop(late.index) if len(late) == 0 else all_rows[all_rows["frame_index"] > follower.last]
        if len(fresh):
            for done in together(follower.follow(fresh)):
                yield told(done[POINT_COLUMNS[:-1]], key[0], False)
            self.save(follower)
            if self.idle_ms is not None:
                for old in list(self.handle.listTimers()):
                    self.handle.deleteTimer(old)
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle_ms)
        if len(late):
            yield told(late[["class_name", "frame_index", *BOX, "conf", "det_id"]], key[0], True)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        """A video that has been silent for idle_ms has ended: its tracks go, its clock stays to tell late frames."""
        self.tracks.clear()
        yield from ()

    def close(self) -> None:
        pass


def told(rows: pd.DataFrame, video: int, late: bool) -> pd.DataFrame:
    """Rows with all columns of OUT_SCHEMA, in order."""
    names = [x.split()[0] for x in OUT_SCHEMA.split(", ")]
    out = rows.reindex(columns=names)
    out["video_id"], out["late"] = video, late
    out["track_id"], out["estimated"] = out["track_id"].astype("Int64"), out["estimated"].astype("boolean")
    out["det_id"] = out["det_id"].astype(object).where(out["det_id"].notna(), None)
    return out


def track_stream(detections: DataFrame, iou_from: float = 0.2, max_age: int = 15, frame_w: float = 1920.0, frame_h: float = 1080.0, stride: int = 1, max_missed: int = 2, idle_ms: int | None = None) -> DataFrame:
    """The points of sequential.track for a stream of detections, in append mode, and the detections that came too late.

    A video's live tracks are its state, a few numbers each. A batch's frames are followed in order, with the
    empty frames between them and since the last batch; tracks are numbered through the whole video. Rows of
    frames up to the last one done come too late: they are given back with `late`, so a sink can count and keep
    them, and change no track. With idle_ms, a timer drops the tracks of a video that has no rows for so long, and only
    its clock is kept; that is for streams that run on, since Spark runs batches for timers for ever and such a query
    never ends of itself. Needs the state store of STORE.
    """
    if iou_from <= 0:
        raise ValueError("an overlap of 0 would match everything with everything")
    processor = Tracking(iou_from, patience_of(max_age, stride, max_missed), frame_w, frame_h, idle_ms)
    return detections.groupBy("video_id").transformWithStateInPandas(processor, OUT_SCHEMA, "Append", "None" if idle_ms is None else "ProcessingTime")


def replay(parts: list[DataFrame], **options) -> DataFrame:
    """track_stream over tables that arrive one after the other, from a source that is stopped after each and resumed: all rows of OUT_SCHEMA."""
    spark = parts[0].sparkSession
    root = f"{shared_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    before = {k: spark.conf.get(k, None) for k in STORE}
    for k, v in STORE.items():
        spark.conf.set(k, v)
    try:
        for part in parts:
            part.write.mode("append").parquet(f"{root}/source")
            source = spark.readStream.schema(parts[0].schema).parquet(f"{root}/source")
            sink = track_stream(source, **options).writeStream.format("parquet").option("path", f"{root}/tracks").option("checkpointLocation", f"{root}/progress")
            sink.trigger(availableNow=True).outputMode("append").start().awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return spark.read.schema(OUT_SCHEMA).parquet(f"{root}/tracks")


def halves(detections: DataFrame, order: str) -> list[DataFrame]:
    """A table in two parts by its order column, or whole if it is empty."""
    middle = detections.agg(F.percentile_approx(order, 0.5)).first()[0]
    return [detections.where(F.col(order) <= middle), detections.where(F.col(order) > middle)] if middle is not None else [detections]
