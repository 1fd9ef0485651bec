"""Tables in the shared folder, nested exports and tolerant readers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Keys under which a wrapped file may hold its rows, the first that is there counts.
WRAPPERS = ("scores", "nodes", "events", "transitions", "segments", "observations", "tracks", "items")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or in a local session a temporary one."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="trackloom-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    return named


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet in the shared folder and read back; for what several plans read."""
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt evenly to four tasks a core, before costly expressions: files may be small or few, and tasks over slim rows are merged by their bytes."""
    return df.repartition(4 * df.sparkSession.sparkContext.defaultParallelism)


def write_rows(df: DataFrame, path: str, form: str = "json", by: str | None = "video_id") -> None:
    """A table as JSON lines or Parquet, one folder for each video."""
    out = df.write.mode("errorifexists").format(form)
    (out.partitionBy(by) if by else out).save(path)


def rows_of(parsed: Column) -> Column:
    """array<variant>: the objects of a file parsed as a variant, a bare list or one wrapped under a known key; null if it is missing, broken or something else."""
    listed = [F.try_variant_get(parsed, path, "array<variant>") for path in ("$", *[f"$.{k}" for k in WRAPPERS])]
    return F.filter(F.coalesce(*listed), lambda x: F.schema_of_variant(x).startswith("OBJECT"))


def flattened(files: DataFrame, text: str, schema: str) -> DataFrame:
    """The rows of files with a text column, one for each object in it, with the fields of a DDL schema; files without rows give none.

    A text is parsed once. A field that is absent or does not fit its type is null.
    """
    rest = [c for c in files.columns if c != text]
    parsed = files.select(*rest, F.try_parse_json(F.col(text)).alias("_file"))
    rows = parsed.select(*rest, F.explode(rows_of(F.col("_file"))).alias("_row"))
    return rows.select(*rest, *[F.try_variant_get("_row", f"$.{f.name}", f.dataType.simpleString()).alias(f.name) for f in T.StructType.fromDDL(schema).fields])


def tracks_text(points: DataFrame) -> DataFrame:
    """(video_id, track_id, class_name, n_points, text): each track's real points as a JSON list, by frame. A track's points are one array."""
    real = F.when(F.col("conf") > 0, F.struct("frame_index", "x1", "y1", "x2", "y2", "conf"))
    made = points.groupBy("video_id", "track_id", "class_name").agg(F.count("*").alias("n_points"), F.array_sort(F.collect_list(real)).alias("real"))
    return made.select("video_id", "track_id", "class_name", "n_points", F.to_json("real").alias("text"))


def observed_boxes(tracks: DataFrame, text: str = "text") -> DataFrame:
    """(video_id, track_id, class_name, frame_index, x1..y2, conf): the real points of tracks with their points as text."""
    found = flattened(tracks.select("video_id", "track_id", "class_name", F.col(text).alias("text")), "text", "frame_index long, x1 double, y1 double, x2 double, y2 double, conf double")
    return found.where("conf > 0")


def last_split(*splits: DataFrame, key: str) -> DataFrame:
    """The rows of all splits by key, a later split's in place of an earlier one's; in one split the row that is largest in order of its columns."""
    rows = None
    for i, split in enumerate(splits):
        part = split.withColumn("_split", F.lit(i))
        rows = part if rows is None else rows.unionByName(part)
    cols = [c for c in rows.columns if c not in (key, "_split")]
    best = rows.groupBy(key).agg(F.max(F.struct("_split", *cols)).alias("_best"))
    return best.select(key, *[F.col(f"_best.{c}") for c in cols])


def first_answers(answers: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, status, row, error): of a model's answers (keys, attempt, rows array<string>) the first with rows, one row for each; a single FAILED row for keys without any."""
    best = answers.groupBy(*keys).agg(F.min_by("rows", F.when(F.size("rows") > 0, F.col("attempt"))).alias("rows"), F.count("*").alias("_n"))
    good = best.where("size(rows) > 0").select(*keys, F.lit("SUCCESS").alias("status"), F.explode("rows").alias("row"), F.lit(None).cast("string").alias("error"))
    bad = best.where("rows is null or size(rows) <= 0").select(*keys, F.lit("FAILED").alias("status"), F.lit(None).cast("string").alias("row"), F.concat(F.lit("no rows in "), "_n", F.lit(" answers")).alias("error"))
    return good.unionByName(bad)
