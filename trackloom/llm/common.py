"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: Rows in one Arrow batch; texts may be long, so batches stay far below Spark's default of 10,000 rows.
ARROW_ROWS = 512
#: A side of a join is broadcast up to so many bytes, counted before; beyond them Spark shuffles both sides.
BROADCAST_BYTES = 16 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or in a local session a temporary one.

    A cluster names it; only where the setting is absent (tests, a laptop) one is set here.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = _local_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    return named


def _local_dir(spark: SparkSession) -> str:
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    current = spark.sparkContext.getCheckpointDir()
    return current or tempfile.mkdtemp(prefix="trackloom-")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Cuts the lineage with a reliable checkpoint in the shared folder, which survives lost executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str, compression: str = "snappy", keep: bool = False) -> DataFrame:
    """Writes df as Parquet in the shared folder and reads it back; for what is read more than once.

    The table goes with the room() that it is written in, unless keep says that the result reads it.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    if _ROOMS and not keep:
        _ROOMS[-1].append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_ROOMS: list[list[str]] = []


@contextmanager
def room(spark: SparkSession) -> Iterator[list[str]]:
    """Tables that stored() writes inside, and paths that the caller adds, go when the block ends.

    What leaves the block must not read them any more: a stage's result is written, with keep, before its end.
    """
    _ROOMS.append([])
    try:
        yield _ROOMS[-1]
    finally:
        for path in _ROOMS.pop():
            discard(spark, path)


def discard(spark: SparkSession, path: str) -> None:
    """Removes a path that nothing reads any more, in whatever store it lies."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row takes in memory."""
    total = F.lit(24)
    for c, t in df.dtypes:
        size = F.octet_length(F.col(c)) if t in ("string", "binary") else F.size(c) * 16 if t.startswith("array") else F.lit(0)
        total = total + 8 + F.coalesce(size, F.lit(0))
    return total.cast("long")


def small(df: DataFrame) -> DataFrame:
    """df, checkpointed, with a broadcast hint if it takes at most BROADCAST_BYTES."""
    df = cut(df)
    size = df.agg(F.sum(row_bytes(df))).first()[0]
    return F.broadcast(df) if (size or 0) <= BROADCAST_BYTES else df


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is worked out once, however often body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, other letters as they are. The cheaper lower() serves texts of one byte a character."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def packed(df: DataFrame, text: str = "text") -> DataFrame:
    """(row, body): the whole row in one struct, so that no working column clashes with the input's, and its text, null as ''."""
    cols = [F.col(f"`{c}`") for c in df.columns]
    return df.select(F.struct(*cols).alias("row"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("body"))


def text_key(text: Column) -> Column:
    """128 bits that stand for a text."""
    return F.unhex(F.md5(text))


def map_texts(df: DataFrame, column: str, added: str, make: Callable[[], Callable[[list], dict[str, list]]], drop: tuple[str, ...] = ()) -> DataFrame:
    """Appends columns that Python works out from one text column, batch by batch.

    added: DDL of the new columns. make() is called once in each task and gives a function from a list of
    texts to the new columns. The other columns pass through as Arrow data, untouched.
    """
    new = T._parse_datatype_string(added)
    kept = [f for f in df.schema.fields if f.name not in drop]
    schema = T.StructType([*kept, *new.fields])
    names, fresh = [f.name for f in kept], [f.name for f in new.fields]
    from pyspark.sql.pandas.types import to_arrow_schema

    types = [to_arrow_schema(new).field(n).type for n in fresh]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            got = work(batch.column(batch.schema.get_field_index(column)).to_pylist())
            arrays = [batch.column(batch.schema.get_field_index(n)) for n in names]
            arrays += [pa.array(got[n], type=t) for n, t in zip(fresh, types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, [*names, *fresh])

    limit_batches(df.sparkSession)
    return df.mapInArrow(run, schema)


def limit_batches(spark: SparkSession) -> None:
    """Keeps Arrow batches small where the session has no smaller limit of its own."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) > ARROW_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 1 modulo 3; such rows are never learned from. A null id is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))
