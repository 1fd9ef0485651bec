"""Answers of a model that may fail: asked again with growing pauses, all rows of an answer or one failed row, and resumed where a run stopped."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What a call gives, beside the keys: one row for each object of the answer, or a single FAILED one.
ANSWER = "status string, nth int, row string, attempts int, error string"
Call = Callable[[dict, int], str]


def objects_of(text: str) -> list[dict]:
    """The objects of an answer's JSON, a list or a single one, whatever stands around it; ValueError if there are none or others."""
    starts = [i for i in (text.find("["), text.find("{")) if i >= 0]
    if not starts:
        raise ValueError("no JSON in the answer")
    found = json.JSONDecoder().raw_decode(text[min(starts) :])[0]
    rows = found if isinstance(found, list) else [found]
    if not rows or not all(isinstance(r, dict) for r in rows):
        raise ValueError("not a list of objects")
    return rows


def ask(row: dict, call: Call, retries: int, pause: float) -> list[tuple]:
    """The rows of the first good answer to a row, or one that tells the last error. A bad object spoils its whole answer."""
    error = ""
    for attempt in range(1, retries + 2):
        try:
            rows = objects_of(call(row, attempt))
            return [("SUCCESS", i, json.dumps(r, sort_keys=True), attempt, None) for i, r in enumerate(rows)]
        except ValueError as e:  # JSON that can't be read is one
            error = f"{'JSON' if isinstance(e, json.JSONDecodeError) else 'answer'}: {e}"
        except Exception as e:  # noqa: BLE001  whatever the call raises
            error = f"call: {e}"
        if attempt <= retries and pause > 0:
            time.sleep(pause * 2 ** (attempt - 1))
    return [("FAILED", 0, None, retries + 1, error)]


def answered(requests: DataFrame, keys: list[str], call: Call, retries: int = 2, pause: float = 0.0) -> DataFrame:
    """(keys, status, nth, row, attempts, error): call(row, attempt) for every row of requests, in the tasks that hold them.

    A call that raises, or whose answer has no list of objects, is made again, up to `retries` times, after pauses that
    double from `pause` seconds. A row's calls are made again if its task is lost, so calls should bear that.
    """
    names = requests.columns
    schema = T.StructType([*[requests.schema[k] for k in keys], *T._parse_datatype_string(ANSWER).fields])
    places = [names.index(k) for k in keys]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for values in batch.itertuples(index=False, name=None):
                own = tuple(values[i] for i in places)
                out += [own + told for told in ask(dict(zip(names, values, strict=True)), call, retries, pause)]
            yield pd.DataFrame(out, columns=schema.names)

    return requests.mapInPandas(run, schema)


def answer_into(path: str, requests: DataFrame, keys: list[str], call: Call, parts: int = 16, **options) -> DataFrame:
    """Answers written to a table at path, in `parts` jobs by a hash of the keys; those that the table has already are not asked again.

    A job's rows are there as a whole or not at all, so a run that stops goes on behind its last part. Failed rows
    count as answered. Keys must not be null; requests that repeat keys are asked once for each.
    """
    spark = requests.sparkSession
    form = answered(requests.limit(0), keys, call).schema
    part = F.pmod(F.xxhash64(*keys), F.lit(parts))
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    for i in range(parts):
        rest = requests.where(part == i)
        if jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path):
            done = spark.read.schema(form).parquet(path).select(*keys).distinct()
            rest = rest.join(done, keys, "left_anti").select(*requests.columns)
        answered(rest, keys, call, **options).write.mode("append").parquet(path)
    return spark.read.schema(form).parquet(path)
