"""Corpus-wide removal of lines that many documents share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackloom.llm.common import ascii_lower, let, packed, small, text_key

#: What is stripped from both ends of a line: space, tab, newline, vertical tab, form feed, carriage return.
BLANKS = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    """The line without blanks at its ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def shared_lines(docs: DataFrame, text: str = "text", min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """(line_hash, n_docs): the keys of at least min_chars code points that occur in at least min_docs rows of docs.

    A row counts once for each of its keys. Counts are summed inside the map tasks first, so a line that
    every document holds reaches the shuffle once from each task.
    """
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    keys = F.array_distinct(F.transform(F.split(body, "\n", -1), line_key))
    lines = docs.select(F.explode(keys).alias("line")).where(F.char_length("line") >= max(1, min_chars))
    counts = lines.groupBy(text_key(F.col("line")).alias("line_hash")).agg(F.count("*").alias("n_docs"))
    return counts.where(F.col("n_docs") >= min_docs)


def drop_shared_lines(docs: DataFrame, text: str = "text", min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """(row, kept_text, n_lines, n_dropped) for every row of docs; row is the input row as a struct.

    Lines are exploded, hashed and counted over documents; the positions of the lines that reach min_docs
    go back to their texts, where the other lines are joined again in order. Texts are keyed by a 128-bit
    hash, so repeated rows, repeated ids and null ids need no key of their own. The shared lines and the positions are
    stored, and broadcast if they are small; else the joins can be split where a line or text is hot, and texts
    move once. A null or empty text is one empty line. Lines of blanks only have the empty key and stay.
    """
    rows = packed(docs, text)
    body = F.coalesce(F.col("row").getField(text).cast("string"), F.lit(""))
    split = F.split("body", "\n", -1)
    common = small(shared_lines(docs, text, min_docs, min_chars).select("line_hash"))
    lines = rows.select(text_key(F.col("body")).alias("key"), F.posexplode(F.transform(split, lambda x: text_key(line_key(x)))).alias("pos", "line_hash"))
    found = small(lines.join(common, "line_hash").groupBy("key").agg(F.collect_set("pos").alias("dropped")))
    joined = rows.select("row", text_key(F.col("body")).alias("key")).join(found.withColumnRenamed("key", "found_key"), F.col("key") == F.col("found_key"), "left")
    joined = joined.select("row", body.alias("body"), F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped"))
    stay = lambda parts: F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("dropped"))
    kept = let(split, lambda parts: F.array_join(F.transform(stay(parts), lambda p: F.get(parts, p)), "\n"))  # a text is split once, not for each line
    return joined.select(
        "row",
        F.when(F.size("dropped") == 0, F.col("body")).otherwise(kept).alias("kept_text"),
        F.size(split).cast("long").alias("n_lines"),
        F.size("dropped").cast("long").alias("n_dropped"),
    )
