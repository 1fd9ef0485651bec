"""Profiles, balanced draws, cut windows and label resolution over tables of any size."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackloom.functions.lexicon import let


def field_histogram(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """(field, value, n, share) for every value of the fields, as text; nulls have a row of their own."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields])).alias("x"))
    counts = long.groupBy("x.field", "x.value").agg(F.count("*").alias("n"))
    totals = counts.groupBy("field").agg(F.sum("n").alias("total"))
    return counts.join(totals, "field").select("field", "value", "n", (F.col("n") / F.col("total")).alias("share"))


def _told(path: str, value: Column, kind: T.DataType) -> Column:
    """array<struct<path, kind, missing, value, number, size>>: a value and all that it holds, the elements of a list under the path with []."""
    none = F.lit(None)
    own = F.struct(
        F.lit(path).alias("path"),
        F.lit(kind.simpleString() if not isinstance(kind, T.StructType | T.ArrayType | T.MapType) else kind.typeName()).alias("kind"),
        value.isNull().alias("missing"),
        (none if isinstance(kind, T.StructType | T.ArrayType | T.MapType | T.BinaryType) else value).cast("string").alias("value"),
        (value if isinstance(kind, T.NumericType) else none).cast("double").alias("number"),
        (F.size(value) if isinstance(kind, T.ArrayType | T.MapType) else none).cast("int").alias("size"),
    )
    inner: list[Column] = []
    if isinstance(kind, T.StructType):
        inner = [_told(f"{path}.{f.name}", value.getField(f.name), f.dataType) for f in kind.fields]
    elif isinstance(kind, T.ArrayType):
        inner = [F.flatten(F.transform(value, lambda x: _told(f"{path}[]", x, kind.elementType)))]
    elif isinstance(kind, T.MapType):
        pair = T.StructType([T.StructField("key", kind.keyType), T.StructField("value", kind.valueType)])
        inner = [F.flatten(F.transform(F.map_entries(value), lambda x: _told(f"{path}[]", x, pair)))]
    empty = F.array().cast("array<struct<path:string,kind:string,missing:boolean,value:string,number:double,size:int>>")
    return F.concat(F.array(own), *[F.coalesce(x, empty) for x in inner]) if inner else F.array(own)


def profile(df: DataFrame) -> DataFrame:
    """(path, kind, n, n_null, null_share, n_distinct, least, most, median, lists, shortest, longest, mean_length) of every field, however deep.

    Fields of structs are named with a dot, elements of lists with [], entries of maps as elements with key and
    value. Numbers are compared as numbers, other values not at all (least, most and median are null). n_distinct and
    median come from sketches that merge, so one pass with sums in the tasks gives all. lists adds up the lengths.
    """
    rows = df.select(F.explode(F.concat(*[_told(f.name, F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields])).alias("x")).select("x.*")
    n = F.count("*")
    return rows.groupBy("path", "kind").agg(
        n.alias("n"),
        F.sum(F.col("missing").cast("long")).alias("n_null"),
        (F.sum(F.col("missing").cast("long")) / n).alias("null_share"),
        F.approx_count_distinct("value").alias("n_distinct"),
        F.min("number").alias("least"),
        F.max("number").alias("most"),
        F.percentile_approx("number", 0.5).alias("median"),
        F.sum("size").alias("lists"),
        F.min("size").alias("shortest"),
        F.max("size").alias("longest"),
        F.avg("size").alias("mean_length"),
    )


def quotas(sizes: Mapping[str, int], limit: int) -> dict[str, int]:
    """How many of each group to draw so that groups get equal parts of the limit, as far as they last; what is left over goes to the first names."""
    level, spare = 0, limit
    while True:
        open_groups = [k for k in sizes if sizes[k] > level]
        if not open_groups or spare < len(open_groups):
            break
        up = min(spare // len(open_groups), min(sizes[k] for k in open_groups) - level)
        level, spare = level + up, spare - up * len(open_groups)
    got = {k: min(n, level) for k, n in sizes.items()}
    for k in sorted(open_groups)[:spare]:
        got[k] += 1
    return got


def balanced_draw(df: DataFrame, group: str, order: str, limit: int) -> DataFrame:
    """Up to `limit` rows of df, spread evenly over the groups, in each the first by order.

    The driver sees one count a group, so groups are a vocabulary such as actions. Map tasks pass on
    no more than `limit` rows of a group. Rows with a null group are not drawn.
    """
    sizes = {r[0]: r[1] for r in df.where(F.col(group).isNotNull()).groupBy(group).count().collect()}
    if not sizes:
        return df.limit(0)
    quota = F.create_map(*[F.lit(x) for k, n in quotas(sizes, limit).items() for x in (k, n)])
    nth = F.row_number().over(Window.partitionBy(group).orderBy(order))
    ranked = df.where(F.col(group).isNotNull()).withColumn("_nth", nth).where(F.col("_nth") <= limit)
    return ranked.where(F.col("_nth") <= quota[F.col(group)]).drop("_nth")


def clause_windows(changes: Column, start: Column, end: Column, n: Column) -> Column:
    """[start, end] cut into n windows (from_sec, to_sec) at distinct changes strictly inside, spread evenly over their list.

    Null for a single clause, or with fewer than n - 1 such changes.
    """

    def spans(edges: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(edges) - 2), lambda i: F.struct(F.get(edges, i).alias("from_sec"), F.get(edges, i + 1).alias("to_sec")))

    def cut(inside: Column) -> Column:
        k = F.size(inside)
        cuts = F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1)).cast("int")), lambda i: F.get(inside, F.floor(i * k / n).cast("int")))
        return F.when(k >= n - 1, let(F.concat(F.array(start), cuts, F.array(end)), spans))

    return F.when(n > 1, let(F.array_sort(F.array_distinct(F.filter(changes, lambda c: (c > start) & (c < end)))), cut))


def resolved_label(span: Column, labels: Sequence[str]) -> Column:
    """The label that a grounded span of text means.

    An equal label; else the one with the largest Jaccard overlap of words, the earlier on a tie; else the
    longest that contains the span or is part of it; else the span itself, `unmatched` if it is empty. Marks of split
    words (##) do not count. A null span has no label.
    """
    text = F.btrim(F.btrim(F.btrim(F.lower(span)), F.lit(".")))
    words = lambda t: F.array_distinct(F.regexp_extract_all(F.replace(t, F.lit("##"), F.lit("")), F.lit(r"([a-z0-9]+)")))
    all_labels = F.array(*[F.struct(F.lit(v).alias("label"), F.lit(-i).alias("at")) for i, v in enumerate(labels)])
    shared = lambda v: F.size(F.array_intersect(words(text), words(v["label"])))
    joined = lambda v: F.size(F.array_union(words(text), words(v["label"])))
    by_words = F.array_max(F.transform(F.filter(all_labels, lambda v: shared(v) > 0), lambda v: F.struct((shared(v) / joined(v)).alias("score"), v["at"], v["label"])))
    part = F.filter(all_labels, lambda v: F.contains(text, v["label"]) | F.contains(v["label"], text))
    by_part = F.array_max(F.transform(part, lambda v: F.struct(F.length(v["label"]).alias("size"), v["at"], v["label"])))
    return F.when(text.isNull(), F.lit(None)).when(text == "", "unmatched").when(text.isin(*labels), text).otherwise(F.coalesce(by_words["label"], by_part["label"], text))
