"""Benchmark decontamination by winnowed fingerprints, with DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackloom.llm.common import ascii_lower, cut, let, packed, small, stored, text_key

#: What stands between words, after A-Z are lower-cased.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(text), BETWEEN, -1), "")


def grams(items: Column, n: int, of: Callable[..., Column]) -> Column:
    """of(items[i], ..., items[i + n - 1]) for each i; empty for fewer than n items."""
    spots = F.when(F.size(items) >= n, F.sequence(F.lit(0), F.size(items) - n)).otherwise(F.array().cast("array<int>"))
    return F.transform(spots, lambda i: of(*[F.get(items, i + j) for j in range(n)]))


def word_hashes(tokens: Column) -> Column:
    return F.transform(tokens, lambda w: F.xxhash64(w))


def least_hashes(tokens: Column, window: int, k: int) -> Column:
    """Winnowing: of each window - k + 1 runs of k words in a row, the least hash. None for fewer than `window` words."""
    return let(word_hashes(tokens), lambda h: let(grams(h, k, F.xxhash64), lambda g: grams(g, window - k + 1, F.least) if window > k else g))


def run_hashes(tokens: Column, n: int) -> Column:
    """The hashes of all runs of n words."""
    return grams(tokens, n, lambda *w: F.xxhash64(F.lit(len(w)), *w))


def numbered(marks: Column) -> Column:
    """(mark, pos) of each."""
    return F.transform(marks, lambda x, i: F.struct(x.alias("mark"), i.alias("pos")))


def fingerprints(tokens: Column, window: int, k: int) -> Column:
    """(mark, pos) of the runs of k words whose hash is one of least_hashes(); ties all count.

    The choice depends on the words of a window alone, so a window that two texts share gives both the same
    mark at the same place in it.
    """
    width = window - k + 1

    def chosen(g: Column) -> Column:
        if width < 2:
            return numbered(g)
        # A hash is the least of a window around it if the largest of the least of these windows is no less.
        top = lambda least, p: F.greatest(*[F.get(least, p - j) for j in range(width)])
        marked = lambda least: F.filter(numbered(g), lambda x: top(least, x["pos"]) >= x["mark"])
        return let(grams(g, width, F.least), marked)

    found = let(word_hashes(tokens), lambda h: let(grams(h, k, F.xxhash64), chosen))
    return F.when(F.size(tokens) >= window, found).otherwise(F.array().cast("array<struct<mark:bigint,pos:int>>"))


def exact(tokens: Column, n: int) -> Column:
    """(mark, pos) of all runs of n words."""
    return numbered(run_hashes(tokens, n))


def seeds(items: DataFrame, window: int, k: int, lengths: list[int]) -> DataFrame:
    """(mark, item, around, at, size, need): the fingerprints of the items with the words around them.

    A window that holds a fingerprint reaches at most window - k words beyond it, so these words on either side
    are all that extension can ask for; at is the fingerprint's place in them. An item of fewer words than a
    window is one fingerprint, its own words around it.
    """
    more = window - k
    part = lambda x: F.slice("tokens", F.greatest(x["pos"] - more, F.lit(0)) + 1, F.least(x["pos"], F.lit(more)) + k + more)
    long = items.where(F.size("tokens") >= window).select("item", F.explode(F.transform(fingerprints(F.col("tokens"), window, k), lambda x: F.struct(x["mark"].alias("mark"), part(x).alias("around"), F.least(x["pos"], F.lit(more)).alias("at")))).alias("x"))
    found = long.select("x.mark", "item", "x.around", "x.at", F.lit(k).alias("size"), F.lit(window).alias("need"))
    for n in lengths:
        short = items.where(F.size("tokens") == n).select("item", "tokens", F.explode(exact(F.col("tokens"), n)).alias("x"))
        found = found.unionByName(short.select("x.mark", "item", F.col("tokens").alias("around"), F.lit(0).alias("at"), F.lit(n).alias("size"), F.lit(n).alias("need")))
    return found.distinct()


def extended(tokens: Column, hit: Column, more: int) -> Column:
    """(start, stop) of the words that a fingerprint's run has in common with the item's, outwards from it; null if they are too few or its own words differ."""
    at, pos, size, around = hit["at"], hit["pos"], hit["size"], hit["around"]
    same = lambda i: F.get(around, at + i) == F.get(tokens, pos + i)

    def reach(place: Callable[[Column], Column]) -> Column:
        steps = F.sequence(F.lit(1), F.lit(more)) if more else F.array().cast("array<int>")
        return F.aggregate(steps, F.lit(0), lambda n, j: F.when((n == j - 1) & same(place(j)), j).otherwise(n))

    start, stop = pos - reach(lambda j: -j), pos + size + reach(lambda j: size - 1 + j)
    equal = F.forall(F.sequence(F.lit(0), size - 1), same)
    return let(F.struct(start.alias("start"), stop.alias("stop")), lambda run: F.when(equal & (run["stop"] - run["start"] >= hit["need"]), run))


def contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = 10, k: int = 5, columns: list[str] | None = None) -> DataFrame:
    """(row, n_words, n_hit, item_ids) for every row of docs; row is the input row as a struct, or what `columns` names of it.

    A window is `window` consecutive words of an item, or all words of a shorter item. n_hit counts the words
    of the document inside any occurrence of a window, item_ids lists the items that have one.

    Documents and items are winnowed; texts that share a fingerprint with an item are candidates. Their fingerprints are joined
    with the items' by positions, and each hit is extended outwards word for word, as far as a window around the
    fingerprint can reach; runs that are long enough count, and their union is what is hit. Every shared window holds a fingerprint of both texts, so none is missed. Items too short to
    winnow are fingerprints as a whole. Texts are keyed by a 128-bit hash, so copies are examined once; only candidates
    are cut into words again. A null or empty text has no words and no hits. The items' fingerprints, the candidates and
    their hits are stored, and broadcast only up to a size counted before; else the joins can be split where
    a fingerprint or text is hot. Items with a null id count as hits but are not listed; items of the same id count as one.
    """
    if not 0 < k <= window:
        raise ValueError("a fingerprint has one word at least and no more than a window")
    rows = packed(docs, text).select("row", "body", text_key(F.col("body")).alias("key"))
    items = benchmark.select(F.col(f"`{item_id}`").alias("item"), words(F.coalesce(F.col(f"`{item_text}`").cast("string"), F.lit(""))).alias("tokens")).where(F.size("tokens") > 0)
    items = cut(items)
    lengths = sorted(r[0] for r in items.where(F.size("tokens") < window).select(F.size("tokens")).distinct().collect())  # fewer than window values
    sought = cut(seeds(items, window, k, lengths))

    def marks(tokens: Column) -> Column:
        return F.array_distinct(F.concat(least_hashes(tokens, window, k), *[run_hashes(tokens, n) for n in lengths]))

    marked = rows.select("key", F.explode(let(words(F.col("body")), marks)).alias("mark"))
    candidates = small(marked.join(small(sought.select("mark").distinct()), "mark", "left_semi").select("key").distinct())
    texts = stored(rows.select("key", "body").join(candidates, "key", "left_semi").groupBy("key").agg(F.first("body").alias("body")), "candidates")
    places = texts.select("key", F.explode(let(words(F.col("body")), lambda t: F.concat(fingerprints(t, window, k), *[exact(t, n) for n in lengths]))).alias("x"))
    hits = places.select("key", "x.mark", "x.pos").join(small(sought), "mark").groupBy(F.col("key").alias("at_key")).agg(F.collect_list(F.struct("pos", "item", "around", "at", "size", "need")).alias("hits"))

    def runs(tokens: Column) -> Column:
        each = F.transform("hits", lambda h: F.struct(extended(tokens, h, window - k).alias("run"), h["item"].alias("item")))
        return F.filter(each, lambda r: r["run"].isNotNull())

    found = texts.join(hits, F.col("key") == F.col("at_key")).select("key", F.explode(let(words(F.col("body")), runs)).alias("x"))
    found = found.groupBy("key").agg(F.collect_set("x.run").alias("runs"), F.collect_set("x.item").alias("item_ids"))
    covered = F.aggregate(
        F.array_sort("runs"),
        F.struct(F.lit(0).alias("stop"), F.lit(0).alias("n")),
        lambda a, x: F.struct(
            F.greatest(a["stop"], x["stop"]).alias("stop"),
            (a["n"] + F.greatest(F.lit(0), x["stop"] - F.greatest(a["stop"], x["start"]))).alias("n"),
        ),
        lambda a: a["n"],
    )
    found = small(found.select(F.col("key").alias("hit_key"), covered.cast("long").alias("n_hit"), "item_ids"))
    row = F.struct(*[F.col("row").getField(c).alias(c) for c in columns]) if columns else F.col("row")
    counted = rows.select(row.alias("row"), "key", F.size(words(F.col("body"))).cast("long").alias("n_words"))
    none = F.array().cast(f"array<{benchmark.schema[item_id].dataType.simpleString()}>")
    return counted.join(found, F.col("key") == F.col("hit_key"), "left").select(
        "row", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("item_ids", none).alias("item_ids")
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows of docs without a benchmark window, with their columns."""
    return contamination(docs, benchmark, text, **options).where("n_hit = 0").select("row.*")
