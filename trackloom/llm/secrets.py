"""Credentials in texts: strong patterns, and weak parts that count only beside their complement. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackloom.llm.common import packed, small, text_key

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
IDENTIFIER = r"""((?i:client_?id|access_?key_?id|account_?id|account|username|user|login))["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._-]{3,})"""
WEAK_SECRET = r"""((?i:passphrase|pass|pwd|credentials?|client_?secret|private_?key|auth_?key|auth|bearer))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=!@-]{6,})"""
ENDPOINT = r"""((?i:https?|ftps?|sftp|amqps?|redis|mongodb|mysql|postgres(?:ql)?|s3))://[A-Za-z0-9._~:/?#@!$&()*+,;=%-]{4,}"""
#: Kinds in the order in which spans of one start are listed, with what they are part of.
KINDS = ("assign", "access", "hex", "identifier", "weak_secret", "endpoint")
ROLES = {"assign": "secret", "access": "identifier", "hex": "secret", "identifier": "identifier", "weak_secret": "secret", "endpoint": "endpoint"}
#: Which roles, in reach, make a weak part worth reporting.
NEEDS = {"identifier": ("secret",), "weak_secret": ("identifier", "endpoint"), "endpoint": ("secret",)}


def found(body: Column, pattern: str, group: int = 0, least: int = 0, most: int = 1 << 30) -> Column:
    """array<struct<start, stop>> of the leftmost non-overlapping matches, in code points.

    Where no part of the text matches, nothing else is worked out. Positions are sums of the lengths of the
    matches and of what split() leaves between them. Matches whose group is shorter than least or longer
    than most are dropped, after they have taken their place.
    """
    gaps, hits = F.split(body, pattern, -1), F.regexp_extract_all(body, F.lit(pattern), F.lit(0))
    sizes = F.arrays_zip(F.transform(gaps, F.char_length).alias("gap"), F.transform(hits, F.char_length).alias("hit"))
    spot = "struct<start:int,stop:int>"
    zero = F.struct(F.lit(0).alias("pos"), F.array().cast(f"array<{spot}>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["pos"] + x["gap"]
        stop = start + F.coalesce(x["hit"], F.lit(0))
        more = F.array_append(acc["out"], F.struct(start.cast("int").alias("start"), stop.cast("int").alias("stop")))
        return F.struct(stop.alias("pos"), F.when(x["hit"].isNotNull(), more).otherwise(acc["out"]).alias("out"))

    spots = F.aggregate(sizes, zero, step, lambda acc: acc["out"])
    if group:
        values = F.regexp_extract_all(body, F.lit(pattern), F.lit(group))
        fits = F.filter(F.arrays_zip(spots.alias("s"), values.alias("v")), lambda x: F.char_length(x["v"]).between(least, most))
        spots = F.transform(fits, lambda x: x["s"])
    return F.when(body.rlike(pattern), spots).otherwise(F.array().cast(f"array<{spot}>"))


def parts(body: Column, kind: str, least: int) -> Column:
    match kind:
        case "assign":
            return found(body, ASSIGN, 2, least)
        case "access":
            return found(body, ACCESS)
        case "hex":
            return found(body, HEX)
        case "identifier":
            return found(body, IDENTIFIER)
        case "weak_secret":
            return F.concat(found(body, WEAK_SECRET), found(body, ASSIGN, 2, 6, least - 1))
    return found(body, ENDPOINT)


def tagged(spans: Column, kind: str) -> Column:
    """The spans with their kind."""
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), F.lit(kind).alias("kind")))


def linked(rows: DataFrame, reach: int, least: int) -> DataFrame:
    """(key, extra): the weak parts of each text that have a complement within reach.

    An interval join: each part covers its span and `reach` code points on both sides, the complement its
    span; both are filed under the stretches of the text that they touch, and a semi join on text and
    stretch looks for an overlap. A stretch holds few parts, however long or frequent the text is, and
    copies of a text are looked at once.
    """
    weak = rows.where(F.col("body").rlike(IDENTIFIER) | F.col("body").rlike(WEAK_SECRET) | F.col("body").rlike(ENDPOINT) | F.col("body").rlike(ASSIGN))
    texts = weak.groupBy("key").agg(F.first("body").alias("body"))
    each = F.concat(*[tagged(parts(F.col("body"), k, least), k) for k in KINDS])
    spans = texts.select("key", F.explode(each).alias("p")).select("key", "p.kind", "p.start", "p.stop")
    role = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])
    stretch = lambda a, b: F.explode(F.sequence(F.floor(a / reach), F.floor(b / reach)))
    other = spans.select("key", role[F.col("kind")].alias("role"), F.col("start").alias("o_start"), F.col("stop").alias("o_stop"), stretch(F.col("start"), F.col("stop")).alias("stretch"))
    needs = F.create_map(*[x for k, v in NEEDS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    seeking = spans.where(F.col("kind").isin(*NEEDS)).withColumn("role", F.explode(needs[F.col("kind")]))
    seeking = seeking.withColumn("stretch", stretch(F.greatest(F.lit(0), F.col("start") - reach), F.col("stop") + reach))
    near = (F.col("o_start") <= F.col("stop") + reach) & (F.col("o_stop") >= F.col("start") - reach)
    kept = seeking.join(other, (seeking["key"] == other["key"]) & (seeking["role"] == other["role"]) & (seeking["stretch"] == other["stretch"]) & near, "left_semi")
    return kept.groupBy("key").agg(F.collect_set(F.struct("start", "stop", "kind")).alias("extra"))


def scan(docs: DataFrame, text: str = "text", reach: int = 200, least: int = 12) -> DataFrame:
    """(row, assign, access, hex, extra) for every row of docs: arrays of spans in code points, end exclusive.

    assign, access and hex are strong and stand alone. Weak parts (identifiers, short or loosely named
    secrets, endpoints) are in extra only where a complementary part, strong or weak, lies within `reach`
    code points. A null or empty text has none. Texts are keyed by a 128-bit hash, so repeated rows and ids
    need no key of their own.
    """
    rows = packed(docs, text).select("row", "body", text_key(F.col("body")).alias("key"))
    strong = rows.select("row", "key", *[parts(F.col("body"), k, least).alias(k) for k in KINDS[:3]])
    more = small(linked(rows.select("key", "body"), reach, least).withColumnRenamed("key", "found_key"))
    none = F.array().cast("array<struct<start:int,stop:int,kind:string>>")
    return strong.join(more, F.col("key") == F.col("found_key"), "left").select("row", *KINDS[:3], F.coalesce("extra", none).alias("extra"))


def spelled(spans: Column) -> Column:
    """kind:start:end of each of array<struct<start, stop, kind>>, by start and then kind as in KINDS, comma-joined."""
    rank = lambda k: F.array_position(F.array(*map(F.lit, KINDS)), k)
    order = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("a"), rank(s["kind"]).alias("b"), s["stop"].alias("c"), s["kind"].alias("d"))))
    return F.array_join(F.transform(order, lambda s: F.concat_ws(":", s["d"], s["a"].cast("string"), s["c"].cast("string"))), ",")
