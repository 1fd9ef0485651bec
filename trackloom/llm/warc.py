"""WARC archives written and read by Spark, with record boundaries proved by following the chain from each file's start."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trackloom.llm.common import cut, limit_batches, small, stored

MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def sha1_base32(data: Column) -> Column:
    """The bare upper-case base32 SHA-1 of a string's or binary's bytes: five hex digits give four letters."""
    return base32(F.sha1(data))


def base32(digest: Column) -> Column:
    """40 hex digits as 32 letters."""
    letters = []
    for i in range(8):
        bits = F.conv(F.substring(digest, 5 * i + 1, 5), 16, 10).cast("int")
        letters += [F.substring(F.lit(BASE32), (F.shiftright(bits, 15 - 5 * j).bitwiseAND(31) + 1), F.lit(1)) for j in range(4)]
    return F.concat(*letters)


def with_revisits(pages: DataFrame, page_id: str, url: str, html: str, min_bytes: int) -> DataFrame:
    """(id, url, payload, size, digest, keep): keep is the id of the response that a record repeats, or null.

    Of records with equal payloads of at least min_bytes, that with the largest id is the response. The
    largest id is found per digest with sums inside the map tasks, and only digests that occur more than
    once go back to the records: by broadcast if they are few, else by a join that can be split where a
    digest is hot. Payloads don't move otherwise.
    """
    payload = F.coalesce(F.col(f"`{html}`").cast("string"), F.lit(""))
    rows = pages.select(F.col(f"`{page_id}`").cast("long").alias("id"), F.col(f"`{url}`").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"size": F.octet_length("payload").cast("long"), "digest": F.unhex(F.sha1("payload"))})
    last = rows.where(F.col("size") >= min_bytes).groupBy(F.col("digest").alias("same")).agg(F.max("id").alias("last_id"), F.count("*").alias("n"))
    both = rows.join(small(last.where("n > 1").drop("n")), F.col("digest") == F.col("same"), "left")
    repeats = F.col("last_id").isNotNull() & ~F.col("id").eqNullSafe(F.col("last_id"))
    return both.select("id", "url", "payload", "size", base32(F.hex("digest")).alias("digest"), F.when(repeats, F.col("last_id")).alias("keep"))


def write_warc(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> None:
    """Writes one WARC/1.1 record for every row of pages, a file for each task.

    A response holds its payload in UTF-8 (null: empty). A revisit holds none: it names its response and
    payload digest, as the identical-payload profile says. Rows whose id equals the largest are responses,
    repeated rows among them; a null id is the smallest, and its record has no WARC-Record-ID. Control
    characters in a URL become spaces. An empty table gives an archive without records.
    """
    rows = with_revisits(pages, page_id, url, html, min_bytes)
    body = F.when(F.col("keep").isNull(), F.col("payload")).otherwise("")
    name = lambda c: F.format_string("<urn:page:%d>", c)

    def header(key: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{key}: "), value, F.lit("\r\n")), F.lit(""))

    kind = F.when(F.col("keep").isNull(), "response").otherwise("revisit")
    record = F.concat(
        F.lit(MAGIC),
        header("WARC-Type", kind),
        header("WARC-Record-ID", F.when(F.col("id").isNotNull(), name(F.col("id")))),
        header("WARC-Target-URI", F.regexp_replace("url", "[\\x00-\\x1F\\x7F]", " ")),
        header("WARC-Date", F.lit(date)),
        header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        header("WARC-Refers-To", F.when(F.col("keep").isNotNull(), name(F.col("keep")))),
        header("WARC-Profile", F.when(F.col("keep").isNotNull(), F.lit(REVISIT_PROFILE))),
        header("Content-Type", F.when(F.col("keep").isNull(), F.lit("text/html; charset=utf-8"))),
        header("Content-Length", F.octet_length(body).cast("string")),
        F.lit("\r\n"),
        body,
        F.lit("\r\n"),  # the writer adds the second line end
    )
    rows.select(record.alias("value")).write.option("lineSep", "\r\n").text(path)


def scan(spark: SparkSession, path: str) -> DataFrame:
    """(path, file, block, value): what stands between two occurrences of the magic, in the order of each split.

    Spark's reader splits files at every magic, wherever it stands, so tasks share large files; block is the
    byte where the split begins. file is a hash of the path.
    """
    read = spark.read.option("lineSep", MAGIC).text(path)
    where = F.col("_metadata.file_path")
    return read.select(where.alias("path"), F.xxhash64(where).alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def jump(value: Column) -> Column:
    """From a magic to the byte where a record would follow, by the header behind it; null without a known length."""
    head = F.substring_index(value, END, 1)
    size = F.regexp_extract(head, r"(?im)^Content-Length:[ \t]*([0-9]{1,18})[ \t]*\r?$", 1)
    total = len(MAGIC) + F.octet_length(head) + len(END) + size.cast("long") + len(END)
    return F.when((size != "") & value.contains(END), total)


def _runs(file: np.ndarray, block: np.ndarray) -> list[tuple[int, int]]:
    """The stretches of rows that are of one split."""
    edges = np.flatnonzero((file[1:] != file[:-1]) | (block[1:] != block[:-1])) + 1
    return list(zip([0, *edges.tolist()], [*edges.tolist(), len(file)], strict=True)) if len(file) else []


def exits(at: np.ndarray, after: np.ndarray, stop: int) -> np.ndarray:
    """Where the chain from each candidate leaves its split; -1 if it breaks within. after is -1 for other chunks."""
    out = np.full(len(at), -1, np.int64)
    place = np.searchsorted(at, after)
    for i in range(len(at) - 1, -1, -1):
        if after[i] >= stop:
            out[i] = after[i]
        elif after[i] >= 0 and place[i] < len(at) and at[place[i]] == after[i]:
            out[i] = out[place[i]]
    return out


def placed(chunks: DataFrame) -> DataFrame:
    """(path, file, block, local, step, leap, value): the chunks of a scan with their places in their splits, written once.

    Spark cuts splits by the cores that it has when it plans a scan, so a second scan may cut elsewhere. All
    that follows reads this one table: its numbers to find the records, then its texts. step is the chunk's
    length with the magic before it, leap the way to the next record by its own header, or null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, at = None, 0
        for batch in batches:
            file, block, step = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("file", "block", "step"))
            local = np.empty(len(step), np.int64)
            for a, b in _runs(file, block):
                if split != (file[a], block[a]):
                    split, at = (file[a], block[a]), 0
                ends = at + np.cumsum(step[a:b])
                local[a:b], at = ends - step[a:b], int(ends[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(local)], [*batch.schema.names, "local"])

    limit_batches(chunks.sparkSession)
    step = (F.octet_length("value") + len(MAGIC)).cast("long")
    rows = chunks.select("path", "file", "block", step.alias("step"), jump(F.col("value")).cast("long").alias("leap"), "value")
    return stored(rows.mapInArrow(run, "path string, file long, block long, step long, leap long, value string, local long"), "warc-chunks", "zstd")


def links(chunks: DataFrame) -> DataFrame:
    """(file, block, local, after, leaves, length) for each placed chunk, without the text.

    after is the place of the record that its header points to (null if it is no candidate), leaves the first
    place outside the split on its chain, length that of the split. Only numbers move, split by split.
    """

    def leave(group: pa.Table) -> pa.Table:
        group = group.sort_by("local")
        at, step = (group.column(c).to_numpy() for c in ("local", "step"))
        after = np.nan_to_num(at + group.column("leap").to_numpy(zero_copy_only=False), nan=-1).astype(np.int64)
        stop = int(at[-1] + step[-1])
        out = exits(at, after, stop)
        cols = [group.column(c).combine_chunks() for c in ("file", "block", "local")]
        cols += [pa.array(x, pa.int64(), mask=x < 0) for x in (after, out)] + [pa.array(np.full(len(at), stop), pa.int64())]
        return pa.Table.from_arrays(cols, ["file", "block", "local", "after", "leaves", "length"])

    numbers = chunks.select("file", "block", "local", "step", "leap")
    return numbers.groupBy("file", "block").applyInArrow(leave, "file long, block long, local long, after long, leaves long, length long")


def reachable(links: DataFrame) -> DataFrame:
    """(file, at) of the records on the chain from byte 0 of each file, of links (file, at, next).

    Pointer jumping: in each round what is reached reaches its pointer's target, then every pointer is
    replaced by that of its target. A chain of n records takes log2(n) rounds; a table in the shared
    folder cuts the lineage after each. A magic inside a payload may begin a chain of its own, but nothing
    that is reached points to it.
    """
    state = cut(links.select("file", "at", "next", (F.col("at") == 0).alias("on")))
    while not state.where(F.col("on") & F.col("next").isNotNull()).isEmpty():
        target = state.select("file", F.col("at").alias("next"), F.col("next").alias("jump"))
        hit = state.where(F.col("on") & F.col("next").isNotNull()).select("file", F.col("next").alias("at"), F.lit(True).alias("hit")).distinct()
        moved = state.join(target, ["file", "next"], "left").join(hit, ["file", "at"], "left")
        state = cut(moved.select("file", "at", F.col("jump").alias("next"), (F.col("on") | F.coalesce("hit", F.lit(False))).alias("on")))
    return state.where("on").select("file", "at")


def boundaries(chunks: DataFrame) -> DataFrame:
    """(file, block, local, at, pieces): the placed chunks of each record on the chain of its file; at is the record's first byte.

    Tasks emit, split by split, where each candidate's chain leaves the split. The byte where a split begins is
    the sum of the lengths of those before it, one row for a split. Pointer jumping over the gates, which are the
    candidates that a chain from another split or byte 0 enters by, tells where the real chain enters each
    split; there it is walked to the end of the split. What stands before a split's first record belongs to
    the last one of an earlier split. No task holds more than the numbers of one split.
    """
    all_links = stored(links(chunks), "warc-links")
    order = Window.partitionBy("file").orderBy("block")
    splits = all_links.groupBy("file", "block").agg(F.first("length").alias("length"))
    base = F.coalesce(F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) - len(MAGIC)
    splits = small(splits.select("file", "block", base.alias("base")))

    sound = all_links.where("leaves is not null").join(splits, ["file", "block"])
    sound = sound.select("file", "block", "local", (F.col("local") + F.col("base")).alias("at"), (F.col("leaves") + F.col("base")).alias("next"))
    aims = sound.select("file", F.col("next").alias("at")).distinct()
    gates = cut(sound.where("at = 0").unionByName(sound.where("at > 0").join(aims, ["file", "at"], "left_semi")))
    entered = gates.join(reachable(gates), ["file", "at"], "left_semi").select("file", "block", F.col("local").alias("entry"))

    def walk(group: pa.Table) -> pa.Table:
        """Each chunk's record and where that ends, in places of the split; null before the first record."""
        group = group.sort_by("local")
        at = group.column("local").to_numpy()
        after = np.nan_to_num(group.column("after").to_numpy(zero_copy_only=False), nan=-1).astype(np.int64)
        entry = group.column("entry")[0].as_py()
        starts = []
        while entry is not None:
            i = int(np.searchsorted(at, entry))
            if i == len(at) or at[i] != entry or after[i] < 0:
                break
            starts.append(i)
            entry = int(after[i])
        which = np.searchsorted(np.array(starts, np.int64), np.arange(len(at)), "right") - 1
        chosen = np.array(starts, np.int64)[np.maximum(which, 0)] if starts else np.zeros(len(at), np.int64)
        none = which < 0
        cols = [group.column(c).combine_chunks() for c in ("file", "block", "local")]
        cols += [pa.array(x[chosen], pa.int64(), mask=none) for x in (at, after)]
        return pa.Table.from_arrays(cols, ["file", "block", "local", "record", "until"])

    inner = all_links.select("file", "block", "local", "after").join(entered, ["file", "block"], "left")
    walked = cut(inner.groupBy("file", "block").applyInArrow(walk, "file long, block long, local long, record long, until long"))
    last = walked.groupBy("file", "block").agg(F.max(F.struct("record", "until")).alias("last")).join(splits, ["file", "block"])
    ends = F.when(F.col("last.record").isNotNull(), F.struct((F.col("last.record") + F.col("base")).alias("at"), (F.col("last.until") + F.col("base")).alias("until")))
    carried = F.last(ends, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    last = last.select("file", "block", "base", carried.alias("carried"))
    own = walked.join(last, ["file", "block"]).withColumn("byte", F.col("local") + F.col("base"))
    at = F.coalesce(F.col("record") + F.col("base"), F.col("carried.at"))
    until = F.coalesce(F.col("until") + F.col("base"), F.col("carried.until"))
    own = own.select("file", "block", "local", "byte", at.alias("at"), until.alias("until")).where((F.col("byte") >= 0) & (F.col("byte") < F.col("until")))
    counts = own.groupBy("file", "at").agg(F.count("*").alias("pieces")).where("pieces > 1")
    return own.join(counts, ["file", "at"], "left").select("file", "block", "local", "at", F.coalesce("pieces", F.lit(1)).alias("pieces"))


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row for each record of the archives under path.

    (file, at, record_type, page_id, url, refers_to, named_digest, payload, sound): payload is binary, whole,
    also where it holds the magic; sound says that it has its full length. The archives are scanned once, into a
    table in the shared folder; its texts are joined to the places of the records that its numbers give, and those
    whose payload holds the magic are put together from their pieces. A file without records
    gives none; bytes behind a broken boundary are not on the chain and are left out.
    """
    chunks = placed(scan(spark, path))
    owned = small(boundaries(chunks))
    both = chunks.join(owned, ["file", "block", "local"])
    single = both.where("pieces = 1").select("path", "at", F.col("value").alias("whole"))
    parts = both.where("pieces > 1").groupBy("path", "at").agg(F.array_sort(F.collect_list(F.struct("block", "local", "value"))).alias("parts"))
    rec = single.unionByName(parts.select("path", "at", F.array_join(F.transform("parts", lambda p: p["value"]), MAGIC).alias("whole")))
    rec = rec.select(F.col("path").alias("file"), "at", F.substring_index("whole", END, 1).alias("head"), F.col("whole").cast("binary").alias("data"))

    def field(key: str, pattern: str) -> Column:
        got = F.regexp_extract("head", rf"(?im)^{key}:[ \t]*{pattern}[ \t]*\r?$", 1)
        return F.when(got != "", got)

    size = field("Content-Length", "([0-9]+)").cast("int")
    start = F.octet_length("head") + len(END) + 1
    return rec.select(
        "file",
        "at",
        field("WARC-Type", "(\\S+)").alias("record_type"),
        field("WARC-Record-ID", "<urn:page:(-?[0-9]+)>").cast("long").alias("page_id"),
        field("WARC-Target-URI", "(.*?)").alias("url"),
        field("WARC-Refers-To", "<urn:page:(-?[0-9]+)>").cast("long").alias("refers_to"),
        field("WARC-Payload-Digest", "sha1:(\\S+)").alias("named_digest"),
        F.substring("data", start, size).alias("payload"),
        (F.octet_length("data") >= start - 1 + size).alias("sound"),
    )


def resolve_revisits(records: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to): a revisit has the figures of its response's payload.

    The response is the one that the revisit names whose payload has the named digest; several records may
    have one id. A revisit whose response is not there keeps the digest that it names and has no size.
    """
    own = records.select("page_id", "record_type", "refers_to", "named_digest", F.octet_length("payload").cast("long").alias("size"), sha1_base32(F.col("payload")).alias("digest"))
    own = stored(own, "warc-figures", keep=True)  # used three times; the payloads are read once
    first = own.where("record_type = 'response' and page_id is not null").groupBy(F.col("page_id").alias("source"), F.col("digest").alias("same")).agg(F.max("size").alias("seen"))
    revisits = own.where("record_type = 'revisit'").join(first, (F.col("refers_to") == F.col("source")) & (F.col("named_digest") == F.col("same")), "left")
    done = revisits.select("page_id", F.col("seen").alias("payload_bytes"), F.col("named_digest").alias("payload_digest"), "record_type", "refers_to")
    plain = own.where("record_type = 'response'").select("page_id", F.col("size").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type", "refers_to")
    return plain.unionByName(done)
