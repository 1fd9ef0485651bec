"""Tokens of two tokenizers over the same bytes: links, common cuts and how often two ids are linked in the corpus."""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackloom.llm.bpe import Codec
from trackloom.llm.common import limit_batches, room, stored

#: A document of more A tokens is walked by several lanes at once, so a long one does not run on alone.
LANE = 1024
#: Chunks of text that a worker remembers the pieces of, and their greatest length; a full memory is emptied, which changes no result.
MAX_KNOWN, MAX_LENGTH = 200_000, 40

_CHUNK = re.compile(" +[^ ]*")


class PlainCodec(Codec):
    """A byte-level tokenizer to which the strings of special tokens are ordinary text.

    With a token for each byte, as is checked, its tokens always spell the text.
    """

    def __init__(self, path: str) -> None:
        super().__init__(path)
        self.tokenizer.encode_special_tokens = True
        if len({x for x in self.bytes_of if len(x) == 1}) < 256:
            raise ValueError("a byte without a token of its own")


class Pieces:
    """A sentencepiece model that adds a space in front, encoding chunk by chunk where that is sure to be the same.

    If no piece holds a space behind another character, no merge crosses the place before a run of spaces, so
    what stands between such places is encoded once and remembered. Other models encode whole texts.
    """

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor
        from sentencepiece.sentencepiece_model_pb2 import ModelProto

        self.model = SentencePieceProcessor(model_file=path)
        said = ModelProto()
        with open(path, "rb") as f:
            said.ParseFromString(f.read())
        rules = said.normalizer_spec
        names = [p.piece for p in said.pieces]
        plain = rules.name == "identity" and rules.add_dummy_prefix and not rules.remove_extra_whitespaces and said.trainer_spec.model_type == 2
        self.by_chunk = plain and "▁" in names and not any("▁" in n.lstrip("▁") or p.type == 4 for n, p in zip(names, said.pieces, strict=True))
        self.bytes_of = [bytes([int(n[3:5], 16)]) if self.model.is_byte(i) else n.replace("▁", " ").encode() for i, n in enumerate(names)]
        self.space = self.model.piece_to_id("▁")
        self.known: dict[str, bytes | None] = {}

    def encode(self, texts: list[str]) -> list[bytes | None]:
        """The ids of each text as little-endian unsigned 32-bit integers; None if their bytes are not a space and the text.

        Bytes are compared chunk by chunk, when a chunk is encoded.
        """
        if len(self.known) > MAX_KNOWN:
            self.known.clear()
        cut = [_CHUNK.findall(" " + t) if self.by_chunk else [" " + t] for t in texts]
        fresh = list({c for chunks in cut for c in chunks} - self.known.keys())
        made = dict(zip(fresh, self.model.encode([c[1:] for c in fresh], num_threads=1), strict=True))
        if " " in made and self.by_chunk:
            made[" "] = [self.space]  # the model adds no space to nothing
        made = {c: array("I", ids).tobytes() if b"".join([self.bytes_of[i] for i in ids]) == c.encode() else None for c, ids in made.items()}
        self.known |= made
        known, out = self.known, []
        for chunks in cut:
            ids = [known[c] for c in chunks]
            out.append(None if None in ids else b"".join(ids))
        for c in made:
            if len(c) > MAX_LENGTH:
                del known[c]
        return out


@lru_cache(maxsize=2)
def tokenizers_of(a_path: str, b_path: str) -> tuple[PlainCodec, Pieces]:
    """A worker process keeps them, and what they remember, from task to task."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return PlainCodec(a_path), Pieces(b_path)


def lockstep(a_ends: np.ndarray, b_ends: np.ndarray, first: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(links' A tokens, links' B tokens, A tokens that end a group, B tokens that do) of all lanes at once.

    a_ends and b_ends are the byte ends of the tokens of all documents, one behind the other. Lane i walks the A
    tokens from first[i] to stop[i]. One vector holds the A and B pointers of all lanes: each step links what
    they point to, cuts where both tokens end, moves on the pointer of whatever token ends first, or both,
    and drops the lanes that are through.
    """
    a = first
    starts = np.where(a > 0, a_ends[a - 1], 0)
    b = np.searchsorted(b_ends, starts, "right")
    links_a, links_b, cuts_a, cuts_b = [], [], [], []
    while len(a):
        links_a.append(a)
        links_b.append(b)
        a_end, b_end = a_ends[a], b_ends[b]
        cut = a_end == b_end
        cuts_a.append(a[cut])
        cuts_b.append(b[cut])
        a, b = a + (a_end <= b_end), b + (b_end <= a_end)
        on = a < stop
        if not on.all():
            a, b, stop = a[on], b[on], stop[on]
    join = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
    return join(links_a), join(links_b), join(cuts_a), join(cuts_b)


class Aligner:
    """Aligns batches of texts with two tokenizers."""

    def __init__(self, a_path: str, b_path: str) -> None:
        self.a, self.b = tokenizers_of(a_path, b_path)
        self.a_size, self.b_size = (np.array([len(x) for x in c.bytes_of], np.int64) for c in (self.a, self.b))
        spelled = lambda n, end: np.array([b"%d%s" % (i, end) for i in range(n)], object)
        self.names = [(spelled(len(s), b","), spelled(len(s), end)) for s, end in ((self.a_size, b"|"), (self.b_size, b";"))]

    def encode(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """The ids of both, or None for a text that is empty or whose bytes one of them does not give back."""
        texts = [t or "" for t in texts]
        pieces = self.b.encode(texts)
        return [(np.frombuffer(self.a.encode(" " + t), "<u4"), np.frombuffer(b, "<u4")) if t and b is not None else None for t, b in zip(texts, pieces, strict=True)]

    def batch(self, texts: list[str | None]) -> dict:
        """The figures of each text, and the linked id pairs of all with their numbers of links.

        A pair is the A id times the size of B's vocabulary, plus the B id. places and times give, for each
        text, which of the pairs it has and how often.
        """
        ids = self.encode(texts)
        n = len(ids)
        none = np.zeros(0, np.int64)
        a = np.concatenate([none, *[x[0] for x in ids if x]]).astype(np.int64)
        b = np.concatenate([none, *[x[1] for x in ids if x]]).astype(np.int64)
        n_a, n_b = (np.array([len(x[k]) if x else 0 for x in ids], np.int64) for k in (0, 1))
        a_from, b_from = (np.concatenate([[0], np.cumsum(x)]) for x in (n_a, n_b))
        lanes = (n_a + LANE - 1) // LANE
        owner = np.repeat(np.arange(n), lanes)
        first = a_from[owner] + (np.arange(len(owner)) - np.repeat(np.cumsum(lanes) - lanes, lanes)) * LANE
        stop = np.minimum(first + LANE, a_from[owner + 1])
        link_a, link_b, cut_a, cut_b = lockstep(np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b]), first, stop)

        doc = np.repeat(np.arange(n), n_a)
        owner = doc[link_a]
        pairs, place = np.unique(a[link_a] * len(self.b_size) + b[link_b], return_inverse=True)
        own, times = np.unique(owner * max(1, len(pairs)) + place, return_counts=True)
        bounds = np.searchsorted(own, np.arange(n + 1) * max(1, len(pairs)))
        return {
            "n_a": n_a,
            "n_b": n_b,
            "n_groups": np.bincount(doc[cut_a], minlength=n),
            "n_links": np.bincount(owner, minlength=n),
            "groups": self.spelled(a, b, cut_a, cut_b, a_from, b_from),
            "pairs": pairs,
            "links": np.bincount(place, minlength=len(pairs)),
            "places": [own[i:j] - k * len(pairs) for k, (i, j) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True))],
            "times": [times[i:j] for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)],
        }

    def spelled(self, a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray, a_from: np.ndarray, b_from: np.ndarray) -> list[bytes]:
        """The groups of each text, as in a1,a2|b1;a3|b2,b3."""
        cut_a, cut_b = np.sort(cut_a), np.sort(cut_b)
        ends = [np.zeros(len(x), bool) for x in (a, b)]
        ends[0][cut_a], ends[1][cut_b] = True, True
        group = [np.cumsum(e) - e for e in ends]  # of each token
        before = np.concatenate([[0], cut_b + 1])[group[0]] if len(a) else group[0]  # B tokens of the groups before an A token's
        upto = (cut_a + 1)[group[1]] if len(b) else group[1]  # A tokens up to the end of a B token's group
        both = np.empty(len(a) + len(b), object)
        for at, x, e, (inner, last) in ((np.arange(len(a)) + before, a, ends[0], self.names[0]), (np.arange(len(b)) + upto, b, ends[1], self.names[1])):
            both[at] = np.where(e, last[x], inner[x])
        words, marks = both.tolist(), (a_from + b_from).tolist()
        return [b"".join(words[i:j])[:-1] for i, j in zip(marks[:-1], marks[1:], strict=True)]


def _small(x: np.ndarray) -> bytes:
    """Numbers in as few bytes each as hold the largest; the first byte tells how many."""
    kind = next(k for k in (1, 2, 4, 8) if x.max(initial=0) < 1 << 8 * k)
    return bytes([kind]) + x.astype(f"<u{kind}").tobytes()


def _large(x: bytes) -> np.ndarray:
    return np.frombuffer(x, f"<u{x[0]}", offset=1).astype(np.int64)


FIGURES = ("n_a", "n_b", "n_groups", "n_links")


def aligned(docs: DataFrame, a_path: str, b_path: str, text: str = "text", columns: list[str] | None = None, with_groups: bool = False) -> DataFrame:
    """The first pass: a row for each document and one for each batch of them (block), stored in the shared folder.

    A document's row has its figures and which pairs of its block it has how often; the block's own row, whose
    place is null, has the pairs. So pairs leave the block once, however many documents have them.
    """
    names = columns or docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col(f"`{text}`").cast("string").alias("body"))
    figures = "".join(f"{k} long, " for k in FIGURES)
    added = T._parse_datatype_string(f"block long, place int, {figures}groups_sha256 string, groups string, places binary, times binary, pairs array<long>, links array<long>")
    schema = T.StructType([T.StructField("row", rows.schema["row"].dataType), *added.fields])
    from pyspark.sql.pandas.types import to_arrow_schema

    types = {f.name: f.type for f in to_arrow_schema(added)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(a_path, b_path)
        for i, batch in enumerate(batches):
            block = (TaskContext.get().partitionId() << 31) + i
            got = aligner.batch(batch.column(1).to_pylist())
            n = batch.num_rows
            spelled = [g.decode() for g in got["groups"]]
            cols = {
                "block": [block] * n,
                "place": list(range(n)),
                **{k: got[k] for k in FIGURES},
                "groups_sha256": [hashlib.sha256(g).hexdigest() if g else "" for g in got["groups"]],
                "groups": spelled if with_groups else [None] * n,
                "places": [_small(np.diff(x, prepend=0)) for x in got["places"]],
                "times": [_small(x) for x in got["times"]],
                "pairs": [None] * n,
                "links": [None] * n,
            }
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(v, type=types[k]) for k, v in cols.items()]], ["row", *cols])
            head = {"block": [block], "pairs": [got["pairs"]], "links": [got["links"]]}
            yield pa.RecordBatch.from_arrays([pa.nulls(1, batch.column(0).type), *[pa.array(head.get(k, [None]), type=types[k]) for k in cols]], ["row", *cols])

    limit_batches(docs.sparkSession)
    return stored(rows.mapInArrow(run, schema), "aligned", "zstd")


def block_pairs(made: DataFrame) -> DataFrame:
    """(block, at, pair, n): the pairs of each block with their numbers of links."""
    zipped = made.where("place is null").select("block", F.posexplode(F.arrays_zip("pairs", "links")).alias("at", "x"))
    return zipped.select("block", "at", F.col("x.pairs").alias("pair"), F.col("x.links").alias("n"))


def pair_counts(made: DataFrame, b_path: str) -> DataFrame:
    """(pair, count, best) over the corpus: count is how many links hold the pair, best whether none of its B id has more.

    The largest counts are a row for each B id at most, so the vocabulary bounds what is broadcast.
    """
    size = Pieces(b_path).model.get_piece_size()
    counts = stored(block_pairs(made).groupBy("pair").agg(F.sum("n").alias("count")), "pair-counts")
    most = counts.groupBy((F.col("pair") % size).alias("b")).agg(F.max("count").alias("most"))
    return counts.join(F.broadcast(most), F.col("pair") % size == F.col("b")).select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def align(docs: DataFrame, a_path: str, b_path: str, text: str = "text", columns: list[str] | None = None, with_groups: bool = False) -> DataFrame:
    """(row, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256[, groups]) for every row of docs.

    A, a byte-level tokenizer file, encodes a space and the text; B, a sentencepiece model that adds a space
    itself, the text; strings of special tokens are plain text to both. Links are all pairs of an A and a B
    token whose bytes overlap; groups are what lies between the places where tokens of both end. A pair's
    count is how many links in the whole corpus hold its two ids; n_best counts links whose pair has the
    largest count of its B id, ties included, count_sum adds up the counts of all links. groups spells the
    ids group by group. A null or empty text, or one whose bytes one tokenizer does not give back, has no
    tokens: zeros and an empty string. row holds the columns named, all if None.

    Texts are read and encoded once. Pairs are counted in blocks of up to 512 rows before they are shuffled,
    the corpus's counts go back to each block once, and documents meet them there, block by block. The result is
    stored; what led to it is removed.
    """
    spark = docs.sparkSession
    with room(spark):
        made = aligned(docs, a_path, b_path, text, columns, with_groups)
        told = block_pairs(made).join(pair_counts(made, b_path), "pair").select(F.col("block").alias("home"), "at", "count", "best")
        own = made.where("place is not null").drop("place", "pairs", "links")
        kept = [f for f in own.schema.fields if f.name not in ("block", "places", "times", *([] if with_groups else ["groups"]))]
        schema = T.StructType([*kept, *T._parse_datatype_string("n_best long, count_sum long").fields])

        def meet(left: pa.Table, right: pa.Table) -> pa.Table:
            n = right.num_rows
            at, count, best = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, bool)
            if n:
                at = right.column("at").to_numpy()
                count[at], best[at] = right.column("count").to_numpy(), right.column("best").to_numpy(zero_copy_only=False)
            n_best, total = [], []
            for places, times in zip(left.column("places").to_pylist(), left.column("times").to_pylist(), strict=True):
                p, k = np.cumsum(_large(places)), _large(times)
                n_best.append(int(k[best[p]].sum()))
                total.append(int((k * count[p]).sum()))
            out = left.select([f.name for f in kept])
            return out.append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(total, pa.int64()))

        found = own.groupBy("block").cogroup(told.groupBy("home")).applyInArrow(meet, schema)
        return stored(found, "alignment", keep=True)
