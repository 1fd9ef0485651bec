"""Byte-level BPE encoding and decoding with content-defined chunks that are encoded once and then joined exactly."""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame

from trackloom.llm.common import map_texts, packed

#: Bytes under the rolling hash, and the mean length of a chunk (a power of two).
WINDOW, MEAN = 12, 1024
#: The published pattern that splits text before the merges of byte-level vocabularies; a fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Entries of a worker's chunk cache; a full cache is emptied, which changes no result.
MAX_CHUNKS = 20_000

#: Characters that every edition of the pre-token pattern's classes agrees on.
_PLAIN = re.compile(r"[\t\n\r -~\u00a1-\u024f\u2010-\u2027\u2030-\u203a\u20ac]*")


def chunk_cuts(data: np.ndarray) -> np.ndarray:
    """Positions at which the rolling hash of the bytes before them says to cut; they depend on those bytes alone."""
    n = len(data) - WINDOW + 1
    if n < 2:
        return np.zeros(0, np.int64)
    sums = np.zeros(n, np.uint32)
    for j in range(WINDOW):
        sums *= np.uint32(0x01000193)
        sums += data[j : j + n]
    sums ^= sums >> np.uint32(15)
    sums *= np.uint32(0x2C1B3C6D)
    found = np.flatnonzero((sums >> np.uint32(12)) & np.uint32(MEAN - 1) == 0) + WINDOW
    return found[found < len(data)]


def safe_points(data: np.ndarray) -> np.ndarray:
    """Positions between a visible ASCII character and a space or newline: a pre-token ends there whatever stands around."""
    a, b = data[:-1], data[1:]
    return np.flatnonzero((a > 0x20) & (a < 0x7F) & ((b == 0x20) | (b == 0x0A))) + 1


def segments(data: bytes) -> list[bytes]:
    """The text as chunk bodies and the joins between them, in order.

    A chunk encoded on its own is right up to the last safe point before its end and from the first one after
    its start. So the text around a cut, between the nearest safe points on either side, is what has to be
    encoded again; a chunk without a safe point is part of one longer join.
    """
    view = np.frombuffer(data, np.uint8)
    cuts = chunk_cuts(view)
    if not len(cuts):
        return [data] if data else []
    safe = safe_points(view)
    after = np.searchsorted(safe, cuts)
    before = np.searchsorted(safe, cuts, "right") - 1
    bounds = np.concatenate([safe, [len(data), 0]])  # index -1 is the start, index len(safe) the end
    starts, stops = bounds[before], bounds[after]
    out, at = [], 0
    i = 0
    while i < len(cuts):
        lo, hi = int(starts[i]), int(stops[i])
        while i + 1 < len(cuts) and starts[i + 1] < hi:
            i += 1
            hi = max(hi, int(stops[i]))
        if lo > at:
            out.append(data[at:lo])
        if hi > max(lo, at):
            out.append(data[max(lo, at) : hi])
        at = max(at, hi)
        i += 1
    if at < len(data):
        out.append(data[at:])
    return out


class Codec:
    """Encodes and decodes with one tokenizer file; keeps the chunks that it has encoded."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            said = json.load(f)
        before = said.get("pre_tokenizer") or {}
        if before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True) or said.get("normalizer"):
            raise ValueError("the chunk joins are proved for plain byte-level BPE without an added first space")
        self.special = [x["content"] for x in said.get("added_tokens", [])]
        letters = byte_letters()
        self.bytes_of = [b""] * self.tokenizer.get_vocab_size(with_added_tokens=True)
        for token, n in self.tokenizer.get_vocab(with_added_tokens=True).items():
            try:
                self.bytes_of[n] = bytes(letters[c] for c in token)
            except KeyError:  # an added token with other characters stands for its own text
                self.bytes_of[n] = token.encode()
        self.fast = self.ranked(said["model"])
        self.chunk_ids: dict[bytes, bytes] = {}

    def ranked(self, model: dict):
        """An encoder by ranks, about three times as fast, where the order of the merges is that of the ids; else None."""
        import tiktoken

        vocab = model["vocab"]
        order = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        if order != sorted(set(order)) or model.get("ignore_merges") or model.get("dropout"):
            return None
        ranks = {self.bytes_of[n]: n for t, n in vocab.items() if t not in self.special}
        return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode_one(self, data: bytes) -> bytes:
        text = data.decode("utf-8")
        if self.fast and _PLAIN.fullmatch(text) and not any(s in text for s in self.special):
            ids = self.fast.encode_ordinary(text)
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return array("I", ids).tobytes()

    def encode(self, text: str) -> bytes:
        """The text's ids as little-endian unsigned 32-bit integers."""
        if len(self.chunk_ids) > MAX_CHUNKS:
            self.chunk_ids.clear()
        known, out = self.chunk_ids, []
        for segment in segments(text.encode("utf-8")):
            ids = known.get(segment)
            if ids is None:
                ids = self.encode_one(segment)
                known[segment] = ids
            out.append(ids)
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """The text of the ids, special tokens among them."""
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec_of(path: str) -> Codec:
    """A worker process keeps its codec, and the chunks in it, from task to task."""
    return Codec(path)


def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: printable ones themselves, the rest from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def encode_decode(docs: DataFrame, path: str, text: str = "text", with_ids: bool = False) -> DataFrame:
    """(row, n_tokens, ids_sha256, decoded_sha256[, ids, decoded]) for every row of docs, without a shuffle.

    Texts are cut into chunks where a rolling hash of their bytes says so, so what documents share is cut
    alike. Each chunk is encoded once in a worker and reused; the joins between chunks are encoded again
    between safe points. The cache is bounded and only saves time. path is a tokenizer file that every executor can read. A null or empty text has no tokens. With
    with_ids, ids is binary (little-endian unsigned 32-bit integers) and decoded the text.
    """
    added = "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary, decoded string" * with_ids

    def make():
        codec = codec_of(path)

        def work(texts: list) -> dict[str, list]:
            ids = [codec.encode(t or "") for t in texts]
            back = [codec.decode(x) for x in ids]
            return {
                "n_tokens": [len(x) // 4 for x in ids],
                "ids_sha256": [hashlib.sha256(x).hexdigest() for x in ids],
                "decoded_sha256": [hashlib.sha256(x.encode("utf-8")).hexdigest() for x in back],
                "ids": ids,
                "decoded": back,
            }

        return work

    return map_texts(packed(docs, text), "body", added, make, drop=("body",))
