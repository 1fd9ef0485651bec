"""Language identification with bit-sliced Bloom filters of letter trigrams."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trackloom.llm.common import held_out, limit_batches, map_texts, packed

UNKNOWN = "und"
_LETTERS = re.compile(r"[^\W\d_]+")


def trigrams(text: str) -> np.ndarray:
    """The runs of three characters of the lower-cased words, each word between spaces, as 63-bit numbers."""
    words = _LETTERS.findall(text.lower())
    if not all(map(str.isalpha, words)):  # the pattern lets other numerals through, such as fractions and powers
        words = "".join(c if c.isalpha() else " " for c in " ".join(words)).split()
    if not words:
        return np.zeros(0, np.uint64)
    codes = np.frombuffer(f" {' '.join(words)} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    return (codes[:-2] << np.uint64(42)) | (codes[1:-1] << np.uint64(21)) | codes[2:]


@dataclass(frozen=True)
class Filters:
    """One Bloom filter for each language, stored slot by slot: a slot's bits are the languages whose filter has it set."""

    langs: list[str]
    slots: np.ndarray  # (size, planes) of 64 languages each
    hashes: int
    false_rate: np.ndarray

    @staticmethod
    def of(grams: dict[str, np.ndarray], hashes: int = 4, least_bits: int = 14) -> Filters:
        """Filters of one size, of which the fullest sets about a third of its bits at most."""
        langs = sorted(grams)
        most = max((len(v) for v in grams.values()), default=0)
        bits = max(least_bits, (hashes * most * 5 // 2).bit_length())
        slots = np.zeros((1 << bits, max(1, -(-len(langs) // 64))), np.uint64)
        for i, lang in enumerate(langs):
            for at in places(grams[lang], bits, hashes):
                slots[at, i // 64] |= np.uint64(1 << (i % 64))
        full = np.array([((slots[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean() for i in range(len(langs))])
        return Filters(langs, slots, hashes, full**hashes)

    def languages(self, grams: np.ndarray) -> np.ndarray:
        """For each trigram the bits of all languages whose filter returns it."""
        bits = len(self.slots).bit_length() - 1
        at = places(grams, bits, self.hashes)
        masks = self.slots[at[0]]
        for more in at[1:]:
            masks = masks & self.slots[more]
        return masks

    def predict(self, text: str | None) -> tuple[str, float]:
        grams = trigrams(text or "")
        if not len(grams) or not self.langs:
            return UNKNOWN, 0.0
        masks = np.ascontiguousarray(self.languages(grams))
        ones = np.unpackbits(masks.view(np.uint8).reshape(len(grams), -1), axis=1, bitorder="little", count=len(self.langs)).sum(0, dtype=np.int64)
        share = np.maximum(0.0, (ones / len(grams) - self.false_rate) / np.maximum(1e-9, 1 - self.false_rate))
        best = int(share.argmax())
        return self.langs[best], float(share[best] / share.sum()) if share.sum() else 1.0 / len(self.langs)


def places(grams: np.ndarray, bits: int, hashes: int) -> list[np.ndarray]:
    x = grams * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    step = (x >> np.uint64(40)) | np.uint64(1)
    return [((x + np.uint64(j) * step) & np.uint64((1 << bits) - 1)).astype(np.int64) for j in range(hashes)]


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", per_lang: int = 2000, least_docs: int = 2, near: float = 0.3) -> Filters:
    """Filters from the labelled rows that are not held out.

    About per_lang rows of each language, drawn by a hash of the id, are read; so the model's cost is bounded
    by the number of languages. A language's filter holds those of its trigrams that occur in `least_docs` of them or more
    and are at least `near` times as common in it as in any other language.
    """
    rows = packed(docs, text).select(F.col("row").getField(doc_id).alias("id"), F.col("row").getField(lang).alias("lang"), "body").where(F.col("lang").isNotNull() & ~held_out(F.col("id")))
    counts = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}  # a row for each language
    if not counts:
        return Filters.of({})
    part = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, per_lang / n)))])
    sample = rows.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < part[F.col("lang")] * 1_000_000).select("lang", "body")

    def count(batches):
        for batch in batches:
            seen: dict[str, list[np.ndarray]] = {}
            for own, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seen.setdefault(own, []).append(np.unique(trigrams(body)))
            for own, parts in seen.items():
                grams, n = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([own] * len(grams), pa.string()), pa.array(grams.view(np.int64)), pa.array(n.astype(np.int64))], ["lang", "gram", "n"])

    limit_batches(docs.sparkSession)
    sums = sample.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    size = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(float(min(n, per_lang))))])
    rate = sums.withColumn("rate", F.col("n") / size[F.col("lang")])
    rate = rate.withColumn("top", F.max("rate").over(Window.partitionBy("gram"))).where(F.col("rate") >= near * F.col("top"))
    grams: dict[str, list[int]] = {k: [] for k in counts}
    for r in rate.where(F.col("n") >= least_docs).select("lang", "gram").collect():  # of a bounded sample
        grams[r[0]].append(r[1])
    return Filters.of({k: np.array(v, np.int64).view(np.uint64) for k, v in grams.items()})


def identify(docs: DataFrame, filters: Filters, text: str = "text") -> DataFrame:
    """(row, lang_pred, score) for every row of docs, without a shuffle.

    Every trigram of the whole text asks the filters for all languages that hold it; each language's share of
    the trigrams, less what false positives would add, is its count, and the largest decides. score is its
    part of the sum. A text that is null or has no letter is 'und' with score 0. Ties go to the language
    first in the alphabet.
    """
    model = docs.sparkSession.sparkContext.broadcast(filters)

    def make():
        own = model.value

        def work(texts: list) -> dict[str, list]:
            got = [own.predict(t) for t in texts]
            return {"lang_pred": [g[0] for g in got], "score": [g[1] for g in got]}

        return work

    return map_texts(packed(docs, text), "body", "lang_pred string, score double", make, drop=("body",))
