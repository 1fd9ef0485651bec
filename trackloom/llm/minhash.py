"""Near-duplicate documents by ProbMinHash: weighted shingles, banded signatures, verified links, connected classes."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackloom.llm.common import cut, limit_batches, map_texts, packed, small, stored, text_key

SHINGLE = 5
#: Bands of a signature and registers in each. At a similarity of 0.8, weighted or not, a pair meets in some band with probability 1 - 3e-5.
BANDS, ROWS = 20, 4
THRESHOLD = 0.8
#: Members of a bucket that all others are compared with first, at most; FIRST, or LARGE in buckets of more than LATER members.
FIRST, LATER, LARGE = 4, 32, 2
#: A bucket of more than LATER members is compared in blocks of about so many members and bytes of shingles, so many distinct shingles at a time.
BLOCK, BLOCK_BYTES, COLUMNS = 400, 6 << 20, 2048
#: Words whose hashes a worker remembers; a full memory is emptied.
MAX_WORDS = 150_000

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_SPACED = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > MAX_WORDS:
            self.clear()
        self[word] = got = xxhash.xxh64_intdigest(word)
        return got


_HASHES = WordHashes()


def word_list(text: str) -> list[bytes]:
    """Runs of letters, digits and non-ASCII characters, A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").translate(_LOWER).translate(_SPACED).split()


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the runs of five words, each once and in order, and how often each occurs. Fewer words make one shingle."""
    ids = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    width = min(SHINGLE, len(ids))
    runs = np.zeros(len(ids) - width + 1, np.uint64)
    for j in range(width):
        runs = runs * np.uint64(0x9E3779B97F4A7C15) + ids[j : j + len(runs)]
    return np.unique(mix(runs + np.uint64(width)), return_counts=True)


def signature(elements: np.ndarray, weights: np.ndarray, registers: int = BANDS * ROWS) -> np.ndarray:
    """ProbMinHash: two weighted sets agree in a register with a probability equal to their probability Jaccard.

    Each element sends arrivals of a Poisson process, at a rate of its weight, to registers drawn at random;
    a register keeps the element that came first. An element stops once its next arrival would come after
    the latest first arrival of all registers.
    """
    best = np.full(registers, np.inf)
    held = np.zeros(registers, np.uint64)
    at = np.zeros(len(elements))
    step = 0
    while len(elements):
        many = max(1, -(-2 * registers // len(elements)))
        nth = np.arange(step + 1, step + many + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        bits = mix(elements[:, None] + nth)
        gaps = np.log(((bits >> np.uint64(32)) + 0.5) * 2.0**-32)  # the high half is the time, the low half the register
        gaps /= weights[:, None]
        times = at[:, None] - (np.cumsum(gaps, 1) if many > 1 else gaps)
        places = (((bits & np.uint64(0xFFFFFFFF)) * np.uint64(registers)) >> np.uint64(32)).astype(np.int64)
        np.minimum.at(best, places.ravel(), times.ravel())
        row, col = np.nonzero(times == best[places])
        held[places[row, col]] = elements[row]
        at = times[:, -1]
        go_on = at < best.max()
        elements, weights, at = elements[go_on], weights[go_on], at[go_on]
        step += many
    return held


def band_hashes(held: np.ndarray) -> list[int]:
    rows = held.reshape(BANDS, ROWS)
    sums = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for j in range(ROWS):
        sums = mix(sums + rows[:, j])
    return sums.view(np.int64).tolist()


def bands_of(words: list[bytes]) -> list[int]:
    """The buckets of a text: by its weighted shingles and, where some shingle repeats, by the set of them too."""
    elements, counts = shingles(words)
    bands = band_hashes(signature(elements, counts))
    if (counts > 1).any():
        bands += band_hashes(signature(elements, np.ones(len(elements))))
    return bands


def _signed(rows: DataFrame) -> DataFrame:
    """(text_key, key, bands): key stands for the sequence of words, so texts that differ in case or marks only share it; null without words."""

    def make() -> Callable:
        def one(text: str) -> tuple[bytes | None, list[int] | None]:
            words = word_list(text)
            if not words:
                return None, None
            return hashlib.md5(b" ".join(words)).digest(), bands_of(words)

        def work(texts: list) -> dict[str, list]:
            got = [one(t) for t in texts]
            return {"key": [g[0] for g in got], "bands": [g[1] for g in got]}

        return work

    return map_texts(rows.select("text_key", "body"), "body", "key binary, bands array<long>", make, drop=("body",))


def _sets(texts: DataFrame) -> DataFrame:
    """(key, marks, counts): shingles as sorted 32-bit hashes, and their counts where one exceeds 1.

    Two texts of n shingles have about n * n / 2**32 chance meetings among them, too few to move a similarity.
    """

    def make() -> Callable:
        def one(text: str) -> tuple[bytes, bytes]:
            elements, counts = shingles(word_list(text))
            marks, at = np.unique((elements >> np.uint64(32)).astype(np.uint32), return_inverse=True)
            summed = np.bincount(at, counts).astype(np.uint32)
            return marks.tobytes(), summed.tobytes() if (summed > 1).any() else b""

        def work(texts: list) -> dict[str, list]:
            got = [one(t) for t in texts]
            return {"marks": [g[0] for g in got], "counts": [g[1] for g in got]}

        return work

    return map_texts(texts, "body", "marks binary, counts binary", make, drop=("body",))


def similarity(a: bytes, b: bytes, a_counts: bytes = b"", b_counts: bytes = b"") -> float:
    """The larger of the Jaccard similarity of two shingle sets and their probability Jaccard; equal where no shingle repeats."""
    x, y = np.frombuffer(a, np.uint32), np.frombuffer(b, np.uint32)
    both, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    plain = len(both) / (len(x) + len(y) - len(both))
    if not len(both) or not (a_counts or b_counts):
        return plain
    u = np.frombuffer(a_counts, np.uint32).astype(float) if a_counts else np.ones(len(x))
    v = np.frombuffer(b_counts, np.uint32).astype(float) if b_counts else np.ones(len(y))
    ratios, of = np.unique(u[i] / v[j], return_inverse=True)
    rest_u, rest_v = u.sum() - u[i].sum(), v.sum() - v[j].sum()
    spans = np.array([np.maximum(u[i], v[j] * r).sum() + rest_u + rest_v * r for r in ratios])
    return max(plain, float((u[i] / spans[of]).sum()))


def _verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Those of the pairs (a, b) whose similarity reaches the threshold."""
    of = lambda c: sets.select(F.col("key").alias(c), F.col("marks").alias(f"{c}_marks"), F.col("counts").alias(f"{c}_counts"))
    both = pairs.join(of("b"), "b").join(of("a"), "a")

    def run(batches):
        for t in batches:
            cols = [t.column(t.schema.get_field_index(c)).to_pylist() for c in ("a_marks", "b_marks", "a_counts", "b_counts")]
            near = pa.array([similarity(*x) >= threshold for x in zip(*cols, strict=True)], pa.bool_())
            yield t.select(["a", "b"]).filter(near)

    limit_batches(pairs.sparkSession)
    return both.mapInArrow(run, "a binary, b binary")


def components(edges: DataFrame) -> DataFrame:
    """(key, root): root is the least key of the component that the edges (a, b) put a key in.

    Large and small stars in turn: each key hands its larger, then its smaller neighbours its least one,
    until only stars are left. Least neighbours are found with sums inside the map tasks and stored, so a hub
    is no single task's work: the join with them is a broadcast, or can be split. A table in the shared folder cuts the lineage after each turn.
    """

    def stars(e: DataFrame) -> DataFrame:
        around = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = small(around.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
        large = around.join(least, "a").where("b > a and b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = small(large.groupBy("a").agg(F.min("b").alias("m")))
        lower = large.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return lower.unionByName(least.select("a", F.col("m").alias("b"))).distinct()

    def done(e: DataFrame) -> bool:
        """Whether each key has one root, which is no key's child."""
        own = e.groupBy("a").agg(F.count("*").alias("n"), F.min("b").alias("b"))
        roots = own.select("b").distinct()
        return own.where("n > 1").isEmpty() and roots.join(own.select(F.col("a").alias("b")), "b", "left_semi").isEmpty()

    now = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct())
    while not done(now):
        now = cut(stars(now))
    roots = now.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("key"), "root")
    return roots.unionByName(roots.select(F.col("root").alias("key"), "root").distinct())


def classes(rows: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(text_key, class) for every text of rows (text_key, body) that has words; class is a key, equal for near-duplicates.

    Texts with the same words are one from the start. The others meet in buckets, one for each band. All
    members of a bucket are compared with a few of them, and what passes is linked. Buckets of up to LATER
    members that are still of several classes get all their pairs, larger ones all pairs of different
    classes, block against block. So every pair of texts that shares a bucket is linked, or in one class, if it is similar.
    What is known of a bucket is worked out with sums inside the map tasks and stored, so that joins on the bucket
    can be split where one is hot.
    """
    signed = stored(_signed(rows), "signatures").where("key is not null")
    keys = cut(signed.groupBy("key").agg(F.first("bands").alias("bands"), F.min("text_key").alias("text_key")))
    filed = keys.select("key", F.explode(F.array_distinct("bands")).alias("band"))
    number = F.xxhash64("key")
    shared = small(filed.groupBy("band").agg(F.min(number).alias("low"), F.max(number).alias("high"), F.count("*").alias("n")).where("low != high").select("band", "n"))
    lying = filed.join(shared, "band").groupBy("key").agg(F.collect_list(F.struct("band", "n")).alias("at"), F.sum("n").alias("weight"))
    members = stored(lying.select("key", "weight", F.inline("at")), "buckets")
    chosen = small(keys.select("key", "text_key").join(members.select("key").distinct(), "key", "left_semi"))
    texts = rows.join(chosen, "text_key").groupBy("key").agg(F.first("body").alias("body"))
    sets = stored(_sets(texts), "shingles")

    def stars() -> DataFrame:
        """Each member of a bucket with its centres.

        A bucket's members are dealt by their hash, and the first of each hand is a centre. The order is one for all
        buckets, so a class has much the same centres in each of its buckets. A text in many large buckets comes first:
        it lies amid its group, so that more of the group is near to it than to others.
        """
        hand = F.pmod(F.xxhash64("key"), F.when(F.col("n") <= LATER, FIRST).otherwise(LARGE))
        first = members.groupBy("band", hand.alias("hand")).agg(F.min(F.struct((-F.col("weight")).alias("weight"), "key")).alias("first"))
        centres = small(first.select("band", F.col("first.key").alias("a")))
        star = members.select("band", F.col("key").alias("b")).join(centres, "band").where("a != b")
        return star.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    def mixed(roots: DataFrame, of: DataFrame) -> DataFrame:
        """Those of the members, with their classes, whose buckets are of several classes."""
        placed = of.join(roots, "key", "left").select("band", "key", F.coalesce("root", "key").alias("root"))
        number = F.xxhash64("root")
        several = placed.groupBy("band").agg(F.min(number).alias("r"), F.max(number).alias("s")).where("r != s").select("band")
        return placed.join(small(several), "band", "left_semi")

    def merged(roots: DataFrame, links: DataFrame) -> DataFrame:
        """roots after the classes that links (a, b) name have become one."""
        joined = cut(components(links))
        moved = joined.select(F.col("key").alias("root"), F.col("root").alias("new"))
        known = roots.join(moved, "root", "left").select("key", F.coalesce("new", "root").alias("root"))
        return cut(known.unionByName(joined.join(roots, "key", "left_anti")))

    tried = cut(stars())
    roots = cut(components(_verified(tried, sets, threshold)))
    few = cut(mixed(roots, members.where(F.col("n") <= LATER)))
    ends = lambda c: few.select("band", F.col("key").alias(c), F.col("root").alias(f"{c}_root"))
    later = ends("a").join(ends("b"), "band").where("a < b and a_root != b_root").drop("band").distinct()
    fresh = cut(later.join(tried, ["a", "b"], "left_anti"))
    links = fresh.join(_verified(fresh.select("a", "b"), sets, threshold), ["a", "b"])
    roots = merged(roots, links.select(F.col("a_root").alias("a"), F.col("b_root").alias("b")))
    large = cut(mixed(roots, members.where(F.col("n") > LATER)))
    if not large.isEmpty():
        roots = merged(roots, _block_links(large, sets, threshold))
    return signed.select("text_key", "key").distinct().join(roots, "key", "left").select("text_key", F.coalesce("root", "key").alias("class"))


def _block_links(large: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """(a, b): classes that some pair within a bucket of large (band, key, root) links; what is left out follows from the rest.

    A bucket is split into blocks of about BLOCK members and BLOCK_BYTES of shingles, and every two blocks meet
    in a group of their own, so no task holds a whole bucket. Classes that fill blocks alone have
    blocks of their own, which do not meet each other: only members of different classes are compared.
    A group tells at most one link for each class in it. A block that no member is hashed to has groups of one side.
    """
    sized = large.join(sets.select("key", (F.octet_length("marks") + F.octet_length("counts")).alias("bytes")), "key")
    parts = lambda: F.ceil(F.greatest(F.sum("n") / BLOCK, F.sum("bytes") / BLOCK_BYTES)).cast("long")
    own = sized.groupBy("band", "root").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))
    fills = (F.col("n") >= BLOCK) | (F.col("bytes") >= BLOCK_BYTES)
    own = own.withColumn("alone", F.when(fills, F.col("root")).otherwise(F.lit(b"")))
    split = small(own.groupBy("band", "alone").agg(parts().alias("parts")))
    filling = small(own.where(F.col("alone") != F.lit(b"")).select("band", "root", "alone"))
    block = lambda part: F.xxhash64("alone", part)
    blocks = split.select("band", F.col("alone").alias("other_alone"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    blocks = small(blocks.select("band", "other_alone", F.xxhash64("other_alone", "part").alias("other")))

    lying = large.join(filling, ["band", "root"], "left").withColumn("alone", F.coalesce("alone", F.lit(b"")))
    lying = lying.join(split, ["band", "alone"]).withColumn("block", block(F.pmod(F.xxhash64("key"), "parts")))
    lying = lying.join(sets, "key").join(blocks, "band").where((F.col("alone") != F.col("other_alone")) | (F.col("alone") == F.lit(b"")))
    ends = {"low": F.least("block", "other"), "high": F.greatest("block", "other")}
    sent = lying.select("band", *[c.alias(n) for n, c in ends.items()], "block", "root", "marks", "counts")

    def meet(group: pa.Table) -> pa.Table:
        low, high = group.column("low")[0].as_py(), group.column("high")[0].as_py()
        at = group.column("block").to_numpy()
        rows = [group.column(c).to_pylist() for c in ("root", "marks", "counts")]
        left, right = np.flatnonzero(at == low), np.flatnonzero(at == high)
        found = class_links(*rows, left, right, threshold) if len(left) and len(right) else []
        return pa.table({"a": pa.array([f[0] for f in found], pa.binary()), "b": pa.array([f[1] for f in found], pa.binary())})

    return sent.groupBy("band", "low", "high").applyInArrow(meet, "a binary, b binary").distinct()


def class_links(roots: list[bytes], marks: list[bytes], counts: list[bytes], left: np.ndarray, right: np.ndarray, threshold: float) -> list[tuple[bytes, bytes]]:
    """Links (class, other class) that join just the classes which near pairs of a left and a right text join.

    Numbers of shared shingles come from products of incidence matrices, COLUMNS shingles at a time. The
    probability Jaccard is never above the share of a text's shingles, with their counts, that the other
    text has, so it is worked out only for pairs that this share lets through.
    """
    names, of = np.unique(np.array(roots, object), return_inverse=True)
    sets = [np.frombuffer(m, np.uint32) for m in marks]
    sizes = np.array([len(s) for s in sets])
    repeats = np.array([bool(c) for c in counts])
    _, column = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    shares = [np.frombuffer(c, np.uint32) if c else np.ones(n) for c, n in zip(counts, sizes, strict=True)]
    share = np.concatenate([(s / s.sum()).astype(np.float32) for s in shares])

    def entries(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The row's place, column and share of every shingle of the rows, by column."""
        flat = np.concatenate([np.arange(starts[r], starts[r + 1]) for r in rows])
        order = flat[np.argsort(column[flat], kind="stable")]
        place = np.repeat(np.arange(len(rows)), sizes[rows])[np.argsort(column[flat], kind="stable")]
        return place, column[order], share[order]

    sides = [entries(left), entries(right)]
    both = np.intersect1d(sides[0][1], sides[1][1])
    shape = (len(left), len(right))
    shared, mass_left, mass_right = np.zeros(shape), np.zeros(shape), np.zeros(shape)
    for first in range(0, len(both), COLUMNS):
        some = both[first : first + COLUMNS]
        cut_out = []
        for (place, col, part), n in zip(sides, shape, strict=True):
            lo, hi = np.searchsorted(col, some[0], "left"), np.searchsorted(col, some[-1], "right")
            spot = np.searchsorted(some, col[lo:hi])
            stay = some[spot] == col[lo:hi]
            there, mass = np.zeros((n, len(some)), np.float32), np.zeros((n, len(some)), np.float32)
            there[place[lo:hi][stay], spot[stay]] = 1
            mass[place[lo:hi][stay], spot[stay]] = part[lo:hi][stay]
            cut_out.append((there, mass))
        (x, x_mass), (y, y_mass) = cut_out
        shared += x @ y.T
        if repeats.any():
            mass_left += x_mass @ y.T
            mass_right += x @ y_mass.T
    apart = of[left][:, None] != of[right][None, :]
    near = apart & (shared / (sizes[left][:, None] + sizes[right][None, :] - shared) >= threshold)
    label = np.arange(len(names))

    def link(a: np.ndarray, b: np.ndarray) -> None:
        while (label[a] != label[b]).any():
            least = np.minimum(label[a], label[b])
            for ends in (a, b):
                np.minimum.at(label, label[ends], least)
            label[:] = label[label]

    i, j = np.nonzero(near)
    link(of[left[i]], of[right[j]])
    if repeats.any():
        maybe = apart & ~near & (repeats[left][:, None] | repeats[right][None, :]) & (np.minimum(mass_left, mass_right) >= threshold - 1e-4)
        for r, s in zip(*np.nonzero(maybe), strict=True):
            a, b = left[r], right[s]
            if label[of[a]] != label[of[b]] and similarity(marks[a], marks[b], counts[a], counts[b]) >= threshold:
                link(of[[a]], of[[b]])
    return [(names[k], names[label[k]]) for k in np.flatnonzero(label != np.arange(len(names)))]


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(id, text_key, class, class_id, n_in_class) for every row of docs: class_id is the least id of its near-duplicates.

    Documents whose five-word shingles have a similarity of 0.8 or more, by their sets or with their counts, are
    linked, and links make classes. Equal texts are of one class. A null or empty text is alone in its class, as is
    one that nothing is linked to. Repeated rows count as copies; null ids are in classes but never their class_id unless
    alone.
    """
    rows = packed(docs, text).select(F.col("row").getField(doc_id).alias("id"), "body", text_key(F.col("body")).alias("text_key"))
    found = small(classes(rows.select("text_key", "body"), threshold))
    same = F.coalesce("class", F.when(F.col("filled"), F.col("text_key")))
    slim = rows.select("id", "text_key", (F.col("body") != "").alias("filled"))  # texts stay where they are
    own = cut(slim.join(found, "text_key", "left").select("id", "text_key", same.alias("class")))
    sums = small(own.where("class is not null").groupBy("class").agg(F.min("id").alias("class_id"), F.count("*").alias("n_in_class")))
    joined = own.join(sums, "class", "left")
    return joined.select("id", "text_key", F.coalesce("class", "text_key").alias("class"), F.coalesce("class_id", "id").alias("class_id"), F.coalesce("n_in_class", F.lit(1)).cast("long").alias("n_in_class"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs with one of each class, that with the least id, and every row with an empty text.

    If several rows of a class have its least id, that with the least text hash stays, and one of rows that are equal in id and text.
    """
    found = cut(near_duplicates(docs, doc_id, text, threshold))
    least = F.col("id").eqNullSafe(F.col("class_id"))
    gone = found.where(~least).select("id", "text_key")
    again = cut(found.where(least).groupBy("id", "class").agg(F.min("text_key").alias("stays"), F.count("*").alias("n")).where("n > 1"))
    repeated = not again.isEmpty()
    if repeated:
        both = found.where(least).alias("f").join(again.alias("g"), F.expr("f.id <=> g.id and f.class = g.class"))
        gone = gone.unionByName(both.where("f.text_key != g.stays").select("f.id", "f.text_key"))
    gone = small(gone.distinct().select(F.col("id").alias("gone_id"), F.col("text_key").alias("gone_key")))
    rows = packed(docs, text).select("row", F.col("row").getField(doc_id).alias("id"), text_key(F.col("body")).alias("key"))
    kept = rows.join(gone, F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("key") == F.col("gone_key")), "left_anti")
    return (kept.dropDuplicates(["id", "key"]) if repeated else kept).select("row.*")
