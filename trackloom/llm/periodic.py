"""Stretches of text that repeat a block of words three times or more, found by string synchronising sets."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from trackloom.llm.common import map_texts, packed

#: Periods up to this are compared directly; they are what the smallest scale of synchronising sets leaves out.
DIRECT = 9
#: Marks positions that a scale leaves out; larger than any hash that counts.
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit hash of 64-bit numbers."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def doubled(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all blocks of 2 k words, of those of k words."""
    return mixed(hashes[:-k] * np.uint64(0xD6E8FEB86659FD93) + hashes[k:])


def stretches(ids: np.ndarray, p: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the longest stretches in which words p apart are equal."""
    same = np.zeros(len(ids) - p + 2, np.int8)
    same[1:-1] = ids[p:] == ids[:-p]
    edges = np.flatnonzero(np.diff(same))
    return edges[::2], edges[1::2] + p


def synchronising(hashes: np.ndarray, t: int, periodic: np.ndarray) -> np.ndarray:
    """The positions of a t-synchronising set, of the hashes of all blocks of t words.

    A position belongs to it if the least hash of the t + 1 blocks from there on is that of the first or the
    last one; so the 2 t words from there on decide it, wherever they stand. Blocks marked periodic (of period
    t / 3 or less) don't count, so at most a few positions of any t are chosen, and one at least unless the
    3 t - 1 words around have such a period.
    """
    own = np.where(periodic, _NONE, hashes)
    least, w = own, 1
    while w < t:
        least = np.minimum(least[:-w], least[w:])
        w *= 2
    least = np.minimum(least[:-1], least[1:])
    return np.flatnonzero((least != _NONE) & ((own[: len(least)] == least) | (own[t:] == least)))


def pairs(at: np.ndarray, context: np.ndarray, least: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(periods, positions) of all pairs of positions with equal contexts from least to most words apart, by period, then position.

    Positions are as sparse as the scale is coarse, so each has a few partners within `most` words.
    """
    order = np.lexsort((at, context))
    at, context = at[order], context[order]
    gaps, starts, k = [], [], 1
    while k < len(at):
        gap = at[k:] - at[:-k]
        near = (context[k:] == context[:-k]) & (gap <= most)
        if not near.any():
            break
        near &= gap >= least
        gaps.append(gap[near])
        starts.append(at[:-k][near])
        k += 1
    if not gaps:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    gap, start = np.concatenate(gaps), np.concatenate(starts)
    order = np.lexsort((start, gap))
    return gap[order], start[order]


def equal_span(ids: np.ndarray, at: int, gap: int) -> tuple[int, int]:
    """The longest [start, end) around `at` in which each word equals the one `gap` words on; in steps that double."""
    end, step, last = at, 64, len(ids) - gap
    while end < last:
        m = min(step, last - end)
        other = np.flatnonzero(ids[end : end + m] != ids[end + gap : end + gap + m])
        if len(other):
            end += int(other[0])
            break
        end, step = end + m, step * 2
    start, step = at, 64
    while start > 0:
        m = min(step, start)
        other = np.flatnonzero(ids[start - m : start] != ids[start + gap - m : start + gap])
        if len(other):
            start += int(other[-1]) + 1 - m
            break
        start, step = start - m, step * 2
    return start, end


def periodic_runs(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every longest stretch with a smallest period of which it holds three or more, by start, then period.

    Periods of up to nine words are compared directly. Beyond, scale t = 4, 8, 16, ... covers those from
    3 t + 1 to 6 t (10 to 24 at first): any run of such a period has a synchronising position in its first
    words whose 2 t words recur one period later, inside the run. All pairs with equal contexts so far apart
    propose that period, which is then compared word for word in both directions. A run of a shorter period
    is known from a lower scale, and its blocks are those that a scale leaves out. Equal hashes only propose,
    so collisions cost time, never a result. Time is n log^2 n plus the words in proposed repeats.
    """
    n = len(ids)
    found: dict[tuple[int, int], int] = {}
    for p in range(1, min(DIRECT, n // 3) + 1):
        starts, ends = stretches(ids, p)
        long = ends - starts >= 3 * p
        for a, b in zip(starts[long].tolist(), ends[long].tolist(), strict=True):
            found.setdefault((a, b), p)
    least, t = DIRECT + 1, 4
    hashes = mixed(ids.astype(np.uint64))
    for k in (1, 2):
        hashes = doubled(hashes, k) if len(hashes) > k else hashes[:0]
    while 3 * least <= n:
        covered = np.zeros(n + 1, np.int32)
        for (a, b), p in found.items():
            if 3 * p <= t <= b - a:
                covered[a] += 1
                covered[b - t + 1] -= 1
        at = synchronising(hashes, t, np.cumsum(covered)[: len(hashes)] > 0)
        context = doubled(hashes, t)
        gap, done = 0, 0
        for d, s in zip(*(x.tolist() for x in pairs(at, context[at], least, 6 * t)), strict=True):
            if d == gap and s < done:
                continue
            start, end = equal_span(ids, s, d)
            gap, done = d, end
            if end - start >= 2 * d:
                found.setdefault((start, end + d), d)
        hashes, least, t = context, 6 * t + 1, 2 * t
    return sorted((a, b - a, p) for (a, b), p in found.items())


def numbered(words: list[bytes]) -> np.ndarray:
    """A number for each word, equal for equal words."""
    known: dict[bytes, int] = {}
    return np.array([known.setdefault(w, len(known)) for w in words], np.int64)


def find_runs(docs: DataFrame, text: str = "text", min_words: int = 24, min_periods: int = 3) -> DataFrame:
    """(row, n_words, runs, collapsed_text) for every row of docs, without a shuffle; row is the input row as a struct.

    runs lists, by start, then period, every longest stretch of words with a smallest period q (words q apart
    are equal) of min_words or more words and min_periods or more periods, as (start, length, period) in words
    from 0. collapsed_text has the words that no run holds behind its first period, joined by one space. Words
    are what stands between spaces, tabs and line ends (U+0009 to U+000D). A null or empty text has no words,
    no runs and an empty collapsed text. min_periods is at least 3, as synchronising positions promise no less.
    """
    if min_periods < 3:
        raise ValueError("runs of fewer than three periods are not covered")

    def make():
        def work(texts: list) -> dict[str, list]:
            out: dict[str, list] = {"n_words": [], "runs": [], "collapsed_text": []}
            for x in texts:
                words = (x or "").encode().split()
                runs = [r for r in periodic_runs(numbered(words)) if r[1] >= max(min_words, min_periods * r[2])]
                if runs:
                    keep = np.zeros(len(words) + 1, np.int64)
                    for start, length, period in runs:
                        keep[start + period] += 1
                        keep[start + length] -= 1
                    words = [words[i] for i in np.flatnonzero(np.cumsum(keep[:-1]) == 0).tolist()]
                out["n_words"].append(int(len(words)) if not runs else len(keep) - 1)
                out["runs"].append(runs)
                out["collapsed_text"].append(b" ".join(words).decode())
            return out

        return work

    added = "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed_text string"
    return map_texts(packed(docs, text), "body", added, make, drop=("body",))
