"""Toxicity from a learned lexicon: a Levenshtein automaton run over its trie, and windows that tell quotation from abuse."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackloom.llm.common import cut, held_out, limit_batches, map_texts, packed

_WORD = re.compile(r"[^\W_]+")
_QUOTES = re.compile("[\"“”„«»]")
#: Words that announce someone else's speech, in the corpus's languages; fixed values.
REPORTING = frozenset("said says wrote writes quoted quote quotes called calls reported according dijo dice escribió cita citó dit écrit cite selon sagte sagt schrieb zitiert laut".split())
#: Code points on either side of a hit that make its window.
WINDOW = 40
#: States of the automaton, and words, that a worker remembers; full memories are emptied.
MAX_MEMORY = 300_000


@dataclass
class Automaton:
    """All terms within an edit distance of a word at once.

    A state is a set of (node of the trie, edits so far): the Levenshtein automata of all terms walked
    together. States are built when a word first needs them and kept, so a word costs one step a character
    and stops where no term can follow.
    """

    terms: dict[str, float]
    one_from: int = 5
    two_from: int = 10
    children: list[dict[str, int]] = field(default_factory=lambda: [{}])
    ends: dict[int, str] = field(default_factory=dict)
    deepest: list[int] = field(default_factory=lambda: [0])

    def __post_init__(self) -> None:
        for term in self.terms:
            path = [0]
            for c in term:
                nxt = self.children[path[-1]].get(c)
                if nxt is None:
                    nxt = len(self.children)
                    self.children[path[-1]][c] = nxt
                    self.children.append({})
                    self.deepest.append(0)
                path.append(nxt)
            self.ends[path[-1]] = term
            for node in path:
                self.deepest[node] = max(self.deepest[node], self.edits(term))
        self.forget()

    def edits(self, term: str) -> int:
        """How many edits a word may be from a term: none for short terms, two for long ones."""
        return 0 if len(term) < self.one_from else 1 if len(term) < self.two_from else 2

    def forget(self) -> None:
        self.start = self.closed({(0, 0)})
        self.steps: dict[tuple[frozenset, str], frozenset] = {}

    def closed(self, states: set[tuple[int, int]]) -> frozenset:
        """With what is reached by leaving out letters of a term. A node has no more edits than some term below it may have."""
        out, fresh = set(states), states
        while fresh:
            fresh = {(child, n + 1) for node, n in fresh for child in self.children[node].values() if n < self.deepest[child]} - out
            out |= fresh
        return frozenset(out)

    def step(self, states: frozenset, c: str) -> frozenset:
        out: set[tuple[int, int]] = set()
        for node, n in states:
            child = self.children[node].get(c)
            if child is not None and n <= self.deepest[child]:
                out.add((child, n))
            if n < self.deepest[node]:
                out.add((node, n + 1))
                out.update((other, n + 1) for other in self.children[node].values() if n < self.deepest[other])
        return self.closed(out)

    def match(self, word: str) -> tuple[str, int] | None:
        """The term nearest to the word and its distance; of equals the heaviest, then the first."""
        states = self.start
        if len(self.steps) > MAX_MEMORY:
            self.forget()
        for c in word:
            nxt = self.steps.get((states, c))
            if nxt is None:
                nxt = self.steps[states, c] = self.step(states, c)
            if not nxt:
                return None
            states = nxt
        found = [(n, -self.terms[t], t) for node, n in states if (t := self.ends.get(node)) and n <= self.edits(t)]
        return (min(found)[2], min(found)[0]) if found else None


@dataclass(frozen=True)
class Model:
    terms: dict[str, float]
    known: frozenset
    weights: np.ndarray
    means: np.ndarray
    spreads: np.ndarray


class Scorer:
    def __init__(self, terms: dict[str, float], known: frozenset) -> None:
        self.automaton, self.terms, self.known = Automaton(terms), terms, known
        self.memory: dict[str, tuple[str, int] | None] = {}

    def look_up(self, word: str) -> tuple[str, int] | None:
        if word in self.terms:
            return word, 0
        if word in self.known or len(word) < self.automaton.one_from - 1:  # too short for any term that allows an edit
            return None
        return self.automaton.match(word)

    def features(self, text: str) -> list[float]:
        """Weights of exact, misspelled and quoted hits, the heaviest, how many terms, and the density; of the whole text."""
        low = text.lower()
        words = _WORD.findall(low)
        memory = self.memory
        if len(memory) > MAX_MEMORY:
            memory.clear()
        hits = set()
        for w in set(words):
            got = memory.get(w, 0)
            if got == 0:
                got = memory[w] = self.look_up(w)
            if got:
                hits.add(w)
        if not hits:
            return [0.0] * 6 + [math.log1p(len(words))]
        exact = fuzzy = quoted = heaviest = 0.0
        kinds = set()
        for m in _WORD.finditer(low):
            if m[0] not in hits:
                continue
            term, distance = memory[m[0]]
            weight = self.terms[term]
            if self.is_quoted(low, m.start(), m.end()):
                quoted += weight
            elif distance:
                fuzzy += weight
            else:
                exact += weight
                heaviest = max(heaviest, weight)
                kinds.add(term)
        density = 100 * (exact + fuzzy) / len(words)
        return [math.log1p(exact), math.log1p(fuzzy), math.log1p(quoted), heaviest, math.log1p(len(kinds)), math.log1p(density), math.log1p(len(words))]

    @staticmethod
    def is_quoted(low: str, start: int, end: int) -> bool:
        """Whether quotation marks stand on both sides within the window, or a mark and a reporting word do."""
        before, after = low[max(0, start - WINDOW) : start].rpartition("\n")[2], low[end : end + WINDOW].partition("\n")[0]
        opened, closed = len(_QUOTES.findall(before)) % 2 == 1, _QUOTES.search(after) is not None
        reports = any(w in REPORTING for w in _WORD.findall(before))
        return (opened and closed) or (reports and (opened or closed))


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, turns: int = 30) -> np.ndarray:
    """Weights of a logistic regression with a constant, by Newton's method."""
    z = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(z.shape[1])
    keep = np.diag([1e-6, *[penalty] * x.shape[1]])
    for _ in range(turns):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        w -= np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + keep, z.T @ (p - y) + keep @ w)
    return w


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = 20_000, least_docs: int = 3, least_weight: float = 2.0) -> Model:
    """A lexicon with weights, and how hits are weighed, from labelled rows that are not held out.

    About `sample` labelled rows, drawn by a hash of the id, are read; so the model's cost is bounded. The
    lexicon is words whose documents are toxic far more often than others (log-odds). The weights of
    the features come from cross-fitting: each half of the rows is looked at with the lexicon of the other
    half; the model has the lexicon of all. Of several labels for an id the largest counts; rows
    without a label are not used. Without labels, or with one class only, every score is 0.
    """
    known_labels = labels.where(F.col(label).isNotNull()).groupBy(F.col(doc_id).alias("label_id")).agg(F.max(label).cast("int").alias("y"))
    rows = packed(docs, text).select(F.col("row").getField(doc_id).alias("id"), "body").where(~held_out(F.col("id")))
    chosen = known_labels.where(~held_out(F.col("label_id")))
    n = chosen.count()
    part = min(1.0, sample / n) if n else 0.0
    chosen = chosen.where(F.pmod(F.xxhash64("label_id"), F.lit(1_000_000)) < part * 1_000_000)
    drawn = rows.join(chosen, F.col("id") == F.col("label_id")).select("y", "body", F.pmod(F.xxhash64(F.lit("half"), F.col("id")), F.lit(2)).alias("half"))
    drawn = cut(drawn)  # a bounded sample, read three times

    def count(batches):
        for batch in batches:
            toxic: dict[tuple[int, str], list[int]] = {}
            for y, body, half in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                for w in set(_WORD.findall(body.lower())):
                    toxic.setdefault((half, w), [0, 0])[1 - (y > 0)] += 1
            cols = [[k[0] for k in toxic], [k[1] for k in toxic], [v[0] for v in toxic.values()], [v[1] for v in toxic.values()]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.string(), pa.int64(), pa.int64()), strict=True)], ["half", "word", "t", "c"])

    limit_batches(docs.sparkSession)
    sizes = [(r[0], r[1], r[2]) for r in drawn.groupBy("half", (F.col("y") > 0).alias("bad")).count().collect()]
    sums = cut(drawn.mapInArrow(count, "half long, word string, t long, c long").groupBy("half", "word").agg(F.sum("t").alias("t"), F.sum("c").alias("c")))

    def lexicon(halves: tuple[int, ...]) -> tuple[dict[str, float], frozenset] | None:
        """Terms and known words of the rows of these halves, if both classes are there; bounded by the sample."""
        n_toxic, n_clean = (sum(k for h, bad, k in sizes if h in halves and bad is want) for want in (True, False))
        if not n_toxic or not n_clean:
            return None
        both = sums.where(F.col("half").isin(*halves)).groupBy("word").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
        weight = F.log((F.col("t") + 0.5) / (n_toxic + 1.0)) - F.log((F.col("c") + 0.5) / (n_clean + 1.0))
        heavy = both.withColumn("w", weight).where((F.col("t") >= least_docs) & (F.col("w") >= least_weight) & (F.char_length("word") >= 3))
        terms = {r[0]: float(r[1]) for r in heavy.select("word", "w").collect()}
        known = frozenset(r[0] for r in both.where("c >= 3").select("word").collect()) - terms.keys()
        return terms, known

    none = Model({}, frozenset(), np.zeros(8), np.zeros(7), np.ones(7))
    whole = lexicon((0, 1))
    if whole is None:
        return none
    other = {h: lexicon((1 - h,)) or whole for h in (0, 1)}
    shared = docs.sparkSession.sparkContext.broadcast(other)

    def look(batches):
        scorers = {h: Scorer(*own) for h, own in shared.value.items()}
        for batch in batches:
            made = [scorers[half].features(body) for body, half in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int32()), pa.array(made, pa.list_(pa.float64()))], ["y", "x"])

    seen = drawn.mapInArrow(look, "y int, x array<double>").collect()  # the sample, seven numbers each
    y = np.array([float(r[0] > 0) for r in seen])
    if not len(y) or y.min() == y.max():
        return none
    x = np.array([r[1] for r in seen])
    means, spreads = x.mean(0), np.maximum(x.std(0), 1e-6)
    return Model(*whole, _logistic((x - means) / spreads, y), means, spreads)


def score(docs: DataFrame, model: Model, text: str = "text", threshold: float = 0.7) -> DataFrame:
    """(row, score, predicted) for every row of docs, without a shuffle.

    Each word of the whole text is held against the lexicon, exactly or within an edit, two for long terms; hits inside
    quotations count apart. Words that are frequent in clean documents are not taken for misspellings. A
    null or empty text has no hits and the score of such texts. predicted is 1 from the threshold on.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        own = shared.value
        scorer = Scorer(own.terms, own.known)

        def work(texts: list) -> dict[str, list]:
            if not texts or not own.terms:
                return {"score": [0.0] * len(texts), "predicted": [0] * len(texts)}
            x = (np.array([scorer.features(t or "") for t in texts]) - own.means) / own.spreads
            p = 1 / (1 + np.exp(-np.clip(own.weights[0] + x @ own.weights[1:], -30, 30)))
            return {"score": p.tolist(), "predicted": (p >= threshold).astype(int).tolist()}

        return work

    return map_texts(packed(docs, text), "body", "score double, predicted int", make, drop=("body",))
