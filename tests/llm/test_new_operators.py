"""Runs, alignments of two tokenizers and chat formatting against plain Python versions."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from trackloom.llm import align, chat, periodic, queries

SF = "/root/testdata/sf0.001"
BLANK = r"[^\x20\x09-\x0D]+"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---- runs


def plain_runs(w):
    """Every longest stretch with a smallest period of which it holds three, period by period."""
    n, found = len(w), {}
    for p in range(1, n // 3 + 1):
        i = 0
        while i + p < n:
            a = i
            while i + p < n and w[i] == w[i + p]:
                i += 1
            if i - a + p >= 3 * p:
                found.setdefault((a, i + p), p)
            i += 1
    return sorted((a, b - a, p) for (a, b), p in found.items())


def test_runs_by_brute_force():
    rng = random.Random(3)
    for _ in range(400):
        w = []
        for _ in range(rng.randint(0, 5)):
            kind = rng.choice("rrnc")
            if kind == "r":
                root = [rng.randint(0, rng.choice([1, 2, 50])) for _ in range(rng.randint(1, 60))]
                root = root[:3] * rng.randint(1, 30) + root if rng.random() < 0.5 else root
                w += root * rng.randint(1, 6) + root[: rng.randint(0, len(root))]
            elif kind == "n":
                w += [rng.randint(0, 3) for _ in range(rng.randint(0, 40))]
            else:
                w += w[-rng.randint(1, 80) :] * rng.randint(1, 4)
        assert periodic.periodic_runs(np.array(w[:900], np.int64)) == plain_runs(w[:900])


def test_synchronising_positions_depend_on_their_words_alone():
    rng = np.random.default_rng(2)
    part = rng.integers(0, 30, 400)
    both = np.concatenate([rng.integers(0, 30, 77), part, rng.integers(0, 30, 55), part])
    hashes = periodic.mixed(both.astype(np.uint64))
    for k in (1, 2):
        hashes = periodic.doubled(hashes, k)
    for t in (4, 8, 16):
        at = periodic.synchronising(hashes, t, np.zeros(len(hashes), bool))
        inside = lambda first: {int(x) - first for x in at if first <= x <= first + 400 - 2 * t}  # noqa: E731, B023
        assert inside(77) == inside(77 + 400 + 55) and np.diff(at).max() <= t
        hashes = periodic.doubled(hashes, t)


def planted_words(doc_id, text):
    w = re.findall(BLANK, text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(w)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def test_runs_query_by_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op11_periodic_runs(spark, SF).collect()
    assert len(rows) == len(texts) and sum(r.n_runs > 0 for r in rows) > 10
    for r in rows:
        w = planted_words(r.doc_id, texts[r.doc_id])
        runs = [x for x in plain_runs(w) if x[1] >= max(24, 3 * x[2])] if len(w) < 3000 else periodic.periodic_runs(periodic.numbered([x.encode() for x in w]))
        runs = [x for x in runs if x[1] >= 24]
        gone = {i for s, n, p in runs for i in range(s + p, s + n)}
        assert r.n_runs == len(runs) and r.runs_sha256 == sha("".join("%d,%d,%d\n" % x for x in runs))
        assert r.collapsed_sha256 == sha(" ".join(x for i, x in enumerate(w) if i not in gone))
        top = min(runs, key=lambda x: (-x[1] / x[2], x[0], x[2])) if runs else (None,) * 3
        assert (r.start, r.length, r.period) == top and r.exponent_milli == (1000 * top[1] // top[2] if runs else None)


@pytest.mark.parametrize("texts", [[], [None, "", " \t", "a", "a " * 24, "a " * 24, "ab " * 100_000, "é\x85ü " * 30]], ids=["none", "odd"])
def test_runs_on_odd_texts(spark, texts):
    df = spark.createDataFrame([(i if i else None, t, "r", "b", "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, row string, body string, runs string, n_words int")
    got = {r.row.doc_id: r for r in periodic.find_runs(df).collect()}
    assert len(got) == len(texts)
    if texts:
        assert got[None].runs == [] == got[1].runs and got[2].collapsed_text == "" and got[3].n_words == 1
        assert [tuple(x) for x in got[4].runs] == [(0, 24, 1)] and got[4].collapsed_text == "a" == got[5].collapsed_text
        assert [tuple(x) for x in got[6].runs] == [(0, 100_000, 1)] and [tuple(x) for x in got[7].runs] == [(0, 30, 1)]
        assert got[4].row.runs == "x" and got[4].row.text == texts[4]
    with pytest.raises(ValueError):
        periodic.find_runs(df, min_periods=2)


# ---- alignment of two tokenizers


class PlainAlignment:
    """The two libraries as they are, tokens met one by one."""

    def __init__(self):
        import public_tokenizers
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
        self.a, self.b = Tokenizer.from_file(self.paths[0]), SentencePieceProcessor(model_file=self.paths[1])
        self.a.encode_special_tokens = True
        letters = align.Codec(self.paths[0]).bytes_of
        self.a_bytes = letters.__getitem__

    def b_bytes(self, i):
        p = self.b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("\u2581", " ").encode()

    def one(self, text):
        """(A ids, B ids, links, groups), or None for a text without tokens."""
        data = (" " + (text or "")).encode()
        a, b = self.a.encode(" " + (text or ""), add_special_tokens=False).ids, self.b.encode(text or "")
        x, y = [self.a_bytes(i) for i in a], [self.b_bytes(i) for i in b]
        if not text or b"".join(x) != data or b"".join(y) != data:
            return None
        ends = [np.cumsum([len(t) for t in z]).tolist() for z in (x, y)]
        starts = [[0, *e[:-1]] for e in ends]
        links, j = [], 0
        for i in range(len(a)):
            while ends[1][j] <= starts[0][i]:
                j += 1
            k = j
            while k < len(b) and starts[1][k] < ends[0][i]:
                links.append((a[i], b[k]))
                k += 1
        cuts = sorted(set(ends[0]) & set(ends[1]))
        within = lambda ids, e, low, high: ",".join(str(t) for t, z in zip(ids, e, strict=True) if low < z <= high)
        groups = ";".join(f"{within(a, ends[0], low, high)}|{within(b, ends[1], low, high)}" for low, high in zip([0, *cuts], cuts, strict=False)) if len(a) < 2000 else None
        return a, b, links, groups, len(cuts)


def check_alignment(texts, rows, plain):
    """rows: {key: result}; texts: {key: text}."""
    want = {k: plain.one(t) for k, t in texts.items()}
    counts = Counter(p for w in want.values() if w for p in w[2])
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    assert rows.keys() == texts.keys()
    for k, r in rows.items():
        w = want[k]
        if w is None:
            assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) == (0, 0, 0, 0, 0, 0, ""), texts[k]
            continue
        assert (r.n_a, r.n_b, r.n_groups, r.n_links) == (len(w[0]), len(w[1]), w[4], len(w[2])), texts[k]
        assert r.n_best == sum(counts[p] == most[p[1]] for p in w[2]) and r.count_sum == sum(counts[p] for p in w[2])
        assert w[3] is None or r.groups_sha256 == sha(w[3])


def test_alignment_query_by_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    check_alignment(texts, {r.doc_id: r for r in queries.op12_tokenizer_alignment(spark, SF).collect()}, PlainAlignment())


@pytest.mark.parametrize("lane", [3, 1024])
def test_alignment_of_odd_texts(spark, monkeypatch, lane):
    monkeypatch.setattr(align, "LANE", lane)
    plain, rng = PlainAlignment(), random.Random(8)
    bits = [" ", "  ", "\n", "\t", "a", "é", "<|endoftext|>", "日本", "'s", "1", "!!", "\r\n", "xyz ", "😀", "\x85", "foo", "The", "\u2581", "<s>", "<0x41>", "\x00", "\u3000", " of the"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 60))) for _ in range(250)]
    texts += [None, "", " ", "a", "a", "a ", "</s>", "<unk>", "x" * 3000, " " * 3000, "word " * 5000]
    df = spark.createDataFrame([(i, t, "b", 3, "p") for i, t in enumerate(texts)], "doc_id long, text string, block string, n_a int, pairs string").repartition(3)
    got = align.align(df, *plain.paths, with_groups=True).collect()
    assert all((r.row.block, r.row.n_a, r.row.pairs, r.row.text) == ("b", 3, "p", texts[r.row.doc_id]) for r in got)
    assert all(sha(r.groups) == r.groups_sha256 for r in got if r.groups)
    check_alignment(dict(enumerate(texts)), {r.row.doc_id: r for r in got}, plain)


def test_alignment_of_nothing(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert align.align(df, *PlainAlignment().paths).collect() == []


# ---- chat


def plain_format(rows, t=chat.Template()):
    """The formatted text, its loss spans in bytes and the turns of one conversation."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "", r[2] or ""))
    turns = [(r[1] or "", r[2] or "") for r in rows]

    def escaped(x):
        x = x.replace("\\", "\\\\")
        for c in t.controls():
            x = x.replace(c, c[0] + "\\" + c[1:])
        return x

    out, spans, last = "", [], None
    for i, (role, text) in enumerate(turns):
        out += t.joint if i and role == last else (t.end if i else "") + t.start + escaped(role) + t.body
        start = len(out.encode())
        out += escaped(text)
        if role == t.loss_role:
            spans.append((start, len(out.encode())))
        last = role
    return out + t.end, spans, turns


def check_chats(spark, rows, **options):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string, said string, part string")
    made = chat.format_chats(df, **options)
    t = options.get("template") or chat.Template()
    got = made.select("*", chat.read_turns(F.col("formatted"), t).alias("turns"), chat.loss_texts(F.col("formatted"), F.col("loss_spans"), t).alias("learned")).collect()
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r[1:4])
    assert sorted((r.conv_id is None, r.conv_id or 0) for r in got) == sorted((k is None, k or 0) for k in by)
    for r in got:
        text, spans, turns = plain_format(by[r.conv_id], t)
        assert r.formatted == text and [tuple(x) for x in r.loss_spans] == spans
        assert [tuple(x) for x in r.turns] == turns and r.learned == [x for role, x in turns if role == t.loss_role]


def test_chats_by_brute_force(spark, monkeypatch):
    monkeypatch.setattr(chat, "STRETCH", 3)
    rng = random.Random(4)
    bits = ["<s>", "</s>", "[INST]", "[/INST]", " ", "\\", "<", "[", "s>", "/s>", "INST]", "é", "\n", "ok", "<\\s>", "😀", "$1"]
    rows = []
    for c in [None, *range(60)]:
        for i in range(rng.choice([1, 2, 9, 40])):
            turn = rng.choice([i, i, i // 2, None, -i])
            rows.append((c, turn, rng.choice(["user", "assistant", "assistant", "system", None, "<s>", "a\nb\\"]), rng.choice([None, "".join(rng.choice(bits) for _ in range(rng.randint(0, 12)))]), "f", "s", "p"))
    check_chats(spark, rows)
    check_chats(spark, rows, template=chat.Template("{|a}", "{|b}\n", "{|c}\n", "{|d}\n", "user"))


def test_chats_of_nothing_and_of_very_much(spark):
    check_chats(spark, [])
    rng = random.Random(6)
    check_chats(spark, [(1, rng.choice([i, 5]), rng.choice(["user", "assistant"]), f"text {i} é " * 3, "f", "s", "p") for i in range(20_000)] + [(2, None, "user", "x" * 3_000_000, "f", "s", "p")])
    for marks in (("<s>", "<s>", "[x]", "</s>"), ("a", "<b>", "<c>", "<d>"), ("<s>", "<s>x", "<c>", "<d>"), ("<s x>", "<b>", "<c>", "<d>")):
        with pytest.raises(ValueError):
            chat.Template(*marks)
