"""Whole queries and the pipeline against plain Python versions of themselves, and odd inputs for every operator."""

import hashlib
import re
import time
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from trackloom.llm import bpe, common, decontam, langid, linededup, minhash, pii, quality, queries, secrets, toxicity

SF, SF01 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
BLANKS = " \t\n\x0b\x0c\r"


def documents(spark, sf=SF):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}


# ---- quality rules


def plain_quality(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, clean_text), one rule after the other."""
    text = text or ""
    words = re.findall(r"[^ \t-\r]+", text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    marked = {i + j for i, w in enumerate(windows) if often[w] > 1 for j in range(8)}
    lines, seen, dup, bad, good, lost = text.split("\n"), set(), 0, 0, [], 0
    for line in lines:
        own = re.findall(r"[^ \t-\r]+", line)
        if own:
            dup += line in seen
            seen.add(line)
            solid = sum(len(w.encode("utf-8", "surrogatepass")) for w in own)
            symbols = len(re.findall(r"[#*$%&<>]", line))
            quoted = ("»" if "«" in line else "") + ("›" if "‹" in line else "")
            bars = [c for c in re.sub(r"^[|»›•· \t-\r]+|[|»›•· \t-\r]+$", "", line) if c in "|»›•·" and c not in quoted]
            phrases = [p for p in quality.BOILERPLATE for _ in range(line.lower().count(p))]
            fault = (
                (symbols > 2 and symbols > 0.1 * solid)
                or sum(w.endswith("!!") for w in own) > 0.5 * len(own)
                or len(bars) > 0.15 * len(own)
                or sum(a == b for a, b in zip(own, own[1:], strict=False)) > 0.5 * (len(own) - 1)
                or (len(own) <= 5 and re.search(r"(\.\.\.|…|»|›|>>)[ \t-\r]*$", line) is not None)
                or sum(len(w.encode("utf-8", "surrogatepass")) for w in own if "http://" in w or "https://" in w or "www." in w) > 0.5 * solid
                or sum(len(p.split()) for p in phrases) > 0.25 * len(own)
            )
            bad += solid
            if fault:
                lost += solid
                continue
        good.append(line)
    failed = len(words) < 20 or 100 * len(marked) > 30 * len(words)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, dup, len(marked), failed, not failed and lost <= 0.5 * bad, "\n".join(good)


def test_quality_query_by_brute_force(spark):
    texts = documents(spark)
    for r in queries.op9_quality(spark, SF).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) == plain_quality(texts[r.doc_id])[:7]


def test_quality_rules_on_lines():
    def faults(*lines):
        return [quality.line_fault(x.encode(), x.encode().split(), quality.Rules()) for x in lines]

    assert faults("Start | Über uns | Kontakt | Impressum", "Accueil » Produits » Contact", "Alle Rechte vorbehalten.", "Tous droits réservés", "Haz clic aquí para ver más") == ["navigation", "navigation", "boilerplate", "boilerplate", "boilerplate"]
    assert faults("• buy some milk", "Il a dit « bonjour ».", "»Ja«, sagte er", "et voici enfin la fin de la phrase »", "· erster Punkt", "| a | b | c |") == [None] * 5 + ["navigation"]
    assert faults("read more...", "Weiter lesen »", "see https://example.org/a/long/path/to/it", "the page www.example.org tells all about the river and its towns") == ["teaser", "teaser", "links", None]
    good = "click here to read the whole of this long and well written story about the town and the people who live beside its old river"
    assert faults(good, "click here to read", "no no") == [None, "boilerplate", "repetition"]
    prose = "a plain sentence about a river that says nothing else and goes on for long " * 8
    assert faults(prose, prose + "click here", "ha ha ha ha ha ha ha") == [None, None, "repetition"]


# ---- toxicity


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(prev[j] + 1, row[-1] + 1, prev[j - 1] + (x != y)))
    return row[-1]


def test_toxicity_features_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text")
    model = toxicity.fit(docs, spark.read.parquet(f"{SF01}/labels.parquet"))
    assert model.terms
    scorer = toxicity.Scorer(model.terms, model.known)
    words = sorted({w for t in list(documents(spark).values())[:60] for w in re.findall(r"[^\W_]+", (t or "").lower())})[::3]
    words += [t[:-1] for t in model.terms] + [t + "x" for t in model.terms] + [t[:2] + "q" + t[4:] for t in model.terms if len(t) > 9]
    for w in words:
        found = scorer.look_up(w)
        if w in model.terms:
            assert found == (w, 0)
        elif w in model.known or len(w) < 4:
            assert found is None
        else:
            near = [(edits(w, t), -model.terms[t], t) for t in model.terms if abs(len(w) - len(t)) <= 2]
            near = [x for x in near if x[0] <= scorer.automaton.edits(x[2])]
            assert found == ((min(near)[2], min(near)[0]) if near else None)


def test_toxicity_of_held_out_rows(spark):
    got = queries.op3_toxicity(spark, SF01).join(spark.read.parquet(f"{SF01}/labels.parquet"), "doc_id").where("held_out").collect()
    bad, good = [r for r in got if r.toxic], [r for r in got if not r.toxic]
    assert sum(r.predicted for r in bad) >= 0.7 * len(bad) and sum(r.predicted for r in good) <= 0.05 * len(good)


# ---- language


def test_language_filters_hold_all_their_trigrams():
    rng = np.random.default_rng(1)
    grams = {k: np.unique(rng.integers(1, 1 << 60, 3000).astype(np.uint64)) for k in ("de", "en", "fr")}
    f = langid.Filters.of(grams)
    for i, lang in enumerate(f.langs):
        assert ((f.languages(grams[lang])[:, 0] >> np.uint64(i)) & np.uint64(1)).all()
        others = rng.integers(1 << 60, 1 << 61, 20_000).astype(np.uint64)
        rate = float(((f.languages(others)[:, 0] >> np.uint64(i)) & np.uint64(1)).mean())
        assert abs(rate - f.false_rate[i]) < 0.01 and f.false_rate[i] < 0.02
    same = langid.Filters.of({"xx": langid.trigrams("aaa bbb"), "aa": langid.trigrams("aaa bbb")})
    assert same.predict("aaa bbb")[0] == "aa"  # ties go to the first in the alphabet
    for text in ("½ ²", "12 34", "", None, "__ ١٢"):
        assert same.predict(text) == ("und", 0.0)


# ---- personal data


def test_pii_query_goes_back(spark):
    texts, feistel = documents(spark), pii.Feistel(b"a key of this test")
    spark.conf.set("spark.trackloom.pii.secret", "a key of this test")
    try:
        check_pii(spark, texts, feistel)
    finally:
        spark.conf.unset("spark.trackloom.pii.secret")


def check_pii(spark, texts, feistel):
    seen = Counter()
    for r in queries.op4_pii(spark, SF).collect():
        spans = [x.split(":") for x in r.spans.split(",") if x]
        seen.update(k for k, _, _ in spans)
        text, at, out = texts[r.doc_id] or "", 0, []
        for k, a, b in spans:  # every value on its own, in the place that the spans tell
            out += [text[at : int(a)], pii.pseudonym(feistel, k, pii._PATTERNS[k].fullmatch(text[int(a) : int(b)]))]
            at = int(b)
        assert "".join([*out, text[at:]]) == r.text
    assert len(seen) >= 4


def test_pii_formats_and_links():
    f = pii.Feistel(b"k")
    one = pii.replace("on 3/4/2020 and 2020-04-03 and 03/04/2020", f)[0]
    day, iso, padded = re.fullmatch(r"on (\S+) and (\S+) and (\S+)", one).groups()
    d, m, y = day.split("/")
    assert not d.startswith("0") and not m.startswith("0") and iso == f"{y}-{int(m):02d}-{int(d):02d}" and padded == f"{int(d):02d}/{int(m):02d}/{y}"
    with_code, without = pii.replace("+1 555-123-4567 or 555-123-4567", f)[0].split(" or ")
    assert with_code == f"+1 {without}"
    for area in (1, 665, 667, 899):
        x = f"{area:03d}-01-0001"
        assert pii.replace(pii.replace(x, f)[0], f, back=True)[0] == x
    start = time.time()
    assert len(pii.replace("2020-01-02, " * 40_000, f)[1]) == 40_000 and time.time() - start < 60


# ---- near duplicates


def shingle_sets(words):
    k = min(5, len(words))
    return Counter(tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def probability_jaccard(a, b):
    total_a, total_b = sum(a.values()), sum(b.values())
    x, y = {k: v / total_a for k, v in a.items()}, {k: v / total_b for k, v in b.items()}
    both = x.keys() & y.keys()
    return sum(1 / sum(max(x.get(z, 0) / x[s], y.get(z, 0) / y[s]) for z in x.keys() | y.keys()) for s in both)


def near_links(texts):
    """Pairs of keys of texts whose shingles have a similarity of 0.8, by the sets or with counts."""
    sets = {k: shingle_sets(minhash.word_list(t)) for k, t in texts.items() if minhash.word_list(t or "")}
    holders = defaultdict(list)
    for k, s in sets.items():
        for x in s:
            holders[x].append(k)
    shared = Counter()
    for ks in holders.values():
        if len(ks) < 400:
            shared.update(combinations(sorted(ks), 2))
    for (a, b), n in shared.items():
        x, y = sets[a], sets[b]
        if n >= 0.8 * len(x.keys() | y.keys()) or (min(sum(x[s] for s in x.keys() & y.keys()) / sum(x.values()), sum(y[s] for s in x.keys() & y.keys()) / sum(y.values())) >= 0.8 and probability_jaccard(x, y) >= 0.8):
            yield a, b


def classes_of(texts):
    root = {k: k for k in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    same = defaultdict(list)
    for k, t in texts.items():
        if t:
            same[t].append(k)
    for ks in same.values():
        for k in ks[1:]:
            a, b = sorted((find(ks[0]), find(k)))
            root[b] = a
    for a, b in near_links(texts):
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {k: find(k) for k in texts}


def test_near_duplicate_query_by_brute_force(spark):
    want = classes_of(documents(spark, SF01))
    got = {r.doc_id: r.class_id for r in queries.op10_near_duplicates(spark, SF01).collect()}
    assert got == want  # every pair that is similar is linked, and nothing else


def test_copies_with_a_repeated_passage_meet(spark):
    rows, held = [], []
    for i in range(40):
        words = [f"w{i}x{j}" for j in range(200)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(words + words[:60] * 12))]
        held.append({2 * i, 2 * i + 1})
    got = {r.id: r.class_id for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[a] == got[b] for a, b in held) and len(set(got.values())) == 40


# ---- pipeline


def plain_pipeline(texts, items, path):
    texts = {k: q[7] for k, t in texts.items() if (q := plain_quality(t))[6]}
    keys = {k: [re.sub("[A-Z]", lambda m: m[0].lower(), x.strip(BLANKS)) for x in t.split("\n")] for k, t in texts.items()}
    n_docs = Counter(x for ks in keys.values() for x in set(ks) if x)
    texts = {k: "\n".join(x for x, key in zip(t.split("\n"), keys[k], strict=True) if not key or n_docs[key] < 10) for k, t in texts.items()}
    root = classes_of(texts)
    texts = {k: t for k, t in texts.items() if root[k] == k}

    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    windows = defaultdict(set)
    for item in items:
        w = words(item)
        n = min(10, len(w))
        if n:
            windows[n] |= {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}
    clean = {}
    for k, t in texts.items():
        w = words(t)
        if not any(tuple(w[i : i + n]) in held for n, held in windows.items() for i in range(len(w) - n + 1)):
            clean[k] = t
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    out = {}
    for k, t in clean.items():
        ids = tokenizer.encode(t, add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        out[k] = (t, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())
    return out


def test_pipeline_by_brute_force(spark):
    import corpus_pipeline

    items = [r.text for r in spark.read.parquet(f"{SF01}/benchmark.parquet").collect()]
    want = plain_pipeline(documents(spark, SF01), items, queries.tokenizer_path())
    got = {r.doc_id: (r.text, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, SF01).collect()}
    assert got == want and len(got) > 500


def test_bpe_query_by_brute_force(spark):
    from tokenizers import Tokenizer

    tokenizer, texts = Tokenizer.from_file(queries.tokenizer_path()), documents(spark)
    for r in queries.op7_bpe(spark, SF).collect():
        ids = tokenizer.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())


# ---- odd inputs

NAMES = ("row", "body", "key", "text_key", "mark", "clean_text", "spans", "__text_key", "class", "filled", "dropped", "gone_id", "id", "lang", "n_words", "half", "y")


def every_operator(df, items, labels):
    """(name, result with a column row or with the columns of df) of all operators on texts."""
    yield "secrets", secrets.scan(df)
    yield "toxicity", toxicity.score(df, toxicity.fit(df, labels))
    yield "pii", pii.pseudonymise(df, b"k")
    yield "decontam", decontam.contamination(df, items)
    yield "langid", langid.identify(df, langid.fit(df.withColumn("lang", F.lit("en"))))
    yield "bpe", bpe.encode_decode(df, queries.tokenizer_path())
    yield "linededup", linededup.drop_shared_lines(df)
    yield "quality", quality.judge(df)


def test_clashing_columns(spark):
    values = [f"{n}-value" for n in NAMES]
    texts = ["alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi", "short", None]
    df = spark.createDataFrame([(i, t, *values) for i, t in enumerate(texts)], ["doc_id", "text", *NAMES])
    items, labels = spark.createDataFrame([(1, "zz yy xx")], "item_id long, text string"), spark.createDataFrame([(0, 1), (1, 0), (1, 1), (2, None)], "doc_id long, toxic int")
    for name, out in every_operator(df, items, labels):
        got = sorted((r.row.asDict() for r in out.select("row").collect()), key=lambda d: d["doc_id"])
        assert [[d[n] for n in NAMES] for d in got] == [values] * 3 and [d["text"] for d in got] == texts, name
    for kept in (quality.keep_good(df), minhash.keep_one(df), decontam.keep_clean(df, items)):
        assert kept.columns == df.columns and all([r[n] for n in NAMES] == values for r in kept.collect())


def test_very_long_texts(spark):
    import random

    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9)))
    passage = " ".join(word() for _ in range(12))
    long = "\n".join(" ".join(word() for _ in range(12)) for _ in range(15_000)) + f"\n{passage}\npassword = hunter22hunter22 AKIA{'A' * 16} 2020-01-02"
    df = spark.createDataFrame([(1, long), (2, long + " end"), (3, "a " * 300_000), (4, "")], "doc_id long, text string")
    items, labels = spark.createDataFrame([(1, passage)], "item_id long, text string"), spark.createDataFrame([(1, 1), (3, 0)], "doc_id long, toxic int")
    found = {name: {r.row.doc_id: r for r in out.collect()} for name, out in every_operator(df, items, labels)}
    assert all(set(v) == {1, 2, 3, 4} for v in found.values())
    assert found["decontam"][1].n_hit == 12 and found["decontam"][3].n_hit == 0
    assert found["linededup"][1].n_lines == 15_002 and len(found["secrets"][1].assign) == 1 and len(found["secrets"][1].access) == 1
    assert found["pii"][1].n_date == 1 and found["quality"][3].base_failed and found["quality"][1].n_words == 15_000 * 12 + 12 + 5
    got = {r.id: r.class_id for r in minhash.near_duplicates(df).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4}


@pytest.mark.parametrize("texts", [[], [None, ""], ["x", "x"]], ids=["none", "blank", "twice"])
def test_filters_on_little(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    items = spark.createDataFrame([], "item_id long, text string")
    nulls = spark.createDataFrame([(1, None), (2, "")], "item_id long, text string")
    assert quality.keep_good(df).count() == 0
    assert decontam.keep_clean(df, items).count() == decontam.keep_clean(df, nulls).count() == len(texts)
    assert minhash.keep_one(df).count() == (1 if texts == ["x", "x"] else len(texts))


def test_joins_without_broadcasts(spark, monkeypatch):
    """The form of every join that tables beyond BROADCAST_BYTES take gives the same rows."""
    names = ("op1_warc", "op2_secrets", "op5_decontamination", "op8_line_dedup", "op10_near_duplicates", "op12_tokenizer_alignment", "op13_chat_format")
    rows = lambda name: sorted(map(str, queries.QUERIES[name](spark, SF).collect()))
    want = {name: rows(name) for name in names}
    monkeypatch.setattr(common, "BROADCAST_BYTES", -1)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert {name: rows(name) for name in names} == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_repeated_rows_and_ids(spark):
    df = spark.createDataFrame([(1, "one two three four five six"), (1, "one two three four five six"), (1, "other words that stand here alone"), (None, "one two three four five six"), (2, "----"), (3, "----")], "doc_id long, text string")
    kept = sorted((r.doc_id or 0, r.text) for r in minhash.keep_one(df).collect())
    assert kept == [(1, "one two three four five six"), (1, "other words that stand here alone"), (2, "----")]
