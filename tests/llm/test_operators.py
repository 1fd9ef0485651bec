"""The training-data operators against brute force, on small texts with nulls, ties, copies and clashing columns."""

import hashlib
import random
import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from trackloom.llm import bpe, decontam, langid, linededup, minhash, pii, quality, queries, queries_sql, secrets, toxicity, warc
from trackloom.llm.common import new_path

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, key string, row string, body string, n_lines string"
ODD = [(1, None), (2, ""), (3, "a"), (3, "a"), (None, "x\ny"), (4, "\n\n"), (5, "é " * 30), (6, "word " * 50), (7, "All rights reserved\nfoo bar")]


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "k", "r", "b", "n") for i, t in rows], DOCS)


def ids(df):
    return sorted((r.doc_id is None, r.doc_id or 0) for r in df.collect())


@pytest.mark.parametrize("name", sorted(queries_sql.ORACLE))
def test_matches_sql(spark, name):
    c = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "conversations"):
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = c.execute(queries_sql.ORACLE[name])
    cols = [d[0] for d in want.description]
    got = [tuple(map(str, (r[x] for x in cols))) for r in queries.QUERIES[name](spark, SF).collect()]
    assert sorted(got) == sorted(tuple(map(str, r)) for r in want.fetchall())


@pytest.mark.parametrize("rows", [ODD, []], ids=["odd", "empty"])
def test_every_row_comes_back(spark, rows):
    df = docs(spark, rows)
    items = spark.createDataFrame([(1, "a"), (2, None), (3, "")], "item_id long, text string")
    labels = spark.createDataFrame([(1, 1), (3, 0), (3, None)], "doc_id long, toxic int")
    want = ids(df)
    assert ids(secrets.scan(df).select("row.doc_id")) == want
    assert ids(toxicity.score(df, toxicity.fit(df, labels)).select("row.doc_id")) == want
    assert ids(pii.pseudonymise(df, b"k").select("row.doc_id")) == want
    assert ids(decontam.contamination(df, items).select("row.doc_id")) == want
    assert ids(langid.identify(df, langid.fit(df.withColumn("lang", F.lit("en")))).select("row.doc_id")) == want
    assert ids(bpe.encode_decode(df, queries.tokenizer_path()).select("row.doc_id")) == want
    assert ids(linededup.drop_shared_lines(df).select("row.doc_id")) == want
    assert ids(quality.judge(df).select("row.doc_id")) == want
    assert ids(minhash.near_duplicates(df).select(F.col("id").alias("doc_id"))) == want


def test_filters_keep_columns(spark):
    df = docs(spark, ODD)
    assert quality.keep_good(df).columns == df.columns
    assert minhash.keep_one(df).columns == df.columns
    items = spark.createDataFrame([(1, "x y")], "item_id long, text string")
    kept = decontam.keep_clean(df, items)
    assert kept.columns == df.columns and kept.where("doc_id is null").isEmpty()


def test_warc_rejects_magic_inside_payloads(spark):
    inner = "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.1\r\n"
    rows = [(1, "http://a\r\nX: y", inner), (2, None, None), (3, "u", "same"), (9, "u", "same"), (4, "u", inner + "é"), (None, "u", "same"), (5, "", "WARC/1.1\r\n" * 5)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, value string").coalesce(2)
    path = new_path(spark, "test-warc")
    warc.write_warc(pages, path)
    got = {r.page_id: r for r in warc.resolve_revisits(warc.read_warc(spark, path)).collect()}
    assert len(got) == len(rows)
    for page, _, html in rows:
        data = (html or "").encode()
        assert got[page].payload_bytes == len(data)
    assert got[9].record_type == "response" and got[3].refers_to == 9 and got[None].refers_to == 9
    import base64

    assert got[4].payload_digest == base64.b32encode(hashlib.sha1((inner + "é").encode()).digest()).decode()


def test_warc_with_repeated_ids(spark):
    rows = [(5, "u", "A" * 10), (5, "u", "B" * 20), (3, "u", "A" * 10), (3, "u", "A" * 10), (2, "u", "B" * 20)]
    path = new_path(spark, "test-warc")
    warc.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string"), path)
    got = warc.resolve_revisits(warc.read_warc(spark, path)).select("page_id", "payload_bytes", "record_type", "refers_to").collect()
    assert sorted(map(tuple, got)) == [(2, 20, "revisit", 5), (3, 10, "revisit", 5), (3, 10, "revisit", 5), (5, 10, "response", None), (5, 20, "response", None)]


def test_warc_chains_run_across_splits(spark):
    rng = random.Random(4)
    fake = "WARC/1.1\r\nContent-Length: {}\r\n\r\n"
    bits = [fake.format(n) for n in (0, 3, 40, 500)] + ["x" * 30, "\r\n\r\n", "é ", "WARC/1.1\r\n"]
    rows = [(i, "u", "".join(rng.choice(bits) for _ in range(rng.choice((0, 1, 9, 200))))) for i in range(120)]
    path = new_path(spark, "test-warc")
    warc.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(3), path)
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        got = warc.read_warc(spark, path).select("record_type", "page_id", "payload", "sound").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert len(got) == len(rows) and all(r.sound for r in got)
    texts = {i: t for i, _, t in rows}
    for r in got:
        assert bytes(r.payload).decode() == (texts[r.page_id] if r.record_type == "response" else "")


def test_warc_keeps_all_records_when_splits_change(spark):
    rows = [(i, "u", f"page {i} " + "WARC/1.1\r\n" * (i % 3) + "x" * (i % 700)) for i in range(3000)]
    path = new_path(spark, "test-warc")
    warc.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), path)
    records = warc.read_warc(spark, path)
    try:  # as if executors came between plan and action, so that Spark would cut the archive anew
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", "64")
        spark.conf.set("spark.sql.files.openCostInBytes", "1000")
        got = {r.page_id: bytes(r.payload).decode() for r in records.collect() if r.sound}
    finally:
        spark.conf.unset("spark.sql.leafNodeDefaultParallelism")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == {i: t for i, _, t in rows}


def test_warc_of_long_pages_and_clashing_columns(spark):
    long = "é\r\n" * 300_000 + "WARC/1.1\r\nContent-Length: 5\r\n\r\nabcde\r\n\r\n" * 500
    rows = [(1, "u", long, "f", 7, "b"), (2, None, long, "f", 7, "b"), (3, "u", long + "!", "f", 7, "b")]
    path = new_path(spark, "test-warc")
    warc.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string, file string, block long, digest string"), path)
    got = {r.page_id: (r.payload_bytes, r.record_type, r.refers_to) for r in warc.resolve_revisits(warc.read_warc(spark, path)).collect()}
    n = len(long.encode())
    assert got == {1: (n, "revisit", 2), 2: (n, "response", None), 3: (n + 1, "response", None)}


def test_lines_of_a_long_text_with_a_shared_line(spark):
    long = "\n".join(f"line {i}" for i in range(100_000)) + "\nshared by ten"
    rows = [(0, long)] + [(i, "shared by ten\nown %d" % i) for i in range(1, 10)]
    got = {r.row.doc_id: r for r in linededup.drop_shared_lines(docs(spark, rows)).collect()}
    assert got[0].n_lines == 100_001 and got[0].n_dropped == 1 and got[0].kept_text == long[: -len("\nshared by ten")]


def test_warc_of_no_pages(spark):
    path = new_path(spark, "test-warc")
    warc.write_warc(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert warc.read_warc(spark, path).count() == 0


def test_weak_credentials_need_a_complement(spark):
    both = "user: alice_01 and pass = hunter22"
    got = {r.doc_id: r.spans for r in secrets.scan(docs(spark, [(1, both), (2, "user: alice_01 alone"), (3, "pass = hunter22"), (4, "user: bob_1 " + "x " * 300 + "pwd: hunter22")])).select("row.doc_id", secrets.spelled(F.col("extra")).alias("spans")).collect()}
    assert got[1] == "identifier:0:14,weak_secret:19:34" and got[2] == got[3] == got[4] == ""


def test_feistel_is_a_permutation_within_its_format():
    f = pii.Feistel(b"k")
    for size in (1, 2, 7, 100, 366):
        assert sorted(f.permute(x, size, "t") for x in range(size)) == list(range(size))
        assert all(f.permute(f.permute(x, size, "t"), size, "t", back=True) == x for x in range(size))


def test_pseudonyms_link_and_go_back():
    f = pii.Feistel(b"k")
    text = "card 4845168114407329 and 4845-1681-1440-7329, 1234567890123456; on 2020-02-29 or 29/02/2020; 10.0.0.1 300.1.1.1; a.b@c.org; +1 (017) 555-7713; 123-45-6789; 2021-02-30"
    masked, spans = pii.replace(text, f)
    kinds = Counter(k for k, _, _ in spans)
    assert kinds == {"card": 2, "date": 2, "ipv4": 1, "email": 1, "phone": 1, "ssn": 1}
    assert "1234567890123456" in masked and "300.1.1.1" in masked and "2021-02-30" in masked
    numbers = re.findall(r"\d{16}|\d{4}-\d{4}-\d{4}-\d{4}", masked)
    assert numbers[0] == numbers[1].replace("-", "") and pii.card_valid(numbers[0])
    assert pii.replace(masked, f, back=True)[0] == text


def test_values_beside_other_numbers_are_found():
    f = pii.Feistel(b"k")
    card, iban = "4111 1111 1111 1111", "BE68 5390 0754 7034"
    around = ["{} 12/27", "{} 737 ok", "738 {}", "12 34 56 78 {}", "{}-737", "9-{} 5", "{}, 100", "1 {} 2"]
    for value, kind, forms in ((card, "card", around), (card.replace(" ", "-"), "card", around), (card.replace(" ", ""), "card", around), (iban, "iban", ["{} EUR 100", "{} 1234 5678 9012 3456 7890", "AB13 3456 7890 {}", "{} X", "{}"]), (iban.replace(" ", ""), "iban", ["{} EUR", "XX00 AAAA {} B1"])):
        for form in forms:
            text = form.format(value)
            masked, spans = pii.replace(text, f)
            at = text.index(value)
            assert (kind, at, at + len(value)) in spans and value not in masked, text
            assert len(masked) == len(text)
    text = f"{card} {card} {iban} DE89 3704 0044 0532 0130 00 {card[:-1]}2"
    masked, spans = pii.replace(text, f)
    assert [k for k, _, _ in spans] == ["card", "card", "iban", "iban"] and masked.endswith(f" {card[:-1]}2")
    assert masked[:19] == masked[20:39] == pii.replace(card, f)[0]
    long = "1 " * 50_000
    assert len(pii.replace(long + "x", f)[0]) == len(long) + 1


def test_codec_equals_the_library():
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    codec, lib = bpe.Codec(path), Tokenizer.from_file(path)
    rng = random.Random(3)
    bits = [" ", "  ", "\n", "\t", "a", "é", "<|endoftext|>", "日本", "'s", "1", "!!", "\r\n", "xyz ", "😀", "\x85", "foo", "The"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 900))) for _ in range(60)] + ["a" * 5000, " " * 3000, "é " * 2000]
    for t in texts:
        want = lib.encode(t, add_special_tokens=False).ids
        got = codec.encode(t)
        assert len(got) == 4 * len(want) and [int.from_bytes(got[i : i + 4], "little") for i in range(0, len(got), 4)] == want
        assert codec.decode(got) == lib.decode(want, skip_special_tokens=False)
        assert b"".join(bpe.segments(t.encode())) == t.encode()


def test_repeated_words_by_brute_force():
    rng = random.Random(5)
    for _ in range(100):
        words = [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(0, 60))]
        spans = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
        often = Counter(spans)
        hit = {i + j for i, s in enumerate(spans) if often[s] > 1 for j in range(8)}
        assert quality.repeated_words(words) == len(hit)


def test_automaton_by_brute_force():
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    rng = random.Random(1)
    terms = {"".join(rng.choice("abc") for _ in range(rng.randint(5, 7))): 1.0 for _ in range(30)}
    machine = toxicity.Automaton(terms)
    for _ in range(400):
        word = "".join(rng.choice("abcd") for _ in range(rng.randint(3, 9)))
        near = min(distance(word, t) for t in terms)
        got = machine.match(word)
        assert (got is not None) == (near <= 1) and (got is None or (got[1] == near and distance(word, got[0]) == near))


def test_probminhash_estimates_the_similarity():
    rng = random.Random(2)
    words = [f"w{rng.randint(0, 500)}".encode() for _ in range(300)]
    other = list(words)
    other[100] = b"zz"
    (a, n), (b, m) = minhash.shingles(words), minhash.shingles(other)
    want = len(set(a) & set(b)) / len(set(a) | set(b))
    got = (minhash.signature(a, n, 2048) == minhash.signature(b, m, 2048)).mean()
    assert abs(want - got) < 0.04


def test_near_duplicates_by_brute_force(spark):
    rng = random.Random(7)
    rows, base = [], []
    for i in range(40):
        if i % 4 == 0:
            base = [f"w{rng.randint(0, 3000)}" for _ in range(rng.randint(30, 200))]
        words = list(base)
        for _ in range(rng.choice([0, 0, 1, 2, 9])):
            words[rng.randrange(len(words))] = f"v{rng.randint(0, 99)}"
        rows.append((i, " ".join(words)))
    rows += [(100, rows[0][1].upper() + "!"), (101, ""), (102, None), (103, "one two"), (104, "one two")]
    sets = {}
    for i, t in rows:
        words = minhash.word_list(t or "")
        k = min(5, len(words))
        sets[i] = {tuple(words[j : j + k]) for j in range(len(words) - k + 1)} if words else None
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    got = {r.id: r.class_id for r in minhash.near_duplicates(docs(spark, rows)).collect()}
    assert got == {i: find(i) for i, _ in rows}
    kept = [r.doc_id for r in minhash.keep_one(docs(spark, rows)).collect()]
    assert sorted(kept) == sorted({find(i) for i, _ in rows})


def test_large_buckets_by_brute_force(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 25)
    rng = random.Random(11)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(rng.randint(0, 6)):
            words[rng.randrange(len(words))] = f"v{rng.randint(0, 999)}"
        if i % 5 == 0:
            words += words[: rng.randint(5, 60)]
        rows.append((i, " ".join(words)))
    sets = []
    for _, t in rows:
        elements, counts = minhash.shingles(minhash.word_list(t))
        sets.append(((elements >> 32).astype("uint32"), counts.astype("uint32")))
    assert all((s[0][1:] != s[0][:-1]).all() for s in sets)
    packed = [(s.tobytes(), c.tobytes() if (c > 1).any() else b"") for s, c in sets]
    root = list(range(150))
    for a in range(150):
        for b in range(a + 1, 150):
            if root[a] != root[b] and minhash.similarity(packed[a][0], packed[b][0], packed[a][1], packed[b][1]) >= 0.8:
                low, high = sorted((root[a], root[b]))
                root = [low if r == high else r for r in root]
    assert 1 < len(set(root)) < 150
    got = {r.id: r.class_id for r in minhash.near_duplicates(docs(spark, rows)).collect()}
    assert got == dict(enumerate(root))


def test_blocks_without_members(spark, monkeypatch):
    monkeypatch.setattr(minhash, "LATER", 6)
    monkeypatch.setattr(minhash, "BLOCK_BYTES", 900)
    rng = random.Random(5)
    rows = []
    for i in range(30):
        words = [f"w{j}" for j in range(150)]
        for _ in range(rng.randint(0, 7)):
            words[rng.randrange(len(words))] = f"v{rng.randint(0, 999)}"
        rows.append((i, " ".join(words)))
    sets = [(e >> 32).astype("uint32").tobytes() for e, _ in (minhash.shingles(minhash.word_list(t)) for _, t in rows)]
    root = list(range(30))
    for a in range(30):
        for b in range(a + 1, 30):
            if root[a] != root[b] and minhash.similarity(sets[a], sets[b]) >= 0.8:
                low, high = sorted((root[a], root[b]))
                root = [low if r == high else r for r in root]
    assert 1 < len(set(root)) < 30
    asked = []
    real = minhash._block_links
    monkeypatch.setattr(minhash, "_block_links", lambda *a: asked.append(1) or real(*a))
    got = {r.id: r.class_id for r in minhash.near_duplicates(docs(spark, rows)).collect()}
    assert asked and got == dict(enumerate(root))


def test_short_items_and_long_spans(spark):
    items = spark.createDataFrame([(1, "one two three"), (2, " ".join(f"w{i}" for i in range(12))), (3, None), (None, "zz yy")], "item_id long, text string")
    rows = [(1, "x ONE, two; three y one two"), (2, " ".join(f"w{i}" for i in range(1, 11))), (3, " ".join(f"w{i}" for i in range(9))), (4, "zz yy"), (5, None)]
    got = {r.doc_id: (r.n_hit, r.item_ids) for r in decontam.contamination(docs(spark, rows), items).select("row.doc_id", "n_hit", "item_ids").collect()}
    assert got == {1: (3, [1]), 2: (10, [2]), 3: (0, []), 4: (2, []), 5: (0, [])}


@pytest.mark.parametrize("window,k", [(10, 5), (6, 6), (4, 1), (7, 6)])
def test_contamination_by_brute_force(spark, window, k):
    rng = random.Random(window)
    some = lambda n, kinds: [rng.choice("abcdefghij"[:kinds]) for _ in range(n)]
    items = [some(rng.choice([1, 3, window - 1, window, window + 1, 40]), rng.choice([1, 2, 10])) for _ in range(12)] + [[]]
    docs_in = []
    for _ in range(120):
        words = some(rng.randint(0, 30), rng.choice([1, 3, 10]))
        for _ in range(rng.randint(0, 3)):
            item = rng.choice(items)
            a = rng.randint(0, len(item))
            words += item[a : a + rng.randint(0, 2 * window)] + some(rng.randint(0, 4), 10)
        docs_in.append(words)
    got = decontam.contamination(docs(spark, [(i, " ".join(w)) for i, w in enumerate(docs_in)]), spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string"), window=window, k=k)
    for r in got.select("row.doc_id", "n_words", "n_hit", "item_ids").collect():
        w, hit, ids = docs_in[r.doc_id], set(), set()
        for i, item in enumerate(items):
            n = min(window, len(item))
            spans = {tuple(item[a : a + n]) for a in range(len(item) - n + 1)} if n else set()
            for a in range(len(w) - n + 1) if n else ():
                if tuple(w[a : a + n]) in spans:
                    hit |= set(range(a, a + n))
                    ids.add(i)
        assert (r.n_words, r.n_hit, set(r.item_ids)) == (len(w), len(hit), ids), w


def test_language_of_held_out_rows(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    got = queries.op6_language(spark, SF).join(df.select("doc_id", "lang"), "doc_id").where("held_out")
    assert got.where("lang_pred = lang").count() >= 0.95 * got.count()
    assert langid.Filters.of({}).predict("x") == ("und", 0.0)


def test_pipeline(spark):
    import corpus_pipeline

    docs_in = spark.read.parquet(f"{SF}/documents.parquet")
    at = docs_in
    for name, stage in corpus_pipeline.STAGES[:-1]:
        at = stage(spark, at, SF)
        assert at.columns == docs_in.columns
    out = corpus_pipeline.run(spark, SF)
    texts = {r.doc_id: r.text for r in out.collect()}
    assert 0 < len(texts) < docs_in.count()
    codec = bpe.Codec(queries.tokenizer_path())
    for r in out.select("doc_id", "text", "n_tokens").take(20):
        assert len(codec.encode(r.text)) // 4 == r.n_tokens
    lines = Counter(k for t in texts.values() for k in {x.strip(" \t\r\x0b\x0c").lower() for x in t.split("\n")} if k)
    assert max(lines.values()) < 10
