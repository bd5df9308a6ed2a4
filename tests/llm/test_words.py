"""Spelling variants, byte-level BPE and periodic runs, against brute force."""

import base64
import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewright.llm import bpe, periods, queries, spelling
from tests.llm.test_texts import ODD, frame

FOLDER = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}


def brute_words(rows):
    count = collections.Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{i}:{low}".encode())
            if h % 97 == 0:
                low = low[:h % len(low)] + low[h % len(low) + 1:]
            count[low] += 1
    return {w: n for w, n in count.items() if len(w) >= 5 and n >= 3}


def brute_near(words):
    """Near words of each word: those that share it with one code point out, or with one wild."""
    shelf = collections.defaultdict(set)
    for w in words:
        shelf[w].add(w)
        for i in range(len(w)):
            shelf[w[:i] + w[i + 1:]].add(w)
            shelf[w[:i], w[i + 1:]].add(w)
    near = collections.defaultdict(set)
    for key, own in shelf.items():
        for a in own:
            for b in own:
                if a != b and (isinstance(key, tuple) or key in (a, b)):
                    near[a].add(b)
    return near


def brute_variants(words):
    near, form = brute_near(words), {}
    for w in words:
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return out


def got_variants(df):
    rows = df.collect()
    out = {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows)
    return out


def test_variants_of_a_table(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    want = brute_variants(brute_words(rows))
    assert got_variants(queries.QUERIES["op11_spelling_variants"](spark, folder)) == want
    assert sum(w[1] is not None for w in want) > 50 and any(w[2] != w[1] for w in want if w[1])


def test_variants_of_made_words(spark):
    random.seed(5)
    words = {"aaaaa": 40, "ééééé": 9}
    for _ in range(400):
        w = "".join(random.choice("abé") for _ in range(random.randrange(5, 9)))
        words[w] = random.choice([3, 4, 8, 16, 40])
    words["x" * 3000], words["x" * 3001], words["y" + "x" * 3000] = 3, 7, 14
    df = spark.createDataFrame([(w, n, "extra") for w, n in words.items()], "word string, n bigint, form string").repartition(3)
    want = brute_variants({w: n for w, n in words.items()})
    assert got_variants(spelling.group_variants(df)) == want
    assert got_variants(spelling.group_variants(df, parts=6)) == want


def test_chain_of_forms(spark):
    chain = {"a" * (5 + i): 3 * 2 ** i for i in range(11)}
    df = spark.createDataFrame(list(chain.items()), "word string, n bigint")
    got = {r.word: r for r in spelling.group_variants(df).collect()}
    assert {r.root for r in got.values()} == {"a" * 15} and got["aaaaa"].form == "aaaaaa"
    assert got["a" * 15].form is None and got["a" * 15].n_near == 1


def test_words_of_odd_rows(spark, monkeypatch):
    docs = frame(spark, [*ODD, (10, "HÉLLO HÉllo hÉLLO éÉéÉé İstanbul", "en", "a")])
    assert {(r.word, r.n) for r in spelling.count_words(docs).collect()} == {("hÉllo", 3)}
    assert spelling.count_words(frame(spark, [])).collect() == []
    assert spelling.group_variants(spelling.count_words(frame(spark, []))).collect() == []
    twice = spark.createDataFrame([("words", 1), ("words", 2), ("word", 7), (None, 4), ("", 2), ("a", 9)], "word string, n bigint")
    got = {r.word: r for r in spelling.group_variants(twice).collect()}
    assert (got["words"].n, got["words"].form, got["words"].form_n, got[""].form) == (3, "word", 7, "a")
    monkeypatch.setattr(spelling, "CHARS", 10)
    assert list(spelling.runs_of("Some wordS, some", re.compile(spelling.LETTERS))) == ["some", "words", "some"]


def reference_encoding():
    import tiktoken

    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})


def test_ids_of_a_table(spark, texts):
    own = reference_encoding()
    got = queries.QUERIES["op12_byte_bpe"](spark, FOLDER).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = own.encode_ordinary(texts[r.doc_id] or "")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()


def test_ids_of_odd_texts(spark, monkeypatch):
    random.seed(2)
    own, made = reference_encoding(), bpe.Codec(RANKS, public_tokenizers.PATTERN)
    odd = ["", "a", "<|endoftext|> b", " \n\t x  ", "a" * 5000, "ab" * 3000, "é" * 900, "=" * 777, "\U0001f600‍́" * 50, "don't we'll '"]
    odd += ["".join(chr(random.choice([random.randrange(32, 127), random.randrange(0xA0, 0x2FF), random.randrange(0x3040, 0x9FFF)]))
                    for _ in range(random.randrange(60))) for _ in range(400)]
    odd += ["".join(random.choice("abcdeint ") for _ in range(4000))] + ["".join(random.choice("thesin") for _ in range(3000))]
    odd += ["inininin banana " * 20, "aaaa aaaaa aaaaaa"]
    for short in (256, 3):  # pre-tokens in one queue, and one by one
        monkeypatch.setattr(bpe, "SHORT", short)
        made.forget()
        for text, raw in zip(odd, made.encode(odd)):
            assert np.frombuffer(raw, "<u4").tolist() == own.encode_ordinary(text)
            assert made.decode(raw) == text.encode()
        assert made.queue.first() == -1
    docs = frame(spark, ODD).withColumn("ids", F.lit("clash"))
    rows = bpe.decode(bpe.encode(docs, RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN).collect()
    assert len(rows) == len(ODD) and all(bytes(r.bytes).decode() == (r.text or "") for r in rows)
    assert bpe.encode(frame(spark, []), RANKS, public_tokenizers.PATTERN).collect() == []


def test_every_code_point_is_cut_alike():
    own, made = reference_encoding(), bpe.Codec(RANKS, public_tokenizers.PATTERN)
    for low in range(0, 0x30000, 256):
        text = "".join(f"x{chr(c)}1" for c in range(low, low + 256) if not 0xD800 <= c < 0xE000)
        assert np.frombuffer(made.encode([text])[0], "<u4").tolist() == own.encode_ordinary(text), hex(low)


def test_queue_gives_lowest_rank_and_leftmost_place():
    random.seed(1)
    for ranks in (1, 64, 65, 5000, 300_000):
        queue, held = bpe.RankQueue(ranks), []
        for _ in range(600):
            if held and random.random() < 0.45:
                rank = queue.first()
                assert (rank, queue.pop(rank)) == held.pop(0)
            else:
                item = (random.randrange(ranks), random.randrange(1000))
                held = sorted([*held, item])
                queue.push(*item)
        while held:
            assert (queue.first(), queue.pop(queue.first())) == held.pop(0)
        assert queue.first() == -1


def test_small_memory_of_pre_tokens(monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN", 3)
    own, made = reference_encoding(), bpe.Codec(RANKS, public_tokenizers.PATTERN)
    text = "several quite different words stand here, several of them twice"
    for _ in range(3):
        assert [np.frombuffer(x, "<u4").tolist() for x in made.encode([text, "and more"])] == [own.encode_ordinary(t) for t in (text, "and more")]
    made.encode(["x"])
    assert len(made) == 1


def brute_runs(words, least=6, times=4):
    out = []
    for q in range(1, len(words) // times + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            length = i + q - start
            if i > start and length >= max(least, times * q):
                own = words[start:start + length]
                if not any(q % p == 0 and own[p:] == own[:-p] for p in range(1, q)):
                    out.append((start, length, q))
            i += 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_collapsed(words, runs):
    return " ".join(w for i, w in enumerate(words) if not any(a + q <= i < a + n for a, n, q in runs))


def made_texts(n):
    random.seed(3)
    out = [None, "", " \n", "a", "a " * 6, "a " * 5, "x " * 700, "a b " * 90 + "a b c " * 70, "  " * 8]
    for _ in range(n):
        size, kinds = random.choice([5, 12, 40, 120, 300]), random.choice([1, 2, 2, 3, 5, 50])
        w = [f"w{random.randrange(kinds)}" for _ in range(size)]
        if random.random() < 0.6:
            a = random.randrange(size)
            p = 1 + random.randrange(max(1, (size - a) // 3))
            w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
            if random.random() < 0.5:
                w += [f"w{random.randrange(kinds)}" for _ in range(30)]
        out.append(random.choice([" ", "\n", "  "]).join(w))
    return out


def check_runs(texts):
    runs, collapsed = periods.described(pa.array(texts, pa.string()), 6, 4)
    n = 0
    for text, own, short in zip(texts, runs.to_pylist(), collapsed.to_pylist()):
        words = [w.decode() for w in (text or "").encode().split()]
        want = brute_runs(words)
        assert [(r["start"], r["length"], r["period"]) for r in own] == want
        assert short == brute_collapsed(words, want)
        n += len(want)
    return n


def test_runs_as_brute_force(monkeypatch):
    assert check_runs(made_texts(400)) > 200
    monkeypatch.setattr(periods, "WORDS", 500)
    assert check_runs(made_texts(60)) > 30
    monkeypatch.setattr(periods.Fermat, "most", 8)  # the larger prime from the third scale on
    assert check_runs(made_texts(60)) > 30


def test_long_runs():
    words = [str(i) for i in range(70_000)] * 4
    runs, _ = periods.described(pa.array([" ".join(words), "y " * 200_000]), 6, 4)
    assert [[(r["start"], r["length"], r["period"]) for r in own] for own in runs.to_pylist()] == [[(0, 280_000, 70_000)], [(0, 200_000, 1)]]


def test_products_are_exact():
    rng = np.random.default_rng(4)
    for most in (1 << 16, 2):
        for block in (1, 2, 8, 64):
            x = rng.integers(0, 3, block * 9)
            x[block * 4:block * 7] = np.tile(x[:block], 3)
            before, periods.Fermat.most = periods.Fermat.most, most
            try:
                got = periods.occurrences(x, block)
            finally:
                periods.Fermat.most = before
            want = [[(x[j * block:(j + 1) * block] == x[j * block + d:(j + 1) * block + d]).all() for j in range(7)]
                    for d in range(block, 2 * block)]
            assert (got == np.array(want)).all()


def test_runs_of_a_table(spark, texts):
    got = {r.doc_id: r for r in queries.QUERIES["op13_periodic_runs"](spark, FOLDER).collect()}
    assert set(got) == set(texts)
    planted = 0
    for i, text in texts.items():
        words = [w.decode() for w in (text or "").encode().split()]
        h, n = zlib.crc32(str(i).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
            planted += 1
        if n > 3000:
            continue
        runs, r = brute_runs(words), got[i]
        best = max(runs, key=lambda x: (x[1], -x[0], -x[2]), default=None)
        assert r.n_runs == len(runs)
        assert (r.start, r.length, r.period) == (best or (None,) * 3)
        assert r.exponent_milli == (1000 * best[1] // best[2] if best else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(brute_collapsed(words, runs).encode()).hexdigest()
    assert planted > 5 and any(r.n_runs for r in got.values())


def test_runs_of_odd_rows(spark):
    rows = periods.find_runs(frame(spark, ODD).withColumn("runs", F.lit(1)).withColumn("_text_read", F.lit(1))).collect()
    assert len(rows) == len(ODD) and {"row", "size", "_text_read"} <= set(rows[0].asDict())
    assert {r.doc_id: len(r.runs) for r in rows}[5] == 1 and all(r.collapsed == "" for r in rows if r.doc_id in (1, 2, 3))
    assert periods.find_runs(frame(spark, [])).collect() == []


def test_no_join_of_words_goes_through_the_driver(spark, monkeypatch):
    """Spark sizes signatures as one for each word and written words as compressed, so it would broadcast them."""
    plans, settle = [], spelling.Scratch.settle
    text = lambda df: df._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(spelling.Scratch, "settle", lambda self, df, *a: (plans.append(text(df)), settle(self, df, *a))[1])
    words = {"aaaaa": 40, "aaaab": 9, "aaabb": 3, "bbbbb": 7}
    got = spelling.group_variants(spark.createDataFrame(list(words.items()), "word string, n bigint"))
    plans.append(text(got))
    assert sum("SortMergeJoin" in p for p in plans) > 2 and not any("Broadcast" in p for p in plans)
    assert got_variants(got) == brute_variants(words)
