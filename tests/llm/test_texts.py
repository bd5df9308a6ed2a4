"""Language, packing, mixing, scoring, line rules, shards and archives."""

import base64
import collections
import functools
import hashlib
import math
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tidewright.llm import language, line_rules, mixing, packing, queries, scoring, sharding, warc
from tidewright.session import fresh_path

TOKENIZERS = {}
FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, row int, size int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, 1, "k", 2, 3) for i, t, lang, s in rows], SCHEMA)


ODD = [(1, None, None, None), (2, "", "en", "a"), (3, " \n\t", "en", "a"), (4, "one", "en", None), (4, "one", "en", None),
       (5, "x " * 30_000, "fr", "b"), (None, "no id here", "en", "b"), (6, "12 34 !!", "en", "a")]


def test_language_of_rows_not_learned_from(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = queries.QUERIES["op4_language"](spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").collect()
    unseen = [r for r in out if r.held_out]
    assert len(unseen) > 100 and len(out) == docs.count()
    assert np.mean([r.lang_pred == r.lang for r in unseen]) > 0.97
    assert all(0 <= r.score <= 1 for r in out)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out)


def brute_grams(text):
    low = f"\n{(text or '').lower()}\n"
    return [tuple(c if c.isalpha() else "" for c in low[i - 1:i + 2]) for i in range(1, len(low) - 1) if low[i].isalpha()]


def test_language_as_sets_of_ngrams(spark):
    """Filters tell what sets of n-grams tell, up to hits by chance, which are few and corrected."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    taught = docs.filter("doc_id % 2 = 0")
    counts = collections.defaultdict(collections.Counter)
    for r in taught.collect():
        if r.text is not None and r.lang is not None:
            counts[r.lang].update(brute_grams(r.text))
    known = {lang: {g for g, n in c.items() if n >= max(2, language.SHARE * c.total())} for lang, c in counts.items()}
    judged = language.predict(docs, language.train(taught)).collect()
    assert len(judged) == docs.count()
    for r in judged:
        own = brute_grams(r.text)
        share = {lang: sum(g in known[lang] for g in own) / max(1, len(own)) for lang in sorted(known)}
        best, *rest = sorted(share.values(), reverse=True)
        if not own:
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        assert abs(r.score - best) < 0.01 and share[r.lang_pred] > best - 0.01
        if best - rest[0] > 0.01:
            assert share[r.lang_pred] == best


def test_language_of_odd_rows(spark):
    learned = language.train(frame(spark, [(i, f"the cat {i} sat on the mat", "en", "s") for i in range(5)]
                                   + [(i, f"die katze {i} sitzt auf", "de", "s") for i in range(5)]))
    assert learned.langs == ["de", "en"]
    out = language.predict(frame(spark, ODD), learned).collect()
    assert len(out) == len(ODD)
    assert {(r.doc_id, r.lang_pred, r.score) for r in out if r.doc_id in (1, 2, 3, 6)} == {(i, "und", 0.0) for i in (1, 2, 3, 6)}
    none = language.train(frame(spark, []))
    assert {r.lang_pred for r in language.predict(frame(spark, ODD), none).collect()} == {"und"}
    assert language.predict(frame(spark, []), learned).collect() == []


def test_filters_miss_nothing_and_slices_agree(monkeypatch):
    keys = np.concatenate([k for _, k in language.grams(["The quick brown fox"])])
    places = list(language.slots_of(keys, 1 << 12))
    word = np.zeros(1 << 12, np.uint64)
    for p in places:
        word[p] |= np.uint64(1)
    own = language.Filters(["en"], [word], np.array([0.0]))
    assert own.hits(keys, np.zeros(len(keys), int), 1)[0, 0] == len(keys)
    text = "Ça va très bien, merci. " * 9
    whole = np.sort(np.concatenate([k for _, k in language.grams([text])]))
    monkeypatch.setattr(language, "SLICE", 7)
    assert (whole == np.sort(np.concatenate([k for _, k in language.grams([text])]))).all()


@functools.cache
def ids_of(text):
    from tokenizers import Tokenizer

    tok = TOKENIZERS.setdefault(0, Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")))
    return [*tok.encode(text or "", add_special_tokens=False).ids, 0]


def check_packed(rows, texts, sequence):
    by_doc, by_seq = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    assert set(by_doc) == set(texts)
    for i, own in by_doc.items():
        ids, at = ids_of(texts[i]), 0
        for r in sorted(own, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.length > 0
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at:at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    full = 0
    for own in by_seq.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= sequence
        full += at == sequence
    assert full >= len(by_seq) - 1


@pytest.mark.parametrize("sequence,window", [(1024, 64), (64, 2), pytest.param(10, 1, marks=pytest.mark.slow)])
def test_packing_round_trip(spark, sequence, window):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").repartition(5)
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), sequence=sequence, window=window).collect()
    check_packed(rows, texts, sequence)
    if window == 2:  # each window holds every source in proportion
        source = {r.doc_id: r.source for r in docs.collect()}
        total, per = collections.Counter(), collections.defaultdict(collections.Counter)
        for r in rows:
            total[source[r.doc_id]] += r.length
            per[r.window][source[r.doc_id]] += r.length
        everything = sum(total.values())
        for w in per.values():
            if sum(w.values()) == sequence * window:
                assert all(abs(w[s] - sequence * window * total[s] / everything) < 2 for s in total)


def test_packing_of_odd_rows(spark):
    rows = packing.pack(frame(spark, ODD), public_tokenizers.path("byte_bpe_50k.json")).collect()
    assert sum(r.length for r in rows) == sum(len(ids_of(t)) for _, t, _, _ in ODD)
    assert packing.pack(frame(spark, []), public_tokenizers.path("byte_bpe_50k.json")).collect() == []
    tiny = [(i, "many words of a large source " * 40, "en", "big") for i in range(60)] + [(100 + i, "a", "en", f"t{i}") for i in range(9)]
    check_packed(packing.pack(frame(spark, tiny), public_tokenizers.path("byte_bpe_50k.json"), sequence=16, window=2).collect(),
                 {i: t for i, t, _, _ in tiny}, 16)
    special = {1: "<|endoftext|> tail", 2: "a <|endoftext|> b", 3: "<|endoftext", 4: "x<|endoftext|><|endoftext|>"}
    assert ids_of(special[2]) == [64, 220, 50256, 275, 0]
    wide = packing.pack(frame(spark, [(i, t, "en", "a") for i, t in special.items()]), public_tokenizers.path("byte_bpe_50k.json")).collect()
    check_packed(wide, special, 1024)


def reshared(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        left, w = total - sum(fixed.values()), sum(weight[s] for s in names if s not in fixed)
        share = {s: left * weight[s] / w for s in names if s not in fixed} if w else {}
        over = [s for s in share if share[s] > 3 * sizes[s]]
        if not over:
            return {**share, **fixed}
        fixed.update({s: 3 * sizes[s] for s in over})


def test_mixing(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "source")
    extra = spark.createDataFrame([(9000 + i, "a b c", "tiny") for i in range(3)] + [(9100, "x y", None), (9101, None, "tiny")], docs.schema)
    df = docs.union(extra)
    rows = mixing.mix(df).collect()
    assert len(rows) == df.count()
    own = {r.doc_id: r for r in rows}
    words = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in df.collect()}
    assert all(own[i].size == n and 0 <= own[i].taken <= 3 * n for i, n in words.items())
    sizes, taken, most = collections.Counter(), collections.Counter(), collections.Counter()
    for r in rows:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        most[r.source] = max(most[r.source], r.size)
    want = reshared(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, want[r.source], rel_tol=1e-9)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= max(0.02 * want[s], most[s] / 2), s
    again = mixing.mix(df.repartition(7)).collect()
    assert collections.Counter(rows) == collections.Counter(again)


def test_rates_solve_the_dual(spark):
    df = spark.createDataFrame([(i, "w " * (1 + i % 17), "big" if i % 4 else "small") for i in range(400)], "doc_id bigint, text string, source string")
    rows = mixing.mix(df).collect()
    for s in ("big", "small"):
        own = [r for r in rows if r.source == s]
        assert math.isclose(sum(r.rate * r.size for r in own), own[0].target, rel_tol=1e-4)
        open_ = sorted({(r.size, round(math.log(r.rate), 4)) for r in own if r.rate < 2.999})
        slopes = {round(x / n, 3) for n, x in open_}
        assert len(slopes) <= 2  # log rates are in proportion to size


def test_mixing_of_odd_rows(spark):
    rows = mixing.mix(frame(spark, ODD)).collect()
    assert len(rows) == len(ODD) and all(r.taken <= 3 * r.size for r in rows)
    assert mixing.mix(frame(spark, [])).collect() == []
    assert [(r.taken, r.target) for r in mixing.mix(frame(spark, [(1, None, None, None)])).collect()] == [(0, 0.0)]


def brute_pairs(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return list(zip(["<s>", *words[:-1]], words)) if words else []


def test_scores_as_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(7000, None), (7001, ""), (7002, "never seen words")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    good = {r.doc_id for r in spark.read.parquet(f"{FOLDER}/labels.parquet").filter("quality = 1").collect()}
    size = {i: len((t or "").encode()) for i, t in rows}
    drawn = min(1.0, sum(size[i] for i in good if i in size) / sum(size.values()))
    place = {r.doc_id: r.p for r in df.select("doc_id", (F.pmod(F.xxhash64(F.lit(17), "doc_id"), F.lit(1 << 30)) / float(1 << 30)).alias("p")).collect()}
    sample = [(True, t) for i, t in rows if i in good] + [(False, t) for i, t in rows if place[i] < drawn]
    count = collections.Counter(w for _, t in sample for _, w in brute_pairs(t))
    total = sum(count.values())
    words = {w for w, n in count.items() if n >= max(2, 1e-6 * total)}
    code = lambda w: w if w in words or w == "<s>" else "<unk>"
    pair, before, v = ({True: collections.Counter(), False: collections.Counter()} for _ in range(3))
    for flag, t in sample:
        own = [(code(a), code(b)) for a, b in brute_pairs(t)]
        pair[flag].update(own)
        before[flag].update(b for _, b in own)
        before[flag]["<s>"] += 1
    v = len(words) + 2
    got = {r.doc_id: r for r in scoring.score(df, spark.createDataFrame([(i,) for i in good], "doc_id bigint"), least=2).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        own = [(code(a), code(b)) for a, b in brute_pairs(t)]
        loss = {}
        for flag in (True, False):
            seen = lambda p: pair[flag][p] if pair[True][p] + pair[False][p] >= 2 else 0  # noqa: E731, B023
            loss[flag] = sum(math.log(before[flag][a] + 0.1 * v) - math.log(seen((a, b)) + 0.1) for a, b in own) / max(1, len(own))
        assert got[i].n_tokens == len(own)
        assert math.isclose(got[i].loss_target, loss[True], rel_tol=1e-9, abs_tol=1e-9)
        assert math.isclose(got[i].loss_difference, loss[True] - loss[False], rel_tol=1e-6, abs_tol=1e-9)


def losses(rows, sample, least, learned_from=None):
    """(loss_target, loss_background) by id with words seen twice and pairs seen `least` times in the sample, without the counts of
    the text itself in the models that learned_from(id) names."""
    count = collections.Counter(w for _, t in sample for _, w in brute_pairs(t))
    code = lambda w: w if count[w] >= 2 or w == "<s>" else "<unk>"
    pair, before = ({True: collections.Counter(), False: collections.Counter()} for _ in range(2))
    for flag, t in sample:
        own = [(code(a), code(b)) for a, b in brute_pairs(t)]
        pair[flag].update(own)
        before[flag].update(["<s>", *(b for _, b in own)])
    v = sum(n >= 2 for n in count.values()) + 2
    out = {}
    for i, t in rows:
        own = [(code(a), code(b)) for a, b in brute_pairs(t)]
        seen = lambda f, p: pair[f][p] if pair[True][p] + pair[False][p] >= least else 0
        mine = {f: bool(learned_from and f in learned_from(i)) for f in (True, False)}
        pairs, firsts = collections.Counter(own), collections.Counter(["<s>", *(b for _, b in own)])
        out[i] = [sum(math.log(before[f][a] - mine[f] * firsts[a] + 0.1 * v) - math.log(seen(f, (a, b)) - mine[f] * pairs[a, b] + 0.1)
                      for a, b in own) / max(1, len(own)) for f in (True, False)]
    return out


def test_op2_counts_every_pair(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    place = (F.pmod(F.xxhash64(F.lit(17), "doc_id"), F.lit(1 << 30)) / float(1 << 30)).alias("p")
    rows = [(r.doc_id, r.text, r.p) for r in docs.select("doc_id", "text", place).collect()]
    good = {r.doc_id for r in spark.read.parquet(f"{FOLDER}/labels.parquet").filter("quality = 1").collect()}
    size = lambda own: sum(len((t or "").encode()) for _, t, _ in own)
    drawn = min(1.0, size([r for r in rows if r[0] in good]) / size(rows))
    sample = [(True, t) for i, t, _ in rows if i in good] + [(False, t) for _, t, p in rows if p < drawn]
    drawn_ids = {i for i, _, p in rows if p < drawn}
    want = losses([r[:2] for r in rows], sample, 1, lambda i: {f for f, ids in ((True, good), (False, drawn_ids)) if i in ids})
    got = queries.QUERIES["op2_lm_scoring"](spark, FOLDER).collect()
    assert len(got) == len(rows)
    for r in got:
        assert np.allclose([r.loss_target, r.loss_background], want[r.doc_id], rtol=1e-9)


def test_words_stay_known_in_a_large_corpus(spark):
    rows = [(0, "x " * 3_100_000), (1, "rare word here"), (2, "word rare"), (3, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(2)
    got = {r.doc_id: r for r in scoring.score(df, df.select("doc_id"), least=2).collect()}
    want = losses(rows, [(flag, t) for _, t in rows for flag in (True, False)], 2)
    assert all(np.allclose([got[i].loss_target, got[i].loss_background], want[i], rtol=1e-9) for i, _ in rows)


@pytest.mark.parametrize("part,bucket,hot", [(300, 200, 1000), (2000, 64, 2)])
def test_scores_in_many_parts(spark, monkeypatch, part, bucket, hot):
    """A text's scores do not depend on parts and buckets; a key of many rows goes to many parts."""
    rows = [(i % 40 if i % 3 else 7, f"some words {i % 5} and {i % 11} more of them {'x' * (i % 4)}") for i in range(300)]
    rows += [(None, "a text without key " * 3)] * 9 + [(8, "the same row again")] * 50 + [(9, None), (9, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    good = spark.createDataFrame([(7,), (8,), (12,), (None,)], "doc_id bigint")
    whole = [collections.Counter((r.doc_id, r.n_tokens, round(r.loss_target, 9), round(r.loss_background, 9))
                                 for r in scoring.score(df, good, leave_out=out).collect()) for out in (False, True)]
    for name, value in (("PART", part), ("BUCKET", bucket), ("HOT", hot)):
        monkeypatch.setattr(scoring, name, value)
    for out in (False, True):
        got = scoring.score(df, good, leave_out=out).collect()
        assert collections.Counter((r.doc_id, r.n_tokens, round(r.loss_target, 9), round(r.loss_background, 9)) for r in got) == whole[out]


def test_scores_of_odd_rows(spark):
    none = spark.createDataFrame([], "doc_id bigint")
    assert len(scoring.score(frame(spark, ODD), none).collect()) == len(ODD)
    assert scoring.score(frame(spark, []), none).collect() == []


def test_lines_as_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    cur = con.execute(queries.ORACLES["op7_line_rules"])
    names = [d[0] for d in cur.description]
    want = collections.Counter(cur.fetchall())
    got = collections.Counter(tuple(r[n] for n in names) for r in queries.QUERIES["op7_line_rules"](spark, FOLDER).collect())
    assert got == want


def test_frequent_lines_go(spark):
    rows = [(i, f"Terms of use {i % 10}\nAll rights reserved here\n" + " ".join("w" + chr(97 + i % 26) + chr(97 + i // 26) + chr(97 + j) for j in range(12 if i % 2 else 3)), "en", "a")
            for i in range(60)]
    rows += [(100 + i, "a copied text stands here often\nwith two lines of many words each", "en", "a") for i in range(40)]
    got = {r.doc_id: r for r in line_rules.check_lines(frame(spark, rows)).collect()}
    assert all(got[i].removed_words == 8 for i in range(60))
    assert [got[i].kept for i in range(4)] == [False, True, False, True]
    assert all(got[100 + i].kept for i in range(40))


def test_further_documents_bring_no_line_back(spark):
    line = "This work is licensed under these terms here"
    letters = lambda i: "".join(chr(97 + int(c)) for c in str(i))  # noqa: E731  digits are all alike to the rules
    own = [(i, f"{line}\n" + " ".join(f"w{letters(i)}x{letters(j)}" for j in range(12)), "en", "a") for i in range(60)]
    few = {r.doc_id: r.removed_words for r in line_rules.check_lines(frame(spark, own)).collect()}
    others = spark.range(1000, 31_000).select(
        F.col("id").alias("doc_id"), F.concat_ws(" ", *[F.concat(F.lit(f"v{letters(j)}x"), F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij"))
                                                       for j in range(12)]).alias("text"),
        F.lit("en").alias("lang"), F.lit("a").alias("source"), F.lit(1).cast("long").alias("n_chars"), F.lit("k").alias("key"),
        F.lit(2).alias("row"), F.lit(3).alias("size"))
    many = line_rules.check_lines(frame(spark, own).union(others)).filter("doc_id < 1000").collect()
    assert set(few.values()) == {8} and {r.doc_id: r.removed_words for r in many} == few


def test_lines_of_odd_rows(spark):
    got = line_rules.check_lines(frame(spark, [*ODD, (8, "a b c d e\nx\nx\n \na b c d e z #|", "en", "a")])).collect()
    assert len(got) == len(ODD) + 1
    r = next(r for r in got if r.doc_id == 8)
    assert (r.n_words, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == (14, 2, 1, 10, True)
    assert all(r.base_failed and not r.kept for r in got if r.doc_id in (1, 2, 3, 4, 6))
    assert next(r for r in got if r.doc_id == 5).n_repeat_words == 30_000
    assert line_rules.check_lines(frame(spark, [])).collect() == []


def test_table_filled_in_turns():
    names, slots = ["a", "b", "c"], 13
    free, owner, at = set(range(slots)), {}, [0, 0, 0]
    prefs = []
    for n in names:
        d = hashlib.md5(n.encode()).hexdigest()
        start, step = int(d[:15], 16) % slots, int(d[15:30], 16) % (slots - 1) + 1
        prefs.append([(start + k * step) % slots for k in range(slots)])
    while free:
        for i in range(3):
            if free:
                while prefs[i][at[i]] not in free:
                    at[i] += 1
                owner[prefs[i][at[i]]] = i
                free.discard(prefs[i][at[i]])
    assert sharding.filled_slots(names, slots) == [owner[s] for s in range(slots)]


def test_few_slots_change_hands():
    names = [f"s{i}" for i in range(20)]
    before, after = sharding.filled_slots(names), sharding.filled_slots(names[:-1])
    stay = sum(a == b for a, b in zip(before, after) if a != 19)
    assert stay / sum(b != 19 for b in before) > 0.8
    share = collections.Counter(before)
    assert max(share.values()) - min(share.values()) <= 1
    heavy = collections.Counter(sharding.filled_slots(["a", "b"], 101, [3, 1]))
    assert abs(heavy[0] - 3 * heavy[1]) <= 4
    with pytest.raises(ValueError):
        sharding.filled_slots(names, 100)


def test_placement(spark):
    df = frame(spark, ODD).withColumn("slot", F.lit("x"))
    rows = sharding.place(df, "doc_id", ["a", "b"], 101).collect()
    owner = sharding.filled_slots(["a", "b"], 101)
    assert len(rows) == len(ODD)
    for r in rows:
        text = "" if r.doc_id is None else str(r.doc_id)
        assert r.slot == int(hashlib.md5(text.encode()).hexdigest()[:15], 16) % 101
        assert r.shard == ["a", "b"][owner[r.slot]]


def test_archive_round_trip(spark):
    pages = [(3, "http://a", "<p>é</p>"), (1, "http://b", "<p>é</p>"), (2, None, None), (5, "u\r\nX: y", ""), (None, "n", "<p>é</p>"),
             (7, "c", "q"), (8, "d", "WARC/1.1\r\n\r\n"), (7, "c", "q")]
    path = fresh_path(spark, "archive")
    warc.write_archive(spark.createDataFrame(pages, "page_id bigint, url string, html string"), path)
    rows = warc.read_archive(spark, path).collect()
    assert len(rows) == len(pages)
    want = collections.Counter()
    for i, _, html in pages:
        raw = (html or "").encode()
        first = min((k for k, _, h in pages if (h or "").encode() == raw and k is not None), default=None)
        want[(i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if i == first else "revisit",
              None if i == first else first)] += 1
    assert collections.Counter((r.key, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows) == want
    for r in rows:
        head, _, body = bytes(r.record).partition(b"\r\n\r\n")
        assert head + b"\r\n\r\n" == r.header.encode() and body.endswith(b"\r\n\r\n")
        assert body[:-4] == (bytes(r.payload) if r.record_type == "response" else b"")
        assert f"Content-Length: {len(body) - 4}".encode() in head
    assert spark.read.parquet(f"{path}/payloads").count() == 4
    small = fresh_path(spark, "archive")
    warc.write_archive(spark.createDataFrame(pages, "page_id bigint, url string, html string"), small, least_bytes=5)
    assert {r.key: r.record_type for r in warc.read_archive(spark, small).collect()}[5] == "response"


def test_broken_payload_is_noticed(spark):
    path = fresh_path(spark, "archive")
    warc.write_archive(spark.createDataFrame([(1, "u", "text")], "page_id bigint, url string, html string"), path)
    spark.read.parquet(f"{path}/payloads").withColumn("bytes", F.lit("tent").cast("binary")).write.parquet(f"{path}/other")
    spark.read.parquet(f"{path}/other").write.mode("overwrite").parquet(f"{path}/payloads")
    with pytest.raises(Exception, match="differs"):
        warc.read_archive(spark, path).collect()
