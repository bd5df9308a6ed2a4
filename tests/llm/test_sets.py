"""Jaccard join, suffix arrays and embeddings against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tidewright.llm import embeddings, jaccard, suffixes, wordhash

DOCS = "doc_id bigint, text string, source string, key string"


def low(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", low(text))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1)))


def groups(nodes, links):
    name = {n: n for n in nodes}

    def top(x):
        while name[x] != x:
            x = name[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        name[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def brute_components(rows, k, percent):
    sets = [(i, shingles(t, k)) for i, t in rows if i is not None]
    links = [(a, b) for x, (a, s) in enumerate(sets) for b, t in sets[:x]
             if s and t and 100 * len(s & t) >= percent * len(s | t)]
    return groups({i for i, _ in sets}, links)


def near_rows(seed):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    passage = [r.choice(words) for _ in range(40)]
    rows = []
    for i in range(60):
        base = [r.choice(words) for _ in range(r.choice([1, 2, 3, 9, 12, 30, 150, 400]))] + (passage if i % 3 == 0 else [])
        rows.append(" ".join(base))
        for _ in range(r.choice([0, 0, 1, 4])):
            own = list(base)
            for _ in range(r.choice([0, 1, 2, 5])):
                own[r.randrange(len(own))] = r.choice(words)
            rows.append(("\t" if r.random() < 0.3 else "") + " ".join(own).upper())
    r.shuffle(rows)
    return list(enumerate(rows)) + [(900, None), (901, ""), (902, " \n"), (903, rows[0]), (903, rows[0]), (None, rows[1])]


@pytest.mark.parametrize("k,percent,heavy", [(3, 90, 64), (5, 80, 2), pytest.param(3, 70, 1, marks=pytest.mark.slow)])
def test_jaccard_as_brute_force(spark, monkeypatch, k, percent, heavy):
    monkeypatch.setattr(jaccard, "HEAVY", heavy)
    monkeypatch.setattr(jaccard, "BLOCK", 8 if heavy < 64 else 1024)
    rows = near_rows(k)
    df = spark.createDataFrame([(i, t, "s", "x") for i, t in rows], DOCS)
    got = jaccard.jaccard_components(df, words=k, percent=percent).collect()
    want = brute_components(rows, k, percent)
    assert len(got) == len(rows)
    assert {(r.doc_id, r.component_id) for r in got if r.doc_id is not None} == set(want.items())
    size = {i: len(shingles(t, k)) for i, t in rows}
    assert all(r.n_shingles == size[r.doc_id] for r in got)


def test_jaccard_on_the_smallest_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = {r.doc_id: r.component_id for r in jaccard.jaccard_components(docs).collect()}
    assert got == brute_components(rows, 3, 90)


def test_words_of_many_texts():
    texts = [f"Été {i} d'où\u00a0 là  x{i}" if i % 7 else None for i in range(1500)]
    hashes = [h for own in wordhash.shingle_sets(pa.array(texts), 3) for h in own.tolist()]
    alone = [h for t in texts for own in wordhash.shingle_sets(pa.array([t], pa.string()), 3) for h in own.tolist()]
    assert hashes == alone and len(hashes) > 3000


def test_few_words():
    for k in (1, 3, 5):
        for texts in (["a"], ["a b", None], ["a b c d"], [""]):
            assert [len(x) for x in wordhash.shingle_sets(pa.array(texts, pa.string()), k)] == [len(shingles(t, k)) for t in texts]


def test_words_of_long_texts():
    r = random.Random(8)
    words = ["".join(r.choice("abXYé") for _ in range(r.randrange(1, 9))) for _ in range(60_000)] + ["Q" * (wordhash.BLOCK + 5), "end"]
    text = " \n".join(words)
    hashes, size = wordhash.word_hashes(pa.array(["first", text, None, "", "end"]))
    assert size.tolist() == [1, len(words), 0, 0, 1]
    assert hashes[-1] == hashes[-2] and len(set(hashes.tolist())) == len({low(w) for w in words} | {"first"})
    alone = {w: wordhash.word_hashes(pa.array([w]))[0][0] for w in words[:50]}
    assert [alone[w] for w in words[:50]] == hashes[1:51].tolist()


def test_jaccard_of_nothing(spark):
    assert jaccard.jaccard_components(spark.createDataFrame([], DOCS)).collect() == []


def test_chain_of_links_is_one_group(spark):
    words = [f"c{i}" for i in range(130)]
    rows = [(i, " ".join(words[2 * i:2 * i + 62]), "s", "x") for i in range(30)]
    got = {r.component_id for r in jaccard.jaccard_components(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == set(brute_components([r[:2] for r in rows], 3, 90).values()) and 0 in got


@pytest.mark.parametrize("block", [pytest.param(1024, marks=pytest.mark.slow), 8])
def test_family_of_edited_copies(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    r = random.Random(4)
    base = [f"b{i}" for i in range(160)]
    rows = []
    for i in range(70):
        own = list(base)
        for _ in range(r.choice([2, 4, 6, 8])):
            own[r.randrange(len(own))] = f"x{i}y{r.randrange(9)}"
        rows.append((i, " ".join(own), "s", "x"))
    got = {x.doc_id: x.component_id for x in jaccard.jaccard_components(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == brute_components([x[:2] for x in rows], 3, 90)


@pytest.mark.parametrize("tops", [(3,), (3, 200), (15, 16, 255, 256, 70000)])
def test_counters_of_any_width(tops):
    rng = np.random.default_rng(1)
    rows = [rng.integers(0, top + 1, jaccard.SIEVE) for top in tops for _ in range(3)] + [np.full(jaccard.SIEVE, top) for top in tops]
    got = jaccard.counters_of(pa.array([jaccard.narrow(x) for x in rows], pa.binary()))
    assert (got == np.stack(rows)).all()


def test_boundary_of_least_cost():
    sizes = {20: 1000, 40: 1000, 300: 1000}
    at = jaccard.boundary(sizes, 90)
    assert 40 < at <= 300
    assert jaccard.boundary({}, 90) == 0


def brute_removed(texts, length):
    seen = Counter()
    for t in texts:
        seen.update(t[i:i + length] for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        cover = np.zeros(len(t) + 1, int)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                cover[i:i + length] = 1
        out.append(cover[:len(t)].astype(bool))
    return out


def check_removed(df, rows, **options):
    length = options.get("length", suffixes.LENGTH)
    texts = [(t or "").encode() for _, t in rows]
    want = Counter()
    for (i, _), raw, gone in zip(rows, texts, brute_removed(texts, length)):
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(int), [0]])))
        want[(i, len(raw), int(gone.sum()), len(edges) // 2, bytes(np.frombuffer(raw, np.uint8)[~gone]))] += 1
    got = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept_bytes))
                  for r in suffixes.remove_repeats(df, **options).collect())
    assert got == want


@pytest.mark.parametrize("seed,crowd", [pytest.param(0, 512, marks=pytest.mark.slow), (1, 2)])
def test_repeats_as_brute_force(spark, seed, crowd):
    r = random.Random(seed)
    letters = "abcdefghé"
    passage = "".join(r.choice(letters) for _ in range(60))
    rows = []
    for i in range(60):
        text = "".join(r.choice(letters) for _ in range(r.randrange(0, 150)))
        for _ in range(r.choice([0, 1, 1, 2])):
            a = r.randrange(0, 30)
            at = r.randrange(0, len(text) + 1)
            text = text[:at] + passage[a:a + r.randrange(15, 40)] + text[at:]
        rows.append((i, text))
    rows += [(100, None), (101, ""), (102, "z" * 75), (103, rows[3][1]), (3, rows[3][1]), (104, passage), (None, passage[::-1] * 2)]
    df = spark.createDataFrame([(i, t, "s", "x") for i, t in rows], DOCS)
    check_removed(df, rows, length=20, seed=8, crowd=crowd)


def test_repeats_on_the_smallest_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    big = "".join(random.Random(5).choice("abcdefgh ") for _ in range(2 * suffixes.CHUNK + 999))
    rows += [(5000, big), (5001, "x" * 300 + big[suffixes.CHUNK - 150:suffixes.CHUNK + 350])]
    check_removed(spark.createDataFrame(rows, "doc_id bigint, text string"), rows)


def test_repeats_of_nothing(spark):
    assert suffixes.remove_repeats(spark.createDataFrame([], DOCS)).collect() == []


def test_levels_double(spark):
    index = suffixes.SuffixLevels(spark)
    rows = [spark.createDataFrame([(i,), (100 + i % 2,)], "key bigint") for i in range(6)]
    for own in rows:
        index.add(own)
    assert [rank for rank, _ in index.levels] == [2, 1]
    assert {r.key for r in index.repeated().collect()} == {100, 101}
    index.close()


def brute_vectors(rows, threshold):
    dims = Counter(len(v) for _, v in rows if v).most_common(1)[0][0]

    def sound(v):
        return v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v) and any(v)

    own = [(i, np.array(v, float)) for i, v in rows if sound(v)]
    x = np.array([v / np.linalg.norm(v) for _, v in own])
    near = x @ x.T >= threshold
    np.fill_diagonal(near, False)
    links = {i: int(n) for (i, _), n in zip(own, near.sum(1))}
    name = groups({i for i, _ in rows}, [(own[a][0], own[b][0]) for a, b in zip(*np.nonzero(near))])
    return {i: (links.get(i, 0), name[i], name[i] == i) for i, _ in rows}


def vector_rows():
    r = np.random.default_rng(3)
    rows = []
    for c in range(30):
        centre = r.normal(size=16)
        for _ in range(12):
            rows.append((len(rows), [float(x) for x in centre + r.normal(size=16) * r.choice([0.01, 0.1, 0.3])]))
    rows += [(len(rows) + i, rows[0][1]) for i in range(40)]
    n = len(rows)
    return rows + [(n, None), (n + 1, []), (n + 2, [0.0] * 16), (n + 3, [float("nan")] * 16), (n + 4, [1.0, None] * 8),
                   (n + 5, [1.0, 2.0]), (n + 6, [float("inf")] + [1.0] * 15), (n + 7, [1e30 * x for x in rows[0][1]])]


@pytest.mark.parametrize("tile", [2048, 16])
def test_vectors_as_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(embeddings, "TILE", tile)
    rows = vector_rows()
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id bigint, embedding array<double>, n int")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.near_vectors(df).collect()}
    assert got == brute_vectors(rows, 0.95)


@pytest.mark.parametrize("tile", [2048, 16])
def test_vectors_of_every_length(spark, monkeypatch, tile):
    monkeypatch.setattr(embeddings, "TILE", tile)
    r = np.random.default_rng(5)
    rows = vector_rows()
    for dims in (8, 2, 1):
        rows += [(len(rows) + i, [float(x) for x in r.normal(size=dims)]) for i in range(60)]
        rows += [(len(rows) + i, [2 * x for x in rows[-1 - i][1]]) for i in range(40)]
        rows += [(len(rows) + i, rows[-1][1]) for i in range(5)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = {x.vec_id: (x.n_links, x.component_id, x.kept) for x in embeddings.near_vectors(df).collect()}
    want = {i: (0, i, True) for i, _ in rows}
    for dims in (16, 8, 2, 1):
        want.update(brute_vectors([(i, v) for i, v in rows if v and len(v) == dims], 0.95))
    assert got == want


def test_vectors_of_the_smallest_tables(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.near_vectors(df).collect()}
    assert got == brute_vectors(rows, 0.95)


def test_no_vectors(spark):
    df = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert embeddings.near_vectors(df).collect() == []
    alone = spark.createDataFrame([(1, None)], "vec_id bigint, embedding array<float>")
    assert [tuple(r) for r in embeddings.near_vectors(alone).collect()] == [(1, 0, 1, True)]


def family(copies, edits):
    r = random.Random(6)
    base = [f"b{i}" for i in range(400)]
    rows = []
    for i in range(copies):
        own = list(base)
        for at in r.sample(range(400), edits):
            own[at] = f"x{i}y{at}"
        rows.append((i, " ".join(own), "s", "x"))
    return rows


def rows_written(monkeypatch):
    sizes, settle = [], jaccard.Scratch.settle

    def count(self, df, *label):
        out = settle(self, df, *label)
        sizes.append(out.count())
        return out

    monkeypatch.setattr(jaccard.Scratch, "settle", count)
    return sizes


def test_family_of_long_texts_is_written_by_keys_and_not_by_pairs_of_keys(spark, monkeypatch):
    rows = family(24, 9)
    sizes = rows_written(monkeypatch)
    got = {x.doc_id: x.component_id for x in jaccard.jaccard_components(spark.createDataFrame(rows, DOCS), percent=80).collect()}
    assert got == brute_components([x[:2] for x in rows], 3, 80) and len(set(got.values())) > 1
    assert max(sizes) < 24 * 100


@pytest.mark.parametrize("cost", [0, 1 << 30])
def test_longest_lists_by_subsets_or_as_they_stand(spark, monkeypatch, cost):
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    monkeypatch.setattr(jaccard, "SUBSET_COST", cost)
    rows = family(24, 7)
    asked, subsets = [], jaccard.heavy_subsets
    monkeypatch.setattr(jaccard, "heavy_subsets", lambda rows: asked.append(1) or subsets(rows))
    monkeypatch.setattr(jaccard, "LEADERS", 1)
    got = {x.doc_id: x.component_id for x in jaccard.jaccard_components(spark.createDataFrame(rows, DOCS), percent=80).collect()}
    assert got == brute_components([x[:2] for x in rows], 3, 80)
    assert bool(asked) == (cost == 0)


@pytest.mark.parametrize("kind", ["float", "double"])
def test_vectors_that_move_at_once_stay_in_proportion(spark, monkeypatch, kind):
    """One dense cell: every pair of blocks is compared, but not moved at the same time."""
    monkeypatch.setattr(embeddings, "TILE", 16)
    monkeypatch.setattr(embeddings, "TILES", 2, raising=False)
    monkeypatch.setattr(embeddings, "MOVED", 0, raising=False)
    r = np.random.default_rng(9)
    centre = r.normal(size=8)
    rows = [(i, [float(np.float32(x)) for x in centre + r.normal(size=8) * (0.6 if i % 3 else 0.02)]) for i in range(600)]
    df = spark.createDataFrame(rows, f"vec_id bigint, embedding array<{kind}>")
    grouped = type(df.groupBy("vec_id"))
    moved, apply = [], grouped.applyInPandas
    monkeypatch.setattr(grouped, "applyInPandas", lambda self, *a: (moved.append(self._df.count()), apply(self, *a))[1])
    got = {x.vec_id: (x.n_links, x.component_id, x.kept) for x in embeddings.near_vectors(df).collect()}
    assert got == brute_vectors(rows, 0.95) and len({x[1] for x in got.values()}) > 1 and max(x[0] for x in got.values()) > 200
    assert len(moved) > 3 and max(moved) <= 3 * len(rows)
