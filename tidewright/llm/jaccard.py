"""Jaccard join of documents on word n-grams, by size-aware heavy and light sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import lean, slices
from tidewright.llm.graph import components
from tidewright.llm.wordhash import mixed, shingle_sets
from tidewright.session import Scratch

WORDS = 3
#: Similarity as a whole percentage.
PERCENT = 90
#: Members of the subsets that small sets are indexed by.
SUBSET = 2
#: What a posting that is scanned costs, in subsets that are enumerated.
SCAN_COST = 6
#: Counters of the frequency sketch that orders shingles; of fixed size for any corpus.
SKETCH, STRIP, LANES = 1 << 22, 1 << 16, 16
#: An inverted list of more members that are not all in one group is heavy.
HEAVY = 16
#: Members of a list that are compared with each other at once; a list of more is copied as often as it has blocks.
BLOCK = 4096
#: What enumerating a subset of two heavy shingles costs, in pairs of a scanned list.
SUBSET_COST = 16
#: Keys of a document that go with its rows of long lists, so that a pair of several lists comes out of one.
AHEAD = 32
#: Leaders that a document is compared with before the groups are known.
LEADERS = 2
#: Counters by which pairs are sifted before their sets are read, and sums of them that are looked at first in long lists.
SIEVE, COARSE = 256, 16


def sketch(docs: DataFrame, words: int) -> np.ndarray:
    """Frequency class of each of SKETCH counters, over the shingles of all texts.

    Every task adds up its own counters and sends them in compressed strips; strips are added one after the other, first
    in LANES lanes and then all, so a task holds one however many there are.
    """

    def strip_row(strip: int, counts: np.ndarray, lane: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([strip], pa.int32()), pa.array([lane], pa.int32()),
             pa.array([pa.compress(counts.tobytes(), codec="zstd", asbytes=True)], pa.binary())], ["strip", "lane", "counts"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SKETCH, np.uint32)
        for batch in batches:
            for part in slices(batch, "text", 1024, 1 << 20):
                held = [own for own in shingle_sets(part.column("text"), words) if len(own)]
                if held:
                    at, n = np.unique(np.concatenate(held) & np.uint64(SKETCH - 1), return_counts=True)
                    total[at.astype(np.int64)] += n.astype(np.uint32)
        for i in range(SKETCH // STRIP):
            yield strip_row(i, total[i * STRIP:(i + 1) * STRIP].astype(np.int64), TaskContext.get().partitionId() % LANES)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, total = None, None
        for batch in batches:
            for strip, raw in zip(batch.column("strip").to_pylist(), batch.column("counts").to_pylist()):
                own = np.frombuffer(pa.decompress(raw, decompressed_size=8 * STRIP, codec="zstd", asbytes=True), np.int64)
                if strip != here:
                    if here is not None:
                        yield strip_row(here, total, 0)
                    here, total = strip, own.copy()
                else:
                    total += own
        if here is not None:
            yield strip_row(here, total, 0)

    kind = "strip int, lane int, counts binary"
    sums = docs.select("text").mapInArrow(lean(count), kind).repartition("strip", "lane").sortWithinPartitions("strip").mapInArrow(lean(add), kind)
    classes = np.zeros(SKETCH, np.uint8)
    for row in sums.repartition("strip").sortWithinPartitions("strip").mapInArrow(lean(add), kind).collect():  # SKETCH counters, compressed
        counts = np.frombuffer(pa.decompress(row["counts"], decompressed_size=8 * STRIP, codec="zstd", asbytes=True), np.int64)
        classes[row["strip"] * STRIP:(row["strip"] + 1) * STRIP] = np.minimum(2 * np.log2(1 + counts), 63).astype(np.uint8)
    return classes


def ordered(own: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """The shingles in one order for all documents: seldom ones first, by class of the counter, then by hash."""
    rank = classes[(own & np.uint64(SKETCH - 1)).astype(np.int64)].astype(np.uint64)
    return np.sort((rank << np.uint64(58)) | (own >> np.uint64(6)))


def reach(n: np.ndarray | int, percent: int):
    """How many shingles of a set of n can be missing from a similar one, and one more."""
    return n - -(-n * percent // 100) + 1


def boundary(sizes: dict[int, int], percent: int) -> int:
    """Sets below this size are small. Small ones cost a row for each subset of their prefix; large ones, and those
    that can be similar to a large one, cost a scanned posting for each shingle of it. The least sum decides."""
    if not sizes:
        return 0
    n = np.array(sorted(sizes), np.int64)
    c = np.array([sizes[int(x)] for x in n], np.float64)
    p = reach(n, percent).astype(np.float64)
    subsets = np.concatenate([[0], np.cumsum(c * (p + SUBSET - 1) * p / 2)])
    postings = np.concatenate([[0], np.cumsum(c * p * SCAN_COST)])
    limits = np.append(n, n[-1] + 1)
    large = np.searchsorted(n, -(-limits * percent // 100))
    return int(limits[np.argmin(subsets[np.arange(len(limits))] + postings[-1] - postings[large])])


def shingle_table(docs: DataFrame, words: int, percent: int, classes: np.ndarray) -> DataFrame:
    """(id, n, sig, sig2, prefix, sieve): size, 128-bit digest and least common shingles of every document's set, and
    how many of its shingles fall in each of SIEVE counters."""
    sent = docs.sparkSession.sparkContext.broadcast(classes)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "text", 1024)):
            n, sig, sig2, prefix, sieve = [], [], [], [], []
            for own in shingle_sets(batch.column("text"), words):
                n.append(len(own))
                sig.append(int(mixed(own).sum(dtype=np.uint64)))
                sig2.append(int(mixed(own ^ np.uint64(0xA0761D6478BD642F)).sum(dtype=np.uint64)))
                keep = reach(len(own), percent) + SUBSET - 1 if len(own) else 0
                prefix.append(ordered(own, sent.value)[:keep].tobytes())
                sieve.append(narrow(np.bincount((own >> np.uint64(56)).astype(np.int64), minlength=SIEVE)))
            yield pa.RecordBatch.from_arrays([
                batch.column("id"), pa.array(n, pa.int64()), pa.array(np.array(sig, np.uint64).view(np.int64)),
                pa.array(np.array(sig2, np.uint64).view(np.int64)), pa.array(prefix, pa.binary()), pa.array(sieve, pa.binary())],
                ["id", "n", "sig", "sig2", "prefix", "sieve"])

    return docs.mapInArrow(lean(describe), "id bigint, n bigint, sig bigint, sig2 bigint, prefix binary, sieve binary")


def narrow(counters: np.ndarray) -> bytes:
    """Counters in half a byte each where the largest fits, else in one byte, else in four."""
    top = counters.max()
    if top < 16:
        return (counters[::2] | counters[1::2] << 4).astype(np.uint8).tobytes()
    return counters.astype(np.uint8 if top < 256 else np.uint32).tobytes()


def counters_of(column: pa.Array) -> np.ndarray:
    """The counters of many documents, in one byte each if all of them fit."""
    raw = column.to_pylist()
    sizes = np.array([len(v) for v in raw])
    out = np.zeros((len(raw), SIEVE), np.uint32 if sizes.max() > SIEVE else np.uint8)
    for size, kind in ((SIEVE // 2, np.uint8), (SIEVE, np.uint8), (4 * SIEVE, np.uint32)):
        at = np.flatnonzero(sizes == size)
        if len(at):
            own = np.frombuffer(b"".join([raw[i] for i in at]), kind).reshape(len(at), -1)
            if size < SIEVE:
                out[at, ::2], out[at, 1::2] = own & 15, own >> 4
            else:
                out[at] = own
    return out


def subsets(own: np.ndarray) -> np.ndarray:
    """Even keys of all subsets of SUBSET elements."""
    a, b = np.triu_indices(len(own), 1)
    return mixed(mixed(own[a]) + own[b]) & ~np.uint64(1)


def heavy_subsets(rows: DataFrame) -> DataFrame:
    """(key, id, low, high): the subsets of the heavy shingles low < high of each document, from rows (id, keys) in key order."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, held in zip(batch.column("id").to_pylist(), batch.column("keys")):
                own = held.values.to_numpy(zero_copy_only=False)
                for first in range(len(own) - 1):
                    high = own[first + 1:]
                    key = mixed(mixed(own[first:first + 1].view(np.uint64)) + mixed(high.view(np.uint64))) & ~np.uint64(1)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key.view(np.int64)), pa.array(np.full(len(high), i)), pa.array(np.full(len(high), own[first])),
                         pa.array(high)], ["key", "id", "low", "high"])

    return rows.mapInArrow(lean(spread), "key bigint, id bigint, low bigint, high bigint")


def postings(reps: DataFrame, percent: int, limit: int) -> DataFrame:
    """(key, id): for small sets one row per subset of SUBSET prefix shingles (even keys), for large ones (and their
    possible partners) one per prefix shingle (odd keys). Both prefixes are those in which similar sets share SUBSET."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, ids, room = [], [], 0
            for i, n, raw in zip(batch.column("id").to_pylist(), batch.column("n").to_pylist(), batch.column("prefix").to_pylist()):
                own = np.frombuffer(raw, np.uint64)
                if n < limit and len(own) >= SUBSET:
                    keys.append(subsets(own))
                    ids.append(np.full(len(keys[-1]), i))
                    room += len(keys[-1])
                if n * 100 >= limit * percent:
                    keys.append(mixed(own ^ np.uint64(0x2545F4914F6CDD1D)) | np.uint64(1))
                    ids.append(np.full(len(own), i))
                    room += len(own)
                if room > 500_000:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(ids))], ["key", "id"])
                    keys, ids, room = [], [], 0
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(ids))], ["key", "id"])

    return reps.mapInArrow(lean(spread), "key bigint, id bigint")


def similar(pairs: DataFrame, docs: DataFrame, repeated: DataFrame | None, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar, counted exactly from the texts: a text is less than half as large as its set.

    A key of several texts, one of `repeated`, is similar if one of them is; its equal texts are one."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "x", 256):
                good = []
                for u, v in zip(shingle_sets(batch.column("x"), words), shingle_sets(batch.column("y"), words)):
                    low, high = sorted((len(u), len(v)))
                    common = len(np.intersect1d(u, v, assume_unique=True)) if low * 100 >= high * percent else 0
                    good.append(low > 0 and 100 * common >= percent * (low + high - common))
                yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(good, pa.bool_()))

    wanted = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
    texts = docs.join(wanted, "id", "left_semi")
    if repeated is not None:
        texts = texts.join(repeated, "id", "left_anti").union(texts.join(repeated, "id", "left_semi").dropDuplicates(["id", "text"]))
    left = texts.select(F.col("id").alias("a"), F.col("text").alias("x"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(lean(verify), "a bigint, b bigint")


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS,
                       percent: int = PERCENT) -> DataFrame:
    """(key, n_shingles, component_id) per row of `docs`.

    Two documents link when their sets of distinct word n-grams have a Jaccard similarity of `percent` or more.
    component_id is the smallest key reachable by links.

    Equal sets are first brought to one. Shingles stand in one order, seldom ones first, and similar sets share
    SUBSET shingles among the first of both. Small sets enumerate these subsets, large sets scan inverted
    lists of single shingles, and the boundary between them is the one of least cost for the sizes at hand. Where lists
    are very long, large sets may enumerate subsets of such shingles too (`cross_pairs`).
    Each key has one member drawn as its leader, and each document is compared with the LEADERS of these that its size and
    counters (`sifted`) let be most similar; what passes an exact count forms groups.
    Only keys that still join different groups compare the rest, so a group of near copies is a star and never
    all its pairs, and no pair of different groups is left out.

    Null and empty texts have no shingles and link with nothing; a null key stays a row of its own (component null);
    rows that repeat a key count as one document for links; an empty table gives an empty result; other columns
    are not looked at.
    """
    if not 50 < percent <= 100:
        raise ValueError("percent must be over 50, so that similar sets that differ share two shingles")
    scratch = Scratch(docs.sparkSession)
    read = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    table = scratch.settle(shingle_table(read, words, percent, sketch(read, words)))
    sized = scratch.settle(table.drop("prefix", "sieve"))
    filled = table.filter("n > 0 AND id IS NOT NULL")
    repeated = scratch.settle(sized.filter("id IS NOT NULL").groupBy("id").count().filter("count > 1").select("id"))
    repeated = None if repeated.isEmpty() else repeated
    group = ["n", "sig", "sig2"]
    same = scratch.settle(filled.groupBy(*group).agg(F.min("id").alias("rep")))
    reps = scratch.settle(filled.join(same, [*group], "inner").filter("id = rep").dropDuplicates(["id", *group]).select("id", "n", "prefix", "sieve"))
    scratch.drop(table)
    sizes = {r["n"]: r["count"] for r in reps.groupBy("n").count().collect()}  # one row per size of a set
    index = scratch.settle(postings(reps, percent, boundary(sizes, percent)))
    reps, old = scratch.settle(reps.drop("prefix")), reps
    scratch.drop(old)
    # Most keys stand alone: only numbers are carried to tell, leaders are drawn among the others.
    lists = index.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1").select("key")
    shared = scratch.settle(index.join(lists, "key"))
    scratch.drop(index)
    drawn = shared.groupBy("key").agg(F.min_by("id", F.xxhash64("key", "id")).alias("lead"))
    leads = shared.join(drawn, "key").filter("id <> lead").select(F.col("lead").alias("a"), F.col("id").alias("b")).distinct()
    # A document has no more leaders than keys.
    nearest = F.slice(F.sort_array(F.collect_list(F.struct("bound", "a")), False), 1, LEADERS)
    star = scratch.settle(sifted(leads, reps, percent).groupBy("b").agg(nearest.alias("x")).select(
        F.explode("x.a").alias("a"), "b"))
    links = scratch.settle(similar(star, read, repeated, words, percent))
    scratch.drop(star)
    named = scratch.settle(components(links, scratch))
    rest = cross_pairs(shared, named, reps, percent, scratch)
    scratch.drop(shared)
    if not rest.isEmpty():
        more = scratch.settle(similar(rest, read, repeated, words, percent))
        scratch.drop(rest)
        named = scratch.settle(components(links.union(more), scratch))
    classes = scratch.settle(same.join(named.withColumnRenamed("node", "rep"), "rep", "left").select(
        *group, F.coalesce("component", "rep").alias("component_id")))
    # What the result reads is small and stays; the rest goes with the other tables.
    out = sized.join(classes, group, "left").select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id"))
    scratch.keep(sized, classes)
    scratch.drop(*[df for df, _ in list(scratch.tables.values())])
    return out


def sifted(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """(a, b, bound) of the pairs that can be similar by the sizes of their sets and by their counters: two sets share in
    each counter at most the smaller number, so no similar pair is lost. bound is the similarity that this allows."""

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, len(batch), 4096):
                part = batch.slice(low, 4096)
                x, y = (counters_of(part.column(c)) for c in ("x", "y"))
                common, both = np.minimum(x, y).sum(1, dtype=np.int64), x.sum(1, dtype=np.int64) + y.sum(1, dtype=np.int64)
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b"), pa.array(common / (both - common))],
                                                 ["a", "b", "bound"]).filter(pa.array(100 * common >= percent * (both - common)))

    left, right = (reps.select(F.col("id").alias(i), F.col("n").alias(f"n{i}"), F.col("sieve").alias(x)) for i, x in (("a", "x"), ("b", "y")))
    # Sizes first, so that fewer pairs carry counters.
    sized = (pairs.join(left.drop("x"), "a").join(right.drop("y"), "b")
             .filter(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent).select("a", "b"))
    return sized.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(lean(sift), "a bigint, b bigint, bound double")


def cross_pairs(shared: DataFrame, named: DataFrame, reps: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """Pairs (a, b) of one key that are in different groups, once each.

    Pairs from lists of at most HEAVY members grow in proportion to the documents and are joined. Longer lists, as those of a
    family of edited copies, are compared in blocks (`long_lists`): a row for each key of a document, however many keys it has.
    Similar sets share SUBSET prefix shingles, so either one of these has a list of at most BLOCK members, which finds them, or all
    have longer ones, and a subset of these shingles finds them too. Longer lists of single shingles are compared as they
    stand or by such subsets, whichever costs less (`by_subsets`). All pairs are sifted by sizes and counters.
    """
    group = reps.select("id", "n").join(named.withColumnRenamed("node", "id"), "id", "left").select(
        "id", "n", F.coalesce("component", "id").alias("g"))

    def torn(rows: DataFrame) -> DataFrame:
        """Rows (key, id, ...) of keys that stand in two groups or more, with n, g and the number c of the key's rows."""
        known = scratch.settle(rows.join(group, "id"))
        keys = known.groupBy("key").agg(F.min("g").alias("low_g"), F.max("g").alias("high_g"), F.count("*").alias("c")).filter("low_g < high_g")
        out = scratch.settle(known.join(keys.select("key", "c"), "key"))
        scratch.drop(known)
        return out

    def keys_of(rows: DataFrame) -> DataFrame:
        return rows.groupBy("id").agg(F.sort_array(F.collect_list("key")).alias("keys"))

    def carried(rows: DataFrame, keys: DataFrame, ahead) -> DataFrame:
        """Rows with the first keys of their documents that `ahead` accepts: a pair that has one of them in common comes out elsewhere."""
        return rows.join(keys.select("id", F.slice("keys", 1, AHEAD).alias("keys")), "id").select(
            *OF_LIST, F.filter("keys", ahead).alias("ahead"))

    first = torn(shared.select("key", "id"))
    heavy = F.col("c") > HEAVY
    alone = F.col("key").bitwiseAND(1) == 1
    single = first.filter(heavy & alone)
    short, long = first.filter(~heavy).select(*OF_LIST), first.filter(heavy & ~alone).select(*OF_LIST, F.array().cast("array<bigint>").alias("ahead"))
    longest = single.filter(F.col("c") > BLOCK)
    if by_subsets(longest):
        single = single.filter(F.col("c") <= BLOCK)
        held = scratch.settle(keys_of(longest).filter(F.size("keys") >= SUBSET))
        index = scratch.settle(heavy_subsets(held))
        lists = index.groupBy("key").agg(F.count("*").alias("m")).filter("m > 1").select("key")
        second = torn(index.join(lists, "key"))
        scratch.drop(index)
        short = short.union(second.filter(~heavy).select(*OF_LIST))
        # The first subset that two documents share is the one with none of their common keys before its second one, but for its first.
        long = long.union(carried(second.filter(heavy), held, lambda k: (k < F.col("high")) & (k != F.col("low"))))
    long = scratch.settle(long.union(carried(single, keys_of(single), lambda k: k < F.col("key"))))
    a, b = short.alias("a"), short.alias("b")
    pairs = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.id") < F.col("b.id")) & (F.col("a.g") != F.col("b.g"))
                   & (F.least("a.n", "b.n") * 100 >= F.greatest("a.n", "b.n") * percent)).select(
        F.col("a.id").alias("a"), F.col("b.id").alias("b")).distinct()
    # Work grows with the square of a list: as many tasks as pairs of full blocks, within reason.
    work = long.agg(F.sum(F.col("c") / 2)).first()[0] or 0
    parts = int(reps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    near = scratch.settle(sifted(pairs, reps, percent).select("a", "b"))
    far = scratch.settle(long_lists(long, reps, percent, max(parts, min(int(work / BLOCK ** 2), 16 * parts))))
    out = scratch.settle(near.union(far).distinct())
    scratch.drop(near, far)
    return out


OF_LIST = ["key", "id", "n", "g", "c"]


def by_subsets(longest: DataFrame) -> bool:
    """Whether the subsets of the heavy shingles of each document cost less than the pairs of their lists, rows (id, c). A document
    of k of them has k * (k - 1) / 2 subsets, so those of long documents would fill the disk."""
    pairs = longest.agg(F.sum(F.col("c") / 2)).first()[0] or 0
    k = F.col("count")
    subsets = longest.groupBy("id").count().agg(F.sum(k * (k - 1) / 2)).first()[0] or 0
    return pairs > SUBSET_COST * subsets


def long_lists(rows: DataFrame, reps: DataFrame, percent: int, tasks: int) -> DataFrame:
    """(a, b) of the pairs of different groups in long lists, rows (key, id, n, g, c, ahead), that sizes and counters let be similar.
    Pairs that have a key of `ahead` in common are left to that key's list.

    The members of a list are dealt into blocks, each pair of blocks is compared in one place, and only the pairs that
    are left come out. A list of any length is spread over tasks in pieces of at most two blocks.
    """
    blocks = F.ceil(F.col("c") / BLOCK)
    own = F.pmod(F.xxhash64("id"), blocks)
    dealt = rows.withColumn("own", own).withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1))).select(
        "key", "id", "n", "g", "ahead", F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"), (F.col("own") > F.col("with")).alias("second"))
    known = dealt.join(reps.select("id", F.col("sieve").alias("x")), "id").select("key", "i", "j", "second", "n", "id", "g", "ahead", "x")

    def compare(part: pa.Table, out: list) -> None:
        order = np.argsort(part.column("n").to_numpy(), kind="stable")
        part = part.take(pa.array(order)).combine_chunks()
        n, ids, g = (part.column(c).to_numpy() for c in ("n", "id", "g"))
        x = counters_of(part.column("x"))
        coarse = x.reshape(len(x), COARSE, -1).sum(2, dtype=np.float32)
        second = part.column("second").to_numpy().astype(bool)
        mixed_blocks = part.column("i")[0].as_py() != part.column("j")[0].as_py()
        ahead = [frozenset(k) for k in part.column("ahead").to_pylist()]
        ends = np.searchsorted(n, n * 100 // percent, "right")
        for k in range(len(n) - 1):
            near = slice(k + 1, ends[k])
            able = g[near] != g[k]
            if mixed_blocks:
                able &= second[near] != second[k]
            # A bound by a few sums of counters first: what it leaves is looked at by all of them.
            able &= 100 * np.minimum(coarse[near], coarse[k]).sum(1) >= percent / (100 + percent) * 100 * (n[k] + n[near]) - 1e-3 * n[k]
            other = np.flatnonzero(able) + k + 1
            if len(other):
                common = np.minimum(x[other], x[k]).sum(1, dtype=np.int64)
                good = other[100 * common >= percent * (n[k] + n[other] - common)]
                if ahead[k] and len(good):
                    good = good[[ahead[k].isdisjoint(ahead[o]) for o in good.tolist()]]
                if len(good):
                    out.append((np.minimum(ids[good], ids[k]), np.maximum(ids[good], ids[k])))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush(table: pa.Table) -> Iterator[pa.RecordBatch]:
            place = [table.column(c).to_numpy() for c in ("key", "i", "j")]
            cuts = np.flatnonzero(np.any([p[1:] != p[:-1] for p in place], axis=0)) + 1
            out: list = []
            for low, high in zip([0, *cuts], [*cuts, len(table)]):
                compare(table.slice(low, high - low), out)
            if out:
                pairs = np.unique(np.stack([np.concatenate([o[0] for o in out]), np.concatenate([o[1] for o in out])]), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"])

        for batch in batches:
            held.append(batch)
            if sum(len(h) for h in held) < 2 * BLOCK:
                continue
            table = pa.Table.from_batches(held)
            last = [table.column(c).to_numpy() for c in ("key", "i", "j")]
            cut = int(np.flatnonzero(np.any([p != p[-1] for p in last], axis=0))[-1]) + 1 if any((p != p[-1]).any() for p in last) else 0
            if cut:
                yield from flush(table.slice(0, cut))
            held = table.slice(cut).combine_chunks().to_batches()
        if held and sum(len(h) for h in held):
            yield from flush(pa.Table.from_batches(held))

    return (known.repartition(tasks, "key", "i", "j").sortWithinPartitions("key", "i", "j")
            .mapInArrow(lean(walk), "a bigint, b bigint"))
