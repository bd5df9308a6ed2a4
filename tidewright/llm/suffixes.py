"""Removal of repeated passages by an index of seed fingerprints in levels of growing size, in place of whole suffix arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.llm.common import free_name, lean
from tidewright.session import Scratch

#: A repeat has this many bytes at least.
LENGTH = 200
#: Suffixes start where a seed of SEED bytes has the least hash among those of some string of LENGTH bytes.
SEED = 80
#: Bytes looked at together; a longer text goes through in pieces that overlap.
CHUNK = 1 << 17
BATCHES = 4
#: Different surroundings of one seed compared in a task (some 50 MB); more of them are compared window by window.
CROWD = 16_384
#: Surroundings that a task gathers, of as many seeds as that takes, before it compares them.
GATHER = 4096

_MASK = np.uint64((1 << 20) - 1)
_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: list[np.ndarray] = []


def powers() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(powers of the base, of its inverse, number for each byte), modulo 2**64."""
    if not _POWERS:
        n = CHUNK + 2 * LENGTH + 2
        inverse = pow(_BASE, -1, 1 << 64)
        for b in (_BASE, inverse):
            out = np.ones(n, np.uint64)
            out[1:] = b
            _POWERS.append(np.multiply.accumulate(out))
        x = np.arange(1, 257, dtype=np.uint64) * np.uint64(0xBF58476D1CE4E5B9)
        _POWERS.append(mixed(x) | np.uint64(1))
    return tuple(_POWERS)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class Hashes:
    """Fingerprints of all stretches of a byte string, wherever in it they stand."""

    def __init__(self, data: bytes):
        power, self.inverse, number = powers()
        raw = np.frombuffer(data, np.uint8)
        self.sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(number[raw] * power[:len(raw)], out=self.sums[1:])

    def all(self, length: int) -> np.ndarray:
        n = len(self.sums) - length
        return mixed((self.sums[length:] - self.sums[:n]) * self.inverse[:n])

    def at(self, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return mixed((self.sums[start + length] - self.sums[start]) * self.inverse[start])


def least_places(x: np.ndarray, window: int) -> np.ndarray:
    """For each start the leftmost place of the least of `window` values."""
    cur = (x & ~_MASK) | np.arange(len(x), dtype=np.uint64)
    size = 1
    while 2 * size <= window:
        cur = np.minimum(cur[:-size], cur[size:])
        size *= 2
    rest = window - size
    return ((np.minimum(cur[:len(cur) - rest], cur[rest:]) if rest else cur) & _MASK).astype(np.int64)


def pieces(texts: list[bytes], length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Chunks of (text number, place in the text, bytes) in which every string of `length` bytes stands once."""
    held, size = [], 0
    for i, text in enumerate(texts):
        for low in range(0, max(1, len(text) - length + 1), CHUNK):
            part = text[low:low + CHUNK + length - 1]
            if len(part) < length:
                continue
            if held and size + len(part) > CHUNK + length - 1:
                yield held
                held, size = [], 0
            held.append((i, low, part))
            size += len(part)
    if held:
        yield held


def sparse_suffixes(texts: list[bytes], length: int, seed: int) -> Iterator[dict[str, np.ndarray]]:
    """The suffixes that the texts put in an array.

    Every string of `length` bytes points to the suffix that starts at its seed of least hash, the same one in
    all its occurrences. The strings that point to one suffix start one after the other, `low` to `high` bytes before it.
    `key` is the fingerprint of the seed, `ring` that of all bytes of these strings.
    """
    for chunk in pieces(texts, length):
        data = b"".join(p for _, _, p in chunk)
        hashes = Hashes(data)
        seeds = hashes.all(seed)
        least = least_places(seeds, length - seed + 1)
        sizes = np.array([len(p) for _, _, p in chunk])
        begins = np.cumsum(sizes) - sizes
        count = sizes - length + 1
        piece = np.repeat(np.arange(len(chunk)), count)
        start = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + begins[piece]
        at = least[start]
        first = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (piece[1:] != piece[:-1])]))
        last = np.append(first[1:], len(at)) - 1
        p, own = at[first], piece[first]
        high, low = p - start[first], p - start[last]
        ring = hashes.at(start[first], high - low + length)
        shift = np.array([o for _, o, _ in chunk])[own] - begins[own]
        yield {"row": np.array([i for i, _, _ in chunk])[own], "at": p + shift, "low": low, "high": high,
               "key": seeds[p].view(np.int64), "ring": mixed(ring ^ (low * 4096 + high).astype(np.uint64)).view(np.int64)}


def suffix_rows(docs: DataFrame, length: int, seed: int) -> DataFrame:
    """(uid, at, low, high, key, ring) of the rows (uid, bytes)."""
    names = ["at", "low", "high", "key", "ring"]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uid, texts = batch.column("uid").to_numpy(), batch.column("bytes").to_pylist()
            for x in sparse_suffixes(texts, length, seed):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(uid[x["row"]]), pa.array(x["at"]), pa.array(x["low"].astype(np.int16)),
                     pa.array(x["high"].astype(np.int16)), pa.array(x["key"]), pa.array(x["ring"])], ["uid", *names])

    return docs.mapInArrow(lean(find), "uid bigint, at bigint, low smallint, high smallint, key bigint, ring bigint")


class SuffixLevels:
    """Fingerprints of the seeds that suffixes start with, in levels whose sizes grow by doubling.

    `add` counts the seeds of a new batch, joins them with every level there is for seeds that both
    hold, and puts them in as a level of rank 0; two levels of one rank are merged into one of the next. So n batches
    leave log2(n) levels, and a seed is merged as often. Levels are in order of fingerprints, not of suffixes.

    A level has one row per seed: how many suffixes start with it, however many there are. `found` holds the
    seeds of two suffixes or more.
    """

    def __init__(self, spark: SparkSession):
        self.scratch = Scratch(spark)
        self.levels: list[tuple[int, DataFrame]] = []
        self.found: list[DataFrame] = []

    def add(self, suffixes: DataFrame) -> None:
        array = self.scratch.settle(suffixes.groupBy("key").agg(F.count("*").alias("n")).sortWithinPartitions("key"))
        hits = array.filter("n > 1").select("key")
        for _, level in self.levels:
            hits = hits.union(array.join(level.filter("n = 1").select("key"), "key").select("key"))
        self.found.append(self.scratch.settle(hits.distinct()))
        rank = 0
        while self.levels and self.levels[-1][0] == rank:
            _, other = self.levels.pop()
            joined = self.scratch.settle(array.union(other).groupBy("key").agg(F.sum("n").alias("n")).sortWithinPartitions("key"))
            self.scratch.drop(array, other)
            array, rank = joined, rank + 1
        self.levels.append((rank, array))

    def repeated(self) -> DataFrame:
        """(key) of all seeds with two suffixes or more."""
        out = self.found[0]
        for more in self.found[1:]:
            out = out.union(more)
        return out.distinct()

    def close(self) -> None:
        self.scratch.drop(*[df for df, _ in list(self.scratch.tables.values())])


def windows_of(context: list[bytes], low: np.ndarray, high: np.ndarray, key: np.ndarray, length: int
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bytes before the suffix, fingerprint with the seed) of every string of `length` bytes in the contexts."""
    rows, before, prints = [], [], []
    at = 0
    while at < len(context):
        size, end = 0, at
        while end < len(context) and (end == at or size + len(context[end]) <= CHUNK):
            size += len(context[end])
            end += 1
        hashes = Hashes(b"".join(context[at:end]))
        begin = np.cumsum([0] + [len(c) for c in context[at:end - 1]])
        count = (high[at:end] - low[at:end] + 1).astype(np.int64)
        row = np.repeat(np.arange(end - at), count)
        step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        back = high[at:end][row] - step
        rows.append(row + at)
        before.append(back)
        prints.append(mixed(hashes.at(begin[row] + step, length) ^ mixed(key[at:end][row].view(np.uint64) + back.astype(np.uint64))))
        at = end
    return np.concatenate(rows), np.concatenate(before), np.concatenate(prints)


def runs(row: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, most, least bytes before the suffix) of strings that start one after the other."""
    first = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (before[1:] != before[:-1] - 1)]))
    last = np.append(first[1:], len(row)) - 1
    return row[first], before[first], before[last]


def compare_contexts(rows: DataFrame, length: int) -> DataFrame:
    """(uid, start, stop) of the repeated stretches of the rows (key, uid, at, low, high, open, bytes) of few surroundings
    a seed. Rows of a key stand together, and tasks compare them a few thousand at a time."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def settle_rows(table: pa.Table) -> pa.RecordBatch:
            col = {c: table.column(c).to_numpy() for c in ("key", "uid", "at", "low", "high", "open")}
            row, before, prints = windows_of(table.column("bytes").to_pylist(), col["low"], col["high"], col["key"], length)
            _, back, n = np.unique(prints, return_inverse=True, return_counts=True)
            take = (n[back] > 1) & (col["open"][row] == 1)
            if not take.any():
                empty = pa.array([], pa.int64())
                return pa.RecordBatch.from_arrays([empty, empty, empty], ["uid", "start", "stop"])
            r, most, least = runs(row[take], before[take])
            at = col["at"][r]
            return pa.RecordBatch.from_arrays([pa.array(col["uid"][r]), pa.array(at - most), pa.array(at - least + length)],
                                              ["uid", "start", "stop"])

        for batch in batches:
            held.append(batch)
            if sum(len(b) for b in held) < GATHER:
                continue
            table = pa.Table.from_batches(held)
            keys = table.column("key").to_numpy()
            cut = int(np.searchsorted(keys, keys[-1]))  # rows of the last key may go on
            if cut:
                yield settle_rows(table.slice(0, cut))
            held = table.slice(cut).combine_chunks().to_batches()
        if held and sum(len(b) for b in held):
            yield settle_rows(pa.Table.from_batches(held))

    return (rows.repartition("key").sortWithinPartitions("key")
            .mapInArrow(lean(compare), "uid bigint, start bigint, stop bigint"))


def compare_windows(rows: DataFrame, length: int) -> DataFrame:
    """The same for seeds of very many surroundings: counts of single windows, with partial sums in the tasks."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, len(batch), 2000):
                part = batch.slice(low, 2000)
                col = {c: part.column(c).to_numpy() for c in ("key", "uid", "at", "low", "high", "open")}
                row, before, prints = windows_of(part.column("bytes").to_pylist(), col["low"], col["high"], col["key"], length)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(prints.view(np.int64)), pa.array(col["uid"][row]), pa.array(col["at"][row] - before),
                     pa.array(col["open"][row])], ["print", "uid", "start", "open"])

    single = rows.mapInArrow(lean(spread), "print bigint, uid bigint, start bigint, open int")
    twice = single.groupBy("print").agg(F.count("*").alias("n")).filter("n > 1").select("print")
    return single.filter("open = 1").join(twice, "print").select("uid", "start", (F.col("start") + length).alias("stop"))


def stretches(docs: DataFrame, scratch: Scratch, batches: int, length: int, seed: int, crowd: int) -> DataFrame:
    """(uid, spans): for each of the rows (uid, bytes) with repeats, the stretches that repeated strings cover."""
    index = SuffixLevels(docs.sparkSession)
    arrays = []
    for i in range(batches):
        own = docs.filter(F.pmod(F.col("uid"), F.lit(batches)) == i)
        arrays.append(scratch.settle(suffix_rows(own, length, seed)))
        index.add(arrays[-1])
    suffixes = arrays[0]
    for more in arrays[1:]:
        suffixes = suffixes.union(more)
    # Written first: a join with a plain table is one that Spark splits at a hot seed.
    repeated = scratch.settle(index.repeated())
    hits = scratch.settle(suffixes.join(repeated, "key"))
    scratch.drop(repeated)
    index.close()
    scratch.drop(*arrays)
    mark = F.xxhash64("uid", "at")
    rings = hits.groupBy("key", "ring").agg(F.count("*").alias("same"), F.min(mark).alias("first"))
    around = rings.groupBy("key").agg(F.count("*").alias("rings"), F.min("same").alias("least"))
    rings = scratch.settle(rings.join(around, "key"))
    closed = hits.join(rings.filter("same > 1").select("key", "ring"), ["key", "ring"]).select(
        "uid", (F.col("at") - F.col("high")).alias("start"), (F.col("at") - F.col("low") + length).alias("stop"))
    asked = (hits.join(rings.filter("rings > 1 AND least = 1"), ["key", "ring"]).filter(mark == F.col("first"))
             .select("uid", "key", "at", "low", "high", (F.col("same") == 1).cast("int").alias("open"), "rings"))
    per_doc = asked.groupBy("uid").agg(F.collect_list(F.struct("key", "at", "low", "high", "open", "rings")).alias("asks"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for low in range(0, len(batch), 200):
                out = [(a["key"], uid, a["at"], a["low"], a["high"], a["open"], a["rings"],
                        raw[a["at"] - a["high"]:a["at"] - a["low"] + length])
                       for uid, raw, asks in batch.iloc[low:low + 200].itertuples(index=False) for a in asks]
                yield pd.DataFrame(out, columns=["key", "uid", "at", "low", "high", "open", "rings", "bytes"])

    contexts = scratch.settle(docs.dropDuplicates(["uid"]).join(per_doc, "uid").select("uid", "bytes", "asks").mapInPandas(
        lean(cut), "key bigint, uid bigint, at bigint, low smallint, high smallint, open int, rings bigint, bytes binary"))
    few = compare_contexts(contexts.filter(F.col("rings") <= crowd), length)
    many = compare_windows(contexts.filter(F.col("rings") > crowd), length)
    # Stretches that follow each other within a task are few when joined here, before they move.
    spans = scratch.settle(closed.union(few).union(many).groupBy("uid").agg(
        F.collect_list(F.struct("start", "stop")).alias("spans")))
    scratch.drop(hits, rings, contexts)
    return spans


def joined(spans: list) -> list[tuple[int, int]]:
    """Stretches in order, those that touch as one."""
    out: list[tuple[int, int]] = []
    for start, stop in sorted((s["start"], s["stop"]) for s in spans):
        if out and start <= out[-1][1]:
            if stop > out[-1][1]:
                out[-1] = (out[-1][0], stop)
        else:
            out.append((start, stop))
    return out


def remove_repeats(docs: DataFrame, text: str = "text", keep: list[Column] | None = None, key: str = "doc_id", batches: int = BATCHES,
                   length: int = LENGTH, seed: int = SEED, crowd: int = CROWD) -> DataFrame:
    """The columns `keep` (all of `docs` by default), then kept_bytes, spans, n_bytes, n_removed, n_spans.

    Texts count as UTF-8 bytes. A byte is removed when it is covered by a string of `length` bytes that also starts
    anywhere else in the input, in the same text or another, judged on the input as it is. spans are the removed
    stretches (start, stop), kept_bytes the rest.

    The rows arrive in `batches` batches, dealt by hash. The seeds of a batch are counted, joined with the levels of
    earlier batches, and merged into them (`SuffixLevels`). Suffixes start only
    where each string of `length` bytes is sure to have one in the same place of all its occurrences. Suffixes
    whose seed is found twice are compared by all bytes around them at once, and where these differ string by string, so the
    result is that of comparing all strings, up to equal 64-bit fingerprints of one seed's strings.

    Null text is empty; rows that repeat repeat each other's strings; texts under `length` bytes are kept whole; an
    empty table gives an empty result; columns of the added names are replaced.
    """
    if not 0 < seed <= length < 1024:
        raise ValueError("needs 0 < seed <= length < 1024")
    scratch = Scratch(docs.sparkSession)
    added = ("kept_bytes", "spans", "n_bytes", "n_removed", "n_spans")
    columns = keep if keep is not None else [F.col(f"`{c}`") for c in docs.columns if c.lower() not in added]
    data = F.coalesce(F.col(text), F.lit("")).cast("binary")
    read = docs.select(F.xxhash64(F.col(key), F.col(text)).alias("uid"), data.alias("bytes"))
    spans = stretches(read, scratch, batches, length, seed, crowd)
    uid, raw_bytes, of, found = (free_name(docs, x) for x in ("_uid_read", "_bytes_read", "_uid_of", "_spans_of"))
    named = docs.select(*columns, F.xxhash64(F.col(key), F.col(text)).alias(uid), data.alias(raw_bytes))
    both = named.join(spans.withColumnsRenamed({"uid": of, "spans": found}), F.col(uid) == F.col(of), "left").drop(uid, of)
    schema = both.drop(raw_bytes, found).schema

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for low in range(0, len(batch), 500):
                part = batch.iloc[low:low + 500]
                cuts = [joined(s) if s is not None else [] for s in part[found]]
                kept = []
                for raw, cut in zip(part[raw_bytes], cuts):
                    ends = [0, *[x for c in cut for x in c], len(raw)]
                    kept.append(b"".join(raw[ends[i]:ends[i + 1]] for i in range(0, len(ends), 2)))
                out = part.drop(columns=[raw_bytes, found])
                out["kept_bytes"] = kept
                out["spans"] = [[{"start": a, "stop": b} for a, b in c] for c in cuts]
                out["n_bytes"] = [len(raw) for raw in part[raw_bytes]]
                out["n_removed"] = out["n_bytes"] - [len(k) for k in kept]
                out["n_spans"] = [len(c) for c in cuts]
                yield out

    scratch.keep(spans)
    return both.mapInPandas(lean(split), ", ".join([
        *[f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields],
        "kept_bytes binary, spans array<struct<start: bigint, stop: bigint>>, n_bytes bigint, n_removed bigint, n_spans bigint"]))

