"""Periodic runs of words by block convolution."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import columns_of, free_name, lean, slices

#: A run has this many words, and this many times its period, at least.
LEAST, TIMES = 6, 4
#: Words looked at together; a longer text is looked at by itself.
WORDS = 1 << 16


class Fermat:
    """Transforms modulo 2**16 + 1, of up to 2**16 numbers. 2**16 is -1, so a product is reduced by a shift."""

    prime, most, root = 65537, 1 << 16, 3

    @staticmethod
    def less(x: np.ndarray) -> np.ndarray:
        """The same number modulo the prime, nearer to 0: numbers below 2**33 become ones of about 2**17."""
        low = x & 0xFFFF
        low -= x >> 16
        return low

    @staticmethod
    def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        x = a * b
        low = x & 0xFFFF
        x >>= 16
        low -= x
        return low

    settled = staticmethod(lambda x: Fermat.less(Fermat.less(x)))
    total = difference = staticmethod(lambda x: x)  # sums stay far below 2**47 over 16 levels

    @staticmethod
    def is_zero(x: np.ndarray) -> np.ndarray:
        x = Fermat.settled(Fermat.less(x))
        return (x == 0) | (x == 65537)


class Large:
    """Transforms modulo 3 * 2**30 + 1, of up to 2**30 numbers, reduced in full at every step."""

    prime, most, root = 3221225473, 1 << 30, 5

    product = staticmethod(lambda a, b: ((a.astype(np.uint64) * b.astype(np.uint64)) % np.uint64(Large.prime)).astype(np.int64))
    settled = total = difference = staticmethod(lambda x: x % Large.prime)

    @staticmethod
    def is_zero(x: np.ndarray) -> np.ndarray:
        return x % Large.prime == 0


_ROOTS: dict[tuple[int, int, bool], np.ndarray] = {}


def roots(field, size: int, inverse: bool) -> np.ndarray:
    """The first size / 2 powers of a root of unity of order `size`, or of its inverse."""
    key = (field.prime, size, inverse)
    if key not in _ROOTS:
        step = pow(field.root, (field.prime - 1) // size, field.prime)
        if inverse:
            step = pow(step, -1, field.prime)
        out = np.ones(1, np.int64)
        while len(out) < size // 2:  # doubled: powers so far, then times the next one
            out = np.concatenate([out, (out.astype(np.uint64) * np.uint64(pow(step, len(out), field.prime))
                                        % np.uint64(field.prime)).astype(np.int64)])
        _ROOTS[key] = out[:max(1, size // 2)]
    return _ROOTS[key]


def transform(field, blocks: np.ndarray) -> np.ndarray:
    """The transform of each column followed by as many zeros, its rows in bit-reversed order."""
    half, n = blocks.shape
    out = np.empty((2 * half, n), np.int64)
    out[:half] = blocks
    out[half:] = field.product(blocks, roots(field, 2 * half, False)[:, None])
    size = half
    while size > 1:
        at = out.reshape(2 * half // size, size, n)
        u, v = at[:, :size // 2], at[:, size // 2:]
        low = field.product(field.difference(u - v), roots(field, size, False)[:, None])
        at[:, :size // 2] = field.total(u + v)
        at[:, size // 2:] = low
        size //= 2
    return field.settled(out)


def transform_back(field, out: np.ndarray) -> np.ndarray:
    """The first half of what a transform in bit-reversed order came from; `out` is overwritten."""
    whole, n = out.shape
    size = 2
    while size <= whole:
        at = out.reshape(whole // size, size, n)
        v = field.product(at[:, size // 2:], roots(field, size, True)[:, None])
        u = at[:, :size // 2].copy()
        at[:, :size // 2] = field.total(u + v)
        at[:, size // 2:] = field.difference(u - v)
        size *= 2
    return field.product(field.settled(out[:whole // 2]), np.int64(pow(whole, -1, field.prime)))


def negated(size: int) -> np.ndarray:
    """For each row in bit-reversed order the row of the negative index."""
    bits = size.bit_length() - 1
    at, back = np.arange(size), np.zeros(size, np.int64)
    for i in range(bits):
        back |= ((at >> i) & 1) << (bits - 1 - i)
    return back[-back % size]


def occurrences(values: np.ndarray, block: int) -> np.ndarray:
    """(distance - block, block number) -> whether a block of `block` values stands again without a mismatch at that
    distance of block to 2 * block - 1, judged modulo a prime: no occurrence is missed, a few may be none.

    The squared differences of a block and a stretch of the two blocks behind it add up to the squares of both less twice
    their product sums, and all the product sums of a block are one convolution.
    """
    field = Fermat if 2 * block <= Fermat.most else Large
    own = values % field.prime if field is Large else values
    n = len(own) // block
    x = own.reshape(n, block)
    f = transform(field, np.ascontiguousarray(x.T))
    behind = f[:, 1:-1].copy()  # the two blocks behind: the second one's transform turns by half a circle
    behind[:block] += f[:block, 2:]
    behind[block:] -= f[block:, 2:]
    products = transform_back(field, field.product(f[negated(2 * block), :-2], field.settled(behind)))
    squares = field.product(own, own)
    upto = np.concatenate([[0], np.cumsum(squares)])
    start = np.arange(n - 2) * block
    away = np.arange(block)[:, None]
    stretch = upto[start + 2 * block + away] - upto[start + block + away]
    return field.is_zero((upto[start + block] - upto[start]) + stretch - 2 * products)


class Known:
    """The runs found so far, by period and start."""

    def __init__(self):
        self.by_period: dict[int, list[tuple[int, int]]] = {}

    def add(self, period: int, start: int, stop: int) -> None:
        self.by_period.setdefault(period, []).append((start, stop))

    def inside(self, distance: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Which stretches lie in a run whose period divides, and is less than, their distance."""
        out = np.zeros(len(start), bool)
        for period, runs in self.by_period.items():
            ask = np.flatnonzero((distance % period == 0) & (distance > period) & ~out)
            if len(ask):
                begin, end = np.array(sorted(runs)).T
                at = np.searchsorted(begin, start[ask], "right") - 1
                out[ask] = (at >= 0) & (end[at] >= stop[ask])
        return out


def runs_of(codes: np.ndarray, sizes: np.ndarray, least: int = LEAST, times: int = TIMES
            ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length, period) of all runs of texts of `sizes` words each, longest text first, whose words follow each
    other in `codes` as numbers from 0. See `find_runs`."""
    if times < 3:
        raise ValueError("a run must hold its period three times or more, or two blocks need not repeat at its distance")
    n = len(sizes)
    begins = np.cumsum(sizes + 1) - (sizes + 1)  # between texts stands a word that no text has
    x = np.empty(int((sizes + 1).sum()), np.int64)
    top = int(codes.max(initial=-1)) + 1
    x[np.arange(len(codes)) + np.repeat(np.arange(n), sizes)] = codes
    x[begins + sizes] = top + np.arange(n)
    known, found = Known(), []
    block = 1
    while n and sizes[0] >= max(least, times * block):
        texts = int(np.searchsorted(-sizes, -max(least, times * block), "right"))
        end = int(begins[texts - 1] + sizes[texts - 1] + 1)
        room = -(-end // block) * block + 2 * block
        part = np.empty(room, np.int64)
        part[:end] = x[:end]
        part[end:] = top + n + np.arange(room - end)
        mixed = (part.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        same = occurrences(((mixed >> np.uint64(24)) & np.uint64((1 << 16 if 2 * block <= Fermat.most else 1 << 31) - 1)).astype(np.int64), block)
        if same.shape[1] > 1:
            # A run has its period three times less one word, and so two neighbouring blocks that both stand again.
            twice = same[:, :-1] & same[:, 1:]
            at = np.flatnonzero(twice)
            wide = twice.shape[1]
            cut = np.flatnonzero(np.diff(at) != 1) + 1 if wide else at
            first = at[np.concatenate([[0], cut]).astype(np.int64)] if len(at) else at
            last = at[np.concatenate([cut - 1, [len(at) - 1]]).astype(np.int64)] if len(at) else at
            distance = block + first // wide
            start, stop = first % wide * block, (last % wide + 2) * block
            open_ = ~known.inside(distance, start, stop + distance)
            for d, low, high in zip(distance[open_].tolist(), start[open_].tolist(), stop[open_].tolist()):
                low, high = max(0, low - block), min(high + block, end - d)
                hit = part[low:high] == part[low + d:high + d]
                edge = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
                for a, b in zip((edge[::2] + low).tolist(), (edge[1::2] + low).tolist()):
                    if b + d - a >= max(least, times * d) and (a, b + d) not in known.by_period.get(d, ()) and not known.inside(
                            np.array([d]), np.array([a]), np.array([b + d]))[0]:
                        known.add(d, a, b + d)
                        found.append((a, b + d - a, d))
        block *= 2
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    start, length, period = np.array(sorted((a, p, l) for a, l, p in found), np.int64).T[[0, 2, 1]]
    text = np.searchsorted(begins, start, "right") - 1
    return text, start - begins[text], length, period


def words_of(texts: pa.Array) -> pa.ListArray:
    """The words of each text, which ASCII white space parts."""
    split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat, ends = split.values, split.offsets.to_numpy().astype(np.int64)
    full = np.concatenate([[0], np.cumsum(pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False))])
    return pa.ListArray.from_arrays(pa.array(full[ends], pa.int32()), flat.filter(pc.greater(pc.binary_length(flat), 0)))


def described(texts: pa.Array, least: int, times: int) -> tuple[pa.Array, pa.Array]:
    """(runs, collapsed text) of each text."""
    words = words_of(texts)
    ends = words.offsets.to_numpy().astype(np.int64)
    sizes = np.diff(ends)
    codes = words.values.dictionary_encode().indices.to_numpy().astype(np.int64)
    order = np.argsort(-sizes, kind="stable")
    taken = [np.zeros((4, 0), np.int64)]
    low = 0
    while low < len(order) and sizes[order[low]] >= least:
        total = np.cumsum(sizes[order[low:]])
        own = order[low:low + max(1, int(np.searchsorted(total, WORDS, "right")))]
        found = runs_of(np.concatenate([codes[ends[i]:ends[i + 1]] for i in own]), sizes[own], least, times)
        taken.append(np.stack([own[found[0]], *found[1:]]))
        low += len(own)
    text, start, length, period = np.concatenate(taken, axis=1)
    by = np.lexsort((period, start, text))
    text, start, length, period = text[by], start[by], length[by], period[by]
    gone = np.zeros(len(codes) + 1, np.int64)
    np.add.at(gone, ends[text] + start + period, 1)
    np.add.at(gone, ends[text] + start + length, -1)
    keep = np.cumsum(gone)[:-1] == 0
    left = np.concatenate([[0], np.cumsum(keep)])[ends]
    collapsed = pc.binary_join(pa.ListArray.from_arrays(pa.array(left, pa.int32()), words.values.filter(pa.array(keep))), " ")
    rows = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in (start, length, period)], ["start", "length", "period"])
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(text, np.arange(len(sizes) + 1)), pa.int32()), rows), collapsed


def find_runs(docs: DataFrame, text: str = "text", keep: list[Column] | None = None, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """The columns `keep` (all of `docs` by default), then runs and collapsed.

    A run is a stretch of at least `least` words and `times` times its smallest period, in which words a period apart are
    the same and which no word beside it goes on; runs are (start, length, period) by start, then period. In collapsed a
    run has its first period only: a word goes if any run holds it behind that run's first period; words are joined by
    one blank.

    For each power of two B the texts are cut into blocks of B words. A run of a period from B to 2B - 1 holds two
    neighbouring blocks that stand again a period later, and `occurrences` tells all distances at which blocks do. What
    neighbouring blocks share is extended word by word on both sides, so runs are exact. Smaller periods come first; a
    stretch inside a run whose period divides its distance is that run again.

    Null and empty texts have no runs and collapse to an empty text; texts of any length are looked at whole, in memory of
    some tens of bytes a word; rows that repeat are rows of their own; an empty table gives an empty result; columns
    of the added names are replaced.
    """
    columns = keep if keep is not None else [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("runs", "collapsed")]
    read = free_name(docs, "_text_read")
    named = docs.select(*columns, F.coalesce(F.col(text), F.lit("")).alias(read))
    kept = named.drop(read).schema

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, read, 4096):
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept.names), *described(part.column(read), least, times)],
                                                 [*kept.names, "runs", "collapsed"])

    return named.mapInArrow(lean(walk), f"{columns_of(kept)}, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string")
