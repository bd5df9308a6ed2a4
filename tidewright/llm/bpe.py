"""Byte-level BPE: texts to ids by a queue of merge ranks, and ids back to bytes."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import columns_of, free_name, lean, slices

#: Bytes of texts whose new pre-tokens are merged together.
TEXTS = 8 << 20
#: Pre-tokens, and characters of them, that a worker remembers.
KNOWN, KNOWN_CHARS = 1 << 19, 1 << 24
#: Pre-tokens of more bytes are merged one by one.
SHORT = 256

_CODECS: dict[tuple[str, str], Codec] = {}


class RankQueue:
    """Places of a linked list in one bucket for each merge rank.

    A bit tells which buckets hold something, a bit of the level above which words of 64 bits do, and so on, so the
    lowest rank is found by one find-first-set a level, whatever the number of places.
    """

    def __init__(self, ranks: int):
        self.buckets: list[list[int]] = [[] for _ in range(ranks)]
        self.levels: list[list[int]] = []
        size = max(ranks, 1)
        while not self.levels or size > 1:
            size = -(-size // 64)
            self.levels.append([0] * size)

    def mark(self, rank: int) -> None:
        """The bucket of this rank holds something."""
        for level in self.levels:
            word, bit = rank >> 6, 1 << (rank & 63)
            held = level[word]
            level[word] = held | bit
            if held:
                break
            rank = word

    def clear(self, rank: int) -> None:
        """The bucket of this rank is empty."""
        for level in self.levels:
            word = rank >> 6
            level[word] &= ~(1 << (rank & 63))
            if level[word]:
                break
            rank = word

    def push(self, rank: int, place: int) -> None:
        bucket = self.buckets[rank]
        if not bucket:
            self.mark(rank)
        heappush(bucket, place)

    def put(self, ranks: np.ndarray, places: np.ndarray) -> None:
        """Many places at once; a bucket then holds arrays of them."""
        order = np.argsort(ranks, kind="stable")
        ranks, places = ranks[order], places[order]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        starts = [0, *cuts.tolist()]
        for rank, low, high in zip(ranks[starts].tolist() if len(ranks) else [], starts, [*starts[1:], len(ranks)]):
            bucket = self.buckets[rank]
            if not bucket:
                self.mark(rank)
            bucket.append(places[low:high])

    def take(self, rank: int) -> np.ndarray:
        """All places of a rank that `put` has put there."""
        bucket = self.buckets[rank]
        out = bucket[0] if len(bucket) == 1 else np.concatenate(bucket)
        bucket.clear()
        self.clear(rank)
        return out

    def first(self) -> int:
        """The lowest rank that holds a place, -1 if none does."""
        if not self.levels[-1][0]:
            return -1
        at = 0
        for level in reversed(self.levels):
            held = level[at]
            at = (at << 6) + (held & -held).bit_length() - 1
        return at

    def pop(self, rank: int) -> int:
        """The leftmost place of a rank that `push` has put there."""
        bucket = self.buckets[rank]
        place = heappop(bucket)
        if not bucket:
            self.clear(rank)
        return place


class Codec(dict):
    """Numbers of pre-tokens, given when first asked for, and the ids of each."""

    def __init__(self, path: str, pattern: str):
        super().__init__()
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.pattern = regex.compile(pattern)
        size = max(self.ranks.values(), default=0) + 1
        self.queue = RankQueue(size)
        self.bytes_of = [b""] * size
        for token, rank in self.ranks.items():
            self.bytes_of[rank] = token
        # Two tokens that are a token together, by the ids of both, in order, and the rank of what they are together.
        joint = sorted((self.ranks[t[:i]] << 32 | self.ranks[t[i:]], rank) for t, rank in self.ranks.items()
                       for i in range(1, len(t)) if t[:i] in self.ranks and t[i:] in self.ranks)
        self.pairs, self.joint = np.array([(-1, -1), *joint], np.int64).T.copy()
        self.byte_id = np.array([self.ranks.get(bytes([i]), -1) for i in range(256)], np.int64)
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.fresh: list[str] = []
        self.chars = 0
        self.ids, self.ends = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def __missing__(self, piece: str) -> int:
        number = self[piece] = len(self)
        self.fresh.append(piece)
        self.chars += len(piece)
        return number

    def settle(self) -> None:
        """Find the ids of the pre-tokens that have none yet."""
        raw = [p.encode() for p in self.fresh]
        self.fresh = []
        found: list = [None] * len(raw)
        short = []
        for i, p in enumerate(raw):
            if (whole := self.ranks.get(p)) is not None:
                found[i] = [whole]
            elif len(p) <= SHORT:
                short.append(i)
            else:
                found[i] = self.merge(p)
        if short:
            ids, ends = self.merge_many([raw[i] for i in short])
            for i, low, high in zip(short, ends.tolist(), ends[1:].tolist()):
                found[i] = ids[low:high]
        if found:
            self.ids = np.concatenate([self.ids, *(np.asarray(f, np.uint32) for f in found)])
            self.ends = np.append(self.ends, self.ends[-1] + np.cumsum([len(f) for f in found]))

    def joint_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of what two tokens are together, -1 if that is no token or one of them is none."""
        keys = np.where((left < 0) | (right < 0), -1, left << 32 | right)
        at = np.searchsorted(self.pairs, keys).clip(max=len(self.pairs) - 1)
        return np.where((self.pairs[at] == keys) & (keys >= 0), self.joint[at], -1)

    def merge_many(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many pre-tokens, and where those of each begin, by one queue: each time the lowest rank of all comes up, every
        pre-token merges its leftmost place of that rank."""
        sizes = np.array([len(p) for p in pieces], np.int64)
        n = int(sizes.sum()) + len(pieces) + 1  # a place that holds no token stands between pre-tokens
        piece = np.repeat(np.arange(len(pieces)), sizes)
        places = np.arange(len(piece)) + piece + 1
        token = np.full(n, -1, np.int64)
        token[places] = self.byte_id[np.frombuffer(b"".join(pieces), np.uint8)]
        if (token[places] < 0).any():
            raise ValueError("the vocabulary has no token for some byte")
        owner = np.full(n, -1, np.int64)
        owner[places] = piece
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        pair = np.full(n, -1, np.int64)
        pair[:-1] = self.joint_rank(token[:-1], token[1:])
        queue = self.queue
        at = np.flatnonzero(pair >= 0)
        queue.put(pair[at], at)
        while (rank := queue.first()) >= 0:
            at = queue.take(rank)
            at = at[pair[at] == rank]  # the others have changed since
            if len(at) > 1:
                at.sort()
                own = owner[at]
                again = own[1:] == own[:-1]
                if again.any():
                    queue.put(np.full(int(again.sum()), rank), at[1:][again])
                    at = at[np.concatenate([[True], ~again])]
            if not len(at):
                continue
            gone = after[at]
            end = after[gone]
            token[at], token[gone] = rank, -2
            after[at], before[end] = end, at
            pair[gone] = -1
            left = before[at]
            here, there = np.concatenate([at, left]), np.concatenate([end, at])
            new = self.joint_rank(token[here], token[there])
            pair[here] = new
            some = np.flatnonzero(new >= 0)
            if len(some):
                queue.put(new[some], here[some])
        left = np.flatnonzero(token >= 0)
        return token[left], np.concatenate([[0], np.cumsum(np.bincount(owner[left], minlength=len(pieces)))])

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token: the whole of it if it is a token, else neighbours merged by lowest rank, leftmost first.

        Places that a merge has changed stay in their buckets and are skipped when they come up.
        """
        ranks = self.ranks
        if (whole := ranks.get(piece)) is not None:
            return [whole]
        n, queue = len(piece), self.queue
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pair = [-1] * n  # rank of each place with the next one, -1 for none
        for i in range(n - 1):
            rank = ranks.get(piece[i:i + 2], -1)
            if rank >= 0:
                pair[i] = rank
                queue.push(rank, i)
        while (rank := queue.first()) >= 0:
            i = queue.pop(rank)
            if pair[i] != rank:
                continue
            gone = after[i]
            end = after[i] = after[gone]
            pair[gone] = pair[i] = -1
            if end < n:
                before[end] = i
                pair[i] = ranks.get(piece[i:after[end]], -1)
                if pair[i] >= 0:
                    queue.push(pair[i], i)
            left = before[i]
            if left >= 0:
                pair[left] = ranks.get(piece[left:end], -1)
                if pair[left] >= 0:
                    queue.push(pair[left], left)
        out, i = [], 0
        while i < n:
            token = piece[i:after[i]]
            if token not in ranks:
                raise ValueError(f"the vocabulary has no token for byte {token!r}")
            out.append(ranks[token])
            i = after[i]
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian bytes of 32 bits, every match of the pattern by itself."""
        if len(self) > KNOWN or self.chars > KNOWN_CHARS:
            self.forget()
        coded = [np.fromiter(map(self.__getitem__, self.pattern.findall(t) if len(t) < TEXTS else (
            m.group() for m in self.pattern.finditer(t))), np.int64) for t in texts]
        self.settle()
        out = []
        for own in coded:
            start, size = self.ends[own], self.ends[own + 1] - self.ends[own]
            at = np.arange(size.sum()) + np.repeat(start - (np.cumsum(size) - size), size)
            out.append(self.ids[at].astype("<u4").tobytes())
        return out

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def decode_all(self, every: list[bytes]) -> list[bytes]:
        return [self.decode(ids) for ids in every]


def codec(path: str, pattern: str) -> Codec:
    """The codec of a ranks file, loaded once in a worker."""
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = Codec(path, pattern)
    return _CODECS[path, pattern]


def with_column(docs: DataFrame, source: Column, keep: list[Column] | None, made, out: str) -> DataFrame:
    """The columns `keep` (all of `docs` by default, but those of the name `out`), then `out`: what `made` gives for the
    values of `source`, as binary."""
    columns = keep if keep is not None else [F.col(f"`{c}`") for c in docs.columns if c.lower() != out]
    read = free_name(docs, "_read")
    named = docs.select(*columns, source.alias(read))
    kept = named.drop(read).schema

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = made()
        for batch in batches:
            for part in slices(batch, read, len(batch), TEXTS):
                values = pa.array(one(part.column(read).to_pylist()), pa.binary())
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept.names), values], [*kept.names, out])

    return named.mapInArrow(lean(walk), f"{columns_of(kept)}, {out} binary" if kept.fields else f"{out} binary")


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", keep: list[Column] | None = None) -> DataFrame:
    """The columns `keep` (all of `docs` by default), then ids: the ids of the text by the ranks file at `path`, as
    little-endian bytes of 32 bits each.

    A text is cut into pre-tokens, the matches of `pattern`. One that is a token is that token. In any other the two
    neighbours whose joint token has the lowest rank become one, the leftmost first, until no two have one. The
    next two come out of a `RankQueue`, so a pre-token of n bytes takes n log n steps, however long it is. The new short
    pre-tokens of some megabytes of texts stand in one queue: each rank that comes up is merged in all of them.

    Null and empty texts have no ids; a text of any length is encoded whole; rows
    that repeat are rows of their own; an empty table gives an empty result; a column `ids` is replaced.
    """
    return with_column(docs, F.coalesce(F.col(text), F.lit("")), keep, lambda: codec(path, pattern).encode, "ids")


def decode(tokens: DataFrame, path: str, pattern: str, ids: str = "ids", keep: list[Column] | None = None) -> DataFrame:
    """The columns `keep` (all of `tokens` by default), then bytes: what the ids stand for. Null ids give no bytes."""
    return with_column(tokens, F.coalesce(F.col(ids), F.lit("").cast("binary")), keep, lambda: codec(path, pattern).decode_all, "bytes")
