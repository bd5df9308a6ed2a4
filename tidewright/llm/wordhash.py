"""Fingerprints of the words of many texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Bytes looked at together. Words longer than this are hashed one by one.
BLOCK = 1 << 17

_TABLES: list[np.ndarray] = []


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(32))


def tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(powers of an odd base, of its inverse modulo 2**64, number for each byte with A-Z as a-z, which bytes are words)."""
    if not _TABLES:
        base = 0x9E3779B97F4A7C15
        for b in (base, pow(base, -1, 1 << 64)):
            out = np.full(BLOCK + 1, b, np.uint64)
            out[0] = 1
            _TABLES.append(np.multiply.accumulate(out))
        byte = np.arange(256)
        low = np.where((byte >= 65) & (byte <= 90), byte + 32, byte)
        _TABLES.append(mixed((low + 1).astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9)) | np.uint64(1))
        _TABLES.append((byte != 0x20) & ((byte < 0x09) | (byte > 0x0D)))
    return tuple(_TABLES)


def block_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the words of a block in order, where each begins); no word goes over one of `starts`."""
    power, inverse, number, is_word = tables()
    word = is_word[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[starts] = True
    edge[-1] = True
    first = word.copy()
    first[1:] &= ~word[:-1] | edge[1:-1]
    last = word.copy()
    last[:-1] &= ~word[1:] | edge[1:-1]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(number[data] * power[:len(data)], out=sums[1:])
    return mixed((sums[end] - sums[begin]) * inverse[begin] + (end - begin).astype(np.uint64)), begin


def long_text_hashes(raw: bytes) -> np.ndarray:
    """Hashes of the words of one text of any length, cut at white space."""
    out, at = [], 0
    space = b" \t\n\x0b\x0c\r"
    while at < len(raw):
        end = min(at + BLOCK, len(raw))
        if end < len(raw) and raw[end] not in space:
            end = max(raw.rfind(bytes([c]), at, end) for c in space) + 1
            if end <= at:  # one word fills the block
                end = at
                while end < len(raw) and raw[end] not in space:
                    end += 1
                if end - at > BLOCK:
                    out.append(np.array([xxhash.xxh64_intdigest(raw[at:end].lower())], np.uint64))
                    at = end
                    continue
        out.append(block_hashes(np.frombuffer(raw[at:end], np.uint8), np.zeros(1, np.int64))[0])
        at = end
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words in order, number of words per text).

    Words are what lies between ASCII white space; A-Z count as a-z; null has none.
    """
    texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type)
    _, places, data = texts.buffers()
    offsets = np.frombuffer(places, np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64) \
        if len(texts) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    out, size = [], np.zeros(len(texts), np.int64)
    at = 0
    while at < len(texts):
        end = int(np.searchsorted(offsets, offsets[at] + BLOCK, "right")) - 1
        if end <= at:
            own = long_text_hashes(raw[offsets[at]:offsets[at + 1]].tobytes())
            out.append(own)
            size[at] = len(own)
            at += 1
            continue
        end = min(end, len(texts))
        starts = offsets[at:end] - offsets[at]
        part = raw[offsets[at]:offsets[end]]
        if len(part):
            hashes, begin = block_hashes(part, starts)
            out.append(hashes)
            edges = np.searchsorted(begin, np.append(starts, len(part)))
            size[at:end] = np.diff(edges)
        at = end
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), size


def shingle_sets(texts: pa.Array, words: int) -> Iterator[np.ndarray]:
    """For each text the sorted hashes of its distinct n-grams; all words as one where there are fewer."""
    for low in range(0, len(texts), 256):
        hashes, size = word_hashes(texts.slice(low, 256))
        ends = np.cumsum(size)
        rolled = np.zeros(len(hashes), np.uint64)
        for k in range(words):
            moved = np.zeros_like(hashes)
            moved[:max(0, len(hashes) - k)] = hashes[k:]
            rolled = (rolled ^ (rolled >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9) + moved
        rolled = mixed(rolled)
        for start, n in zip((ends - size).tolist(), size.tolist()):
            if n >= words:
                yield distinct(rolled[start:start + n - words + 1])
            elif n:
                whole = np.array([n], np.uint64)
                for k in range(n):
                    whole = mixed(whole + hashes[start + k:start + k + 1])
                yield whole
            else:
                yield np.zeros(0, np.uint64)


def distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    keep = np.empty(len(x), bool)
    keep[0] = True
    np.not_equal(x[1:], x[:-1], out=keep[1:])
    return x[keep]
