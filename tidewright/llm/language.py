"""Language of texts by n-gram filters whose slots hold a bit for every language."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import free_name, lean
from tidewright.session import Scratch

UNKNOWN = "und"
#: A filter holds the n-grams that are at least this share of a language's, so at most 1 / SHARE of them.
SHARE = 1e-5
SLOTS = 1 << 20
HASHES = 3
#: Characters handled at once; a longer text goes through in slices.
SLICE = 1 << 17

_LETTERS: list[np.ndarray] = []


def letters() -> np.ndarray:
    """For each code point whether it is a letter."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def grams(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text number, n-gram) of the given texts, in slices.

    An n-gram is a letter with the characters beside it, lower case, all that are no letters
    alike. Its 63 bits hold the three code points.
    """
    pieces, owners, size = [], [], 0

    def flush():
        codes = np.frombuffer("".join(pieces).encode("utf-32-le", "surrogatepass"), np.uint32)
        plain = np.where(letters()[codes], codes, 0).astype(np.uint64)
        inner = np.ones(len(codes), bool)
        ends = np.cumsum([len(p) for p in pieces])
        inner[ends - 1] = False
        inner[ends - np.array([len(p) for p in pieces])] = False
        at = np.flatnonzero(inner & (plain > 0))
        owner = np.repeat(np.array(owners, np.int64), [len(p) for p in pieces])
        return owner[at], (plain[at - 1] << np.uint64(42)) | (plain[at] << np.uint64(21)) | plain[at + 1]

    for i, text in enumerate(texts):
        text = text.lower()
        for low in range(0, len(text), SLICE):
            high = min(low + SLICE, len(text))
            pieces.append((text[low - 1] if low else "\n") + text[low:high] + (text[high] if high < len(text) else "\n"))
            owners.append(i)
            size += high - low
            if size >= SLICE:
                yield flush()
                pieces, owners, size = [], [], 0
    if pieces:
        yield flush()


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, back = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(back, weights=np.concatenate([n for _, n in parts]), minlength=len(keys)).astype(np.int64)


def count_grams(batches: Iterator[pd.DataFrame], most: int = 1 << 19) -> Iterator[pd.DataFrame]:
    """(lang, gram, n) of rows (lang, text), summed within the task while there are at most `most`."""
    held: dict[str, list] = {}
    size = 0

    def emit():
        for lang, parts in held.items():
            keys, n = merged(parts)
            for low in range(0, len(keys), 100_000):
                yield pd.DataFrame({"lang": lang, "gram": keys[low:low + 100_000].astype(np.int64), "n": n[low:low + 100_000]})

    for batch in batches:
        for lang, own in batch.groupby("lang"):
            for _, keys in grams(own["text"].tolist()):
                parts = held.setdefault(lang, [])
                parts.append(np.unique(keys, return_counts=True))
                if len(parts) >= 16:
                    held[lang] = [merged(parts)]
        size = sum(len(k) for parts in held.values() for k, _ in parts)
        if size > most:
            held = {lang: [merged(parts)] for lang, parts in held.items()}
            if sum(len(parts[0][0]) for parts in held.values()) > most:
                yield from emit()
                held = {}
    yield from emit()


def slots_of(keys: np.ndarray, slots: int) -> Iterator[np.ndarray]:
    """Places of n-grams in the filter, one array for each hash."""
    x = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    step = (x >> np.uint64(33)) | np.uint64(1)
    for i in range(HASHES):
        yield ((x + np.uint64(i) * step) & np.uint64(slots - 1)).astype(np.int64)


@dataclass
class Filters:
    """Bit i % 64 of words[i // 64][slot] is set where an n-gram of language i falls in the slot."""

    langs: list[str]
    words: list[np.ndarray]
    false_rate: np.ndarray

    def hits(self, keys: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
        """For each text and language, how many n-grams the language's filter holds."""
        found = np.zeros((n, len(self.langs)))
        places = list(slots_of(keys, len(self.words[0]) if self.words else SLOTS))
        for w, word in enumerate(self.words):
            mask = word[places[0]]
            for p in places[1:]:
                mask = mask & word[p]
            for bit in range(min(64, len(self.langs) - 64 * w)):
                found[:, 64 * w + bit] += np.bincount(owner[(mask >> np.uint64(bit)) & np.uint64(1) == 1], minlength=n)
        return found


def train(docs: DataFrame, text: str = "text", lang: str = "lang", share: float = SHARE, slots: int = SLOTS) -> Filters:
    """Filters from all rows with a text and a language.

    N-grams are counted over all rows, within tasks first. A language keeps those that are at least
    `share` of its own (and occur twice), which leaves out what slips in from elsewhere and bounds
    what reaches the driver to 1 / share n-grams a language, whatever the size of the corpus.
    """
    known = docs.filter(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    scratch = Scratch(docs.sparkSession)
    counts = scratch.settle(known.mapInPandas(lean(count_grams), "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(
        F.sum("n").alias("n")))
    rows = counts.groupBy("lang").agg(F.sum("n").alias("all"))
    totals = {r["lang"]: r["all"] for r in rows.collect()}  # one row per language
    langs = sorted(totals)
    least = F.element_at(F.create_map(*[x for l in langs for x in (F.lit(l), F.lit(float(totals[l]) * share))]),
                         F.col("lang")) if langs else F.lit(0.0)
    kept = counts.filter((F.col("n") >= least) & (F.col("n") >= 2)).select("lang", "gram").toPandas()
    scratch.drop(counts)
    words = [np.zeros(slots, np.uint64) for _ in range(-(-len(langs) // 64))]
    rate = np.zeros(len(langs))
    for i, name in enumerate(langs):
        keys = kept.loc[kept["lang"] == name, "gram"].to_numpy(np.int64)
        bit = np.uint64(1 << (i % 64))
        for place in slots_of(keys, slots):
            words[i // 64][place] |= bit
        rate[i] = float(np.mean(words[i // 64] & bit != 0)) ** HASHES
    return Filters(langs, words, rate)


def predict(docs: DataFrame, filters: Filters, text: str = "text", keep: list[Column] | None = None) -> DataFrame:
    """The columns `keep` (all of `docs` by default), then lang_pred, score and margin.

    Each n-gram is looked up once and answers for all languages. A language's hits, less those
    expected by chance from how full its bits are, decide; score is their share of the text's
    n-grams, margin the distance to the next language. Ties go to the first language in code
    point order. A text that is null or without letters is UNKNOWN with score 0, and so is every
    text when nothing was learned. The filters are of a size fixed by parameters, so every task holds
    them. Columns of these names are replaced; rows that repeat and empty tables need no care.
    """
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(filters)
    columns = keep if keep is not None else [F.col(f"`{c}`") for c in docs.columns
                                             if c.lower() not in ("lang_pred", "score", "margin")]
    read = free_name(docs, "_text_read")
    named = docs.select(*columns, F.col(text).alias(read))
    schema = named.drop(read).schema

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = sent.value
        for batch in batches:
            n = len(batch)
            found, size = np.zeros((n, max(1, len(own.langs)))), np.zeros(n)
            for owner, keys in grams(batch[read].fillna("").tolist()):
                size += np.bincount(owner, minlength=n)
                if own.langs:
                    found += own.hits(keys, owner, n)
            if own.langs:
                found = np.clip((found - size[:, None] * own.false_rate) / (1 - own.false_rate), 0, None)
            part = found / np.maximum(size, 1)[:, None]
            best = part.argmax(1)
            score = part[np.arange(n), best]
            rest = part.copy()
            rest[np.arange(n), best] = 0
            known = (size > 0) & bool(own.langs)
            out = batch.drop(columns=read)
            out["lang_pred"] = np.where(known, np.array(own.langs or [UNKNOWN], dtype=object)[best], UNKNOWN)
            out["score"] = np.where(known, np.minimum(score, 1.0), 0.0)
            out["margin"] = np.where(known, score - rest.max(1), 0.0)
            yield out

    return named.mapInPandas(lean(judge), ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields],
                                               "lang_pred string", "score double", "margin double"]))
