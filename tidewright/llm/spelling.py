"""Spelling variants: words one edit apart, found by exact signatures of their letters."""

from __future__ import annotations

import itertools
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import lean
from tidewright.llm.wordhash import mixed
from tidewright.session import Scratch

#: Fixed by the task: what a run of letters is.
LETTERS = r"[A-Za-zÀ-ÿ]+"
LEAST_LENGTH, LEAST_COUNT = 5, 3
#: A form stands this many times as often as the word it stands for, at least.
TIMES = 2
#: Parts that the letters of a half are dealt into.
PARTS = 4
#: Words that a task counts before it passes them on, and characters of a text that it takes at once.
HELD, CHARS = 1 << 19, 1 << 20


def runs_of(text: str, pattern: re.Pattern) -> Iterator[str]:
    """The runs of letters of a text with A-Z in lower case, a long text's a stretch at a time."""
    low = text.encode().lower().decode()  # of bytes, lower() changes A-Z only
    return iter(pattern.findall(low)) if len(low) <= CHARS else (m.group() for m in pattern.finditer(low))


def count_words(docs: DataFrame, key: str = "doc_id", text: str = "text", letters: str = LETTERS, least_length: int = LEAST_LENGTH,
                least_count: int = LEAST_COUNT, edit: Callable[[str, int], str] | None = None) -> DataFrame:
    """(word, n) of the runs of letters that have `least_length` code points or more and occur `least_count` times or more in
    all texts, after `edit(run, checksum)`, if given, has had its turn; checksum is the crc32 of `<key>:<run>`.

    Each text's runs are counted first, then each task's, in tables of bounded size, so a very frequent word is a few rows.
    Null texts have no runs; a null key stands as an empty one.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern, held = re.compile(letters), Counter()

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for name, own in zip(batch.column("key").to_pylist(), batch.column("text")):
                start = zlib.crc32(f"{'' if name is None else name}:".encode())
                for run, n in Counter(runs_of(own.as_py() or "", pattern)).items():
                    if len(run) >= least_length:
                        if edit is not None:
                            run = edit(run, zlib.crc32(run.encode(), start))
                            if len(run) < least_length:
                                continue
                        held[run] += n
                if len(held) >= HELD:
                    yield rows()
                    held.clear()
        if held:
            yield rows()

    read = docs.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text"))
    return read.mapInArrow(lean(count), "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def vectors(words: list[str], parts: int) -> np.ndarray:
    """The letters of each word as a binary vector with a place for the first, second, ... of each letter, in `parts` parts:
    the sum of the hashes of the places that are set in each part."""
    out = np.zeros((len(words), parts), np.uint64)
    if not words:
        return out
    row = np.repeat(np.arange(len(words)), [len(w) for w in words])
    letter = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    order = np.argsort(row << 21 | letter, kind="stable")
    row, letter = row[order], letter[order]
    at = np.arange(len(row))
    first = np.concatenate([[True], (row[1:] != row[:-1]) | (letter[1:] != letter[:-1])]) if len(row) else np.zeros(0, bool)
    which = at - np.maximum.accumulate(np.where(first, at, 0)) if len(row) else at
    place = mixed((letter << 24 | which).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))
    np.add.at(out, (row, (place >> np.uint64(40)) % np.uint64(parts)), place)
    return out


def signatures(words: DataFrame, parts: int = PARTS) -> DataFrame:
    """(key, role, word, n): the signatures of each of the rows (word, n).

    Two words are one edit apart only if one of their halves is the same and the letters of the other, as binary vectors,
    differ in two places at most: two where a letter is replaced, one where one is inserted. So the halves are the first
    partition, and one half's vector stands in the key whole. The other half's parts are the second one: at most as many of
    them differ as places do, so the vectors agree on some choice of all parts but two, or but one. A key holds which
    half is whole, the length of the shorter word, the choice and the sums of the parts chosen. Role 0 meets role 0 (words of
    one length), role 1 (the shorter word) meets role 2.
    """

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, len(batch), 2048):
                part = batch.slice(low, 2048)
                own = part.column("word").to_pylist()
                size = np.array([len(w) for w in own], np.int64)
                keys, roles = [], []
                # (role, letters that the shorter word lacks, places that differ)
                for role, more, differ in ((0, 0, 2), (1, 0, 1), (2, 1, 1)):
                    for half in (0, 1):
                        # The shorter word is cut in the middle; a longer one has its further letter in the half that differs.
                        cut = [(n - more) // 2 + more * half for n in size.tolist()]
                        first, second = ([w[:c] for w, c in zip(own, cut)], [w[c:] for w, c in zip(own, cut)])
                        same, other = (first, second) if half == 0 else (second, first)
                        whole, rest = vectors(same, 1)[:, 0], vectors(other, parts)
                        kind = (role > 0) * 2 + half
                        start = mixed(whole + mixed(np.uint64(kind) + np.uint64(4) * (size - more).astype(np.uint64)))
                        for left in itertools.combinations(range(parts), differ):
                            kept = rest.sum(1, dtype=np.uint64) - rest[:, list(left)].sum(1, dtype=np.uint64)
                            choice = np.uint64(sum(1 << x for x in left))
                            keys.append(mixed(start + mixed(kept + choice * np.uint64(0xA0761D6478BD642F))))
                            roles.append(role)
                every = pa.array(np.tile(np.arange(len(own)), len(keys)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.repeat(roles, len(own)), pa.int32()),
                     part.column("word").take(every), part.column("n").take(every)], ["key", "role", "word", "n"])

    return words.mapInArrow(lean(spread), "key bigint, role int, word string, n bigint")


def shuffled(side: DataFrame) -> DataFrame:
    """`side` of a join, never to be broadcast. Spark sizes a written table of words by its compressed files, and signatures as if
    there were one for each word, so what looks small can be hundreds of times as large in the driver."""
    return side.hint("merge")


def near_pairs(words: DataFrame, parts: int = PARTS) -> DataFrame:
    """(a, na, b, nb): every pair of words of the rows (word, n) that one inserted, deleted or replaced code point parts, once."""
    if parts < 3:
        raise ValueError("of fewer than three parts, two left out leave nothing to agree on")
    rows = signatures(words, parts)
    a, b = rows.alias("a"), rows.alias("b")
    # 0 for two words of one length, 5 for a shorter and a longer one; said so that both sides are one exchange.
    meet = F.col("a.role") * 3 + F.col("b.role")
    near = ((meet == 5) | ((meet == 0) & (F.col("a.word") < F.col("b.word")))) & (F.levenshtein("a.word", "b.word", 1) == 1)
    return a.join(shuffled(b), (F.col("a.key") == F.col("b.key")) & near).select(
        F.col("a.word").alias("a"), F.col("a.n").alias("na"), F.col("b.word").alias("b"), F.col("b.n").alias("nb")).distinct()


def follow(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """(word, root) of the rows (word, form): where following forms ends. A form is more frequent than what it stands for, so
    there is an end; every round doubles how far each word has followed, so n steps take log2(n) rounds."""
    now = scratch.settle(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = now.select(F.col("word").alias("of"), F.col("root").alias("next"))
        step = scratch.settle(now.join(shuffled(ahead), F.col("root") == F.col("of"), "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        scratch.drop(now)
        now = step.select("word", "root")
        if step.filter("moved").isEmpty():
            return now
        now = scratch.settle(now)
        scratch.drop(step)


def group_variants(words: DataFrame, times: float = TIMES, parts: int = PARTS) -> DataFrame:
    """(word, n, form, root, n_near, form_n) for the rows (word, n), n how often a word occurs.

    Words are near if exactly one inserted, deleted or replaced code point parts them; n_near counts a word's near words.
    Its form is the near word of largest n, of several the first in code point order, if that n is `times` the word's n or
    more, else null; form_n is that n. root is where following forms from the word ends, the word itself without a form.

    Candidates come out of an equi-join of exact signatures (`signatures`), which misses no near pair, and each is
    verified in that join; groups of words that share a signature are ones that Spark splits, and hold no list.

    Null words are left out and words that repeat are added up first; words of any length, the empty word and an empty
    table need no care; other columns are not looked at.
    """
    scratch = Scratch(words.sparkSession)
    own = scratch.settle(words.filter("word IS NOT NULL").groupBy("word").agg(F.sum("n").cast("long").alias("n")))
    pairs = scratch.settle(near_pairs(own, parts))
    both = pairs.union(pairs.select("b", "nb", "a", "na"))
    best = F.min_by(F.struct(F.col("b").alias("form"), F.col("nb").alias("form_n")), F.struct(-F.col("nb"), F.col("b")))
    near = scratch.settle(both.groupBy(F.col("a").alias("of"), F.col("na").alias("n_of")).agg(
        F.count("*").alias("n_near"), best.alias("best")).select(
        "of", "n_near", F.when(F.col("best.form_n") >= F.col("n_of") * times, F.col("best")).alias("best")))
    scratch.drop(pairs)
    roots = scratch.settle(follow(near.filter("best IS NOT NULL").select(F.col("of").alias("word"), "best.form"), scratch)
                           .withColumnRenamed("word", "start"))
    scratch.keep(own, near, roots)
    scratch.drop(*[df for df, _ in list(scratch.tables.values())])
    return own.join(shuffled(near), F.col("word") == F.col("of"), "left").join(
        shuffled(roots), F.col("word") == F.col("start"), "left").select(
        "word", "n", "best.form", F.coalesce("root", "word").alias("root"), F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        "best.form_n")
