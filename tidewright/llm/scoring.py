"""Cross-entropy difference of a target and a background language model."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidewright.llm.common import lean, slices
from tidewright.llm.wordhash import mixed, word_hashes
from tidewright.session import Scratch

#: A word seen less often in both samples together is the unknown word, in a corpus of any size.
SEEN = 2
#: Pairs of words seen less often in both samples together count as unseen.
LEAST = 1
ALPHA = 0.1
UNKNOWN, BEGIN = np.uint64(1), np.uint64(2)
#: Bytes of text of a part, and of all texts for one bucket of words or pairs.
PART, BUCKET = 8 << 20, 8 << 20
#: Rows of one key that go to one part.
HOT = 1024

COUNTED = "bucket bigint, part bigint, words binary, t binary, b binary"
SUMMED = "part bigint, bucket bigint, t binary, b binary, n bigint, known bigint, unknown_t bigint, unknown_b bigint"


def packed(x: np.ndarray) -> bytes:
    """Whole numbers in the fewest bytes that hold the largest, compressed; the first byte tells how many."""
    top = int(x.max(initial=0))
    wide = next(w for w in (1, 2, 4, 8) if top < 1 << 8 * w)
    return bytes([wide]) + pa.compress(x.astype(f"<u{wide}").tobytes(), codec="zstd", asbytes=True)


def unpacked(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(raw[1:], n * raw[0], codec="zstd", asbytes=True), f"<u{raw[0]}").astype(np.int64)


def packed_keys(keys: np.ndarray) -> bytes:
    """Keys in order, as the steps between them, all first bytes together and so on, compressed; how many stands ahead."""
    steps = np.diff(keys, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8)
    return len(keys).to_bytes(8, "little") + pa.compress(np.ascontiguousarray(steps.T).tobytes(), codec="zstd", asbytes=True)


def unpacked_keys(raw: bytes) -> np.ndarray:
    n = int.from_bytes(raw[:8], "little")
    steps = np.frombuffer(pa.decompress(raw[8:], 8 * n, codec="zstd", asbytes=True), np.uint8).reshape(8, n)
    return np.cumsum(np.ascontiguousarray(steps.T).view("<u8").ravel(), dtype=np.uint64)


class Part:
    """The texts of a part by words, each different text once, and what has been looked up for them."""

    def __init__(self, number: int):
        self.number = number
        self.targets: set = set()
        self.words: list[tuple[np.ndarray, np.ndarray]] = []
        self.pairs: list[tuple[np.ndarray, np.ndarray]] = []
        self.rows: list[tuple] = []  # (key, number of its text, is target, is background)
        self.numbers: dict[int, int] = {}
        self.held: list[np.ndarray] = []

    def add(self, batch: pa.RecordBatch) -> None:
        kind = batch.column("kind")[0].as_py()
        if kind == 0:
            self.targets.update(batch.column("key").to_pylist())
        elif kind < 3:
            held = self.words if kind == 1 else self.pairs
            for t, b, n in zip(*(batch.column(c).to_pylist() for c in ("t", "b", "n"))):
                held.append((unpacked(t, n), unpacked(b, n)))
        else:
            for own in slices(batch, "text", 512):
                hashes, sizes = word_hashes(own.column("text"))
                ends = np.cumsum(sizes)
                drawn = own.column("drawn").to_pylist()
                marks = own.column("mark").to_pylist()
                for key, mark, flag, end, n in zip(own.column("key").to_pylist(), marks, drawn, ends.tolist(), sizes.tolist()):
                    if mark not in self.numbers:
                        self.numbers[mark] = len(self.numbers)
                        self.held.append(hashes[end - n:end])
                    self.rows.append((key, self.numbers[mark], key in self.targets, flag))

    def close(self) -> Part:
        """All texts are there."""
        n = len(self.held)
        self.text_of_row = np.array([r[1] for r in self.rows], np.int64)
        self.is_target, self.is_drawn = (np.array([r[i] for r in self.rows], bool) for i in (2, 3))
        self.weights = [np.bincount(self.text_of_row, weights=x, minlength=n) for x in (self.is_target, self.is_drawn)]
        self.sizes = np.array([len(h) for h in self.held], np.int64)
        self.hashes = np.concatenate(self.held) if n else np.zeros(0, np.uint64)
        self.held = []
        self.text = np.repeat(np.arange(n), self.sizes)
        return self

    def distinct_words(self) -> tuple[np.ndarray, np.ndarray]:
        return np.unique(self.hashes, return_inverse=True)

    def counts(self, place: np.ndarray, n: int) -> list[np.ndarray]:
        """How often each of `n` things stands in target and in background texts; `place` tells the one of each word."""
        return [np.bincount(place, weights=w[self.text], minlength=n).astype(np.int64) for w in self.weights]

    def mapped(self, seen: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hash of each word, UNKNOWN outside the vocabulary; its place; whether the word of each place is known)."""
        words, place = self.distinct_words()
        self.word_totals = joined(self.words, len(words))
        known = self.word_totals[0] + self.word_totals[1] >= seen
        return np.where(known, words, UNKNOWN)[place], place, known

    def distinct_pairs(self, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keys of the pairs of words, those before in a text and BEGIN before its first, and the place of each word's."""
        before = np.empty_like(own)
        before[1:] = own[:-1]
        before[(np.cumsum(self.sizes) - self.sizes)[self.sizes > 0]] = BEGIN
        return np.unique(mixed(mixed(before) + own), return_inverse=True)

    def blobs(self, keys: np.ndarray, counts: list[np.ndarray], buckets: int) -> Iterator[pa.RecordBatch]:
        """Keys in order with their counts, by ranges of the keys."""
        edges = np.array([-(-(k << 64) // buckets) for k in range(1, buckets)], np.uint64)
        cuts = [0, *np.searchsorted(keys, edges).tolist(), len(keys)]
        full = [k for k in range(buckets) if cuts[k] < cuts[k + 1]]
        for low in range(0, len(full), 512):
            own = [(k, slice(cuts[k], cuts[k + 1])) for k in full[low:low + 512]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in own], pa.int64()), pa.array([self.number] * len(own), pa.int64()),
                 pa.array([packed_keys(keys[s]) for _, s in own], pa.binary()),
                 *[pa.array([packed(c[s]) for _, s in own], pa.binary()) for c in counts]], ["bucket", "part", "words", "t", "b"])


def joined(found: list[tuple[np.ndarray, np.ndarray]], n: int) -> list[np.ndarray]:
    """Totals of all buckets, which come in order."""
    out = [np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in (0, 1)]
    if len(out[0]) != n:
        raise ValueError(f"looked up {len(out[0])} of {n}: texts of a part have changed between two passes")
    return out


def parts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[Part]:
    """The parts of rows in order of part and kind."""
    part = None
    for batch in batches:
        number, kind = (batch.column(c).to_numpy() for c in ("part", "kind"))
        cuts = np.flatnonzero((number[1:] != number[:-1]) | (kind[1:] != kind[:-1])) + 1
        for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), len(batch)]):
            if low == high:
                continue
            if part is None or part.number != number[low]:
                if part is not None:
                    yield part.close()
                part = Part(int(number[low]))
            part.add(batch.slice(low, high - low))
    if part is not None:
        yield part.close()


def totals(counted: DataFrame, seen: int) -> DataFrame:
    """For each part and bucket the sums, over all parts, of the counts of its keys, in their order; and for each bucket a
    row without part: how many keys are seen `seen` times or more, and the counts of the others.

    A bucket's keys are as many as one task can hold, whatever the corpus; a key in all texts stands in it once a part.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def settle(bucket: int, held: list[tuple]) -> Iterator[pa.RecordBatch]:
            keys = [unpacked_keys(h[1]) for h in held]
            sizes = [len(k) for k in keys]
            every, place = np.unique(np.concatenate(keys), return_inverse=True)
            sums = [np.bincount(place, weights=np.concatenate([unpacked(h[i], n) for h, n in zip(held, sizes)]),
                                minlength=len(every)).astype(np.int64) for i in (2, 3)]
            known = sums[0] + sums[1] >= seen
            ends = np.cumsum(sizes).tolist()
            cut = [slice(e - n, e) for e, n in zip(ends, sizes)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([*(h[0] for h in held), None], pa.int64()), pa.array([bucket] * (len(held) + 1), pa.int64()),
                 *[pa.array([*(packed(s[place[c]]) for c in cut), None], pa.binary()) for s in sums], pa.array([*sizes, None], pa.int64()),
                 *[pa.array([None] * len(held) + [int(x)], pa.int64()) for x in (known.sum(), sums[0][~known].sum(), sums[1][~known].sum())]],
                ["part", "bucket", "t", "b", "n", "known", "unknown_t", "unknown_b"])

        bucket, held = None, []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("bucket", "part", "words", "t", "b"))):
                if row[0] != bucket:
                    if held:
                        yield from settle(bucket, held)
                    bucket, held = row[0], []
                held.append(row[1:])
        if held:
            yield from settle(bucket, held)

    return counted.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(lean(add), SUMMED)


def score(docs: DataFrame, is_target: DataFrame, key: str = "doc_id", text: str = "text", seen: int = SEEN,
          least: int = LEAST, alpha: float = ALPHA, leave_out: bool = False) -> DataFrame:
    """(key, n_tokens, loss_target, loss_background, loss_difference) per row of `docs`.

    Two models of word pairs are learned: from all documents whose key is in `is_target`, and from a background
    drawn by hash of the key from all documents, of about as many bytes. They share the vocabulary and the smoothing: after a word h the
    chance of w is (count(h w) + alpha) / (count(h) + alpha * V). A loss is the mean of -log over the text's
    words; the difference, target less background, is low for texts like the target's.

    The vocabulary is all words seen `seen` times or more in both samples together, however large these are; pairs seen
    less than `least` times count as unseen. With `leave_out` a document that a model was learned from is scored without its
    own counts.

    Texts are dealt into parts by key. A part sends its different words with their counts in its texts of both samples, in
    ranges of their hashes, to buckets; a bucket adds up what all parts sent and answers each with the sums. With
    these the part knows its vocabulary and does the same with its pairs; then it has all that its texts' scores need.
    So words and pairs, which are as many as the corpus has, are never in one place, and what moves is a row for each
    part and bucket. A key of very many rows is dealt to many parts by text.

    Null and empty texts have no words and losses of 0; words outside the vocabulary are one unknown word; a
    null key is never a target; rows that repeat are rows of their own; a text of any length is in one part; with no target
    or no background the counts of that model are 0 and every word is as likely; an empty table gives an empty result;
    other columns are not looked at.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    kind = docs.schema[key].dataType.simpleString()
    wanted = is_target.select(F.col(key).cast(kind).alias("key")).filter("key IS NOT NULL").distinct()
    read = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    per_key = scratch.settle(read.groupBy("key").agg(F.sum(F.octet_length("text").cast("long")).alias("size"), F.count("*").alias("rows")))
    volume = F.coalesce(F.sum("size"), F.lit(0))
    size = per_key.agg(volume).first()[0]
    share = min(1.0, per_key.join(wanted, "key", "left_semi").agg(volume).first()[0] / max(1, size))
    hot = scratch.settle(per_key.filter((F.col("rows") > HOT) & F.col("key").isNotNull()).select(
        "key", F.ceil(F.col("rows") / HOT).alias("salts")))
    scratch.drop(per_key)
    parts, buckets = -(-size // PART) or 1, -(-size // BUCKET) or 1
    mark = F.xxhash64("text")
    drawn = F.pmod(F.xxhash64(F.lit(17), "key"), F.lit(1 << 30)) / float(1 << 30) < share
    rows = read.select("key", "text", mark.alias("mark"), drawn.alias("drawn"))
    if hot.isEmpty():
        salted, asked = rows.withColumn("salt", F.lit(0).cast("long")), wanted.withColumn("salt", F.lit(0).cast("long"))
    else:
        salted = rows.join(hot, "key", "left").withColumn("salt", F.coalesce(F.pmod("mark", "salts"), F.lit(0).cast("long"))).drop("salts")
        asked = wanted.join(hot, "key", "left").select("key", F.explode(F.sequence(
            F.lit(0).cast("long"), F.coalesce("salts", F.lit(1)) - 1)).alias("salt"))
    place = F.pmod(F.xxhash64("key", "salt"), F.lit(parts)).cast("long")
    texts = salted.select(F.when(F.col("key").isNull(), F.pmod("mark", F.lit(parts))).otherwise(place).alias("part"),
                          F.lit(3).alias("kind"), "key", "text", "mark", "drawn")
    targets = asked.select(place.alias("part"), F.lit(0).alias("kind"), "key")

    def gathered(**looked: DataFrame) -> DataFrame:
        """Rows of all parts: their targets, what has been looked up for them, their texts."""
        out = texts.unionByName(targets, allowMissingColumns=True)
        for number, name in enumerate(("words", "pairs"), 1):
            found = looked.get(name)
            if found is None:
                found = spark.createDataFrame([], SUMMED)
            out = out.unionByName(found.filter("part IS NOT NULL").select(
                "part", F.lit(number).alias("kind"), "bucket", "t", "b", "n"), allowMissingColumns=True)
        return out.repartition("part").sortWithinPartitions("part", "kind", "bucket")

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts_of(batches):
            words, at = part.distinct_words()
            yield from part.blobs(words, part.counts(at, len(words)), buckets)

    def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts_of(batches):
            keys, at = part.distinct_pairs(part.mapped(seen)[0])
            yield from part.blobs(keys, part.counts(at, len(keys)), buckets)

    words = scratch.settle(totals(gathered().mapInArrow(lean(count_words), COUNTED), seen))
    sums = words.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("known", "unknown_t", "unknown_b")]).first()
    began = rows.select("key", "drawn").join(wanted.withColumn("is_target", F.lit(True)), "key", "left").agg(
        F.count_if("is_target").alias("t"), F.count_if("drawn").alias("b")).first()
    pairs = scratch.settle(totals(gathered(words=words).mapInArrow(lean(count_pairs), COUNTED), least))
    v, key_type = float(sums["known"] + 2), to_arrow_type(docs.schema[key].dataType)
    rest = ((sums["unknown_t"], began["t"]), (sums["unknown_b"], began["b"]))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts_of(batches):
            own, at, known = part.mapped(seen)
            keys, pair = part.distinct_pairs(own)
            pair_totals = joined(part.pairs, len(keys))
            heard = pair_totals[0] + pair_totals[1] >= least
            n = len(part.sizes)
            # The word before each word: its place among the part's words, then UNKNOWN, then BEGIN.
            unknown, begin = len(known), len(known) + 1
            here = np.where(known[at], at, unknown)
            before = np.empty_like(here)
            before[1:] = here[:-1]
            before[(np.cumsum(part.sizes) - part.sizes)[part.sizes > 0]] = begin
            # How often each word's pair, and the word before it, stand in its own text.
            _, back, times = np.unique(part.text * len(keys) + pair, return_inverse=True, return_counts=True)
            own_pairs = times[back]
            spots, times = np.unique(part.text * begin + here, return_counts=True)
            asked = np.searchsorted(spots, part.text * begin + before).clip(max=max(len(spots) - 1, 0))
            own_words = np.where(before == begin, 1, times[asked]) if len(spots) else before
            losses = []
            for side in (0, 1):
                after = np.concatenate([part.word_totals[side], rest[side]])[before]
                both = np.where(heard, pair_totals[side], 0)[pair]
                for out in (0, 1):
                    less = np.minimum(both, own_pairs) if out else 0
                    fewer = np.minimum(after, own_words) if out else 0
                    loss = np.log(after - fewer + alpha * v) - np.log(both - less + alpha)
                    losses.append(np.bincount(part.text, weights=loss, minlength=n))
            row = part.text_of_row
            size_of = part.sizes[row]
            lt, lb = (np.where(flag & leave_out, losses[2 * k + 1][row], losses[2 * k][row]) / np.maximum(size_of, 1)
                      for k, flag in enumerate((part.is_target, part.is_drawn)))
            names = pa.array([r[0] for r in part.rows], key_type)
            for low in range(0, len(row), 65_536):
                s = slice(low, low + 65_536)
                yield pa.RecordBatch.from_arrays([names[s], *(pa.array(c[s]) for c in (size_of, lt, lb, lt - lb))],
                                                 ["key", "n_tokens", "loss_target", "loss_background", "loss_difference"])

    scratch.keep(words, pairs, hot)
    return gathered(words=words, pairs=pairs).mapInArrow(
        lean(judge), f"key {kind}, n_tokens bigint, loss_target double, loss_background double, loss_difference double").withColumnRenamed("key", key)
