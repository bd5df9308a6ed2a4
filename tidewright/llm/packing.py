"""Packing token streams into windows that hold every source in proportion."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewright.llm.common import lean
from tidewright.session import Scratch

SEQUENCE = 1024
#: Sequences in a window; in each window every source has its share of the tokens.
WINDOW = 64
END = 0

_ENCODERS: dict[str, object] = {}


def encoder(path: str):
    """Encoder of texts to ids for the tokenizer file at `path`, loaded once in a worker.

    Ids are those of `encode(text, add_special_tokens=False)`, so the content of an added token in a text is that token.
    Where the same vocabulary lies beside the file as ranks (`.tiktoken`), texts without such content go by that file:
    the ids are the same and it is about four times as fast.
    """
    if path not in _ENCODERS:
        import base64
        import os

        from tokenizers import Tokenizer

        own = Tokenizer.from_file(path)
        ranks = path.rsplit(".", 1)[0] + ".tiktoken"
        if os.path.exists(ranks):
            import public_tokenizers
            import tiktoken

            with open(ranks, "rb") as lines:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
            added = [t.content for t in own.get_added_tokens_decoder().values()]
            _ENCODERS[path] = lambda text: (own.encode(text, add_special_tokens=False).ids if any(c in text for c in added)
                                            else fast.encode_ordinary(text))
        else:
            _ENCODERS[path] = lambda text: own.encode(text, add_special_tokens=False).ids
    return _ENCODERS[path]


def tokenized(docs: DataFrame, tokenizer: str, key: str, source: str, text: str) -> DataFrame:
    """(key, source, part, before, n, ids): the ids of each row and END, as little-endian bytes of 16 bits
    where they fit and else of 32. `before` counts the ids of the same source earlier in the same task."""

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode_one, part, seen = encoder(tokenizer), TaskContext.get().partitionId(), {}
        for batch in batches:
            for low in range(0, len(batch), 256):
                out = []
                for k, s, t in batch.iloc[low:low + 256].itertuples(index=False):
                    ids = np.array([*encode_one(t), END], dtype=np.uint32)
                    before = seen.get(s, 0)
                    seen[s] = before + len(ids)
                    small = len(ids) == 0 or ids.max() < 1 << 16
                    out.append((k, s, part, before, len(ids), not small,
                                ids.astype("<u2" if small else "<u4").tobytes()))
                yield pd.DataFrame(out, columns=["key", "source", "part", "before", "n", "wide", "ids"]).astype({"key": object})

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("key"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"),
                       F.coalesce(F.col(text), F.lit("")).alias("text")).mapInPandas(
        lean(encode), f"key {kind}, source string, part int, before bigint, n bigint, wide boolean, ids binary")


def pieces(batches: Iterator[pd.DataFrame], sequence: int, window: int) -> Iterator[pd.DataFrame]:
    """Cut the rows of `pack` where their places in the stream do not go on, and at sequence ends.

    With T tokens in all and P(s) those of the sources up to s, the sources up to s have together
    floor(c * P(s) / T) tokens among the first c of the stream, c at a window's end. So source s
    has in every window its share to within one token, and the fraction it is short by is carried to the next.
    """
    size = sequence * window
    for batch in batches:
        out = []
        for key, wide, raw, x, low, high, total in zip(
                batch["key"], batch["wide"], batch["ids"], batch["x"], batch["low"], batch["high"], batch["total"]):
            ids = np.frombuffer(raw, "<u4" if wide else "<u2").astype("<u4")
            n, x, low, high, total = len(ids), int(x), int(low), int(high), int(total)
            windows = -(-total // size)

            def end(w: int) -> int:
                return min(w * size, total)

            def given(w: int) -> int:  # tokens of this source before window w
                return end(w) * high // total - end(w) * low // total

            w, done = min(x * total // ((high - low) * size), windows - 1), 0
            while w > 0 and given(w) > x:
                w -= 1
            while done < n:
                while given(w + 1) <= x + done:
                    w += 1
                ahead = (end(w + 1) * low // total) - (end(w) * low // total)
                at = end(w) + ahead + (x + done - given(w))
                left = min(n - done, given(w + 1) - (x + done))
                while left:
                    length = min(left, sequence - at % sequence)
                    part = ids[done:done + length].tobytes()
                    out.append((key, done, length, zlib.crc32(part), n, at // sequence, at % sequence, w))
                    done, at, left = done + length, at + length, left - length
        yield pd.DataFrame(out, columns=["key", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "window"]
                           ).astype({"key": object})


def pack(docs: DataFrame, tokenizer: str, key: str = "doc_id", source: str = "source", text: str = "text",
         sequence: int = SEQUENCE, window: int = WINDOW) -> DataFrame:
    """Pieces of all rows of `docs`: key, start, length, ids_crc32, doc_tokens, sequence_id, offset, window.

    Every source is a queue, in the order of its tasks and rows. Windows of `window` sequences are
    filled by deficit round-robin: a source may put in its share of all tokens, what it is short of a whole
    token is carried to its next turn, over windows and over the partitions its queue is spread over.
    The turns have a closed form (`pieces`), so a row needs only the number of tokens before it in its
    queue, and no queue, however long, passes through one task. Sources of less than one token a window
    are one queue, the first, so that no turn is ever negative. All queues end together; only the last
    sequence of all can be short.

    Texts are tokenised once; the ids are written with running counts per task and source and read
    again when the sums over tasks, one row for each task and source, are known.

    Null text is empty (one id, END); a null source is a queue named ""; rows that repeat are rows of
    their own; an empty table has no pieces. Other columns are not looked at.
    """
    scratch = Scratch(docs.sparkSession)
    ids = scratch.settle(tokenized(docs, tokenizer, key, source, text))
    sums = ids.groupBy("source", "part").agg(F.sum("n").alias("sum"))
    ahead = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    per_source = sums.groupBy("source").agg(F.sum("sum").alias("all"))
    total = F.sum("all").over(Window.orderBy("source").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    sized = per_source.select("source", "all", total.alias("total")).withColumn(
        "large", F.col("all").cast("decimal(38,0)") * (sequence * window) >= F.col("total"))
    up = Window.orderBy("large", "source").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    small = F.sum(F.when(F.col("large"), 0).otherwise(F.col("all"))).over(
        Window.orderBy("source").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    places = sized.withColumn("high", F.sum("all").over(up)).withColumn("low", F.col("high") - F.col("all")).withColumn("small", small)
    ranges = places.select(
        F.col("source").alias("of"), "total", F.when(F.col("large"), F.col("high")).otherwise(F.col("small")).alias("high"),
        F.when(F.col("large"), F.col("low")).otherwise(0).alias("low"),
        F.when(F.col("large"), 0).otherwise(F.col("low")).alias("earlier"))
    starts = scratch.settle(
        sums.withColumn("skip", F.coalesce(F.sum("sum").over(ahead), F.lit(0)))
        .join(ranges, F.col("source") == F.col("of")).withColumn("skip", F.col("skip") + F.col("earlier"))
        .select(F.col("source").alias("of"), F.col("part").alias("of_part"), "skip", "low", "high", "total"))
    placed = ids.join(starts, (F.col("source") == F.col("of")) & (F.col("part") == F.col("of_part"))).select(
        "key", "wide", "ids", (F.col("skip") + F.col("before")).alias("x"), "low", "high", "total")
    scratch.keep(ids, starts)
    kind = docs.schema[key].dataType.simpleString()
    return placed.mapInPandas(
        lambda batches: pieces(batches, sequence, window),
        f"key {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
        "offset bigint, window bigint").withColumnRenamed("key", key)
