"""Token counts from pre-token frequencies, without token ids.

A text is cut into pre-tokens, which no piece of the vocabulary crosses. Pre-tokens are counted over
the whole corpus; each distinct one is encoded once; a document's count is the sum over its
pre-tokens. The most frequent pre-tokens (at most ``head``, so their table has a fixed bound) travel
with each task as a dictionary and cover most occurrences; all others go through a join with
the table of distinct pre-tokens. Both ways give the same count, so where the border lies changes
nothing but the size of the shuffle.

Here a pre-token is a run of spaces (or U+2581, which means the same to the library) and what
follows up to the next run. The library puts one space before a text, so the first run has at
least that one.

Defined results: null and empty texts have no tokens and no bytes; repeated rows and null ids are
rows like any other; an empty table gives no rows. Only the id and text columns are read.
"""

from __future__ import annotations

import functools
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import slices, stored

PIECES = regex.compile("[ ▁]+[^ ▁]*")
#: Distinct pre-tokens that a task holds before it hands their counts on.
HELD = 200_000


@functools.lru_cache(maxsize=2)
def processor(path: str):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    crossing = [p for p in map(model.id_to_piece, range(model.get_piece_size()))
                if "▁" in p.lstrip("▁")]
    if crossing:
        raise ValueError(f"pieces that go over a space: {crossing[:3]}")
    return model


def pre_tokens(text: str) -> list[str]:
    return PIECES.findall(" " + text) if text else []


def piece_counts(path: str, tokens: list[str]) -> list[int]:
    """Tokens of each pre-token; the library adds back the one space taken off. It adds none to an
    empty text, so a last single space is counted here."""
    found = processor(path).encode([t[1:] for t in tokens], num_threads=1)
    return [len(ids) or 1 for ids in found]


def frequencies(docs: DataFrame, text: str = "text") -> DataFrame:
    """piece, n: how often each pre-token occurs in the whole table."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def hand_on() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.string()), pa.array(held.values(), pa.int64())],
                names=["piece", "n"])
            held.clear()
            return out

        for batch in batches:
            for value in batch["text"]:
                held.update(pre_tokens(value.as_py() or ""))
                if len(held) >= HELD:
                    yield hand_on()
        yield hand_on()

    return docs.select(F.col(text).alias("text")).mapInArrow(count, "piece string, n bigint") \
        .groupBy("piece").agg(F.sum("n").alias("n"))


def counted(docs: DataFrame, path: str, head: int = 200_000, doc_id: str = "doc_id",
            text: str = "text") -> DataFrame:
    """doc_id, n_bytes and n_tokens for every row of ``docs``."""
    spark = docs.sparkSession
    distinct = stored(frequencies(docs, text), "token-pieces")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch["piece"], pa.array(piece_counts(path, batch["piece"].to_pylist()),
                                          pa.int32())], names=["piece", "tokens"])

    pieces = distinct.select("piece").mapInArrow(encode, "piece string, tokens int")
    frequent = distinct.orderBy(F.desc("n"), "piece").limit(head).select("piece").mapInArrow(
        encode, "piece string, tokens int").toArrow()
    known = spark.sparkContext.broadcast(
        dict(zip(frequent["piece"].to_pylist(), frequent["tokens"].to_pylist())))

    kind = docs.select(F.col(doc_id)).schema[0].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The row's number: its task and place. A task that runs again reads the same rows.
        row, table = TaskContext.get().partitionId() << 40, known.value
        for batch in slices(batches):
            ids, numbers, sizes, sums, pieces, times = [], [], [], [], [], []
            for key, value in zip(batch["doc_id"].to_pylist(), batch["text"]):
                content = value.as_py() or ""
                total, rest = 0, []
                for piece in pre_tokens(content):
                    n = table.get(piece)
                    if n is None:
                        rest.append(piece)
                    else:
                        total += n
                row += 1
                ids.append(key)
                numbers.append(row)
                sizes.append(len(content.encode()))
                sums.append(total)
                # No pre-token begins with another sign than a space: this one finds no partner.
                pieces.append(f"#{row}")
                times.append(0)
                for piece, n in Counter(rest).items():
                    ids.append(None)
                    numbers.append(row)
                    sizes.append(None)
                    sums.append(None)
                    pieces.append(piece)
                    times.append(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, batch["doc_id"].type), pa.array(numbers, pa.int64()),
                 pa.array(sizes, pa.int64()), pa.array(sums, pa.int64()),
                 pa.array(pieces, pa.string()), pa.array(times, pa.int32())],
                names=["doc_id", "row", "n_bytes", "known", "piece", "times"])

    parts = rows.mapInArrow(
        split, f"doc_id {kind}, row bigint, n_bytes bigint, known bigint, piece string, times int")
    summed = parts.join(pieces, "piece", "left").groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_bytes").alias("n_bytes"),
        F.sum(F.coalesce("known", F.lit(0)) + F.coalesce(
            F.col("times").cast("long") * F.col("tokens"), F.lit(0))).alias("n_tokens"))
    return summed.select("doc_id", "n_bytes", "n_tokens")
