"""Benchmark decontamination by greedy string tiling.

Texts are sequences of normalised tokens (letters and digits, case folded). A document and a
benchmark item are compared when they share seeds (runs of ``least`` tokens) that together touch
enough of the item; then the longest common runs that overlap no earlier one are marked again and
again, found by running Karp-Rabin with falling lengths, until none of ``least`` tokens is left.
The share of the item's tokens under tiles decides, so a passage whose sentences were moved about
is caught like one copied straight.

The benchmark is taken in blocks of at most ``block_tokens`` tokens; a block's seed index is the
only thing broadcast, so its size has a fixed bound, and a larger benchmark means more blocks. Each
document is judged in its own task, however many documents share an item.

Defined results: null and empty texts match nothing, and items without ``least`` tokens cannot be
matched; repeated items and rows are judged one by one, null ids as well; empty tables give no
matches. Rows travel as one struct, so no column name can clash.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import slices

NOISE = regex.compile(r"[^\p{L}\p{M}\p{N}]+")
FACTOR = np.uint64(0x9E3779B97F4A7C15)
MATCH = "array<struct<item_id:bigint,coverage:double,n_tiles:int,n_tokens:int>>"


class _Codes(dict):
    """64-bit codes of words as they stand; 0 for words without a letter or digit."""

    def __missing__(self, word: str) -> int:
        if len(self) >= 300_000:
            self.clear()
        token = NOISE.sub("", word.casefold())
        self[word] = code = (xxhash.xxh3_64_intdigest(token) or 1) if token else 0
        return code


@functools.cache
def codes() -> _Codes:
    return _Codes()


def tokens(text: str | None) -> np.ndarray:
    words = (text or "").split()
    found = np.fromiter(map(codes().__getitem__, words), np.uint64, len(words))
    return found[found != 0]


def seeds(sequence: np.ndarray, least: int) -> np.ndarray:
    """A hash of the run of ``least`` tokens at every place."""
    n = max(0, len(sequence) - least + 1)
    out = np.zeros(n, np.uint64)
    for k in range(least):
        out = out * FACTOR + sequence[k:k + n]
    out ^= out >> np.uint64(29)
    return out * FACTOR


class Index:
    """The seeds of a block of items: sorted hashes, and the (item, place) of each."""

    def __init__(self, items: list[tuple[int | None, str | None]], least: int):
        self.ids = [item for item, _ in items]
        self.tokens = [tokens(text) for _, text in items]
        each = [seeds(t, least) for t in self.tokens]
        hashes = np.concatenate([np.empty(0, np.uint64), *each])
        owner = np.repeat(np.arange(len(each)), np.array([len(e) for e in each], np.int64))
        place = np.concatenate([np.empty(0, np.int64), *[np.arange(len(e)) for e in each]])
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.owner, self.place = hashes[order], owner[order], place[order]
        self.near = np.zeros(1 << 20, bool)  # a first look, by 20 bits of the hash
        self.near[self.hashes >> np.uint64(44)] = True

    def shared(self, found: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(item, places in the text, places in the item) of the shared seeds, by item."""
        at = np.flatnonzero(self.near[found >> np.uint64(44)])
        low = np.searchsorted(self.hashes, found[at], "left")
        high = np.searchsorted(self.hashes, found[at], "right")
        times = high - low
        if not times.any():
            return
        start = np.repeat(low - np.concatenate([[0], np.cumsum(times)[:-1]]), times)
        entry = start + np.arange(times.sum())
        here, item, there = np.repeat(at, times), self.owner[entry], self.place[entry]
        order = np.argsort(item, kind="stable")
        here, item, there = here[order], item[order], there[order]
        cuts = np.flatnonzero(np.diff(item)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(item)]):
            yield int(item[a]), here[a:b], there[a:b]


def tiles(text: list[int], item: list[int], least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (place in the text, place in the item, length). Search lengths fall
    from the longest possible; a match longer than the search length raises it again. Places hold
    a token's code, or None where nothing may match."""
    used_text, used_item = [False] * len(text), [False] * len(item)
    out: list[tuple[int, int, int]] = []
    length = max(least, min(len(text), len(item)))
    while True:
        longest, matches = _matches(text, item, used_text, used_item, length)
        if longest > 2 * length:
            length = longest
            continue
        for n, i, j in sorted(matches, key=lambda m: (-m[0], m[1], m[2])):
            if not any(used_text[i:i + n]) and not any(used_item[j:j + n]):
                used_text[i:i + n] = used_item[j:j + n] = [True] * n
                out.append((i, j, n))
        if length <= least:
            # Parts of matches that were overlapped may still be long enough.
            if not matches:
                return out
            continue
        length = max(least, length // 2)


def _matches(text, item, used_text, used_item, length):
    """All maximal matches of at least ``length`` tokens between unmarked places, by running
    Karp-Rabin hashes of that length, each confirmed token by token."""
    table: dict[int, list[int]] = {}
    for j, h in _windows(item, used_item, length):
        table.setdefault(h, []).append(j)
    longest, found = 0, []
    for i, h in _windows(text, used_text, length):
        for j in table.get(h, ()):
            if (i and j and not used_text[i - 1] and not used_item[j - 1]
                    and text[i - 1] is not None and text[i - 1] == item[j - 1]):
                continue  # part of the match that begins one place before
            n = 0
            while (i + n < len(text) and j + n < len(item) and text[i + n] == item[j + n]
                   and not used_text[i + n] and not used_item[j + n]):
                n += 1
            if n >= length:
                longest = max(longest, n)
                found.append((n, i, j))
    return longest, found


def _windows(tokens_, used, length, base=1_000_003, size=(1 << 61) - 1) -> Iterator[tuple[int, int]]:
    """(place, hash) of each window of unmarked tokens; the hash is updated by one token a step."""
    top, value, held = pow(base, length - 1, size), 0, 0
    for end, token in enumerate(tokens_):
        if token is None or used[end]:
            value = held = 0
            continue
        if held == length:
            value -= tokens_[end - length] * top
            held -= 1
        value = (value * base + token) % size
        held += 1
        if held == length:
            yield end - length + 1, value


def compared(text: np.ndarray, index: Index, least: int, threshold: float) -> list[dict]:
    """The items of a block that the text covers to ``threshold`` or more."""
    out = []
    for item, here, there in index.shared(seeds(text, least)):
        whole = index.tokens[item]
        touched = np.zeros(len(whole), bool)
        for k in range(least):
            touched[there + k] = True
        if touched.mean() < threshold:  # tiles cannot reach further than their seeds
            continue
        # Only places under a seed can be tiled; one gap stands for all between them.
        places = np.unique((here[:, None] + np.arange(least)).ravel())
        part, last = [], None
        for p in places.tolist():
            if last is not None and p != last + 1:
                part.append(None)
            part.append(int(text[p]))
            last = p
        found = tiles(part, whole.tolist(), least)
        coverage = sum(n for _, _, n in found) / len(whole)
        if coverage >= threshold:
            out.append({"item_id": index.ids[item], "coverage": round(coverage, 6),
                        "n_tiles": len(found), "n_tokens": len(whole)})
    return out


def blocks(rows: Iterable[tuple[int | None, str | None]], size: int
           ) -> Iterator[list[tuple[int | None, str | None]]]:
    """Items in blocks of at most ``size`` tokens (an item longer than that is its own block)."""
    block, held = [], 0
    for row in rows:
        n = len((row[1] or "").split())
        if block and held + n > size:
            yield block
            block, held = [], 0
        block.append(row)
        held += n
    yield block


def matched(docs: DataFrame, benchmark: DataFrame, least: int = 4, threshold: float = 0.6,
            block_tokens: int = 500_000, text: str = "text", item_id: str = "item_id",
            item_text: str = "text") -> DataFrame:
    """``row`` (the whole row of ``docs``) and ``matches``, one for every row."""
    context = docs.sparkSession.sparkContext
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col(text).alias("text"), F.array().cast(MATCH).alias("matches"))
    items = benchmark.select(F.col(item_id).cast("long"), F.col(item_text))
    for block in blocks(map(tuple, items.toLocalIterator()), block_tokens):
        rows = rows.mapInArrow(_judge(context.broadcast(Index(block, least)), least, threshold),
                               rows.schema)
    return rows.select("row", "matches")


def _judge(shared: Broadcast, least: int, threshold: float):
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in slices(batches):
            before = batch["matches"]
            found = [[*was.as_py(), *compared(tokens(t.as_py()), index, least, threshold)]
                     for was, t in zip(before, batch["text"])]
            yield pa.RecordBatch.from_arrays(
                [batch["row"], batch["text"], pa.array(found, before.type)],
                names=["row", "text", "matches"])
        codes().clear()  # the worker goes on to other stages
    return judge


def contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id",
                 **options) -> DataFrame:
    """One row for each document and item it contains: doc_id, item_id, coverage, n_tiles,
    n_tokens."""
    return matched(docs, benchmark, **options).select(
        F.col(f"row.{doc_id}").alias("doc_id"), F.explode("matches").alias("m")).select(
        "doc_id", "m.*")


def clean_rows(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that contain no item, with all their columns."""
    return matched(docs, benchmark, **options).where(F.size("matches") == 0).select("row.*")
