"""Vectors as short codes: integer product quantisation by a dual-tree Lloyd.

Components become integers floor(1024 * x). A vector is cut into consecutive parts; each part
position has a codebook of its own, and a code is the index of the nearest entry for each part.

Rows are gathered into blocks of at most :data:`BLOCK` vectors, and each block stores, for every
position, the order of its parts in a balanced k-d tree: the tree is built once and serves all
rounds. A round walks a block's part tree against a tree over the codebook's entries:

1. Of the entry nodes that are left for a part node, those whose least squared distance to its box
   is over the smallest greatest distance of any of them are pruned: no part below can choose them.
2. If one entry is left, the whole node is assigned to it by its cached sum and count.
3. Otherwise both trees are descended; a leaf that is still uncertain compares its parts with the
   entries left by exact integer distances, ties to the lower index.

A task adds the sums of its blocks up before anything is shuffled, so a round moves one row per
task, position and entry, and the driver receives positions * entries rows: both bounds are
parameters. Blocks are read, never moved; no key gathers rows.

Defined results: rows whose vector is null or has null or non-finite components are dropped, and so
are vectors of another length than the first kept one (by id, null ids last, then by components).
Repeated ids are rows of their own; where they tie for a first codebook the smaller components come
first. With fewer rows than entries the codebook is that much shorter. A length that the number of
parts does not divide is cut at floor(i * length / parts). Ids and labels may be null. An empty
table gives no rows. Components so large that squared distances leave 64 bits are an error. Only
the id, vector and label columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import stored

#: Vectors of a block, parts of a leaf of its trees.
BLOCK, LEAF = 4096, 128


# --- trees ----------------------------------------------------------------------------


def leaf_starts(n: int, leaf: int) -> np.ndarray:
    """Borders of the leaves of a balanced tree over ``n`` points: a power of two of leaves."""
    leaves = 1
    while leaves * leaf < n:
        leaves *= 2
    return np.arange(leaves + 1) * n // leaves


def tree_order(points: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The order of points in the tree: each node is cut along its widest side."""
    order = np.arange(len(points))
    todo = [(0, len(starts) - 1)]
    while todo:
        a, b = todo.pop()
        if b - a < 2:
            continue
        middle = (a + b) // 2
        lo, hi = starts[a], starts[b]
        held = points[order[lo:hi]]
        if len(held) > 1 and held.shape[1]:
            side = int(np.argmax(held.max(0) - held.min(0)))
            cut = np.argsort(held[:, side], kind="stable")
            order[lo:hi] = order[lo:hi][cut]
        todo += [(a, middle), (middle, b)]
    return order


class Tree:
    """Boxes of all nodes over ordered points; node i has the children 2 i + 1 and 2 i + 2."""

    def __init__(self, points: np.ndarray, starts: np.ndarray):
        """``points`` in tree order. No leaf may be empty."""
        self.points, leaves = points, len(starts) - 1
        level = (np.minimum.reduceat(points, starts[:-1], 0),
                 np.maximum.reduceat(points, starts[:-1], 0), starts[:-1], starts[1:])
        levels = [level]
        while len(level[0]) > 1:
            low, high, first, last = level
            level = (np.minimum(low[::2], low[1::2]), np.maximum(high[::2], high[1::2]),
                     first[::2], last[1::2])
            levels.append(level)
        self.low, self.high, self.first, self.last = (
            np.concatenate(column) for column in zip(*reversed(levels)))
        self.inner = leaves - 1  # nodes from here on are leaves


class Codebook:
    """The entries of one position and the tree over them, down to single entries."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        starts = leaf_starts(len(entries), 1)
        # A power of two of leaves: the last entry is repeated, which changes no nearest entry.
        self.index = np.minimum(np.arange(len(starts) - 1), len(entries) - 1)
        ordered = tree_order(entries[self.index], np.arange(len(starts)))
        self.index = self.index[ordered]
        self.tree = Tree(entries[self.index], np.arange(len(starts)))


def distances(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances, one row for each point."""
    top = max(int(np.abs(points).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if 4 * max(1, points.shape[1]) * top * top < 1 << 53:  # every sum is an exact double
        p, e = points.astype(np.float64), entries.astype(np.float64)
        found = (p * p).sum(1)[:, None] + (e * e).sum(1)[None, :] - 2 * (p @ e.T)
        return found.astype(np.int64)
    return np.stack([((points - e) ** 2).sum(1) for e in entries], 1)


def nearest(points: np.ndarray, starts: np.ndarray, book: Codebook,
            ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For parts in tree order: each one's entry, and every entry's sum of parts and their number."""
    tree, entries, goal = Tree(points, starts), book.tree, book.entries
    codes = np.zeros(len(points), np.int64)
    sums = np.zeros(goal.shape, np.int64)
    counts = np.zeros(len(goal), np.int64)
    running = np.zeros((len(points) + 1, points.shape[1]), np.int64)
    np.cumsum(points, 0, out=running[1:])
    todo = [(0, np.zeros(1, np.int64))]
    while todo:
        node, left = todo.pop()
        low, high = tree.low[node], tree.high[node]
        a, b = tree.first[node], tree.last[node]
        e_low, e_high = entries.low[left], entries.high[left]
        gap = np.maximum(0, np.maximum(e_low - high, low - e_high))
        reach = np.maximum(e_high - low, high - e_low)
        left = left[(gap * gap).sum(1) <= (reach * reach).sum(1).min()]
        single = left[left >= entries.inner]
        if len(single) == len(left):
            found = np.unique(book.index[single - entries.inner])
            if len(found) == 1:
                codes[a:b] = found[0]
                sums[found[0]] += running[b] - running[a]
                counts[found[0]] += b - a
                continue
        if node >= tree.inner:
            while len(single) < len(left):  # down to entries
                deeper = left[left < entries.inner]
                left = np.concatenate([single, 2 * deeper + 1, 2 * deeper + 2])
                single = left[left >= entries.inner]
            found = np.unique(book.index[left - entries.inner])
            best = found[np.argmin(distances(points[a:b], goal[found]), 1)]
            codes[a:b] = best
            np.add.at(sums, best, points[a:b])
            counts += np.bincount(best, minlength=len(goal))
            continue
        deeper = left[left < entries.inner]
        left = np.concatenate([single, 2 * deeper + 1, 2 * deeper + 2])
        todo += [(2 * node + 1, left), (2 * node + 2, left)]
    return codes, sums, counts


# --- blocks ---------------------------------------------------------------------------


def kept(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding",
         label: str = "label") -> DataFrame:
    """vec_id, label and vec of the rows whose components are all finite numbers."""
    fine = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (
        F.abs(x) < F.lit(float("inf"))))
    return vectors.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"),
                          F.col(vector).cast("array<double>").alias("vec")).filter(
        F.col("vec").isNotNull() & fine)


def whole_numbers(vec: np.ndarray) -> np.ndarray:
    scaled = np.floor(vec * 1024.0)
    top = float(np.abs(scaled).max(initial=0.0))
    if 4.0 * max(1, scaled.shape[-1]) * top * top >= 2.0 ** 62:
        raise ValueError(f"a component of {top / 1024} is too large for exact distances")
    return scaled.astype(np.int64)


def borders(length: int, parts: int) -> list[int]:
    return [i * length // parts for i in range(parts + 1)]


def blocks(rows: DataFrame, length: int, parts: int) -> DataFrame:
    """Rows of at most :data:`BLOCK` vectors: ids, labels, integers, and each position's order."""
    cut = borders(length, parts)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                flat = part["vec"].flatten().to_numpy(zero_copy_only=False)
                whole = whole_numbers(flat.reshape(part.num_rows, length))
                starts = leaf_starts(part.num_rows, LEAF)
                orders = [tree_order(whole[:, a:b], starts).astype(np.int32)
                          for a, b in zip(cut, cut[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part["vec_id"].to_pylist()], pa.list_(part["vec_id"].type)),
                     pa.array([part["label"].to_pylist()], pa.list_(part["label"].type)),
                     pa.array([whole.astype(np.int32).tobytes() if np.abs(whole).max(initial=0)
                               < 1 << 31 else whole.tobytes()], pa.binary()),
                     pa.array([np.concatenate(orders).tobytes()], pa.binary())],
                    names=["ids", "labels", "whole", "orders"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.filter(F.size("vec") == length).mapInArrow(
        gather, f"ids array<{kinds['vec_id']}>, labels array<{kinds['label']}>, "
                "whole binary, orders binary")


def opened(row: dict, n: int, length: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """A block's integers and, by position, the tree order of its rows."""
    size = len(row["whole"]) // max(1, n * length)
    whole = np.frombuffer(row["whole"], np.int32 if size == 4 else np.int64)
    return (whole.astype(np.int64).reshape(n, length),
            np.frombuffer(row["orders"], np.int32).reshape(parts, n))


# --- rounds ---------------------------------------------------------------------------


def first_books(rows: DataFrame, parts: int, entries: int) -> list[np.ndarray]:
    """The parts of the smallest ids; what comes to the driver is ``entries`` vectors."""
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "vec").limit(1).collect()
    if not first:
        return []
    length = len(first[0].vec)
    chosen = rows.filter(F.size("vec") == length).orderBy(
        F.col("vec_id").asc_nulls_last(), "vec").limit(entries).collect()
    whole = whole_numbers(np.array([r.vec for r in chosen], np.float64).reshape(-1, length))
    cut = borders(length, parts)
    return [whole[:, a:b] for a, b in zip(cut, cut[1:])]


def moved(held: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """One round: every entry becomes the floored mean of its parts; unused entries stay."""
    parts, length = len(books), sum(b.shape[1] for b in books)
    cut = borders(length, parts)
    wide = max(b.shape[1] for b in books)
    known = held.sparkSession.sparkContext.broadcast(books)  # parts * entries rows

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        goal = [Codebook(b) for b in known.value]
        sums = [np.zeros(b.shape, np.int64) for b in known.value]
        counts = [np.zeros(len(b), np.int64) for b in known.value]
        for batch in batches:
            for row in batch.to_pylist():
                whole, orders = opened(row, row["n"], length, parts)
                starts = leaf_starts(row["n"], LEAF)
                for p in range(parts):
                    _, more, times = nearest(whole[orders[p], cut[p]:cut[p + 1]], starts, goal[p])
                    sums[p] += more
                    counts[p] += times
        for p in range(parts):
            used = np.flatnonzero(counts[p])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(used), p), pa.int32()), pa.array(used, pa.int32()),
                 pa.array(counts[p][used], pa.int64()),
                 pa.array(list(sums[p][used]), pa.list_(pa.int64()))],
                names=["position", "entry", "n", "sums"])

    found = held.select(F.size("ids").alias("n"), "whole", "orders").mapInArrow(
        assign, "position int, entry int, n bigint, sums array<bigint>")
    added = found.groupBy("position", "entry").agg(
        F.sum("n").alias("n"),
        *(F.sum(F.get("sums", F.lit(i)).cast("decimal(38,0)")).alias(f"s{i}")
          for i in range(wide))).collect()
    known.unpersist()
    books = [b.copy() for b in books]
    for row in added:
        book = books[row.position]
        book[row.entry] = [int(row[f"s{i}"]) // row.n for i in range(book.shape[1])]
    return books


def coded(held: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """vec_id, label, codes and error of every row of the blocks."""
    parts, length = len(books), sum(b.shape[1] for b in books)
    cut = borders(length, parts)
    known = held.sparkSession.sparkContext.broadcast(books)
    kinds = {f.name: f.dataType.elementType.simpleString() for f in held.schema
             if f.name in ("ids", "labels")}

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        goal = [Codebook(b) for b in known.value]
        for batch in batches:
            for row in batch.to_pylist():
                n = row["n"]
                whole, orders = opened(row, n, length, parts)
                starts = leaf_starts(n, LEAF)
                codes, error = np.zeros((n, parts), np.int64), np.zeros(n, np.int64)
                for p in range(parts):
                    chosen, _, _ = nearest(whole[orders[p], cut[p]:cut[p + 1]], starts, goal[p])
                    codes[orders[p], p] = chosen
                    gap = whole[:, cut[p]:cut[p + 1]] - known.value[p][codes[:, p]]
                    error += (gap * gap).sum(1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["ids"], batch["ids"].type.value_type),
                     pa.array(row["labels"], batch["labels"].type.value_type),
                     pa.array(list(codes), pa.list_(pa.int64())), pa.array(error, pa.int64())],
                    names=["vec_id", "label", "codes", "error"])

    return held.select("ids", "labels", F.size("ids").alias("n"), "whole", "orders").mapInArrow(
        assign, f"vec_id {kinds['ids']}, label {kinds['labels']}, codes array<bigint>, "
                "error bigint")


def compressed(vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4,
               vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
               ) -> tuple[DataFrame, list[np.ndarray]]:
    """(vec_id, label, codes, error) of every kept row, and the final codebooks by position."""
    rows = kept(vectors, vec_id, vector, label)
    books = first_books(rows, parts, entries)
    if not books:
        return rows.limit(0).select("vec_id", "label", F.array().cast("array<bigint>").alias(
            "codes"), F.lit(0).cast("long").alias("error")), []
    held = stored(blocks(rows, sum(b.shape[1] for b in books), parts), "vector-blocks")
    for _ in range(rounds):
        books = moved(held, books)
    return coded(held, books), books


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all entries' components by position, entry and place."""
    return hashlib.sha256(",".join(
        str(x) for book in books for x in book.ravel().tolist()).encode()).hexdigest()


def label_errors(codes: DataFrame) -> DataFrame:
    """Rows with ``label_error``, the error summed over the rows of a label. One row per label and
    task is shuffled."""
    by_label = codes.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed(
        "label", "_label")
    return codes.join(by_label, F.col("label").eqNullSafe(F.col("_label"))).drop("_label")
