"""Substring dedup by prefix-partitioned suffix trees over words.

A window is ``length`` words; it is a repeat if the same words also start at an earlier place
(smaller document, or same document and earlier word). Suffixes that can share a window are brought
together by prefixes, and each group's suffix tree, cut at depth ``length``, shows by its deep
nodes which windows are the same:

1. *Anchors.* In each window the ``prefix``-word run with the least code is its anchor (the first
   of equal ones). Equal windows have equal anchors at the same place, so only suffixes at anchors
   need to meet: one word in seven. An anchor stands for the range of windows it was chosen by.
2. *Prefix groups.* Anchors are dealt by the code of their prefix. Anchors whose whole context is
   the same are one leaf: all but the earliest repeat it, which needs no text. A task first does
   this among its own documents, so that however common a passage is, each task sends it once.
   Prefixes with one leaf left have no more repeats and end here.
3. *Subtrees.* For the other leaves the words around them are fetched. A prefix with at most
   ``group`` leaves is one group, and its tree is built from the prefix down, word by word; a
   larger one goes to prefixes of whole windows at once, where a group is the earliest of equal
   windows by a 128-bit hash, found by an aggregate that combines before the shuffle.

Codes only propose: in a subtree words are compared as they stand; in step 2 the two 64-bit codes
(of the prefix and of the context) must both agree, and for hot prefixes the hash of the window.

Defined results: null and empty texts have no words; texts under ``length`` words have no window
and stay whole. Documents are ordered by (id, code of the text), null ids first; rows equal in both
are one document whose rows all get the same result. Empty tables give no rows. Only the id and
text columns are read; in :func:`deduplicated_rows` rows travel as one struct, so no name clashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import partitions, slices, stored, text_of
from larder.llm.word_arrays import BASE, INVERSE, Words, mixed, portions, powers, runs

LENGTH, PREFIX, GROUP = 20, 6, 2_000
#: Bytes of text after which a task hands on what it has combined, and leaves in a subtree batch.
COMBINED, LEAVES = 16 << 20, 40_000

ANCHOR = "local boolean, h bigint, c bigint, doc bigint, tag bigint, at int, lo int, hi int"
RESOLVED = "many int, h bigint, doc bigint, tag bigint, at int, lo int, hi int"


def keyed(docs: DataFrame, doc_id: str, text: str, *more) -> DataFrame:
    """doc and tag, the order and key of documents, and the text."""
    return docs.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(-(1 << 63))).alias("doc"),
        F.xxhash64(text_of(text)).alias("tag"), F.col(text).alias("text"), *more)


# ---- 1. anchors ------------------------------------------------------------------------------


def anchors_of(words: Words, first: int, last: int, length: int, prefix: int) -> tuple:
    """Of one text: places of the anchors, first and last window of each (as distances before it),
    and the codes of prefix and context."""
    codes = words.codes[first:last]
    n = len(codes) - length + 1
    if n < 1:
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),) * 2
    found = runs(codes, prefix)
    width = length - prefix + 1
    chosen = np.lib.stride_tricks.sliding_window_view(found, width).argmin(axis=1) + np.arange(n)
    cut = np.flatnonzero(np.diff(chosen, prepend=-1))
    at = chosen[cut]
    low, high = cut, np.append(cut[1:], n) - 1  # windows low..high have this anchor
    # The context is all words that one of the windows covers.
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * powers(BASE, len(codes)), out=sums[1:])
    context = (sums[high + length] - sums[low]) * powers(INVERSE, len(codes))[low]
    context = mixed(context + np.uint64(31) * (high - low).astype(np.uint64)
                    + np.uint64(1_000_003) * (at - low).astype(np.uint64))
    return at, at - high, at - low, found[at], context


def find_anchors(length: int, prefix: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in slices(batches):
            doc, tag = (batch[c].to_numpy(zero_copy_only=False) for c in ("doc", "tag"))
            for start, words in portions(batch["text"]):
                parts, owner = [], []
                for i in range(len(words.first) - 1):
                    a, b = words.first[i], words.first[i + 1]
                    if b - a >= length:
                        parts.append(anchors_of(words, a, b, length, prefix))
                        owner.append(np.full(len(parts[-1][0]), start + i))
                if parts:
                    at, lo, hi, h, c = map(np.concatenate, zip(*parts))
                    own = np.concatenate(owner)
                    held.append((h.view(np.int64), c.view(np.int64), doc[own], tag[own],
                                 at.astype(np.int32), lo.astype(np.int32), hi.astype(np.int32)))
                size += len(words.data)
                if size >= COMBINED:
                    yield combined(held)
                    held, size = [], 0
        if held:
            yield combined(held)
    return find


def combined(held: list[tuple]) -> pa.RecordBatch:
    """The earliest anchor of each leaf, and the others, which repeat it (``local``)."""
    h, c, doc, tag, at, lo, hi = map(np.concatenate, zip(*held))
    order = np.lexsort((at, tag, doc, c, h))
    h, c, doc, tag, at, lo, hi = (x[order] for x in (h, c, doc, tag, at, lo, hi))
    local, same = followers([h, c], [doc, tag, at])
    names = ["local", "h", "c", "doc", "tag", "at", "lo", "hi"]
    return pa.RecordBatch.from_arrays(
        [pa.array(x[~same]) for x in (local, h, c, doc, tag, at, lo, hi)], names=names)


def followers(key: list[np.ndarray], place: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted rows: which are not the first of their key, and which of those stand at the very
    place of the first (rows of one document read twice are no repeat)."""
    new = np.ones(len(key[0]), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in key])
    head = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
    same = ~new & np.logical_and.reduce([p == p[head] for p in place])
    return ~new, same


# ---- 2. prefix groups --------------------------------------------------------------------------


def resolve(group: int):
    """Rows sorted by (local, h, c, doc, tag, at). Repeats of a leaf get ``many`` 0; the first of
    each leaf gets the number of its prefix's leaves, and is left out if that is 1."""
    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, part in by_key(batches, ["local", "h"], 100_000, ["c"]):
            local, h, c, doc, tag, at, lo, hi = (
                table[n].to_numpy(zero_copy_only=False) for n in
                ("local", "h", "c", "doc", "tag", "at", "lo", "hi"))
            later, same = followers([local, h, c], [doc, tag, at])
            prefix = np.cumsum(~followers([local, h], [doc])[0]) - 1
            many = np.bincount(prefix, ~later)[prefix].astype(np.int32)
            if part:  # more of this prefix than a table holds
                many[:] = group + 1
            many[later | local] = 0
            keep = local | later & ~same | (many > 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[keep]) for x in (many, h, doc, tag, at, lo, hi)],
                names=["many", "h", "doc", "tag", "at", "lo", "hi"])
    return leaves


def by_key(batches: Iterator[pa.RecordBatch], key: list[str], rows: int,
           finer: list[str] | None = None) -> Iterator[tuple[pa.Table, bool]]:
    """Tables of sorted rows that end where the key changes, once ``rows`` rows are held. A key
    with more rows than that is cut where the ``finer`` columns change; its tables hold nothing
    else and come with True."""
    held, n, opened = [], 0, False

    def changes(table: pa.Table, names: list[str]) -> np.ndarray:
        cols = [table[c].to_numpy(zero_copy_only=False) for c in names]
        return np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in cols])) + 1

    def rest() -> Iterator[tuple[pa.Table, bool]]:
        table = pa.Table.from_batches(held).combine_chunks()
        ends = changes(table, key)
        if opened and len(ends):
            yield table.slice(0, int(ends[0])), True
            yield table.slice(int(ends[0])), False
        else:
            yield table, opened

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        n += batch.num_rows
        if n < rows:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        ends = changes(table, key)
        if len(ends):
            if opened:
                yield table.slice(0, int(ends[0])), True
                if len(ends) > 1:
                    yield table.slice(int(ends[0]), int(ends[-1] - ends[0])), False
            else:
                yield table.slice(0, int(ends[-1])), False
            cut, opened = int(ends[-1]), False
        else:
            ends = changes(table, finer) if finer else ends
            cut = int(ends[-1]) if len(ends) else 0
            if cut:
                opened = True
                yield table.slice(0, cut), True
        held, n = table.slice(cut).to_batches(), n - cut
    if n:
        yield from rest()


# ---- 3. subtrees -------------------------------------------------------------------------------


def fetch(length: int, group: int):
    """Of documents with their leaves: one row for each leaf with the words it covers (short), or
    one for each of its windows (``window`` is a 128-bit code)."""
    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in slices(batches, 50):  # a text may have thousands of windows
            cols = {n: [] for n in ("h", "window", "doc", "tag", "at", "lo", "hi", "words")}
            for doc, tag, text, leaves in zip(*(batch[c] for c in ("doc", "tag", "text", "leaves"))):
                words = (text.as_py() or "").encode().split()
                for leaf in leaves.as_py():
                    at, lo, hi = leaf["at"], leaf["lo"], leaf["hi"]
                    if leaf["many"] <= group:
                        spans = [(lo, hi, at - hi, at - lo + length, None)]
                    else:
                        spans = [(o, o, at - o, at - o + length, True) for o in range(lo, hi + 1)]
                    for low, high, a, b, whole in spans:
                        content = b" ".join(words[a:b])
                        cols["h"].append(leaf["h"])
                        cols["window"].append(
                            xxhash.xxh3_128_digest(content) if whole else None)
                        cols["doc"].append(doc.as_py())
                        cols["tag"].append(tag.as_py())
                        cols["at"].append(at)
                        cols["lo"].append(low)
                        cols["hi"].append(high)
                        cols["words"].append(None if whole else content)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols["h"], pa.int64()), pa.array(cols["window"], pa.binary()),
                 pa.array(cols["doc"], pa.int64()), pa.array(cols["tag"], pa.int64()),
                 pa.array(cols["at"], pa.int32()), pa.array(cols["lo"], pa.int32()),
                 pa.array(cols["hi"], pa.int32()), pa.array(cols["words"], pa.binary())],
                names=list(cols))
    return contexts


FETCHED = ("h bigint, window binary, doc bigint, tag bigint, at int, lo int, hi int, "
           "words binary")


def grow(length: int):
    """The subtrees of sorted prefix groups, many at a time: a node is a set of leaves whose words
    agree from the prefix on to some depth. Nodes are split by the next word, level by level, once
    to the right and once to the left of the anchors; a window that begins ``o`` words before its
    anchor ends in the node of (right words to depth length - o, left words to depth o)."""
    def subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, _ in by_key(batches, ["h"], LEAVES):
            doc, tag, at, lo, hi, h = (table[n].to_numpy() for n in
                                       ("doc", "tag", "at", "lo", "hi", "h"))
            # Words left and right of the anchor as numbers, -1 beyond the context.
            ids: dict[bytes, int] = {}
            left = np.full((length, len(at)), -1, np.int64)
            right = np.full((length, len(at)), -1, np.int64)
            for i, content in enumerate(table["words"].to_pylist()):
                own = [ids.setdefault(w, len(ids)) for w in content.split()]
                before = int(hi[i])
                right[:len(own) - before, i] = own[before:]
                if before:
                    left[:before, i] = own[before - 1::-1]
            root = np.unique(h, return_inverse=True)[1]
            rights = list(levels(root, right))
            lefts = list(levels(np.zeros(len(at), np.int64), left))
            for o in range(int(hi.max()) + 1):
                rows = np.flatnonzero((lo <= o) & (o <= hi))
                node = np.unique(np.stack([rights[length - o][rows], lefts[o][rows]]),
                                 axis=1, return_inverse=True)[1].ravel()
                yield repeats(node, doc[rows], tag[rows], at[rows] - o)
    return subtrees


def levels(node: np.ndarray, words: np.ndarray) -> Iterator[np.ndarray]:
    """The node of every leaf at depth 0, 1, 2 ...; ``words[d]`` is the word after depth d."""
    yield node
    for word in words:
        key = node * np.int64(words.max() + 2) + word + 1
        node = np.unique(key, return_inverse=True)[1]
        yield node


def repeats(node: np.ndarray, doc: np.ndarray, tag: np.ndarray, at: np.ndarray) -> pa.RecordBatch:
    """The windows of each deep node that do not stand first, as spans of windows."""
    order = np.lexsort((at, tag, doc, node))
    node, doc, tag, at = node[order], doc[order], tag[order], at[order]
    later, same = followers([node], [doc, tag, at])
    keep = later & ~same
    at = at[keep].astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [pa.array(doc[keep]), pa.array(tag[keep]), pa.array(at), pa.array(at)],
        names=["doc", "tag", "low", "high"])


# ---- the operator ------------------------------------------------------------------------------


def repeated_windows(docs: DataFrame, length: int = LENGTH, prefix: int = PREFIX,
                     group: int = GROUP, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc, tag, low, high: spans of windows (by their first word) that repeat an earlier one."""
    spark = docs.sparkSession
    texts = keyed(docs, doc_id, text)
    deal = partitions(spark)
    dealt = texts.mapInArrow(find_anchors(length, prefix), ANCHOR)
    # Local repeats need no partner: they only pass through, spread over all tasks.
    order = ["local", "h", "c", "doc", "tag", "at"]
    found = stored(dealt.repartition(deal, F.when(F.col("local"), F.xxhash64("doc", "at"))
                                     .otherwise(F.col("h"))).sortWithinPartitions(*order)
                   .mapInArrow(resolve(group), RESOLVED), "substring-anchors")
    span = ["doc", "tag", (F.col("at") - F.col("hi")).alias("low"),
            (F.col("at") - F.col("lo")).alias("high")]
    known = found.where("many = 0").select(*span)
    leaves = found.where("many > 0").groupBy("doc", "tag").agg(
        F.collect_set(F.struct("h", "many", "at", "lo", "hi")).alias("leaves"))
    fetched = stored(texts.join(leaves, ["doc", "tag"]).mapInArrow(
        fetch(length, group), FETCHED), "substring-leaves")
    grown = fetched.where("window IS NULL").repartition(deal, "h").sortWithinPartitions("h") \
        .mapInArrow(grow(length), "doc bigint, tag bigint, low int, high int")
    whole = fetched.where("window IS NOT NULL").select(
        "window", F.struct("doc", "tag", (F.col("at") - F.col("lo")).alias("low")).alias("place"))
    first = whole.groupBy("window").agg(F.min("place").alias("first"))
    deep = whole.join(first, "window").where("place > first").select(
        "place.doc", "place.tag", "place.low", F.col("place.low").alias("high"))
    return known.unionByName(grown).unionByName(deep)


def cut(length: int, name: str):
    """Rows with their spans: the words that no repeated window covers."""
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            totals, removed, words_left, texts_left = [], [], [], []
            for text, spans in zip(batch["row"].field(name), batch["spans"]):
                words = (text.as_py() or "").encode().split()
                left, content = words, text.as_py()
                if spans.is_valid:
                    covered = np.zeros(len(words) + 1, np.int32)
                    low, high = (spans.values.field(n).to_numpy() for n in ("low", "high"))
                    np.add.at(covered, low, 1)
                    np.add.at(covered, high + length, -1)
                    gone = np.cumsum(covered)[:-1] > 0
                    left = [w for w, g in zip(words, gone.tolist()) if not g]
                    content = without(content.encode(), gone)
                totals.append(len(words))
                removed.append(len(words) - len(left))
                words_left.append(b" ".join(left).decode())
                texts_left.append(content)
            yield pa.RecordBatch.from_arrays(
                [batch["row"], pa.array(totals, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(words_left, pa.string()), pa.array(texts_left, pa.string())],
                names=["row", "n_words", "n_removed", "kept_words", "kept_text"])
    return remove


def without(content: bytes, gone: np.ndarray) -> str:
    """A text without the words marked, each with the white space before it."""
    words = Words(content, np.array([0, len(content)]))
    before = np.concatenate([[0], words.stop[:-1]])
    parts = [content[a:b] for a, b in zip(before[~gone].tolist(), words.stop[~gone].tolist())]
    return b"".join(parts).decode().lstrip(" \t\n\x0b\f\r")


def deduplicated(docs: DataFrame, length: int = LENGTH, prefix: int = PREFIX, group: int = GROUP,
                 doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for every row of ``docs``: ``row`` (that row whole), n_words, n_removed,
    ``kept_words`` (the words left, joined by one space) and ``kept_text`` (the text without the
    others; untouched if nothing goes)."""
    spans = repeated_windows(docs, length, prefix, group, doc_id, text).groupBy(
        "doc", "tag").agg(F.collect_set(F.struct("low", "high")).alias("spans"))
    whole = keyed(docs, doc_id, text,
                  F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    joined = whole.join(spans, ["doc", "tag"], "left").select("row", "spans")
    kind = joined.schema["row"].dataType.simpleString()
    return joined.mapInArrow(cut(length, text), f"row {kind}, n_words bigint, n_removed bigint, "
                                          "kept_words string, kept_text string")
