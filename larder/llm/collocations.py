"""Phrases of two to five words that are more than their parts, from stripes.

A *stripe* is a prefix with the counter of the words that follow it. Tasks fill stripes, merging
adds them elementwise, and the merged stripes give all that is needed: an entry is a phrase's count,
the greatest entry of a phrase's own stripe is its best extension to the right, the same entries
grouped by what follows their first word are the extensions to the left.

1. The stripe of the empty prefix: how often every word occurs, and how many words there are.
2. Stripes of single words. A phrase can only be frequent if its words are, so pairs with a word
   below the threshold are left out.
3. Stripes of frequent pairs, counting what follows in one, two and three words, wherever all
   pairs of neighbouring words are frequent.

Between the steps the frequent words or pairs travel as a Bloom filter of a fixed size
(:data:`BITS`, 16 MB). What it lets through by mistake is counted exactly and falls below the
threshold in the end, so it changes the size of the shuffle, never the result.

A prefix that begins at every thousandth word or more often is *hot* (there are at most a thousand):
its stripe is split into :data:`SLOTS` slots by the next word. Stripes are dealt by (language,
prefix, slot) to :data:`BINS` bins for each shuffle partition, and a task sends one row with all its
stripes of a bin. Merging holds one bin at a time, a small share of a partition. Phrases are told apart by their texts; within a megabyte of text
words are told apart by 64-bit codes.

Definitions: A-Z are lower-cased; texts are cut into pieces at ``. , ; : ! ?`` and \\n to \\r, pieces
into words at spaces and tabs. Counts are by language, a null one is ``und``. Null and empty texts
have no words; repeated rows and null ids count like any other; a very long text is worked on in
portions that overlap by four words, so no phrase is lost or counted twice. An empty table gives no
rows. Only the text and language columns are read.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.common import partitions, slices, stored
from larder.llm.word_arrays import BASE, INVERSE, PORTION, mixed, powers

LONGEST = 5
#: Bits of a filter between two steps.
BITS = 1 << 27
#: Merging places of one prefix (a power of two).
SLOTS = 64
#: Entries, and distinct words or prefixes, that a task holds before it hands its stripes on.
HELD, NAMES = 1_000_000, 400_000
#: Bins for each shuffle partition.
BINS = 16
#: A prefix is hot if it begins at one of so many words.
HOT = 1000

CUT = np.zeros(256, bool)
CUT[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
GAP = CUT.copy()
GAP[[0x20, 0x09]] = True
_ENDS = re.compile(rb"[ \t.,;:!?\n-\r]")
_AHEAD = re.compile(rb"(?:[ \t]*[^ \t.,;:!?\n-\r]+){0,%d}" % (LONGEST - 1))


# --- words of texts -------------------------------------------------------------------


def segments(data: bytes, size: int) -> Iterator[tuple[bytes, int]]:
    """(bytes, how many of them are its own): portions of a text that end at a word's end, with the
    next words of the piece behind them."""
    at = 0
    while len(data) - at > size:
        end = _ENDS.search(data, at + size)
        if end is None:
            break
        yield data[at:_AHEAD.match(data, end.start()).end()], end.start() - at
        at = end.start()
    yield data[at:], len(data) - at


class Portion:
    """Words of segments: place, language, code, and whether the next word is in their piece."""

    def __init__(self, parts: list[tuple[str, bytes, int]]):
        """``parts`` are (language, bytes, own bytes)."""
        self.data = b"\n".join(part for _, part, _ in parts)
        begins = np.cumsum([0] + [len(part) + 1 for _, part, _ in parts[:-1]])
        raw = np.frombuffer(self.data, np.uint8)
        word = ~GAP[raw]
        edge = np.diff(word.astype(np.int8), prepend=0, append=0)
        self.start, self.stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        cuts = np.zeros(len(raw) + 1, np.int32)
        np.cumsum(CUT[raw], out=cuts[1:])
        self.linked = cuts[self.stop[:-1]] == cuts[self.start[1:]]
        part = np.searchsorted(begins, self.start, "right") - 1
        own = np.array([n for _, _, n in parts])
        self.own = self.start - begins[part] < own[part]
        self.langs = sorted({lang for lang, _, _ in parts})
        number = {lang: i for i, lang in enumerate(self.langs)}
        self.lang = np.array([number[lang] for lang, _, _ in parts])[part]
        salt = np.array([int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(),
                                        "little") for lang in self.langs], np.uint64)
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(raw)), out=sums[1:])
        shift = powers(INVERSE, len(raw) + 1)
        self.codes = mixed(mixed((sums[self.stop] - sums[self.start]) * shift[self.start])
                           + salt[self.lang])

    def named(self, i: int) -> tuple[str, str]:
        return (self.langs[self.lang[i]],
                self.data[self.start[i]:self.stop[i]].decode())

    def pairs(self) -> np.ndarray:
        """A code of every word and the next."""
        return mixed(self.codes[:-1] * BASE + self.codes[1:])


def portions(batch: pa.RecordBatch, size: int = PORTION) -> Iterator[Portion]:
    """Over an Arrow batch with ``text`` and ``lang``."""
    held, parts = 0, []
    for lang, value in zip(batch["lang"].to_pylist(), batch["text"]):
        if not value.is_valid:
            continue
        for part, own in segments(bytes(value.as_buffer()).lower(), size):
            parts.append((lang, part, own))
            held += len(part)
            if held >= size:
                yield Portion(parts)
                held, parts = 0, []
    if parts:
        yield Portion(parts)


# --- filters --------------------------------------------------------------------------


def probes(codes: np.ndarray) -> list[np.ndarray]:
    step = (codes >> np.uint64(32)) | np.uint64(1)
    return [(codes + np.uint64(i) * step) & np.uint64(BITS - 1) for i in range(3)]


def passes(bits: np.ndarray, codes: np.ndarray) -> np.ndarray:
    found = np.ones(len(codes), bool)
    for place in probes(codes):
        found &= (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return found


def filter_of(phrases: DataFrame, words: int) -> Broadcast:
    """The Bloom filter of all (lang, phrase) of one or two words."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 10_000):
            parts = [(lang, phrase.encode(), len(phrase.encode())) for lang, phrase in zip(
                batch["lang"].to_pylist(), batch["phrase"].to_pylist())]
            if parts:
                portion = Portion(parts)
                codes = portion.codes if words == 1 else portion.pairs()[portion.linked]
                yield pa.RecordBatch.from_arrays([pa.array(
                    np.concatenate(probes(codes)).astype(np.int64))], names=["bit"])

    # Buckets and places count from bit 1.
    bit = F.col("bit") + 1
    rows = phrases.select("lang", "phrase").mapInArrow(places, "bit bigint").groupBy(
        F.bitmap_bucket_number(bit).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits")).toArrow()
    bits = np.zeros(BITS // 8, np.uint8)
    for bucket, part in zip(rows["bucket"].to_pylist(), rows["bits"].to_pylist()):
        at = (bucket - 1) * len(part)
        bits[at:at + len(part)] = np.frombuffer(part, np.uint8)
    return phrases.sparkSession.sparkContext.broadcast(bits)


# --- stripes --------------------------------------------------------------------------

STRIPES = ("bin int, langs array<string>, prefixes array<string>, sizes array<int>, nexts string, "
           "counts array<bigint>")


class Stripes:
    """The stripes a task fills: prefixes of one or two words, and for each the counter of the next
    word, of the next two and so on. What follows a prefix is kept as a trie whose nodes are a
    parent and a word."""

    def __init__(self, prefix: int, depth: int, hot: set[tuple[str, str]], bins: int):
        self.prefix, self.depth, self.hot, self.bins = prefix, depth, hot, bins
        self.clear()

    def clear(self) -> None:
        self.ids: dict[tuple[str, str], int] = {}
        self.slots: list[int] = []
        self.roots: dict[int, int] = {}
        self.is_hot: list[bool] = []
        self.nodes = [{} for _ in range(self.depth - 1)]
        self.held = [[] for _ in range(self.depth)]
        self.size = self.merged = 0

    def word_ids(self, portion: Portion, wanted: np.ndarray) -> np.ndarray:
        """The id of each wanted word, -1 for the others."""
        out = np.full(len(portion.codes), -1, np.int64)
        _, at, back = np.unique(portion.codes[wanted], return_index=True, return_inverse=True)
        places = np.flatnonzero(wanted)
        found = []
        for i in places[at].tolist():
            name = portion.named(i)
            number = self.ids.setdefault(name, len(self.ids))
            if number == len(self.slots):
                self.slots.append(zlib.crc32(name[1].encode()) % SLOTS)
                if self.prefix == 1:
                    self.is_hot.append(name in self.hot)
            found.append(number)
        out[wanted] = np.array(found, np.int64)[back]
        return out

    def root_ids(self, portion: Portion, ids: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The id of the prefix that begins at each place."""
        if self.prefix == 1:
            return ids[place]
        pairs, at, back = np.unique(ids[place] << 32 | ids[place + 1], return_index=True,
                                    return_inverse=True)
        found = []
        for pair, i in zip(pairs.tolist(), place[at].tolist()):
            number = self.roots.setdefault(pair, len(self.roots))
            if number == len(self.is_hot):
                lang, word = portion.named(i)
                self.is_hot.append((lang, f"{word} {portion.named(i + 1)[1]}") in self.hot)
            found.append(number)
        return np.array(found, np.int64)[back]

    def add(self, portion: Portion, ids: np.ndarray, linked: np.ndarray) -> None:
        """Count phrases over neighbours that are ``linked``, from each word of its own."""
        ahead = np.append(linked, np.zeros(LONGEST, bool))
        place = np.flatnonzero(linked & portion.own[:-1])
        for n in range(1, self.prefix):
            place = place[ahead[place + n]]
        if not len(place):
            return
        node = self.root_ids(portion, ids, place)
        last = place + self.prefix
        slot = np.where(np.array(self.is_hot)[node], np.array(self.slots)[ids[last]], 0)
        node = node << 6 | slot
        for d in range(self.depth):
            unique, back, counts = np.unique(node << 26 | ids[last], return_inverse=True,
                                             return_counts=True)
            self.held[d].append((unique, counts))
            self.size += len(unique)
            if d < self.depth - 1:
                known = self.nodes[d]
                node = np.array([known.setdefault(k, len(known)) for k in unique.tolist()],
                                np.int64)[back]
                more = ahead[last]
                node, last = node[more], last[more] + 1
                if not len(last):
                    break
        if self.size - self.merged > HELD:
            self.held = [[added(parts)] if parts else [] for parts in self.held]
            self.size = self.merged = sum(len(k) for parts in self.held for k, _ in parts)

    def full(self) -> bool:
        return (self.merged > HELD or len(self.ids) + len(self.roots) > NAMES
                or sum(map(len, self.nodes)) > NAMES)

    def handed_on(self) -> Iterator[pa.RecordBatch]:
        """All stripes as rows; nothing is held afterwards."""
        names, low = list(self.ids), (1 << 26) - 1
        stripes, nexts, counts = [], [], []
        parents = texts = None
        for d, parts in enumerate(self.held):
            if parts:
                keys, n = added(parts)
                words = [names[w][1] for w in (keys & low).tolist()]
                above = keys >> 26
                stripes.append(above if d == 0 else parents[above])
                nexts += words if d == 0 else [
                    f"{texts[p]} {w}" for p, w in zip(above.tolist(), words)]
                counts.append(n)
            if d < self.depth - 1:
                known = np.fromiter(self.nodes[d], np.int64, len(self.nodes[d]))
                words = [names[w][1] for w in (known & low).tolist()]
                above = known >> 26
                texts = words if d == 0 else [
                    f"{texts[p]} {w}" for p, w in zip(above.tolist(), words)]
                parents = above if d == 0 else parents[above]
        if stripes:
            prefixes = names if self.prefix == 1 else [
                (names[pair >> 32][0], f"{names[pair >> 32][1]} {names[pair & (1 << 32) - 1][1]}")
                for pair in self.roots]
            yield from self.rows(np.concatenate(stripes), nexts, np.concatenate(counts), prefixes)
        self.clear()

    def rows(self, stripes: np.ndarray, nexts: list[str], counts: np.ndarray,
             prefixes: list[tuple[str, str]]) -> Iterator[pa.RecordBatch]:
        """A row for every bin, with all its stripes."""
        order = np.argsort(stripes, kind="stable")
        stripes, order = stripes[order], order.tolist()
        edges = np.append(np.flatnonzero(np.diff(stripes, prepend=-1)), len(stripes)).tolist()
        rows: dict[int, list[tuple[tuple[str, str], int, int]]] = {}
        for stripe, i, j in zip(stripes[edges[:-1]].tolist(), edges, edges[1:]):
            name = prefixes[stripe >> 6]
            place = zlib.crc32(f"{stripe & SLOTS - 1} {name[1]} {name[0]}".encode()) % self.bins
            rows.setdefault(place, []).append((name, i, j))
        bins = list(rows.items())
        for at in range(0, len(bins), 256):
            some = bins[at:at + 256]
            chosen = [[k for _, i, j in held for k in order[i:j]] for _, held in some]
            yield pa.RecordBatch.from_arrays(
                [pa.array([place for place, _ in some], pa.int32()),
                 pa.array([[name[0] for name, _, _ in held] for _, held in some],
                          pa.list_(pa.string())),
                 pa.array([[name[1] for name, _, _ in held] for _, held in some],
                          pa.list_(pa.string())),
                 pa.array([[j - i for _, i, j in held] for _, held in some],
                          pa.list_(pa.int32())),
                 pa.array(["\t".join([nexts[k] for k in entries]) for entries in chosen],
                          pa.string()),
                 pa.array([counts[entries] for entries in chosen], pa.list_(pa.int64()))],
                names=["bin", "langs", "prefixes", "sizes", "nexts", "counts"])


def added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys with the sums of their counts."""
    if len(parts) == 1:
        return parts[0]
    keys, counts = (np.concatenate(column) for column in zip(*parts))
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    edges = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[edges], np.add.reduceat(counts, edges) if len(edges) else counts


def merged(stripes: DataFrame, least: int) -> DataFrame:
    """words, lang, phrase, f: entries of the merged stripes from ``least`` on. One bin is held at
    a time."""

    def entries(rows: list[dict]) -> list[tuple[int, str, str, int]]:
        totals: dict[tuple[str, str], int] = {}
        for row in rows:
            row["names"] = list(zip(row["langs"], row["prefixes"]))
            row["edges"] = np.concatenate([[0], np.cumsum(row["sizes"])])
            for name, n in zip(row["names"], np.add.reduceat(
                    row["counts"], row["edges"][:-1]).tolist()):
                totals[name] = totals.get(name, 0) + n
        # A stripe that sums up to less has no frequent entry.
        counters = {name: {} for name, n in totals.items() if n >= least}
        for row in rows:
            wanted = [i for i, name in enumerate(row["names"]) if name in counters]
            nexts = row["nexts"].split("\t") if wanted else []
            edges, counts = row["edges"].tolist(), row["counts"].tolist()
            for i in wanted:
                counter, a, b = counters[row["names"][i]], edges[i], edges[i + 1]
                for more, n in zip(nexts[a:b], counts[a:b]):
                    counter[more] = counter.get(more, 0) + n
        return [(prefix.count(" ") + more.count(" ") + 2, lang, f"{prefix} {more}", f)
                for (lang, prefix), counter in counters.items()
                for more, f in counter.items() if f >= least]

    def table(found: list[tuple[int, str, str, int]]) -> pa.RecordBatch:
        columns = list(zip(*found)) or [[]] * 4
        kinds = pa.int32(), pa.string(), pa.string(), pa.int64()
        return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)],
                                          names=["words", "lang", "phrase", "f"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, last, found = [], None, []
        for batch in batches:
            for i, place in enumerate(batch["bin"].to_pylist()):
                if place != last and rows:
                    found += entries(rows)
                    rows = []
                    if len(found) > 10_000:
                        yield table(found)
                        found = []
                last = place
                row = {name: batch[name][i].as_py() for name in (
                    "langs", "prefixes", "sizes", "nexts")}
                rows.append(row | {"counts": batch["counts"][i].values.to_numpy()})
        yield table(found + entries(rows))

    return stripes.repartition("bin").sortWithinPartitions("bin").mapInArrow(
        merge, "words int, lang string, phrase string, f bigint")


# --- the operator ---------------------------------------------------------------------


def word_counts(docs: DataFrame) -> DataFrame:
    """lang, phrase, f: how often each word occurs; the empty phrase is all words together."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], int] = {}

        def hand_on() -> pa.RecordBatch:
            langs, phrases = zip(*held) if held else ((), ())
            out = pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(phrases, pa.string()),
                 pa.array(held.values(), pa.int64())], names=["lang", "phrase", "n"])
            held.clear()
            return out

        for batch in slices(batches):
            for portion in portions(batch):
                own = np.flatnonzero(portion.own)
                _, at, counts = np.unique(portion.codes[own], return_index=True,
                                          return_counts=True)
                for i, n in zip(own[at].tolist(), counts.tolist()):
                    name = portion.named(i)
                    held[name] = held.get(name, 0) + n
                for number, n in enumerate(np.bincount(portion.lang[own]).tolist()):
                    name = portion.langs[number], ""
                    held[name] = held.get(name, 0) + n
                if len(held) > NAMES:
                    yield hand_on()
        yield hand_on()

    return docs.mapInArrow(count, "lang string, phrase string, n bigint").groupBy(
        "lang", "phrase").agg(F.sum("n").alias("f"))


def hot_phrases(found: DataFrame, total: int) -> set[tuple[str, str]]:
    """(lang, phrase) of those that are one of :data:`HOT` words or more: at most :data:`HOT` words,
    or as many pairs."""
    return {(r.lang, r.phrase) for r in found.filter(
        (F.col("words") > 0) & (F.col("f") * HOT >= total)).select("lang", "phrase").collect()}


def stripes_of(docs: DataFrame, hot: set[tuple[str, str]], words: Broadcast | None,
               pairs: Broadcast | None) -> DataFrame:
    """Stripes of single ``words``, or of ``pairs`` with what follows in one to three words."""
    bins = BINS * partitions(docs.sparkSession)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Stripes(1, 1, hot, bins) if pairs is None else Stripes(
            2, LONGEST - 2, hot, bins)
        for batch in slices(batches):
            for portion in portions(batch):
                if len(portion.codes) < 2:
                    continue
                linked = portion.linked.copy()
                if pairs is None:
                    frequent = passes(words.value, portion.codes)
                    linked &= frequent[:-1] & frequent[1:]
                else:
                    linked[linked] = passes(pairs.value, portion.pairs()[linked])
                wanted = np.zeros(len(portion.codes), bool)
                wanted[:-1] |= linked
                wanted[1:] |= linked
                held.add(portion, held.word_ids(portion, wanted), linked)
                if held.full():
                    yield from held.handed_on()
        yield from held.handed_on()

    return docs.mapInArrow(fill, STRIPES)


def frequent(docs: DataFrame, least: int = 100, text: str = "text",
             lang: str = "lang") -> DataFrame:
    """words, lang, phrase, f: all phrases of one to five words that occur ``least`` times or more,
    and as the empty phrase (of 0 words) the number of all words."""
    rows = docs.select(F.col(text).alias("text"),
                       F.coalesce(F.col(lang), F.lit("und")).alias("lang"))
    single = stored(word_counts(rows).filter(F.col("f") >= least).select(
        F.when(F.col("phrase") == "", 0).otherwise(1).alias("words"), "lang", "phrase", "f"),
        "collocations-1")
    total = single.filter("words = 0").agg(F.sum("f")).first()[0] or 0
    pairs = stored(merged(stripes_of(rows, hot_phrases(single, total),
                                     filter_of(single.filter("words = 1"), 1), None), least),
                   "collocations-2")
    longer = stored(merged(stripes_of(rows, hot_phrases(pairs, total), None,
                                      filter_of(pairs, 2)), least), "collocations-3")
    return single.unionByName(pairs).unionByName(longer)


def scored(found: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r, n and score of every candidate: that of its lowest-scoring cut, ties
    to the shortest first part."""
    counts = found.filter("words > 0").select("lang", "phrase", "f")
    # Repeated for each slot, so that the rows of one language meet in many tasks.
    totals = found.filter("words = 0").select(
        "lang", F.col("f").alias("n"), F.explode(F.sequence(F.lit(0), F.lit(SLOTS - 1))).alias("slot"))
    cuts = found.filter("words > 1").select(
        "lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("parts"),
        F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", F.array_join(F.slice("parts", 1, F.col("k")), " ").alias("head"),
        F.array_join(F.expr("slice(parts, k + 1, size(parts))"), " ").alias("tail"))
    cuts = (cuts.join(counts.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l")),
                      ["lang", "head"])
            .join(counts.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r")),
                  ["lang", "tail"])
            .withColumn("slot", F.pmod(F.xxhash64("phrase"), F.lit(SLOTS)).cast("int"))
            .join(totals, ["lang", "slot"]))
    score = F.expr("CAST(1000 AS DECIMAL(4,0)) * CAST(a AS DECIMAL(19,0)) * CAST(n AS DECIMAL(15,0)) "
                   "DIV (CAST(l AS DECIMAL(19,0)) * CAST(r AS DECIMAL(19,0)))")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    return cuts.groupBy("lang", "phrase", "a", "n").agg(lowest).select(
        "lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def subsumed(found: DataFrame) -> DataFrame:
    """lang and phrase where a longer phrase occurs as often. It is enough to look at phrases of
    one word more: whatever lies between a phrase and a longer one occurs as often as both."""
    longer = found.filter("words > 2")
    inside = longer.select(
        "lang", F.expr("substring_index(phrase, ' ', words - 1)").alias("phrase"), "f").unionByName(
        longer.select("lang", F.expr("substring(phrase, instr(phrase, ' ') + 1)").alias("phrase"),
                      "f")).groupBy("lang", "phrase").agg(F.max("f").alias("most"))
    return found.join(inside, ["lang", "phrase"]).filter("most >= f").select("lang", "phrase")


def collocations(docs: DataFrame, least: int = 100, top: int = 2000, text: str = "text",
                 lang: str = "lang") -> DataFrame:
    """The first ``top`` phrases of every language by score, count and text."""
    found = frequent(docs, least, text, lang)
    kept = scored(found).join(subsumed(found), ["lang", "phrase"], "anti")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # Cut in salted groups first, so that the last window sees a bounded number of rows.
    salted = kept.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SLOTS)))
    part = Window.partitionBy("lang", "salt").orderBy(*order)
    few = salted.withColumn("place", F.row_number().over(part)).filter(F.col("place") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    return few.withColumn("rank", rank).filter(F.col("rank") <= top).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")
