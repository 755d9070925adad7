"""Near-duplicate classes by Order MinHash.

A text is a sequence of ``k``-word runs, each labelled with how often it has occurred before. For
each of ``bands`` hash functions the sketch keeps the ``picks`` labelled runs with the least hash,
in text order; two texts share a band if they picked the same runs in the same order, so the
chance falls with every edit and with every change of order. Texts that share a band are candidates;
a pair is a link if a banded alignment of their word sequences matches M words with
M / (n1 + n2 - M) at least ``similarity``. Words are aligned and not runs, since one changed word
takes ``k`` runs with it: texts of which every tenth word differs have hardly half of their runs in
common, and are near copies all the same. Classes are the connected components of the links.

Equal texts are one text from the start (by two 64-bit hashes), however many copies there are; its
vid is the first hash, or where different texts share that one the second. Candidates are decided
in two steps. First each text of a bucket is compared with the bucket's hub: its least text, then in ``rounds`` more rounds others, drawn anew for each bucket and round, as long as the
bucket holds texts of different classes and new pairs are proposed. This joins most of what is to be
joined. Then all pairs of a bucket that are still in different classes are decided: the members
are dealt into slices of bounded size, and a task compares two slices at a time (the bucket's largest
class is not compared with itself, so its members are not copied for each other). Lengths and a
parity bitmap of the words rule out pairs that cannot be similar enough; the others are aligned,
unless links found in the task have joined them. No candidate is left out, so a link is missed only
if the two texts share no band and no chain of links joins them. Of texts with a share J of common
runs that is (1 - J ** ``picks``) ** ``bands`` of the pairs: 0.3 % at 0.6, 4 % at 0.5, and 25 % at 0.38,
the share that is left where every ninth word by itself was changed, which is as far as
``similarity`` 0.8 goes.

Defined results: null and empty texts are equal texts; a text of fewer than ``k`` words is one run;
a class is named by its least document id (null ids count only if there is no other); repeated rows
get the same class; an empty table gives no rows. Only the id and text columns are read; in
:func:`one_of_each` rows travel as one struct, so no name clashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.common import slices, stored, text_of
from larder.llm.word_arrays import mixed, portions, runs

K, PICKS, BANDS, SIMILARITY, ROUNDS = 5, 3, 24, 0.8, 3
#: Members and bytes of word codes of a slice of a bucket, on average; bits of a parity bitmap.
SLICE, SLICE_BYTES, MARK = 500, 4 << 20, 2048


# ---- sketches ----------------------------------------------------------------------------------


def labelled(found: np.ndarray) -> np.ndarray:
    """Runs with their occurrence mixed in: the second one of a kind differs from the first, which
    keeps its code, so that texts with and without repeated runs share labels."""
    order = np.argsort(found, kind="stable")
    ordered = found[order]
    new = np.ones(len(found), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    if new.all():
        return found
    place = np.arange(len(found))
    nth = place - np.maximum.accumulate(np.where(new, place, 0))
    out = np.empty_like(found)
    again = mixed(ordered + nth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    out[order] = np.where(new, ordered, again)
    return out


def seeds(bands: int) -> np.ndarray:
    return mixed(np.arange(1, bands + 1, dtype=np.uint64) << np.uint64(32))


def order_sketch(found: np.ndarray, bands: int, picks: int) -> np.ndarray:
    """One key for each band: the picked runs in text order, and the band itself."""
    found = labelled(found)
    keys = seeds(bands)
    if len(found) <= picks:
        chosen = np.broadcast_to(np.arange(len(found)), (bands, len(found)))
    else:
        chosen = np.empty((bands, picks), np.int64)
        for band in range(bands):
            value = (found ^ keys[band]) * (keys[band] | np.uint64(1))
            value ^= value >> np.uint64(32)
            chosen[band] = np.argpartition(value, picks - 1)[:picks]
        chosen.sort(axis=1)
    out = keys.copy()
    for pick in range(chosen.shape[1]):
        out = mixed(out * np.uint64(31) + found[chosen[:, pick]])
    return out


def text_runs(codes: np.ndarray, k: int) -> np.ndarray:
    return runs(codes, k) if len(codes) >= k else runs(codes, len(codes))[:1] \
        if len(codes) else np.empty(0, np.uint64)


def sketch(k: int, bands: int, picks: int):
    def sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            keys, count = [], []
            for _, words in portions(batch["text"]):
                for a, b in zip(words.first[:-1], words.first[1:]):
                    keys.append(order_sketch(text_runs(words.codes[a:b], k), bands, picks))
                    count.append(int(b - a))
            flat = np.concatenate(keys).view(np.int64) if keys else np.empty(0, np.int64)
            ends = np.arange(len(keys) + 1, dtype=np.int32) * bands
            yield pa.RecordBatch.from_arrays(
                [batch["hash"], batch["check"], batch["doc"],
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                 pa.array(count, pa.int64())],
                names=["hash", "check", "doc", "keys", "words"])
    return sketches


# ---- verification ------------------------------------------------------------------------------


def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as 32-bit word codes, which is what an alignment needs."""
    for batch in slices(batches):
        out = []
        for _, words in portions(batch["text"]):
            short = (words.codes >> np.uint64(32)).astype(np.uint32)
            out += [short[a:b].tobytes() for a, b in zip(words.first[:-1], words.first[1:])]
        yield pa.RecordBatch.from_arrays([batch["vid"], pa.array(out, pa.binary())],
                                         names=["vid", "codes"])


def words_in(codes: pa.Scalar) -> np.ndarray:
    return np.frombuffer(codes.as_buffer(), np.uint32).astype(np.uint64)


def matched_words(a: np.ndarray, b: np.ndarray, band: int, block: int = 1024) -> int:
    """Length of the longest common subsequence whose places differ by at most ``band`` (or a bit
    more). A row of the alignment is one whole number, a bit for each place of ``a`` in the
    window; the window moves along with ``b`` a block at a time, and what leaves it is final."""
    total, row, low = 0, 0, 0
    high = 0
    for at in range(0, len(b), block):
        start, end = min(max(0, at - band), len(a)), min(len(a), at + block + band)
        if start > low:
            gone = min(start - low, high - low)
            total += gone - (row & ((1 << gone) - 1)).bit_count()
            row >>= gone
            low = start
        if end > high:  # places not seen before: nothing matched yet
            high = max(high, low)
            row |= ((1 << (end - high)) - 1) << (high - low)
            high = end
        size = (1 << (high - low)) - 1
        places: dict[int, int] = {}
        for i, code in enumerate(a[low:high].tolist()):
            places[code] = places.get(code, 0) | 1 << i
        for code in b[at:at + block].tolist():
            hit = places.get(code)
            if hit is not None:
                both = row & hit
                row = ((row + both) | (row - both)) & size
    return total + (high - low) - row.bit_count()


def similar(a: np.ndarray, b: np.ndarray, least: float) -> float:
    """The aligned similarity of two word sequences, or 0.0 if it is under ``least``."""
    n, need = len(a) + len(b), least / (1 + least) * (len(a) + len(b))
    if min(len(a), len(b)) + 1e-9 < need:
        return 0.0
    if len(np.intersect1d(labelled(a), labelled(b), assume_unique=True)) + 1e-9 < need:
        return 0.0
    if not n:
        return 1.0
    # Places of matched words differ by the unmatched words between, of which there are few.
    m = matched_words(a, b, int(n - 2 * need) + 1)
    return m / (n - m) if m + 1e-9 >= need else 0.0


def verify(least: float):
    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [similar(words_in(x), words_in(y), least)
                     for x, y in zip(batch["codes"], batch["hub_codes"])]
            yield pa.RecordBatch.from_arrays(
                [batch["vid"], batch["hub"], pa.array(found, pa.float64())],
                names=["vid", "hub", "similarity"])
    return links


# ---- pairs within buckets ----------------------------------------------------------------------


def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each of ``MARK`` bits whether an odd number of a text's labelled words falls there: two
    texts differ in at least as many words as their bitmaps do in bits."""
    for batch in slices(batches):
        bits = []
        for codes in batch["codes"]:
            found = words_in(codes)
            place = (labelled(found) % np.uint64(MARK)).astype(np.int64)
            odd = (np.bincount(place, minlength=MARK) & 1).astype(np.uint8)
            bits.append(np.packbits(odd).tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch["vid"], batch["keys"], pa.array(bits, pa.binary())],
            names=["vid", "keys", "mark"])


def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one bucket and pair of slices after the other, from rows sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = np.stack([batch[c].to_numpy().astype(np.int64) for c in ("key", "i", "j")], axis=1)
        new = np.flatnonzero((ids[1:] != ids[:-1]).any(axis=1)) + 1
        cuts = [0, *new.tolist(), batch.num_rows]
        if held and last != tuple(ids[0]):
            yield pa.Table.from_batches(held)
            held = []
        for a, b in zip(cuts[:-1], cuts[1:]):
            if a:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
        last = tuple(ids[-1])
    if held:
        yield pa.Table.from_batches(held)
    pa.default_memory_pool().release_unused()


def possible(table: pa.Table, least: float) -> dict[int, np.ndarray]:
    """By place of a row, the places of the rows that lengths and bitmaps do not rule out, where
    this bucket is the first one that the pair shares and their classes differ."""
    label, words, own = (table[c].to_numpy() for c in ("label", "words", "own"))
    keys = np.array(table["keys"].to_pylist(), np.int64)
    mark = np.frombuffer(b"".join(table["mark"].to_pylist()), np.uint64).reshape(len(keys), -1)
    key, i, j = (table[c][0].as_py() for c in ("key", "i", "j"))
    band = int(np.argmax(keys[0] == key))
    left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
    found = {}
    for at, u in enumerate(left):
        v = right if i < j else left[at + 1:]
        v = v[label[v] != label[u]]
        need = least / (1 + least) * (words[v] + words[u])
        v = v[np.minimum(words[v], words[u]) + 1e-9 >= need]
        v = v[~(keys[v, :band] == keys[u, :band]).any(axis=1)]
        if not len(v):
            continue
        both = words[v] + words[u]
        apart = np.bitwise_count(mark[v] ^ mark[u]).sum(axis=1, dtype=np.int64)
        v = v[apart <= both - 2 * least / (1 + least) * both + 1e-6]
        if len(v):
            found[int(u)] = v
    return found


def proposed(least: float):
    """Of two slices the texts that belong to a possible pair, each with its ``others``."""
    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in together(batches):
            found = possible(table, least)
            if not found:
                continue
            vid = table["vid"].to_numpy()
            rows = sorted(set(found) | {int(v) for x in found.values() for v in x})
            part = table.take(pa.array(rows)).combine_chunks()
            others = pa.array([vid[found[r]].tolist() if r in found else [] for r in rows],
                              pa.list_(pa.int64()))
            for batch in part.select(["key", "i", "j", "vid", "label"]).append_column(
                    "others", others).to_batches():
                yield batch
    return texts


def decided(least: float):
    """The links among the proposed pairs; pairs that links have joined already are left."""
    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in together(batches):
            vids = table["vid"].to_pylist()
            label = dict(zip(vids, table["label"].to_pylist()))
            codes = dict(zip(vids, table["codes"]))
            up: dict[int, int] = {}
            known: dict[int, np.ndarray] = {}

            def root(x):
                while up.setdefault(x, x) != x:
                    up[x] = x = up[up[x]]
                return x

            def found(v):
                if v not in known:
                    known[v] = words_in(codes[v])
                return known[v]

            out = []
            for u, others in zip(vids, table["others"]):
                for v in others.as_py():
                    a, b = root(label[u]), root(label[v])
                    if a != b and similar(found(u), found(v), least) > 0:
                        up[a] = b
                        out.append((max(u, v), min(u, v)))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x for x, _ in out], pa.int64()),
                     pa.array([x for _, x in out], pa.int64())], names=["vid", "hub"])
    return links


def left_over(shared: DataFrame, labels: DataFrame | None, reps: DataFrame, codes: DataFrame,
              least: float) -> DataFrame:
    """vid and hub of links between members of a bucket with different labels: together with the
    labels they give the classes of all links that any bucket has."""
    parts = ["key", "i", "j"]
    open_ = stored(in_classes(shared, labels).join(
        in_classes(shared, labels).groupBy("key").agg(
            F.count("*").alias("n"), F.min("label").alias("low"), F.max("label").alias("high"))
        .where("low <> high and n > 2")  # the one pair of two was compared in the first round
        .select("key"), "key"), "near-open")
    marks = stored(codes.join(open_.select("vid").distinct(), "vid", "left_semi").join(
        reps.select("vid", "keys"), "vid").select("vid", "codes", "keys").mapInArrow(
            marked, "vid bigint, keys array<bigint>, mark binary"), "near-marks")
    # The largest class of a bucket has slices of its own, which meet those of the rest only.
    per_class = open_.groupBy("key", "label").agg(
        F.count("*").alias("n"), F.sum("words").alias("w"))
    top = F.max(F.struct("n", "w", "label")).alias("top")
    needed = lambda n, w: F.greatest(F.ceil(F.greatest(
        n / SLICE, w * 4 / SLICE_BYTES)), F.lit(1)).cast("int")
    dealt = per_class.groupBy("key").agg(top, F.sum("n").alias("n"), F.sum("w").alias("w")).select(
        "key", F.col("top.label").alias("top"), needed(F.col("top.n"), F.col("top.w")).alias("a"),
        needed(F.col("n") - F.col("top.n"), F.col("w") - F.col("top.w")).alias("b"))
    place, of_top = F.xxhash64("vid", "key"), F.col("label") == F.col("top")
    members = open_.join(dealt, "key").select(
        "key", "vid", "label", "words", F.when(of_top, F.pmod(place, "a")).otherwise(
            F.col("a") + F.pmod(place, "b")).cast("int").alias("own"),
        F.when(of_top, F.col("a")).otherwise(0).alias("from"),
        (F.col("a") + F.col("b") - 1).alias("to"))
    # A member meets its bitmap once, and is then copied for each slice it is compared with.
    copied = members.join(marks, "vid").withColumn(
        "other", F.explode(F.sequence("from", "to"))).withColumns(
        {"i": F.least("own", "other"), "j": F.greatest("own", "other")})
    kind = "key bigint, i int, j int, vid bigint, label bigint"
    pairs = stored(copied.repartition(*parts).sortWithinPartitions(*parts)
                   .select(*parts, "own", "vid", "label", "keys", "words", "mark").mapInArrow(
                       proposed(least), f"{kind}, others array<bigint>"), "near-possible")
    return stored(pairs.join(codes, "vid").repartition(*parts).sortWithinPartitions(*parts)
                  .select(*parts, "vid", "label", "others", "codes").mapInArrow(
                      decided(least), "vid bigint, hub bigint"), "near-links")


# ---- classes -----------------------------------------------------------------------------------


def long_enough(a: str, b: str, least: float) -> Column:
    """Whether texts of so many words can be similar enough, as :func:`similar` finds first."""
    need = F.lit(least / (1 + least)) * (F.col(a) + F.col(b))
    return F.least(a, b) + F.lit(1e-9) >= need


def in_classes(shared: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Members of buckets, each with the label of its class so far."""
    if labels is None:
        return shared.select("*", F.col("vid").alias("label"))
    return shared.join(labels, "vid", "left").select(
        "key", "vid", "words", F.coalesce("label", "vid").alias("label"))


def components(links: DataFrame, a: str = "vid", b: str = "hub") -> DataFrame:
    """vid and label, the least vid of its component, for every vid with a link. Labels spread to
    neighbours and then jump to their own label's label, until nothing changes."""
    edges = stored(links.select(F.col(a).alias("u"), F.col(b).alias("v")).unionByName(
        links.select(F.col(b).alias("u"), F.col(a).alias("v"))).distinct(), "near-edges")
    labels = stored(edges.groupBy("u").agg(F.min("v").alias("near")).select(
        F.col("u").alias("vid"), F.least("u", "near").alias("label")), "near-labels")
    while True:
        around = edges.join(labels.select(F.col("vid").alias("v"), "label"), "v").groupBy(
            F.col("u").alias("vid")).agg(F.min("label").alias("near"))
        spread = labels.join(around, "vid").select(
            "vid", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("vid").alias("label"), F.col("label").alias("far"))
        moved = stored(spread.join(jump, "label").select(
            "vid", "old", F.least("label", "far").alias("label")), "near-labels")
        labels = moved.select("vid", "label")
        if moved.where("label <> old").isEmpty():
            return labels


def hashes(text: str) -> list[Column]:
    """What tells a text from all others: two hashes of it."""
    return [F.xxhash64(text_of(text)).alias("hash"),
            F.xxhash64(F.lit("check"), text_of(text)).alias("check")]


def numbered(found: DataFrame) -> DataFrame:
    """A vid for every pair of hashes: the first one, or for the few that share it the second."""
    clashes = stored(found.groupBy("hash").agg(
        F.min("check").alias("low"), F.max("check").alias("high")).where("low <> high").select(
        "hash", F.lit(True).alias("clash")), "near-clashes")
    return found.join(clashes, "hash", "left").withColumn(
        "vid", F.when(F.col("clash"), F.col("check")).otherwise(F.col("hash"))).drop("clash")


def classes(docs: DataFrame, k: int = K, bands: int = BANDS, picks: int = PICKS,
            similarity: float = SIMILARITY, rounds: int = ROUNDS, doc_id: str = "doc_id",
            text: str = "text") -> DataFrame:
    """One row for each text: hash and check, vid, first_doc (least id of its copies), label (least
    vid of the class) and class_id."""
    texts = docs.select(*hashes(text), F.col(doc_id).cast("long").alias("doc"),
                        F.col(text).alias("text"))
    sketched = texts.mapInArrow(sketch(k, bands, picks),
                                "hash bigint, check bigint, doc bigint, keys array<bigint>, "
                                "words bigint")
    # Copies meet here, one row for each text and task.
    reps = numbered(stored(sketched.groupBy("hash", "check").agg(
        F.min("doc").alias("first_doc"), F.first("keys").alias("keys"),
        F.first("words").alias("words")), "near-texts"))
    rows = reps.select("vid", "words", F.explode("keys").alias("key"))
    buckets = rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    shared = stored(rows.join(buckets, "key"), "near-buckets")
    wanted = shared.select("vid").distinct().join(
        reps.select("hash", "check", "vid", "first_doc"), "vid")
    codes = stored(texts.alias("t").join(wanted.alias("w"), (F.col("t.hash") == F.col("w.hash"))
                                         & (F.col("t.check") == F.col("w.check"))
                                         & F.col("t.doc").eqNullSafe(F.col("w.first_doc")))
                   .select("w.vid", "t.text").mapInArrow(coded, "vid bigint, codes binary")
                   .dropDuplicates(["vid"]), "near-codes")

    links = tested = labels = None
    for turn in range(rounds + 1):
        now = in_classes(shared, labels)
        order = F.col("vid") if turn == 0 else F.xxhash64("vid", "key", F.lit(turn))
        hubs = now.groupBy("key").agg(
            F.min(F.struct(order.alias("at"), "vid", "label", "words")).alias("hub"),
            F.min("label").alias("low"), F.max("label").alias("high")).where(
            "low <> high").select("key", F.col("hub.vid").alias("hub"),
                                  F.col("hub.label").alias("hub_label"),
                                  F.col("hub.words").alias("hub_words"))
        pairs = now.join(hubs, "key").where("label <> hub_label").where(
            long_enough("words", "hub_words", similarity)).select(
            F.least("vid", "hub").alias("hub"), F.greatest("vid", "hub").alias("vid")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["vid", "hub"], "left_anti")
        judged = stored(
            pairs.join(codes, "vid").join(
                codes.select(F.col("vid").alias("hub"), F.col("codes").alias("hub_codes")), "hub")
            .select("vid", "hub", "codes", "hub_codes").mapInArrow(
                verify(similarity), "vid bigint, hub bigint, similarity double"),
            "near-links")
        if judged.isEmpty():
            break
        new = judged.where("similarity > 0").select("vid", "hub")
        pair = judged.select("vid", "hub")
        links = new if links is None else links.unionByName(new)
        tested = pair if tested is None else tested.unionByName(pair)
        if not new.isEmpty():
            labels = components(links)
    new = left_over(shared, labels, reps, codes, similarity)
    if not new.isEmpty():
        labels = components(new if links is None else links.unionByName(new))
    if labels is None:
        return reps.select("hash", "check", "vid", "first_doc", F.col("vid").alias("label"),
                           F.col("first_doc").alias("class_id"))
    named = reps.join(labels, "vid", "left").select(
        "hash", "check", "vid", "first_doc", F.coalesce("label", "vid").alias("label"))
    least = named.groupBy("label").agg(F.min("first_doc").alias("class_id"))
    return named.join(least, "label").select(
        "hash", "check", "vid", "first_doc", "label", "class_id")


def classified(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
               **options) -> DataFrame:
    """doc_id and class_id, one for every row of ``docs``."""
    found = classes(docs, doc_id=doc_id, text=text, **options)
    return docs.select(F.col(doc_id).alias("doc_id"), *hashes(text)).join(
        found, ["hash", "check"]).select("doc_id", "class_id")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                **options) -> DataFrame:
    """The rows of ``docs`` whose id names their class: one of each (rows repeated with the same id
    and text stay together; a class without any id keeps the rows of its least text)."""
    found = classes(docs, doc_id=doc_id, text=text, **options)
    # Of texts that share the naming id, the least one stands for the class.
    chosen = found.where(F.col("first_doc").eqNullSafe(F.col("class_id"))).groupBy("label").agg(
        F.min(F.struct("vid", "hash", "check", "class_id")).alias("m")).select("m.*")
    rows = docs.select(*hashes(text), F.col(doc_id).cast("long").alias("id"),
                       F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return rows.alias("r").join(chosen.alias("c"), (F.col("r.hash") == F.col("c.hash"))
                                & (F.col("r.check") == F.col("c.check"))
                                & F.col("r.id").eqNullSafe(F.col("c.class_id"))).select("r.row.*")
