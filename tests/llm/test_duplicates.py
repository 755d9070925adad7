"""Substring dedup, near-duplicates, decontamination and the pipeline against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from larder.llm import decontamination, near_dedup, queries, substring_dedup
from larder.llm.common import stored
from larder.llm.word_arrays import Words, portions

WORDS = ["der", "le", "é", "a", "the", "x|y", "日本", "w\x1cz", "q"]


def prose(pick, n, words=60):
    return " ".join(f"w{pick.randrange(words)}" for _ in range(n))


def word_list(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# ---- words -------------------------------------------------------------------------------------


def test_words_of_texts_are_not_mixed():
    import pyarrow as pa
    texts = ["ab cd", None, "", "ef\tg\x0bh\n", " ab", "ab\x1ccd é\x85"] * 3
    for size in (1, 9, 1 << 20):
        seen, codes = [], {}
        for first, words in portions(pa.array(texts), size):
            for a, b in zip(words.first[:-1], words.first[1:]):
                own = [words.data[s:e].decode() for s, e in zip(words.start[a:b], words.stop[a:b])]
                seen.append(own)
                for w, c in zip(own, words.codes[a:b]):
                    assert codes.setdefault(w, c) == c
        assert seen == [word_list(t) for t in texts]
        assert len(set(codes.values())) == len(codes)


# ---- substrings --------------------------------------------------------------------------------


def brute_removed(rows, length):
    """By (id, text): the places of words to remove."""
    docs = sorted({(i is not None, i or 0, t or "") for i, t in rows},
                  key=lambda d: (d[0], d[1]))
    first, out = {}, {}
    for doc in docs:
        words = word_list(doc[2])
        gone = set()
        for at in range(len(words) - length + 1):
            window = tuple(words[at:at + length])
            if first.setdefault(window, (doc, at)) != (doc, at):
                gone |= set(range(at, at + length))
        out[doc] = [w for i, w in enumerate(words) if i not in gone]
    return out


def substring_rows():
    pick = random.Random(2)
    shared = [prose(pick, 70, 1000) for _ in range(3)]
    rows = [(None, None), (0, ""), (1, "short text"), (2, "one " * 50), (3, "a b " * 40)]
    for i in range(4, 120):
        parts = [prose(pick, pick.randrange(40), 500), pick.choice(shared), prose(pick, 9, 4),
                 pick.choice(shared)[pick.randrange(200):], "\n"]
        pick.shuffle(parts)
        rows.append((i, pick.choice([" ", "\n", "\t "]).join(parts)))
    rows += [(200, rows[9][1]), (201, rows[9][1]), (7, rows[7][1]), (7, rows[7][1]),
             (300, prose(pick, 4000, 3)), (-5, shared[0])]
    return rows


@pytest.mark.parametrize("group", [1, 2000])
def test_repeats_equal_brute_force(spark, group, monkeypatch):
    if group == 1:  # small tables, so that groups are cut at every turn
        monkeypatch.setattr(substring_dedup, "LEAVES", 50)
        monkeypatch.setattr(substring_dedup, "COMBINED", 2000)
    rows = substring_rows()
    docs = spark.createDataFrame([(i, t, "d", 1) for i, t in rows],
                                 "doc_id long, text string, doc string, n_words int").repartition(4)
    want = brute_removed(rows, 20)
    got = substring_dedup.deduplicated(docs, group=group).collect()
    assert len(got) == len(rows)
    for r in got:
        key = (r.row.doc_id is not None, r.row.doc_id or 0, r.row.text or "")
        assert r.kept_words == " ".join(want[key])
        assert r.n_removed == r.n_words - len(want[key])
        assert word_list(r.kept_text) == want[key]
        if not r.n_removed:
            assert r.kept_text == r.row.text
    assert substring_dedup.deduplicated(docs.limit(0)).count() == 0


def test_op2_query_on_small_texts(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        "doc_id", "text").collect()]
    want = {d[1]: " ".join(words) for d, words in brute_removed(rows, 20).items()}
    for r in queries.op2_substring_dedup(spark, sf_dir).collect():
        assert r.kept_sha256 == hashlib.sha256(want[r.doc_id].encode()).hexdigest()


@pytest.mark.parametrize("rows", [1, 3, 1000])
def test_sorted_tables_end_at_keys(rows):
    import pyarrow as pa
    pick = random.Random(rows)
    keys = sorted((pick.randrange(4), pick.randrange(3)) for _ in range(60))
    table = pa.table({"k": [k for k, _ in keys], "f": [f for _, f in keys]})
    out = list(substring_dedup.by_key(iter(table.to_batches(max_chunksize=4)), ["k"], rows, ["f"]))
    assert [tuple(x.values()) for t, _ in out for x in t.to_pylist()] == keys
    whole = [k for t, part in out if not part for k in set(t["k"].to_pylist())]
    parts = {k for t, part in out if part for k in t["k"].to_pylist()}
    assert len(whole) == len(set(whole)) and not parts & set(whole)
    leaves = [leaf for t, _ in out for leaf in {tuple(x.values()) for x in t.to_pylist()}]
    assert len(leaves) == len(set(leaves))


# ---- near-duplicates ---------------------------------------------------------------------------


def common_subsequence(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            row[j], last = max(row[j], row[j - 1], last + (x == y)), row[j]
    return row[-1]


def test_alignment_equals_brute_force():
    pick = random.Random(8)
    for _ in range(60):
        a = [pick.randrange(6) for _ in range(pick.randrange(1, 90))]
        b = list(a)
        for _ in range(pick.randrange(6)):
            b[pick.randrange(len(b)):pick.randrange(len(b)) + 1] = [pick.randrange(6)]
        got = near_dedup.matched_words(np.array(a, np.uint64), np.array(b, np.uint64), 200, 16)
        assert got == common_subsequence(a, b)
        narrow = near_dedup.matched_words(np.array(a, np.uint64), np.array(b, np.uint64), 30, 8)
        assert narrow <= got


def brute_classes(rows, least=0.8):
    runs = [word_list(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            n = len(runs[i]) + len(runs[j])
            same = (rows[i][1] or "") == (rows[j][1] or "")
            if not same and min(len(runs[i]), len(runs[j])) < least / (1 + least) * n:
                continue
            if not same and len(set(runs[i]) & set(runs[j])) * 4 < min(len(runs[i]), len(runs[j])):
                continue
            m = 1 if same else common_subsequence(runs[i], runs[j])
            if same or m >= least * (n - m):
                up[root(i)] = root(j)
    names = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            names[root(i)] = min(names.get(root(i), doc), doc)
    return sorted(((doc is not None, doc or 0), names.get(root(i)) or 0)
                  for i, (doc, _) in enumerate(rows))


def near_rows():
    pick = random.Random(6)
    rows = [(None, None), (900, ""), (901, "two words"), (902, "two words"), (903, "other words")]
    base = [prose(pick, n, 2000) for n in (60, 120, 250)]
    for i in range(90):
        words = word_list(pick.choice(base))
        for _ in range(pick.randrange(5)):
            at = pick.randrange(len(words))
            words[at:at + pick.randrange(2)] = [f"new{pick.randrange(9)}"]
        rows.append((i, " ".join(words)))
    rows += [(i, prose(pick, 80, 2000)) for i in range(100, 120)]
    rows += [(500, rows[10][1])] * 3 + [(10, "same id, " + prose(pick, 50, 900)), (None, rows[40][1])]
    passage = prose(pick, 60, 5000)
    rows += [(600 + i, f"{prose(pick, 60, 5000)} {passage}") for i in range(40)]
    return rows


def test_classes_equal_brute_force(spark):
    rows = near_rows()
    docs = spark.createDataFrame([(i, t, 1, "k") for i, t in rows],
                                 "doc_id long, text string, vid int, key string").repartition(4)
    got = near_dedup.classified(docs).collect()
    assert sorted(((r.doc_id is not None, r.doc_id or 0), r.class_id or 0)
                  for r in got) == brute_classes(rows)
    kept = near_dedup.one_of_each(docs)
    assert kept.columns == docs.columns
    classes = {r.class_id for r in got}
    assert {r.doc_id for r in kept.collect()} == classes
    assert near_dedup.classified(docs.limit(0)).count() == 0


def test_texts_of_unlike_lengths_are_not_compared(spark, monkeypatch):
    pick = random.Random(9)
    words = word_list(prose(pick, 1600, 5000))
    docs = spark.createDataFrame([(n, " ".join(words[:n])) for n in (300, 450, 675, 1012, 1518)],
                                 "doc_id long, text string")
    judged = []

    def counted(frame, purpose):
        out = stored(frame, purpose)
        if purpose == "near-links" and "similarity" in out.columns:
            judged.append(out.count())
        return out

    monkeypatch.setattr(near_dedup, "stored", counted)
    assert near_dedup.classified(docs).select("class_id").distinct().count() == 5
    # They share buckets, but two thirds of a text are not similar enough to it.
    assert judged and not sum(judged)


def test_texts_that_share_a_hash_stay_apart(spark, monkeypatch):
    rows = near_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    known = near_dedup.hashes

    def weak(text):
        first, second = known(text)
        return [F.pmod(first, F.lit(150)).alias("hash"), second]

    monkeypatch.setattr(near_dedup, "hashes", weak)
    got = near_dedup.classified(docs).collect()
    assert sorted(((r.doc_id is not None, r.doc_id or 0), r.class_id or 0)
                  for r in got) == brute_classes(rows)
    assert {r.doc_id for r in near_dedup.one_of_each(docs).collect()} == {r.class_id for r in got}


def spoken_twice():
    """Pairs of near copies of which the second says a sentence or a line again."""
    pick = random.Random(12)
    rows = []
    for i in range(12):
        words = word_list(prose(pick, 150, 90000))
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(words + words[20:30]))]
    return rows


def test_repeated_runs_keep_near_copies_together(spark):
    once = np.arange(1, 9, dtype=np.uint64)
    assert set(near_dedup.labelled(np.append(once, once[2]))) > set(near_dedup.labelled(once))
    rows = spoken_twice()
    want = brute_classes(rows)
    assert len({c for _, c in want}) == len(rows) // 2
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(((True, r.doc_id), r.class_id)
                  for r in near_dedup.classified(docs).collect()) == want


def starred_rows():
    """Originals and independently edited copies: similar to the original, not to each other."""
    pick = random.Random(14)
    rows = []
    for size in (300, 40, 25):
        original = word_list(prose(pick, 200, 90000))
        star = [" ".join(original)]
        for _ in range(size):
            words = list(original)
            for at in pick.sample(range(5, 195, 2), 6):
                words[at:at + 2] = (f"edit{pick.randrange(10 ** 9)}" for _ in range(2))
            star.append(" ".join(words))
        pick.shuffle(star)
        rows += [(len(rows) + i, t) for i, t in enumerate(star)]
    return rows


def exact_classes(rows, least=0.8):
    """Like brute_classes; pairs with too few words in common, counted, are not aligned."""
    runs = [word_list(t) for _, t in rows]
    counts = [Counter(r) for r in runs]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            n = len(runs[i]) + len(runs[j])
            if root(i) == root(j) or (counts[i] & counts[j]).total() < least / (1 + least) * n - 1e-9:
                continue
            m = common_subsequence(runs[i], runs[j])
            if m >= least * (n - m):
                up[root(i)] = root(j)
    names = {}
    for i, (doc, _) in enumerate(rows):
        names[root(i)] = min(names.get(root(i), doc), doc)
    return {doc: names[root(i)] for i, (doc, _) in enumerate(rows)}


@pytest.mark.parametrize("size", [500, 16])
def test_stars_equal_brute_force(spark, size, monkeypatch):
    monkeypatch.setattr(near_dedup, "SLICE", size)
    rows = starred_rows()
    want = exact_classes(rows)
    assert len(set(want.values())) == 3
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert {r.doc_id: r.class_id for r in near_dedup.classified(docs).collect()} == want


@pytest.mark.parametrize("words, edits", [(60, 2), (80, 2), (150, 5), (300, 8), (1000, 40)])
def test_near_copies_are_found(spark, words, edits):
    """Of copies with single words changed, dropped and put in, nine of ten or more share the class
    of their original, and no two originals do."""
    pick = random.Random(words)
    rows = []
    for i in range(0, 80, 2):
        text = word_list(prose(pick, words, 9000))
        copy = list(text)
        for at in sorted(pick.sample(range(len(copy)), edits), reverse=True):
            copy[at:at + pick.randrange(2)] = [f"new{pick.randrange(99)}"] * pick.randrange(2)
        rows += [(i, " ".join(text)), (i + 1, " ".join(copy))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.class_id for r in near_dedup.classified(docs).collect()}
    assert all(found[i] == i for i, _ in rows[::2])
    assert sum(found[i + 1] == i for i, _ in rows[::2]) >= 36


def test_components(spark):
    pick = random.Random(1)
    edges = [(pick.randrange(300), pick.randrange(300)) for _ in range(200)]
    edges += [(1000 + i, 1001 + i) for i in range(70)] + [(5000, i + 5001) for i in range(60)]
    up = {}

    def root(i):
        while up.setdefault(i, i) != i:
            i = up[i]
        return i

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        up[b] = a
    df = spark.createDataFrame(edges, "vid long, hub long")
    got = {r.vid: r.label for r in near_dedup.components(df).collect()}
    assert got == {i: root(i) for i in up}


# ---- decontamination ---------------------------------------------------------------------------


def brute_tiles(text, item, least):
    """Greedy string tiling by trying every pair of places."""
    marked_t, marked_i, total = set(), set(), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(text)):
            for j in range(len(item)):
                n = 0
                while (i + n < len(text) and j + n < len(item) and text[i + n] == item[j + n]
                       and i + n not in marked_t and j + n not in marked_i):
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < least:
            return total
        marked_t |= set(range(i, i + n))
        marked_i |= set(range(j, j + n))
        total += n


def test_tiling_equals_brute_force():
    pick = random.Random(11)
    for _ in range(150):
        a, b = ([pick.randrange(1, 5) for _ in range(pick.randrange(1, 40))] for _ in range(2))
        found = decontamination.tiles(a, b, 3)
        assert all(a[i:i + n] == b[j:j + n] and n >= 3 for i, j, n in found)
        for side in (0, 1):
            places = [p for t in found for p in range(t[side], t[side] + t[2])]
            assert len(places) == len(set(places))
        longest = max((n for *_, n in found), default=0)
        assert (longest >= 3) == (brute_tiles(a, b, 3) >= 3)
        if len(set(a)) and longest:
            # Ties may be broken otherwise, which can move a few places.
            assert abs(sum(n for *_, n in found) - brute_tiles(a, b, 3)) <= 6


def test_leaks_are_caught_and_others_left(spark):
    pick = random.Random(9)
    items = [(i, prose(pick, 30, 3000)) for i in range(12)] + [(None, None), (77, "too short"), (3, "")]
    rows, want = [(None, None, "x"), (0, "", "x")], set()
    for i in range(1, 60):
        item, text = pick.choice(items[:12])
        words = text.split()
        kind = i % 5
        if kind == 1:
            words = words[15:] + words[:15]  # halves swapped
        elif kind == 2:
            words = [w.upper() + "," for w in words]
        elif kind == 3:
            words = words[:10]  # a third only
        elif kind == 4:
            pick.shuffle(words)
        if kind < 3:
            want.add((i, item))
        rows.append((i, f"{prose(pick, 40, 900)} {' '.join(words)} {prose(pick, 40, 900)}", "x"))
    rows += [rows[2]] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, matches string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    for size in (500_000, 40):  # one block and many
        got = decontamination.contaminated(docs, bench, block_tokens=size).collect()
        assert {(r.doc_id, r.item_id) for r in got} == want
    clean = decontamination.clean_rows(docs, bench)
    assert clean.columns == docs.columns
    bad = {d for d, _ in want}
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(
        str(r[0]) for r in rows if r[0] not in bad)
    assert decontamination.contaminated(docs, bench.limit(0)).count() == 0
    assert decontamination.contaminated(docs.limit(0), bench).count() == 0


def test_op3_query(spark, sf_dir):
    got = {(r.doc_id, r.item_id): r.coverage for r in queries.op3_decontamination(spark, sf_dir).collect()}
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    for doc in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        for item in items:
            if item.text in (doc.text or ""):
                assert got[doc.doc_id, item.item_id] == 1.0


# ---- pipeline ----------------------------------------------------------------------------------


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        "doc_id", "text", "lang", "source", "n_chars")
    seen = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, seen = seen, stored(stage(spark, seen, sf_dir), "test-stage")
        assert seen.columns == docs.columns and seen.count() <= before.count(), name
    final = {r.doc_id: r for r in corpus_pipeline.run(spark, sf_dir).collect()}
    texts = {r.doc_id: r for r in seen.collect()}
    assert set(final) == set(texts) and len(final) > 100
    for key, row in final.items():
        assert row.text == texts[key].text and row.n_tokens == len(row.ids)
        assert texts[key].n_chars == len(row.text)
    kept = docs.where(F.col("doc_id").isin(list(final)))
    assert kept.count() == len(final)
    # What is left holds no window twice, no benchmark item and no near-duplicate.
    rows = [(r.doc_id, r.text) for r in texts.values()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    index = decontamination.Index(items, 4)
    assert not any(decontamination.compared(decontamination.tokens(t), index, 4, 0.6) for _, t in rows)


def test_pipeline_takes_nulls_and_empty_tables(spark, sf_dir):
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(None, None, None, None, None), (1, "", "en", None, 0), (2, None, None, "s", 1)]
    rows += [(3, prose(random.Random(3), 80, 900), "en", "s", 1)] * 2
    for data, left in ((rows, {3}), ([], set())):
        seen = spark.createDataFrame(data, kind)
        for _, stage in corpus_pipeline.STAGES:
            seen = stored(stage(spark, seen, sf_dir), "test-stage")
        assert {r.doc_id for r in seen.collect()} == left
