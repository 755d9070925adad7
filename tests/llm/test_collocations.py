import random
import re
from collections import Counter
from fractions import Fraction

import pytest

from larder.llm import collocations, queries

SCHEMA = "doc_id long, text string, lang string, phrase string, f int, slot string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(rows):
    """Occurrences by (lang, words), and all words by language."""
    f, n = Counter(), Counter()
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    f[lang or "und", tuple(words[i:i + k])] += 1
    return f, n


def brute(rows, least, top):
    f, n = counted(rows)
    found = {}
    for (lang, p), a in f.items():
        if len(p) < 2 or a < least:
            continue
        longer = any(len(q) > len(p) and 100 * b >= 100 * a and b >= least and g == lang and any(
            q[i:i + len(p)] == p for i in range(len(q))) for (g, q), b in f.items())
        if not longer:
            score, k = min((Fraction(1000 * a * n[lang], f[lang, p[:k]] * f[lang, p[k:]]).__floor__(),
                            k) for k in range(1, len(p)))
            found.setdefault(lang, []).append(
                (-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    out = []
    for lang, phrases in found.items():
        for rank, (s, a, p, left, right) in enumerate(sorted(phrases)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def speech(seed, length, words="a b the The of é x, y. z! ß 日本 a\tb c\nd e; a:b ?? ... #".split(" ")):
    pick = random.Random(seed)
    return "".join(pick.choice(words) + pick.choice([" ", " ", "  ", "\t", " ", "\r"])
                   for _ in range(length))


def frame(spark, rows, slices=3):
    return spark.createDataFrame(
        [(None if i % 5 == 1 else i, text, lang, "x", 1, "y") for i, (text, lang) in enumerate(rows)],
        SCHEMA).repartition(slices)


def result(frame):
    return sorted(tuple(r) for r in frame.collect())


ODD = [(None, "en"), ("", "en"), ("   ", None), ("...,,", "fr"), ("one", "de"), ("Ä ä Ä ä", None),
       ("\x00 \x1c\x85 a\x0bb", "en"), ("a b " * 400, "en"), ("x" * 3000, "en")]


@pytest.mark.parametrize("least, top", [(3, 2000), (8, 7), (25, 2000)])
def test_equals_brute_force(spark, least, top):
    rows = ODD + [(speech(i, 60), [None, "en", "fr", "und"][i % 4]) for i in range(30)] + [
        ("the quick brown fox jumps over the dog. " * 5, "en")] * 4
    got = result(collocations.collocations(frame(spark, rows), least, top))
    assert got == brute(rows, least, top) and got


def test_full_tables_and_small_portions_change_nothing(spark, monkeypatch):
    rows = ODD + [(speech(100 + i, 300), ["en", "fr"][i % 2]) for i in range(8)]
    want = brute(rows, 4, 50)
    monkeypatch.setattr(collocations, "HELD", 40)
    monkeypatch.setattr(collocations, "NAMES", 30)
    monkeypatch.setattr(collocations, "HOT", 8)
    monkeypatch.setattr(collocations, "portions", small_portions)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        assert result(collocations.collocations(frame(spark, rows), 4, 50)) == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def small_portions(batch, whole=collocations.portions):
    return whole(batch, 64)


@pytest.mark.parametrize("text", ["aa bb cc dd ee ff gg hh ii", "aa,bb cc  dd.ee", "a" * 50, " , ", "a b " * 9])
@pytest.mark.parametrize("size", [1, 4, 7])
def test_portions_of_a_long_text(text, size):
    """Every phrase starts in one portion's own bytes and lies in it whole."""
    want, _ = counted([(text, "x")])
    got = Counter()
    for part, own in collocations.segments(text.encode(), size):
        for piece in re.finditer(rb"[^.,;:!?\n-\r]+", part):
            words = [(m.start() + piece.start(), m.group().decode())
                     for m in re.finditer(rb"[^ \t]+", piece.group())]
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    if words[i][0] < own:
                        got["x", tuple(w for _, w in words[i:i + k])] += 1
    assert got == want


def test_products_beyond_64_bits(spark):
    big = 3 * 10 ** 9
    found = spark.createDataFrame(
        [(0, "en", "", big * 1000), (1, "en", "a", big), (1, "en", "b", big + 7),
         (2, "en", "a b", big - 1)], "words int, lang string, phrase string, f long")
    row = collocations.scored(found).first()
    assert row.score == 1000 * (big - 1) * big * 1000 // (big * (big + 7))
    assert (row.l, row.r, row.n) == (big, big + 7, big * 1000)


def test_empty_table(spark):
    assert result(collocations.collocations(frame(spark, ODD).limit(0))) == []


def test_query_equals_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    f, n = counted([(r.text, r.lang) for r in docs])
    got = result(queries.op12_collocations(spark, sf_dir))
    assert got
    for lang, _, phrase, a, left, right, total, score in got:
        words = tuple(phrase.split(" "))
        assert a == f[lang, words] >= 100 and total == n[lang]
        sides = [(f[lang, words[:k]], f[lang, words[k:]]) for k in range(1, len(words))]
        scores = [1000 * a * total // (x * y) for x, y in sides]
        assert score == min(scores) and (left, right) == sides[scores.index(score)]
