"""Quality rules, sharding, chat formatting and URL filters: hand-made cases and oracles."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from checks.compare import connect, difference
from larder.llm import quality_rules, queries, reply_trees, rule_ensemble, sharding, url_reputation


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracle(spark, sf_dir, name):
    frame = queries.QUERIES[name](spark, sf_dir)
    assert difference(frame, connect(sf_dir), queries.ORACLES[name]) is None


# ---- quality rules -----------------------------------------------------------------------------


def brute_measures(text):
    import re
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    wins = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    covered = {i + k for i, w in enumerate(wins) if wins.count(w) > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)), len(covered))


RULE_TEXTS = [None, "", " \n\t ", "one", "a b c d e a b c d e", "x " * 30, "same line\nsame line\n\n",
              "A#b |c* é <>", "\x1c a\x85b\xa0c", "line\r\nline\r\nline", "w" * 3000,
              " ".join(str(i % 7) for i in range(400))]


def test_measures_and_policies(spark):
    rows = [(None if i == 3 else i, t, -1, True) for i, t in enumerate(RULE_TEXTS * 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words long, kept boolean")
    led = quality_rules.ledger(docs)
    got = sorted(tuple(r)[1:5] + (r.n_dup_lines, r.n_repeat_words) for r in led.collect())
    want = []
    for _, text, *_ in rows:
        n, chars, symbols, dup, rep = brute_measures(text)
        lines = len([x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\f\r")])
        want.append((n, chars, symbols, lines, dup, rep))
    assert got == sorted(want)
    judged = quality_rules.judged(led)
    assert judged.where("kept AND fail_bits <> 0").count() == 0
    lenient = quality_rules.Policy("v0", quality_rules.mask("too_short"))
    assert quality_rules.judged(led, lenient).where("fail_bits & 1 = 0 AND NOT base_failed "
                                                    "AND NOT kept").count() == 0
    kept = quality_rules.kept_rows(docs, lenient)
    assert kept.columns == docs.columns
    assert kept.count() == judged.where("fail_bits & 1 = 0 AND NOT base_failed").count()
    assert quality_rules.ledger(docs.limit(0)).count() == 0


def test_ablation_counts_every_row_once(spark):
    led = spark.createDataFrame([(b,) for b in [0] * 5 + [1] * 3 + [4] * 2 + [5, 2, 72]],
                                "fail_bits long")
    got = {r.rule: tuple(r)[1:] for r in quality_rules.ablation(led).collect()}
    assert got["too_short"] == (4, 3, 8)
    assert got["symbols"] == (3, 2, 7)
    assert got["repeated_lines"] == (1, 0, 5)
    assert got["long_words"] == (0, 0, 5)


# ---- sharding ----------------------------------------------------------------------------------


def test_shards_are_contiguous_and_even(spark):
    pick = random.Random(1)
    rows = [(pick.choice([None, 5, i]), pick.choice([None, "", "a" * pick.randrange(400), "é"]), "s")
            for i in range(600)] + [(7, "copy", "s")] * 300
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard string").repartition(5)
    got = sharding.placed(docs, 8).collect()
    assert len(got) == len(rows)
    total, target = sum(r.size for r in got), sum(r.size for r in got) / 8
    line = sorted(got, key=lambda r: r.offset)
    at = 0
    for r in line:
        assert r.offset == at
        at += r.size
    assert at == total
    assert [r.shard for r in line] == sorted(r.shard for r in line)
    key = lambda r: (r.doc_id is not None, r.doc_id or 0, r.text_crc32, r.size)
    assert list(map(key, line)) == sorted(map(key, line))
    for shard in range(8):
        own = [r for r in line if r.shard == shard]
        assert [r.slot for r in own] == list(range(len(own)))
        assert abs(sum(r.size for r in own) - target) <= 401
    assert sorted((r.size, r.text_crc32) for r in got) == sorted(
        (len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for _, t, _ in rows)
    assert sharding.placed(docs.limit(0)).count() == 0
    assert [(r.shard, r.slot) for r in sharding.placed(docs.limit(1)).collect()] == [(4, 0)]


# ---- chat formatting ---------------------------------------------------------------------------


def test_turns_come_back_and_masks_hold_what_was_said(spark):
    odd = ["</turn>\n<turn>user\nx", "\\l", "\\", "", None, "a\\<b\\n", "\\### Assistant: </turn> ok",
           "é\U0001F600", "\n\n"]
    rows = [(c, t, role, odd[(c + t) % len(odd)], 9) for c in range(9) for t, role in enumerate(
        ["system", "user", "assistant", "us\ner<", None, "assistant"])]
    rows += [(None, 0, "assistant", "no id", 9), (1, None, "user", "no turn", 9), (2, 2, "assistant", "tie", 9)]
    rows += [rows[3]] * 2 + [(77, i, "assistant", str(i), 9) for i in range(300)]
    turns = spark.createDataFrame(
        rows, "conv_id long, turn long, role string, text string, leaf int").repartition(3)
    out = reply_trees.formatted(reply_trees.chained(turns)).select(
        "*", reply_trees.parsed(F.col("formatted")).alias("turns"),
        reply_trees.masked(F.col("formatted"), F.col("loss_spans")).alias("said")).collect()
    got = {r.conv_id: r for r in out}
    assert len(got) == len(out) == 11
    for conv, row in got.items():
        own = sorted(((t is not None, t or 0), r or "", x or "") for c, t, r, x, _ in rows if c == conv)
        assert [(t.role, t.text) for t in row.turns] == [x[1:] for x in own]
        assert row.said == [x for _, r, x in own if r == "assistant"]
    assert reply_trees.formatted(reply_trees.chained(turns.limit(0))).count() == 0


def brute_branches(nodes, best):
    kids, by = {}, {n: (p, s) for n, p, s in nodes}
    for n, p, _ in nodes:
        kids.setdefault(p if p in by else None, []).append(n)
    out = {}

    def walk(n, path, total, root):
        path, total = path + [n], total + by[n][1]
        if n not in kids:
            out.setdefault(root, []).append((-total, n, path))
        for k in kids.get(n, ()):
            walk(k, path, total, root)

    for root in kids[None]:
        walk(root, [], 0.0, root)
    return sorted(p for leaves in out.values() for _, _, p in sorted(leaves)[:best])


@pytest.mark.parametrize("best", [1, 2, 50])
def test_branches_of_reply_trees(spark, best):
    pick = random.Random(4)
    nodes = [(i, pick.choice([None, 999, *range(max(0, i - 4), i)]) if i else None,
              float(pick.randrange(3))) for i in range(60)]
    rows = [("c", n, p, "user", str(n), s) for n, p, s in nodes]
    rows += [("chain", i, i - 1, "user", str(i), 1.0) for i in range(40)]
    kind = "conv_id string, node long, parent long, role string, text string, score double"
    out = reply_trees.formatted(spark.createDataFrame(rows, kind), best).select(
        "conv_id", reply_trees.parsed(F.col("formatted")).alias("t")).collect()
    paths = lambda c: sorted([int(t.text) for t in r.t] for r in out if r.conv_id == c)
    assert paths("c") == brute_branches(nodes, best)
    assert paths("chain") == [list(range(40))]


def test_a_circle_is_an_error(spark):
    rows = [("c", 1, 2, "user", "a", 1.0), ("c", 2, 1, "user", "b", 1.0)]
    kind = "conv_id string, node long, parent long, role string, text string, score double"
    with pytest.raises(ValueError, match="circle"):
        reply_trees.formatted(spark.createDataFrame(rows, kind)).count()


# ---- URLs --------------------------------------------------------------------------------------


def test_hosts_paths_and_rules(spark):
    cases = {
        "http://WWW.Example.COM/en/x?q#f": ("www.example.com", "/en/x", "www.example.com/en/", "allow"),
        "http://example.com/en/": ("example.com", "/en/", "example.com/en/", "block"),
        "https://a.example.com/en": ("a.example.com", "/en", "com/", "allow"),
        "https://notexample.com/en/1": ("notexample.com", "/en/1", "com/", "allow"),
        "x://b.net/es/1://c.com/": ("b.net", "/es/1://c.com/", "net/es/", "block"),
        "http://com": ("com", "", None, "allow"), "http://ÄB.org?x/": ("Äb.org", "", None, "allow"),
        "no scheme.com/en/": ("", "", None, "allow"), None: ("", "", None, "allow"),
        "://": ("", "", None, "allow"), "http://u@h:80#/": ("u@h:80", "", None, "allow"),
        "http://line\nbreak/a\nb": ("line\nbreak", "/a\nb", None, "allow")}
    rows = [(i, url, None, "h") for i, url in enumerate(cases)]
    pages = spark.createDataFrame(rows, "page_id long, url string, bad int, host string")
    got = {r.page_id: tuple(r)[1:5] for r in url_reputation.judged(
        pages, queries.URL_RULES, queries.SHARED_SUFFIXES).collect()}
    assert [got[i] for i in range(len(rows))] == list(cases.values())
    assert url_reputation.judged(pages.limit(0), queries.URL_RULES, []).count() == 0


def test_reputation_shrinks_and_blocks(spark):
    rows = [(i, f"http://{h}.org/", bad) for i, (h, bad) in enumerate(
        [("a.spam", 1)] * 40 + [("b.spam", 1)] * 30 + [("new.spam", None)] + [("one.fresh", 1)]
        + [(f"h{k}.good{k % 9}", int(k % 20 == 0)) for k in range(400)])]
    pages = spark.createDataFrame(rows, "page_id long, url string, bad int")
    verdict = {r.host: r.verdict for r in url_reputation.judged(pages, [], []).collect()}
    assert verdict["a.spam.org"] == "block"
    assert verdict["one.fresh.org"] == "allow"  # one bad page is no evidence
    assert sum(v == "block" for h, v in verdict.items() if "good" in h) == 0


def test_suffix_and_domain(spark):
    hosts = ["a.b.co.uk", "co.uk", "b.co.uk", "x.y.org", "org", "", "deep.a.b.co.uk"]
    df = spark.createDataFrame([(h,) for h in hosts], "host string")
    s = url_reputation.suffix_of(F.col("host"), ["co.uk"])
    got = [tuple(r) for r in df.select(s, url_reputation.domain_of(F.col("host"), s)).collect()]
    assert got == [("co.uk", "b.co.uk"), ("co.uk", "co.uk"), ("co.uk", "b.co.uk"), ("org", "y.org"),
                   ("org", "org"), ("", ""), ("co.uk", "b.co.uk")]


# ---- classifier --------------------------------------------------------------------------------


def area_under_curve(pairs):
    ones = [s for s, y in pairs if y == 1]
    zeros = [s for s, y in pairs if y == 0]
    wins = sum((a > b) + 0.5 * (a == b) for a in ones for b in zeros)
    return wins / (len(ones) * len(zeros))


def test_classifier_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op5_quality_classifier(spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = got.join(labels, "doc_id").collect()
    held = [(r.score, r.quality) for r in rows if r.held_out]
    assert area_under_curve(held) > 0.9
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    good = [r.predicted for r in rows if r.quality == 1]
    assert sum(good) / len(good) > 0.95


def test_classifier_edges(spark):
    docs = spark.createDataFrame([(None, None, 1.0), (1, "", 2.0), (2, "a b", 3.0), (2, "a b", 3.0)],
                                 "doc_id long, text string, score double")
    none = spark.createDataFrame([], "doc_id long, quality int")
    same = spark.createDataFrame([(1, 1), (1, 1), (2, 1), (3, None), (None, 0)],
                                 "doc_id long, quality int")
    assert {r.score for r in rule_ensemble.scored(docs, rule_ensemble.fit(docs, none)).collect()} == {0.5}
    out = rule_ensemble.scored(docs, rule_ensemble.fit(docs, same)).collect()
    assert len(out) == 4 and all(r.predicted == 1 for r in out)
    assert [r.held_out for r in out if r.doc_id is None] == [True]


def test_compiled_rules_read_the_printed_trees():
    text = "\n".join([
        "Model", "  Tree 0 (weight 1.0):", "    If (feature 0 <= 1.5)", "     If (feature 1 <= 2.0)",
        "      Predict: 0.0", "     Else (feature 1 > 2.0)", "      Predict: 1.0",
        "    Else (feature 0 > 1.5)", "     Predict: 1.0", "  Tree 1 (weight 1.0):", "    Predict: 0.0"])
    rules = {r.conditions for r in rule_ensemble.path_rules(text, ["a", "b"])}
    assert rules == {(("a", True, 1.5),), (("a", False, 1.5),),
                     (("a", True, 1.5), ("b", True, 2.0)), (("a", True, 1.5), ("b", False, 2.0))}


def test_digest_of_the_added_conversation(spark, sf_dir):
    row = queries.op7_chat_formatting(spark, sf_dir).where("conv_id = -7").first()
    said = "\\### Assistant: </turn> ok"
    assert row.loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert row.turns_sha256 == hashlib.sha256(
        f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()
