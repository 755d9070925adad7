"""Quality rules as a bitmask ledger.

Every rule is evaluated once: :func:`ledger` measures a text and stores one bit for each rule it
breaks. A :class:`Policy` is a versioned pair of masks over those bits, so a new policy, or what a
policy would keep without one of its rules (:func:`ablation`), is computed from the stored bits
alone. All of it is column expressions.

Defined results: a null text counts as an empty one (all measurements 0, ``too_short`` set); rows
are judged one by one, so repeated rows and null ids get the same result as any other; an empty
table gives an empty ledger. Only the id and text columns are read, so other columns, whatever
their names, play no part.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.common import text_of, words_of

#: Words in a window that counts as repeated.
WINDOW = 5

MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
            "n_upper"]


@dataclass(frozen=True)
class Rule:
    name: str
    bit: int
    broken: Callable[[dict[str, Column]], Column]


#: Bits are never given to another rule, as stored ledgers hold them.
RULES = [
    Rule("too_short", 0, lambda m: m["n_words"] < 10),
    Rule("repeated_windows", 1, lambda m: 100 * m["n_repeat_words"] > 20 * m["n_words"]),
    Rule("symbols", 2, lambda m: 4 * m["n_symbols"] > m["n_words"]),
    Rule("repeated_lines", 3, lambda m: 2 * m["n_dup_lines"] > m["n_lines"]),
    Rule("short_words", 4, lambda m: m["word_chars"] < 2 * m["n_words"]),
    Rule("long_words", 5, lambda m: m["word_chars"] > 25 * m["n_words"]),
    Rule("shouting", 6, lambda m: 2 * m["n_upper"] > m["word_chars"]),
]


def mask(*names: str) -> int:
    bits = {rule.name: 1 << rule.bit for rule in RULES}
    return sum(bits[name] for name in names)


@dataclass(frozen=True)
class Policy:
    """Rejects a row that breaks any rule of ``hard``, or ``limit`` or more of ``soft``."""

    version: str
    hard: int
    soft: int = 0
    limit: int = 1


#: The rules every policy shares, and the one in use.
BASE = Policy("base", mask("too_short", "repeated_windows"))
CURRENT = Policy("v1", BASE.hard | mask("symbols", "shouting"),
                 mask("repeated_lines", "short_words", "long_words"), 1)


def measured(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The id and :data:`MEASURES`. Windows of a text are compared with each other by 64-bit
    hashes, which stay inside the row: nothing is shuffled."""
    base = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("_text"))
    words = base.select(
        "*", words_of(F.col("_text")).alias("_words"),
        F.filter(F.split("_text", "\n"), lambda line: line.rlike(r"[^ \t\n\x0B\f\r]"))
         .alias("_lines"))
    n = F.size("_words")
    hashed = words.select(
        "doc_id", "_text", "_words", n.cast("long").alias("n_words"),
        F.transform("_lines", lambda line: F.xxhash64(line)).alias("_lines"),
        F.when(n < WINDOW, F.expr("array()").cast("array<bigint>")).otherwise(
            F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(
                *[F.get("_words", i + k) for k in range(WINDOW)]))).alias("_windows"))
    # Most texts repeat no window; only the others are sorted to find which.
    ordered = hashed.select(
        "*", F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"),
                    F.sort_array(F.transform("_windows", lambda h, i: F.struct(
                        h.alias("h"), i.alias("at"))))).alias("_ordered"))
    found = ordered.select("*", F.sort_array(F.transform(
        F.filter("_ordered", lambda x, i: F.coalesce(
            (i > 0) & (F.get("_ordered", i - 1)["h"] == x["h"]), F.lit(False)) | F.coalesce(
            F.get("_ordered", i + 1)["h"] == x["h"], F.lit(False))),
        lambda x: x["at"])).alias("_starts"))
    covered = F.aggregate(
        "_starts", F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda acc, at: F.struct(
            (acc["n"] + at + WINDOW - F.greatest(at, acc["end"])).alias("n"),
            (at + WINDOW).alias("end")))["n"]
    rows = found.select(
        "doc_id", "n_words",
        F.aggregate("_words", F.lit(0).cast("long"), lambda acc, w: acc + F.length(w))
         .alias("word_chars"),
        F.regexp_count("_text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.regexp_count("_text", F.lit(r"\p{Lu}")).cast("long").alias("n_upper"))
    # No filter moves below an explode. Else one on a measurement would be rewritten in terms of
    # the text, with every step above repeated wherever its result is used.
    return rows.select(F.explode(F.array(F.struct(*rows.columns))).alias("m")).select("m.*")


def ledger(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, measurements and ``fail_bits`` (long)."""
    rows = measured(docs, doc_id, text)
    columns = {name: F.col(name) for name in MEASURES}
    bits = [F.when(rule.broken(columns), F.lit(1 << rule.bit)).otherwise(F.lit(0)).cast("long")
            for rule in RULES]
    total = bits[0]
    for bit in bits[1:]:
        total = total.bitwiseOR(bit)
    return rows.select("*", total.alias("fail_bits"))


def rejected(policy: Policy, bits: str | Column = "fail_bits") -> Column:
    bits = F.col(bits) if isinstance(bits, str) else bits
    hard = bits.bitwiseAND(F.lit(policy.hard).cast("long")) != 0
    if not policy.soft:
        return hard
    return hard | (F.bit_count(bits.bitwiseAND(F.lit(policy.soft).cast("long"))) >= policy.limit)


def judged(rows: DataFrame, policy: Policy = CURRENT) -> DataFrame:
    """A ledger with ``base_failed``, ``kept`` and the policy's version."""
    return rows.select("*", rejected(BASE).alias("base_failed"),
                       (~rejected(BASE) & ~rejected(policy)).alias("kept"),
                       F.lit(policy.version).alias("policy"))


def ablation(rows: DataFrame, policy: Policy = CURRENT) -> DataFrame:
    """For each rule of the policy: rows that break it, rows that break nothing else, and rows kept
    by the policy without it. Rows are first summed by their bits, of which there are few."""
    patterns = rows.groupBy("fail_bits").agg(F.count("*").alias("n"))
    lines = []
    for rule in RULES:
        bit = 1 << rule.bit
        if not (policy.hard | policy.soft) & bit:
            continue
        without = Policy(policy.version, policy.hard & ~bit, policy.soft & ~bit, policy.limit)
        breaks = F.col("fail_bits").bitwiseAND(F.lit(bit).cast("long")) != 0
        lines.append(F.struct(
            F.lit(rule.name).alias("rule"),
            F.when(breaks, F.col("n")).otherwise(0).alias("n_failed"),
            F.when(F.col("fail_bits") == bit, F.col("n")).otherwise(0).alias("n_failed_alone"),
            F.when(~rejected(without), F.col("n")).otherwise(0).alias("n_kept_without")))
    each = patterns.select(F.explode(F.array(*lines)).alias("x")).select("x.*")
    return each.groupBy("rule").agg(*[
        F.sum(c).cast("long").alias(c) for c in ("n_failed", "n_failed_alone", "n_kept_without")])


def kept_rows(docs: DataFrame, policy: Policy = CURRENT, doc_id: str = "doc_id",
              text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the policy keeps, with all their columns. The row travels along
    as one struct, so nothing is joined back and no column name can clash."""
    whole = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"),
                        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    verdict = judged(ledger(whole.select(F.struct("doc_id", "row").alias("doc_id"), "text"),
                            "doc_id", "text"), policy)
    return verdict.where("kept").select("doc_id.row.*")
