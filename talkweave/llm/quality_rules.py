"""Quality rules as a bitmask ledger: every rule is evaluated once, policies are applied to the stored bits.

``ledger`` measures each text and sets one bit per failed rule. A policy is a version name with a mask of the
rules that count; ``kept`` needs only the bits, so policies change without reading a text again. ``ablations``
compares what a policy drops with and without each rule, from counts per distinct bit pattern.

All of it is built-in SQL: no shuffle (but for the few rows of an ablation), no Python. Null and blank texts have
no words and fail ``few_words``. Repeated rows and ties need no rule, as rows are judged one by one; an empty table
gives an empty ledger; columns of the input pass through, but for one called ``ledger``, which is replaced.
Windows of a text are told apart by a 64-bit hash, compared only within one text.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITE, let, words

SYMBOLS = "#*$%&|<>"
WINDOW = 8


@dataclass(frozen=True)
class Rule:
    name: str
    bit: int
    failed: Callable[[Column], Column]  # of the struct of measurements


#: A rule never changes its bit, so that stored ledgers stay readable. Ratios are compared in whole numbers.
RULES = (
    Rule("few_words", 0, lambda m: m["n_words"] < 20),
    Rule("repeated_windows", 1, lambda m: 100 * m["n_repeat_words"] > 30 * m["n_words"]),
    Rule("symbols", 2, lambda m: 100 * m["n_symbols"] > 20 * m["n_words"]),
    Rule("repeated_lines", 3, lambda m: 100 * m["n_dup_lines"] > 40 * m["n_lines"]),
    Rule("stuttering", 4, lambda m: 100 * m["n_stutter"] > 30 * m["n_words"]),
    Rule("word_length", 5, lambda m: (m["word_chars"] < 2 * m["n_words"]) | (m["word_chars"] > 16 * m["n_words"])),
)


def mask_of(*names: str) -> int:
    return sum(1 << r.bit for r in RULES if r.name in names)


BASE = mask_of("few_words", "repeated_windows")

#: Versions of the policy: which failed rules drop a document.
POLICIES = {"base": BASE, "v1": BASE | mask_of("symbols", "repeated_lines", "stuttering", "word_length")}
CURRENT = "v1"


def _covered(hashes: Column) -> Column:
    """How many words lie in windows whose hash occurs twice or more."""

    def of_sorted(s: Column) -> Column:
        def twin(e: Column, i: Column) -> Column:
            same = lambda j: F.coalesce(F.get(s, j)["h"] == e["h"], F.lit(False))
            return same(i - 1) | same(i + 1)

        places = F.sort_array(F.transform(F.filter(s, twin), lambda e: e["p"]))
        start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n"))
        return F.aggregate(places, start, lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(WINDOW), p - a["last"])).alias("n")), lambda a: a["n"].cast("bigint"))

    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("bigint")).otherwise(let(pairs, of_sorted))


def _of_words(ws: Column) -> Column:
    n = F.size(ws)
    hashes = F.when(n >= WINDOW, F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(ws, i, WINDOW)))).otherwise(F.array().cast("array<bigint>"))
    stutter = F.size(F.filter(ws, lambda w, i: F.coalesce(F.get(ws, i - 1) == w, F.lit(False))))
    return F.struct(n.cast("bigint").alias("n_words"), stutter.cast("bigint").alias("n_stutter"), let(hashes, _covered).alias("n_repeat_words"))


def _of_lines(lines: Column) -> Column:
    return F.struct(F.size(lines).cast("bigint").alias("n_lines"), (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint").alias("n_dup_lines"))


def ledger_of(text: Column) -> Column:
    """A struct of all measurements of a text and ``fail_bits``, each evaluated once."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(WHITE)) != "")
    parts = F.struct(
        let(words(text), _of_words).alias("w"),
        let(lines, _of_lines).alias("l"),
        F.length(F.translate(text, WHITE, "")).cast("bigint").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
    )

    def with_bits(m: Column) -> Column:
        flat = {"n_words": m["w"]["n_words"], "word_chars": m["word_chars"], "n_symbols": m["n_symbols"], "n_lines": m["l"]["n_lines"], "n_dup_lines": m["l"]["n_dup_lines"], "n_repeat_words": m["w"]["n_repeat_words"], "n_stutter": m["w"]["n_stutter"]}
        bits = [F.when(r.failed(flat), F.lit(1 << r.bit)).otherwise(F.lit(0)) for r in RULES]
        return F.struct(*[c.alias(k) for k, c in flat.items()], sum(bits[1:], bits[0]).cast("bigint").alias("fail_bits"))

    return let(parts, with_bits)


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the struct column ``ledger``."""
    return docs.withColumn("ledger", ledger_of(F.col(text)))


def kept(fail_bits: Column, policy: str = CURRENT) -> Column:
    """Whether a document passes a version of the policy."""
    return fail_bits.bitwiseAND(POLICIES[policy]) == 0


def ablations(ledgers: DataFrame, policy: str = CURRENT) -> DataFrame:
    """Per rule of a policy: documents that fail it, that fail it alone, and that stay if the rule is left out.

    Counted over the distinct bit patterns (at most two to the number of rules), not over documents.
    """
    mask = POLICIES[policy]
    patterns = ledgers.groupBy(F.col("ledger")["fail_bits"].bitwiseAND(mask).alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    rules = [r for r in RULES if mask >> r.bit & 1]
    each = F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("bigint").alias("one")) for r in rules])).alias("r")
    n = lambda cond: F.sum(F.when(cond, F.col("n")).otherwise(F.lit(0)))
    one, bits = F.col("r")["one"], F.col("bits")
    return (
        patterns.select("bits", "n", each)
        .groupBy(F.col("r")["rule"].alias("rule"))
        .agg(n(bits.bitwiseAND(one) != 0).alias("n_failed"), n(bits == one).alias("n_failed_alone"), n(bits.bitwiseAND(F.bitwise_not(one)) == 0).alias("n_kept_without"))
    )


def filtered(docs: DataFrame, policy: str = CURRENT, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass the policy, with their columns unchanged."""
    return docs.filter(kept(ledger_of(F.col(text))["fail_bits"], policy))
