"""Quality rules as a bitmask ledger: every rule is evaluated once, policies and ablations only read bits. Column expressions only.

ledger() measures each text once and stores a failure bit per rule beside the measurements. A policy is a name, a version and a mask
of rules; verdicts() keeps a row if none of the policy's bits failed, without touching the text again. ablations() counts the rows by
bit pattern (as many as patterns occur, 2 ** len(RULES) at most) and answers for every policy, and for every rule left out of it, how
many rows stay.

Everything is computed within the row: a text is never exploded into rows, so nothing is shuffled and a hot source costs nothing.
A null text has no words. An empty text fails the length rule. Repeated rows and null ids stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pcmarts.llm.common import WORD, let

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_bars", "n_lines")


def _repeated(words: Column) -> Column:
    """Words that lie in a 3-word window which occurs at least twice."""

    def of_hashes(windows: Column) -> Column:
        # Windows sorted by hash, then place: a window that has its like beside it is repeated.
        ordered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        same = lambda s, x, k: F.coalesce(F.get(s, k)["h"] == x["h"], F.lit(False))
        twice = let(ordered, lambda s: F.transform(F.filter(s, lambda x, k: same(s, x, k - 1) | same(s, x, k + 1)), lambda x: x["i"]))
        reach = lambda ps: F.aggregate(F.transform(ps, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(ps, k + 1) - p, F.lit(3)))), F.lit(0), lambda a, x: a + x)
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(let(F.sort_array(twice), reach))

    def of_words(ws: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(0), F.size(ws) - 3), lambda i: F.xxhash64(F.get(ws, i), F.get(ws, i + 1), F.get(ws, i + 2)))
        return F.when(F.size(ws) < 4, F.lit(0)).otherwise(let(hashes, of_hashes))

    return let(words, of_words).cast("bigint")


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with the columns MEASURES."""
    whole = F.coalesce(F.col(text), F.lit(""))
    words = F.regexp_extract_all(whole, F.lit(WORD), F.lit(0))
    lines = F.filter(F.split(whole, "\n", -1), lambda x: x.rlike(WORD))
    only = lambda chars: F.length(F.regexp_replace(whole, f"[^{chars}]+", "")).cast("bigint")
    out = docs.withColumn("_words", words).withColumn("_lines", lines)
    out = out.withColumns({
        "n_words": F.size("_words").cast("bigint"),
        "word_chars": F.length(F.regexp_replace(whole, r"[\x20\x09-\x0D]+", "")).cast("bigint"),
        "n_symbols": only(r"#*$%&|<>"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"),
        "n_repeat_words": _repeated(F.col("_words")),
        "n_upper": only(r"\p{Lu}"),
        "n_bars": only(r"|!"),
        "n_lines": F.size("_lines").cast("bigint"),
    })
    return out.drop("_words", "_lines")


# The rules in the order of their bits: name and condition of failure on the measurements. Shares are written without division.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 25 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "repeated_lines": "n_lines >= 4 and 10 * n_dup_lines > 3 * n_lines",
    "capitals": "10 * n_upper > 4 * word_chars",
    "bars": "10 * n_bars > 3 * n_words",
}

# Policies: (name, version) and the rules that reject. `base` states the two rules that every version keeps.
POLICIES: dict[tuple[str, int], tuple[str, ...]] = {
    ("base", 1): ("few_words", "repeated_words"),
    ("web", 1): ("few_words", "repeated_words", "short_words", "long_words", "symbols"),
    ("web", 2): tuple(RULES),
}
CURRENT = ("web", 2)


def bit(rule: str) -> int:
    return 1 << list(RULES).index(rule)


def mask(policy: tuple[str, int]) -> int:
    return sum(bit(rule) for rule in POLICIES[policy])


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs without the text, with the measurements and `failed`, a bit for each rule that failed."""
    rows = measured(docs, text).drop(text)
    bits = [F.when(F.expr(fails), F.lit(bit(rule))).otherwise(0).cast("bigint") for rule, fails in RULES.items()]
    total = bits[0]
    for b in bits[1:]:
        total = total.bitwiseOR(b)
    return rows.withColumn("failed", total)


def verdict(policy: tuple[str, int] = CURRENT) -> Column:
    """Whether a row of the ledger passes every rule of a policy."""
    return F.col("failed").bitwiseAND(F.lit(mask(policy)).cast("bigint")) == 0


def ablations(rows: DataFrame) -> DataFrame:
    """(policy, version, left_out, kept, kept_more): rows that stay under each policy as it is (left_out null) and without each rule."""
    patterns = rows.groupBy("failed").agg(F.count("*").alias("n"), F.bit_or("failed").alias("seen"))
    cases = [(name, version, rule, mask((name, version)) & ~(bit(rule) if rule else 0)) for (name, version), rules in POLICIES.items() for rule in (None, *rules)]
    entries = F.array(*(F.struct(F.lit(p).alias("policy"), F.lit(v).alias("version"), F.lit(r).cast("string").alias("left_out"), F.lit(m).cast("bigint").alias("mask")) for p, v, r, m in cases))
    each = patterns.select("failed", "n", F.explode(entries).alias("c")).select("failed", "n", "c.*")
    kept = F.sum(F.when(F.col("failed").bitwiseAND(F.col("mask")) == 0, F.col("n")).otherwise(0))
    whole = F.lit(None).cast("bigint")
    for (name, version) in POLICIES:
        m = F.lit(mask((name, version))).cast("bigint")
        whole = F.when((F.col("policy") == name) & (F.col("version") == version), m).otherwise(whole)
    more = F.sum(F.when((F.col("failed").bitwiseAND(F.col("mask")) == 0) & (F.col("failed").bitwiseAND(whole) != 0), F.col("n")).otherwise(0))
    return each.groupBy("policy", "version", "left_out").agg(kept.alias("kept"), more.alias("kept_more"))
