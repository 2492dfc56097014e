"""Quality rules as a bitmask ledger: every rule is evaluated once, policies and ablations are bit operations.

Built of DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read, unused

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 5

#: Rule -> failure condition over the measurements. The position of a rule is its bit: append only.
RULES = {
    "few_words": "n_words < 10",
    "repeats": "100 * n_repeat_words > 20 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "dup_lines": "2 * n_dup_lines > n_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 15 * n_words",
    "shouting": "2 * n_upper > n_letters",
    "few_letters": "2 * n_letters < word_chars",
    "bangs": "10 * n_bangs > 3 * n_words",
}
BASE = ("few_words", "repeats")


@dataclass(frozen=True)
class Policy:
    """A version and the rules whose failure drops a document."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << list(RULES).index(r) for r in self.rules)


POLICIES = (
    Policy("v1", BASE),
    Policy("v2", (*BASE, "symbols", "short_words", "long_words", "few_letters")),
    Policy("v3", tuple(RULES)),
)


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value) with value computed once, whatever the number of its uses."""
    return F.element_at(F.transform(F.array(value), then), 1)


def repeated_words(words: Column) -> Column:
    """Words within windows of WINDOW words that occur twice or more, the first included.

    Windows are compared by 64-bit hashes. Sorting (hash, place) brings equal windows together, so a text of n words
    costs n log n. Each place that is found covers the words from it on that the place before doesn't cover.
    """
    last = F.size(words) - WINDOW  # place of the last window
    places = F.when(last >= 1, F.sequence(F.lit(0), F.greatest(last, F.lit(1)))).otherwise(F.array().cast("array<int>"))
    hashed = F.transform(places, lambda i: F.struct(F.xxhash64(*(F.get(words, i + j) for j in range(WINDOW))).alias("h"), i.alias("i")))

    def again(s: Column) -> Column:
        def near(x: Column, k: Column) -> Column:
            return F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False))

        return F.array_sort(F.transform(F.filter(s, near), lambda x: x["i"]))

    def covered(found: Column) -> Column:
        start = F.struct(F.lit(-WINDOW).alias("at"), F.lit(0).alias("n"))
        step = lambda acc, i: F.struct(i.alias("at"), (acc["n"] + F.least(F.lit(WINDOW), i - acc["at"])).alias("n"))
        return F.aggregate(found, start, step, lambda acc: acc["n"])

    return let(F.array_sort(hashed), lambda s: let(again(s), covered)).cast("long")


def measurements(text: Column) -> dict[str, Column]:
    """What the rules look at; a null text measures as an empty one."""
    text = F.coalesce(text, F.lit(""))
    count = lambda pattern: F.length(F.regexp_replace(text, pattern, "")).cast("long")
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.translate(x, " \t\n\x0b\x0c\r", "") != "")
    symbols = F.length(text) - F.length(F.translate(text, SYMBOLS, ""))
    line_counts = let(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("d")))
    return {
        "word_counts": let(words, lambda w: F.struct(F.size(w).cast("long").alias("n"), repeated_words(w).alias("r"))),
        "word_chars": F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long"),
        "n_symbols": symbols.cast("long"),
        "line_counts": line_counts,
        "n_upper": count(r"\P{Lu}+"),
        "n_letters": count(r"\P{L}+"),
        "n_bangs": (F.length(text) - F.length(F.translate(text, "!?", ""))).cast("long"),
    }


MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper", "n_letters", "n_bangs")


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: doc_id, the measurements and fail_bits, bit i set if rule i fails.

    One pass without a shuffle. Null and empty texts have no words, so they fail few_words; repeated rows and null ids
    have rows of their own; other columns are not read; an empty table gives an empty ledger.
    """
    m = docs.select(F.col(id_col).alias("doc_id"), *(c.alias(n) for n, c in measurements(F.col(text_col)).items()))
    m = m.select(
        "doc_id", F.col("word_counts.n").alias("n_words"), "word_chars", "n_symbols",
        F.col("line_counts.n").cast("long").alias("n_lines"), F.col("line_counts.d").cast("long").alias("n_dup_lines"),
        F.col("word_counts.r").alias("n_repeat_words"), "n_upper", "n_letters", "n_bangs",
    )
    bits = [F.when(F.expr(rule), F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, rule in enumerate(RULES.values())]
    total = bits[0]
    for b in bits[1:]:
        total = total.bitwiseOR(b)
    return m.withColumn("fail_bits", total)


def apply_policy(rows: DataFrame, policy: Policy, into: str = "kept") -> DataFrame:
    """Adds whether a ledger's row passes all rules of the policy. No text is read again."""
    return rows.withColumn(into, F.col("fail_bits").bitwiseAND(F.lit(policy.mask).cast("long")) == 0)


def ablations(rows: DataFrame, policies: tuple[Policy, ...] = POLICIES) -> DataFrame:
    """For each policy and rule of it: documents kept, documents that fail the rule, and those that the policy would gain
    without it. One aggregation over the ledger's distinct bit patterns (at most 2 to the number of rules)."""
    patterns = rows.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("n"))
    bits = F.col("fail_bits")
    cases = []
    for p in policies:
        for r in p.rules:
            bit = F.lit(1 << list(RULES).index(r)).cast("long")
            failed = bits.bitwiseAND(F.lit(p.mask).cast("long"))
            cases.append(F.struct(F.lit(p.version).alias("policy"), F.lit(r).alias("rule"), (failed == 0).alias("kept"), (bits.bitwiseAND(bit) != 0).alias("fails"), (failed == bit).alias("alone")))
    flat = patterns.select("n", F.explode(F.array(*cases)).alias("c")).select("n", "c.*")
    total = lambda c: F.coalesce(F.sum(F.when(F.col(c), F.col("n"))), F.lit(0)).alias(f"n_{c}")
    return flat.groupBy("policy", "rule").agg(total("kept"), total("fails"), total("alone"))


def with_ledger(docs: DataFrame, policy: Policy = POLICIES[-1], text_col: str = "text") -> DataFrame:
    """docs as they are, without the rows that the policy drops."""
    key = unused(docs, "_row")
    rows = docs.withColumn(key, F.struct(*(c.alias(n) for n, c in measurements(F.col(text_col)).items())))
    flat = {"n_words": "word_counts.n", "n_repeat_words": "word_counts.r", "n_lines": "line_counts.n", "n_dup_lines": "line_counts.d"}
    keep = F.lit(True)
    for r in policy.rules:
        rule = RULES[r]
        for m in MEASURES:
            rule = " ".join(f"`{key}`.{flat.get(m, m)}" if w == m else w for w in rule.split(" "))
        keep = keep & ~F.expr(rule)
    return rows.where(keep).drop(key)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = apply_policy(ledger(read(spark, sf_dir, "documents")), POLICIES[-1])
    base = F.col("fail_bits").bitwiseAND(F.lit(POLICIES[0].mask).cast("long")) != 0
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), "kept", "fail_bits")


ORACLE_SQL = r"""
WITH w AS (
  SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text FROM documents
), m AS (
  SELECT *, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    length(regexp_replace(text, '\P{Lu}', '', 'g')) AS n_upper,
    length(regexp_replace(text, '\P{L}', '', 'g')) AS n_letters,
    length(regexp_replace(text, '[^!?]', '', 'g')) AS n_bangs
  FROM w
), grams AS (
  SELECT row_id, i, words[i:i + 4] AS gram FROM m, unnest(range(1, len(words) - 3)) AS r(i)
), places AS (
  SELECT row_id, i FROM (SELECT row_id, i, count(*) OVER (PARTITION BY row_id, gram) AS n FROM grams) WHERE n > 1
), repeats AS (
  SELECT row_id, count(DISTINCT i + j) AS n FROM places, unnest(range(5)) AS r(j) GROUP BY row_id
), counted AS (
  SELECT m.*, len(words) AS n_words, len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars, coalesce(n, 0) AS n_repeat_words
  FROM m LEFT JOIN repeats USING (row_id)
), judged AS (
  SELECT *, (CASE WHEN n_words < 10 THEN 1 ELSE 0 END) | (CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END)
    | (CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END) | (CASE WHEN 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END)
    | (CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END) | (CASE WHEN word_chars > 15 * n_words THEN 32 ELSE 0 END)
    | (CASE WHEN 2 * n_upper > n_letters THEN 64 ELSE 0 END) | (CASE WHEN 2 * n_letters < word_chars THEN 128 ELSE 0 END)
    | (CASE WHEN 10 * n_bangs > 3 * n_words THEN 256 ELSE 0 END) AS fail_bits
  FROM counted
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, (fail_bits & 3) <> 0 AS base_failed,
  fail_bits = 0 AS kept, fail_bits::BIGINT AS fail_bits
FROM judged
"""
