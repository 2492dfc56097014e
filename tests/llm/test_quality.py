from __future__ import annotations

import re
from collections import Counter

import duckdb
import pytest

from tramline.llm import catalog, quality


def brute(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0d]+", text) if w]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    n = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if n[w] > 1 for j in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


CASES = [(1, None), (2, ""), (3, "a b c d e a b c d e"), (4, "x\nx\n \n\ny\nx"), (5, "é# *$ %&|<> \t\x0b\x0c\r z"), (6, "a a a a a a"), (7, "a a a a a"), (None, "one two"), (8, " ".join(f"w{i % 977}" for i in range(30_000)))]


def test_measurements_match_brute_force(spark, corpus):
    rows = CASES + corpus
    got = quality.ledger(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    key = lambda d: (d is None, d or 0)
    assert sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got), key=lambda x: (key(x[0]), x[1:])) == sorted(
        ((d, *brute(t)) for d, t in rows), key=lambda x: (key(x[0]), x[1:])
    )


def test_policies_and_ablations_are_bit_operations(spark, corpus):
    rows = quality.ledger(spark.createDataFrame(corpus, "doc_id long, text string")).cache()
    bits = [r.fail_bits for r in rows.collect()]
    for p in quality.POLICIES:
        assert quality.apply_policy(rows, p).where("kept").count() == sum(b & p.mask == 0 for b in bits)
    for r in quality.ablations(rows).collect():
        p = next(p for p in quality.POLICIES if p.version == r.policy)
        bit = 1 << list(quality.RULES).index(r.rule)
        assert (r.n_kept, r.n_fails, r.n_alone) == (sum(b & p.mask == 0 for b in bits), sum(b & bit != 0 for b in bits), sum(b & p.mask == bit for b in bits))


def test_filter_agrees_with_the_ledger(spark, corpus):
    docs = spark.createDataFrame([(d, t, 1) for d, t in corpus], "doc_id long, text string, _row int")
    kept = quality.with_ledger(docs)
    assert kept.columns == docs.columns
    assert kept.count() == quality.apply_policy(quality.ledger(docs), quality.POLICIES[-1]).where("kept").count()


def test_empty_table(spark):
    assert quality.ledger(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_sql(spark, name):
    sf = "/root/testdata/sf0.001"
    for table in ("documents", "embeddings"):
        duckdb.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    df = catalog.queries()[name](spark, sf)
    want = duckdb.sql(catalog.oracle_sql()[name])
    at = [want.columns.index(c) for c in sorted(df.columns)]
    assert sorted(tuple(r[c] for c in sorted(df.columns)) for r in df.collect()) == sorted(tuple(r[i] for i in at) for r in want.fetchall())
