"""Sharding by jump consistent hashing of a stable key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import ranked, read

SHARDS = 16


def jump(keys, shards: int):
    """Shards 0..shards-1 of unsigned 64-bit keys (Lamping and Veach, 2014), a whole array at a time."""
    import numpy as np

    state = keys.astype(np.uint64)
    shard, ahead = np.zeros(len(state), np.int64), np.zeros(len(state), np.int64)
    active = np.arange(len(state))
    while len(active):
        shard[active] = ahead[active]
        with np.errstate(over="ignore"):
            state[active] = state[active] * np.uint64(2862933555777941757) + np.uint64(1)
        step = float(1 << 31) / ((state[active] >> np.uint64(33)).astype(np.float64) + 1)
        ahead[active] = np.floor((shard[active] + 1) * step).astype(np.int64)
        active = active[ahead[active] < shards]
    return shard


def shard_of(key: Column, shards: int) -> Column:
    """The shard of an integer key; a null key is placed as 0."""

    @pandas_udf("int")
    def place(keys):
        import numpy as np
        import pandas as pd

        return pd.Series(jump(keys.to_numpy(dtype=np.int64).view(np.uint64), shards).astype(np.int32))

    return place(F.coalesce(key.cast("long"), F.lit(0)))


def shard(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    The id and the number of shards alone decide the shard, so nothing is read or balanced beforehand; with one more
    shard (grown_shard) rows move into the new shard only. slot numbers each shard's rows from 0 without a gap. A null
    text has size 1 and checksum 0 as an empty one has; a null id is placed as 0; repeated ids share a shard and have
    slots of their own; other columns are not read.
    """
    data = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(data) + 1).cast("long").alias("size"), F.crc32(data).alias("text_crc32")
    )
    rows = rows.withColumns({"shard": shard_of(F.col("doc_id"), shards), "grown_shard": shard_of(F.col("doc_id"), shards + 1)})
    by = [F.col("doc_id"), F.col("text_crc32"), F.col("size")]
    return ranked(rows, ["shard"], by, by, "slot").select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, id_col: str = "doc_id") -> None:
    """Writes docs as Parquet under path/shard=N, each task writing the part of every shard that it has read."""
    docs.withColumn("shard", shard_of(F.col(id_col), shards)).write.partitionBy("shard").parquet(path)


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(read(spark, sf_dir, "documents"))


def _times(x: str, by: int) -> str:
    return f"({x}::UHUGEINT * {by}::UHUGEINT % {1 << 64}::UHUGEINT)"


def _turned(x: str, by: int) -> str:
    return f"({x}::UHUGEINT * {1 << by}::UHUGEINT % {1 << 64}::UHUGEINT + {x}::UHUGEINT // {1 << 64 - by}::UHUGEINT)"


def _xor(x: str, y: str) -> str:
    return f"xor({x}::UBIGINT, {y}::UBIGINT)"


def _hash_sql(table: str, columns: list[str]) -> tuple[str, str]:
    """CTEs that add the XXH64 hash of 64-bit columns, each seeded by the one before, and the name of the last CTE."""
    p1, p2, p3, p4, p5 = 11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261
    ctes, word = [], 1 << 64

    def step(expression: str) -> None:
        nonlocal table
        ctes.append(f"{table}_ AS (SELECT * EXCLUDE (s), ({expression})::UHUGEINT AS s FROM {table})")
        table += "_"

    for c in columns:
        unsigned = f"(CASE WHEN {c} < 0 THEN {c}::HUGEINT + {word} ELSE {c} END)"
        step(f"CASE WHEN {c} IS NULL THEN s ELSE {_xor(f'((s + {p5 + 8}) % {word})', _times(_turned(_times(unsigned, p2), 31), p1))} END")
        step(f"CASE WHEN {c} IS NULL THEN s ELSE ({_times(_turned('s', 27), p1)} + {p4}) % {word} END")
        for shift, by in ((33, p2), (29, p3), (32, 1)):
            step(f"CASE WHEN {c} IS NULL THEN s ELSE {_times(_xor('s', f'(s // {1 << shift})'), by)} END")
    return ",\n".join(ctes), table


_HASH, _HASHED = _hash_sql("sized", ["doc_id", "text_crc32", "size"])

#: CRC-32 byte by byte, jump hashing by recursion, and slots in the order of the 1024 buckets by which they are dealt.
ORACLE_SQL = f"""
WITH RECURSIVE bits AS (
  SELECT list(list_reduce(range(8), lambda c, k: xor(c >> 1, 3988292384 * (c & 1)), i) ORDER BY i) AS t FROM range(256) AS r(i)
), texts AS (
  SELECT doc_id::BIGINT AS doc_id, encode(coalesce(text, '')) AS data FROM documents
), sized AS (
  SELECT row_number() OVER () AS r, doc_id, octet_length(data)::BIGINT + 1 AS size, 42::UHUGEINT AS s,
    xor(list_reduce(list_transform(regexp_extract_all(hex(data), '..'), lambda x: ('0x' || x)::BIGINT),
      lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295::BIGINT), 4294967295)::BIGINT AS text_crc32
  FROM texts, bits
), {_HASH}, jumps AS (
  SELECT r, n, -1::BIGINT AS shard, 0::BIGINT AS ahead, (CASE WHEN doc_id < 0 THEN doc_id::HUGEINT + {1 << 64} ELSE coalesce(doc_id, 0) END)::UHUGEINT AS state
  FROM sized, (VALUES ({SHARDS}), ({SHARDS + 1})) AS v(n)
  UNION ALL
  SELECT r, n, ahead, floor((ahead + 1) * (2147483648.0::DOUBLE / ((next // 8589934592)::DOUBLE + 1)))::BIGINT, next
  FROM (SELECT *, ({_times("state", 2862933555777941757)} + 1) % {1 << 64} AS next FROM jumps WHERE ahead < n)
), placed AS (
  SELECT r, max(shard) FILTER (n = {SHARDS}) AS shard, max(shard) FILTER (n = {SHARDS + 1}) AS grown_shard FROM jumps GROUP BY r
)
SELECT doc_id, size, text_crc32, 'key' AS law, shard::INT AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY s % 1024, doc_id NULLS FIRST, text_crc32, size) - 1 AS slot, grown_shard::INT AS grown_shard
FROM {_HASHED} JOIN placed USING (r)
"""
