"""A training corpus from raw documents: language, near-duplicates, repeated passages, mix of sources, packed sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tramline.llm import language, minhash, mixing, packing, suffix
from tramline.llm.common import read, unused, written

SHINGLE = 5  # words

#: SQL can't express the kernel model, the suffix trees or the tokenizer; the stages are tested against brute force.
ORACLE_SQL = None


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents of no known language: null texts, texts without a letter and texts whose score is below the
    model's floor. Where no row has a label no language is known, and all texts with a letter stay."""
    pred, score = unused(docs, "lang_pred"), unused(docs, "lang_score")
    model = language.fit(docs.withColumn(pred, language.held_out()).where(~F.col(pred)).drop(pred))
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    rows = language.predict(docs, model, pred_col=pred, score_col=score)
    return rows.where((F.col(pred) != language.UNKNOWN) & (F.col(score) >= model.floor)).drop(pred, score)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the least id. Rows with equal id and text are one
    document. A null id, and one that several texts share, names no document: such rows are told apart by a hash of id
    and text, and come after all others."""
    mark, key, place = (unused(docs, n) for n in ("_mark", "_key", "_place"))
    text = F.xxhash64("text")
    shared = docs.where("doc_id is not null").groupBy("doc_id").agg(F.min(text).alias("x"), F.max(text).alias("y")).where("x <> y")
    shared = written(shared.select(F.col("doc_id").alias(mark)), "shared")
    keyed = docs.join(shared, docs["doc_id"] == shared[mark], "left")
    hashed = F.xxhash64("doc_id", "text").bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62))
    keyed = keyed.withColumn(key, F.when(F.col(mark).isNull() & F.col("doc_id").isNotNull(), F.col("doc_id").cast("long")).otherwise(hashed)).drop(mark)
    kept = minhash.near_duplicates(keyed, SHINGLE, id_col=key).where("kept").select(F.col("doc_id").alias(key)).distinct()
    rows = keyed.join(kept, key, "left_semi")
    first = Window.partitionBy(key).orderBy(F.xxhash64(*(F.col(f"`{c}`") for c in docs.columns)))
    return rows.withColumn(place, F.row_number().over(first)).where(F.col(place) == 1).select(*(F.col(f"`{c}`") for c in docs.columns))


def suffix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that came before in the corpus; characters that lose a byte go whole. n_chars follows."""
    cut = unused(docs, "_cut")
    rows = suffix.without_repeats(docs, into=cut)
    changed = F.col(f"{cut}.removed") > 0
    text = F.when(changed, suffix.as_text(F.col(f"{cut}.kept"))).otherwise(F.col("text"))
    rows = rows.withColumn("text", text).withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return rows.select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, dealt and sorted by their place in the mix, so that the files hold it in order."""
    names = tuple(unused(docs, n) for n in ("_block", "_slot", "_position"))
    return mixing.in_order(mixing.mix(docs, names=names, most=None), names[2]).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences, with a checksum of their token ids. Ranges of the mix are packed in its order, so
    sequence ids follow it from range to range."""
    pieces = packing.pack(mixing.as_written(docs), packing.default_vocabulary())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("language", language_stage),
    ("near_duplicates", near_stage),
    ("repeated_passages", suffix_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another; what each keeps is written as Parquet in the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
