"""Language identification: blended-spectrum presence kernels, Nystroem landmarks, one-versus-rest kernel ridge regression."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read, small_batches, unused

BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
TRAIN_ROWS = 2000  # at most about so many labelled rows are fitted, shared evenly by the languages
LANDMARKS = 200
RIDGE = 1e-2
UNKNOWN = "und"
SHARPNESS = 4  # of the softmax
_CHUNK = 1 << 20


def grams(text: str):
    """Buckets of the byte 1-, 2- and 3-grams of the lower-cased text, with repeats; a chunk at a time for long texts."""
    import numpy as np

    data = np.frombuffer(text.lower().encode("utf-8", "ignore"), np.uint8).astype(np.uint32)
    for start in range(0, max(len(data), 1), _CHUNK):
        part = data[start : start + _CHUNK + max(ORDERS) - 1]
        code = np.zeros(len(part), np.uint32)
        for n in ORDERS:
            code = code[: max(len(part) - n + 1, 0)] * np.uint32(257) + part[n - 1 :] + np.uint32(1)
            yield ((code * np.uint32(2654435761)) >> np.uint32(17)) & np.uint32(BUCKETS - 1)


def presence(texts: list[str]):
    """0/1 rows of float32, one per text."""
    import numpy as np

    x = np.zeros((len(texts), BUCKETS), np.float32)
    for row, text in zip(x, texts, strict=True):
        for found in grams(text):
            row[found] = 1
    return x


def has_letter(text: str | None) -> bool:
    return bool(text) and any(c.isalpha() for c in text)


@dataclass
class Model:
    languages: list[str]
    weights: object  # BUCKETS x languages: the landmarks' presence rows times their dual coefficients
    floor: float = 0.0  # a text that scores less has no sign of any of the languages

    def scores(self, x):
        """Ridge outputs (1 for the language, -1 for the rest) of presence rows."""
        import numpy as np

        return (x @ self.weights) / np.sqrt(np.maximum(x.sum(axis=1, keepdims=True), 1))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", train_rows: int = TRAIN_ROWS, landmarks: int = LANDMARKS) -> Model:
    """Fits on a sample of rows with a language and a letter, drawn by a hash of id and text.

    The sample is bounded: about train_rows rows, at equal shares of the languages, of which only packed presence bits
    (BUCKETS / 8 bytes a row) come to the driver. There the kernel k(x, y) = |x and y| / sqrt(|x| |y|) against the
    landmarks, rows of the sample taken in turn from each language, is mapped by the inverse square root of the
    landmarks' kernel (Nystroem), and a ridge regression against -1/1 targets is solved for each language.
    """
    import numpy as np

    rows = small_batches(docs).select(F.col(text_col).alias("t"), F.col(lang_col).alias("g"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("h")).where(
        "t is not null and g is not null"
    )
    counts = {r["g"]: r["n"] for r in rows.groupBy("g").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return Model([], np.zeros((BUCKETS, 0), np.float32))
    share = max(train_rows // len(counts), 1)
    parts = 1 << 20
    limit = F.coalesce(*(F.when(F.col("g") == g, F.lit(min(parts, parts * share // n + 1))) for g, n in counts.items()))

    def bits(batches):
        import pandas as pd

        for b in batches:
            b = b[[has_letter(t) for t in b["t"]]]
            for start in range(0, len(b), 64):
                part = b.iloc[start : start + 64]
                packed = np.packbits(presence(list(part["t"])).astype(np.uint8), axis=1)
                yield pd.DataFrame({"g": part["g"].to_numpy(), "h": part["h"].to_numpy(), "x": [r.tobytes() for r in packed]})

    # Rows equal in id, text and language are one, so a row that is repeated without end doesn't fill the sample.
    sample = rows.where(F.pmod("h", F.lit(parts)) < limit).dropDuplicates(["g", "h"]).mapInPandas(bits, "g string, h long, x binary").collect()
    sample = sorted(sample, key=lambda r: (r["g"], r["h"], r["x"]))
    languages = sorted({r["g"] for r in sample})
    if not sample:
        return Model([], np.zeros((BUCKETS, 0), np.float32))

    def unpack(rows):
        return np.unpackbits(np.stack([np.frombuffer(r["x"], np.uint8) for r in rows]), axis=1).astype(np.float32)

    by = {g: [r for r in sample if r["g"] == g] for g in languages}
    turns = [by[g][i] for i in range(max(map(len, by.values()))) for g in languages if i < len(by[g])]
    chosen = unpack(turns[:landmarks])
    sizes = np.sqrt(np.maximum(chosen.sum(axis=1), 1))
    chosen /= sizes[:, None]

    def kernel(rows):
        x = unpack(rows)
        return (x @ chosen.T) / np.sqrt(np.maximum(x.sum(axis=1, keepdims=True), 1))

    k_nm = np.concatenate([kernel(sample[i : i + 100]) for i in range(0, len(sample), 100)]).astype(np.float64)
    values, vectors = np.linalg.eigh(kernel(turns[:landmarks]).astype(np.float64))
    good = values > 1e-6 * max(values.max(), 1e-12)
    root = vectors[:, good] / np.sqrt(values[good])
    phi = np.hstack([k_nm @ root, np.ones((len(sample), 1))])
    y = np.array([[1.0 if r["g"] == g else -1.0 for g in languages] for r in sample])
    beta = np.linalg.solve(phi.T @ phi + RIDGE * np.eye(phi.shape[1]), phi.T @ y)
    # Half way from the score of no evidence to the least score of a fitted row whose language is found.
    outputs = k_nm @ (root @ beta[:-1])
    found = outputs.argmax(axis=1) == y.argmax(axis=1)
    tops = 1 / np.exp(SHARPNESS * (outputs - outputs.max(axis=1, keepdims=True))).sum(axis=1)
    floor = (1 / len(languages) + tops[found].min()) / 2 if found.any() else 0.0
    # A constant output moves all documents of a language alike; it is left out so that a score is a kernel sum.
    return Model(languages, np.ascontiguousarray(chosen.T @ (root @ beta[:-1]), dtype=np.float32), float(floor))


def predict(docs: DataFrame, model: Model, text_col: str = "text", pred_col: str = "lang_pred", score_col: str = "score") -> DataFrame:
    """docs with the predicted language and its score (0 to 1, a softmax of the ridge outputs).

    A null text, a text without a letter, and every text when nothing was learned are ``und`` with score 0. Whole texts
    count, whatever their length. Equal texts get equal rows; ties go to the first language in order. All columns are
    kept; columns named like the two new ones are replaced.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    kept = small_batches(docs).drop(pred_col, score_col)

    @F.pandas_udf(f"{pred_col} string, {score_col} double")
    def judge(texts):
        import numpy as np
        import pandas as pd

        m = held.value
        out = pd.DataFrame({pred_col: [UNKNOWN] * len(texts), score_col: np.zeros(len(texts))})
        good = [i for i, t in enumerate(texts) if m.languages and has_letter(t)]
        for start in range(0, len(good), 64):
            at = good[start : start + 64]
            s = m.scores(presence([texts.iloc[i] for i in at])).astype(np.float64)
            best = s.argmax(axis=1)
            e = np.exp(SHARPNESS * (s - s.max(axis=1, keepdims=True)))
            out.loc[at, pred_col] = [m.languages[b] for b in best]
            out.loc[at, score_col] = 1 / e.sum(axis=1)
        return out

    new = unused(kept, "_lang")
    return kept.withColumn(new, judge(F.col(text_col))).select(*(F.col(f"`{c}`") for c in kept.columns), f"{new}.{pred_col}", f"{new}.{score_col}")


def held_out() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", held_out())
    model = fit(docs.where("not held_out"))
    return predict(docs.select("doc_id", "held_out", "text"), model).select("doc_id", "held_out", "lang_pred", "score")
