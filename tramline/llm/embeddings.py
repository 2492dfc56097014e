"""Near-duplicate vectors by int8 tile products with error bounds, confirmed in double precision."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, joined_labels, ranked, read, small_batches, written

THRESHOLD = 0.93
TILE = 2048


def quantised(x):
    """Unit rows of x as int8 codes q with scales s, and the lengths e of the errors: x = s q + r, |r| <= e."""
    import numpy as np

    top = np.abs(x).max(axis=1)
    scale = np.where(top > 0, top / 127, 1)
    q = np.rint(x / scale[:, None]).astype(np.int8)
    error = np.linalg.norm(x - scale[:, None] * q, axis=1) * (1 + 1e-9) + 1e-12
    return q, scale, error


def tile_pairs(x, y, threshold: float, rows: int = 512):
    """x, y: (codes, scales, errors) of two tiles. Yields (first row, (i, j), (i, j)): the pairs x[first row + i], y[j] that
    reach the threshold for certain, and those that may.

    Products of codes are whole numbers below 2 to the 24 for up to 1040 dimensions, so a float32 product of them is
    exact; wider vectors are multiplied in parts. With x = x' + r and y = y' + t, x y = x' y' + x' t + r y' + r t, so the
    error of the codes' product is at most |x'| |t| + |r| |y'| + |r| |t|.
    """
    import numpy as np

    (qx, sx, ex), (qy, sy, ey) = x, y
    nx, ny = 1 + ex, 1 + ey  # lengths of the coded rows are no more than these
    for start in range(0, len(qx), rows):
        part = slice(start, start + rows)
        product = np.zeros((len(qx[part]), len(qy)))
        for d in range(0, qx.shape[1], 1024):
            product += qx[part, d : d + 1024].astype(np.float32) @ qy[:, d : d + 1024].astype(np.float32).T
        product *= sx[part, None] * sy[None]
        bound = nx[part, None] * ey[None] + ex[part, None] * ny[None] + ex[part, None] * ey[None] + 1e-9
        certain = product - bound >= threshold
        yield start, np.nonzero(certain), np.nonzero((product + bound >= threshold) & ~certain)


def unit(v):
    """The vectors as rows of length 1, in double precision."""
    import numpy as np

    x = np.stack(v.to_numpy()).astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)  # no overflow in the lengths
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def coded(batches):
    """Adds q, scale and error, the int8 code of each vector, to rows with columns width and v."""
    import pandas as pd

    for batch in batches:
        parts = [batch.iloc[:0].assign(q=None, scale=0.0, error=0.0)]
        for _, part in batch.groupby("width"):
            q, scale, error = quantised(unit(part["v"]))
            parts.append(part.assign(q=[row.tobytes() for row in q], scale=scale, error=error))
        yield pd.concat(parts[1:] or parts, ignore_index=True)


def compared(pdf, i: int, j: int, threshold: float, exact: bool):
    """The rows of tiles i and j: links and a spanning forest of the pairs that are certain by their codes, and the places
    of those that are not (open); or, if exact, of the uncertain ones that reach the threshold in double precision."""
    import numpy as np
    import pandas as pd

    pdf = pdf.sort_values("place", kind="stable")
    place, copies, tile = pdf["place"].to_numpy(), pdf["copies"].to_numpy(), pdf["tile"].to_numpy()
    codes = np.stack([np.frombuffer(q, np.int8) for q in pdf["q"]]), pdf["scale"].to_numpy(), pdf["error"].to_numpy()
    x = unit(pdf["v"]) if exact else None
    left, right = np.flatnonzero(tile == i), np.flatnonzero(tile == j)
    counts, unsure = np.zeros(len(pdf), np.int64), np.zeros(len(pdf), bool)
    own, low, high = np.arange(len(pdf)), [], []
    for start, certain, maybe in tile_pairs(*([c[side] for c in codes] for side in (left, right)), threshold):
        for (a, b), settled in ((certain, True), (maybe, False)):
            if exact and settled:
                continue
            a, b = left[start + a], right[b]
            if i == j:
                a, b = a[a < b], b[a < b]
            if exact:
                good = [np.einsum("ij,ij->i", x[a[k : k + 100_000]], x[b[k : k + 100_000]]) >= threshold for k in range(0, len(a), 100_000)]
                good = np.concatenate(good or [np.zeros(0, bool)])
                a, b = a[good], b[good]
            elif not settled:
                unsure[a] = unsure[b] = True
                continue
            np.add.at(counts, a, copies[b])
            np.add.at(counts, b, copies[a])
            if len(a):
                joined = joined_labels(own, a, b)
                low.append(joined[0])
                high.append(joined[1])
    if low:
        low, high = joined_labels(own, np.concatenate(low), np.concatenate(high))
    at = np.flatnonzero((counts > 0) | unsure)
    found = pd.DataFrame({"place": place[at], "links": counts[at], "open": unsure[at].astype(np.int64)})
    joined = pd.DataFrame({"a": place[np.asarray(low, np.int64)], "b": place[np.asarray(high, np.int64)]})
    return pd.concat([found, joined], ignore_index=True).reindex(columns=["place", "links", "open", "a", "b"]).astype("Int64")


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, tile: int = TILE, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """A row per vector: vec_id, n_links, component_id, kept.

    Vectors with equal labels are linked when their cosine in double precision is at least ``threshold``. A vector that
    is null, empty or zero or holds a null or a non-finite component, and one with a null label, links with nothing;
    vectors of different lengths don't link. Rows that share an id are one node for components; each is its own vector
    for counts. A null id has a null component and is kept; its links count. Extra columns are not read.

    Equal vectors of a label are one class, whose copies count as links but aren't compared. Classes are coded once and
    each label's are cut into tiles of ``tile`` rows; each two tiles are a group of their own, to which only the codes are
    sent. It returns counts and a spanning forest of the links that are certain by the error bounds, and names the rows of
    the pairs that are not; only these rows go once more, with their doubles. So what is shuffled does not grow with the
    links. All pairs of a label are products of tiles: work, and the copies of codes, grow with the square of its classes.
    """
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), v.alias("v"))
    finite = F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    usable = F.col("label").isNotNull() & F.col("v").isNotNull() & F.coalesce(finite, F.lit(False)) & F.coalesce(F.exists("v", lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("usable", usable).withColumn("hash", F.xxhash64("v"))
    classes = rows.where("usable").groupBy("label", "v", "hash").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    classes = classes.withColumn("width", F.size("v"))
    classes = ranked(classes, ["label", "width"], [F.col("hash")], [F.col("hash"), F.col("v")], "place")
    classes = classes.select("label", "width", "place", F.floor(F.col("place") / tile).cast("int").alias("tile"), "rep", "copies", "v")
    code = "label string, width int, place long, tile int, rep long, copies long, v array<double>, q binary, scale double, error double"
    classes = written(small_batches(classes).mapInPandas(coded, code), "classes")
    tiles = classes.groupBy("label", "width").agg(F.max("tile").alias("last"))
    group, sent = ["label", "width", "i", "j"], ["tile", "place", "copies", "q", "scale", "error"]
    dealt = classes.select("label", "width", *sent).join(tiles, ["label", "width"]).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("last"))))
    dealt = dealt.select("label", "width", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"), *sent)

    def compare(exact):
        def units(key, pdf):
            out = compared(pdf, key[2], key[3], threshold, exact)
            for k, (name, value) in enumerate(zip(group, key, strict=True)):
                out.insert(k, name, value)
            return out

        return units

    schema = "label string, width int, i int, j int, place long, links long, open long, a long, b long"
    certain = written(dealt.groupBy(*group).applyInPandas(compare(False), schema), "tiles")
    unsure = certain.where("open = 1").select(*group, "place").join(classes.drop("rep"), ["label", "width", "place"])
    found = certain.unionByName(written(unsure.groupBy(*group).applyInPandas(compare(True), schema), "tiles"))
    counts = found.where("place is not null").groupBy("label", "width", "place").agg(F.sum("links").alias("links"))
    names = classes.select("label", "width", "place", "rep")
    edges = found.where("a is not null").select("label", "width", F.col("a").alias("place"), "b").join(names, ["label", "width", "place"])
    edges = edges.select("label", "width", F.col("b").alias("place"), F.col("rep").alias("x")).join(names, ["label", "width", "place"]).select(F.col("x").alias("a"), F.col("rep").alias("b"))
    by_class = classes.join(counts, ["label", "width", "place"], "left").select("label", "v", "rep", "copies", F.coalesce("links", F.lit(0)).alias("links"))
    # What links with nothing has no class: it stays out of the join, where its nulls would meet in one task.
    alone = rows.where("not usable").select("id", F.lit(None).cast("long").alias("rep"), F.lit(None).cast("long").alias("copies"), F.lit(0).cast("long").alias("links"))
    member = rows.where("usable").join(by_class, ["label", "v"], "left").select("id", "rep", "copies", "links").unionByName(alone)
    member = written(member.select("id", "rep", (F.coalesce("links", F.lit(0)) + F.coalesce(F.col("copies") - 1, F.lit(0))).alias("n_links")), "members")
    # A row whose id isn't its class's least is linked with it.
    own = member.where("id is not null and rep is not null and id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    found = components(edges.where("a is not null and b is not null").unionByName(own))
    member = member.join(found, member["id"] == found["id"], "left").select(member["id"].alias("vec_id"), "n_links", F.coalesce("component", member["id"]).alias("component_id"))
    return member.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def op4_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(read(spark, sf_dir, "embeddings"))


#: All pairs of a label by their cosine, components by following links.
ORACLE_SQL = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
), usable AS (
  SELECT *, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS size FROM v
  WHERE label IS NOT NULL AND len(list_filter(e, lambda x: x IS NOT NULL AND isfinite(x))) = len(e) AND len(list_filter(e, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.r AS x, a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.label = b.label AND a.r <> b.r AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / (a.size * b.size) >= 0.93
), reach AS (
  SELECT vec_id, vec_id AS c FROM v UNION SELECT links.b, reach.c FROM reach JOIN links ON links.a = reach.vec_id
), least_one AS (
  SELECT vec_id, min(c) AS component_id FROM reach GROUP BY vec_id
), counted AS (
  SELECT x AS r, count(*) AS n FROM links GROUP BY x
)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN least_one USING (vec_id) LEFT JOIN counted USING (r)
"""
