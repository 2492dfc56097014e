"""Near-duplicates by bottom-k sketches of one hash function, confirmed on full shingle sets.

1. Each document's shingles are hashed once; its sketch is the K least hashes. Documents with equal sets are one class.
2. Inverted lists of the retained values. Two sketches that have OVERLAP values in common share one of the K - OVERLAP + 1
   values of each whose lists are shortest, whatever the lists, so only these are used, and passages that many documents
   share make no candidates. A value of the larger set's sketch is in the other set with probability intersection / size,
   so a similarity of 0.8 leaves 57 of 64 values in common for sets of one size, and 51, give or take 3.2, where one set
   holds the other: OVERLAP is 4.1 standard errors below that: two lost pairs in 100,000 at the threshold itself, and
   fewer above it. Sets that their sketches hold whole use the bound of the similarity itself and lose nothing.
3. Each class is first compared with one centre of its lists. The union sketch's estimate rules pairs out, the full sets
   decide. A family of copies is mostly joined by this round, at one pair a copy.
4. Lists that still hold classes that are apart are bundled by their least class, since the lists of a family have
   nearly equal members. A bundle is cut into blocks of a bounded size; blocks of classes that are all joined already
   are not compared with each other. The sketches of two blocks meet in one task, which keeps the classes that have a
   partner there by a bound on the values in common, six standard errors wide and derived from both sizes. The full
   sets of these meet next, and the task returns the links that join classes, not the pairs. No pair of a list is left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import components, drop_written, joined_labels, read, small_batches, unused, written
from .hashing import MULTIPLIER, Hasher, words

K = 64
THRESHOLD = (80, 100)
ESTIMATE = 0.5  # six standard errors of a 64-value sketch below the threshold
OVERLAP = 38  # of K values
SALT = 256  # copies that one task compares with one centre
BLOCK_ROWS, BLOCK_SHINGLES = 1024, 1 << 19  # of a block of full sets
FEW = 16  # sets; the pairs of values in more sets are counted by matrix products


def shingles(text: str, size: int, hasher: Hasher):
    """Sorted distinct hashes of the text's shingles of ``size`` words; A-Z count as a-z, words end at ASCII space."""
    import numpy as np

    hashes = words(text, hasher)
    if not len(hashes):
        return np.zeros(0, np.int64)
    n = min(size, len(hashes))
    total = np.zeros(len(hashes) - n + 1, np.uint64)
    for i in range(n):
        total = total * np.uint64(MULTIPLIER) + hashes[i : i + len(total)]
    found = np.sort(hasher.mixed(total + np.uint64(n)).view(np.int64))
    return found[np.concatenate([[True], found[1:] != found[:-1]])]


def sketches(docs: DataFrame, size: int, k: int = K) -> DataFrame:
    """docs: doc, text. doc, n (set size), f1 and f2 (fingerprint of the set), sketch (the k least hashes in order)."""

    def run(batches):
        import numpy as np
        import pandas as pd

        hasher = Hasher()
        for b in batches:
            for part in range(0, len(b), 500):
                rows = []
                with np.errstate(over="ignore"):
                    for doc, text in zip(b["doc"].iloc[part : part + 500], b["text"].iloc[part : part + 500], strict=True):
                        s = shingles(text or "", size, hasher)
                        u = s.view(np.uint64)
                        f1, f2 = hasher.mixed(u * np.uint64(MULTIPLIER)).sum(), hasher.mixed(u ^ np.uint64(MULTIPLIER)).sum()
                        rows.append((doc, len(s), int(np.uint64(f1).view(np.int64)), int(np.uint64(f2).view(np.int64)), s[:k].copy()))
                out = pd.DataFrame(rows, columns=["doc", "n", "f1", "f2", "sketch"])
                out["doc"] = out["doc"].astype("Int64")
                yield out

    return small_batches(docs).select("doc", "text").mapInPandas(run, "doc long, n long, f1 long, f2 long, sketch array<long>")


def inverted_lists(reps: DataFrame, held=written) -> DataFrame:
    """reps: rep, n, sketch. (key, rep, n) of the values by which a class looks for others."""
    flat = reps.select("rep", "n", F.size("sketch").alias("m"), F.explode("sketch").alias("key"))
    lengths = held(flat.groupBy("key").agg(F.count(F.lit(1)).alias("length")).where("length > 1"), "lengths")
    by = Window.partitionBy("rep")
    shared = flat.join(lengths, "key").withColumns({"place": F.row_number().over(by.orderBy("length", "key")), "shared": F.count(F.lit(1)).over(by)})
    whole = F.col("n") - F.expr(f"({THRESHOLD[0]} * n + {THRESHOLD[1] - 1}) div {THRESHOLD[1]}") + 1
    sketched = F.col("m") - OVERLAP + 1
    first = F.when(F.col("n") > K, sketched).when(F.col("n") * THRESHOLD[1] >= K * THRESHOLD[0], F.greatest(whole, sketched)).otherwise(whole)
    # The values that no other class has come first in this order; they have no list.
    return shared.where(F.col("place") <= first - (F.col("m") - F.col("shared"))).select("key", "rep", "n")


def apart(rows: DataFrame, held=written) -> DataFrame:
    """Of rows (key, rep, n, comp) those of lists that hold two components or more, with ``centre``, the list's least class."""
    lists = rows.groupBy("key").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"), F.min("rep").alias("centre")).where("c0 <> c1")
    return rows.join(held(lists.select("key", "centre"), "centres"), "key")


def star(rows: DataFrame) -> DataFrame:
    """(a, b): each class with one centre of its lists, the one with which it shares most of them."""
    counted = rows.where("centre <> rep").groupBy("rep", "centre").agg(F.count(F.lit(1)).alias("shared"))
    best = counted.groupBy("rep").agg(F.max(F.struct("shared", (-F.col("centre")).alias("a"))).alias("m"))
    return best.select((-F.col("m.a")).alias("a"), F.col("rep").alias("b"))


def labelled(rows: DataFrame, links: DataFrame) -> DataFrame:
    """rows: key, rep, n, and comp: a class that rep is known to be connected to by the links (a, b), one for each b; the
    centre's centre, or the centre, or rep itself."""
    one = links.groupBy("b").agg(F.min("a").alias("a"))
    two = one.join(one.select(F.col("b").alias("a"), F.col("a").alias("aa")), "a", "left").select(F.col("b").alias("rep"), F.coalesce("aa", "a").alias("comp"))
    return rows.join(two, "rep", "left").select("key", "rep", "n", F.coalesce("comp", "rep").alias("comp"))


def dealt(bundles: DataFrame, held=written) -> DataFrame:
    """bundles: centre, rep, n, comp. A row for each pair of blocks (i, j) of its bundle in which a class is compared.

    A bundle that fits one block is one. Else its largest component has blocks of its own, which are not compared with
    each other, and the rest has others. So a family that is joined but for a few is dealt out once or twice, and the
    copies of a row grow with the blocks that are apart from it.
    """
    by_comp = bundles.groupBy("centre", "comp").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("shingles"))
    total = by_comp.groupBy("centre").agg(F.sum("rows").alias("rows"), F.sum("shingles").alias("shingles"), F.max(F.struct("rows", "shingles", "comp")).alias("main"))
    blocks = lambda rows, n: F.greatest(F.ceil(rows / BLOCK_ROWS), F.ceil(n / BLOCK_SHINGLES)).cast("int")
    total = total.withColumn("all", blocks(F.col("rows"), F.col("shingles"))).withColumns({
        "m": F.when(F.col("all") > 1, blocks(F.col("main.rows"), F.col("main.shingles"))).otherwise(0),
        "r": F.when(F.col("all") > 1, blocks(F.col("rows") - F.col("main.rows"), F.col("shingles") - F.col("main.shingles"))).otherwise(1),
    })
    plan = held(total.select("centre", F.col("main.comp").alias("main"), "m", "r"), "bundles")
    spot = lambda n: F.pmod(F.xxhash64("rep"), F.greatest(n, F.lit(1))).cast("int")
    in_main = (F.col("m") > 0) & (F.col("comp") == F.col("main"))
    own = F.when(in_main, spot(F.col("m"))).otherwise(F.col("m") + spot(F.col("r")))
    others = F.sequence(F.when(in_main, F.col("m")).otherwise(F.lit(0)), F.col("m") + F.col("r") - 1)
    rows = bundles.join(plan, "centre").withColumn("own", own).withColumn("other", F.explode(others))
    return rows.select("centre", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "rep", "comp")


def common_counts(sets: list):
    """The sizes of the intersections of sorted distinct arrays, above the diagonal of a matrix."""
    import numpy as np

    m = len(sets)
    row = np.repeat(np.arange(m), [len(s) for s in sets])
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    values, row = values[order], row[order]
    start = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    times = np.diff(np.append(start, len(values)))
    both, few = np.zeros((m, m), np.float32), min(FEW, m)
    found, size = [], 0

    def add():
        nonlocal size
        both.ravel()[:] += np.bincount(np.concatenate(found), minlength=m * m)
        found.clear()
        size = 0

    for t in range(2, few + 1):
        at = start[times == t]
        for a in range(0, len(at), 1 << 16):
            held = row[at[a : a + (1 << 16), None] + np.arange(t)]
            for d in range(1, t):
                found.append((held[:, :-d] * m + held[:, d:]).ravel())
                size += len(found[-1])
            if size > 1 << 21:
                add()
    if found:
        add()
    many = np.flatnonzero(times > few)
    for a in range(0, len(many), 2048):
        some = many[a : a + 2048]
        n = times[some]
        at = np.repeat(start[some] - np.cumsum(n) + n, n) + np.arange(n.sum())
        x = np.zeros((m, len(some)), np.float32)
        x[row[at], np.repeat(np.arange(len(some)), n)] = 1
        both += x @ x.T
    return both


def least_common(n, m):
    """Values that the sketches of two sets with n and m shingles have in common at the least if the sets reach the
    threshold, six standard errors below what is expected. A value of the larger set's sketch is in the other set with
    probability intersection / size: 0.89 for sets of one size, 0.8 where one set holds the other. Sets that the sketches
    hold whole have their true intersection."""
    import numpy as np

    least = np.ceil(THRESHOLD[0] * (n + m) / sum(THRESHOLD))
    p = np.minimum(least / np.maximum(n, m), 1)
    return np.where(np.maximum(n, m) <= K, least, K * p - 6 * np.sqrt(K * p * (1 - p)))


def together(rows: DataFrame) -> DataFrame:
    """Rows of two blocks one after the other, in one task."""
    return small_batches(rows).repartition("centre", "i", "j").sortWithinPartitions("centre", "i", "j")


def block_candidates(blocks: DataFrame, reps: DataFrame) -> DataFrame:
    """The rows of blocks that have a partner of another component in them by their sketches."""
    own = reps.select(F.col("rep").alias("doc"), "n", "sketch")
    rows = together(blocks.join(own, blocks["rep"] == own["doc"]).select(*blocks.columns, "n", "sketch"))

    def run(batches):
        import numpy as np
        import pandas as pd

        held, columns = None, ["centre", "i", "j", "rep", "comp"]

        def able(part):
            if len(part) < 2:
                return part[:0]
            n, comp = part["n"].to_numpy(), part["comp"].to_numpy()
            low, high = np.minimum(n[:, None], n[None]), np.maximum(n[:, None], n[None])
            near = np.triu(common_counts(list(part["sketch"])) >= least_common(n[:, None], n[None]), 1)
            near &= (comp[:, None] != comp[None]) & (low * THRESHOLD[1] >= high * THRESHOLD[0])
            return part[near.any(axis=0) | near.any(axis=1)]

        def split(rows):
            key = rows[["centre", "i", "j"]].to_numpy()
            cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1), len(rows)]
            return [rows.iloc[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

        for b in batches:
            *whole, held = split(b if held is None else pd.concat([held, b], ignore_index=True))
            if whole:
                yield pd.concat([able(part) for part in whole])[columns]
        if held is not None:
            yield able(held)[columns]

    return rows.mapInPandas(run, "centre long, i int, j int, rep long, comp long").distinct()


def block_links(blocks: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """(a, b) of components that the links within two blocks join; the full sets are compared."""
    rows = together(blocks.join(texts, blocks["rep"] == texts["doc"]).select("centre", "i", "j", "comp", "text"))

    def run(batches):
        import numpy as np
        import pandas as pd

        hasher, at, comps, sets, low, high = Hasher(), None, [], [], [], []

        def compare():
            if len(sets) < 2:
                return
            n, comp = np.array([len(s) for s in sets], np.int64), np.array(comps)
            both = common_counts(sets)
            union = n[:, None] + n[None] - both.astype(np.int64)
            near = np.triu(THRESHOLD[1] * both >= THRESHOLD[0] * union, 1) & (comp[:, None] != comp[None])
            a, b = joined_labels(comp, *np.nonzero(near))
            low.append(a)
            high.append(b)

        with np.errstate(over="ignore"):
            for batch in batches:
                for centre, i, j, comp, text in zip(batch["centre"], batch["i"], batch["j"], batch["comp"], batch["text"], strict=True):
                    if at != (centre, i, j):
                        compare()
                        at = (centre, i, j)
                        comps.clear()
                        sets.clear()
                    comps.append(comp)
                    sets.append(shingles(text or "", size, hasher))
            compare()
        none = np.zeros(0, np.int64)
        yield pd.DataFrame({"a": np.concatenate([none, *low]), "b": np.concatenate([none, *high])})

    return rows.mapInPandas(run, "a long, b long").distinct()


def estimated(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """The pairs (a, b) whose union sketch doesn't rule the threshold out. Exact where the sketches hold the whole sets."""
    one = reps.select(F.col("rep").alias("a"), F.col("sketch").alias("sa"))
    two = reps.select(F.col("rep").alias("b"), F.col("sketch").alias("sb"))
    both = pairs.join(two, "b").join(one, "a")
    union = F.slice(F.sort_array(F.array_union("sa", "sb")), 1, K)
    common = F.size(F.array_intersect(F.array_intersect("sa", "sb"), union))
    return both.where(common >= F.lit(ESTIMATE) * F.size(union)).select("a", "b")


def confirmed(pairs: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold. texts: doc, text.

    A centre a with many partners is sent to one task for each SALT of them, so a hot centre is no hot task.
    """
    salts = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / SALT).alias("salts"))
    dealt = pairs.join(salts, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.col("salts")))
    partners = dealt.select(F.col("b").alias("doc"), "a", "salt")
    centres = salts.select(F.col("a").alias("doc"), "a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"))
    rows = texts.join(partners.unionByName(centres), "doc").select("a", "salt", (F.col("doc") != F.col("a")).alias("partner"), "doc", "text")
    rows = rows.repartition("a", "salt").sortWithinPartitions("a", "salt", "partner")

    def run(batches):
        import numpy as np
        import pandas as pd

        hasher, centre, held = Hasher(), None, []  # rows that share the centre's id have a set each
        for b in batches:
            found = []
            with np.errstate(over="ignore"):
                for a, salt, partner, doc, text in zip(b["a"], b["salt"], b["partner"], b["doc"], b["text"], strict=True):
                    s = shingles(text or "", size, hasher)
                    if not partner:
                        held = [*held, s] if centre == (a, salt) else [s]
                        centre = (a, salt)
                        continue
                    assert centre == (a, salt)
                    for other in held:
                        common = len(np.intersect1d(other, s, assume_unique=True))
                        if THRESHOLD[1] * common >= THRESHOLD[0] * (len(s) + len(other) - common):
                            found.append((a, doc))
            yield pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return rows.mapInPandas(run, "a long, b long")


def near_duplicates(docs: DataFrame, size: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: doc_id, n_shingles, component_id (the smallest id reachable over links), kept.

    Links join documents whose sets of ``size``-word shingles have a similarity of 0.8 or more; a text with fewer words
    has its whole sequence as its only shingle; null and empty texts and texts without words link with nothing. Rows that
    share an id are one node, which has the links of all of them. A null id links with nothing, has a null component and
    is kept. Extra columns are not read; an empty table gives no rows. Shingles are compared by 64-bit hashes.
    """
    made: list[DataFrame] = []

    def held(df: DataFrame, name: str) -> DataFrame:
        made.append(written(df, name))
        return made[-1]

    plain = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    table = held(sketches(plain, size), "sketches")
    named = table.where("n > 0 and doc is not null")
    least = named.groupBy("n", "f1", "f2").agg(F.min(F.struct("doc", "sketch")).alias("m"))
    reps = held(least.select("n", "f1", "f2", F.col("m.doc").alias("rep"), F.col("m.sketch").alias("sketch")), "classes")
    # Rows that share an id but not their sets: their classes are one node.
    several = named.groupBy("doc").agg(F.min(F.struct("n", "f1", "f2")).alias("x"), F.max(F.struct("n", "f1", "f2")).alias("y")).where("x <> y")
    same = named.join(several, "doc", "left_semi").join(reps, ["n", "f1", "f2"]).select("doc", "rep")
    links = same.select(F.col("rep").alias("b"), F.min("rep").over(Window.partitionBy("doc")).alias("a")).where("a <> b").select("a", "b").distinct()
    lists = held(inverted_lists(reps, held), "lists")

    def texts_of(ids):
        return held(plain.join(ids.select(F.col("id").alias("doc")).distinct(), "doc", "left_semi"), "texts")

    pairs = held(estimated(star(apart(lists.withColumn("comp", F.col("rep")), held)), reps), "pairs")
    ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id")))
    found = held(confirmed(pairs, texts_of(ids), size), "links")
    rows = apart(labelled(lists, found), held)
    members = held(rows.select("centre", "rep", "n", "comp").distinct(), "members")
    near = held(block_candidates(dealt(members, held), reps), "candidates")
    texts = texts_of(near.select(F.col("rep").alias("id")))
    links = links.unionByName(found).unionByName(held(block_links(near, texts, size), "links"))
    joined = held(components(links), "components")
    member = table.join(reps.drop("sketch"), ["n", "f1", "f2"], "left")
    member = member.join(joined, member["rep"] == joined["id"], "left")
    component = F.when(F.col("doc").isNotNull(), F.coalesce("component", "rep", "doc"))
    result = member.select(
        F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(component == F.col("doc"), F.lit(True)).alias("kept")
    )
    result = written(result, "near")
    for t in made:
        drop_written(t)
    return result


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"), size=2)


#: Links by counting the shingles of each two documents, components by following links.
ORACLE_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) = 1 THEN words
    ELSE list_distinct(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) END AS s
  FROM w
), flat AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets
), counted AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS n, any_value(b.n) AS m, count(*) AS c
  FROM flat a JOIN flat b ON a.x = b.x AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n) GROUP BY a.doc_id, b.doc_id
), links AS (
  SELECT a, b FROM counted WHERE 100 * c >= 80 * (n + m - c)
), two_way AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT doc_id, doc_id AS c FROM sets UNION SELECT two_way.b, reach.c FROM reach JOIN two_way ON two_way.a = reach.doc_id
), least_one AS (
  SELECT doc_id, min(c) AS component_id FROM reach GROUP BY doc_id
)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN least_one USING (doc_id)
"""
