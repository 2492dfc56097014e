"""Repeated passages by the common-prefix interval tree of an enhanced suffix array.

A suffix array of all documents fits no task, so the corpus is split by content: each window of LENGTH bytes belongs to
its anchor, the K-gram in it with the least hash, and equal windows have equal anchors. The windows of one occurrence of an
anchor are a run; their bytes are its context. Contexts that occur once cannot repeat. Equal contexts are one leaf, and the
different contexts of an anchor go to one suffix array, whose interval tree gives the repeats among them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import drop_written, read, small_batches, unused, written
from .hashing import MULTIPLIER, Hasher

LENGTH = 100
K = 24
HOT = 512  # an anchor with more different contexts is split further, by whole windows
_CHUNK = 1 << 22
_TOGETHER = 1 << 17  # bytes of short documents that are hashed together
_COMBINE = 1 << 20
_HELD_BYTES = 1 << 20
_KERNEL_BYTES = 1 << 16  # a suffix array's tables stay in a core's cache


def runs(data, hasher: Hasher, length: int = LENGTH, ends=None):
    """(anchor hash, context hash, first window, number of windows) of each run of windows of one document's bytes, or of
    the bytes of several that end at ``ends``: windows never cross an end. Places count from the start of data."""
    import numpy as np

    ends = np.array([len(data)]) if ends is None else ends
    starts = np.concatenate([[0], ends[:-1]])
    out = []
    for base in range(0, max(len(data) - length + 1, 0), _CHUNK):
        part = data[base : base + _CHUNK + length - 1]
        h = hasher.grams(part, K)
        key = (h & np.uint64(~((1 << 24) - 1) & ((1 << 64) - 1))) | np.arange(len(h), dtype=np.uint64)
        width, span = length - K + 1, 1
        while 2 * span <= width:
            key = np.minimum(key[: len(key) - span], key[span:])
            span *= 2
        if width > span:
            key = np.minimum(key[: len(key) - (width - span)], key[width - span :])
        anchor = (key & np.uint64((1 << 24) - 1)).astype(np.int64)
        edge = np.zeros(len(anchor) + 1, np.int32)
        lo, hi = np.clip(starts - base, 0, len(anchor)), np.clip(ends - length + 1 - base, 0, len(anchor))
        some = hi > lo
        edge[lo[some]] += 1
        edge[hi[some]] -= 1
        own = np.zeros(len(anchor), bool)
        own[lo[some]] = True
        new = own | np.concatenate([[True], anchor[1:] != anchor[:-1]])
        inside = np.cumsum(edge[:-1]) > 0
        first = np.flatnonzero(new & inside)
        stop = np.concatenate([np.flatnonzero((new | ~inside)), [len(anchor)]])
        count = stop[np.searchsorted(stop, first, side="right")] - first
        context = hasher.ranges(part, first, first + count + length - 1)
        shape = ((anchor[first] - first) * 256 + count).astype(np.uint64)
        out.append((h[anchor[first]], hasher.mixed(context + shape * np.uint64(MULTIPLIER)), first + base, count))
    if not out:
        return tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def suffix_ranks(text, rest):
    """[(h, ranks by the first h symbols)] by prefix doubling; rest: bytes from each place to its context's end, at which
    suffixes end. Equal suffixes have equal ranks."""
    import numpy as np

    n, h = len(text), 7
    padded = np.concatenate([text.astype(np.int64) + 1, np.zeros(h, np.int64)])
    key = np.zeros(n, np.int64)
    for t in range(h):
        key = key * 512 + np.where(t < rest, padded[t : t + n], 0)
    levels = []
    while True:
        order = np.argsort(key)
        sorted_key = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate([[0], (sorted_key[1:] != sorted_key[:-1]).astype(np.int64)]))
        levels.append((h, rank))
        if h >= rest.max():
            return levels
        ahead = np.zeros(n, np.int64)
        ahead[: n - h] = rank[h:] + 1
        key = rank * (n + 1) + np.where(rest > h, ahead, 0)
        h *= 2


def common_prefixes(text, rest, levels, a, b):
    """Lengths of the common prefixes of the suffixes at a and b, each up to its context's end."""
    import numpy as np

    last, lcp = len(text) - 1, np.zeros(len(a), np.int64)
    a, b, left = a.copy(), b.copy(), np.minimum(rest[a], rest[b])
    alive = np.ones(len(a), bool)

    def step(same, h):
        nonlocal a, b, left, lcp
        by = np.where(same, h, 0)
        lcp, a, b, left = lcp + by, np.minimum(a + by, last), np.minimum(b + by, last), left - by

    for h, rank in reversed(levels):
        step((left >= h) & (rank[a] == rank[b]), h)
    for _ in range(levels[0][0] - 1):
        alive &= (left > 0) & (text[a] == text[b])
        step(alive, 1)
    return lcp


def interval_tree(lcp: list[int], order: list[int], left: list[int], least: int) -> Iterator[tuple[int, int, int, list[int]]]:
    """Scans leaves 0..n-1 of a suffix array with a stack; lcp[i] is that of leaves i-1 and i.

    order ranks the leaves' occurrences; left is the symbol before each, or -1 where it is not known. Yields each interval
    of common prefix >= least whose left extensions differ (a maximal repeat): its length, first and last leaf, and the
    leaves that are not its first occurrence but are the first of none or of a smaller interval in it: over all intervals
    each leaf comes up once at most, with the longest prefix that an earlier leaf shares.
    """
    diverse = -1
    stack: list[list] = []  # length, first leaf, leaf of the first occurrence, left symbol, leaves that come later

    def close(top, last):
        if top[3] == diverse:
            yield top[0], top[1], last, top[4]

    def absorb(top, best, symbol):
        if symbol != top[3]:
            top[3] = diverse
        if order[best] < order[top[2]]:
            top[4].append(top[2])
            top[2] = best
        else:
            top[4].append(best)

    n = len(order)
    for k in range(1, n + 1):
        value = lcp[k] if k < n else 0
        lb, best, symbol = k - 1, k - 1, left[k - 1]
        while stack and stack[-1][0] > value:
            top = stack.pop()
            absorb(top, best, symbol)
            yield from close(top, k - 1)
            lb, best, symbol = top[1], top[2], top[3]
        if value >= least:
            if stack and stack[-1][0] == value:
                absorb(stack[-1], best, symbol)
            else:
                stack.append([value, lb, best, symbol, []])


def repeats(contexts: list[bytes], windows, occurrence, length: int = LENGTH, members: bool = False) -> Iterator[tuple[int, list, list]]:
    """Maximal repeats of at least ``length`` bytes among contexts, of which the first windows[i] places may start one.

    occurrence numbers the contexts by their places in the corpus, at least as far apart as the windows they share. Yields
    the repeat's length, all its occurrences as (context, window) if members are asked for, and of these the ones to
    remove: each later occurrence under the longest repeat that has an earlier one.
    """
    import numpy as np

    windows, sizes = np.asarray(windows), np.array([len(c) for c in contexts])
    text = np.frombuffer(b"".join(contexts), np.uint8)
    ends = np.cumsum(sizes)
    rest = np.repeat(ends, sizes) - np.arange(len(text))
    levels = suffix_ranks(text, rest)
    owner = np.repeat(np.arange(len(contexts)), windows)
    window = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    place = (ends - sizes)[owner] + window
    when = occurrence[owner] + window
    sa = np.lexsort((when, levels[-1][1][place]))
    owner, window, place, when = owner[sa], window[sa], place[sa], when[sa]
    lcp = np.concatenate([[0], common_prefixes(text, rest, levels, place[:-1], place[1:])])
    joined = lcp >= length
    at = np.flatnonzero(joined | np.append(joined[1:], False))  # leaves beside a prefix that is long enough
    # What stands before a context isn't known; a repeat that starts there can't be left out for a longer one.
    left = np.where(window == 0, -1, text[np.maximum(place - 1, 0)].astype(np.int64))
    leaf = list(zip(owner[at].tolist(), window[at].tolist(), strict=True))
    for value, lb, rb, later in interval_tree(np.where(joined, lcp, 0)[at].tolist(), when[at].tolist(), left[at].tolist(), length):
        yield value, leaf[lb : rb + 1] if members else [], [leaf[i] for i in later]


def tag_of(text: Column) -> Column:
    """With the id it tells documents apart: rows that share an id, or have none, differ in 64 bits of a hash."""
    return F.xxhash64(text)


OCCURRENCE = "h long, c long, doc long, tag long, at long, n int"
SPAN = "doc long, tag long, at long, n int"


def occurrences(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """docs: doc, tag, text. A row for each run; runs whose context came earlier in the same task have n negated."""

    def run(batches):
        import numpy as np
        import pandas as pd

        hasher, held, size = Hasher(), [], 0

        def combined():
            h, c, doc, tag, at, n = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            order = np.lexsort((at, tag, doc, c, h))
            h, c, doc, tag, at, n = (x[order] for x in (h, c, doc, tag, at, n))
            twin = np.concatenate([[False], np.logical_and.reduce([x[1:] == x[:-1] for x in (h, c, doc, tag, at)])])
            h, c, doc, tag, at, n = (x[~twin] for x in (h, c, doc, tag, at, n))
            again = np.concatenate([[False], (h[1:] == h[:-1]) & (c[1:] == c[:-1])])
            # What came earlier here is settled, wherever it came first: it is dealt out by its place.
            h = np.where(again, hasher.mixed(doc.astype(np.uint64) * np.uint64(MULTIPLIER) + at.astype(np.uint64)), h)
            return pd.DataFrame({"h": h.view(np.int64), "c": c.view(np.int64), "doc": doc, "tag": tag, "at": at, "n": np.where(again, -n, n).astype(np.int32)})

        with np.errstate(over="ignore"):
            for b in batches:
                docs, tags, texts = b["doc"].to_numpy(), b["tag"].to_numpy(), [t.encode("utf-8") for t in b["text"]]
                lengths = np.array([len(t) for t in texts], np.int64)
                part = np.cumsum(lengths) // _TOGETHER
                cuts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1), len(texts)] if len(texts) else []
                for i, j in zip(cuts, cuts[1:], strict=False):
                    ends = np.cumsum(lengths[i:j])
                    h, c, at, n = runs(np.frombuffer(b"".join(texts[i:j]), np.uint8), hasher, length, ends)
                    if len(h):
                        of = np.searchsorted(ends, at, side="right")
                        held.append((h, c, docs[i + of], tags[i + of], at - (ends - lengths[i:j])[of], n))
                        size += len(h)
                    if size >= _COMBINE:
                        yield combined()
                        size = 0
            if held:
                yield combined()

    return small_batches(docs).mapInPandas(run, OCCURRENCE)


def contexts(needed: DataFrame, length: int = LENGTH) -> DataFrame:
    """needed: doc, tag, text, runs (array of h, at, n, hot). The runs' bytes, those of hot anchors window by window."""

    def run(batches):
        import pandas as pd

        seen: dict[bytes, tuple] = {}
        rows: list[tuple] = []

        def flush():
            rows.extend((_key(w), doc, tag, at, 1, w) for w, (doc, tag, at) in seen.items())
            seen.clear()
            out = pd.DataFrame(rows, columns=["h", "doc", "tag", "at", "n", "bytes"])
            rows.clear()
            return out

        for b in batches:
            for doc, tag, text, found in zip(b["doc"], b["tag"], b["text"], b["runs"], strict=True):
                data = text.encode("utf-8")
                for r in found:
                    at, n = int(r["at"]), int(r["n"])
                    if not r["hot"]:
                        rows.append((int(r["h"]), doc, tag, at, n, data[at : at + n + length - 1]))
                        continue
                    for i in range(at, at + n):
                        w = data[i : i + length]
                        before = seen.get(w)
                        if before is None:
                            seen[w] = (doc, tag, i)
                        else:
                            first, later = sorted((before, (doc, tag, i)))
                            seen[w] = first
                            if later != first:  # settled, and dealt out by its place
                                rows.append((hash(later) & 0x7FFFFFFFFFFF, *later, -1, None))
                if len(rows) + len(seen) > 100_000:
                    yield flush()
        yield flush()

    return needed.mapInPandas(run, "h long, doc long, tag long, at long, n int, bytes binary")


def _key(window: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(window, digest_size=8).digest(), "little", signed=True)


def by_anchor(found: DataFrame, work, schema: str) -> DataFrame:
    """work's frames for the rows of found, of which it has those of an anchor (h) together: some anchors at a time, of
    about _HELD_BYTES of bytes in all."""

    def run(batches):
        import pandas as pd

        held, size = [], 0
        for b in batches:
            held.append(b)
            size += int(_lengths(b["bytes"]).sum())
            if size >= _HELD_BYTES:
                rows = pd.concat(held, ignore_index=True)
                last = (rows["h"] == rows["h"].iloc[-1]).to_numpy()
                if not last.all():
                    yield from work(rows[~last])
                    rows = rows[last]
                held, size = [rows], int(_lengths(rows["bytes"]).sum())
        if held:
            rows = pd.concat(held, ignore_index=True)
            if len(rows):
                yield from work(rows)

    return found.mapInPandas(run, schema)


def _lengths(texts):
    """Bytes held for each row: those of its text, and as many as a row takes without one."""
    import numpy as np

    return np.array([64 if t is None else 64 + len(t) for t in texts], np.int64)


def kernels(h, texts) -> Iterator[slice]:
    """Slices of rows in order of their anchors h: whole anchors, of about _KERNEL_BYTES each."""
    import numpy as np

    starts = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
    part = np.cumsum(_lengths(texts))[starts] // _KERNEL_BYTES
    cuts = [*starts[np.concatenate([[True], part[1:] != part[:-1]])].tolist(), len(h)]
    yield from (slice(i, j) for i, j in zip(cuts, cuts[1:], strict=False))


def tree_spans(found: DataFrame, length: int = LENGTH) -> DataFrame:
    """Spans that repeat an earlier context's bytes; found has the rows of an anchor together."""

    def work(rows):
        import numpy as np
        import pandas as pd

        settled = rows[rows["bytes"].isna()]
        if len(settled):
            yield pd.DataFrame({"doc": settled["doc"], "tag": settled["tag"], "at": settled["at"], "n": np.int32(length)})
        rows = rows[rows["bytes"].notna()].drop_duplicates(["h", "doc", "tag", "at"])
        if len(rows) < 2:
            return
        h, doc, tag, at, n = (rows[c].to_numpy() for c in ("h", "doc", "tag", "at", "n"))
        order = np.lexsort((at, tag, doc))
        new = np.concatenate([[0], ((doc[order][1:] != doc[order][:-1]) | (tag[order][1:] != tag[order][:-1])).astype(np.int64)])
        when = np.empty(len(rows), np.int64)
        when[order] = np.cumsum(new) * (int(at.max()) + (1 << 20)) + at[order]
        texts, out = list(rows["bytes"]), []
        for s in kernels(h, texts):
            found = repeats(texts[s], n[s], when[s], length) if s.stop - s.start > 1 else ()
            out.extend((doc[s][c], tag[s][c], at[s][c] + w, size) for size, _, later in found for c, w in later)
        if out:
            yield pd.DataFrame(out, columns=["doc", "tag", "at", "n"])

    return by_anchor(found, work, SPAN)


LEAF = "h long, c long, n int, several boolean, at int, bytes binary"


def leaf_bytes(needed: DataFrame, length: int = LENGTH) -> DataFrame:
    """needed: text, runs (array of h, c, at, n, several, hot). The bytes of each different context c; those of hot anchors
    window by window, with the window's place in the context (at), a hash of it as h, and no bytes."""

    def run(batches):
        import pandas as pd

        rows: list[tuple] = []

        def flush():
            out = pd.DataFrame(rows, columns=["h", "c", "n", "several", "at", "bytes"])
            rows.clear()
            return out

        for b in batches:
            for text, found in zip(b["text"], b["runs"], strict=True):
                data = text.encode("utf-8")
                for r in found:
                    at, n = int(r["at"]), int(r["n"])
                    if r["hot"]:
                        rows.extend((_key(data[i : i + length]), r["c"], n, r["several"], i - at, None) for i in range(at, at + n))
                    else:
                        rows.append((r["h"], r["c"], n, r["several"], 0, data[at : at + n + length - 1]))
                    if len(rows) > 100_000:
                        yield flush()
        yield flush()

    return needed.mapInPandas(run, LEAF)


GROUP = "group_id long, length int, c long, at int"


def tree_groups(leaves: DataFrame, length: int = LENGTH) -> DataFrame:
    """leaves: the different contexts, those of an anchor together. The groups of maximal repeats as places in contexts."""

    def work(rows):
        import numpy as np
        import pandas as pd

        rows = rows.drop_duplicates(["h", "c"])
        h, c, windows, several = (rows[x].to_numpy() for x in ("h", "c", "n", "several"))
        texts, out, whole = list(rows["bytes"]), [], np.zeros(len(rows), bool)
        when = np.arange(len(rows), dtype=np.int64) << 20
        for s in kernels(h, texts):
            i = s.start
            for n, members, _ in repeats(texts[s], windows[s], when[s], length, members=True) if s.stop - i > 1 else ():
                name = _key(texts[i + members[0][0]][members[0][1] : members[0][1] + n])
                out.extend((name, n, c[i + k], w) for k, w in members)
                whole[[i + k for k, w in members if w == 0 and n == len(texts[i + k])]] = True
        # A leaf of several occurrences is a repeat of its own, unless an interval of its whole length holds it.
        out.extend((_key(texts[k]), len(texts[k]), c[k], 0) for k in np.flatnonzero(several & ~whole))
        if out:
            yield pd.DataFrame(out, columns=["group_id", "length", "c", "at"])

    return by_anchor(leaves, work, GROUP)


def repeat_groups(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """group_id, length, doc_id, tag, at: the groups of maximal repeats of ``length`` bytes or more, with every occurrence.

    A group is a string of bytes that occurs twice or more, in one document or in several; a row is one of its places (at,
    in bytes, in the document doc_id), and no place of the string is left out. Strings are maximal within the context of
    their anchor: a longer passage is a chain of overlapping groups. Every two equal windows of ``length`` bytes lie in a
    group, so the bytes that places other than a group's first one cover are those that without_repeats removes. Contexts
    that occur often go to the tree once, as one leaf, and their occurrences are joined to its groups. Anchors with more
    than HOT different contexts give groups of single windows. Periodic bytes have many nested groups.

    Rows that share an id are told apart by tag, a hash of their text; rows equal in both are one document. Null and empty
    texts hold no repeats, a null id stays null, other columns are not read, and an empty table gives an empty one.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    plain = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("doc"), tag_of(text).alias("tag"), text.alias("text"))
    found = written(occurrences(plain, length), "occurrences")
    place = F.struct("doc", "tag", "at")
    # Where a context came earlier in the same task its row has no anchor (n is negated), but one of its rows has.
    leaves = found.groupBy("c").agg(F.max(F.when(F.col("n") > 0, F.col("h"))).alias("h"), F.min(place).alias("first"), F.max(place).alias("last"), F.max(F.abs("n")).alias("n"))
    leaves = written(leaves.withColumn("several", F.col("first") != F.col("last")), "leaves")
    anchors = leaves.groupBy("h").agg(F.count(F.lit(1)).alias("classes"))
    leaves = leaves.join(anchors, "h").where("several or classes > 1").select("first.*", F.struct("h", "c", F.col("first.at").alias("at"), "n", "several", (F.col("classes") > HOT).alias("hot")).alias("run"))
    needed = leaves.groupBy("doc", "tag").agg(F.collect_list("run").alias("runs"))
    bytes_ = written(leaf_bytes(plain.join(needed, ["doc", "tag"]).select("text", "runs"), length), "leaves")
    groups = tree_groups(bytes_.where("bytes is not null").repartition("h").sortWithinPartitions("h"), length)
    windows = bytes_.where("bytes is null").select("h", "c", "at", "several").distinct()
    repeated = windows.groupBy("h").agg(F.count(F.lit(1)).alias("m"), F.max("several").alias("several")).where("several or m > 1").select("h")
    windows = windows.join(repeated, "h").select(F.col("h").alias("group_id"), F.lit(length).alias("length"), "c", "at")
    groups = groups.unionByName(windows).withColumnRenamed("at", "within")
    places = found.select("c", "doc", "tag", "at").join(groups, "c").select("group_id", "length", "doc", "tag", (F.col("at") + F.col("within")).alias("at")).distinct()
    doc = F.when(F.col("doc") != -(1 << 63), F.col("doc"))
    return places.select("group_id", "length", doc.alias(id_col), "tag", "at")


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """docs: doc, tag, text (not null). doc, tag, spans: the places (at, n) that repeat earlier bytes, in any order."""
    found = occurrences(docs, length)
    by = Window.partitionBy("h")
    ordered = by.orderBy("c", "doc", "tag", "at")
    first = F.coalesce(F.lag("c").over(ordered) != F.col("c"), F.lit(True)).cast("int")
    same = F.coalesce(F.lag(F.struct("doc", "tag", "at")).over(ordered) == F.struct("doc", "tag", "at"), F.lit(False)) & (first == 0)
    # The same place of a twin is no earlier one, so it stays unmarked.
    rows = found.withColumns({"first": F.when(F.col("n") > 0, first).otherwise(F.lit(0)), "same": same})
    rows = rows.withColumn("classes", F.sum("first").over(by))
    rows = rows.where("(first = 0 and not same) or classes > 1").select("h", "doc", "tag", "at", "n", "first", (F.col("classes") > HOT).alias("hot"))
    marks = written(rows, "runs")
    later = marks.where("first = 0").select("doc", "tag", "at", (F.abs("n") + length - 1).alias("n"))
    needed = marks.where("first = 1").groupBy("doc", "tag").agg(F.collect_set(F.struct("h", "at", "n", "hot")).alias("runs"))
    needed = docs.join(needed, ["doc", "tag"]).select("doc", "tag", "text", "runs")
    bytes_ = contexts(needed, length).repartition("h").sortWithinPartitions("h")
    spans = later.unionByName(tree_spans(bytes_, length))
    return spans.groupBy("doc", "tag").agg(F.collect_set(F.struct("at", "n")).alias("spans"))


@F.pandas_udf(T.StructType([T.StructField("kept", T.BinaryType()), T.StructField("removed", T.LongType()), T.StructField("runs", T.LongType())]))
def cut(text, spans):
    """The bytes that no span covers, and the number of removed bytes and of maximal removed runs."""
    import numpy as np
    import pandas as pd

    out = []
    for t, found in zip(text, spans, strict=True):
        data = (t or "").encode("utf-8")
        if found is None or not len(found):
            out.append((data, 0, 0))
            continue
        edge = np.zeros(len(data) + 2, np.int64)
        at = np.array([s["at"] for s in found], np.int64)
        np.add.at(edge, at + 1, 1)
        np.add.at(edge, at + np.array([s["n"] for s in found], np.int64) + 1, -1)
        gone = np.cumsum(edge)[:-1] > 0
        starts = np.flatnonzero(gone[1:] & ~gone[:-1])
        kept = np.frombuffer(data, np.uint8)[~gone[1:]].tobytes()
        out.append((kept, len(data) - len(kept), len(starts)))
    return pd.DataFrame(out, columns=["kept", "removed", "runs"])


@F.pandas_udf(T.StringType())
def as_text(kept):
    """UTF-8 bytes as text, without the rests of characters that lost a byte."""
    import pandas as pd

    return pd.Series([None if k is None else bytes(k).decode("utf-8", "ignore") for k in kept], dtype=object)


def without_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", into: str = "cut") -> DataFrame:
    """docs with struct ``into``: kept (bytes), removed (number of bytes), runs (number of maximal removed runs).

    Every byte goes that a string of ``length`` bytes covers which also starts earlier: in a document with a smaller id,
    or before in the same one. Strings are those of the input. Null and empty texts have nothing to remove. A null id
    counts as the smallest. Rows that share an id are documents ordered by a hash of their text; rows equal in both are
    twins with equal results, which don't count as each other's repeats. All columns stay; one named like ``into`` is
    replaced. Texts of any length are cut into overlapping chunks; an empty table gives an empty one.
    """
    docs = docs.drop(into)
    doc, tag, spans = (unused(docs, n) for n in ("_doc", "_tag", "_spans"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.withColumns({doc: F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))), tag: tag_of(text)})
    plain = keyed.select(F.col(doc).alias("doc"), F.col(tag).alias("tag"), text.alias("text"))
    found = repeated_spans(plain, length).select(F.col("doc").alias(doc), F.col("tag").alias(tag), F.col("spans").alias(spans))
    return keyed.join(found, [doc, tag], "left").withColumn(into, cut(F.col(text_col), F.col(spans))).drop(doc, tag, spans)


def op3_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    rows = without_repeats(docs)
    size = F.octet_length(F.coalesce("text", F.lit(""))).cast("long")
    return rows.select("doc_id", size.alias("n_bytes"), F.col("cut.removed").alias("n_removed"), F.col("cut.runs").alias("n_spans"), F.sha2("cut.kept", 256).alias("kept_sha256"))


#: Every window of 100 bytes, as hexadecimal digits, with its first place in the corpus.
ORACLE_SQL = """
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents
), w AS (
  SELECT doc_id, i, substr(h, 2 * i::INT + 1, 200) AS s FROM d, unnest(range(0, greatest(n - 99, 0))) AS r(i)
), f AS (
  SELECT s, min((doc_id, i)) AS first FROM w GROUP BY s HAVING count(*) > 1
), gone AS (
  SELECT doc_id, i, coalesce(i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) > 100, TRUE) AS new
  FROM w JOIN f USING (s) WHERE (doc_id, i) <> first
), numbered AS (
  SELECT doc_id, i, sum(new::INT) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM gone
), spans AS (
  SELECT doc_id, min(i) AS a, max(i) + 100 AS b FROM numbered GROUP BY doc_id, run
), pieces AS (
  SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM spans
), cut AS (
  SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS last, string_agg(substr(h, 2 * before::INT + 1, 2 * (a - before)::INT), '' ORDER BY a) AS kept
  FROM pieces JOIN d USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 0)::INT + 1))) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id)
"""
