"""Mixing sources to target weights by Pfair scheduling of their blocks. Built of DataFrame functions only."""

from __future__ import annotations

import array
import bisect
import heapq
import math
from collections.abc import Mapping
from fractions import Fraction

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ranked, read, unused

BLOCK = 8  # documents that stay together
MOST_BLOCKS = 1 << 20  # of the plan that the driver makes; blocks are longer where there would be more
MOST_SOURCES = 500
TEMPERATURE = 0.5  # default weights: the sources' document counts to this power
PIECE = 1024  # blocks of a row of the plan
PLAN = "source string, piece long, slots array<long>"


def whole_shares(weights: Mapping, units: int) -> dict:
    """Shares of at least 1 that sum to units, by largest remainders; ties go to the source that is first."""
    total = sum(weights.values())
    exact = {s: w / total * units for s, w in weights.items()}
    shares = {s: max(1, int(x)) for s, x in exact.items()}
    while (left := units - sum(shares.values())) != 0:
        step = 1 if left > 0 else -1
        able = [s for s in shares if step > 0 or shares[s] > 1]
        shares[max(able, key=lambda s: step * (exact[s] - shares[s]))] += step
    return shares


def one_period(shares: Mapping) -> list:
    """The source of each slot of one period, whose length is the sum of the shares.

    Block k (from 0) of a source with share u in a period of P slots may not start before floor(k P / u) and has to end by
    ceil((k + 1) P / u). Among the released blocks the one with the earliest deadline goes first. Since the shares fill the
    period, every window is kept, so after any number of slots a source is less than one block from its weight's due.
    """
    names, period = list(shares), sum(shares.values())
    waiting = [(0, i, 0) for i in range(len(names))]
    heapq.heapify(waiting)
    ready, order = [], []
    for slot in range(period):
        while waiting and waiting[0][0] <= slot:
            _, i, k = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(k + 1) * period // shares[names[i]]), i, k))
        _, i, k = heapq.heappop(ready)
        order.append(names[i])
        if k + 1 < shares[names[i]]:
            heapq.heappush(waiting, ((k + 1) * period // shares[names[i]], i, k + 1))
    return order


def schedule(blocks: Mapping, weights: Mapping) -> dict:
    """The slots of each source's blocks in order: every block has a slot of its own, gapless from 0.

    In the fluid mix all sources run at once, each by its weight until its blocks end: at virtual time v source s has had
    min(w_s v, n_s) and the slots passed are T(v), the sum of that. Block k has the window from floor(T(k / w_s)) to
    ceil(T((k + 1) / w_s)); the earliest deadline goes first among the released. The fluid mix fills every slot and keeps
    every window, so this does too: after any number of slots every source is less than one block from its due, whatever
    ends. Weights are taken as the exact fractions they are; sources of weight 0 share alike what comes after the others.
    """
    last = {s: n for s, n in blocks.items() if not weights[s]}
    if last:
        first = {s: n for s, n in blocks.items() if s not in last}
        after = schedule(last, dict.fromkeys(last, 1))
        return schedule(first, weights) | {s: array.array("q", (t + sum(first.values()) for t in x)) for s, x in after.items()}
    names = [s for s, n in blocks.items() if n]
    exact = [Fraction(weights[s]) for s in names]
    unit = math.lcm(*(w.denominator for w in exact))
    w, n = [int(x * unit) for x in exact], [blocks[s] for s in names]
    # Between the ends of two sources T(v) is ended + running * v.
    ends, ended, running = [], [0], [sum(w)]
    for i in sorted(range(len(names)), key=lambda i: Fraction(n[i], w[i])):
        ends.append(Fraction(n[i], w[i]))
        ended.append(ended[-1] + n[i])
        running.append(running[-1] - w[i])
    phase = [0] * len(names)

    def passed(i: int, k: int) -> tuple[int, int]:
        """Floor and ceiling of T(k / w_i)."""
        at = phase[i]
        if at < len(ends) and ends[at].numerator * w[i] < k * ends[at].denominator:
            at = phase[i] = bisect.bisect_left(ends, Fraction(k, w[i]), lo=at)
        low, rest = divmod(ended[at] * w[i] + running[at] * k, w[i])
        return low, low + (rest > 0)

    waiting, ready, slots = [(0, i, 0) for i in range(len(names))], [], [array.array("q") for _ in names]
    for slot in range(sum(n)):
        while waiting and waiting[0][0] <= slot:
            _, i, k = heapq.heappop(waiting)
            release, deadline = passed(i, k + 1)
            heapq.heappush(ready, (deadline, i, k, release))
        _, i, k, release = heapq.heappop(ready)
        slots[i].append(slot)
        if k + 1 < n[i]:
            heapq.heappush(waiting, (release, i, k + 1))
    return dict(zip(names, slots, strict=True))


def mix(docs: DataFrame, weights: Mapping | None = None, block: int = BLOCK, id_col: str = "doc_id", source_col: str = "source", spread: int = 1024, names: tuple[str, str, str] = ("block", "slot", "position"), most: int | None = MOST_SOURCES) -> DataFrame:
    """docs with block (number within the source), slot (the block's place in the mix) and position (order of rows).

    Sources are cut into blocks of ``block`` rows in the order of a hash of the id; ``weights`` maps sources to target
    weights (default: document counts to the power TEMPERATURE). Every row is kept once. After any number of slots every
    source is less than one block from its due (see schedule). Positions are unique and may skip numbers where a source's
    last block is short. A null source is a source; ties and repeated rows are interchangeable; null texts don't matter;
    an empty table gives no rows; existing columns named like the new ones are replaced.

    A count for each source comes to the driver, which makes the plan: a number for each block, PIECE of them in a row.
    Blocks hold ``block`` rows, or as many as leave MOST_BLOCKS blocks besides one for each source, so the plan has a
    bounded size whatever the corpus.
    More than ``most`` sources are refused; None takes any number, as the query and the pipeline do.
    """
    docs = docs.drop(*names)
    source, rank = unused(docs, "_source"), unused(docs, "_rank")
    docs = docs.withColumn(source, F.col(source_col).cast("string"))
    sizes = docs.groupBy(source).agg(F.count(F.lit(1)))
    counts = {r[0]: r[1] for r in (sizes if most is None else sizes.limit(most + 1)).collect()}
    if most is not None and len(counts) > most:
        raise ValueError(f"more than {most} sources: group them, mix the groups, or set most=None")
    counts = dict(sorted(counts.items(), key=lambda x: (x[0] is None, x[0] or "")))
    if weights is not None and (missing := set(counts) - set(weights)):
        raise ValueError(f"no weight for {sorted(map(str, missing))}")
    due = {s: weights[s] if weights is not None else n**TEMPERATURE for s, n in counts.items()}
    block = max(block, -(-sum(counts.values()) // MOST_BLOCKS))
    plan = schedule({s: -(-n // block) for s, n in counts.items()}, due) if due else {}
    pieces = [(s, i // PIECE, x[i : i + PIECE].tolist()) for s, x in plan.items() for i in range(0, len(x), PIECE)]
    p = unused(docs, "_plan")
    table = docs.sparkSession.createDataFrame(pieces, PLAN).select(F.struct("*").alias(p))
    key = F.xxhash64(F.col(id_col), F.col(source_col))
    rows = ranked(docs, [source], [F.col(id_col), F.xxhash64(*(F.col(f"`{c}`") for c in docs.columns))], [key, F.col(id_col)], rank, spread)
    number = F.floor(F.col(rank) / block).cast("long")
    rows = rows.withColumn(names[0], number)
    on = F.col(source).eqNullSafe(F.col(f"{p}.source")) & (F.expr(f"`{names[0]}` div {PIECE}") == F.col(f"{p}.piece"))
    slot = F.element_at(f"{p}.slots", (F.col(names[0]) % PIECE + 1).cast("int"))
    rows = rows.join(table, on).withColumn(names[1], slot)
    return rows.withColumn(names[2], F.col(names[1]) * block + F.col(rank) % block).drop(source, rank, p)


def in_order(mixed: DataFrame, position: str | Column = "position") -> DataFrame:
    """Rows dealt and sorted by position, so that files written from them hold the mix in its order."""
    return mixed.repartitionByRange(position).sortWithinPartitions(position)


def as_written(table: DataFrame) -> DataFrame:
    """The rows of a table read from files, dealt and sorted by the number of their file and their place in it. Spark deals
    files by size, which undoes the order in which in_order() wrote them. Rows that aren't read from files stay as dealt."""
    try:
        names = [unused(table, n) for n in ("_part", "_file", "_row")]
        meta = table.metadataColumn("_metadata")
        part = F.regexp_extract(meta["file_name"], r"part-(\d+)", 1).try_cast("long")
        placed = table.select(*(F.col(f"`{c}`") for c in table.columns), part.alias(names[0]), meta["file_name"].alias(names[1]), meta["row_index"].alias(names[2]))
    except AnalysisException:
        return table
    return placed.repartitionByRange(*names).sortWithinPartitions(*names).drop(*names)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents").select("doc_id", "source"), most=None).select("doc_id", "source", "block", "slot", "position")
