"""Sharding, mixing and packing."""

from __future__ import annotations

from fractions import Fraction
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tramline.llm import mixing, packing, sharding


def jump_one(key, n):
    b, j = -1, 0
    while j < n:
        b, key = j, (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_hash_matches_its_definition():
    keys = np.array([0, 1, 2, 12345, 2**63, 2**64 - 1, *range(100, 400)], np.uint64)
    for n in (1, 2, 16, 17, 1000):
        assert sharding.jump(keys.copy(), n).tolist() == [jump_one(int(k), n) for k in keys]


def test_shards(docs, corpus):
    got = sharding.shard(docs).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in corpus)
    for r in got:
        key = (r.doc_id or 0) % (1 << 64)
        assert (r.shard, r.grown_shard, r.law) == (jump_one(key, 16), jump_one(key, 17), "key") and r.grown_shard in (r.shard, 16)
    for s in range(16):
        mine = sorted(r.slot for r in got if r.shard == s)
        assert mine == list(range(len(mine)))


def test_written_shards_hold_every_row(docs, corpus, spark, tmp_path):
    sharding.write_shards(docs, str(tmp_path / "s"), 4)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == len(corpus) and back.where(F.col("shard") != sharding.shard_of(F.col("doc_id"), 4)).count() == 0


def test_every_prefix_is_less_than_a_block_from_its_due():
    rng = random.Random(6)
    for _ in range(60):
        shares = mixing.whole_shares({f"s{i}": rng.random() + 0.01 for i in range(rng.randint(1, 12))}, rng.choice([50, 200, 1000]))
        order, seen = mixing.one_period(shares), dict.fromkeys(shares, 0)
        for n, s in enumerate(order, 1):
            seen[s] += 1
            assert all(abs(seen[x] * len(order) - n * shares[x]) < len(order) for x in shares)
        assert seen == shares


@pytest.mark.parametrize("blocks, weights", [({"a": 3000, "b": 6000}, {"a": 1, "b": 2}), ({f"s{i}": 20 + 97 * i for i in range(40)}, {f"s{i}": (20 + 97 * i) ** 0.5 for i in range(40)}), ({"a": 9000, "b": 1, "c": 700}, {"a": 0.7, "b": 3, "c": 0.1})])
def test_whole_mix_is_less_than_a_block_from_its_due(blocks, weights):
    slots = mixing.schedule(blocks, weights)
    assert {s: len(x) for s, x in slots.items()} == blocks and sorted(t for x in slots.values() for t in x) == list(range(sum(blocks.values())))
    order = {t: s for s, x in slots.items() for t in x}
    seen, fluid = dict.fromkeys(blocks, 0), dict.fromkeys(blocks, 0.0)
    for t in range(len(order)):
        seen[order[t]] += 1
        left = 1.0  # one slot of the fluid mix
        while left > 1e-9 and (on := {s for s in blocks if fluid[s] < blocks[s] - 1e-7}):
            total = sum(weights[s] for s in on)
            step = min(left / total, *((blocks[s] - fluid[s]) / weights[s] for s in on))
            for s in on:
                fluid[s] += step * weights[s]
            left -= step * total
        assert all(abs(seen[s] - fluid[s]) < 1 + 1e-5 for s in blocks)


def test_sources_of_no_weight_come_last():
    assert {s: list(x) for s, x in mixing.schedule({"a": 2, "b": 1, "c": 1}, {"a": 0, "b": 1, "c": 1}).items()} == {"b": [0], "c": [1], "a": [2, 3]}


def test_mix_places_every_row_once_and_keeps_its_due(spark):
    rows = [(i, ["a", "b", "c", None][i % 7 % 4], None if i % 5 else "t") for i in range(3000)] + [(1, "a", "t"), (1, "a", "t")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, Position string")
    weights = {"a": 5, "b": 3, "c": 1, None: 1}
    got = mixing.mix(docs, weights, block=4).collect()
    assert Counter((r.doc_id, r.source) for r in got) == Counter(r[:2] for r in rows)
    assert len({r.position for r in got}) == len(rows)
    slots = {}
    for r in got:
        assert slots.setdefault(r.slot, r.source) == r.source
    assert sorted(slots) == list(range(len(slots)))
    blocks = Counter(slots.values())
    end = min(blocks[s] / (w / 10) for s, w in weights.items())  # the first source to end
    seen = Counter()
    for n in range(int(end) - 1):
        seen[slots[n]] += 1
        assert all(abs(seen[s] - (n + 1) * w / 10) < 1 + 1e-9 for s, w in weights.items())


def test_mix_of_nothing_and_of_too_many(spark):
    assert mixing.mix(spark.createDataFrame([], "doc_id long, source string")).count() == 0
    with pytest.raises(ValueError, match="sources"):
        mixing.mix(spark.createDataFrame([(i, f"s{i}") for i in range(600)], "doc_id long, source string"))


def test_query_mixes_any_number_of_sources(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"s{i % 700}") for i in range(2000)], "doc_id long, source string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = mixing.op6_mixing(spark, str(tmp_path)).collect()
    assert Counter((r.doc_id, r.source) for r in got) == Counter(map(tuple, docs.collect()))
    assert len({r.position for r in got}) == 2000 and sorted(r.slot for r in got if r.position % 8 == 0) == list(range(700))


def test_files_hold_the_mix_in_order(spark):
    docs = spark.createDataFrame([(i, f"s{i % 3}") for i in range(500)], "doc_id long, source string")
    got = [r.position for r in mixing.in_order(mixing.mix(docs)).collect()]
    assert got == sorted(got)


def whole_ids(text):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(f"{packing.default_vocabulary()}.json")
    return (t.encode(text, add_special_tokens=False).ids if text else []) + [0]


@pytest.mark.parametrize("size", [1024, 64])
def test_packing_is_a_round_trip(docs, corpus, size):
    extra = docs.unionByName(docs.sparkSession.createDataFrame([(900, "a<|endoftext|>b \n\n  c"), (901, "it's  1234 ?!\t")], "doc_id long, text string"))
    pieces = packing.pack(extra, packing.default_vocabulary(), size, open_windows=4).collect()
    by_sequence: dict = {}
    for p in pieces:
        assert len(p.ids) == 4 * p.length > 0
        by_sequence.setdefault(p.sequence_id, []).append(p)
    for ps in by_sequence.values():
        at = 0
        for p in sorted(ps, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= size
    short = Counter(s >> 40 for s, ps in by_sequence.items() if sum(p.length for p in ps) < size)
    assert max(short.values(), default=0) <= 1
    texts = Counter(whole_ids_key(t) for _, t in [*corpus, (900, "a<|endoftext|>b \n\n  c"), (901, "it's  1234 ?!\t")])
    rebuilt = Counter()
    by_doc: dict = {}
    for p in pieces:
        by_doc.setdefault((p.doc_id, p.doc_tokens), []).append(p)
    for (_, total), ps in by_doc.items():
        ps.sort(key=lambda p: (p.start, p.sequence_id, p.offset))
        copies = sum(p.length for p in ps) // total
        rows = [ps] if copies == 1 else split(ps, total)
        for row in rows:
            rebuilt[b"".join(bytes(p.ids) for p in row)] += 1
    assert rebuilt == texts


def whole_ids_key(text):
    return np.array(whole_ids(text), "<u4").tobytes()


def split(pieces, total):
    """Rows that share an id: pieces dealt to documents by their starts."""
    rows: list = []
    for p in pieces:
        for row in rows:
            if row[-1].start + row[-1].length == p.start:
                row.append(p)
                break
        else:
            rows.append([p])
    return rows


def test_packing_nothing(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), packing.default_vocabulary()).count() == 0


def test_schedule_equals_brute_force():
    """Earliest deadline first slot by slot, with windows from the fluid mix computed anew for each block."""
    rng = random.Random(12)
    for _ in range(12):
        n = {f"s{i}": rng.randint(1, 25) for i in range(rng.randint(1, 5))}
        w = {s: Fraction(rng.uniform(0.01, 1)) for s in n}

        def passed(v, n=n, w=w):
            return sum((min(w[s] * v, Fraction(n[s])) for s in n), Fraction(0))

        windows = {(s, k): (math.floor(passed(k / w[s])), math.ceil(passed((k + 1) / w[s]))) for s in n for k in range(n[s])}
        names, done, order = list(n), dict.fromkeys(n, 0), []
        for slot in range(sum(n.values())):
            able = [(windows[s, done[s]][1], i) for i, s in enumerate(names) if done[s] < n[s] and windows[s, done[s]][0] <= slot]
            deadline, i = min(able)
            assert deadline > slot
            order.append(names[i])
            done[names[i]] += 1
        got = mixing.schedule(n, {s: float(x) for s, x in w.items()})
        assert [s for _, s in sorted((t, s) for s in got for t in got[s])] == order


def test_real_weights_stay_within_a_block_over_many_slots():
    rng = random.Random(13)
    w = {f"s{i}": rng.uniform(0.0001, 1) for i in range(6)}
    total = sum(w.values())
    n = {s: int(200_000 * x / total) + 10 for s, x in w.items()}
    slots = mixing.schedule(n, w)
    for s, x in w.items():
        own = list(slots[s])[: n[s] - 15]
        assert all(abs(k + 1 - (t + 1) * x / total) < 1.001 and abs(k - t * x / total) < 1.001 for k, t in enumerate(own))


def test_blocks_grow_where_the_plan_would(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MOST_BLOCKS", 40)
    docs = spark.range(1000).selectExpr("id AS doc_id", "CAST(id % 3 AS STRING) AS source")
    rows = mixing.mix(docs).collect()
    assert len(rows) == 1000 and len({r.position for r in rows}) == 1000 and max(r.slot for r in rows) < 43
