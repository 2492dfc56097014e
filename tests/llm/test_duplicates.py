"""Near-duplicates, repeated passages and near vectors against brute force."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from tramline.llm import embeddings, minhash, suffix
from tramline.llm.common import components, joined_labels, ranked


def grouped(nodes, links):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def sets_of(rows, size):
    out = []
    for d, t in rows:
        w = (t or "").encode().lower().split()
        out.append((d, frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset()))
    return out


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates(docs, corpus, size):
    sets = [(d, s) for d, s in sets_of(corpus, size)]
    named = [(d, s) for d, s in sets if d is not None]
    links = [(a, b) for i, (a, s) in enumerate(named) for b, t in named[:i] if s and t and 100 * len(s & t) >= 80 * len(s | t)]
    roots = grouped({d for d, _ in named}, links)
    want = sorted((str(d), len(s), str(roots.get(d)), d is None or roots[d] == d) for d, s in sets)
    got = minhash.near_duplicates(docs, size).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in got) == want


def test_chains_of_short_texts_lose_no_link(spark):
    rng = random.Random(4)
    rows, text = [], [f"a{i}" for i in range(30)]
    for i in range(120):
        if i % 20 == 0:
            text = [f"a{rng.randint(0, 40)}" for _ in range(rng.randint(2, 40))]
        text = text[:]
        text[rng.randrange(len(text))] = f"b{rng.randint(0, 9)}"
        rows.append((i, " ".join(text)))
    sets = sets_of(rows, 2)
    links = [(a, b) for a, s in sets for b, t in sets if a < b and 100 * len(s & t) >= 80 * len(s | t)]
    want = grouped([d for d, _ in sets], links)
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()
    assert {r.doc_id: r.component_id for r in got} == want


def test_contained_sets_at_the_threshold_lose_no_link(spark):
    """Families of a text, its first 80.1 to 82 %, and smaller decoys with lower ids that resemble both."""
    rng, rows, links = random.Random(8), [], 0
    for i in range(60):
        n = rng.choice([300, 700, 1500, 3000, 5000])
        text = [f"f{i}w{j}" for j in range(n + 1)]
        kept = int(n * rng.uniform(0.801, 0.82)) + 1
        for k in range(6):
            rows.append((100 * i + k, " ".join(text[: int(n * (0.4 + 0.05 * k))] + [f"d{i}k{k}x{j}" for j in range(n // 4)])))
        rows += [(100 * i + 50, " ".join(text)), (100 * i + 60, " ".join(text[: kept + 1]))]
        links += 1
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()}
    assert sum(got[100 * i + 60] == got[100 * i + 50] for i in range(60)) == links


def test_families_cut_into_many_blocks(spark, monkeypatch):
    """Near copies around the threshold, more than a block holds, against brute force."""
    monkeypatch.setattr(minhash, "BLOCK_ROWS", 8)
    rng, rows = random.Random(21), []
    for family in range(4):
        base = [f"f{family}w{j}" for j in range(100)]
        for i in range(60):
            text = base[:]
            for _ in range(rng.choice([3, 5, 7])):
                text[rng.randrange(len(text))] = f"y{rng.randint(0, 30)}"
            rows.append((1000 * family + i, " ".join(text)))
    sets = sets_of(rows, 2)
    links = [(a, b) for a, s in sets for b, t in sets if a < b and 100 * len(s & t) >= 80 * len(s | t)]
    want = grouped([d for d, _ in sets], links)
    assert 8 < len(set(want.values())) < 230
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()
    assert {r.doc_id: r.component_id for r in got} == want


def test_common_counts_and_joined_labels():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 300, rng.integers(1, 200))) for _ in range(70)]
    both = minhash.common_counts(sets)
    assert all(both[i, j] == len(np.intersect1d(sets[i], sets[j])) for i in range(70) for j in range(i + 1, 70))
    for _ in range(50):
        labels, n = rng.integers(0, 20, 30), rng.integers(0, 25)
        a, b = rng.integers(0, 30, n), rng.integers(0, 30, n)
        want = grouped(range(30), [*zip(a, b, strict=True), *((i, j) for i in range(30) for j in range(30) if labels[i] == labels[j])])
        low, high = joined_labels(labels, a, b)
        got = grouped(set(labels.tolist()), list(zip(low.tolist(), high.tolist(), strict=True)))
        same = lambda x, k: {(i, j) for i in range(30) for j in range(30) if x[k(i)] == x[k(j)]}
        assert same(got, lambda i: labels[i]) == same(want, int) and len(low) == len(set(labels.tolist())) - len(set(got.values()))


def test_near_duplicates_of_an_empty_table_and_with_clashing_columns(spark):
    empty = minhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string"), 2)
    assert empty.count() == 0 and empty.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    rows = [(1, "a b c", 5, "z", 0), (2, "a b c", 6, None, 1), (3, None, None, "z", 2)]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, rep long, component_id string, n long"), 2).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == [(1, 2, 1, True), (2, 2, 1, False), (3, 0, 3, True)]


def brute_removed(rows, length):
    """By (id, text) in order, as rows that share an id are ordered by a hash of their text."""
    seen, out = set(), {}
    for d, t in rows:
        data = (t or "").encode()
        gone = np.zeros(len(data), bool)
        for p in range(len(data) - length + 1):
            w = data[p : p + length]
            if w in seen:
                gone[p : p + length] = True
            seen.add(w)
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out[d, t] = (int(gone.sum()), runs, hashlib.sha256(np.frombuffer(data, np.uint8)[~gone].tobytes()).hexdigest())
    return out


@pytest.mark.parametrize("hot", [512, 1])
def test_repeated_passages(docs, corpus, hot, monkeypatch):
    monkeypatch.setattr(suffix, "HOT", hot)
    order = sorted(set(corpus), key=lambda r: (r[0] is not None, r[0] or 0))
    want = brute_removed(order, 100)
    got = suffix.without_repeats(docs).collect()
    assert len(got) == len(corpus)
    for r in got:
        assert (r.cut.removed, r.cut.runs, hashlib.sha256(bytes(r.cut.kept)).hexdigest()) == want[r.doc_id, r.text], (r.doc_id, r.text)


@pytest.mark.parametrize("hot", [512, 1])
def test_groups_have_all_occurrences_and_give_the_removal(docs, corpus, hot, monkeypatch):
    monkeypatch.setattr(suffix, "HOT", hot)
    order = sorted({(d, t or "") for d, t in corpus}, key=lambda r: (r[0] is not None, r[0] or 0))
    data = {r: r[1].encode() for r in order}
    rank, named = {r: i for i, r in enumerate(order)}, {}
    for d, t in order:
        named.setdefault(d, []).append((d, t))
    assert all(len(v) == 1 for v in named.values())
    groups = {}
    for r in suffix.repeat_groups(docs).collect():
        groups.setdefault((r.group_id, r.length), []).append((rank[named[r.doc_id][0]], r.at))
    gone = [np.zeros(len(data[r]), bool) for r in order]
    for (_, n), places in groups.items():
        places.sort()
        (first, start), *later = places
        string = data[order[first]][start : start + n]
        assert n >= 100 and later and len(set(places)) == len(places)
        want = [(i, p) for i, r in enumerate(order) for p in range(len(data[r]) - n + 1) if data[r].startswith(string[:8], p) and data[r].startswith(string, p)] if len(places) < 40 else places
        assert places == want
        for i, p in later:
            assert data[order[i]][p : p + n] == string
            gone[i][p : p + n] = True
    want = brute_removed([(d, t) for d, t in order], 100)
    for i, r in enumerate(order):
        assert (int(gone[i].sum()), hashlib.sha256(np.frombuffer(data[r], np.uint8)[~gone[i]].tobytes()).hexdigest()) == want[r][::2]


def test_passages_keep_columns_that_clash(spark):
    rows = spark.createDataFrame([(1, "x" * 150, 5, 6)], "doc_id long, text string, _doc int, _TAG int")
    got = suffix.without_repeats(rows, into="cut")
    assert got.columns == ["doc_id", "text", "_doc", "_TAG", "cut"] and got.first().cut.removed == 149


def test_chunks_of_long_texts_meet(spark, monkeypatch):
    rng = random.Random(8)
    long = "".join(rng.choice("abcdefgh") for _ in range(5000))
    data, hasher = np.frombuffer((long + long[100:2000]).encode(), np.uint8), suffix.Hasher()
    with np.errstate(over="ignore"):
        whole = suffix.runs(data, hasher)
        monkeypatch.setattr(suffix, "_CHUNK", 997)
        parts = suffix.runs(data, hasher)
    cover = lambda r: [(int(h), p) for h, at, n in zip(r[0], r[2], r[3], strict=True) for p in range(at, at + n)]
    assert cover(whole) == cover(parts)


def test_interval_tree_lists_maximal_repeats():
    text = [b"xabcdefgh1", b"yabcdefgh2", b"zabcdeq"]
    found = {v: sorted(m) for v, m, _ in suffix.repeats(text, [5, 5, 3], np.array([0, 100, 200]), 4, members=True)}
    assert found[8] == [(0, 1), (1, 1)] and found[5] == [(0, 1), (1, 1), (2, 1)]


def test_near_vectors(spark):
    rng = np.random.default_rng(5)
    centre = rng.normal(size=(4, 16))
    rows = [(i, [float(x) for x in (centre[i % 4] + rng.normal(size=16) * 0.22).astype(np.float32)], [0, 1, None][i % 3]) for i in range(240)]
    rows += [(300 + i, rows[0][1], 0) for i in range(50)] + [(400, None, 0), (401, [0.0] * 16, 0), (402, [float("nan")] * 16, 0), (403, [None] * 16, 1), (404, [float("inf")] * 16, 1), (405, [], 1), (406, [1.0, 2.0], 1), (407, [2.0, 4.0], 1), (None, rows[3][1], 0)]
    n, links = {}, []
    for i, (a, v, k) in enumerate(rows):
        n[i] = 0
        for j, (b, w, m) in enumerate(rows):
            ok = lambda x: x and all(c is not None and np.isfinite(c) for c in x) and any(x)
            if i != j and k is not None and k == m and ok(v) and ok(w) and len(v) == len(w) and np.dot(v, w) / np.linalg.norm(v) / np.linalg.norm(w) >= 0.93:
                n[i] += 1
                if a is not None and b is not None:
                    links.append((a, b))
    roots = grouped({r[0] for r in rows if r[0] is not None}, links)
    for tile in (2048, 16):
        got = embeddings.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), tile=tile).collect()
        assert sorted((str(r.vec_id), r.n_links) for r in got) == sorted((str(r[0]), n[i]) for i, r in enumerate(rows))
        assert {r.vec_id: r.component_id for r in got if r.vec_id is not None} == roots
        assert all(r.kept == (r.vec_id is None or r.vec_id == r.component_id) for r in got)


def test_quantisation_bounds_hold():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 70))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    q, s, e = embeddings.quantised(x)
    assert (np.linalg.norm(x - q * s[:, None], axis=1) <= e).all()
    want, certain, maybe = set(zip(*np.nonzero(x @ x.T >= 0.3), strict=True)), set(), set()
    for start, *found in embeddings.tile_pairs((q, s, e), (q, s, e), 0.3, 64):
        for into, (i, j) in zip((certain, maybe), found, strict=True):
            into |= set(zip(start + i, j, strict=True))
    assert certain <= want <= certain | maybe and 0 < len(maybe) < len(x) ** 2 / 20 and not certain & maybe


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(0, 70)] + [(1000, 1000 + i) for i in range(1, 90)] + [(5, 5), (1003, 1000)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(71), 0), **dict.fromkeys(range(1000, 1090), 1000)}


def test_ranks_are_gapless(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([(i % 3 if i % 7 else None, i // 2) for i in range(200)], "k int, v int")
    got = ranked(rows, ["k"], [F.col("v")], [F.col("v")], "r", parts=8).collect()
    for k in (None, 0, 1, 2):
        mine = sorted(r.r for r in got if r.k == k)
        assert mine == list(range(len(mine)))


@pytest.mark.parametrize("call", [lambda d: minhash.near_duplicates(d), lambda d: suffix.without_repeats(d), lambda d: suffix.repeat_groups(d)])
def test_empty_tables(spark, call):
    assert call(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_no_vectors(spark):
    assert embeddings.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0
