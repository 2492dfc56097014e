"""Language, URL verdicts and language-model scores."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from tramline.llm import language, language_model, urls

DATA = "/root/testdata/sf0.01"
LETTERS = {"xx": "abcdefgh", "yy": "fghijklm", "zz": "éèüöabñç"}


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(3)
    rows = [(i, " ".join("".join(rng.choice(LETTERS[g]) for _ in range(5)) for _ in range(rng.randint(3, 60))), g) for i, g in enumerate(sorted(LETTERS) * 60)]
    return spark.createDataFrame([*rows, (900, None, "xx"), (901, "123 !", "xx"), (902, "abc", None)], "doc_id long, text string, lang string")


def test_language_is_learned(labelled):
    docs = labelled.withColumn("out", language.held_out())
    model = language.fit(docs.where("not out"))
    got = language.predict(docs, model).collect()
    test = [r for r in got if r.out and r.lang and r.text and language.has_letter(r.text)]
    assert np.mean([r.lang == r.lang_pred for r in test]) > 0.95
    assert all(0 <= r.score <= 1 for r in got)
    assert {r.doc_id: (r.lang_pred, r.score) for r in got if r.doc_id in (900, 901)} == {900: ("und", 0.0), 901: ("und", 0.0)}


def test_held_out_accuracy_on_documents(spark):
    got = language.op8_language(spark, DATA)
    truth = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang")
    rows = got.join(truth, "doc_id").where("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.97


def test_language_without_labels_and_without_rows(spark):
    none = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert language.predict(none, language.fit(none)).first().lang_pred == "und"
    assert language.predict(none.limit(0), language.fit(none)).count() == 0


def test_presence_holds_the_grams(labelled):
    texts = [r.text for r in labelled.where("text is not null").limit(30).collect()]
    x = language.presence(texts)
    grams = [set(np.concatenate(list(language.grams(t))).tolist()) for t in texts]
    assert [set(np.flatnonzero(r).tolist()) for r in x] == grams


def test_scores_equal_direct_kernel_ridge_regression(labelled):
    """Kernels from sets, Nystroem features of all fitted rows as landmarks, and a solve, against the fitted model."""
    docs = labelled.where("doc_id < 24")
    model = language.fit(docs, landmarks=1000)
    rows = [(r.lang, r.text) for r in docs.collect()]
    sets = [set(np.concatenate(list(language.grams(t))).tolist()) for _, t in rows]
    kernel = np.array([[len(a & b) / np.sqrt(len(a) * len(b)) for b in sets] for a in sets])
    values, vectors = np.linalg.eigh(kernel)
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    phi = np.hstack([kernel @ root, np.ones((len(rows), 1))])
    y = np.array([[1.0 if g == name else -1.0 for name in model.languages] for g, _ in rows])
    beta = np.linalg.solve(phi.T @ phi + language.RIDGE * np.eye(phi.shape[1]), phi.T @ y)
    assert np.abs(model.scores(language.presence([t for _, t in rows])) - kernel @ root @ beta[:-1]).max() < 1e-3


URLS = [
    (1, "http://A.Example.NET/en/1?x=/fr/", "a.example.net", "/en/1", "example.net/en/", "allow"),
    (2, "https://example.net/de/", "example.net", "/de/", "net/", "block"),
    (3, "https://badexample.com/de/", "badexample.com", "/de/", None, None),
    (4, "https://x.example.com/de/1", "x.example.com", "/de/1", "example.com/de/", "block"),
    (5, "https://q.org/fr/#a://b", "q.org", "/fr/", "org/fr/", "allow"),
    (6, "https://net", "net", "", None, None),
    (7, None, "", "", None, None),
    (8, "no scheme", "", "", None, None),
    (9, "://net/ÄB?", "net", "/ÄB", "net/", "block"),
]


def test_hosts_paths_and_rules(spark):
    pages = spark.createDataFrame([(i, u, 1) for i, u, *_ in URLS], "page_id long, url string, Host int")
    got = {r.page_id: r for r in urls.judge(pages).collect()}
    for i, _, host, path, rule, verdict in URLS:
        r = got[i]
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")


def test_trees_learn_a_rule():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(2000, 5))
    y = ((x[:, 1] > 0.3) ^ (x[:, 3] > 0)).astype(float)
    prior, trees = urls.boost(x[:1500], y[:1500])
    p = prior + sum(t.predict(x[1500:]) for t in trees)
    assert np.mean((p > 0) == y[1500:]) > 0.93


def test_first_split_equals_brute_force():
    """The root of a tree of depth 1 against every cut of every feature, and its leaves against Newton steps."""
    rng = np.random.default_rng(9)
    x, y = rng.integers(0, 12, (300, 4)).astype(float), rng.integers(0, 2, 300).astype(float)
    y[x[:, 2] > 7] = 1
    prior, (tree,) = urls.boost(x, y, trees=1, depth=1, rate=1.0, bins=64)
    p = 1 / (1 + np.exp(-prior))
    g, h = y - p, np.full(300, p * (1 - p))
    gain = lambda m: g[m].sum() ** 2 / (h[m].sum() + 1) + g[~m].sum() ** 2 / (h[~m].sum() + 1)
    best = max((gain(x[:, f] <= c), f, c) for f in range(4) for c in np.unique(x[:, f])[:-1])
    low = x[:, tree.feature[0]] <= tree.cut[0]
    assert abs(gain(low) - best[0]) < 1e-9
    want = np.where(low, g[low].sum() / (h[low].sum() + 1), g[~low].sum() / (h[~low].sum() + 1))
    assert np.abs(tree.predict(x) - want).max() < 1e-12


def test_urls_without_rules_or_rows(spark):
    pages = spark.createDataFrame([(1, "http://a.b/c")], "page_id long, url string")
    assert urls.judge(pages, rules=()).first().verdict == "allow"
    assert urls.judge(pages.limit(0)).count() == 0


def counted(spark, texts):
    return language_model.vocabulary(spark.createDataFrame([(t,) for t in texts], "text string"))


def test_every_word_is_counted(spark):
    rng = random.Random(2)
    texts = [" ".join(f"w{min(rng.randint(0, 900), rng.randint(0, 900))}" for _ in range(rng.randint(0, 80))) for _ in range(200)] + [None, "", " "]
    vocab = counted(spark, texts)
    want = Counter(w for t in texts for w in (t or "").split())
    hasher, bits = language_model.Hasher(), len(vocab.counts).bit_length() - 1
    with np.errstate(over="ignore"):
        at = {w: int(language_model.words(w, hasher)[0] >> np.uint64(64 - bits)) for w in want}
    sums = Counter()
    for w, n in want.items():
        sums[at[w]] += n
    assert {i: int(vocab.counts[i]) for i in np.flatnonzero(vocab.counts)} == dict(sums)
    assert set(vocab.frequent.tolist()) <= set(sums) and len(vocab.frequent) == language_model.FREQUENT
    assert min(sums[i] for i in vocab.frequent.tolist()) >= max(n for i, n in sums.items() if i not in set(vocab.frequent.tolist()))
    with np.errstate(over="ignore"):
        found, inner = vocab.classes(texts[0], hasher)
    of = {i: c for c, i in enumerate(vocab.frequent.tolist())}
    classes = [of.get(at[w], language_model.FREQUENT + at[w] % language_model.REST) for w in texts[0].split()]
    size = Counter()
    for i, n in sums.items():
        size[of.get(i, language_model.FREQUENT + i % language_model.REST)] += n
    assert found.tolist() == classes
    assert abs(inner - sum(np.log(sums[at[w]] / size[c]) for w, c in zip(texts[0].split(), classes, strict=True))) < 1e-4


def small_network():
    vocab = language_model.Vocabulary.of(np.random.default_rng(1).integers(0, 9, 1 << 10).astype(np.float32))
    net = language_model.Network.fresh(vocab)
    return language_model.Network((net.weights * 3).astype(np.float64))


def test_log_probabilities_equal_a_plain_loop():
    net, rng = small_network(), np.random.default_rng(4)
    texts = [rng.integers(0, language_model.CLASSES, n).astype(np.uint8) for n in (1, 2, 7, 30)]
    line, at = language_model.in_one_line(texts)
    got = iter(net.log_probabilities(line, at).tolist())
    e, b, u, c = net.split(net.weights)
    for t in texts:
        for i, y in enumerate(t):
            sides = [t[i + o] if 0 <= i + o < len(t) else language_model.CLASSES for o in language_model.OFFSETS]
            z = np.tanh(sum(e[j][s] for j, s in enumerate(sides)) + b) @ u + c
            assert abs(next(got) - (z[y] - np.log(np.exp(z).sum()))) < 1e-9


def test_gradients_equal_differences():
    net, rng = small_network(), np.random.default_rng(5)
    sides, tokens = rng.integers(0, language_model.CLASSES + 1, (40, 4)), rng.integers(0, language_model.CLASSES, 40)
    g = net.gradient(sides, tokens)

    def loss(weights):
        _, p = language_model.Network(weights).forward(sides)
        return -np.log(p[np.arange(40), tokens] / p.sum(axis=1)).mean()

    ends = np.cumsum([0, *(int(np.prod(s)) for s in net.shapes())])
    at = np.concatenate([np.flatnonzero(g[: ends[1]])[:40], *(rng.integers(a, b, 40) for a, b in zip(ends[1:], ends[2:], strict=False))])
    for i in at:
        step = np.zeros(len(g))
        step[i] = 1e-5
        assert abs((loss(net.weights + step) - loss(net.weights - step)) / 2e-5 - g[i]) < 1e-7


def test_every_word_is_learned_once(spark, monkeypatch):
    docs = spark.createDataFrame([(" ".join(f"w{i % 7}" for i in range(n)),) for n in (1, 2, 3, 50, 5000)], "text string")
    weights, summed = [], language_model.summed

    def seen(rows):
        weights.append(summed(rows)[1])
        return summed(rows)

    monkeypatch.setattr(language_model, "summed", seen)
    vocab = language_model.vocabulary(docs)
    language_model.train(language_model.tokenised(docs.selectExpr("1L AS doc_id", "text"), vocab), vocab)
    assert len(weights) == language_model.ROUNDS and sum(weights) == 5056


def test_texts_score_above_their_shuffled_words(spark):
    """With the query's own parameters, of documents of 50 words and more."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text")
    vocab = language_model.vocabulary(docs)
    net = language_model.train(language_model.tokenised(docs, vocab).coalesce(1), vocab)
    rng, rows = random.Random(6), []
    for r in docs.where("text IS NOT NULL").collect():
        words = r.text.split()
        if len(words) >= 50:
            rng.shuffle(words)
            rows += [(2 * r.doc_id, r.text), (2 * r.doc_id + 1, " ".join(words))]
    probe = language_model.tokenised(spark.createDataFrame(rows, "doc_id long, text string"), vocab)
    got = {r.doc_id: r.log_likelihood for r in language_model.score(probe, net).collect()}
    assert np.mean([got[d] > got[d + 1] for d in got if d % 2 == 0]) >= 0.9


def test_scores_of_nulls_repeats_and_long_texts(spark):
    rows = [(1, None, 1), (2, "", 2), (3, "a b c", 3), (3, "a b c", 4), (None, "a b c", 5), (4, "x y " * 40_000, 6)]
    got = language_model.scored(spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")).collect()
    assert sorted(r.n_tokens for r in got) == [0, 0, 3, 3, 3, 80_000]
    same = [r.log_likelihood for r in got if r.n_tokens == 3]
    assert max(same) - min(same) < 1e-5 * abs(same[0])
    assert all(r.mean_log_likelihood is None and r.log_likelihood == 0 for r in got if not r.n_tokens)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert language_model.vocabulary(empty) is None and language_model.scored(empty).count() == 0
    blank = language_model.scored(spark.createDataFrame([(1, " ")], "doc_id long, text string")).collect()
    assert [(r.n_tokens, r.log_likelihood) for r in blank] == [(0, 0.0)]
