"""Masked pseudo-likelihood: a network sees two words on each side of every word and predicts it.

Every word of the corpus is counted. The network, trained in numpy, predicts the word's class from the classes on both
sides; the FREQUENT most frequent words are classes of their own, all others share REST classes. With the counts,
log P(word | both sides) = log P(class | both sides) + log P(word | class).
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop_written, read, small_batches, written
from .hashing import Hasher, words

BITS = 24  # of the words' hashes by which they are counted; fewer in a corpus of fewer words
FREQUENT, REST = 192, 64
CLASSES = FREQUENT + REST
OFFSETS = (-2, -1, 1, 2)
EDGE = 2
HIDDEN = 16
ROUNDS = 2
MASKED = 2  # in each round one token of so many is masked and learned, in every document; in ROUNDS rounds each once
BATCH = 1024
RATE = 0.2
CAUTION = 1e-6  # first value of Adagrad's sums of squares
HELD = 1 << 15  # tokens that are learned or scored together
PARTS = 64  # of the counts, and of a task's numbers, which are summed apart


@dataclass
class Vocabulary:
    """counts: of the words by the first bits of their hashes; frequent: those of the frequent words, in order."""

    counts: object
    frequent: object
    sizes: object  # words of each class

    @classmethod
    def of(cls, counts):
        import numpy as np

        some = min(FREQUENT, int(np.count_nonzero(counts)))
        least = np.partition(counts, len(counts) - some)[len(counts) - some]
        able = np.flatnonzero(counts >= least)
        frequent = np.sort(able[np.lexsort((able, -counts[able]))[:some]])
        rest = counts.astype(np.float64)
        rest[frequent] = 0
        shared = rest.reshape(-1, REST).sum(axis=0)
        sizes = np.concatenate([counts[frequent], np.zeros(FREQUENT - some), shared])
        return cls(counts, frequent, sizes)

    def classes(self, text: str | None, hasher: Hasher):
        """The class of each word of the text, and log P(word | class) summed over them. A word that was never counted
        counts as half a word."""
        import numpy as np

        bits = int(len(self.counts)).bit_length() - 1
        at = (words(text or "", hasher) >> np.uint64(64 - bits)).astype(np.int64)
        near = np.minimum(np.searchsorted(self.frequent, at), len(self.frequent) - 1)
        found = np.where(self.frequent[near] == at, near, FREQUENT + at % REST)
        inner = np.log(np.maximum(self.counts[at], 0.5)) - np.log(np.maximum(self.sizes, 0.5))[found]
        return found.astype(np.uint8), float(inner.sum(dtype=np.float64))


def vocabulary(docs: DataFrame) -> Vocabulary | None:
    """docs: text. Counts every word of every document. Each task sends its distinct words; PARTS ranges of hashes are
    summed apart. The table that comes to the driver grows with the corpus up to 2 to the BITS counts (64 MB); beyond
    that, words whose hashes agree in BITS bits are counted together. None if there is no word."""
    import numpy as np

    def run(batches):
        import pandas as pd

        hasher, held, size = Hasher(), [], 0
        at, n = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def merged():
            found, times = np.unique(np.concatenate(held), return_counts=True)
            both, back = np.unique(np.concatenate([at, found]), return_inverse=True)
            return both, np.bincount(back, np.concatenate([n, times])).astype(np.int64)

        with np.errstate(over="ignore"):
            for b in batches:
                for text in b["text"]:
                    held.append((words(text or "", hasher) >> np.uint64(64 - BITS)).astype(np.int64))
                    size += len(held[-1])
                    if size > 1 << 21:
                        at, n = merged()
                        held, size = [], 0
        if held:
            at, n = merged()
        cuts = np.searchsorted(at, np.arange(PARTS + 1) << (BITS - 6))
        rows = [(i, int(n[a:b].sum()), at[a:b].astype(np.uint32).tobytes(), n[a:b].tobytes()) for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)) if b > a]
        yield pd.DataFrame(rows, columns=["part", "words", "at", "n"])

    table = written(small_batches(docs).select("text").mapInPandas(run, "part int, words long, at binary, n binary"), "words")
    total = table.agg(F.sum("words")).first()[0]
    if not total:
        drop_written(table)
        return None
    bits = min(BITS, max(16, int(total).bit_length()))

    def add(batches):
        import pandas as pd

        sums: dict[int, object] = {}
        for b in batches:
            for part, at, n in zip(b["part"], b["at"], b["n"], strict=True):
                own = sums.setdefault(part, np.zeros(1 << (bits - 6)))
                place = (np.frombuffer(at, np.uint32).astype(np.int64) >> (BITS - bits)) - (part << (bits - 6))
                own += np.bincount(place, np.frombuffer(n, np.int64), len(own))
        yield pd.DataFrame([(p, x.astype(np.float32).tobytes()) for p, x in sums.items()], columns=["part", "numbers"])

    rows = table.select("part", "at", "n").repartition("part").mapInPandas(add, "part int, numbers binary").collect()
    counts = np.zeros(1 << bits, np.float32)
    for r in rows:
        own = np.frombuffer(r["numbers"], np.float32)
        counts[r["part"] * len(own) : (r["part"] + 1) * len(own)] = own
    drop_written(table)
    return Vocabulary.of(counts)


def tokenised(docs: DataFrame, vocab: Vocabulary | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, inner (log P(word | class), summed), classes (a byte for each word)."""
    held = docs.sparkSession.sparkContext.broadcast(vocab)  # 64 MB at most

    def run(batches):
        import numpy as np
        import pandas as pd

        hasher, own = Hasher(), held.value
        for b in batches:
            rows = []
            with np.errstate(over="ignore"):
                for doc, text in zip(b["doc_id"], b["text"], strict=True):
                    found, inner = own.classes(text, hasher) if own is not None else (np.zeros(0, np.uint8), 0.0)
                    rows.append((None if pd.isna(doc) else int(doc), len(found), inner, found.tobytes()))
            yield pd.DataFrame(rows, columns=["doc_id", "n_tokens", "inner", "classes"]).astype({"doc_id": "Int64"})

    rows = small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInPandas(run, "doc_id long, n_tokens long, inner double, classes binary")


def in_one_line(texts: list):
    """Arrays of classes in one, with EDGE places that stand for what is beyond a text around each, and their places."""
    import numpy as np

    sizes = np.array([len(t) for t in texts], np.int64)
    gap = np.full(EDGE, CLASSES, np.int16)
    line = np.concatenate([gap, *(x for t in texts for x in (t, gap))])
    first = EDGE + np.cumsum(sizes + EDGE) - (sizes + EDGE)
    return line, np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


def sides_of(line, at):
    import numpy as np

    return line[at[:, None] + np.array(OFFSETS)].astype(np.int64)


@dataclass
class Network:
    """Embeddings for each offset (one row more stands for what is beyond the text), output weights and biases."""

    weights: object  # all numbers in one array

    @staticmethod
    def shapes():
        return [(len(OFFSETS), CLASSES + 1, HIDDEN), (HIDDEN,), (HIDDEN, CLASSES), (CLASSES,)]

    @staticmethod
    def split(flat):
        import numpy as np

        ends = np.cumsum([int(np.prod(s)) for s in Network.shapes()])
        return [x.reshape(s) for x, s in zip(np.split(flat, ends[:-1]), Network.shapes(), strict=True)]

    @classmethod
    def fresh(cls, vocab: Vocabulary):
        """Small random weights; the biases are the classes' frequencies."""
        import numpy as np

        rng = np.random.default_rng(7)
        flat = np.concatenate([rng.normal(0, 0.1 if len(s) > 1 else 0, s).ravel() for s in cls.shapes()]).astype(np.float32)
        cls.split(flat)[3][:] = np.log((vocab.sizes + 0.5) / (vocab.sizes + 0.5).sum())
        return cls(flat)

    def forward(self, sides):
        """Hidden values, and for each class its share of the probability before they are scaled to 1."""
        import numpy as np

        e, b, u, c = self.split(self.weights)
        h = e[0][sides[:, 0]]
        for j in range(1, len(OFFSETS)):
            h += e[j][sides[:, j]]
        h += b
        np.tanh(h, out=h)
        z = h @ u
        z += c
        if np.abs(u).sum(axis=0).max() + np.abs(c).max() > 80:  # else no share over- or underflows
            z -= z.max(axis=1, keepdims=True)
        return h, np.exp(z, out=z)

    def log_probabilities(self, line, at):
        """log P(class | both sides) at the places of the line."""
        import numpy as np

        out = np.empty(len(at))
        for a in range(0, len(at), 1024):
            some = at[a : a + 1024]
            _, p = self.forward(sides_of(line, some))
            out[a : a + 1024] = np.log(np.maximum(p[np.arange(len(p)), line[some]] / p.sum(axis=1), 1e-30))
        return out

    def gradient(self, sides, tokens):
        """Of the mean of -log P(token | sides), in one array like the weights."""
        import numpy as np

        _, _, u, _ = self.split(self.weights)
        h, p = self.forward(sides)
        p /= p.sum(axis=1, keepdims=True) * len(p)
        p[np.arange(len(p)), tokens] -= 1 / len(p)
        dh = p @ u.T
        dh *= 1 - h * h
        g = np.zeros_like(self.weights)
        ge, gb, gu, gc = self.split(g)
        for j in range(len(OFFSETS)):
            order = np.argsort(sides[:, j], kind="stable")
            of = sides[order, j]
            first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
            ge[j][of[first]] = np.add.reduceat(dh[order], first, axis=0)
        gb[:], gc[:] = dh.sum(axis=0), p.sum(axis=0)
        np.matmul(h.T, p, out=gu)
        return g

    def learn(self, sides, tokens, squares, rate: float = RATE) -> None:
        """One Adagrad step on the cross-entropy of a batch."""
        import numpy as np

        g = self.gradient(sides, tokens)
        squares += g * g
        self.weights -= rate * g / (np.sqrt(squares) + np.float32(1e-6))


def summed(per_task: DataFrame):
    """per_task: task, part, weight, numbers (float64 bytes). The weighted means of each part's numbers, in order, and the
    total weight. Parts are summed in a stream, in the order of the tasks; PARTS rows come to the driver."""

    def run(batches):
        import numpy as np
        import pandas as pd

        totals: dict[int, list] = {}
        for b in batches:
            for part, weight, numbers in zip(b["part"], b["weight"], b["numbers"], strict=True):
                x = np.frombuffer(numbers, np.float64) * weight
                held = totals.setdefault(part, [0.0, np.zeros(len(x))])
                held[0] += weight
                held[1] += x
        yield pd.DataFrame([(p, w, x.tobytes()) for p, (w, x) in totals.items()], columns=["part", "weight", "numbers"])

    import numpy as np

    rows = per_task.repartition("part").sortWithinPartitions("part", "task").mapInPandas(run, "part int, weight double, numbers binary").collect()
    rows = sorted(rows, key=lambda r: r["part"])
    if not rows or not rows[0]["weight"]:
        return None, 0.0
    return np.concatenate([np.frombuffer(r["numbers"], np.float64) for r in rows]) / rows[0]["weight"], rows[0]["weight"]


def train(tokens: DataFrame, vocab: Vocabulary | None, rounds: int = ROUNDS, masked: int = MASKED) -> Network | None:
    """tokens: classes. Every task learns from the masked words of all its documents; the tasks' networks are averaged by
    the number of words they learned, and the next round starts from the mean. With as many rounds as ``masked``, every
    word of every document is learned once. Masked places follow from the text and the round, the order of steps from the
    order of rows in a task: other partitions of the same rows give another network, whose scores differ somewhat. None
    if there is no word."""
    import numpy as np

    if vocab is None:
        return None
    network = Network.fresh(vocab)
    for turn in range(rounds):
        held = tokens.sparkSession.sparkContext.broadcast(network)  # a fixed size

        def run(batches, turn=turn, held=held):
            import pandas as pd

            own = Network(held.value.weights.copy())
            squares, learned, rng = np.full(len(own.weights), CAUTION, np.float32), 0, np.random.default_rng(turn)
            texts, size = [], 0

            def step():
                nonlocal learned
                line, at = in_one_line(texts)
                place = np.concatenate([np.arange(len(t)) + zlib.crc32(t) for t in texts])  # of which one in ``masked`` is learned
                at = rng.permutation(at[(place + turn) % masked == 0])
                for a in range(0, len(at), BATCH):
                    some = at[a : a + BATCH]
                    own.learn(sides_of(line, some), line[some], squares)
                learned += len(at)

            for b in batches:
                for text in b["classes"]:
                    texts.append(np.frombuffer(text, np.uint8))
                    size += len(text)
                    if size >= HELD:
                        step()
                        texts, size = [], 0
            if size:
                step()
            task = TaskContext.get().partitionId()
            rows = [(task, i, float(learned), p.astype(np.float64).tobytes()) for i, p in enumerate(np.array_split(own.weights, PARTS))]
            yield pd.DataFrame(rows, columns=["task", "part", "weight", "numbers"])

        mean, weight = summed(tokens.select("classes").mapInPandas(run, "task int, part int, weight double, numbers binary"))
        if weight:
            network = Network(mean.astype(np.float32))
    return network


def score(tokens: DataFrame, network: Network | None) -> DataFrame:
    """A row per document: doc_id, n_tokens, log_likelihood (sum over all its words of log P(word | both sides)) and
    mean_log_likelihood. Null texts and texts without a word have 0 words, sum 0 and a null mean. Equal texts get equal
    scores but for rounding in single precision, since texts are scored many at a time; repeated rows and null ids have
    rows of their own."""
    held = tokens.sparkSession.sparkContext.broadcast(network)

    def run(batches):
        import numpy as np
        import pandas as pd

        own = held.value
        for b in batches:
            texts = [np.frombuffer(t, np.uint8) for t in b["classes"]]
            sums, part, size = np.zeros(len(texts)), [], 0
            for i, t in enumerate(texts):
                part.append(i)
                size += len(t)
                if own is not None and size and (size >= HELD or i == len(texts) - 1):
                    line, at = in_one_line([texts[k] for k in part])
                    of = np.repeat(np.arange(len(part)), [len(texts[k]) for k in part])
                    sums[part] = np.bincount(of, own.log_probabilities(line, at), len(part))
                    part, size = [], 0
            n, total = b["n_tokens"].to_numpy(), sums + b["inner"].to_numpy()
            mean = pd.Series(total / np.maximum(n, 1)).where(n > 0).astype("Float64")
            yield pd.DataFrame({"doc_id": b["doc_id"].astype("Int64").array, "n_tokens": n, "log_likelihood": total, "mean_log_likelihood": mean.array})

    return tokens.mapInPandas(run, "doc_id long, n_tokens long, log_likelihood double, mean_log_likelihood double")


def scored(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The scores of docs (see score) by a network trained on them. Columns other than the two named are not read."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    vocab = vocabulary(rows)
    tokens = written(tokenised(rows, vocab), "tokens")
    return score(tokens, train(tokens, vocab))


def op2_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(read(spark, sf_dir, "documents"))
