"""URL verdicts: rules on host and path, and gradient-boosted trees on lexical features for the urls without a rule."""

from __future__ import annotations

import math
import string
from collections import Counter
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read

#: (verdict, rule): a host and all its subdomains, and a prefix of the path.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
TRAIN_URLS = 20_000  # at most about so many labelled urls are fitted
SUFFIX_BUCKETS = 4096
FEATURES = ("length", "host_length", "labels", "depth", "path_length", "digit_ratio", "entropy", "parameters", "hyphens", "upper_ratio", "suffix1", "suffix2", "extension")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What is between the first ``://`` and ``/``, ``?`` or ``#``, A-Z lower-cased, and then up to ``?`` or ``#``; else empty."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, or nulls."""
    found = []
    for verdict, rule in sorted(rules, key=lambda r: -len(r[1])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit(f".{name}"))) & F.startswith(path, F.lit(slash + rest))
        found.append((fits, rule, verdict))
    if not found:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    return F.coalesce(*(F.when(f, r) for f, r, _ in found)), F.coalesce(*(F.when(f, v) for f, _, v in found))


def suffixes(host: Column, path: Column) -> list[Column]:
    """Buckets of the host's last label, its last two, and the path's file extension."""
    ends = [F.substring_index(host, ".", -1), F.substring_index(host, ".", -2), F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1)]
    return [F.pmod(F.xxhash64(F.lit(i), e), F.lit(SUFFIX_BUCKETS)).cast("int") for i, e in enumerate(ends)]


def lexical(url: str | None, host: str, path: str) -> list[float]:
    url = url or ""
    n = max(len(url), 1)
    counts = Counter(url)
    query = url.partition("?")[2].partition("#")[0]
    return [
        len(url),
        len(host),
        host.count(".") + 1 if host else 0,
        sum(1 for p in path.split("/") if p),
        len(path),
        sum(c in string.digits for c in url) / n,
        -sum(c / n * math.log2(c / n) for c in counts.values()),
        sum(1 for p in query.split("&") if p),
        url.count("-"),
        sum(c in string.ascii_uppercase for c in url) / n,
    ]


@dataclass
class Tree:
    feature: list = field(default_factory=list)
    cut: list = field(default_factory=list)
    left: list = field(default_factory=list)
    right: list = field(default_factory=list)
    value: list = field(default_factory=list)

    def node(self) -> int:
        for column, empty in ((self.feature, -1), (self.cut, 0.0), (self.left, 0), (self.right, 0), (self.value, 0.0)):
            column.append(empty)
        return len(self.value) - 1

    def predict(self, x):
        import numpy as np

        feature, cut, left, right = (np.array(c) for c in (self.feature, self.cut, self.left, self.right))
        at = np.zeros(len(x), np.int64)
        while (inner := feature[at] >= 0).any():
            rows, nodes = np.flatnonzero(inner), at[inner]
            at[rows] = np.where(x[rows, feature[nodes]] <= cut[nodes], left[nodes], right[nodes])
        return np.array(self.value)[at]


@dataclass
class Model:
    prior: float
    rates: list  # of each suffix: blocked share by bucket, smoothed towards the prior share
    share: float
    trees: list

    def features(self, frame):
        import numpy as np

        words = np.array([lexical(u, h, p) for u, h, p in zip(frame["url"], frame["host"], frame["path"], strict=True)], float).reshape(-1, 10)
        rates = [[r.get(int(b), self.share) for b in frame[f"s{i}"]] for i, r in enumerate(self.rates)]
        return np.hstack([words, np.array(rates).T.reshape(-1, len(self.rates))])

    def score(self, frame):
        import numpy as np

        x = self.features(frame)
        return 1 / (1 + np.exp(-(self.prior + sum((t.predict(x) for t in self.trees), np.zeros(len(x))))))


def boost(x, y, trees: int = 40, depth: int = 3, rate: float = 0.2, bins: int = 32, ridge: float = 1.0) -> tuple[float, list[Tree]]:
    """Gradient boosting of the logistic loss with histogram splits and Newton leaf values; deterministic."""
    import numpy as np

    share = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
    prior = math.log(share / (1 - share))
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T, strict=True)], axis=1)
    out, margin = [], np.full(len(y), prior)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, p * (1 - p)
        tree = Tree()
        todo = [(tree.node(), np.arange(len(y)), 0)]
        while todo:
            node, rows, level = todo.pop()
            tg, th = g[rows].sum(), h[rows].sum()
            tree.value[node] = rate * tg / (th + ridge)
            best = (1e-6, -1, 0)
            for f in range(x.shape[1]) if level < depth else ():
                m = len(cuts[f]) + 1
                lg = np.cumsum(np.bincount(binned[rows, f], g[rows], m))[:-1]
                lh = np.cumsum(np.bincount(binned[rows, f], h[rows], m))[:-1]
                gain = lg**2 / (lh + ridge) + (tg - lg) ** 2 / (th - lh + ridge) - tg**2 / (th + ridge)
                gain[(lh < 1e-3) | (th - lh < 1e-3)] = 0
                if len(gain) and gain.max() > best[0]:
                    best = (gain.max(), f, int(gain.argmax()))
            if best[1] >= 0:
                _, f, b = best
                tree.feature[node], tree.cut[node] = f, float(cuts[f][b])
                tree.left[node], tree.right[node] = tree.node(), tree.node()
                low = binned[rows, f] <= b
                todo += [(tree.left[node], rows[low], level + 1), (tree.right[node], rows[~low], level + 1)]
        margin = margin + tree.predict(x)
        out.append(tree)
    return prior, out


def fit(labelled: DataFrame, train_urls: int = TRAIN_URLS) -> Model | None:
    """labelled: url, host, path, s0..s2, blocked (0/1). Suffix statistics count all rows; trees are fitted on a sample
    drawn by a hash of the url, of about train_urls distinct urls at most. None without rows."""
    import numpy as np

    total = labelled.agg(F.count(F.lit(1)).alias("n"), F.sum("blocked").alias("b"), F.approx_count_distinct("url").alias("d")).first()
    if not total["n"]:
        return None
    share = total["b"] / total["n"]
    rates = []
    for i in range(3):
        got = labelled.groupBy(f"s{i}").agg(F.count(F.lit(1)).alias("n"), F.sum("blocked").alias("b")).collect()  # SUFFIX_BUCKETS rows at most
        rates.append({r[0]: (r["b"] + 5 * share) / (r["n"] + 5) for r in got})
    parts = 1 << 40
    sample = labelled.where(F.pmod(F.xxhash64("url"), F.lit(parts)) < min(parts, parts * train_urls // max(total["d"], 1) + 1)).distinct().toPandas()
    model = Model(0.0, rates, share, [])
    if share in (0, 1) or not len(sample):
        model.prior = -10.0 if share < 0.5 else 10.0
        return model
    sample = sample.sort_values(["url", "blocked"], kind="stable")
    model.prior, model.trees = boost(model.features(sample), sample["blocked"].to_numpy(float))
    return model


def judge(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict, block_score for every row.

    The verdict is the rule's, or else the trees' (block from a score of 0.5). The labelled urls are those that a rule
    decides. A null url or one without ``://`` has an empty host and path and goes to the trees; without labelled urls
    every other url is allowed with score 0. Repeated rows get equal verdicts; other columns are not read.
    """
    host, path = host_and_path(F.col("url"))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url")).withColumns({"host": host, "path": path})
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    s = suffixes(F.col("host"), F.col("path"))
    rows = rows.withColumns({"rule": rule, "ruled": verdict, "s0": s[0], "s1": s[1], "s2": s[2]})
    model = fit(rows.where("ruled is not null").select("url", "host", "path", "s0", "s1", "s2", (F.col("ruled") == "block").cast("int").alias("blocked")))
    if model is None:
        score = F.lit(0.0)
    else:
        held = pages.sparkSession.sparkContext.broadcast(model)

        @F.pandas_udf("double")
        def scored(url, host, path, s0, s1, s2):
            import pandas as pd

            return pd.Series(held.value.score(pd.DataFrame({"url": url, "host": host, "path": path, "s0": s0, "s1": s1, "s2": s2})))

        score = scored("url", "host", "path", "s0", "s1", "s2")
    rows = rows.withColumn("block_score", score)
    decided = F.coalesce("ruled", F.when(F.col("block_score") >= 0.5, "block").otherwise("allow"))
    return rows.select("page_id", "host", "path", "rule", decided.alias("verdict"), "block_score")


def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read(spark, sf_dir, "pages"))
