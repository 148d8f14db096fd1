"""Quality by hierarchical empirical Bayes: what a text looks like, and what its host and path have held so far.

A document's own odds come from a logistic classifier: on how much likelier its hashed uni- and
bigrams are in texts labelled good than in those labelled bad, and on a few figures of its form. The
n-grams are counted over one half of the labelled rows, the classifier is fitted on the other, so
that it weighs them by what they are worth on texts they weren't counted in. The mean odds over
a path is shrunk toward its host's, and that toward the global one; how strongly, follows from how
far hosts (and paths within hosts) really differ, by the method of moments. A sparse site so takes
over the rate above it, a large one keeps its own. A document's posterior odds are its own odds
times its path's odds over the global odds.

The classifier is fitted on a bounded sample, TRAIN_ROWS labelled rows at most, and is one Column
expression; figures and posteriors are over all documents. Only sums by path are shuffled.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotemill.llm.common import let, staged
from quotemill.llm.quality import bucket_counts, mean_ratio, pieces_of, words_of

#: Labelled rows the classifier is fitted on, at most: those with the smallest hash of their id.
TRAIN_ROWS = 16384
#: Strength of the ridge penalty, and steps of the fit.
RIDGE, STEPS = 0.05, 40
#: Between these a prior may weigh, in documents.
LEAST_WEIGHT, MOST_WEIGHT = 2.0, 1000.0
#: A document's own odds stay within e to the power of plus and minus this.
MOST_LOGIT = 12.0
#: Both n-gram counts are smoothed by so much in every bucket.
SMOOTHING = 1.0
FIGURES = ("ngrams", "symbols", "capitals", "bangs", "bars", "repeats", "word_length", "length", "line_repeats")


def ngram_ratios(rows: DataFrame) -> list[float]:
    """ln p_good - ln p_bad by bucket, over rows (good, pieces)."""
    every, good = bucket_counts(rows)
    bad = [n - g for n, g in zip(every, good, strict=True)]
    least = min(sum(good), sum(bad))  # both at the size of the smaller one
    if not least:
        return [0.0] * len(good)
    by_good, by_bad = least / sum(good), least / sum(bad)
    return [math.log(g * by_good + SMOOTHING) - math.log(b * by_bad + SMOOTHING) for g, b in zip(good, bad, strict=True)]


def figures(text: Column, words: Column, ratios: list[float]) -> list[Column]:
    """In the order of FIGURES, all doubles; of an empty text all zero but the first."""
    n, size = F.greatest(F.length(text), F.lit(1)), F.greatest(F.size(words), F.lit(1))
    lines = F.filter(F.split(text, "\n"), lambda x: x != "")
    share = lambda pattern, of: F.regexp_count(text, F.lit(pattern)) / of
    return [
        let(pieces_of(text), lambda pieces: mean_ratio(pieces, ratios)) * 4,
        F.least(share(r"[#*$%&<>]", size), F.lit(4.0)),
        share(r"[A-Z]", n) * 4,
        F.least(share(r"!", size), F.lit(4.0)),
        F.least(share(r"\|", size), F.lit(2.0)),
        F.when(F.size(words) < 2, F.lit(0.0)).otherwise(1 - F.size(F.array_distinct(words)) / size),
        F.least(n / size / 10, F.lit(3.0)),
        F.log1p(F.size(words).cast("double")) / 8,
        F.when(F.size(lines) < 2, F.lit(0.0)).otherwise(1 - F.size(F.array_distinct(lines)) / F.size(lines)),
    ]


def fit_logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights, the intercept last; Newton steps with a ridge penalty on all but the intercept. Without both classes: the intercept alone."""
    rate = (y.sum() + 1) / (len(y) + 2)
    w = np.zeros(x.shape[1] + 1)
    w[-1] = np.log(rate / (1 - rate))
    if len(np.unique(y)) < 2:
        return w
    data = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.diag([RIDGE] * x.shape[1] + [1e-6])
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(data @ w, -30, 30)))
        step = np.linalg.solve((data * (p * (1 - p) + 1e-9)[:, None]).T @ data + ridge, data.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _logit(p: Column) -> Column:
    return F.log(p) - F.log(1 - p)


def prior_weight(spread: float, noise: float, inner: float, n: float, groups: int) -> float:
    """How many documents the prior counts as: p(1-p) over the variance between groups, beyond what their size explains.

    spread: sum of n (mean - p)^2 over groups; noise: sum of p(1-p); inner: sum of n p(1-p).
    """
    if not n or groups < 2:
        return MOST_WEIGHT
    between = (spread - noise) / n
    return float(min(MOST_WEIGHT, max(LEAST_WEIGHT, inner / n / between))) if between > 0 else MOST_WEIGHT


def site_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", path_col: str = "lang", threshold: float = 0.5) -> DataFrame:
    """doc_id, host, path, p_text, host_rate, path_rate, score and kept for each row of docs.

    A null text counts as empty, null hosts and paths are a host and a path of their own. Rows
    with a null id are judged like others; repeated rows each count and come out. Without labels
    p_text is 0.5 for all and so is the score, which keeps all. An empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(host_col).cast("string").alias("host"), F.col(path_col).cast("string").alias("path"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("words", words_of(F.col("text")))
    good = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").alias("known")).agg(F.min("quality").alias("quality"))
    good = good.orderBy(F.xxhash64("known"), "known").limit(TRAIN_ROWS)
    good = staged(good, "labelled")
    half = F.pmod(F.xxhash64("known", F.lit(1)), F.lit(2))
    labelled = rows.join(F.broadcast(good), F.col("doc_id") == F.col("known"))  # TRAIN_ROWS pairs of numbers at most
    values = figures(F.col("text"), F.col("words"), ngram_ratios(labelled.where(half == 0).select((F.col("quality") > 0).cast("long").alias("good"), pieces_of(F.col("text")).alias("pieces"))))
    train = labelled.where(half == 1).select("known", "quality", F.array(*values).alias("x"))
    train = train.groupBy("known").agg(F.min("quality").alias("quality"), F.min("x").alias("x"))
    got = sorted((tuple(r["x"]), int(r["quality"] > 0)) for r in train.collect())
    weights = fit_logistic(np.array([x for x, _ in got]).reshape(-1, len(FIGURES)), np.array([y for _, y in got], float))
    own = F.lit(float(weights[-1]))
    for v, w in zip(values, weights[:-1], strict=True):
        own = own + v * F.lit(float(w))
    own = F.least(F.greatest(own, F.lit(-MOST_LOGIT)), F.lit(MOST_LOGIT))
    judged = staged(rows.select("doc_id", "host", "path", (1 / (1 + F.exp(-own))).alias("p_text")), "judged")
    paths = judged.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p_text").alias("good"))  # a few numbers a path; read three times
    hosts = paths.groupBy(F.col("host").alias("host_name")).agg(F.sum("n").alias("host_n"), F.sum("good").alias("host_good"))
    row = hosts.agg(F.sum("host_n").alias("n"), F.sum("host_good").alias("good"), F.sum(F.col("host_good") * F.col("host_good") / F.col("host_n")).alias("squares"), F.count("*").alias("groups")).first()
    n = row["n"] or 0
    rate = (row["good"] + 0.5) / (n + 1) if n else 0.5
    spread = row["squares"] - 2 * rate * row["good"] + rate * rate * n if n else 0.0
    weight = prior_weight(spread, row["groups"] * rate * (1 - rate), n * rate * (1 - rate), n, row["groups"])
    hosts = hosts.withColumn("host_rate", (F.col("host_good") + rate * weight) / (F.col("host_n") + weight))
    sites = paths.join(hosts, F.col("host").eqNullSafe(F.col("host_name"))).select("host", "path", "n", "good", "host_rate")
    p, gap = F.col("host_rate"), F.col("good") / F.col("n") - F.col("host_rate")
    row = sites.agg(F.sum(F.col("n") * gap * gap).alias("spread"), F.sum(p * (1 - p)).alias("noise"), F.sum(F.col("n") * p * (1 - p)).alias("inner"), F.sum("n").alias("n"), F.count("*").alias("groups")).first()
    weight = prior_weight(row["spread"], row["noise"], row["inner"], row["n"], row["groups"])
    sites = sites.withColumn("path_rate", (F.col("good") + F.col("host_rate") * weight) / (F.col("n") + weight))
    sites = sites.select(F.col("host").alias("site_host"), F.col("path").alias("site_path"), "host_rate", "path_rate")
    both = judged.join(sites, F.col("host").eqNullSafe(F.col("site_host")) & F.col("path").eqNullSafe(F.col("site_path")))
    odds = _logit(F.col("p_text")) + _logit(F.col("path_rate")) - F.lit(float(np.log(rate / (1 - rate))))
    both = both.withColumn("score", 1 / (1 + F.exp(-odds)))
    return both.select("doc_id", "host", "path", "p_text", "host_rate", "path_rate", "score", (F.col("score") >= threshold).alias("kept"))
