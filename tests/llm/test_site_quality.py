from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quotemill.llm.site_quality import LEAST_WEIGHT, MOST_WEIGHT, SMOOTHING, fit_logistic, site_quality


def made(spark):
    rng = np.random.default_rng(1)
    rows, labels = [], []
    for i in range(900):
        host, path = f"h{i % 5}", f"p{i % 3}"
        bad = rng.random() < (0.6 if host == "h0" else 0.1)
        words = ["alpha", "beta", "gamma", "delta", "words", "more"]
        text = " ".join(rng.choice(words) + ("***" if bad else "") for _ in range(80))
        rows.append((i, text, host, path))
        if i % 2:
            labels.append((i, int(not bad), 0))
    rows.append((900, "alpha beta gamma " * 20, "lonely", "p"))
    return spark.createDataFrame(rows, "doc_id long, text string, source string, lang string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), rows


def test_posteriors_against_brute_force(spark):
    docs, labels, made_rows = made(spark)
    got = site_quality(docs, labels).toPandas()
    n, total = len(got), got["p_text"].sum()
    rate = (total + 0.5) / (n + 1)

    def weight(groups, toward):
        p = np.array(toward)
        m, size = groups["p_text"].mean().to_numpy(), groups.size().to_numpy()
        between = ((size * (m - p) ** 2).sum() - (p * (1 - p)).sum()) / n
        within = (size * p * (1 - p)).sum() / n
        return min(MOST_WEIGHT, max(LEAST_WEIGHT, within / between)) if between > 0 else MOST_WEIGHT

    hosts = got.groupby("host")
    w = weight(hosts, [rate] * hosts.ngroups)
    host_rate = (hosts["p_text"].sum() + rate * w) / (hosts.size() + w)
    assert got["host_rate"].to_numpy() == pytest.approx(host_rate[got["host"]].to_numpy())
    paths = got.groupby(["host", "path"])
    toward = host_rate[[h for h, _ in paths.size().index]].to_numpy()
    w = weight(paths, toward)
    path_rate = (paths["p_text"].sum() + toward * w) / (paths.size() + w)
    mine = path_rate[list(zip(got["host"], got["path"], strict=True))].to_numpy()
    assert got["path_rate"].to_numpy() == pytest.approx(mine)
    logit = lambda p: np.log(p / (1 - p))
    assert logit(got["score"]).to_numpy() == pytest.approx((logit(got["p_text"]) + logit(mine) - logit(rate)).to_numpy(), abs=1e-6)
    assert (got["kept"] == (got["score"] >= 0.5)).all()
    bad = {r[0] for r in made_rows if "***" in r[1]}
    assert np.mean([(r.doc_id in bad) != r.kept for r in got.itertuples()]) > 0.97
    assert host_rate["h0"] < host_rate["h1"]


def test_logistic_fit():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, 2))
    y = (x[:, 0] > 0).astype(float)
    w = fit_logistic(x, y)
    assert (((x @ w[:-1] + w[-1]) > 0) == (y > 0)).mean() > 0.95
    assert fit_logistic(np.zeros((0, 2)), np.zeros(0))[-1] == 0


def test_odd_and_empty_tables(spark, odd_docs, odd_labels, no_docs, no_labels):
    rows = site_quality(odd_docs, odd_labels).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["kept"] for r in site_quality(odd_docs, no_labels).collect())
    assert site_quality(no_docs, odd_labels).count() == 0


def ambiguous(spark):
    """Hosts of good and of bad texts, and one text that both have, made of words that either has."""
    rng = np.random.default_rng(4)
    good, bad, both = ([f"{x}{k}" for k in range(30)] for x in ("good", "bad", "both"))
    rows, labels = [], []
    for i in range(600):
        fine = i % 2 == 0
        text = " ".join(rng.choice((good if fine else bad) + both, 60))
        rows.append((i, text, "fine" if fine else "poor", f"p{i % 4 // 2}"))
        labels.append((i, int(fine), 0))
    rows += [(1000 + k, " ".join(both + both), "fine" if k % 2 == 0 else "poor", "p0") for k in range(8)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, lang string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), rows


def test_the_site_decides_about_ambiguous_texts(spark):
    docs, labels, _ = ambiguous(spark)
    got = site_quality(docs.withColumns({c: F.lit("mine") for c in ("host", "path", "words", "known", "quality", "score", "p_text")}), labels).toPandas().set_index("doc_id")
    same = got[got.index >= 1000]
    assert same["p_text"].nunique() == 1 and 0.02 < same["p_text"].iloc[0] < 0.98
    assert same[same["host"] == "fine"]["kept"].all() and not same[same["host"] == "poor"]["kept"].any()
    plain = got[got.index < 1000]
    assert (plain["kept"] == (plain["host"] == "fine")).mean() > 0.98


def test_own_odds_against_a_plain_version(spark):
    docs, labels, rows = ambiguous(spark)
    texts, known = {r[0]: r[1].split() for r in rows}, {r["doc_id"]: r["quality"] for r in labels.collect()}
    half = {r["doc_id"]: r["h"] for r in labels.select("doc_id", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2)).alias("h")).collect()}
    grams = lambda w: [*w, *zip(w, w[1:])]
    counts = [Counter(g for i, q in known.items() if q == y and half[i] == 0 for g in grams(texts[i])) for y in (0, 1)]
    total = [sum(c.values()) for c in counts]
    ratio = lambda g: np.log(counts[1][g] * min(total) / total[1] + SMOOTHING) - np.log(counts[0][g] * min(total) / total[0] + SMOOTHING)

    def plain(words):
        text = " ".join(words)
        ngrams = 4 * sum(map(ratio, grams(words))) / (2 * len(words) - 1)
        return [ngrams, 0, 0, 0, 0, 1 - len(set(words)) / len(words), min(3, len(text) / len(words) / 10), np.log1p(len(words)) / 8, 0]

    got = {r["doc_id"]: r["p_text"] for r in site_quality(docs, labels).collect()}
    fit = sorted((tuple(plain(texts[i])), q) for i, q in known.items() if half[i] == 1)
    w = fit_logistic(np.array([x for x, _ in fit], float), np.array([q for _, q in fit], float))
    want = {i: 1 / (1 + np.exp(-np.clip(np.dot(plain(t), w[:-1]) + w[-1], -12, 12))) for i, t in texts.items()}
    # two n-grams in one bucket can move a text a little
    assert np.median([abs(got[i] - want[i]) for i in want]) < 0.01 and max(abs(got[i] - want[i]) for i in want) < 0.2
