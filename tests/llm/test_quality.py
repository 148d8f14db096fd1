import math
import re
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from quotemill.llm import quality
from quotemill.llm.quality import log_ratios, quality_filter, quality_report, repeated_words, with_quality

WORD = re.compile("[^\x20\x09-\x0d]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    n = Counter(windows)
    covered = {j for i, w in enumerate(windows) if n[w] > 1 for j in (i, i + 1, i + 2)}
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def grams(text):
    pieces = WORD.findall(re.sub(r"([#*$%&|<>!]+)", r" \1 ", text or ""))
    for k, a in enumerate(pieces):
        h = xxhash.xxh64_intdigest(a.encode(), 42)
        yield signed(h) % quality.BUCKETS
        if k + 1 < len(pieces):
            yield signed(xxhash.xxh64_intdigest(pieces[k + 1].encode(), h)) % quality.BUCKETS


TEXTS = ["a b c d a b c x a b c", "one\none\n\n \ntwo\none", "x # * ** <b> | & $ %", "a a a a", "", None, "é 日本 é 日本 é 日本", "w\u00a0w w\u00a0w w\u00a0w w\u00a0w", "\n\n"]


def test_base_counts_against_brute_force(spark, odd_docs):
    extra = spark.createDataFrame([(100 + k, t) for k, t in enumerate(TEXTS)], "doc_id long, text string")
    df = odd_docs.select("doc_id", "text").unionByName(extra)
    got = with_quality(df, [0.0] * quality.BUCKETS).collect()
    assert len(got) == df.count()
    for r in got:
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == base(r["text"])


def test_ratios_and_scores_against_brute_force(spark, odd_docs, odd_labels):
    rows = odd_docs.collect()
    trusted = {1, 2, 7}
    raw, good = Counter(), Counter()
    for r in rows:
        for b in grams(r["text"]):
            raw[b] += 1
            good[b] += r["doc_id"] in trusted
    a, m = quality.SMOOTHING, quality.BUCKETS
    scale = good.total() / raw.total()
    want = [math.log((good[b] + a) / (raw[b] * scale + a)) for b in range(m)]
    got = log_ratios(odd_docs, odd_labels)
    assert got == pytest.approx(want, abs=1e-12)
    for r in quality_report(odd_docs, odd_labels).join(odd_docs.where("doc_id is not null").dropDuplicates(["doc_id"]).select("doc_id", "text"), "doc_id").collect():
        g = list(grams(r["text"]))
        assert r["score"] == pytest.approx(sum(want[b] for b in g) / len(g) if g else 0.0, abs=1e-9)
        assert r["kept"] == (not r["base_failed"] and r["score"] >= quality.THRESHOLD)


def test_filter_keeps_columns_that_clash(spark, odd_docs, odd_labels):
    df = odd_docs.withColumn("kept", F.lit("mine")).withColumn("score", F.lit(1)).withColumn("text_", F.lit("x"))
    out = quality_filter(df, odd_labels)
    assert out.columns == df.columns
    assert {r["kept"] for r in out.collect()} <= {"mine"}
    report = {r["doc_id"]: r["kept"] for r in quality_report(odd_docs, odd_labels).collect()}
    assert {r["doc_id"] for r in out.collect()} == {k for k, v in report.items() if v}


def test_filter_on_long_texts_takes_linear_time(spark, odd_docs, no_labels):
    assert odd_docs.where(repeated_words(quality.words_of(F.coalesce("text", F.lit("")))) > 100_000).count() == 1
    assert quality_filter(odd_docs, no_labels).count() >= 0


def test_empty_table(no_docs, no_labels, odd_labels):
    assert quality_report(no_docs, no_labels).count() == 0
    assert quality_filter(no_docs, odd_labels).count() == 0
