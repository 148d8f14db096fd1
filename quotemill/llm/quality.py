"""Quality rules: base counts of a text, and how much likelier its hashed n-grams are in trusted text than in the corpus.

Both multinomials are over hashed unigrams and bigrams of a text's pieces (words, with runs of
symbols cut off). The corpus counts take in every document; the trusted counts a bounded sample of
rows labelled good. A text's score is the mean over its n-grams of ln p_trusted - ln p_corpus, and
every text is kept or rejected by the same threshold. Everything is DataFrame functions: counting
is one map-side aggregation into ``buckets`` rows, scoring needs no shuffle.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotemill.llm.common import GAP, free, let

SPACES = " \t\n\x0b\f\r"
SYMBOLS = r"[#*$%&|<>]"
#: Rows labelled good that stand for trusted text: those with the smallest hash of their id.
TRUSTED_ROWS = 8192
BUCKETS = 1 << 14
SMOOTHING = 4.0
#: Texts whose n-grams are less than e^-0.5 times as likely in trusted text go.
THRESHOLD = -0.5


def words_of(text: Column) -> Column:
    """The words; one empty string for a text without any."""
    return F.split(F.btrim(text, F.lit(SPACES)), GAP)


def pieces_of(text: Column) -> Column:
    """Words and runs of symbols; one empty string for a text without any."""
    return words_of(F.regexp_replace(text, r"([#*$%&|<>!]+)", " $1 "))


def _grams(pieces: Column) -> Column:
    """An array of structs (0: piece, 1: the next one, null after the last)."""
    return F.arrays_zip(pieces, F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0))))


def _bucket(*parts: Column) -> Column:
    return F.pmod(F.xxhash64(*parts), F.lit(BUCKETS)).cast("int")


def trusted_ids(labels: DataFrame, rows: int = TRUSTED_ROWS) -> DataFrame:
    """At most ``rows`` ids labelled good, those with the smallest hash; ids labelled both ways count as bad."""
    good = labels.where("doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("q")).where("q = 1")
    return good.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def log_ratios(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> list[float]:
    """ln p_trusted - ln p_corpus by bucket; ``BUCKETS`` numbers whatever the corpus.

    Both multinomials are smoothed by the same count in every bucket, the corpus's after scaling
    it to the size of the trusted sample. What the sample is too small to show so weighs little.
    """
    ids = trusted_ids(labels).select(F.col("doc_id").alias("good_id"))
    rows = docs.select(F.col(id_col).alias("id"), pieces_of(F.coalesce(F.col(text_col), F.lit(""))).alias("pieces"))
    rows = rows.join(F.broadcast(ids), F.col("id") == F.col("good_id"), "left")  # TRUSTED_ROWS longs at most
    raw, good = bucket_counts(rows.select(F.col("good_id").isNotNull().cast("long").alias("good"), "pieces"))
    scale = sum(good) / max(1, sum(raw))
    return [math.log(g + SMOOTHING) - math.log(r * scale + SMOOTHING) for g, r in zip(good, raw, strict=True)]


def bucket_counts(rows: DataFrame) -> tuple[list[int], list[int]]:
    """How many unigrams and bigrams of rows (good, pieces) are in each bucket, and how many of them in rows with good = 1."""
    grams = rows.select("good", F.inline(_grams(F.col("pieces")))).toDF("good", "a", "b").where("a <> ''")
    hashed = grams.select("good", F.explode(F.array(_bucket(F.col("a")), F.when(F.col("b").isNotNull(), _bucket(F.col("a"), F.col("b"))))).alias("bucket"))
    counts = hashed.where("bucket is not null").groupBy("bucket").agg(F.count("*").alias("n"), F.sum("good").alias("good")).collect()
    raw, good = [0] * BUCKETS, [0] * BUCKETS
    for row in counts:
        raw[row["bucket"]], good[row["bucket"]] = row["n"], row["good"]
    return raw, good


def mean_ratio(pieces: Column, ratios: list[float]) -> Column:
    """The mean of the ratios of a text's unigrams and bigrams."""
    table = F.split(F.lit(",".join(map(repr, ratios))), ",").cast("array<double>")

    def each(x: Column, i: Column) -> Column:
        after = F.get(pieces, i + 1)
        return F.get(table, _bucket(x)) + F.when(after.isNotNull(), F.get(table, _bucket(x, after))).otherwise(0.0)

    return F.aggregate(F.transform(pieces, each), F.lit(0.0), lambda a, x: a + x) / (F.size(pieces) * 2 - 1)  # as many bigrams as unigrams, less one


def with_quality(docs: DataFrame, ratios: list[float], text_col: str = "text", threshold: float = THRESHOLD, names: dict[str, str] | None = None) -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, score and kept (under ``names``, if given).

    A null text counts as empty: no words, so base_failed; its score is 0. Counts are of whole
    texts. Rows stay one to one, whatever repeats or nulls other columns have.
    """
    out = {c: c for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept")} | (names or {})
    text, words = free(docs, "text_", "words_")
    t, w = F.col(text), F.col(words)
    df = docs.withColumn(text, F.coalesce(F.col(text_col), F.lit(""))).withColumn(words, words_of(t))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = df.withColumns(
        {
            out["n_words"]: F.when(w[0] == "", F.lit(0)).otherwise(F.size(w)).cast("long"),
            out["word_chars"]: F.char_length(F.array_join(w, "")).cast("long"),
            out["n_symbols"]: F.regexp_count(t, F.lit(SYMBOLS)).cast("long"),
            out["n_dup_lines"]: _repeats(lines).cast("long"),
            out["n_repeat_words"]: repeated_words(w),
        }
    ).drop(words)

    mean = let(pieces_of(t), lambda pieces: mean_ratio(pieces, ratios))
    n, r = F.col(out["n_words"]), F.col(out["n_repeat_words"])
    df = df.withColumn(out["base_failed"], (n < 50) | (r * 100 > n * 50)).withColumn(out["score"], F.when(n == 0, F.lit(0.0)).otherwise(mean))
    return df.withColumn(out["kept"], ~F.col(out["base_failed"]) & (F.col(out["score"]) >= threshold)).drop(text)


def repeated_words(words: Column, window: int = 3) -> Column:
    """How many words are in windows of ``window`` words that the text has more than once.

    Arrays are bound by let(), since the optimizer writes out columns that a filter asks for, and
    would compute an array again for each of its elements.
    """

    def hashed(w: Column) -> Column:
        starts = F.slice(w, F.lit(1), F.greatest(F.size(w) - (window - 1), F.lit(0)))
        return F.sort_array(F.transform(starts, lambda x, i: F.struct(F.xxhash64(x, *[F.get(w, i + k) for k in range(1, window)]).alias("h"), i.alias("i"))))

    def repeated(o: Column) -> Column:
        like = lambda x, k: F.coalesce(x["h"] == F.get(o, k)["h"], F.lit(False))
        return F.sort_array(F.transform(F.filter(o, lambda x, k: like(x, k - 1) | like(x, k + 1)), lambda x: x["i"]))

    def covered(p: Column) -> Column:
        new = F.transform(p, lambda x, k: F.least(F.lit(window), F.coalesce(F.get(p, k + 1) - x, F.lit(window))))
        return F.aggregate(new, F.lit(0).cast("long"), lambda a, x: a + x)

    return let(let(let(words, hashed), repeated), covered)


def _repeats(items: Column) -> Column:
    return F.size(items) - F.size(F.array_distinct(items))


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed, score and kept for each row of docs; an empty table gives an empty result."""
    rows = docs.select("doc_id", "text")
    return with_quality(rows, log_ratios(rows, labels)).drop("text")


def quality_filter(docs: DataFrame, labels: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of docs that the rules keep, with the columns of docs."""
    ours = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept")
    names = dict(zip(ours, free(docs, *ours), strict=True))
    return with_quality(docs, log_ratios(docs, labels, text_col=text_col), text_col, names=names).where(F.col(names["kept"])).select(*docs.columns)
