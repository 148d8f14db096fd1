"""Mixing sources to target weights by Poisson replication.

A source's mean repetition rate is its target share of the bytes over its share today. A document's
number of copies is the Poisson distribution with that mean, inverted at a number hashed from the
seed, its id and its text, so that it depends on nothing else and a retried task gives the same.
Copies are then shuffled globally: dealt to partitions and sorted there by a hash of their own.

The rates are one grouped sum, written to the shared folder; Spark sends that table to all
executors if it is under its broadcast threshold and joins by sorting, splitting a hot source,
if not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotemill.llm.common import free, let, staged, unit_hash

SEED = 17
#: Without given weights, a source's target share goes with its size to this power.
TEMPERATURE = 0.5
#: Means above this are drawn as a sum of as many equal parts, since exp(-mean) would underflow.
LARGEST_MEAN = 500.0


def size_of(text: Column) -> Column:
    """UTF-8 bytes, plus one for the end of the document."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def source_rates(docs: DataFrame, source_col: str = "source", text_col: str = "text", weights: dict[str, float] | None = None, temperature: float = TEMPERATURE, total: float = 1.0) -> DataFrame:
    """source, rate, parts, cdf: the mean repetition rate, in how many parts it is drawn, and the parts' cumulative probabilities.

    total: bytes wanted, over the bytes there are. With ``weights``, sources that aren't named get
    weight 0. A null source is a source.
    """
    sums = docs.groupBy(F.col(source_col).alias("source")).agg(F.sum(size_of(F.col(text_col))).alias("bytes"))
    if weights is None:
        share = F.floor(F.pow(F.col("bytes").cast("double"), F.lit(temperature)) * 1000) if temperature != 0.5 else F.floor(F.sqrt(F.col("bytes").cast("double")) * 1000)
    else:
        share = F.lit(0)
        for name, w in weights.items():
            share = F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(int(w * 1_000_000))).otherwise(share)
    sums = staged(sums.withColumn("share", share.cast("long")), "sources")
    whole = sums.agg(F.sum("share").alias("share"), F.sum("bytes").alias("bytes")).first()
    if not whole["share"]:
        rate = F.lit(0.0)
    else:
        rate = F.col("share").cast("double") / F.lit(float(whole["share"])) * (F.lit(float(whole["bytes"])) * F.lit(float(total)) / F.col("bytes").cast("double"))
    rated = sums.select("source", rate.alias("rate")).withColumn("parts", F.greatest(F.lit(1), F.ceil(F.col("rate") / LARGEST_MEAN)).cast("int"))
    mean = F.col("rate") / F.col("parts")
    first = F.array(F.struct(F.exp(-mean).alias("p"), F.exp(-mean).alias("c")))
    steps = F.sequence(F.lit(1), F.ceil(mean + F.sqrt(mean) * 12 + 20).cast("int"))

    def step(acc: Column, k: Column) -> Column:
        last = F.element_at(acc, -1)
        p = last["p"] * mean / k
        return F.concat(acc, F.array(F.struct(p.alias("p"), (last["c"] + p).alias("c"))))

    return staged(rated.withColumn("cdf", F.transform(F.aggregate(steps, first, step), lambda x: x["c"])), "rates")


def _copies(docs: DataFrame, id_col: str, source_col: str, text_col: str, seed: int, out: dict[str, str], digest: str, rates: dict) -> DataFrame:
    """docs with the columns of ``out`` and the text's MD5 in ``digest``, a row for each copy.

    All of a row's copies are one array, bound by let() on the text's MD5 and on the number drawn, so
    that either is computed once a row; an empty array is a document without copies.
    """
    table = source_rates(docs, source_col, text_col, **rates)
    src, parts, cdf, each = free(docs.select("*", *[F.lit(0).alias(x) for x in (*out.values(), digest)]), "source_of", "parts", "cdf", "each")
    table = table.select(F.col("source").alias(src), F.col("rate").alias(out["rate"]), F.col("parts").alias(parts), F.col("cdf").alias(cdf))
    df = docs.join(table, F.col(source_col).eqNullSafe(F.col(src)))
    own = lambda d: (F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit("")), d)
    one = lambda d, j: let(unit_hash(*own(d), j.cast("string")), lambda u: F.size(F.filter(F.col(cdf), lambda c: c <= u)))
    drawn = lambda d: F.when(F.col(parts) == 1, one(d, F.lit(1))).otherwise(F.aggregate(F.sequence(F.lit(1), F.col(parts)), F.lit(0), lambda a, j: a + one(d, j))).cast("int")
    key = lambda d, c: F.conv(F.substring(F.md5(F.concat_ws("|", *own(d), F.lit("order"), c.cast("string"))), 1, 13), 16, 10).cast("long")

    def copies(d: Column, n: Column) -> Column:
        numbers = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(numbers, lambda c: F.struct(n.alias("n"), c.alias("copy"), key(d, c).alias("key"), d.alias("digest")))

    df = df.withColumn(each, F.explode(let(F.md5(F.coalesce(F.col(text_col), F.lit(""))), lambda d: let(drawn(d), lambda n: copies(d, n)))))
    df = df.withColumns({out["n_copies"]: F.col(f"{each}.n"), out["copy"]: F.col(f"{each}.copy"), out["shuffle_key"]: F.col(f"{each}.key"), digest: F.col(f"{each}.digest")})
    return df.drop(src, parts, cdf, each).repartition(F.col(out["shuffle_key"])).sortWithinPartitions(out["shuffle_key"])


OURS = ("rate", "n_copies", "copy", "shuffle_key")


def mix_sources(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", seed: int = SEED, names: dict[str, str] | None = None, **rates) -> DataFrame:
    """docs repeated to the target weights and shuffled: every column of docs, with rate, n_copies, copy (from 0) and shuffle_key.

    Null texts count as empty ones. Repeated rows are drawn alike, and each is repeated. An empty
    table gives an empty result. ``names`` renames the four new columns.
    """
    out = {c: c for c in OURS} | (names or {})
    (digest,) = free(docs.select("*", *[F.lit(0).alias(x) for x in out.values()]), "digest")
    return _copies(docs, id_col, source_col, text_col, seed, out, digest, rates).drop(digest)


def mixed(docs: DataFrame, **how) -> DataFrame:
    """The shuffled copies with the columns of docs only."""
    return mix_sources(docs, names=dict(zip(OURS, free(docs, *OURS), strict=True)), **how).select(*docs.columns)


def mix_report(docs: DataFrame) -> DataFrame:
    """One row for each copy: doc_id, source, rate, n_copies, copy, shuffle_key and the MD5 of the text that was shuffled."""
    rows = mix_sources(docs.select("doc_id", "source", "text"))
    return rows.select("doc_id", "source", *OURS, F.md5(F.coalesce("text", F.lit(""))).alias("text_md5"))


#: mix_report() in SQL, for means up to LARGEST_MEAN.
MIX_SQL = f"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, md5(coalesce(text, '')) AS digest, strlen(coalesce(text, '')) + 1 AS bytes FROM {{docs}}
), sums AS (
  SELECT source, sum(bytes)::BIGINT AS bytes, floor(sqrt(sum(bytes)::DOUBLE) * 1000)::BIGINT AS share FROM sized GROUP BY source
), whole AS (
  SELECT sum(share)::BIGINT AS share, sum(bytes)::BIGINT AS bytes FROM sums
), rates AS (
  SELECT s.source, s.share::DOUBLE / w.share::DOUBLE * (w.bytes::DOUBLE * 1.0::DOUBLE / s.bytes::DOUBLE) AS rate FROM sums s, whole w
), steps(source, rate, k, p, c) AS (
  SELECT source, rate, 0, exp(-rate), exp(-rate) FROM rates
  UNION ALL
  SELECT source, rate, k + 1, p * rate / (k + 1), c + p * rate / (k + 1) FROM steps WHERE k < ceil(rate + sqrt(rate) * 12 + 20)::INT
), cdfs AS (
  SELECT source, any_value(rate) AS rate, list(c ORDER BY k) AS cdf FROM steps GROUP BY source
), drawn AS (
  SELECT d.*, r.rate, len(list_filter(r.cdf, lambda c: c <= ('0x' || substr(md5(concat_ws('|', '{SEED}', coalesce(d.doc_id::VARCHAR, ''), d.digest, '1')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE))::INT AS n_copies
  FROM sized d JOIN cdfs r ON d.source IS NOT DISTINCT FROM r.source
), copies AS (
  SELECT *, unnest(range(n_copies))::INT AS copy FROM drawn
)
"""

MIX_REPORT_SQL = (
    MIX_SQL.format(docs="documents")
    + f"""SELECT doc_id, source, rate, n_copies, copy,
  ('0x' || substr(md5(concat_ws('|', '{SEED}', coalesce(doc_id::VARCHAR, ''), digest, 'order', copy::VARCHAR)), 1, 13))::BIGINT AS shuffle_key,
  digest AS text_md5 FROM copies"""
)
