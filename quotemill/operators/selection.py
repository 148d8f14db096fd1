"""How well a day's selections worked."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotemill.functions.coerce import ratio_or_zero

#: Fixed values: (metric, comparison, bound, label) in the order they are tried, and the sentence for each label.
THRESHOLDS = (
    ("conversion_rate", "lt", 0.4, "LOW_CONVERSION"),
    ("conversion_rate", "gte", 0.4, "GOOD_CONVERSION"),
    ("failure_rate", "gt", 0.5, "HIGH_FAILURE"),
    ("failure_rate", "lte", 0.5, "CONTROLLED_FAILURE"),
    ("missed_opportunity_rate", "gt", 0.3, "HIGH_MISSED"),
    ("missed_opportunity_rate", "lte", 0.3, "LOW_MISSED"),
)
SENTENCES = {
    "LOW_CONVERSION": "System conversion is below expected levels.",
    "GOOD_CONVERSION": "System conversion is within acceptable range.",
    "HIGH_FAILURE": "Failure rate is elevated indicating poor selection quality.",
    "CONTROLLED_FAILURE": "Failure rate is within acceptable limits.",
    "HIGH_MISSED": "Significant missed opportunities detected.",
    "LOW_MISSED": "Missed opportunities are under control.",
}
#: Fixed values: (metric, direction, bound, urgent bound, confidence, supporting text).
SUGGESTIONS = (
    ("conversion_rate", -1, 0.4, 0.3, 0.7, "conversion_rate below threshold"),
    ("failure_rate", 1, 0.5, 0.6, 0.6, "failure_rate above threshold"),
    ("missed_opportunity_rate", 1, 0.3, 0.5, 0.65, "missed opportunities too high"),
)
MAX_LINES = 5
LEAST_CANDLES = 75


def classes(candidates: DataFrame, outcomes: DataFrame) -> DataFrame:
    """trade_date, symbol, selected, outcome, classification for every candidate; a selected one without outcome is CHOP."""
    df = candidates.join(outcomes.select("trade_date", "symbol", "outcome"), ["trade_date", "symbol"], "left")
    chosen = F.when(F.col("outcome") == "SUCCESS", "GOOD_SELECTION").when(F.col("outcome") == "FAILURE", "BAD_SELECTION").otherwise("CHOP")
    left = F.when(F.col("outcome") == "SUCCESS", "MISSED_OPPORTUNITY").otherwise("CORRECT_REJECTION")
    return df.select("trade_date", "symbol", "selected", "outcome", F.when(F.col("selected"), chosen).otherwise(left).alias("classification"))


def diagnostics(classified: DataFrame) -> DataFrame:
    return classified.where("outcome is not null")


def data_gaps(classified: DataFrame) -> DataFrame:
    return classified.where("outcome is null").select("trade_date", "symbol", F.lit("STOCK_DATA_MISSING").alias("issue_type"))


def summary(classified: DataFrame) -> DataFrame:
    """Counts and guarded rates by day."""
    n = lambda c: F.count_if(F.col("classification") == c)
    df = classified.groupBy("trade_date").agg(
        F.count("*").alias("candidate_count"),
        F.count_if("selected").alias("selected_count"),
        n("GOOD_SELECTION").alias("good_selection"),
        n("BAD_SELECTION").alias("bad_selection"),
        n("MISSED_OPPORTUNITY").alias("missed_opportunity"),
        n("CORRECT_REJECTION").alias("correct_rejection"),
    )
    return df.withColumns(
        {
            "conversion_rate": ratio_or_zero(F.col("good_selection"), F.col("selected_count")),
            "failure_rate": ratio_or_zero(F.col("bad_selection"), F.col("selected_count")),
            "missed_opportunity_rate": ratio_or_zero(F.col("missed_opportunity"), F.col("candidate_count")),
        }
    )


def totals(daily: DataFrame) -> DataFrame:
    """All days together: summed counts, and rates of the sums."""
    df = daily.agg(*[F.sum(c).cast("bigint").alias(c) for c in ("candidate_count", "selected_count", "good_selection", "bad_selection", "missed_opportunity")])
    return df.select(
        F.coalesce("candidate_count", F.lit(0)).alias("total_candidates"),
        F.coalesce("selected_count", F.lit(0)).alias("total_selected"),
        F.coalesce("good_selection", F.lit(0)).alias("total_success"),
        F.coalesce("bad_selection", F.lit(0)).alias("total_failure"),
        F.coalesce("missed_opportunity", F.lit(0)).alias("total_missed_opportunities"),
        ratio_or_zero(F.col("good_selection"), F.col("selected_count")).alias("conversion_rate"),
        ratio_or_zero(F.col("bad_selection"), F.col("selected_count")).alias("failure_rate"),
        ratio_or_zero(F.col("missed_opportunity"), F.col("candidate_count")).alias("missed_opportunity_rate"),
    )


def suggestions(daily: DataFrame) -> DataFrame:
    """A row for each rule that a day breaks."""
    rules = []
    for name, sign, bound, urgent, confidence, text in SUGGESTIONS:
        c = F.col(name)
        broken = c < bound if sign < 0 else c > bound
        high = c < urgent if sign < 0 else c > urgent
        rules.append(
            F.when(
                broken,
                F.struct(
                    F.lit(name).alias("rule_name"),
                    c.alias("current_value"),
                    F.lit(bound).alias("suggested_value"),
                    F.lit(text).alias("support_metric"),
                    (F.lit(bound) - c if sign < 0 else c - F.lit(bound)).alias("impact"),
                    F.lit(confidence).alias("confidence"),
                    F.when(high, "HIGH").otherwise("MEDIUM").alias("priority"),
                ),
            )
        )
    return daily.select("trade_date", F.inline(F.filter(F.array(*rules), lambda x: x.isNotNull())))


def _label(metric: str) -> Column:
    out = F.lit(None).cast("string")
    for name, how, bound, label in reversed(THRESHOLDS):
        if name == metric:
            c = F.col(name)
            test = {"lt": c < bound, "lte": c <= bound, "gt": c > bound, "gte": c >= bound}[how]
            out = F.when(test, label).otherwise(out)
    return out


def summary_text(daily: DataFrame) -> DataFrame:
    """trade_date, the three labels and summary_text, of MAX_LINES sentences at most."""
    metrics = ("conversion_rate", "failure_rate", "missed_opportunity_rate")
    sentence = F.create_map(*[F.lit(x) for pair in SENTENCES.items() for x in pair])
    broken = sum(((F.col(n) < b if s < 0 else F.col(n) > b).cast("int") for n, s, b, *_ in SUGGESTIONS), F.lit(0))
    df = daily.select("trade_date", *[_label(m).alias(f"{m}_label") for m in metrics], broken.alias("broken"))
    parts = [F.element_at(sentence, F.col(f"{m}_label")) for m in metrics]
    parts.append(F.when(F.col("broken") > 0, F.concat(F.col("broken").cast("string"), F.lit(" improvement opportunities identified."))))
    lines = F.slice(F.filter(F.array(*parts), lambda x: x.isNotNull()), 1, MAX_LINES)
    return df.select("trade_date", *[f"{m}_label" for m in metrics], F.concat_ws(" ", lines).alias("summary_text"))


def validation(dates: DataFrame, step1: DataFrame, step2: DataFrame, step3: DataFrame, candle_counts: DataFrame) -> DataFrame:
    """trade_date, candles, validation: COMPLETE with all steps and enough candles, PARTIAL with step 3 and candles, else SKIPPED."""
    df = dates.select("trade_date").distinct()
    for name, rows in (("step1", step1), ("step2", step2), ("step3", step3)):
        df = df.join(rows.select("trade_date").distinct().withColumn(name, F.lit(True)), "trade_date", "left").fillna({name: False})
    df = df.join(candle_counts.select("trade_date", "candles"), "trade_date", "left").fillna({"candles": 0})
    enough = F.col("candles") >= LEAST_CANDLES
    status = F.when(F.col("step1") & F.col("step2") & F.col("step3") & enough, "COMPLETE").when(F.col("step3") & enough, "PARTIAL").otherwise("SKIPPED")
    return df.select("trade_date", "candles", status.alias("validation"), F.when(status == "COMPLETE", "COMPLETED").otherwise("PARTIAL").alias("job_status"))
