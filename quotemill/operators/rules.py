"""Rules as data: a frame of metrics is held against a frame of rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CONFIG = "metric_thresholds map<string,array<struct<label:string,type:string,value:double>>>, label_mappings map<string,string>, templates map<string,string>, summary_rules struct<max_lines:int>"


def rules_from(spark: SparkSession, path: str) -> DataFrame:
    """metric, nth, how, bound, label, sentence: the rules of a JSON file, a metric's in the order they are tried; a label goes by its mapping, if it has one."""
    config = spark.read.schema(CONFIG).json(path, multiLine=True)
    each = config.select(F.explode("metric_thresholds").alias("metric", "rules"), "label_mappings", "templates")
    each = each.select("metric", F.posexplode("rules").alias("nth", "r"), "label_mappings", "templates")
    label = F.coalesce(F.element_at("label_mappings", F.col("r.label")), F.col("r.label"))
    return each.select("metric", "nth", F.col("r.type").alias("how"), F.col("r.value").alias("bound"), label.alias("label"), F.element_at("templates", label).alias("sentence"))


def unpivoted(rows: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    """keys, metric, value: a row for each metric, nulls too."""
    return rows.select(*keys, F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])))


def applied(values: DataFrame, rules: DataFrame, keys: list[str]) -> DataFrame:
    """keys, metric, value, label, sentence, nth: the first rule of the metric that its value meets; a value that meets none, or is null, has nulls.

    how is lt, lte, gt, gte or eq; a rule of any other kind is never met.
    """
    value, bound = F.col("value"), F.col("bound")
    met = F.when(F.col("how") == "lt", value < bound).when(F.col("how") == "lte", value <= bound).when(F.col("how") == "gt", value > bound).when(F.col("how") == "gte", value >= bound).when(F.col("how") == "eq", value == bound)
    first = F.min(F.when(met, F.struct("nth", "label", "sentence"))).alias("first")
    found = values.join(rules, "metric", "left").groupBy(*keys, "metric").agg(F.first("value").alias("value"), first)
    return found.select(*keys, "metric", "value", "first.label", "first.sentence", "first.nth")


def told(found: DataFrame, keys: list[str], metrics: list[str], lines: int = 5) -> DataFrame:
    """keys, a column of labels for each metric, and summary_text: the sentences in the metrics' order, so many at most."""
    place = F.array_position(F.array(*[F.lit(m) for m in metrics]), F.col("metric"))
    labels = [F.max(F.when(F.col("metric") == m, F.col("label"))).alias(f"{m}_label") for m in metrics]
    df = found.groupBy(*keys).agg(*labels, F.array_sort(F.collect_list(F.when(F.col("sentence").isNotNull(), F.struct(place.alias("p"), "sentence")))).alias("s"))
    return df.select(*keys, *[f"{m}_label" for m in metrics], F.concat_ws(" ", F.slice("s.sentence", 1, lines)).alias("summary_text"))
