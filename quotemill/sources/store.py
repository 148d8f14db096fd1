"""Idempotent Parquet sinks, one directory a table, replaced by partition or by snapshot.

Merges are plans over (old, new); writing is apart from them, so that a dry run is the plan alone.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def last_of(rows: DataFrame, keys: list[str], order: tuple[str, ...] = ()) -> DataFrame:
    """One row a key: the last by ``order``, ties and what has no order by all other columns."""
    by = [*order, *[c for c in rows.columns if c not in keys and c not in order]]
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in by] or [F.lit(1)]))
    return rows.withColumn("nth_", nth).where("nth_ = 1").drop("nth_")


def replaced(old: DataFrame, new: DataFrame, keys: list[str], order: tuple[str, ...] = ()) -> DataFrame:
    """Upsert: rows of new win over rows of old with the same key; of new rows with one key the last by ``order``."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(last_of(new, keys, order).select(*old.columns))


def coalesced(old: DataFrame, new: DataFrame, keys: list[str], keep_old: tuple[str, ...], order: tuple[str, ...] = ()) -> DataFrame:
    """Upsert that keeps an old value of the ``keep_old`` columns where the new one is null; of new rows with one key the last by ``order``."""
    new = last_of(new, keys, order)
    a = old.select(*keys, F.lit(True).alias("in_old_"), *[F.col(c).alias(f"old_{c}") for c in old.columns if c not in keys])
    b = new.select(*keys, F.lit(True).alias("in_new_"), *[F.col(c).alias(f"new_{c}") for c in old.columns if c not in keys])
    df = a.join(b, keys, "full")

    def pick(c: str):
        if c in keys:
            return F.col(c)
        if c in keep_old:
            return F.coalesce(f"new_{c}", f"old_{c}").alias(c)
        return F.when(F.col("in_new_"), F.col(f"new_{c}")).otherwise(F.col(f"old_{c}")).alias(c)

    return df.select(*[pick(c) for c in old.columns])


def absent(old: DataFrame, new: DataFrame, keys: list[str], order: tuple[str, ...] = ()) -> DataFrame:
    """Rows of new whose key old doesn't have; of several with one key the first by ``order``, ties and what has no order by all other columns."""
    by = [*order, *[c for c in new.columns if c not in keys and c not in order]]
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_first() for c in by] or [F.lit(1)]))
    return new.withColumn("nth_", nth).where("nth_ = 1").drop("nth_").join(old.select(*keys).distinct(), keys, "left_anti")


def updated(old: DataFrame, new: DataFrame, keys: list[str], columns: tuple[str, ...], order: tuple[str, ...] = (), fallback: list[str] | None = None) -> DataFrame:
    """old with ``columns`` from new where new has the key; of new rows with one key the last by ``order``.

    A row of new whose key isn't whole, holding a null, goes by the ``fallback`` key instead.
    """
    if fallback:
        whole = F.lit(True)
        for k in keys:
            whole = whole & F.col(k).isNotNull()
        return updated(updated(old, new.where(whole), keys, columns, order), new.where(~whole), fallback, columns, order)
    b = last_of(new, keys, order).select(*keys, F.lit(True).alias("hit_"), *[F.col(c).alias(f"new_{c}") for c in columns])
    df = old.join(b, keys, "left")
    return df.select(*[F.when(F.col("hit_"), F.col(f"new_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in old.columns])


def put(spark: SparkSession, path: str, text: str) -> None:
    """A small file with the text, in place of any before: written beside it and renamed, so that readers see one or the other whole."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(path).getParent()
    beside = jvm.org.apache.hadoop.fs.Path(folder, f".{uuid.uuid4().hex}")
    out = beside.getFileSystem(conf).create(beside, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(beside.toUri(), conf).rename(beside, jvm.org.apache.hadoop.fs.Path(path), how)


def got(spark: SparkSession, path: str) -> str:
    """The text of a small file."""
    return spark.read.text(path, wholetext=True).first()[0]


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def write_snapshot(df: DataFrame, root: str) -> str:
    """df as a new snapshot of the table at ``root``; readers go on with the one before until the pointer is moved."""
    path = f"{root}/snapshot-{uuid.uuid4().hex}"
    df.write.parquet(path)
    put(df.sparkSession, f"{root}/current", path)
    return path


def read_snapshot(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(got(spark, f"{root}/current"))


def write_dates(df: DataFrame, root: str, by: str = "trade_date", files: int = 1) -> None:
    """df in place of the dates that it has, and of no other; running it again leaves the same rows. A date is written by ``files`` tasks, whatever its size."""
    salted = [F.pmod(F.xxhash64(*[c for c in df.columns if c != by]), F.lit(files))] if files > 1 else []
    df.repartition(by, *salted).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(root)


def write_batch(df: DataFrame, batch: int, root: str) -> bool:
    """A stream's micro-batch, once: its rows go to a folder of the batch's own, and count from the moment its ledger entry is renamed into place.

    A batch that died between the two is written over when it comes again; one that the ledger has is left alone (False).
    """
    spark, entry = df.sparkSession, f"{root}/ledger/{batch}"
    if exists(spark, entry):
        return False
    df.write.mode("overwrite").parquet(f"{root}/rows/batch={batch}")
    put(spark, entry, str(batch))
    return True


def read_batches(spark: SparkSession, root: str) -> DataFrame:
    """The rows of all batches that the ledger has, with the batch's number; of at least one batch."""
    done = spark.read.text(f"{root}/ledger").select(F.col("value").cast("long").alias("batch"))
    return spark.read.option("basePath", f"{root}/rows").parquet(f"{root}/rows").withColumn("batch", F.col("batch").cast("long")).join(done, "batch", "left_semi")


def append(df: DataFrame, path: str, columns: list[str] | None = None) -> None:
    """The columns that the target knows, added to it."""
    df.select(*[c for c in columns or df.columns if c in df.columns]).write.mode("append").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """df as a directory of CSV files, one a task."""
    df.write.mode("overwrite").csv(path, header=True)


def write_log(df: DataFrame, path: str) -> None:
    """Rows of a run's log or status, added to a directory of JSON lines."""
    df.write.mode("append").json(path)
