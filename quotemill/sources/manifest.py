"""Tables that are merged file by file: a manifest knows each file's keys, so that a merge reads and rewrites only files that may hold one.

A version of the table is a manifest, itself a small Parquet table: a row for each file and part
with the least and largest key and a Bloom filter of the keys. A pointer file names the manifest that
counts, and is put in place by renaming; readers and a merge that dies see the version before.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quotemill.sources import store
from quotemill.sources.standin import PART_ROWS
from quotemill.sources.table_io import staged

#: Rows of a file, bits of its filter for each of them, and bits set by a key.
FILE_ROWS, BITS_A_KEY, HASHES = 1_000_000, 10, 7


def _place(keys: list[str], words: Column, nth: int) -> Column:
    return F.pmod(F.xxhash64(*keys, F.lit(nth)), words.cast("long") * 64)


def _places(keys: list[str], words: Column) -> Column:
    return F.array(*[_place(keys, words, k) for k in range(HASHES)])


def _may_hold(keys: list[str]) -> Column:
    """Whether the filter in column ``bloom`` has all the key's bits."""
    word, bit = lambda p: F.get("bloom", F.shiftright(p, 6).cast("int")), lambda p: p.bitwiseAND(F.lit(63)).cast("int")
    return F.forall(_places(keys, F.size("bloom")), lambda p: F.call_function("shiftright", word(p), bit(p)).bitwiseAND(F.lit(1).cast("long")) == 1)


def _summed(words: int):
    """Batches of rows (file, part, key, places) -> a row for each run of one file and part: least and most key, n, bloom. A run goes on from batch to batch."""

    def told(runs: list[list], of: pa.Schema) -> pa.RecordBatch:
        key = of.field("key").type
        kinds = [pa.string(), of.field("part").type, key, key, pa.int64(), pa.list_(pa.int64())]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*runs, strict=True), kinds, strict=True)], ["file", "part", "least", "most", "n", "bloom"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, of = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            of = batch.schema
            ends = np.union1d(*[pc.run_end_encode(batch.column(c)).run_ends.to_numpy() for c in ("file", "part")])
            starts = np.r_[0, ends[:-1]]
            bits = np.zeros((len(ends), words * 64), bool)
            for k in range(HASHES):
                bits[np.repeat(np.arange(len(ends)), ends - starts), batch.column(f"place_{k}").to_numpy()] = True
            blooms = np.packbits(bits, axis=1, bitorder="little").view("<i8")
            file, part, key = (batch.column(c) for c in ("file", "part", "key"))
            runs = [[file[a].as_py(), part[a].as_py(), key[a].as_py(), key[b - 1].as_py(), b - a, blooms[k]] for k, (a, b) in enumerate(zip(starts.tolist(), ends.tolist(), strict=True))]
            if last and last[:2] == runs[0][:2]:
                runs[0][2], runs[0][4], runs[0][5] = last[2], last[4] + runs[0][4], last[5] | runs[0][5]
            elif last:
                yield told([last], of)
            *whole, last = runs
            if whole:
                yield told(whole, of)
        if last:
            yield told([last], of)

    return run


def described(spark: SparkSession, files: list[str], part: str, keys: list[str], words: int) -> DataFrame:
    """The manifest's rows for some files, which are sorted by part and keys: file, part, least, most (structs of the keys), n, bloom.

    A file's rows follow one another, so that its filter is made where they are read, and only filters are shuffled.
    """
    rows = spark.read.parquet(*files)
    rows = rows.select(F.col("_metadata.file_path").alias("file"), F.col(part).alias("part"), F.struct(*keys).alias("key"), *[_place(keys, F.lit(words), k).alias(f"place_{k}") for k in range(HASHES)])
    kind = dict(rows.dtypes)
    runs = rows.mapInArrow(_summed(words), f"file string, part {kind['part']}, least {kind['key']}, most {kind['key']}, n long, bloom array<long>")
    either = F.aggregate(F.slice("blooms", 2, 1 << 30), F.col("blooms")[0], lambda a, b: F.zip_with(a, b, lambda x, y: x.bitwiseOR(y)))
    found = runs.groupBy("file", "part").agg(F.min("least").alias("least"), F.max("most").alias("most"), F.sum("n").alias("n"), F.collect_list("bloom").alias("blooms"))
    return found.select("file", "part", "least", "most", "n", either.alias("bloom"))


def _written(df: DataFrame, root: str, part: str, keys: list[str], file_rows: int) -> list[str]:
    """df in new files, sorted by part and keys; their names. A task has ``PART_ROWS`` rows, and as many files as they make."""
    path, spark = f"{root}/data/{uuid.uuid4().hex}", df.sparkSession
    df = staged(df, "unsorted")  # counted, sampled and written
    tasks = max(1, -(-df.count() // max(file_rows, PART_ROWS // file_rows * file_rows)))
    df.repartitionByRange(tasks, part, *keys).sortWithinPartitions(part, *keys).write.option("maxRecordsPerFile", file_rows).parquet(path)
    return [r["f"] for r in spark.read.schema(df.schema).parquet(path).select(F.col("_metadata.file_path").alias("f")).distinct().collect()]  # names of files


def _commit(rows: DataFrame, root: str) -> None:
    path = f"{root}/manifests/{uuid.uuid4().hex}"
    rows.write.parquet(path)
    store.put(rows.sparkSession, f"{root}/current", path)


def manifest(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(store.got(spark, f"{root}/current"))


def create(df: DataFrame, root: str, part: str, keys: list[str], file_rows: int = FILE_ROWS) -> None:
    """df as a table whose merges go by ``keys``; ``part`` is a column of few values that follows from them."""
    words = max(1, -(-min(file_rows, FILE_ROWS) * BITS_A_KEY // 64))
    files = _written(df, root, part, keys, file_rows)
    spark = df.sparkSession
    if not files:  # an empty table keeps its columns
        path = f"{root}/data/{uuid.uuid4().hex}"
        df.limit(0).coalesce(1).write.parquet(path)
        files = [path]
    _commit(described(spark, files, part, keys, words), root)
    store.put(spark, f"{root}/columns", df.schema.json())


def read(spark: SparkSession, root: str) -> DataFrame:
    """The table as its current manifest has it."""
    schema = StructType.fromJson(json.loads(store.got(spark, f"{root}/columns")))
    files = [r["file"] for r in manifest(spark, root).select("file").distinct().collect()]  # names of files
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)


def touched(new: DataFrame, at: DataFrame, part: str, keys: list[str]) -> DataFrame:
    """file, once, for the files that may hold a key of new: same part, key between the least and the largest, all bits set.

    A part's files are numbered by their least keys; a key meets only files whose numbers it lies between, not all of
    its part, and files without overlap are met by keys of one number.
    """
    ask = new.select(F.col(part).alias("part"), F.struct(*keys).alias("key")).distinct()
    points = ask.select("part", "key", F.lit(2).alias("what"), F.lit(None).cast("string").alias("file"))
    points = points.unionByName(at.select("part", F.col("least").alias("key"), F.lit(1).alias("what"), "file")).unionByName(at.select("part", F.col("most").alias("key"), F.lit(3).alias("what"), "file"))
    before = Window.partitionBy("part").orderBy("key", "what").rowsBetween(Window.unboundedPreceding, 0)
    placed = points.withColumn("cell", F.count(F.when(F.col("what") == 1, 1)).over(before))
    spans = placed.where("what <> 2").groupBy("part", "file").agg(F.min(F.when(F.col("what") == 1, F.col("cell"))).alias("lo"), F.max(F.when(F.col("what") == 3, F.col("cell"))).alias("hi"))
    cells = spans.select("part", "file", F.explode(F.sequence("lo", "hi")).alias("cell"))
    near = placed.where("what = 2").select("part", "key", "cell").join(cells, ["part", "cell"]).join(at.select("part", "file", "least", "most", "bloom"), ["part", "file"])
    near = near.where((F.col("key") >= F.col("least")) & (F.col("key") <= F.col("most"))).select("file", "bloom", "key.*")
    return near.where(_may_hold(keys)).select("file").distinct()


def merge(new: DataFrame, root: str, part: str, keys: list[str], order: tuple[str, ...] = (), file_rows: int = FILE_ROWS) -> dict[str, int]:
    """Upsert: rows of new win over the table's with the same key; of new rows with one key the last by ``order``. Counts of files read, kept and written.

    Files that can't hold a key of new are neither read nor written; rows without a match come in new files.
    """
    spark = new.sparkSession
    columns = StructType.fromJson(json.loads(store.got(spark, f"{root}/columns"))).names
    at = manifest(spark, root)
    hit = [r["file"] for r in touched(new, at, part, keys).collect()]  # names of files
    old = spark.read.parquet(*hit).select(*columns) if hit else read(spark, root).limit(0)
    words = at.select(F.size("bloom").alias("w")).first()
    words = words["w"] if words else max(1, -(-file_rows * BITS_A_KEY // 64))
    files = _written(store.replaced(old, new, keys, order), root, part, keys, file_rows)
    kept = at.join(spark.createDataFrame([(f,) for f in hit], "file string"), "file", "left_anti")
    rows = kept.unionByName(described(spark, files, part, keys, words)) if files else kept
    counts = {"read": len(hit), "kept": kept.select("file").distinct().count(), "written": len(files)}
    _commit(rows, root)
    return counts
