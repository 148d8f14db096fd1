"""Daily archives: ZIP files of CSV members, read where the files are.

An archive's directory becomes a row a member first, by which kinds and days are chosen; only the
packed bytes of the members that are wanted are then dealt to tasks, unpacked and parsed.
"""

from __future__ import annotations

import csv
import io
import zipfile
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotemill.functions.names import file_date

#: Kinds of members, by how the base name begins.
KINDS = ("ETF", "GL", "HL", "PR", "TT", "PD")
#: Encodings and separators that are tried for members of unknown form.
FORMS = (("utf-8", None), ("utf-8", ","), ("latin-1", ","), ("utf-8", ";"), ("latin-1", None))

#: What a broken archive or member makes the reader raise.
FAULTS = (zipfile.BadZipFile, zlib.error, EOFError, NotImplementedError, RuntimeError, ValueError)


def kind_of(member: Column) -> Column:
    """The kind of a member by its base name, OTHER for the rest."""
    base = F.upper(F.regexp_extract(member, r"([^/\\]*)$", 1))
    out = F.lit("OTHER")
    for kind in reversed(KINDS):
        out = F.when(base.startswith(kind) & base.endswith(".CSV"), kind).otherwise(out)
    return out


#: Rows of a member that go to Spark at a time.
CHUNK = 10_000
#: What the central directory tells of a member, and where in the archive its packed bytes are; ``fault`` where that can't be told.
ENTRY = "struct<member: string, first: long, packed: long, size: long, method: int, crc: long, fault: string>"
_HEADER = 30


def _lines(data: bytes, sniff: bool) -> tuple[list[str], list[list[str]]]:
    """A member's header and rows: those with fewer fields than the header lack the last ones, empty lines count for nothing.

    A row with more fields is left out; when the form is being sniffed it means that the form is wrong,
    and the next one is tried. No rows if no form reads the member.
    """
    for encoding, sep in FORMS if sniff else (("utf-8", ","),):
        try:
            text = data.decode(encoding, errors="strict" if sniff else "replace")
            dialect = csv.Sniffer().sniff(text[:4096]) if sep is None else None
            reader = csv.reader(io.StringIO(text), dialect) if dialect else csv.reader(io.StringIO(text), delimiter=sep)
            header = [h.strip().upper() for h in next(reader, [])]
            if sniff and len(header) < 2:
                continue
            rows = [row for row in reader if row]
            if sniff and any(len(row) > len(header) for row in rows):
                continue
            return header, [row for row in rows if len(row) <= len(header)]
        except (UnicodeDecodeError, csv.Error):
            continue
    return [], []


def _named(header: list[str], rows: list[list[str]]) -> list[dict[str, str]]:
    return [dict(zip(header, row, strict=False)) for row in rows]


def _rows(data: bytes, sniff: bool) -> list[dict[str, str]]:
    """A member's rows by its header, one at a time."""
    return _named(*_lines(data, sniff))


def _maps(header: list[str], rows: list[list[str]]) -> pa.MapArray:
    """Each row's fields by the header, made a column at a time; of headers with one name the last that the row reaches counts."""
    if len(set(header)) < len(header):
        found = _named(header, rows)
        keys, values = pa.array([k for row in found for k in row], pa.string()), [v for row in found for v in row.values()]
        held = np.fromiter(map(len, found), np.int64, len(found))
    else:
        held = np.fromiter(map(len, rows), np.int64, len(rows))
        place = np.arange(held.sum()) - np.repeat(np.cumsum(held) - held, held)
        keys, values = pa.array(header, pa.string()).take(pa.array(place)), list(chain.from_iterable(rows))
    offsets = np.r_[0, np.cumsum(held)].astype(np.int32)
    return pa.MapArray.from_arrays(pa.array(offsets), keys, pa.array(values, pa.string()))


def members(spark: SparkSession, path: str, sniff: bool = False) -> DataFrame:
    """Rows of all CSV members of the files under a path or glob."""
    return member_rows(spark.read.format("binaryFile").load(path), sniff)


def _why(e: Exception) -> str:
    return str(e) or type(e).__name__


def _directory(content: bytes) -> list[tuple]:
    """An ENTRY for each CSV member in order of their names, for the last one of a name; or one without a member that tells why there are none."""
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            found = {m.filename: m for m in z.infolist() if m.filename.upper().endswith(".CSV")}
    except FAULTS as e:
        return [(None, None, None, None, None, None, _why(e))]
    out = []
    for name, m in sorted(found.items()):
        head = content[m.header_offset : m.header_offset + _HEADER]
        first = m.header_offset + _HEADER + int.from_bytes(head[26:28], "little") + int.from_bytes(head[28:30], "little")
        whole = head[:4] == b"PK\x03\x04" and first + m.compress_size <= len(content)
        fault = "encrypted" if m.flag_bits & 1 else None if whole else "the member isn't where the directory says"
        out.append((name, first, m.compress_size, m.file_size, m.compress_type, m.CRC, fault))
    return out


def entries(files: DataFrame) -> DataFrame:
    """A row a CSV member of files (path, modificationTime, content): archive, modified, kind, trade_date, the fields of ENTRY, and ``data``, its packed bytes.

    Files that aren't ZIP archives, by their first bytes, give no rows; an archive whose directory
    can't be read gives one with a fault alone. What is filtered out here isn't unpacked or moved.
    """

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        names = [x.split(":")[0].strip() for x in ENTRY[len("struct<") : -1].split(",")]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string()]
        kind = pa.list_(pa.struct(list(zip(names, kinds, strict=True))))
        for contents in batches:
            yield pa.array([[dict(zip(names, e, strict=True)) for e in _directory(c.as_py())] for c in contents], kind)

    listed = F.arrow_udf(run, f"array<{ENTRY}>")
    files = files.where(F.substring("content", 1, 2) == b"PK")
    rows = files.select(F.col("path").alias("archive"), F.col("modificationTime").alias("modified"), "content", F.explode(listed("content")).alias("e"))
    base = F.regexp_extract("e.member", r"([^/\\]*)$", 1)
    data = F.when(F.col("e.fault").isNull(), F.substring("content", (F.col("e.first") + 1).cast("int"), F.col("e.packed").cast("int")))
    return rows.select("archive", "modified", kind_of(F.col("e.member")).alias("kind"), file_date(base).alias("trade_date"), "e.*", data.alias("data"))


def _unpacked(member: str, data: bytes, size: int, method: int, crc: int) -> bytes:
    info = zipfile.ZipInfo(member)
    info.compress_type, info.compress_size, info.file_size, info.CRC = method, len(data), size, crc
    with zipfile.ZipExtFile(io.BytesIO(data), "r", info) as f:
        out = f.read()
    if len(out) != size:
        raise zipfile.BadZipFile("the member ends early")
    return out


def parsed(rows: DataFrame, sniff: bool = False) -> DataFrame:
    """Rows of the members of ``entries``, as in member_rows(). Members are dealt to tasks by archive and name, so that a large archive is no task's alone."""
    names, shared = ["archive", "modified", "member", "row_seq", "fields", "fault", "kind", "trade_date"], ("archive", "modified", "member", "kind", "trade_date")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def frame(batch: pa.RecordBatch, k: int, seq: list | np.ndarray, fields: pa.Array, fault: str | None = None) -> pa.RecordBatch:
            out = {c: batch.column(c).take(pa.array(np.full(len(seq), k))) for c in shared}
            out |= {"row_seq": pa.array(seq, pa.int64()), "fields": fields, "fault": pa.array([fault] * len(seq), pa.string())}
            return pa.RecordBatch.from_pydict({c: out[c] for c in names})

        for part in batches:
            for k in range(part.num_rows):
                member, data, size, method, crc, fault = (part.column(c)[k].as_py() for c in ("member", "data", "size", "method", "crc", "fault"))
                try:
                    header, found = _lines(_unpacked(member, data, size, method, crc), sniff) if fault is None else ([], None)
                except FAULTS as e:
                    found, fault = None, _why(e)
                if found is None:
                    yield frame(part, k, [None], pa.nulls(1, pa.map_(pa.string(), pa.string())), fault)
                    continue
                for lo in range(0, len(found), CHUNK):
                    rows = found[lo : lo + CHUNK]
                    yield frame(part, k, np.arange(lo, lo + len(rows)), _maps(header, rows))

    dealt = rows.select("archive", "modified", "member", "data", "size", "method", "crc", "fault", "kind", "trade_date")  # told once a member
    dealt = dealt.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "archive", "member")  # a number, since packed bytes say little of the work
    return dealt.mapInArrow(run, "archive string, modified timestamp, member string, row_seq long, fields map<string,string>, fault string, kind string, trade_date date")


def member_rows(files: DataFrame, sniff: bool = False, kinds: tuple[str, ...] | None = None) -> DataFrame:
    """Rows of the CSV members of files (path, modificationTime, content): archive, modified, member, row_seq, fields (map of upper-case header to text), fault.

    kinds: only members of these kinds are unpacked, and only their faults are told; faults of whole
    archives always are. Files that aren't ZIP archives, by their first bytes, give no rows. An
    archive or a member that can't be opened gives one row without fields that tells why in
    ``fault``; it is null everywhere else. Of members with one name the last counts.
    """
    rows = entries(files)
    if kinds is not None:
        rows = rows.where(F.col("kind").isin(*kinds) | F.col("member").isNull())
    return parsed(rows, sniff)


def newest(files: DataFrame) -> DataFrame:
    """The newest of files (path, modificationTime, ...): by the date in its name, then by time; a name without a date comes after all that have one."""
    day = file_date(F.regexp_extract("path", r"([^/\\]*)$", 1))
    return files.withColumn("file_day", day).orderBy(F.col("file_day").desc_nulls_last(), F.desc("modificationTime"), F.desc("path")).limit(1).drop("file_day")


def newest_of(files: DataFrame, by: list[str]) -> DataFrame:
    """newest() of every group, one row each."""
    day = file_date(F.regexp_extract("path", r"([^/\\]*)$", 1))
    best = F.max_by(F.struct(*[c for c in files.columns if c not in by]), F.struct(day.isNotNull(), day, "modificationTime", "path")).alias("best")
    return files.groupBy(*by).agg(best).select(*by, "best.*")


def field(*names: str) -> Column:
    """The first of the headers that a row has, by synonyms."""
    return F.coalesce(*[F.element_at("fields", n) for n in names])


def projected(rows: DataFrame, kind: str, spec: dict[str, tuple[str, ...]], keep: tuple[str, ...] = ()) -> DataFrame:
    """Members of one kind as text columns, by synonyms; extras hold the other fields as JSON."""
    used = [n for names in spec.values() for n in names]
    extras = F.map_filter("fields", lambda k, _: ~k.isin(*used))
    return rows.where(F.col("kind") == kind).select("trade_date", "member", "row_seq", *keep, *[field(*names).alias(c) for c, names in spec.items()], F.to_json(extras).alias("extras"))
