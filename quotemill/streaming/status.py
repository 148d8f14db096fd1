"""Status of jobs as keyed state of a stream: only legal moves count, and a state that nothing follows expires.

Events of a job may arrive in any order. They wait in the state until the watermark has passed them
and are then folded by (time, event), so that the result doesn't depend on how the stream is cut
into batches. Jobs share slots, whose one timer wakes them at the next waiting event or state's end.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: The states of a day's job, and those that may follow each; '' is a job that has none yet.
MOVES = {
    "": ("pending", "holiday", "downloaded", "failed"),
    "pending": ("downloaded", "failed", "holiday"),
    "downloaded": ("committed", "failed"),
    "committed": ("success", "failed"),
    "failed": ("pending", "downloaded"),
    "success": (),
    "holiday": (),
}
#: States that fail if nothing follows for so long, in microseconds.
OPEN = ("pending", "downloaded", "committed")
EXPIRY = 6 * 3600 * 1_000_000
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Slots that jobs are dealt to, and pages of a slot's settled jobs.
SLOTS, PAGES = 1024, 16
OUT = "event_id long, at_us long, from_state string, proposed string, to_state string, accepted boolean"


class JobStatus(StatefulProcessor):
    """State of a slot of jobs: calls between Spark and a Python worker are dear, so that they are made by slot and page, not by job.

    ``waiting``: a text of [job, at, event_id, proposed] for each micro-batch with events that the watermark hasn't passed.
    ``open``: {job: [state, since]} of the jobs that may expire. ``settled``: pages of the same for the other ones, a job's page by its checksum.
    """

    def __init__(self, expiry: int = EXPIRY) -> None:
        self.expiry = expiry

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "events string")
        self.open = handle.getValueState("open", "jobs string")
        self.settled = handle.getMapState("settled", "page int", "jobs string")

    def _wake(self, times: list[int]) -> None:
        """The one timer, at the first of the times (milliseconds)."""
        for at in list(self.handle.listTimers()):
            self.handle.deleteTimer(at)
        if times:
            self.handle.registerTimer(min(times))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        came = [x for part in rows for x in zip(part["job"].tolist(), part["at"].tolist(), part["event_id"].tolist(), part["proposed"].tolist(), strict=True)]
        self.waiting.appendValue((json.dumps(came),))
        due, known = min(x[1] for x in came) // 1000, list(self.handle.listTimers())
        if not known or due < min(known):  # else the first timer sees to these as well
            self._wake([due])
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000 + 999  # all of the watermark's millisecond
        events = [tuple(x) for (text,) in self.waiting.get() for x in json.loads(text)]
        left = [x for x in events if x[1] > passed]
        due: dict[str, list[tuple]] = {}
        for job, *event in events:
            if event[0] <= passed:
                due.setdefault(job, []).append(event)
        opened = json.loads(self.open.get()[0]) if self.open.exists() else {}
        pages: dict[int, dict] = {}

        def page(job: str) -> dict:
            nth = zlib.crc32(job.encode()) % PAGES
            if nth not in pages:
                found = self.settled.getValue((nth,))
                pages[nth] = json.loads(found[0]) if found else {}
            return pages[nth]

        out: list[tuple] = []
        for job in sorted({*due, *(j for j, (_, since) in opened.items() if since + self.expiry <= passed // 1000 * 1000)}):
            state, since = opened.pop(job, None) or page(job).pop(job, ("", 0))
            state, since = self._folded(job, state, since, sorted(due.get(job, ())), passed // 1000 * 1000 + 1, out)
            if state in OPEN:
                opened[job] = (state, since)
            elif state:
                page(job)[job] = (state, since)
        self.open.update((json.dumps(opened),))
        for nth, jobs in pages.items():
            self.settled.updateValue((nth,), (json.dumps(jobs),))
        if left:
            self.waiting.put([(json.dumps(left),)])
        else:
            self.waiting.clear()
        self._wake([x[1] // 1000 for x in left] + [-(-(since + self.expiry) // 1000) for _, since in opened.values()])
        if out:
            yield pd.DataFrame(out, columns=["job", "event_id", "at_us", "from_state", "proposed", "to_state", "accepted"]).astype({"event_id": "Int64"})

    def _folded(self, job: str, state: str, since: int, events: list, before: int, out: list[tuple]) -> tuple[str, int]:
        """The state after a job's events, and after its expiry if that is before ``before``; what happened goes to ``out``."""
        for at, event, proposed in events:
            state, since = self._ended(job, state, since, at, out)
            legal = proposed in MOVES[state]
            out.append((job, event, at, state, proposed, proposed if legal else state, legal))
            if legal:
                state, since = proposed, at
        return self._ended(job, state, since, before, out)

    def _ended(self, job: str, state: str, since: int, before: int, out: list[tuple]) -> tuple[str, int]:
        if state in OPEN and since + self.expiry < before:
            out.append((job, None, since + self.expiry, state, "failed", "failed", True))
            return "failed", since + self.expiry
        return state, since

    def close(self) -> None:
        pass


@contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """Streams that are started meanwhile keep their state in STORE."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, STORE)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def status_stream(events: DataFrame, keys: list[str], late: str = "10 minutes", expiry: int = EXPIRY, slots: int = SLOTS) -> DataFrame:
    """A row for each event that the watermark has passed, and for each expiry (event_id null): keys, event_id, at_us, from_state, proposed, to_state, accepted.

    events: a stream of keys, ts (timestamp), event_id, proposed. Times in ``at_us`` are microseconds.
    An event that the watermark has passed before it comes is dropped, one without a time as well.
    The session must keep its state in STORE. Jobs are dealt to ``slots`` by hash, which a checkpoint
    must not change; a task holds a slot's waiting events and open jobs.
    """
    types = dict(events.dtypes)
    form = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    rows = events.where("ts is not null").withWatermark("ts", late).select(F.to_json(F.struct(*keys), form).alias("job"), "ts", F.unix_micros("ts").alias("at"), "event_id", "proposed")
    rows = rows.withColumn("slot", F.pmod(F.xxhash64("job"), F.lit(slots)).cast("int"))
    found = rows.groupBy("slot").transformWithStateInPandas(JobStatus(expiry), f"job string, {OUT}", "append", "eventTime")
    job = F.from_json("job", ", ".join(f"`{k}` {types[k]}" for k in keys), form)
    return found.withColumn("job", job).select(*[F.col("job")[k].alias(k) for k in keys], *[x.split()[0] for x in OUT.split(", ")])
