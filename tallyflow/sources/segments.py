"""A log as a Spark data source: records in segments, made visible by commits that fix their offsets.

``data/`` holds Parquet files of one topic and partition each, ``commits/`` a numbered file for each write: its segments with
their first offsets, the ends of all partitions after it, and the last batch of each named writer. Readers see whole commits
alone. Files of a write that failed or was cut off are in no commit; ``sweep`` takes them away. One write commits at a time: a
commit's name is taken once, and who comes second takes the next.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamArrowWriter, DataSourceStreamReader, InputPartition, WriterCommitMessage

from tallyflow.sources.log import LOG

NAME = "segment_log"
#: Rows of a segment at most.
SEGMENT_ROWS = 1_000_000
_STORED = ("timestamp", "key", "value", "headers")


class Store:
    """The files of a log, by path or URI."""

    def __init__(self, path: str):
        from pyarrow import fs

        self.fs, self.root = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))

    def names(self, folder: str) -> list[str]:
        from pyarrow import fs

        found = self.fs.get_file_info(fs.FileSelector(f"{self.root}/{folder}", allow_not_found=True))
        return sorted(f.base_name for f in found if f.type == fs.FileType.File)

    def last(self) -> int:
        """The number of the last commit; -1 without one."""
        return max((int(n.split(".")[0]) for n in self.names("commits") if n.endswith(".json")), default=-1)

    def commit(self, number: int) -> dict:
        """A commit; number -1 stands for the empty log."""
        if number < 0:
            return {"segments": [], "ends": {}, "writers": {}}
        with self.fs.open_input_stream(f"{self.root}/commits/{number:012d}.json") as f:
            return json.loads(f.read())

    def put(self, number: int, made: dict) -> bool:
        """Makes a commit under its number; False if the number is taken."""
        from pyarrow import fs

        self.fs.create_dir(f"{self.root}/commits", recursive=True)
        name = f"{self.root}/commits/{number:012d}.json"
        draft = f"{name}.{uuid.uuid4().hex}"
        with self.fs.open_output_stream(draft) as out:
            out.write(json.dumps(made).encode())
        if not isinstance(self.fs, fs.LocalFileSystem):
            self.fs.move(draft, name)  # stores without links: one writer at a time
            return True
        try:
            os.link(draft, name)  # fails where the name is taken
        except FileExistsError:
            return False
        finally:
            os.unlink(draft)
        return True

    def add(self, files: list[dict], writer: str | None, batch: int | None) -> int | None:
        """Commits the files of a write, in order. None if the writer has committed the batch already."""
        while True:
            number = self.last() + 1
            before = self.commit(number - 1)
            if writer and batch is not None and before["writers"].get(writer, -1) >= batch:
                return None
            ends, segments = dict(before["ends"]), []
            for f in files:
                place = f"{f['topic']}/{f['partition']}"
                segments.append(f | {"offset": ends.get(place, 0)})
                ends[place] = ends.get(place, 0) + f["rows"]
            made = {"segments": segments, "ends": ends, "writers": before["writers"] | ({writer: batch} if writer and batch is not None else {})}
            if self.put(number, made):
                return number

    def drop(self, files: list[dict]) -> None:
        for f in files:
            self.fs.delete_file(f"{self.root}/data/{f['file']}")


@dataclass
class Segment(InputPartition):
    """What a task reads: ``rows`` records of a file from ``skip`` on, the first of which has ``offset``."""

    file: str
    topic: str
    partition: int
    offset: int
    skip: int
    rows: int
    deadline: float

    def __post_init__(self):
        self.value = None


_NOTHING = Segment("", "", 0, 0, 0, 0, float("inf"))


def _segments(store: Store, first: int, last: int, topics, start: dict, end: dict, timeout_ms: int) -> list[Segment]:
    """The segments of the commits after ``first`` up to ``last``, cut to the offsets from ``start`` to before ``end`` where these name their partition."""
    deadline, out = time.time() + timeout_ms / 1000, []
    for number in range(first + 1, last + 1):
        for s in store.commit(number)["segments"]:
            place = f"{s['topic']}/{s['partition']}"
            if topics and s["topic"] not in topics:
                continue
            low, high = max(s["offset"], start.get(place, 0)), min(s["offset"] + s["rows"], end.get(place, 1 << 62))
            if low < high:
                out.append(Segment(s["file"], s["topic"], s["partition"], low, low - s["offset"], high - low, deadline))
    return out


def _read(path: str, segment: Segment, timeout_ms: int):
    import numpy as np
    import pyarrow as pa
    import pyarrow.parquet as pq
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(LOG)
    store = Store(path)
    skip, left, at = segment.skip, segment.rows, segment.offset
    with store.fs.open_input_file(f"{store.root}/data/{segment.file}") as f:
        for batch in pq.ParquetFile(f).iter_batches(batch_size=10_000):
            if time.time() > segment.deadline:
                raise TimeoutError(f"scan of {segment.topic} timed out after {timeout_ms} ms; partition {segment.partition} reached {at} of {segment.offset + segment.rows}")
            if skip >= batch.num_rows:
                skip -= batch.num_rows
                continue
            part = batch.slice(skip, left)
            skip, left = 0, left - part.num_rows
            n = part.num_rows
            columns = {"topic": pa.array([segment.topic]).take(pa.array(np.zeros(n, np.int32))), "partition": pa.array(np.full(n, segment.partition, np.int32)), "offset": pa.array(np.arange(at, at + n))}
            columns |= {c: part.column(c) for c in _STORED}
            yield pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) for f in schema], schema=schema)
            at += n
            if not left:
                break


class _Options:
    def __init__(self, options):
        self.path = options["path"]
        self.topics = [t for t in options.get("topics", "").split(",") if t]
        self.timeout_ms = int(options.get("timeoutMs", 30_000_000))
        self.starting = options.get("startingOffsets", "earliest")
        self.ending = options.get("endingOffsets", "latest")
        self.writer = options.get("writer")
        self.batch = int(options["batch"]) if "batch" in options else None

    def places(self, told: str, store: Store, last: int) -> dict:
        """Offsets by topic/partition; {} where the position does not bound."""
        return store.commit(last)["ends"] if told == "latest" else {} if told == "earliest" else json.loads(told)


class BatchReader(DataSourceReader):
    def __init__(self, options: _Options):
        self.o = options

    def partitions(self):
        store = Store(self.o.path)
        last = store.last()  # the ends are fixed here, before anything is read
        return _segments(store, -1, last, self.o.topics, self.o.places(self.o.starting, store, last), self.o.places(self.o.ending, store, last), self.o.timeout_ms) or [_NOTHING]

    def read(self, partition):
        return _read(self.o.path, partition, self.o.timeout_ms) if partition.rows else iter(())


class StreamReader(DataSourceStreamReader):
    """Positions are (commit, ends of all partitions after it). The first position differs from any later one, so that the first batch, empty or not, puts it into the checkpoint: a restart does not choose it anew."""

    def __init__(self, options: _Options):
        self.o = options

    def initialOffset(self) -> dict:  # noqa: N802
        store = Store(self.o.path)
        last = store.last() if self.o.starting == "latest" else -1
        start = {} if self.o.starting in ("latest", "earliest") else json.loads(self.o.starting)
        return {"commit": last, "ends": store.commit(last)["ends"], "start": start or True}

    def latestOffset(self) -> dict:  # noqa: N802
        store = Store(self.o.path)
        last = store.last()
        return {"commit": last, "ends": store.commit(last)["ends"]}

    def partitions(self, start: dict, end: dict):
        first = start.get("start")
        return _segments(Store(self.o.path), start["commit"], end["commit"], self.o.topics, first if isinstance(first, dict) else {}, {}, self.o.timeout_ms)

    def read(self, partition):
        return _read(self.o.path, partition, self.o.timeout_ms)


@dataclass
class Written(WriterCommitMessage):
    files: list[dict]


def _write(path: str, batches) -> Written:
    """A task's records as segments, a file for each topic and partition at a time."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    store, files, open_files = Store(path), [], {}
    store.fs.create_dir(f"{store.root}/data", recursive=True)

    def close(place):
        open_files.pop(place)[1].close()

    for batch in batches:
        table = pa.Table.from_batches([batch]).combine_chunks()
        places = list(zip(table.column("topic").to_pylist(), table.column("partition").to_pylist(), strict=True))
        rows_of: dict = {}
        for i, place in enumerate(places):
            rows_of.setdefault(place, []).append(i)
        for place, rows in rows_of.items():
            if place not in open_files:
                if len(open_files) >= 64:
                    close(next(iter(open_files)))
                f = {"file": f"{uuid.uuid4().hex}.parquet", "topic": place[0], "partition": place[1], "rows": 0}
                files.append(f)
                open_files[place] = (f, pq.ParquetWriter(store.fs.open_output_stream(f"{store.root}/data/{f['file']}"), table.select(list(_STORED)).schema))
            f, out = open_files[place]
            out.write_table(table.select(list(_STORED)).take(pa.array(rows)), row_group_size=100_000)
            f["rows"] += len(rows)
            if f["rows"] >= SEGMENT_ROWS:
                close(place)
    for place in list(open_files):
        close(place)
    return Written(files)


class _Commits:
    def _commit(self, messages, batch: int | None) -> None:
        files = [f for m in messages if m is not None for f in m.files]
        store = Store(self.o.path)
        if store.add(files, self.o.writer, batch) is None:
            store.drop(files)  # this batch is in the log already

    def _abort(self, messages) -> None:
        Store(self.o.path).drop([f for m in messages if m is not None for f in m.files])


class BatchWriter(_Commits, DataSourceArrowWriter):
    def __init__(self, options: _Options):
        self.o = options

    def write(self, iterator) -> Written:
        return _write(self.o.path, iterator)

    def commit(self, messages) -> None:
        self._commit(messages, self.o.batch)

    def abort(self, messages) -> None:
        self._abort(messages)


class StreamWriter(_Commits, DataSourceStreamArrowWriter):
    def __init__(self, options: _Options):
        self.o = options

    def write(self, iterator) -> Written:
        return _write(self.o.path, iterator)

    def commit(self, messages, batchId: int) -> None:  # noqa: N803
        self._commit(messages, batchId)

    def abort(self, messages, batchId: int) -> None:  # noqa: N803
        self._abort(messages)


class SegmentLog(DataSource):
    """Options: path; topics (by comma); startingOffsets (earliest, latest or JSON of topic/partition to offset); endingOffsets and timeoutMs of a bounded scan; writer (and batch) of a write that must not be repeated."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self):
        return LOG

    def reader(self, schema):
        return BatchReader(_Options(self.options))

    def streamReader(self, schema):  # noqa: N802
        return StreamReader(_Options(self.options))

    def writer(self, schema, overwrite: bool):
        if overwrite:
            raise ValueError("a log is appended to")
        return BatchWriter(_Options(self.options))

    def streamWriter(self, schema, overwrite: bool):  # noqa: N802
        options = _Options(self.options)
        if not options.writer:
            raise ValueError("a stream that writes to a log needs the option writer, its name")
        return StreamWriter(options)


def _options(path: str, **options) -> dict[str, str]:
    return {"path": path} | {k: str(v) for k, v in options.items() if v is not None}


def scan_log(spark: SparkSession, path: str, topics=(), starting: str = "earliest", ending: str = "latest", timeout_ms: int = 30_000) -> DataFrame:
    """A scan up to the ends that the log has when Spark plans it; what is written later stays out, a missing topic gives no rows. A scan that takes longer than ``timeout_ms`` fails as a whole."""
    spark.dataSource.register(SegmentLog)
    return spark.read.format(NAME).options(**_options(path, topics=",".join(topics), startingOffsets=starting, endingOffsets=ending, timeoutMs=timeout_ms)).load()


def log_stream(spark: SparkSession, path: str, topics=(), starting: str = "earliest") -> DataFrame:
    """The topics as one stream. ``starting`` counts only before the checkpoint exists."""
    spark.dataSource.register(SegmentLog)
    return spark.readStream.format(NAME).options(**_options(path, topics=",".join(topics), startingOffsets=starting)).load()


def keyed(records: DataFrame, partitions: int = 12) -> DataFrame:
    """topic, key, value and, where there are such, timestamp and headers as log records: equal keys share a partition of their topic, and a partition's records are together. Without key they spread."""
    has = records.columns
    at = F.col("timestamp") if "timestamp" in has else F.current_timestamp()
    headers = F.col("headers") if "headers" in has else F.lit(None)
    spread = F.pmod(F.when(F.col("key").isNull(), F.xxhash64("value")).otherwise(F.xxhash64("key")), F.lit(partitions)).cast("int")
    rows = records.select("topic", spread.alias("partition"), F.lit(None).cast("long").alias("offset"), at.cast("timestamp").alias("timestamp"), F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"), headers.cast(LOG["headers"].dataType).alias("headers"))
    return rows.repartition("topic", "partition")


def append_log(records: DataFrame, path: str, writer: str | None = None, batch: int | None = None, partitions: int = 12) -> None:
    """Appends keyed records in one commit; the log gives them offsets. A ``batch`` that ``writer`` has committed is not written again."""
    records.sparkSession.dataSource.register(SegmentLog)
    keyed(records, partitions).write.format(NAME).options(**_options(path, writer=writer, batch=batch)).mode("append").save()


def log_sink(records: DataFrame, path: str, writer: str, checkpoint: str, partitions: int = 12):
    """A stream's writer into the log, still to be started: each batch is one commit, once."""
    records.sparkSession.dataSource.register(SegmentLog)
    return keyed(records, partitions).writeStream.format(NAME).options(**_options(path, writer=writer)).option("checkpointLocation", checkpoint)


def ends(path: str) -> dict[str, int]:
    """The next offset of each topic/partition."""
    store = Store(path)
    return store.commit(store.last())["ends"]


def sweep(path: str, older_than_s: float = 86_400) -> int:
    """Deletes segments of no commit that are older than that; returns how many. For one reader of all commits, so at quiet times."""
    store = Store(path)
    known = {s["file"] for n in range(store.last() + 1) for s in store.commit(n)["segments"]}
    old = [n for n in store.names("data") if n not in known and time.time() - store.fs.get_file_info(f"{store.root}/data/{n}").mtime.timestamp() > older_than_s]
    store.drop([{"file": n} for n in old])
    return len(old)
