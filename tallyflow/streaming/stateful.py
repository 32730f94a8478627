"""Keyed state in streams: running statistics that start from a changelog, and a delay queue with timers."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from tallyflow.functions.headers import RETRY_NOT_BEFORE, read_int_header
from tallyflow.sources.log import LOG

#: What is kept for a key; last_updated in milliseconds.
STATE = "count long, mean double, m2 double, min double, max double, last_updated long, partition int, last_offset long"
_FIELDS = [f.split()[0] for f in STATE.split(", ")]


def use_rocksdb(spark: SparkSession) -> None:
    """State in RocksDB, as these processors need it: it may outgrow an executor's memory, and checkpoints write what changed."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def merged(a: tuple | None, b: tuple) -> tuple:
    """Two states of a key as one; the newer offset stands, the time never goes back."""
    if not a or not a[0] or not b[0]:
        some = b if not a or not a[0] else a
        return (*some[:5], *(max((x for x in (a and a[i], b[i]) if x is not None), default=None) for i in (5,)), *_later(a, b))
    n, d = a[0] + b[0], b[1] - a[1]
    return (n, a[1] + d * b[0] / n, a[2] + b[2] + d * d * a[0] * b[0] / n, min(a[3], b[3]), max(a[4], b[4]), max(a[5], b[5]), *_later(a, b))


def _later(a: tuple | None, b: tuple) -> tuple:
    return tuple(b[6:8]) if not a or a[7] is None or (b[7] is not None and b[7] >= a[7]) else tuple(a[6:8])


def partial_states(records: DataFrame, key: str, value: str, at: str, partition: str = "partition", offset: str = "offset") -> DataFrame:
    """key and STATE of each batch of a task's records, so that a hot key costs a row a batch in the shuffle. Null values count for offset and time alone."""

    def run(batches):
        import pandas as pd

        for df in batches:
            v = df["v"]
            by = df.assign(square=(v - v.groupby(df["key"], dropna=False).transform("mean")) ** 2).groupby("key", dropna=False, sort=False)
            last = df.loc[by["o"].idxmax()].set_index("key")
            n = by["v"].count()
            out = pd.DataFrame({"key": n.index, "count": n.to_numpy(), "mean": by["v"].mean().fillna(0.0).to_numpy(), "m2": by["square"].sum().to_numpy(), "min": by["v"].min().to_numpy(), "max": by["v"].max().to_numpy(), "last_updated": by["t"].max().to_numpy()})
            yield out.assign(partition=last["p"].to_numpy(), last_offset=last["o"].to_numpy())

    rows = records.select(F.col(key).cast("string").alias("key"), F.col(value).cast("double").alias("v"), F.unix_millis(F.col(at).cast("timestamp")).alias("t"), F.col(partition).cast("int").alias("p"), F.col(offset).cast("long").alias("o"))
    return rows.mapInPandas(run, f"key string, {STATE}")


class RunningState(StatefulProcessor):
    """count, mean, m2, min, max, time and place of a key's records, in one value state. Records may come late and in any order; nothing is dropped."""

    def init(self, handle) -> None:
        self.state = handle.getValueState("state", STATE)

    def handleInitialState(self, key, initialState, timerValues) -> None:  # noqa: N802, N803
        self.state.update(tuple(initialState[c] for c in _FIELDS))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        now = self.state.get() if self.state.exists() else None
        for row in rows:
            now = merged(now, tuple(row[c] for c in _FIELDS))
        self.state.update(now)
        yield Row(**dict(zip(["key", *_FIELDS], [key[0], *now], strict=True)))


def running_states(records: DataFrame, key: str, value: str, at: str, initial: DataFrame | None = None, partition: str = "partition", offset: str = "offset") -> DataFrame:
    """A stream of the states that changed, a row for each key and batch: key and STATE.

    ``initial``: entries of ``changelog.restore``, from which keys start when the query runs for the first time; after that its
    checkpoint has them. Give it for the partitions that the stream reads, and read the records after the entries' offsets.
    """
    use_rocksdb(records.sparkSession)
    begin = None
    if initial is not None:
        millis = F.unix_millis(F.col("last_updated").cast("timestamp"))
        begin = initial.select(F.col("product").alias("key"), "count", "mean", "m2", "min", "max", millis.alias("last_updated"), "partition", "last_offset").groupBy("key")
    partial = partial_states(records, key, value, at, partition, offset)
    return partial.groupBy("key").transformWithState(RunningState(), f"key string, {STATE}", "Update", "None", begin)


def state_entries(states: DataFrame) -> DataFrame:
    """STATE rows as entries of the changelog (product, partition, last_offset and the figures), for ``changelog.encode``."""
    return states.select(F.col("key").alias("product"), "partition", "last_offset", "count", "mean", "m2", "min", "max", F.timestamp_millis("last_updated").alias("last_updated"))


def read_states(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The states of a query of ``running_states``, read from its checkpoint: key and STATE."""
    use_rocksdb(spark)
    rows = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "state").load()
    return rows.select(F.col("key.key").alias("key"), *[F.col(f"value.{c}").alias(c) for c in _FIELDS])


_RECORD = T.StructType([*LOG.fields[2:], T.StructField("not_before", T.LongType())])
FORWARDED = T.StructType([T.StructField("topic", T.StringType()), T.StructField("retry_topic", T.StringType()), LOG["partition"], *_RECORD.fields, T.StructField("outcome", T.StringType()), T.StructField("forwarded_at", T.LongType())])
#: Offsets that a chunk of records spans at most and bytes that it has, about; bytes of chunks that a task holds before it stores them.
SPAN, CHUNK_BYTES, HELD_BYTES = 1 << 13, 1 << 20, 32 << 20
#: What the queue takes and gives: chunks of a partition's records, in order of their offsets.
_CHUNK = "topic string, partition int, first long, records long, most long, packed binary"
_SENT = "retry_topic string, partition int, packed binary, forwarded_at long"


def _layout():
    """The columns of a chunk; timestamp in microseconds."""
    import pyarrow as pa

    headers = pa.list_(pa.struct([("key", pa.string()), ("value", pa.binary())]))
    return pa.schema([("offset", pa.int64()), ("timestamp", pa.int64()), ("key", pa.binary()), ("value", pa.binary()), ("headers", headers), ("not_before", pa.int64())])


def _pack(batch) -> bytes:
    import pyarrow as pa

    data = batch.serialize()
    return data.size.to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def _unpack(packed: bytes):
    import pyarrow as pa

    data = pa.decompress(memoryview(packed)[8:], int.from_bytes(packed[:8], "little"), "zstd")
    return pa.ipc.read_record_batch(data, _layout())


def _chunks(batches):
    """A task's records as chunks of a partition each that do not overlap, sorted by offset. What spans SPAN offsets must lie in one task."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    table = [b for b in batches if b.num_rows]
    if not table:
        return
    table = pa.Table.from_batches(table)
    table = table.take(pc.sort_indices(table, [("topic", "ascending"), ("partition", "ascending"), ("offset", "ascending")])).combine_chunks()
    place = [pc.fill_null(c, -1).to_numpy() for c in (table["topic"].combine_chunks().dictionary_encode().indices, table["partition"], table["offset"])]
    place[2] = place[2] // SPAN
    cuts = np.flatnonzero(np.any([c[1:] != c[:-1] for c in place], axis=0)) + 1
    most = max(1, CHUNK_BYTES * table.num_rows // max(1, table.nbytes))
    topics, partitions, rows = table["topic"], table["partition"], table.select(_RECORD.names).cast(_layout())
    for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), table.num_rows], strict=True):
        out: list = []
        for at in range(low, high, most):
            part = pa.RecordBatch.from_struct_array(rows.slice(at, min(most, high - at)).to_struct_array().combine_chunks())
            part = part.take(pa.array(np.arange(part.num_rows)))  # a copy: a slice would write the columns' whole buffers
            late = pc.max(pc.fill_null(part["not_before"], 0)).as_py()
            out.append({"topic": topics[at].as_py(), "partition": partitions[at].as_py(), "first": part["offset"][0].as_py(), "records": part.num_rows, "most": late, "packed": _pack(part)})
        yield pa.RecordBatch.from_pylist(out, pa.schema([("topic", pa.string()), ("partition", pa.int32()), ("first", pa.int64()), ("records", pa.int64()), ("most", pa.int64()), ("packed", pa.binary())]))


def _records(batches):
    """The records of forwarded chunks, in order."""
    import pyarrow as pa

    for batch in batches:
        for topic, partition, packed, now in zip(*(batch.column(c) for c in ("retry_topic", "partition", "packed", "forwarded_at")), strict=True):
            part = _unpack(packed.as_py())
            fixed = [pa.repeat(pa.scalar(x.as_py(), kind), part.num_rows) for x, kind in ((topic, pa.string()), (partition, pa.int32()), (now, pa.int64()))]
            yield pa.RecordBatch.from_arrays([*fixed[:2], *part.columns, fixed[2]], ["retry_topic", "partition", *_RECORD.names, "forwarded_at"])


class DelayQueue(StatefulProcessor):
    """The records that wait in a partition of a retry topic, in order of arrival (by offset within a batch), in chunks.

    A record goes on when it and all before it are due. The chunks that wait are numbered from head to tail, with how many of the
    head's records are done, so that forwarding costs the chunks that it forwards, and the state is called for each chunk, not for
    each record; one timer stands for the first record that waits. Chunks that are due when they come, with none before them, are not stored.
    """

    def init(self, handle) -> None:
        self.handle = handle
        self.ends = handle.getValueState("ends", "head long, tail long, timer long, done long, records long")
        self.queue = handle.getMapState("queue", "number long", "chunk long, records long, most long")
        self.chunks = handle.getMapState("chunks", "chunk long", "packed binary")

    def _sent(self, key, packed: bytes, now: int) -> Row:
        return Row(retry_topic=key[0], partition=key[1], packed=packed, forwarded_at=now)

    def _release(self, key, head: int, tail: int, timer, done: int, records: int, now: int) -> Iterator[Row]:
        wait = None
        while head < tail:
            chunk, n, most = self.queue.getValue((head,))
            packed = self.chunks.getValue((chunk,))[0]
            if done or most > now:
                part = _unpack(packed)
                times = part["not_before"].fill_null(0).to_numpy()
                end = next((i for i in range(done, n) if times[i] > now), n)
                if end < n:
                    wait = int(times[end])
                packed = _pack(part.take(list(range(done, end)))) if end > done else None
            else:
                end = n
            if packed is not None:
                yield self._sent(key, packed, now)
            records -= end - done
            if wait is not None:
                done = end
                break
            self.queue.removeKey((head,))
            self.chunks.removeKey((chunk,))
            head, done = head + 1, 0
        if wait != timer:
            if timer is not None and timer > now:
                self.handle.deleteTimer(timer)
            if wait is not None:
                self.handle.registerTimer(wait)
        self.ends.update((head, tail, wait, done, records))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        now = timerValues.getCurrentProcessingTimeInMs()
        head, tail, timer, done, records = self.ends.get() if self.ends.exists() else (0, 0, None, 0, 0)
        come: list[list] = []  # first offset, records, latest not_before, number, the chunk unless it is stored
        stored = size = 0
        for row in rows:
            come.append([row["first"], row["records"], row["most"], tail + len(come), bytes(row["packed"])])
            size += len(come[-1][4])
            if size > HELD_BYTES:
                for held in come[stored:]:
                    self.chunks.updateValue((held[3],), (held[4],))
                    held[4] = None
                stored, size = len(come), 0
        for number, (_, n, most, chunk, packed) in enumerate(sorted(come, key=lambda c: c[0]), tail):
            if head == number and most <= now:
                if packed is None:
                    packed = self.chunks.getValue((chunk,))[0]
                    self.chunks.removeKey((chunk,))
                yield self._sent(key, packed, now)
                head += 1
            else:
                if packed is not None:
                    self.chunks.updateValue((chunk,), (packed,))
                self.queue.updateValue((number,), (chunk, n, most))
                records += n
        yield from self._release(key, head, tail + len(come), timer, done, records, now)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        if self.ends.exists():
            yield from self._release(key, *self.ends.get(), timerValues.getCurrentProcessingTimeInMs())


def waiting_records(log: DataFrame) -> DataFrame:
    """Records of retry topics with not_before, the time in their header in milliseconds; null without one."""
    return log.withColumn("not_before", read_int_header(F.col("headers"), RETRY_NOT_BEFORE))


def delay_queue(waiting: DataFrame, topic: str = "orders") -> DataFrame:
    """A stream of the records (log columns and not_before) that are due, once each, in order within their partition, addressed to ``topic``: FORWARDED. Timers send what becomes due without new input, also after a restart."""
    use_rocksdb(waiting.sparkSession)
    rows = waiting.select(*LOG.names[:3], F.unix_micros("timestamp").alias("timestamp"), *LOG.names[4:], F.col("not_before").cast("long").alias("not_before"))
    chunks = rows.repartition("topic", "partition", F.expr(f"offset div {SPAN}")).mapInArrow(_chunks, _CHUNK)
    sent = chunks.groupBy("topic", "partition").transformWithState(DelayQueue(), _SENT, "Append", "ProcessingTime")
    record = T.StructType([T.StructField("retry_topic", T.StringType()), LOG["partition"], *[T.StructField(f.name, T.LongType()) if f.name == "timestamp" else f for f in _RECORD.fields], T.StructField("forwarded_at", T.LongType())])
    return sent.mapInArrow(_records, record).select(*[{"topic": F.lit(topic), "timestamp": F.timestamp_micros("timestamp"), "outcome": F.lit("forwarded")}.get(c, F.col(c)).alias(c) for c in FORWARDED.names])


def delay_stream(waiting: DataFrame, table: str, checkpoint: str, every: str = "1 second", topic: str = "orders"):
    """Starts the delay queue; what is forwarded lies under ``table`` by retry_topic. A batch that is repeated writes nothing twice, as the file sink keeps which batches it has. It runs until it is stopped: while timers stand, a query with the trigger availableNow would not end either."""
    out = delay_queue(waiting, topic).writeStream.format("parquet").option("path", table).partitionBy("retry_topic")
    return out.outputMode("append").option("checkpointLocation", checkpoint).trigger(processingTime=every).start()


def held_records(spark: SparkSession, checkpoint: str) -> DataFrame:
    """topic, partition, records that wait and the time until which their head does, read from the queue's checkpoint."""
    use_rocksdb(spark)
    rows = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "ends").load()
    return rows.select("key.topic", "key.partition", "value.records", F.col("value.timer").alias("until_ms")).where("records > 0")
