"""Messages addressed by partition and offset, as a Spark data source over Parquet files: bounded and continuous scans, and a
sink that takes a micro-batch exactly once.

A log is a folder. ``segments/`` holds Parquet files with the messages (key, value, timestamp) of one partition in order;
``commits/`` holds one small JSON file per accepted write that says which file starts at which offset. Files without a commit
do not count, so a write is there as a whole or not at all. Messages carry no offset of their own: a message's offset is its
segment's first one plus its row, which a commit knows and a task does not.

Both folders are reached through ``pyarrow.fs``, by tasks and driver: a path that all of them share.

    register(spark)
    spark.read.format("message_log").option("startingOffsets", '{"flows": {"0": 40}}').load(path)
    spark.readStream.format("message_log").option("maxOffsetsPerTrigger", 100000).load(path)
    messages.write.format("message_log").option("batch", 7).mode("append").save(path)

Reader options: ``startingOffsets`` (``earliest``, ``latest`` or JSON by topic and partition), ``endingOffsets`` likewise,
``assign`` (JSON list of partitions by topic), ``lookBack`` (so many messages per partition before the start), ``failOnDataLoss``
(what happens when the start is gone: an error, or the earliest message there is), ``rowsPerTask``, and for streams
``maxOffsetsPerTrigger`` per partition (the first micro-batch after a start takes all there is: Spark asks for its end before it
says where the last run stopped).
Writer options: ``batch``, a number that is accepted once.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceStreamArrowWriter,
    DataSourceStreamReader,
    EqualTo,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
    WriterCommitMessage,
)

from flowguard.schema import KAFKA_RECORD

ROWS_PER_TASK = 1_000_000
STORED = pa.schema([("key", pa.binary()), ("value", pa.binary()), ("timestamp", pa.timestamp("us", tz="UTC"))])


def register(spark: SparkSession) -> None:
    """Make the format known to a session and let it take filters on partition and offset."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(MessageLog)


@dataclass
class Log:
    """What is committed in a log folder."""

    path: str

    def __post_init__(self):
        self.files, self.root = fs.FileSystem.from_uri(self.path) if "://" in self.path or self.path.startswith("file:") else (fs.LocalFileSystem(), self.path)
        self.root = self.root.rstrip("/")

    def commits(self) -> list[str]:
        found = self.files.get_file_info(fs.FileSelector(f"{self.root}/commits", allow_not_found=True))
        return sorted(f.base_name for f in found if f.base_name.endswith(".json"))

    def segments(self) -> list[dict]:
        """Committed segments (topic, partition, first, count, file) in order of partition and offset."""
        out = []
        for name in self.commits():
            with self.files.open_input_stream(f"{self.root}/commits/{name}") as f:
                out += json.loads(f.read())
        return sorted(out, key=lambda s: (s["topic"], s["partition"], s["first"]))

    def bounds(self) -> dict[tuple[str, int], tuple[int, int]]:
        """(earliest, next) offset by topic and partition."""
        out: dict[tuple[str, int], tuple[int, int]] = {}
        for s in self.segments():
            key, end = (s["topic"], s["partition"]), s["first"] + s["count"]
            out[key] = (out[key][0], end) if key in out else (s["first"], end)
        return out

    def has(self, batch: str) -> bool:
        return f"{batch_name(batch)}.json" in self.commits()

    def commit(self, batch: str, parts: list[dict]) -> None:
        """Give the files of a write their offsets, partition by partition in the order of tasks; nothing if it is known."""
        if self.has(batch):
            self.discard(parts)
            return
        after, made = {k: end for k, (_, end) in self.bounds().items()}, []
        for p in parts:
            key = (p["topic"], p["partition"])
            made.append({**p, "first": after.get(key, 0)})
            after[key] = after.get(key, 0) + p["count"]
        self.put(f"{batch_name(batch)}.json", made)

    def put(self, name: str, content: list[dict]) -> None:
        self.files.create_dir(f"{self.root}/commits", recursive=True)
        draft = f"{self.root}/commits/.{name}.{uuid.uuid4().hex}"
        with self.files.open_output_stream(draft) as f:
            f.write(json.dumps(content).encode())
        self.files.move(draft, f"{self.root}/commits/{name}")

    def discard(self, parts: list[dict]) -> None:
        for p in parts:
            self.files.delete_file(f"{self.root}/segments/{p['file']}")

    def expire(self, before: dict[tuple[str, int], int]) -> None:
        """Forget whole segments below the given offsets, like a broker's retention; offsets of the rest stay."""
        for name in self.commits():
            with self.files.open_input_stream(f"{self.root}/commits/{name}") as f:
                held = json.loads(f.read())
            gone = [s for s in held if s["first"] + s["count"] <= before.get((s["topic"], s["partition"]), 0)]
            if gone:
                self.put(name, [s for s in held if s not in gone])
                self.discard(gone)


def batch_name(batch: str) -> str:
    return str(batch).rjust(20, "0")


@dataclass
class Piece(InputPartition):
    """Rows ``skip`` to ``skip + count`` of a segment file, which start at ``offset``."""

    topic: str
    partition: int
    offset: int
    file: str
    skip: int
    count: int


NOTHING = Piece("", 0, 0, "", 0, 0)


@dataclass
class Parts(WriterCommitMessage):
    task: int
    parts: list[dict] = field(default_factory=list)


class MessageLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return "message_log"

    def schema(self):
        return KAFKA_RECORD

    def reader(self, schema):
        return LogReader(dict(self.options))

    def streamReader(self, schema):
        return LogStreamReader(dict(self.options))

    def writer(self, schema, overwrite):
        return LogWriter(dict(self.options))

    def streamWriter(self, schema, overwrite):
        return LogStreamWriter(dict(self.options))


class _Ranges:
    """Offset ranges by topic and partition, and the pieces of files that hold them."""

    def __init__(self, options: dict[str, str]):
        self.options = {k.lower(): v for k, v in options.items()}
        self.path = self.options["path"]

    def chosen(self, bounds: dict) -> dict:
        assign = self.options.get("assign")
        if assign is None:
            return bounds
        wanted = {(topic, int(p)) for topic, ps in json.loads(assign).items() for p in ps}
        return {k: v for k, v in bounds.items() if k in wanted}

    def asked(self, option: str, bounds: dict, default: str) -> dict:
        """The option's offset per partition; a partition that JSON does not name starts at its first and ends at its last."""
        text = self.options.get(option, default)
        if text in ("earliest", "latest"):
            return {k: b[text == "latest"] for k, b in bounds.items()}
        named = {(topic, int(p)): int(n) for topic, ps in json.loads(text).items() for p, n in ps.items()}
        return {k: named.get(k, b[default == "latest"]) for k, b in bounds.items()}

    def start(self, bounds: dict) -> dict:
        back = int(self.options.get("lookback", 0))
        # Context that is gone is no loss; a start that is gone is one.
        return {k: max(min(self.kept(k, n, bounds), n) - back, bounds[k][0]) if back else self.kept(k, n, bounds) for k, n in self.asked("startingoffsets", bounds, "earliest").items()}

    def kept(self, key: tuple[str, int], offset: int, bounds: dict) -> int:
        earliest = bounds.get(key, (0, 0))[0]
        if offset >= earliest:
            return offset
        if self.options.get("failondataloss", "true").lower() == "true":
            raise ValueError(f"messages {offset} to {earliest - 1} of {key[0]}/{key[1]} are gone")
        return earliest

    def pieces(self, ranges: dict, segments: list[dict]) -> list[Piece]:
        rows, out = int(self.options.get("rowspertask", ROWS_PER_TASK)), []
        for s in segments:
            low, high = ranges.get((s["topic"], s["partition"]), (0, 0))
            low, high = max(low, s["first"]), min(high, s["first"] + s["count"])
            out += [Piece(s["topic"], s["partition"], at, s["file"], at - s["first"], min(rows, high - at)) for at in range(low, high, rows)]
        return out


def read_piece(path: str, piece: Piece) -> Iterator[pa.RecordBatch]:
    """Record batches of a piece; row groups in front of it are not read."""
    log, seen, offset = Log(path), 0, piece.offset
    with log.files.open_input_file(f"{log.root}/segments/{piece.file}") as f:
        file = pq.ParquetFile(f)
        groups = []
        for g in range(file.num_row_groups):
            n = file.metadata.row_group(g).num_rows
            if seen + n > piece.skip and seen < piece.skip + piece.count:
                groups.append((g, seen))
            seen += n
        if not groups:
            return
        at = groups[0][1]
        for batch in file.iter_batches(row_groups=[g for g, _ in groups]):
            low, high = max(piece.skip - at, 0), min(piece.skip + piece.count - at, batch.num_rows)
            at += batch.num_rows
            if low >= high:
                continue
            some, n = batch.slice(low, high - low), high - low
            yield pa.RecordBatch.from_arrays(
                [some.column("key"), some.column("value"), pa.array([piece.topic] * n), pa.array([piece.partition] * n, pa.int32()),
                 pa.array(range(offset, offset + n), pa.int64()), some.column("timestamp")], names=[f.name for f in KAFKA_RECORD.fields])
            offset += n


class LogReader(_Ranges, DataSourceReader):
    def __init__(self, options):
        super().__init__(options)
        self.only: set[int] | None = None
        self.low, self.high = 0, 1 << 62

    def pushFilters(self, filters):
        """Partitions and offset ranges are cut out here, so those filters need not be looked at again."""
        for f in filters:
            column, value = getattr(f, "attribute", None), getattr(f, "value", None)
            if column == ("partition",) and isinstance(f, (EqualTo, In)):
                found = {value} if isinstance(f, EqualTo) else set(value)
                self.only = found if self.only is None else self.only & found
            elif column == ("offset",) and isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)) and value is not None:
                if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)):
                    self.low = max(self.low, value + isinstance(f, GreaterThan))
                if isinstance(f, (EqualTo, LessThan, LessThanOrEqual)):
                    self.high = min(self.high, value + (not isinstance(f, LessThan)))
            else:
                yield f

    def partitions(self):
        log = Log(self.path)
        bounds = self.chosen(log.bounds())
        first, last = self.start(bounds), self.asked("endingoffsets", bounds, "latest")
        ranges = {k: (max(first[k], self.low), min(last[k], self.high)) for k in bounds if self.only is None or k[1] in self.only}
        return self.pieces(ranges, log.segments()) or [NOTHING]

    def read(self, partition):
        if partition.count:
            yield from read_piece(self.path, partition)


class LogStreamReader(_Ranges, DataSourceStreamReader):
    """Offsets are JSON: next offset by ``topic/partition``."""

    def __init__(self, options):
        super().__init__(options)
        self.reached: dict[str, int] | None = None

    def initialOffset(self):
        self.reached = {f"{t}/{p}": n for (t, p), n in self.start(self.chosen(Log(self.path).bounds())).items()}
        return self.reached

    def latestOffset(self):
        most, out = int(self.options.get("maxoffsetspertrigger", 1 << 62)), {}
        for (t, p), (first, end) in self.chosen(Log(self.path).bounds()).items():
            name = f"{t}/{p}"
            before = first if self.reached is not None and name not in self.reached else (self.reached or {}).get(name)
            out[name] = end if before is None else min(end, before + most)
        return out

    def partitions(self, start, end):
        self.reached = dict(end)
        log = Log(self.path)
        bounds, ranges = log.bounds(), {}
        for name, high in end.items():
            topic, _, p = name.rpartition("/")
            key = (topic, int(p))
            ranges[key] = (self.kept(key, start[name], bounds) if name in start else bounds.get(key, (0, 0))[0], high)
        return self.pieces(ranges, log.segments()) or [NOTHING]

    def read(self, partition):
        if partition.count:
            yield from read_piece(self.path, partition)


class _Write:
    """Tasks write one file per topic and partition; the driver commits what came back."""

    def __init__(self, options):
        options = {k.lower(): v for k, v in options.items()}
        self.path, self.topic, self.batch = options["path"], options.get("topic", "messages"), options.get("batch")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Parts:
        from pyspark import TaskContext

        log, open_files, task = Log(self.path), {}, TaskContext.get().partitionId()
        log.files.create_dir(f"{log.root}/segments", recursive=True)
        try:
            for batch in iterator:
                rows = pa.Table.from_batches([batch])
                n = len(rows)
                topic = rows["topic"].combine_chunks() if "topic" in rows.column_names else pa.array([self.topic] * n, pa.string())
                place = rows["partition"].combine_chunks().cast(pa.int32()) if "partition" in rows.column_names else pa.array([0] * n, pa.int32())
                named = {f.name: rows[f.name].cast(f.type) if f.name in rows.column_names else pa.nulls(n, f.type) for f in STORED}
                full = pa.table(named, schema=STORED)
                for t, p in sorted({*zip(topic.to_pylist(), place.to_pylist())}, key=str):
                    mine = full.filter(pc.and_(pc.equal(topic, t), pc.equal(place, p)))
                    if (t, p) not in open_files:
                        name = f"{uuid.uuid4().hex}.parquet"
                        open_files[t, p] = [name, pq.ParquetWriter(f"{log.root}/segments/{name}", STORED, filesystem=log.files), 0]
                    open_files[t, p][1].write_table(mine)
                    open_files[t, p][2] += len(mine)
        finally:
            for _, writer, _ in open_files.values():
                writer.close()
        return Parts(task, [{"topic": t, "partition": p, "count": n, "file": name} for (t, p), (name, _, n) in open_files.items()])

    @staticmethod
    def listed(messages) -> list[dict]:
        return [p for m in sorted((m for m in messages if m is not None), key=lambda m: m.task) for p in m.parts]


class LogWriter(_Write, DataSourceArrowWriter):
    def commit(self, messages):
        Log(self.path).commit(self.batch if self.batch is not None else uuid.uuid4().hex, self.listed(messages))

    def abort(self, messages):
        Log(self.path).discard(self.listed(messages))


class LogStreamWriter(_Write, DataSourceStreamArrowWriter):
    def commit(self, messages, batchId):
        Log(self.path).commit(str(batchId), self.listed(messages))

    def abort(self, messages, batchId):
        Log(self.path).discard(self.listed(messages))
