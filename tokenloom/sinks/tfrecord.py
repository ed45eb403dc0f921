"""K6: TF-record files of id sequences as a PySpark data source.

Each row becomes one ``Example`` with a single int64-list feature (``text``
by default).  Framing per record: little-endian u64 length, masked CRC-32C
of the length bytes, the payload, masked CRC-32C of the payload.  The
protobuf payload is written by hand (no TensorFlow needed).

Every task writes one part file under ``_temporary``; the commit, which
knows the total row count, names the files ``{name}_{total}.tfrecords`` (one
part) or ``{name}_{total}.tfrecords-{i}-of-{n}`` (several).  A reader for
the same format is included for round trips.
"""

from __future__ import annotations

import io
import struct
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql.datasource import (DataSource, DataSourceReader, DataSourceWriter, InputPartition,
                                    WriterCommitMessage)

from tokenloom.session import bound_batches, ship_package
from tokenloom.sinks.fs import clear_job, filesystem, join, list_files


READ_BYTES = 1 << 20     # read ahead of a file


# --- CRC-32C (Castagnoli), reflected polynomial 0x82F63B78 ----------------
def _crc_table() -> list[int]:
    table = []
    for i in range(256):
        c = i
        for _ in range(8):
            c = (c >> 1) ^ 0x82F63B78 if c & 1 else c >> 1
        table.append(c)
    return table


_CRC_TABLE = _crc_table()


def crc32c(data: bytes) -> int:
    crc = 0xFFFFFFFF
    t = _CRC_TABLE
    for b in data:
        crc = t[(crc ^ b) & 0xFF] ^ (crc >> 8)
    return crc ^ 0xFFFFFFFF


def masked_crc(data: bytes) -> int:
    c = crc32c(data)
    return (((c >> 15) | (c << 17)) + 0xA282EAD8) & 0xFFFFFFFF


# --- minimal protobuf for tf.train.Example ---------------------------------
def _varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n >= 0x80:
        out.append((n & 0x7F) | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _ld(tag: int, payload: bytes) -> bytes:
    return bytes([tag]) + _varint(len(payload)) + payload


def example_bytes(values, key: str = "text") -> bytes:
    """Serialized ``Example{features{feature{key: int64_list{value: values}}}}``."""
    packed = b"".join(_varint(int(v)) for v in values)
    int64_list = _ld(0x0A, packed) if packed else b""
    feature = _ld(0x1A, int64_list)
    entry = _ld(0x0A, key.encode("utf-8")) + _ld(0x12, feature)
    return _ld(0x0A, _ld(0x0A, entry))


def _read_varint(buf: bytes, i: int) -> tuple[int, int]:
    shift = result = 0
    while True:
        b = buf[i]
        i += 1
        result |= (b & 0x7F) << shift
        if b < 0x80:
            return result, i
        shift += 7


def _fields(buf: bytes):
    i = 0
    while i < len(buf):
        key, i = _read_varint(buf, i)
        num, wt = key >> 3, key & 7
        if wt == 2:
            n, i = _read_varint(buf, i)
            yield num, wt, buf[i:i + n]
            i += n
        elif wt == 0:
            v, i = _read_varint(buf, i)
            yield num, wt, v
        else:
            raise ValueError(f"unsupported wire type {wt}")


def _signed(v: int) -> int:
    return v - (1 << 64) if v >= 1 << 63 else v


def parse_example(buf: bytes) -> dict[str, list[int]]:
    """int64-list features of a serialized ``Example``."""
    out: dict[str, list[int]] = {}
    for num, _, features in _fields(buf):
        if num != 1:
            continue
        for fnum, _, entry in _fields(features):
            if fnum != 1:
                continue
            key, values = "", []
            for enum, _, part in _fields(entry):
                if enum == 1:
                    key = part.decode("utf-8")
                elif enum == 2:
                    for knum, _, lst in _fields(part):
                        if knum == 3:
                            for vnum, wt, v in _fields(lst):
                                if vnum != 1:
                                    continue
                                if wt == 2:
                                    j = 0
                                    while j < len(v):
                                        x, j = _read_varint(v, j)
                                        values.append(_signed(x))
                                else:
                                    values.append(_signed(v))
            out[key] = values
    return out


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return length + struct.pack("<I", masked_crc(length)) + payload + struct.pack("<I", masked_crc(payload))


def read_records(data, verify: bool = True):
    """Payloads of ``data``: bytes, or a binary stream, of which one record is
    held at a time."""
    stream = io.BytesIO(data) if isinstance(data, bytes) else data
    while head := stream.read(12):
        if len(head) < 12:
            raise ValueError("truncated record length")
        n, lc = struct.unpack("<QI", head)
        if verify and lc != masked_crc(head[:8]):
            raise ValueError("corrupt record length")
        body = stream.read(n + 4)
        if len(body) < n + 4:
            raise ValueError("truncated record")
        payload = body[:n]
        (pc,) = struct.unpack("<I", body[n:])
        if verify and pc != masked_crc(payload):
            raise ValueError("corrupt record payload")
        yield payload


# --- data source ---------------------------------------------------------------
@dataclass
class TFRecordCommit(WriterCommitMessage):
    tmp: str = ""
    rows: int = 0
    part: int = 0
    extra: list = field(default_factory=list)


class TFRecordDataSource(DataSource):
    """Write: ``df.write.format("tokenloom_tfrecord").option("path", dir)
    .option("name", "data")`` with an ``array<int|bigint>`` column (option
    ``column``, default ``ids``).  Read: ``spark.read.format(...).load(dir)``
    gives ``(file, record_idx, ids)``."""

    @classmethod
    def name(cls) -> str:
        return "tokenloom_tfrecord"

    def schema(self) -> str:
        return "file string, record_idx bigint, ids array<bigint>"

    def writer(self, schema, overwrite: bool):
        return TFRecordWriter(self.options)

    def reader(self, schema):
        return TFRecordReader(self.options)


class TFRecordWriter(DataSourceWriter):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.name_prefix = options.get("name", "data")
        self.column = options.get("column", "ids")
        self.feature = options.get("feature", "text")
        self.job = uuid.uuid4().hex[:12]

    def write(self, iterator) -> TFRecordCommit:
        from pyspark import TaskContext

        ctx = TaskContext.get()
        pid = ctx.partitionId() if ctx else 0
        attempt = ctx.attemptNumber() if ctx else 0
        fs, root = filesystem(self.path)
        tmp_dir = join(root, "_temporary", self.job)
        fs.create_dir(tmp_dir, recursive=True)
        tmp = join(tmp_dir, f"{pid:05d}-{attempt}.tfrecords")
        rows = 0
        with fs.open_output_stream(tmp, compression=None) as out:
            for row in iterator:
                out.write(frame(example_bytes(row[self.column] or [], self.feature)))
                rows += 1
        return TFRecordCommit(tmp=tmp, rows=rows, part=pid)

    def commit(self, messages) -> None:
        fs, root = filesystem(self.path)
        parts = sorted((m for m in messages if m is not None), key=lambda m: m.part)
        total = sum(m.rows for m in parts)
        n = len(parts)
        base = f"{self.name_prefix}_{total}.tfrecords"
        names = [join(root, base if n == 1 else f"{base}-{i:05d}-of-{n:05d}") for i in range(n)]
        if any(fs.get_file_info(x).type.name != "NotFound" for x in names):
            # an earlier job wrote as many records under this name: keep both
            names = [f"{x.removesuffix('.tfrecords')}-{self.job}.tfrecords" for x in names]
        for m, name in zip(parts, names):
            fs.move(m.tmp, name)
        clear_job(fs, root, self.job)

    def abort(self, messages) -> None:
        fs, root = filesystem(self.path)
        clear_job(fs, root, self.job)


class TFRecordReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.feature = options.get("feature", "text")

    def partitions(self):
        return [InputPartition(f) for f in list_files(self.path, ".tfrecords")]

    def read(self, partition):
        fs, _ = filesystem(self.path)
        name = partition.value.rsplit("/", 1)[-1]
        with fs.open_input_stream(partition.value, compression=None, buffer_size=READ_BYTES) as fh:
            for k, payload in enumerate(read_records(fh)):
                yield (name, k, parse_example(payload).get(self.feature, []))


def write_tfrecords(df: DataFrame, path: str, name: str = "data", column: str = "ids") -> None:
    """K6: one Example per row of ``column``."""
    ship_package(df.sparkSession)
    bound_batches(df.sparkSession)
    df.sparkSession.dataSource.register(TFRecordDataSource)
    (df.select(column).write.format(TFRecordDataSource.name()).mode("append")
       .option("path", path).option("name", name).option("column", column).save())


def read_tfrecords(spark, path: str) -> DataFrame:
    ship_package(spark)
    bound_batches(spark)
    spark.dataSource.register(TFRecordDataSource)
    return spark.read.format(TFRecordDataSource.name()).option("path", path).load()
