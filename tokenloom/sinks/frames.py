"""Archives of independent zstd frames with an index, written and read by
many tasks (K5, S1).

An archive file is a row of zstd frames, each holding whole lines (about
``FRAME_BYTES`` of text), and at its end a skippable frame: for each frame
before it the compressed size and the number of lines, then their number and
a tag.  Every zstd reader, Spark's among them, passes over skippable frames,
so the file stays an ordinary ``*.jsonl.zst``.  With the index a task can
read any frame on its own and knows the number of its first line.

Writing: records are range-partitioned by ``(file, order)``; every task writes
its stretch of each file as a part, itself an indexed archive.  Parts of one
file are then copied end to end, compressed as they are, and get an index of
the whole; a file with one part is taken as it stands.  So a file that holds a
third of all records is compressed by many tasks.  Files appear under their
names by renames at the end; a failed job leaves none.
"""

from __future__ import annotations

import struct
from typing import Iterable, Iterator

from tokenloom.sinks.fs import filesystem, join

FRAME_BYTES = 4 << 20
# fixed values: a skippable frame's number in the zstd format, and the index's own tag
SKIPPABLE = 0x184D2A51
TAG = b"tlframes"
_FOOT = struct.Struct("<I8s")
_HEAD = struct.Struct("<II")


def index_frame(entries: list[tuple[int, int]]) -> bytes:
    """``(compressed size, lines)`` of all frames so far, as a skippable frame."""
    body = b"".join(_HEAD.pack(size, lines) for size, lines in entries) + _FOOT.pack(len(entries), TAG)
    return _HEAD.pack(SKIPPABLE, len(body)) + body


def read_index(stream, size: int) -> list[tuple[int, int]] | None:
    """The entries of a file's index; None if it has none."""
    if size < _HEAD.size + _FOOT.size:
        return None
    stream.seek(size - _FOOT.size)
    n, tag = _FOOT.unpack(stream.read(_FOOT.size))
    whole = _HEAD.size + _HEAD.size * n + _FOOT.size
    if tag != TAG or whole > size:
        return None
    stream.seek(size - whole)
    raw = stream.read(whole)
    if _HEAD.unpack_from(raw) != (SKIPPABLE, whole - _HEAD.size):
        return None
    return [_HEAD.unpack_from(raw, _HEAD.size * (k + 1)) for k in range(n)]


class FrameWriter:
    """Lines into frames of a binary stream; ``close`` adds the index."""

    def __init__(self, raw, level: int = 3, frame_bytes: int = FRAME_BYTES):
        import zstandard
        self.raw, self.compressor, self.frame_bytes = raw, zstandard.ZstdCompressor(level=level), frame_bytes
        self.lines: list[bytes] = []
        self.size, self.entries = 0, []

    def write(self, lines: Iterable[str]) -> None:
        for line in lines:
            data = line.encode()
            self.lines.append(data)
            self.size += len(data) + 1
            if self.size >= self.frame_bytes:
                self.flush()

    def flush(self) -> None:
        if self.lines:
            frame = self.compressor.compress(b"\n".join(self.lines) + b"\n")
            self.raw.write(frame)
            self.entries.append((len(frame), len(self.lines)))
            self.lines, self.size = [], 0

    def close(self) -> list[tuple[int, int]]:
        self.flush()
        self.raw.write(index_frame(self.entries))
        self.raw.close()
        return self.entries


def write_parts(root_path: str, job: str, level: int, frame_bytes: int):
    """Task function over sorted ``(file, line)`` batches: one part per file;
    rows ``(file, part, path, rows, sizes, lines)``."""
    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        ctx = TaskContext.get()
        part, attempt = ctx.partitionId(), ctx.taskAttemptId()
        fs, root = filesystem(root_path)
        folder = join(root, "_temporary", job, f"{part:06d}-{attempt}")
        name, writer, out = None, None, []

        def done():
            entries = writer.close()
            out.append((name, part, join(folder, name), sum(e[1] for e in entries), [e[0] for e in entries], [e[1] for e in entries]))

        for batch in batches:
            names, lines = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            lo = 0
            for k in range(1, len(names) + 1):           # stretches of one name
                if k < len(names) and names[k] == names[lo]:
                    continue
                if names[lo] != name:
                    if writer:
                        done()
                    name = names[lo]
                    fs.create_dir(folder, recursive=True)
                    writer = FrameWriter(fs.open_output_stream(join(folder, name), compression=None), level, frame_bytes)
                writer.write(lines[lo:k])
                lo = k
        if writer:
            done()
        if out:
            kinds = [pa.string(), pa.int32(), pa.string(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=["file", "part", "path", "rows", "sizes", "lines"])
    return run


PARTS = "file string, part int, path string, rows bigint, sizes array<bigint>, lines array<bigint>"


def stitch(root_path: str, job: str, chunk: int = 1 << 20):
    """Task function over ``(file, parts)``: one file from each list of parts in
    order; rows ``(file, path, n_parts)``."""
    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        attempt = TaskContext.get().taskAttemptId()
        fs, root = filesystem(root_path)
        folder = join(root, "_temporary", job, f"whole-{attempt}")
        for batch in batches:
            out = []
            for name, parts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if len(parts) == 1:
                    out.append((name, parts[0]["path"], 1))
                    continue
                fs.create_dir(folder, recursive=True)
                entries: list[tuple[int, int]] = []
                with fs.open_output_stream(join(folder, name), compression=None) as raw:
                    for p in parts:
                        with fs.open_input_stream(p["path"], compression=None) as source:
                            while data := source.read(chunk):
                                raw.write(data)
                        own = list(zip(p["sizes"], p["lines"]))
                        entries += own + [(len(index_frame(own)), 0)]     # the part's index is a frame without lines
                    raw.write(index_frame(entries))
                out.append((name, join(folder, name), len(parts)))
            if out:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), [pa.string(), pa.string(), pa.int32()])], names=["file", "path", "n_parts"])
    return run


FRAMES = "path string, offset bigint, size bigint, first_row bigint, rows bigint"


def list_frames(batches):
    """Task function over ``path``: a row for each frame with lines; a file
    without an index is one row without ``rows``."""
    import pyarrow as pa

    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    for batch in batches:
        out = []
        for path in batch.column(0).to_pylist():
            fs, p = filesystem(path)
            size = fs.get_file_info(p).size
            with fs.open_input_file(p) as stream:
                entries = read_index(stream, size)
            if entries is None:
                out.append((path, 0, size, 0, None))
                continue
            offset = row = 0
            for length, lines in entries:
                if lines:
                    out.append((path, offset, length, row, lines))
                offset, row = offset + length, row + lines
        if out:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=["path", "offset", "size", "first_row", "rows"])


def _pieces(path: str, offset: int, size: int, rows: int | None, chunk: int) -> Iterator[list[bytes]]:
    """Lines of a frame, or of a whole file without an index, in lists."""
    import zstandard

    fs, p = filesystem(path)
    if rows is not None:
        with fs.open_input_file(p) as stream:
            stream.seek(offset)
            raw = stream.read(size)
        lines = zstandard.ZstdDecompressor().decompress(raw).split(b"\n")[:-1]
        if len(lines) != rows:
            raise ValueError(f"{path}: the frame at {offset} has {len(lines)} lines, its index says {rows}")
        yield lines
        return
    left = b""
    with fs.open_input_stream(p, compression=None) as stream:
        reader = zstandard.ZstdDecompressor().stream_reader(stream, read_across_frames=True)
        while data := reader.read(chunk):
            lines = (left + data).split(b"\n")
            left = lines.pop()
            yield lines
    if left:
        yield [left]


def read_lines(batches, chunk: int = FRAME_BYTES):
    """Task function over ``FRAMES`` rows: ``(file, row_idx, line)``; blank lines
    are no records."""
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        for path, offset, size, first, rows in zip(*(c.to_pylist() for c in batch.columns)):
            row, name = first, path.rsplit("/", 1)[-1]
            for lines in _pieces(path, offset, size, rows, chunk):
                lines = [x for x in lines if x.strip()]
                if lines:
                    yield pa.record_batch([pa.array([name] * len(lines), pa.string()), pa.array(np.arange(row, row + len(lines))),
                                           pa.array(lines, pa.binary()).cast(pa.string())], names=["file", "row_idx", "line"])
                row += len(lines)
