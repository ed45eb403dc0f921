"""K5: zstd-compressed JSON-lines archives.

Spark's JSON writer has no zstd codec, so tasks compress.  The JSON line
itself (``{"text": ..., "meta": {}}``) is built on the JVM by ``to_json``
before rows reach Python; a task only gathers lines and compresses them frame
by frame, so memory stays flat whatever the file size.  Named files are
written by many tasks (see ``frames``).  Part files, one per task, go through
a PySpark data source: written under ``_temporary`` and moved into place by
the driver-side commit; an aborted job removes its temporary files.

Any zstd reader reads the files; ``tokenloom.sources.files.read_archive``
reads their frames in parallel.
"""

from __future__ import annotations

import uuid
from collections import Counter
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from tokenloom.constants import ARCHIVE_SUFFIX
from tokenloom.session import bound_batches, default_parallelism, land, ship_package
from tokenloom.sinks.frames import FRAME_BYTES, PARTS, FrameWriter, stitch, write_parts
from tokenloom.sinks.fs import clear_job, filesystem, join


@dataclass
class ArchiveCommit(WriterCommitMessage):
    moves: list = field(default_factory=list)   # (temporary path, final path)
    rows: int = 0


class ArchiveDataSource(DataSource):
    """``df.write.format("tokenloom_archive").option("path", dir)``: one part
    file per task.

    Options: ``path`` (folder), ``level`` (zstd level, default 3).  Input
    columns: ``line`` (a ready JSON line) or ``text``.
    """

    @classmethod
    def name(cls) -> str:
        return "tokenloom_archive"

    def schema(self) -> str:
        return "text string"

    def writer(self, schema, overwrite: bool):
        return ArchiveWriter(self.options)


class ArchiveWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.level = int(options.get("level", "3"))
        self.job = uuid.uuid4().hex[:12]

    def write(self, iterator) -> ArchiveCommit:
        import json

        from pyspark import TaskContext

        ctx = TaskContext.get()
        pid = ctx.partitionId() if ctx else 0
        attempt = ctx.attemptNumber() if ctx else 0
        fs, root = filesystem(self.path)
        name = f"part-{pid:05d}-{self.job}.{ARCHIVE_SUFFIX}"
        folder = join(root, "_temporary", self.job, f"{pid:05d}-{attempt}")
        writer, rows = None, 0
        for batch in iterator:
            if "line" in batch.schema.names:
                lines = batch.column("line").to_pylist()
            else:
                lines = [json.dumps({"text": t, "meta": {}}) for t in batch.column("text").to_pylist()]
            if lines and writer is None:
                fs.create_dir(folder, recursive=True)
                writer = FrameWriter(fs.open_output_stream(join(folder, name), compression=None), self.level)
            if lines:
                writer.write(lines)
            rows += len(lines)
        if writer is None:
            return ArchiveCommit()
        writer.close()
        return ArchiveCommit(moves=[(join(folder, name), join(root, name))], rows=rows)

    def commit(self, messages) -> None:
        fs, root = filesystem(self.path)
        finals = [dst for m in messages if m for _, dst in m.moves]
        dupes = {d for d, n in Counter(finals).items() if n > 1}
        if dupes:
            self.abort(messages)
            raise ValueError(f"archive files written by more than one task: {sorted(dupes)[:5]}")
        there = [d for d in finals if fs.get_file_info(d).type.name != "NotFound"]
        if there:
            self.abort(messages)
            raise FileExistsError(f"archive files exist already: {sorted(there)[:5]}")
        for m in messages:
            for src, dst in (m.moves if m else []):
                fs.move(src, dst)
        clear_job(fs, root, self.job)

    def abort(self, messages) -> None:
        fs, root = filesystem(self.path)
        clear_job(fs, root, self.job)


def archive_lines(df: DataFrame, text_col: str = "text") -> DataFrame:
    """JSON line per row, built on the JVM: ``{"text": ..., "meta": {}}``."""
    meta = F.from_json(F.lit("{}"), "map<string,string>")
    return df.withColumn("line", F.to_json(F.struct(F.col(text_col).alias("text"), meta.alias("meta"))))


def write_archive(df: DataFrame, path: str, file_col: str | None = None, order_col: str | None = None,
                  text_col: str = "text", level: int = 3, frame_bytes: int = FRAME_BYTES) -> None:
    """K5: write ``text`` as archives of indexed frames (see ``frames``).  With
    ``file_col`` every distinct value becomes one file, its records in the
    order of ``order_col`` and compressed by as many tasks as its size takes;
    without it every task writes one part file."""
    spark = df.sparkSession
    ship_package(spark)
    bound_batches(spark)
    if file_col is None:
        spark.dataSource.register(ArchiveDataSource)
        out = df.sortWithinPartitions(order_col) if order_col else df
        archive_lines(out, text_col).select("line").write.format(ArchiveDataSource.name()).mode("append").option("path", path).option("level", level).save()
        return
    job, order = uuid.uuid4().hex[:12], [F.col(file_col)] + ([F.col(order_col)] if order_col else [])
    fs, root = filesystem(path)
    try:
        dealt = df.select(*order, text_col)
        n = default_parallelism(spark)
        dealt = dealt.repartitionByRange(n, *order) if order_col else dealt.repartition(n, file_col)
        lines = archive_lines(dealt.sortWithinPartitions(*order), text_col).select(F.col(file_col).cast("string").alias("file"), "line")
        parts = land(lines.mapInArrow(write_parts(path, job, level, frame_bytes), PARTS), "archive-parts")
        whole = parts.groupBy("file").agg(F.sort_array(F.collect_list(F.struct("part", "path", "sizes", "lines"))).alias("parts"))
        made = land(whole.mapInArrow(stitch(path, job), "file string, path string, n_parts int"), "archive-files").select("file", "path").collect()
        there = [r["file"] for r in made if fs.get_file_info(join(root, r["file"])).type.name != "NotFound"]
        if there:
            raise FileExistsError(f"archive files exist already: {sorted(there)[:5]}")
        for r in made:
            fs.move(r["path"], join(root, r["file"]))
    finally:
        clear_job(fs, root, job)
