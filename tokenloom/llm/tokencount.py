"""Operator 3, token counts: separator scan of flat token files.

A flat token file holds nothing but ids of fixed width; an end-of-document id
closes every document, and no index tells where.  The scan cuts the files
into blocks, finds the separators of a block with one vectorised comparison,
and stitches documents over block boundaries with a prefix scan: the place of
the last separator before a block is a running maximum over the blocks
before it, and the number of documents closed before it a running sum.  The
scan has two levels (blocks in stretches of ``STRETCH``, then stretches), so
that no task orders all blocks of a long file.

Files are read and written through Arrow file systems by the path that the
table of files gives, in the shared folder, never on a local disk of one
machine.  Blocks, not files, are the unit of work; a task holds one block.

Edge cases: an empty document gives a count of 0; ids after the last
separator form a document that is marked as not closed; an empty file gives no
document; a file whose size is not a multiple of the width is refused.  Null
texts are written as empty documents; repeated rows are written as often.  An
end-of-document mark that stands in a text is encoded as ordinary text, so its
tokens are counted.  Ids that do not fit the width are refused.  Columns other
than the text and the id are not read.  An empty table gives no files and no rows.
"""

from __future__ import annotations

from typing import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tokenloom.llm.bpe import codec, definition
from tokenloom.llm.tables import map_arrow, read
from tokenloom.session import land, scratch_path

END_OF_DOCUMENT = 50256
WIDTH = 2                  # bytes of an id, unsigned, little-endian
BLOCK_IDS = 1 << 20        # ids of one block
STRETCH = 1024             # blocks of one stretch of the prefix scan
FILE_IDS = 1 << 26         # ids after which a writer begins another file


def _filesystem(path: str):
    from tokenloom.sinks.fs import filesystem

    return filesystem(path)


def write_token_files(docs: DataFrame, folder: str, text_col: str = "text", tokenizer: str | None = None, file_ids: int = FILE_IDS,
                      id_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Encode ``docs`` into flat files under ``folder``; landed tables ``(path,
    file, n_ids)`` of the files and ``(path, doc, doc_id)`` of the documents in
    them.  ``file`` names the partition and the file's number in it, so reruns
    over one table agree; the path also names the attempt, and only the files
    of a task's successful run are in the tables."""
    shared = definition(docs.sparkSession, tokenizer)
    if len(codec(shared.value).offsets) - 1 > 1 << 8 * WIDTH:
        raise ValueError(f"the vocabulary's ids do not fit {WIDTH} bytes")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        from pyspark import TaskContext

        ctx, c = TaskContext.get(), codec(shared.value)
        part, attempt = ctx.partitionId(), ctx.taskAttemptId()
        out, at, file, count, doc, done, number = None, "", "", 0, 0, [], 0
        end = np.array([END_OF_DOCUMENT], f"<u{WIDTH}").tobytes()
        names = ["path", "file", "n_ids", "doc", "doc_id"]

        def rows(paths, files, sizes, docs_, ids):
            return pa.record_batch([pa.array(paths, pa.string()), pa.array(files, pa.string()), pa.array(sizes, pa.int64()),
                                    pa.array(docs_, pa.int64()), ids.cast(pa.int64())], names=names)

        try:
            for batch in batches:
                places = []
                for x in batch.column(1):
                    if out is None:
                        file, count, doc, number = f"{part:06d}-{number:04d}", 0, 0, number + 1
                        at = f"{folder}/{file}-{attempt}.ids"
                        fs, place = _filesystem(at)
                        fs.create_dir(place.rsplit("/", 1)[0], recursive=True)
                        out = fs.open_output_stream(place)
                    # a literal end mark in a text is text
                    ids = np.frombuffer(c.encode(x.as_py() or "", special=False), "<u4")
                    out.write(ids.astype(f"<u{WIDTH}").tobytes())
                    out.write(end)
                    places.append((at, file, doc))
                    count, doc = count + len(ids) + 1, doc + 1
                    if count >= file_ids:
                        out.close()
                        out = None
                        done.append((at, file, count))
                if places:
                    paths, files, numbers = zip(*places)
                    yield rows(paths, files, [None] * len(places), numbers, batch.column(0))
        finally:
            if out is not None:
                out.close()
                done.append((at, file, count))
        if done:
            paths, files, sizes = zip(*done)
            yield rows(paths, files, sizes, [None] * len(done), pa.nulls(len(done), pa.int64()))

    ids = F.lit(None).cast("bigint") if id_col is None else F.col(id_col).cast("bigint")
    table = land(map_arrow(docs.select(ids.alias("id"), F.col(text_col)), run, "path string, file string, n_ids bigint, doc bigint, doc_id bigint"), "token-files")
    return table.where("n_ids IS NOT NULL").select("path", "file", "n_ids"), table.where("doc IS NOT NULL").select("path", "file", "doc", "doc_id")


def _blocks(files: DataFrame, block_ids: int) -> DataFrame:
    last = F.floor((F.col("n_ids") - 1) / block_ids)
    blocks = files.where("n_ids > 0").select("path", "n_ids", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("block"))
    return blocks.repartition(F.col("path"), F.col("block"))


def _scan(batches: Iterable[pa.RecordBatch], separator: int, width: int, block_ids: int) -> Iterable[pa.RecordBatch]:
    """Places of the separators of each block, counted in ids from the file's start."""
    for batch in batches:
        for path, n_ids, block in zip(*(batch.column(k).to_pylist() for k in range(3))):
            fs, place = _filesystem(path)
            start = block * block_ids
            with fs.open_input_file(place) as f:
                f.seek(start * width)
                data = f.read(min(block_ids, n_ids - start) * width)
            at = np.flatnonzero(np.frombuffer(data, f"<u{width}") == separator) + start
            yield pa.record_batch([pa.array([path]), pa.array([n_ids]), pa.array([block]), pa.array([at], pa.list_(pa.int64()))],
                                  names=["path", "n_ids", "block", "ends"])


def count_tokens(files: DataFrame, separator: int = END_OF_DOCUMENT, width: int = WIDTH, block_ids: int = BLOCK_IDS,
                 stretch: int = STRETCH) -> DataFrame:
    """``(path, doc, first, n_tokens, closed)`` for every document of
    ``files(path, n_ids)``; ``doc`` counts from 0 in the file, ``first`` is the
    place of its first id."""
    schema = "path string, n_ids bigint, block bigint, ends array<bigint>"
    found = land(map_arrow(_blocks(files, block_ids), lambda it: _scan(it, separator, width, block_ids), schema), "separators")
    blocks = found.select("path", "block", F.floor(F.col("block") / stretch).alias("part"),
                          F.size("ends").cast("bigint").alias("n"), F.array_max("ends").alias("last"))
    before = lambda *by: Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, -1)
    inner = before("path", "part", "block")
    blocks = blocks.withColumns({"docs_in": F.coalesce(F.sum("n").over(inner), F.lit(0)), "last_in": F.max("last").over(inner)})
    parts = blocks.groupBy("path", "part").agg(F.sum("n").alias("n"), F.max("last").alias("last"))
    outer = before("path", "part")
    parts = parts.select("path", "part", F.coalesce(F.sum("n").over(outer), F.lit(0)).alias("docs_out"), F.max("last").over(outer).alias("last_out"))
    carry = land(blocks.join(parts, ["path", "part"]).select(
        "path", "block", (F.col("docs_in") + F.col("docs_out")).alias("docs"), F.coalesce("last_in", "last_out", F.lit(-1)).alias("last")), "carry")
    stitched = found.join(carry, ["path", "block"]).select("path", "docs", "last", "ends", F.posexplode("ends").alias("k", "end"))
    first = F.when(F.col("k") == 0, F.col("last")).otherwise(F.get("ends", F.col("k") - 1)) + 1
    closed = stitched.select("path", (F.col("docs") + F.col("k")).alias("doc"), first.alias("first"),
                             (F.col("end") - first).alias("n_tokens"), F.lit(True).alias("closed"))
    # ids after a file's last separator
    tail = found.groupBy("path").agg(F.max("n_ids").alias("n_ids"), F.sum(F.size("ends")).alias("doc"),
                                     F.coalesce(F.max(F.array_max("ends")), F.lit(-1)).alias("last"))
    tail = tail.where("last + 1 < n_ids").select("path", "doc", (F.col("last") + 1).alias("first"),
                                                 (F.col("n_ids") - F.col("last") - 1).alias("n_tokens"), F.lit(False).alias("closed"))
    return closed.unionByName(tail)


def files_of(spark: SparkSession, paths: list[str], width: int = WIDTH) -> DataFrame:
    """The table of given flat files, with their sizes from the file system."""
    rows = []
    for path in paths:
        fs, place = _filesystem(path)
        size = fs.get_file_info(place).size
        if size is None or size % width:
            raise ValueError(f"{path}: {size} bytes are not a whole number of {width}-byte ids")
        rows.append((path, size // width))
    return spark.createDataFrame(rows, "path string, n_ids bigint")


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as flat token files, then counted without an index;
    the documents' ids come from the table that the writer leaves."""
    files, owners = write_token_files(read(spark, sf_dir, "documents"), scratch_path(spark, "tokens"), id_col="doc_id")
    counts = count_tokens(files.select("path", "n_ids"))
    return counts.join(owners, ["path", "doc"]).select("doc_id", "file", "doc", "first", "n_tokens", "closed")
