"""Incremental archive -> masked token table with Structured Streaming.

A file stream over ``*jsonl.zst`` admits ``max_files_per_trigger`` archives
per micro-batch; each micro-batch runs the same stateless operators as the
batch form (tokenize, flag, drop, encode against a vocabulary fixed before
the stream starts, mask) and is written with ``foreachBatch`` to
``{out}/batch={id}`` in overwrite mode, so a replayed micro-batch replaces
its own output instead of adding rows.  The checkpoint location records
which files are done; a restart continues from there.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from tokenloom.constants import ARCHIVE_SUFFIX, DEFAULT_MAX_TOKENS, MARKER
from tokenloom.functions.text import marker_tokens
from tokenloom.operators.lookup import Head
from tokenloom.operators.marker import drop_flagged, flag_records, with_labels
from tokenloom.operators.vocab import encode, vocabulary_head, with_tokens
from tokenloom.sources.files import read_archive

BINARY_FILE = "path string, modificationTime timestamp, length bigint, content binary"


def mask_batch(batch: DataFrame, vocab: DataFrame, max_tokens: int = DEFAULT_MAX_TOKENS,
               marker: str = MARKER, head: Head | None = None) -> DataFrame:
    """The stateless producer step on one table ``(file, row_idx, text)``:
    ``(file, row_idx, input_ids, attention_mask, labels)``."""
    t = with_tokens(batch).drop("text")
    t = drop_flagged(flag_records(t, marker_tokens(marker), max_tokens, inclusive=True))
    t = t.select("file", "row_idx", "tokens", "dff_idx")
    enc = encode(t, vocab, ["file", "row_idx"], head=head)
    return with_labels(enc, max_tokens=max_tokens).drop("dff_idx")


def stream_masked(spark: SparkSession, archive_dir: str, vocab: DataFrame, out_dir: str,
                  checkpoint_location: str, max_tokens: int = DEFAULT_MAX_TOKENS,
                  max_files_per_trigger: int = 1, marker: str = MARKER) -> None:
    """Run the stream until every archive present is processed."""
    head = vocabulary_head(vocab)             # fixed before the stream starts

    def per_batch(rows: DataFrame, batch_id: int) -> None:
        out = mask_batch(rows, vocab, max_tokens, marker, head)
        (out.write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/batch={batch_id}"))

    run_over_archives(spark, archive_dir, checkpoint_location, per_batch, max_files_per_trigger)


def run_over_archives(spark: SparkSession, archive_dir: str, checkpoint_location: str,
                      per_batch: Callable[[DataFrame, int], None], max_files_per_trigger: int = 1) -> None:
    """A file stream over the archives present: ``per_batch`` gets the rows
    ``(file, row_idx, text)`` of each micro-batch and its number.  The stream
    itself carries the files' names only (``max_files_per_trigger`` at most);
    their frames are read in parallel."""
    src = (spark.readStream.format("binaryFile").schema(BINARY_FILE)
           .option("maxFilesPerTrigger", max_files_per_trigger)
           .option("pathGlobFilter", f"*{ARCHIVE_SUFFIX}")
           .load(archive_dir).select("path"))

    def batch(names: DataFrame, batch_id: int) -> None:
        files = sorted(r["path"] for r in names.collect())
        per_batch(read_archive(spark, files), batch_id)

    q = (src.writeStream.foreachBatch(batch)
         .option("checkpointLocation", checkpoint_location)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    err = q.exception()
    if err is not None:
        raise RuntimeError(f"stream failed: {err}")
