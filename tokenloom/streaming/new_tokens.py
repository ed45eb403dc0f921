"""T1 with tokens that the vocabulary does not hold: ids from keyed state.

A stream over archives looks for tokens that a given vocabulary lacks.  Each
such token belongs to one of ``buckets`` keys; the key's state maps the tokens
seen so far to their numbers.  A new token's rank is ``known + number *
buckets + bucket``, so ids of different keys never meet and no task waits for
another.  State and input offsets are committed together, tokens of a
micro-batch are numbered in their order, and the assignments of a micro-batch
overwrite its own folder: a restart, or a replay after a failure, gives every
token the id that it had, once.
"""

from __future__ import annotations

from typing import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tokenloom.constants import ARCHIVE_SUFFIX
from tokenloom.operators.vocab import id_of_rank, with_tokens
from tokenloom.session import bound_batches, ship_package
from tokenloom.sinks.frames import FRAMES, list_frames, read_lines
from tokenloom.streaming.chunks import BINARY_FILE

BUCKETS = 256
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class TokenNumbers(StatefulProcessor):
    """Numbers the tokens of one key in the order of their arrival."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.numbers = handle.getMapState("numbers", StructType([StructField("token", StringType())]), StructType([StructField("number", LongType())]))
        self.used = handle.getValueState("used", StructType([StructField("used", LongType())]))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        tokens = sorted({r["token"] for r in rows})
        used = self.used.get()[0] if self.used.exists() else 0
        for token in tokens:
            if not self.numbers.containsKey((token,)):
                self.numbers.updateValue((token,), (used,))
                yield Row(token=token, bucket=key[0], number=used)
                used += 1
        self.used.update((used,))

    def close(self) -> None:
        pass


def _records(spark: SparkSession, archive_dir: str, max_files_per_trigger: int) -> DataFrame:
    """``text`` of the archives as a stream, read frame by frame."""
    ship_package(spark)
    bound_batches(spark)
    names = (spark.readStream.format("binaryFile").schema(BINARY_FILE)
             .option("maxFilesPerTrigger", max_files_per_trigger).option("pathGlobFilter", f"*{ARCHIVE_SUFFIX}")
             .load(archive_dir).select("path"))
    frames = names.mapInArrow(list_frames, FRAMES).repartition("path", "offset")
    lines = frames.mapInArrow(read_lines, "file string, row_idx bigint, line string")
    return lines.select(F.from_json("line", "text string", {"mode": "FAILFAST"}).getField("text").alias("text"))


def stream_new_ids(spark: SparkSession, archive_dir: str, vocab: DataFrame, out_dir: str, checkpoint_location: str,
                   max_files_per_trigger: int = 1, buckets: int = BUCKETS) -> None:
    """Give ids to the tokens of all archives present that ``vocab(token, id)``
    lacks: ``(token, id)`` under ``out_dir``, one folder per micro-batch.  Call
    it again, with the same arguments, for archives that came later."""
    known = vocab.count()
    tokens = with_tokens(_records(spark, archive_dir, max_files_per_trigger)).select(F.explode("tokens").alias("token"))
    late = tokens.join(vocab.select("token"), "token", "left_anti")
    keyed = late.withColumn("bucket", F.pmod(F.xxhash64("token"), F.lit(buckets)).cast("bigint"))
    schema = StructType([StructField("token", StringType()), StructField("bucket", LongType()), StructField("number", LongType())])
    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        new = keyed.groupBy("bucket").transformWithState(TokenNumbers(), schema, "Append", "None")
        ranked = new.select("token", id_of_rank(F.lit(known) + F.col("number") * buckets + F.col("bucket")).alias("id"))

        def per_batch(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/batch={batch_id}")

        q = (ranked.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint_location)
             .trigger(availableNow=True).start())
        q.awaitTermination()
    finally:
        spark.conf.unset(STATE_STORE) if before is None else spark.conf.set(STATE_STORE, before)
    if q.exception() is not None:
        raise RuntimeError(f"stream failed: {q.exception()}")


def with_new_ids(vocab: DataFrame, new_ids_dir: str) -> DataFrame:
    """``vocab`` and the ids that the stream gave: ``(token, id)``."""
    given = vocab.sparkSession.read.schema("token string, id bigint").parquet(f"{new_ids_dir.rstrip('/')}/*")
    return vocab.select("token", "id").unionByName(given.select("token", "id"))
