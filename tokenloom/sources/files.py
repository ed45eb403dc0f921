"""Sources (S1-S9).

S1 archive scan (``*jsonl.zst``, one JSON object per line, only ``text`` is
read), S2 file resolution, S3 saved tables, S4/S5 CSV/JSON/text splits, S6
named tables, S7 index text files, S8 file count, S9 multi-file reads (every
read here is one multi-path Spark read carrying the file name).
"""

from __future__ import annotations

from collections import Counter
from typing import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.constants import ARCHIVE_SUFFIX
from tokenloom.operators.indexing import index_from_text
from tokenloom.operators.rowindex import file_row_index, ordered_index, tag_scan_position
from tokenloom.session import bound_batches, land, ship_package
from tokenloom.sinks.frames import FRAMES, list_frames, read_lines
from tokenloom.sinks.fs import filesystem

TASK_BYTES = 32 << 20     # compressed bytes that one task reads


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def resolve_archive_files(spark: SparkSession, path: str, suffix: str = ARCHIVE_SUFFIX) -> list[str]:
    """A single archive file, or the archive files directly inside a
    folder (glob ``*jsonl.zst``, not recursive).  Listing is metadata only."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        raise FileNotFoundError(f"archive path {path} does not exist")
    if fs.getFileStatus(p).isDirectory():
        statuses = fs.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(
            path.rstrip("/") + f"/*{suffix}")) or []
        files = sorted(str(s.getPath().toString()) for s in statuses if s.isFile())
        if not files:
            raise ValueError(f"folder {path} holds no archive (names ending in {suffix})")
        # Spark's readers pass over such names without a word
        hidden = [f for f in files if f.rsplit("/", 1)[-1].startswith(("_", "."))]
        if hidden:
            raise ValueError(f"archives with hidden names cannot be read, rename them: {hidden[:5]}")
        return files
    if not path.endswith(suffix):
        raise ValueError(f"archive {path} does not end in {suffix}")
    return [str(p.toString())]


def list_archives(spark: SparkSession, path: str) -> list[str]:
    """S2 for a folder that may be missing or empty."""
    fs, p = _fs(spark, path)
    found = fs.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + f"/*{ARCHIVE_SUFFIX}")) or []
    return sorted(s.getPath().toString() for s in found)


def read_archive(spark: SparkSession, path: str | Iterable[str], with_row_index: bool = True) -> DataFrame:
    """S1 + S9 (+O1): ``(file, row_idx, text)`` from one or many archives.

    Archives with a frame index (``sinks.frames``) are read frame by frame, by
    as many tasks as their size takes; others by one task each, in order.
    ``row_idx`` is the position in the file, known from the index or counted
    on the way, so everything is read once.  Where only Spark knows the file
    system, Spark reads the files, once for the positions and once for the
    rows.  ``file`` is the base name, so two archives of one name are an error.
    """
    paths = [path] if isinstance(path, str) else list(path)
    files = [f for p in paths for f in resolve_archive_files(spark, p)]
    repeated = [n for n, k in Counter(f.rsplit("/", 1)[-1] for f in files).items() if k > 1]
    if repeated:
        raise ValueError(f"archives of different folders share a name: {sorted(repeated)[:5]}")
    if with_row_index and all(map(reachable, files)):
        return read_frames(spark, files)
    df = spark.read.schema("text string").option("mode", "FAILFAST").json(files)
    if not with_row_index:
        return df.select(F.col("_metadata.file_name").alias("file"), "text")
    tagged = tag_scan_position(df)
    return file_row_index(tagged).select("file", "row_idx", "text")


def reachable(path: str) -> bool:
    """Whether tasks can open ``path`` themselves."""
    try:
        filesystem(path)
        return True
    except Exception:
        return False


def read_frames(spark: SparkSession, files: list[str], task_bytes: int = TASK_BYTES) -> DataFrame:
    """``(file, row_idx, text)`` of archive files, frame by frame: the files'
    indexes are read by tasks, then frames of about ``task_bytes`` (compressed)
    go to one task.  A bad line fails the read."""
    ship_package(spark)
    bound_batches(spark)
    cores = spark.sparkContext.defaultParallelism
    paths = spark.createDataFrame([(f,) for f in files], "path string").repartition(min(len(files), 4 * cores))
    frames = land(paths.mapInArrow(list_frames, FRAMES), "frames")
    n, size = frames.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    tasks = max(1, min(n, max(cores, -(-size // task_bytes))))
    dealt = frames.repartitionByRange(tasks, "path", "offset") if tasks > 1 else frames.coalesce(1)
    lines = dealt.mapInArrow(read_lines, "file string, row_idx bigint, line string")
    return lines.select("file", "row_idx", F.from_json("line", "text string", {"mode": "FAILFAST"}).getField("text").alias("text"))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """S3: re-open a saved table (any mid-point)."""
    return spark.read.parquet(path)


def read_named(spark: SparkSession, name: str, config: str | None = None, root: str | None = None) -> DataFrame:
    """A named data set: a catalog table, or ``{root}/{name}/{config}``."""
    if root is None:
        return spark.table(name if config is None else f"{name}_{config}")
    return spark.read.parquet(f"{root.rstrip('/')}/{name}" + (f"/{config}" if config else ""))


_EXTENSIONS = ("csv", "json", "txt")


def _read_one(spark: SparkSession, path: str, keep_linebreaks: bool, ordered: bool = False) -> DataFrame:
    ext = path.rsplit(".", 1)[-1]
    if ext not in _EXTENSIONS:
        raise ValueError(f"{path}: extension {ext!r} is none of {', '.join(_EXTENSIONS)}")
    if ext == "csv":
        df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    else:
        df = spark.read.json(path) if ext == "json" else spark.read.text(path)
    if ordered:
        df = file_row_index(tag_scan_position(df), "_in_file")
    if ext != "txt":
        return df
    text = F.concat(F.col("value"), F.lit("\n")) if keep_linebreaks else F.col("value")      # S5
    return df.select(text.alias("text"), *[c for c in df.columns if c != "value"])


def read_split_files(spark: SparkSession, train_file: str | None = None,
                     validation_file: str | None = None, keep_linebreaks: bool = True,
                     order_col: str | None = None) -> DataFrame:
    """S4 (+S5): CSV / JSON / TXT files for the train and/or validation
    split, as one table with a ``split`` column.  ``order_col`` adds one
    dense 0-based index by split, file and position in the file."""
    parts = []
    for split, path in (("train", train_file), ("validation", validation_file)):
        if path is not None:
            parts.append(_read_one(spark, path, keep_linebreaks, order_col is not None).withColumn("split", F.lit(split)))
    if not parts:
        raise ValueError("neither train_file nor validation_file is given")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    if order_col is not None:
        out = ordered_index(out, [F.col("split"), F.col("file"), F.col("_in_file")], order_col).drop("file", "_in_file")
    return out


def read_index_text(spark: SparkSession, path: str) -> DataFrame:
    """S7 (+F12): ``(file, row_idx)`` from index text files.

    Folders written by :func:`tokenloom.sinks.tables.write_index_text` carry
    the data file name as the ``file`` partition column and hold bounded
    lines; they are read line by line.  A flat folder of foreign index
    files (plain text named like the data file, e.g. ``x.jsonl.zst``) is
    read as raw bytes, so no codec is guessed from the name, and each file
    name becomes ``file``.  Every integer is an index (``None`` and brackets
    are skipped, any nesting is flattened).
    """
    lines = spark.read.text(path)
    if "file" in lines.columns:
        return index_from_text(lines, "value")
    raw = (spark.read.format("binaryFile").load(path)
           .select(F.element_at(F.split("path", "/"), -1).alias("file"),
                   F.decode("content", "UTF-8").alias("value")))
    return index_from_text(raw, "value")


def count_files(spark: SparkSession, path: str, glob: str | None = None) -> int:
    """Number of files in a folder (only paths are read)."""
    r = spark.read.format("binaryFile")
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(path).select("path").count()
