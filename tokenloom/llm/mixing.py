"""Operator 5, mixing sources to target weights: pivotal dependent rounding.

A source's target divided by its size is the expected number of copies of
each of its documents.  The whole part is taken as it is; the fraction is
rounded by a pivotal process on words: two documents of a source meet, and
one passes words of its expected mass to the other until one of them is
integral (taken once more, or not).  Which way the mass goes is random, with
the odds that keep every expectation; the sum of both masses never changes.
So a source ends within one document of its target.

The meetings form a reduction tree.  Documents are dealt into blocks of about
``FAN`` by a hash; each block is folded by one ``aggregate`` expression and
leaves at most one document unfinished, and these are dealt into blocks
again, until one per source is left, which is rounded by its own odds.  All
of it is DataFrame functions; random numbers are hashes of the documents' ids
and a seed, so reruns agree.

Null text: size 0, never taken (``taken`` 0).  Null source: a source of its
own, the last.  Repeated rows are documents of their own; ties are broken by a
hash.  Extra columns are not read by ``mix`` and kept by ``mixed_documents``,
whatever their names.  An empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tokenloom.llm.rows import packed, unpacked
from tokenloom.llm.tables import read
from tokenloom.session import land

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5          # of all sizes
MOST_COPIES = 2.0    # a target's limit in sizes of its source
FAN = 128            # documents of one fold, on average
SEED = 5
#: Sources up to this many are broadcast (40 bytes each); more are joined by a shuffle.
BROADCAST_SOURCES = 100_000


def words(text: Column | str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit("[^ \\t-\\r]+")), F.lit(0)).cast("bigint")


def targets(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """``(source, source_size, target)`` of ``sized(source, size)``.

    Sources by code point, null last, take the weights in turn.  Targets are
    ``min(MOST_COPIES * size, level * weight)`` with the one ``level`` at which
    they add up to ``share`` of all sizes: resharing what is above the limits
    by weight, until none is above, ends there.  Sources reach their limit in
    the order of limit over weight, so the level follows from running sums.
    The windows run over one row per source.
    """
    s = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.array(*[F.lit(w) for w in weights])
    s = s.withColumn("weight", F.get(turn, ((F.row_number().over(order) - 1) % len(weights)).cast("int")))
    s = s.withColumn("limit", MOST_COPIES * F.col("source_size"))
    everything = Window.partitionBy()
    full = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumns({
        "total": share * F.sum("source_size").over(everything),
        "weight_left": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(full), F.lit(0.0)),
        "limit_full": F.coalesce(F.sum("limit").over(full), F.lit(0.0)),
    })
    # the level if exactly the sources before this one are at their limit; it
    # rises as long as the next source is above its limit, then falls
    s = s.withColumn("level", (F.col("total") - F.col("limit_full")) / F.col("weight_left"))
    s = s.withColumn("level", F.max("level").over(everything))
    return s.select("source", "source_size",
                    F.coalesce(F.least("limit", F.col("level") * F.col("weight")), F.col("limit")).alias("target"))


#: One meeting of the unfinished document ``s.r`` with the next document ``x``: ``v.up`` words may go to ``s.r``, ``v.down`` to ``x``.
_MEETING = """
transform(array(named_struct(
    'up', least(s.r.size - s.r.mass, x.mass), 'down', least(s.r.mass, x.size - x.mass),
    'odds', pmod(xxhash64(s.r.key, x.key, s.r.place, x.place, {seed}L), 9007199254740992L) / 9007199254740992D)),
  v -> CASE WHEN v.odds * (v.up + v.down) < v.down
    THEN named_struct('gain', v.up, 'full', s.r.size - s.r.mass <= x.mass, 'other', x.mass <= s.r.size - s.r.mass, 'rose', true)
    ELSE named_struct('gain', -v.down, 'full', s.r.mass <= x.size - x.mass, 'other', x.size - x.mass <= s.r.mass, 'rose', false) END)[0]
"""
_ITEM = "struct<place:int,key:bigint,size:bigint,mass:double>"
_FOLD = """
aggregate(items, cast(named_struct('r', null, 'done', array()) as struct<r:{item},done:array<struct<place:int,more:int>>>),
  (s, x) -> CASE WHEN s.r IS NULL THEN named_struct('r', x, 'done', s.done) ELSE
    transform(array({meeting}), m -> named_struct(
      'r', CASE WHEN m.full AND m.other THEN cast(null as {item})
                WHEN m.full THEN named_struct('place', x.place, 'key', x.key, 'size', x.size, 'mass', x.mass - m.gain)
                ELSE named_struct('place', s.r.place, 'key', s.r.key, 'size', s.r.size, 'mass', s.r.mass + m.gain) END,
      'done', concat(s.done,
        CASE WHEN m.full THEN array(named_struct('place', s.r.place, 'more', cast(m.rose as int))) ELSE array() END,
        CASE WHEN m.other THEN array(named_struct('place', x.place, 'more', cast(NOT m.rose as int))) ELSE array() END)))[0] END)
"""


def _fold(items: DataFrame, seed: int) -> DataFrame:
    """One level of the tree: blocks of ``items(rank, block, key, size, mass, row)``
    to ``(rank, block, rows, state)``.  Long documents meet first, so that what
    is left unfinished is likely short."""
    item = F.struct((-F.col("size")).alias("order"), "key", "size", "mass", "row")
    packed = items.groupBy("rank", "block").agg(F.sort_array(F.collect_list(item)).alias("rows"))
    fold = _FOLD.format(item=_ITEM, meeting=_MEETING.format(seed=seed))
    shaped = packed.withColumn("items", F.expr(
        "transform(rows, (x, i) -> named_struct('place', i, 'key', x.key, 'size', x.size, 'mass', x.mass))"))
    return shaped.select("rank", "block", "rows", F.expr(fold).alias("state"))


def _finished(level: DataFrame) -> DataFrame:
    return (level.select("rows", F.explode("state.done").alias("d"))
            .select(F.expr("get(rows, d.place).row").alias("row"), F.col("d.more").alias("more")))


def round_fractions(items: DataFrame, most: int, seed: int = SEED, fan: int = FAN) -> DataFrame:
    """``(row, more)`` for ``items(rank, of, row, key, size, mass, salt)``: ``more`` is 1
    for the rows taken once more.  ``rank`` numbers the sources, ``of`` counts
    a source's items and ``most`` is the largest ``of``; ``salt`` parts rows
    that repeat a key and size."""
    blocks = F.ceil(F.col("of") / fan).cast("bigint")
    live = items.withColumn("block", F.pmod(F.xxhash64("key", "size", "salt", F.lit(seed)), blocks))
    count, done, depth = -(-most // fan), [], 0
    while True:
        level = land(_fold(live.select("rank", "block", "key", "size", "mass", "row"), seed + depth), "mix-level")
        done.append(_finished(level))
        rest = level.where("state.r is not null").select(
            "rank", "block", F.col("state.r.key").alias("key"), F.col("state.r.size").alias("size"),
            F.col("state.r.mass").alias("mass"), F.expr("get(rows, state.r.place).row").alias("row"))
        depth += 1
        if count <= 1:
            break
        live = rest.withColumn("block", F.floor(F.col("block") / fan))
        count = -(-count // fan)
    odds = F.pmod(F.xxhash64("key", F.lit(seed + depth)), F.lit(1 << 53)) / F.lit(float(1 << 53))
    last = rest.select("row", (odds * F.col("size") < F.col("mass")).cast("int").alias("more"))
    for part in done:
        last = last.unionByName(part)
    return last


def _salted(sized: DataFrame, fan: int = FAN) -> DataFrame:
    """``sized`` with a ``salt``: the scan's number of the row where more than
    ``fan`` rows have its id and size (they would fall into one block), else 0."""
    hot = land(sized.groupBy("doc_id", "size").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > fan).select(
        F.col("doc_id").alias("_id"), F.col("size").alias("_size")), "mix-hot")
    if hot.isEmpty():
        return sized.withColumn("salt", F.lit(0).cast("bigint"))
    scan = sized.withColumn("scan", F.monotonically_increasing_id())
    joined = scan.join(hot, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("size") == F.col("_size")), "left")
    return joined.withColumn("salt", F.when(F.col("_size").isNotNull(), F.col("scan")).otherwise(F.lit(0))).drop("scan", "_id", "_size")


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
        weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, seed: int = SEED) -> DataFrame:
    """``(doc_id, source, size, source_size, target, copies)`` for every row of ``docs``."""
    sized = land(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), words(text_col).alias("size")), "mix-sizes")
    sized = _salted(sized)
    order = Window.orderBy(F.col("source").asc_nulls_last())
    counts = sized.groupBy("source").agg(F.count(F.when(F.col("size") > 0, 1)).alias("of"))
    goal = land(targets(sized, weights, share).join(counts.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")))
                .drop("_s").withColumn("rank", F.row_number().over(order)), "mix-targets")
    n_sources, most = goal.agg(F.count(F.lit(1)), F.coalesce(F.max("of"), F.lit(0))).first()
    side = F.broadcast(goal) if n_sources <= BROADCAST_SOURCES else goal
    d = sized.join(side.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    copies = F.coalesce(F.col("target") / F.nullif(F.col("source_size"), F.lit(0)), F.lit(0.0))
    d = d.select("doc_id", "source", "size", "source_size", "target", "rank", "of", "salt",
                 F.floor(copies).alias("base"), (copies - F.floor(copies)).alias("fraction"))
    # a document without words has no mass; it never meets another
    open_ = (F.col("fraction") > 0) & (F.col("size") > 0)
    row = F.struct("doc_id", "source", "size", "source_size", "target", "base")
    settled = d.where(~open_).select(row.alias("row"), F.lit(0).alias("more"))
    items = d.where(open_).select("rank", "of", row.alias("row"), F.xxhash64("doc_id", F.lit(seed)).alias("key"),
                                  "size", (F.col("size") * F.col("fraction")).alias("mass"), "salt")
    rounded = round_fractions(items, most, seed) if most else settled.limit(0)
    both = rounded.unionByName(settled)
    return both.select("row.doc_id", "row.source", "row.size", "row.source_size", "row.target",
                       (F.col("row.base") + F.col("more")).cast("bigint").alias("copies"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """``docs`` with every row repeated as often as the mix takes it.

    Rows are matched by id and their number within the id, so repeated ids
    keep their own decisions.
    """
    n = lambda *by: F.row_number().over(Window.partitionBy("id").orderBy(*by))
    decided = mix(docs, id_col, **options).select(F.col("doc_id").alias("id"), "size", "copies")
    decided = decided.select(F.col("id").alias("_id"), n("size", "copies").alias("_n"), "copies")
    rows = packed(docs, F.col(id_col).alias("id"), words(options.get("text_col", "text")).alias("size"))
    rows = rows.select("row", "id", n("size").alias("n"))
    joined = rows.join(decided, F.col("id").eqNullSafe(F.col("_id")) & (F.col("n") == F.col("_n")))
    repeated = joined.where("copies > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
    return unpacked(repeated, docs)


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix(docs).select("doc_id", "size", "source_size", "target",
                            (F.col("copies") * F.col("size")).alias("taken"), "copies")
