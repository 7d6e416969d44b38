"""Building blocks that keep the operators exact when tables, groups and keys get very large.

Rules shared by the whole package:

* a table is broadcast only after its size was counted, or when it is a literal of this repository;
* statistics that Spark keeps whole in one task (exact percentiles, unpartitioned windows) take a distributed method,
  the same one at every size;
* lineage is cut only through files in the shared checkpoint folder, so a lost executor costs a re-read.
"""

from __future__ import annotations

import math
import tempfile
import threading
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20
HOT_SHARE = 0.01
_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_freeing, _freeing_lock = [0], threading.Lock()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="acrewise-checkpoint-")
    sc.setCheckpointDir(configured)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder name next to the checkpoints, where every executor can write."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Materialise ``df`` once in the shared folder and cut its lineage.

    As parquet: a reliable checkpoint would compute the plan twice, once to run it and once to write it.
    """
    return stage(df, "settled")


def _file_system(spark: SparkSession, folder: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, folder: str) -> bool:
    files, path = _file_system(spark, folder)
    return files.exists(path)


def release(spark: SparkSession) -> None:
    """Delete what this application has stored next to its checkpoints; results that still read it become unusable."""
    folder = spark.sparkContext.getCheckpointDir()
    if folder is not None:
        files, path = _file_system(spark, folder)
        files.delete(path, True)


@contextmanager
def _freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the writes inside are deleted when their rows are stored, not when the driver next collects garbage.

    Writes of several threads share the setting; the last one to end takes it back.
    """
    with _freeing_lock:
        _freeing[0] += 1
        spark.conf.set(_CLEAN_UP, "true")
    try:
        yield
    finally:
        with _freeing_lock:
            _freeing[0] -= 1
            if not _freeing[0]:
                spark.conf.unset(_CLEAN_UP)


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write a row-sized intermediate table once as parquet in the shared folder and read it back.

    Used where several passes follow: each of them then reads only the columns it needs, with filters pushed
    into the scan, instead of repeating the parsing and joins before it. The shuffle files of the write do not outlive it.
    """
    path = shared_folder(df.sparkSession, name)
    with _freed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete what staged ``tables`` read from the shared folder before :func:`release` does; nothing may read it any more."""
    for df in tables:
        spark = df.sparkSession
        # the last part of the checkpoint folder is unique to the application
        own = f"/{(spark.sparkContext.getCheckpointDir() or '').rsplit('/', 1)[-1]}/"
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles() if own in f}:
            files, path = _file_system(spark, folder)
            files.delete(path, True)


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """True when ``df`` is within both limits; looks at no more than ``max_rows + 1`` of its rows."""
    width = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    rows, size = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.sum(width)).first()
    return rows <= max_rows and (size or 0) <= max_bytes


def hot_keys(df: DataFrame, keys: Sequence[str], share: float = HOT_SHARE, sample: float = 0.02) -> DataFrame | None:
    """Keys that hold more than about ``share`` of the rows, at most ``1 / share`` of them, with the number of ``__salts``
    that deals a key into parts of about half a mean partition; None if there are none.

    Found on a sample: a key that is missed or added changes how work is spread, never a result.
    """
    spark = df.sparkSession
    seen = df.select(*keys).sample(sample, 17).groupBy(*keys).count()
    total = seen.agg(F.sum("count")).first()[0] or 0
    parts = F.ceil(2 * F.col("count") / max(total, 1) * int(spark.conf.get("spark.sql.shuffle.partitions"))) + 1
    found = seen.where(F.col("count") > max(share * total, 10)).select(*keys, parts.cast("int").alias("__salts")).collect()
    schema = T.StructType([*df.select(*keys).schema.fields, T.StructField("__salts", T.IntegerType())])
    return spark.createDataFrame(found, schema) if found else None


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    null_safe: bool = False,
    max_rows: int | None = None,
) -> DataFrame:
    """Join a large ``left`` to per-key ``right`` rows without letting a hot key pile up in one task.

    ``right`` is settled and measured first. Up to ``max_rows`` rows (and a byte limit) it is broadcast and ``left`` is not
    shuffled at all; beyond that the rows of hot keys are salted on the left and copied on the right, so a
    key that holds a third of ``left`` spreads over as many tasks as its share asks for.
    """
    max_rows = BROADCAST_ROWS if max_rows is None else max_rows
    on = list(on)
    other = {c: f"__r_{c}" for c in on}
    small = settle(right)

    def matches(lhs: DataFrame, rhs_names: dict[str, str], nulls: bool = null_safe) -> Column:
        cond = F.lit(True)
        for c, name in rhs_names.items():
            pair = lhs[c].eqNullSafe(F.col(name)) if nulls else lhs[c] == F.col(name)
            cond = cond & pair
        return cond

    if fits_broadcast(small, max_rows):
        lookup = small.withColumnsRenamed(other)
        return left.join(F.broadcast(lookup), matches(left, other), how).drop(*other.values())
    hot = hot_keys(left, on)
    if hot is None:
        # the hint keeps the planner from broadcasting by an estimate what was counted as too large
        lookup = small.withColumnsRenamed(other).hint("merge")
        return left.join(lookup, matches(left, other), how).drop(*other.values())

    # at most 1 / HOT_SHARE hot keys, so marking them is a broadcast join
    marks = F.broadcast(hot.withColumnsRenamed({c: f"__h_{c}" for c in on}))
    mark_names = {c: f"__h_{c}" for c in on}

    def marked(df: DataFrame) -> DataFrame:
        # null-safe, so that a large group of missing keys is spread as well
        return df.join(marks, matches(df, mark_names, nulls=True), "left").drop(*mark_names.values())

    hashable = [F.col(f"`{c}`") for c, t in left.dtypes if "map<" not in t]
    hot_key = F.col("__salts").isNotNull()
    spread = F.when(hot_key, F.pmod(F.xxhash64(*hashable), F.col("__salts")).cast("int")).otherwise(0)
    salted = marked(left).withColumn("__salt", spread).drop("__salts")
    every = F.when(hot_key, F.sequence(F.lit(0), F.col("__salts") - 1)).otherwise(F.array(F.lit(0)))
    copies = marked(small).withColumn("__r_salt", F.explode(every)).drop("__salts").withColumnsRenamed(other).hint("merge")
    cond = matches(salted, other) & (F.col("__salt") == F.col("__r_salt"))
    return salted.join(copies, cond, how).drop("__salt", "__r_salt", *other.values())


def first_per_key(df: DataFrame, keys: Sequence[Column | str], order: Sequence[Column | str]) -> DataFrame:
    """Keep the first row of every key in ``order``; NULL keys compare equal.

    A ``min_by`` aggregate instead of a ranking window: each map task sends one row per key, so a key that
    holds a third of the table is no heavier than any other.
    """
    order_key = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order])
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    by = [(F.col(k) if isinstance(k, str) else k).alias(f"__k{i}") for i, k in enumerate(keys)]
    return df.groupBy(*by).agg(F.min_by(row, order_key).alias("__row")).select("__row.*")


def running_sum(
    df: DataFrame, value: str, order: Sequence[str], out: str, by: Sequence[str] = ()
) -> DataFrame:
    """Inclusive running total of ``value`` in ``order`` (per ``by`` group), without a one-task window.

    Rows are range-partitioned by (by, order) and settled, so each row's range number is a stored fact.
    The window runs inside each range; the totals of earlier ranges (one row per range and group) are added.
    """
    by = list(by)
    ranged = settle(df.repartitionByRange(*by, *order).withColumn("__range", F.spark_partition_id()))
    totals = ranged.groupBy(*by, "__range").agg(F.sum(value).alias("__total"))
    # one row per (group, range) is left, so this window is bounded by the number of ranges
    before = Window.partitionBy(*(by or [F.lit(0)])).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*by, "__range", F.coalesce(F.sum("__total").over(before), F.lit(0)).alias("__offset"))
    inside = Window.partitionBy(*by, "__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    joined = lookup_join(ranged, offsets, [*by, "__range"], how="inner", null_safe=True)
    return joined.withColumn(out, F.col("__offset") + F.sum(value).over(inside)).drop("__range", "__offset")


def dense_index(df: DataFrame, order: Sequence[str], out: str) -> DataFrame:
    """Number rows 0..n-1 in ``order`` (``order`` must identify a row).

    Rows are range-partitioned, sorted and stored once with their partition and place in it; the rows of earlier partitions are
    added, so whole rows are shuffled once.
    """
    # the high bits of the increasing id are the partition, the low 33 the place in it
    placed = settle(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id()))
    part = F.shiftright("__at", 33).cast("int")
    sizes = placed.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    # one row per partition
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    numbered = lookup_join(placed.withColumn("__part", part), offsets, ["__part"], how="inner")
    place = F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    return numbered.withColumn(out, F.col("__before") + place).drop("__at", "__part", "__before")


def distinct_rows(df: DataFrame) -> DataFrame:
    """Rows equal in all columns once. ``df`` is read twice; only rows whose hash another row has too are shuffled whole."""
    marked = df.withColumn("__mark", F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    twice = settle(marked.groupBy("__mark").agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select("__mark"))
    if twice.isEmpty():
        return df
    once = lookup_join(marked, twice, ["__mark"], how="left_anti")
    return once.unionByName(lookup_join(marked, twice, ["__mark"], how="left_semi").distinct()).drop("__mark")


def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Exact linear-interpolation quantiles: one row per group, each column an array in ``probs`` order.

    NULL group keys form a group; a group or column without values gives NULL. One path for every size:

    1. a mergeable sketch brackets the wanted ranks of every (group, column);
    2. rows below each bracket are counted, values inside are kept with their counts (a thousandth of a large group),
       and a running count over them finds the value of each rank.

    The counts prove that a rank lies inside its bracket; if one does not, the brackets are widened, at last to the whole range.
    """
    by, cols, probs = list(by), list(cols), [float(p) for p in probs]
    if not by:
        found = _whole_quantiles(df, cols, probs)
        schema = T.StructType([T.StructField(c, T.ArrayType(T.DoubleType())) for c in cols])
        return df.sparkSession.createDataFrame([tuple(found[c] for c in cols)], schema)
    keys = [*by, "__col"]
    long = df.select(
        *by,
        F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("double").alias("v")) for c in cols])).alias("__e"),
    ).select(*by, F.col("__e.c").alias("__col"), F.col("__e.v").alias("__v"))

    # a wanted quantile is the mix of the values at two neighbouring ranks
    targets = [(i, p, side) for i, p in enumerate(probs) for side in (0, 1)]
    slack = 0.0005
    while True:
        marks = [x for _, p, _ in targets for x in (max(p - slack, 0.0), min(p + slack, 1.0))]
        sketch = long.groupBy(*keys).agg(
            F.count("__v").alias("__n"),
            F.min("__v").alias("__min"),
            F.max("__v").alias("__max"),
            F.percentile_approx("__v", F.array(*[F.lit(m) for m in marks]), F.lit(10_000)).alias("__q"),
        )
        brackets = []
        for t, (_, p, side) in enumerate(targets):
            h = F.lit(p) * (F.col("__n") - 1)
            rank = F.floor(h) if side == 0 else F.ceil(h)
            low = F.col("__min") if p - slack <= 0 else F.col("__q")[2 * t]
            high = F.col("__max") if p + slack >= 1 else F.col("__q")[2 * t + 1]
            parts = (F.lit(t).alias("t"), rank.cast("long").alias("rank"), low.alias("lo"), high.alias("hi"))
            brackets.append(F.struct(*parts))
        sketch = settle(sketch.select(*keys, "__n", F.array(*brackets).alias("__b")))
        wanted = sketch.where("__n > 0").select(*keys, "__b")
        tagged = lookup_join(long.where("__v is not null"), wanted, keys, how="inner", null_safe=True)
        # a value below the bracket is counted under NULL, which comes first in the running count
        cells = (
            tagged.select(*keys, "__v", F.explode(F.filter("__b", lambda b: F.col("__v") <= b["hi"])).alias("b"))
            .select(*keys, "b.t", "b.rank", F.when(F.col("__v") >= F.col("b.lo"), F.col("__v")).alias("__v"))
            .groupBy(*keys, "t", "rank", "__v")
            .agg(F.count(F.lit(1)).alias("__c"))
        )
        upto = Window.partitionBy(*keys, "t").orderBy(F.asc_nulls_first("__v")).rowsBetween(Window.unboundedPreceding, 0)
        reached = cells.withColumn("__upto", F.sum("__c").over(upto)).where(F.col("__upto") > F.col("rank"))
        first = reached.groupBy(*keys, "t").agg(F.min_by("__v", "__upto").alias("__v"))
        by_rank = settle(
            first.groupBy(*keys).agg(
                *[F.max(F.when(F.col("t") == t, F.col("__v"))).alias(f"__v{t}") for t in range(len(targets))],
                F.count("__v").alias("__found"),
            )
        )
        # a rank below or above its bracket has no value yet
        missing = wanted.count() * len(targets) - (by_rank.agg(F.sum("__found")).first()[0] or 0)
        if missing == 0 or slack >= 1:
            break
        slack *= 16
    wide = lookup_join(sketch.select(*keys, "__n"), by_rank.drop("__found"), keys, how="left", null_safe=True)
    mixed = []
    for i, p in enumerate(probs):
        h = F.lit(p) * (F.col("__n") - 1)
        lo, hi = F.col(f"__v{2 * i}"), F.col(f"__v{2 * i + 1}")
        mixed.append(F.when(lo == hi, lo).otherwise((F.ceil(h) - h) * lo + (h - F.floor(h)) * hi))
    per_col = wide.select(*keys, F.when(F.col("__n") > 0, F.array(*mixed)).alias("__out"))
    return per_col.groupBy(*by).agg(*[F.max(F.when(F.col("__col") == c, F.col("__out"))).alias(c) for c in cols])


def _whole_quantiles(df: DataFrame, cols: list[str], probs: list[float]) -> dict[str, list[float] | None]:
    """:func:`quantiles` of a whole table, whose brackets are a few numbers and so literals.

    The sketch is one aggregate without a row per cell. In the second pass a cell becomes one (column, zone, value): zones number
    the stretches between the ends of the brackets in order, and the value is kept inside brackets only, so a value is
    counted once however many quantiles are wanted.
    """
    values = df.select(*[F.col(c).cast("double").alias(f"__v{i}") for i, c in enumerate(cols)])
    out: dict[str, list[float] | None] = {}
    left, slack = list(range(len(cols))), 0.0005
    while left:
        marks = [x for p in probs for x in (max(p - slack, 0.0), min(p + slack, 1.0))]
        sketch = F.array(*[F.lit(m) for m in marks])
        row = values.agg(
            *[
                f.alias(f"{name}{i}")
                for i in left
                for v in [F.col(f"__v{i}")]
                for name, f in (("n", F.count(v)), ("min", F.min(v)), ("max", F.max(v)), ("q", F.percentile_approx(v, sketch, F.lit(10_000))))
            ]
        ).first()
        out |= {cols[i]: None for i in left if not row[f"n{i}"]}
        left = [i for i in left if row[f"n{i}"]]
        if not left:
            break
        cells = []
        for i in left:
            v, q = F.col(f"__v{i}"), row[f"q{i}"]
            low = [row[f"min{i}"] if p - slack <= 0 else q[2 * j] for j, p in enumerate(probs)]
            high = [row[f"max{i}"] if p + slack >= 1 else q[2 * j + 1] for j, p in enumerate(probs)]
            # a few ends are compared one by one; compiled code for many would be too long for the JVM to optimise
            if len(probs) <= 4:
                begun = sum(((v >= F.lit(x)).cast("int") for x in low), F.lit(0))
                ended = sum(((v > F.lit(x)).cast("int") for x in high), F.lit(0))
            else:
                begun = F.size(F.filter(F.array(*[F.lit(x) for x in low]), lambda x: v >= x))  # noqa: B023
                ended = F.size(F.filter(F.array(*[F.lit(x) for x in high]), lambda x: v > x))  # noqa: B023
            cells.append(F.struct(F.lit(i).alias("i"), v.alias("v"), begun.alias("begun"), ended.alias("ended")))
        inside = F.when(F.col("e.begun") > F.col("e.ended"), F.col("e.v"))
        counted = stage(
            values.select(F.explode(F.array(*cells)).alias("e")).where("e.v is not null")
            .select(F.col("e.i").alias("i"), (F.col("e.begun") + F.col("e.ended")).alias("zone"), inside.alias("v"))
            .groupBy("i", "zone", "v").agg(F.count(F.lit(1)).alias("c")),
            "cells",
        )
        zones = counted.groupBy("i", "zone").agg(F.sum("c").alias("n"), F.count("v").alias("kept")).orderBy("i", "zone").collect()
        missed, wanted = set(), set()
        for i in left:
            for p in probs:
                h = p * (row[f"n{i}"] - 1)
                for rank in (math.floor(h), math.ceil(h)):
                    before = 0
                    for z in (z for z in zones if z["i"] == i):
                        if rank < before + z["n"]:
                            break
                        before += z["n"]
                    if z["kept"]:
                        wanted.add((i, z["zone"], rank - before, rank))
                    else:
                        missed.add(i)
        at = {}
        if wanted:
            asked = df.sparkSession.createDataFrame(sorted(wanted), "i int, zone int, at long, rank long")
            upto = Window.partitionBy("i", "zone").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
            run = counted.where("v is not null").withColumn("upto", F.sum("c").over(upto))
            hit = run.join(F.broadcast(asked), ["i", "zone"]).where("at < upto and at >= upto - c")
            at = {(r["i"], r["rank"]): r["v"] for r in hit.select("i", "rank", "v").collect()}
        for i in (i for i in left if i not in missed):
            mixed = []
            for p in probs:
                h = p * (row[f"n{i}"] - 1)
                lo, hi = at[i, math.floor(h)], at[i, math.ceil(h)]
                # the same value twice, not a number included, is not mixed
                same = lo == hi or (math.isnan(lo) and math.isnan(hi))
                mixed.append(lo if same else (math.ceil(h) - h) * lo + (h - math.floor(h)) * hi)
            out[cols[i]] = mixed
        left, slack = [i for i in left if i in missed], slack * 16
    return out


def quantile_values(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> dict[str, list[float | None]]:
    """Ungrouped quantiles as driver scalars (a single row of ``len(cols) * len(probs)`` numbers)."""
    found = _whole_quantiles(df, list(cols), [float(p) for p in probs])
    return {c: found[c] or [None] * len(probs) for c in cols}


def medians(df: DataFrame, cols: Sequence[str]) -> dict[str, float | None]:
    return {c: v[0] for c, v in quantile_values(df, cols, [0.5]).items()}


def group_medians(df: DataFrame, cols: dict[str, str], by: Sequence[str]) -> DataFrame:
    """Per-group exact medians; ``cols`` maps output name to input column."""
    found = quantiles(df.select(*by, *[F.col(c).alias(out) for out, c in cols.items()]), list(cols), [0.5], by)
    return found.withColumns({out: F.col(out)[0] for out in cols})
