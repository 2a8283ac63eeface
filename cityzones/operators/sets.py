"""Set operators."""

from __future__ import annotations

from functools import reduce
from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

# Some 600 bytes a row in an aggregate, which is there twice (partial and final).
ROWS_PER_TASK = 100_000
# A split of at most 128 MB (``spark.sql.files.maxPartitionBytes``) has about a million lines.
TASKS_PER_SPLIT = 8
# Places for the rows of one folder, by their hash, before these are cut into tasks.
HASHES = 1 << 30


def dedupe(df: DataFrame, tasks: int | None = None) -> DataFrame:
    """Distinct over whole rows, nested structs included.

    Planned as a partial (map-side) aggregate then a final one, so a group of
    copies that holds a large share of all rows is combined inside each map
    task before the shuffle and cannot swamp a single reducer.

    ``tasks``: rows are dealt over that many tasks first and compared only
    there.  For wide rows that seldom repeat: a task then holds its share of
    the distinct rows, however large an input split is and whatever
    ``spark.sql.shuffle.partitions`` says.  Copies of one row meet in one task,
    which keeps one of them.  Columns holding floats do not count for the
    dealing (-0.0 equals 0.0); without any other column ``tasks`` is ignored."""
    by = [f.name for f in df.schema if not _holds_floats(f.dataType)]
    if tasks is None or not by:
        return df.distinct()
    return df.repartition(max(2, tasks), *[df[c] for c in by]).distinct()


def dedupe_grouped(df: DataFrame, grouped_by: list[str]) -> DataFrame:
    """``dedupe`` whose tasks can write a table partitioned by ``grouped_by`` without a shuffle of their own.

    Rows are counted per value of these columns (one more pass over ``df``; the counts, one for each folder of the
    table, pass through the driver).  They then lie in one line, value by value and by hash within a value, which is
    cut into tasks of ``ROWS_PER_TASK``: a value holding a large share of the rows is spread over many tasks, small
    ones share a task, and copies of one row meet."""
    by = [f.name for f in df.schema if not _holds_floats(f.dataType)] or grouped_by
    found = df.groupBy(*grouped_by).agg(F.count(F.lit(1)).alias("_rows")).collect()
    before = [0, *accumulate(r["_rows"] for r in found)]
    tasks = max(1, -(-before[-1] // ROWS_PER_TASK))
    keys = [f"_key{i}" for i in range(len(grouped_by))]
    types = [df.schema[c].dataType.simpleString() for c in grouped_by]
    places = df.sparkSession.createDataFrame(
        [(*r[:-1], start, r["_rows"]) for r, start in zip(found, before)],
        ", ".join(f"{k} {t}" for k, t in zip(keys, types)) + ", _start long, _rows long")
    same = reduce(lambda a, b: a & b, [df[c].eqNullSafe(places[k]) for c, k in zip(grouped_by, keys)])
    place = F.col("_start") + F.col("_rows") * F.pmod(F.hash(*[df[c] for c in by]), F.lit(HASHES)) / HASHES
    task = F.coalesce(F.floor(place * tasks / max(1, before[-1])), F.lit(0)).cast("int")
    dealt = df.join(F.broadcast(places), same, "left").select(*[df[c] for c in df.columns], task.alias("_task"))
    return dealt.repartitionById(tasks, "_task").distinct().drop("_task")


def _holds_floats(kind: DataType) -> bool:
    return any(name in kind.simpleString() for name in ("double", "float"))


def tasks_for_rows(rows: int) -> int:
    """Tasks for ``dedupe`` over ``rows`` wide rows: at least one per core."""
    return max(SparkSession.active().sparkContext.defaultParallelism, -(-rows // ROWS_PER_TASK))


def tasks_for_splits(raw: DataFrame) -> int:
    """Tasks for ``dedupe`` over text files: a few for each split of them.

    Counting would parse the files; this only plans ``raw`` (and runs what it shuffles or broadcasts)."""
    return max(raw.sparkSession.sparkContext.defaultParallelism, TASKS_PER_SPLIT * raw.rdd.getNumPartitions())


def union_all(frames: list[DataFrame], tag_col: str | None = None) -> DataFrame:
    """Union by column name; optionally tag each row with its input position."""
    if tag_col:
        frames = [f.withColumn(tag_col, F.lit(i)) for i, f in enumerate(frames)]
    return reduce(lambda a, b: a.unionByName(b), frames)
