"""Run jobs while the first attempt of partition 0 of every stage fails
(local mode with task retries), and compare with runs without failures.
Invoked by test_recovery.py in its own process; prints OK on success."""

import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql.types import LongType  # noqa: E402

from cityzones.operators.joins import join_measured  # noqa: E402
from cityzones.operators.reconcile import reconcile_names  # noqa: E402
from cityzones.session import build_session  # noqa: E402


@F.udf(LongType())
def flaky(x):
    tc = TaskContext.get()
    if tc is not None and tc.partitionId() == 0 and tc.attemptNumber() == 0:
        raise RuntimeError("injected task failure")
    return x


def rows(df):
    return sorted(tuple("" if v is None else v for v in r) for r in df.collect())


def main():
    spark = build_session("local[4,3]", app="cityzones-recovery", shuffle_partitions=4,
                          default_checkpoint_dir=tempfile.mkdtemp(prefix="run-recovery-"))
    spark.sparkContext.setLogLevel("WARN")  # lost-task warnings show the injected failures
    base = spark.range(0, 4000, 1, 4).select(
        F.col("id"), F.when(F.col("id") % 4 != 0, F.lit("hot")).otherwise((F.col("id") % 9).cast("string")).alias("k"))
    small = spark.createDataFrame([("hot", "H"), ("0", "Z"), ("4", "F")], "key string, v string")
    want = rows(base.join(small, base.k == small.key, "left").select("id", "v"))
    unstable = base.withColumn("id", flaky("id"))
    got = rows(join_measured(unstable, small, ["k"], ["key"], "left").select("id", "v"))
    assert got == want, "join_measured differs under task retries"

    names = spark.range(0, 2000, 1, 4).select(
        F.concat(F.lit("sant "), F.element_at(F.array(F.lit("andreu"), F.lit("andru"), F.lit("antoni")),
                                              (F.col("id") % 3 + 1).cast("int"))).alias("raw"),
        F.col("id"))
    canon = spark.createDataFrame([(1, "Sant Andreu"), (2, "Sant Antoni")], "cid int, cname string")
    want = rows(reconcile_names(names, canon, "raw", "cid", "cname"))
    got = rows(reconcile_names(names.withColumn("id", flaky("id")), canon, "raw", "cid", "cname"))
    assert got == want, "reconcile_names differs under task retries"
    print("OK")


if __name__ == "__main__":
    main()
