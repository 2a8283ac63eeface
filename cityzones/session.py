"""Session helpers and shared scratch space.

Scratch output (sink round trips, model directories, lineage cuts) always goes
below the cluster's shared checkpoint folder (``spark.checkpoint.dir``), never
a machine-local temporary folder.  A session that has no such folder (a unit
test) gets one only when the caller passes ``default_checkpoint_dir``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job of this library relies on.  AQE re-plans joins from the
# measured shuffle sizes (runtime broadcast, partition coalescing, skew-join
# splitting), which is what keeps the plans sane at very different scales.
BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


_GIVEN: list[str] = []  # scratch folders of this process, oldest first


def build_session(
    master: str | None = None,
    app: str = "cityzones",
    shuffle_partitions: int | None = None,
    default_checkpoint_dir: str | None = None,
    conf: dict | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the library's base settings."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(BASE_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark, default_checkpoint_dir)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, default: str | None = None) -> str:
    """Return the session's reliable checkpoint folder.

    The folder named by ``spark.checkpoint.dir`` wins, then ``default``.  A
    local-mode session without either uses a folder below its warehouse; on a
    cluster that might be the driver's own disk, so there a shared folder must
    be named."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or default
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        configured = f"{warehouse.rstrip('/')}/_checkpoints"
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark)
    _GIVEN.append(f"{root.rstrip('/')}/cityzones-scratch/{name}-{uuid.uuid4().hex[:12]}")
    return _GIVEN[-1]


def scratch_mark() -> int:
    """How many scratch folders were given out so far (for ``clear_scratch``)."""
    return len(_GIVEN)


def clear_scratch(spark: SparkSession, since: int = 0) -> None:
    """Remove the scratch folders given out after ``since``; call it when no
    result that reads them is used any more."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for name in _GIVEN[since:]:
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(conf).delete(path, True)
    del _GIVEN[since:]


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet below the scratch folder and read it back.

    Survives lost executors like a checkpoint, is computed once however often
    it is used, and gives the planner the measured size of a join side."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` into the reliable checkpoint folder and cut its lineage.

    Reliable checkpoints survive executor loss (unlike local checkpoints)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
