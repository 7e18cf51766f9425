"""Spark session settings and the shared working folder.

Nothing here names a master: on a cluster ``spark-submit`` does, in tests
the caller passes one.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# One shuffle partition should hold about this much input.
TARGET_PARTITION_BYTES = 128 * 1024 * 1024

BASE_CONF = {
    # Reference timestamps are UTC; bad casts must fail rather than turn NULL.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Runtime re-planning: merge small partitions, split skewed join sides.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs one more exchange above it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.ui.enabled": "false",
}


def shuffle_partitions_for(input_bytes: int, floor: int = 8) -> int:
    """Shuffle partitions needed for ``input_bytes`` of shuffled data."""
    return max(floor, -(-int(input_bytes) // TARGET_PARTITION_BYTES))


def get_session(
    app: str = "cardamom",
    master: str | None = None,
    shuffle_bytes: int | None = None,
    **conf: str,
) -> SparkSession:
    """Build or fetch a session.

    ``shuffle_bytes`` is the size of the largest shuffle expected.  AQE starts
    from that many partitions and merges the ones that turn out small, so one
    setting serves both a few megabytes and many terabytes.  Without it, and
    unless ``spark-submit`` or ``conf`` names a number, shuffles start from two
    partitions for every core of the cluster, 200 at least, and AQE merges them
    up to ``TARGET_PARTITION_BYTES`` each.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(BASE_CONF)
    if shuffle_bytes is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions_for(shuffle_bytes))
    settings.update(conf)
    settings.setdefault("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(TARGET_PARTITION_BYTES))
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    given = "spark.sql.shuffle.partitions"
    if given not in settings and spark.sparkContext.getConf().get(given) is None:
        spark.conf.set(given, max(200, 2 * spark.sparkContext.defaultParallelism))
    return spark


_LOCAL_ROOTS: dict[str, str] = {}
_MADE: list[str] = []
_NAMESPACES: list[str] = []


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path in the folder that every executor can reach.

    The cluster names that folder in ``spark.checkpoint.dir``.  Only a local
    session, whose one machine is the whole cluster, may do without.  What is
    written there is scratch: it goes when the driver's program ends, or
    earlier with :func:`drop_scratch`.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        app = spark.sparkContext.applicationId
        if app not in _LOCAL_ROOTS:
            _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="cardamom-")
        root = _LOCAL_ROOTS[app]
    if not _MADE:
        atexit.register(_drop_all)
    _MADE.append(f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}")
    return _MADE[-1]


def scratch_namespace(spark: SparkSession, label: str) -> str:
    """A new namespace for catalog tables that are scratch; they lie in the shared folder.

    Its name and folder are used once, so neither another call, nor another
    program, nor files that an earlier one left behind are in the way.  It goes
    with its tables when the driver's program ends.
    """
    name = f"{label}_{uuid.uuid4().hex}"
    place = shared_dir(spark, label).replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE DATABASE `{name}` LOCATION '{place}'")
    _NAMESPACES.append(name)
    return name


def scratch(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back: its lineage ends there."""
    path = shared_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch_space(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """``with scratch_space(spark) as keep``: what ``keep(df, label)`` writes goes at the end of the block."""
    made = []

    def keep(df: DataFrame, label: str) -> DataFrame:
        path = shared_dir(spark, label)
        made.append(path)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    try:
        yield keep
    finally:
        for path in made:
            drop_scratch(spark, path)


def path_exists(spark: SparkSession, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through the file system it is on."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete a path that :func:`shared_dir` gave out, once nothing reads it any more."""
    if path in _MADE:
        _MADE.remove(path)
        delete_path(spark, path)


def _drop_all() -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None:
        while _NAMESPACES:
            try:
                spark.sql(f"DROP DATABASE IF EXISTS `{_NAMESPACES.pop()}` CASCADE")
            except Exception:  # as below
                break
        for path in list(_MADE):
            try:
                drop_scratch(spark, path)
            except Exception:  # the session may have ended before the program
                break
    for root in _LOCAL_ROOTS.values():
        shutil.rmtree(root, ignore_errors=True)
