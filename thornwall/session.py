"""Session settings and the shared working folder."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

from thornwall.sources.files import file_system, hadoop_path, size_in_bytes

_SHUFFLE_START = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
# What this module last set that to: a value of the caller's own is left alone.
_SHUFFLE_SET = "spark.thornwall.shuffleStart"
_MOST_PARTITIONS = 100_000

_lock = threading.Lock()
_workdirs: dict[str, str] = {}


def _bytes(size: str) -> int:
    """A size as settings have it: ``64MB``, ``8m``, ``1048576b``."""
    number, unit = re.fullmatch(r"(\d+)\s*([kmgtp]?)i?b?", size.strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def configure(spark: SparkSession, *inputs: str) -> SparkSession:
    """Set what the datasets rely on; shuffles start with as many partitions as the size of the ``inputs`` asks for.

    Source timestamps carry no zone, so every day boundary is a UTC one. A batch
    of page files is looked up in a job of up to 10,000 tasks by default, one
    per file; a few per core do it in a tenth of the time.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    cores = spark.sparkContext.defaultParallelism
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", min(10_000, 4 * cores))
    # Adaptive execution merges small shuffle partitions but does not split large ones, so start with many:
    # Parquet unfolds to several times its size, hence half of what a partition should hold.
    own = spark.conf.get(_SHUFFLE_START, None)
    if own is None or own == spark.conf.get(_SHUFFLE_SET, None):
        part = _bytes(spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes"))
        by_size = sum(size_in_bytes(spark, path) for path in inputs) // max(1, part // 2)
        start = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * cores, min(by_size, _MOST_PARTITIONS))
        spark.conf.set(_SHUFFLE_START, start)
        spark.conf.set(_SHUFFLE_SET, start)
    return spark


@contextmanager
def settings(spark: SparkSession, values: dict[str, object]):
    """Settings for the actions inside the block."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def same_settings(spark: SparkSession, but: dict[str, object]) -> SparkSession:
    """Another session of the same application, with the same settings but for the given ones."""
    other = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if other.conf.isModifiable(key) and other.conf.get(key, None) != value:
            other.conf.set(key, value)
    for key, value in but.items():
        other.conf.set(key, value)
    return other


def workdir(spark: SparkSession) -> str:
    """A folder of this application's own that all executors can reach.

    It lies below ``spark.checkpoint.dir``. Only a local session may go without
    that setting, and then leaves nothing behind: a temporary folder of one
    machine is lost, or never seen, on a cluster.
    """
    app = spark.sparkContext.applicationId
    with _lock:
        if app not in _workdirs:
            shared = spark.conf.get("spark.checkpoint.dir", None)
            if not shared:
                master = spark.sparkContext.master
                if master != "local" and not master.startswith("local["):
                    raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
                shared = tempfile.mkdtemp(prefix="thornwall-")
                atexit.register(shutil.rmtree, shared, ignore_errors=True)
            _workdirs[app] = f"{shared.rstrip('/')}/thornwall/{app}-{uuid.uuid4().hex[:8]}"
        return _workdirs[app]


def clear(spark: SparkSession) -> None:
    """Delete this application's working folder. What has not been stored elsewhere can no longer be read."""
    path = workdir(spark)
    file_system(spark, path).delete(hadoop_path(spark, path), True)
    with _lock:
        _workdirs.pop(spark.sparkContext.applicationId, None)
