"""Session helpers: build a session for tests/bench, and find the shared folder.

Library code never builds its own session; every operator takes DataFrames.
These helpers are for the entry points (tests, bench, the Part 3 pipeline).
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def get_session(master: str | None = "local[8]", shuffle_partitions: int = 8,
                app_name: str = "claimlens", driver_memory: str | None = "8g",
                advisory_partition_bytes: str = "128m") -> SparkSession:
    """Session for local runs, or (``master=None``) for spark-submit on a
    cluster, where the submit command's master and memory settings apply.

    AQE stays on: shuffle partitions start at ``shuffle_partitions`` (on a
    cluster, size it to the largest shuffle / ``advisory_partition_bytes``)
    and are coalesced at runtime; skewed join partitions are split. The UI
    stays off (no server is opened).
    """
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    if driver_memory is not None and master is not None and master.startswith("local"):
        builder = builder.config("spark.driver.memory", driver_memory)
    builder = (
        builder
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", advisory_partition_bytes)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_FALLBACK: dict[tuple, str] = {}


def session_key(spark: SparkSession) -> tuple:
    """Identity of a running session: object id plus application id (an id
    alone can be reused by a later session after the first one stops)."""
    return id(spark), spark.conf.get("spark.app.id", None)


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session. Only when it is unset and the session runs in one
    process (master ``local``, as in tests) is a private folder under the
    system temp dir created and registered; a cluster whose executors do not
    share that folder raises instead.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        return conf_dir
    try:  # a classic session may have had setCheckpointDir called directly
        current = spark.sparkContext.getCheckpointDir()
    except Exception:  # e.g. a Spark Connect session: no SparkContext
        current = None
    if current:
        return current
    master = spark.conf.get("spark.master", "")
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share "
                           f"(master {master!r} has no local default)")
    key = session_key(spark)
    if key not in _FALLBACK:
        _FALLBACK[key] = tempfile.mkdtemp(prefix="claimlens-ckpt-")
        try:
            spark.sparkContext.setCheckpointDir(_FALLBACK[key])
        except Exception:
            pass
    return _FALLBACK[key]


_MADE: dict[tuple, list[str]] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder for one written table."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    _MADE.setdefault(session_key(spark), []).append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete the scratch tables made inside the ``with`` block at its end.

    For runs whose results are written or collected before the block ends;
    DataFrames that still read a scratch table must not outlive it.
    """
    made = _MADE.setdefault(session_key(spark), [])
    before = len(made)
    try:
        yield
    finally:
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for path in made[before:]:
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(conf).delete(p, True)
        del made[before:]
