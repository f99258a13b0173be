"""Tables that are replaced in one step.

A table is a folder; every write of it is a version folder inside. The marker file
in a version is created when all of it is written: that single file is what switches
readers over, so there is no moment without a readable table, and a job that fails
midway changes nothing. It needs no rename, so object stores will do.

The version before the current one is kept: a query may replace the table it reads,
and DataFrames made before a replacement can still be evaluated after it. One writer
at a time. Version folders start with ``_``, which plain readers of the folder skip.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_VERSION = "_v"
_MARKER = "_COMMITTED"


def _folder(spark: SparkSession, path: str):
    """(file system, Hadoop path, their package)."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    at = hadoop.Path(path)
    return at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), at, hadoop


def _versions(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    """(name, committed) of the versions, oldest first."""
    fs, at, hadoop = _folder(spark, path)
    if not fs.exists(at):
        return []
    names = sorted(s.getPath().getName() for s in fs.listStatus(at))
    return [(n, fs.exists(hadoop.Path(at, f"{n}/{_MARKER}"))) for n in names if n.startswith(_VERSION)]


def current(spark: SparkSession, path: str) -> str:
    """The folder to read: the newest committed version, or ``path`` itself if the
    table was written as plain files."""
    done = [n for n, committed in _versions(spark, path) if committed]
    return f"{path.rstrip('/')}/{done[-1]}" if done else path


def replace(df: DataFrame, path: str, keep: int = 2) -> None:
    """Write ``df`` as the new version of the table and drop all but the last
    ``keep`` committed versions (and what failed writes left)."""
    spark = df.sparkSession
    fs, at, hadoop = _folder(spark, path)
    before = _versions(spark, path)
    number = 1 + max((int(n[len(_VERSION):].split("-")[0]) for n, _ in before), default=0)
    name = f"{_VERSION}{number:08d}-{uuid.uuid4().hex[:8]}"
    df.write.mode("error").parquet(f"{path.rstrip('/')}/{name}")
    fs.create(hadoop.Path(at, f"{name}/{_MARKER}"), False).close()

    done = [n for n, committed in before if committed] + [name]
    old = {n for n, committed in before if not committed} | set(done[:-keep])
    if len(done) > keep:    # plain files of before count as the oldest version
        old |= {s.getPath().getName() for s in fs.listStatus(at) if not s.getPath().getName().startswith("_")}
    for n in old:
        fs.delete(hadoop.Path(at, n), True)
