"""Reliable lineage cuts in the cluster's shared checkpoint folder.

The folder is read from the session (``spark.checkpoint.dir`` or the context's
checkpoint dir).  Only a local-mode session without one (tests, laptops) gets a
fresh folder of its own; a cluster session without one is an error, because a
machine-local folder would not survive the loss of that machine.
"""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    try:
        configured = configured or spark.conf.get("spark.checkpoint.dir", None)
    except Exception:  # pragma: no cover - conf not settable at runtime
        pass
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder "
                "(HDFS/S3/…) so checkpoints survive executor loss"
            )
        configured = tempfile.mkdtemp(prefix="quire-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def cut(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Write ``df`` as a parquet table in the checkpoint folder; read it back.

    ``compression`` is a parquet codec, the session's own if not given.

    Cuts the lineage like ``checkpoint()`` but keeps columnar storage, so the
    later passes that need a few columns (counts, keys, word counts) read only
    those columns.
    """
    path = shared_path(df.sparkSession, "cut") + ".parquet"
    df.write.mode("overwrite").parquet(path, compression=compression)
    return df.sparkSession.read.parquet(path)


def shared_path(spark: SparkSession, kind: str) -> str:
    """A fresh path in the shared folder.

    What lies there is deleted at the end of the enclosing ``scratch`` block,
    or else when the process ends, as lazy results may still read it.
    """
    path = f"{checkpoint_dir(spark).rstrip('/')}/quire-{kind}-{uuid.uuid4().hex}"
    for p in (path, path + ".parquet"):
        if _SCOPES:
            _SCOPES[-1].append(p)
        else:
            if not _LEFT:
                atexit.register(delete_left)
            _LEFT.append((spark, p))
    return path


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a written table is (still) there."""
    hp = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return hp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hp)


_SCOPES: list[list[str]] = []
#: Tables that lazy results may still read; they go when the process ends.
_LEFT: list[tuple[SparkSession, str]] = []


def _delete(spark: SparkSession, paths: list[str]) -> None:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        hp.getFileSystem(conf).delete(hp, True)


def delete_left() -> None:
    """Delete the tables cut outside ``scratch``; results that read them are void then."""
    while _LEFT:
        spark, path = _LEFT.pop()
        with contextlib.suppress(Exception):  # the session may be gone
            _delete(spark, [path])


@contextlib.contextmanager
def scratch(spark: SparkSession):
    """Delete the tables cut inside the block once it finishes.

    For jobs that write their result before leaving the block; a DataFrame
    returned out of the block must not read a cut table.  Deletion goes
    through the Hadoop FileSystem of each path, so it works on any shared
    store the checkpoint folder lives on.
    """
    paths: list[str] = []
    _SCOPES.append(paths)
    try:
        yield paths
    finally:
        _SCOPES.remove(paths)
        _delete(spark, paths)
