"""Session defaults for the jobs (a cluster session keeps its own settings)."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..sources.checkpoint import checkpoint_dir

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.showConsoleProgress": "false",
    # Arrow batches to Python are byte-capped, so a batch of long books stays
    # bounded; the row cap only matters for short rows.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 << 20),
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "quire") -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = (b.master(master).config("spark.ui.enabled", "false")
             .config("spark.driver.memory", "8g"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in DEFAULTS.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED_KEY = "spark.quire.shipped"


def ship_package(spark: SparkSession) -> None:
    """Make ``quire`` importable in local-mode Python workers.

    Local sessions (tests, bench, the driver's checks) get a zip of the
    package through ``addPyFile``.  On a cluster the package is deployed the
    usual way (``spark-submit --py-files quire.zip``), so nothing is written
    to a machine-local folder there.  Idempotent per session.
    """
    import os
    import tempfile
    import zipfile

    if not spark.sparkContext.master.startswith("local"):
        return
    if spark.conf.get(_SHIPPED_KEY, "false") == "true":
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    base = os.path.dirname(root)
    fd, path = tempfile.mkstemp(prefix="quire-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w") as z:
        for d, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, base))
    spark.sparkContext.addPyFile(path)
    spark.conf.set(_SHIPPED_KEY, "true")
