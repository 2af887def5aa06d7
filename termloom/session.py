"""Session settings for this library's plans."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # a recording is one row; a few long ones must not share a Python batch
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


def session(app: str = "termloom", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for k, v in (SETTINGS | conf).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Give executors this package, unless PYTHONPATH names its folder (then they are taken to have it)."""
    import os
    import shutil
    import tempfile

    package = os.path.dirname(os.path.abspath(__file__))
    above = os.path.dirname(package)
    if above in map(os.path.abspath, filter(None, os.environ.get("PYTHONPATH", "").split(os.pathsep))) or getattr(spark.sparkContext, "_termloom", False):
        return
    with tempfile.TemporaryDirectory() as d:
        root = os.path.join(d, "package")
        shutil.copytree(package, os.path.join(root, "termloom"), ignore=shutil.ignore_patterns("__pycache__"))
        # Spark serves the archive for as long as the application runs
        spark.sparkContext.addPyFile(shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="termloom-"), "termloom"), "zip", root))
    spark.sparkContext._termloom = True
