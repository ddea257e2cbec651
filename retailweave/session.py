"""Session settings for local runs (tests and the benchmark).

On a cluster the caller's session is used as it is: nothing in the library
sets configuration on it.
"""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the executors, once per application, for functions that run in their Python workers.

    The archive is a file of the driver, which Spark hands out to every executor.
    """
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = shutil.make_archive(f"{tempfile.mkdtemp()}/{package.name}", "zip", package.parent, package.name)
    spark.sparkContext.addPyFile(archive)
    _shipped.add(application)


def local_session(app: str, cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
