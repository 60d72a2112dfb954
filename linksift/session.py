"""Session settings shared by jobs, tests and the bench."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", app: str = "linksift", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benches; on a cluster the submitter sets these."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # generated methods above 8000 bytes are never compiled by the JVM: better not to fuse them
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.driver.memory", os.environ.get("LINKSIFT_DRIVER_MEMORY", "12g"))
        .getOrCreate()
    )


_own_folder: dict[str, str] = {}


def shared_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared checkpoint folder of the session.

    ``spark.checkpoint.dir`` names the cluster's shared folder. Only where it is
    unset (tests on one machine) is a local temporary folder taken instead.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        app = spark.sparkContext.applicationId
        root = _own_folder.setdefault(app, "") or tempfile.mkdtemp(prefix="linksift-")
        _own_folder[app] = root
    return f"{root.rstrip('/')}/{name}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder: later steps read it instead of computing it again."""
    path = shared_folder(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
