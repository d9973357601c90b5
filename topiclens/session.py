"""Session helpers.

The library never creates its own cluster configuration: callers pass an existing
``SparkSession``.  ``local_session`` exists for tests, the bench and the examples.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "topiclens") -> SparkSession:
    """A local session tuned for small inputs: AQE on, UI off, few shuffle partitions."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TOPICLENS_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster it must be set to a shared file system.  Only a local master (tests, the
    bench), where driver and executors are one process, gets a folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        conf_dir = tempfile.mkdtemp(prefix="topiclens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint dir for written intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/tables/{name}-{uuid.uuid4().hex[:12]}"


def local_path(uri: str) -> str:
    """A ``file:`` URI as a plain path for Python file writes (other schemes are refused)."""
    if uri.startswith("file:"):
        path = uri[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
        return path
    if "://" in uri:
        raise ValueError(f"{uri}: Python file writes need a locally mounted shared folder")
    return uri


def materialize(df, name: str = "table"):
    """Write ``df`` once as Parquet under the shared checkpoint folder and read it back.

    A table that several branches of a plan read is computed once (columnar, compressed),
    and the lineage is cut there, so a lost executor recomputes nothing upstream."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


_SCRATCH = re.compile(r".+/tables/[^/]+-[0-9a-f]{12}")


def discard(*tables) -> None:
    """Remove the tables of :func:`materialize` that these frames read, so that the shared folder holds live tables only.

    Call it when every frame made of them is written itself: nothing may read them later.  Other files stay."""
    for df in tables:
        context = df.sparkSession.sparkContext
        for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
            if _SCRATCH.fullmatch(folder):
                path = context._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
