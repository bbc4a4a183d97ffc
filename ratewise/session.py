"""Session set-up and the shared folders jobs write to.

On a cluster the shared folder is whatever ``spark.checkpoint.dir`` names;
only a local-mode session (tests, the bench) may fall back to a folder of
its own under /tmp.
"""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession


def build_session(
    cpus: int | str = "*",
    shuffle_partitions: int = 8,
    app: str = "ratewise",
    driver_memory: str = "16g",
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """A local session tuned like the cluster one: AQE on, UI off."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.forceDeleteTempCheckpointLocation", "true")
        .config("spark.python.worker.reuse", "true")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for k, v in (extra_conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``ratewise`` importable by the Python workers (pandas UDFs).

    Zips the package in memory once per application, writes the zip into
    the shared checkpoint folder through the Hadoop file system API, and
    hands that path to ``SparkContext.addPyFile``, which distributes it to
    every executor. (Passing the zip with ``--py-files`` does the same.)
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _, files in os.walk(pkg):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.relpath(full, root))
    data = buf.getvalue()
    target = os.path.join(checkpoint_root(spark), "pkg", f"ratewise-{app}.zip")
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(target)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    out = fs.create(path, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()
    sc.addPyFile(target)
    _SHIPPED.add(app)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and job outputs.

    Uses the context's checkpoint dir, else ``spark.checkpoint.dir``; a
    private /tmp folder is made only for local-mode sessions where neither
    is set.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder"
            )
        configured = tempfile.mkdtemp(prefix="ratewise-ckpt-", dir="/tmp")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    root = checkpoint_root(spark)
    return os.path.join(root, "scratch", f"{tag}-{uuid.uuid4().hex[:12]}")
