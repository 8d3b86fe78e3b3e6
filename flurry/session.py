"""Session helpers: building a session, shuffle sizing and lineage cuts."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every session of ours wants, whatever the cluster size.
_BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Last-write-wins when two maps are concatenated (request over defaults).
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.ui.showConsoleProgress": "false",
    # lineage cuts write to the shared checkpoint folder: remove those files
    # once the DataFrame that owns them is no longer referenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, app: str = "flurry",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Return the active session, or build one.

    ``master`` is only used when no session exists (tests, bench). On a
    cluster the submitter decides the master and the session is reused.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        ship_package(active)
        return active
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(_BASE_CONF)
    conf["spark.ui.enabled"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder must be on shared storage and is set by whoever
    submits the job. Only a local-mode session (tests) may fall back to a
    fresh temporary folder, and only when the setting is absent.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir is not set; a shared folder is required")
        d = tempfile.mkdtemp(prefix="flurry-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder.

    Used after expensive multi-stage work so a lost executor recomputes from
    the checkpoint instead of from the scans. Never a local checkpoint.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def staged_table(df: DataFrame, name: str) -> DataFrame:
    """Write a large intermediate table as compressed Parquet into the shared
    folder and read it back: like a checkpoint, but columns are compressed.
    ``discard`` removes it once what was made of it is written."""
    path = scratch_path(df.sparkSession, f"stage/{name}-{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.parquet(path)
    out.staged_at = path
    return out


def discard(*staged: DataFrame) -> None:
    """Delete staged tables whose last reader has written its result."""
    for df in staged:
        sc = df.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(df.staged_at)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of jobs whose results are checkpointed.

    Spark removes them when the driver's JVM finds their owners unreachable;
    between large stages it is worth asking for that at once.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for intermediate tables."""
    return os.path.join(checkpoint_dir(spark), name)


def ship_package(spark: SparkSession) -> None:
    """Make ``flurry`` importable in executor Python workers.

    Pandas UDFs and grouped functions reference this package's helpers, which
    are pickled by reference. The package is zipped in memory, written once
    (per content hash) into the shared checkpoint folder through the Hadoop
    FileSystem API, and added with ``addPyFile`` -- the way --py-files ships
    code. No machine-local folder is involved and no data goes this way.
    """
    sc = spark.sparkContext
    if getattr(sc, "_flurry_shipped", False):
        return
    import hashlib
    import io
    import zipfile

    pkg = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in sorted(os.walk(pkg)):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    info = zipfile.ZipInfo(os.path.relpath(full, os.path.dirname(pkg)), (2020, 1, 1, 0, 0, 0))
                    with open(full, "rb") as fh:
                        z.writestr(info, fh.read())
    data = buf.getvalue()
    target = os.path.join(checkpoint_dir(spark), "flurry-code", hashlib.sha1(data).hexdigest()[:16], "flurry.zip")
    jvm = sc._jvm
    path = jvm.org.apache.hadoop.fs.Path(target)
    fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
    if not fs.exists(path):
        out = fs.create(path, True)
        try:
            out.write(bytearray(data))
        finally:
            out.close()
    sc.addPyFile(target)
    sc._flurry_shipped = True
