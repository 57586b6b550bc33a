"""Session settings and the shared scratch folder.

All jobs assume ``spark.sql.session.timeZone=UTC`` (the stored tables hold UTC
instants) and keep ANSI mode on, using ``try_*`` functions where the sources are
lenient.  Scratch data (staging for upserts, lineage cuts) always goes under the
cluster's shared ``spark.checkpoint.dir``; a private folder is only created when
that setting is unset, as in tests and local runs.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

SESSION_DEFAULTS: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app_name: str = "tidemark",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings every job relies on."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_session_settings(spark)
    return spark


def apply_session_settings(spark: SparkSession) -> None:
    """Pin the runtime settings the jobs depend on (idempotent)."""
    conf = spark.conf
    conf.set("spark.sql.session.timeZone", "UTC")
    conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    conf.set("spark.sql.adaptive.enabled", "true")
    # listing the files of a table: tasks by the cores there are, not one for each folder
    conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", str(max(32, 4 * spark.sparkContext.defaultParallelism)))


_PRIVATE_ROOTS: dict[str, str] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session (or the context's checkpoint directory); a private
    folder is created only when the cluster names none (tests, local runs), once
    per application.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        root = sc.getCheckpointDir()
    if not root:
        app = sc.applicationId
        root = _PRIVATE_ROOTS.get(app)
        if root is None:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise RuntimeError("spark.checkpoint.dir is not set: a cluster has to name a folder that all its machines share")
            root = _PRIVATE_ROOTS[app] = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/{purpose}-{uuid.uuid4().hex[:12]}"


def hadoop_fs(spark: SparkSession, path: str):
    """Hadoop FileSystem handle for ``path`` (works for local, HDFS and object stores)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Put a small file in the place of another by one rename: a reader sees the old one or the new one."""
    fs, target = hadoop_fs(spark, path)
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    fresh = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex[:12]}")
    out = fs.create(fresh, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(fresh), fs.makeQualified(target), how)


def file_names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    fs, hpath = hadoop_fs(spark, folder)
    return [st.getPath().getName() for st in fs.listStatus(hpath)] if fs.exists(hpath) else []


def remove(spark: SparkSession, path: str) -> bool:
    """Remove a file or folder; whether there was one."""
    fs, hpath = hadoop_fs(spark, path)
    return bool(fs.delete(hpath, True))


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; None if there is no such file."""
    fs, hpath = hadoop_fs(spark, path)
    if not fs.exists(hpath):
        return None
    stream = fs.open(hpath)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def local_test_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and local benches; scratch under /tmp only here."""
    os.environ.setdefault("PYSPARK_PYTHON", "python")
    return build_session(
        master=f"local[{cores}]",
        app_name="tidemark-local",
        shuffle_partitions=shuffle_partitions,
        extra={"spark.driver.memory": "8g", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m"},
    )
