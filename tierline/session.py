"""Session construction and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(
    master: str | None = None,
    app_name: str = "tierline",
    shuffle_partitions: int | None = None,
    time_zone: str | None = None,
    initial_partitions: int | None = None,
) -> SparkSession:
    """A session with AQE on and the UI off.

    On a cluster pass ``master=None`` and let the launcher decide; partitions
    then come from the cluster defaults and AQE coalescing. ``time_zone`` sets
    the session zone that processing stamps are shown in (the caller's choice;
    library functions never change it). ``initial_partitions`` is the partition
    count that a shuffle starts with before AQE coalesces it; choose about the
    largest expected shuffle / 128 MB, within what one driver can track.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # remove reliable checkpoint files once their data is no longer referenced
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if time_zone:
        conf["spark.sql.session.timeZone"] = time_zone
    if initial_partitions:
        conf["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(initial_partitions)
    for k, v in conf.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


_CHOSEN: dict[str, str] = {}


def workspace_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names shared storage every executor can reach.
    Only when it is unset (local tests) is a folder created; it becomes the
    context's checkpoint folder and is reused for the rest of the application.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _CHOSEN:
        return _CHOSEN[app]
    # the setting, or the folder that the caller gave to setCheckpointDir
    current = spark.conf.get(_CHECKPOINT_KEY, None) or sc.getCheckpointDir()
    if not current:
        if not sc.master.startswith("local"):
            raise RuntimeError(f"{_CHECKPOINT_KEY} must name storage shared by all executors")
        current = tempfile.mkdtemp(prefix="tierline-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    _CHOSEN[app] = current.rstrip("/")
    return _CHOSEN[app]


def run_dir(spark: SparkSession, *parts: str) -> str:
    """A folder below the workspace that is private to this application run."""
    app = spark.sparkContext.applicationId or uuid.uuid4().hex
    return "/".join([workspace_dir(spark), "tierline", app, *parts])


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A folder below the workspace shared by all runs (content-addressed use only)."""
    return "/".join([workspace_dir(spark), "tierline", "shared", *parts])


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of ``path`` and its path object (classic sessions only)."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop file system of ``path``."""
    fs, hpath = file_system(spark, path)
    return bool(fs.exists(hpath))


def write_text(spark: SparkSession, path: str, text: str, overwrite: bool) -> None:
    """A small file. Without ``overwrite`` the file system fails if it exists, so of two writers one succeeds."""
    fs, hpath = file_system(spark, path)
    out = fs.create(hpath, overwrite)
    out.write(bytearray(text.encode()))
    out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; None if there is no such file."""
    fs, hpath = file_system(spark, path)
    if not fs.exists(hpath):
        return None
    stream = fs.open(hpath)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def files_of(spark: SparkSession, path: str) -> str:
    """Path, length and time of every file below ``path``; a folder's own time says little on object stores."""
    fs, hpath = file_system(spark, path)
    files, seen = fs.listFiles(hpath, True), []
    while files.hasNext():
        f = files.next()
        seen.append(f"{f.getPath()}|{f.getLen()}|{f.getModificationTime()}")
    return "\n".join(sorted(seen))


def stored(df: DataFrame, *parts: str) -> DataFrame:
    """``df`` written as parquet below this run's folder and read back.

    Used where one computed input feeds two sides of a plan: each side reads
    only its columns of the written copy, and a lost executor costs a re-read
    rather than a recomputation from the source.
    """
    spark = df.sparkSession
    path = run_dir(spark, *parts, uuid.uuid4().hex[:12])
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
