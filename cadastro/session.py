"""Session helpers: building a session for local runs and finding the shared scratch folder.

On a cluster the session is built by the platform; the library only *reads* its settings. The one
setting it relies on is ``spark.checkpoint.dir``: every table this library writes for its own use
(staging, fixtures, checkpoints) goes below that shared folder, never to a machine-local temp dir.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings a local session gets; a cluster session keeps whatever the platform chose.
LOCAL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Wide registry tables generate codegen methods above the JVM's 8000-byte JIT limit; without this
    # flag such a method runs in the bytecode interpreter. Set the same on executors of a cluster.
    "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "cadastro") -> SparkSession:
    """A ``local[cpus]`` session for tests and benchmarks (never used on a cluster)."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for k, v in LOCAL_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("CADASTRO_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session first. A ``local[...]`` session without one (tests) gets a temporary folder,
    registered with the session so ``DataFrame.checkpoint()`` and this library agree on one place, and
    removed when the process ends. On a cluster a folder of one machine would be seen by that machine
    only, so a cluster session without the setting is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    context = _context(spark)
    if not root and context is not None:
        root = context.getCheckpointDir()
    if not root:
        if context is None or not context.master.startswith("local[") and context.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="cadastro-checkpoint-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        context.setCheckpointDir(root)
        root = context.getCheckpointDir() or root
    return root.rstrip("/")


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None on a Spark Connect session (which has none)."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect raises for sparkContext
        return None


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique path below the shared checkpoint folder: ``<root>/cadastro/<parts>/<uuid>``."""
    return "/".join([checkpoint_root(spark), "cadastro", *parts, uuid.uuid4().hex])


def delete_path(spark: SparkSession, path: str) -> bool:
    """Recursively delete ``path`` through the Hadoop FileSystem of the session (works for any URI)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.delete(hpath, True))


# Since Spark 4.1; an older session ignores it.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_deleted(spark: SparkSession):
    """Within it, what a write or an action shuffled is deleted when it has ended. Spark alone deletes it once the
    driver's garbage collector finds it unused, which takes long where the driver has memory to spare."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def set_modified(spark: SparkSession, path: str, epoch_ms: int) -> None:
    """Set the modification time of every file directly in the folder ``path``."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in fs.listStatus(hpath):
        fs.setTimes(status.getPath(), epoch_ms, -1)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def _storage(spark: SparkSession, path: str):
    """(Hadoop path, its file system) of a path in any storage the session knows."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath, hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly in ``path``."""
    hpath, fs = _storage(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(hpath) if s.isDirectory()]


def read_text(spark: SparkSession, path: str) -> str:
    """The whole content of a small UTF-8 file."""
    hpath, fs = _storage(spark, path)
    stream = fs.open(hpath)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file so that readers see the old content or the new, never a part: it is written beside
    and renamed over the old one in one step of the storage."""
    jvm = spark.sparkContext._jvm
    hpath, fs = _storage(spark, path)
    beside = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    stream = fs.create(beside, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(beside.toUri() if beside.toUri().getScheme() else fs.getUri(),
                                                                  spark.sparkContext._jsc.hadoopConfiguration())
    rename = jvm.java.lang.reflect.Array.newInstance(jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 1)
    rename[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(fs.makeQualified(beside), fs.makeQualified(hpath), rename)
