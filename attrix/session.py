"""Session helpers.

The library never creates its own cluster configuration for production use;
``get_session`` is a convenience for tests, benches and local runs.  Shared
scratch space always comes from ``spark.checkpoint.dir`` (set by the cluster);
only a local session may leave it unset.
"""

from __future__ import annotations

import atexit
import contextlib
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every attrix job relies on for correct results: UTC session time
# (timestamps compare with other engines) and AQE for runtime skew handling.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def get_session(master: str = "local[8]", shuffle_partitions: int = 8,
                app_name: str = "attrix") -> SparkSession:
    builder = (SparkSession.builder.master(master).appName(app_name)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "16g"))
    for k, v in REQUIRED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_conf(spark)
    return spark


def scale_conf(input_bytes: int, total_cores: int,
               target_partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Sizing for a cluster run: partitions of about ``target_partition_bytes``.

    Shuffle partitions are input / target, at least two per core, whatever the
    input's size: AQE coalesces small partitions and splits skewed ones at
    runtime. File splits use the same target so scan tasks fit in executor
    memory without spilling.
    """
    parts = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }


def ensure_conf(spark: SparkSession) -> None:
    """Apply the runtime-settable parts of REQUIRED_CONF to an existing session."""
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    Only a local session (one JVM, so any folder is shared) may leave the setting
    out; it then gets one scratch folder of its own, removed when the driver ends.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if not d:
        d = sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        d = "file:" + tempfile.mkdtemp(prefix="attrix-shared-")
        atexit.register(shutil.rmtree, d.removeprefix("file:"), True)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d.rstrip("/")


_RUNS: list[str] = []      # folders of the scratch runs that are open, the innermost last


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path in the shared folder for one job run; its writer creates it."""
    base = _RUNS[-1] if _RUNS else f"{shared_dir(spark)}/attrix"
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


@contextlib.contextmanager
def scratch_run(spark: SparkSession):
    """All tables that jobs in this block write beside their results go to one folder, which is removed at its end.

    Results are lazy and read those tables: write them somewhere else before the block ends.
    The folder goes on failure, too; that of a driver that dies stays, under
    ``<spark.checkpoint.dir>/attrix/run-*``, and may be removed when no such driver runs.
    """
    folder = f"{shared_dir(spark)}/attrix/run-{uuid.uuid4().hex[:12]}"
    _RUNS.append(folder)
    try:
        yield folder
    finally:
        _RUNS.remove(folder)
        remove_path(spark, folder)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on its (Hadoop-compatible) filesystem."""
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
    except Exception:  # no JVM gateway in this process: local paths only, else try a listing
        if "://" not in path or path.startswith("file:"):
            return os.path.exists(path.replace("file:", "", 1))
        try:
            return len(spark.read.format("binaryFile").load(path).select("path").limit(1).collect()) > 0
        except Exception:
            return False


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Data files directly under ``path`` on its filesystem, fully qualified and sorted."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    names = [f.getPath().toString() for f in fs.listStatus(p) if f.isFile()]
    return sorted(n for n in names if not n.rsplit("/", 1)[-1].startswith(("_", ".")))


def stored_bytes(spark: SparkSession, paths) -> int:
    """Bytes of files and folders together, as stored."""
    jvm, total = spark.sparkContext._jvm, 0
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        total += p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(p).getLength()
    return total


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that this process made."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def move_file(spark: SparkSession, source: str, target: str) -> None:
    """Move one file on its filesystem, making the target's folder."""
    jvm = spark.sparkContext._jvm
    p, q = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(q.getParent())
    if not fs.rename(p, q):
        raise OSError(f"could not move {source} to {target}")


def bare_path(path):
    """A file path for comparisons (str or Column): percent-decoded, ``file:///x`` and ``file:/x`` alike."""
    if isinstance(path, str):
        from urllib.parse import unquote
        return re.sub("^file:/+", "/", unquote(path))
    from pyspark.sql import functions as F
    return F.regexp_replace(F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), "^file:/+", "/")


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly under ``path``; none if it does not exist."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    return sorted(f.getPath().getName() for f in fs.listStatus(p) if f.isDirectory())


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file, such as a manifest, as one string."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    stream = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Make ``path`` appear with all of ``text`` at once; False, and nothing changed, if it is there already.

    The text is written beside it and renamed without overwriting, which is atomic on the
    filesystems that Structured Streaming checkpoints need as well.
    """
    jvm, sc = spark.sparkContext._jvm, spark.sparkContext
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(sc._jsc.hadoopConfiguration())
    fs.mkdirs(p.getParent())
    beside = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{uuid.uuid4().hex}.tmp")
    out = fs.create(beside, False)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    whole = fs.makeQualified(p)
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(whole.toUri(), sc._jsc.hadoopConfiguration())
    try:
        files.rename(fs.makeQualified(beside), whole, sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
        return True
    except Exception:
        if not fs.exists(p):
            raise
        return False
    finally:
        fs.delete(beside, False)
