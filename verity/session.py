"""Session defaults and the shared checkpoint location."""
from __future__ import annotations

import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the library relies on. AQE re-plans joins and splits skewed
# partitions at run time; UTC keeps text <-> timestamp conversions stable.
# No broadcast is planned from size *estimates* (a compressed file can be
# many times larger in memory): the library broadcasts only row-counted
# frames, and AQE may still broadcast a side whose measured shuffle output is
# small.
RECOMMENDED_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.legacy.timeParserPolicy": "CORRECTED",
}


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "verity") -> SparkSession:
    """A local session for tests and benchmarks (the UI stays off)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
    )
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names in ``spark.checkpoint.dir``."""
    try:
        d = spark.sparkContext.getCheckpointDir()
    except Exception:  # noqa: BLE001 - no SparkContext (e.g. a Spark Connect session)
        d = None
    if d:
        return d
    return spark.conf.get("spark.checkpoint.dir", None) or None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The configured checkpoint folder. Only a local-mode session without
    one (tests, local runs) gets a folder under the local temp directory; on
    a cluster a machine-local folder would not be shared, so it is an error."""
    d = checkpoint_dir(spark)
    if d is None:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        d = tempfile.mkdtemp(prefix="verity-ckpt-")
    try:
        if not spark.sparkContext.getCheckpointDir():
            # Spark makes a fresh subfolder under the given one: set it once.
            spark.sparkContext.setCheckpointDir(d)
    except Exception:  # noqa: BLE001 - no SparkContext; the folder is used by path only
        pass
    return d


def remove_path(spark: SparkSession, path: str) -> bool:
    """Best-effort recursive delete of a scratch folder (staging tables under
    the checkpoint folder) through the Hadoop FileSystem of the session, so it
    works on any shared store the cluster uses. Returns False when it could
    not delete."""
    try:
        jvm = spark.sparkContext._jvm
        hpath = jvm.org.apache.hadoop.fs.Path(path)
        fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        return bool(fs.delete(hpath, True))
    except Exception:  # noqa: BLE001 - cleanup must never fail a finished job
        return False


def input_bytes(spark: SparkSession, path: str) -> int | None:
    """Total size of the files under ``path`` (Hadoop FileSystem content
    summary, one listing on the driver); None when it cannot be read."""
    try:
        jvm = spark.sparkContext._jvm
        hpath = jvm.org.apache.hadoop.fs.Path(path)
        fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        return int(fs.getContentSummary(hpath).getLength())
    except Exception:  # noqa: BLE001
        return None


def size_shuffles(spark: SparkSession, nbytes: int | None,
                  target_bytes: int = 256 * 1024 * 1024) -> int:
    """Raise ``spark.sql.shuffle.partitions`` to about ``nbytes /
    target_bytes`` so each shuffle partition of a job over that input fits
    executor memory; AQE coalesces small ones back together. Never lowers the
    setting. Returns the value in effect."""
    current = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    want = -(-(nbytes or 0) // target_bytes)
    if want > current:
        spark.conf.set("spark.sql.shuffle.partitions", str(want))
        return want
    return current


@contextmanager
def session_settings(spark: SparkSession, **settings: str):
    """Session settings for the length of a block; the caller's values (and
    any changed inside under the same names) come back after it. Names are
    given with ``__`` for ``.``."""
    names = {k.replace("__", "."): v for k, v in settings.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        if v is not None:
            spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def qualified(spark: SparkSession, path: str) -> str:
    """One spelling of a path: scheme and authority of its file system, no
    double or trailing slashes."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.makeQualified(hpath).toUri()
    scheme = {"s3": "s3a", "s3n": "s3a"}.get(out.getScheme(), out.getScheme())
    return f"{scheme}://{out.getAuthority() or ''}{out.getPath()}".rstrip("/")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether the file system has the path; any error to find out is raised."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hpath))


def versions_root(path: str) -> str:
    """The folder beside a table's path that holds versions of its data."""
    return f"{path.rstrip('/')}.versions"


def rename_path(spark: SparkSession, old: str, new: str) -> None:
    """Rename a folder; an error if the file system does not."""
    jvm = spark.sparkContext._jvm
    source, target = jvm.org.apache.hadoop.fs.Path(old), jvm.org.apache.hadoop.fs.Path(new)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(target.getParent())
    if not fs.rename(source, target):
        raise OSError(f"could not rename {old} to {new}")


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly under a path; none if it is not there."""
    if not path_exists(spark, path):
        return []
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(hpath) if s.isDirectory()]


def swap_path(spark: SparkSession, new: str, path: str) -> None:
    """Put a finished folder in the place of another. The old one is moved
    aside first and comes back if the new one cannot be moved in."""
    aside = f"{new.rstrip('/')}.replaced"
    held = path_exists(spark, path)
    if held:
        rename_path(spark, path, aside)
    try:
        rename_path(spark, new, path)
    except Exception:
        if held:
            rename_path(spark, aside, path)
        raise
    if held:
        remove_path(spark, aside)


def source_roots(df) -> list[str]:
    """The paths the frame's file scans were opened with; no file is listed."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    roots = []
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName() == "LogicalRelation" \
                and leaf.relation().getClass().getSimpleName() == "HadoopFsRelation":
            paths = leaf.relation().location().rootPaths()
            roots += [paths.apply(j).toString() for j in range(paths.size())]
    return roots
