"""Session construction and shared-folder helpers.

The library itself never creates a session: every operator takes and returns
DataFrames.  These helpers exist for tests, the benchmark and the driver entry.
"""

from __future__ import annotations

import tempfile
import uuid
import weakref

from pyspark.sql import SparkSession

# Scratch folders made so far, by session.
_SCRATCH: "weakref.WeakKeyDictionary[SparkSession, list[str]]" = \
    weakref.WeakKeyDictionary()

# Settings every job wants: AQE re-plans joins/partition counts at runtime from
# measured sizes, skew-join splitting for hot keys, UTC so that timestamps and
# calendar functions agree with other engines.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "panelforge",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    On a cluster pass ``master=None`` and let spark-submit decide; the shuffle
    partition count should then be sized so one partition is ~128-256 MB of
    shuffle data at the target scale (AQE coalesces the rest).
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local master may
    do without: it gets a fresh local folder, which other machines could not
    read, so any other master without the setting is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or \
        spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all "
                             "executors share")
        configured = tempfile.mkdtemp(prefix="panelforge-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder.

    Used for the few operators whose semantics are about files (slice
    overwrite, by-name load, per-period documents).  Never machine-local on a
    cluster: it hangs off ``spark.checkpoint.dir``.
    """
    base = ensure_checkpoint_dir(spark)
    path = base.rstrip("/") + f"/panelforge-scratch/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.setdefault(spark, []).append(path)
    return path


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder through the cluster's file system (any scheme)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.delete(p, True)


def scratch_mark(spark: SparkSession) -> int:
    """How many scratch folders there are, for ``drop_scratch_since``."""
    return len(_SCRATCH.get(spark, []))


def drop_scratch_since(spark: SparkSession, mark: int, keep: str) -> int:
    """Delete the scratch folders made since ``mark`` but ``keep``: the
    intermediates of a result that was stored in ``keep``."""
    paths = _SCRATCH.get(spark, [])
    done = [p for p in paths[mark:] if p != keep]
    paths[mark:] = [p for p in paths[mark:] if p == keep]
    return sum(delete_path(spark, p) for p in done)


def drop_scratch(spark: SparkSession) -> int:
    """Delete every scratch folder this session has made so far.

    Results are read lazily, so call it when the DataFrames of earlier queries
    are done with; the benchmark does so after each run."""
    paths = _SCRATCH.pop(spark, [])
    return sum(delete_path(spark, p) for p in paths)
