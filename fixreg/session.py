"""Session helpers: a local session for tests/bench and the shared scratch folder.

On a cluster the session comes from the platform; the only thing the library
reads from it is ``spark.checkpoint.dir`` (a shared, fault-tolerant folder).
A private folder is created only when that setting is absent (local runs).
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Session settings used by tests and bench.py.  AQE re-plans joins and
# coalesces/splits shuffle partitions at run time; the UI stays off.
LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "8g",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "fixreg") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in LOCAL_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder.

    Uses the context's checkpoint dir or ``spark.checkpoint.dir``.  Only a
    local-mode session (tests, bench) gets a private folder when neither is
    set; on a cluster (``local-cluster`` too) the setting is required.  What
    the cluster names there is taken as shared, whatever its scheme.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not re.match(r"local(\[|$)", sc.master):  # local-cluster has executors of its own
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS or object storage)")
        conf_dir = tempfile.mkdtemp(prefix="fixreg-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/fixreg-{name}-{uuid.uuid4().hex[:12]}"


class ScratchSpace:
    """Scratch tables of one owner, with one life span.

    The tables lie in a folder of the space's own below the shared checkpoint
    folder, so nobody else's clean-up touches them and ``close`` removes all
    of them, the remains of a failed write too.  Use it as a context manager
    around the work that reads the tables::

        with ScratchSpace(spark, "convert") as scratch:
            ids = scratch.write(ids, "ids")   # cuts the lineage
            ...
    """

    def __init__(self, spark: SparkSession, owner: str):
        self.spark = spark
        self.path = scratch_path(spark, owner)
        self._tables: list[tuple[str, str]] = []  # (name, path), listed before they are written

    def write(self, df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
        """``df`` as a Parquet table of the space; a failed write leaves nothing."""
        path = f"{self.path}/{len(self._tables)}-{name}"
        self._tables.append((name, path))
        writer = df.write.partitionBy(*partition_by) if partition_by else df.write
        try:
            writer.parquet(path)
        except Exception:
            remove_path(self.spark, path)
            raise
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        """Remove the space's tables called ``name``."""
        for n, path in self._tables:
            if n == name:
                remove_path(self.spark, path)

    def close(self) -> None:
        remove_path(self.spark, self.path)

    def __enter__(self) -> ScratchSpace:
        return self

    def __exit__(self, *_exc) -> None:
        self.close()


_SESSION_SPACES: dict[str, ScratchSpace] = {}  # by application


def session_space(spark: SparkSession) -> ScratchSpace:
    """The space of tables whose caller named no owner; it lives until ``close_session_space``."""
    app = spark.sparkContext.applicationId
    if app not in _SESSION_SPACES:
        _SESSION_SPACES[app] = ScratchSpace(spark, "session")
    return _SESSION_SPACES[app]


def close_session_space(spark: SparkSession) -> None:
    """Remove what the session's space holds; results not written by then can't be computed any more."""
    space = _SESSION_SPACES.pop(spark.sparkContext.applicationId, None)
    if space:
        space.close()


def remove_path(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
