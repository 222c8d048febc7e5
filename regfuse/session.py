"""Session settings the operators assume, and the shared checkpoint folder.

On a cluster the session comes from the platform; ``ensure_conf`` only fills
in settings that are unset.  ``local_session`` is for tests and the bench.
"""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime re-planning is what makes un-hinted joins safe at any size: AQE
# turns a join into a broadcast only after it has measured the real size of
# a side, splits skewed shuffle partitions and coalesces tiny ones.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # the JVM does not compile longer methods: beyond it, expressions are evaluated in several short ones
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# Settings that a session must be built with; a cluster's belong in its spark-submit configuration.
STATIC_CONF = {
    "spark.python.sql.dataFrameDebugging.enabled": "false",  # else every column built records its call site
}


def ensure_conf(spark: SparkSession) -> SparkSession:
    for k, v in DEFAULT_CONF.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the session.

    Only a local session (tests, the bench) may leave it unset: a scratch
    folder is then created and registered.  On a cluster a machine-local folder
    would lose what other executors wrote, so there an unset folder is an error."""
    try:
        sc = spark.sparkContext
    except Exception:  # remote session: only the configuration is visible
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir and sc is not None:
        conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if sc is None or not (sc.master or "").startswith("local") or "cluster" in sc.master:
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="regfuse-ckpt-")
    if sc is not None:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    return conf_dir


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "regfuse") -> SparkSession:
    os.environ.setdefault("PYSPARK_PYTHON", "python")
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in (DEFAULT_CONF | STATIC_CONF).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_scopes: list[list[str]] = []


_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed(spark: SparkSession):
    """What is written inside the block leaves no shuffle files behind: they go when it is written, not when the driver
    happens to collect its garbage.  (Of writes only: a result that is read several times keeps its files.)"""
    old = spark.conf.get(_FREED, None)
    spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        spark.conf.unset(_FREED) if old is None else spark.conf.set(_FREED, old)


def materialize(df, by: tuple[str, ...] = ()):
    """Write ``df`` once as a parquet table under the session's checkpoint
    folder and read it back.

    This cuts the lineage like ``checkpoint()`` (a lost executor re-reads the
    table instead of recomputing it) but is columnar and compressed - the RDD
    checkpoint path serialises row objects one by one.  ``by``: columns that become folders.  Row order across
    partitions is not kept: sort after reading when order matters.  Inside
    ``scratch`` the table goes when the block ends, else see ``remove``."""
    import uuid

    spark = df.sparkSession
    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/regfuse-{uuid.uuid4().hex}"
    for scope in _scopes:
        scope.append(path)
    # short-lived table: dictionary encoding only costs time here
    df.write.mode("error").option("parquet.enable.dictionary", "false").option("compression", "zstd").partitionBy(*by).parquet(path)
    out = (spark.read.schema(df.schema) if by else spark.read).parquet(path)
    out.materialized_path = path
    return out


@contextmanager
def scratch(spark: SparkSession):
    """Tables materialised inside the block are removed when it ends."""
    _scopes.append(paths := [])
    try:
        yield
    finally:
        _scopes.remove(paths)
        for path in paths:
            remove_path(spark, path)


def remove(df) -> None:
    """Remove the table of a ``materialize`` once nothing reads it any more."""
    remove_path(df.sparkSession, df.materialized_path)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files under ``path``; 0 if it does not exist."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return store.getContentSummary(path).getLength() if store.exists(path) else 0


def remove_path(spark: SparkSession, path: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
