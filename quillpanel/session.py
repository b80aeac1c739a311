"""Session, column-name and durability helpers used by every operator."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL_FOLDERS: dict[str, str] = {}
_WRITTEN: dict[str, list[str]] = {}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for (UTC, AQE, Arrow)."""
    builder = (
        SparkSession.builder.master(master)
        .appName("quillpanel")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def qcol(name: str) -> Column:
    """Column by exact name; dots and back-ticks in the name are literal."""
    return F.col("`" + name.replace("`", "``") + "`")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, however often the body uses it: bound as a lambda
    variable, it is neither inlined nor evaluated again inside nested lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def fresh(df: DataFrame, stem: str) -> str:
    """A column name starting with ``stem`` that clashes with no column of ``df``, whatever the letter case."""
    taken = {c.lower() for c in df.columns}
    name, n = stem, 0
    while name.lower() in taken:
        n += 1
        name = f"{stem}_{n}"
    return name


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder for checkpoints. The cluster's ``spark.checkpoint.dir`` is used as it is; only a
    local master without that setting gets a temporary folder."""
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not re.match(r"local(\[|$)", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = sc.applicationId
    if app not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="quillpanel-checkpoint-")
        atexit.register(shutil.rmtree, _LOCAL_FOLDERS[app], ignore_errors=True)
    return _LOCAL_FOLDERS[app]


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage through a reliable checkpoint in the shared folder."""
    sc = df.sparkSession.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(checkpoint_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; ``forget_stored`` deletes what is written there."""
    path = f"{checkpoint_folder(spark).rstrip('/')}/quillpanel-{uuid.uuid4().hex}-{name}"
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def forget_stored(spark: SparkSession) -> int:
    """Delete the tables that ``stored`` wrote for this application, and say how many: to be called once the results
    that are computed from them are written."""
    paths = _WRITTEN.pop(spark.sparkContext.applicationId, [])
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(conf).delete(target, True)
    return len(paths)


def stored(df: DataFrame, *partition_by: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it again: columnar, prunable, and
    independent of the executors that made it."""
    path = scratch(df.sparkSession, "table")
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
