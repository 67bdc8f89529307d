"""Session helpers shared by operators: shared scratch space, checked broadcasts, written stages."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A written table up to this many bytes may be broadcast; beyond it the plan shuffles.
BROADCAST_LIMIT = 32 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session, or the checkpoint folder set on the context.

    Only where both are absent (tests, local mode) a temporary folder is
    made and remembered in the session, so later calls agree.
    """
    try:
        found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    except Exception:  # noqa: BLE001 - a session without the key
        found = None
    if not found:
        found = spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="palimpsest-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in this application's part of the shared folder."""
    return f"{shared_dir(spark)}/palimpsest/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def clean(spark: SparkSession) -> None:
    """Remove what this application staged. Results that have not been read yet are lost."""
    remove(spark, f"{shared_dir(spark)}/palimpsest/{spark.sparkContext.applicationId}")


def fs(spark: SparkSession, path: str):
    """Hadoop file system and path object for ``path``."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    f, p = fs(spark, path)
    return f.exists(p)


def bytes_of(spark: SparkSession, path: str) -> int:
    f, p = fs(spark, path)
    return f.getContentSummary(p).getLength() if f.exists(p) else 0


def get(spark: SparkSession, path: str) -> str | None:
    """Text of a small file; None if there is none."""
    f, p = fs(spark, path)
    if not f.exists(p):
        return None
    stream = f.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def remove(spark: SparkSession, *paths: str) -> None:
    for path in paths:
        f, p = fs(spark, path)
        if f.exists(p):
            f.delete(p, True)


class Superseded(RuntimeError):
    """Another run has published since this one read its state; nothing of this run is visible, and it may be taken again."""


#: Published versions that are kept beside the newest one.
PAST_VERSIONS = 20


def published(spark: SparkSession, root: str) -> tuple[int, str | None]:
    """(number, text) of the newest version below ``root``; (0, None) if nothing was published."""
    f, p = fs(spark, f"{root}/_versions")
    names = [s.getPath().getName() for s in f.listStatus(p)] if f.exists(p) else []
    newest = max((n for n in names if n.endswith(".json")), default=None)
    return (int(newest[:-5]), get(spark, f"{root}/_versions/{newest}")) if newest else (0, None)


def publish(spark: SparkSession, root: str, after: int, text: str) -> int:
    """Publish the version that follows number ``after``: readers see the old or the new one. Returns its number.

    The file is written beside its place and renamed without overwriting, so of two runs that read one version only the first gets through;
    the other raises ``Superseded``. Needs a file system whose rename is atomic.
    """
    number = after + 1
    f, p = fs(spark, f"{root}/_versions/{number:012d}.json")
    tmp = fs(spark, f"{root}/_versions/{uuid.uuid4().hex}.tmp")[1]
    out = f.create(tmp, True)
    out.write(bytearray(text.encode()))
    out.close()
    jvm = spark.sparkContext._jvm
    none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(tmp, p, none)
    except Exception as e:
        f.delete(tmp, False)
        if f.exists(p):
            raise Superseded(f"{root}: version {number} was published by another run") from e
        raise
    if number > PAST_VERSIONS:
        remove(spark, f"{root}/_versions/{number - PAST_VERSIONS:012d}.json")
    return number


def stage(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives executor loss."""
    spark = df.sparkSession
    path = scratch(spark, name)
    schema = df.schema
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(schema).parquet(path), path


def maybe_broadcast(df: DataFrame, path: str, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Hint a broadcast for a written table whose measured size is within ``limit``; else leave the join to Catalyst.

    Parquet is compressed, so a factor of four is allowed for its size in memory.
    """
    return F.broadcast(df) if bytes_of(df.sparkSession, path) * 4 <= limit else df


def local_session(cores: str = "*", shuffle: int = 8, **conf: str) -> SparkSession:
    """A session for tests, the command line and benchmarks."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("palimpsest")
        .config("spark.sql.shuffle.partitions", str(shuffle))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    )
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    ship(spark)
    return spark


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers of the session, once per application."""
    import os
    import zipfile

    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="palimpsest-code-"), "palimpsest.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(here):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.join("palimpsest", os.path.relpath(full, here)))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)
