"""Session helpers: a local session for tests and the bench, the shared
checkpoint folder, and size-checked broadcasting."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Largest number of rows we agree to broadcast when the caller gives no bound.
DEFAULT_BROADCAST_ROWS = 200_000
# Most text in a frame that is broadcast.
DEFAULT_BROADCAST_BYTES = 64 << 20


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "sifter") -> SparkSession:
    """A local session configured like the cluster one (AQE on, UI off)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("SIFTER_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in
    ``spark.checkpoint.dir``; create a scratch one only when it is unset
    (local tests)."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a remote session has no context here
        sc = None
    current = spark.conf.get("spark.checkpoint.dir", None) or (sc.getCheckpointDir() if sc else None)
    if current:
        if sc is not None and not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if sc is None or not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="sifter-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    if sc is not None:
        sc.setCheckpointDir(path)
    return path


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                      max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Broadcast ``df`` only if it has at most ``max_rows`` rows and, written
    out as text, ``max_bytes`` bytes.

    The check runs ``df`` until it has ``max_rows + 1`` rows, so give it frames
    that are cheap to run; beyond a bound the frame is returned as is and the
    planner picks a shuffle join (with AQE skew handling)."""
    size = df.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("n"), F.coalesce(
        F.sum(F.octet_length(F.to_json(F.struct(*df.columns)))), F.lit(0)).alias("b")).first()
    return F.broadcast(df) if size["n"] <= max_rows and size["b"] <= max_bytes else df


def row_count_at_most(df: DataFrame, max_rows: int) -> bool:
    return df.limit(max_rows + 1).count() <= max_rows


def spread(df: DataFrame, keys: list[str] | None = None, min_partitions: int | None = None) -> DataFrame:
    """Hash-partition a scan on its row key when it yields fewer partitions
    than the cluster can run at once (a small table in one row group would
    otherwise put all text work in one task). At scale the scan already has
    far more splits than cores and this is a no-op. Partitioning on the
    document key also clusters every later per-document/page aggregate."""
    want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    splits = df.rdd.getNumPartitions()
    if splits >= 4 * want:
        return df
    # a file of one row group can be cut into many splits of which one has rows:
    # count the splits that do (no column is read, only the footers)
    if splits >= want and df.select(F.spark_partition_id()).distinct().count() >= want:
        return df
    return df.repartition(want, *keys) if keys else df.repartition(want)


def materialise_bucketed(df: DataFrame, key: str | list[str] | tuple[str, ...], buckets: int | None = None,
                         name: str = "table", clustered: bool = False, sort: str | None = None,
                         path: str | None = None) -> DataFrame:
    """Like ``materialise`` but as a table bucketed on ``key``
    in the checkpoint folder: reads of it are hash-partitioned on ``key``, so
    aggregates and windows keyed on it (or on a superset of it) need no
    exchange. ``buckets`` defaults to ``spark.sql.shuffle.partitions``. The
    table is registered in the session's catalog, of whatever kind. Unless
    ``clustered`` says that ``df`` is partitioned on ``key`` already, it is
    first, so that a bucket is one file and not one per task. With ``sort`` the
    rows of a bucket are in that column's order, so a filter on it skips
    most of each file by its page index. ``path`` names the folder."""
    import uuid

    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    base = "" if path else ensure_checkpoint_dir(spark).rstrip("/")
    tag = uuid.uuid4().hex
    table_name = f"sifter_{name}_{tag}"
    cols = [key] if isinstance(key, str) else list(key)
    if not clustered:
        df = df.repartition(n, *cols)
    w = df.write.mode("overwrite").bucketBy(n, *cols)
    if sort:
        w = w.sortBy(sort)
    w.option("path", path or f"{base}/sifter-tables/{name}-{tag}").saveAsTable(table_name)
    return spark.table(table_name)


def open_bucketed(spark: SparkSession, path: str, key: list[str] | tuple[str, ...], buckets: int, sort: str,
                  name: str = "table") -> DataFrame:
    """A table that ``materialise_bucketed`` wrote to ``path``, perhaps in
    another application, with its buckets known to the planner again."""
    import uuid

    table_name = f"sifter_{name}_{uuid.uuid4().hex}"
    quoted = ", ".join(f"`{c}`" for c in key)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema.fields)
    location = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {table_name} ({columns}) USING parquet CLUSTERED BY ({quoted}) SORTED BY (`{sort}`) "
              f"INTO {buckets} BUCKETS LOCATION '{location}'")
    return spark.table(table_name)


def materialise(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once as Parquet under the shared checkpoint folder and
    read it back: the lineage is cut, readers depend only on durable files
    (an executor lost later costs no recomputation), and the plan runs once
    (``checkpoint()`` without caching runs it twice)."""
    import uuid

    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/sifter-tables/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
