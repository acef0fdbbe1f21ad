"""Session helpers: a tuned local session for tests/bench, and lineage cuts.

Library code never creates a session; callers pass theirs in.  The only
session state the library touches is the checkpoint directory, and only when
the session has none (see :func:`checkpoint_dir`).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "tessera",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """A session configured the way the operators expect to run.

    Under ``spark-submit`` (no explicit ``master``) the submitted session is
    returned as is; otherwise a local session is built with the settings below.

    AQE re-plans joins and coalesces small shuffles at run time, and splits
    skewed join partitions.  On a cluster the number of shuffle partitions is
    the cluster's setting (size it to input bytes / ~128 MB), as AQE only
    coalesces it down.
    """
    if master is None and os.environ.get("PYSPARK_GATEWAY_PORT") and not os.environ.get("TESSERA_LOCAL"):
        # launched by spark-submit: the submitted master and settings win
        spark = SparkSession.builder.appName(app).getOrCreate()
        spark.sparkContext.setLogLevel("ERROR")
        return spark
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    builder = SparkSession.builder.master(master).appName(app)
    event_dir = os.environ.get("TESSERA_EVENT_LOG_DIR")
    if event_dir:  # stage/task timings without the UI: see tools/stages.py
        builder = (builder.config("spark.eventLog.enabled", "true")
                   .config("spark.eventLog.dir", event_dir))
    for key, value in session_settings(master, shuffle_partitions).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def session_settings(master: str, shuffle_partitions: int | None = None) -> dict[str, str]:
    """The settings :func:`build_session` makes for a master.

    Only a local master gets sizes (shuffle partitions, driver memory): a
    cluster keeps its own.
    """
    out = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # checkpoint files of frames that are no longer referenced get removed
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if master == "local" or master.startswith("local["):
        if shuffle_partitions is None:
            shuffle_partitions = max(8, 2 * _local_cores(master))
        out["spark.driver.memory"] = os.environ.get("TESSERA_DRIVER_MEMORY", "8g")
    if shuffle_partitions is not None:
        out["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    return out


def _local_cores(master: str) -> int:
    """Threads of ``local``, ``local[n]``, ``local[n,retries]`` or ``local[*]``."""
    inner = master[len("local"):].strip("[]").split(",")[0]
    return int(inner) if inner.isdigit() else (1 if not inner else os.cpu_count() or 1)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder used to cut lineage.

    Taken from the session (``SparkContext.getCheckpointDir`` or the
    ``spark.checkpoint.dir`` setting).  Only when neither is set *and* the
    master is local does this create a private folder, as tests do; on a
    cluster an unset directory is an error, since a machine-local folder would
    not survive the loss of the executor that wrote it.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: the server owns the folder
        return spark.conf.get("spark.checkpoint.dir", None) or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tessera-ckpt-"))
        return sc.getCheckpointDir()
    raise RuntimeError(
        "no checkpoint directory: set spark.checkpoint.dir to a shared folder "
        "(HDFS/S3/…) before running iterative jobs")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and checkpoint it in the folder of :func:`checkpoint_dir`.

    For small frames that a step hands to the next one.  Nothing is cached and
    nothing has to be released: the files go with the last reference.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def materialize(df: DataFrame) -> DataFrame:
    """Cut ``df``'s lineage: write it as a Parquet table in the checkpoint folder.

    The data is computed once and written (columnar and compressed — a few
    bytes per row for small integer tuples); the returned frame reads that
    table and is cached, so losing an executor later costs a re-read of the
    table, not a re-run of the joins and aggregations that produced it.
    Call :func:`release` when done: it drops the cache and the table.  On a
    session without a reachable checkpoint folder path (Spark Connect) this
    falls back to ``DataFrame.checkpoint``.
    """
    spark = df.sparkSession
    base = checkpoint_dir(spark)
    if not base:
        return df.checkpoint(eager=True)
    path = f"{base.rstrip('/')}/tessera-{uuid.uuid4().hex}"
    df.write.parquet(path)
    # the schema is known: no footer reads to infer it again
    out = spark.read.schema(df.schema).parquet(path).persist(StorageLevel.MEMORY_AND_DISK)
    out._tessera_table = path  # noqa: SLF001 - lets release() remove the table
    return out


def release(*frames: DataFrame) -> None:
    """Unpersist frames; remove the tables :func:`materialize` wrote for them."""
    for f in frames:
        if f is None:
            continue
        f.unpersist()
        path = getattr(f, "_tessera_table", None)
        if path:
            remove_table(f.sparkSession, path)


def remove_table(spark: SparkSession, path: str) -> None:
    """Delete a table that this library wrote in the checkpoint folder, as far as that is possible."""
    try:
        hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)
    except Exception:  # noqa: BLE001 - cleanup is best effort
        pass


def _sql_literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, int):
        return str(v)
    if isinstance(v, float):
        return f"CAST('{v!r}' AS DOUBLE)"       # exact round trip, incl. inf/nan
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def local_frame(spark: SparkSession, rows, schema: str) -> DataFrame:
    """A small DataFrame from driver-side rows, built as a SQL ``VALUES`` relation.

    For the handful of rows the jobs derive on the driver (k means, medians,
    search intervals): the rows travel inside the plan, so no Python worker
    is started to decode them.  ``schema`` is ``"name TYPE, …"``.
    """
    fields = [f.split() for f in schema.split(",")]
    if not rows:
        nulls = ", ".join(f"CAST(NULL AS {t}) AS `{n}`" for n, t in fields)
        return spark.sql(f"SELECT {nulls} WHERE false")
    values = ", ".join("(" + ", ".join(_sql_literal(v) for v in r) + ")" for r in rows)
    cols = ", ".join(f"CAST(col{i + 1} AS {t}) AS `{n}`" for i, (n, t) in enumerate(fields))
    return spark.sql(f"SELECT {cols} FROM VALUES {values}")
