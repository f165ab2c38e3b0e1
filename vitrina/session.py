"""Session construction and shared-storage helpers."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

# Settings every job relies on: ANSI semantics, UTC, AQE with skew-join
# splitting and partition coalescing.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # delete reliable-checkpoint files once nothing references them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


# Whole-stage codegen fuses a cleaning projection into one large generated
# method; HotSpot refuses to JIT methods over 8000 bytes of bytecode unless
# told otherwise, and would interpret it instead.
JIT_OPTIONS = "-XX:-DontCompileHugeMethods"


def compiled_methods(spark: SparkSession) -> None:
    """For sessions that others built, whose JVMs may lack ``JIT_OPTIONS``: a stage
    whose fused method HotSpot would refuse runs operator by operator instead, in
    methods that it compiles. Results are the same."""
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")


# How stored tables are written: about a quarter smaller than Spark's default.
TABLE_OPTIONS = {"compression": "zstd"}

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def short_lived_shuffles(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of a query are removed when it has ended. Else they stay
    until the driver's garbage collector finds them unused, and a job of many queries holds
    those of most of them at once. For work whose results are stored: a DataFrame that is
    run again, or an iterator read after its query, would shuffle again. The caller's
    setting comes back afterwards."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "vitrina", extra: dict | None = None,
                  driver_memory: str = "8g") -> SparkSession:
    """Build (or reuse) a session with the defaults above.

    On a cluster the master and ``spark.checkpoint.dir`` come from the
    submit environment; locally the caller passes ``local[N]``.
    """
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master.startswith("local"):
        # local mode: the driver JVM is the only executor
        conf["spark.driver.memory"] = driver_memory
        conf["spark.driver.extraJavaOptions"] = JIT_OPTIONS
    else:
        conf.setdefault("spark.executor.extraJavaOptions", JIT_OPTIONS)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder for checkpoints and scratch tables.

    ``spark.checkpoint.dir`` - the cluster's shared folder - always wins.
    Only when it is unset on a local master (unit tests, a laptop) is a
    scratch folder of our own created; it is handed to ``setCheckpointDir``
    (a core setting cannot be changed through the SQL conf at run time). On a
    cluster an unset folder is an error: executors could not share ours.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by the driver and all executors")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(configured or tempfile.mkdtemp(prefix="vitrina-ckpt-"))
    return (configured or sc.getCheckpointDir()).rstrip("/")


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint directory."""
    return f"{ensure_checkpoint_dir(spark)}/vitrina/{name}-{uuid.uuid4().hex[:12]}"
