"""Session helpers: a local builder for tests and benches, and the shared work folder."""

import tempfile
import uuid
from contextlib import contextmanager
from functools import wraps

from pyspark.sql import SparkSession

# tables that only this package reads back are compressed harder than Spark's default
STORED = {"compression": "zstd"}
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cpus="*", app="daybrook", shuffle_partitions=8, memory="8g") -> SparkSession:
    """Session for tests and single-machine runs; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        # generated methods above this size are not JIT-compiled; wide typing projections run faster without them
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL_ROOTS = {}


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can see: the one the cluster names in ``spark.checkpoint.dir``.

    Where it is unset, only a local master, whose driver and executors are one process, may use a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[context.applicationId] = tempfile.mkdtemp(prefix="daybrook-")
    return _LOCAL_ROOTS[context.applicationId]


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared root."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def freeing(spark: SparkSession):
    """Within, a job's shuffle files go when the job ends, not when the driver happens to collect its garbage.

    For jobs whose result is stored or collected: nothing reads their shuffles again. The session's own setting returns after it.
    """
    before = spark.conf.get(_FREE_SHUFFLES, None)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREE_SHUFFLES)
        else:
            spark.conf.set(_FREE_SHUFFLES, before)


def frees_shuffles(run):
    """``run(spark, ...)`` within ``freeing``."""
    @wraps(run)
    def wrapped(spark, *args, **named):
        with freeing(spark):
            return run(spark, *args, **named)
    return wrapped


def release(stored):
    """Delete a table that ``materialize`` returned. Nothing that still has to run may read it."""
    spark = stored.sparkSession
    for path in {file.rpartition("/")[0] for file in stored.inputFiles()}:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def materialize(df, name: str):
    """Write once to the shared root and read back: cuts the lineage and survives lost executors."""
    path = work_path(df.sparkSession, name)
    with freeing(df.sparkSession):
        df.write.options(**STORED).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
