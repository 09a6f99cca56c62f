"""Session helpers: a local session for tests and benchmarks, and shuffle sizing for large inputs."""

import os

from pyspark.sql import SparkSession

_SHUFFLE_TARGET = 128 * 1024 * 1024
# Beyond this many partitions their size grows with the input as well: map tasks times partitions is what a shuffle's
# bookkeeping has to hold.
_WIDE = 1000
# Columnar files unfold to several times their size as shuffle rows.
_UNFOLD = 4


def local_session(name: str, cpus: int | None = None, memory: str = "20g", **conf: str) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    cpus = cpus or os.cpu_count()
    builder = (SparkSession.builder.master(f"local[{cpus}]").appName(name)
               .config("spark.ui.enabled", "false")
               .config("spark.driver.memory", memory)
               .config("spark.sql.shuffle.partitions", str(cpus))
               .config("spark.sql.session.timeZone", "UTC")
               # do not look up the Python call site of every column expression
               .config("spark.python.sql.dataFrameDebugging.enabled", "false"))
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of a file or folder in whatever file system holds it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(target).getLength()


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in whatever file system."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def size_shuffles(spark: SparkSession, *inputs: str) -> int:
    """Raise the shuffle partitions for the given inputs; never lower them.

    Partitions hold about 128 MB up to a thousand of them; from there their number grows with the square root of the
    input only, and rows that outgrow a task's memory are spilled. AQE merges partitions that turn out small, but
    nothing splits ordinary partitions that are too large.
    """
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = sum(stored_bytes(spark, p) for p in inputs) * _UNFOLD // _SHUFFLE_TARGET
    if wanted > _WIDE:
        wanted = int((wanted * _WIDE) ** 0.5)
    if wanted > current:
        spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    return max(current, wanted)

