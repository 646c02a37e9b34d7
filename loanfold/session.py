"""Session settings and the shared folder for data that must outlive an executor."""

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Bytes of input files for each shuffle partition. Its rows are wider once they are read and joined: by the loan tables some 30 times.
BYTES_A_PARTITION = 1 << 20
#: Most bytes that a task of a sized session reads: of files, and of shuffled rows where Spark merges partitions.
TASK_BYTES = 4 << 20
#: Most bytes of a table that a sized session sends to every task: as counted in files and shuffles, where rows are packed.
BROADCAST_BYTES = 1 << 20
#: Whether Spark removes what a query shuffled as soon as the query ends, not when the driver next collects its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Folders made below the shared one since the outermost scratch() began.
_made: list[str] = []
#: Temporary folders of sessions on one machine; they go when Python ends.
_local: list[tempfile.TemporaryDirectory] = []


def local_session(cpus: int = 8, name: str = "loanfold", memory: str = "8g") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def sized_session(spark: SparkSession, files: Iterable[str]) -> SparkSession:
    """The given session, or one beside it whose shuffle partitions are as many as these input files ask for.

    A task sorts a partition of each side of a join at once. With too few partitions each sort spills many times, and the
    buffers of the spilled parts fill the heap. The session beside it has the same catalog and settings, but for this number,
    smaller tasks and smaller broadcasts; the given session is left as it is.
    """
    wanted = -(-sum(map(_bytes_of(spark), files)) // BYTES_A_PARTITION)
    if wanted <= int(spark.conf.get("spark.sql.shuffle.partitions")):
        return spark
    sized = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if sized.conf.get(key, None) != value:
            sized.conf.set(key, value)
    sized.conf.set("spark.sql.shuffle.partitions", wanted)
    for key, most in (("spark.sql.files.maxPartitionBytes", TASK_BYTES), ("spark.sql.adaptive.advisoryPartitionSizeInBytes", TASK_BYTES),
                      ("spark.sql.autoBroadcastJoinThreshold", BROADCAST_BYTES)):
        sized.conf.set(key, min(most, _conf_bytes(spark, key)))
    return sized


def _bytes_of(spark: SparkSession) -> Callable[[str], int]:
    """Gives the bytes of a file or folder; 0 where there is none."""
    jvm, hadoop = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def size(name: str) -> int:
        path = jvm.org.apache.hadoop.fs.Path(name)
        system = path.getFileSystem(hadoop)
        return system.getContentSummary(path).getLength() if system.exists(path) else 0

    return size


def _conf_bytes(spark: SparkSession, key: str) -> int:
    """A size setting in bytes, whatever its unit; -1 stays."""
    value = spark.conf.get(key)
    return int(value) if value.startswith("-") else spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(value)


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. On one machine, where it is unset, a temporary folder."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    _local.append(tempfile.TemporaryDirectory(prefix="loanfold-", ignore_cleanup_errors=True))
    context.setCheckpointDir(_local[-1].name)
    return context.getCheckpointDir()


def checkpointed(df: DataFrame, name: str = "rows") -> DataFrame:
    """Write df to the shared folder and read it back, which cuts its lineage. Runs one job."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settled(df: DataFrame, name: str = "rows", path: str | None = None) -> DataFrame:
    """As checkpointed, for steps of large builds: the file is packed more tightly, and what the step shuffled goes when it is written.

    Several steps of a query then need the disk of the largest one, not of all of them.
    """
    spark = df.sparkSession
    path, before = path or scratch_path(spark, name), spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    _made.append(f"{shared_folder(spark).rstrip('/')}/loanfold/{name}-{uuid.uuid4().hex}")
    return _made[-1]


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove the folders that are made inside when the block ends, whether it fails or not."""
    first = len(_made)
    try:
        yield
    finally:
        jvm = spark.sparkContext._jvm
        for folder in _made[first:]:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        del _made[first:]
