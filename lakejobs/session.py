"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

# Settings the jobs rely on; sizes and memory stay with the cluster. Wide rows
# compile to methods the JVM will not optimise above 8000 bytes; past that
# Spark then splits the generated code.
REQUIRED = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Streaming state lives on disk next to the task, not in the JVM heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def require(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the jobs depend on to a session."""
    for key, value in REQUIRED.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = 8, app: str = "lakejobs", **extra: str) -> SparkSession:
    """Session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", "8g")
    )
    for key, value in {**REQUIRED, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, named by spark.checkpoint.dir.

    Only a local session may run without the setting; it then gets its own
    folder, which is remembered in the session.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    own = spark.conf.get("lakejobs.local.dir", None)
    if own:
        return own
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    own = tempfile.mkdtemp(prefix="lakejobs-")
    spark.conf.set("lakejobs.local.dir", own)
    return own


def new_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nothing has used yet."""
    return f"{_own_folder(spark)}/{label}-{uuid.uuid4().hex}"


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_root(spark)}/lakejobs/{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove everything this application wrote below the shared folder.

    Call it when all results have been written elsewhere: frames that read
    scratch copies fail afterwards.
    """
    delete_path(spark, _own_folder(spark))


def path_status(spark: SparkSession, path: str) -> str:
    """'absent', 'file' or 'directory', on whatever file system the path names."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(where):
        return "absent"
    return "directory" if fs.getFileStatus(where).isDirectory() else "file"


def listed(spark: SparkSession, path: str) -> list[tuple[str, datetime]]:
    """Name and last change of everything directly in a folder; nothing if it is absent."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(where):
        return []
    return [
        (s.getPath().getName(), datetime.fromtimestamp(s.getModificationTime() / 1000))
        for s in fs.listStatus(where)
    ]


def write_text_file(spark: SparkSession, path: str, text: str) -> None:
    """Write one small file on whatever file system the path names."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(where, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a file or folder that these jobs wrote."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Cut lineage: write once to the shared folder and read the copy back."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
