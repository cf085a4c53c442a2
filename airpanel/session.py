"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JError, Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

_LOCAL_DIRS: dict[str, str] = {}
_SCOPES: list[list[str]] = []


def local_session(cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("airpanel")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        # The JVM leaves methods above 8000 bytes uncompiled unless told otherwise;
        # the generated code of wide rows is longer.
        .config("spark.driver.extraJavaOptions", "-XX:-DontCompileHugeMethods")
        .config("spark.ui.enabled", "false")
        # Wide plans of many short queries: keep their compiled code.
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a session whose executors are threads of the driver may go without the
    setting, as in tests: it gets a folder of its own. Elsewhere a machine-local
    folder would be lost with its executor, so a missing setting is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="airpanel-")
        atexit.register(shutil.rmtree, _LOCAL_DIRS[app], ignore_errors=True)
    return _LOCAL_DIRS[app]


def _hadoop(spark: SparkSession, path: str):
    """(file system, path) as the JVM knows them."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark._jsc.hadoopConfiguration()), there


def new_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing else uses.

    What is written there is deleted when the driver ends, or with the
    :func:`temporary_tables` that surround the call.
    """
    path = f"{shared_dir(spark).rstrip('/')}/airpanel/{name}-{uuid.uuid4().hex}"
    system, there = _hadoop(spark, path)
    system.deleteOnExit(there)
    for scope in _SCOPES:
        scope.append(path)
    return path


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables written inside are deleted at the end: read the result before that."""
    scope: list[str] = []
    _SCOPES.append(scope)
    try:
        yield
    finally:
        _SCOPES.remove(scope)
        for path in scope:
            system, there = _hadoop(spark, path)
            system.delete(there, True)


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once as a columnar table in the shared folder and read it back.

    Cuts the lineage where several passes follow. The table outlives executors,
    and later passes still prune columns and push filters into the scan.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release_memory(spark: SparkSession) -> bool:
    """Gives back to the system what the driver's JVM has freed and its C library keeps; whether the JVM can.

    The JVM's compiler takes and frees much such memory while a driver plans one query after the other. The
    command is that of ``jcmd <pid> System.trim_native_heap``, asked of the JVM's own management bean.
    """
    jvm = spark._jvm
    try:
        server = jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer()
        asked = jvm.java.lang.Class.forName("javax.management.MBeanServerConnection").getMethods()
        invoke = next(m for m in asked if m.getName() == "invoke")
        values = spark.sparkContext._gateway.new_array(jvm.java.lang.Object, 4)
        values[0] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand")
        values[1] = "systemTrimNativeHeap"
        invoke.invoke(server, values)
    except Py4JError:  # another C library, or a JVM without the command
        return False
    return True


def checkpointed(df: DataFrame) -> DataFrame:
    """``df.checkpoint()`` in the shared folder: keeps partitions and row order."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system, which is the default one if the path names none."""
    system, there = _hadoop(spark, path)
    return there.makeQualified(system.getUri(), system.getWorkingDirectory()).toString()


def exists(spark: SparkSession, path: str) -> bool:
    system, there = _hadoop(spark, path)
    return system.exists(there)


def is_folder(spark: SparkSession, path: str) -> bool:
    system, there = _hadoop(spark, path)
    return system.getFileStatus(there).isDirectory()


def publish(spark: SparkSession, written: str, path: str) -> None:
    """Rename the finished table ``written`` to ``path`` in one step, unless a finished table is there.

    Of several writers one succeeds; the tables of the others are deleted. Nothing that is at ``path`` is.
    """
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    system, there = _hadoop(spark, path)
    _, mine = _hadoop(spark, written)
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    never_over = gateway.new_array(rename, 1)
    never_over[0] = rename.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(mine, there, never_over)
    except Py4JJavaError:
        if not exists(spark, f"{path}/_SUCCESS"):
            raise
        system.delete(mine, True)
