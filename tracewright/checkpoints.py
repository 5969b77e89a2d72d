"""Settling intermediate rows, and dense global row numbers without a single task."""

from __future__ import annotations

import re
import tempfile
import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def checkpoint_folder(spark: SparkSession) -> None:
    """Make sure that settled rows have a folder: the one of spark.checkpoint.dir.

    Where that is unset, a local session gets one below its temporary folder; on a
    cluster that would be a machine's own, so there the setting must be made.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = f"{tempfile.gettempdir()}/tracewright-{uuid.uuid4().hex}"
    context.setCheckpointDir(folder)


#: Seconds between two releases at least; when the last one was.
PAUSE = 2.0
_released = 0.0


def release(spark: SparkSession) -> None:
    """Let the driver collect its garbage and give free memory back, at most every PAUSE seconds.

    Spark deletes broadcasts and settled rows that nothing needs any more only once
    the driver's JVM finds their handles dead, and that JVM gives memory back only
    then; left to itself it does neither before its heap is full.  What is freed
    outside the heap, by compiling each plan's code above all, stays with the C
    library's allocator, more after every plan, until that is told to trim.
    """
    global _released
    if time.monotonic() - _released >= PAUSE:
        spark.sparkContext._jvm.System.gc()
        _trim(spark)
        _released = time.monotonic()


def _trim(spark: SparkSession) -> None:
    """Have the driver's JVM return free native memory to the system, where it has a command for that (OpenJDK from 17.0.9, on Linux)."""
    jvm = spark.sparkContext._jvm
    # the server's class is closed to reflection, its interface is open
    invoke = next(m for m in jvm.java.lang.Class.forName("javax.management.MBeanServer").getMethods() if m.getName() == "invoke")
    args = spark.sparkContext._gateway.new_array(jvm.java.lang.Object, 4)
    args[0], args[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
    try:
        invoke.invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), args)
    except Py4JJavaError:
        pass  # this JVM has no such command; its allocator keeps what it has


#: Spark's switch for deleting the shuffle files of a query as it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def settle(df: DataFrame) -> DataFrame:
    """The rows written once to the shared folder, so that later stages neither recompute nor lose them.

    They need no shuffle files any more, so those go as soon as the rows are written.
    """
    spark = df.sparkSession
    checkpoint_folder(spark)
    release(spark)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        return df.select("*").checkpoint(eager=True)  # planned anew, as a plan has the switch from its beginning
    finally:
        spark.conf.set(_CLEANUP, before)


def number_rows(df: DataFrame, *order: str, name: str = "idx") -> DataFrame:
    """``df`` with dense numbers 0, 1, ... by the order columns, settled.

    Rows are range-partitioned by the order and numbered inside their partition;
    only the partitions' row counts meet on the driver.
    """
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_mid", F.monotonically_increasing_id())
    dealt = settle(dealt.withColumn("_pid", F.shiftright("_mid", 33)).withColumn("_local", F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))))
    counts = dealt.groupBy("_pid").count().orderBy("_pid").collect()  # one row a partition
    start, offsets = 0, []
    for row in counts:
        offsets += [F.lit(row["_pid"]), F.lit(start)]
        start += row["count"]
    base = F.element_at(F.create_map(*offsets), F.col("_pid")) if offsets else F.lit(0)
    return dealt.withColumn(name, (base + F.col("_local")).cast("long")).drop("_mid", "_pid", "_local")


def running_count(numbered: DataFrame, flag: str, idx: str, name: str) -> DataFrame:
    """``numbered`` with how many rows up to each have the flag; blocks of rows sum apart and meet by offsets."""
    from pyspark.sql import Window

    block = F.shiftright(idx, 16)
    rows = numbered.withColumn("_block", block)
    sums = rows.groupBy("_block").agg(F.sum(F.col(flag).cast("long")).alias("_n"))
    before = sums.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    inside = Window.partitionBy("_block").orderBy(idx).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn("_in", F.sum(F.col(flag).cast("long")).over(inside)).join(before, "_block").withColumn(name, F.col("_before") + F.col("_in")).drop("_block", "_in", "_before")
