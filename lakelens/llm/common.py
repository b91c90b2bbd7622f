"""Shared pieces of the training-data operators: table access, shared storage, fixed-size row filters."""

from __future__ import annotations

import math
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space; words are the maximal runs of anything else.
WHITE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
#: While a table is written: its shuffle files go at the end, and workers get few rows at once, as texts and sets are long.
WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_root(spark: SparkSession) -> str:
    """The folder that the driver and all executors share. Where the session names none, a local master gets a temporary
    one, as in tests; on a cluster it would be another one on every machine, so there it is an error."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not (sc.master or "").startswith("local") or (sc.master or "").startswith("local-cluster") and not named:
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir(named or "file://" + tempfile.mkdtemp(prefix="lakelens-"))
    return sc.getCheckpointDir()


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Writes df to the shared folder and reads it back: cuts lineage, and any executor can reread it. The shuffle files
    of the write go when it ends, as nothing needs them once the table is there."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    before = {k: spark.conf.get(k) for k in WRITING}
    for k, v in WRITING.items():
        spark.conf.set(k, v)
    try:
        df.write.parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    trim_driver(spark)
    table = spark.read.schema(df.schema).parquet(path)
    table.shared_path = path
    return table


def trim_driver(spark: SparkSession) -> bool:
    """Memory that the driver's JVM has freed outside its heap goes back to the system. Each query is planned, compiled and
    broadcast by many threads, and what glibc keeps of theirs, some 200 MB after a few hundred queries, counts as the driver's.
    False where the JVM has no such command (it is for Linux, from JDK 17.0.9 on): then that memory stays as it is."""
    jvm, array = spark._jvm, spark.sparkContext._gateway.new_array
    types, values = array(jvm.java.lang.Class, 4), array(jvm.java.lang.Object, 4)
    named = jvm.java.lang.Class.forName
    for k, kind in enumerate(("javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;")):
        types[k] = named(kind)
    values[0], values[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
    try:  # by the interface's method, as the server's own class is not open to calls
        named("javax.management.MBeanServer").getMethod("invoke", types).invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), values)
    except Py4JJavaError:
        return False
    return True


def discard(*tables: DataFrame) -> None:
    """Deletes tables that materialize wrote, once all that reads them is written itself."""
    for x in tables:
        path = x.sparkSession._jvm.org.apache.hadoop.fs.Path(x.shared_path)
        path.getFileSystem(x.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def numbered(docs: DataFrame, **columns: Column) -> DataFrame:
    """A table of the rows with their place in the scan, a key that even repeated rows don't share: _row, the given columns
    and rec, a struct of all columns of docs, so that no name of theirs can clash. It is written once and read by every
    later pass, as a second scan may be split differently and number its rows otherwise."""
    return materialize(docs.select(F.monotonically_increasing_id().alias("_row"), *[v.alias(k) for k, v in columns.items()], F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("rec")), "numbered")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def single_pass(docs: DataFrame, columns: list[str]) -> DataFrame:
    """Only the columns an operator reads, so that others (clashing names too) never enter its plan."""
    return docs.select(*[docs[c] for c in columns])


# Row filters. A table of at most 2**MOST_LOG2 rows (key, bits) marks hashed keys; it is broadcast, as its size is bounded
# whatever the data: it has eight bits for each key up to that bound. A set bit says "maybe": what passes is then decided
# exactly, so a filter that fills up costs time and never a wrong row.
WORDS_LOG2, MOST_LOG2 = 16, 19


def words_for(keys: int) -> int:
    """The size of a filter for so many keys."""
    return min(MOST_LOG2, max(10, math.ceil(math.log2(max(1, keys / 8)))))


def bitmap(keys: DataFrame, key: Column, words_log2: int = WORDS_LOG2) -> DataFrame:
    h = F.xxhash64(key)
    return (
        keys.select(F.pmod(h, F.lit(1 << words_log2)).alias("_word"), F.shiftrightunsigned(h, 58).cast("int").alias("_bit"))
        .groupBy("_word")
        .agg(F.expr("bit_or(shiftleft(1L, _bit))").alias("_bits"))
    )


def maybe_in(rows: DataFrame, marks: DataFrame, key: Column, name: str, words_log2: int = WORDS_LOG2) -> DataFrame:
    """rows, of columns named here, with a boolean column: false if key is certainly not among the marked ones."""
    h = F.xxhash64(key)
    at = F.shiftrightunsigned(h, 58).cast("int")
    keyed = rows.withColumn("_word", F.pmod(h, F.lit(1 << words_log2))).withColumn("_at", at)
    return keyed.join(F.broadcast(marks), "_word", "left").withColumn(name, F.expr("coalesce(shiftright(_bits, _at) & 1, 0) = 1")).drop("_word", "_bits", "_at")


def drop_rows(rows: DataFrame, dropped: DataFrame) -> DataFrame:
    """rows of a numbered table without those whose _row is in dropped, a table. Only rows that a filter can't clear are shuffled."""
    size = words_for(dropped.count())
    marked = maybe_in(rows, bitmap(dropped, F.col("_row"), size), F.col("_row"), "_maybe", size)
    unsure = marked.where("_maybe").join(dropped.select("_row"), "_row", "left_anti")
    return marked.where("not _maybe").unionByName(unsure).drop("_maybe")
