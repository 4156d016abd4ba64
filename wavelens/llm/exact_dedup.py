"""Exact deduplication as a stateful stream.

A stream of document digests is aggregated into keyed state without expiry, kept on
disk by RocksDB: for each digest the smallest stable identifier seen, where its content
lies, and how many documents have it. The state outlives a run: the same checkpoint
folder goes on with new files. Equal digests are only a hit; the full bytes decide, those
of earlier runs too, whose texts are kept beside the checkpoint.
"""

from __future__ import annotations

import uuid
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wavelens.llm.common import among, filled
from wavelens.session import scratch_path, stored

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: Input of one micro-batch, in bytes of digest files.
BATCH_BYTES = 64 << 30


def normalised(text: str | Column = "text") -> Column:
    """Every run of ASCII blanks as one space; null as empty."""
    spaces = F.translate(filled(text), "\t\n\x0b\x0c\r", "     ")
    return F.when(F.contains(spaces, F.lit("  ")), F.regexp_replace(spaces, " {2,}", " ")).otherwise(spaces)


def _digest() -> Column:
    return F.unhex(F.sha2(normalised(), 256))


def digests(docs: DataFrame) -> DataFrame:
    """``(doc_id, row, locator, digest)`` for each row of ``(doc_id, text)``.

    ``row`` tells rows of one ``doc_id`` apart; ``locator`` is the file a row came from
    (empty for frames that have none).
    """
    return docs.select(
        "doc_id",
        F.monotonically_increasing_id().alias("row"),
        F.input_file_name().alias("locator"),
        _digest().alias("digest"),
    )


def keep_state(stream: DataFrame, checkpoint: str) -> None:
    """Fold all that is new in a stream of ``digests`` into the state at ``checkpoint``.

    Null identifiers are larger than any other. Groups are pre-aggregated in each task,
    so a digest that a third of all rows share is one row per task.
    """
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "row", "locator"))
    state = stream.groupBy("digest").agg(first.alias("keep"), F.count(F.lit(1)).alias("n"))
    query = (
        state.writeStream.format("noop").outputMode("update")
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def read_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``(digest, keep, group_size)`` as the state holds it."""
    return spark.read.format("statestore").load(checkpoint).select(
        F.col("key.digest").alias("digest"),
        F.col("value.min").alias("keep"),
        F.col("value.count").alias("group_size"),
    )


def stream_of(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.readStream.schema(schema).option("maxBytesPerTrigger", str(BATCH_BYTES)).parquet(path)


def collisions(docs: DataFrame, state: DataFrame) -> DataFrame:
    """Digests whose documents differ in their bytes, after reading all hits in full.

    A broadcast filter of fixed size leaves the documents that may be hits; of these, the
    smallest and the largest text of a digest are found in each task before anything
    moves, so a hot group sends two texts per task. Both are equal only if all are. What
    the filter lets through too much are groups of one text.
    """
    hits = state.filter("group_size > 1").select(F.xxhash64("digest").alias("key"))
    texts = docs.select(_digest().alias("digest"), normalised().alias("text")).withColumn("key", F.xxhash64("digest"))
    spread = among(texts, hits).groupBy("digest").agg(F.min("text").alias("low"), F.max("text").alias("high"))
    return spread.filter("low <> high").select("digest")


def exact_dedup(docs: DataFrame, checkpoint: str | None = None) -> DataFrame:
    """Per row of ``(doc_id, text)``: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when they are after every run of ASCII blanks became one space; null
    counts as empty. The row with the smallest ``doc_id`` stays; of rows that repeat
    this ``doc_id``, one stays. A null ``doc_id`` stays only when no other has its text.

    With a ``checkpoint``, rows of earlier runs count too; every run keeps its rows in a
    folder of its own below ``<checkpoint>-texts``, where locators lead, and adds its
    digests to ``<checkpoint>-log``.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    root = None
    if checkpoint:
        root = f"{checkpoint.rstrip('/')}-texts"
        batch = f"{root}/run-{uuid.uuid4().hex}"
        docs.write.parquet(batch)
        docs = spark.read.schema(docs.schema).parquet(batch)
    log_path = scratch_path(spark, "digests")
    digests(docs).write.parquet(log_path)
    log = spark.read.parquet(log_path)
    session = rocksdb_session(spark)
    earlier = earlier_keepers(docs, log, session, checkpoint) if checkpoint else None
    if checkpoint:  # a stream goes on only in the folder where it began
        log_path = f"{checkpoint.rstrip('/')}-log"
        log.write.mode("append").parquet(log_path)
    checkpoint = checkpoint or scratch_path(spark, "dedup-state")
    keep_state(stream_of(session, log_path, log.schema), checkpoint)
    state_path = scratch_path(spark, "state")
    read_state(session, checkpoint).write.parquet(state_path)
    state = spark.read.parquet(state_path)
    compared = docs if earlier is None else docs.unionByName(earlier)
    clashes = stored(collisions(compared, state), "collisions")
    if clashes.isEmpty():
        return resolve(docs, log, state, None)
    if root is None:
        return resolve(docs, log, state, clashes)
    every = spark.read.schema(docs.schema).parquet(f"{root}/run-*")
    return resolve(every, log, state, clashes, F.contains(F.input_file_name(), F.lit(batch.rsplit("/", 1)[1])))


def earlier_keepers(docs: DataFrame, log: DataFrame, session: SparkSession, checkpoint: str) -> DataFrame | None:
    """Rows of the files to which the locators lead of earlier keepers that ``log`` hits."""
    spark = docs.sparkSession
    commits = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint.rstrip('/')}/commits")
    if not commits.getFileSystem(spark._jsc.hadoopConfiguration()).exists(commits):
        return None
    path = scratch_path(spark, "earlier-state")
    read_state(session, checkpoint).select("digest", F.col("keep.locator").alias("locator")).write.parquet(path)
    hits = stored(spark.read.parquet(path).join(log.select("digest").distinct(), "digest"), "earlier-hits")
    files = [unquote(r["locator"]) for r in hits.select("locator").distinct().collect()]
    if not files:
        return None
    return spark.read.schema(docs.schema).parquet(*files)


def rocksdb_session(spark: SparkSession) -> SparkSession:
    """A session beside ``spark`` whose streaming state lives in RocksDB, within bounds."""
    session = spark.newSession()
    session.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    session.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage", "true")
    # many partitions with little state each: no space set aside for logs
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false")
    return session


def resolve(
    docs: DataFrame, log: DataFrame, state: DataFrame, clashes: DataFrame | None, own: Column | None = None
) -> DataFrame:
    """What becomes of each row; documents of clashing digests are told apart by their text.

    Where ``docs`` holds rows of earlier runs too, ``own`` is true for those of this one.
    """
    is_keeper = F.col("doc_id").eqNullSafe(F.col("keep.doc_id")) & (F.col("row") == F.col("keep.row"))
    clear = log if clashes is None else log.join(clashes, "digest", "left_anti")
    out = clear.join(state, "digest").select(
        "doc_id",
        F.col("keep.doc_id").alias("keep_id"),
        "group_size",
        (is_keeper & F.col("locator").eqNullSafe(F.col("keep.locator"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
    if clashes is None:
        return out
    texts = docs.select(
        "doc_id", _digest().alias("digest"), F.sha2(normalised(), 256).alias("text_sha256"), normalised().alias("text"),
        (F.lit(True) if own is None else own).alias("own"), F.monotonically_increasing_id().alias("row"),
    )
    texts = stored(texts.join(clashes, "digest", "left_semi"), "clashing")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "row")).alias("keep")
    groups = texts.groupBy("text").agg(first, F.count(F.lit(1)).alias("group_size"))
    told = texts.filter("own").join(groups, "text").select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size", is_keeper.alias("kept"), "text_sha256",
    )
    return out.unionByName(told)
