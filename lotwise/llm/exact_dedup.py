"""Exact dedup: a stream of digests folded into disk-backed keyed state, hits checked byte by byte.

Every row is entered in a ledger: its identifier, the digest of its text and the locator of its
content, which is the file and row it was read from. The ledger is read as a stream in bounded
micro-batches and folded by digest; the state lives in RocksDB, never expires, and retains per
digest the row that stays, its identifier and locator, and the number of rows seen. The state is
then read back as a table. Digests seen more than once are hits: the bytes of the row that stays
are fetched by its locator and compared with those of every other row of the digest. Rows with
the same digest but other bytes are told apart by the text itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.llm.rows import PLACE, located
from lotwise.sources.staging import stage, staged_path

STATE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # All stores of one executor share this much memory outside the heap.
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "64",
    # A store gives back its memory and its local files at the end of each micro-batch.
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}
# Rows of the ledger for which one store is opened, as long as shuffles have that many partitions.
ROWS_PER_STORE = 50_000
# Bytes of the ledger in one micro-batch at most, and micro-batches that a ledger is read in at
# least, as far as each has this many bytes. Every micro-batch opens all stores anew, and an
# executor keeps half a megabyte of native memory for each store that it ever opened.
BATCH_BYTES, LEAST_BATCHES, LEAST_BYTES = 16 << 30, 4, 4 << 20


def sha256(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def fold_stream(
    ledger: DataFrame, path: str, rows: int, batch_bytes: int = BATCH_BYTES
) -> DataFrame:
    """The state after all of the ledger at ``path``: ``_digest``, ``_keep`` and ``_seen``.

    ``_keep`` is identifier, file and row of the largest identifier. The fold combines rows in
    the tasks that read them, so a digest of a third of all rows reaches its state as a few rows.
    """
    spark = ledger.sparkSession
    checkpoint = staged_path(spark, "dedup-state")
    streaming = spark.newSession()
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stores = min(most, -(-rows // ROWS_PER_STORE))
    for key, value in {**STATE, "spark.sql.shuffle.partitions": str(stores)}.items():
        streaming.conf.set(key, value)
    entries = streaming.readStream.schema(ledger.schema).option("maxBytesPerTrigger", batch_bytes)
    folded = (
        entries.parquet(path)
        .groupBy("_digest")
        .agg(F.max(F.struct("_id", *PLACE)).alias("keep"), F.count(F.lit(1)).alias("seen"))
    )
    query = (
        folded.writeStream.outputMode("update")
        .format("noop")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    state = streaming.read.format("statestore").load(checkpoint)
    table = staged_path(spark, "dedup-groups")
    state.select(
        F.col("key._digest").alias("_digest"),
        F.col("value.max").alias("_keep"),
        F.col("value.count").alias("_seen"),
    ).write.parquet(table)
    return spark.read.parquet(table)


def _batch_bytes(spark: SparkSession, path: str, most: int) -> int:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    length = fs.getContentSummary(folder).getLength()
    return min(most, max(LEAST_BYTES, length // LEAST_BATCHES))


def _same_place(keep: Column) -> Column:
    return (keep[PLACE[0]] == F.col(PLACE[0])) & (keep[PLACE[1]] == F.col(PLACE[1]))


def colliding(docs: DataFrame, groups: DataFrame, digest) -> DataFrame:
    """Rows whose bytes differ from those of the row that stays for their digest.

    ``docs`` has ``_id``, ``_body`` and locators. The texts of hits are staged, so the rows of a
    digest meet the one row that stays in a join whose large side can be split.
    """
    body = F.coalesce("_body", F.lit(""))
    rows = docs.select("_id", *PLACE, body.alias("_body"), digest(F.col("_body")).alias("_digest"))
    hits = stage(rows.join(groups.filter("_seen > 1"), "_digest"), "dedup-hits")
    kept = hits.filter(_same_place(F.col("_keep")))
    kept = kept.select("_digest", F.col("_body").alias("_kept_body"))
    unequal = hits.join(kept, "_digest").filter(F.col("_body") != F.col("_kept_body"))
    return unequal.select("_digest", *PLACE, "_id", "_body")


def _judge(docs: DataFrame, digest, batch_bytes: int) -> DataFrame:
    """Every row of ``docs`` (``_id``, ``_body`` and locator) with its group."""
    spark = docs.sparkSession
    path = staged_path(spark, "dedup-ledger")
    docs.select("_id", digest(F.col("_body")).alias("_digest"), *PLACE).write.parquet(path)
    ledger = spark.read.parquet(path)
    rows = ledger.count()
    if not rows:
        one = F.lit(1).cast("long")
        groups = ledger.select("_digest", F.struct("_id", *PLACE).alias("_keep"), one.alias("_seen"))
    else:
        groups = fold_stream(ledger, path, rows, _batch_bytes(spark, path, batch_bytes))
    other = stage(colliding(docs, groups, digest), "dedup-collisions")

    less = other.groupBy("_digest").agg(F.count(F.lit(1)).alias("_less"))
    apart = other.groupBy("_digest", "_body").agg(
        F.max(F.struct("_id", *PLACE)).alias("_apart"), F.count(F.lit(1)).alias("_size")
    )
    apart = other.join(apart, ["_digest", "_body"]).select(*PLACE, "_apart", "_size")
    judged = (
        ledger.join(groups, "_digest", "left")
        .join(less, "_digest", "left")
        .join(apart, list(PLACE), "left")
    )
    keep = F.coalesce("_apart", "_keep")
    size = F.coalesce("_size", F.col("_seen") - F.coalesce("_less", F.lit(0)))
    return judged.select(
        "_id",
        *PLACE,
        keep["_id"].alias("keep_id"),
        size.alias("group_size"),
        _same_place(keep).alias("kept"),
        F.col("_digest").alias("digest"),
    )


def deduplicate(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    digest=sha256,
    batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``keep_id``, ``group_size``, ``kept``, ``digest``,
    and the file and row its content was read from, ``source_file`` and ``source_row``.

    Texts are equal if all their bytes are; a null text is an empty one. Of equal texts the row
    with the largest identifier stays, a null one being smallest. If an identifier repeats with
    the same text, the repetition read from the last place stays and the others do not; repeated
    identifiers with other texts are other documents. An empty table gives no rows. Other columns
    of ``docs`` are not read, whatever their names.
    """
    rows = located(docs.select(F.col(id_col).alias("_id"), F.col(text).alias("_body")))
    return _judge(rows, digest, batch_bytes).select(
        F.col("_id").alias(id_col),
        "keep_id",
        "group_size",
        "kept",
        "digest",
        F.col(PLACE[0]).alias("source_file"),
        F.col(PLACE[1]).alias("source_row"),
    )


def keep_distinct(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with the columns of ``docs``; rules as ``deduplicate``."""
    columns = docs.columns
    docs = located(docs)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text).alias("_body"), *PLACE)
    dropped = _judge(rows, sha256, BATCH_BYTES).filter(~F.col("kept")).select(*PLACE)
    return docs.join(dropped, list(PLACE), "left_anti").select(*columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return deduplicate(docs).select(
        "doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256")
    )


ORACLE = """
WITH hashed AS (
    SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256, coalesce(text, '') AS text FROM documents
)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
    doc_id = max(doc_id) OVER same AS kept, text_sha256
FROM hashed WINDOW same AS (PARTITION BY text)
"""
