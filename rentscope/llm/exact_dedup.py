"""Exact duplicates by a stream with keyed state on disk.

Each row is fed to a stateful aggregation as digest, identifier and locator (file and row of
the text). Its state lives in RocksDB, has no expiry and keeps per digest the identifier and
locator of the row that stays, and a count. On a hit, meaning any digest seen more than once,
the whole texts are fetched by their digest and compared with the text at the kept locator, byte by
byte; if two texts ever share a digest, their rows are grouped again by the text itself.

Defined cases: a null text is empty; a null identifier ranks lowest; among rows with the
largest identifier the one with the greatest locator stays, so one row of a group stays even if
rows repeat; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentscope.llm.common import fresh
from rentscope.session import materialise, scratch_path

STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Many small stores: without this each one takes megabytes of disk in advance.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
FILES_PER_BATCH = 5_000
DIGEST_CHARS = 64
FEED = "doc_id long, text_sha256 string, digest string, file string, row long"
PLACE = ["file", "row"]


def located(docs: DataFrame, columns: list) -> DataFrame:
    """The columns with the file and row they stand in; a table that is not read from files
    is written first."""
    try:
        place = docs.metadataColumn("_metadata")
        return docs.select(*columns, place["file_path"].alias("file"), place["row_index"].alias("row"))
    except AnalysisException:
        return located(materialise(docs.select(*columns), "exact-input"), ["*"])


def _columns() -> list:
    return [
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ]


def _own_session(spark: SparkSession) -> SparkSession:
    """A session with the same settings, and the state store's, which queries beside it do not see."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if own.conf.isModifiable(key):
            own.conf.set(key, value)
    # Not all of these are known as settings before a store reads them.
    for key, value in STATE_STORE.items():
        own.conf.set(key, value)
    return own


def seen_groups(feed_path: str, spark: SparkSession, files_per_batch: int) -> DataFrame:
    """Digest, count and kept row of every digest, as the stream's state has them at its end."""
    stream = (
        _own_session(spark).readStream.schema(FEED)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(feed_path)
        .groupBy("digest")
        .agg(F.max(F.struct("doc_id", "file", "row")).alias("keep"), F.count(F.lit(1)).alias("n"))
    )
    out = scratch_path(spark, "exact-state")

    def store(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{out}/batch={batch}")

    query = (
        stream.writeStream.outputMode("update")
        .option("checkpointLocation", scratch_path(spark, "exact-checkpoint"))
        .trigger(availableNow=True)
        .foreachBatch(store)
        .start()
    )
    query.awaitTermination()
    kept = "struct<doc_id: long, file: string, row: long>"
    changes = spark.read.schema(f"digest string, keep {kept}, n long, batch int").parquet(out)
    # A digest is written again in each batch that meets it; the largest count is the last.
    last = changes.groupBy("digest").agg(F.max(F.struct("n", "keep")).alias("last"))
    return last.select("digest", "last.n", "last.keep")


def classes(
    docs: DataFrame, files_per_batch: int = FILES_PER_BATCH, digest_chars: int = DIGEST_CHARS
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, file, row."""
    spark = docs.sparkSession
    rows = located(docs, _columns()).withColumn("text_sha256", F.sha2("text", 256))
    rows = rows.withColumn("digest", F.substring("text_sha256", 1, digest_chars))
    feed_path = scratch_path(spark, "exact-feed")
    rows.select("doc_id", "text_sha256", "digest", "file", "row").write.parquet(feed_path)
    feed = spark.read.schema(FEED).parquet(feed_path)
    if feed.isEmpty():  # no file for the stream to read
        groups = spark.createDataFrame(
            [], "digest string, n long, keep struct<doc_id: long, file: string, row: long>"
        )
    else:
        groups = seen_groups(feed_path, spark, files_per_batch)
    repeated = materialise(groups.where("n > 1"), "exact-repeated")

    def verdict(frame: DataFrame) -> DataFrame:
        place = F.struct("doc_id", "file", "row")
        return frame.select(
            "doc_id",
            F.coalesce(F.col("keep"), place)["doc_id"].alias("keep_id"),
            F.coalesce(F.col("n"), F.lit(1)).alias("group_size"),
            F.coalesce(F.col("keep"), place).eqNullSafe(place).alias("kept"),
            "text_sha256",
            *PLACE,
        )

    by_digest = feed.join(repeated, "digest", "left")
    # The list grows with the table, so the join is the same at every size: it is not broadcast.
    hits = materialise(
        rows.select("digest", "doc_id", "text", "text_sha256", *PLACE).join(
            repeated.select("digest", "keep").hint("merge"), "digest"
        ),
        "exact-hits",
    )
    mixed = _mixed(hits)
    if mixed.isEmpty():
        return verdict(by_digest)
    again = hits.join(mixed, "digest", "left_semi").drop("keep")
    by_text = again.groupBy("digest", "text").agg(
        F.max(F.struct("doc_id", *PLACE)).alias("keep"), F.count(F.lit(1)).alias("n")
    )
    return verdict(by_digest.join(mixed, "digest", "left_anti")).unionByName(
        verdict(again.join(by_text, ["digest", "text"]))
    )


def _mixed(hits: DataFrame) -> DataFrame:
    """Digests with a text that differs from the one at the kept locator."""
    here = F.struct("doc_id", *PLACE)
    stays = hits.where(here.eqNullSafe(F.col("keep"))).select("digest", F.col("text").alias("kept_text"))
    differing = hits.join(stays, "digest").where(F.col("text") != F.col("kept_text"))
    # Stored before it is made distinct: a join with nothing behind it may split a hot digest.
    differing = materialise(differing.select("digest"), "exact-differing")
    return materialise(differing.distinct(), "exact-mixed")


def mark(docs: DataFrame, **options) -> DataFrame:
    """One row per document, dropped ones too."""
    return classes(docs, **options).drop(*PLACE)


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The rows that stay, with all their columns."""
    try:
        docs.select(docs.metadataColumn("_metadata")["row_index"])
    except AnalysisException:
        docs = materialise(docs, "exact-input")
    here, place = docs.metadataColumn("_metadata"), fresh("_place", docs)
    rows = docs.withColumn(place, F.struct(here["file_path"].alias("file"), here["row_index"].alias("row")))
    dropped = classes(docs, **options).where("not kept").select(F.struct(*PLACE).alias(place))
    return rows.join(materialise(dropped, "exact-dropped").hint("merge"), place, "left_anti").drop(place)
