"""Exact deduplication with keyed streaming state on disk.

A streaming aggregation keeps, for each SHA-256 digest and without expiry, how often it came, the
identifier that stays (the largest) and where the content of that row lies (file and row number).
The state lives in RocksDB and is committed to the checkpoint after each micro-batch, so a lost
executor restores it and a later run with more files goes on from it. A row whose digest is held
by another row is a hit: both contents are fetched by their locators and compared byte by byte.

Defined results: a null text is empty; equal texts form one group whatever their other columns; the
row with the largest id stays, a null id is smaller than any other, and of rows that agree in text
and id the one with the larger locator stays, so one row of each group stays. Two different
texts with one digest stop the run (``raise_error``) rather than merge. An empty table gives an
empty result. Columns that are not asked for are never read, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldpan.llm.common import id_and_text, whole_text, without
from goldpan.storage import fresh_path, materialize

# State on disk, and a store is open only while its task runs: thousands of idle ones would hold
# files and memory on every executor.
_STATE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}
LOCATOR = ("locator_file", "locator_row")


@contextmanager
def _state_settings(spark: SparkSession) -> Iterator[None]:
    """Hold the settings while a streaming query starts, then put the session's own back."""
    before = {key: spark.conf.get(key, None) for key in _STATE}
    for key, value in _STATE.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def with_locator(docs: DataFrame) -> DataFrame:
    """The rows with ``locator_file`` and ``locator_row``: a place that reads alike every time.

    A frame that is not a plain scan of files is written to the shared folder first.
    """

    def located(frame: DataFrame) -> DataFrame:
        return frame.select(
            "*",
            F.xxhash64("_metadata.file_path").alias(LOCATOR[0]),
            F.col("_metadata.row_index").alias(LOCATOR[1]),
        )

    try:
        return located(docs)
    except AnalysisException:
        path = fresh_path(docs.sparkSession, "content")
        docs.write.parquet(path)
        return located(docs.sparkSession.read.schema(docs.schema).parquet(path))


def digest_stream(spark: SparkSession, path: str, files_per_batch: int) -> DataFrame:
    """The landed digests under ``path`` as a stream; files added later are new input."""
    schema = "digest string, doc_id long, locator_file long, locator_row long"
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def update_state(stream: DataFrame, checkpoint: str) -> None:
    """Take all input that is there into the keyed state of ``checkpoint``, then stop."""
    held = stream.groupBy("digest").agg(
        F.max(F.struct("doc_id", *LOCATOR)).alias("keeper"), F.count(F.lit(1)).alias("group_size")
    )
    with _state_settings(stream.sparkSession):
        (
            held.writeStream.format("noop")
            .outputMode("update")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
            .awaitTermination()
        )


def read_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """digest, keeper (id and locator) and group_size of every key in the state."""
    state = spark.read.format("statestore").load(checkpoint)
    keeper, count = state.schema["value"].dataType.names
    return state.select(
        F.col("key.digest").alias("digest"),
        F.col("value")[keeper].alias("keeper"),
        F.col("value")[count].alias("group_size"),
    )


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    files_per_batch: int = 10_000,
    rows_per_check: int = 64,
) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256 and the locator.

    ``files_per_batch`` bounds a micro-batch. ``rows_per_check`` splits a large group: its kept
    content is compared with that many hits in one place, then with the next ones elsewhere.
    """
    content = with_locator(id_and_text(docs, id_col, text_col))
    return _judge(content, files_per_batch, rows_per_check)


def drop_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    files_per_batch: int = 10_000,
    rows_per_check: int = 64,
) -> DataFrame:
    """The rows that stay, with all their columns."""
    content = with_locator(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            whole_text(text_col).alias("text"),
            F.struct("*").alias("row"),
        )
    )
    gone = _judge(content.drop("row"), files_per_batch, rows_per_check).filter("not kept").select(*LOCATOR)
    rows = without(content.select("row", *LOCATOR), materialize(gone, "copies"), list(LOCATOR))
    return rows.select("row.*")


def _judge(content: DataFrame, files_per_batch: int, rows_per_check: int) -> DataFrame:
    spark = content.sparkSession
    landed, checkpoint = fresh_path(spark, "digests"), fresh_path(spark, "digest-state")
    content.select(F.sha2("text", 256).alias("digest"), "doc_id", *LOCATOR).write.parquet(landed)
    update_state(digest_stream(spark, landed, files_per_batch), checkpoint)
    digests = spark.read.schema("digest string, doc_id long, locator_file long, locator_row long").parquet(landed)

    judged = digests.join(read_state(spark, checkpoint), "digest")
    is_keeper = (F.col("keeper.locator_file") == F.col(LOCATOR[0])) & (
        F.col("keeper.locator_row") == F.col(LOCATOR[1])
    )
    judged = judged.select(
        "doc_id",
        F.col("keeper.doc_id").alias("keep_id"),
        "group_size",
        is_keeper.alias("kept"),
        F.col("digest").alias("text_sha256"),
        *LOCATOR,
    )
    parts = F.ceil(F.col("group_size") / rows_per_check).cast("int")
    contested = judged.filter("group_size > 1").withColumn(
        "part", F.pmod(F.xxhash64(*LOCATOR), F.lit(1_000_003)).cast("int") % parts
    )
    texts = content.select("text", *LOCATOR).join(contested.hint("shuffle_hash"), list(LOCATOR))
    hits = texts.filter("not kept")
    keepers = texts.filter("kept").select(
        "text_sha256", F.col("text").alias("kept_text"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("part")
    )
    compared = hits.join(keepers, ["text_sha256", "part"]).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.when(F.col("text") == F.col("kept_text"), F.lit(False))
        .otherwise(F.raise_error(F.lit("different texts share a digest")).cast("boolean"))
        .alias("kept"),
        "text_sha256",
        *LOCATOR,
    )
    return judged.filter("kept").unionByName(compared)
