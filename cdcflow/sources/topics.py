"""Message topics: a broker where there is one, text files where there is not.

A message is one JSON text in ``value``. On files a topic is a folder with one
message per line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROKER = "kafka"


def stream_change_topic(
    spark: SparkSession,
    fmt: str = BROKER,
    options: dict[str, str] | None = None,
    max_per_trigger: int | None = None,
    path: str | None = None,
) -> DataFrame:
    """Unbounded messages from the beginning of a topic.

    A batch takes all there is unless ``max_per_trigger`` limits it, which counts messages on a broker and files elsewhere. A broker topic is
    named by the ``subscribe`` option, a file topic by ``path``.
    """
    reader = spark.readStream.format(fmt)
    if fmt == BROKER:
        reader = reader.option("startingOffsets", "earliest")
        limit = "maxOffsetsPerTrigger"
    else:
        limit = "maxFilesPerTrigger"
        if fmt != "text":
            reader = reader.schema("key string, value string")
    if max_per_trigger is not None:
        reader = reader.option(limit, str(max_per_trigger))
    reader = reader.options(**(options or {}))
    return reader.load(path) if path else reader.load()


def as_messages(df: DataFrame, key: str | None = None) -> DataFrame:
    """Records as JSON messages; a ``value`` column already is the message.

    Messages of one ``key`` stay in order in one broker partition.
    """
    value = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    if "value" in df.columns:
        value = F.col("value")
    named = [F.col(key).cast("string").alias("key")] if key else []
    return df.select(*named, value.cast("string").alias("value"))


def publish_topic(
    df: DataFrame,
    topic: str,
    fmt: str = BROKER,
    options: dict[str, str] | None = None,
    path: str | None = None,
    key: str | None = None,
    mode: str = "append",
):
    """Send records to a topic.

    A streaming ``df`` gives the started query (``options`` then hold its
    ``checkpointLocation``); a batch is written at once. A text topic fails on a message
    with a line break, which would come back as several; other formats take it.
    """
    messages = as_messages(df, key)
    options = dict(options or {})
    if fmt == BROKER:
        options["topic"] = topic
    elif fmt == "text":
        refused = F.raise_error(F.lit("a message with a line break cannot be a line of text"))
        broken = F.col("value").rlike("[\r\n]")
        messages = messages.select(F.when(broken, refused).otherwise(F.col("value")).alias("value"))
    location = None if fmt == BROKER else f"{path}/{topic}"
    if df.isStreaming:
        query = messages.writeStream.format(fmt).options(**options)
        return query.start(location) if location else query.start()
    writer = messages.write.format(fmt).options(**options).mode(mode)
    return writer.save(location) if location else writer.save()
