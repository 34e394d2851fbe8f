"""SRC-5 / SRC-6: flight messages as a streaming DataFrame.

Each message value is one concise CSV line (the key is ignored). Four inputs
give the same ``value`` column:

* ``kind="log"``: a partitioned message log in the shared folder, read by
  offsets (``aerolap.sources.log``); also gives ``partition`` and ``offset``.
* ``kind="recording"``: recorded messages in the order of their event times, at
  a chosen speed (``aerolap.sources.recording``); also gives ``at``.
* ``kind="kafka"``: ``readStream.format("kafka")`` subscribed to a comma list
  of topics. The Kafka connector jar is not in this container, so this path
  is written but not run here.
* ``kind="files"``: new text files appearing under a folder (the replay of
  recorded files, SRC-6), optionally capped per micro-batch.

``parsed_stream`` applies the same ``parse_concise`` as the batch readers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolap.sources.csv import parse_concise


def kafka_options(topics: str, bootstrap: str, starting_offsets: str = "latest",
                  max_offsets_per_trigger: int | None = None, fail_on_data_loss: bool = True,
                  options: dict | None = None) -> dict[str, str]:
    """Options of the Kafka reader: topics (comma list), where a new query
    starts, how much a micro-batch may take, and whether lost offsets stop it.
    ``options`` are passed on and win."""
    out = {"kafka.bootstrap.servers": bootstrap, "subscribe": topics,
           "startingOffsets": starting_offsets,
           "failOnDataLoss": str(fail_on_data_loss).lower()}
    if max_offsets_per_trigger:
        out["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return out | {k: str(v) for k, v in (options or {}).items()}


def message_stream(spark: SparkSession, kind: str = "files", path: str | None = None,
                   topics: str | None = None, bootstrap: str | None = None,
                   max_files_per_trigger: int | None = None,
                   options: dict | None = None, **kafka) -> DataFrame:
    """Streaming ``value STRING`` (plus partition columns of a file folder).

    ``kafka``: the further settings of ``kafka_options``; a log takes
    ``starting_offsets``, ``max_offsets_per_trigger`` and ``reader``, a
    recording ``speed`` and ``reader``.
    """
    if kind == "kafka":
        if not (topics and bootstrap):
            raise ValueError("kafka needs topics and bootstrap servers")
        r = spark.readStream.format("kafka").options(
            **kafka_options(topics, bootstrap, options=options, **kafka))
        return r.load().select(F.col("value").cast("string").alias("value"))
    if kind == "log" and path:
        from aerolap.sources.log import log_stream

        return log_stream(spark, path, kafka.get("starting_offsets", "latest"), kafka.get("max_offsets_per_trigger"),
                          kafka.get("reader"))
    if kind == "recording" and path:
        from aerolap.sources.recording import paced_stream

        return paced_stream(spark, path, kafka.get("speed", 1.0), kafka.get("reader", ""))
    if kind != "files" or not path:
        raise ValueError("kind must be 'files', 'log' or 'recording' (with path), or 'kafka'")
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r.load(path)


def parsed_stream(messages: DataFrame, keep: tuple[str, ...] = (), strict: bool = False) -> DataFrame:
    """PRJ-3 on a stream: typed flights with their parse report."""
    return parse_concise(messages, keep=keep, strict=strict)
