"""Change-record sources.

``read_change_stream(spark, source)`` returns a streaming frame with a
``value`` column holding the record (binary from Kafka, text from files) and,
for Kafka, the usual ``key``/``topic``/``partition``/``offset``/``timestamp``.

* ``kafka``: needs the Kafka connector on the classpath (not in this image;
  the options are built and checked offline).  ``maxOffsetsPerTrigger`` is a
  total per trigger, split over the topic partitions.  ``minPartitions``
  splits a large offset range (a hot partition) over several tasks.
  Keys and values always arrive as binary; the parse casts them to text, so no
  deserializer options are set.
* ``files``: JSON text files, one record per line, read as text.
  ``maxFilesPerTrigger`` limits intake per micro-batch.

``read_change_batch`` is the bounded twin (same columns) for backfills.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..spec import SourceSpec

# The SCRAM login module of the Kafka client.
SCRAM_LOGIN_MODULE = "org.apache.kafka.common.security.scram.ScramLoginModule"


def kafka_options(source: SourceSpec) -> dict[str, str]:
    if not source.bootstrap_servers or not source.topics:
        raise ValueError("kafka source needs bootstrap_servers and topics")
    opts = {
        "kafka.bootstrap.servers": source.bootstrap_servers,
        "subscribe": source.topics,
        "startingOffsets": source.starting_offsets,
        "failOnDataLoss": "false",
    }
    if source.max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(int(source.max_offsets_per_trigger))
    if source.min_partitions:
        opts["minPartitions"] = str(int(source.min_partitions))
    if source.secure:
        opts.update(secure_options(source))
    opts.update({k: str(v) for k, v in (source.options or {}).items()})
    return opts


def secure_options(source: SourceSpec) -> dict[str, str]:
    def q(s: str) -> str:
        return s.replace("\\", "\\\\").replace('"', '\\"')

    jaas = (f'{SCRAM_LOGIN_MODULE} required username="{q(source.user)}" '
            f'password="{q(source.password)}";')
    return {
        "kafka.security.protocol": source.security_protocol,
        "kafka.sasl.mechanism": source.sasl_mechanism,
        "kafka.sasl.jaas.config": jaas,
    }


def file_options(source: SourceSpec) -> dict[str, str]:
    if not source.path:
        raise ValueError("files source needs a path")
    opts: dict[str, str] = {}
    if source.max_files_per_trigger:
        opts["maxFilesPerTrigger"] = str(int(source.max_files_per_trigger))
    opts.update({k: str(v) for k, v in (source.options or {}).items()})
    return opts


def read_change_stream(spark: SparkSession, source: SourceSpec) -> DataFrame:
    if source.kind == "kafka":
        return spark.readStream.format("kafka").options(**kafka_options(source)).load()
    if source.kind == "files":
        return spark.readStream.format("text").options(**file_options(source)).load(source.path)
    raise ValueError(f"unknown source kind: {source.kind!r}")


def read_change_batch(spark: SparkSession, source: SourceSpec) -> DataFrame:
    if source.kind == "kafka":
        opts = kafka_options(source)
        opts.pop("maxOffsetsPerTrigger", None)
        if source.starting_offsets == "latest":
            raise ValueError("a bounded read cannot start at the latest offsets: say earliest, or give offsets")
        return spark.read.format("kafka").options(**opts).load()
    if source.kind == "files":
        opts = file_options(source)
        opts.pop("maxFilesPerTrigger", None)
        return spark.read.format("text").options(**opts).load(source.path)
    raise ValueError(f"unknown source kind: {source.kind!r}")
