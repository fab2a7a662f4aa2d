"""Topic sources and sinks on Spark's Kafka connector.

The connector is a package of its own (``spark-sql-kafka-0-10``). Everything else works on frames
of the log shape, so only these functions need it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

# Defaults of every job.
BATCH_SIZE = 10_000
BATCH_TIMEOUT = "5s"

_LOGIN_MODULES = {
    "plain": ("PLAIN", "org.apache.kafka.common.security.plain.PlainLoginModule"),
    "scram-256": ("SCRAM-SHA-256", "org.apache.kafka.common.security.scram.ScramLoginModule"),
    "scram-512": ("SCRAM-SHA-512", "org.apache.kafka.common.security.scram.ScramLoginModule"),
    "oauth": ("OAUTHBEARER", "org.apache.kafka.common.security.oauthbearer.OAuthBearerLoginModule"),
    "aws": ("AWS_MSK_IAM", "software.amazon.msk.auth.iam.IAMLoginModule"),
}
_AWS_CALLBACK = "software.amazon.msk.auth.iam.IAMClientCallbackHandler"


def _jaas(module: str, settings: Mapping[str, str | None]) -> str:
    def quoted(value: str) -> str:
        return '"' + value.replace("\\", "\\\\").replace('"', '\\"') + '"'

    given = [f"{name}={quoted(value)}" for name, value in settings.items() if value]
    return " ".join([module, "required", *given]) + ";"


def sasl_options(
    protocol: str,
    user: str | None = None,
    password: str | None = None,
    is_token: bool = False,
    token: str | None = None,
    callback_handler: str | None = None,
    **login: str,
) -> dict[str, str]:
    """Connector options for a login; a login always runs over TLS.

    ``oauth`` takes its token through a callback handler class, which reads it from the login
    settings. ``aws`` reads the machine's own credentials unless ``login`` says otherwise.
    """
    if protocol not in _LOGIN_MODULES:
        raise ValueError(f"no login is called {protocol}; there are {', '.join(_LOGIN_MODULES)}")
    mechanism, module = _LOGIN_MODULES[protocol]
    settings: dict[str, str | None] = dict(login)
    if protocol in ("plain", "scram-256", "scram-512"):
        settings |= {"username": user, "password": password}
    if is_token and protocol.startswith("scram"):
        settings["tokenauth"] = "true"
    if protocol == "oauth":
        settings["token"] = token
    options = {
        "kafka.security.protocol": "SASL_SSL",
        "kafka.sasl.mechanism": mechanism,
        "kafka.sasl.jaas.config": _jaas(module, settings),
    }
    handler = callback_handler or (_AWS_CALLBACK if protocol == "aws" else None)
    if handler and protocol == "aws":
        options["kafka.sasl.client.callback.handler.class"] = handler
    elif handler:
        options["kafka.sasl.login.callback.handler.class"] = handler
    return options


def source_options(
    brokers: Sequence[str],
    topics: Sequence[str],
    group: str | None = None,
    workers_per_topic: int = 1,
    batch_size: int | None = BATCH_SIZE,
    fetch_max_bytes: int | None = None,
    fetch_max_partition_bytes: int | None = None,
    rebalance_timeout_ms: int | None = None,
    starting_offsets: str = "earliest",
    sasl: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options of a topic source: committed records only, headers included.

    ``batch_size`` limits what one trigger reads per topic and worker; None reads everything there
    is, which is what a large cluster wants. More workers mean more, smaller input tasks.
    """
    if not brokers or not topics:
        raise ValueError("brokers and topics must not be empty")
    options = {
        "kafka.bootstrap.servers": ",".join(brokers),
        "subscribe": ",".join(topics),
        "includeHeaders": "true",
        "startingOffsets": starting_offsets,
        "kafka.isolation.level": "read_committed",
    }
    if group:
        options["kafka.group.id"] = group
    if workers_per_topic > 1:
        options["minPartitions"] = str(workers_per_topic * len(topics))
    if batch_size:
        options["maxOffsetsPerTrigger"] = str(batch_size * workers_per_topic * len(topics))
    if fetch_max_bytes:
        options["kafka.fetch.max.bytes"] = str(fetch_max_bytes)
    if fetch_max_partition_bytes:
        options["kafka.max.partition.fetch.bytes"] = str(fetch_max_partition_bytes)
    if rebalance_timeout_ms:
        options["kafka.max.poll.interval.ms"] = str(rebalance_timeout_ms)
    return options | dict(sasl or {})


def sink_options(
    brokers: Sequence[str],
    compression: str | None = None,
    timeout_ms: int | None = None,
    sasl: Mapping[str, str] | None = None,
) -> dict[str, str]:
    if not brokers:
        raise ValueError("brokers must not be empty")
    options = {"kafka.bootstrap.servers": ",".join(brokers), "includeHeaders": "true"}
    if compression:
        options["kafka.compression.type"] = compression
    if timeout_ms:
        options["kafka.delivery.timeout.ms"] = str(timeout_ms)
    return options | dict(sasl or {})


_LOG_COLUMNS = ["topic", "partition", "offset", "timestamp", "key", "value", "headers"]


def read_topics(spark: SparkSession, options: Mapping[str, str], streaming: bool = True) -> DataFrame:
    """Topics as a log frame, unbounded or up to now."""
    if streaming:
        return spark.readStream.format("kafka").options(**options).load().select(_LOG_COLUMNS)
    bounded = {k: v for k, v in options.items() if k != "maxOffsetsPerTrigger"}
    return spark.read.format("kafka").options(**bounded).load().select(_LOG_COLUMNS)


def outgoing(messages: DataFrame, keep_partition: bool = False) -> DataFrame:
    """The columns a topic sink takes; ``partition`` only to send records back where they were."""
    columns = ["topic", "key", "value", "headers"]
    return messages.select(columns + (["partition"] if keep_partition else []))


def write_topics(
    messages: DataFrame, options: Mapping[str, str], keep_partition: bool = False
) -> None:
    """Send a bounded frame."""
    outgoing(messages, keep_partition).write.format("kafka").options(**options).save()


def stream_topics(
    messages: DataFrame, options: Mapping[str, str], checkpoint: str, timeout: str = BATCH_TIMEOUT
) -> DataStreamWriter:
    """Writer of an unbounded frame; the caller starts it."""
    from relayframe.streaming.triggers import every

    return (
        outgoing(messages)
        .writeStream.format("kafka")
        .options(**options)
        .option("checkpointLocation", checkpoint)
        .trigger(**every(timeout))
    )
