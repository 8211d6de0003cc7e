"""Tick messages as a stream with a `value` column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PLAIN_LOGIN = "org.apache.kafka.common.security.plain.PlainLoginModule"


def kafka_options(bootstrap_servers: str, topic: str, user: str | None = None,
                  password: str | None = None, starting_offsets: str = "earliest",
                  login_module: str = PLAIN_LOGIN, **extra: str) -> dict[str, str]:
    """Options of Spark's Kafka source; with a user, SASL PLAIN over TLS."""
    options = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
    }
    if user is not None:
        options |= {
            "kafka.security.protocol": "SASL_SSL",
            "kafka.sasl.mechanism": "PLAIN",
            "kafka.sasl.jaas.config":
                f'{login_module} required username="{user}" password="{password}";',
            "kafka.ssl.endpoint.identification.algorithm": "https",
        }
    return options | extra


def tick_stream(spark: SparkSession, kind: str = "kafka", path: str | None = None,
                **options: str) -> DataFrame:
    """Stream of JSON payloads in `value`.

    kind   "kafka": needs Spark's Kafka connector; see `kafka_options`;
           "files": JSON lines that arrive in `path`
    """
    if kind == "kafka":
        return (spark.readStream.format("kafka").options(**options).load()
                .select(F.col("value").cast("string").alias("value")))
    if kind == "files":
        return spark.readStream.options(**options).text(path).select("value")
    raise ValueError(f"kind must be 'kafka' or 'files', not {kind!r}")
