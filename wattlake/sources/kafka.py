"""The two calls that need the Kafka connector on the class path.

All logic is in `operators.envelopes`, on frames of Kafka's shape. Offsets live in the
checkpoint of the query, not in a consumer group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from wattlake.operators.envelopes import to_kafka_rows

# The default topic, and acknowledgement by the leader only.
TOPIC = "energy-aggregated"
ACKS = "1"


def read_kafka(
    spark: SparkSession,
    brokers: str,
    topic: str = TOPIC,
    starting: str = "latest",
    offsets_per_trigger: int = 10_000_000,
) -> DataFrame:
    """Messages as a stream; each trigger takes a bounded number of them."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .option("maxOffsetsPerTrigger", offsets_per_trigger)
        .load()
    )


def _options(brokers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": brokers, "topic": topic, "kafka.acks": ACKS}


def write_kafka(envelopes: DataFrame, brokers: str, topic: str = TOPIC) -> None:
    to_kafka_rows(envelopes).write.format("kafka").options(**_options(brokers, topic)).save()


def stream_to_kafka(
    envelopes: DataFrame, brokers: str, checkpoint: str, topic: str = TOPIC
) -> DataStreamWriter:
    writer = to_kafka_rows(envelopes).writeStream.format("kafka")
    return writer.options(**_options(brokers, topic)).option("checkpointLocation", checkpoint)
