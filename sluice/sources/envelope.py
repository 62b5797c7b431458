"""Record envelope: schemas, Kafka and JSON sources and sinks, header routing.

Raw records carry the Kafka envelope (key, value, topic, partition, offset,
timestamp, timestampType, headers). Header 0 names the target table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The columns of a Kafka record.
RAW_ENVELOPE = T.StructType(
    [
        T.StructField("key", T.BinaryType(), True),
        T.StructField("value", T.BinaryType(), True),
        T.StructField("topic", T.StringType(), True),
        T.StructField("partition", T.IntegerType(), True),
        T.StructField("offset", T.LongType(), True),
        T.StructField("timestamp", T.TimestampType(), True),
        T.StructField("timestampType", T.IntegerType(), True),
        T.StructField(
            "headers",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("key", T.StringType(), True),
                        T.StructField("value", T.BinaryType(), True),
                    ]
                )
            ),
            True,
        ),
    ]
)

# Envelope column renames and the routing header position.
ENVELOPE_RENAMES = {
    "topic": "kafka_topic",
    "key": "kafka_key",
    "partition": "kafka_partition",
    "offset": "kafka_offset",
    "timestamp": "kafka_ts",
    "timestampType": "kafka_ts_type",
}
ROUTING_HEADER_INDEX = 0
ROUTING_COLUMN = "table_suffix"

# Envelope columns kept on every target row, in table order.
META_COLUMNS = ["kafka_key", "kafka_topic", "kafka_partition", "kafka_offset", "kafka_ts", "kafka_ts_type"]

# JSON files keep record times to the microsecond (Spark's default
# JSON format stops at milliseconds).
JSON_TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def routing_key(headers: Column) -> Column:
    """Value of header 0 as text; NULL (not an error) when there is no header."""
    return F.get(headers, F.lit(ROUTING_HEADER_INDEX)).getField("value").cast("string")


def header_to_suffix(df: DataFrame) -> DataFrame:
    return df.withColumn(ROUTING_COLUMN, routing_key(F.col("headers"))).drop("headers")


def rename_envelope(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(ENVELOPE_RENAMES)


def normalise(df: DataFrame) -> DataFrame:
    """Raw envelope to ``kafka_*`` columns plus ``table_suffix``."""
    return df.transform(header_to_suffix).transform(rename_envelope)


def payload_text(df: DataFrame) -> DataFrame:
    return df.withColumn("value", F.col("value").cast("string"))


def kafka_options(
    bootstrap_servers: str | None = None,
    topic: str | None = None,
    starting_offsets: str = "earliest",
    ending_offsets: str | None = "latest",
    include_headers: bool = True,
    streaming: bool = False,
    **extra: str,
) -> dict[str, str]:
    """Options for the Kafka source; headers are always requested for routing."""
    for option, value in (("bootstrap_servers", bootstrap_servers), ("topic", topic)):
        if not value:
            raise ValueError(f"the Kafka source needs the option {option!r}")
    opts = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "includeHeaders": str(include_headers).lower(),
    }
    if not streaming and ending_offsets is not None:
        opts["endingOffsets"] = ending_offsets
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def _with_min_partitions(spark: SparkSession, config: dict) -> dict:
    """Split large topic partitions over several tasks: a hot partition holding a
    third of the records would otherwise be parsed by one task."""
    config = dict(config)
    config.setdefault("minPartitions", str(spark.sparkContext.defaultParallelism))
    return config


def read_kafka(spark: SparkSession, **config: str) -> DataFrame:
    """Bounded read of a topic (needs the spark-sql-kafka connector on the classpath)."""
    opts = kafka_options(streaming=False, **_with_min_partitions(spark, config))
    return spark.read.format("kafka").options(**opts).load()


def read_kafka_stream(spark: SparkSession, **config: str) -> DataFrame:
    opts = kafka_options(streaming=True, **_with_min_partitions(spark, config))
    return spark.readStream.format("kafka").options(**opts).load()


def read_json(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RAW_ENVELOPE).option("timestampFormat", JSON_TIMESTAMP_FORMAT).json(path)


def read_json_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(RAW_ENVELOPE).option("timestampFormat", JSON_TIMESTAMP_FORMAT)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.json(path)


def write_json(df: DataFrame, path: str) -> None:
    """Append envelope records as JSON files (binary columns as base64)."""
    df.write.mode("append").option("timestampFormat", JSON_TIMESTAMP_FORMAT).json(path)


def kafka_encode(df: DataFrame) -> DataFrame:
    """Projection the Kafka sink expects: text key and value, headers kept."""
    return df.selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value", "headers")


def write_kafka(df: DataFrame, bootstrap_servers: str, topic: str) -> None:
    (
        kafka_encode(df)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("topic", topic)
        .option("includeHeaders", "true")
        .save()
    )
