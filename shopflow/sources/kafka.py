"""Kafka source configuration.

The Kafka connector jar is not bundled; ``read_kafka`` needs it on the
classpath (``spark-sql-kafka-0-10``).  Tests use the file replay twin in
``shopflow.sources.replay``, which yields rows of the same shape.
"""

from __future__ import annotations

import configparser
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

#: JAAS login module of the open-source Kafka client
PLAIN_LOGIN_MODULE = "org.apache.kafka.common.security.plain.PlainLoginModule"

# fixed values: option names of the INI section read by StreamConfig.from_ini, as
# written in existing deployment config files (names are read in any case)
INI_BOOTSTRAP = "bootstrap_server"
INI_API_KEY = "confluentApiKey"
INI_API_SECRET = "confluentSecret"
INI_TOPICS = {
    "customers": "TopicName_customers",
    "shoes": "TopicName_shoes",
    "shoe_clickstream": "TopicName_clickstream",
    "shoe_orders": "TopicName_shoe_orders",
}
#: topic of the smoke table, which has no option
SMOKE_TOPICS = {"shoes_test": "dummy-test"}


@dataclass(frozen=True)
class StreamConfig:
    """Where one table's messages come from."""

    bootstrap_servers: str
    topic: str
    api_key: str | None = None
    api_secret: str | None = field(default=None, repr=False)
    starting_offsets: str = "earliest"
    fail_on_data_loss: bool = False
    login_module: str = PLAIN_LOGIN_MODULE
    extra: dict[str, str] = field(default_factory=dict)

    @classmethod
    def from_ini(cls, path: str, section: str, table: str, **kw) -> StreamConfig:
        """Read the bootstrap server, API key and secret and the topic of
        ``table`` from an INI section (option names: the fixed values above;
        a table without an option of its own, such as the smoke table, has a fixed topic)."""
        cp = configparser.ConfigParser(interpolation=None)
        if not cp.read(path):
            raise FileNotFoundError(path)
        sec = cp[section]
        return cls(
            bootstrap_servers=sec[INI_BOOTSTRAP],
            topic=SMOKE_TOPICS[table] if table in SMOKE_TOPICS else sec[INI_TOPICS[table]],
            api_key=sec.get(INI_API_KEY),
            api_secret=sec.get(INI_API_SECRET),
            **kw,
        )

    def options(self) -> dict[str, str]:
        opts = {
            "kafka.bootstrap.servers": self.bootstrap_servers,
            "subscribe": self.topic,
            "startingOffsets": self.starting_offsets,
            "failOnDataLoss": str(self.fail_on_data_loss).lower(),
        }
        if self.api_key is not None:
            opts.update({
                "kafka.security.protocol": "SASL_SSL",
                "kafka.sasl.mechanism": "PLAIN",
                "kafka.sasl.jaas.config": (
                    f"{self.login_module} required username='{self.api_key}' password='{self.api_secret}';"
                ),
                "kafka.ssl.endpoint.identification.algorithm": "https",
            })
        opts.update(self.extra)
        return opts


def read_kafka(spark: SparkSession, config: StreamConfig) -> DataFrame:
    """Streaming DataFrame of Kafka rows (key, value, topic, partition, offset, timestamp, ...)."""
    return spark.readStream.format("kafka").options(**config.options()).load()
