"""Settings of the streaming job, from arguments and environment."""

from __future__ import annotations

import argparse
import os
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from creditweave.sources.kafka import KafkaConnection
from creditweave.streaming.flatten import CONTINUOUS, ONCE

OFFSETS = ("earliest", "latest")
RUN_MODES = (ONCE, CONTINUOUS)

# Environment variable of each setting that has one.
ENVIRONMENT = {
    "bootstrap_servers": "KAFKA_BOOTSTRAP_SERVERS",
    "topic": "KAFKA_TOPIC",
    "output": "KAFKA_OUTPUT_PATH",
    "checkpoint": "KAFKA_CHECKPOINT_PATH",
    "starting_offsets": "KAFKA_STARTING_OFFSETS",
    "run_mode": "KAFKA_RUN_MODE",
    "timeout_seconds": "KAFKA_TIMEOUT_SECONDS",
    "kafka_security_protocol": "KAFKA_SECURITY_PROTOCOL",
    "kafka_sasl_mechanism": "KAFKA_SASL_MECHANISM",
    "kafka_sasl_jaas_config": "KAFKA_SASL_JAAS_CONFIG",
    "kafka_username": "KAFKA_USERNAME",
    "kafka_password": "KAFKA_PASSWORD",
}
REQUIRED = ("bootstrap_servers", "topic", "output", "checkpoint")
# For these the environment wins over the argument, whose default is always set.
ENVIRONMENT_FIRST = ("starting_offsets", "run_mode")


def _flag(name: str) -> str:
    return "--" + name.replace("_", "-")


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(description="Flatten application events into Parquet.")
    parser.add_argument("--bootstrap-servers")
    parser.add_argument("--topic")
    parser.add_argument("--output", help="directory of the flat rows")
    parser.add_argument("--checkpoint", help="checkpoint directory; one per output")
    parser.add_argument("--starting-offsets", choices=OFFSETS, default="earliest")
    parser.add_argument("--run-mode", choices=RUN_MODES, default=ONCE)
    parser.add_argument("--timeout-seconds", type=int)
    parser.add_argument("--kafka-security-protocol")
    parser.add_argument("--kafka-sasl-mechanism")
    parser.add_argument("--kafka-sasl-jaas-config")
    parser.add_argument("--max-offsets-per-trigger", type=int, help="upper bound of a micro-batch")
    parser.add_argument("--fail-on-data-loss", action="store_true", default=None, help="stop when messages expired before they were read")
    parser.add_argument("--min-partitions", type=int, help="split topic partitions into at least this many tasks")
    parser.add_argument("--processing-time", help="trigger interval of a continuous run, such as '1 minute'")
    parser.add_argument("--replay-id", help="replay everything into a new output and checkpoint of this name")
    return parser


@dataclass(frozen=True)
class FlattenSettings:
    bootstrap_servers: str
    topic: str
    output: str
    checkpoint: str
    starting_offsets: str = "earliest"
    run_mode: str = ONCE
    timeout_seconds: int | None = None
    kafka_security_protocol: str | None = None
    kafka_sasl_mechanism: str | None = None
    kafka_sasl_jaas_config: str | None = field(default=None, repr=False)
    kafka_username: str | None = field(default=None, repr=False)
    kafka_password: str | None = field(default=None, repr=False)
    max_offsets_per_trigger: int | None = None
    min_partitions: int | None = None
    fail_on_data_loss: bool | None = None
    processing_time: str | None = None
    replay_id: str | None = None

    @classmethod
    def resolve(
        cls, argv: Sequence[str] | None = None, environment: Mapping[str, str] | None = None
    ) -> FlattenSettings:
        """Merge arguments and environment; a ValueError names every required setting that is missing."""
        env = os.environ if environment is None else environment
        values = vars(_parser().parse_args(argv))
        for name, variable in ENVIRONMENT.items():
            given, set_outside = values.get(name), env.get(variable)
            first, second = (set_outside, given) if name in ENVIRONMENT_FIRST else (given, set_outside)
            values[name] = first or second or None
        if values["timeout_seconds"] is not None:
            values["timeout_seconds"] = int(values["timeout_seconds"])
        missing = [f"{ENVIRONMENT[name]} or {_flag(name)}" for name in REQUIRED if not values[name]]
        if missing:
            raise ValueError(f"missing required settings: {', '.join(missing)}")
        return cls(**values)

    def connection(self) -> KafkaConnection:
        return KafkaConnection(
            servers=self.bootstrap_servers,
            security_protocol=self.kafka_security_protocol,
            sasl_mechanism=self.kafka_sasl_mechanism,
            jaas_config=self.kafka_sasl_jaas_config,
            username=self.kafka_username,
            password=self.kafka_password,
        )

    def arguments(self) -> list[str]:
        """The job arguments that give these settings; a user's login becomes its JAAS line."""
        values = {name: getattr(self, name) for name in vars(_parser().parse_args([]))}
        values["kafka_sasl_jaas_config"] = self.connection().options().get("kafka.sasl.jaas.config")
        return [
            part
            for name, value in values.items()
            if value not in (None, "", False)
            for part in ((_flag(name),) if value is True else (_flag(name), str(value)))
        ]
