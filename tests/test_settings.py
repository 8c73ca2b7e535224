from __future__ import annotations

import pytest

from creditweave.jobs import publish
from creditweave.jobs.settings import FlattenSettings
from creditweave.sources.kafka import KafkaConnection, sasl_jaas_line, topic_options
from creditweave.sources.keyed import jdbc_snapshot_options

ARGS = ["--bootstrap-servers", "a:9092", "--topic", "t", "--output", "/out", "--checkpoint", "/cp"]
ENV = {
    "KAFKA_BOOTSTRAP_SERVERS": "env:9092", "KAFKA_TOPIC": "env_topic", "KAFKA_OUTPUT_PATH": "/env_out",
    "KAFKA_CHECKPOINT_PATH": "/env_cp", "KAFKA_STARTING_OFFSETS": "latest", "KAFKA_RUN_MODE": "continuous",
    "KAFKA_TIMEOUT_SECONDS": "60", "KAFKA_SECURITY_PROTOCOL": "SASL_SSL", "KAFKA_SASL_MECHANISM": "SCRAM-SHA-512",
    "KAFKA_SASL_JAAS_CONFIG": "jaas",
}


def test_defaults():
    settings = FlattenSettings.resolve(ARGS, {})
    assert (settings.starting_offsets, settings.run_mode, settings.timeout_seconds) == ("earliest", "once", None)
    assert settings.connection().options() == {"kafka.bootstrap.servers": "a:9092"}


def test_environment_alone():
    settings = FlattenSettings.resolve([], ENV)
    assert (settings.topic, settings.output, settings.checkpoint) == ("env_topic", "/env_out", "/env_cp")
    assert settings.timeout_seconds == 60
    assert settings.connection().options() == {
        "kafka.bootstrap.servers": "env:9092", "kafka.security.protocol": "SASL_SSL",
        "kafka.sasl.mechanism": "SCRAM-SHA-512", "kafka.sasl.jaas.config": "jaas",
    }


def test_precedence():
    argv = [*ARGS, "--starting-offsets", "earliest", "--run-mode", "once", "--timeout-seconds", "5",
            "--kafka-security-protocol", "SSL"]
    settings = FlattenSettings.resolve(argv, ENV)
    assert (settings.bootstrap_servers, settings.topic, settings.timeout_seconds) == ("a:9092", "t", 5)
    assert settings.kafka_security_protocol == "SSL"
    # for these two the environment wins
    assert (settings.starting_offsets, settings.run_mode) == ("latest", "continuous")


def test_every_missing_setting_is_named():
    with pytest.raises(ValueError) as error:
        FlattenSettings.resolve(["--topic", "t"], {"KAFKA_OUTPUT_PATH": ""})
    for name in ("KAFKA_BOOTSTRAP_SERVERS", "--output", "KAFKA_CHECKPOINT_PATH"):
        assert name in str(error.value)
    assert "--topic" not in str(error.value)


def test_arguments_round_trip_with_login():
    settings = FlattenSettings.resolve(
        [*ARGS, "--timeout-seconds", "900", "--kafka-sasl-mechanism", "SCRAM-SHA-512"],
        {"KAFKA_USERNAME": "u", "KAFKA_PASSWORD": "p"},
    )
    argv = settings.arguments()
    assert argv[:8] == ARGS
    again = FlattenSettings.resolve(argv, {})
    assert again.connection().options() == settings.connection().options()
    assert again.timeout_seconds == 900
    assert "p\"" in again.kafka_sasl_jaas_config


def test_secrets_are_not_printed():
    settings = FlattenSettings.resolve(ARGS, ENV | {"KAFKA_PASSWORD": "secret1", "KAFKA_SASL_JAAS_CONFIG": "secret2"})
    assert "secret" not in repr(settings) and "secret" not in repr(settings.connection())


def test_jaas_lines():
    assert sasl_jaas_line("u", 'p"\\') == (
        'org.apache.kafka.common.security.scram.ScramLoginModule required username="u" password="p\\"\\\\";'
    )
    assert "plain.PlainLoginModule" in sasl_jaas_line("u", "p", "PLAIN")
    given = KafkaConnection("a", jaas_config="mine", username="u", password="p")
    assert given.options()["kafka.sasl.jaas.config"] == "mine"
    assert "kafka.sasl.jaas.config" not in KafkaConnection("a", username="u").options()


def test_topic_options():
    options = topic_options(KafkaConnection(" a:1 , b:2,"), "t", "latest", 1000, 64)
    assert options == {
        "kafka.bootstrap.servers": "a:1,b:2", "subscribe": "t", "startingOffsets": "latest",
        "failOnDataLoss": "false", "maxOffsetsPerTrigger": "1000", "minPartitions": "64",
    }


def test_publisher_login_needs_a_mechanism():
    base = ["--input", "i", "--bootstrap-servers", "a:1, b:2", "--topic", "t", "--sasl-username", "u", "--sasl-password", "p"]
    plain = publish.connection(publish.parse_args(base)).options()
    assert plain == {"kafka.bootstrap.servers": "a:1,b:2", "kafka.security.protocol": "PLAINTEXT"}
    secure = publish.connection(publish.parse_args([*base, "--sasl-mechanism", "SCRAM-SHA-256"])).options()
    assert secure["kafka.sasl.mechanism"] == "SCRAM-SHA-256" and 'username="u"' in secure["kafka.sasl.jaas.config"]


def test_jdbc_read_is_split():
    options = jdbc_snapshot_options("jdbc:x", "calls", "2026-01-01", "2027-01-01", 64)
    assert options["partitionColumn"] == "call_time" and options["numPartitions"] == "64"
