"""Publishing job: event records to a topic as nested JSON."""

from __future__ import annotations

import argparse
import json
import os
from collections.abc import Sequence

from creditweave.session import build_session
from creditweave.sinks.kafka import publish_events
from creditweave.sources.kafka import KafkaConnection


def parse_args(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Publish application records to a topic.")
    parser.add_argument("--input", required=True, help="Parquet records with a documents array")
    parser.add_argument("--bootstrap-servers", required=True, help="brokers, comma separated")
    parser.add_argument("--topic", required=True)
    parser.add_argument("--security-protocol", default="PLAINTEXT")
    parser.add_argument("--sasl-mechanism")
    parser.add_argument("--sasl-username", default=os.environ.get("KAFKA_USERNAME"), help="KAFKA_USERNAME if not given")
    parser.add_argument("--sasl-password", default=os.environ.get("KAFKA_PASSWORD"), help="better left to KAFKA_PASSWORD")
    return parser.parse_args(argv)


def connection(args: argparse.Namespace) -> KafkaConnection:
    """A login is only sent when a mechanism is set."""
    login = {}
    if args.sasl_mechanism:
        login = {
            "sasl_mechanism": args.sasl_mechanism,
            "username": args.sasl_username,
            "password": args.sasl_password,
        }
    return KafkaConnection(
        servers=args.bootstrap_servers, security_protocol=args.security_protocol, **login
    )


def main(argv: Sequence[str] | None = None) -> None:
    args = parse_args(argv)
    spark = build_session("creditweave-publish")
    try:
        report = publish_events(spark.read.parquet(args.input), connection(args), args.topic)
        print(json.dumps(report))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
