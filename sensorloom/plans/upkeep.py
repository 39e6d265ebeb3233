"""The job beside the live one: delivers the outbox and keeps the stored tables in few files."""

import time

from pyspark.sql import SparkSession

from sensorloom.streaming import routing


def upkeep(spark: SparkSession, out: str) -> None:
    """One round. Each step may be run again, or by two jobs at once."""
    routing.deliver(spark, out)
    routing.compact(spark, out)
    routing.compact_rows(spark, out)


def main(arguments: list[str] | None = None) -> None:
    import argparse

    from sensorloom.session import build_session

    parser = argparse.ArgumentParser(description="Deliver the outbox and compact the stored tables.")
    parser.add_argument("out", help="folder of the live job's tables")
    parser.add_argument("--every", type=float, help="seconds between rounds; one round without it")
    given = parser.parse_args(arguments)
    spark = build_session("sensorloom-upkeep")
    while True:
        upkeep(spark, given.out)
        if given.every is None:
            return
        time.sleep(given.every)


if __name__ == "__main__":
    main()
