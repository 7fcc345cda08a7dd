"""Read the JSON configuration of the jobs."""

from __future__ import annotations

import json
import os
from collections.abc import Mapping

from pyspark.sql import SparkSession

from tillmart.plans.ingest import TableConfig
from tillmart.plans.marts import Mart
from tillmart.sources.stores import JdbcStore, split_from_dict


def table_configs(text: str) -> list[TableConfig]:
    return [TableConfig.from_dict(entry) for entry in json.loads(text)]


def mart_configs(text: str) -> list[Mart]:
    return [Mart.from_dict(entry) for entry in json.loads(text)]


def table_list(text: str) -> list[str]:
    return list(json.loads(text))


def connections(
    spark: SparkSession, text: str, environment: Mapping[str, str] = os.environ
) -> dict[str, JdbcStore]:
    """Named databases, each with `host`, `user`, `password` and `driver`.

    `splits` may say for tables how they are scanned: `partition_column` and `num_partitions`,
    either with `lower_bound` and `upper_bound`, or without them for parts of equal size. A
    value written as `$NAME` is taken from the environment, so that the file needs to hold no
    secret.
    """

    def value(text: str) -> str:
        return environment[text[1:]] if text.startswith("$") else text

    return {
        name: JdbcStore(
            spark,
            url=value(entry["host"]),
            user=value(entry["user"]),
            password=value(entry["password"]),
            driver=entry["driver"],
            splits={
                table: split
                for table, raw in entry.get("splits", {}).items()
                if (split := split_from_dict(raw))
            },
        )
        for name, entry in json.loads(text).items()
    }
