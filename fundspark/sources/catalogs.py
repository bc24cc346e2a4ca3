"""Scans of tables that other teams own, by qualified name and under a schema contract."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from fundspark.sources.versions import has_version, read_version


class SchemaDrift(ValueError):
    """A source no longer has the columns or types its readers were promised."""


def resolve(spark: SparkSession, name: str, roots: Mapping[str, str] | None = None) -> DataFrame:
    """The table of a qualified name: ``database.table`` or ``catalog.database.table``.

    A catalog named in ``roots`` is a folder of databases, each a folder of tables; any other one is
    a catalog of the session.
    """
    parts = name.split(".")
    if len(parts) < 2 or not all(parts):
        raise ValueError(f"{name!r}: a database and a table are required")
    if len(parts) == 3 and roots and parts[0] in roots:
        path = "/".join([roots[parts[0]].rstrip("/"), *parts[1:]])
        return read_version(spark, path) if has_version(spark, path) else spark.read.parquet(path)
    return spark.table(".".join(f"`{p}`" for p in parts))


def drift(df: DataFrame, contract: T.StructType) -> list[str]:
    """What breaks the contract: missing columns, other types. Further columns are fine."""
    have = {f.name: f.dataType for f in df.schema}
    found = []
    for field in contract:
        if field.name not in have:
            found.append(f"{field.name} is missing")
        elif have[field.name] != field.dataType:
            found.append(
                f"{field.name} is {have[field.name].simpleString()}, not {field.dataType.simpleString()}"
            )
    return found


def read_contracted(
    spark: SparkSession, name: str, ddl: str, roots: Mapping[str, str] | None = None
) -> DataFrame:
    """The contracted columns of a table; refuses a table that has drifted, before any row is read."""
    df = resolve(spark, name, roots)
    contract = T.StructType.fromDDL(ddl)
    if found := drift(df, contract):
        raise SchemaDrift(f"{name}: {'; '.join(found)}")
    return df.select(*contract.fieldNames())
