"""Published views: persistent, with a declared column list, and rows per group of readers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from fundspark.sources.versions import versions


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def publish_view(
    spark: SparkSession,
    name: str,
    table: str,
    columns: Mapping[str, str],
    *,
    entities: Sequence[str] = (),
    entity_column: str = "global_entity_id",
    comment: str = "",
) -> None:
    """Create or replace the view ``name`` in the session catalog.

    ``table`` is a table name, or the path of a table that ``replace_table`` wrote; the view then
    shows the version that is newest now, until it is published again. ``columns`` maps the
    published columns, in their order, to their comments; what is not listed is not shown. With
    ``entities`` only their rows are.
    """
    if not columns:
        raise ValueError(f"{name}: a view needs a column list")
    if "/" in table:
        known = versions(spark, table)
        table = f"parquet.`{known[-1][1] if known else table}`"
    listed = ", ".join(f"`{c}` COMMENT {_quoted(text)}" for c, text in columns.items())
    where = ""
    if entities:
        where = f" WHERE `{entity_column}` IN ({', '.join(map(_quoted, entities))})"
    spark.sql(
        f"CREATE OR REPLACE VIEW {name} ({listed}) COMMENT {_quoted(comment)} AS"
        f" SELECT {', '.join(f'`{c}`' for c in columns)} FROM {table}{where}"
    )


def publish_to_groups(
    spark: SparkSession,
    name: str,
    table: str,
    columns: Mapping[str, str],
    groups: Mapping[str, Sequence[str]],
) -> list[str]:
    """One view per group of readers, ``<name>_<group>``, with the rows of the group's entities.

    A group without entities gets no view: an empty list must not mean all rows.
    """
    made = []
    for group, entities in groups.items():
        if entities:
            publish_view(spark, f"{name}_{group}", table, columns, entities=entities)
            made.append(f"{name}_{group}")
    return made


def undeclared(df: DataFrame, columns: Mapping[str, str]) -> list[str]:
    """Declared columns that a table lacks."""
    return [c for c in columns if c not in df.columns]
