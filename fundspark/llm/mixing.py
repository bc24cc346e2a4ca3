"""Mix sources to target weights by Poisson replication.

Every document gets a copy count from a Poisson distribution whose mean is the repetition rate its
source needs to reach its target weight. The count is the inverse of the distribution function at
a number hashed from seed and document, so it needs no state, is the same on every run, and holds
for any split of the data. The steps of the distribution function are computed once per source.
Whole documents are then dealt to tasks by a hash of document and copy and put in its order there:
one shuffle, in which every task gets a random share of all sources.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundspark.operators.lineage import materialise
from fundspark.operators.skew import bounded_join

# Beyond this mean a count is the sum of several draws of the same mean, so exp(-mean) stays
# far from underflow and the search for the inverse stays short.
PART_MEAN = 16.0
TAIL = 64


def source_rates(
    docs: DataFrame,
    weights: DataFrame | None = None,
    *,
    source_col: str = "source",
    exponent: float = 0.5,
    epochs: float = 1.0,
) -> DataFrame:
    """``source, rate``: mean number of copies per document of each source.

    ``weights`` (source, weight) are relative targets; sources it lacks, or with a weight that is
    NULL or not positive, get rate 0. Without it the target of a source with n documents is
    proportional to ``n ** exponent``. The expected size of the mixture is ``epochs`` times that
    of docs. NULL is a source of its own.
    """
    counts = docs.groupBy(F.col(source_col).alias("source")).agg(F.count(F.lit(1)).alias("n"))
    if weights is None:
        sized = counts.withColumn("weight", F.pow(F.col("n").cast("double"), F.lit(exponent)))
    else:
        given = weights.select(
            F.col("source").alias("__s"), F.col("weight").cast("double").alias("weight")
        )
        given = given.groupBy("__s").agg(F.max("weight").alias("weight"))
        sized = counts.join(given, F.col("source").eqNullSafe(F.col("__s")), "left").drop("__s")
        sized = sized.withColumn("weight", F.greatest(F.coalesce("weight", F.lit(0.0)), F.lit(0.0)))
    total = sized.agg(F.sum("n"), F.sum("weight")).first()
    documents, weight = total[0] or 0, total[1] or 0.0
    scale = F.lit(documents * epochs / weight if weight else 0.0)
    return sized.select("source", "n", (F.col("weight") * scale / F.col("n")).alias("rate"))


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from 52 bits of an MD5 hash."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") / 2.0**52


def poisson_steps(mean: Column) -> Column:
    """P(X <= k) for k from 0 up to ``TAIL``, or to where it no longer grows; for means up to ``PART_MEAN``."""
    none = F.array().cast("array<double>")
    start = F.struct(F.exp(-mean).alias("mass"), F.lit(0.0).alias("below"), none.alias("steps"))

    def step(state: Column, k: Column) -> Column:
        below = state["below"] + state["mass"]
        steps = F.when(below > state["below"], F.array_append(state["steps"], below)).otherwise(state["steps"])
        mass = state["mass"] * mean / k
        return F.struct(mass.alias("mass"), below.alias("below"), steps.alias("steps"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(TAIL)), start, step, lambda s: s["steps"])


def poisson_count(steps: Column, u: Column) -> Column:
    """Smallest k with P(X <= k) > u."""
    return F.size(F.filter(steps, lambda below: below <= u))


def mix_sources(
    docs: DataFrame,
    rates: DataFrame,
    *,
    id_col: str = "doc_id",
    source_col: str = "source",
    seed: int = 0,
) -> DataFrame:
    """Rows of docs, each as often as its count says, with ``copy`` (from 0) and ``position``.

    ``position`` is a hash of seed, id and copy; every task holds a random share of the copies in
    the order of it. Columns of docs named ``copy`` or ``position`` are replaced. Rows that repeat
    an id get the same count and place. A NULL id is hashed as an empty one, a NULL or empty text is
    mixed like any other. The few rows of ``rates`` are broadcast only if they are counted to be
    few, and salted otherwise: a source may hold most rows.
    """
    kept = [c for c in docs.columns if c not in ("copy", "position")]
    # A source of its own for NULL, which no name can be.
    name = F.concat(F.lit("="), F.col(source_col).cast("string"))
    base = docs.select(*kept, F.coalesce(name, F.lit("")).alias("__source"))
    parts = F.greatest(F.ceil(F.col("rate") / PART_MEAN), F.lit(1)).cast("int")
    every = rates.where("rate > 0").select(
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("__source"),
        parts.alias("__parts"),
        poisson_steps(F.col("rate") / parts).alias("__steps"),
    )
    joined = bounded_join(base, materialise(every, "mix-rates"), ["__source"])
    count = F.aggregate(
        F.sequence(F.lit(1), F.col("__parts")),
        F.lit(0),
        lambda total, part: total
        + poisson_count(F.col("__steps"), uniform(F.lit(seed), F.col(id_col), part)),
    )
    copies = joined.withColumn("__count", count).where("__count > 0").withColumn(
        "copy", F.explode(F.sequence(F.lit(0), F.col("__count") - 1))
    )
    place = F.md5(F.concat_ws(":", F.lit(f"place{seed}"), F.col(id_col), F.col("copy")).cast("binary"))
    placed = copies.select(*kept, "copy", place.alias("position"))
    return placed.repartition("position").sortWithinPartitions("position", id_col, "copy")
