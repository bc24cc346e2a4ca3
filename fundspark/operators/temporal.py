"""Validity intervals: derive them from change events, and join facts to them as of a time."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundspark.operators.dedup import tie_break
from fundspark.operators.skew import all_of

OPEN_START = datetime(1970, 1, 1)
OPEN_END = datetime(2030, 1, 1)


def with_neighbour(
    events: DataFrame,
    keys: Sequence[str],
    ts: str,
    out: str,
    *,
    following: bool,
    ties: Sequence[str] = (),
    slice_by: str | None = "month",
) -> DataFrame:
    """Add the time of the next (or previous) event of the same key.

    With ``slice_by`` the window runs inside (key, calendar slice); only the edge of a slice
    looks into the nearest other slice of its key, through one pre-aggregated row per slice. A
    key with very many events is thereby spread over its slices instead of being one task.
    """
    order = [F.col(ts).asc(), *tie_break(*ties)]
    move = F.lead if following else F.lag
    if slice_by is None:
        return events.withColumn(out, move(ts).over(Window.partitionBy(*keys).orderBy(*order)))
    sliced = events.withColumn("__slice", F.trunc(ts, slice_by))
    inside = sliced.withColumn(
        "__inside", move(ts).over(Window.partitionBy(*keys, "__slice").orderBy(*order))
    )
    edge = F.min(ts) if following else F.max(ts)
    edges = sliced.groupBy(*keys, "__slice").agg(edge.alias("__edge"))
    across = edges.withColumn(
        "__across", move("__edge").over(Window.partitionBy(*keys).orderBy("__slice"))
    ).drop("__edge")
    across = across.select(*[F.col(c).alias(f"__e_{c}") for c in across.columns])
    joined = inside.join(
        across,
        all_of([inside[c].eqNullSafe(across[f"__e_{c}"]) for c in [*keys, "__slice"]]),
        "inner",
    )
    return joined.select(*events.columns, F.coalesce("__inside", "__e___across").alias(out))


def scd2_from_events(
    events: DataFrame,
    keys: Sequence[str],
    ts: str,
    *,
    valid_to: str = "valid_to_utc",
    open_end: datetime = OPEN_END,
    ties: Sequence[str] = (),
    slice_by: str | None = "month",
) -> DataFrame:
    """Turn a change list into half-open intervals ``[ts, next change)``; the last one is open."""
    with_next = with_neighbour(
        events, keys, ts, valid_to, following=True, ties=ties, slice_by=slice_by
    )
    return with_next.withColumn(valid_to, F.coalesce(valid_to, F.lit(open_end)))


SLICE = "__time_slice"
DENSE_SLICE = "__dense_slice"
KEY_HASH = "__key_hash"
# Versions of one key that are compared as they are; a key with more of them is cut into time slices.
DENSE_VERSIONS = 1_000
# Types whose equal values have equal texts.
PLAIN_TYPES = {"string", "tinyint", "smallint", "int", "bigint", "date", "timestamp", "boolean"}


def _key_hash(keys: Sequence[Column]) -> Column:
    return F.xxhash64(*[c.cast("string") for c in keys])


def dense_keys(rows: DataFrame, keys: Sequence[str], versions: int = DENSE_VERSIONS) -> DataFrame:
    """Hashes of the keys with more than ``versions`` rows: at most rows / versions, whatever the data.

    ``rows`` may be what a history is made from, which has no fewer rows per key. A key that only
    shares its hash with such a key is cut too, on both sides of a join: results never change.
    """
    hashed = rows.select(_key_hash([F.col(c) for c in keys]).alias(KEY_HASH))
    counted = hashed.groupBy(KEY_HASH).agg(F.count(F.lit(1)).alias("__versions"))
    return counted.where(F.col("__versions") > versions).select(KEY_HASH)


def may_have_dense_keys(rows: DataFrame, key: str, versions: int = DENSE_VERSIONS, tracked: int = 4_096) -> bool:
    """Whether a key may have more than ``versions`` rows and more than 7 / ``tracked`` of all rows.

    Never False where one has. Every row is counted, in one sketch of frequent items per task, so next
    to nothing moves; for a merge, whose work is its rows, keys of a smaller share need no slices.
    """
    hashed = rows.where(F.col(key).isNotNull()).select(_key_hash([F.col(key)]).alias(KEY_HASH))
    found = hashed.agg(F.expr(f"approx_top_k({KEY_HASH}, 1, {tracked})").alias("top")).first()["top"]
    return bool(found) and found[0]["count"] > versions


def with_dense(rows: DataFrame, keys: Sequence[Column], dense: DataFrame) -> DataFrame:
    """Add ``__dense``, true for rows of the dense keys and NULL for others. No row moves for this."""
    marks = F.broadcast(dense.withColumn("__dense", F.lit(True)))
    return rows.withColumn(KEY_HASH, _key_hash(keys)).join(marks, KEY_HASH, "left").drop(KEY_HASH)


def time_slice(col: Column, bounds: tuple[date, date], bucket_days: int) -> Column:
    """Number of the slice a time lies in, limited to the slices of the bounds."""
    low, high = ((d - date(1970, 1, 1)).days // bucket_days for d in bounds)
    number = F.floor(F.unix_date(F.to_date(col)) / bucket_days).cast("int")
    return F.when(col.isNotNull(), F.greatest(F.least(number, F.lit(high)), F.lit(low)))


def with_time_slice(
    facts: DataFrame, ts: str, bounds: tuple[date, date] | None, bucket_days: int | None
) -> DataFrame:
    """Add the slice column that ``asof_join`` uses as a key part.

    Facts that carry it through several joins on the same key are shuffled once for all of them.
    """
    if bounds is None or not bucket_days:
        return facts
    return facts.withColumn(SLICE, time_slice(F.col(ts), bounds, bucket_days))


def with_dense_slice(
    facts: DataFrame,
    keys: Sequence[str],
    ts: str,
    dense: DataFrame,
    bounds: tuple[date, date] | None,
    bucket_days: int | None,
    out: str = DENSE_SLICE,
) -> DataFrame:
    """As ``with_time_slice``, for dense keys only: all facts of another key are in slice 0."""
    if bounds is None or not bucket_days:
        return facts
    number = F.when(F.col("__dense"), time_slice(F.col(ts), bounds, bucket_days)).otherwise(F.lit(0))
    marked = with_dense(facts, [F.col(c) for c in keys], dense)
    return marked.withColumn(out, number).drop("__dense")


def _in_slices(
    history: DataFrame,
    keys: Sequence[str],
    start: str,
    end: Column,
    dense: DataFrame | None,
    bounds: tuple[date, date],
    bucket_days: int,
    out: str,
) -> DataFrame:
    """Versions once per slice they touch; those of a key that is not dense once, in slice 0."""
    first, last = (time_slice(c, bounds, bucket_days) for c in (F.col(start), end))
    if dense is None:
        return history.withColumn(out, F.explode(F.sequence(first, last)))
    slices = F.when(F.col("__dense"), F.sequence(first, last)).otherwise(F.array(F.lit(0)))
    marked = with_dense(history, [F.col(c) for c in keys], dense)
    return marked.withColumn(out, F.explode(slices)).drop("__dense")


def asof_join(
    facts: DataFrame,
    history: DataFrame,
    on: Mapping[str, str],
    ts: str,
    *,
    valid_from: str = "valid_from_utc",
    valid_to: str = "valid_to_utc",
    values: Mapping[str, str],
    closed: str = "left",
    bounds: tuple[date, date] | None = None,
    bucket_days: int | None = None,
    dense: DataFrame | None = None,
) -> DataFrame:
    """Left join facts to the history rows in force at ``ts``; several versions may match.

    ``on`` maps fact columns to history columns, ``values`` output names to history columns.
    ``closed="left"`` means ``[from, to)``, ``"both"`` means ``[from, to]``.

    With ``bounds`` and ``bucket_days`` the interval is also cut into time slices that become a
    key part, so a product with many versions and many sales is compared slice by slice. Times
    outside the bounds fall into the outermost slice on both sides: bounds affect the number of
    slices, never the result. A history row repeats at most ``span / bucket_days + 1`` times.

    With ``dense`` (``dense_keys`` of the history's key) only versions of those keys repeat: the
    others move once, and a fact of theirs is compared with ``DENSE_VERSIONS`` versions at most.
    Facts that carry ``DENSE_SLICE`` were sliced by the same ``dense``.
    """
    hist = history.select(
        *[F.col(c).alias(f"__k{i}") for i, c in enumerate(on.values())],
        F.col(valid_from).alias("__from"),
        F.col(valid_to).alias("__to"),
        *[F.col(c).alias(name) for name, c in values.items()],
    )
    lhs = facts
    sliced = bounds is not None and bool(bucket_days)
    if sliced:
        types = [(facts.schema[f].dataType, history.schema[h].dataType) for f, h in on.items()]
        plain = all(a == b and a.simpleString() in PLAIN_TYPES for a, b in types)
        if SLICE in facts.columns or not plain:
            dense = None
        own = SLICE if dense is None else DENSE_SLICE
        if own not in facts.columns:
            lhs = (
                with_time_slice(facts, ts, bounds, bucket_days)
                if dense is None
                else with_dense_slice(facts, list(on), ts, dense, bounds, bucket_days)
            )
        hist = hist.where(F.col("__from") <= F.col("__to"))
        keys = [f"__k{i}" for i in range(len(on))]
        hist = _in_slices(hist, keys, "__from", F.col("__to"), dense, bounds, bucket_days, "__slot")
    conditions = [lhs[c] == hist[f"__k{i}"] for i, c in enumerate(on)]
    if sliced:
        conditions.append(lhs[own] == hist["__slot"])
    upper = hist["__to"] >= lhs[ts] if closed == "both" else hist["__to"] > lhs[ts]
    joined = lhs.join(hist, all_of([*conditions, hist["__from"] <= lhs[ts], upper]), "left")
    return joined.select(*[lhs[c] for c in facts.columns], *[hist[name] for name in values])


@dataclass(frozen=True)
class History:
    """Versions of one fact table to carry along: which fact columns it is looked up by, and what
    it gives. Versions of one key must not overlap, as intervals made from changes never do."""

    rows: DataFrame
    on: Mapping[str, str]
    values: Mapping[str, str]
    valid_from: str = "valid_from_utc"
    valid_to: str = "valid_to_utc"


@dataclass(frozen=True)
class ChangeLog:
    """Changes as they were logged, cleaned where the merge has them together: they move once.

    ``casts`` maps an output to the ``kind`` of change it takes (None: any) and to how it reads the
    ``value``. Without ``valid_to`` a change holds until the next one of its key. With ``seen``, which
    is not NULL, only the newest of the changes of a key, kind and day counts, then the smallest value.
    """

    rows: DataFrame
    on: Mapping[str, str]
    value: str
    casts: Mapping[str, tuple[str | None, Callable[[Column], Column]]]
    valid_from: str = "valid_from_utc"
    valid_to: str | None = None
    kind: str | None = None
    seen: str | None = None

    @property
    def kinds(self) -> list[str]:
        return sorted({kind for kind, _ in self.casts.values() if kind is not None})

    def raw(self) -> Column:
        """What the merge carries of a row until it is cleaned, in as few bytes as can be."""
        fields = {"value": F.col(self.value)}
        if self.valid_to:
            fields["to"] = F.col(self.valid_to).cast("timestamp")
        if self.kind:
            fields["kind"] = F.array_position(F.array(*map(F.lit, self.kinds)), F.col(self.kind))
        if self.seen:
            seen = F.col(self.seen).cast("timestamp")
            fields["seen"] = F.nullif(seen, F.col(self.valid_from).cast("timestamp"))
        return F.struct(*[c.alias(name) for name, c in fields.items()])

    def clean(self, stream: DataFrame, raw: str, keys: Sequence[str], at: str) -> DataFrame:
        """Replace the column ``raw`` by one of versions per output."""
        row, mine = F.col(raw), F.col(raw).isNotNull()
        if self.seen:
            seen = F.when(mine, F.coalesce(row["seen"], at))
            same_day = [*([row["kind"]] if self.kind else []), F.to_date(seen)]
            of_day = Window.partitionBy(*keys, *same_day).orderBy(
                seen.desc_nulls_last(), row["value"].asc_nulls_last()
            )
            ranked = stream.withColumn("__rn", F.row_number().over(of_day))
            stream = ranked.where(~mine | (F.col("__rn") == 1)).drop("__rn")
        if self.valid_to:
            end = row["to"]
        else:
            changes = Window.partitionBy(*keys, mine).orderBy(at, row["value"].asc_nulls_last())
            stream = stream.withColumn("__next", F.lead(at).over(changes))
            end = F.coalesce("__next", F.lit(OPEN_END))
        versions = {}
        for name, (kind, cast) in self.casts.items():
            valid = mine & (F.col(at) < end) & (
                F.lit(True) if kind is None else row["kind"] == self.kinds.index(kind) + 1
            )
            version = F.struct(end.cast("timestamp").alias("to"), cast(row["value"]).alias(name))
            versions[f"__h_{name}"] = F.when(valid, version)
        return stream.withColumns(versions).drop(raw, "__next")


def carry_asof(
    facts: DataFrame,
    histories: Sequence[History | ChangeLog],
    ts: str,
    *,
    common: str,
    spread_by: Sequence[str],
    hot: DataFrame | None = None,
    bounds: tuple[date, date] | None = None,
    bucket_days: int | None = None,
    dense: DataFrame | None = None,
) -> DataFrame:
    """Left join facts to several histories as of ``ts`` by one merge of all their rows.

    Facts and versions of one key form one stream in time order, and every fact takes the version
    that started last before it, unless that has ended: half-open intervals ``[from, to)``. The work
    of a key is its rows, not facts times versions, and facts move once for all histories: all of
    them are looked up by ``common`` and perhaps further columns, and the stream is dealt by
    ``common`` and time slice.

    Nothing relies on settings of the session. A key that ``hot_keys`` names is dealt to parts by a
    hash of ``spread_by``, each with its own copy of the key's versions; facts without a key meet
    nothing and are spread by the same hash. ``hot`` only balances: stale counts give equal rows.
    Of versions of one key that start together the one that ends last counts, then the largest
    values. With ``dense`` (``dense_keys`` of all histories by ``common``) only those keys are dealt
    by time slice, and only their versions repeat. A ``ChangeLog`` is cleaned after it has moved, so
    it cannot be cut into slices before.
    """
    at, is_fact, part, fact = "__at", "__is_fact", "__part", "__fact"
    sliced = bounds is not None and bool(bucket_days)
    if sliced and any(isinstance(h, ChangeLog) for h in histories):
        raise ValueError("a change log has no versions to slice")
    lhs = facts
    if SLICE in facts.columns:
        dense = None
    elif sliced and dense is None:
        lhs = with_time_slice(facts, ts, bounds, bucket_days)
    elif sliced:
        lhs = with_dense_slice(facts, [common], ts, dense, bounds, bucket_days, SLICE)
    spread = F.xxhash64(*spread_by)
    if hot is not None:
        lhs = lhs.join(F.broadcast(hot), common, "left")
        inside = F.pmod(spread, F.coalesce("__parts", F.lit(1)).cast("bigint"))
    else:
        inside = F.lit(0).cast("bigint")
    lhs = lhs.withColumns(
        {
            part: F.when(F.col(common).isNull(), spread).otherwise(inside),
            at: F.col(ts),
            is_fact: F.lit(True),
        }
    ).drop("__parts")
    dealt_by = [common, *([SLICE] if sliced else []), part]
    # Facts travel as one column, so that versions are narrow rows.
    keys = list(dict.fromkeys([*dealt_by, *[c for history in histories for c in history.on]]))
    streams = [lhs.select(*keys, at, is_fact, F.struct(*facts.columns).alias(fact))]
    for i, history in enumerate(histories):
        start, rows = F.col(history.valid_from), history.rows
        if isinstance(history, ChangeLog):
            version = history.raw()
        else:
            end = F.col(history.valid_to)
            rows = rows.where(start < end)
            version = F.struct(
                end.cast("timestamp").alias("to"),
                *[F.col(c).alias(name) for name, c in history.values.items()],
            )
        events = rows.select(
            *[F.col(c).cast(facts.schema[name].dataType).alias(name) for name, c in history.on.items()],
            start.cast("timestamp").alias(at),
            F.lit(False).alias(is_fact),
            version.alias(f"__h{i}"),
        )
        events = events.where(all_of([F.col(c).isNotNull() for c in history.on]))
        if sliced:
            end = F.col(f"__h{i}")["to"]
            events = _in_slices(events, [common], at, end, dense, bounds, bucket_days, SLICE)
        if hot is not None:
            last_part = F.coalesce("__parts", F.lit(1)).cast("bigint") - 1
            copies = F.explode(F.sequence(F.lit(0).cast("bigint"), last_part))
            events = events.join(F.broadcast(hot), common, "left").withColumn(part, copies)
            events = events.drop("__parts")
        else:
            events = events.withColumn(part, F.lit(0).cast("bigint"))
        streams.append(events)
    stream = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), streams)
    # Dealt once by what all keys share: rows of every longer key are then together as well.
    stream = stream.repartition(*dealt_by)
    # By the further columns of a key: columns of versions; and what each version gives.
    by_key: dict[tuple[str, ...], list[str]] = {}
    given: dict[str, str] = {}
    for i, history in enumerate(histories):
        rest = tuple(c for c in history.on if c != common)
        if isinstance(history, ChangeLog):
            stream = history.clean(stream, f"__h{i}", [*dealt_by, *rest], at)
            own = {name: f"__h_{name}" for name in history.casts}
        else:
            own = dict.fromkeys(history.values, f"__h{i}")
        by_key.setdefault(rest, []).extend(dict.fromkeys(own.values()))
        given |= own
    for rest, versions in by_key.items():
        window = (
            Window.partitionBy(*dealt_by, *rest)
            .orderBy(at, is_fact, *versions)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        carried = {v: F.last(v, ignorenulls=True).over(window) for v in versions}
        stream = stream.withColumns(carried)
    found = [
        F.when(F.col(v)["to"] > F.col(at), F.col(v)[name]).alias(name) for name, v in given.items()
    ]
    merged = stream.where(is_fact)
    return merged.select(*[F.col(fact)[c].alias(c) for c in facts.columns], *found)
