"""Idempotent and incremental loads without a transactional table format."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..workspace import durable
from .cleanse import remove_duplicates
from .joins import broadcast_when_small
from .quality import duplicate_keys


class DuplicateSourceKeys(ValueError):
    """The source of an upsert holds several rows for one key."""


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    *,
    order_by: list[str] | None = None,
    source_is_unique: bool = False,
) -> DataFrame:
    """Matched keys take the source row, others are added; applying it twice changes nothing.

    An ambiguous source is an error, as several rows would claim one target row. Pass
    ``order_by`` to let the last row in that order win, or ``source_is_unique`` to skip the
    check where the caller has made it. Otherwise the source is written once, and check and merge
    read it there.
    """
    if order_by:
        source = remove_duplicates(source, keys, keep="last", order_by=order_by)
    elif not source_is_unique:
        source = durable(source, "upsert-source")
        if not duplicate_keys(source, keys).isEmpty():
            raise DuplicateSourceKeys(f"source has several rows for one {keys}")
    untouched = target.join(source.select(*keys), keys, "left_anti")
    return untouched.unionByName(source.select(*target.columns))


def high_water_mark(df: DataFrame, column: str):
    """Largest loaded value; one row reaches the driver, where it becomes a pushed literal."""
    return df.agg(F.max(column)).first()[0]


def later_mark(old, new):
    """The larger of two marks; an empty batch never moves the mark back."""
    known = [m for m in (old, new) if m is not None]
    return max(known) if known else None


def rows_after(df: DataFrame, column: str, mark, *, inclusive: bool = False) -> DataFrame:
    """Rows past the mark. ``inclusive`` re-reads rows that share the mark (safe with upsert)."""
    if mark is None:
        return df
    limit = mark if isinstance(mark, Column) else F.lit(mark)
    return df.filter(F.col(column) >= limit if inclusive else F.col(column) > limit)


@dataclass(frozen=True)
class TimestampLoad:
    """Result of :func:`load_after_timestamp`."""

    merged: DataFrame
    rejected: DataFrame
    _mark: object
    _fresh: DataFrame
    _modified: str

    def next_mark(self):
        """The mark for the next load; scans the loaded rows when asked for."""
        return later_mark(self._mark, high_water_mark(self._fresh, self._modified))


def load_after_timestamp(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    modified: str,
    *,
    inclusive: bool = True,
    order_by: list[str] | None = None,
) -> TimestampLoad:
    """Watermark load: upsert the rows modified at or after the newest loaded row.

    Rows that share the mark are read again, since more of them may have come since; the upsert makes
    that harmless. Rows without a modification time are in ``rejected``.
    """
    mark = high_water_mark(target, modified)
    fresh = rows_after(source.filter(F.col(modified).isNotNull()), modified, mark, inclusive=inclusive)
    merged = upsert(target, fresh, keys, order_by=order_by or [modified, *keys])
    return TimestampLoad(merged, source.filter(F.col(modified).isNull()), mark, fresh, modified)


def load_after_sequence(target: DataFrame, source: DataFrame, sequence: str) -> DataFrame:
    """Append the rows whose sequence number is above every loaded one."""
    fresh = rows_after(source, sequence, high_water_mark(target, sequence))
    return target.unionByName(fresh.select(*target.columns))


def load(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    *,
    mode: str,
    process_date: str,
    date_column: str,
) -> DataFrame:
    """``full`` replaces the target by the source; ``incremental`` merges one processing date."""
    if mode == "full":
        return source
    if mode != "incremental":
        raise ValueError(f"mode must be 'full' or 'incremental', not {mode!r}")
    of_date = source.filter(F.to_date(F.col(date_column)) == F.to_date(F.lit(process_date)))
    return upsert(target, of_date, keys)


def union_widening(frames: list[DataFrame]) -> DataFrame:
    """UNION ALL by name; columns a frame lacks are NULL."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


def passes_rules(df: DataFrame, rules: list[Column]) -> DataFrame:
    """Rows that satisfy every business rule; unknown does not satisfy."""
    for rule in rules:
        df = df.filter(rule)
    return df


# Versioned change log: rows with _version, _op (insert, update, delete) and _ts.


def as_of(changes: DataFrame, keys: list[str], version: int) -> DataFrame:
    """Table content at ``version``: newest change per key, deleted keys left out.

    A key with a billion changes sends one row per map task to the shuffle.
    """
    past = changes.filter(F.col("_version") <= version)
    newest = remove_duplicates(past, keys, keep="last", order_by=["_version"])
    return newest.filter("_op <> 'delete'").drop("_version", "_op", "_ts")


def history(changes: DataFrame, newest: int | None = None) -> DataFrame:
    """Number of changes per version and kind, newest version first."""
    log = changes.groupBy("_version").agg(
        F.min("_ts").alias("committed_at"),
        F.count("*").alias("changed_rows"),
        F.count_if(F.col("_op") == "insert").alias("inserted"),
        F.count_if(F.col("_op") == "update").alias("updated"),
        F.count_if(F.col("_op") == "delete").alias("deleted"),
    )
    ordered = log.orderBy(F.desc("_version"))
    return ordered.limit(newest) if newest else ordered


def change_feed(changes: DataFrame, keys: list[str], start: int, end: int) -> DataFrame:
    """Net inserts, updates and deletes between two versions.

    The newest change up to ``start`` and up to ``end`` come from one aggregation per key:
    one scan and one shuffle, with partial results on the map side.
    """
    values = [c for c in changes.columns if c not in (*keys, "_version", "_op", "_ts")]
    version = F.col("_version")
    state = F.struct(F.col("_op"), F.struct(*values).alias("row"))
    folded = (
        changes.filter(version <= end)
        .groupBy(*keys)
        .agg(
            F.max(version).alias("__last"),
            F.max_by(state, F.when(version <= start, version)).alias("__old"),
            F.max_by(state, version).alias("__new"),
        )
        .filter(F.col("__last") > start)
    )

    def present(name):
        return F.when(F.col(f"{name}._op") != "delete", F.col(f"{name}.row"))

    both = folded.select(*keys, present("__old").alias("__old"), present("__new").alias("__new"))
    kind = (
        F.when(F.col("__old").eqNullSafe(F.col("__new")), None)
        .when(F.col("__old").isNull(), "insert")
        .when(F.col("__new").isNull(), "delete")
        .otherwise("update")
    )
    shown = F.coalesce("__new", "__old")
    changed = both.withColumn("_change", kind).filter(F.col("_change").isNotNull())
    return changed.select(*keys, "_change", *[shown[v].alias(v) for v in values])


# Checkpoint table: one row per pipeline and checkpoint type.

CHECKPOINT_SCHEMA = (
    "pipeline_name string, checkpoint_type string, checkpoint_value string, updated_at timestamp"
)
CHECKPOINT_KEYS = ["pipeline_name", "checkpoint_type"]


def save_checkpoint(checkpoints: DataFrame, updates: DataFrame) -> DataFrame:
    """New checkpoint state; rows of other pipelines stay."""
    return upsert(checkpoints, updates, CHECKPOINT_KEYS)


def checkpoint_value(checkpoints: DataFrame, name: str, kind: str, as_type: str):
    """Stored value in its own type, so that marks compare as times or numbers, not text."""
    row = (
        checkpoints.filter((F.col("pipeline_name") == name) & (F.col("checkpoint_type") == kind))
        .select(F.col("checkpoint_value").cast(as_type))
        .first()
    )
    return row[0] if row else None


def resume_by_partition(source: DataFrame, marks: DataFrame, key: str, position: str, mark: str) -> DataFrame:
    """Rows past the stored mark of their own key; keys without a mark are read whole.

    Rows without a position cannot be placed before the mark and are read each time.

    The marks are broadcast when they measure small, so the source is not shuffled by a key
    that few pipelines share.
    """
    joined = source.join(broadcast_when_small(marks.select(key, mark)), key, "left")
    past = F.col(mark).isNull() | F.col(position).isNull() | (F.col(position) > F.col(mark))
    return joined.filter(past).drop(mark)
