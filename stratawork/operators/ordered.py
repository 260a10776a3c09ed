"""Ordered per-group calculations that survive groups too large for one task.

A Spark window puts a whole group into one task. That is fine for ordinary groups and is
used for them. The rows of groups above ``max_group_rows`` are cut by range into ordered
slices, each slice is scanned on its own, and what the earlier slices of the group contribute
(one summary row per slice) is added afterwards. No row is dropped, and both ways give the
same rows, types and errors for sums of integers and decimals. Sums of doubles depend on their
order, so ``running`` does not take them.

Order columns are named; a leading ``-`` means descending. NULLs come first in ascending and
last in descending order, as in Spark.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..workspace import durable
from .joins import DEFAULT_BROADCAST_BYTES, broadcast_when_small, join_null_safe, measured_bytes

MAX_GROUP_ROWS = 5_000_000
#: Stands for MAX_GROUP_ROWS as it is when a scan is made.
DEFAULT = 0
_SLICE = "__slice"


@dataclass
class Wanted:
    """The columns a scan adds."""

    row_number: str | None = None
    rank: str | None = None
    dense_rank: str | None = None
    running: dict[str, Column] = field(default_factory=dict)
    following: dict[str, str] = field(default_factory=dict)

    @property
    def names(self) -> list[str]:
        single = (self.row_number, self.rank, self.dense_rank)
        return [*self.running, *self.following, *[n for n in single if n]]

    @property
    def peers(self) -> bool:
        return bool(self.rank or self.dense_rank)


def _is_descending(name: str) -> bool:
    return name.startswith("-")


def _ordering(order: list[str]) -> list[Column]:
    return [F.col(o[1:]).desc() if _is_descending(o) else F.col(o).asc() for o in order]


def slices_for(rows: int, max_group_rows: int) -> int:
    """Enough slices that each is well below the group limit."""
    return 1 + 2 * rows // max(1, max_group_rows)


def ordered_scan(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    *,
    row_number: str | None = None,
    rank: str | None = None,
    dense_rank: str | None = None,
    running: dict[str, Column] | None = None,
    following: dict[str, str] | None = None,
    max_group_rows: int | None = DEFAULT,
) -> DataFrame:
    """Positions, running sums and next-row values per group.

    ``order`` must end in a column that is unique within the group, so that the result is
    defined. ``rank`` and ``dense_rank`` follow the first order column alone. ``running`` maps a
    new column to the summed expression (rows frame from the start of the group), ``following``
    maps a new column to the column whose next value it shows. ``max_group_rows=None`` skips the
    measurement where the groups are small by construction; otherwise one count per group is
    written as this function is called, and, if a group is large, the rows as well, so that ``df``
    is worked out once for the count and once for the result.
    """
    want = Wanted(row_number, rank, dense_rank, running or {}, following or {})
    plain = _plain_scan(df, keys, order, want)
    if any(isinstance(plain.schema[n].dataType, (T.DoubleType, T.FloatType)) for n in want.running):
        raise TypeError("running sums take integers and decimals, whose order of addition does not matter")
    if max_group_rows is None:
        return plain
    max_group_rows = max_group_rows or MAX_GROUP_ROWS
    # Map-side counts; two numbers reach the driver.
    large = durable(df.groupBy(*keys).count().filter(F.col("count") > max_group_rows), "hot-keys")
    groups, rows = large.agg(F.count("*"), F.sum("count")).first()
    if not groups:
        return plain
    df = durable(df, "ordered-input")
    hot_keys = broadcast_when_small(large.select(*[F.col(k).alias(f"__hot_{k}") for k in keys]))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__hot_{k}")) for k in keys])
    hot = df.join(hot_keys, same, "left_semi")
    rest = df.join(hot_keys, same, "left_anti")
    sliced = _sliced_scan(hot, keys, order, want, slices_for(rows, max_group_rows))
    sliced = sliced.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in plain.schema.fields])
    return _plain_scan(rest, keys, order, want).unionByName(sliced)


def _local_columns(keys: list[str], order: list[str], want: Wanted) -> dict[str, Column]:
    full = Window.partitionBy(*keys).orderBy(*_ordering(order))
    so_far = full.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    peers = Window.partitionBy(*keys).orderBy(*_ordering(order[:1]))
    added = {name: F.sum(expr).over(so_far) for name, expr in want.running.items()}
    added |= {name: F.lead(column).over(full) for name, column in want.following.items()}
    if want.row_number:
        added[want.row_number] = F.row_number().over(full).cast("long")
    if want.rank:
        added[want.rank] = F.rank().over(peers).cast("long")
    if want.dense_rank:
        added[want.dense_rank] = F.dense_rank().over(peers).cast("long")
    return added


def _plain_scan(df: DataFrame, keys: list[str], order: list[str], want: Wanted) -> DataFrame:
    return df.withColumns(_local_columns(keys, order, want))


def _sliced_scan(df: DataFrame, keys: list[str], order: list[str], want: Wanted, slices: int) -> DataFrame:
    # The slice number must be the same for every reader below, hence the written stage.
    ranged = df.repartitionByRange(slices, *[F.col(k) for k in keys], *_ordering(order))
    scanned = durable(ranged.withColumn(_SLICE, F.spark_partition_id()), "slices")

    by_slice = [*keys, _SLICE]
    local = Wanted(
        "__row",
        "__rank" if want.peers else None,
        "__dense" if want.peers else None,
        {f"__sum_{n}": e for n, e in want.running.items()},
        {f"__next_{n}": c for n, c in want.following.items()},
    )
    source, scanned = scanned, scanned.withColumns(_local_columns(by_slice, order, local))
    if want.peers or want.following:
        source = scanned = durable(scanned, "scanned")
    offsets = _slice_offsets(source, keys, order, want)

    offsets = durable(offsets, "offsets")
    joined = join_null_safe(scanned, offsets, by_slice, broadcast=measured_bytes(offsets) <= DEFAULT_BROADCAST_BYTES)
    result = {}
    for name in want.running:
        here, earlier = F.col(f"__sum_{name}"), F.col(f"__before_{name}")
        result[name] = F.coalesce(here + earlier, here, earlier)
    for name in want.following:
        is_last = F.col("__row") == F.col("__rows")
        result[name] = F.when(is_last, F.col(f"__head_{name}")).otherwise(F.col(f"__next_{name}"))
    if want.row_number:
        result[want.row_number] = F.col("__row") + F.col("__rows_before")
    if want.rank:
        starts_slice = F.col("__rank") == 1
        result[want.rank] = F.when(starts_slice, F.col("__first_start")).otherwise(
            F.col("__rank") + F.col("__rows_before")
        )
    if want.dense_rank:
        result[want.dense_rank] = F.col("__dense") + F.col("__values_before")
    return joined.withColumns(result).select(*df.columns, *want.names)


def _slice_offsets(scanned: DataFrame, keys: list[str], order: list[str], want: Wanted) -> DataFrame:
    """What precedes each slice of each group; at most (slices + groups) rows."""
    totals = {"__rows": F.count("*")}
    totals |= {f"__sum_{n}": F.sum(e) for n, e in want.running.items()}
    totals |= {f"__head_{n}": F.max_by(F.col(c), F.when(F.col("__row") == 1, 1)) for n, c in want.following.items()}
    if want.peers:
        value = order[0].removeprefix("-")
        missing, low, high = F.count_if(F.col(value).isNull()) > 0, F.min(value), F.max(value)
        with_null = F.when(~missing, low)
        first, last = (high, with_null) if _is_descending(order[0]) else (with_null, high)
        totals |= {"__first": first, "__last": last, "__last_rank": F.max("__rank"), "__values": F.max("__dense")}
    slices = scanned.groupBy(*keys, _SLICE).agg(*[e.alias(n) for n, e in totals.items()])

    along = Window.partitionBy(*keys).orderBy(_SLICE)
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    carried = {"__rows_before": F.coalesce(F.sum("__rows").over(before), F.lit(0))}
    carried |= {f"__before_{n}": F.sum(f"__sum_{n}").over(before) for n in want.running}
    carried |= {f"__head_{n}": F.lead(f"__head_{n}").over(along) for n in want.following}
    offsets = slices.withColumns(carried)
    if want.peers:
        # Equal values may lie across a cut: such a slice continues the peers of the one before.
        continues = F.col("__first").eqNullSafe(F.lag("__last").over(along)) & F.lag("__rows").over(along).isNotNull()
        offsets = offsets.withColumns(
            {
                "__continues": F.coalesce(continues, F.lit(False)),
                "__last_start": F.min(F.col("__rows_before") + F.col("__last_rank")).over(
                    Window.partitionBy(*keys, "__last")
                ),
            }
        )
        upto = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        values_before = F.coalesce(F.sum("__values").over(before), F.lit(0))
        offsets = offsets.withColumns(
            {
                "__first_start": F.when(F.col("__continues"), F.lag("__last_start").over(along)).otherwise(
                    F.col("__rows_before") + 1
                ),
                "__values_before": values_before - F.sum(F.col("__continues").cast("int")).over(upto),
            }
        )
    kept = ["__rows", "__rows_before", *[f"__before_{n}" for n in want.running]]
    kept += [f"__head_{n}" for n in want.following]
    kept += ["__first_start", "__values_before"] if want.peers else []
    return offsets.select(*keys, _SLICE, *kept)


def in_blocks(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    back: int,
    compute: Callable[[DataFrame, list[str]], DataFrame],
    *,
    first: dict[str, str] | None = None,
    max_group_rows: int | None = DEFAULT,
) -> DataFrame:
    """``compute(df, keys)`` for groups of any size, where its windows look back ``back`` rows at most.

    ``compute`` adds columns by windows over the keys it is given, in ``order``, which must be unique within the group.
    Rows of groups above ``max_group_rows`` are numbered and cut into blocks; each block also gets the
    ``back`` rows before it, which only its windows see. ``first`` maps a new column, for ``compute`` to use, to the
    column whose value in the group's first row it shows. ``max_group_rows=None`` skips the
    measurement where groups are small by construction.
    """
    first = first or {}

    def with_first(rows: DataFrame) -> DataFrame:
        start = Window.partitionBy(*keys).orderBy(*_ordering(order)).rowsBetween(Window.unboundedPreceding, 0)
        return rows.withColumns({name: F.first(column).over(start) for name, column in first.items()})

    plain = compute(with_first(df), keys).drop(*first)
    if max_group_rows is None:
        return plain
    limit = max_group_rows or MAX_GROUP_ROWS
    df = durable(df, "series")
    large = durable(df.groupBy(*keys).count().filter(F.col("count") > limit), "long-series")
    if large.isEmpty():
        return compute(with_first(df), keys).drop(*first)
    hot_keys = broadcast_when_small(large.select(*[F.col(k).alias(f"__hot_{k}") for k in keys]))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__hot_{k}")) for k in keys])
    rest = df.join(hot_keys, same, "left_anti")
    rows = ordered_scan(df.join(hot_keys, same, "left_semi"), keys, order, row_number="__row", max_group_rows=limit)
    # a block of at least ``back`` rows lends rows to the next block only
    size = max(limit // 2, back, 1)
    block, place = F.floor((F.col("__row") - 1) / size), (F.col("__row") - 1) % size
    lent = F.when(place >= size - back, F.array(block, block + 1)).otherwise(F.array(block))
    blocks = rows.withColumn("__own_block", block).withColumn("__block", F.explode(lent))
    if first:
        heads = durable(rows.filter("__row = 1").select(*keys, *[F.col(c).alias(n) for n, c in first.items()]), "heads")
        blocks = join_null_safe(blocks, heads, keys, broadcast=measured_bytes(heads) <= DEFAULT_BROADCAST_BYTES)
    done = compute(blocks, [*keys, "__block"]).filter("__block = __own_block")
    return compute(with_first(rest), keys).drop(*first).unionByName(done.select(*plain.columns))


def running_total_of_peers(
    df: DataFrame,
    keys: list[str],
    order: str,
    amount: Column,
    name: str = "running_total",
    *,
    max_group_rows: int = DEFAULT,
) -> DataFrame:
    """Running total with the default RANGE frame: rows equal in ``order`` share one total.

    Groups within the limit take one window. If a group is larger, peers fold to one row each
    before the ordered pass, and the totals are joined back.
    """
    frame = Window.partitionBy(*keys).orderBy(*_ordering([order]))
    plain = df.withColumn(name, F.sum(amount).over(frame))
    limit = max_group_rows or MAX_GROUP_ROWS
    if df.groupBy(*keys).count().filter(F.col("count") > limit).isEmpty():
        return plain
    df = durable(df, "peers-input")
    folded = df.groupBy(*keys, order).agg(F.sum(amount).alias("__amount"))
    totals = ordered_scan(
        folded, keys, [order], running={name: F.col("__amount")}, max_group_rows=max_group_rows
    ).drop("__amount")
    joined = join_null_safe(df, totals, [*keys, order])
    return joined.withColumn(name, F.col(name).cast(plain.schema[name].dataType))


def top_rows(df: DataFrame, keys: list[str], order: list[str], n: int, position: str = "position") -> DataFrame:
    """First ``n`` rows of each group.

    Spark cuts every map task to ``n`` rows per group before the shuffle (WindowGroupLimit),
    so a hot group never travels whole.
    """
    window = Window.partitionBy(*keys).orderBy(*_ordering(order))
    return df.withColumn(position, F.row_number().over(window)).filter(F.col(position) <= n)


def paged_lists(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    item: Column,
    *,
    page_rows: int = 1000,
    name: str = "items",
    max_group_rows: int = DEFAULT,
) -> DataFrame:
    """Ordered list of each group, cut into pages of at most ``page_rows`` elements.

    Nothing is left out, and no array can outgrow a row however large the group is.
    """
    numbered = ordered_scan(df, keys, order, row_number="__row", max_group_rows=max_group_rows)
    paged = numbered.withColumn("page_no", F.floor((F.col("__row") - 1) / page_rows))
    element = F.struct(F.col("__row"), item.alias("item"))
    collected = paged.groupBy(*keys, "page_no").agg(F.sort_array(F.collect_list(element)).alias("__list"))
    return collected.select(*keys, "page_no", F.col("__list.item").alias(name))
