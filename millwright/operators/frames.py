"""Window functions over groups of any size.

Spark evaluates one window group in one task, and adaptive execution cannot
split it. Here the largest group is measured first. If it fits, the window is
an ordinary one. If not, the rows are range-partitioned on group and order,
cut into chunks there, and each chunk gets the few rows in front of
it that its frames reach back to. The result is the same to the last row.
Only groups above the limit are cut; all others keep an ordinary window.

Inputs are read more than once, so pass a stored table or a staged frame
(`workspace.stage`), not a long chain of joins. Where the number of rows is
known (`rows`) and already small, nothing is measured.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from millwright.workspace import stage, stage_counted

# Rows of one group that one task may take.
GROUP_ROWS = 5_000_000

_CHUNK, _HALO, _POS, _ROW, _TAIL, _PEERS, _SIZE = "_chunk", "_halo", "_pos", "_row", "_tail", "_peers", "_size"
_EARLIER = "_earlier"

Measure = Callable[[WindowSpec], Column]


def _ascending(columns: list[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in columns]


def _descending(columns: list[str]) -> list[Column]:
    return [F.col(c).desc_nulls_first() for c in columns]


@dataclass(frozen=True)
class _Split:
    """Rows of groups that fit one task, those of larger groups, and how many the latter are."""

    fitting: DataFrame
    hot: DataFrame
    hot_rows: int


def _split(df: DataFrame, group: list[str], limit: int, rows: int | None) -> _Split | None:
    """None if every group fits one task."""
    if rows is not None and rows <= limit:
        return None
    sizes = df.groupBy(*group).agg(F.count(F.lit(1)).alias(_SIZE)).where(F.col(_SIZE) > limit)
    # At most one group per `limit` rows.
    hot, n_hot = stage_counted(sizes)
    if not n_hot:
        return None
    hot_rows = hot.agg(F.sum(_SIZE)).first()[0]
    if not group:
        return _Split(df.where(F.lit(False)), df, hot_rows)
    keys = hot.select(*[F.col(c).alias(f"_h_{c}") for c in group])
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_h_{c}")) for c in group])
    return _Split(df.join(keys, same, "left_anti"), df.join(keys, same, "left_semi"), hot_rows)


def _chunked(split: _Split, group: list[str], order: list[Column], limit: int) -> DataFrame:
    """Hot rows in contiguous chunks of the order, chunk numbers rising within each group.

    Every `limit` rows of a sorted range are a chunk. There are as many ranges as a
    shuffle has partitions, or as chunks are needed if that is less, so tasks and
    files do not grow with the number of chunks; only beyond `GROUP_ROWS` rows a
    range there are more. The bounds are sampled, so the numbered rows are stored:
    every reader must see the same chunks, also after a lost executor.
    """
    keys = [*_ascending(group), *order]
    chunks = max(2, -(-split.hot_rows // limit))
    partitions = int(split.hot.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = min(chunks, max(partitions, -(-split.hot_rows // GROUP_ROWS)))
    spread = split.hot.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys)
    # The range stands above the lower 33 bits, the place in it below.
    row, place = F.col(_POS), F.col(_POS).bitwiseAND(F.lit((1 << 33) - 1))
    numbered = spread.withColumn(_POS, F.monotonically_increasing_id())
    return stage(numbered.withColumn(_CHUNK, row - place % F.lit(limit)).drop(_POS))


def over_preceding(
    df: DataFrame,
    group: list[str],
    order: list[str],
    depth: int,
    measures: dict[str, Measure],
    *,
    group_rows: int = GROUP_ROWS,
    rows: int | None = None,
) -> DataFrame:
    """Add window columns whose frames reach at most `depth` rows back and none ahead.

    Order is ascending with NULLs last.
    """
    def plain(some: DataFrame) -> DataFrame:
        window = Window.partitionBy(*group).orderBy(*_ascending(order))
        return some.withColumns({name: make(window) for name, make in measures.items()})

    split = _split(df, group, group_rows, rows)
    if split is None:
        return plain(df)

    chunked = _chunked(split, group, _ascending(order), group_rows)
    # The last `depth` rows of every chunk, oldest first. A chunk may hold fewer,
    # so a chunk looks at the `depth` chunks in front of it, which are never empty.
    from_end = Window.partitionBy(*group, _CHUNK).orderBy(*_descending(order))
    tails = (
        chunked.withColumn(_POS, F.row_number().over(from_end))
        .where(F.col(_POS) <= depth)
        .groupBy(*group, _CHUNK)
        .agg(F.sort_array(F.collect_list(F.struct(_POS, F.struct(*df.columns).alias(_ROW))), False).alias(_TAIL))
    )
    in_front = Window.partitionBy(*group).orderBy(_CHUNK).rowsBetween(-depth, -1)
    reach = F.flatten(F.collect_list(_TAIL).over(in_front))
    # Of those, only the last `depth` rows matter.
    nearest = F.slice(reach, F.greatest(F.size(reach) - F.lit(depth - 1), F.lit(1)), F.lit(depth))
    halo = (
        tails.withColumn(_TAIL, nearest)
        .select(_CHUNK, F.explode(_TAIL).alias(_TAIL))
        .select(F.col(f"{_TAIL}.{_ROW}.*"), _CHUNK)
        .withColumn(_HALO, F.lit(True))
    )
    # Rows that tie in the whole order may lie on both sides of a bound: those of the halo come first.
    window = Window.partitionBy(*group, _CHUNK).orderBy(*_ascending(order), F.col(_HALO).desc())
    hot = (
        chunked.withColumn(_HALO, F.lit(False))
        .unionByName(halo)
        .withColumns({name: make(window) for name, make in measures.items()})
        .where(~F.col(_HALO))
        .drop(_CHUNK, _HALO)
    )
    return plain(split.fitting).unionByName(hot)


@dataclass(frozen=True)
class Carried:
    """New rows with their window columns, and the last rows of every group for the next run."""

    rows: DataFrame
    tail: DataFrame


def over_carried(
    new: DataFrame,
    tail: DataFrame | None,
    group: list[str],
    order: list[str],
    depth: int,
    measures: dict[str, Measure],
    *,
    group_rows: int = GROUP_ROWS,
) -> Carried:
    """`over_preceding` for rows that come behind all earlier ones, whose last `depth` per group are in `tail`.

    The tail stands in front of the new rows and goes again; the result is the
    same as over all rows. Only `depth` rows per group are kept, whatever lies
    before. `new` should be staged, since it is read more than once.
    """
    columns = new.columns
    marked = new.withColumn(_EARLIER, F.lit(False))
    if tail is not None:
        marked = marked.unionByName(tail.select(*columns).withColumn(_EARLIER, F.lit(True)))
    done = over_preceding(marked, group, order, depth, measures, group_rows=group_rows)
    from_end = Window.partitionBy(*group).orderBy(*_descending(order))
    last = marked.withColumn(_POS, F.row_number().over(from_end)).where(F.col(_POS) <= depth)
    return Carried(done.where(~F.col(_EARLIER)).drop(_EARLIER), last.select(*columns))


def total_before(
    df: DataFrame,
    group: list[str],
    order: list[Column],
    totals: dict[str, str],
    *,
    group_rows: int = GROUP_ROWS,
    rows: int | None = None,
) -> DataFrame:
    """Add, per name, the sum of a column over all rows of the group before this one.

    The frame has no lower bound, so chunks get the sums of the chunks in front
    of them instead of single rows. `group` may be empty. The first row gets NULL.
    """
    def plain(some: DataFrame) -> DataFrame:
        before = _all_before(group, order)
        return some.withColumns({name: F.sum(column).over(before) for name, column in totals.items()})

    split = _split(df, group, group_rows, rows)
    if split is None:
        return plain(df)

    chunked = _chunked(split, group, order, group_rows)
    before_chunk, within = _all_before(group, [F.col(_CHUNK)]), _all_before([*group, _CHUNK], order)
    offset = {name: f"_offset_{name}" for name in totals}
    offsets = (
        chunked.groupBy(*group, _CHUNK)
        .agg(*[F.sum(column).alias(offset[name]) for name, column in totals.items()])
        .withColumns({offset[name]: F.sum(offset[name]).over(before_chunk) for name in totals})
    )
    local = chunked.withColumns({name: F.sum(column).over(within) for name, column in totals.items()})
    hot = (
        null_safe_join(local, offsets, [*group, _CHUNK])
        .withColumns({name: _sum_of(name, offset[name]) for name in totals})
        .drop(_CHUNK, *offset.values())
    )
    return plain(split.fitting).unionByName(hot) if group else hot


def _all_before(group: list[str], order: list[Column]) -> WindowSpec:
    return Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)


def _sum_of(*names: str) -> Column:
    """The sum of two columns, where NULL stands for no rows."""
    first, second = (F.col(name) for name in names)
    return F.coalesce(first + second, first, second)


def with_rank(
    df: DataFrame,
    group: list[str],
    value: str,
    name: str,
    *,
    group_rows: int = GROUP_ROWS,
    rows: int | None = None,
) -> DataFrame:
    """Add RANK by `value` descending (NULLs last): ties share a rank, the next one is skipped."""
    highest_first = F.col(value).desc_nulls_last()

    def plain(some: DataFrame) -> DataFrame:
        return some.withColumn(name, F.rank().over(Window.partitionBy(*group).orderBy(highest_first)))

    split = _split(df, group, group_rows, rows)
    if split is None:
        return plain(df)

    # A rank is one plus the number of rows with a greater value. Counting per
    # distinct value first turns any number of ties into one row.
    peers, values = stage_counted(split.hot.groupBy(*group, value).agg(F.count(F.lit(1)).alias(_PEERS)))
    greater = total_before(
        peers, group, [highest_first], {name: _PEERS}, group_rows=group_rows, rows=values
    )
    place = (F.coalesce(F.col(name), F.lit(0)) + 1).cast("int").alias(name)
    hot = null_safe_join(split.hot, greater.select(*group, value, place), [*group, value])
    return plain(split.fitting).unionByName(hot)


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join where NULL keys are equal, as they are in a grouping."""
    renamed = right.withColumnsRenamed({key: f"_r_{key}" for key in keys})
    matches = F.lit(True)
    for key in keys:
        matches = matches & F.col(key).eqNullSafe(F.col(f"_r_{key}"))
    return left.join(renamed, matches, "inner").drop(*[f"_r_{key}" for key in keys])
