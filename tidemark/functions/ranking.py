"""Exact row numbers without putting one hot group into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.session import staged


#: Groups of more rows than this, and than all rows / MAX_LARGE, are numbered slice by slice.
LARGE, MAX_LARGE = 500_000, 20_000


def split_row_number(
    df: DataFrame, group: list[str], order: str, tie_hash: str, name: str, digits: int = 2
) -> DataFrame:
    """``row_number() over (partition by group order by order nulls last, tie_hash)`` for groups
    of any size. Hand it narrow rows of a written table and join the number back.

    Groups are counted with map-side combine. Fewer than MAX_LARGE of them can be large; these are
    broadcast and numbered by slices, all others by one window, and both parts are united: one
    plan, whatever the sizes.
    """
    rows = df.count()
    limit = max(LARGE, rows // MAX_LARGE)
    large = staged(df.groupBy(*group).count().filter(f"count > {limit}").select(
        *[F.col(c).alias(f"_g{i}") for i, c in enumerate(group)]))
    of_large = F.expr(" and ".join(f"`{c}` <=> _g{i}" for i, c in enumerate(group)))
    listed = ", ".join(f"`{c}`" for c in group)
    small = df.join(F.broadcast(large), of_large, "left_anti").selectExpr(
        "*", f"cast(row_number() over (partition by {listed} order by {order} nulls last, {tie_hash}) "
             f"as bigint) as {name}")
    return small.unionByName(
        _by_slices(df.join(F.broadcast(large), of_large, "left_semi"), group, order, tie_hash, name, digits))


def _by_slices(
    df: DataFrame, group: list[str], order: str, tie_hash: str, name: str, digits: int
) -> DataFrame:
    """The same numbers without ever sorting a group as a whole.

    ``tie_hash`` is a uniform hex digest, so its first ``digits`` characters cut every group
    into order-preserving slices. Slices are counted with map-side partial aggregation, the
    counts (at most ordering values x 16^digits rows per group) are prefix-summed, and the
    rows themselves are numbered slice by slice.
    """
    columns = [*group, "_order", "_slice"]
    sliced = df.selectExpr(
        "*", f"{order} as _order", f"substring({tie_hash}, 1, {digits}) as _slice"
    )
    # Renamed keys keep the null-safe join unambiguous.
    renamed = {name: f"_k{i}" for i, name in enumerate(columns)}
    groups = ", ".join(renamed[name] for name in group)
    counts = (
        sliced.groupBy(*columns)
        .agg(F.expr("count(*) as _n"))
        .withColumnsRenamed(renamed)
        .selectExpr(
            *renamed.values(),
            f"sum(_n) over (partition by {groups} order by {renamed['_order']} nulls last, "
            f"{renamed['_slice']}) - _n as _before",
        )
    )
    match = " and ".join(f"`{name}` <=> {key}" for name, key in renamed.items())
    listed = ", ".join(f"`{name}`" for name in columns)
    return sliced.join(counts, F.expr(match)).selectExpr(
        *[f"`{c}`" for c in df.columns],
        f"_before + row_number() over (partition by {listed} order by {tie_hash}) as {name}",
    )
