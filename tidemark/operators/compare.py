"""Differences between two inventories, two tables or two builds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.fingerprint import identity, row_hash
from tidemark.functions.scalars import quoted
from tidemark.session import staged

SHA256 = r"^[0-9a-f]{64}\z"


def inventory_problems(files: DataFrame) -> DataFrame:
    """Paths that are missing or repeated and sizes that are missing or negative."""
    named = files.groupBy("path").agg(
        F.expr("count(*) as n"), F.expr("count_if(size is null or size < 0) as bad_sizes")
    )
    return named.filter("path is null or path = '' or n > 1 or bad_sizes > 0")


class ComparisonError(ValueError):
    """What is to be compared is itself not sound."""


def require_sound(files: DataFrame, side: str) -> None:
    """Action: refuse an inventory with repeated or blank paths or bad sizes."""
    bad = inventory_problems(files).orderBy("path").limit(5).collect()
    if bad:
        raise ComparisonError(f"{side} inventory: bad rows at {[r.path for r in bad]}")


def compare_inventories(local: DataFrame, other: DataFrame, checksums: bool = True) -> DataFrame:
    """(path, difference) over files(path, size, sha256): one full outer join on path.

    A file can differ in several ways; each is one row. Unsound inventories are refused first.
    """
    require_sound(local, "local")
    require_sound(other, "other")
    left = local.selectExpr("path", "size as size_a", "sha256 as hash_a", "true as in_a")
    right = other.selectExpr("path", "size as size_b", "sha256 as hash_b", "true as in_b")
    both = "in_a and in_b"
    hashed = f"coalesce(hash_a rlike r'{SHA256}' and hash_b rlike r'{SHA256}', false)"
    differences = [
        "if(in_a is null, 'missing_local', null)",
        "if(in_b is null, 'extra_local', null)",
        f"if({both} and size_a is distinct from size_b, 'size_mismatch', null)",
        f"if({both} and {hashed} and hash_a <> hash_b, 'hash_mismatch', null)",
    ]
    if checksums:
        differences.append(f"if({both} and not {hashed}, 'missing_checksum', null)")
    return left.join(right, "path", "full").selectExpr(
        "path", f"explode(array_compact(array({', '.join(differences)}))) as difference"
    )


def inventory_totals(local: DataFrame, other: DataFrame) -> DataFrame:
    """File counts, bytes and top directories of both sides, as one row per side."""
    def side(files: DataFrame, name: str) -> DataFrame:
        top = "if(instr(path, '/') > 0, substring_index(path, '/', 1), null)"
        per_directory = files.groupBy(F.expr(f"{top} as directory")).agg(
            F.expr("count(*) as n"), F.expr("sum(size) as bytes")
        )
        return per_directory.groupBy().agg(
            F.lit(name).alias("side"),
            F.expr("coalesce(sum(n), 0) as file_count"),
            F.expr("coalesce(sum(bytes), 0) as total_bytes"),
            F.expr("count(directory) as directories"),
            F.expr("cast(coalesce(sum(cast(xxhash64(directory) as decimal(38,0))), 0) as string) "
                   "as directory_hash"),
        )

    return side(local, "local").unionByName(side(other, "other"))


def scoped_inventory(files: DataFrame) -> DataFrame:
    """Leave out documents lying in the root directory."""
    return files.filter("not (instr(path, '/') = 0 and endswith(lower(path), '.md'))")


def table_diff(first: DataFrame, second: DataFrame, key: list[str]) -> DataFrame:
    """Row-level differences of two builds of one table: key, kind and changed columns.

    Null key parts are equal to each other. A key that is repeated on either side is reported as
    'repeated_key', as its rows cannot be told apart. A table may consist of its key alone.
    """
    if first.columns != second.columns:
        raise ValueError(f"schemas differ: {first.columns} / {second.columns}")
    others = [c for c in first.columns if c not in key]
    packed = f"named_struct({', '.join(f'{quoted(c)}, `{c}`' for c in others) or quoted('_') + ', 1'})"

    def side(df: DataFrame, which: str) -> DataFrame:
        return df.selectExpr(*[f"`{c}`" for c in key], f"{packed} as _row", f"{which} as _side")

    # One aggregate on the key takes the place of a join: grouping treats nulls as equal.
    both = side(first, "1").unionByName(side(second, "2")).groupBy(*key).agg(
        F.expr("count_if(_side = 1) as _a_rows"), F.expr("count_if(_side = 2) as _b_rows"),
        F.expr("max_by(_row, if(_side = 1, 1, null)) as _a_row"),
        F.expr("max_by(_row, if(_side = 2, 1, null)) as _b_row"),
    )
    changed = ", ".join(
        f"if(_a_row.`{c}` is distinct from _b_row.`{c}`, {quoted(c)}, null)" for c in others
    ) or "cast(null as string)"
    return both.selectExpr(
        *[f"`{c}`" for c in key],
        "case when _a_rows > 1 or _b_rows > 1 then 'repeated_key' "
        "when _b_rows = 0 then 'only_first' when _a_rows = 0 then 'only_second' "
        "else 'changed' end as difference",
        "if(_a_rows = 1 and _b_rows = 1, "
        f"array_join(array_compact(array({changed})), ','), '') as changed_columns",
    ).filter("difference <> 'changed' or changed_columns <> ''")


#: Leaves of a table's hash tree; a bounded number of rows, whatever the table's size.
BUCKETS = 1 << 14


def hash_tree(df: DataFrame, key: list[str]) -> DataFrame:
    """Staged leaves (bucket, row_count, hash_sum, hash_xor): fingerprints of a table's rows by a
    hash of their key. Aggregates combine map-side, so a task shuffles at most BUCKETS small rows."""
    nulls = ", ".join(f"`{c}` is null" for c in key)
    place = F.expr(f"pmod(xxhash64({nulls}, {', '.join(f'`{c}`' for c in key)}), {BUCKETS})")
    rows = df.select(place.alias("bucket"), row_hash(df, sorted(df.columns)).alias("h"))
    return staged(rows.groupBy("bucket").agg(*identity()))


def differing_buckets(first: DataFrame, second: DataFrame, fan: int = 128) -> DataFrame:
    """Buckets whose leaves differ between two hash trees, found from the root down: inner nodes are
    sums over ``fan`` children, and only leaves below differing nodes are compared."""
    def node(tree: DataFrame, width: int) -> DataFrame:
        return tree.groupBy(F.expr(f"bucket div {width}").alias("node")).agg(
            F.sum("row_count").alias("n"), F.sum(F.col("hash_sum").cast("decimal(38,0)")).alias("s"),
            F.expr("bit_xor(cast(hash_xor as bigint))").alias("x"))

    below = None
    for width in (BUCKETS, fan, 1):
        pair = [node(t if below is None else t.join(F.broadcast(below), F.expr("bucket div _width = _node"), "left_semi"),
                     width) for t in (first, second)]
        found = staged(pair[0].exceptAll(pair[1]).unionByName(pair[1].exceptAll(pair[0])).select("node").distinct())
        below = found.selectExpr("node as _node", f"bigint({width}) as _width")
        if found.isEmpty():
            break
    return found.withColumnRenamed("node", "bucket")


def compare_tables(first: DataFrame, second: DataFrame, key: list[str]) -> DataFrame:
    """:func:`table_diff` of two large builds of one table, of which little differs.

    Each table is read once for its hash tree. Equal tables end there; otherwise only rows of
    differing buckets are shuffled and held against each other.
    """
    if first.columns != second.columns:
        raise ValueError(f"schemas differ: {first.columns} / {second.columns}")
    found = differing_buckets(hash_tree(first, key), hash_tree(second, key))
    if found.isEmpty():
        return table_diff(first.limit(0), second.limit(0), key)
    nulls = ", ".join(f"`{c}` is null" for c in key)
    place = F.expr(f"pmod(xxhash64({nulls}, {', '.join(f'`{c}`' for c in key)}), {BUCKETS}) = bucket")
    sides = [df.join(F.broadcast(found), place, "left_semi") for df in (first, second)]
    return table_diff(*sides, key)


def compare_manifests(first: DataFrame, second: DataFrame) -> DataFrame:
    """(table_name, field): manifest fields that differ between two builds; none means equal."""
    fields = ["layer", "row_count", "primary_key", "schema_json", "config_hash", "hash_sum",
              "hash_xor"]
    joined = first.selectExpr(
        "table_name", f"struct({', '.join(fields)}) as a"
    ).join(
        second.selectExpr("table_name", f"struct({', '.join(fields)}) as b"), "table_name", "full"
    )
    differing = ", ".join(
        f"if(a.{f} is distinct from b.{f}, {quoted(f)}, null)" for f in fields
    )
    return joined.selectExpr(
        "table_name",
        f"explode(case when a is null then array('missing_first') when b is null "
        f"then array('missing_second') else array_compact(array({differing})) end) as field",
    )
