"""Announcement-lagged filings that keep every revision."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.fingerprint import record_id
from tidemark.functions.ranking import split_row_number
from tidemark.functions.scalars import day_of, exprs, is_blank, is_security_code, quoted
from tidemark.operators.calendar import bounds, lookup_days
from tidemark.session import staged

FILING_DATES = ("ann_date", "f_ann_date", "end_date")


def own_columns(raw: DataFrame) -> list[str]:
    """Vendor columns; lineage columns take no part in a record's identity."""
    return [c for c in raw.columns if not c.startswith("_source_")]


def record_locations(raw: DataFrame, source_table: str) -> DataFrame:
    """Every place each record was seen: (source_table, record_id, file, row).

    This child table carries the complete lineage. A list per record would grow with the
    number of copies, and one much-copied record could then outgrow a task.
    """
    return raw.select(
        F.lit(source_table).alias("source_table"),
        record_id(source_table, own_columns(raw)).alias("record_id"),
        F.col("_source_file").alias("file"), F.col("_source_row").alias("row"),
    )


def first_copies(sources: dict[str, DataFrame], carried: tuple[str, ...] = ()) -> DataFrame:
    """Staged: (source_table, record_id, source_count, source_file, source_row, carried...), one
    row per distinct record of all sources.

    One scan and one hash per row, of which only the id, the place and the carried columns go on;
    copies are collapsed map-side. Whatever follows reads this table and meets the wide rows by
    their place.
    """
    parts = []
    for table, raw in sources.items():
        kept = [f"`{c}`" if c in raw.columns else f"cast(null as string) as `{c}`" for c in carried]
        parts.append(raw.withColumn("_id", record_id(table, own_columns(raw))).selectExpr(
            f"{quoted(table)} as source_table", "_id as record_id",
            "struct(_source_file as file, _source_row as row) as _place", *kept))
    keys = ["source_table", "record_id", *carried]  # a record has one value of each carried column
    return staged(
        reduce(DataFrame.unionByName, parts).groupBy(*keys).agg(
            F.expr("count(*) as source_count"), F.min("_place").alias("_first"))
        .selectExpr(*keys, "source_count", "_first.file as source_file", "_first.row as source_row")
    )


def _fetched(raw: DataFrame, facts: DataFrame, source_table: str) -> DataFrame:
    """The whole rows at the places of ``facts``, with their other columns.

    Places are unique within a source, so a much-copied record is spread like any other, and wide
    rows are shuffled once and never hashed or sorted.
    """
    names = [c for c in facts.columns if c not in ("source_table", "source_file", "source_row")]
    found = facts.filter(F.col("source_table") == source_table).selectExpr(
        "source_file as _file", "source_row as _row", *names)
    return raw.join(
        found.hint("shuffle_hash"), F.expr("_source_file <=> _file and _source_row <=> _row")
    ).selectExpr(
        *[f"`{name}`" for name in own_columns(raw)], "_file as source_file", "_row as source_row",
        *names, f"{quoted(source_table)} as source_table",
    )


def dedup_records(raw: DataFrame, source_table: str) -> DataFrame:
    """One row per distinct record with its count and first (file, row)."""
    return _fetched(raw, first_copies({source_table: raw}), source_table)


def normalize_filings(records: DataFrame) -> DataFrame:
    """Typed dates beside their raw text, and the later of the two announcements."""
    absent = [c for c in ("f_ann_date", "report_type") if c not in records.columns]
    records = records.selectExpr("*", *[f"cast(null as string) as {c}" for c in absent])
    raw = {f"raw_{name}": f"cast({name} as string)" for name in FILING_DATES}
    typed = {name: day_of(records, name) for name in FILING_DATES}
    return records.withColumns(exprs({**raw, **typed})).withColumn(
        "effective_ann_date", F.greatest("ann_date", "f_ann_date")
    )


VERSION_GROUP = ["source_table", "ts_code", "end_date", "report_type"]


#: Companies are counted in this many buckets; rows of a bucket with more than LARGE of them, and
#: than four times its even share, are numbered slice by slice.
BUCKETS, LARGE = 1 << 16, 500_000
#: Rows that one task numbers on average.
TASK_ROWS = 100_000
_BUCKET = f"pmod(xxhash64(cast(ts_code as string)), {BUCKETS})"


def versioned_filings(
    sources: dict[str, DataFrame], reused: bool = True, clustered: bool = False
) -> DataFrame:
    """The distinct records of all sources, normalised, with ``version``.

    Wide rows are shuffled once, by (source, company), and nothing else is: in the task of its
    company a record is identified, its copies are collapsed and its version is numbered. Companies
    too large for a task go the way of :func:`_sliced`. ``reused`` writes the rows for plans that
    read them more than once; unwritten rows keep their partitioning for one plan to go on with.
    ``clustered`` says that all sources come dealt out by ``ts_code`` alike, in tasks small enough to
    sort; their wide rows are then not shuffled. Where Spark finds them otherwise it shuffles.
    """
    sources = {name: raw if "ts_code" in raw.columns else raw.withColumn("ts_code", F.lit(None).cast("string"))
               for name, raw in sources.items()}
    counts = reduce(DataFrame.unionByName, [
        raw.selectExpr(f"{quoted(name)} as source_table", f"{_BUCKET} as bucket") for name, raw in sources.items()
    ]).groupBy("source_table", "bucket").count()
    rows, most = counts.agg(F.sum("count"), F.max("count")).first()
    limit = max(LARGE, 4 * (rows or 0) // BUCKETS)
    hot = []
    if most and most > limit:
        hot = [r.bucket for r in counts.filter(f"count > {limit}").select("bucket").distinct().collect()]
    of_hot = f"{_BUCKET} in ({', '.join(f'{b}L' for b in hot)})"
    plain = {name: raw.filter(f"not ({of_hot})") for name, raw in sources.items()} if hot else sources
    numbered = _numbered(plain, (rows or 0) // TASK_ROWS, clustered)
    if hot:
        numbered = numbered.unionByName(
            _sliced({name: raw.filter(of_hot) for name, raw in sources.items()}), allowMissingColumns=True)
    return staged(numbered) if reused else numbered


def _numbered(sources: dict[str, DataFrame], tasks: int, clustered: bool) -> DataFrame:
    """One sort per company's task: copies follow each other, versions are counted along them."""
    kinds = [(f.name, f.dataType) for raw in sources.values() for f in raw.schema.fields]
    alike = len(set(kinds)) == len({name for name, _ in kinds})
    ids = {name: F.when(F.col("source_table") == name, record_id(name, own_columns(raw)))
           for name, raw in sources.items()}
    parts = []
    for name, raw in sources.items():
        part = raw.withColumn("source_table", F.lit(name))
        parts.append(part if alike else part.withColumn("record_id", ids[name]))
    wide = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    n = max(tasks, int(wide.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    near = (wide if clustered else wide.repartition(n, "source_table", "ts_code")).withColumnsRenamed(
        {"_source_file": "source_file", "_source_row": "source_row"})
    if alike:
        near = near.withColumn("record_id", F.coalesce(*ids.values()))
    group = ", ".join(VERSION_GROUP)
    # Without an announcement last; a number, as a partition's nulls sort first.
    ordered = normalize_filings(near).withColumn("_order", F.expr(f"coalesce(unix_date(effective_ann_date), {2**31 - 1})"))
    copies = f"over (partition by {group}, _order, record_id order by source_file, source_row"
    whole = "rows between unbounded preceding and unbounded following"
    return ordered.selectExpr("*", f"row_number() {copies}) as _copy", f"count(*) {copies} {whole}) as source_count").selectExpr(
        "*", f"sum(if(_copy = 1, 1, 0)) over (partition by {group} order by _order, record_id, source_file, source_row "
             "rows between unbounded preceding and current row) as version",
    ).filter("_copy = 1").drop("_copy", "_order")


def _sliced(sources: dict[str, DataFrame]) -> DataFrame:
    """The same rows without ever gathering a company: copies are collapsed map-side, versions are
    numbered on the narrow staged rows by slices and meet the wide row when it is fetched."""
    texts = ("ts_code", "report_type", *FILING_DATES)
    firsts = first_copies(sources, texts)
    dated = normalize_filings(firsts).select(
        "record_id", "source_count", "source_file", "source_row", "effective_ann_date", *VERSION_GROUP)
    numbered = split_row_number(
        dated, VERSION_GROUP, "effective_ann_date", "record_id", "version"
    ).select("source_table", "record_id", "source_count", "source_file", "source_row", "version")
    return reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [normalize_filings(_fetched(raw, numbered, table)) for table, raw in sources.items()],
    )


def filings_available(
    sources: dict[str, DataFrame], calendar: DataFrame, reused: bool = True, clustered: bool = False
) -> DataFrame:
    """Every filing version with its version number, status and availability date.

    A record becomes available on the first trading day strictly after its effective
    announcement. Nothing is dropped: unusable records keep a status and no date. Version
    numbers are dense per (source, code, period, report type) and carry no priority. ``reused`` and
    ``clustered`` as in :func:`versioned_filings`.
    """
    mapped = lookup_days(
        versioned_filings(sources, reused, clustered), calendar, "effective_ann_date", {"next_trade_date": "_mapped"}
    )
    lo, hi, _ = bounds(calendar)

    def unreadable(name: str) -> str:
        return f"(not {is_blank('raw_' + name)} and {name} is null)"

    status = (
        f"case when not {is_security_code('ts_code')} then 'invalid_code' "
        "when end_date is null then 'invalid_report_date' "
        f"when {is_blank('raw_ann_date')} and {is_blank('raw_f_ann_date')} "
        "then 'missing_announcement' "
        f"when {unreadable('ann_date')} or {unreadable('f_ann_date')} "
        "then 'invalid_announcement' "
        "when effective_ann_date < end_date then 'announcement_before_report' "
        "when effective_ann_date < _lo then 'calendar_before_coverage' "
        "when effective_ann_date > _hi or _mapped is null then 'calendar_after_coverage' "
        "else 'available' end"
    )
    return (
        mapped.withColumns({"_lo": lo, "_hi": hi})
        .withColumn("availability_status", F.expr(status))
        .withColumn(
            "available_date", F.expr("if(availability_status = 'available', _mapped, null)")
        )
        .drop("_mapped", "_lo", "_hi")
    )


def candidate_key_conflicts(sources: dict[str, DataFrame], keys: list[str]) -> DataFrame:
    """Keys a vendor calls unique that several distinct records share.

    Copies are records equal in every vendor column, so no identity is hashed, no version numbered
    and no company gathered: two aggregates with map-side combine, on all columns and on the keys.
    """
    parts = []
    for name, raw in sources.items():
        distinct = raw.groupBy(*[F.col(f"`{c}`") for c in own_columns(raw)]).agg(F.count("*").alias("_copies"))
        parts.append(normalize_filings(distinct).select(F.lit(name).alias("source_table"), *keys))
    return (
        reduce(DataFrame.unionByName, parts).groupBy("source_table", *keys)
        .agg(F.count("*").alias("records"))
        .filter("records > 1")
    )
