"""Single-quarter and trailing-twelve-month figures, versioned by the day they became visible.

No state machine: a record's available date never decreases with its announcement date, so
"what was known on day d" is a last-non-null window over versions ordered by available date.
Windows are partitioned by (source, code, metric, period), at most four rows per announcement
day of one period, however much of the market one company makes up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.scalars import (
    compensated_sum,
    is_blank,
    is_finite,
    quarter_end,
    quarter_index,
    quoted,
)

GROUP = ["source_table", "ts_code", "metric"]


def metrics_long(filings: DataFrame, metrics: dict[str, list[str]]) -> DataFrame:
    """(source, code, metric, period, dates, record, value, state) of usable annual-type records.

    Each record is read once and expanded to the metrics of its own source.
    """
    cases = []
    for source, names in metrics.items():
        absent = [n for n in names if n not in filings.columns]
        if absent:
            raise ValueError(f"{source}: missing metric columns {absent}")
        pairs = ", ".join(
            f"struct({quoted(n)} as metric, cast(`{n}` as string) as raw)" for n in names
        )
        cases.append(f"when {quoted(source)} then array({pairs})")
    usable = filings.filter(
        "availability_status = 'available' and trim(cast(report_type as string)) = '1' "
        f"and source_table in ({', '.join(map(quoted, metrics))})"
    )
    value = "try_cast(raw as double)"
    return usable.selectExpr(
        "source_table", "ts_code", "end_date", "effective_ann_date", "available_date",
        "record_id", f"inline(case source_table {' '.join(cases)} end)",
    ).selectExpr(
        *GROUP, "end_date", "effective_ann_date", "available_date", "record_id",
        f"case when {is_finite(value)} then {value} end as metric_value",
        f"case when {is_blank('raw')} then 'missing_metric' "
        f"when not {is_finite(value)} then 'invalid_metric' else 'available' end as value_state",
    )


def period_versions(long: DataFrame, clustered: bool = False) -> DataFrame:
    """One row per (group, period, available date): the agreed value of the newest announcement.

    Rows are clustered by company once, or not at all where they come so (as unwritten filings do),
    and every later step goes on in the same tasks. Records tied on a date must agree on state and
    value; the record list holds only such ties of one company's one period, after exact copies
    were merged.
    """
    key = [*GROUP, "end_date", "available_date"]
    claims = long.selectExpr(
        *key, "effective_ann_date", "record_id",
        "struct(value_state as state, metric_value as value) as claim",
    )
    if not clustered:
        claims = _clustered(claims)
    by = f"over (partition by {', '.join(key)}"
    newest = claims.selectExpr("*", f"rank() {by} order by effective_ann_date desc) as _rank").filter("_rank = 1")
    return newest.selectExpr(
        *key, f"min(claim) {by}) as low", f"max(claim) {by}) as high", f"collect_set(record_id) {by}) as ids",
        f"row_number() {by} order by effective_ann_date desc) as _n",
    ).filter("_n = 1").selectExpr(
        *key,
        "case when low <=> high then low.value end as value",
        "case when low <=> high then low.state else 'ambiguous_metric' end as status",
        "sort_array(ids) as ids",
    )


BY_PERIOD = f"over (partition by {', '.join(GROUP)}, end_date order by available_date)"
ID_FIELDS = ["status", "cast(value as string)", "array_join(source_record_ids, ',')"]


def _version_id(kind: str, fields: list[str]) -> str:
    """sha256 of the version's key and content in a fixed order."""
    parts = [*GROUP, "cast(end_date as string)", "cast(available_date as string)", *fields]
    texts = ", ".join(f"coalesce({part}, '')" for part in parts)
    return f"sha2(concat_ws('|', '{kind}', {texts}), 256) as version_id"


def _visible(slots: range, own: str) -> list[str]:
    """Newest version per slot up to and including each event day, one row per day.

    A record has one available date, so each event brings records no earlier version of the
    period was built from: every event day is a changed version, and none needs comparing
    with its predecessor. Events of one day see the same state; the last stands for all.
    """
    columns = [
        f"last(if(slot = {k}, known, null), true) {BY_PERIOD} as {own}{k}" for k in slots
    ]
    return [*columns, f"lead(available_date) {BY_PERIOD} as next_event"]


# A period emits nothing before its own first version.
EMITTED = "{own}0 is not null and next_event is distinct from available_date"


def _clustered(df: DataFrame) -> DataFrame:
    """Hash-partition by group so that all later windows, which refine it, need no shuffle.

    Copies are merged before, so a company has as many rows as it filed different records.
    """
    return df.repartition(*[F.col(name) for name in GROUP])


def quarterly(versions: DataFrame) -> DataFrame:
    """Quarter versions from period versions: cumulative minus the previous quarter's cumulative.

    Slot 0 feeds a version to its own period; slot 1 feeds it, as predecessor, to the next
    quarter of the same year.
    """
    own_slot = "struct(end_date as target, 0 as slot)"
    seen = (
        versions.selectExpr("*", f"{quarter_index('end_date')} as q")
        .selectExpr(
            *GROUP, "available_date", "struct(value, status, ids) as known",
            f"inline(if(q % 4 <> 3, array({own_slot}, "
            f"struct({quarter_end('q + 1')} as target, 1 as slot)), array({own_slot})))",
        )
        .withColumnRenamed("target", "end_date")
        .selectExpr(*GROUP, "end_date", "available_date", *_visible(range(2), "c"))
        .filter(EMITTED.format(own="c"))
        .selectExpr(
            *GROUP, "end_date", "available_date", "c0 as own", "c1 as prior",
            f"{quarter_index('end_date')} as q", "c0.value - c1.value as difference",
        )
    )
    bad = (
        "case when own.status = 'available' then prior.status "
        "when prior.status = 'available' or prior.status = own.status then own.status "
        "else concat_ws('+', least(own.status, prior.status), "
        "greatest(own.status, prior.status)) end"
    )
    status = (
        "case when q is null then 'unsupported_report_period' when q % 4 = 0 then own.status "
        "when prior is null and own.status = 'available' then 'missing_previous_quarter' "
        "when prior is null then concat(own.status, '+missing_previous_quarter') "
        f"when own.status <> 'available' or prior.status <> 'available' then {bad} "
        f"when not {is_finite('difference')} then 'invalid_computation' else 'available' end"
    )
    rows = seen.withColumn("status", F.expr(status)).selectExpr(
        *GROUP, "end_date", "available_date",
        "case when q % 4 = 0 then own.value when status = 'available' then difference end as value",
        "status",
        "case when q is null or q % 4 = 0 or prior is null then own.ids "
        "else sort_array(array_union(own.ids, prior.ids)) end as source_record_ids",
        f"case when q is null or q % 4 = 0 then array(end_date) "
        f"else array({quarter_end('q - 1')}, end_date) end as source_end_dates",
    )
    return rows.selectExpr("*", _version_id("quarter", ID_FIELDS))


UNAVAILABLE = "if(q{k}.status <> 'available', end{k}, null)"


def ttm(quarters: DataFrame) -> DataFrame:
    """TTM versions: the four consecutive quarters ending at a period, as visible each day.

    A quarter version feeds its own period and the next three; slot k holds the quarter k
    before the target.
    """
    own_slot = "struct(end_date as target, 0 as slot)"
    later = ", ".join(
        f"struct({quarter_end(f'q + {k}')} as target, {k} as slot)" for k in (1, 2, 3)
    )
    # Oldest first, as source lists are ordered. An unsupported period fills only its own slot,
    # which is not a source quarter.
    order = (3, 2, 1, 0)
    seen = (
        quarters.selectExpr("*", f"{quarter_index('end_date')} as q")
        .selectExpr(
            *GROUP, "available_date",
            "struct(value, status, source_record_ids as ids, version_id) as known",
            f"inline(if(q is not null, array({own_slot}, {later}), array({own_slot})))",
        )
        .withColumnRenamed("target", "end_date")
        .selectExpr(*GROUP, "end_date", "available_date", *_visible(range(4), "q"))
        .filter(EMITTED.format(own="q"))
        .selectExpr("*", f"{quarter_index('end_date')} as q")
        .selectExpr("*", *[f"{quarter_end(f'q - {k}')} as end{k}" for k in order])
    )

    def listed(pattern: str) -> str:
        items = ", ".join(pattern.format(k=k) for k in order)
        return f"array_compact(array({items}))"

    def any_status(text: str) -> str:
        return " or ".join(f"coalesce(contains(q{k}.status, '{text}'), false)" for k in order)

    complete = " and ".join(f"coalesce(q{k}.status = 'available', false)" for k in order)
    total = compensated_sum([f"q{k}.value" for k in order])
    seen = seen.withColumn("total", F.expr(f"if(q is not null and {complete}, {total}, null)"))
    status = (
        "case when q is null then 'unsupported_report_period' "
        f"when {any_status('ambiguous')} then 'ambiguous_quarter' "
        f"when {any_status('invalid')} then 'invalid_quarter' "
        f"when not ({complete}) then 'missing_quarter' "
        f"when {is_finite('total')} then 'available' else 'invalid_computation' end"
    )
    all_ids = ", ".join(f"coalesce(q{k}.ids, array())" for k in order)
    no_dates, no_text = "cast(array() as array<date>)", "cast(array() as array<string>)"
    rows = seen.withColumn("status", F.expr(status)).selectExpr(
        *GROUP, "end_date", "available_date",
        "case when status = 'available' then total end as value",
        "status",
        f"if(q is null, q0.ids, sort_array(array_distinct(concat({all_ids})))) "
        "as source_record_ids",
        f"if(q is null, {no_dates}, array({', '.join(f'end{k}' for k in order)})) "
        "as source_end_dates",
        f"if(q is null, {no_text}, {listed('q{k}.version_id')}) as source_quarter_ids",
        f"if(q is null, {no_dates}, {listed('if(q{k} is null, end{k}, null)')}) "
        "as missing_source_end_dates",
        "if(q is null, "
        f"{no_dates}, {listed(UNAVAILABLE)}) as unavailable_source_end_dates",
    )
    fields = [*ID_FIELDS, "array_join(source_quarter_ids, ',')"]
    return rows.selectExpr("*", _version_id("ttm", fields))


def quarterly_and_ttm(
    filings: DataFrame, metrics: dict[str, list[str]]
) -> tuple[DataFrame, DataFrame]:
    """Both derived tables from the filings table."""
    quarters = quarterly(period_versions(metrics_long(filings, metrics)))
    return quarters, ttm(quarters)
