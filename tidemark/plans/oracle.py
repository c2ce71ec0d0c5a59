"""The same market and operators as plain DuckDB SQL, written independently of the Spark plans.

Here intervals are range joins, look-ups are correlated or as-of joins, and nothing shares
code with the operators, so agreement means something. ``compose`` builds one statement from
the named blocks a query needs.
"""

from __future__ import annotations

import re

BLOCKS: dict[str, str] = {}


def block(name: str, sql: str) -> None:
    BLOCKS[name] = sql.strip()


def compose(sql: str) -> str:
    """``sql`` preceded by every block it mentions, directly or not, in dependency order."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in sorted(set(re.findall(r"\bm_\w+", text))):
            if name in BLOCKS and name not in ordered:
                visit(BLOCKS[name])
                ordered.append(name)

    visit(sql)
    blocks = ",\n".join(f"{name} AS MATERIALIZED (\n{BLOCKS[name]}\n)" for name in ordered)
    text = sql.strip()
    if not ordered:
        return text
    # A statement with its own WITH list continues the block list.
    own = re.match(r"WITH\s+(.*)", text, re.S)
    return f"WITH {blocks},\n{own.group(1)}" if own else f"WITH {blocks}\n{text}"


def _code(key: str) -> str:
    return (f"lpad(CAST({key} AS VARCHAR), 10, '0') || "
            f"CASE {key} % 3 WHEN 0 THEN '.SH' WHEN 1 THEN '.SZ' ELSE '.BJ' END")


def _stamp(day: str) -> str:
    return f"strftime({day}, '%Y%m%d')"


def _day(x: str) -> str:
    text = f"regexp_replace(trim(CAST({x} AS VARCHAR)), '\\.0$', '')"
    return (f"CASE WHEN regexp_full_match({text}, '[0-9]{{8}}') "
            f"THEN CAST(try_strptime({text}, '%Y%m%d') AS DATE) "
            f"WHEN regexp_full_match({text}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') "
            f"THEN try_cast({text} AS DATE) END")


def _blank(x: str) -> str:
    return f"({x} IS NULL OR trim(CAST({x} AS VARCHAR)) = '')"


CODE_OK = "regexp_full_match({x}, '[^.[:space:]]+[.](SH|SZ|BJ)')"

# -- calendar ------------------------------------------------------------------------------
block("m_days", """
SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day
FROM (SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi
      FROM orders)
""")
block("m_natural", """
SELECT day, NOT (dayofweek(day) IN (0, 6) OR (month(day) = 1 AND day(day) = 1)) AS is_open
FROM m_days
""")
block("m_cal", """
SELECT day AS trade_date,
       lag(day) OVER (ORDER BY day) AS prev_trade_date,
       lead(day) OVER (ORDER BY day) AS next_trade_date,
       row_number() OVER (ORDER BY day) AS trade_index,
       (SELECT min(day) FROM m_natural) AS calendar_start,
       (SELECT max(day) FROM m_natural) AS calendar_end,
       'SSE' AS exchange
FROM m_natural WHERE is_open
""")
block("m_next", """
SELECT n.day, n.is_open,
       (SELECT max(trade_date) FROM m_cal c WHERE c.trade_date < n.day) AS prev_trade_date,
       (SELECT min(trade_date) FROM m_cal c WHERE c.trade_date > n.day) AS next_trade_date
FROM m_natural n
""")

# -- quotes --------------------------------------------------------------------------------
block("m_totals", """
SELECT l_suppkey AS key, CAST(l_shipdate AS DATE) AS day,
       min(CAST(round(l_extendedprice * 100) AS BIGINT)) AS low_c,
       max(CAST(round(l_extendedprice * 100) AS BIGINT)) AS high_c,
       CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS sum_c,
       count(*) AS n, sum(l_quantity) AS vol
FROM lineitem WHERE CAST(l_shipdate AS DATE) IN (SELECT trade_date FROM m_cal)
GROUP BY 1, 2
""")
block("m_quotes", f"""
SELECT {_code('key')} AS ts_code, day AS trade_date,
       ((low_c + high_c) // 2) / 100.0::DOUBLE AS open, high_c / 100.0::DOUBLE AS high,
       low_c / 100.0::DOUBLE AS low, (sum_c // n) / 100.0::DOUBLE AS close,
       vol, sum_c / 100.0::DOUBLE AS amount,
       CASE WHEN key % 3 = 0 AND day >= DATE '1998-01-01' THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END
         AS adj_factor
FROM m_totals
""")
block("m_adjusted", """
SELECT p.*, CASE WHEN p.prev_quote_date = c.prev_trade_date
                 THEN p.adjusted_close / p.prev_close - 1 END AS ret_1d,
       CASE WHEN p.prev_quote_date IS NULL THEN 'no_previous_quote'
            WHEN p.prev_quote_date <> c.prev_trade_date THEN 'missing_previous_trading_day'
            ELSE 'available' END AS return_status
FROM (SELECT *, open * adj_factor AS adjusted_open, high * adj_factor AS adjusted_high,
             low * adj_factor AS adjusted_low, close * adj_factor AS adjusted_close,
             lag(trade_date) OVER w AS prev_quote_date,
             lag(close * adj_factor) OVER w AS prev_close
      FROM m_quotes WINDOW w AS (PARTITION BY ts_code ORDER BY trade_date)) p
JOIN m_cal c USING (trade_date)
""")
block("m_untidy_raw", f"""
SELECT {_code('l_suppkey')} AS ts_code,
       CASE WHEN l_linenumber = 7 THEN '19950230' ELSE {_stamp('l_shipdate')} END AS trade_date,
       l_extendedprice AS open, l_extendedprice + l_quantity - 2 AS high,
       l_extendedprice AS low, l_extendedprice AS close, l_quantity - 3 AS vol,
       l_extendedprice AS amount,
       CASE WHEN l_tax > 0.07 THEN 'nan' WHEN l_quantity = 9 THEN '-1'
            WHEN l_quantity = 8 THEN 'x' ELSE '1.0' END AS adj_factor
FROM lineitem
""")
block("m_untidy", f"""
SELECT * REPLACE ({_day('trade_date')} AS trade_date, try_cast(adj_factor AS DOUBLE) AS adj_factor)
FROM m_untidy_raw
""")

# -- securities and names ------------------------------------------------------------------
block("m_listed", f"""
SELECT s_suppkey AS key, {_code('s_suppkey')} AS ts_code,
       DATE '1994-06-01' + CAST(s_suppkey * 37 % 900 AS INTEGER) AS list_date,
       CASE WHEN s_suppkey % 10 = 0 THEN DATE '1994-06-01'
            + CAST(s_suppkey * 37 % 900 + s_suppkey % 500 + 900 AS INTEGER) END AS delist_date,
       CASE WHEN s_suppkey % 17 = 0 THEN 'USD' ELSE 'CNY' END AS curr_type
FROM supplier
""")
block("m_names", """
SELECT CASE WHEN key % 29 = 3 THEN 'X' || ts_code ELSE ts_code END AS ts_code,
       CASE (key + seg) % 6 WHEN 0 THEN 'st S' WHEN 1 THEN '*ST S' ELSE 'Supplier ' END
         || CAST(key AS VARCHAR) AS name,
       list_date + CAST(seg * 300 AS INTEGER) AS start_date,
       CASE WHEN seg < 4 THEN list_date + CAST(seg * 300 AS INTEGER)
            + CASE WHEN (key + seg) % 5 = 0 THEN 239 WHEN (key + seg) % 7 = 0 THEN 359
                   ELSE 299 END END AS end_date,
       key * 10 + seg AS source_row
FROM m_listed, (SELECT unnest([0, 1, 2, 3, 4]) AS seg) WHERE key % 23 <> 5
""")
# A sweep over the days on which a name starts or has ended: running totals say how many names
# cover a day and how many of them are marked.
block("m_levels", """
WITH marked AS (
  SELECT *, CAST(contains(upper(name), 'ST') AS INTEGER) AS st,
    CAST(contains(upper(name), '*ST') AS INTEGER) AS star FROM m_names),
edges AS (
  SELECT ts_code, start_date AS day, 1 AS step, st, star FROM marked
  UNION ALL SELECT ts_code, end_date + 1, -1, -st, -star FROM marked WHERE end_date IS NOT NULL),
daily AS (
  SELECT ts_code, day, sum(step) AS step, sum(st) AS st, sum(star) AS star
  FROM edges GROUP BY ts_code, day)
SELECT ts_code, day, CAST(sum(step) OVER w AS BIGINT) AS n, CAST(sum(st) OVER w AS BIGINT) AS st,
  CAST(sum(star) OVER w AS BIGINT) AS star
FROM daily WINDOW w AS (PARTITION BY ts_code ORDER BY day)
""")
block("m_name_lists", """
SELECT ts_code, list({'lo': start_date, 'hi': end_date, 'name': name, 'row': source_row}
                     ORDER BY start_date DESC, source_row) AS names
FROM m_names GROUP BY ts_code
""")
block("m_facts", """
WITH asked AS (SELECT trade_date, ts_code, names FROM m_cal, m_name_lists)
SELECT a.trade_date, a.ts_code, n AS covering_intervals, st > 0 AS any_st, st = n AS all_st,
  star > 0 AS any_star_st, star = n AS all_star_st, valid.name AS historical_name,
  valid.row AS name_source_row
FROM (SELECT asked.*, list_filter(names, lambda x: x.lo <= trade_date
        AND (x.hi IS NULL OR x.hi >= trade_date))[1] AS valid FROM asked) a
ASOF JOIN m_levels l ON a.ts_code = l.ts_code AND a.trade_date >= l.day
WHERE n > 0
""")
# Ages are counts of open days: those up to the end of life less those before listing.
block("m_opened", """
SELECT day, count(*) FILTER (WHERE is_open) OVER (ORDER BY day) AS opened FROM m_natural
""")
block("m_ages", """
WITH life AS (
  SELECT trade_date, calendar_start, ts_code, curr_type, list_date,
    CASE WHEN trade_date < list_date THEN 'before' WHEN trade_date >= delist_date THEN 'after'
         ELSE 'listed' END AS phase,
    least(trade_date, delist_date - 1) AS alive_until
  FROM m_cal, m_listed),
counted AS (
  SELECT life.*, greatest(0, coalesce(upto.opened, 0) - coalesce(earlier.opened, 0)) AS sessions,
    greatest(0, alive_until - list_date) AS days
  FROM life ASOF LEFT JOIN m_opened upto ON life.alive_until >= upto.day
  ASOF LEFT JOIN (SELECT day + 1 AS day, opened FROM m_opened) earlier
    ON life.list_date >= earlier.day)
SELECT trade_date, ts_code, curr_type, phase, phase = 'listed' AS is_listed,
  phase = 'after' AS is_delisted, phase = 'before' AS is_not_yet_listed,
  CAST(sessions AS BIGINT) AS listing_trade_days_lower_bound,
  CASE WHEN phase = 'before' OR list_date >= calendar_start THEN CAST(sessions AS BIGINT) END
    AS listing_trade_days,
  CASE WHEN phase = 'before' THEN 'not_yet_listed' WHEN list_date >= calendar_start THEN 'exact'
       ELSE 'left_censored' END AS listing_age_status,
  CAST(days AS BIGINT) AS listing_natural_days,
  CAST(round(days / 365.25::DOUBLE * 252) AS BIGINT) AS estimated_listing_trade_days
FROM counted
""")
block("m_state", """
WITH held AS (
  SELECT a.*, coalesce(f.covering_intervals, 0) AS names, f.* EXCLUDE (trade_date, ts_code)
  FROM m_ages a LEFT JOIN m_facts f USING (trade_date, ts_code))
SELECT * EXCLUDE (phase, curr_type, names, covering_intervals, any_st, all_st, any_star_st,
                  all_star_st, historical_name, name_source_row),
  curr_type = 'CNY' AS is_a_share,
  CASE phase WHEN 'listed' THEN MAP {'SH': 'SSE', 'SZ': 'SZSE', 'BJ': 'BSE'}[
    split_part(ts_code, '.', 2)] END AS exchange,
  CASE WHEN phase = 'listed' AND any_st = all_st THEN all_st END AS is_st,
  CASE WHEN phase = 'listed' AND any_star_st = all_star_st THEN all_star_st END AS is_star_st,
  CASE WHEN phase <> 'listed' THEN 'not_listed' ELSE 'namechange_' || CASE
    WHEN names = 0 THEN 'uncovered'
    WHEN any_st = all_st AND any_star_st = all_star_st THEN 'derived' ELSE 'ambiguous' END END
    AS historical_state_status,
  CASE phase WHEN 'listed' THEN historical_name END AS historical_name,
  CASE phase WHEN 'listed' THEN name_source_row END AS name_source_row
FROM held
""")

# -- events --------------------------------------------------------------------------------
block("m_suspend", f"""
SELECT * FROM (
  SELECT {_code('l_suppkey')} AS ts_code, CAST(l_shipdate AS DATE) AS trade_date,
    CASE WHEN l_returnflag = 'R' AND l_quantity = 50 THEN 'S'
         WHEN l_returnflag = 'A' AND l_quantity = 1 THEN 'R' END AS suspend_type,
    CASE WHEN l_tax > 0.05 THEN '09:30-10:00' END AS suspend_timing,
    'suspend_d/' || strftime(l_shipdate, '%Y%m') AS source_file
  FROM lineitem) WHERE suspend_type IS NOT NULL
""")
block("m_limit", f"""
SELECT * FROM (
  SELECT {_code('l_suppkey')} AS ts_code, CAST(l_shipdate AS DATE) AS trade_date,
    CASE CAST(round(l_discount * 100) AS INTEGER)
         WHEN 10 THEN 'U' WHEN 0 THEN 'D' WHEN 5 THEN 'Z' END AS limit_type,
    'limit_list_d/' || strftime(l_shipdate, '%Y%m') AS source_file
  FROM lineitem) WHERE limit_type IS NOT NULL
""")
block("m_limit_prices", f"""
SELECT {_code('key')} AS ts_code, day AS trade_date,
  CASE WHEN hole THEN 99999.99::DOUBLE ELSE (mid * 103 // 100) / 100.0::DOUBLE END AS up_limit,
  CASE WHEN hole THEN 0.0::DOUBLE ELSE (mid * 97 // 100) / 100.0::DOUBLE END AS down_limit
FROM (SELECT *, (low_c + high_c) // 2 AS mid, key % 6 = 2 AND day(day) = 15 AS hole
      FROM m_totals WHERE key % 7 <> 0)
""")
block("m_valid_limits", """
SELECT * FROM m_limit_prices WHERE isfinite(up_limit) AND isfinite(down_limit)
 AND up_limit > down_limit AND down_limit > 0
""")
_MARKS = {
    "m_susp_facts": ("m_suspend", "suspend_type", """CASE WHEN suspend_type = 'R' THEN 'resume'
      WHEN suspend_timing IS NULL THEN 'full_day' ELSE 'intraday' END""",
                     {"suspend": ["full_day", "intraday"], "full_day": ["full_day"],
                      "intraday": ["intraday"], "resume": ["resume"]}),
    "m_lim_facts": ("m_limit", "limit_type", "limit_type",
                    {"up": ["U"], "down": ["D"], "opened": ["Z"]}),
}
for _name, (_events, _type, _mark, _seen) in _MARKS.items():
    _flags = ", ".join(f"list_has_any(marks, {marks}) AS observed_{flag}"
                       for flag, marks in _seen.items())
    block(_name, f"""
SELECT trade_date, ts_code, {_flags}, types, files FROM (
  SELECT trade_date, ts_code, list(DISTINCT {_mark}) AS marks,
    string_agg(DISTINCT {_type}, ',' ORDER BY {_type}) AS types,
    string_agg(DISTINCT source_file, ',' ORDER BY source_file) AS files
  FROM {_events} GROUP BY trade_date, ts_code)
""")
_KNOWN = ("(trade_date BETWEEN DATE '1995-06-01' AND DATE '2001-06-30' "
          "AND split_part(ts_code, '.', 2) IN ('SH', 'SZ'))")
_LIMITS_KNOWN = "trade_date BETWEEN DATE '1998-01-01' AND DATE '2000-12-31'"


def _foremost(table: list[tuple[str, str]]) -> str:
    """The label of lowest priority number whose condition holds, from a table in that order."""
    rows = ", ".join(f"{{'label': '{label}', 'holds': {condition}}}" for label, condition in table)
    return f"(list_filter([{rows}], lambda x: x.holds)[1]).label"


def _tri(reason: str, unknown: list[str]) -> str:
    """True without a reason, NULL where the reason is that something is unknown, else false."""
    return f"({reason} IS NULL OR nullif({reason} IN {tuple(unknown)}, true))"


def _otherwise(yes: str, no: str) -> str:
    """True where ``yes`` holds, else false where ``no`` does, else NULL."""
    return f"({yes} OR nullif(NOT ({no}), true))"


def _side(label: str, flag: str) -> list[tuple[str, str]]:
    return [
        ("DELISTED", "is_delisted"), ("NOT_LISTED", "NOT is_listed"),
        ("INTRADAY_SUSPENSION", "is_intraday_suspended"), ("FULL_DAY_SUSPENSION", "is_suspended"),
        ("NO_QUOTE", "NOT quotation_exists"), ("NO_VOLUME", "vol <= 0"), (label, flag),
        ("SUSPENSION_STATUS_UNKNOWN", "is_suspended IS NULL"),
        ("LIMIT_STATUS_UNKNOWN", f"{flag} IS NULL"),
    ]


_TRADE_UNKNOWN = ["SUSPENSION_STATUS_UNKNOWN", "LIMIT_STATUS_UNKNOWN"]
block("m_status", f"""
WITH seen AS (
  SELECT trade_date, ts_code, is_listed, is_delisted, q.close AS raw_close, q.vol,
    q.close IS NOT NULL AS quotation_exists, x.up_limit, x.down_limit,
    x.up_limit IS NOT NULL AS limit_price_exists,
    coalesce(e.observed_suspend, false) AS observed_suspend,
    coalesce(e.observed_full_day, false) AS observed_full_day,
    coalesce(e.observed_intraday, false) AS observed_intraday,
    coalesce(e.observed_resume, false) AS has_resume_event,
    coalesce(m.observed_up, false) AS observed_up,
    coalesce(m.observed_down, false) AS observed_down,
    coalesce(m.observed_opened, false) AS observed_opened, coalesce(m.types, '') AS limit_types
  FROM m_state LEFT JOIN m_quotes q USING (trade_date, ts_code)
  LEFT JOIN m_valid_limits x USING (trade_date, ts_code)
  LEFT JOIN m_susp_facts e USING (trade_date, ts_code)
  LEFT JOIN m_lim_facts m USING (trade_date, ts_code)),
halted AS (
  SELECT *, {_otherwise('observed_suspend', _KNOWN)} AS is_suspended,
    {_otherwise('observed_full_day', 'observed_suspend OR ' + _KNOWN)} AS is_full_day_suspended,
    {_otherwise('observed_intraday', 'observed_suspend OR ' + _KNOWN)} AS is_intraday_suspended,
    CASE WHEN quotation_exists THEN raw_close >= up_limit END AS at_up,
    CASE WHEN quotation_exists THEN raw_close <= down_limit END AS at_down
  FROM seen),
bounded AS (
  SELECT *,
    observed_up OR coalesce(at_up, nullif(NOT (observed_down OR observed_opened
      OR {_LIMITS_KNOWN}), true)) AS is_limit_up,
    observed_down OR coalesce(at_down, nullif(NOT (observed_up OR observed_opened
      OR {_LIMITS_KNOWN}), true)) AS is_limit_down
  FROM halted),
reasoned AS (
  SELECT *, {_foremost(_side('LIMIT_UP', 'is_limit_up'))} AS cannot_buy_reason,
    {_foremost(_side('LIMIT_DOWN', 'is_limit_down'))} AS cannot_sell_reason FROM bounded)
SELECT *, {_tri('cannot_buy_reason', _TRADE_UNKNOWN)} AS can_buy,
  {_tri('cannot_sell_reason', _TRADE_UNKNOWN)} AS can_sell
FROM reasoned
""")
block("m_rules", """
SELECT * FROM (VALUES ('all_a', false, false, 0), ('all_a_ex_st', true, false, 0),
  ('all_a_ex_st_ipo120', true, false, 120), ('all_a_ex_st_ipo120_ex_bj', true, true, 120))
  AS r(universe_id, no_st, no_bj, minimum)
""")
_YOUNG = "coalesce(listing_trade_days, listing_trade_days_lower_bound, -1) < minimum"
_MEMBERSHIP = [
    ("DELISTED", "is_delisted"), ("NOT_LISTED", "NOT is_listed"),
    ("NOT_A_SHARE", "NOT is_a_share"),
    ("IDENTITY_UNKNOWN", "is_listed IS NULL OR is_a_share IS NULL"),
    ("EXCLUDED_BJ", "no_bj AND split_part(ts_code, '.', 2) = 'BJ'"),
    ("EXCLUDED_ST", "no_st AND is_st"), ("ST_STATUS_UNKNOWN", "no_st AND is_st IS NULL"),
    ("IPO_TOO_RECENT", f"listing_trade_days IS NOT NULL AND {_YOUNG}"),
    ("LISTING_AGE_UNKNOWN", f"listing_trade_days IS NULL AND {_YOUNG}"),
]
block("m_universe", f"""
WITH reasoned AS (
  SELECT trade_date, ts_code, universe_id, can_buy, can_sell,
    {_foremost(_MEMBERSHIP)} AS exclusion_reason
  FROM m_rules, m_state JOIN m_status USING (trade_date, ts_code, is_listed, is_delisted))
SELECT *, {_tri('exclusion_reason', [r for r, _ in _MEMBERSHIP if r.endswith('UNKNOWN')])}
  AS is_in_universe FROM reasoned
""")

# -- filings -------------------------------------------------------------------------------
_ANN = "period + CAST(key % 45 AS INTEGER) + late"
_F_ANN = "period + CAST(key % 45 + key % 4 AS INTEGER) + late"
block("m_filing_rows", """
WITH cells AS (
  SELECT k.key, k.year, q.q,
    last_day(make_date(CAST(k.year AS INTEGER), CAST(q.q * 3 AS INTEGER), 1)) AS period,
    CAST(coalesce(sum(CAST(round(o.o_totalprice * 100) AS BIGINT)), 0) AS BIGINT) AS cum,
    count(o.o_orderkey) AS cnt
  FROM (SELECT DISTINCT o_custkey AS key, year(o_orderdate) AS year FROM orders) k
  CROSS JOIN (SELECT unnest([1, 2, 3, 4]) AS q) q
  LEFT JOIN orders o ON o.o_custkey = k.key AND year(o.o_orderdate) = k.year
       AND quarter(o.o_orderdate) <= q.q
  GROUP BY ALL)
SELECT c.*, v.v, cum + CASE v.v WHEN 1 THEN q * 100 WHEN 2 THEN 7 ELSE 0 END AS restated,
  CAST(CASE WHEN v.v = 1 THEN CASE WHEN key % 14 = 0 THEN 200 ELSE 90 END ELSE 0 END AS INTEGER)
    AS late
FROM cells c JOIN (SELECT unnest([0, 1, 2, 3, 4]) AS v) v
  ON v.v = 0 OR (v.v = 1 AND key % 7 = 0) OR (v.v = 2 AND key % 50 = 1)
     OR (v.v = 3 AND key % 13 = 0) OR (v.v = 4 AND key % 19 = 0)
WHERE NOT (key % 11 = 0 AND q = 2)
""")
_COMMON = f"""CASE WHEN key % 47 = 9 THEN CAST(key AS VARCHAR) ELSE {_code('key')} END AS ts_code,
  CASE WHEN key % 31 = 4 AND q = 2 THEN 'None' ELSE {_stamp(_ANN)} END AS ann_date,
  {_stamp('CASE WHEN key % 43 = 7 THEN period - 1 ELSE period END')} AS end_date,
  CASE WHEN v = 1 THEN '1' ELSE '0' END AS update_flag"""
_TYPED = f"""CASE WHEN key % 5 <> 0 THEN {_stamp(_F_ANN)} END AS f_ann_date,
  CASE WHEN v = 4 THEN '2' ELSE '1' END AS report_type"""
_FIGURES = {
    "income_vip": f"""{_TYPED}, CASE WHEN key % 37 = 2 AND q = 3 THEN 'n/a'
      WHEN key % 41 = 2 AND q = 1 THEN NULL ELSE CAST(restated AS VARCHAR) END AS revenue,
      CAST(cum // 10 AS VARCHAR) AS n_income_attr_p""",
    "cashflow_vip": f"""{_TYPED},
      CAST(cnt * 100 + CASE WHEN v = 1 THEN 1 ELSE 0 END AS VARCHAR) AS n_cashflow_act""",
    "balancesheet_vip": f"{_TYPED}, CAST(restated AS VARCHAR) AS total_assets",
    "fina_indicator": "CAST(cum // 1000 AS VARCHAR) AS eps",
}
_OWN = {
    "income_vip": "ann_date end_date f_ann_date n_income_attr_p report_type revenue ts_code "
                  "update_flag",
    "cashflow_vip": "ann_date end_date f_ann_date n_cashflow_act report_type ts_code update_flag",
    "balancesheet_vip": "ann_date end_date f_ann_date report_type total_assets ts_code "
                        "update_flag",
    "fina_indicator": "ann_date end_date eps ts_code update_flag",
}
for _source, _figures in _FIGURES.items():
    _packed = ", ".join(f"{c} := {c}" for c in _OWN[_source].split())
    block(f"m_raw_{_source}", f"""
SELECT *, sha256('{_source}|' || to_json(struct_pack({_packed}))) AS record_id FROM (
  SELECT {_COMMON}, {_figures},
    '{_source}/by_period/' || {_stamp('period')} AS source_file, key * 10 + v AS source_row
  FROM m_filing_rows)
""")
    block(f"m_dedup_{_source}", f"""
SELECT * EXCLUDE (n, copy), n AS source_count FROM (
  SELECT *, '{_source}' AS source_table, count(*) OVER (PARTITION BY record_id) AS n,
    row_number() OVER (PARTITION BY record_id ORDER BY source_file, source_row) AS copy
  FROM m_raw_{_source}) WHERE copy = 1
""")
block("m_versions", f"""
SELECT *, greatest(ann_date, f_ann_date) AS effective_ann_date FROM (
  SELECT * REPLACE ({_day('ann_date')} AS ann_date, {_day('f_ann_date')} AS f_ann_date,
                    {_day('end_date')} AS end_date),
    ann_date AS raw_ann_date, f_ann_date AS raw_f_ann_date, end_date AS raw_end_date
  FROM (SELECT * FROM m_dedup_income_vip UNION ALL BY NAME SELECT * FROM m_dedup_cashflow_vip
        UNION ALL BY NAME SELECT * FROM m_dedup_balancesheet_vip
        UNION ALL BY NAME SELECT * FROM m_dedup_fina_indicator))
""")
# Availability is read off the table of natural days, which knows the session after each of them.
_FILING_STATUS = [
    ("invalid_code", f"NOT coalesce({CODE_OK.format(x='ts_code')}, false)"),
    ("invalid_report_date", "end_date IS NULL"),
    ("missing_announcement", f"{_blank('raw_ann_date')} AND {_blank('raw_f_ann_date')}"),
    ("invalid_announcement", " OR ".join(
        f"({d} IS NULL AND NOT {_blank('raw_' + d)})" for d in ("ann_date", "f_ann_date"))),
    ("announcement_before_report", "end_date > effective_ann_date"),
    ("calendar_before_coverage", "effective_ann_date < (SELECT min(day) FROM m_days)"),
    ("calendar_after_coverage", "session IS NULL"),
]
block("m_filings", f"""
WITH placed AS (
  SELECT v.*, n.next_trade_date AS session, row_number() OVER (
      PARTITION BY source_table, ts_code, end_date, report_type
      ORDER BY effective_ann_date NULLS LAST, record_id) AS version
  FROM m_versions v LEFT JOIN m_next n ON n.day = v.effective_ann_date),
graded AS (
  SELECT *, coalesce({_foremost(_FILING_STATUS)}, 'available') AS availability_status FROM placed)
SELECT * EXCLUDE (session), CASE availability_status WHEN 'available' THEN session END
  AS available_date FROM graded
""")


def _metric(source: str, name: str) -> str:
    return f"""SELECT source_table, ts_code, '{name}' AS metric, end_date, effective_ann_date,
    available_date, record_id,
    CASE WHEN isfinite(try_cast({name} AS DOUBLE)) THEN try_cast({name} AS DOUBLE) END
      AS metric_value,
    CASE WHEN {_blank(name)} THEN 'missing_metric'
         WHEN try_cast({name} AS DOUBLE) IS NULL OR NOT isfinite(try_cast({name} AS DOUBLE))
         THEN 'invalid_metric' ELSE 'available' END AS value_state
  FROM m_filings WHERE source_table = '{source}' AND trim(report_type) = '1'
   AND availability_status = 'available'"""


block("m_metrics", " UNION ALL ".join(
    [_metric("income_vip", "revenue"), _metric("income_vip", "n_income_attr_p"),
     _metric("cashflow_vip", "n_cashflow_act")]))
block("m_period", """
SELECT source_table, ts_code, metric, end_date, available_date,
  CASE WHEN min(claim) = max(claim) THEN min(metric_value) END AS value,
  CASE WHEN min(claim) = max(claim) THEN min(value_state) ELSE 'ambiguous_metric' END AS status,
  list(DISTINCT record_id ORDER BY record_id) AS ids
FROM (
  SELECT *, value_state || '|' || coalesce(CAST(metric_value AS VARCHAR), '') AS claim
  FROM m_metrics
  QUALIFY rank() OVER (PARTITION BY source_table, ts_code, metric, end_date, available_date
                       ORDER BY effective_ann_date DESC) = 1)
GROUP BY ALL
""")
_G = "source_table, ts_code, metric"
_QUARTER = "(d = last_day(d) AND month(d) IN (3, 6, 9, 12))"
# Event days of a period are its own versions' and its predecessor's; the state on each is
# looked up by as-of joins.
block("m_quarterly", f"""
WITH events AS (
  SELECT {_G}, end_date AS d, available_date AS day FROM m_period
  UNION
  SELECT {_G}, CAST(last_day(end_date + INTERVAL 3 MONTH) AS DATE), available_date FROM m_period
  WHERE end_date = last_day(end_date) AND month(end_date) IN (3, 6, 9)),
owned AS (
  SELECT e.*, {_QUARTER} AS is_q, CAST(last_day(d - INTERVAL 3 MONTH) AS DATE) AS before_d,
    o.value AS ov, o.status AS os, o.ids AS oi
  FROM events e ASOF JOIN m_period o ON o.source_table = e.source_table
   AND o.ts_code = e.ts_code AND o.metric = e.metric AND o.end_date = e.d
   AND e.day >= o.available_date),
paired AS (
  SELECT o.*, p.value AS pv, p.status AS ps, p.ids AS pi
  FROM owned o ASOF LEFT JOIN m_period p ON p.source_table = o.source_table
   AND p.ts_code = o.ts_code AND p.metric = o.metric AND p.end_date = o.before_d
   AND o.day >= p.available_date),
graded AS (
  SELECT *, CASE WHEN NOT is_q THEN 'unsupported_report_period' WHEN month(d) = 3 THEN os
    WHEN ps IS NULL AND os = 'available' THEN 'missing_previous_quarter'
    WHEN ps IS NULL THEN os || '+missing_previous_quarter'
    WHEN os <> 'available' AND ps <> 'available' AND os <> ps
      THEN least(os, ps) || '+' || greatest(os, ps)
    WHEN os <> 'available' THEN os WHEN ps <> 'available' THEN ps
    WHEN NOT isfinite(ov - pv) THEN 'invalid_computation' ELSE 'available' END AS status
  FROM paired),
valued AS (
  SELECT {_G}, d AS end_date, day AS available_date, status,
    CASE WHEN is_q AND month(d) = 3 THEN ov WHEN status = 'available' THEN ov - pv END AS value,
    array_to_string(CASE WHEN NOT is_q OR month(d) = 3 OR ps IS NULL THEN oi
      ELSE list_sort(list_distinct(list_concat(oi, pi))) END, ',') AS record_ids,
    CASE WHEN NOT is_q OR month(d) = 3 THEN CAST(d AS VARCHAR)
      ELSE CAST(before_d AS VARCHAR) || ',' || CAST(d AS VARCHAR) END AS source_ends
  FROM graded),
marked AS (
  SELECT *, (coalesce(CAST(value AS VARCHAR), '-') || '|' || status || '|' || record_ids) AS sig
  FROM valued)
SELECT * EXCLUDE (sig) FROM marked
QUALIFY sig IS DISTINCT FROM lag(sig) OVER (PARTITION BY {_G}, end_date ORDER BY available_date)
""")


def _slot(k: int) -> str:
    return f"""s{k} AS (
  SELECT e.*, q.value AS v{k}, q.status AS s{k}, q.record_ids AS r{k}, q.available_date AS a{k}
  FROM {'own_events' if k == 0 else f's{k - 1}'} e ASOF {'JOIN' if k == 0 else 'LEFT JOIN'}
   m_quarterly q ON q.source_table = e.source_table
   AND q.ts_code = e.ts_code AND q.metric = e.metric
   AND q.end_date = CASE WHEN {k} = 0 THEN e.d
       WHEN e.is_q THEN CAST(last_day(e.d - INTERVAL {3 * k} MONTH) AS DATE) END
   AND e.day >= q.available_date)"""


def _listed(kind: str) -> str:
    """Comma list of the expected ends (oldest first) whose slot satisfies a condition."""
    parts = []
    for k in (3, 2, 1, 0):
        end = f"CAST(CAST(last_day(d - INTERVAL {3 * k} MONTH) AS DATE) AS VARCHAR)"
        condition = {"all": "true", "missing": f"s{k} IS NULL",
                     "unavailable": f"s{k} <> 'available'"}[kind]
        parts.append(f"CASE WHEN {condition} THEN {end} END")
    return f"CASE WHEN is_q THEN concat_ws(',', {', '.join(parts)}) ELSE '' END"


def _any(text: str) -> str:
    return " OR ".join(f"coalesce(contains(s{k}, '{text}'), false)" for k in range(4))


block("m_ttm", f"""
WITH own_events AS (
  SELECT DISTINCT {_G}, d, day, {_QUARTER} AS is_q FROM (
    SELECT {_G}, end_date AS d, available_date AS day FROM m_quarterly
    UNION ALL
    SELECT {_G}, CAST(last_day(end_date + to_months(CAST(3 * k AS INTEGER))) AS DATE),
      available_date
    FROM m_quarterly, (SELECT unnest([1, 2, 3]) AS k)
    WHERE end_date = last_day(end_date) AND month(end_date) IN (3, 6, 9, 12))),
{_slot(0)}, {_slot(1)}, {_slot(2)}, {_slot(3)},
graded AS (
  SELECT *, CASE WHEN NOT is_q THEN 'unsupported_report_period'
    WHEN {_any('ambiguous')} THEN 'ambiguous_quarter' WHEN {_any('invalid')} THEN 'invalid_quarter'
    WHEN s0 IS NULL OR s1 IS NULL OR s2 IS NULL OR s3 IS NULL OR s0 <> 'available'
      OR s1 <> 'available' OR s2 <> 'available' OR s3 <> 'available' THEN 'missing_quarter'
    WHEN isfinite(v0 + v1 + v2 + v3) THEN 'available' ELSE 'invalid_computation' END AS status
  FROM s3),
valued AS (
  SELECT {_G}, d AS end_date, day AS available_date, status,
    CASE WHEN status = 'available' THEN v3 + v2 + v1 + v0 END AS value,
    array_to_string(list_sort(list_distinct(string_split(
      CASE WHEN is_q THEN concat_ws(',', r3, r2, r1, r0) ELSE r0 END, ','))), ',') AS record_ids,
    {_listed('all')} AS source_ends, {_listed('missing')} AS missing_ends,
    {_listed('unavailable')} AS unavailable_ends,
    concat_ws(',', CAST(a3 AS VARCHAR), CAST(a2 AS VARCHAR), CAST(a1 AS VARCHAR),
              CAST(a0 AS VARCHAR)) AS quarters
  FROM graded),
marked AS (
  SELECT *, (coalesce(CAST(value AS VARCHAR), '-') || '|' || status || '|' || record_ids || '|'
    || CASE WHEN status = 'unsupported_report_period' THEN '' ELSE quarters END || '|'
    || missing_ends) AS sig FROM valued)
SELECT * EXCLUDE (sig, quarters) FROM marked
QUALIFY sig IS DISTINCT FROM lag(sig) OVER (PARTITION BY {_G}, end_date ORDER BY available_date)
""")


def row_hashes(table: str, kinds: dict[str, str]) -> str:
    """SQL of the XXH64 row hashes (h) behind ``fingerprint``: the null map, then each value, chained.

    Numbers modulo 2^64 are kept in 128 bits, one operation a step. ``kinds`` names each column's
    type: long, int, double, timestamp (microseconds) or flag, a text of at most three bytes.
    """
    p1, p2, p3, p4, p5 = (11400714785074694791, 14029467366897019727, 1609587929392839161,
                          9650029242287828579, 2870177450012600261)
    every, steps = "18446744073709551615::UHUGEINT", []

    def times(x: str, p: int) -> str:
        return f"(({x}) * {p}::UHUGEINT & {every})"

    def turned(r: int, name: str) -> str:
        return f"(({name} << {r}) & {every} | ({name} >> {64 - r}))"

    def eight(word: str) -> None:  # one word of eight bytes
        steps.append(f"{times(word, p2)} AS k")
        steps.append(f"{times(turned(31, 'k'), p1)} AS k")
        steps.append("xor(h, k) AS h")
        steps.append(f"({times(turned(27, 'h'), p1)} + {p4}) & {every} AS h")

    def one(byte: str, present: str) -> None:
        steps.append(f"xor(h, {times(byte, p5)}) AS x")
        steps.append(f"CASE WHEN {present} THEN {times(turned(11, 'x'), p1)} ELSE h END AS h")

    def last() -> None:
        for shift, p in ((33, p2), (29, p3)):
            steps.append(f"xor(h, h >> {shift}) AS h")
            steps.append(f"{times('h', p)} AS h")
        steps.append("xor(h, h >> 32) AS h")

    columns = sorted(kinds)
    bits = [f"(CASE WHEN {c} IS NULL THEN 49 ELSE 48 END)::UHUGEINT" for c in columns]
    if len(bits) != 11:
        raise ValueError("the null map is spelled out for eleven columns")
    steps.append(f"{(42 + p5 + 11) % 2**64}::UHUGEINT AS h")
    eight(" + ".join(f"({bit} << {8 * i})" for i, bit in enumerate(bits[:8])))
    for bit in bits[8:]:
        one(bit, "true")
    last()
    for c in columns:
        kind = kinds[c]
        steps.append("h AS seed")
        if kind == "flag":
            steps.append(f"(seed + {p5} + coalesce(strlen({c}), 0)::UHUGEINT) & {every} AS h")
            for i in range(3):
                steps.append(f"(CASE WHEN strlen({c}) > 3 THEN error('a flag is at most three bytes long') "
                    f"WHEN strlen({c}) > {i} THEN ('0x' || substr(hex({c}), {2 * i + 1}, 2))::UTINYINT "
                    "ELSE 0 END)::UHUGEINT AS b")
                one("b", f"coalesce(strlen({c}) > {i}, false)")
        elif kind == "int":
            steps.append(f"(seed + {p5} + 4) & {every} AS h")
            steps.append(f"xor(h, {times(f'(coalesce({c}, 0)::BIGINT & 4294967295)::UHUGEINT', p1)}) AS h")
            steps.append(f"({times(turned(23, 'h'), p2)} + {p3}) & {every} AS h")
        else:
            word = {"long": c, "timestamp": f"epoch_us({c})", "double": f"({c} + 0.0)::DOUBLE::BIT::BIGINT"}[kind]
            steps.append(f"(seed + {p5} + 8) & {every} AS h")
            steps.append(f"coalesce({word}, 0)::HUGEINT AS v")
            steps.append("(CASE WHEN v < 0 THEN v + 18446744073709551616 ELSE v END)::UHUGEINT AS w")
            eight("w")
        last()
        steps.append(f"CASE WHEN {c} IS NULL THEN seed ELSE h END AS h")
    empty = ", ".join(f"0::UHUGEINT AS {name}" for name in ("h", "k", "x", "b", "w", "seed"))
    parts = [f"s0 AS (SELECT {', '.join(columns)}, {empty}, 0::HUGEINT AS v FROM {table})"]
    for i, step in enumerate(steps):
        expression, name = step.rsplit(" AS ", 1)
        parts.append(f"s{i + 1} AS (SELECT * REPLACE ({expression} AS {name}) FROM s{i})")
    signed = "CASE WHEN h > 9223372036854775807 THEN h::HUGEINT - 18446744073709551616 ELSE h::HUGEINT END"
    return f"WITH {', '.join(parts)} SELECT ({signed})::BIGINT AS h FROM s{len(steps)}"
