"""DuckDB SQL of the queries over the feed with every kind of fault."""

from __future__ import annotations

from siftworks.presets import property_sales as sales
from siftworks.presets.odd_feed import ALTERED, PERIOD, PLAIN, WIDE

_COLUMNS = sorted([*sales.REQUIRED, sales.SUPPLIED_TERM, "agent"])
_TEXTS = ("town", "flat_type", "flat_model", "storey_range", "block", "street_name")


def _altered(column: str) -> str:
    cases = "".join(
        f" WHEN free AND k % {PERIOD} = {n} THEN '{text}'" for n, (name, text) in ALTERED.items() if name == column)
    if column in sales.REQUIRED:
        place = sorted(sales.REQUIRED).index(column)
        cases = f" WHEN free AND k % {PERIOD} = {place} THEN CASE WHEN k % 2 = 0 THEN NULL ELSE ' ' || chr(12288) END" + cases
    return f"CASE{cases} ELSE {column} END" if cases else column


def _odd_feed() -> str:
    columns = ", ".join(f"{_altered(c)} AS {c}" for c in (*sales.REQUIRED, sales.SUPPLIED_TERM))
    kind = f"free AND k % {PERIOD} ="
    return f"""
odd AS (SELECT (src - 1) // 2 AS k, (src - 1) % 2 AS copy, month <> '1995-01' AS free, * FROM feed_now),
altered AS (SELECT src, rid, k, copy, free, {columns} FROM odd),
feed AS (
  SELECT src, rid, k, month, flat_type, storey_range, flat_model, lease_commence_date, remaining_lease,
    CASE WHEN {kind} 30 THEN translate(upper(trim(town)), '{PLAIN}', '{WIDE}')
         WHEN {kind} 31 THEN ' ' || chr(8195) || town || chr(160) || chr(10) ELSE town END AS town,
    CASE WHEN {kind} 32 THEN street_name || ' cafe' || chr(769) ELSE street_name END AS street_name,
    CASE WHEN {kind} 33 THEN block || chr(178) ELSE block END AS block,
    CASE WHEN {kind} 34 THEN '0' || floor_area_sqm || '.50' WHEN {kind} 35 THEN floor_area_sqm || '.0'
         ELSE floor_area_sqm END AS floor_area_sqm,
    CASE WHEN k % 100 = 0 AND copy = 1 AND regexp_full_match(resale_price, '[0-9]+\\.[0-9]{{2}}')
         THEN CAST(CAST(resale_price AS DECIMAL(18,2)) + 1 AS VARCHAR) ELSE resale_price END AS resale_price,
    CASE WHEN k % 150 = 0 AND copy = 1 THEN 'second desk' WHEN k % 7 = 0 THEN NULL
         ELSE 'desk ' || (k % 5) END AS agent
  FROM altered
)"""


def _tidy(column: str) -> str:
    """Composition of what this feed holds beyond ASCII; then one space for many, and none around."""
    text = f"replace(replace(translate({column}, '{WIDE}', '{PLAIN}'), chr(178), '2'), 'e' || chr(769), chr(233))"
    blank = "[\\s\\x{A0}\\x{2003}\\x{3000}]+"
    return f"nullif(upper(trim(regexp_replace({text}, '{blank}', ' ', 'g'))), '')"


_BLANK = "trim({}, ' ' || chr(12288) || chr(10))"
_MISSING = ", ".join(f"CASE WHEN {c} IS NULL THEN 'missing:{c}' END" for c in sorted(sales.REQUIRED))


def _unknown(column: str) -> str:
    known = f"(SELECT list(\"value\") FROM domains WHERE \"column\" = '{column}')"
    return (f"CASE WHEN NOT coalesce(list_contains({known}, {column}), false) THEN 'not_in_reference:{column}' END")


def _assessed() -> str:
    others = ", ".join(
        f"nullif({_BLANK.format(c)}, '') AS {c}" for c in _COLUMNS if c not in _TEXTS)
    texts = ", ".join(f"{_tidy(c)} AS {c}" for c in _TEXTS)
    domains = "\n  UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {c} AS \"value\", count(*) AS \"rows\" FROM tidy WHERE month = '1995-01' GROUP BY {c}"
        for c in sales.CATEGORIES)
    number = "CASE WHEN regexp_full_match({0}, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]{{1,4}})?') THEN TRY_CAST({0} AS DOUBLE) END"
    supplied = "lower(remaining_lease)"
    extra = f"TRY_CAST(regexp_extract({supplied}, 'years? ([0-9]{{1,2}}) month', 1) AS BIGINT)"
    reasons = ", ".join([
        _MISSING,
        "CASE WHEN NOT dated THEN 'invalid_date' END",
        "CASE WHEN dated AND NOT (month BETWEEN '1995-01' AND '2001-12') THEN 'outside_requested_period' END",
        *map(_unknown, sales.CATEGORIES),
        "CASE WHEN lo IS NULL OR hi IS NULL OR lo < 1 OR lo > hi THEN 'invalid_storey_range' END",
        "CASE WHEN NOT coalesce(regexp_matches(block, '[0-9]'), false) THEN 'block_has_no_digits' END",
        "CASE WHEN coalesce(area <= 0, true) THEN 'invalid_floor_area' END",
        "CASE WHEN NOT coalesce(regexp_full_match(lease_commence_date, '[0-9]{4}'), false) THEN 'invalid_lease_commence_year' END",
        "CASE WHEN coalesce(months <= 0 OR months > 1188, true) THEN 'lease_outside_0_to_99_years' END",
        "CASE WHEN cents IS NULL THEN 'invalid_resale_price' END",
        "CASE WHEN remaining_lease IS NOT NULL AND provided IS NULL THEN 'invalid_provided_remaining_lease' END",
    ])
    plain = "regexp_replace(CAST(area AS VARCHAR), '\\.0$', '')"
    values = {"floor_area_sqm": plain, "lease_commence_date": "CAST(CAST(start_year AS BIGINT) AS VARCHAR)"}
    key = ", ".join(f"['{c}', {values.get(c, c)}]" for c in _COLUMNS if c != sales.AMOUNT)
    return f""",
tidy AS (SELECT src, rid, k, town AS raw_town, {texts}, {others} FROM feed),
domains AS (
  {domains}
),
parsed AS (
  SELECT *, coalesce(regexp_full_match(month, '[0-9]{{4}}-(0[1-9]|1[0-2])'), false) AS dated,
    TRY_CAST(substr(month, 1, 4) AS BIGINT) AS y, TRY_CAST(substr(month, 6, 2) AS BIGINT) AS m,
    {number.format('floor_area_sqm')} AS area, {number.format('lease_commence_date')} AS start_year,
    CASE WHEN regexp_full_match(resale_price, '[0-9]+(\\.[0-9]{{1,2}})?([eE][0-9])?')
      THEN nullif(CAST(TRY_CAST(resale_price AS DOUBLE) * 100 + 0.001 AS BIGINT), 0) END AS cents,
    CASE WHEN regexp_full_match(storey_range, '[0-9]{{2}} TO [0-9]{{2}}') THEN TRY_CAST(substr(storey_range, 1, 2) AS BIGINT) END AS lo,
    CASE WHEN regexp_full_match(storey_range, '[0-9]{{2}} TO [0-9]{{2}}') THEN TRY_CAST(substr(storey_range, 7, 2) AS BIGINT) END AS hi,
    CASE WHEN regexp_full_match({supplied}, '[0-9]{{1,3}}') THEN CAST(remaining_lease AS BIGINT) * 12
         WHEN regexp_full_match({supplied}, '[0-9]{{1,3}} years?( [0-9]{{1,2}} months?)?') AND coalesce({extra}, 0) <= 11
           THEN CAST(regexp_extract({supplied}, '^[0-9]+') AS BIGINT) * 12 + coalesce({extra}, 0) END AS any_provided
  FROM tidy
),
timed AS (SELECT *, CASE WHEN dated THEN (start_year + 99 - y) * 12 - (m - 1) END AS months,
  CASE WHEN any_provided <= 1188 THEN any_provided END AS provided FROM parsed),
judged AS (SELECT *, list_filter([{reasons}], lambda r: r IS NOT NULL) AS reasons FROM timed),
valid AS (
  SELECT * REPLACE (CAST(months AS BIGINT) AS months), CAST(cents AS DOUBLE) / 100 / area AS ppsqm, to_json([{key}]) AS key
  FROM judged WHERE len(reasons) = 0
)"""


_JOB_CHECKS = (
    "row_has_one_outcome", "widenings_follow_cleaned", "term_parts_add_up", "term_months_below_twelve",
    "month_in_scope", *[f"known_value:{c}" for c in sales.CATEGORIES], "one_row_per_key", "record_digest_unique",
    "quarantine_text_unchanged", "loser_not_above_winner", "winner_is_kept", "code_form", "code_digest", "group_mean",
    *[f"copies_agree:{g}" for g in ("cleaned", "transformed", "hashed", "quarantined")], "columns_kept",
    "input_unchanged", "input_listed", "input_rows_accounted", "manifest_names_whole_run",
)


def oracles(feed: str, pipeline_text: str) -> dict[str, str]:
    """``feed`` ends in the plain feed; the pipeline's text from its ranking on is used as it is."""
    head = "feed AS (\n  SELECT\n    k * 2 + copy + 1 AS src,"
    tail = pipeline_text[pipeline_text.index("ranked AS ("):]
    text = f"{feed.replace(head, head.replace('feed AS', 'feed_now AS'))},{_odd_feed()}{_assessed()},\n{tail}"

    def query(select: str) -> str:
        return f"WITH {text}\n{select}"

    year = "left(month, 4)"
    return {
        "odd_reasons": query(
            "SELECT src AS _source_row, CAST(to_json(reasons) AS VARCHAR) AS reasons FROM judged WHERE len(reasons) > 0"),
        "rule_counts": query("""
SELECT reason, count(*) AS "rows" FROM (SELECT unnest(reasons) AS reason FROM decisions) GROUP BY reason"""),
        "odd_text": query(f"SELECT src AS _source_row, {', '.join(_TEXTS)} FROM tidy"),
        "odd_duplicates": query("""
SELECT src AS _source_row, sha256(CAST(key AS VARCHAR)) AS key_hash, cents,
  CASE WHEN place > 1 THEN winner END AS reference_id FROM ranked"""),
        "run_metrics": query("""
SELECT r.*, d.*, c.*, h.*, (SELECT count(*) FROM tidy WHERE month = '1995-01') AS reference_rows FROM
(SELECT count(*) AS raw_rows, count(*) FILTER (dated AND month BETWEEN '1995-01' AND '2001-12') AS in_scope_rows,
   count(*) FILTER (NOT dated) AS invalid_date_rows,
   count(*) FILTER (dated AND NOT month BETWEEN '1995-01' AND '2001-12') AS out_of_scope_rows FROM parsed) r,
(SELECT count(*) AS master_rows, count(*) FILTER (stage = 'validation') AS validation_rejected_rows,
   count(*) FILTER (stage <> 'validation') AS validation_passed_rows,
   count(*) FILTER (stage = 'duplicate') AS duplicate_rejected_rows,
   count(*) FILTER (stage = 'anomaly') AS anomaly_candidates, count(*) FILTER (stage = 'cleaned') AS cleaned_rows,
   count(*) FILTER (stage <> 'cleaned') AS quarantined_rows,
   count(*) FILTER (stage = 'cleaned' AND peer_level = 'unassessed') AS anomaly_unassessed_rows,
   count(*) FILTER (stage = 'cleaned' AND abs(provided - months) > 12) AS provided_lease_difference_gt_12_months
 FROM decisions) d,
(SELECT count(*) AS business_identifier_distinct, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS business_identifier_duplicate_excess,
   count(*) FILTER (n > 1) AS business_identifier_collision_groups,
   CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) AS business_identifier_rows_in_collisions
 FROM (SELECT code, count(*) AS n FROM coded GROUP BY code)) c,
(SELECT count(DISTINCT key) AS unique_record_hashes, count(*) AS transformed_rows, count(*) AS hashed_rows FROM coded) h"""),
        "canonical_numbers": """
WITH v AS (SELECT o_orderkey, o_orderkey AS k FROM orders),
d AS (SELECT o_orderkey, CAST(k AS DECIMAL(38,14)) * CAST([1, 1000, 1000000, 1000000000, 1000000000000][k % 5 + 1] AS BIGINT) AS l,
  CAST(k AS DECIMAL(38,14)) * [1.0::DECIMAL(12,10), 0.125, 0.0078125, 0.0009765625][k % 4 + 1] AS s,
  CAST(k % 9 AS DECIMAL(38,14)) * CAST(0.000244140625 AS DECIMAL(14,12)) AS t FROM v),
x AS (SELECT o_orderkey, regexp_replace(rtrim(CAST(CAST(l AS DECIMAL(38,14)) AS VARCHAR), '0'), '\\.$', '') AS large,
  regexp_replace(rtrim(CAST(CAST(s AS DECIMAL(38,14)) AS VARCHAR), '0'), '\\.$', '') AS small,
  regexp_replace(rtrim(CAST(CAST(t AS DECIMAL(38,14)) AS VARCHAR), '0'), '\\.$', '') AS tiny FROM d)
SELECT o_orderkey, large, CASE WHEN small = '0' THEN '0' ELSE '-' || small END AS small, tiny FROM x""",
        "csv_rows": query(f"""
SELECT src AS _source_row, {', '.join(f"coalesce({c}, '') AS {c}" for c in _COLUMNS)}, true AS numbered_right
FROM feed WHERE month IS NOT NULL"""),
        "job_checks": "SELECT unnest([" + ", ".join(f"'{c}'" for c in _JOB_CHECKS)
        + "]) AS \"check\", true AS passed, CAST(0 AS BIGINT) AS violations",
        "extra_attributes": query(f"""
SELECT {year} AS year, count(*) AS "rows", count(*) FILTER ({year} IN ('1997', '1998')) AS agents,
  count(agent) FILTER ({year} IN ('1997', '1998')) AS named_agents, CAST(0 AS BIGINT) AS late_notes,
  count(*) AS ids, 13 AS "columns"
FROM (SELECT month, agent, coalesce(regexp_full_match({_BLANK.format('month')}, '[0-9]{{4}}-(0[1-9]|1[0-2])'), false) AS dated
      FROM feed WHERE month IS NOT NULL)
WHERE NOT dated OR month BETWEEN '1996-01' AND '1998-12' GROUP BY 1"""),
    }
