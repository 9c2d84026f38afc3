"""DuckDB SQL that answers the registered queries on the same tables."""

from __future__ import annotations

from siftworks.catalog import evolution_sql, odd_sql

_FEED = """
sold AS (
  SELECT o_orderkey AS k, o_custkey AS buyer, strftime(o_orderdate, '%Y-%m') AS ym,
         o_orderpriority, CAST(o_totalprice AS DECIMAL(18,2)) AS total,
         c_name, c_mktsegment, n_name, strftime(o_orderdate, '%Y-%m') = '1995-01' AS ref
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
),
copies AS (SELECT *, 0 AS copy FROM sold UNION ALL SELECT *, 1 AS copy FROM sold WHERE k % 50 = 0),
feed AS (
  SELECT
    k * 2 + copy + 1 AS src,
    sha256('["sales_feed","derived",' || (k * 2 + copy + 1) || ']') AS rid,
    CASE WHEN NOT ref AND k % 97 = 0 THEN '1995-13' ELSE ym END AS month,
    CASE WHEN NOT ref AND k % 79 = 0 THEN '  ' || lower(n_name) || ' '
         WHEN NOT ref AND k % 101 = 0 THEN 'UNKNOWN' ELSE n_name END AS town,
    CASE WHEN k % 61 = 0 OR (ref AND k % 13 = 0) THEN 'RARE'
         WHEN k % 1009 = 0 OR (ref AND k % 17 = 0) THEN 'SINGLE'
         ELSE c_mktsegment END AS flat_type,
    CASE WHEN NOT ref AND k % 103 = 0 THEN 'ABC'
         ELSE buyer || CASE WHEN NOT ref AND k % 7 = 0 THEN 'A' ELSE '' END END AS block,
    c_name AS street_name,
    CASE WHEN NOT ref AND k % 83 = 0 THEN '01 TO 05'
         ELSE lpad(CAST(3 * (k % 12) + 1 AS VARCHAR), 2, '0') || ' TO '
              || lpad(CAST(3 * (k % 12) + 3 AS VARCHAR), 2, '0') END AS storey_range,
    CASE WHEN NOT ref AND k % 107 = 0 THEN '0'
         ELSE CAST(40 + k % 100 AS VARCHAR) END AS floor_area_sqm,
    o_orderpriority AS flat_model,
    CASE WHEN NOT ref AND k % 109 = 0 THEN '2013'
         ELSE CAST(1960 + buyer % 30 AS VARCHAR) END AS lease_commence_date,
    CASE WHEN NOT ref AND k % 89 = 0 THEN '-1'
         ELSE CAST(CAST(total - copy AS DECIMAL(18,2)) AS VARCHAR) END AS resale_price,
    CASE WHEN k % 6 = 0 THEN NULL
         WHEN k % 6 = 1 THEN CAST(40 + k % 70 AS VARCHAR)
         WHEN k % 6 = 2 THEN (40 + k % 70) || ' Years '
              || lpad(CAST(k % 13 AS VARCHAR), 2, '0') || ' months'
         WHEN k % 6 = 3 THEN ' ' || (40 + k % 70) || ' year'
         WHEN k % 6 = 4 AND k % 5 = 0 THEN 'about 60 years'
         WHEN k % 6 = 4 THEN CAST(40 + k % 70 AS VARCHAR)
         ELSE '' END AS remaining_lease
  FROM copies
)"""

_ASSESSED = _FEED + """,
tidy AS (
  SELECT src, rid, month, remaining_lease, floor_area_sqm, lease_commence_date, resale_price,
    town AS raw_town, floor_area_sqm AS area_text,
    upper(trim(regexp_replace(town, '\\s+', ' ', 'g'))) AS town,
    upper(trim(flat_type)) AS flat_type, upper(trim(block)) AS block,
    upper(trim(street_name)) AS street_name, upper(trim(storey_range)) AS storey_range,
    upper(trim(flat_model)) AS flat_model
  FROM feed
),
domains AS (
  SELECT 'town' AS "column", town AS "value", count(*) AS "rows" FROM tidy
    WHERE month = '1995-01' GROUP BY town
  UNION ALL SELECT 'flat_type', flat_type, count(*) FROM tidy
    WHERE month = '1995-01' GROUP BY flat_type
  UNION ALL SELECT 'flat_model', flat_model, count(*) FROM tidy
    WHERE month = '1995-01' GROUP BY flat_model
  UNION ALL SELECT 'storey_range', storey_range, count(*) FROM tidy
    WHERE month = '1995-01' GROUP BY storey_range
),
parsed AS (
  SELECT *,
    regexp_full_match(month, '[0-9]{4}-(0[1-9]|1[0-2])') AS dated,
    TRY_CAST(substr(month, 1, 4) AS BIGINT) AS y, TRY_CAST(substr(month, 6, 2) AS BIGINT) AS m,
    TRY_CAST(area_text AS DOUBLE) AS area,
    TRY_CAST(lease_commence_date AS BIGINT) AS start_year,
    CAST(CAST(resale_price AS DECIMAL(18,2)) * 100 AS BIGINT) AS raw_cents,
    TRY_CAST(substr(storey_range, 1, 2) AS BIGINT) AS lo,
    TRY_CAST(substr(storey_range, 7, 2) AS BIGINT) AS hi,
    lower(trim(remaining_lease)) AS supplied
  FROM tidy
),
timed AS (
  SELECT *,
    CASE WHEN raw_cents > 0 THEN raw_cents END AS cents,
    CASE WHEN dated THEN (start_year + 99 - y) * 12 - (m - 1) END AS months,
    CASE
      WHEN regexp_full_match(supplied, '[0-9]{1,3}') THEN CAST(supplied AS BIGINT) * 12
      WHEN regexp_full_match(supplied, '[0-9]{1,3} years?( [0-9]{1,2} months?)?') THEN
        CASE WHEN coalesce(TRY_CAST(regexp_extract(supplied, 'years? ([0-9]{1,2}) month', 1) AS BIGINT), 0) <= 11
          THEN CAST(regexp_extract(supplied, '^[0-9]+') AS BIGINT) * 12
               + coalesce(TRY_CAST(regexp_extract(supplied, 'years? ([0-9]{1,2}) month', 1) AS BIGINT), 0)
        END
    END AS supplied_any
  FROM parsed
),
termed AS (
  SELECT *, CASE WHEN supplied_any <= 1188 THEN supplied_any END AS provided FROM timed
),
judged AS (
  SELECT *, list_filter([
    CASE WHEN NOT dated THEN 'invalid_date' END,
    CASE WHEN dated AND NOT (month BETWEEN '1995-01' AND '2001-12')
      THEN 'outside_requested_period' END,
    CASE WHEN town NOT IN (SELECT "value" FROM domains WHERE "column" = 'town')
      THEN 'not_in_reference:town' END,
    CASE WHEN flat_type NOT IN (SELECT "value" FROM domains WHERE "column" = 'flat_type')
      THEN 'not_in_reference:flat_type' END,
    CASE WHEN flat_model NOT IN (SELECT "value" FROM domains WHERE "column" = 'flat_model')
      THEN 'not_in_reference:flat_model' END,
    CASE WHEN storey_range NOT IN (SELECT "value" FROM domains WHERE "column" = 'storey_range')
      THEN 'not_in_reference:storey_range' END,
    CASE WHEN lo IS NULL OR hi IS NULL OR lo < 1 OR lo > hi THEN 'invalid_storey_range' END,
    CASE WHEN NOT regexp_matches(block, '[0-9]') THEN 'block_has_no_digits' END,
    CASE WHEN area IS NULL OR area <= 0 THEN 'invalid_floor_area' END,
    CASE WHEN NOT regexp_full_match(lease_commence_date, '[0-9]{4}')
      THEN 'invalid_lease_commence_year' END,
    CASE WHEN months IS NULL OR months <= 0 OR months > 1188
      THEN 'lease_outside_0_to_99_years' END,
    CASE WHEN cents IS NULL THEN 'invalid_resale_price' END
    {supplied_rule}
  ], lambda r: r IS NOT NULL) AS reasons
  FROM termed
),
valid AS (
  SELECT *, CAST(cents AS DOUBLE) / 100 / area AS ppsqm,
    to_json([['block', block], ['flat_model', flat_model], ['flat_type', flat_type],
      ['floor_area_sqm', area_text], ['lease_commence_date', lease_commence_date],
      ['month', month], {supplied_key} ['storey_range', storey_range],
      ['street_name', street_name], ['town', town]]) AS key
  FROM judged WHERE len(reasons) = 0
),
ranked AS (
  SELECT *, row_number() OVER best AS place, first_value(rid) OVER best AS winner
  FROM valid WINDOW best AS (PARTITION BY key ORDER BY cents DESC, src)
),
winners AS (SELECT *, ln(ppsqm) AS x FROM ranked WHERE place = 1),
s1 AS (SELECT town, flat_type, y, count(*) AS n, quantile_cont(x, 0.25) AS q1,
         quantile_cont(x, 0.75) AS q3 FROM winners GROUP BY ALL),
s2 AS (SELECT town, flat_type, count(*) AS n, quantile_cont(x, 0.25) AS q1,
         quantile_cont(x, 0.75) AS q3 FROM winners GROUP BY ALL),
s3 AS (SELECT flat_type, y, count(*) AS n, quantile_cont(x, 0.25) AS q1,
         quantile_cont(x, 0.75) AS q3 FROM winners GROUP BY ALL),
levelled AS (
  SELECT w.*,
    CASE WHEN s1.n >= 20 AND s1.q3 - s1.q1 > 1e-12 THEN 1
         WHEN s2.n >= 20 AND s2.q3 - s2.q1 > 1e-12 THEN 2
         WHEN s3.n >= 20 AND s3.q3 - s3.q1 > 1e-12 THEN 3 ELSE 0 END AS lvl,
    s1.n AS n1, s2.n AS n2, s3.n AS n3, s1.q1 AS a1, s2.q1 AS a2, s3.q1 AS a3,
    s1.q3 AS b1, s2.q3 AS b2, s3.q3 AS b3
  FROM winners w
  JOIN s1 ON s1.town = w.town AND s1.flat_type = w.flat_type AND s1.y = w.y
  JOIN s2 ON s2.town = w.town AND s2.flat_type = w.flat_type
  JOIN s3 ON s3.flat_type = w.flat_type AND s3.y = w.y
),
fenced AS (
  SELECT *,
    CASE lvl WHEN 1 THEN 'town_flat_type_year' WHEN 2 THEN 'town_flat_type_all_years'
             WHEN 3 THEN 'flat_type_year' ELSE 'unassessed' END AS peer_level,
    CAST(CASE lvl WHEN 1 THEN n1 WHEN 2 THEN n2 WHEN 3 THEN n3 ELSE 0 END AS BIGINT) AS peer_count,
    CASE lvl WHEN 1 THEN exp(a1 - 3 * (b1 - a1)) WHEN 2 THEN exp(a2 - 3 * (b2 - a2))
             WHEN 3 THEN exp(a3 - 3 * (b3 - a3)) END AS lower_f,
    CASE lvl WHEN 1 THEN exp(b1 + 3 * (b1 - a1)) WHEN 2 THEN exp(b2 + 3 * (b2 - a2))
             WHEN 3 THEN exp(b3 + 3 * (b3 - a3)) END AS upper_f
  FROM levelled
),
scored AS (
  SELECT *, coalesce(ppsqm < lower_f OR ppsqm > upper_f, false) AS flagged FROM fenced
),
cleaned AS (SELECT * FROM scored WHERE NOT flagged),
means AS (
  SELECT *, sum(cents) OVER g AS s, count(*) OVER g AS gn
  FROM cleaned WINDOW g AS (PARTITION BY month, town, flat_type)
),
coded AS (
  SELECT *, CAST(s AS DOUBLE) / (gn * 100) AS mean,
    'S' || left(lpad(regexp_replace(block, '[^0-9]', '', 'g'),
                     CAST(greatest(3, length(regexp_replace(block, '[^0-9]', '', 'g'))) AS INTEGER), '0'), 3)
        || left(lpad(CAST(s // (gn * 100) AS VARCHAR),
                     CAST(greatest(2, length(CAST(s // (gn * 100) AS VARCHAR))) AS INTEGER), '0'), 2)
        || right(month, 2) || left(town, 1) AS code
  FROM means
),
decisions AS (
  SELECT src, month, raw_town, 'validation' AS stage, reasons, NULL AS peer_level,
         provided, months FROM judged WHERE len(reasons) > 0
  UNION ALL SELECT src, month, raw_town, 'duplicate',
         ['duplicate_non_maximum_or_tied_price'], NULL, provided, months
         FROM ranked WHERE place > 1
  UNION ALL SELECT src, month, raw_town, 'anomaly', ['potential_price_anomaly'], peer_level,
         provided, months FROM scored WHERE flagged
  UNION ALL SELECT src, month, raw_town, 'cleaned', [], peer_level, provided, months FROM cleaned
)"""


def _feed(select: str) -> str:
    return f"WITH {_FEED}\n{select}"


def _pipeline(select: str, supplied: bool = False) -> str:
    rule = (
        ", CASE WHEN supplied <> '' AND provided IS NULL"
        " THEN 'invalid_provided_remaining_lease' END"
        if supplied
        else ""
    )
    key = "['remaining_lease', nullif(trim(remaining_lease), '')]," if supplied else ""
    ctes = _ASSESSED.replace("{supplied_rule}", rule).replace("{supplied_key}", key)
    return f"WITH {ctes}\n{select}"


_EVIDENCE = (
    "peer_level, peer_count, round(lower_f, 4) AS lower_fence, round(upper_f, 4) AS upper_fence"
)


def _profile_sql() -> str:
    numeric = {"floor_area_sqm", "lease_commence_date", "resale_price"}
    columns = [
        "block", "flat_model", "flat_type", "floor_area_sqm", "lease_commence_date", "month",
        "remaining_lease", "resale_price", "storey_range", "street_name", "town",
    ]
    parts = []
    for c in columns:
        x = f"TRY_CAST({c} AS DOUBLE)"
        if c in numeric:
            stats = (
                f"count({x}) AS parseable, round(avg({x}), 4) AS mean,"
                f" round(stddev_samp({x}), 4) AS std, round(quantile_cont({x}, 0.5), 4) AS p50,"
                " CAST(NULL AS VARCHAR) AS top_value, CAST(0 AS BIGINT) AS top_rows"
            )
        else:
            top = (
                f"SELECT {c} AS v, count(*) AS n FROM feed WHERE {c} IS NOT NULL"
                " GROUP BY 1 ORDER BY n DESC, v LIMIT 1"
            )
            stats = (
                "0 AS parseable, CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS std,"
                f" CAST(NULL AS DOUBLE) AS p50, (SELECT v FROM ({top})) AS top_value,"
                f" (SELECT n FROM ({top})) AS top_rows"
            )
        blank = f"{c} IS NULL OR trim({c}) = ''"
        parts.append(
            f"SELECT '{c}' AS \"column\", count(*) AS \"rows\","
            f" count(*) FILTER ({blank}) AS missing,"
            f" round(count(*) FILTER ({blank}) * 100.0 / count(*), 4) AS missing_pct,"
            f" count(DISTINCT {c}) AS distinct_non_null, {stats} FROM feed"
        )
    return _feed("\nUNION ALL\n".join(parts))


def _describe(column: str) -> str:
    x = f"CAST({column} AS DOUBLE)"
    quartiles = ", ".join(
        f"round(quantile_cont({x}, {p}), 4) AS {name}"
        for name, p in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))
    )
    return (
        f"SELECT '{column}' AS \"column\", count({x}) AS \"count\", round(avg({x}), 4) AS mean,"
        f" round(stddev_samp({x}), 4) AS std, round(min({x}), 4) AS \"min\", {quartiles},"
        f" round(max({x}), 4) AS \"max\" FROM orders"
    )


_CHECKS = {
    "row_has_one_outcome": "SELECT count(*) FROM decisions",
    "widenings_follow_cleaned": "SELECT count(*) FROM decisions",
    "term_parts_add_up": "SELECT count(*) FROM cleaned",
    "term_months_below_twelve": "SELECT count(*) FROM cleaned",
    "month_in_scope": "SELECT count(*) FROM cleaned",
    "known_value:town": "SELECT count(*) FROM cleaned",
    "known_value:flat_type": "SELECT count(*) FROM cleaned",
    "known_value:flat_model": "SELECT count(*) FROM cleaned",
    "known_value:storey_range": "SELECT count(*) FROM cleaned",
    "one_row_per_key": "SELECT count(*) FROM cleaned",
    "record_digest_unique": "SELECT count(*) FROM cleaned",
    "quarantine_text_unchanged":
        "SELECT count(*) FROM decisions WHERE stage <> 'cleaned'",
    "loser_not_above_winner":
        "SELECT count(*) FROM decisions WHERE stage = 'duplicate'",
    "winner_is_kept":
        "SELECT count(*) FROM decisions WHERE stage = 'duplicate'",
    "code_form": "SELECT count(*) FROM coded",
    "code_digest": "SELECT count(*) FROM coded",
    "group_mean": "SELECT count(*) FROM coded",
    "copies_agree:cleaned": "SELECT count(*) FROM cleaned",
    "copies_agree:transformed": "SELECT count(*) FROM coded",
    "copies_agree:hashed": "SELECT count(*) FROM coded",
    "copies_agree:quarantined":
        "SELECT count(*) FROM decisions WHERE stage <> 'cleaned'",
    "columns_kept": "SELECT CAST(10 * 5 AS BIGINT)",
}


def _checks_sql() -> str:
    rows = [
        f"SELECT '{name}' AS \"check\", true AS passed, CAST(0 AS BIGINT) AS violations,"
        f" ({counted}) AS rows_checked"
        for name, counted in _CHECKS.items()
    ]
    return _pipeline("\nUNION ALL\n".join(rows))


ORACLES: dict[str, str] = {
    "quality_by_month": _pipeline("""
SELECT month, count(*) FILTER (stage = 'anomaly') AS anomaly,
  count(*) FILTER (stage = 'cleaned') AS cleaned,
  count(*) FILTER (stage = 'duplicate') AS duplicate,
  count(*) FILTER (stage = 'validation') AS validation
FROM decisions GROUP BY month"""),
    "reference_domains": _pipeline('SELECT "column", "value", "rows" FROM domains'),
    "normalized_text": _pipeline("""
SELECT src AS _source_row, town, flat_type, flat_model, storey_range, block, street_name
FROM tidy"""),
    "validation_reasons": _pipeline("""
SELECT src AS _source_row, CAST(to_json(reasons) AS VARCHAR) AS quarantine_reasons
FROM judged WHERE len(reasons) > 0"""),
    "reason_histogram": _pipeline("""
SELECT reason, count(*) AS "rows" FROM (SELECT unnest(reasons) AS reason FROM decisions)
GROUP BY reason"""),
    "unseen_categories": _pipeline("""
SELECT c AS "column", v AS "value", count(*) AS "rows" FROM (
  SELECT 'town' AS c, town AS v FROM tidy UNION ALL SELECT 'flat_type', flat_type FROM tidy
  UNION ALL SELECT 'flat_model', flat_model FROM tidy
  UNION ALL SELECT 'storey_range', storey_range FROM tidy) t
WHERE v IS NOT NULL AND NOT EXISTS (
  SELECT 1 FROM domains d WHERE d."column" = t.c AND d."value" = t.v)
GROUP BY c, v"""),
    "scope_accounting": _pipeline("""
SELECT count(*) AS raw_rows,
  count(*) FILTER (dated AND month BETWEEN '1996-01' AND '2000-12') AS in_scope_rows,
  count(*) FILTER (NOT dated) AS invalid_date_rows,
  count(*) FILTER (dated AND NOT month BETWEEN '1996-01' AND '2000-12') AS out_of_scope_rows,
  count(*) FILTER (NOT dated OR month BETWEEN '1996-01' AND '2000-12') AS master_rows
FROM parsed"""),
    "storey_bounds": _feed("""
SELECT src AS _source_row, CAST(substr(storey_range, 1, 2) AS BIGINT) AS low,
  CAST(substr(storey_range, 7, 2) AS BIGINT) AS high FROM feed"""),
    "money_cents": _pipeline("SELECT src AS _source_row, coalesce(cents, -1) AS cents FROM timed"),
    "provided_duration_parse": _pipeline(
        "SELECT src AS _source_row, coalesce(provided, -1) AS months FROM termed", supplied=True
    ),
    "record_ids": _feed("SELECT src AS _source_row, rid AS _source_record_id FROM feed"),
    "canonical_key_hash": _pipeline(
        "SELECT src AS _source_row, sha256(CAST(key AS VARCHAR)) AS key_hash FROM valid"
    ),
    "dedup_winners": _pipeline("""
SELECT src AS _source_row, cents AS price_cents FROM ranked WHERE place = 1"""),
    "dedup_losers_with_reference": _pipeline("""
SELECT src AS _source_row, winner AS reference_id FROM ranked WHERE place > 1"""),
    "dedup_lineitem": """
SELECT l_orderkey, l_linenumber, cents, l_partkey, l_suppkey, copies FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY cents DESC, l_partkey, l_suppkey, l_quantity, l_discount, l_tax,
               l_returnflag, l_linestatus, l_shipdate) AS place,
    count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS copies
  FROM (SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents FROM lineitem))
WHERE place = 1""",
    "dedup_documents_text": """
SELECT doc_id, kept_doc_id FROM (
  SELECT doc_id, min(doc_id) OVER (PARTITION BY text, lang) AS kept_doc_id FROM documents)
WHERE doc_id <> kept_doc_id""",
    "price_fences": _pipeline(f"SELECT src AS _source_row, {_EVIDENCE} FROM scored"),
    "peer_level_counts": _pipeline("""
SELECT peer_level, count(*) AS "rows" FROM cleaned GROUP BY peer_level"""),
    "anomaly_rows": _pipeline(f"""
SELECT src AS _source_row, ppsqm AS price_per_sqm, {_EVIDENCE}
FROM scored WHERE flagged"""),
    "event_value_fences": """
WITH e AS (SELECT event_id, event_type, strftime(ts, '%Y-%m-%d') AS day, "value" AS v,
             ln("value") AS x FROM events WHERE "value" > 0),
s1 AS (SELECT event_type, day, count(*) AS n, quantile_cont(x, 0.25) AS a,
         quantile_cont(x, 0.75) AS b FROM e GROUP BY ALL),
s2 AS (SELECT event_type, count(*) AS n, quantile_cont(x, 0.25) AS a,
         quantile_cont(x, 0.75) AS b FROM e GROUP BY ALL),
j AS (SELECT e.*, CASE WHEN s1.n >= 20 AND s1.b - s1.a > 1e-12 THEN 1
                       WHEN s2.n >= 20 AND s2.b - s2.a > 1e-12 THEN 2 ELSE 0 END AS lvl,
        s1.n AS n1, s2.n AS n2, s1.a AS a1, s1.b AS b1, s2.a AS a2, s2.b AS b2
      FROM e JOIN s1 USING (event_type, day) JOIN s2 ON s2.event_type = e.event_type),
f AS (SELECT *, CASE lvl WHEN 1 THEN 'type_day' WHEN 2 THEN 'type' ELSE 'unassessed' END AS peer_level,
        CAST(CASE lvl WHEN 1 THEN n1 WHEN 2 THEN n2 ELSE 0 END AS BIGINT) AS peer_count,
        CASE lvl WHEN 1 THEN exp(a1 - 3 * (b1 - a1)) WHEN 2 THEN exp(a2 - 3 * (b2 - a2)) END AS lower_f,
        CASE lvl WHEN 1 THEN exp(b1 + 3 * (b1 - a1)) WHEN 2 THEN exp(b2 + 3 * (b2 - a2)) END AS upper_f
      FROM j)
SELECT event_id, peer_level, peer_count, round(lower_f, 4) AS lower_fence,
  round(upper_f, 4) AS upper_fence
FROM f WHERE v < lower_f OR v > upper_f""",
    "remaining_term": _pipeline("""
SELECT src AS _source_row, months AS remaining_lease_total_months,
  months // 12 AS remaining_lease_years, months % 12 AS remaining_lease_months,
  (months // 12) || ' years ' || lpad(CAST(months % 12 AS VARCHAR), 2, '0') || ' months'
    AS remaining_lease_years_months
FROM valid"""),
    "unit_price": _pipeline("""
SELECT src AS _source_row, y AS transaction_year, m AS transaction_month,
  CASE WHEN month < '1995-03' THEN 'approval' ELSE 'registration' END AS date_basis,
  ppsqm AS price_per_sqm FROM valid"""),
    "term_comparison": _pipeline("""
SELECT src AS _source_row, coalesce(provided, -1) AS provided_months,
  coalesce(provided - months, 0) AS difference_months,
  CASE WHEN provided IS NULL THEN 'source value absent'
       WHEN abs(provided - months) > 12 THEN 'review: difference exceeds 12 months'
       ELSE 'within year/month precision allowance' END AS note
FROM valid""", supplied=True),
    "lease_review": _pipeline("""
SELECT src AS _source_row, provided - months AS difference_months FROM decisions
WHERE stage = 'cleaned' AND abs(provided - months) > 12""", supplied=True),
    "group_average": _pipeline("SELECT src AS _source_row, mean AS group_average FROM coded"),
    "business_identifier": _pipeline("SELECT src AS _source_row, code AS identifier FROM coded"),
    "hashed_records": _pipeline("""
SELECT src AS _source_row, sha256(code) AS resale_identifier_hash,
  sha256(CAST(key AS VARCHAR)) AS resale_record_hash FROM coded"""),
    "identifier_collisions": _pipeline("""
SELECT count(*) AS business_identifier_distinct,
  CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS business_identifier_duplicate_excess,
  count(*) FILTER (n > 1) AS business_identifier_collision_groups,
  CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) AS business_identifier_rows_in_collisions
FROM (SELECT code, count(*) AS n FROM coded GROUP BY code)"""),
    "identifier_collision_rows": _pipeline("""
SELECT src AS _source_row, code AS identifier, n AS copies
FROM (SELECT src, code, count(*) OVER (PARTITION BY code) AS n FROM coded) WHERE n > 1"""),
    "decision_counts": _pipeline("""
SELECT count(*) AS master_rows,
  count(*) FILTER (stage = 'validation') AS validation_rejected_rows,
  count(*) FILTER (stage <> 'validation') AS validation_passed_rows,
  count(*) FILTER (stage = 'duplicate') AS duplicate_rejected_rows,
  count(*) FILTER (stage = 'anomaly') AS anomaly_candidates,
  count(*) FILTER (stage = 'cleaned') AS cleaned_rows,
  count(*) FILTER (stage <> 'cleaned') AS quarantined_rows,
  count(*) FILTER (stage = 'cleaned' AND peer_level = 'unassessed') AS anomaly_unassessed_rows,
  CAST(0 AS BIGINT) AS provided_lease_difference_gt_12_months
FROM decisions"""),
    "review_sample": _pipeline("""
SELECT src AS _source_row, month, raw_town AS town, stage,
  CAST(to_json(reasons) AS VARCHAR) AS quarantine_reasons
FROM decisions WHERE stage <> 'cleaned' ORDER BY src LIMIT 20"""),
    "numeric_describe": f"{_describe('o_custkey')}\nUNION ALL\n{_describe('o_totalprice')}",
    "top_values": """
SELECT "column", "rank", "value", "rows" FROM (
  SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY "rows" DESC, "value") AS "rank"
  FROM (SELECT 'c_mktsegment' AS "column", c_mktsegment AS "value", count(*) AS "rows"
          FROM customer GROUP BY c_mktsegment
        UNION ALL SELECT 'c_nationkey', CAST(c_nationkey AS VARCHAR), count(*)
          FROM customer GROUP BY c_nationkey)
  WHERE "value" IS NOT NULL) WHERE "rank" <= 5""",
    "column_profile": _profile_sql(),
    "conservation": _pipeline("""
SELECT count(DISTINCT src) AS master_ids, count(*) FILTER (stage = 'cleaned') AS kept_rows,
  count(*) FILTER (stage <> 'cleaned') AS rejected_rows,
  count(*) - count(DISTINCT src) AS violations
FROM decisions"""),
    "source_inventory": _pipeline("""
SELECT left(month, 4) AS feed_year, count(*) AS "rows",
  count(*) FILTER (dated AND month BETWEEN '1995-01' AND '2001-12') AS in_scope_rows,
  count(*) FILTER (NOT dated) AS invalid_date_rows,
  count(*) FILTER (dated AND NOT month BETWEEN '1995-01' AND '2001-12') AS out_of_scope_rows,
  min(month) FILTER (dated) AS min_month, max(month) FILTER (dated) AS max_month
FROM parsed GROUP BY 1"""),
    "csv_row_lineage": _feed("""
SELECT left(month, 4) AS feed_year, count(*) AS "rows", count(*) AS last_rows,
  count(*) AS different_rows FROM feed GROUP BY 1"""),
    "contract_checks": _checks_sql(),
}
ORACLES |= evolution_sql.oracles(_pipeline) | odd_sql.oracles(_FEED, _ASSESSED)
