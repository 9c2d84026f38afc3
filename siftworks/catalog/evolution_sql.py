"""DuckDB SQL of the queries about change."""

from __future__ import annotations

from siftworks.catalog.evolution import CHANGED_MONTHS

_MONTHS = ", ".join(f"'{m}'" for m in CHANGED_MONTHS)


def earlier(pipeline: str) -> str:
    """The pipeline over the feed as it was delivered before."""
    head = "feed AS (\n  SELECT\n    k * 2 + copy + 1 AS src,"
    if head not in pipeline or "\n  FROM copies\n)" not in pipeline:
        raise ValueError("The feed is not where it was expected")
    inside = f"month IN ({_MONTHS})"
    before = f"""
  FROM copies
),
feed AS (
  SELECT * REPLACE (CASE WHEN {inside} AND (src - 1) // 2 % 5 = 1 THEN '1000.00' ELSE resale_price END AS resale_price)
  FROM feed_now WHERE NOT ({inside} AND (src - 1) // 2 % 5 = 0)
  UNION ALL
  SELECT * REPLACE (-src AS src, sha256('["sales_feed","derived",' || (-src) || ']') AS rid,
                    '900000.00' AS resale_price)
  FROM feed_now WHERE {inside} AND (src - 1) // 2 % 5 = 2
)"""
    return pipeline.replace(head, head.replace("feed AS", "feed_now AS")).replace("\n  FROM copies\n)", before)


def drifted(pipeline: str) -> str:
    """The pipeline over the feed with other flat types and lost prices."""
    head = "feed AS (\n  SELECT\n    k * 2 + copy + 1 AS src,"
    after = """
  FROM copies
),
feed AS (
  SELECT * REPLACE (
    CASE WHEN (src - 1) // 2 % 4 = 0 THEN 'RARE' ELSE flat_type END AS flat_type,
    CASE WHEN (src - 1) // 2 % 6 = 1 THEN ' ' ELSE resale_price END AS resale_price)
  FROM feed_now
)"""
    moved = pipeline.replace(head, head.replace("feed AS", "feed_now AS")).replace("\n  FROM copies\n)", after)
    # A blank price is missing, which is a reason of its own; nothing else here looks at reasons.
    return moved.replace("CAST(CAST(resale_price AS DECIMAL(18,2)) * 100 AS BIGINT)",
                         "CAST(TRY_CAST(resale_price AS DECIMAL(18,2)) * 100 AS BIGINT)")


_COLUMNS = (
    "block", "flat_model", "flat_type", "floor_area_sqm", "lease_commence_date", "month", "resale_price",
    "storey_range", "street_name", "town",
)
_CATEGORIES = ("town", "flat_type", "flat_model", "storey_range")
_MEASURES = "\nUNION ALL\n".join(
    [f"SELECT 'v' AS kind, '{c}' AS name, {c} AS v, count(*) AS n, 0 AS total FROM cleaned GROUP BY {c}" for c in _CATEGORIES]
    + [f"SELECT 'r', 'stage:{s}', NULL, count(*) FILTER (stage = '{s}'), count(*) FROM decisions"
       for s in ("validation", "duplicate", "anomaly")]
    + ["SELECT 'r', 'unassessed', NULL, count(*) FILTER (stage = 'cleaned' AND peer_level = 'unassessed'), count(*) FROM decisions"]
    + [f"SELECT 'r', 'missing:{c}', NULL, count(*) FILTER ({c} IS NULL OR trim({c}) = ''), count(*) FROM feed" for c in _COLUMNS])


def _gate(before: str, after: str) -> str:
    return f"""
WITH a AS ({before}), b AS ({after}),
p AS (SELECT name, v, n / sum(n) OVER (PARTITION BY name) AS p FROM a WHERE kind = 'v'),
q AS (SELECT name, v, n / sum(n) OVER (PARTITION BY name) AS q FROM b WHERE kind = 'v'),
m AS (SELECT coalesce(p.name, q.name) AS name, coalesce(p, 0) AS p, coalesce(q, 0) AS q
      FROM p FULL JOIN q ON p.name = q.name AND p.v = q.v),
d AS (SELECT name, sum(abs(p - q)) / 2 AS shift,
        sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END
          + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2 AS divergence FROM m GROUP BY name),
r AS (SELECT a.name, a.n AS h0, a.total AS n0, b.n AS h1, b.total AS n1, (a.n + b.n) / (a.total + b.total) AS pool
      FROM a JOIN b ON a.name = b.name WHERE a.kind = 'r' AND b.kind = 'r'),
z AS (SELECT *, h0 / n0 AS p0, h1 / n1 AS p1, sqrt(pool * (1 - pool) * (1.0 / n0 + 1.0 / n1)) AS s FROM r),
t AS (SELECT name, p0, p1, CASE WHEN s > 0 THEN (p1 - p0) / s ELSE 0 END AS z FROM z),
w AS (SELECT CAST(max(n0) AS DOUBLE) AS a, CAST(max(n1) AS DOUBLE) AS b FROM r)
SELECT 'shift:' || name AS "check", CAST(NULL AS DOUBLE) AS "before", CAST(NULL AS DOUBLE) AS "after",
  round(shift, 6) AS statistic, CAST(0.1 AS DOUBLE) AS "limit", shift <= 0.1 AS passed FROM d
UNION ALL SELECT 'divergence:' || name, NULL, NULL, round(divergence, 6), 0.02, divergence <= 0.02 FROM d
UNION ALL SELECT 'rate:' || name, round(p0, 6), round(p1, 6), round(z, 6), 0.02, NOT (abs(p1 - p0) > 0.02 AND abs(z) > 4) FROM t
UNION ALL SELECT 'rows', a, b, round(greatest(a, b) / least(a, b), 6), 2.0, greatest(a, b) / least(a, b) <= 2.0 FROM w"""


_APPROVED = """
approvals(version, c, v, f, t, approver) AS (VALUES
  (1, 'town', 'UNKNOWN', '1996-05', '1997-09', 'desk a'),
  (2, 'storey_range', '01 TO 05', '1997-01', NULL, 'desk a'),
  (3, 'town', 'UNKNOWN', '1998-02', NULL, 'desk b')),
versions AS (
  SELECT version, c, v, f, t, approver FROM approvals
  UNION ALL SELECT 0, "column", "value", '', CASE WHEN "column" = 'flat_type' AND "value" = 'SINGLE' THEN '1998-07' END,
    'reference month' FROM domains)"""


def _held(column: str, what: str) -> str:
    """The version that held for a row's value, or its approver."""
    month = "CASE WHEN p.dated THEN p.month ELSE '' END"
    return (f"(SELECT max_by({what}, v.version) FROM versions v WHERE v.c = '{column}' AND v.v = p.{column}"
            f" AND v.f <= {month} AND (v.t IS NULL OR {month} < v.t))")


def _as_of(pipeline) -> str:
    columns = ("town", "flat_type", "flat_model", "storey_range")
    failing = [f"CASE WHEN {_held(c, 'v.version')} IS NULL THEN 'not_in_reference:{c}' END" for c in columns]
    kept = "list_filter(j.reasons, lambda r: NOT starts_with(r, 'not_in_reference:'))"
    # Domain reasons stand between those of the month and all others.
    early = f"list_filter({kept}, lambda r: r IN ('invalid_date', 'outside_requested_period'))"
    late = f"list_filter({kept}, lambda r: r NOT IN ('invalid_date', 'outside_requested_period'))"
    domain = f"list_filter([{', '.join(failing)}], lambda r: r IS NOT NULL)"
    select = ", ".join(
        [f"CAST({_held(c, 'v.version')} AS INT) AS _version_{c}" for c in columns]
        + [f"{_held(c, 'v.approver')} AS _approver_{c}" for c in columns])
    text = pipeline("SELECT 1")
    head, _, _ = text.rpartition("SELECT 1")
    return f"""{head.rstrip()},{_APPROVED}
SELECT p.src AS _source_row, {select},
  CAST(to_json(list_concat(list_concat({early}, {domain}), {late})) AS VARCHAR) AS reasons
FROM parsed p JOIN judged j ON j.src = p.src"""


_EVIDENCE = """
SELECT src, CASE WHEN dated THEN month ELSE 'malformed' END AS part,
  struct_pack(l := peer_level, n := peer_count, a := lower_f, b := upper_f) AS evidence FROM scored"""


def oracles(pipeline) -> dict[str, str]:
    now = pipeline(_EVIDENCE)
    return {
        "incremental_refresh": pipeline("""
SELECT d.src AS _source_row, d.stage, CAST(to_json(d.reasons) AS VARCHAR) AS reasons,
  CASE WHEN r.place > 1 THEN r.winner END AS reference_id,
  s.peer_level, s.peer_count, round(s.lower_f, 4) AS lower_fence, round(s.upper_f, 4) AS upper_fence,
  c.mean AS group_average, c.code AS identifier,
  CASE WHEN c.src IS NOT NULL THEN sha256(CAST(c.key AS VARCHAR)) END AS record_hash
FROM decisions d LEFT JOIN ranked r ON r.src = d.src LEFT JOIN scored s ON s.src = d.src
  LEFT JOIN coded c ON c.src = d.src"""),
        "reference_as_of": _as_of(pipeline),
        "baseline_gate": _gate(earlier(pipeline(_MEASURES)), pipeline(_MEASURES)),
        "baseline_gate_drifted": _gate(pipeline(_MEASURES), drifted(pipeline(_MEASURES))),
        "incremental_months": f"""
WITH was AS ({earlier(now)}), now AS ({now}),
parts AS ({pipeline("SELECT CASE WHEN dated THEN month ELSE 'malformed' END AS part, count(*) AS n FROM parsed GROUP BY 1")}),
moved AS (SELECT DISTINCT now.part FROM now JOIN was ON was.src = now.src AND was.evidence IS DISTINCT FROM now.evidence)
SELECT part AS month, n AS "rows", part IN ({_MONTHS}) OR part IN (SELECT part FROM moved) AS rewritten FROM parts""",
    }
