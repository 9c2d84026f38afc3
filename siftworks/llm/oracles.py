"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

_SIZES = r"""
d AS (SELECT doc_id, source, text,
        coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
        CAST('0x' || substr(md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || coalesce(md5(text), 'null')), 1, 12) AS BIGINT) AS draw
      FROM {documents}),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
        [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][CAST((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1 AS INT)] AS weight
      FROM d GROUP BY source),
r AS (SELECT *, source_size * 2.0::DOUBLE AS cap, source_size * 2.0::DOUBLE / weight AS ratio,
        sum(source_size) OVER () * 1.5::DOUBLE AS total FROM s),
l AS (SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY ratio, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(weight) OVER (ORDER BY ratio, encode(source) NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM r),
f AS (SELECT *, min(CASE WHEN ratio > level THEN level END) OVER () AS final FROM l),
t AS (SELECT source, source_size, CASE WHEN ratio <= level THEN cap ELSE weight * final END AS target FROM f),
p AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size + 1e-12) ELSE 0 END AS epochs FROM t),
w AS (SELECT *, greatest(target - epochs * source_size, 0) AS want FROM p),
b AS (SELECT *, row_number() OVER o AS place, sum(size) OVER o - size AS before
      FROM d WINDOW o AS (PARTITION BY source ORDER BY draw ROWS UNBOUNDED PRECEDING)),
x AS (SELECT b.source, min(place) FILTER (WHERE before + size * 0.5 > want) AS stop
      FROM b JOIN w ON b.source IS NOT DISTINCT FROM w.source GROUP BY b.source),
m AS (SELECT b.*, w.source_size, w.target,
        CAST(epochs AS BIGINT) + CASE WHEN x.stop IS NULL OR place < x.stop THEN 1 ELSE 0 END AS copies
      FROM b JOIN w ON b.source IS NOT DISTINCT FROM w.source JOIN x ON b.source IS NOT DISTINCT FROM x.source)
"""

_LINES = r"""
t AS (SELECT doc_id, text, md5(coalesce(text, '')) AS tk, string_split(text, chr(10)) AS ls FROM {documents}),
n AS (SELECT doc_id, tk, coalesce(len(ls), 0) AS n FROM t),
k AS (SELECT DISTINCT doc_id, tk, ls FROM t WHERE ls IS NOT NULL),
q AS (SELECT doc_id, tk, ls, unnest(range(1, len(ls))) AS i FROM k),
v AS (SELECT doc_id, tk, i, ls[i] AS a, ls[i + 1] AS b FROM q),
e AS (SELECT *, row_number() OVER (PARTITION BY a, b ORDER BY doc_id NULLS LAST, tk, i) AS place FROM v),
g AS (SELECT DISTINCT doc_id, tk, unnest([i, i + 1]) AS i FROM e WHERE place > 1),
y AS (SELECT k.doc_id, k.tk, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS i FROM k),
z AS (SELECT y.doc_id, y.tk, string_agg(y.line, chr(10) ORDER BY y.i) FILTER (WHERE g.i IS NULL) AS kept,
        count(g.i) AS removed
      FROM y LEFT JOIN g ON y.doc_id IS NOT DISTINCT FROM g.doc_id AND y.tk = g.tk AND y.i = g.i
      GROUP BY y.doc_id, y.tk)
"""

_TOPK = """
v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
      FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id,
        max(CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])) AS BIGINT)) AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e) GROUP BY ALL),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM s)
"""

ORACLES = {
    "op1_mixing": f"WITH {_SIZES.format(documents='documents')} "
    "SELECT doc_id, size, source_size, target, size * copies AS taken FROM m",
    "op6_topk": f"WITH {_TOPK} SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5",
    "op9_line_dedup": f"""WITH {_LINES.format(documents='documents')}
        SELECT n.doc_id, n.n AS n_lines, coalesce(z.removed, 0) AS n_removed,
            sha256(coalesce(z.kept, '')) AS kept_sha256
        FROM n LEFT JOIN z ON n.doc_id IS NOT DISTINCT FROM z.doc_id AND n.tk = z.tk AND n.n > 0""",
}
