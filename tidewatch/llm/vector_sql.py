"""DuckDB SQL of the two vector queries: their rounds written out as materialised subqueries."""

from __future__ import annotations

from . import centroids, vector_codes

FLOOR_MEAN = "((sum(q) - ((sum(q) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT"


def _finite(column: str) -> str:
    return f"len([x FOR x IN {column} IF x IS NOT NULL AND isfinite(x)]) = len({column})"


def clusters_sql() -> str:
    k, width = centroids.CLUSTERS, centroids.DIMENSION
    steps = [f"""e AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings
            WHERE len(embedding) = {width} AND {_finite('embedding')})""",
             f"""v AS MATERIALIZED (SELECT r, i, floor({centroids.SCALE} * embedding[i]::DOUBLE)::BIGINT AS q
            FROM e, range(1, {width + 1}) t(i))""",
             f"""c0 AS MATERIALIZED (SELECT c, i, q FROM v JOIN (SELECT r, row_number() OVER (
            ORDER BY sha256('{centroids.SALT}' || vec_id)) - 1 AS c FROM e QUALIFY c < {k}) f USING (r))"""]
    for n in range(centroids.ROUNDS + 1):
        steps.append(f"""a{n} AS MATERIALIZED (SELECT r, min(d * {k} + c) AS best FROM (
            SELECT r, c, sum((v.q - c{n}.q) * (v.q - c{n}.q))::HUGEINT AS d
            FROM v JOIN c{n} USING (i) GROUP BY r, c) p GROUP BY r)""")
        if n < centroids.ROUNDS:
            steps.append(f"""c{n + 1} AS MATERIALIZED (SELECT o.c, o.i, coalesce(m.q, o.q) AS q FROM c{n} o
            LEFT JOIN (SELECT best % {k} AS c, i, {FLOOR_MEAN} AS q FROM v JOIN a{n} USING (r)
                       GROUP BY ALL) m ON m.c = o.c AND m.i = o.i)""")
    last = centroids.ROUNDS
    return f"""WITH {', '.join(steps)},
        h AS (SELECT c, sha256(string_agg(q::VARCHAR, ',' ORDER BY i)) AS digest FROM c{last} GROUP BY c),
        f AS (SELECT vec_id, best % {k} AS c, best // {k} AS d FROM a{last} JOIN e USING (r))
        SELECT vec_id, f.c::INTEGER AS cluster, d::BIGINT AS distance,
               (sum(d) OVER (PARTITION BY f.c))::BIGINT AS cluster_inertia,
               (sum(d) OVER ())::BIGINT AS inertia, digest AS centroid_sha256
        FROM f JOIN h ON h.c = f.c"""


def codes_sql() -> str:
    p, k = vector_codes.PARTS, vector_codes.ENTRIES
    steps = [f"""e AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, label, embedding,
            len(embedding) // {p} AS w FROM embeddings
            WHERE len(embedding) > 0 AND {_finite('embedding')})""",
             f"""v AS MATERIALIZED (SELECT r, (i - 1) // w AS p, (i - 1) % w AS i,
            floor({vector_codes.SCALE} * embedding[i]::DOUBLE)::BIGINT AS q
            FROM (SELECT r, w, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM e) u)""",
             f"""c0 AS MATERIALIZED (SELECT p, c, i, q FROM v JOIN (SELECT r, row_number() OVER (
            ORDER BY vec_id) - 1 AS c FROM e QUALIFY c < {k}) f USING (r))"""]
    for n in range(vector_codes.ROUNDS + 1):
        steps.append(f"""a{n} AS MATERIALIZED (SELECT r, p, min(d * {k} + c) AS best FROM (
            SELECT r, p, c, sum((v.q - c{n}.q) * (v.q - c{n}.q))::HUGEINT AS d
            FROM v JOIN c{n} USING (p, i) GROUP BY r, p, c) x GROUP BY r, p)""")
        if n < vector_codes.ROUNDS:
            steps.append(f"""c{n + 1} AS MATERIALIZED (SELECT o.p, o.c, o.i, coalesce(m.q, o.q) AS q FROM c{n} o
            LEFT JOIN (SELECT v.p, best % {k} AS c, i, {FLOOR_MEAN} AS q FROM v JOIN a{n} USING (r, p)
                       GROUP BY ALL) m ON m.p = o.p AND m.c = o.c AND m.i = o.i)""")
    last = vector_codes.ROUNDS
    return f"""WITH {', '.join(steps)},
        f AS (SELECT r, string_agg(printf('%02x', (best % {k})::INTEGER), '' ORDER BY p) AS code,
                     sum(best // {k}) AS error FROM a{last} GROUP BY r)
        SELECT vec_id, code, error::BIGINT AS error,
               (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
               (SELECT sha256(string_agg(q::VARCHAR, ',' ORDER BY p, c, i)) FROM c{last}) AS codebooks_sha256
        FROM f JOIN e USING (r)"""
