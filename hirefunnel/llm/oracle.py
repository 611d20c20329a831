"""SQL counterparts, for DuckDB, of the operators that SQL can express."""

from __future__ import annotations


def _centroids(rounds: int = 3) -> str:
    """K-means in integers: one pair of steps (assign, move) per round, then a last assignment."""
    steps = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: cast(floor(64 * cast(x AS double)) AS bigint)) AS v
  FROM embeddings
  WHERE len(embedding) = 64
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS cluster, v AS c FROM vectors
  QUALIFY cluster < 16
)"""
    for n in range(rounds + 1):
        steps += f""", a{n} AS (
  SELECT vec_id, v, arg_min(cluster, (distance, cluster)) AS cluster, min(distance) AS distance
  FROM (SELECT vec_id, v, cluster, cast(list_sum(list_transform(
          list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS bigint) AS distance
        FROM vectors, c{n})
  GROUP BY vec_id, v
)"""
        if n < rounds:
            steps += f""", m{n} AS (
  SELECT cluster, list(cast(floor(total / n) AS bigint) ORDER BY i) AS c
  FROM (SELECT cluster, i, sum(x) AS total, count(*) AS n
        FROM (SELECT cluster, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{n})
        GROUP BY cluster, i)
  GROUP BY cluster
), c{n + 1} AS (
  SELECT c{n}.cluster, coalesce(m{n}.c, c{n}.c) AS c FROM c{n} LEFT JOIN m{n} USING (cluster)
)"""
    return f"""{steps}
SELECT vec_id, cast(a.cluster AS integer) AS cluster, distance,
       cast(sum(distance) OVER (PARTITION BY a.cluster) AS bigint) AS cluster_inertia,
       cast(sum(distance) OVER () AS bigint) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON a.cluster = c.cluster
"""


CENTROIDS = _centroids()

WARC = """
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM (SELECT page_id, octet_length(encode(body)) AS payload_bytes, sha256(body) AS payload_digest,
             min(page_id) OVER (PARTITION BY body) AS first
      FROM (SELECT page_id, coalesce(html, '') AS body FROM pages))
"""

_TERMS = r"""
  SELECT {key}, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM {table}"""

LEXICAL = f"""
WITH counts AS (
  SELECT doc_id, term, count(*) AS tf FROM ({_TERMS.format(key="doc_id", table="documents")}) GROUP BY ALL
), lengths AS (SELECT doc_id, cast(sum(tf) AS bigint) AS n FROM counts GROUP BY doc_id
), totals AS (SELECT count(*) AS docs, cast(sum(n) AS bigint) AS terms FROM lengths
), norms AS (SELECT doc_id, 75 + (25 * n * docs) // terms AS m FROM lengths, totals
), weights AS (
  SELECT term, cast(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS bigint) AS w
  FROM counts, totals GROUP BY term
), wanted AS (
  SELECT item_id, term, count(*) AS times
  FROM ({_TERMS.format(key="item_id", table="benchmark")}) GROUP BY ALL
), scores AS (
  SELECT item_id, doc_id,
         cast(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS bigint) AS score
  FROM wanted JOIN weights USING (term) JOIN counts USING (term) JOIN norms USING (doc_id)
  GROUP BY item_id, doc_id
)
SELECT item_id, cast(row_number() OVER best AS integer) AS rank, doc_id, score
FROM scores WHERE score > 0
WINDOW best AS (PARTITION BY item_id ORDER BY score DESC, doc_id)
QUALIFY rank <= 20
"""
