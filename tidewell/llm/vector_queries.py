"""The registered queries over ``embeddings``, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..queries.common import Query, table
from .clustering import cluster_vectors
from .negatives import hard_negatives


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


NEGATIVES_SQL = """
WITH v AS (SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS w FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF isfinite(x)]) = len(embedding)),
s AS MATERIALIZED (SELECT a.id AS anchor, v.id, a.label = v.label AS same, CAST(list_inner_product(a.w, v.w) AS BIGINT) AS score FROM v a JOIN v ON a.id % 100 = 0 AND a.id <> v.id),
p AS (SELECT anchor, id, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) <= 5)
SELECT p.anchor AS anchor_id, p.id AS positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor = p.anchor AND NOT s.same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score
WINDOW w AS (PARTITION BY p.anchor, p.id ORDER BY s.score DESC, s.id) QUALIFY rank <= 5
"""


def op13_centroid_clustering(spark: SparkSession, folder: str) -> DataFrame:
    return cluster_vectors(table(spark, folder, "embeddings"))


def clustering_sql(k: int = 40, rounds: int = 5, width: int = 64) -> str:
    """The same rounds as one chain of tables: components as rows, distances as sums over them."""
    steps = [
        f"""v AS MATERIALIZED (SELECT vec_id, row_number() OVER () AS r, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS w FROM embeddings
  WHERE len(embedding) = {width} AND len([x FOR x IN embedding IF isfinite(x)]) = {width})""",
        f"x AS MATERIALIZED (SELECT r, unnest(range({width})) AS d, unnest(w) AS x FROM v)",
        f"seed AS (SELECT r, row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS c FROM v QUALIFY c < {k})",
        "c0 AS MATERIALIZED (SELECT c, d, x FROM seed JOIN x USING (r))",
    ]
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (SELECT r, c, s FROM (SELECT x.r, c.c, CAST(sum((x.x - c.x) * (x.x - c.x)) AS BIGINT) AS s FROM x JOIN c{i} c USING (d) GROUP BY x.r, c.c)
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY s, c) = 1)""")
        if i < rounds:
            steps.append(f"""c{i + 1} AS MATERIALIZED (SELECT c, d, coalesce(m, x) AS x FROM c{i} LEFT JOIN
  (SELECT c, d, (t - ((t % n) + n) % n) // n AS m FROM (SELECT c, d, CAST(sum(x) AS BIGINT) AS t, count(*) AS n FROM a{i} JOIN x USING (r) GROUP BY c, d)) USING (c, d))""")
    steps.append(f"h AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY d)) AS centroid_sha256 FROM c{rounds} GROUP BY c)")
    return f"""WITH {", ".join(steps)}
SELECT vec_id, CAST(c AS INTEGER) AS cluster, s AS distance, CAST(sum(s) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(s) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{rounds} JOIN v USING (r) JOIN h USING (c)"""


QUERIES = {
    "op12_hard_negatives": Query(op12_hard_negatives, NEGATIVES_SQL),
    "op13_centroid_clustering": Query(op13_centroid_clustering, clustering_sql()),
}
