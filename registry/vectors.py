"""Vector, map and cluster queries."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from registry.common import DIMS, POSTINGS, WORD_VECTORS, embeddings, hashed_word_vectors, long_vectors, postings
from sigloom.operators import classify, cluster, embed, som
from sigloom.scale import settle

GRID = (4, 4)
RADIUS = 1.5
LINE = 8


def _doc_means(spark, sf):
    rows = settle(postings(spark, sf), "postings")
    vectors = settle(hashed_word_vectors(spark, sf, rows).select("word", "vector"), "word-vectors")
    return long_vectors(embed.embed(rows, vectors, ["doc_id"]), ["doc_id"])


def _signatures(spark, sf):
    """(label, vector) pairs: the mean vector of each label, read once."""
    rows = embed.mean_vectors(embeddings(spark, sf), "label").orderBy("label").collect()
    return [(r["label"], r["vector"]) for r in rows]


def _nearest(norm):
    def run(spark, sf):
        found = embed.nearest_signature(embeddings(spark, sf), _signatures(spark, sf), ["vec_id", "label"], norm)
        return found.select("vec_id", "label", "signature", F.round("distance", 6).alias("distance"))

    return run


def _synonyms(spark, sf):
    """The ten nearest vectors of every one whose id is divisible by 100."""
    vectors = embeddings(spark, sf)
    return embed.synonyms(vectors.filter("vec_id % 100 = 0"), vectors, 10, "vec_id").select(
        "query", "rank", F.col("vec_id").alias("neighbour"), "similarity"
    )


def _scaled(spark, sf):
    vectors = embeddings(spark, sf)
    return long_vectors(embed.min_max_scale(vectors, *embed.fit_min_max(vectors)), ["vec_id"])


def small_map(spark, sf) -> som.Codebook:
    """A 4 x 4 map that starts from the 16 rows with the smallest vec_id."""
    rows = embeddings(spark, sf).orderBy("vec_id").limit(GRID[0] * GRID[1]).collect()
    return som.Codebook(*GRID, np.array([r["vector"] for r in rows]))


def placed(spark, sf):
    return som.som_assign(embeddings(spark, sf), small_map(spark, sf), ["vec_id", "label"])


def _bmu(spark, sf):
    return placed(spark, sf).select("vec_id", "unit", "x", "y", F.round("dist", 6).alias("dist"))


def _epoch(spark, sf):
    fresh, _ = som.som_epoch(embeddings(spark, sf), small_map(spark, sf), RADIUS)
    return long_vectors(fresh.to_table(spark), ["unit", "x", "y"], "weight")


def line_map() -> som.Codebook:
    """A 1 x 8 map on the diagonal of the grid."""
    return som.Codebook(1, LINE, np.array([[u * 3 / 7, u * 3 / 7] for u in range(LINE)]))


def _second_level(spark, sf):
    points = classify.labelled_points(placed(spark, sf).drop("label"), "unit", ["x", "y"])
    fresh, _ = som.som_epoch(points, line_map(), RADIUS)
    assigned = som.som_assign(points, fresh, ["vec_id"])
    return assigned.select("vec_id", F.col("unit").alias("signature"), F.round("dist", 6).alias("dist"))


def _error(spark, sf):
    return som.som_error(placed(spark, sf)).select(
        F.round("mean_error", 6).alias("mean_error"), F.round("max_error", 6).alias("max_error")
    )


def _centers(spark, sf):
    return np.array([v for _, v in _signatures(spark, sf)])


def _clustered(spark, sf):
    return cluster.kmeans_assign(embeddings(spark, sf), _centers(spark, sf), ["vec_id", "label"])


def _step(spark, sf):
    fresh = cluster.kmeans_step(embeddings(spark, sf), _centers(spark, sf))
    return long_vectors(cluster.centers_table(spark, fresh), ["cluster"], "center")


def _points(spark, sf):
    rows = classify.labelled_points(placed(spark, sf).drop("label"), "unit", ["x", "y"])
    return rows.select("vec_id", "label", F.element_at("vector", 1).alias("f1"), F.element_at("vector", 2).alias("f2"))


QUERIES = {
    "doc_mean_vector": _doc_means,
    "class_mean_vector": lambda spark, sf: long_vectors(embed.mean_vectors(embeddings(spark, sf), "label"), ["label", "n"]),
    "synonyms_topk": _synonyms,
    "minmax_scale": _scaled,
    "nearest_signature_l1": _nearest("l1"),
    "nearest_signature_l2": _nearest("l2"),
    "som_bmu": _bmu,
    "som_epoch": _epoch,
    "som_second_level": _second_level,
    "som_error": _error,
    "som_occupancy": lambda spark, sf: som.som_occupancy(placed(spark, sf)),
    "kmeans_assign": lambda spark, sf: _clustered(spark, sf).select(
        "vec_id", "label", "cluster", F.round("dist", 6).alias("dist")
    ),
    "kmeans_step": _step,
    "wssse": lambda spark, sf: cluster.wssse(_clustered(spark, sf)).select(F.round("wssse", 6).alias("wssse")),
    "cluster_sizes": lambda spark, sf: cluster.cluster_sizes(_clustered(spark, sf)),
    "labelled_points": _points,
}

_MEANS = DIMS + """,
means AS (SELECT label, dim, avg(value) AS value, count(*) AS n FROM dims GROUP BY label, dim),
signatures AS (SELECT label, list(value ORDER BY dim) AS vector FROM means GROUP BY label)"""

_L1 = "list_sum(list_transform(list_zip(v.vector, s.vector), lambda z: abs(z[1] - z[2])))"
_L2 = "pow(list_distance(v.vector, s.vector), 2)"

# The nearest signature of each vector; ``d`` is rounded to 9 digits, ties go to the first.
_NEAREST = """,
nearest AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, signature) AS place FROM (
    SELECT v.vec_id, v.label, v.vector, s.label AS signature, round({d}, 9) AS d
    FROM vectors v CROSS JOIN signatures s)) WHERE place = 1)"""

_MAP = DIMS + """,
units AS (SELECT CAST(row_number() OVER (ORDER BY vec_id) - 1 AS INTEGER) AS unit, vector FROM
  (SELECT * FROM vectors ORDER BY vec_id LIMIT 16)),
placed AS (SELECT vec_id, label, unit, CAST(unit // 4 AS INTEGER) AS x, CAST(unit % 4 AS INTEGER) AS y, sqrt(d) AS dist FROM (
  SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, unit) AS place FROM (
    SELECT v.vec_id, v.label, u.unit, round(pow(list_distance(v.vector, u.vector), 2), 9) AS d
    FROM vectors v CROSS JOIN units u)) WHERE place = 1)"""

_LINE = _MAP + """,
start AS (SELECT u AS unit, u * 3 / 7.0::DOUBLE AS w FROM range(8) t(u)),
won AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, unit) AS place FROM (
    SELECT p.vec_id, p.x, p.y, s.unit, round((p.x - s.w) * (p.x - s.w) + (p.y - s.w) * (p.y - s.w), 9) AS d
    FROM placed p CROSS JOIN start s)) WHERE place = 1),
sums AS (SELECT unit, count(*) AS n, sum(x) AS sx, sum(y) AS sy FROM won GROUP BY unit),
fresh AS (SELECT j.unit,
    sum(exp(-(j.unit - c.unit) * (j.unit - c.unit) / 4.5) * c.sx) / sum(exp(-(j.unit - c.unit) * (j.unit - c.unit) / 4.5) * c.n) AS wx,
    sum(exp(-(j.unit - c.unit) * (j.unit - c.unit) / 4.5) * c.sy) / sum(exp(-(j.unit - c.unit) * (j.unit - c.unit) / 4.5) * c.n) AS wy
  FROM start j CROSS JOIN sums c GROUP BY j.unit)"""

ORACLE = {
    "doc_mean_vector": "WITH " + POSTINGS + "," + WORD_VECTORS + """,
        joined AS (SELECT p.doc_id, p.tf, w.vector FROM postings p
          LEFT JOIN word_vectors w ON w.word = p.term),
        counts AS (SELECT doc_id, sum(tf) AS n FROM postings GROUP BY doc_id),
        parts AS (SELECT doc_id, tf, unnest(range(64)) AS dim, unnest(coalesce(vector, list_transform(range(64), lambda i: 0.0::DOUBLE))) AS value
          FROM joined)
        SELECT doc_id, CAST(dim AS INTEGER) AS dim, round(sum(tf * value) / any_value(n), 6) + 0.0 AS value
        FROM parts JOIN counts USING (doc_id) GROUP BY doc_id, dim""",
    "class_mean_vector": "WITH " + _MEANS + """
        SELECT label, n, CAST(dim AS INTEGER) AS dim, round(value, 6) + 0.0 AS value FROM means""",
    "synonyms_topk": "WITH " + DIMS + """
        SELECT query, CAST(rank AS INTEGER) AS rank, neighbour, similarity FROM (
          SELECT *, row_number() OVER (PARTITION BY query ORDER BY similarity DESC, neighbour) AS rank FROM (
            SELECT h.vec_id AS query, v.vec_id AS neighbour,
                   round(list_cosine_similarity(h.vector, v.vector), 6) + 0.0 AS similarity
            FROM vectors h JOIN vectors v ON v.vec_id <> h.vec_id WHERE h.vec_id % 100 = 0)) WHERE rank <= 10""",
    "minmax_scale": "WITH " + DIMS + """,
        bounds AS (SELECT dim, min(value) AS low, max(value) AS high FROM dims GROUP BY dim)
        SELECT vec_id, CAST(dim AS INTEGER) AS dim,
          round(CASE WHEN high = low THEN 0.5 ELSE (value - low) / (high - low) END, 6) + 0.0 AS value
        FROM dims JOIN bounds USING (dim)""",
    "nearest_signature_l1": "WITH " + _MEANS + _NEAREST.format(d=_L1) + """
        SELECT vec_id, label, signature, round(d, 6) AS distance FROM nearest""",
    "nearest_signature_l2": "WITH " + _MEANS + _NEAREST.format(d=_L2) + """
        SELECT vec_id, label, signature, round(sqrt(d), 6) AS distance FROM nearest""",
    "som_bmu": "WITH " + _MAP + "SELECT vec_id, unit, x, y, round(dist, 6) AS dist FROM placed",
    "som_epoch": "WITH " + _MAP + """,
        sums AS (SELECT unit, x, y, dim, count(*) AS n, sum(value) AS s FROM placed JOIN dims USING (vec_id) GROUP BY ALL),
        grid AS (SELECT unit, unit // 4 AS x, unit % 4 AS y FROM units)
        SELECT g.unit, CAST(g.x AS INTEGER) AS x, CAST(g.y AS INTEGER) AS y, CAST(dim AS INTEGER) AS dim,
          round(sum(h * s) / sum(h * n), 6) + 0.0 AS value
        FROM (SELECT g.*, c.dim, c.n, c.s, exp(-((g.x - c.x) * (g.x - c.x) + (g.y - c.y) * (g.y - c.y)) / 4.5) AS h
              FROM grid g CROSS JOIN sums c) g
        GROUP BY g.unit, g.x, g.y, dim""",
    "som_second_level": "WITH " + _LINE + """
        SELECT vec_id, CAST(unit AS INTEGER) AS signature, round(sqrt(d), 6) AS dist FROM (
          SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, unit) AS place FROM (
            SELECT p.vec_id, f.unit, round((p.x - f.wx) * (p.x - f.wx) + (p.y - f.wy) * (p.y - f.wy), 9) AS d
            FROM placed p CROSS JOIN fresh f)) WHERE place = 1""",
    "som_error": "WITH " + _MAP + """SELECT round(avg(dist), 6) AS mean_error, round(max(dist), 6) AS max_error FROM placed""",
    "som_occupancy": "WITH " + _MAP + "SELECT x, y, count(*) AS n FROM placed GROUP BY x, y",
    "kmeans_assign": "WITH " + _MEANS + _NEAREST.format(d=_L2) + """
        SELECT vec_id, label, CAST(signature AS INTEGER) AS cluster, round(d, 6) AS dist FROM nearest""",
    "kmeans_step": "WITH " + _MEANS + _NEAREST.format(d=_L2) + """
        SELECT CAST(n.signature AS INTEGER) AS cluster, CAST(d.dim AS INTEGER) AS dim, round(avg(d.value), 6) + 0.0 AS value
        FROM nearest n JOIN dims d USING (vec_id) GROUP BY 1, 2""",
    "wssse": "WITH " + _MEANS + _NEAREST.format(d=_L2) + "SELECT round(sum(d), 6) AS wssse FROM nearest",
    "cluster_sizes": "WITH " + _MEANS + _NEAREST.format(d=_L2) + """
        SELECT CAST(signature AS INTEGER) AS cluster, count(*) AS n FROM nearest GROUP BY 1""",
    "labelled_points": "WITH " + _MAP + """SELECT vec_id, CAST(unit AS DOUBLE) AS label,
        CAST(x AS DOUBLE) AS f1, CAST(y AS DOUBLE) AS f2 FROM placed""",
}
