"""Centroid clustering by sort-means, in exact integers.

Each round orders, for each centroid, the others by their distance from it. A vector is measured against the centroid it had and then against the others in
that order, up to the first that lies strictly beyond twice its distance: by the triangle inequality none from there on can be nearer, and
one at exactly twice may tie.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import named, remove_folder, shared_folder, sliced

#: Integer components stay below this, so that a squared distance over up to 64 of them fits 63 bits.
BOUND = 1 << 27


def quantised(vectors: DataFrame, dim: int = 64, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, packed): vectors with exactly ``dim`` components, none null or non-finite, each component x turned into floor(scale * x), packed as 32-bit integers.

    Null vectors and vectors with a component of ``BOUND`` or more after scaling, whose distances might not fit a long, take no part either. Null ids stay,
    repeated rows repeat, other columns are ignored; an empty table gives no rows.
    """
    if dim > 64:
        raise ValueError("distances over more than 64 components may not fit a long")

    def run(batches):
        for batch in sliced(batches, 4096):
            column = batch.column(1)
            sizes = pc.list_value_length(column).fill_null(-1).to_numpy()
            rows = np.flatnonzero(sizes == dim)
            values = column.take(pa.array(rows)).flatten()
            x = np.asarray(values.cast(pa.float64()).to_numpy(zero_copy_only=False), np.float64).reshape(-1, dim)  # a null is NaN here
            x = np.floor(scale * x)
            fits = (np.abs(x) < BOUND).all(axis=1)  # false for NaN and infinity
            packed = x[fits].astype("<i4")
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows[fits])), pa.array([r.tobytes() for r in packed], pa.binary())], names=["vec_id", "packed"])

    held = vectors.select(named(id_col).cast("long").alias("vec_id"), named(vector_col).cast("array<double>").alias("v"))
    return held.mapInArrow(run, "vec_id long, packed binary")


def first_centroids(held: DataFrame, k: int, salt: str) -> np.ndarray:
    """The ``k`` vectors with the smallest SHA-256 of ``<salt><vec_id>`` (a null id: of the salt alone), in that order; ties by their bytes. Fewer vectors: all of them."""
    name = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    rows = held.select(name.alias("name"), "packed").orderBy("name", "packed").limit(k).collect()
    return np.array([np.frombuffer(r.packed, "<i4") for r in rows], np.int64)


class Order:
    """Centroids, and for each of them the others by distance."""

    def __init__(self, centroids: np.ndarray):
        self.at = centroids
        #: squared distances between centroids
        self.apart = ((centroids[:, None, :] - centroids[None, :, :]) ** 2).sum(axis=2)
        #: for each centroid all numbers by distance from it, itself first
        own = np.where(np.eye(len(centroids), dtype=bool), -1, self.apart)
        self.order = np.argsort(own, axis=1, kind="stable")

    def nearest(self, x: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Nearest centroid (ties: the smaller number) and squared distance of each vector, which had ``before``; and how many distances were measured."""
        held = ((x - self.at[before]) ** 2).sum(axis=1)
        best, least, measured = before.copy(), held.copy(), len(x)
        rows = np.arange(len(x))
        for place in range(1, len(self.at)):
            other = self.order[before[rows], place]
            on = self.apart[before[rows], other] <= 4 * held[rows]  # strictly beyond twice the distance: stop
            rows, other = rows[on], other[on]
            if not len(rows):
                break
            d = ((x[rows] - self.at[other]) ** 2).sum(axis=1)
            measured += len(rows)
            nearer = (d < least[rows]) | ((d == least[rows]) & (other < best[rows]))
            best[rows[nearer]], least[rows[nearer]] = other[nearer], d[nearer]
        return best, least, measured


def _assigned(state: DataFrame, order: Order | None) -> DataFrame:
    """``state`` (vec_id, packed, cluster) with clusters and distances under ``order``."""
    shared = state.sparkSession.sparkContext.broadcast(order)  # k vectors

    def run(batches):
        order = shared.value
        for batch in sliced(batches, 8192):
            x = np.frombuffer(b"".join(batch.column("packed").to_pylist()), "<i4").reshape(len(batch), -1).astype(np.int64)
            best, least, _ = order.nearest(x, batch.column("cluster").to_numpy().astype(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("packed"), pa.array(best.astype(np.int32)), pa.array(least)], names=["vec_id", "packed", "cluster", "distance"])

    return state.select("vec_id", "packed", "cluster").mapInArrow(run, "vec_id long, packed binary, cluster int, distance long")


def _sums(state: DataFrame, k: int, dim: int) -> list:
    """(cluster, n, inertia, sums of the components) of each cluster; summed in each task first. ``k`` rows come to the driver."""

    def run(batches):
        n, total, sums = np.zeros(k, np.int64), [0] * k, np.zeros((k, dim), np.int64)
        for batch in batches:
            if len(batch):
                cluster, distance = batch.column("cluster").to_numpy(), batch.column("distance").to_numpy()
                x = np.frombuffer(b"".join(batch.column("packed").to_pylist()), "<i4").reshape(len(batch), -1)
                for c in np.unique(cluster):
                    at = cluster == c
                    n[c] += at.sum()
                    total[c] += int(distance[at].astype(object).sum()) if distance.max() > 1 << 40 else int(distance[at].sum())
                    sums[c] += x[at].sum(axis=0, dtype=np.int64)
        found = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(found.astype(np.int32)), pa.array(n[found]), pa.array([str(total[c]) for c in found], pa.string()), pa.array(list(sums[found]), pa.list_(pa.int64()))],
            names=["cluster", "n", "inertia", "sums"],
        )

    parts = state.select("packed", "cluster", "distance").mapInArrow(run, "cluster int, n long, inertia string, sums array<long>")
    wide = lambda c: F.sum(c.cast("decimal(38,0)"))
    return parts.groupBy("cluster").agg(F.sum("n").alias("n"), wide(F.col("inertia")).alias("inertia"), F.array(*[wide(F.element_at("sums", i + 1)) for i in range(dim)]).alias("sums")).collect()


def sort_means(vectors: DataFrame, k: int = 40, rounds: int = 5, dim: int = 64, scale: int = 256, salt: str = "2:", id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, list[dict]]:
    """(vec_id, cluster, distance) of every vector that ``quantised`` keeps, and for each centroid its components, inertia and number of vectors.

    Each of ``rounds`` rounds assigns every vector to the nearest centroid and moves each centroid that has vectors to the floor of their mean; then vectors are
    assigned once more. All arithmetic is exact. Equal vectors fall to one cluster; fewer than ``k`` vectors give as many centroids; no vectors: no rows.
    A round reads the table of the last, in which each vector has its cluster, and writes the next; the older is then removed. Nothing is shuffled but a
    row a cluster and task, and ``k`` rows are all that the driver sees.
    """
    spark = vectors.sparkSession
    base = f"{shared_folder(spark)}/sort-means-{uuid.uuid4().hex}"

    def written(df, n):
        df.write.parquet(f"{base}/{n}")
        if n:
            remove_folder(spark, f"{base}/{n - 1}")
        return spark.read.schema(df.schema).parquet(f"{base}/{n}")

    state = written(quantised(vectors, dim, scale, id_col, vector_col).withColumn("cluster", F.lit(0)), 0)
    at = first_centroids(state, k, salt)
    if not len(at):
        return state.select("vec_id", "cluster", F.lit(0).cast("long").alias("distance")), []
    for n in range(rounds + 1):
        state = written(_assigned(state, Order(at)), n + 1)
        stats = {r.cluster: r for r in _sums(state, len(at), dim)}
        if n < rounds:
            for c, r in stats.items():
                at[c] = [int(s) // r.n for s in r.sums]
    told = [{"cluster": c, "centroid": [int(x) for x in at[c]], "n": stats[c].n if c in stats else 0, "inertia": int(stats[c].inertia) if c in stats else 0} for c in range(len(at))]
    return state.select("vec_id", "cluster", "distance"), told


def op12_sort_means(spark, sf_dir):
    from ._common import table

    out, clusters = sort_means(table(spark, sf_dir, "embeddings"))
    total = sum(c["inertia"] for c in clusters)
    told = [(c["cluster"], c["inertia"], total, hashlib.sha256(",".join(map(str, c["centroid"])).encode()).hexdigest()) for c in clusters]
    told = spark.createDataFrame(told, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return out.join(F.broadcast(told), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")  # k rows


def _rounds(n: int) -> str:
    """Assignment ``n`` and, after each but the last, the centroids that follow."""
    nearest = f"""
        near{n} AS MATERIALIZED (
            SELECT row, c AS cluster, distance FROM (
                SELECT v.row, m.c, sum((v.x - m.x) * (v.x - m.x)) AS distance FROM v JOIN at{n} m ON v.i = m.i GROUP BY v.row, m.c)
            QUALIFY row_number() OVER (PARTITION BY row ORDER BY distance, c) = 1)"""
    if n == 5:
        return nearest
    return nearest + f""",
        at{n + 1} AS MATERIALIZED (
            SELECT m.c, m.i, coalesce(s.x, m.x) AS x FROM at{n} m LEFT JOIN (
                SELECT cluster AS c, i, CAST(floor(sum(x) / count(*)) AS BIGINT) AS x FROM v JOIN near{n} USING (row) GROUP BY cluster, i) s ON m.c = s.c AND m.i = s.i)"""


SQL = {
    "op12_sort_means": """
        WITH held AS MATERIALIZED (
            SELECT row_number() OVER () AS row, vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS x, sha256('2:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS name
            FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x) AND abs(floor(256 * CAST(x AS DOUBLE))) < 134217728)) = 64),
        v AS MATERIALIZED (SELECT row, unnest(range(64)) AS i, unnest(x) AS x FROM held),
        seeds AS (SELECT row, row_number() OVER (ORDER BY name, row) - 1 AS c FROM held QUALIFY c < 40),
        at0 AS MATERIALIZED (SELECT c, i, x FROM v JOIN seeds USING (row)),"""
    + ",".join(_rounds(n) for n in range(6))
    + """
        SELECT h.vec_id, CAST(n.cluster AS INTEGER) AS cluster, CAST(n.distance AS BIGINT) AS distance, CAST(sum(n.distance) OVER (PARTITION BY n.cluster) AS BIGINT) AS cluster_inertia,
               CAST(sum(n.distance) OVER () AS BIGINT) AS inertia, m.sha AS centroid_sha256
        FROM held h JOIN near5 n ON h.row = n.row JOIN (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS sha FROM at5 GROUP BY c) m ON m.c = n.cluster
    """,
}
