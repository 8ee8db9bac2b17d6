"""Centroid clustering over subvector dictionaries.

Vectors are cut into blocks of ``block`` dimensions. The vectors of a chunk (at most
``chunk``) are written once, each block as the list of its distinct subvectors and one
code a vector; nothing is lost. A round reads that table: the exact squared distances of
every distinct subvector to the centroids' subvectors are computed once, and a vector's
distance is the sum of its codes' entries. Copies and repeated subvectors of a chunk cost
one entry. A round sends one row a task and cluster (sums and counts) through the shuffle
and its centroids (k rows) back to the driver; vectors never move. Chunks are read again
if an executor is lost.

Components x become integers floor(scale * x); all sums are exact (64-bit inside a chunk,
decimals between chunks). Kept are vectors with exactly ``dims`` components, none null, NaN or
infinite; components beyond +-``LARGEST`` after scaling, whose squared distances would
leave 64 bits, also drop the vector. Null id: hashed as ``3:`` alone; repeated ids and
repeated vectors are vectors of their own, equal hashes start in order of the components.
Fewer than k kept vectors give as many centroids; an empty table gives no rows. Other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustlens.session import materialize

K, ROUNDS, DIMS, SCALE, SEED = 8, 10, 64, 1024, 3
BLOCK, CHUNK = 4, 4096
LARGEST = 1 << 27


def kept(vectors: DataFrame, key: str, vector: str, dims: int, scale: int) -> DataFrame:
    """id and v (integers) of the vectors that take part."""
    x = F.col(f"`{vector}`").cast("array<double>")
    whole = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) <= F.lit(LARGEST / scale)))
    good = vectors.select(F.col(f"`{key}`").alias("id"), x.alias("x")).where((F.size("x") == dims) & F.coalesce(whole, F.lit(False)))
    return good.select("id", F.transform("x", lambda c: F.floor(c * scale).cast("int")).alias("v"))


def encode(good: DataFrame, dims: int, block: int, chunk: int) -> DataFrame:
    """Rows of a chunk: ids, entries (a block's distinct subvectors, little-endian 32-bit
    integers) and codes (a block's place in them of each vector, 32-bit)."""
    kind = good.schema["id"].dataType

    def pack(ids, rows):
        entries, codes = [], []
        for a in range(0, dims, block):
            part = np.ascontiguousarray(rows[:, a:a + block])
            distinct, code = np.unique(part.view([("", part.dtype)] * part.shape[1]).ravel(), return_inverse=True)
            entries.append(distinct.tobytes())
            codes.append(code.astype("<u4").tobytes())
        return pa.RecordBatch.from_arrays(
            [pa.array([ids], pa.list_(ids.type)), pa.array([entries], pa.list_(pa.binary())), pa.array([codes], pa.list_(pa.binary()))],
            names=["ids", "entries", "codes"])

    def run(batches):
        waiting, rows = [], np.empty((0, dims), "<i4")
        for batch in batches:
            waiting.append(batch["id"])
            rows = np.vstack([rows, batch["v"].flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)])
            ids = pa.concat_arrays(waiting)
            full = len(ids) // chunk * chunk
            for a in range(0, full, chunk):
                yield pack(ids.slice(a, chunk), rows[a:a + chunk])
            waiting, rows = [ids.slice(full)], rows[full:]
        if len(rows):
            yield pack(pa.concat_arrays(waiting), rows)

    return good.mapInArrow(run, f"ids array<{kind.simpleString()}>, entries array<binary>, codes array<binary>")


def _subvectors(entries: list[bytes], dims: int, block: int):
    return [np.frombuffer(e, "<i4").reshape(-1, min(block, dims - a)).astype(np.int64)
            for a, e in zip(range(0, dims, block), entries, strict=True)]


def nearest(entries: list[bytes], codes: list[bytes], centroids: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """(cluster, squared distance) of a chunk's vectors; ties go to the smaller number."""
    dims, total = centroids.shape[1], None
    for a, sub, code in zip(range(0, dims, block), _subvectors(entries, dims, block), codes, strict=True):
        gap = sub[:, None, :] - centroids[None, :, a:a + sub.shape[1]]
        part = (gap * gap).sum(axis=2)[np.frombuffer(code, "<u4")]
        total = part if total is None else total + part
    cluster = total.argmin(axis=1)
    return cluster, total[np.arange(len(total)), cluster]


def _round(encoded: DataFrame, centroids: np.ndarray, block: int) -> np.ndarray:
    """The centroids after one assignment: the floor of each cluster's mean."""
    k, dims = centroids.shape

    def run(batches):
        # Components are below 2**27 and a task's share below 2**35 vectors.
        sums, counts = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            for entries, codes in zip(batch["entries"].to_pylist(), batch["codes"].to_pylist(), strict=True):
                cluster, _ = nearest(entries, codes, centroids, block)
                counts += np.bincount(cluster, minlength=k)
                for a, sub, code in zip(range(0, dims, block), _subvectors(entries, dims, block), codes, strict=True):
                    # how often each cluster holds each entry, times the entry
                    held = np.bincount(np.frombuffer(code, "<u4") * np.int64(k) + cluster, minlength=len(sub) * k)
                    sums[:, a:a + sub.shape[1]] += held.reshape(-1, k).T @ sub
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(counts[some]), pa.array(list(sums[some]), pa.list_(pa.int64()))],
                                         names=["cluster", "n", "s"])

    parts = encoded.mapInArrow(run, "cluster int, n long, s array<long>")
    by_place = parts.select("cluster", "n", F.posexplode("s").alias("d", "x")).groupBy("cluster", "d").agg(
        F.sum("n").alias("n"), F.sum(F.col("x").cast("decimal(38,0)")).alias("x"))
    out = centroids.copy()
    for r in by_place.collect():  # k * dims rows
        out[r["cluster"], r["d"]] = int(r["x"]) // r["n"]
    return out


def start(good: DataFrame, k: int, seed: int, dims: int) -> np.ndarray:
    """The k kept vectors with the smallest hashes of their ids."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    first = good.select(digest.alias("h"), "v").orderBy("h", "v").limit(k).collect()
    return np.array([r["v"] for r in first], np.int64).reshape(-1, dims)


def cluster(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = K, rounds: int = ROUNDS,
            dims: int = DIMS, scale: int = SCALE, seed: int = SEED, block: int = BLOCK, chunk: int = CHUNK) -> DataFrame:
    """key, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every kept vector."""
    spark = vectors.sparkSession
    good = kept(vectors, key, vector, dims, scale)
    kind = good.schema["id"].dataType.simpleString()
    encoded = materialize(encode(good, dims, block, chunk), "op13-encoded")
    centroids = start(good, k, seed, dims)
    for _ in range(rounds if len(centroids) else 0):
        new = _round(encoded, centroids, block)
        if (new == centroids).all():  # every later round gives the same
            break
        centroids = new

    def run(batches):
        for batch in batches:
            for ids, entries, codes in zip(batch["ids"], batch["entries"].to_pylist(), batch["codes"].to_pylist(), strict=True):
                at, distance = nearest(entries, codes, centroids, block)
                yield pa.RecordBatch.from_arrays([ids.values, pa.array(at, pa.int32()), pa.array(distance)], names=["id", "cluster", "distance"])

    assigned = materialize(encoded.mapInArrow(run, f"id {kind}, cluster int, distance long"), "op13-assigned")
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    total = sum((r["s"] for r in sums), Decimal(0))
    facts = [(r["cluster"], int(r["s"]), int(total), hashlib.sha256(",".join(map(str, centroids[r["cluster"]].tolist())).encode()).hexdigest())
             for r in sums]
    facts = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return (assigned.join(F.broadcast(facts), "cluster")  # one row a cluster
            .select(F.col("id").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"))


def _oracle(k: int = K, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, seed: int = SEED) -> str:
    parts = [rf"""WITH t AS MATERIALIZED (SELECT vec_id, [floor(x * {scale}.0)::BIGINT for x in e] AS v,
    sha256('{seed}:' || coalesce(vec_id::VARCHAR, '')) AS h, row_number() OVER () AS i FROM (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings) WHERE len(e) = {dims} AND len([x for x in e if x IS NOT NULL AND isfinite(x)]) = {dims}),
p AS MATERIALIZED (SELECT i, unnest(v) AS x, unnest(range({dims})) AS d FROM t),
c0 AS MATERIALIZED (SELECT c, unnest(v) AS x, unnest(range({dims})) AS d FROM (SELECT v, (row_number() OVER (ORDER BY h, v) - 1)::INTEGER AS c FROM t
  QUALIFY c < {k}))"""]
    for r in range(rounds + 1):
        parts.append(f"""a{r} AS MATERIALIZED (SELECT i, min_by(c, (s, c)) AS c, min(s) AS s FROM (
  SELECT p.i, c.c, sum((p.x - c.x) * (p.x - c.x))::BIGINT AS s FROM p JOIN c{r} c USING (d) GROUP BY 1, 2) GROUP BY i)""")
        if r < rounds:
            parts.append(f"""c{r + 1} AS MATERIALIZED (SELECT c.c, coalesce(n.x, c.x) AS x, c.d FROM c{r} c LEFT JOIN (
  SELECT a.c, p.d, (sum(p.x) - (sum(p.x) % count(*) + count(*)) % count(*)) // count(*) AS x FROM a{r} a JOIN p USING (i) GROUP BY 1, 2) n USING (c, d))""")
    return ",\n".join(parts) + f"""
SELECT vec_id, a.c AS cluster, a.s AS distance, (sum(a.s) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia, (sum(a.s) OVER ())::BIGINT AS inertia,
  sha256(g.g) AS centroid_sha256 FROM a{rounds} a JOIN t USING (i)
JOIN (SELECT c, string_agg(x::BIGINT::VARCHAR, ',' ORDER BY d) AS g FROM c{rounds} GROUP BY c) g ON g.c = a.c"""


ORACLE = _oracle()
