"""Embedding near-duplicates by int8 quantised tile products.

A unit vector x is stored as int8 codes q with a scale s; e = |x - s q| is its own
quantisation error, computed exactly. For two vectors

    |x.y - s_x s_y q_x.q_y| <= e_x + e_y + 3 e_x e_y,

so a tile product of codes settles every pair whose approximate cosine lies
further from the threshold than that; only the others are computed again in double
precision. Products of codes are whole numbers below 2**24 for up to 1,040
dimensions, so float32 matrix products hold them exactly (float64 beyond).

Equal vectors are one node from the start. The nodes are dealt by hash into groups
of about ``GROUP``, and each unordered pair of groups is one task of bounded size
whatever the data. A task returns one row for each of its vectors that has links: how many
vectors it links with, and the root of its class there, never the pairs.
Components follow by star contraction. No exact method can skip groups of
unstructured vectors, so the multiplications (not the memory of a task) grow with the
square of the distinct vectors.

Defined results: vectors that are null, zero or hold null, NaN or infinite
components link with nothing; vectors of different lengths don't link; repeated
rows are vectors of their own. A null id never names a component that has another
id; a component of null ids only has a null name and its rows are kept. Other
columns aren't read; empty tables give empty results.

Vectors travel in their own type (32-bit floats where the table has those), not as codes: pairs that the
bound leaves open are settled where the codes meet. Sent elsewhere, they would be as many as a
dense cluster has pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.components import components
from corpusmill.llm.kernels import forest
from corpusmill.plans.lineage import cut

THRESHOLD = 0.95
GROUP = 13_000
#: Groups stay at ``GROUP`` vectors while there are few, then grow to this many, so that each vector travels less often.
MAX_GROUP = 65_536
FEW_GROUPS = 8
TILE = 1024
#: Stands for the id of a node whose rows all have a null id; above all ids.
NAMELESS = 1 << 62


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes, scales, and a bound of each unit vector's quantisation error."""
    scale = np.abs(x).max(axis=1) / 127
    codes = np.rint(x / scale[:, None]).astype(np.int8)
    error = np.linalg.norm(x - scale[:, None] * codes, axis=1)
    return codes, scale, error * (1 + 1e-9) + 1e-12


def near_pairs(x: np.ndarray, y: np.ndarray | None, threshold: float):
    """Pairs (i, j) of unit vectors with a cosine of at least the threshold; i < j within x if y is None."""
    same = y is None
    y = x if same else y
    kind = np.float32 if x.shape[1] <= 1040 else np.float64
    qx, sx, ex = quantise(x)
    qy, sy, ey = (qx, sx, ex) if same else quantise(y)
    out_i, out_j = [], []
    for a in range(0, len(x), TILE):
        left = qx[a : a + TILE].astype(kind)
        for b in range(a if same else 0, len(y), TILE):
            right = slice(b, b + TILE)
            product = left @ qy[right].astype(kind).T
            top_x, top_y = ex[a : a + TILE].max(), ey[right].max()
            least = threshold - (top_x + top_y + 3 * top_x * top_y) - 1e-9
            bar = (least / (sx[a : a + TILE] * sy[right].max()) * (1 - 1e-6)).astype(kind) if least > 0 else np.full(len(left), -np.inf, kind)
            i, j = np.divmod(np.flatnonzero(product >= bar[:, None]), product.shape[1])
            about = product[i, j].astype(np.float64) * sx[a + i] * sy[b + j]
            slack = ex[a + i] + ey[b + j] + 3 * ex[a + i] * ey[b + j] + 1e-9
            open_ = (about + slack >= threshold) & ((a + i < b + j) if same else True)
            i, j = a + i[open_], b + j[open_]
            for k in range(0, len(i), 1 << 16):
                p, q = i[k : k + (1 << 16)], j[k : k + (1 << 16)]
                good = np.einsum("ij,ij->i", x[p], y[q]) >= threshold
                out_i.append(p[good])
                out_j.append(q[good])
            if len(out_i) > 64:
                yield np.concatenate(out_i), np.concatenate(out_j)
                out_i, out_j = [], []
    if out_i:
        yield np.concatenate(out_i), np.concatenate(out_j)


def link_vectors(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD, group: int = GROUP) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row."""
    spark = vectors.sparkSession
    kind = vectors.schema[vector].dataType.simpleString()
    rows = vectors.select(F.col(f"`{key}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").cast(kind if kind == "array<float>" else "array<double>").alias("v"))
    number = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    fine = F.col("v").isNotNull() & F.forall("v", number) & F.exists("v", lambda c: c != 0)
    nodes = rows.where(fine).groupBy("v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"))
    nodes = cut(nodes.withColumn("rep", F.coalesce("rep", F.lit(NAMELESS) + F.monotonically_increasing_id())))
    count = nodes.count()
    groups = max(1, min(-(-count // group), FEW_GROUPS), -(-count // max(group, MAX_GROUP)))

    own = F.pmod(F.xxhash64("rep"), F.lit(groups)).cast("int")
    pairs = nodes.withColumn("g", own).withColumn("h", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    pairs = pairs.select("rep", "n", "v", "g", F.struct(F.least("g", "h").alias("a"), F.greatest("g", "h").alias("b")).alias("task"))

    def tile(table: pa.Table) -> pa.Table:
        rep, n, g = (table[c].to_numpy() for c in ("rep", "n", "g"))
        lists = table["v"].combine_chunks()
        lists = pa.concat_arrays(lists.chunks) if isinstance(lists, pa.ChunkedArray) else lists
        length, flat, a = lists.value_lengths().to_numpy(), lists.flatten().to_numpy().astype(np.float64), table["task"][0].as_py()["a"]
        begin = np.cumsum(length) - length
        links, left, right = np.zeros(len(rep), np.int64), [], []
        for d in np.unique(length):
            of = np.flatnonzero(length == d)
            x = flat[begin[of][:, None] + np.arange(d)]
            x = x / np.abs(x).max(axis=1, keepdims=True)  # so that no square overflows
            x = x / np.linalg.norm(x, axis=1, keepdims=True)
            first, second = np.flatnonzero(g[of] == a), np.flatnonzero(g[of] != a)
            one = not (g != a).any() and table["task"][0].as_py()["b"] == a
            if not one and not (len(first) and len(second)):
                continue
            for i, j in near_pairs(x, None, threshold) if one else near_pairs(x[first], x[second], threshold):
                i, j = (of[i], of[j]) if one else (of[first[i]], of[second[j]])
                np.add.at(links, i, n[j])
                np.add.at(links, j, n[i])
                p, q = forest(rep[i], rep[j])
                left.append(p)
                right.append(q)
        root = rep.copy()
        if left:
            p, q = forest(np.concatenate(left), np.concatenate(right))
            order = np.argsort(rep)
            root[order[np.searchsorted(rep[order], p)]] = q
        hit = np.flatnonzero(links)
        return pa.table({"rep": rep[hit], "links": links[hit], "root": root[hit]})

    tiles = cut(pairs.groupBy("task").applyInArrow(tile, "rep long, links long, root long"))
    of = components(tiles.where("rep <> root"), "rep", "root").withColumnRenamed("id", "rep")
    stats = tiles.groupBy("rep").agg(F.sum("links").alias("links")).join(of, "rep", "left")
    found = nodes.join(stats, "rep", "left").select(F.col("v").alias("w"), "rep", "n", "links", "component_id")
    out = rows.withColumn("fine", F.coalesce(fine, F.lit(False))).join(found, F.col("fine") & (F.col("v") == F.col("w")), "left")
    component = F.coalesce("component_id", "rep", "vec_id")
    component = F.when(component < NAMELESS, component)
    return out.select("vec_id", (F.coalesce("links", F.lit(0)) + F.coalesce(F.col("n") - 1, F.lit(0))).alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))


def op3_int8_tiles(spark, sf_dir: str) -> DataFrame:
    return link_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


ORACLE_SQL = f"""
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= {THRESHOLD}),
r AS (SELECT vec_id AS x, vec_id AS y FROM v UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x)
SELECT v.vec_id, coalesce(n, 0) AS n_links, c AS component_id, v.vec_id = c AS kept
FROM v LEFT JOIN (SELECT x, count(*) AS n FROM l GROUP BY x) k ON v.vec_id = k.x JOIN (SELECT x, min(y) AS c FROM r GROUP BY x) m ON v.vec_id = m.x
"""
