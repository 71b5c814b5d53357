"""Near-duplicate vectors by a subspace pigeonhole join (operator 6).

Two vectors link when their cosine is at least ``cos``: the unit vectors' squared
distance is at most ``e = 2 - 2 cos``. All are rotated onto the principal axes of the
table (their sums of products, one small matrix), and the axes are dealt into blocks
of about ``WIDTH`` dimensions. A block gets a part of ``e`` in proportion to its
variance. The parts add up to e, so a linked pair stays within the part of one block
at least: the union of the blocks' range joins has every link.

**Range join of a block.** Vectors fall into slabs along the block's first axis, as
wide as the block's radius, so partners are in the same or the next slab. A slab of
more than ``CHUNK`` vectors is split by hash into chunks, and each pair of chunks is a
group of its own: groups are bounded, whatever the number of vectors or copies. In a
group, vectors lie in cells of about ``CELL`` by quantiles of further axes. Two cells
whose boxes are farther apart than the block's part allows are skipped; for each other
pair, distances within the block come from a matrix product.

**Verification** is by cosine in double precision on the vectors as given. A verified
pair counts in one block only, that in which it takes the least of its part. A group
returns the number of links of each vector, and each vector's root within the group:
output is linear in its rows, however many pairs link.

Equal vectors are one node. What the method can't do: in many dimensions without
structure a block's radius is wide against the spread, so slabs skip little, and
distances within blocks grow with the square of the number of different vectors.

Defined cases: a vector that is null, zero, or holds null or non-finite components
links with nothing and is its own component; a shorter vector counts as followed by
zeros; repeated rows link with one another; a null id names no component unless all
are null and is never kept; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricewise.llm.common import components, materialize
from pricewise.llm.ragged import U64, mix

COS = 0.9
WIDTH = 16
CHUNK = 1 << 14
CELL = 128
SLACK = 1e-5  # of float32 products, on the filter's side


def _matrix(col, dim: int) -> np.ndarray:
    """The lists of an Arrow column as rows of doubles, short ones filled with zeros."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    flat, size = col.flatten().to_numpy(zero_copy_only=False), col.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(col), dim))
    at = np.r_[0, np.cumsum(size)]
    out[np.repeat(np.arange(len(col)), size), np.arange(at[-1]) - np.repeat(at[:-1], size)] = flat
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # squares stay in range
    return x / np.linalg.norm(x, axis=1, keepdims=True)


class Blocks:
    """Rotation, blocks of axes, and each block's part of the squared distance."""

    def __init__(self, products: np.ndarray, cos: float):
        dim = len(products)
        values, axes = np.linalg.eigh(products)
        order = np.argsort(-values)
        m = max(1, dim // WIDTH)
        # dealt like cards, back and forth, so that blocks have like variance
        turn = np.arange(dim) // m
        block = np.where(turn % 2 == 0, np.arange(dim) % m, m - 1 - np.arange(dim) % m)
        self.axes = [axes[:, order[block == b]] for b in range(m)]
        share = np.array([np.maximum(values[order[block == b]], 0).sum() for b in range(m)]) + 1e-9
        self.budget = (2 - 2 * cos) * share / share.sum()
        self.cos, self.dim = cos, dim

    def slab(self, b: int, x: np.ndarray) -> np.ndarray:
        return np.floor(x @ self.axes[b][:, 0] / (np.sqrt(self.budget[b]) * 1.001 + 1e-6)).astype(np.int64)

    def owner(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The block in which each pair takes the least of the block's part."""
        d = x - y
        return np.stack([((d @ a) ** 2).sum(axis=1) / part for a, part in zip(self.axes, self.budget)]).argmin(axis=0)


def _products(vectors: DataFrame, dim: int) -> np.ndarray:
    def run(batches):
        total = np.zeros((dim, dim))
        for b in batches:
            x = _unit(_matrix(b.column("vec"), dim))
            total += x.T @ x
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel()), pa.array(j.ravel()), pa.array(total.ravel())], names=["i", "j", "v"])

    out = np.zeros((dim, dim))
    sums = vectors.select("vec").mapInArrow(run, "i long, j long, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    for i, j, v in sums.toPandas().itertuples(index=False):  # dim * dim numbers
        out[i, j] = v
    return (out + out.T) / 2


def _roots(n: int, u: np.ndarray, v: np.ndarray, root: np.ndarray) -> np.ndarray:
    """Smallest index reachable, by links (u, v) on top of those in ``root``."""
    while True:
        low = np.minimum(root[u], root[v])
        new = root.copy()
        for side in (u, v):
            np.minimum.at(new, side, low)
            np.minimum.at(new, root[side], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _deal(vectors: DataFrame, blocks: Blocks) -> DataFrame:
    """A row for each group that a vector takes part in."""
    held = vectors.sparkSession.sparkContext.broadcast(blocks)

    def count(batches):
        total: dict[tuple[int, int], int] = {}
        for batch in batches:
            x = _unit(_matrix(batch.column("vec"), held.value.dim))
            for b in range(len(held.value.axes)):
                for s, n in zip(*np.unique(held.value.slab(b, x), return_counts=True)):
                    total[b, int(s)] = total.get((b, int(s)), 0) + int(n)
        if total:
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in total]), pa.array([k[1] for k in total]),
                                              pa.array(list(total.values()))], names=["block", "slab", "n"])

    counts = vectors.select("vec").mapInArrow(count, "block long, slab long, n long") \
        .groupBy("block", "slab").agg(F.sum("n").alias("n")).collect()  # a few slabs a block, by the radius
    chunks = {(r["block"], r["slab"]): -(-r["n"] // CHUNK) for r in counts}
    vec_type = vectors.schema["vec"].dataType
    schema = T.StructType([*(T.StructField(c, T.LongType()) for c in ("block", "slab", "i", "other", "j", "side")),
                           T.StructField("node", T.LongType()), T.StructField("copies", T.LongType()), T.StructField("vec", vec_type)])

    def run(batches):
        for batch in batches:
            x = _unit(_matrix(batch.column("vec"), held.value.dim))
            salt = mix(batch.column("node").to_numpy().astype(U64))
            for b in range(len(held.value.axes)):
                slabs = held.value.slab(b, x)
                for s in np.unique(slabs).tolist():
                    rows = np.flatnonzero(slabs == s)
                    mine = chunks[b, s]
                    own = (salt[rows] % U64(mine)).astype(np.int64)
                    for c in range(mine):
                        at = rows[own == c]
                        if not len(at):
                            continue
                        part = batch.take(pa.array(at))
                        to = [(s, c, s, j, 0) for j in range(c, mine)] + [(s, i, s, c, 1) for i in range(c)]
                        to += [(s, c, s + 1, j, 0) for j in range(chunks.get((b, s + 1), 0))]
                        to += [(s - 1, i, s, c, 1) for i in range(chunks.get((b, s - 1), 0))]
                        for key in to:
                            yield pa.RecordBatch.from_arrays(
                                [*(pa.array(np.full(len(at), k)) for k in (b, *key)),
                                 part.column("node"), part.column("copies"), part.column("vec")], names=schema.names)

    return vectors.select("node", "copies", "vec").mapInArrow(run, schema)


def _cells(z: np.ndarray, rows: np.ndarray) -> list[np.ndarray]:
    """The rows in cells of about ``CELL``, by quantiles of the block's axes after the first
    (on which a group is narrow already), most on the second."""
    axes, out = [k % z.shape[1] for k in (1, 2, 3)], [rows]
    want = len(rows) / CELL
    for k, axis in enumerate(axes):
        parts = max(1, round((want / max(1, len(out))) ** (1 / 2 if k < 2 else 1)))
        out = [part for cell in out for part in np.array_split(cell[np.argsort(z[cell, axis], kind="stable")], parts) if len(part)]
    return out


def _join(blocks: Blocks, t: pa.Table) -> pa.Table:
    """Links of one pair of chunks: (node, links, root) of the vectors that have any."""
    b, side = t.column("block")[0].as_py(), t.column("side").to_numpy()
    whole = (t.column("slab")[0].as_py(), t.column("i")[0].as_py()) == (t.column("other")[0].as_py(), t.column("j")[0].as_py())
    node, copies = t.column("node").to_numpy(), t.column("copies").to_numpy()
    x = _unit(_matrix(t.column("vec"), blocks.dim))
    first = np.flatnonzero(side == 0)
    second = first if whole else np.flatnonzero(side == 1)
    z = x @ blocks.axes[b]
    square = (z ** 2).sum(axis=1, keepdims=True)
    one = np.ones_like(square)
    left = np.hstack([-2 * z, square, one]).astype(np.float32)
    right = np.hstack([z, one, square]).astype(np.float32)
    links, root = np.zeros(len(node), np.int64), np.arange(len(node))
    most = blocks.budget[b] + SLACK
    cells = _cells(z, first)
    others = cells if whole else _cells(z, second)
    low, high = (np.array([f(z[c], axis=0) for c in others]) for f in (np.min, np.max))
    for i, cell in enumerate(cells):
        gap = np.maximum(np.maximum(low - z[cell].max(axis=0), z[cell].min(axis=0) - high), 0)
        near = np.flatnonzero((gap ** 2).sum(axis=1) <= most)
        if whole:
            near = near[near >= i]  # the cell itself first
        if not len(near):
            continue
        rows = np.concatenate([others[j] for j in near])
        u, v = np.nonzero(left[cell] @ right[rows].T <= np.float32(most))
        if whole:
            once = (v >= len(cell)) | (u < v)
            u, v = u[once], v[once]
        u, v = cell[u], rows[v]
        for k in range(0, len(u), 1 << 18):
            p, q = u[k:k + (1 << 18)], v[k:k + (1 << 18)]
            good = np.einsum("ij,ij->i", x[p], x[q]) >= blocks.cos
            p, q = p[good], q[good]
            mine = blocks.owner(x[p], x[q]) == b
            p, q = p[mine], q[mine]
            links += np.bincount(p, copies[q], len(node)).astype(np.int64) + np.bincount(q, copies[p], len(node)).astype(np.int64)
            if len(p):
                root = _roots(len(node), p, q, root)
    some = links > 0
    return pa.table({"node": node[some], "links": links[some], "root": node[root[some]]})


def near_vectors(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", cos: float = COS) -> DataFrame:
    """Per row: the id, n_links, component_id, kept."""
    vec = F.col("vec")
    rows = table.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec"))
    fine = F.coalesce(F.forall(vec, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(vec, lambda v: v != 0),
                      F.lit(False))
    rows = rows.withColumn("node", F.when(fine, F.xxhash64("vec")))
    nodes = materialize(rows.where("node IS NOT NULL").groupBy("node").agg(
        F.count("*").alias("copies"), F.min("id").alias("low"), F.first("vec").alias("vec")), "vectors")
    dim = nodes.agg(F.max(F.size("vec"))).first()[0]
    if dim is None:
        return rows.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"),
                           F.col("id").isNotNull().alias("kept"))
    blocks = Blocks(_products(nodes, dim), cos)
    held = table.sparkSession.sparkContext.broadcast(blocks)
    found = materialize(_deal(nodes, blocks).groupBy("block", "slab", "i", "other", "j")
                        .applyInArrow(lambda t: _join(held.value, t), "node long, links long, root long"), "links")
    roots = components(found.selectExpr("node AS a", "root AS b"))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    placed = nodes.select("node", "copies", "low").join(links, "node", "left") \
        .join(roots.withColumnRenamed("root", "to"), "node", "left") \
        .select("node", "low", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("to", "node").alias("root"))
    placed = materialize(placed, "placed")
    head = placed.groupBy("root").agg(F.min("low").alias("component_id"))
    known = placed.join(head, "root").select("node", "n_links", "component_id")
    alone = rows.where("node IS NULL").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return rows.where("node IS NOT NULL").select("id", "node").join(known, "node").select("id", "n_links", "component_id") \
        .unionByName(alone).select(F.col("id").alias(id_col), "n_links", "component_id",
                                   F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))
