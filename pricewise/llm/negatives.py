"""Hard negatives by exact integer scores (operator 13).

Components become integers, ``floor(scale * x)``; a score is an inner product of
integers, exact at any size that fits a long.

**Residue number system.** The integer matrices are reduced modulo several primes below
512, to residues around zero, and multiplied in float32: over ``SPAN`` components every
partial sum is an integer below 2**24, so float32 is exact. There are as many primes as
it takes for their product to exceed twice the largest possible score. The signed score
comes back from its residues by Chinese remaindering in mixed radix, with digits around
zero (Garner).

**Grid.** Anchors and rows fall into chunks by hash, of about ``ANCHORS`` and ``ROWS``;
each pair of chunks is a group, bounded whatever the labels or copies, and is worked on
in tiles. Every anchor meets every row once in each of two steps:

1. *Positives.* In a group, only rows of the anchor's label are scored; a group returns
   at most ``positives`` rows an anchor, and a window over these picks the best.
2. *Negatives.* An anchor carries the score windows of its positives. A tile keeps the
   scores of other labels that fall into any of them, sorted; each window takes its
   first rows there, and a window over all groups the first of these.

Defined cases: rows with a null label, a null vector, a null or non-finite component,
or a squared length (in integers) of 2**62 or more, whose scores need not fit a long,
take no part; a shorter vector counts as followed by zeros; a null id is no anchor and
comes last in a tie; repeated rows are rows of their own, "other rows" to one another;
anchors without positives, and positives without negatives, have no rows; extra columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricewise.llm.common import materialize

ANCHORS = 1 << 13
ROWS = 1 << 13
TILE = 1 << 21  # scores held at once
SPAN = 256  # components in a float32 product: 256 * 255**2 < 2**24
NONE = np.iinfo(np.int64).min


def primes(bound: int) -> list[int]:
    """The largest primes below 512, as many as tell scores from -bound to bound apart."""
    out, product = [], 1
    for p in range(511, 2, -2):
        if all(p % q for q in range(3, math.isqrt(p) + 1, 2)):
            if product > 2 * bound:
                break
            out.append(p)
            product *= p
    return out or [511]


def _centred(x: np.ndarray, p: int) -> np.ndarray:
    """``x`` modulo ``p``, from -(p - 1) / 2 to (p - 1) / 2."""
    half = (p - 1) // 2
    y = x + half
    return y - y // p * p - half


class Residues:
    """Residue matrices of integer rows, for products of rows."""

    def __init__(self, x: np.ndarray, moduli: list[int]):
        self.moduli = moduli
        self.parts = [_centred(x, p).astype(np.float32) for p in moduli]

    def at(self, rows) -> Residues:
        out = Residues.__new__(Residues)
        out.moduli, out.parts = self.moduli, [m[rows] for m in self.parts]
        return out

    def scores(self, other: Residues) -> np.ndarray:
        """The exact inner products of all rows with all of ``other``."""
        value, radix = None, 1
        for p, a, b in zip(self.moduli, self.parts, other.parts):
            rest = sum((a[:, k:k + SPAN] @ b[:, k:k + SPAN].T).astype(np.int64) for k in range(0, a.shape[1], SPAN))
            if value is None:
                value = _centred(rest, p)
            else:
                value = value + _centred((rest - value) % p * pow(radix, -1, p), p) * radix
            radix *= p
        return value


def integers(col, dim: int, scale: int) -> np.ndarray:
    """floor(scale * x) of the lists of an Arrow column, short ones filled with zeros."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    flat, size = col.flatten().to_numpy(zero_copy_only=False), col.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(col), max(dim, 1)), np.int64)
    at = np.r_[0, np.cumsum(size)].astype(np.int64)
    out[np.repeat(np.arange(len(col)), size), np.arange(at[-1]) - np.repeat(at[:-1], size)] = np.floor(flat.astype(float) * scale)
    return out


def _by_id(t: pa.Table) -> pa.Table:
    return t.sort_by([("id", "ascending"), ("row", "ascending")])  # nulls last


def _column(t: pa.Table, name: str) -> np.ndarray:
    return t.column(name).to_numpy()


def _steps(n: int, width: int):
    step = max(1, TILE // max(1, width))
    return ((k, min(n, k + step)) for k in range(0, n, step))


class Miner:
    """What a group of the grid does; sent to the tasks."""

    def __init__(self, moduli: list[int], dim: int, scale: int, n_positives: int, n_negatives: int, low: int, high: int):
        self.moduli, self.dim, self.scale = moduli, dim, scale
        self.n_positives, self.n_negatives, self.low, self.high = n_positives, n_negatives, low, high

    def _residues(self, t: pa.Table) -> Residues:
        return Residues(integers(t.column("vec"), self.dim, self.scale), self.moduli)

    def best(self, anchors: pa.Table, rows: pa.Table) -> pa.Table:
        """The best rows of its own label of each anchor, among these rows."""
        rows = _by_id(rows)
        x, y = self._residues(anchors), self._residues(rows)
        a_label, r_label, a_row, r_row = _column(anchors, "label"), _column(rows, "label"), _column(anchors, "row"), _column(rows, "row")
        found = [[], [], []]
        for label in np.unique(a_label):
            mine, same = np.flatnonzero(a_label == label), np.flatnonzero(r_label == label)
            if not len(same):
                continue
            right = y.at(same)
            for i, j in _steps(len(mine), len(same)):
                at = mine[i:j]
                score = x.at(at).scores(right)
                score[a_row[at][:, None] == r_row[same]] = NONE
                for _ in range(min(self.n_positives, len(same))):
                    pick = score.argmax(axis=1)  # the first of equals: the smallest id
                    top = score[np.arange(len(at)), pick]
                    some = top > NONE
                    found[0].append(at[some])
                    found[1].append(same[pick[some]])
                    found[2].append(top[some])
                    score[np.arange(len(at)), pick] = NONE
        a, r, score = (np.concatenate(f).astype(np.int64) if f else np.zeros(0, np.int64) for f in found)
        return pa.table({"anchor": pa.array(a_row[a]), "anchor_id": anchors.column("id").take(pa.array(a)),
                         "other": pa.array(r_row[r]), "other_id": rows.column("id").take(pa.array(r)), "score": pa.array(score)})

    def window(self, positive: int) -> tuple[int, int]:
        """Least and largest score n with low * positive <= 100 * n <= high * positive."""
        return -(-self.low * positive // 100), self.high * positive // 100

    def inside(self, anchors: pa.Table, rows: pa.Table) -> pa.Table:
        """The first rows of another label in the window of each positive."""
        rows = _by_id(rows)
        x, y = self._residues(anchors), self._residues(rows)
        a_label, r_label = _column(anchors, "label"), _column(rows, "label")
        held = anchors.column("positives").to_pylist()
        windows = [[self.window(p["score"]) for p in ps] for ps in held]
        least = np.array([min(lo for lo, _ in w) for w in windows], np.int64)
        most = np.array([max(hi for _, hi in w) for w in windows], np.int64)
        found = []
        for i, j in _steps(len(held), rows.num_rows):
            score = x.at(slice(i, j)).scores(y)
            fits = (score >= least[i:j, None]) & (score <= most[i:j, None]) & (a_label[i:j, None] != r_label)
            a, r = np.nonzero(fits)
            s = score[a, r]
            order = np.lexsort((r, -s, a))
            a, r, s = a[order], r[order], s[order]
            ends = np.searchsorted(a, np.arange(j - i + 1))
            for k in np.flatnonzero(np.diff(ends)).tolist():
                u, v = ends[k], ends[k + 1]
                falling = -s[u:v]
                for n, (lo, hi) in enumerate(windows[i + k]):
                    first = u + int(np.searchsorted(falling, -hi, side="left"))
                    last = u + int(np.searchsorted(falling, -lo, side="right"))
                    found += [(i + k, n, int(r[q]), int(s[q])) for q in range(first, min(last, first + self.n_negatives))]
        rank = [held[a][n] for a, n, _, _ in found]
        at = pa.array([f[0] for f in found], pa.int64())
        return pa.table({"anchor": anchors.column("row").take(at), "anchor_id": anchors.column("id").take(at),
                         "positive": pa.array([p["other"] for p in rank], pa.int64()),
                         "positive_id": pa.array([p["other_id"] for p in rank], pa.int64()),
                         "positive_score": pa.array([p["score"] for p in rank], pa.int64()),
                         "negative": rows.column("row").take(pa.array([f[2] for f in found], pa.int64())),
                         "negative_id": rows.column("id").take(pa.array([f[2] for f in found], pa.int64())),
                         "negative_score": pa.array([f[3] for f in found], pa.int64())})


def mine(table: DataFrame, anchor: Column, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
         n_positives: int = 5, n_negatives: int = 3, low: int = 50, high: int = 95, scale: int = 256,
         anchor_chunk: int = ANCHORS, row_chunk: int = ROWS) -> DataFrame:
    """For each anchor (a condition on the table's columns) and each of its positives:
    anchor_id, positive_id, rank, negative_id, positive_score, negative_score. Ids are
    longs."""
    vec = F.col("vec")
    plain = table.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"), F.col(label_col).cast("long").alias("label"),
                         F.coalesce(anchor, F.lit(False)).alias("is_anchor"))
    fine = F.forall(vec, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    square = F.aggregate(vec, F.lit(0.0), lambda acc, v: acc + F.pow(F.floor(v.cast("double") * scale).cast("double"), F.lit(2.0)))
    rows = plain.where(F.col("label").isNotNull() & F.coalesce(fine, F.lit(False))) \
        .withColumn("square", square).where(F.col("square") < float(2 ** 62))
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
    n, n_anchors, dim, widest = rows.agg(F.count("*"), F.count_if("is_anchor"), F.max(F.size("vec")), F.max("square")).first()
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not n_anchors:
        return table.sparkSession.createDataFrame([], schema)
    miner = Miner(primes(int(widest * 1.000001) + 1), dim, scale, n_positives, n_negatives, low, high)
    held = table.sparkSession.sparkContext.broadcast(miner)
    across, down = -(-n_anchors // anchor_chunk), -(-n // row_chunk)
    chunk = lambda k: F.pmod(F.xxhash64("row"), F.lit(k))
    every = lambda k: F.explode(F.expr(f"sequence(0L, {k - 1}L)"))
    anchors = rows.where("is_anchor").withColumn("i", chunk(across)).withColumn("j", every(down))
    # as columns of their own: a cogroup takes those of the anchors' side for the same
    right = rows.select(*(F.col(c).alias(c) for c in ("row", "id", "vec", "label")), chunk(down).alias("j"), every(across).alias("i"))
    best = anchors.select("i", "j", "row", "id", "vec", "label").groupBy("i", "j").cogroup(right.groupBy("i", "j")) \
        .applyInArrow(lambda a, r: held.value.best(a, r), "anchor long, anchor_id long, other long, other_id long, score long")
    place = Window.partitionBy("anchor").orderBy(F.desc("score"), F.asc_nulls_last("other_id"), "other")
    best = best.withColumn("place", F.row_number().over(place)).where(F.col("place") <= n_positives) \
        .groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("place", "other", "other_id", "score"))).alias("positives"))
    best = materialize(best, "positives")
    left = anchors.join(best, F.col("row") == F.col("anchor")).select("i", "j", "row", "id", "vec", "label", "positives")
    found = left.groupBy("i", "j").cogroup(right.groupBy("i", "j")).applyInArrow(
        lambda a, r: held.value.inside(a, r), "anchor long, anchor_id long, positive long, positive_id long, positive_score long, "
                                              "negative long, negative_id long, negative_score long")
    place = Window.partitionBy("anchor", "positive").orderBy(F.desc("negative_score"), F.asc_nulls_last("negative_id"), "negative")
    return found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= n_negatives) \
        .select(*(c.split()[0] for c in schema.split(", ")))


#: On the table as it is, with every anchor against every row.
ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
    CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
  other_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same
  AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""
