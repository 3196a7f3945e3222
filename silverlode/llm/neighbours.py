"""Approximate nearest neighbours by inner product over shifted Hilbert orderings.

Vectors are dealt into bands of similar norm, in which the inner product orders nearly as
the direction does. Directions are projected on ``CURVES`` random bases of ``DIMS``
directions. Each projection is shifted and ordered along a Hilbert curve, and each ordering
is cut into ranges of equal counts, band by band. A query meets, in every band, all vectors
of its own and of the two neighbouring ranges on every curve; what the curves find is merged
and ranked by the exact product of the original vectors. Ranges are dealt out in blocks of
bounded size.

Equal vectors form one class, which takes part once and is expanded to ids at the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from silverlode.llm.common import picked
from silverlode.session import stage

K = 20
CURVES = 20
DIMS = 6
BITS = 10
#: Ranges of a curve at most, and the vectors a range has at least. A range holds 1/40 of
#: the vectors, so that the recall does not fall as the table grows.
RANGES, RANGE_LEAST = 40, 256
#: The longest norm of a band is at most so many times its shortest.
NORM_RATIO = 1.5
#: Vectors and queries of one block.
BLOCK, QUERY_BLOCK = 4096, 1024
SEED = 11
GROUP = ("band", "curve", "place", "block", "query_block")


def hilbert(x: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of points x (rows, dims) in [0, 2**bits) (Skilling 2004)."""
    one = np.uint64(1)
    x = x.astype(np.uint64).T.copy()
    d = len(x)
    q = np.uint64(1 << (bits - 1))
    while q > one:
        p = q - one
        for i in range(d):
            turned = (x[i] & q) != 0
            t = np.where(turned, np.uint64(0), (x[0] ^ x[i]) & p)
            x[i] ^= t
            x[0] = np.where(turned, x[0] ^ p, x[0] ^ t)
        q >>= one
    for i in range(1, d):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = np.uint64(1 << (bits - 1))
    while q > one:
        t = np.where((x[d - 1] & q) != 0, t ^ (q - one), t)
        q >>= one
    x ^= t
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            out = (out << one) | ((x[i] >> np.uint64(b)) & one)
    return out.astype(np.int64)


def curve_codes(points: np.ndarray) -> np.ndarray:
    """(rows, CURVES) places of unit vectors on every curve; the bases depend on the seed and the width only."""
    width = points.shape[1]
    rng = np.random.default_rng([SEED, width])
    out = np.empty((len(points), CURVES), np.int64)
    top = (1 << BITS) - 1
    for c in range(CURVES):
        basis, _ = np.linalg.qr(rng.normal(size=(width, min(DIMS, width))))
        shift = rng.random(basis.shape[1])
        # nearly all coordinates of a random direction lie within four standard deviations
        flat = np.clip(points @ basis * np.sqrt(width) / 4, -1, 1)
        out[:, c] = hilbert(((flat + 1) / 2 + shift) / 2 * top, BITS)
    return out


def directions(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors, with a last coordinate of 0."""
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)
    return np.hstack([scaled / np.linalg.norm(scaled, axis=1, keepdims=True), np.zeros((len(vectors), 1))])


def matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(len(column), -1)


def best_of(q: np.ndarray, v: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, vector row, score) of the k best vectors of each query, ties to the smaller id.

    The matrix product selects; the scores are summed pair by pair, so that a pair has
    the same score in every block.
    """
    rough = q @ v.T
    if rough.shape[1] > k:
        least = -np.partition(-rough, k - 1, axis=1)[:, k - 1] - 1e-9 * np.abs(rough).max(1)
        i, j = np.nonzero(rough >= least[:, None])
    else:
        i, j = (x.ravel() for x in np.indices(rough.shape))
    s = (q[i] * v[j]).sum(1)
    order = np.lexsort((ids[j], -s, i))
    i, j, s = i[order], j[order], s[order]
    first = np.searchsorted(i, i)  # equal-score rows beyond k are cut after sorting
    keep = np.arange(len(i)) - first < k
    return i[keep], j[keep], s[keep]


def nearest(df: DataFrame, k: int = K, every: int = 20, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of each row whose id ``every`` divides.

    Vectors that are NULL, empty, zero or hold NULL or non-finite parts, and rows with a
    NULL id, take no part. Vectors of different lengths do not meet. Repeated vectors
    are candidates of their own; a repeated id counts once, under its smallest vector.
    """
    spark = df.sparkSession
    v = F.col("vec")
    rows = picked(df, vec_id=key, vec=vector).where("vec_id is not null and vec is not null and size(vec) > 0").withColumn("vec", v.cast("array<double>"))
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = rows.where(fine).withColumn("h1", F.xxhash64("vec")).withColumn("h2", F.xxhash64(F.lit(1), v))
    rows = stage(rows.groupBy("vec_id").agg(F.min(F.struct("h1", "h2", "vec")).alias("r")).select("vec_id", "r.*"), "vectors")

    same = Window.partitionBy("h1", "h2").orderBy("vec_id")
    few = rows.withColumn("at", F.row_number().over(same)).where(F.col("at") <= k + 1)
    classes = few.groupBy("h1", "h2").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"), F.first("vec").alias("vec"))
    asked = rows.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "h1", "h2")
    flags = asked.select("h1", "h2").distinct().withColumn("asks", F.lit(True))
    classes = classes.join(flags, ["h1", "h2"], "left").select("h1", "h2", F.col("ids")[0].alias("cid"), "ids", "vec", F.coalesce("asks", F.lit(False)).alias("asks"))
    # logarithm of the norm, without overflow
    top = F.array_max(F.transform(v, F.abs))
    norm = F.log(top) + F.log(F.aggregate(v, F.lit(0.0), lambda a, x: a + (x / top) * (x / top))) / 2
    classes = stage(classes.withColumn("norm", norm), "classes")
    longest = classes.groupBy(F.size("vec").alias("width")).agg(F.max("norm").alias("longest"))
    step = F.floor((F.col("longest") - F.col("norm")) / float(np.log(NORM_RATIO))).cast("int")
    stepped = classes.withColumn("width", F.size("vec")).join(F.broadcast(longest), "width").select("cid", "vec", "asks", step.alias("step"))
    # one row per vector length and step of the norm
    counts = sorted((r[0], r[1], r[2]) for r in stepped.groupBy(F.size("vec"), "step").count().collect())
    band_of = {(w, at): i for i, (w, at, _) in enumerate(counts)}
    bands: dict[int, list[int]] = {}
    for (w, _), i in band_of.items():
        bands.setdefault(w, []).append(i)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            width = np.asarray(pa.compute.list_value_length(b.column(1)))
            for w in np.unique(width):
                t = b.filter(pa.array(width == w))
                code = curve_codes(directions(matrix(t.column(1))))
                band = [band_of[int(w), x] for x in t.column(3).to_pylist()]
                yield pa.RecordBatch.from_arrays([t.column(0), t.column(1), t.column(2), pa.array(band, pa.int32()), pa.array(list(code), pa.list_(pa.int64()))], ["cid", "vec", "asks", "band", "code"])

    codes = stage(stepped.mapInArrow(coded, "cid long, vec array<double>, asks boolean, band int, code array<long>"), "codes")
    # borders of the ranges: at most CURVES * RANGES numbers for each band; one range needs one curve
    ranges = [max(1, min(RANGES, n // RANGE_LEAST)) for _, _, n in counts]
    borders: list[np.ndarray] = []
    for i, n in enumerate(ranges):
        cuts = [x / n for x in range(1, n)]
        sorted_codes = codes.where(F.col("band") == i).select(F.posexplode("code").alias("curve", "at")).groupBy("curve")
        found = {r[0]: r[1] for r in sorted_codes.agg(F.percentile_approx("at", F.array(*map(F.lit, cuts)), 10_000)).collect()} if cuts else {}
        borders.append(np.array([found.get(c, []) for c in range(CURVES if cuts else 1)], np.int64).reshape(CURVES if cuts else 1, -1))

    def places(codes: np.ndarray, band: int) -> np.ndarray:
        return np.stack([np.searchsorted(cuts, codes[:, c], "right") for c, cuts in enumerate(borders[band])], 1)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            width, band, asks = (np.asarray(b.column(c)) for c in ("width", "band", "asks"))
            code = np.asarray(b.column("code").flatten()).reshape(b.num_rows, -1)
            for w in np.unique(width):
                for i in bands[int(w)]:
                    for side, of in ((0, band == i), (1, (width == w) & asks)):
                        if of.any():
                            s = sums.setdefault(i, np.zeros((2, len(borders[i]), ranges[i]), np.int64))
                            for c, p in enumerate(places(code[of], i).T):
                                s[side, c] += np.bincount(p, minlength=ranges[i])
        for i, s in sums.items():
            c, r = (x.ravel() for x in np.indices(s.shape[1:]))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(c), i), pa.int32()), pa.array(c, pa.int32()), pa.array(r, pa.int32()), pa.array(s[0].ravel()), pa.array(s[1].ravel())], ["band", "curve", "place", "n", "q"])

    tally = codes.select(F.size("vec").alias("width"), "band", "code", "asks").mapInArrow(counted, "band int, curve int, place int, n long, q long")
    blocks = {}
    totals = {(r[0], r[1], r[2]): (r[3], r[4]) for r in tally.groupBy("band", "curve", "place").agg(F.sum("n"), F.sum("q")).collect()}
    for (i, c, p), (n, _) in totals.items():
        q = sum(totals.get((i, c, p + d), (0, 0))[1] for d in (-1, 0, 1))
        blocks[i, c, p] = (-(-n // BLOCK), -(-q // QUERY_BLOCK))
    shared = spark.sparkContext.broadcast(blocks)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 512):
                b = whole.slice(start, 512)
                width = np.asarray(pa.compute.list_value_length(b.column("vec")))
                code = np.asarray(b.column("code").flatten()).reshape(b.num_rows, -1)
                cid, asks, band = (np.asarray(b.column(c)) for c in ("cid", "asks", "band"))
                rows: list[tuple] = []
                for w in np.unique(width):
                    for at in bands[int(w)]:
                        for side, of in ((0, np.flatnonzero(band == at)), (1, np.flatnonzero((width == w) & asks))):
                            for i, at_curve in zip(of, places(code[of], at), strict=True):
                                turn = int(cid[i]) * 0x9E3779B97F4A7C15 >> 17
                                for c, s in enumerate(at_curve.tolist()):
                                    for d in (-1, 0, 1) if side else (0,):
                                        cb, qb = shared.value.get((at, c, s + d), (0, 0))
                                        if cb and qb:
                                            for j in range(cb if side else qb):
                                                own_block = turn % (qb if side else cb)
                                                rows.append((at, c, s + d, *((j, own_block) if side else (own_block, j)), side, int(i)))
                if rows:
                    cols = list(zip(*rows, strict=True))
                    take = pa.array(cols[6])
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int32()) for x in cols[:6]] + [b.column("cid").take(take), b.column("vec").take(take)], [*GROUP, "side", "cid", "vec"])

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def answer(t: pa.Table) -> pa.RecordBatch:
            side, cid = np.asarray(t["side"]), np.asarray(t["cid"])
            m = matrix(t["vec"].combine_chunks())
            q, v = side == 1, side == 0
            if not q.any() or not v.any():
                i = j = np.zeros(0, np.int64)
                s = np.zeros(0)
            else:
                i, j, s = best_of(m[q], m[v], cid[v], k + 1)
            return pa.RecordBatch.from_arrays([pa.array(cid[q][i]), pa.array(cid[v][j]), pa.array(s)], ["asked", "cid", "score"])

        rest = None
        for b in batches:
            t = pa.Table.from_batches([b])
            t = pa.concat_tables([rest, t]).combine_chunks() if rest is not None else t
            keys = np.stack([np.asarray(t[c]) for c in GROUP])
            edges = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1
            for lo, hi in zip([0, *edges[:-1]], edges):
                yield answer(t.slice(lo, hi - lo))
            rest = t.slice(edges[-1] if len(edges) else 0)
        if rest is not None and rest.num_rows:
            yield answer(rest)

    schema = ", ".join(f"{c} int" for c in [*GROUP, "side"])
    groups = codes.mapInArrow(dealt, f"{schema}, cid long, vec array<double>").repartition(*GROUP).sortWithinPartitions(*GROUP)
    met = groups.mapInArrow(searched, "asked long, cid long, score double").groupBy("asked", "cid").agg(F.max("score").alias("score"))
    order = Window.partitionBy("asked").orderBy(F.desc("score"), "cid")
    top = met.withColumn("at", F.row_number().over(order)).where(F.col("at") <= k + 1).drop("at")
    top = top.join(classes.select("cid", "ids"), "cid").groupBy("asked").agg(F.collect_list(F.struct("score", "ids")).alias("found"))
    named = asked.join(classes.select("h1", "h2", F.col("cid").alias("asked")), ["h1", "h2"])
    flat = named.join(top, "asked").select("query_id", F.explode("found").alias("f")).select("query_id", "f.score", F.explode("f.ids").alias("vec_id")).where("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return flat.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

