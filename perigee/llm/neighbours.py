"""Nearest neighbours by multiprobe p-stable hashing of directions, in bands of lengths.

Vectors are dealt into bands by their length, each ``RATIO`` times as long as the one before. Among
vectors of one length the nearest to a query, however long, are those nearest in direction, so
directions are hashed. Each of ``TABLES`` hash tables projects them on ``K`` Gaussian directions
and cuts the lines into cells of ``WIDTH``. In a band a query visits, besides its own bucket, the
buckets reached by moving some coordinates one cell up or down, in the order of how near it lies to
those cell borders (Lv et al. 2007), ``PROBES`` in all. Every vector is indexed. Vectors found in
any table are compared by their exact distance in double precision.

A query visits its own band first, then every other band that may hold a row nearer than its k-th
so far. Bands of up to ``WHOLE`` vectors are compared whole. So are bands more than ``SHORT`` times
as long as the query, where length and not direction decides: only queries with fewer than k rows
about as long as they get that far. A query that found fewer than k rows is then compared with
all rows of the bands that are certain to hold them.

Vectors of a band are dealt into blocks by a hash of the vector, and every query is sent once to each
block of the bands that it visits. A task makes the hash tables of its block, and looks up the buckets
that its queries visit: neither the index nor the visited buckets exist as tables of their own, and
nothing that grows with the input passes the driver. Equal vectors meet in one block and are indexed
once, with the smallest vec_ids of their group: as many as can appear in a result. Candidates are ruled
out by their distance in single precision, with a margin for its errors, so those left out can't be
among the nearest; the others are compared in double precision.

Defined results. Vectors that are null, zero, or hold null or non-finite components take no part,
nor do those whose length is not the most frequent one (the longer of equally frequent ones).
Null vec_id: takes no part. Rows repeating vec_id and vector count once. Ties go to the smaller vec_id. Fewer
candidates than asked for: all of them. An empty table gives an empty result. Extra columns are
ignored.
"""

from __future__ import annotations

import functools
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from perigee.llm.common import stored

TABLES = 8
K = 6
WIDTH = 2.0
PROBES = 48
#: Vectors in a block at least, where there are as many.
CHUNK = 4096
#: Numbers in the vectors of a block at most, and in those of the queries compared with it in one task.
BLOCK = 1 << 23
#: Queries compared at once, bits of a word, with so many vectors.
AT_ONCE, STEP = 64, 2048
#: Lengths of a band's upper to its lower border.
RATIO = 1.2
WHOLE = 1024
SHORT = 3.0


def probe_costs(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All sets of moves (rows of 0, -1 or +1 a line), and each one's sum of squared distances to the crossed borders.

    offsets: places within the cells, from 0 to 1; the last axis are the lines. The first set is empty.
    """
    lines = offsets.shape[-1]
    step = np.stack([np.zeros_like(offsets), offsets**2, (1 - offsets) ** 2], axis=-1)
    total = step[..., 0, :]
    for j in range(1, lines):
        total = (total[..., :, None] + step[..., j, None, :]).reshape(*offsets.shape[:-1], -1)
    return _all_moves(lines), total


@functools.cache
def _all_moves(lines: int) -> np.ndarray:
    return np.array([*itertools.product((0, -1, 1), repeat=lines)])


def probe_order(offsets: np.ndarray, probes: int) -> list:
    """Sets of moves (coordinate, -1 or +1) by rising sum of squared distances to the crossed borders.

    offsets: the query's place within its cell, from 0 to 1, on each line. First the empty set.
    """
    moves, cost = probe_costs(offsets)
    return [[(j, int(m)) for j, m in enumerate(moves[i]) if m] for i in np.argsort(cost, kind="stable")[:probes]]


class Hashes:
    """The projections of all tables for one number of dimensions; the same for the same seed."""

    #: A bucket's cells as one number: those of directions are far from 512 cells apart.
    PLACES = 1024 ** np.arange(K, dtype=np.int64)

    def __init__(self, dim: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.a = rng.normal(size=(TABLES, dim, K)) / WIDTH
        self.b = rng.uniform(size=(TABLES, K))

    def cells(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cells of the directions (rows x tables x K) and the places within them."""
        x = x / np.abs(x).max(axis=1, keepdims=True)
        x = x / np.linalg.norm(x, axis=1, keepdims=True)
        p = (x @ self.a.transpose(1, 0, 2).reshape(x.shape[1], -1)).reshape(-1, TABLES, K) + self.b[None]
        cell = np.floor(p)
        return cell.astype(np.int64), p - cell

    def buckets(self, x: np.ndarray) -> np.ndarray:
        """The bucket of each row in each table."""
        return np.concatenate([self.cells(x[i : i + CHUNK].astype(float))[0] @ self.PLACES for i in range(0, len(x), CHUNK)])

    def visited(self, x: np.ndarray) -> np.ndarray:
        """The PROBES buckets that each row as a query visits in each table."""
        cell, offsets = self.cells(x)
        moves, cost = probe_costs(offsets)
        best = np.argpartition(cost, PROBES - 1, axis=-1)[..., :PROBES]
        return (cell @ self.PLACES)[..., None] + (moves @ self.PLACES)[best]


class Bands:
    """How many vectors each band holds, and what follows from that for queries."""

    def __init__(self, counts: dict, k: int, dim: int, spread: int):
        self.counts, self.dim = dict(sorted(counts.items())), dim
        self.low = {b: RATIO ** (b - 0.5) * (1 - 1e-9) for b in counts}
        self.high = {b: RATIO ** (b + 0.5) * (1 + 1e-9) for b in counts}
        self.small = frozenset(b for b, n in counts.items() if n <= WHOLE)
        # blocks: as many as bound their size, or up to ``spread``, so that all cores have work
        self.parts = {b: max(-(-n * dim // BLOCK), min(-(-n // CHUNK), spread)) for b, n in counts.items()}
        # no k + 1 vectors are longer than this
        total, self.enough = 0, float("inf")
        for b, n in self.counts.items():
            total += n
            if total > k:
                self.enough = self.high[b]
                break

    def within(self, length: float, reach: float | None) -> list:
        """Bands that may hold one of the k nearest rows of a query that has k rows up to ``reach`` (null: fewer)."""
        reach = min(length + self.enough, float("inf") if reach is None else reach) * (1 + 1e-9)
        return [b for b in self.counts if max(self.low[b] - length, length - self.high[b]) <= reach]


def _lengths(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths, and the logarithms of them; squares of the parts of the largest component don't overflow."""
    most = np.abs(x).max(axis=1)
    over = np.sqrt(((x / most[:, None]) ** 2).sum(axis=1))
    return most * over, np.log(most) + np.log(over)


def _packed(kind: str, k: int):
    """Rows with their vector as bytes, its band, and whether they are indexed: of a batch's equal vectors the k + 1 smallest ids."""
    schema = pa.schema([("vec_id", pa.int64()), ("code", pa.binary()), ("band", pa.int32()), ("indexed", pa.bool_())])

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("vector").flatten().to_numpy().reshape(batch.num_rows, -1) + 0.0  # no negative zeros
            codes, ids = [v.tobytes() for v in x.astype(kind)], batch.column("vec_id").to_pylist()
            indexed, seen = [False] * len(ids), {}
            for i in sorted(range(len(ids)), key=ids.__getitem__):
                own = seen.setdefault(codes[i], set())
                if len(own) <= k and ids[i] not in own:
                    own.add(ids[i])
                    indexed[i] = True
            band = np.floor(_lengths(x)[1] / np.log(RATIO) + 0.5).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(codes, pa.binary()), pa.array(band), pa.array(indexed)], schema=schema)

    return run


def _vectors(codes, kind: str, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(codes), kind).reshape(-1, dim)


def _visits(kind: str, bands: Bands, step: str):
    """Bands visited by queries, and whether they are compared whole. step: "own" band, "others" within reach, or "rest": large bands whole."""
    schema = pa.schema([("query_id", pa.int64()), ("code", pa.binary()), ("band", pa.int32()), ("whole", pa.bool_()), ("parts", pa.int32())])

    def targets(own: int, length: float, reach: float | None) -> tuple[list, list]:
        if step == "rest":
            return [b for b in bands.within(length, None) if b not in bands.small], []
        near = [own] if step == "own" else [b for b in bands.within(length, reach) if b != own]
        whole = [b for b in near if b in bands.small or (b != own and bands.low[b] > SHORT * length)]
        return whole, [b for b in near if b not in whole]

    def run(batches):
        for every in batches:
            for at in range(0, every.num_rows, 64):
                batch = every.slice(at, 64)
                lengths, _ = _lengths(_vectors(batch.column("code").to_pylist(), kind, bands.dim).astype(float))
                to, whole, rows = [], [], []
                for i, q in enumerate(batch.select(["band", "reach"]).to_pylist()):
                    all_of, hashed = targets(q["band"], float(lengths[i]), q["reach"])
                    to += all_of + hashed
                    whole += [True] * len(all_of) + [False] * len(hashed)
                    rows += [i] * (len(to) - len(rows))
                take = pa.array(rows, pa.int64())
                parts = pa.array([bands.parts[b] for b in to], pa.int32())
                yield pa.RecordBatch.from_arrays([batch.column("query_id").take(take), batch.column("code").take(take), pa.array(to, pa.int32()), pa.array(whole, pa.bool_()), parts], schema=schema)

    return run


class Block:
    """Different vectors of about one length, their hash tables, and their nearest to queries."""

    def __init__(self, x: np.ndarray, gid: np.ndarray, most: int):
        self.x, self.gid, self.most, self.tables = x, gid, most, None
        self.hashes = Hashes(x.shape[1])
        # single precision: rows of -2 x and x * x, scaled by the largest component
        self.scale = float(np.abs(x).max())
        self.single = np.empty((len(x), x.shape[1] + 1), np.float32)
        for i in range(0, len(x), CHUNK):
            part = x[i : i + CHUNK].astype(float) / self.scale
            self.single[i : i + CHUNK, :-1] = -2 * part
            self.single[i : i + CHUNK, -1] = (part**2).sum(axis=1)
        self.squared = float(self.single[:, -1].max())

    def candidates(self, v: np.ndarray, whole: np.ndarray) -> np.ndarray:
        """For each vector the queries that find it, as bits."""
        bit = np.uint64(1) << np.arange(len(v), dtype=np.uint64)
        out = np.full(len(self.x), np.bitwise_or.reduce(bit[whole], initial=np.uint64(0)))
        if whole.all():
            return out
        if self.tables is None:
            own = self.hashes.buckets(self.x)
            self.tables = [np.unique(own[:, t], return_inverse=True) for t in range(TABLES)]
        visited, bits = self.hashes.visited(v[~whole]), np.repeat(bit[~whole], PROBES)
        for t, (buckets, place) in enumerate(self.tables):
            asked = visited[:, t].ravel()
            at = np.minimum(np.searchsorted(buckets, asked), len(buckets) - 1)
            there, by = buckets[at] == asked, np.zeros(len(buckets), np.uint64)
            np.bitwise_or.at(by, at[there], bits[there])
            out |= by[place]
        return out

    def near(self, v: np.ndarray, whole: np.ndarray):
        """For each query the rows that may be among its nearest ``most`` candidates: all that are, and a few more."""
        found_by = self.candidates(v, whole)
        rows = np.flatnonzero(found_by)
        if not len(rows):
            return [rows] * len(v)
        if len(rows) == len(found_by):
            rows, single = slice(None), self.single
        else:
            found_by, single = found_by[rows], self.single[rows]
        bit = np.uint64(1) << np.arange(len(v), dtype=np.uint64)
        with np.errstate(over="ignore"):
            length = np.linalg.norm(v / self.scale, axis=1)
        # else one side vanishes beside the other, or double precision doesn't hold squares either
        largest = max(1.0, float(length.max())) * self.scale
        if not (length < 1e15).all() or self.scale < 1e-150 or largest > 1e150:
            every = np.arange(len(self.x))[rows]
            return [every[(found_by & b) != 0] for b in bit]
        # queries fill a word; what single precision may be off, several times: the rounding of both vectors, of products and of sums
        w = np.zeros((v.shape[1] + 1, AT_ONCE), np.float32)
        w[:-1, : len(v)], w[-1] = (v / self.scale).T, 1
        margin = 4 * (v.shape[1] + 8) * float(np.finfo(np.float32).eps) * (self.squared + 2 * length * np.sqrt(self.squared)) + 1e-30
        some = max(STEP // 2, len(single) // 32)
        first = (single[:some] @ w)[:, : len(v)]
        first[(found_by[:some, None] & bit) == 0] = np.inf
        limit = np.full(AT_ONCE, -np.inf, np.float32)
        limit[: len(v)] = np.partition(first, self.most - 1, axis=0)[self.most - 1] + 2 * margin if len(first) > self.most else np.inf
        hits, room = [], np.empty((STEP, AT_ONCE), np.float32)
        for i in range(0, len(single), STEP):
            part = single[i : i + STEP]
            d = np.matmul(part, w, out=room[: len(part)])
            eights = (d <= limit).reshape(-1, 8)
            any_of = np.flatnonzero(eights.view(np.uint64))
            hit, of = np.nonzero(eights[any_of])
            r, q = np.divmod(any_of[hit] * 8 + of, AT_ONCE)
            own = (found_by[i + r] >> q.astype(np.uint64) & np.uint64(1)) != 0
            r, q = r[own], q[own]
            hits.append((i + r, q, d[r, q]))
        r, q, d = (np.concatenate(x) for x in zip(*hits, strict=True))
        order = np.argsort(q, kind="stable")
        r, d = (np.arange(len(self.x))[rows][r])[order], d[order]
        ends, out = np.cumsum(np.bincount(q, minlength=len(v))), []
        for i, end in enumerate(ends.tolist()):
            start = int(ends[i - 1]) if i else 0
            mine, far = r[start:end], d[start:end]
            if len(mine) > self.most:
                mine = mine[far <= np.partition(far, self.most - 1)[self.most - 1] + 2 * margin[i]]
            out.append(mine)
        return out

    def nearest(self, v: np.ndarray, whole: np.ndarray):
        """For each query rows and exact distances of its nearest candidates, ``most`` at most, by distance and id."""
        for one, rows in zip(v, self.near(v, whole), strict=True):
            with np.errstate(over="ignore"):
                d = np.sqrt(((self.x[rows].astype(float) - one) ** 2).sum(axis=1))
            best = np.lexsort((self.gid[rows], d))[: self.most]
            yield rows[best].tolist(), d[best].tolist()


def _nearest_in_block(kind: str, dim: int, k: int):
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def run(queries: pa.Table, index: pa.Table) -> pa.Table:
        found: tuple = ([], [], [])
        if queries.num_rows and index.num_rows:
            groups: dict = {}
            for code, i in zip(index["code"].to_pylist(), index["vec_id"].to_pylist(), strict=True):
                groups.setdefault(code, set()).add(i)
            ids = [sorted(g)[: k + 1] for g in groups.values()]
            # groups enough for k results: the query's own may hold no other row
            block = Block(_vectors(groups, kind, dim), np.array([g[0] for g in ids]), k + 1)
            for at in range(0, queries.num_rows, AT_ONCE):
                some = queries.slice(at, AT_ONCE)
                v, whole = _vectors(some["code"].to_pylist(), kind, dim).astype(float), np.array(some["whole"].to_pylist())
                for query_id, (rows, far) in zip(some["query_id"].to_pylist(), block.nearest(v, whole), strict=True):
                    for j, d in zip(rows, far, strict=True):
                        others = [i for i in ids[j] if i != query_id][:k]
                        found[0].extend([query_id] * len(others))
                        found[1].extend(others)
                        found[2].extend([d] * len(others))
        return pa.Table.from_arrays([pa.array(x, t) for x, t in zip(found, schema.types, strict=True)], schema=schema)

    return run


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and vector (doubles) of the rows that take part."""
    finite = lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))
    given = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("vector"))
    good = given.where("vec_id is not null and vector is not null").where(F.forall("vector", finite) & F.exists("vector", lambda e: e != 0))
    sizes = good.groupBy(F.size("vector").alias("dim")).count().orderBy(F.col("count").desc(), F.col("dim").desc()).first()
    return good.where(F.size("vector") == (sizes["dim"] if sizes else 0))


def _of_band(numbers: dict) -> Column:
    """The number of a row's band; 1 for bands that aren't named."""
    pairs = [F.lit(x) for band, n in numbers.items() if n > 1 for x in (band, n)]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.col("band")), F.lit(1)) if pairs else F.lit(1)


def _compared(visits: DataFrame, index: DataFrame, bands: Bands, visitors: dict, kind: str, k: int) -> DataFrame:
    """query_id, vec_id, score of the rows found in the visited bands, with the k nearest of each block at least."""
    down = _of_band({b: -(-n * bands.dim // BLOCK) for b, n in visitors.items()})
    chunk = lambda n, c: F.pmod(F.xxhash64(c), n).cast("int")
    every_of = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    dealt = index.where(F.col("band").isin([*visitors])).withColumn("i", chunk(_of_band({b: bands.parts[b] for b in visitors}), "code")).withColumn("j", every_of(down))
    coming = visits.withColumn("j", chunk(down, "query_id")).withColumn("i", every_of(F.col("parts")))
    where = ["band", "i", "j"]
    return coming.select(*where, "query_id", "code", "whole").groupBy(*where).cogroup(dealt.select(*where, "vec_id", "code").groupBy(*where)).applyInArrow(
        _nearest_in_block(kind, bands.dim, k), "query_id long, vec_id long, score double"
    )


def nearest(vectors: DataFrame, every: int = 100, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest other rows found for each row with vec_id divisible by ``every``."""
    spark, rows = vectors.sparkSession, usable(vectors)
    none = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    single = vectors.select("embedding").schema[0].dataType.elementType.simpleString() == "float"
    kind = "<f4" if single else "<f8"
    packed = stored(rows.mapInArrow(_packed(kind, k), "vec_id long, code binary, band int, indexed boolean"), "lsh-vectors")
    index = packed.where("indexed").select("vec_id", "code", "band")
    counts = index.groupBy("band").agg(F.count_distinct(F.xxhash64("code")).alias("vectors")).collect()
    if not counts:
        return none
    dim = len(packed.first()["code"]) // np.dtype(kind).itemsize
    bands = Bands({r["band"]: r["vectors"] for r in counts}, k, dim, max(32, 4 * spark.sparkContext.defaultParallelism))
    asked = packed.where(F.pmod("vec_id", F.lit(every)) == 0).select(F.col("vec_id").alias("query_id"), "code", "band")
    asked = stored(asked.dropDuplicates(), "lsh-asked")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")

    def ranked_k(found: DataFrame) -> DataFrame:
        merged = found.repartition("query_id").groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
        return merged.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

    found = None
    for step in ("own", "others", "rest"):
        reach = F.lit(None).cast("double")
        open_ = asked.withColumn("reach", reach)
        if found is not None:
            # merged: files say little of the size of rows in memory, so neither side is broadcast for theirs
            done = found.where(F.col("rank") == k).select("query_id", F.col("score").alias("reach")).hint("merge")
            open_ = asked.join(done, "query_id", "left") if step == "others" else asked.join(done, "query_id", "left_anti").withColumn("reach", reach)
        visits = stored(open_.mapInArrow(_visits(kind, bands, step), "query_id long, code binary, band int, whole boolean, parts int"), f"lsh-visits-{step}")
        visitors = {r["band"]: r["count"] for r in visits.groupBy("band").count().collect()}
        if not visitors:
            continue
        got = _compared(visits, index, bands, visitors, kind, k)
        found = stored(ranked_k(got if found is None else got.unionByName(found.select("query_id", "vec_id", "score"))), f"lsh-found-{step}")
    return none if found is None else found
