"""Exact top-k inner products by sorted lists and score bounds, without random access.

Candidates lie in blocks of bounded size. A block is stored as sorted lists only: for each
dimension its values in rising order with their row numbers. Lists are read in step from both
ends. What has been read of a row adds to its score; of what has not, the two ends reached so far
bound each value, so every row has a lower and an upper bound. A query is done with a block once
few enough rows have an upper bound that reaches its k-th lower bound (or the k-th score that it
brings from earlier blocks); only those are read to the end.

Blocks fall into groups, query tiles go to every group, and a task keeps the best k of each query
it has met, so what is merged at the end is k rows for each query and group. Sums are whole
numbers below 2^53 in floating point, else 64-bit integers, so scores are exact.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wordloom.llm.tables import stored
from wordloom.llm.vectors import finite, on_grid, stacked

BLOCK_ROWS = 4096
TILE_ROWS = 256
#: Blocks for each group at least, and groups at most.
GROUP_BLOCKS = 4
MOST_GROUPS = 256
#: Query tiles that one task keeps the best rows of.
SET_TILES = 1024
#: Depths at which bounds are taken, as shares of a list; a half from either end is all of it.
DEPTHS = (1 / 16, 1 / 8, 1 / 4, 3 / 8, 7 / 16, 1 / 2)
#: Rows a query that are read to the end at once instead of going deeper, in units of k.
FEW = 4
EXACT = 1 << 53

BLOCKS = "block long, n int, d int, most double, ids binary, values binary, rows binary"
TILES = "tile long, n int, d int, most double, ids binary, vectors binary"
FOUND = "query_id long, tile long, place int, vec_id long, score long"


def _packed(columns: dict) -> pa.RecordBatch:
    kinds = {"n": pa.int32(), "d": pa.int32(), "most": pa.float64()}
    return pa.RecordBatch.from_pydict(
        {k: pa.array([v], kinds.get(k, pa.binary() if isinstance(v, bytes) else pa.int64())) for k, v in columns.items()}
    )


def _largest(x: np.ndarray) -> float:
    return float(np.abs(x.astype(float)).max()) if x.size else 0.0


def _sorted_lists(batches):
    """Blocks of candidates as one sorted list of values and row numbers a dimension."""
    for k, (ids, x) in enumerate(stacked(batches, BLOCK_ROWS)):
        order = np.argsort(x, axis=0, kind="stable").T
        values = np.take_along_axis(x.T, order, 1)
        yield _packed({
            "block": k, "n": len(ids), "d": x.shape[1], "most": _largest(x),
            "ids": ids.astype(np.int64).tobytes(),
            "values": np.ascontiguousarray(values, np.int64).tobytes(),
            "rows": order.astype(np.uint16).tobytes(),
        })


def _query_tiles(batches):
    for k, (ids, x) in enumerate(stacked(batches, TILE_ROWS)):
        yield _packed({
            "tile": k, "n": len(ids), "d": x.shape[1], "most": _largest(x),
            "ids": ids.astype(np.int64).tobytes(),
            "vectors": np.ascontiguousarray(x, np.int64).tobytes(),
        })


class Lists:
    """The sorted lists of one block, read in step from both ends, as deep as any query asked."""

    def __init__(self, row):
        self.n, self.d = row["n"], row["d"]
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.values = np.frombuffer(row["values"], np.int64).reshape(self.d, self.n)
        self.rows = np.frombuffer(row["rows"], np.uint16).reshape(self.d, self.n)
        self.most = row["most"]
        self.depth = 0
        #: What has been read: values (zero where not) and which entries are known.
        self.read = np.zeros((self.d, self.n))
        self.known = np.zeros((self.d, self.n))

    def go(self, depth: int) -> None:
        """Read on until `depth` entries of each list are known from either end."""
        if depth <= self.depth:
            return
        lists = np.arange(self.d)[:, None]
        for part in (slice(self.depth, depth), slice(self.n - depth, self.n - self.depth)):
            rows = self.rows[:, part].astype(np.int64)
            self.read[lists, rows] = self.values[:, part]
            self.known[lists, rows] = 1.0
        self.depth = depth

    def ends(self) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest value that an entry not read yet can have, by list."""
        low = self.values[:, min(self.depth, self.n - 1)]
        return low.astype(float), self.values[:, max(self.n - 1 - self.depth, 0)].astype(float)

    def all_read(self) -> bool:
        return 2 * self.depth >= self.n


def _kth(values: np.ndarray, k: int) -> np.ndarray:
    """Each row's k-th greatest value, minus infinity where there are fewer."""
    if values.shape[1] < k:
        return np.full(len(values), -np.inf)
    return np.partition(values, values.shape[1] - k, axis=1)[:, values.shape[1] - k]


def block_best(lists: Lists, ids: np.ndarray, vectors: np.ndarray, floor: np.ndarray, k: int):
    """(query, row, score) of all rows of a block that may be among the best k of their query.

    `floor` is the k-th best score that each query has so far. Rows with the query's own id take
    no part. Every pair that is left out has k better ones in the block or before it.
    """
    d = min(lists.d, vectors.shape[1])
    q = np.zeros((len(ids), lists.d))
    q[:, :d] = vectors[:, :d]
    own = ids[:, None] == lists.ids[None, :]
    open_ = np.arange(len(ids))
    found = []
    halves = sorted({max(1, math.ceil(lists.n * share)) for share in DEPTHS})
    for depth in halves:
        lists.go(min(depth, (lists.n + 1) // 2))
        part = q[open_]
        score = part @ lists.read
        if lists.all_read():
            limit = np.maximum(floor[open_], _kth(np.where(own[open_], -np.inf, score), k))
            at, row = np.nonzero((score >= limit[:, None]) & ~own[open_])
            found.append((open_[at], row, score[at, row]))
            break
        low, high = lists.ends()
        least, most = np.minimum(part * low, part * high), np.maximum(part * low, part * high)
        lower = score + least.sum(1)[:, None] - least @ lists.known
        upper = score + most.sum(1)[:, None] - most @ lists.known
        lower[own[open_]] = upper[own[open_]] = -np.inf
        limit = np.maximum(floor[open_], _kth(lower, k))
        candidates = (upper >= limit[:, None]) & ~own[open_]
        few = candidates.sum(1) <= FEW * k
        at, row = np.nonzero(candidates & few[:, None])
        if len(at):
            found.append((open_[at], row, None))
        open_ = open_[~few]
        if not len(open_):
            break
    out = []
    for at, row, score in found:
        if score is None:
            lists.go((lists.n + 1) // 2)
            score = np.einsum("ij,ij->i", q[at], lists.read[:, row].T)
        out.append((at, row, score))
    return [np.concatenate(x) for x in zip(*out)] if out else [np.empty(0, np.int64)] * 3


def _plain_best(lists: Lists, ids, vectors):
    """All pairs of a block in 64-bit integers, for numbers that floating point does not hold."""
    d = min(lists.d, vectors.shape[1])
    if lists.most * _largest(vectors) * max(d, 1) >= 2.0**63:
        raise ValueError("inner products of these vectors pass 64 bits")
    x = np.zeros((lists.d, lists.n), np.int64)
    x[np.arange(lists.d)[:, None], lists.rows.astype(np.int64)] = lists.values
    score = vectors[:, :d] @ x[:d]
    at, row = np.nonzero(ids[:, None] != lists.ids[None, :])
    return at, row, score[at, row]


class Best:
    """The best k (score, id) of each query of a tile so far."""

    def __init__(self, n: int, k: int):
        self.k, self.n = k, n
        self.query = self.vec = self.score = np.empty(0, np.int64)

    def floor(self) -> np.ndarray:
        out = np.full(self.n, -np.inf)
        counts = np.bincount(self.query, minlength=self.n)
        full = np.flatnonzero(counts == self.k)
        ends = np.cumsum(counts) - 1
        out[full] = self.score[ends[full]]
        return out

    def add(self, query, vec, score) -> None:
        query = np.concatenate([self.query, query])
        vec = np.concatenate([self.vec, vec])
        score = np.concatenate([self.score, score.astype(np.int64)])
        order = np.lexsort((vec, -score, query))
        query, vec, score = query[order], vec[order], score[order]
        first = np.searchsorted(query, query)
        keep = np.arange(len(query)) - first < self.k
        self.query, self.vec, self.score = query[keep], vec[keep], score[keep]


def _searched(k: int):
    def run(batches):
        best, names, lists, block = {}, {}, None, None
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in ("block_key", "tile_key", "tile_n", "tile_d", "tile_most")}
                if row["block_key"] != block:
                    block = row["block_key"]
                    lists = Lists({c: batch.column(c)[i].as_py() for c in ("n", "d", "most", "ids", "values", "rows")})
                tile, n = row["tile_key"], row["tile_n"]
                ids = np.frombuffer(batch.column("tile_ids")[i].as_py(), np.int64)
                vectors = np.frombuffer(batch.column("tile_vectors")[i].as_py(), np.int64).reshape(n, row["tile_d"])
                if tile not in best:
                    best[tile], names[tile] = Best(n, k), ids
                top = best[tile]
                if lists.most * row["tile_most"] * max(lists.d, 1) < EXACT:
                    at, rows, score = block_best(lists, ids, vectors, top.floor(), k)
                else:
                    at, rows, score = _plain_best(lists, ids, vectors)
                top.add(at, lists.ids[rows], score)
        for tile, top in best.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(names[tile][top.query]),
                    pa.array(np.full(len(top.query), tile)),
                    pa.array(top.query.astype(np.int32)),
                    pa.array(top.vec),
                    pa.array(top.score),
                ],
                ["query_id", "tile", "place", "vec_id", "score"],
            )

    return run


def _numbered(table: DataFrame, name: str) -> DataFrame:
    """The row's number within its partition made unique over the table."""
    return table.withColumn(name, F.monotonically_increasing_id())


def top_inner_products(
    df: DataFrame,
    is_query,
    k: int = 10,
    scale: int = 1024,
    id_column: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """The `k` rows of greatest inner product with each row that meets the condition `is_query`.

    Columns query_id, rank (from 1), vec_id, score. Entries are taken as floor(scale * entry);
    scores are exact. Equal scores rank by the smaller id. All rows are candidates but those that
    have the query's own id; with fewer than k there are fewer rows.

    Rows with a null id, a null vector, or null or non-finite entries take no part, and neither
    does a row whose condition is null as a query. A shorter vector counts as one that ends in
    zeros. An id that several rows have is a candidate with each of them, and each is a query of
    its own, with a list of its own. Scores beyond 64 bits are an error. An empty table, or one
    without queries, gives no rows. Other columns are read only if the condition names them.
    """
    spark = df.sparkSession
    rows = finite(df, vector).filter(F.col(id_column).isNotNull())
    each = [F.col(id_column).cast("long").alias("id"), on_grid(vector, scale).alias("x")]
    blocks = _numbered(rows.select(*each).mapInArrow(_sorted_lists, BLOCKS), "block")
    tiles = _numbered(rows.filter(is_query).select(*each).mapInArrow(_query_tiles, TILES), "tile")
    blocks, tiles = stored(blocks, "sorted-lists"), stored(tiles, "query-tiles")
    n_blocks, n_tiles = blocks.count(), tiles.count()
    groups = max(1, min(MOST_GROUPS, max(math.ceil(n_blocks / GROUP_BLOCKS), min(n_blocks, 16))))
    sets = max(1, math.ceil(n_tiles / SET_TILES))
    # A group of blocks and a set of tiles meet in one task; both are spread by hashes of numbers.
    left = blocks.withColumnRenamed("block", "block_key").select(
        "*",
        F.pmod(F.xxhash64("block_key"), F.lit(groups)).alias("group"),
        F.explode(F.sequence(F.lit(0), F.lit(sets - 1))).alias("set"),
    )
    right = tiles.select(
        F.col("tile").alias("tile_key"),
        *[F.col(c).alias(f"tile_{c}") for c in ("n", "d", "most", "ids", "vectors")],
        F.pmod(F.xxhash64("tile"), F.lit(sets)).cast("int").alias("set"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("group"),
    )
    pairs = left.join(right, ["group", "set"]).drop("group", "set")
    found = pairs.mapInArrow(_searched(k), FOUND)
    order = Window.partitionBy("tile", "place").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
