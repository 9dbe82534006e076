"""Whitening of embeddings with distributed block matrices.

Entries become whole numbers on a fixed grid. Each distinct vector counts once: equal rows are
grouped first, so a vector that a third of all rows share is one row of the matrix. The distinct
vectors of a partition are packed into blocks where they are, the last one filled up with rows that
count for nothing; so the matrix costs no shuffle of its own. Rows are centred exactly (n * x - S in
whole numbers, then one division). The scatter matrix is one product of block matrices whose middle
dimension is split, so no task gathers all blocks; only the d x d scatter comes to the driver. A
second product with the whitening matrix projects all rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.bytewise import lists
from wordloom.llm.tables import stored
from wordloom.llm.vectors import finite, on_grid, padded, stacked
from wordloom.operators.ordering import ROW_IN_PARTITION, chunk_offsets

BLOCK_ROWS = 1024
BLOCK_COLUMNS = 1024
BLOCKS_A_SPLIT = 16
#: The scatter matrix is held by the driver.
MOST_DIMENSIONS = 4096
FIT_BLOCKS = "n int, x binary, sums array<bigint>"
KNOWN = "x array<bigint>, deviation bigint, w array<double>"


@dataclass
class Whitening:
    """What is known of the fit list: `n` distinct vectors with sums `sums`, and their components
    by falling eigenvalue, as columns of `vectors`."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def matrix(self, k: int) -> np.ndarray:
        return self.vectors[:, :k] / np.sqrt(self.values[:k])

    def explained(self, k: int) -> list[float]:
        return (self.values[:k] / self.trace).tolist()


def grid_rows(df: DataFrame, id_column: str, vector: str, scale: int) -> tuple[DataFrame, int]:
    """(id, x) of usable rows, stored, and the largest number of entries; shorter vectors get
    zeros at their end."""
    rows = finite(df.select(F.col(id_column).alias("id"), F.col(vector).alias("v")), "v")
    table = stored(rows.select("id", on_grid("v", scale).alias("x")), "grid-rows")
    d = table.agg(F.max(F.size("x"))).first()[0] or 0
    if d > MOST_DIMENSIONS:
        raise ValueError(f"vectors have up to {d} entries; {MOST_DIMENSIONS} can be whitened")
    return table.withColumn("x", padded("x", d)), d


def _packed(batches):
    for _, x in stacked(batches, BLOCK_ROWS):
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([len(x)], pa.int32()),
                pa.array([np.ascontiguousarray(x, np.int64).tobytes()], pa.binary()),
                lists(x.sum(0), np.array([x.shape[1]])),
            ],
            ["n", "x", "sums"],
        )


def fit_list(rows: DataFrame) -> tuple[DataFrame, int, int, list[int]]:
    """(number, n, x): every distinct x once, in blocks numbered from 0 without gaps; the number
    of blocks, of vectors, and the sums of the dimensions."""
    packed = rows.select("x").distinct().mapInArrow(_packed, FIT_BLOCKS)
    # Stored with its places: another run might deal the vectors otherwise.
    placed = stored(
        packed.select(
            "*",
            F.spark_partition_id().alias("chunk"),
            F.monotonically_increasing_id().bitwiseAND(F.lit(ROW_IN_PARTITION)).alias("pos"),
        ),
        "fit-blocks",
    )
    totals = placed.agg(F.count("*"), F.sum("n")).first()
    each = placed.select(F.posexplode("sums").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("s"))
    sums = [r.s for r in sorted(each.collect())]
    number = (F.col("before") + F.col("pos")).alias("number")
    offsets = F.broadcast(chunk_offsets(placed, F.count("*")))
    return placed.join(offsets, "chunk").select(number, "n", "x"), totals[0], totals[1] or 0, sums


def off_centre(x: bytes, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - S of a block's rows, in whole numbers of whatever size they need."""
    rows = np.frombuffer(x, np.int64).reshape(-1, len(sums))
    most = int(np.abs(rows).max(initial=0)) * n + max(map(abs, sums.tolist()))
    return rows * n - sums if most < 1 << 62 else rows.astype(object) * n - sums.astype(object)


def block_matrix(fit: DataFrame, n_blocks: int, n: int, sums: list[int]) -> BlockMatrix:
    """The centred rows of the fit list as distributed blocks; missing rows are zeros."""
    d, columns, totals = len(sums), min(len(sums), BLOCK_COLUMNS), np.array(sums)

    def blocks(row):
        dense = np.zeros((BLOCK_ROWS, d))
        dense[: row.n] = off_centre(row.x, n, totals).astype(float) / n
        for j in range(0, d, columns):
            part = dense[:, j : j + columns]
            yield (row.number, j // columns), DenseMatrix(*part.shape, part.ravel(order="F"))

    return BlockMatrix(fit.rdd.flatMap(blocks), BLOCK_ROWS, columns, n_blocks * BLOCK_ROWS, d)


def scatter(blocks: BlockMatrix) -> np.ndarray:
    """Transpose times matrix. The middle dimension is split, as all products would else be
    summed where the one block of the result lives."""
    splits = max(1, blocks.numRows() // (BLOCK_ROWS * BLOCKS_A_SPLIT))
    product = blocks.transpose()._java_matrix_wrapper.call(
        "multiply", blocks._java_matrix_wrapper._java_model, splits
    )
    size = blocks.colsPerBlock
    return BlockMatrix(product, size, size).toLocalMatrix().toArray()


def fit_whitening(blocks: BlockMatrix, n: int, sums: list[int]) -> Whitening:
    """Components of the covariance (divisor n); those without variance are left out."""
    covariance = scatter(blocks) / n
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    values, vectors = values[::-1], vectors[:, ::-1]
    trace = float(np.trace(covariance))
    some = values > max(trace, 0.0) * len(values) * np.finfo(float).eps
    return Whitening(n, sums, values[some], vectors[:, some], trace)


def project(blocks: BlockMatrix, matrix: np.ndarray) -> DataFrame:
    """(number, w): the rows of each block times a local matrix, column after column."""
    size = blocks.colsPerBlock
    parts = [
        ((i, 0), DenseMatrix(*part.shape, part.ravel(order="F")))
        for i, part in enumerate(np.split(matrix, range(size, len(matrix), size)))
    ]
    context = blocks.blocks.context
    right = BlockMatrix(context.parallelize(parts, 1), size, matrix.shape[1], *matrix.shape)
    product = blocks.multiply(right)
    table = callMLlibFunc("getMatrixBlocks", product._java_matrix_wrapper._java_model)
    number = F.col("_1")["_1"].cast("long").alias("number")
    return table.select(number, F.unwrap_udt("_2")["values"].alias("w"))


def _unpacked(n: int, sums: list[int], k: int):
    totals = np.array(sums)

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                x = batch.column("x")[i].as_py()
                whole = off_centre(x, n, totals)
                rows = len(whole)
                if len(totals) * float(np.abs(whole).max(initial=0)) ** 2 < 2.0**62:
                    deviation = (whole * whole).sum(1).tolist()
                else:
                    exact = (whole.astype(object) ** 2).sum(1).tolist()
                    deviation = [v if v < 1 << 63 else None for v in exact]
                w = np.array(batch.column("w")[i].values).reshape(k, BLOCK_ROWS)[:, :rows].T
                yield pa.RecordBatch.from_arrays(
                    [
                        lists(np.frombuffer(x, np.int64), np.full(rows, len(totals))),
                        pa.array(deviation, pa.int64()),
                        lists(np.ascontiguousarray(w).ravel(), np.full(rows, k)),
                    ],
                    ["x", "deviation", "w"],
                )

    return run


def identity_error(known: DataFrame, n: int, k: int) -> float:
    """Largest absolute entry of the projected rows' covariance (divisor n) less the identity."""
    at = [F.get("w", F.lit(i)) for i in range(k)]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    sums = known.agg(
        *[F.sum(c).alias(f"s{i}") for i, c in enumerate(at)],
        *[F.sum(at[i] * at[j]).alias(f"p{i}_{j}") for i, j in pairs],
    ).first()
    return max(
        abs(sums[f"p{i}_{j}"] / n - sums[f"s{i}"] / n * sums[f"s{j}"] / n - (i == j))
        for i, j in pairs
    )


def whitened(
    df: DataFrame,
    id_column: str = "vec_id",
    vector: str = "embedding",
    scale: int = 256,
    components: int = 4,
) -> DataFrame:
    """Every usable row on the first whitened components of the table, one row a component.

    Columns: the id, component (from 1, by falling eigenvalue), n (distinct vectors), deviation
    (exact squared distance of n * x from the sums), whitened, explained (share of the variance),
    identity_error (one value). A component's sign is arbitrary, the same for all rows.

    Null vectors and vectors with null or non-finite entries are left out. Ids may be null or
    repeat; each row gets its own. Equal vectors count once in the fit and get equal values.
    Vectors of fewer entries than the longest get zeros at their end; more than 4,096 entries are
    an error. Components without variance are left out, so one distinct vector, or none, or an
    empty table, gives no rows. A deviation beyond 64 bits is null. Other columns are not read.
    """
    rows, d = grid_rows(df, id_column, vector, scale)
    fit, n_blocks, n, sums = fit_list(rows)
    model = None
    if d and n > 1:
        blocks = block_matrix(fit, n_blocks, n, sums)
        model = fit_whitening(blocks, n, sums)
    k = min(components, len(model.values)) if model else 0
    explained, error = [], 0.0
    known = df.sparkSession.createDataFrame([], KNOWN)
    if k:
        pairs = fit.join(project(blocks, model.matrix(k)), "number").select("x", "w")
        known = stored(pairs.mapInArrow(_unpacked(n, sums, k), KNOWN), "projected")
        explained, error = model.explained(k), identity_error(known, n, k)
    each = rows.join(known, "x").select("id", "deviation", F.posexplode("w").alias("i", "whitened"))
    shares = F.array(*map(F.lit, explained)).cast("array<double>")
    return each.select(
        F.col("id").alias(id_column),
        (F.col("i") + 1).alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("i")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
