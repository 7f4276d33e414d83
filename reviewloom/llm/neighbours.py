"""Approximate nearest neighbours: cross-polytope hashing with multiprobe, exact reranking."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.llm.common import cut

#: Hash tables, and cells of each that a query looks at.
TABLES, PROBES = 16, 8
#: Cross-polytope functions joined into a table's cell number. With f functions a vector of d
#: components (d a power of two) falls into one of (2 d)^f cells: raise it with the table's size.
FUNCTIONS = 1
#: Vectors and queries of a cell that one task compares; larger cells are divided.
INDEX_BLOCK, QUERY_BLOCK = 4_096, 1_024
SEED = 20_240


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row, scaled to keep lengths."""
    rows, n = x.shape
    step = 1
    while step < n:
        pairs = x.reshape(rows, n // (2 * step), 2, step)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], 2).reshape(rows, n)
        step *= 2
    return x / np.sqrt(n)


def rotated(x: np.ndarray, table: int, function: int) -> np.ndarray:
    """Pseudo-rotation of unit vectors: three rounds of random signs and a Hadamard transform."""
    width = 1 << max(int(x.shape[1] - 1).bit_length(), 0)
    rng = np.random.default_rng([SEED, table, function, x.shape[1]])
    y = np.pad(x, ((0, 0), (0, width - x.shape[1])))
    for _ in range(3):
        y = hadamard(y * rng.choice([-1.0, 1.0], width))
    return y


def ranked_axes(y: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` nearest signed axes of each row, nearest first, and their closeness."""
    signed = np.concatenate([y, -y], 1)
    most = min(most, signed.shape[1])
    at = np.argsort(-signed, axis=1, kind="stable")[:, :most]
    return at, np.take_along_axis(signed, at, 1)


def cells(x: np.ndarray, table: int, functions: int, probes: int) -> np.ndarray:
    """Cell numbers of each row in a table, nearest first."""
    code, value = np.zeros((len(x), 1), np.int64), np.zeros((len(x), 1))
    for f in range(functions):
        y = rotated(x, table, f)
        at, close = ranked_axes(y, probes)
        code = (code[:, :, None] * (2 * y.shape[1]) + at[:, None, :]).reshape(len(x), -1)
        value = (value[:, :, None] + close[:, None, :]).reshape(len(x), -1)
        best = np.argsort(-value, axis=1, kind="stable")[:, :probes]
        code, value = np.take_along_axis(code, best, 1), np.take_along_axis(value, best, 1)
    return code


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten(), np.float64).reshape(len(column), -1)


def _by_width(batch: pa.RecordBatch):
    sizes = np.asarray(batch.column("embedding").value_lengths())
    for width in np.unique(sizes):
        yield int(width), batch.take(pa.array(np.flatnonzero(sizes == width)))


def _hashed(probes: int, tables: int, functions: int):
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for width, part in _by_width(batch):
                x = _matrix(part.column("embedding"))
                x = x / np.linalg.norm(x, axis=1, keepdims=True)
                for table in range(tables):
                    code = cells(x, table, functions, probes)
                    rows = pa.array(np.repeat(np.arange(len(x)), code.shape[1]))
                    n = len(rows)
                    arrays = [pa.array([width] * n, pa.int32()), pa.array([table] * n, pa.int32()), pa.array(code.ravel()), *[part.column(c).take(rows) for c in ("class_id", "first_id", "embedding")]]
                    yield pa.RecordBatch.from_arrays(arrays, ["width", "table_no", "cell", "class_id", "first_id", "embedding"])

    return spread


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each pair of rows, summed the same way wherever the pair is met."""
    return (a * b).sum(1) / (np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1)))


def _compare(k: int):
    def best(index: pa.Table, queries: pa.Table) -> pa.Table:
        found = []
        if index.num_rows and queries.num_rows:
            v, q = _matrix(index.column("embedding")), _matrix(queries.column("embedding"))
            ids, firsts = np.asarray(index.column("class_id")), np.asarray(index.column("first_id"))
            near = (q / np.linalg.norm(q, axis=1, keepdims=True)) @ (v / np.linalg.norm(v, axis=1, keepdims=True)).T
            most = min(k, len(v))
            rounding = 8 * (v.shape[1] + 8) * np.finfo(np.float64).eps  # far above what both ways to add up can differ by
            for row, query in enumerate(np.asarray(queries.column("class_id"))):
                at = np.flatnonzero(near[row] >= np.partition(near[row], len(v) - most)[len(v) - most] - rounding)
                score = cosines(np.repeat(q[row : row + 1], len(at), 0), v[at])
                top = np.lexsort((ids[at], firsts[at], -score))[:k]
                found.append((np.full(len(top), query), ids[at][top], firsts[at][top], score[top]))
        columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * 3 + [np.zeros(0)]
        kinds = {"query_class": pa.int64(), "class_id": pa.int64(), "first_id": pa.int64(), "score": pa.float64()}
        return pa.table({name: pa.array(c, kind) for (name, kind), c in zip(kinds.items(), columns, strict=True)})

    return best


def _met(index: DataFrame, probes: DataFrame, k: int) -> DataFrame:
    """The k best of every cell for each query that looks there; large cells in blocks."""
    cell = ["width", "table_no", "cell"]
    n_index = index.groupBy(*cell).agg(F.ceil(F.count("*") / INDEX_BLOCK).cast("int").alias("index_blocks"))
    n_probes = probes.groupBy(*cell).agg(F.ceil(F.count("*") / QUERY_BLOCK).cast("int").alias("query_blocks"))
    blocks = n_index.join(n_probes, cell)
    own = lambda parts: F.pmod(F.xxhash64("class_id"), F.col(parts)).cast("int")
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.col(parts) - 1))
    left = index.join(blocks, cell).select(*cell, "class_id", "first_id", "embedding", own("index_blocks").alias("i"), every("query_blocks").alias("j"))
    right = probes.join(blocks, cell).select(*cell, "class_id", "embedding", own("query_blocks").alias("j"), every("index_blocks").alias("i"))
    keys = [*cell, "i", "j"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_compare(k), "query_class long, class_id long, first_id long, score double")


def usable(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Rows with a vector of finite components that isn't zero; equal rows once."""
    kind = dict(df.dtypes)[vector_col]
    vector = F.col("embedding")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("embedding"))
        .where(vector.isNotNull() & F.col("vec_id").isNotNull())
        .where(finite & F.exists(vector, lambda x: x != 0))
        .withColumn("embedding", F.transform(vector, lambda x: F.when(x == 0, F.lit(0)).otherwise(x)).cast(kind))
        .dropDuplicates(["vec_id", "embedding"])
    )


def search(
    vectors: DataFrame,
    queries,
    k: int = 5,
    tables: int = TABLES,
    probes: int = PROBES,
    functions: int = FUNCTIONS,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """The ``k`` nearest rows found by cosine for each row that the condition ``queries`` selects.

    Returns query_id, rank (from 1), vec_id and score, nearest first, ties to the smaller id; a
    query isn't its own neighbour. ``queries`` is a condition on vec_id. Equal vectors are hashed
    once (of each, the k + 1 smallest ids are kept, which is all that a result can hold); different
    vectors that tie at the cut (parallel ones, or signs) are cut by their smallest ids too.
    Vectors that are null, zero or have a null or non-finite component take no part; only
    vectors of equal length meet. A query for which less than k rows were met is compared with
    all vectors, in blocks, so small tables give all candidates. An empty table gives no rows.
    """
    rows = usable(vectors, id_col, vector_col)
    smallest = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    classes = cut(
        rows.withColumn("n", smallest).where(F.col("n") <= k + 1)
        .groupBy("embedding").agg(F.min("vec_id").alias("first_id"), F.sort_array(F.collect_list("vec_id")).alias("members"))
        .withColumn("class_id", F.monotonically_increasing_id())
    )
    asked = cut(rows.where(queries).withColumnRenamed("vec_id", "query_id").join(classes.select("embedding", "class_id", "first_id"), "embedding"))
    vectors_of = classes.select("class_id", "first_id", "embedding")
    wanted = asked.select("class_id", "first_id", "embedding").dropDuplicates(["class_id"])
    kind = f"width int, table_no int, cell long, class_id long, first_id long, embedding {dict(classes.dtypes)['embedding']}"
    met = _met(vectors_of.mapInArrow(_hashed(1, tables, functions), kind), wanted.mapInArrow(_hashed(probes, tables, functions), kind), k + 1)
    first = cut(_top(met, k + 1))
    sizes = first.join(classes.select("class_id", F.size("members").alias("size")), "class_id")
    enough = sizes.groupBy("query_class").agg(F.sum("size").alias("n")).where(F.col("n") > k)
    short = cut(wanted.join(enough, F.col("class_id") == F.col("query_class"), "left_anti"))
    first_names = ["width", "table_no", "cell", "class_id", "first_id", "embedding"]
    everywhere = lambda df: df.select(F.size("embedding").alias("width"), F.lit(-1).alias("table_no"), F.lit(0).cast("long").alias("cell"), "class_id", "first_id", "embedding").toDF(*first_names)
    if not short.isEmpty():
        more = _top(_met(everywhere(vectors_of), everywhere(short), k + 1), k + 1)
        first = first.join(short, F.col("query_class") == short["class_id"], "left_anti").unionByName(more)
    pairs = asked.select("query_id", F.col("class_id").alias("query_class")).join(first, "query_class")
    expanded = pairs.join(classes.select("class_id", "members"), "class_id").select("query_id", "score", F.explode("members").alias("vec_id"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    ranked = expanded.where("query_id != vec_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return ranked.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _top(met: DataFrame, k: int) -> DataFrame:
    order = F.row_number().over(Window.partitionBy("query_class").orderBy(F.desc("score"), "first_id", "class_id"))
    return met.dropDuplicates(["query_class", "class_id"]).withColumn("n", order).where(F.col("n") <= k).drop("n")
