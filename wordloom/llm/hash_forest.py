"""Approximate nearest neighbours by cosine with a forest of hash prefixes.

Each tree gives every vector a hash string of signs of random projections, and the vectors that
share a prefix with a query are a range of the tree. A query starts at the longest prefixes that
can matter and ascends one bit at a time, in all trees at once, until the ranges of all trees
together hold ``share`` of the vectors. Strings are worked out to the depth D of these prefixes only
(five bits with the defaults), and ranges are cells of D bits, not places in a sorted array: how many
vectors a prefix holds comes from the cells' counts, a table of at most ``trees * 2**D`` entries; D
follows from ``share`` and ``trees`` alone.

For the search every tree's array is dealt out by range, large ranges in blocks of
``BLOCK`` vectors, and a query goes to the ranges below its prefix only. The members of a
block are scored with one matrix product. Nothing is dropped from a range or block.

Equal vectors are searched once, under a number of their own: one id may have several vectors. Only the ``k + 1`` smallest ids of each distinct vector
can be among anybody's ``k`` nearest, so no more of them are kept as answers; all of them are
queries if their ids say so.

On vectors without any cluster structure, prefixes of hash strings tell little about cosines:
there, recall 0.9 needs a large ``share``. The default reaches it on uniform directions in 64
dimensions; on clustered vectors a smaller one does.

Defined results: vectors null, zero, or with a null or non-finite component take no part,
neither do vectors of another length than most have (of several such lengths, the greatest);
repeated rows of one id and vector count once; an id with several vectors has a row for each, and
each asks by itself if the id is a query's, its own row left out; cosines that agree in
``TIE_DIGITS`` decimals, as those of multiples of a vector do, are ties, and go to the smaller id;
fewer than ``k`` candidates
give fewer rows; an empty table gives none; other columns are not used.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordloom.llm.common import documents, prepare, stage

BITS = 64
BLOCK = 4096
QUERY_BLOCK = 1024
MAX_DEPTH = 20
TIE_DIGITS = 12


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, embedding`` of the rows that take part, once per id and vector."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    rows = documents(vectors, "vec_id", "embedding").select(F.col("vec_id").cast("long"), "embedding")
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~bad & some)
    sizes = rows.groupBy(F.size("embedding").alias("size")).count()
    most = sizes.orderBy(F.desc("count"), F.desc("size")).first()
    return rows.where(F.size("embedding") == (most["size"] if most else 0))


def unit(embedding: pa.Array) -> np.ndarray:
    """Rows of length 1 in double precision."""
    flat = embedding.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = flat.reshape(len(embedding), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow of the squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


class Forest:
    """The hash functions, and the number of vectors per tree and range of depth ``depth``."""

    def __init__(self, dimension: int, trees: int, depth: int, seed: int):
        self.dimension, self.trees, self.depth, self.seed = dimension, trees, depth, seed
        self.counts = np.zeros((trees, 1 << depth), np.int64)

    def cells(self, x: np.ndarray) -> np.ndarray:
        """Per vector and tree, the first ``depth`` bits of its hash string."""
        rng = np.random.default_rng(self.seed)
        planes = rng.standard_normal((self.trees, BITS, self.dimension))[:, : self.depth]
        cells = np.zeros((len(x), self.trees), np.int64)
        for bit in range(self.depth):
            cells = 2 * cells + (x @ planes[:, bit].T > 0)
        return cells

    def depths(self, cells: np.ndarray, wanted: float) -> np.ndarray:
        """The greatest depth at which all trees' ranges together hold ``wanted`` vectors."""
        found = np.zeros(len(cells), np.int64)
        trees = np.arange(self.trees)
        for depth in range(1, self.depth + 1):
            held = self.counts.reshape(self.trees, 1 << depth, -1).sum(axis=2)
            total = held[trees, cells >> (self.depth - depth)].sum(axis=1)
            found[total >= wanted] = depth
        return found

    def blocks(self) -> tuple[np.ndarray, np.ndarray]:
        """Per tree and range, the number of blocks of its vectors, and of its queries."""
        return np.maximum(1, -(-self.counts // BLOCK)), np.maximum(1, -(-self.counts // (16 * BLOCK)))


def _spread(ids: np.ndarray, parts: np.ndarray) -> np.ndarray:
    """A part for each id, evenly and always the same."""
    mixed = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(33)) % parts.astype(np.uint64)).astype(np.int64)


def _rows(keys: list, ids: list, vectors: list) -> pa.RecordBatch:
    key, own = np.concatenate(keys), np.concatenate(ids)
    x = np.concatenate(vectors)
    data = pa.array([row.tobytes() for row in x], pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(key), pa.array(own), data], ["key", "id", "x"])


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    trees: int = 32,
    share: float = 0.9,
    seed: int = 20,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found to each query row."""
    spark = vectors.sparkSession
    prepare(spark)
    rows = stage(usable(vectors), "vectors")
    # Numbered in the order of their smallest ids, which settles ties; written once, so the numbers stay.
    groups = rows.groupBy("embedding").agg(F.min("vec_id").alias("first"))
    groups = groups.orderBy("first", F.xxhash64("embedding"))
    groups = stage(groups.select(F.monotonically_increasing_id().alias("gid"), "embedding"), "groups")
    members = rows.join(groups, "embedding").select("gid", "vec_id", is_query.alias("is_query"))
    members = stage(members.distinct(), "members")
    first = Window.partitionBy("gid").orderBy("vec_id")
    answers = members.select("gid", "vec_id", F.row_number().over(first).alias("n"))
    answers = stage(answers.where(F.col("n") <= k + 1).select("gid", "vec_id"), "answers")
    asked = members.where("is_query").select("gid").distinct()
    asking = groups.join(asked, "gid", "left_semi")

    n = groups.count()
    dimension = len(groups.first()["embedding"]) if n else 1
    depth = min(MAX_DEPTH, max(0, math.floor(math.log2(trees / share)) + 1))
    forest = Forest(dimension, trees, depth, seed)

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros_like(forest.counts)
        for batch in batches:
            if batch.num_rows:
                for tree, cells in enumerate(forest.cells(unit(batch.column(0))).T):
                    total[tree] += np.bincount(cells, minlength=1 << depth)
        tree, cell = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(tree), pa.array(cell), pa.array(total[tree, cell])], ["tree", "cell", "n"]
        )

    counted = groups.select("embedding").mapInArrow(tally, "tree long, cell long, n long")
    for row in counted.groupBy("tree", "cell").agg(F.sum("n").alias("n")).collect():
        forest.counts[row["tree"], row["cell"]] = row["n"]
    shared = spark.sparkContext.broadcast(forest)
    wanted = share * n

    def block_key(tree, cell, block, query_block):
        return ((tree * (1 << depth) + cell) << 40) + (block << 20) + query_block

    def deal_vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = shared.value
        blocks, query_blocks = forest.blocks()
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, x = batch.column(0).to_numpy(), unit(batch.column(1))
            for tree, cell in enumerate(forest.cells(x).T):
                block, copies = _spread(ids, blocks[tree, cell]), query_blocks[tree, cell]
                at = np.repeat(np.arange(len(ids)), copies)
                nth = np.arange(len(at)) - np.repeat(np.cumsum(copies) - copies, copies)
                yield _rows([block_key(tree, cell[at], block[at], nth)], [ids[at]], [x[at]])

    def deal_queries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = shared.value
        blocks, query_blocks = forest.blocks()
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, x = batch.column(0).to_numpy(), unit(batch.column(1))
            cells = forest.cells(x)
            free = depth - forest.depths(cells, wanted)
            for tree, own_cells in enumerate(cells.T):
                keys, own, vectors = [], [], []
                for i, (cell, f) in enumerate(zip(own_cells, free)):
                    low = (cell >> f) << f
                    below = np.arange(low, low + (1 << f))
                    below = below[forest.counts[tree, below] > 0]
                    for c in below:
                        block = np.arange(blocks[tree, c])
                        mine = _spread(ids[i : i + 1], query_blocks[tree, c : c + 1])[0]
                        keys.append(block_key(tree, c, block, mine))
                        own.append(np.repeat(ids[i], len(block)))
                        vectors.append(np.repeat(x[i : i + 1], len(block), axis=0))
                if keys:
                    yield _rows(keys, own, vectors)

    def score(own: pa.Table, asking: pa.Table) -> pa.Table:
        found = ([], [], [])
        if own.num_rows and asking.num_rows:
            p, q = (
                np.frombuffer(b"".join(t.column("x").to_pylist()), np.float64).reshape(t.num_rows, -1)
                for t in (own, asking)
            )
            gids, qids = own.column("id").to_numpy(), asking.column("id").to_numpy()
            order = np.argsort(gids)
            p, gids = p[order], gids[order]
            for lo in range(0, len(q), QUERY_BLOCK):
                cosine = q[lo : lo + QUERY_BLOCK] @ p.T
                best = np.argsort(-cosine.round(TIE_DIGITS), axis=1, kind="stable")[:, : k + 1]
                found[0].append(np.repeat(qids[lo : lo + QUERY_BLOCK], best.shape[1]))
                found[1].append(gids[best].ravel())
                found[2].append(np.take_along_axis(cosine, best, axis=1).ravel())
        columns = [np.concatenate(c) if c else np.zeros(0) for c in found]
        kinds = (pa.int64(), pa.int64(), pa.float64())
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], ["qid", "gid", "score"])

    dealt = "key long, id long, x binary"
    points = groups.select("gid", "embedding").mapInArrow(deal_vectors, dealt)
    searches = asking.select("gid", "embedding").mapInArrow(deal_queries, dealt)
    found = (
        points.groupBy("key")
        .cogroup(searches.groupBy("key"))
        .applyInArrow(score, "qid long, gid long, score double")
        .groupBy("qid", "gid")
        .agg(F.max("score").alias("score"))
    )
    nearer = F.desc(F.round("score", TIE_DIGITS))
    best = Window.partitionBy("qid").orderBy(nearer, "gid")
    found = found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1)
    found = stage(found.select("qid", "gid", "score"), "found")
    order = Window.partitionBy("qid").orderBy(nearer, "vec_id", "gid")
    found = found.join(answers, "gid").withColumn("n", F.row_number().over(order))
    found = stage(found.where(F.col("n") <= k + 1).select("qid", "gid", "vec_id", "score"), "found_ids")
    queries = members.where("is_query").select(F.col("gid").alias("qid"), F.col("vec_id").alias("query_id"))
    last = Window.partitionBy("query_id", "qid").orderBy(nearer, "vec_id", "gid")
    return (
        queries.join(found, "qid")
        .where((F.col("vec_id") != F.col("query_id")) | (F.col("gid") != F.col("qid")))
        .withColumn("rank", F.row_number().over(last))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op4_hash_forest(spark, sf_dir) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest(vectors, F.col("vec_id") % 50 == 0)
