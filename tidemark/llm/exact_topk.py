"""Exact top-k search by integer inner product.

Vectors are sorted by descending length and cut into blocks. A rotation by the singular vectors of
the corpus (from its d x d Gram matrix, summed in parallel) moves most of every product into the
first coordinates; what the rest can add is at most the product of the two residual lengths
(Cauchy-Schwarz). Each query first meets the block of the longest vectors, which gives it a floor
for its k-th best score; with that floor it meets the other blocks, where chunks whose longest
vector cannot reach the floor, and vectors whose partial sum plus residual bound cannot, are
skipped. What is left is scored exactly in integers, and each block returns k rows a query at most.

What a block's longest vector cannot raise to a query's floor is pruned before anything moves: blocks are in order
of length, so a query is sent to the first blocks up to the last it can reach, found in a list of the blocks'
lengths. Blocks stay whole and queries stream past them, a task holds one block and one batch of
queries; a block that very many queries reach is repeated for each ``PACK`` of them.

Defined cases: vectors that are null, empty or hold null or non-finite components, and rows without
an id, take no part; rows are told apart by a number of their own, so rows that repeat an id, or an id and its
vector, are candidates each, also for each other, and each row of a query's id has its own result;
vectors shorter than the longest are filled with zeros; components and scores beyond 64 bits stop at their limits; other
columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import picked
from tidemark.session import materialize

K = 5
SCALE = 256
QUERY_EVERY = 50
#: Coordinates of the rotated vectors that are summed before the rest is bounded.
HEAD = 16
#: Vectors in a block, queries that meet one copy of a block, queries and vectors compared at once.
BLOCK, PACK, BATCH, CHUNK = 1 << 13, 1 << 15, 1 << 12, 1 << 9
#: Products of integers are exact in doubles below this.
EXACT = float(1 << 53)
#: Pairs scored at a time.
PAIRS = 1 << 16
LEAST = -(1 << 63)
#: Rounding of the rotated sums, relative to the product of the lengths.
SLACK = 1e-9


def quantised(embeddings: DataFrame, vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(row, vec_id, v array<double> of whole numbers, norm2) of the rows that take part; to be written before use."""
    embeddings = picked(embeddings, "vec_id", vector)
    value = F.col(vector).cast("array<double>")
    sound = (F.size(value) > 0) & ~F.exists(value, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform(value, lambda x: F.floor(x * scale).cast("double"))
    return (
        embeddings.where(F.col("vec_id").isNotNull() & F.coalesce(sound, F.lit(False)))
        .select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v"))
        .withColumn("norm2", F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    )


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (lengths == d).all():
        return flat.reshape(-1, d)
    out = np.zeros((len(lengths), d))
    out[np.repeat(np.arange(len(lengths)), lengths), np.concatenate([np.arange(n) for n in lengths])] = flat
    return out


def _gram(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[pa.RecordBatch]:
    total = np.zeros((d, d))
    for batch in batches:
        m = _matrix(batch.column("v"), d)
        total += m.T @ m
    yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()], pa.list_(pa.float64()))], ["gram"])


def rotation(vectors: DataFrame, d: int) -> np.ndarray:
    """Right singular vectors of all ``vectors``, strongest first. The driver sees one d x d matrix."""
    sums = vectors.select("v").mapInArrow(lambda b: _gram(b, d), "gram array<double>")
    cells = sums.select(F.posexplode("gram").alias("i", "g")).groupBy("i").agg(F.sum("g").alias("g"))
    gram = np.zeros(d * d)
    for row in cells.collect():
        gram[row["i"]] = row["g"]
    return np.linalg.eigh(gram.reshape(d, d))[1][:, ::-1].copy()


class Block:
    """Vectors by descending length, with their rotated heads and the lengths of what is left."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, m: np.ndarray, turn: np.ndarray):
        lengths = np.sqrt((m * m).sum(1))
        order = np.argsort(-lengths, kind="stable")
        self.rows, self.ids, self.m, self.lengths = rows[order], ids[order], m[order], lengths[order]
        self.turn = turn[:, : min(HEAD, m.shape[1])]
        self.head = self.m @ self.turn
        self.rest = np.sqrt(np.maximum(self.lengths**2 - (self.head**2).sum(1), 0))

    def best(self, q_rows: np.ndarray, q: np.ndarray, floor: np.ndarray, k: int):
        """(query, vec_id, score): up to k best for each query, by score, then id; never the query's own row.

        ``floor`` is the query's k-th best score elsewhere; anything below cannot be in the result.
        """
        q_length = np.sqrt((q * q).sum(1))
        q_head = q @ self.turn
        q_rest = np.sqrt(np.maximum(q_length**2 - (q_head**2).sum(1), 0))
        whole = float(self.lengths.max(initial=0)) * float(q_length.max(initial=0)) < EXACT
        kind = np.float64 if whole else object
        exact_m, exact_q = (self.m, q) if whole else (np.vectorize(int, otypes=[object])(x) for x in (self.m, q))
        floor = floor.copy()
        found = (np.empty(0, int), np.empty(0, np.int64), np.empty(0, kind))
        for at in range(0, len(self.ids), CHUNK):
            active = np.flatnonzero(q_length * self.lengths[at] * (1 + SLACK) >= floor)
            if not len(active):
                break  # the vectors only get shorter
            part = slice(at, at + CHUNK)
            bound = q_head[active] @ self.head[part].T + np.outer(q_rest[active], self.rest[part])
            bound += SLACK * np.outer(q_length[active], self.lengths[part]) + SLACK
            i, j = np.nonzero((bound >= floor[active, None]) & (q_rows[active, None] != self.rows[None, part]))
            if not len(i):
                continue
            if whole and len(i) * 16 > bound.size:  # so many are left that scoring all is quicker
                scores = (q[active] @ self.m[part].T)[i, j]
            else:
                scores = np.empty(len(i), kind)
                for s in range(0, len(i), PAIRS):
                    e = s + PAIRS
                    scores[s:e] = (exact_q[active[i[s:e]]] * exact_m[at + j[s:e]]).sum(1)
            i, j = active[i], at + j
            keep = scores.astype(float) >= floor[i]
            found = _best(*(np.concatenate([x, y]) for x, y in zip(found, (i[keep], self.ids[j[keep]], scores[keep]))), k)
            # the k-th best so far is the new floor of each query that has k
            rows, counts = np.unique(found[0], return_counts=True)
            last = np.cumsum(counts) - 1
            full = counts == k
            floor[rows[full]] = np.maximum(floor[rows[full]], found[2][last[full]].astype(float))
        return found


def _best(rows: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int):
    """The k best of each row, by score, then id; ordered so."""
    if scores.dtype == object:
        order = np.array(sorted(range(len(rows)), key=lambda x: (rows[x], -scores[x], ids[x])), int)
    else:
        order = np.lexsort((ids, -scores, rows))
    rows, ids, scores = rows[order], ids[order], scores[order]
    first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]]) if len(rows) else np.empty(0, int)
    rank = np.arange(len(rows)) - np.repeat(first, np.diff(np.r_[first, len(rows)]))
    return rows[rank < k], ids[rank < k], scores[rank < k]


_MET = "query_row long, query_id long, vec_id long, score long"


def _meet(batches: Iterator[pa.RecordBatch], turn: np.ndarray, d: int, k: int) -> Iterator[pa.RecordBatch]:
    """Rows by block: its vectors, which are held, then the queries that reach it, which are not."""
    held, parts, block = None, [], None
    for batch in batches:
        place = batch.column("block").to_numpy().astype(np.int64) << 32 | batch.column("split").to_numpy()
        is_query = batch.column("is_query").to_numpy(zero_copy_only=False)
        edges = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (is_query[1:] != is_query[:-1])]) if len(place) else []
        for start, end in zip(edges, np.r_[edges[1:], len(place)].astype(int) if len(edges) else []):
            if place[start] != held:
                held, parts, block = place[start], [], None
            for at in range(start, end, BATCH):
                some = batch.slice(at, min(BATCH, end - at))
                rows, ids = some.column("row").to_numpy(), some.column("vec_id").to_numpy()
                m = _matrix(some.column("v"), d)
                if not is_query[at]:
                    parts.append((rows, ids, m))
                    continue
                if block is None:
                    if not parts:
                        break  # a block without vectors
                    block, parts = Block(*(np.concatenate(x) for x in zip(*parts)), turn), []
                found, near, scores = block.best(rows, m, some.column("floor").to_numpy(), k)
                scores = [max(LEAST, min(-LEAST - 1, int(s))) for s in scores]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows[found]), pa.array(ids[found]), pa.array(near), pa.array(scores, pa.int64())],
                    ["query_row", "query_id", "vec_id", "score"])


def _search(blocks: DataFrame, queries: DataFrame, splits: dict[int, int], turn: np.ndarray, d: int, k: int) -> DataFrame:
    """Every query (block, row, vec_id, v, floor) against the block it was sent to.

    ``splits``: how many copies of a block share its queries, one row a block; blocks not in it are not sent.
    """
    spark = blocks.sparkSession
    copies = spark.createDataFrame(list(splits.items()), "block int, splits int")
    nothing = F.lit(None).cast("double")
    vectors = blocks.join(F.broadcast(copies), "block").select(
        "block", F.explode(F.sequence(F.lit(0), F.col("splits") - 1)).alias("split"), F.lit(False).alias("is_query"),
        "row", "vec_id", "v", nothing.alias("floor"))
    asking = queries.join(F.broadcast(copies), "block").select(
        "block", F.pmod(F.xxhash64("row"), "splits").cast("int").alias("split"), F.lit(True).alias("is_query"),
        "row", "vec_id", "v", "floor")
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(sum(splits.values()), 1 << 15))
    return (
        vectors.unionAll(asking).repartition(tasks, "block", "split").sortWithinPartitions("block", "split", "is_query")
        .mapInArrow(lambda b: _meet(b, turn, d, k), _MET)
    )


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _reach(batches: Iterator[pa.RecordBatch], longest: np.ndarray, d: int) -> Iterator[pa.RecordBatch]:
    """Adds the last block, in order of length, whose longest vector can raise a query to its floor."""
    for batch in batches:
        q = _matrix(batch.column("v"), d)
        length = np.sqrt((q * q).sum(1))
        floor = batch.column("floor").to_numpy()
        reached = np.empty(len(length), np.int32)
        for i in range(len(length)):
            reached[i] = np.searchsorted(-(length[i] * longest * (1 + SLACK) + SLACK), -floor[i], "right") - 1
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(reached)], [*batch.schema.names, "last"])


def _splits(counts: dict[int, int], pack: int) -> dict[int, int]:
    return {block: -(-n // pack) for block, n in counts.items() if n}


def top_k(
    embeddings: DataFrame, k: int = K, query_every: int = QUERY_EVERY, scale: int = SCALE,
    vector: str = "embedding", block: int = BLOCK, pack: int = PACK,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other rows for each row whose id ``query_every`` divides."""
    vectors = materialize(quantised(embeddings, vector, scale), "vectors")
    is_query = F.col("vec_id") % query_every == 0
    size = vectors.agg(
        F.count("*").alias("n"), F.coalesce(F.max(F.size("v")), F.lit(1)).alias("d"), F.count_if(is_query).alias("q")).first()
    n, d = size["n"], size["d"]
    turn = rotation(vectors, d)
    blocks = vectors.repartitionByRange(max(1, -(-n // block)), F.desc("norm2"), F.xxhash64("row")).select(
        F.spark_partition_id().alias("block"), "row", "vec_id", "v", "norm2")
    blocks = materialize(blocks, "blocks")
    # one number a block
    longest = {r["block"]: r["norm2"] for r in blocks.groupBy("block").agg(F.max("norm2").alias("norm2")).collect()}
    last = max(longest, default=0)
    queries = vectors.where(is_query).select("row", "vec_id", "v")
    lowest = F.lit(float("-inf"))
    first = materialize(
        _search(blocks.where("block = 0"), queries.select(F.lit(0).alias("block"), "row", "vec_id", "v", lowest.alias("floor")),
                _splits({0: size["q"]}, pack), turn, d, k),
        "first-block",
    )
    result = ["query_id", "rank", "vec_id", "score"]
    if not last:
        return _top(first, k).select(*result)
    floors = _top(first, k).groupBy(F.col("query_row").alias("row")).agg(
        F.count("*").alias("n"), F.min("score").cast("double").alias("floor"))
    floors = queries.join(floors.where(F.col("n") >= k).select("row", "floor"), "row", "left").select(
        "row", "vec_id", "v", F.coalesce("floor", lowest).alias("floor"))
    lengths = np.sqrt(np.array([longest.get(b, 0.0) for b in range(last + 1)]))
    lengths = np.maximum.accumulate(lengths[::-1])[::-1]  # a block without vectors is as the next
    asking = materialize(floors.mapInArrow(
        lambda b: _reach(b, lengths, d), "row long, vec_id long, v array<double>, floor double, last int"), "queries")
    ends = {r["last"]: r["n"] for r in asking.groupBy("last").agg(F.count("*").alias("n")).collect()}  # at most one row a block
    reached = np.cumsum(np.array([ends.get(b, 0) for b in range(last + 1)])[::-1])[::-1]
    splits = _splits({b: int(reached[b]) for b in range(1, last + 1)}, pack)
    sent = asking.where("last > 0").select(
        F.explode(F.sequence(F.lit(1), F.col("last"))).alias("block"), "row", "vec_id", "v", "floor")
    rest = _search(blocks.where("block > 0"), sent, splits, turn, d, k)
    return _top(first.unionAll(rest), k).select(*result)
