"""Approximate nearest neighbours by a forest of random-projection trees.

*Index.* Each of ``TREES`` trees halves the vectors level by level: a level has one random direction, and every node
of it the median of its vectors along that direction, taken from a bounded sample (``SAMPLE`` vectors). All rows are
indexed: the trees name a leaf for every vector. Neighbouring leaves are stored together in blocks of about
``BLOCK`` vectors; a shard that holds more, as equal vectors may, is dealt over several blocks by id.

*Search.* One priority queue is shared by the roots of all trees. The open node with the least squared distance
to the query, summed over the borders that were crossed, is opened next, until the leaves taken hold enough vectors.
How many are enough is measured: queries from the sample are searched in the sample and against brute force, and the
share of all vectors is taken at which ``RECALL`` of the true neighbours were found.

*Reranking.* In the task that holds a block, the cosine of each query to the vectors of its leaves is computed in double
precision on the original vectors, and the best ``k`` of a block are kept; they are merged over blocks and trees.

Defined results: vectors that are null, zero, of another length than most, or hold null or non-finite components take no
part, nor do rows without an id; rows that repeat an id count once (with their best score), and none is its own neighbour; ties go to
the smaller id; with fewer than ``k`` candidates all that were found are returned; an empty table gives no rows; components may be as
small or large as doubles are; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.llm.common import map_texts, written

TREES = 8
LEAF = 128            # vectors of a leaf that the depth aims at
DEEPEST = 14
BLOCK = 8192
SAMPLE = 20_000
PROBES = 96           # queries that measure the search
RECALL = 0.97


def valid(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, v) of the vectors that take part, v as doubles."""
    rows = vectors.select(F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{embedding}`").cast("array<double>").alias("v")).where("vec_id is not null and size(v) > 0")
    rows = rows.where(F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0))
    most = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == (most.n if most else 0))


@dataclass
class Forest:
    directions: np.ndarray     # trees x dim x depth
    borders: np.ndarray        # trees x nodes
    depth: int

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """Leaf of every row in every tree."""
        out = np.empty((len(x), len(self.directions)), dtype=np.int32)
        unit = x / np.linalg.norm(x, axis=1, keepdims=True)
        for t, directions in enumerate(self.directions):
            along, node = unit @ directions, np.zeros(len(x), dtype=np.int64)
            for level in range(self.depth):
                node = 2 * node + 1 + (along[:, level] > self.borders[t, node])
            out[:, t] = node - ((1 << self.depth) - 1)
        return out

    def search(self, q: np.ndarray) -> Iterator[tuple[int, int]]:
        """(tree, leaf) in the order of the shared queue."""
        along = np.einsum("d,tdl->tl", q / np.linalg.norm(q), self.directions).tolist()
        queue, inner = [(0.0, t, 0, 0) for t in range(len(along))], (1 << self.depth) - 1
        borders = self.borders
        while queue:
            far, t, node, level = heapq.heappop(queue)
            while node < inner:
                gap = along[t][level] - borders[t, node]
                right = gap > 0
                heapq.heappush(queue, (far + gap * gap, t, 2 * node + 2 - right, level + 1))
                node, level = 2 * node + 1 + right, level + 1
            yield t, node - inner


def grow(sample: np.ndarray, rows: int, trees: int, leaf: int, seed: int = 7) -> Forest:
    depth = int(np.clip(np.ceil(np.log2(max(rows, 1) / leaf)), 0, min(DEEPEST, np.log2(max(len(sample), 1)))))
    trees = trees if depth else 1
    rng, (n, dim) = np.random.default_rng(seed), sample.shape
    unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    directions = np.zeros((trees, dim, depth))
    borders = np.zeros((trees, (1 << depth) - 1))
    for t in range(trees):
        drawn = rng.standard_normal((dim, depth))
        directions[t] = np.linalg.qr(drawn)[0] if depth <= dim else drawn / np.linalg.norm(drawn, axis=0)
        along, parts = unit @ directions[t], [np.arange(n)]
        for level in range(depth):
            below = []
            for i, part in enumerate(parts):
                border = float(np.median(along[part, level])) if len(part) else 0.0
                borders[t, (1 << level) - 1 + i] = border
                right = along[part, level] > border
                below += [part[~right], part[right]]
            parts = below
    return Forest(directions, borders, depth)


def cosines(v: np.ndarray, norms: np.ndarray, q: np.ndarray) -> np.ndarray:
    """In double precision, summed in the same order for every row: equal vectors get equal scores."""
    return (v * q).sum(axis=1) / (norms * np.sqrt((q * q).sum()))


def enough(forest: Forest, sample: np.ndarray, k: int, recall: float = RECALL) -> float:
    """Share of all vectors that the leaves of a search must hold to find ``recall`` of the true neighbours."""
    n = len(sample)
    leaf, norms = forest.leaves(sample), np.sqrt((sample * sample).sum(axis=1))
    size = np.stack([np.bincount(column, minlength=1 << forest.depth) for column in leaf.T])
    needed = []
    for i in range(0, n, max(1, n // PROBES)):
        score = cosines(sample, norms, sample[i])
        score[i] = -2
        seen, open_ = 0, [tuple(leaf[j]) for j in np.argsort(-score)[:min(k, n - 1)]]
        for t, at in forest.search(sample[i]):
            seen += size[t, at]
            found = [x for x in open_ if x[t] == at]
            needed += [seen] * len(found)
            open_ = [x for x in open_ if x[t] != at]
            if not open_:
                break
    return float(np.quantile(needed, recall, method="higher")) / n if needed else 1.0


def neighbours(vectors: DataFrame, is_query: Column, k: int = 5, trees: int = TREES, leaf: int = LEAF, sample_rows: int = SAMPLE,
               recall: float = RECALL, block: int = BLOCK, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found for every row with ``is_query``, a condition on ``vec_id``."""
    spark = vectors.sparkSession
    kind = vectors.schema[vec_id].dataType.simpleString()
    rows = valid(vectors, vec_id, embedding)
    n = rows.count()
    result = f"query_id {kind}, vec_id {kind}, score double"
    if n == 0:
        return spark.createDataFrame([], result).select("query_id", F.lit(1).alias("rank"), "vec_id", "score")
    share = min(1.0, sample_rows / n)
    part = rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)) < int(share * (1 << 30)) + 1).limit(2 * sample_rows)
    sample = scaled(np.array([r.v for r in part.select("vec_id", "v").orderBy("vec_id").collect()] or [rows.first().v]))
    forest = grow(sample, n, trees, leaf)
    budget = min(enough(forest, sample, k, recall), float(len(forest.directions))) * n

    def count(batch: pa.RecordBatch):
        at = forest.leaves(matrix(batch.column(0)))
        key = at + (np.arange(at.shape[1]) << forest.depth)
        value, times = np.unique(key, return_counts=True)
        yield {"place": value, "n": times}

    # at most trees * 2**DEEPEST rows
    sizes = np.zeros((len(forest.directions), 1 << forest.depth), dtype=np.int64)
    for place, times in map_texts(rows.select("v"), count, "place int, n long").groupBy("place").agg(F.sum("n")).collect():
        sizes[place >> forest.depth, place & ((1 << forest.depth) - 1)] = times
    shift = max(0, int(np.floor(np.log2(max(1, block * (1 << forest.depth) / n)))))
    shift = min(shift, forest.depth)
    blocks = np.maximum(1, -(-sizes.reshape(len(sizes), -1, 1 << shift).sum(axis=2) // block))   # blocks of each shard

    def place(batch: pa.RecordBatch):
        x = matrix(batch.column(1))
        at, salt = forest.leaves(x), batch.column(2).to_numpy()
        raw = [v.tobytes() for v in x]
        for t in range(at.shape[1]):
            shard = at[:, t] >> shift
            yield {"tree": np.full(len(x), t), "shard": shard, "block": salt % blocks[t, shard], "kind": np.zeros(len(x), int),
                   "id": batch.column(0), "leaf": at[:, t], "leaves": [None] * len(x), "v": raw}

    def probe(batch: pa.RecordBatch):
        out = {c: [] for c in ("tree", "shard", "block", "kind", "id", "leaf", "leaves", "v")}
        for id_, q in zip(batch.column(0).to_pylist(), matrix(batch.column(1))):
            taken, held = {}, 0
            for t, at in forest.search(q):
                taken.setdefault((t, at >> shift), []).append(at)
                held += sizes[t, at]
                if held >= budget:
                    break
            for (t, shard), leaves in taken.items():
                for b in range(blocks[t, shard]):
                    for c, value in zip(out, (t, shard, b, 1, id_, None, leaves, q.tobytes())):
                        out[c].append(value)
        yield out

    schema = f"tree int, shard int, block int, kind int, id {kind}, leaf int, leaves array<int>, v binary"
    salt = F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(1 << 30))
    index = map_texts(rows.select("vec_id", "v", salt.alias("salt")), place, schema)
    probes = map_texts(rows.where(is_query).select("vec_id", "v"), probe, schema)
    keys = ["tree", "shard", "block"]
    dealt = index.unionByName(probes).repartition(*keys).sortWithinPartitions(*keys, "kind")

    def rerank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, leaves, raw, ready = None, [], [], [], None
        for batch in batches:
            out = {"query_id": [], "vec_id": [], "score": []}
            for *at, what, id_, leaf_, wanted, v in zip(*[c.to_pylist() for c in batch.columns]):
                if at != key:
                    key, ids, leaves, raw, ready = at, [], [], [], None
                if what == 0:
                    ids.append(id_)
                    leaves.append(leaf_)
                    raw.append(v)
                    continue
                if not ids:
                    continue
                if ready is None:
                    block_ = np.frombuffer(b"".join(raw)).reshape(len(ids), -1)
                    ready = block_, np.sqrt((block_ * block_).sum(axis=1)), np.array(leaves) & ((1 << shift) - 1), np.array(ids)
                own = np.zeros(1 << shift, dtype=bool)
                own[np.array(wanted) & ((1 << shift) - 1)] = True
                pick = np.flatnonzero(own[ready[2]] & (ready[3] != id_))
                score = cosines(ready[0][pick], ready[1][pick], np.frombuffer(v))
                best = np.lexsort((ready[3][pick], -score))
                # equal ids would fill the list: keep the first k different ones
                _, first = np.unique(ready[3][pick][best], return_index=True)
                for j in best[np.sort(first)[:k]]:
                    out["query_id"].append(id_)
                    out["vec_id"].append(ready[3][pick[j]].item())
                    out["score"].append(float(score[j]))
            if out["score"]:
                yield pa.RecordBatch.from_pydict({c: pa.array(x, batch.schema.field("id").type if c != "score" else pa.float64()) for c, x in out.items()})

    found = dealt.mapInArrow(rerank, result)
    found = written(found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")), "neighbours")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return scaled(flat.reshape(len(column), -1))


def scaled(x: np.ndarray) -> np.ndarray:
    """Each row times the power of two that brings its largest component between 0.5 and 1. That is exact and leaves cosines as they
    are, but squares of very small or large components neither vanish nor overflow."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])
