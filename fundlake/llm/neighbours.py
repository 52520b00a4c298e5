"""Approximate nearest neighbours by inner product, with learned partitions.

From a bounded sample a graph of nearest neighbours is made and cut into parts of equal size with few edges between them.
A small network learns to name the parts that hold a vector's neighbours. Every vector is indexed in its most probable
part; a query goes to its most probable parts, as many as the sample needs for the recall asked for, and all vectors of
those parts are ranked by their exact inner product. Parts are searched in blocks, so a part may be of any size, and a
block answers only with what can still be among the nearest: what does not fall behind the query's best in the sample,
which every query is compared with.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fundlake.llm.common import first_by_hash, read, stage

#: Vectors the graph and the network are made from (in the order of a hash of the id), and vectors per part and block.
SAMPLE, PART, BLOCK = 9_000, 1_500, 2_000
#: A part needs at least so many vectors of the sample, so there are at most SAMPLE / LEAST parts.
LEAST = 60


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id`` and ``embedding`` of the vectors that take part: not null, not zero, all components finite numbers, of
    the most frequent length (the larger of two). Rows that repeat count once."""
    fine = "embedding is not null and vec_id is not null and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('Infinity')) and exists(embedding, x -> x != 0)"
    kept = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<float>")).where(fine)
    length = kept.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return kept.where(F.size("embedding") == (length["d"] if length else 0))


def nearest(base: np.ndarray, queries: np.ndarray, k: int, own: np.ndarray | None = None) -> np.ndarray:
    """Places of the ``k`` rows of ``base`` with the largest inner product, in no order; ``own`` is left out."""
    found = np.empty((len(queries), min(k, len(base))), dtype=np.int64)
    for at in range(0, len(queries), 1000):
        scores = queries[at : at + 1000] @ base.T
        if own is not None:
            scores[np.arange(len(scores)), own[at : at + 1000]] = -np.inf
        found[at : at + 1000] = np.argpartition(-scores, found.shape[1] - 1, axis=1)[:, : found.shape[1]]
    return found


def balanced_cut(vectors: np.ndarray, graph: np.ndarray, parts: int, passes: int = 6, slack: float = 1.05) -> np.ndarray:
    """Part of each node: halved along principal directions, then nodes move to the part of most of their neighbours
    while parts stay within ``slack`` of equal size."""
    part = np.zeros(len(vectors), dtype=np.int64)

    def halve(rows: np.ndarray, first: int, count: int) -> None:
        if count == 1:
            part[rows] = first
            return
        own = vectors[rows] - vectors[rows].mean(0)
        direction = np.linalg.eigh(own.T @ own)[1][:, -1]
        order = rows[np.argsort(own @ direction, kind="stable")]
        cut = len(rows) * (count // 2) // count
        halve(order[:cut], first, count // 2)
        halve(order[cut:], first + count // 2, count - count // 2)

    halve(np.arange(len(vectors)), 0, parts)
    most, sizes = int(len(vectors) / parts * slack) + 1, np.bincount(part, minlength=parts)
    both = [[] for _ in vectors]
    for node, others in enumerate(graph.tolist()):
        both[node] += others
        for other in others:
            both[other].append(node)
    for _ in range(passes):
        moved = 0
        for node, others in enumerate(both):
            pull = np.bincount(part[others], minlength=parts)
            now = part[node]
            pull[sizes >= most] = np.minimum(pull[sizes >= most], pull[now])
            to = int(pull.argmax())
            if pull[to] > pull[now]:
                sizes[now] -= 1
                sizes[to] += 1
                part[node], moved = to, moved + 1
        if not moved:
            break
    return part


@dataclass
class Router:
    """One hidden layer; probabilities of the parts that hold a vector's neighbours."""

    centre: np.ndarray
    scale: float
    first: np.ndarray
    first_bias: np.ndarray
    second: np.ndarray
    second_bias: np.ndarray

    def probabilities(self, vectors: np.ndarray) -> np.ndarray:
        hidden = np.maximum((vectors - self.centre) * self.scale @ self.first + self.first_bias, 0)
        logits = hidden @ self.second + self.second_bias
        out = np.exp(logits - logits.max(1, keepdims=True))
        return out / out.sum(1, keepdims=True)


def train(vectors: np.ndarray, targets: np.ndarray, hidden: int = 128, epochs: int = 20, rate: float = 3e-3) -> Router:
    """Fit a router to rows of target probabilities by Adam; the same input gives the same router."""
    pick, d, parts = np.random.default_rng(0), vectors.shape[1], targets.shape[1]
    centre = vectors.mean(0)
    scale = 1 / max(1e-12, float((vectors - centre).std()))
    weights = [pick.normal(0, d**-0.5, (d, hidden)), np.zeros(hidden), pick.normal(0, hidden**-0.5, (hidden, parts)), np.zeros(parts)]
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]
    step = 0
    for _ in range(epochs):
        order = pick.permutation(len(vectors))
        for at in range(0, len(order), 256):
            rows = order[at : at + 256]
            router = Router(centre, scale, *weights)
            x = (vectors[rows] - centre) * scale
            inner = np.maximum(x @ weights[0] + weights[1], 0)
            error = (router.probabilities(vectors[rows]) - targets[rows]) / len(rows)
            back = (error @ weights[2].T) * (inner > 0)
            gradients = [x.T @ back, back.sum(0), inner.T @ error, error.sum(0)]
            step += 1
            for w, g, (m, v) in zip(weights, gradients, moments, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Router(centre, scale, *weights)


@dataclass
class Index:
    router: Router | None
    parts: int
    probes: int

    def rank(self, vectors: np.ndarray) -> np.ndarray:
        """Parts of each vector, the most probable first."""
        if self.router is None:
            return np.zeros((len(vectors), 1), dtype=np.int64)
        return np.argsort(-self.router.probabilities(vectors), axis=1, kind="stable")


def learn(sample: np.ndarray, rows: int, k: int, recall: float) -> Index:
    """Cut the sample's graph, train the router, and take as many probes as ``recall`` needs on the sample itself."""
    parts = min(rows // PART, len(sample) // LEAST)
    if parts < 2:
        return Index(None, 1, 1)
    graph = nearest(sample, sample, k, np.arange(len(sample)))
    part = balanced_cut(sample, graph, parts)
    targets = np.zeros((len(sample), parts))
    np.add.at(targets, (np.repeat(np.arange(len(sample)), graph.shape[1]), part[graph].ravel()), 1.0)
    targets[np.arange(len(sample)), part] += 1
    # A fifth of the sample is kept from the network, to count the probes that vectors it has not seen need.
    seen = np.arange(len(sample)) % 5 != 0
    router = train(sample[seen], (targets / targets.sum(1, keepdims=True))[seen])
    index = Index(router, parts, parts)
    ranks = index.rank(sample)
    place = np.argsort(ranks, axis=1)
    depth = np.take_along_axis(place[~seen], ranks[:, 0][graph[~seen]], axis=1)
    index.probes = next((p for p in range(1, parts) if (depth < p).mean() >= recall), parts)
    return index


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1) if len(column) else np.empty((0, 0))


def best(base: np.ndarray, ids: np.ndarray, queries: np.ndarray, own: np.ndarray, bounds: np.ndarray, k: int) -> Iterator[tuple[int, list, list]]:
    """Ids and exact scores of the ``k`` nearest of each query, ties to the smaller id; the query's own id and what is
    under the query's bound are left out.

    Candidates are taken from a matrix product with some slack, then scored one by one, so that equal vectors tie.
    """
    rough = queries @ base.T
    rough[(own[:, None] == ids[None, :]) | (rough < bounds[:, None])] = -np.inf
    for n, scores in enumerate(rough):
        left = int((scores > -np.inf).sum())
        if not left:
            continue
        limit = np.partition(scores, len(scores) - min(k, left))[len(scores) - min(k, left)]
        near = np.flatnonzero(scores >= limit - 1e-9 * (1 + abs(limit)))
        exact = (base[near] * queries[n]).sum(1)
        order = np.lexsort((ids[near], -exact))[:k]
        yield n, ids[near][order].tolist(), exact[order].tolist()


def search(vectors: DataFrame, queries: DataFrame, k: int = 20, recall: float = 0.93) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the ``k`` nearest vectors found for each query.

    Both have vec_id and embedding; a query is not its own neighbour. Nearness is the inner product in double precision.
    Vectors that ``usable`` leaves out take no part, as query or as candidate; without any, the result is empty.
    """
    base, asked = stage(usable(vectors), "vectors"), usable(queries)
    spark = base.sparkSession
    rows = base.count()
    sample = first_by_hash(base, SAMPLE, rows, "vec_id", "embedding").toPandas()
    sample = sample.drop_duplicates("vec_id")
    matrix = np.array(sample["embedding"].tolist(), dtype=np.float32)
    index = spark.sparkContext.broadcast(learn(matrix.astype(np.float64), rows, k, recall))
    known = spark.sparkContext.broadcast((matrix, sample["vec_id"].to_numpy(dtype=np.int64)))

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each query's score that ``k`` vectors of the sample reach besides itself: no nearest one is under it."""
        base = known.value[0].astype(np.float64)
        for batch in batches:
            asked, bounds = _matrix(batch.column("embedding")), np.full(batch.num_rows, -np.inf)
            for at in range(0, len(asked) if len(base) > k else 0, 500):
                scores = np.partition(asked[at : at + 500] @ base.T, len(base) - k - 1, axis=1)[:, len(base) - k - 1]
                bounds[at : at + 500] = scores - 1e-9 * (1 + np.abs(scores))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(bounds)], [*batch.schema.names, "bound"])

    def route(kind: int, probes: int):
        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ranks = index.value.rank(_matrix(batch.column("embedding")))[:, :probes]
                at = np.repeat(np.arange(len(ranks)), ranks.shape[1] if len(ranks) else 0)
                columns = [batch.column(name).take(pa.array(at)) for name in ("vec_id", "embedding", "bound")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ranks.ravel().astype(np.int32)), pa.array(np.full(len(at), kind, np.int32)), *columns],
                    ["part", "kind", "vec_id", "embedding", "bound"],
                )

        return assign

    schema = "part int, kind int, vec_id long, embedding array<float>, bound double"
    indexed = stage(base.withColumn("bound", F.lit(None).cast("double")).mapInArrow(route(0, 1), schema), "indexed")
    sizes = indexed.groupBy("part").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))  # a row per part
    sizes = F.broadcast(spark.createDataFrame(sizes.collect(), "part int, blocks int"))
    held = indexed.join(sizes, "part").withColumn("block", F.pmod(F.xxhash64("vec_id"), "blocks").cast("int"))
    bounded = asked.mapInArrow(bound, "vec_id long, embedding array<float>, bound double")
    sent = bounded.mapInArrow(route(1, index.value.probes), schema).join(sizes, "part")
    sent = sent.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = held.unionByName(sent).drop("blocks").repartition("part", "block").sortWithinPartitions("part", "block", "kind")

    def answers(base: np.ndarray, names: np.ndarray, asked: np.ndarray, own: np.ndarray, bounds: np.ndarray) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(own) if len(base) else 0, 256):
            found = list(best(base, names, asked[at : at + 256], own[at : at + 256], bounds[at : at + 256], k))
            columns = [
                pa.array([own[at + n] for n, near, _ in found for _ in near], pa.int64()),
                pa.array([x for _, near, _ in found for x in near], pa.int64()),
                pa.array([x for _, _, scores in found for x in scores], pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["query_id", "vec_id", "score"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pieces() -> Iterator[tuple]:
            for batch in batches:
                keys = np.stack([batch.column(name).to_numpy() for name in ("part", "block", "kind")], axis=1)
                cuts = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(1), [True]])) if len(keys) else []
                for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                    bounds = batch.column("bound").to_numpy(zero_copy_only=False)[a:b]
                    yield tuple(keys[a].tolist()), batch.column("vec_id").to_numpy()[a:b], _matrix(batch.column("embedding").slice(a, b - a)), bounds

        for _, group in groupby(pieces(), key=lambda piece: piece[0][:2]):
            base, ids = [], []
            matrix = None
            for (_, _, kind), own, values, bounds in group:
                if kind == 0:
                    base.append(values)
                    ids.append(own)
                    continue
                if not base:
                    continue
                if matrix is None:
                    matrix, names = np.concatenate(base), np.concatenate(ids)
                yield from answers(matrix, names, values, own, bounds)

    def near_sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = known.value[0].astype(np.float64)
        for batch in batches:
            asked, own = _matrix(batch.column("embedding")), batch.column("vec_id").to_numpy()
            yield from answers(base, known.value[1], asked, own, np.full(len(own), -np.inf))

    schema = "query_id long, vec_id long, score double"
    found = met.mapInArrow(compare, schema).union(asked.mapInArrow(near_sample, schema)).distinct()
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings", vec_id="long", embedding="array<float>")
    return search(vectors, vectors.where("vec_id % 20 = 0"))
