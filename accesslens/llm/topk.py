"""Exact top-k inner products with one KD-tree per shard.

Components become ``floor(256 * x)``. Median splits of about ``SAMPLE`` rows part the space
into at most ``CELLS`` cells; the rows of a cell are dealt by row over its shards, so rows
alike and repeated ids spread as well. The sample only decides who is near whom: every row
is in a shard. A shard is built into a KD-tree: median splits on the widest side,
every node with the tight bounding box of its points and its smallest id. A box
bounds the inner product with a query: ``max(q * low, q * high)`` summed over the
sides. The search visits nodes best bound first and ends when no open node can
beat the k-th result so far.

Two passes: each query first searches its own shard only, among the rows near it, which
gives a k-th score that holds for the whole table; then query and score go to the shards of
those cells whose box can reach that score, where it cuts nodes from the start. In a task a
shard's vectors come first, then the queries in a stream, so a task holds one tree and a batch
of queries. Results of shards are merged by a partial aggregate.

Order: higher score, then smaller id. A query's own row is any row with its id.
Defined cases: vectors that are null or hold null or non-finite components take
no part, nor do rows with a null id; vectors are only compared with vectors of
their length; rows alike count as rows of their own; fewer candidates give
fewer ranks; an empty table gives an empty result; inner products that a double
cannot hold exactly are taken in whole numbers of any size and kept within a
long; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accesslens.llm.common import stored
from accesslens.llm.negatives import Cut, cells_of, cuts_of, vectors_in
from accesslens.operators.select import top_per_group

SHARD = 4096  # vectors per shard, on average
CELLS = 1024
SAMPLE = 16384  # rows that the cells are cut by
LEAF = 64
SCALE = 256
LONG = 2**63 - 1


def whole(vectors: np.ndarray) -> np.ndarray:
    """``floor(256 * x)`` as doubles, which hold it exactly."""
    return np.floor(vectors.astype(np.float64) * SCALE)


class Tree:
    """Nodes in arrays; a node's points are ``order[first:last]``."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, leaf: int = LEAF):
        self.order = np.arange(len(ids))
        first, last, low, high, children = [], [], [], [], []
        open_ = [(0, len(ids), -1)]
        while open_:
            a, b, parent = open_.pop()
            node = len(first)
            own = points[self.order[a:b]]
            first.append(a)
            last.append(b)
            low.append(own.min(axis=0))
            high.append(own.max(axis=0))
            children.append([])
            if parent >= 0:
                children[parent].append(node)
            wide = high[-1] - low[-1]
            if b - a > leaf and wide.size and wide.max() > 0:
                side = int(np.argmax(wide))
                middle = (b - a) // 2
                by = np.argpartition(own[:, side], middle)
                self.order[a:b] = self.order[a:b][by]
                open_ += [(a, a + middle, node), (a + middle, b, node)]
        self.ids, self.points = ids[self.order], points[self.order]
        self.first, self.last, self.children = first, last, children
        self.low, self.high = np.array(low), np.array(high)
        self.least = np.array([self.ids[a:b].min() for a, b in zip(first, last)])

    def exact(self, queries: np.ndarray) -> bool:
        """Whether sums of products stay below 2^53, where doubles are exact."""
        if not queries.size:
            return True
        most = np.maximum(np.abs(self.low[0]), np.abs(self.high[0])).max() * np.abs(queries).max()
        return most * queries.shape[1] < 2**53

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Upper bounds of the inner product, queries by nodes."""
        return np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T

    def search(self, queries: np.ndarray, own: np.ndarray, floors: np.ndarray, k: int) -> list[list[tuple[int, int]]]:
        """Per query up to k of (score, -id) that are no worse than its floor, best first."""
        if not self.exact(queries):
            return [self._wide(q, i, k) for q, i in zip(queries, own)]
        bounds = self.bounds(queries)
        found = []
        for q, me, floor, bound in zip(queries, own, floors, bounds):
            best: list[tuple[float, int]] = []  # heap of (score, -id), worst first
            open_ = [(-bound[0], int(self.least[0]), 0)]
            while open_:
                top, least, node = heapq.heappop(open_)
                # A node's best possible entry; entries below the k-th or the floor cannot count.
                if -top < floor or len(best) == k and (-top, -least) <= best[0]:
                    break
                if self.children[node]:
                    for child in self.children[node]:
                        heapq.heappush(open_, (-bound[child], int(self.least[child]), child))
                    continue
                a, b = self.first[node], self.last[node]
                scores = self.points[a:b] @ q
                keep = np.flatnonzero((scores >= max(floor, best[0][0] if len(best) == k else -np.inf)) & (self.ids[a:b] != me))
                for at in keep.tolist():
                    entry = (scores[at], -int(self.ids[a + at]))
                    if len(best) < k:
                        heapq.heappush(best, entry)
                    elif entry > best[0]:
                        heapq.heapreplace(best, entry)
            found.append([(int(s), i) for s, i in sorted(best, reverse=True)])
        return found

    def _wide(self, query: np.ndarray, me: int, k: int) -> list[tuple[int, int]]:
        q = [int(x) for x in query]
        every = (
            (max(-LONG, min(LONG, sum(a * int(b) for a, b in zip(q, p)))), -int(i))
            for i, p in zip(self.ids, self.points)
            if i != me
        )
        return heapq.nlargest(k, every)


def searched(rows: DataFrame, k: int) -> DataFrame:
    """``rows``: shard, kind (0 vectors, 1 queries), id, vector, floor. Rows ``query_id``, ``vec_id``,
    ``score``: each query's best of the shards it was sent to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, ids, vectors, trees = None, [], [], None
        for batch in batches:
            shards = batch.column("shard").to_numpy()
            kinds = batch.column("kind").to_numpy()
            names = batch.column("id").to_numpy()
            floors = batch.column("floor").to_numpy(zero_copy_only=False).astype(np.float64)
            lists = batch.column("vector")
            ends = lists.offsets.to_numpy()
            flat = lists.values.to_numpy(zero_copy_only=False)
            edges = np.flatnonzero(np.diff(shards) | np.diff(kinds)) + 1
            for a, b in zip([0, *edges], [*edges, len(shards)]):
                if a == b:
                    continue
                if shards[a] != shard:
                    shard, ids, vectors, trees = shards[a], [], [], None
                own = [flat[ends[i] : ends[i + 1]] for i in range(a, b)]
                if kinds[a] == 0:
                    ids.extend(names[a:b].tolist())
                    vectors.extend(own)
                    continue
                trees = forest(ids, vectors) if trees is None else trees
                for c in range(a, b, 256):
                    yield answers(trees, names[c : min(b, c + 256)], own[c - a : c - a + 256], floors[c : min(b, c + 256)])

    def forest(ids: list[int], vectors: list[np.ndarray]) -> dict[int, Tree]:
        sides = np.array([len(v) for v in vectors], np.int64)
        found = {}
        for n in set(sides.tolist()):
            at = np.flatnonzero(sides == n)
            points = whole(np.array([vectors[i] for i in at]).reshape(len(at), n))
            found[n] = Tree(np.array(ids, np.int64)[at], points)
        return found

    def answers(trees: dict[int, Tree], names: np.ndarray, vectors: list[np.ndarray], floors: np.ndarray) -> pa.RecordBatch:
        out: list[tuple[int, int, int]] = []
        sides = np.array([len(v) for v in vectors])
        for n, tree in trees.items():
            at = np.flatnonzero(sides == n)
            if len(at):
                queries = whole(np.array([vectors[i] for i in at]).reshape(len(at), n))
                for i, best in zip(at, tree.search(queries, names[at], floors[at], k)):
                    out += [(int(names[i]), -other, score) for score, other in best]
        columns = [pa.array([r[c] for r in out], pa.int64()) for c in range(3)]
        return pa.RecordBatch.from_arrays(columns, ["query_id", "vec_id", "score"])

    dealt = rows.repartition("shard").sortWithinPartitions("shard", "kind")
    return dealt.mapInArrow(run, "query_id long, vec_id long, score long")


def merged(found: DataFrame, k: int) -> DataFrame:
    """The k best per query; every task cuts to k before anything moves."""
    order = [F.desc("score"), F.asc("vec_id")]
    best = top_per_group(found, "query_id", order, k)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(*order))
    return best.select("query_id", rank.cast("int").alias("rank"), "vec_id", "score")


def dealt_cells(rows: DataFrame, cuts: list[Cut]) -> DataFrame:
    """``rows`` (row, id, vector) with their ``cell``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = vectors_in(batch.column("vector"))
            sides = np.array([len(v) for v in vectors], np.int64)
            cells = np.zeros(len(vectors), np.int64)
            for n in set(sides.tolist()):
                at = np.flatnonzero(sides == n)
                cells[at] = cells_of(whole(np.array([vectors[i] for i in at]).reshape(len(at), n)), cuts)
            yield pa.RecordBatch.from_pydict({c: batch.column(c) for c in batch.schema.names} | {"cell": cells})

    kind = rows.schema["vector"].dataType.simpleString()
    return rows.mapInArrow(run, f"row long, id long, vector {kind}, cell long")


def boxes_of(dealt: DataFrame, sides: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """The box of the vectors of one length in each cell, of which there are at most ``CELLS``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            points = whole(np.array(vectors_in(batch.column("vector"))).reshape(batch.num_rows, sides))
            cells = batch.column("cell").to_numpy()
            for cell in np.unique(cells).tolist():
                own = points[cells == cell]
                low, high = own.min(axis=0), own.max(axis=0)
                if cell in found:
                    low, high = np.minimum(low, found[cell][0]), np.maximum(high, found[cell][1])
                found[cell] = low, high
        doubles = pa.list_(pa.float64())
        lows, highs = ([f[i] for f in found.values()] for i in range(2))
        columns = [pa.array(list(found), pa.int64()), pa.array(lows, doubles), pa.array(highs, doubles)]
        yield pa.RecordBatch.from_arrays(columns, ["cell", "low", "high"])

    some = dealt.filter(F.size("vector") == sides).select("cell", "vector")
    each = some.mapInArrow(run, "cell long, low array<double>, high array<double>")
    each = each.select("cell", F.posexplode(F.arrays_zip("low", "high")).alias("d", "x"))
    per = each.groupBy("cell", "d").agg(F.min("x.low").alias("low"), F.max("x.high").alias("high"))
    rows = per.groupBy("cell").agg(F.sort_array(F.collect_list(F.struct("d", "low", "high"))).alias("x"))
    rows = rows.select("cell", F.col("x.low").alias("low"), F.col("x.high").alias("high")).collect()
    return {r["cell"]: (np.array(r["low"]), np.array(r["high"])) for r in rows}


def reaching(queries: DataFrame, boxes: dict[int, tuple[np.ndarray, np.ndarray]], sides: int, count: int) -> DataFrame:
    """``queries`` with ``to``: the cells whose box can reach their floor; all ``count`` for queries of other lengths."""
    cells = np.array(sorted(boxes), np.int64)
    low, high = (np.array([boxes[c][i] for c in cells.tolist()]).reshape(len(cells), sides) for i in range(2))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for vector, floor in zip(vectors_in(batch.column("vector")), batch.column("floor").to_pylist()):
                if len(vector) != sides or not boxes:
                    found.append(list(range(count)))
                    continue
                q = whole(vector)
                up, down = np.maximum(q, 0), np.minimum(q, 0)
                slack = 1e-9 * (up @ np.abs(high).T - down @ np.abs(low).T)  # of sums beyond 2^53
                # What overflows is no number, and no bound.
                found.append(cells[~(up @ high.T + down @ low.T + slack < floor)].tolist())
            columns = {c: batch.column(c) for c in batch.schema.names}
            yield pa.RecordBatch.from_pydict(columns | {"to": pa.array(found, pa.list_(pa.int64()))})

    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in queries.schema.fields)
    return queries.mapInArrow(run, f"{kind}, to array<long>")


def visits_of(
    queries: DataFrame, boxes: dict[int, tuple[np.ndarray, np.ndarray]], sides: int, count: int, parts: DataFrame
) -> DataFrame:
    """``shard``, ``kind``, ``id``, ``vector``, ``floor``: ``queries`` (home, id, vector, floor) for all shards that
    can hold a result but their own; ``parts`` (cell, parts) has at most ``count`` rows."""
    sent = reaching(queries, boxes, sides, count).withColumn("cell", F.explode("to")).join(F.broadcast(parts), "cell")
    sent = sent.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    sent = sent.select(shard_of("cell", "part").alias("shard"), F.lit(1).alias("kind"), "id", "vector", "floor", "home")
    return sent.filter("shard <> home").drop("home")


def shard_of(cell: str, part: str) -> Column:
    return F.shiftleft(cell, 32) + F.col(part)


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, shard: int = SHARD) -> DataFrame:
    """``vectors`` (vec_id, embedding). For each row whose id is divisible by ``every`` its k best
    other rows: ``query_id``, ``rank``, ``vec_id``, ``score``."""
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").alias("vector"))
    rows = rows.filter(F.col("id").isNotNull() & ~F.coalesce(bad, F.lit(True)))
    rows = stored(rows.select(F.monotonically_increasing_id().alias("row"), "id", "vector"), "vectors")
    sizes = rows.agg(F.count(F.lit(1)).alias("n"), F.mode(F.size("vector")).alias("sides")).first()
    sides, cells = sizes["sides"] or 0, min(CELLS, -(-sizes["n"] // shard))
    cuts: list[Cut] = []
    if cells > 1 and sides:
        some = F.pmod(F.xxhash64("row"), F.lit(max(1, sizes["n"] // SAMPLE))) == 0
        sample = rows.filter(some & (F.size("vector") == sides)).select("vector").limit(2 * SAMPLE).toArrow()
        cuts = cuts_of(whole(np.array(vectors_in(sample.column("vector").combine_chunks())).reshape(-1, sides)), cells)
    placed = stored(dealt_cells(rows, cuts), "placed")
    parts = stored(placed.groupBy("cell").agg(F.greatest(F.round(F.count(F.lit(1)) / shard), F.lit(1)).cast("long").alias("parts")), "parts")
    dealt = placed.join(F.broadcast(parts), "cell").withColumn("part", F.pmod(F.xxhash64("row"), "parts"))
    dealt = dealt.select(shard_of("cell", "part").alias("home"), "id", "vector")
    every_floor = F.lit(float("-inf"))
    own = dealt.select(F.col("home").alias("shard"), F.lit(0).alias("kind"), "id", "vector", every_floor.alias("floor"))
    queries = dealt.filter(F.col("id") % every == 0)
    first = queries.select(F.col("home").alias("shard"), F.lit(1).alias("kind"), "id", "vector", every_floor.alias("floor"))
    near = stored(merged(searched(own.unionAll(first), k), k), "near").drop("rank")
    floors = near.groupBy("query_id").agg(
        F.when(F.count(F.lit(1)) >= k, F.min("score").cast("double")).otherwise(every_floor).alias("floor")
    )
    queries = queries.join(floors, F.col("id") == F.col("query_id"), "left")
    queries = queries.select("home", "id", "vector", F.coalesce("floor", every_floor).alias("floor"))
    others = visits_of(queries, boxes_of(placed, sides), sides, len(cuts) + 1, parts)
    return merged(near.unionAll(searched(own.unionAll(others), k)), k)
