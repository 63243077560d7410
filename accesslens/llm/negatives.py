"""Hard-negative mining by BOND, a vertical scan with branch and bound.

Components become ``floor(256 * x)``; a row's score for an anchor is their inner
product. An anchor's positives are its ``k`` best other rows of its label; for each
positive the hard negatives are the ``k`` best rows of other labels whose score lies
in the window from four fifths of the positive's score up to that score.

1. Blocks. Median splits of at most ``SAMPLE`` rows part the space into at most ``CELLS``
   cells; every row goes to its cell, and cells are dealt by row into blocks of
   about ``VALUES`` components, so a vector that a third of all rows share fills many
   blocks. A block is written dimension by dimension, with the least and greatest value of each.
   The sample only decides who is near whom: every row is in a block, results are exact.
2. Scan. An anchor reads a block's dimensions in descending order of its own
   components' magnitude. After every few dimensions the partial scores, with the least
   and greatest contribution that the dimensions to come can add, bound each
   candidate's score; candidates that cannot lie in a window, or are below k that
   surely do, leave the window's bitmap, and only what is left is read on. After the last
   dimension scores are exact.
3. Visits. Anchors first visit their own block, which gives a k-th score for the
   whole table, then only cells whose box can reach it: once for the
   positives, once for the windows of their scores.

Anchors are a stated set that meets all rows block by block; pairs are never rows.
What moves: each vector once to its block, and per visit the block and the anchor.

Order: higher score, then smaller id. Defined cases: rows with a null id, null label,
null vector or a null or non-finite component take no part; vectors are only
compared with vectors of their length; rows alike are rows of their own, as anchors,
positives and negatives, but a row is never matched with one of its own id; positives of a
negative score have no window; fewer rows give fewer ranks; sums that a double cannot hold
exactly are taken in whole numbers and kept within a long; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from accesslens.llm.common import stored
from accesslens.operators.select import top_per_group

SCALE = 256
VALUES = 1 << 18  # components per block, on average
SAMPLE = 4096  # rows that the cells are cut by
CELLS = 256
STEP = 8  # dimensions read between two cuts of the bitmap
LONG = 2**63 - 1

Cut = tuple[int, float, int, int]  # dimension, value, cell or cut below it, cell or cut from it on (cells: ~cell)


def clean(vectors: DataFrame, shift: int = 7, labels: int = 10) -> DataFrame:
    """``row``, ``id``, ``label``, ``vector`` of the rows that take part; where the id is divisible by ``shift``
    the label first becomes the next of ``labels``."""
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    label = F.col("label").cast("long")
    rows = vectors.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("vec_id").cast("long").alias("id"),
        F.when(F.col("vec_id") % shift == 0, F.pmod(label + 1, F.lit(labels))).otherwise(label).alias("label"),
        F.col("embedding").cast("array<double>").alias("vector"),
    )
    rows = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & ~F.coalesce(bad, F.lit(True)))
    # From 2^53 on every double is whole.
    whole = F.transform("vector", lambda x: F.when(F.abs(x) < 2.0**44, F.floor(x * SCALE).cast("double")).otherwise(x * SCALE))
    return rows.withColumn("vector", whole)


def vectors_in(column: pa.ListArray) -> list[np.ndarray]:
    ends = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False)
    return [flat[a:b] for a, b in zip(ends, ends[1:])]


def cuts_of(sample: np.ndarray, cells: int) -> list[Cut]:
    """Median splits on the widest dimension, the largest part first."""
    cuts: list[list] = []
    open_ = [(np.arange(len(sample)), -1, 0)]
    count = 1
    while open_ and count < cells:
        open_.sort(key=lambda part: len(part[0]))
        own, parent, side = open_.pop()
        points = sample[own]
        spread = np.ptp(points, axis=0) if len(own) > 1 else np.zeros(0)
        if not spread.size or not spread.max():
            break  # the largest part is one vector; smaller ones need no cut either
        d = int(np.argmax(spread))
        value = float(np.median(points[:, d]))
        if value == points[:, d].min():
            value = float(points[:, d][points[:, d] > value].min())
        if parent >= 0:
            cuts[parent][side] = len(cuts)
        below = points[:, d] < value
        open_ += [(own[below], len(cuts), 2), (own[~below], len(cuts), 3)]
        cuts.append([d, value, ~0, ~0])
        count += 1
    for cell, (_, parent, side) in enumerate(open_):
        if parent >= 0:
            cuts[parent][side] = ~cell
    return [tuple(c) for c in cuts]


def cells_of(points: np.ndarray, cuts: list[Cut]) -> np.ndarray:
    found = np.zeros(len(points), np.int32)
    open_ = [(0, np.arange(len(points)))] if cuts else []
    while open_:
        at, own = open_.pop()
        d, value, left, right = cuts[at]
        below = points[own, d] < value if d < points.shape[1] else np.ones(len(own), bool)
        for to, part in ((left, own[below]), (right, own[~below])):
            if to < 0:
                found[part] = ~to
            elif len(part):
                open_.append((to, part))
    return found


def dealt_cells(rows: DataFrame, cuts: list[Cut]) -> DataFrame:
    """``rows`` with ``sides`` (components) and ``cell``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = vectors_in(batch.column("vector"))
            sides = np.array([len(v) for v in vectors], np.int32)
            cells = np.zeros(len(vectors), np.int32)
            for n in set(sides.tolist()):
                at = np.flatnonzero(sides == n)
                cells[at] = cells_of(np.array([vectors[i] for i in at]).reshape(len(at), n), cuts)
            yield pa.RecordBatch.from_pydict({c: batch.column(c) for c in batch.schema.names} | {"sides": sides, "cell": cells})

    return rows.mapInArrow(run, "row long, id long, label long, vector array<double>, sides int, cell int")


BLOCK = "struct<ids:array<long>,labels:array<long>,columns:array<double>,low:array<double>,high:array<double>>"


def blocks_of(dealt: DataFrame) -> DataFrame:
    """``sides``, ``cell``, ``part``, ``block``, ``low``, ``high``: vectors turned into columns."""

    def turned(sides: int, cell: int, part: int, ids: list, labels: list, vectors: list) -> pa.RecordBatch:
        points = np.array(vectors).reshape(len(vectors), sides)
        low, high = pa.array([points.min(axis=0)], pa.list_(pa.float64())), pa.array([points.max(axis=0)], pa.list_(pa.float64()))
        longs = pa.list_(pa.int64())
        columns = pa.array([np.ascontiguousarray(points.T).ravel()], pa.list_(pa.float64()))
        block = pa.StructArray.from_arrays(
            [pa.array([ids], longs), pa.array([labels], longs), columns, low, high], ["ids", "labels", "columns", "low", "high"]
        )
        key = {"sides": sides, "cell": cell, "part": part}
        return pa.RecordBatch.from_pydict({k: pa.array([v], pa.int32()) for k, v in key.items()} | {"block": block})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids, labels, vectors = None, [], [], []
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("sides", "cell", "part"))))
            for key, i, label, vector in zip(keys, batch.column("id").to_pylist(), batch.column("label").to_pylist(), vectors_in(batch.column("vector"))):
                if at != key:
                    if at:
                        yield turned(*at, ids, labels, vectors)
                    at, ids, labels, vectors = key, [], [], []
                ids.append(i)
                labels.append(label)
                vectors.append(vector)
        if at:
            yield turned(*at, ids, labels, vectors)

    rows = dealt.select("sides", "cell", "part", "id", "label", "vector").repartition("sides", "cell", "part")
    return rows.sortWithinPartitions("sides", "cell", "part").mapInArrow(run, f"sides int, cell int, part int, block {BLOCK}")


class Opened:
    """A block in a task."""

    def __init__(self, block: dict):
        self.ids, self.labels = np.array(block["ids"], np.int64), np.array(block["labels"], np.int64)
        self.low, self.high = np.array(block["low"]), np.array(block["high"])
        self.columns = np.array(block["columns"]).reshape(len(self.low), len(self.ids))
        self.most = max(np.abs(self.low).max(initial=0), np.abs(self.high).max(initial=0))

    def scan(self, query: np.ndarray, mask: np.ndarray, windows: list[tuple[int, int]], k: int) -> list[list[tuple[int, int]]]:
        """Per window (low, high) up to k of (id, score) inside it, best first."""
        if self.most * np.abs(query).max(initial=0) * len(query) >= 2**53:
            return self._wide(query, mask, windows, k)
        order = np.argsort(-np.abs(query), kind="stable")
        ends = query * self.low, query * self.high
        least, most = np.minimum(*ends)[order], np.maximum(*ends)[order]
        # What the dimensions from place d on can add.
        least, most = (np.append(np.cumsum(x[::-1])[::-1], 0.0) for x in (least, most))
        lows, highs = (np.array(x, np.float64)[:, None] for x in zip(*windows))
        alive = np.flatnonzero(mask)
        scores = np.zeros(len(alive))
        bitmap = np.ones((len(windows), len(alive)), bool)
        read = 0
        while True:
            lower, upper = scores + least[read], scores + most[read]
            bitmap &= (upper >= lows) & (lower <= highs)
            inside = bitmap & (lower >= lows) & (upper <= highs)
            for w in np.flatnonzero(inside.sum(axis=1) >= k):
                kth = np.partition(lower[inside[w]], -k)[-k]
                lows[w] = max(lows[w, 0], kth)
            bitmap &= upper >= lows
            left = bitmap.any(axis=0)
            if not left.all():
                alive, scores, bitmap = alive[left], scores[left], bitmap[:, left]
            if read == len(order) or not len(alive):
                break
            some = order[read : read + STEP]
            part = self.columns[some] if len(alive) == len(self.ids) else self.columns[np.ix_(some, alive)]
            scores = scores + query[some] @ part
            read += len(some)
        found = []
        for own in bitmap:
            ids, values = self.ids[alive[own]], scores[own]
            best = np.lexsort((ids, -values))[:k]
            found.append([(int(ids[i]), int(values[i])) for i in best])
        return found

    def _wide(self, query: np.ndarray, mask: np.ndarray, windows: list[tuple[int, int]], k: int) -> list[list[tuple[int, int]]]:
        q = [int(x) for x in query]
        scores = [(max(-LONG, min(LONG, sum(a * int(b) for a, b in zip(q, self.columns[:, i])))), int(self.ids[i])) for i in np.flatnonzero(mask)]
        return [[(i, s) for s, i in sorted(((s, i) for s, i in scores if a <= s <= b), key=lambda x: (-x[0], x[1]))[:k]] for a, b in windows]


def scanned(blocks: DataFrame, visits: DataFrame, same: bool, k: int) -> DataFrame:
    """``visits`` (sides, cell, part, row, id, label, vector, windows): ``row``, ``high`` (of the window), ``other``,
    ``score``: the best k in each window, of the same label or of others, of the blocks an anchor visits."""
    wanted = blocks.join(visits.select("sides", "cell", "part").distinct(), ["sides", "cell", "part"], "left_semi")
    empty = {"row": "long", "id": "long", "label": "long", "vector": "array<double>", "windows": "array<struct<low:long,high:long>>"}
    key = ["sides", "cell", "part"]
    first = wanted.select(*key, F.lit(0).alias("kind"), "block", *[F.lit(None).cast(t).alias(c) for c, t in empty.items()])
    then = visits.select(*key, F.lit(1).alias("kind"), F.lit(None).cast(BLOCK).alias("block"), *empty)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = None
        for batch in batches:
            out: list[tuple[int, int, int, int]] = []
            column = batch.column
            for i, kind in enumerate(column("kind").to_pylist()):
                if kind == 0:
                    opened = Opened(column("block")[i].as_py())
                    continue
                row, me, label = (column(c)[i].as_py() for c in ("row", "id", "label"))
                windows = [(w["low"], w["high"]) for w in column("windows")[i].as_py()]
                mask = ((opened.labels == label) == same) & (opened.ids != me)
                query = np.array(column("vector")[i].as_py())
                for (_, high), found in zip(windows, opened.scan(query, mask, windows, k)):
                    out += [(row, high, other, score) for other, score in found]
            names = ["row", "high", "other", "score"]
            yield pa.RecordBatch.from_arrays([pa.array([o[c] for o in out], pa.int64()) for c in range(4)], names)

    rows = first.unionAll(then).repartition(*key).sortWithinPartitions(*key, "kind")
    return rows.mapInArrow(run, "row long, high long, other long, score long")


def reaching(anchors: DataFrame, boxes: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """``anchors`` with ``to``: the cells whose box can reach into one of their windows."""
    by_sides: dict[int, tuple[list[int], np.ndarray, np.ndarray]] = {}
    for (sides, cell), (low, high) in sorted(boxes.items()):
        cells, lows, highs = by_sides.setdefault(sides, ([], [], []))
        cells.append(cell)
        lows.append(low)
        highs.append(high)
    by_sides = {n: (np.array(c, np.int32), np.array(a), np.array(b)) for n, (c, a, b) in by_sides.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for vector, windows in zip(vectors_in(batch.column("vector")), batch.column("windows").to_pylist()):
                if len(vector) not in by_sides:
                    found.append(None)  # all cells of this length
                    continue
                cells, low, high = by_sides[len(vector)]
                most = np.maximum(vector, 0) @ high.T + np.minimum(vector, 0) @ low.T
                least = np.maximum(vector, 0) @ low.T + np.minimum(vector, 0) @ high.T
                slack = 1e-9 * (np.abs(most) + np.abs(least))  # of sums beyond 2^53
                near = np.zeros(len(cells), bool)
                for w in windows:
                    near |= (most + slack >= w["low"]) & (least - slack <= w["high"])
                found.append(cells[near].tolist())
            columns = {c: batch.column(c) for c in batch.schema.names}
            yield pa.RecordBatch.from_pydict(columns | {"to": pa.array(found, pa.list_(pa.int32()))})

    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in anchors.schema.fields)
    return anchors.mapInArrow(run, f"{kind}, to array<int>")


class Space:
    """All rows in blocks, the boxes of the cells, and the anchors with their own block."""

    def __init__(self, vectors: DataFrame, every: int, values: int = VALUES):
        rows = stored(clean(vectors), "rows")
        sizes = rows.agg(F.count(F.lit(1)).alias("n"), F.mode(F.size("vector")).alias("sides")).first()
        sides = sizes["sides"] or 0
        cells = min(CELLS, -(-sizes["n"] * max(sides, 1) // values))
        cuts: list[Cut] = []
        if cells > 1:
            sample = rows.filter(F.size("vector") == sides).orderBy(F.xxhash64("row")).limit(SAMPLE).select("vector").toArrow()
            cuts = cuts_of(np.array(vectors_in(sample.column("vector").combine_chunks())), cells)
        placed = dealt_cells(rows, cuts)
        counts = placed.groupBy("sides", "cell").agg(
            F.ceil(F.count(F.lit(1)) * F.greatest("sides", F.lit(1)) / F.lit(values)).alias("parts")
        )
        part = F.pmod(F.xxhash64("row"), "parts").cast("int").alias("part")
        dealt = stored(placed.join(counts, ["sides", "cell"]).select("row", "id", "label", "vector", "sides", "cell", part), "dealt")
        self.blocks = stored(blocks_of(dealt), "blocks")
        self.anchors = dealt.filter(F.col("id") % every == 0)
        # At most CELLS boxes: those of the commonest length.
        each = self.blocks.filter(F.col("sides") == sides).select("cell", F.posexplode(F.arrays_zip("block.low", "block.high")).alias("d", "x"))
        per = each.groupBy("cell", "d").agg(F.min("x.low").alias("low"), F.max("x.high").alias("high"))
        whole = per.groupBy("cell").agg(F.sort_array(F.collect_list(F.struct("d", "low", "high"))).alias("x"))
        found = whole.select("cell", F.col("x.low").alias("low"), F.col("x.high").alias("high")).collect()
        self.boxes = {(sides, r["cell"]): (np.array(r["low"]), np.array(r["high"])) for r in found}

    def mine(self, asked: DataFrame, same: bool, k: int) -> DataFrame:
        """``asked`` (row, windows): the k best of all rows in every window: ``row``, ``high``, ``other``, ``score``."""
        order = [F.desc("score"), F.asc("other")]

        def best(found: DataFrame) -> DataFrame:
            return top_per_group(found.withColumn("window", F.struct("row", "high")), "window", order, k).drop("window")

        anchors = self.anchors.join(asked, "row")
        near = stored(best(scanned(self.blocks, anchors, same, k)), "near")
        reached = near.groupBy("row", "high").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least")).filter(F.col("n") >= k)
        windows = asked.select("row", F.inline("windows")).join(reached, ["row", "high"], "left")
        windows = windows.select("row", F.struct(F.greatest("low", "least").alias("low"), "high").alias("w"))
        raised = windows.groupBy("row").agg(F.collect_list("w").alias("windows"))  # at most as many as positives
        rest = reaching(self.anchors.withColumnsRenamed({"cell": "own", "part": "own_part"}).join(raised, "row"), self.boxes)
        keys = self.blocks.select("sides", "cell", "part")
        visits = rest.withColumn("home", F.struct(F.col("own").alias("cell"), F.col("own_part").alias("part")))
        there = visits.filter("to IS NOT NULL").withColumn("cell", F.explode("to")).join(keys, ["sides", "cell"])
        other = visits.filter("to IS NULL").join(keys, "sides")
        columns = ["sides", "cell", "part", "row", "id", "label", "vector", "windows", "home"]
        visits = there.select(columns).unionAll(other.select(columns)).filter(F.struct("cell", "part") != F.col("home"))
        return best(near.unionAll(scanned(self.blocks, visits, same, k).select(near.columns)))


def hard_negatives(vectors: DataFrame, k: int = 5, every: int = 100, values: int = VALUES) -> DataFrame:
    """``vectors`` (vec_id, embedding, label). For each row whose id is divisible by ``every`` and each of its k positives:
    ``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``."""
    space = Space(vectors, every, values)
    whole = F.array(F.struct(F.lit(-LONG).alias("low"), F.lit(LONG).alias("high")))
    positives = stored(space.mine(space.anchors.select("row", whole.alias("windows")), True, k), "positives")
    positives = positives.select("row", F.col("other").alias("positive_id"), F.col("score").alias("positive_score"))
    # 80 * positive <= 100 * negative <= 100 * positive, in whole numbers.
    low = F.col("high") - F.expr("high div 5")
    windows = positives.filter("positive_score >= 0").select("row", F.col("positive_score").alias("high")).distinct()
    windows = windows.groupBy("row").agg(F.collect_list(F.struct(low.alias("low"), "high")).alias("windows"))
    found = space.mine(stored(windows, "windows"), False, k)
    rank = F.row_number().over(Window.partitionBy("row", "high").orderBy(F.desc("score"), F.asc("other")))
    ranked = found.withColumn("rank", rank.cast("int"))
    same = (F.col("p.row") == F.col("f.row")) & (F.col("p.positive_score") == F.col("f.high"))
    pairs = positives.alias("p").join(ranked.alias("f"), same).select("p.row", "positive_id", "rank", F.col("other").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
    names = space.anchors.select("row", F.col("id").alias("anchor_id"))
    return pairs.join(names, "row").select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
