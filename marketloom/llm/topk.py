"""Exact search of the highest inner products with a pivot-distance index.

Vectors get one more component, so that all of them lie on one sphere of radius M, the largest norm;
queries get a zero there. Then ``|q - x|^2 = |q|^2 + M^2 - 2 q.x``: the nearest vector has the highest
inner product, and the triangle inequality holds. Every vector is keyed by its nearest pivot and the
distance to it. Range partitioning by (pivot, distance) sorts the keys over all tasks, and runs of rows
with one pivot become annuli of a bounded number of vectors, so neither a common pivot nor a vector
that repeats gathers in one task.

A block of neighbouring queries expands annuli in order of the lower bound
``max(0, d(q, p) - hi, lo - d(q, p))`` on their distance. The first annuli give each query a k-th score;
pairs of block and annulus whose bound cannot reach it are never joined. The others stream past the
block one annulus at a time with the scores found so far, and a query skips an annulus that cannot reach
its k-th score. Scores are 64-bit integers throughout; only bounds are floats, widened by a slack above
rounding, and a bound equal to the k-th score is still looked at, so ties go to the smaller id.

Defined results
    Vectors that are null or empty, or hold null or non-finite components, take no part; nor do null ids.
    Repeated ids: each row is a candidate, but no row with the query's own id. Shorter vectors count as
    padded with zeros. Scores beyond 64 bits count as the end of that range. Fewer than k candidates: all of them. Empty table: no rows. Other columns: ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.llm.common import Stage, batch_rows

PIVOTS = 64
SAMPLE_ROWS = 4096  # vectors from which the pivots are chosen; the index holds every row
ANNULUS_ROWS = 1024
QUERY_ROWS = 256
FIRST_ANNULI = 3
PAYLOAD_ROWS = 32  # annuli in an Arrow batch
SLACK = 1e-6  # relative widening of the bounds, far above the rounding of 64-bit floats

NO_SCORE = -(2**63)

BLOCK = "block long, pivot int, lo double, hi double, rows int, ids binary, vectors binary"


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """``id`` and ``v``: each component as floor(scale * x), for rows that take part."""
    finite = F.forall(F.col(vector_col), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vectors.filter(F.col(id_col).isNotNull() & (F.size(vector_col) > 0) & finite).select(
        F.col(id_col).cast("long").alias("id"),
        F.transform(vector_col, lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))).alias("v"),
    )


def choose_pivots(sample, count: int):
    """Cluster centres of the sample: spread starts, then a few rounds of means."""
    import numpy as np

    centres = sample[:1]
    nearest = ((sample - centres[0]) ** 2).sum(1)
    while len(centres) < min(count, len(sample)) and nearest.max() > 0:
        centres = np.vstack([centres, sample[nearest.argmax()]])
        nearest = np.minimum(nearest, ((sample - centres[-1]) ** 2).sum(1))
    for _ in range(5):
        owner = ((sample**2).sum(1)[:, None] - 2 * sample @ centres.T + (centres**2).sum(1)).argmin(1)
        centres = np.vstack([sample[owner == k].mean(0) if (owner == k).any() else centres[k] for k in range(len(centres))])
    return centres


def _distances(x, pivots):
    import numpy as np

    return np.sqrt(np.maximum(0, (x**2).sum(1)[:, None] - 2 * x @ pivots.T + (pivots**2).sum(1)))


def products(queries, x, bound: float):
    """Inner products of whole numbers as 64-bit integers; ``bound`` is one on their size."""
    import numpy as np

    if bound < 2**52:
        return (queries.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)  # sums below 2^53: exact
    if bound < 2**62:
        return queries @ x.T
    exact = queries.astype(object) @ x.astype(object).T
    return np.clip(exact, NO_SCORE + 1, 2**63 - 1).astype(np.int64)


def _blocks(keyed: DataFrame, most: int, dim: int) -> DataFrame:
    """Rows sorted by (pivot, distance) over all tasks, in blocks with one pivot and at most so many rows."""
    import numpy as np
    import pyarrow as pa

    def pack(batches):
        part, number, held = None, 0, []

        def flush():
            nonlocal number, held
            ids, dist, v, pivot = zip(*held)
            number += 1
            row = [(part << 32) + number, pivot[0], dist[0], dist[-1], len(ids), np.array(ids, np.int64).tobytes(), b"".join(v)]
            held = []
            return row

        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        for batch in batches:
            out = []
            rows = zip(*(batch.column(c).to_pylist() for c in ("id", "dist", "vector", "pivot")))
            for row in rows:
                if held and (held[0][3] != row[3] or len(held) == most):
                    out.append(flush())
                held.append(row)
            yield _batch(pa, out)
        if held:
            yield _batch(pa, [flush()])

    shape = keyed.select("id", "pivot", "dist", "vector")
    return shape.repartitionByRange("pivot", "dist", "id").sortWithinPartitions("pivot", "dist", "id").mapInArrow(pack, BLOCK)


def _batch(pa, rows):
    types = [pa.int64(), pa.int32(), pa.float64(), pa.float64(), pa.int32(), pa.binary(), pa.binary()]
    names = ["block", "pivot", "lo", "hi", "rows", "ids", "vectors"]
    columns = list(zip(*rows)) if rows else [[]] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


class Best:
    """The k best (score, id) of each query of a block so far."""

    def __init__(self, ids, vectors, pivots, largest: float, k: int):
        import numpy as np

        self.np, self.ids, self.k = np, ids, k
        self.vectors = vectors
        lifted = np.hstack([vectors.astype(np.float64), np.zeros((len(ids), 1))])
        self.squares = (lifted**2).sum(1)
        self.to_pivots = _distances(lifted, pivots)
        self.largest = largest
        self.scores = np.full((len(ids), k), NO_SCORE)
        self.found = np.full((len(ids), k), np.iinfo(np.int64).max)

    def reachable(self, pivot: int, lo: float, hi: float):
        """The highest score that a vector of this annulus can have, widened by the slack."""
        d = self.to_pivots[:, pivot]
        width = SLACK * (self.largest + d + hi + 1)
        low = self.np.maximum(0, self.np.maximum(d - hi, lo - d) - width)
        return self.np.maximum(NO_SCORE, (self.squares + self.largest**2 - low**2) / 2 * (1 + SLACK) + SLACK)

    def visit(self, pivot: int, lo: float, hi: float, ids, vectors) -> None:
        np = self.np
        open_ = np.flatnonzero(self.reachable(pivot, lo, hi) >= self.scores[:, -1])
        if not len(open_):
            return
        bound = np.sqrt(self.squares.max() * (vectors.astype(np.float64) ** 2).sum(1).max())
        scores = products(self.vectors[open_], vectors, bound)
        scores[ids[None, :] == self.ids[open_][:, None]] = NO_SCORE
        # Keep those not below the k-th best of this annulus, then order by score and id.
        if scores.shape[1] > self.k:
            kth = np.partition(scores, scores.shape[1] - self.k, axis=1)[:, -self.k]
            kth = np.maximum(kth, self.scores[open_, -1])
        else:
            kth = self.scores[open_, -1]
        for i, row, floor in zip(open_, scores, kth):
            hit = np.flatnonzero((row >= floor) & (row > NO_SCORE))
            if len(hit):
                s, d = np.concatenate([self.scores[i], row[hit]]), np.concatenate([self.found[i], ids[hit]])
                best = np.lexsort((d, ~s))[: self.k]  # ~ turns the order of all 64-bit integers
                self.scores[i], self.found[i] = s[best], d[best]

    def rows(self) -> Iterator[tuple[int, int, int, int]]:
        for q, scores, found in zip(self.ids.tolist(), self.scores.tolist(), self.found.tolist()):
            for rank, (s, x) in enumerate(zip(scores, found), 1):
                if s != NO_SCORE:
                    yield q, rank, x, s


def _stream(visits: DataFrame, queries: DataFrame, seeds: DataFrame | None, pivots, largest: float, k: int, dim: int) -> DataFrame:
    """Annuli past their query blocks in order of the bound; one annulus is in memory at a time."""
    import numpy as np
    import pyarrow as pa

    schema = "qblock long, query_id long, rank int, vec_id long, score long"
    head = queries.select(F.col("block").alias("qblock"), F.lit(-2.0).alias("bound"), F.lit(0).alias("pivot"), F.lit(0.0).alias("lo"), F.lit(0.0).alias("hi"), "ids", "vectors")
    rows = head.unionByName(visits.select("qblock", "bound", "pivot", "lo", "hi", "ids", "vectors"))
    if seeds is not None:
        packed = seeds.groupBy("qblock").agg(F.collect_list(F.struct("query_id", "rank", "vec_id", "score")).alias("s"))
        rows = rows.join(packed.withColumn("bound", F.lit(-2.0)), ["qblock", "bound"], "left")
    else:
        rows = rows.withColumn("s", F.lit(None).cast("array<struct<query_id:long,rank:int,vec_id:long,score:long>>"))

    def search(batches):
        block, best = None, None

        def flush():
            return pa.RecordBatch.from_pylist(
                [{"qblock": block, "query_id": q, "rank": r, "vec_id": x, "score": s} for q, r, x, s in best.rows()],
                schema=pa.schema([("qblock", pa.int64()), ("query_id", pa.int64()), ("rank", pa.int32()), ("vec_id", pa.int64()), ("score", pa.int64())]),
            )

        for batch in batches:
            for i in range(batch.num_rows):
                get = lambda c: batch.column(batch.schema.get_field_index(c))[i].as_py()  # noqa: B023, E731
                ids = np.frombuffer(get("ids"), np.int64)
                vectors = np.frombuffer(get("vectors"), np.int64).reshape(len(ids), dim)
                if get("bound") == -2.0:
                    if best is not None:
                        yield flush()
                    block, best = get("qblock"), Best(ids, vectors, pivots, largest, k)
                    place = {q: n for n, q in enumerate(ids.tolist())}
                    for s in get("s") or []:
                        best.scores[place[s["query_id"]], s["rank"] - 1] = s["score"]
                        best.found[place[s["query_id"]], s["rank"] - 1] = s["vec_id"]
                else:
                    best.visit(get("pivot"), get("lo"), get("hi"), ids, vectors)
        if best is not None:
            yield flush()

    return rows.repartition(F.col("qblock")).sortWithinPartitions("qblock", "bound", "lo", "hi").mapInArrow(search, schema)


def search(
    vectors: DataFrame,
    is_query: Callable[[Column], Column],
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 5,
    scale: int = 256,
    pivots: int = PIVOTS,
    annulus_rows: int = ANNULUS_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` of each query's k best rows, its own id left out."""
    import numpy as np
    import pyarrow as pa

    spark = vectors.sparkSession
    stage = Stage(spark, "topk")
    base = stage.keep("base", quantised(vectors, id_col, vector_col, scale))
    squares = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    shape = base.agg(F.max(F.size("v")), F.max(squares)).first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if shape[0] is None:
        return empty
    dim, largest = shape[0], float(np.sqrt(shape[1]))

    def whole(v):
        x = np.zeros((len(v), dim), np.int64)
        for i, row in enumerate(v):
            x[i, : len(row)] = row
        return x

    def lift(whole_numbers, query: bool):
        x = np.hstack([whole_numbers.astype(np.float64), np.zeros((len(whole_numbers), 1))])
        if not query:
            x[:, dim] = np.sqrt(np.maximum(0, largest**2 - (x**2).sum(1)))
        return x

    sample = base.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS).select("v").collect()
    centres = choose_pivots(lift(whole([r.v for r in sample]), False), pivots)

    def key(query: bool):
        def run(batches):
            for batch in batches:
                if not batch.num_rows:
                    continue
                v = whole(batch.column(1).to_pylist())
                d = _distances(lift(v, query), centres)
                own = d.argmin(1)
                payload = [r.tobytes() for r in v]
                columns = [batch.column(0), pa.array(own.astype(np.int32)), pa.array(d[np.arange(len(own)), own]), pa.array(payload, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["id", "pivot", "dist", "vector"])

        return run

    keyed = "id long, pivot int, dist double, vector binary"
    annuli = stage.keep("annuli", _blocks(base.mapInArrow(key(False), keyed), annulus_rows, dim))
    # A query's own id names it, so of rows that share an id one is the query.
    asked = base.filter(is_query(F.col("id"))).dropDuplicates(["id"]).mapInArrow(key(True), keyed)
    queries = stage.keep("queries", _blocks(asked, query_rows, dim))

    def spread(batches):
        """For each query block and pivot: the range of distances, and the largest squared norm."""
        for batch in batches:
            out = []
            for block, ids, v in zip(*(batch.column(c).to_pylist() for c in ("block", "ids", "vectors"))):
                x = np.frombuffer(v, np.int64).reshape(-1, dim).astype(np.float64)
                d = _distances(np.hstack([x, np.zeros((len(x), 1))]), centres)
                square = float((x**2).sum(1).max())
                out += [(block, p, float(d[:, p].min()), float(d[:, p].max()), square) for p in range(len(centres))]
            columns = list(zip(*out)) if out else [[]] * 5
            types = [pa.int64(), pa.int32(), pa.float64(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["qblock", "pivot", "near", "far", "square"])

    ranges = queries.select("block", "ids", "vectors").mapInArrow(spread, "qblock long, pivot int, near double, far double, square double")
    low = F.greatest(F.lit(0.0), F.col("near") - F.col("hi"), F.col("lo") - F.col("far"))
    width = SLACK * (largest + F.col("far") + F.col("hi") + 1)
    pairs = ranges.join(annuli.select("block", "pivot", "lo", "hi"), "pivot").withColumn("bound", low)
    pairs = stage.keep("pairs", pairs.select("qblock", "block", "bound", "square", (F.greatest(F.lit(0.0), low - width)).alias("low")))

    order = Window.partitionBy("qblock").orderBy("bound", "block")
    first = pairs.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= FIRST_ANNULI)
    payload = annuli.select("block", "pivot", "lo", "hi", "ids", "vectors")
    with batch_rows(spark, PAYLOAD_ROWS):
        seeds = stage.keep("seeds", _stream(first.join(payload, "block"), queries, None, centres, largest, k, dim))
    # The lowest k-th score in a block; a query with fewer than k results has none yet.
    sizes = queries.select(F.col("block").alias("qblock"), F.col("rows"))
    floors = (
        seeds.groupBy("qblock")
        .agg(F.min(F.when(F.col("rank") == k, F.col("score"))).alias("floor"), F.sum((F.col("rank") == k).cast("int")).alias("full"))
        .join(sizes, "qblock")
        .select("qblock", F.when(F.col("full") == F.col("rows"), F.col("floor")).alias("floor"))
    )
    reach = F.greatest(F.lit(float(NO_SCORE)), (F.col("square") + F.lit(largest**2) - F.col("low") * F.col("low")) / 2 * (1 + SLACK) + SLACK)
    rest = (
        pairs.join(first.select("qblock", "block"), ["qblock", "block"], "left_anti")
        .join(floors, "qblock", "left")
        .filter(F.col("floor").isNull() | (reach >= F.col("floor")))
        .join(payload, "block")
    )
    found = _stream(rest, queries, seeds, centres, largest, k, dim).select("query_id", "rank", "vec_id", "score")
    with batch_rows(spark, PAYLOAD_ROWS):
        return stage.keep("found", found)
