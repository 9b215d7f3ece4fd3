"""Removal of long repeated byte strings with a logarithmic family of suffix arrays.

A byte goes when a string of ``length`` bytes that covers it also starts somewhere else. Every such string (a
window) holds an anchor: the place in it whose next ``GRAM`` bytes have the smallest hash. Equal windows
have their anchor at the same place, so suffixes are sampled at anchors, about one in a hundred bytes.

An entry of a suffix array is an anchored suffix: the digest of its first ``GRAM`` bytes (``core``), the digest
of all bytes that windows around this anchor can hold (``full``), and its place. Suffixes are ordered by these
digests; any order that puts equal beginnings side by side serves a scan. Entries with equal digests are one
row with their number and one place.

Documents come in batches. A batch gets its array, which is scanned, merged in order, against each array of the
family: equal ``full`` is a long match, and a ``core`` with several ``full`` is one whose ends are still open.
Arrays of equal size become one, so a family of n batches has at most log n arrays and an entry is written
log n times. What the scans found is kept beside the arrays.

Open cores are narrowed, with one place for all equal ones. Up to ``GROUP_ROWS`` places of a core meet in a
task with the bytes around them. Rolling hashes of all their windows make a table, a row for each place and a
column for each distance from the anchor; equal values in a column are repeated windows, found by a sort of
each column, never pair by pair. Places of a core that has more are narrowed in Spark: the windows around an
anchor are split into runs. All windows of a run share the bytes in its middle (its ``core``), and its ``full``
are all bytes of the run. Runs whose core is met nowhere else hold no match; runs whose full is met elsewhere
are repeated as a whole; the others are split again, down to single windows. Both ways find the same.

``core`` and ``full`` are 64-bit digests that decide together; a place is the 64-bit digest and the length of
its text, and the offset. Removal depends on the text alone, so rows with equal texts share their spans.

Defined results
    null text: the empty text. Texts shorter than a window: nothing goes, but copies of longer texts go whole.
    Repeated rows: each is another place. Empty table: no rows. Other columns: kept, one that clashes with an
    added column is replaced. Very long texts: read in pieces that overlap by a window.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import Stage, free_name, text_or_empty

LENGTH = 400
GRAM = 113
RUNS = (48, 8, 1)  # windows in a run, by round of narrowing; each divides the one before, the first the windows of an anchor
BATCHES = 4
GROUP_ROWS = 65_536  # 45 MB of text, 150 MB of hashes
TABLE_CELLS = 1 << 20
PIECE = 1 << 16

PLACE = ["t", "n", "p"]
ENTRY = "core long, full long, t long, n int, p int"


@cache
def _tables():
    """A number for each byte value, and powers of an odd base and of its inverse, modulo 2^64."""
    import numpy as np

    rng = np.random.default_rng(29)
    of_byte = rng.integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
    base = int(rng.integers(0, 1 << 62)) * 2 + 1

    def powers(x: int):
        out = np.ones(PIECE + 4096, np.uint64)
        out[1:] = x
        return np.multiply.accumulate(out)

    return of_byte, powers(base), powers(pow(base, -1, 1 << 64))


def gram_hashes(buffer, gram: int):
    """A hash of the ``gram`` bytes from each place on."""
    import numpy as np

    of_byte, power, inverse = _tables()
    sums = np.zeros(len(buffer) + 1, np.uint64)
    np.cumsum(of_byte[buffer] * power[: len(buffer)], out=sums[1:])
    x = (sums[gram:] - sums[:-gram]) * inverse[: len(buffer) - gram + 1]
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def _sliding(best, values, width: int):
    """The best of every ``width`` neighbours."""
    out, done = values, 1
    while done * 2 <= width:
        out = best(out[:-done], out[done:])
        done *= 2
    n = len(values) - width + 1
    return best(out[:n], out[width - done : width - done + n])


def anchors(text: bytes, length: int = LENGTH, gram: int = GRAM):
    """The places with the smallest hash of some window (all of equal ones), and their hashes."""
    import numpy as np

    width = length - gram + 1
    data, places, hashes = np.frombuffer(text, np.uint8), [], []
    for at in range(0, len(text) - length + 1, PIECE):
        x = gram_hashes(data[at : at + PIECE + length - 1], gram)
        smallest = _sliding(np.minimum, x, width)
        around = np.zeros(len(x) + width - 1, np.uint64)
        around[width - 1 : width - 1 + len(smallest)] = smallest
        found = np.flatnonzero(_sliding(np.maximum, around, width) == x)
        places.append(found + at)
        hashes.append(x[found])
    if not places:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    places, first = np.unique(np.concatenate(places), return_index=True)
    return places, np.concatenate(hashes)[first]


def _digest(text: bytes, first: int, last: int, seed: int) -> int:
    """Of the bytes from ``first`` to ``last`` that the text has, and of where they begin."""
    import xxhash

    start = max(first, 0)
    return xxhash.xxh3_64_intdigest(memoryview(text)[start : max(last, start)], (start - first) ^ seed)


def _batch(rows: list, pa):
    """An Arrow batch of entries whose digests are unsigned."""
    import numpy as np

    core, full, t, n, p = zip(*rows) if rows else ((),) * 5
    digests = [pa.array(np.array(c, np.uint64).view(np.int64)) for c in (core, full)]
    return pa.RecordBatch.from_arrays([*digests, pa.array(t, pa.int64()), pa.array(n, pa.int32()), pa.array(p, pa.int32())], ["core", "full", *PLACE])


def keyed(text_col: str) -> list[Column]:
    """``t`` and ``n``, which name a text, and its ``bytes``."""
    body = text_or_empty(text_col).cast("binary")
    return [F.xxhash64(body).alias("t"), F.octet_length(body).alias("n"), body.alias("bytes")]


def entries(docs: DataFrame, text_col: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """The anchored suffixes of all texts; ``p`` is the first of the windows that can hold the anchor."""
    import pyarrow as pa

    before = length - gram

    def read(batches: Iterator) -> Iterator:
        for batch in batches:
            rows = []
            for t, n, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                places, hashes = anchors(text, length, gram)
                rows += [(h, _digest(text, a - before, a + length, 0), t, n, a - before) for a, h in zip(places.tolist(), hashes.tolist())]
                if len(rows) > 50_000:
                    yield _batch(rows, pa)
                    rows = []
            yield _batch(rows, pa)

    return docs.select(*keyed(text_col)).filter(F.col("n") >= length).mapInArrow(read, ENTRY)


def split(texts: DataFrame, windows: int, run: int, length: int) -> DataFrame:
    """The runs of ``run`` windows that stretches of ``windows`` windows (``open``: core and first window) are made of."""
    import pyarrow as pa

    def cut(batches: Iterator) -> Iterator:
        for batch in batches:
            rows = []
            for t, n, text, stretches in zip(*(batch.column(c).to_pylist() for c in ("t", "n", "bytes", "open"))):
                for s in stretches:
                    for k in range(0, windows, run):
                        p, last = s["p"] + k, s["p"] + k + run - 1
                        if last >= 0 and p + length <= n:  # a window of the run lies inside the text
                            seed = (s["core"] + k * 0x9E3779B97F4A7C15) & (2**64 - 1)
                            rows.append((_digest(text, last, p + length, seed), _digest(text, p, min(n, last + length), 0), t, n, p))
                if len(rows) > 50_000:
                    yield _batch(rows, pa)
                    rows = []
            yield _batch(rows, pa)

    return texts.select("t", "n", "bytes", "open").mapInArrow(cut, ENTRY)


def window_spans(stretches: DataFrame, windows: int, length: int) -> DataFrame:
    """Runs of repeated windows (``t``, ``n``, ``p``, ``m``: how many) among the places of each core.

    ``stretches`` hold ``core``, the place and ``around``: the bytes that its windows have in the text.
    """
    import numpy as np
    import pyarrow as pa

    names = ["t", "n", "p", "m"]
    types = [pa.int64(), pa.int32(), pa.int32(), pa.int32()]
    width = windows + length - 1

    def repeated(places, around):
        """Which windows of which places of one core are met twice."""
        of_byte, power, inverse = _tables()
        hashes, step = np.empty((windows, len(places)), np.uint64), max(1, TABLE_CELLS // width)
        n, p = (np.array([place[k] for place in places], np.int64) for k in (1, 2))
        for at in range(0, len(places), step):
            cells = np.zeros((len(places[at : at + step]), width), np.uint8)
            for row, body, skip in zip(cells, around[at : at + step], np.maximum(-p[at : at + step], 0)):
                row[skip : skip + len(body)] = np.frombuffer(body, np.uint8)
            sums = np.zeros((len(cells), width + 1), np.uint64)
            np.cumsum(of_byte[cells] * power[:width], axis=1, out=sums[:, 1:])
            hashes[:, at : at + step] = ((sums[:, length:] - sums[:, :-length]) * inverse[:windows]).T
        flags, step = np.zeros(hashes.shape, bool), max(1, TABLE_CELLS // len(places))
        for at in range(0, windows, step):
            first = p[None, :] + np.arange(at, min(at + step, windows))[:, None]
            flags[at : at + step] = _met_twice(np, hashes[at : at + step], (first >= 0) & (first + length <= n))
        return flags.T

    def run(batches: Iterator) -> Iterator:
        core, places, around = None, [], []

        def spans():
            flags = repeated(places, around)
            edges = np.diff(np.pad(flags, ((0, 0), (1, 1))).astype(np.int8), axis=1)
            for (i, start), (_, stop) in zip(np.argwhere(edges == 1).tolist(), np.argwhere(edges == -1).tolist()):
                t, n, p = places[i]
                yield t, n, p + start, stop - start

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else ((),) * 4, types)], names)

        for batch in batches:
            out: list = []
            for c, t, n, p, body in zip(*(batch.column(k).to_pylist() for k in ("core", *PLACE, "around"))):
                if c != core:
                    if places:
                        out += spans()
                    core, places, around = c, [], []
                places.append((t, n, p))
                around.append(body)
            yield batch_of(out)
        if places:
            yield batch_of(list(spans()))

    dealt = stretches.select("core", *PLACE, "around").repartition("core").sortWithinPartitions("core")
    return dealt.mapInArrow(run, "t long, n int, p int, m int")


def _met_twice(np, values, known):
    """Flags of the known values that another known value of their row equals."""
    order = np.argsort(values, axis=1)
    ranked, known = np.take_along_axis(values, order, 1), np.take_along_axis(known, order, 1)
    starts = np.ones(values.shape, bool)
    starts[:, 1:] = ranked[:, 1:] != ranked[:, :-1]
    group = np.cumsum(starts.ravel()) - 1
    known_in = np.bincount(group, weights=known.ravel())
    flags = np.zeros(values.shape, bool)
    np.put_along_axis(flags, order, known & (known_in[group].reshape(values.shape) > 1), 1)
    return flags


def classes(rows: DataFrame, copies: Column) -> DataFrame:
    """Equal entries as one row: how many there are, and the place of one of them."""
    one = [F.first(c).alias(c) for c in PLACE]
    return rows.groupBy("core", "full").agg(F.sum(copies).alias("copies"), *one)


def open_cores(found: DataFrame) -> DataFrame:
    return found.groupBy("core").count().filter("count > 1").select("core")


def members(rows: DataFrame, repeated: DataFrame) -> DataFrame:
    """The rows of the classes in ``repeated`` (``core``, ``full``, ``copies``; a class can be there more than once).

    Rows of a class with over ``GROUP_ROWS`` copies are marked where they are read. The input has at most one such
    class for ``GROUP_ROWS`` rows, so these go to every task; the others meet their one row.
    """
    keys = ["core", "full"]
    large = F.broadcast(repeated.filter(F.col("copies") > GROUP_ROWS).select(*keys).distinct())
    if large.isEmpty():
        return rows.join(repeated.select(*keys).distinct(), keys, "left_semi")
    others = rows.join(large, keys, "left_anti").join(repeated.select(*keys).distinct(), keys, "left_semi")
    return rows.join(large, keys, "left_semi").unionByName(others)


class Family:
    """Suffix arrays of 1, 2, 4, ... batches and what their scans found."""

    def __init__(self, stage: Stage):
        self.stage, self.made = stage, 0
        self.arrays: list[tuple[int, str, DataFrame]] = []  # batches in it, name, rows; smallest first
        self.repeated: list[DataFrame] = []
        self.open: list[DataFrame] = []

    def _array(self, rows: DataFrame) -> tuple[str, DataFrame]:
        self.made += 1
        name = f"array{self.made}"
        return name, self.stage.keep(name, rows.sortWithinPartitions("core", "full"))

    def _found(self, scanned: DataFrame) -> None:
        self.repeated.append(self.stage.keep("repeated", scanned.filter("copies > 1").select("core", "full", "copies")))
        self.open.append(self.stage.keep("open", open_cores(scanned)))

    def add(self, batch: DataFrame) -> None:
        """Scan the entries of a batch against all arrays, and merge arrays of equal size."""
        name, run = self._array(classes(batch, F.lit(1)))
        self._found(run)
        size, others = 1, []
        for batches, other, array in self.arrays:
            both = classes(run.unionByName(array), F.col("copies"))
            scanned_name, scanned = self._array(both)
            self._found(scanned)
            if batches == size:
                self.stage.drop(name, other)
                name, run, size = scanned_name, scanned, 2 * size
            else:
                self.stage.drop(scanned_name)
                others.append((batches, other, array))
        self.arrays = sorted([(size, name, run), *others], key=lambda a: a[0])

    def union(self) -> DataFrame:
        return reduce(DataFrame.unionByName, [rows for _, _, rows in self.arrays])


def _union_distinct(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames).distinct()


def _texts(docs: DataFrame, text_col: str, wanted: DataFrame) -> DataFrame:
    """``t``, ``n``, ``bytes`` of the texts that have open entries, each once."""
    named = docs.select(*keyed(text_col)).join(wanted.select("t", "n").distinct(), ["t", "n"], "left_semi")
    return named.groupBy("t", "n").agg(F.first("bytes").alias("bytes"))


def _gathered(texts: DataFrame, places: DataFrame) -> DataFrame:
    """The texts with their places."""
    return texts.join(places.groupBy("t", "n").agg(F.collect_list(F.struct("core", "p")).alias("open")), ["t", "n"])


def repeated_spans(
    docs: DataFrame, text_col: str = "text", length: int = LENGTH, gram: int = GRAM, runs: tuple[int, ...] = RUNS, batches: int = BATCHES
) -> DataFrame:
    """``t``, ``n`` (a text) and its ``spans``: an array of first and last byte (exclusive), unordered, overlapping."""
    widths = (length - gram + 1, *runs)
    if runs[-1] != 1 or any(a % b for a, b in zip(widths, widths[1:])):
        raise ValueError(f"{widths}: each must divide the one before, down to 1")
    stage = Stage(docs.sparkSession, "suffixes")
    batch = F.pmod("t", F.lit(batches)).alias("batch")
    every = stage.keep("entries", entries(docs, text_col, length, gram).select("*", batch), partition_by="batch")
    family = Family(stage)
    for k in range(batches):
        family.add(every.filter(F.col("batch") == k).drop("batch"))
    windows = length - gram + 1
    whole = members(every, reduce(DataFrame.unionByName, family.repeated))
    spans = [whole.select(*PLACE, F.lit(windows).alias("m"))]
    still_open = family.union().join(_union_distinct(family.open), "core", "left_semi").select("core", *PLACE)
    still_open = stage.keep("stretches", still_open)
    texts = stage.keep("texts", _texts(docs, text_col, still_open))
    many = stage.keep("many", still_open.groupBy("core").count().filter(F.col("count") > GROUP_ROWS).select("core"))
    few = _gathered(texts, still_open.join(many, "core", "left_anti")).select("t", "n", "bytes", F.explode("open").alias("s"))
    after = F.greatest(F.col("s.p"), F.lit(0))
    around = F.substring("bytes", after + 1, F.col("s.p") + windows + length - 1 - after)
    spans.append(stage.keep("few", window_spans(few.select("s.core", "t", "n", "s.p", around.alias("around")), windows, length)))
    still_open = still_open.join(many, "core", "left_semi")
    for run in runs if not many.isEmpty() else ():
        rows = stage.keep("runs", split(_gathered(texts, still_open), windows, run, length))
        equal = stage.keep("classes", classes(rows, F.lit(1)))
        spans.append(members(rows, equal.filter("copies > 1")).select(*PLACE, F.lit(run).alias("m")))
        if run > 1:
            still_open = stage.keep("stretches", equal.join(open_cores(equal), "core", "left_semi").select("core", *PLACE))
            windows = run
    first, last = F.greatest(F.col("p"), F.lit(0)), F.col("p") + F.col("m") - 1 + length
    placed = reduce(DataFrame.unionByName, spans).distinct()
    span = F.struct(first.alias("first"), F.least(last, F.col("n")).alias("last"))
    kept = stage.keep("spans", placed.groupBy("t", "n").agg(F.collect_list(span).alias("spans")))
    stage.drop("entries", "repeated", "open", "stretches", "texts", "many", "few", "runs", "classes", *[name for _, name, _ in family.arrays])
    return kept


def remove_repeats(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows with ``kept`` (the bytes that stay), ``n_bytes``, ``n_removed`` and ``n_spans`` (maximal removed stretches)."""
    spans = repeated_spans(docs, text_col, **options)

    @F.pandas_udf("kept binary, n_spans long")
    def cut(bodies, stretches):
        import numpy as np
        import pandas as pd

        kept, counts = [], []
        for body, found in zip(bodies, stretches):
            if body is None:
                kept.append(None)
                counts.append(0)
                continue
            ends = np.array(sorted((s["first"], s["last"]) for s in found), np.int64)
            reach = np.maximum.accumulate(ends[:, 1])
            new = np.flatnonzero(np.r_[True, ends[1:, 0] > reach[:-1]])
            stops = np.r_[reach[new[1:] - 1], reach[-1]]
            starts = ends[new, 0]
            kept.append(b"".join(body[a:b] for a, b in zip([0, *stops.tolist()], [*starts.tolist(), len(body)])))
            counts.append(len(new))
        return pd.DataFrame({"kept": kept, "n_spans": counts})

    t, n, body, found, cuts = (free_name(docs.columns, c) for c in ("t", "n", "bytes", "spans", "cuts"))
    named = docs.select("*", *[c.alias(a) for c, a in zip(keyed(text_col), (t, n, body))])
    spans = spans.select(F.col("t").alias(t), F.col("n").alias(n), F.col("spans").alias(found))
    joined = named.join(spans, [t, n], "left")
    joined = joined.withColumn(cuts, cut(F.when(F.col(found).isNotNull(), F.col(body)), F.col(found)))
    added = {
        "kept": F.coalesce(F.col(f"{cuts}.kept"), F.col(body)),
        "n_bytes": F.col(n).cast("long"),
        "n_spans": F.coalesce(F.col(f"{cuts}.n_spans"), F.lit(0).cast("long")),
    }
    rest = [c for c in docs.columns if c.lower() not in (*added, "n_removed")]
    out = joined.select(*rest, *[c.alias(a) for a, c in added.items()])
    return out.withColumn("n_removed", F.col("n_bytes") - F.octet_length("kept"))
