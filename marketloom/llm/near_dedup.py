"""Near-duplicate groups: MinHash signatures, banding, verification on full shingle sets, connected components.

1. Every text becomes its set of word shingles and the minima of the set under ``BANDS * BAND_ROWS``
   universal hash functions. Rows with the same set are one class, represented by its smallest id.
2. Representatives that agree in all rows of a band share a bucket. In each bucket all members are
   compared with its smallest one: a star, not all pairs. A pair goes on when enough minima agree, and is
   a link when the full sets, made again from both whole texts, are similar enough.
3. Components of these links. A bucket that still holds several components can hide a link between
   members other than its smallest, so there every member outside the largest component is compared
   with all members of the other components. Members and those that ask are both dealt out in slices,
   so a task holds one slice of each. It reads minima first: only members that agree in enough of them
   with one of another component go on to the full sets, with their texts. There a member counts the
   shingles it shares with all rows of a slice at once, and one link for each component it meets leaves
   the task, never the pairs compared. The components of all links are the result.

With 24 bands of 4 rows, two sets at the threshold 0.85 share no bucket with probability 2e-8; the
agreement asked for lies six standard deviations below the threshold (1e-9).

Defined results
    null or empty text, or white space only: no shingles, linked with nothing. Fewer words than a
    shingle: the whole sequence is one. Null ids: linked with nothing, component null, kept. Repeated
    rows: the same component; rows that share an id are one node. Empty table: no rows.
    Other columns: ignored by ``groups``, kept by ``deduplicate``.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import Stage, free_name
from marketloom.llm.components import components

SHINGLE_WORDS = 5
PERCENT = 80
BANDS = 24
BAND_ROWS = 4
SLICE_ROWS = 1024


def least_agreement(percent: int, minima: int) -> int:
    """Equal minima below which a pair at the threshold is out of the question (six deviations)."""
    p = percent / 100
    return math.floor(minima * p - 6 * math.sqrt(minima * p * (1 - p)))


def signatures(docs: DataFrame, id_col: str, text_col: str, words: int, bands: int, rows: int) -> DataFrame:
    """``id``, ``n`` (set size), ``s0`` and ``s1`` (the set's digest), ``keys`` of the bands, ``minima`` (16 bits of each)."""
    import numpy as np
    import pyarrow as pa

    from marketloom.llm import shingles

    names = ["id", "n", "s0", "s1", "keys", "minima"]
    functions = shingles.Minima(bands, rows)

    def sign(batches):
        for batch in batches:
            n, s0, s1 = [], [], []
            minima = np.zeros((batch.num_rows, bands * rows), np.uint64)
            for i, text in enumerate(batch.column(1)):
                x = shingles.shingle_set(text.as_py(), words)
                n.append(len(x))
                s0.append(int(shingles.mixed(x, 0).sum(dtype=np.uint64).view(np.int64)))
                s1.append(int(shingles.mixed(x, 3).sum(dtype=np.uint64).view(np.int64)))
                minima[i] = functions.of(x)
            keys = functions.band_keys(minima)
            low = (minima >> np.uint64(40)).astype(np.uint16)
            keys_column = pa.ListArray.from_arrays(np.arange(batch.num_rows + 1, dtype=np.int32) * bands, pa.array(keys.reshape(-1)))
            columns = [batch.column(0).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(s0, pa.int64()), pa.array(s1, pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, keys_column, pa.array([r.tobytes() for r in low], pa.binary())], names)

    schema = "id long, n long, s0 long, s1 long, keys array<long>, minima binary"
    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(sign, schema)


def _agreeing(pairs: DataFrame, reps: DataFrame, least: int) -> DataFrame:
    """Pairs ``a``, ``b`` whose signatures agree in enough minima."""
    import numpy as np
    import pyarrow.compute as pc

    one = reps.select(F.col("id").alias("a"), F.col("minima").alias("ma"))
    other = reps.select(F.col("id").alias("b"), F.col("minima").alias("mb"))

    def agree(batches):
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(batch.num_rows, -1) for c in ("ma", "mb"))
                batch = batch.filter(pc.equal((x == y).sum(1) >= least, True))
            yield batch.select(["a", "b"])

    return pairs.join(one, "a").join(other, "b").select("a", "b", "ma", "mb").mapInArrow(agree, "a long, b long")


def _links(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs whose full shingle sets are similar enough."""
    import numpy as np
    import pyarrow as pa

    from marketloom.llm import shingles

    both = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a").join(
        texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b"
    )

    def verify(batches):
        hub, hub_set = None, None
        for batch in batches:
            a, b = [], []
            for x, y, tx, ty in zip(*(batch.column(c) for c in ("a", "b", "ta", "tb"))):
                if hub != y.as_py():
                    hub, hub_set = y.as_py(), shingles.shingle_set(ty.as_py(), words)
                own = shingles.shingle_set(tx.as_py(), words)
                common = len(np.intersect1d(own, hub_set, assume_unique=True))
                if 100 * common >= percent * (len(own) + len(hub_set) - common):
                    a.append(x.as_py())
                    b.append(hub)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return both.sortWithinPartitions("b").mapInArrow(verify, "a long, b long")


def _candidates(buckets: DataFrame, of: DataFrame, reps: DataFrame, least: int) -> DataFrame:
    """Members of mixed buckets that agree in enough minima with one of another component, by the slices that met.

    ``key``, ``slice``, ``asking`` (the slice of those that ask), ``id``, ``component``, ``asks``.
    """
    import numpy as np
    import pyarrow as pa

    labelled = buckets.join(of.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    by_component = labelled.groupBy("key", "component").agg(F.count("*").alias("n"))
    cuts = lambda n: F.greatest(F.lit(1), F.ceil(n / SLICE_ROWS)).cast("int")
    mixed = (
        by_component.groupBy("key")
        .agg(F.sum("n").alias("all"), F.count("*").alias("parts"), F.max(F.struct("n", "component")).alias("most"))
        .filter("parts > 1")
        .select("key", F.col("most.component").alias("largest"), cuts(F.col("all")).alias("slices"), cuts(F.col("all") - F.col("most.n")).alias("askings"))
    )
    members = labelled.join(mixed, "key").withColumn("asks", F.col("component") != F.col("largest"))
    members = members.join(reps.select("id", "minima"), "id")
    cut = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    # A row is looked at in its own slice, by each slice of those outside the largest component.
    own = F.transform(every("askings"), lambda j: F.struct(cut("slices").alias("slice"), j.alias("asking"), F.lit(False).alias("asks")))
    asked = F.transform(every("slices"), lambda i: F.struct(i.alias("slice"), cut("askings").alias("asking"), F.lit(True).alias("asks")))
    dealt = members.select("key", "id", "component", "minima", F.explode(F.when(F.col("asks"), F.concat(own, asked)).otherwise(own)).alias("at"))
    dealt = dealt.select("key", "at.slice", "at.asking", "id", "component", "at.asks", "minima")
    names = ["key", "slice", "asking", "id", "component", "asks"]

    types = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.bool_()]

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 6, types)], names)

    def agreeing(place, rows):
        ids, parts, asks, minima = zip(*rows)
        low = np.frombuffer(b"".join(minima), np.uint16).reshape(len(ids), -1)
        parts, asks, found = np.array(parts), np.array(asks), np.zeros(len(ids), bool)
        own = np.flatnonzero(~asks)
        for i in np.flatnonzero(asks):
            with_it = own[(parts[own] != parts[i]) & ((low[own] == low[i]).sum(1) >= least)]
            found[with_it] = True
            found[i] = len(with_it) > 0
        return [(*place, ids[i], int(parts[i]), bool(asks[i])) for i in np.flatnonzero(found)]

    def run(batches):
        place, held = None, []
        for batch in batches:
            out = []
            for k, i, j, *row in zip(*(batch.column(c).to_pylist() for c in (*names, "minima"))):
                if (k, i, j) != place:
                    if held:
                        out += agreeing(place, held)
                    place, held = (k, i, j), []
                held.append(row)
            yield batch_of(out)
        if held:
            yield batch_of(agreeing(place, held))

    place = ("key", "slice", "asking")
    schema = "key long, slice int, asking int, id long, component long, asks boolean"
    return dealt.repartition(*place).sortWithinPartitions(*place).mapInArrow(run, schema)


def _across(candidates: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Links between candidates of different components whose slices met, one per member and component met."""
    import numpy as np
    import pyarrow as pa

    from marketloom.llm import shingles

    dealt = candidates.join(texts, "id").select("key", "slice", "asking", "id", "component", "asks", "text")

    def compare(rows):
        ids, parts, asks, texts = zip(*rows)
        sets = [shingles.shingle_set(t, words) for t in texts]
        here = [i for i, asking in enumerate(asks) if not asking]
        sizes, parts = np.array([len(x) for x in sets]), np.array(parts)
        every = np.concatenate([sets[i] for i in here] or [np.empty(0, np.uint64)])
        owner = np.repeat(here, sizes[here]) if here else np.empty(0, np.int64)
        order = np.argsort(every, kind="stable")
        every, owner = every[order], owner[order]
        for i in np.flatnonzero(asks):
            first, last = np.searchsorted(every, sets[i], "left"), np.searchsorted(every, sets[i], "right")
            hits = last - first
            at = np.repeat(first - np.concatenate([[0], np.cumsum(hits)[:-1]]), hits) + np.arange(hits.sum())
            common = np.bincount(owner[at], minlength=len(ids))
            linked = (100 * common >= percent * (sizes + sizes[i] - common)) & (common > 0) & (parts != parts[i])
            for j in {parts[j]: j for j in np.flatnonzero(linked)}.values():
                yield max(ids[i], ids[j]), min(ids[i], ids[j])

    def run(batches):
        group, held = None, []
        for batch in batches:
            pairs = set()
            columns = (batch.column(c).to_pylist() for c in ("key", "slice", "asking", "id", "component", "asks", "text"))
            for key, own, asking, *row in zip(*columns):
                if (key, own, asking) != group:
                    if held:
                        pairs.update(compare(held))
                    group, held = (key, own, asking), []
                held.append(row)
            yield _pairs(pa, pairs)
        if held:
            yield _pairs(pa, set(compare(held)))

    place = ("key", "slice", "asking")
    return dealt.repartition(*place).sortWithinPartitions(*place).mapInArrow(run, "a long, b long").distinct()


def _pairs(pa, pairs):
    a, b = zip(*pairs) if pairs else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    percent: int = PERCENT,
    bands: int = BANDS,
    band_rows: int = BAND_ROWS,
) -> DataFrame:
    """One row per input row: ``id``, ``n_shingles``, ``component_id`` (the smallest id reachable), ``kept``."""
    stage = Stage(docs.sparkSession, "near")
    least = least_agreement(percent, bands * band_rows)
    signed = stage.keep("signed", signatures(docs, id_col, text_col, shingle_words, bands, band_rows))
    shape = ["s0", "s1", "n"]
    some = signed.filter("n > 0 AND id IS NOT NULL")
    classes = stage.keep("classes", some.groupBy(*shape).agg(F.min("id").alias("rep")))
    reps = some.join(classes, [some[c].eqNullSafe(classes[c]) for c in shape] + [some["id"] == classes["rep"]], "left_semi")
    # A representative whose id names other rows too stands for all of them: they are linked through the id.
    reps = stage.keep("reps", reps.select("id", "keys", "minima").dropDuplicates(["id", "keys"]))
    buckets = reps.select(F.explode("keys").alias("key"), "id")
    shared = buckets.groupBy("key").agg(F.min("id").alias("hub"), F.count("*").alias("members")).filter("members > 1")
    buckets = stage.keep("buckets", buckets.join(shared.select("key", "hub"), "key"))
    star = buckets.filter("id <> hub").select(F.col("id").alias("a"), F.col("hub").alias("b")).distinct()
    # Only texts of documents that share a bucket are read again, once.
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    texts = stage.keep("texts", texts.join(buckets.select("id").distinct(), "id").dropDuplicates(["id"]))
    one = reps.dropDuplicates(["id"])
    agreeing = stage.keep("star", _agreeing(star, one, least))
    first = stage.keep("links", _links(agreeing, texts, shingle_words, percent))
    same_id = some.join(classes, shape).filter("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    met = stage.keep("met", _candidates(buckets.select("key", "id"), components(first), one, least))
    more = stage.keep("across", _across(met, texts, shingle_words, percent))
    links = first.unionByName(more).unionByName(same_id)
    of = components(links)
    stage.drop("classes", "reps", "buckets", "texts", "star", "links", "met", "across")
    return (
        signed.select("id", F.col("n").alias("n_shingles"))
        .join(of.withColumnRenamed("node", "id"), "id", "left")
        .select(
            "id", "n_shingles", F.coalesce("component", "id").alias("component_id"),
            (F.col("component").isNull()).alias("kept"),
        )
    )


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of one document of each group, that with the smallest id, with all their columns."""
    gone = free_name(docs.columns, "gone")
    dropped = groups(docs, id_col, text_col, **options).filter(~F.col("kept")).select(F.col("id").alias(gone)).distinct()
    return docs.join(dropped, docs[id_col].cast("long") == F.col(gone), "left_anti")
