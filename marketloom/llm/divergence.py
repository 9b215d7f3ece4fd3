"""Divergence audit of sources: how far the word shares of two sources of a language lie apart.

A term is a run of ASCII letters and other non-ASCII characters, A-Z in lower case. A language keeps the
terms of enough of its documents. With ``count`` occurrences of a kept term in a group (one source of one
language), ``total`` over all kept terms and ``kept`` terms, the group's share of the term is

    1 + floor(SCALE * (count + SMOOTHING) / (total + SMOOTHING * kept))

Two sources are apart by the sum of the absolute differences of their shares over all kept terms, those that
neither has included.

The sum is a sparse matrix product in Gustavson's order. The term-major index lists for each term the groups
that have it. It is dealt out in blocks of terms. In a block, each group (a row) goes through the postings of
its own terms and scatters into one dense accumulator with a cell for each peer:

    |p - q| - |p - q0| - |p0 - q| + |p0 - q0|      p, q: shares in row and peer, p0, q0: shares of absent terms

That corrects the baseline, which takes every term as absent from one of the two: the sum of ``|p - q0|`` over
the row's terms and of ``|p0 - q|`` over the peer's (from sorted shares and their running sums), and
``|p0 - q0|`` for all other terms. So pairs of postings are added where they are met and never become rows;
a block yields one row per row and peer, and Spark adds the blocks up. Hot languages have more blocks, and
languages of many groups deal their rows out in slices, so a task holds a block of postings and a slice of rows.

Shares are decimal in Spark and whole 64-bit numbers in the tasks, where every sum stays below 2^53.

Defined results
    null text, language or source: the empty string. Texts without terms: their group still counts as a
    peer. Languages without kept terms: all pairs have the value 0, there are no term rows. Repeated rows:
    each counts. Empty table: no rows. Other columns: ignored. Very long texts and words: taken whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import Stage

LEAST_DOCUMENTS = 30
TOP_TERMS = 50
SCALE = 1_000_000_000
SMOOTHING = 5
BLOCK_POSTINGS = 1_000_000
SLICE_CELLS = 1_000_000  # rows of a slice times peers
HELD_TERMS = 200_000

# Bytes that separate terms become spaces, A-Z become a-z; bytes above 0x7F are parts of letters.
_FOLDED = bytes(b if 0x61 <= b <= 0x7A or b >= 0x80 else b + 0x20 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def term_counts(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """``lang``, ``source``, ``term``, ``n`` (occurrences) and ``docs`` (documents with it), by group and term.

    Tasks add up what they read in tables of bounded size, so most words never become rows.
    """
    from collections import Counter, defaultdict

    import pyarrow as pa

    names = ["lang", "source", "term", "n", "docs"]
    types = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()]

    def rows(held):
        for (of_lang, of_source), (n, documents) in held.items():
            terms = list(n)
            cells = [
                pa.array([of_lang] * len(terms)), pa.array([of_source] * len(terms)), pa.array(terms, pa.binary()).cast(pa.string()),
                pa.array(list(n.values())), pa.array([documents[t] for t in terms]),
            ]
            for at in range(0, len(terms), 50_000):
                yield pa.RecordBatch.from_arrays([c.slice(at, 50_000).cast(t) for c, t in zip(cells, types)], names)

    def count(batches):
        held = defaultdict(lambda: (Counter(), Counter()))
        size = 0
        for batch in batches:
            for of_lang, of_source, body in zip(*(batch.column(i) for i in range(3))):
                words = body.as_py().encode("utf-8", "surrogatepass").translate(_FOLDED).split()
                n, documents = held[of_lang.as_py(), of_source.as_py()]
                before = len(n)
                n.update(words)
                documents.update(set(words))
                size += len(n) - before
                if size > HELD_TERMS:
                    yield from rows(held)
                    held.clear()
                    size = 0
        yield from rows(held)

    plain = docs.select(*[F.coalesce(F.col(c), F.lit("")) for c in (lang, source, text)])
    counted = plain.mapInArrow(count, "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column, kept: Column) -> Column:
    """The smoothed share, exact for counts of any size; null where a language keeps no terms."""
    wide = lambda c: c.cast("decimal(20,0)")
    below = F.when(kept > 0, wide(total) + wide(kept * SMOOTHING))
    return (F.lit(1) + F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * wide(count + SMOOTHING), below)).cast("long")


class Audit:
    """The tables that both parts of the audit read, each written once."""

    def __init__(self, docs: DataFrame, lang: str, source: str, text: str, least_documents: int):
        self.stage = Stage(docs.sparkSession, "divergence")
        counts = self.stage.keep("counts", term_counts(docs, lang, source, text))
        posting = F.struct("source", "n")
        # The term-major index: a term lists each group at most once.
        index = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"), F.collect_list(posting).alias("postings"))
        self.index = self.stage.keep("index", index.filter(F.col("docs") >= least_documents).select("lang", "term", "n", "postings"))
        self.stage.drop("counts")
        named = [F.coalesce(F.col(c), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"))]
        per_group = self.postings().groupBy("lang", "source").agg(F.sum("n").alias("total"))
        per_lang = self.index.groupBy("lang").agg(
            F.count("*").alias("kept"), F.sum("n").alias("lang_total"), F.sum(F.size("postings")).alias("n_postings")
        )
        groups = docs.select(*named).distinct().join(per_group, ["lang", "source"], "left").join(per_lang, "lang", "left")
        groups = self.stage.keep("groups", groups.fillna(0, ["total", "kept", "lang_total", "n_postings"]))
        peers = groups.groupBy("lang").agg(F.count("*").alias("n_peers"))
        absent = F.coalesce(share(F.lit(0).cast("long"), F.col("total"), F.col("kept")), F.lit(0)).alias("absent")
        self.groups = groups.join(peers, "lang").select(
            "*", absent,
            F.greatest(F.lit(1), F.ceil(F.col("n_postings") / BLOCK_POSTINGS)).cast("int").alias("blocks"),
            F.greatest(F.lit(1), F.ceil(F.col("n_peers") * F.col("n_peers") / SLICE_CELLS)).cast("int").alias("slices"),
        )

    def postings(self) -> DataFrame:
        """The index, one row per term and group."""
        return self.index.select("lang", "term", F.col("n").alias("lang_n"), F.explode("postings").alias("p")).select("lang", "term", "lang_n", "p.*")

    def shares(self) -> DataFrame:
        """Postings with the ``share`` of the term in the group, and what is known of the group."""
        known = self.postings().join(self.groups, ["lang", "source"])
        return known.withColumn("share", share(F.col("n"), F.col("total"), F.col("kept")))


def _accumulate(key, postings, peers):
    """The sums of one block of terms: a row per group of the slice and peer."""
    import numpy as np
    import pyarrow as pa

    block, piece, names = key[1].as_py(), key[2].as_py(), peers.column("source").to_pylist()
    order = sorted(range(len(names)), key=lambda i: names[i])
    place = {names[i]: k for k, i in enumerate(order)}
    absent = peers.column("absent").to_numpy()[order]
    mine = peers.column("mine").to_numpy(zero_copy_only=False)[order]
    terms = postings.column("term").dictionary_encode().combine_chunks()
    term = terms.indices.to_numpy(zero_copy_only=False).astype(np.int64) if len(postings) else np.empty(0, np.int64)
    n_terms = len(terms.dictionary) if len(postings) else 0
    group = np.fromiter((place[s] for s in postings.column("source").to_pylist()), np.int64, len(postings))
    p = postings.column("share").to_numpy()

    by_term = np.argsort(term, kind="stable")
    first = np.searchsorted(term[by_term], np.arange(n_terms + 1))
    peer_of, share_of = group[by_term], p[by_term]
    by_group = np.argsort(group, kind="stable")
    starts = np.searchsorted(group[by_group], np.arange(len(names) + 1))
    sizes = np.diff(starts)
    distance = np.zeros((len(names),), np.int64)

    def to_absent(row, others):
        """The sum of |p - q0| over the terms of a row, for each of some values q0."""
        own = np.sort(p[by_group[starts[row] : starts[row + 1]]])
        sums = np.concatenate([[0], np.cumsum(own)])
        below = np.searchsorted(own, others)
        return others * below - sums[below] + (sums[-1] - sums[below]) - others * (len(own) - below)

    out_row, out_peer, out_sum = [], [], []
    everyone = np.arange(len(names))
    mine_rows = np.flatnonzero(mine)
    # The peer's part of the baseline: its terms against the share that an absent term has in each row.
    theirs = np.stack([to_absent(s, absent[mine_rows]) for s in everyone], 1) if len(mine_rows) else None
    for k, row in enumerate(mine_rows):
        own = by_group[starts[row] : starts[row + 1]]
        distance = to_absent(row, absent) + theirs[k] + (n_terms - sizes[row] - sizes) * np.abs(absent[row] - absent)
        for at in range(0, len(own), 8192):
            some = own[at : at + 8192]
            lengths = first[term[some] + 1] - first[term[some]]
            hit = np.repeat(first[term[some]] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
            q, q0, mine_p = share_of[hit], absent[peer_of[hit]], np.repeat(p[some], lengths)
            p0 = absent[row]
            np.add.at(distance, peer_of[hit], np.abs(mine_p - q) - np.abs(mine_p - q0) - np.abs(p0 - q) + np.abs(p0 - q0))
        keep = everyone != row
        out_row += [names[order[row]]] * int(keep.sum())
        out_peer += [names[order[s]] for s in everyone[keep]]
        out_sum.append(distance[keep])
    n = len(out_row)
    sums = np.concatenate(out_sum) if out_sum else np.empty(0, np.int64)
    return pa.table({"lang": pa.array([key[0].as_py()] * n, pa.string()), "source": pa.array(out_row, pa.string()), "peer": pa.array(out_peer, pa.string()), "value": sums})


def pair_distances(audit: Audit) -> DataFrame:
    """``lang``, ``source``, ``peer``, ``value`` for every two groups of a language, both ways."""
    slice_of = F.pmod(F.xxhash64("source"), F.col("slices")).cast("int")
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    postings = audit.shares().select(
        "lang", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("block"), F.explode(every("slices")).alias("slice"), "term", "source", "share"
    )
    peers = (
        audit.groups.select("lang", "source", "absent", "slices", slice_of.alias("own"), F.explode(every("blocks")).alias("block"))
        .select("*", F.explode(every("slices")).alias("slice"))
        .select("lang", "block", "slice", "source", "absent", (F.col("own") == F.col("slice")).alias("mine"))
    )
    place = ("lang", "block", "slice")
    sums = postings.groupBy(*place).cogroup(peers.groupBy(*place)).applyInArrow(_accumulate, "lang string, source string, peer string, value long")
    return sums.groupBy("lang", "source", "peer").agg(F.sum("value").alias("value"))


def marked_terms(audit: Audit, top: int = TOP_TERMS) -> DataFrame:
    """``lang``, ``source``, ``term``, ``value``, ``rank``: the terms a group has more of than its language, most of all first."""
    over = audit.shares().withColumn("value", F.col("share") - share(F.col("lang_n"), F.col("lang_total"), F.col("kept")))
    return _ranked(over.filter("value > 0").select("lang", "source", "term", "value"), "term").filter(F.col("rank") <= top)


def _ranked(rows: DataFrame, item: str) -> DataFrame:
    from pyspark.sql import Window

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), item)
    return rows.withColumn("rank", F.row_number().over(order))


def audit(
    docs: DataFrame,
    lang: str = "lang",
    source: str = "source",
    text: str = "text",
    least_documents: int = LEAST_DOCUMENTS,
    top: int = TOP_TERMS,
) -> DataFrame:
    """``lang``, ``source``, ``part`` (pair or term), ``item``, ``value``, ``rank``."""
    known = Audit(docs, lang, source, text, least_documents)
    parts = [("pair", _ranked(pair_distances(known), "peer"), "peer"), ("term", marked_terms(known, top), "term")]
    pairs, terms = (rows.select("lang", "source", F.lit(part).alias("part"), F.col(item).alias("item"), "value", "rank") for part, rows, item in parts)
    return known.stage.keep("result", pairs.unionByName(terms))
