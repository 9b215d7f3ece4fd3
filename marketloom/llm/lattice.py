"""SentencePiece ids of whole texts from a relational lattice of pieces, and texts from ids.

A text is cut into units: a word with the word marks before it. No piece reaches across a unit, so units
are segmented alone, and the common ones once for the whole corpus:

1. Units are counted over all texts. The ``KEPT_UNITS`` most frequent ones of at most ``LATTICE_LETTERS``
   letters form the lattice: their substrings of at most the longest piece's length are exploded and
   joined to the piece table, the edges found are grouped by unit, and a higher-order ``aggregate`` folds
   them into ids.
2. That table, of bounded size, goes to the tasks that encode. Units that are not in it are segmented in
   the task by the same rule: the short ones of many texts at once as rows of a matrix, a long one with
   a heap, so that its time grows as n log n.

The fold follows the kind of the vocabulary. ``bpe`` joins, again and again, the two adjacent segments
whose union is the best-scored piece. ``unigram`` is the Viterbi fold: the path of highest total score, ties
to the longest last piece. Letters without a piece become their UTF-8 bytes.

Decoding looks pieces up by id in an array column and joins their bytes, in the JVM.

Defined results
    null or empty text: no ids, decoded as empty. Texts that hold the word mark itself decode with spaces
    in its place. Repeated rows: the same ids. Empty table: no rows. Other columns: kept.
"""

from __future__ import annotations

import re
from array import array
from heapq import heappop, heappush
from itertools import filterfalse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm.common import Stage, free_name

MARK = "▁"
KEPT_UNITS = 40_000
LATTICE_LETTERS = 32  # longer units are segmented alone
CACHED_UNITS = 400_000  # further units that a worker remembers
ROWS_AT_ONCE = 4096  # units in one matrix
LETTERS_AT_ONCE = 1 << 20  # letters of texts whose units are segmented together
# A line feed has no piece of its own, so units end there too.
UNIT = f"\n|{MARK}*[^{MARK}\n]+|{MARK}+"
# Units as they are looked up: with a line feed goes the unit behind it.
_LOOKED_UP = re.compile(f"\n[^{MARK}\n]*|{MARK}*[^{MARK}\n]+|{MARK}+")
UNKNOWN_SCORE = -1e6
PIECE_END = "\ue000"


class Vocabulary:
    """Pieces with id and score, and the id of the first of the 256 byte pieces."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(size)]
        self.first_byte = self.pieces.index("<0x00>")
        odd = [model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i) for i in range(size)]
        self.table = {p: (i, model.get_score(i)) for i, p in enumerate(self.pieces) if not odd[i]}
        self.odd = odd
        self.longest = max(map(len, self.table))
        across = [p for p in self.table if MARK in p.lstrip(MARK)]
        if across or any("\n" in p for p in self.table):
            raise ValueError("pieces reach across words")

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(p, i, s) for p, (i, s) in self.table.items()], "piece string, id int, score double")


def common_units(texts: DataFrame, text: Column, kept: int) -> DataFrame:
    """The most frequent units of at most ``LATTICE_LETTERS`` letters (ties: the smaller string).

    Counted over all texts as what lies between two spaces, with the line feed kept in front of a word
    that follows it; a word after several spaces counts as after one.
    """
    between = F.explode(F.split(F.replace(text, F.lit("\n"), F.lit(" \n")), " ")).alias("word")
    counted = texts.select(between).groupBy("word").count()
    word = F.col("word")
    unit = F.when(word.startswith("\n"), F.expr("substring(word, 2)")).when(word != "", F.concat(F.lit(MARK), word))
    whole = F.char_length("unit").between(1, LATTICE_LETTERS) & ~F.substring("unit", 2, LATTICE_LETTERS).contains(MARK)
    short = counted.select(unit.alias("unit"), "count").filter(whole)
    return short.orderBy(F.desc("count"), "unit").limit(kept).select("unit")


def edges(words: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``unit``, ``n`` (its letters) and its ``edges``: start, stop, id and score of every piece in it."""
    spark = words.sparkSession
    starts = words.select("unit", F.char_length("unit").alias("n"), F.explode(F.sequence(F.lit(0), F.char_length("unit") - 1)).alias("start"))
    ends = F.sequence(F.col("start") + 1, F.least(F.col("n"), F.col("start") + vocabulary.longest))
    spans = starts.select("unit", "n", "start", F.explode(ends).alias("stop"))
    found = spans.withColumn("piece", F.substring("unit", F.col("start") + 1, F.col("stop") - F.col("start")))
    # The vocabulary file bounds this side.
    joined = found.join(F.broadcast(vocabulary.frame(spark)), "piece", "left")
    whole = F.col("id").isNotNull() | (F.col("stop") == F.col("start") + 1)
    edge = F.struct("start", "stop", "id", F.coalesce("score", F.lit(UNKNOWN_SCORE)).alias("score"))
    return joined.filter(whole).groupBy("unit", "n").agg(F.array_sort(F.collect_list(edge)).alias("edges"))


def merge_fold(n: Column, edges: Column) -> Column:
    """The ends of the segments of a byte-pair vocabulary, from the letters on."""

    def step(cuts, _):
        place = lambda x: F.array_position(cuts, x)
        joins = F.filter(edges, lambda e: e["id"].isNotNull() & (place(e["start"]) > 0) & (place(e["stop"]) == place(e["start"]) + 2))
        best = F.array_max(F.transform(joins, lambda e: F.struct(e["score"].alias("score"), (-e["start"]).alias("first"), e["stop"].alias("stop"))))
        kept = F.filter(cuts, lambda c: (c <= -best["first"]) | (c >= best["stop"]))
        return F.when(best.isNull(), cuts).otherwise(kept)

    steps = F.when(n > 1, F.sequence(F.lit(1), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(steps, F.sequence(F.lit(0), n), step)


def viterbi_fold(n: Column, edges: Column) -> Column:
    """The ends of the segments of the path with the highest sum of scores."""
    state = "array<struct<score:double,back:int>>"

    def step(best, stop):
        ways = F.filter(edges, lambda e: e["stop"] == stop)
        scored = F.transform(
            ways, lambda e: F.struct((F.element_at(best, e["start"] + 1)["score"] + e["score"]).alias("score"), (-e["start"]).alias("minus"))
        )
        top = F.array_min(F.transform(scored, lambda s: F.struct((-s["score"]).alias("cost"), (-s["minus"]).alias("back"))))
        return F.concat(best, F.array(F.struct((-top["cost"]).alias("score"), top["back"].alias("back"))))

    best = F.aggregate(F.sequence(F.lit(1), n), F.array(F.struct(F.lit(0.0).alias("score"), F.lit(0).alias("back"))).cast(state), step)
    back = lambda cuts: F.element_at(best, F.element_at(cuts, 1) + 1)["back"]
    walk = lambda cuts, _: F.when(F.element_at(cuts, 1) == 0, cuts).otherwise(F.concat(F.array(back(cuts)), cuts))
    return F.aggregate(F.sequence(F.lit(1), n), F.array(n), walk)


def folded(words: DataFrame, vocabulary: Vocabulary, kind: str = "bpe") -> DataFrame:
    """``unit`` and its ``ids``."""
    fold = {"bpe": merge_fold, "unigram": viterbi_fold}[kind]
    cut = edges(words, vocabulary).withColumn("cuts", fold(F.col("n"), F.col("edges")))

    def ids_of(start, place):
        stop = F.element_at(F.col("cuts"), place + 2)
        edge = F.element_at(F.filter("edges", lambda e: (e["start"] == start) & (e["stop"] == stop)), 1)
        hexed = F.hex(F.encode(F.substring(F.col("unit"), start + 1, F.lit(1)), "utf-8"))
        at = F.sequence(F.lit(1), F.char_length(hexed) - 1, F.lit(2))
        spelled = F.transform(at, lambda i: F.conv(F.substring(hexed, i, F.lit(2)), 16, 10).cast("int") + vocabulary.first_byte)
        return F.when(edge["id"].isNull(), spelled).otherwise(F.array(edge["id"]))

    starts = F.slice(F.col("cuts"), 1, F.size("cuts") - 1)
    return cut.select("unit", F.flatten(F.transform(starts, ids_of)).alias("ids"))


def merge_unit(unit: str, table: dict[str, tuple[int, float]], first_byte: int) -> list[int]:
    """``merge_fold`` for one unit of any length: adjacent pairs wait in a heap, stale ones are passed over."""
    n = len(unit)
    ends, before = list(range(1, n + 1)), list(range(-1, n - 1))  # of the segment that starts at a letter
    waiting: list[tuple[float, int, int, int]] = []

    def offer(start: int, middle: int) -> None:
        hit = table.get(unit[start : ends[middle]])
        if hit:
            heappush(waiting, (-hit[1], start, middle, ends[middle]))

    for i in range(n - 1):
        offer(i, i + 1)
    while waiting:
        _, start, middle, stop = heappop(waiting)
        if ends[start] != middle or ends[middle] != stop:
            continue
        ends[start], ends[middle] = stop, 0
        if stop < n:
            before[stop] = start
            offer(start, stop)
        if before[start] >= 0:
            offer(before[start], start)
    parts, at = [], 0
    while at < n:
        parts.append(unit[at : ends[at]])
        at = ends[at]
    return _numbered(parts, table, first_byte)


class Merges:
    """``merge_fold`` for many short units at once: a row of segments for each, one merge a row and step.

    A segment stays in the column it starts in and knows its neighbours, so a merge touches three places of a row.
    """

    def __init__(self, table: dict[str, tuple[int, float]], first_byte: int):
        import numpy as np

        letters = sorted({c for p in table for c in p})
        names = [*table, *(c for c in letters if c not in table)]
        place = {p: i for i, p in enumerate(names)}
        pairs = []
        for p, (_, score) in table.items():
            for cut in range(1, len(p)):
                left, right = place.get(p[:cut]), place.get(p[cut:])
                if left is not None and right is not None:
                    pairs.append((left * len(names) + right, score, place[p]))
        pairs.sort()
        self.table, self.first_byte, self.names = table, first_byte, len(names)
        self.keys = np.array([k for k, _, _ in pairs], np.int64)
        # Equal scores have the same rank, the best one 0. The last pair stands for none.
        rank = {x: i for i, x in enumerate(sorted({x for _, x, _ in pairs}, reverse=True))}
        self.none = len(rank)
        self.ranks = np.array([*(rank[x] for _, x, _ in pairs), self.none], np.int32)
        self.unions = np.array([*(u for _, _, u in pairs), -1], np.int32)
        self.numbers = np.array([table[p][0] if p in table else -1 for p in names], np.int32)
        self.of_letter = np.full(max(map(ord, letters), default=0) + 2, -1, np.int32)
        self.of_letter[[ord(c) for c in letters]] = [place[c] for c in letters]

    def _pairs(self, left, right):
        import numpy as np

        wanted = left.astype(np.int64) * self.names + right
        at = np.searchsorted(self.keys, wanted)
        found = (left >= 0) & (right >= 0) & (self.keys[np.minimum(at, len(self.keys) - 1)] == wanted)
        at = np.where(found, at, len(self.keys))
        return self.ranks[at], self.unions[at]

    def segmented(self, units: list[str]) -> list[bytes]:
        """The ids of each unit as 32-bit integers."""
        import numpy as np

        if not len(self.keys):
            return [array("i", merge_unit(u, self.table, self.first_byte)).tobytes() for u in units]
        # A column without a letter on either side.
        sizes, longest = np.array([len(u) for u in units]), max(map(len, units))
        width, shape = longest + 2, (len(units), longest + 2)
        points = np.array(units, f"U{longest}").view(np.int32).reshape(len(units), longest)
        alive = np.zeros(shape, bool)
        alive[:, 1:-1] = np.arange(longest) < sizes[:, None]
        rows = np.full(shape, -1, np.int32)
        rows[:, 1:-1] = np.where(alive[:, 1:-1], self.of_letter[np.minimum(points, len(self.of_letter) - 1)], -1)
        ranks, unions = np.full(shape, self.none, np.int32), np.full(shape, -1, np.int32)
        ranks[:, :-1], unions[:, :-1] = self._pairs(rows[:, :-1], rows[:, 1:])
        after = np.arange(1, rows.size + 1)
        before = after - 2
        by_row, kept = ranks, alive
        rows, ranks, unions, alive = rows.ravel(), ranks.ravel(), unions.ravel(), alive.ravel()
        live = np.arange(len(units))
        while len(live):
            at = live * width + by_row[live].argmin(1)
            more = ranks[at] < self.none
            live, at = live[more], at[more]
            gone = after[at]
            behind = after[gone]
            rows[at] = unions[at]
            after[at], before[behind] = behind, at
            ranks[gone], alive[gone] = self.none, False
            ranks[at], unions[at] = self._pairs(rows[at], rows[behind])
            first = before[at]
            ranks[first], unions[first] = self._pairs(rows[first], rows[at])
        numbers = np.where(rows >= 0, self.numbers[rows], -1).reshape(shape)
        spelled = np.flatnonzero(((numbers < 0) & kept).any(1)).tolist()
        flat, ends = numbers[kept].tobytes(), (np.cumsum(kept.sum(1)) * 4).tolist()
        out = [flat[a:b] for a, b in zip([0, *ends], ends)]
        for i in spelled:
            cuts = [*(np.flatnonzero(kept[i]) - 1).tolist(), len(units[i])]
            out[i] = array("i", _numbered([units[i][a:b] for a, b in zip(cuts, cuts[1:])], self.table, self.first_byte)).tobytes()
        return out


def viterbi_unit(unit: str, table: dict[str, tuple[int, float]], first_byte: int, longest: int) -> list[int]:
    """``viterbi_fold`` for one unit."""
    best: list[tuple[float, int]] = [(0.0, 0)]
    for stop in range(1, len(unit) + 1):
        ways = []
        for start in range(max(0, stop - longest), stop):
            hit = table.get(unit[start:stop])
            if hit or stop == start + 1:
                ways.append((-(best[start][0] + (hit[1] if hit else UNKNOWN_SCORE)), start))
        cost, start = min(ways)
        best.append((-cost, start))
    cuts = [len(unit)]
    while cuts[-1]:
        cuts.append(best[cuts[-1]][1])
    cuts.reverse()
    return _numbered([unit[a:b] for a, b in zip(cuts, cuts[1:])], table, first_byte)


def _numbered(parts: list[str], table, first_byte: int) -> list[int]:
    ids: list[int] = []
    for p in parts:
        hit = table.get(p)
        ids += [hit[0]] if hit else [first_byte + b for b in p.encode("utf-8", "surrogatepass")]
    return ids


def words(text: str) -> list[str]:
    """The units of a text as they are looked up: a word mark that is the only one of its unit is left out, and a
    line feed is joined to the unit behind it, if that has no mark."""
    spaced = text.replace("\n", " \n")
    if spaced and MARK not in text and "  " not in spaced and spaced[0] != " " and spaced[-1] != " ":
        return spaced.split(" ")
    return list(map(_unmarked, _LOOKED_UP.findall(MARK + text.replace(" ", MARK)))) if text else []


def _unmarked(unit: str) -> str:
    return unit[1:] if unit[0] == MARK and unit[1:2] not in ("", MARK) else unit


def _marked(word: str) -> str:
    """The unit of a word; of one with a line feed in front the unit behind it, which may be empty."""
    return word[1:] if word[0] == "\n" else word if word[0] == MARK else MARK + word


_KNOWN: dict[str, dict[str, bytes]] = {}


def _known(key: str, common: dict[str, bytes], feed: bytes) -> dict[str, bytes]:
    """The ids of the words that this worker remembers, from task to task; those of another table are given up.

    A function that a task carries along gets a copy of the variables around it, so only one of the module sees these.
    """
    if key not in _KNOWN:
        _KNOWN.clear()
        _KNOWN[key] = {_unmarked(u) if u[0] == MARK else "\n" + u: ids if u[0] == MARK else feed + ids for u, ids in common.items()}
    return _KNOWN[key]


def encode(docs: DataFrame, model: str, text_col: str = "text", kind: str = "bpe", kept: int = KEPT_UNITS) -> DataFrame:
    """The rows with ``ids``."""
    from uuid import uuid4

    spark = docs.sparkSession
    vocabulary = Vocabulary(model)
    text = F.coalesce(F.col(text_col), F.lit(""))
    stage = Stage(spark, "lattice")
    common = stage.keep("common", common_units(docs, text, kept))
    # A table of at most ``kept`` short units. They are few bytes and much work, so their number of partitions is fixed.
    tasks = max(8, spark.sparkContext.defaultParallelism)
    found = folded(common.repartition(tasks, "unit"), vocabulary, kind).toArrow()
    stage.drop("common")
    share = spark.sparkContext.broadcast(
        {u: array("i", ids).tobytes() for u, ids in zip(found.column("unit").to_pylist(), found.column("ids").to_pylist())}
    )
    table, first_byte, longest, key = vocabulary.table, vocabulary.first_byte, vocabulary.longest, uuid4().hex
    rules = spark.sparkContext.broadcast(Merges(table, first_byte))
    feed = array("i", _numbered(["\n"], table, first_byte)).tobytes()

    def segmented(units: list[str]) -> list[bytes]:
        """Units of like length, so that the matrix of the short ones has little padding."""
        merges = rules.value
        if kind != "bpe":
            return [array("i", viterbi_unit(u, table, first_byte, longest)).tobytes() for u in units]
        out, start = [], 0
        while start < len(units) and len(units[start]) <= LATTICE_LETTERS:
            stop = start
            most = min(LATTICE_LETTERS, len(units[start]) + 3)
            while stop < min(len(units), start + ROWS_AT_ONCE) and len(units[stop]) <= most:
                stop += 1
            out += merges.segmented(units[start:stop])
            start = stop
        return out + [array("i", merge_unit(u, merges.table, first_byte)).tobytes() for u in units[start:]]

    @F.pandas_udf("array<int>")
    def run(texts):
        import numpy as np
        import pandas as pd

        known = _known(key, share.value, feed)
        most, out, held, letters = len(share.value) + CACHED_UNITS, [], [], 0

        def flush():
            missing = set()
            for found in held:
                missing.update(filterfalse(known.__contains__, found))
            units = sorted({_marked(w) for w in missing} - {""}, key=len)
            ids = dict(zip(units, segmented(units))) if units else {}
            # Short words stay as long as there is room; the others serve these texts only.
            short = [w for w in missing if len(w) <= LATTICE_LETTERS]
            passing = missing.difference(short[: max(0, most - len(known))])
            known.update((w, feed + ids.get(_marked(w), b"") if w[0] == "\n" else ids[_marked(w)]) for w in missing)
            for found in held:
                out.append(np.frombuffer(b"".join(map(known.__getitem__, found)), np.int32))
            for w in passing:
                del known[w]
            held.clear()

        for t in texts:
            held.append(words(t or ""))
            letters += len(t or "")
            if letters >= LETTERS_AT_ONCE:
                flush()
                letters = 0
        flush()
        return pd.Series(out)

    return docs.withColumn(free_name(docs.columns, "ids"), run(F.col(text_col)))


def decode(encoded: DataFrame, model: str, ids_col: str = "ids", to: str = "decoded") -> DataFrame:
    """The rows with the text of the ids; control ids are passed over, null ids give the empty text."""
    vocabulary = Vocabulary(model)
    plain, spelled = [], []
    for i, p in enumerate(vocabulary.pieces):
        byte = re.fullmatch(r"<0x([0-9A-F]{2})>", p)
        own = "" if vocabulary.odd[i] else p.replace(MARK, " ")
        spelled.append(byte[1] if byte else own.encode().hex())
        plain.append(chr(int(byte[1], 16)) if byte else own)
    ids = F.coalesce(ids_col, F.array().cast("array<int>"))
    # One string, cut once when the plan is made; an array literal would cost a call for each piece.
    if any(PIECE_END in p for p in plain):
        raise ValueError("a piece holds the sign that ends pieces")
    listed = lambda table: F.split(F.lit(PIECE_END.join(table)), PIECE_END, -1)
    joined = lambda table: F.array_join(F.transform(ids, lambda i: F.element_at(listed(table), i + 1)), "")
    # Bytes beyond ASCII are parts of letters, so such texts are put together byte by byte.
    parts = F.exists(ids, lambda i: i.between(vocabulary.first_byte + 128, vocabulary.first_byte + 255))
    text = F.when(parts, F.decode(F.unhex(joined(spelled)), "utf-8")).otherwise(joined(plain))
    return encoded.withColumn(to, F.when(text.startswith(" "), F.substring(text, 2, 2**31 - 1)).otherwise(text))
