"""Packing and piece lattices against brute force and the libraries."""

import math
import random
import re
import zlib
from array import array
from collections import Counter

import pytest
from pyspark.sql import functions as F

from marketloom.llm import lattice, packing
from marketloom.llm.queries import byte_bpe, piece_bpe
from marketloom.llm.tokens import encoder

SCHEMA = "doc_id long, text string, length string, task int, ids string"
TEXTS = [None, "", " ", "a  b", "a   b \n ", "<|endoftext|> x", "日本 語", "word " * 3000, "x\ty\r\nz ", "é" * 50, "a  b", "same text", "same text"]


def table(spark, texts):
    return spark.createDataFrame([(i, t, "l", 1, "x") for i, t in enumerate(texts)], SCHEMA)


def test_ids_equal_the_library():
    from tokenizers import Tokenizer

    whole, fast = Tokenizer.from_file(byte_bpe()), encoder(byte_bpe())
    rng = random.Random(1)
    parts = ["a", "b", " ", " ", "\n", "\t", "'s", "12", "é", "日本", "　", "<|endoftext|>", ".", "🙂"]
    texts = [t or "" for t in TEXTS] + ["".join(rng.choices(parts, k=rng.randint(0, 10))) for _ in range(3000)]
    for t in texts:
        assert fast.encode(t) == array("I", whole.encode(t, add_special_tokens=False).ids).tobytes(), repr(t)


def test_pieces_and_places(spark):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(byte_bpe())
    want = Counter()
    for i, t in enumerate(TEXTS):
        ids = whole.encode(t or "", add_special_tokens=False).ids + [2]
        for k, (a, n) in enumerate(packing.cut(len(ids), 64)):
            want[(i, k, a, n, zlib.crc32(array("I", ids[a : a + n]).tobytes()))] += 1
    cut = packing.pieces(table(spark, TEXTS).repartition(3), byte_bpe(), capacity=64)
    rows = packing.pack(cut.withColumn("crc", F.crc32("ids")), 64).collect()
    assert Counter((r.id, r.piece, r.start, r.length, r.crc) for r in rows) == want
    places = Counter((r.sequence_id, p) for r in rows for p in range(r.offset, r.offset + r.length))
    assert max(places.values()) == 1
    used = Counter(s for s, _ in places)
    assert all((s, p) in places for s, n in used.items() for p in range(n)) and max(used.values()) <= 64
    assert len(used) <= math.ceil(sum(r.length for r in rows) / 64) + 1


def test_cut_puts_the_remainder_first():
    assert list(packing.cut(5, 4)) == [(0, 1), (1, 4)]
    assert list(packing.cut(8, 4)) == [(0, 4), (4, 4)] and list(packing.cut(4, 4)) == [(0, 4)]


def best_possible(items, capacity):
    """Fewest sequences, by trying every place for every item."""
    best = [len(items)]

    def place(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(items):
            best[0] = len(rooms)
            return
        for k in range(len(rooms)):
            if rooms[k] >= items[i]:
                place(i + 1, [*rooms[:k], rooms[k] - items[i], *rooms[k + 1 :]])
        place(i + 1, [*rooms, capacity - items[i]])

    place(0, [])
    return best[0]


def test_plan_is_valid_and_reduction_keeps_the_optimum():
    rng = random.Random(2)
    for _ in range(300):
        items = sorted((rng.randint(1, 12) for _ in range(rng.randint(0, 8))), reverse=True)
        counts = dict(Counter(items))
        runs, left = packing.reduce(counts, 12)
        rest = sorted(Counter(left).elements(), reverse=True)
        assert sum(n for n, _ in runs) + best_possible(rest, 12) == best_possible(items, 12)
        plan = packing.plan(counts, 12)
        assert sum((Counter({w: k * n for w, k in c.items()}) for n, c in plan), Counter()) == Counter(items)
        assert all(sum(w * k for w, k in c.items()) <= 12 for _, c in plan)
        assert sum(n for n, _ in plan) <= sum(n for n, _ in packing.best_fit(counts, 12))


def test_pack_refuses_lengths_beyond_the_capacity(spark):
    with pytest.raises(Exception, match="between 1 and 8"):
        packing.pack(spark.createDataFrame([(1, 9)], "k int, length long"), 8)
    assert packing.pack(spark.createDataFrame([], "k int, length long"), 8).count() == 0


@pytest.fixture(scope="module")
def vocabulary():
    return lattice.Vocabulary(piece_bpe())


def test_lattice_ids_equal_the_library_and_decode(spark, vocabulary):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=piece_bpe())
    docs = table(spark, TEXTS + ["a\nb c", "tab\there", "   lead", "trail  ", "x" * 40]).drop("ids")
    rows = lattice.decode(lattice.encode(docs, piece_bpe(), kept=20), piece_bpe()).collect()
    assert all(list(r.ids) == model.encode(r.text or "") and r.decoded == (r.text or "") for r in rows)
    assert len(rows) == docs.count() and lattice.encode(docs.filter("doc_id < 0"), piece_bpe()).count() == 0


def test_both_folds_equal_brute_force(spark, vocabulary):
    rng = random.Random(4)
    units = sorted({"▁" + "".join(rng.choices("abeinrt日é", k=rng.randint(1, 7))) for _ in range(150)} | {"▁", "▁▁▁", "\n"})
    frame = spark.createDataFrame([(u,) for u in units], "unit string")

    def splits(u):
        if not u:
            yield []
        for n in range(1, len(u) + 1):
            if u[:n] in vocabulary.table or n == 1:
                yield from ([u[:n], *rest] for rest in splits(u[n:]))

    def score(parts):
        return sum(vocabulary.table.get(p, (0, lattice.UNKNOWN_SCORE))[1] for p in parts)

    best = {r.unit: list(r.ids) for r in lattice.folded(frame, vocabulary, "unigram").collect()}
    for u in units:
        top = max(map(score, splits(u)))
        assert any(best[u] == lattice._numbered(p, vocabulary.table, vocabulary.first_byte) for p in splits(u) if score(p) == top)
    merged = {r.unit: list(r.ids) for r in lattice.folded(frame, vocabulary, "bpe").collect()}
    assert all(merged[u] == lattice.merge_unit(u, vocabulary.table, vocabulary.first_byte) for u in units)


def test_short_units_in_a_matrix_equal_the_heap_and_plain_merging(vocabulary):
    rng = random.Random(9)
    units = sorted({"".join(rng.choices("▁aabeinrt日é\0😀 x", k=rng.randint(1, 20))) for _ in range(2000)} | {"▁" * 7, "x" * 32, "\n"}, key=len)

    def plain(u):
        parts = list(u)
        while True:
            ways = [(-vocabulary.table[a + b][1], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in vocabulary.table]
            if not ways:
                return lattice._numbered(parts, vocabulary.table, vocabulary.first_byte)
            at = min(ways)[1]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    wanted = [plain(u) for u in units]
    rows = lattice.Merges(vocabulary.table, vocabulary.first_byte).segmented(units)
    assert [list(array("i", r)) for r in rows] == wanted
    assert [lattice.merge_unit(u, vocabulary.table, vocabulary.first_byte) for u in units] == wanted


def test_a_long_text_without_spaces_ends(spark, vocabulary):
    rng = random.Random(3)
    long = ["x" * 1_000_000, "".join(rng.choices("abeinrt,é\n", k=300_000))]
    rows = lattice.decode(lattice.encode(table(spark, long).drop("ids"), piece_bpe()), piece_bpe()).orderBy("doc_id").collect()
    assert [r.decoded for r in rows] == long and all(len(r.ids) < len(r.text) for r in rows)


def test_common_units_count_all_texts(spark):
    frame = spark.createDataFrame([("a b\nb a",), ("b  c\n\nc",), (None,), ("y" * 40 + " y",)], "text string")
    kept = lattice.common_units(frame, F.coalesce("text", F.lit("")), 4)
    assert [r.unit for r in kept.collect()] == ["▁a", "▁b", "b", "c"]  # ties: the smaller string


def test_units_cover_the_text():
    for t in ["▁a▁b", "▁▁▁a\nb▁", "▁", "▁a\n\n▁"]:
        assert "".join(re.findall(lattice.UNIT, t)) == t


def test_words_are_the_units_of_a_text():
    rng = random.Random(5)
    texts = ["", " ", "\n", "a b\nc \n d", "▁a", "a▁ b", "a  b", " a", "a "]
    for t in texts + ["".join(rng.choices("ab \n▁é", k=rng.randint(0, 9))) for _ in range(20000)]:
        found = lattice.words(t)
        units = [u for w in found for u in (["\n"] if w[0] == "\n" else []) + [lattice._marked(w)] if u]
        assert units == (re.findall(lattice.UNIT, lattice.MARK + t.replace(" ", lattice.MARK)) if t else []), repr(t)
    assert lattice.words("plain words\nand lines") == ["plain", "words", "\nand", "lines"]


def test_merges_of_equal_scores_start_on_the_left():
    rng = random.Random(6)
    for _ in range(30):
        pieces = {"".join(rng.choices("abc", k=rng.randint(1, 4))) for _ in range(12)}
        table = {p: (i, -float(rng.randint(0, 3))) for i, p in enumerate(sorted(pieces))}
        units = ["".join(rng.choices("abcx\0", k=rng.randint(1, 12))) for _ in range(200)]
        rows = lattice.Merges(table, 100).segmented(units)
        assert [list(array("i", r)) for r in rows] == [lattice.merge_unit(u, table, 100) for u in units]


def test_words_beyond_the_cache_have_the_same_ids(spark, monkeypatch):
    import sentencepiece

    monkeypatch.setattr(lattice, "CACHED_UNITS", 3)
    monkeypatch.setattr(lattice, "LETTERS_AT_ONCE", 40)
    rng = random.Random(7)
    texts = TEXTS + [" ".join("".join(rng.choices("abcé\n▁", k=rng.randint(1, 40))) for _ in range(8)) for _ in range(60)]
    whole = sentencepiece.SentencePieceProcessor(model_file=piece_bpe())
    for r in lattice.encode(table(spark, texts).drop("ids").coalesce(1), piece_bpe(), kept=5).collect():
        assert list(r.ids) == (whole.encode(r.text) if r.text else []), repr(r.text)


def test_workers_remember_words_from_task_to_task(spark):
    def remembered(batches):
        import pyarrow as pa

        from marketloom.llm import lattice as there

        for b in batches:
            sizes = [len(known) for known in there._KNOWN.values()]
            yield pa.RecordBatch.from_pydict({"tables": [len(sizes)] * b.num_rows, "words": [sum(sizes)] * b.num_rows})

    texts = ["one two three", "four five", "six\nseven"]
    for _ in range(2):
        assert lattice.encode(table(spark, texts).drop("ids").repartition(3), piece_bpe(), kept=2).select(F.sum(F.size("ids"))).first()[0]
    left = spark.range(0, 64, 1, 8).mapInArrow(remembered, "tables long, words long").agg(F.max("tables"), F.max("words")).first()
    assert left[0] == 1 and left[1] > 2
