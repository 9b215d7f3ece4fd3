"""Exact and near duplicates against brute force on small tables."""

import random

import pytest
from pyspark.sql import functions as F

from marketloom.llm import exact_dedup, near_dedup
from marketloom.llm.components import components
from marketloom.llm.shingles import Minima, shingle_set, words

SCHEMA = "doc_id long, text string, name string, row string"
LONG = "abcdefghij" * 30_000


def table(spark, rows):
    return spark.createDataFrame([(i, t, "n", "r") for i, t in rows], SCHEMA)


def exact(rows):
    out = []
    for i, t in rows:
        same = [j for j, u in rows if (u or "") == (t or "")]
        known = [j for j in same if j is not None]
        out.append((i, max(known) if known else None, len(same)))
    return sorted(out, key=str)


ROWS = [(1, None), (2, ""), (3, "a"), (4, "a "), (5, "a"), (6, LONG), (7, LONG), (8, LONG + "x"), (None, "a"), (9, "é" * 5000), (10, "é" * 5000)]


@pytest.mark.parametrize("block_bytes", [3, 4096])
def test_groups_equal_brute_force(spark, block_bytes):
    rows = [(i, t[:700] if t else t) for i, t in ROWS] if block_bytes == 3 else ROWS
    got = exact_dedup.groups(table(spark, rows), block_bytes=block_bytes).collect()
    assert sorted(((r.id, r.keep_id, r.group_size) for r in got), key=str) == exact(rows)
    assert sum(r.kept for r in got) == len({t or "" for _, t in rows})


def test_random_texts_with_many_equal_blocks(spark):
    rng = random.Random(3)
    rows = [(i, "".join(rng.choice(["aa", "bb"]) for _ in range(rng.randint(0, 9)))) for i in range(300)]
    got = exact_dedup.groups(table(spark, rows), block_bytes=2).collect()
    assert sorted(((r.id, r.keep_id, r.group_size) for r in got), key=str) == exact(rows)


def test_digests_that_collide_are_replaced(spark):
    def weak(block, seed):
        return [F.lit(7)] if seed == 0 else exact_dedup.block_digest(block, seed)

    got = exact_dedup.groups(table(spark, [(1, "a"), (2, "b"), (3, "a")]), digest=weak).collect()
    assert sorted((r.id, r.keep_id) for r in got) == [(1, 3), (2, 2), (3, 3)]


def test_deduplicate_keeps_one_row_and_all_columns(spark):
    docs = table(spark, [(1, "x"), (2, "x"), (2, "x"), (3, None), (4, "")])
    kept = exact_dedup.deduplicate(docs, block_bytes=4)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 4]
    assert exact_dedup.deduplicate(docs.filter("doc_id > 9")).count() == 0


def near(rows, size, percent):
    """Smallest reachable id of each row, by all pairs."""
    sets = {i: set(shingle_set(t, size).tolist()) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            common = len(sets[a] & sets[b])
            if a < b and common and 100 * common >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return sorted((i, len(sets[i]), find(i)) for i in sets)


def variants(seed, groups, copies, length):
    rng = random.Random(seed)
    rows = [(1000, None), (1001, " \n\t"), (1002, "two Words"), (1003, "TWO words "), (1004, "one")]
    for g in range(groups):
        base = [f"w{rng.randrange(10**6)}" for _ in range(length)]
        for c in range(copies):
            text = list(base)
            for _ in range(c % 12):
                text[rng.randrange(length)] = f"v{rng.randrange(10**6)}"
            rows.append((g * copies + c, " ".join(text)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("size, percent", [(3, 85), (5, 80)])
def test_components_equal_all_pairs(spark, size, percent):
    rows = variants(size, 4, 30, 150)
    got = near_dedup.groups(table(spark, rows), shingle_words=size, percent=percent).collect()
    assert sorted((r.id, r.n_shingles, r.component_id) for r in got) == near(rows, size, percent)
    assert all(r.kept == (r.id == r.component_id) for r in got)


def test_slices_of_a_large_bucket_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "SLICE_ROWS", 8)
    rows = variants(11, 1, 80, 120)
    got = near_dedup.groups(table(spark, rows), shingle_words=3, percent=85).collect()
    assert sorted((r.id, r.n_shingles, r.component_id) for r in got) == near(rows, 3, 85)


def shared_passages(n):
    """Texts of one bucket that share a passage but stay below the threshold, and two near pairs among them."""
    rng = random.Random(17)
    passage = [f"p{i}" for i in range(150)]
    rows = [(i, " ".join(passage + [f"u{rng.randrange(10**9)}" for _ in range(100)])) for i in range(n)]
    return [*rows, *((n + i, rows[7 * i][1] + " end") for i in range(2))]


def test_members_that_ask_are_dealt_in_slices(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "SLICE_ROWS", 8)
    rows, held, tried = shared_passages(120), [], []
    real, deal = near_dedup._across, type(spark.range(0)).repartition

    def across(met, *rest):
        tried.append(met.groupBy("key", "slice", "asking", "asks").count().agg(F.max("count")).first()[0])
        return real(met, *rest)

    def dealing(df, *columns):
        if columns[0] == "key" and "minima" in df.columns:
            held.append(df.groupBy(*columns, "asks").count().agg(F.max("count"), F.count("*")).first())
        return deal(df, *columns)

    monkeypatch.setattr(near_dedup, "_across", across)
    monkeypatch.setattr(type(spark.range(0)), "repartition", dealing)
    got = near_dedup.groups(table(spark, rows), shingle_words=3, percent=85).collect()
    assert sorted((r.id, r.n_shingles, r.component_id) for r in got) == near(rows, 3, 85)
    # Both sides are bounded (slices are dealt by hash), and texts are read for near pairs only.
    ((most, blocks),) = held
    assert most <= 4 * near_dedup.SLICE_ROWS and blocks > 100
    assert (tried[0] or 0) <= 4


def test_near_duplicates_with_null_and_repeated_ids(spark):
    text = " ".join(f"w{i}" for i in range(40))
    docs = table(spark, [(5, text), (5, text), (3, text), (None, text), (9, "other words here now")])
    got = sorted(((r.id, r.component_id, r.kept) for r in near_dedup.groups(docs).collect()), key=str)
    assert got == [(3, 3, True), (5, 3, False), (5, 3, False), (9, 9, True), (None, None, True)]
    kept = near_dedup.deduplicate(docs)
    assert kept.columns == docs.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["3", "9", "None"]
    assert near_dedup.groups(docs.filter("doc_id > 99")).count() == 0


def test_words_and_minima():
    assert words("Ab\x0bC D É") == ["ab".encode(), "c d".encode(), "É".encode()]
    m = Minima(24, 4)
    x = shingle_set(" ".join(map(str, range(5000))), 3)
    assert (m.of(x) == m.of(x, chunk=7)).all() and len(shingle_set("", 3)) == 0


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(100, 160)] + [(0, i) for i in range(1, 50)] + [(7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(path, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(101, 161)}, **{i: 0 for i in range(1, 50)}}
