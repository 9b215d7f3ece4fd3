"""Exact search and fixity audit against brute force."""

import math
import random

from pyspark.sql import functions as F

from marketloom.llm import fixity, topk

VECTORS = "vec_id long, embedding array<float>, label int, v string, dist double"


def brute(rows, asked, k):
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in ok if asked(i)}):
        a = next(v for i, v in ok if i == q)
        scored = sorted((-sum(x * y for x, y in zip(a, v)), i) for i, v in ok if i != q)[:k]
        out += [(q, n, i, -s) for n, (s, i) in enumerate(scored, 1)]
    return out


def run(spark, rows, k=5, schema=VECTORS, **options):
    frame = spark.createDataFrame([(i, v, 0, "x", 1.0) for i, v in rows], schema)
    found = topk.search(frame, lambda c: c % 10 == 0, k=k, **options)
    return sorted(tuple(r) for r in found.collect())


def test_search_equals_brute_force(spark):
    rng = random.Random(5)
    rows = [(i, [float(x) for x in map(lambda _: rng.choice([rng.gauss(0, 1), 0.5]), range(8))]) for i in range(400)]
    rows = [(i, [float.fromhex(float(x).hex()) for x in v]) for i, v in rows]
    rows += [(400 + i, [0.25] * 8) for i in range(60)]  # one vector many times: ties
    rows += [(500, None), (501, []), (502, [1.0, None] * 4), (503, [float("nan")] * 8), (504, [float("inf")] * 8), (None, [1.0] * 8)]
    import numpy as np

    single = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    want = brute(single, lambda i: i % 10 == 0, 5)
    assert run(spark, rows, pivots=6, annulus_rows=16, query_rows=7) == want


def test_search_with_few_or_no_candidates(spark):
    assert run(spark, [(10, [1.0, 0.0]), (11, [0.5])]) == [(10, 1, 11, 128 * 256)]
    assert run(spark, [(10, [1.0])]) == [] and run(spark, [(1, None)]) == []


def test_zero_and_equal_vectors(spark):
    rows = [(i, [0.0, 0.0]) for i in range(25)]
    assert run(spark, rows) == brute(rows, lambda i: i % 10 == 0, 5)


def test_scores_above_the_whole_numbers_of_floats_are_exact(spark):
    rng = random.Random(6)
    rows = [(i, [rng.uniform(1e6, 2e6) for _ in range(6)]) for i in range(200)]
    rows += [(200 + i, [v + i % 2 / 256 for v in rows[3][1]]) for i in range(20)]  # scores that differ in their last digits
    want = brute(rows, lambda i: i % 10 == 0, 5)
    assert any(float(s) != s for *_, s in want)
    assert run(spark, rows, schema=VECTORS.replace("float", "double"), pivots=6, annulus_rows=16, query_rows=7) == want


def test_scores_beyond_64_bits_count_as_the_end_of_the_range(spark):
    top = 2**63 - 1
    rows = [(10, [2.0**50, 1.0]), (11, [2.0**50, 0.0]), (12, [2.0**49, 0.0]), (13, [-(2.0**50), 0.0]), (14, [0.0, 1.0])]
    assert run(spark, rows) == [(10, 1, 11, top), (10, 2, 12, top), (10, 3, 14, 2**16), (10, 4, 13, -top)]


RECORDS = "vol string, pos long, url string, html string, digest string, node int"


def archive(spark, rows):
    return spark.createDataFrame([(v, p, u, h, "d", 0) for v, p, u, h in rows], RECORDS)


def audited(spark, a, b, **options):
    found = fixity.audit(archive(spark, a), archive(spark, b), "vol", "pos", ["url", "html"], **options)
    return sorted((r.level, r.volume, r.first_offset, r.status, r.records_a, r.records_b) for r in found.collect())


def test_audit_finds_exactly_the_damage(spark):
    a = [("v", p, f"u{p}", "x" * p) for p in range(300)] + [("w", 5, "u", None)]
    b = [r for r in a if r[1] != 70 or r[0] == "w"]
    b[10] = ("v", 10, "u10", "y")
    got = audited(spark, a, b)
    assert got == [
        (0, "v", 10, "changed", 1, 1), (0, "v", 70, "missing", 1, 0),
        (1, "v", 0, "changed", 64, 64), (1, "v", 64, "changed", 64, 63), (2, "v", 0, "changed", 300, 299),
    ]


def test_audit_of_nulls_repeats_order_and_empty_archives(spark):
    a = [("v", 1, "u", None), ("v", 1, "u", None), ("v", 1, "t", "h"), (None, None, None, "z"), ("v", -3, "n", "n")]
    assert audited(spark, a, list(reversed(a))) == []
    assert audited(spark, a, [*a[1:], ("v", 1, "u", "")], height=1) == [
        (0, "v", 1, "changed", 3, 3), (1, "v", 0, "changed", 4, 4),
    ]
    assert audited(spark, a[:1], a[:2], height=0) == [(0, "v", 1, "changed", 1, 2)]
    empty = archive(spark, a).filter(F.lit(False))
    assert fixity.audit(empty, empty, "vol", "pos", ["url"]).count() == 0
    assert fixity.audit(empty, archive(spark, a[:1]), "vol", "pos", ["url"], height=0).first().status == "extra"
