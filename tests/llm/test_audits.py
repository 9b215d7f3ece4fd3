"""Manifest, repeated passages and divergence against brute force on small tables."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from marketloom.llm import divergence, manifest, suffixes

DOCS = "doc_id long, text string, lang string, source string, n_chars long, t string, spans int, place long, node string"


def documents(spark, rows):
    """Rows of id, text, lang, source; other columns have the names of columns that the operators add."""
    return spark.createDataFrame([(i, t, lang, s, None if t is None else len(t), "t", 1, 2, "n") for i, t, lang, s in rows], DOCS)


# Manifest


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(i, t, lang, s, text):
    """The leaf of a row with another text; the number of letters stays."""
    frame = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return h(*map(frame, (i, s, lang, None if t is None else len(t), text)))


def leaf(i, t, lang, s):
    return leaf_of(i, t, lang, s, t)


def climbed(nodes):
    """The root of a list of digests, and the siblings of each one on its way up."""
    ways, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, k in enumerate(at):
            run = range(k // 3 * 3, min(k // 3 * 3 + 3, len(nodes)))
            ways[i].append(([nodes[j] for j in run if j < k], [nodes[j] for j in run if j > k]))
            at[i] = k // 3
        nodes = [h(*nodes[j : j + 3]) for j in range(0, len(nodes), 3)]
    return nodes[0] if nodes else None, ways


def proven(rows, changed):
    by_source = defaultdict(list)
    for r in rows:
        by_source[r[3]].append(r)
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in sources:
        members = sorted(by_source[s], key=lambda r: (r[0] is not None, r[0], leaf(*r)))
        trees.append((members, *climbed([leaf(*r) for r in members])))
    root, tops = climbed([sub for _, sub, _ in trees])
    out = []
    for (members, sub, ways), top in zip(trees, tops):
        for r, way in zip(members, ways):
            folded = leaf(*r) if r[1] is None else leaf_of(*r, changed(r[1]))
            for left, right in way + top:
                folded = h(*left, folded, *right)
            out.append((r[0], leaf(*r), sub, root, [d for left, right in way + top for d in left + right], folded))
    return sorted(out, key=str)


def manifested(spark, rows):
    changed = {"text": F.replace("text", F.lit("\n"), F.lit(""))}
    built = manifest.manifest(documents(spark, rows), "source", "doc_id", ["doc_id", "source", "lang", "n_chars", "text"], changed)
    got = manifest.prove(built).select("id", *[manifest.hexed(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")], F.transform("siblings", manifest.hexed).alias("w"), manifest.hexed(F.col("folded")).alias("f"))
    return sorted((tuple(r) for r in got.collect()), key=str)


def sample(n, sources, seed):
    rng = random.Random(seed)
    return [(i, rng.choice(["a\nb", "é", "", None, f"x{i}\n"]), rng.choice(["en", None]), rng.choice(sources)) for i in range(n)]


@pytest.mark.parametrize("levels, share", [(4, 512), (1, 2), (2, 100_000)])
def test_proofs_equal_brute_force(spark, monkeypatch, levels, share):
    monkeypatch.setattr(manifest, "BLOCK_LEVELS", levels)
    monkeypatch.setattr(manifest, "HOT_SHARE", share)
    rows = sample(330, ["hot"] * 9 + ["b", "é", "", None, "c", "B", "d"], 1)
    rows += [(None, "z\n", "en", "hot"), (None, "y", "en", "hot"), (7, "other", "en", "hot"), (900, "lone", "en", "only")]
    assert manifested(spark, rows) == proven(rows, lambda t: t.replace("\n", ""))


def test_proofs_of_one_group_one_row_repeats_and_nothing(spark):
    rows = sample(85, ["s"], 2)
    assert manifested(spark, rows) == proven(rows, lambda t: t.replace("\n", ""))
    for some in ([(1, "a\n", "en", None)], [(1, "a", "en", "s")] * 4, [(1, "a", "en", "s"), (1, "a", "en", "t")]):
        assert manifested(spark, some) == proven(some, lambda t: t.replace("\n", ""))
    assert manifested(spark, rows[:0]) == []


# Repeated passages


def without_repeats(texts, length):
    bodies = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + length] for b in bodies for i in range(len(b) - length + 1))
    out = []
    for b in bodies:
        gone = bytearray(len(b) + 1)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        out.append((bytes(c for c, g in zip(b, gone) if not g), sum(gone), bytes(gone).count(b"\1\0")))
    return out


def passages(seed, alphabet="abc ", n=200):
    rng = random.Random(seed)
    shared = ["".join(rng.choice(alphabet) for _ in range(rng.randint(20, 120))) for _ in range(10)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randint(0, 6)):
            p, cut = rng.choice(shared), rng.randint(0, 60)
            parts.append(rng.choice([p, p[cut:], p[:cut], "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 60)))]))
        rows.append("".join(parts))
    return [*rows, "a" * 500, "ab" * 300, None, "", rows[5], rows[5], "short", "short"]


@pytest.mark.parametrize("batches, group_rows", [(1, 1), (5, 4096), (2, 6)])
def test_removed_bytes_equal_brute_force(spark, monkeypatch, batches, group_rows):
    monkeypatch.setattr(suffixes, "PIECE", 128)
    monkeypatch.setattr(suffixes, "GROUP_ROWS", group_rows)
    monkeypatch.setattr(suffixes, "TABLE_CELLS", 200)
    texts = passages(batches)
    docs = documents(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])
    got = suffixes.remove_repeats(docs, length=50, gram=19, runs=(8, 1), batches=batches).orderBy("doc_id").collect()
    assert [(bytes(r.kept), r.n_removed, r.n_spans) for r in got] == without_repeats(texts, 50)
    assert got[0].t == "t" and got[0].spans == 1


def test_repeats_of_production_length(spark):
    rng = random.Random(8)
    text = "".join(rng.choice("abcdefghij") for _ in range(200_000))
    texts = [text, text[1000:1399], "x" + text[5000:5400] + "y", text[:500] + text[150_000:151_000], None]
    docs = documents(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])
    got = suffixes.remove_repeats(docs).orderBy("doc_id").collect()
    want = [(0, 400 + 500 + 1000, 3), (1, 0, 0), (2, 400, 1), (3, 1500, 1), (4, 0, 0)]
    assert [(r.doc_id, r.n_removed, r.n_spans) for r in got] == want
    assert bytes(got[2].kept) == b"xy"
    assert suffixes.remove_repeats(docs.filter("doc_id < 0")).count() == 0


def test_family_grows_geometrically(spark):
    from marketloom.llm.common import Stage

    family = suffixes.Family(Stage(spark, "family"))
    sizes = []
    for k in range(5):
        rows = [(c, c, k, 500, c) for c in range(k, k + 3)]
        family.add(spark.createDataFrame(rows, suffixes.ENTRY))
        sizes.append([n for n, _, _ in family.arrays])
    assert sizes == [[1], [2], [1, 2], [4], [1, 4]]
    assert {r.core for f in family.repeated for r in f.collect()} == {1, 2, 3, 4, 5}


def test_members_of_a_large_class_stay_in_their_tasks(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "GROUP_ROWS", 100)
    rows = [(1, 7, k, 500, k) for k in range(800)] + [(c, 7, k, 500, c) for c in (2, 3, 3, 4) for k in range(2)]
    held = spark.createDataFrame(rows, suffixes.ENTRY).repartition(8)
    repeated = spark.createDataFrame([(1, 7, 300), (1, 7, 800), (2, 7, 2), (3, 7, 4), (3, 7, 2), (1, 8, 900)], "core long, full long, copies long")
    for found, cores in ((repeated, (1, 2, 3)), (repeated.filter("core = 3"), (3,)), (repeated.filter("core = 9"), ())):
        got = suffixes.members(held, found).collect()
        assert sorted(map(tuple, got)) == sorted(r for r in rows if r[0] in cores)
    tasks = suffixes.members(held, repeated).filter("core = 1").groupBy(F.spark_partition_id()).count()
    assert max(r["count"] for r in tasks.collect()) < 200


def test_runs_must_divide(spark):
    with pytest.raises(ValueError):
        suffixes.repeated_spans(documents(spark, []), runs=(50, 1))


# Divergence


def diverged(rows, least, top):
    words = [(lang or "", s or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))) for _, t, lang, s in rows]
    out = []
    for lang in {w[0] for w in words}:
        documents, counts, everywhere = Counter(), defaultdict(Counter), Counter()
        for of, s, found in words:
            if of == lang:
                documents.update(set(found))
                counts[s].update(found)
        kept = {t for t, n in documents.items() if n >= least}
        for c in counts.values():
            everywhere.update({t: n for t, n in c.items() if t in kept})
        share = lambda c: {t: 1 + 10**9 * (c[t] + 5) // (sum(c[u] for u in kept) + 5 * len(kept)) for t in kept}
        shares, q = {s: share(c) for s, c in counts.items()}, share(everywhere)
        for s in counts:
            pairs = [(o, sum(abs(shares[s][t] - shares[o][t]) for t in kept)) for o in counts if o != s]
            terms = [(t, shares[s][t] - q[t]) for t in kept if counts[s][t] and shares[s][t] > q[t]]
            for part, items in (("pair", pairs), ("term", terms)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, n) for n, (i, v) in enumerate(ranked, 1) if part == "pair" or n <= top]
    return sorted(out)


def audited(spark, rows, least, top=5):
    got = divergence.audit(documents(spark, rows), least_documents=least, top=top)
    return sorted((r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in got.collect())


@pytest.mark.parametrize("block, cells, held", [(1_000_000, 1_000_000, 200_000), (7, 4, 5)])
def test_audit_equals_brute_force(spark, monkeypatch, block, cells, held):
    monkeypatch.setattr(divergence, "BLOCK_POSTINGS", block)
    monkeypatch.setattr(divergence, "SLICE_CELLS", cells)
    monkeypatch.setattr(divergence, "HELD_TERMS", held)
    rng = random.Random(6)
    words = ["Alpha", "beta", "ÉTÉ", "x1y", "naïve", "a_b", "don't", "ß", "gamma", "中文"]
    rows = [
        (i, " ".join(rng.choice(words[: 4 + i % 7]) for _ in range(rng.randint(0, 30))), rng.choice(["en", "de", None]), rng.choice(["hot"] * 5 + ["a", "é", None, "b"]))
        for i in range(200)
    ]
    rows += [(300, None, "en", "silent"), (301, "", "en", "silent"), (302, "rare", "xx", "a"), (303, None, "xx", "b"), (303, "z" * 100_000, "xx", "lone"), rows[0], rows[0]]
    assert audited(spark, rows, 3) == diverged(rows, 3, 5)


def test_audit_of_nothing_and_of_counts_beyond_64_bits(spark):
    assert audited(spark, [], 1) == []
    assert audited(spark, [(1, "a", "en", "s")], 1) == [("en", "s", "term", "a", 0, 1)][:0]
    big = spark.createDataFrame([(10**18, 3 * 10**18, 2)], "c long, n long, v long")
    got = big.select(divergence.share(F.col("c"), F.col("n"), F.col("v")).alias("p")).first().p
    assert got == 1 + 10**9 * (10**18 + 5) // (3 * 10**18 + 10)
