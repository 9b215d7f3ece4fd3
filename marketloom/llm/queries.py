"""Queries of this subpackage and their SQL, for the driver."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm import divergence, exact_dedup, fixity, html_text, lattice, licences, manifest, near_dedup, packing, pii, suffixes, topk, toxicity
from marketloom.llm.common import importable

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn: QueryFn) -> QueryFn:
        _QUERIES[name] = fn
        if sql:
            _SQL[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return importable(spark).read.parquet(f"{sf_dir}/{name}.parquet")


@query(
    "op2_exact_dedup",
    """
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
)
def exact_dedup_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.groups(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query(
    "op4_exact_topk",
    """
    WITH v AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
        WHERE vec_id IS NOT NULL AND len(embedding) > 0
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), s AS (
        SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
        FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
    )
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
    FROM s QUALIFY rank <= 5
    """,
)
def exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), lambda i: i % 50 == 0)


def byte_bpe() -> str:
    """The public byte-level vocabulary, installed on the driver and all executors."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op7_best_fit_packing")
def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = packing.pieces(table(spark, sf_dir, "documents"), byte_bpe())
    digests = cut.select(F.col("id").alias("doc_id"), "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(digests)


@query(
    "op9_near_dedup",
    r"""
    WITH RECURSIVE d AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
        FROM documents
    ), s AS (
        SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) BETWEEN 1 AND 2 THEN [array_to_string(w, ' ')]
            ELSE list_transform(generate_series(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS shingle
        FROM d WHERE len(w) > 0
    ), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY ALL),
    p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
    e AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 85 * (a.n + b.n - c)),
    r AS (SELECT x AS doc_id, y AS other FROM e UNION SELECT r.doc_id, e.y FROM r JOIN e ON r.other = e.x)
    SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id,
           doc_id <= coalesce(m, doc_id) AS kept
    FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT doc_id, min(other) AS m FROM r GROUP BY ALL) USING (doc_id)
    """,
)
def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.groups(table(spark, sf_dir, "documents"), shingle_words=3, percent=85)
    return found.withColumnRenamed("id", "doc_id")


@query("op5_toxicity")
def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.fit(docs, table(spark, sf_dir, "labels")).score(docs)
    held_out = (toxicity.fold("doc_id") == toxicity.HELD_OUT).alias("held_out")
    return scored.select("doc_id", held_out, "score", toxicity.predicted().alias("predicted"))


@query("op6_pii")
def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["base"])
    kinds = F.transform(base, lambda s: s["kind"])
    counts = [(F.size(base) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in pii.KINDS[: pii.BASE_KINDS]]
    return found.select("doc_id", *counts, F.sha2(pii.joined(base), 256).alias("base_sha256"), pii.joined(F.col("spans")).alias("spans"))


@query("op8_html_text")
def main_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = html_text.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return read.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


SEGMENT = 4096  # pages in a volume: two levels of nodes above the records


@query(
    "op1_merkle_fixity",
    """
    WITH p AS (
        SELECT CAST(page_id // 4096 AS VARCHAR) AS volume, page_id % 4096 AS pos, 1 AS a,
               CASE WHEN page_id % 89 = 5 THEN 0 WHEN page_id % 83 = 7 THEN 2 ELSE 1 END AS b, page_id % 97 = 3 AS changed
        FROM pages
    ), nodes AS (
        SELECT level::INT AS level, volume, pos >> (6 * level) AS node, sum(a) AS a, sum(b) AS b, bool_or(b <> 1 OR changed) AS differs
        FROM p, (SELECT unnest([0, 1, 2]) AS level) GROUP BY ALL
    )
    SELECT level, volume, node << (6 * level) AS first_offset, ((node + 1) << (6 * level)) - 1 AS last_offset,
           CASE WHEN b = 0 THEN 'missing' ELSE 'changed' END AS status, a::BIGINT AS records_a, b::BIGINT AS records_b
    FROM nodes WHERE differs
    """,
)
def merkle_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages as an archive against a replica with changed, lost and repeated records."""
    keys = {"volume": F.floor(F.col("page_id") / SEGMENT).cast("string"), "pos": F.col("page_id") % SEGMENT}
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html").withColumns(keys)
    damaged = F.when(F.col("page_id") % 97 == 3, F.concat(F.coalesce("html", F.lit("")), F.lit("!"))).otherwise(F.col("html"))
    copies = F.when(F.col("page_id") % 83 == 7, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    replica = pages.filter(F.coalesce(F.col("page_id") % 89 != 5, F.lit(True))).withColumn("html", damaged)
    replica = replica.withColumn("copy", F.explode(copies)).drop("copy")
    return fixity.audit(pages, replica, "volume", "pos", ["url", "html"], height=2)


@query("op10_licences")
def licence_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def piece_bpe() -> str:
    """The public SentencePiece vocabulary, installed on the driver."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query("op3_piece_lattice")
def piece_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text, and whether they decode to the text (the word mark read as a space)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    back = lattice.decode(lattice.encode(docs, piece_bpe()), piece_bpe())
    same = F.col("decoded") == F.translate(F.coalesce("text", F.lit("")), lattice.MARK, " ")
    return back.select("doc_id", "ids", F.size("ids").alias("n_ids"), same.alias("round_trip"))


LEAF_FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
_FRAMED = "coalesce(strlen({0}) || ':' || {0}, '-')"


def _leaf_sql(text: str) -> str:
    values = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
    return "sha256(" + " || ".join(_FRAMED.format(v) for v in values) + ")"


@query(
    "op11_merkle_manifest",
    f"""
    WITH RECURSIVE bits AS (  -- the register of CRC-32 before its last inversion, bit by bit
        SELECT doc_id, list_reduce(
            list_transform(flatten(list_transform(range(len(doc_id::VARCHAR)), lambda i: list_transform(range(8), lambda j: (ascii((doc_id::VARCHAR)[i + 1]) >> j) & 1))), lambda x: x::BIGINT),
            lambda c, b: xor(c >> 1, (xor(c, b) & 1) * 3988292384), 4294967295::BIGINT) AS c
        FROM documents
    ), leaf AS (
        SELECT d.doc_id, source, {_leaf_sql("text")} AS leaf, {_leaf_sql(chr(114) + "eplace(text, chr(10), '')")} AS other,
               xor(c, 4294967295) % 2 = 0 AS tamper, row_number() OVER (PARTITION BY source ORDER BY d.doc_id) - 1 AS pos
        FROM documents d JOIN bits USING (doc_id)
    ), groups AS (SELECT source, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, count(*) AS n FROM leaf GROUP BY source),
    up AS (
        SELECT tree, 0 AS level, pos AS node, leaf AS h, n FROM leaf JOIN groups ON leaf.source IS NOT DISTINCT FROM groups.source
        UNION ALL
        SELECT tree, level + 1, node // 3, sha256(string_agg(h, '' ORDER BY node)), (n + 2) // 3 FROM up WHERE n > 1 GROUP BY tree, level, node // 3, n
    ), subroots AS (SELECT tree, h FROM up WHERE n = 1),
    top AS (
        SELECT 0 AS level, tree AS node, h, (SELECT count(*) FROM subroots) AS n FROM subroots
        UNION ALL
        SELECT level + 1, node // 3, sha256(string_agg(h, '' ORDER BY node)), (n + 2) // 3 FROM top WHERE n > 1 GROUP BY level, node // 3, n
    ), nodes AS (
        SELECT tree, level, node, n, coalesce(string_agg(h, '' ORDER BY node) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
               coalesce(string_agg(h, '' ORDER BY node) OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
        FROM (SELECT * FROM up UNION ALL SELECT -1, level, node, h, n FROM top) WHERE n > 1
        WINDOW w AS (PARTITION BY tree, level, node // 3 ORDER BY node)
    ), climb AS (
        SELECT doc_id, CASE WHEN n = 1 THEN -1 ELSE tree END AS tree, 0 AS level, CASE WHEN n = 1 THEN tree ELSE pos END AS node,
               CASE WHEN tamper THEN other ELSE leaf END AS h, '' AS proof, 0 AS step
        FROM leaf JOIN groups ON leaf.source IS NOT DISTINCT FROM groups.source
        UNION ALL
        SELECT doc_id, CASE WHEN n <= 3 THEN -1 ELSE c.tree END, CASE WHEN n <= 3 AND c.tree >= 0 THEN 0 ELSE c.level + 1 END,
               CASE WHEN n <= 3 AND c.tree >= 0 THEN c.tree ELSE c.node // 3 END, sha256(l || h || r), proof || l || r, step + 1
        FROM climb c JOIN nodes x ON x.tree = c.tree AND x.level = c.level AND x.node = c.node
    ), done AS (SELECT doc_id, arg_max(h, step) AS folded_root, sha256(arg_max(proof, step)) AS proof_sha256 FROM climb GROUP BY doc_id)
    SELECT doc_id, leaf, s.h AS subroot, t.h AS root, proof_sha256, folded_root, folded_root = t.h AS verified
    FROM leaf JOIN groups ON leaf.source IS NOT DISTINCT FROM groups.source JOIN subroots s USING (tree) JOIN done USING (doc_id), top t WHERE t.n = 1
    """,
)
def merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose id has an even checksum are proven with the line feeds of their text deleted."""
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    without = F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    built = manifest.manifest(table(spark, sf_dir, "documents"), "source", "doc_id", LEAF_FIELDS, {"text": without})
    proven = manifest.prove(built)
    return proven.select(
        F.col("id").alias("doc_id"), *[manifest.hexed(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")],
        F.sha2(manifest.listed(F.col("siblings")).cast("binary"), 256).alias("proof_sha256"),
        manifest.hexed(F.col("folded")).alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"),
    )


@query(
    "op12_suffix_array_dedup",
    """
    WITH d AS (SELECT row_number() OVER () AS row, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
    w AS (SELECT row, h, unnest(generate_series(0, len(h) // 2 - 400)) AS p FROM d WHERE len(h) >= 800),
    k AS (SELECT row, p, md5(substr(h, 2 * p + 1, 800)) AS m FROM w),
    rep AS (SELECT row, p FROM k WHERE m IN (SELECT m FROM k GROUP BY m HAVING count(*) > 1)),
    s AS (SELECT row, p, coalesce(p > lag(p) OVER (PARTITION BY row ORDER BY p) + 400, true) AS new FROM rep),
    i AS (SELECT row, p, sum(new::INT) OVER (PARTITION BY row ORDER BY p) AS island FROM s),
    spans AS (SELECT row, island, min(p) AS a, max(p) + 400 AS b FROM i GROUP BY ALL),
    gaps AS (SELECT row, a, b, lead(a) OVER (PARTITION BY row ORDER BY a) AS next FROM spans),
    kept AS (
        SELECT row, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans,
               substr(any_value(h), 1, 2 * min(a)) || string_agg(substr(h, 2 * b + 1, 2 * (coalesce(next, len(h) // 2) - b)), '' ORDER BY a) AS h
        FROM gaps JOIN d USING (row) GROUP BY row
    )
    SELECT doc_id, len(d.h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
           sha256(unhex(coalesce(kept.h, d.h))) AS kept_sha256
    FROM d LEFT JOIN kept USING (row)
    """,
)
def repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffixes.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query(
    "op13_source_divergence",
    r"""
    WITH d AS (
        SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
               regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
        FROM documents
    ), per_doc AS (SELECT row, lang, source, term, count(*) AS n FROM (SELECT row, lang, source, unnest(w) AS term FROM d) GROUP BY ALL),
    terms AS (SELECT lang, term, sum(n) AS lang_n FROM per_doc GROUP BY ALL HAVING count(*) >= 30),
    c AS (SELECT lang, source, term, sum(n) AS n FROM per_doc JOIN terms USING (lang, term) GROUP BY ALL),
    g AS (
        SELECT lang, source, coalesce(total, 0) AS total, coalesce(v, 0) AS v, coalesce(lang_total, 0) AS lang_total
        FROM (SELECT DISTINCT lang, source FROM d)
        LEFT JOIN (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL) USING (lang, source)
        LEFT JOIN (SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM terms GROUP BY ALL) USING (lang)
    ), p AS (
        SELECT lang, source, term, lang_n, coalesce(n, 0) AS n,
               1 + ((1000000000::HUGEINT * (coalesce(n, 0) + 5)) // (total + 5 * v)::HUGEINT) AS p,
               1 + ((1000000000::HUGEINT * (lang_n + 5)) // (lang_total + 5 * v)::HUGEINT) AS q
        FROM g JOIN terms USING (lang) LEFT JOIN c USING (lang, source, term)
    ), pairs AS (
        SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
        FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
    ), rows AS (
        SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
        FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN pairs x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
        UNION ALL
        SELECT lang, source, 'term', term, (p - q)::BIGINT FROM p WHERE n > 0 AND p > q
    )
    SELECT lang, source, part, item, value, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank
    FROM rows QUALIFY part = 'pair' OR rank <= 50
    """,
)
def source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def queries() -> dict[str, QueryFn]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
