"""The registered queries of this package; each applies one operator to its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakekit.llm import oracles
from lakekit.llm.common import materialize, read
from lakekit.llm.decontaminate import find_contamination, is_contaminated
from lakekit.llm.divergence import divergence
from lakekit.llm.merkle import audit
from lakekit.llm.minhash import near_duplicates
from lakekit.llm.mixing import count_words, plan_mix
from lakekit.llm.ngram_jaccard import jaccard_components
from lakekit.llm.packing import pack_documents, sequences
from lakekit.llm.quality_classifier import score_quality
from lakekit.llm.quality_rules import apply_quality_rules
from lakekit.llm.secrets import find_secrets
from lakekit.llm.sharding import assign_shards
from lakekit.llm.substring_dedup import remove_repeats
from lakekit.llm.warc import archive_round_trip

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"  # unless spark.lakekit.vocabulary names another

QUERIES = {}
ORACLES = {}


def query(name, sql=None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql.strip()
        return fn

    return register


@query("op1_ngram_jaccard_join")
def op1(spark, sf_dir):
    return jaccard_components(read(spark, sf_dir, "documents"), shingle_words=4, percent=85)


@query(
    "op3_benchmark_decontamination",
    r"""
    WITH raw AS (
      SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark),
    w AS (
      SELECT kind, id, regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM raw),
    b AS (
      SELECT id AS item, least(len(ws), 13) AS n, unnest(generate_series(1, greatest(len(ws) - 12, 1))) AS i, ws
      FROM w WHERE kind = 'b' AND len(ws) > 0),
    k AS (SELECT DISTINCT item, n, array_to_string(ws[i:i + n - 1], ' ') AS phrase FROM b),
    g AS (
      SELECT id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS phrase
      FROM (SELECT id, ws, n, unnest(generate_series(1, len(ws) - n + 1)) AS i
            FROM w, (SELECT DISTINCT n FROM k) WHERE kind = 'd' AND len(ws) >= n)),
    m AS (SELECT id, g.n, i, item FROM g JOIN k ON g.n = k.n AND g.phrase = k.phrase),
    h AS (SELECT id, count(*) AS hits FROM (SELECT DISTINCT id, unnest(generate_series(i, i + n - 1)) AS p FROM m) GROUP BY id),
    o AS (SELECT id, count(*) AS items, string_agg(item::VARCHAR, ',' ORDER BY item::VARCHAR) AS names
          FROM (SELECT DISTINCT id, item FROM m) GROUP BY id)
    SELECT w.id AS doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(hits, 0) AS BIGINT) AS n_hit,
           CAST(coalesce(items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
           coalesce(hits, 0) > 0 AND 20 * coalesce(hits, 0) >= len(ws) AS contaminated
    FROM w LEFT JOIN h USING (id) LEFT JOIN o USING (id) WHERE kind = 'd'
    """,
)
def op3(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_contamination(docs, read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        F.size("hit_words").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        is_contaminated(F.size("hit_words"), F.col("n_words")).alias("contaminated"),
    )


@query("op5_secret_scans")
def op5(spark, sf_dir):
    found = find_secrets(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans"
    )


@query(
    "op7_substring_dedup",
    r"""
    WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
    g AS (
      SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS k
      FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 12)) AS i FROM w WHERE len(ws) >= 13)),
    f AS (SELECT k, min(doc_id) AS first FROM g GROUP BY k),
    h AS (SELECT DISTINCT doc_id, i + j AS p FROM g JOIN f USING (k), range(0, 13) AS t(j) WHERE first < doc_id),
    s AS (SELECT doc_id, unnest(ws) AS word, unnest(generate_series(1, len(ws))) AS p FROM w),
    t AS (
      SELECT s.doc_id, count(h.p) AS gone, string_agg(word, ' ' ORDER BY s.p) FILTER (WHERE h.p IS NULL) AS kept
      FROM s LEFT JOIN h ON s.doc_id = h.doc_id AND s.p = h.p GROUP BY s.doc_id)
    SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed,
           sha256(coalesce(kept, '')) AS kept_sha256
    FROM w LEFT JOIN t USING (doc_id)
    """,
)
def op7(spark, sf_dir):
    kept = remove_repeats(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op2_mixing_sources")
def op2(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    sizes = docs.select("doc_id", "source", count_words(F.col("text")).alias("size"), F.xxhash64("text").alias("tie"))
    return plan_mix(materialize(sizes, "sizes")).select("doc_id", "size", "source_size", "target", "taken")


SHARD_BYTES = 64 << 20


@query(
    "op6_sharding",
    f"""
    WITH d AS (
      SELECT doc_id, coalesce(strlen(text), 0) AS n_bytes,
             ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15))::BIGINT AS h
      FROM documents),
    n AS (
      SELECT k, h >> (60 - k) AS p, sum(n_bytes) AS b, count(*) AS c
      FROM d, range(0, 40) AS t(k) GROUP BY ALL),
    f AS (
      SELECT d.doc_id, d.n_bytes, n.k, n.p, n.b, n.c
      FROM d JOIN n ON n.p = d.h >> (60 - n.k) WHERE n.b <= {SHARD_BYTES} OR n.c = 1
      QUALIFY row_number() OVER (PARTITION BY d.doc_id, d.h ORDER BY n.k) = 1)
    SELECT doc_id, CAST(n_bytes AS BIGINT) AS n_bytes,
           CASE WHEN k = 0 THEN '' ELSE right(repeat('0', 60) || bin(p), CAST(k AS BIGINT)) END AS shard,
           CAST(b AS BIGINT) AS shard_bytes, CAST(c AS BIGINT) AS shard_docs
    FROM f
    """,
)
def op6(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", F.octet_length("text").alias("size"))
    shards = assign_shards(docs, size="size", limit_bytes=SHARD_BYTES)
    return shards.select("doc_id", "n_bytes", "shard", "shard_bytes", "shard_docs")


@query("op8_quality_rules")
def op8(spark, sf_dir):
    judged = apply_quality_rules(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.drop("text")


@query("op10_quality_classifier")
def op10(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_quality(docs, read(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


@query(
    "op9_warc",
    """
    WITH p AS (
      SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS payload_digest,
             CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes
      FROM pages),
    o AS (SELECT payload_digest AS d, max(page_id) AS owner FROM p WHERE payload_bytes >= 1000 GROUP BY 1)
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN owner IS NOT NULL AND owner <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN owner <> page_id THEN owner END AS refers_to
    FROM p LEFT JOIN o ON p.payload_digest = o.d AND p.payload_bytes >= 1000
    """,
)
def op9(spark, sf_dir):
    return archive_round_trip(read(spark, sf_dir, "pages")).drop("url")


@query("op4_token_packing")
def op4(spark, sf_dir):
    vocabulary = spark.conf.get("spark.lakekit.vocabulary", VOCABULARY)
    packed = materialize(pack_documents(read(spark, sf_dir, "documents"), vocabulary), "matrices")
    return sequences(packed).select(
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("positions", 256).alias("positions_sha256"),
        F.element_at("cu_seqlens", -1).cast("long").alias("n_ids"),
        "cu_seqlens",
        "doc_ids",
        "parts",
    )


@query("op11_merkle_manifest", oracles.merkle())
def op11(spark, sf_dir):
    return audit(read(spark, sf_dir, "documents")).drop("tree", "place")


@query("op12_minhash_near_dedup")
def op12(spark, sf_dir):
    return near_duplicates(read(spark, sf_dir, "documents"), shingle_words=5, percent=85)


@query(
    "op13_source_divergence",
    r"""
    WITH d AS (
      SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
    w AS (SELECT id, lang, source, unnest(ws) AS term FROM d),
    k AS (SELECT lang, term, count(*)::HUGEINT AS n FROM w GROUP BY ALL HAVING count(DISTINCT id) >= 3),
    l AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS total FROM k GROUP BY lang),
    c AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM w JOIN k USING (lang, term) GROUP BY ALL),
    g AS (
      SELECT s.lang, s.source, coalesce(t.total, 0)::HUGEINT AS total
      FROM (SELECT DISTINCT lang, source FROM d) s
      LEFT JOIN (SELECT lang, source, sum(n)::HUGEINT AS total FROM c GROUP BY ALL) t ON s.lang = t.lang AND s.source = t.source),
    p AS (
      SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + 1000000000 * (coalesce(c.n, 0) + 1) // (g.total + l.v) AS p,
             1 + 1000000000 * (k.n + 1) // (l.total + l.v) AS q
      FROM g JOIN l USING (lang) JOIN k USING (lang)
      LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
    f AS (
      SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
    r AS (
      SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
      UNION ALL
      SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p WHERE n > 0 AND p > q)
    SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
           CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
    FROM r QUALIFY part = 'pair' OR rank <= 200
    """,
)
def op13(spark, sf_dir):
    return divergence(read(spark, sf_dir, "documents"))
