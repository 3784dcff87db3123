"""Registered queries of this package, over whole tables with production parameters, and their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.config import shared_folder
from quayside.llm import ann, decontaminate, line_dedup, mixing, ngram_join, quality, secrets, spelling, token_align, topk, toxicity, url_filter, warc
from quayside.llm.tables import table

HOST_PATH_RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))
#: Addresses that hold no prose.
WILDCARD_RULES = tuple((rule, "block") for rule in ("/wp-admin/", "/wp-login.", "/cart/", "/checkout/", "/ads/*/banner^", "?sessionid=", ".exe|"))
URL_RULES = tuple(url_filter.host_path_rule(*r) for r in HOST_PATH_RULES) + tuple(url_filter.wildcard_rule(*r) for r in WILDCARD_RULES)


def op1_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    judged = url_filter.judge(table(spark, folder, "pages").select("page_id", "url"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op2_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    done = line_dedup.deduplicate(docs, min_docs=10, min_chars=1, keep_first=False)
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    return quality.classify(docs, table(spark, folder, "labels")).select("doc_id", "quality_score", "keep")


def op7_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.find(table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "benchmark"), n=5, percent=80)


def op8_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    scored = toxicity.score(table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "labels"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op4_ann(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return ann.search(vectors, vectors.where("vec_id % 100 = 0"), k=10)


def op5_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    joined = ngram_join.join(table(spark, folder, "documents").select("doc_id", "text"), n=4, percent=85)
    return joined.select("doc_id", F.col("n_grams").alias("n_shingles"), "component_id")


def op9_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Findings without the secrets themselves: a digest and the length stand for the value."""
    found = secrets.scan(table(spark, folder, "documents").select("doc_id", "text", "source"))
    return found.select("doc_id", "position", F.length("value").alias("length"), F.sha2("value", 256).alias("value_sha256"), "score", "is_secret")


def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Responses are read with their payloads, decoded and checked; of revisits only headers are read."""
    path = f"{shared_folder(spark)}/llm/archives-{uuid.uuid4().hex}"
    warc.write_archives(table(spark, folder, "pages").select("page_id", "url", "html"), path, "2024-01-01T00:00:00Z")
    responses = warc.read_archives(spark, path, verify=True).where("type = 'response'").withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    headers = "record_id string, type string, payload_digest string, refers_to string, payload_bytes long"
    revisits = warc.read_archives(spark, path, headers).where("type = 'revisit'")
    columns = [c.split()[0] for c in headers.split(", ")]
    page = lambda name: F.nullif(F.regexp_extract(name, "^urn:page_id:(.*)$", 1), F.lit("")).cast("long")
    return responses.select(columns).union(revisits.select(columns)).select(
        page("record_id").alias("page_id"), "payload_bytes", "payload_digest", F.col("type").alias("record_type"), page("refers_to").alias("refers_to")
    )


def without_one_letter(doc_id: Column, run: Column) -> Column:
    """One in 31 runs of a document, told by a checksum, loses a letter."""
    check = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run))
    at = (check % F.length(run)).cast("int")
    return F.when(check % 31 == 0, F.concat(F.left(run, at), F.substr(run, at + 2))).otherwise(run)


def op11_spelling(spark: SparkSession, folder: str) -> DataFrame:
    words = spelling.count_words(table(spark, folder, "documents"), min_chars=7, min_count=2, respelled=without_one_letter)
    return spelling.group_variants(words, ratio=10)


#: The two tokenizers that are aligned.
TOKENIZERS = ("/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model")


def op12_token_align(spark: SparkSession, folder: str) -> DataFrame:
    return token_align.align(table(spark, folder, "documents"), *TOKENIZERS)


def op13_topk(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings").select("vec_id", topk.scaled(F.col("embedding"), 256).alias("vector"))
    return topk.search(vectors, vectors.where("vec_id % 50 = 0"), k=5)


REGISTERED = [
    op1_url_filter, op2_line_dedup, op3_toxicity, op4_ann, op5_ngram_join, op6_quality, op7_decontaminate, op8_mixing, op9_secrets, op10_warc,
    op11_spelling, op12_token_align, op13_topk,
]


ORACLES = {
    "op1_url_filter": r"""
        WITH rules(rule, verdict) AS (VALUES ('org/', 'allow'), ('example.org/es/', 'block'), ('example.org/en/1', 'block'), ('com/fr/', 'allow'), ('com/de/', 'block')),
        split_rules AS (SELECT rule, verdict, split_part(rule, '/', 1) AS rule_host, substr(rule, strpos(rule, '/')) AS rule_path FROM rules),
        tails AS (SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS tail FROM pages),
        hosts AS (SELECT *, regexp_extract(tail, '^[^/?#]*') AS raw_host FROM tails),
        parts AS (
            SELECT page_id, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(substr(tail, length(raw_host) + 1), '^[^?#]*') AS path, substr(tail, length(raw_host) + 1) AS rest
            FROM hosts),
        fits AS (
            SELECT page_id, p.host, p.path, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
            FROM parts p JOIN split_rules r ON (p.host = rule_host OR ends_with(p.host, '.' || rule_host)) AND starts_with(p.path, rule_path)
            GROUP BY page_id, p.host, p.path)
        SELECT p.page_id, p.host, p.path, f.rule,
               coalesce(f.verdict, CASE WHEN regexp_matches(p.host || rest, '(?s)/wp-admin/|/wp-login\.|/cart/|/checkout/|/ads/.*/banner([^0-9A-Za-z_.%-]|$)|\?sessionid=|\.exe$')
                                        THEN 'block' ELSE 'allow' END) AS verdict
        FROM parts p LEFT JOIN (SELECT DISTINCT * FROM fits) f ON p.page_id IS NOT DISTINCT FROM f.page_id AND p.host = f.host AND p.path = f.path""",
    "op2_line_dedup": r"""
        WITH docs AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
        lines AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM docs),
        keyed AS (
            SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM lines),
        common AS (SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
        SELECT doc_id, count(*) AS n_lines, count(c.key) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE c.key IS NULL), '')) AS kept_sha256
        FROM keyed LEFT JOIN common c USING (key) GROUP BY doc_id""",
    "op8_mixing": r"""
        WITH docs AS (
            SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
                   ('0x' || substr(md5('0:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT AS step FROM documents),
        sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source),
        weighed AS (
            SELECT *, ((row_number() OVER (ORDER BY source COLLATE "C" NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight, source_size * 3.0::DOUBLE AS limit_ FROM sources),
        -- The level is right when the sources it caps are just those whose limit it passes.
        levels AS (
            SELECT ((SELECT sum(source_size) FROM weighed) - coalesce(sum(o.limit_) FILTER (WHERE o.limit_ / o.weight < w.limit_ / w.weight), 0))::DOUBLE
                   / sum(o.weight) FILTER (WHERE o.limit_ / o.weight >= w.limit_ / w.weight) AS level, w.limit_ / w.weight AS until
            FROM weighed w CROSS JOIN weighed o GROUP BY w.source, w.limit_, w.weight),
        settled AS (SELECT arg_min(level, until) AS level FROM levels WHERE level <= until),
        goals AS (SELECT source, source_size, least(level * weight, limit_) AS target FROM weighed, settled),
        parts AS (
            SELECT source, source_size, target, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM goals),
        wanted AS (SELECT *, target - whole * source_size AS wanted FROM parts),
        by_size AS (SELECT source, size, count(*) * size AS words, count(*)::HUGEINT * size * size AS squares FROM docs WHERE size > 0 GROUP BY source, size),
        -- Documents over some size are certain; the rate is right for the largest size whose odds it doesn't bring over 1.
        tried AS (
            SELECT b.source, b.size, (w.wanted - coalesce(sum(words) OVER (PARTITION BY b.source ORDER BY size DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
                   / (sum(squares) OVER (PARTITION BY b.source ORDER BY size DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS rate
            FROM by_size b JOIN wanted w ON b.source IS NOT DISTINCT FROM w.source),
        rates AS (SELECT source, arg_max(rate, size) AS rate FROM tried WHERE rate * size <= 1 GROUP BY source),
        drawn AS (
            SELECT d.*, w.source_size, w.target, w.whole, w.wanted, coalesce(r.rate, 0) * d.size AS p, (d.step + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u
            FROM docs d JOIN wanted w ON d.source IS NOT DISTINCT FROM w.source LEFT JOIN rates r ON d.source IS NOT DISTINCT FROM r.source),
        odds AS (SELECT *, CASE WHEN p > 0 AND p < 1 THEN (u / (1 - u)) / (p / (1 - p)) END AS q FROM drawn),
        placed AS (
            SELECT *, CASE WHEN p >= 1 THEN 0 WHEN q IS NULL THEN 4503599627370496 ELSE floor(q / (1 + q) * 4503599627370496::DOUBLE)::BIGINT END AS place FROM odds),
        ranked AS (
            SELECT *, sum(size) OVER (PARTITION BY source ORDER BY place, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING) - size / 2.0::DOUBLE AS middle FROM placed)
        SELECT doc_id, size, source_size, target, size * (whole + (middle <= wanted AND wanted > 0)::BIGINT) AS taken FROM ranked""",
    "op5_ngram_join": r"""
        WITH RECURSIVE docs AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
        sets AS (
            SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
                ELSE list_distinct(list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' '))) END AS grams FROM docs),
        rows_ AS (SELECT doc_id, len(grams) AS n, unnest(grams) AS gram FROM sets),
        pairs AS (
            SELECT a.doc_id AS a, b.doc_id AS b FROM rows_ a JOIN rows_ b ON a.gram = b.gram AND a.doc_id <> b.doc_id
            GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
        reached AS (SELECT doc_id, doc_id AS other FROM sets UNION SELECT r.doc_id, p.b FROM reached r JOIN pairs p ON r.other = p.a)
        SELECT s.doc_id, len(s.grams) AS n_shingles, min(r.other) AS component_id FROM sets s JOIN reached r USING (doc_id) GROUP BY s.doc_id, len(s.grams)""",
    "op10_warc": r"""
        WITH sums AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
        named AS (
            SELECT page_id, octet_length(encode(html)) AS payload_bytes, hex,
                   array_to_string(list_transform(range(8), lambda g: array_to_string(list_transform([15, 10, 5, 0],
                       lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (('0x' || substr(hex, g * 5 + 1, 5))::INT >> s) % 32 + 1, 1)), '')), '') AS payload_digest
            FROM sums),
        firsts AS (SELECT hex, payload_bytes, max(page_id) AS first_id FROM named GROUP BY hex, payload_bytes)
        SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first_id THEN first_id END AS refers_to
        FROM named JOIN firsts USING (hex, payload_bytes)""",
    "op7_decontaminate": r"""
        WITH texts AS (
            SELECT 'doc' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'item', item_id, text FROM benchmark),
        worded AS (
            SELECT kind, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM texts),
        sets AS (
            SELECT kind, id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
                ELSE list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) END AS grams FROM worded),
        rows_ AS (SELECT kind, id, len(grams) AS n, unnest(grams) AS gram FROM sets)
        SELECT d.id AS doc_id, i.id AS item_id, count(*) AS shared, i.n AS n_shingles
        FROM rows_ d JOIN rows_ i ON d.kind = 'doc' AND i.kind = 'item' AND d.gram = i.gram
        GROUP BY d.id, i.id, i.n HAVING 100 * count(*) >= 80 * i.n""",
    "op13_topk": r"""
        WITH finite AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vector FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
        scored AS (
            SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.vector, v.vector)::BIGINT AS score
            FROM finite q JOIN finite v ON q.vec_id % 50 = 0 AND q.vec_id <> v.vec_id),
        ranked AS (SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank FROM scored)
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5""",
}
