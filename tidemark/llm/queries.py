"""The registered queries of the training-data operators, and SQL oracles where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontamination, embedding_dedup, exact_dedup, fill_in_middle, language_id, license_scan, ngram_join, packing, ppm, ranked_search, secret_scan, sharding, toxicity
from tidemark.llm.common import fold, scratch_dir, table


def tokenizer_files() -> tuple[str, str]:
    """The tokenizer file of the packing query, and the ranks of the same vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where("doc_id is not null").where(fold(F.col("doc_id")) != 0)
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    return scored.select("doc_id", F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "score", "predicted")


def op4_ppm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score(table(spark, sf_dir, "documents"))


def op5_differencing_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), *tokenizer_files())


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    base = secret_scan.rendered(F.filter("found", lambda s: s["rank"] < 3))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(base, 256).alias("base_sha256"), secret_scan.rendered(F.col("found")).alias("spans"))


def op7_tiered_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: the live file that holds it after two arrivals, each split by source and compacted."""
    docs = table(spark, sf_dir, "documents")
    shards = sharding.Shards(spark, scratch_dir(spark))
    late = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 0, F.lit(True))
    for arrival in (docs.where(~late), docs.where(late)):
        shards.append(arrival, "source")
        version = shards.compact()
    found = shards.rows(["doc_id"], version)
    shard = F.col("tidemark_shard")
    file = {"kind": shard["kind"], "tier": shard["tier"], "file_rows": shard["rows"], "file_bytes": shard["bytes"]}
    return found.select("doc_id", F.sha1(shard["file"]).alias("file"), *(c.alias(n) for n, c in file.items()), F.lit(version).alias("version"))


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs.where("doc_id is not null").where(fold(F.col("doc_id")) != 0).select("lang", "text"))
    found = language_id.identify(docs, model)
    return found.select("doc_id", F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle.transform(table(spark, sf_dir, "documents").select("doc_id", "text"), render=False)
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")


QUERIES = {
    f.__name__: f
    for f in (
        op1_embedding_near_dedup,
        op2_license_scan,
        op3_toxicity,
        op4_ppm_scores,
        op5_differencing_packing,
        op6_secret_scan,
        op7_tiered_shards,
        op8_benchmark_decontamination,
        op9_language_id,
        op10_ngram_jaccard_join,
        op11_ranked_search,
        op12_exact_dedup,
        op13_fill_in_middle,
    )
}

_COMPONENTS = """
reach(a, b) AS (
  SELECT id, id FROM nodes
  UNION
  SELECT r.a, l.v FROM reach r JOIN links l ON l.u = r.b
)"""

ORACLES: dict[str, str] = {
    "op1_embedding_near_dedup": f"""
WITH RECURSIVE good AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND list_sum(list_transform(embedding, lambda x: abs(x))) > 0
), nodes AS (SELECT DISTINCT vec_id AS id FROM embeddings),
links AS MATERIALIZED (
  SELECT a.vec_id AS u, b.vec_id AS v FROM good a JOIN good b ON a.label = b.label AND a.vec_id != b.vec_id
  WHERE list_inner_product(a.e, b.e) / sqrt(list_inner_product(a.e, a.e)) / sqrt(list_inner_product(b.e, b.e)) >= 0.98
), {_COMPONENTS}, component AS (SELECT a, min(b) AS c FROM reach GROUP BY a),
degree AS (SELECT u, count(*) AS n FROM links GROUP BY u)
SELECT e.vec_id, coalesce(d.n, 0)::BIGINT AS n_links, c.c AS component_id, e.vec_id = c.c AS kept
FROM embeddings e JOIN component c ON c.a = e.vec_id LEFT JOIN degree d ON d.u = e.vec_id""",
    "op8_benchmark_decontamination": r"""
WITH words AS (
  SELECT 0 AS kind, doc_id AS id, regexp_extract_all(lower(coalesce(text, '')), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
  UNION ALL
  SELECT 1, item_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark
), widths AS (SELECT DISTINCT least(len(w), 5) AS k FROM words WHERE kind = 1 AND len(w) > 0),
shingles AS (
  SELECT DISTINCT kind, id, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i+k-1], ' '))) AS s
  FROM words JOIN widths ON len(w) >= k AND (kind = 0 OR k = least(len(w), 5))
), items AS (SELECT id, count(*) AS n FROM shingles WHERE kind = 1 GROUP BY id),
both_have AS (
  SELECT d.id AS doc_id, b.id AS item_id, count(*) AS n FROM shingles d JOIN shingles b ON d.s = b.s AND d.k = b.k AND d.kind = 0 AND b.kind = 1 GROUP BY ALL
)
SELECT doc_id, item_id, i.n AS n_item, h.n AS n_contained, h.n / i.n::DOUBLE AS containment
FROM both_have h JOIN items i ON i.id = h.item_id WHERE h.n * 10 >= i.n * 8""",
    "op10_ngram_jaccard_join": rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i+3], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM words
), sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS MATERIALIZED (
  SELECT a.doc_id AS u, b.doc_id AS v FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id != b.doc_id
    JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))
), nodes AS (SELECT DISTINCT doc_id AS id FROM documents),{_COMPONENTS}, component AS (SELECT a, min(b) AS c FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, c.c AS component_id
FROM documents d JOIN component c ON c.a = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id""",
    "op11_ranked_search": r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents
), sizes AS (SELECT doc_id, len(t)::BIGINT AS n FROM words WHERE len(t) > 0),
total AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM sizes),
items AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), tf AS MATERIALIZED (
  SELECT doc_id, term, count(*)::BIGINT AS tf FROM (SELECT doc_id, unnest(t) AS term FROM words) WHERE term IN (SELECT term FROM items) GROUP BY ALL
), weights AS (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, total GROUP BY term, docs),
scores AS (
  SELECT i.item_id, f.doc_id, sum(w * ((1000000000 * f.tf) // (1000 * f.tf + 20 * (100 - 50 + (50 * n * docs) // terms))))::BIGINT AS score
  FROM items i JOIN tf f ON f.term = i.term JOIN weights v ON v.term = f.term JOIN sizes s ON s.doc_id = f.doc_id, total
  GROUP BY i.item_id, f.doc_id
), ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM scores WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 50""",
    "op12_exact_dedup": r"""
WITH digests AS (
  SELECT doc_id, length(coalesce(text, '')) AS points, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS sha FROM documents
)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY sha) AS group_size, row_number() OVER best = 1 AS kept, sha AS text_sha256
FROM digests WINDOW best AS (PARTITION BY sha ORDER BY points DESC, doc_id NULLS LAST)""",
    "op13_fill_in_middle": r"""
WITH hashed AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
), numbers AS (
  SELECT doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS units, ('0x' || h[1:8])::UBIGINT AS h1, ('0x' || h[9:16])::UBIGINT AS h2, ('0x' || h[17:24])::UBIGINT AS h3, ('0x' || h[25:32])::UBIGINT AS h4 FROM hashed
), forms AS (
  SELECT *, len(units)::BIGINT AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1))::BIGINT AS a, greatest(h1 % (len(units) + 1), h2 % (len(units) + 1))::BIGINT AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM numbers
), parts AS (
  SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a+1:b], '') AS middle, array_to_string(units[b+1:], '') AS suffix FROM forms
)
SELECT doc_id, n, form, CASE WHEN form != 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form != 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts""",
}
