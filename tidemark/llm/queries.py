"""Registered queries of the operators, with production parameters over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import codes, decontaminate, language, lines, pieces, pii, resampling, simhash, suffixes, token_counts, token_files, toxicity, vectors
from tidemark.llm.common import Scratch

BYTE_BPE = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op2_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.without_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_kept", F.length("text").alias("kept_chars"), F.md5("text").alias("kept_md5"))


def op3_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.score_texts(table(spark, sf_dir, "documents"), vocabulary(BYTE_BPE))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.digests(pii.find(docs, pii.train(docs)))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = Scratch(spark, "tokens").folder("files")
    manifest = token_files.write_tokens(table(spark, sf_dir, "documents"), folder, vocabulary(BYTE_BPE))
    return token_files.digests(token_files.read_tokens(manifest))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), vocabulary(PIECES))


def op9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(table(spark, sf_dir, "documents"), vocabulary(PIECES), with_ids=False)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op11_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffixes.cut_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op12_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compress(table(spark, sf_dir, "embeddings"))


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_lines": op2_lines,
    "op3_embeddings": op3_embeddings,
    "op4_language": op4_language,
    "op5_decontaminate": op5_decontaminate,
    "op6_pii": op6_pii,
    "op7_token_files": op7_token_files,
    "op8_token_counts": op8_token_counts,
    "op9_pieces": op9_pieces,
    "op10_toxicity": op10_toxicity,
    "op11_suffixes": op11_suffixes,
    "op12_codes": op12_codes,
    "op13_resampling": op13_resampling,
}

# Bytes as hexadecimal digits, so that two characters stand for one byte.
OP11_SQL = """
WITH t AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
w AS (SELECT doc_id, i, substr(x, 2 * i + 1, 100) AS s
      FROM (SELECT doc_id, x, unnest(range(0, length(x) // 2 - 49)) AS i FROM t WHERE length(x) >= 100)),
least AS (SELECT s, min(doc_id) AS first_id FROM w GROUP BY s),
gone AS (SELECT w.doc_id, w.i FROM w JOIN least USING (s) WHERE w.doc_id > first_id),
marked AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 THEN 0 ELSE 1 END AS new FROM gone),
numbered AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM marked),
spans AS (SELECT doc_id, k, min(i) AS a, max(i) + 50 AS b FROM numbered GROUP BY doc_id, k),
pieces AS (SELECT doc_id, k, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY k), 0) AS z FROM spans),
cut AS (SELECT p.doc_id, sum(b - a) AS n_removed, count(*) AS n_spans,
               string_agg(substr(x, CAST(2 * z + 1 AS BIGINT), CAST(2 * (a - z) AS BIGINT)), '' ORDER BY k) AS head, max(b) AS z
        FROM pieces p JOIN t USING (doc_id) GROUP BY p.doc_id)
SELECT t.doc_id, CAST(length(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(x, CAST(2 * coalesce(z, 0) + 1 AS BIGINT)))) AS kept_sha256
FROM t LEFT JOIN cut USING (doc_id)
"""

# CRC-32 byte by byte over a table that the first rows make by its rule.
OP13_SQL = r"""
WITH RECURSIVE turned(b, k, v) AS (
  SELECT b, 0, b FROM (SELECT unnest(range(256)) AS b)
  UNION ALL SELECT b, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM turned WHERE k < 8),
tab AS (SELECT list(v ORDER BY b) AS steps FROM turned WHERE k = 8),
digits AS (SELECT map_from_entries(list({'k': printf('%02X', b), 'v': b})) AS byte FROM (SELECT unnest(range(256)) AS b)),
texts AS (SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark),
split AS (SELECT kind, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
runs AS (SELECT kind, id, unnest(list_concat(w,
             list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
             list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS f FROM split),
counted AS (SELECT kind, id, f, count(*) AS n FROM runs GROUP BY kind, id, f),
hexed AS (SELECT f, hex(encode(f)) AS x FROM (SELECT DISTINCT f FROM counted)),
crc AS (SELECT f, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(length(x) // 2), lambda i: CAST(byte[substr(x, 2 * i + 1, 2)] AS BIGINT))),
               lambda c, b: xor(steps[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 10000 AS bucket FROM hexed, tab, digits),
hits AS (SELECT kind, id, bucket, sum(n) AS n FROM counted JOIN crc USING (f) GROUP BY kind, id, bucket),
sums AS (SELECT b AS bucket, coalesce(sum(n) FILTER (kind = 'd'), 0) AS s, coalesce(sum(n) FILTER (kind = 'b'), 0) AS t
         FROM (SELECT unnest(range(10000)) AS b) LEFT JOIN hits ON bucket = b GROUP BY b),
totals AS (SELECT sum(s) AS s_all, sum(t) AS t_all FROM sums),
gains AS (SELECT bucket, CAST(floor(1000 * ln((CAST(t + 1 AS DOUBLE) * CAST(s_all + 10000 AS DOUBLE)) / (CAST(s + 1 AS DOUBLE) * CAST(t_all + 10000 AS DOUBLE)))) AS BIGINT) AS g
          FROM sums, totals),
weighed AS (SELECT id, sum(n * g) AS weight FROM hits JOIN gains USING (bucket) WHERE kind = 'd' GROUP BY id),
scored AS (SELECT id AS doc_id, len(w) AS words, CAST(len(w) + greatest(len(w) - 1, 0) + greatest(len(w) - 2, 0) AS BIGINT) AS n_features,
                  CAST(coalesce(weight, 0) AS BIGINT) AS weight, CAST(coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
                  (CAST('0x' || substr(sha256('42:' || id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS BIGINT) AS score
           FROM split LEFT JOIN weighed USING (id) WHERE kind = 'd'),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n FROM scored WHERE words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN r <= 5 * n // 100 THEN r END AS rank FROM scored LEFT JOIN ranked USING (doc_id)
"""



def _codes_sql(rounds: int) -> str:
    """All entries compared in every round; the sort key of a distance holds the entry's index below it."""
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""
near{k} AS MATERIALIZED (SELECT vec_id, p.part, any_value(x) AS x, min(CAST(list_inner_product(x, x) - 2 * list_inner_product(x, c) + list_inner_product(c, c) AS BIGINT) * 256 + e) AS m
      FROM p JOIN book{k} b ON p.part = b.part GROUP BY vec_id, p.part)""")
        if k < rounds:
            steps.append(f"""
mean{k} AS (SELECT part, e, list(v ORDER BY pos) AS c FROM (
      SELECT part, m % 256 AS e, pos, floor(sum(x[pos]) / count(*)) AS v FROM near{k}, (SELECT unnest(range(1, 17)) AS pos) GROUP BY ALL) GROUP BY part, e),
book{k + 1} AS MATERIALIZED (SELECT part, e, coalesce(n.c, o.c) AS c FROM book{k} o LEFT JOIN mean{k} n USING (part, e))""")
    return f"""
WITH base AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (SELECT vec_id, part, v[part * 16 + 1 : part * 16 + 16] AS x FROM base, (SELECT unnest(range(4)) AS part)),
book0 AS MATERIALIZED (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS e, x AS c
      FROM p WHERE vec_id IN (SELECT vec_id FROM base ORDER BY vec_id LIMIT 256)),{",".join(steps)},
coded AS (SELECT vec_id, string_agg(printf('%02x', m % 256), '' ORDER BY part) AS code, CAST(sum(m // 256) AS BIGINT) AS error FROM near{rounds} GROUP BY vec_id),
sums AS (SELECT label, CAST(sum(error) AS BIGINT) AS label_error FROM coded JOIN base USING (vec_id) GROUP BY label)
SELECT vec_id, code, error, label_error,
       (SELECT sha256(string_agg(array_to_string(list_transform(c, lambda x: CAST(x AS BIGINT)), ','), ',' ORDER BY part, e)) FROM book{rounds}) AS codebooks_sha256
FROM coded JOIN base USING (vec_id) JOIN sums ON base.label IS NOT DISTINCT FROM sums.label
"""


OP12_SQL = _codes_sql(rounds=4)

ORACLE_SQL: dict[str, str] = {"op11_suffixes": OP11_SQL, "op12_codes": OP12_SQL, "op13_resampling": OP13_SQL}
