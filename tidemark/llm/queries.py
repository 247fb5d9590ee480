"""The queries of the corpus operators, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .collocations import mine_collocations
from .decontam import decontaminate, items_digest
from .kd_sharding import category, kd_shards, magnitude
from .license_scan import scan_licenses
from .line_dedup import dedup_lines
from .minhash import minhash_components
from .pieces import encode_pieces
from .private_data import KINDS, sanitise
from .quality import fit_bands, quality_rules
from .secret_scan import frequent_words, scan_secrets
from .simhash import simhash_components
from .token_counts import count_document_tokens
from .turn_repair import all_conversations, damage, repair_report

#: Folder of public vocabulary files; a parameter of every query that reads one.
TOKENIZERS = "/opt/tokenizers"
#: Pattern that cuts texts for the byte-level vocabularies, and the id that closes a document.
EOD = 50256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@lru_cache(maxsize=4)
def vocabulary(name: str, folder: str = TOKENIZERS) -> bytes:
    """A vocabulary file of the driver's own disk; a few hundred kB that a broadcast may hold."""
    return Path(folder, name).read_bytes()


def byte_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate(docs, table(spark, sf_dir, "benchmark"), window=13)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        items_digest(F.col("items")).alias("items_sha256"),
        "contaminated",
    )


OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), p AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS m, array_to_string(w[s : s + least(len(w), 13) - 1], ' ') AS gram
  FROM b, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS t(s)
  WHERE len(w) > 0
), lengths AS (SELECT DISTINCT m FROM p), g AS (
  SELECT doc_id, s, m, array_to_string(w[s : s + m - 1], ' ') AS gram
  FROM d, lengths, unnest(range(1, len(w) - m + 2)) AS t(s)
), hit AS (SELECT g.doc_id, g.s, g.m, p.item_id FROM g JOIN p ON p.gram = g.gram AND p.m = g.m),
words AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM hit, unnest(range(s, s + m)) AS t(x) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(id, ',' ORDER BY id)) AS digest
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(digest, sha256('')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def op3_token_counts(spark: SparkSession, sf_dir: str, tokenizers: str = TOKENIZERS) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_document_tokens(docs, vocabulary("byte_bpe_50k.tiktoken", tokenizers), byte_pattern(), EOD).select("doc_id", "n_tokens")


def op4_pieces(spark: SparkSession, sf_dir: str, tokenizers: str = TOKENIZERS) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_pieces(docs, vocabulary("piece_bpe_32k.model", tokenizers)).drop("text")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), edits=2, least=40, short=True)
    return found.select("doc_id", "n_lines", "n_dropped", "n_near", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules(docs, fit_bands(docs, table(spark, sf_dir, "labels"))).drop("text")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_components(table(spark, sf_dir, "documents"), radius=4, shingle=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan_secrets(docs, words=frequent_words(docs))
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    joined = lambda keep: F.array_join(F.transform(F.filter("secrets", keep), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return found.select(
        "doc_id",
        count("assign"),
        count("access"),
        count("hex"),
        F.sha2(joined(lambda s: s["kind"] != "novel"), 256).alias("base_sha256"),
        joined(lambda s: F.lit(True)).alias("spans"),
        count("novel"),
    )


def op9_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    dims = [category(F.col("source")), category(F.col("lang")), magnitude(F.col("n_chars"))]
    return kd_shards(docs, dims, n_shards=24).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op10_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sanitise(table(spark, sf_dir, "documents").select("doc_id", "text")).withColumnRenamed("private_spans", "spans")
    names = F.array(*[F.lit(k) for k in KINDS])
    count = lambda i: F.size(F.filter("spans", lambda s: s["kind"] == i)).cast("long").alias(f"n_{KINDS[i]}")
    joined = lambda kinds: F.array_join(
        F.transform(F.filter("spans", lambda s: s["kind"] < kinds), lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ","
    )
    return found.select(
        "doc_id",
        *[count(i) for i in range(4)],
        F.sha2(joined(4), 256).alias("base_sha256"),
        joined(5).alias("spans"),
        count(4),
        F.sha2(F.coalesce("sanitised", F.lit("")), 256).alias("sanitised_sha256"),
    )


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return all_conversations(repair_report(damage(turns), copies="copies"), turns)


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_components(table(spark, sf_dir, "documents"), shingle=4, per_cent=80)


OP12_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ 	-
]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, list_sort(list_distinct(list_transform(range(1, greatest(len(w) - 4, 0) + 2), lambda s: array_to_string(w[s : s + 3], ' ')))) AS g FROM d WHERE len(w) > 0
), classes AS (SELECT min(doc_id) AS c, g, len(g) AS n FROM sets GROUP BY g),
grams AS (SELECT c, n, unnest(g) AS gram FROM classes),
links AS (
  SELECT a.c AS a, b.c AS b FROM grams a JOIN grams b ON a.gram = b.gram AND a.c <> b.c AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.c, b.c, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reach AS (
  SELECT c, c AS r FROM classes UNION SELECT reach.c, links.b FROM reach JOIN links ON links.a = reach.r
), least AS (SELECT c, min(r) AS component_id FROM reach GROUP BY c)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, coalesce(component_id, d.doc_id) AS component_id,
  coalesce(component_id, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN sets USING (doc_id) LEFT JOIN classes USING (g) LEFT JOIN least USING (c)
"""


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_collocations(table(spark, sf_dir, "documents"), least=100, top=2000)


OP13_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, m, array_to_string(w[s : s + m - 1], ' ') AS phrase, count(*)::HUGEINT AS f
  FROM words, unnest(range(1, 6)) AS t(m), unnest(range(1, len(w) - m + 2)) AS u(s) WHERE len(w) >= m GROUP BY ALL HAVING count(*) >= 100
), totals AS (SELECT lang, sum(len(w))::HUGEINT AS n FROM words GROUP BY lang),
candidates AS (SELECT lang, phrase, m, f AS a, string_split(phrase, ' ') AS w FROM grams WHERE m >= 2),
inner_phrases AS (
  SELECT lang, array_to_string(w[s : s + k - 1], ' ') AS phrase, max(a) AS whole
  FROM candidates, unnest(range(2, m)) AS t(k), unnest(range(1, m - k + 2)) AS u(s) GROUP BY ALL
), kept AS (
  SELECT c.* FROM candidates c LEFT JOIN inner_phrases i USING (lang, phrase) WHERE i.whole IS NULL OR 100 * i.whole < 100 * a
), cuts AS (
  SELECT kept.lang, kept.phrase, a, k, l.f AS l, r.f AS r, n, 1000 * a * n // (l.f * r.f) AS score
  FROM kept CROSS JOIN unnest(range(1, 5)) AS t(k) JOIN totals ON totals.lang = kept.lang
  JOIN grams l ON l.lang = kept.lang AND l.phrase = array_to_string(w[1:k], ' ')
  JOIN grams r ON r.lang = kept.lang AND r.phrase = array_to_string(w[k + 1 :], ' ')
  WHERE k < kept.m
), best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
  a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM best QUALIFY rank <= 2000
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": op1_license_scan,
    "op2_decontamination": op2_decontamination,
    "op3_token_counts": op3_token_counts,
    "op4_pieces": op4_pieces,
    "op5_line_dedup": op5_line_dedup,
    "op6_quality_rules": op6_quality_rules,
    "op7_simhash": op7_simhash,
    "op8_secret_scan": op8_secret_scan,
    "op9_kd_sharding": op9_kd_sharding,
    "op10_private_data": op10_private_data,
    "op11_turn_repair": op11_turn_repair,
    "op12_minhash": op12_minhash,
    "op13_collocations": op13_collocations,
}
SQL: dict[str, str] = {"op2_decontamination": OP2_SQL, "op12_minhash": OP12_SQL, "op13_collocations": OP13_SQL}
