"""Registered queries of the training-data operators and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from panelcast.llm.common import crc_remainder, table, tokenizer_path

Query = Callable[[SparkSession, str], DataFrame]


def op1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest embeddings of every hundredth one."""
    from panelcast.llm.ann import neighbours

    return neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document by the 32k sentencepiece model."""
    from panelcast.llm.token_counts import token_counts

    return token_counts(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"), limit=4096)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a WARC record, written and read back."""
    from panelcast.llm.warc import round_trip

    return round_trip(table(spark, sf_dir, "pages"))


OP3_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS digest FROM pages
), g AS (
  SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY digest) END AS keeper FROM p
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN keeper IS NOT NULL AND page_id <> keeper THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN keeper IS NOT NULL AND page_id <> keeper THEN keeper END AS refers_to
FROM g
"""


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases, identifier tags and expressions of every document."""
    from panelcast.llm.license_scan import license_scan

    return license_scan(table(spark, sf_dir, "documents"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by centroids learned outside the held-out quarter."""
    from panelcast.llm import language_id as L

    docs = table(spark, sf_dir, "documents")
    held = crc_remainder("doc_id", 4) == 2
    model = L.fit(docs.where(~held))
    return L.predict(docs, model).select("doc_id", held.alias("held_out"), "lang_pred", "score", "rejected")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labels outside the held-out fifth."""
    from panelcast.llm import toxicity as T

    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    machine = T.fit(docs, labels.where(crc_remainder("doc_id", 5) != 0))
    return T.predict(docs, machine).select("doc_id", (crc_remainder("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents: 3-word shingles, at most 2 differing bits."""
    from panelcast.llm.simhash import simhash_groups

    return simhash_groups(table(spark, sf_dir, "documents"), shingle=3, most=2)


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items inside documents, at most a fifth of an item's words edited."""
    from panelcast.llm.decontaminate import find_leaks

    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), similarity=0.8)


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    from panelcast.llm.html_text import extract

    return extract(table(spark, sf_dir, "pages"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into windows of 4096 ids; the digest of every piece."""
    from panelcast.llm.packing import pack

    pieces = pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), end_id=2, window=4096)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 two- and three-word collocations of every language."""
    from panelcast.llm.collocations import collocations

    return collocations(table(spark, sf_dir, "documents"), shortest=2, longest=3, least=10, covered=50, top=2000)


OP11_SQL = """
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
), w AS (
  SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM piece
), n AS (
  SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang
), gram AS (
  SELECT lang, 1 AS k, unnest(w) AS phrase FROM w
  UNION ALL
  SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM w WHERE len(w) >= 2
  UNION ALL
  SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM w WHERE len(w) >= 3
), f AS (
  SELECT lang, k, phrase, count(*) AS f FROM gram GROUP BY lang, k, phrase HAVING count(*) >= 10
), over AS (
  SELECT lang, phrase, max(f) AS longer FROM (
    SELECT lang, split_part(phrase, ' ', 1) || ' ' || split_part(phrase, ' ', 2) AS phrase, f FROM f WHERE k = 3
    UNION ALL
    SELECT lang, split_part(phrase, ' ', 2) || ' ' || split_part(phrase, ' ', 3), f FROM f WHERE k = 3
  ) GROUP BY lang, phrase
), cut AS (
  SELECT f.lang, f.phrase, f.f AS a, f.k - 1 AS cuts, f.k AS words, f.phrase AS p FROM f LEFT JOIN over o ON o.lang = f.lang AND o.phrase = f.phrase
  WHERE f.k >= 2 AND (o.longer IS NULL OR 100 * o.longer < 50 * f.f)
), side AS (
  SELECT lang, phrase, a, 1 AS k, split_part(p, ' ', 1) AS lp, substr(p, length(split_part(p, ' ', 1)) + 2) AS rp FROM cut
  UNION ALL
  SELECT lang, phrase, a, 2, split_part(p, ' ', 1) || ' ' || split_part(p, ' ', 2), split_part(p, ' ', 3) FROM cut WHERE words = 3
), scored AS (
  SELECT s.lang, s.phrase, s.a, s.k, l.f AS l, r.f AS r,
         CAST((CAST(1000000 AS HUGEINT) * s.a * s.a) // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
  FROM side s JOIN f l ON l.lang = s.lang AND l.phrase = s.lp JOIN f r ON r.lang = s.lang AND r.phrase = s.rp
), best AS (
  SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS nth FROM scored
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best WHERE nth = 1
)
SELECT ranked.lang, rank, phrase, a, l, r, n.n, score FROM ranked JOIN n ON n.lang = ranked.lang WHERE rank <= 2000
"""


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 13-word windows that a document with a smaller id has too."""
    from panelcast.llm.substring_dedup import dedup_substrings

    return dedup_substrings(table(spark, sf_dir, "documents"), window=13)


OP12_SQL = """
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), win AS (
  SELECT doc_id, unnest(range(1, len(w) - 11)) AS i,
         unnest(list_transform(range(1, len(w) - 11), lambda i: array_to_string(w[i:i + 12], ' '))) AS s
  FROM w WHERE len(w) >= 13
), low AS (
  SELECT s, min(doc_id) AS m FROM win GROUP BY s
), gone AS (
  SELECT DISTINCT doc_id, k FROM (
    SELECT win.doc_id, unnest(range(win.i, win.i + 13)) AS k FROM win JOIN low ON low.s = win.s WHERE low.m < win.doc_id
  )
), word AS (
  SELECT doc_id, unnest(range(1, len(w) + 1)) AS k, unnest(w) AS x FROM w
), kept AS (
  SELECT word.doc_id, string_agg(x, ' ' ORDER BY word.k) AS kept, count(*) AS n
  FROM word LEFT JOIN gone ON gone.doc_id = word.doc_id AND gone.k = word.k WHERE gone.k IS NULL GROUP BY word.doc_id
)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(len(w.w) - coalesce(kept.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.kept, '')) AS kept_sha256
FROM w LEFT JOIN kept ON kept.doc_id = w.doc_id
"""


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding on the 16 leading components of all of them, whitened."""
    from panelcast.llm.whitening import whiten

    return whiten(table(spark, sf_dir, "embeddings"), k=16, scale=64.0, shift=1_000_000)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline."""
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Query] = {
    "op1_neighbours": op1_neighbours,
    "op2_token_counts": op2_token_counts,
    "op3_warc": op3_warc,
    "op4_license_scan": op4_license_scan,
    "op5_language_id": op5_language_id,
    "op6_toxicity": op6_toxicity,
    "op7_simhash": op7_simhash,
    "op8_decontaminate": op8_decontaminate,
    "op9_html_text": op9_html_text,
    "op10_packing": op10_packing,
    "op11_collocations": op11_collocations,
    "op12_substring_dedup": op12_substring_dedup,
    "op13_whitening": op13_whitening,
    "pipeline": pipeline,
}
ORACLE_SQL: dict[str, str] = {"op3_warc": OP3_SQL, "op11_collocations": OP11_SQL, "op12_substring_dedup": OP12_SQL}


if corpus_pipeline.ORACLE_SQL is not None:
    ORACLE_SQL["pipeline"] = corpus_pipeline.ORACLE_SQL


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
