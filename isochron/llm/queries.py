"""Registered queries of the text operators. Results that SQL can say have their DuckDB text in ``oracles``."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isochron.llm import (
    decontamination,
    divergence,
    fingerprints,
    html_text,
    jaccard,
    language,
    simhash,
    substring_dedup,
    suffix_dedup,
    warc,
    whitening,
)
from isochron.llm.packing import pack
from isochron.llm.token_counts import count_tokens

queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
oracles: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    queries[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived_pages(table(spark, sf_dir, "pages"))


oracles["op1_warc"] = """
WITH d AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
e AS (SELECT page_id, h, octet_length(encode(h)) AS payload_bytes, CAST(CAST(unhex(sha1(h)) AS BIT) AS VARCHAR) AS bits,
             min(page_id) OVER (PARTITION BY h) AS first FROM d)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + list_sum(list_transform(range(5), lambda j: CAST(substr(bits, CAST(5 * i + j + 1 AS BIGINT), 1) AS BIGINT)
             * (CAST(16 AS BIGINT) >> CAST(j AS INTEGER))))::BIGINT, 1)), '') AS payload_digest,
       CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first < page_id THEN first END AS refers_to
FROM e"""


@query
def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.without_repeated_bytes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


oracles["op2_suffix_array_dedup"] = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
s AS (SELECT doc_id, unnest(range(1, length(h) // 2 - 398)) AS i, h FROM d),
w AS (SELECT doc_id, i, md5_number(substr(h, 2 * i - 1, 800)) AS k FROM s),
r AS (SELECT k FROM w GROUP BY k HAVING count(*) > 1),
hit AS (SELECT doc_id, i, max(i) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p
        FROM w JOIN r USING (k)),
run AS (SELECT doc_id, i, sum(CASE WHEN p IS NULL OR i > p + 400 THEN 1 ELSE 0 END)
        OVER (PARTITION BY doc_id ORDER BY i) AS g FROM hit),
span AS (SELECT doc_id, min(i) AS a, max(i) + 400 AS b FROM run GROUP BY doc_id, g),
gap AS (SELECT doc_id, b, lead(a) OVER (PARTITION BY doc_id ORDER BY a) AS a2 FROM span),
first AS (SELECT doc_id, min(a) AS a, count(*) AS n_spans, sum(b - a) AS n_removed FROM span GROUP BY doc_id),
rest AS (SELECT doc_id, string_agg(substr(h, 2 * b - 1, CASE WHEN a2 IS NULL THEN length(h) ELSE 2 * (a2 - b) END), '' ORDER BY b) AS t
         FROM gap JOIN d USING (doc_id) GROUP BY doc_id)
SELECT d.doc_id, length(h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(CASE WHEN first.a IS NULL THEN h ELSE substr(h, 1, 2 * (first.a - 1)) || t END)) AS kept_sha256
FROM d LEFT JOIN first USING (doc_id) LEFT JOIN rest USING (doc_id)"""


@query
def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"), jaccard.Scheme(least=90, words=3))


oracles["op3_ngram_jaccard_join"] = """
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 3 THEN CASE WHEN len(w) = 0 THEN [] ELSE [array_to_string(w, ' ')] END
        ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * i >= 90 * (a.n + b.n - i)),
r AS (SELECT doc_id, doc_id AS o FROM d UNION SELECT r.doc_id, l.y FROM r JOIN l ON r.o = l.x)
SELECT r.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(o) AS component_id
FROM r LEFT JOIN n USING (doc_id) GROUP BY r.doc_id"""


@query
def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), least_words=1)


@query
def op5_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_likeness(table(spark, sf_dir, "documents"))


@query
def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.predict(docs, language.fit(docs))
    return found.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


@query
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


@query
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.without_earlier_passages(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))


oracles["op10_substring_dedup"] = """
WITH d AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
           FROM documents),
s AS (SELECT doc_id, unnest(list_transform(range(1, len(w) - 11),
        lambda i: {'i': i, 'k': md5_number(array_to_string(w[i:i + 12], ' '))}), recursive := true) FROM d),
f AS (SELECT k, min(doc_id) AS least FROM s GROUP BY k),
gone AS (SELECT DISTINCT doc_id, i + j AS p FROM s JOIN f USING (k), range(13) AS t(j) WHERE doc_id > least),
words AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS x FROM d),
kept AS (SELECT words.doc_id, string_agg(x, ' ' ORDER BY words.p) AS t
         FROM words ANTI JOIN gone ON words.doc_id = gone.doc_id AND words.p = gone.p GROUP BY words.doc_id),
n AS (SELECT doc_id, count(*) AS n_removed FROM gone GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN kept USING (doc_id)"""


@query
def op11_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


@query
def op13_source_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(table(spark, sf_dir, "documents"))


oracles["op13_source_divergence_audit"] = """
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY lang, source, term),
g AS (SELECT DISTINCT lang, source FROM d),
dense AS (SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n FROM g JOIN kept ON g.lang = kept.lang
          LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
p AS (SELECT lang, source, term, n, 1 + CAST((1000000000::HUGEINT * (n + 5))
        // (sum(n) OVER (PARTITION BY lang, source) + 5 * v) AS BIGINT) AS p FROM dense JOIN v USING (lang)),
q AS (SELECT lang, term, 1 + CAST((1000000000::HUGEINT * (sum(n) + 5))
        // (sum(sum(n)) OVER (PARTITION BY lang) + 5 * any_value(v)) AS BIGINT) AS q FROM dense JOIN v USING (lang) GROUP BY lang, term),
f AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
o AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(f.value, 0) AS BIGINT) AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
      UNION ALL SELECT p.lang, p.source, 'term', p.term, CAST(p.p - q.q AS BIGINT) FROM p JOIN q USING (lang, term) WHERE p.n > 0 AND p.p > q.q),
k AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM o)
SELECT lang, source, part, item, value, rank FROM k WHERE part = 'pair' OR rank <= 50"""
