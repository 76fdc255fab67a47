"""The registered queries: each operator over its whole table with production settings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import lm_scoring
from .common import table
from .exact_dedup import exact_dedup
from .fill_in_middle import fill_in_middle, restored
from .fingerprints import fingerprint_neighbours
from .line_dedup import line_dedup
from .minhash_forest import minhash_classes
from .mixing import mix
from .ngram_join import ngram_classes
from .packing import pack_documents
from .repeats import repeated_spans
from .revisits import captures_of_pages, resolve_revisits
from .source_divergence import source_divergence
from .tokens import public_file
from .toxicity import fit_on_labels, held_out, score


TOXIC_FROM = 0.3
#: Share of all tokens that the mixture draws.
MIX_KEEP = 0.8


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_on_labels(docs, table(spark, sf_dir, "labels"))
    scored = score(docs, model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"))


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_classes(table(spark, sf_dir, "documents"), n=3, num=90, den=100)


def op3_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return repeated_spans(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"), keep=MIX_KEEP).select("doc_id", "source", "lang", "topic", "n_tokens", "probability", "selected")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_file("byte_bpe_50k.json"))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_neighbours(table(spark, sf_dir, "documents"))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = lm_scoring.lm_scores(docs, public_file("byte_bpe_50k.json"), learn_from=~lm_scoring.held_out())
    return out.withColumn("held_out", lm_scoring.held_out())


def op10_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = resolve_revisits(captures_of_pages(table(spark, sf_dir, "pages")))
    lines = F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit(": "), e["value"])))
    return out.select("record_id", "response_id", "outcome", F.array_join(lines, "\n").alias("merged_headers"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = restored(fill_in_middle(table(spark, sf_dir, "documents")))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))


def op13_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_classes(table(spark, sf_dir, "documents"), n=4, num=80, den=100)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op3_repeats": op3_repeats,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_mixing": op5_mixing,
    "op6_line_dedup": op6_line_dedup,
    "op7_packing": op7_packing,
    "op8_fingerprints": op8_fingerprints,
    "op9_lm_scoring": op9_lm_scoring,
    "op10_revisits": op10_revisits,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_source_divergence": op12_source_divergence,
    "op13_minhash_dedup": op13_minhash_dedup,
}

ORACLES: dict[str, str] = {
    "op4_exact_dedup": r"""
        WITH n AS (
          SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
        )
        SELECT doc_id, min(doc_id) OVER (PARTITION BY norm) AS keep_id,
               count(*) OVER (PARTITION BY norm) AS group_size,
               doc_id = min(doc_id) OVER (PARTITION BY norm) AS kept, sha256(norm) AS text_sha256
        FROM n
    """,
    "op6_line_dedup": r"""
        WITH l AS (
          SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                 generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
          FROM documents
        ), k AS (
          SELECT doc_id, pos, line,
                 translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
          FROM l
        ), shared AS (
          SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20
          GROUP BY key HAVING count(DISTINCT doc_id) >= 3
        ), m AS (
          SELECT k.doc_id, k.pos, k.line, s.key IS NOT NULL AND k.doc_id <> s.keeper AS gone
          FROM k LEFT JOIN shared s ON k.key = s.key
        )
        SELECT doc_id, count(*) AS n_lines, sum(CASE WHEN gone THEN 1 ELSE 0 END)::BIGINT AS n_dropped,
               sha256(coalesce(string_agg(CASE WHEN NOT gone THEN line END, chr(10) ORDER BY pos), '')) AS kept_sha256
        FROM m GROUP BY doc_id
    """,
    "op10_revisits": r"""
        WITH u AS (
          SELECT page_id, html, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS rest FROM pages
        ), parts AS (
          SELECT page_id, html,
            regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(rest, '^([^/?]*)', 1)), '^.*@', ''), ':(80|443)$', ''), '^www\.', '') AS host,
            regexp_replace(regexp_extract(rest, '^[^/?]*([^?]*)', 1), '/+$', '') AS path,
            list_sort(list_filter(string_split(regexp_extract(rest, '\?(.*)$', 1), '&'), lambda p: p <> '' AND NOT
              regexp_matches(lower(p), '^(utm_[a-z]+|ref|sessionid|phpsessid|jsessionid|sid|fbclid|gclid)(=|$)'))) AS asked
          FROM u
        ), c AS (
          SELECT page_id, CASE WHEN len(asked) > 0 THEN host || path || '?' || array_to_string(asked, '&') ELSE host || path END AS page,
            page_id * 10 AS at, page_id * 10 + 5 + (page_id % 7) * 400 AS again,
            '"' || substr(md5(html), 1, 16) || '"' AS tag, 'day ' || (page_id % 97) AS lm, strlen(html) AS size
          FROM pages_in
        ), m AS (
          SELECT r.page_id, r.tag, r.lm, max(f.page_id) AS full_id
          FROM c r LEFT JOIN c f ON f.page = r.page AND f.at < r.again GROUP BY 1, 2, 3
        ), j AS (
          SELECT m.page_id, m.full_id, f.size, f.tag AS ftag, f.lm AS flm, m.tag, m.lm,
            CASE WHEN m.page_id % 11 = 0 THEN 'no_validator'
                 WHEN m.page_id % 5 = 0 THEN CASE WHEN m.lm = f.lm THEN 'resolved' ELSE 'mismatch' END
                 WHEN m.tag = f.tag THEN 'resolved' ELSE 'mismatch' END AS outcome
          FROM m JOIN c f ON f.page_id = m.full_id
        )
        SELECT page_id * 2 + 1 AS record_id, full_id * 2 AS response_id, outcome,
          CASE WHEN outcome = 'resolved' THEN
            'cache-control: max-age=' || (page_id % 13) || chr(10) || 'content-length: ' || size || chr(10) || 'content-type: text/html' || chr(10) ||
            'etag: ' || CASE WHEN page_id % 5 = 0 THEN ftag ELSE 'W/' || tag END || chr(10) || 'last-modified: ' || flm END AS merged_headers
        FROM j
    """.replace("pages_in", "parts"),
    "op11_fill_in_middle": r"""
        WITH t AS (
          SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
                 sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h
          FROM documents
        ), d AS (
          SELECT doc_id, text, u, len(u) AS n, ('0x' || h[1:8])::BIGINT % (len(u) + 1) AS one, ('0x' || h[9:16])::BIGINT % (len(u) + 1) AS two,
                 text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR ('0x' || h[17:24])::BIGINT % 100 >= 100 AS plain,
                 ('0x' || h[25:32])::BIGINT % 100 < 50 AS first
          FROM t
        ), p AS (
          SELECT *, array_to_string(u[1:least(one, two)], '') AS prefix, array_to_string(u[least(one, two) + 1:greatest(one, two)], '') AS middle,
                 array_to_string(u[greatest(one, two) + 1:], '') AS suffix
          FROM d
        )
        SELECT doc_id, n::BIGINT AS n, CASE WHEN plain THEN 'plain' WHEN first THEN 'spm' ELSE 'psm' END AS form,
               CASE WHEN NOT plain THEN length(prefix) END::BIGINT AS prefix_chars, CASE WHEN NOT plain THEN length(middle) END::BIGINT AS middle_chars,
               sha256(CASE WHEN plain THEN text WHEN first THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
                      ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256,
               sha256(text) AS restored_sha256
        FROM p
    """,
    "op12_source_divergence": r"""
        WITH d AS (
          SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                 regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
          FROM documents
        ), c AS (
          SELECT lang, source, term, sum(k) AS n, count(*) AS docs
          FROM (SELECT r, lang, source, term, count(*) AS k FROM (SELECT r, lang, source, unnest(w) AS term FROM d) GROUP BY ALL) GROUP BY ALL
        ), kept AS (SELECT lang, term, sum(n) AS n_lang FROM c GROUP BY ALL HAVING sum(docs) >= 30),
        langs AS (SELECT lang, count(*) AS v, sum(n_lang) AS n_all FROM kept GROUP BY lang),
        named AS (SELECT DISTINCT lang, source FROM d),
        full_table AS (
          SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.n_lang, l.v, l.n_all,
                 sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source) AS n_group
          FROM named g JOIN kept k ON k.lang = g.lang JOIN langs l ON l.lang = g.lang
          LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
        ), p AS (
          SELECT *, (1 + (1000000000::HUGEINT * (n + 5)::HUGEINT) // (n_group + 5 * v)::HUGEINT)::BIGINT AS p,
                 (1 + (1000000000::HUGEINT * (n_lang + 5)::HUGEINT) // (n_all + 5 * v)::HUGEINT)::BIGINT AS q
          FROM full_table
        ), pairs AS (
          SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
          FROM named a JOIN named b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value
                     FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) s
            ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
        ), best AS (
          SELECT lang, source, term AS item, p - q AS value, row_number() OVER (PARTITION BY lang, source ORDER BY p - q DESC, term) AS rank
          FROM p WHERE n > 0 AND p > q
        )
        SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INTEGER AS rank FROM pairs
        UNION ALL
        SELECT lang, source, 'term', item, value, rank::INTEGER FROM best WHERE rank <= 50
    """,
}
