"""The registered queries of the text operators, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerwright.llm import (
    bpe,
    decontaminate,
    exact_dedup,
    fingerprints,
    langid,
    licenses,
    merkle,
    quality,
    ranked,
    secrets,
    simhash,
    suffixes,
    warc,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function (spark, folder) -> DataFrame under its own name."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


@query()
def op3_quality_score(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality.score(docs, quality.train(docs, table(spark, folder, "labels")))


@query(
    """
    WITH normalised AS (
        SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS body
        FROM documents)
    SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           doc_id = min(doc_id) OVER same AS kept, sha256(body) AS text_sha256
    FROM normalised
    WINDOW same AS (PARTITION BY body)
    """
)
def op4_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.decide(table(spark, folder, "documents")).drop("row_key")


@query()
def op1_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.digest_spans(secrets.scan(table(spark, folder, "documents")))


@query()
def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return langid.predict(docs, langid.train(docs))


@query()
def op5_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents"))


@query()
def op6_simhash_components(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.components(table(spark, folder, "documents"))
    return found.select("doc_id", "fingerprint", "component_id")


@query()
def op7_repeated_bytes(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.report(table(spark, folder, "documents"))


#: Overlaps from every alignment with four equal words in a row, which each of them has, or with a whole
#: item of fewer words.
LEAKS_SQL = """
    WITH d AS (
        SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'),
                                   lambda x: x <> '') AS w
        FROM documents),
    b AS (
        SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'),
                                    lambda x: x <> '') AS w
        FROM benchmark),
    items AS (SELECT item_id, w, least(13, len(w)) AS size FROM b WHERE len(w) >= 1),
    sizes AS (SELECT DISTINCT least(4, len(w)) AS n FROM items),
    doc_runs AS (
        SELECT doc_id, i AS at, array_to_string(w[i:i + n - 1], ' ') AS run
        FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes)),
    item_runs AS (
        SELECT item_id, i AS at, array_to_string(w[i:i + n - 1], ' ') AS run
        FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
              FROM (SELECT *, least(4, len(w)) AS n FROM items))),
    shifts AS (
        SELECT DISTINCT doc_id, item_id, doc_runs.at - item_runs.at AS shift
        FROM doc_runs JOIN item_runs USING (run)),
    aligned AS (
        SELECT doc_id, item_id, size, len(items.w) AS item_size,
               [CASE WHEN d.w[j + shift] = items.w[j] THEN 1 ELSE 0 END
                FOR j IN range(greatest(1, 1 - shift), least(len(items.w), len(d.w) - shift) + 1)] AS e
        FROM shifts JOIN d USING (doc_id) JOIN items USING (item_id)),
    verified AS (
        SELECT doc_id, item_id, max(list_sum(e) / item_size) AS share
        FROM aligned
        WHERE len(e) >= size
          AND list_max([list_sum(e[s:s + size - 1]) FOR s IN range(1, len(e) - size + 2)])
              >= size - CASE WHEN size = 13 THEN 2 WHEN size >= 8 THEN 1 ELSE 0 END
        GROUP BY doc_id, item_id),
    found AS (
        SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS item_ids,
               max(share) AS best_share
        FROM verified GROUP BY doc_id)
"""


@query(
    LEAKS_SQL
    + """
    SELECT doc_id, n_items IS NOT NULL AS contaminated, coalesce(n_items, 0) AS n_items,
           coalesce(item_ids, '') AS item_ids, coalesce(best_share, 0.0)::DOUBLE AS best_share
    FROM documents LEFT JOIN found USING (doc_id)
    """
)
def op8_benchmark_leaks(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.report(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query(
    """
    WITH found AS (
        SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
               sha1(coalesce(html, '')) AS payload_digest
        FROM pages),
    newest AS (
        SELECT *, CASE WHEN payload_bytes >= 1000
                       THEN max(page_id) OVER (PARTITION BY payload_digest, payload_bytes >= 1000)
                       ELSE page_id END AS original
        FROM found)
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> original THEN original END AS refers_to
    FROM newest
    """
)
def op9_warc_revisits(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(table(spark, folder, "pages"))


@query()
def op10_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.digests(table(spark, folder, "documents"), path, public_tokenizers.PATTERN)


#: A level at a time: ``own`` climbs from every leaf, ``level`` holds all nodes. Bits of CRC-32 by shifting.
MERKLE_SQL = """
    WITH RECURSIVE d AS (
        SELECT doc_id, lang, text,
               [CASE WHEN v IS NULL THEN '-' ELSE strlen(v) || ':' || v END
                FOR v IN [doc_id::VARCHAR, source, lang, n_chars::VARCHAR]] AS fields,
               list_reduce(
                   list_concat([4294967295::BIGINT],
                               [ascii(c)::BIGINT FOR c IN string_split(doc_id::VARCHAR, '')]),
                   lambda crc, b: list_reduce(
                       list_concat([xor(crc, b)], range(8)),
                       lambda r, step: xor(r >> 1, 3988292384 * (r & 1)))) AS crc
        FROM documents),
    leaves AS (
        SELECT doc_id, lang,
               sha256(array_to_string(fields, '') || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
               CASE WHEN xor(crc, 4294967295) % 3 = 0 THEN
                   sha256(array_to_string(fields, '') || coalesce(strlen(text) || ':' || translate(text,
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-'))
               END AS offered,
               row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS pos,
               count(*) OVER (PARTITION BY lang) AS n
        FROM d),
    level AS (
        SELECT lang, 0 AS height, pos, n, leaf AS digest FROM leaves
        UNION ALL
        SELECT lang, height + 1, pos // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY pos))
        FROM level WHERE n > 1 GROUP BY lang, height, n, pos // 8),
    tops AS (
        SELECT lang, digest AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos,
               count(*) OVER () AS n
        FROM level WHERE n = 1),
    upper AS (
        SELECT 0 AS height, pos, n, subroot AS digest FROM tops
        UNION ALL
        SELECT height + 1, pos // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY pos))
        FROM upper WHERE n > 1 GROUP BY height, n, pos // 8),
    runs AS (
        SELECT lang, height, pos // 8 AS run, list(digest ORDER BY pos) AS digests FROM level WHERE n > 1
        GROUP BY lang, height, pos // 8),
    upper_runs AS (
        SELECT height, pos // 8 AS run, list(digest ORDER BY pos) AS digests FROM upper WHERE n > 1
        GROUP BY height, pos // 8),
    own AS (
        SELECT doc_id, lang, 0 AS height, pos, n, coalesce(offered, leaf) AS digest, '' AS proof FROM leaves
        UNION ALL
        SELECT doc_id, own.lang, own.height + 1, pos // 8, (n + 7) // 8,
               sha256(array_to_string(digests[:pos % 8], '') || digest || array_to_string(digests[pos % 8 + 2:], '')),
               proof || array_to_string(digests[:pos % 8], '') || array_to_string(digests[pos % 8 + 2:], '')
        FROM own JOIN runs
          ON runs.lang IS NOT DISTINCT FROM own.lang AND runs.height = own.height AND run = pos // 8
        WHERE n > 1),
    further AS (
        SELECT doc_id, subroot, 0 AS height, tops.pos, tops.n, digest, proof
        FROM own JOIN tops ON tops.lang IS NOT DISTINCT FROM own.lang
        WHERE own.n = 1
        UNION ALL
        SELECT doc_id, subroot, further.height + 1, pos // 8, (n + 7) // 8,
               sha256(array_to_string(digests[:pos % 8], '') || digest || array_to_string(digests[pos % 8 + 2:], '')),
               proof || array_to_string(digests[:pos % 8], '') || array_to_string(digests[pos % 8 + 2:], '')
        FROM further JOIN upper_runs ON upper_runs.height = further.height AND run = pos // 8
        WHERE n > 1)
    SELECT doc_id, leaf, subroot, upper.digest AS root, sha256(proof) AS proof_sha256,
           further.digest AS folded_root, further.digest = upper.digest AS verified
    FROM further JOIN leaves USING (doc_id) CROSS JOIN upper
    WHERE further.n = 1 AND upper.n = 1
"""


@query(MERKLE_SQL)
def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.tamper_check(table(spark, folder, "documents"))


@query()
def op12_document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    rows = fingerprints.against_next(table(spark, folder, "documents"))
    return fingerprints.with_near_counts(rows, F.col("doc_id") % 20 == 0)


@query(
    """
    WITH docs AS (
        SELECT doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
        FROM documents),
    items AS (
        SELECT item_id, unnest(regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
        FROM benchmark),
    corpus AS (SELECT count(*) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM docs WHERE len(terms) > 0),
    postings AS (
        SELECT doc_id, size, term, count(*) AS tf
        FROM (SELECT doc_id, len(terms) AS size, unnest(terms) AS term FROM docs) GROUP BY doc_id, size, term),
    weights AS (
        SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
        FROM postings CROSS JOIN corpus GROUP BY term, n_docs),
    impacts AS (
        SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * size * n_docs) // n_terms)))
               AS impact
        FROM postings JOIN weights USING (term) CROSS JOIN corpus),
    scores AS (
        SELECT item_id, doc_id, sum(impact)::BIGINT AS score
        FROM items JOIN impacts USING (term) GROUP BY item_id, doc_id HAVING sum(impact) > 0),
    ranked AS (
        SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank,
               doc_id, score
        FROM scores)
    SELECT * FROM ranked WHERE rank <= 20
    """
)
def op13_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked.top_documents(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
