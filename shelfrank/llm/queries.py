"""Registered queries of the training-data operators and the same results as DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfrank.llm import exact, importance, jaccard, licenses, mixing, neighbours, packing, pii, quality, repair, substring, toxicity, warc

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality.classify(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op2_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.near_groups(_table(spark, folder, "documents")).drop("text_key")


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.classify(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op4_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(_table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op5_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.near_vectors(_table(spark, folder, "embeddings"))


def op6_warc_fixity(spark: SparkSession, folder: str) -> DataFrame:
    """The archive of all pages against a second store in which known records are lost, cut short or have a byte changed."""
    half = F.expr("substring(payload, 1, octet_length(payload) div 2)")
    rest = F.expr("substring(payload, octet_length(payload) div 2 + 2)")
    copy = (
        F.when(F.col("page_id") % 97 == 5, F.concat(half, F.encode(F.lit("#"), "UTF-8"), rest))
        .when(F.col("page_id") % 211 == 7, half)
        .when(F.col("page_id") % 307 == 11, F.lit(None))
        .otherwise(F.col("payload"))
    )
    return warc.fixity(_table(spark, folder, "pages"), copy)


def op7_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact.exact_groups(_table(spark, folder, "documents")).drop("text_key")


def op8_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring.repeated_passages(_table(spark, folder, "documents")).drop("row_no")


def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(_table(spark, folder, "documents")).drop("row_no", "copies", "parts")


def op10_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan_licenses(_table(spark, folder, "documents"))


def damaged(conversations: DataFrame) -> DataFrame:
    """Turns of which some are lost, emptied, cut short, said twice or given to the user, by a hash of conversation and turn.

    A null conversation or turn counts as one space in the hash; a null role or text is one space."""
    blank = F.lit(" ")
    fault = F.crc32(F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn")))) % 20
    role, text = F.coalesce("role", blank), F.coalesce("text", blank)
    return conversations.where(fault != 0).select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(role).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    conversations = _table(spark, folder, "conversations")
    return repair.digests(repair.repair(damaged(conversations), conversations))


def op12_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return pii.digests(pii.find_spans(docs, pii.fit(docs)))


def op13_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    drawn = importance.draw(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES: dict[str, Query] = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op3_toxicity": op3_toxicity,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_embedding_near_dedup": op5_embedding_near_dedup,
    "op6_warc_fixity": op6_warc_fixity,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_mixing": op9_mixing,
    "op10_license_scan": op10_license_scan,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_pii": op12_pii,
    "op13_importance_resampling": op13_importance_resampling,
}

ORACLES: dict[str, str] = {
    "op2_ngram_jaccard": r"""
        WITH RECURSIVE words AS (
          SELECT doc_id, regexp_extract_all(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x20\x09-\x0D]+') AS w FROM documents),
        shingles AS (
          SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []
              WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
              ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
          FROM words),
        sizes AS (SELECT doc_id, count(s) AS n FROM words LEFT JOIN shingles USING (doc_id) GROUP BY doc_id),
        common AS (
          SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
          FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
        links AS (
          SELECT x, y FROM common JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
          WHERE 100 * c >= 75 * (a.n + b.n - c)),
        both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
        reached AS (
          SELECT doc_id, doc_id AS other FROM sizes
          UNION SELECT r.doc_id, l.y FROM reached r JOIN both_ways l ON l.x = r.other)
        SELECT doc_id, n AS n_shingles, min(other) AS component_id, doc_id = min(other) AS kept
        FROM reached JOIN sizes USING (doc_id) GROUP BY doc_id, n
    """,
    "op6_warc_fixity": r"""
        WITH records AS (
          SELECT page_id, coalesce(url, '') AS url,
                 'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10)
                 || 'WARC-Record-ID: <urn:page:' || coalesce(page_id::VARCHAR, '') || '>' || chr(13) || chr(10)
                 || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10)
                 || 'Content-Type: text/html' || chr(13) || chr(10)
                 || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10)
                 || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) AS payload
          FROM pages),
        sized AS (
          SELECT page_id, url, strlen(payload)::BIGINT AS length, sha256(payload) AS sha256,
                 substr(md5(coalesce(page_id::VARCHAR, '') || ' ' || url), 1, 8) AS key,
                 encode(payload)[(strlen(payload) // 2 + 1):(strlen(payload) // 2 + 1)] AS middle
          FROM records),
        placed AS (
          SELECT *, (('0x' || key)::BIGINT
                     % greatest(1, ceil((SELECT sum(length) FROM sized) / 8388608.0)::BIGINT))::BIGINT AS segment
          FROM sized)
        SELECT page_id, segment,
               (sum(length) OVER (PARTITION BY segment ORDER BY page_id, url, sha256
                                  ROWS UNBOUNDED PRECEDING) - length)::BIGINT AS offset,
               length, sha256,
               CASE WHEN page_id % 97 = 5 THEN CASE WHEN middle = '#'::BLOB THEN 'ok' ELSE 'altered' END
                    WHEN page_id % 211 = 7 THEN 'altered'
                    WHEN page_id % 307 = 11 THEN 'missing' ELSE 'ok' END AS status
        FROM placed
    """,
    "op9_mixing": r"""
        WITH RECURSIVE sized AS (
          SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
          FROM documents),
        keyed AS (SELECT *, md5(concat('17:', coalesce(doc_id::VARCHAR, '-'), ':', size)) AS key FROM sized),
        sources AS (
          SELECT source, count(*) AS n, sum(size)::BIGINT AS words, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS i
          FROM sized GROUP BY source),
        filled AS (
          SELECT 0 AS step, i, words, [5, 2, 1][i % 3 + 1] AS w, false AS full_, 0.0::DOUBLE AS target FROM sources
          UNION ALL
          SELECT step + 1, i, words, w, full_ OR share > 2.0 * words,
                 CASE WHEN full_ OR share > 2.0 * words THEN 2.0::DOUBLE * words ELSE share END
          FROM (SELECT *, (1.5::DOUBLE * sum(words) OVER () - coalesce(sum(CASE WHEN full_ THEN 2.0::DOUBLE * words END) OVER (), 0))
                       * w / sum(CASE WHEN NOT full_ THEN w END) OVER () AS share
                FROM filled WHERE step <= (SELECT count(*) FROM sources))),
        goals AS (
          SELECT s.*, f.target, least(4096, ceil(n / 4096.0))::BIGINT AS n_shards
          FROM sources s JOIN filled f USING (i) WHERE step = (SELECT max(step) FROM filled)),
        seats AS (
          SELECT i, count(*) AS blocks FROM (
            SELECT i, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, i) AS place
            FROM (SELECT i, target, unnest(range(ceil(2 * words / 32.0)::BIGINT)) AS k FROM goals))
          WHERE place <= round_even((SELECT sum(target) FROM goals) / 32, 0) GROUP BY i),
        placed AS (
          SELECT k.*, g.i, g.words AS source_size, g.target, ('0x' || substr(key, 1, 8))::BIGINT % n_shards AS shard
          FROM keyed k JOIN goals g ON g.source IS NOT DISTINCT FROM k.source),
        shards AS (SELECT i, source, shard, sum(size)::BIGINT AS line FROM placed GROUP BY i, source, shard),
        quotas AS (
          SELECT i, shard, count(*) AS q FROM (
            SELECT i, shard, row_number() OVER (PARTITION BY i ORDER BY line::DOUBLE / (2 * k + 1) DESC, shard) AS place
            FROM (SELECT i, shard, line, unnest(range(ceil(2 * line / 32.0)::BIGINT)) AS k FROM shards)) JOIN seats USING (i)
          WHERE place <= blocks GROUP BY i, shard),
        chosen AS (
          SELECT i, shard, line, least(coalesce(q, 0) * 32, 2 * line) AS wanted,
                 CASE WHEN line = 0 THEN 0 ELSE
                   ('0x' || substr(md5(concat('17:', coalesce(source, 'None'), ':', shard)), 1, 12))::BIGINT
                   % ceil(line / 32.0)::BIGINT * 32 END AS start
          FROM shards LEFT JOIN quotas USING (i, shard)),
        spread AS (
          SELECT p.*, line, CASE WHEN line = 0 THEN 0 ELSE wanted // line END AS copies, start AS s,
                 start + CASE WHEN line = 0 THEN 0 ELSE wanted % line END AS e,
                 sum(size) OVER (PARTITION BY p.i, p.shard ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING)::BIGINT AS b
          FROM placed p JOIN chosen USING (i, shard))
        SELECT doc_id, size, source_size, target, source,
               (copies * size + greatest(0, least(b, e, line) - greatest(b - size, s))
                + greatest(0, least(b, e - line) - (b - size)))::BIGINT AS taken
        FROM spread
    """,
    "op7_exact_dedup": r"""
        WITH rows AS (
          SELECT doc_id, length(coalesce(text, '')) AS n,
                 sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS sha
          FROM documents)
        SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY sha) AS group_size,
               row_number() OVER best = 1 AS kept, sha AS text_sha256
        FROM rows WINDOW best AS (PARTITION BY sha ORDER BY n DESC, doc_id NULLS LAST)
    """,
    "op11_conversation_repair": r"""
        WITH RECURSIVE bytes AS (
          SELECT 0 AS step, b, b::BIGINT AS c FROM range(256) t(b)
          UNION ALL
          SELECT step + 1, b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bytes WHERE step < 8),
        crcs AS (SELECT list(c ORDER BY b) AS tab FROM bytes WHERE step = 8),
        hexes AS (
          SELECT *, hex(encode(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))) AS h FROM conversations),
        faults AS (
          SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                 xor(list_reduce(list_concat([4294967295::BIGINT],
                   list_transform(range(0, length(h) // 2), lambda i: ('0x' || substr(h, (2 * i + 1)::BIGINT, 2))::BIGINT)),
                   lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS fault
          FROM hexes, crcs),
        damaged AS (
          SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
                 CASE WHEN fault = 1 THEN '' WHEN fault = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
                 unnest(CASE WHEN fault = 3 THEN [0, 1] ELSE [0] END) AS copy
          FROM faults WHERE fault <> 0),
        placed AS (
          SELECT *, row_number() OVER same AS i, substr(role, 1, 1) AS initial,
                 lag(substr(role, 1, 1)) OVER same AS initial_before,
                 row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again
          FROM damaged WINDOW same AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(role || chr(0) || text), copy)),
        coded AS (
          SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN again THEN 'duplicate'
                         WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS kind
          FROM placed),
        counted AS (
          SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                 count(*) FILTER (kind = 'blank') AS blank, count(*) FILTER (kind = 'duplicate') AS duplicate,
                 count(*) FILTER (kind = 'truncated') AS truncated,
                 count(*) FILTER (initial_before || initial NOT IN ('su', 'ua', 'au')
                                  OR i > 1 AND (initial = '' OR initial_before = '')) AS illegal
          FROM coded GROUP BY conv_id),
        known AS (SELECT d.conv_id, coalesce(n, 0) AS n FROM (SELECT DISTINCT conv_id FROM conversations) d
                  LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM d.conv_id),
        inserts(q, p, c, a, line) AS (
          VALUES (0, 0, 0, '', NULL), (1, 1, 0, '', NULL), (2, 2, 0, '', NULL), (3, 3, 0, '', NULL),
                 (0, 2, 5, 'I', 'user:'), (1, 2, 5, 'I', 'user:'), (3, 2, 5, 'I', 'user:'), (2, 3, 5, 'I', 'assistant:')),
        edits(p, q, c, a, initial, role) AS (
          VALUES (0, 0, 2, 'D', NULL, NULL), (1, 1, 2, 'D', NULL, NULL), (2, 2, 2, 'D', NULL, NULL), (3, 3, 2, 'D', NULL, NULL),
                 (0, 1, 0, 'K', 's', NULL), (0, 2, 0, 'K', 'u', NULL), (1, 2, 0, 'K', 'u', NULL), (3, 2, 0, 'K', 'u', NULL),
                 (2, 3, 0, 'K', 'a', NULL), (0, 2, 1, 'R', NULL, 'user'), (1, 2, 1, 'R', NULL, 'user'),
                 (3, 2, 1, 'R', NULL, 'user'), (2, 3, 1, 'R', NULL, 'assistant')),
        tails(q, c, a, lines) AS (
          VALUES (0, 0, '', []), (3, 0, '', []), (2, 5, 'I', ['assistant:']), (1, 10, 'II', ['user:', 'assistant:'])),
        best AS (
          SELECT conv_id, n, 0::BIGINT AS i, 0 AS q, 0::BIGINT AS cost, '' AS audit, []::VARCHAR[] AS lines FROM known
          UNION ALL
          SELECT conv_id, n, i, q, cost, audit, lines FROM (
            SELECT b.conv_id, b.n, r.i, e.q,
                   b.cost + s.c + e.c + CASE WHEN e.a <> 'D' AND r.kind = 'truncated' THEN 5 ELSE 0 END AS cost,
                   b.audit || s.a || e.a AS audit,
                   list_concat(b.lines, CASE WHEN s.a = '' THEN [] ELSE [s.line] END,
                               CASE WHEN e.a = 'D' THEN [] ELSE [coalesce(e.role, r.role) || ':' || r.text] END) AS lines,
                   row_number() OVER (PARTITION BY b.conv_id, e.q
                     ORDER BY b.cost + s.c + e.c + CASE WHEN e.a <> 'D' AND r.kind = 'truncated' THEN 5 ELSE 0 END,
                              b.audit || s.a || e.a) AS place
            FROM best b JOIN coded r ON r.conv_id IS NOT DISTINCT FROM b.conv_id AND r.i = b.i + 1
            JOIN inserts s ON s.q = b.q
            JOIN edits e ON e.p = s.p AND (e.initial IS NULL OR e.initial = r.initial)
                        AND (e.a = 'D' OR r.kind NOT IN ('blank', 'duplicate')))
          WHERE place = 1),
        ended AS (
          SELECT b.conv_id, b.cost + t.c AS cost, b.audit || t.a AS audit, list_concat(b.lines, t.lines) AS lines,
                 row_number() OVER (PARTITION BY b.conv_id ORDER BY b.cost + t.c, b.audit || t.a) AS place
          FROM best b JOIN tails t USING (q) WHERE i = n)
        SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
               coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, cost::BIGINT AS cost, audit,
               sha256(array_to_string(lines, chr(10))) AS repaired_sha256
        FROM ended e LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM e.conv_id WHERE place = 1
    """,
    "op13_importance_resampling": r"""
        WITH RECURSIVE bytes AS (
          SELECT 0 AS step, b, b::BIGINT AS c FROM range(256) t(b)
          UNION ALL
          SELECT step + 1, b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bytes WHERE step < 8),
        crcs AS (SELECT list(c ORDER BY b) AS tab FROM bytes WHERE step = 8),
        texts AS (
          SELECT true AS own, row_number() OVER () AS row_no, doc_id, text FROM documents
          UNION ALL SELECT false, row_number() OVER (), NULL, text FROM benchmark),
        words AS (
          SELECT own, row_no, doc_id, regexp_extract_all(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
        features AS (
          SELECT own, row_no, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f
          FROM words),
        hexes AS (SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM features)),
        hashed AS (
          SELECT f, xor(list_reduce(list_concat([4294967295::BIGINT],
                     list_transform(range(0, length(h) // 2), lambda i: ('0x' || substr(h, (2 * i + 1)::BIGINT, 2))::BIGINT)),
                     lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
          FROM hexes, crcs),
        counted AS (
          SELECT bucket, count(*) FILTER (own) AS s, count(*) FILTER (NOT own) AS t
          FROM features JOIN hashed USING (f) GROUP BY bucket),
        gains AS (
          SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE
                   / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE)))::BIGINT AS gain
          FROM counted),
        weights AS (
          SELECT row_no, count(*) AS n, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
          FROM features JOIN hashed USING (f) JOIN gains USING (bucket) WHERE own GROUP BY row_no),
        scored AS (
          SELECT doc_id, coalesce(n, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight, len(w) >= 20 AS able,
                 (coalesce(weight, 0) + floor(-1000 * ln(-ln((
                   ('0x' || substr(sha256('7:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE))))::BIGINT AS score
          FROM words LEFT JOIN weights USING (row_no) WHERE own)
        SELECT doc_id, n_features, weight, score,
               CASE WHEN able AND place <= 25 * n // 100 THEN place END::BIGINT AS rank
        FROM (SELECT *, row_number() OVER (PARTITION BY able ORDER BY score DESC, doc_id NULLS LAST) AS place,
                     count(*) OVER (PARTITION BY able) AS n FROM scored)
    """,
}
