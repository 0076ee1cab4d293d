"""One query for each operator, over its whole table, and SQL for the oracle where SQL can express it."""

from __future__ import annotations

from ..sources.tables import table
from . import ann, decontam, html, jaccard, licenses, mixing, quality, quotes, suffixes, warc


def op1_learned_partition_ann(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return ann.search(vectors, vectors.where("vec_id % 50 = 0"), k=5, parts=16, sample=4096)


def op2_winnow_decontamination(spark, sf_dir):
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_dictionary_warc(spark, sf_dir):
    return warc.round_trip(table(spark, sf_dir, "pages"), least=0)


def op4_ngram_jaccard_join(spark, sf_dir):
    return jaccard.components(table(spark, sf_dir, "documents"), k=4, num=85, den=100)


def op5_license_diagonals(spark, sf_dir):
    return licenses.labels(table(spark, sf_dir, "documents"))


def op6_pfair_mixing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.schedule(docs, power=0.7, block=16)


def op7_suffix_dedup(spark, sf_dir):
    return suffixes.digests(table(spark, sf_dir, "documents"), width=100)


def op8_html_tree_scoring(spark, sf_dir):
    return html.extract(table(spark, sf_dir, "pages"))


def op9_bradley_terry_quality(spark, sf_dir):
    return quality.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), at=0.3)


def op10_quotation_linking(spark, sf_dir):
    return quotes.conversations(table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (op1_learned_partition_ann, op2_winnow_decontamination, op3_dictionary_warc, op4_ngram_jaccard_join, op5_license_diagonals, op6_pfair_mixing, op7_suffix_dedup, op8_html_tree_scoring, op9_bradley_terry_quality, op10_quotation_linking)}

ORACLE_SQL = {
    "op2_winnow_decontamination": r"""
        WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
        b AS (SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
        bw AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS g
               FROM b, LATERAL (SELECT unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i) WHERE len(w) > 0),
        lens AS (SELECT DISTINCT n FROM bw),
        dw AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS g
               FROM d, lens, LATERAL (SELECT unnest(range(1, len(w) - n + 2)) AS i)),
        hit AS (SELECT doc_id, i, dw.n, item_id FROM dw JOIN bw USING (n, g)),
        cover AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
        items AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM hit) GROUP BY doc_id)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM d LEFT JOIN cover USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op3_dictionary_warc": """
        WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b, sha1(encode(coalesce(html, ''))) AS h FROM pages),
        g AS (SELECT h, max(page_id) AS original FROM p GROUP BY h)
        SELECT page_id, octet_length(b)::BIGINT AS payload_bytes,
               array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INT + 1, 1) FOR i IN range(32)], '') AS payload_digest,
               CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> original THEN original END AS refers_to
        FROM p JOIN g USING (h)""",
    "op4_ngram_jaccard_join": r"""
        WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
        s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + least(len(w), 4) - 1], chr(10)) AS g FROM w, LATERAL (SELECT unnest(range(1, len(w) - least(len(w), 4) + 2)) AS i) WHERE len(w) > 0),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both_n FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
        links AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * both_n >= 85 * (x.n + y.n - both_n)),
        both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
        reach(node, seen) AS (SELECT a, a FROM both_ways UNION SELECT b, seen FROM reach JOIN both_ways ON node = a)
        SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(least(doc_id, (SELECT min(seen) FROM reach WHERE node = doc_id)), doc_id) AS component_id FROM w LEFT JOIN n USING (doc_id)""",
    "op7_suffix_dedup": """
        WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
        p AS (SELECT doc_id, unnest(list_transform(range(0, octet_length(b) - 99), lambda i: {'i': i, 'm': md5(array_slice(b, i + 1, i + 100))})) AS x FROM d WHERE octet_length(b) >= 100),
        k AS (SELECT doc_id, x.i AS i, row_number() OVER (PARTITION BY x.m ORDER BY doc_id, x.i) > 1 AS later FROM p),
        r AS (SELECT doc_id, i, i - 100 > lag(i) OVER (PARTITION BY doc_id ORDER BY i) OR lag(i) OVER (PARTITION BY doc_id ORDER BY i) IS NULL AS fresh FROM k WHERE later),
        g AS (SELECT doc_id, i, sum(fresh::INT) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM r),
        spans AS (SELECT doc_id, run, min(i) AS lo, max(i) + 100 AS hi, lag(max(i) + 100, 1, 0) OVER (PARTITION BY doc_id ORDER BY run) AS before FROM g GROUP BY doc_id, run),
        parts AS (SELECT doc_id, run, hex(array_slice(b, before + 1, lo)) AS part FROM spans JOIN d USING (doc_id)
            UNION ALL SELECT doc_id, 1000000000 AS run, hex(array_slice(b, max(hi) + 1, octet_length(b))) FROM spans JOIN d USING (doc_id) GROUP BY doc_id, b),
        kept AS (SELECT doc_id, string_agg(part, '' ORDER BY run) AS h FROM parts GROUP BY doc_id),
        n AS (SELECT doc_id, sum(hi - lo) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
        SELECT doc_id, octet_length(b)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(coalesce(unhex(kept.h), b)) AS kept_sha256
        FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN n USING (doc_id)""",
    "op6_pfair_mixing": """
        WITH RECURSIVE c AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
        w AS (SELECT source, (n + 15) // 16 AS blocks, pow(n::DOUBLE, 0.7) AS weight, row_number() OVER (ORDER BY coalesce(source, ''), source IS NULL) - 1 AS i FROM c),
        q AS (SELECT source, blocks, i, greatest(1, round(weight * 1073741824 / sum(weight) OVER ())::BIGINT) AS a FROM w),
        l AS (SELECT list(a ORDER BY i) AS a, sum(a)::BIGINT AS total, count(*) AS k FROM q),
        e AS (SELECT source, blocks, i, q.a, total, (blocks * total + q.a - 1) // q.a AS stop FROM q, l),
        h AS (SELECT coalesce(((SELECT stop FROM e ORDER BY stop DESC, i LIMIT 1 OFFSET 1) + 255) // 256 * 256, 0) AS slots),
        edf(t, done, pick) AS (
            SELECT -1::BIGINT, list_transform(range(k), lambda x: 0::BIGINT), NULL::BIGINT FROM l
            UNION ALL
            SELECT t + 1, list_transform(done, lambda v, j: v + CASE WHEN j - 1 = p THEN 1 ELSE 0 END), p FROM (
                SELECT t, done, list_sort(list_filter(list_transform(range(l.k), lambda y: CASE WHEN (done[y + 1] * l.total) // l.a[y + 1] <= t + 1 THEN {'d': ((done[y + 1] + 1) * l.total + l.a[y + 1] - 1) // l.a[y + 1], 'i': y} END), lambda y: y IS NOT NULL))[1].i AS p
                FROM edf, l, h WHERE t + 1 < h.slots)),
        s AS (SELECT t AS slot, pick AS i, row_number() OVER (PARTITION BY pick ORDER BY t) - 1 AS block_no FROM edf WHERE t >= 0),
        n AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY sha256(coalesce(doc_id::VARCHAR, '')), doc_id) - 1 AS no FROM documents),
        d AS (SELECT n.doc_id, n.source, no // 16 AS block_no, (no % 16)::INT AS place, e.i, (no // 16 * total) // a AS release, ((no // 16 + 1) * total + a - 1) // a AS due FROM n JOIN e ON n.source IS NOT DISTINCT FROM e.source),
        b AS (SELECT doc_id, source, block_no, place, coalesce(slot, due - 1) AS slot, release, due FROM d LEFT JOIN s USING (i, block_no))
        SELECT doc_id, source, block_no, place, slot, dense_rank() OVER (ORDER BY slot) - 1 AS position, release, due FROM b""",
}
