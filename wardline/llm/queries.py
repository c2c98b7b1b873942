"""The registered queries of the subpackage: thin digests of what the operators return."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm import align, bands, bottomk, bwt, decontaminate, filter_audit, hash_tree, html_blocks, packing, ranked, secrets, toxicity, warc
from wardline.llm.scratch import new_folder


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_warc_chunks(spark: SparkSession, folder: str) -> DataFrame:
    archive = new_folder(spark, "warc")
    warc.write_archive(warc.mark_revisits(_table(spark, folder, "pages")), archive)
    return warc.read_archive(spark, archive).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_compression_bands(spark: SparkSession, folder: str) -> DataFrame:
    return bands.assess(_table(spark, folder, "documents").select("doc_id", "text")).drop("text")


def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return decontaminate.digest(decontaminate.find(docs, _table(spark, folder, "benchmark")))


def op4_hash_tree(spark: SparkSession, folder: str) -> DataFrame:
    return hash_tree.shard(_table(spark, folder, "documents"), 8)


def op5_patience_lines(spark: SparkSession, folder: str) -> DataFrame:
    done = align.dedup(_table(spark, folder, "documents").select("doc_id", "text"))
    return done.select(
        F.col("row.doc_id").alias("doc_id"), "n_lines", F.size("removed").cast("long").alias("n_removed"),
        F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256"),
    )


def op6_counterfactual_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.train(docs, _table(spark, folder, "labels"))
    return toxicity.score(docs, model).select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op7_bottomk_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return bottomk.near_duplicates(_table(spark, folder, "documents"), words=3, percent=85)


def op8_columnwise_bwt(spark: SparkSession, folder: str) -> DataFrame:
    return bwt.remove_repeats(_table(spark, folder, "documents"), with_text=False).drop("kept_text")


def op9_secret_forest(spark: SparkSession, folder: str) -> DataFrame:
    judged = secrets.scan(_table(spark, folder, "documents"))
    return judged.select(F.col("id").alias("doc_id"), "nth", F.sha2("value", 256).alias("value_sha256"), "probability", "is_secret")


def op10_cutting_stock(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(_table(spark, folder, "documents"))


def op11_document_terms(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.audit(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op12_flat_blocks(spark: SparkSession, folder: str) -> DataFrame:
    return html_blocks.extract(_table(spark, folder, "pages").select("page_id", "url", "html"))


def op13_no_random_access(spark: SparkSession, folder: str) -> DataFrame:
    return ranked.rank(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_warc_chunks, op2_compression_bands, op3_decontamination, op4_hash_tree, op5_patience_lines, op6_counterfactual_toxicity,
        op7_bottomk_duplicates, op8_columnwise_bwt, op9_secret_forest, op10_cutting_stock, op11_document_terms, op12_flat_blocks,
        op13_no_random_access,
    )
}

_DIGEST = """
    array_to_string(list_transform(range(0, 32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1
        + 16 * CAST(substr(bits, 5 * j + 1, 1) AS BIGINT) + 8 * CAST(substr(bits, 5 * j + 2, 1) AS BIGINT)
        + 4 * CAST(substr(bits, 5 * j + 3, 1) AS BIGINT) + 2 * CAST(substr(bits, 5 * j + 4, 1) AS BIGINT)
        + CAST(substr(bits, 5 * j + 5, 1) AS BIGINT) AS BIGINT), 1)), '')"""

ORACLE: dict[str, str] = {
    "op1_warc_chunks": f"""
        WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
        g AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS h, max(page_id) OVER (PARTITION BY html) AS largest FROM p),
        b AS (SELECT *, array_to_string(list_transform(range(1, 41), lambda i: substr(
            '0000000100100011010001010110011110001001101010111100110111101111',
            CAST(4 * (strpos('0123456789abcdef', substr(h, i, 1)) - 1) + 1 AS BIGINT), 4)), '') AS bits FROM g)
        SELECT page_id, payload_bytes, {_DIGEST} AS payload_digest,
            CASE WHEN page_id = largest THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN page_id <> largest THEN largest END AS refers_to
        FROM b
    """,
    "op3_decontamination": r"""
        WITH low AS (SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        items AS (SELECT item_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
        sized AS (SELECT item_id, w, least(len(w), 10) AS k FROM items WHERE len(w) > 0),
        wins AS (SELECT DISTINCT item_id, k, array_to_string(w[i : i + k - 1], ' ') AS win
            FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM sized)),
        sizes AS (SELECT DISTINCT k FROM wins),
        dwins AS (SELECT doc_id, k, i, array_to_string(w[i : i + k - 1], ' ') AS win
            FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM low, sizes WHERE len(w) >= k)),
        hits AS (SELECT doc_id, item_id, i, k FROM dwins JOIN wins USING (k, win)),
        words AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM hits) GROUP BY doc_id),
        found AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
            string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM hits GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
            sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM low LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)
    """,
    "op7_bottomk_duplicates": r"""
        WITH RECURSIVE low AS (SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
        sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
            ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS grams FROM low),
        each AS (SELECT doc_id, unnest(grams) AS gram FROM sets),
        pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM each a JOIN each b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY ALL),
        links AS (SELECT a, b FROM pairs JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b
            WHERE 100 * n >= 85 * (len(x.grams) + len(y.grams) - n)),
        both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
        reach AS (SELECT doc_id, doc_id AS c FROM sets UNION SELECT b, c FROM reach JOIN both_ways ON a = doc_id),
        least AS (SELECT doc_id, min(c) AS component_id FROM reach GROUP BY doc_id)
        SELECT doc_id, CAST(len(grams) AS BIGINT) AS n_shingles, component_id, component_id = doc_id AS kept FROM sets JOIN least USING (doc_id)
    """,
    "op8_columnwise_bwt": r"""
        WITH bytes AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
        strings AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM (
            SELECT doc_id, h, unnest(range(0, len(h) // 2 - 49)) AS i FROM bytes WHERE len(h) >= 100)),
        hits AS (SELECT doc_id, i FROM strings JOIN (SELECT s, min(doc_id) AS first FROM strings GROUP BY s HAVING min(doc_id) < max(doc_id)) USING (s)
            WHERE doc_id > first),
        runs AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM (
            SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 50 THEN 0 ELSE 1 END AS new FROM hits)),
        spans AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM runs GROUP BY doc_id, run),
        gaps AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM spans),
        rest AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last,
            string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept FROM gaps JOIN bytes USING (doc_id) GROUP BY doc_id)
        SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
            CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
            sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
        FROM bytes LEFT JOIN rest USING (doc_id)
    """,
    "op11_document_terms": r"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS part FROM documents),
        w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY t) AS first FROM d),
        good AS (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY doc_id),
        f AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
                (CASE WHEN len(words) < 100 THEN 1 ELSE 0 END)
                + (CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 2 ELSE 0 END)
                + (CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 4 ELSE 0 END)
                + (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END)
                + (CASE WHEN w.doc_id > first THEN 16 ELSE 0 END) AS bits
            FROM w LEFT JOIN good ON good.doc_id = w.doc_id),
        c AS (SELECT part, bits, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f GROUP BY part, bits),
        letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS bit),
        orders AS (SELECT a.x || b.x || e.x || g.x || h.x AS filter_order, [a.bit, b.bit, e.bit, g.bit, h.bit] AS own
            FROM letters a, letters b, letters e, letters g, letters h
            WHERE a.bit + b.bit + e.bit + g.bit + h.bit = 31 AND (a.bit | b.bit | e.bit | g.bit | h.bit) = 31),
        steps AS (SELECT filter_order, CAST(s AS INTEGER) AS step, own[s] AS own, CAST(coalesce(list_sum(own[1 : s - 1]), 0) AS INTEGER) AS before
            FROM orders, range(1, 6) AS r(s)),
        parts AS (SELECT DISTINCT part FROM d),
        sums AS (SELECT part, filter_order, step, own,
                sum(CASE WHEN bits & (own | before) = 0 THEN n ELSE 0 END) AS kept,
                sum(CASE WHEN bits & own > 0 AND bits & before = 0 THEN n ELSE 0 END) AS removed,
                sum(CASE WHEN bits & own > 0 AND bits & before > 0 THEN n ELSE 0 END) AS redundant,
                sum(CASE WHEN bits = own THEN n ELSE 0 END) AS unique_fails,
                sum(CASE WHEN bits & own > 0 AND bits & before = 0 THEN good ELSE 0 END) AS good_lost,
                sum(CASE WHEN bits & own > 0 AND bits & before = 0 THEN toxic ELSE 0 END) AS toxic_lost
            FROM parts JOIN c USING (part), steps GROUP BY part, filter_order, step, own)
        SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
            CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
            CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
        FROM sums
    """,
    "op13_no_random_access": r"""
        WITH low AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        items AS (SELECT DISTINCT item_id, coalesce(text, '') AS body FROM benchmark),
        terms AS (SELECT item_id, body, term, count(*) AS repeats FROM (SELECT item_id, body, unnest(regexp_extract_all(
                translate(body, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term FROM items) GROUP BY ALL),
        totals AS (SELECT count(*) FILTER (len(w) > 0) AS big_n, CAST(sum(len(w)) AS BIGINT) AS big_l FROM low),
        times AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM low) WHERE term IN (SELECT term FROM terms) GROUP BY ALL),
        weights AS (SELECT term, CAST(floor(1000 * ln((2 * big_n + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM times, totals GROUP BY term, big_n),
        sizes AS (SELECT r, doc_id, 25 + (75 * len(w) * big_n) // big_l AS m FROM low, totals WHERE len(w) > 0),
        scored AS (SELECT item_id, body, r, CAST(sum(repeats * weight * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
            FROM terms JOIN times USING (term) JOIN weights USING (term) JOIN sizes USING (r) GROUP BY item_id, body, r),
        best AS (SELECT item_id, row_number() OVER (PARTITION BY item_id, body ORDER BY score DESC, doc_id) AS rank, doc_id, score
            FROM scored JOIN sizes USING (r) WHERE score > 0)
        SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM best WHERE rank <= 10
    """,
}
