"""Queries of the llm operators, over the whole tables and with the parameters of production."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkmill.llm import budget, cross_split, encoding, leaks, near_duplicates, pairs, pieces, pii, sampling, splits
from inkmill.llm.shared import table

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    t = table
    return {
        "p1_found": lambda s, d: near_duplicates.near_duplicate_pairs(t(s, d, "records")),
        "p1_groups": lambda s, d: near_duplicates.near_duplicate_groups(t(s, d, "records")),
        "p1_pair_counts": lambda s, d: near_duplicates.pair_counts(near_duplicates.near_duplicate_pairs(t(s, d, "records"))),
        "p2_found": lambda s, d: splits.related_records(t(s, d, "records"), t(s, d, "work_authors")),
        "p2_splits": lambda s, d: splits.assign_splits(t(s, d, "records"), t(s, d, "work_authors")),
        "p2_sizes": lambda s, d: splits.split_sizes(splits.assign_splits(t(s, d, "records"), t(s, d, "work_authors"))),
        "p3_found": lambda s, d: pairs.defective_pairs(t(s, d, "records")),
        "p3_counts": lambda s, d: pairs.defect_counts(t(s, d, "records")),
        "p3_empty": lambda s, d: pairs.wordless(t(s, d, "records")),
        "p4_found": lambda s, d: sampling.short_cells(t(s, d, "records"), t(s, d, "targets")),
        "p4_report": lambda s, d: sampling.sample_report(t(s, d, "records"), t(s, d, "targets")),
        "p4_sample": lambda s, d: sampling.stratified_sample(t(s, d, "records"), t(s, d, "targets")),
        "p4_sizes": lambda s, d: sampling.stratified_sample(t(s, d, "records"), t(s, d, "targets")).agg(F.count("*").alias("rows"), F.count_distinct("id").alias("ids")),
        "p5_texts": lambda s, d: budget.token_budget(t(s, d, "records"), t(s, d, "documents")).groupBy("part", "source").agg(F.sum("texts").alias("texts")),
        "p5_budget": lambda s, d: budget.token_budget(t(s, d, "records"), t(s, d, "documents")),
        "p6_found": lambda s, d: cross_split.cross_split_pairs(t(s, d, "records"), t(s, d, "splits")).select("id_a", "id_b"),
        "p6_report": lambda s, d: cross_split.overlap_report(t(s, d, "records"), t(s, d, "splits")),
        "p7_found": lambda s, d: pieces.split_oversized(t(s, d, "records")).select("id").distinct(),
        "p7_pieces": lambda s, d: pieces.split_oversized(t(s, d, "records")),
        "p7_cover": lambda s, d: pieces.cover(pieces.split_oversized(t(s, d, "records")), t(s, d, "records")),
        "p8_counts": lambda s, d: encoding.encode_documents(t(s, d, "documents")).agg(F.count("*").alias("documents"), F.count_if(F.size("ids") == 0).alias("without_ids"), F.count_if(F.size("ids") > 0).alias("with_ids")),
        "p8_ids": lambda s, d: encoding.encode_documents(t(s, d, "documents")),
        "p9_found": lambda s, d: leaks.leaked_passages(t(s, d, "documents"), t(s, d, "eval_items")).select("doc_id", "item_id").distinct(),
        "p9_passages": lambda s, d: leaks.leaked_passages(t(s, d, "documents"), t(s, d, "eval_items")),
        "p9_report": lambda s, d: leaks.leak_report(t(s, d, "documents"), t(s, d, "eval_items")),
        "p10_found": lambda s, d: pii.find_personal_data(t(s, d, "documents"), t(s, d, "person_names")).select("doc_id", "pii_type", "start_pos"),
        "p10_redacted": lambda s, d: pii.redact_personal_data(t(s, d, "documents"), t(s, d, "person_names")),
    }


#: Labels and splits that DuckDB can recount from the tables.
_LABEL = "replace(lower(regexp_replace({c}, '^\\s+|\\s+$', '', 'g')), '-', '_')"


def oracle_sql() -> dict[str, str]:
    top, sub = _LABEL.format(c="classification.top"), _LABEL.format(c="classification.sub")
    held = f"WITH ids AS (SELECT id, min(({top}, {sub})) AS c FROM records WHERE id IS NOT NULL GROUP BY id), s AS (SELECT count(*) // 5 AS size FROM ids), n AS (SELECT c[1] AS top, c[2] AS sub, count(*) AS held FROM ids GROUP BY 1, 2), g AS (SELECT t.top, t.sub, coalesce(n.held, 0) AS held, greatest(t.min_rows, (t.target_permille * s.size + 999) // 1000) AS wanted FROM targets t CROSS JOIN s LEFT JOIN n ON n.top = t.top AND n.sub = t.sub) "
    work = "lower(regexp_extract({c}, '(?i)(?:^|[^a-z0-9])(kt|mv|qo|zr|bx|wy)[-_: ]?0*([0-9]{{1,8}})', 1)) || '-' || lpad(regexp_extract({c}, '(?i)(?:^|[^a-z0-9])(kt|mv|qo|zr|bx|wy)[-_: ]?0*([0-9]{{1,8}})', 2), 8, '0')"
    rec_work = work.format(c="meta.original_id")
    words = "regexp_extract_all(lower({c}), '[\\p{{L}}\\p{{N}}]+')"
    near = f"""r AS (SELECT id, min(response) AS response FROM records WHERE id IS NOT NULL AND response IS NOT NULL GROUP BY id), w AS (SELECT id, {words.format(c="response")} AS ws FROM r),
        s AS (SELECT DISTINCT id, ws[k] || ' ' || ws[k + 1] || ' ' || ws[k + 2] AS g FROM w, unnest(range(1, len(ws) - 1)) AS u(k) WHERE len(ws) >= 60), n AS (SELECT id, count(*) AS c FROM s GROUP BY id),
        p AS (SELECT a.id AS id_a, b.id AS id_b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.id < b.id GROUP BY 1, 2),
        pairs AS (SELECT id_a, id_b FROM p JOIN n x ON x.id = id_a JOIN n y ON y.id = id_b WHERE p.c >= 0.5 * (x.c + y.c - p.c))"""
    gram = " || ' ' || ".join(f"ws[k + {i}]" for i in range(12))
    related = f"""wa AS (SELECT DISTINCT work_id AS work, CASE WHEN regexp_matches(author, '[0-9]+\\s*$') THEN regexp_extract(trim(author), '([0-9]+)\\s*$', 1) END AS author FROM work_authors),
            rw AS (SELECT id, min({rec_work}) AS work FROM records WHERE length({rec_work}) = 11 GROUP BY id),
            e AS (SELECT DISTINCT a.work AS x, b.work AS y FROM wa a JOIN wa b ON a.author = b.author),
            nodes AS (SELECT work FROM wa UNION SELECT work FROM rw),
            walk(x, y) AS (SELECT work, work FROM nodes UNION SELECT w.x, e.y FROM walk w JOIN e ON e.x = w.y),
            lab AS (SELECT x AS work, min(y) AS group_key FROM walk GROUP BY x)"""
    slug = "nullif(regexp_replace(trim(lower(regexp_replace({c}, '[\\s\\x{{a0}}]+', ' ', 'g'))), '[-_ ]+', '_', 'g'), '')"
    return {
        "p1_found": f"WITH {near} SELECT id_a, id_b FROM pairs",
        "p6_found": f"""WITH {near}, sp AS (SELECT id, min(lower(regexp_replace(split, '^\\s+|\\s+$', '', 'g'))) AS split FROM splits WHERE id IS NOT NULL AND split IS NOT NULL GROUP BY id)
            SELECT id_a, id_b FROM pairs JOIN sp x ON x.id = id_a JOIN sp y ON y.id = id_b WHERE (x.split = 'train') <> (y.split = 'train')""",
        "p9_found": f"""WITH d AS (SELECT doc_id, {words.format(c="text")} AS ws FROM documents WHERE text IS NOT NULL), i AS (SELECT item_id, {words.format(c="text")} AS ws FROM eval_items),
            gi AS (SELECT DISTINCT item_id, {gram} AS g FROM i, unnest(range(1, len(ws) - 10)) AS u(k)) SELECT DISTINCT doc_id, item_id FROM (SELECT doc_id, {gram} AS g FROM d, unnest(range(1, len(ws) - 10)) AS u(k)) JOIN gi USING (g)""",
        "p2_found": f"""WITH RECURSIVE {related}, g AS (SELECT rw.id, lab.group_key FROM rw JOIN lab ON lab.work = rw.work)
            SELECT id, group_key FROM g WHERE group_key IN (SELECT group_key FROM g GROUP BY 1 HAVING count(*) > 1)""",
        "p4_found": held + "SELECT top, sub FROM g WHERE held < wanted",
        "p7_found": "SELECT DISTINCT id FROM records WHERE id IS NOT NULL AND length(response) > 3000",
        "p1_pair_counts": f"WITH {near}, d AS (SELECT id_a AS id FROM pairs UNION ALL SELECT id_b FROM pairs) SELECT pairs, count(*) AS records FROM (SELECT id, count(*) AS pairs FROM d GROUP BY id) GROUP BY pairs",
        "p2_sizes": f"WITH RECURSIVE {related}, k AS (SELECT id, coalesce(lab.group_key, 'id:' || id) AS group_key FROM (SELECT DISTINCT id FROM records WHERE id IS NOT NULL) LEFT JOIN rw USING (id) LEFT JOIN lab ON lab.work = rw.work) SELECT group_key, count(*) AS records, 1 AS splits FROM k GROUP BY 1 HAVING count(*) > 1",
        "p3_empty": """SELECT DISTINCT id FROM records WHERE id IS NOT NULL AND prompt IS NOT NULL AND NOT regexp_matches(regexp_replace(coalesce(response, ''), '<[^<>]*>', ' ', 'g'), '[\\p{L}\\p{N}]')""",
        "p4_sizes": "WITH s AS (SELECT count(DISTINCT id) // 5 AS size FROM records WHERE id IS NOT NULL) SELECT size AS rows, size AS ids FROM s",
        "p5_texts": f"""WITH r AS (SELECT id, arg_min(source_dataset_name, ingested_at) AS source, arg_min(response, ingested_at) AS text FROM (SELECT id, coalesce(source_dataset_name, '') AS source_dataset_name, coalesce(response, '') AS response, ingested_at FROM records WHERE id IS NOT NULL) GROUP BY id),
            t AS (SELECT 'records' AS part, source, text FROM r UNION ALL SELECT 'documents', source, text FROM documents WHERE text IS NOT NULL)
            SELECT part, {slug.format(c="source")} AS source, count(*) AS texts FROM t WHERE regexp_matches(text, '[^\\s\\x{{a0}}]') GROUP BY 1, 2""",
        "p6_report": f"""WITH {near}, sp AS (SELECT id, min(lower(regexp_replace(split, '^\\s+|\\s+$', '', 'g'))) AS split FROM splits WHERE id IS NOT NULL AND split IS NOT NULL GROUP BY id),
            c AS (SELECT CASE WHEN x.split = 'train' THEN y.id ELSE x.id END AS id, CASE WHEN x.split = 'train' THEN y.split ELSE x.split END AS split FROM pairs JOIN sp x ON x.id = id_a JOIN sp y ON y.id = id_b WHERE (x.split = 'train') <> (y.split = 'train')),
            src AS (SELECT id, min({slug.format(c="source_dataset_name")}) AS source FROM records WHERE id IS NOT NULL GROUP BY id), cnt AS (SELECT id, split, count(*) AS pairs FROM c GROUP BY 1, 2)
            SELECT split, source, count(*) AS records, sum(pairs)::BIGINT AS pairs FROM cnt JOIN src USING (id) GROUP BY 1, 2""",
        "p7_cover": "WITH r AS (SELECT id, any_value(response) AS response FROM records WHERE id IS NOT NULL AND length(response) > 3000 GROUP BY id) SELECT id, length(response) AS covered, true AS within_limit, true AS texts_match FROM r",
        "p8_counts": "SELECT count(*) AS documents, count(*) FILTER (coalesce(text, '') = '') AS without_ids, count(*) FILTER (coalesce(text, '') <> '') AS with_ids FROM documents",
        "p9_report": f"""WITH d AS (SELECT doc_id, {words.format(c="text")} AS ws FROM documents WHERE text IS NOT NULL), i AS (SELECT item_id, {words.format(c="text")} AS ws FROM eval_items),
            gi AS (SELECT DISTINCT item_id, {gram} AS g FROM i, unnest(range(1, len(ws) - 10)) AS u(k)), f AS (SELECT doc_id, item_id, k FROM (SELECT doc_id, k, {gram} AS g FROM d, unnest(range(1, len(ws) - 10)) AS u(k)) JOIN gi USING (g)),
            runs AS (SELECT doc_id, item_id, count(*) + 11 AS n FROM (SELECT *, k - row_number() OVER (PARTITION BY doc_id, item_id ORDER BY k) AS run FROM (SELECT DISTINCT * FROM f)) GROUP BY doc_id, item_id, run)
            SELECT e.item_id, e.task, count(DISTINCT doc_id) AS documents, coalesce(max(n), 0) AS longest FROM eval_items e LEFT JOIN runs r ON r.item_id = e.item_id GROUP BY 1, 2""",
        "p9_passages": f"""WITH d AS (SELECT doc_id, text, {words.format(c="text")} AS ws FROM documents WHERE text IS NOT NULL), i AS (SELECT item_id, {words.format(c="text")} AS ws FROM eval_items),
            gi AS (SELECT DISTINCT item_id, {gram} AS g FROM i, unnest(range(1, len(ws) - 10)) AS u(k)), f AS (SELECT DISTINCT doc_id, item_id, k FROM (SELECT doc_id, k, {gram} AS g FROM d, unnest(range(1, len(ws) - 10)) AS u(k)) JOIN gi USING (g)),
            runs AS (SELECT doc_id, item_id, min(k) AS a, max(k) + 11 AS b FROM (SELECT *, k - row_number() OVER (PARTITION BY doc_id, item_id ORDER BY k) AS run FROM f) GROUP BY doc_id, item_id, run),
            gaps AS (SELECT doc_id, regexp_split_to_array(text, '[\\p{{L}}\\p{{N}}]+') AS gs, regexp_extract_all(text, '[\\p{{L}}\\p{{N}}]+') AS raw FROM d)
            SELECT doc_id, item_id, (list_sum(list_transform(gs[1:a], lambda x: length(x))) + coalesce(list_sum(list_transform(raw[1:a - 1], lambda x: length(x))), 0))::BIGINT AS start_pos,
            (list_sum(list_transform(gs[1:b], lambda x: length(x))) + list_sum(list_transform(raw[1:b], lambda x: length(x))))::BIGINT AS end_pos, b - a + 1 AS n_words FROM runs JOIN gaps USING (doc_id)""",
    }
