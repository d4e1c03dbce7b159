"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from . import queries_runs, queries_store


def _split(key: str) -> str:
    u = f"(('0x' || substr(sha256('42:' || {key}), 1, 12))::bigint / 281474976710656.0)"
    return f"CASE WHEN {u} < 0.8 THEN 'train' WHEN {u} < 0.8 + 0.1 THEN 'val' ELSE 'test' END"


_LABELLED = "SELECT doc_id, lang, source, n_chars, CASE WHEN doc_id % 70 = 0 THEN '' WHEN doc_id % 50 = 0 THEN '<image>' || text ELSE text END AS text FROM documents"
_VIEW = f"""l AS ({_LABELLED}),
r AS (SELECT 'r' || doc_id AS rid, source, lang, 'd' || (doc_id // 4) AS did, CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 'img/' || doc_id || '.jpg' ELSE 'a' || doc_id END AS path,
 CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN n_chars + 1 END AS w, CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 100 END AS h, text FROM l WHERE source IN ('src0','src1','src2','src3') AND lang IN ('en','fr')),
k AS (SELECT did FROM (SELECT DISTINCT did FROM r) ORDER BY sha256('7:' || did) LIMIT 60),
p AS (SELECT *, CASE WHEN text = '' THEN 'empty_label' WHEN contains(text, '<image>') OR contains(text, '<video>') THEN 'reserved_media_token_label' WHEN w IS NULL THEN 'invalid_dimensions'
 WHEN greatest(w::double / h, h::double / w) > 60 THEN 'aspect_ratio' END AS problem FROM r WHERE NOT (source = 'src3' AND lang = 'fr'))"""
_BOX = "b AS (SELECT p_partkey, p_size::double AS x0, p_size::double / 2 AS x1, p_size + 100.5 AS x2, p_retailprice / 2 AS x3, p_brand AS label, (p_partkey % 4) * 90 AS rotation FROM part)"
_GRID = ", ".join(f"least(greatest(floor(x{k} * 1000 / {s}), 0), 1000)::int AS g{k}" for k, s in enumerate((800, 1000, 800, 1000)))
_TURN = "CASE rotation WHEN 90 THEN 'right' WHEN 180 THEN 'down' WHEN 270 THEN 'left' ELSE 'up' END"


def _line(points: list[tuple[float, float]], step: str = "step") -> str:
    out = f"CASE WHEN {step} <= {points[0][0]} THEN {points[0][1]}"
    for (a, x), (b, y) in zip(points, points[1:], strict=False):
        out += f" WHEN {step} < {b} THEN {x} + ({step} - {a}) / {float(b - a)} * ({y} - {x})"
    return f"{out} ELSE {points[-1][1]} END"


_CLEAN = r"""c AS (SELECT doc_id, source, replace(replace(regexp_replace(regexp_replace(replace(replace(replace(replace(dirty, '<|ln|>', ''), '<|pn|>', ''), '<|sn|>', ''), '<<<change_line_token_wrap>>>', ''),
 '\\\(\s*(.*?)\s*\\\)', '$\1$', 'gs'), '\\\$\s*(.*?)\s*\\\$', '$\1$', 'gs'), '\(', ''), '\)', '') AS x FROM d), k AS (SELECT doc_id, source, regexp_replace(x, '^\s+|\s+$', '', 'g') AS clean FROM c)"""
_DISPLAY = r"'^\s*(?:\\\[(.*?)\\\]|\$\$(.*?)\$\$)\s*$'"

ORACLE_SQL = {
    "view_build": f"""WITH {_VIEW} SELECT 'view:v1:' || substr(sha256(rid || 'text_default_v1'), 1, 16) AS id, rid AS canonical_record_id, path AS image_path, {_split("did")} AS split, text AS label,
 '<image>' || chr(10) || 'Text Recognition:' AS ask, 2::int AS turns, 'plain_text_v1' AS target_format FROM p WHERE problem IS NULL AND did IN (SELECT did FROM k)""",
    "view_filter_counts": f"WITH {_VIEW} SELECT problem, count(*) AS n FROM p WHERE problem IS NOT NULL GROUP BY problem",
    "view_select_where": "SELECT d.doc_id, source AS source_name, lang FROM documents d LEFT JOIN labels l USING (doc_id) WHERE lang IN ('en','de') AND coalesce(toxic, 0) != 1 AND NOT (source = 'src1') AND NOT (source = 'src2' AND lang = 'de')",
    "sample_topk_hash": "SELECT source, doc_id, sample_rank FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY sha256('42:' || doc_id))::int AS sample_rank FROM documents) WHERE sample_rank <= 5",
    "sample_keys": "SELECT sample_key FROM (SELECT DISTINCT doc_id::varchar AS sample_key FROM documents) ORDER BY sha256('42:' || sample_key) LIMIT 100",
    "split_assign": f"SELECT doc_id, {_split('doc_id')} AS split FROM documents",
    "split_counts": f"SELECT s.split, count(d.split) AS n FROM (VALUES ('train'),('val'),('test')) s(split) LEFT JOIN (SELECT {_split('doc_id')} AS split FROM documents) d ON s.split = d.split GROUP BY s.split",
    "split_leakage": f"SELECT document_id, string_agg(split, ',' ORDER BY split) AS splits FROM (SELECT DISTINCT conv_id AS document_id, {_split(chr(40) + 'conv_id::varchar || chr(45) || turn::varchar' + chr(41))} AS split FROM conversations) GROUP BY document_id HAVING count(*) > 1",
    "label_filter_counts": f"SELECT CASE WHEN text = '' THEN 'empty_label' WHEN contains(text, '<image>') OR contains(text, '<video>') THEN 'reserved_media_token_label' ELSE 'kept' END AS problem, count(*) AS n FROM ({_LABELLED}) GROUP BY 1",
    "failure_stats": """WITH e AS (SELECT coalesce(event_type, 'unknown') AS event_type, coalesce(nullif(CASE WHEN user_id % 3 = 0 THEN '' ELSE (user_id % 5)::varchar END, ''), 'unknown') AS phase, CASE WHEN value > 50 THEN 'big' ELSE 'unknown' END AS size FROM events)
SELECT 'event_type' AS kind, event_type AS value, count(*) AS n FROM e GROUP BY event_type UNION ALL SELECT 'phase', phase, count(*) FROM e GROUP BY phase UNION ALL SELECT 'size', size, count(*) FROM e GROUP BY size""",
    "schema_sample_per_group": "SELECT doc_id, lang, source FROM (SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY doc_id) AS k FROM documents) WHERE k <= 3",
    "dedupe_keep_first": "SELECT min(doc_id) AS doc_id, sha256(text) AS digest FROM documents GROUP BY sha256(text)",
    "dedupe_last_wins": "SELECT max(doc_id) AS doc_id, arg_max(source, doc_id) AS source, sha256(text) AS digest FROM documents GROUP BY sha256(text)",
    "resume_anti_join": "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "asset_left_join_dims": "SELECT l_orderkey, l_linenumber, CASE WHEN p_size IS NULL OR p_size <= 0 OR l_quantity <= 0 THEN 'invalid_dimensions' WHEN greatest(l_quantity / p_size, p_size / l_quantity) > 3.0 THEN 'aspect_ratio' ELSE 'kept' END AS problem FROM lineitem LEFT JOIN part ON p_partkey = l_partkey",
    "chat_messages": "SELECT conv_id, count(*)::int AS n, string_agg(role || ':' || text, chr(10) ORDER BY turn, role, text) AS chat FROM conversations GROUP BY conv_id",
    "placeholder_count": "SELECT conv_id, sum((length(t) - length(replace(t, '<image>', ''))) // 7)::bigint AS n FROM (SELECT conv_id, CASE WHEN turn % 2 = 0 THEN '<image>' || text || '<image>' ELSE text END AS t FROM conversations) GROUP BY conv_id",
    "layout_serialize": f"WITH {_BOX}, g AS (SELECT *, {_GRID} FROM b) SELECT p_partkey, '<|box_start|>' || g0 || ' ' || g1 || ' ' || g2 || ' ' || g3 || '<|box_end|><|ref_start|>' || label || '<|ref_end|><|rotate_' || {_TURN} || '|>' AS box FROM g",
    "box_tokens_parse": f"WITH {_BOX}, g AS (SELECT *, {_GRID} FROM b) SELECT p_partkey, place, label, rotation::int AS rotation, round(g0 * 800 / 1000.0, 6)::double AS x0, round(g1 * 1000 / 1000.0, 6)::double AS x1, round(g2 * 800 / 1000.0, 6)::double AS x2, round(g3 * 1000 / 1000.0, 6)::double AS x3 FROM g, (VALUES (1), (2)) t(place)",
    "crop_boxes": f"""WITH {_BOX}, c AS (SELECT p_partkey, least(greatest(trunc(x0)::int, 0), 119) AS c0, least(greatest(trunc(x1)::int, 0), 299) AS c1, trunc(x2)::int AS a, trunc(x3)::int AS b FROM b)
SELECT p_partkey, c0, c1, least(greatest(a, c0 + 1), 120) AS c2, least(greatest(b, c1 + 1), 300) AS c3 FROM c""",
    "repetition_basic": r"""WITH t AS (SELECT doc_id, text, regexp_extract_all(text, '\\[A-Za-z]+|[A-Za-z]+|\d+(?:\.\d+)?|[\x{4e00}-\x{9fff}]|[^\s]') AS t FROM documents),
x AS (SELECT doc_id, unnest(t) AS w, generate_subscripts(t, 1) AS i FROM t), g AS (SELECT doc_id, w, i - row_number() OVER (PARTITION BY doc_id, w ORDER BY i) AS island FROM x),
r AS (SELECT doc_id, max(n) AS run FROM (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id, w, island) GROUP BY doc_id)
SELECT doc_id, len(t)::int AS tokens, length(text)::int AS chars, coalesce(run, 0)::int AS run FROM t LEFT JOIN r USING (doc_id)""",
    "table_cells": "SELECT r_name, string_agg('<fcel>' || n_name || '<ecel><fcel>' || n_nationkey || '<nl>', '' ORDER BY n_nationkey) AS cells FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name",
    "deploy_manifest": r"SELECT path FROM (SELECT regexp_extract(url, '://[^/]+/([^?#]*)', 1) AS path FROM pages UNION SELECT 'img/' || doc_id || '.jpg' FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)) WHERE path IS NOT NULL AND path != ''",
    "validator_violations": """SELECT doc_id, 'long_enough' AS rule FROM documents WHERE NOT coalesce(n_chars >= 500, false) UNION ALL SELECT doc_id, 'labelled' FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NULL
UNION ALL SELECT doc_id, 'english' FROM documents WHERE NOT coalesce(lang = 'en', false)""",
    "stable_ids": "SELECT page_id, 'page:' || translate(url, '/:', '__') || ':' || page_id AS id, substr(sha256(url), 1, 16) AS h FROM pages",
    "kd_schedule": f"SELECT step, round({_line([(0, 0.0), (50, 1.0), (100, 1.0), (150, 0.1)])}, 9)::double AS rate, round({_line([(10, 2.0), (60, 1.0), (160, 4.0)])}, 9)::double AS line FROM (SELECT p_partkey AS step FROM part)",
    "kd_cosine": "SELECT a.vec_id, round(1 - list_dot_product(a.embedding::double[], b.embedding::double[]) / sqrt(list_dot_product(a.embedding::double[], a.embedding::double[]) * list_dot_product(b.embedding::double[], b.embedding::double[])), 6) AS loss FROM embeddings a JOIN embeddings b ON b.vec_id - 1 = a.vec_id",
    "kd_topk_kl": """WITH x AS (SELECT a.vec_id, unnest(a.embedding)::double AS t, unnest(b.embedding)::double AS s, generate_subscripts(a.embedding, 1) AS i FROM embeddings a JOIN embeddings b ON b.vec_id - 1 = a.vec_id),
k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY t DESC, i DESC) AS r FROM x) WHERE r <= 5),
z AS (SELECT vec_id, ln(sum(exp(t))) AS zt, ln(sum(exp(s))) AS zs FROM k GROUP BY vec_id)
SELECT vec_id, round(sum(exp(t - zt) * ((t - zt) - (s - zs))), 6) AS kl FROM k JOIN z USING (vec_id) GROUP BY vec_id""",
    "metric_reduction": "SELECT event_type, round(avg(v)::double, 4) AS mean_of_sums, count(*) AS ranks FROM (SELECT user_id, event_type, sum(value::decimal(20,6)) AS v FROM events GROUP BY user_id, event_type) GROUP BY event_type",
    "windowed_events": "SELECT epoch(time_bucket(INTERVAL 1 HOUR, ts))::bigint AS start, event_type, count(*) AS n, round(sum(value::decimal(20,6))::double, 4) AS total FROM events GROUP BY 1, 2",
    "view_rlvr": f"""SELECT 'r' || doc_id AS canonical_record_id, 'normalized_levenshtein_v1' AS reward_profile_id, {_split("('r' || doc_id)")} AS split, text AS truth, CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 'img/' || doc_id || '.jpg' ELSE 'a' || doc_id END AS image FROM ({_LABELLED}) WHERE text != ''""",
    "view_validate": f"""WITH l AS ({_LABELLED}), v AS (SELECT doc_id, 'r' || doc_id AS rid, doc_id // 4 AS did, {_split("('r' || doc_id)")} AS split, 1 + (length(text) - length(replace(text, '<image>', ''))) // 7 AS unused, n_chars + 1 AS w FROM l WHERE text != ''),
x AS (SELECT did FROM v GROUP BY did HAVING count(DISTINCT split) > 1)
SELECT rid AS canonical_record_id, 'image_count' AS rule FROM v WHERE doc_id % 10 = 7 UNION ALL SELECT rid, 'image_path' FROM v WHERE doc_id % 10 = 7
UNION ALL SELECT rid, 'split_leak' FROM v WHERE did IN (SELECT did FROM x)
UNION ALL SELECT rid, 'image_missing' FROM v, (VALUES (1), (2)) t(k) WHERE doc_id % 10 = 7
UNION ALL SELECT rid, 'image_missing' FROM v WHERE doc_id % 10 != 7 AND doc_id NOT IN (SELECT doc_id FROM labels)
UNION ALL SELECT rid, 'aspect_ratio' FROM v WHERE doc_id % 10 != 7 AND doc_id IN (SELECT doc_id FROM labels) AND greatest(w / 100.0, 100.0 / w) >= 40""",
    "lineage_of_view": f"SELECT 'r' || doc_id AS record_id, CASE WHEN source != 'src5' THEN source END AS source_name, CASE WHEN source != 'src5' THEN 'd' || (doc_id // 4) END AS document_id FROM ({_LABELLED}) WHERE text != ''",
    "image_resolution": """WITH n AS (SELECT n_nationkey, replace(n_name, '_', 'x') || 'z' AS stem FROM nation)
SELECT stem AS sample_id, CASE WHEN n_nationkey % 2 = 0 THEN stem || '.webp' ELSE stem || '_a.png' END AS image FROM n UNION ALL
SELECT stem || '_2', CASE WHEN n_nationkey % 2 = 0 THEN stem || '_a.png' ELSE stem || '_b.jpg' END FROM n UNION ALL SELECT 'none', NULL""",
    "runtime_paths": "SELECT 'a' || doc_id AS asset_id, CASE WHEN (n_chars + 1) % 2 = 0 THEN '/img/' || doc_id || '.jpg' ELSE '/data/img/' || doc_id || '.jpg' END AS path FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)",
    "kd_hidden": """WITH x AS (SELECT a.vec_id, unnest(a.embedding)::double AS t, unnest(b.embedding)::double AS s, generate_subscripts(a.embedding, 1) AS i FROM embeddings a JOIN embeddings b ON b.vec_id - 1 = a.vec_id),
z AS (SELECT vec_id, ln(sum(exp(t))) AS zt, ln(sum(exp(s))) AS zs, sum((t - s) * (t - s)) / sum(t * t) AS mse FROM x GROUP BY vec_id),
k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY t DESC, i DESC) AS r FROM x) WHERE r <= 5)
SELECT vec_id, round(any_value(mse), 6) AS mse, round(sum(exp(t - zt) * ((t - zt) - (s - zs))), 6) AS kl FROM k JOIN z USING (vec_id) GROUP BY vec_id""",
    "masked_loss": "SELECT l_returnflag, round(sum(l_quantity * (l_linenumber % 2)) / greatest(sum(l_linenumber % 2), 1), 6)::double AS loss FROM lineitem GROUP BY l_returnflag",
    "media_token_round_trip": "SELECT conv_id, turn, CASE WHEN role = 'user' THEN 1 ELSE 0 END::int AS left, true AS same FROM conversations",
    "preview_and_extension": r"""SELECT page_id, CASE WHEN length(url) > 20 THEN substr(url, 1, 17) || '...' ELSE url END AS preview, coalesce(nullif(lower(regexp_extract(regexp_extract(url, '^([^?#]*)', 1), '(\.[A-Za-z0-9]+)$', 1)), ''), '.html') AS ext FROM pages""",
    "clean_labels": rf"""WITH d AS (SELECT doc_id, source, ' <|ln|>\( a+b \)' || text || '<|pn|>\(c\) \(' AS dirty FROM documents), {_CLEAN} SELECT doc_id, clean FROM k""",
    "classify_text": rf"""WITH d AS (SELECT doc_id, source, CASE WHEN doc_id % 10 = 1 THEN text || chr(10) || 'a' || chr(9) || 'b' || chr(10) || 'c' || chr(9) || 'd' ELSE text END AS dirty FROM documents), {_CLEAN},
l AS (SELECT *, list_filter(string_split_regex(clean, '\r\n|[\n\r]'), lambda t: trim(t) != '') AS lines, regexp_replace(regexp_replace(clean, '\\\((.*?)\\\)', '', 'g'), {_DISPLAY}, '', 'gs') AS rest FROM k),
m AS (SELECT *, list_sum(list_transform(lines, lambda t: length(t) - length(replace(t, chr(9), '')))) AS tabs, list_sum(list_transform(lines, lambda t: length(t) - length(replace(t, '|', '')))) AS bars FROM l)
SELECT CASE WHEN regexp_matches(source, '(?i)\b(table|tabular|tbl|cell|row|column|col)\b') OR regexp_matches(lower(clean), '<table|<tr|<td') OR (len(lines) >= 2 AND (tabs >= 2 OR bars >= 4)) THEN 'table'
 WHEN regexp_matches(clean, {_DISPLAY}, 's') OR (regexp_matches(clean, '\\[a-zA-Z]+|[_^{{}}]') AND len(regexp_extract_all(rest, '[A-Za-z]{{2,}}')) <= 2 AND len(regexp_extract_all(rest, '[\x{{4e00}}-\x{{9fff}}]')) = 0) THEN 'formula' ELSE 'text' END AS kind, count(*) AS n FROM m GROUP BY 1""",
    "table_html_roundtrip": """SELECT n_nationkey, '<fcel>' || n_name || '<fcel>a & b<lcel><nl><ucel><fcel>c<ecel><nl>' AS cells, '<table><tr><td rowspan="2">' || n_name || '</td><td colspan="2">a &amp; b</td></tr><tr><td>c</td><td></td></tr></table>' AS html FROM nation""",
} | queries_runs.ORACLE_SQL | queries_store.ORACLE_SQL
ORACLE_SQL["view_written"] = ORACLE_SQL["view_build"]
