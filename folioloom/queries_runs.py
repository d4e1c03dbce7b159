"""More queries: what views, exports and deployments do besides selecting, and the DuckDB SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import geometry, numeric, repetition, rewards
from .functions import text as T
from .functions.prompts import rendered
from .operators import deploy, lineage
from .operators import select as S
from .operators import tables as R
from .operators import views as V
from .plans import export as X
from .plans.view import ViewPlan, failures, shard_counts, view_rows
from .sources.files import first_existing


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _core(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    from .queries import _assets, _records

    return _records(spark, sf_dir), _assets(spark, sf_dir)


def _images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """path and content of an image of each toxic-labelled or clean document; its bytes are the text's."""
    d = _t(spark, sf_dir, "documents").join(_t(spark, sf_dir, "labels"), "doc_id", "left_semi")
    return d.where("n_chars > 1000").select(F.concat(F.lit("img/"), F.col("doc_id").cast("string"), F.lit(".jpg")).alias("path"), F.encode("text", "UTF-8").alias("content"))


EMBEDDED = ViewPlan.of({"name": "v3", "include": [{"task": "text"}], "image_policy": {"materialization": {"mode": "embedded"}}, "skip_failure": True, "split_policy": {"level": "record", "train_ratio": 0.8, "val_ratio": 0.1}})
#: One mapping instead of a list of samples, and sources that an empty list doesn't narrow.
SAMPLED = ViewPlan.of({"name": "v4", "include": [{"task": "text", "sources": []}], "sample": {"level": "document", "count": 40, "seed": 3, "sources": ["src1", "src2"]}, "exclude": [{"sources": [], "where": {"language": "de"}}], "split_policy": {"train_ratio": 0.8, "val_ratio": 0.1}})
SHARDED = ViewPlan.of({"name": "v5", "include": [{"task": "text"}], "shard_policy": {"rows_per_shard": 128}, "split_policy": {"level": "record", "train_ratio": 0.8, "val_ratio": 0.1}})


def view_embedded(spark, sf_dir):
    records, assets = _core(spark, sf_dir)
    v = view_rows(EMBEDDED, records, assets, _images(spark, sf_dir))
    return v.select("canonical_record_id", F.octet_length(F.col("images_bytes")[0]).alias("bytes"), "split")


def view_failures(spark, sf_dir):
    records, assets = _core(spark, sf_dir)
    out = failures(EMBEDDED, records, assets, _images(spark, sf_dir))
    return out.select("record_id", "phase", "task", "target_format", F.array_join("target_keys", ",").alias("target_keys"), F.length("target_preview").alias("preview"), "exception_type", "message")


def view_failure_stats(spark, sf_dir):
    records, assets = _core(spark, sf_dir)
    out = failures(EMBEDDED, records, assets, _images(spark, sf_dir))
    return R.failure_stats(out, ["phase", "task", "source_name", "exception_type"])


def view_one_sample(spark, sf_dir):
    return view_rows(SAMPLED, *_core(spark, sf_dir)).select("canonical_record_id", "source_name")


def view_shard_counts(spark, sf_dir):
    return shard_counts(SHARDED, view_rows(SHARDED, *_core(spark, sf_dir)))


def view_given_splits(spark, sf_dir):
    """Splits of labelled documents are given by their quality, the others' follow their hash."""
    d = _t(spark, sf_dir, "documents").select("doc_id", "source")
    given = _t(spark, sf_dir, "labels").select("doc_id", F.when(F.col("quality") == 1, "train").otherwise("test").alias("split"))
    return S.split_by_table(d, "doc_id", given, S.split_of(F.col("doc_id"), 42, 0.8, 0.1))


def fitted_boxes(spark, sf_dir):
    p = _t(spark, sf_dir, "part").select("p_partkey", F.array(F.lit(1.0), F.lit(2.0), F.col("p_size").cast("double"), F.col("p_size") + 10.5).alias("box"), (F.col("p_size") * 10).alias("w"), F.lit(240).alias("h"))
    for name, square in (("fit", True), ("stretch", False)):
        p = p.withColumn(name, geometry.moved_box(F.col("box"), geometry.fitted(F.col("w"), F.col("h"), 1036, square)))
    return p.select("p_partkey", *(F.round(F.col(n)[k], 6).alias(f"{n}{k}") for n in ("fit", "stretch") for k in range(4)))


def _tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Documents as a source: one page and one record each."""
    d = _t(spark, sf_dir, "documents").select(F.concat(F.lit("doc:"), F.col("doc_id").cast("string")).alias("document_id"), F.lpad(F.col("doc_id").cast("string"), 9, "0").alias("source_document_id"), F.col("source").alias("source_name"), F.when(F.col("lang") == "en", "text").otherwise("table").alias("task"))
    return {"documents": d, "pages": d, "regions": d.where("task = 'text'"), "records": d, "assets": d}


def export_report(spark, sf_dir):
    return X.report(X.with_tasks(X.limited(_tables(spark, sf_dir), 150), ["text"]))


def export_not_completed(spark, sf_dir):
    """Documents whose source id the store has are done, which are those with a label."""
    tables = _tables(spark, sf_dir)
    done = _t(spark, sf_dir, "labels").select(F.lpad(F.col("doc_id").cast("string"), 9, "0").alias("source_document_id"))
    left = X.of_documents(tables, R.not_done(tables["documents"], done, "source_document_id"))
    return X.report(left)


def _view(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .queries import RLVR

    return view_rows(RLVR, *_core(spark, sf_dir))


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "nation").select(F.concat(F.lit("views/v2/"), "n_name", F.lit(".parquet")).alias("path"))


def deploy_view(spark, sf_dir):
    return deploy.manifest(_files(spark, sf_dir), _view(spark, sf_dir))


def deploy_counts(spark, sf_dir):
    return deploy.manifest_counts(_files(spark, sf_dir), _view(spark, sf_dir))


def deploy_missing(spark, sf_dir):
    return deploy.missing(_view(spark, sf_dir), _images(spark, sf_dir), None)


def deploy_globs(spark, sf_dir):
    p = _t(spark, sf_dir, "pages").select("page_id", F.regexp_extract("url", r"://([^?#]*)", 1).alias("path"))
    return p.where(deploy.glob_kept(F.col("path"), ["*[02468]"], ["*.com/*", "en", "d?"])).select("page_id", "path")


def recent_files(spark, sf_dir):
    c = _t(spark, sf_dir, "customer").select(F.concat(F.lower("c_mktsegment"), F.lit("-"), F.col("c_nationkey").cast("string"), F.lit("."), F.col("c_custkey").cast("string")).alias("name"))
    return deploy.recent_logs(c, "7", "build")


def ranked_nodes(spark, sf_dir):
    n = _t(spark, sf_dir, "nation").select(F.col("n_name").alias("name"), "n_regionkey")
    return deploy.chosen_nodes(n, [r[0] for r in n.orderBy(F.desc("name")).limit(3).collect()])


def _checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tree over customers: each comes from the one of half its key."""
    key = F.col("c_custkey")
    return _t(spark, sf_dir, "customer").select(key.cast("string").alias("checkpoint_id"), F.when(key > 1, (key / 2).cast("long").cast("string")).alias("parent_id"))


def checkpoint_ancestors(spark, sf_dir):
    c = _checkpoints(spark, sf_dir)
    return lineage.ancestors(c, "100").select("id", "depth")


def checkpoint_descendants(spark, sf_dir):
    return lineage.descendants(_checkpoints(spark, sf_dir), "7").select("id", "depth")


def run_progress(spark, sf_dir):
    p = _t(spark, sf_dir, "part").select("p_partkey", lineage.progress(F.col("p_size"), F.lit(50), F.col("p_size") - 10).alias("x"))
    return p.select("p_partkey", *(F.round(f"x.{k}", 6).alias(k) for k in ("rate", "pct", "eta")))


def grpo_violations(spark, sf_dir):
    v = _view(spark, sf_dir).withColumn("data_source", F.when(F.col("split") == "val", "").otherwise(F.col("data_source")))
    files = _images(spark, sf_dir).select("path")
    return V.grpo_violations(v, files, "canonical_record_id")


def stage_violations(spark, sf_dir):
    """Rows of source src3 have two carriers, those of src4 no profile, and the folder of all is train."""
    v = _view(spark, sf_dir)
    src = F.col("source_name")
    v = v.withColumns({"images_bytes": F.when(src == "src3", F.array(F.lit("x").cast("binary"))), "reward_profile_id": F.when(src != "src4", F.col("reward_profile_id"))})
    bad = V.stage_violations(v, F.lit("train")).join(v.select("id", "canonical_record_id"), "id")
    return bad.select("canonical_record_id", "rule")


def first_rows_per_file(spark, sf_dir):
    c = _t(spark, sf_dir, "conversations")
    return V.first_rows(c, 3, F.col("role"), "conv_id", "turn").select("role", "conv_id", "turn")


def flagged_summary(spark, sf_dir):
    d = _t(spark, sf_dir, "documents")
    reasons = F.array_compact(F.array(F.when(F.col("n_chars") > 3000, "long"), F.when(F.col("lang") == "fr", "french")))
    return R.flagged_summary(d.select(reasons.alias("reasons")))


def total_losses(spark, sf_dir):
    p = _t(spark, sf_dir, "part").select(F.col("p_partkey").alias("step"), F.col("p_size").cast("double").alias("s"))
    raw = {"sft": F.col("s"), "logit": F.col("s") / 2, "hidden": F.col("s") * 3}
    weight = {"sft": numeric.schedule(F.col("step"), "constant", value=1.0), "logit": numeric.schedule(F.col("step"), "piecewise_linear", points=[(0, 0.0), (100, 1.0)]), "hidden": numeric.schedule(F.col("step"), "warmup_constant", warmup=50, start=0.0, peak=0.5)}
    out = p.select("step", numeric.total_loss(raw, weight).alias("x"))
    return out.select("step", *(F.round(f"x.{k}", 6).alias(k) for k in ("loss", "loss_logit_raw", "loss_logit_weighted", "lambda_hidden")))


def reduced_metrics(spark, sf_dir):
    e = _t(spark, sf_dir, "events").select("user_id", F.concat(F.when(F.col("value") > 50, "loss_").otherwise("rate_"), "event_type").alias("metric"), F.col("value").cast("decimal(20,6)").alias("value"))
    out = numeric.reduced_metrics(e.withColumn("run", F.lit("r")), ["run"], "user_id")
    return out.select("metric", F.round(F.col("value").cast("double"), 3).alias("value"))


def validation_loss(spark, sf_dir):
    e = _t(spark, sf_dir, "events").select("event_type", "user_id", F.col("value").alias("loss"))
    return numeric.validation_loss(e, ["event_type"], "user_id").select("event_type", F.round("loss", 4).alias("loss"))


def sql_rewards(spark, sf_dir):
    """Short turns against their roles, by the functions that are registered for SQL."""
    rewards.register(spark)
    c = _t(spark, sf_dir, "part").select("p_partkey", F.concat(F.lit(" "), "p_brand").alias("p"), F.col("p_type").alias("g"))
    return c.select("p_partkey", F.expr("round(normalized_similarity(p, g), 9)").alias("score"), F.expr("round(truth_reward(p, g), 9)").alias("reward"))


def different_targets(spark, sf_dir):
    c = _t(spark, sf_dir, "conversations")
    roles = F.transform(F.array_sort(F.collect_list(F.struct("turn", "role"))), lambda x: x["role"])
    return c.groupBy("conv_id").agg(F.array_join(T.ordered_unique(roles), ",").alias("roles"), F.array_join(T.as_list(F.min("role"), "string"), ",").alias("first"))


def first_positive_side(spark, sf_dir):
    p = _t(spark, sf_dir, "part")
    return p.select("p_partkey", T.first_positive(F.when(F.col("p_size") > 25, F.lit(0)).otherwise(F.lit(None)), F.col("p_size").cast("string"), F.lit("7.9")).alias("side"))


def image_candidates(spark, sf_dir):
    p = _t(spark, sf_dir, "pages").select("page_id", F.array(F.concat(F.lit("img/"), F.col("page_id").cast("string"), F.lit(".png")), F.concat(F.lit("img/"), F.col("page_id").cast("string"), F.lit(".jpg"))).alias("names"))
    return first_existing(p, "names", _images(spark, sf_dir)).select("page_id", "path")


def prompts(spark, sf_dir):
    d = _t(spark, sf_dir, "documents").select("doc_id", F.lit("text").alias("task"), F.col("source").alias("source_name"), F.when(F.col("lang") != "fr", F.col("lang")).alias("category"))
    return d.select("doc_id", rendered(F.lit("{{ image_placeholder }}\n{{ task }} of {{source_name}} ({{ category }})")).alias("prompt"))


def broken_links(spark, sf_dir):
    """Rows of a view whose record the store has no more."""
    records, _ = _core(spark, sf_dir)
    left = records.where(F.col("source_name") != "src5")
    v = _view(spark, sf_dir).select("canonical_record_id")
    return R.broken_links(v, left, v.canonical_record_id == left.record_id)


def lineage_trace(spark, sf_dir):
    """Rows of a view with their record and document."""
    records, _ = _core(spark, sf_dir)
    docs = records.select("document_id", F.concat(F.lit("/data/"), "document_id").alias("document_path")).distinct()
    return V.trace(_view(spark, sf_dir), records, docs).select("record_id", "source_name", "document_path", "split")


def nested_content(spark, sf_dir):
    """The texts of documents, nested in JSON with their sources."""
    from .functions.content import nested_text

    d = _t(spark, sf_dir, "documents")
    raw = F.to_json(F.struct(F.array(F.struct(F.lit("x").alias("other")), F.struct(F.lit("y").alias("other"))).alias("kids"), F.col("source").alias("content"), F.struct(F.col("text").alias("content")).alias("more")))
    return d.select("doc_id", nested_text(raw).alias("text"))


def repetition_report(spark, sf_dir):
    """Whole texts that loop, worst first."""
    out = repetition.analysed(_t(spark, sf_dir, "documents").select("doc_id", "text")).where(F.size("reasons") > 0)
    return out.select("doc_id", F.col("ngram.span").alias("span"), "same_token_run", F.array_join("reasons", ";").alias("reasons")).orderBy(F.desc("span"), F.desc("same_token_run"), "doc_id")


_ALL = (view_embedded, view_failures, view_failure_stats, view_one_sample, view_shard_counts, view_given_splits, fitted_boxes, export_report, export_not_completed, deploy_view, deploy_counts, deploy_missing, deploy_globs, recent_files, ranked_nodes, checkpoint_ancestors, checkpoint_descendants, run_progress, grpo_violations, stage_violations, first_rows_per_file, flagged_summary, total_losses, reduced_metrics, validation_loss, sql_rewards, different_targets, first_positive_side, image_candidates, prompts, broken_links, lineage_trace, nested_content, repetition_report)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in _ALL}


def _split(key: str) -> str:
    u = f"(('0x' || substr(sha256('42:' || {key}), 1, 12))::bigint / 281474976710656.0)"
    return f"CASE WHEN {u} < 0.8 THEN 'train' WHEN {u} < 0.8 + 0.1 THEN 'val' ELSE 'test' END"


_IN = "doc_id IN (SELECT doc_id FROM labels)"
_LABELLED = "SELECT doc_id, lang, source, n_chars, CASE WHEN doc_id % 70 = 0 THEN '' WHEN doc_id % 50 = 0 THEN '<image>' || text ELSE text END AS text, text AS whole FROM documents"
#: Records whose label a view takes, and what is known of their image.
_ROWS = f"v AS (SELECT doc_id, 'r' || doc_id AS rid, 'd' || (doc_id // 4) AS did, source, lang, text, whole, CASE WHEN {_IN} THEN 'img/' || doc_id || '.jpg' ELSE 'a' || doc_id END AS path, {_IN} AND n_chars > 1000 AS there, {_split(chr(40) + 'chr(114) || doc_id' + chr(41))} AS split FROM ({_LABELLED}) WHERE text != '')"
_SFT = f"{_ROWS}, s AS (SELECT * FROM v WHERE NOT contains(text, '<image>') AND NOT contains(text, '<video>'))"
_REPORT = "SELECT 'documents' AS name, count(*) AS n FROM d UNION ALL SELECT 'pages', count(*) FROM d UNION ALL SELECT 'regions', count(*) FROM d WHERE lang = 'en' UNION ALL SELECT 'assets', count(*) FROM d"
_GLOB = r"regexp_matches(path, '^.*[02468]$') OR len(list_filter(string_split(path, '/'), lambda p: regexp_matches(p, '^.*[02468]$'))) > 0"
_NOT = r"regexp_matches(path, '^.*\.com/.*$') OR len(list_filter(string_split(path, '/'), lambda p: p = 'en' OR regexp_matches(p, '^d.$'))) > 0"
_FIT = "(SELECT p_partkey, p_size, p_size * 10 AS w, 240 AS h, greatest(p_size * 10, 240) AS m FROM part)"

ORACLE_SQL = {
    "view_embedded": f"WITH {_SFT} SELECT rid AS canonical_record_id, strlen(whole)::int AS bytes, split FROM s WHERE there",
    "view_failures": f"WITH {_SFT} SELECT rid AS record_id, 'materialize' AS phase, 'text' AS task, 'plain_text_v1' AS target_format, 'text' AS target_keys, least(165, 5 + length(text))::int AS preview, 'ValueError' AS exception_type, 'can''t read the image of ' || rid AS message FROM s WHERE NOT there",
    "view_failure_stats": f"WITH {_SFT}, f AS (SELECT * FROM s WHERE NOT there) SELECT 'phase' AS kind, 'materialize' AS value, count(*) AS n FROM f UNION ALL SELECT 'task', 'text', count(*) FROM f UNION ALL SELECT 'exception_type', 'ValueError', count(*) FROM f UNION ALL SELECT 'source_name', source, count(*) FROM f GROUP BY source",
    "view_one_sample": f"WITH l AS ({_LABELLED}), k AS (SELECT did FROM (SELECT DISTINCT 'd' || (doc_id // 4) AS did FROM l WHERE source IN ('src1', 'src2')) ORDER BY sha256('3:' || did) LIMIT 40) SELECT 'r' || doc_id AS canonical_record_id, source AS source_name FROM l WHERE text != '' AND NOT contains(text, '<image>') AND NOT contains(text, '<video>') AND coalesce(lang != 'de', true) AND (source NOT IN ('src1', 'src2') OR 'd' || (doc_id // 4) IN (SELECT did FROM k))",
    "view_shard_counts": f"WITH {_SFT} SELECT split, count(*) AS n, ceil(count(*) / 128.0)::int AS shards FROM s GROUP BY split",
    "view_given_splits": f"SELECT d.doc_id, source, CASE WHEN l.doc_id IS NULL THEN {_split('d.doc_id')} WHEN quality = 1 THEN 'train' ELSE 'test' END AS split FROM documents d LEFT JOIN labels l USING (doc_id)",
    "fitted_boxes": f"""SELECT p_partkey, round(1.0 * (1036.0 / m) + (m - w) * (1036.0 / m) / 2, 6) AS fit0, round(2.0 * (1036.0 / m) + (m - h) * (1036.0 / m) / 2, 6) AS fit1, round(p_size * (1036.0 / m) + (m - w) * (1036.0 / m) / 2, 6) AS fit2, round((p_size + 10.5)::double * (1036.0 / m) + (m - h) * (1036.0 / m) / 2, 6) AS fit3,
 round(1.0 * (1036.0 / w), 6) AS stretch0, round(2.0 * (1036.0 / h), 6) AS stretch1, round(p_size * (1036.0 / w), 6) AS stretch2, round((p_size + 10.5)::double * (1036.0 / h), 6) AS stretch3 FROM {_FIT}""",
    "export_report": f"WITH d AS (SELECT * FROM documents ORDER BY lpad(doc_id::varchar, 9, '0') LIMIT 150) {_REPORT} UNION ALL SELECT 'records', count(*) FROM d WHERE lang = 'en' UNION ALL SELECT 'records/text', count(*) FROM d WHERE lang = 'en'",
    "export_not_completed": f"WITH d AS (SELECT * FROM documents WHERE NOT ({_IN})) {_REPORT} UNION ALL SELECT 'records', count(*) FROM d UNION ALL SELECT 'records/' || CASE WHEN lang = 'en' THEN 'text' ELSE 'table' END, count(*) FROM d GROUP BY lang = 'en'",
    "deploy_view": f"WITH {_ROWS} SELECT 'views/v2/' || n_name || '.parquet' AS path FROM nation UNION SELECT path FROM v",
    "deploy_counts": f"WITH {_ROWS} SELECT (SELECT count(*) FROM nation) AS view_files, (SELECT count(*) FROM v) AS image_references, (SELECT count(*) FROM nation) + (SELECT count(DISTINCT path) FROM v) AS unique_files",
    "deploy_missing": f"WITH {_ROWS} SELECT path FROM v WHERE NOT there",
    "deploy_globs": f"SELECT page_id, path FROM (SELECT page_id, regexp_extract(url, '://([^?#]*)', 1) AS path FROM pages) WHERE ({_GLOB}) OR NOT ({_NOT})",
    "recent_files": "SELECT name FROM (SELECT lower(c_mktsegment) || '-' || c_nationkey || '.' || c_custkey AS name FROM customer) WHERE contains(name, '-7.') AND starts_with(name, 'build') ORDER BY name DESC LIMIT 20",
    "ranked_nodes": "SELECT n_name AS name, (row_number() OVER (ORDER BY n_name DESC) - 1)::int AS rank, n_regionkey FROM nation ORDER BY n_name DESC LIMIT 3",
    "checkpoint_ancestors": "WITH RECURSIVE w AS (SELECT 100 AS id, 0 AS depth UNION ALL SELECT id // 2, depth + 1 FROM w WHERE id > 1) SELECT id::varchar AS id, depth FROM w",
    "checkpoint_descendants": "WITH RECURSIVE w AS (SELECT 7::bigint AS id, 0 AS depth UNION ALL SELECT c_custkey::bigint, depth + 1 FROM w JOIN customer ON c_custkey // 2 = id AND c_custkey > 1) SELECT id::varchar AS id, depth FROM w",
    "run_progress": "SELECT p_partkey, round(rate, 6) AS rate, round(p_size * 100.0 / 50, 6)::double AS pct, round(CASE WHEN rate > 0 THEN (50 - p_size) / rate END, 6) AS eta FROM (SELECT p_partkey, p_size, CASE WHEN p_size > 10 THEN p_size::double / (p_size - 10) END AS rate FROM part)",
    "grpo_violations": f"WITH {_ROWS} SELECT rid AS canonical_record_id, 'data_source' AS rule FROM v WHERE split = 'val' UNION ALL SELECT rid, 'image_missing' FROM v WHERE NOT there",
    "stage_violations": f"WITH {_ROWS} SELECT rid AS canonical_record_id, 'split_folder' AS rule FROM v WHERE split != 'train' UNION ALL SELECT rid, r FROM v, (VALUES ('image_carriers'), ('image_count')) t(r) WHERE source = 'src3' UNION ALL SELECT rid, 'reward_profile' FROM v WHERE source = 'src4'",
    "first_rows_per_file": "SELECT role, conv_id, turn FROM (SELECT *, row_number() OVER (PARTITION BY role ORDER BY conv_id, turn) AS k FROM conversations) WHERE k <= 3",
    "flagged_summary": "SELECT 'scanned' AS name, count(*) AS n FROM documents UNION ALL SELECT 'flagged', count(*) FROM documents WHERE n_chars > 3000 OR lang = 'fr' UNION ALL SELECT 'long', count(*) FROM documents WHERE n_chars > 3000 UNION ALL SELECT 'french', count(*) FROM documents WHERE lang = 'fr'",
    "total_losses": """WITH w AS (SELECT p_partkey AS step, p_size::double AS s, least(greatest(p_partkey / 100.0, 0), 1)::double AS l, CASE WHEN p_partkey < 50 THEN p_partkey / 50.0 * 0.5 ELSE 0.5 END::double AS h FROM part)
SELECT step, round(s + s / 2 * l + s * 3 * h, 6) AS loss, round(CASE WHEN l = 0 THEN 0 ELSE s / 2 END, 6) AS loss_logit_raw, round(s / 2 * l, 6) AS loss_logit_weighted, round(h, 6) AS lambda_hidden FROM w""",
    "reduced_metrics": """WITH e AS (SELECT user_id, CASE WHEN value > 50 THEN 'loss_' ELSE 'rate_' END || event_type AS metric, value::decimal(20,6) AS value FROM events),
w AS (SELECT metric, user_id, sum(value) AS total FROM e GROUP BY metric, user_id), m AS (SELECT metric, avg(total) AS sums FROM w GROUP BY metric)
SELECT metric, round(CASE WHEN starts_with(metric, 'loss') THEN sums ELSE mean END::double, 3) AS value FROM m JOIN (SELECT metric, avg(value) AS mean FROM e GROUP BY metric) USING (metric)""",
    "validation_loss": "SELECT event_type, round(avg(m), 4) AS loss FROM (SELECT event_type, user_id, avg(value) AS m FROM events GROUP BY event_type, user_id) GROUP BY event_type",
    "sql_rewards": "SELECT p_partkey, round(greatest(0.0, 1.0 - levenshtein(p_brand, p_type)::double / greatest(length(p_brand), length(p_type), 1)), 9) AS score, round(1.0 - least(levenshtein(p_brand, p_type)::double / length(p_type), 1.0), 9) AS reward FROM part",
    "different_targets": "SELECT conv_id, string_agg(role, ',' ORDER BY first) AS roles, min(role) AS first FROM (SELECT conv_id, role, min(turn) AS first FROM conversations GROUP BY conv_id, role) GROUP BY conv_id",
    "first_positive_side": "SELECT p_partkey, CASE WHEN p_size > 0 THEN p_size ELSE 7 END::int AS side FROM part",
    "image_candidates": f"SELECT page_id, CASE WHEN page_id IN (SELECT doc_id FROM documents WHERE {_IN} AND n_chars > 1000) THEN 'img/' || page_id || '.jpg' ELSE 'img/' || page_id || '.png' END AS path FROM pages",
    "prompts": "SELECT doc_id, '<image>' || chr(10) || 'text of ' || coalesce(source, '') || ' (' || CASE WHEN lang != 'fr' THEN lang ELSE '' END || ')' AS prompt FROM documents",
    "broken_links": f"WITH {_ROWS} SELECT rid AS canonical_record_id FROM v WHERE source = 'src5'",
    "lineage_trace": f"WITH {_ROWS} SELECT rid AS record_id, source AS source_name, '/data/' || did AS document_path, split FROM v",
    "nested_content": "SELECT doc_id, source || chr(10) || text AS text FROM documents",
}
