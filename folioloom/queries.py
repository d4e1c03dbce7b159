"""Queries over the driver's tables, one for each operator family, with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import queries_runs, queries_store
from .functions import geometry, numeric, repetition, rewards, tables
from .functions import text as T
from .functions.ids import stable_hash, stable_id
from .operators import select as S
from .operators import tables as R
from .operators import views as V
from .plans.view import ViewPlan, filter_counts, view_rows
from .sources.files import resolved_images, under_root
from .streaming.incremental import windowed_counts


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as text records; every fiftieth holds a media token, every seventieth has no text."""
    text = F.when(F.col("doc_id") % 70 == 0, "").when(F.col("doc_id") % 50 == 0, F.concat(F.lit("<image>"), "text")).otherwise(F.col("text"))
    return _t(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars", text.alias("text"))


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _labelled(spark, sf_dir)
    key = F.col("doc_id").cast("string")
    target = F.struct(*(F.lit(None).cast(t).alias(n) for n, t in (("coordinate_space", "string"), ("elements", "array<struct<region_id:string,bbox:array<double>,label:string,rotation:int,reading_order:int>>"))), F.col("text"), *(F.lit(None).cast(t).alias(n) for n, t in (("html", "string"), ("otsl", "string"), ("enhanced_otsl", "string"), ("latex", "string"), ("display", "boolean"), ("raw", "string"))))
    return d.select(F.concat(F.lit("r"), key).alias("record_id"), F.lit("text").alias("task"), F.col("source").alias("source_name"), F.concat(F.lit("d"), (F.col("doc_id") / 4).cast("long").cast("string")).alias("document_id"), F.concat(F.lit("p"), key).alias("page_id"), F.lit(None).cast("string").alias("region_id"), F.concat(F.lit("a"), key).alias("image_asset_id"), target.alias("target"), F.lit(None).cast("string").alias("category"), F.col("lang").alias("language"), F.lit("{}").alias("metadata"))


def _assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _t(spark, sf_dir, "documents")
    key = F.col("doc_id").cast("string")
    return d.join(_t(spark, sf_dir, "labels"), "doc_id", "left_semi").select(F.concat(F.lit("a"), key).alias("asset_id"), F.concat(F.lit("img/"), key, F.lit(".jpg")).alias("path"), F.lit("s").alias("source_name"), (F.col("n_chars") + 1).cast("int").alias("width"), F.lit(100).alias("height"), F.lit("jpg").alias("format"))


PLAN = ViewPlan.of({"name": "v1", "stage": "sft", "include": [{"task": "text", "sources": ["src0", "src1", "src2", "src3"], "where": {"language": {"in": ["en", "fr"]}}}], "exclude": [{"where": {"source_name": "src3", "language": "fr"}}], "sample": [{"level": "document", "count": 60, "seed": 7}], "image_policy": {"filter": {"max_aspect_ratio": 60}}, "split_policy": {"train_ratio": 0.8, "val_ratio": 0.1}})


def view_build(spark, sf_dir):
    v = view_rows(PLAN, _records(spark, sf_dir), _assets(spark, sf_dir))
    return v.select("id", "canonical_record_id", "image_path", "split", "label", F.col("messages")[0]["content"].alias("ask"), F.size("prompt").alias("turns"), "target_format")


def view_filter_counts(spark, sf_dir):
    return filter_counts(replace(PLAN, sample=()), _records(spark, sf_dir), _assets(spark, sf_dir))


def view_select_where(spark, sf_dir):
    d, lab = _t(spark, sf_dir, "documents"), _t(spark, sf_dir, "labels")
    flags = F.array_compact(F.array(F.when(F.col("quality") == 0, "low_quality"), F.when(F.col("toxic") == 1, "toxic")))
    df = d.join(lab, "doc_id", "left").select("doc_id", F.lit("text").alias("task"), F.col("source").alias("source_name"), "lang", flags.alias("quality_flags"))
    df = S.include(df, [{"task": "text", "where": {"lang": {"in": ["en", "de"]}, "quality_flags": {"not_contains": ["toxic"]}}}])
    return S.exclude(df, [{"sources": ["src1"]}, {"sources": ["src2"], "where": {"lang": "de"}}]).select("doc_id", "source_name", "lang")


def sample_topk_hash(spark, sf_dir):
    d = _t(spark, sf_dir, "documents")
    return S.sample_per_group(d, ["source"], "doc_id", 5).select("source", "doc_id", "sample_rank")


def sample_keys(spark, sf_dir):
    return S.sample_keys(_t(spark, sf_dir, "documents"), "doc_id", 100, 42)


def split_assign(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", S.split_of(F.col("doc_id"), 42, 0.8, 0.1).alias("split"))


def split_counts(spark, sf_dir):
    return R.split_counts(split_assign(spark, sf_dir))


def split_leakage(spark, sf_dir):
    c = _t(spark, sf_dir, "conversations").select(F.col("conv_id").alias("document_id"), S.split_of(F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")), 42, 0.8, 0.1).alias("split"))
    return R.split_leaks(c).select("document_id", F.array_join("splits", ",").alias("splits"))


def label_filter_counts(spark, sf_dir):
    d = _labelled(spark, sf_dir)
    return d.groupBy(F.coalesce(S.label_problem(F.lit("text"), F.col("text"), "sft"), F.lit("kept")).alias("problem")).agg(F.count("*").alias("n"))


def failure_stats(spark, sf_dir):
    e = _t(spark, sf_dir, "events").select("event_type", F.when(F.col("user_id") % 3 == 0, F.lit("")).otherwise((F.col("user_id") % 5).cast("string")).alias("phase"), F.when(F.col("value") > 50, "big").alias("size"))
    return R.failure_stats(e, ["event_type", "phase", "size"])


def schema_sample_per_group(spark, sf_dir):
    return R.first_n(_t(spark, sf_dir, "documents").select("doc_id", "lang", "source"), ["lang", "source"], 3, "doc_id")


def dedupe_keep_first(spark, sf_dir):
    d = _t(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("digest"))
    return R.keep_first(d, "digest", "doc_id")


def dedupe_last_wins(spark, sf_dir):
    d = _t(spark, sf_dir, "documents").select("doc_id", "source", F.sha2("text", 256).alias("digest"))
    return R.keep_last(d, "digest", "doc_id")


def resume_anti_join(spark, sf_dir):
    return R.not_done(_t(spark, sf_dir, "documents").select("doc_id", "source"), _t(spark, sf_dir, "labels"), "doc_id")


def asset_left_join_dims(spark, sf_dir):
    lines = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").alias("w"))
    parts = _t(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_size").alias("h"))
    return lines.join(parts, "l_partkey", "left").select("l_orderkey", "l_linenumber", F.coalesce(S.image_problem(F.col("w"), F.col("h"), 3.0), F.lit("kept")).alias("problem"))


def chat_messages(spark, sf_dir):
    c = _t(spark, sf_dir, "conversations")
    turns = F.array_sort(F.collect_list(F.struct("turn", "role", "text")))
    return c.groupBy("conv_id").agg(turns.alias("m")).select("conv_id", F.size("m").alias("n"), F.array_join(F.transform("m", lambda m: F.concat(m["role"], F.lit(":"), m["text"])), "\n").alias("chat"))


def placeholder_count(spark, sf_dir):
    c = _t(spark, sf_dir, "conversations").withColumn("text", F.when(F.col("turn") % 2 == 0, F.concat(F.lit("<image>"), "text", F.lit("<image>"))).otherwise(F.col("text")))
    return c.groupBy("conv_id").agg(F.sum(T.count_placeholders(F.col("text"))).alias("n"))


def _pairs(spark, sf_dir):
    """Turns and their answers."""
    c = _t(spark, sf_dir, "conversations")
    user = c.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("label"))
    other = c.where(F.col("role") == "assistant").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("prediction"))
    return user.join(other, ["conv_id", "turn"])


def reward_score(spark, sf_dir):
    how = {"strip": False}
    return _pairs(spark, sf_dir).select("conv_id", "turn", F.round(rewards.similarity(F.col("prediction"), F.col("label"), **how), 9).alias("score"), F.round(rewards.truth_reward(F.col("prediction"), F.col("label"), **how), 9).alias("reward"))


def reward_summary(spark, sf_dir):
    s = reward_score(spark, sf_dir)
    return s.agg(F.count("*").alias("n"), F.min("score").alias("least"), F.round(F.avg("score"), 9).alias("mean"), F.max("score").alias("most"))


def clean_labels(spark, sf_dir):
    """Whole texts, with tokens and wrappers around them beside those that they hold."""
    d = _t(spark, sf_dir, "documents")
    dirty = F.concat(F.lit(r" <|ln|>\( a+b \)"), "text", F.lit(r"<|pn|>\(c\) \("))
    return d.select("doc_id", T.clean_label(dirty).alias("clean"))


def classify_text(spark, sf_dir):
    """Whole texts and their source as the hint; every tenth also ends in a small table."""
    d = _t(spark, sf_dir, "documents")
    text = F.when(F.col("doc_id") % 10 == 1, F.concat("text", F.lit("\na\tb\nc\td"))).otherwise(F.col("text"))
    return d.groupBy(T.classify(text, F.col("source")).alias("kind")).agg(F.count("*").alias("n"))


def _boxes(spark, sf_dir):
    p = _t(spark, sf_dir, "part")
    box = F.array(F.col("p_size").cast("double"), F.col("p_size").cast("double") / 2, F.col("p_size") + 100.5, F.col("p_retailprice") / 2)
    return p.select("p_partkey", box.alias("bbox"), F.col("p_brand").alias("label"), ((F.col("p_partkey") % 4) * 90).cast("int").alias("rotation"))


def layout_serialize(spark, sf_dir):
    return _boxes(spark, sf_dir).select("p_partkey", geometry.box_text(F.col("bbox"), F.col("label"), F.col("rotation"), F.lit(800), F.lit(1000)).alias("box"))


def box_tokens_parse(spark, sf_dir):
    b = layout_serialize(spark, sf_dir).select("p_partkey", F.explode(T.parse_boxes(F.concat("box", F.lit("x"), "box"), F.lit(800), F.lit(1000))).alias("e"))
    return b.select("p_partkey", F.col("e.reading_order").alias("place"), F.col("e.label").alias("label"), F.col("e.rotation").alias("rotation"), *(F.round(F.col("e.bbox")[k], 6).alias(f"x{k}") for k in range(4)))


def crop_boxes(spark, sf_dir):
    b = _boxes(spark, sf_dir).select("p_partkey", geometry.crop_box(F.col("bbox"), F.lit(120), F.lit(300)).alias("c"))
    return b.select("p_partkey", *(F.col("c")[k].alias(f"c{k}") for k in range(4)))


def repetition_basic(spark, sf_dir):
    d = _t(spark, sf_dir, "documents").select("doc_id", F.col("text"), T.tokens(F.col("text")).alias("t"))
    return d.select("doc_id", F.size("t").alias("tokens"), F.length("text").alias("chars"), T.longest_token_run(F.col("t")).alias("run"))


def repetition_full(spark, sf_dir):
    d = repetition.analysed(_t(spark, sf_dir, "documents").select("doc_id", "text"))
    return d.select("doc_id", "token_count", "same_token_run", F.col("ngram.repeats").alias("repeats"), F.col("ngram.span").alias("span"), F.round("compression", 4).alias("compression"), "char_run", F.array_join("reasons", ";").alias("reasons"))


def table_cells(spark, sf_dir):
    n, r = _t(spark, sf_dir, "nation"), _t(spark, sf_dir, "region")
    rows = F.array_sort(F.collect_list(F.struct("n_nationkey", F.array(F.col("n_name"), F.lit(""), F.col("n_nationkey").cast("string")).alias("r"))))
    return n.join(r, n.n_regionkey == r.r_regionkey).groupBy("r_name").agg(tables.cells_of_rows(F.transform(rows, lambda x: x["r"])).alias("cells"))


def table_html_roundtrip(spark, sf_dir):
    n = _t(spark, sf_dir, "nation").select("n_nationkey", F.concat(F.lit('<table><tr><td rowspan="2">'), "n_name", F.lit('</td><td colspan="2">a &amp; b</td></tr><tr><td>c</td><td></td></tr></table>')).alias("html"))
    n = n.withColumn("cells", tables.html_to_cells("html"))
    return n.select("n_nationkey", "cells", tables.cells_to_html("cells").alias("html"))


def deploy_manifest(spark, sf_dir):
    pages = _t(spark, sf_dir, "pages").select(F.regexp_extract("url", r"://[^/]+/([^?#]*)", 1).alias("path"))
    return R.file_manifest(pages, _assets(spark, sf_dir))


def validator_violations(spark, sf_dir):
    d = _t(spark, sf_dir, "documents").join(_t(spark, sf_dir, "labels"), "doc_id", "left")
    return R.violations(d, "doc_id", {"long_enough": F.col("n_chars") >= 500, "labelled": F.col("quality").isNotNull(), "english": F.col("lang") == "en"})


def stable_ids(spark, sf_dir):
    p = _t(spark, sf_dir, "pages")
    return p.select("page_id", stable_id("page", F.col("url"), F.lit(""), F.col("page_id")).alias("id"), stable_hash(F.col("url")).alias("h"))


def kd_schedule(spark, sf_dir):
    steps = _t(spark, sf_dir, "part").select(F.col("p_partkey").alias("step"))
    return steps.select("step", F.round(numeric.warmup_hold_decay(F.col("step"), 50, 50, 50, 0.0, 1.0, 0.1), 9).alias("rate"), F.round(numeric.piecewise_linear(F.col("step"), [(10, 2.0), (60, 1.0), (160, 4.0)]), 9).alias("line"))


def kd_cosine(spark, sf_dir):
    e = _t(spark, sf_dir, "embeddings")
    other = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("b"))
    return e.join(other, "vec_id").select("vec_id", F.round(numeric.cosine_loss(F.col("embedding"), F.col("b")), 6).alias("loss"))


def kd_topk_kl(spark, sf_dir):
    e = _t(spark, sf_dir, "embeddings")
    other = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("b"))
    return e.join(other, "vec_id").select("vec_id", F.round(numeric.renormalized_top_k_kl(F.col("embedding"), F.col("b"), 5), 6).alias("kl"))


def metric_reduction(spark, sf_dir):
    e = _t(spark, sf_dir, "events").withColumn("value", F.col("value").cast("decimal(20,6)"))
    return R.metric_means(e, ["user_id", "event_type"], "value").select("event_type", F.round(F.col("mean_of_sums").cast("double"), 4).alias("mean_of_sums"), "ranks")


def windowed_events(spark, sf_dir):
    w = windowed_counts(_t(spark, sf_dir, "events").withColumn("value", F.col("value").cast("decimal(20,6)")))
    return w.select(F.unix_timestamp("start").alias("start"), "event_type", "n", F.round(F.col("total").cast("double"), 4).alias("total"))


RLVR = ViewPlan.of({"name": "v2", "stage": "rlvr", "include": [{"task": "text"}], "reward_profile": {"by_task": {"text": "normalized_levenshtein_v1"}}, "split_policy": {"level": "record", "train_ratio": 0.8, "val_ratio": 0.1}})


def view_rlvr(spark, sf_dir):
    v = view_rows(RLVR, _records(spark, sf_dir), _assets(spark, sf_dir))
    return v.select("canonical_record_id", "reward_profile_id", "split", F.col("reward_model.ground_truth").alias("truth"), F.col("images_path")[0].alias("image"))


def view_validate(spark, sf_dir):
    v = view_rows(RLVR, _records(spark, sf_dir), _assets(spark, sf_dir))
    v = v.withColumn("images_path", F.when(F.substr("canonical_record_id", F.lit(-1), F.lit(1)) == "7", F.array(F.lit("/abs"), F.lit("b"))).otherwise(F.col("images_path")))
    sizes = _assets(spark, sf_dir).select("path", "width", "height")
    bad = V.view_violations(v, 40.0, sizes).join(v.select("id", "canonical_record_id"), "id")
    return bad.select("canonical_record_id", "rule")


def score_predictions(spark, sf_dir):
    p = _pairs(spark, sf_dir)
    key = F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    view = p.select(key.alias("id"), "label", F.when(F.col("turn") % 2 == 0, "normalized_levenshtein_v1").otherwise("truth_levenshtein_v1").alias("reward_profile_id"))
    out = V.score_predictions(view, p.select(key.alias("id"), "prediction"))
    return out.select("id", F.round("score", 9).alias("score"))


def lineage_of_view(spark, sf_dir):
    r = _records(spark, sf_dir)
    v = view_rows(RLVR, r, _assets(spark, sf_dir))
    return V.trace(v, r.where(F.col("source_name") != "src5")).select("record_id", "source_name", "document_id")


def image_resolution(spark, sf_dir):
    n = _t(spark, sf_dir, "nation").select("n_nationkey", F.concat(F.replace("n_name", F.lit("_"), F.lit("x")), F.lit("z")).alias("stem"))
    named = lambda end: F.concat("stem", F.lit(end))
    names = n.select(F.explode(F.array(named("_a.png"), named("_b.jpg"), F.when(F.col("n_nationkey") % 2 == 0, named(".webp")))).alias("name")).where(F.col("name").isNotNull())
    asks = n.select(F.explode(F.array("stem", named("_2"), F.lit("none"))).alias("sample_id")).distinct()
    return resolved_images(asks, names)


def runtime_paths(spark, sf_dir):
    return _assets(spark, sf_dir).select("asset_id", under_root("/data/", F.when(F.col("width") % 2 == 0, F.concat(F.lit("/"), "path")).otherwise(F.col("path"))).alias("path"))


def kd_hidden(spark, sf_dir):
    e = _t(spark, sf_dir, "embeddings")
    other = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("b"))
    return e.join(other, "vec_id").select("vec_id", F.round(numeric.normalized_mse(F.col("embedding"), F.col("b")), 6).alias("mse"), F.round(numeric.truncated_top_k_kl(F.col("embedding"), F.col("b"), 5), 6).alias("kl"))


def masked_loss(spark, sf_dir):
    e = _t(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.round(numeric.masked_mean(F.col("l_quantity"), (F.col("l_linenumber") % 2).cast("double")), 6).alias("loss"))
    return e


def media_token_round_trip(spark, sf_dir):
    c = _t(spark, sf_dir, "conversations").select("conv_id", "turn", F.array(F.struct("role", F.concat(F.lit("<image>"), "text").alias("content"))).alias("m"))
    hidden = T.escape_media_tokens(F.col("m"), "n")[0]["content"]
    return c.select("conv_id", "turn", T.count_placeholders(hidden).alias("left"), (T.restore_media_tokens(hidden, "n") == F.col("m")[0]["content"]).alias("same"))


def preview_and_extension(spark, sf_dir):
    p = _t(spark, sf_dir, "pages")
    return p.select("page_id", T.truncated(F.col("url"), 20).alias("preview"), T.extension(F.regexp_extract("url", r"^([^?#]*)", 1), ".html").alias("ext"))


_ALL = (view_build, view_filter_counts, view_select_where, sample_topk_hash, sample_keys, split_assign, split_counts, split_leakage, label_filter_counts, failure_stats, schema_sample_per_group, dedupe_keep_first, dedupe_last_wins, resume_anti_join, asset_left_join_dims, chat_messages, placeholder_count, reward_score, reward_summary, clean_labels, classify_text, layout_serialize, box_tokens_parse, crop_boxes, repetition_basic, repetition_full, table_cells, table_html_roundtrip, deploy_manifest, validator_violations, stable_ids, kd_schedule, kd_cosine, kd_topk_kl, metric_reduction, windowed_events, view_rlvr, view_validate, score_predictions, lineage_of_view, image_resolution, runtime_paths, kd_hidden, masked_loss, media_token_round_trip, preview_and_extension)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in _ALL} | queries_runs.QUERIES | queries_store.QUERIES
