"""Queries that write what they read: views, exports, streams and look-ups in a store, read back from disk."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import canonical
from .functions import numeric
from .operators import index
from .operators import select as S
from .plans import export as X
from .plans.view import read_view, write_view
from .sources.adapters import nested_jsonl
from .storage import shared_dir
from .streaming.incremental import ingest


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _fresh(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def view_written(spark, sf_dir):
    """The flagship view, written twice as a whole and read back."""
    from .queries import PLAN, _assets, _records

    root = _fresh(spark, "views")
    for _ in range(2):
        path = write_view(PLAN, _records(spark, sf_dir), _assets(spark, sf_dir), root)
    v = read_view(spark, path)
    return v.select("id", "canonical_record_id", "image_path", "split", "label", F.col("messages")[0]["content"].alias("ask"), F.size("prompt").alias("turns"), "target_format")


def export_committed(spark, sf_dir):
    """Documents as JSON lines, exported in two runs, the second of which skips what the first has committed."""
    lines, root = _fresh(spark, "lines"), _fresh(spark, "store")
    d = _t(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("record_id"), F.coalesce("source", F.lit("")).alias("subset_id"), F.lit("i.jpg").alias("image_path"), F.lit("40_30").alias("size_key"), F.col("text").alias("label"), F.lit("text").alias("type"))
    d.where(F.col("subset_id") < "src2").write.json(f"{lines}/one")
    d.where(F.col("subset_id") >= "src2").write.json(f"{lines}/two")
    for paths in ([f"{lines}/one"], [f"{lines}/one", f"{lines}/two"]):
        X.export(spark, nested_jsonl(spark, paths, "texts"), root, "nested_jsonl", "texts", skip_completed=True)
    done = X.completed(spark, root)
    docs = canonical.read(spark, root, "documents").join(done, ["source_name", "source_document_id"])
    records = canonical.read(spark, root, "records").groupBy("document_id").agg(F.count("*").alias("records"))
    return docs.join(records, "document_id").select("source_document_id", "source_name", "records")


def ingested_texts(spark, sf_dir):
    """Documents streamed into a store by the hash of their text, each text once; a second run finds nothing new."""
    root, schema = _fresh(spark, "ingested"), "doc_id long, text string, lang string, source string, n_chars long"
    rows = lambda df: df.select(F.sha2(F.coalesce("text", F.lit("")), 256).alias("document_id"), F.lit("texts").alias("source_name"), F.length("text").alias("num_pages"))
    for _ in range(2):
        ingest(spark, f"{sf_dir}/documents.parque[t]", schema, root, "documents", f"{root}/checkpoint", rows)
    return canonical.read(spark, root, "documents").select("document_id", F.col("num_pages").alias("n_chars"))


def _stored(spark: SparkSession, sf_dir: str) -> str:
    from .queries import _records

    root = _fresh(spark, "records")
    canonical.write(_records(spark, sf_dir), root, "records")
    return root


def record_lookup(spark, sf_dir):
    """A sample of a hundred records, looked up in a store by the index of its ids."""
    root = _stored(spark, sf_dir)
    canonical.build_index(spark, root, "records")
    ids = [r[0] for r in S.sample_keys(canonical.read(spark, root, "records"), "record_id", 100, 5).collect()]
    return canonical.lookup(spark, root, "records", ids).select("record_id", "source_name", F.length("target.text").alias("chars"))


def records_needed(spark, sf_dir):
    """The stored records of labelled documents."""
    needed = _t(spark, sf_dir, "labels").select(F.concat(F.lit("r"), F.col("doc_id").cast("string")).alias("record_id"))
    return index.rows_of_many(canonical.read(spark, _stored(spark, sf_dir), "records"), "record_id", needed).select("record_id", "source_name", "language")


LAYERS = [(0, 0), (1, 2), (3, 6), (3, 2)]


def hidden_losses(spark, sf_dir):
    """Vectors as hidden states of four layers, against those of their neighbours, by token groups of one remainder."""
    e = _t(spark, sf_dir, "embeddings")

    def states(place, step):
        token = F.floor(place / 4)
        return e.where(place >= 0).select(token.alias("token"), (token % 5).alias("batch"), (place % 4 * step).alias("layer"), F.col("embedding").alias("hidden"))

    student, teacher = states(F.col("vec_id"), 1), states(F.col("vec_id") - 1, 2)
    mask = student.select("token", "batch", (F.col("token") % 3 > 0).cast("int").alias("mask")).distinct()
    out = [numeric.hidden_loss(student, teacher, LAYERS, mask, kind, ["token", "batch"], ["batch"]).select("batch", F.round("loss", 6).alias(kind)) for kind in numeric.HIDDEN]
    return out[0].join(out[1], "batch")


_ALL = (view_written, export_committed, ingested_texts, record_lookup, records_needed, hidden_losses)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in _ALL}

_LABELLED = "SELECT doc_id, lang, source, CASE WHEN doc_id % 70 = 0 THEN '' WHEN doc_id % 50 = 0 THEN '<image>' || text ELSE text END AS text FROM documents"
_UNIT = "sqrt(list_sum(list_transform({x}, lambda v: v * v)))"

#: view_written has the SQL of view_build.
ORACLE_SQL = {
    "export_committed": r"SELECT source || '/' || doc_id AS source_document_id, 'texts' AS source_name, count(*) AS records FROM documents WHERE regexp_matches(coalesce(text, ''), '\S') GROUP BY 1",
    "ingested_texts": "SELECT sha256(coalesce(text, '')) AS document_id, any_value(length(text))::int AS n_chars FROM documents GROUP BY 1",
    "record_lookup": f"WITH r AS (SELECT 'r' || doc_id AS record_id, source AS source_name, length(text)::int AS chars FROM ({_LABELLED})) SELECT * FROM r ORDER BY sha256('5:' || record_id) LIMIT 100",
    "records_needed": "SELECT DISTINCT 'r' || doc_id AS record_id, source AS source_name, lang AS language FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)",
    "hidden_losses": f"""WITH s AS (SELECT vec_id // 4 AS token, vec_id % 4 AS layer, embedding::double[] AS h FROM embeddings),
t AS (SELECT (vec_id - 1) // 4 AS token, (vec_id - 1) % 4 * 2 AS layer, embedding::double[] AS h FROM embeddings WHERE vec_id >= 1),
m(k, a, b) AS (VALUES (0, 0, 0), (1, 1, 2), (2, 3, 6), (3, 3, 2)),
x AS (SELECT k, s.token, (s.token % 3 > 0)::int AS w, s.h AS a, t.h AS b, {_UNIT.format(x='s.h')} AS na, {_UNIT.format(x='t.h')} AS nb FROM s JOIN m ON s.layer = a JOIN t ON t.layer = b AND t.token = s.token),
e AS (SELECT k, token % 5 AS batch, w, list_sum(list_transform(list_zip(a, b), lambda p: pow(p[1] / na - p[2] / nb, 2))) / len(a) AS mse, 1 - list_dot_product(a, b) / (na * nb) AS cosine FROM x),
l AS (SELECT k, batch, sum(mse * w) / greatest(sum(w), 1) AS mse, sum(cosine * w) / greatest(sum(w), 1) AS cosine FROM e GROUP BY k, batch)
SELECT batch, round(avg(mse), 6) AS normalized_mse, round(avg(cosine), 6) AS cosine FROM l GROUP BY batch""",
}
