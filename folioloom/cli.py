"""Command line: export a source, validate the store, build and validate a view, try and score rewards, list files, trace rows."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from . import canonical, config
from .functions import prompts
from .operators import deploy, views
from .plans.export import export
from .plans.view import ViewPlan, read_view, read_yaml, write_view
from .schemas import CANONICAL
from .sources.adapters import ADAPTERS
from .sources.files import image_listing, relative_files


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="folioloom", description=__doc__)
    sub = parser.add_subparsers(dest="command", required=True)
    for name, options in {"export-source": ("adapter", "path", "source", "root"), "validate-canonical": ("root",), "build-view": ("config", "root", "views"), "validate-view": ("view",), "reward-smoke-test": ("view",), "deploy-manifest": ("view", "out"), "score-predictions": ("view", "predictions", "out"), "trace": ("view", "root", "id"), "index": ("root",)}.items():
        p = sub.add_parser(name)
        for o in options:
            p.add_argument(o)
        if name == "export-source":
            p.add_argument("--append", action="store_true")
            p.add_argument("--overwrite", action="store_true", help="replace the source's partitions, which is what happens without --append and --skip-completed")
            p.add_argument("--skip-completed", action="store_true")
            p.add_argument("--images", help="folder of the pages' or records' images, for their sizes")
            p.add_argument("--middle", help="annotated_pages: files <sample>_middle.json")
            p.add_argument("--max-samples", type=int)
            p.add_argument("--tasks", nargs="*")
        if name == "build-view":
            for o in ("--num-workers", "--worker-batch-size", "--schema-sample-size"):
                p.add_argument(o, type=int)
            p.add_argument("--images", help="folder of the images that the view embeds or resizes")
            p.add_argument("--prompts", help="YAML profile of prompts")
            p.add_argument("--skip-failure", action="store_true", default=None, help="leave out records that can't be made")
        if name == "validate-canonical":
            p.add_argument("--tasks", nargs="*")
            p.add_argument("--sources", nargs="*")
        if name == "validate-view":
            p.add_argument("--images", help="folder of the images that rows refer to")
            p.add_argument("--max-aspect-ratio", type=float, default=200.0)
            p.add_argument("--max-rows", type=int, default=0)
        if name == "reward-smoke-test":
            p.add_argument("--limit", type=int, default=0)
    a = parser.parse_args(args)
    spark = SparkSession.builder.appName("folioloom").getOrCreate()
    table = lambda name: canonical.read(spark, a.root, name)
    if a.command == "export-source":
        if a.overwrite and (a.append or a.skip_completed):
            parser.error("--overwrite goes with neither --append nor --skip-completed")
        more = {"middle": a.middle} if a.middle else {}
        tables = ADAPTERS[a.adapter](spark, a.path, a.source, image_listing(spark, a.images) if a.images else None, **more)
        print(export(spark, tables, a.root, a.adapter, a.source, a.tasks, a.append, a.skip_completed, a.max_samples))
    elif a.command == "validate-canonical":
        bad = 0
        for name in CANONICAL:
            if (df := table(name)) is None:
                continue
            if a.sources:
                df = df.where(F.col("source_name").isin(a.sources))
            if a.tasks and "task" in df.columns and name == "records":
                df = df.where(F.col("task").isin(a.tasks))
            if (rows := canonical.validate(df, name).limit(20).collect()):
                bad += len(rows)
                print(name, *(f"{r[0]}: {r.rule}" for r in rows), sep="\n  ")
        return int(bad > 0)
    elif a.command == "index":
        for name in ("records", "documents", "assets"):
            if table(name) is not None:
                canonical.build_index(spark, a.root, name)
    elif a.command == "build-view":
        raw = read_yaml(spark, a.config) | (prompts.load(spark, a.prompts) if a.prompts else {}) | ({"skip_failure": True} if a.skip_failure else {})
        config.apply(spark, {"num_workers": a.num_workers, "worker_batch_size": a.worker_batch_size, "schema_sample_size": a.schema_sample_size}, (raw.get("execution") or {}).get("view_build"))
        images = relative_files(spark, a.images) if a.images else None
        print(write_view(ViewPlan.of(raw), table("records"), table("assets"), a.views, images))
    elif a.command == "validate-view":
        view = read_view(spark, a.view).withColumn("file", F.col("_metadata.file_path"))
        view = views.first_rows(view, a.max_rows, F.col("file"), "id").drop("file")
        sizes = image_listing(spark, a.images) if a.images else None
        bad = views.view_violations(view, a.max_aspect_ratio, sizes).unionByName(views.stage_violations(view))
        rows = bad.distinct().limit(20).collect()
        print(*(f"{r.id}: {r.rule}" for r in rows), sep="\n")
        return int(bool(rows))
    elif a.command == "reward-smoke-test":
        view = read_view(spark, a.view).where("stage = 'rlvr'")
        view = view.orderBy("id").limit(a.limit) if a.limit > 0 else view
        out = views.reward_summary(views.score_predictions(view, view.select("id", F.col("label").alias("prediction")))).first()
        print(out.asDict())
        return int(not out["n"])
    elif a.command == "deploy-manifest":
        view = read_view(spark, a.view)
        files = view.select(F.col("_metadata.file_path").alias("path")).distinct()
        deploy.write_lines(deploy.manifest(files, view), a.out)
        print(deploy.manifest_counts(files, view).first().asDict())
    elif a.command == "score-predictions":
        scores = views.score_predictions(read_view(spark, a.view), spark.read.parquet(a.predictions))
        scores.write.mode("overwrite").parquet(a.out)
        print(views.reward_summary(spark.read.parquet(a.out)).first().asDict())
    else:
        rows = read_view(spark, a.view).where(F.col("id") == a.id)
        ids = [r[0] for r in rows.select("canonical_record_id").collect()]
        found = canonical.lookup(spark, a.root, "records", ids)
        records = found if found is not None else spark.createDataFrame([], CANONICAL["records"])
        documents = canonical.lookup(spark, a.root, "documents", [r[0] for r in records.select("document_id").collect()])
        print(*views.trace(rows, records, documents).toJSON().collect(), sep="\n")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
