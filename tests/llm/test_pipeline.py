"""The corpus pipeline, stage by stage, on the driver's smallest tables."""

import corpus_pipeline
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, quality, simhash, substring_dedup


def test_each_stage_does_what_its_operator_says(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns, name
        ids = {r[0] for r in docs.select("doc_id").collect()}
        if name == "quality classifier":
            judged = quality.quality_classifier(before, spark.read.parquet(f"{sf_dir}/labels.parquet"))
            assert ids == {r[0] for r in judged.where("predicted = 1").select("doc_id").collect()}
        elif name == "SimHash near-dedup":
            assert ids == {r[0] for r in simhash.simhash_dedup(before).select("component_id").collect()}
        elif name == "substring dedup":
            cut = {r[0] for r in substring_dedup.passages(before).select("doc_id").collect()}
            same = docs.join(before.select("doc_id", F.col("text").alias("old")), "doc_id")
            assert {r[0] for r in same.where("text <> old").select("doc_id").collect()} <= cut
            assert {r[0] for r in before.select("doc_id").collect()} - ids <= cut
        elif name == "benchmark decontamination":
            bad = decontaminate.contamination(before, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).where("contaminated")
            assert ids == {r[0] for r in before.select("doc_id").collect()} - {r[0] for r in bad.select("doc_id").collect()}
        else:
            assert ids == {r[0] for r in before.select("doc_id").collect()}
