"""The pipeline on a small corpus whose right results are known by construction."""

import math
import random

from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_operators import brute_components

WIDE = ["".join(random.Random(k).choices("abcdefghij", k=6)) for k in range(3000)]


def test_every_stage_does_its_work(spark, tmp_path):
    rng = random.Random(9)
    text = lambda n: " ".join(rng.choice(WIDE) for _ in range(n))
    clean = {k: text(rng.randint(60, 150)) for k in range(900)}
    junk = {1000 + k: " ".join(w + "###" for w in text(80).split()) for k in range(150)} | {1200 + k: " ".join(w for w in text(20).split() for _ in range(5)) for k in range(150)}
    copies = {2000 + k: clean[k] for k in range(30)} | {2100 + k: clean[k] + " tail" for k in range(30)}
    items = [(k, text(30) + ". " + text(9) + ".") for k in range(12)]
    leaking = {3000 + k: text(60) + " " + items[k][1] + " " + text(60) for k in range(12)}
    secret = {4000: text(70) + " password=Zq81LmNoPw " + text(10)}
    rows = [(d, t, "en", f"s{d % 3}", len(t)) for d, t in (clean | junk | copies | leaking | secret).items()]
    labels = [(d, 1, 0) for d in list(clean)[:600]] + [(d, 0, 0) for d in junk if d % 2]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "near_duplicates", "benchmark_decontamination", "secret_scan", "source_mix"]
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        columns = docs.columns
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = {r["doc_id"]: r for r in docs.collect()}
        if name != "source_mix":
            assert docs.columns == columns
    first = set(kept["quality_classifier"])
    assert not first & set(junk) and len(first & set(clean)) > 0.97 * len(clean)

    texts = [(d, r["text"]) for d, r in kept["quality_classifier"].items()]
    assert set(kept["near_duplicates"]) == {c for _, _, c in brute_components(texts)}
    assert set(kept["near_duplicates"]) - set(kept["benchmark_decontamination"]) == set(leaking) & set(kept["near_duplicates"])
    assert set(kept["secret_scan"]) == set(kept["benchmark_decontamination"])
    changed = {d for d, r in kept["secret_scan"].items() if r["text"] != kept["benchmark_decontamination"][d]["text"]}
    assert changed == {4000} & first
    for d in changed:
        assert "password=[SECRET] " in kept["secret_scan"][d]["text"] and kept["secret_scan"][d]["n_chars"] == len(kept["secret_scan"][d]["text"])

    per = docs.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()
    assert len(per) == 3 and all(r["taken"] == math.floor(r["target"]) for r in per)
    assert corpus_pipeline.ORACLE_SQL is None
