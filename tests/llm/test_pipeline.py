"""Each stage of the pipeline against a plain version, on what the stage before it kept."""

from brute import components, normalised
from pyspark.sql import functions as F

import corpus_pipeline
from tsengine.llm import queries

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = {}
    for name, result in corpus_pipeline.steps(spark, FOLDER):
        kept[name] = result
        if name != "best-fit packing":
            assert kept[name].columns == docs.columns
    rows = {name: [(r["doc_id"], r["text"]) for r in df.collect()] for name, df in kept.items() if name != "best-fit packing"}

    scored = queries.op1_quality_classifier(spark, FOLDER).where("score >= 0.3")
    assert sorted(i for i, _ in rows["quality classifier"]) == sorted(r["doc_id"] for r in scored.collect())

    first = {}
    for i, t in sorted(rows["quality classifier"]):
        first.setdefault(normalised(t), i)
    assert sorted(i for i, _ in rows["exact dedup"]) == sorted(first.values())

    alone = sorted(i for i, _, c in components(rows["exact dedup"]) if i == c)
    assert sorted(i for i, _ in rows["n-gram Jaccard join"]) == alone

    mixed = kept["mixing sources"]
    assert {i for i, _ in rows["mixing sources"]} <= set(alone)
    words = mixed.select(F.sum(F.size(F.expr("filter(split(text, ' |\\n'), w -> w != '')")))).first()[0]
    supply = kept["n-gram Jaccard join"].select(F.sum(F.size(F.expr("filter(split(text, ' |\\n'), w -> w != '')")))).first()[0]
    assert 0.8 * supply < words < 1.2 * supply

    packed = kept["best-fit packing"]
    assert packed.where("piece = 0").count() == mixed.count()
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("e")).where("n <> e or n > 1024").count() == 0


def test_stages_of_odd_tables(spark, documents):
    """Null and repeated ids, null and repeated texts, clashing columns; then an empty table."""
    rows = [(None, "null id"), (None, "null id"), (1, None), (2, ""), (3, "same words here"), (3, "same words here"), (4, "Same  words here"), (5, "w " * 3000)]
    for table in (documents(rows), documents([])):
        docs = table
        for name, stage in corpus_pipeline.STAGES[1:]:
            docs = stage(spark, docs, FOLDER)
            if name == "n-gram Jaccard join":
                assert sorted(str(r["doc_id"]) for r in docs.collect()) == (["1", "3", "5", "None"] if table.count() else [])
            if name != "best-fit packing":
                assert docs.columns == table.columns
        docs.collect()
    assert corpus_pipeline.good_quality(spark, documents([]), FOLDER).count() == 0


def test_run_registers_and_gives_the_last_stage(spark):
    import __spark_entry__ as contract

    assert "pipeline" in contract.queries() and set(queries.QUERIES) <= set(contract.queries())
    assert contract.queries()["pipeline"](spark, FOLDER).count() > 0
