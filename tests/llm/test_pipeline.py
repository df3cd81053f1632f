import corpus_pipeline
from tallyline.llm import registry

from .helpers import CLASHING, DOC, frame, odd_docs, with_extras


def test_stages_in_order_on_odd_rows(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "mixing", "packing"]
    for schema, rows in ((CLASHING, with_extras(odd_docs())), (DOC, [])):
        docs = frame(spark, rows, schema)
        cols, path = docs.columns, None
        for k, (name, f) in enumerate(corpus_pipeline.STAGES):
            out = f(spark, docs, path)
            if k < 4:
                assert out.columns == cols, name
                assert [f.dataType for f in out.schema] == [f.dataType for f in docs.schema], name
                docs = spark.createDataFrame(out.collect(), out.schema)
            else:
                got = out.collect()
        if rows:
            assert got and all(g["length"] > 0 for g in got)
        else:
            assert got == []


def test_run_over_the_smallest_tables(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert len(out) > 100
    assert sum(g["length"] for g in out) / 4096 + 1 >= len({g["sequence_id"] for g in out})


def test_every_operator_is_registered():
    numbers = {int(n[2:].split("_")[0]) for n in registry.QUERIES}
    assert numbers == set(range(1, 14))
    assert set(registry.ORACLE) <= set(registry.QUERIES)
