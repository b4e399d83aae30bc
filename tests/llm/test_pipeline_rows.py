"""Odd rows and empty tables through every stage."""

import corpus_pipeline
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def written(spark, df, name):
    path = f"{spark.conf.get('spark.checkpoint.dir')}/{name}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def test_stages_take_odd_rows(spark):
    """Nulls in any column, empty, blank, very long and repeated texts, one id twice, invalid bytes, clashing columns."""
    prose = [f"the small house on the hill number {i} has a red roof and a green door and many old books" for i in range(40)]
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(prose)] + [(100 + i, f"das kleine haus nummer {i} hat ein rotes dach und viele alte buecher im keller", "de", "t", 1) for i in range(40)]
    rows += [(200, None, "en", "s", 1), (201, "", None, "s", 1), (202, " \n\t", "en", None, None), (203, "12 34 !!", "en", "s", 1), (204, "the old house " * 30_000, "en", None, 1), (None, prose[0] + " extra words here", None, None, None)]
    rows += [(205, prose[1], "en", "s", 1)] * 3 + [(205, "quite another text about the same old house with a door", "en", "s", 1)]
    docs = spark.createDataFrame(rows, DOCS).union(spark.sql("select 206L, cast(unhex('746865206f6c6420ff20686f757365') as string), 'en', 's', 1L"))
    for c in ("id", "size", "run", "key", "pos", "_key", "edge", "row", "lang_pred", "shard", "h"):
        docs = docs.withColumn(c, F.lit("clash"))
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(spark, stage(spark, docs, ""), f"odd-{name}")
        assert docs.columns == columns and docs.count() > 0
        texts = [r.text for r in docs.collect()]
        if name == "language_id":
            assert None not in texts and "" not in texts and "12 34 !!" not in texts and len(texts) >= len(rows) - 5
        if name == "exact_dedup":
            assert len(texts) == len({"".join(t.split()) for t in texts})
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, "").collect()
    assert sum(r.length for r in packed) >= docs.count() and max(r.doc_tokens for r in packed) > 1024


def test_stages_take_empty_tables(spark):
    docs = spark.createDataFrame([], DOCS)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(spark, stage(spark, docs, ""), f"none-{name}")
        assert docs.count() == 0 and docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() == 0
