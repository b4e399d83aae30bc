import corpus_pipeline
from corpusloom.llm.mixing import WORD
from pyspark.sql import functions as F

from tests.llm.test_models_joins import brute_components, word_sets


def test_stages_against_brute_force(spark):
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, d)
        docs.write.mode("overwrite").parquet(f"{spark.conf.get('spark.checkpoint.dir')}/stage-{name}")
        docs = spark.read.parquet(f"{spark.conf.get('spark.checkpoint.dir')}/stage-{name}")
        assert docs.columns == columns
        was, now = before.collect(), docs.collect()
        if name == "language_id":
            assert len(now) > 0.97 * len(was) and not [r for r in now if not any(c.isalpha() for c in r.text)]
        if name == "exact_dedup":
            assert len(now) == len({"".join(r.text.encode().decode().translate({9: "", 10: "", 11: "", 12: "", 13: "", 32: ""})) for r in was})
        if name == "near_dedup":
            root = brute_components(word_sets([(r.doc_id, r.text) for r in was], 5))
            assert {r.doc_id for r in now} == {i for i, r in root.items() if i == r}
        if name == "mixing":
            size = lambda rows: sum(len(r.text.encode().split()) for r in rows)
            assert abs(size(now) - size(was)) <= 16 * 20 and {r.doc_id for r in now} <= {r.doc_id for r in was}
            assert docs.where(F.regexp_count("text", F.lit(WORD)) == 0).count() == 0
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, d)
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_a_stage_forgets_what_others_left_from_its_first_task_on(spark):
    from corpusloom.llm import _common, exact_dedup, language_id, packing

    for first in (language_id._word_counts, exact_dedup._first_rows):
        _common.claim("packing")
        packing._tokenizers["x"] = None
        task = first(iter([]))
        try:
            next(task, None)
        except AttributeError:  # no task runs here
            pass
        assert not packing._tokenizers
