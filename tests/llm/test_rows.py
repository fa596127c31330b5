"""Decontamination in the pipeline goes by row, not by id."""

import corpus_pipeline

PASSAGE = "one two three four five six seven eight nine ten eleven twelve"


def test_clean_namesakes_stay(spark, tmp_path):
    spark.createDataFrame([(1, PASSAGE)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    clean = [(None, "clean a"), (None, "clean b"), (None, None), (7, "clean c"), (7, "clean c"), (8, "clean d"), (9, "")]
    hit = [(None, f"so {PASSAGE} it is"), (7, PASSAGE.upper()), (10, PASSAGE)]
    docs = spark.createDataFrame(clean + hit, "doc_id bigint, text string")
    kept = corpus_pipeline.keep_clean(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns and sorted(map(str, map(tuple, kept.collect()))) == sorted(map(str, clean))
