"""The pipeline, and its last two stages alone, on awkward and empty tables."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pricemill.llm import mixing

LONG = " ".join(f"word{i % 977}" for i in range(30_000))
ROWS = [
    (1, "", "en", "a", 0), (2, None, None, None, None), (3, LONG, "en", "a", 1), (4, LONG + " end", "de", None, 1), (5, "\n \t", "en", "b", 3),
    (6, "same words here for all of us to read", None, "a", 1), (6, "same words here for all of us to read", None, "a", 1),
    (None, "no id but a text with some words", "en", "b", 1), (8, "x" * 5000, "fr", "b", 1), (9, "\u2581 \u0000 é 日本 😀 mot", "fr", "c", 1),
    (10, "a\nb\r\nc", "de", "c", 1),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.mark.parametrize("empty", [False, True])
def test_the_whole_pipeline(spark, awkward, tmp_path, empty):
    (awkward.limit(0) if empty else awkward).write.parquet(f"{tmp_path}/documents.parquet")
    result = corpus_pipeline.run(spark, str(tmp_path)).collect()
    if empty:
        assert result == []
    else:
        assert result and all(r.lossless for r in result)
        assert {r.doc_id for r in result} <= {3, 4, 6, 8, 9, 10, None}


def test_mix_and_encode_stages(spark, awkward):
    crowded = awkward.withColumns({c: F.lit(7) for c in ("sid", "row", "start", "size", "doc", "n_tokens", "lossless")})
    mixed = mixing.mixed_documents(crowded)
    assert set(crowded.columns) | set(mixing.PLACE) == set(mixed.columns)
    rows = mixed.collect()
    assert {r.doc_id for r in rows} <= {3, 4, 6, 8, 9, 10, None} and rows
    encoded = corpus_pipeline.encode(spark, mixed, "").collect()
    assert len(encoded) == len(rows) and all(r.lossless for r in encoded)
    assert mixing.mixed_documents(crowded.limit(0)).count() == 0
    assert corpus_pipeline.encode(spark, mixed.limit(0), "").count() == 0
