from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfseries.llm import toxicity

from .test_frequent import CUTS, documents


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(documents(), "doc_id long, text string")


@pytest.fixture(scope="module")
def model(spark, texts):
    return toxicity.fit(texts, spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, toxic int"))[0]


def body(texts):
    return texts.select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).cast("binary").alias("body"))


def test_words_that_a_hash_finds_are_not_joined(texts, model):
    _, (_, parts) = toxicity._features(body(texts), model, head=10)
    assert parts.where("word is not null").count() == 0


def test_features_do_not_depend_on_the_words_in_memory(texts, model):
    first, *others = ({r["id"]: r["x"] for r in toxicity._features(body(texts), model, head, more)[0].collect()} for head, more in CUTS)
    for i, text in documents():
        words = Counter((text or "").encode().lower().split())
        assert np.isclose(first[i][-1], np.log1p(len(words)))
        assert all(np.allclose(first[i], other[i], rtol=1e-9, atol=1e-12) for other in others)
