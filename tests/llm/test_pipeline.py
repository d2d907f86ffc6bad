import re

from pyspark.sql import functions as F

import corpus_pipeline
from shelfseries.llm import toxicity
from shelfseries.llm.staging import hold
from tests.conftest import TESTDATA
from tests.llm import brute
from tests.llm.test_packing import check


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_stages_against_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "exact dedup", "near-duplicates", "substring dedup", "packing"]

    kept = hold(stages["toxicity"](spark, docs, small), "t")
    fitted = toxicity.fit(docs, spark.read.parquet(f"{small}/labels.parquet"))
    low = {r["id"] for r in toxicity.score(docs, fitted).where("score < 0.5").collect()}
    assert kept.columns == columns and {i for i, _ in pairs(kept)} == low

    single = hold(stages["exact dedup"](spark, kept, small), "t")
    seen = {}
    for i, t in sorted(pairs(kept)):
        seen.setdefault(re.sub(r"[\x20\x09-\x0d]+", " ", t), i)
    assert single.columns == columns and {i for i, _ in pairs(single)} == set(seen.values())

    apart = hold(stages["near-duplicates"](spark, single, small), "t")
    assert apart.columns == columns and {i for i, _ in pairs(apart)} == {i for i, (_, c) in brute.components(pairs(single), 5).items() if i == c}

    cut = hold(stages["substring dedup"](spark, apart, small), "t")
    want = brute.cut_repeats(pairs(apart))
    before = dict(pairs(apart))
    assert cut.columns == columns and len(pairs(cut)) == len(before)
    for r in cut.collect():
        words, gone, _ = want[r["doc_id"]]
        assert len(r["text"].split()) == words - gone
        assert r["text"] == before[r["doc_id"]] if not gone else r["n_chars"] == len(r["text"])

    check([r.asDict() | {"id": r["doc_id"]} for r in stages["packing"](spark, cut, small).collect()], pairs(cut), 2048)


def test_first_stage_against_labels(spark):
    """Documents that are labelled toxic go and others stay, also those that no count or curve has seen."""
    medium = str(TESTDATA / "sf0.1")
    docs = spark.read.parquet(f"{medium}/documents.parquet")
    kept = {r["doc_id"] for r in corpus_pipeline.drop_toxic(spark, docs, medium).select("doc_id").collect()}
    labels = spark.read.parquet(f"{medium}/labels.parquet").withColumn("unseen", toxicity.fold(F.col("doc_id")) == 0).collect()
    for rows in (labels, [r for r in labels if r["unseen"]]):
        toxic = [r["doc_id"] not in kept for r in rows if r["toxic"]]
        clean = [r["doc_id"] in kept for r in rows if not r["toxic"]]
        assert sum(toxic) >= 0.8 * len(toxic) and sum(clean) >= 0.97 * len(clean)  # measured: 0.89 and 0.99 of the unseen


def test_odd_rows_and_clashing_columns(spark, make, odd, small):
    docs = make(odd + [(1, odd[0][1]), (1, odd[0][1])]).withColumns({c: F.lit(7) for c in ("n_removed", "_text", "carried", "kept_text", "hash", "doc", "own", "doc_id_2")})
    rows = odd + [(1, odd[0][1])] * 2
    stages = dict(corpus_pipeline.STAGES)
    columns = docs.columns
    first = hold(stages["toxicity"](spark, docs, small), "t")
    assert first.columns == columns and first.count() <= len(rows)

    single = hold(stages["exact dedup"](spark, docs, small), "t")
    seen = {}
    for i, t in rows:
        if i is not None:
            key = re.sub(r"[\x20\x09-\x0d]+", " ", t or "")
            seen[key] = min(seen.get(key, i), i)
    want = sorted(seen.values()) + [None] * sum(i is None for i, _ in rows)
    assert single.columns == columns and sorted((i for i, _ in pairs(single)), key=lambda i: (i is None, i)) == want

    apart = hold(stages["near-duplicates"](spark, single, small), "t")
    assert apart.columns == columns and {i for i, _ in pairs(apart)} <= set(want)

    cut = hold(stages["substring dedup"](spark, apart, small), "t")
    assert cut.columns == columns and cut.count() == apart.count()
    kinds = {f.name: f.dataType for f in docs.schema}
    assert {f.name: f.dataType for f in cut.schema} == kinds
    lost = brute.cut_repeats([(i, t) for i, t in pairs(apart) if i is not None])
    for r in cut.where("doc_id is not null").collect():
        words, gone, _ = lost[r["doc_id"]]
        assert len((r["text"] or "").encode().split()) == words - gone and r["n_removed"] == 7
    assert sum(gone for _, gone, _ in lost.values()) > 0
    packed = stages["packing"](spark, cut, small)
    assert packed.where("start = 0").count() == cut.count()


def test_empty_table(spark, make, small):
    docs = make([])
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, small)
        assert out.count() == 0
        assert name == "packing" or out.columns == docs.columns
