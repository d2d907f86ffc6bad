"""The numbered queries: columns, and the same rows as their SQL."""

import duckdb
import pytest

from shelfseries.llm.queries import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, small, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    frame = QUERIES[name](spark, small)
    cursor = con.execute(SQL[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(frame.columns)
    want = sorted((dict(zip(columns, r)) for r in cursor.fetchall()), key=str)
    want = sorted((tuple(r[c] for c in sorted(columns)) for r in want), key=str)
    got = sorted((tuple(r[c] for c in sorted(columns)) for r in frame.collect()), key=str)
    assert got == want


COLUMNS = {
    1: ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"], 2: ["doc_id", "held_out", "score", "predicted"],
    3: ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"], 4: ["doc_id", "n_shingles", "component_id", "kept"],
    5: ["doc_id", "keep_id", "group_size", "kept", "text_sha256"], 6: ["query_id", "rank", "vec_id", "score"],
    7: ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"], 8: ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    13: ["doc_id", "n_features", "weight", "score", "rank"], 12: ["lang", "source", "part", "item", "value", "rank"],
    11: ["doc_id", "size", "source_size", "target", "taken"],
    9: ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"], 10: ["doc_id", "n_words", "n_removed", "kept_sha256"],
}


@pytest.mark.parametrize("number", sorted(COLUMNS))
def test_columns(spark, small, number):
    (name,) = [q for q in QUERIES if q.startswith(f"op{number}_")]
    assert QUERIES[name](spark, small).columns == COLUMNS[number]
