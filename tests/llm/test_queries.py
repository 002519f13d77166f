"""The registered queries: SQL where there is some, columns, and whole tables."""

import compare
import pytest

import corpus_pipeline
from mailtally.llm.queries import ORACLES, QUERIES

COLUMNS = {
    1: "doc_id n_bytes n_removed n_spans kept_sha256",
    2: "doc_id held_out score predicted",
    3: "vec_id n_links component_id kept",
    4: "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    5: "doc_id size source_size target taken",
    6: "doc_id held_out score predicted",
    7: "doc_id n_words n_base first_word last_word base_labels labels score",
    8: "doc_id fingerprint component_id",
    9: "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    10: "doc_id n_words n_removed kept_sha256",
    11: "doc_id n_features weight score rank",
    12: "page_id host path rule verdict",
    13: "doc_id leaf subroot root proof_sha256 folded_root verified",
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, name):
    number = int(name[2:].split("_")[0])
    df = QUERIES[name](spark, sf)
    assert set(COLUMNS[number].split()) <= set(df.columns)
    if name in ORACLES:
        assert compare.mismatch(df, compare.connect(sf), ORACLES[name]) is None
        return
    rows = df.collect()
    ids = {r[0] for r in rows}
    assert ids == {r[0] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id").collect()}
    assert number == 4 or len(rows) == len(ids)
    assert all(v is not None for r in rows for v in r)


def test_entry_point_has_all():
    import __spark_entry__

    assert {f"op{n}" for n in COLUMNS} == {q.split("_")[0] for q in QUERIES}
    assert set(QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality", "near_duplicates", "substring_dedup", "mixing", "packing",
    ]
