"""The registered queries run over whole tables, and agree with DuckDB where there is SQL."""

import os

import duckdb
import pytest

from staylens.llm import queries as Q

SMALL = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_class_lm": {"doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"},
    "op2_quality_llr": {
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    },
    "op3_line_blocks": {"page_id", "url", "text", "n_chars"},
    "op4_license_scan": {"doc_id", "template", "coverage", "start", "end", "span"},
    "op5_mix": {"doc_id", "probability", "kept"},
    "op6_order_minhash": {
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"
    },
    "op7_jump_hash": {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"},
    "op8_toxicity": {"doc_id", "held_out", "score", "predicted"},
    "op9_pack": {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"},
    "op10_jaccard": {"doc_id", "n_shingles", "component_id"},
    "op11_ranked_search": {"item_id", "rank", "doc_id", "score"},
    "op12_minhash": {"doc_id", "n_shingles", "component_id", "kept"},
    "op13_merkle_log": {"doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"},
}


def test_entry_lists_all():
    import __spark_entry__ as E

    assert set(COLUMNS) | {"pipeline"} <= set(E.queries())
    assert set(Q.ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("key", sorted(COLUMNS))
def test_whole_table(spark, key):
    df = Q.QUERIES[key](spark, SMALL)
    assert COLUMNS[key] <= set(df.columns)
    rows = df.collect()
    table, name = ("pages", "page_id") if key.startswith("op3") else ("documents", "doc_id")
    ids = sorted(r[0] for r in spark.read.parquet(f"{SMALL}/{table}.parquet").select(name).collect())
    got = [r[name] for r in rows]
    if key in ("op4_license_scan", "op11_ranked_search"):
        assert set(got) <= set(ids)
    elif key == "op9_pack":
        assert sorted(set(got)) == ids
    else:
        assert sorted(got) == ids


@pytest.mark.parametrize("key", sorted(Q.ORACLE))
def test_oracle(spark, key):
    con = duckdb.connect()
    for t in os.listdir(SMALL):
        con.execute(f"CREATE VIEW {t.removesuffix('.parquet')} AS SELECT * FROM '{SMALL}/{t}'")
    df = Q.QUERIES[key](spark, SMALL)
    cols = sorted(df.columns)
    cur = con.execute(Q.ORACLE[key])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    want = sorted(tuple(repr(r[names.index(c)]) for c in cols) for r in cur.fetchall())
    assert sorted(tuple(repr(r[c]) for c in cols) for r in df.collect()) == want
