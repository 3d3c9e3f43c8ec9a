from collections import defaultdict

import corpus_pipeline as CP
from llm_rows import no_docs, odd_docs
from test_jaccard_join import brute
from test_packing import check_layout
from test_quality_llr import stats

from staylens.llm import packing

DIR = "/root/testdata/sf0.01"


def test_stages_over_the_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{DIR}/labels.parquet").collect()}
    rows = [{r["doc_id"]: r for r in docs.collect()}]
    for i, (_, stage) in enumerate(CP.STAGES):
        out = stage(spark, docs, DIR)
        if i < 4:
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        if i < 4:
            kept = docs.collect()
            assert len({r["doc_id"] for r in kept}) == len(kept)
            assert all(rows[-1][r["doc_id"]] == r for r in kept)
            rows.append({r["doc_id"]: r for r in kept})
    given, good, clean, single, mixed = rows
    assert not any(stats(r["text"])[-1] for r in good.values())
    judged = [i for i in given if i in labels and not stats(given[i]["text"])[-1]]
    # in 1,000 documents one of 27 bad ones is too near to the corpus; no good one may go
    assert all(i in good for i in judged if labels[i]["quality"])
    bad = [i for i in judged if not labels[i]["quality"]]
    assert sum(i not in good for i in bad) >= 0.9 * len(bad)
    toxic = [i for i in good if i in labels and labels[i]["toxic"]]
    assert sum(i not in clean for i in toxic) >= 0.75 * len(toxic)
    assert all(i in clean for i in good if i in labels and not labels[i]["toxic"])
    want = brute([(i, r["text"]) for i, r in clean.items()])
    assert set(single) == {i for i, c in want.items() if i == c}
    assert 0.2 * len(single) < len(mixed) < 0.6 * len(single)
    packed = docs.collect()
    check_layout(packed, packing.SIZE)
    lengths = defaultdict(int)
    for r in packed:
        lengths[r["doc_id"]] += r["length"]
    assert set(lengths) == set(mixed)
    assert all(lengths[r["doc_id"]] == r["doc_tokens"] for r in packed)


def test_run_returns_the_last_stage(spark):
    out = CP.run(spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert out.count() > 0


def test_odd_rows_and_no_rows(spark):
    for docs in (odd_docs(spark), no_docs(spark)):
        for i, (_, stage) in enumerate(CP.STAGES):
            out = stage(spark, docs, "/root/testdata/sf0.001")
            rows = out.collect()
            if i < 4:
                assert out.columns == docs.columns
                own = [r.asDict() for r in docs.collect()]
                assert all(r.asDict() in own for r in rows)
            if not own:
                assert not rows
