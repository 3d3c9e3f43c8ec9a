import hashlib
from collections import Counter

from llm_rows import no_docs, odd_docs

from staylens.llm import mixing as M
from staylens.llm import queries as Q

TARGETS = {"source": {"a": 0.5, "b": 0.3}, "lang": {"en": 0.7, "fr": 0.3}}


def table(spark):
    rows = []
    for i in range(400):
        source = "a" if i % 3 == 0 else "b" if i % 3 == 1 else f"other{i % 5}"
        lang = "en" if i % 4 else "fr"
        rows.append((i, " ".join(["w"] * (1 + i * 7 % 23)), source, lang))
    return spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")


def rake(tokens, targets, share, sweeps):
    """The same fitting over a dictionary of cells."""
    dims = list(targets)
    weight = {c: float(t) for c, t in tokens.items()}
    wanted = sum(tokens.values()) * share
    for _ in range(sweeps):
        for k, dim in enumerate(dims):
            now = Counter()
            for c, w in weight.items():
                now[c[k]] += w
            for c in weight:
                goal = targets[dim].get(c[k], max(0.0, 1 - sum(targets[dim].values())))
                weight[c] = min(weight[c] * goal * wanted / now[c[k]] if now[c[k]] else 0.0, float(tokens[c]))
    return {c: weight[c] / tokens[c] for c in tokens}


def test_probabilities_against_brute_force(spark):
    docs = table(spark)
    rows = M.with_probability(docs, TARGETS, share=0.3).collect()

    def cell(r):
        return tuple(r[d] if r[d] in TARGETS[d] else M.REST for d in TARGETS)

    tokens = Counter()
    for r in rows:
        assert r["n_tokens"] == len(r["text"].split())
        tokens[cell(r)] += r["n_tokens"]
    want = rake(tokens, TARGETS, 0.3, M.SWEEPS)
    for r in rows:
        assert abs(r["probability"] - want[cell(r)]) < 1e-9
        u = int(hashlib.md5(f"{M.SEED}:{r['doc_id']}".encode()).hexdigest()[:13], 16) / 16**13
        assert r["kept"] == (u < r["probability"])
    # the expected shares are the targets
    total = sum(r["n_tokens"] * r["probability"] for r in rows)
    assert abs(total / sum(tokens.values()) - 0.3) < 1e-3
    for k, dim in enumerate(TARGETS):
        for value, share in TARGETS[dim].items():
            mass = sum(r["n_tokens"] * r["probability"] for r in rows if cell(r)[k] == value)
            assert abs(mass / total - share) < 1e-3


def test_a_scarce_cell_is_never_asked_for_more_than_it_has(spark):
    docs = table(spark)
    rows = M.with_probability(docs, {"source": {"other1": 0.9, "a": 0.1}}, share=0.5).collect()
    assert max(r["probability"] for r in rows) == 1.0
    assert all(r["kept"] for r in rows if r["probability"] == 1.0)


def test_odd_rows_and_no_rows(spark):
    docs = odd_docs(spark)
    out = M.with_probability(docs, TARGETS)
    assert out.count() == docs.count()
    assert [c for c in out.columns if c == "kept"] == ["kept"]
    assert out.where("probability is null or kept is null or n_tokens is null").count() == 0
    assert M.with_probability(no_docs(spark), TARGETS).count() == 0
    # the verdict is one for all rows of a key
    assert out.where("doc_id = 3").select("kept").distinct().count() == 1


def _mix(spark, tmp_path, place):
    """op5_mix over 900 documents whose (source, lang) is ``place`` of their number."""
    rows = [(i, " ".join(["w"] * (1 + i * 7 % 900)), *place(i)) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = Q.op5_mix(spark, str(tmp_path)).collect()
    total = sum(r["n_tokens"] for r in rows)
    return rows, sum(r["n_tokens"] * r["probability"] for r in rows) / total


def test_unlisted_and_null_values_are_drawn(spark, tmp_path):
    places = [("src0", "en"), ("books", "en"), (None, "fr"), ("src1", "pt"), ("src2", None), (None, None)]
    rows, _ = _mix(spark, tmp_path, lambda i: places[i % 6])
    assert all(r["probability"] > 0 for r in rows)
    for k, dim in enumerate(("source", "lang")):
        for value in {place[k] for place in places}:
            assert any(r["kept"] for r in rows if r[dim] == value), (dim, value)


def test_a_corpus_of_unlisted_values_only_fills_the_sample(spark, tmp_path):
    rows, share = _mix(spark, tmp_path, lambda i: ("books" if i % 2 else None, None if i % 3 else "pt"))
    assert sum(r["kept"] for r in rows) > 100
    assert abs(share - sum(min(M.KEEP_SHARE * t, have) for t, have in _topics(rows))) < 1e-3


def _topics(rows):
    """(target share, share of the tokens) of each topic."""
    total = sum(r["n_tokens"] for r in rows)
    return [(t, sum(r["n_tokens"] for r in rows if r["topic"] == v) / total) for v, t in Q.TOPIC_SHARES.items()]
