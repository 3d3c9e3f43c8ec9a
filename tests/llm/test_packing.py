import random
import zlib
from collections import Counter, defaultdict

import numpy as np
from llm_rows import ODD_TEXTS, no_docs, odd_docs
from tokenizers import Tokenizer

from staylens.llm import packing as P
from staylens.llm import queries as Q

SMALL = "/root/testdata/sf0.001"


def check_layout(rows, size):
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for places in by_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= size
    return len(by_sequence)


def test_pieces_hold_each_id_once(spark):
    tokenizer = Tokenizer.from_file(Q.tokenizer_path())
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = Q.op9_pack(spark, SMALL).collect()
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
    assert set(by_doc) == set(docs)
    for i, text in docs.items():
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(ids))
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    n = check_layout(rows, P.SIZE)
    tokens = sum(r["length"] for r in rows)
    assert n * P.SIZE - tokens < 0.02 * tokens + P.SIZE


def test_words_give_the_tokenizer_s_ids():
    path = Q.tokenizer_path()
    tokenizer, words = Tokenizer.from_file(path), P.WordIds(path)
    special = ["a<|endoftext|>b <|startoftext|>", "İSTANBUL ΣΑΣ Straße ﬁ ①", "it's I'VE don't 1234 a1b2", "é ẛ̣", "a b c",
               "!!!??? ... $$$ #### 日本語 한국어 😀😀", "\x1c\x1d a\x85b", "x" * 3000]
    for text in [t or "" for _, t in ODD_TEXTS] + special:
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert words.ids(P.bytes_words(text)).tolist() == want, text[:40]


def test_shortest_pack_first_places_every_piece_once():
    rng = random.Random(2)
    for size in (8, 64, 2048):
        histogram = Counter(rng.choice([rng.randint(1, size), size, 1 + size // 3]) for _ in range(3000))
        places = P.shortest_pack_first(histogram, size)
        ranks = defaultdict(list)
        used = Counter()
        for p in places:
            ranks[p.length].append((p.rank, p.rank + p.count * p.copies))
            for n in range(p.count):
                used[p.first + n] += p.length * p.copies
                assert p.offset + p.length * p.copies <= size
        for length, n in histogram.items():
            spans = sorted(ranks[length])
            assert spans[0][0] == 0 and spans[-1][1] == n
            assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
        total = sum(k * n for k, n in histogram.items())
        assert sum(used.values()) == total and max(used.values()) <= size
        assert sorted(used) == list(range(len(used)))
        # as many patterns as the lengths ask for, not as the pieces
        assert len({p.first for p in places}) <= 4 * size


def test_shortest_pack_first_on_one_example():
    # 6 and 5 open packs; the 3s go to the shorter ones first
    places = P.shortest_pack_first({6: 1, 5: 1, 3: 2}, 8)
    packs = defaultdict(list)
    for p in places:
        packs[p.first].append(p.length)
    assert sorted(map(tuple, packs.values())) == [(3,), (5, 3), (6,)]


def test_odd_rows_and_no_rows(spark):
    path = Q.tokenizer_path()
    docs = odd_docs(spark)
    rows = P.pack_documents(docs, path, size=64).collect()
    check_layout(rows, 64)
    starts = [r for r in rows if r["start"] == 0]
    assert len(starts) == docs.count()
    assert sum(r["doc_tokens"] for r in starts) == sum(r["length"] for r in rows)
    assert P.pack_documents(no_docs(spark), path).count() == 0
    ids = P.pieces(docs, path, keep_ids=True).collect()
    assert all(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] for r in ids)
