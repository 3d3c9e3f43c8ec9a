import random

import numpy as np
from llm_rows import no_docs, odd_docs

from staylens.llm import license_scan as S


def test_notices_with_span():
    scanner = S.Scanner(S.TEMPLATES)
    text = "Some words. Released under the MIT License. More words, " + "x " * 50 + "released UNDER the mit license!"
    found = scanner.scan(text, 0.8)
    assert [(m.template, m.matched) for m, _, _ in found] == [("mit-notice", 5)] * 2
    assert [text[a:b] for _, a, b in found] == ["Released under the MIT License", "released UNDER the mit license"]
    assert scanner.scan("The license was released under a bridge by the MIT band.", 0.8) == []


def test_every_template_with_edits():
    scanner, rng = S.Scanner(S.TEMPLATES), random.Random(3)
    for name, text in S.TEMPLATES.items():
        words = text.split()
        for _ in range(max(0, len(words) // 25)):
            i = rng.randrange(3, len(words) - 3)
            rng.choice([lambda: words.pop(i), lambda: words.insert(i, "extra"), lambda: words.__setitem__(i, "other")])()
        found = [m for m, _, _ in scanner.scan("before it " + " ".join(words) + " after it", 0.8) if m.template == name]
        assert len(found) == 1 and found[0].matched >= 0.85 * found[0].words


def test_alignment_matches_full_dynamic_programming():
    """In a wide band the alignment scores as much as an unbanded one."""
    rng = random.Random(7)
    scanner = S.Scanner({"t": " ".join(f"w{i}" for i in range(30))}, band=40)
    t = scanner.templates["t"]
    for _ in range(20):
        words = [x for x in t if rng.random() > 0.1]
        for _ in range(3):
            words.insert(rng.randrange(len(words)), 0)
        full = [[0] * (len(words) + 1) for _ in range(len(t) + 1)]
        for i in range(1, len(t) + 1):
            for j in range(1, len(words) + 1):
                same = 2 if t[i - 1] == words[j - 1] else -1
                full[i][j] = max(0, full[i - 1][j - 1] + same, full[i - 1][j] - 1, full[i][j - 1] - 1)
        assert scanner.align(np.array(words), "t", 0).score == max(map(max, full))


def test_documents_with_a_notice_line(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = {(r["doc_id"], r["template"]) for r in S.scan(docs).collect()}
    lines = {v: k for k, v in S.TEMPLATES.items() if k.endswith("notice")}
    want = {
        (r["doc_id"], lines[line]) for r in docs.collect() for line in (r["text"] or "").split("\n") if line in lines
    }
    assert want and want <= found
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in S.scan(docs).collect():
        assert texts[r["doc_id"]][r["start"] : r["end"]] == r["span"] and r["coverage"] >= S.MIN_COVERAGE


def test_odd_rows_and_no_rows(spark):
    assert S.scan(odd_docs(spark)).count() == 0
    assert S.scan(no_docs(spark)).count() == 0
    twice = spark.createDataFrame([(None, "Released under the MIT License.")] * 2, "doc_id long, text string")
    assert S.scan(twice).count() == 2


def test_copies_side_by_side():
    scanner = S.Scanner(S.TEMPLATES)
    for name in ("mit-notice", "cc-by-nc-4.0-notice", "apache-2.0-notice", "bsd-conditions"):
        text = S.TEMPLATES[name]
        for n in (2, 3, 5):
            found = [(m, a, b) for m, a, b in scanner.scan("\n".join([text] * n), 0.8) if m.template == name]
            assert [m.matched for m, _, _ in found] == [found[0][0].words] * n
            assert [a for _, a, _ in found] == [i * (len(text) + 1) for i in range(n)]


def test_words_inserted_or_cut_in_the_middle():
    scanner = S.Scanner(S.TEMPLATES)
    for name in ("mit", "apache-2.0-header", "gpl-3.0-header"):
        words = S.TEMPLATES[name].split()
        half = len(words) // 2
        for edited, least in (
            (words[:half] + [f"x{i}" for i in range(20)] + words[half:], 1.0),
            (words[:half] + words[half + 10 :], 0.8),
        ):
            text = "before it " + " ".join(edited) + " after it"
            found = [(m, text[a:b]) for m, a, b in scanner.scan(text, 0.8) if m.template == name]
            assert len(found) == 1 and found[0][0].matched >= least * found[0][0].words - 1
            assert found[0][1] == " ".join(edited).rstrip(".")


def test_common_licenses():
    """Every notice line that the documents have, and classes of licenses, worded here."""
    scanner = S.Scanner(S.TEMPLATES)
    for text, want in (
        ("(c) 2020 the group. All rights reserved.", {"all-rights-reserved-notice"}),
        ("this work is of the all rights reserved the work", {"all-rights-reserved-notice"}),
        ("Licensed under CC BY 4.0.", {"cc-by-4.0-notice"}),
        ("Licensed under CC BY-NC 4.0.", {"cc-by-nc-4.0-notice"}),
        ("Licensed under CC BY-SA 4.0.", {"cc-by-sa-4.0-notice"}),
        ("This work is licensed under the GNU General Public License, version 2.", {"gpl-2.0-notice"}),
        ("This work is licensed under the GNU General Public License, version 3.", {"gpl-3.0-notice"}),
        ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", {"cc-by-sa-4.0"}),
    ):
        assert {m.template for m, _, _ in scanner.scan(f"so it is\n{text}\nand on", 0.8)} == want, text
    for name in ("apache-2.0", "gpl-2.0", "gpl-3.0", "lgpl-2.1", "lgpl-3.0", "mpl-2.0", "cc0-1.0", "bsd-3-clause", "isc",
                 "unlicense", "mit-warranty", "bsd-disclaimer", "gpl-2.0-header", "agpl-3.0-header", "lgpl-2.1-header"):
        assert name in {m.template for m, _, _ in scanner.scan("so\n" + S.TEMPLATES[name] + "\non", 0.8)}, name


def test_notice_lines_of_the_documents(spark):
    """The short lines that several documents share and that speak of licenses or rights, not taken from TEMPLATES."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("text rlike '(?i)licen[sc]e|rights reserved'")
    held = {}
    for r in docs.collect():
        for line in set(r["text"].split("\n")):
            low = line.lower()
            if len(line) < 100 and ("license" in low or "rights reserved" in low):
                held.setdefault(line, []).append(r["doc_id"])
    shared = {line for line, ids in held.items() if len(ids) > 20}
    assert len(shared) >= 5
    found = {}
    for r in S.scan(docs).collect():
        found.setdefault(r["doc_id"], []).append(r["span"])
    for line in shared:
        assert all(any(span in line for span in found.get(i, ())) for i in held[line]), line


def test_spans_where_lower_case_changes_the_length():
    text = "İİİ İstanbul Released under the MIT License. tail words here"
    (m, start, end), *rest = S.Scanner(S.TEMPLATES).scan(text, 0.8)
    assert (text[start:end], rest) == ("Released under the MIT License", [])
    assert S.template_words("İstanbul") == ["İstanbul".lower()]


def test_ten_thousand_adjacent_notices():
    import time

    notice = "Released under the MIT License."
    text = " ".join([notice] * 10_000)
    begin = time.monotonic()
    found = S.Scanner(S.TEMPLATES).scan(text, 0.8)
    assert time.monotonic() - begin < 60
    assert [start for _, start, _ in found] == [i * (len(notice) + 1) for i in range(10_000)]
    assert {text[start:end] for _, start, end in found} == {notice[:-1]}


def test_a_long_text_of_license_phrases():
    import random
    import time

    rng = random.Random(1)
    phrases = []
    for t in S.TEMPLATES.values():
        w = t.split()
        phrases += [" ".join(w[i : i + 12]) for i in range(0, len(w), 12)]
    text = " ".join(rng.choices(phrases, k=4000)) + " " + S.TEMPLATES["gpl-2.0"]
    begin = time.monotonic()
    found = S.Scanner(S.TEMPLATES).scan(text, 0.8)
    assert time.monotonic() - begin < 90
    assert any(
        m.template == "gpl-2.0" and m.matched == m.words for m, _, _ in found
    )


def test_ascending_hits_against_brute_force():
    import itertools
    import random

    rng = random.Random(2)
    for _ in range(60):
        hits = sorted({(rng.randrange(8), rng.randrange(8)) for _ in range(rng.randrange(1, 9))})
        got = S._ascending(hits)
        for h in hits:
            best = 0
            for n in range(1, len(hits) + 1):
                for c in itertools.combinations(hits, n):
                    if c[-1] == h and all(a[0] < b[0] and a[1] < b[1] for a, b in zip(c, c[1:])):
                        best = max(best, n)
            assert got[h] == best


def test_no_template_is_lost_to_its_size():
    """Every tenth word changed, in templates of all lengths."""
    scanner = S.Scanner(S.TEMPLATES)
    for name, text in S.TEMPLATES.items():
        w = S.template_words(text)
        if len(w) < 25:  # in short ones the changed word may be all that tells two templates apart
            continue
        for i in range(9, len(w), 10):
            w[i] = f"changed{i}"
        found = scanner.scan("some words before " + " ".join(w) + " and after", 0.8)
        assert any(m.matched >= 0.85 * m.words and m.words == len(w) for m, _, _ in found), name
