"""Column functions against hand-worked inputs, and properties over random texts."""

import random
import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from staylens.functions import amenity_list, amenity_tokens_raw, money_a, money_b, text_tokens

ALPHABET = "abcXYZ09 '-&.,$\t\n{}\"/éÉßΩ€İ!?"

# text -> (tokens, cleaned amenities, raw amenities), worked by hand
TABLE = [
    ("", [""], [""], [""]),
    ("Sunny LOFT, 2 beds!", ["sunny", "loft", "2", "beds"], ["sunny loft", " 2 beds"], ["Sunny LOFT", " 2 beds!"]),
    ("{TV,\"Wi Fi\"}", ["tv", "wi", "fi"], ["tv", "wi fi"], ["TV", "Wi Fi"]),
    ("R&B  rock-n-roll's", ["r&b", "rock-n-roll's"], ["rb  rock-n-roll's"], ["R&B  rock-n-roll's"]),
    ("é…€", [""], [""], ["é…€"]),
    ("İ\u212a", ["ik"], ["ik"], ["İ\u212a"]),
    ("a\tb\nc", ["a", "b", "c"], ["abc"], ["a\tb\nc"]),
    ("{}", [""], [""], [""]),
    ("Pool/Spa,,24-Hour", ["pool", "spa", "24-hour"], ["pool/spa", "", "24-hour"], ["Pool/Spa", "", "24-Hour"]),
]

MONEY = [
    ("$1,234.50", 1234.5, 1234.5),
    ("$5", 5.0, 5.0),
    ("USD 20", None, 20.0),
    ("-$5", -5.0, 5.0),
    ("1.2.3", None, None),
    ("call us", None, None),
    ("", None, None),
    (None, None, None),
]


def test_hand_worked_texts(spark):
    df = spark.createDataFrame([(i, t) for i, (t, *_) in enumerate(TABLE)], "i int, t string")
    got = df.select("i", text_tokens("t"), amenity_list("t"), amenity_tokens_raw("t")).collect()
    for r in got:
        _, tokens, cleaned, raw = TABLE[r[0]]
        assert r[1] == tokens and r[3] == raw, TABLE[r[0]]
        if "İ" not in TABLE[r[0]][0]:  # a dotted capital leaves a combining dot when lower-cased whole
            assert r[2] == cleaned, TABLE[r[0]]


def test_hand_worked_prices(spark):
    df = spark.createDataFrame([(i, p) for i, (p, *_) in enumerate(MONEY)], "i int, p string")
    for r in df.select("i", money_a("p"), money_b("p")).collect():
        assert (r[1], r[2]) == MONEY[r[0]][1:], MONEY[r[0]]


def test_token_properties(spark):
    rnd = random.Random(11)
    data = [("".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 40))),) for _ in range(400)]
    df = spark.createDataFrame(data, "t string")
    again = F.array_join("tok", " ")
    got = df.select("t", text_tokens("t").alias("tok")).select("t", "tok", text_tokens(again).alias("twice")).collect()
    for r in got:
        assert r["tok"] == r["twice"], r["t"]  # tokens of the joined tokens are the tokens
        assert all(re.fullmatch("[0-9a-z'&-]+", x) for x in r["tok"]) or r["tok"] == [""]
        # every token character of the text is in a token, as often as in the text
        want = Counter(c.lower() for c in r["t"] if re.match("[0-9A-Za-z'&-]", c)) + Counter("i" * r["t"].count("İ"))
        assert Counter("".join(r["tok"])) == want, r["t"]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(0, 10**9), min_size=1, max_size=60))
def test_written_prices_parse_back(spark, cents):
    df = spark.createDataFrame([(c, f"${c / 100:,.2f}") for c in cents], "c long, p string")
    for r in df.select("c", money_a("p").alias("a"), money_b("p").alias("b")).collect():
        assert r["a"] == r["b"] == float(f"{r['c'] / 100:.2f}")
