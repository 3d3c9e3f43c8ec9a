"""DuckDB SQL for the queries that SQL can express, over the same Parquet tables."""

from __future__ import annotations

WORD_RE = r"[^\x20\x09-\x0D]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def mixing_sql(targets: dict[str, dict[str, float]], share: float, sweeps: int, seed: str) -> str:
    """Iterative proportional fitting as a chain of windows, one for each margin and sweep."""
    dims = list(targets)
    topic = (
        "CASE WHEN contains(coalesce(text, ''), ' | ') THEN 'table' WHEN length(coalesce(text, '')) < 1500 THEN 'note' "
        "WHEN length(coalesce(text, '')) < 8000 THEN 'article' ELSE 'long' END"
    )
    parts = [
        f"d AS (SELECT doc_id, source, lang, {topic} AS topic, "
        f"len(regexp_extract_all(coalesce(text, ''), '{WORD_RE}'))::BIGINT AS n_tokens FROM documents)"
    ]

    def cat(dim: str) -> str:
        return f"CASE WHEN {dim} IN ({', '.join(repr(v) for v in targets[dim])}) THEN {dim} ELSE '*' END AS c_{dim}"

    parts.append(f"k AS (SELECT *, {', '.join(map(cat, dims))} FROM d)")

    def goal(dim: str) -> str:
        rest = max(0.0, 1.0 - sum(targets[dim].values()))
        cases = " ".join(f"WHEN c_{dim} = '{v}' THEN {s!r}::DOUBLE" for v, s in targets[dim].items())
        return f"CASE {cases} ELSE {rest!r}::DOUBLE END AS t_{dim}"

    keys = ", ".join(f"c_{d}" for d in dims)
    parts.append(f"c AS (SELECT {keys}, sum(n_tokens)::DOUBLE AS tokens FROM k GROUP BY {keys} HAVING sum(n_tokens) > 0)")
    parts.append(
        f"w0 AS MATERIALIZED (SELECT *, tokens AS w, sum(tokens) OVER () * {share!r}::DOUBLE AS wanted, "
        f"{', '.join(map(goal, dims))} FROM c)"
    )
    step = 0
    for _ in range(sweeps):
        for dim in dims:
            parts.append(
                f"s{step} AS MATERIALIZED (SELECT *, sum(w) OVER (PARTITION BY c_{dim}) AS now FROM w{step}), "
                f"w{step + 1} AS MATERIALIZED (SELECT * EXCLUDE (w, now), "
                f"least(CASE WHEN now > 0 THEN w * t_{dim} * wanted / now ELSE 0 END, tokens) AS w FROM s{step})"
            )
            step += 1
    parts.append(f"p AS (SELECT {keys}, w / tokens AS p FROM w{step})")
    uniform = f"('0x' || substr(md5('{seed}:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT / {float(16**13)!r}::DOUBLE"
    return (
        f"WITH {', '.join(parts)} SELECT doc_id, source, lang, topic, n_tokens, round(coalesce(p, 0), 9) AS probability, "
        f"({uniform}) < coalesce(p, 0) AS kept FROM k LEFT JOIN p USING ({keys})"
    )


def _crc32_steps() -> list[int]:
    """The effect of each of the 16 half bytes, from the polynomial."""
    out = []
    for value in range(16):
        for _ in range(4):
            value = (value >> 1) ^ (0xEDB88320 if value & 1 else 0)
        out.append(value)
    return out


def crc32_sql(digits: str) -> str:
    """crc32 of bytes given as the column ``digits`` in hex, half a byte at a time."""
    steps = f"[{', '.join(f'{x}::BIGINT' for x in _crc32_steps())}]"
    listed = f"list_transform(regexp_extract_all({digits}, '..'), lambda x: ('0x' || x)::BIGINT)"
    low = f"xor(a >> 4, {steps}[(xor(a, x) & 15) + 1])"
    both = f"xor({low} >> 4, {steps}[(xor({low}, x >> 4) & 15) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {listed}), lambda a, x: {both}), 4294967295::BIGINT)"


def sharding_sql(shards: int) -> str:
    """Jump consistent hashing with the jumps unrolled, and slots by one window for each shard."""
    word = "18446744073709551616::HUGEINT"
    parts = [
        "x AS MATERIALIZED (SELECT doc_id, hex(encode(coalesce(text, ''))) AS digits FROM documents)",
        "d AS MATERIALIZED (SELECT doc_id, md5(coalesce(doc_id::VARCHAR, '')) AS h, length(digits) // 2 + 1 AS size, "
        f"{crc32_sql('digits')} AS text_crc32 FROM x)",
        "j0 AS (SELECT *, ('0x' || substr(h, 1, 15))::BIGINT::HUGEINT AS k, 0::BIGINT AS j, 0::BIGINT AS a, 0::BIGINT AS b FROM d)",
    ]
    for i in range(shards + 1):
        parts.append(
            f"k{i} AS (SELECT * EXCLUDE (k), (k * 2862933555777941757::HUGEINT + 1) % {word} AS k FROM j{i}), "
            f"j{i + 1} AS (SELECT * EXCLUDE (j, a, b), "
            f"floor((j + 1)::DOUBLE * (2147483648::DOUBLE / ((k // 8589934592::HUGEINT)::DOUBLE + 1)))::BIGINT AS j, "
            f"CASE WHEN j < {shards} THEN j ELSE a END AS a, CASE WHEN j < {shards + 1} THEN j ELSE b END AS b "
            f"FROM (SELECT * FROM k{i}))"
        )
    return (
        f"WITH {', '.join(parts)} SELECT doc_id, size, text_crc32, 'key' AS law, a::INT AS shard, "
        "row_number() OVER (PARTITION BY a ORDER BY substr(h, 1, 3), doc_id, text_crc32, size) - 1 AS slot, "
        f"b::INT AS grown_shard FROM j{shards + 1}"
    )


def jaccard_sql(n: int, percent: int) -> str:
    """All pairs that share an n-gram, their exact overlap, and reachability over the links."""
    joined = " || ' ' || ".join(f"w[i + {k}]" for k in range(n))
    return f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{WORD_RE}') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= {n} THEN list_transform(range(1, len(w) - {n - 2}), lambda i: {joined})
  WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * o >= {percent} * (nx.n + ny.n - o)),
e AS (SELECT x, y FROM l UNION SELECT y, x FROM l),
r AS (SELECT doc_id, doc_id AS z FROM documents UNION SELECT r.doc_id, e.y FROM r JOIN e ON e.x = r.z)
SELECT doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(z) AS component_id
FROM r LEFT JOIN n USING (doc_id) GROUP BY doc_id"""


def _merkle_levels(levels: int, start: str, tree: str, prefix: str) -> list[str]:
    """One table for each level of 8-ary hashing: of each node its digest, the run's digests and its place."""
    parts = [f"{prefix}0 AS MATERIALIZED ({start})"]
    for i in range(levels):
        parts.append(
            f"{prefix}r{i} AS MATERIALIZED (SELECT {tree}, x // 8 AS x, list(d ORDER BY x) AS run, any_value(n) AS n "
            f"FROM {prefix}{i} GROUP BY {tree}, x // 8), "
            f"{prefix}{i + 1} AS MATERIALIZED (SELECT {tree}, x, (n + 7) // 8 AS n, run, "
            f"CASE WHEN n > 1 THEN sha256(array_to_string(run, '')) ELSE run[1] END AS d FROM {prefix}r{i})"
        )
    return parts


def merkle_sql(levels: int = 9, top_levels: int = 3) -> str:
    """All levels of the trees unrolled; a run of one node at the end of a level is hashed, a lone node isn't."""

    def counted(value: str) -> str:
        return f"coalesce(strlen({value}::VARCHAR)::VARCHAR || ':' || {value}::VARCHAR, '-')"

    def leaf(text: str) -> str:
        return f"sha256({' || '.join(map(counted, ('doc_id', 'source', 'lang', 'n_chars', text)))})"

    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    parts = [
        f"h AS MATERIALIZED (SELECT *, coalesce('=' || lang, '-') AS tree, {leaf('text')} AS leaf, "
        f"hex(encode(doc_id::VARCHAR)) AS digits FROM documents)",
        f"l AS MATERIALIZED (SELECT doc_id, tree, leaf, "
        f"CASE WHEN {crc32_sql('digits')} % 3 = 0 THEN {leaf(low)} ELSE leaf END AS now, "
        "row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS x, "
        "count(*) OVER (PARTITION BY tree) AS n FROM h)",
        *_merkle_levels(levels, "SELECT tree, x, n, leaf AS d, NULL::VARCHAR[] AS run FROM l", "tree", "a"),
        f"s AS MATERIALIZED (SELECT tree, d AS subroot, 0 AS one, row_number() OVER (ORDER BY tree) - 1 AS x, "
        f"count(*) OVER () AS n FROM a{levels})",
        *_merkle_levels(top_levels, "SELECT one, x, n, subroot AS d, NULL::VARCHAR[] AS run FROM s", "one", "b"),
    ]
    # fold every leaf upwards: f is the folded node, p the siblings so far, c the place at the level
    parts.append("f0 AS (SELECT doc_id, tree, leaf, now AS f, '' AS p, x AS c, n FROM l)")
    step = 0

    def up(run_table: str, join: str, keep: str) -> None:
        nonlocal step
        place = "CAST(c % 8 AS BIGINT)"
        left = f"array_to_string(run[1:{place}], '')"
        right = f"array_to_string(run[{place} + 2:], '')"
        parts.append(
            f"f{step + 1} AS MATERIALIZED (SELECT {keep}, CASE WHEN q.n > 1 THEN sha256({left} || q.f || {right}) ELSE q.f END AS f, "
            f"CASE WHEN q.n > 1 THEN q.p || {left} || {right} ELSE q.p END AS p, q.c // 8 AS c, (q.n + 7) // 8 AS n "
            f"FROM f{step} q JOIN {run_table} r ON {join} AND r.x = q.c // 8)"
        )
        step += 1

    for i in range(levels):
        up(f"ar{i}", "r.tree = q.tree", "q.doc_id, q.tree, q.leaf")
    parts.append(
        f"f{step + 1} AS MATERIALIZED (SELECT q.doc_id, q.leaf, s.subroot, q.f, q.p, s.x AS c, s.n FROM f{step} q JOIN s ON s.tree = q.tree)"
    )
    step += 1
    for i in range(top_levels):
        up(f"br{i}", "true", "q.doc_id, q.leaf, q.subroot")
    return (
        f"WITH {', '.join(parts)} SELECT q.doc_id, q.leaf, q.subroot, b.d AS root, sha256(q.p) AS proof_sha256, "
        f"q.f AS folded_root, q.f = b.d AS verified FROM f{step} q CROSS JOIN b{top_levels} b"
    )


def ranked_search_sql(k: int) -> str:
    """Every document with a term of an item, scored in full."""
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    found = f"unnest(regexp_extract_all({low}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term"
    return f"""
WITH t AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, {found} FROM documents) GROUP BY 1, 2),
n AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM t GROUP BY 1),
s AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS all_terms FROM n),
f AS (SELECT term, count(*) AS df FROM t GROUP BY 1),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM f, s),
m AS (SELECT doc_id, 100 - 75 + ((75 * n * n_docs) // all_terms) AS m FROM n, s),
q AS (SELECT item_id, term, count(*) AS q FROM (SELECT item_id, {found} FROM benchmark) GROUP BY 1, 2),
r AS (SELECT item_id, doc_id, sum(q * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM q JOIN t USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY 1, 2),
o AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
  FROM r WHERE score > 0)
SELECT * FROM o WHERE rank <= {k}"""


def minhash_sql(n: int, percent: int) -> str:
    """The links on full sets, as for the n-gram Jaccard join, and which rows are their component's smallest."""
    return f"SELECT *, doc_id = component_id AS kept FROM ({jaccard_sql(n, percent)})"
