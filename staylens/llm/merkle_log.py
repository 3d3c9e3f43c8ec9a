"""Merkle manifest of a dataset, kept as postorder append logs.

Every row is a leaf (:func:`with_leaf`). The leaves of a tree (one for each ``lang``) ascend by key; runs of
``FAN`` nodes are hashed into one until one node, the subroot, remains. The subroots, in order, make one
more such tree, whose last node is the root.

1. Aligned builders: the leaves ``WIDTH`` * b to ``WIDTH`` * (b + 1) - 1 of a tree are built by one task,
   which appends each node to its log as soon as its last child is there. A builder's log is one row of
   at most 585 digests. The logs' last nodes are the leaves of the next tier, until each tree has one log.
2. No positions are stored. Before leaf x of a log lie, for each base-8 digit d of x at place j, d whole
   subtrees of (8^(j+1) - 1) / 7 nodes; a node of level h ends h places after its last leaf
   (:func:`position`). This finds the siblings of any node in a log.
3. Proofs go down the tiers: a log's last node passes the siblings above it on to its leaves.

Only digests and keys are shuffled; a text is read and hashed where it lies. Rows are numbered within
ranges of (tree, key), and only the counts of the ranges are summed in order, so a tree that holds most of
the rows is spread over many tasks.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staylens.llm.common import id_crc32, lower_ascii, runs_in_tasks, staged

runs_in_tasks(__name__)

FAN = 8
#: Levels of a builder's log.
LEVELS = 3
#: Leaves of a builder's log.
WIDTH = FAN**LEVELS
_HEX = 64


def digest(text: str) -> str:
    """Lower-case hex SHA-256 of a text."""
    return hashlib.sha256(text.encode("ascii")).hexdigest()


# -- the log of one builder -------------------------------------------------------------------------


def height(n: int) -> int:
    """Levels above ``n`` leaves until one node remains."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FAN), levels + 1
    return levels


def append_log(leaves: list[str], levels: int) -> list[str]:
    """All nodes over ``leaves`` in the order in which they are complete, ``levels`` levels high."""
    log: list[str] = []
    waiting: list[list[str]] = [[] for _ in range(levels + 1)]
    for x, node in enumerate(leaves):
        log.append(node)
        waiting[0].append(node)
        for level in range(levels):
            if len(waiting[level]) < FAN and x < len(leaves) - 1:
                break
            node = digest("".join(waiting[level]))
            waiting[level].clear()
            log.append(node)
            waiting[level + 1].append(node)
    return log


def position(level: int, index: int, leaves: int) -> int:
    """Place of a node in the log over ``leaves`` leaves, from the sizes of the subtrees before it."""
    last = min((index + 1) * FAN**level, leaves) - 1
    before, size = 0, 1
    while last:
        last, d = divmod(last, FAN)
        before += d * size
        size = size * FAN + 1
    return before + level


def siblings(log: list[str], leaves: int, leaf: int, levels: int) -> list[tuple[str, str]]:
    """For each level on the way up from a leaf, the siblings to the left and to the right."""
    out = []
    for level in range(levels):
        count = -(-leaves // FAN**level)
        at = leaf // FAN**level
        first = at - at % FAN
        run = [log[position(level, i, leaves)] for i in range(first, min(first + FAN, count))]
        out.append(("".join(run[: at - first]), "".join(run[at - first + 1 :])))
    return out


def fold(node: str, path: list[tuple[str, str]]) -> str:
    """The root that a leaf and its siblings lead to."""
    for left, right in path:
        node = digest(left + node + right)
    return node


# -- leaves -----------------------------------------------------------------------------------------


def _counted(value: Column) -> Column:
    """``-`` for NULL, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(columns: list[Column]) -> Column:
    return F.sha2(F.concat(*[_counted(c) for c in columns]).cast("binary"), 256)


def with_leaf(docs: DataFrame, *, key: str = "doc_id", tree: str = "lang") -> DataFrame:
    """(tree, key, leaf, tampered) for each row: ``tree`` as text that sorts like the column, NULL first;
    ``tampered`` is the leaf with A-Z of the text in lower case where 3 divides the crc32 of the key,
    else NULL (a NULL key is never tampered with)."""
    plain = [F.col(c) for c in (key, "source", tree, "n_chars", "text")]
    changed = [*plain[:-1], lower_ascii(F.col("text"))]
    return docs.select(
        F.coalesce(F.concat(F.lit("="), F.col(tree).cast("string")), F.lit("-")).alias("tree"),
        F.col(key).cast("long").alias("key"),
        leaf_hash(plain).alias("leaf"),
        F.when(id_crc32(key) % 3 == 0, leaf_hash(changed)).alias("tampered"),
    )


# -- numbering --------------------------------------------------------------------------------------


def _number(batches):
    """Rows sorted by tree, numbered within their tree, as a stream."""
    tree, n = None, 0
    for b in batches:
        at = []
        for t in b.column("tree").to_pylist():
            tree, n = (t, n + 1) if t == tree else (t, 0)
            at.append(n)
        yield b.append_column("at", pa.array(at, pa.int64()))


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``rank`` (from 0, by ``order`` within ``tree``) and ``n``, the rows of the tree."""
    # rows that are equal in all of these may still go to different ranges
    loose = rows.withColumn("tie", F.rand(1))
    sort = ["tree", *order, "tie"]
    ranges = loose.repartitionByRange(*sort).sortWithinPartitions(*sort).withColumn("part", F.spark_partition_id())
    names = [f"{f.name} {f.dataType.simpleString()}" for f in ranges.schema.fields]
    placed = staged(ranges.mapInArrow(_number, ", ".join([*names, "at bigint"])), "ranges")
    counts = placed.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("rows"))
    whole = Window.partitionBy("tree")
    before = counts.select(
        "tree",
        "part",
        (F.sum("rows").over(whole.orderBy("part")) - F.col("rows")).alias("before"),
        F.sum("rows").over(whole).alias("n"),
    )
    found = placed.join(before, ["tree", "part"])
    return found.select(*rows.columns, (F.col("before") + F.col("at")).alias("rank"), "n")


# -- building ---------------------------------------------------------------------------------------

_LOG = "tree string, block long, leaves long, levels int, log string, keys array<bigint>, tampered array<string>"


def _build(table: pa.Table) -> pa.Table:
    """The log of one aligned range of leaves."""
    table = table.sort_by("rank")
    leaves = table.column("leaf").to_pylist()
    n = table.column("n")[0].as_py()
    levels = LEVELS if n > WIDTH else height(n)
    return pa.table(
        {
            "tree": table.column("tree").slice(0, 1),
            "block": pa.array([table.column("rank")[0].as_py() // WIDTH], pa.int64()),
            "leaves": pa.array([len(leaves)], pa.int64()),
            "levels": pa.array([levels], pa.int32()),
            "log": pa.array(["".join(append_log(leaves, levels))]),
            "keys": pa.array([table.column("key").to_pylist()], pa.list_(pa.int64())),
            "tampered": pa.array([table.column("tampered").to_pylist()], pa.list_(pa.string())),
        }
    )


def _logs(leaves: DataFrame, name: str) -> DataFrame:
    """One log for each aligned range of (tree, rank, n, leaf, key, tampered)."""
    block = F.floor(F.col("rank") / WIDTH).alias("block")
    rows = leaves.select("tree", block, "rank", "n", "leaf", "key", "tampered")
    return staged(rows.groupBy("tree", "block").applyInArrow(_build, _LOG), name)


def _next_tier(logs: DataFrame) -> DataFrame:
    """The last nodes of the logs as leaves."""
    n = F.count(F.lit(1)).over(Window.partitionBy("tree"))
    last = F.substring("log", -_HEX, _HEX)
    return logs.select(
        "tree",
        F.col("block").alias("rank"),
        n.alias("n"),
        last.alias("leaf"),
        F.lit(None).cast("long").alias("key"),
        F.lit(None).cast("string").alias("tampered"),
    )


def _tiers(leaves: DataFrame, name: str) -> list[DataFrame]:
    """Logs from the leaves up, until each tree has one."""
    tiers = [_logs(leaves, f"{name}0")]
    while tiers[-1].where("block > 0").limit(1).count():
        tiers.append(_logs(_next_tier(tiers[-1]), f"{name}{len(tiers)}"))
    return tiers


@dataclass
class Manifest:
    """``trees``: tiers of logs of all trees, from the rows up. ``top``: those over the subroots.
    ``order``: (block, under, subroot), the place of each tree among the subroots."""

    trees: list[DataFrame]
    top: list[DataFrame]
    order: DataFrame

    def subroots(self) -> DataFrame:
        """(tree, subroot)."""
        return self.trees[-1].select("tree", F.substring("log", -_HEX, _HEX).alias("subroot"))

    def root(self) -> DataFrame:
        """(root): one row, or none without rows."""
        return self.top[-1].select(F.substring("log", -_HEX, _HEX).alias("root"))


def build(docs: DataFrame, *, key: str = "doc_id", tree: str = "lang") -> Manifest:
    """The manifest of ``docs`` (columns ``source``, ``n_chars`` and ``text`` beside ``key`` and ``tree``).

    NULLs are leaves' values like any other; NULL keys come first. Rows that repeat a key are leaves of
    their own, in the order of their leaf hashes. Further columns aren't read. An empty table has no root."""
    rows = staged(with_leaf(docs, key=key, tree=tree), "leaves")
    trees = _tiers(numbered(rows, ["key", "leaf"]), "log")
    subroots = trees[-1].select(
        F.lit("").alias("tree"),
        F.col("tree").alias("name"),
        F.substring("log", -_HEX, _HEX).alias("leaf"),
        F.lit(None).cast("long").alias("key"),
        F.lit(None).cast("string").alias("tampered"),
    )
    by_name = staged(numbered(subroots, ["name"]), "subroots")
    top = _tiers(by_name.drop("name"), "top")
    order = by_name.select(F.col("rank").alias("block"), F.col("name").alias("under"), F.col("leaf").alias("subroot"))
    return Manifest(trees, top, order)


# -- proofs -----------------------------------------------------------------------------------------

_PATH = "tree string, block long, lefts array<string>, rights array<string>, subroot string, root string"


def _nodes(log: str) -> list[str]:
    return [log[i : i + _HEX] for i in range(0, len(log), _HEX)]


def _paths(batches):
    """The path above each leaf of a tier, from the path above its log."""
    for b in batches:
        for r in b.to_pylist():
            log = _nodes(r["log"])
            above = list(zip(r["lefts"], r["rights"], strict=True))
            paths = [siblings(log, r["leaves"], i, r["levels"]) + above for i in range(r["leaves"])]
            n = len(paths)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r["tree"]] * n, pa.string()),
                    pa.array(range(r["block"] * WIDTH, r["block"] * WIDTH + n), pa.int64()),
                    pa.array([[left for left, _ in p] for p in paths], pa.list_(pa.string())),
                    pa.array([[right for _, right in p] for p in paths], pa.list_(pa.string())),
                    pa.array([r["subroot"]] * n, pa.string()),
                    pa.array([r["root"]] * n, pa.string()),
                ],
                names=["tree", "block", "lefts", "rights", "subroot", "root"],
            )


_PROOF = "key long, leaf string, subroot string, root string, proof string, folded_root string"


def _proofs(batches):
    """A row for each leaf of a log: its siblings' hash and the root that it leads to."""
    for b in batches:
        for r in b.to_pylist():
            log, m = _nodes(r["log"]), r["leaves"]
            above = list(zip(r["lefts"], r["rights"], strict=True))
            out = []
            for i, (key, tampered) in enumerate(zip(r["keys"], r["tampered"], strict=True)):
                path = siblings(log, m, i, r["levels"]) + above
                leaf = log[position(0, i, m)]
                proof = digest("".join(left + right for left, right in path))
                out.append((key, leaf, r["subroot"], r["root"], proof, fold(tampered or leaf, path)))
            kinds = [pa.int64()] + [pa.string()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)],
                names=["key", "leaf", "subroot", "root", "proof", "folded_root"],
            )


def _down(tiers: list[DataFrame], paths: DataFrame) -> DataFrame:
    """The paths above the leaves of the lowest of ``tiers``, from those above the highest."""
    for logs in reversed(tiers):
        rows = logs.drop("keys", "tampered").join(paths, ["tree", "block"])
        paths = rows.mapInArrow(_paths, _PATH)
    return paths


def proofs(manifest: Manifest, *, key: str = "doc_id") -> DataFrame:
    """(key, leaf, subroot, root, proof_sha256, folded_root, verified) for each row of the manifest.

    ``proof_sha256`` is the hash of all siblings on the way to the root. ``folded_root`` comes from the
    row's leaf, or from its tampered leaf where it has one, and the siblings; ``verified`` tells whether
    it equals ``root``."""
    nothing = F.array().cast("array<string>")
    last = F.substring("log", -_HEX, _HEX)
    start = manifest.top[-1].select(
        "tree", "block", nothing.alias("lefts"), nothing.alias("rights"), last.alias("subroot"), last.alias("root")
    )
    to_root = _down(manifest.top, start).select("block", "lefts", "rights", "root")
    above = manifest.order.join(to_root, "block").select(
        F.col("under").alias("tree"), F.lit(0).cast("long").alias("block"), "lefts", "rights", "subroot", "root"
    )
    paths = _down(manifest.trees[1:], above)
    found = manifest.trees[0].join(paths, ["tree", "block"]).mapInArrow(_proofs, _PROOF)
    return found.select(
        F.col("key").alias(key),
        "leaf",
        "subroot",
        "root",
        F.col("proof").alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
