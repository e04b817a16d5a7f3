"""A Merkle manifest of a dataset: one tree a source, and a tree of the sources' roots.

Leaves are appended in order to aligned blocks of 256. A block keeps its open runs of
16 at every level; an append attaches the new node to the open run below it, and the
sibling that completes a run gives all its nodes their witnesses at that level and is
itself appended one level up. A block that is done is one row: its levels, which are
the partial witnesses of all its leaves. Block roots are appended to further blocks in
the same way, by Spark, until a source has one root; what those blocks hold extends
the witnesses below.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.sinks.staging import Staging
from llm.batches import small_batches
from llm.ordering import numbered
from llm.shipping import ship

RUN = 16
# Levels of runs in a block: its full size is RUN ** HEIGHT.
HEIGHT = 2
BLOCK = RUN**HEIGHT
HEX = 64
# Blocks that travel to a Python worker at once.
BLOCKS_AT_ONCE = 200
TAMPER_FOLD = 5
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLOCK_SCHEMA = "grp long, block long, size long, alone boolean, levels array<string>, root string"


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


class Appender:
    """A tree that grows node by node; ``levels[i]`` has all nodes of level i, leaves first."""

    def __init__(self) -> None:
        self.levels: list[list[str]] = [[]]

    def append(self, node: str, level: int = 0) -> None:
        """Attach ``node`` to the open run of its level; the last of a run goes on as their hash."""
        if level == len(self.levels):
            self.levels.append([])
        nodes = self.levels[level]
        nodes.append(node)
        if len(nodes) % RUN == 0:
            self.append(digest(*nodes[-RUN:]), level + 1)

    def close(self, height: int | None = None) -> str:
        """End the open runs and return the root: the node at ``height``, or the only one that is left."""
        level = 0
        while level != height if height is not None else len(self.levels[level]) > 1:
            rest = len(self.levels[level]) % RUN
            if rest:
                self.append(digest(*self.levels[level][-rest:]), level + 1)
            level += 1
        del self.levels[level + 1 :]
        return self.levels[level][0]


def siblings(levels: list[str], at: int) -> list[tuple[str, str]]:
    """Nodes before and after the path of leaf ``at`` in its runs, level by level below the root."""
    out = []
    for nodes in levels[:-1]:
        begin = at - at % RUN
        out.append((nodes[HEX * begin : HEX * at], nodes[HEX * (at + 1) : HEX * (begin + RUN)]))
        at //= RUN
    return out


def fold(node: str, witness: list[tuple[str, str]]) -> str:
    """The root that a leaf and its siblings give."""
    for before, after in witness:
        node = digest(before, node, after)
    return node


def _build(table: pa.Table) -> pa.Table:
    """A block of the nodes at consecutive places; the only one of its tree ends at its single root."""
    rows = table.select(["place", "node", "alone"]).sort_by("place")
    tree, alone = Appender(), rows.column("alone")[0].as_py()
    for node in rows.column("node").to_pylist():
        tree.append(node)
    root = tree.close(None if alone else HEIGHT)
    return pa.table(
        {
            "grp": table.column("grp")[:1].cast(pa.int64()),
            "block": pa.array([rows.column("place")[0].as_py() // BLOCK], pa.int64()),
            "size": pa.array([table.num_rows], pa.int64()),
            "alone": pa.array([alone]),
            "levels": pa.array([["".join(nodes) for nodes in tree.levels]], pa.list_(pa.string())),
            "root": pa.array([root]),
        }
    )


def blocks_of(nodes: DataFrame) -> DataFrame:
    """Blocks (grp, block, size, alone, levels, root) of ``nodes`` (grp, place, node, total)."""
    block = F.floor(F.col("place") / BLOCK)
    rows = nodes.select("grp", "place", "node", (F.col("total") <= BLOCK).alias("alone"), block.alias("block"))
    return rows.groupBy("grp", "block").applyInArrow(_build, BLOCK_SCHEMA)


def grown(leaves: DataFrame, stage: Staging, name: str) -> list[DataFrame]:
    """The rounds of blocks over ``leaves`` (grp, place, node, total), until each group has one root.

    A round has a 256th of the rows of the one before; the number of rounds follows from
    the largest group.
    """
    rounds = []
    while True:
        blocks = stage(blocks_of(leaves), f"{name}-{len(rounds)}")
        rounds.append(blocks)
        rest = blocks.where("not alone")
        if rest.isEmpty():
            return rounds
        totals = rest.groupBy("grp").agg(F.count("*").alias("total"))
        leaves = rest.select("grp", F.col("block").alias("place"), F.col("root").alias("node")).join(totals, "grp")


WITNESS = "array<struct<before: string, after: string>>"
ENTRIES = f"grp long, block long, witness {WITNESS}, top string"


def _witness_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each entry of a block: its place, its whole witness and the root."""
    for batch in batches:
        for row in batch.to_pylist():
            above = [(w["before"], w["after"]) for w in row["witness"] or ()]
            places, found = [], []
            for at in range(row["size"]):
                places.append(row["block"] * BLOCK + at)
                found.append([{"before": b, "after": a} for b, a in siblings(row["levels"], at) + above])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row["grp"]] * len(places), pa.int64()),
                    pa.array(places, pa.int64()),
                    pa.array(found, pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))),
                    pa.array([row["top"]] * len(places), pa.string()),
                ],
                names=["grp", "block", "witness", "top"],
            )


def extended(rounds: list[DataFrame], stage: Staging, name: str) -> DataFrame:
    """The first round's blocks with the witness of each above it and its group's root (``top``).

    From the last round down: a block's entries take its witness and their own siblings
    within it. Blocks that stand alone need none.
    """
    above = None
    for number in range(len(rounds) - 1, -1, -1):
        blocks = rounds[number]
        none = F.lit(None).cast(WITNESS)
        found = blocks.where("alone").select("*", none.alias("witness"), F.col("root").alias("top"))
        if above is not None:
            found = found.unionByName(blocks.where("not alone").join(above, ["grp", "block"]))
        if number == 0:
            return found
        above = stage(found.mapInArrow(_witness_batches, ENTRIES), f"{name}-above-{number}")
    raise ValueError("no rounds")


def leaf(text: Column) -> Column:
    """H of a document's values, each as its length in bytes and itself; ``text`` stands in for its text."""
    parts = []
    for name in FIELDS:
        value = (text if name == "text" else F.col(name)).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def _leaves(docs: DataFrame) -> DataFrame:
    """doc_id, source, node, and the leaf of the tampered text where there is one."""
    kinds = {"doc_id": "long", "source": "string", "lang": "string", "n_chars": "long", "text": "string"}
    own = docs.select(*(F.col(c).cast(kind).alias(c) for c, kind in kinds.items()))
    number = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    other = F.when(number % TAMPER_FOLD == 0, leaf(F.translate("text", _UPPER, _LOWER)))
    return own.select("doc_id", "source", leaf(F.col("text")).alias("node"), other.alias("tampered"))


def manifest_blocks(docs: DataFrame, stage: Staging) -> tuple[DataFrame, DataFrame]:
    """(leaves, sources): every document with its source's number and its place, every source with its number.

    Numbers ascend with the source's name by bytes, null first.
    """
    leaves = stage(_leaves(docs).withColumn("row", F.monotonically_increasing_id()), "leaves")
    order = [F.asc_nulls_first("doc_id"), F.asc("node"), F.asc("row")]
    placed = stage(numbered(leaves, order, stage, ["source"], "leaf-order"), "placed")
    sources = stage(placed.groupBy("source").agg(F.count("*").alias("total")), "totals")
    sources = stage(numbered(sources, [F.asc_nulls_first("source")], stage, (), "source-order"), "sources")
    sources = sources.withColumnRenamed("place", "grp")
    named = sources.select(F.col("source").alias("of"), "grp", "total")
    return placed.join(named, F.col("source").eqNullSafe(F.col("of"))).drop("of", "row"), sources


def _proof_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Place, digest of the siblings and recomputed root of every leaf of a block."""
    names = ("grp", "place", "subroot", "root", "proof_sha256", "folded_root")
    kinds = (pa.int64(), pa.int64(), *[pa.string()] * 4)
    for batch in batches:
        for row in batch.to_pylist():
            above = [(w["before"], w["after"]) for w in (row["witness"] or []) + (row["over"] or [])]
            tampered = {t["place"]: t["tampered"] for t in row["tampered"] or ()}
            out = []
            for at in range(row["size"]):
                place = row["block"] * BLOCK + at
                witness = siblings(row["levels"], at) + above
                node = tampered.get(place) or row["levels"][0][HEX * at : HEX * (at + 1)]
                proof = digest(*(part for pair in witness for part in pair))
                out.append((row["grp"], place, row["top"], row["root_of_all"], proof, fold(node, witness)))
            columns = [pa.array(c, kind) for c, kind in zip(zip(*out), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=list(names))


def manifest(docs: DataFrame) -> DataFrame:
    """Leaf, roots and proof of every document, and whether a tampered copy still verifies.

    Returns doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, source. A
    leaf is the SHA-256 (lower-case hex) of doc_id, source, lang, n_chars and text, each
    ``-`` if null, else its length in bytes, ``:`` and itself. Per source, leaves ascend
    by doc_id; every 16 consecutive nodes, the last ones fewer, become the digest of
    their joined hex, level by level until one is left, the subroot. Subroots by source
    (null first) become the root alike. The proof is the joined siblings of the leaf's
    path up to the root; ``folded_root`` is recomputed from them and the leaf, or that of
    the tampered text (A-Z in lower case) where the id's crc32 is divisible by 5.

    Leaves are numbered over ranges of (source, doc_id), so a source with most rows is
    spread over tasks, and appended in blocks of 256; a task holds one block. Only
    digests are shuffled, texts are read once.

    Null ids come first in their source, rows alike in id by their leaf, so repeated
    rows are leaves of their own. A null source is a source, the first; a null text has
    no tampered form but itself, and the crc32 of a null id is that of an empty text.
    A text of any length is hashed whole. A single document or source is its own root;
    an empty table gives an empty result. Other columns do not matter.
    """
    ship(docs.sparkSession)
    stage = Staging(docs.sparkSession)
    leaves, sources = manifest_blocks(docs, stage)
    with small_batches(docs.sparkSession, BLOCKS_AT_ONCE):
        below = grown(leaves.select("grp", "place", "node", "total"), stage, "blocks")
        tops = extended(below, stage, "blocks")
        # The tree of the sources' roots: one more group, whose places are the sources' numbers.
        total = F.lit(sources.count()).cast("long")
        roots = _roots(below).select(F.lit(0).cast("long").alias("grp"), F.col("grp").alias("place"), "node", total.alias("total"))
        over = extended(grown(roots, stage, "sources"), stage, "sources")
        over = stage(over.mapInArrow(_witness_batches, ENTRIES), "over")
        over = over.select(F.col("block").alias("grp"), F.col("witness").alias("over"), F.col("top").alias("root_of_all"))
        changed = leaves.where("tampered is not null").groupBy("grp", F.floor(F.col("place") / BLOCK).alias("block"))
        changed = changed.agg(F.collect_list(F.struct("place", "tampered")).alias("tampered"))
        proofs = tops.join(changed, ["grp", "block"], "left").join(over, "grp")
        proofs = proofs.select("grp", "block", "size", "levels", "witness", "top", "over", "root_of_all", "tampered")
        proofs = stage(
            proofs.mapInArrow(
                _proof_batches,
                "grp long, place long, subroot string, root string, proof_sha256 string, folded_root string",
            ),
            "proofs",
        )
    out = leaves.join(proofs, ["grp", "place"])
    return out.select(
        "doc_id",
        F.col("node").alias("leaf"),
        "subroot",
        "root",
        "proof_sha256",
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
        "source",
    )


def _roots(rounds: list[DataFrame]) -> DataFrame:
    """(grp, node): the root of each group, from the round in which it stands alone."""
    alone = [blocks.where("alone").select("grp", F.col("root").alias("node")) for blocks in rounds]
    out = alone[0]
    for more in alone[1:]:
        out = out.unionByName(more)
    return out
