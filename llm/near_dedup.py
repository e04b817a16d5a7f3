"""Near-duplicate documents by HyperMinHash."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.sinks.staging import Staging
from llm import hyperminhash as hmh
from llm.batches import small_batches
from llm.byteops import LOWER, ranges, shingle_hashes, span_hashes, text_chunks, word_bounds
from llm.components import connected_components
from llm.rows import as_rows, from_rows
from llm.shipping import ship
from llm.slots import perhaps_in

SHINGLE_WORDS = 5
LINK_PERCENT = 80
# Bytes of shingle sets a residual block may hold; a block pair is one group.
BLOCK_BYTES = 4 << 20
# Digests that, with the id, tell texts apart.
TEXT_KEYS = ("k0", "k1")
# The same without nulls, as join and grouping key.
ROW_KEY = ("id", "nameless", *TEXT_KEYS)


def _text_sets(batch: pa.RecordBatch) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """(rows, hashes, first): distinct shingle hashes of each text, ascending."""
    for rows, data, offsets in text_chunks(batch.column("text")):
        data = LOWER[data]
        starts, ends, first = word_bounds(data, offsets)
        hashes, first = shingle_hashes(span_hashes(data, starts, ends), first, SHINGLE_WORDS)
        owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
        order = np.lexsort((hashes, owner))
        hashes, owner = hashes[order], owner[order]
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
        hashes, owner = hashes[new], owner[new]
        yield rows, hashes, np.searchsorted(owner, np.arange(len(first)))


def _binary(data: bytes, offsets: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(
        pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)]
    )


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, hashes, first in _text_sets(batch):
            n = np.diff(first)
            registers = hmh.sketch(hashes, first)
            # Two independent sums identify a set.
            keys = np.zeros((len(n), 2), np.uint64)
            full = n > 0
            for k in range(2):
                mixed = hmh.mix(hashes + np.uint64(7 + 11 * k))
                keys[full, k] = np.add.reduceat(mixed, first[:-1][full]) if full.any() else 0
            yield pa.record_batch(
                [
                    *(batch.column(c).slice(rows.start, len(n)) for c in ("doc_id", *TEXT_KEYS)),
                    pa.array(n.astype(np.int64)),
                    _binary(keys.tobytes(), np.arange(len(n) + 1) * 16),
                    _binary(registers.tobytes(), np.arange(len(n) + 1) * 2 * hmh.REGISTERS),
                ],
                names=["doc_id", *TEXT_KEYS, "n_shingles", "set_key", "registers"],
            )


def _set_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, hashes, first in _text_sets(batch):
            yield pa.record_batch(
                [
                    batch.column("node").slice(rows.start, rows.stop - rows.start),
                    pa.array(np.diff(first).astype(np.int64)),
                    _binary(hashes.tobytes(), first * 8),
                    _binary(hmh.sketch(hashes, first).tobytes(), np.arange(len(first)) * 2 * hmh.REGISTERS),
                ],
                names=["node", "n", "shingles", "registers"],
            )


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, hmh.REGISTERS)


def _likely(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Pairs whose corrected estimate does not rule out the threshold."""
    for batch in batches:
        if not batch.num_rows:
            continue
        n, m = batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy()
        equal = _matrix(batch.column("registers_a")) == _matrix(batch.column("registers_b"))
        keep = hmh.possible(equal, n, m, threshold) & (np.minimum(n, m) >= threshold * np.maximum(n, m) - 1e-9)
        yield batch.select(["a", "b"]).filter(pa.array(keep))


def _linked(n: np.ndarray, m: np.ndarray, same: np.ndarray, percent: int) -> np.ndarray:
    return 100 * same >= percent * (n + m - same)


def _verified(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs linked on their full sets."""
    for batch in batches:
        keep = []
        for left, right in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
            x, y = np.frombuffer(left.as_buffer(), np.uint64), np.frombuffer(right.as_buffer(), np.uint64)
            same = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(bool(_linked(len(x), len(y), same, percent)))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


class _Rare:
    """Members of a block by their rarest shingles, in one order for all, rarest first.

    Of linked sets with n >= m shingles, ``percent`` of n and 2 * percent / (100 + percent)
    of m are common at least. So the n less that many plus one rarest of the larger set
    (``wide``) and of the smaller one (``narrow``) hold a common shingle.
    """

    def __init__(self, at: np.ndarray, sizes: np.ndarray, first: np.ndarray, percent: int):
        count = np.bincount(at).astype(np.int32)
        owner = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        order = np.lexsort((count[at], owner))  # stable: equally rare ones stay in the order of their numbers
        rank = np.arange(len(at), dtype=np.int32) - np.repeat(first[:-1].astype(np.int32), sizes)
        wide = sizes + (-percent * sizes) // 100 + 1
        narrow = sizes + (-2 * percent * sizes) // (100 + percent) + 1
        # Shingles that no other member has find nobody.
        shared = count[at[order]] > 1
        pick = lambda length: order[shared & (rank < np.repeat(length, sizes))]
        self.wide, self.narrow = pick(wide), pick(narrow)
        self.of_wide, self.of_narrow = at[self.wide], at[self.narrow]
        self.wide_of, self.narrow_of = owner[self.wide], owner[self.narrow]
        members = np.arange(len(sizes) + 1)
        self.wide_first, self.narrow_first = np.searchsorted(self.wide_of, members), np.searchsorted(self.narrow_of, members)
        self.by_wide, self.by_narrow = np.argsort(self.of_wide, kind="stable"), np.argsort(self.of_narrow, kind="stable")
        self.sorted_wide, self.sorted_narrow = self.of_wide[self.by_wide], self.of_narrow[self.by_narrow]

    def near(self, i: int) -> np.ndarray:
        """Members that may be linked with member ``i``."""
        mine = self.of_wide[self.wide_first[i] : self.wide_first[i + 1]]
        smaller = self.narrow_of[self.by_narrow[self._places(self.sorted_narrow, mine)]]
        mine = self.of_narrow[self.narrow_first[i] : self.narrow_first[i + 1]]
        larger = self.wide_of[self.by_wide[self._places(self.sorted_wide, mine)]]
        return np.unique(np.concatenate([smaller, larger]))

    @staticmethod
    def _places(ordered: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        begin = np.searchsorted(ordered, wanted)
        return ranges(begin, np.searchsorted(ordered, wanted, "right") - begin)


def _block_links(table: pa.Table, percent: int) -> pa.Table:
    """Links between different components of one block pair; at most one per member and component.

    Members outside the largest component look for others in an index of rare shingles.
    Those of fitting size are kept by the corrected estimate, if this is the first
    bucket that both are in, and verified on their full sets. A link whose ends are
    joined already is left out.
    """
    ids = table.column("node").to_numpy()
    component = table.column("component").to_numpy()
    registers = _matrix(table.column("registers").combine_chunks())
    band, rows = table.column("band")[0].as_py(), hmh.band_rows(percent / 100)
    bands = hmh.REGISTERS // rows
    buffers = table.column("shingles").combine_chunks().to_pylist()
    sizes = np.array([len(x) // 8 for x in buffers], np.int64)
    values, at = np.unique(np.frombuffer(b"".join(buffers), np.uint64), return_inverse=True)
    seen, at = np.zeros(len(values), bool), at.astype(np.int32)
    del buffers, values
    first = np.concatenate([[0], np.cumsum(sizes)])
    rare = _Rare(at, sizes, first, percent)
    _, label, counts = np.unique(component, return_inverse=True, return_counts=True)
    out = []
    for i in np.flatnonzero(label != counts.argmax()).tolist():
        others = rare.near(i)
        others = others[label[others] != label[i]]
        others = others[100 * np.minimum(sizes[i], sizes[others]) >= percent * np.maximum(sizes[i], sizes[others])]
        if not len(others):
            continue
        equal = registers[others] == registers[i]
        shared = equal[:, : bands * rows].reshape(-1, bands, rows).all(axis=2)
        others = others[hmh.possible(equal, sizes[i], sizes[others], percent / 100) & (shared.argmax(axis=1) == band)]
        if not len(others):
            continue
        mine = at[first[i] : first[i + 1]]
        seen[mine] = True
        ends = np.cumsum(sizes[others])
        same = np.add.reduceat(seen[at[ranges(first[others], sizes[others])]].astype(np.int64), ends - sizes[others])
        seen[mine] = False
        linked = others[_linked(sizes[i], sizes[others], same, percent)]
        for j in linked[np.unique(label[linked], return_index=True)[1]]:
            out.append((ids[i], ids[j]))
            label[label == label[j]] = label[i]
    return pa.table(
        {"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())}
    )


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text and two digests of the text; null and empty are alike."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    return own.withColumns({k: F.xxhash64(F.lit(i), "text") for i, k in enumerate(TEXT_KEYS)})


def sketch_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, k0, k1, n_shingles, set_key, registers) of every row; k0 and k1 are digests of the text."""
    ship(docs.sparkSession)
    return _texts(docs, id_col, text_col).mapInArrow(
        _sketch_batches, "doc_id long, k0 long, k1 long, n_shingles long, set_key binary, registers binary"
    )


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", link_percent: int = LINK_PERCENT
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row: near-duplicate groups of word shingles.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case; a document is its set of
    distinct 5-word shingles, the whole sequence where it has fewer words. Documents
    are linked at ``100 * intersection >= link_percent * union``; a component is what
    links connect, named by its smallest id; ``kept`` marks that document.

    1. One pass sketches every text by HyperMinHash. Equal sets collapse to one class.
    2. Bands of registers (six at 85 percent, five at 80) put classes into buckets; a pair
       at the threshold shares none with a probability below 1e-8. Each member is compared with one member of
       its bucket: first by the collision-corrected estimate, less six standard
       deviations, then on the full sets.
    3. Buckets that still hold several components are finished exactly: of the members
       that were not compared with all of the bucket, those outside the largest component meet those they share a rare shingle with, by the estimate
       and then on the full sets, in blocks of bounded bytes, and only links that join
       components leave a block. No pairs are emitted.

    A null or empty text has no shingles, is linked with nothing and stands for
    itself; a very long one is a chunk of its own, never cut. Rows without id belong to
    the component of their text and are named by its smallest id; where no row of it
    has one, they have no component and are kept. Rows that repeat an id are documents
    of their own, each in its text's component. An empty table gives an empty result.
    Other columns of the input do not matter.
    """
    rows = _grouped(docs, id_col, text_col, link_percent)
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return rows.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), component.isNull()).alias("kept"),
    )


def _grouped(docs: DataFrame, id_col: str, text_col: str, link_percent: int) -> DataFrame:
    """Every row (doc_id, k0, k1, n_shingles) with its component and that one's smallest id."""
    spark = docs.sparkSession
    stage = Staging(spark)
    with small_batches(spark):
        sketches = stage(sketch_documents(docs, id_col, text_col), "sketches")
    # The class's first row by id stands for it: its text is found again by id and digests.
    least = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", *TEXT_KEYS)).alias("least")
    classes = sketches.where("n_shingles > 0").groupBy("set_key")
    classes = classes.agg(least, F.min("n_shingles").alias("n"), F.min("registers").alias("registers"))
    classes = stage(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    members = stage(_bucket_members(classes, stage, hmh.band_rows(link_percent / 100)), "members")
    needed = classes.join(members.select("node").distinct(), "node", "left_semi")
    needed = stage(_row_keys(needed.select("node", *(f"least.{k}" for k in ("doc_id", *TEXT_KEYS))), "node"), "needed")
    sets = _member_sets(docs, id_col, text_col, needed, stage.rows["needed"])
    with small_batches(spark):
        sets = stage(sets, "sets")
        links = stage(_star_links(members, sets, link_percent), "links")
    part = stage(connected_components(links, stage, "part"), "part-labels")
    with small_batches(spark):
        rest = stage(_residual_links(members, part, sets, stage, link_percent), "rest")
    labels = stage(connected_components(links.unionByName(rest), stage, "whole"), "labels")

    named = classes.select("set_key", "node", F.col("least.doc_id").alias("doc_id")).join(labels, "node", "left")
    named = stage(named.select("set_key", F.coalesce("component", "node").alias("component"), "doc_id"), "named")
    # One row a component of several classes; the others are named by their own smallest id.
    smallest = stage(named.groupBy("component").agg(F.min("doc_id").alias("component_id")), "names")
    named = stage(named.drop("doc_id").join(smallest, "component"), "set-names")
    return sketches.drop("registers").join(named, "set_key", "left").drop("set_key")


def keep_one_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", link_percent: int = LINK_PERCENT
) -> DataFrame:
    """One row of each component of :func:`near_duplicates`, with all its columns.

    The row with the smallest id stays (of several, and where none has an id, that
    whose text's digest is least; of rows alike in id and text, that whose columns'
    digest is least). Rows without shingles, null and empty texts too, all stay; a text
    is never dropped for sharing an id. An empty table gives an empty result, and
    columns of any name pass.
    """
    stage = Staging(docs.sparkSession)
    found = stage(_grouped(docs, id_col, text_col, link_percent).where("n_shingles > 0"), "grouped")
    key = ("doc_id", *TEXT_KEYS)
    rank = F.struct(F.col("doc_id").isNull().alias("nameless"), *key)
    winners = stage(found.groupBy("component").agg(F.min(rank).alias("w")), "winners").select("component", "w")
    judged = found.groupBy("component", *key).agg(F.count("*").alias("copies")).join(winners, "component")
    judged = stage(judged.select(*key, "copies", (rank == F.col("w")).alias("won")), "judged")
    gone, repeated = judged.where("not won"), judged.where("won and copies > 1")

    text = F.coalesce(F.col(f"row.c{docs.columns.index(text_col)}").cast("string"), F.lit(""))
    rows = as_rows(docs, doc_id=id_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    rows = rows.withColumns({k: F.xxhash64(F.lit(i), text) for i, k in enumerate(TEXT_KEYS)})
    kept = _without(rows, gone)
    if not repeated.isEmpty():
        first = F.row_number().over(Window.partitionBy(*key).orderBy(F.xxhash64("row")))
        one = rows.join(repeated.select(*(F.col(k).alias(f"_{k}") for k in key)), _same(key), "left_semi")
        one = one.withColumn("place", first).where("place = 1").drop("place")
        kept = _without(kept, repeated).unionByName(one)
    return from_rows(kept, docs)


def _same(key: tuple[str, ...]) -> Column:
    return reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key])


def _without(rows: DataFrame, gone: DataFrame) -> DataFrame:
    key = ("doc_id", *TEXT_KEYS)
    return rows.join(gone.select(*(F.col(k).alias(f"_{k}") for k in key)), _same(key), "left_anti")


def _bucket_members(classes: DataFrame, stage: Staging, band_rows: int) -> DataFrame:
    """(bucket, band, node, pivot) of all buckets with two classes or more; the pivot differs by bucket.

    Most buckets hold one class. Only their keys are counted; rows of others are then
    dealt, and few besides.
    """
    last, size = hmh.REGISTERS // band_rows - 1, 2 * band_rows
    key = f"transform(sequence(0, {last}), i -> xxhash64(i, substring(registers, cast(i * {size} + 1 as int), {size})))"
    rows = classes.select("node", F.posexplode(F.expr(key)).alias("band", "bucket"))
    several = rows.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1").select("bucket")
    several = stage(several, "buckets")
    rows = stage(perhaps_in(rows, ("bucket",), several, stage.rows["buckets"]), "bucket-rows")
    pivots = (
        rows.groupBy("bucket")
        .agg(F.min(F.col("node").bitwiseXOR(F.col("bucket"))).alias("p"), F.count("*").alias("members"))
        .where("members > 1")
    )
    return rows.join(pivots, "bucket").select("bucket", "band", "node", F.col("p").bitwiseXOR(F.col("bucket")).alias("pivot"))


def _row_keys(rows: DataFrame, *others: str) -> DataFrame:
    """ROW_KEY of rows with doc_id and TEXT_KEYS, and the other columns named."""
    named = F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("nameless")
    return rows.select(*named, *TEXT_KEYS, *others)


def _member_sets(docs: DataFrame, id_col: str, text_col: str, needed: DataFrame, count: int) -> DataFrame:
    """(node, n, shingles, registers) of the classes that share a bucket with another, from their texts.

    Of the other texts few are shuffled. Rows alike in id and text have one set; they
    collapse before they are dealt.
    """
    own = perhaps_in(_row_keys(_texts(docs, id_col, text_col), "text"), ROW_KEY, needed, count)
    own = own.groupBy(*ROW_KEY).agg(F.first("text").alias("text")).join(needed, list(ROW_KEY)).select("node", "text")
    return own.mapInArrow(_set_batches, "node long, n long, shingles binary, registers binary")


def _star_links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links of members with their buckets' pivots; the estimate needs no set."""
    pairs = (
        members.where("node <> pivot")
        .select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b"))
        .distinct()
    )
    for side in ("a", "b"):
        info = sets.select(
            F.col("node").alias(side), F.col("n").alias(f"n_{side}"), F.col("registers").alias(f"registers_{side}")
        )
        pairs = pairs.join(info, side)
    likely = pairs.mapInArrow(lambda it: _likely(it, percent / 100), "a long, b long")
    for side in ("a", "b"):
        likely = likely.join(sets.select(F.col("node").alias(side), F.col("shingles").alias(f"set_{side}")), side)
    return likely.mapInArrow(lambda it: _verified(it, percent), "a long, b long")


def _residual_links(members: DataFrame, labels: DataFrame, sets: DataFrame, stage: Staging, percent: int) -> DataFrame:
    """Links in buckets that hold several components, found block pair by block pair.

    A pivot has met all others of its bucket, so it is left out there. Of buckets that
    then hold the same members the one of the lowest band stands for all: it is the
    first bucket of each of its pairs that the others hold too.
    """
    rows = members.where("node <> pivot").select("bucket", "band", "node").join(labels, "node", "left")
    rows = rows.join(sets.select("node", "n"), "node")
    rows = rows.select("bucket", "band", "node", F.coalesce("component", "node").alias("component"), "n")
    alike = [F.bit_xor(F.xxhash64(F.lit(i), "node")).alias(f"m{i}") for i in range(2)]
    open_buckets = (
        rows.groupBy("bucket", "band")
        .agg(
            F.min("component").alias("low"),
            F.max("component").alias("high"),
            F.sum("n").alias("total"),
            F.count("*").alias("members"),
            *alike,
        )
        .where("low <> high")
        .groupBy("members", "m0", "m1")
        .agg(F.min(F.struct("band", "bucket", F.ceil(F.col("total") * 8 / BLOCK_BYTES).cast("int").alias("blocks"))).alias("b"))
    )
    # Staged, so that AQE may split a bucket with very many members.
    open_buckets = stage(open_buckets.select("b.bucket", "b.blocks"), "open")
    rows = rows.join(open_buckets, "bucket").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    each = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    units = rows.select("bucket", "band", "node", "component", "own", each)
    units = units.select(
        "bucket", "band", "node", "component", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")
    )
    return (
        units.join(sets.drop("n"), "node")
        .groupBy("bucket", "i", "j")
        .applyInArrow(lambda t: _block_links(t, percent), "a long, b long")
    )
