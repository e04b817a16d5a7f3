import hashlib
import random
import zlib

import pytest
from helpers import awkward_rows, table, text_of
from pyspark.sql import functions as F

from lakeops.sinks.staging import Staging
from llm import merkle
from llm.merkle import Appender, digest, fold, manifest, siblings


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[0], row[3], row[2], row[4], row[1])))


def lower(text):
    return text and text.translate({c: c + 32 for c in range(65, 91)})


def tree(nodes):
    """All levels, whole level after whole level."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 16]) for i in range(0, len(levels[-1]), 16)])
    return levels


def path(levels, at):
    out = []
    for nodes in levels[:-1]:
        run = nodes[at // 16 * 16 : at // 16 * 16 + 16]
        out.append((run[: at % 16], run[at % 16 + 1 :]))
        at //= 16
    return out


def brute(rows):
    sources = sorted({r[3] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in sources:
        own = sorted((r for r in rows if r[3] == source), key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[source] = (own, tree([leaf_of(r) for r in own]))
    top = tree([trees[s][1][-1][0] for s in sources])
    out = []
    for number, source in enumerate(sources):
        own, levels = trees[source]
        for at, row in enumerate(own):
            way = path(levels, at) + path(top, number)
            node = leaf_of(row)
            if zlib.crc32(str(row[0] if row[0] is not None else "").encode()) % 5 == 0:
                node = leaf_of((row[0], lower(row[1]), *row[2:]))
            for before, after in way:
                node = h(*before, node, *after)
            proof = h(*(x for before, after in way for x in (*before, *after)))
            out.append((row[0], leaf_of(row), levels[-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r)[:7] for r in df.collect()), key=repr)


@pytest.mark.parametrize("n", [1, 2, 15, 16, 17, 255, 256, 257, 4096, 4097, 5000])
def test_appended_tree_is_the_whole_tree(n):
    nodes = [h(str(i)) for i in range(n)]
    grown = Appender()
    for node in nodes:
        grown.append(node)
    levels = tree(nodes)
    assert grown.close() == levels[-1][0] and grown.levels == levels
    joined = ["".join(x) for x in levels]
    for at in {0, n // 2, n - 1}:
        way = siblings(joined, at)
        assert way == [("".join(b), "".join(a)) for b, a in path(levels, at)]
        assert fold(nodes[at], way) == levels[-1][0]


def test_closing_at_a_height_goes_on_over_single_nodes():
    grown = Appender()
    grown.append("a")
    assert grown.close(2) == digest(digest("a"))
    assert [len(x) for x in grown.levels] == [1, 1, 1]


def test_awkward_rows(spark):
    rows = awkward_rows()
    assert got(manifest(table(spark, rows))) == brute(rows)


def test_hot_source_over_several_rounds(spark):
    rng = random.Random(3)
    rows = [(i, text_of(i, rng.randrange(9)).title(), "en", "hot", i % 7) for i in rng.sample(range(10**6), 4300)]
    rows += [(i, "Text", None, f"s{i % 40}", 1) for i in range(300)] + [(7, "Twice", "en", None, 1)] * 3
    rows += [(None, "Nameless", "en", "hot", 1)] * 600
    assert got(manifest(table(spark, rows, clash=False))) == brute(rows)


def test_single_row_and_empty_table(spark):
    rows = [(1, "A", "en", "a", 1)]
    (only,) = manifest(table(spark, rows)).collect()
    assert only.leaf == only.subroot == only.root and only.proof_sha256 == h()
    assert got(manifest(table(spark, rows))) == brute(rows)
    assert manifest(table(spark, [])).collect() == []


def test_any_change_of_a_leaf_is_found(spark):
    rows = [(i, f"Text {i}", "en", "ab"[i % 2], 6) for i in range(200)]
    out = manifest(table(spark, rows)).collect()
    bad = {r.doc_id for r in out if not r.verified}
    assert bad == {i for i in range(200) if zlib.crc32(str(i).encode()) % 5 == 0}


def test_leaves_are_numbered_without_a_single_task(spark):
    docs = spark.range(20000).select(
        F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.lit("en").alias("lang"), F.lit("hot").alias("source"), F.lit(1).alias("n_chars")
    )
    leaves, _ = merkle.manifest_blocks(docs, Staging(spark))
    sizes = [r["count"] for r in leaves.groupBy(F.floor(F.col("place") / 256)).count().collect()]
    assert max(sizes) == 256 and sum(sizes) == 20000
