import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest
from helpers import awkward_rows, rows_of, table, text_of

from lakeops.sinks.staging import Staging
from llm import hyperminhash as hmh
from llm import near_dedup
from llm.components import connected_components
from llm.near_dedup import keep_one_each, near_duplicates

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def brute(rows, percent=80):
    """Components by comparing all rows."""
    sets = [shingles(r[1]) for r in rows]
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            same = len(sets[i] & sets[j])
            if sets[i] and sets[j]:
                if 100 * same >= percent * (len(sets[i]) + len(sets[j]) - same):
                    group[root(i)] = root(j)
    out = []
    for i, row in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(i)]
        least = min((x for x in ids if x is not None), default=None)
        least = least if sets[i] else row[0]
        out.append((row[0], len(sets[i]), least, least is None or row[0] == least))
    return sorted(out, key=repr)


def chains(seed, n):
    """Texts that drift by a few words, so links do not all meet in one text; odd sizes too."""
    rng, rows = random.Random(seed), []
    for family in range(6):
        words = text_of(seed * 10 + family, rng.choice([6, 9, 25, 120, 300]), 4000).split()
        for _ in range(n):
            words = list(words)
            for _ in range(rng.randint(0, max(1, len(words) // 60))):
                words[rng.randrange(len(words))] = text_of(rng.random(), 1, 4000)
            rows.append((rng.randrange(10**6) * 1000 + len(rows), " ".join(words), "en", "s", 1))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_components_are_those_of_all_pairs(spark, seed):
    rows = chains(seed, 25)
    assert rows_of(near_duplicates(table(spark, rows))) == brute(rows)
    assert rows_of(near_duplicates(table(spark, rows), link_percent=85)) == brute(rows, 85)


def test_bands_keep_the_chance_to_miss_small():
    assert (hmh.band_rows(0.85), hmh.band_rows(0.8)) == (6, 5)
    for threshold in (0.3, 0.5, 0.8, 0.85, 0.95):
        rows = hmh.band_rows(threshold)
        assert (1 - threshold**rows) ** (hmh.REGISTERS // rows) <= 1e-8 or rows == 1


def test_blocks_of_few_bytes_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK_BYTES", 4000)
    rows = chains(3, 20)
    assert rows_of(near_duplicates(table(spark, rows))) == brute(rows)


def test_awkward_rows(spark):
    rows = awkward_rows()
    assert rows_of(near_duplicates(table(spark, rows))) == brute(rows)


def test_kept_rows_have_their_columns(spark):
    df = table(spark, awkward_rows())
    kept = keep_one_each(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == [1, 4, 5, 6, 7, 8, 10, 11, 12, 12, 13]
    assert kept.where("doc_id is null").count() == 2


def test_repeated_and_null_ids_are_rows_of_their_own(spark):
    base, other, third = text_of(1, 120), text_of(2, 120), text_of(3, 120)
    near = base.rsplit(" ", 1)[0] + " end"
    rows = [
        (1, base, "en", "a", 1),
        (5, near, "en", "a", 1),  # a near copy ...
        (5, other, "en", "a", 1),  # ... whose id a clean text has too
        (5, other, "en", "b", 1),  # alike in id and text
        (5, other, "en", "b", 1),
        (None, base, "en", "a", 1),
        (None, third, "en", "a", 1),
        (None, third, "de", "a", 1),
        (None, third + " and more", "en", "a", 1),
        (None, None, "en", "a", 1),
        (None, "", "en", "a", 1),
    ]
    assert rows_of(near_duplicates(table(spark, rows))) == brute(rows)
    kept = keep_one_each(table(spark, rows)).collect()
    assert sorted((r.doc_id, r.text) for r in kept if r.doc_id) == [(1, base), (5, other)]
    nameless = [r.text for r in kept if r.doc_id is None]
    assert len(nameless) == 3 and {None, ""} < set(nameless)
    assert {third, third + " and more"} & set(nameless)
    again = keep_one_each(table(spark, rows).repartition(5)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, kept))


def _bucket_table(sets, component, band):
    hashes, first = np.concatenate(sets), np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    registers = hmh.sketch(hashes, first)
    return pa.table(
        {
            "node": pa.array(range(len(sets)), pa.int64()),
            "component": pa.array(component, pa.int64()),
            "band": pa.array([band] * len(sets), pa.int64()),
            "registers": pa.array([r.tobytes() for r in registers], pa.binary()),
            "shingles": pa.array([s.tobytes() for s in sets], pa.binary()),
        }
    ), registers


def _template_sets(rng, n, shared=21, own=5):
    template = rng.integers(0, 2**63, shared, dtype=np.uint64)
    return [np.sort(np.concatenate([template, rng.integers(0, 2**63, own, dtype=np.uint64)])) for _ in range(n)]


def test_bucket_links_are_those_of_all_pairs(monkeypatch):
    """In any one bucket: all links between components that share no earlier bucket."""
    rng = np.random.default_rng(4)
    sets = _template_sets(rng, 120) + _template_sets(rng, 60, 40, 4)
    sets += [np.sort(np.concatenate([s[:-2], rng.integers(0, 2**63, 2, dtype=np.uint64)])) for s in sets[:40]]
    sets += [s[:-1] for s in sets[130:150]]
    component = [i // 3 for i in range(len(sets))]
    for band in range(0, 51, 7):
        tab, registers = _bucket_table(sets, component, band)
        found = near_dedup._block_links(tab, 80)
        label = list(component)
        for a, b in zip(*found.to_pydict().values()):
            same = len(np.intersect1d(sets[a], sets[b]))
            assert 100 * same >= 80 * (len(sets[a]) + len(sets[b]) - same) and label[a] != label[b]
            label = [label[b] if x == label[a] else x for x in label]
        for a in range(len(sets)):
            for b in range(a):
                same = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
                linked = 100 * same >= 80 * (len(sets[a]) + len(sets[b]) - same)
                equal = (registers[a] == registers[b])[: 51 * 5].reshape(51, 5).all(axis=1)
                if linked and equal.any() and equal.argmax() == band:
                    assert label[a] == label[b], "a link between components is missing"


def test_a_full_bucket_of_unlike_members_takes_time_in_proportion():
    rng = np.random.default_rng(6)

    def seconds(n):
        tab, _ = _bucket_table(_template_sets(rng, n), list(range(n)), 0)
        begin = time.perf_counter()
        assert near_dedup._block_links(tab, 80).num_rows == 0
        return time.perf_counter() - begin

    small, large = min(seconds(1000) for _ in range(2)), seconds(8000)
    assert large < 8 * small * 2.5 + 0.5


def test_hub_of_a_third_of_all_edges_is_split(spark):
    edges = spark.range(60000).selectExpr("id + 1 as a", "0L as b").union(spark.range(120000).selectExpr("200000 + 2 * id", "200001 + 2 * id"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.files.maxPartitionBytes": "40k",
        "spark.sql.files.openCostInBytes": "1k",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    plans = []
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)

        class Watching(Staging):
            def __call__(self, df, name):
                out = super().__call__(df, name)
                if name.endswith("-large") and not plans:
                    again = df.select("*")
                    again.collect()
                    plans.append(again._jdf.queryExecution().executedPlan().toString())
                return out

        found = connected_components(edges, Watching(spark)).where("component = 0").count()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert found == 60001
    assert "skew=true" in plans[0]


def test_empty_table(spark):
    assert near_duplicates(table(spark, [])).collect() == []
    assert keep_one_each(table(spark, [])).collect() == []


def test_estimate_is_corrected_for_chance():
    rng = np.random.default_rng(5)
    def sketch(x):
        return hmh.sketch(x, np.array([0, len(x)]))

    for same, own in ((0, 4000), (500, 100), (90, 10), (30, 3)):
        estimates = []
        for _ in range(40):
            x = rng.integers(0, 2**63, same + 2 * own, dtype=np.uint64)
            a, b = sketch(x[: same + own]), sketch(np.concatenate([x[:same], x[same + own :]]))
            estimates.append(hmh.jaccard(a == b, np.array([same + own]), np.array([same + own]))[0])
        truth = same / (same + 2 * own)
        assert abs(np.mean(estimates) - truth) < 0.03
        assert all(e >= truth - hmh.slack(np.array([same + own]), max(truth, 0.01))[0] for e in estimates)


def test_components_of_paths_stars_and_gaps(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (None, 3), (500, 501), (501, 500)]
    with Staging(spark) as stage:
        found = connected_components(spark.createDataFrame(edges, "a long, b long"), stage)
        got = dict(map(tuple, found.collect()))
    assert got == {**{i: 1 for i in range(1, 41)}, **{i: 100 for i in range(100, 160)}, 500: 500, 501: 500}
