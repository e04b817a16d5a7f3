"""Fingerprints and mixing: operators of built-in functions alone."""

import hashlib
import random
import re

import xxhash
from helpers import awkward_rows, rows_of, table, text_of
from pyspark.sql import functions as F

from lakeops.sinks.staging import Staging
from llm import mixing
from llm.mixing import mixed_documents, mixture, source_targets
from llm.order_minhash import BUCKETS, edited_fingerprints, entries, fingerprint, likeness

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_edits_and_places_are_those_of_plain_code(spark):
    rng = random.Random(2)
    rows = [(i * 7 % 501, text_of(i, rng.randrange(0, 90)) + "é😀" * (i % 3), "en", "a", 1) for i in range(200)]
    rows = list({r[0]: r for r in rows}.values()) + [(None, "the last, without an id", "en", "a", 1)]
    df = table(spark, rows)
    out = edited_fingerprints(df)
    assert not re.search("Python|Pandas|Arrow", plan_of(out))
    got = {r.doc_id: r for r in out.collect()}
    assert len(got) == len(rows)
    order = sorted((r[0] for r in rows if r[0] is not None), reverse=True) + [None]
    texts = {r[0]: r[1] for r in rows}
    for here, after in zip(order, order[1:] + order[:1]):
        text, k = texts[here], len(texts[here]) // 3
        edited = text[: len(text) - k] + texts[after][:k]
        assert got[here].n_chars == len(text)
        assert got[here].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        if text == edited:
            assert got[here].fingerprint == got[here].edited_fingerprint and got[here].near_edited == 1


def sketched(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    df = df.select("i", F.array_join(fingerprint(F.col("text")), "").alias("f"))
    return [r.f for r in df.orderBy("i").collect()]


def chained(*parts):
    """The hash of several values one after another: bytes, or (whole number, its bytes)."""
    seed = 42
    for part in parts:
        data = part if isinstance(part, bytes) else part[0].to_bytes(part[1], "little")
        seed = xxhash.xxh64_intdigest(data, seed)
    return seed


def plain_fingerprint(text):
    """Order MinHash word by word: number the copies, keep two of each bucket, hash them in text order."""
    words = [w.encode() for w in WORD.findall(text)]
    n = max(len(words) - 2, min(len(words), 1))
    seen, buckets = {}, {}
    for place in range(n):
        kmer = chained(*words[place : place + 3]) >> 29
        copy = seen[kmer] = seen.get(kmer, -1) + 1
        value = chained((kmer, 8), (copy, 4)) >> 29
        buckets.setdefault(value >> 29, []).append((value, place))
    out = ""
    for bucket, found in sorted(buckets.items()):
        least = sorted(sorted(found)[:2], key=lambda e: e[1])
        out += f"{bucket:02x}{chained(*((value, 8) for value, _ in least)) & 0xFFFF:04x}"
    return out


def plain_likeness(a, b):
    x, y = ({f[i : i + 6] for i in range(0, len(f), 6)} for f in (a, b))
    either = {e[:2] for e in x | y}
    return len(x & y) / len(either) if either else 1.0


def test_fingerprints_are_those_of_plain_code(spark):
    texts = [text_of(i, n, 30 + 10 * i) for i, n in enumerate((0, 1, 2, 3, 4, 40, 300, 2000))]
    texts += ["a b c " * 50, "é 😀\tx\x0by " * 20, " \n "]
    assert sketched(spark, texts) == [plain_fingerprint(t) for t in texts]
    rows = [(i, t, "en", "a", 1) for i, t in enumerate(texts)]
    for r in edited_fingerprints(table(spark, rows)).collect():
        text, after = texts[r.doc_id], texts[r.doc_id - 1]
        k = len(text) // 3
        own, edited, following = map(plain_fingerprint, (text, text[: len(text) - k] + after[:k], after))
        assert (r.fingerprint, r.edited_fingerprint) == (own, edited)
        assert r.near_edited == plain_likeness(own, edited) and r.near_next == plain_likeness(own, following)


def test_ids_of_a_third_of_all_rows_are_dealt_in_parts(spark):
    def key(i):
        return (None, 7, 1000 + i)[i % 3]

    rows = [(key(i), text_of(i // 2 if i % 3 else i % 9, 20 + i % 30), "en", "a", 1) for i in range(1800)]
    signed = lambda t: (v := chained(t.encode())) - (v >> 63 << 64)
    least = {}
    for k, text, *_ in rows:
        least[k] = min(least.get(k, text), text, key=signed)
    order = sorted((k for k in least if k is not None), reverse=True) + [None]
    after = dict(zip(order, order[1:] + order[:1]))
    expected = []
    for k, text, *_ in rows:
        cut = len(text) // 3
        edited = text[: len(text) - cut] + least[after[k]][:cut]
        expected.append((k, hashlib.sha256(edited.encode()).hexdigest(), plain_fingerprint(text)))
    settings = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        out = edited_fingerprints(table(spark, rows)).withColumn("task", F.spark_partition_id()).collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    got = [(r.doc_id, r.edited_sha256, r.fingerprint) for r in out]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    tasks = [r.task for r in out]
    assert max(map(tasks.count, set(tasks))) < 0.1 * len(rows)


def near(spark, a, b):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    return df.select(likeness(entries("a"), entries("b"))).first()[0]


def test_fingerprints_follow_edits_and_order(spark):
    words = text_of(1, 600, 4000).split()
    moved = words[300:] + words[:300]
    few = list(words)
    few[100], few[400] = "zzz", "yyy"
    shuffled = list(words)
    random.Random(1).shuffle(shuffled)
    base, same, small, move, loose, other, repeated, once = sketched(
        spark,
        [" ".join(x) for x in (words, words, few, moved, shuffled)]
        + [text_of(2, 600, 4000), "a b c d " * 60, "a b c d e f"],
    )
    assert base == same and len(base) == 6 * BUCKETS
    assert near(spark, base, same) == 1 and near(spark, base, other) == 0
    assert 0.75 < near(spark, base, small) < 1 and near(spark, base, loose) < 0.1
    # the same k-mers but for a few, in another order: pairs across the move change their order
    assert 0.3 < near(spark, base, move) < 0.8
    # copies of a k-mer are told apart by their number
    assert len(repeated) > 3 * len(once) and near(spark, repeated, once) < 0.2


def test_likeness_grows_with_the_share_kept(spark):
    words = text_of(3, 900, 4000).split()
    fresh = text_of(4, 900, 4000).split()
    cut = [" ".join(words[:n] + fresh[n:]) for n in (900, 800, 600, 300, 0)]
    first, *others = sketched(spark, cut)
    values = [near(spark, first, x) for x in others]
    # 800 of 1000 distinct k-mers shared: both of a bucket's two with a chance of 0.64, give or take 0.06
    assert values == sorted(values, reverse=True) and values[0] > 0.45 and values[-1] == 0


def test_fingerprints_of_awkward_rows(spark):
    out = edited_fingerprints(table(spark, awkward_rows()))
    rows = out.collect()
    assert len(rows) == len(awkward_rows())
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    by_text = {}
    for r in rows:
        by_text.setdefault((r.n_chars, r.fingerprint), []).append(r)
    assert {r.doc_id for r in rows if r.fingerprint == ""} == {5, 6, 7, None}
    assert len({r.fingerprint for r in rows if r.doc_id in (1, 2)}) == 1
    assert edited_fingerprints(table(spark, [])).collect() == []
    single = edited_fingerprints(table(spark, [(5, "abcdefghi", "en", "a", 1)])).first()
    assert single.edited_sha256 == hashlib.sha256(b"abcdefabc").hexdigest() and single.near_next == 1


def water_fill(sizes):
    """Targets by resharing the excess again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, target, open_sources = 1.5 * sum(sizes.values()), {}, set(order)
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in open_sources) for s in open_sources}
        full = {s for s in open_sources if share[s] > 2 * sizes[s]}
        if not full:
            return target | share
        target |= {s: 2.0 * sizes[s] for s in full}
        left -= sum(2 * sizes[s] for s in full)
        open_sources -= full


def test_targets_are_those_of_repeated_sharing(spark):
    rng = random.Random(4)
    for n in (1, 2, 3, 7, 20):
        sizes = {f"s{i}é"[: 2 + i % 3] + str(i): rng.choice([0, 3, 50, 1000, 40000]) for i in range(n - 1)} | {None: 77}
        df = spark.createDataFrame([(s, v, 1) for s, v in sizes.items()], "source string, source_size long, documents long")
        got = {r.source: r.target for r in source_targets(df).collect()}
        expected = water_fill(sizes)
        assert got.keys() == expected.keys()
        assert all(abs(got[s] - expected[s]) < 1e-6 * max(1, expected[s]) for s in got)


def documents(n=400):
    rng = random.Random(9)
    return [(i, text_of(i, rng.randrange(1, 200)), "en", rng.choice(["a", "a", "a", "b", "c", None]), 1) for i in range(n)]


def test_sources_meet_their_targets_in_whole_epochs_first(spark, monkeypatch):
    df = table(spark, documents())
    whole = rows_of(mixture(df))
    monkeypatch.setattr(mixing, "BUCKET_DOCUMENTS", 7)
    out = mixture(df)
    assert not re.search("Python|Pandas|Arrow", plan_of(out))
    assert rows_of(out) == whole, "the size of buckets does not matter"
    assert rows_of(mixture(df.repartition(5))) == whole, "nor do partitions and reruns"
    frame = out.toPandas()
    for _, own in frame.groupby("source", dropna=False):
        assert 0 <= own.target.iloc[0] - own.taken.sum() < 1
        epochs = int(own.target.iloc[0] // own.source_size.iloc[0])
        rest = own.taken - epochs * own["size"]
        assert ((rest >= 0) & (rest <= own["size"])).all()
        assert ((rest > 0) & (rest < own["size"])).sum() <= 1
    assert (frame.taken <= 2 * frame["size"]).all()


def test_junk_comes_late(spark):
    rows = [(i, text_of(i, 50), "en", "a", 1) for i in range(600)]
    rows += [(1000 + i, text_of(i, 50).replace(" ", "# "), "en", "a", 1) for i in range(600)]
    rows += [(5000 + i, text_of(i, 60), "en", "b", 1) for i in range(600)]
    taken = {r.doc_id: r.taken // r.size for r in mixture(table(spark, rows)).where("source = 'b'").collect()}
    assert set(taken.values()) <= {0, 1, 2}
    out = mixture(table(spark, rows), share=0.4, most_epochs=2.0).where("source = 'a'").collect()
    good = sum(r.taken > 0 for r in out if r.doc_id < 1000)
    junk = sum(r.taken > 0 for r in out if r.doc_id >= 1000)
    assert good > 2 * junk > 0


def test_mixing_of_awkward_rows(spark):
    df = table(spark, awkward_rows())
    out = mixture(df)
    sizes = sorted(len(WORD.findall(r[1] or "")) for r in awkward_rows())
    assert sorted(r.size for r in out.collect()) == sizes
    mixed = mixed_documents(df)
    assert mixed.columns == df.columns
    words = sum(len(WORD.findall(r.text)) for r in mixed.collect())
    assert words == sum(r.taken for r in out.collect())
    assert mixture(table(spark, [])).collect() == [] and mixed_documents(table(spark, [])).collect() == []
    empty = table(spark, [(1, "", "en", "a", 0), (2, None, "en", "b", 0)])
    assert {(r.target, r.taken) for r in mixture(empty).collect()} == {(0.0, 0)}
    with Staging(spark) as stage:
        assert stage(out, "again").count() == len(sizes)


def test_a_mix_of_whole_documents_parts_none(spark):
    """Texts keep their line ends; each source lands within half a document of its target."""
    rows = [(i, text_of(i, 30 + i).replace(" ", "\n", 5), "en", "abc"[i % 3], 1) for i in range(60)]
    rows.append((99, text_of(99, 4000), "en", "d", 1))
    df = table(spark, rows)
    target = {r.source: r.target for r in mixture(df, share=0.4).collect()}
    taken = mixed_documents(df, share=0.4, whole=True).collect()
    assert {r.text for r in taken} <= {r[1] for r in rows} and {r.n_chars for r in taken} == {1}
    for source in "abc":
        words = sum(len(WORD.findall(r.text)) for r in taken if r.source == source)
        assert abs(words - target[source]) <= 45.5, "half of the longest document, and less than a word"
    assert [r.doc_id for r in taken if r.source == "d"] == [99]
