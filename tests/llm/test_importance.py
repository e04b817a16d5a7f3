import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers import awkward_rows, table, text_of

from llm import ngram_table
from llm.byteops import text_chunks
from llm.importance import _tables, bucket_counts, resampled
from llm.ngram_table import equal_spans, folded_words, intern, ngrams, span_keys

ODD = ["Ünï-code ÄB 12,3 x" * 3, "ABC abc Abc", "\x7fé{a}é", "a" * 200 + " " + "a" * 199 + "b", "日本 語", "-", "😀x😀"]


def features(text, orders=(1, 1)):
    folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", folded)
    grams = [" ".join(words[i : i + n]) for n in range(orders[0], orders[1] + 1) for i in range(len(words) - n + 1)]
    return words, grams


def brute(rows, target, orders=(1, 1), buckets=10000, percent=10, least=20, seed=2024):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    raw, want = Counter(), Counter()
    for r in rows:
        raw.update(map(bucket, features(r[1], orders)[1]))
    for t in target:
        want.update(map(bucket, features(t, orders)[1]))
    s, t = raw.total(), want.total()
    gain = lambda b: math.floor(1000 * math.log((want[b] + 1) * (s + buckets) / ((raw[b] + 1) * (t + buckets))))
    out = []
    for r in rows:
        words, grams = features(r[1], orders)
        weight = sum(gain(bucket(f)) for f in grams)
        h = int(hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([r[0], len(grams), weight, score, None, len(words)])
    able = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, -r[2], -r[5]))
    for place, r in enumerate(able[: percent * len(able) // 100]):
        r[4] = place + 1
    return sorted(map(tuple, out), key=repr)


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


def targets(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "item_id long, text string")


@pytest.mark.parametrize("orders", [(1, 1), (1, 3), (2, 2)])
def test_same_as_plain_code(spark, orders):
    rows = awkward_rows() + [(100 + i, t, "en", "a", 1) for i, t in enumerate(ODD)]
    rows += [(200 + i, text_of(i, 5 + i % 60, 300), "en", "a", 1) for i in range(300)]
    want = [text_of(i, 30, 90) for i in range(40)] + [None, "", *ODD]
    result = resampled(table(spark, rows), targets(spark, want), orders=orders)
    assert got(result) == brute(rows, want, orders)
    assert sum(r[4] is not None for r in brute(rows, want, orders)) > 10


def test_draw_favours_the_target(spark):
    rows = [(i, text_of(i, 60, 30 if i % 2 else 400), "en", "a", 1) for i in range(400)]
    drawn = resampled(table(spark, rows), targets(spark, [text_of(9, 3000, 30)])).where("rank is not null").collect()
    assert len(drawn) == 40 and all(r.doc_id % 2 for r in drawn)
    assert sorted(r.rank for r in drawn) == list(range(1, 41))


def test_empty_tables(spark):
    assert resampled(table(spark, []), targets(spark, ["a b"])).collect() == []
    rows = awkward_rows()
    assert got(resampled(table(spark, rows), targets(spark, []))) == brute(rows, [])


def test_counts_are_summed_over_all_chunks(spark, monkeypatch):
    monkeypatch.setattr("llm.byteops.CHUNK_BYTES", 50)
    texts = pa.array([text_of(i, 20) for i in range(30)] + [None])
    total = np.zeros(97, np.int64)
    for _, _, _, tab in _tables(texts, (1, 2), 97):
        np.add.at(total, tab.bucket, tab.count)
    expected = Counter(zlib.crc32(f.encode()) % 97 for t in texts for f in features(t.as_py(), (1, 2))[1])
    assert total.tolist() == [expected[b] for b in range(97)]
    rows = [(i, t.as_py(), "en", "a", 1) for i, t in enumerate(texts)]
    assert bucket_counts(table(spark, rows), orders=(1, 2), buckets=97).tolist() == total.tolist()


def _spans(texts, orders=(1, 1)):
    ((_, data, offsets),) = text_chunks(pa.array(texts))
    data, starts, ends, first = folded_words(data, offsets)
    starts, ends, _ = ngrams(starts, ends, first, *orders)
    return data, starts, ends


@pytest.mark.parametrize("keys", ["own", "all equal", "few", "wrapping"])
def test_table_tells_spans_apart_by_their_bytes(keys):
    """Also where keys collide: the bytes decide, at the end of the table probing goes on at its start."""
    texts = [*ODD, text_of(1, 300, 200), text_of(2, 300, 200)]
    data, starts, ends = _spans(texts, (1, 2))
    own = span_keys(data, starts, ends)
    given = {
        "own": own,
        "all equal": np.full(len(own), 7, np.uint64),
        "few": own % np.uint64(3),
        "wrapping": np.full(len(own), 2**64 - 1, np.uint64),
    }[keys]
    found = intern(data, starts, ends, given, 10000)
    words = [data[s:e].tobytes() for s, e in zip(starts, ends, strict=True)]
    by_slot = {}
    for slot, word in zip(found.slot.tolist(), words, strict=True):
        assert by_slot.setdefault(slot, word) == word
    assert len(by_slot) == len(set(words))
    counts = Counter(words)
    for slot, word in by_slot.items():
        assert found.count[slot] == counts[word] and found.bucket[slot] == zlib.crc32(word) % 10000


def test_keys_are_xxhash64_with_and_without_gaps():
    from xxhash import xxh64_intdigest

    data, starts, ends = _spans([*ODD, "one two  THREE"])
    words = [data[s:e].tobytes() for s, e in zip(starts, ends, strict=True)]
    assert span_keys(data, starts, ends).tolist() == [xxh64_intdigest(w) for w in words]
    some = slice(1, None, 2)
    assert span_keys(data, starts[some], ends[some]).tolist() == [xxh64_intdigest(w) for w in words[some]]


def test_equal_spans_at_every_length():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 3, 3000, dtype=np.uint8)
    data[1500:] = data[:1500]
    a, length = np.repeat(np.arange(0, 1200, 40), 100), np.tile(np.arange(1, 101), 30)
    same = equal_spans(data, a, a + 1500, length)
    assert same.all()
    other = equal_spans(data, a, a + 1501, length)
    assert other.tolist() == [bool((data[i : i + n] == data[i + 1501 : i + 1501 + n]).all()) for i, n in zip(a, length)]


def test_words_of_neighbouring_texts_stay_apart():
    data, starts, ends = _spans(["ab", "cd", "", "ef gh", None, "x"])
    assert [data[s:e].tobytes() for s, e in zip(starts, ends)] == [b"ab", b"cd", b"ef", b"gh", b"x"]
    assert ngram_table.folded_words(np.zeros(0, np.uint8), np.array([0, 0]))[3].tolist() == [0, 0]
