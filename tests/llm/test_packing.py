import random

import numpy as np
import public_tokenizers
import pytest
from helpers import awkward_rows, table, text_of
from tokenizers import Tokenizer

import corpus_pipeline
from llm import packing
from llm.packing import hilbert_key, pack

PATH = public_tokenizers.path("word_bpe_49k.json")
NAME = "word_bpe_49k.json"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


ODD = [
    "It's THE <|endoftext|> end<|startoftext|>ing, isn't-it? 'll 've x's.y",
    "ﬁne Ångström étude ÅÉÎ straße İstanbul ΟΔΟΣ Σ.Α ǅ 日本語テキスト ½ ² ٣٤",
    "a b c d​e\x00f .̸x ≠ é≠ é.́ x.́y —, ×÷ ª º µ",
    "🙂🙂.,!? a1b2c3 3.14 x_y-z/w \\ | # [b]{c}(d) ~^`\"q\"",
    "<|END|> The.The a.'s it.'S we'LL !!!??? ...word",
]


def check(pieces, rows, tokenizer, length=2048):
    """Every id of every document lies in one piece; sequences are full but for the last."""
    expected = sorted([*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 1] for r in rows)
    documents, sequences = {}, {}
    for p in pieces:
        ids = np.frombuffer(p.tokens, "<u4").tolist()
        assert len(ids) == p.length and p.offset + p.length <= length
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
        # the place of a document's start in the whole stream tells documents of one id apart
        documents.setdefault((p.doc_id, p.sequence_id * length + p.offset - p.start), []).append((p.start, ids, p.doc_tokens))
    found = []
    for parts in documents.values():
        parts.sort()
        joined = [i for _, ids, _ in parts for i in ids]
        assert [start for start, _, _ in parts] == np.cumsum([0] + [len(ids) for _, ids, _ in parts])[:-1].tolist()
        assert {n for _, _, n in parts} == {len(joined)}
        found.append(joined)
    assert sorted(found) == expected
    assert sorted(sequences) == list(range(len(sequences)))
    for number, spans in sequences.items():
        spans.sort()
        assert [a for a, _ in spans] == np.cumsum([0] + [n for _, n in spans])[:-1].tolist()
        assert sum(n for _, n in spans) == length or number == len(sequences) - 1


@pytest.mark.parametrize("length", [2048, 7])
def test_ids_survive_whole(spark, tokenizer, length):
    rows = awkward_rows() + [(300 + i, t, "en", "a", 1) for i, t in enumerate(ODD)]
    rows += [(400 + i, text_of(i, i % 90), "en", "a", 1) for i in range(150)]
    check(pack(table(spark, rows), NAME, length=length).collect(), rows, tokenizer, length)


def test_memory_of_words_changes_nothing(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 20)
    monkeypatch.setattr(packing, "ENCODE_WORDS", 3)
    encoder = packing._Encoder(PATH)
    words = sorted({w for t in [*ODD, text_of(1, 300)] for w in t.split(" ") if w})
    rng = random.Random(1)
    for _ in range(5):
        some = rng.sample(words, 60)
        got = encoder.encode([hash(w) for w in some], lambda at, some=some: [some[i] for i in at])
        for word, ids in zip(some, got):
            assert np.frombuffer(ids, "<u2").tolist() == tokenizer.encode(word, add_special_tokens=False).ids


def test_empty_table(spark):
    assert pack(table(spark, []), PATH).collect() == []


@pytest.mark.parametrize("dimensions,bits", [(2, 4), (3, 3), (4, 2)])
def test_hilbert_curve_visits_each_cell_from_a_neighbour(dimensions, bits):
    cells = np.stack(np.meshgrid(*[np.arange(2**bits)] * dimensions, indexing="ij"), -1).reshape(-1, dimensions)
    keys = hilbert_key(cells, bits)
    assert sorted(keys.tolist()) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def test_like_documents_are_packed_near_each_other(spark):
    rows = [(i, text_of(i, 200, 30 if i % 2 else 60), "en", "a", 1) for i in range(120)]
    # two vocabularies: even and odd ids
    rows = [(i, t if i % 2 else " ".join(w[::-1] + "q" for w in t.split()), *r) for i, t, *r in rows]
    order = [p.doc_id % 2 for p in sorted(pack(table(spark, rows), PATH).where("start = 0").collect(), key=lambda p: (p.sequence_id, p.offset))]
    changes = sum(a != b for a, b in zip(order, order[1:]))
    assert changes < 30, "by chance it would be about 60"


def test_pipeline_stage_by_stage(spark, sf_dir, tokenizer):
    """Each stage on what its predecessor kept, against plain code on the same rows."""
    from llm.secret_scan import secret_scan
    from test_near_dedup import brute
    from test_scans import rule_row

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "near_dedup", "secret_scan", "mixing", "packing"]
    stages, base = {}, docs
    for name, function in corpus_pipeline.STAGES:
        base = spark.createDataFrame(function(spark, base, sf_dir).collect(), function(spark, base, sf_dir).schema)
        stages[name] = base
        assert name == "packing" or base.columns == docs.columns
    as_rows = lambda df: [tuple(r) for r in df.collect()]
    kept = {r[0] for r in as_rows(stages["quality_rules"])}
    assert not any(rule_row(r)[-1] for r in as_rows(docs) if r[0] in kept)
    assert 0.7 * docs.count() < len(kept) < docs.count()
    one_each = {r[0] for r in brute(as_rows(stages["quality_rules"])) if r[3]}
    assert {r[0] for r in as_rows(stages["near_dedup"])} == one_each
    clean = stages["secret_scan"]
    assert clean.count() == stages["near_dedup"].count()
    assert secret_scan(clean).where("spans <> ''").count() == 0
    ids = {r[0] for r in as_rows(clean)}
    mixed = as_rows(stages["mixing"])
    assert {r[0] for r in mixed} <= ids and len(mixed) > len(ids)
    check(stages["packing"].collect(), mixed, tokenizer)


def test_run_gives_the_last_stage(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.columns == ["doc_id", "start", "length", "tokens", "doc_tokens", "sequence_id", "offset"]
    assert out.count() > 100
