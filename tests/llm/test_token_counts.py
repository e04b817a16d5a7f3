import public_tokenizers
import pytest
from helpers import awkward_rows, rows_of, table, text_of
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from test_packing import ODD
from tokenizers import Tokenizer

from llm import token_counts as counting
from llm.token_counts import divides_words, normalised, stored_counts, token_counts
from llm.tokenizer_files import tokenizer_path, version_digest

NAME = "word_bpe_49k.json"
MORE = ["H̱ T̈ J̌ Å", "A\t\tB\n\nC\r\nD", "<|ENDOFTEXT|> <|endoftext|>X", "a\x0bb\x0cc\x1cd", "'S it'LL DON'T", " a b\u0085c"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_path(NAME))


def brute(rows, size, limit=2048):
    out = []
    for r in rows:
        n = size(r[1] or "")
        out.append((r[0], len((r[1] or "").encode()), n, n > limit))
    return sorted(out, key=repr)


def all_rows():
    rows = awkward_rows() + [(300 + i, t, "en", "a", 1) for i, t in enumerate([*ODD, *MORE])]
    return rows + [(400 + i, text_of(i % 40, i % 90).upper(), "en", "a", 1) for i in range(150)]


def test_counts_are_the_librarys(spark, tokenizer):
    rows = all_rows()
    result = token_counts(table(spark, rows), NAME)
    assert rows_of(result) == brute(rows, lambda t: len(tokenizer.encode(t, add_special_tokens=False).ids))
    assert any(r.over_limit for r in result.collect())


@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "byte_bpe_50k.json"])
def test_other_tokenizers(spark, name):
    rows = all_rows()[:40]
    if name.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))
        size = lambda t: len(model.encode(t))
    else:
        made = Tokenizer.from_file(public_tokenizers.path(name))
        size = lambda t: len(made.encode(t, add_special_tokens=False).ids)
    assert not divides_words(name)
    assert rows_of(token_counts(table(spark, rows), name)) == brute(rows, size)


def test_only_misses_are_encoded_and_appended(spark, root, monkeypatch):
    first, second = all_rows()[:60], all_rows()
    token_counts(table(spark, first), NAME, f"{root}/cache").collect()
    version = version_digest(NAME)
    stored = stored_counts(spark, f"{root}/cache", version)
    assert stored.count() == stored.select("digest").distinct().count() > 20
    kept = stored.count()
    # a count that only the cache can have given
    odd = spark.createDataFrame([(900, "never to be encoded", "en", "a", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    key = odd.select(F.unhex(F.sha2(normalised(F.col("text"), True).cast("binary"), 256)).alias("digest"))
    key.select("digest", F.lit(77).cast("long").alias("n_tokens"), F.lit(version).alias("version")).write.mode("append").partitionBy(
        "version"
    ).parquet(f"{root}/cache")
    assert [r.n_tokens for r in token_counts(odd, NAME, f"{root}/cache").collect()] == [77]
    again = token_counts(table(spark, second), NAME, f"{root}/cache")
    assert rows_of(again) == rows_of(token_counts(table(spark, second), NAME))
    stored = stored_counts(spark, f"{root}/cache", version)
    assert kept + 1 < stored.count() == stored.select("digest").distinct().count()
    monkeypatch.setattr(counting, "_count_batches", None)  # a warm cache encodes nothing
    assert rows_of(token_counts(table(spark, second), NAME, f"{root}/cache")) == rows_of(again)


def test_another_version_has_counts_of_its_own(spark, root, tmp_path):
    docs = spark.createDataFrame([(1, "some words here"), (2, "some words here")], "doc_id long, text string")
    changed = tmp_path / "changed.json"
    text = open(tokenizer_path(NAME), encoding="utf-8").read()
    changed.write_text(text + "\n", encoding="utf-8")
    token_counts(docs, NAME, f"{root}/cache").collect()
    assert stored_counts(spark, f"{root}/cache", version_digest(str(changed))).count() == 0
    token_counts(docs, str(changed), f"{root}/cache").collect()
    assert stored_counts(spark, f"{root}/cache", version_digest(str(changed))).count() == 1
    assert stored_counts(spark, f"{root}/cache", version_digest(NAME)).count() == 1


def test_counts_stored_twice_give_one_row(spark, root):
    docs = spark.createDataFrame([(1, "some words here"), (2, "other")], "doc_id long, text string")
    expected = rows_of(token_counts(docs, NAME, f"{root}/cache"))
    held = spark.read.parquet(f"{root}/cache").collect()
    spark.createDataFrame(held, "digest binary, n_tokens long, version string").write.mode("append").partitionBy("version").parquet(f"{root}/cache")
    assert rows_of(token_counts(docs, NAME, f"{root}/cache")) == expected


def test_many_misses_take_the_other_join(spark, root, monkeypatch):
    rows = all_rows()
    expected = rows_of(token_counts(table(spark, rows), NAME))
    monkeypatch.setattr(counting, "_broadcast_bytes", lambda spark: -1)
    token_counts(table(spark, rows[:50]), NAME, f"{root}/cache").collect()
    assert rows_of(token_counts(table(spark, rows), NAME, f"{root}/cache")) == expected


def test_empty_table(spark, root):
    assert token_counts(table(spark, []), NAME, f"{root}/cache").collect() == []


@pytest.fixture(scope="module")
def normal(spark):
    def all_of(texts):
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
        return [r.n for r in df.select("i", normalised(F.col("text"), True).alias("n")).orderBy("i").collect()]

    return all_of


units = st.sampled_from([*"aAbB sS'<|>\t\n\r\x0bH\u0331T\u0308\u0130\u00df\u03a3\u03c21.!\u00e9e\u0301 ", "<|endoftext|>", "'ll", "  "])
letters = st.lists(units, max_size=25).map("".join)


@settings(max_examples=15, deadline=None)
@given(st.lists(letters, min_size=30, max_size=60))
def test_normalising_keeps_the_count(normal, tokenizer, texts):
    size = lambda t: len(tokenizer.encode(t, add_special_tokens=False).ids)
    assert list(map(size, normal(texts))) == list(map(size, texts))
