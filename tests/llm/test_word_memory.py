"""The memory of encoded words between chunks."""

from llm import packing
from llm.tokenizer_files import tokenizer_path


def test_frequent_words_outlive_a_full_memory(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 50)
    encoder = packing._Encoder(tokenizer_path("word_bpe_49k.json"))
    asked, plain = [], encoder._new
    monkeypatch.setattr(encoder, "_new", lambda words: asked.extend(words) or plain(words))
    frequent = [f"usual{chr(97 + i)}" for i in range(20)]
    for chunk in range(30):
        texts = [*frequent, *(f"rare{chr(97 + chunk % 26)}{chr(97 + i)}{chunk}" for i in range(20))]
        got = encoder.encode([hash(w) for w in texts], lambda at: [texts[i] for i in at])
        assert got == [encoder.ids(w).tobytes() for w in texts]
    # every word is encoded once, however often the memory began anew
    assert sorted(w for w in asked if w.startswith("usual")) == sorted(frequent)
    assert len(encoder.known) <= 50 and len(encoder.before) <= 50 + 40
