"""Token ids by word against the tokenizer itself, and what is merged anew."""

from __future__ import annotations

import public_tokenizers
import pyarrow as pa
import pytest

from tallyfold.llm import packing

TEXTS = ["Plain words, plain WORDS; ça été naïve", "x1 don't 漢字 plain", "", "Ünder été words été\n\tmore words!!", "zzqx plain words"]


@pytest.mark.parametrize("remembered", [400_000, 6, 2])
def test_ids_equal_the_tokenizer_whatever_is_remembered(monkeypatch, remembered):
    monkeypatch.setattr(packing, "REMEMBERED_PLAIN", remembered)
    tokens = packing.WordTokens(public_tokenizers.path("word_bpe_49k.json"))
    for texts in (TEXTS, TEXTS[::-1], ["new words", *TEXTS], []):
        ids, begins = tokens.ids(pa.array(texts, type=pa.string()))
        for k, text in enumerate(texts):
            assert ids[begins[k] : begins[k + 1]].tolist() == tokens.tokenizer.encode(text, add_special_tokens=False).ids
        assert len(tokens.words) <= remembered


def test_plain_words_are_merged_once():
    tokens = packing.WordTokens(public_tokenizers.path("word_bpe_49k.json"))
    merge, calls = tokens.merge, []
    tokens.merge = lambda word: (calls.append(word), merge(word))[1]
    for _ in range(3):
        tokens.ids(pa.array(["some plain words", "plain été"]))
    assert len(calls) == 4
