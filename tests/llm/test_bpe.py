"""BPE against the tokenizers library."""

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from shelfmark.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def theirs():
    return Tokenizer.from_file(PATH)


def texts():
    draw = random.Random(5)
    odd = ["", "  ", "I'm <|endoftext|>x <|startoftext|>", "ΑΣ ΣΑΣ ÀÉ é \x1c a\x1db 　２３ ½",
           "a" * 1000, "x" * 63 + " " + "y" * 64 + " " + "é" * 40, "İstanbul ﬁ 漢字かな we'LL",
           "<|endoftext|><|", "<|STARTOFTEXT|> <|ENDOFTEXT|>", "a<|EndOfText|>b <|endoftext|>",
           "<|endoftext|><|ENDOFTEXT|> <|endoftext|", "x<|startoftext|>y", "'S'T 12345 ...!!! a_b"]
    letters = "abctheinö'é .,1\n漢\U0001d518"
    return odd + ["".join(draw.choice(letters) for _ in range(draw.randint(1, 200)))
                  for _ in range(500)]


def test_ids_and_texts_are_those_of_the_library(theirs):
    ours = bpe.WordBpe(PATH)
    for text, ids in zip(texts(), ours.encode_batch(texts()), strict=True):
        want = theirs.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert ours.decode(ids) == theirs.decode(want, skip_special_tokens=False)


def test_long_and_short_words_merge_alike():
    ours = bpe.WordBpe(PATH)
    draw = random.Random(6)
    for _ in range(300):
        word = bytes(draw.choice(b"theinga\xc3\xa9") for _ in range(draw.randint(1, 60)))
        many = np.frombuffer(ours.merge_many([word], 64)[0], "<u4").tolist()
        assert many == ours.merge_long(word)


def test_cache_is_bounded(theirs, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 10)
    ours = bpe.WordBpe(PATH)
    for text in texts():
        [ids] = ours.encode_batch([text])
        assert np.frombuffer(ids, "<u4").tolist() == theirs.encode(
            text, add_special_tokens=False).ids
