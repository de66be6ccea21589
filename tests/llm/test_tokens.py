"""Token ids of whole columns against the tokenizer, text by text."""

import random
import sys
import unicodedata

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from ratewise.llm.packing import SIGNS, WordIds
from ratewise.llm.queries import WORD_TOKENIZER


def split(words, texts):
    out = []
    for ids, offsets in words.columns(pa.array(texts, pa.string())):
        out += [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])]
    return out


def test_every_letter_before_a_sign():
    tokenizer, words = Tokenizer.from_file(WORD_TOKENIZER), WordIds(WORD_TOKENIZER)
    rnd = random.Random(1)
    letters = [chr(c) for c in range(sys.maxunicode + 1) if chr(c).isalpha() and not 0xAC10 < c < 0xD7A0 and not 0x20000 < c]
    texts = [f"{c}{rnd.choice(SIGNS)}" for c in letters] + [f"चa{c},b {c}{c}!?" for c in letters]
    want = [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    got = split(words, texts)
    assert [t for t, a, b in zip(texts, got, want) if a != b] == []
    # some of them do change under composing or lower-casing
    assert sum(not unicodedata.normalize("NFC", c).lower().isalpha() for c in letters) > 50


def test_odd_chunks(monkeypatch):
    from ratewise.llm import packing
    monkeypatch.setattr(packing, "PART_CHUNKS", 7)
    tokenizer = Tokenizer.from_file(WORD_TOKENIZER)
    texts = ["", " ", "\n\n", "a", "it's don't WE'LL 'tis '", "x<|endoftext|>y <|ENDOFTEXT|> <|startoftext|>!", "é. É! ́x", "12,345.67%", "a\tb c d\r\ne",
             "ÀÉ! İ! ß? Σας, ΣΑΣ.", "…—«»", "a" * 5000 + "!" * 3000, "é" * 3000 + " " + "日本語。テスト、", "한국어! 한,", "≠ ≮", "a.b.c...", None, "<|", "x|>!"]
    want = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    words = WordIds(WORD_TOKENIZER, most=5)  # the memory is forgotten again and again
    assert split(words, texts) == want and split(words, texts) == want
    assert split(words, [None, "A a", None][1:]) == [tokenizer.encode("a a", add_special_tokens=False).ids, []]
    sliced = pa.array(texts, pa.string()).slice(3, 9)
    got = [ids[a:b].tolist() for ids, o in words.columns(sliced) for a, b in zip(o[:-1], o[1:])]
    assert got == want[3:12]
    rnd = random.Random(2)
    alphabet = "aAbé'’ ,.!<|>1९़ज́İıſK\n"
    many = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 30))) for _ in range(3000)]
    assert split(WordIds(WORD_TOKENIZER), many) == [e.ids for e in tokenizer.encode_batch_fast(many, add_special_tokens=False)]
    assert np.frombuffer(words.ids("a b"), "<u4").tolist() == tokenizer.encode("a b", add_special_tokens=False).ids
