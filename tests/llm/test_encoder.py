"""The encoder of the token shards and of the packing: the library's ids, each part of a word encoded once."""

import itertools
import random

import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from wattlake.llm import packing, token_repair
from wattlake.llm.queries import tokenizer_file


def test_each_part_of_the_words_is_encoded_once():
    words = ["".join(w) for w in itertools.product("bdfgk", "aeiou", "lmnrs", "aeiou", "tvz")]
    text = " ".join(f"{w}, {w}. {w}\n{w} {w}" for w in words)
    encoder, seen = token_repair.Encoder(tokenizer_file()), []
    library = encoder._encode
    encoder._encode = lambda texts, *a: (seen.extend(texts), library(texts, *a))[1]
    ids, sizes = encoder.encode([text] * 3, 2)
    want = Tokenizer.from_file(tokenizer_file()).encode(text, add_special_tokens=False).ids + [2]
    assert ids.tolist() == 3 * want and sizes.tolist() == 3 * [len(want)]
    assert sum(map(len, seen)) < 2.5 * sum(len(w) + 1 for w in words)


def test_odd_texts_equal_the_library():
    rng, tok = random.Random(4), Tokenizer.from_file(tokenizer_file())
    bits = ["a", "The", " ", " ", "  ", ".", ",", "\n", "\n\n", "é", "×", "ɏ", "ɐ", "12", "don't", "<|endoftext|>", "<|", "\t",
            "\x00", "\x01", " ", "　", "日本", "Straße", "-", "***", " 'll", "\r\n", "\x85", "😀", "ŉ"]
    encoder = token_repair.Encoder(tokenizer_file(), held=50)
    for _ in range(40):
        texts = [None if rng.random() < .05 else "".join(rng.choices(bits, k=rng.randint(0, 25))) for _ in range(30)]
        want = [tok.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]
        ids, sizes = encoder.encode(texts, 2)
        assert ids.tolist() == [i for w in want for i in w] and sizes.tolist() == list(map(len, want))


@pytest.mark.parametrize("rows", [1, 400])
def test_packing_uses_the_workers_one_encoder(rows, monkeypatch):
    monkeypatch.setattr(packing.ex, "pid", lambda: 0)
    monkeypatch.setattr(token_repair, "_ENCODERS", {})
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(rows), pa.int64()), "text": [f"some text {i}" for i in range(rows)]})
    out = list(packing._pieces([batch], tokenizer_file(), 1, 2048))
    assert sum(b.num_rows for b in out) == rows
    assert list(token_repair._ENCODERS) == [tokenizer_file()]
