"""Ids by way of words against the tokenizer on whole texts."""

import numpy as np
import pyarrow as pa

from cratewise.llm import packing
from cratewise.llm.queries import vocabulary

PARTS = [
    *"aAzZ019 .,'\"-<|>_#\n\t", "'s", "'S", "'ll", "don't", "O'Re", "İ", "K", "é", "É", "é", "W̊", "ẘ", "≠", "5⃣", "ß", "Σ", "ς",
    "你好", "‍", "👩", "️", "٣", "½", " ", " ", "“", "’s", "<|endoftext|>", "<|ENDOFTEXT|>", "ﬁ", "가",
]


def texts(count=3000):
    rng = np.random.default_rng(5)
    return ["", *["".join(rng.choice(PARTS, int(rng.integers(1, 14)))) for _ in range(count)]]


def encoded(words, some):
    ids, bounds = words.encode(pa.array(some, pa.large_string()))
    return [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:], strict=False)]


def test_ids_are_those_of_whole_texts(monkeypatch):
    monkeypatch.setattr(packing, "LEARNED_AT_ONCE", 100)
    words, some = packing.WordIds(vocabulary(), kept=500), texts()
    wanted = [words.tokenizer.encode(t, add_special_tokens=False).ids for t in some]
    assert encoded(words, some) == wanted
    assert [x for low in range(0, len(some), 50) for x in encoded(words, some[low : low + 50])] == wanted
    assert len(words.recent) + len(words.older) <= 500


def test_spellings_and_numbers_are_no_new_words():
    words = packing.WordIds(vocabulary())
    encoded(words, [f"Item-{n}, ITEM #{n}: it's {n}.{n}; (item)" for n in range(2000)])
    assert len(words.recent) < 30
