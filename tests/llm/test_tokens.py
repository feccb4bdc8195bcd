"""Ids equal those of the tokenizers library, word by word and in prose."""

import random

import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from ledgerflow.llm import tokens
from ledgerflow.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_path())


def differing(library, texts):
    ids, offsets = tokens.WordEncoder(tokenizer_path()).encode(pa.array(texts))
    want = library.encode_batch(texts, add_special_tokens=False)
    return [t for i, t in enumerate(texts) if ids[offsets[i]:offsets[i + 1]].tolist() != want[i].ids]


def test_every_last_letter_before_every_closing_mark(library):
    texts = [f"ab{chr(c)}{mark} x" for c in range(0x250) for mark in ".,;:!?"]
    texts += [f"{chr(c)}{mark}{mark}" for c in range(0x250) for mark in ".,;:!?"]
    assert differing(library, texts) == []


def test_turkish_and_random_texts(library):
    rng = random.Random(6)
    letters = "abI\u0130\u0131\u00c9\u00e9\u0049\u0307Z\u00df.,;:!? \n'0123\u00a0\u4e00<|>"
    texts = ["T\u00dcRK\u0130YE B\u0130RL\u0130\u011e\u0130, EV\u0130! \u0130?"]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(20_000)]
    texts += ["".join(chr(rng.choice([rng.randrange(32, 0x250), rng.randrange(0x250, 0xD800), rng.randrange(0x1F300, 0x1F600)])) for _ in range(12))
              for _ in range(10_000)]
    assert differing(library, texts) == []


def test_a_full_cache_starts_anew(library):
    encoder, rng = tokens.WordEncoder(tokenizer_path()), random.Random(1)
    encoder.cache_words = 50
    for _ in range(20):
        texts = [" ".join(f"word{rng.randrange(300)}" for _ in range(30))]
        ids, _ = encoder.encode(pa.array(texts))
        assert ids.tolist() == library.encode(texts[0], add_special_tokens=False).ids
