"""Ids gathered from pieces are those of the tokenizers library, on texts full of white space of all kinds, in bounded memory."""

import random

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from routelens.llm import piece_ids
from routelens.llm.bpe_ids import SPECIAL, PieceEncoder
from routelens.llm.piece_ids import PieceIds

PATH = public_tokenizers.path("byte_bpe_50k.json")
BLANKS = [" ", " ", "  ", "\n", "\n\n", " \n", "\n ", "\t", "\r\n", " ", "  ", "  ", "\x1c", " \x1f", "\x0b\x0c", "\x85", "   \n\n  ", "　"]
WORDS = ["the", "House", "é", "naïve", "12", "3.5", "...", "it's", "'s", "I'LL", "日本", "😀", "_", "<|", SPECIAL, "x" * 90, "ß", "​", "́"]


def library(texts):
    tokenizer = Tokenizer.from_file(PATH)
    return [tokenizer.encode(text, add_special_tokens=False).ids for text in texts]


def found(ids, texts):
    values, firsts = ids.of(pa.array(texts, pa.string()))
    return [values[a:b].tolist() for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist(), strict=True)]


def random_texts(seed, n=400, special=True):
    rng = random.Random(seed)
    words = [w for w in WORDS if special or w != SPECIAL]
    return ["".join(rng.choice(rng.choice([words, BLANKS])) for _ in range(rng.randrange(25))) for _ in range(n)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_as_the_library(seed, monkeypatch):
    texts = ["", " ", "\n", "a", " a ", "\n\na", "a\n\n", *random_texts(seed, special=seed != 3)]
    ids = PieceIds(PieceEncoder(PATH), SPECIAL, 10**6)
    expected = library(texts)
    assert found(ids, texts) == expected
    assert found(ids, texts[::-1]) == expected[::-1]  # now remembered
    monkeypatch.setattr(piece_ids, "CHUNK", 7)
    assert found(PieceIds(PieceEncoder(PATH), SPECIAL, 3), texts) == expected
    sliced = pa.array(["zz", *texts], pa.string()).slice(1)
    assert ids.of(sliced)[1].tolist() == np.concatenate([[0], np.cumsum([len(e) for e in expected])]).tolist()


def test_no_texts():
    ids = PieceIds(PieceEncoder(PATH), SPECIAL, 10)
    assert found(ids, []) == [] and found(ids, ["", ""]) == [[], []]


def test_memory_does_not_grow_with_texts():
    ids = PieceIds(PieceEncoder(PATH), SPECIAL, 10**6)
    rng = random.Random(4)
    words = [f"w{i}" for i in range(500)]
    held = []
    for _ in range(4):
        texts = ["\n\n".join("  ".join(rng.choices(words, k=12)) for _ in range(30)) + "\n\n" + "é" * 400 for _ in range(100)]
        found(ids, texts)
        held.append(ids.held_bytes)
    assert held[-1] <= 1.05 * held[-2] and held[-1] < 100_000
    small = PieceIds(PieceEncoder(PATH), SPECIAL, 50)
    assert found(small, texts) == found(ids, texts) and small.held_bytes < held[-1]
