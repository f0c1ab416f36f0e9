"""Parts of many texts are encoded side by side, with the ids of the library."""

import random

import numpy as np
import public_tokenizers as tokenizers
import pytest

from foliograph.llm import sentencepiece_bpe as S

PATH = tokenizers.path("piece_bpe_32k.model")
ODD = ["the", "an", "é", "ß", "\n", " ", "  ", "a", "$$$", "123", "中文", "\x00", "🙂", "▁", "ing", "\t", "x" * 120, "http://", "\r\n"]


@pytest.fixture(scope="module")
def texts():
    pick = random.Random(5)
    words = ["".join(pick.choices(["the", "an", "ee", "ß", "ou", "ch", "r", "ó", "."], k=pick.randint(1, 6))) for _ in range(3000)]
    odd = ["".join(pick.choices(ODD, k=pick.randint(0, 30))) for _ in range(500)]
    return [" ".join(words[:2000]) + "\n" + "\n".join(words[2000:]), *odd, "", "\n", "a \nb", "a\n b", "\na ", None]


def test_known_parts_are_not_encoded_alone(texts, monkeypatch):
    import sentencepiece

    library, own = sentencepiece.SentencePieceProcessor(model_file=PATH), S.PieceModel(S.read_model(PATH))
    assert own.encode(texts[0]) == np.array(library.encode(texts[0]), "<u4").tobytes()
    own.forget()
    own.learn(texts[:1])
    monkeypatch.setattr(own, "core", None)  # encodes one text
    assert own.encode(texts[0]) == np.array(library.encode(texts[0]), "<u4").tobytes()


@pytest.mark.parametrize("full", [False, True])
def test_ids_of_the_library(texts, monkeypatch, full):
    import sentencepiece

    if full:  # tables that overflow, groups and large texts in small
        for name, value in {"PARTS": 40, "CORES": 30, "PAIRS": 50, "LARGE": 400, "SIDE_BY_SIDE": 300}.items():
            monkeypatch.setattr(S, name, value)
    library, own = sentencepiece.SentencePieceProcessor(model_file=PATH), S.PieceModel(S.read_model(PATH))
    own.learn(texts)
    for t in texts:
        assert np.frombuffer(own.encode(t or ""), "<u4").tolist() == library.encode(t or ""), t


def test_pairs_by_touching_edges(texts):
    own, pick = S.PieceModel(S.read_model(PATH)), random.Random(2)
    ids = [own.id[p] for p in sorted(own.whole)]
    for _ in range(3000):
        left, right = pick.choice(ids), pick.choice(ids)
        both = [own.pieces[left], own.pieces[right]]
        assert own.compatible(left, right) == (own.merged("".join(both)) == both)
