import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from goldpan.llm import token_counts as tc
from tests.llm.conftest import ODD_ROWS

PATH = public_tokenizers.path("word_bpe_49k.json")
PIECES = [
    "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "Σ", "ΑΣ ", "İ", "e\u0301", "ẛ̣", "'s", "'S", "I'LL", "\x1c", "\x85",
    "\u00a0", "½", "²", "१", "日本", "😀", "\u200d", "_", "--", "a", "B", "9", " ", "\n", "ͅ", "ǅ", "ß", "ﬁ", "\x00", "\u3000", "'", "क़",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize("most", [3, 100_000])
def test_as_the_library(library, most):
    draw = random.Random(1)
    count = tc.counter(PATH, most)
    for _ in range(3000):
        text = "".join(draw.choice(PIECES) for _ in range(draw.randrange(10)))
        assert count(text.encode()) == (len(text.encode()), len(library.encode(text, add_special_tokens=False))), repr(text)


def test_odd_and_empty(odd, empty, library):
    found = tc.count_tokens(odd, PATH)
    expected = sorted(
        (i, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False)), n > 2048)
        for i, t, _ in ODD_ROWS
        if i is not None
    )
    assert sorted(tuple(r) for r in found.where("doc_id is not null").collect()) == expected
    assert found.where("doc_id is null").count() == 2
    assert tc.count_tokens(empty, PATH).isEmpty()


def test_a_later_task_learns_nothing_anew(library, monkeypatch):
    text = "Remembered words, remembered. Ünïcode 日本 x1 <|endoftext|>"
    raw = text.encode()
    expected = (len(raw), len(library.encode(text, add_special_tokens=False)))
    assert tc.counter(PATH, 1000)(raw) == expected
    monkeypatch.setattr(tc.PieceCounts, "learn", None)
    assert tc.counter(PATH, 1000)(raw) == expected


def test_white_space_and_marks_at_the_borders_of_chunks(library):
    count = tc.counter(PATH, 1000)
    for text in ("E ́é", "word. Word.\n,a", "a\x0b\x0cb\x1cc\x85d e", "1, 2.", "x.́ ", "Ḱ. İ"):
        assert count(text.encode())[1] == len(library.encode(text, add_special_tokens=False)), repr(text)
