from __future__ import annotations

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from wattspan.llm import tokens

PATH = public_tokenizers.path(tokens.VOCABULARY)


@pytest.fixture(scope="module")
def both():
    library = Tokenizer.from_file(PATH)
    ours = tokens.counter(*tokens.read_vocabulary(PATH), {})
    return ours, lambda text: len(library.encode(text, add_special_tokens=False).ids)


def test_random_texts(both):
    ours, theirs = both
    rng = random.Random(2)
    bits = [*"abcdefgh TH\n\t  '’éßñ漢字🙂\x85\x1c‍_.,!1½", "<|endoftext|>", "'ll", " the", "   ", "tion"]
    for _ in range(3000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 40)))
        assert ours(text) == theirs(text), text


def test_long_pieces(both):
    ours, theirs = both
    for text in ("ab" * 30_000, " " * 5000 + "x", "é" * 20_001, "aaa" * 7777):
        assert ours(text) == theirs(text)


def test_columns(spark, both, small, nasty, nothing):
    theirs = both[1]
    for docs in (small, nasty, nothing):
        got = docs.select("text", tokens.count_tokens(PATH, spark).alias("n")).collect()
        assert all(r["n"] == theirs(r["text"] or "") for r in got)


def test_other_kinds_of_vocabulary_are_refused(tmp_path):
    file = tmp_path / "v.json"
    file.write_text('{"model": {"type": "WordPiece", "merges": []}, "added_tokens": []}')
    with pytest.raises(ValueError):
        tokens.read_vocabulary(str(file))
