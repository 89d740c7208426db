from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wattspan.llm import bpe

PATH = public_tokenizers.path(bpe.VOCABULARY)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def ids():
    of_texts = bpe.encoder(bpe.Pieces(bpe.read_vocabulary(PATH)))
    return lambda text: np.frombuffer(next(of_texts([text])), np.int32).tolist()


def theirs(library, text):
    return library.encode(text, add_special_tokens=False).ids


def test_random_texts(library, ids):
    rng = random.Random(3)
    bits = [*"abcdefgh TH\n\t\x0b '’éßñ漢字🙂\x85\x1c\x1f‍_.,!1½", "<|endoftext|>", "<|endo", "'ll", " the", "   "]
    for n in range(3000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 40)))
        if n % 2:  # the pattern for ASCII texts has to cut alike
            text = text.encode("ascii", "ignore").decode()
        assert ids(text) == theirs(library, text), text


def test_long_pieces(library, ids):
    for text in ("ab" * 30_000, " " * 5000 + "x", "é" * 20_001, "aaa" * 7777):
        assert ids(text) == theirs(library, text)


def test_merges_equal_a_plain_search():
    words = bpe.read_vocabulary(PATH)

    def plain(piece):
        out = [words.of_byte[b] for b in piece]
        while True:
            ranks = [(words.pairs.get(a << 32 | b, 1 << 60), i) for i, (a, b) in enumerate(zip(out, out[1:]))]
            if not ranks or min(ranks)[0] == 1 << 60:
                return out
            rank, i = min(ranks)
            out[i : i + 2] = [words.merged[rank]]

    rng = random.Random(4)
    for _ in range(500):
        piece = bytes(rng.choice(b"aaabcdeinorst \xc3\xa9") for _ in range(rng.randint(1, 70)))
        assert bpe.encode_piece(piece, words) == plain(piece)
    merger = bpe.Merger(words)
    for width in (1, 2, 4, 8, 16, 32, 64):
        pieces = [bytes(rng.choice(b"aaabcdeinorst \xc3\xa9") for _ in range(rng.randint(2, width + 1))) for _ in range(300)]
        got = [np.frombuffer(x, np.int32).tolist() for x in merger.merge(pieces, width)]
        assert got == [plain(p) for p in pieces]


def test_kept_pieces_are_bounded(monkeypatch, library):
    monkeypatch.setattr(bpe, "KEPT", 100)
    monkeypatch.setattr(bpe, "BLOCK", 1 << 10)
    pieces = bpe.Pieces(bpe.read_vocabulary(PATH))
    texts = [" ".join(f"word{chr(97 + i % 26)}{i // 7}x" for i in range(k, k + 40)) for k in range(0, 2000, 13)]
    got = [np.frombuffer(x, np.int32).tolist() for x in bpe.encoder(pieces)(texts)]
    assert got == [theirs(library, text) for text in texts]
    assert len(pieces) + len(pieces.old) <= 800  # two halves, and what one block brings


def test_columns(spark, library, small, nasty, nothing):
    for docs in (small, nasty, nothing):
        docs = docs.withColumn("ids", F.lit("own"))
        found = bpe.encoded(docs, PATH)
        assert found.columns == [*docs.columns, "decoded"]
        for row in found.select("text", "ids", "decoded").collect():
            assert row["ids"] == theirs(library, row["text"] or "")
            assert row["decoded"] == (row["text"] or "")


def test_decoding_of_odd_ids(spark, library):
    rows = [([3, 50256, 3],), (None,), ([],), ([10**7, 64, None],), ([220, 187],), ([94, 95, 162],)]
    df = spark.createDataFrame(rows, "ids array<int>")
    got = [r[0] for r in df.select(bpe.decode(PATH, spark)).collect()]
    want = [library.decode([i for i in r[0] or [] if i is not None], skip_special_tokens=False) for r in rows]
    assert got == want


def test_query(spark, library):
    rows = bpe.op13_bpe(spark, "/root/testdata/sf0.001").collect()
    texts = dict(map(tuple, spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()))
    assert len(rows) == len(texts)
    for row in rows:
        ids = theirs(library, texts[row["doc_id"]] or "")
        digests = [",".join(map(str, ids)), library.decode(ids, skip_special_tokens=False)]
        assert row["n_tokens"] == len(ids)
        assert [row["ids_sha256"], row["decoded_sha256"]] == [hashlib.sha256(x.encode()).hexdigest() for x in digests]
