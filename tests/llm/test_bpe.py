import hashlib
import random

import numpy as np
import pytest
import public_tokenizers
import tiktoken

from tallywind.llm import bpe
from tallywind.llm.queries import ranks_path
from tests.llm.corpus import ODD, docs

SIGNS = ["'", "s", "t", "re", "ve", "ll", "d", "m", " ", "  ", "\n", "\r\n", "\t", " ", "a", "B", "é", "漢", "1", "٣", "½"]
SIGNS += ["!", "..", "😀", "''", "x'", "'S", "\u0085", "퟿", "\x00", "\x1c", "ʼ", "़", "　"]


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.read_ranks(ranks_path()))


@pytest.fixture(scope="module")
def library(codec):
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={}
    )


def ids(found):
    return np.frombuffer(found, "<u4").tolist()


def test_as_the_library(codec, library):
    rng = random.Random(1)
    texts = ["".join(rng.choice(SIGNS) for _ in range(rng.randint(0, 30))) for _ in range(4000)]
    texts += [t or "" for t in ODD] + ["ab" * 3000, "'" * 100 + "s", " " * 300, "\n" * 99 + "x", "é" * 999]
    for text, found in zip(texts, codec.encode(texts), strict=True):
        assert ids(found) == library.encode_ordinary(text), repr(text)
        assert codec.decode(found, codec.ends(found)) == text.encode()


def test_slices_join_to_the_text():
    texts = ["it's  a\n\n test's", "", "don'tre 'll", "漢字 123abc"]
    cut = list(bpe.slices(texts))
    assert [b"".join(p).decode() for p in cut] == texts
    assert cut[0] == [b"it", b"'s", b" ", b" a", b"\n\n", b" test", b"'s"]
    assert list(bpe.slices([])) == []


def test_offsets_retain_every_token(codec):
    text = "some words, 漢字 and more"
    found = codec.encode([text])[0]
    ends = np.frombuffer(codec.ends(found), "<u4").tolist()
    raw = text.encode()
    assert [raw[a:b] for a, b in zip([0, *ends], ends, strict=False)] == [codec.words[i] for i in ids(found)]


def test_full_cache_gives_way(monkeypatch, library):
    monkeypatch.setattr(bpe.Codec, "CACHE", 3)
    own = bpe.Codec(bpe.read_ranks(ranks_path()))
    for text in ("a few wordsof zzqx", "and othersx hereq", "a few wordsof zzqx", "qqxz vvxq wwxz"):
        assert ids(own.encode([text])[0]) == library.encode_ordinary(text)
        assert len(own.cache) < 12


def test_rows(spark, library):
    rows = [(k, t) for k, t in enumerate(ODD)] + [(4, ODD[4]), (None, "x y")]
    table = docs(spark, rows)
    tokens = bpe.tokenize(table, ranks_path(), carry=("row", "source"), decode=True)
    assert tokens.columns == ["doc_id", "row", "source", "ids", "ends", "decoded", "n_tokens"]
    again = bpe.detokenize(bpe.tokenize(table, ranks_path()), ranks_path())
    twice = {bytes(r["ids"]): bytes(r["decoded"]) for r in again.collect()}
    tokens = tokens.collect()
    assert twice == {bytes(r["ids"]): bytes(r["decoded"]) for r in tokens}
    assert len(tokens) == len(rows)
    for r in tokens:
        text = "x y" if r["doc_id"] is None else ODD[r["doc_id"]] or ""
        want = library.encode_ordinary(text)
        assert ids(bytes(r["ids"])) == want and r["n_tokens"] == len(want)
        assert hashlib.sha256(bytes(r["decoded"])).digest() == hashlib.sha256(text.encode()).digest()
    assert bpe.tokenize(docs(spark, []), ranks_path()).count() == 0
