"""BPE against the tokenizers library, and the round trip through the offset table."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from curvethin.llm import op11_bpe

PATH = public_tokenizers.path(op11_bpe.TOKENIZER)
SCHEMA = "doc_id long, text string, ids string, n_tokens string"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocabulary():
    with open(PATH, encoding="utf-8") as f:
        return op11_bpe.Vocabulary(f.read())


def texts() -> list[str | None]:
    rnd = random.Random(3)
    every = lambda: chr(rnd.choice([rnd.randint(32, 127), rnd.randint(0x300, 0x36F), rnd.randint(0, 0x2FFF), rnd.randint(0xE000, 0x1FFFF), 39, 39, 115, 108]))
    out: list[str | None] = [None, "", " \t\n", "<|endoftext|>", "a<|startoftext|>b <|endoftext|", "ΑΣ ΌΣΟΣ", "İ ẞ ǅ", "é 가",
                             "'s'sound're'll'l''s \"'ve' '", "a'", "a'l", "x²½Ⅷ 12_3", "\x1c\x1d\x85　​", "퟿\U0010ffff\u0000"]
    out += ["".join(rnd.choice("ababcdeinrsté日") for _ in range(rnd.randint(1, 40))) for _ in range(1500)]
    out += ["".join(every() for _ in range(rnd.randint(1, 60))) for _ in range(1500)]
    out += [rnd.choice(["a", "ab", "the", "!", "=-", "ha", "0", "'s"]) * rnd.randint(1, 300) for _ in range(150)]
    return out


def test_encode_and_decode(spark, library):
    rows = [(i, t, "x", "y") for i, t in enumerate(texts())] + [(3, "again", "x", "y")] * 2 + [(None, "no id", "x", "y")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    want = [(i, library.encode(t or "", add_special_tokens=False).ids) for i, t, *_ in rows]
    for packed in (False, True):
        ids = op11_bpe.encode(docs, PATH, packed)
        as_list = (lambda x: np.frombuffer(x, "<u4").tolist()) if packed else list
        key = lambda r: (r[0] is None, r[0] or 0, r[1])
        assert sorted(((r["doc_id"], as_list(r["ids"])) for r in ids.collect()), key=key) == sorted(want, key=key)
        back = [(r["doc_id"], r["text"]) for r in op11_bpe.decode(ids, PATH).collect()]
        assert sorted(back, key=key) == sorted(((i, library.decode(x, skip_special_tokens=False)) for i, x in want), key=key)


def test_every_assigned_code_point(library, vocabulary):
    probes = [f"a{c}b{c}{c}1 '{c}s" for c in map(chr, [*range(0xD800), *range(0xE000, 0x32000), *range(0xE0000, 0xE0200), 0x10FFFF])]
    probes = ["\n".join(probes[i:i + 200]) for i in range(0, len(probes), 200)]
    ids, counts = vocabulary.texts(probes)
    ends = np.concatenate([[0], np.cumsum(counts)])
    for a, b, e in zip(ends[:-1], ends[1:], library.encode_batch(probes, add_special_tokens=False)):
        assert ids[a:b].tolist() == e.ids


def test_words_that_are_tokens(vocabulary):
    """A word that the vocabulary has as one token is encoded as that token, with or without the pair table's help."""
    for token, name in list(vocabulary.names.items())[::7]:
        if name.endswith("</w>") and name[:-4].isascii():
            assert np.frombuffer(vocabulary.word(name[:-4].encode("utf-32-le")), "<u4").tolist() == [token]


def test_long_words_take_linear_time(library, vocabulary):
    rnd = random.Random(4)
    for text in ("a" * 300_000, "".join(rnd.choice("abcdefghij") for _ in range(300_000)), "-=" * 150_000):
        assert vocabulary.texts([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids


def test_known_words_are_bounded(library, vocabulary, monkeypatch):
    monkeypatch.setattr(op11_bpe, "KNOWN_WORDS", 10)
    monkeypatch.setattr(op11_bpe, "KNOWN_PAIRS", 10)
    some = [t or "" for t in texts()[:400]]
    ids, counts = vocabulary.texts(some)
    assert ids.tolist() == [i for t in some for i in library.encode(t, add_special_tokens=False).ids]
    assert len(vocabulary.known) <= 10


def test_query_digests(spark, library):
    sf = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] or "" for r in op11_bpe.T.read(spark, sf, "documents").collect()}
    got = {r["doc_id"]: r for r in op11_bpe.query(spark, sf).collect()}
    assert got.keys() == docs.keys()
    for i, text in docs.items():
        ids = library.encode(text, add_special_tokens=False).ids
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert op11_bpe.decode(op11_bpe.encode(none, PATH), PATH).count() == 0
    assert op11_bpe.decode(op11_bpe.encode(none, PATH, packed=True), PATH).count() == 0
