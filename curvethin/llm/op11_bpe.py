"""BPE encoding by backtracking, decoding by an offset table.

``encode`` turns each text into the ids that merging by rank gives, without merging:

1. A word's longest token at every position comes from one Aho-Corasick pass over the reversed word, with an automaton of
   the reversed tokens.
2. A sequence of tokens is the merge result exactly if each pair of neighbours is: ``Vocabulary.compatible`` undoes the
   merges of two tokens, latest first, and fails if a merge across their border would have come before the one undone.
   The answers are kept in a pair table.
3. From the left, the longest token that agrees with the one before it is taken; if none does, the place is marked dead
   and the last token gives way to its next shorter prefix. Each place dies at most once, so the time is linear in the
   word, whatever its length.

The end of a word is a symbol of its own after the last byte, part of the last token. Words and pairs are remembered for
each Python worker, in tables of at most ``KNOWN_WORDS`` and ``KNOWN_PAIRS`` entries. The vocabulary file is read on the
driver, as its path may not exist elsewhere, and broadcast: its size is that of one tokenizer, whatever the data.

``decode`` joins the tokens' strings with one space, as a tokenizer without a decoder does: all strings lie in one buffer, and
an id's bytes are found by its offset there, for all ids of a slice in one array operation.

Preparing a text: the strings of special tokens are cut out first and become their ids; the rest is normalised (NFC, lower
case for each character on its own) and split into contractions, runs of letters, single digits and runs of other
characters, as array operations on the code points of a slice of texts; white space is dropped. Each distinct word of a slice
is looked up once. Only texts with code points on which this Python's Unicode tables and the library's may differ are
prepared by the tokenizers library itself.

Defined results: a null text counts as empty and has no ids; an empty list decodes to the empty text; invalid UTF-8 counts as the
replacement character; rows that repeat are encoded each; null doc_ids stay null; further columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

import json
import struct
import sys
import unicodedata
from collections.abc import Iterator
from functools import cached_property

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from curvethin.llm import textops as T

TOKENIZER = "word_bpe_49k.json"
KNOWN_WORDS = 1 << 19
KNOWN_PAIRS = 1 << 20
KNOWN_LENGTH = 48  # longer words are not remembered
SLICE = 2 << 20  # bytes of text that are split at once
END = "Ā"  # stands for the end of a word; bytes are the characters below it

# The contractions that the tokenizer splits off, without their apostrophe.
SHORT, LONG = ("s", "t", "m", "d"), ("re", "ve", "ll")

SPACE, LETTER, DIGIT, OTHER, DIFFERS = range(5)


def _byte_of_char() -> dict[int, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others, in order, from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {b: b for b in printable} | {256 + i: b for i, b in enumerate(rest)}


class Vocabulary:
    """The tables of one tokenizer file."""

    def __init__(self, spec: str):
        spec_ = json.loads(spec)
        model = spec_["model"]
        self._library = Tokenizer.from_str(spec)
        self.suffix = model["end_of_word_suffix"] or ""
        self.special = {a["content"]: a["id"] for a in spec_["added_tokens"]}
        self.names = {i: t for t, i in (model["vocab"] | self.special).items()}
        back = _byte_of_char()

        def plain(token: str) -> str:
            end = token.endswith(self.suffix) and token != self.suffix
            return (token[: -len(self.suffix)] if end else token).translate(back) + END * end

        ids = {plain(t): i for t, i in model["vocab"].items()}
        self.length = [0] * (max(self.names) + 1)
        for text, i in ids.items():
            self.length[i] = len(text)
        self.rank = [-1] * len(self.length)  # the merge that makes a token; -1 for the first symbols
        self.halves: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        for rank, (left, right) in enumerate(model["merges"]):
            pair, made = (model["vocab"][left], model["vocab"][right]), model["vocab"][left + right]
            if made in self.halves:
                raise ValueError(f"two merges make the token {left + right!r}")
            self.halves[made], self.merged[pair], self.rank[made] = pair, made, rank
        self.shorter = [-1] * len(self.length)  # the longest token that is a proper prefix
        for text, i in ids.items():
            self.shorter[i] = next((ids[text[:k]] for k in range(len(text) - 1, 0, -1) if text[:k] in ids), -1)
        self.tokens = ahocorasick.Automaton()
        for text, i in ids.items():
            self.tokens.add_word(text[::-1], i)
        self.tokens.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.known: dict[bytes, bytes] = {}

    # --- decoding ---

    @cached_property
    def offsets(self) -> tuple[np.ndarray, np.ndarray]:
        """All tokens' strings, each with a space after it, and where each begins."""
        strings = [self.names.get(i, "").encode() + b" " for i in range(len(self.length))]
        return np.frombuffer(b"".join(strings), np.uint8), np.cumsum([0, *map(len, strings)])

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> pa.Array:
        """The texts of rows with ``counts`` ids each."""
        strings, begin = self.offsets
        data, size = _gather(strings, np.diff(begin), ids)
        stop = _ends(size)[_ends(counts)]
        return pa.array([data[a:max(a, b - 1)].tobytes().decode() for a, b in zip(stop[:-1], stop[1:])], pa.string())

    # --- encoding ---

    def compatible(self, a: int, b: int) -> bool:
        """Merging the two tokens' joint text leaves just these two."""
        before = sys.maxsize  # merges across the border of a lower rank than this would have come first
        while True:
            across = self.merged.get((a, b))
            if across is not None and self.rank[across] < before:
                return False
            if self.rank[a] > self.rank[b]:  # the left token's last merge was the later one
                before, a = self.rank[a], self.halves[a][1]
            elif self.rank[b] >= 0:  # at one rank the right one was later, and the border lies before it
                before, b = self.rank[b] + 1, self.halves[b][0]
            else:
                return True

    def word(self, word: bytes) -> bytes:
        """The ids of one word (UTF-32), as little-endian unsigned 32-bit integers."""
        text = word.decode("utf-32-le").encode("utf-8", "replace").decode("latin-1") + (END if self.suffix else "")
        n = len(text)
        # of the matches that end at one place the longest comes first, and so stays in the dictionary
        longest = dict(list(self.tokens.iter(text[::-1]))[::-1])
        length, shorter, pairs = self.length, self.shorter, self.pairs
        if len(pairs) >= KNOWN_PAIRS:
            pairs.clear()
        out, dead, at, token, last = [], set(), 0, longest.get(n - 1, -1), -1
        while at < n:
            while token >= 0:
                end = at + length[token]
                if end not in dead:
                    if last < 0:
                        break
                    agree = pairs.get(last << 32 | token)
                    if agree is None:
                        agree = pairs[last << 32 | token] = self.compatible(last, token)
                    if agree:
                        break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                last, at = token, end
                token = longest.get(n - 1 - at, -1)
            else:
                dead.add(at)
                token = out.pop()
                last = out[-1] if out else -1
                at -= length[token]
        ids = np.array(out, "<u4").tobytes() if n > KNOWN_LENGTH else struct.pack(f"<{len(out)}I", *out)
        if n <= KNOWN_LENGTH:
            if len(self.known) >= KNOWN_WORDS:
                self.known.clear()
            self.known[word] = ids
        return ids

    @cached_property
    def _kinds(self) -> np.ndarray:
        """The kind of each code point."""
        every = "".join(map(chr, range(sys.maxunicode + 1)))
        kinds = np.full(len(every), OTHER, np.uint8)
        for kind, pattern in ((LETTER, r"\p{L}+"), (DIGIT, r"\p{N}+"), (SPACE, r"\s+")):
            for m in regex.finditer(pattern, every):
                kinds[m.start():m.end()] = kind
        # not assigned for this Python, but for a newer Unicode
        kinds[[ord(c) for c in regex.findall(r"\P{Cn}", "".join(c for c in every if unicodedata.category(c) == "Cn"))]] = DIFFERS
        # marks that the library orders differently next to marks of the lowest and of the highest class
        for c in filter(unicodedata.combining, every):
            for probe in (c + "\u0334", "\u0345" + c):
                if self._library.normalizer.normalize_str(probe) != unicodedata.normalize("NFC", probe):
                    kinds[ord(c)] = DIFFERS
        return kinds

    @cached_property
    def _special(self) -> regex.Pattern:
        return regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")

    def odd(self, text: str) -> bytes:
        """The ids of a text with special tokens, or with characters on which the Unicode tables differ."""
        out: list[bytes] = []
        for piece in self._special.split(text):
            if piece in self.special:
                out.append(self.special[piece].to_bytes(4, "little"))
            else:
                plain = self._library.normalizer.normalize_str(piece)
                out += [self.word(plain[a:b].encode("utf-32-le", "replace")) for _, (a, b) in self._library.pre_tokenizer.pre_tokenize_str(plain)]
        return b"".join(out)

    def texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and the number of each text's."""
        special = [any(s in t for s in self.special) for t in texts]
        # capital sigma apart: lower() writes it differently at the end of a word, the tokenizer does not
        plain = ["" if s else unicodedata.normalize("NFC", t).replace("Σ", "σ").lower() for t, s in zip(texts, special)]
        codes = np.frombuffer("\n".join(plain).encode("utf-32-le", "replace"), "<u4")
        edge = _ends(np.array([len(t) + 1 for t in plain], np.int64))  # text i is codes[edge[i]:edge[i + 1] - 1]
        kinds = self._kinds[codes]
        differ = np.unique(np.searchsorted(edge, np.flatnonzero(kinds == DIFFERS), "right") - 1)
        start, end = _words(codes, kinds)
        size = end - start
        packed = codes[np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum())].astype("<u4")
        words = pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(_ends(size) * 4), pa.py_buffer(packed)])
        words = words.dictionary_encode()
        known = [self.known.get(w) or self.word(w) for w in words.dictionary.to_pylist()]
        ids, counts = _gather(np.frombuffer(b"".join(known), "<u4"), np.array([len(k) // 4 for k in known], np.int64), words.indices.to_numpy())
        stop = _ends(counts)[np.searchsorted(start, edge)]
        slow = {*differ.tolist(), *(i for i, s in enumerate(special) if s)}
        if not slow:
            return ids, np.diff(stop)
        own = [np.frombuffer(self.odd(t), "<u4") if i in slow else ids[stop[i]:stop[i + 1]] for i, t in enumerate(texts)]
        return np.concatenate(own), np.array([len(x) for x in own])


def _words(codes: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last + 1 of each word: runs of letters, single digits, runs of others, and contractions."""
    n = len(codes)
    same = np.zeros(n + 1, bool)
    same[1:n] = kinds[1:] == kinds[:-1]
    first = (kinds != SPACE) & (~same[:n] | (kinds == DIGIT))
    # an apostrophe that begins a run takes one or two letters from the next one
    mark = np.flatnonzero(first & (codes == ord("'")))
    after = np.concatenate([codes, [0, 0]])
    one, two = after[mark + 1], after[mark + 2]
    short = np.isin(one, [ord(c) for c in SHORT])
    long = ~short & np.logical_or.reduce([(one == ord(a)) & (two == ord(b)) for a, b in LONG])
    first[mark[short | long] + 1] = False
    for rest in (mark[short] + 2, mark[long] + 3):
        rest = rest[rest < n]
        first[rest[kinds[rest] != SPACE]] = True
    start = np.flatnonzero(first)
    stop = np.zeros(n + 1, bool)
    stop[:n] = first | (kinds == SPACE)
    stop[n] = True
    stop = np.flatnonzero(stop)
    return start, stop[np.searchsorted(stop, start, "right")]


def _ends(counts: np.ndarray) -> np.ndarray:
    """Where lists of these lengths end, from 0 on."""
    out = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts, out=out[1:])
    return out


def _gather(values: np.ndarray, counts: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lists ``which``, joined, and their lengths; list i has ``counts[i]`` of the values."""
    size = counts[which]
    ends = np.cumsum(size)
    begin = np.cumsum(counts) - counts
    return values[np.repeat(begin[which] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)], size


_LOADED: dict[int, Vocabulary] = {}


def _vocabulary(spec) -> Vocabulary:
    """The tables, built once a Python worker."""
    if spec.value[0] not in _LOADED:
        _LOADED.clear()
        _LOADED[spec.value[0]] = Vocabulary(spec.value[1])
    return _LOADED[spec.value[0]]


def _share(spark: SparkSession, path: str):
    with open(path, encoding="utf-8") as f:
        spec = f.read()
    return spark.sparkContext.broadcast((hash(spec), spec))


def encode(docs: DataFrame, path: str, packed: bool = False) -> DataFrame:
    """doc_id, ids of each row (doc_id, text): an array, or little-endian unsigned 32-bit integers if ``packed``."""
    spec = _share(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = _vocabulary(spec)
        for rows, data, off in T.by_chunk(batches, size=SLICE):
            raw = data.tobytes()
            ids, counts = v.texts([raw[a:b].decode("utf-8", "replace") for a, b in zip(off[:-1], off[1:])])
            if packed:
                column = pa.Array.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(_ends(counts) * 4), pa.py_buffer(ids.astype("<u4"))]).cast(pa.binary())
            else:
                column = T.lists(ids.astype(np.int32), counts, pa.int32())
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), column], ["doc_id", "ids"])

    kind = "binary" if packed else "array<int>"
    doc_id = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {doc_id}, ids {kind}")


def decode(rows: DataFrame, path: str) -> DataFrame:
    """The rows with their ids (as ``encode`` gives them, ``packed`` or not) replaced by ``text``."""
    spec = _share(rows.sparkSession, path)
    packed = rows.schema["ids"].dataType.simpleString() == "binary"
    others = [f for f in rows.schema.fields if f.name != "ids"]
    if any(f.name.lower() == "text" for f in others):
        raise ValueError("decode would hide the column text")

    def slices(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
        ids = batch.column("ids")
        if packed:
            for i, j, data, off in T.chunks(ids.fill_null(b"")):
                yield batch.slice(i, j - i), np.frombuffer(data.tobytes(), "<u4").astype(np.int64), np.diff(off) // 4
            return
        off = np.concatenate([[0], np.cumsum(ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))])
        i = 0
        while i < len(ids):
            j = max(i + 1, int(np.searchsorted(off, off[i] + T.CHUNK // 4, "right")) - 1)
            yield batch.slice(i, j - i), ids.slice(i, j - i).flatten().to_numpy().astype(np.int64), np.diff(off[i:j + 1])
            i = j

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = _vocabulary(spec)
        for batch in batches:
            for part, ids, counts in slices(batch):
                yield pa.RecordBatch.from_arrays([*[part.column(f.name) for f in others], v.decode(ids, counts)], [*[f.name for f in others], "text"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in others)
    return rows.select(*[f.name for f in others], "ids").mapInArrow(run, f"{schema}, text string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(TOKENIZER)
    ids = encode(T.read(spark, sf_dir, "documents"), path, packed=True)
    ids = ids.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), "ids")
    return decode(ids, path).select("doc_id", "n_tokens", "ids_sha256", F.sha2("text", 256).alias("decoded_sha256"))
