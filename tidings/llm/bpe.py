"""BPE encoding by dynamic programming over the prefixes of a word, and decoding.

Of each prefix of a word the encoding ends in one token only. It is the one match of the
vocabulary, ending there, that fits behind the last token of the prefix it leaves: two tokens fit
if taking their merges apart along the border never finds a merge that would have come earlier. An
automaton over the vocabulary gives the matches that end at each place, one pass a word; the last
token of every prefix is stored, and the pointers back from the end give the ids. Time is linear in
the word, also for a word of a million letters.

Words recur, so a worker remembers the ids of recent words; the memory is emptied when full. Rows are
encoded one by one in place: nothing is shuffled, and a lost executor costs its own partitions.

Defined results: a null text counts as empty and has no ids; the strings of the vocabulary's special
tokens become those tokens, as the library does; repeated rows each give their row.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidings.llm.common import map_arrow

CACHED_WORDS = 300_000
#: Of the remembered verdicts on pairs of tokens.
CACHED_PAIRS = 600_000
_FINAL = 256


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in a vocabulary of byte-level BPE."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    shown = {b: chr(b) for b in plain}
    others = (b for b in range(256) if b not in shown)
    return [c for _, c in sorted((shown | {b: chr(256 + k) for k, b in enumerate(others)}).items())]


class Codec:
    """Encodes and decodes with the vocabulary of a tokenizer file: lower-cased words, word ends."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        suffix = model["end_of_word_suffix"]
        letters = {c: chr(b) for b, c in enumerate(_byte_letters())}

        def symbols(token: str) -> str:
            """The token with a character for each byte; a final byte has one of its own."""
            is_end = token.endswith(suffix) and token != suffix
            body = [letters[c] for c in (token[: -len(suffix)] if is_end else token)]
            if is_end:
                body[-1] = chr(_FINAL + ord(body[-1]))
            return "".join(body)

        vocab = model["vocab"]
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.names = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        of = {symbols(t): i for t, i in vocab.items() if t not in self.special}
        #: Rank of the merge that makes a token, its two parts, and the token of two parts.
        self.rank: dict[int, int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = (vocab[t] for t in (pair if isinstance(pair, list) else pair.split(" ")))
            token = of[symbols(self.names[left]) + symbols(self.names[right])]
            self.merged.setdefault((left, right), token)
            if token not in self.rank:
                self.rank[token], self.parts[token] = rank, (left, right)
        self.matches = ahocorasick.Automaton()
        for text, token in of.items():
            if len(text) == 1 or token in self.rank:
                self.matches.add_word(text, (len(text), token))
        self.matches.make_automaton()
        # White space never stands in a word, so runs of it need not be made blanks first.
        self.words = regex.compile(
            r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+"
        )
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.known: dict[str, bytes] = {}
        self.runs: dict[str, bytes] = {}
        self.fitting: dict[int, bool] = {}

    def fits(self, left: int, right: int) -> bool:
        """Whether two tokens side by side stay as they are.

        ``bound`` is the rank from which merges across the border come too late.
        """
        rank, parts, merged = self.rank, self.parts, self.merged
        bound = len(rank)
        a, b = rank.get(left, -1), rank.get(right, -1)
        while True:
            token = merged.get((left, right))
            if token is not None and rank[token] < bound:
                return False
            # The later of the two merges is undone. Of equal ones the left came first, so that
            # across the border the same merge would have come before the right one.
            if a > b:
                bound, left = a, parts[left][1]
                a = rank.get(left, -1)
            elif b >= 0:
                bound, right = b + 1, parts[right][0]
                b = rank.get(right, -1)
            else:
                return True

    def last_tokens(self, word: str) -> tuple[list[int], list[int]]:
        """The last token of each prefix of a word of symbols, and its length."""
        tokens, sizes = [-1] * (len(word) + 1), [0] * (len(word) + 1)
        fitting = self.fitting
        for end, (size, token) in self.matches.iter(word):
            end += 1
            if tokens[end] >= 0:
                continue
            if end > size:
                before = tokens[end - size]
                if before < 0:
                    continue
                pair = before << 20 | token
                ok = fitting.get(pair)
                if ok is None:
                    if len(fitting) >= CACHED_PAIRS:
                        fitting.clear()
                    ok = fitting[pair] = self.fits(before, token)
                if not ok:
                    continue
            tokens[end], sizes[end] = token, size
        return tokens, sizes

    def encode_word(self, word: str) -> list[int]:
        """Ids of one word."""
        body = word.encode().decode("latin-1")
        body = body[:-1] + chr(_FINAL + ord(body[-1]))
        tokens, sizes = self.last_tokens(body)
        ids, at = [], len(body)
        while at:
            ids.append(tokens[at])
            at -= sizes[at]
        return ids[::-1]

    def _word(self, word: str) -> bytes:
        """The packed ids of one word."""
        found = self.known.get(word)
        if found is None:
            found = array("I", self.encode_word(word)).tobytes()
            if len(self.known) >= CACHED_WORDS:
                self.known.clear()
            if len(word) < 64:
                self.known[word] = found
        return found

    def _run(self, run: str) -> bytes:
        """The packed ids of a text without special tokens."""
        # Letters are lowered one by one, without the Greek rule for the end of a word.
        plain = unicodedata.normalize("NFC", run).replace("Σ", "σ").lower()
        found = b"".join(map(self._word, self.words.findall(plain)))
        if len(run) < 64:
            if len(self.runs) >= CACHED_WORDS:
                self.runs.clear()
            self.runs[run] = found
        return found

    def _plain(self, text: str) -> bytes:
        # No word, letter or rule reaches across white space, so runs between it stand alone. Four
        # control characters separate for Python, but are no white space to the tokenizer.
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return self._run(text)
        known = self.runs
        runs = text.split()
        found = list(map(known.get, runs))
        for k, ids in enumerate(found):
            if ids is None:
                found[k] = self._run(runs[k])
        return b"".join(found)

    def packed(self, text: str | None) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        parts = self.specials.split(text) if any(map(text.__contains__, self.special)) else [text]
        return b"".join(
            array("I", [self.special[p]]).tobytes() if p in self.special else self._plain(p)
            for p in parts
        )

    def encode(self, text: str | None) -> list[int]:
        return list(array("I", self.packed(text)))

    def decode(self, ids: Iterable[int]) -> str:
        """Names of the tokens with blanks between; the file names no other decoder."""
        names = self.names
        return " ".join(names[i] for i in ids if i in names)


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """Path of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One codec for each worker process and file."""
    return Codec(path)


def encode(
    docs: DataFrame, path: str, with_ids: bool = True, passed: tuple[str, ...] = ()
) -> DataFrame:
    """``(doc_id, n_tokens, ids, ids_sha256, decoded_sha256)`` of every row, and its ``passed`` columns.

    ``path`` is a file that every executor has. The text is encoded, and the ids are decoded again.
    """

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            counts, all_ids, digests, texts = [], [], [], []
            for text in batch.column(1):
                ids = own.packed(text.as_py())
                counts.append(len(ids) // 4)
                digests.append(hashlib.sha256(ids).hexdigest())
                decoded = own.decode(memoryview(ids).cast("I"))
                texts.append(hashlib.sha256(decoded.encode()).hexdigest())
                if with_ids:
                    all_ids.append(np.frombuffer(ids, np.int32))
            columns = [batch.column(0), pa.array(counts, pa.int64())]
            names = ["doc_id", "n_tokens"]
            if with_ids:
                columns.append(pa.array(all_ids, pa.list_(pa.int32())))
                names.append("ids")
            columns += [pa.array(digests, pa.string()), pa.array(texts, pa.string())]
            columns += [batch.column(c) for c in passed]
            yield pa.RecordBatch.from_arrays(columns, [*names, "ids_sha256", "decoded_sha256", *passed])

    rows = docs.select(F.col("doc_id").cast("long"), "text", *passed)
    kinds = dict(docs.dtypes)
    ids = "ids array<int>, " if with_ids else ""
    schema = f"doc_id long, n_tokens long, {ids}ids_sha256 string, decoded_sha256 string"
    schema += "".join(f", `{c}` {kinds[c]}" for c in passed)
    return map_arrow(rows, compute, schema)
