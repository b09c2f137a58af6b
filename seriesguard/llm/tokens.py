"""Token ids of whole texts with a public tokenizer file.

The ids are those of the ``tokenizers`` library for the whole text without special tokens added; the strings of special
tokens in a text count as these. Byte-pair merging itself is done by ``tiktoken`` from the file's own vocabulary, which
is several times faster. Two kinds of files are known: byte-level ones that keep spaces, and lower-casing ones that drop
white space and whose words end with ``</w>``. A text for the latter is cut at spaces and line feeds, where its
pre-tokenizer cuts in every case, and each piece is encoded once; a blank stands for the word end there, and pieces with
characters beyond Latin-1, an apostrophe (contractions) or a special token's string (these texts are not cut) go through
the ``tokenizers`` library.
"""

from __future__ import annotations

import functools
import json
import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Fixed: the pre-tokenizer pattern of byte-level files.
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORD_END = "</w>"

#: Pieces, and ids of all of them, kept per Python worker; with more the store is emptied.
KEPT_PIECES = 800_000
KEPT_IDS = 8_000_000

#: A text with so long a run of white space goes through the library: the other's pattern matcher gives up on a million.
LONG_RUN = 1 << 16
_LONG_RUN = re.compile(rf"\s{{{LONG_RUN}}}")

_UNSAFE = re.compile(r"[^\t\n\r -~À-ÖØ-öø-ÿ]|'")
_NO_WORD = re.compile(r"[^\s\0a-zß-öø-ÿ0-9]+|[0-9]")


def _byte_of_char() -> dict[str, int]:
    """Byte-level alphabet: printable Latin-1 characters stand for themselves, other bytes follow from 256 on."""
    shown = [b for b in range(256) if chr(b).isprintable() and b not in (32, 160, 173)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}


class _Pieces(dict):
    """Numbers of pieces met so far, and the ids of each in one pool."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []
        self.left_whole: set[str] = set()
        self.pool = np.empty(0, "<u4")
        self.starts = self.sizes = np.empty(0, np.int64)

    def __missing__(self, piece: str) -> int:
        self[piece] = n = len(self)
        self.new.append(piece)
        return n

    def whole(self, text: str) -> int:
        """A text that is not cut, as special strings are in it."""
        self.left_whole.add(text)
        return self[text]

    def single(self, id_: int) -> int:
        """A piece that is one id and no text."""
        if id_ not in self:
            self[id_] = len(self)
            self.add(np.array([id_], "<u4"), np.array([1]))
        return self[id_]

    def add(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.starts = np.r_[self.starts, len(self.pool) + np.cumsum(sizes) - sizes]
        self.sizes, self.pool = np.r_[self.sizes, sizes], np.concatenate([self.pool, ids])
        self.new, self.left_whole = [], set()


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a Spark task is one core
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.words = spec.get("normalizer") is not None
        byte_of, ranks = _byte_of_char(), {}
        for token, id_ in spec["model"]["vocab"].items():
            if token not in self.specials:
                end = self.words and token.endswith(WORD_END)
                ranks[bytes(byte_of[c] for c in (token.removesuffix(WORD_END) if end else token)) + b" " * end] = id_
        self.ends = {b: i for b, i in ranks.items()} if not self.words else {}
        self.separator = ranks.get(b"\0 ")
        self.pieces = _Pieces()
        self.size = 1 + max([*ranks.values(), *self.specials.values()])
        self.fast = tiktoken.Encoding("file", pat_str="[^ ]+ " if self.words else BYTE_PATTERN, mergeable_ranks=ranks,
                                      special_tokens={} if self.words else self.specials)

    def ids(self, text: str | None) -> np.ndarray:
        """Unsigned 32-bit ids of a text; none for null."""
        if not text:
            return np.empty(0, "<u4")
        if not self.words:
            if len(text) > LONG_RUN and _LONG_RUN.search(text):
                return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")
            return self.fast.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False)
        return self.batch([text])[0]

    def batch(self, texts: list[str | None] | pa.StringArray) -> list[np.ndarray]:
        """Unsigned 32-bit ids of each text; none for null."""
        if not self.words:
            return [self.ids(t) for t in (texts.to_pylist() if isinstance(texts, pa.Array) else texts)]
        of, ends = self.pieces_of(texts)
        size = self.pieces.sizes[of]
        stops = np.cumsum(size)
        places = np.arange(int(stops[-1]) if len(stops) else 0) + np.repeat(self.pieces.starts[of] - stops + size, size)
        out, cuts = self.pieces.pool[places], np.r_[0, stops][ends].tolist()
        self.forget()
        return [out[a:b] for a, b in zip([0, *cuts[:-1]], cuts)]

    def pieces_of(self, texts: list[str | None] | pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the pieces of all texts, and where each text's end. ``pieces`` has their ids until ``forget``."""
        known = self.pieces
        texts = pc.fill_null(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), "")
        special = functools.reduce(pc.or_, [pc.match_substring(texts, s) for s in self.specials])
        # cut by Arrow: only different pieces become Python strings
        cut = pc.split_pattern(pc.replace_substring(pc.if_else(special, "", texts), "\n", " "), " ")
        words = cut.flatten().dictionary_encode()
        place = np.fromiter(map(known.__getitem__, words.dictionary.to_pylist()), np.int64, len(words.dictionary))
        of, ends = place[words.indices.to_numpy()], cut.offsets.to_numpy()[1:].astype(np.int64)
        for i in np.flatnonzero(special.to_numpy(zero_copy_only=False)).tolist():
            of[ends[i] - 1] = known.whole(texts[i].as_py())  # in place of the one empty piece
        if known.new:
            known.add(*self._encode_pieces(known.new, known.left_whole))
        return of, ends

    def full(self) -> bool:
        return len(self.pieces) > KEPT_PIECES or len(self.pieces.pool) > KEPT_IDS

    def forget(self) -> None:
        """Drop the pieces if there are many, or long ones."""
        if self.full():
            self.pieces = _Pieces()

    def _encode_pieces(self, pieces: list[str], whole: set[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces, one after the other, and how many each has."""
        odd = [i for i, p in enumerate(pieces) if _UNSAFE.search(p) or p in whole]
        plain = pieces
        if odd:
            other = self.tokenizer.encode_batch_fast([pieces[i] for i in odd], add_special_tokens=False)
            plain = pieces.copy()
            for i in odd:
                plain[i] = ""
        text = _NO_WORD.sub(r" \g<0> ", " \0 ".join(plain).lower()).replace("\t", " ").replace("\r", " ") + " \0 "
        ids = np.array(self.fast.encode_ordinary(text), "<u4")
        ends = np.flatnonzero(ids == self.separator)
        sizes = np.diff(np.r_[-1, ends]) - 1
        ids = np.delete(ids, ends)
        if odd:
            parts = np.split(ids, np.cumsum(sizes)[:-1])
            for i, e in zip(odd, other):
                parts[i] = np.array(e.ids, "<u4")
            ids, sizes = np.concatenate(parts), np.array([len(x) for x in parts])
        return ids, sizes

    def ending_with(self, ends: tuple[bytes, ...]) -> np.ndarray:
        """For each id of a byte-level file, whether its bytes end so."""
        out = np.zeros(self.size, bool)
        out[[i for b, i in self.ends.items() if b.endswith(ends)]] = True
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each file and Python worker."""
    return Encoder(path)
