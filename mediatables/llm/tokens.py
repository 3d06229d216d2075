"""Token ids from the tokenizers library, for whole batches of texts.

The byte-level pre-tokenizer never joins characters across a space that is
followed by a non-space, so texts are cut there and only the distinct words of
a batch are looked at. Words of common letters are cut into the
pre-tokenizer's pieces, whose ids are looked up in a bounded cache; only new
pieces reach the tokenizer's model, and only other words the whole tokenizer.
A text with any other space goes to the tokenizer whole.
"""

from __future__ import annotations

import os
import re
from array import array
from itertools import chain
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CACHE_WORDS = 300_000
# Characters of texts that are cut up at once.
CUT_CHARS = 1_000_000
# Words that are encoded as one text.
JOINED = 2000
# Characters on which two definitions of white space may differ.
_DISPUTED = frozenset("\x85᠎​﻿")


def byte_letters() -> dict[int, str]:
    """The letters by which byte-level vocabularies spell the 256 bytes:
    printable Latin-1 as itself, the others from code point 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = (b for b in range(256) if b not in plain)
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}


def uncut(word: str) -> bool:
    """Whether the pre-tokenizer may join a word to the space before it."""
    return not word or word[0].isspace() or word[0] in _DISPUTED


_LETTERS = str.maketrans(byte_letters())
# Stands between pieces; no plain word has it.
_BREAK = "\r"
# Letters of plain words, which all definitions call letters; of other
# characters they have printable ASCII and line ends, not at the start.
LETTERS = ("A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f\u0388-\u038a\u038e-\u03a1\u03a3-\u03f5"
           "\u0400-\u0481\u048a-\u052f")
_ODD = f"^(\n|$)|[^\n!-~{LETTERS}]"
# The byte-level pre-tokenizer's own pattern, over plain words.
_PIECE = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[0-9]+| ?[^ \n0-9{LETTERS}]+|[ \n]+(?![^ \n])|[ \n]+")


_ID = attrgetter("id")


class Words(dict):
    """Numbers of words in order of first sight; ``new`` holds those that were
    not known."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        return number


class Encoder:
    """Ids of texts under one byte-level vocabulary, as the library gives them:
    the string of a special token is that token.

    The distinct words of many texts are cut into the pre-tokenizer's pieces.
    Pieces are numbered and the model's ids of each lie one after the other in
    one array, so a batch's ids are gathered at once. ``room`` is how many
    times the usual pieces are kept and the usual characters cut up at once.
    """

    def __init__(self, path: str, room: int = 1) -> None:
        self._room = room
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._model = self._tokenizer.model
        self.size = self._tokenizer.get_vocab_size()
        self._code = "H" if self.size <= 1 << 16 else "I"
        self.dtype = np.dtype(self._code)
        # Bytes of each id; a special token's string is its own.
        self._special = {t.content: k for k, t in self._tokenizer.get_added_tokens_decoder().items()}
        names = [self._tokenizer.id_to_token(k) or "" for k in range(self.size)]
        self._lengths = np.array([len(t.encode()) if t in self._special else len(t) for t in names], np.int64)
        self._pieces = Words()
        self._held = array(self._code)
        self._ends = array("q", [0])
        self._leads = array("b")
        # Which pieces were met in a later batch than their first.
        self._again = bytearray()

    def _forget(self) -> None:
        """Keep the pieces that were met again, or none if these are many."""
        keep = np.flatnonzero(np.frombuffer(self._again, np.int8))
        keep = keep[:0] if len(keep) > self._room * CACHE_WORDS // 2 else keep
        ends = np.frombuffer(self._ends, np.int64)
        flat, upto = gather(np.frombuffer(self._held, self.dtype), ends[keep], ends[keep + 1] - ends[keep])
        names = list(self._pieces)
        self._pieces = Words()
        self._pieces.update((names[k], n) for n, k in enumerate(keep.tolist()))
        self._leads = array("b", np.frombuffer(self._leads, np.int8)[keep].tobytes())
        self._held, self._ends = array(self._code, flat.tobytes()), array("q", [0, *upto.tolist()])
        self._again = bytearray(len(keep))

    def _sizes(self, words: list[str], ids: np.ndarray) -> np.ndarray | None:
        """How many of the ids of a text, words joined by spaces, belong to each
        word; None where one goes over the end of a word."""
        ends = np.cumsum(self._lengths[ids])
        upto = np.cumsum([len(w.encode()) + 1 for w in words])
        at = np.searchsorted(ends, upto)
        if not len(ends) or ends[-1] != upto[-1] or not (ends[at] == upto).all():
            return None
        return np.diff(at + 1, prepend=0)

    def _learn(self, pieces: list[str]) -> None:
        """The model's ids of pieces of plain words."""
        spelled = _BREAK.join(pieces).encode().decode("latin-1").translate(_LETTERS).split(_LETTERS[ord(_BREAK)])
        for k in range(0, len(spelled), JOINED):
            found = list(map(self._model.tokenize, spelled[k:k + JOINED]))
            ends = len(self._held) + np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))
            ids = np.fromiter(map(_ID, chain.from_iterable(found)), self.dtype, int(ends[-1]) - len(self._held))
            self._held.frombytes(ids.tobytes())
            self._ends.frombytes(ends.tobytes())
        self._leads.extend(p[0] == " " for p in pieces)

    def _learn_odd(self, words: list[str]) -> None:
        """Ids of other words with a space before each, many words as one text."""
        for k in range(0, len(words), JOINED):
            part = words[k:k + JOINED]
            ids = self._tokenizer.encode_batch_fast([" " + " ".join(part)], add_special_tokens=False)[0].ids
            own = self._sizes(part, np.array(ids, np.int64))
            if own is None:
                each = [e.ids for e in self._tokenizer.encode_batch_fast([" " + w for w in part], add_special_tokens=False)]
                ids, own = list(chain.from_iterable(each)), np.fromiter(map(len, each), np.int64)
            self._ends.extend((len(self._held) + np.cumsum(own)).tolist())
            self._held.extend(ids)
        self._leads.extend([1] * len(words))

    def _numbers(self, pieces: list[str], learn) -> np.ndarray:
        numbers = np.fromiter(map(self._pieces.__getitem__, pieces), np.int64, len(pieces))
        np.frombuffer(self._again, np.int8)[numbers[numbers < len(self._again)]] = 1
        self._again.extend(bytes(len(self._pieces.new)))
        if self._pieces.new:
            learn(self._pieces.new)
            self._pieces.new = []
        return numbers

    def _of_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct words with a space before each, the first one's place
        and the number of each word's, and which cannot be told alone."""
        odd = pc.match_substring_regex(words, _ODD)
        for content in self._special:
            odd = pc.or_(odd, pc.match_substring(words, content))
        is_odd = odd.to_numpy(zero_copy_only=False)
        plain = words.filter(pc.invert(odd))
        text = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(plain)], pa.int32()), plain), " ")[0].as_py()
        pieces = self._numbers(_PIECE.findall(" " + text), self._learn) if len(plain) else np.empty(0, np.int64)
        others = words.filter(odd).to_pylist()
        joined = np.fromiter(map(uncut, others), bool, len(others))
        alone = self._numbers([w for w, j in zip(others, joined) if not j], self._learn_odd)
        # Pieces of plain words, then the odd ones that stand alone.
        numbers = np.concatenate([pieces, alone])
        flat, upto = gather(np.frombuffer(self._held, self.dtype), np.frombuffer(self._ends, np.int64)[numbers],
                            np.diff(np.frombuffer(self._ends, np.int64))[numbers])
        at = np.flatnonzero(np.frombuffer(self._leads, np.int8)[numbers])
        first = np.concatenate([[0], upto])[at]
        bad = np.zeros(len(words), bool)
        bad[is_odd] = joined
        place = np.concatenate([np.flatnonzero(~is_odd), np.flatnonzero(is_odd)[~joined]])
        starts, counts = np.zeros(len(words), np.int32), np.zeros(len(words), np.int32)
        starts[place], counts[place] = first, np.diff(first, append=len(flat))
        return flat, starts, counts, bad

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """One array of ids per text; an empty text has none."""
        out: list[np.ndarray] = []
        first = chars = 0
        for k, text in enumerate(texts):
            if chars and chars + len(text) > self._room * CUT_CHARS:
                out += self._encode(texts[first:k])
                first, chars = k, 0
            chars += len(text)
        return out + self._encode(texts[first:])

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        if not texts:
            return []
        if len(self._pieces) > self._room * CACHE_WORDS:
            self._forget()
        cut = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        sizes = np.diff(cut.offsets.to_numpy()).astype(np.int64) - 1
        at_head = np.cumsum(sizes + 1) - sizes - 1
        is_word = np.ones(int(sizes.sum()) + len(texts), bool)
        is_word[at_head] = False
        heads = [h.ids for h in self._tokenizer.encode_batch_fast(
            cut.values.take(pa.array(at_head)).to_pylist(), add_special_tokens=False)]
        coded = cut.values.filter(pa.array(is_word)).dictionary_encode()
        words, starts, counts, bad = self._of_words(coded.dictionary.cast(pa.string()))
        # Heads follow the words, and all lie in one sequence.
        numbers = np.empty(len(is_word), np.int32)
        numbers[is_word] = coded.indices.to_numpy()
        numbers[at_head] = len(starts) + np.arange(len(texts))
        head_sizes = np.fromiter(map(len, heads), np.int32, len(heads))
        own = np.fromiter(chain.from_iterable(heads), self.dtype, int(head_sizes.sum()))
        starts = np.concatenate([starts, (len(words) + np.cumsum(head_sizes) - head_sizes).astype(np.int32)])
        counts = np.concatenate([counts, head_sizes])
        flat, upto = gather(np.concatenate([words, own]), starts[numbers], counts[numbers])
        out = np.split(flat, upto[at_head[1:] - 1])
        if bad.any():
            owner = np.repeat(np.arange(len(texts)), sizes)
            for k in np.unique(owner[bad[numbers[is_word]]]).tolist():
                ids = self._tokenizer.encode(texts[k], add_special_tokens=False).ids
                out[k] = np.array(ids, self.dtype)
        return out


def gather(pool: np.ndarray, first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``count`` values of the pool from each place ``first`` on, one after the
    other, and where each lot ends."""
    upto = np.cumsum(count)
    total = int(upto[-1]) if len(upto) else 0
    kind = np.int32 if max(total, len(pool)) < 1 << 31 else np.int64
    at = np.repeat((first - (upto - count)).astype(kind), count)
    at += np.arange(total, dtype=kind)
    return pool[at], upto


_ENCODERS: dict[tuple[str, int], Encoder] = {}


def encoder(path: str, room: int = 1) -> Encoder:
    """One encoder per worker, vocabulary and room; its cache lasts over tasks."""
    if (path, room) not in _ENCODERS:
        _ENCODERS[path, room] = Encoder(path, room)
    return _ENCODERS[path, room]
