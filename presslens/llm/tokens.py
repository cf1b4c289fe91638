"""Token ids of whole texts by the tokenizers library, with a cache of words.

Pre-tokenizers never join characters across white space, nor letters with the
punctuation after them, so a text cut there and encoded piece by piece gives the ids of
the whole text. A comma or full stop between a letter or digit and white space is a piece by itself, so that one entry of
the cache serves a word with and without it. A word of letters not met lately goes straight to the library's model;
any other piece, and every text whose white space is not of the plain kind this holds for, or that holds the
string of a special token, goes through the whole tokenizer. Null and empty texts give no ids; a very long text is cut in
the same way, word by word.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from presslens.llm.common import worker_state

CACHED_WORDS = 450_000  # per generation; two are kept
LONGEST_WORD = 64  # characters of a word that is kept
PART_BYTES = 4 << 20  # of texts whose words are looked up together
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"  # no apostrophe: it may begin a piece of letters


def _byte_characters() -> dict[int, str]:
    """The characters byte-level vocabularies write for bytes: a byte's own where that prints, else the next from U+0100."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(0x100) if b not in own]
    return {b: chr(b) if b in own else chr(0x100 + rest.index(b)) for b in range(0x100)}


class _Words(dict):
    """Ids by word; one not met in this generation comes from the one before, or else from ``piece``, which has None for no word."""

    def __init__(self, piece, old: dict[str, bytes]):
        self.piece, self.old = piece, old

    def __missing__(self, key: str) -> bytes | None:
        got = self.old.get(key)
        if got is None:
            got = self.piece(key)
        if got is not None and len(key) <= LONGEST_WORD:
            self[key] = got
        return got


class Encoder:
    """Encodes texts to little-endian unsigned 32-bit ids. ``spaces``: whether the tokenizer keeps white
    space (a space belongs to the word after it) or drops it. ``special_as_text``: whether the strings of
    special tokens are ordinary text, or, as in the library's plain call, give their one id."""

    def __init__(self, definition: str, spaces: bool, special_as_text: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallelism
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.encode_special_tokens = special_as_text
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.special = () if special_as_text else tuple(t.content for t in added if t.special)
        self.model = self.tokenizer.model
        self.normalizer = self.tokenizer.normalizer
        self.spaces = spaces
        self.bytes = _byte_characters()
        before = "A-Za-z0-9" if self.normalizer else r"^\W_"  # a normalizer may end other letters with a mark
        self.stops = [(re.compile(rf"{re.escape(c)}(?<=[{before}]{re.escape(c)})(?=[ \n]|\Z)"), f" \t{c}" if spaces else f" {c}")
                      for c in ",."]
        self.tails: dict[str, bytes] = {}  # marks after a word, a piece of their own
        self.words = _Words(self._piece, {})  # a word in use stays, one not met for a generation goes
        self.line = self._whole("\n")

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _normal(self, word: str) -> str:
        if self.normalizer is None:
            return word
        return word.lower() if word.isascii() else self.normalizer.normalize_str(word)

    def _letters(self, word: str, lead: str) -> bytes:
        """A run of letters, one piece to the model, after ``lead``."""
        word = self._normal(word)
        if word.isascii():  # letters of ASCII stand for their own bytes
            s = self.bytes[0x20] + word if lead else word
        elif word.isalpha():
            s = (lead + word).encode().decode("latin-1").translate(self.bytes)
        else:
            return self._whole(lead + word)
        return array("I", [t.id for t in self.model.tokenize(s)]).tobytes()

    def _piece(self, key: str) -> bytes | None:
        """A word with what stands before it: nothing or, where spaces are kept, a space or, as the first character, a line
        feed or a tab (for nothing: a text or a mark begins). None if white space is in it, or nothing but that."""
        if key.isalpha():
            return self._letters(key, " " if self.spaces else "")
        head = key[:1] if key[:1] in ("\n", "\t") else ""
        word, lead = (key[1:], "") if head else (key, " " if self.spaces else "")
        if word.split() != [word]:
            return None
        if word.isalpha():
            out = self._letters(word, lead)
        elif (base := word.rstrip(_MARKS)).isalpha() and (base.isascii() or self._normal(base)[-1].isalpha()):
            return self.words[key[:len(base) - len(word)]] + self._tail(word[len(base):])
        else:
            out = self._whole(lead + word)
        return self.line + out if head == "\n" else out

    def _tail(self, marks: str) -> bytes:
        got = self.tails.get(marks)
        if got is None:
            got = self._whole(marks)
            if len(marks) < 4:
                self.tails[marks] = got
        return got

    def _words(self, text: str) -> str | None:
        """The text's words as ``_piece`` takes them, a space between two; None if it must go through the whole tokenizer."""
        if any(s in text for s in self.special):
            return None
        if any(c in text for c in "\x1c\x1d\x1e\x1f\x85"):  # white space to Python, not to all tokenizers
            return None
        if self.spaces and "\t" in text:
            return None
        for stop, apart in self.stops:
            text = stop.sub(apart, text)
        return "\t" + text.replace("\n", " \n") if self.spaces else " ".join(text.split())

    def encode_all(self, texts: list[str | None]) -> pa.LargeBinaryArray:
        """The ids of every whole text; none for null and empty ones. A word is looked up once for all of them."""
        cut = [self._words(t) if t else "" for t in texts]
        whole = {i: self._whole(texts[i]) for i, words in enumerate(cut) if words is None}
        lists = pc.split_pattern(pa.array([words or None for words in cut], pa.large_string()), " ")
        places = lists.values.dictionary_encode()
        ids = pa.array(map(self.words.__getitem__, places.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.large_binary())
        if len(self.words) > CACHED_WORDS:
            self.words.old = {}
            self.words = _Words(self._piece, self.words)
        ids, ends = ids.take(places.indices), np.asarray(lists.offsets)
        if ids.null_count:  # more than one white space between words, or at an end
            odd = np.flatnonzero(np.asarray(ids.is_null()))
            whole |= {i: self._whole(texts[i]) for i in np.unique(np.searchsorted(ends, odd, "right") - 1).tolist()}
        _, starts, data = ids.buffers()
        starts = np.frombuffer(starts, np.int64)[ends] if len(ids) else np.zeros(len(texts) + 1, np.int64)
        out = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(texts), [None, pa.py_buffer(starts), data or pa.py_buffer(b"")])
        return pa.array([whole.get(i, b) for i, b in enumerate(out.to_pylist())], pa.large_binary()) if whole else out

    def encode(self, text: str | None) -> bytes:
        """The ids of the whole text; none for null and empty ones."""
        return self.encode_all([text])[0].as_py()

    def encode_rows(self, texts: pa.Array) -> Iterator[tuple[int, pa.LargeBinaryArray]]:
        """(the number of its first row, ids) of consecutive rows, about PART_BYTES of text at once."""
        size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64) // PART_BYTES
        first = np.flatnonzero(np.diff(size, prepend=-1)).tolist()
        for a, b in zip(first, [*first[1:], len(texts)]):
            yield a, self.encode_all(texts.slice(a, b - a).to_pylist())


def definition(path: str) -> str:
    """The tokenizer's file, read by the driver and sent to the workers (a vocabulary: a few MB)."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def encoder(text: str, spaces: bool) -> Encoder:
    """This worker's encoder, kept from task to task; special tokens as in the library's plain call."""
    return worker_state(f"encoder_{zlib.crc32(text.encode())}_{spaces}", lambda: Encoder(text, spaces, special_as_text=False))
