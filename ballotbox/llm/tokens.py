"""Token ids of whole texts, with a per-process cache of words.

Both public vocabularies split a text before merging, and never across the
border of a word and the white space around it, so a text's ids are the ids of
its words one after the other. Words repeat, so each is encoded once per worker
process. A word of Latin letters and sentence marks is two pieces for either
vocabulary and goes to the library's merging model directly; every other word
goes through the whole tokenizer. A text that holds one of the vocabulary's
special tokens as written (``<|endoftext|>``) is encoded as a whole, since those are
found before the split. The tests hold the ids against encoding each text with an
unaltered library.
"""

from __future__ import annotations

import os
import re
from array import array
from functools import lru_cache

import numpy as np

# Unicode white space, and how each vocabulary attaches it to words.
_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
SPLITS = {
    # white space is dropped
    "word_bpe_49k.json": r"[^ \t-\r]+",
    # one space goes with the word after it; longer white space leaves its last character
    "byte_bpe_50k.json": rf"[{_SPACE}]+(?![^{_SPACE}])| ?[^{_SPACE}]+|[{_SPACE}]",
}
MOST_WORDS = 800_000        # words kept per worker process; then the cache starts anew
LONGEST = 48                # longer words are encoded each time
_separators = re.compile("[\x1c-\x1f]").search        # white space for str.split, not for the vocabularies
_plain = re.compile(r"( ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([.,;:!?]*)").fullmatch


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: printable
    bytes stand for themselves, the others follow from 256 on."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    others = (b for b in range(256) if b not in set(printable))
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


_LETTERS = _byte_letters()


class _Codes(dict):
    """Word -> its ids as bytes; a word that is not there is encoded."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        code = self.encode(word)
        if len(word) <= LONGEST:
            self[word] = code
        return code


class Encoder:
    """``width`` is the bytes of an id: 2 where the vocabulary allows it, else 4."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        marks = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(marks) or "(?!)").search
        self.find = re.compile(SPLITS[os.path.basename(path)]).findall
        self.merge = self.tokenizer.model.tokenize
        self.dropped = os.path.basename(path) == "word_bpe_49k.json"    # white space is
        self.lower = self.tokenizer.normalizer is not None      # the word vocabulary is in lower case
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.kind = "H" if self.width == 2 else "I"
        self.codes = _Codes(self._word)
        self.marks = _Codes(self._whole)

    def _whole(self, text: str) -> bytes:
        return array(self.kind, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _word(self, word: str) -> bytes:
        parts = _plain(word)
        if parts is None:
            return self._whole(word)
        head, tail = parts.groups()
        pieces = self.merge((head.lower() if self.lower else head).encode().decode("latin-1").translate(_LETTERS))
        code = array(self.kind, [p.id for p in pieces]).tobytes()
        return code + self.marks[tail] if tail else code

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text, ``width`` bytes each, little endian (as the machine)."""
        if len(self.codes) > MOST_WORDS:
            self.codes.clear()
        code, out = self.codes.__getitem__, []
        for text in texts:
            if not text:
                out.append(b"")
            elif self.special(text):
                out.append(self._whole(text))
            elif self.dropped and not _separators(text):
                out.append(b"".join(map(code, text.split())))       # splits at white space just as well
            else:
                out.append(b"".join(map(code, self.find(text))))
        return out

    def ids(self, code: bytes) -> bytes:
        """Ids as unsigned 32-bit integers."""
        return code if self.width == 4 else np.frombuffer(code, "<u2").astype("<u4").tobytes()


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One per process and vocabulary file."""
    return Encoder(path)


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
