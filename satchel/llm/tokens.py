"""Token ids of whole texts with the tokenizers library, fast enough for large tables.

Both vocabularies first split a text into words, and no token reaches over two of them.  Words repeat, so a text is
split here by the same published rule, and the tokenizer is asked for each word once; the memory of words is bounded
and starts anew when full, which changes no id.  The rule is spelled out for the Latin letters, where the classes of
characters are settled; a text with any other character is cut only at single blanks, where every word ends.
"""

from __future__ import annotations

import os
import re
import struct

# Letters, numbers and white space of ASCII, and what is added to each up to U+024F.
ASCII = ("A-Za-z", "0-9", "\t-\r ")
LATIN = ("A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾", "\t-\r \x85\xa0")
APART = "\0"  # parts new words when they are asked for together
OTHER_SCRIPT = re.compile("[^\x01-ɏ]|İ")  # this one letter becomes two when lowered


def _words(kind: str, letter: str, number: str, space: str) -> re.Pattern:
    if kind == "byte":
        return re.compile(
            rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+"
            rf"|[{space}]+(?![^{space}])|[{space}]+"
        )
    return re.compile(
        rf"'[sS]|'[tT]|'[rR][eE]|'[vV][eE]|'[mM]|'[lL][lL]|'[dD]|[{letter}]+|[{number}]|[^{space}{letter}{number}]+"
    )


def byte_letters() -> dict[int, str]:
    """How byte-level vocabularies write bytes: printable characters of Latin-1 as they are, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = sorted(set(range(256)).difference(plain))
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


BLANK = re.compile(r"(?<=\S) (?=\S)")
REMEMBERED = 650_000  # some 95 MB; a dict of 700,000 doubles its table
ASKED = 10_000


class Encoder:
    """Ids of a text as little-endian unsigned 32-bit bytes, as ``encode(text, add_special_tokens=False)`` gives them.

    ``kind``: ``byte`` for the byte-level vocabulary, ``word`` for the one with word ends, which drops white space.
    ``added``: whether the vocabulary's added tokens are found in texts, as the library does unless told otherwise; a text
    that may hold one goes to the tokenizer as a whole.
    """

    def __init__(self, file: str, kind: str, remembered: int = REMEMBERED, added: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(file)
        self.whole.encode_special_tokens, self.model = not added, self.whole.model
        tokens = self.whole.get_added_tokens_decoder().values() if added else ()
        # Such a token can be matched in the text as it is or as normalized, that is lowered.
        self.marks = re.compile("|".join(re.escape(x.content) for x in tokens), re.IGNORECASE) if tokens else None
        self.first = os.path.commonprefix([x.content for x in tokens])
        self.bytes = byte_letters()
        self.apart = self.bytes[ord(APART)]
        self.ascii, self.latin, self.lowers = _words(kind, *ASCII), _words(kind, *LATIN), kind == "word"
        self.remembered = remembered
        self.known: dict[str, bytes] = {}

    def __call__(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.marks and (not self.first or self.first[0] in text) and self.marks.search(text):
            return b"".join(self._ask(self.whole, [text]))
        plain = text.isascii() and APART not in text
        if not plain and OTHER_SCRIPT.search(text):
            first, *rest = BLANK.split(text)
            return b"".join(self._ask(self.whole, [first, *(" " + x for x in rest)]))
        words, known = (self.ascii if plain else self.latin).findall(text), self.known
        try:
            return b"".join(map(known.__getitem__, words))
        except KeyError:
            new = list(set(words).difference(known))
        if len(known) + len(new) > self.remembered:
            known.clear()
            new = list(set(words))
        for at in range(0, len(new), ASKED):
            some = new[at : at + ASKED]
            known.update(zip(some, self._bare(some), strict=True))
        return b"".join(map(known.__getitem__, words))

    def _bare(self, words: list[str]) -> list[bytes]:
        """Ids of each word by the model alone, as words are already what it is given one by one.

        Both vocabularies write a byte as a letter.  Words of these letters are composed already and hold no white space,
        so lowering is all that is normalized.
        """
        joined = APART.join(words)
        letters = (joined.lower() if self.lowers else joined).encode().decode("latin-1").translate(self.bytes)
        tokenize, word = self.model.tokenize, struct.Struct("<I").pack
        return [b"".join([word(x.id) for x in tokenize(w)]) for w in letters.split(self.apart)]

    @staticmethod
    def _ask(tokenizer, pieces: list[str]) -> list[bytes]:
        import numpy as np

        return [
            np.array(found.ids, dtype="<u4").tobytes()
            for at in range(0, len(pieces), ASKED)
            for found in tokenizer.encode_batch_fast(pieces[at : at + ASKED], add_special_tokens=False)
        ]


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(file: str, kind: str) -> Encoder:
    """One per Python worker, so that its memory of words serves all tasks of the worker."""
    if (file, kind) not in _ENCODERS:
        _ENCODERS[file, kind] = Encoder(file, kind, added=True)
    return _ENCODERS[file, kind]
