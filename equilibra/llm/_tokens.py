"""Token ids of whole texts from a public tokenizer file, with a word cache.

Both tokenizers used here cut a text into words before they apply byte-pair
merges, and no word reaches over a space or line feed that stands between two
characters other than white space. So a text is cut there, and the library is
asked once for each different piece; the ids of a text are the ids of its pieces
joined. Nor does a word reach over the border from a letter or digit to a
trailing run of symbols other than the apostrophe, so ``word,`` is ``word`` and
``,``. A new piece of letters alone is one word to both, so the library's model is asked
for its merges directly; any other piece goes through the whole library. A text with
any other white space (runs, tabs, at either end) goes to the library whole, if
spaces count. An added token written out in a text (such as ``<|endoftext|>``) is
its one id, as in the library's plain call; a text with one, in upper or lower case,
goes to the library whole too. ``tests/llm`` holds the result against plain
whole-text calls.
"""

from __future__ import annotations

import os
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import compress
from operator import not_

import numpy as np

END_ID = 2
ID = np.dtype("<u4")
#: Symbols that neither tokenizer joins to letters or digits before them.
TAILS = ".,!?;:*$%&#|"
MARK = "\0"
CROWDED = (" ,", " .", "\n,", "\n.", ",,", ",.", ".,", "..")


#: Letters up to here are letters to every version of Unicode that the libraries know.
PLAIN = "\u0400"


def byte_characters() -> dict[int, str]:
    """How both vocabularies write the 256 bytes: printable Latin-1 as itself, others from 256 on."""
    plain = {b: chr(b) for b in range(256) if chr(b).isprintable() and b not in (32, 173)}
    others = [b for b in range(256) if b not in plain]
    return plain | {b: chr(256 + k) for k, b in enumerate(others)}


def apart(text: str) -> str:
    """Plain prose with commas and stops set off as pieces that no space precedes (marked so).

    Only where letters and digits are all else, and one of them precedes each.
    """
    plain = text.replace(" ", "").replace("\n", "").replace(",", "").replace(".", "").isalnum()
    if plain and text[0] not in ",." and not any(x in text for x in CROWDED):
        return text.replace(",", " \0,").replace(".", " \0.")
    return text


class Pieces(dict):
    """Cache: piece of text -> its ids as little-endian unsigned 32-bit bytes; one that isn't known
    yet is noted in ``new`` and gives None.

    A piece follows ``prefix`` in its text, or the line feed that it starts with. Pieces
    of over ``longest`` characters aren't kept for other texts.
    """

    def __init__(self, tokenizer, prefix: str, longest: int = 64):
        super().__init__()
        self.tokenizer, self.model, self.prefix, self.longest = tokenizer, tokenizer.model, prefix, longest
        self.table = byte_characters()
        self.head = "".join(self.table[b] for b in prefix.encode())
        self.new: set[str] = set()
        self.long: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {}
        self.feed = self.whole("\n")

    def whole(self, text: str) -> bytes:
        # This call gives the same ids as encode() and keeps no offsets.
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, ID).tobytes()

    def __missing__(self, piece: str) -> bytes | None:
        self.new.add(piece)
        return None

    def _alone(self, piece: str) -> bytes:
        first = piece[:1]
        return self.whole(piece[1:] if first == MARK else piece if first == "\n" else self.prefix + piece)

    def _word(self, letters: str, head: str) -> bytes:
        """A word of plain letters is cut by no rule: the vocabulary's merges are asked for directly."""
        word = head + letters.encode().decode("latin-1").translate(self.table)
        return b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(word)])

    def _known(self, piece: str) -> bytes:
        """The ids of a piece without tail."""
        if piece.isalpha() and max(piece) < PLAIN:
            return self._word(piece, self.head)
        if piece[:1] == "\n" and piece[1:].isalpha() and max(piece) < PLAIN:
            return self.feed + self._word(piece[1:], "")
        return self._alone(piece)

    def _tail(self, symbols: str) -> bytes:
        if symbols not in self.tails:
            if len(self.tails) >= 10_000:
                self.tails.clear()
            self.tails[symbols] = self.whole(symbols)
        return self.tails[symbols]

    def learn(self) -> None:
        """Take in what was asked for."""
        new, self.new = self.new, set()
        for p in new:
            word = p.rstrip(TAILS)
            if len(p) > self.longest:
                self.long[p] = self._alone(p)
            elif word is not p and word and word[-1].isalnum():
                if (ids := self.get(word)) is None:
                    self[word] = ids = self._known(word)
                self[p] = ids + self._tail(p[len(word) :])
            else:
                self[p] = self._known(p)


class Encoder:
    """``ids(texts)`` gives the ids of each whole text and the end id, as bytes.

    path: tokenizer file of the ``tokenizers`` library. spaces_kept: whether a
    space belongs to the word after it (byte-level) or is dropped (and case with
    it). room: entries of the cache, about 220 bytes each, after which it starts anew;
    that changes no result.
    """

    def __init__(self, path: str, spaces_kept: bool, end_id: int = END_ID, room: int = 400_000):
        from tokenizers import Tokenizer

        # One text a call: threads of the library's own would gain nothing inside a task.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.spaces_kept, self.room = spaces_kept, room
        self.end = np.array([end_id], ID).tobytes()
        self.pieces = Pieces(self.tokenizer, " " if spaces_kept else "")
        self.skip = len(self.pieces.feed) if spaces_kept else 0

    def ids(self, texts: list[str | None]) -> list[bytes]:
        """Null counts as the empty text: only the end id."""
        pieces, skip, end = self.pieces, self.skip, self.end
        cut = [(self._spaced(t) if self.spaces_kept else self._dropped(t)) if t else b"" for t in texts]
        found = [x if isinstance(x, bytes) else list(map(pieces.__getitem__, x)) for x in cut]
        pieces.learn()
        for x, f in zip(cut, found, strict=True):
            if isinstance(f, list) and None in f:
                for k in compress(range(len(f)), map(not_, f)):
                    ids = pieces.get(x[k])
                    f[k] = pieces.long[x[k]] if ids is None else ids
        pieces.long.clear()
        if len(pieces) > self.room:
            pieces.clear()
        return [(f if isinstance(f, bytes) else b"".join(f)[skip:]) + end for f in found]

    def _dropped(self, text: str) -> list[str] | bytes:
        """Pieces in lower case, or the ids where the library's lower case isn't surely the same: it
        composes first, then lowers character by character (no final sigma), and composes no more."""
        low = text.lower()
        if MARK in text or not text.isascii() and ("Σ" in text or not (unicodedata.is_normalized("NFC", text) and unicodedata.is_normalized("NFC", low))):
            return self.pieces.whole(text)
        if self._adds(text) or self._adds(low):
            return self.pieces.whole(text)
        return apart(low).replace("\n", " ").split(" ")

    def _adds(self, text: str) -> bool:
        """Whether an added token is written out in the text."""
        return any(x in text for x in self.added)

    def _spaced(self, text: str) -> list[str] | bytes:
        """Pieces, or the ids where white space is more than single spaces and line feeds between
        other characters (any other white space isn't printable)."""
        feeds = text.replace("\n", "") if "\n" in text else text
        if not feeds.isprintable() or "  " in text or " \n" in text or "\n " in text or "\n\n" in text or text[0] in " \n" or text[-1] in " \n" or self._adds(text):
            return self.pieces.whole(text)
        out = apart(text).replace("\n", " \n").split(" ")
        out[0] = "\n" + out[0]
        return out


@lru_cache(maxsize=4)
def encoder(path: str, spaces_kept: bool) -> Encoder:
    """One per Python worker, so that tasks share its cache."""
    return Encoder(path, spaces_kept)


def encoded(path: str, spaces_kept: bool, rows: Iterable[tuple], room: int = 2_000_000) -> Iterator[tuple]:
    """(key, ids) of (key, text) rows, some at a time: up to ``room`` characters, or one text."""
    held, size = [], 0
    for key, text in rows:
        held.append((key, text))
        size += len(text or "")
        if size >= room or len(held) >= 5000:
            yield from zip([k for k, _ in held], encoder(path, spaces_kept).ids([t for _, t in held]), strict=True)
            held, size = [], 0
    if held:
        yield from zip([k for k, _ in held], encoder(path, spaces_kept).ids([t for _, t in held]), strict=True)
