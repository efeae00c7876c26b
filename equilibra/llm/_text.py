"""Counts over one whole text, for rules and classifiers."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import xxhash

#: The symbols that count as such, and ASCII white space.
SYMBOLS, BLANKS, DIGITS = "#*$%&|<>", " \t\n\x0b\x0c\r", "0123456789"
WINDOW = 5
#: Above this many words the windows are numbered in arrays, which takes less memory.
MANY = 50_000


def many(text: str, characters: str) -> int:
    return sum(map(text.count, characters))


def repeated_words(words: list[bytes]) -> int:
    """Words inside 5-word windows that occur twice or more, the first included."""
    if len(words) <= WINDOW:
        return 0
    if len(words) > MANY:
        number = _numbers(words)
        n = len(words) - WINDOW + 1
        code = number[:n]
        for k in range(1, WINDOW):
            code = np.unique(code * (int(number.max()) + 1) + number[k : n + k], return_inverse=True)[1].astype(np.int64)
        often = np.flatnonzero(np.bincount(code)[code] > 1)
    else:
        windows = list(zip(words, words[1:], words[2:], words[3:], words[4:], strict=False))
        if len(set(windows)) == len(windows):
            return 0
        seen = Counter(windows)
        often = np.flatnonzero([seen[w] > 1 for w in windows])
    if not len(often):
        return 0
    gaps = np.diff(often, append=often[-1] + WINDOW)
    return int(np.minimum(gaps, WINDOW).sum())


def _numbers(words: list[bytes]) -> np.ndarray:
    table: dict[bytes, int] = {}
    return np.fromiter((table.setdefault(w, len(table)) for w in words), np.int64, len(words))


def base(text: str, words: list[bytes]) -> dict[str, int]:
    """The counts that the rules name."""
    seen: set[str] = set()
    copies = 0
    for line in text.split("\n"):
        if line.strip(BLANKS):
            copies += line in seen
            seen.add(line)
    return {
        "n_words": len(words),
        "word_chars": len(text) - many(text, BLANKS),
        "n_symbols": many(text, SYMBOLS),
        "n_dup_lines": copies,
        "n_repeat_words": repeated_words(words),
    }


LINE_FEATURES = ("bias", "length", "short", "symbols", "marks", "upper", "digits", "bars", "stop", "repeats", "variety", "word_length", "notice", "common")
NOTICES = ("licen", "copyright", "rights reserved", "cookie", "subscribe", "click here", "javascript")


def line_key(line: str) -> int:
    """A line's 64-bit hash, without blanks around it."""
    return xxhash.xxh64_intdigest(line.strip(BLANKS).encode()) - 2**63


def lines(text: str, common: frozenset[int] = frozenset()) -> tuple[np.ndarray, np.ndarray]:
    """(features, words) of the lines with a word, in order; ``common``: keys of lines that many documents share."""
    kept = [x for x in text.split("\n") if x.strip(BLANKS)]
    times = Counter(kept)
    rows, counts = [], []
    for x in kept:
        words = x.split() or [x]
        n, chars, lower = len(words), len(x), x.lower()
        rows.append((
            1.0,
            math.log1p(n) / 4,
            n <= 3,
            min(1.0, 10 * many(x, SYMBOLS) / chars),
            min(1.0, 2 * x.count("!") / n),
            sum(map(str.isupper, words)) / n,
            min(1.0, 5 * many(x, DIGITS) / chars),
            min(1.0, 2 * x.count("|") / n),
            x.rstrip()[-1:] in ".?!:…\"»”",
            times[x] > 1,
            len(set(words)) / n,
            min(3.0, chars / n / 8),
            any(w in lower for w in NOTICES),
            bool(common) and line_key(x) in common,
        ))
        counts.append(n)
    return np.array(rows, float).reshape(-1, len(LINE_FEATURES)), np.array(counts, np.int64)


STATISTICS = (
    "chars", "words", "word_length", "symbols", "upper", "digits", "marks", "bars", "lines", "dup_lines",
    "variety", "repeats", "top_word", "stops", "line_words", "spread",
)


def statistics(text: str) -> list[float]:
    """A document's statistics, transformed towards bell shape (logarithms of sizes, roots of shares)."""
    words = text.encode().split()
    n, chars = max(1, len(words)), max(1, len(text))
    b = base(text, words)
    rows, sizes = lines(text)
    count = max(1, len(sizes))
    bars = text.count("|")
    sizes_of = np.fromiter(map(len, words), float, len(words)) if words else np.zeros(1)
    top = Counter(words).most_common(1)[0][1] if words else 0
    upper = sum(map(bytes.isupper, words))
    return [
        math.log1p(len(text)),
        math.log1p(len(words)),
        math.log1p(b["word_chars"] / n),
        math.sqrt(b["n_symbols"] / chars),
        math.sqrt(upper / n),
        math.sqrt(many(text, DIGITS) / chars),
        math.sqrt(text.count("!") / chars),
        math.sqrt(bars / chars),
        math.log1p(len(sizes)),
        math.sqrt(b["n_dup_lines"] / count),
        len(set(words)) / n * math.log1p(n) / 6,
        math.sqrt(b["n_repeat_words"] / n),
        math.sqrt(top / n),
        float(rows[:, LINE_FEATURES.index("stop")].mean()) if len(rows) else 0.0,
        math.log1p(n / count),
        float(np.log1p(sizes_of.std())),
    ]
