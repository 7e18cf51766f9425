"""Fold texts so that disguised spellings of a word become the same letters."""

from __future__ import annotations

import re
import unicodedata

# Letters of other scripts that look like Latin letters.
HOMOGLYPHS = {
    "а": "a", "в": "b", "е": "e", "ѕ": "s", "і": "i", "ј": "j", "к": "k", "м": "m", "н": "h", "о": "o",
    "р": "p", "с": "c", "т": "t", "у": "y", "х": "x", "ԁ": "d", "һ": "h", "ԝ": "w", "ɡ": "g", "ı": "i",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t",
    "υ": "u", "χ": "x", "ω": "w",
}

# Digits and signs written for letters.  "l" folds to "i" because "1" stands for both.
SUBSTITUTES = {"0": "o", "1": "i", "l": "i", "|": "i", "!": "i", "3": "e", "4": "a", "@": "a", "5": "s", "$": "s", "7": "t", "8": "b"}


def _table() -> dict[int, str]:
    table: dict[int, str] = {}
    for code in range(128):
        c = chr(code)
        table[code] = SUBSTITUTES.get(c.lower(), c.lower()) if c.isalnum() or c in SUBSTITUTES else " "
    # Marked letters of western European languages tell words apart there; they only lose their case.
    for code in range(0xC0, 0x100):
        table[code] = chr(code).lower() if chr(code).isalpha() else " "
    # Rarer marked letters and full-width forms fold to their base letter.
    for code in [*range(0x100, 0x250), *range(0x1E00, 0x1F00), *range(0xFF01, 0xFF5F)]:
        base = "".join(c for c in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(c))
        if base and base.isascii():
            table[code] = "".join(table[ord(c)] for c in base)
    for look, letter in HOMOGLYPHS.items():
        for c in {look, look.upper()}:
            if len(c) == 1:
                table[ord(c)] = table[ord(letter)]
    for code in [*range(0x80, 0xC0), *range(0x2000, 0x2070), 0x3000]:
        if not chr(code).isalnum():
            table[code] = " "
    # Invisible characters and loose marks split nothing.
    for code in (0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF, *range(0x300, 0x370)):
        table[code] = ""
    return table


_TABLE = _table()
_BYTES = bytes(ord(_TABLE[c]) if c < 128 else c for c in range(256))
# Signs stand for letters only where a letter or digit follows; else they end the word.
_SIGNS = re.compile(r"[@$!|]+(?![^\W_])")


def fold(text: str | None) -> str:
    """Folded words, each with one space before and after it; a single space if there are none."""
    if not text:
        return " "
    text = _SIGNS.sub(" ", text)
    if text.isascii():
        text = text.encode().translate(_BYTES).decode()
    else:
        text = text.translate(_TABLE)
    words = text.split()
    return f" {' '.join(words)} " if words else " "
