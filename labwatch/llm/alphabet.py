"""Character classes of the public tokenizers' patterns up to U+00FF, and the byte alphabet of their vocabularies."""

from __future__ import annotations

# Letters, digits and blanks as the patterns tell them apart (fixed values).
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ÿ"
DIGITS = "0-9²³¹¼-¾"
BLANKS = "\t-\r \u0085\u00a0"


def byte_alphabet() -> dict[int, int]:
    """The printable character that byte-level vocabularies write for each byte: itself, or the next one from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return dict(zip(plain, plain)) | {b: 256 + n for n, b in enumerate(others)}


def is_latin(text: str) -> bool:
    """Whether all code points are at most U+00FF."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True
