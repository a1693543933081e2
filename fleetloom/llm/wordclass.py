"""Character classes over the code points below U+0250, where every Unicode version agrees, and byte-level symbols."""

from __future__ import annotations

import re
import unicodedata

LIMIT = 0x250


def _ranges(codes: list[int]) -> str:
    out, start, last = [], None, None
    for c in [*codes, None]:
        if start is not None and c != last + 1:
            out.append(f"\\u{start:04x}-\\u{last:04x}")
            start = None
        if start is None:
            start = c
        last = c
    return "".join(out)


def _of(first_letters: str) -> str:
    return _ranges([c for c in range(LIMIT) if unicodedata.category(chr(c))[0] in first_letters])


LETTERS = _of("L")
NUMBERS = _of("N")
#: White_Space below U+0250.
SPACE = "\\u0009-\\u000d\\u0020\\u0085\\u00a0"
#: A text with such a character goes the library's own way: its class or its normal form may depend on a Unicode version.
#: U+0130 is among them, as its lower case has a combining mark.
UNUSUAL = re.compile(f"[^\\u0000-\\u012f\\u0131-\\u{LIMIT - 1:04x}]")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]
