"""White space as the tokenizers' regular expressions know it."""

from __future__ import annotations

import re

# Unicode's white space; it does not hold U+001C to U+001F, which ``str.split`` cuts at
WS = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_WORD = re.compile(f"[^{WS}]+")
_SEPARATORS = re.compile("[\x1c-\x1f]")


def words(text: str) -> list[str]:
    """The runs between white space."""
    return _WORD.findall(text) if _SEPARATORS.search(text) else text.split()
