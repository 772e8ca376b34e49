"""Words of a text as they are compared: without case, markup, look-alikes, marks and broken lines."""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Container

import regex

# Letters of other alphabets that look like Latin ones, after decomposition and in lower case.
_CYRILLIC = {"а": "a", "в": "b", "г": "r", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x", "ь": "b"}
_CYRILLIC_MORE = {"і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ԛ": "q", "ԝ": "w", "һ": "h", "ӏ": "l"}
_GREEK = {"α": "a", "β": "b", "ε": "e", "η": "h", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "y", "χ": "x", "ω": "w"}
LOOK_ALIKES = str.maketrans({**_CYRILLIC, **_CYRILLIC_MORE, **_GREEK, "ı": "i"})
#: Tags that stand between words; all others stand inside them.
_BLOCKS = regex.compile(r"<\s*/?\s*(?:p|div|br|li|ul|ol|tr|td|th|table|h[1-6]|hr|section|article|pre|blockquote)\b[^<>]{0,500}>", regex.I)
_TAGS = regex.compile(r"</?[a-zA-Z][^<>]{0,500}>|<!--.{0,2000}?-->", regex.S)
_JOINER = regex.compile(r"\p{Cf}+")
_MARKS = regex.compile(r"\p{Mn}+")
_BREAK = re.compile(r"(?<=[^\W_])[-‐‑]\s*\n\s*(?=[^\W_])")
_WORD = regex.compile(r"[^\W_]+")
_EMPHASIS = "*_`~"
#: Bytes that stand in words of plain text; all others become blanks.
_PLAIN = bytes(b if chr(b).isalnum() and b < 128 else 32 for b in range(256))


def folded(text: str) -> str:
    """The text without markup, marks, invisible and look-alike characters, in lower case."""
    if "<" in text:
        text = _TAGS.sub("", _BLOCKS.sub(" ", text))
    if "&" in text:
        text = html.unescape(text)
    if not text.isascii():
        text = _MARKS.sub("", unicodedata.normalize("NFKD", _JOINER.sub("", text)))
        text = text.lower().replace("ß", "ss").translate(LOOK_ALIKES)
    for mark in _EMPHASIS:
        if mark in text:
            text = text.replace(mark, "")
    return text.lower()


def _plain_words(text: str) -> list[str]:
    return text.encode().translate(_PLAIN).decode().split() if text.isascii() else _WORD.findall(text)


def tokens(text: str | None) -> tuple[list[str], list[int]]:
    """The words of a whole text, and the places of those that a hyphen at a line's end parts from the next one. Of breaks that
    follow one another only every other counts. Null gives none."""
    if not text:
        return [], []
    text = folded(text)
    parts = _BREAK.split(text) if "\n" in text else [text]
    out = _plain_words(parts[0])
    breaks: list[int] = []
    for p in parts[1:]:
        if not breaks or breaks[-1] != len(out) - 2:
            breaks.append(len(out) - 1)
        out += _plain_words(p)
    return out, breaks


def is_one_word(a: str, b: str, known: Container[str]) -> bool:
    """Whether the parts of a broken word are one: not if they are known words and the whole is not."""
    return a + b in known or a not in known or b not in known


def words(text: str | None, known: Container[str] = ()) -> list[str]:
    """The words of a whole text. A word broken by a hyphen at a line's end is joined, unless its parts are known
    words and the whole is not. Null gives none."""
    out, breaks = tokens(text)
    for p in reversed(breaks):
        if is_one_word(out[p], out[p + 1], known):
            out[p : p + 2] = [out[p] + out[p + 1]]
    return out
