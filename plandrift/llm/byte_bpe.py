"""Byte-level BPE: cutting text into pretokens as the tokenizer library does."""

from __future__ import annotations

import os
import re
import unicodedata
from functools import lru_cache

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")


def _class(kinds: str) -> str:
    """Regular-expression class of the characters below U+0300 of the given kinds."""
    return "".join(f"\\u{c:04x}" for c in range(0x300) if unicodedata.category(chr(c))[0] in kinds)


_L, _N = _class("L"), _class("N")
_S = r"\t\n\r \xa0"
#: The pretoken pattern of the vocabulary's public reference (fixed value), its
#: classes spelled out for the characters that ``ODD`` lets through.
PRETOKEN = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
#: Characters whose classes depend on the Unicode version or the library.
ODD = re.compile(r"[^\t\n\r -~\xa0-\u02ff]")


@lru_cache(maxsize=4)
def tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=4)
def added_strings(path: str) -> tuple[re.Pattern | None, dict[str, int]]:
    """Pattern and ids of the strings that the library takes out of texts beforehand."""
    ids = {t.content: i for i, t in tokenizer(path).get_added_tokens_decoder().items()}
    longest = sorted(ids, key=len, reverse=True)
    return (re.compile("(" + "|".join(map(re.escape, longest)) + ")") if ids else None), ids


def pretokens(text: str, path: str) -> list[str]:
    """The pretokens of a text without added strings."""
    if ODD.search(text):
        return [text[s:e] for _, (s, e) in tokenizer(path).pre_tokenizer.pre_tokenize_str(text)]
    return PRETOKEN.findall(text)


def parts(text: str, path: str) -> list[str]:
    """The pretokens of a text, added strings standing for themselves."""
    pattern, _ = added_strings(path)
    if pattern is None or not pattern.search(text):
        return pretokens(text, path)
    out: list[str] = []
    for k, piece in enumerate(pattern.split(text)):
        out += [piece] if k % 2 else pretokens(piece, path)
    return out
