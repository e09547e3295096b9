"""Token ids of whole texts with a public tokenizer file.

Texts in Latin letters go through the file's vocabulary in tiktoken, which is
several times faster than the tokenizers library: pieces are cut here, and a
zero byte after each stands for the vocabulary's end-of-word mark. All other
texts (further alphabets, other control characters, anything like a special
token) go to the tokenizers library itself. Tests hold both ways against the
library on whole texts.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np

_FAST = re.compile(r"[\n -~À-įı-ſ]*")
# How the tokenizer file cuts a text into pieces, for Latin letters.
_DIGITS = re.compile(r"([0-9])")
_SIGNS = re.compile(r"([^a-zÀ-ÖØ-öø-ſ0-9\x00]+)")
_PIECES = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d|[a-zÀ-ÖØ-öø-ſ]+|[0-9]"
    r"|[^a-zÀ-ÖØ-öø-ſ0-9\n ]+"
)
_END = "</w>"
_workers: dict[str, TextTokenizer] = {}


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_of_letter() -> dict[str, int]:
    """How byte-level vocabularies write bytes: printable ones as themselves, others from U+0100."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _marked(text: str) -> str:
    """The pieces of a text, a zero byte after each; further zero bytes mean nothing."""
    text = text.lower()
    if "'" in text:
        return "\0".join(_PIECES.findall(text)) + "\0"
    text = _DIGITS.sub("\0\\1\0", text.replace("\n", "\0").replace(" ", "\0"))
    return _SIGNS.sub("\0\\1\0", text) + "\0"


class TextTokenizer:
    """Ids as arrays of unsigned little-endian 32-bit numbers."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        special = {token["content"] for token in content["added_tokens"]}
        letters = _byte_of_letter()
        ranks = {}
        for token, number in content["model"]["vocab"].items():
            if token not in special:
                body = token.removesuffix(_END)
                mark = b"\0" if token.endswith(_END) else b""
                ranks[bytes(letters[c] for c in body) + mark] = number
        self.fast = tiktoken.Encoding(
            "pieces", pat_str=r"[^\x00]+\x00", mergeable_ranks=ranks, special_tokens={}
        )

    def ids(self, text: str) -> np.ndarray:
        if _FAST.fullmatch(text) and "<|" not in text:
            marked = _marked(text)
            return self.fast.encode_to_numpy(marked, disallowed_special=()).astype("<u4")
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4")


def tokenizer(path: str) -> TextTokenizer:
    """The worker's own copy, loaded once."""
    if path not in _workers:
        _workers[path] = TextTokenizer(path)
    return _workers[path]
