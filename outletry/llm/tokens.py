"""Byte-level BPE ids of whole texts, by the tokenizers library.

The library takes some microseconds for a call and caches few words, so a worker
remembers the ids of the words it has seen: the tokenizer splits a text into words
by a fixed pattern before it merges, hence the ids of a text are those of its words
in order. Texts on which the standard library's pattern could split otherwise than
the tokenizer's go through the tokenizer whole.
"""

from __future__ import annotations

import os
import re
from array import array
from functools import lru_cache

# The published pre-tokenization pattern, in the standard library's classes.
_WORD = re.compile(r" ?[^\W\d_]+|'(?:[sdmt]|ll|ve|re)| ?[0-9]+| ?[^\s\w]+(?:[^\s\w]|_)*| ?_(?:[^\s\w]|_)*|\s+(?!\S)|\s+")
_ASCII = re.compile(_WORD.pattern.replace(r"[^\W\d_]", "[A-Za-z]"), re.ASCII)
# Numbers that are neither letters nor ASCII digits, blanks of one library only, and all beyond the Latin and Greek blocks.
_ODD = re.compile(r"[\x1c-\x1f\x85\xb2\xb3\xb9\xbc-\xbe]|[^\x00-ɏΑ-ΡΣ-ω‐-‧‰-⁞€]")


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """Where the installed public vocabulary file is; a path may be given in place of a name."""
    if os.path.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Little-endian unsigned 32-bit ids of texts, as bytes.

    words: how many words it remembers, so that its memory has a bound; further ones
    are encoded each time. A text that holds an added token, such as ``<|endoftext|>``,
    goes through the tokenizer whole, which gives that token's id; with `special_as_text`
    such strings are ordinary text.
    """

    def __init__(self, name: str = "byte_bpe_50k.json", words: int = 400_000, special_as_text: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary(name))
        self.tokenizer.encode_special_tokens = special_as_text
        self.added = tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.words, self.known = words, {}

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def __call__(self, text: str) -> bytes:
        if text.isascii():
            plain, pattern = not any(c in text for c in "\x1c\x1d\x1e\x1f"), _ASCII
        else:
            plain, pattern = not _ODD.search(text), _WORD
        if not plain or any(t in text for t in self.added):
            return self._whole([text])[0]
        found = pattern.findall(text)
        got = list(map(self.known.get, found))
        if None in got:
            places = [i for i, x in enumerate(got) if x is None]
            new = list(dict.fromkeys([found[i] for i in places]))
            ids = dict(zip(new, self._whole(new), strict=True))
            for i in places:
                got[i] = ids[found[i]]
            if len(self.known) < self.words:
                self.known.update((w, x) for w, x in ids.items() if len(w) < 64)
        return b"".join(got)


@lru_cache(maxsize=2)
def encoder(name: str = "byte_bpe_50k.json") -> Encoder:
    """This process's encoder: a worker's later tasks find the words of its earlier ones."""
    return Encoder(name)
