"""Pre-tokens of two public byte-pair vocabularies, and caches of what they encode to.

Byte-pair merges never cross a pre-token, so the ids of a text are those of its
pre-tokens in order. The patterns here cover texts of ASCII and the Latin-1 letters,
for which case, composition and letter classes have no exceptions; any other text goes
through the library as a whole. So do texts that hold the string of a special token.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import public_tokenizers
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

_OTHER = re.compile("[^\x00-\x7fÀ-ÖØ-öø-ÿ]")
_L, _S = "a-zA-ZÀ-ÖØ-öø-ÿ", "\t-\r "
#: How the two vocabularies cut a text. Letters come first, being frequent;
#: no other alternative starts with them. The second is for texts in lower case.
BYTE_PATTERN = re.compile(
    rf" ?[{_L}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[0-9]+| ?[^{_S}{_L}0-9]+|[{_S}]+(?![^{_S}])|[{_S}]+"
)
WORD_PATTERN = re.compile(
    rf"[a-zß-öø-ÿ]+|'s|'t|'re|'ve|'m|'ll|'d|[0-9]|[^{_S}a-zß-öø-ÿ0-9]+"
)
#: Entries of each of the two generations of a worker's cache, and the longest ones: what is
#: longer is encoded each time, so that a cache is bounded in bytes.
CACHE, LONGEST = 300_000, 256


def tokenizer_path(name: str) -> str:
    """Where a vocabulary file of the public tokenizers lies."""
    return public_tokenizers.path(name)


class Encoder:
    """Ids of whole texts by way of their pre-tokens; one per Python worker and file."""

    _made: dict[str, Encoder] = {}

    def __init__(self, path: str, pattern: re.Pattern, lower: bool):
        self.library = Tokenizer.from_file(path)
        self.findall, self.lower = pattern.findall, lower
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.tokenize = self.library.model.tokenize
        # How the byte level writes each character that a plain text may have.
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        plain = [chr(i) for i in range(256) if not _OTHER.match(chr(i))]
        self.written = {ord(c): level.pre_tokenize_str(c)[0][0] for c in plain}
        self.young: dict = {}
        self.old: dict = {}

    @classmethod
    def of(cls, path: str, pattern: re.Pattern, lower: bool) -> Encoder:
        if path not in cls._made:
            cls._made[path] = cls(path, pattern, lower)
        return cls._made[path]

    def whole(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def piece(self, piece: str) -> list[int]:
        """Ids of one pre-token of a plain text, straight from the model."""
        return [t.id for t in self.tokenize(piece.translate(self.written))]

    def plain(self, text: str) -> bool:
        """Whether the text's pre-tokens are those of the pattern."""
        return not _OTHER.search(text) and not any(s in text for s in self.special)

    def pieces(self, text: str) -> list[str]:
        return self.findall(text.lower() if self.lower else text)

    def cached(self, pieces: list[str], make: Callable[[list[int]], object]) -> list:
        """The value of each piece: what ``make`` makes of its ids.

        A full generation becomes the old one, from which what is still in use returns.
        """
        found = list(map(self.young.get, pieces))
        if None in found:
            young, old = self.young, self.old
            for k, p in enumerate(pieces):
                if found[k] is None:
                    found[k] = value = young.get(p) or old.get(p) or make(self.piece(p))
                    if len(p) <= LONGEST:
                        young[p] = value
            if len(young) > CACHE:
                self.old, self.young = young, {}
        return found
