"""Token ids of whole texts by a public byte-level BPE vocabulary, word by word.

Byte-level BPE never merges across its own pre-split, so the ids of a text are those of its parts. The parts recur, so each
worker encodes a recurring part once. Texts with characters for which Python's classes could differ from the tokenizer's
are given to it whole.
"""

from __future__ import annotations

import os
import re

import public_tokenizers

from lampyris.llm.cache import Recent

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
#: The pre-split of the vocabulary (fixed), written with Python's classes.
_PARTS = re.compile(r"'(?:[sdmt]|ll|ve|re)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+").findall
#: Other characters than ASCII's printable and white space, and the letters of Latin-1 and Latin Extended.
_OTHER = re.compile(r"[^\t-\r -~À-ÖØ-öø-ɏ]").search
#: Byte-level vocabularies write a byte as a printable character (fixed): itself, or one from U+0100 on for the others in turn.
_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_SHOWN = {b: 0x100 + k for k, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}


class Ids:
    """Ids of texts as unsigned 32-bit little-endian bytes."""

    def __init__(self, path: str = VOCABULARY):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks already use the cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.parts = Recent(self._part, 400_000)

    def _part(self, part: str) -> bytes:
        shown = part.encode().decode("latin-1").translate(_SHOWN)
        return b"".join(t.id.to_bytes(4, "little") for t in self.tokenizer.model.tokenize(shown))

    def whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return b"".join(i.to_bytes(4, "little") for i in ids)

    def of(self, text: str | None) -> bytes:
        """All ids of the text; none of a null or empty text."""
        if not text:
            return b""
        if _OTHER(text):
            return self.whole(text)
        return b"".join(map(self.parts.__getitem__, _PARTS(text)))
