"""Byte-level BPE ids and character spans for whole texts.

The vocabulary file is given by path and only read. Ids equal those of the ``tokenizers`` library for
``byte_bpe_50k.json`` with ``add_special_tokens=False`` (checked in tests), where a literal
``<|endoftext|>`` becomes id 50256; ``tiktoken`` gives them in a third of the CPU time.
"""

from __future__ import annotations

import base64

import numpy as np

END_OF_TEXT = "<|endoftext|>"
END_ID = 50256


class Encoder:
    def __init__(self, ranks_path: str, pattern: str):
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.bpe = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={END_OF_TEXT: END_ID})
        self.width = np.zeros(max(*ranks.values(), END_ID) + 1, np.int64)
        self.width[list(ranks.values())] = [len(k) for k in ranks]
        self.width[END_ID] = len(END_OF_TEXT)

    def encode(self, text: str) -> np.ndarray:
        """Token ids as little-endian uint32."""
        if END_OF_TEXT in text:
            return np.array(self.bpe.encode(text, allowed_special="all"), "<u4")
        return np.array(self.bpe.encode_ordinary(text), "<u4")

    def spans(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(ids, first character of each token). A token that begins inside a character begins at that character."""
        ids = self.encode(text)
        begins = np.cumsum(self.width[ids]) - self.width[ids]
        raw = np.frombuffer(text.encode(), np.uint8)
        if len(raw) == len(text):
            return ids, begins
        return ids, (np.cumsum((raw & 0xC0) != 0x80) - 1)[begins]


def public_encoder() -> Encoder:
    """The encoder of the installed 50k byte-level vocabulary."""
    import public_tokenizers

    return Encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
