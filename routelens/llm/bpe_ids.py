"""Token ids by the tokenizers library, with pieces of text encoded many at a time."""

from __future__ import annotations

import json

import numpy as np

SPECIAL = "<|endoftext|>"
#: Pieces that a worker remembers, about 150 bytes each.
REMEMBERED = 1_200_000
_JOINED = 20_000


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_lengths(path: str) -> np.ndarray:
    """UTF-8 bytes that each id stands for: a byte-level token has one character for each byte."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)
    top = max([*model["model"]["vocab"].values(), *(added["id"] for added in model["added_tokens"])])
    lengths = np.zeros(top + 1, np.int64)
    for token, number in model["model"]["vocab"].items():
        lengths[number] = len(token)
    for added in model["added_tokens"]:
        lengths[added["id"]] = len(added["content"].encode())
    return lengths


class PieceEncoder:
    """Ids of pieces as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._lengths = byte_lengths(path)

    def __call__(self, pieces: list[str]) -> list[bytes]:
        """Pieces that begin with a blank are joined, encoded in one call, and told apart by byte lengths."""
        out: list[bytes] = [b""] * len(pieces)
        joined = []
        for i, piece in enumerate(pieces):
            if piece[:1] in " \n" and piece.strip() and not piece[-1].isspace() and not piece[1].isspace() and SPECIAL not in piece:
                joined.append(i)
            elif piece:
                out[i] = self._ids(piece).tobytes()
        for at in range(0, len(joined), _JOINED):
            some = joined[at : at + _JOINED]
            ids = self._ids("".join([pieces[i] for i in some]))
            ends = np.cumsum([len(pieces[i].encode()) for i in some])
            cuts = (4 * np.searchsorted(np.cumsum(self._lengths[ids]), ends, side="right")).tolist()
            data, start = ids.tobytes(), 0
            for i, end in zip(some, cuts, strict=True):
                out[i] = data[start:end]
                start = end
        return out

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self._tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")
