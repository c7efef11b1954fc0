"""Byte-level BPE through the tokenizers library, one call per distinct unit of text.

The pattern that splits text before the merges never lets a piece reach across the place before a space that
a non-space follows. Texts are therefore cut at those places into units (mostly a space and a word), each distinct unit is
encoded once by the library, and a text's ids are its units' ids in order. Texts with a run of white space are cut
by the pattern's own rule instead: only where such a run ends in a space.
"""

from __future__ import annotations

import base64
import json
import os
import re
from functools import cache

import numpy as np

#: Distinct units in each of the two generations a worker remembers: about 70 MB a generation.
REMEMBERED = 300_000
#: Units that are encoded in one call.
TOGETHER = 4000
#: Fixed value: the splitting rule that the library has built in.
BUILT_IN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_RUN = re.compile(r" (?=\s|\Z)")
_CUT = re.compile(r" (?=\S)")


@cache
def byte_characters() -> tuple[str, ...]:
    """The character that stands for each byte: printable Latin-1 ones for themselves, the rest from 256 upward."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return tuple(chr(b) if b in printable else chr(next(others)) for b in range(256))


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def tokenizer_of_ranks(ranks: dict[bytes, int], pattern: str):
    """A tokenizer of the library that encodes by ``ranks``.

    A rank file names tokens, not merges: any two neighbours whose bytes together are a token may merge, the lowest
    rank first. So every split of a token into two tokens is a merge, in the order of the tokens' ranks.
    """
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    characters = byte_characters()
    spelt = {token: "".join(characters[b] for b in token) for token in ranks}
    merges = []
    for token in sorted(ranks, key=ranks.__getitem__):
        for at in range(1, len(token)):
            if token[:at] in ranks and token[at:] in ranks:
                merges.append((spelt[token[:at]], spelt[token[at:]]))
    model = models.BPE(vocab={spelt[t]: rank for t, rank in ranks.items()}, merges=merges, ignore_merges=True)
    tokenizer = Tokenizer(model)
    if pattern == BUILT_IN:
        tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
    else:
        tokenizer.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.Split(Regex(pattern), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    return tokenizer


def tokenizer_of_file(path: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True  # their spelling in a text is ordinary text
    return tokenizer


def bytes_of_ids(path: str) -> list[bytes]:
    """The bytes of every id, from a rank file or from a tokenizer file whose characters stand for bytes."""
    if path.endswith(".json"):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        back = {character: b for b, character in enumerate(byte_characters())}
        table = {i: bytes(back[c] for c in token) for token, i in spec["model"]["vocab"].items()}
        table |= {t["id"]: t["content"].encode() for t in spec["added_tokens"]}
    else:
        table = {rank: token for token, rank in read_ranks(path).items()}
    return [table.get(i, b"") for i in range(max(table) + 1)]


class Encoder:
    """Texts to packed ids (little-endian unsigned 32-bit), with a bounded memory of units.

    A text's first unit and the others, which all begin with a space, are remembered apart; the others without that space.
    """

    def __init__(self, tokenizer, token_bytes: list[bytes]):
        self.tokenizer = tokenizer
        self.lengths = np.array([len(token) for token in token_bytes], np.int64)
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.first: dict[str, bytes] = {"": b""}

    @staticmethod
    def cut(text: str) -> list[str]:
        """The first unit and the others, these without the space they begin with."""
        if _RUN.search(text) is None:
            return text.split(" ")
        starts = [found.start() for found in _CUT.finditer(text)]
        if not starts or starts[0]:
            starts.insert(0, -1)
        else:
            return ["", *[text[a + 1:b] for a, b in zip(starts, [*starts[1:], len(text)])]]
        return [text[a + 1:b] for a, b in zip(starts, [*starts[1:], len(text)])]

    def _encoded(self, units: list[str]) -> list[bytes]:
        return [np.array(found.ids, "<u4").tobytes() for found in self.tokenizer.encode_batch_fast(units, add_special_tokens=False)]

    def learn(self, units: list[str]) -> None:
        """Encode units (without their space) that are not known yet: those that a cut may precede together, others alone."""
        joined = [unit for unit in units if unit and not unit[0].isspace()]
        alone = [unit for unit in units if not (unit and not unit[0].isspace())]
        self.known |= zip(alone, self._encoded([" " + unit for unit in alone]))
        for begin in range(0, len(joined), TOGETHER):
            some = joined[begin:begin + TOGETHER]
            whole = " " + " ".join(some)
            ids = np.array(self.tokenizer.encode_batch_fast([whole], add_special_tokens=False)[0].ids, "<u4")
            ends = np.cumsum(np.fromiter(map(len, map(str.encode, some)), np.int64, len(some)) + 1)
            stops = (np.searchsorted(np.cumsum(self.lengths[ids]), ends) + 1) * 4  # no token crosses a cut
            packed, stops = ids.tobytes(), stops.tolist()
            self.known |= zip(some, [packed[a:b] for a, b in zip([0, *stops], stops)])

    def __call__(self, texts: list[str]) -> list[bytes]:
        parts = [self.cut(text) if text else [""] for text in texts]
        heads = [part.pop(0) for part in parts]
        if len(self.known) > REMEMBERED:
            self.before, self.known = self.known, {}
        if len(self.first) > REMEMBERED:
            self.first = {"": b""}
        known, before = self.known, self.before
        new = set().union(*parts).difference(known)
        if before:
            old = new.intersection(before)
            known |= zip(old, map(before.__getitem__, old))
            new -= old
        self.learn([*new])
        begins = [*set(heads).difference(self.first)]
        self.first |= zip(begins, self._encoded(begins))
        return [self.first[head] + b"".join(map(known.__getitem__, part)) for head, part in zip(heads, parts)]


@cache
def encoder_of(path: str, pattern: str = BUILT_IN) -> Encoder:
    """One encoder per worker process and vocabulary file."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    tokenizer = tokenizer_of_file(path) if path.endswith(".json") else tokenizer_of_ranks(read_ranks(path), pattern)
    return Encoder(tokenizer, bytes_of_ids(path))
