"""Tokenizers of vocabulary files: ids and token bytes, and safe places to cut long texts.

A byte-level vocabulary writes each byte as a printable character (``BYTE_CHARS``); reversing that table gives the bytes
of a token. All files are read from ``public_tokenizers.path``, on the executors, once per worker.
"""

from __future__ import annotations

import base64
import itertools
import os
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text whose tokens a task holds at once, unless one text alone is longer.
SLICE = 4 << 20


def _byte_chars() -> list[str]:
    """Printable bytes stand for themselves; the others take the characters from 256 on, in order."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


BYTE_CHARS = _byte_chars()
CHAR_BYTES = {c: b for b, c in enumerate(BYTE_CHARS)}

#: A space between two characters that are not white space, nor the mark that pieces have for a space. No match of the
#: byte-level pattern goes on across it, and no piece of a vocabulary that splits by white space has a space after another
#: character, so texts may be cut before it.
_CUT = re.compile(r" (?<=[^\s▁] )(?=[^\s▁])")


def cut(text: str) -> list[str]:
    """The parts of a text between safe spaces, without those spaces; an empty text has none."""
    return _CUT.split(text) if text else []


@dataclass(frozen=True)
class Vocabulary:
    """``encode`` takes texts and gives ids without special tokens; ``tokens`` has the bytes of each id."""

    encode: Callable[[list[str]], list[list[int]]]
    tokens: list[bytes]


def ranks_of(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def _byte_level(tokenizer) -> Vocabulary:
    def token(i: int) -> bytes:
        name = tokenizer.id_to_token(i) or ""
        return bytes(CHAR_BYTES[c] for c in name) if all(c in CHAR_BYTES for c in name) else name.encode()

    return Vocabulary(lambda texts: [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)], [token(i) for i in range(tokenizer.get_vocab_size())])


def _from_ranks(path: str):
    """A byte-level BPE of the tokenizers library. A pair merges when its bytes are a token, the least rank first, so
    every split of a token into two tokens is a merge of that token's rank."""
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    ranks = ranks_of(path)
    name = {t: "".join(map(BYTE_CHARS.__getitem__, t)) for t in ranks}
    merges = [(name[t[:i]], name[t[i:]]) for t in sorted(ranks, key=ranks.__getitem__) for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
    tokenizer = Tokenizer(models.BPE({name[t]: r for t, r in ranks.items()}, merges, ignore_merges=True))
    pieces = pre_tokenizers.Split(Regex(public_tokenizers.PATTERN), "isolated")
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence([pieces, pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    return tokenizer


def _pieces(path: str) -> Vocabulary:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    token = lambda i: bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode()
    return Vocabulary(lambda texts: model.encode(texts, num_threads=1), [token(i) for i in range(model.get_piece_size())])


@cache
def vocabulary(name: str) -> Vocabulary:
    """By file name: ``.tiktoken`` and ``.json`` are byte-level BPE, ``.model`` is sentencepiece (which adds a space)."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    path = public_tokenizers.path(name)
    if name.endswith(".tiktoken"):
        return _byte_level(_from_ranks(path))
    if name.endswith(".json"):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True
        return _byte_level(tokenizer)
    return _pieces(path)


#: Parts that the library gets as one text, which costs it less than a text each.
JOINED = 64


def _joins(part: str) -> bool:
    """Whether a part starts with one space and ends with none, so that it may follow and be followed by such parts."""
    return len(part) > 1 and part[0] == " " and not part[1].isspace() and not part[-1].isspace()


def encoded_parts(name: str, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of parts by a byte-level vocabulary, one after the other, and how many each part has.

    Parts that may follow each other are encoded together and taken apart by their bytes: at a cut, a token ends.
    """
    v = vocabulary(name)
    joins = np.fromiter(map(_joins, parts), bool, len(parts))
    together, alone = np.flatnonzero(joins), np.flatnonzero(~joins)
    texts = [parts[i] for i in together.tolist()]
    flat = lambda lists: np.fromiter(itertools.chain.from_iterable(lists), np.int64)
    ids = flat(v.encode(["".join(texts[i : i + JOINED]) for i in range(0, len(texts), JOINED)]))
    ends, part_ends = np.cumsum(lengths(name)[ids]), np.cumsum(np.fromiter((len(t.encode()) for t in texts), np.int64, len(texts)))
    upto = np.searchsorted(ends, part_ends) + 1
    if len(texts) and not np.array_equal(ends[upto - 1], part_ends):
        raise ValueError(f"{name}: a token goes on across a cut")
    lists = v.encode([parts[i] for i in alone.tolist()])
    counts = np.zeros(len(parts), np.int64)
    counts[together], counts[alone] = np.diff(upto, prepend=0), [len(x) for x in lists]
    starts = np.zeros(len(parts), np.int64)
    starts[together], starts[alone] = np.concatenate([[0], upto])[:-1], len(ids) + np.cumsum(counts[alone]) - counts[alone]
    place = np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    return np.concatenate([ids, flat(lists)])[place], counts


@cache
def lengths(name: str) -> np.ndarray:
    """The bytes of each token."""
    return np.array([len(t) for t in vocabulary(name).tokens], np.int64)


def text_slices(batches: Iterator[pa.RecordBatch], column: int, size: int = SLICE) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of batches with at most ``size`` bytes of text (or one row), and their texts: null as empty, and bytes
    that are no UTF-8 as the replacement character."""
    for b in batches:
        sizes = [n or 0 for n in pc.binary_length(b.column(column)).to_pylist()]
        start, held = 0, 0
        for at in range(len(sizes) + 1):
            if at == len(sizes) or (at > start and held + sizes[at] > size):
                if at > start:
                    part = b.slice(start, at - start)
                    yield part, [(x or b"").decode("utf-8", "replace") for x in part.column(column).cast(pa.binary()).to_pylist()]
                start, held = at, 0
            if at < len(sizes):
                held += sizes[at]
