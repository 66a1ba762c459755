"""Shared helpers: byte blocks of Arrow texts, and vectorised substring hashes.

Texts are worked on as UTF-8 bytes in numpy. A *block* is a run of consecutive documents of a record batch holding
about ``BLOCK_BYTES`` bytes (a longer document is a block of its own, it is never cut), which bounds a worker's memory.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from ..sources.scratch import cleaned, discard, materialise, shared_folder

__all__ = ["Block", "Substrings", "Words", "blocks", "cleaned", "discard", "fold_case", "free_name", "materialise", "mix", "normalise", "powers", "runs", "shared_folder", "text_buffers", "words_of"]

BLOCK_BYTES = 1 << 19

_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_powers = np.ones(1, dtype=np.uint64)
_inverse_powers = np.ones(1, dtype=np.uint64)

#: ASCII capitals to small letters; all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes that belong to words: ASCII letters and digits, and every byte of a non-ASCII character.
IS_WORD = np.zeros(256, dtype=bool)
for _low, _high in ((48, 58), (65, 91), (97, 123), (128, 256)):
    IS_WORD[_low:_high] = True


def free_name(name: str, taken: list[str]) -> str:
    """The name, or with the first number that no column of ``taken`` has (capitals are no difference)."""
    lower, number = {c.lower() for c in taken}, 1
    while (found := name if number == 1 else f"{name}_{number}").lower() in lower:
        number += 1
    return found


@dataclass
class Block:
    """Documents ``first`` to ``last`` (exclusive) of a record batch; ``starts`` are byte offsets into ``data``."""

    first: int
    last: int
    data: np.ndarray
    starts: np.ndarray

    @property
    def size(self) -> int:
        return self.last - self.first


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column and its offsets; NULL counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data, offsets


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    data, offsets = text_buffers(column)
    count, first = len(offsets) - 1, 0
    while first < count:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(count, max(first + 1, last))
        low = int(offsets[first])
        yield Block(first, last, data[low : int(offsets[last])], (offsets[first : last + 1] - low).astype(np.int64))
        first = last


def powers(length: int) -> tuple[np.ndarray, np.ndarray]:
    """The multiplier's powers and inverse powers up to ``length``, kept for the worker's life."""
    global _powers, _inverse_powers
    if len(_powers) < length:
        size = max(length, 2 * len(_powers), BLOCK_BYTES + 1)
        made = []
        for factor in (_MULTIPLIER, _INVERSE):
            out = np.full(size, factor, dtype=np.uint64)
            out[0] = 1
            made.append(np.multiply.accumulate(out))
        _powers, _inverse_powers = made
    return _powers, _inverse_powers


def mix(values: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that every bit of the result depends on every bit of the value."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


class Substrings:
    """64-bit hashes of any substrings of an array in constant time each, by prefix sums of a polynomial."""

    def __init__(self, values: np.ndarray) -> None:
        power, self._inverse = powers(len(values) + 1)
        self._sums = np.zeros(len(values) + 1, dtype=np.uint64)
        terms = values.astype(np.uint64) if values.dtype != np.uint64 else values.copy()
        terms += np.uint64(1)
        terms *= power[: len(values)]
        np.cumsum(terms, out=self._sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out = self._sums[ends] - self._sums[starts]
        out *= self._inverse[starts]
        return mix(out)


def fold_case(data: np.ndarray) -> np.ndarray:
    """Small letters for ASCII and Latin-1 capitals; other scripts stay as they are."""
    out = LOWER[data]
    accented = np.flatnonzero(data == 0xC3) + 1
    accented = accented[accented < len(data)]
    letters = data[accented]
    accented = accented[(letters >= 0x80) & (letters <= 0x9E) & (letters != 0x97)]
    out[accented] += 32
    return out


def runs(member: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true positions; a document's end also ends a run."""
    size = len(member)
    if not size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    before = np.zeros(size, dtype=bool)
    before[1:] = member[:-1]
    edge = starts[(starts > 0) & (starts < size)]
    before[edge] = False
    begins = np.flatnonzero(member & ~before)
    after = np.zeros(size, dtype=bool)
    after[:-1] = member[1:]
    after[edge - 1] = False
    return begins, np.flatnonzero(member & ~after) + 1


@dataclass
class Words:
    """Words of a block: byte spans in the case-folded data, 64-bit hashes, and each document's word offsets."""

    folded: np.ndarray
    begins: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    offsets: np.ndarray


def words_of(block: Block) -> Words:
    folded = fold_case(block.data)
    begins, ends = runs(IS_WORD[folded], block.starts)
    hashes = Substrings(folded).of(begins, ends) if len(begins) else np.zeros(0, np.uint64)
    return Words(folded, begins, ends, hashes, np.searchsorted(begins, block.starts))


def normalise(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Each text's case-folded words between single spaces, with a space at both ends, and the texts' offsets.

    A text without words gives nothing.
    """
    data = fold_case(block.data)
    word = IS_WORD[data]
    previous = np.zeros(len(data), dtype=bool)
    previous[1:] = word[:-1]
    if len(data):
        previous[block.starts[:-1][block.starts[:-1] < len(data)]] = False
    at = np.flatnonzero(word | previous)
    kept = np.where(word[at], data[at], np.uint8(32))
    offsets = np.searchsorted(at, block.starts)
    filled = (offsets[1:] > offsets[:-1]).astype(np.int64)
    open_end = np.zeros(block.size, dtype=np.int64)
    some = filled > 0
    open_end[some] = kept[offsets[1:][some] - 1] != 32
    grown = np.concatenate([[0], np.cumsum(np.diff(offsets) + filled + open_end)])
    out = np.full(grown[-1], 32, dtype=np.uint8)
    out[np.arange(len(kept)) + np.repeat(grown[:-1] - offsets[:-1] + filled, np.diff(offsets))] = kept
    return out, grown
