"""Words of many texts at once, on their UTF-8 bytes, and a bounded memory of their ids.

Every separator is an ASCII character and no byte of a longer character looks like one, so texts can
be cut on bytes: one table look-up per byte finds the words, and the words of a batch become one
Arrow array without a Python object per word.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa

SLICE_BYTES = 4 << 20  # texts that are cut together; a longer text is cut alone


def byte_table(characters: str) -> np.ndarray:
    """True at the given ASCII characters."""
    table = np.zeros(256, bool)
    table[list(characters.encode("ascii"))] = True
    return table


# A-Z become a-z, all other bytes stay.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@dataclass(frozen=True)
class Words:
    """Words in order: ``words`` (large_binary), the text of each, and whether it follows the one before
    without a text border or a break between them."""

    words: pa.Array
    text: np.ndarray
    follows: np.ndarray


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an array of texts; NULL is empty."""
    texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return whole[bounds[0] : bounds[-1]], bounds - bounds[0]


def words_of(texts: pa.Array, separators: np.ndarray, breaks: np.ndarray | None = None) -> Words:
    """Lower-case (A-Z only) maximal runs of bytes that are neither separators nor breaks."""
    data, bounds = buffers(texts)
    n = len(data)
    gap = separators[data] if breaks is None else (separators | breaks)[data]
    inside = ~gap
    starts = inside.copy()
    starts[1:] &= gap[:-1]
    ends = inside.copy()
    ends[:-1] &= gap[1:]
    # a text begins and ends its words, whatever its neighbours are
    edges = np.unique(bounds[1:-1])
    edges = edges[(edges > 0) & (edges < n)]
    starts[edges] = inside[edges]
    ends[edges - 1] = inside[edges - 1]
    first, last = np.flatnonzero(starts), np.flatnonzero(ends)
    offsets = np.zeros(len(first) + 1, np.int64)
    np.cumsum(last - first + 1, out=offsets[1:])
    kept = _LOWER[data[inside]]
    words = pa.Array.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(kept)])
    text = np.searchsorted(bounds, first, side="right") - 1
    follows = np.zeros(len(first), bool)
    follows[1:] = text[1:] == text[:-1]
    if breaks is not None:
        part = np.searchsorted(np.flatnonzero(breaks[data]), first)
        follows[1:] &= part[1:] == part[:-1]
    return Words(words, text, follows)


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in parts whose texts have about ``most`` bytes together."""
    if not batch.num_rows:
        return
    _, bounds = buffers(batch.column(column))
    begin = 0
    while begin < batch.num_rows:
        end = int(np.searchsorted(bounds, bounds[begin] + most, side="right")) - 1
        end = min(max(end, begin + 1), batch.num_rows)
        yield batch.slice(begin, end - begin)
        begin = end


MARK, QUOTE, LETTER, OTHER, BLANK, BREAK = range(6)  # kinds of characters
_LATIN = 0xC3  # first byte of U+00C0 to U+00FF
_SIGNS = 0x97, 0xB7  # second bytes of those that are no letters


def kind_of(char: str) -> int:
    """Letters are those of ASCII and U+00C0 to U+00FF, marks what else is in ASCII, but spaces and line breaks."""
    if char.isascii():
        return {" ": BLANK, "\n": BREAK, "'": QUOTE}.get(char, LETTER if char.isalpha() else MARK)
    return LETTER if "\xc0" <= char <= "\xff" and char.isalpha() else OTHER


def byte_kinds(others: str = "") -> np.ndarray:
    """Kind of each byte; ``others`` are ASCII characters that count as other ones."""
    kinds = np.array([kind_of(chr(b)) if b < 128 else LETTER if b == _LATIN else OTHER for b in range(256)], np.uint8)
    kinds[list(others.encode("ascii"))] = OTHER
    return kinds


def after_spaces(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of the texts, with a space before every text that is not empty."""
    given, bounds = buffers(texts)
    filled = np.diff(bounds) > 0
    bounds = bounds + np.append(0, np.cumsum(filled))
    data = np.empty(bounds[-1], np.uint8)
    spaces = np.zeros(len(data), bool)
    spaces[bounds[:-1][filled]] = True
    data[spaces], data[~spaces] = ord(" "), given
    return data, bounds


def word_starts(data: np.ndarray, bounds: np.ndarray, kinds: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Where words begin: with a text, and where ``begins`` holds for the kinds of a character and the next one."""
    kind = kinds[data]
    latin = np.flatnonzero(data[:-1] == _LATIN)
    kind[latin + 1] = LETTER
    signs = latin[np.isin(data[latin + 1], _SIGNS)]
    kind[signs] = kind[signs + 1] = OTHER
    starts = np.append(True, begins.ravel()[kind[:-1] * len(begins) + kind[1:]])
    starts[bounds[:-1][np.diff(bounds) > 0]] = True
    return np.flatnonzero(starts)


def pieces_of(data: np.ndarray, starts: np.ndarray) -> pa.Array:
    """The bytes (large_binary) cut at ``starts``, the first of which is 0; nothing is copied."""
    offsets = np.append(starts, len(data)).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def spread(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``sizes[i]`` values from ``starts[i]`` on, for each i in turn."""
    ends = np.cumsum(sizes)
    index = np.repeat(starts - (ends - sizes), sizes)
    index += np.arange(len(index))
    return values[index]


class Memory:
    """Ids of the words that a worker has met, in flat arrays.

    ``learn`` gets new words (large_binary) and returns their ids, one after another, and the number of
    ids of each.  Words of a call are made unique first, so Python handles each of them once a call.
    With more than ``most`` words it forgets all but those that the present call holds: frequent words stay.
    """

    def __init__(self, learn: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]], most: int, dtype: type):
        self.learn, self.most = learn, most
        self.known: dict[bytes, int] = {}
        self.ids, self.starts, self.sizes = np.empty(0, dtype), np.empty(0, np.int64), np.empty(0, np.int64)

    def _store(self, ids: np.ndarray, sizes: np.ndarray) -> range:
        first = len(self.starts)
        self.starts = np.append(self.starts, len(self.ids) + np.cumsum(sizes) - sizes)
        self.sizes = np.append(self.sizes, sizes)
        self.ids = np.append(self.ids, ids.astype(self.ids.dtype))
        return range(first, len(self.starts))

    def _forget(self, spelled: list[bytes], number: np.ndarray) -> np.ndarray:
        """Keep only the given words; returns their new numbers."""
        starts, sizes = self.starts[number], self.sizes[number]
        ids = spread(self.ids, starts, sizes)
        self.ids, self.starts, self.sizes = ids[:0], starts[:0], sizes[:0]
        self.known = dict(zip(spelled, kept := self._store(ids, sizes)))
        return np.array(kept, np.int64)

    def look_up(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after another, and the number of ids of each."""
        coded = words.dictionary_encode()
        spelled = coded.dictionary.to_pylist()
        number = np.fromiter(map(self.known.get, spelled, repeat(-1)), np.int64, len(spelled))
        new = np.flatnonzero(number < 0)
        if len(new):
            if len(self.starts) + len(new) > self.most:
                old = np.flatnonzero(number >= 0)
                number[old] = self._forget([spelled[i] for i in old.tolist()], number[old])
            fresh = self._store(*self.learn(coded.dictionary.take(pa.array(new))))
            self.known.update(zip([spelled[i] for i in new.tolist()], fresh))
            number[new] = fresh
        at = number[coded.indices.to_numpy()]
        sizes = self.sizes[at]
        return spread(self.ids, self.starts[at], sizes), sizes

    def of_texts(self, data: np.ndarray, starts: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts whose words begin at ``starts``, one after another, and where each text's begin and end."""
        if not len(starts):
            return self.ids[:0], np.zeros(len(bounds), np.int64)
        ids, sizes = self.look_up(pieces_of(data, starts))
        return ids, np.append(0, np.cumsum(sizes))[np.searchsorted(starts, bounds)]
