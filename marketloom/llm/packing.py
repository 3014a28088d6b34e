"""Packing tokenised documents into sequences: dominance reduction, then best fit.

A sequence holds at most ``capacity`` tokens, so there are at most ``capacity`` different lengths.  The
plan is made on the number of pieces per length, a table whose size does not depend on the corpus, and
pieces find their places by their number within their length.
"""

from __future__ import annotations

import bisect
import os
import zlib
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from marketloom.llm.common import free_name, gapless_numbers, other_columns
from marketloom.llm.tokens import (
    BLANK,
    LETTER,
    MARK,
    QUOTE,
    Memory,
    after_spaces,
    byte_kinds,
    kind_of,
    slices,
    spread,
    word_starts,
)
from marketloom.sources.scratch import stored

CAPACITY = 2048
CACHE_WORDS = 400_000  # words that a worker remembers; beyond them it keeps those of the present texts
_LETTERS = "^[A-Za-zÀ-ÖØ-öø-ÿ]+$"  # lowered, letters that the tokenizer cannot join to others


# --- the plan ------------------------------------------------------------


@dataclass(frozen=True)
class Pattern:
    """``count`` sequences that hold, each, ``items``: (length, how many of it)."""

    count: int
    items: tuple[tuple[int, int], ...]


class _Lengths:
    """How many pieces there are of each length, with the lengths that occur in order."""

    def __init__(self, counts: dict[int, int]):
        self.counts = {length: n for length, n in counts.items() if n > 0}
        self.order = sorted(self.counts)

    def take(self, length: int, n: int) -> None:
        self.counts[length] -= n
        if not self.counts[length]:
            del self.counts[length]
            self.order.remove(length)

    def largest_within(self, room: int) -> int | None:
        at = bisect.bisect_right(self.order, room)
        return self.order[at - 1] if at else None

    def least_two(self) -> int | None:
        """Sum of the two smallest pieces."""
        if not self.order:
            return None
        if self.counts[self.order[0]] > 1:
            return 2 * self.order[0]
        return self.order[0] + self.order[1] if len(self.order) > 1 else None

    def least_three(self) -> int | None:
        smallest = list(
            chain.from_iterable([length] * min(3, self.counts[length]) for length in self.order[:3])
        )[:3]
        return sum(smallest) if len(smallest) == 3 else None

    def best_pair(self, room: int) -> int:
        """Largest sum of two pieces that fits, 0 if none does."""
        best, low, high = 0, 0, len(self.order) - 1
        while low <= high:
            both = self.order[low] + self.order[high]
            if both > room or (low == high and self.counts[self.order[low]] < 2):
                high -= 1
            else:
                best, low = max(best, both), low + 1
        return best


def reduce_by_dominance(counts: dict[int, int], capacity: int) -> tuple[list[Pattern], dict[int, int]]:
    """Fix sets that some best solution contains; returns them and what is left to pack.

    For a largest piece the set with the largest partner that fits dominates every other set if the
    partner fills the sequence, if no two other pieces fit beside it, or if no three do and no two
    that fit together are longer than the partner.  Such a set is fixed for as many pieces as there
    are, since taking pieces away only removes alternatives.  A piece beside which nothing fits is
    alone.  Passes are made until none of them fixes anything.
    """
    left, fixed, again = _Lengths(counts), [], True
    while again:
        again = False
        for length in list(reversed(left.order)):
            while left.counts.get(length):
                n, room = left.counts[length], capacity - length
                left.take(length, 1)  # look at what is there beside one such piece
                partner = left.largest_within(room)
                two, three = left.least_two(), left.least_three()
                alone = partner is None
                dominates = not alone and (
                    partner == room
                    or two is None
                    or two > room
                    or ((three is None or three > room) and left.best_pair(room) <= partner)
                )
                left.counts[length] = n
                if length not in left.order:
                    bisect.insort(left.order, length)
                if alone:
                    fixed.append(Pattern(n, ((length, 1),)))
                    left.take(length, n)
                elif not dominates:
                    break
                elif partner == length:
                    fixed.append(Pattern(n // 2, ((length, 2),)))
                    left.take(length, n // 2 * 2)
                else:
                    m = min(n, left.counts[partner])
                    fixed.append(Pattern(m, ((length, 1), (partner, 1))))
                    left.take(length, m)
                    left.take(partner, m)
                again = True
    return fixed, dict(left.counts)


def best_fit(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Best fit, longest pieces first, on whole groups of equal sequences at a time."""
    open_groups: dict[int, list[Pattern]] = {}
    rooms: list[int] = []

    def put(room: int, pattern: Pattern) -> None:
        if pattern.count:
            if room not in open_groups:
                open_groups[room] = []
                bisect.insort(rooms, room)
            open_groups[room].append(pattern)

    for length in sorted(counts, reverse=True):
        n = counts[length]
        while n:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                group = open_groups[room].pop()
                if not open_groups[room]:
                    del open_groups[room]
                    rooms.pop(at)
            else:
                room, group = capacity, Pattern(-(-n // (capacity // length)), ())
            each = room // length
            full = min(group.count, n // each)
            put(room - each * length, Pattern(full, (*group.items, (length, each))))
            n -= full * each
            rest = group.count - full
            if rest and n:
                put(room - n * length, Pattern(1, (*group.items, (length, n))))
                n, rest = 0, rest - 1
            put(room, Pattern(rest, group.items))
    return [p for groups in open_groups.values() for p in groups if p.items]


def plan(counts: dict[int, int], capacity: int) -> list[Pattern]:
    fixed, rest = reduce_by_dominance(counts, capacity)
    return fixed + best_fit(rest, capacity)


def places(patterns: list[Pattern]) -> pd.DataFrame:
    """Per length and range of numbers: first sequence, pieces per sequence, offset of the first."""
    rows, used, sequence = [], {}, 0
    for p in patterns:
        offset = 0
        for length, each in p.items:
            first = used.get(length, 0)
            rows.append((length, first, sequence, each, offset))
            used[length] = first + p.count * each
            offset += length * each
        sequence += p.count
    frame = pd.DataFrame(rows, columns=["length", "first", "sequence", "each", "offset"], dtype="int64")
    return frame.sort_values(["length", "first"], ignore_index=True)


# --- tokens --------------------------------------------------------------


def _byte_characters() -> dict[int, str]:
    """What the byte-level alphabet writes for each byte: itself if printable, else the next free character."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return {b: chr(b) if b in printable else chr(next(others)) for b in range(256)}


class Tokens:
    """Token ids by the library, word by word, with a bounded memory of words.

    The tokenizer joins nothing over a space or line break, after a letter no mark, and after a mark
    but ``'`` no letter, so a text has the ids of its words.  What stands in its special tokens is no mark.
    A word of letters is one unit of its merges and goes to the library's model directly; any other
    word goes through the whole library.
    """

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_str(definition)
        self.alphabet = _byte_characters()
        self.memory = Memory(self._learn, CACHE_WORDS, np.uint32)
        special = {c for t in self.library.get_added_tokens_decoder().values() for c in t.content}
        self.kinds = byte_kinds("".join(c for c in special if c.isascii() and kind_of(c) == MARK))
        self.begins = np.zeros((6, 6), bool)
        self.begins[:, BLANK] = self.begins[LETTER, [MARK, QUOTE]] = self.begins[MARK, LETTER] = True

    def _letters(self, words: pa.Array) -> list[list[int]]:
        """The ids of words of lower-case letters."""
        found = []
        for word in words.to_pylist():
            spelled = word if word.isascii() else word.encode().decode("latin-1").translate(self.alphabet)
            found.append([token.id for token in self.library.model.tokenize(spelled)])
        return found

    def _learn(self, new: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of new words, one after another, and the number of ids of each."""
        words = pc.utf8_ltrim(new.cast(pa.large_string()), " ")
        letters = pc.match_substring_regex(words, _LETTERS)
        stems = pc.utf8_lower(words.filter(letters)).dictionary_encode()
        others = words.filter(pc.invert(letters)).to_pylist()
        found = self._letters(stems.dictionary)
        found += [code.ids for code in self.library.encode_batch_fast(others, add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum()))
        letters = letters.to_numpy(zero_copy_only=False)
        at = np.empty(len(new), np.int64)
        at[letters] = stems.indices.to_numpy()
        at[~letters] = np.arange(len(found) - len(others), len(found))
        return spread(ids, (np.cumsum(sizes) - sizes)[at], sizes[at]), sizes[at]

    def encode_array(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and where each text's begin and end."""
        data, bounds = after_spaces(texts)
        data[data == ord("\n")] = ord(" ")
        starts = word_starts(data, bounds, self.kinds, self.begins) if len(data) else bounds[:0]
        return self.memory.of_texts(data, starts, bounds)

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        ids, bounds = self.encode_array(pa.array(texts, pa.large_string()))
        return [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:])]


_tokens: dict[str, Tokens] = {}


def tokens(definition: str) -> Tokens:
    """The tokenizer of a worker; it outlives a task, and so do the words that it knows."""
    if definition not in _tokens:
        _tokens.clear()
        _tokens[definition] = Tokens(definition)
    return _tokens[definition]


PIECE = "piece int, start long, length long, ids_crc32 long"


def token_pieces(
    df: DataFrame, text: str, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = 0, with_ids: bool = False
) -> DataFrame:
    """Per piece of a document: the columns of ``df`` but the text, its place there and a checksum.

    A document is its ids and then ``end_id``; a longer one than ``capacity`` is cut there, so only its
    last piece may be shorter.  A NULL or empty text is ``end_id`` alone.  With ``with_ids`` the ids
    themselves follow in ``ids``.  Repeated rows are documents each, and an empty table gives no pieces.
    Columns of ``df`` that are called like a result, in upper or lower case, are replaced; all others
    keep name, order and value.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        definition = file.read()
    fields = [part.split()[0] for part in PIECE.split(", ")] + (["ids"] if with_ids else [])
    kept, text_col = other_columns(df, text, *fields), free_name(df, "_text")
    given = df.select(*[F.col(f"`{c}`") for c in kept], F.col(text).cast("string").alias(text_col))
    schema = given.select(
        *[F.col(f"`{c}`") for c in kept], F.lit(0).alias("piece"), *[F.lit(0).cast("long").alias(c) for c in fields[1:4]],
        *([F.lit(None).cast("array<int>").alias("ids")] if with_ids else []),
    ).schema

    def run(batches):
        own = tokens(definition)
        for batch in batches:
            for part in slices(batch, text_col):
                ids, bounds = own.encode_array(part.column(text_col))
                # every document's end
                ids = np.insert(ids, bounds[1:], end_id).astype("<u4")
                bounds = bounds + np.arange(len(bounds))
                sizes = np.diff(bounds)
                pieces = -(-sizes // capacity)
                row = np.repeat(np.arange(len(sizes)), pieces)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * capacity
                length = np.minimum(sizes[row] - start, capacity)
                begins = bounds[row] + start
                whole = memoryview(ids).cast("B")
                sums = [zlib.crc32(whole[4 * a : 4 * (a + n)]) for a, n in zip(begins.tolist(), length.tolist())]
                carried = part.take(pa.array(row)).columns[: len(kept)]
                arrays = [*carried, pa.array(piece, pa.int32())]
                arrays += [pa.array(x, pa.int64()) for x in (start, length, sums)]
                if with_ids:
                    ends = pa.array(np.append(begins, len(ids)), pa.int32())
                    arrays.append(pa.ListArray.from_arrays(ends, pa.array(ids.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(arrays, [*kept, *fields])

    return given.mapInArrow(run, schema)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """All columns of ``pieces`` with ``sequence_id`` and ``offset``.

    Of the pieces only the number per length (1 to ``capacity``) comes to the driver, and only the plan
    made from it goes back; both are bounded by ``capacity``.  ``length`` must not be NULL; NULLs in
    other columns are carried.  Repeated rows are pieces each, and an empty table gives an empty result.
    Columns called like a result are replaced; all others keep name, order and value.
    """
    row, number_col = free_name(pieces, "_piece_row"), free_name(pieces, "_number")
    pieces = pieces.drop("sequence_id", "offset")
    numbered = stored(pieces.withColumn(row, F.monotonically_increasing_id()), "pieces")
    counts = {r[0]: r[1] for r in numbered.groupBy("length").count().collect()}
    table = places(plan(counts, capacity))
    keys = (table["length"].to_numpy() << 40) + table["first"].to_numpy()
    first, sequence, each, offset = (table[c].to_numpy() for c in ("first", "sequence", "each", "offset"))
    bucket_rows = 2_000 if "ids" in pieces.columns else 50_000  # some 16 MB of ids, or of plain rows
    names = list(pieces.columns)
    ranked = gapless_numbers(numbered, ["length"], [row], number_col, bucket_rows)
    ranked = ranked.select(*[F.col(f"`{c}`") for c in names], number_col)
    width, at_length, at_number = len(ranked.columns), names.index("length"), len(names)

    def place(batches):
        for batch in batches:
            length, number = batch.column(at_length).to_numpy(), batch.column(at_number).to_numpy()
            at = np.searchsorted(keys, (length << 40) + number, side="right") - 1
            beyond, place_there = np.divmod(number - first[at], each[at])
            found = [pa.array(sequence[at] + beyond), pa.array(offset[at] + place_there * length)]
            kept = [batch.column(i) for i in range(width) if i != at_number]
            yield pa.RecordBatch.from_arrays([*kept, *found], [*names, "sequence_id", "offset"])

    schema = ranked.drop(number_col).select(
        "*", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    ).schema
    return ranked.mapInArrow(place, schema)
