"""SentencePiece encoding (byte-pair models) by vectorised merge rounds, and decoding.

Texts are cut where no piece of the model goes on: into words, marks and line breaks.  New words of many
documents are put into one flat array of symbols.  In each round the least rank of the pairs of every word
is found by a segmented minimum, all words merge their leftmost pairs of that rank at once, and words
without a pair are taken out.  Ids of words seen before come from a bounded memory.  Ids are those of the
library; decoding is the library's.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import free_name, other_columns
from marketloom.llm.tokens import (
    BLANK,
    BREAK,
    LETTER,
    MARK,
    QUOTE,
    Memory,
    after_spaces,
    buffers,
    byte_kinds,
    kind_of,
    slices,
    word_starts,
)

SPACE = "▁"  # stands for a space in pieces
NONE = np.int32((1 << 31) - 1)  # rank of a pair that cannot be merged
CACHE_WORDS = 400_000  # words that a worker remembers; beyond them it keeps those of the present texts
LEARNT_WORDS = 16_384  # new words that are merged together: their arrays stay in the processor's cache
LONG_WORD = 2048  # longer words are merged one pair at a time; each round would walk all of them
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class Vocabulary:
    """Pieces, merge ranks and fallback ids of a byte-pair model."""

    def __init__(self, model: bytes):
        self.library = sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = sp.get_piece_size()
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i) for i in range(size)]
        pieces = {sp.id_to_piece(i): i for i in range(size) if not special[i]}
        self.size, self.unknown = size, sp.unk_id()
        self.bytes = {int(sp.id_to_piece(i)[3:5], 16): i for i in range(size) if sp.is_byte(i)}
        # where words may be cut: no piece goes on over it
        joined = "".join(pieces)
        self.cuts_lines = "\n" not in joined
        self.cuts_words = not any(b == SPACE and a != SPACE for p in pieces for a, b in zip(p, p[1:]))
        self.cuts_marks = not any(
            (kind_of(a) == LETTER and kind_of(b) in (MARK, QUOTE)) or (kind_of(a) in (MARK, QUOTE) and kind_of(b) == LETTER)
            for p in pieces for a, b in zip(p, p[1:])
        )
        numbers = dict(pieces)
        for c in sorted(set(joined)):
            numbers.setdefault(c, len(numbers) + size)
        self.width = max(numbers.values()) + 1
        self.of_char = np.full(0x110000, -1, np.int32)
        for p, i in numbers.items():
            if len(p) == 1:
                self.of_char[ord(p)] = i
        scores = np.array([-sp.get_score(i) for i in range(size)])
        rank = np.unique(scores, return_inverse=True)[1]
        keys, merged = [], []
        for p, i in pieces.items():
            for cut in range(1, len(p)):
                left, right = numbers.get(p[:cut]), numbers.get(p[cut:])
                if left is not None and right is not None:
                    keys.append(left * self.width + right)
                    merged.append(i)
        self.keys, self.merged = np.array(keys, np.int64), np.array(merged, np.int32)
        self.ranks = rank[self.merged].astype(np.int32)
        self._hash()

    def _hash(self) -> None:
        """A table of the pairs, at most an eighth full; a pair whose place is taken goes to the next free one."""
        bits = max(len(self.keys), 2).bit_length() + 3
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.slot_keys = np.full(1 << bits, -1, np.int64)
        self.slot_pairs = np.zeros(1 << bits, np.int32)
        left, at = np.arange(len(self.keys)), self._place(self.keys)
        while len(left):
            free = self.slot_keys[at] < 0
            _, first = np.unique(np.where(free, at, -1), return_index=True)
            first = first[free[first]]
            self.slot_keys[at[first]] = self.keys[left[first]]
            self.slot_pairs[at[first]] = left[first]
            rest = np.ones(len(left), bool)
            rest[first] = False
            left, at = left[rest], (at[rest] + 1) & self.mask

    def _place(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * _MULTIPLIER) >> self.shift).astype(np.int64)

    def pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged piece of each pair."""
        key = left.astype(np.int64) * self.width + right
        key[(left < 0) | (right < 0)] = -2
        at = self._place(key)
        there = self.slot_keys[at]
        found = there == key
        rank = np.where(found, self.ranks[self.slot_pairs[at]], NONE)
        piece = np.where(found, self.merged[self.slot_pairs[at]], np.int32(-1))
        # places taken by another pair: look at the next ones
        open_at = np.flatnonzero(~found & (there >= 0))
        at, key = at[open_at], key[open_at]
        while len(open_at):
            at = (at + 1) & self.mask
            there = self.slot_keys[at]
            found = there == key
            hit = open_at[found]
            rank[hit], piece[hit] = self.ranks[self.slot_pairs[at[found]]], self.merged[self.slot_pairs[at[found]]]
            on = ~found & (there >= 0)
            open_at, at, key = open_at[on], at[on], key[on]
        return rank, piece

    def fallback(self, char: str) -> list[int]:
        data = char.encode()
        return [self.bytes[b] for b in data] if len(self.bytes) == 256 else [self.unknown]


def _merge_one_by_one(vocabulary: Vocabulary, symbols: list[int], at: list[int]) -> tuple[list[int], list[int]]:
    """Merge the pair of least rank, leftmost first, until none is left; for very long words."""
    table = dict(zip(vocabulary.keys.tolist(), zip(vocabulary.ranks.tolist(), vocabulary.merged.tolist())))
    n, width = len(symbols), vocabulary.width
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    agenda: list[tuple[int, int, int, int]] = []

    def propose(i: int) -> None:
        j = after[i]
        if j < n and symbols[i] >= 0 and symbols[j] >= 0:
            hit = table.get(symbols[i] * width + symbols[j])
            if hit:
                heapq.heappush(agenda, (hit[0], i, symbols[i], symbols[j]))

    for i in range(n - 1):
        propose(i)
    gone = bytearray(n)
    while agenda:
        _, i, left, right = heapq.heappop(agenda)
        j = after[i]
        if gone[i] or j >= n or symbols[i] != left or symbols[j] != right:
            continue
        symbols[i] = table[left * width + right][1]
        gone[j] = 1
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
        propose(i)
        if before[i] >= 0:
            propose(before[i])
    kept = [i for i in range(n) if not gone[i]]
    return [symbols[i] for i in kept], [at[i] for i in kept]


def merge_rounds(vocabulary: Vocabulary, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge all words at once; ``symbols`` holds them one after another, ``sizes`` their lengths.

    Returns the remaining symbols and, for each, where its first character stands in ``symbols``.
    """
    at = np.arange(len(symbols), dtype=np.int32)
    sizes = sizes[sizes > 0]
    word = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    done_symbols, done_at = [], []

    def pair_of(i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        j = np.minimum(i + 1, len(symbols) - 1)
        rank, piece = vocabulary.pairs(symbols[i], symbols[j])
        inside = (i + 1 < len(symbols)) & (word[i] == word[j])
        return np.where(inside, rank, NONE), piece

    rank, piece = pair_of(np.arange(len(symbols))) if len(symbols) else (symbols, symbols)
    while len(symbols):
        starts = np.nonzero(np.diff(word, prepend=-1))[0]
        sizes = np.diff(np.append(starts, len(symbols)))
        least = np.repeat(np.minimum.reduceat(rank, starts), sizes)
        live = least < NONE
        if not live.all():
            done_symbols.append(symbols[~live])
            done_at.append(at[~live])
            symbols, at, word, rank, piece, least = (x[live] for x in (symbols, at, word, rank, piece, least))
            if not len(symbols):
                break
        index = np.arange(len(symbols))
        wanted = rank == least
        # overlapping pairs stand in a row: every other one counts, from the left
        run = np.maximum.accumulate(np.where(wanted & ~np.append(False, wanted[:-1]), index, 0))
        chosen = index[wanted & ((index - run) % 2 == 0)]
        first = np.diff(word[chosen], prepend=-1) != 0
        if not first.all():
            # a later pair waits if an earlier merge of its word makes a pair that comes before it
            new = piece[chosen]
            previous = np.maximum(chosen - 1, 0)
            merged_before = np.append(False, chosen[1:] - chosen[:-1] == 2)
            left = np.where(merged_before, np.append(-1, new[:-1]), symbols[previous])
            left = np.where((chosen > 0) & (word[previous] == word[chosen]), left, -1)
            following = np.minimum(chosen + 2, len(symbols) - 1)
            right = np.where((chosen + 2 < len(symbols)) & (word[following] == word[chosen]), symbols[following], -1)
            best = np.minimum(vocabulary.pairs(left, new)[0], vocabulary.pairs(new, right)[0])
            unsafe = best <= rank[chosen]
            if unsafe.any():
                waits = np.isin(word[chosen], word[chosen[unsafe]])
                chosen = chosen[first | ~waits]
        symbols = symbols.copy()
        symbols[chosen] = piece[chosen]
        keep = np.ones(len(symbols), bool)
        keep[chosen + 1] = False
        place = np.cumsum(keep) - 1
        symbols, at, word, rank, piece = (x[keep] for x in (symbols, at, word, rank, piece))
        changed = place[chosen]
        touched = np.zeros(len(symbols), bool)
        touched[changed] = touched[np.maximum(changed - 1, 0)] = True
        changed = np.nonzero(touched)[0]
        rank[changed], piece[changed] = pair_of(changed)
    if not done_symbols:
        return symbols, at
    all_symbols, all_at = np.concatenate(done_symbols), np.concatenate(done_at)
    order = np.argsort(all_at, kind="stable")
    return all_symbols[order], all_at[order]


class Encoder:
    """Ids of whole texts, with a bounded memory of words."""

    def __init__(self, model: bytes):
        self.vocabulary = vocabulary = Vocabulary(model)
        self.memory = Memory(self._learn, CACHE_WORDS, np.int32)
        # a word begins between two kinds of characters over which no piece goes on
        self.kinds, self.begins = byte_kinds(), np.zeros((6, 6), bool)
        self.begins[BREAK], self.begins[:, BREAK], self.begins[:BLANK, BLANK] = True, True, True
        for mark in (MARK, QUOTE):
            self.begins[LETTER, mark] = self.begins[mark, LETTER] = vocabulary.cuts_marks

    @property
    def known(self) -> dict[bytes, int]:
        return self.memory.known

    def _starts(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Where words begin.  Spaces belong to the word that follows them, a line break is a word."""
        if not len(data) or not (self.vocabulary.cuts_words and self.vocabulary.cuts_lines):
            return np.unique(bounds[:-1][np.diff(bounds) > 0])
        return word_starts(data, bounds, self.kinds, self.begins)

    def _learn(self, new: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of new words, one after another, and the number of ids of each."""
        found = [self._learn_some(new.slice(i, LEARNT_WORDS)) for i in range(0, len(new), LEARNT_WORDS)]
        return np.concatenate([ids for ids, _ in found]), np.concatenate([sizes for _, sizes in found])

    def _learn_some(self, new: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        vocabulary = self.vocabulary
        data, bounds = buffers(new)
        # continuation bytes of UTF-8 begin no character
        characters = np.append(0, np.cumsum((data & 0xC0) != 0x80))
        codes = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        codes = np.where(codes == ord(" "), ord(SPACE), codes)
        cuts = characters[bounds]
        begins, sizes = cuts[:-1], np.diff(cuts)
        symbols = vocabulary.of_char[codes]
        long = sizes > LONG_WORD
        usual = np.repeat(~long, sizes)
        merged, at = merge_rounds(vocabulary, symbols[usual], sizes[~long])
        if long.any():
            at = np.flatnonzero(usual)[at]
            for k in np.flatnonzero(long).tolist():
                span = range(begins[k], begins[k] + sizes[k])
                more, more_at = _merge_one_by_one(vocabulary, symbols[span.start : span.stop].tolist(), list(span))
                merged, at = np.append(merged, more), np.append(at, more_at)
            order = np.argsort(at, kind="stable")
            merged, at = merged[order], at[order]
        odd = np.flatnonzero((merged < 0) | (merged >= vocabulary.size))
        parts = np.ones(len(merged), np.int64)
        if len(odd):
            chars, which = np.unique(codes[at[odd]], return_inverse=True)
            instead = [vocabulary.fallback(chr(c)) for c in chars.tolist()]
            parts[odd] = np.array([len(x) for x in instead])[which]
            flat = np.repeat(merged, parts)
            first = (np.cumsum(parts) - parts)[odd]
            for k in range(max(map(len, instead))):
                ids = np.array([x[k] if k < len(x) else -1 for x in instead])[which]
                flat[(first + k)[ids >= 0]] = ids[ids >= 0]
            merged = flat
        ends = np.append(0, np.cumsum(parts))[np.searchsorted(at, cuts)]
        return merged, np.diff(ends)

    def encode_array(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and where each text's begin and end."""
        data, bounds = after_spaces(pc.replace_substring(texts.cast(pa.large_string()), SPACE, " "))
        return self.memory.of_texts(data, self._starts(data, bounds), bounds)

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        ids, bounds = self.encode_array(pa.array(texts, pa.large_string()))
        return [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        decode = self.vocabulary.library.decode
        return [decode(ids[a:b].tolist()) if b > a else "" for a, b in zip(bounds[:-1], bounds[1:])]


_encoders: dict[bytes, Encoder] = {}


def encoder(model: bytes) -> Encoder:
    """The encoder of a worker; it outlives a task, and so do the words that it knows."""
    if model not in _encoders:
        _encoders.clear()
        _encoders[model] = Encoder(model)
    return _encoders[model]


def encode(df: DataFrame, text: str, model_path: str, ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """All columns but the text, the ids of the whole text and, if named, what they decode to.

    The model file is read on the driver and sent along.  A NULL or empty text has no ids and decodes
    to an empty text; texts may be of any length.  No begin or end ids are added, nothing is sampled.
    Repeated rows are treated alike, and an empty table gives an empty result.  Columns of ``df`` that
    are called like a result, in upper or lower case, are replaced; all others keep name, order and value.
    """
    with open(model_path, "rb") as file:
        model = file.read()
    results = [ids] + ([decoded] if decoded else [])
    kept, text_col = other_columns(df, text, *results), free_name(df, "_text")
    given = df.select(*[F.col(f"`{c}`") for c in kept], F.col(text).cast("string").alias(text_col))
    schema = given.select(*[F.col(f"`{c}`") for c in kept]).withColumn(ids, F.lit(None).cast("array<int>"))
    if decoded:
        schema = schema.withColumn(decoded, F.lit("").cast("string"))

    def run(batches):
        own = encoder(model)
        for batch in batches:
            for part in slices(batch, text_col):
                found, bounds = own.encode_array(part.column(text_col))
                arrays = [*part.columns[: len(kept)], pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(found))]
                if decoded:
                    arrays.append(pa.array(own.decode(found, bounds), pa.string()))
                yield pa.RecordBatch.from_arrays(arrays, [*kept, *results])

    return given.mapInArrow(run, schema.schema)
