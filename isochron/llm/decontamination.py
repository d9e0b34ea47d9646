"""Documents that hold benchmark items, also in changed form: CGK embeddings, bit-sampling LSH, exact edit distances.

Items and documents are sequences of words (lower case, letters and digits only; other signs are dropped). In scripts
that are written without spaces (Chinese, Japanese, Thai, ..) each letter with its marks is a word. An item of n words is
in a document if a stretch of it is at most ``floor(rate * n)`` word edits away from the item.

1. *Where to look.* An item cut into one piece more than the edits allowed keeps a piece whole, so a match contains one
   of the pieces exactly. Each occurrence of a piece names the start of an item-sized window. This loses no match. An
   item that allows no edit is one piece, and needs no further step.
2. *CGK.* A random walk turns a window into a string of three times its length, repeating or advancing by a bit drawn
   from (table, place, word). Windows that are few edits apart soon walk together again, so their strings agree in many
   places.
3. *LSH.* Each table samples ``SAMPLED`` places of its embedding; windows are looked up among the items of their
   length. Tables are added until ``recall`` of trial items, edited at random as far as is allowed, are found.
4. *Verification.* The least edit distance between the item and any stretch around the window is computed exactly.

Nothing is shuffled. Items are collected in blocks of some ``BLOCK`` characters, whatever the size of the benchmark, and
each block is held against all documents.

Defined results: items with fewer than ``least_words`` words (the registered query and the pipeline ask for 1, so that
every item with a word counts), or without text, match nothing; equal items (id and text)
count once; an item without an id counts, with a null ``item_id``, unless its text also stands under an id; a null text holds nothing; rows that share an id are documents of their own; an empty table gives an empty
one; other columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isochron.llm.common import gram_hashes, mix, stored, tidy, words
from isochron.llm.repeats import slices

SAMPLED = 3
MOST_TABLES = 64
"""Where these do not reach the recall asked for, every window that a piece names is verified instead."""
BLOCK = 1 << 24
SLICE = 1 << 22
MEMO = 120_000
STRETCH = 3
MARKS = 20
SIGNS = re.compile(r"[\W_]+")
SCRIPTS = [  # written without spaces
    (0x0E00, 0x0FFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19FF), (0x1A20, 0x1AAF), (0x1B00, 0x1B7F),
    (0x3005, 0x3007), (0x3021, 0x3029), (0x3041, 0x312F), (0x31A0, 0x31BF), (0x31F0, 0x31FF), (0x3400, 0x4DBF),
    (0x4E00, 0xA4CF), (0xA980, 0xA9FF), (0xAA60, 0xAADF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x1AFF0, 0x1B16F),
    (0x20000, 0x3FFFF),
]
BLOCKS = "".join(f"{chr(a)}-{chr(b)}" for a, b in SCRIPTS)
VOWELS = "".join(chr(c) for a, b in SCRIPTS if b < 0x20000 for c in range(a, b + 1) if unicodedata.category(chr(c))[0] == "M")
UNSPACED = re.compile(f"[{BLOCKS}]")
LETTER = re.compile(f"[{BLOCKS}][{VOWELS}]*|[^{BLOCKS}]+")
SPLIT = 2
"""In place of the hash of a word that holds several; hashes are odd."""


class WordNames(dict):
    """Hash of the letters and digits of each word, 0 where it has none; the first ``MEMO`` words met are kept."""

    def __missing__(self, word: str) -> int:
        if not word.isascii() and UNSPACED.search(word):
            return SPLIT
        plain = SIGNS.sub("", word.lower())
        name = xxhash.xxh3_64_intdigest(plain) | 1 if plain else 0
        if len(self) < MEMO:
            self[word] = name
        return name


class LetterNames(dict):
    """Hash of each letter with its marks, or of each word between such letters."""

    def __missing__(self, letter: str) -> int:
        if not UNSPACED.match(letter):
            return NAMES[letter]
        name = xxhash.xxh3_64_intdigest(letter) | 1 if letter[0].isalnum() else 0
        if len(self) < MEMO:
            self[letter] = name
        return name


NAMES = WordNames()
LETTERS = LetterNames()


def split_words(distinct: list[str], hashes: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the occurrences ``codes`` of words, of which some hold several, and where each occurrence's begin."""
    split = np.flatnonzero(hashes == SPLIT).tolist()
    held = [np.array([LETTERS[x] for x in LETTER.findall(distinct[k].lower())], np.uint64) for k in split]
    size = np.ones(len(distinct), np.int64)
    size[split] = [len(x) for x in held]
    first = np.cumsum(size) - size
    pool = np.repeat(hashes, size)
    for k, x in zip(split, held, strict=True):
        pool[first[k] : first[k] + len(x)] = x
    many = size[codes]
    bounds = np.concatenate([[0], np.cumsum(many)])
    return pool[np.arange(bounds[-1]) + np.repeat(first[codes] - bounds[:-1], many)], bounds


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of each text, end to end, and where each text's begin."""
    bounds, codes, distinct = words(texts)
    distinct = distinct.to_pylist()
    hashes = np.fromiter(map(NAMES.__getitem__, distinct), np.uint64, len(distinct))
    if (hashes == SPLIT).any():
        hashes, begin = split_words(distinct, hashes, codes)
        bounds = begin[bounds]
    else:
        hashes = hashes[codes]
    full = hashes != 0  # 0 stands for the end of a text
    return hashes[full], np.concatenate([[0], np.cumsum(full)])[bounds]


def walk(windows: np.ndarray, sizes: np.ndarray, table: int, upto: int) -> np.ndarray:
    """The first ``upto`` symbols of each window's embedding, by step; windows are filled up with zeros."""
    rows, at = np.arange(len(windows)), np.zeros(len(windows), np.int64)
    padded = np.concatenate([windows, np.zeros((len(windows), 1), np.uint64)], axis=1)
    chance = mix(np.arange(upto, dtype=np.uint64) + np.uint64(table * 100_003 + 1))
    out = np.empty((upto, len(windows)), np.uint64)
    for j in range(upto):
        out[j] = padded[rows, at]
        at = np.minimum(at + (mix(out[j] ^ chance[j]) >> np.uint64(63)).astype(np.int64), sizes)
    return out


def places(table: int, n: int) -> np.ndarray:
    """The places of an embedding that a table samples, for windows of n words."""
    return np.sort(np.random.default_rng((table, n)).choice(STRETCH * n, min(SAMPLED, STRETCH * n), replace=False))


def signatures(windows: np.ndarray, sizes: np.ndarray, table: int) -> np.ndarray:
    """What a table holds of each window, and of its size."""
    kinds, of = np.unique(sizes, return_inverse=True)
    sampled = np.array([places(table, n) for n in kinds.tolist()]).reshape(len(kinds), -1)[of]
    symbols = walk(windows, sizes, table, int(sampled.max()) + 1) if len(windows) else np.empty((0, 0), np.uint64)
    total = sizes.astype(np.uint64)
    with np.errstate(over="ignore"):
        for k in range(sampled.shape[1] if len(windows) else 0):
            total = mix(total * np.uint64(31) + symbols[sampled[:, k], np.arange(len(windows))])
    return total


def nearest(item: np.ndarray, stretch: np.ndarray) -> tuple[int, int]:
    """Least edit distance between the item and any part of the stretch, and where the first such part ends."""
    n = len(stretch)
    steps = np.arange(n + 1)
    row = np.zeros(n + 1, np.int64)
    for i, word in enumerate(item):
        best = np.empty(n + 1, np.int64)
        best[0] = i + 1
        best[1:] = np.minimum(row[:-1] + (stretch != word), row[1:] + 1)
        row = np.minimum.accumulate(best - steps) + steps
    end = int(row.argmin())
    return int(row[end]), end


def occurrences(numbers: np.ndarray, bounds: np.ndarray, pieces: dict[int, tuple[np.ndarray, ...]]):
    """``size, row, at, item, offset`` of the places in the rows where pieces of each size stand, in order of place."""
    row_of = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    for size, (marked, name, item, offset) in pieces.items():
        grams = gram_hashes(numbers, size)
        at = np.flatnonzero(marked[(grams & np.uint64((1 << MARKS) - 1)).astype(np.int64)])
        lo, hi = np.searchsorted(name, grams[at], "left"), np.searchsorted(name, grams[at], "right")
        at, lo, many = at[hi > lo], lo[hi > lo], (hi - lo)[hi > lo]
        piece = np.repeat(lo, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        at = np.repeat(at, many)
        row = row_of[at]
        inside = at + size <= bounds[row + 1]
        row, at, piece = row[inside], at[inside], piece[inside]
        yield size, row, at, item[piece], offset[piece]


class Items:
    """A block of items with their pieces and tables."""

    def __init__(self, rows: list[tuple[int | None, str]], rate: float, recall: float, least_words: int):
        rows = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        hashes, bounds = word_hashes(pa.array([t for _, t in rows], pa.large_string()))
        kept = [k for k in range(len(rows)) if bounds[k + 1] - bounds[k] >= max(least_words, 1)]
        kept.sort(key=lambda k: int(rate * (bounds[k + 1] - bounds[k])) == 0)
        self.ids = [rows[k][0] for k in kept]
        self.words = [hashes[bounds[k] : bounds[k + 1]] for k in kept]
        self.edits = [int(rate * len(w)) for w in self.words]
        self.lengths = np.array([len(w) for w in self.words], np.int64)
        self.near = sum(d > 0 for d in self.edits)  # those after them match as they are or not at all
        pieces: dict[bool, dict[int, list[tuple[int, int, int]]]] = {True: {}, False: {}}
        for i, (w, d) in enumerate(zip(self.words, self.edits, strict=True)):
            size = len(w) // (d + 1)
            grams = gram_hashes(w, size)
            for k in range(d + 1):
                pieces[d > 0].setdefault(size, []).append((int(grams[k * size]), i, k * size))
        self.pieces, self.wholes = self.by_size(pieces[True]), self.by_size(pieces[False])
        longest = int(self.lengths[: self.near].max()) if self.near else 0
        self.block = np.zeros((self.near, longest), np.uint64)
        for i, w in enumerate(self.words[: self.near]):
            self.block[i, : len(w)] = w
        self.tables = self.enough(recall) if self.near else 0
        self.listed = []
        for t in range(self.tables or 0):
            found = signatures(self.block, self.lengths[: self.near], t)
            order = np.argsort(found)
            self.listed.append((found[order], order))

    @staticmethod
    def by_size(pieces: dict[int, list[tuple[int, int, int]]]) -> dict[int, tuple[np.ndarray, ...]]:
        """Pieces in the order of their hashes, with marks of the hashes there are."""
        sorted_pieces = {}
        for size, found in pieces.items():
            found.sort()
            name, item, offset = (np.array(x, t) for x, t in zip(zip(*found, strict=True), (np.uint64, np.int64, np.int64), strict=True))
            marked = np.zeros(1 << MARKS, bool)
            marked[(name & np.uint64((1 << MARKS) - 1)).astype(np.int64)] = True
            sorted_pieces[size] = (marked, name, item, offset)
        return sorted_pieces

    def enough(self, recall: float, trials: int = 400, seed: int = 5) -> int | None:
        """Tables that find the wanted share of items with as many random edits as are allowed; None if they are too many."""
        rng = np.random.default_rng(seed)
        missed = []
        for _ in range(trials):
            i = int(rng.integers(self.near))
            copy = self.words[i].tolist()
            for _ in range(self.edits[i]):
                at, kind = int(rng.integers(len(copy))), int(rng.integers(3))
                copy[at : at + (kind != 0)] = [] if kind == 2 else [int(rng.integers(1 << 62)) | 1]
            text = [int(x) | 1 for x in rng.integers(1 << 62, size=60)]
            text[30:30] = copy
            missed.append((i, np.array(text, np.uint64)))
        trial, item, windows = [], [], []
        for k, (i, text) in enumerate(missed):
            bounds = np.array([0, len(text)])
            found = self.starts(text, bounds)
            own = found[found[:, 2] == self.lengths[i]]
            windows.append(self.cut(text, bounds, own[:, 0], own[:, 1], own[:, 2]))
            trial += [k] * len(own)
            item += [i] * len(own)
        trial, item, windows = np.array(trial), np.array(item, np.int64), np.concatenate(windows)
        hit = np.zeros(trials, bool)
        for t in range(MOST_TABLES):
            if hit.mean() >= recall:
                return t
            same = signatures(windows, self.lengths[item], t) == signatures(self.block, self.lengths[: self.near], t)[item]
            hit[trial[same]] = True
        return MOST_TABLES if hit.mean() >= recall else None

    def starts(self, numbers: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Distinct (row, window start, length) that a piece of an item names."""
        found = [
            np.stack([row, at - offset, self.lengths[item]], axis=1)
            for _, row, at, item, offset in occurrences(numbers, bounds, self.pieces)
        ]
        return np.unique(np.concatenate(found), axis=0) if found else np.empty((0, 3), np.int64)

    def named(self, numbers: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Distinct (row, window start, item) that a piece of the item names: without errors, no item is missed."""
        for _, row, at, item, offset in occurrences(numbers, bounds, self.pieces):
            yield from map(tuple, np.unique(np.stack([row, at - offset, item], axis=1), axis=0).tolist())

    def cut(self, numbers, bounds, row, start, size) -> np.ndarray:
        """Windows, filled up with zeros; what lies outside the document is 0, too."""
        step = np.arange(self.block.shape[1])
        at = start[:, None] + step
        outside = (at < bounds[row][:, None]) | (at >= bounds[row + 1][:, None]) | (step >= size[:, None])
        out = numbers[np.clip(at, 0, max(0, len(numbers) - 1))]
        out[outside] = 0
        return out

    def matches(self, numbers: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(row, item, distance, first word, end) of items that the rows hold; the nearest place of each."""
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for size, row, at, item, _ in occurrences(numbers, bounds, self.wholes):
            pairs, first = np.unique(np.stack([row, item], axis=1), axis=0, return_index=True)
            start = at[first] - bounds[pairs[:, 0]]
            best.update({(r, i): (0, a, a + size) for (r, i), a in zip(pairs.tolist(), start.tolist(), strict=True)})
        if self.tables is None:
            for row, start, i in sorted(set(self.named(numbers, bounds))):
                self.verify(numbers, bounds, row, start, i, best)
        found = self.starts(numbers, bounds) if self.tables else np.empty((0, 3), np.int64)
        for part in range(0, len(found), 4096):
            row, start, size = found[part : part + 4096].T
            windows = self.cut(numbers, bounds, row, start, size)
            pairs = set()
            for t, (listed, items) in enumerate(self.listed):
                name = signatures(windows, size, t)
                lo, hi = np.searchsorted(listed, name, "left"), np.searchsorted(listed, name, "right")
                for k in np.flatnonzero(hi > lo).tolist():
                    pairs.update((k, int(items[x])) for x in range(lo[k], hi[k]))
            for k, i in sorted(pairs):
                self.verify(numbers, bounds, int(row[k]), int(start[k]), i, best)
        return [(row, i, *found) for (row, i), found in sorted(best.items())]

    def verify(self, numbers, bounds, row: int, start: int, i: int, best: dict) -> None:
        item, most = self.words[i], self.edits[i]
        a = max(int(bounds[row]), start - 2 * most)
        b = min(int(bounds[row + 1]), start + len(item) + 2 * most)
        distance, end = nearest(item, numbers[a:b])
        if distance <= most and distance < best.get((row, i), (most + 1,))[0]:
            _, back = nearest(item[::-1], numbers[a : a + end][::-1])
            first = int(bounds[row])
            best[row, i] = (distance, a + end - back - first, a + end - first)


def item_blocks(benchmark: DataFrame, rate: float, recall: float, least_words: int, item_col: str, text_col: str):
    """The items in blocks of bounded size, each with its tables."""
    items = benchmark.select(F.col(item_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    items = items.where("text IS NOT NULL")
    named = items.where("id IS NOT NULL").select("text").distinct()
    unnamed = items.where("id IS NULL").distinct().join(named, "text", "left_anti")
    items = stored(items.where("id IS NOT NULL").distinct().unionByName(unnamed), "items")
    size = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = -(-int(size) // BLOCK) or 1
    for k in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == k).collect()
        yield Items([(r.id, r.text) for r in rows], rate, recall, least_words)


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    rate: float = 0.2,
    recall: float = 0.999,
    least_words: int = 8,
    id_col="doc_id",
    text_col="text",
    item_col="item_id",
    item_text_col="text",
) -> DataFrame:
    """``doc_id, item_id, distance, first_word, end_word`` of every item that a document holds."""
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    given = given.where(F.col("text").isNotNull())
    schema = "doc_id long, item_id long, distance int, first_word int, end_word int"
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = [pa.int64()] * 2 + [pa.int32()] * 3

    def search(block: Items):
        @tidy
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in slices(batches, SLICE):
                found = block.matches(*word_hashes(part["text"]))
                doc = part["doc_id"].to_pylist()
                rows = [(doc[r], block.ids[i], d, a, b) for r, i, d, a, b in found]
                columns = list(zip(*rows, strict=True)) or [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

        return run

    # block by block, so that the plan holds the tables of one block only; what is found is little
    blocks = item_blocks(benchmark, rate, recall, least_words, item_col, item_text_col)
    return reduce(DataFrame.unionByName, (stored(given.mapInArrow(search(block), schema), "found") for block in blocks))


def without_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    rate: float = 0.2,
    recall: float = 0.999,
    least_words: int = 8,
    text_col="text",
    item_col="item_id",
    item_text_col="text",
) -> DataFrame:
    """Rows of ``docs`` that hold no item, with all their columns, in passes without a shuffle."""

    def keep(block: Items):
        @tidy
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in slices(batches, SLICE, text_col):
                clean = np.ones(part.num_rows, bool)
                clean[[r for r, *_ in block.matches(*word_hashes(part[text_col].fill_null("")))]] = False
                yield part.filter(pa.array(clean))

        return run

    for block in item_blocks(benchmark, rate, recall, least_words, item_col, item_text_col):
        docs = docs.mapInArrow(keep(block), docs.schema)
    return docs
