"""Passages of words that an earlier document holds, found with suffix automata of reference shards.

A window is ``WINDOW`` consecutive words. Each word covered by a window that also starts in a document with a smaller
id is removed; windows are judged on the input. The reference of a document is all documents before it, which no single
automaton can hold, so it is cut into shards by the key of the windows' anchors (see ``repeats``): windows that can be
equal are in one shard, and only text around the edges of repeated passages is in any. The automaton of a shard grows
from the passages of earlier documents, and those of each later document are streamed through it: its matching
statistics, the length of the longest match that ends at each word, give the maximal spans of ``WINDOW`` words or more.

Defined results: words are ``[^\\x20\\x09-\\x0D]+``; a null text has none; documents with fewer than ``WINDOW`` words
keep them all; rows with one id are no reference for each other; a row without id comes after all others; an empty
table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isochron.llm.common import hash_words, keyed, tidy, words
from isochron.llm.repeats import GROUP, Sampling, merged, repeated_spans, slices

WINDOW = 13
SAMPLING = Sampling(WINDOW, span=10, gram=1)


class SuffixAutomaton:
    """All substrings of the sequences added."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]

    def state(self, length: int, link: int, follow: dict[int, int]) -> int:
        self.next.append(follow)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def split(self, p: int, x: int, q: int) -> int:
        """The state of what ends in x after p, which q so far stands for as well."""
        if self.length[q] == self.length[p] + 1:
            return q
        copy = self.state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = copy
        while p >= 0 and self.next[p].get(x) == q:
            self.next[p][x] = copy
            p = self.link[p]
        return copy

    def add(self, sequence: list[int]) -> None:
        last = 0
        for x in sequence:
            if x in self.next[last]:
                last = self.split(last, x, self.next[last][x])
                continue
            new, p = self.state(self.length[last] + 1, 0, {}), last
            while p >= 0 and x not in self.next[p]:
                self.next[p][x] = new
                p = self.link[p]
            if p >= 0:
                self.link[new] = self.split(p, x, self.next[p][x])
            last = new

    def matches(self, sequence: list[int]) -> Iterator[int]:
        """Length of the longest match that ends at each place."""
        state, size = 0, 0
        for x in sequence:
            while state and x not in self.next[state]:
                state = self.link[state]
                size = self.length[state]
            if x in self.next[state]:
                state = self.next[state][x]
                size += 1
            yield size


def long_matches(automaton: SuffixAutomaton, sequence: list[int], least: int) -> Iterator[tuple[int, int]]:
    """Maximal spans that matches of ``least`` numbers or more cover."""
    first = end = -1
    for i, size in enumerate(automaton.matches(sequence)):
        if size >= least:
            if i + 1 - size > end:
                if end >= 0:
                    yield first, end
                first = i + 1 - size
            else:
                first = min(first, i + 1 - size)
            end = i + 1
    if end >= 0:
        yield first, end


def resolve(window: int):
    """Compares the runs of one shard: spans that documents with smaller ids hold."""

    def compare(ids: list[int], contents: list[bytes], witness: list[bool]) -> Iterator[tuple[int, int, int]]:
        automaton = SuffixAutomaton()
        order = sorted(range(len(ids)), key=ids.__getitem__)
        for _, same in groupby(order, key=ids.__getitem__):
            sequences = [(i, np.frombuffer(contents[i], "<u8").tolist()) for i in same]
            for i, sequence in sequences:
                yield from ((i, a, b) for a, b in long_matches(automaton, sequence, window))
            for _, sequence in sequences:
                automaton.add(sequence)

    return compare


def word_numbers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    bounds, codes, distinct = words(texts)
    return hash_words(distinct)[codes], bounds


def word_cutter(texts: pa.Array):
    numbers, bounds = word_numbers(texts)
    return lambda row, a, b: numbers[bounds[row] + a : bounds[row] + b].tobytes()


def without_earlier_passages(
    docs: DataFrame, id_col="doc_id", text_col="text", sampling: Sampling = SAMPLING, group: int = GROUP
) -> DataFrame:
    """``doc_id, n_words, n_removed, removed, kept``: removed spans of words, and the words that stay."""
    given = keyed(docs, id_col, text_col).withColumnRenamed("khash", "tag")
    found = repeated_spans(given, word_numbers, sampling, True, resolve(sampling.window), word_cutter, group)
    spans = "array<struct<first: int, end: int>>"

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))
        for part in slices(batches, sampling.slice):
            sizes, gone, removed, kept = [], [], [], []
            for text, own in zip(part["text"].cast(pa.binary()).to_pylist(), part["spans"].to_pylist(), strict=True):
                all_words = text.split()  # bytes are split at the six ASCII blanks
                cuts = merged(own)
                ends = [0, *(x for cut in cuts for x in cut), len(all_words)]
                kept.append(b" ".join(w for a, b in zip(ends[::2], ends[1::2]) for w in all_words[a:b]))
                sizes.append(len(all_words))
                gone.append(sum(b - a for a, b in cuts))
                removed.append([{"first": a, "end": b} for a, b in cuts])
            columns = [part["doc_id"], pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(removed, kind)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(kept, pa.binary()).cast(pa.string())],
                names=["doc_id", "n_words", "n_removed", "removed", "kept"],
            )

    joined = given.join(found, ["kid", "tag"], "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(run, f"doc_id long, n_words long, n_removed long, removed {spans}, kept string")
