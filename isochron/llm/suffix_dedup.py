"""Bytes that stand twice in a corpus, found by sorting suffixes with deep-shallow sorting.

Each byte covered by a string of ``WINDOW`` bytes that also starts anywhere else, in the same document or another, is
removed; strings never cross documents, overlaps count, and all is judged on the input. Runs of windows with one anchor
are brought together by hash (see ``repeats``). For runs with one key, the suffixes from their anchors on, and those of
the reversed text before, are sorted:

* multikey quicksort, eight bytes at a time, down to ``SHALLOW`` bytes;
* groups that are still equal there have long common prefixes, and are ordered by a blind trie: a new suffix runs down
  the trie by its branching bytes only, is compared once with the leaf it meets, and is put in where they part.

Two runs hold a common string of L + R bytes around their anchors, where L and R are their common prefixes in the two
orders. Joining neighbours of the left order from the longest common prefix down, and keeping every joined set in right
order, each run meets the partners with the largest R for every L; that finds all bytes to remove without comparing all
pairs.

Defined results: a null text has no bytes; shorter documents keep all; equal rows are copies of each other and lose
what is long enough; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from isochron.llm.common import NO_ID, gram_hashes, keyed, tidy
from isochron.llm.repeats import GROUP, Sampling, merged, repeated_spans, slices

WINDOW = 400
SHALLOW = 64
SAMPLING = Sampling(WINDOW, span=200, gram=8, width="u1", slice=1 << 20)
PASSAGES = Sampling(240, span=150, gram=8, width="u1", slice=1 << 20)
"""For passages of some 50 words, which have 300 bytes or so: every one of them covers whole windows."""


def common_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    m = min(len(a), len(b))
    x = int.from_bytes(a[known:m], "big") ^ int.from_bytes(b[known:m], "big")
    return m - (x.bit_length() + 7) // 8


def deep_shallow_order(strings: list[bytes], depth: int = 0, shallow: int = SHALLOW) -> list[int]:
    """Numbers of the strings in ascending order; all agree on the first ``depth`` bytes."""
    out: list[int] = []
    todo = [(list(range(len(strings))), depth)]
    while todo:
        group, at = todo.pop()
        if len(group) == 1:
            out += group
        elif at - depth >= shallow:
            out += blind_trie_order(strings, group)
        else:  # one letter of the super-alphabet: eight bytes, and their number where the string ends
            letter = {i: strings[i][at : at + 8] for i in group}
            pivot = letter[group[len(group) // 2]]
            less = [i for i in group if letter[i] < pivot]
            same = [i for i in group if letter[i] == pivot]
            more = [i for i in group if letter[i] > pivot]
            if more:
                todo.append((more, at))
            if len(pivot) < 8:  # they end here and are equal
                todo += [([i], at) for i in reversed(same)]
            else:
                todo.append((same, at + 8))
            if less:
                todo.append((less, at))
    return out


def blind_trie_order(strings: list[bytes], group: list[int]) -> list[int]:
    """Order of strings with long common prefixes. Inner nodes are [depth, {byte or -1 at the end: child}]."""
    root: list | int = group[0]
    same: dict[int, list[int]] = {group[0]: [group[0]]}
    for i in group[1:]:
        s = strings[i]
        node = root
        while isinstance(node, list):
            node = node[1].get(s[node[0]] if node[0] < len(s) else -1) or next(iter(node[1].values()))
            node = node - 1 if isinstance(node, int) else node
        other = strings[node]
        n = common_prefix(s, other)
        if n == len(s) == len(other):
            same[node].append(i)
            continue
        same[i] = [i]
        above, node = None, root
        while isinstance(node, list) and node[0] < n:
            above = (node, s[node[0]])
            node = node[1][s[node[0]]]
            node = node - 1 if isinstance(node, int) else node
        own = s[n] if n < len(s) else -1
        if isinstance(node, list) and node[0] == n:
            node[1][own] = i + 1
            continue
        split = [n, {own: i + 1, other[n] if n < len(other) else -1: node + 1 if isinstance(node, int) else node}]
        if above is None:
            root = split
        else:
            above[0][1][above[1]] = split
    out, stack = [], [root if isinstance(root, list) else root + 1]
    while stack:
        node = stack.pop()
        if isinstance(node, list):
            stack += [node[1][x] for x in sorted(node[1], reverse=True)]
        else:
            out += same[node - 1]
    return out


def resolve(sampling: Sampling):
    """Compares the runs of one key: spans of ``window`` bytes or more that another run holds too."""
    window, reach = sampling.window, sampling.reach

    def anchor(content: bytes) -> int:
        first = np.frombuffer(content[: sampling.span], np.uint8).astype(np.uint64)
        return int(gram_hashes(first, sampling.gram).argmin())

    def compare(ids: list[int], contents: list[bytes], witness: list[bool]) -> Iterator[tuple[int, int, int]]:
        at = [anchor(c) for c in contents]
        rights = [c[a:] for c, a in zip(contents, at, strict=True)]
        lefts = [c[:a][::-1] for c, a in zip(contents, at, strict=True)]
        right_order = deep_shallow_order(rights, min(reach, *map(len, rights)) if all_agree(rights, reach) else 0)
        rank = [0] * len(rights)
        for r, i in enumerate(right_order):
            rank[i] = r
        left_order = deep_shallow_order(lefts)
        shared = [common_prefix(lefts[a], lefts[b]) for a, b in zip(left_order, left_order[1:])]
        home = list(range(len(left_order)))  # set of each place in left order
        sets = [[rank[i]] for i in left_order]
        for gap in sorted(range(len(shared)), key=shared.__getitem__, reverse=True):
            left = shared[gap]
            a, b = find(home, gap), find(home, gap + 1)
            if len(sets[a]) < len(sets[b]):
                a, b = b, a
            large, small = sets[a], sets[b]
            home[b], sets[b] = a, []
            if len(small) * 8 > len(large):
                joined = sorted(large + small)
            else:
                joined = large
                for r in small:
                    joined.insert(bisect_left(joined, r), r)
            sets[a] = joined
            for r in small:
                k = bisect_left(joined, r)
                for n in (k - 1, k + 1):
                    if 0 <= n < len(joined):
                        i, j = right_order[r], right_order[joined[n]]
                        right = common_prefix(rights[i], rights[j])
                        if left + right >= window:
                            for x in (i, j):
                                if not witness[x]:
                                    yield x, at[x] - left, at[x] + right

    return compare


def all_agree(strings: list[bytes], n: int) -> bool:
    """Runs of one key agree on ``n`` bytes, unless hashes collide."""
    return len({s[:n] for s in strings}) == 1


def find(home: list[int], x: int) -> int:
    while home[x] != x:
        home[x] = home[home[x]]
        x = home[x]
    return x


def byte_numbers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    raw = texts.cast(pa.large_binary())
    bounds = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
    data = np.frombuffer(raw.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
    return data, bounds - bounds[0]


def byte_cutter(texts: pa.Array):
    rows = texts.cast(pa.large_binary()).to_pylist()
    return lambda row, a, b: rows[row][a:b]


def repeated_bytes(docs: DataFrame, sampling: Sampling, group: int) -> DataFrame:
    return repeated_spans(docs, byte_numbers, sampling, False, resolve(sampling), byte_cutter, group)


def without_repeated_bytes(
    docs: DataFrame, id_col="doc_id", text_col="text", sampling: Sampling = SAMPLING, group: int = GROUP
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, removed, kept``: removed spans of bytes, and the bytes that stay."""
    given = keyed(docs, id_col, text_col).withColumnRenamed("khash", "tag")
    found = repeated_bytes(given, sampling, group)
    spans = "array<struct<first: int, end: int>>"

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))
        for part in slices(batches, sampling.slice):
            sizes, gone, removed, kept = [], [], [], []
            for text, own in zip(part["text"].cast(pa.binary()).to_pylist(), part["spans"].to_pylist(), strict=True):
                cuts = merged(own)
                ends = [0, *(x for cut in cuts for x in cut), len(text)]
                kept.append(b"".join(text[a:b] for a, b in zip(ends[::2], ends[1::2])))
                sizes.append(len(text))
                gone.append(sum(b - a for a, b in cuts))
                removed.append([{"first": a, "end": b} for a, b in cuts])
            columns = [pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(map(len, removed), pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [part["doc_id"], *columns, pa.array(removed, kind), pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "removed", "kept"],
            )

    joined = given.join(found, ["kid", "tag"], "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(run, f"doc_id long, n_bytes long, n_removed long, n_spans long, removed {spans}, kept binary")


def whole_characters(text: bytes, cuts: list[tuple[int, int]]) -> str:
    """What stays when the cuts are narrowed to whole characters of the UTF-8 text."""
    kept, at = [], 0
    for a, b in cuts:
        while a < b and text[a] & 0xC0 == 0x80:
            a += 1
        while b > a and b < len(text) and text[b] & 0xC0 == 0x80:
            b -= 1
        kept.append(text[at:a])
        at = b
    return b"".join([*kept, text[at:]]).decode("utf-8")


def long_enough(text: bytes, cuts: list[tuple[int, int]], least_words: int, enough: int) -> list[tuple[int, int]]:
    """The cuts that hold ``least_words`` words or more, or ``enough`` bytes, as in scripts without spaces."""
    return [(a, b) for a, b in cuts if b - a >= enough or len(text[a:b].split()) >= least_words]


def with_unique_texts(
    docs: DataFrame,
    id_col="doc_id",
    text_col="text",
    sampling: Sampling = SAMPLING,
    group: int = GROUP,
    least_words: int = 0,
) -> DataFrame:
    """Rows of ``docs`` with all their columns, repeated bytes taken out of the text as whole characters.

    Repeated runs of fewer than ``least_words`` words stay where they are, unless they have ``WINDOW`` bytes or more. A
    text of which nothing stays is empty; a null text stays null.
    """
    text = F.col(text_col).cast("string")
    given = docs.select(
        F.struct(*docs.columns).alias("row"),
        F.coalesce(text, F.lit("")).alias("text"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("kid"),
        F.xxhash64(F.coalesce(text, F.lit(""))).alias("tag"),
    )
    found = repeated_bytes(given.select("kid", "tag", "text"), sampling, group)
    others = [c for c in docs.columns if c != text_col]

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, sampling.slice):
            texts = part["text"].cast(pa.binary()).to_pylist()
            cuts = [long_enough(t, merged(s), least_words, WINDOW) for t, s in zip(texts, part["spans"].to_pylist(), strict=True)]
            made = [whole_characters(t, own) if own else t.decode("utf-8") for t, own in zip(texts, cuts, strict=True)]
            yield pa.RecordBatch.from_arrays([part["row"], part["empty"], pa.array(made, pa.string())], names=["row", "empty", "text"])

    rest = F.struct(*(F.col(f"row.`{c}`").alias(c) for c in others)) if others else F.struct(F.lit(1).alias("none"))
    sent = given.select(rest.alias("row"), F.col(f"row.`{text_col}`").isNull().alias("empty"), "text", "kid", "tag")
    joined = sent.join(found, ["kid", "tag"], "left").select("row", "empty", "text", "spans")
    schema = StructType([joined.schema["row"], StructField("empty", BooleanType()), StructField("text", StringType())])
    back = joined.mapInArrow(run, schema)
    text = F.when(~F.col("empty"), F.col("text")).alias(text_col)
    return back.select(*(text if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns))
