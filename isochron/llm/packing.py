"""Best-fit packing of token sequences by exact-complement hashing.

Documents are tokenized where they are; only lengths decide the packing. The plan is made from the count of pieces of
each length, which is at most ``capacity`` numbers however large the table is:

1. *Exact complements.* For each length, from the longest, the gap it leaves is looked up among the lengths still
   available, then among sums of two and of three of them; a combination that fills the gap exactly is used as often
   as the counts allow.
2. *Best fit.* What remains goes, longest first, into the open sequence with the smallest gap that holds it, or opens
   a new one.

The plan says for each length which ranks go where. A piece's rank among all pieces of its length is the number of such
pieces in earlier partitions (a sum over per-partition counts) plus its number within its partition, so that no length,
however frequent, meets in one task.

Defined results: a null or empty text is the end mark alone; documents longer than ``capacity`` are cut, the first
piece taking the remainder; equal rows are packed one by one; an empty table gives no pieces; other columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from isochron.llm.common import stored, tidy
from isochron.llm.repeats import slices
from isochron.llm.token_counts import PLAIN, byte_symbols

PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
"""Fixed value: the split pattern of the vocabulary file, for plain texts."""
MEMO = 400_000
"""Units and pre-tokens whose ids a worker keeps, the first that it meets; later ones are encoded once a slice."""
SLICE = 1 << 22


class PieceIds(dict):
    """Ids of the pre-tokens of plain texts, asked of the library's model, and of units made of them.

    The first ``MEMO`` met are kept. A unit that is one pre-token has its ids, so both are kept under their text.
    """

    def __init__(self, model):
        self.model = model
        self.shown = byte_symbols()

    def __missing__(self, piece: str) -> bytes:
        shown = (piece if piece.isascii() else piece.encode("utf-8").decode("latin-1")).translate(self.shown)
        ids = array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()
        if len(self) < MEMO:
            self[piece] = ids
        return ids


class IdEncoder:
    """Ids of whole texts as the library gives them, as little-endian 32-bit numbers.

    In a plain text without double spaces every space that follows a word begins a pre-token, so the units between
    spaces can be taken one by one; the library's model gives the ids of each distinct pre-token. Other texts it encodes whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.pieces = PieceIds(self.library.model)

    def ids(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def is_plain(self, text: str) -> bool:
        odd = "  " in text or text.endswith(" ") or "\0" in text or any(s in text for s in self.special)
        return not odd and PLAIN.fullmatch(text) is not None

    def __call__(self, texts: list[str]) -> list[bytes]:
        plain = [self.is_plain(t) for t in texts]
        whole = iter(self.ids([t for t, p in zip(texts, plain, strict=True) if not p]))
        own = iter(self.joined([t for t, p in zip(texts, plain, strict=True) if p]))
        return [next(own) if p else next(whole) for p in plain]

    def joined(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of plain texts: units are coded by Arrow, looked up once each, and put together by numpy."""
        marked = pc.replace_substring(pa.array(texts, pa.large_string()), " ", "\0 ")
        units = pc.split_pattern(marked, "\0").cast(pa.large_list(pa.large_string()))
        bounds, coded = units.offsets.to_numpy(), units.flatten().dictionary_encode()
        names, codes = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy()
        found = list(map(self.pieces.get, names))
        for i in [i for i, x in enumerate(found) if x is None]:
            found[i] = b"".join(map(self.pieces.__getitem__, PIECES.findall(names[i])))
            if len(self.pieces) < MEMO:
                self.pieces[names[i]] = found[i]
        flat = np.frombuffer(b"".join(found), "<u4")
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        first = (np.cumsum(size) - size)[codes]
        each = size[codes]
        ends = np.cumsum(each)
        ids = flat[np.repeat(first - ends + each, each) + np.arange(each.sum())]
        cuts = np.concatenate([[0], ends])[bounds]
        return (ids[a:b].tobytes() for a, b in zip(cuts, cuts[1:]))


@cache
def encoder(path: str) -> IdEncoder:
    """One for each worker process, which serves many tasks; Spark's tasks are the parallel ones, not its threads."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return IdEncoder(path)


def token_pieces(
    docs: DataFrame, vocabulary: str, capacity: int = 2048, end_id: int = 0, id_col="doc_id", text_col="text", with_ids=False
) -> DataFrame:
    """Pieces of at most ``capacity`` ids: ``doc_id, piece, start, length, ids_crc32, part, nth[, ids]``.

    ``nth`` numbers the pieces of one length within the partition ``part``.
    """
    given = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        F.spark_partition_id().alias("part"),
    )
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"
    schema += ", ids binary" * with_ids

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, seen = encoder(vocabulary), np.zeros(capacity + 1, np.int64)
        mark = np.array([end_id], "<u4").tobytes()
        for batch in slices(batches, SLICE):
            rows = []
            texts = batch["text"].to_pylist()
            for doc, p, ids in zip(batch["doc_id"].to_pylist(), batch["part"].to_pylist(), encode(texts), strict=True):
                ids += mark
                n = len(ids) // 4
                cuts = [0, *range(n % capacity or capacity, n, capacity), n]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    own = ids[4 * a : 4 * b]
                    rows.append((doc, k, a, b - a, zlib.crc32(own), p, int(seen[b - a]), own))
                    seen[b - a] += 1
            columns = list(zip(*rows, strict=True))[: 7 + with_ids]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth", "ids"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names[: len(columns)])

    return given.mapInArrow(run, schema)


class Plan:
    """Where each rank of each length goes: rows (length, first rank, first sequence, copies in each, offset)."""

    def __init__(self, counts: np.ndarray):
        """``counts[n]``: pieces of length n; the capacity is the last length."""
        self.left = counts.astype(np.int64).copy()
        self.capacity = len(counts) - 1
        self.used = np.zeros(len(counts), np.int64)
        self.sequences = 0
        self.rows: list[tuple[int, int, int, int, int]] = []
        self.exact()
        self.best_fit()

    def put(self, length: int, first: int, n: int, copies: int, offset: int) -> None:
        """``copies`` pieces of this length into each of the n sequences from ``first`` on."""
        self.rows.append((length, int(self.used[length]), first, copies, offset))
        self.used[length] += n * copies
        self.left[length] -= n * copies

    def complement(self, gap: int) -> tuple[int, ...] | None:
        """One, two or three available lengths that sum to ``gap``, the longest first."""
        left = self.left
        if left[gap]:
            return (gap,)
        there = left > 0

        def pair(total: int, most: int, taken: int = 0) -> tuple[int, int] | None:
            high = np.arange(min(total - 1, most), (total - 1) // 2, -1)
            if not len(high):
                return None
            low = total - high
            enough = left[high] >= 1 + (high == low) + (high == taken)
            enough &= left[low] >= 1 + (low == high) + (low == taken)
            return (int(high[k]), int(low[k])) if enough[k := int(enough.argmax())] else None

        if found := pair(gap, gap):
            return found
        for a in np.flatnonzero(there[: gap - 1])[::-1]:
            if 3 * a < gap:
                break
            if found := pair(gap - int(a), int(a), int(a)):
                return (int(a), *found)
        return None

    def exact(self) -> None:
        for length in range(self.capacity, 0, -1):
            while self.left[length]:
                self.left[length] -= 1  # this one cannot fill its own gap
                parts = self.complement(self.capacity - length) if length < self.capacity else ()
                self.left[length] += 1
                if parts is None:
                    break
                each = np.bincount((length, *parts), minlength=len(self.left))
                kinds = np.flatnonzero(each)[::-1]
                n, offset = int((self.left[kinds] // each[kinds]).min()), 0
                for kind in kinds:
                    self.put(int(kind), self.sequences, n, int(each[kind]), offset)
                    offset += int(kind * each[kind])
                self.sequences += n

    def best_fit(self) -> None:
        gaps: list[list[tuple[int, int]]] = [[] for _ in range(self.capacity + 1)]  # runs of sequences by their gap
        for length in range(self.capacity, 0, -1):
            gap = length
            while n := int(self.left[length]):
                while gap <= self.capacity and not gaps[gap]:
                    gap += 1
                if gap <= self.capacity:
                    first, m = gaps[gap].pop()
                    room = gap
                else:
                    first, m, room = self.sequences, -(-n // (self.capacity // length)), self.capacity
                    self.sequences += m
                fit = room // length
                full = min(m, n // fit)
                if full:
                    self.put(length, first, full, fit, self.capacity - room)
                    gaps[room - fit * length].append((first, full))
                if full < m:
                    some = int(self.left[length])  # fewer than fit
                    if some:
                        self.put(length, first + full, 1, some, self.capacity - room)
                        gaps[room - some * length].append((first + full, 1))
                    if m - full - bool(some):
                        gaps[room].append((first + full + bool(some), m - full - bool(some)))
                gap = length
        if self.left.any():
            raise AssertionError("pieces are left over")


def pack(
    docs: DataFrame, vocabulary: str, capacity: int = 2048, end_id: int = 0, id_col="doc_id", text_col="text", with_ids=False
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset[, ids]`` of every piece."""
    pieces = stored(token_pieces(docs, vocabulary, capacity, end_id, id_col, text_col, with_ids), "pieces")
    counts = stored(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "piece-counts")
    totals = np.zeros(capacity + 1, np.int64)
    for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most ``capacity`` rows
        totals[row["length"]] = row["n"]
    plan = np.array(sorted(Plan(totals).rows), np.int64).reshape(-1, 5)
    first_row = np.searchsorted(plan[:, 0], np.arange(capacity + 2))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = pieces.join(before, ["part", "length"]).withColumn("rank", F.col("before") + F.col("nth"))
    out = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"

    @tidy
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch["length"].to_numpy(), batch["rank"].to_numpy()
            row = np.zeros(len(length), np.int64)
            for n in np.unique(length):
                own = length == n
                lo, hi = first_row[n], first_row[n + 1]
                row[own] = lo + np.searchsorted(plan[lo:hi, 1], rank[own], side="right") - 1
            _, begin, sequence, copies, offset = plan[row].T
            k = rank - begin
            places = [pa.array(sequence + k // copies), pa.array(offset + k % copies * length)]
            kept = ["doc_id", "piece", "start", "length", "ids_crc32"]
            names = [*kept, "sequence_id", "offset", *["ids"] * with_ids]
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in kept), *places, *[batch["ids"]] * with_ids] if with_ids else [*(batch[c] for c in kept), *places],
                names=names,
            )

    return ranked.mapInArrow(place, out + ", ids binary" * with_ids)
