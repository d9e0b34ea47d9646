"""Token counts of whole texts by rank-synchronous merging of ragged numpy arrays.

The distinct pre-tokens of a batch are held as one flat array of symbols with row bounds. In each round every
pre-token finds the lowest rank among its neighbouring pairs, and all pre-tokens apply their own lowest-ranked pair at
once; those without a pair left drop out with the number of their surviving symbols. Counts of pre-tokens are kept in a
bounded memo, so words that recur are merged once.

Defined results: a null or empty text has 0 bytes and 0 tokens; strings of special tokens inside a text count as one
token, as the library's default has it; equal rows give equal rows; an empty table gives an empty one; columns other
than the id and the text are ignored. A text of any length is counted whole.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isochron.llm.common import tidy

NONE = np.int64(1) << np.int64(40)
PLAIN = re.compile(r"[\x00-\x1b\x20-\x7fÀ-ÖØ-öø-ÿ]*")
"""Texts in which Python's classes agree with the tokenizer's, and which are in composed form."""
PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+")
"""Fixed value: the split pattern of the vocabulary file, for plain texts."""
MEMO = 400_000


def byte_symbols() -> dict[int, str]:
    """Printable stand-in of each byte, by the public rule of byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    names = {b: chr(b) for b in shown}
    hidden = (b for b in range(256) if b not in names)
    return names | {b: chr(256 + i) for i, b in enumerate(hidden)}


class RankMerger:
    """Merge ranks of a byte-level vocabulary file with word ends, and the symbols counts they lead to."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"] or ""
        names = byte_symbols()
        self.inner = np.array([vocab[names[b]] for b in range(256)], np.int64)
        self.last = np.array([vocab[names[b] + end] for b in range(256)], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.size = np.int64(max(vocab.values()) + 1)
        rank_made = np.full(self.size, -1, np.int64)
        rank_made[made] = np.arange(len(made))
        if (np.maximum(rank_made[left], rank_made[right]) >= np.arange(len(made))).any():
            raise ValueError("a merge uses a symbol that is made later; its pairs cannot be applied all at once")
        keys = left * self.size + right
        order = np.argsort(keys)
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made[order]
        self.library = Tokenizer.from_file(path)
        special = [t["content"] for t in spec["added_tokens"]]
        self.strings = special
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True))) or r"(?!)")
        self.memo: dict[str, int] = {}

    def pieces(self, text: str) -> list[str]:
        """Pre-tokens of a text without special strings, as bytes shown by their own characters are not needed."""
        if PLAIN.fullmatch(text):
            return PIECES.findall(text.lower())
        normal = self.library.normalizer.normalize_str(text)
        return [normal[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(normal)]

    def lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        found = self.keys[at] == key
        return np.where(found, self.ranks[at], NONE), self.made[at]

    def merge(self, pieces: list[str]) -> np.ndarray:
        """Surviving symbols of each piece; no piece is empty."""
        raw = [p.encode("utf-8") for p in pieces]
        length = np.fromiter(map(len, raw), np.int64, len(raw))
        flat = np.frombuffer(b"".join(raw), np.uint8)
        start = np.cumsum(length) - length
        symbols = self.inner[flat]
        symbols[start + length - 1] = self.last[flat[start + length - 1]]
        counts, row = np.ones(len(raw), np.int64), np.arange(len(raw))
        while True:
            several = length > 1
            counts[row[~several]] = 1
            symbols = symbols[np.repeat(several, length)]
            row, length = row[several], length[several]
            if not len(row):
                return counts
            start = np.cumsum(length) - length
            rank, made = self.lookup(symbols[:-1], symbols[1:])
            rank, made = np.append(rank, NONE), np.append(made, 0)
            rank[start + length - 1] = NONE
            least = np.minimum.reduceat(rank, start)
            going = least < NONE
            counts[row[~going]] = length[~going]
            hit = (rank == np.repeat(least, length)) & (rank < NONE)
            at = np.flatnonzero(hit)
            # equal symbols in a row: every second pair of the run is applied, from its left end
            begins = np.flatnonzero(np.diff(at, prepend=-2) != 1)
            place = np.arange(len(at)) - np.repeat(begins, np.diff(np.append(begins, len(at))))
            at = at[place % 2 == 0]
            symbols[at] = made[at]
            keep = np.repeat(going, length)
            keep[at + 1] = False
            gone = np.zeros(len(symbols), np.int64)
            gone[at + 1] = 1
            length = (length - np.add.reduceat(gone, start))[going]
            symbols, row = symbols[keep], row[going]

    def count(self, texts: Iterable[str]) -> list[int]:
        found, fixed = [], []
        for text in texts:
            marks = 0
            if any(s in text for s in self.strings):
                parts = self.special.split(text)
                marks = len(parts) - 1
                found.append([p for part in parts if part for p in self.pieces(part)])
            else:
                found.append(self.pieces(text))
            fixed.append(marks)
        if len(self.memo) > MEMO:
            self.memo.clear()
        memo = self.memo
        new = list({p for pieces in found for p in pieces if p not in memo})
        new.sort(key=len)
        for i in range(0, len(new), 1 << 16):
            block = new[i : i + (1 << 16)]
            memo.update(zip(block, self.merge(block).tolist(), strict=True))
        return [n + sum(map(memo.__getitem__, p)) for n, p in zip(fixed, found, strict=True)]


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 2048, id_col="doc_id", text_col="text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every text. ``vocabulary``: a file that every worker can read."""
    given = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger = RankMerger(vocabulary)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                n = pa.array(merger.count(part["text"].to_pylist()), pa.int64())
                yield pa.RecordBatch.from_arrays([part["doc_id"], part["n_bytes"], n], ["doc_id", "n_bytes", "n_tokens"])

    sized = given.withColumn("n_bytes", F.octet_length("text").cast("long"))
    counts = sized.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return counts.withColumn("over_limit", F.col("n_tokens") > limit)
