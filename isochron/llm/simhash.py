"""SimHash near-duplicates: fingerprints within ``REACH`` bits meet through Golay-code fuzzy hashing.

A document's fingerprint has 64 bits: each is 1 if it is set in over half of the XXH64 hashes (seed 42) of the
document's shingles of four lower-case words, repeats included. Equal fingerprints are one node.

*Fuzzy hashing.* The binary Golay code of length 23 is perfect: every 23-bit vector is within 3 bits of one codeword. A
vector at distance 3 of it is also within 4 bits of five more, so a vector has one nearby codeword or six. Vectors that
differ in two bits always have one of them in common (``nearby``); of vectors that differ in one bit, the nearest
codeword of either is near to the other.

*Pigeonhole.* The fingerprint is cut into three segments (22, 21 and 21 bits, filled up with zeros to 23). Four errors
leave

* a segment without error, and then another with two at most: keys are a segment as it is and a nearby codeword of
  another, for all six choices; or
* at least one error in each, and then exactly one in two of them: the one side is entered under the nearest codewords
  and the parities of two segments, the other asks for all nearby codewords and the other parities.

That is some 120 keys of 28 to 34 bits for a distinct fingerprint.

*Join and verify.* A pass over sorted keys gives every entry its key's centre, the entry that a mask drawn from the key
puts first, and drops keys that hold nothing to compare. Entries near their centre are linked; components are formed;
only keys that then hold several components are joined, across these, and verified within the join. So no pairs within a
group are made, and no link between different texts' classes is lost.

Defined results: a null or empty text, or one without words, has fingerprint zero and is linked like any other; fewer
than four words are one shingle; equal rows, and rows sharing an id, are documents of their own; ``component_id`` is the
smallest id, null only if no member has one; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isochron.llm.common import NO_ID, as_long, keyed, mix, stored, tidy
from isochron.llm.components import components
from isochron.llm.repeats import slices

WORDS = 4
SEED = 42
REACH = 4
SLICE = 1 << 21
CHUNK = 1 << 15
NODES = 4096
LENGTH, REDUNDANT = 23, 11
GENERATOR = 0b101011100011  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1
SEGMENTS = ((0, 22), (22, 21), (43, 21))


@cache
def golay() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the low and the high bits, and of each syndrome six error patterns and how many there are.

    The patterns are those of up to 4 bits: the leader first, then, where that has 3 bits, five of 4 bits.
    """
    remainder = np.zeros(LENGTH, np.int64)
    x = 1
    for i in range(LENGTH):
        remainder[i] = x
        x <<= 1
        if x >> REDUNDANT:
            x ^= GENERATOR

    def table(first: int, bits: int) -> np.ndarray:
        of = np.zeros(1 << bits, np.int64)
        for i in range(bits):
            of[1 << i : 2 << i] = of[: 1 << i] ^ remainder[first + i]
        return of

    patterns, count = np.zeros((1 << REDUNDANT, 6), np.int64), np.zeros(1 << REDUNDANT, np.int64)
    for weight in range(5):
        for places in combinations(range(LENGTH), weight):
            syndrome = int(np.bitwise_xor.reduce(remainder[list(places)])) if places else 0
            patterns[syndrome, count[syndrome]] = sum(1 << p for p in places)
            count[syndrome] += 1
    return table(0, 12), table(12, 11), patterns, count


def nearby(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers (12 bits) of the codewords within 4 bits of each 23-bit vector, the nearest first, and which are there."""
    low, high, patterns, count = golay()
    syndrome = low[v & 0xFFF] ^ high[v >> 12]
    return (v[:, None] ^ patterns[syndrome]) >> REDUNDANT, np.arange(6) < count[syndrome][:, None]


def fuzzy_keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries of fingerprints: the key (its last bit set where the entry only asks), and the place of the fingerprint."""
    n = len(fp)
    segment = [((fp >> np.uint64(at)) & np.uint64((1 << bits) - 1)).astype(np.int64) for at, bits in SEGMENTS]
    near = [nearby(s) for s in segment]
    parity = [np.bitwise_count(s).astype(np.int64) & 1 for s in segment]
    keys, rows = [], []

    def enter(key: np.ndarray, valid: np.ndarray, asks: int) -> None:
        row = np.broadcast_to(np.arange(n).reshape(-1, *[1] * (key.ndim - 1)), key.shape)
        keys.append(key[valid] << 1 | asks)
        rows.append(row[valid])

    kind = 0
    for a in range(3):
        for b in (x for x in range(3) if x != a):
            kind += 1
            number, valid = near[b]
            enter(kind << 40 | segment[a][:, None] << 12 | number, valid, 0)
    for a, b in combinations(range(3), 2):
        kind += 1
        (one, valid), (other, there) = near[a], near[b]
        nearest = one[:, 0] << 12 | other[:, 0]
        enter(kind << 40 | parity[a] << 25 | parity[b] << 24 | nearest, np.ones(n, bool), 0)
        flipped = (1 - parity[a]) << 25 | (1 - parity[b]) << 24
        all_near = flipped[:, None, None] | one[:, :, None] << 12 | other[:, None, :]
        enter(kind << 40 | all_near, valid[:, :, None] & there[:, None, :], 1)
    return np.concatenate(keys), np.concatenate(rows)


def fingerprint(text: bytes) -> int:
    """Majority of the bits of the hashes of all shingles."""
    words = text.lower().split()  # of bytes: A-Z, and the six ASCII blanks
    if not words:
        return 0
    h, n = xxhash.xxh64_intdigest, max(len(words) - WORDS + 1, 1)
    votes = np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        some = words[at : min(at + CHUNK, n) + WORDS - 1]
        joined = b" ".join(some)
        size = np.fromiter(map(len, some), np.int64, len(some))
        end = np.cumsum(size + 1) - 1
        first, last = (end - size).tolist(), end[min(WORDS, len(some)) - 1 :].tolist()
        hashes = np.fromiter((h(joined[a:b], SEED) for a, b in zip(first, last)), np.uint64, len(last))
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * votes > n).tolist())


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, kid, fp`` of each row of ``docs`` (``doc_id, kid, text``)."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, SLICE):
            texts = part["text"].cast(pa.large_binary()).to_pylist()
            found = np.fromiter(map(fingerprint, texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([part["doc_id"], part["kid"], pa.array(as_long(found))], names=["doc_id", "kid", "fp"])

    return docs.select("doc_id", "kid", "text").mapInArrow(run, "doc_id long, kid long, fp long")


def entries(nodes: DataFrame) -> DataFrame:
    """``key, masked`` of distinct fingerprints: the mask is drawn from the key, so another order holds in every key."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, NODES):
                fp = batch["fp"][at : at + NODES].to_numpy().view(np.uint64)
                key, row = fuzzy_keys(fp)
                masked = fp[row] ^ mix((key >> 1).astype(np.uint64))
                for a in range(0, len(key), 1 << 17):
                    own = slice(a, a + (1 << 17))
                    yield pa.RecordBatch.from_arrays([pa.array(key[own]), pa.array(as_long(masked[own]))], names=["key", "masked"])

    return nodes.select("fp").mapInArrow(run, "key long, masked long")


def with_centres(listed: DataFrame) -> DataFrame:
    """``key, asks, fp, centre`` of every entry but the centres, where the key has one that does not only ask.

    A pass over sorted rows that keeps the last key's centre in mind, so a key may have any number of entries.
    """

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_key, last_centre, last_good = None, np.uint64(0), False
        for batch in batches:
            if not batch.num_rows:
                continue
            entry, masked = (batch[n].to_numpy() for n in ("key", "masked"))
            key, asks = entry >> 1, entry & 1
            fp = masked.view(np.uint64) ^ mix(key.astype(np.uint64))
            begins = np.concatenate([[last_key is None or key[0] != last_key], key[1:] != key[:-1]])
            first = np.maximum.accumulate(np.where(begins, np.arange(len(key)), -1))
            centre = np.where(first >= 0, fp[first], last_centre)
            good = np.where(first >= 0, asks[first] == 0, last_good)
            last_key, last_centre, last_good = key[-1], centre[-1], bool(good[-1])
            keep = good & ~begins
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[keep]), pa.array(asks[keep] == 1), pa.array(as_long(fp[keep])), pa.array(as_long(centre[keep]))],
                names=["key", "asks", "fp", "centre"],
            )

    dealt = listed.repartition(F.shiftright("key", 1)).sortWithinPartitions("key", "masked")
    return dealt.mapInArrow(run, "key long, asks boolean, fp long, centre long")


def links(nodes: DataFrame, reach: int = REACH) -> DataFrame:
    """``a, b``: links of fingerprints that connect all that are within ``reach`` (at most 4) bits."""
    met = stored(with_centres(entries(nodes)), "meetings")

    def near(a: str, b: str):
        return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= reach

    stars = met.where(near("fp", "centre")).select(F.col("centre").alias("a"), F.col("fp").alias("b"))
    stars = stored(stars.distinct(), "stars")
    # keys with nothing far from their centre are done, and so are those where all others only ask
    open_keys = met.groupBy("key").agg(F.bool_or(~near("fp", "centre")).alias("far"), F.bool_and("asks").alias("asking"))
    left = met.join(open_keys.where(F.col("far") & ~F.col("asking")).select("key"), "key").select("key", "asks", "fp")
    label = components(stars).select(F.col("node").alias("fp"), "component")
    left = left.join(label, "fp", "left").select("key", "asks", "fp", F.coalesce("component", "fp").alias("component"))
    main = (
        left.groupBy("key", "component")
        .agg(F.count("*").alias("size"))
        .groupBy("key")
        .agg(F.max(F.struct("size", "component"))["component"].alias("main"), F.count("*").alias("components"))
        .where("components > 1")
        .select("key", "main")
    )
    left = stored(left.join(main, "key"), "open-keys")
    x, y = left.where("component != main").alias("x"), left.alias("y")
    across = (
        (F.col("x.key") == F.col("y.key"))
        & (F.col("x.component") != F.col("y.component"))
        & ((F.col("y.component") == F.col("y.main")) | (F.col("x.fp") < F.col("y.fp")))
        & ~(F.col("x.asks") & F.col("y.asks"))
        & near("x.fp", "y.fp")
    )
    more = x.join(y, across).select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b")).distinct()
    return stars.unionByName(more)


def near_duplicates(docs: DataFrame, id_col="doc_id", text_col="text", reach: int = REACH) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of each row."""
    prints = stored(fingerprints(keyed(docs, id_col, text_col)), "fingerprints")
    nodes = stored(prints.groupBy("fp").agg(F.min("kid").alias("kid")), "distinct-fingerprints")
    found = components(links(nodes, reach)).select(F.col("node").alias("fp"), "component")
    placed = nodes.join(found, "fp", "left").select("fp", "kid", F.coalesce("component", "fp").alias("component"))
    least = placed.groupBy("component").agg(F.min("kid").alias("least"))
    classes = placed.join(least, "component").select("fp", F.when(F.col("least") != NO_ID, F.col("least")).alias("component_id"))
    shown = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return prints.join(classes, "fp").select("doc_id", shown, "component_id")
