"""Minimal perfect hashing of strings in shards: a dense slot for every key, and the keys to verify against."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from isochron.llm.common import MULTIPLIER, mix

KEYS_PER_BUCKET = 4
LONG_KEY = 64
_BUCKET, _DISPLACED = np.uint64(0x27D4EB2F165667C5), np.uint64(0x165667B19E3779F9)


def hash_keys(keys: list[bytes]) -> np.ndarray:
    """Hash of each key, equal to Spark's ``xxhash64`` of the string."""
    h = xxhash.xxh64_intdigest
    return np.fromiter((h(k, 42) for k in keys), np.uint64, len(keys))


def stored_key(key: bytes) -> bytes:
    """What is kept of a key to verify it: all of it, or a digest where it is long. No UTF-8 begins with 0xFF."""
    return key if len(key) <= LONG_KEY else b"\xff" + hashlib.sha256(key).digest()


def _places(h: np.ndarray, displacement: np.ndarray, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix(h ^ (_DISPLACED + displacement.astype(np.uint64) * MULTIPLIER)) % np.uint64(n)).astype(np.int64)


def displacements(h: np.ndarray) -> np.ndarray:
    """One number for each bucket of the distinct hashes, so that all of them fall into places of their own.

    Buckets are served from the largest down, each trying displacements until all its keys meet free places. A bucket
    of one key takes the next free place as it is, written as -1 - place.
    """
    n = len(h)
    buckets = n // KEYS_PER_BUCKET + 1
    bucket = (mix(h ^ _BUCKET) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    size = np.bincount(bucket, minlength=buckets)
    first = np.cumsum(size) - size
    free = np.ones(n, bool)
    found = np.zeros(buckets, np.int64)
    for b in np.argsort(-size, kind="stable"):
        if size[b] < 2:
            break
        keys, at, tries = h[order[first[b] : first[b] + size[b]]], 0, 8
        while True:
            places = np.sort(_places(keys[:, None], np.arange(at, at + tries)[None, :], n), axis=0)
            fits = np.flatnonzero(free[places].all(axis=0) & (places[1:] != places[:-1]).all(axis=0))
            if len(fits):
                found[b] = at + fits[0]
                free[places[:, fits[0]]] = False
                break
            at, tries = at + tries, min(2 * tries, 4096)
    single = np.flatnonzero(size == 1)
    found[single] = -1 - np.flatnonzero(free)[: len(single)]
    return found


def slots(h: np.ndarray, displacement: np.ndarray, n: int) -> np.ndarray:
    """Slot of each hash, below n; a hash that is not among the keys gets some slot, too."""
    own = displacement[(mix(h ^ _BUCKET) % np.uint64(len(displacement))).astype(np.int64)]
    return np.where(own < 0, -1 - own, _places(h, np.maximum(own, 0), n))


class Shard:
    """Slots of the keys of one shard. Keys whose hashes are equal, should there be any, are looked up by themselves."""

    def __init__(self, displacement: np.ndarray, keys: pa.Array, placed: int):
        self.displacement, self.keys, self.placed = displacement, keys, placed
        self.size = len(keys)
        self.twins = {k: placed + i for i, k in enumerate(keys[placed:].to_pylist())}

    @classmethod
    def of(cls, keys: list[bytes]) -> tuple[Shard, np.ndarray]:
        """The shard of distinct keys, and the slot of each."""
        h = hash_keys(keys)
        _, one = np.unique(h, return_index=True)
        slot = np.empty(len(keys), np.int64)
        displacement = displacements(h[one])
        slot[one] = slots(h[one], displacement, len(one))
        others = np.setdiff1d(np.arange(len(keys)), one)
        slot[others] = len(one) + np.arange(len(others))
        by_slot = np.argsort(slot)
        return cls(displacement, pa.array([stored_key(keys[i]) for i in by_slot], pa.binary()), len(one)), slot

    def lookup(self, keys: list[bytes], h: np.ndarray) -> np.ndarray:
        """Slot of each key, or -1 where the stored key is another one."""
        found = slots(h, self.displacement, self.placed)
        kept = [stored_key(k) for k in keys]
        same = pc.equal(self.keys.take(pa.array(found)), pa.array(kept, pa.binary())).to_numpy(zero_copy_only=False)
        found = np.where(same, found, -1)
        if self.twins:
            found = np.array([self.twins.get(k, s) for k, s in zip(kept, found.tolist(), strict=True)], np.int64)
        return found
