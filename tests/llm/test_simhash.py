import random
import re

import numpy as np
import pytest
import xxhash

from isochron.llm import simhash
from isochron.llm.simhash import fingerprint, fuzzy_keys, golay, links, near_duplicates, nearby

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    shingles = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints, reach=4):
    """Smallest place reachable from each place, by comparing all."""
    home = list(range(len(prints)))

    def find(x):
        while home[x] != x:
            x = home[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= reach:
                a, b = sorted((find(i), find(j)))
                home[b] = a
    return [find(i) for i in range(len(prints))]


def test_code_is_perfect():
    _, _, patterns, count = golay()
    assert sorted(np.unique(count, return_counts=True)[1].tolist()) == [277, 1771]
    assert set(count.tolist()) == {1, 6}
    assert max(int(p).bit_count() for p in patterns[:, 0]) == 3


def test_two_errors_share_a_codeword_and_one_error_keeps_the_nearest_near():
    rng = np.random.default_rng(1)
    for v in rng.integers(0, 1 << 23, 60).tolist():
        flips = [0, *(1 << i for i in range(23)), *(1 << i | 1 << j for i in range(23) for j in range(i))]
        number, valid = nearby(np.array([v ^ f for f in flips]))
        own = set(number[0][valid[0]].tolist())
        assert all(own & set(n[ok].tolist()) for n, ok in zip(number, valid))
        assert all(number[i][0] in own for i in range(24))


def test_keys_meet_for_every_pattern_of_four_errors():
    rng = random.Random(2)
    for _ in range(1500):
        a = rng.getrandbits(64)
        b = a
        for i in rng.sample(range(64), rng.randint(1, 4)):
            b ^= 1 << i
        key, row = fuzzy_keys(np.array([a, b], np.uint64))
        one, other = set(key[row == 0].tolist()), set(key[row == 1].tolist())
        whole = lambda keys: {k >> 1 for k in keys}
        assert whole(k for k in one if not k & 1) & whole(other)


@pytest.mark.parametrize("seed", [3, 4])
def test_links_equal_all_pairs(spark, seed):
    """Chains, dense balls and lone fingerprints."""
    rng = random.Random(seed)
    prints = [rng.getrandbits(64) for _ in range(60)]
    for _ in range(500):
        x = rng.choice(prints[-40:] if rng.random() < 0.5 else prints[:10])
        for i in rng.sample(range(64), rng.choice([1, 2, 3, 4, 4, 5, 6])):
            x ^= 1 << i
        prints.append(x)
    prints = list(dict.fromkeys(prints))
    signed = [(int(np.uint64(x).view(np.int64)),) for x in prints]
    nodes = spark.createDataFrame(signed, "fp long").repartition(3)
    found = {(r.a, r.b) for r in links(nodes).collect()}
    place = {x[0]: i for i, x in enumerate(signed)}
    assert all((prints[place[a]] ^ prints[place[b]]).bit_count() <= 4 for a, b in found)
    home = list(range(len(prints)))

    def find(x):
        while home[x] != x:
            x = home[x]
        return x

    for a, b in found:
        x, y = sorted((find(place[a]), find(place[b])))
        home[y] = x
    assert [find(i) for i in range(len(prints))] == classes(prints)


def texts(seed):
    rng = random.Random(seed)
    out = ["", None, " \t\n", "One", "one", "ONE two", "one two three", "a b c d", "x" * 40_000, "É É é é é", "word " * 70_000]
    for _ in range(60):
        w = [rng.choice("abcdefghij") * rng.randint(1, 3) for _ in range(rng.choice([5, 30, 300]))]
        for _ in range(rng.randint(1, 4)):
            v = list(w)
            for _ in range(rng.randint(0, 2)):
                v[rng.randrange(len(v))] = "new"
            out.append(" ".join(v))
    return out


def test_documents_equal_brute_force(spark):
    given = texts(5)
    rows = [(i if i % 7 else None, t, 1) for i, t in enumerate(given)] + [(3, "One", 2), (3, "One", 2)]
    prints = [plain_fingerprint(t) for _, t, _ in rows]
    assert [fingerprint((t or "").encode()) for _, t, _ in rows] == prints
    ids = {}
    for (i, *_), c in zip(rows, classes(prints), strict=True):
        ids.setdefault(c, []).append(i)
    least = {c: min((i for i in own if i is not None), default=None) for c, own in ids.items()}
    wanted = [(i, f"{p:016x}", least[c]) for (i, *_), p, c in zip(rows, prints, classes(prints), strict=True)]
    docs = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, fp int, component string").repartition(3)
    got = near_duplicates(docs)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(wanted, key=str)


def test_one_large_ball(spark):
    """Thousands of fingerprints around one: far from each other, but all in one class; no pairs are made."""
    rng = random.Random(6)
    ball = {0x123456789ABCDEF0}
    while len(ball) < 1500:
        x = 0x123456789ABCDEF0
        for i in rng.sample(range(64), rng.choice([2, 3, 4])):
            x ^= 1 << i
        ball.add(x)
    nodes = spark.createDataFrame([(int(np.uint64(x).view(np.int64)),) for x in ball], "fp long")
    found = links(nodes)
    assert simhash.components(found).select("component").distinct().count() == 1


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(docs).collect() == []
