import random
import re
from collections import Counter

import numpy as np
import pytest

from isochron.llm.divergence import source_divergence, terms
from isochron.llm.perfect_hash import Shard, displacements, hash_keys, slots, stored_key
import pyarrow as pa

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"


def plain(rows, least, ranks=50):
    """rows: (text, lang, source)"""
    rows = [tuple(x or "" for x in r) for r in rows]
    found = [(re.findall(TERM, t.translate(LOWER)), lang, source) for t, lang, source in rows]
    docs = Counter((lang, w) for ws, lang, _ in found for w in set(ws))
    out = []
    for lang in {r[1] for r in rows}:
        kept = sorted(w for (x, w), n in docs.items() if x == lang and n >= least)
        groups = {s: Counter(w for ws, x, y in found if (x, y) == (lang, s) for w in ws if w in set(kept)) for s in {r[2] for r in rows if r[1] == lang}}
        whole = sum(groups.values(), Counter())
        p = lambda c, w: 1 + 10**9 * (c[w] + 5) // (sum(c.values()) + 5 * len(kept))
        for s, own in groups.items():
            pairs = [(o, sum(abs(p(own, w) - p(c, w)) for w in kept)) for o, c in groups.items() if o != s]
            above = [(w, p(own, w) - p(whole, w)) for w in kept if own[w] > 0 and p(own, w) > p(whole, w)]
            for part, listed in (("pair", pairs), ("term", above)):
                listed.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, k + 1) for k, (i, v) in enumerate(listed) if part == "pair" or k < ranks]
    return sorted(out)


def corpus(seed, n=260):
    rng = random.Random(seed)
    words = ["the", "The", "Œuvre", "naïve", "x", "漢字", "a b", "one", "two", "three", "four", "five", "z" * 90, "z" * 90 + "y"]
    rows = []
    for _ in range(n):
        lang = rng.choice(["en", "en", "en", "fr", None, ""])
        source = rng.choice(["web", "web", "web", "books", "Ähre", "", None, "\U0001f600"])
        own = words[: 5 + len(source or "") * 2] if rng.random() < 0.7 else words
        text = "".join(rng.choice(own) + rng.choice([" ", "-", "_", "1", "\n", "@", "\x7f"]) for _ in range(rng.choice([0, 3, 30])))
        rows.append((rng.choice([text, text, None]) if rng.random() < 0.1 else text, lang, source))
    rows += [("none of these", "de", "a"), ("nor these", "de", "b"), ("", "it", "only")] + rows[:9]
    return rows


def frame(spark, rows):
    named = [(1, *r, 2, "x") for r in rows]
    return spark.createDataFrame(named, "doc_id long, text string, lang string, source string, rank int, item string").repartition(3)


@pytest.mark.parametrize("sizes", [{}, {"tile": 2}, {"dense_bytes": 100, "round_bytes": 1}])
def test_equals_plain(spark, sizes):
    rows = corpus(1)
    got = source_divergence(frame(spark, rows), least=12, ranks=4, **sizes)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == plain(rows, 12, 4)


def test_several_shards(spark, monkeypatch):
    monkeypatch.setattr("isochron.llm.divergence.SHARD_KEYS", 3)
    rows = corpus(2)
    got = source_divergence(frame(spark, rows), least=9)
    assert sorted(map(tuple, got.collect())) == plain(rows, 9)


def test_nothing_kept_and_empty(spark):
    rows = [("one two", "en", "a"), ("one", "en", "b"), (None, None, None)]
    assert sorted(map(tuple, source_divergence(frame(spark, rows)).collect())) == plain(rows, 30)
    assert source_divergence(frame(spark, [])).collect() == []


def test_terms_are_runs_of_letters_and_of_what_is_beyond_ascii():
    texts = ["Ab1cD é-É", "", "@[`{\x7f\x00", "  x\u0085", "Straße STRASSE"]
    bounds, codes, distinct = terms(pa.array(texts))
    listed = [distinct.take(pa.array(codes[a:b])).to_pylist() for a, b in zip(bounds, bounds[1:])]
    assert listed == [re.findall(TERM, t.translate(LOWER)) for t in texts]


@pytest.mark.parametrize("n", [1, 2, 3, 7, 50, 5000])
def test_perfect_hash(n):
    keys = [f"key {i}".encode() * (1 + 20 * (i % 97 == 0)) for i in range(n)]
    h = hash_keys(keys)
    assert sorted(slots(h, displacements(h), n).tolist()) == list(range(n))
    shard, slot = Shard.of(keys)
    assert shard.lookup(keys, h).tolist() == slot.tolist()
    strange = [k + b"!" for k in keys]
    assert set(shard.lookup(strange, hash_keys(strange)).tolist()) == {-1}
    assert max(len(stored_key(k)) for k in keys) <= 64


def test_keys_with_one_hash(monkeypatch):
    monkeypatch.setattr("isochron.llm.perfect_hash.hash_keys", lambda keys: np.array([len(k) for k in keys], np.uint64))
    keys = [b"a", b"b", b"cc", b"d", b"ee"]
    shard, slot = Shard.of(keys)
    assert sorted(slot.tolist()) == list(range(5))
    assert shard.lookup([*keys, b"x"], np.array([1, 1, 2, 1, 2, 1], np.uint64)).tolist() == [*slot.tolist(), -1]


def test_hash_is_that_of_spark(spark):
    words = ["", "a", "Œuvre", "x" * 100]
    rows = spark.createDataFrame([(w,) for w in words], "w string").selectExpr("w", "xxhash64(w) AS h").collect()
    assert {r.w: r.h for r in rows} == dict(zip(words, hash_keys([w.encode() for w in words]).view(np.int64).tolist()))
