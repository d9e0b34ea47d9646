import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from isochron.llm import substring_dedup as sub
from isochron.llm import suffix_dedup as suf
from isochron.llm.repeats import Sampling, runs_in_parts

WORDS = Sampling(5, span=4, gram=1, slice=1 << 9)
BYTES = Sampling(12, span=8, gram=3, width="u1", slice=1 << 9)


def random_texts(seed, n=60):
    """Random words with copied passages, some with changes, and copies of whole texts."""
    rng = random.Random(seed)
    letters = "ab" if seed % 3 == 0 else "abcdefgh"
    word = lambda: "".join(rng.choice(letters) for _ in range(rng.randint(1, 3 + seed % 4)))
    texts = []
    passage = [word() for _ in range(9)]
    for _ in range(n):
        own = [word() for _ in range(rng.randint(0, 25))]
        for _ in range(rng.randint(0, 2)):
            source = rng.choice(texts).split() if texts and rng.random() < 0.6 else passage
            a = rng.randrange(len(source) + 1)
            at = rng.randrange(len(own) + 1)
            own[at:at] = source[a : a + rng.randint(1, 14)]
        texts.append(rng.choice([" ", "\n", "  "]).join(own))
        if rng.random() < 0.1:
            texts.append(texts[-1])
    return texts


def brute_words(rows, w):
    """rows: (id or None, text)"""
    order = lambda i: (i is None, i)
    first = {}
    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    for (i, _), x in zip(rows, split, strict=True):
        for a in range(len(x) - w + 1):
            key = tuple(x[a : a + w])
            first[key] = min(first.get(key, order(i)), order(i))
    out = []
    for (i, _), x in zip(rows, split, strict=True):
        gone = set()
        for a in range(len(x) - w + 1):
            if first[tuple(x[a : a + w])] < order(i):
                gone.update(range(a, a + w))
        out.append((i, len(x), len(gone), " ".join(y for k, y in enumerate(x) if k not in gone)))
    return sorted(out, key=str)


def brute_bytes(rows, w):
    starts = defaultdict(int)
    raw = [(t or "").encode() for _, t in rows]
    for x in raw:
        for a in range(len(x) - w + 1):
            starts[x[a : a + w]] += 1
    out = []
    for (i, _), x in zip(rows, raw, strict=True):
        gone = np.zeros(len(x) + 1, bool)
        for a in range(len(x) - w + 1):
            if starts[x[a : a + w]] > 1:
                gone[a : a + w] = True
        runs = int((gone[:-1] & ~np.concatenate([[False], gone[:-2]])).sum()) if len(x) else 0
        out.append((i, len(x), int(gone.sum()), runs, bytes(b for b, g in zip(x, gone[:-1], strict=True) if not g)))
    return sorted(out, key=str)


def word_rows(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in df.collect()), key=str)


def byte_rows(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in df.collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, kid int, spans string").repartition(3)


@pytest.mark.parametrize("group", [4096, 2])
@pytest.mark.parametrize("seed", range(4))
def test_random_texts(spark, seed, group):
    rows = list(enumerate(random_texts(seed)))
    assert word_rows(sub.without_earlier_passages(frame(spark, rows), sampling=WORDS, group=group)) == brute_words(rows, 5)
    assert byte_rows(suf.without_repeated_bytes(frame(spark, rows), sampling=BYTES, group=group)) == brute_bytes(rows, 12)


def test_nulls_ties_repeats(spark):
    text = "one two three four five six seven"
    rows = [(1, None), (2, ""), (3, text), (3, text), (3, "zero " + text), (None, text), (4, "x " + text + " y"), (5, "a" * 3000), (6, " \t\n")]
    found = word_rows(sub.without_earlier_passages(frame(spark, rows), sampling=WORDS))
    assert found == brute_words(rows, 5)
    assert byte_rows(suf.without_repeated_bytes(frame(spark, rows), sampling=BYTES)) == brute_bytes(rows, 12)
    empty = frame(spark, rows).limit(0)
    assert word_rows(sub.without_earlier_passages(empty)) == byte_rows(suf.without_repeated_bytes(empty)) == []


def test_rows_without_id_whose_hashes_nearly_agree(spark):
    """Two texts of one null id, hashes alike in their last 24 bits: what is found in one is not cut from the other."""
    common = "the same words again and again " * 40

    def tag(text):
        return xxhash.xxh64_intdigest(text, 42) & 0xFFFFFF

    seen, i = {}, 0
    while True:
        a, b = f"{i} {common}", " ".join(f"{i}.{k}" for k in range(300))
        seen.setdefault(tag(a), [None, None])[0] = a
        seen.setdefault(tag(b), [None, None])[1] = b
        both = next((p for t in (tag(a), tag(b)) if all(p := seen[t])), None)
        if both:
            break
        i += 1
    rows = [(None, both[0]), (None, both[1]), (1, common)]
    assert byte_rows(suf.without_repeated_bytes(frame(spark, rows))) == brute_bytes(rows, 400)
    rows = [(1, common), (None, both[0]), (None, both[1])]
    assert word_rows(sub.without_earlier_passages(frame(spark, rows))) == brute_words(rows, 13)


def test_many_rows_without_id(spark):
    """20,000 rows under one null id, some equal: nothing that is gathered for a text grows with the rows equal to it."""
    rng = random.Random(5)
    texts = ["".join(rng.choices("abcde ", k=60)) for _ in range(400)]
    rows = [(None, rng.choice(texts) + rng.choice(["", "", " " + rng.choice(texts)])) for _ in range(20_000)]
    rows += [(None, "x" * 30 + " one text that very many rows hold " + "y" * 30)] * 20_000
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = byte_rows(suf.without_repeated_bytes(docs, sampling=BYTES))
    assert found == brute_bytes(rows, 12)
    small = rows[:600] + rows[-600:]
    docs = spark.createDataFrame(small, "doc_id long, text string").repartition(4)
    assert word_rows(sub.without_earlier_passages(docs, sampling=WORDS)) == brute_words(small, 5)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = word_rows(sub.without_earlier_passages(docs))
    assert found == brute_words(rows, 13) and any(r[2] for r in found)
    found = byte_rows(suf.without_repeated_bytes(docs))
    assert found == brute_bytes(rows, 400) and any(r[2] for r in found)


@pytest.mark.parametrize("seed", range(20))
def test_orders(seed):
    rng = random.Random(seed)
    start = bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 200)))
    strings = [start + bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 12))) for _ in range(rng.randint(1, 60))]
    strings += rng.choices(strings, k=5)
    for shallow in (0, 8, 64):
        order = suf.deep_shallow_order(strings, shallow=shallow)
        assert sorted(order) == list(range(len(strings)))
        assert [strings[i] for i in order] == sorted(strings)
    a, b = rng.choices(strings, k=2)
    n = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    assert suf.common_prefix(a, b) == n


def test_automaton_knows_the_substrings():
    rng = random.Random(3)
    added = [[rng.randrange(3) for _ in range(rng.randint(0, 9))] for _ in range(12)]
    automaton = sub.SuffixAutomaton()
    for k, sequence in enumerate(added):
        automaton.add(sequence)
        known = {tuple(s[a:b]) for s in added[: k + 1] for a in range(len(s)) for b in range(a + 1, len(s) + 1)}
        asked = [rng.randrange(3) for _ in range(30)]
        longest = [max((n for n in range(i + 2) if tuple(asked[i + 1 - n : i + 1]) in known), default=0) for i in range(30)]
        assert list(automaton.matches(asked)) == longest


@pytest.mark.parametrize("seed", range(60))
def test_runs_do_not_depend_on_the_parts(seed):
    rng = np.random.default_rng(seed)
    sampling = WORDS if seed % 2 else BYTES
    bounds = np.concatenate([[0], np.cumsum(rng.integers(0, 120, rng.integers(0, 6)))])
    numbers = rng.integers(0, rng.integers(1, 5), bounds[-1]).astype(np.uint64)

    def runs(size):
        parts = runs_in_parts(numbers, bounds, Sampling(sampling.window, sampling.span, sampling.gram, slice=size))
        return [row for part in parts for row in zip(*(x.tolist() for x in part))]

    whole = runs(10**6)
    assert all(runs(size) == whole for size in (1, 7, 30, 50))
    windows = [(row, start + k) for _, _, row, start, count in whole for k in range(count)]
    sizes = np.diff(bounds)
    assert windows == [(r, a) for r in range(len(sizes)) for a in range(sizes[r] - sampling.window + 1)]
