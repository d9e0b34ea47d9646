import random
import re

import numpy as np
import pyarrow as pa
import pytest

from isochron.llm.components import components
from isochron.llm.common import keyed
from isochron.llm.jaccard import (
    Scheme, lists_of_several, near_duplicates, one_of_each, open_lists, scanned, shingle_sets, shortest_lists, signatures, sketch,
)


def shingles(text, k):
    table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(table))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set())


def brute(rows, k, least):
    """rows: (id or None, text)"""
    sets = [shingles(t, k) for _, t in rows]
    home = list(range(len(rows)))

    def find(x):
        while home[x] != x:
            x = home[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            both = len(a & b)
            if both and 100 * both >= least * (len(a) + len(b) - both):
                home[find(i)] = find(j)
    members = {}
    for i in range(len(rows)):
        members.setdefault(find(i), []).append(rows[i][0])
    ids = {c: min((m for m in ms if m is not None), default=None) for c, ms in members.items()}
    return sorted(((rows[i][0], len(sets[i]), ids[find(i)]) for i in range(len(rows))), key=str)


def random_texts(seed, n=90):
    """Texts with copies at all distances around the threshold, short ones and long ones."""
    rng = random.Random(seed)
    texts = []
    for _ in range(n):
        if texts and rng.random() < 0.65:
            w = rng.choice(texts[-30:]).split()
            for _ in range(rng.choice([0, 1, 1, 1, 2, 3, 5])):
                at = rng.randrange(len(w) + 1)
                w[at : at + rng.randint(0, 1)] = rng.choices("abcdefghijklmnop", k=rng.randint(0, 1))
                w = w + rng.choices("qrstuvw", k=rng.choice([0, 0, 1]))
        else:
            w = ["".join(rng.choices("abcdef", k=2)) for _ in range(rng.choice([0, 1, 2, 3, 6, 12, 15, 22, 30, 60, 150, 400]))]
        texts.append(" ".join(x.upper() if rng.random() < 0.05 else x for x in w))
    return texts


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, kid int, component string").repartition(3)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize(("seed", "least", "k"), [(0, 90, 3), (1, 90, 3), (2, 80, 5), (3, 80, 5)])
def test_random_texts(spark, seed, least, k):
    rows = list(enumerate(random_texts(seed)))
    wanted = brute(rows, k, least)
    assert len({r[2] for r in wanted}) < len(rows) - 15
    assert rows_of(near_duplicates(frame(spark, rows), Scheme(least, k))) == wanted


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert rows_of(near_duplicates(docs)) == brute(rows, 3, 90)


ROWS = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (9, "A b"), (None, "a b"), (None, "zz"), (5, " \n"), (6, "x " * 100_000), (5, " \n")]


def test_nulls_ties_repeats(spark):
    assert rows_of(near_duplicates(frame(spark, ROWS))) == brute(ROWS, 3, 90)
    assert rows_of(near_duplicates(frame(spark, ROWS).limit(0))) == []


def test_one_of_each(spark):
    kept = one_of_each(frame(spark, ROWS), Scheme(80, 5))
    assert kept.columns == ["doc_id", "text", "kid", "component"]
    found = sorted(((r.doc_id, (r.text or "")[:3]) for r in kept.collect()), key=str)
    assert found == sorted([(1, ""), (2, ""), (3, "a b"), (None, "zz"), (5, " \n"), (5, " \n"), (6, "x x")], key=str)


def test_one_of_each_class_without_an_id_or_with_a_shared_one(spark):
    rows = [(None, "one two three four"), (None, "five six seven"), (None, "five six seven"), (4, "eight nine"), (4, "ten")]
    rows += [(None, f"text {i} of many without an id") for i in range(6000)]  # more than 24 bits tell apart
    kept = one_of_each(frame(spark, rows), Scheme(80, 5))
    assert rows_of(kept.select("doc_id", "text")) == sorted(set(rows), key=str)


@pytest.mark.parametrize("least", [80, 90])
def test_scheme(least):
    """Classes, light sizes and part counts hold for every pair of sizes that can link."""
    scheme = Scheme(least)
    assert scheme.light >= 9
    for a in range(1, 400):
        for b in range(a, a * 100 // least + 1):
            both = a  # the largest overlap
            if not scheme.linked(both, a, b):
                continue
            shared = set(scheme.classes(a)) & set(scheme.classes(b))
            assert shared
            low = next(i for i in range(a + 1) if scheme.linked(i, a, b))
            assert a - low <= scheme.missing(a) and b - low <= scheme.missing(b)
            assert any(a + b - 2 * low <= scheme.differing(c) < scheme.parts(c) for c in shared)


@pytest.mark.parametrize("least", [80, 90])
def test_linked_sets_share_the_lists_they_must(least):
    """Also after each of them has left out as many lists as it may, whatever the order."""
    scheme, rng = Scheme(least), np.random.default_rng(least)
    for _ in range(300):
        n = int(rng.integers(20, 900))
        a = rng.integers(0, 1 << 63, n).astype(np.uint64)
        b = a[int(rng.integers(0, n * (100 - least) // 100 + 1)) :]
        b = np.concatenate([b, rng.integers(0, 1 << 63, int(rng.integers(0, n * (100 - least) // 100 + 1))).astype(np.uint64)])
        if not scheme.linked(len(np.intersect1d(a, b)), len(a), len(b)):
            continue
        rows, names, kinds, _ = signatures(np.concatenate([np.sort(a), np.sort(b)]), np.array([0, n, n + len(b)]), scheme)
        lists = [{(k, x) for k, x in zip(kinds[rows == i].tolist(), names[rows == i].tolist(), strict=True)} for i in (0, 1)]
        classes = [{k >> 32: k & 0xFFFFFFFF for k, _ in x if k} for x in lists]
        names = [{c: [x for k, x in y if k and k >> 32 == c] for c in z} for y, z in zip(lists, classes, strict=True)]
        for c in set(classes[0]) & set(classes[1]):
            need = max(classes[0][c], classes[1][c])
            common = set(names[0][c]) & set(names[1][c])
            assert len(common) >= need or need == 1
            left = [set(sorted(names[i][c])[: len(names[i][c]) - classes[i][c] + 1]) for i in (0, 1)]
            assert not common or left[0] & left[1]


def test_a_passage_in_common_makes_no_pairs(spark):
    """Documents that share half of their words stand in the same lists, and any two of them would leave the scan."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    passage = [word() for _ in range(500)]
    texts = [" ".join(passage + [word() for _ in range(500)]) for _ in range(60)]
    near = [" ".join(texts[i].split()[:-40]) for i in range(4)]
    rows = list(enumerate(texts + near))
    scheme, docs = Scheme(80, 5), frame(spark, rows)
    found = lists_of_several(sketch(keyed(docs, "doc_id", "text").withColumnRenamed("khash", "tag"), scheme)).cache()
    sets = found.where("kid IS NOT NULL").drop("list", "kind", "kid", "tag")
    member = open_lists(found.where("kid IS NULL").select("list", "sid", "kind"), sets, None)
    met = scanned(shortest_lists(member), sets, scheme)
    assert met.distinct().count() >= 4 and met.count() < 60
    assert rows_of(near_duplicates(docs, scheme)) == brute(rows, 5, 80)


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(40)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(found[a] == found[b] for a, b in edges if a != b)
    assert {found[i] for i in range(41)} == {0} and {found[100 + i] for i in range(30)} == {100}
    assert all(found[c] == c <= n for n, c in found.items())


def test_sets_of_a_slice():
    texts = pa.array(["É à B", "x Y", "Größe B c D", None, "b C d"]).fill_null("")
    whole, bounds = shingle_sets(texts, 3)
    for a in range(5):
        part, at = shingle_sets(texts[a:], 3)
        assert part.tolist() == whole[bounds[a] :].tolist() and at.tolist() == (bounds[a:] - bounds[a]).tolist()
    assert whole[bounds[4]] in whole[bounds[2] : bounds[3]]
