import hashlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from isochron.llm import fingerprints as fp

LINES = st.lists(st.text("ab \t", max_size=12), min_size=1, max_size=6)


def one(text):
    return fp.texts_of(fp.vectors([text]))[0]


@settings(max_examples=60, deadline=None)
@given(LINES, st.randoms())
def test_order_does_not_matter_and_edits_are_increments(lines, random):
    mixed = list(lines)
    random.shuffle(mixed)
    assert one("\n".join(lines)) == one("\n".join(mixed))
    grown = fp.changed(one("\n".join(lines)), added=("new line here",))
    assert grown == one("\n".join([*lines, "new line here"]))
    assert fp.changed(grown, removed=("new line here",)) == one("\n".join(lines))


def brute(rows):
    ordered = sorted(rows)
    out = {}
    for i, (doc, text) in enumerate(ordered):
        following = ordered[(i + 1) % len(ordered)][1]
        n = len(text)
        out[doc] = (n, hashlib.sha256((text[: n - n // 2] + following[: n // 2]).encode()).hexdigest(), one(text))
    return out


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    wanted = brute([(r.doc_id, r.text or "") for r in docs.collect()])
    rows = fp.edited_likeness(docs.repartition(5)).collect()
    assert {r.doc_id: (r.n_chars, r.edited_sha256, r.fingerprint) for r in rows} == wanted and len(rows) == len(wanted)
    long = [r for r in rows if r.n_chars > 500]
    assert np.mean([r.near_edited for r in long]) > 0.4 and np.mean([r.near_next for r in long]) < 0.15
    assert all(0 <= x <= 1 for r in rows for x in (r.near_edited, r.near_next))


def test_run_repeated_very_often(spark):
    for n in (40_000, 100_000, 131_072):
        one_run, half = (fp.vectors(["a b c\n" * m]) for m in (n, n // 2))
        assert fp.likeness(one_run, half)[0] > 0.999
        assert fp.likeness(one_run, fp.vectors(["a b c\n" * 30_000]))[0] > 0.999
        assert abs(fp.of_text(fp.texts_of(one_run)[0])[1].view(np.int32)).max() == n
    docs = spark.createDataFrame([(1, "a b c\n" * 40_000), (2, "z")], "doc_id long, text string")
    assert fp.edited_likeness(docs).where("doc_id = 1").first().near_edited > 0.999


def test_nulls_ties_repeats(spark):
    rows = [(None, "z z z"), (1, None), (3, "b" * 9), (3, "a c e"), (3, "a c e"), (7, "é" * 200_000)]
    docs = spark.createDataFrame([(i, t, 0, 0) for i, t in rows], "doc_id long, text string, kid int, role int")
    found = fp.edited_likeness(docs).collect()
    assert sorted((r.doc_id if r.doc_id is not None else 99, r.n_chars) for r in found) == [(1, 0), (3, 5), (3, 5), (3, 9), (7, 200_000), (99, 5)]
    by = {(r.doc_id, r.n_chars): r for r in found}
    assert by[7, 200_000].edited_sha256 == hashlib.sha256(("é" * 100_000 + "z z z").encode()).hexdigest()
    assert by[None, 5].edited_sha256 == hashlib.sha256(b"z z").hexdigest()  # the first text is empty
    assert fp.edited_likeness(docs.limit(0)).count() == 0
    assert fp.edited_likeness(docs.where("doc_id = 7")).first().near_next == 1.0
    assert fp.fingerprint(docs).count() == 6


def test_many_rows_under_one_id(spark):
    """A third of the rows share an id, others have none: they are dealt to several buckets, and each has its next row."""
    rows = [(5, f"text {i}") for i in range(400)] + [(None, f"none {i}") for i in range(300)] + [(i, f"own {i}") for i in range(6, 506)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    dealt = fp.with_next(docs).where("role = 0").groupBy("bucket", "part").count().collect()
    assert max(r["count"] for r in dealt) < 400 / 3
    found = fp.edited_likeness(docs).collect()
    assert sorted((r.doc_id is None, r.doc_id, r.n_chars) for r in found) == sorted((i is None, i, len(t)) for i, t in rows)
    order = {None: 2, 5: 0}
    edited = {r.edited_sha256 for r in found}
    # of the rows under one id the order is that of hashes; the row after the last of them is known
    texts = [t for i, t in sorted(rows, key=lambda r: (order.get(r[0], 1), r[0] or 0))]
    for a, b in zip(texts[401:899], texts[402:900]):  # ids of their own
        assert hashlib.sha256((a[: len(a) - len(a) // 2] + b[: len(a) // 2]).encode()).hexdigest() in edited
    assert len(fp.with_next(docs).where("role = 1").collect()) == len(dealt)
