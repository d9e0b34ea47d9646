import base64
import random
import zlib

import numpy as np
import pytest

from corpus_pipeline import LEAST_SCORE
from isochron.llm import language


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


@pytest.fixture(scope="module")
def network(docs):
    return language.fit(docs)


def test_held_out_accuracy(docs, network):
    truth = {r.doc_id: r.lang for r in docs.collect()}
    rows = language.predict(docs, network).withColumn("held_out", language.held_out()).collect()
    assert len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out and r.lang_pred != "und"]
    assert np.mean([truth[r.doc_id] == r.lang_pred for r in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_windows_cover_the_text():
    texts = [b"a" * 256, b"b" * 257, b"c", b"d" * 1000]
    windows, row, size = language.cut(texts)
    assert [bytes(windows[row == i].reshape(-1)[: len(t)]) for i, t in enumerate(texts)] == texts
    assert np.bincount(row, size).tolist() == [256, 257, 1, 1000]


def test_pooling_is_that_of_each_filter(network):
    """The largest response of every filter, position by position."""
    text = "Größe und 12 Wörter.".encode()
    window = np.frombuffer(text.ljust(language.WINDOW, b"\0"), np.uint8)[None]
    x = np.concatenate([network.embedding[window[0]], np.zeros((3, language.EMBEDDING), np.float32)])
    best = [max((x[t : t + 4] * network.filters[:, :, f]).sum() for t in range(language.WINDOW)) for f in range(network.filters.shape[2])]
    wanted = np.maximum(np.array(best) + network.bias, 0)
    assert np.allclose(network.pooled(window)[0], wanted, atol=1e-4)


def test_nulls_repeats_long_texts(spark, network):
    rows = [(1, None), (2, ""), (3, "12 34 !!"), (None, "the thing and that"), (5, "x" * 300_000), (5, "x" * 300_000)]
    docs = spark.createDataFrame([(i, t, 1, "zz") for i, t in rows], "doc_id long, text string, score int, lang_pred string")
    found = sorted(language.predict(docs, network).collect(), key=str)
    by = {r.doc_id: r for r in found}
    assert len(found) == 6 and all(by[i].lang_pred == "und" and by[i].score == 0 for i in (1, 2, 3))
    assert by[None].lang_pred in network.langs
    kept = language.keep_identified(docs, network, 0.0)
    assert kept.columns == docs.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 5, 5]
    assert language.predict(docs.limit(0), network).count() == 0


def test_no_labels(spark):
    docs = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert language.fit(docs) is None
    assert language.predict(docs, None).first().lang_pred == "und"
    assert language.keep_identified(docs, None).count() == 0


def test_plain_forward_pass(network):
    """A whole prediction with plain loops: embedding, filters, largest response, softmax, mean over windows by bytes."""
    texts = ["Der Hund lief über die Straße. " * 3, "the " * 90]
    for text in texts:
        raw, total = text.encode(), np.zeros(len(network.langs))
        for at in range(0, len(raw), language.WINDOW):
            window = raw[at : at + language.WINDOW]
            x = np.zeros((language.WINDOW + 3, language.EMBEDDING))
            for t, b in enumerate(window):
                x[t] = network.embedding[b]
            hidden = []
            for f in range(network.filters.shape[2]):
                responses = [
                    sum(float(x[t + k] @ network.filters[k, :, f]) for k in range(4)) for t in range(language.WINDOW)
                ]
                hidden.append(max(max(responses) + float(network.bias[f]), 0.0))
            logits = np.array(hidden) @ network.dense + network.dense_bias
            e = np.exp(logits - logits.max())
            total += e / e.sum() * len(window)
        best, score = network.identify([raw])
        assert best[0] == total.argmax() and score[0] == pytest.approx(total.max() / len(raw), abs=1e-4)


def test_junk_goes_and_languages_stay(docs):
    """Shares that the stage keeps: of clean, mixed and shuffled texts, and of what is no text at all."""
    network, rng = language.fit(docs, junk=True), random.Random(3)
    held = [(r.text, r.lang) for r in docs.where(language.held_out()).collect() if r.text and any(c.isalpha() for c in r.text)]
    long = [t for t, _ in held if len(t) > 200]
    by = {lang: [t for t, x in held if x == lang and len(t) > 100] for lang in {x for _, x in held}}

    def kept(texts):
        return np.mean(network.identify([t.encode() for t in texts])[1] > LEAST_SCORE)

    assert kept([t for t, _ in held]) == 1.0
    assert kept([f"{a[:300]} {b[:300]}" for x in by for y in by if x < y for a, b in zip(by[x][:20], by[y])]) > 0.98
    assert kept([base64.b64encode(t.encode()).decode() for t in long]) == 0.0
    assert kept([t.encode().hex() for t in long]) == 0.0
    assert kept([f"{t[:600]} {base64.b64encode(t[:300].encode()).decode()}" for t in long]) > 0.98
    assert kept(["".join(rng.sample(t, len(t))) for t in long]) < 0.1
    assert kept(["".join(chr(0x400 + ord(c) * 7 % 64) if c.isalpha() else c for c in t) for t in long]) < 0.02
    assert kept(["".join(chr(rng.randrange(33, 127)) for _ in range(300)) for _ in range(50)]) == 0.0


def test_sample_is_bounded_and_has_every_language(spark, monkeypatch):
    """Thousands of rows under one id, equal texts, and a language of one row."""
    rows = [(9, f"the text number {i}", "en") for i in range(3000)] + [(11, "le même texte", "fr")] * 2000
    rows += [(13, "ein einziger Satz", "de")] + [(None, "no id", "es"), (14, None, "it"), (15, "123", "pt")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    seen = {}
    monkeypatch.setattr(language, "train", lambda texts, langs: seen.update(n={x: langs.count(x) for x in set(langs)}))
    language.fit(docs, rows_per_lang=200)
    expected = {"en", "fr", "de"} - {x for i, x in ((9, "en"), (11, "fr"), (13, "de")) if zlib.crc32(str(i).encode()) % 4 == 2}
    assert seen["n"].keys() == expected and max(seen["n"].values()) <= 200
