"""Every stage against a plain version of it, on the rows that the stage before left."""

import random

import public_tokenizers
import pytest
import test_decontamination
import test_jaccard
import test_packing

import corpus_pipeline as pipeline
from isochron.llm import language
from isochron.llm.suffix_dedup import whole_characters

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def results(spark, tmp_path_factory):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = [docs]
    for name, stage in pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, out[-1], SF_DIR).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_names_and_columns(results):
    assert [n for n, _ in pipeline.STAGES] == [
        "language_id", "ngram_jaccard_join", "suffix_array_dedup", "benchmark_decontamination", "best_fit_packing"
    ]
    assert all(r.schema == results[0].schema for r in results[1:5])


def test_language(results):
    given, kept = rows(results[0]), rows(results[1])
    said = rows(language.predict(results[0], language.fit(results[0], junk=True)))
    assert kept == {i: r for i, r in given.items() if said[i].lang_pred != "und" and said[i].score > pipeline.LEAST_SCORE}
    assert len(kept) > 0.9 * len(given)


def test_near_copies(results):
    given, kept = rows(results[1]), rows(results[2])
    classes = test_jaccard.brute([(i, r.text) for i, r in given.items()], 5, 80)
    assert kept == {i: given[i] for i, n, c in classes if i == c} and len(kept) < len(given)


def plain_cuts(raw, window):
    """Maximal runs of bytes that windows starting twice or more cover, of each text."""
    starts = {}
    for x in raw:
        for a in range(len(x) - window + 1):
            k = hash(x[a : a + window])
            starts[k] = starts.get(k, 0) + 1
    found = []
    for x in raw:
        cuts = []
        for a in range(len(x) - window + 1):
            if starts[hash(x[a : a + window])] > 1:
                if cuts and a <= cuts[-1][1]:
                    cuts[-1] = (cuts[-1][0], a + window)
                else:
                    cuts.append((a, a + window))
        found.append(cuts)
    return found


def test_unique_texts(results):
    given, kept = rows(results[2]), rows(results[3])
    raw = {i: r.text.encode() for i, r in given.items()}
    assert kept.keys() == given.keys()
    for (i, x), cuts in zip(raw.items(), plain_cuts(list(raw.values()), 240), strict=True):
        long = [(a, b) for a, b in cuts if len(x[a:b].split()) >= 50 or b - a >= 400]
        assert kept[i].text == whole_characters(x, long) and kept[i].n_chars == len(kept[i].text)


def test_passages_of_over_fifty_words_go(spark):
    """Passages that several documents share, each among words of its own; shorter ones stay."""
    rng = random.Random(1)

    def words(n):
        return ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.choice([2, 3, 4, 5, 6, 7, 9]))) for _ in range(n)]

    passages = [words(n) for n in (51, 52, 55, 60, 80, 200)]
    short = words(40)
    documents, own = [], []
    for i in range(60):
        before, after = words(rng.randint(0, 150)), words(rng.randint(5, 150))
        middle = passages[i % 7] if i % 7 < 6 else short
        documents.append((i, " ".join([*before, *middle, *after]), "en", "s", 0))
        own.append((before, after))
    docs = spark.createDataFrame(documents, "doc_id long, text string, lang string, source string, n_chars long")
    found = {r.doc_id: r.text for r in pipeline.unique_texts(spark, docs, SF_DIR).collect()}
    for i, (before, after) in enumerate(own):
        if i % 7 == 6:
            assert found[i] == documents[i][1]
        else:
            assert found[i].split() == [*before, *after] or abs(len(found[i]) - len(" ".join([*before, *after]))) < 12
            assert " ".join(passages[i % 7][2:-2]) not in found[i]


def test_decontaminated(spark, results):
    given, kept = rows(results[3]), rows(results[4])
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    gone = given.keys() - kept.keys()
    sure = [(i, given[i].text) for i in given if i in gone or given[i].n_chars < 2500]
    hit = {d for d, _ in test_decontamination.brute(sure, items)}
    assert gone == hit and kept == {i: given[i] for i in kept} and gone


def test_packed(results):
    texts = {i: r.text for i, r in rows(results[4]).items()}
    ids = dict(zip(texts, test_packing.library_ids(list(texts.values())), strict=True))
    test_packing.check(results[5].collect(), ids, 2048)


def test_cuts_keep_characters_whole():
    text = "aéé日b".encode()
    for a in range(len(text) + 1):
        for b in range(a, len(text) + 1):
            gone = [c for k, c in enumerate("aéé日b") if a <= len("aéé日b"[:k].encode()) and len("aéé日b"[: k + 1].encode()) <= b]
            assert whole_characters(text, [(a, b)]) == "aéé日b".replace("".join(gone), "", 1) or len(gone) == 1


def test_nulls_repeats_and_empty_tables(spark, tmp_path):
    long = "the quick brown fox jumps over the lazy dog again and " * 40
    data = [(1, None, None, None, None), (None, "the thing", "en", "s", 9), (3, "", "en", "s", 0), (4, long, "en", "s", 1), (4, long, "en", "s", 1)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    for given in (docs, docs.limit(0)):
        last = given
        for k, (name, stage) in enumerate(pipeline.STAGES):
            path = str(tmp_path / f"{given is docs}-{k}")
            stage(spark, last, SF_DIR).write.parquet(path)
            last = spark.read.parquet(path)
            assert k == 4 or last.columns == docs.columns, name
    alone = spark.createDataFrame(data, docs.schema).where("text IS NULL OR text = ''")
    assert pipeline.unique_texts(spark, alone, SF_DIR).count() == pipeline.decontaminated(spark, alone, SF_DIR).count() == 2
    assert public_tokenizers.path("byte_bpe_50k.json")
