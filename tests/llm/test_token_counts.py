import json

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from isochron.llm.token_counts import RankMerger, count_tokens

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    "", " ", "Hello, world's END", "aaaaaaaaaaaaaaaaa bbbb aa aaa", "ß Übergrößen 12345 ½ ² naïve école",
    "<|endoftext|>", "a<|endoftext|>b <|startoftext|><|endoftext|", "ΑΣ ΣΑΣ İstanbul", "日本語 テスト　x \x1c y\x85z\xa0w",
    "it's we'll I'M 'S _under__score_ $$$!!&&&", "x" * 5000, "é" * 300 + " 🙂🙂👍🏽", "a\x00b\n\n\tc",
]


def expected(texts):
    library = Tokenizer.from_file(PATH)
    return [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_counts_are_the_librarys():
    assert RankMerger(PATH).count(TEXTS) == expected(TEXTS)


def test_long_texts():
    """Far beyond the longest pre-token of the tables, in one piece and in many."""
    long = ["ab" * 60_000, "word " * 30_000, "Ünï-" * 20_000 + "<|endoftext|>" + "x" * 50_000]
    assert RankMerger(PATH).count(long) == expected(long)


def test_special_strings_are_those_of_the_file(tmp_path):
    """A vocabulary whose special strings look like ordinary words."""
    spec = json.load(open(PATH, encoding="utf-8"))
    for token, name in zip(spec["added_tokens"], ("[sep]", "END")):
        token["content"] = name
    path = str(tmp_path / "vocabulary.json")
    with open(path, "w", encoding="utf-8") as f:
        json.dump(spec, f)
    texts = ["a [sep] b", "[sep][sep]", "the END", "ENDED", "<|endoftext|>", "end [SEP]"]
    library = Tokenizer.from_file(path)
    assert RankMerger(path).count(texts) == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001"])
def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = count_tokens(docs, PATH).collect()
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    ids = sorted(texts)
    wanted = dict(zip(ids, expected([texts[i] for i in ids]), strict=True))
    assert {r.doc_id: r.n_tokens for r in rows} == wanted
    assert all(r.n_bytes == len(texts[r.doc_id].encode()) and r.over_limit == (r.n_tokens > 2048) for r in rows)


def test_nulls_repeats_extra_columns(spark):
    docs = spark.createDataFrame([(1, None, 5), (None, "a b", 6), (2, "x", 7), (2, "x", 7)], "doc_id long, text string, n_tokens long")
    rows = sorted(count_tokens(docs, PATH).collect(), key=str)
    assert [(r.doc_id, r.n_bytes, r.n_tokens) for r in rows] == [(1, 0, 0), (2, 1, 1), (2, 1, 1), (None, 3, 2)]
    assert count_tokens(docs.limit(0), PATH).count() == 0
