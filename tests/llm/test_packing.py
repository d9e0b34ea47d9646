import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from isochron.llm.packing import IdEncoder, Plan, pack

from test_token_counts import TEXTS

PATH = public_tokenizers.path("byte_bpe_50k.json")


def library_ids(texts):
    return [[*e.ids, 0] for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]


def check(rows, ids, capacity):
    """Every id of every document once, in gapless sequences; ``ids`` by doc_id."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert by_doc.keys() == ids.keys()
    for doc, own in by_doc.items():
        at = 0
        for k, r in enumerate(sorted(own, key=lambda r: r.piece)):
            assert (r.piece, r.start) == (k, at)
            part = ids[doc][at : at + r.length]
            assert zlib.crc32(np.array(part, "<u4").tobytes()) == r.ids_crc32
            assert k == 0 or r.length == capacity
            at += r.length
        assert at == len(ids[doc])
    for spans in by_sequence.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_ids_are_the_librarys():
    found = IdEncoder(PATH)(TEXTS)
    assert [np.frombuffer(x, "<u4").tolist() for x in found] == [x[:-1] for x in library_ids(TEXTS)]


@pytest.mark.parametrize("seed", range(6))
def test_plan_is_near_the_bound(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(1, 257, 3000) if seed % 2 else np.minimum(rng.geometric(0.03, 3000), 256)
    counts = np.bincount(lengths, minlength=257)
    plan = Plan(counts)
    filled = np.zeros(plan.sequences, np.int64)
    placed = np.zeros(257, np.int64)
    rows = sorted(plan.rows)
    for (n, first, sequence, copies, _), after in zip(rows, [*rows[1:], (0,) * 5]):
        upto = after[1] if after[0] == n else counts[n]
        m = (upto - first) // copies
        filled[sequence : sequence + m] += copies * n
        placed[n] += m * copies
    assert (placed == counts).all() and filled.max() <= 256
    assert plan.sequences <= 1.02 * -(-lengths.sum() // 256) + 1


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    ids = dict(zip(texts, library_ids(list(texts.values())), strict=True))
    n = check(pack(docs.repartition(3, "source"), PATH).collect(), ids, 2048)
    assert n <= 1.05 * sum(map(len, ids.values())) / 2048 + 1


def test_nulls_ties_long_texts(spark):
    rows = [(1, None, 0), (2, "", 0), (3, "word " * 5000, 0), (4, "a b c", 0), (None, "a b c", 0), (6, "a b c", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length long")
    ids = dict(zip([r[0] for r in rows], library_ids([r[1] or "" for r in rows]), strict=True))
    found = pack(docs, PATH, with_ids=True).collect()
    check(found, ids, 2048)
    assert all(np.frombuffer(r.ids, "<u4").tolist() == ids[r.doc_id][r.start : r.start + r.length] for r in found)
    assert pack(docs.limit(0), PATH).count() == 0
    twice = pack(docs.union(docs), PATH).collect()
    assert len(twice) == 2 * len(found)
    places = defaultdict(int)
    for r in twice:
        places[r.sequence_id] += r.length
    assert max(places.values()) <= 2048 and sum(places.values()) == 2 * sum(map(len, ids.values()))


def test_spaces_do_not_matter(spark):
    texts = [" a", "a ", "a  b", "a \n b", "a\n b", "a \nb", "a\n\n b c\t d", "\n", " ", "a\x0bb c", "don't 'll 've", "end.\nNext one"]
    found = IdEncoder(PATH)(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in found] == [x[:-1] for x in library_ids(texts)]


def test_a_word_is_asked_of_the_library_once():
    """Of words in plenty, too; a unit that is one pre-token and the pre-token in a longer unit are one word."""
    encode, asked = IdEncoder(PATH), []
    model = encode.pieces.model

    class Counted:
        def tokenize(self, shown):
            asked.append(shown)
            return model.tokenize(shown)

    encode.pieces.model = Counted()
    names = [f"w{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}{'uvwxyz'[i // 100 % 6]}{chr(97 + i // 600 % 26)}{chr(97 + i // 15600)}" for i in range(150_000)]
    first = encode(["x " + " ".join(names)])
    assert len(asked) == len(set(asked)) == 150_001
    assert encode(["x " + " ".join(names)]) == first and len(asked) == 150_001
    text = f"x {names[-1]}, {names[-2]}. x"
    assert encode([text]) == encode.ids([text]) and len(asked) <= 150_004
