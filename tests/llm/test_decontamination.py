import random
import re

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from isochron.llm import decontamination as dc
from isochron.llm.common import shared_folder
from isochron.llm.queries import queries


def plain(text):
    return [x for x in (re.sub(r"[\W_]+", "", w.lower()) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")) if x]


def distance(item, text):
    """Least edits between the item and any stretch of the text."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item):
        new = [i + 1]
        for j, b in enumerate(text):
            new.append(min(row[j] + (a != b), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def brute(docs, items, rate=0.2, least=8):
    out = {}
    for i, t in items:
        words = plain(t)
        if len(words) >= least:
            for d, text in docs:
                if (k := distance(words, plain(text))) <= int(rate * len(words)):
                    out[d, i] = k
    return out


def planted(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randint(1, 5)))
    items = [(i, " ".join(word() for _ in range(rng.randint(6, 60)))) for i in range(25)]
    docs = []
    for d in range(120):
        w = [word() for _ in range(rng.randint(0, 150))]
        if rng.random() < 0.7:
            own = rng.choice(items)[1].split()
            for _ in range(rng.randint(0, int(0.25 * len(own)) + 1)):
                at = rng.randrange(len(own))
                own[at : at + rng.randint(0, 1)] = [word()] * rng.randint(0, 1)
            at = rng.randrange(len(w) + 1)
            w[at:at] = [x.upper() + rng.choice(["", ",", "!"]) for x in own]
        docs.append((d, rng.choice([" ", "\n"]).join(w)))
    return docs, items


@pytest.mark.parametrize("seed", range(3))
def test_planted_items(spark, seed):
    docs, items = planted(seed)
    wanted = brute(docs, items)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = dc.contaminated(df, bench).collect()
    found = {(r.doc_id, r.item_id): r.distance for r in rows}
    assert len(rows) == len(found) and found.items() <= wanted.items()
    assert len(found) >= 0.99 * len(wanted) > 30
    texts, names = dict(docs), dict(items)
    for r in rows:
        stretch, item = plain(texts[r.doc_id])[r.first_word : r.end_word], plain(names[r.item_id])
        assert distance(item, stretch) == r.distance
    kept = {r.doc_id for r in dc.without_contaminated(df, bench).collect()}
    assert kept == set(texts) - {d for d, _ in found}


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    found = {(r.doc_id, r.item_id): r.distance for r in dc.contaminated(docs, bench).collect()}
    rows, items = ([tuple(r) for r in df.select(df.columns[0], "text").collect()] for df in (docs, bench))
    rows = [r for r in rows if len(r[1]) < 2500 or any(r[0] == d for d, _ in found)]
    wanted = brute(rows, items)
    assert found == wanted and found


def test_blocks_nulls_clashes(spark, monkeypatch):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    docs = spark.createDataFrame(
        [(1, None, 0), (2, "", 0), (None, f"x {item} y", 0), (4, f"x {item} y", 0), (4, f"x {item} y", 0), (5, "alpha " * 50_000, 0)],
        "doc_id long, text string, item_id int",
    )
    bench = spark.createDataFrame([(7, item), (7, item), (8, "too short"), (9, None), (None, item)], "item_id long, text string")
    monkeypatch.setattr(dc, "BLOCK", 40)
    found = sorted(map(tuple, dc.contaminated(docs, bench).collect()), key=str)
    assert found == [(4, 7, 0, 1, 11), (4, 7, 0, 1, 11), (None, 7, 0, 1, 11)]
    kept = dc.without_contaminated(docs, bench)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 5]
    assert dc.contaminated(docs.limit(0), bench).count() == dc.contaminated(docs, bench.limit(0)).count() == 0


@pytest.mark.parametrize("most", [0, 1])
def test_without_enough_tables_every_named_window_is_verified(spark, monkeypatch, most):
    """Recall is not given up where the tables would be too many: what pieces name is verified, and nothing is missed."""
    monkeypatch.setattr(dc, "MOST_TABLES", most)
    docs, items = planted(7)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([*items, *items[:3]], "item_id long, text string")
    rows = dc.contaminated(df, bench).collect()
    assert {(r.doc_id, r.item_id): r.distance for r in rows} == brute(docs, items) and len(rows) == len(brute(docs, items))


def test_short_items(spark):
    items = [(1, "Yes."), (2, "alpha beta gamma"), (3, "red green blue white black grey"), (4, "--"), (5, "")]
    docs = [(1, "oh, yes yes"), (2, "x ALPHA beta, gamma"), (3, "alpha beta delta gamma"), (4, "a red green blue wet black grey b")]
    docs += [(5, "red blue green black white grey"), (6, "-- , yess"), (7, "alpha beta\ngamma alpha beta gamma yes")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = sorted(map(tuple, dc.contaminated(df, bench, least_words=1).collect()))
    assert found == [(1, 1, 0, 1, 2), (2, 2, 0, 1, 4), (4, 3, 1, 1, 7), (7, 1, 0, 6, 7), (7, 2, 0, 0, 3)]
    assert {(d, i): k for d, i, k, _, _ in found} == brute(docs, items[:3], least=1)
    assert sorted(r.doc_id for r in dc.without_contaminated(df, bench, least_words=1).collect()) == [3, 5, 6]
    table = {"benchmark": bench, "documents": df}
    folder = dc_folder(spark, table)
    assert sorted(map(tuple, queries["op4_benchmark_decontamination"](spark, folder).collect())) == found
    assert sorted(r.doc_id for r in corpus_pipeline.decontaminated(spark, df, folder).collect()) == [3, 5, 6]


def test_items_without_an_id(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    other = "one two three four five six seven eight nine ten"
    df = spark.createDataFrame([(1, f"x {item}"), (2, f"{other} x"), (3, "x")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, item), (None, item), (None, other), (None, other), (None, None)], "item_id long, text string")
    found = sorted(map(tuple, dc.contaminated(df, bench).collect()))
    assert found == [(1, 7, 0, 1, 11), (2, None, 0, 0, 10)]
    assert [r.doc_id for r in dc.without_contaminated(df, bench).collect()] == [3]


def dc_folder(spark, tables):
    folder = shared_folder(spark, "tables")
    for name, df in tables.items():
        df.write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_scripts_without_spaces(spark):
    item = "请问下列哪一个城市是中华人民共和国的首都"
    thai = "ประเทศไทยมีเมืองหลวงชื่อว่าอะไร"
    items = [(1, item), (2, thai)]
    docs = [(1, f"前言。{item},后面还有别的文字"), (2, f"เขาถามว่า{thai}ครับ"), (3, "前言" + item[:9] + "GPT" + item[10:] + "吗"), (4, item[10:] + item[:10])]
    docs += [(5, "请 问 下列哪一个城市 是中华人民共和国 的首都"), (6, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id): (r.distance, r.first_word) for r in dc.contaminated(df, bench, least_words=1).collect()}
    assert {k: v[0] for k, v in found.items()} == {(1, 1): 0, (2, 2): 0, (3, 1): 1, (5, 1): 0} and found[1, 1][1] == 2
    assert dc.word_hashes(pa.array(["GPT模型 a", "b", "gpt 模 型"]))[1].tolist() == [0, 4, 5, 8]
    split = dc.word_hashes(pa.array(["GPT模型", "gpt 模 型"]))[0].tolist()
    assert split[:3] == split[3:]


def test_embedding_keeps_near_windows_near():
    rng = np.random.default_rng(2)
    far, near = [], []
    for _ in range(60):
        a, c = (rng.integers(1, 1 << 62, 40).astype(np.uint64) for _ in range(2))
        b = a.copy()
        b[rng.integers(40)] = 9
        x, y, z = (dc.walk(v[None], np.array([40]), 1, 60)[:, 0] for v in (a, b, c))
        near.append((x != y).mean())
        far.append((x != z).mean())
    assert np.mean(near) < 0.5 and min(far) > 0.95


def test_nearest_is_the_edit_distance():
    rng = random.Random(4)
    for _ in range(200):
        a, b = ([rng.randint(1, 4) for _ in range(rng.randint(1, 12))] for _ in range(2))
        assert dc.nearest(np.array(a, np.uint64), np.array(b, np.uint64))[0] == distance(a, b)
    assert dc.word_hashes(pa.array(["a - b", "--", "A_b"]))[1].tolist() == [0, 2, 2, 3]
