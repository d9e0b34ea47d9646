"""Document fingerprints by a homomorphic multiset hash of paragraphs.

A paragraph (a line of the text) is hashed to a wide vector: ``DIGEST`` numbers modulo 2**64 drawn from its whole text,
and ``SKETCH`` counts modulo 2**32, to which each of its runs of three words adds +1 or -1 at a hashed place; a text of
2 GiB, the most a row holds, has fewer than 2**31 runs. A document's fingerprint is the sum of its paragraphs' vectors. So it does not depend on their order, equal multisets of
paragraphs give equal fingerprints, and a paragraph is put in or taken out by adding or subtracting its vector.

``likeness`` of two fingerprints is the cosine of their counts, at least 0: about the share of three-word runs that the
texts have in common, with a deviation of some 1/sqrt(SKETCH) for unrelated ones. Equal fingerprints have likeness 1.

Defined results: a null text is empty, and has one empty paragraph; rows that share an id follow each other by text; a
row without id comes after all others; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isochron.llm.common import as_long, gram_hashes, hash_words, keyed, tidy, words

DIGEST = 8
SKETCH = 256
RUN = 3


def vectors(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Digest and sketch parts of the fingerprint of each text."""
    lines = pc.split_pattern(pa.array(texts, pa.large_string()), "\n")
    bounds = lines.offsets.to_numpy()
    paragraphs = lines.flatten()
    doc = np.repeat(np.arange(len(texts)), np.diff(bounds))
    return digests(paragraphs, doc, len(texts)), sketches(paragraphs, doc, len(texts))


def digests(paragraphs: pa.Array, doc: np.ndarray, n: int) -> np.ndarray:
    hashed = b"".join(hashlib.blake2b(p.as_buffer()).digest() for p in paragraphs.cast(pa.large_binary()))
    each = np.frombuffer(hashed, "<u8").reshape(-1, DIGEST)
    total = np.zeros((n, DIGEST), np.uint64)
    np.add.at(total, doc, each)  # wraps modulo 2**64
    return total


def sketches(paragraphs: pa.Array, doc: np.ndarray, n: int) -> np.ndarray:
    bounds, codes, distinct = words(paragraphs)
    hashes = hash_words(distinct)[codes]
    size = np.diff(bounds)
    place = np.arange(len(codes)) - np.repeat(bounds[:-1], size)
    left = np.repeat(size, size) - place
    own = np.repeat(doc, size)
    long_runs = gram_hashes(hashes, RUN)
    inside = left[: len(long_runs)] >= RUN
    few = np.repeat(size < RUN, size)  # paragraphs with fewer words: each word by itself
    parts = [(own[: len(long_runs)][inside], long_runs[inside]), (own[few], gram_hashes(hashes, 1)[few])]
    row, h = (np.concatenate(x) for x in zip(*parts, strict=True))
    sign = 1.0 - 2.0 * ((h >> np.uint64(40)) & np.uint64(1)).astype(np.float64)
    at = row * SKETCH + as_long(h & np.uint64(SKETCH - 1))
    counts = np.bincount(at, sign, n * SKETCH).reshape(n, SKETCH)
    return counts.astype(np.int64).astype(np.uint32)  # modulo 2**32


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Row by row, from 0 to 1."""
    x, y = (v[1].view(np.int32).astype(np.float64) for v in (a, b))
    size = np.sqrt((x * x).sum(axis=1) * (y * y).sum(axis=1))
    cosine = np.divide((x * y).sum(axis=1), size, out=np.zeros(len(x)), where=size > 0)
    same = (a[0] == b[0]).all(axis=1) & (a[1] == b[1]).all(axis=1)
    return np.where(same, 1.0, np.clip(cosine, 0, 1))


def texts_of(parts: tuple[np.ndarray, np.ndarray]) -> list[str]:
    """Fingerprints as base64 text."""
    return [base64.b64encode(d.tobytes() + s.tobytes()).decode() for d, s in zip(*parts, strict=True)]


def of_text(fingerprint: str) -> tuple[np.ndarray, np.ndarray]:
    raw = base64.b64decode(fingerprint)
    return np.frombuffer(raw[: 8 * DIGEST], "<u8")[None], np.frombuffer(raw[8 * DIGEST :], "<u4")[None]


def changed(fingerprint: str, added: tuple[str, ...] = (), removed: tuple[str, ...] = ()) -> str:
    """The fingerprint after paragraphs were put in and taken out, without the rest of the text."""
    digest, sketch = (x.copy() for x in of_text(fingerprint))
    for paragraphs, sign in ((added, 1), (removed, -1)):
        for p in paragraphs:
            d, s = vectors([p])
            digest, sketch = (digest + d, sketch + s) if sign > 0 else (digest - d, sketch - s)
    return texts_of((digest, sketch))[0]


def fingerprint(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """``doc_id, fingerprint`` of every row, in one pass without a shuffle."""
    given = keyed(docs, id_col, text_col).select("doc_id", "text")

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                made = texts_of(vectors(part["text"].to_pylist()))
                yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(made, pa.string())], ["doc_id", "fingerprint"])

    return given.mapInArrow(run, "doc_id long, fingerprint string")


def with_next(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """Rows in buckets of consecutive ids, each bucket followed by the row that comes after it.

    ``bucket, part, role, kid, khash, doc_id, text``; role 1 marks the copied row. Bounds of the buckets are quantiles of
    the ids, so texts are shuffled once; besides them only one row for each bucket is looked up. Rows under one id are in
    the order of their texts' hashes; an id with more rows than a bucket should have gets a bucket of its own, which is
    cut into parts by these hashes.
    """
    spark = docs.sparkSession
    given = keyed(docs, id_col, text_col)
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = given.groupBy("kid").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).first()[0]
    if not total:
        return given.withColumns({"bucket": F.lit(0), "part": F.lit(0), "role": F.lit(0)})
    share = -(-total // buckets)
    hot = {r.kid: -(-r.n // share) for r in counts.where(F.col("n") > max(share, 1)).collect()}  # as many as buckets at most
    ids = docs.select(F.col(id_col).cast("double").alias("id"))
    cuts = ids.approxQuantile("id", [i / buckets for i in range(1, buckets)], 0.2 / buckets)
    around = {float(x) for kid in hot for x in (kid, kid + 1)}
    splits = [float("-inf"), *sorted({0.0, *cuts, *around}), float("inf")]
    given = given.withColumn("place", F.col("kid").cast("double"))
    dealt = Bucketizer(splits=splits, inputCol="place", outputCol="bucket").transform(given)
    dealt = dealt.withColumn("bucket", F.col("bucket").cast("int")).drop("place")
    parts = F.lit(1)
    for kid, n in hot.items():
        parts = F.when(F.col("kid") == kid, n).otherwise(parts)
    # the hash, as the order has it, counted from the least one: its first 31 bits give the part
    upper = F.shiftright("khash", 33) + (1 << 30)
    dealt = dealt.withColumn("part", F.shiftright(upper * parts, 31).cast("int"))
    least = dealt.groupBy("bucket", "part").agg(F.min(F.struct("kid", "khash")).alias("head")).collect()
    heads = sorted((r.bucket, r.part, r["head"].kid, r["head"].khash) for r in least)
    before = [heads[i - 1][:2] for i in range(len(heads))]  # the first row follows the last bucket
    peeks = spark.createDataFrame(
        [(kid, khash, *to) for (*_, kid, khash), to in zip(heads, before, strict=True)],
        "kid long, khash long, target int, target_part int",
    )
    copies = (
        dealt.select("kid", "khash", "doc_id", "text")
        .join(F.broadcast(peeks), ["kid", "khash"])  # one row for each bucket
        .groupBy("target", "target_part", "kid", "khash", "doc_id")
        .agg(F.min("text").alias("text"))
        .select(
            "doc_id", "text", "kid", "khash", F.col("target").alias("bucket"), F.col("target_part").alias("part"), F.lit(1).alias("role")
        )
    )
    rows = dealt.withColumn("role", F.lit(0)).unionByName(copies)
    return rows.repartition("bucket", "part").sortWithinPartitions("bucket", "part", "role", "kid", "khash", "text")


def edited_likeness(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """Fingerprints of each text and of its edited text, and how like they are.

    The edited text has its last ``floor(n / 2)`` code points replaced by the first as many (or all) of the next row's
    text in the order of ids; after the last row comes the first.
    """
    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )

    def results(rows: list[tuple[int | None, str, str]]) -> pa.RecordBatch:
        ids, texts, following = (list(x) for x in zip(*rows, strict=True))
        edited = [t[: len(t) - len(t) // 2] + n[: len(t) // 2] for t, n in zip(texts, following, strict=True)]
        m = len(rows)
        digest, sketch = vectors([*texts, *edited, *following])
        own, other, after = ((digest[i : i + m], sketch[i : i + m]) for i in (0, m, 2 * m))
        columns = [
            pa.array(ids, pa.int64()),
            pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(t.encode("utf-8")).hexdigest() for t in edited], pa.string()),
            pa.array(texts_of(own), pa.string()),
            pa.array(texts_of(other), pa.string()),
            pa.array(likeness(own, other)),
            pa.array(likeness(own, after)),
        ]
        return pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in schema.split(", ")])

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, rows, chars = None, [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256).to_pydict()
                for doc, text, role in zip(part["doc_id"], part["text"], part["role"], strict=True):
                    if waiting is not None:
                        rows.append((*waiting, text))
                        chars += len(waiting[1])
                    waiting = None if role else (doc, text)
                    if len(rows) >= 256 or chars > 1 << 21:
                        yield results(rows)
                        rows, chars = [], 0
        if rows:
            yield results(rows)

    return with_next(docs, id_col, text_col).select("doc_id", "text", "role").mapInArrow(run, schema)
