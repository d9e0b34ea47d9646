"""Language identification with a convolutional network over bytes, trained and applied in numpy.

A text is cut into windows of ``WINDOW`` bytes, the last one padded with zeros. Bytes are embedded, filters of several
widths run over them, each filter's largest response in the window is kept, and a softmax layer gives the languages'
probabilities. A text's probabilities are the mean over all its windows, weighted by their bytes.

The network is fitted on the driver on a bounded sample: at most ``ROWS_PER_LANG`` labelled rows of each language, and
one at least, drawn by a hash of id and text, and at most ``SLICE`` characters from a place that the hash draws as well.
Predictions use nothing but the text, and cover every window of every text.

To sort out what is no language at all, a network can be fitted with one more class, learned from the sample itself
torn up: its letters shuffled, its bytes in base64 or as digits, and random letters of other scripts. The score of a text
is then the probability of any language, which texts in several languages have as well.

Defined results: a null text, and one without a letter, is ``und`` with score 0; so is every text when no row is
labelled. Equal texts get equal predictions; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isochron.llm.common import tidy

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDING = 6
ROWS_PER_LANG = 1200
SLICE = 1024
UNKNOWN = "und"


@dataclass
class ByteNetwork:
    langs: list[str]
    embedding: np.ndarray  # byte, dimension; the padding byte stays zero
    filters: np.ndarray  # position in the widest filter, dimension, filter; zero beyond a filter's width
    bias: np.ndarray
    dense: np.ndarray
    dense_bias: np.ndarray

    def pooled(self, windows: np.ndarray) -> np.ndarray:
        """Largest response of each filter in each window, before the softmax layer."""
        n, length = windows.shape
        widest = len(self.filters)
        padded = np.zeros((n, length + widest - 1), np.uint8)
        padded[:, :length] = windows
        embedded = self.embedding[padded]
        spans = np.lib.stride_tricks.sliding_window_view(embedded, widest, axis=1)  # window, place, dimension, position
        flat = spans.transpose(0, 1, 3, 2).reshape(n * length, -1)
        response = (flat @ self.filters.reshape(-1, self.filters.shape[2])).reshape(n, length, -1)
        return np.maximum(response.max(axis=1) + self.bias, 0)

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        return softmax(self.pooled(windows) @ self.dense + self.dense_bias)

    def identify(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Number of the likeliest language and its probability, for texts that are not empty."""
        windows, row, size = cut(texts)
        total = np.zeros((len(texts), len(self.langs)))
        for i in range(0, len(windows), 128):
            own = slice(i, i + 128)
            np.add.at(total, row[own], self.probabilities(windows[own]) * size[own, None])
        mean = total / np.bincount(row, size, len(texts))[:, None]
        if UNKNOWN in self.langs:  # the likeliest of the languages, and the probability of any language
            junk = mean[:, self.langs.index(UNKNOWN)].copy()
            mean[:, self.langs.index(UNKNOWN)] = -1
            return mean.argmax(axis=1), np.clip(1 - junk, 0, 1)
        return mean.argmax(axis=1), np.clip(mean.max(axis=1), 0, 1)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def cut(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of all texts, the text of each, and its bytes."""
    sizes = np.array([len(t) for t in texts])
    each = -(-sizes // WINDOW)
    padded = b"".join(t + b"\0" * (-len(t) % WINDOW) for t in texts)
    row = np.repeat(np.arange(len(texts)), each)
    place = np.arange(len(row)) - np.repeat(np.cumsum(each) - each, each)
    return np.frombuffer(padded, np.uint8).reshape(-1, WINDOW), row, np.minimum(WINDOW, sizes[row] - place * WINDOW)


def train(texts: list[str], langs: list[str], epochs: int = 8, rate: float = 0.01, batch: int = 64, seed: int = 7) -> ByteNetwork:
    """Fit by Adam on the windows of the texts, some of them cut short so that short texts are known too."""
    names = sorted(set(langs))
    rng = np.random.default_rng(seed)
    windows, row, _ = cut([t.encode("utf-8") for t in texts])
    windows = windows.copy()
    short = np.flatnonzero(rng.random(len(windows)) < 0.35)
    for i, n in zip(short, rng.integers(4, 80, len(short)), strict=True):
        windows[i, n:] = 0
    label = np.array([names.index(x) for x in langs])[row]
    weight = len(label) / (len(names) * np.bincount(label, minlength=len(names)))
    widest, out = max(WIDTHS), FILTERS * len(WIDTHS)
    inside = np.repeat(np.array([[p < w for w in WIDTHS] for p in range(widest)]), FILTERS, axis=1)[:, None, :]
    p = {
        "embedding": rng.normal(0, 0.5, (256, EMBEDDING)),
        "filters": rng.normal(0, 0.3, (widest, EMBEDDING, out)) * inside,
        "bias": np.zeros(out),
        "dense": rng.normal(0, 0.2, (out, len(names))),
        "dense_bias": np.zeros(len(names)),
    }
    p = {k: v.astype(np.float32) for k, v in p.items()}
    p["embedding"][0] = 0
    first, second = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), batch):
            own = order[at : at + batch]
            x, n = windows[own], len(own)
            padded = np.zeros((n, WINDOW + widest - 1), np.uint8)
            padded[:, :WINDOW] = x
            embedded = p["embedding"][padded]
            flat = np.concatenate([embedded[:, i : i + WINDOW] for i in range(widest)], axis=2)
            response = flat.reshape(n * WINDOW, -1) @ p["filters"].reshape(-1, out)
            response = response.reshape(n, WINDOW, out)
            where = response.argmax(axis=1)
            best = np.take_along_axis(response, where[:, None, :], 1)[:, 0] + p["bias"]
            hidden = np.maximum(best, 0)
            prob = softmax(hidden @ p["dense"] + p["dense_bias"])
            prob[np.arange(n), label[own]] -= 1
            prob *= weight[label[own]][:, None] / n
            back = (prob @ p["dense"].T) * (best > 0)
            taken = flat[np.arange(n)[:, None], where]  # window, filter, span
            d_filters = np.einsum("nfs,nf->sf", taken, back).reshape(p["filters"].shape) * inside
            d_span = back[:, :, None] * p["filters"].reshape(-1, out).T[None]  # window, filter, span
            d_embedding = np.zeros_like(p["embedding"])
            for i in range(widest):
                np.add.at(d_embedding, padded[np.arange(n)[:, None], where + i], d_span[:, :, i * EMBEDDING : (i + 1) * EMBEDDING])
            d_embedding[0] = 0
            grads = {
                "embedding": d_embedding, "filters": d_filters, "bias": back.sum(axis=0),
                "dense": hidden.T @ prob, "dense_bias": prob.sum(axis=0),
            }
            step += 1
            now = rate * (1 - epoch / epochs)
            for k, g in grads.items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.001 * (g * g - second[k])
                p[k] -= now * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-7)
    return ByteNetwork(names, **{k: v.astype(np.float32) for k, v in p.items()})


def held_out(id_col: str = "doc_id") -> Column:
    """Rows kept from training; a row without id is none of them, and is not learned from either."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def fit(
    docs: DataFrame, id_col="doc_id", text_col="text", lang_col="lang", rows_per_lang: int = ROWS_PER_LANG, junk: bool = False
) -> ByteNetwork | None:
    """Learn from labelled rows that are not held out; None if there are none. With ``junk`` also what no language is."""
    known = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")
    ).where(F.col("id").isNotNull() & F.col("text").rlike(r"\p{L}") & F.col("lang").isNotNull() & ~held_out("id"))
    counts = known.groupBy("lang").count()
    longest = F.greatest(F.char_length("text") - F.lit(SLICE), F.lit(0)) + 1
    start = (F.pmod(F.xxhash64("id", "text", F.lit(1)), longest) + 1).cast("int")
    part = F.substring("text", start, F.lit(SLICE)).alias("text")
    drawn = known.select("lang", F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30)).alias("drawn"), part)
    # somewhat more than are wanted, then the first of them: a bounded number, whatever ids and texts they have
    share = F.lit(1.5 * rows_per_lang + 100) / F.col("count") * F.lit(float(1 << 30))
    some = drawn.join(F.broadcast(counts), "lang").where(F.col("drawn") < share)  # one row for each language
    place = F.row_number().over(Window.partitionBy("lang").orderBy("drawn", "text"))
    some = some.select("lang", "text", place.alias("place")).where(F.col("place") <= rows_per_lang).select("lang", "text")
    first = drawn.groupBy("lang").agg(F.min(F.struct("drawn", "text"))["text"].alias("text"))
    rows = sorted((r.lang, r.text) for r in some.unionByName(first.join(some, ["lang", "text"], "left_anti")).collect())
    if not rows:
        return None
    if junk:
        rows += [(UNKNOWN, t) for t in torn([t for _, t in rows], rows_per_lang)]
    return train([t for _, t in rows], [x for x, _ in rows])


def torn(texts: list[str], most: int, seed: int = 11) -> list[str]:
    """Texts that are no language, made from the sample: as many as a language has, of each kind a share."""
    rng = np.random.default_rng(seed)
    out = []
    for i in rng.permutation(len(texts))[:most].tolist():
        text, kind = texts[i], len(out) % 6
        raw = text.encode("utf-8")[: SLICE]
        if kind == 0:
            made = "".join(rng.permutation(list(text)).tolist())
        elif kind == 1:
            made = base64.b64encode(bytes(rng.permutation(list(raw)).tolist())).decode()
        elif kind == 2:
            made = raw[: SLICE // 2].hex()
        elif kind == 3:  # letters at random, in words of random length
            letters = sorted({c for c in text.lower() if c.isalpha()}) or ["x"]
            made = "".join(rng.choice([*letters, " "], len(text)).tolist())
        elif kind == 4:
            first = int(rng.choice([0x370, 0x400, 0x5D0, 0x620, 0x900, 0xE00, 0x3040, 0x4E00, 0xAC00]))
            made = "".join(chr(first + int(x)) for x in rng.integers(0, 60, min(len(text), 300)))
        else:
            made = "".join(chr(int(x)) for x in rng.integers(33, 127, len(text)))
        out.append(made)
    return out


def lettered(text: Column) -> Column:
    """The text, or null where it has no letter."""
    return F.when(text.rlike(r"\p{L}"), text)


def identify(batches: Iterator[pa.RecordBatch], network: ByteNetwork | None, text_col: str):
    """Slices of the batches, with the languages and scores of their texts."""
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            part = batch.slice(at, 1024)
            texts = part[text_col].cast(pa.binary()).to_pylist()
            lang, score = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
            rows = [i for i, t in enumerate(texts) if t is not None] if network else []
            if rows:
                best, score[rows] = network.identify([texts[i] for i in rows])
                lang[rows] = np.array(network.langs, object)[best]
            yield part, lang, score


def predict(docs: DataFrame, network: ByteNetwork | None, id_col="doc_id", text_col="text") -> DataFrame:
    """``doc_id, lang_pred, score`` of every row."""
    given = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), lettered(F.col(text_col).cast("string")).alias("text")
    )

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, lang, score in identify(batches, network, "text"):
            columns = [part["doc_id"], pa.array(lang, pa.string()), pa.array(score)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang_pred", "score"])

    return given.mapInArrow(run, "doc_id long, lang_pred string, score double")


def keep_identified(docs: DataFrame, network: ByteNetwork | None, least: float = 0.5, text_col="text") -> DataFrame:
    """Rows whose language is identified with more than this score, with all their columns; nothing is shuffled.

    Of a network that knows junk, the score is the probability of any language.
    """
    lettered_col = "__lettered"
    while lettered_col in docs.columns:
        lettered_col += "_"

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, lang, score in identify(batches, network, lettered_col):
            good = (lang != UNKNOWN) & (score > least)
            yield part.drop_columns([lettered_col]).filter(pa.array(good, pa.bool_()))

    given = docs.withColumn(lettered_col, lettered(F.col(text_col).cast("string")))
    return given.mapInArrow(run, docs.schema)
