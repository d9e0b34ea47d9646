"""Finding windows of a fixed length that occur more than once in a corpus, however large its groups of copies.

A document is a sequence of numbers (hashes of words, or bytes). Every window of ``window`` of them has an *anchor*: the
place of the smallest hashed gram among its first ``span`` places. Equal windows have equal anchors, and neighbouring
windows mostly share theirs, so the windows of a document fall into runs with one anchor each. A run has

* a key ``k``: hash of the numbers that every window with this anchor holds to the right of the anchor, and
* a class ``c``: hash of all that the run covers, and of the anchor's place in it.

Equal windows lie in runs of equal key. Runs of equal class are repeats as a whole; only runs of one key and different
classes, which is where copies begin, end or differ, must be compared number by number. So only hashes are shuffled for
the bulk of the corpus:

1. ``sketch``: runs of every document. Runs that a slice of the table holds several times are settled there; one stands
   for them in the shuffle, so that a group of copies does not meet in one task.
2. ``classify``: a pass over runs sorted by key and class, which keeps one row in mind. Runs whose key occurs once end
   here, runs whose class decides are settled, the others are left open.
3. Open runs are cut from their documents and compared within their key by the caller's method; keys with more than
   ``GROUP`` open runs are compared by the hashes of their single windows instead, which needs no group in one place.
4. Settled runs are gathered by document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isochron.llm.common import MULTIPLIER, as_long, gram_hashes, mix, stored, tidy, window_argmin

GROUP = 4096
SETTLED, OPEN, WITNESS = 0, 1, 2
INVERSE = np.uint64(pow(int(MULTIPLIER), -1, 1 << 64))


@dataclass(frozen=True)
class Sampling:
    window: int
    span: int
    gram: int
    width: str = "<u8"
    """Type of the numbers where they are cut out of documents."""
    slice: int = 1 << 22
    """Bytes of text handled at once in a task; a longer text makes a slice of its own."""

    @property
    def reach(self) -> int:
        """Numbers that a window holds from its anchor on, wherever the anchor lies."""
        return self.window - (self.span - self.gram)


class Runs:
    """Runs of windows with one anchor, over rows of numbers laid end to end."""

    def __init__(self, numbers: np.ndarray, bounds: np.ndarray, sampling: Sampling):
        numbers = numbers.astype(np.uint64, copy=False)
        n, w = len(numbers), sampling.window
        size = np.diff(bounds)
        row = np.repeat(np.arange(len(size)), size)
        grams = gram_hashes(numbers, sampling.gram)
        anchor = window_argmin(grams, sampling.span - sampling.gram + 1)
        start = np.flatnonzero(np.repeat(bounds[1:], size) - np.arange(n) >= w)
        anchor = anchor[start]
        first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]])) if len(start) else start
        last = np.append(first[1:], len(start)) - 1 if len(start) else start
        self.anchor, self.start = anchor[first], start[first]
        self.count = (start[last] - self.start + 1).astype(np.int64)
        self.row = row[self.start] if n else self.start
        with np.errstate(over="ignore"):
            power = np.cumprod(np.full(n + 1, MULTIPLIER, np.uint64)) * INVERSE
            back = np.cumprod(np.full(n + 1, INVERSE, np.uint64)) * MULTIPLIER
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(numbers + np.uint64(1)) * power[:n])])

            def covered(a: np.ndarray, b: np.ndarray) -> np.ndarray:
                return mix((total[b] - total[a]) * back[a] + mix((b - a).astype(np.uint64)))

            self.key = covered(self.anchor, self.anchor + sampling.reach)
            place = mix((self.anchor - self.start).astype(np.uint64) + np.uint64(7))
            self.cls = mix(covered(self.start, self.start + self.count + w - 1) + place)


def runs_in_parts(numbers: np.ndarray, bounds: np.ndarray, sampling: Sampling) -> Iterator[tuple]:
    """``(key, class, row, first window in its row, windows)`` of all runs, with memory for ``slice`` numbers at a time.

    A part ends where a run begins, so runs come out as if all had been read at once.
    """
    at, n, more = 0, len(numbers), sampling.window - 1
    while True:
        stop = min(n, at + max(sampling.slice, 4 * sampling.window) + more)
        runs = Runs(numbers[at:stop], np.clip(bounds - at, 0, stop - at), sampling)
        last = len(runs.start)
        after = stop - more
        if stop < n and last and runs.start[-1] + runs.count[-1] + more == stop - at:  # it may go on
            last -= 1
            after = at + int(runs.start[-1])
        row, start = runs.row[:last], runs.start[:last] + at
        yield runs.key[:last], runs.cls[:last], row, start - bounds[row], runs.count[:last]
        if stop == n:
            return
        at = after


def pack(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """First window and number of windows in one number."""
    return start.astype(np.int64) << 8 | count.astype(np.int64)


def slices(batches: Iterator[pa.RecordBatch], size: int, column: str = "text") -> Iterator[pa.RecordBatch]:
    """The batches in parts of some ``size`` bytes of text."""
    for batch in batches:
        length = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(length.astype(np.int64)) // size
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)


MARK = "kind int, k long, c long, kid long, tag long, place long"


def mark_batch(kind, *columns) -> pa.RecordBatch:
    arrays = [pa.array(np.asarray(kind, np.int32)), *(pa.array(np.asarray(x, np.int64)) for x in columns)]
    return pa.RecordBatch.from_arrays(arrays, names=["kind", "k", "c", "kid", "tag", "place"])


Numbers = Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]
"""Numbers of all texts end to end, and where each text begins."""


def sketch(docs: DataFrame, numbers: Numbers, sampling: Sampling, earlier: bool) -> DataFrame:
    """Runs of every document of ``docs`` (``text, kid, tag``): ``tag`` tells rows with one ``kid`` apart by their texts."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, sampling.slice):
            for found in runs_in_parts(*numbers(part["text"]), sampling):
                yield marks_of(*found, part["kid"].to_numpy(), part["tag"].to_numpy())

    def marks_of(key, cls, row, start, count, kids, tags) -> pa.RecordBatch:
        kid, tag, place = kids[row], tags[row], pack(start, count)
        k, c = as_long(key), as_long(cls)
        order = np.lexsort((place, tag, kid, c, k))
        k, c, kid, tag, place = (x[order] for x in (k, c, kid, tag, place))
        new = np.concatenate([[True], (k[1:] != k[:-1]) | (c[1:] != c[:-1])]) if len(k) else np.empty(0, bool)
        group = np.cumsum(new) - 1
        kind = np.full(len(k), OPEN)
        if earlier:  # an earlier document of the slice has the same run
            kind[kid > kid[np.flatnonzero(new)][group]] = SETTLED
        else:  # it is there several times; the first stands for all
            several = np.bincount(group, minlength=1)[group] > 1
            kind[several] = SETTLED
            extra = new & several
            k, c, kid, tag, place = (np.concatenate([x, x[extra]]) for x in (k, c, kid, tag, place))
            kind = np.concatenate([kind, np.full(extra.sum(), WITNESS)])
        spread = as_long(mix(place.view(np.uint64) ^ mix(kid.view(np.uint64) ^ tag.view(np.uint64))))
        return mark_batch(kind, np.where(kind == SETTLED, spread, k), c, kid, tag, place)

    return docs.select("text", "kid", "tag").mapInArrow(run, MARK)


def classify(runs: DataFrame, earlier: bool) -> DataFrame:
    """Settled and open runs; runs whose key occurs once are dropped.

    ``earlier``: a run is settled if a document with a smaller id has its class; else if its class occurs twice.
    """

    def decide(k, c, kid, kind, before, after):
        """Kinds of rows, with the row before (and the least id of its class) and the row after them."""
        same_key = np.concatenate([[before is not None and before[0] == k[0]], k[1:] == k[:-1]])
        same = same_key & np.concatenate([[before is not None and before[1] == c[0]], c[1:] == c[:-1]])
        next_key = np.append(same_key[1:], after is not None and after[0] == k[-1])
        next_same = np.append(same[1:], after is not None and after[:2] == (k[-1], c[-1]))
        given = kind == SETTLED
        alone = ~same_key & ~next_key & (kind == OPEN)
        if earlier:
            first = np.maximum.accumulate(np.where(~same, np.arange(len(k)), -1))
            least = np.where(first >= 0, kid[first], before[2] if before else 0)
            out = np.where(given | (kid > least), SETTLED, OPEN)
            return np.where(alone, -1, out), least[-1], np.zeros(len(k), bool)
        several = same | next_same | (kind == WITNESS)
        out = np.where(given | (several & (kind == OPEN)), SETTLED, kind)
        shown = several & ~same & (kind == OPEN)  # one run of the class stays as a witness for others
        return np.where(alone, -1, out), 0, shown

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, before = None, None
        for batch in batches:
            rows = [batch[n].to_numpy() for n in ("kind", "k", "c", "kid", "tag", "place")]
            if held is not None:
                rows = [np.concatenate([a, b]) for a, b in zip(held, rows, strict=True)]
            if len(rows[0]) < 2:
                held = rows if len(rows[0]) else None
                continue
            held = [x[-1:] for x in rows]
            kind, k, c, kid, *rest = (x[:-1] for x in rows)
            out, least, shown = decide(k, c, kid, kind, before, (held[1][0], held[2][0]))
            before = (k[-1], c[-1], least)
            yield kept(out, shown, k, c, kid, *rest)
        if held is not None:
            kind, k, c, kid, *rest = held
            out, _, shown = decide(k, c, kid, kind, before, None)
            yield kept(out, shown, k, c, kid, *rest)

    def kept(out, shown, *rows):
        keep = out >= 0
        both = [np.concatenate([x[keep], x[shown]]) for x in rows]
        return mark_batch(np.concatenate([out[keep], np.full(shown.sum(), WITNESS)]), *both)

    return runs.repartition("k").sortWithinPartitions("k", "c", "kid", "tag", "place").mapInArrow(run, MARK)


def repeated_spans(
    docs: DataFrame,
    numbers: Numbers,
    sampling: Sampling,
    earlier: bool,
    resolve: Callable[[list[int], list[bytes], list[bool]], Iterator[tuple[int, int, int]]],
    cut: Callable[[pa.Array], Callable[[int, int, int], bytes]],
    group: int = GROUP,
) -> DataFrame:
    """``kid, tag, spans`` of the documents that hold repeated windows; spans are (first, end) in numbers.

    ``cut(texts)`` gives a function (row, first, end) -> bytes of the numbers there. ``resolve`` compares the open runs
    of one key: it gets ids, contents and whether each is only a witness, and yields (run, first, end) within it.
    """
    marks = stored(classify(sketch(docs, numbers, sampling, earlier), earlier), "marks")
    open_ = marks.where(F.col("kind") != SETTLED)
    sizes = open_.groupBy("k").agg(
        (F.min("c") < F.max("c")).alias("differ"), (F.min("kid") < F.max("kid")).alias("apart"), F.count("*").alias("runs")
    )
    sizes = sizes.where(F.col("differ") & (F.col("apart") | F.lit(not earlier))).select("k", (F.col("runs") > group).alias("wide"))
    needed = (
        open_.join(sizes, "k")
        .groupBy("kid", "tag")  # a set, since equal rows ask for the same
        .agg(F.collect_set(F.struct("k", "place", (F.col("kind") == WITNESS).alias("witness"), "wide")).alias("needs"))
    )
    w = sampling.window

    @tidy
    def contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, sampling.slice):
            take = cut(part["text"])
            out = {"k": [], "kid": [], "tag": [], "place": [], "witness": [], "wide": [], "content": []}
            owners = zip(*(part[n].to_pylist() for n in ("kid", "tag", "needs")), strict=True)
            for row, (kid, tag, needs) in enumerate(owners):
                for need in needs:
                    first, count = need["place"] >> 8, need["place"] & 255
                    out["k"].append(need["k"])
                    out["kid"].append(kid)
                    out["tag"].append(tag)
                    out["place"].append(need["place"])
                    out["witness"].append(need["witness"])
                    out["wide"].append(need["wide"])
                    out["content"].append(take(row, first, first + count + w - 1))
            for at in range(0, len(out["k"]), 8192):
                yield pa.RecordBatch.from_pydict(
                    {n: v[at : at + 8192] for n, v in out.items()},
                    pa.schema([*((n, pa.int64()) for n in ("k", "kid", "tag", "place")), ("witness", pa.bool_()), ("wide", pa.bool_()), ("content", pa.binary())]),
                )

    found = docs.select("kid", "tag", "text").join(needed, ["kid", "tag"]).select("kid", "tag", "text", "needs")
    schema = "k long, kid long, tag long, place long, witness boolean, wide boolean, content binary"
    runs = stored(found.mapInArrow(contents, schema), "open-runs")
    span_schema = "kid long, tag long, first int, end int"

    def span_batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
        columns = list(zip(*rows, strict=True)) or [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, kinds)], ["kid", "tag", "first", "end"])

    @tidy
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, members, rows = None, [], []

        def finish() -> None:
            for i, a, b in resolve(*([m[x] for m in members] for x in (0, 3, 4))):
                kid, tag, place, *_ = members[i]
                rows.append((kid, tag, (place >> 8) + a, (place >> 8) + b))

        for batch in batches:
            names = ("k", "kid", "tag", "place", "content", "witness")
            for k, *member in zip(*(batch[n].to_pylist() for n in names), strict=True):
                if k != current and members:
                    finish()
                    members = []
                    if len(rows) > 8192:
                        yield span_batch(rows)
                        rows.clear()
                current = k
                members.append(member)
        if members:
            finish()
        yield span_batch(rows)

    narrow = runs.where(~F.col("wide")).select("k", "kid", "tag", "place", "content", "witness")
    compared = narrow.repartition("k").sortWithinPartitions("k", "kid", "tag", "place").mapInArrow(compare, span_schema)

    @tidy
    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                raw = [np.frombuffer(x, sampling.width) for x in part["content"].to_pylist()]
                values = np.concatenate(raw).astype(np.uint64)
                bounds = np.concatenate([[0], np.cumsum([len(x) for x in raw])])
                counts = np.diff(bounds) - w + 1
                row = np.repeat(np.arange(len(raw)), counts)
                nth = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
                at_ = bounds[row] + nth
                hashed = [as_long(gram_hashes(mix(values + np.uint64(s)), w)[at_]) for s in (1, 2)]
                kid, tag, place = (part[n].to_numpy()[row] for n in ("kid", "tag", "place"))
                first = (place >> 8) + nth
                yield pa.RecordBatch.from_arrays(
                    [*map(pa.array, hashed), pa.array(kid), pa.array(tag), pa.array(first.astype(np.int32))],
                    names=["h1", "h2", "kid", "tag", "first"],
                )

    single = runs.where("wide").select("kid", "tag", "place", "content").mapInArrow(
        windows, "h1 long, h2 long, kid long, tag long, first int"
    )
    totals = single.groupBy("h1", "h2").agg(F.min("kid").alias("least"), F.count("*").alias("n"))
    repeated = F.col("kid") > F.col("least") if earlier else F.col("n") > 1
    by_window = (
        single.join(totals.where(F.col("n") > 1), ["h1", "h2"])
        .where(repeated)
        .select("kid", "tag", "first", (F.col("first") + w).cast("int").alias("end"))
    )
    settled = marks.where(F.col("kind") == SETTLED).select(
        "kid",
        "tag",
        F.shiftright("place", 8).cast("int").alias("first"),
        (F.shiftright("place", 8) + F.col("place").bitwiseAND(255) + (w - 1)).cast("int").alias("end"),
    )
    spans = settled.unionByName(compared).unionByName(by_window)
    # a set, since equal rows have the same spans: its size is bounded by the text, not by how often the row is there
    return spans.groupBy("kid", "tag").agg(F.collect_set(F.struct("first", "end")).alias("spans"))


def merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    """Disjoint spans in order; touching ones are one."""
    out: list[list[int]] = []
    for a, b in sorted((s["first"], s["end"]) for s in spans or ()):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]
