"""N-gram Jaccard join: a size-aware heavy-light set similarity join.

A document's set is its distinct shingles of ``words`` words, as 64-bit hashes; with fewer words the whole sequence is
the one shingle, without words the set is empty and links with nothing. Sets link when intersection / union is at least
``least / 100``. The join is exact, and gives classes of linked documents instead of all pairs:

* *Light* sets enumerate their subsets of every size that an overlap with a linked set can have. The largest light size
  is where enumerating would cost more than the lists of the heavy way (``Scheme.light``).
* *Heavy* sets are cut, by a hash of the shingles, into more parts than linked sets of their size can differ in; linked
  sets then agree on whole parts, and on one that is not empty unless both have more empty parts than the slack allows.
  Lists are inverted by the part's hash. A list of single shingles would be as long as the shingle is common; one of
  whole parts holds little but near copies. Sets with too many empty parts are also listed under the first few of their
  shingles in hash order, of which linked sets share one.

Equal sets are one node. Each list has a centre (a star), every node is checked against the few centres it shares most
lists with, and components are formed; this is done ``ROUNDS`` times, for what is outside of its list's main component.
Lists that then still hold several components are scanned whole: members outside of their list's main component meet all
others, and the pairs that sizes and parity sketches allow (both are bounds, no estimates) are checked exactly.

A set also knows how many lists of a class it must share with any linked one: its filled parts, less as many as linked
sets can differ in elements. A set with fewer lists than that has no link there, and one with more may leave out its
longest ones, all but one of those it must share: linked sets meet in what is left. Most documents that merely have a
passage in common share a few long lists and so do not meet. Pairs that share many lists come out of the scan in the least
of those among the first ``FIRST`` of both, not in every one. So no link between different components is lost, and no
pairs within a group of copies are made.

Checks read whole texts. The members of a centre are spread over as many tasks as they need (``MEMBERS`` each), and each
task meets the centre once.

Defined results: a null text has no words; equal rows, and rows sharing an id, are documents of their own; a component's
id is its smallest id, null only if no member has one; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property, reduce
from itertools import combinations
from math import comb, exp

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isochron.llm.common import NO_ID, as_long, gram_hashes, hash_words, keyed, mix, stored, tidy, words
from isochron.llm.components import components
from isochron.llm.repeats import slices

SLICE = 1 << 21
MEMBERS = 256
LIST_COST = 4
CALL_BYTES, BROADCAST_BYTES = 48, 8 << 20
"""Bytes of a call or a row of them, as Spark lays them out, and as many as are broadcast."""
ROUNDS = 3
STARS = 4
PARITY = 16
FIRST = 12


@dataclass(frozen=True)
class Scheme:
    """How sets of each size are listed for links of at least ``least`` percent."""

    least: int = 90
    words: int = 3
    stretch: int = 2

    def linked(self, both: int, one: int, other: int) -> bool:
        return 100 * both >= self.least * (one + other - both) and both > 0

    def missing(self, n: int) -> int:
        """Elements of a set of n that a linked set can lack."""
        return n - -(-self.least * n // 100)

    def shared(self, n: int, filled: int, c: int) -> int:
        """Fewest lists of class c that a set of n with so many filled parts has in common with a linked set there."""
        other = min(100 * n // self.least, self.bounds[c + 1] - 1)
        return max(filled - (n + other) * (100 - self.least) // (100 + self.least), 1)

    def subsets(self, n: int) -> int:
        return sum(comb(n, d) for d in range(self.missing(n) + 1))

    @cached_property
    def light(self) -> int:
        """Largest size whose subsets cost no more than the entries of the heavy way, each of which is scanned."""
        n = 1
        while self.subsets(n + 1) <= LIST_COST * sum(self.parts(c) for c in self.classes(n + 1)):
            n += 1
        return n

    @cached_property
    def bounds(self) -> list[int]:
        """First size of each size class; sizes of linked sets differ by less than the width of a class."""
        found = [1]
        while found[-1] < 1 << 40:
            top = found[-1]
            for _ in range(self.stretch):
                top = top * 100 // self.least
            found.append(max(top, found[-1]) + 1)
        return found

    def classes(self, n: int) -> list[int]:
        """Classes in which a set of n is listed: its own, and the next if a linked set can be there."""
        own = bisect_right(self.bounds, n) - 1
        return [own, own + 1] if 100 * n >= self.least * self.bounds[own + 1] else [own]

    def differing(self, c: int) -> int:
        """Most elements by which linked sets listed in class c differ, both sides together."""
        return 2 * (self.bounds[c + 1] - 1) * (100 - self.least) // (100 + self.least)

    def slack(self, c: int) -> int:
        """Parts that may be empty: those of a small set of the class, as a rule, and some more."""
        most, extra = self.differing(c), 2
        while 1.5 * (most + 1 + extra) * exp(-self.bounds[c] / (most + 1 + extra)) + 2 > extra and extra <= most:
            extra += 1
        return extra

    @cached_property
    def _parts(self) -> dict[int, int]:
        return {}

    def parts(self, c: int) -> int:
        if c not in self._parts:
            self._parts[c] = self.differing(c) + 1 + self.slack(c)
        return self._parts[c]


def shingle_sets(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text in ascending order, end to end, and where each text's begin."""
    bounds, codes, distinct = words(texts)
    hashes = hash_words(distinct, lower=True)[codes]
    size = np.diff(bounds)
    row = np.repeat(np.arange(len(size)), size)
    left = np.repeat(bounds[1:], size) - np.arange(len(codes))
    grams = gram_hashes(hashes, k)
    inside = np.flatnonzero(left[: len(grams)] >= k)
    rows, found = [row[inside]], [grams[inside]]
    for n in range(1, k):
        short = np.flatnonzero(size == n)
        rows.append(short)
        found.append(gram_hashes(hashes, n)[bounds[short]] if len(short) else np.empty(0, np.uint64))
    row, h = np.concatenate(rows), np.concatenate(found)
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (row[1:] != row[:-1])]) if len(h) else np.empty(0, bool)
    row, h = row[new], h[new]
    return h, np.searchsorted(row, np.arange(len(size) + 1))


def row_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values)])
    return total[bounds[1:]] - total[bounds[:-1]]


def set_ids(h: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """64-bit name of each set: equal for equal sets."""
    with np.errstate(over="ignore"):
        first, second = row_sums(mix(h), bounds), row_sums(mix(h ^ np.uint64(0x5851F42D4C957F2D)), bounds)
        return mix(first ^ mix(second + np.diff(bounds).astype(np.uint64)))


def parity(h: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For each set 64 * ``PARITY`` bits, each telling whether an odd number of elements falls to it."""
    n = len(bounds) - 1
    row = np.repeat(np.arange(n), np.diff(bounds))
    bit = (h & np.uint64(64 * PARITY - 1)).astype(np.int64)
    odd = np.bincount(row * 64 * PARITY + bit, minlength=n * 64 * PARITY) & 1
    return np.packbits(odd.astype(np.uint8).reshape(n, -1), axis=1, bitorder="little").view("<i8")


def signatures(h: np.ndarray, bounds: np.ndarray, scheme: Scheme) -> tuple[np.ndarray, ...]:
    """Row of each list entry, the list's name and kind; and for each row its filled parts in its own class, at least 0.

    A kind is 0 where one list in common may be all, else the class and, below it, ``Scheme.shared`` in 32 bits.
    """
    size = np.diff(bounds)
    spread = mix(h ^ np.uint64(0x2545F4914F6CDD1D))
    rows, names, own_parts = [np.empty(0, np.int64)], [np.empty(0, np.uint64)], np.zeros(len(size), np.int64)
    kinds = [np.empty(0, np.int64)]
    with np.errstate(over="ignore"):
        for i in np.flatnonzero((size > 0) & (size <= scheme.light)):
            own = spread[bounds[i] : bounds[i + 1]]
            whole = own.sum(dtype=np.uint64)
            for d in range(scheme.missing(len(own)) + 1):
                without = [sum(c) & ((1 << 64) - 1) for c in combinations(own.tolist(), d)]
                left = whole - np.array(without, np.uint64) + np.uint64(len(own) - d)
                names.append(mix(left))
                rows.append(np.full(len(left), i))
                kinds.append(np.zeros(len(left), np.int64))
        # sets that a heavy one can link with are listed the heavy way, too
        heavy = np.flatnonzero(100 * size >= scheme.least * (scheme.light + 1))
        entries = [(i, c, k == 0) for i in heavy for k, c in enumerate(scheme.classes(int(size[i])))]
        if entries:
            row, cls, first = np.array(entries, np.int64).T
            parts = np.array([scheme.parts(c) for c in cls])
            slack = np.array([scheme.slack(c) for c in cls])
            offset = np.cumsum(parts) - parts
            count = size[row]
            entry = np.repeat(np.arange(len(row)), count)
            place = np.arange(len(entry)) - np.repeat(np.cumsum(count) - count, count) + bounds[row][entry]
            dealt = mix(h[place] + mix(cls.astype(np.uint64) + np.uint64(11))[entry])
            part = (dealt % parts[entry].astype(np.uint64)).astype(np.int64)
            total = np.zeros(parts.sum(), np.uint64)
            filled = np.zeros(parts.sum(), np.int64)
            np.add.at(total, offset[entry] + part, spread[place])
            np.add.at(filled, offset[entry] + part, 1)
            of = np.repeat(np.arange(len(row)), parts)
            number = np.arange(len(of)) - offset[of]
            name = mix(total + mix(cls.astype(np.uint64)[of] * np.uint64(1 << 32) + number.astype(np.uint64) + np.uint64(1)))
            rows.append(row[of][filled > 0])
            names.append(name[filled > 0])
            full = np.add.reduceat((filled > 0).astype(np.int64), offset)
            facts = zip(size[row].tolist(), full.tolist(), cls.tolist(), strict=True)
            kind = np.array([(c + 1) << 32 | scheme.shared(n, f, c) for n, f, c in facts], np.int64)
            kinds.append(kind[of][filled > 0])
            own = (first == 1) & (size[row] > scheme.light)
            own_parts[row[own]] = full[own]
            for i in np.unique(row[parts - full > slack]):  # too few parts to rely on
                prefix = h[bounds[i] : bounds[i] + scheme.missing(int(size[i])) + 1]
                names.append(mix(prefix ^ np.uint64(0x9E6C63D0876A9A47)))
                rows.append(np.full(len(prefix), i))
                kinds.append(np.zeros(len(prefix), np.int64))
    return np.concatenate(rows), np.concatenate(names), np.concatenate(kinds), own_parts


PARITIES = [f"p{i + 1}" for i in range(PARITY)]
CARRIED = ["q1", "q2", "q3", "q4"]
LISTS = ", ".join(f"{c} long" for c in ("list", "sid", "kind", "kid", "tag", "n", "parts", *PARITIES))
FACTS = ["kid", "tag", "n", "parts", *PARITIES]
NEED = "(kind & 4294967295)"


def sketch(docs: DataFrame, scheme: Scheme) -> DataFrame:
    """Two kinds of rows: ``list, sid, kind`` for each list entry, and the facts of each document with a random list."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in LISTS.split(", ")]
        for part in slices(batches, SLICE):
            h, bounds = shingle_sets(part["text"], scheme.words)
            sid = set_ids(h, bounds)
            size = np.diff(bounds)
            kid = part["kid"].to_numpy()
            tag = part["tag"].to_numpy()
            bits = parity(h, bounds)
            anywhere = as_long(mix(kid.view(np.uint64) + tag.view(np.uint64)))
            _, one, of = np.unique(sid, return_index=True, return_inverse=True)  # equal sets of the slice are listed once
            listed, held = h_of(h, bounds, one)
            row, name, kind, full = signatures(listed, held, scheme)
            facts = [anywhere, as_long(sid), np.zeros(len(sid), np.int64), kid, tag, size, full[of], *bits.T]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in facts], names=names)
            for at in range(0, len(row), 1 << 18):
                own = slice(at, at + (1 << 18))
                columns = [pa.array(as_long(name[own])), pa.array(as_long(sid[one][row[own]])), pa.array(kind[own])]
                nulls = [pa.nulls(len(columns[0]), pa.int64()) for _ in names[3:]]
                yield pa.RecordBatch.from_arrays([*columns, *nulls], names=names)

    return docs.select("text", "kid", "tag").mapInArrow(run, LISTS)


def h_of(h: np.ndarray, bounds: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sets of some rows, end to end."""
    size = np.diff(bounds)[rows]
    held = np.concatenate([[0], np.cumsum(size)])
    at = np.arange(held[-1]) - np.repeat(held[:-1], size) + np.repeat(bounds[rows], size)
    return h[at], held


def lists_of_several(rows: DataFrame) -> DataFrame:
    """Entries of lists with several rows, and the facts.

    A pass over sorted rows that keeps one of them in mind, so a list may be of any length.
    """
    names = [x.split()[0] for x in LISTS.split(", ")]

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, before = None, None
        for batch in batches:
            fact = batch["kid"].is_valid()
            facts = batch.filter(fact)
            if facts.num_rows:
                yield facts
            name, sid, kind = (x.to_numpy() for x in batch.filter(pc.invert(fact)).columns[:3])
            if held is not None:
                name, sid, kind = (np.concatenate(x) for x in zip(held, (name, sid, kind), strict=True))
            if len(name) < 2:
                held = (name, sid, kind) if len(name) else None
                continue
            held = name[-1:], sid[-1:], kind[-1:]
            yield several(name[:-1], sid[:-1], kind[:-1], before, name[-1])
            before = name[-2], sid[-2]
        if held is not None:
            yield several(*held, before, None)

    def several(name, sid, kind, before, after):
        same = np.concatenate([[before is not None and before[0] == name[0]], name[1:] == name[:-1]])
        again = same & np.concatenate([[before is not None and before[1] == sid[0]], sid[1:] == sid[:-1]])
        more = np.append(same[1:], after is not None and after == name[-1])
        keep = (same | more) & ~again
        columns = [pa.array(name[keep]), pa.array(sid[keep]), pa.array(kind[keep])]
        nulls = [pa.nulls(len(columns[0]), pa.int64()) for _ in names[3:]]
        return pa.RecordBatch.from_arrays([*columns, *nulls], names=names)

    return rows.repartition("list").sortWithinPartitions("list", "sid").mapInArrow(run, LISTS)


def checked(docs: DataFrame, facts: DataFrame, pairs: DataFrame, scheme: Scheme) -> DataFrame:
    """Those of the ``pairs`` (``centre, sid``) that link, as edges ``a, b``, and for each node one text is read."""
    places = pairs.groupBy("centre").agg(F.ceil(F.count("*") / MEMBERS).cast("int").alias("tasks"))
    spread = pairs.join(places, "centre").select(
        "centre", "sid", F.pmod(F.xxhash64("sid"), F.col("tasks")).cast("int").alias("task"), F.lit(1).alias("role")
    )
    hosts = places.select(
        "centre", F.col("centre").alias("sid"), F.explode(F.sequence(F.lit(0), F.col("tasks") - 1)).alias("task"), F.lit(0).alias("role")
    )
    one = facts.groupBy("sid").agg(F.min(F.struct("kid", "tag")).alias("doc"))
    wanted = (
        spread.unionByName(hosts)
        .join(one, "sid")
        .groupBy(F.col("doc.kid").alias("kid"), F.col("doc.tag").alias("tag"))
        .agg(F.collect_set(F.struct("centre", "task", "role", "sid")).alias("calls"))
    )
    wanted = stored(wanted, "wanted")
    calls, texts = wanted.agg(F.coalesce(F.sum(F.size("calls")), F.lit(0)), F.count("*")).first()
    if CALL_BYTES * (calls + texts) <= BROADCAST_BYTES:  # beyond that the texts are shuffled
        wanted = F.broadcast(wanted)
    sent = (
        docs.select("kid", "tag", "text")
        .join(wanted, ["kid", "tag"])
        .select("text", F.explode("calls").alias("call"))
        .select("call.*", "text")
    )

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        host, whose = None, None
        for part in slices(batches, SLICE):
            h, bounds = shingle_sets(part["text"], scheme.words)
            rows = zip(*(part[n].to_pylist() for n in ("centre", "task", "role", "sid")), strict=True)
            asked = as_long(set_ids(h, bounds)) == part["sid"].to_numpy()
            edges = []
            for i, (centre, task, role, sid) in enumerate(rows):
                if not asked[i]:  # another text with the same id and tag
                    continue
                own = h[bounds[i] : bounds[i + 1]]
                if role == 0:
                    host, whose = own, (centre, task)
                    continue
                if whose != (centre, task):
                    raise AssertionError("a member without its centre")
                both = len(np.intersect1d(host, own, assume_unique=True))
                if scheme.linked(both, len(host), len(own)):
                    edges.append((centre, sid))
            a, b = zip(*edges, strict=True) if edges else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    ordered = sent.repartition("centre", "task").sortWithinPartitions("centre", "task", "role", "sid")
    return stored(ordered.select("text", "centre", "task", "role", "sid").mapInArrow(run, "a long, b long"), "links")


def folded(words: list[str], i: int) -> Column:
    """Word ``i`` of the parity with ``len(CARRIED)`` words: every bit of it stands for several of the longer one."""
    return reduce(Column.bitwiseXOR, [F.col(w) for w in words[i :: len(CARRIED)]])


def near_parity(scheme: Scheme, a: dict[str, Column], b: dict[str, Column], words: list[str]) -> Column:
    """No more odd bits apart than linked sets of these sizes can differ in elements."""
    apart = sum(F.bit_count(a[p].bitwiseXOR(b[p])) for p in words)
    return apart * (100 + scheme.least) <= (a["n"] + b["n"]) * (100 - scheme.least)


def possible(scheme: Scheme, a: dict[str, Column], b: dict[str, Column], shared: Column) -> Column:
    """What linked sets must fulfil: no more bits apart than they can differ in elements, and lists in common.

    Each element that only one has spoils one part; the larger set's filled parts that are left are listed for both.
    """
    differing = F.floor((a["n"] + b["n"]) * (100 - scheme.least) / (100 + scheme.least))
    parts = F.when(a["n"] > b["n"], a["parts"]).when(a["n"] < b["n"], b["parts"]).otherwise(F.least(a["parts"], b["parts"]))
    return near_parity(scheme, a, b, CARRIED) & (shared >= parts - differing)


def listed_enough(entries: DataFrame) -> DataFrame:
    """Entries of the sets that stand in as many lists of a kind as they must share with a linked one."""
    held = F.count("*").over(Window.partitionBy("sid", "kind"))  # a set's lists, no more
    return entries.withColumn("held", held).where(f"held >= {NEED}").drop("held")


def shortest_lists(member: DataFrame) -> DataFrame:
    """Entries without the longest lists of each set and kind, all but one of those that it must share."""
    own = Window.partitionBy("sid", "kind")
    ranked = member.withColumns({"nth": F.row_number().over(own.orderBy("length", "list")), "held": F.count("*").over(own)})
    return ranked.where(f"nth <= held - greatest({NEED}, 1) + 1").drop("nth", "held")


def open_lists(entries: DataFrame, sets: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Entries of the lists that hold several components: ``list, sid, kind, component, n, main, length``, stored.

    ``main`` is the component with most members in the list, of equal ones the one with the largest name; ``length``
    counts its entries, also those of sets in too few open lists, which are left out.
    """
    member = entries.select("list", "sid", "kind")
    if labels is None:
        member = member.withColumn("component", F.col("sid"))
    else:
        member = member.join(labels.select(F.col("node").alias("sid"), "component"), "sid", "left")
        member = member.select("list", "sid", "kind", F.coalesce("component", "sid").alias("component"))
    main = (
        member.groupBy("list", "component")
        .agg(F.count("*").alias("size"))
        .groupBy("list")
        .agg(
            F.max(F.struct("size", "component"))["component"].alias("main"), F.count("*").alias("components"),
            F.sum("size").alias("length"),
        )
        .where("components > 1")
        .select("list", "main", "length")
    )
    return stored(listed_enough(member.join(main, "list").join(sets.select("sid", "n"), "sid")), "open-lists")


def stars(member: DataFrame) -> DataFrame:
    """``centre, sid, shared``: for each set outside of its lists' main components, ``STARS`` centres in each of these.

    The centre of a list is one of its main component's sets, drawn by a hash, so another one in every list. ``shared``
    counts the lists that the set has in common with the component.
    """
    drawn = F.struct(F.xxhash64("list", "sid").alias("drawn"), "sid")
    centres = member.where("component = main").groupBy("list").agg(F.min(drawn)["sid"].alias("centre"))
    tried = F.array_sort(F.collect_list(F.struct(F.xxhash64("list").alias("drawn"), "centre")))
    few = F.slice(F.array_distinct(F.transform(tried, lambda x: x["centre"])), 1, STARS)
    return (
        member.where("component != main")
        .join(centres, "list")
        .groupBy("sid", "main")
        .agg(F.count("*").alias("shared"), few.alias("few"))
        .select("sid", F.explode("few").alias("centre"), "shared")
    )


def scanned(member: DataFrame, sets: DataFrame, scheme: Scheme) -> DataFrame:
    """Pairs ``centre, sid`` of different components that share a list and may link by sizes and parities.

    The parities go with the rows, so that pairs which cannot link end within the join; so do the first of a set's lists,
    since two sets share many lists but need to meet in one. A few pairs still come out of several lists.
    """
    own = F.slice(F.array_sort(F.collect_list("list")), 1, FIRST).alias("first")  # a set's lists, no more
    member = member.join(sets.select("sid", *PARITIES), "sid").join(member.groupBy("sid").agg(own), "sid")
    a, b = member.where("component != main").alias("a"), member.alias("b")
    apart = (F.col("a.component") != F.col("b.component")) & (
        (F.col("b.component") == F.col("b.main")) | (F.col("a.sid") < F.col("b.sid"))
    )
    columns = lambda x: {c: F.col(f"{x}{c}") for c in ("n", *PARITIES)}
    sizes = (100 * F.col("a.n") >= scheme.least * F.col("b.n")) & (100 * F.col("b.n") >= scheme.least * F.col("a.n"))
    met_before = F.array_min(F.array_intersect("a.first", "b.first")) < F.col("a.list")
    once = F.when(near_parity(scheme, columns("a."), columns("b."), PARITIES), ~F.coalesce(met_before, F.lit(False))).otherwise(F.lit(False))
    met = a.join(b, (F.col("a.list") == F.col("b.list")) & apart & sizes & once)
    return met.select(F.least("a.sid", "b.sid").alias("centre"), F.greatest("a.sid", "b.sid").alias("sid"))


def linked_documents(docs: DataFrame, scheme: Scheme = Scheme(), id_col="doc_id", text_col="text") -> DataFrame:
    """``kid, tag, n, component, node`` of each row: its set's size, and the smallest id of the documents it is linked with.

    ``kid`` is the id, or ``NO_ID`` where it is null; ``tag`` tells texts with one id apart. ``node`` names the class of
    linked documents: classes without an id, or with an id in common, have one ``component`` but are not linked.
    """
    given = keyed(docs, id_col, text_col).withColumnRenamed("khash", "tag")
    rows = stored(lists_of_several(sketch(given, scheme)), "lists")
    facts = rows.where(F.col("kid").isNotNull()).select("sid", *FACTS)
    entries = rows.where(F.col("kid").isNull()).select("list", "sid", "kind")
    sets = stored(facts.groupBy("sid").agg(*(F.first(c).alias(c) for c in FACTS[2:])), "sets")
    short = sets.select("sid", "n", "parts", *(folded(PARITIES, i).alias(p) for i, p in enumerate(CARRIED)))

    def with_facts(pairs: DataFrame, given: DataFrame, can_link: Callable[[dict, dict], Column]) -> DataFrame:
        """The pairs ``centre, sid`` whose facts, as ``given``, allow a link."""
        names = given.columns[1:]

        def of(x: str) -> DataFrame:
            return given.select(F.col("sid").alias(f"{x}_sid"), *(F.col(c).alias(f"{x}_{c}") for c in names))

        both = pairs.join(of("a"), F.col("centre") == F.col("a_sid")).join(of("b"), F.col("sid") == F.col("b_sid"))
        columns = ({c: F.col(f"{x}_{c}") for c in names} for x in "ab")
        return both.where(can_link(*columns))

    links, tried = None, 0
    member = open_lists(entries, sets, None)
    while tried < ROUNDS:  # a short cut: what stars do not link has its turn below
        tried += 1
        # a component as a whole may share twice as many lists with a set as one of its sets does
        likely = with_facts(stars(member), short, lambda x, y: possible(scheme, x, y, F.col("shared") * 2))
        found = checked(given, facts, stored(likely.select("centre", "sid"), "stars"), scheme)
        links = links.unionByName(found) if links else found
        member = open_lists(entries, sets, components(links))
        if found.isEmpty():
            break
    pairs = scanned(stored(shortest_lists(member), "shortest-lists"), sets, scheme).distinct()
    more = checked(given, facts, stored(pairs, "pairs"), scheme)
    classes = components(links.unionByName(more))
    placed = facts.join(classes.select(F.col("node").alias("sid"), "component"), "sid", "left").select(
        "kid", "tag", "n", F.coalesce("component", "sid").alias("node")
    )
    least = placed.where("n > 0").groupBy("node").agg(F.min("kid").alias("least"))
    return placed.join(least, "node", "left").select(
        "kid", "tag", "n", F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("kid")).alias("component"), "node"
    )


def near_duplicates(docs: DataFrame, scheme: Scheme = Scheme(), id_col="doc_id", text_col="text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` of each row."""
    named = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return linked_documents(docs, scheme, id_col, text_col).select(
        named("kid").alias("doc_id"), F.col("n").alias("n_shingles"), named("component").alias("component_id")
    )


def one_of_each(docs: DataFrame, scheme: Scheme, id_col="doc_id", text_col="text") -> DataFrame:
    """Rows of ``docs`` with all their columns, the one with the smallest id of each class of linked documents."""
    found = linked_documents(docs, scheme, id_col, text_col)
    alone = found.where("n = 0").select("kid", "tag")
    kept = found.where("n > 0").groupBy("node").agg(F.min(F.struct("kid", "tag")).alias("doc"))
    kept = kept.select("doc.kid", "doc.tag").unionByName(alone.distinct())
    several = found.where("n > 0").groupBy("kid", "tag").agg(F.count("*").alias("rows")).where("rows > 1")
    kept = kept.join(several, ["kid", "tag"], "left")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    named = docs.select(
        F.struct(*docs.columns).alias("row"), F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("kid"),
        F.xxhash64(text).alias("tag"),
    )
    chosen = named.join(kept, ["kid", "tag"])
    single = chosen.where(F.col("rows").isNull())
    repeated = chosen.where(F.col("rows").isNotNull()).dropDuplicates(["kid", "tag"])
    return single.select("row.*").unionByName(repeated.select("row.*"))
