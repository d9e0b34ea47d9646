"""Source divergence audit: how the sources of a language differ in the terms they use.

Terms are maximal runs of ASCII letters and of everything beyond ASCII, A-Z in lower case. Each language keeps the terms
that at least ``LEAST`` of its documents hold. The probability of a kept term in a group (language and source, or the
whole language) is 1 + floor(10**9 * (count + 5) / (N + 5 * V)), N being the group's count of kept terms and V their
number; all arithmetic is exact.

1. *Exact frequencies.* A pass counts documents per language and term, in each slice of the input first.
2. *Perfect hashes.* Kept terms are cut into shards of some ``SHARD_KEYS`` by their hash; each shard becomes a minimal
   perfect hash with its keys to verify against (``perfect_hash``), at most ``SHARD_BYTES`` large.
3. *Recount.* Shards are broadcast in rounds of at most ``ROUND_BYTES``; a pass over the documents for each round adds
   into dense arrays, one for each group and shard, which leave the task when it ends or when they pass ``DENSE_BYTES``.
   A vocabulary beyond one round costs another pass, not memory.
4. *Differences.* For all pairs of sources a task takes one shard of up to some ``TILE`` by ``TILE`` sources; its sums
   are added up. For terms, each group's counts meet the language's by slot.

The result has rows for all pairs of sources in a language, both ways: that is what is asked for, so it grows with the
square of the number of sources, though not with documents.

Defined results: null text, language and source read as empty strings; texts without terms count as documents and make
their group occur; equal rows are documents of their own; ids are not looked at; an empty table gives an empty one; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isochron.llm.common import stored, tidy, words
from isochron.llm.perfect_hash import LONG_KEY, Shard, hash_keys
from isochron.llm.repeats import slices
from isochron.llm.suffix_dedup import byte_numbers

LEAST = 30
RANKS = 50
SLICE = 1 << 22
SHARD_KEYS = 1 << 14
ROUND_BYTES = 48 << 20
DENSE_BYTES = 64 << 20
TILE = 256
SHARD_BYTES = 2 * SHARD_KEYS * (LONG_KEY + 16)
"""Shards are dealt by hash, so one with twice its share is out of the question."""

_LETTERS = np.arange(256, dtype=np.uint8)
_LETTERS[0x41:0x5B] += 0x20
for _first, _last in ((0x00, 0x40), (0x5B, 0x60), (0x7B, 0x7F)):
    _LETTERS[_first : _last + 1] = 0x20


def terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Terms of each text: row bounds, code of each term, the distinct terms."""
    data, bounds = byte_numbers(texts)
    buffers = [None, pa.py_buffer(np.ascontiguousarray(bounds)), pa.py_buffer(_LETTERS[data])]
    return words(pa.Array.from_buffers(pa.large_string(), len(texts), buffers))


def named(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    given = {"text": text_col, "lang": lang_col, "source": source_col}
    return docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for n, c in given.items()))


def coded(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    found = column.dictionary_encode()
    return found.indices.to_numpy().astype(np.int64), found.dictionary


def frequencies(docs: DataFrame) -> DataFrame:
    """Two kinds of rows: ``lang, term, docs``, the documents that hold the term, and ``lang, source`` of each group."""
    names = ["lang", "term", "source", "docs"]

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, SLICE):
            bounds, codes, distinct = terms(part["text"])
            lang, langs = coded(part["lang"])
            source, sources = coded(part["source"])
            group = np.unique(lang * len(sources) + source)
            of, which = langs.take(pa.array(group // len(sources))), sources.take(pa.array(group % len(sources)))
            yield pa.RecordBatch.from_arrays(
                [of, pa.nulls(len(of), pa.string()), which, pa.nulls(len(of), pa.int64())], names=names
            )
            if not len(codes):
                continue
            row = np.repeat(np.arange(part.num_rows), np.diff(bounds))
            held = np.unique(row * len(distinct) + codes)
            held, count = np.unique(lang[held // len(distinct)] * len(distinct) + held % len(distinct), return_counts=True)
            of = langs.take(pa.array(held // len(distinct)))
            what = distinct.take(pa.array(held % len(distinct))).cast(pa.string())
            yield pa.RecordBatch.from_arrays([of, what, pa.nulls(len(of), pa.string()), pa.array(count, pa.int64())], names=names)

    found = docs.mapInArrow(run, "lang string, term string, source string, docs long")
    return found.groupBy("lang", "term", "source").agg(F.sum("docs").alias("docs"))


def perfect_shards(kept: DataFrame) -> DataFrame:
    """``lang, shard, shards, placed, displacement, keys, terms`` of the kept terms (``lang, term``)."""
    totals = kept.groupBy("lang").agg(F.ceil(F.count("*") / SHARD_KEYS).cast("int").alias("shards"))
    dealt = kept.join(totals, "lang").select("lang", "shards", F.pmod(F.xxhash64("term"), F.col("shards")).cast("int").alias("shard"), "term")

    def build(table: pa.Table) -> pa.Table:
        own = table["term"].combine_chunks()
        shard, slot = Shard.of(own.cast(pa.binary()).to_pylist())
        listed = own.take(pa.array(np.argsort(slot)))
        return pa.table(
            {
                "lang": table["lang"].combine_chunks()[:1],
                "shard": table["shard"].combine_chunks()[:1],
                "shards": table["shards"].combine_chunks()[:1],
                "placed": pa.array([shard.placed], pa.int32()),
                "displacement": pa.array([shard.displacement.tolist()], pa.list_(pa.int64())),
                "keys": pa.array([shard.keys.to_pylist()], pa.list_(pa.binary())),
                "terms": pa.array([listed.to_pylist()], pa.list_(pa.string())),
            }
        )

    schema = "lang string, shard int, shards int, placed int, displacement array<long>, keys array<binary>, terms array<string>"
    return dealt.groupBy("lang", "shard").applyInArrow(build, schema)


def rounds(shards: DataFrame, round_bytes: int) -> Iterator[list]:
    """Shards of all languages in lists of at most ``round_bytes``; only sizes are gathered beforehand."""
    size = F.size("keys") * 16 + F.aggregate("keys", F.lit(0), lambda a, x: a + F.octet_length(x))
    held, total = [], 0
    for row in shards.select("lang", "shard", size.alias("size")).orderBy("lang", "shard").collect():
        if held and total + row["size"] > round_bytes:
            yield held
            held, total = [], 0
        held.append((row["lang"], row["shard"]))
        total += row["size"]
    if held:
        yield held


def recounted(docs: DataFrame, shards: DataFrame, round_bytes: int, dense_bytes: int) -> DataFrame | None:
    """``lang, source, shard, slot, n`` of all kept terms that occur in a group; None without a kept term."""
    names = ["lang", "source", "shard", "slot", "n"]
    schema = "lang string, source string, shard int, slot int, n long"
    spark, found = docs.sparkSession, None
    for wanted in rounds(shards, round_bytes):
        asked = spark.createDataFrame(wanted, "lang string, shard int")
        tables: dict[str, tuple[int, dict[int, tuple]]] = {}
        for row in shards.drop("terms").join(F.broadcast(asked), ["lang", "shard"]).toArrow().to_pylist():
            parts = np.array(row["displacement"], np.int64), pa.array(row["keys"], pa.binary()), row["placed"]
            tables.setdefault(row["lang"], (row["shards"], {}))[1][row["shard"]] = parts
        sent = spark.sparkContext.broadcast(tables)

        @tidy
        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            ready = {
                lang: (n, {k: Shard(*parts) for k, parts in own.items()})
                for lang, (n, own) in sent.value.items()
            }
            dense: dict[tuple[str, str, int], np.ndarray] = {}
            held = 0
            for part in slices(batches, SLICE):
                bounds, codes, distinct = terms(part["text"])
                if not len(codes):
                    continue
                lang, langs = coded(part["lang"])
                source, sources = coded(part["source"])
                group = np.repeat(lang * len(sources) + source, np.diff(bounds))
                met, count = np.unique(group * len(distinct) + codes, return_counts=True)
                met_group, met_code = met // len(distinct), met % len(distinct)
                raw = distinct.cast(pa.large_binary()).to_pylist()
                hashes = hash_keys(raw)
                langs, sources = langs.to_pylist(), sources.to_pylist()
                for at, name in enumerate(langs):
                    if name not in ready:
                        continue
                    n_shards, own = ready[name]
                    mine = np.flatnonzero(met_group // len(sources) == at)
                    asked = np.unique(met_code[mine])
                    shard_of = np.full(len(raw), -1)
                    slot_of = np.full(len(raw), -1)
                    shard_of[asked] = hashes[asked].view(np.int64) % n_shards
                    for k, shard in own.items():
                        some = asked[shard_of[asked] == k]
                        if len(some):
                            slot_of[some] = shard.lookup([raw[i] for i in some], hashes[some])
                    mine = mine[slot_of[met_code[mine]] >= 0]
                    where = met_group[mine] % len(sources), shard_of[met_code[mine]]
                    order = np.lexsort(where[::-1])
                    s, k = (x[order] for x in where)
                    mine = mine[order]
                    cuts = np.flatnonzero(np.concatenate([[True], (s[1:] != s[:-1]) | (k[1:] != k[:-1])])) if len(mine) else []
                    for a, b in zip(cuts, [*cuts[1:], len(mine)]):
                        key = (name, sources[s[a]], int(k[a]))
                        if key not in dense:
                            dense[key] = np.zeros(own[key[2]].size, np.int64)
                            held += dense[key].nbytes
                        dense[key][slot_of[met_code[mine[a:b]]]] += count[mine[a:b]]
                if held > dense_bytes:
                    yield from filled(dense)
                    dense, held = {}, 0
            yield from filled(dense)

        one = docs.mapInArrow(run, schema).groupBy("lang", "source", "shard", "slot").agg(F.sum("n").alias("n"))
        one = stored(one.select(*names), "recount")
        found = found.unionByName(one) if found else one
    return found


def filled(dense: dict[tuple[str, str, int], np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Slots that are not zero, of all arrays."""
    for (lang, source, shard), counts in dense.items():
        slot = np.flatnonzero(counts)
        where = [pa.array([x] * len(slot), t) for x, t in ((lang, pa.string()), (source, pa.string()), (shard, pa.int32()))]
        yield pa.RecordBatch.from_arrays(
            [*where, pa.array(slot, pa.int32()), pa.array(counts[slot], pa.int64())], names=["lang", "source", "shard", "slot", "n"]
        )


def probability(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(10**9 * (count + 5) / (total + 5 * kept)); decimals, since the product can pass 64 bits."""
    upper = (count + 5).cast("decimal(28,0)") * F.lit(10**9).cast("decimal(10,0)")
    lower = (total + 5 * kept).cast("decimal(20,0)")
    return 1 + F.call_function("div", upper, lower)


def pair_sums(facts: DataFrame, counts: DataFrame, sizes: DataFrame, tile: int) -> DataFrame:
    """``lang, a, b, value`` for all pairs of a language's sources, each once.

    ``facts``: ``lang, source, total, kept`` of every group; ``sizes``: ``lang, shard, size``.
    """
    tiles = facts.groupBy("lang").agg(F.ceil(F.count("*") / tile).cast("int").alias("tiles"))
    none = probability(F.lit(0).cast("long"), F.col("total"), F.col("kept"))
    groups = facts.join(tiles, "lang").select(
        "lang", "source", "tiles", F.pmod(F.xxhash64("source"), F.col("tiles")).cast("int").alias("tile"),
        F.when(F.col("kept") > 0, none).otherwise(F.lit(0)).alias("none"),
    )
    p = probability(F.col("n"), F.col("total"), F.col("kept"))
    listed = (
        counts.join(facts, ["lang", "source"])
        .groupBy("lang", "source", "shard")
        .agg(F.collect_list(F.struct("slot", p.alias("p"))).alias("filled"))  # no longer than the shard
    )
    # a language without kept terms has one shard without slots
    laid = groups.join(sizes, "lang", "left").select("*").fillna(0, ["shard", "size"])
    laid = laid.join(listed, ["lang", "source", "shard"], "left")
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    met = laid.withColumn("other", other).select(
        "lang", "shard", "size", "source", "tile", "none", "filled",
        F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"),
    )

    def differences(table: pa.Table) -> pa.Table:
        size, low, high = (table[n][0].as_py() for n in ("size", "low", "high"))
        tile_of = table["tile"].to_numpy()
        sources = table["source"].to_pylist()
        p = np.repeat(table["none"].to_numpy()[:, None], size, axis=1)
        for i, own in enumerate(table["filled"].combine_chunks()):
            if own.is_valid:
                p[i, own.values.field("slot").to_numpy()] = own.values.field("p").to_numpy()
        order = np.lexsort((np.arange(len(p)), tile_of))
        first, second, value = [], [], []
        for at, i in enumerate(order):
            if low != high and tile_of[i] != low:
                break
            rest = order[at + 1 :] if low == high else order[tile_of[order] == high]
            value.append(np.abs(p[rest] - p[i]).sum(axis=1))
            first += [sources[i]] * len(rest)
            second += [sources[j] for j in rest]
        value = np.concatenate(value) if value else np.empty(0, np.int64)
        a = [min(x, y, key=str.encode) for x, y in zip(first, second, strict=True)]
        b = [max(x, y, key=str.encode) for x, y in zip(first, second, strict=True)]
        lang = [table["lang"][0].as_py()] * len(a)
        return pa.table({"lang": pa.array(lang, pa.string()), "a": pa.array(a, pa.string()), "b": pa.array(b, pa.string()), "value": pa.array(value, pa.int64())})

    made = met.groupBy("lang", "shard", "low", "high").applyInArrow(differences, "lang string, a string, b string, value long")
    return made.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def source_divergence(
    docs: DataFrame,
    text_col="text",
    lang_col="lang",
    source_col="source",
    least: int = LEAST,
    ranks: int = RANKS,
    round_bytes: int = ROUND_BYTES,
    dense_bytes: int = DENSE_BYTES,
    tile: int = TILE,
) -> DataFrame:
    """``lang, source, part, item, value, rank``.

    Part ``pair``: the sum of differences to each other source of the language. Part ``term``: the ``ranks`` kept terms
    that the group holds and whose probability is furthest above the language's.
    """
    given = named(docs, text_col, lang_col, source_col)
    seen = stored(frequencies(given).where(F.col("source").isNotNull() | (F.col("docs") >= least)), "terms-and-groups")
    groups = seen.where(F.col("source").isNotNull()).select("lang", "source")
    kept = seen.where(F.col("source").isNull()).select("lang", "term")
    shards = stored(perfect_shards(kept), "perfect-hashes")
    counts = recounted(given, shards, round_bytes, dense_bytes)
    if counts is None:
        counts = docs.sparkSession.createDataFrame([], "lang string, source string, shard int, slot int, n long")
    sizes = shards.select("lang", "shard", F.size("terms").alias("size"))
    kept_of = kept.groupBy("lang").agg(F.count("*").alias("kept"))
    facts = (
        groups.join(counts.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left")
        .join(kept_of, "lang", "left")
        .fillna(0, ["total", "kept"])
    )
    facts = stored(facts, "group-facts")

    pairs = pair_sums(facts, counts, sizes, tile)
    both = pairs.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").unionByName(
        pairs.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value")
    )

    whole = facts.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.max("kept").alias("kept"))
    whole = whole.withColumnRenamed("lang", "of")
    spelled = shards.select("lang", "shard", F.posexplode("terms").alias("slot", "item"))
    common = counts.groupBy("lang", "shard", "slot").agg(F.sum("n").alias("lang_n"))
    common = (
        common.join(spelled, ["lang", "shard", "slot"])
        .join(whole, F.col("lang") == F.col("of"))
        .select("lang", "shard", "slot", "item", probability(F.col("lang_n"), F.col("lang_total"), F.col("kept")).alias("q"))
    )
    own = counts.join(facts, ["lang", "source"]).select(
        "lang", "source", "shard", "slot", probability(F.col("n"), F.col("total"), F.col("kept")).alias("p")
    )
    above = own.join(common, ["lang", "shard", "slot"]).where("p > q").select("lang", "source", "item", (F.col("p") - F.col("q")).alias("value"))

    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")).cast("int")
    columns = ["lang", "source", "part", "item", "value", "rank"]
    listed = both.withColumn("rank", place).withColumn("part", F.lit("pair")).select(*columns)
    top = above.withColumn("rank", place).where(F.col("rank") <= ranks).withColumn("part", F.lit("term")).select(*columns)
    return listed.unionByName(top)
