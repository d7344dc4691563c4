"""Source divergence audit: how far the sources of a language differ in their words.

Terms that enough documents of a language hold make its vocabulary, which is sorted
over the cluster and turned into minimal acyclic transducers, one for each stretch of
``CHUNK`` sorted terms.  Texts are then streamed through them: a term's path adds up to
its lexicographic ordinal, occurrences are counted by language, source and ordinal, and ordinals
decide ties, since their order is that of the terms.  Only transducers of ``TRAY`` bytes
together are ever sent out at once; a larger vocabulary takes as many passes over the texts.

Shares are integers in billionths, so all arithmetic is exact.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import textscan, transducer
from .common import arrow_map, materialize, ragged, scratch_dir
from .units import stretches

#: Terms of a transducer.
CHUNK = 1 << 17
#: Bytes of transducers that go to the tasks together (one transducer at least).
TRAY = 16 << 20
#: Text that is counted at a time, bytes.
STRETCH = 8 << 20
#: Counts that a task adds up before it hands them over.
HELD = 1 << 20
#: Terms and sources of a block of pair sums.
TERMS, SOURCES = 2048, 128
#: Shares are counted in such parts of one.
ONE = 1_000_000_000

# Bytes of a term are letters of ASCII and whatever is beyond ASCII.
_IN_TERM = np.zeros(256, bool)
_IN_TERM[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def term_spans(buffer: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every term; none reaches across texts."""
    own, edge = np.zeros(len(buffer) + 2, bool), np.zeros(len(buffer) + 1, bool)
    own[1:-1], edge[edges] = _IN_TERM[buffer], True
    return np.flatnonzero(own[1:-1] & (~own[:-2] | edge[:-1])), np.flatnonzero(own[1:-1] & (~own[2:] | edge[1:])) + 1


def codes(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for every span, equal for equal bytes, and a span of each number."""
    _, first, code = np.unique(textscan.hashes(buffer, starts, ends), return_index=True, return_inverse=True)
    lens = ends - starts
    if (lens == lens[first][code]).all() and (buffer[ragged(starts, lens)] == buffer[ragged(starts[first][code], lens)]).all():
        return code, first
    number: dict[bytes, int] = {}  # two terms of one hash
    code = np.array([number.setdefault(buffer[a:b].tobytes(), len(number)) for a, b in zip(starts.tolist(), ends.tolist())], np.int64)
    return code, np.unique(code, return_index=True)[1]


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    buffer, edges = textscan.column(batch.column("text"))
    for a, b in stretches(edges, STRETCH):
        yield a, b, textscan.LOWER[buffer[edges[a]:edges[b]]], edges[a:b + 1] - edges[a]


def _keys(column: pa.Array) -> tuple[np.ndarray, list[str]]:
    d = column.dictionary_encode()
    return d.indices.to_numpy().astype(np.int64), d.dictionary.to_pylist()


def document_frequency(docs: DataFrame) -> DataFrame:
    """``lang, term, n``: documents of ``lang`` that hold ``term`` (rows of ``lang, source, text``)."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, names = _keys(batch.column("lang"))
            for a, b, buffer, edges in _texts(batch):
                starts, ends = term_spans(buffer, edges)
                if not len(starts):
                    continue
                code, first = codes(buffer, starts, ends)
                k = len(first)
                pairs = np.unique((np.searchsorted(edges, starts, "right") - 1) * k + code)  # a document counts once
                found, n = np.unique(lang[a + pairs // k] * k + pairs % k, return_counts=True)
                lens = ends[first] - starts[first]
                text = pa.Array.from_buffers(pa.large_binary(), k, [None, pa.py_buffer(np.concatenate([[0], np.cumsum(lens)]).astype(np.int64).tobytes()),
                                                                  pa.py_buffer(buffer[ragged(starts[first], lens)].tobytes())])
                term = text.take(pa.array(found % k)).cast(pa.large_string()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()).take(pa.array(found // k)), term, pa.array(n, pa.int64())], ["lang", "term", "n"])
    return arrow_map(docs.select("lang", "text"), run, "lang string, term string, n long").groupBy("lang", "term").agg(F.sum("n").alias("n"))


def build_transducers(kept: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``lang, base, n, first, blob``, written: the transducers of a written table of distinct ``lang, term``,
    in sorted stretches; ``base`` is the ordinal of the stretch's first term in its language."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, lang, terms, number = TaskContext.get().partitionId(), None, [], 0

        def flush() -> pa.RecordBatch:
            row = [lang, part, number, len(terms), terms[0], transducer.build(terms)]
            kinds = [pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds)], ["lang", "part", "number", "n", "first", "blob"])

        for batch in batches:
            for own, term in zip(batch.column("lang").to_pylist(), batch.column("term").cast(pa.binary()).to_pylist()):
                if terms and (own != lang or len(terms) >= chunk):
                    yield flush()
                    terms, number = [], number + 1
                lang = own
                terms.append(term)
        if terms:
            yield flush()

    parts = max(1, -(-kept.count() // chunk))
    ordered = kept.select("lang", "term").repartitionByRange(parts, "lang", "term").sortWithinPartitions("lang", "term")
    built = materialize(arrow_map(ordered, run, "lang string, part int, number int, n long, first binary, blob binary"), "transducers")
    upto = Window.partitionBy("lang").orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)  # a row for each stretch
    places = built.select("lang", "part", "number", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("base"))
    return materialize(built.join(places, ["lang", "part", "number"]).select("lang", "base", "n", "first", "blob"), "transducers")


class Vocabulary:
    """Some of the transducers, and which of them a term of a language can be in."""

    def __init__(self, rows: list[tuple]):
        rows = sorted(rows, key=lambda r: (r[0], r[1]))
        self.walk = transducer.Transducers([r[4] for r in rows])
        self.lang = [r[0] for r in rows]
        self.base, self.n = np.array([r[1] for r in rows], np.int64), np.array([r[2] for r in rows], np.int64)
        self.bound = np.array([int.from_bytes(r[3][:8].ljust(8, b"\0"), "big") for r in rows], np.uint64)

    def ordinals(self, langs: list[str], lang: np.ndarray, buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Ordinal of each span, -1 for one that is no term here; ``lang`` numbers ``langs``."""
        out = np.full(len(starts), -1, np.int64)
        key = np.zeros(len(starts), np.uint64)
        if len(self.lang) > len(set(self.lang)):
            for k in range(8):
                at = starts + k
                key = (key << np.uint64(8)) | np.where(at < ends, buffer[np.minimum(at, len(buffer) - 1)], 0).astype(np.uint64)
        for i, name in enumerate(langs):
            if name not in self.lang:
                continue
            a = self.lang.index(name)
            bound = self.bound[a:a + self.lang.count(name)]
            rows = np.flatnonzero(lang == i)
            if len(bound) == 1:
                low = high = np.zeros(len(rows), np.int64)
            else:
                low = np.maximum(np.searchsorted(bound, key[rows], "left") - 1, 0)
                high = np.searchsorted(bound, key[rows], "right") - 1
            while len(rows):
                go = low <= high
                rows, low, high = rows[go], low[go], high[go]
                got = self.walk.ordinals(a + low, buffer, starts[rows], ends[rows])
                out[rows[got >= 0]] = self.base[a + low[got >= 0]] + got[got >= 0]
                rows, low, high = rows[got < 0], low[got < 0] + 1, high[got < 0]
        return out

    def term(self, lang: str, ordinal: int) -> str | None:
        """The term of an ordinal, if it is here."""
        for i, name in enumerate(self.lang):
            if name == lang and 0 <= ordinal - self.base[i] < self.n[i]:
                return self.walk.term(i, int(ordinal - self.base[i])).decode()
        return None


_held: dict[str, Vocabulary] = {}


def _vocabulary(name: str, sent) -> Vocabulary:
    """The tray's vocabulary, kept by the worker until the next tray."""
    if name not in _held:
        _held.clear()
        _held[name] = Vocabulary(sent.value)
    return _held[name]


class _Trays:
    """The transducers in trays of bounded size, each sent to the tasks while it is in use."""

    def __init__(self, table: DataFrame, most: int):
        self.table, self.trays, size = table, [], 0
        for r in table.select("lang", "base", F.octet_length("blob").alias("size")).orderBy("lang", "base").collect():  # a row for each stretch
            if not self.trays or size + r["size"] > most:
                self.trays.append([])
                size = 0
            self.trays[-1].append((r["lang"], r["base"]))
            size += r["size"]

    def __iter__(self):
        spark = self.table.sparkSession
        for tray in self.trays:
            mine = spark.createDataFrame(tray, "lang string, base long")
            rows = [(r["lang"], r["base"], r["n"], bytes(r["first"]), bytes(r["blob"])) for r in self.table.join(F.broadcast(mine), ["lang", "base"]).collect()]
            sent = spark.sparkContext.broadcast(rows)
            yield uuid.uuid4().hex, sent
            sent.destroy()


def recount(docs: DataFrame, trays: _Trays) -> DataFrame:
    """``lang, source, ordinal, n``, written: occurrences of the vocabulary's terms."""
    def counter(name: str, sent):
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            numbers: dict[tuple, int] = {}  # (lang, source) -> its number in this task
            held = np.zeros(0, np.int64), np.zeros(0, np.int64)  # number and ordinal in one key, count

            def flush() -> pa.RecordBatch:
                groups = list(numbers)
                own = pa.array(held[0] >> 40)
                return pa.RecordBatch.from_arrays([pa.array([g[i] for g in groups], pa.string()).take(own) for i in (0, 1)]
                                                  + [pa.array(held[0] & ((1 << 40) - 1), pa.int64()), pa.array(held[1], pa.int64())], ["lang", "source", "ordinal", "n"])

            for batch in batches:
                lang, langs = _keys(batch.column("lang"))
                source, sources = _keys(batch.column("source"))
                both, group = np.unique(lang * len(sources) + source, return_inverse=True)
                group = np.array([numbers.setdefault((langs[k // len(sources)], sources[k % len(sources)]), len(numbers)) for k in both.tolist()], np.int64)[group]
                for a, b, buffer, edges in _texts(batch):
                    starts, ends = term_spans(buffer, edges)
                    doc = a + np.searchsorted(edges, starts, "right") - 1
                    ordinal = _vocabulary(name, sent).ordinals(langs, lang[doc], buffer, starts, ends)
                    has = np.flatnonzero(ordinal >= 0)
                    found, n = np.unique((group[doc[has]] << 40) | ordinal[has], return_counts=True)
                    keys, at = np.unique(np.concatenate([held[0], found]), return_inverse=True)
                    held = keys, np.bincount(at, np.concatenate([held[1], n]), len(keys)).astype(np.int64)  # a task's counts are far below 2^53
                    if len(keys) > HELD:
                        yield flush()
                        held = np.zeros(0, np.int64), np.zeros(0, np.int64)
            if len(held[0]):
                yield flush()
        return run

    spark, schema = docs.sparkSession, "lang string, source string, ordinal long, n long"
    path = f"{scratch_dir(spark)}/recount-{uuid.uuid4().hex}"
    spark.createDataFrame([], schema).write.parquet(path)
    for name, sent in trays:
        counted = arrow_map(docs.select("lang", "source", "text"), counter(name, sent), schema)
        counted.groupBy("lang", "source", "ordinal").agg(F.sum("n").alias("n")).write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def _spell(rows: DataFrame, trays: _Trays) -> DataFrame:
    """``rows`` of ``lang, source, ordinal, value, rank`` with ``item``, written."""
    def speller(name: str, sent):
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            words = _vocabulary(name, sent)
            for batch in batches:
                items = [words.term(x, o) for x, o in zip(batch.column("lang").to_pylist(), batch.column("ordinal").to_pylist())]
                out = pa.RecordBatch.from_arrays([*batch.columns, pa.array(items, pa.string())], [*batch.schema.names, "item"])
                yield out.filter(out.column("item").is_valid())
        return run

    schema = "lang string, source string, ordinal long, value long, rank int, item string"
    spark = rows.sparkSession
    path = f"{scratch_dir(spark)}/spelt-{uuid.uuid4().hex}"
    spark.createDataFrame([], schema).write.parquet(path)
    for name, sent in trays:
        arrow_map(rows.select("lang", "source", "ordinal", "value", "rank"), speller(name, sent), schema).write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def _share(count: str, total: str, size: str):
    """``1 + floor(ONE * (count + 5) / (total + 5 * size))``; ``size`` is not zero.

    ``ONE`` is 31,250 * 32,000: two long divisions in place of one of 10^9-fold numbers,
    exact while the sums are below 2.8 * 10^14."""
    c, d = f"({count} + 5L)", f"({total} + 5L * {size})"
    return F.expr(f"1L + ({c} * 31250L) div {d} * 32000L + (({c} * 31250L) % {d} * 32000L) div {d}")


def _pair_sums(pdf: pd.DataFrame) -> pd.DataFrame:
    """Sums of absolute differences between the sources of two tiles, over one block of terms."""
    total = pdf["width"].notna()
    facts = pdf[total].sort_values("place")
    width, one = int(facts["width"].iloc[0]), facts["ti"].iloc[0] == facts["tj"].iloc[0]
    place = facts["place"].to_numpy()
    share = np.repeat(facts["p"].to_numpy(np.int64)[:, None], width, axis=1)  # of a term without occurrences
    cells = pdf[~total]
    share[np.searchsorted(place, cells["place"].to_numpy()), cells["at"].to_numpy().astype(np.int64)] = cells["p"].to_numpy(np.int64)
    left = np.flatnonzero(place // SOURCES == facts["ti"].iloc[0])
    right = left if one else np.flatnonzero(place // SOURCES == facts["tj"].iloc[0])
    value = np.stack([np.abs(share[right] - share[i]).sum(axis=1) for i in left])
    a, b, v = np.repeat(place[left], len(right)), np.tile(place[right], len(left)), value.ravel()
    if one:
        a, b, v = a[a != b], b[a != b], v[a != b]
    else:
        a, b, v = np.concatenate([a, b]), np.concatenate([b, a]), np.concatenate([v, v])
    return pd.DataFrame({"lang": facts["lang"].iloc[0], "a": a, "b": b, "value": v})


def _pairs(groups: DataFrame, counts: DataFrame) -> DataFrame:
    """``lang, a, b, value``: each two sources' (numbers ``place``) sum of absolute differences."""
    tiles = Window.partitionBy("lang")
    facts = groups.select("lang", "place", "size", "total", F.max(F.floor(F.col("place") / SOURCES)).over(tiles).alias("last_tile"))
    tile, other = F.floor(F.col("place") / SOURCES), F.explode(F.expr("sequence(0L, last_tile)"))
    cells = (counts.join(facts, ["lang", "place"])
             .select("lang", "place", "last_tile", F.floor(F.col("ordinal") / TERMS).alias("block"), (F.col("ordinal") % TERMS).cast("int").alias("at"),
                     _share("n", "total", "size").alias("p"), F.lit(None).cast("int").alias("width")))
    zero = (facts.select("lang", "place", "last_tile", F.explode(F.expr(f"sequence(0L, greatest(ceil(size / {TERMS}), 1) - 1)")).alias("block"), F.lit(0).alias("at"),
                         F.when(F.col("size") > 0, _share("0L", "total", "greatest(size, 1)")).otherwise(F.lit(0)).alias("p"), "size")
            .select("lang", "place", "last_tile", "block", "at", "p", F.least(F.lit(TERMS), F.col("size") - F.col("block") * TERMS).cast("int").alias("width")))
    rows = (cells.unionByName(zero).withColumn("other", other)
            .select("lang", "block", F.least(tile, "other").alias("ti"), F.greatest(tile, "other").alias("tj"), "place", "at", "p", "width"))
    return (rows.groupBy("lang", "block", "ti", "tj").applyInPandas(_pair_sums, "lang string, a long, b long, value long")
            .groupBy("lang", "a", "b").agg(F.sum("value").alias("value")))


def audit(docs: DataFrame, least_documents: int = 30, top: int = 50, chunk: int = CHUNK, tray: int = TRAY) -> DataFrame:
    """``lang, source, part, item, value, rank``.

    Part ``pair``: for every source of a language each other source, by the sum over the
    language's vocabulary of absolute differences between their shares.  Part ``term``: for every
    source the ``top`` terms whose share is furthest above the language's.  A share is
    ``1 + floor(10^9 * (count + 5) / (N + 5 V))``; ranks go by value, then by bytes of the item.

    A null text, lang or source counts as empty; texts without terms still make their source occur;
    each row is a document, repeated ones too.  A language without a vocabulary has pairs of value 0 and no
    terms, one with a single source no pairs; an empty table gives no rows."""
    spark: SparkSession = docs.sparkSession
    own = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    kept = materialize(document_frequency(own).where(F.col("n") >= least_documents).select("lang", "term"), "vocabulary")
    trays = _Trays(build_transducers(kept, chunk), tray)
    counts = recount(own, trays)
    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("size"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = materialize(own.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(sizes, "lang", "left")
                         .select("lang", "source", place.cast("long").alias("place"), F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("size", F.lit(0)).alias("size")), "sources")
    counts = materialize(counts.join(groups.select("lang", "source", "place"), ["lang", "source"]).select("lang", "place", "ordinal", "n"), "counts")

    names = groups.select("lang", F.col("place").alias("b"), F.col("source").alias("item"))
    pairs = (_pairs(groups, counts).join(groups.select("lang", F.col("place").alias("a"), "source"), ["lang", "a"]).join(names, ["lang", "b"])
             .select("lang", "source", F.lit("pair").alias("part"), "item", "value",
                     F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")).alias("rank")))

    whole = counts.groupBy("lang", "ordinal").agg(F.sum("n").alias("all_n"))
    langs = groups.groupBy("lang").agg(F.sum("total").alias("all_total"))
    above = (counts.join(whole, ["lang", "ordinal"]).join(groups.select("lang", "place", "source", "total", "size"), ["lang", "place"]).join(langs, "lang")
             .select("lang", "source", "ordinal", (_share("n", "total", "size") - _share("all_n", "all_total", "size")).alias("value"))
             .where("value > 0"))
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ordinal")
    best = materialize(above.withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= top), "best-terms")
    terms = _spell(best, trays).select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")
    return pairs.unionByName(terms)
