"""Windows that repeat across a corpus: what exact substring removal over symbols
(bytes or words) has in common, whatever data structure decides which windows repeat.

Comparing every window with every other is cut down without losing a repeat:

1. Texts are packed into chunks, a written table bucketed by chunk, so that what later
   steps answer to a chunk joins it without moving a text.
2. A window's minimizer is the least hash of its k-grams.  Equal windows have equal
   minimizers, so consecutive windows of one minimizer form a run and a minimizer
   seen once in the corpus is a run without repeats.  Each chunk sends its distinct
   minimizers' hashes, packed into one row a bucket, and how many bytes of distinct runs
   each has; a bucket answers which were seen twice.  (A false answer only costs work.)
3. Of the runs of repeated minimizers, the *contents*, which are found once and written
   as flat columns a chunk, each chunk sends one hash (with
   the minimizer's, about a hundred bits) and the first place for each distinct one.
   A bucket answers which are later copies of an equal content, and which
   minimizers have several contents.  A minimizer that very many chunks have, or
   whose contents are too many bytes for one group, is sent window by window, by the
   window's own hash, so that no bucket grows with one frequent string.
4. Only first copies whose minimizer has several contents need their text looked
   at.  A bucket holds all of them that share a minimizer, and so all first
   occurrences of their windows: the solver says which windows occur earlier.
5. Each chunk marks what is covered: all of a later copy, and the solver's windows.

Every group is bounded by the number of buckets, which follows the input's size, and a
chunk's share of a group by what is distinct in the chunk.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textscan
from .common import NULL_KEY, arrow_map, documents, input_bytes, materialize, ragged, scratch_dir
from .units import by_size

#: Characters of a chunk, about.
CHUNK = 2 << 20
#: Chunks that must share a minimizer for it to be sent window by window.
FREQUENT = 2_048
#: Bytes of one minimizer's contents, summed over chunks, for the same.
CROWDED = 1 << 20
#: Windows of one content at most (longer runs are cut).
LONGEST_RUN = 64
_SYMBOLS_AT_ONCE = 1 << 17


@dataclass(frozen=True)
class Spec:
    """``split(buffer)`` gives the symbols' starts, ends and hashes (or hashes alone, for
    bytes); windows are ``window`` symbols, minimizers ``2 ** log_gram``-grams; with
    ``by_position`` an earlier place in the same document counts, else only smaller keys.
    With ``together`` a bucket's contents are parted by minimizer and solved in parts of
    about that many bytes."""

    window: int
    log_gram: int
    words: bool
    by_position: bool
    together: int = 0

    def split(self, buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.words:
            at = np.arange(len(buffer))
            return at, at + 1, _BYTE[buffer]
        starts, ends = textscan.words(buffer)
        return starts, ends, textscan.hashes(buffer, starts, ends)


_BYTE = textscan.mix(np.arange(1, 257, dtype=np.uint64))

CHUNK_SCHEMA = "chunk long, docs binary, sizes binary, data binary"


def chunks(docs: DataFrame, buckets: int) -> DataFrame:
    """Written table of chunks: keys, byte lengths and compressed UTF-8 of consecutive rows."""
    def run(batches):
        import zstandard
        part, number, pack = TaskContext.get().partitionId(), 0, zstandard.ZstdCompressor(level=3)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            ids = batch.column("doc_id").fill_null(NULL_KEY).to_numpy()
            for a, b in by_size(texts, CHUNK):
                raw = [t.encode() for t in texts[a:b]]
                sizes = np.fromiter(map(len, raw), np.int64, len(raw))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([(part << 32) + number], pa.int64()), pa.array([ids[a:b].tobytes()], pa.binary()),
                     pa.array([sizes.tobytes()], pa.binary()), pa.array([pack.compress(b"".join(raw))], pa.binary())],
                    ["chunk", "docs", "sizes", "data"])
                number += 1

    return _bucketed_table(arrow_map(documents(docs), run, CHUNK_SCHEMA), buckets, "chunks")


def _bucketed_table(df: DataFrame, buckets: int, kind: str) -> DataFrame:
    """``df`` as a written table that joins others on ``chunk`` without being moved."""
    spark, name = df.sparkSession, f"{kind}_{uuid.uuid4().hex}"
    df.write.bucketBy(buckets, "chunk").option("path", f"{scratch_dir(spark)}/{name}").saveAsTable(name)
    return spark.table(name)


class Chunk:
    """A chunk's documents, symbols and runs.  Symbols never cross documents: documents of
    words are parted by a line feed, of bytes by their edges alone."""

    def __init__(self, row: dict, spec: Spec):
        import zstandard
        self.spec = spec
        self.docs = np.frombuffer(row["docs"], np.int64)
        sizes = np.frombuffer(row["sizes"], np.int64)
        data = zstandard.ZstdDecompressor().decompress(row["data"]) if sizes.sum() else b""
        edges = np.concatenate([[0], np.cumsum(sizes)])
        if spec.words:
            self.buffer, edges = textscan.join([data[a:b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())])
        else:
            self.buffer = np.frombuffer(data, np.uint8)
        self.raw = self.buffer.tobytes()
        self.starts, self.ends, self.symbols = spec.split(self.buffer)
        self.first = np.searchsorted(self.starts, edges)

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """First window, number of windows and minimizer of every run, and whether its own
        windows can repeat (the minimizer stands there twice and places count)."""
        w, spec = self.spec.window, self.spec
        grams = w - (1 << spec.log_gram) + 1
        starts, counts, least, twice = [], [], [], []
        first, d, n = self.first, 0, len(self.first) - 1
        while d < n:
            e = d + 1
            while e < n and first[e + 1] - first[d] <= _SYMBOLS_AT_ONCE:
                e += 1
            h = self.symbols[first[d]:first[e]]
            if len(h) >= w:
                for k in range(spec.log_gram):
                    h = h[:-(1 << k)] * np.uint64(0x9E3779B97F4A7C15 + 2 * k) + h[1 << k:]
                h = textscan.mix(h)
                m, p = h, 1
                while 2 * p <= grams:
                    m = np.minimum(m[:-p], m[p:])
                    p *= 2
                if grams > p:
                    m = np.minimum(m[:p - grams], m[grams - p:])
                # windows that cross a document's end are no windows
                owner = np.repeat(np.arange(e - d), np.diff(first[d:e + 1]))
                own = owner[:len(m)]
                valid = own == owner[w - 1:]
                new = np.ones(len(m), bool)
                new[1:] = (m[1:] != m[:-1]) | (own[1:] != own[:-1]) | ~valid[:-1]
                new &= valid
                at = np.flatnonzero(new)
                stop = np.flatnonzero(np.append(new | ~valid, True))
                length = stop[np.searchsorted(stop, at, "right")] - at
                pieces = -(-length // LONGEST_RUN)
                if len(at) and pieces.max() > 1:
                    k = np.arange(int(pieces.sum())) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                    at, length = np.repeat(at, pieces) + k * LONGEST_RUN, np.repeat(length, pieces) - k * LONGEST_RUN
                    length = np.minimum(length, LONGEST_RUN)
                starts.append(at + first[d])
                counts.append(length)
                least.append(m[at])
                again = np.zeros(len(at), bool)
                if spec.by_position and len(at):
                    span = length + grams - 1
                    same = h[ragged(at, span)] == np.repeat(m[at], span)
                    again = np.add.reduceat(same, np.cumsum(span) - span, dtype=np.int64) > 1
                twice.append(again)
            d = e
        z = np.zeros(0, np.int64)
        return (np.concatenate([z, *starts]), np.concatenate([z, *counts]), np.concatenate([np.zeros(0, np.uint64), *least]),
                np.concatenate([np.zeros(0, bool), *twice]))

    def contents_bytes(self, start: np.ndarray, count: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct minimizers of runs and the bytes of the distinct contents of each."""
        distinct, back = np.unique(least, return_inverse=True)
        stop = start + count + self.spec.window - 1
        # contents told apart by a polynomial of their symbols, whose powers wrap around
        base = np.uint64(0x9E3779B97F4A7C15)
        power = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(len(self.symbols), base)]), dtype=np.uint64)
        upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.symbols * power[:-1], dtype=np.uint64)])
        alike = (upto[stop] - upto[start]) * power[len(self.symbols) - start]
        size = self.ends[stop - 1] - self.starts[start]
        order = np.lexsort((alike, back))
        new = np.ones(len(order), bool)
        new[1:] = (alike[order][1:] != alike[order][:-1]) | (back[order][1:] != back[order][:-1])
        own = order[new]
        return distinct, np.bincount(back[own], size[own], len(distinct))

    def content(self, start: int, windows: int) -> bytes:
        return self.raw[self.starts[start]:self.ends[start + windows + self.spec.window - 2]]


def _bucketed(minimizers: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of distinct minimizers by bucket, where each bucket begins, and 32 more bits of each."""
    h = textscan.mix(minimizers + np.uint64(0x51ED270B))
    bucket = (h % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(buckets + 1)), (h >> np.uint64(32)).astype(np.uint32)[order]


def _seen(table: DataFrame, spec: Spec, buckets: int) -> DataFrame:
    """``chunk, seen`` (list of ``bucket, twice, frequent``: bit masks over the chunk's distinct
    minimizers in that bucket)."""
    def send(batches):
        for batch in batches:
            for row in batch.to_pylist():
                chunk = Chunk(row, spec)
                distinct, size = chunk.contents_bytes(*chunk.runs()[:3])
                order, edge, bits = _bucketed(distinct, buckets)
                eighths = np.minimum(np.ceil(8 * np.log2(np.maximum(size, 1))), 255).astype(np.uint8)[order]  # sizes in a byte, rounded up
                own = np.flatnonzero(np.diff(edge))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own.astype(np.int32)), pa.array(np.full(len(own), row["chunk"])),
                     *(pa.array([x[edge[b]:edge[b + 1]].tobytes() for b in own], pa.binary()) for x in (bits, eighths))], ["bucket", "chunk", "hashes", "sizes"])

    def answer(group: pa.Table) -> pa.Table:
        blobs = group.column("hashes").to_pylist()
        lens = [len(b) // 4 for b in blobs]
        _, back, count = np.unique(np.frombuffer(b"".join(blobs), np.uint32), return_inverse=True, return_counts=True)
        size = np.bincount(back, 2 ** (np.frombuffer(b"".join(group.column("sizes").to_pylist()), np.uint8) / 8), len(count))
        ends = np.cumsum(lens)
        masks = [[np.packbits(x[e - n:e]).tobytes() for e, n in zip(ends, lens)]
                 for x in ((count >= 2)[back], ((count >= FREQUENT) | (size >= CROWDED))[back])]
        return pa.table({"chunk": group.column("chunk"), "bucket": group.column("bucket"),
                         "twice": pa.array(masks[0], pa.binary()), "frequent": pa.array(masks[1], pa.binary())})

    sent = arrow_map(table, send, "bucket int, chunk long, hashes binary, sizes binary")
    got = sent.groupBy("bucket").applyInArrow(answer, "chunk long, bucket int, twice binary, frequent binary")
    return got.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "twice", "frequent")).alias("seen"))


class Contents:
    """A chunk's distinct contents of repeated minimizers, in a fixed order: number of windows,
    whether own windows can repeat, bucket, hashes of minimizer and content, first place
    (``doc, pos``) and all first windows (``places``).  Found once a chunk and written
    (``_contents``); every later step reads the columns back (``Contents.read``)."""

    COLUMNS = {"windows": "<i4", "route": "<u8", "hash": "<u8", "doc": "<i8", "pos": "<i4", "times": "<i4", "places": "<i4"}
    FLAGS = {"again": "windows", "place_later": "places"}  # bit masks as long as the named column

    def __init__(self, chunk: Chunk, seen: list | None, buckets: int, routes: int):
        import xxhash
        spec = chunk.spec
        start, count, least, again = chunk.runs()
        distinct, back, times = np.unique(least, return_inverse=True, return_counts=True)
        order, edge, _ = _bucketed(distinct, buckets)
        twice, often = times >= 2, np.zeros(len(distinct), bool)
        twice[back[again]] = True
        for s in seen or []:
            own = order[edge[s["bucket"]]:edge[s["bucket"] + 1]]
            twice[own] |= np.unpackbits(np.frombuffer(s["twice"], np.uint8), count=len(own)).astype(bool)
            often[own] = np.unpackbits(np.frombuffer(s["frequent"], np.uint8), count=len(own)).astype(bool)
        whole, single = twice[back] & ~often[back], twice[back] & often[back]
        route = textscan.mix(distinct)[back]
        runs = list(zip(start[whole].tolist(), count[whole].tolist(), again[whole].tolist(), route[whole].tolist()))
        runs += [(s + i, 1, False, None) for s, n in zip(start[single].tolist(), count[single].tolist()) for i in range(n)]
        found: dict[bytes, list] = {}
        for s, n, r, m in runs:
            c = chunk.content(s, n)
            if spec.words:
                c = b" ".join(c.split())
            got = found.get(c)
            if got is None:
                found[c] = [n, r, m, [s]]
            else:
                got[3].append(s)
        content, vals = list(found), found.values()
        k = len(found)
        self.windows = np.fromiter((v[0] for v in vals), np.int64, k)
        self.again = np.fromiter((v[1] for v in vals), bool, k)
        self.hash = np.fromiter(map(xxhash.xxh64_intdigest, content), np.uint64, k)
        # a window of its own is told by two hashes, as a content is by its minimizer's and its own
        self.route = np.fromiter((xxhash.xxh64_intdigest(c, 1) if v[2] is None else v[2] for c, v in found.items()), np.uint64, k)
        self.bucket = (self.route % np.uint64(routes)).astype(np.int64)
        self.times = np.fromiter((len(v[3]) for v in vals), np.int64, k)
        self.places = np.fromiter((p for v in vals for p in v[3]), np.int64, int(self.times.sum()))
        own = np.searchsorted(chunk.first, self.places, "right") - 1
        self.place_doc = chunk.docs[own] if len(own) else np.zeros(0, np.int64)
        self.place_pos = self.places - chunk.first[own] if spec.by_position else np.zeros(len(own), np.int64)
        of = np.repeat(np.arange(k), self.times)
        by = np.lexsort((self.place_pos, self.place_doc, of))
        first = by[np.cumsum(self.times) - self.times]
        self.doc, self.pos = self.place_doc[first], self.place_pos[first]
        self.place_later = (self.place_doc != self.doc[of]) | (self.place_pos != self.pos[of])
        self.of = of

    def write(self) -> dict[str, bytes]:
        return ({k: getattr(self, k).astype(t).tobytes() for k, t in self.COLUMNS.items()}
                | {k: np.packbits(getattr(self, k)).tobytes() for k in self.FLAGS})

    @classmethod
    def read(cls, row: dict, routes: int) -> Contents:
        c = cls.__new__(cls)
        for k in cls.COLUMNS.keys() & row.keys():
            setattr(c, k, np.frombuffer(row[k], cls.COLUMNS[k]))
        for k in cls.FLAGS.keys() & row.keys():
            n = len(getattr(c, cls.FLAGS[k]))
            setattr(c, k, np.unpackbits(np.frombuffer(row[k], np.uint8), count=n).astype(bool))
        c.bucket = (c.route % np.uint64(routes)).astype(np.int64)
        if "times" in row:
            c.of = np.repeat(np.arange(len(c.times)), c.times)
        return c

    def texts(self, chunk: Chunk, pick: np.ndarray) -> list[bytes]:
        """The picked contents' own text, words parted by one space."""
        first = self.places[np.cumsum(self.times) - self.times][pick].tolist()
        out = [chunk.content(p, n) for p, n in zip(first, self.windows[pick].tolist())]
        return [b" ".join(c.split()) for c in out] if chunk.spec.words else out

    def by_bucket(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Order by bucket, the buckets that occur, and their edges in that order."""
        order = np.argsort(self.bucket, kind="stable")
        own, at = np.unique(self.bucket[order], return_index=True)
        return order, own, np.append(at, len(order))


def _contents(table: DataFrame, spec: Spec, buckets: int, routes: int) -> DataFrame:
    """``chunk`` and the columns of its ``Contents``."""
    names = [*Contents.COLUMNS, *Contents.FLAGS]

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                c = Contents(Chunk(row, spec), row["seen"], buckets, routes).write()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["chunk"]], pa.int64()), *(pa.array([c[k]], pa.binary()) for k in names)], ["chunk", *names])

    return arrow_map(table, run, "chunk long, " + ", ".join(f"{k} binary" for k in names))


def _copies(contents: DataFrame, routes: int) -> DataFrame:
    """``chunk, copies`` (list of ``bucket, later, several``: bit masks over the chunk's contents in
    that bucket)."""
    def send(batches):
        for batch in batches:
            for row in batch.to_pylist():
                c = Contents.read(row, routes)
                order, own, edge = c.by_bucket()
                parts = [order[a:b] for a, b in zip(edge[:-1], edge[1:])]
                cols = [(c.route >> np.uint64(32)).astype("<u4"), c.hash.astype("<u8"), c.doc.astype("<i8"), c.pos.astype("<i4")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own.astype(np.int32)), pa.array(np.full(len(own), row["chunk"]))]
                    + [pa.array([x[p].tobytes() for p in parts], pa.binary()) for x in cols], ["bucket", "chunk", "m", "h", "doc", "pos"])

    def answer(group: pa.Table) -> pa.Table:
        m, h, doc, pos = (np.frombuffer(b"".join(group.column(k).to_pylist()), t) for k, t in (("m", "<u4"), ("h", "<u8"), ("doc", "<i8"), ("pos", "<i4")))
        lens = [len(x) // 4 for x in group.column("m").to_pylist()]
        order = np.lexsort((pos, doc, h, m))
        new = np.ones(len(order), bool)
        new[1:] = (m[order][1:] != m[order][:-1]) | (h[order][1:] != h[order][:-1])
        first = order[np.flatnonzero(new)][np.cumsum(new) - 1]
        later, several = np.zeros(len(order), bool), np.zeros(len(order), bool)
        later[order] = (doc[order] != doc[first]) | (pos[order] != pos[first])
        _, back, count = np.unique(m[order][new], return_inverse=True, return_counts=True)
        several[order] = (count[back] >= 2)[np.cumsum(new) - 1]
        ends = np.cumsum(lens)
        masks = [[np.packbits(x[e - n:e]).tobytes() for e, n in zip(ends, lens)] for x in (later, several)]
        return pa.table({"chunk": group.column("chunk"), "bucket": group.column("bucket"),
                         "later": pa.array(masks[0], pa.binary()), "several": pa.array(masks[1], pa.binary())})

    sent = arrow_map(contents.select("chunk", "route", "hash", "doc", "pos"), send, "bucket int, chunk long, m binary, h binary, doc binary, pos binary")
    got = sent.groupBy("bucket").applyInArrow(answer, "chunk long, bucket int, later binary, several binary")
    return got.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "later", "several")).alias("copies"))


def _answered(c: Contents, copies: list | None) -> tuple[np.ndarray, np.ndarray]:
    """Of each content: is it a later copy; does its text have to be looked at?"""
    order, own, edge = c.by_bucket()
    later, several = np.zeros(len(order), bool), np.zeros(len(order), bool)
    at = {b: order[x:y] for b, x, y in zip(own.tolist(), edge[:-1].tolist(), edge[1:].tolist())}
    for s in copies or []:
        mine = at[s["bucket"]]
        for mask, bits in ((later, s["later"]), (several, s["several"])):
            mask[mine] = np.unpackbits(np.frombuffer(bits, np.uint8), count=len(mine)).astype(bool)
    return later, ~later & (several | c.again)


Solver = Callable[[list[bytes], np.ndarray, np.ndarray, np.ndarray], list[np.ndarray]]


def covered(docs: DataFrame, spec: Spec, solve: Solver, finish: Callable[[Chunk, np.ndarray], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Mark every symbol in a window that also starts earlier and give ``finish`` each chunk
    with its mask.  ``solve(contents, windows, doc, pos)`` gets a bucket's contents in order
    of (doc, pos, text) and says of each window whether it occurs earlier."""
    buckets = max(12, input_bytes(documents(docs)) // (16 << 20))
    routes = 2 * buckets
    width = max(buckets, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    table = chunks(docs, width)
    seen = materialize(_seen(table, spec, buckets), "seen")
    contents = _bucketed_table(_contents(table.join(seen, "chunk", "left"), spec, buckets, routes), width, "contents")
    copies = materialize(_copies(contents, routes), "copies")
    table = table.join(contents, "chunk").join(copies, "chunk", "left")

    def send(batches):
        for batch in batches:
            for row in batch.to_pylist():
                c = Contents.read(row, routes)
                pick = np.flatnonzero(_answered(c, row["copies"])[1])
                if not len(pick):
                    continue
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c.bucket[pick].astype(np.int32)), pa.array(np.full(len(pick), row["chunk"])), pa.array(pick.astype(np.int32)),
                     pa.array((c.route[pick] >> np.uint64(33)).astype(np.int32)), pa.array(c.texts(Chunk(row, spec), pick), pa.binary()),
                     *(pa.array(x[pick].astype(np.int64)) for x in (c.windows, c.doc, c.pos))],
                    ["bucket", "chunk", "number", "part", "content", "windows", "doc", "pos"])

    def decide(group: pa.Table) -> pa.Table:
        group = group.sort_by([("doc", "ascending"), ("pos", "ascending"), ("content", "ascending")])
        windows, doc, pos = (group.column(k).to_numpy() for k in ("windows", "doc", "pos"))
        contents = group.column("content").to_pylist()
        parts = -(-sum(map(len, contents)) // spec.together) if spec.together else 1
        if parts > 1:
            part = group.column("part").to_numpy() % parts
            by = np.argsort(part, kind="stable")
            flags = [None] * len(contents)
            for own in np.split(by, np.flatnonzero(np.diff(part[by])) + 1):
                for i, f in zip(own.tolist(), solve([contents[i] for i in own.tolist()], windows[own], doc[own], pos[own])):
                    flags[i] = f
        else:
            flags = solve(contents, windows, doc, pos)
        some = pa.array([i for i, f in enumerate(flags) if f.any()], pa.int64())
        return pa.table({"chunk": group.column("chunk").take(some), "number": group.column("number").take(some),
                         "flags": pa.array([np.packbits(flags[i]).tobytes() for i in some.to_pylist()], pa.binary())})

    sent = arrow_map(table, send, "bucket int, chunk long, number int, part int, content binary, windows long, doc long, pos long")
    flags = (sent.groupBy("bucket").applyInArrow(decide, "chunk long, number int, flags binary")
             .groupBy("chunk").agg(F.collect_list(F.struct("number", "flags")).alias("found")))

    def mark(batches):
        for batch in batches:
            for row in batch.to_pylist():
                chunk = Chunk(row, spec)
                c = Contents.read(row, routes)
                later, _ = _answered(c, row["copies"])
                edge = np.zeros(len(chunk.symbols) + 1, np.int32)
                whole = later[c.of] | c.place_later
                np.add.at(edge, c.places[whole], 1)
                np.add.at(edge, c.places[whole] + c.windows[c.of[whole]] + spec.window - 1, -1)
                ends = np.cumsum(c.times)
                for f in row["found"] or []:
                    i = f["number"]
                    step = np.diff(np.unpackbits(np.frombuffer(f["flags"], np.uint8), count=int(c.windows[i])).astype(np.int8), prepend=0, append=0)
                    begin, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
                    mine = slice(ends[i] - c.times[i], ends[i])
                    for p in c.places[mine][~c.place_later[mine]]:
                        edge[p + begin] += 1
                        np.add.at(edge, p + end + spec.window - 1, -1)
                yield from finish(chunk, np.cumsum(edge[:-1]) > 0)

    return arrow_map(table.join(materialize(flags, "flags"), "chunk", "left"), mark, schema)


def null_keys(docs: np.ndarray) -> pa.Array:
    return pa.array(docs, mask=docs == NULL_KEY)
