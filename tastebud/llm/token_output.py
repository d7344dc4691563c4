"""Token ids of a corpus as Simple-8b files in ascending record order.

Documents are range-partitioned and sorted by ``doc_id``, so the parts and the
segments inside a part are in order.  A segment holds whole documents of about
``SEGMENT`` ids as one binary Simple-8b stream with the documents' keys and
lengths; segments are rows of a table in shared storage (one file a part), written
by Spark's committer, so that a lost executor costs its part again and no more.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import simple8b, textscan
from .common import arrow_map, documents
from .units import UnitCache, stretches

SEGMENT = 1 << 18


class WordBPE:
    """A ``tokenizers`` file whose pre-tokenizer drops white space and whose vocabulary
    marks word ends: a text's ids are those of its space-separated units in turn."""

    def __init__(self, path: str):
        import json
        import os

        import regex
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.lib.no_padding()
        self.lib.no_truncation()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        suffix = spec["model"]["end_of_word_suffix"]
        size = max([*spec["model"]["vocab"].values(), *(a["id"] for a in spec["added_tokens"])]) + 1
        self.ends = np.zeros(size, bool)
        for t, i in spec["model"]["vocab"].items():
            self.ends[i] = t.endswith(suffix)
        self.added = [a["content"] for a in spec["added_tokens"]]
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pieces = regex.compile(split["pattern"]["Regex"], regex.IGNORECASE)
        self.find_added = re.compile(b"|".join(re.escape(a.lower().encode()) for a in self.added) or b"(?!)")
        # letters that normalise one by one
        self.plain = re.compile("[a-zß-öø-ÿ]+\\Z")
        self.cache = UnitCache(self._encode_units)

    def _encode_units(self, units: list[bytes]) -> Iterator[list[int]]:
        """Joined by spaces the library encodes many units in one call, and word ends tell them
        apart; units whose pieces only normalising can tell are encoded each."""
        for a in range(0, len(units), 1024):
            part = list(map(bytes.decode, units[a:a + 1024]))
            rest = [u for u in part if not (u.isascii() or self.plain.match(u))]
            single = iter(self.lib.encode_batch_fast(rest, add_special_tokens=False) if rest else ())
            many = iter(self._encode([u for u in part if u.isascii() or self.plain.match(u)]))
            for u in part:
                yield next(many) if u.isascii() or self.plain.match(u) else next(single).ids

    def _encode(self, units: list[str]) -> list[list[int]]:
        if not units:
            return []
        upto = np.cumsum([0, *(1 if u.isalpha() else len(self.pieces.findall(u)) for u in units)])
        ids = np.array(self.lib.encode_batch_fast([" ".join(units)], add_special_tokens=False)[0].ids, np.int64)
        ends = np.concatenate([[0], np.flatnonzero(self.ends[ids]) + 1])
        if len(ends) - 1 != upto[-1] or len(ids) != ends[-1]:  # an added token is among them
            return [self.lib.encode(u, add_special_tokens=False).ids for u in units]
        edges, flat = ends[upto].tolist(), ids.tolist()
        return [flat[x:y] for x, y in zip(edges, edges[1:])]

    def encode(self, buffer: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, concatenated, and the count of each."""
        # ids don't see the case of letters, but an added token does, and so may a mark that joins the letter
        buffer, given = textscan.LOWER[buffer], buffer
        joined = np.flatnonzero(given[1:] >= 0x80)
        buffer[joined] = given[joined]
        added = textscan.spans(buffer, edges, self.find_added)
        for i, j in added.tolist():
            buffer[i:j] = given[i:j]
        n = len(buffer)
        gap, edge = np.ones(n + 2, bool), np.append(textscan.changes(buffer), True)  # gap[i + 1]: byte i is white space; edge[i]: a cut
        for i, j in added.tolist():
            edge[i + 1:j] = False
        gap[1:-1], edge[edges] = textscan.SPACE[buffer], True
        starts = np.flatnonzero(~gap[1:-1] & (gap[:-2] | edge[:-1]))
        ends = np.flatnonzero(~gap[1:-1] & (gap[2:] | edge[1:])) + 1
        return self.cache.texts(buffer, edges, starts, ends)


_loaded: dict[str, WordBPE] = {}


def load(path: str) -> WordBPE:
    if path not in _loaded:
        _loaded[path] = WordBPE(path)
    return _loaded[path]


SEGMENT_SCHEMA = "part int, segment int, before long, docs binary, nulls binary, lens binary, payload binary"


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int, segment: int = SEGMENT) -> None:
    """Encode every whole text, append ``end_id`` and write the files under ``path``.

    A null or empty text has the end id alone.  Null keys come first, rows
    of equal keys are in order of their texts' hashes, repeated rows are written each.  ``before``: ids of the part before the segment."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part = load(tokenizer), TaskContext.get().partitionId()
        number = before = held = 0
        keys, nulls, lens, ids = [], [], [], []

        def flush() -> pa.RecordBatch:
            row = [part, number, before, np.concatenate(keys).tobytes(), np.concatenate(nulls).tobytes(),
                   np.concatenate(lens).tobytes(), simple8b.encode(np.concatenate(ids))]
            kinds = [pa.int32(), pa.int32(), pa.int64()] + [pa.binary()] * 4
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds)],
                                              ["part", "segment", "before", "docs", "nulls", "lens", "payload"])

        for batch in batches:
            buffer, edges = textscan.column(batch.column("text"))
            doc = batch.column("doc_id")
            null = doc.is_null().to_numpy(zero_copy_only=False)
            key = doc.fill_null(0).to_numpy()
            for a, b in stretches(edges):
                own, counts = words.encode(buffer[edges[a]:edges[b]], edges[a:b + 1] - edges[a])
                counts = counts + 1
                out = np.empty(int(counts.sum()), np.uint32)
                stops = np.cumsum(counts) - 1
                last = np.zeros(len(out), bool)
                last[stops] = True
                out[last], out[~last] = end_id, own
                keys.append(key[a:b])
                nulls.append(null[a:b])
                lens.append(counts.astype(np.int64))
                ids.append(out)
                held += len(out)
                if held >= segment:
                    yield flush()
                    number, before, held = number + 1, before + held, 0
                    keys, nulls, lens, ids = [], [], [], []
        if held:
            yield flush()

    # by a hash beside the key: the range sample goes to the driver and must not hold texts
    keyed = documents(docs).withColumn("tie", F.xxhash64("text"))
    ordered = keyed.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    arrow_map(ordered, run, SEGMENT_SCHEMA).write.parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The files' segments with ``first``: ids of all documents before the segment.

    The running sum goes over the parts (one row a file, whose number the writer
    chose), and those few sums are broadcast."""
    seg = spark.read.schema(SEGMENT_SCHEMA).parquet(path)
    parts = seg.groupBy("part").agg(F.max(F.struct("before", "lens")).alias("m"))
    # the last segment's start plus its own ids: lengths are summed from the binary column in the task
    totals = arrow_map(parts.select("part", F.col("m.before").alias("before"), F.col("m.lens").alias("lens")), _totals, "part int, n long")
    first = (totals.withColumn("first_of_part", F.coalesce(
        F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .select("part", "first_of_part"))
    return seg.join(F.broadcast(first), "part").withColumn("first", F.col("first_of_part") + F.col("before")).drop("first_of_part")


def _totals(batches):
    for b in batches:
        n = [x + int(np.frombuffer(y, np.int64).sum()) for x, y in zip(b.column("before").to_pylist(), b.column("lens").to_pylist())]
        yield pa.RecordBatch.from_arrays([b.column("part"), pa.array(n, pa.int64())], ["part", "n"])


def _documents(batches) -> Iterator[tuple]:
    for b in batches:
        for row in b.to_pylist():
            lens = np.frombuffer(row["lens"], np.int64)
            null = np.frombuffer(row["nulls"], np.bool_)
            doc = pa.array(np.frombuffer(row["docs"], np.int64), mask=null)
            yield doc, row["first"], lens, simple8b.decode(row["payload"]).astype("<u4")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, ids array<long>`` of every document in the files."""
    def run(batches):
        for doc, first, lens, ids in _documents(batches):
            ends = np.cumsum(lens)
            lists = pa.ListArray.from_arrays(np.concatenate([[0], ends]).astype(np.int32), ids.astype(np.int64))
            yield pa.RecordBatch.from_arrays([doc, pa.array(first + ends - lens, pa.int64()), lists], ["doc_id", "start", "ids"])
    return arrow_map(read_tokens(spark, path), run, "doc_id long, start long, ids array<long>")


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` (of the ids as little-endian u32), from the files."""
    def run(batches):
        for doc, first, lens, ids in _documents(batches):
            ends = np.cumsum(lens)
            data = memoryview(ids.tobytes())
            crc = [zlib.crc32(data[4 * (e - n):4 * e]) for e, n in zip(ends.tolist(), lens.tolist())]
            yield pa.RecordBatch.from_arrays([doc, pa.array(first + ends - lens, pa.int64()), pa.array(lens, pa.int64()), pa.array(crc, pa.int64())],
                                             ["doc_id", "start", "n_tokens", "ids_crc32"])
    return arrow_map(read_tokens(spark, path), run, "doc_id long, start long, n_tokens long, ids_crc32 long")
