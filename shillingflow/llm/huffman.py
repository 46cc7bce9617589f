"""Token ids in files: canonical, length-limited Huffman codes from global counts.

A file is a sequence of blocks that decode on their own, given the code table. A block holds whole
documents in ascending order of their ids; each document starts at a byte, and a checkpoint gives
the bit at which every 64th id begins. Decoding runs from all checkpoints of many blocks at once,
one table look-up an id.

Layout under a path: ``codes`` (id, length) and ``blocks`` (one folder per part, parts ascending).
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import shared_dir
from .common import partitions
from .tokens import pack_ids, tokenize, unpack_ids

LIMIT = 16  # bits of the longest code; more only if the ids in use need it
EVERY = 64
BLOCK = 1 << 16  # ids after which a block ends
BLOCKS = "part int, block int, first_id long, n_ids long, doc_ids binary, null_ids binary, sizes binary, starts binary, marks binary, bits binary"


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits, by package-merge."""
    n = len(counts)
    if n <= 1:
        return np.ones(n, np.int64)
    limit = max(limit, (n - 1).bit_length())
    order = np.argsort(counts, kind="stable")
    leaves = counts[order].astype(np.float64)
    levels, packages = [], np.zeros(0)
    for _ in range(limit):
        both = np.concatenate([leaves, packages])
        by = np.argsort(both, kind="stable")
        levels.append(by < n)
        both = both[by]
        packages = both[: len(both) // 2 * 2].reshape(-1, 2).sum(axis=1)
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for leaf in reversed(levels):
        k = int(leaf[:take].sum())
        lengths[order[:k]] += 1
        take = 2 * (take - k)
    return lengths


class Codes:
    """Canonical codes: by length, then id. Only the lengths need to be stored."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray):
        by = np.lexsort((ids, lengths))
        self.ids, self.lengths = ids[by].astype(np.uint32), lengths[by].astype(np.uint64)
        self.width = int(self.lengths.max(initial=1))
        steps = np.uint64(1) << (np.uint64(self.width) - self.lengths)
        self.codes = (np.cumsum(steps, dtype=np.uint64) - steps) >> (np.uint64(self.width) - self.lengths)
        self.steps = steps

    def encoding(self) -> tuple[np.ndarray, np.ndarray]:
        """Code and length by id."""
        n = int(self.ids.max(initial=0)) + 1
        code, length = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
        code[self.ids], length[self.ids] = self.codes, self.lengths
        return code, length

    def decoding(self) -> tuple[np.ndarray, np.ndarray]:
        """Id and length by the next ``width`` bits."""
        n = self.steps.astype(np.int64)
        pad = (1 << self.width) - int(n.sum())
        return (np.concatenate([np.repeat(self.ids, n), np.zeros(pad, np.uint32)]),
                np.concatenate([np.repeat(self.lengths.astype(np.int64), n), np.ones(pad, np.int64)]))


def write_bits(ids: np.ndarray, sizes: np.ndarray, table: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of documents' ids, the byte at which each document starts, and the checkpoints (bits within the document)."""
    code, length = table[0][ids], table[1][ids]
    ends = np.cumsum(sizes)
    upto = np.concatenate([[0], np.cumsum(length.astype(np.int64))])
    bits = upto[ends] - upto[ends - sizes]
    starts = np.concatenate([[0], np.cumsum((bits + 7) // 8)])
    shift = starts[:-1] * 8 - upto[ends - sizes]  # documents start at bytes
    at = upto[:-1] + np.repeat(shift, sizes)
    mark = _nth(sizes)
    marks = (at[mark] - np.repeat(starts[:-1] * 8, (sizes + EVERY - 1) // EVERY)).astype("<u4")
    words = np.zeros((int(starts[-1]) + 3) // 4 + 2, np.uint64)
    if len(ids):
        value = code << (np.uint64(64) - (at & 31).astype(np.uint64) - length)
        word = at >> 5
        first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))  # codes never overlap, so sums are unions
        words[word[first]] += np.add.reduceat(value >> np.uint64(32), first)
        words[word[first] + 1] += np.add.reduceat(value & np.uint64(0xFFFFFFFF), first)
    return words.astype(">u4").view(np.uint8)[: int(starts[-1])], starts, marks


def _nth(sizes: np.ndarray) -> np.ndarray:
    """Positions of every 64th id of each document."""
    n = (sizes + EVERY - 1) // EVERY
    first = np.cumsum(n) - n
    return np.repeat(np.cumsum(sizes) - sizes, n) + (np.arange(int(n.sum())) - np.repeat(first, n)) * EVERY


def read_bits(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, marks: np.ndarray, codes: Codes,
              table: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Ids of documents that start at the given bytes. All checkpoints are followed at the same time."""
    n = (sizes + EVERY - 1) // EVERY
    left = np.full(int(n.sum()), EVERY, np.int64)
    last = np.cumsum(n)[sizes > 0] - 1
    left[last] = (sizes - (n - 1) * EVERY)[sizes > 0]
    by = np.argsort(-left, kind="stable")
    bit = (np.repeat(starts * 8, n) + marks)[by]
    to = _nth(sizes)[by]
    active = len(left) - np.searchsorted(np.sort(left), np.arange(EVERY), side="right")  # lanes with more ids than that
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint32)
    ahead = (padded[:-3] << 24) | (padded[1:-2] << 16) | (padded[2:-1] << 8) | padded[3:]
    out = np.empty(int(sizes.sum()), np.uint32)
    symbol, length = table
    drop, mask = 32 - codes.width, (1 << codes.width) - 1
    for step in range(EVERY):
        lanes = int(active[step])
        if not lanes:
            break
        at = bit[:lanes]
        window = (ahead[at >> 3] >> (drop - (at & 7)).astype(np.uint32)) & np.uint32(mask)
        out[to[:lanes] + step] = symbol[window]
        at += length[window]
    return out


def count_ids(tokens: DataFrame) -> DataFrame:
    """Global counts: at most one row per id of the vocabulary."""
    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(0, np.int64)
        for frame in frames:
            for data in frame["ids"]:
                ids = unpack_ids(data)
                top = int(ids.max(initial=0)) + 1
                if top > len(total):
                    total = np.concatenate([total, np.zeros(top - len(total), np.int64)])
                total += np.bincount(ids, minlength=len(total))
        used = np.flatnonzero(total)
        yield pd.DataFrame({"id": used, "n": total[used]})

    return tokens.select("ids").mapInPandas(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write_ids(tokens: DataFrame, path: str) -> None:
    """Writes ``doc_id, ids`` to files under ``path``, in ascending order of ``doc_id`` (nulls first)."""
    spark = tokens.sparkSession
    counted = count_ids(tokens).orderBy("id").toPandas()  # bounded by the vocabulary
    codes = Codes(counted["id"].to_numpy(np.int64), code_lengths(counted["n"].to_numpy(np.int64)))
    table = spark.createDataFrame(pd.DataFrame({"id": codes.ids.astype(np.int64), "length": codes.lengths.astype(np.int64)}), "id long, length long")
    table.coalesce(1).write.parquet(f"{path}/codes")
    parts = partitions(spark)
    cuts = tokens.filter("doc_id is not null").stat.approxQuantile("doc_id", [i / parts for i in range(1, parts)], 0.25 / parts) if parts > 1 else []
    cuts = np.unique(np.array(cuts or [], np.float64))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_id = codes.encoding()
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                some = batch.slice(lo, 500)
                ids = [unpack_ids(x) for x in some.column("ids").to_pylist()]
                sizes = np.array([len(x) for x in ids], np.int64)
                data, starts, marks = write_bits(np.concatenate(ids), sizes, by_id)
                n = np.concatenate([[0], np.cumsum((sizes + EVERY - 1) // EVERY)])
                docs = some.column("doc_id")
                key = np.array([-np.inf if x is None else x for x in docs.to_pylist()], np.float64)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.searchsorted(cuts, key, side="left"), pa.int32()), docs, pa.array(sizes),
                    pa.array([marks[a:b].tobytes() for a, b in zip(n[:-1], n[1:])], pa.binary()),
                    pa.array([data[a:b].tobytes() for a, b in zip(starts[:-1], starts[1:])], pa.binary())],
                    ["part", "doc_id", "size", "marks", "bits"])

    coded = tokens.select("doc_id", "ids").mapInArrow(code, "part int, doc_id long, size long, marks binary, bits binary")
    dealt = coded.repartitionById(parts, F.col("part")).sortWithinPartitions("part", "doc_id", "size", "bits")
    dealt.mapInArrow(_blocks, BLOCKS).write.partitionBy("part").parquet(f"{path}/blocks")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Gathers sorted documents into blocks; a part is never shared by tasks."""
    part, block, first, rows, n = None, 0, 0, [], 0

    def done() -> pa.RecordBatch:
        starts = np.cumsum([0] + [len(r["bits"]) for r in rows[:-1]])
        row = {"part": part, "block": block, "first_id": first, "n_ids": n,
               "doc_ids": np.array([r["doc_id"] or 0 for r in rows], "<i8").tobytes(),
               "null_ids": np.array([r["doc_id"] is None for r in rows], np.uint8).tobytes(),
               "sizes": np.array([r["size"] for r in rows], "<i8").tobytes(), "starts": starts.astype("<i8").tobytes(),
               "marks": b"".join(r["marks"] for r in rows), "bits": b"".join(r["bits"] for r in rows)}
        return pa.RecordBatch.from_pylist([row], BLOCK_ROW)

    for batch in batches:
        for r in batch.to_pylist():
            if rows and (r["part"] != part or n >= BLOCK):
                yield done()
                block, first, rows, n = (block + 1, first + n, [], 0) if r["part"] == part else (0, 0, [], 0)
            part = r["part"]
            rows.append(r)
            n += r["size"]
    if rows:
        yield done()


BLOCK_ROW = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("first_id", pa.int64()), ("n_ids", pa.int64())] + [
    (x, pa.binary()) for x in ("doc_ids", "null_ids", "sizes", "starts", "marks", "bits")])
Emit = Callable[[pa.Array, np.ndarray, list[np.ndarray]], pa.RecordBatch]


def emit_ids(docs: pa.Array, starts: np.ndarray, ids: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([docs, pa.array(starts), pa.array([pack_ids(x) for x in ids], pa.binary())], ["doc_id", "start", "ids"])


def read_ids(spark: SparkSession, path: str, emit: Emit = emit_ids, schema: str = "doc_id long, start long, ids binary") -> DataFrame:
    """The documents of the files, as ``emit`` presents them; ``start`` counts the ids of all documents before.

    One row per part (as many as the writer had partitions) tells what lies before a part."""
    known = spark.read.parquet(f"{path}/codes").toPandas()
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    totals = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = Codes(known["id"].to_numpy(np.int64), known["length"].to_numpy(np.int64))
        table = codes.decoding()
        for batch in batches:
            for lo in range(0, batch.num_rows, 8):
                some = batch.slice(lo, 8).to_pydict()
                sizes = [np.frombuffer(x, "<i8") for x in some["sizes"]]
                data = [np.frombuffer(x, np.uint8) for x in some["bits"]]
                ahead = np.cumsum([0] + [len(x) for x in data[:-1]])
                starts = np.concatenate([np.frombuffer(x, "<i8") + a for x, a in zip(some["starts"], ahead)])
                marks = np.concatenate([np.frombuffer(x, "<u4") for x in some["marks"]]).astype(np.int64)
                every = np.concatenate(sizes)
                ids = read_bits(np.concatenate(data), starts, every, marks, codes, table)
                docs = pa.array(np.frombuffer(b"".join(some["doc_ids"]), "<i8"), mask=np.frombuffer(b"".join(some["null_ids"]), np.uint8) == 1)
                first = np.concatenate([b + f + np.cumsum(s) - s for b, f, s in zip(some["base"], some["first_id"], sizes)])
                yield emit(docs, first, np.split(ids, np.cumsum(every)[:-1]))

    return blocks.join(F.broadcast(base), "part").mapInArrow(decode, schema)


def encode_documents(docs: DataFrame, path: str, end_id: int | None = 2, vocab: str | None = None) -> None:
    """Tokenises whole texts (null: empty), appends ``end_id`` and writes the files.

    The ids are first written once to the shared folder, since the code table needs the counts of all.
    Repeated rows are documents of their own; an empty table writes an empty code table and no blocks."""
    spark = docs.sparkSession
    scratch = shared_dir(spark, "token-ids")
    tokenize(docs, vocab, end_id).write.option("compression", "zstd").parquet(scratch)
    write_ids(spark.read.schema("doc_id long, ids binary, n_tokens long").parquet(scratch), path)


def op5(docs: DataFrame) -> DataFrame:
    def digest(doc_ids: pa.Array, starts: np.ndarray, ids: list[np.ndarray]) -> pa.RecordBatch:
        crc = [zlib.crc32(x.astype("<u4", copy=False).tobytes()) for x in ids]
        return pa.RecordBatch.from_arrays([doc_ids, pa.array(starts), pa.array([len(x) for x in ids], pa.int64()), pa.array(crc, pa.int64())],
                                          ["doc_id", "start", "n_tokens", "ids_crc32"])

    path = shared_dir(docs.sparkSession, "id-files")
    encode_documents(docs, path)
    return read_ids(docs.sparkSession, path, digest, "doc_id long, start long, n_tokens long, ids_crc32 long")
