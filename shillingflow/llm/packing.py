"""Best-fit packing by sums of squares.

Documents become pieces of at most one sequence's length. A piece goes into the open sequence for
which the sum, over all gaps, of the squared number of open sequences with that gap gets smallest;
a new sequence is opened when none has room. Longest pieces come first. Groups of pieces are packed
side by side, so a task holds a bounded group and the loss is at most about one sequence for each.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import groups_for, released_group
from .tokens import pack_ids, tokenize, unpack_ids

CAPACITY = 2048
GROUP_DOCS, GROUP_BYTES = 4096, 16 << 20


def assign(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece, in the given order of pieces."""
    open_ = np.zeros(capacity + 1, np.int64)  # open sequences by gap
    by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    sequence, offset, n = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), 0
    shut = np.iinfo(np.int64).max
    for i, size in enumerate(lengths.tolist()):
        # moving one sequence from gap g to g - size changes the sum by 2 N(g - size) - 2 N(g) + 2
        change = 2 * open_[: capacity + 1 - size] - 2 * open_[size:] + 2
        change[0] = 1 - 2 * open_[size]  # a full sequence leaves the sum
        change[open_[size:] == 0] = shut
        at = int(change.argmin())
        if change[at] < shut:
            gap = size + at
            seq = by_gap[gap].pop()
            open_[gap] -= 1
        else:
            gap, seq, n = capacity, n, n + 1
        sequence[i], offset[i] = seq, capacity - gap
        if gap > size:
            open_[gap - size] += 1
            by_gap[gap - size].append(seq)
    return sequence, offset


def pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int | None = 0, vocab: str | None = None) -> DataFrame:
    """``doc_id, piece, start, length, ids``: only documents longer than a sequence are cut."""
    def cut(docs: pa.Array, ids: list[np.ndarray]) -> pa.RecordBatch:
        sizes = np.array([len(x) for x in ids], np.int64)
        n = -(-sizes // capacity)
        doc = np.repeat(np.arange(len(n)), n)
        piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
        start = piece * capacity
        parts = [pack_ids(ids[d][lo:lo + capacity]) for d, lo in zip(doc.tolist(), start.tolist())]
        return pa.RecordBatch.from_arrays([
            docs.take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
            pa.array(np.minimum(capacity, sizes[doc] - start), pa.int64()), pa.array(parts, pa.binary())],
            ["doc_id", "piece", "start", "length", "ids"])

    return tokenize(docs, vocab, end_id, cut, "doc_id long, piece int, start long, length long, ids binary")


PACKED = "doc_id long, piece int, start long, length long, ids binary, sequence_id long, offset long"


def pack(docs: DataFrame, capacity: int = CAPACITY, end_id: int | None = 0, vocab: str | None = None,
         present: Callable[[pa.Table], pa.Table] | None = None, schema: str = PACKED) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``; ``present`` may give other columns of a packed group.

    Null and empty texts are a piece of the end id alone (without an end id, none); repeated rows are
    packed as rows of their own; very long texts give many pieces, dealt to groups one by one; an empty
    table gives no rows. Other columns of ``docs`` play no part.
    """
    size = docs.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b")).first()
    groups = max(groups_for(size.n, GROUP_DOCS, 1), groups_for(size.b, GROUP_BYTES, 1))
    dealt = pieces(docs, capacity, end_id, vocab).withColumn("group", F.pmod(F.xxhash64("doc_id", "piece", "ids"), F.lit(groups)))

    def place(part: pa.Table) -> pa.Table:
        part = part.take(pc.sort_indices(part, [("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending")]))
        sequence, offset = assign(part["length"].to_numpy(), capacity)
        sequence += part["group"][0].as_py() << 32
        part = part.drop_columns(["group"]).append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))
        return present(part) if present else part

    return dealt.groupBy("group").applyInArrow(released_group(place), schema)


def op2(docs: DataFrame) -> DataFrame:
    def digest(part: pa.Table) -> pa.Table:
        crc = [zlib.crc32(unpack_ids(x).tobytes()) for x in part["ids"].to_pylist()]
        return part.drop_columns(["ids"]).append_column("ids_crc32", pa.array(crc, pa.int64()))

    return pack(docs, present=digest, schema=PACKED.replace("ids binary, ", "") + ", ids_crc32 long")
