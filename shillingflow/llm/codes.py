"""Product codes of vectors: exact Lloyd rounds with norm-of-sum bounds.

Components become integers, vectors are cut into ``PARTS`` parts, and each part has a codebook. Rounds
assign every part to its nearest entry and move entries to the floor of their parts' mean. All
arithmetic that decides is exact.

Each part of a vector keeps, per group of entries, a lower bound of the distance to the group's entries
other than its own, and the round in which it was taken. The history of all codebooks is sent along
(their number and size are fixed), so a bound of round s is lowered in round r by the true net
displacement |c(r) - c(s)|, the norm of the summed moves, which is never more than the summed norms. A
group whose lowered bound lies above the distance to the own entry is skipped; all others are rescanned
exactly and get a new bound and stamp.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir
from .common import short_list

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
GROUPS = 8  # of entries, each with one bound
MOST = 1 << 24  # scaled components beyond it count as it, which keeps every sum of squares in a long
SLACK = 1e-6  # for the roundings of roots and of bounds kept in 32 bits


def integer_vectors(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id, label, v``: floors of the scaled components; vectors that are null or hold null or
    non-finite components are left out."""
    real = "embedding is not null and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('inf'))"
    scaled = F.transform("embedding", lambda x: F.floor(F.greatest(F.least(x.cast("double") * scale, F.lit(float(MOST))), F.lit(-float(MOST)))))
    return rows.select("vec_id", "label", "embedding").filter(real).select(
        F.col("vec_id").cast("long"), F.col("label").cast("string").alias("label"), scaled.alias("v"))


def _padded(lists: pa.Array, width: int) -> np.ndarray:
    """A matrix of the lists, short ones filled with zeros."""
    lengths = np.diff(lists.offsets.to_numpy())
    values = lists.flatten().to_numpy().astype(np.int64)
    if (lengths == width).all():
        return values.reshape(len(lists), width)
    out = np.zeros((len(lists), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = values
    return out


def _as_rows(column: pa.Array, kind: str, width: int) -> np.ndarray:
    """Rows of a binary column of equal lengths."""
    if not width:
        return np.zeros((len(column), 0), kind)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int32)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[ends[0]:ends[-1]].view(kind).reshape(len(column), width)


def _as_binary(rows: np.ndarray) -> pa.Array:
    size = rows.itemsize * rows.shape[1]
    ends = np.arange(len(rows) + 1, dtype=np.int32) * np.int32(size)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(rows).tobytes())])


# ---- codebooks


class Codebooks:
    """All rounds' entries (round, part, entry, component) and the fixed groups of each part's entries."""

    def __init__(self, first: np.ndarray) -> None:
        self.rounds = [first]
        self.groups = [_grouped(entries) for entries in first]

    def moved(self, part: int) -> np.ndarray:
        """Per group and round s: the farthest net way of an entry of the group from round s to the last."""
        now = self.rounds[-1][part]
        ways = [np.sqrt(((now - past[part]).astype(np.float64) ** 2).sum(axis=1)) for past in self.rounds]
        return np.array([[way[g].max() for way in ways] for g in self.groups[part]]) * (1 + SLACK)

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.rounds[-1].ravel().tolist())).encode()).hexdigest()


def _grouped(entries: np.ndarray) -> list[np.ndarray]:
    """Entries by their nearest of a few that lie far apart; any grouping gives the same codes."""
    x = entries.astype(np.float64)
    seeds, far = [0], ((x - x[0]) ** 2).sum(axis=1)
    while len(seeds) < min(GROUPS, len(x)):
        seeds.append(int(far.argmax()))
        far = np.minimum(far, ((x - x[seeds[-1]]) ** 2).sum(axis=1))
    nearest = ((x[:, None] - x[seeds]) ** 2).sum(axis=2).argmin(axis=1)
    return [g for g in (np.flatnonzero(nearest == k) for k in range(len(seeds))) if len(g)]


def _squares(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    return (x * x).sum(axis=1)[:, None] - 2 * (x @ entries.T) + (entries * entries).sum(axis=1)


def assign(x: np.ndarray, books: Codebooks, part: int, code: np.ndarray | None, low: np.ndarray, stamp: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest entries (ties to the lower index), exact squared distances, and the number of rescans of a
    group. ``low`` and ``stamp`` (row, group) are brought up to date in place; without ``code`` all is scanned."""
    now, entries, n = len(books.rounds) - 1, books.rounds[-1][part], len(x)
    rows = np.arange(n)
    if code is None:
        best, index = np.full(n, np.iinfo(np.int64).max), np.full(n, ENTRIES)
        lowered = np.full(low.shape, -1.0)
    else:
        own = x - entries[code]
        best, index = (own * own).sum(axis=1).astype(np.int64), code.astype(np.int64)
        ways = books.moved(part)
        lowered = low.astype(np.float64) - ways[np.arange(low.shape[1]), stamp]
    before, reach = best.copy(), np.sqrt(best.astype(np.float64)) * (1 + SLACK)
    scanned = []
    for k, group in enumerate(books.groups[part]):
        at = rows if code is None else np.flatnonzero(lowered[:, k] <= reach)
        if not len(at):
            continue
        d = _squares(x[at], entries[group]).astype(np.int64)
        first = d.argmin(axis=1)  # groups list their entries in order, so the lowest index of a tie
        least = d[np.arange(len(at)), first]
        d[np.arange(len(at)), first] = np.iinfo(np.int64).max
        second = d.min(axis=1)
        found = group[first]
        better = (least < best[at]) | ((least == best[at]) & (found < index[at]))
        best[at[better]], index[at[better]] = least[better], found[better]
        scanned.append((k, at, found, least, second))
    if code is not None:  # the entry that is left counts in its group from now on
        left = np.flatnonzero(index != code)
        group_of = np.zeros(len(entries), np.int64)
        for k, group in enumerate(books.groups[part]):
            group_of[group] = k
        k = group_of[code[left]]
        low[left, k] = np.minimum(lowered[left, k], np.sqrt(before[left].astype(np.float64)) * (1 - SLACK))
        stamp[left, k] = now
    for k, at, found, least, second in scanned:
        other = np.where(found == index[at], second, least).astype(np.float64)
        low[at, k] = np.sqrt(other) * (1 - SLACK)
        stamp[at, k] = now
    return index.astype(np.uint8), best, sum(len(at) for _, at, *_ in scanned)


# ---- rounds


STATE = "vec_id long, label string, parts binary, codes binary, low binary, stamp binary, error long, scans long"
NAMES = [c.split()[0] for c in STATE.split(", ")]


def _rounds(batches: Iterator[pa.RecordBatch], books: Codebooks, kind: str) -> Iterator[pa.RecordBatch]:
    """One round over rows of vectors (``v``) or of an earlier round's state."""
    parts, width, groups = PARTS, books.rounds[0].shape[2], max(len(g) for g in books.groups)
    top = max(int(np.abs(books.rounds[-1]).max(initial=0)), 1)
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        begun = "v" not in batch.schema.names
        whole = _as_rows(batch.column("parts"), kind, parts * width) if begun else _padded(batch.column("v"), parts * width)
        exact = 4 * max(top, int(np.abs(whole.astype(np.int64)).max(initial=0))) ** 2 * max(width, 1) < 1 << 53
        codes = np.array(_as_rows(batch.column("codes"), "u1", parts)) if begun else np.zeros((n, parts), np.uint8)
        low = np.array(_as_rows(batch.column("low"), "f4", parts * groups)) if begun else np.zeros((n, parts * groups), np.float32)
        stamp = np.array(_as_rows(batch.column("stamp"), "u1", parts * groups)) if begun else np.zeros((n, parts * groups), np.uint8)
        error, scans = np.zeros(n, np.int64), 0
        for p in range(parts):
            x = whole[:, p * width:(p + 1) * width].astype(np.float64 if exact else np.int64)
            lows, stamps = low[:, p * groups:(p + 1) * groups], stamp[:, p * groups:(p + 1) * groups]
            some = len(books.groups[p])
            codes[:, p], squares, count = assign(x, books, p, codes[:, p].copy() if begun else None, lows[:, :some], stamps[:, :some])
            error += squares
            scans += count
        told = np.zeros(n, np.int64)
        told[0] = scans
        yield pa.RecordBatch.from_arrays([
            batch.column("vec_id"), batch.column("label"), _as_binary(whole.astype(kind)), _as_binary(codes), _as_binary(low), _as_binary(stamp),
            pa.array(error), pa.array(told)], NAMES)


def _sums(batches: Iterator[pa.RecordBatch], entries: int, width: int, kind: str) -> Iterator[pa.RecordBatch]:
    """Per part and entry: the number of parts assigned and the sums of their components, over a whole task."""
    count, total = np.zeros((PARTS, entries), np.int64), np.zeros((PARTS, entries, width), np.int64)
    for batch in batches:
        whole, codes = _as_rows(batch.column("parts"), kind, PARTS * width), _as_rows(batch.column("codes"), "u1", PARTS)
        for p in range(PARTS):
            count[p] += np.bincount(codes[:, p], minlength=entries)
            for c in range(width):  # weights are summed in 53 bits, which a batch's rows cannot exceed
                total[p, :, c] += np.bincount(codes[:, p], weights=whole[:, p * width + c], minlength=entries).astype(np.int64)
    part, entry = np.nonzero(count)
    yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(count[part, entry]),
                                      pa.array(list(total[part, entry]), pa.list_(pa.int64()))], ["part", "entry", "n", "s"])


def _moved(state: DataFrame, books: Codebooks, kind: str) -> np.ndarray:
    """The next codebooks; unused entries stay."""
    last = books.rounds[-1]
    _, entries, width = last.shape
    sums = state.select("parts", "codes").mapInArrow(lambda it: _sums(it, entries, width, kind), "part int, entry int, n long, s array<long>")
    sums = sums.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.col("s")[i]).alias(f"s{i}") for i in range(width)])
    out = last.copy()
    for row in sums.collect():  # one row per entry: PARTS x ENTRIES at most
        out[row["part"], row["entry"]] = [row[f"s{i}"] // row["n"] for i in range(width)]
    return out


def _written(df: DataFrame) -> tuple[DataFrame, str]:
    path = shared_dir(df.sparkSession, "codes")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def _freed(spark: SparkSession, path: str, like: DataFrame) -> None:
    """Empties a written table that nothing reads any more."""
    spark.createDataFrame([], like.schema).write.mode("overwrite").parquet(path)


def compress(rows: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks]:
    """``vec_id, label, codes, error, scans`` per kept vector, and the codebooks of all rounds.

    ``codes`` has one byte per part; ``error`` is the squared distance summed over parts; ``scans`` sums
    to the rescans of the last round (all would be rows x parts x groups).

    Codebooks start as the ``ENTRIES`` smallest ids' vectors (ids ascending, null ids last, ties by the
    vector). Vectors are padded with zeros to four equal parts of the longest; scaled components beyond
    ``MOST`` count as ``MOST``. Repeated rows are coded alike, and each counts in the means. An empty table
    gives no rows and codebooks without entries.
    """
    spark = rows.sparkSession
    vectors = integer_vectors(rows)
    size = vectors.agg(F.max(F.size("v")), F.max(F.greatest(F.array_max("v"), -F.array_min("v")))).first()
    width = -(-(size[0] or 0) // PARTS)
    kind = "i2" if (size[1] or 0) < 1 << 15 else "i4"
    chosen = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(ENTRIES).select("v").collect()
    first = np.zeros((PARTS, len(chosen), width), np.int64)
    for e, row in enumerate(chosen):
        first[:, e] = np.pad(np.array(row["v"], np.int64), (0, PARTS * width - len(row["v"]))).reshape(PARTS, width)
    books = Codebooks(first) if len(chosen) else None
    if books is None:
        return spark.createDataFrame([], STATE).select("vec_id", "label", "codes", "error", "scans"), None
    state, old = vectors, None
    for r in range(rounds + 1):
        sent = spark.sparkContext.broadcast(books)  # (rounds + 1) x PARTS x ENTRIES short rows
        done, path = _written(state.mapInArrow(lambda it, sent=sent: _rounds(it, sent.value, kind), STATE))
        sent.unpersist()
        if old:
            _freed(spark, old, done)
        state, old = done, path
        if r < rounds:
            books.rounds.append(_moved(state, books, kind))
    return state.select("vec_id", "label", "codes", "error", "scans"), books


def op11(rows: DataFrame) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256``; see ``compress``."""
    coded, books = compress(rows)
    most = F.lit((1 << 63) - 1).cast("decimal(38,0)")
    sums = coded.groupBy("label").agg(F.least(F.sum(F.col("error").cast("decimal(19,0)")), most).cast("long").alias("label_error"))
    sums = short_list(_written(sums.withColumnRenamed("label", "of_label"))[0])
    digest = books.digest() if books else hashlib.sha256(b"").hexdigest()
    return coded.join(sums, coded["label"].eqNullSafe(sums["of_label"])).select(
        "vec_id", F.lower(F.hex("codes")).alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def _sql() -> str:
    """The rounds written out as queries over exact doubles."""
    def near(r: int) -> str:
        return f"""a{r} AS MATERIALIZED (
  SELECT rn, p, min(struct_pack(d := CAST(list_dot_product(x, x) - 2 * list_dot_product(x, c) + list_dot_product(c, c) AS BIGINT), e := e)) AS b
  FROM parts JOIN c{r} USING (p) GROUP BY rn, p)"""

    def move(r: int) -> str:
        return f"""c{r + 1} AS MATERIALIZED (
  SELECT c.p, c.e, coalesce(m.c, c.c) AS c FROM c{r} c LEFT JOIN (
    SELECT p, e, list(v ORDER BY i) AS c FROM (
      SELECT p, e, i, floor(sum(v) / count(*)) AS v FROM (
        SELECT p, a.b.e AS e, unnest(x) AS v, unnest(range(len(x))) AS i FROM a{r} a JOIN parts USING (rn, p)) GROUP BY p, e, i)
    GROUP BY p, e) m ON m.p = c.p AND m.e = c.e)"""

    steps = [step for r in range(ROUNDS) for step in (near(r), move(r))] + [near(ROUNDS)]
    return f"""
WITH v AS (
  SELECT vec_id, label, [floor({SCALE} * CAST(x AS DOUBLE)) FOR x IN embedding] AS v, row_number() OVER (ORDER BY vec_id) AS rn FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
parts AS MATERIALIZED (SELECT rn, p, v[p * len(v) // {PARTS} + 1:(p + 1) * len(v) // {PARTS}] AS x FROM v, range({PARTS}) t(p)),
c0 AS MATERIALIZED (SELECT p, rn - 1 AS e, x AS c FROM parts WHERE rn <= {ENTRIES}),
{", ".join(steps)},
coded AS (
  SELECT rn, lower(string_agg(printf('%02x', b.e), '' ORDER BY p)) AS code, CAST(sum(b.d) AS BIGINT) AS error FROM a{ROUNDS} GROUP BY rn),
books AS (
  SELECT sha256(string_agg(CAST(CAST(x AS BIGINT) AS VARCHAR), ',' ORDER BY p, e, i)) AS h
  FROM (SELECT p, e, unnest(c) AS x, unnest(range(len(c))) AS i FROM c{ROUNDS}))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
FROM v JOIN coded USING (rn), books"""


OP11_SQL = _sql()
