"""Near duplicates: universal hash minima, banding, verification, connected components.

Documents with equal shingle sets are one class and are handled once. A class's signature is the
minimum of each of many universal hash functions over its shingles; bands of the signature that
agree bring classes together in a bucket. In a bucket a maximum spanning forest of the estimated
similarities is enough to connect what belongs together, so its pairs are tried first, on full
sets. Classes that may still have a link into another component then meet in their buckets once
more, with their texts, and every such pair is tried there until its ends are connected. So no link
that could join two components stays untried, and no bucket ever gives more rows than it has classes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import write_out
from .common import released, released_group, short_list, with_running
from .components import components
from .hashing import mix, shingles, word_hashes

WORDS, PERCENT = 5, 80
HASHES, ROWS = 128, 4  # 32 bands of 4: a pair at 0.8 shares none once in 2 * 10^7
SLACK = 0.2  # estimates this far below the limit are dropped: 5.6 standard deviations
BLOCK = 2048  # classes of a bucket compared in one task
FEW = 8  # of buckets up to this size with the same classes, one is enough

_A, _B = (np.random.Generator(np.random.PCG64(5)).integers(0, 1 << 63, (2, HASHES), dtype=np.uint64) << np.uint64(1)) + np.array([[1], [0]], np.uint64)


def signature(hashes: np.ndarray) -> np.ndarray:
    """Minima of the functions ``(a x + b) >> 32`` modulo 2^64, ``a`` odd."""
    low = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 256):
        np.minimum(low, ((hashes[at:at + 256, None] * _A + _B) >> np.uint64(32)).min(axis=0), out=low)
    return low.astype(np.uint32)


def sets_of(texts: list[str | None], words: int) -> list[np.ndarray]:
    return [shingles(h, words) for h in word_hashes([(t or "").encode().lower() for t in texts])]


SIGNED = "doc_id long, n long, k1 long, k2 long, sig binary"


def signed(docs: DataFrame, words: int) -> DataFrame:
    """Set size, two digests of the set, and the signature, per document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                sets = sets_of(part.column("text").to_pylist(), words)
                digest = [(int(s.sum(dtype=np.uint64)), int(mix(s ^ np.uint64(77)).sum(dtype=np.uint64))) for s in sets]
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                    *[pa.array(np.array([d[k] for d in digest], np.uint64).view(np.int64)) for k in (0, 1)],
                    pa.array([signature(s).tobytes() if len(s) else b"" for s in sets], pa.binary())], ["doc_id", "n", "k1", "k2", "sig"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(released(run), SIGNED)


def _keys(sig: np.ndarray) -> np.ndarray:
    """A key for each band of each signature."""
    bands = sig.reshape(-1, HASHES // ROWS, ROWS).astype(np.uint64)
    salts = (np.arange(HASHES // ROWS, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    key = np.broadcast_to(salts, bands.shape[:2]).copy()
    for k in range(ROWS):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + bands[:, :, k])
    return key


def banded(classes: DataFrame) -> DataFrame:
    """``key, id, band``: one row per class and band."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 2000):
                part = batch.slice(lo, 2000)
                key = _keys(np.frombuffer(b"".join(part.column("sig").to_pylist()), np.uint32))
                ids = np.repeat(part.column("id").to_numpy(zero_copy_only=False), key.shape[1])
                band = np.tile(np.arange(key.shape[1], dtype=np.int32), len(key))
                yield pa.RecordBatch.from_arrays([pa.array(key.ravel().view(np.int64)), pa.array(ids), pa.array(band)], ["key", "id", "band"])

    return classes.select("id", "sig").mapInArrow(released(run), "key long, id long, band int")


def buckets(bands: DataFrame) -> DataFrame:
    """Keys of two or more classes with their numbers and bands. Of small buckets with the same classes one
    is kept, as band 0; a pair of a large bucket belongs to the first band that it shares."""
    found = bands.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("band").alias("band"), F.min("id").alias("low"), F.max("id").alias("high"),
                                     F.sum(F.xxhash64("id").cast("decimal(38,0)")).alias("all")).filter("n > 1")
    large = F.col("n") > FEW
    alike = [F.when(~large, F.col(c)).alias(c) for c in ("low", "high", "all")]
    return found.groupBy("n", *alike, F.when(large, F.col("key")).alias("own")).agg(F.min("key").alias("key"), F.min("band").alias("band")).select(
        "key", "n", F.when(large, F.col("band")).otherwise(0).alias("band"))


def members(classes: DataFrame, keys: DataFrame, block: int = BLOCK) -> DataFrame:
    """``key, task, band, id, sig``: the classes of each bucket, by task. A bucket above ``block`` is dealt
    into parts and every two parts meet in a task of their own."""
    parts = F.ceil(F.col("n") / block).cast("int")
    rows = banded(classes).drop("band").join(keys, "key").withColumn("parts", parts)
    rows = rows.withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    meet = F.when(F.col("parts") == 1, F.array(F.lit(0))).otherwise(F.transform(
        F.array_remove(F.sequence(F.lit(0), F.col("parts") - 1), F.col("part")),
        lambda other: F.least(other, F.col("part")) * F.col("parts") + F.greatest(other, F.col("part"))))
    dealt = rows.select("key", "band", "id", F.explode(meet).alias("task"))
    return dealt.join(classes.select("id", "sig"), "id")


def _signatures(part: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(part["sig"].to_pylist()), np.uint32).reshape(part.num_rows, HASHES)


def forest(sig: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Links of a maximum spanning forest over pairs with ``least`` or more equal minima (Prim's way)."""
    n = len(sig)
    best, source = np.full(n, -1, np.int64), np.zeros(n, np.int64)
    out, at = [], 0
    best[0] = HASHES + 1
    done = np.zeros(n, bool)
    for _ in range(n):
        at = int(np.where(done, -2, best).argmax())
        if 0 <= best[at] <= HASHES and best[at] >= least:
            out.append((int(source[at]), at))
        done[at] = True
        equal = (sig == sig[at]).sum(axis=1)
        nearer = ~done & (equal > best)
        best[nearer], source[nearer] = equal[nearer], at
    return out


def apart(sig: np.ndarray, label: np.ndarray, band: int, least: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each class the later ones under another label (as it is by then) with ``least`` or more equal
    minima, but for those that share a band before this one."""
    keys = _keys(sig)[:, :band]
    for i in range(len(sig) - 1):
        other = np.flatnonzero(label[i + 1:] != label[i]) + i + 1
        if len(other):
            other = other[(sig[other] == sig[i]).sum(axis=1) >= least]
            if band and len(other):
                other = other[~(keys[other] == keys[i]).any(axis=1)]
            if len(other):
                yield i, other


def spanning(rows: DataFrame, percent: int) -> DataFrame:
    """``a, b``: the pairs of a spanning forest of each task's classes."""
    least = int((percent / 100 - SLACK) * HASHES)

    def run(part: pa.Table) -> pa.Table:
        part = part.take(pc.sort_indices(part, [("id", "ascending")]))
        ids = part["id"].to_numpy()
        found = np.array(forest(_signatures(part), least), np.int64).reshape(-1, 2)
        a, b = ids[found[:, 0]], ids[found[:, 1]]
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return rows.groupBy("key", "task").applyInArrow(released_group(run), "a long, b long").distinct()


def undecided(rows: DataFrame, percent: int) -> DataFrame:
    """The rows of classes that may have a link into another component, by ``label``."""
    least = int((percent / 100 - SLACK) * HASHES)

    def run(part: pa.Table) -> pa.Table:
        label, open_ = part["label"].to_numpy(), np.zeros(part.num_rows, bool)
        if (label != label[0]).any():
            part = part.take(pc.sort_indices(part, [("id", "ascending")]))
            for i, other in apart(_signatures(part), part["label"].to_numpy(), part["band"][0].as_py(), least):
                open_[i] = True
                open_[other] = True
        return part.filter(pa.array(open_))

    return rows.groupBy("key", "task").applyInArrow(released_group(run), rows.schema)


def settled(rows: DataFrame, words: int, percent: int) -> DataFrame:
    """``a, b``: confirmed links between components. Rows have their ``text``; a pair is tried on its full sets unless links of its
    task connect it already."""
    least = int((percent / 100 - SLACK) * HASHES)

    def run(part: pa.Table) -> pa.Table:
        part = part.take(pc.sort_indices(part, [("id", "ascending")]))
        ids, label = part["id"].to_numpy(), part["label"].to_numpy().copy()
        sets, links = sets_of(part["text"].to_pylist(), words), []
        for i, other in apart(_signatures(part), label, part["band"][0].as_py(), least):
            for j in other.tolist():
                if label[j] != label[i] and _linked(sets[i], sets[j], percent):
                    links.append((ids[i], ids[j]))
                    label[label == label[j]] = label[i]
        links = np.array(links, np.int64).reshape(-1, 2)
        return pa.table({"a": links[:, 0], "b": links[:, 1]})

    return rows.groupBy("key", "task").applyInArrow(released_group(run), "a long, b long").distinct()


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def confirmed(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs whose full shingle sets share ``percent`` of their union. ``texts`` has one row per ``id``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 200):
                part = batch.slice(lo, 200)
                ids = part.column("a").to_pylist(), part.column("b").to_pylist()
                text = dict(zip(ids[0], part.column("text_a").to_pylist())) | dict(zip(ids[1], part.column("text_b").to_pylist()))
                sets = dict(zip(text, sets_of(list(text.values()), words)))
                keep = [_linked(sets[a], sets[b], percent) for a, b in zip(*ids)]
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
    met = left.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
    return met.select("a", "b", "text_a", "text_b").mapInArrow(released(run), "a long, b long")


def _by_text(docs: DataFrame, words: int, percent: int, block: int) -> DataFrame:
    """``near_duplicates`` where an id stands for several sets: the texts of an id are linked under numbers of
    their own, then ids join what their texts reach."""
    digest = F.coalesce(F.sha2("text", 256), F.lit(""))
    keyed = docs.select(F.col("doc_id").cast("long"), "text", digest.alias("digest"))
    texts = keyed.filter("doc_id is not null").select("doc_id", "digest").distinct()
    numbers = write_out(with_running(texts, [], ["doc_id", "digest"], None, "row"), "text-numbers")
    numbered = keyed.join(numbers, ["doc_id", "digest"], "left").select(F.col("row").alias("doc_id"), "text")
    judged = write_out(near_duplicates(numbered, words, percent, block), "near-texts")
    reached = write_out(judged.filter("doc_id is not null").select(F.col("doc_id").alias("row"), "n_shingles", "component_id").join(
        numbers.select("doc_id", "row"), "row"), "texts-reached")  # copies of a text are several rows
    firsts = reached.groupBy("doc_id").agg(F.min("component_id").alias("u"), F.max("component_id").alias("v")).filter("u <> v").drop("v")
    ends = reached.select("doc_id", "component_id").distinct().join(short_list(write_out(firsts, "first-components")), "doc_id")
    joined = write_out(components(ends.filter("u <> component_id").select("u", F.col("component_id").alias("v"))), "components")
    reached = reached.join(joined, reached["component_id"] == joined["node"], "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "component_id").alias("component"))
    smallest = reached.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    out = reached.join(smallest, "component").select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))
    return out.unionByName(judged.filter("doc_id is null"))


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``doc_id, text``.

    Documents are linked when their shingle sets share ``percent`` of their union; ``component_id`` is the
    smallest id that links reach and ``kept`` tells whether it is the document's own. Texts without
    words (null, empty, blank) link to nothing; rows that repeat an id count as one document, linked by each
    of its texts; rows without an id have no component and are kept; an empty table gives no rows.
    """
    signs = write_out(signed(docs, words), "signatures")
    sets_of_id = F.struct("k1", "k2", "n")
    torn = signs.filter("doc_id is not null").groupBy("doc_id").agg(F.min(sets_of_id).alias("least"), F.max(sets_of_id).alias("most"))
    if not torn.filter("least <> most").isEmpty():
        return _by_text(docs, words, percent, block)
    linked = signs.filter("doc_id is not null and n > 0")
    classes = write_out(linked.groupBy("k1", "k2", "n").agg(F.min("doc_id").alias("id"), F.first("sig").alias("sig")), "classes")
    sets = classes.drop("sig")
    keys = write_out(buckets(banded(classes)), "buckets")
    rows = write_out(members(classes, keys, block), "members")
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text")

    def texts_of(ids: DataFrame) -> DataFrame:
        wanted = short_list(write_out(ids.distinct(), "wanted"))
        return texts.join(wanted, "id", "left_semi").dropDuplicates(["id"])

    def linked_up(links: DataFrame) -> DataFrame:
        return write_out(components(links.select(F.col("a").alias("u"), F.col("b").alias("v"))), "components")

    pairs = write_out(spanning(rows, percent), "pairs")
    ends = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id")))
    good = write_out(confirmed(pairs, texts_of(ends), words, percent), "confirmed")
    found = linked_up(good)
    labelled = rows.join(found, rows["id"] == found["node"], "left").select(rows["*"], F.coalesce("component", "id").alias("label"))
    open_rows = write_out(undecided(labelled, percent), "undecided")
    more = write_out(settled(open_rows.join(texts_of(open_rows.select("id")), "id"), words, percent), "confirmed")
    if not more.isEmpty():
        found = linked_up(good.unionByName(more))
    named = sets.join(found, sets["id"] == found["node"], "left").select("k1", "k2", "n", F.coalesce("component", "id").alias("component_id"))
    out = signs.select("doc_id", "n", "k1", "k2").join(named, ["k1", "k2", "n"], "left")
    component = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def deduplicated(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of the kept documents, with all their columns; of rows that repeat an id, one."""
    judged = write_out(near_duplicates(docs.select("doc_id", "text"), words, percent), "near-duplicates")
    kept = docs.join(judged.filter("not kept").select("doc_id"), "doc_id", "left_anti").select(*docs.columns)
    again = judged.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1")
    if again.isEmpty():
        return kept
    again = again.select("doc_id")
    return kept.join(again, "doc_id", "left_anti").unionByName(kept.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id"]))


def op1(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs.select("doc_id", "text"), words=4, percent=80)
