"""Benchmark decontamination: one Aho-Corasick automaton over the normalised test items.

Items and texts are normalised alike: A-Z to lower case, words of digits, letters a-z and everything
beyond ASCII. Every window of ``WINDOW`` consecutive words of an item (the whole item, if it has fewer)
is a pattern. A word is spelled by two symbols of separate alphabets, so a pattern only matches on word
borders and no state has many ways out. Texts run through the automaton once, in parts that keep its
state, and the words inside matches are mapped to places in the original text.

The automaton is bounded by ``MOST_WORDS`` item words. Larger benchmarks are split into several, and
texts are scanned once for each; nothing is left out.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator
from math import isqrt

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import write_out
from .common import groups_for, short_list

WINDOW = 10
SEGMENT = 1000  # windows of a long item that are dealt together
MOST_WORDS = 150_000  # item words in one automaton: about 1 KB each
PART = 1 << 22  # bytes of a text that are scanned at a time
#: ASCII other than digits and letters separates words; bytes beyond ASCII belong to words.
PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
MISS = "\x00\x00"
SETS = 100_000  # sets of items that are sent to all tasks, with two digests each


# ---- items


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bodies = [b" ".join(t.translate(PLAIN).split()) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("item_id"), pa.array(bodies, pa.binary())], ["item_id", "body"])


def normalised(items: DataFrame) -> DataFrame:
    """``item_id, body``: words of each item, one space between them. Items without words are left out."""
    rows = items.filter("text is not null").select(F.col("item_id").cast("string"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(_item_words, "item_id string, body binary").filter("length(body) > 0")


def _segments(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[bytes, bytes, int]] = []
            for cls, body in zip(batch.column("class").to_pylist(), batch.column("body").to_pylist()):
                words = body.split()
                for at in range(0, max(len(words) - window + 1, 1), SEGMENT):
                    part = words[at:at + SEGMENT + window - 1]
                    out.append((cls, b" ".join(part), len(part)))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.binary(), pa.binary(), pa.int64()))] if out else
                                             [pa.array([], t) for t in (pa.binary(), pa.binary(), pa.int64())], ["class", "body", "n"])
    return run


# ---- the automaton


class Patterns:
    """The automaton of a list of (class, segment), with the length and the classes of each window."""

    def __init__(self, segments: list[tuple[bytes, bytes]], window: int) -> None:
        counts = Counter(w for _, body in segments for w in body.split())
        base = isqrt(max(len(counts) - 1, 0)) + 1
        self.code = {w: chr(1 + i // base) + chr(1 + base + i % base) for i, (w, _) in enumerate(counts.most_common())}
        found: dict[str, int] = {}
        self.lengths: list[int] = []
        self.owners: list[list[bytes]] = []
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for cls, body in segments:
            spelled = [self.code[w] for w in body.split()]
            n = min(window, len(spelled))
            text = "".join(spelled)
            for k in range(len(spelled) - n + 1):
                pattern = text[2 * k:2 * (k + n)]
                at = found.setdefault(pattern, len(found))
                if at == len(self.lengths):
                    self.lengths.append(n)
                    self.owners.append([])
                    self.automaton.add_word(pattern, at)
                if not self.owners[at] or self.owners[at][-1] != cls:
                    self.owners[at].append(cls)
        if found:
            self.automaton.make_automaton()

    def scan(self, text: bytes) -> tuple[int, list[tuple[int, int]], set[bytes]]:
        """Number of words of a normalised text, its maximal runs of hit words and the classes that occur."""
        n, runs, windows, search = 0, [], set(), None
        for part in _parts(text):
            words = part.split()
            n += len(words)
            if not self.lengths:
                continue
            get = self.code.get
            spelled = "".join([get(w, MISS) for w in words])
            if search is None:
                search = self.automaton.iter(spelled)
            else:
                search.set(spelled)  # state and places go on from the last part
            for end, at in search:
                windows.add(at)
                last = (end + 1) // 2
                first = last - self.lengths[at]
                while runs and runs[-1][1] >= first:
                    first = min(first, runs.pop()[0])
                runs.append((first, last))
        return n, runs, {c for at in windows for c in self.owners[at]}


def _parts(text: bytes) -> Iterator[bytes]:
    at = 0
    while len(text) - at > 2 * PART:
        cut = text.find(b" ", at + PART)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut
    yield text[at:] if at else text


def places(raw: bytes, text: bytes, runs: list[tuple[int, int]]) -> list[dict[str, int]]:
    """The runs with their character offsets in the original text."""
    if not runs:
        return []
    space = np.frombuffer(text, np.uint8) == 32
    before = np.concatenate([[True], space[:-1]])
    begin, end = np.flatnonzero(~space & before), np.flatnonzero(space & ~before)
    if len(end) < len(begin):
        end = np.append(end, len(text))
    lead = np.frombuffer(raw, np.uint8) & 0xC0
    out, at, chars = [], 0, 0
    for first, last in runs:
        low, high = int(begin[first]), int(end[last - 1])
        chars += int(np.count_nonzero(lead[at:low] != 0x80))
        inside = int(np.count_nonzero(lead[low:high] != 0x80))
        out.append({"first": first, "words": last - first, "start": chars, "end": chars + inside})
        at, chars = high, chars + inside
    return out


_BUILT: dict[str, Patterns] = {}  # at most one: the automaton that the worker scans with


def _built(key: str, segments: list[tuple[bytes, bytes]], window: int) -> Patterns:
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = Patterns(segments, window)
    return _BUILT[key]


SPANS = "array<struct<first:long,words:long,start:long,end:long>>"
FOUND = f"doc_id long, mark string, n_words long, spans {SPANS}, classes array<binary>"
ROWS = pa.list_(pa.struct([(n, pa.int64()) for n in ("first", "words", "start", "end")]))


def _scanned(docs: DataFrame, segments: list[tuple[bytes, bytes]], window: int, only_hits: bool) -> DataFrame:
    sent, key = docs.sparkSession.sparkContext.broadcast(segments), uuid.uuid4().hex  # bounded by MOST_WORDS words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = _built(key, sent.value, window)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                rows = []
                for doc, mark, raw in zip(part.column("doc_id").to_pylist(), part.column("mark").to_pylist(), part.column("text").to_pylist()):
                    text = (raw or b"").translate(PLAIN)
                    n, runs, classes = patterns.scan(text)
                    if runs or not only_hits:
                        rows.append((doc, mark, n, places(raw or b"", text, runs), sorted(classes)))
                cols = list(zip(*rows)) or [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (
                    pa.int64(), pa.string(), pa.int64(), ROWS, pa.list_(pa.binary())))], ["doc_id", "mark", "n_words", "spans", "classes"])

    return docs.mapInArrow(run, FOUND)


def _united(spans: list) -> list[dict]:
    """Maximal runs of the union of several lists of runs of one text."""
    out: list[dict] = []
    for s in sorted((s.asDict() for x in spans for s in x), key=lambda s: s["first"]):
        last = out[-1] if out else None
        if last and s["first"] <= last["first"] + last["words"]:
            last["words"] = max(last["words"], s["first"] + s["words"] - last["first"])
            last["end"] = max(last["end"], s["end"])
        else:
            out.append(s)
    return out


def find(docs: DataFrame, items: DataFrame, window: int = WINDOW, most_words: int = MOST_WORDS) -> tuple[DataFrame, DataFrame]:
    """Two tables: per document ``doc_id, n_words, spans, classes``, and ``class, item_id`` of the items.

    ``spans`` are the maximal runs of words inside occurrences of windows: first word, number of words,
    and start and end character of the original text. Items of equal words are one class.

    Null and empty texts have no words and no hits; null or wordless items have no windows; an item
    without an id marks words but is never counted; repeated rows are judged alike; an empty benchmark
    hits nothing; other columns are left out.
    """
    spark = docs.sparkSession
    bodies = write_out(normalised(items).withColumn("class", F.unhex(F.sha2("body", 256))), "items")
    members = bodies.select("class", "item_id").filter("item_id is not null").distinct()
    one = bodies.groupBy("class").agg(F.first("body").alias("body"))
    segments = write_out(one.mapInArrow(_segments(window), "class binary, body binary, n long"), "segments")
    total = segments.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    shards = groups_for(total, int(0.8 * most_words) or 1, 1)
    texts = docs.select(F.col("doc_id").cast("long"), (F.lit("") if shards == 1 else F.concat_ws(
        ":", F.xxhash64("text"), F.crc32(F.col("text").cast("binary")), F.length("text"))).alias("mark"), F.col("text").cast("binary").alias("text"))

    def of(shard: int) -> list[tuple[bytes, bytes]]:
        part = segments.filter(F.pmod(F.xxhash64("class", "body"), F.lit(shards)) == shard)
        return sorted((bytes(r["class"]), bytes(r["body"])) for r in part.select("class", "body").collect())

    found = write_out(_scanned(texts, of(0), window, False), "scanned")
    if shards > 1:
        more = found.filter("size(spans) > 0")
        for k in range(1, shards):
            more = more.unionByName(write_out(_scanned(texts, of(k), window, True), "scanned"))
        # at most one row per shard and text: copies of a text under one id agree
        more = more.groupBy(F.col("doc_id").alias("of_doc"), F.col("mark").alias("of_mark")).agg(
            F.collect_set("spans").alias("lists"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("classes")))).alias("all_classes"))
        more = more.withColumn("all_spans", F.udf(_united, SPANS, useArrow=False)("lists"))
        joined = found.join(more, F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("mark") == F.col("of_mark")), "left")
        found = write_out(joined.select("doc_id", "n_words", F.coalesce("all_spans", "spans").alias("spans"),
                                        F.coalesce("all_classes", "classes").alias("classes")), "scanned")
    return found.select("doc_id", "n_words", "spans", "classes"), members


def report(found: DataFrame, members: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` and ``spans``. The list of items is
    made once for each set of classes that some document holds."""
    key = F.sha2(F.array_join(F.transform("classes", lambda c: F.hex(c)), ","), 256)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["words"])
    found = found.withColumn("held", key).withColumn("n_hit", hit)
    some, none = found.filter("size(classes) > 0"), found.filter("size(classes) = 0")  # most texts hold nothing and meet no one
    sets = some.groupBy("held").agg(F.first("classes").alias("classes"))
    listed = sets.select("held", F.explode("classes").alias("class")).join(members, "class").groupBy("held").agg(
        F.array_sort(F.collect_set("item_id")).alias("ids"))
    listed = listed.select("held", F.size("ids").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "ids"), 256).alias("items_sha256"))
    listed = short_list(write_out(listed, "item-lists"), SETS)
    out = some.join(listed, "held", "left").unionByName(none, allowMissingColumns=True)
    return out.select("doc_id", "n_words", "n_hit", F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
                      F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"), "spans")


def cleaned(docs: DataFrame, items: DataFrame, window: int = WINDOW, most_words: int = MOST_WORDS) -> DataFrame:
    """The documents, with all their columns, in which no window of an item occurs."""
    found, _ = find(docs, items, window, most_words)
    hit = found.filter("size(spans) > 0").select("doc_id").distinct()
    return docs.join(hit, docs["doc_id"].eqNullSafe(hit["doc_id"]), "left_anti")


def op12(docs: DataFrame, items: DataFrame) -> DataFrame:
    return report(*find(docs, items)).drop("spans")


OP12_SQL = r"""
WITH i AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL),
iw AS (
  SELECT DISTINCT item_id, n, win FROM (
    SELECT item_id, least(len(w), 10) AS n, unnest([array_to_string(w[k:k + least(len(w), 10) - 1], ' ') FOR k IN range(1, len(w) - least(len(w), 10) + 2)]) AS win
    FROM i WHERE len(w) > 0)),
d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
spot AS (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n),
hit AS (SELECT a.r, a.k, a.n, iw.item_id FROM (SELECT r, k, n, array_to_string(w[k:k + n - 1], ' ') AS win FROM spot) a JOIN iw ON iw.n = a.n AND iw.win = a.win),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(k, k + n)) AS p FROM hit) GROUP BY r),
items AS (
  SELECT r, count(*) AS n_items, sha256(string_agg(id, ',' ORDER BY id)) AS items_sha256
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM hit WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)"""
