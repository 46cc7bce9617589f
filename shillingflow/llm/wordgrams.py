"""A word model beside the letter model of ``quality``: runs of ``ORDER`` words, one model per language and half.

A gram is a word with the two before it, across all word borders of a text; two start marks precede a
text. Texts are dealt to two halves by their hash, and each is scored by the model of the half that it
is not in: its own counts are left out, and those of its exact copies, which share its half. The counts of
both halves are smoothed side by side (interpolated modified Kneser-Ney, as ``quality.kneser_ney``): every gram
of the corpus gets a probability under both halves, by back-off where a half has not seen it.

All that the model needs of a gram's middle word ``v`` is in the grams around it, so grams are dealt by it: a
bucket knows the counts of its runs of three and of two, and how many words precede each last word. Of the rest, only
discounts (a few numbers a language) and the probabilities of single words come from all buckets. The texts are read
once to count and once to score, for ``TOGETHER`` of ``SLICES`` shares of the buckets at a time, and their shuffle is
dropped at its end, so the disk holds a share of the grams and no model of runs. Texts go to buckets by pieces: a bucket has
one row of a piece, whatever number of its texts has grams there, and gives one row of probabilities back to it, where
they are summed by text. A word with more than ``CROWDED`` grams is dealt to several buckets, and what they count
together is summed by Spark.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import empty_out, shared_dir, write_out
from .common import groups_for, released, released_group, short_list
from .hashing import mix, word_hashes

ORDER = 3
KEYS = ("u", "v", "w")  # hashes of a gram's words
START = 0  # in place of the words before a text
HALVES = (0, 1)
EMITTED = 50_000  # grams in a batch, and of one text in a piece; below 2^16
DEALT = 500_000  # grams that are dealt to buckets at a time
HASHED = 16  # texts that are hashed at a time; more fall out of a core's cache
FEW_SLICES, SLICES = 4, 12  # ``TOGETHER`` of them cost two readings of the texts
SLICE = 10_000_000  # grams of a slice beyond ``FEW_SLICES`` of them; beyond ``SLICES``, slices grow
BUCKET = 500_000  # grams of a bucket
CROWDED = 1_000_000
TOGETHER = 2  # slices that are dealt in one reading of the texts: packed, a word takes half of the room it had
COMMON = 1 << 16  # words that are dealt by number
GRAMS = "m long, d long, part int, u long, v long, w long"
#: ``texts`` names the texts of a piece, in one row; the others hold grams by language (``langs``, and how many grams of each in ``sizes``) and middle word (``v``, ``runs``), with the
#: halves of their text's part (``low``, ``high``; parts from ``edge`` on are of the second half of the texts) and the words before and after: numbers of common words, 0 for the others, which follow.
PACKED = ("bucket int, piece long, texts binary, edge int, langs binary, sizes binary, v binary, runs binary, low binary, high binary, "
          "u binary, u_rare binary, w binary, w_rare binary")
SCORED = "piece long, texts binary, low binary, high binary, p binary"
#: Rows that buckets give and take, with a common word's number for its hash in ``w``: of a word (``w``), of a run of two (``v, w``) or context (``v, w`` for its two words) that several
#: buckets share, or of a language (``w`` is a class of counts). ``TOTAL + k`` counts the grams of a context that come k times, 3 or more for 3.
WORD, PAIR, CLASS2, CLASS3, TOTAL = 0, 1, 2, 3, 4
COUNTED = "kind int, bucket int, m long, v long, w long, n0 long, n1 long"
Piece = tuple[int, int, int, int, np.ndarray]


def keyed(docs: DataFrame, no_lang: str) -> DataFrame:
    """``m, d, text``: hashes of the language and of the text, which name a model and a scored text."""
    text = F.col("text").cast("string")
    return docs.select(F.xxhash64(F.coalesce(F.col("lang").cast("string"), F.lit(no_lang))).alias("m"), F.xxhash64(text).alias("d"), text.alias("text"))


def half(d: np.ndarray) -> np.ndarray:
    return np.mod(d, len(HALVES))


def each(make) -> list[Column]:
    return [c for h in HALVES for c in make(h)]


# ---- grams of texts


def _pieces(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[list[Piece]]:
    """Lists of about ``most`` words of texts: ``m, d``, the first word, the number of the text's words, and the words' hashes, after those of the two words before where there are any."""
    held: list[Piece] = []
    size = 0
    for batch in batches:
        for lo in range(0, batch.num_rows, HASHED):
            some = batch.slice(lo, HASHED)
            hashes = word_hashes([(t or "").lower().encode() for t in some.column("text").to_pylist()])
            for m, d, h in zip(some.column("m").to_pylist(), some.column("d").to_pylist(), hashes):
                for at in range(0, len(h), EMITTED):
                    held.append((m, d, at, len(h), h[max(at - ORDER + 1, 0):at + EMITTED]))
                    size += min(EMITTED, len(h) - at)
                    if size >= most:
                        yield held
                        held, size = [], 0
    if held:
        yield held


class Row:
    """Pieces side by side: ``m, d`` of each, all hashes ``h`` in a row, the piece ``of`` each, and whether it is a gram's ``middle`` word."""

    def __init__(self, held: list[Piece]) -> None:
        marks = np.full(ORDER - 1, START, np.uint64)
        self.m, self.d, self.at, self.words = (np.array(x, np.int64) for x in zip(*[x[:4] for x in held]))
        self.h = np.concatenate([x for p in held for x in ((p[4],) if p[2] else (marks, p[4]))])
        n = np.array([len(p[4]) for p in held]) + np.where(self.at > 0, 0, ORDER - 1)
        self.of, ends = np.repeat(np.arange(len(held)), n), np.cumsum(n)
        self.begins = ends - n
        self.middle = np.ones(len(self.h), bool)
        self.middle[ends - 1] = self.middle[self.begins] = False

    def part(self, places: np.ndarray, parts: int) -> np.ndarray:
        """Which of ``parts`` equal runs of its text's words the grams are in that have their middle words at these places."""
        of = self.of[places]
        word = places - (self.begins - self.at)[of] - 1
        part = np.zeros(len(places), np.int32)
        for k in range(1, parts):
            part += word >= (self.words * k // parts)[of]
        return part


def word_grams(docs: DataFrame, parts: int) -> DataFrame:
    """``m, d, part, u, v, w``: a row for each word of each text of ``keyed``, lower-cased, with the part of the text that it is in."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _pieces(batches, EMITTED):
            row = Row(held)
            at = np.flatnonzero(row.middle)
            words = [row.h[at + k].view(np.int64) for k in (-1, 0, 1)]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, [row.m[row.of[at]], row.d[row.of[at]], row.part(at, parts), *words])), ["m", "d", "part", *KEYS])

    return docs.mapInArrow(released(run), GRAMS)


# ---- buckets


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * np.uint64(0x9E3779B97F4A7C15) + b)


def _short(u: np.ndarray) -> np.ndarray:
    """The 48 bits of a first word that are dealt; they only need to tell apart the words before one word."""
    return u & np.uint64((1 << 48) - 1)


def _middle(m: np.ndarray, v: np.ndarray, of: np.ndarray | None = None) -> np.ndarray:
    """One number for a word of a language; ``of`` names the language of each word, if they are not given side by side."""
    langs = mix(m.view(np.uint64).copy()) * np.uint64(0x9E3779B97F4A7C15)
    return mix((langs if of is None else langs[of]) + v)


def _share(number: np.ndarray, of: int) -> np.ndarray:
    """Which of ``of`` equal ranges of 32 bits a number's upper half is in."""
    return (number >> np.uint64(32)) * np.uint64(of) >> np.uint64(32)


class Common:
    """The most frequent words of all texts, by numbers from 1 on, the mark before a text first."""

    def __init__(self, words: np.ndarray) -> None:
        self.words = np.concatenate([np.full(2, START, np.uint64), words[:COMMON - 2]])
        self.numbers = np.zeros(8 * COMMON, np.uint16)  # a place holds one word; the others that belong there count as rare
        self.numbers[self.place(self.words[:0:-1])] = np.arange(1, len(self.words), dtype=np.uint16)[::-1]

    def place(self, h: np.ndarray) -> np.ndarray:
        return (h >> np.uint64(40)) % np.uint64(len(self.numbers))

    def __call__(self, h: np.ndarray) -> np.ndarray:
        """The words' numbers, 0 for rare ones."""
        number = self.numbers[self.place(h)]
        return np.where(self.words[number] == h, number, 0).astype(np.uint16)

    def key(self, number: np.ndarray, h: np.ndarray) -> np.ndarray:
        """What names a word where buckets exchange counts: its number, or its hash where it has none."""
        return np.where(number > 0, number.astype(np.uint64), h)


class Crowded:
    """Words of languages with more than ``CROWDED`` grams, and the number of buckets that share each; the ``common`` words of all languages."""

    def __init__(self, words: np.ndarray, shares: np.ndarray, common: Common) -> None:
        by = np.argsort(words)
        self.words, self.shares, self.common = words[by], shares[by].astype(np.uint64), common

    def __call__(self, middle: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which are crowded, and their numbers of buckets."""
        if not len(self.words):
            return np.zeros(len(middle), bool), np.ones(len(middle), np.uint64)
        at = np.minimum(np.searchsorted(self.words, middle), len(self.words) - 1)
        found = self.words[at] == middle
        return found, np.where(found, self.shares[at], np.uint64(1))


def _added(seen: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Words and their counts, added up."""
    words, of = np.unique(np.concatenate([w for w, _ in seen]), return_inverse=True)
    return words, np.bincount(of, np.concatenate([n for _, n in seen]), len(words)).astype(np.int64)


def crowded_words(docs: DataFrame) -> tuple[int, Crowded]:
    """The number of words of ``keyed`` texts, and the crowded ones: words are counted where they are at least one in ten thousand of a task's piece.
    Common words are counted where a piece has them twice; which are common decides only how they are packed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(kind: int, words: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n), pa.array(np.full(len(n), kind, np.int32))], ["word", "n", "kind"])

        seen: list[tuple[np.ndarray, np.ndarray]] = []
        for held in _pieces(batches, DEALT):
            row = Row(held)
            words, n = np.unique(_middle(row.m, row.h, row.of)[row.middle], return_counts=True)
            often = n >= n.sum() / 10_000
            yield rows(MIDDLE, words[often], n[often])
            yield rows(WHOLE, np.zeros(1, np.uint64), n.sum(keepdims=True))
            words, n = np.unique(row.h[row.middle], return_counts=True)
            seen.append((words[n > 1], n[n > 1]))
            if sum(len(w) for w, _ in seen) > DEALT:
                seen = [_added(seen)]
        if seen:
            words, n = _added(seen)
            most = np.argsort(-n)[:COMMON]
            yield rows(ANY, words[most], n[most])

    MIDDLE, WHOLE, ANY = 0, 1, 2
    counted = docs.mapInArrow(released(run), "word long, n long, kind int").groupBy("word", "kind").agg(F.sum("n").alias("n"))
    counted = write_out(counted.filter((F.col("kind") != MIDDLE) | (F.col("n") > CROWDED)), "word-common")
    common = counted.filter(F.col("kind") == ANY).orderBy(F.desc("n")).limit(COMMON).select("word").toArrow()["word"].to_numpy().view(np.uint64)
    found = counted.filter(F.col("kind") != ANY).toArrow()  # fewer words than grams / CROWDED
    word, n, whole = found["word"].to_numpy(), found["n"].to_numpy(), found["kind"].to_numpy() == WHOLE
    return int(n[whole].sum()), Crowded(word[~whole].view(np.uint64), -(-n[~whole] // CROWDED), Common(common))


def _binary(values: np.ndarray, at: np.ndarray) -> pa.Array:
    """Rows of bytes: the values between places."""
    values = np.ascontiguousarray(values)
    return pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer((at * values.itemsize).astype(np.int32)), pa.py_buffer(values)])


def _values(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    """The values of all rows that ``_binary`` made, one row after the other."""
    parts = []
    for c in column.chunks:
        at = np.frombuffer(c.buffers()[1], np.int32, len(c) + 1, 4 * c.offset)
        if at[-1] > at[0]:
            parts.append(np.frombuffer(c.buffers()[2], kind, (at[-1] - at[0]) // np.dtype(kind).itemsize, at[0]))
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def _lengths(column: pa.ChunkedArray) -> np.ndarray:
    return pc.binary_length(column).to_numpy()


def _cells(packed: pa.Table) -> np.ndarray:
    """Which part of which text of its piece each gram is in."""
    return _values(packed["low"], np.uint16) | _values(packed["high"], np.uint16).astype(np.int32) << 16


def _changes(x: np.ndarray) -> np.ndarray:
    return np.append(True, x[1:] != x[:-1])


def _name(m: np.ndarray, d: np.ndarray, task: int, nth: int) -> np.int64:
    """A number for a task's piece and its texts."""
    h = mix(mix(m.view(np.uint64) + np.uint64(task)) + d.view(np.uint64))
    return np.bitwise_xor.reduce(mix(h + np.arange(nth, nth + len(h), dtype=np.uint64))).view(np.int64)


def deal(docs: DataFrame, parts: int, which: int, slices: int, buckets: int, crowded: Crowded) -> DataFrame:
    """Grams of one of the slices, packed: per piece its texts, and per bucket and piece the grams, by language and middle word."""
    common = crowded.common

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        names = [x.split()[0] for x in PACKED.split(", ")]
        for nth, held in enumerate(_pieces(batches, DEALT)):
            held.sort(key=lambda x: x[1] % len(HALVES))
            row = Row(held)
            m, d, h, of, valid = row.m, row.d, row.h, row.of, row.middle
            piece = _name(m, d, task, nth)
            home = int(_share(mix(np.array([piece]).view(np.uint64)), buckets)[0]) + which * buckets
            yield pa.RecordBatch.from_arrays([pa.array([home], pa.int32()), pa.array([piece]), pa.array([np.concatenate([m, d]).tobytes()], pa.binary()),
                                              pa.nulls(1, pa.int32()), *[pa.nulls(1, pa.binary())] * (len(names) - 4)], names)
            middle = _middle(m, h, of)
            shared, shares = crowded(middle)
            shared = np.flatnonzero(shared & valid)
            if len(shared):
                middle[shared] = _joined(middle[shared], mix(_short(h[shared - 1]) + h[shared + 1]) % shares[shared])
            mine = np.flatnonzero((_share(middle, slices) == which) & valid)
            if not len(mine):
                continue
            number = mix(middle[mine])
            bucket, lang = _share(number, buckets), np.unique(m, return_inverse=True)[1].astype(np.uint64)[of[mine]]
            # in order of buckets, languages and words; where the bits do not tell them apart, there are only more rows or runs
            by = np.argsort(bucket << np.uint64(48) | (lang & np.uint64(0xFFFF)) << np.uint64(32) | number & np.uint64(0xFFFFFFFF))
            mine, bucket, lang = mine[by], bucket[by], lang[by]
            u, v, w, cell = h[mine - 1], h[mine], h[mine + 1], of[mine] * parts + row.part(mine, parts)
            rows = _changes(bucket)
            langs = rows | _changes(lang)
            runs = langs | _changes(v)
            u_number, w_number = common(u), common(w)
            at = np.append(np.flatnonzero(rows), len(mine))

            def of_some(some: np.ndarray) -> np.ndarray:
                return np.append(0, np.cumsum(some))[at]

            def sizes(some: np.ndarray) -> np.ndarray:
                return np.diff(np.append(np.flatnonzero(some), len(mine))).astype(np.uint32)

            u_rare, w_rare = u_number == 0, w_number == 0
            n = len(at) - 1
            yield pa.RecordBatch.from_arrays([
                pa.array(bucket[rows].astype(np.int32) + np.int32(which * buckets)), pa.array(np.full(n, piece)), pa.nulls(n, pa.binary()),
                pa.array(np.full(n, parts * (half(d) == 0).sum(), np.int32)), _binary(m[of[mine[langs]]], of_some(langs)), _binary(sizes(langs), of_some(langs)),
                _binary(v[runs], of_some(runs)), _binary(sizes(runs), of_some(runs)), _binary(cell.astype(np.uint16), at), _binary((cell >> 16).astype(np.uint16), at),
                _binary(u_number, at), _binary(np.ascontiguousarray(u[u_rare].astype("<u8").view(np.uint16).reshape(-1, 4)[:, :3]).ravel(), 3 * of_some(u_rare)),
                _binary(w_number, at), _binary(w[w_rare], of_some(w_rare))], names)

    return docs.mapInArrow(released(run), PACKED)


class Bucket:
    """The grams of a bucket: occurrences, different runs of three (``n``: counts by half) and of two (``k``)."""

    def __init__(self, packed: pa.Table, common: Common) -> None:
        self.sizes = _lengths(packed["low"]) // 2
        self.half = (_cells(packed) >= np.repeat(packed["edge"].to_numpy(), self.sizes)).astype(np.int64)
        m, runs, words = (_values(packed[c], t) for c, t in (("langs", np.int64), ("runs", np.uint32), ("v", np.uint64)))
        m = np.repeat(m, _values(packed["sizes"], np.uint32))
        v, middle = np.repeat(words, runs), np.repeat(_middle(m[np.cumsum(runs) - runs], words), runs)
        u, w = (common.words[_values(packed[c], np.uint16)] for c in ("u", "w"))
        u = _short(u)
        rare = _values(packed["u"], np.uint16) == 0
        wide = np.zeros((rare.sum(), 4), np.uint16)
        wide[:, :3] = _values(packed["u_rare"], np.uint16).reshape(-1, 3)
        u[rare] = wide.view("<u8")[:, 0]
        number = _values(packed["w"], np.uint16)
        w[number == 0] = _values(packed["w_rare"], np.uint64)
        w = common.key(number, w)
        context = _joined(middle, u)
        gram = _joined(context, w)
        by = np.argsort(gram)
        gram = gram[by]
        new = np.append(True, gram[1:] != gram[:-1])
        self.gram = np.empty(len(by), np.int64)  # of an occurrence
        self.gram[by] = np.cumsum(new) - 1
        one, starts = by[new], np.flatnonzero(new)
        times, second = np.diff(np.append(starts, len(by))), np.add.reduceat(self.half[by], starts)
        self.n = (times - second, second)
        self.m, self.u, self.v, self.w, self.middle, self.context = m[one], u[one], v[one], w[one], middle[one], context[one]
        _, first, self.pair = np.unique(_joined(self.middle ^ np.uint64(1), self.w), return_index=True, return_inverse=True)
        # nothing but another start mark precedes one, so runs that begin a text keep their counts
        self.k = tuple(np.bincount(self.pair, np.where(self.v == START, n, n > 0)).astype(np.int64) for n in self.n)
        self.pair_m, self.pair_v, self.pair_w, self.pair_middle = self.m[first], self.v[first], self.w[first], self.middle[first]


def _rows(kind: int, bucket: int, m: np.ndarray, v: np.ndarray | int, w: np.ndarray, n: tuple[np.ndarray, np.ndarray]) -> pa.Table:
    some = np.flatnonzero((n[0] > 0) | (n[1] > 0))
    whole = lambda x, t: np.full(len(some), x, t)
    return pa.table({"kind": whole(kind, np.int32), "bucket": whole(bucket, np.int32), "m": m[some], "v": whole(v, np.int64) if isinstance(v, int) else v.view(np.int64)[some],
                     "w": w.view(np.int64)[some], "n0": n[0][some].astype(np.int64), "n1": n[1][some].astype(np.int64)})


def _summed(keys: np.ndarray, values: tuple[np.ndarray, ...]) -> tuple[np.ndarray, tuple[np.ndarray, ...]]:
    """The first place of each different key, and sums."""
    _, first, of = np.unique(keys, return_index=True, return_inverse=True)
    return first, tuple(np.bincount(of, x) for x in values)


def _classes(kind: int, bucket: int, m: np.ndarray, n: tuple[np.ndarray, np.ndarray]) -> pa.Table:
    """How many grams of a language come once, twice, three times and more often, per half."""
    langs, of = np.unique(m, return_inverse=True)
    sums = tuple(np.bincount(of * 5 + np.minimum(x, 4), minlength=5 * len(langs)).reshape(-1, 5)[:, 1:].ravel() for x in n)
    return _rows(kind, bucket, np.repeat(langs, 4), 0, np.tile(np.arange(1, 5), len(langs)), sums)


def count(dealt: DataFrame, crowded: Crowded) -> DataFrame:
    """What other buckets need of each bucket's counts, as rows of ``COUNTED``."""
    def run(packed: pa.Table) -> pa.Table:
        packed = packed.filter(packed["texts"].is_null())
        if not packed.num_rows:
            return pa.table({})
        b, bucket = Bucket(packed, crowded.common), packed["bucket"][0].as_py()
        shared, alone = crowded(b.middle)[0], ~crowded(b.pair_middle)[0]
        # the rows of a word name all words of the bucket, for their probabilities
        first, sums = _summed(_middle(b.pair_m, b.pair_w)[alone], tuple(k[alone] > 0 for k in b.k))
        out = [_rows(WORD, bucket, b.pair_m[alone][first], 0, b.pair_w[alone][first], sums), _classes(CLASS3, bucket, b.m, b.n),
               _classes(CLASS2, bucket, b.pair_m[alone], tuple(k[alone] for k in b.k)),
               _rows(PAIR, bucket, b.pair_m[~alone], b.pair_v[~alone], b.pair_w[~alone], tuple(k[~alone] for k in b.k))]
        if shared.any():
            n = tuple(x[shared] for x in b.n)
            first, sums = _summed(b.context[shared], tuple(x for h in HALVES for x in (n[h], n[h] == 1, n[h] == 2, n[h] > 2)))
            out += [_rows(TOTAL + k, bucket, b.m[shared][first], b.v[shared][first], b.u[shared][first], (sums[k], sums[4 + k])) for k in range(4)]
        return pa.concat_tables(out)

    return dealt.groupBy("bucket").applyInArrow(released_group(run), COUNTED)


# ---- smoothing


def _class_sums(counts: DataFrame) -> DataFrame:
    """``m`` and, per half, the numbers ``t1`` to ``t4`` of grams that come so often, 4 or more for 4."""
    return counts.groupBy("m").agg(*each(lambda h: [F.sum((F.least(f"n{h}", F.lit(4)) == k).cast("long")).alias(f"t{k}_{h}") for k in (1, 2, 3, 4)]))


def _discounts(sums: DataFrame) -> DataFrame:
    """``m`` and, per half, the discounts ``d1, d2, d3`` of one, two and more occurrences."""
    def cuts(h: int) -> list[Column]:
        t = {k: F.col(f"t{k}_{h}").cast("double") for k in (1, 2, 3, 4)}
        share = t[1] / (t[1] + 2 * t[2])
        return [F.coalesce(F.when((t[k] > 0) & (t[k + 1] > 0) & (t[1] + t[2] > 0), F.least(
            F.lit(k - 0.05), F.greatest(F.lit(0.05), k - (k + 1) * share * t[k + 1] / t[k]))), F.lit(0.5)).alias(f"d{k}_{h}") for k in (1, 2, 3)]

    sums = sums.groupBy("m").agg(*each(lambda h: [F.sum(f"t{k}_{h}").alias(f"t{k}_{h}") for k in (1, 2, 3, 4)]))
    return write_out(sums.select("m", *each(cuts)), "word-discounts")


def _cut(h: int) -> Column:
    n = F.col(f"n{h}")
    return F.when(n == 1, F.col(f"d1_{h}")).when(n == 2, F.col(f"d2_{h}")).when(n > 2, F.col(f"d3_{h}")).otherwise(F.lit(0.0))


def _smoothed(rows: DataFrame, h: int, below: Column) -> Column:
    n, total = F.col(f"n{h}"), F.col(f"total{h}")
    return F.when(total > 0, (n - _cut(h)) / total + F.col(f"held{h}") / total * below).otherwise(below).alias(f"x{h}")


def _totals(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(*each(lambda h: [
        F.sum(f"n{h}").alias(f"total{h}"), F.sum(_cut(h)).alias(f"held{h}"), F.sum((F.col(f"n{h}") > 0).cast("long")).alias(f"size{h}")]))


def _sums(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(*each(lambda h: [F.sum(f"n{h}").alias(f"n{h}")]))


def smooth(counted: DataFrame, kept: Callable[[DataFrame, str], DataFrame], dropped: Callable[[DataFrame], None]) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """From the rows of all buckets, per half ``x``: probabilities of words (``m, w``) and of runs of two that buckets share (``m, v, w``),
    totals and held-back counts of shared contexts (``kind, m, v, w``), and discounts (``kind, m, w``).

    The summed counts, which ``kept`` made, are given to ``dropped`` as soon as the model is written. A half that has not seen a context gives what it gives without the context's first word; one
    without any gram of the language gives null. The lowest order is mixed with an even chance for each word and an unknown one."""
    two = pairs = kept(_sums(counted.filter(F.col("kind") == PAIR), "m", "v", "w"), "word-grams-2")
    seen = pairs.select("m", "w", *each(lambda h: [(F.col(f"n{h}") > 0).cast("long").alias(f"n{h}")]))
    one = words = kept(_sums(counted.filter(F.col("kind") == WORD).select("m", "w", "n0", "n1").unionByName(seen), "m", "w"), "word-grams-1")

    def classes(kind: int) -> DataFrame:
        return counted.filter(F.col("kind") == kind).groupBy("m").agg(*each(lambda h: [F.sum(F.when(F.col("w") == k, F.col(f"n{h}")).otherwise(0)).alias(f"t{k}_{h}") for k in (1, 2, 3, 4)]))

    cuts = {1: _discounts(_class_sums(words)), 2: _discounts(classes(CLASS2).unionByName(_class_sums(pairs))), 3: _discounts(classes(CLASS3))}
    rows = words.join(short_list(cuts[1]), "m")
    rows = rows.join(short_list(write_out(_totals(rows, "m"), "word-totals")), "m")
    words = kept(rows.select("m", "w", *each(lambda h: [_smoothed(rows, h, F.when(F.col(f"size{h}") > 0, 1.0 / (F.col(f"size{h}") + 1)))])), "word-model-1")

    rows = pairs.join(short_list(cuts[2]), "m")
    rows = rows.join(_totals(rows, "m", "v"), ["m", "v"]).join(words, ["m", "w"])
    pairs = kept(rows.select("m", "v", "w", *each(lambda h: [_smoothed(rows, h, F.col(f"x{h}"))])), "word-model-2")

    dropped(one)
    dropped(two)

    shared = counted.filter(F.col("kind") >= TOTAL).groupBy("m", "v", "w").agg(*each(lambda h: [
        F.sum(F.when(F.col("kind") == TOTAL + k, F.col(f"n{h}")).otherwise(0)).alias(f"c{k}_{h}") for k in range(4)])).join(short_list(cuts[3]), "m")
    held = [sum(F.col(f"c{k}_{h}") * F.col(f"d{k}_{h}") for k in (1, 2, 3)) for h in HALVES]
    shared = shared.select("m", "v", "w", F.explode(F.array(
        F.struct(F.lit(TOTAL).alias("kind"), *[F.col(f"c0_{h}").cast("double").alias(f"x{h}") for h in HALVES]),
        F.struct(F.lit(TOTAL + 1).alias("kind"), *[held[h].alias(f"x{h}") for h in HALVES]))).alias("x")).select("m", "v", "w", "x.*")
    shared = kept(shared, "word-contexts")

    flat = None
    for kind, order in ((CLASS2, 2), (CLASS3, 3)):
        some = cuts[order].select("m", F.explode(F.array(*[F.struct(F.lit(kind).alias("kind"), F.lit(k).cast("long").alias("w"), *[F.col(f"d{k}_{h}").alias(f"x{h}") for h in HALVES]) for k in (1, 2, 3)])).alias("x")).select("m", "x.*")
        flat = some if flat is None else flat.unionByName(some)
    return words, pairs, shared, flat


def needed(counted: DataFrame, words: DataFrame, pairs: DataFrame, shared: DataFrame, cuts: DataFrame) -> DataFrame:
    """``bucket, kind, m, v, w, x0, x1``: what each bucket needs from all others to smooth its own counts."""
    own = lambda kind: counted.filter(F.col("kind") == kind).select("bucket", "m", "v", "w")
    numbered = F.col("w").between(1, COMMON - 1)
    parts = [own(WORD).filter(numbered).join(short_list(words.filter(numbered)), ["m", "w"]).withColumn("kind", F.lit(WORD)),
             own(WORD).filter(~numbered).join(words.filter(~numbered), ["m", "w"]).withColumn("kind", F.lit(WORD)), own(PAIR).join(pairs, ["m", "v", "w"]).withColumn("kind", F.lit(PAIR)),
             own(TOTAL).join(shared, ["m", "v", "w"]),
             counted.filter(F.col("kind") == CLASS3).select("bucket", "m").distinct().join(cuts, "m").withColumn("v", F.lit(0).cast("long"))]
    out = None
    for p in parts:
        p = p.select("bucket", "kind", "m", "v", "w", "x0", "x1")
        out = p if out is None else out.unionByName(p)
    return out


class Needed:
    """The rows of ``needed`` for a bucket, by kind and key."""

    def __init__(self, rows: pa.Table) -> None:
        kind, m, v, w = (rows[c].to_numpy() for c in ("kind", "m", "v", "w"))
        x = [rows[f"x{h}"].to_numpy() for h in HALVES]  # null: not a number
        self.found = {}
        for k in np.unique(kind):
            at = np.flatnonzero(kind == k)
            keys = self.key(int(k), m[at], v[at].view(np.uint64), w[at].view(np.uint64))
            by = np.argsort(keys)
            self.found[int(k)] = keys[by], [c[at][by] for c in x]

    @staticmethod
    def key(kind: int, m: np.ndarray, v: np.ndarray, w: np.ndarray) -> np.ndarray:
        return _joined(_middle(m, v), w) if kind in (PAIR, TOTAL, TOTAL + 1) else _middle(m, w)

    def __call__(self, kind: int, m: np.ndarray, v: np.ndarray, w: np.ndarray) -> list[np.ndarray]:
        """The values of both halves; every key that is asked for is there."""
        if not len(m):
            return [np.zeros(0) for _ in HALVES]
        keys, values = self.found[kind]
        at = np.searchsorted(keys, self.key(kind, m, v, w))
        return [x[at] for x in values]


def _cuts(got: Needed, kind: int, m: np.ndarray, n: tuple[np.ndarray, np.ndarray]) -> list[np.ndarray]:
    langs, of = np.unique(m, return_inverse=True)
    out = [np.zeros((len(langs), 4)) for _ in HALVES]
    for k in (1, 2, 3):
        for h, x in enumerate(got(kind, langs, langs.view(np.uint64), np.full(len(langs), k, np.uint64))):
            out[h][:, k] = x
    return [out[h][of, np.minimum(n[h], 3)] for h in HALVES]


def _mixed(n: np.ndarray, cut: np.ndarray, total: np.ndarray, held: np.ndarray, below: np.ndarray) -> np.ndarray:
    safe = np.maximum(total, 1)
    return np.where(total > 0, (n - cut) / safe + held / safe * below, below)


def scores(dealt: DataFrame, need: DataFrame, crowded: Crowded) -> DataFrame:
    """The probabilities of all grams of a piece in a bucket, as rows of ``SCORED``; the rows that name a piece's texts are passed on."""
    def run(packed: pa.Table, rows: pa.Table) -> pa.Table:
        whole = pa.schema([("piece", pa.int64()), *[(c, pa.binary()) for c in ("texts", "low", "high", "p")]])
        if not packed.num_rows:
            return whole.empty_table()
        named = packed.filter(packed["texts"].is_valid())
        named = pa.table([named["piece"], named["texts"], *[pa.nulls(named.num_rows, pa.binary())] * 3], whole)
        packed = packed.filter(packed["texts"].is_null())
        if not packed.num_rows:
            return named
        b, got = Bucket(packed, crowded.common), Needed(rows)
        shared = crowded(b.pair_middle)[0]
        cut = _cuts(got, CLASS2, b.pair_m, b.k)
        _, of = np.unique(b.pair_middle, return_inverse=True)
        own = [np.zeros(len(shared)) for _ in HALVES]
        words, pairs = (got(kind, b.pair_m[at], b.pair_v[at], b.pair_w[at]) for kind, at in ((WORD, ~shared), (PAIR, shared)))
        for h in HALVES:
            total, held = np.bincount(of, b.k[h])[of], np.bincount(of, cut[h])[of]
            own[h][~shared] = _mixed(b.k[h][~shared], cut[h][~shared], total[~shared], held[~shared], words[h])
            own[h][shared] = pairs[h]
        shared = np.flatnonzero(crowded(b.middle)[0])
        cut = _cuts(got, CLASS3, b.m, b.n)
        _, of = np.unique(b.context, return_inverse=True)
        totals, helds = (got(kind, b.m[shared], b.v[shared], b.u[shared]) for kind in (TOTAL, TOTAL + 1))
        p = []
        for h in HALVES:
            total, held = np.bincount(of, b.n[h])[of], np.bincount(of, cut[h])[of]
            total[shared], held[shared] = totals[h], helds[h]
            p.append(_mixed(b.n[h], cut[h], total, held, own[h][b.pair]).astype(np.float32))
        value = np.where(b.half == 0, p[1][b.gram], p[0][b.gram])
        ends = np.cumsum(b.sizes)
        value = pa.array([value[lo:hi].tobytes() for lo, hi in zip(ends - b.sizes, ends)], pa.binary())
        return pa.concat_tables([named, pa.table([packed["piece"], packed["texts"], packed["low"], packed["high"], value], whole)])

    return dealt.groupBy("bucket").cogroup(need.groupBy("bucket")).applyInArrow(released_group(run), SCORED)


def by_text(scored: DataFrame, parts: int) -> DataFrame:
    """``m, d`` and per part the sum of log probabilities and the number of a text's grams that have one, per text of a piece."""
    def run(rows: pa.Table) -> pa.Table:
        m, d = np.frombuffer(next(x for x in rows["texts"].to_pylist() if x is not None), np.int64).reshape(2, -1)
        rows = rows.filter(rows["texts"].is_null())
        cell, value = _cells(rows), _values(rows["p"], np.float32).astype(np.float64)
        known = ~np.isnan(value)
        sums = np.bincount(cell[known], np.log(value[known]), len(m) * parts)
        n = np.bincount(cell[known], minlength=len(m) * parts)
        return pa.table({"m": m, "d": d} | {f"{c}{k}": x.reshape(-1, parts)[:, k] for k in range(parts) for c, x in (("sum", sums), ("n", n))})

    schema = "m long, d long, " + ", ".join(f"sum{k} double, n{k} long" for k in range(parts))
    return scored.groupBy("piece").applyInArrow(released_group(run), schema)


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go when their query ends, not when the driver happens to collect its garbage."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def slices_for(total: int) -> int:
    return min(groups_for(total, BUCKET), max(FEW_SLICES, min(SLICES, groups_for(total, SLICE))))


def score(docs: DataFrame, parts: int, no_lang: str) -> DataFrame:
    """``m, d, word_ppl, least_word_ppl, most_word_ppl`` per language and text: log perplexity of the text, and of its least and most
    surprising part, under the other half's model; null where the other half has no text of the language. Texts without words have no row."""
    spark = docs.sparkSession
    made: dict[int, tuple[str, DataFrame]] = {}

    def kept(df: DataFrame, purpose: str) -> DataFrame:
        path = shared_dir(spark, purpose)
        df.write.parquet(path)
        out = spark.read.schema(df.schema).parquet(path)
        made[id(out)] = path, out
        return out

    def dropped(df: DataFrame) -> None:
        empty_out(spark, made.pop(id(df))[0], df.schema)

    def together(frames: list[DataFrame]) -> DataFrame:
        out = frames[0]
        for f in frames[1:]:
            out = out.unionByName(f)
        return out

    docs = keyed(docs, no_lang)
    with shuffles_dropped(spark):
        total, crowded = crowded_words(docs)
        readings = groups_for(slices_for(total), TOGETHER)
        buckets = groups_for(total, readings * BUCKET)
        dealt = [deal(docs, parts, k, readings, buckets, crowded) for k in range(readings)]
        counted = [kept(count(x, crowded), "word-counts") for x in dealt]
        model = smooth(together(counted), kept, dropped)
        sums = [F.sum(f"{c}{k}").alias(f"{c}{k}") for k in range(parts) for c in ("sum", "n")]
        own = []
        for x, counts in zip(dealt, counted):
            own.append(kept(by_text(scores(x, needed(counts, *model), crowded), parts), "word-scores"))
            dropped(counts)
        rows = together(own).groupBy("m", "d").agg(*sums)
        mean = [F.when(F.col(f"n{k}") > 0, -F.col(f"sum{k}") / F.col(f"n{k}")) for k in range(parts)]
        total, n = (sum((F.col(f"{c}{k}") for k in range(1, parts)), F.col(f"{c}0")) for c in ("sum", "n"))
        every = F.array(*mean)
        out = write_out(rows.select("m", "d", F.when(n > 0, -total / n).alias("word_ppl"), F.array_min(every).alias("least_word_ppl"), F.array_max(every).alias("most_word_ppl")), "word-scores")
        for _, df in list(made.values()):
            dropped(df)
    return out
