"""Exact token ids of a public tokenizer, a batch of documents at a time.

The tokenizer splits a text into runs of letters, single digits, contractions and runs of other
marks, and encodes each piece on its own. Most pieces have been seen before, so pieces are cut and
hashed for a whole batch with array operations, looked up in a table kept by the worker, and only
new ones go to the library. Texts outside a plain Latin alphabet go to the library whole.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import released
from .hashing import SpanHasher

VOCABULARY = "word_bpe_49k.json"
CHUNK = 500_000  # characters cut at a time
SLOTS = 1 << 20
POOL = 6_000_000  # ids kept for known pieces; the table starts anew beyond that

#: White space, ASCII marks and precomposed Latin letters: composed, and lower-cased alike everywhere.
PLAIN = "\t\n\r -~À-ÖØ-öø-įı-ɏ"
OTHER = re.compile(f"[^{PLAIN}]|<\\|")
_SPACE, _LETTER, _DIGIT, _MARK = 1, 2, 3, 4


def _classes() -> np.ndarray:
    kind = np.full(256, _MARK, np.uint8)
    kind[0], kind[list(b"\t\n\r ")] = 0, _SPACE
    kind[list(range(ord("a"), ord("z") + 1)) + list(range(128, 256))] = _LETTER
    kind[list(range(ord("0"), ord("9") + 1))] = _DIGIT
    return kind


class Encoder:
    """Ids as the library gives them without special tokens."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.kinds = _classes()
        self.hashes = SpanHasher()
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(SLOTS, np.uint64)
        self.at = np.zeros(SLOTS, np.int64)  # place in ``first``
        self.first, self.pool = np.zeros(1, np.int64), np.zeros(0, np.uint32)

    def _pieces(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the pieces of lower-cased bytes; a zero byte ends a text."""
        kind = self.kinds[data]
        start = kind >= _LETTER
        start[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
        quote = np.flatnonzero(data == ord("'"))
        quote = quote[start[quote]]
        if len(quote):
            padded = np.append(data, np.zeros(3, np.uint8))
            one, two = padded[quote + 1], padded[quote + 2]
            short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
            long = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
            for hit, size in ((short, 2), (long & ~short, 3)):
                at = quote[hit]
                start[at + 1] = False
                after = at + size
                after = after[after < len(data)]
                start[after] |= kind[after] == _LETTER
        begin = np.flatnonzero(start)
        stop = np.flatnonzero(start | (kind <= _SPACE))
        end = np.append(stop, len(data))[np.searchsorted(stop, begin, side="right")]
        return begin, end

    def _learn(self, words: list[bytes]) -> np.ndarray:
        """Adds pieces to the pool and returns their places."""
        counts, parts = [], []
        for i in range(0, len(words), 4000):
            some = words[i:i + 4000]
            found = self.library.encode(b" ".join(some).decode(), add_special_tokens=False)
            of = np.fromiter((w for w in found.word_ids), np.int64, len(found))
            counts.append(np.bincount(of, minlength=len(some)))
            parts.append(np.array(found.ids, np.uint32))
            assert len(counts[-1]) == len(some), "a piece was cut again"
        places = len(self.first) - 1 + np.arange(len(words))
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(np.concatenate(counts))])
        self.pool = np.concatenate([self.pool, *parts])
        return places

    def _plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain texts, and where each text's ids end."""
        data = np.frombuffer(("\0".join(texts) + "\0").lower().encode(), np.uint8)
        begin, end = self._pieces(data)
        if not len(begin):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        h = self.hashes(data, begin, end) | np.uint64(1)  # 0 marks a free slot
        if len(self.pool) > POOL:
            self._clear()
        slot = (h >> np.uint64(20)).astype(np.int64) & (SLOTS - 1)
        place = np.where(self.keys[slot] == h, self.at[slot], -1)
        new = np.flatnonzero(place < 0)
        if len(new):
            _, one, which = np.unique(h[new], return_index=True, return_inverse=True)
            raw = data.tobytes()
            places = self._learn([raw[b:e] for b, e in zip(begin[new[one]].tolist(), end[new[one]].tolist())])
            place[new] = places[which]
            self.keys[slot[new]], self.at[slot[new]] = h[new], place[new]
        size = self.first[place + 1] - self.first[place]
        upto = np.cumsum(size)
        ids = self.pool[np.repeat(self.first[place] - (upto - size), size) + np.arange(upto[-1])]
        last = np.searchsorted(begin, np.flatnonzero(data == 0))  # pieces before each text's end
        return ids, np.append(0, upto)[last]

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids per text; a null text has none."""
        out: list[list[np.ndarray]] = [[] for _ in texts]
        held: list[tuple[int, str]] = []
        size = 0

        def flush() -> None:
            nonlocal size
            if held:
                ids, ends = self._plain([t for _, t in held])
                for (i, _), part in zip(held, np.split(ids, ends[:-1])):
                    out[i].append(part)
                held.clear()
                size = 0

        for i, text in enumerate(texts):
            if not text:
                continue
            if OTHER.search(text):
                out[i].append(np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32))
                continue
            for part in _parts(text):
                held.append((i, part))
                size += len(part)
                if size >= CHUNK:
                    flush()
        flush()
        return [p[0] if len(p) == 1 else np.concatenate(p) if p else np.zeros(0, np.uint32) for p in out]


def _parts(text: str) -> Iterator[str]:
    """A very long text in parts, cut at spaces, which no piece crosses."""
    at = 0
    while len(text) - at > 2 * CHUNK:
        cut = text.find(" ", at + CHUNK)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut
    yield text[at:] if at else text


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder of a vocabulary: what it has learned serves its later tasks; results don't depend on it."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def vocabulary(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pack_ids(ids: np.ndarray) -> bytes:
    """Little-endian, two bytes an id where all fit, else four; the first byte tells the width."""
    if len(ids) == 0 or ids.max() < 1 << 16:
        return b"\x02" + ids.astype("<u2").tobytes()
    return b"\x04" + ids.astype("<u4").tobytes()


def unpack_ids(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<u2" if data[0] == 2 else "<u4", offset=1).astype("<u4")


Present = Callable[[pa.Array, list[np.ndarray]], pa.RecordBatch]


def whole(docs: pa.Array, ids: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([docs, pa.array([pack_ids(x) for x in ids], pa.binary()), pa.array([len(x) for x in ids], pa.int64())],
                                      ["doc_id", "ids", "n_tokens"])


def tokenize(docs: DataFrame, vocab: str | None = None, end_id: int | None = None, present: Present = whole,
             schema: str = "doc_id long, ids binary, n_tokens long") -> DataFrame:
    """``doc_id, ids, n_tokens``: packed ids of whole texts, with ``end_id`` appended where one is given.
    ``present`` may give other rows of a batch's documents.

    Null and empty texts have only the end id; repeated rows stay repeated; other columns are left out."""
    tail = np.array([] if end_id is None else [end_id], np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocab or vocabulary())
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                yield present(part.column("doc_id"), [np.append(x, tail).astype(np.uint32) for x in enc.encode(part.column("text").to_pylist())])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(released(run), schema)
