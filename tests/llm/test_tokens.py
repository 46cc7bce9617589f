import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shillingflow.llm import huffman, packing, tokens
from shillingflow.session import shared_dir

from .helpers import no_docs, odd_docs, odd_rows


@pytest.fixture(scope="module")
def encoder():
    return tokens.Encoder(tokens.vocabulary())


def library_ids(encoder, text):
    return encoder.library.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="abcXYZ'''sdtmvelr 12  \n\t.,!?éÉßñÀ€%&<|>ſİ́σΣ\u0000\u001c\u00a0ǅÿ", max_size=60), max_size=8))
def test_same_ids_as_the_library(encoder, texts):
    assert [x.tolist() for x in encoder.encode(texts)] == [library_ids(encoder, t) for t in texts]


def test_cases_of_the_cutter(encoder, monkeypatch):
    texts = ["it's I'VE we'll they'd'S", "'s 're'll x''s ,'s", "<|endoftext|> a", None, "", "12a3", "a" * 3000]
    assert [x.tolist() for x in encoder.encode(texts)] == [library_ids(encoder, t) for t in texts]
    monkeypatch.setattr(tokens, "CHUNK", 40)
    monkeypatch.setattr(tokens, "POOL", 10)
    long = "One thing's sure, 12 of them aren't ÉTÉ. " * 20
    assert encoder.encode([long])[0].tolist() == library_ids(encoder, long)


def test_ids_pack_and_unpack():
    for ids in ([], [0, 65535], [0, 65536, 1 << 31]):
        assert tokens.unpack_ids(tokens.pack_ids(np.array(ids, np.uint32))).tolist() == ids


# ---- packing


def test_pieces_fill_sequences_without_gaps(spark, encoder):
    rows = odd_rows()
    got = packing.op2(odd_docs(spark, clash=True)).toPandas()
    want = sorted((-1 if r[0] is None else r[0], p, lo, len(ids[lo:lo + 2048]), zlib.crc32(np.array(ids[lo:lo + 2048], "<u4").tobytes()))
                  for r in rows for ids in [[*library_ids(encoder, r[1]), 0]] for p, lo in enumerate(range(0, len(ids), 2048)))
    have = got.assign(doc_id=got.doc_id.fillna(-1).astype(int))
    assert sorted(have[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False, name=None)) == want
    by = got.sort_values(["sequence_id", "offset"])
    assert (by.offset == by.groupby("sequence_id")["length"].cumsum() - by["length"]).all()
    assert by.groupby("sequence_id")["length"].sum().max() <= 2048
    assert packing.op2(no_docs(spark)).count() == 0


def test_few_sequences():
    r = np.random.default_rng(1)
    lengths = np.sort(np.minimum(2048, r.lognormal(6, 1, 5000).astype(int) + 1))[::-1]
    sequence, offset = packing.assign(lengths, 2048)
    assert sequence.max() + 1 <= 1.01 * -(-lengths.sum() // 2048)
    used = np.bincount(sequence, weights=lengths)
    assert used.max() <= 2048


def test_each_step_makes_the_sum_of_squares_smallest():
    r = np.random.default_rng(2)
    lengths = r.integers(1, 21, 200)
    sequence, offset = packing.assign(lengths, 20)
    level: dict[int, int] = {}

    def total(levels):
        return sum(x * x for x in np.bincount([20 - v for v in levels if v < 20], minlength=21).tolist())

    for size, seq, off in zip(lengths.tolist(), sequence.tolist(), offset.tolist()):
        fits = [s for s, v in level.items() if v + size <= 20]
        assert level.get(seq, 0) == off
        if fits:
            best = min(total([v + size * (s == t) for s, v in level.items()]) for t in fits)
            assert seq in level and total([v + size * (s == seq) for s, v in level.items()]) == best
        else:
            assert seq not in level
        level[seq] = off + size


# ---- files


def test_code_lengths_are_optimal_and_limited():
    assert huffman.code_lengths(np.array([5])).tolist() == [1] and huffman.code_lengths(np.array([], int)).tolist() == []
    counts = np.array([1, 1, 2, 3, 5, 8, 13, 21, 34, 55])
    free = huffman.code_lengths(counts, 16)
    assert (counts * free).sum() == 363  # merging the two smallest: 2+4+7+12+20+33+54+88+143
    tight = huffman.code_lengths(counts, 4)
    assert tight.max() == 4 and (0.5 ** tight).sum() <= 1 and (0.5 ** free).sum() == 1


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 300), max_size=200), min_size=1, max_size=6))
def test_bits_round_trip(docs):
    ids = np.array([x for d in docs for x in d], np.int64)
    used, counts = np.unique(ids, return_counts=True)
    codes = huffman.Codes(used, huffman.code_lengths(counts))
    sizes = np.array([len(d) for d in docs])
    if not len(ids):
        return
    data, starts, marks = huffman.write_bits(ids, sizes, codes.encoding())
    back = huffman.read_bits(data, starts[:-1], sizes, marks.astype(np.int64), codes, codes.decoding())
    assert back.tolist() == ids.tolist()


def test_files_round_trip(spark, encoder, monkeypatch):
    monkeypatch.setattr(huffman, "BLOCK", 500)
    rows, path = odd_rows(), shared_dir(spark, "test-ids")
    huffman.encode_documents(odd_docs(spark, clash=True), path)
    got = sorted(huffman.read_ids(spark, path).collect(), key=lambda r: r.start)
    want = sorted(([*library_ids(encoder, r[1]), 2], r[0]) for r in rows if r[0] is not None)
    assert sorted((tokens.unpack_ids(r.ids).tolist(), r.doc_id) for r in got if r.doc_id is not None) == want
    assert [r.doc_id for r in got if r.doc_id is not None] == sorted(r[0] for r in rows if r[0] is not None)
    assert [r.doc_id for r in got][:2] == [None, None]
    at = 0
    for r in got:
        assert r.start == at
        at += len(tokens.unpack_ids(r.ids))
    assert huffman.op5(no_docs(spark)).collect() == []


def test_digests_of_a_table(spark, encoder):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    at = 0
    got = {r.doc_id: r for r in huffman.op5(docs).collect()}
    for row in sorted(docs.select("doc_id", "text").collect()):
        ids = [*library_ids(encoder, row.text), 2]
        assert tuple(got[row.doc_id]) == (row.doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
