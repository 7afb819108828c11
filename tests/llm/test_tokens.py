"""Token counts, token files and packing."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from dqspark.llm import packing, tokencount, tokenfile

WORDS, BYTES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
ROWS = [(3, "The cat sat."), (1, None), (2, ""), (7, "x " * 9000), (3, "The cat sat."), (None, "no id"), (5, "été 12 <|endoftext|>"), (6, "a\n\n  b ")]
SCHEMA = "doc_id long, text string, shard string, bin int, page int, n_tokens int, key int, offset string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, "s", 1, 2, 3, 4, "o") for r in ROWS], SCHEMA)


def encoded(path, text, eos=None):
    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids + ([eos] if eos else [])


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


@settings(max_examples=60, deadline=None)
@given(ids=st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), min_size=1, max_size=700), percentile=st.sampled_from([0.0, 0.5, 0.9, 1.0]))
def test_blocks_round_trip(ids, percentile):
    a = np.array(ids, dtype=np.uint32)
    assert tokenfile.unpack_blocks(len(a), *tokenfile.pack_blocks(a, percentile)).tolist() == ids


def test_outliers_are_exceptions():
    a = np.arange(128, dtype=np.uint32) % 7 + 1000
    a[5] = 2**31
    low, width, first, place, high, packed = tokenfile.pack_blocks(a)
    assert low.tolist() == [1000] and width.tolist() == [3] and place.tolist() == [5] and len(packed) == 48


def test_token_file(spark, docs):
    got = sorted(map(tuple, tokenfile.write_and_read(docs, WORDS, shard_rows=3, page_ids=50).collect()), key=lambda r: r[1])
    want, at = [], 0
    for d, t in sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = encoded(WORDS, t, 1)
        want.append((d, at, len(ids), crc(ids)))
        at += len(ids)
    assert got == want
    assert tokenfile.write_and_read(docs.limit(0), WORDS).collect() == []


@pytest.mark.parametrize("options", [{}, {"table_size": 3}, {"table_size": 0}, {"sample_rows": 1}])
def test_counts(spark, docs, options):
    out = tokencount.count_tokens(docs, BYTES, limit=4, **options)
    want = [(d, len((t or "").encode()), len(encoded(BYTES, t)), len(encoded(BYTES, t)) > 4) for d, t in ROWS]
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(want, key=repr)
    assert tokencount.count_tokens(docs.limit(0), BYTES, **options).collect() == []


def test_no_piece_is_shuffled(spark, docs):
    stored = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for df in (tokencount.count_tokens(stored, BYTES), tokencount.sampled_pieces(stored, BYTES)):
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    assert tokencount.sampled_pieces(stored, BYTES, rows=20, per_row=3).count() <= 3 * 60


@settings(max_examples=80, deadline=None)
@given(pieces=st.lists(st.binary(min_size=1, max_size=tokencount.WIDTH + 8), min_size=1, max_size=60, unique=True), data=st.data())
def test_piece_table(pieces, data):
    """A hit has the table's count; whatever else (zeros at the end, other lengths) is a miss."""
    held = [p for p in data.draw(st.lists(st.sampled_from(pieces), unique=True)) if len(p) <= tokencount.WIDTH]
    t = tokencount.piece_table(held, [i + 1 for i in range(len(held))])
    asked = pieces + [p + b"\0" for p in pieces]
    a = np.frombuffer(b"".join(asked), dtype=np.uint8)
    end = np.cumsum([len(p) for p in asked])
    want = {p: i + 1 for i, p in enumerate(held)}
    assert t.find(a, np.append(0, end[:-1]), end).tolist() == [want.get(p, -1) for p in asked]


@settings(max_examples=60, deadline=None)
@given(lengths=st.lists(st.integers(1, 20), max_size=60))
def test_best_fit(lengths):
    where, offset, level = packing.best_fit(lengths, 20)
    places = {}
    for n, b, o in zip(lengths, where, offset):
        assert o == places.get(b, 0)
        places[b] = o + n
    assert [places[b] for b in range(len(level))] == level and all(x <= 20 for x in level)
    # a new bin only where no other had room
    room = {}
    for n, b in zip(lengths, where):
        fits = [r for r in room.values() if r >= n]
        assert (room[b] == min(fits)) if b in room else not fits
        room[b] = room.get(b, 20) - n


SHAPES = {
    "spread": lambda rng: np.minimum(100, rng.exponential(30, 400) + 1),
    "halves": lambda rng: rng.integers(46, 56, 400),
    "few small": lambda rng: np.where(rng.random(400) < 0.03, rng.integers(1, 40, 400), rng.integers(51, 97, 400)),
}


def packed(spark, lengths, **options):
    pieces = spark.createDataFrame(list(enumerate(lengths)), "key long, length int")
    got = packing.pack(pieces, capacity=100, **options).collect()
    assert sorted(r.key for r in got) == list(range(len(lengths)))
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, lengths[r.key]))
    for b in bins.values():
        at = 0
        for o, n in sorted(b):
            assert o == at
            at += n
        assert at <= 100
    return bins


@pytest.mark.parametrize("shape", SHAPES)
@pytest.mark.parametrize("options", [{"group_size": 40, "fan": 2}, {"group_size": 10, "fan": 3}])
def test_no_round_misses_a_bin_that_was_held_back(spark, monkeypatch, shape, options):
    """As many sequences as when every underfull bin goes up."""
    lengths = [int(x) for x in SHAPES[shape](np.random.default_rng(5))]
    bins = packed(spark, lengths, **options)
    monkeypatch.setattr(packing, "hosts_kept", lambda fan, rounds: 10**9 if rounds else 0)
    assert len(bins) == len(packed(spark, lengths, **options))


def test_packing_of_one_group_is_tight(spark):
    lengths = [int(x) for x in SHAPES["spread"](np.random.default_rng(5))]
    assert len(packed(spark, lengths)) <= 1.05 * -(-sum(lengths) // 100)


def test_pack_documents(spark, docs):
    got = packing.pack_documents(docs, WORDS, capacity=64).collect()
    parts = {}
    for r in got:
        assert 1 <= r.length <= 64 and r.start == 64 * r.piece
        parts.setdefault(r.doc_id, []).append((r.piece, r.length, r.ids_crc32))
    ids = encoded(WORDS, "x " * 9000, 1)
    assert sorted(parts[7]) == [(k, len(ids[64 * k : 64 * k + 64]), crc(ids[64 * k : 64 * k + 64])) for k in range(-(-len(ids) // 64))]
    assert parts[1] == [(0, 1, crc([1]))] and len(parts[3]) == 2 and parts[None]
    assert packing.pack_documents(docs.limit(0), WORDS).collect() == []


def test_bounded_memory_slices(spark, monkeypatch):
    """Results don't depend on how rows are cut into batches."""
    from dqspark.llm import common

    rows = pytest.importorskip("pyarrow").RecordBatch.from_pydict({"a": list(range(1300))})
    parts = list(common.small_batches([rows, rows.slice(0, 0)]))
    assert [p.num_rows for p in parts] == [512, 512, 276]
    assert [x for p in parts for x in p.column(0).to_pylist()] == list(range(1300))
