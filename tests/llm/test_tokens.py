"""Token operators against the tokenizers library and exact round trips."""

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyarrow import fs

from opsignals.llm import packing, token_counts, token_files, tokens
from opsignals.llm.bpe import BpeCodec, bpe_decode, bpe_encode, codec

tokenizers = pytest.importorskip("tokenizers")
WORD, BYTE = tokens.tokenizer_file("word_bpe_49k.json"), tokens.tokenizer_file("byte_bpe_50k.json")
LIBRARY = {p: tokenizers.Tokenizer.from_file(p) for p in (WORD, BYTE)}
ALPHABET = st.sampled_from([*"abcXYZ é'.,!|#01 \n\t", " ", "  ", "'s", "<|endoftext|>", "　", "Σ", "ß", "é", "\x00", "the", "ing"])


def ids_of(path, text):
    return LIBRARY[path].encode(text or "", add_special_tokens=False).ids


def raw(ids):
    return np.array(ids, "<u4").tobytes()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(ALPHABET, max_size=25).map("".join), max_size=6))
def test_memo_gives_the_librarys_ids(texts):
    for path in (WORD, BYTE):
        flat, ends = tokens.library_memo(path).ids(pa.array(texts, pa.string()))
        assert [flat[a:b].tolist() for a, b in zip(ends, ends[1:])] == [ids_of(path, t) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(ALPHABET, max_size=40).map("".join))
def test_codec_gives_the_librarys_ids_and_text(text):
    own = codec(WORD)[0]
    assert own.encode(text) == ids_of(WORD, text)
    assert own.decode(own.encode(text)).decode() == LIBRARY[WORD].decode(ids_of(WORD, text), skip_special_tokens=False)


def test_long_words_take_the_heap_and_agree():
    own = BpeCodec(WORD)
    word = ("thering" * 60 + "xqz").encode()
    assert own.merge(word) == ids_of(WORD, word.decode())


def test_codec_over_odd_rows(documents, odd_rows):
    rows = bpe_decode(bpe_encode(documents(odd_rows), WORD), WORD).collect()
    want = [(i, len(ids_of(WORD, t)), raw(ids_of(WORD, t)), LIBRARY[WORD].decode(ids_of(WORD, t), skip_special_tokens=False)) for i, t in odd_rows]
    key = repr
    assert sorted(((r.doc_id, r.n_tokens, bytes(r.ids), r.decoded) for r in rows), key=key) == sorted(want, key=key)
    assert bpe_decode(bpe_encode(documents([]), WORD), WORD).count() == 0


def test_counts_come_from_the_cache(spark, documents, odd_rows, tmp_path):
    cache = str(tmp_path / "cache")
    want = sorted([(i, len((t or "").encode()), len(ids_of(WORD, t))) for i, t in odd_rows], key=repr)
    for _ in range(2):
        rows = token_counts.token_counts(documents(odd_rows), WORD, cache).collect()
        assert sorted([(r.doc_id, r.n_bytes, r.n_tokens) for r in rows], key=repr) == want
    stored = spark.read.parquet(cache)
    assert stored.count() == stored.select("content").distinct().count() < len(odd_rows)
    more = [*odd_rows, (99, "not seen before")]
    assert token_counts.token_counts(documents(more), WORD, cache).count() == len(more)
    assert spark.read.parquet(cache).count() == stored.count() + 1
    assert token_counts.token_counts(documents([]), WORD, str(tmp_path / "none")).count() == 0


def test_token_files_round_trip(documents, odd_rows):
    files = token_files.write_token_files(documents(odd_rows), BYTE, end_id=0)
    rows = sorted(token_files.read_token_files(files).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted((i for i, _ in odd_rows), key=lambda i: (i is not None, i or 0))
    assert sorted((r.doc_id or 0, bytes(r.ids)) for r in rows) == sorted((i or 0, raw([*ids_of(BYTE, t), 0])) for i, t in odd_rows)
    at = 0
    for row in rows:
        assert (row.start, row.n_tokens) == (at, len(row.ids) // 4)
        at += row.n_tokens
    # Any record alone, by the index.
    file = files.manifest.orderBy("part").first()
    store = fs.LocalFileSystem()
    with store.open_input_stream(file["index"]) as stream:
        index = np.frombuffer(stream.read(), "<i8").reshape(-1, 4)
    last = index[-1]
    assert len(token_files.read_record(store, file["data"], int(last[2]))) == 2 * last[3]
    assert token_files.read_token_files(token_files.write_token_files(documents([]), BYTE, 0)).count() == 0


def test_a_damaged_record_is_noticed(documents):
    files = token_files.write_token_files(documents([(1, "some words")]), BYTE, end_id=0)
    path = files.manifest.first()["data"]
    data = bytearray(open(path, "rb").read())
    data[14] ^= 1
    open(path, "wb").write(bytes(data))
    with pytest.raises(ValueError, match="damaged"):
        token_files.read_record(fs.LocalFileSystem(), path, 0)
    assert token_files.masked(b"123456789") == ((0xCBF43926 >> 15 | 0xCBF43926 << 17) + 0xA282EAD8) & 0xFFFFFFFF


def one_by_one(lengths, window):
    """Best-fit decreasing, piece by piece: the fill of each window."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= n]
        room = min(fits, default=window)
        if fits:
            rooms.remove(room)
        rooms.append(room - n)
    return sorted(rooms)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 19), max_size=60))
def test_runs_are_best_fit_decreasing(lengths):
    counts = {n: lengths.count(n) for n in lengths}
    fill, seen = {}, {n: set() for n in counts}
    for length, rank, number, first, offset in packing.best_fit_decreasing(counts, 20):
        for k in range(number):
            fill.setdefault(first + k, []).append((offset, length))
            seen[length].add(rank + k)
    assert all(s == set(range(counts[n])) for n, s in seen.items())
    for pieces in fill.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
    assert sorted(20 - sum(n for _, n in p) for p in fill.values()) == one_by_one(lengths, 20)


def test_packed_pieces_are_the_documents(documents, odd_rows):
    many = [*odd_rows, *((100 + i, "one two three") for i in range(300))]
    rows = packing.packed_rows(documents(many), WORD, end_id=2).collect()
    want = sorted([zlib.crc32(raw([*ids_of(WORD, t), 2][s : s + 4096])) for _, t in many for s in range(0, len(ids_of(WORD, t)) + 1, 4096)])
    assert sorted(r.ids_crc32 for r in rows) == want
    windows = {}
    for r in rows:
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in windows.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 4096
    assert packing.packed_rows(documents([]), WORD, 2).count() == 0


def test_digest_of_the_tokenizer_file():
    assert token_counts.tokenizer_digest(WORD) == hashlib.sha256(open(WORD, "rb").read()).hexdigest()
