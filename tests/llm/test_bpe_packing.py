import hashlib
import random
import struct
import zlib
from collections import defaultdict

import public_tokenizers
import pytest
import tiktoken
from helpers import table, texts
from tokenizers import Tokenizer

from tallyforge.llm import byte_bpe, packing, units

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=units.read_ranks(RANKS), special_tokens={})


def ids_of(packed):
    return list(struct.unpack(f"<{len(packed) // 4}I", packed))


def test_encoder_equals_the_rank_library_on_odd_texts(reference):
    rng = random.Random(7)
    parts = [*"abc  \n\t'sSé  😀0९!?_ß\x00\x1c\x85", " 's", "'ll", "\r\n", " \n ", "<|endoftext|>"]
    odd = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(5000)]
    for got, text in zip(units.encoder_of(RANKS, public_tokenizers.PATTERN)(odd), odd):
        assert ids_of(got) == reference.encode_ordinary(text), text


def test_forgetting_units_changes_nothing(reference, monkeypatch):
    monkeypatch.setattr(units, "REMEMBERED", 5)
    encoder = units.Encoder(units.tokenizer_of_file(VOCABULARY), units.bytes_of_ids(VOCABULARY))
    for text in ["one two three four five six seven", "two eight nine one", "six one two"] * 3:
        assert ids_of(encoder([text])[0]) == reference.encode_ordinary(text)


def test_encode_offsets_and_decode(spark, reference):
    rows = byte_bpe.decode(byte_bpe.encode(table(spark), RANKS), RANKS).collect()
    assert len(rows) == len(texts())
    expected = defaultdict(list)
    for i, text in texts():
        expected[i].append(text or "")
    for row in rows:
        text = row.decoded.decode()
        assert text in expected[row.doc_id]
        assert ids_of(row.ids) == reference.encode_ordinary(text)
        assert row.whole == text and row.head == b"" and row.tail == b""
        pieces = reference.decode_tokens_bytes(ids_of(row.ids))
        at = 0
        for piece, start, end in zip(pieces, ids_of(row.starts), ids_of(row.ends)):
            data = text.encode()
            assert start == len(data[:at].decode(errors="ignore"))
            at += len(piece)
            assert end == len(data[:at].decode(errors="ignore")) + (not _whole(data[:at]))


def _whole(data):
    try:
        data.decode()
        return True
    except UnicodeDecodeError:
        return False


def test_pieces_cut_inside_a_character_join_again():
    data = "a😀é".encode()
    for cut in range(len(data) + 1):
        parts = [byte_bpe.cut_ends(data[:cut]), byte_bpe.cut_ends(data[cut:])]
        assert b"".join(b"".join(part) for part in parts) == data
        for _, whole, _ in parts:
            whole.decode()


def test_empty_table(spark):
    empty = table(spark, [])
    assert byte_bpe.round_trip(empty, RANKS).count() == 0
    assert packing.packed(empty, VOCABULARY).count() == 0


def test_packing_places_every_id_once(spark):
    rows = packing.packed(table(spark), VOCABULARY).collect()
    tokenizer = Tokenizer.from_file(VOCABULARY)
    tokenizer.encode_special_tokens = True
    want = defaultdict(int)
    for i, text in texts():
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        want[i, hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).digest()] += len(ids)
    assert sum(r.length for r in rows) == sum(want.values())
    by_id = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for i, t in texts() if i}
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append(r)
        if r.doc_id:
            part = by_id[r.doc_id][r.start:r.start + r.length]
            assert (len(part), zlib.crc32(struct.pack(f"<{r.length}I", *part))) == (r.length, r.ids_crc32)
            assert r.doc_tokens == len(by_id[r.doc_id])
    for pieces in sequences.values():
        at = 0
        for piece in sorted(pieces, key=lambda p: p.offset):
            assert piece.offset == at
            at += piece.length
        assert at <= packing.CAPACITY
    assert len(sequences) <= sum(want.values()) / packing.CAPACITY + 4


@pytest.mark.parametrize("sizes, windows", [([8, 7, 6, 5, 4], 2), ([5, 5, 5, 5], 4), ([9, 1], 3), ([3], 1), ([2] * 50, 7)])
def test_differencing_balances(sizes, windows):
    sets = packing.differencing(sizes, windows)
    assert sorted(i for members in sets for i in members) == list(range(len(sizes)))
    sums = [sum(sizes[i] for i in members) for members in sets]
    assert max(sums) - min([*sums, *[0] * (windows - len(sums))]) <= max(sizes)


def test_window_count_rises_when_capacity_is_exceeded():
    assert len(packing.fitted([6, 6, 6], 10)) == 3
    rng = random.Random(3)
    sizes = [rng.randint(1, 512) for _ in range(500)]
    sets = packing.fitted(sizes, 2048)
    assert max(sum(sizes[i] for i in members) for members in sets) <= 2048
    assert len(sets) <= sum(sizes) / 2048 * 1.02 + 1


def test_sequences_hold_the_ids(spark):
    placed = packing.packed(table(spark), VOCABULARY, capacity=64, with_ids=True)
    rows = packing.sequences(placed, 64).collect()
    assert {len(r.ids) for r in rows} == {64 * 4} and all(r.used <= 64 for r in rows)
    assert sum(r.used for r in rows) == placed.agg({"length": "sum"}).first()[0]
