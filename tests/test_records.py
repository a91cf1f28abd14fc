"""Record files: bytes as by hand, ranges that begin anywhere, broken records told by place."""

from __future__ import annotations

import random
import struct

import numpy as np
import pytest

from terrafield.sources import records as R


def crc_by_bits(data):
    reg = 0xFFFFFFFF
    for b in data:
        reg ^= b
        for _ in range(8):
            reg = (reg >> 1) ^ (0x82F63B78 if reg & 1 else 0)
    return reg ^ 0xFFFFFFFF


def test_checksums():
    assert R.crc32c([b"123456789"]).tolist() == [0xE3069283]  # the check value of CRC-32C
    rng = random.Random(1)
    messages = [rng.randbytes(rng.choice([0, 1, 3, 4, 5, 8, 40, 300])) for _ in range(60)]
    assert R.crc32c(messages).tolist() == [crc_by_bits(m) for m in messages]
    assert R.masked(np.array([0])).tolist() == [0xA282EAD8]


def test_bytes_equal_a_hand_made_record():
    message = bytes.fromhex("0a0f 0a0d 0a01 61 1208 1a06 0a04 01 ac02 05".replace(" ", ""))  # a: integers 1, 300, 5
    assert R.encode_example({"a": [1, 300, 5]}) == message
    floats = bytes.fromhex("0a0f 0a0d 0a01 62 1208 1206 0a04 0000c03f".replace(" ", ""))  # b: 1.5
    assert R.encode_example({"b": np.array([1.5])}) == floats
    text = bytes.fromhex("0a0d 0a0b 0a01 63 1206 0a04 0a02 6869".replace(" ", ""))  # c: hi
    assert R.encode_example({"c": "hi"}) == text
    mask = lambda c: struct.pack("<I", (((c >> 15 | c << 17) & 0xFFFFFFFF) + 0xA282EAD8) & 0xFFFFFFFF)
    head = struct.pack("<Q", len(message))
    assert R.frame([message]) == head + mask(crc_by_bits(head)) + message + mask(crc_by_bits(message))


def test_examples_come_back():
    example = {"i": [-1, 0, 2**40], "f": np.array([0.5, -2.0]), "s": "Straße", "b": b"\x00\xff", "n": None}
    got = R.decode_example(R.encode_example(example))
    assert got["i"] == [-1, 0, 2**40] and got["f"].tolist() == [0.5, -2.0] and got["s"] == ["Straße".encode()] and got["b"] == [b"\x00\xff"] and "n" not in got
    unpacked = R._field(1, R._field(1, R._field(1, b"k") + R._field(2, R._field(3, b"\x08\x05\x08\x07"))))
    assert R.decode_example(unpacked) == {"k": [5, 7]}
    with pytest.raises(ValueError, match="beyond"):
        R.decode_example(b"\x0a\x7f\x00")


ROWS = [(i, f"row {i}", [i * 0.5] * (i % 40), None if i % 7 == 0 else i / 4) for i in range(500)]
SCHEMA = "id bigint, name string, patch array<float>, v double"


@pytest.fixture
def folder(spark, tmp_path):
    path = f"file://{tmp_path}/records"
    assert R.write_examples(spark.createDataFrame(ROWS, SCHEMA).repartition(3), path) == len(ROWS)
    return path


@pytest.mark.parametrize("size", [97, 1000, 1 << 20])
def test_ranges(spark, folder, size):
    got = R.read_examples(spark, folder, SCHEMA, size).collect()
    assert sorted(map(tuple, got)) == sorted((i, n, list(map(float, p)), v) for i, n, p, v in ROWS)
    assert not [n for n in __import__("os").listdir(folder.removeprefix("file://")) if n.startswith("_")]


def test_broken_records_are_told(spark, folder):
    import glob

    file = sorted(glob.glob(folder.removeprefix("file://") + "/*.records"))[0]
    places = [(r.offset, len(r.data)) for r in R.read_records(spark, file).orderBy("offset").collect()]
    raw = bytearray(open(file, "rb").read())
    raw[places[3][0] + 12] ^= 1  # data
    raw[places[50][0]] ^= 1  # a length
    raw = raw[:-2]
    open(file, "wb").write(raw)
    for size in (150, 1 << 20):
        rows = R.read_records(spark, file, strict=False, range_bytes=size).collect()
        faults = {r.offset: r.fault for r in rows if r.fault}
        assert {places[3][0], places[50][0], places[-1][0]} >= set(faults) >= {places[3][0]} and (size < 1000 or len(faults) == 3)
        assert {r.offset for r in rows if not r.fault} == {o for k, (o, _) in enumerate(places) if k not in (3, 50, len(places) - 1)}
    with pytest.raises(Exception, match=f"offset {places[3][0]}: the data"):
        R.read_records(spark, file).collect()


def test_empty(spark, tmp_path):
    path = f"file://{tmp_path}/none"
    assert R.write_examples(spark.createDataFrame([], SCHEMA), path) == 0
    assert R.read_examples(spark, path, SCHEMA).count() == 0
