"""Records of writers' schemas read with a reader's: round trips, resolution, broken bytes."""

import json
import struct

import pytest
from pyspark.sql import functions as F

from tallyflow.functions.avro import EARLY, LATE, LONG, compatibility, conflicts, decode_avro, encode_avro, resolved

FLAT = {"type": "record", "name": "R", "fields": [{"name": "s", "type": "string"}, {"name": "i", "type": "int"}, {"name": "l", "type": "long"}, {"name": "f", "type": "float"}, {"name": "d", "type": "double"}, {"name": "b", "type": "boolean"}, {"name": "y", "type": "bytes"}, {"name": "u", "type": ["null", "string"]}, {"name": "e", "type": {"type": "enum", "name": "E", "symbols": ["A", "B"]}}]}


def record(*fields, name="R"):
    return json.dumps({"type": "record", "name": name, "fields": [{"name": n, "type": t, **more} for n, t, more in fields]})


def zigzag(n):
    z, out = (n << 1) ^ (n >> 63), bytearray()
    while z > 127:
        out.append(z & 127 | 128)
        z >>= 7
    return bytes([*out, z])


def text(s):
    return zigzag(len(s.encode())) + s.encode()


def decoded(spark, rows, reader):
    """Decoded (record, error) of (bytes, writer's schema)."""
    df = spark.createDataFrame([(i, None if b is None else bytearray(b), w) for i, (b, w) in enumerate(rows)], "i long, b binary, w string").repartition(2)
    out = df.select("i", decode_avro(F.col("b"), F.col("w"), reader).alias("x")).select("i", "x.record", "x.error").orderBy("i").collect()
    return [(r.record, r.error) for r in out]


def test_round_trip(spark):
    rows = [("x" * 200, -5, 2**62, 1.5, -0.1, True, bytearray(b"\x00\xff"), None, "B"), ("é", 2**31 - 1, -(2**63), float("inf"), 1e300, False, bytearray(b""), "", "A"), ("", 0, 0, 0.0, 0.0, False, bytearray(b"z"), "u", "A")]
    df = spark.createDataFrame(rows, "s string, i int, l long, f float, d double, b boolean, y binary, u string, e string")
    out = df.select("*", decode_avro(encode_avro(F.struct("*"), json.dumps(FLAT)), F.lit(json.dumps(FLAT)), json.dumps(FLAT)).alias("x")).select(*df.columns, "x.record", "x.error").collect()
    assert all(r.error is None and tuple(r.record) == tuple(r)[:9] for r in out) and len(out) == 3
    bad = df.select(encode_avro(F.struct(F.lit(None).cast("string").alias("s"), *df.columns[1:]), json.dumps(FLAT)).alias("v")).collect()
    assert [r.v for r in bad] == [None] * 3
    first = df.limit(1).select(encode_avro(F.struct("*"), json.dumps(FLAT))).first()[0]
    assert bytes(first) == text("x" * 200) + zigzag(-5) + zigzag(2**62) + struct.pack("<fd", 1.5, -0.1) + b"\x01" + zigzag(2) + b"\x00\xff" + zigzag(0) + zigzag(1)


def test_two_writers_one_reader(spark):
    reader = record(("id", "string", {}), ("price", "double", {}), ("currency", "string", {"default": "EUR"}), ("note", ["null", "string"], {"default": None}))
    one = record(("id", "string", {}), ("price", "float", {}))
    two = record(("extra", {"type": "array", "items": "int"}, {}), ("price", "int", {}), ("note", "string", {}), ("id", "string", {}), ("currency", "string", {}))
    retyped = record(("id", "string", {}), ("price", "string", {}))
    missing = record(("price", "float", {}))
    rows = [(text("a") + struct.pack("<f", 2.5), one), (zigzag(2) + zigzag(7) + zigzag(8) + zigzag(0) + zigzag(3) + text("n") + text("b") + text("LKR"), two), (text("a") + text("x"), retyped), (struct.pack("<f", 1), missing), (None, one), (text("a"), "no json"), (text("a"), None)]
    got = decoded(spark, rows, reader)
    assert [tuple(r) if r else r for r, _ in got] == [("a", 2.5, "EUR", None), ("b", 3.0, "LKR", "n"), None, None, None, None, None]
    assert [e for _, e in got[:5]] == [None, None, "price: string cannot be read as double", "id: missing without default", None]
    assert got[5][1].startswith("bad schema") and got[6][1] is None


def test_broken_bytes(spark):
    w = record(("s", "string", {}), ("i", "int", {}), ("u", ["null", "long"], {}))
    good = text("ab") + zigzag(5) + zigzag(1) + zigzag(9)
    rows = [good, good[:-1], good[:1], b"", good + b"\x00", zigzag(-3) + b"abc", zigzag(2**40), text("a") + zigzag(2**33) + zigzag(0), text("a") + zigzag(1) + zigzag(7), b"\xff" * 12, zigzag(2) + b"\xff\xfe" + zigzag(1) + zigzag(0)]
    got = decoded(spark, [(b, w) for b in rows], w)
    assert [e for _, e in got] == [None, EARLY, EARLY, EARLY, LATE, LONG, EARLY, LONG, "a union has no such branch", LONG, None]
    assert tuple(got[0][0]) == ("ab", 5, 9) and got[10][0].s == "��" and all(r is None for r, e in got if e)


def test_nested_types(spark):
    point = {"type": "record", "name": "P", "namespace": "n", "fields": [{"name": "x", "type": "int"}]}
    w = json.dumps({"type": "record", "name": "W", "namespace": "n", "fields": [{"name": "a", "type": {"type": "array", "items": point}}, {"name": "m", "type": {"type": "map", "values": ["null", "string"]}}, {"name": "p", "type": "P"}, {"name": "f", "type": {"type": "fixed", "name": "F", "size": 2}}]})
    body = lambda xs, m: b"".join([*(zigzag(len(xs)) + b"".join(map(zigzag, xs)) if xs else b"",), zigzag(0), *(zigzag(-len(m)) + zigzag(9) + b"".join(text(k) + (zigzag(0) if v is None else zigzag(1) + text(v)) for k, v in m.items()) if m else b"",), zigzag(0), zigzag(4), b"ab"])
    cases = [([1, 2, 3], {"k": "v", "n": None}), ([], {}), ([-9], {"z": ""})]
    got = decoded(spark, [(body(*c), w) for c in cases] + [(zigzag(1 << 30), w)], w)
    assert [([p.x for p in r.a], r.m, r.p.x, bytes(r.f)) for r, e in got[:3] if e is None] == [(xs, m, 4, b"ab") for xs, m in cases]
    assert got[3] == (None, EARLY)
    with pytest.raises(ValueError, match="recursive"):
        resolved({"type": "record", "name": "L", "fields": [{"name": "next", "type": ["null", "L"]}]})


def test_verdicts(spark):
    base = record(("orderId", "string", {}), ("product", "string", {}), ("price", "float", {}), name="Order")
    proposals = {
        "defaulted": (record(("orderId", "string", {}), ("product", "string", {}), ("price", "float", {}), ("currency", "string", {"default": "EUR"}), name="Order"), ""),
        "required": (record(("orderId", "string", {}), ("product", "string", {}), ("price", "float", {}), ("customerId", "string", {}), name="Order"), "customerId: missing without default"),
        "retyped": (record(("orderId", "string", {}), ("product", "string", {}), ("price", "string", {}), name="Order"), "price: float cannot be read as string"),
        "dropped": (record(("orderId", "string", {}), name="Order"), ""),
        "promoted": (record(("orderId", "string", {}), ("price", "double", {}), name="Order"), ""),
        "renamed": (record(("orderId", "string", {}), ("cost", "float", {"aliases": ["price"]}), name="Order"), ""),
    }
    df = spark.createDataFrame([(k, base, p) for k, (p, _) in proposals.items()], "label string, written string, proposed string")
    got = {r.label: (r.accepted, r.detail) for r in compatibility(df).collect()}
    assert got == {k: (d == "", d) for k, (_, d) in proposals.items()}
    assert conflicts({"type": "enum", "name": "E", "symbols": ["A", "C"]}, {"type": "enum", "name": "E", "symbols": ["A"]}) == ["record: symbols C are unknown"]
    assert conflicts(["null", "int"], "int") == ["record: null cannot be read as int"] and conflicts("int", ["null", "long"]) == []
