"""Avro records by Arrow: bytes of a writer's schema to columns of a reader's, and columns to bytes.

Fields are read one after the other for all values of a batch at once; every value has a place up to which it has been read, and
an error once something in it cannot be.
"""

from __future__ import annotations

import json
from functools import cache

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Names of the types, and those that a type may be read as.
PRIMITIVE = {"null": T.NullType(), "boolean": T.BooleanType(), "int": T.IntegerType(), "long": T.LongType(), "float": T.FloatType(), "double": T.DoubleType(), "bytes": T.BinaryType(), "string": T.StringType()}
PROMOTED = {"int": ("long", "float", "double"), "long": ("float", "double"), "float": ("double",), "string": ("bytes",), "bytes": ("string",)}
EARLY, LONG, LATE = "payload ends before the record does", "a length or number is out of range", "bytes follow the record"


def kind_of(schema) -> str:
    return "union" if isinstance(schema, list) else schema if isinstance(schema, str) else schema["type"] if isinstance(schema["type"], str) else kind_of(schema["type"])


def resolved(schema, names: dict | None = None, space: str = ""):
    """The schema with names of records, enums and fixed types replaced by what they stand for, and types spelled one way."""
    names = {} if names is None else names
    if isinstance(schema, list):
        return [resolved(s, names, space) for s in schema]
    if isinstance(schema, str):
        if schema in PRIMITIVE:
            return schema
        full = schema if "." in schema or not space else f"{space}.{schema}"
        if names.get(full, names.get(schema)) is None:
            raise ValueError(f"unknown or recursive type {schema}")
        return names.get(full, names.get(schema))
    kind = schema["type"]
    if isinstance(kind, (dict, list)):
        return resolved(kind, names, space)
    if kind in PRIMITIVE:
        return kind
    if kind in ("array", "map"):
        inner = "items" if kind == "array" else "values"
        return {"type": kind, inner: resolved(schema[inner], names, space)}
    if kind not in ("record", "enum", "fixed"):
        return resolved(kind, names, space)
    space = schema.get("namespace", space)
    full = schema["name"] if "." in schema["name"] or not space else f"{space}.{schema['name']}"
    out = dict(schema)
    names[full] = None  # recursive types have no columns
    if kind == "record":
        out["fields"] = [dict(f) | {"type": resolved(f["type"], names, space)} for f in schema["fields"]]
    names[full] = out
    return out


def conflicts(writer, reader, path: str = "") -> list[str]:
    """Why data of the writer's schema cannot be read with the reader's, field by field; empty if it can."""
    w, r = kind_of(writer), kind_of(reader)
    at = path or "record"
    if w == "union":
        return [c for s in writer for c in (min((conflicts(s, t, path) for t in reader), key=len)[:1] if r == "union" else conflicts(s, reader, path))]
    if r == "union":
        return min((conflicts(writer, t, path) for t in reader), key=len)[:1]
    if w != r:
        return [] if r in PROMOTED.get(w, ()) else [f"{at}: {w} cannot be read as {r}"]
    if w in ("array", "map"):
        inner = "items" if w == "array" else "values"
        return conflicts(writer[inner], reader[inner], f"{at}[]")
    if w == "fixed":
        return [] if writer["size"] == reader["size"] else [f"{at}: fixed sizes differ"]
    if w == "enum":
        lost = [s for s in writer["symbols"] if s not in reader["symbols"]]
        return [] if not lost or "default" in reader else [f"{at}: symbols {', '.join(lost)} are unknown"]
    if w == "record":
        given = {f["name"]: f["type"] for f in writer["fields"]}
        out = []
        for f in reader["fields"]:
            name = next((n for n in (f["name"], *f.get("aliases", ())) if n in given), None)
            here = f"{path}.{f['name']}" if path else f["name"]
            if name is None and "default" not in f:
                out.append(f"{here}: missing without default")
            elif name is not None:
                out += conflicts(given[name], f["type"], here)
        return out
    return []


def spark_type(schema) -> T.DataType:
    """The column type of a schema: unions with null are nullable columns, other unions of several types are texts."""
    kind = kind_of(schema)
    if kind == "union":
        some = [s for s in schema if s != "null"]
        return T.NullType() if not some else spark_type(some[0]) if len(some) == 1 else T.StringType()
    if kind == "array":
        return T.ArrayType(spark_type(schema["items"]))
    if kind == "map":
        return T.MapType(T.StringType(), spark_type(schema["values"]))
    if kind == "record":
        return T.StructType([T.StructField(f["name"], spark_type(f["type"])) for f in schema["fields"]])
    return T.BinaryType() if kind == "fixed" else T.StringType() if kind == "enum" else PRIMITIVE[kind]


class _Reader:
    """The bytes of a batch's values, each with a place and an error."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        self.data, self.at, self.ends = np.concatenate([data, np.zeros(16, np.uint8)]), starts.astype(np.int64), ends.astype(np.int64)
        self.error = np.full(len(starts), None, object)

    def fail(self, rows: np.ndarray, why: str) -> None:
        fresh = rows[self.error[rows] == None]  # noqa: E711
        self.error[fresh] = why
        self.at[rows] = self.ends[rows]

    def take(self, rows: np.ndarray, n) -> np.ndarray:
        """Goes ``n`` bytes on; the places before, of rows that have them (others fail)."""
        n = np.broadcast_to(np.asarray(n, np.int64), rows.shape)
        before = self.at[rows]
        good = (n >= 0) & (n <= self.ends[rows] - before)
        self.fail(rows[~good & (n >= 0)], EARLY)
        self.fail(rows[n < 0], LONG)
        self.at[rows[good]] += n[good]
        return np.where(good, before, -1)

    def number(self, rows: np.ndarray) -> np.ndarray:
        """Zig-zag variable-length numbers; 0 where there is none."""
        out, open_, shift = np.zeros(len(rows), np.uint64), np.arange(len(rows)), 0
        while len(open_):
            if shift > 63:
                self.fail(rows[open_], LONG)
                out[open_] = 0
                break
            places = self.take(rows[open_], 1)
            good = places >= 0
            byte = np.where(good, self.data[np.maximum(places, 0)], 0).astype(np.uint64)
            out[open_] |= (byte & np.uint64(127)) << np.uint64(shift)
            open_ = open_[good & (byte > 127)]
            shift += 7
        return (out >> np.uint64(1)).astype(np.int64) ^ -(out & np.uint64(1)).astype(np.int64)

    def plain(self, rows: np.ndarray, dtype: str) -> np.ndarray:
        width = np.dtype(dtype).itemsize
        places = np.maximum(self.take(rows, width), 0)
        return np.ascontiguousarray(self.data[places[:, None] + np.arange(width)]).view(dtype)[:, 0]

    def strings(self, rows: np.ndarray, length: np.ndarray, text: bool):
        """An Arrow array of the next ``length`` bytes of each row; what is no UTF-8 in a text is replaced."""
        import pyarrow as pa
        import pyarrow.compute as pc

        places = self.take(rows, length)
        n = np.where(places >= 0, length, 0)
        offsets = np.concatenate([[0], np.cumsum(n)])
        index = np.arange(offsets[-1]) + np.repeat(np.maximum(places, 0) - offsets[:-1], n)
        raw = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(rows), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(self.data[index])])
        if not text:
            return raw.cast(pa.binary())
        try:
            return pc.cast(raw, pa.large_string()).cast(pa.string())
        except pa.ArrowInvalid:
            return pa.array([x.decode(errors="replace") for x in raw.to_pylist()], pa.string())


def _none(n: int, kind):
    import pyarrow as pa

    return pa.nulls(n, kind)


def _arrow(schema):
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(spark_type(schema))


def _constant(value, schema, n: int):
    """n times a default of the reader's schema."""
    import pyarrow as pa

    def typed(v, s):
        kind = kind_of(s)
        if kind == "union":
            return None if v is None else typed(v, next(t for t in s if t != "null"))
        if kind in ("bytes", "fixed"):
            return v.encode("latin-1")
        if kind == "record":
            return {f["name"]: typed(v[f["name"]] if f["name"] in v else f["default"], f["type"]) for f in s["fields"]}
        if kind == "array":
            return [typed(x, s["items"]) for x in v]
        return [(k, typed(x, s["values"])) for k, x in v.items()] if kind == "map" else v

    return pa.array([typed(value, schema)], _arrow(schema)).take(pa.array(np.zeros(n, np.int64)))


def _scattered(parts: list, n: int, kind):
    """An array of length n from (places, values) of its parts; null elsewhere."""
    import pyarrow as pa

    parts = [(places, values) for places, values in parts if len(places)]
    if not parts:
        return _none(n, kind)
    index = np.full(n, -1, np.int64)
    index[np.concatenate([p for p, _ in parts])] = np.arange(sum(len(p) for p, _ in parts))
    values = pa.chunked_array([v.cast(kind) for _, v in parts]).combine_chunks()
    return values.take(pa.array(index, mask=index < 0))


def _read(r: _Reader, rows: np.ndarray, writer, reader):
    """The values of the rows' next field, as an Arrow array of the reader's type; ``reader`` None: they are only passed over."""
    import pyarrow as pa

    w = kind_of(writer)
    if w == "union":
        branch = r.number(rows)
        wrong = (branch < 0) | (branch >= len(writer))
        r.fail(rows[wrong], "a union has no such branch")
        parts = []
        for i, s in enumerate(writer):
            mine = np.flatnonzero(branch == i)
            if len(mine):
                parts.append((mine, _read(r, rows[mine], s, reader)))
        return None if reader is None else _scattered(parts, len(rows), _arrow(reader))
    if isinstance(reader, list):
        fit = next((s for s in reader if kind_of(s) == w and not conflicts(writer, s)), None) or next((s for s in reader if not conflicts(writer, s)), None)
        values = _read(r, rows, writer, fit)
        kind = _arrow(reader)
        return _none(len(rows), kind) if fit is None or fit == "null" else pa.array([None if v is None else str(v) for v in values.to_pylist()], kind) if pa.types.is_string(kind) and not pa.types.is_string(values.type) else values
    if w == "record":
        wanted = {} if reader is None else {n: f for f in reader["fields"] for n in (f["name"], *f.get("aliases", ())) if any(g["name"] == n for g in writer["fields"])}
        found = {}
        for f in writer["fields"]:
            target = wanted.get(f["name"])
            values = _read(r, rows, f["type"], target["type"] if target else None)
            if target:
                found[target["name"]] = values
        if reader is None:
            return None
        columns = [found[f["name"]] if f["name"] in found else _constant(f["default"], f["type"], len(rows)) for f in reader["fields"]]
        return pa.StructArray.from_arrays(columns, fields=list(_arrow(reader)))
    if w in ("array", "map"):
        return _read_blocks(r, rows, writer, reader)
    if w in ("string", "bytes"):
        values = r.strings(rows, r.number(rows), reader == "string")
    elif w == "fixed":
        values = r.strings(rows, np.full(len(rows), writer["size"]), False)
    elif w == "enum":
        number = r.number(rows)
        r.fail(rows[(number < 0) | (number >= len(writer["symbols"]))], "an enum has no such symbol")
        known = [s if reader is None or s in reader["symbols"] else reader.get("default") for s in writer["symbols"]]
        values = pa.array(known, pa.string()).take(pa.array(np.clip(number, 0, len(known) - 1)))
    elif w == "null":
        values = _none(len(rows), pa.null())
    elif w == "boolean":
        values = pa.array(r.plain(rows, "u1") != 0)
    elif w in ("float", "double"):
        values = pa.array(r.plain(rows, "<f4" if w == "float" else "<f8"))
    else:
        number = r.number(rows)
        if w == "int":
            r.fail(rows[(number < -(1 << 31)) | (number >= 1 << 31)], LONG)
            number = np.where((number < -(1 << 31)) | (number >= 1 << 31), 0, number)
        values = pa.array(number.astype(np.dtype(_arrow(reader).to_pandas_dtype())) if reader is not None and reader != w else number)
    return None if reader is None else values.cast(_arrow(reader))


def _read_blocks(r: _Reader, rows: np.ndarray, writer, reader):
    """Arrays and maps: one item of every row that has more at a time."""
    import pyarrow as pa

    is_map = kind_of(writer) == "map"
    inner = writer["values" if is_map else "items"]
    target = None if reader is None else reader["values" if is_map else "items"]
    left = np.zeros(len(rows), np.int64)
    over = np.zeros(len(rows), bool)
    keys, items, owners = [], [], []
    while True:
        asking = np.flatnonzero(~over & (left == 0))
        if len(asking):
            n = r.number(rows[asking])
            sized = asking[n < 0]
            if len(sized):
                r.number(rows[sized])  # the block's bytes
            n = np.abs(n)
            bad = n > r.ends[rows[asking]] - r.at[rows[asking]] if inner != "null" else n > 1 << 20
            r.fail(rows[asking[bad]], EARLY)
            left[asking] = np.where(bad, 0, n)
            over[asking] = (n == 0) | bad
        some = np.flatnonzero(left > 0)
        some = some[r.error[rows[some]] == None]  # noqa: E711
        over |= (r.error[rows] != None)  # noqa: E711
        if not len(some):
            if over.all():
                break
            left[over] = 0
            continue
        if is_map:
            keys.append(r.strings(rows[some], r.number(rows[some]), True))
        items.append(_read(r, rows[some], inner, target))
        owners.append(some)
        left[some] -= 1
    if reader is None:
        return None
    kind = _arrow(reader)
    if not owners:
        return pa.array([[]] * len(rows), kind)
    owner = np.concatenate(owners)
    order = pa.array(np.argsort(owner, kind="stable"))
    offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(rows)))]).astype(np.int32))
    values = pa.chunked_array(items).combine_chunks().take(order)
    if not is_map:
        return pa.ListArray.from_arrays(offsets, values).cast(kind)
    return pa.MapArray.from_arrays(offsets, pa.chunked_array(keys).combine_chunks().take(order).fill_null(""), values).cast(kind)


@cache
def _parsed(text: str):
    return resolved(json.loads(text))


def _decoded(values, writer: str, reader: str):
    """(struct array, errors) of an Arrow array of records of one schema."""
    import pyarrow as pa

    target = _parsed(reader)
    try:
        source = _parsed(writer)
        problems = conflicts(source, target)
    except (ValueError, KeyError, TypeError) as e:
        problems = [f"bad schema: {e}"]
    if problems:
        return _none(len(values), _arrow(target)), pa.array(["; ".join(problems)] * len(values), pa.string())
    raw = values.fill_null(b"").cast(pa.large_binary())
    _, offsets, data = raw.buffers()
    offsets = np.frombuffer(offsets, np.int64)[raw.offset : raw.offset + len(raw) + 1]
    r = _Reader(np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), offsets[:-1], offsets[1:])
    rows = np.arange(len(raw))
    out = _read(r, rows, source, target)
    r.fail(rows[r.at < r.ends], LATE)
    good = pa.array(np.array([x is None for x in r.error], bool))
    return _scattered([(np.flatnonzero(good), out.filter(good))], len(raw), out.type), pa.array(r.error.tolist(), pa.string())


def decode_avro(body: Column, writer: Column, reader: str) -> Column:
    """Struct (record, error) of ``body``, bytes of a record of the schema (JSON) in ``writer``, as the reader's schema has it.

    Fields of the writer that the reader lacks are passed over, those that only the reader has take their defaults, numbers are
    promoted; what cannot be resolved is the error of all records of that writer. A record is null where there is an error, bytes
    that end early, go on, or hold what the schema does not allow. Null bytes or schemas give null and no error.
    """
    from pyspark.sql.functions import arrow_udf

    kind = T.StructType([T.StructField("record", spark_type(_parsed(reader))), T.StructField("error", T.StringType())])

    def run(values, schemas):
        import pyarrow as pa
        import pyarrow.compute as pc

        record = _arrow(_parsed(reader))
        codes = schemas.dictionary_encode()
        parts, errors = [], []
        known = pc.and_(values.is_valid(), schemas.is_valid()).to_numpy(zero_copy_only=False)
        index = codes.indices.fill_null(-1).to_numpy(zero_copy_only=False)
        for i, schema in enumerate(codes.dictionary.to_pylist()):
            mine = np.flatnonzero((index == i) & known)
            out, error = _decoded(values.take(pa.array(mine)), schema, reader)
            parts.append((mine, out))
            errors.append((mine, error))
        n = len(values)
        return pa.StructArray.from_arrays([_scattered(parts, n, record), _scattered(errors, n, pa.string())], fields=[pa.field("record", record), pa.field("error", pa.string())])

    return arrow_udf(run, kind)(body, writer)


def _varints(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Zig-zag bytes of whole numbers, (rows, 10), and how many each has."""
    z = (n.astype(np.int64) << 1 ^ n.astype(np.int64) >> 63).view(np.uint64)
    groups = (z[:, None] >> (np.arange(10, dtype=np.uint64) * np.uint64(7))) & np.uint64(127)
    size = 1 + np.sum(z[:, None] >= np.uint64(1) << np.arange(7, 64, 7, dtype=np.uint64), axis=1)
    return (groups | np.where(np.arange(10) < size[:, None] - 1, 128, 0).astype(np.uint64)).astype(np.uint8), size


def _binary(rows: np.ndarray, size: np.ndarray):
    import pyarrow as pa

    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows[np.arange(rows.shape[1]) < size[:, None]]))])


def _written(values, schema):
    """An Arrow array of the bytes of each value; null where a value is that the schema does not allow."""
    import pyarrow as pa
    import pyarrow.compute as pc

    kind = kind_of(schema)
    joined = lambda *parts: pc.binary_join_element_wise(*parts, pa.scalar(b"", pa.binary()))
    numbers = lambda x: _binary(*_varints(np.asarray(x, np.int64)))
    if kind == "union":
        some = next(s for s in schema if s != "null")
        present = joined(numbers(np.full(len(values), schema.index(some))), _written(values, some))
        return pc.if_else(values.is_valid(), present, _binary(*_varints(np.array([schema.index("null")]))).take(pa.array(np.zeros(len(values), np.int64)))) if "null" in schema else present
    if kind == "record":
        return joined(*[_written(pc.struct_field(values, i), f["type"]) for i, f in enumerate(schema["fields"])])
    if kind in ("string", "bytes", "fixed"):
        raw = values.cast(pa.binary())
        if kind == "fixed":
            return pc.if_else(pc.equal(pc.binary_length(raw), schema["size"]), raw, pa.scalar(None, pa.binary()))
        return joined(numbers(pc.binary_length(raw).fill_null(0).to_numpy(zero_copy_only=False)), raw)
    fixed = {"float": "<f4", "double": "<f8", "boolean": "u1"}.get(kind)
    if kind == "enum":
        body = numbers(pc.index_in(values, pa.array(schema["symbols"])).fill_null(0).to_numpy(zero_copy_only=False))
        return pc.if_else(pc.is_in(values, pa.array(schema["symbols"])), body, pa.scalar(None, pa.binary()))
    if kind in ("array", "map"):
        raise ValueError("records with arrays or maps are read, not written")
    x = values.fill_null(False if kind == "boolean" else 0).to_numpy(zero_copy_only=False)
    body = _binary(np.ascontiguousarray(x.astype(fixed)).view(np.uint8).reshape(len(x), -1), np.full(len(x), np.dtype(fixed).itemsize)) if fixed else numbers(x)
    return pc.if_else(values.is_valid(), body, pa.scalar(None, pa.binary()))


def encode_avro(record: Column, schema: str) -> Column:
    """Bytes of a struct column as a record of the schema (JSON), field by field in order; null where a field has a value that the schema does not allow."""
    from pyspark.sql.functions import arrow_udf

    kind = spark_type(_parsed(schema))
    return arrow_udf(lambda values: _written(values, _parsed(schema)), T.BinaryType())(record.cast(kind))


def compatibility(proposals, subjects: str = "subject", written: str = "written", proposed: str = "proposed"):
    """``proposals`` (a DataFrame with the schema that a subject's records were written with, and a proposed one, as JSON) with accepted and detail: whether readers of the proposed schema can read the records, and every reason why not."""
    def verdicts(old, new):
        import pyarrow as pa

        out = []
        for w, r in zip(old.to_pylist(), new.to_pylist(), strict=True):
            try:
                out.append("; ".join(conflicts(_parsed(w), _parsed(r))))
            except (ValueError, KeyError, TypeError) as e:
                out.append(f"bad schema: {e}")
        return pa.array(out, pa.string())

    from pyspark.sql.functions import arrow_udf

    detail = arrow_udf(verdicts, T.StringType())(F.col(written), F.col(proposed))
    return proposals.withColumn("detail", detail).withColumn("accepted", F.col("detail") == "")
