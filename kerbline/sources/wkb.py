"""Well-known binary geometry, whole Arrow batches at a time.

SQL cannot reinterpret bytes as doubles, so this is the one place where rows pass
through Python.  Numbers are read and written at all places of a batch at once,
through views of its bytes in both byte orders; coordinates go from one flat buffer
to another and never become Python objects.

A geometry is (kind, parts): a point and a line have one part, a multi-point one of a
single point each, a multi-line one per line, a polygon one per ring.

Defined results: null, empty, cut off or unsupported bytes are a null geometry, and so
are counts that reach beyond the bytes; bytes after the geometry are ignored; a line
without points has one empty part.  A null line is written as null, and so is a point
that does not have exactly one place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, types as T

# fixed values: geometry type codes
KINDS = {1: "Point", 2: "LineString", 3: "Polygon", 4: "MultiPoint", 5: "MultiLineString"}
CODES = {name: code for code, name in KINDS.items()}
# bytes that a part takes at least: a point's place, a ring's count, a whole point, a line's head
LEAST = np.array([0, 16, 16, 4, 21, 9])
POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
GEOMETRY = T.StructType([T.StructField("kind", T.StringType()), T.StructField("parts", T.ArrayType(T.ArrayType(POINT)))])


class _Numbers:
    """Numbers at any places of a byte buffer, aligned or not; ``big`` chooses the byte order of each."""

    def __init__(self, data: np.ndarray):
        self.data = data

    def _view(self, dtype: str) -> np.ndarray:
        return np.ndarray((len(self.data) - np.dtype(dtype).itemsize + 1,), dtype, self.data, strides=(1,))

    def get(self, kind: str, at: np.ndarray, big: np.ndarray) -> np.ndarray:
        out = self._view("<" + kind)[at].astype(kind)
        out[big] = self._view(">" + kind)[at[big]]
        return out

    def put(self, kind: str, at: np.ndarray, values: np.ndarray | int, big: bool) -> None:
        self._view((">" if big else "<") + kind)[at] = values


def _within(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... anew for each size."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _nested(num: _Numbers, rows: np.ndarray, at: np.ndarray, left: np.ndarray, end: np.ndarray, lines: np.ndarray,
            big: np.ndarray, ok: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """(row, first coordinate, points, byte order) of parts of unequal sizes: the first parts of all rows, then the second ones ...

    ``ok`` becomes false for rows whose parts reach beyond their bytes.
    """
    while len(rows):
        head = np.where(lines[rows], 9, 4)
        room = at + head <= end[rows]
        ok[rows[~room]] = False
        rows, at, left, head = rows[room], at[room], left[room], head[room]
        order = np.where(lines[rows], num.data[at] != 1, big[rows])
        n = num.get("u4", at + head - 4, order).astype(np.int64)
        first = at + head
        fits = first + 16 * n <= end[rows]
        ok[rows[~fits]] = False
        rows, first, n, left = rows[fits], first[fits], n[fits], left[fits] - 1
        yield rows, first, n, order[fits]
        more = left > 0
        rows, at, left = rows[more], (first + 16 * n)[more], left[more]


def decode_array(values: pa.Array) -> pa.StructArray:
    """Geometries of an array of binary values."""
    n_rows = len(values)
    valid = values.is_valid().to_numpy(zero_copy_only=False)
    values = pc.fill_null(values.cast(pa.large_binary()), b"")
    if n_rows:
        offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset:values.offset + n_rows + 1]
        raw = np.frombuffer(values.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    else:
        offsets, raw = np.zeros(1, np.int64), np.zeros(0, np.uint8)
    num = _Numbers(np.append(raw, np.zeros(16, np.uint8)))  # heads may be read past the end before they are checked
    start, end = offsets[:-1] - offsets[0], offsets[1:] - offsets[0]

    ok = valid & (end - start >= 5)
    big = num.data[start] != 1
    code = num.get("u4", start + 1, big).astype(np.int64) & 0xFF
    ok &= (code >= 1) & (code <= 5)
    code = np.where(ok, code, 1)
    single = code == 1
    count = np.where(single, 1, num.get("u4", start + 5, big)).astype(np.int64)
    at = start + np.where(single, 5, 9)
    ok &= at + LEAST[code] * count <= end

    flat = np.flatnonzero(ok & (code <= 2))
    multi = np.flatnonzero(ok & (code == 4))
    of = np.repeat(multi, count[multi])
    place = at[of] + 21 * _within(count[multi])
    parts = [(flat, at[flat], count[flat], big[flat]), (of, place + 5, np.ones(len(of), np.int64), num.data[place] != 1)]
    deep = np.flatnonzero(ok & ((code == 3) | (code == 5)) & (count > 0))
    parts += _nested(num, deep, at[deep], count[deep], end, code == 5, big, ok)
    row, first, n, order = (np.concatenate(p) for p in zip(*parts, strict=True))
    kept = np.flatnonzero(ok[row])
    kept = kept[np.argsort(row[kept], kind="stable")]
    row, first, n, order = row[kept], first[kept], n[kept], order[kept]

    place, order = np.repeat(first, n) + 16 * _within(n), np.repeat(order, n)
    kinds, lists = _arrow_geometry()
    xy = pa.StructArray.from_arrays([pa.array(num.get("f8", place, order)), pa.array(num.get("f8", place + 8, order))],
                                    fields=list(lists.value_type.value_type))
    inner = pa.ListArray.from_arrays(_offsets(n), xy, type=lists.value_type)
    outer = pa.ListArray.from_arrays(_offsets(np.bincount(row, minlength=n_rows)), inner, type=lists)
    names = pa.array([None, *KINDS.values()]).take(pa.array(code))
    return pa.StructArray.from_arrays([names, outer], fields=[kinds, pa.field("parts", lists)], mask=pa.array(~ok))


def _arrow_geometry() -> tuple[pa.Field, pa.ListType]:
    from pyspark.sql.pandas.types import to_arrow_type
    made = to_arrow_type(GEOMETRY)
    return made.field("kind"), made.field("parts").type


def _offsets(sizes: np.ndarray) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))


def parse(b: bytes | None) -> dict | None:
    """One geometry as {kind, parts}; anything malformed or unsupported is null."""
    return decode_array(pa.array([b], pa.binary()))[0].as_py()


def encode_array(lines: pa.Array, kind: str = "LineString", big: bool = False) -> pa.Array:
    """Binary geometries of one kind: from lists of points, or from lists of lines for multi-lines and polygons."""
    code, n_rows = CODES[kind], len(lines)
    valid = lines.is_valid().to_numpy(zero_copy_only=False)
    sizes = pc.fill_null(pc.list_value_length(lines), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lines.flatten()
    if kind == "Point":
        valid &= sizes == 1
        flat = flat.filter(pa.array(np.repeat(valid, sizes)))
        sizes = valid.astype(np.int64)
    if kind in ("Polygon", "MultiLineString"):
        points = pc.fill_null(pc.list_value_length(flat), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        row, flat = np.repeat(np.arange(n_rows), sizes), flat.flatten()
    elif kind == "MultiPoint":
        points, row = np.ones(len(flat), np.int64), np.repeat(np.arange(n_rows), sizes)
    else:  # one part a row
        row = np.flatnonzero(valid)
        points = sizes[row]
    row_head = 5 if kind in ("Point", "LineString") else 9
    part_head = {"Point": 0, "LineString": 4, "Polygon": 4, "MultiPoint": 5, "MultiLineString": 9}[kind]

    part_bytes = part_head + 16 * points
    heads = np.where(valid, row_head, 0)
    row_bytes = heads + np.bincount(row, weights=part_bytes, minlength=n_rows).astype(np.int64)
    start = np.cumsum(row_bytes) - row_bytes
    at = np.cumsum(heads)[row] + np.cumsum(part_bytes) - part_bytes
    num = _Numbers(np.zeros(int(row_bytes.sum()) + 8, np.uint8))
    written = start[valid]
    num.data[written] = 0 if big else 1
    num.put("u4", written + 1, code, big)
    if row_head == 9:
        num.put("u4", written + 5, sizes[valid], big)
    if part_head in (5, 9):
        num.data[at] = 0 if big else 1
        num.put("u4", at + 1, 1 if kind == "MultiPoint" else 2, big)
    if part_head in (4, 9):
        num.put("u4", at + part_head - 4, points, big)
    place = np.repeat(at + part_head, points) + 16 * _within(points)
    for i, axis in enumerate(("x", "y")):
        num.put("f8", place + 8 * i, flat.field(axis).to_numpy(zero_copy_only=False), big)
    return pa.Array.from_buffers(pa.binary(), n_rows, [pa.array(valid).buffers()[1], _offsets(row_bytes).buffers()[1], pa.py_buffer(num.data)])


def _with_column(df: DataFrame, column: str, out: str, kind: T.DataType, fn) -> DataFrame:
    schema = T.StructType(df.schema.fields + [T.StructField(out, kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = fn(batch.column(batch.schema.get_field_index(column)))
            yield pa.RecordBatch.from_arrays([*batch.columns, made], names=[*batch.schema.names, out])

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, column: str, out: str) -> DataFrame:
    """Add ``out`` struct(kind, parts) decoded from a binary column."""
    return _with_column(df, column, out, GEOMETRY, decode_array)


def encode(df: DataFrame, column: str, out: str, big_endian: bool = False, kind: str = "LineString") -> DataFrame:
    """Add ``out``: a column of points, or of lines for multi-lines and polygons, as binary geometries of one kind."""
    return _with_column(df, column, out, T.BinaryType(), lambda lines: encode_array(lines, kind, big_endian))
