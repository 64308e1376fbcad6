"""Column-at-a-time Avro binary codec for one Arrow batch.

A batch holds many message bodies in one byte buffer. Instead of walking one
record after another, every body keeps a read position in a numpy array and
each schema field is read for all bodies at once, straight into Arrow arrays.
The loops below run over fields and array slots, never over rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from skytide.sources.avro_schema import LEGACY_SUFFIX

OK, CORRUPT, TRAILING = 0, 1, 2
ERRORS = {CORRUPT: "body does not match its schema", TRAILING: "bytes left over after the record"}

_NATURAL = {
    "null": pa.string(),
    "boolean": pa.bool_(),
    "int": pa.int32(),
    "long": pa.int64(),
    "float": pa.float32(),
    "double": pa.float64(),
    "bytes": pa.binary(),
    "string": pa.string(),
}

_NUMBERS = ("boolean", "int", "long", "float", "double")
_ZIGZAG = np.array([(b >> 1) ^ -(b & 1) for b in range(128)], dtype=np.int64)


def _kind(avro_type) -> str:
    return avro_type if isinstance(avro_type, str) else avro_type["type"]


def _fits(avro_type, target: pa.DataType) -> bool:
    """Whether a writer type can fill a target type of the same field name."""
    if isinstance(avro_type, list):
        branches = [b for b in avro_type if b != "null"]
        return not branches or _fits(branches[0], target)
    kind = _kind(avro_type)
    if kind == "record":
        return pa.types.is_struct(target)
    if kind == "array":
        return pa.types.is_list(target)
    if kind == "map":
        return pa.types.is_map(target)
    return not pa.types.is_nested(target)


def _spread(part: pa.Array, at: np.ndarray, n: int) -> pa.Array:
    """Place ``part`` at positions ``at`` of a null array of length ``n``."""
    if len(at) == n:
        return part
    take = np.zeros(n, dtype=np.int64)
    missing = np.ones(n, dtype=bool)
    take[at] = np.arange(len(at))
    missing[at] = False
    return part.take(pa.array(take, mask=missing))


# From this many items on, a block is read as one vector instead of slot by slot.
LONG_BLOCK = 512
WINDOW = 1 << 15


class BodyReader:
    """Read positions of the bodies in ``buf``; row i spans starts[i]..ends[i]."""

    def __init__(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        if buf.size < 16:
            buf = np.concatenate([buf, np.zeros(16, dtype=np.uint8)])
        self.buf = buf
        self.pos = starts.astype(np.int64)
        self.end = ends.astype(np.int64)
        self.status = np.zeros(len(starts), dtype=np.int8)
        # Unaligned views with a one-byte stride: element i starts at byte i.
        self._f8 = np.ndarray((buf.size - 7,), dtype="<f8", buffer=buf, strides=(1,))
        self._f4 = np.ndarray((buf.size - 3,), dtype="<f4", buffer=buf, strides=(1,))

    @classmethod
    def over(cls, bodies: pa.Array) -> "BodyReader":
        if isinstance(bodies, pa.ChunkedArray):
            bodies = bodies.combine_chunks()
        bodies = bodies.cast(pa.binary()).fill_null(b"")
        offsets = np.frombuffer(bodies.buffers()[1], dtype=np.int32)[bodies.offset : bodies.offset + len(bodies) + 1]
        data = bodies.buffers()[2]
        buf = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
        return cls(buf, offsets[:-1], offsets[1:])

    def fail(self, rows: np.ndarray) -> None:
        self.status[rows] = CORRUPT
        self.pos[rows] = self.end[rows]

    # -- scalars ------------------------------------------------------------
    def read_long(self, rows: np.ndarray) -> np.ndarray:
        last = self.buf.size - 1
        p = self.pos[rows]
        byte = self.buf[np.minimum(p, last)]
        p += 1
        if byte.max(initial=0) < 0x80 and (p <= self.end[rows]).all():
            # Every number fits one byte: union branches, most lengths.
            self.pos[rows] = p
            return _ZIGZAG[byte]
        value = (byte & 0x7F).astype(np.uint64)
        live = np.flatnonzero(byte & 0x80)
        shift = 7
        while live.size and shift < 70:
            byte = self.buf[np.minimum(p[live], last)]
            value[live] |= (byte & 0x7F).astype(np.uint64) << np.uint64(shift)
            p[live] += 1
            live = live[(byte & 0x80) != 0]
            shift += 7
        bad = p > self.end[rows]
        bad[live] = True
        self.pos[rows] = p
        if bad.any():
            self.fail(rows[bad])
            value[bad] = 0
        sign = (~(value & np.uint64(1))) + np.uint64(1)
        return ((value >> np.uint64(1)) ^ sign).view(np.int64)

    def _fixed(self, rows: np.ndarray, width: int, source: np.ndarray, want: bool) -> np.ndarray | None:
        p = self.pos[rows]
        after = p + width
        bad = after > self.end[rows]
        if bad.any():
            self.fail(rows[bad])
            p[bad] = 0
            self.pos[rows[~bad]] = after[~bad]
        else:
            self.pos[rows] = after
        return source[p] if want else None

    def _numbers(self, kind: str, rows: np.ndarray, want: bool = True) -> np.ndarray | None:
        if kind == "double":
            return self._fixed(rows, 8, self._f8, want)
        if kind == "float":
            return self._fixed(rows, 4, self._f4, want)
        if kind == "boolean":
            value = self._fixed(rows, 1, self.buf, want)
            return value != 0 if want else None
        value = self.read_long(rows)
        if kind == "int":
            wrong = (value > 2147483647) | (value < -2147483648)
            if wrong.any():
                self.fail(rows[wrong])
            value = value.astype(np.int32)
        return value

    def _slices(self, rows: np.ndarray, want: bool) -> pa.Array | None:
        size = self.read_long(rows)
        p = self.pos[rows]
        bad = (size < 0) | (size > self.end[rows] - p)
        if bad.any():
            self.fail(rows[bad])
            p = self.pos[rows]
            size = np.where(bad, 0, size)
        self.pos[rows] = p + size
        if not want:
            return None
        if not len(rows):
            return pa.array([], pa.binary())
        # Positions rise from row to row, so values and the gaps between them
        # form one Arrow array over the original buffer; keep every other one.
        edges = np.empty(2 * len(rows), dtype=np.int32)
        edges[0::2] = p
        edges[1::2] = p + size
        both = pa.Array.from_buffers(
            pa.binary(), len(edges) - 1, [None, pa.py_buffer(edges), pa.py_buffer(self.buf)]
        )
        return both.take(pa.array(np.arange(0, len(edges) - 1, 2)))

    def _text(self, rows: np.ndarray, raw: pa.Array) -> pa.Array:
        try:
            return raw.cast(pa.string())
        except pa.ArrowInvalid:
            values = []
            for i, body in enumerate(raw.to_pylist()):
                try:
                    values.append(body.decode("utf-8"))
                except UnicodeDecodeError:
                    values.append("")
                    self.fail(rows[i : i + 1])
            return pa.array(values, pa.string())

    # -- types --------------------------------------------------------------
    def read(self, avro_type, rows: np.ndarray, target: pa.DataType | None) -> pa.Array | None:
        """Read one value per row; ``target=None`` skips over it."""
        if isinstance(avro_type, list):
            return self._union(avro_type, rows, target)
        kind = _kind(avro_type)
        if kind == "record":
            return self._record(avro_type, rows, target)
        if kind == "array":
            return self._array(avro_type["items"], rows, target)
        if kind == "map":
            return self._map(avro_type["values"], rows, target)
        if kind not in _NATURAL:
            raise ValueError(f"unsupported Avro type {avro_type!r}")
        if kind == "null":
            return None if target is None else pa.nulls(len(rows), target)
        if kind in ("bytes", "string"):
            out = self._slices(rows, target is not None)
            if out is not None and kind == "string":
                out = self._text(rows, out)
        else:
            value = self._numbers(kind, rows, target is not None)
            out = pa.array(value) if target is not None else None
        if target is None:
            return None
        if pa.types.is_timestamp(target) and pa.types.is_int64(out.type):
            if isinstance(avro_type, dict) and avro_type.get("logicalType") == "timestamp-millis":
                out = pc.multiply(out, 1000)
            return out.cast(pa.timestamp("us")).cast(target)
        return out if out.type == target else out.cast(target)

    def _union(self, branches, rows, target):
        choice = self.read_long(rows)
        wrong = (choice < 0) | (choice >= len(branches))
        if wrong.any():
            self.fail(rows[wrong])
        values = [b for b in branches if b != "null"]
        kept = values[:1]
        if target is not None and len(values) == 1 and _kind(values[0]) in _NUMBERS and not pa.types.is_timestamp(target):
            return self._optional_numbers(_kind(values[0]), rows, choice == branches.index(values[0]), target)
        result = None
        for i, branch in enumerate(branches):
            if branch == "null":
                continue
            at = np.flatnonzero(choice == i)
            if not at.size:
                continue
            if branch in kept or target is None:
                part = self.read(branch, rows if at.size == rows.size else rows[at], target)
                if target is not None:
                    part = _spread(part, at, len(rows))
                    result = part if result is None else pc.coalesce(result, part)
                continue
            # A later branch counts only if its values fit the first one's type.
            try:
                natural = _NATURAL.get(_kind(branch), target)
                part = self.read(branch, rows[at], natural).cast(target)
            except (pa.ArrowInvalid, pa.ArrowNotImplementedError):
                self.fail(rows[at])
                continue
            part = _spread(part, at, len(rows))
            result = part if result is None else pc.coalesce(result, part)
        if target is None:
            return None
        return pa.nulls(len(rows), target) if result is None else result

    def _optional_numbers(self, kind, rows, present, target):
        """The common case, a number or null, without an Arrow array in between."""
        at = np.flatnonzero(present)
        if at.size == rows.size:
            out = pa.array(self._numbers(kind, rows))
        else:
            part = self._numbers(kind, rows[at])
            full = np.zeros(len(rows), dtype=part.dtype)
            full[at] = part
            out = pa.array(full, mask=~present)
        return out if out.type == target else out.cast(target)

    def _record(self, record, rows, target):
        columns = {}
        for field in record["fields"]:
            name, wanted = field["name"], None
            for candidate in (name, name + LEGACY_SUFFIX):
                at = target.get_field_index(candidate) if target is not None else -1
                if at >= 0 and _fits(field["type"], target.field(at).type):
                    name, wanted = candidate, target.field(at).type
                    break
            value = self.read(field["type"], rows, wanted)
            if wanted is not None:
                columns[name] = value
        if target is None:
            return None
        arrays = [columns[f.name] if f.name in columns else pa.nulls(len(rows), f.type) for f in target]
        return pa.StructArray.from_arrays(arrays, fields=list(target))

    def _blocks(self, rows, read_items, read_long=None):
        """Walk the counted blocks of an array or map for all rows at once; long blocks
        by themselves, if there is a way."""
        waiting = np.arange(len(rows))
        while waiting.size:
            count = self.read_long(rows[waiting])
            sized = count < 0
            if sized.any():
                self.read_long(rows[waiting[sized]])
                count = np.abs(count)
            count[self.status[rows[waiting]] != OK] = 0
            waiting, count = waiting[count > 0], count[count > 0]
            short = count < LONG_BLOCK if read_long else np.ones(len(count), bool)
            for at, n in zip(waiting[~short], count[~short]):
                read_long(at, int(n))
            self.repeat(rows, waiting[short], count[short], read_items)

    def repeat(self, rows, live, count, read_items):
        """Read slot 0 of every row, then slot 1 of the rows that have one, …"""
        left = count.copy()
        while live.size:
            read_items(live)
            left -= 1
            more = (left > 0) & (self.status[rows[live]] == OK)
            live, left = live[more], left[more]

    def _at(self, pos: np.ndarray, end: int) -> "BodyReader":
        """A reader that takes each position for a row of its own."""
        return BodyReader(self.buf, pos, np.full(len(pos), end, dtype=np.int64))

    def _item_starts(self, items, at: int, end: int, count: int) -> tuple[np.ndarray, int] | None:
        """Where ``count`` items one after the other begin, and where the last one ends.

        An item is skipped from every byte of a window at once, which tells for each
        byte where the item after it would begin. The items that do follow each other
        from the first are then found by doubling: the first n, and as many steps of n.
        """
        starts, left = [], count
        while left:
            size = min(WINDOW, end - at)
            if size <= 0:
                return None if not _is_empty(items) else (np.concatenate([*starts, np.full(left, at)]), at)
            probe = self._at(np.arange(at, at + size), end)
            probe.read(items, np.arange(size), None)
            good = probe.status == OK
            step = np.append(np.where(good & (probe.pos < at + size), probe.pos - at, size), size)
            chain = np.zeros(1, dtype=np.int64)
            while len(chain) < left and chain[-1] < size:
                chain = np.concatenate([chain, step[chain]])
                step = step[step]
            chain = chain[chain < size][:left]
            if not good[chain].all():
                return None
            starts.append(at + chain)
            left -= len(chain)
            at = int(probe.pos[chain[-1]])
        return np.concatenate(starts), at

    def _array(self, items, rows, target):
        value_type = target.value_type if target is not None else None
        parts, owners = [], []

        def long(at, n):
            row = rows[at]
            end = int(self.end[row])
            found = self._item_starts(items, int(self.pos[row]), end, n)
            if found is not None and value_type is not None:
                reader = self._at(found[0], end)
                part = reader.read(items, np.arange(n), value_type)
                found = found if (reader.status == OK).all() else None
                parts.append(part)
                owners.append(np.full(n, at))
            if found is None:
                self.fail(rows[at : at + 1])
            else:
                self.pos[row] = found[1]

        def slot(live):
            part = self.read(items, rows[live], value_type)
            if value_type is not None:
                parts.append(part)
                owners.append(live)

        self._blocks(rows, slot, long if _is_flat(items) else None)
        if target is None:
            return None
        offsets, values = gather(parts, owners, len(rows), value_type)
        return pa.ListArray.from_arrays(offsets, values, type=target)

    def _map(self, values_type, rows, target):
        item_type = target.item_type if target is not None else None
        keys, items, owners = [], [], []

        def slot(live):
            key = self.read("string", rows[live], pa.string() if target is not None else None)
            item = self.read(values_type, rows[live], item_type)
            if target is not None:
                keys.append(key)
                items.append(item)
                owners.append(live)

        self._blocks(rows, slot)
        if target is None:
            return None
        offsets, key_array = gather(keys, owners, len(rows), pa.string())
        _, item_array = gather(items, owners, len(rows), item_type)
        return pa.MapArray.from_arrays(offsets, key_array, item_array, type=target)


def _is_flat(avro_type) -> bool:
    """Whether values hold no further array or map, whose length any byte could pretend."""
    if isinstance(avro_type, list):
        return all(_is_flat(b) for b in avro_type)
    kind = _kind(avro_type)
    return all(_is_flat(f["type"]) for f in avro_type["fields"]) if kind == "record" else kind not in ("array", "map")


def _is_empty(avro_type) -> bool:
    """Whether values take no byte."""
    kind = None if isinstance(avro_type, list) else _kind(avro_type)
    return kind == "null" or (kind == "record" and all(_is_empty(f["type"]) for f in avro_type["fields"]))


def gather(parts, owners, n, value_type):
    """Slot-wise pieces to row order: list offsets and the ordered values."""
    if not parts:
        return pa.array(np.zeros(n + 1, dtype=np.int32)), pa.array([], value_type)
    owner = np.concatenate(owners)
    values = pa.concat_arrays(parts)
    if len(parts) > 1:
        values = values.take(pa.array(np.argsort(owner, kind="stable")))
    sizes = np.bincount(owner, minlength=n)
    return pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), values


def decode_bodies(bodies: pa.Array, schema: dict, target: pa.StructType) -> tuple[pa.StructArray, np.ndarray]:
    """Decode schemaless bodies; the status array tells which rows are good."""
    reader = BodyReader.over(bodies)
    rows = np.arange(len(bodies))
    decoded = reader.read(schema, rows, target)
    early = (reader.status == OK) & (reader.pos < reader.end)
    reader.status[early] = TRAILING
    return decoded, reader.status


def decode_blocks(payloads: list[bytes], counts: list[int], schema: dict, target: pa.StructType) -> pa.StructArray:
    """Decode container-file blocks, each a run of ``count`` records."""
    ends = np.cumsum([len(p) for p in payloads])
    reader = BodyReader(np.frombuffer(b"".join(payloads), dtype=np.uint8), np.concatenate([[0], ends[:-1]]), ends)
    rows = np.arange(len(payloads))
    parts, owners = [], []

    def slot(live):
        parts.append(reader.read(schema, rows[live], target))
        owners.append(live)

    count = np.asarray(counts, dtype=np.int64)
    has_rows = np.flatnonzero(count > 0)
    reader.repeat(rows, has_rows, count[has_rows], slot)
    if (reader.status != OK).any() or (reader.pos != reader.end).any():
        raise ValueError("corrupt Avro block")
    return gather(parts, owners, len(rows), target)[1]


# -- encoding -----------------------------------------------------------------
def _binary(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.Array.from_buffers(
        pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]
    )


def _join(*parts) -> pa.Array:
    return pc.binary_join_element_wise(*parts, pa.scalar(b"", pa.binary()))


def encode_long(values: np.ndarray) -> pa.Array:
    v = values.astype(np.int64)
    rest = ((v << 1) ^ (v >> 63)).view(np.uint64)
    digits = np.zeros((len(v), 10), dtype=np.uint8)
    sizes = np.ones(len(v), dtype=np.int64)
    for i in range(10):
        digits[:, i] = (rest & np.uint64(0x7F)).astype(np.uint8)
        rest = rest >> np.uint64(7)
        more = rest > 0
        if not more.any():
            break
        digits[more, i] |= 0x80
        sizes[more] = i + 2
    return _binary(digits[np.arange(10) < sizes[:, None]], sizes)


def _values(arr: pa.Array) -> np.ndarray:
    return arr.to_numpy(zero_copy_only=False)


def encode(avro_type, arr: pa.Array, path: str = "record") -> pa.Array:
    """Avro bytes of every value of an Arrow array."""
    n = len(arr)
    if isinstance(avro_type, list):
        branch = next((i for i, b in enumerate(avro_type) if b != "null"), None)
        missing = arr.is_null() if branch is not None else pa.array(np.ones(n, dtype=bool))
        has_null = "null" in avro_type
        if not has_null and pc.any(missing).as_py():
            raise ValueError(f"{path}: null in a union without null")
        null_tag = bytes([2 * avro_type.index("null")]) if has_null else b""
        if branch is None:
            return pa.array([null_tag] * n, pa.binary())
        present = np.flatnonzero(~_values(missing))
        if not len(present):  # an absent column has no type to encode
            if n and not has_null:
                raise ValueError(f"{path}: null in a union without null")
            return pa.array([null_tag] * n, pa.binary())
        body = encode(avro_type[branch], arr.take(pa.array(present)) if len(present) < n else arr, path)
        tagged = _join(pa.scalar(bytes([2 * branch]), pa.binary()), body)
        return _spread(tagged, present, n).fill_null(null_tag) if len(present) < n else tagged
    kind = _kind(avro_type)
    if kind == "null":
        return pa.array([b""] * n, pa.binary())
    if arr.null_count:
        raise ValueError(f"{path}: null in a field that is not nullable")
    if kind == "record":
        children = dict(zip([f.name for f in arr.type], arr.flatten()))
        parts = []
        for field in avro_type["fields"]:
            name = field["name"]
            child = children[name] if name in children else pa.nulls(n)
            parts.append(encode(field["type"], child, f"{path}.{name}"))
        return _join(*parts) if parts else pa.array([b""] * n, pa.binary())
    if kind in ("array", "map"):
        sizes = _values(pc.list_value_length(arr)).astype(np.int64) if kind == "array" else np.diff(_values(arr.offsets))
        if kind == "array":
            items = encode(avro_type["items"], arr.flatten(), f"{path}[]")
        else:
            first, last = arr.offsets[0].as_py(), arr.offsets[-1].as_py()
            items = _join(
                encode("string", arr.keys[first:last], f"{path}.key"),
                encode(avro_type["values"], arr.items[first:last], f"{path}.value"),
            )
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
        joined = pc.binary_join(pa.ListArray.from_arrays(offsets, items), pa.scalar(b"", pa.binary()))
        counts = encode_long(sizes)
        full = _join(counts, joined, pa.scalar(b"\x00", pa.binary()))
        return pc.if_else(pa.array(sizes > 0), full, pa.scalar(b"\x00", pa.binary()))
    if kind in ("string", "bytes"):
        raw = arr.cast(pa.string() if kind == "string" else pa.binary()).cast(pa.binary())
        return _join(encode_long(_values(pc.binary_length(raw))), raw)
    if kind in ("double", "float"):
        values = _values(arr).astype("<f8" if kind == "double" else "<f4")
        return _binary(values.view(np.uint8), np.full(n, values.itemsize))
    if kind == "boolean":
        return _binary(_values(arr).astype(np.uint8), np.ones(n, dtype=np.int64))
    if kind in ("int", "long"):
        if pa.types.is_timestamp(arr.type):
            millis = isinstance(avro_type, dict) and avro_type.get("logicalType") == "timestamp-millis"
            arr = arr.cast(pa.timestamp("ms" if millis else "us", arr.type.tz), safe=False).cast(pa.int64())
        return encode_long(_values(arr))
    raise ValueError(f"{path}: unsupported Avro type {avro_type!r}")
