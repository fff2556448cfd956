"""Graph work inside tasks: links packed by vertex, the moves of a Louvain sweep, what they change, and contraction.

A vertex is a whole number below ``n`` here. Its links lie in one row of an Arrow file in the shared folder, as two arrays
(other ends, weights), and a task of a sweep opens one such file and reads the community of every vertex from the written
table, so that no link is ever shuffled in a sweep and only those of vertices that may move are looked at. Worker functions
are pickled by value, so executors need only the public libraries.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

from opinion_spark.operators.sketches import opened, read

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FLUSH = 1 << 21  # edges packed at a time
FILE = 1 << 22  # links in a file, about
PART = 1 << 20  # links compared at a time
LONG = 64  # links of a vertex, on average, from which vertices are picked one by one
TABLE = 2048  # communities whose pairs are summed in one array

Batches = Iterator[pa.RecordBatch]


def _cut(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    """The bytes of ``values``, cut at ``starts``."""
    offsets = (np.append(starts, len(values)) * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def _flat(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """Where each row's values begin (and the last ones end), and the values of all rows."""
    _, offsets, data = column.buffers()
    wide = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    at = np.frombuffer(offsets, wide)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    if data is None:
        return at * 0, np.empty(0, kind)
    values = np.frombuffer(data, np.uint8)[at[0]:at[-1]].view(kind)
    return (at - at[0]) // values.itemsize, values


def _pieces(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    a, b, w = (c.to_numpy() for c in pa.Table.from_batches(held).columns)
    node, other, w = np.concatenate([a, b]), np.concatenate([b, a]), np.concatenate([w, w])
    order = np.sort((node.astype(np.int64) << 32) | np.arange(len(node))) & 0xFFFFFFFF
    node, w = node[order], w[order]
    starts = np.flatnonzero(np.diff(node, prepend=-2))
    return pa.RecordBatch.from_arrays(
        [pa.array(node[starts]), _cut(other[order], starts), _cut(w, starts)], ["idx", "o", "w"])


def pack(batches: Batches) -> Batches:
    """For ``mapInArrow``: edges ``(int, int, double)`` to ``idx, o, w``, some of a vertex's links, for both ends."""
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= FLUSH:
            yield _pieces(held)
            held, n = [], 0
    if n:
        yield _pieces(held)


def _store(folder: str, rows: list[tuple]) -> tuple[str, np.ndarray, np.ndarray]:
    """A new file of the rows ``(idx, o, w)`` (arrays of some links; those of a vertex follow each other): its name, vertices, sums of weights."""
    import uuid

    idx = np.array([r[0] for r in rows], np.int32)
    starts = np.flatnonzero(np.diff(idx, prepend=-2))
    o, w = np.concatenate([r[1] for r in rows]), np.concatenate([r[2] for r in rows])
    ptr = np.cumsum([0, *(len(r[1]) for r in rows)])
    values, kept = np.unique(w), w
    if len(values) <= 256:  # a byte a weight
        kept = np.searchsorted(values, w).astype(np.uint8)
    offsets = pa.array(np.append(ptr[starts], ptr[-1]).astype(np.int32))
    k = np.add.reduceat(w, ptr[starts])
    batch = pa.RecordBatch.from_arrays([pa.array(idx[starts]), pa.array(k), pa.ListArray.from_arrays(offsets, pa.array(o)), pa.ListArray.from_arrays(offsets, pa.array(kept))], ["idx", "k", "o", "w"])
    batch = batch.replace_schema_metadata({"values": values.tobytes()})
    fs, path = opened(folder)
    fs.create_dir(path, recursive=True)
    name = f"{uuid.uuid4().hex}.arrow"
    with fs.open_output_stream(f"{path}/{name}", compression=None) as out, pa.ipc.new_file(out, batch.schema) as file:
        file.write_batch(batch)
    return name, idx[starts], k


def store(folder: str) -> Callable[[Batches], Batches]:
    """For ``mapInArrow``: pieces sorted by vertex to files of whole vertices; gives ``(file, idx, k)`` for each vertex."""
    def given(rows: list[tuple]) -> pa.RecordBatch:
        name, idx, k = _store(folder, rows)
        return pa.RecordBatch.from_arrays([pa.array([name] * len(idx)), pa.array(idx), pa.array(k)], ["file", "idx", "k"])

    def run(batches: Batches) -> Batches:
        rows, n = [], 0
        for b in batches:
            idx = b.column(0).to_numpy()
            ptr, o = _flat(b.column(1), np.int32)
            _, w = _flat(b.column(2), np.float64)
            for i, v in enumerate(idx.tolist()):
                if n >= FILE and rows[-1][0] != v:
                    yield given(rows)
                    rows, n = [], 0
                rows.append((v, o[ptr[i]:ptr[i + 1]], w[ptr[i]:ptr[i + 1]]))
                n += len(rows[-1][1])
        if rows:
            yield given(rows)
    return run


class Links:
    """The links of a file's vertices: ``idx``, where each one's begin (``ptr``), other ends, and weights by ``weight``."""

    def __init__(self, folder: str, name: str):
        fs, path = opened(folder)
        batch = pa.ipc.open_file(fs.open_input_file(f"{path}/{name}")).get_batch(0)
        self.idx = batch.column(0).to_numpy()
        self.ptr = batch.column(2).offsets.to_numpy().astype(np.int64)
        self.o, self.w = (batch.column(c).values.to_numpy() for c in (2, 3))
        self.values = np.frombuffer(batch.schema.metadata[b"values"], np.float64) if self.w.dtype == np.uint8 else None

    def parts(self, wanted: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """The (wanted) vertices some at a time: vertices, the row of each link among them, its other end and its weight."""
        chosen = np.arange(len(self.idx)) if wanted is None else np.flatnonzero(wanted)
        first, size = self.ptr[chosen], np.diff(self.ptr)[chosen]
        many, lo = np.append(0, np.cumsum(size)), 0
        while lo < len(chosen):
            hi = max(lo + 1, int(np.searchsorted(many, many[lo] + PART, "right")) - 1)
            row = np.repeat(np.arange(hi - lo), size[lo:hi])
            if many[-1] >= LONG * len(chosen):
                at = [slice(a, a + z) for a, z in zip(first[lo:hi].tolist(), size[lo:hi].tolist())]
                o, w = (np.concatenate([x[a] for a in at]) for x in (self.o, self.w))
            else:
                at = np.arange(len(row)) + np.repeat(first[lo:hi] - many[lo:hi] + many[lo], size[lo:hi])
                o, w = self.o[at], self.w[at]
            yield self.idx[chosen[lo:hi]], row, o, w if self.values is None else self.values[w]
            lo = hi


def _state(folder: str, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every vertex: its community, the sum of its weights, and whether it has any edge."""
    t = read(folder, {"idx": pa.int32(), "c": pa.int32(), "k": pa.float64()})
    at = t["idx"].to_numpy()
    c, k, linked = np.zeros(n, np.int32), np.zeros(n), np.zeros(n, bool)
    c[at], k[at], linked[at] = t["c"].to_numpy(), t["k"].fill_null(0.0).to_numpy(), t["k"].is_valid().to_numpy()
    return c, k, linked


def _places(c: np.ndarray, linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The communities of vertices with edges, ascending, and each vertex's place among them."""
    known = np.zeros(len(c), bool)
    known[c[linked]] = True
    ids = np.flatnonzero(known).astype(np.int32)
    place = np.zeros(len(c), np.int32)
    place[ids] = np.arange(len(ids), dtype=np.int32)
    return ids, place[c]


def _summed(key: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, ascending, and the sum of each one's weights."""
    shift = len(key).bit_length()
    order = np.sort((key << shift) | np.arange(len(key)))
    key = order >> shift
    first = np.flatnonzero(np.diff(key, prepend=-1))
    return key[first], np.add.reduceat(w[order & ((1 << shift) - 1)], first)


def best(row: np.ndarray, cand: np.ndarray, w: np.ndarray, own: np.ndarray, k: np.ndarray, tot: np.ndarray, m: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each row: the best other community among its links' (ties to the smallest), its gain, and that of staying.

    Gains are rounded so that the order of sums cannot flip near-ties.
    """
    n, many = len(own), len(tot)
    each, part = np.arange(n), k / (2.0 * m * m)
    key = row * many + cand
    if n * many <= len(w) and w.min() > 0:
        weight = np.bincount(key, w, n * many).reshape(n, many)
        gain = np.round(weight / m - tot * part[:, None], 12)
        gain[weight == 0] = -np.inf
        mine = weight[each, own]
        gain[each, own] = -np.inf
        choice = gain.argmax(1)
        top = gain[each, choice]
    else:
        key, weight = _summed(key, w)
        r, c = np.divmod(key, many)
        gain = np.round(weight / m - tot[c] * part[r], 12)
        is_own = c == own[r]
        mine = np.zeros(n)
        mine[r[is_own]] = weight[is_own]
        gain[is_own] = -np.inf
        top = np.maximum.reduceat(gain, np.searchsorted(r, each))
        tops = np.flatnonzero(gain == top[r])
        choice = c[tops[np.searchsorted(r[tops], each)]]
    return choice, top, np.round(mine / m - (tot[own] - k) * part, 12)


def moves(folder: str, files: list[str], state: str, turns: str, bit: int, n: int, m: float) -> Callable[[Batches], Batches]:
    """For ``mapInArrow``: numbers of files to ``(idx, c)``, the vertices whose turn it is that gain by a move, and where they go."""
    def run(batches: Batches) -> Batches:
        c, k, linked = _state(state, n)
        ids, place = _places(c, linked)
        tot = np.bincount(place[linked], k[linked], len(ids))
        t, turn = read(turns, {"idx": pa.int32(), "turns": pa.int64()}), np.zeros(n, bool)
        turn[t["idx"].to_numpy()] = (t["turns"].to_numpy() >> bit) & 1 == 1
        for f in (f for b in batches for f in b.column(0).to_pylist()):
            links = Links(folder, files[f])
            for v, row, other, w in links.parts(turn[links.idx]):
                choice, top, stay = best(row, place[other], w, place[v], k[v], tot, m)
                go = top > stay + 1e-9
                yield pa.RecordBatch.from_arrays([pa.array(v[go]), pa.array(ids[choice[go]])], ["idx", "c"])
    return run


def change(folder: str, files: list[str], state: str, moved: str, n: int) -> Callable[[Batches], Batches]:
    """For ``mapInArrow``: numbers of files to one row a task.

    What the moves add to the weight inside communities (a link between two moved vertices is met twice), and, the same in every
    task, the sum of squares of the communities' weights afterwards and the number of moves.
    """
    def run(batches: Batches) -> Batches:
        c, k, linked = _state(state, n)
        t = read(moved, {"idx": pa.int32(), "c": pa.int32()})
        new, gone, more = c.copy(), np.zeros(n, bool), 0.0
        new[t["idx"].to_numpy()] = t["c"].to_numpy()
        gone[t["idx"].to_numpy()] = True
        for f in (f for b in batches for f in b.column(0).to_pylist()):
            links = Links(folder, files[f])
            for v, row, other, w in links.parts(gone[links.idx]):
                r = v[row]
                now = (new[r] == new[other]).astype(np.int8) - (c[r] == c[other])
                more += float(np.dot(np.where(gone[other], w / 2, w), now))
        tot = np.bincount(new[linked], k[linked], n)
        yield pa.RecordBatch.from_arrays([pa.array([more]), pa.array([float(np.dot(tot, tot))]), pa.array([len(t)], pa.int64())], ["more", "d2", "moved"])
    return run


def contract(folder: str, files: list[str], state: str, n: int) -> Callable[[Batches], Batches]:
    """For ``mapInArrow``: numbers of files to ``(a, b, w)``, sums of the weights between communities (a = b: inside one)."""
    def run(batches: Batches) -> Batches:
        c, _, linked = _state(state, n)
        ids, place = _places(c, linked)
        many = len(ids)
        table = np.zeros(many * many) if many <= TABLE else None

        def sums(key, w):
            return pa.RecordBatch.from_arrays([pa.array(ids[key // many]), pa.array(ids[key % many]), pa.array(w)], ["a", "b", "w"])

        for f in (f for b in batches for f in b.column(0).to_pylist()):
            for v, row, other, w in Links(folder, files[f]).parts():
                a, b = place[v][row].astype(np.int64), place[other]
                once = a <= b  # each link is met from both ends
                key, w = (a * many + b)[once], np.where(a == b, w / 2, w)[once]
                if not len(w):
                    continue
                if table is not None and w.min() > 0:
                    table += np.bincount(key, w, many * many)
                else:
                    yield sums(*_summed(key, w))
        if table is not None:
            key = np.flatnonzero(table)
            yield sums(key, table[key])
    return run
