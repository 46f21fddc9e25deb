"""The join on keys without a shuffle of pairs: records of source 1 and targets are put in blocks, and each pair of blocks is a cell.

A pair of records is in one cell, with all keys that the two share, so the bits of its strategies are or-ed there
and a pair leaves its cell once. What is written are the blocks: numbers of keys and records, a byte or two
for each key of a record that both sides have and that isn't suppressed. Pairs are made as they are read.
Cells are as many as pairs of blocks: blocks are read again for each cell, which costs no disk.
"""

from __future__ import annotations

import ctypes
import pickle
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import _parse_datatype_string

from ..sources.shared import written

#: Keys that a task holds before it hands them on.
SLICE_KEYS = 1_000_000
#: Records of one side in a block, and cells that there should be for each core while blocks are smaller.
BLOCK_RECORDS, CELLS = 12_288, 4
#: The same where more is known about the records.
DESCRIBED_RECORDS = 4096
#: Places of a cell's table of pairs that are looked at at once, and pairs of keys that are laid out at once.
PLACES, MATCHES = 1 << 20, 1 << 20
#: Parts of a block: buckets' from 0, records' from -1 down, what else is known about those from here down.
ABOUT = -(1 << 60)
NO_TAG = np.iinfo(np.int64).min


def _map(table: DataFrame, run: Callable, schema: str, batch_rows: str = "1000") -> DataFrame:
    """``mapInArrow``, in small batches unless the session has a size of its own; tasks give memory back when they end."""
    conf = table.sparkSession.conf
    if conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch_rows)

    def run_and_release(batches):
        yield from run(batches)
        _release()

    return table.mapInArrow(run_and_release, _parse_datatype_string(schema))


def _release() -> None:
    """Gives freed memory back."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def _pack(*parts) -> bytes:
    """Arrays in few bytes."""
    raw = pickle.dumps(parts, 5)
    return pickle.dumps((len(raw), pa.Codec("zstd", compression_level=3).compress(raw, asbytes=True)), 5)


def _unpack(data: bytes) -> tuple:
    size, raw = pickle.loads(data)
    return pickle.loads(pa.decompress(raw, size, "zstd", asbytes=True))


def _steps(x: np.ndarray) -> np.ndarray:
    """Differences of neighbours, which pack better."""
    return np.diff(x, prepend=x.dtype.type(0))


def _row(kinds: str, *columns) -> pa.RecordBatch:
    names = kinds.split()
    types = {"i": pa.int32(), "l": pa.int64(), "b": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array(c, types[k[-1]]) for c, k in zip(columns, names)], [k[:-2] for k in names])


def _planes(x: np.ndarray) -> np.ndarray:
    """Small numbers as first bytes, second bytes and so on, which pack better; ``_numbers`` undoes it."""
    return np.ascontiguousarray(x.astype("<i4").view(np.uint8).reshape(-1, 4).T)


def _numbers(planes: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(planes.T).view("<i4").ravel()


def _set_packed(words: pa.StringArray, sizes: np.ndarray, codes: np.ndarray) -> tuple:
    """Sets of words, by record: the words, frequent ones first and else in order, and each record's places among them in order."""
    times = np.bincount(codes, minlength=len(words))
    order = pc.sort_indices(pa.table({"n": np.frexp(times)[1], "word": words}), [("n", "descending"), ("word", "ascending")])
    place = np.empty(len(words), np.int64)
    place[order.to_numpy()] = np.arange(len(words))
    wide, edges, steps = max(1, len(words)), np.concatenate([[0], np.cumsum(sizes)]), np.empty(len(codes), np.int32)
    for at in range(0, len(sizes), 512):
        end = min(at + 512, len(sizes))
        some = slice(edges[at], edges[end])
        steps[some] = np.sort(np.repeat(np.arange(end - at), sizes[at:end]) * wide + place[codes[some]]) % wide
    steps = _planes(_steps(steps))
    words = words.take(order)
    if not len(words):
        return b"", _planes(np.zeros(0)), _planes(sizes), steps
    _, offsets, text = words.buffers()
    offsets = np.frombuffer(offsets, np.int32, len(words) + 1)
    return text.to_pybytes()[: offsets[-1]], _planes(np.diff(offsets)), _planes(sizes), steps


def _set_of(text: bytes, lengths: np.ndarray, sizes: np.ndarray, steps: np.ndarray) -> tuple:
    """(words, sizes, codes) of what ``_set_packed`` made."""
    offsets = np.concatenate([[0], np.cumsum(_numbers(lengths))]).astype(np.int32)
    words = pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(text))
    return words, _numbers(sizes), np.cumsum(_numbers(steps), dtype=np.int32)


def _columns(about: pa.StructArray) -> tuple[dict, dict]:
    """Numbers of records by name, and their sets (lists of words, each once)."""
    plain, sets = {}, {}
    for field, column in zip(about.type, about.flatten()):
        if pa.types.is_list(field.type):
            coded = column.flatten().dictionary_encode()
            sets[field.name] = _set_packed(coded.dictionary, np.diff(column.offsets.to_numpy()), coded.indices.to_numpy(zero_copy_only=False))
        else:
            plain[field.name] = column.to_numpy(zero_copy_only=False)
    return plain, sets


def _joined(parts: list[tuple[dict, dict]]) -> tuple[dict, dict]:
    """``_columns`` of all parts."""
    plain = {k: np.concatenate([p[0][k] for p in parts]) for k in parts[0][0]}
    sets = {}
    for k in parts[0][1]:
        own = [_set_of(*p[1][k]) for p in parts]
        coded = pa.concat_arrays([words for words, _, _ in own]).dictionary_encode()
        starts = np.cumsum([0] + [len(words) for words, _, _ in own])
        codes = np.concatenate([codes + start for start, (_, _, codes) in zip(starts, own)])
        sets[k] = _set_packed(coded.dictionary, np.concatenate([sizes for _, sizes, _ in own]), coded.indices.to_numpy(zero_copy_only=False)[codes])
    return plain, sets


def _slices(buckets: int):
    """Records with their keys to rows (bucket, slice, lefts, rights, payload): a slice's records, what else is known about them (bucket -2), and its keys by bucket."""
    kinds = "bucket:i slice:l lefts:i rights:i payload:b"

    def one(n: int, held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        side = table.column("side").to_numpy()
        left = side == 1
        place = np.where(left, np.cumsum(left) - 1, np.cumsum(~left) - 1).astype(np.int32)
        column = lambda c, at: table.column(c).combine_chunks().filter(pa.array(at))
        own = [(column("id", at), column("country", at), column("side", at).to_numpy(), column("tag", at).to_numpy(zero_copy_only=False)) for at in (left, ~left)]
        rows = [(-1, n, int(left.sum()), int((~left).sum()), _pack(*own))]
        if "about" in table.column_names:
            rows.append((-2, n, int(left.sum()), int((~left).sum()), _pack(*[_columns(column("about", at)) for at in (left, ~left)])))
        lists = table.column("keys").combine_chunks()
        lengths = np.diff(lists.offsets.to_numpy())
        coded = lists.flatten().dictionary_encode()
        words, code = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        in_bucket = np.fromiter((zlib.crc32(w.encode()) % buckets for w in words.to_pylist()), np.int64, len(words))
        record = np.repeat(np.arange(len(lengths)), lengths)
        order = np.lexsort((record, ~left[record], code, in_bucket[code]))
        code, record = code[order], record[order]
        of, lefts, places = in_bucket[code], left[record], place[record]
        edges = np.searchsorted(of, np.arange(buckets + 1))
        for b in range(buckets):
            some = slice(edges[b], edges[b + 1])
            if edges[b] == edges[b + 1]:
                continue
            first = np.flatnonzero(np.diff(code[some], prepend=-1))
            l_at = lefts[some]
            n_all = np.diff(np.append(first, len(l_at)))
            n_left = np.add.reduceat(l_at.astype(np.int32), first)
            own = (words.take(pa.array(code[some][first])), n_left.astype(np.int32), (n_all - n_left).astype(np.int32), _steps(places[some][l_at]), _steps(places[some][~l_at]))
            rows.append((b, n, 0, 0, _pack(*own)))
        return _row(kinds, *zip(*rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, keys, n = [], 0, TaskContext.get().partitionId() << 20
        for batch in batches:
            held.append(batch)
            keys += len(batch.column(4).flatten())
            if keys > SLICE_KEYS:
                yield one(n, held)
                held, keys, n = [], 0, n + 1
        if sum(b.num_rows for b in held):
            yield one(n, held)

    return run


def _merge(held: list[tuple[int, bytes]], most: int, places: dict, blocks: tuple[int, int]):
    """A bucket's keys from all slices to rows for each block: the keys both sides have, without suppressed ones, and the records that have them."""
    parts = [(n, *_unpack(p)) for n, p in held]
    words = pa.chunked_array([p[1] for p in parts]).dictionary_encode().combine_chunks()
    words = words if isinstance(words, pa.DictionaryArray) else words.chunk(0)
    code = words.indices.to_numpy().astype(np.int64)
    size = len(words.dictionary)
    n_left, n_right = np.concatenate([p[2] for p in parts]), np.concatenate([p[3] for p in parts])
    lefts, rights = np.bincount(code, n_left, size), np.bincount(code, n_right, size)
    good = (lefts > 0) & (rights > 0) & (rights <= most)
    number = np.where(good, np.cumsum(good) - 1, -1)
    bits = np.fromiter((ord(w[0]) - 65 for w in words.dictionary.filter(pa.array(good)).to_pylist()), np.int64, int(good.sum()))
    edges = np.cumsum([0] + [len(p[1]) for p in parts])
    for side in (0, 1):
        keys, records, block = [], [], []
        for (n, *p), a, z in zip(parts, edges, edges[1:]):
            to, offset = places[n][side]
            key = np.repeat(number[code[a:z]], p[1 + side])
            kept = key >= 0
            keys.append(key[kept])
            records.append((np.cumsum(p[3 + side], dtype=np.int64)[kept] + offset).astype(np.int32))
            block.append(np.full(int(kept.sum()), to, np.int32))
        keys, records, block = np.concatenate(keys), np.concatenate(records), np.concatenate(block)
        order = np.lexsort((records, keys, block))
        keys, records = keys[order], records[order]
        cut = np.searchsorted(block[order], np.arange(blocks[side] + 1))
        for k in range(blocks[side]):
            own = keys[cut[k] : cut[k + 1]]
            yield side, k, _pack(len(bits), _steps(own).astype(np.int32), _steps(records[cut[k] : cut[k + 1]]), bits[own].astype(np.uint8) if side == 0 else None)


def _buckets(most: int, places: dict, blocks: tuple[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def out():
            for side, k, payload in _merge(held, most, places, blocks):
                yield _row("side:i block:i part:l payload:b", [side], [k], [now], [payload])

        for batch in batches:
            for b, n, p in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if held and b != now:
                    yield from out()
                    held.clear()
                now = b
                held.append((n, p.as_py()))
        if held:
            yield from out()

    return run


def _blocks(places: dict, more: bool):
    """Parts of blocks, each block's in order of bucket and after its records', to one row a block."""
    kinds = "side:i block:i payload:b" + " about:b" * more

    def whole(side: int, block: int, held: list[tuple[int, bytes]]) -> pa.RecordBatch:
        known = sorted(((places[ABOUT - n][side][1], p) for n, p in held if n <= ABOUT), key=lambda x: x[0])
        about = [[_pack(*_joined([_unpack(p)[side] for _, p in known]))]] if more else []
        held = [(n, p) for n, p in held if n > ABOUT]
        return _row(kinds, [side], [block], [keyed(side, held)], *about)

    def keyed(side: int, held: list[tuple[int, bytes]]) -> bytes:
        own = sorted(((places[-1 - n][side][1], _unpack(p)[side]) for n, p in held if n < 0), key=lambda x: x[0])
        names = [pa.concat_arrays([x[1][i].cast(pa.string()) for x in own]) for i in (0, 1)]
        about = [np.concatenate([x[1][i] for x in own]) for i in (2, 3)]
        keys, records, bits, first = [], [], [], 0
        for _, p in sorted((n, p) for n, p in held if n >= 0):
            size, key, record, bit = _unpack(p)
            keys.append((np.cumsum(key, dtype=np.int64) + first).astype(np.int32 if first + size < 2**31 else np.int64))
            records.append(np.cumsum(record, dtype=np.int64).astype(np.int32))
            bits.append(bit)
            first += size
        key = np.concatenate([*keys, np.zeros(0, np.int32)])
        del keys
        return _pack(*names, *about, _steps(key), np.concatenate([*records, np.zeros(0, np.int32)]), np.concatenate([*bits, np.zeros(0, np.uint8)]) if side == 0 else None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            for side, block, n, p in zip(*[batch.column(i).to_pylist() for i in range(3)], batch.column(3)):
                if held and (side, block) != now:
                    yield whole(*now, held)
                    held.clear()
                now = side, block
                held.append((n, p.as_py()))
        if held:
            yield whole(*now, held)

    return run


def _places(counts: list[tuple[int, int, int]], cores: int, most: int) -> tuple[dict, tuple[int, int]]:
    """For each slice the block of its records and their place in it, on both sides; and the numbers of blocks."""
    total = [sum(c[1 + side] for c in counts) for side in (0, 1)]
    side_of = max(1, round((cores * CELLS) ** 0.5))
    size = [max(1, min(most, -(-t // side_of))) for t in total]
    places, at, block = {}, [0, 0], [0, 0]
    for n, *own in sorted(counts):
        places[n] = []
        for side in (0, 1):
            if at[side] and at[side] + own[side] > 1.5 * size[side]:
                block[side], at[side] = block[side] + 1, 0
            places[n].append((block[side], at[side]))
            at[side] += own[side]
    return places, (block[0] + 1, block[1] + 1)


def blocks(records: DataFrame, most: int) -> DataFrame:
    """side, block, payload from id, side (1: source 1, else the target's source), country, tag (a number or null), keys (array; the first letter is the strategy's).

    If there is ``about`` (a struct of numbers and of lists of distinct words), blocks have that too.
    """
    spark = records.sparkSession
    more = [c for c in ("about",) if c in records.columns]
    records = records.select("id", F.col("side").cast("int").alias("side"), "country", F.coalesce("tag", F.lit(NO_TAG)).cast("long").alias("tag"), "keys", *more)
    cores = spark.sparkContext.defaultParallelism
    parts = records._jdf.queryExecution().toRdd().getNumPartitions()
    n_buckets = max(cores, 2 * parts)
    slices = written(_map(records, _slices(n_buckets), "bucket int, slice long, lefts int, rights int, payload binary"), "key-slices")
    counts = [tuple(r) for r in slices.where("bucket = -1").select("slice", "lefts", "rights").collect()]
    places, n = _places(counts, cores, DESCRIBED_RECORDS if more else BLOCK_RECORDS)
    schema = "side int, block int, payload binary" + ", about binary" * len(more)
    if not counts:
        return spark.createDataFrame([], schema)
    dealt = slices.where("bucket >= 0").select("bucket", "slice", "payload").repartition(n_buckets, "bucket").sortWithinPartitions("bucket", "slice")
    merged = _map(dealt, _buckets(most, places, n), "side int, block int, part long, payload binary")
    rows = merged
    for bucket, first in ((-1, -1), (-2, ABOUT))[: 1 + len(more)]:
        own = slices.where(F.col("bucket") == bucket)
        for side in (0, 1):
            to = F.element_at(F.create_map(*[F.lit(x) for k, v in places.items() for x in (k, v[side][0])]), F.col("slice"))
            rows = rows.unionByName(own.select(F.lit(side).alias("side"), to.alias("block"), (first - F.col("slice")).alias("part"), "payload"))
    rows = rows.repartition(2 * sum(n), "side", "block").sortWithinPartitions("side", "block", "part")
    return _map(rows, _blocks(places, bool(more)), schema)


def _agree(a: np.ndarray, b: np.ndarray, mode: str, blank_a: np.ndarray, blank_b: np.ndarray) -> np.ndarray:
    if mode == "allow_missing":
        return blank_a | blank_b | (a == b)
    if mode == "strict":
        return ~blank_a & (a == b)
    return np.ones(len(a), bool)


def cell_pairs(left: tuple, right: tuple, mode: str) -> Iterator[tuple]:
    """(lefts, rights, masks) of a cell, by record of source 1: numbers of records and the bits of the strategies that pair them."""
    _, country1, _, _, key1, record1, bit1 = left
    _, country2, _, _, key2, record2, _ = right
    key1, key2 = np.cumsum(key1, dtype=key1.dtype), np.cumsum(key2, dtype=key2.dtype)
    countries = pa.concat_arrays([country1, country2]).dictionary_encode()
    blank = np.array([x == "" for x in countries.dictionary.to_pylist()], bool)
    codes = countries.indices.to_numpy()
    c1, c2 = codes[: len(country1)], codes[len(country1) :]
    low = np.searchsorted(key2, key1, "left").astype(np.int32)
    size = np.searchsorted(key2, key1, "right").astype(np.int32) - low
    del key1, key2
    met = np.flatnonzero(size)
    met = met[np.argsort(record1[met], kind="stable")]
    record, low, size, bit = record1[met], low[met].astype(np.int64), size[met].astype(np.int64), bit1[met]
    if not len(met):
        return
    wide = len(country2)
    upto = np.concatenate([[0], np.cumsum(size)])
    firsts = np.flatnonzero(np.diff(record, prepend=-1))
    ends = np.append(firsts[1:], len(record))
    many, at = max(1, PLACES // wide), 0
    while at < len(firsts):
        end = min(len(firsts), at + many)
        end = max(at + 1, min(end, int(np.searchsorted(upto[ends], upto[firsts[at]] + MATCHES, "right"))))
        some = slice(firsts[at], ends[end - 1])
        row = np.repeat(np.arange(end - at), (ends - firsts)[at:end])
        seen = np.zeros((end - at) * wide, np.int64 if bit.max() > 7 else np.uint8)
        for b in np.unique(bit[some]).tolist():
            own = np.flatnonzero(bit[some] == b)
            n = size[some][own]
            where = np.arange(n.sum()) + np.repeat(low[some][own] - (np.cumsum(n) - n), n)
            place = record2[where] + np.repeat(row[own] * wide, n)
            seen[place] |= seen.dtype.type(1 << b)
        found = np.flatnonzero(seen)
        lefts, rights = record[firsts[at:end]][found // wide], found % wide
        x, y = c1[lefts], c2[rights]
        fine = _agree(x, y, mode, blank[x], blank[y])
        yield lefts[fine], rights[fine], seen[found[fine]]
        at = end


#: Members of sets that so large a share of a cell's pairs of records have are looked up in bits, others in lists of the records that have them.
COMMON = 1 / 4096
#: Pairs whose bits are gathered at once.
GATHERED = 512


def _bits(codes: np.ndarray, record: np.ndarray, records: int, width: int) -> np.ndarray:
    """For each record the codes it has, as bits in rows of 64-bit words."""
    words = np.zeros((records, -(-width // 64) * 8), np.uint8)
    for at in range(0, records, 1024):
        some = slice(*np.searchsorted(record, [at, at + 1024]))
        plain = np.zeros((min(1024, records - at), words.shape[1] * 8), np.uint8)
        plain[record[some] - at, codes[some]] = 1
        words[at : at + 1024] = np.packbits(plain, axis=1)
    return words.view(np.uint64)


def _of_pair(left: tuple, right: tuple) -> tuple:
    """Bits of both sides' common members; the left records' rare members as beginnings, sizes and right records of lists."""
    (words1, sizes1, codes1), (words2, sizes2, codes2) = left, right
    at = pc.index_in(words2, words1).fill_null(-1).to_numpy()
    at1, at2 = at[at >= 0], np.flatnonzero(at >= 0)
    number1, number2 = np.full(len(words1), -1, np.int32), np.full(len(words2), -1, np.int32)
    number1[at1] = number2[at2] = np.arange(len(at1))
    sides = []
    for number, sizes, codes in ((number1, sizes1, codes1), (number2, sizes2, codes2)):
        code, record = number[codes], np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        sides.append((code[code >= 0], record[code >= 0]))
    (code1, record1), (code2, record2) = sides
    n1, n2 = np.bincount(code1, minlength=len(at1)), np.bincount(code2, minlength=len(at1))
    common = n1 * n2 >= COMMON * len(sizes1) * len(sizes2)
    place = np.cumsum(common) - 1
    bits = [_bits(place[code[common[code]]], record[common[code]], len(sizes), int(common.sum())) for code, record, sizes in ((code1, record1, sizes1), (code2, record2, sizes2))]
    rare1, rare2 = ~common[code1], ~common[code2]
    code1, record1, code2, record2 = code1[rare1], record1[rare1], code2[rare2], record2[rare2]
    n2 = np.where(common, 0, n2)
    lists = record2[np.argsort(code2, kind="stable")]
    begin = np.cumsum(n2) - n2
    return *bits, np.searchsorted(record1, np.arange(len(sizes1) + 1)), begin.astype(np.int32)[code1], n2.astype(np.int32)[code1], lists


def intersections(sets: list[tuple]) -> Callable:
    """For sets of a cell's two sides (words, each once; sizes; places of records' words, by record): a function from numbers of records to the size of each intersection; the first numbers are in order."""
    known = [_of_pair(*s) for s in sets]
    wide = len(sets[0][1][1])
    edges = np.cumsum([0] + [k[0].shape[1] for k in known])
    bits1, bits2 = (np.concatenate([k[side] for k in known], axis=1) for side in (0, 1))
    some = np.flatnonzero(np.diff(edges))
    rest = [k[2:] for k in known]
    del known

    def rare(rows: np.ndarray, at: np.ndarray, edge: np.ndarray, begin: np.ndarray, size: np.ndarray, lists: np.ndarray) -> np.ndarray:
        """How many rare members the records ``rows`` share with those at places of a table with a row of ``wide`` for each."""
        n = edge[rows + 1] - edge[rows]
        item = np.arange(n.sum()) + np.repeat(edge[rows] - (np.cumsum(n) - n), n)
        row, low, size = np.repeat(np.arange(len(rows)) * wide, n), begin[item], size[item]
        upto, found, a = np.cumsum(size), np.zeros(len(at), np.int32), 0
        while a < len(item):
            z = max(a + 1, int(np.searchsorted(upto, (upto[a - 1] if a else 0) + MATCHES, "right")))
            n = size[a:z]
            where = np.arange(n.sum()) + np.repeat(low[a:z] - (np.cumsum(n) - n), n)
            found += np.bincount(lists[where] + np.repeat(row[a:z], n), minlength=len(rows) * wide)[at].astype(np.int32)
            a = z
        return found

    def count(lefts: np.ndarray, rights: np.ndarray) -> list[np.ndarray]:
        out = np.zeros((len(lefts), len(edges) - 1), np.int32)
        if len(some):
            for a in range(0, len(lefts), GATHERED):
                both = bits2[rights[a : a + GATHERED]]
                both &= bits1[lefts[a : a + GATHERED]]
                out[a : a + GATHERED, some] = np.add.reduceat(np.bitwise_count(both), edges[some], axis=1, dtype=np.int32)
        firsts = np.diff(lefts, prepend=-1) != 0
        at = (np.cumsum(firsts) - 1) * wide + rights
        return [out[:, k] + rare(lefts[firsts], at, *r) for k, r in enumerate(rest)]

    return count


def _ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The ids of blocks' records with their places."""
    for batch in batches:
        for side, block, payload in zip(*[batch.column(i).to_pylist() for i in range(3)]):
            ids = _unpack(payload)[0]
            columns = [pa.array(np.full(len(ids), x, np.int32)) for x in (side, block)] + [pa.array(np.arange(len(ids), dtype=np.int32)), ids]
            yield pa.RecordBatch.from_arrays(columns, ["side", "block", "place", "id"])


def flagged(blocked: DataFrame, ids: DataFrame) -> DataFrame:
    """``blocks`` with ``flagged``: the places of their records whose id is in ``ids`` (one column, each once). Records are joined with it, not pairs."""
    named = _map(blocked.select("side", "block", "payload"), _ids, "side int, block int, place int, id string")
    places = named.join(ids.toDF("id"), "id", "left_semi").groupBy("side", "block").agg(F.collect_list("place").alias("flagged"))
    return blocked.join(F.broadcast(written(places, "flagged")), ["side", "block"], "left")  # four bytes a record


def cells(blocked: DataFrame) -> DataFrame:
    """payload1, payload2 (and about1, about2, flagged1, flagged2): each block of source 1 with each of the targets, without a shuffle."""
    more = [c for c in ("about", "flagged") if c in blocked.columns]
    side = lambda n: blocked.where(F.col("side") == n - 1).select(*[F.col(c).alias(f"{c}{n}") for c in ("payload", *more)])
    rows = side(1).hint("shuffle_replicate_nl").crossJoin(side(2))
    return rows.select(*[f"{c}{n}" for c in ("payload", *more) for n in (1, 2)])


def mapped(blocked: DataFrame, mode: str, made: Callable, schema: str) -> DataFrame:
    """What ``made`` makes, as batches, of each cell: its two sides, the pairs of ``cell_pairs``, and the sides' ``about`` and ``flagged`` (places) if there are."""

    def read(value):
        if not isinstance(value, bytes):
            return np.array(value or (), np.int64)
        plain, sets = _unpack(value)
        return plain, {k: _set_of(*x) for k, x in sets.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                left, right = (_unpack(column[i].as_py()) for column in batch.columns[:2])
                more = [read(column[i].as_py()) for column in batch.columns[2:]]
                yield from made(left, right, cell_pairs(left, right, mode), more)
                del left, right, more
                _release()

    return _map(cells(blocked), run, schema)


def _pairs(left: tuple, right: tuple, found: Iterator[tuple], _) -> Iterator[pa.RecordBatch]:
    tag1, tag2 = left[3], right[3]
    for lefts, rights, masks in found:
        if len(lefts):
            tagged = (tag1[lefts] == tag2[rights]) & (tag1[lefts] != NO_TAG)
            columns = [left[0].take(pa.array(lefts)), right[0].take(pa.array(rights)), pa.array(right[2][rights], pa.int32()), pa.array(masks.astype(np.int32)), pa.array(tagged)]
            yield pa.RecordBatch.from_arrays(columns, ["s1", "t", "source", "mask", "tagged"])


def pairs(blocked: DataFrame, mode: str) -> DataFrame:
    """s1, t, target_source, mask, tagged (both have the same tag) of all pairs of ``blocks`` whose countries agree, each once if ids are."""
    rows = mapped(blocked, mode, _pairs, "s1 string, t string, source int, mask int, tagged boolean")
    return rows.select("s1", "t", source_name(F.col("source")).alias("target_source"), "mask", "tagged")


def source_name(source: Column) -> Column:
    return F.when(source == 2, "Source 2").otherwise("Source 3")
