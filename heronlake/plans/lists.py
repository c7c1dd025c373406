"""Sorted lists of ids that travel in few bytes.

Where every row of one table meets a whole list of another, rows of id pairs
fill the disk: each pair is shuffled with its key.  Here a list is packed once,
as differences of seven bits a byte, and moves whole to the tasks that need it:
for each of them once, whatever the number of rows there that use it.  Rows are
dealt by a hash of the group they are counted for to ``slots``, several to a
partition; all that leaves a task for a slot is one compressed block.  A task
sorts its blocks by slot (Spark does, and spills), unpacks one slot at a time
and counts a bounded number of list entries at once, so nothing of the product
is ever written.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# Types of ids that can be packed.
WHOLE = {"tinyint", "smallint", "int", "bigint"}
BLOCK = "slot int, head int, size int, body binary"
# Slots of a partition.
SLOTS = 4
# Ids in one packed list; longer ones are several.
LONGEST = 4096
# Rows, and bytes of lists, that a task packs at once.
ROWS, BYTES = 1 << 19, 32 << 20
# Bytes of lists that are unpacked and counted at once.
CHUNK = 1 << 20
# Places of an id that are looked at together.
STRETCH = 64
# Rows of an Arrow batch that is handed back.
BATCH = 1 << 17


def packed(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of whole numbers (uint64), low seven bits first, and where each number ends."""
    width = np.ones(len(values), np.int64)
    for k in range(1, 10):
        more = values >= np.uint64(1 << 7 * k)
        if not more.any():
            break
        width += more
    ends = np.cumsum(width)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    starts = ends - width
    for k in range(int(width.max(initial=0))):
        at = np.flatnonzero(width > k) if k else slice(None)
        part = (values[at] >> np.uint64(7 * k)) & np.uint64(127)
        out[starts[at] + k] = part.astype(np.uint8) | (width[at] > k + 1).astype(np.uint8) << 7
    return out, ends


def unpacked(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of :func:`packed`, and where each ends in the bytes."""
    ends = np.flatnonzero(data < 128) + 1
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    width, out = ends - starts, (data[starts] & 127).astype(np.uint64)
    for k in range(1, int(width.max(initial=0))):
        at = np.flatnonzero(width > k)
        out[at] |= (data[starts[at] + k] & 127).astype(np.uint64) << np.uint64(7 * k)
    return out, ends


def zigzag(values: np.ndarray) -> np.ndarray:
    """Signed numbers as unsigned ones, small where they are near zero."""
    return ((values << 1) ^ (values >> 63)).view(np.uint64)


def unzigzag(values: np.ndarray) -> np.ndarray:
    return ((values >> np.uint64(1)) ^ (np.uint64(0) - (values & np.uint64(1)))).view(np.int64)


def slot_of(ids: np.ndarray, slots: int) -> np.ndarray:
    mixed = ids.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(33)).astype(np.int64) % slots


def _edges(*sorted_columns: np.ndarray) -> np.ndarray:
    """Where a new value begins along sorted columns."""
    n = len(sorted_columns[0])
    fresh = np.zeros(n, bool)
    fresh[:1] = True
    for c in sorted_columns:
        fresh[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(fresh)


def _longs(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a column of whole numbers, 0 for null, and which are null."""
    gone = column.is_null().to_numpy(zero_copy_only=False)
    return np.ascontiguousarray(column.fill_null(0).to_numpy(zero_copy_only=False)), gone


def _gathered(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Batches put together up to a number of rows."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield pa.concat_batches(held)
            held, n = [], 0
    if n:
        yield pa.concat_batches(held)


def _blocks(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    columns = [
        pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()),
        pa.array([len(r[2]) for r in rows], pa.int32()), pa.array([pa.compress(r[2], "zstd", asbytes=True) for r in rows], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["slot", "head", "size", "body"])


def _column(sizes: np.ndarray, data: np.ndarray) -> pa.Array:
    """Lists that lie one after the other as a column."""
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def _taken(lists: pa.Array, which: np.ndarray) -> np.ndarray:
    """Bytes of the chosen lists, one after the other."""
    body = lists.take(pa.array(which)).buffers()[2]
    return np.zeros(0, np.uint8) if body is None else np.frombuffer(body, np.uint8)


def _between(data: np.ndarray, ends: np.ndarray, low: int, high: int) -> bytes:
    """Bytes of the packed numbers from ``low`` up to ``high``."""
    return data[(ends[low - 1] if low else 0) : (ends[high - 1] if high else 0)].tobytes()


def _row_blocks(kind: int, slot: np.ndarray, ids: np.ndarray, others: list[np.ndarray], gone: np.ndarray) -> pa.RecordBatch:
    """Rows (id, others ..) as blocks for their slots; copies that meet are one.  ``gone`` marks a null in the last column."""
    order = np.lexsort((others[-1], gone, *others[-2::-1], ids, slot))
    order = order[_edges(*[c[order] for c in (slot, ids, *others, gone)])]
    slot, ids, gone = slot[order], ids[order], gone[order]
    starts = _edges(slot)
    step = np.diff(ids, prepend=0)
    step[starts] = ids[starts]
    streams = [packed(zigzag(step)), packed(gone.astype(np.uint64)), *[packed(zigzag(c[order])) for c in others]]
    bounds = [*starts.tolist(), len(slot)]
    return _blocks([(int(slot[a]), kind, b"".join(_between(*s, a, b) for s in streams)) for a, b in zip(bounds, bounds[1:])])


def _rows(blocks: list[np.ndarray], others: int = 1) -> list[np.ndarray]:
    """The distinct rows of blocks in order, null first: the id, the other columns, whether the last is null."""
    width = others + 2
    found = [np.split(unpacked(data)[0], width) for data in blocks] or [[np.zeros(0, np.uint64)] * width]
    ids = np.concatenate([np.cumsum(unzigzag(f[0])) for f in found])
    gone = np.concatenate([f[1] for f in found]).astype(bool)
    columns = [unzigzag(np.concatenate([f[k] for f in found])) for k in range(2, width)]
    order = np.lexsort((columns[-1], ~gone, *columns[-2::-1], ids))
    order = order[_edges(*[c[order] for c in (ids, *columns, gone)])]
    return [c[order] for c in (ids, *columns, gone)]


def pack_pairs(kind: int, slots: int, rows: int) -> Callable:
    """Pairs (id, other) of a kind as blocks for the slot of the id."""

    def run(batches):
        for batch in _gathered(batches, rows):
            ids, (others, gone) = _longs(batch.column(0))[0], _longs(batch.column(1))
            yield _row_blocks(kind, slot_of(ids, slots), ids, [others], gone)

    return run


def pack_places(slots: int, rows: int, stretch: int) -> Callable:
    """Rows (id, place, value) as blocks for the slot of a stretch of places of the id.

    The first place of a stretch goes to the stretch before as well, so neighbours meet.
    """

    def run(batches):
        for batch in _gathered(batches, rows):
            ids, places, values = (_longs(c)[0] for c in batch.columns)
            # half a stretch on, so places around zero are in one and are sent once
            part, into = np.divmod(places + (stretch // 2 - 1), stretch)
            twice = np.flatnonzero(into == 0)
            rows_of = np.concatenate([np.arange(len(ids)), twice])
            part = np.concatenate([part, part[twice] - 1])
            ids, places, values = ids[rows_of], places[rows_of], values[rows_of]
            slot = slot_of(ids + part * np.int64(0x632BE59BD9B4E019), slots)
            yield _row_blocks(0, slot, ids, [places, values], np.zeros(len(ids), bool))

    return run


def pair_places(rows: int) -> Callable:
    """Blocks of places to pairs of different values on neighbouring places of an id, the smaller first."""

    def run(batches):
        for blocks in _by_slot(batches):
            ids, places, values, _ = _rows([data for _, data in blocks], 2)
            first = _edges(ids, places)
            ends = np.append(first[1:], len(ids))
            near = np.flatnonzero((ids[first[1:]] == ids[first[:-1]]) & (places[first[1:]] - 1 == places[first[:-1]]))
            n, m = (ends - first)[near], (ends - first)[near + 1]
            left = _ranges(first[near], n)
            start, size = np.repeat(first[near + 1], n), np.repeat(m, n)
            done, a = np.cumsum(size), 0
            while a < len(left):
                b = max(a + 1, int(np.searchsorted(done, (done[a - 1] if a else 0) + rows, side="right")))
                x, y = np.repeat(values[left[a:b]], size[a:b]), values[_ranges(start[a:b], size[a:b])]
                x, y = np.minimum(x, y)[x != y], np.maximum(x, y)[x != y]
                yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], ["user1_id", "user2_id"])
                a = b

    return run


def distinct_pairs(most: int) -> Callable:
    """Blocks of pairs to the pairs themselves, each once."""

    def run(batches):
        for blocks in _by_slot(batches):
            x, y, _ = _rows([data for _, data in blocks])
            for start in range(0, len(x), most):
                yield pa.RecordBatch.from_arrays([pa.array(x[start : start + most]), pa.array(y[start : start + most])], ["user1_id", "user2_id"])

    return run


def _lists(ids: np.ndarray, items: np.ndarray, gone: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed lists of sorted pairs: their ids, their lengths in bytes, the bytes.

    A list begins with twice its number of items, and one more where null is among them.
    """
    first = _edges(ids)
    rank = np.arange(len(ids)) - np.repeat(first, np.diff(first, append=len(ids)))
    heads = np.flatnonzero(rank % longest == 0)
    which = np.repeat(np.arange(len(heads)), np.diff(heads, append=len(ids)))
    n, null = np.bincount(which[~gone], minlength=len(heads)), np.bincount(which[gone], minlength=len(heads))
    items, which = items[~gone], which[~gone]
    steps = np.diff(items, prepend=0).view(np.uint64)
    opening = _edges(which)
    steps[opening] = zigzag(items[opening])
    at = np.cumsum(n + 1) - n - 1
    stream = np.empty(len(items) + len(heads), np.uint64)
    stream[at] = 2 * n + null
    stream[np.arange(len(items)) + which + 1] = steps
    data, ends = packed(stream)
    return ids[heads], np.diff(ends[at + n], prepend=0), data


def _use_blocks(slots: int, who: np.ndarray, marks: np.ndarray, which: np.ndarray, sizes: np.ndarray, lists: pa.Array) -> pa.RecordBatch:
    """Uses of lists as blocks for the slot of the group; within a block a list is there once."""
    slot = slot_of(who, slots)
    order = np.lexsort((who, which, slot))
    heads = _edges(slot[order], which[order])
    uses = np.diff(heads, append=len(order))
    # lists in the order of their first groups, so groups grow in small steps
    by = np.lexsort((who[order[heads]], slot[order[heads]]))
    chosen, uses = which[order[heads[by]]], uses[by]
    order, heads = order[_ranges(heads[by], uses)], np.cumsum(uses) - uses
    slot, who, marks = slot[order], who[order], marks[order]
    begin, out = _edges(slot), []
    step = np.diff(who, prepend=0)
    step[begin] = who[begin]
    data, sizes = _taken(lists, chosen), sizes[chosen]
    ends = np.concatenate([[0], np.cumsum(sizes)])
    uses, size = packed(uses.astype(np.uint64)), packed(sizes.astype(np.uint64))
    who, marks = packed(zigzag(step)), packed(marks)
    bounds = [*begin.tolist(), len(slot)]
    at = np.searchsorted(heads, bounds).tolist()
    for k, (a, b) in enumerate(zip(bounds, bounds[1:])):
        low, high = at[k], at[k + 1]
        head = b"".join([
            packed(np.array([high - low], np.uint64))[0].tobytes(), _between(*uses, low, high), _between(*size, low, high),
            _between(*who, a, b), _between(*marks, a, b),
        ])
        out.append((int(slot[a]), len(head), head + data[ends[low] : ends[high]].tobytes()))
    return _blocks(out)


def _by_slot(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[int, np.ndarray]]]:
    """The blocks of one slot after the other, as (length of the head, bytes)."""
    now, held = None, []
    for batch in batches:
        for slot, head, size, body in zip(*[c.to_pylist() for c in batch.columns]):
            if slot != now and held:
                yield held
                held = []
            now = slot
            held.append((head, np.frombuffer(pa.decompress(body, size, "zstd", asbytes=True), np.uint8)))
    if held:
        yield held


# Kinds of pairs.
ITEM, GROUP = 0, 1


def pack_uses(slots: int, longest: int, rows: int, most: int) -> Callable:
    """Blocks of pairs (id, item) and (id, group) to blocks of uses: each group with the list of the id.

    An id's list goes to the group of the same number as well, marked as its own.
    """

    def sent(held):
        who, marks, sizes, data = (np.concatenate(c) for c in list(zip(*held))[:4])
        first = np.cumsum([0, *[len(h[2]) for h in held]]).tolist()
        which = np.concatenate([h[4] + k for h, k in zip(held, first)])
        lists, done, a = _column(sizes, data), np.cumsum(sizes[which]), 0
        while a < len(who):
            b = int(np.searchsorted(done, (done[a - 1] if a else 0) + most, side="right"))
            b = min(max(a + 1, b), a + rows)
            yield _use_blocks(slots, who[a:b], marks[a:b], which[a:b], sizes, lists)
            a = b

    def run(batches):
        held, n, size = [], 0, 0
        for blocks in _by_slot(batches):
            ids, lengths, data = _lists(*_rows([data for kind, data in blocks if kind == ITEM]), longest)
            friend, group, none = _rows([data for kind, data in blocks if kind == GROUP])
            low, high = np.searchsorted(ids, friend), np.searchsorted(ids, friend, side="right")
            which = _ranges(low, high - low)
            who = np.concatenate([np.repeat(group, high - low), ids])
            marks = np.concatenate([np.repeat(none, high - low).astype(np.uint64) * np.uint64(2), np.ones(len(ids), np.uint64)])
            which = np.concatenate([which, np.arange(len(ids))])
            held.append((who, marks, lengths, data, which))
            n, size = n + len(who), size + int(lengths[which].sum())
            if n >= rows or size >= most:
                yield from sent(held)
                held, n, size = [], 0, 0
        if n:
            yield from sent(held)

    return run


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places start, start + 1 .. of all ranges, one after the other."""
    return np.arange(int(sizes.sum())) + np.repeat(starts - np.cumsum(sizes) + sizes, sizes)


def _entries(data: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Items of packed lists, number of items of each and whether it holds null."""
    numbers, ends = unpacked(data)
    at = np.searchsorted(ends, np.cumsum(sizes) - sizes, side="right")
    n, null = (numbers[at] >> np.uint64(1)).astype(np.int64), (numbers[at] & np.uint64(1)).astype(bool)
    numbers[at] = 0
    some = at[n > 0] + 1
    numbers[some] = unzigzag(numbers[some]).view(np.uint64)
    sums = np.cumsum(numbers)
    values = (sums - np.repeat(sums[at], n + 1)).view(np.int64)
    keep = np.ones(len(values), bool)
    keep[at] = False
    return values[keep], n, null


def _counted(group: np.ndarray, item: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, ...]:
    """Each (group, item) once, in order: how often it is there, and whether a row of its own is."""
    if not len(item):
        return group, item, np.zeros(0, np.int64), np.zeros(0, bool)
    low, known = item.min(), None
    place = item.view(np.uint64) - low.view(np.uint64)
    bits = int(place.max()).bit_length()
    if bits + int(group[-1]).bit_length() > 62:
        known, place = np.unique(item, return_inverse=True)
        place, bits = place.astype(np.uint64), len(known).bit_length()
    key = np.sort(((group.astype(np.uint64) << np.uint64(bits) | place) << np.uint64(1)) | own.astype(np.uint64))
    pair = key >> np.uint64(1)
    starts = _edges(pair)
    ends = np.append(starts[1:], len(pair))
    pair = pair[starts]
    place = pair & np.uint64((1 << bits) - 1)
    item = (place + low.view(np.uint64)).view(np.int64) if known is None else known[place.astype(np.int64)]
    return (pair >> np.uint64(bits)).astype(np.int64), item, ends - starts, (key[ends - 1] & np.uint64(1)).astype(bool)


def _joined(before: tuple[np.ndarray, ...], now: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
    """Counts of one group from two places: (item, count, own)."""
    item, back = np.unique(np.concatenate([before[0], now[0]]), return_inverse=True)
    count, own = np.zeros(len(item), np.int64), np.zeros(len(item), bool)
    np.add.at(count, back, np.concatenate([before[1], now[1]]))
    np.logical_or.at(own, back, np.concatenate([before[2], now[2]]))
    return item, count, own


def count_uses(chunk: int, most: int) -> Callable:
    """Blocks of uses to (group, item, count): rows whose list has the item, without items of the group's own lists.

    Null is an item of nobody's own.
    """

    def run(batches):
        for blocks in _by_slot(batches):
            who, marks, which, sizes, lists, m = [], [], [], [], [], 0
            for head, data in blocks:
                numbers = unpacked(data[:head])[0]
                n = int(numbers[0])
                uses, size = numbers[1 : n + 1].astype(np.int64), numbers[n + 1 : 2 * n + 1]
                rest = numbers[2 * n + 1 :].reshape(2, -1)
                who.append(np.cumsum(unzigzag(rest[0])))
                marks.append(rest[1].astype(np.int64))
                which.append(np.repeat(np.arange(m, m + n), uses))
                sizes.append(size.astype(np.int64))
                lists.append(data[head:])
                m += n
            who, marks, which, sizes = map(np.concatenate, (who, marks, which, sizes))
            lists = _column(sizes, np.concatenate(lists))
            order = np.lexsort((who, marks >> 1))
            who, marks, which = who[order], marks[order], which[order]
            first = _edges(who, marks >> 1)
            group = np.repeat(np.arange(len(first)), np.diff(first, append=len(who)))
            done = np.cumsum(sizes[which])
            a, held, held_null = 0, None, 0
            while a < len(who):
                b = max(a + 1, int(np.searchsorted(done, (done[a - 1] if a else 0) + chunk, side="right")))
                base, last = group[a], group[b - 1]
                items, n, null = _entries(_taken(lists, which[a:b]), sizes[which[a:b]])
                at, own = group[a:b] - base, (marks[a:b] & 1).astype(bool)
                nulls = np.bincount(at[null & ~own], minlength=last - base + 1)
                g, item, count, mine = _counted(np.repeat(at, n), items, np.repeat(own, n))
                if held is not None:  # the first group began in the chunk before
                    k = int(np.searchsorted(g, 0, side="right"))
                    i, c, o = _joined(held, (item[:k], count[:k], mine[:k]))
                    g, item = np.concatenate([np.zeros(len(i), np.int64), g[k:]]), np.concatenate([i, item[k:]])
                    count, mine = np.concatenate([c, count[k:]]), np.concatenate([o, mine[k:]])
                    nulls[0] += held_null
                    held, held_null = None, 0
                if b < len(who) and group[b] == last:
                    k = int(np.searchsorted(g, last - base))
                    held, held_null = (item[k:], count[k:], mine[k:]), int(nulls[-1])
                    g, item, count, mine, nulls[-1] = g[:k], item[:k], count[:k], mine[:k], 0
                g, item, count, some = g[~mine], item[~mine], count[~mine], np.flatnonzero(nulls)
                row = first[base + np.concatenate([g, some])]
                columns = [
                    pa.array(who[row], mask=marks[row] >= 2),
                    pa.concat_arrays([pa.array(item), pa.nulls(len(some), pa.int64())]),
                    pa.array(np.concatenate([count, nulls[some]]).astype(np.int64)),
                ]
                out = pa.RecordBatch.from_arrays(columns, ["group", "item", "count"])
                for start in range(0, out.num_rows, most):
                    yield out.slice(start, most)
                a = b

    return run


def _dealt(blocks: DataFrame, parts: int) -> DataFrame:
    return blocks.repartitionById(parts, F.pmod("slot", F.lit(parts)).cast("int")).sortWithinPartitions("slot")


def _parts(df: DataFrame) -> int:
    return max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))


def neighbour_pairs(rows: DataFrame) -> DataFrame:
    """Pairs of different values on neighbouring places of an id, of rows (id, place, value) of whole numbers without nulls.

    The outcome is (user1_id, user2_id), the smaller first, each pair once.  A
    row moves once and packed, to a stretch of 64 places of its id, and so does
    a pair, to its copies from other ids.
    """
    parts = _parts(rows)
    slots = parts * SLOTS
    longs = rows.select(*[F.col(c).cast("long") for c in ("id", "place", "value")])
    blocks = _dealt(longs.mapInArrow(pack_places(slots, ROWS, STRETCH), BLOCK), parts)
    near, pack = pair_places(BATCH), pack_pairs(0, slots, ROWS)
    pairs = _dealt(blocks.mapInArrow(lambda batches: pack(near(batches)), BLOCK), parts)
    return pairs.mapInArrow(distinct_pairs(BATCH), "user1_id long, user2_id long")


def count_by_lists(links: DataFrame, pairs: DataFrame) -> DataFrame:
    """How many of a group's ids have an item that the group itself has not.

    ``links`` holds (id, group), ``pairs`` (id, item), both with repeats as
    they come and of whole numbers.  The outcome is (group, item, count).
    A null id has no items, a null group has none of its own, and a null item
    is counted as a value that nobody has of their own.  What concerns one
    slot has to fit in a task's memory in packed form, a byte or two an entry.
    """
    parts = _parts(links)
    slots = parts * SLOTS
    known = lambda df, other: df.where("id is not null").select(F.col("id").cast("long"), F.col(other).cast("long"))
    items = known(pairs, "item").mapInArrow(pack_pairs(ITEM, slots, ROWS), BLOCK)
    groups = known(links, "group").mapInArrow(pack_pairs(GROUP, slots, ROWS), BLOCK)
    uses = _dealt(items.unionAll(groups), parts).mapInArrow(pack_uses(slots, LONGEST, ROWS, BYTES), BLOCK)
    return _dealt(uses, parts).mapInArrow(count_uses(CHUNK, BATCH), "group long, item long, count long")
