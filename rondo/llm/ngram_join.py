"""N-gram Jaccard join by parity sketches: groups of documents whose shingle sets overlap by a given share.

A document is the set of its distinct word shingles. Per size band, its sketch is a row of 64-bit words: every shingle
XORs its hash into the one word its upper bits select. Two sets that differ in d shingles differ in at most d words, so
the words that differ bound the symmetric difference from below. A band bounds the symmetric difference of the pairs it
has to find by D and uses more than D words, so by the pigeonhole principle any such pair has equal words, and documents
are joined on (band, position, word). Every candidate is verified on the whole texts.

Which words to join on: a document with F filled words shares at least F - D of them with a partner, so it is enough
that both send their D + 1 rarest filled words, by one order of all words. Words nobody else has are the rarest, so a
document that was changed a lot sends none, and the words a large group has in common are sent by few of its members.
A document with D filled words or fewer sends all its words, the empty ones too.

Candidates are then compared by a second parity sketch, in which every shingle flips one of about as many bits as the
set has members: its Hamming distance, too, bounds the symmetric difference from below, and leaves few wrong pairs.
Only those are verified on the texts.

No group is ever expanded into its pairs. Equal texts are one class from the start. In the first rounds each group, at
first a class, is verified against one other group by one pair; groups at least halve in number each time, and nearly all
of what belongs together is joined. In the last round all classes that share a word with a class of another group and pass the sketches
with it get their shingle sets, and are verified where they meet: a task puts out a spanning forest of the links it finds, so no
link between groups is missed and no more rows are made than there are classes. Lists of classes that share a word are cut into blocks,
and blocks are compared in tasks of their own. Memory is bounded by one shuffle bucket, whose number follows the data (but the
holders of one sketch word meet in one of them, 16 bytes a class), and two blocks or two parts of sets of ``SET_BYTES``. A set is copied to each list its class is in, or to each part of the cluster of all
classes that such lists connect, whichever is less.

Defined cases: null and empty texts have an empty set, and are linked with nothing, not even each other. Rows that share
an id but not the text are documents of their own, each compared by its own text; rows that share both are one. Rows with
a null id have their set's size and are linked with nothing. Extra columns are ignored. An empty table gives an empty
result.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache, partial
from itertools import count as numbers

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rondo.llm import bloom, exact_dedup
from rondo.llm.components import components
from rondo.llm.store import stored, unused
from rondo.llm.words import mix, shingle_sets

_U = np.uint64
#: Sketch words in one shuffle bucket, about; 16 bytes each.
BUCKET = 400_000
#: Rounds that verify one pair for each group, before all classes left are compared.
ROUNDS = 3
#: Bits of the second sketch, at most; a longer set's sketch is as valid, and passes more wrong pairs.
MOST_BITS = 4096
#: Members up to which a block is compared pair by pair.
FEW = 12
#: Members of one block of a candidate list, about.
BLOCK = 4096
#: Bytes of the shingle sets that the last round compares in one task, about.
SET_BYTES = 16 << 20
#: Sketch words for each shingle of a band's largest set, as a fraction, or D + 1 and a tenth more if those are more.
WORDS = 1, 5


def bands(num: int, den: int, largest: int) -> list[int]:
    """Lower ends of the size bands: a set in one band links only with sets of that band and its neighbours."""
    out = [1]
    while out[-1] <= largest:
        out.append(max(out[-1] + 1, (out[-1] - 1) * den // num + 1))
    return [*out, (out[-1] - 1) * den // num + 1]


def difference(a: int, b: int, num: int, den: int) -> int:
    """The most shingles in which linked sets of these sizes, or smaller ones, can differ."""
    return (a + b) * (den - num) // (den + num)


@lru_cache(4096)
def _edges(count: int) -> np.ndarray:
    """Where a range of all 64-bit numbers is cut into ``count`` equal parts."""
    return np.array([i * (1 << 64) // count for i in range(1, count)], _U)


def sketch_keys(hashes: np.ndarray, num: int, den: int, lows: list[int]) -> tuple[np.ndarray, list[int]]:
    """Join keys of one set: a hash of (band, position, word) for its band and for the one below.

    The last bit of a key is that of its band. Also, by that bit, how many keys more than all must be sent (below zero:
    fewer).
    """
    size, out, more = len(hashes), [], [0, 0]
    own = bisect_right(lows, size) - 1
    for band in (own, own - 1):
        if band < 0:
            continue
        top = lows[band + 1] - 1
        partner = size * den // num if band == own else top
        if band != own and partner * den < size * num:
            continue  # too large for any partner in the band below
        most = difference(size, partner, num, den)
        least = difference(top, top * den // num, num, den) + 1
        count = max(least + (1 + least // 10 if least > 1 else 0), top * WORDS[0] // WORDS[1])
        cuts = np.searchsorted(hashes, _edges(count))
        running = np.append(_U(0), np.bitwise_xor.accumulate(mix(hashes)))
        at = np.concatenate(([0], cuts, [size]))
        words = running[at[1:]] ^ running[at[:-1]]
        filled = at[1:] > at[:-1]
        place = np.arange(count, dtype=_U) + _U(band << 32)
        keys = (mix(words ^ mix(place + _U(1))) & ~_U(1)) | _U(band & 1)
        more[band & 1] = most + 1 - int(filled.sum())
        out.append(keys if more[band & 1] > 0 else keys[filled])
    return np.concatenate(out), more


_PACKED = "bucket int, kind int, a binary, b binary, c binary, d binary"
_KEYS, _SETS = 0, 1
_EMPTY = np.zeros(0, np.int64)


def _bits(size: int) -> int:
    """Bits in the second sketch of a set of this size: half as many or more, up to a number that bounds every row."""
    return min(MOST_BITS, max(64, 1 << max(0, int(size).bit_length() - 1)))


def _flip(hashes: np.ndarray) -> bytes:
    bits = _bits(len(hashes))
    flips = np.bincount((mix(hashes ^ _U(0x5851F42D4C957F2D)) & _U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(flips.astype(np.uint8), bitorder="little").tobytes()


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 4]
    names = ["bucket", "kind", "a", "b", "c", "d"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def _packed(kind: int, buckets: int, by: np.ndarray, columns: list[np.ndarray], sketches: list[bytes] | None = None):
    """The columns' values and the sketches, a row for each bucket that ``by`` names."""
    if not len(by):
        return
    to = (mix(by.view(_U)) % _U(buckets)).astype(np.int32)
    order = np.argsort(to, kind="stable")
    columns, to = [c[order] if len(c) else c for c in columns], to[order]
    marks = np.flatnonzero(np.diff(to)) + 1
    spans = list(zip(np.append(0, marks), np.append(marks, len(to))))
    bits = lambda s, e: b"".join(sketches[i] for i in order[s:e]) if sketches else b""
    for at in range(0, len(spans), 1000):
        part = spans[at : at + 1000]
        yield _rows([(int(to[s]), kind, *(c[s:e].tobytes() for c in columns), bits(s, e)) for s, e in part])


def _cut(sketches: bytes, sizes: np.ndarray) -> list[bytes]:
    lengths = np.array([_bits(n) // 8 for n in sizes], np.int64)
    ends = np.cumsum(lengths)
    return [sketches[e - n : e] for e, n in zip(ends, lengths)]


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[int, list]]:
    """The columns and sketches of each bucket, by kind; the input is ordered by bucket."""
    at, held = None, {}

    def joined() -> dict[int, list]:
        return {k: [*(np.concatenate(c) for c in list(zip(*p))[:3]), b"".join(x[3] for x in p)] for k, p in held.items()}

    for batch in batches:
        for bucket, kind, *columns, sketches in zip(*(batch.column(i).to_pylist() for i in range(6))):
            if bucket != at and held:
                yield joined()
                held = {}
            at = bucket
            held.setdefault(kind, []).append([*(np.frombuffer(c, np.int64) for c in columns), sketches])
    if held:
        yield joined()


def _sketch(num: int, den: int, size: int, buckets: int):
    """Keys of every class (key, id, -) by key, and by id (id, set size, words to send beyond all in two bands; sketch)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lows = bands(num, den, 1 << 12)
        for batch in batches:
            ids = batch.column("id").to_numpy(zero_copy_only=False).astype(np.int64)
            sizes, more, sketches = np.zeros(len(ids), np.int64), np.zeros((len(ids), 2), np.int32), []
            keys, owners, held = [], [], 0

            def so_far() -> Iterator[pa.RecordBatch]:
                every = np.concatenate(keys)  # noqa: B023
                return _packed(_KEYS, buckets, every, [every, np.concatenate(owners), _EMPTY])  # noqa: B023

            for i, hashes in enumerate(shingle_sets(batch.column("text"), size)):
                sizes[i] = len(hashes)
                sketches.append(_flip(hashes))
                if not len(hashes):
                    continue
                if len(hashes) >= lows[-3]:
                    lows = bands(num, den, 2 * len(hashes))
                with np.errstate(over="ignore"):
                    own, more[i] = sketch_keys(hashes, num, den, lows)
                keys.append(own.view(np.int64))
                owners.append(np.full(len(own), ids[i]))
                held += len(own)
                if held >= BUCKET:
                    yield from so_far()
                    keys, owners, held = [], [], 0
            if held:
                yield from so_far()
            counts = np.ascontiguousarray(more).view(np.int64).ravel()
            yield from _packed(_SETS, buckets, ids, [ids, sizes, counts], sketches)

    return run


def _shared(buckets: int):
    """Keys that two classes or more have (key, id, how many have it) by id; sets pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in _by_bucket(batches):
            if _SETS in found:
                *columns, sketches = found[_SETS]
                yield from _packed(_SETS, buckets, columns[0], columns, _cut(sketches, columns[1]))
            if _KEYS not in found:
                continue
            keys, ids, _, _ = found[_KEYS]
            order = np.lexsort((ids, keys))
            keys, ids = keys[order], ids[order]
            new = np.append(True, (keys[1:] != keys[:-1]) | (ids[1:] != ids[:-1]))
            keys, ids = keys[new], ids[new]
            first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            run = np.diff(np.append(first, len(keys)))
            times = np.repeat(run, run)
            some = times > 1
            yield from _packed(_KEYS, buckets, ids[some], [keys[some], ids[some], times[some]])

    return run


_SENT = "key long, parts int, part int, id long, n long, alone long, bits binary"


def _rarest(batches: Iterator[pa.RecordBatch], block: int) -> Iterator[pa.RecordBatch]:
    """A row for each key a class sends: (key, parts of the key's list, part, id, set size, own keys, sketch).

    Also a row for each class, without a key.
    """
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    names = ["key", "parts", "part", "id", "n", "alone", "bits"]
    for found in _by_bucket(batches):
        known, sizes, more, sketches = found[_SETS]
        none = [pa.nulls(len(known), kind) for kind in kinds]
        none[3:5] = pa.array(known), pa.array(sizes)
        yield pa.RecordBatch.from_arrays(none, names)
        if _KEYS not in found:
            continue
        sketches = _cut(sketches, sizes)
        by = np.argsort(known, kind="stable")
        known, sizes, more = known[by], sizes[by], more[by].view(np.int32).reshape(-1, 2)
        keys, ids, times, _ = found[_KEYS]
        band = keys & 1
        order = np.lexsort((keys, times, band, ids))
        keys, ids, band, times = keys[order], ids[order], band[order], times[order]
        first = np.flatnonzero(np.append(True, (ids[1:] != ids[:-1]) | (band[1:] != band[:-1])))
        run = np.diff(np.append(first, len(keys)))
        place = np.arange(len(keys)) - np.repeat(first, run)
        own = np.searchsorted(known, ids[first])
        beyond = more[own, band[first]].astype(np.int64)
        sent = np.flatnonzero(place < np.repeat(np.where(beyond > 0, run, run + beyond), run))
        group = np.repeat(np.arange(len(run)), run)[sent]
        whose = own[group]
        parts = ((times[sent] - 1) // block + 1).astype(np.int32)
        part = (mix(ids[sent].view(_U)) % parts.astype(_U)).astype(np.int32)
        alone = np.maximum(-beyond, 0)[group]
        for at in range(0, len(sent), 20_000):
            cut = slice(at, at + 20_000)
            bits = [sketches[by[i]] for i in whose[cut]]
            columns = [keys[sent][cut], parts[cut], part[cut], ids[sent][cut], sizes[whose][cut], alone[cut], bits]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)


def _matrix(bits: list[bytes]) -> np.ndarray:
    """Sketches as rows of 64-bit words, folded to the shortest: folding keeps a parity sketch one."""
    width = min(map(len, bits), default=8) // 8
    out = np.empty((len(bits), width), _U)
    for i, b in enumerate(bits):
        out[i] = np.bitwise_xor.reduce(np.frombuffer(b, _U).reshape(-1, width), axis=0)
    return out


def _apart(a: bytes, b: bytes) -> int:
    """Hamming distance of two sketches, the longer one folded."""
    while len(a) != len(b):
        a, b = sorted((a, b), key=len)
        half = len(b) // 2
        b = (int.from_bytes(b[:half]) ^ int.from_bytes(b[half:])).to_bytes(half)
    return (int.from_bytes(a) ^ int.from_bytes(b)).bit_count()


def _close(left: np.ndarray, right: np.ndarray, n_left: np.ndarray, n_right: np.ndarray, num: int, den: int) -> np.ndarray:
    """Which pairs of rows may link, by their sizes and sketches."""
    ok = (np.minimum.outer(n_left, n_right) * den) >= (np.maximum.outer(n_left, n_right) * num)
    apart = np.zeros(ok.shape, np.int64)
    for w in range(left.shape[1]):
        apart += np.bitwise_count(left[:, w, None] ^ right[None, :, w])
    return ok & (apart <= np.add.outer(n_left, n_right) * (den - num) // (den + num))


_PAIRS = "a long, b long, la long, lb long"


def _candidates(num: int, den: int):
    """Pairs (a, b) of classes in two blocks of one list, of different groups, that may link: one for each group but the most central."""
    names = ["a", "b", "la", "lb"]

    def few(members: list[dict]) -> Iterator[tuple[int, int, int, int]]:
        """Pairs of a short block, without the cost of making arrays."""
        met: set[int] = set()
        for at, one in enumerate(members):
            if one["label"] in met:
                continue
            for other in members[:at]:
                low, high = sorted((one["n"], other["n"]))
                if one["label"] == other["label"] or low * den < high * num:
                    continue
                if _apart(one["bits"], other["bits"]) <= difference(low, high, num, den):
                    yield one["id"], other["id"], one["label"], other["label"]
                    met.add(one["label"])
                    break

    def many(members: list[dict], others: list[dict], same: bool) -> Iterator[tuple[int, int, int, int]]:
        (ids, labels, _), (ids2, labels2, _) = _columns(members), _columns(others)
        met: set[int] = set()
        for at, ok in _close_tiles(members, others, num, den):
            if same:
                ok &= np.arange(at, at + len(ok))[:, None] > np.arange(len(ids2))[None, :]
            rows = np.flatnonzero(ok.any(1))
            rows = np.array([r for r in rows if (x := int(labels[r + at])) not in met and not met.add(x)], np.int64)
            i, j = rows + at, ok[rows].argmax(1)
            yield from zip(ids[i].tolist(), ids2[j].tolist(), labels[i].tolist(), labels2[j].tolist())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = lambda m: (m["alone"], m["id"])
        for batch in batches:
            out: list[tuple[int, int, int, int]] = []
            for i in range(batch.num_rows):
                members, others = (batch.column(c)[i].as_py() for c in ("members", "members2"))
                members = sorted(members, key=order)
                if others is None and len(members) <= FEW:
                    out.extend(few(members))
                else:
                    out.extend(many(members, members if others is None else sorted(others, key=order), others is None))
                if len(out) > 100_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names)
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names)

    return run


def _columns(members: list[dict]) -> list[np.ndarray]:
    return [np.array([m[k] for m in members], np.int64) for k in ("id", "label", "n")]


def _close_tiles(members: list[dict], others: list[dict], num: int, den: int) -> Iterator[tuple[int, np.ndarray]]:
    """Which of ``members``, some rows at a time, may link with which of ``others`` in another group."""
    both = _matrix([m["bits"] for m in members] + [m["bits"] for m in others])
    left, right = both[: len(members)], both[len(members) :]
    (_, labels, sizes), (_, labels2, sizes2) = _columns(members), _columns(others)
    for at in range(0, len(members), 512):
        cut = slice(at, at + 512)
        yield at, _close(left[cut], right, sizes[cut], sizes2, num, den) & (labels[cut, None] != labels2[None, :])


_NEAR = "g long, side int, id long, label long, n long"
_GOLD = 0x9E3779B97F4A7C15


def _group(*numbers_: int) -> int:
    """A number for a group of classes that are compared in one task; two groups of one number are compared together."""
    out = _U(0)
    with np.errstate(over="ignore"):
        for x in numbers_:
            out = mix(out * _U(_GOLD) + _U(x & ((1 << 64) - 1)))
    return int(out.view(np.int64))


def _near(num: int, den: int, set_bytes: int):
    """Classes of two blocks of one list that have a candidate in another group, by groups whose sets fit into a task.

    Side 0 is compared with all of its group, sides 1 and 2 with each other. Where the sets of a list hold more than ``set_bytes``, it is
    cut into parts by id, and each two parts are a group.
    """

    def placed(own: tuple[int, ...], members: list[dict], others: list[dict] | None) -> Iterator[tuple[int, ...]]:
        held = 8 * sum(m["n"] for m in members + (others or []))
        parts = held // set_bytes + 1
        group = lru_cache(None)(lambda low, high: _group(*own, low, high))
        for side, rows in ((1, members), (2, others or [])):
            for m in rows:
                at = _group(m["id"]) % parts if parts > 1 else 0
                if others is None:
                    yield group(at, at), 0, m["id"], m["label"], m["n"]
                for t in range(parts):
                    if others is not None:
                        yield group(at, t) if side == 1 else group(t, at), side, m["id"], m["label"], m["n"]
                    elif t != at:
                        yield group(min(at, t), max(at, t)), 1 if at < t else 2, m["id"], m["label"], m["n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[int, ...]] = []
            for i in range(batch.num_rows):
                members, others = (batch.column(c)[i].as_py() for c in ("members", "members2"))
                some = members if others is None else others
                left, right = np.zeros(len(members), bool), np.zeros(len(some), bool)
                for at, ok in _close_tiles(members, some, num, den):
                    left[at : at + len(ok)] = ok.any(1)
                    right |= ok.any(0)
                if not left.any():
                    continue
                kept = [m for m, ok in zip(members, left) if ok]
                over = None if others is None else [m for m, ok in zip(others, right) if ok]
                out.extend(placed(tuple(int(batch.column(c)[i].as_py()) for c in ("key", "part", "part2")), kept, over))
                if len(out) > 100_000:
                    yield _numbers(out)
                    out = []
            if out:
                yield _numbers(out)

    return run


def _numbers(rows: list[tuple[int, ...]]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 3]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["g", "side", "id", "label", "n"])


def _sets(size: int):
    """The shingle set of each class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(at, 256) for whole in batches for at in range(0, whole.num_rows, 256)):
            found = [hashes.tobytes() for hashes in shingle_sets(batch.column("text"), size)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, pa.binary())], ["id", "hashes"])

    return run


def forest(labels: np.ndarray, sides: np.ndarray, sets: list[np.ndarray], num: int, den: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between groups: pairs of labels, fewer than there are labels.

    Overlaps are counted exactly, for one set with all others at once, over the lists of sets that hold a shingle.
    """
    sizes = np.array([len(x) for x in sets], np.int64)
    _, code = np.unique(np.concatenate(sets), return_inverse=True)
    holders = np.repeat(np.arange(len(sets)), sizes)[np.argsort(code, kind="stable")]
    ends = np.cumsum(np.bincount(code))
    begins = ends - np.bincount(code)
    offsets = np.append(0, np.cumsum(sizes))
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (y := root.get(x, x)) != x:
            root[x] = root.get(y, y)
            x = y
        return x

    out = []
    for i in range(len(sets) - 1):
        own = code[offsets[i] : offsets[i + 1]]
        if not len(own):
            continue
        met = np.concatenate([holders[b:e] for b, e in zip(begins[own].tolist(), ends[own].tolist())])
        both = np.bincount(met, minlength=len(sets))
        ok = (den * both >= num * (sizes[i] + sizes - both)) & (labels != labels[i])
        if sides[i]:
            ok &= (sides == 0) | (sides != sides[i])
        for j in (np.flatnonzero(ok[i + 1 :]) + i + 1).tolist():
            a, b = find(int(labels[i])), find(int(labels[j]))
            if a != b:
                root[max(a, b)] = min(a, b)
                out.append((int(labels[i]), int(labels[j])))
    return out


def _forest(num: int, den: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        labels, sides = (table.column(c).to_numpy() for c in ("label", "side"))
        sets = [np.frombuffer(x.as_buffer(), _U) for x in table.column("hashes").combine_chunks()]
        found = forest(labels, sides, sets, num, den)
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([x for _, x in found], pa.int64())})

    return run


def _by_cluster(near: DataFrame, set_bytes: int) -> DataFrame:
    """The same classes in groups by cluster, a cluster being all classes that groups connect, where that needs fewer copies of their sets.

    A class is in many lists. Compared by cluster, each set is copied once for each ``set_bytes`` that the cluster's sets hold.
    """
    first = near.groupBy("g").agg(F.min("id").alias("a"))
    roots = components(near.select("g", F.col("id").alias("b")).join(first, "g").select("a", "b"))
    placed = near.join(roots.withColumnRenamed("node", "id"), "id", "left")
    copies = F.floor(8 * F.sum("n") / set_bytes).cast("int") + 1
    classes = placed.where("root IS NOT NULL").groupBy("root", "id").agg(F.max("label").alias("label"), F.max("n").alias("n"), F.count(F.lit(1)).alias("_in"))
    sizes = classes.groupBy("root").agg(copies.alias("_parts"), F.count(F.lit(1)).alias("_c"), F.sum("_in").alias("_r"))
    cheaper = stored(sizes.where("_parts * _c <= _r").select("root", "_parts"), "clusters")
    part = F.pmod(F.xxhash64("id"), F.col("_parts").cast("long"))
    rows = classes.join(cheaper, "root").withColumn("_p", part.cast("int"))
    rows = rows.withColumn("_t", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    group = F.xxhash64(F.lit(3), "root", F.least("_p", "_t"), F.greatest("_p", "_t"))
    side = F.when(F.col("_p") == F.col("_t"), 0).when(F.col("_p") < F.col("_t"), 1).otherwise(2)
    by_cluster = rows.select(group.alias("g"), side.alias("side"), "id", "label", "n")
    by_list = placed.join(cheaper, "root", "left_anti").select("g", "side", "id", "label", "n")
    return by_list.unionByName(by_cluster)


def _last_links(whole: DataFrame, texts: DataFrame, num: int, den: int, size: int) -> DataFrame:
    """Links (a, b) between groups' labels that join all groups with a link between any two of their classes.

    Candidates are verified where they meet, so what is put out grows with the classes and not with their pairs.
    """
    near = stored(whole.mapInArrow(_near(num, den, SET_BYTES), _NEAR), "near")
    # Near texts share many words, so that many groups have the same classes; one of them is enough.
    marks = [F.bit_xor(F.xxhash64(F.lit(seed), "id", "label", "side")).alias(f"_{seed}") for seed in (1, 2)]
    alike = near.groupBy("g").agg(F.count(F.lit(1)).alias("_n"), *marks).groupBy("_n", "_1", "_2").agg(F.min("g").alias("g"))
    near = stored(near.join(alike.select("g"), "g", "left_semi"), "near-once")
    near = stored(_by_cluster(near, SET_BYTES), "compared")
    sets = bloom.thin(texts, near, "id", near.count()).mapInArrow(_sets(size), "id long, hashes binary")
    return near.join(sets, "id").groupBy("g").applyInArrow(_forest(num, den), "a long, b long")


def _verify(num: int, den: int, size: int):
    """Pairs whose sets overlap enough, computed on the texts; sets of texts met again soon are kept."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(at, 512) for whole in batches for at in range(0, whole.num_rows, 512)):
            a, b = (batch.column(c).to_numpy() for c in "ab")
            _, first, of = np.unique(b, return_index=True, return_inverse=True)
            order = np.argsort(of, kind="stable")
            rights = shingle_sets(batch.column("b_text").take(pa.array(first)), size)
            lefts = shingle_sets(batch.column("a_text").take(pa.array(order)), size)
            at, right, out = -1, None, []
            for i, left in zip(order, lefts):
                if of[i] != at:
                    at, right = of[i], next(rights)
                both = len(np.intersect1d(left, right, assume_unique=True))
                if len(left) and den * both >= num * (len(left) + len(right) - both):
                    out.append(i)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(a[out]), pa.array(b[out])], schema=schema)

    return run


def _linked(pairs: DataFrame, texts: DataFrame, num: int, den: int, size: int) -> DataFrame:
    """Those of the stored ``pairs`` (a, b) that are links; the text of a moves to that of b."""
    left = texts.select(F.col("id").alias("a"), F.col("text").alias("a_text"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("b_text"))
    count = pairs.count()
    both = pairs.select("a", "b").join(bloom.thin(left, pairs, "a", count), "a")
    both = both.join(bloom.thin(right, pairs, "b", count), "b").select("a", "b", "a_text", "b_text")
    return both.mapInArrow(_verify(num, den, size), "a long, b long")


def _fresh(marks: DataFrame) -> DataFrame | None:
    """(id, text_sha256, node) of classes whose smallest id names several texts, with numbers that are no document's id.

    None if every id names one text. Only ids that may be repeated are shuffled.
    """
    named = marks.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("id"), "text_sha256")
    words = bloom.words_for(named.count())
    hashed = F.xxhash64(F.lit(7), F.col("id"))
    again = bloom.probe(named, hashed, words, bloom.repeated(named, hashed, words)).where("_maybe")
    several = again.groupBy("id").agg(F.min("text_sha256").alias("_l"), F.max("text_sha256").alias("_h")).where("_l < _h")
    several = stored(several.select("id"), "shared-ids")
    many = several.count()
    if not many:
        return None
    kept = marks.select(F.col("keep_id").cast("long").alias("id"), "text_sha256").where("id IS NOT NULL")
    kept = bloom.semi_join(kept, several, "id", many).distinct()
    for salt in numbers():
        fresh = stored(kept.withColumn("node", F.xxhash64(F.lit(salt), "id", "text_sha256")), "fresh-ids")
        ids = fresh.select(F.col("node").alias("id"))
        if ids.distinct().count() == ids.count() and bloom.semi_join(named, ids, "id", ids.count()).isEmpty():
            return fresh


def _noded(rows: DataFrame, fresh: DataFrame | None, digest: Column) -> DataFrame:
    """The rows with ``id`` replaced by their class's number, where it has one of its own; most rows don't move."""
    if fresh is None:
        return rows
    words = bloom.words_for(fresh.count())
    hashed = F.xxhash64(F.lit(7), F.col("id"))
    probed = bloom.probe(rows, hashed, words, bloom.members(fresh, hashed, words))
    some = probed.where("_maybe").drop("_maybe").withColumn("_digest", digest)
    own = fresh.select("id", F.col("text_sha256").alias("_digest"), "node")
    some = some.join(own, ["id", "_digest"], "left").withColumn("id", F.coalesce("node", "id"))
    return probed.where("NOT _maybe").drop("_maybe").unionByName(some.select(*rows.columns))


def _sizes(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [len(hashes) for hashes in shingle_sets(batch.column("text"), size)]
            yield pa.RecordBatch.from_arrays([batch.column("text_sha256"), pa.array(found, pa.int64())], ["text_sha256", "_n"])

    return run


def link_groups(
    docs: DataFrame, shingle: int, num: int, den: int, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """One row per document: doc_id, n_shingles, class_id, component_id.

    Documents link when den * |A and B| >= num * |A or B|. class_id is the smallest id with an equal text but for white
    space, component_id the smallest id reachable by links.
    """
    return _groups(docs, shingle, num, den, text, doc_id)[0].select("doc_id", "n_shingles", "class_id", "component_id")


def _groups(
    docs: DataFrame, shingle: int, num: int, den: int, text: str, doc_id: str
) -> tuple[DataFrame, DataFrame | None]:
    """The rows of ``link_groups`` with text_sha256 and whether the document stays for its group, and the fresh ids."""
    marks = stored(exact_dedup.mark(docs, text, doc_id), "marks")
    fresh = _fresh(marks)
    digest = F.sha2(exact_dedup.normalised(F.col("text")).cast("binary"), 256)
    every = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    rows = every.where("id IS NOT NULL")
    classes = _noded(exact_dedup.dedup(rows, "text", "id"), fresh, digest)
    # A word of text takes about six bytes; in its two bands a shingle has so many sketch words.
    volume = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    each = 2 * max(1.1 * (den - num) / num, WORDS[0] / WORDS[1])
    buckets = max(8, int(volume / 6 * each / BUCKET) + 1)
    # Each step's rows are packed by bucket, and a task holds one bucket at a time.
    packed = classes.mapInArrow(_sketch(num, den, shingle, buckets), _PACKED)
    packed = packed.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(_shared(buckets), _PACKED)
    packed = packed.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    sent = stored(packed.mapInArrow(partial(_rarest, block=BLOCK), _SENT), "sent-words")
    sizes = sent.where("key IS NULL").groupBy("id").agg(F.max("n").alias("n"))
    sent = sent.where("key IS NOT NULL")
    member = F.struct("alone", "id", "n", "bits")
    # Blocks have a bounded size; one that holds a single class matters only if its list may have others.
    blocks = sent.groupBy("key", "parts", "part").agg(F.collect_list(member).alias("members"))
    blocks = stored(blocks.where("parts > 1 OR size(members) > 1"), "blocks")

    needed = stored(blocks.select(F.explode("members.id").alias("id")).distinct(), "needed")
    texts = bloom.semi_join(_noded(rows, fresh, digest), needed, "id", needed.count())
    texts = stored(texts.dropDuplicates(["id"]), "texts")
    labels = needed.withColumn("label", F.col("id"))

    def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
        roots = components(links).withColumnRenamed("node", "label")
        joined = labels.join(roots, "label", "left")
        return stored(joined.select("id", F.coalesce("root", "label").alias("label")), "labels")

    tested = None
    for _ in range(ROUNDS):
        pairs = _paired(blocks, None if tested is None else labels).mapInArrow(_candidates(num, den), _PAIRS)
        # A group's pair that most of its words speak for.
        found = pairs.groupBy("a", "b", "la", "lb").count()
        best = F.max_by(F.struct("a", "b", "lb"), F.struct("count", -F.col("b"), -F.col("a"))).alias("_best")
        pairs = found.groupBy("la").agg(best).select("la", "_best.*")
        low, high = F.least("a", "b").alias("b"), F.greatest("a", "b").alias("a")
        pairs = pairs.select(high, low, F.least("la", "lb").alias("la"), F.greatest("la", "lb").alias("lb")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = stored(pairs, "pairs")
        tested = pairs.select("a", "b") if tested is None else tested.unionByName(pairs.select("a", "b"))
        linked = _linked(pairs, texts, num, den, shingle).join(pairs, ["a", "b"])
        labels = merged(labels, linked.select(F.col("la").alias("a"), F.col("lb").alias("b")))
    labels = merged(labels, _last_links(_paired(blocks, labels), texts, num, den, shingle))

    nodes = sizes.join(labels, "id", "left").select(
        "id", F.col("n").alias("n_shingles"), F.coalesce("label", "id").alias("component_id")
    )
    if fresh is not None:
        # The smallest id of a group's classes, and the class it stands for.
        own = fresh.select(F.col("id").alias("_id"), "text_sha256", F.col("node").alias("id"))
        order = F.struct(F.coalesce("_id", "id").alias("_least"), F.coalesce("text_sha256", F.lit("")), F.col("id").alias("_first"))
        firsts = nodes.join(own, "id", "left").groupBy("component_id").agg(F.min(order).alias("_order"))
        nodes = nodes.join(firsts.select("component_id", "_order._least", "_order._first"), "component_id")
        nodes = nodes.select("id", "n_shingles", F.col("_least").alias("component_id"), "_first")
    else:
        nodes = nodes.withColumn("_first", F.col("component_id"))
    of = marks.select("doc_id", F.col("keep_id").cast("long").alias("class_id"), "text_sha256")
    of = _noded(of.withColumn("id", F.col("class_id")), fresh, F.col("text_sha256"))
    out = of.join(nodes, "id", "left")
    if not marks.where("keep_id IS NULL").isEmpty():
        # Texts that only rows without an id have.
        bare = every.where("id IS NULL").select(digest.alias("text_sha256"), "text")
        bare = bare.mapInArrow(_sizes(shingle), "text_sha256 string, _n long").groupBy("text_sha256").agg(F.max("_n").alias("_n"))
        alone = out.where("class_id IS NULL").join(bare, "text_sha256").withColumn("n_shingles", F.col("_n")).drop("_n")
        out = out.where("class_id IS NOT NULL").unionByName(alone)
    linked = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    group = F.coalesce(F.when(linked, F.col("component_id")), F.col("doc_id").cast("long"))
    stays = ~F.coalesce(linked, F.lit(False)) | ((F.col("doc_id") == F.col("component_id")) & (F.col("id") == F.col("_first")))
    out = out.select("doc_id", "n_shingles", "class_id", group.alias("component_id"), "text_sha256", stays.alias("stays"))
    return out, fresh


def _paired(blocks: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Every two blocks of a list, a block with itself included, with the labels of their members.

    Without ``labels`` every class is its own group; with them only lists that members of two groups share are left.
    """
    if labels is None:
        label = F.transform("members", lambda m: m.withField("label", m["id"]))
        whole = blocks.withColumn("members", label)
    else:
        ids = blocks.select("key", F.explode("members.id").alias("id")).join(labels, "id")
        several = ids.groupBy("key").agg(F.min("label").alias("_l"), F.max("label").alias("_h")).where("_l < _h")
        several = stored(several.select("key"), "mixed")
        rows = bloom.semi_join(blocks, several, "key", several.count())
        rows = rows.select("key", "parts", "part", F.explode("members").alias("_m"))
        rows = rows.select("key", "parts", "part", "_m.*").join(labels, "id")
        member = F.struct("alone", "id", "n", "bits", "label")
        whole = stored(rows.groupBy("key", "parts", "part").agg(F.collect_list(member).alias("members")), "labelled")
    # A block meets itself without a join; only lists of several blocks are joined.
    columns = ["key", "part", "part2", "members", "members2"]
    alone = whole.withColumn("part2", F.col("part")).withColumn("members2", F.lit(None).cast(whole.schema["members"].dataType))
    longer = whole.where("parts > 1")
    other = longer.select("key", F.col("part").alias("part2"), F.col("members").alias("members2"))
    two = longer.join(other, "key").where("part < part2")
    return alone.select(columns).unionByName(two.select(columns))


def drop_near_copies(
    docs: DataFrame, shingle: int = 5, num: int = 80, den: int = 100, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """One document of each group stays, the one with the smallest id. Rows with a null id stay.

    Of a group's texts that share the smallest id, one stays. Columns may have any names.
    """
    groups, fresh = _groups(docs, shingle, num, den, text, doc_id)
    gone = stored(groups.where("NOT stays").select(F.col("doc_id").alias(doc_id), "text_sha256"), "gone")
    if fresh is None:
        return bloom.anti_join(docs, gone, doc_id, gone.count())
    # An id may name texts that go and others that stay; only rows whose id is among those that go are shuffled.
    words = bloom.words_for(gone.count())
    hashed = F.xxhash64(F.lit(7), F.col(doc_id))
    maybe, own = unused("_maybe", docs.columns), unused("_digest", docs.columns)
    probed = bloom.probe(docs, hashed, words, bloom.members(gone, hashed, words), maybe)
    digest = F.sha2(exact_dedup.normalised(F.col(text)).cast("binary"), 256)
    some = probed.where(F.col(maybe)).drop(maybe).withColumn(own, digest)
    listed = gone.select(doc_id, F.col("text_sha256").alias(own)).distinct()
    some = some.join(listed, [doc_id, own], "left_anti").select(*docs.columns)
    return probed.where(~F.col(maybe)).select(*docs.columns).unionByName(some)
