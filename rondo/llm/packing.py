"""Best-fit packing of tokenised documents into sequences of fixed length, by bin completion.

Documents longer than a sequence are cut; full pieces fill sequences of their own. For the rest only the number of pieces
of each length matters, so the search runs on a table of at most ``capacity`` counts, whatever the size of the corpus,
and its answer is a list of patterns: a filling and how many sequences use it. Best-fit decreasing gives the first
solution. If it needs more sequences than the lower bound, branch and bound looks for better ones: around the largest
piece left it enumerates the fillings that no other one dominates, and gives up branches that have wasted more than a better
solution could. Branches are taken in the order of their departures from the first choice, which is the filling with the least
waste, used as often as the counts allow: each next filling is one departure, and so is each halving of the uses, down to one.
Spark then numbers the pieces of each length and deals them to the patterns' places.

The search is bounded by ``nodes`` alone. A node costs 1, again for every 100 lengths it has left, and again for every 400 steps
its enumeration of fillings may take; where all branches are done and an enumeration was cut short, the search starts anew with
four times the steps. Given nodes enough it ends with the fewest sequences there can be; stopped before, it may need more than
that, never lose a piece. ``lower_bound`` tells how far it can be from the fewest.

Defined cases: a null or empty text is its end token alone. Repeated rows and ids are pieces like any other. Extra
columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import os
import unicodedata
import zlib
from array import array
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator
from itertools import count
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from rondo.llm.store import stored

END = 1
#: Words whose tokens a task remembers before it starts afresh, and characters of a text it splits at once.
WORDS, SEGMENT = 600_000, 1 << 20

#: Letters before this one alone are one pre-token, and so are any number of these signs after them.
LATIN_END, SIGNS = "\u0250", "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: Byte-level vocabularies write a byte as a printable character: itself, or the next free one from 256 on.
_PRINTED = {*range(33, 127), *range(161, 173), *range(174, 256)}
BYTES = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTED)}

Pattern = tuple[int, tuple[tuple[int, int], ...]]  # sequences, then (length, pieces of it in each)


def _segments(text: str) -> Iterator[str]:
    """Parts of a text, cut at a space."""
    at = 0
    while len(text) - at > SEGMENT:
        cut = text.rfind(" ", at + 1, at + SEGMENT)
        cut = cut if cut > 0 else text.find(" ", at + SEGMENT)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut
    yield text[at:]


class Tokens(dict):
    """The token ids of words as packed bytes, each word encoded when it is first asked for."""

    def __init__(self, vocabulary: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)

    def __missing__(self, word: str) -> bytes:
        """Latin words, with signs after them or not, skip the tokenizer's slow outer layers."""
        plain = (word if word.isascii() else unicodedata.normalize("NFC", word)).lower()
        stem = plain.rstrip(SIGNS)
        if stem.isalpha() and (stem.isascii() or max(stem) < LATIN_END):
            if stem == word:
                letters = stem if stem.isascii() else stem.encode().decode("latin-1").translate(BYTES)
                ids = array("I", [t.id for t in self.tokenizer.model.tokenize(letters)]).tobytes()
            else:
                ids = self[stem] + self[plain[len(stem) :]]
        else:
            ids = array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
        self[word] = ids
        return ids


#: The last tokenizer of a Python worker, which keeps it from task to task, under its checksum.
_tokens: dict[str, Tokens] = {}


def known_tokens(vocabulary: str, checksum: str) -> Tokens:
    if checksum not in _tokens:
        _tokens.clear()
        _tokens[checksum] = Tokens(vocabulary)
    return _tokens[checksum]


def _tokenise(vocabulary: str, capacity: int):
    checksum = hashlib.sha256(vocabulary.encode()).hexdigest()
    schema = pa.schema(
        [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = known_tokens(vocabulary, checksum)

        def encoded(text: str) -> Iterator[bytes]:
            # The tokenizer drops white space and never looks across it, so words can be encoded one by one.
            for part in _segments(text):
                if len(known) > WORDS:
                    known.clear()
                words = part.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
                yield b"".join(map(known.__getitem__, words))

        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = b"".join([*encoded(text.as_py() or ""), END.to_bytes(4, "little")])
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[at : at + 4 * capacity]
                    out.append((doc_id, piece, at // 4, len(own) // 4, zlib.crc32(own)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return run


def best_fit(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Best-fit decreasing, on counts: equal sequences are filled together."""
    groups: list[list[list]] = [[] for _ in range(capacity + 1)]  # by room: [sequences, filling]
    rooms: list[int] = []  # those with a group, in order

    def put(room: int, sequences: int, filling: tuple) -> None:
        if not groups[room]:
            insort(rooms, room)
        groups[room].append([sequences, filling])

    for length in sorted(counts, reverse=True):
        left, per_new = counts[length], capacity // length
        while left:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                whole, rest = divmod(left, per_new)
                if whole:
                    put(capacity - per_new * length, whole, ((length, per_new),))
                if rest:
                    put(capacity - rest * length, 1, ((length, rest),))
                break
            room = rooms[at]
            sequences, filling = groups[room].pop()
            if not groups[room]:
                del rooms[at]
            each = room // length
            whole = min(sequences, left // each)
            left -= whole * each
            if whole:
                put(room - each * length, whole, (*filling, (length, each)))
            if whole < sequences:
                some = min(left, each)
                if some:
                    put(room - some * length, 1, (*filling, (length, some)))
                    left -= some
                if same := sequences - whole - bool(some):
                    put(room, same, filling)
    return [(n, filling) for own in groups for n, filling in own]


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Sequences needed at least: the volume, and pieces over half that can't share with those of a given size or more."""
    number = np.zeros(capacity + 2, object)
    for length, n in counts.items():
        number[length] = n
    volume = number * np.arange(capacity + 2)
    numbers, volumes = np.cumsum(number), np.cumsum(volume)
    best = -(-int(volumes[-1]) // capacity)
    half = capacity // 2
    for k in range(1, half + 1):
        alone = numbers[capacity] - numbers[capacity - k]
        large = numbers[capacity - k] - numbers[half]
        spare = large * capacity - (volumes[capacity - k] - volumes[half])
        small = volumes[half] - volumes[k - 1]
        best = max(best, int(alone + large + max(0, -(-(small - spare) // capacity))))
    return best


def fillings(largest: int, counts: dict[int, int], capacity: int, limit: int) -> tuple[list[tuple[int, Counter]], bool]:
    """(waste, other pieces) around a piece of the largest length, best first, and whether they are all there are.

    Those that another filling dominates are left out: one more piece fits, or one of its pieces, or two together, can be
    exchanged for a larger one. At most ``limit`` steps are taken; a filling without waste ends the search. The filling that
    takes the largest pieces that fit is always there.
    """
    lengths = sorted((x for x, n in counts.items() if n), reverse=True)
    found: list[tuple[int, Counter]] = []
    steps = 0

    def dominated(items: list[int], waste: int, used: Counter) -> bool:
        free = [x for x in lengths if counts[x] > used[x]]
        if free and free[-1] <= waste:
            return True
        sizes = set(items) | {a + b for i, a in enumerate(items) for b in items[i + 1 :]}
        return waste > 0 and any(size < x <= size + waste for size in sizes for x in free)

    def extend(at: int, room: int, items: list[int], used: Counter) -> bool:
        nonlocal steps
        steps += 1
        if steps > limit:
            return True
        grown = False
        for i in range(at, len(lengths)):
            x = lengths[i]
            if x <= room and counts[x] > used[x]:
                grown = True
                used[x] += 1
                items.append(x)
                stop = extend(i, room - x, items, used)
                items.pop()
                used[x] -= 1
                if stop:
                    return True
        if not grown and not dominated(items, room, used):
            found.append((room, Counter(items)))
            return room == 0
        return False

    extend(0, capacity - largest, [], Counter({largest: 1}))
    room, greedy = capacity - largest, Counter()
    for x in lengths:
        if n := min(room // x, counts[x] - (x == largest)):
            greedy[x], room = n, room - n * x
    if steps > limit and all(others != greedy for _, others in found):
        found.append((room, greedy))
    return sorted(found, key=lambda f: (f[0], sum(f[1].values()))), steps <= limit


def bin_completion(counts: dict[int, int], capacity: int, nodes: int = 3000, steps: int = 400) -> list[Pattern]:
    """The best packing found: best-fit decreasing, or better ones from branch and bound."""
    counts = {int(x): int(n) for x, n in counts.items() if n}
    best = best_fit(counts, capacity)
    least = lower_bound(counts, capacity)
    total = sum(x * n for x, n in counts.items())
    fewest = sum(n for n, _ in best)
    per_node, whole = steps, False
    while not whole and nodes > 0 and fewest > least:
        whole = True  # unless an enumeration is cut short
        seen: dict[frozenset, int] = {}  # sequences with which a state was reached
        # By departures, then depth: the state before, its fillings, which of them, how often its uses are halved.
        order = count()
        start = {"left": counts, "patterns": [], "used": 0, "waste": 0}
        queue: list[tuple] = [(0, 0, next(order), start, None, 0)]
        while queue and nodes > 0 and fewest > least:
            departures, depth, _, state, at, halved = heapq.heappop(queue)
            if at is not None:
                gap, filling = state["fillings"][at]
                most = min(state["left"][x] // n for x, n in filling.items())
                if halved == 0 and at + 1 < len(state["fillings"]):
                    heapq.heappush(queue, (departures + 1, depth, next(order), state, at + 1, 0))
                if most >> (halved + 1):
                    heapq.heappush(queue, (departures + 1, depth, next(order), state, at, halved + 1))
                times = most >> halved
                left = {x: n - times * filling[x] for x, n in state["left"].items() if n > times * filling[x]}
                patterns = [*state["patterns"], (times, tuple(sorted(filling.items(), reverse=True)))]
                state = {"left": left, "patterns": patterns, "used": state["used"] + times, "waste": state["waste"] + times * gap}
            left, used = state["left"], state["used"]
            nodes -= 1 + len(left) // 100 + (per_node - 1) // 400
            if state["waste"] > (fewest - 1) * capacity - total:
                continue
            key = frozenset(left.items())
            if seen.get(key, used + 1) <= used:
                continue
            seen[key] = used
            quick = best_fit(left, capacity)
            if used + sum(n for n, _ in quick) < fewest:
                best = state["patterns"] + quick
                fewest = sum(n for n, _ in best)
            if not left or used + lower_bound(left, capacity) >= fewest:
                continue
            largest = max(left)
            around, all_of_them = fillings(largest, left, capacity, per_node)
            whole &= all_of_them
            state["fillings"] = [(gap, others + Counter({largest: 1})) for gap, others in around]
            heapq.heappush(queue, (departures, depth - 1, next(order), state, 0, 0))
        per_node *= 4
    return best


def _places(patterns: list[Pattern]) -> tuple[np.ndarray, ...]:
    """For runs of pieces of one length, by number: (length, first number, first sequence, pieces in each, offset)."""
    rows, seen, first = [], Counter(), 0
    for times, filling in patterns:
        offset = 0
        for length, each in filling:
            rows.append((length, seen[length], first, each, offset))
            seen[length] += times * each
            offset += length * each
        first += times
    return tuple(np.array(c, np.int64) for c in zip(*sorted(rows)))


def _deal(places: tuple[np.ndarray, ...]):
    length, number, first, each, offset = places
    starts = np.searchsorted(length, np.arange(length.max() + 2))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("length").to_numpy()
            rank = batch.column("_rank").to_numpy()
            low, high = starts[own], starts[own + 1]
            while (more := high - low > 1).any():  # halve each piece's range of runs
                middle = (low + high) // 2
                right = more & (number[np.minimum(middle, len(number) - 1)] <= rank)
                low, high = np.where(right, middle, low), np.where(more & ~right, middle, high)
            k = rank - number[low]
            sequence, place = first[low] + k // each[low], offset[low] + k % each[low] * own
            kept = [batch.column(c) for c in batch.schema.names if c != "_rank"]
            names = [c for c in batch.schema.names if c != "_rank"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(place)], [*names, "sequence_id", "offset"])

    return run


def pack(pieces: DataFrame, capacity: int) -> DataFrame:
    """Add sequence_id and offset to a stored table of pieces that has doc_id, piece, ids_crc32 and length."""
    schema = StructType([*pieces.schema, StructField("sequence_id", LongType()), StructField("offset", LongType())])
    # At most ``capacity`` rows: the search needs nothing else.
    counts = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}
    if not counts:
        return pieces.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")})
    places = _places(bin_completion(counts, capacity))
    # Pieces of one length are numbered in parts, so that a frequent length isn't one task's work.
    part = max(2000, sum(counts.values()) // 4096)
    parts = -(-max(counts.values()) // part)
    salted = pieces.withColumn("_part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(parts)))
    within = Window.partitionBy("length", "_part").orderBy("doc_id", "piece", "ids_crc32")
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = salted.groupBy("length", "_part").count()
    sums = sums.select("length", "_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    ranked = salted.withColumn("_rank", F.row_number().over(within) - 1).join(sums, ["length", "_part"])
    ranked = ranked.withColumn("_rank", F.col("_rank") + F.col("_before")).select(*pieces.columns, "_rank")
    return ranked.mapInArrow(_deal(places), schema)


def pack_documents(
    docs: DataFrame, tokenizer: str, capacity: int = 4096, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    The driver reads the file ``tokenizer``; workers get its text with their tasks.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    shape = "doc_id long, piece int, start long, length long, ids_crc32 long"
    return pack(stored(rows.mapInArrow(_tokenise(Path(tokenizer).read_text("utf-8"), capacity), shape), "pieces"), capacity)
