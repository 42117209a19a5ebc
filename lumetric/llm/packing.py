"""Best-fit packing of token pieces into sequences by bin completion."""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumetric.llm.common import encoder, index_within, relieve, texts_of
from lumetric.session import settle

PIECE = "doc_id long, piece int, start long, length long, ids binary"

# Lengths of one filling, longest first, and how many sequences are filled so.
Plan = list[tuple[tuple[int, ...], int]]


def cut(
    docs: DataFrame,
    vocabulary: str,
    capacity: int = 2048,
    end_id: int = 0,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Encode every whole text, append ``end_id``, and cut what is longer than ``capacity``.

    Returns doc_id, piece (from 0), start (the document's ids before it), length
    and ids (little-endian unsigned 32-bit). The first piece takes the remainder,
    all others are full. A null or empty text is the end id alone; repeated rows
    give their pieces again; other columns are ignored.
    """
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    )

    def pieces(batches):
        names = ["doc_id", "piece", "start", "length", "ids"]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
        for batch in batches:
            doc_ids = batch.column("doc_id").to_pylist()
            made = []
            for doc_id, ids in zip(doc_ids, encoder(vocabulary).encode(texts_of(batch.column("text")))):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                start, stop, piece = 0, len(ids) % capacity or capacity, 0
                while start < len(ids):
                    made.append((doc_id, piece, start, stop - start, ids[start:stop].tobytes()))
                    start, stop, piece = stop, stop + capacity, piece + 1
                if len(made) >= 2000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*made), kinds)], names)
                    made = []
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*made), kinds)], names)
        relieve()

    return rows.mapInArrow(pieces, PIECE)


def place(pieces: DataFrame, capacity: int = 2048, nodes: int = 10_000) -> DataFrame:
    """Add sequence_id and offset: each piece's sequence and its place there, gapless from 0.

    ``pieces`` needs a length of 1 to ``capacity``; its other columns are kept and
    order pieces of equal length. Pieces of one length are interchangeable, so
    only the counts by length, at most ``capacity`` numbers whatever the data,
    go to the driver, where ``complete_bins`` plans the fillings; the pieces
    are then numbered within their length and take the places planned for it.
    No rows give no rows. Pieces of other lengths fail.
    """
    table = settle(pieces, "pieces")
    counts = {r.length: r["n"] for r in table.groupBy("length").agg(F.count("*").alias("n")).collect()}
    odd = [x for x in counts if x is None or not 1 <= x <= capacity]
    if odd:
        raise ValueError(f"lengths outside 1 to {capacity}: {sorted(odd, key=str)[:5]}")
    plan = complete_bins(counts, capacity, nodes)
    slots, taken, sequence = [], defaultdict(int), 0
    for filling, times in plan:
        offset = 0
        for length in sorted(set(filling), reverse=True):
            each = filling.count(length)
            low = taken[length]
            taken[length] = low + each * times
            slots.append((length, low, low + each * times, each, sequence, offset))
            offset += each * length
        sequence += times
    spark = pieces.sparkSession
    kinds = "length long, _low long, _high long, _each long, _sequence long, _offset long"
    planned = F.broadcast(spark.createDataFrame(slots, kinds))
    order = [c for c in table.columns if c != "length"]
    numbered = index_within(table, "length", order, "_index")
    inside = (F.col("_index") >= F.col("_low")) & (F.col("_index") < F.col("_high"))
    found = numbered.alias("n").join(
        planned.alias("p"), (F.col("n.length") == F.col("p.length")) & inside
    )
    nth = F.col("_index") - F.col("_low")
    return found.select(
        *[F.col(f"n.{c}") for c in table.columns],
        (F.col("_sequence") + F.floor(nth / F.col("_each"))).cast("long").alias("sequence_id"),
        (F.col("_offset") + nth % F.col("_each") * F.col("n.length")).cast("long").alias("offset"),
    )


def best_fit(counts: dict[int, int], capacity: int) -> Plan:
    """Best-fit decreasing on counts by length: each piece goes where the least room remains.

    Sequences filled alike are one group, so the work depends on the number of
    lengths, not of pieces.
    """
    open_: dict[int, list[list]] = {}  # room -> [filling, sequences]
    rooms: list[int] = []  # in order

    def put(room: int, filling: tuple[int, ...], many: int) -> None:
        if room not in open_:
            open_[room] = []
            insort(rooms, room)
        open_[room].append([filling, many])

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                fits = capacity // length
                if left >= fits:
                    put(capacity - fits * length, (length,) * fits, left // fits)
                if left % fits:
                    put(capacity - left % fits * length, (length,) * (left % fits), 1)
                break
            room = rooms.pop(at)
            fits = room // length
            for filling, many in open_.pop(room):
                full = min(many, left // fits)
                left -= full * fits
                if full:
                    put(room - fits * length, filling + (length,) * fits, full)
                if full < many and left:
                    put(room - left * length, filling + (length,) * left, 1)
                    full, left = full + 1, 0
                if full < many:
                    put(room, filling, many - full)
    return [(filling, many) for groups in open_.values() for filling, many in groups]


def bins(plan: Plan) -> int:
    return sum(many for _, many in plan)


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """No packing uses fewer: pieces over a threshold exclude each other's company.

    For each threshold t up to half the capacity, pieces longer than capacity - t
    stand alone, those over half need a sequence each, and what the room beside
    them can't take of the others at least t long needs more.
    """
    many = np.zeros(capacity + 2, np.int64)
    for length, n in counts.items():
        many[length] = n
    # Pieces, and their tokens, of at least each length.
    pieces = many[::-1].cumsum()[::-1]
    tokens = (many * np.arange(capacity + 2))[::-1].cumsum()[::-1]
    half = capacity // 2 + 1
    t = np.arange(1, capacity // 2 + 1)
    alone = pieces[capacity - t + 1]
    beside = pieces[half] - alone
    room = beside * capacity - (tokens[half] - tokens[capacity - t + 1])
    rest = tokens[t] - tokens[half] - room
    best = int((alone + beside + np.maximum(0, -(-rest // capacity))).max(initial=0))
    return max(best, -(-int(tokens[0]) // capacity))


class Steps:
    """What a search may still do: a step for each piece tried, and for each length packed by best fit."""

    def __init__(self, left: int):
        self.left = left


def maximal(counts: dict[int, int], lengths: list[int], capacity: int, steps: Steps) -> list[tuple[int, tuple[int, ...]]]:
    """Every filling around the longest piece that takes no further one, as (room left, filling).

    ``lengths`` are those left, longest first. Of pieces after which nothing fits,
    only the longest is taken, as it dominates the others in its place. Ends
    early, with what it has, when no steps are left.
    """
    rising, found, spare = lengths[::-1], [], defaultdict(int, {lengths[0]: 1})
    shortest = rising[0]

    def extend(chosen: tuple[int, ...], room: int) -> None:
        top = bisect_right(rising, min(room, chosen[-1]))
        more = bisect_right(rising, room - shortest, hi=top)
        full = next((rising[k] for k in range(top - 1, more - 1, -1) if counts[rising[k]] > spare[rising[k]]), 0)
        if full:
            found.append((room - full, (*chosen, full)))
        more_fit = bool(full)
        for k in range(more - 1, -1, -1):
            if steps.left <= 0:
                return
            x = rising[k]
            steps.left -= 1
            if counts[x] > spare[x]:
                more_fit = True
                spare[x] += 1
                extend((*chosen, x), room - x)
                spare[x] -= 1
        if not more_fit:
            found.append((room, chosen))

    extend((lengths[0],), capacity - lengths[0])
    return found


def fillings(counts: dict[int, int], lengths: list[int], capacity: int, steps: Steps | None = None) -> list[tuple[int, ...]]:
    """All undominated fillings that contain the longest piece, least waste first.

    ``lengths`` are those left, longest first. A filling is dominated when the
    room left takes another piece, when one of its pieces can give way to a
    longer one, or when two can give way to a single one at least as long as both;
    a single piece that fills the room dominates all else. Without steps for any
    filling there is one, filled greedily.
    """
    first, rising = lengths[0], lengths[::-1]
    room = capacity - first
    if room and counts.get(room, 0) - (room == first) > 0:
        return [(first, room)]

    def dominated(filling: tuple[int, ...], room: int) -> bool:
        spare, others = Counter(filling), filling[1:]

        def available(low: int, high: int) -> bool:
            return any(counts[x] > spare[x] for x in rising[bisect_left(rising, low) : bisect_right(rising, high)])

        if room and any(available(y + 1, y + room) for y in set(others)):
            return True
        return any(available(x, x + room) for x in {y + z for i, y in enumerate(others) for z in others[i + 1 :]})

    found = maximal(counts, lengths, capacity, steps or Steps(1_000_000))
    kept = [(left, f) for left, f in found if not dominated(f, left)]
    if not kept:
        chosen = [first]
        for x in lengths:
            take = min(room // x, counts[x] - (x == first))
            chosen, room = chosen + [x] * take, room - take * x
        return [tuple(chosen)]
    return [f for _, f in sorted(kept, key=lambda f: (f[0], [-x for x in f[1]]))]


def without(counts: dict[int, int], filling: tuple[int, ...], times: int) -> dict[int, int]:
    rest = dict(counts)
    for x, n in Counter(filling).items():
        rest[x] -= n * times
        if not rest[x]:
            del rest[x]
    return rest


def dive(counts: dict[int, int], capacity: int, charge: float, steps: Steps) -> Plan:
    """One descent of the search: around each longest piece the filling of least waste and charge.

    Each piece of a filling costs ``charge``. Without it every long piece takes
    short ones until its sequence is full, and middling ones are left that go
    together badly; a charge keeps the longest pieces to themselves, at some
    waste, so that the rest still has short ones. The cheapest filling is
    undominated: whatever dominates it would cost less. Of equals, the one of
    most even pieces is taken. Best fit packs the rest when the steps end.
    """
    left, plan = dict(counts), []
    while left:
        found = maximal(left, sorted(left, reverse=True), capacity, steps)
        if steps.left <= 0:
            break
        _, filling = min(found, key=lambda f: (f[0] + charge * len(f[1]), f[1]))
        times = min(left[x] // n for x, n in Counter(filling).items())
        plan.append((filling, times))
        left = without(left, filling, times)
    return plan + best_fit(left, capacity)


def complete_bins(counts: dict[int, int], capacity: int, nodes: int = 10_000, steps: int = 4_000_000) -> Plan:
    """Few sequences for the pieces counted by length: bin completion, branch and bound.

    The best-fit packing is the first incumbent; six descents, each with another
    charge for a piece, from none to 5/32 of the capacity, may give better ones.
    While the incumbent needs more than the lower bound, the search fills a
    sequence around the longest piece left with each undominated filling in
    turn, repeats that filling while its lengths last (so that a node stands for
    many equal sequences) or once, packs the rest of every node by best fit for
    a better incumbent, and prunes a branch whose waste so far, or whose own
    lower bound, leaves no hope to beat the incumbent. After ``nodes`` nodes or
    ``steps`` steps (an eighth for each descent, a quarter for the rest) the
    incumbent stands; it is always a complete packing.
    """
    counts = {x: n for x, n in counts.items() if n}
    best = best_fit(counts, capacity)
    fewest, least = bins(best), lower_bound(counts, capacity)
    for part in range(6):
        if fewest > least:
            plan = dive(counts, capacity, part * capacity / 32, Steps(steps // 8))
            if bins(plan) < fewest:
                best, fewest = plan, bins(plan)
    total = sum(x * n for x, n in counts.items())
    budget = Steps(steps // 4)
    # What is left, the fillings that led there as a chain, their number and waste.
    stack = [(counts, None, 0, 0)]
    visited = 0
    while stack and visited < nodes and budget.left > 0 and fewest > least:
        left, chain, used, waste = stack.pop()
        visited += 1
        if total + waste > (fewest - 1) * capacity or used + lower_bound(left, capacity) >= fewest:
            continue
        rest = best_fit(left, capacity)
        budget.left -= len(left)
        if used + bins(rest) < fewest:
            best, fewest = unwound(chain) + rest, used + bins(rest)
        branches = []
        for filling in fillings(left, sorted(left, reverse=True), capacity, budget) if left else ():
            room = capacity - sum(filling)
            times = min(left[x] // n for x, n in Counter(filling).items())
            for repeat in sorted({times, 1}, reverse=True):
                after = waste + room * repeat
                # A packing that beats the incumbent wastes no more than this.
                if total + after <= (fewest - 1) * capacity:
                    branches.append((without(left, filling, repeat), (chain, (filling, repeat)), used + repeat, after))
        stack.extend(reversed(branches))
    return best


def unwound(chain) -> Plan:
    plan = []
    while chain:
        chain, step = chain
        plan.append(step)
    return plan
