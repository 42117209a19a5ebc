"""Language-model scores by prediction by partial matching over bytes."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumetric.session import settle

# Symbols are the 256 bytes and the end of a text; a text is led in by bytes that UTF-8 doesn't have.
END, N_SYMBOLS, LEAD = 256, 257, b"\xff"
SYMBOL_BITS = 9

# Distinct grams and words (joined by blanks), sorted, with a number for each, all compressed.
PARCEL = "batch long, shard long, grams binary, gram_n binary, words binary, word_n binary"
SCORED = "doc_id long, n_tokens long, n_known long, base_score double, score double"


def held_out(key, divisor: int = 5, remainder: int = 1):
    """Whether a row is kept from learning, by the CRC of its id as text; a null id is an empty string."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(divisor)) == remainder


# --- grams --------------------------------------------------------------------------------------
#
# A gram is a symbol with the `order` bytes before it, packed into a long: the symbol in the low
# bits, above it the context, its last byte lowest. So the gram of a shorter context is a mask away.


def mask(order: int) -> int:
    """The bits of a gram with a context of ``order`` bytes."""
    return (1 << (8 * order + SYMBOL_BITS)) - 1


def grams_of(texts: Sequence[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """The grams of all texts, one after the other, and how many each has; the end is the last one."""
    blob = np.frombuffer(b"".join(LEAD * order + t for t in texts) + LEAD, np.uint8).astype(np.int64)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.r_[0, np.cumsum(sizes + order)]
    keep = np.ones(len(blob), bool)
    keep[0] = False
    for j in range(1, order):
        keep[starts[:-1] + j] = False
    symbols = blob.copy()
    symbols[starts[1:]] = END
    grams = np.zeros(len(blob) - order, np.int64)
    for j in range(order):
        grams = (grams << 8) | blob[j : len(blob) - order + j]
    return ((grams << SYMBOL_BITS) | symbols[order:])[keep[order:]], sizes + 1


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[first], np.add.reduceat(counts, first)


def found(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each key is in a sorted table, and whether it is there at all."""
    if not len(table):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys


# --- the trie -----------------------------------------------------------------------------------
#
# A level holds the entries (context and symbol) of one order with their counts. The longest
# contexts count occurrences. A shorter one counts in how many contexts longer by one byte the
# symbol was met: just what counting only novel symbols in shorter contexts ("update exclusion")
# gives, whatever the order of the texts, so that counts can be summed over all tasks.
#
# In a context with total n and d different symbols, after leaving out those of the next longer
# context, a symbol met c times has probability (2c - 1) / 2n, the escape d / 2n. Symbols of a
# longer context are all symbols of the shorter one too, so what is left out is a sum a node.

Level = tuple[np.ndarray, np.ndarray]


def shorter(level: Level, order: int) -> Level:
    """The level of contexts of ``order`` bytes below the one of a byte more."""
    entries, counts = np.unique(level[0] & mask(order), return_counts=True)
    return entries, counts


class Node:
    """The contexts of a level: total and number of symbols, and what they leave out of the next shorter one."""

    def __init__(self, level: Level, below: Level | None, order: int):
        entries, counts = level
        contexts = entries >> SYMBOL_BITS
        first = np.flatnonzero(np.r_[True, contexts[1:] != contexts[:-1]]) if len(contexts) else np.zeros(0, np.int64)
        self.contexts = contexts[first]
        self.total = np.add.reduceat(counts, first) if len(first) else first
        self.symbols = np.diff(np.r_[first, len(entries)])
        self.left_out = np.zeros(len(first), np.int64)
        if below is not None and len(first):
            at, _ = found(below[0], entries & mask(order - 1))
            self.left_out = np.add.reduceat(below[1][at], first)


def log_probabilities(grams: np.ndarray, counts: np.ndarray, order: int, low: Sequence[Level]) -> np.ndarray:
    """log10 of the probability of each gram's symbol after its context.

    ``grams`` are distinct and sorted, with their counts in training (0: not
    met), and hold, with a gram, all that share its last ``len(low)`` bytes of
    context; ``low`` holds the whole levels of shorter contexts, from order 0.
    """
    met = counts > 0
    levels = {order: (grams[met], counts[met]), **dict(enumerate(low))}
    for j in range(order - 1, len(low) - 1, -1):
        levels[j] = shorter(levels[j + 1], j)
    out = np.zeros(len(grams))
    to_do = np.ones(len(grams), bool)
    out_total, out_symbols = np.zeros(len(grams), np.int64), np.zeros(len(grams), np.int64)
    for j in range(order, -1, -1):
        node = Node(levels[j], levels.get(j - 1), j)
        key = grams & mask(j)
        at, here = found(node.contexts, key >> SYMBOL_BITS)
        if not len(node.contexts):
            continue
        total, symbols = node.total[at] - out_total, node.symbols[at] - out_symbols
        place, seen = found(levels[j][0], key)
        used = to_do & here & (symbols > 0)
        hit, missed = used & seen, used & ~seen
        out[hit] += np.log10((2 * levels[j][1][place[hit]] - 1) / (2 * total[hit]))
        out[missed] += np.log10(symbols[missed] / (2 * total[missed]))
        to_do &= ~hit
        out_total = np.where(here, node.left_out[at], 0)
        out_symbols = np.where(here, node.symbols[at], 0)
    out[to_do] -= np.log10(N_SYMBOLS - len(levels[0][0]))
    return out


# --- what the corpus says -----------------------------------------------------------------------
#
# Grams and words travel as parcels: one row for all those of a batch of texts that one shard
# looks after. A gram's shard is its remainder, a word's that of its CRC, so shards are even.


def parcels(batch: int, shards: int, grams: Level, words: dict[bytes, int]) -> Iterator[tuple]:
    """One parcel for each shard that has any of the grams (sorted) and words."""
    of = grams[0] % shards
    sort = np.argsort(of.astype(np.uint16) if shards < 1 << 16 else of, kind="stable")
    cuts = np.searchsorted(of[sort], np.arange(shards + 1))
    lists: list[list[bytes]] = [[] for _ in range(shards)]
    for word in sorted(words):
        lists[zlib.crc32(word) % shards].append(word)
    for shard in range(shards):
        here = sort[cuts[shard] : cuts[shard + 1]]
        some = lists[shard]
        if len(here) or some:
            numbers = np.fromiter(map(words.__getitem__, some), np.int64, len(some))
            yield (
                batch, shard, packed_longs(grams[0][here]), packed_longs(grams[1][here]),
                packed_words(some), packed_longs(numbers),
            )


def parcel_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), *[pa.binary()] * 4)
    columns = [pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)]
    return pa.RecordBatch.from_arrays(columns, ["batch", "shard", "grams", "gram_n", "words", "word_n"])


# Sorted numbers have small steps, and like bytes of all numbers compress best beside each other.


def squeezed(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def restored(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def packed_longs(numbers: np.ndarray) -> bytes:
    steps = np.diff(numbers, prepend=0).astype("<i8")
    return squeezed(steps.view(np.uint8).reshape(-1, 8).T.tobytes())


def longs(data: bytes) -> np.ndarray:
    steps = np.frombuffer(restored(data), np.uint8).reshape(8, -1).T
    return np.cumsum(np.ascontiguousarray(steps).view("<i8").ravel())


def packed_words(words: list[bytes]) -> bytes:
    return squeezed(b" ".join(words))


def words_in(data: bytes) -> list[bytes]:
    return restored(data).split()


def gathered(rows: DataFrame, order: int, shards: int, chars: int = 1 << 19, most: int = 1 << 21) -> DataFrame:
    """Parcels of the distinct grams and words of each batch's texts.

    The numbers count them in texts to learn from: 0 for what only others have.
    A batch gives several parcels to a shard if several tasks have its texts, or
    after about ``2 * most`` distinct grams; ``most`` grams are held beside them.
    """

    def gather(batches):
        fresh, sums, words, rows, current = [], None, Counter(), 0, None

        def collapsed():
            # The lowest bit tells the grams to learn from.
            keys, counts = np.unique(np.concatenate(fresh), return_counts=True)
            part = summed(keys >> 1, np.where(keys & 1, counts, 0))
            return merged([sums, part]) if sums else part

        for batch in batches:
            for number, learned, texts in runs_of(batch, chars):
                if current != number or rows > most:
                    if fresh:
                        fresh, sums, rows = [], collapsed(), 0
                    if sums and (current != number or len(sums[0]) > 2 * most):
                        yield parcel_batch(list(parcels(current, shards, sums, words)))
                        sums, words = None, Counter()
                current = number
                keys, sizes = grams_of(texts, order)
                fresh.append((keys << 1) | np.repeat(np.array(learned, np.int64), sizes))
                rows += len(keys)
                for text, learn in zip(texts, learned):
                    if learn:
                        words.update(text.split())
                    else:
                        words.update(dict.fromkeys(text.split(), 0))
        if fresh:
            sums = collapsed()
        if sums:
            yield parcel_batch(list(parcels(current, shards, sums, words)))

    return rows.mapInArrow(gather, PARCEL)


def counted(parcels: DataFrame) -> DataFrame:
    """One parcel a shard with the sums over all batches (batch -1)."""

    def add(batches):
        held, words, current = [], Counter(), None

        def packed():
            grams = merged(held)
            names = sorted(words)
            numbers = np.fromiter(map(words.__getitem__, names), np.int64, len(names))
            return parcel_batch(
                [(-1, current, packed_longs(grams[0]), packed_longs(grams[1]), packed_words(names), packed_longs(numbers))]
            )

        for batch in batches:
            for i in range(batch.num_rows):
                shard = batch.column("shard")[i].as_py()
                if held and shard != current:
                    yield packed()
                    held, words = [], Counter()
                current = shard
                _, _, grams, gram_n, names, word_n = (batch.column(c)[i].as_py() for c in batch.schema.names)
                held.append((longs(grams), longs(gram_n)))
                if len(held) > 16:
                    held = [merged(held)]
                for word, n in zip(words_in(names), longs(word_n).tolist()):
                    words[word] += n
        if held:
            yield packed()

    return parcels.repartition("shard").sortWithinPartitions("shard").mapInArrow(add, PARCEL)


def rows_of(sums: DataFrame) -> DataFrame:
    """gram, n of each shard's grams."""

    def explode(batches):
        for batch in batches:
            for grams, numbers in zip(batch.column("grams"), batch.column("gram_n")):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(longs(grams.as_py())), pa.array(longs(numbers.as_py()))], ["gram", "n"]
                )

    return sums.select("grams", "gram_n").mapInArrow(explode, "gram long, n long")


def word_totals(sums: DataFrame) -> tuple[int, int]:
    """Occurrences and number of different words learned."""

    def total(batches):
        for batch in batches:
            numbers = [longs(x.as_py()) for x in batch.column("word_n")]
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(n.sum()) for n in numbers], pa.int64()), pa.array([int((n > 0).sum()) for n in numbers], pa.int64())],
                ["n", "kinds"],
            )

    found = sums.select("word_n").mapInArrow(total, "n long, kinds long")
    return found.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("kinds"), F.lit(0))).first()


def merged(parts: list[Level]) -> Level:
    return summed(np.concatenate([g for g, _ in parts]), np.concatenate([n for _, n in parts]))


def runs_of(batch: pa.RecordBatch, chars: int) -> Iterator[tuple[int, list[bool], list[bytes]]]:
    """(batch, to learn from, lower-cased texts) of consecutive rows, about ``chars`` bytes at a time."""
    numbers = batch.column("batch").to_numpy()
    learned = batch.column("learned").to_pylist()
    texts, start, size = batch.column("text"), 0, 0
    some: list[bytes] = []
    for i in range(len(numbers)):
        if some and (numbers[i] != numbers[start] or size >= chars):
            yield int(numbers[start]), learned[start:i], some
            some, start, size = [], i, 0
        text = (texts[i].as_py() or b"").lower()
        some.append(text)
        size += len(text)
    if some:
        yield int(numbers[start]), learned[start:], some


def context_depth(grams: DataFrame, order: int, group_rows: int) -> tuple[list[int], list[Level], Level]:
    """(two-byte contexts of more than ``group_rows`` grams, levels 0 and 1, level 2 below those contexts).

    Level 1 has at most 65,792 entries; a busy context has at most 257, and there
    is one such context for each ``group_rows`` grams at most.
    """
    met = grams.where("n > 0").select("gram")
    second = F.col("gram").bitwiseAND(F.lit(mask(2)))

    def collected(entries: DataFrame, order: int) -> Level:
        rows = entries.groupBy(F.col("gram").bitwiseAND(F.lit(mask(order))).alias("gram")).count().collect()
        found = np.array(sorted((r["gram"], r["count"]) for r in rows), np.int64).reshape(-1, 2)
        return found[:, 0], found[:, 1]

    level1 = collected(met.select(second.alias("gram")).distinct(), 1)
    context = F.shiftright(second, SYMBOL_BITS)
    busy = grams.groupBy(context.alias("context")).count().where(F.col("count") > group_rows)
    busy = sorted(r["context"] for r in busy.collect())
    below = met.where(context.isin(busy)).select(F.col("gram").bitwiseAND(F.lit(mask(3))).alias("gram"))
    level2 = collected(below.distinct(), 2) if busy else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    return busy, [shorter(level1, 0), level1], level2


def costs(grams: DataFrame, order: int, group_rows: int = 1 << 22, at_once: int = 1 << 20) -> DataFrame:
    """gram, value: log10 of the probability of each distinct gram (gram, n).

    The trie is cut below its contexts of two bytes, each part with all longer
    contexts that end alike. A part of more than ``group_rows`` grams is cut
    below three bytes. So each part is scored in one task, a few of them at
    once, and none needs more than the small levels above.
    """
    busy, top, level2 = context_depth(grams, order, group_rows)
    sent = grams.sparkSession.sparkContext.broadcast((top, level2))
    deep = 1 << 32

    def score(batches):
        top, level2 = sent.value
        held: list[tuple[np.ndarray, ...]] = []

        def done(parts):
            keys, grams, counts = (np.concatenate(x) for x in zip(*parts))
            for low, some in ((top, keys < deep), ([*top, level2], keys >= deep)):
                if some.any():
                    here, n = summed(grams[some], counts[some])
                    values = log_probabilities(here, n, order, low)
                    yield pa.RecordBatch.from_arrays([pa.array(here), pa.array(values)], ["gram", "value"])

        rows = 0
        for batch in batches:
            part = tuple(batch.column(c).to_numpy() for c in ("key", "gram", "n"))
            held.append(part)
            rows += len(part[0])
            if rows >= at_once and part[0][0] != part[0][-1]:
                # The last key of the batch may go on in the next one.
                cut = int(np.searchsorted(part[0], part[0][-1]))
                held[-1] = tuple(x[:cut] for x in part)
                yield from done(held)
                held, rows = [tuple(x[cut:] for x in part)], len(part[0]) - cut
        if held:
            yield from done(held)

    context = F.shiftright(F.col("gram").bitwiseAND(F.lit(mask(2))), SYMBOL_BITS)
    longer = F.shiftright(F.col("gram").bitwiseAND(F.lit(mask(3))), SYMBOL_BITS)
    key = F.when(context.isin(busy), longer + deep).otherwise(context) if busy else context
    parts = grams.select(key.alias("key"), "gram", "n").repartition("key").sortWithinPartitions("key")
    return parts.mapInArrow(score, "gram long, value double")


def answered(parcels: DataFrame, sums: DataFrame, values: DataFrame, shards: int) -> DataFrame:
    """The parcels with each gram's value in place of its number, and each word's sum.

    A shard gets its values (kind 0) and sums (kind 1) first and then, batch by
    batch, the parcels (kind 2); those of a batch become one.
    """

    def answer(batches):
        current, table, sums, held, batch_id = None, [], {}, [], None

        def packed():
            grams = np.unique(np.concatenate([g for g, _ in held]))
            keys, values = table[0]
            words = sorted(set().union(*[w for _, w in held]))
            numbers = np.fromiter(map(sums.__getitem__, words), np.int64, len(words))
            each = values[np.searchsorted(keys, grams)] if len(keys) else np.zeros(0)
            return parcel_batch(
                [(batch_id, current, packed_longs(grams), squeezed(each.tobytes()), packed_words(words), packed_longs(numbers))]
            )

        for batch in batches:
            shard, kind = batch.column("shard").to_numpy(), batch.column("kind").to_numpy()
            cuts = np.flatnonzero((shard[1:] != shard[:-1]) | (kind[1:] != kind[:-1])) + 1
            for a, b in zip(np.r_[0, cuts].tolist(), np.r_[cuts, len(shard)].tolist()):
                if shard[a] != current:
                    if held:
                        yield packed()
                    current, table, sums, held = int(shard[a]), [], {}, []
                part = batch.slice(a, b - a)
                if kind[a] == 0:
                    table.append((part.column("gram").to_numpy(), part.column("value").to_numpy()))
                    continue
                if not table:
                    table.append((np.zeros(0, np.int64), np.zeros(0)))
                if len(table) > 1 or kind[a] == 1:
                    keys, values = (np.concatenate(x) for x in zip(*table))
                    sort = np.argsort(keys)
                    table = [(keys[sort], values[sort])]
                for i in range(part.num_rows):
                    words = words_in(part.column("words")[i].as_py())
                    if kind[a] == 1:
                        sums = dict(zip(words, longs(part.column("word_n")[i].as_py()).tolist()))
                        continue
                    number = part.column("batch")[i].as_py()
                    if held and number != batch_id:
                        yield packed()
                        held = []
                    batch_id = number
                    held.append((longs(part.column("grams")[i].as_py()), words))
        if held:
            yield packed()

    none = F.lit(None)
    blobs = ["grams", "words", "word_n"]
    rows = [
        values.select(
            F.pmod("gram", F.lit(shards)).alias("shard"), F.lit(0).alias("kind"), F.lit(-1).cast("long").alias("batch"),
            "gram", "value", *[none.cast("binary").alias(c) for c in blobs],
        ),
        *[
            df.select(
                "shard", F.lit(kind).alias("kind"), "batch", none.cast("long").alias("gram"),
                none.cast("double").alias("value"), *blobs,
            )
            for kind, df in ((1, sums.withColumn("grams", none.cast("binary"))), (2, parcels.withColumn("word_n", none.cast("binary"))))
        ],
    ]
    ordered = rows[0].union(rows[1]).union(rows[2]).repartition("shard")
    return ordered.sortWithinPartitions("shard", "kind", "batch").mapInArrow(answer, PARCEL)


def scored(rows: DataFrame, order: int, ends: int, divisor: float, chars: int = 1 << 19) -> DataFrame:
    """Scores of the texts (kind 1) of each batch by the answers to its parcels (kind 0) before them."""

    def score(batches):
        current, tables, table, sums = None, [], None, {}
        for batch in batches:
            numbers, kinds = batch.column("batch").to_numpy(), batch.column("kind").to_numpy()
            cuts = np.flatnonzero((numbers[1:] != numbers[:-1]) | (kinds[1:] != kinds[:-1])) + 1
            for a, b in zip(np.r_[0, cuts].tolist(), np.r_[cuts, len(numbers)].tolist()):
                part = batch.slice(a, b - a)
                if numbers[a] != current:
                    current, tables, table, sums = numbers[a], [], None, {}
                if kinds[a] == 0:
                    for i in range(part.num_rows):
                        grams, values, words, word_n = (part.column(c)[i].as_py() for c in ("grams", "gram_n", "words", "word_n"))
                        tables.append((longs(grams), np.frombuffer(restored(values))))
                        sums.update(zip(words_in(words), longs(word_n).tolist()))
                    continue
                if table is None:
                    keys = np.concatenate([k for k, _ in tables])
                    sort = np.argsort(keys)
                    table = keys[sort], np.concatenate([v for _, v in tables])[sort]
                    tables = []
                yield texts_of(part, table, sums)

    # A sorted gram has room for so many numbers of texts above its own bits.
    most = 1 << (62 - 8 * order - SYMBOL_BITS)

    def sums_of(texts, keys, values):
        """The sum of each text's values; sorting meets the table in its order."""
        grams, sizes = grams_of(texts, order)
        pairs = np.sort((grams * most) | np.repeat(np.arange(len(texts)), sizes))
        grams = pairs // most
        first = np.flatnonzero(np.r_[True, grams[1:] != grams[:-1]])
        each = np.repeat(values[np.searchsorted(keys, grams[first])], np.diff(np.r_[first, len(grams)]))
        return np.bincount(pairs % most, weights=each, minlength=len(texts))

    def texts_of(part, table, sums):
        ids, results = part.column("doc_id"), []
        for _, _, texts in runs_of(part, chars):
            scores = np.concatenate([sums_of(texts[i : i + most], *table) for i in range(0, len(texts), most)])
            split = [text.split() for text in texts]
            counts = np.array([n for words in split for n in (*map(sums.__getitem__, words), ends)], np.float64)
            first = np.r_[0, np.cumsum([len(words) + 1 for words in split])]
            base = np.add.reduceat(np.log10((counts + 0.5) / divisor), first[:-1])
            known = np.add.reduceat((counts > 0).astype(np.int64), first[:-1])
            results.append((np.diff(first), known, base, scores))
        columns = [pa.array(np.concatenate(c)) for c in zip(*results)]
        return pa.RecordBatch.from_arrays([ids, *columns], ["doc_id", "n_tokens", "n_known", "base_score", "score"])

    return rows.mapInArrow(score, SCORED)


def score(
    docs: DataFrame,
    order: int = 5,
    *,
    batch_bytes: int = 24 << 20,
    batch_rows: int = 1 << 14,
    shard_bytes: int = 16 << 20,
    group_rows: int = 1 << 22,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row.

    ``score`` is log10 of the probability of the whole text, A-Z in lower case,
    as bytes with an end after them, white space included, by a trie of contexts
    of up to ``order`` bytes (3 to 6) learned from all texts not held out:
    prediction by partial matching with escape estimate D, symbol exclusion and
    update exclusion. ``base_score`` is that of the words and the end by their
    smoothed frequency among the ``train_tokens`` tokens learned.

    Null and empty texts are the end alone. A null id is hashed as an empty
    string. Repeated rows count again and share their scores. Without a text to
    learn from, all 257 symbols are equally likely. Other columns are ignored.
    No rows give no rows.

    Texts are written in batches: stretches of ``batch_rows`` rows are dealt to
    as many batches as hold about ``batch_bytes`` each. Of a batch only the
    distinct grams and words travel: to the shards (one for each ``shard_bytes``
    of text) that sum them over the corpus, then with their values back to the
    batch, where the texts meet them.
    """
    if not 3 <= order <= 6:
        raise ValueError("order must be 3 to 6")
    key = F.col(f"`{id_column}`")
    # Of a row's number the upper bits are its partition, the lower 33 its place there.
    number = F.monotonically_increasing_id()
    stretch = F.shiftright(number, 33) + F.floor(number.bitwiseAND(F.lit((1 << 33) - 1)) / batch_rows)
    written = settle(
        docs.select(
            stretch.alias("stretch"), key.cast("long").alias("doc_id"), held_out(key).alias("held_out"),
            F.col(f"`{text_column}`").cast("binary").alias("text"),
        ),
        "texts",
    )
    size, ends = written.agg(
        F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count_if(~F.col("held_out"))
    ).first()
    # Odd, so that every bit of a gram decides on its shard.
    shards = max(8, -(-size // shard_bytes)) | 1
    rows = written.withColumn("batch", F.pmod("stretch", F.lit(max(1, -(-size // batch_bytes)))))
    learned = rows.select("batch", (~F.col("held_out")).alias("learned"), "text")
    requests = settle(gathered(learned, order, shards), "parcels")
    sums = settle(counted(requests), "sums")
    in_words, kinds = word_totals(sums)
    tokens, distinct = in_words + ends, kinds + (ends > 0)
    values = settle(costs(rows_of(sums), order, group_rows), "costs")
    answers = answered(requests, sums, values, shards)

    none = F.lit(None)
    blobs = ["grams", "gram_n", "words", "word_n"]
    together = answers.select(
        "batch", F.lit(0).alias("kind"), none.cast("long").alias("doc_id"), F.lit(False).alias("learned"),
        none.cast("binary").alias("text"), *blobs,
    ).union(
        rows.select(
            "batch", F.lit(1).alias("kind"), "doc_id", F.lit(False).alias("learned"), "text",
            *[none.cast("binary").alias(c) for c in blobs],
        )
    )
    by_batch = together.repartition("batch").sortWithinPartitions("batch", "kind")
    return scored(by_batch, order, ends, tokens + 0.5 * (distinct + 1)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known",
        F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score",
    )
