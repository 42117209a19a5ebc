"""Spelling variants by k-d trees over letter-count vectors."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumetric.session import settle

RUN = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Letters of words in the order of their vectors: a to z, then U+00C0 to U+00FF.
N_LETTERS = 26 + 64
# How many letters a near word may have more, and how many less, by its length minus the own length.
REACH = {0: (1, 1), 1: (1, 0), -1: (0, 1)}

DEALT = "length int, cell int, block int, home boolean, word string, n long"
FOUND = "word string, n long, n_near long, form string, form_n long"


def vocabulary(
    docs: DataFrame,
    *,
    min_letters: int = 5,
    min_count: int = 3,
    damage: int | None = 97,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """word, n: the words of all texts with their number of occurrences.

    Words are maximal runs of Latin letters, A to Z in lower case. If ``damage``
    divides the CRC of ``<id>:<word>``, the word loses the letter at the CRC's
    remainder by its length: misspellings made on purpose; None makes none.
    Words of fewer than ``min_letters`` letters or ``min_count`` occurrences go.

    A null text has no words; a null id counts as an empty string; repeated
    rows count again. Occurrences are counted before the shuffle, so that a
    frequent word sends one row a task.
    """
    key = F.coalesce(F.col(f"`{id_column}`").cast("string"), F.lit(""))
    runs = F.explode(F.regexp_extract_all(F.col(f"`{text_column}`"), F.lit(RUN), F.lit(0)))
    words = docs.select(key.alias("key"), runs.alias("run")).withColumn("word", F.translate("run", UPPER, LOWER))
    if damage:
        crc = F.crc32(F.concat_ws(":", "key", "word").cast("binary"))
        lost = F.pmod(F.col("crc"), F.length("word").cast("long")).cast("int")
        shorter = F.concat(F.col("word").substr(F.lit(1), lost), F.col("word").substr(lost + 2, F.length("word")))
        words = words.where(F.length("word") >= min_letters).withColumn("crc", crc).select(
            F.when(F.col("crc") % damage == 0, shorter).otherwise(F.col("word")).alias("word")
        )
    return (
        words.where(F.length("word") >= min_letters)
        .groupBy("word")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= min_count)
    )


# --- letters and vectors ------------------------------------------------------------------------
#
# Words hold only code points up to U+00FF, so Latin-1 has one byte a letter, in code-point order.


def letters_of(words: list[bytes]) -> np.ndarray:
    """The letters of words of one length, a row each."""
    return np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1)


def vectors_of(words: list[bytes], cells: int = 1 << 24) -> np.ndarray:
    """How often each word of one length has each letter."""
    step = max(1, cells // max(len(words[0]), N_LETTERS)) if words else 1
    parts = [np.zeros((0, N_LETTERS), np.int32)]
    for a in range(0, len(words), step):
        letters = letters_of(words[a : a + step]).astype(np.int64)
        codes = np.where(letters < 128, letters - ord("a"), letters - 0xC0 + 26)
        codes += np.arange(len(letters))[:, None] * N_LETTERS
        counts = np.bincount(codes.ravel(), minlength=len(letters) * N_LETTERS)
        parts.append(counts.reshape(-1, N_LETTERS).astype(np.int32))
    return np.concatenate(parts)


# --- k-d trees ----------------------------------------------------------------------------------
#
# A node splits the words of one length by how often they have one letter. One edit changes the
# vector by L1 distance two at most: a replaced letter takes one count up and one down, an inserted
# one takes one count up. So a search follows every branch whose box needs no more letters added or
# removed than the edit may; `REACH` holds both numbers, which prune more than their sum does.


def best_split(vectors: np.ndarray) -> tuple[int, int] | None:
    """The letter and its highest count on the left that part the rows most evenly."""
    middle = np.sort(vectors, axis=0)[(len(vectors) - 1) // 2]
    best, least = None, 0
    for most in (middle, middle - 1):
        left = (vectors <= most).sum(axis=0)
        smaller = np.minimum(left, len(vectors) - left)
        letter = int(smaller.argmax())
        if smaller[letter] > least:
            best, least = (letter, int(most[letter])), smaller[letter]
    return best


def build(vectors: np.ndarray, leaf: int, first: int = 0) -> tuple[dict, int]:
    """A tree whose leaves hold at most ``leaf`` rows, or rows all alike, numbered from ``first``."""
    split = best_split(vectors) if len(vectors) > leaf else None
    if split is None:
        return {"leaf": first}, first + 1
    letter, most = split
    left = vectors[:, letter] <= most
    node = {"letter": letter, "most": most}
    node["left"], first = build(vectors[left], leaf, first)
    node["right"], first = build(vectors[~left], leaf, first)
    return node, first


def within(vectors: np.ndarray, low: np.ndarray, high: np.ndarray, reach: tuple[int, int]) -> np.ndarray:
    """Whether each row reaches the box by adding and removing no more letters than ``reach``."""
    more = np.maximum(low - vectors, 0).sum(axis=1)
    less = np.maximum(vectors - high, 0).sum(axis=1)
    return (more <= reach[0]) & (less <= reach[1])


def visited(
    node: dict, vectors: np.ndarray, reach: tuple[int, int], rows: np.ndarray | None = None,
    box: Mapping[int, tuple[int, int]] = {},
) -> Iterator[tuple[int, np.ndarray]]:
    """(leaf, rows) of all leaves whose box the rows reach; with reach (0, 0) the leaf they are in."""
    rows = np.arange(len(vectors)) if rows is None else rows
    if not len(rows):
        return
    if "leaf" in node:
        yield node["leaf"], rows
        return
    letter, most = node["letter"], node["most"]
    low, high = box.get(letter, (0, 1 << 30))
    for side, span in (("left", (low, min(high, most))), ("right", (max(low, most + 1), high))):
        inner = {**box, letter: span}
        spans = np.array(list(inner.values()))
        near = within(vectors[np.ix_(rows, list(inner))], spans[:, 0], spans[:, 1], reach)
        yield from visited(node[side], vectors, reach, rows[near], inner)


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether each row of letters of ``a`` becomes that of ``b`` by one edit; a is not longer, and not equal."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(axis=1) == 1
    ahead = np.logical_and.accumulate(a == b[:, :-1], axis=1).sum(axis=1)
    behind = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return ahead + behind >= a.shape[1]


def pairs_of(
    homes: list[bytes], others: list[bytes], leaf: int = 256, cells: int = 1 << 22
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(homes, others) as indices of words one edit apart; the words of each list have one length."""
    if not homes or not others:
        return
    size, gap = len(homes[0]), len(homes[0]) - len(others[0])
    # Sums of squares stay exact.
    kind = np.float32 if size < 1000 else np.float64
    at, of = vectors_of(homes), vectors_of(others)
    tree, _ = build(at, leaf)
    lives = dict(visited(tree, at, (0, 0)))
    home_letters, other_letters = letters_of(homes), letters_of(others)
    for number, rows in visited(tree, of, REACH[gap]):
        mine = lives[number]
        rows = rows[within(of[rows], at[mine].min(axis=0), at[mine].max(axis=0), REACH[gap])]
        step = max(1, cells // max(len(mine), size))
        for a in range(0, len(mine), cells):
            some = mine[a : a + cells]
            x = at[some].astype(kind)
            for b in range(0, len(rows), step):
                part = rows[b : b + step]
                y = of[part].astype(kind)
                apart = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :] - 2 * (x @ y.T)
                # One letter more and one less, or one letter more or less.
                i, j = np.nonzero(apart == (1 if gap else 2))
                i, j = some[i], part[j]
                for c in range(0, len(i), max(1, cells // size)):
                    k = slice(c, c + max(1, cells // size))
                    short, long = home_letters[i[k]], other_letters[j[k]]
                    if gap > 0:
                        short, long = long, short
                    good = one_edit(short, long)
                    yield i[k][good], j[k][good]


# --- dealing ------------------------------------------------------------------------------------


def dealt(words: DataFrame, trees: dict[int, dict], blocks: dict[tuple[int, int], int], visit: bool = True) -> DataFrame:
    """Every word in the cell of its tree, and with ``visit`` in all cells that it reaches.

    ``trees`` holds a tree for each length of many words; other lengths are one
    cell. A cell that its tree can't split has ``blocks``: its words are spread
    over them, and visitors come to each.
    """
    sent = words.sparkSession.sparkContext.broadcast((trees, blocks))

    def rows_of(length, cell, block, home, some, counts):
        columns = [
            pa.array(np.full(len(some), length, np.int32)),
            pa.array(np.full(len(some), cell, np.int32)),
            pa.array(np.asarray(block, np.int32)),
            pa.array(np.full(len(some), home)),
            some,
            counts,
        ]
        return pa.RecordBatch.from_arrays(columns, ["length", "cell", "block", "home", "word", "n"])

    def deal(batches):
        trees, blocks = sent.value
        for batch in batches:
            words, counts = batch.column("word"), batch.column("n")
            plain = [w.encode("latin-1") for w in words.to_pylist()]
            sizes = np.array(list(map(len, plain)), np.int64)
            for size in np.unique(sizes).tolist():
                every = np.flatnonzero(sizes == size)
                step = max(1, (1 << 24) // max(size, N_LETTERS))
                for a in range(0, len(every), step):
                    chosen = every[a : a + step]
                    vectors = vectors_of([plain[i] for i in chosen])
                    spread = batch.column("spread").to_numpy()[chosen]
                    for gap, reach in REACH.items() if visit else [(0, (0, 0))]:
                        tree = trees.get(size + gap, {"leaf": 0})
                        lives = np.full(len(chosen), -1)
                        if not gap:
                            for cell, rows in visited(tree, vectors, (0, 0)):
                                lives[rows] = cell
                        for cell, rows in visited(tree, vectors, reach):
                            home = lives[rows] == cell
                            parts = blocks.get((size + gap, cell), 1)
                            own = spread[rows] % parts
                            for block in range(parts):
                                for here, some in ((True, rows[home & (own == block)]), (False, rows[~(home & (own == block))])):
                                    if len(some):
                                        at = pa.array(chosen[some])
                                        yield rows_of(
                                            size + gap, cell, np.full(len(some), block), here,
                                            words.take(at), counts.take(at),
                                        )

    keyed = words.select("word", "n", F.pmod(F.xxhash64("word"), F.lit(1 << 30)).alias("spread"))
    return keyed.mapInArrow(deal, DEALT)


def cells_of(
    words: DataFrame, cell_rows: int, sample_rows: int
) -> tuple[dict[int, dict], dict[tuple[int, int], int]]:
    """Trees by length and blocks by cell, so that no cell's block has much over ``cell_rows`` words.

    Trees come from a bounded sample; cells that are still too large are sampled
    and split again until none is, or its words all have the same letters.
    """
    trees: dict[int, dict] = {}
    leaves: dict[int, int] = {}
    blocks: dict[tuple[int, int], int] = {}
    sizes = words.groupBy(F.length("word").alias("length"), F.lit(0).alias("cell"))
    while True:
        # At most one row for each 2 * cell_rows words.
        found = sizes.agg(F.count("*").alias("n")).where(F.col("n") > 2 * cell_rows).collect()
        large = {(r.length, r.cell): r.n for r in found if (r.length, r.cell) not in blocks}
        if not large:
            return trees, blocks
        share = min(1.0, sample_rows / sum(large.values()))
        homes = dealt(words, trees, {}, visit=False)
        wanted = words.sparkSession.createDataFrame(list(large), "length int, cell int")
        sample: dict[tuple[int, int], list[bytes]] = {cell: [] for cell in large}
        chosen = F.pmod(F.xxhash64("word", F.lit(len(leaves))), F.lit(1 << 30)) < int(share * (1 << 30))
        for r in homes.where(chosen).join(wanted, ["length", "cell"], "left_semi").limit(2 * sample_rows).collect():
            sample[r.length, r.cell].append(r.word.encode("latin-1"))
        for (length, cell), some in sample.items():
            some.sort()
            leaf = max(8, int(cell_rows * len(some) / large[length, cell]))
            tree, first = build(vectors_of(some), leaf, leaves.get(length, 1))
            if "leaf" in tree:
                blocks[length, cell] = -(-large[length, cell] // cell_rows)
            else:
                trees[length] = replaced(trees.get(length, {"leaf": 0}), cell, tree)
                leaves[length] = first
        sizes = dealt(words, trees, {}, visit=False).groupBy("length", "cell")


def replaced(node: dict, leaf: int, tree: dict) -> dict:
    """The tree with another one in place of a leaf."""
    if "leaf" in node:
        return tree if node["leaf"] == leaf else node
    return {**node, "left": replaced(node["left"], leaf, tree), "right": replaced(node["right"], leaf, tree)}


# --- variants -----------------------------------------------------------------------------------


def near_words(words: DataFrame, cell_rows: int = 8192, sample_rows: int = 100_000) -> DataFrame:
    """word, n, n_near, form, form_n: how many words are one edit away, and the form among them.

    ``words`` (word, n) holds each word once. The form is the near word of the
    largest n, the smallest of equal ones, if its n is at least twice the word's.
    Each cell of the trees is a group of bounded size with all visitors it needs,
    so a word's near words meet it in one place and pairs are never written.
    """
    trees, blocks = cells_of(words, cell_rows, sample_rows)

    def search(table: pa.Table) -> pa.Table:
        words = [w.encode("latin-1") for w in table.column("word").to_pylist()]
        counts = table.column("n").to_numpy()
        home = table.column("home").to_numpy()
        sizes = np.array(list(map(len, words)), np.int64)
        # Places by falling n, then by word: the best near word has the least.
        place = np.empty(len(words), np.int64)
        ranked = sorted(range(len(words)), key=lambda i: (-counts[i], words[i]))
        place[ranked] = np.arange(len(words))
        mine = np.flatnonzero(home)
        best = np.full(len(mine), len(words))
        n_near = np.zeros(len(mine), np.int64)
        homes = [words[i] for i in mine]
        for size in np.unique(sizes).tolist() if len(mine) else []:
            others = np.flatnonzero(sizes == size)
            for i, j in pairs_of(homes, [words[k] for k in others]):
                np.minimum.at(best, i, place[others[j]])
                n_near += np.bincount(i, minlength=len(mine))
        nearest = np.array([*ranked, -1])[best]
        most = np.where(nearest >= 0, counts[nearest], 0) if len(words) else n_near
        formed = (nearest >= 0) & (most >= 2 * counts[mine])
        none = ~formed
        return pa.table(
            {
                "word": table.column("word").take(pa.array(mine)),
                "n": pa.array(counts[mine]),
                "n_near": pa.array(n_near),
                "form": table.column("word").take(pa.array(nearest, mask=none)),
                "form_n": pa.array(most, pa.int64(), mask=none),
            }
        )

    shards = dealt(words, trees, blocks).groupBy("length", "cell", "block")
    return shards.applyInArrow(search, FOUND)


def roots(formed: DataFrame) -> DataFrame:
    """word, root: where the forms of forms end, for words with a form (word, form).

    A form has at least twice the occurrences, so a chain has at most 63 links
    and six rounds of doubled jumps end it. Words that have arrived leave, so a
    root shared by very many words is never a hot key of a later round.
    """
    step = settle(formed.where("form is not null").select("word", F.col("form").alias("root")), "forms")
    known, arrived = step, step.limit(0)
    for _ in range(6):
        ahead = known.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = settle(
            step.join(ahead, "root", "left").select(
                "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("on")
            ),
            "forms",
        )
        arrived = arrived.union(moved.where("not on").select("word", "root"))
        step = moved.where("on").select("word", "root")
        known = arrived.union(step)
        if step.isEmpty():
            break
    return known


def variants(
    docs: DataFrame,
    *,
    min_letters: int = 5,
    min_count: int = 3,
    damage: int | None = 97,
    cell_rows: int = 8192,
    sample_rows: int = 100_000,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the texts' ``vocabulary``.

    Two words are near if one inserted, deleted or replaced letter turns one
    into the other. ``n_near`` counts near words, ``form`` is the most frequent
    one if it is at least twice as frequent, ``root`` where following forms ends,
    the word itself without a form. Nulls, repeated rows and ids: as there. Ties
    go to the smaller word. Without words there are no rows.
    """
    words = vocabulary(
        docs, min_letters=min_letters, min_count=min_count, damage=damage, id_column=id_column, text_column=text_column
    )
    found = settle(near_words(settle(words, "vocabulary"), cell_rows, sample_rows), "near-words")
    return found.join(roots(found), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
