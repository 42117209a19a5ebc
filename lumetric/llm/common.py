"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import re
import sys
import types
from collections.abc import Callable, Iterator, Sequence
from itertools import chain
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lumetric.session import settle

# Words of the contracts: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def relieve() -> None:
    """Give freed memory of this Python worker back to the system: it idles beside the stages that follow."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def _kept() -> dict:
    name = "_lumetric_worker"
    return sys.modules.setdefault(name, types.ModuleType(name)).__dict__.setdefault("kept", {})


def forget() -> None:
    """Drop what the worker keeps, in a stage that has no use for it."""
    _kept().clear()
    relieve()


def resident(key: tuple, make: Callable[[], Any]) -> Any:
    """What one Python worker keeps from task to task, such as a loaded tokenizer.

    Functions travel to workers by value, so their own module globals are new
    in every task; this belongs to the worker process instead. Only the last
    one is kept, so stages that follow each other don't add up in memory.
    """
    kept = _kept()
    if key not in kept:
        forget()
        kept[key] = make()
    return kept[key]


def chunks_of(texts: Sequence[str], chars: int = 2_000_000) -> Iterator[tuple[int, int]]:
    """Index ranges of consecutive texts with about ``chars`` characters, at least one text."""
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= chars:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


class _Numbers(dict):
    """Chunk -> number; an unknown chunk gets the next number and is remembered as new."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, chunk: str) -> int:
        number = self[chunk] = len(self)
        self.new.append(chunk)
        return number


class ChunkEncoder:
    """Token ids by the ``tokenizers`` library, encoding each distinct chunk once.

    A chunk is a run of blanks and newlines with the run of other characters
    after it. Both vocabularies cut words at white space, so the ids of a text
    are the ids of its chunks in order. A text of one-byte characters has fewer
    different chunks: the lower-casing vocabulary also cuts letters from all
    else, save contractions, so one without an apostrophe is cut there, and for
    the byte vocabulary chunks are the pieces of its own rule. Texts with other
    white space, where none of this need hold, or with the text of an added
    token (in any case), are encoded whole. About ``limit`` chunks are kept; beyond it, those
    met least often go.
    """

    CHUNK = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
    WORDS = re.compile(r"[a-zªµºß-öø-ÿ]+|[^a-zªµºß-öø-ÿ \n]+")
    # The pieces of the byte vocabulary's rule, for letters and digits of one byte.
    PIECES = re.compile(
        r"'(?:[stmd]|re|ve|ll)| ?[A-Za-zªµºÀ-ÖØ-öø-ÿ]+| ?[0-9²³¹¼½¾]+| ?[^A-Za-zªµºÀ-ÖØ-öø-ÿ0-9²³¹¼½¾ \n]+"
        r"|[ \n]+(?![^ \n])|[ \n]+"
    )
    OTHER_SPACE = re.compile(r"[^\S \n]")
    SINGLE = re.compile(r"[ ]?[^ \n\x01]+")
    BEYOND_LATIN = re.compile(r"[^\x00-\xff]")

    def __init__(self, path: str, limit: int = 500_000):
        import json
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.limit = limit
        added = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(added) or r"(?!)", re.IGNORECASE)
        settings = json.loads(self.tokenizer.to_str())
        normalizer, cutter = settings.get("normalizer"), settings.get("pre_tokenizer") or {}
        self.by_rule = normalizer is None and cutter.get("type") == "ByteLevel" and cutter.get("use_regex", True)
        # A text of one-byte letters has no combining marks, so lowering first changes nothing.
        self.lowers = "Lowercase" in json.dumps(normalizer)
        mark = self._ids(["a \x01 b"])[0]
        plain = self._ids(["a", " b", "b"])
        inner = mark[len(plain[0]) : -len(plain[2])] if self.lowers else self._ids(["\n"])[0]
        # What separates chunks that are encoded together; None where no single id does.
        self.mark = int(inner[0]) if len(inner) == 1 else None
        self.glue = " \x01 " if self.lowers else "\n"
        self._reset()

    def _reset(self) -> None:
        self.numbers = _Numbers()
        self.flat = np.zeros(0, np.uint32)
        # Where the ids of each chunk begin, and how many there are.
        self.begin = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.met = np.zeros(0, np.int64)

    def _trim(self) -> None:
        """Keep the chunks met most often, at most half of the limit."""
        floor = max(2, np.partition(self.met, -(self.limit // 2))[-(self.limit // 2)] + 1)
        keep = np.flatnonzero(self.met >= floor)
        lengths = self.size[keep]
        until = np.cumsum(lengths)
        places = np.arange(until[-1] if len(until) else 0) + np.repeat(self.begin[keep] - until + lengths, lengths)
        self.flat, self.begin, self.size, self.met = self.flat[places], until - lengths, lengths, self.met[keep]
        chunks = list(self.numbers)
        self.numbers = _Numbers()
        self.numbers.update((chunks[i], n) for n, i in enumerate(keep.tolist()))

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype=np.uint32) for e in found]

    def _learn(self, chunks: list[str]) -> None:
        """Append the ids of new chunks, in order."""
        begin, size = np.zeros(len(chunks), np.int64), np.zeros(len(chunks), np.int64)
        rows, filled = [self.flat], len(self.flat)
        single = self.SINGLE.fullmatch
        together = [i for i, c in enumerate(chunks) if self.mark is not None and len(c) <= 64 and single(c)]
        alone = set(range(len(chunks))).difference(together)
        for start in range(0, len(together), 1024):
            part = together[start : start + 1024]
            row = self._ids([self.glue.join([chunks[i] for i in part])])[0]
            cuts = np.flatnonzero(row == self.mark)
            if len(cuts) != len(part) - 1:  # a chunk holds the separating id itself
                alone.update(part)
                continue
            firsts, stops = np.r_[0, cuts + 1], np.r_[cuts, len(row)]
            # Without the separating ids, one less for each chunk before.
            begin[part] = filled + firsts - np.arange(len(part))
            size[part] = stops - firsts
            rows.append(row[row != self.mark])
            filled += len(rows[-1])
        rest = sorted(alone)
        for start in range(0, len(rest), 256):
            part = rest[start : start + 256]
            for i, row in zip(part, self._ids([chunks[i] for i in part])):
                begin[i], size[i] = filled, len(row)
                rows.append(row)
                filled += len(row)
        self.flat = np.concatenate(rows)
        self.begin, self.size = np.r_[self.begin, begin], np.r_[self.size, size]

    def encode(self, texts: Sequence[str]) -> Iterator[np.ndarray]:
        """The ids of each text, in order."""
        for start, stop in chunks_of(texts):
            yield from self._encode(texts[start:stop])

    def _encode(self, texts: Sequence[str]) -> Iterator[np.ndarray]:
        if len(self.numbers) > self.limit:
            self._trim()
        split, whole = [], {}
        for i, text in enumerate(texts):
            if self.OTHER_SPACE.search(text) or self.added.search(text):
                whole[i] = text
                split.append(())
            else:
                chunk = self.CHUNK
                if text.isascii() or not self.BEYOND_LATIN.search(text):
                    if self.lowers:
                        text = text.lower()
                        chunk = self.CHUNK if "'" in text else self.WORDS
                    elif self.by_rule:
                        chunk = self.PIECES
                split.append(chunk.findall(text))
        counts = np.fromiter(map(len, split), np.int64, len(split))
        known = map(self.numbers.__getitem__, chain.from_iterable(split))
        numbers = np.fromiter(known, np.int64, int(counts.sum()))
        if self.numbers.new:
            self._learn(self.numbers.new)
            self.numbers.new = []
            self.met = np.pad(self.met, (0, len(self.numbers) - len(self.met)))
        self.met += np.bincount(numbers, minlength=len(self.met))
        lengths = self.size[numbers]
        until = np.cumsum(lengths)
        total = int(until[-1]) if len(until) else 0
        place = np.arange(total) + np.repeat(self.begin[numbers] - until + lengths, lengths)
        flat = self.flat[place]
        text_ends = np.r_[0, until][np.cumsum(counts)]
        text_starts = np.r_[0, text_ends[:-1]]
        direct = dict(zip(whole, self._ids(list(whole.values())))) if whole else {}
        for i in range(len(texts)):
            yield direct[i] if i in direct else flat[text_starts[i] : text_ends[i]]


def encoder(path: str) -> ChunkEncoder:
    """The worker's encoder for a vocabulary file, loaded once."""
    return resident(("encoder", path), lambda: ChunkEncoder(path))


def texts_of(column) -> list[str]:
    """Arrow strings as Python strings, null as empty."""
    return [t or "" for t in column.to_pylist()]


def sampled(df: DataFrame, rows: int, key: Column) -> DataFrame:
    """About ``rows`` rows (never over twice as many), chosen by a hash of ``key``.

    A bounded sample for fitting only; the same rows are chosen in every run.
    """
    total = df.count()
    if total <= rows:
        return df
    share = rows / total
    return df.where(F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(1 << 40)) < int(share * (1 << 40))).limit(2 * rows)


def index_within(df: DataFrame, key: str, order: Sequence[str], name: str) -> DataFrame:
    """0-based position of each row among those of equal ``key``, by ``order``.

    Rows are range-partitioned by key and order and written with their
    partition number, so a frequent key is spread over partitions; a position
    is the size of the earlier partitions plus the place in the own one.
    """
    spread = df.repartitionByRange(key, *order)
    placed = settle(spread.withColumn("_part", F.spark_partition_id()), "placed")
    counts = placed.groupBy(key, "_part").agg(F.count("*").alias("_n"))
    # One row per partition and key of it: a key has at most as many as there are partitions.
    before = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(key, "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    local = F.row_number().over(Window.partitionBy(key, "_part").orderBy(*order)) - 1
    return (
        placed.withColumn("_local", local)
        .join(starts, [key, "_part"])
        .withColumn(name, F.col("_start") + F.col("_local"))
        .select(*df.columns, name)
    )
