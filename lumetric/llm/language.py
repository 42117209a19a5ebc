"""Language identification by a bidirectional gated recurrent network over bytes."""

from __future__ import annotations

import hashlib
import pickle
import re
from collections.abc import Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumetric.llm.common import _Numbers, chunks_of, relieve, resident

WINDOW = 32  # bytes at most; state starts anew at white space
LETTER = re.compile(r"[^\W\d_]")
UNKNOWN = "und"
Params = dict[str, np.ndarray]


def held_out(doc_id: Column) -> Column:
    """Rows that nothing is learned from: crc32 of the id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


# --- the network -----------------------------------------------------------------------------


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


def initial(classes: int, hidden: int, seed: int = 0) -> Params:
    rng = np.random.default_rng(seed)
    params = {"out": rng.normal(0, 0.1, (2 * hidden, classes)), "bias": np.zeros(classes)}
    for side in ("f", "b"):
        params[side + "x"] = rng.normal(0, 0.3, (256, 3 * hidden))
        params[side + "h"] = rng.normal(0, 1 / np.sqrt(hidden), (hidden, 3 * hidden))
    return {k: v.astype(np.float32) for k, v in params.items()}


def run(x: np.ndarray, wx: np.ndarray, wh: np.ndarray, keep: bool = False):
    """Hidden states (time, row, hidden) of a gated recurrent layer over bytes (row, time)."""
    hidden = wh.shape[0]
    h = np.zeros((len(x), hidden), np.float32)
    states, cache = np.empty((x.shape[1], len(x), hidden), np.float32), []
    for t in range(x.shape[1]):
        a, u = wx[x[:, t]], h @ wh
        gates = sigmoid(a[:, : 2 * hidden] + u[:, : 2 * hidden])
        z, r = gates[:, :hidden], gates[:, hidden:]
        n = np.tanh(a[:, 2 * hidden :] + r * u[:, 2 * hidden :])
        if keep:
            cache.append((h, z, r, n, u[:, 2 * hidden :]))
        h = n + z * (h - n)
        states[t] = h
    return states, cache


def back(x: np.ndarray, wh: np.ndarray, cache: list, grads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of both weights, through time, from those of the hidden states."""
    hidden = wh.shape[0]
    gx = np.zeros((256, 3 * hidden), np.float32)
    gh = np.zeros_like(wh)
    carried = np.zeros((len(x), hidden), np.float32)
    for t in range(x.shape[1] - 1, -1, -1):
        h, z, r, n, u = cache[t]
        g = grads[t] + carried
        gn = g * (1 - z) * (1 - n * n)
        gz = g * (h - n) * z * (1 - z)
        gr = gn * u * r * (1 - r)
        ga = np.hstack([gz, gr, gn])
        gu = np.hstack([gz, gr, gn * r])
        np.add.at(gx, x[:, t], ga)
        gh += h.T @ gu
        carried = g * z + gu @ wh.T
    return gx, gh


def reversed_rows(x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Each row turned round within its length."""
    at = lengths[:, None] - 1 - np.arange(x.shape[1])
    return np.where(at >= 0, np.take_along_axis(x, np.maximum(at, 0), 1), 0)


def positions(params: Params, x: np.ndarray, lengths: np.ndarray, keep: bool = False):
    """Class probabilities (row, time, class) of every byte, from both directions."""
    forward, fc = run(x, params["fx"], params["fh"], keep)
    turned = reversed_rows(x, lengths)
    backward, bc = run(turned, params["bx"], params["bh"], keep)
    at = np.maximum(lengths[:, None] - 1 - np.arange(x.shape[1]), 0)
    rows = np.arange(len(x))[:, None]
    both = np.concatenate([forward.transpose(1, 0, 2), backward[at, rows]], axis=2)
    scores = both @ params["out"] + params["bias"]
    scores -= scores.max(axis=2, keepdims=True)
    np.exp(scores, out=scores)
    scores /= scores.sum(axis=2, keepdims=True)
    return scores, (both, turned, fc, bc)


def gradients(params: Params, x: np.ndarray, lengths: np.ndarray, label: np.ndarray) -> tuple[float, Params]:
    """Mean cross-entropy over all positions, and its gradients by backpropagation through time."""
    probs, (both, turned, fc, bc) = positions(params, x, lengths, keep=True)
    mask = np.arange(x.shape[1]) < lengths[:, None]
    total = mask.sum()
    rows = np.arange(len(x))[:, None]
    times = np.arange(x.shape[1])[None, :]
    loss = -(np.log(np.maximum(probs[rows, times, label[:, None]], 1e-12)) * mask).sum() / total
    probs[rows, times, label[:, None]] -= 1
    d = (probs * mask[:, :, None] / total).astype(np.float32)
    flat, flat_d = both.reshape(-1, both.shape[2]), d.reshape(-1, d.shape[2])
    grads = {"out": flat.T @ flat_d, "bias": flat_d.sum(axis=0)}
    g = d @ params["out"].T
    hidden = g.shape[2] // 2
    grads["fx"], grads["fh"] = back(x, params["fh"], fc, g[:, :, :hidden].transpose(1, 0, 2))
    at = np.maximum(lengths[:, None] - 1 - np.arange(x.shape[1]), 0)
    gb = np.take_along_axis(g[:, :, hidden:], at[:, :, None], 1) * mask[:, :, None]
    grads["bx"], grads["bh"] = back(turned, params["bh"], bc, gb.transpose(1, 0, 2))
    return float(loss), grads


def padded(windows: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(w) for w in windows])
    x = np.zeros((len(windows), int(lengths.max())), np.int64)
    for row, w in zip(x, windows):
        row[: len(w)] = np.frombuffer(w, np.uint8)
    return x, lengths


def train(windows: Sequence[bytes], labels: np.ndarray, classes: int, *, hidden: int = 16,
          steps: int = 500, batch: int = 512, rate: float = 0.02, seed: int = 0) -> Params:
    """Adam on batches with as many windows of each class as of any other."""
    rng = np.random.default_rng(seed)
    params = initial(classes, hidden, seed)
    first = {k: np.zeros_like(v) for k, v in params.items()}
    second = {k: np.zeros_like(v) for k, v in params.items()}
    groups = [np.flatnonzero(labels == c) for c in range(classes)]
    groups = [g for g in groups if len(g)]
    for step in range(1, steps + 1):
        chosen = np.concatenate([rng.choice(g, max(1, batch // len(groups))) for g in groups])
        x, lengths = padded([windows[i] for i in chosen])
        _, grads = gradients(params, x, lengths, labels[chosen])
        slow = rate * min(1.0, 2 * (1 - step / (steps + 1)))
        for k, g in grads.items():
            first[k] += 0.1 * (g - first[k])
            second[k] += 0.01 * (g * g - second[k])
            move = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
            params[k] = (params[k] - slow * move).astype(np.float32)
    return params


# --- documents -------------------------------------------------------------------------------


def windows_of(text: str) -> list[bytes]:
    """A text's bytes, cut at white space and after every ``WINDOW`` bytes: all of them but the blanks."""
    words = text.encode("utf-8", "surrogatepass").split()
    if words and max(map(len, words)) > WINDOW:
        words = [w[a : a + WINDOW] for w in words for a in range(0, len(w), WINDOW)]
    return words


class Labeller:
    """Sums of position probabilities by window; each distinct window is run once, some are kept."""

    def __init__(self, params: Params, limit: int = 200_000):
        self.params, self.limit = params, limit
        self.classes = params["out"].shape[1]
        self._reset()

    def _reset(self) -> None:
        self.numbers, self.sums = _Numbers(), np.zeros((0, self.classes))

    def _learn(self, windows: list[bytes]) -> None:
        order = sorted(range(len(windows)), key=lambda i: len(windows[i]))
        found = np.zeros((len(windows), self.classes))
        for a in range(0, len(order), 2048):
            part = order[a : a + 2048]
            x, lengths = padded([windows[i] for i in part])
            probs, _ = positions(self.params, x, lengths)
            mask = np.arange(x.shape[1]) < lengths[:, None]
            found[part] = (probs * mask[:, :, None]).sum(axis=1)
        self.sums = np.concatenate([self.sums, found])

    def documents(self, texts: Sequence[str]) -> np.ndarray:
        """Mean probability of each class over all positions of each text; 0 without positions."""
        if len(self.numbers) > self.limit:
            self._reset()
        split = [windows_of(t) for t in texts]
        counts = np.fromiter(map(len, split), np.int64, len(split))
        known = map(self.numbers.__getitem__, chain.from_iterable(split))
        numbers = np.fromiter(known, np.int64, int(counts.sum()))
        if self.numbers.new:
            self._learn(self.numbers.new)
            self.numbers.new = []
        result = np.zeros((len(texts), self.classes))
        some = np.flatnonzero(counts)
        if len(some):
            firsts = (np.cumsum(counts) - counts)[some]
            sums = np.add.reduceat(self.sums[numbers], firsts, axis=0)
            result[some] = sums / sums.sum(axis=1, keepdims=True)
        return result


def fit(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang",
        per_language: int = 200, longest: int = 1 << 16, windows: int = 40_000) -> tuple[list[str], Params]:
    """Languages and network, learned from rows that are not held out and have a language.

    The sample is bounded: by hash of the id about ``per_language`` documents of
    at most ``longest`` bytes for each language, at most twice as many, and
    ``windows`` different places in them for each language.
    """
    rows = docs.where(~held_out(F.col(id_column)) & F.col(lang_column).isNotNull()).select(
        F.col(id_column).alias("id"), F.col(text_column).alias("text"), F.col(lang_column).alias("lang")
    )
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(counts)
    if not languages:
        return [], {}
    share = F.create_map(*chain.from_iterable((F.lit(c), F.lit(per_language / n)) for c, n in counts.items()))
    place = F.pmod(F.xxhash64("id", F.lit("language")), F.lit(1 << 30)) / float(1 << 30)
    chosen = rows.where((F.octet_length("text") <= longest) & (place < share[F.col("lang")]))
    taken = chosen.limit(2 * per_language * len(languages)).orderBy("lang", "id", "text").collect()
    rng = np.random.default_rng(0)
    sample, labels = [], []
    for c, language in enumerate(languages):
        own = list(chain.from_iterable(windows_of(r.text) for r in taken if r.lang == language))
        if len(own) > windows:
            own = [own[i] for i in rng.choice(len(own), windows, replace=False)]
        sample += own
        labels += [c] * len(own)
    if not sample:
        return languages, initial(len(languages), 16)
    return languages, train(sample, np.array(labels), len(languages))


def predict(docs: DataFrame, languages: list[str], params: Params, *, id_column: str = "doc_id",
            text_column: str = "text") -> DataFrame:
    """All columns with lang_pred and score (mean probability of lang_pred over all bytes, 0 to 1).

    The network labels every byte of the whole text. State starts anew at white
    space and after 32 bytes, so a window's labels depend on it alone, and a
    window that a worker has seen is not run again. ``und`` with score 0 where
    the text is null or has no letter, or where nothing was learned. Rows are
    independent: repeated ones get the same label. Columns named lang_pred or
    score are replaced.
    """
    key = hashlib.sha256(pickle.dumps(params)).hexdigest()
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    narrow = docs.select(*[f"`{c}`" for c in kept])

    def label(batches):
        labeller = resident(("labeller", key), lambda: Labeller(params)) if params else None
        for batch in batches:
            texts = batch.column(text_column).to_pylist()
            found, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            asked = [i for i, t in enumerate(texts) if params and t and LETTER.search(t)]
            for a, b in chunks_of([texts[i] for i in asked]):
                part = asked[a:b]
                means = labeller.documents([texts[i] for i in part])
                for i, row in zip(part, means):
                    best = int(row.argmax())
                    found[i], scores[i] = languages[best], round(float(row[best]), 6)
            yield pa.RecordBatch.from_arrays(
                [*map(batch.column, kept), pa.array(found, pa.string()), pa.array(scores, pa.float64())],
                [*kept, "lang_pred", "score"],
            )
        relieve()

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema)
    return narrow.mapInArrow(label, f"{schema}, lang_pred string, score double")


def identify(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang",
             **fitting) -> DataFrame:
    """Learn from the rows that are not held out and label all of them; see ``fit`` and ``predict``.

    An empty table gives no rows.
    """
    languages, params = fit(docs, id_column=id_column, text_column=text_column, lang_column=lang_column, **fitting)
    return predict(docs, languages, params, id_column=id_column, text_column=text_column)
