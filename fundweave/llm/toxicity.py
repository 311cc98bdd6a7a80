"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy.

A word's embedding is the mean of the embeddings of its features (the word and its first and last
letters), looked up by hash, so unseen words of a known stem still mean something. Filters of several
widths slide over the words of the whole text, each filter keeps its largest response, and a logistic
layer gives the score.

Training takes every labelled row and its whole text. Rows meet their labels in one shuffle and are
stored as packs: the words of some `SHARD` documents as numbers, picked by a hash of their id, so that a
pack does not depend on the number of tasks. In each of `EPOCHS` rounds every pack is trained on by itself,
from the model of the round before, and the packs' steps are averaged: an embedding row over the packs
that moved it, the rest over all. Steps are added as whole numbers, so their order does not matter. The
driver holds the model, whose size does not depend on the corpus. Scoring covers every row and whole
text, in Arrow batches, without a shuffle; workers remember the embeddings of a bounded number of words.

Thresholds are calibrated by language on the labelled documents that are not trained on, a fifth by a hash
of their id: the cut with the best F1 among documents of that language, from counts by score. They
enter `flagged` only; the score itself sees nothing but the text.

Defined cases: null and empty texts are scored as texts without words; with labels of one class only
(or none) every score is that class's share (or 0); rows without a language, or with one not seen in
training, take the threshold of all languages; a row without an id has no label, rows that repeat an id
all count; an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from fundweave.operators.ordering import ordered_blocks, running_totals
from fundweave.sources.workspace import cut, discard

from .common import col, fresh, ship

#: Labelled documents of a pack, about.
SHARD = 1024
#: Words from which a pack is closed early.
PACK = 1 << 20
#: Rows of the embedding table; row 0 is the padding and stays zero.
ROWS = 1 << 20
WIDTH = 8
FILTERS = 12
SPANS = (1, 2, 3)
EPOCHS = 10
RATE = 0.08
#: Documents of a training step.
STEP = 32
#: Where Adagrad's sums of squares start.
FLOOR = 1e-6
SEED = 7
#: Steps are averaged as multiples of 1 / UNIT.
UNIT = 1 << 32
#: Words remembered by a worker before it starts over.
REMEMBER = 200_000
#: Words scored at a time.
BLOCK = 1 << 17
#: Places whose responses are laid out at a time, however long a document is.
PLACES = 1 << 13
EDGES = ".,!?;:\"'()[]"
#: CRC-32 of the letters that mark what a feature is made of.
FOUR, FIVE, END = (zlib.crc32(x) for x in (b"4", b"5", b"e"))


def tokens(text: str | None) -> list[str]:
    return (text or "").lower().split()


def features(word: str) -> tuple[int, int, int, int]:
    """Embedding rows of a word: the word, its first four and five letters, its last four."""
    w = word.strip(EDGES)
    crc, n = zlib.crc32, ROWS - 1
    b = w.encode()
    if len(b) == len(w):
        four, five, end = b[:4], b[:5], b[-4:]
    else:
        four, five, end = w[:4].encode(), w[:5].encode(), w[-4:].encode()
    return crc(b) % n + 1, crc(four, FOUR) % n + 1, crc(five, FIVE) % n + 1, crc(end, END) % n + 1


@dataclass
class Model:
    table: np.ndarray
    #: For each span, (span, WIDTH, FILTERS).
    filters: list[np.ndarray]
    shifts: list[np.ndarray]
    out: np.ndarray
    bias: float
    #: Set where there was nothing to tell apart: every score is this.
    constant: float | None = None
    thresholds: dict[str, float] = field(default_factory=dict)
    threshold: float = 0.5


def blank(seed: int = SEED) -> Model:
    r = np.random.default_rng(seed)
    table = (r.standard_normal((ROWS, WIDTH), np.float32) * 0.1).astype(np.float32)
    table[0] = 0
    filters = [
        (r.standard_normal((k, WIDTH, FILTERS)) * (0.5 / k)).astype(np.float32) for k in SPANS
    ]
    shifts = [np.zeros(FILTERS, np.float32) for _ in SPANS]
    out = (r.standard_normal(FILTERS * len(SPANS)) * 0.1).astype(np.float32)
    return Model(table, filters, shifts, out, -1.0)


def layout(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(first place, end of words, places in all) of documents laid out one after the other, each
    with one place at least and as many padding places behind it as the widest span reaches."""
    n = np.maximum(lengths, 1)
    size = n + max(SPANS) - 1
    starts = np.cumsum(size) - size
    return starts, starts + n, int(size.sum())


def taps(filters: list[np.ndarray]) -> np.ndarray:
    """(all filters, places of the widest span times WIDTH): embeddings of neighbouring words to the
    responses at the first of them. Shorter filters end in zeros."""
    out = np.zeros((FILTERS * len(filters), max(SPANS) * WIDTH), np.float32)
    for i, f in enumerate(filters):
        out[i * FILTERS : (i + 1) * FILTERS, : len(f) * WIDTH] = f.reshape(-1, FILTERS).T
    return out


def peaks(
    columns: np.ndarray, at: np.ndarray, starts: np.ndarray, stops: np.ndarray, taken: np.ndarray, find: bool
) -> tuple[np.ndarray, np.ndarray]:
    """Largest response (document, filter) in each document, and on request where it was. The word at
    a place is number `at`, its embedding that column of `columns`; `taken` are the filters' taps."""
    top = np.full((len(starts), len(taken)), -np.inf, np.float32)
    where = np.zeros(top.shape if find else (0, 0), np.int64)
    reach = max(SPANS) - 1
    for a in range(0, len(at) - reach, PLACES):
        n = min(PLACES, len(at) - reach - a)
        x = columns.take(at[a : a + n + reach], axis=1)
        z = taken @ np.concatenate([x[:, j : j + n] for j in range(reach + 1)])
        some = slice(np.searchsorted(stops, a, "right"), np.searchsorted(starts, a + n))
        begin, end = np.maximum(starts[some] - a, 0), np.minimum(stops[some] - a, n)
        if not len(begin):
            continue
        bounds = np.stack([begin, end], axis=1).ravel()
        best = np.maximum.reduceat(z, bounds[:-1] if bounds[-1] == n else bounds, axis=1)[:, ::2].T
        if find:
            here = np.stack([z[:, p:q].argmax(axis=1) + (a + p) for p, q in zip(begin, end)])
            where[some] = np.where(best > top[some], here, where[some])
        top[some] = np.maximum(top[some], best)
    return top, where


def embed(m: Model, rows: np.ndarray) -> np.ndarray:
    return m.table[rows].mean(axis=1)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Numbers(dict):
    """Numbers of words, from 1 on in the order in which they are first asked for."""

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self) + 1
        return n

    def of(self, texts: list[list[str]], n: int) -> np.ndarray:
        """Numbers of the `n` words of some texts, one after the other."""
        return np.fromiter(map(self.__getitem__, chain.from_iterable(texts)), np.int32, n)


@dataclass
class Pack:
    """Labelled documents as word numbers. Word 0 is the padding."""

    #: Embedding rows of the pack's words, each once and ascending, from 0 on.
    rows: np.ndarray
    #: (4, words): places in `rows` of a word's features.
    places: np.ndarray
    #: Word numbers of the documents, one after the other.
    words: np.ndarray
    lengths: np.ndarray
    labels: np.ndarray


def pack(texts: list[list[str]], labels: list[float]) -> Pack:
    """`texts` are given as tokens."""
    known, lengths = Numbers(), np.asarray([len(t) for t in texts], np.int32)
    words = known.of(texts, int(lengths.sum()))
    found = np.asarray([(0, 0, 0, 0), *map(features, known)], np.int32)
    rows, places = np.unique(found, return_inverse=True)
    return Pack(
        rows.astype(np.int32),
        np.ascontiguousarray(places.reshape(-1, 4).T).astype(np.int32),
        words,
        lengths,
        np.asarray(labels, np.float32),
    )


def parts(dense: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray, np.ndarray]:
    """Views of filters, shifts, output weights and bias in the vector that holds them."""
    shapes = [(k, WIDTH, FILTERS) for k in SPANS] + [(FILTERS,) for _ in SPANS] + [(FILTERS * len(SPANS),), (1,)]
    ends = np.cumsum([np.prod(x) for x in shapes])
    found = [dense[e - np.prod(x) : e].reshape(x) for e, x in zip(ends, shapes)]
    n = len(SPANS)
    return found[:n], found[n : 2 * n], found[-2], found[-1]


@lru_cache(maxsize=1)
def untrained(seed: int) -> Model:
    return blank(seed)


@dataclass
class State:
    """What a round starts from: the rows of the embedding table that were moved, the rest of the
    model as a vector, and Adagrad's sums of squares for both."""

    seed: int
    rows: np.ndarray
    values: np.ndarray
    past: np.ndarray
    dense: np.ndarray
    dense_past: np.ndarray
    #: Weights of a document labelled 0 and 1.
    weights: tuple[float, float]

    def local(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Embeddings and sums of squares of some rows."""
        table, past = untrained(self.seed).table[rows], np.full(len(rows), FLOOR, np.float32)
        if len(self.rows):
            ours = np.minimum(np.searchsorted(self.rows, rows), len(self.rows) - 1)
            mine = np.flatnonzero(self.rows[ours] == rows)
            table[mine], past[mine] = self.values[ours[mine]], self.past[ours[mine]]
        return table, past


def opening(seed: int, weights: tuple[float, float] = (1.0, 1.0)) -> State:
    m = untrained(seed)
    dense = np.concatenate([x.ravel() for x in (*m.filters, *m.shifts, m.out, np.array([m.bias]))]).astype(np.float32)
    none = np.zeros(0, np.int32)
    past = np.full(len(dense), FLOOR, np.float32)
    return State(seed, none, np.zeros((0, WIDTH), np.float32), none.astype(np.float32), dense, past, weights)


def closing(state: State) -> Model:
    m = blank(state.seed)
    m.table[state.rows] = state.values
    m.filters, m.shifts, m.out, bias = parts(state.dense)
    m.bias = float(bias[0])
    return m


def summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each key once, ascending, with the sum of its rows of `values`."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([keys[:1] == keys[:1], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(values[order], first, axis=0) if len(first) else values


class Steps:
    """Documents of a pack through the network, with the embeddings and weights at hand."""

    def __init__(self, p: Pack, table: np.ndarray, dense: np.ndarray) -> None:
        self.pack, self.table = p, table
        self.filters, self.shifts, self.out, self.bias = parts(dense)
        self.ends = np.cumsum(p.lengths, dtype=np.int64)
        self.seen, self.place = np.zeros(p.places.shape[1], bool), np.zeros(p.places.shape[1], np.int64)

    def forward(self, some: np.ndarray) -> np.ndarray:
        """Largest responses (document, filter) of some documents. Keeps what `pull` needs."""
        lengths = self.pack.lengths[some]
        starts, stops, places = layout(lengths)
        words = np.zeros(places, np.int32)
        for s, n, e in zip(starts, lengths, self.ends[some]):
            words[s : s + n] = self.pack.words[e - n : e]
        self.seen[words] = True
        used = np.flatnonzero(self.seen)
        self.seen[used] = False
        self.place[used] = np.arange(len(used))
        self.at = self.place[words]
        self.features = self.pack.places.take(used, axis=1)
        self.embedded = sum(self.table.take(f, axis=0) for f in self.features) / np.float32(4)
        columns = np.ascontiguousarray(self.embedded.T)
        top, self.where = peaks(columns, self.at, starts, stops, taps(self.filters), True)
        return np.maximum(top + np.concatenate(self.shifts), 0)

    def scores(self, top: np.ndarray) -> np.ndarray:
        return sigmoid(top @ self.out + self.bias[0])

    def pull(self, top: np.ndarray, error: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Gradients: of the vector of weights, and places of `table` with theirs."""
        d_top = error[:, None] * self.out[None, :] * (top > 0)
        g = np.zeros(sum(x.size for x in (*self.filters, *self.shifts, self.out, self.bias)), np.float32)
        g_filters, g_shifts, g_out, g_bias = parts(g)
        g_out[:], g_bias[0] = top.T @ error, error.sum()
        words, pulls = [], []
        for s, k in enumerate(SPANS):
            part = d_top[:, s * FILTERS : (s + 1) * FILTERS]
            where = self.where[:, s * FILTERS : (s + 1) * FILTERS]
            g_shifts[s][:] = part.sum(axis=0)
            for j in range(k):
                seen = self.at[np.minimum(where + j, len(self.at) - 1)]
                g_filters[s][j] = np.einsum("dfw,df->wf", self.embedded[seen], part)
                words.append(seen.ravel())
                pulls.append((part[:, :, None] * self.filters[s][j].T[None, :, :]).reshape(-1, WIDTH))
        word, total = summed(np.concatenate(words), np.concatenate(pulls))
        rows, total = summed(self.features[:, word].ravel(), np.tile(total / 4, (4, 1)))
        live = rows > 0
        return g, rows[live], total[live]


def advance(state: State, p: Pack, order: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """One epoch over a pack by Adagrad on the logistic loss. Max pooling leaves one place per filter and
    document a gradient, so a step touches few embedding rows. Returns (keys, steps as multiples of
    1 / `UNIT`): embedding rows with the move of their values and of their sum of squares, and below zero,
    from -1 down, the vectors of weights and of their sums of squares in lines of `WIDTH`."""
    table, past = state.local(p.rows)
    before, past_before = table.copy(), past.copy()
    dense, dense_past = state.dense.copy(), state.dense_past.copy()
    steps, weight = Steps(p, table, dense), np.where(p.labels == 1, state.weights[1], state.weights[0])
    turn = order.permutation(len(p.labels))
    for i in range(0, len(turn), STEP):
        some = turn[i : i + STEP]
        top = steps.forward(some)
        error = ((steps.scores(top) - p.labels[some]) * weight[some] / len(some)).astype(np.float32)
        g, rows, g_rows = steps.pull(top, error)
        dense_past += g * g
        dense -= RATE * g / np.sqrt(dense_past)
        past[rows] += (g_rows * g_rows).mean(axis=1)
        table[rows] -= RATE * g_rows / np.sqrt(past[rows])[:, None]
    moved = np.flatnonzero(past > past_before)
    rest = np.concatenate([dense - state.dense, dense_past - state.dense_past])
    rest = np.pad(rest, (0, -len(rest) % WIDTH)).reshape(-1, WIDTH)
    keys = np.concatenate([p.rows[moved], -1 - np.arange(len(rest))])
    lines = np.column_stack([table[moved] - before[moved], past[moved] - past_before[moved]])
    lines = np.concatenate([lines, np.pad(rest, ((0, 0), (0, 1)))])
    return keys, np.rint(lines.astype(float) * UNIT).astype(np.int64)


def averaged(state: State, keys: np.ndarray, steps: np.ndarray) -> State:
    """The state after a round; `steps` are the averages of what `advance` returned, divided by `UNIT`, by key."""
    order = np.argsort(keys)
    keys, steps = keys[order], steps[order].astype(np.float32)
    below = int(np.searchsorted(keys, 0))
    n = len(state.dense)
    rest = steps[:below][::-1, :WIDTH].ravel()
    rows = np.union1d(state.rows, keys[below:]).astype(np.int32)
    values, past = state.local(rows)
    at = np.searchsorted(rows, keys[below:])
    values[at] += steps[below:, :WIDTH]
    past[at] += steps[below:, WIDTH]
    return State(
        state.seed, rows, values, past, state.dense + rest[:n], state.dense_past + rest[n : 2 * n], state.weights
    )


def balance(share: float) -> tuple[float, float]:
    """Weights of the classes that make both weigh the same, by the share of class 1."""
    return 0.5 / (1 - share), 0.5 / share


def train(texts: list[str | None], labels: list[int], seed: int = SEED, epochs: int = EPOCHS) -> Model:
    """A model of one pack."""
    y = np.asarray(labels, np.float32)
    if not len(y) or y.min() == y.max():
        m = blank(seed)
        m.constant = float(y[0]) if len(y) else 0.0
        return m
    state, p = opening(seed, balance(float(y.mean()))), pack([tokens(t) for t in texts], labels)
    for epoch in range(epochs):
        keys, steps = advance(state, p, np.random.default_rng([seed, epoch]))
        state = averaged(state, keys, steps / UNIT)
    return closing(state)


def best_cut(scores: np.ndarray, labels: np.ndarray) -> float:
    """The cut with the best F1, half way between neighbouring scores; 0.5 without both classes."""
    if not len(labels) or labels.min() == labels.max():
        return 0.5
    order = np.argsort(-scores, kind="stable")
    s, y = scores[order], labels[order]
    hit = np.cumsum(y)
    f1 = 2 * hit / (np.arange(1, len(y) + 1) + y.sum())
    f1[:-1][s[:-1] == s[1:]] = -1
    best = int(np.argmax(f1))
    return float((s[best] + (s[best + 1] if best + 1 < len(s) else 0)) / 2)


BLOBS = ("rows", "places", "words", "lengths", "labels")
PACKS = "shard int, part int, held boolean, docs long, ones double, least float, most float, " + "".join(
    f"{b} binary, " for b in BLOBS
) + "langs array<string>"


def packed(docs: DataFrame, labels: DataFrame, shards: int) -> DataFrame:
    """Packs of the labelled rows of `docs` (doc_id, lang, text); `labels` has doc_id and toxic. A fifth
    of the ids is `held` back from training. A document and its label meet in their shard."""
    ship(docs.sparkSession)
    texts = docs.select("doc_id", "lang", "text", F.lit(None).cast("float").alias("toxic"), F.lit(True).alias("is_doc"))
    marks = labels.select(
        "doc_id", F.lit(None).cast("string").alias("lang"), F.lit(None).cast("string").alias("text"),
        F.col("toxic").cast("float").alias("toxic"), F.lit(False).alias("is_doc"),
    )
    both = texts.unionByName(marks).filter("doc_id IS NOT NULL")
    dealt = both.withColumns(
        {
            "shard": F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int"),
            "held": F.pmod(F.xxhash64("doc_id", F.lit("held")), F.lit(5)) == 0,
        }
    ).repartition("shard")
    same = Window.partitionBy("shard", "doc_id").orderBy(F.xxhash64("text", "lang"), "text", "lang")
    known = F.max("toxic").over(same.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    rows = dealt.withColumn("toxic", known).filter("is_doc AND toxic IS NOT NULL")
    return rows.select("shard", "held", "lang", "text", "toxic").mapInArrow(_packs, PACKS)


def _packs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come shard by shard."""
    schema = pa.schema(
        [("shard", pa.int32()), ("part", pa.int32()), ("held", pa.bool_()),
         ("docs", pa.int64()), ("ones", pa.float64()), ("least", pa.float32()), ("most", pa.float32()),
         *[(b, pa.binary()) for b in BLOBS], ("langs", pa.list_(pa.string()))]
    )
    shard, part = -1, 0
    kept: dict[bool, tuple[list, list, list]] = {h: ([], [], []) for h in (False, True)}
    size = {False: 0, True: 0}

    def closed(held: bool) -> Iterator[pa.RecordBatch]:
        nonlocal part
        texts, labels, langs = kept[held]
        if texts:
            p = pack(texts, labels)
            row = {
                "shard": shard, "part": part, "held": held, "docs": len(texts), "ones": float(p.labels.sum()),
                "least": float(p.labels.min()), "most": float(p.labels.max()), "langs": langs,
            }
            row |= {b: getattr(p, b).tobytes() for b in BLOBS}
            yield pa.RecordBatch.from_pylist([row], schema)
            part += 1
        kept[held], size[held] = ([], [], []), 0

    for batch in batches:
        for at, held, lang, text, toxic in zip(*[c.to_pylist() for c in batch.columns]):
            if at != shard:
                yield from closed(False)
                yield from closed(True)
                shard, part = at, 0
            words = tokens(text)
            for values, value in zip(kept[held], (words, toxic, lang)):
                values.append(value)
            size[held] += len(words)
            if size[held] >= PACK:
                yield from closed(held)
    yield from closed(False)
    yield from closed(True)


def unpacked(batch: pa.RecordBatch) -> Iterator[tuple[int, Pack]]:
    """(place in the batch, pack)."""
    kinds = (np.int32, np.int32, np.int32, np.int32, np.float32)
    for i in range(batch.num_rows):
        found = [np.frombuffer(batch.column(b)[i].as_buffer(), k) for b, k in zip(BLOBS, kinds)]
        yield i, Pack(found[0], found[1].reshape(4, -1), *found[2:])


STEP_COLUMNS = [f"s{i}" for i in range(WIDTH + 1)]


def one_round(packs: DataFrame, state: State, epoch: int) -> State:
    """Every pack trained on from `state`, steps averaged. A task adds up the steps of its packs."""
    shared = packs.sparkSession.sparkContext.broadcast(state)
    names = ["key", "n", *STEP_COLUMNS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = shared.value
        keys, steps = [np.zeros(0, np.int64)], [np.zeros((0, WIDTH + 2), np.int64)]

        def together() -> None:
            keys[:], steps[:] = [[x] for x in summed(np.concatenate(keys), np.concatenate(steps))]

        for batch in batches:
            numbers = zip(batch.column("shard").to_pylist(), batch.column("part").to_pylist())
            for (_, p), number in zip(unpacked(batch), numbers):
                k, moved = advance(start, p, np.random.default_rng([start.seed, epoch, *number]))
                keys.append(k)
                steps.append(np.column_stack([np.ones(len(k), np.int64), moved]))
                if sum(map(len, keys[1:])) > ROWS // 2:
                    together()
        together()
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (keys[0], *steps[0].T)], names=names)

    moves = packs.select("shard", "part", *BLOBS).mapInArrow(run, ", ".join(f"{n} long" for n in names))
    means = [(F.sum(c) / F.sum("n") / UNIT).cast("float").alias(c) for c in STEP_COLUMNS]
    found = moves.groupBy("key").agg(*means).toArrow()
    shared.destroy()
    return averaged(
        state, found.column("key").to_numpy(), np.column_stack([found.column(c).to_numpy() for c in STEP_COLUMNS])
    )


def rated(packs: DataFrame, state: State) -> DataFrame:
    """(lang, score, toxic) of the documents of packs."""
    shared = packs.sparkSession.sparkContext.broadcast(state)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column("langs").to_pylist()
            for i, p in unpacked(batch):
                steps = Steps(p, shared.value.local(p.rows)[0], shared.value.dense)
                some = [np.arange(j, min(j + STEP, len(p.labels))) for j in range(0, len(p.labels), STEP)]
                s = np.concatenate([steps.scores(steps.forward(x)) for x in some]).astype(float)
                columns = [pa.array(langs[i], pa.string()), pa.array(s), pa.array(p.labels)]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "score", "toxic"])

    return packs.select("langs", *BLOBS).mapInArrow(run, "lang string, score double, toxic float")


def cuts(scored: DataFrame) -> dict[str | None, float]:
    """`best_cut` of all rows (None) and of each language with both classes, from (lang, score, toxic).
    Rows are counted by score, and the counts added up in blocks."""
    groups = F.array(F.struct(F.lit(True).alias("all"), F.lit("").alias("lang")),
                     F.struct(F.lit(False).alias("all"), F.col("lang").alias("lang")))
    each = scored.select(F.explode(groups).alias("g"), "score", "toxic").select("g.*", "score", "toxic")
    hit = F.when(F.col("toxic") == 1, 1).otherwise(0)
    counts = (
        each.filter("lang IS NOT NULL").groupBy("all", "lang", (-F.col("score")).alias("low"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(hit).alias("hits"))
    )
    by = ["all", "lang"]
    summed_up = running_totals(
        ordered_blocks(counts, [*map(F.col, by), F.col("low")]), by, "_block", [F.col("low")],
        {"rows": F.col("n"), "found": F.col("hits")}, {"size": "rows", "positive": "found"},
    ).filter("positive > 0 AND positive < size")
    f1 = 2 * F.col("found") / (F.col("rows") + F.col("positive"))
    best = summed_up.groupBy(by).agg(F.max(F.struct(f1.alias("f1"), -F.col("low"))).alias("best"))
    best = best.select(*by, F.col("best.col2").alias("cut"))
    lower = F.max(F.when(-F.col("low") < F.col("cut"), -F.col("low")))
    found = counts.join(best, by).groupBy(*by, "cut").agg(F.coalesce(lower, F.lit(0.0)).alias("lower")).collect()
    return {None if r["all"] else r.lang: (r.cut + r.lower) / 2 for r in found}


def learn(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str | None = "lang",
    shard: int = SHARD,
) -> Model:
    """Trains on all labelled rows of `docs`; `labels` has doc_id and toxic."""
    spark, staged = docs.sparkSession, []
    rows = docs.select(
        col(id_col).alias("doc_id"),
        (col(lang_col) if lang_col else F.lit(None).cast("string")).alias("lang"),
        col(text_col).alias("text"),
    )
    known = labels.select("doc_id", "toxic").filter("doc_id IS NOT NULL AND toxic IS NOT NULL")
    packs = cut(packed(rows, known, max(1, -(-known.count() // shard))), "packs", staged, compression="zstd")
    mine = packs.filter("NOT held")
    of = mine.selectExpr("sum(docs) AS docs", "sum(ones) AS ones", "min(least) AS least", "max(most) AS most").first()
    if not of.docs or of.least == of.most:
        m = blank()
        m.constant = float(of.least or 0)
    else:
        state = opening(SEED, balance(of.ones / of.docs))
        for epoch in range(EPOCHS):
            state = one_round(mine, state, epoch)
        m = closing(state)
        m.thresholds = cuts(rated(packs.filter("held"), state))
        m.threshold = m.thresholds.pop(None, 0.5)
    discard(spark, staged)
    return m


class Scorer:
    """Scores texts with word embeddings remembered."""

    def __init__(self, m: Model) -> None:
        self.model, self.taps, self.shift = m, taps(m.filters), np.concatenate(m.shifts)
        self.start()

    def start(self) -> None:
        self.known = Numbers()
        self.words = np.zeros((1, WIDTH), np.float32)

    def numbers(self, texts: list[list[str]], n: int) -> np.ndarray:
        """Places of the `n` words in `self.words`, one after the other."""
        if len(self.known) > REMEMBER:
            self.start()
        ids = self.known.of(texts, n)
        new = [features(w) for w in islice(self.known, len(self.words) - 1, None)]
        if new:
            self.words = np.concatenate([self.words, embed(self.model, np.asarray(new, np.int32))])
        return ids

    def score(self, texts: list[str | None]) -> np.ndarray:
        if self.model.constant is not None:
            return np.full(len(texts), self.model.constant)
        out, group, size = [], [], 0
        for i, t in enumerate(texts):
            group.append(tokens(t))
            size += len(group[-1])
            if size > BLOCK or i == len(texts) - 1:
                ids = self.numbers(group, size)
                lengths = np.array([len(g) for g in group])
                starts, ends, places = layout(lengths)
                at = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
                full = np.zeros(places, np.int32)
                full[np.arange(len(ids)) + at] = ids
                top, _ = peaks(np.ascontiguousarray(self.words.T), full, starts, ends, self.taps, False)
                out.append(sigmoid(np.maximum(top + self.shift, 0) @ self.model.out + self.model.bias))
                group, size = [], 0
        return np.concatenate(out) if out else np.zeros(0)


def score(
    df: DataFrame, m: Model, text_col: str = "text", lang_col: str | None = "lang"
) -> tuple[DataFrame, dict[str, str]]:
    """`df` with score (0 to 1), predicted (score of 0.5 or more), threshold of the row's language
    and flagged (score at or above it); and the names they got."""
    ship(df.sparkSession)
    kinds = {"score": "double", "predicted": "integer", "threshold": "double", "flagged": "boolean"}
    names = dict(zip(kinds, fresh(df, *kinds)))
    shared = df.sparkSession.sparkContext.broadcast(m)
    place = df.columns.index(text_col)
    lang_place = df.columns.index(lang_col) if lang_col else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        cuts, other = shared.value.thresholds, shared.value.threshold
        for rows in batches:
            s = scorer.score(rows.column(place).to_pylist()).astype(float)
            if lang_place is None:
                at = np.full(len(s), other)
            else:
                langs = rows.column(lang_place).to_pylist()
                at = np.asarray([cuts.get(x, other) for x in langs], float)
            yield pa.RecordBatch.from_arrays(
                [
                    *rows.columns,
                    pa.array(s),
                    pa.array((s >= 0.5).astype(np.int32)),
                    pa.array(at),
                    pa.array(s >= at),
                ],
                names=schema.names,
            )

    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    schema = T.StructType(list(plain.schema.fields))
    for name, kind in kinds.items():
        schema = schema.add(name, kind)
    return plain.mapInArrow(run, schema).toDF(*df.columns, *names.values()), names
