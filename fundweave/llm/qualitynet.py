"""Quality classifier: a convolutional network over the bytes of a text, trained in numpy.

A byte has an embedding; learned filters slide over every byte of the whole document and respond to
`WIDTH` bytes at a time. The document is cut into segments of `SEGMENT` bytes, and two neighbours make a
chunk, so chunks overlap by half and together cover everything. A chunk keeps each filter's largest
response (through a ReLU); the document keeps the largest and the mean of its chunks' values, and a
logistic layer makes one probability of them.

Scoring never multiplies embeddings and filters: their product is one table per place in a filter,
256 rows long, and a response is the sum of `WIDTH` looked-up rows. It runs on every row and whole
text, in Arrow batches, without a shuffle; a long text is worked through in pieces of `PIECE` bytes,
so memory does not depend on its length.

Training takes a bounded, documented sample: `PER_CLASS` labelled documents of each class by a hash of
their id, one row per id, none longer than `LONGEST` characters. The driver holds the sample and the
model, whose sizes do not depend on the corpus.

Defined cases: null and empty texts are scored as texts of one padding byte; with labels of one class
only (or none) every score is that class (or 0); documents with several labels are as good as the best;
rows with null ids are not learnt from; an empty table gives an empty result; other columns pass
through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundweave.operators.ordering import top_k
from fundweave.sources.workspace import cut

from .common import class_sample, col, fresh, ship

PER_CLASS = 1500
LONGEST = 20_000
EMBEDDING = 8
FILTERS = 24
WIDTH = 7
SEGMENT = 256
#: Bytes whose responses are laid out at a time: whole segments.
PIECE = 64 * SEGMENT
#: Documents seen in training, in epochs over the sample.
SEEN = 16_000
BATCH = 16
RATE = 0.01
SEED = 11


@dataclass
class Model:
    bytes_: np.ndarray  # (256, EMBEDDING)
    filters: np.ndarray  # (WIDTH, EMBEDDING, FILTERS)
    shift: np.ndarray  # (FILTERS,)
    out: np.ndarray  # (2 * FILTERS,): largest and mean
    bias: np.ndarray  # (1,)
    #: Set where there was nothing to tell apart: every score is this.
    constant: float | None = None

    def values(self) -> list[np.ndarray]:
        return [self.bytes_, self.filters, self.shift, self.out, self.bias]


def blank(seed: int = SEED) -> Model:
    r = np.random.default_rng(seed)
    draw = lambda scale, *shape: (r.standard_normal(shape) * scale).astype(np.float32)
    return Model(
        draw(0.5, 256, EMBEDDING),
        draw(1 / np.sqrt(WIDTH * EMBEDDING), WIDTH, EMBEDDING, FILTERS),
        np.zeros(FILTERS, np.float32),
        draw(0.1, 2 * FILTERS),
        np.zeros(1, np.float32),
    )


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def tables(m: Model) -> np.ndarray:
    """(WIDTH, 256, FILTERS): what a byte adds to the response of a filter at each of its places."""
    return np.einsum("be,wef->wbf", m.bytes_, m.filters).astype(np.float32)


def responses(tabs: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    """Responses at the first n places of `data`, which is WIDTH - 1 bytes longer at least."""
    z = tabs[0].take(data[:n], axis=0)
    for j in range(1, WIDTH):
        z += tabs[j].take(data[j : j + n], axis=0)
    return z


def layout(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Documents one after the other, each with one byte at least and WIDTH - 1 bytes of padding
    behind it: bytes, places that are padding, starts of segments, first segment of each document."""
    pad = b"\0" * (WIDTH - 1)
    data = np.frombuffer(b"".join([(t or b"\0") + pad for t in texts]), np.uint8)
    length = np.maximum(np.fromiter(map(len, texts), np.int64, len(texts)), 1)
    begin = np.cumsum(length + WIDTH - 1) - (length + WIDTH - 1)
    padding = ((begin + length)[:, None] + np.arange(WIDTH - 1)).ravel()
    count = -(-length // SEGMENT)
    first = np.cumsum(count) - count
    within = np.arange(count.sum()) - np.repeat(first, count)
    return data, padding, np.repeat(begin, count) + within * SEGMENT, first


def chunks(segments: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two neighbouring segments make a chunk; a document of one segment is one chunk. Gives the
    chunks' left and right segments and each document's first chunk."""
    count = np.diff(np.append(first, len(segments)))
    many = np.maximum(count - 1, 1)
    start = np.cumsum(many) - many
    left = np.repeat(first, many) + np.arange(many.sum()) - np.repeat(start, many)
    return left, np.where(np.repeat(count, many) > 1, left + 1, left), start


def pooled(segments: np.ndarray, first: np.ndarray, shift: np.ndarray) -> np.ndarray:
    """(document, 2 * FILTERS) from the largest responses of segments."""
    left, right, start = chunks(segments, first)
    value = np.maximum(np.maximum(segments[left], segments[right]) + shift, 0)
    count = np.diff(np.append(start, len(left)))[:, None]
    return np.concatenate(
        [np.maximum.reduceat(value, start, axis=0), np.add.reduceat(value, start, axis=0) / count], axis=1
    )


class Trainer:
    """Adam on the logistic loss. Max pooling leaves one place per filter and chunk a gradient."""

    def __init__(self, m: Model) -> None:
        self.m, self.step_ = m, 0
        self.first = [np.zeros_like(v) for v in m.values()]
        self.second = [np.zeros_like(v) for v in m.values()]

    def move(self, grads: list[np.ndarray], rate: float) -> None:
        self.step_ += 1
        for value, g, a, b in zip(self.m.values(), grads, self.first, self.second):
            a += 0.1 * (g - a)
            b += 0.001 * (g * g - b)
            up = a / (1 - 0.9**self.step_)
            value -= rate * up / (np.sqrt(b / (1 - 0.999**self.step_)) + 1e-8)

    def gradients(self, texts: list[bytes], y: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
        m = self.m
        data, padding, starts, first = layout(texts)
        n = len(data) - WIDTH + 1
        z = responses(tables(m), data, n)
        z[padding[padding < n]] = -np.inf
        ends = np.append(starts[1:], n)
        where = np.stack([z[a:b].argmax(axis=0) + a for a, b in zip(starts, ends)])
        best = np.take_along_axis(z, where, axis=0)
        left, right, start = chunks(best, first)
        place = np.where(best[left] >= best[right], where[left], where[right])
        raw = np.maximum(best[left], best[right]) + m.shift
        value = np.maximum(raw, 0)
        count = np.diff(np.append(start, len(left)))
        top = np.maximum.reduceat(value, start, axis=0)
        mean = np.add.reduceat(value, start, axis=0) / count[:, None]
        x = np.concatenate([top, mean], axis=1)
        d = (sigmoid(x @ m.out + m.bias) - y) * weight / len(y)
        of = np.repeat(np.arange(len(texts)), count)
        hit = value == top[of]
        # A largest value reached in several chunks shares its gradient.
        hit = hit / np.add.reduceat(hit, start, axis=0, dtype=np.float32)[of]
        g = d[of, None] * (hit * m.out[:FILTERS] + m.out[FILTERS:] / count[of, None]) * (raw > 0)
        g = g.astype(np.float32)
        seen = data[place[..., None] + np.arange(WIDTH)]  # (chunk, filter, WIDTH)
        vectors = m.bytes_[seen]
        g_filters = np.einsum("cfwe,cf->wef", vectors, g)
        g_bytes = np.zeros_like(m.bytes_)
        flow = g[:, :, None, None] * m.filters.transpose(2, 0, 1)[None]
        np.add.at(g_bytes, seen.ravel(), flow.reshape(-1, EMBEDDING))
        return [g_bytes, g_filters, g.sum(axis=0), x.T @ d, np.asarray([d.sum()], np.float32)]


def train(texts: list[str | None], labels: list[int], seed: int = SEED, seen: int = SEEN) -> Model:
    """Both classes weigh the same."""
    y = np.asarray(labels, np.float32)
    m = blank(seed)
    if not len(y) or y.min() == y.max():
        m.constant = float(y[0]) if len(y) else 0.0
        return m
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean())).astype(np.float32)
    data = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    r, trainer, epochs = np.random.default_rng(seed), Trainer(m), -(-seen // len(y))
    for epoch in range(epochs):
        rate = RATE * (1 - epoch / epochs)
        order = r.permutation(len(y))
        for i in range(0, len(order), BATCH):
            some = order[i : i + BATCH]
            trainer.move(trainer.gradients([data[k] for k in some], y[some], weight[some]), rate)
    return m


class Scorer:
    def __init__(self, m: Model) -> None:
        self.model, self.tables = m, tables(m)

    def segments(self, data: np.ndarray, padding: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Largest responses of all segments, some at a time. A segment ends where the next one
        starts; padding counts for nothing."""
        n = len(data) - WIDTH + 1
        out, i = np.empty((len(starts), FILTERS), np.float32), 0
        while i < len(starts):
            j = max(i + 1, int(np.searchsorted(starts, starts[i] + PIECE)))
            a, b = starts[i], starts[j] if j < len(starts) else n
            z = responses(self.tables, data[a : b + WIDTH - 1], b - a)
            lo, hi = np.searchsorted(padding, [a, b])
            z[padding[lo:hi] - a] = -np.inf
            out[i:j] = np.maximum.reduceat(z, starts[i:j] - a, axis=0)
            i = j
        return out

    def score(self, texts: list[bytes | None]) -> np.ndarray:
        if self.model.constant is not None:
            return np.full(len(texts), self.model.constant)
        out, group, size = [], [], 0
        for i, t in enumerate(texts):
            group.append(t or b"")
            size += len(group[-1])
            if size > 64 * PIECE or i == len(texts) - 1:
                data, padding, starts, first = layout(group)
                x = pooled(self.segments(data, padding, starts), first, self.model.shift)
                out.append(sigmoid(x @ self.model.out + self.model.bias))
                group, size = [], 0
        return np.concatenate(out) if out else np.zeros(0)


def sample(
    docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, text, quality) of `per_class` rows of each class at most: one row for an id."""
    known = labels.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    picked = class_sample(known, "doc_id", "quality", 3 * per_class)
    ids = F.broadcast(picked.select(F.col("doc_id").alias("p_id"), "quality"))
    rows = docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text"))
    short = rows.filter(F.coalesce(F.length("text"), F.lit(0)) <= LONGEST)
    found = short.join(ids, F.col("doc_id") == F.col("p_id")).select("doc_id", "text", "quality")
    one = cut(top_k(found, ["doc_id"], [F.xxhash64("text"), F.col("text")], 1), "sample")
    both = class_sample(one, "doc_id", "quality", per_class).select(F.col("doc_id").alias("c_id"))
    return one.join(F.broadcast(both), F.col("doc_id") == F.col("c_id"), "left_semi")


def learn(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    per_class: int = PER_CLASS,
) -> Model:
    """Trains on labelled rows of `docs`; `labels` has doc_id and quality."""
    rows = sample(docs, labels, per_class, id_col, text_col).collect()
    rows.sort(key=lambda r: (str(r.doc_id), r.text or ""))
    return train([r.text for r in rows], [r.quality for r in rows])


def score(df: DataFrame, m: Model, text_col: str = "text") -> tuple[DataFrame, dict[str, str]]:
    """`df` with score (0 to 1) and predicted (score of 0.5 or more); and the names they got."""
    ship(df.sparkSession)
    kinds = {"score": "double", "predicted": "integer"}
    names = dict(zip(kinds, fresh(df, *kinds)))
    shared = df.sparkSession.sparkContext.broadcast(m)
    place = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for rows in batches:
            s = scorer.score(rows.column(place).cast(pa.binary()).to_pylist()).astype(float)
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array(s), pa.array((s >= 0.5).astype(np.int32))], names=schema.names
            )

    # Plain names inside: mapInArrow reads a dot in a name as a path.
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    schema = T.StructType(list(plain.schema.fields))
    for name, kind in kinds.items():
        schema = schema.add(name, kind)
    return plain.mapInArrow(run, schema).toDF(*df.columns, *names.values()), names
