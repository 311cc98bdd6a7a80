"""Source divergence audit: how the sources of a language differ in the terms they use.

Terms are maximal runs of letters and of everything beyond ASCII, with A-Z lower-cased. Each language
keeps the terms found in at least `least` of its documents; every group (language, source) and every
language as a whole has a smoothed share p of each kept term, in whole billionths. A pair of sources
diverges by the sum of (p - q)^2 / q over all kept terms, rounded down term by term; a term stands out
in a source by the same figure against its language.

The vocabulary. Kept terms are range-partitioned and sorted, and every task turns its run of them into
minimal acyclic transducers (`transducer`) of at most `SHARD` terms of one language. Terms before a
transducer's first one are counted, so a term's ordinal is its place among all kept terms of its
language: ordinals stand for terms from there on, also where ties are broken.

Recounting. A second pass cuts the whole texts into terms again and counts them by group, some
megabytes of text at a time. Counts are packed and sent to the transducer of their range, in `LOTS`
lots, and stream through it: a task holds one transducer and one group's counts. Terms that are not
kept fall out there. What remains is one packed row for each group and transducer.

Pairs. Sources are compared in tiles of `TILE` sources, as dense matrices over the terms of one
transducer, absent terms with their smoothed share; a matrix gives back one sum a pair. The result of
all pairs has as many rows as there are pairs, but nothing else does.

What the driver and every task see whole is the directory of transducers: one row for each `SHARD`
kept terms, and one at least per language and range partition.

All arithmetic is on whole numbers; products that can outgrow 64 bits are Python's.

Defined cases: null texts, languages and sources are empty strings; texts without terms count their
group in; a language without kept terms has pairs of value 0 and no terms; a language with one source
has no pairs; ties are ordered by the UTF-8 bytes of the item; repeated rows are documents of their
own; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fundweave.sources.workspace import cut

from .common import col, ship, whole
from .transducer import Transducer

#: Terms of one transducer, lots that a transducer's counts are dealt in.
SHARD = 1 << 14
LOTS = 8
#: Terms and sources compared at a time.
BLOCK = 2048
TILE = 64
BILLION = 1_000_000_000

#: Bytes of text that are cut into terms at a time.
PIECE = 1 << 24

#: What each byte becomes: A-Z lower-cased, other letters and bytes beyond ASCII themselves, the rest blanks.
_LETTERS = np.asarray(
    [b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)], np.uint8
)


@dataclass
class Terms:
    """The terms of some documents: `document` and `code` for each occurrence, the terms by code."""

    document: np.ndarray
    code: np.ndarray
    terms: pa.Array


def terms(texts: pa.Array) -> Terms:
    """Cuts whole texts (of type string) into terms. Only ASCII bytes change, one for one, so the array
    stays valid UTF-8; Arrow splits it and tells the distinct terms."""
    texts = pa.concat_arrays([texts])  # own buffers, starting at the first text
    _, offsets, data = texts.buffers()
    plain = _LETTERS[np.frombuffer(data, np.uint8)] if data is not None else np.zeros(0, np.uint8)
    lists = pc.ascii_split_whitespace(
        pa.Array.from_buffers(texts.type, len(texts), [None, offsets, pa.py_buffer(plain)], offset=texts.offset)
    )
    coded = lists.flatten().cast(pa.binary()).dictionary_encode()
    document = np.repeat(np.arange(len(texts)), np.asarray(lists.value_lengths()))
    code = np.asarray(coded.indices).astype(np.int64)
    blank = pc.index(coded.dictionary, pa.scalar(b"", pa.binary())).as_py()  # before and after the others
    there = code != blank
    return Terms(document[there], code[there], coded.dictionary)


def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in slices of about `PIECE` bytes of text."""
    for rows in batches:
        size = np.cumsum(np.asarray(pc.binary_length(rows.column("text"))).astype(np.int64))
        at = 0
        while at < len(rows):
            done = size[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(size, done + PIECE, "right")))
            yield rows.slice(at, end - at)
            at = end


def counted(keys: np.ndarray, found: Terms, once: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, code, n) of the occurrences by the key of their document, or of a document's distinct terms."""
    width = max(1, len(found.terms))
    document, code = found.document, found.code
    if once:
        pairs = np.unique(document * width + code)
        document, code = pairs // width, pairs % width
    both, n = np.unique(keys[document] * width + code, return_counts=True)
    return both // width, both % width, n


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents by language and term."""
    for rows in pieces(batches):
        found = terms(rows.column("text"))
        langs = rows.column("lang").dictionary_encode()
        lang, code, n = counted(np.asarray(langs.indices).astype(np.int64), found, once=True)
        yield pa.RecordBatch.from_arrays(
            [langs.dictionary.take(pa.array(lang)), found.terms.take(pa.array(code)), pa.array(n)],
            names=["lang", "term", "n"],
        )


def _transducers(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Terms come sorted by language and term; a transducer takes `most` of them."""
    mine, held = None, []

    def shard() -> pa.RecordBatch:
        data = Transducer.build(held).to_bytes()
        row = {"lang": [mine], "low": [held[0]], "n": [len(held)], "data": [data]}
        types = {"low": pa.binary(), "n": pa.int64(), "data": pa.binary()}
        return pa.RecordBatch.from_pydict({c: pa.array(v, types.get(c, pa.string())) for c, v in row.items()})

    for rows in batches:
        for lang, term in zip(rows.column("lang").to_pylist(), rows.column("term").to_pylist()):
            if held and (lang != mine or len(held) == most):
                yield shard()
                held = []
            mine = lang
            held.append(term)
    if held:
        yield shard()


def vocabulary(rows: DataFrame, least: int) -> DataFrame:
    """The transducers of the terms in at least `least` documents of their language: lang, base (the
    terms of the language before them), low (the first term), n, data. A stored table."""
    found = rows.select("lang", "text").mapInArrow(_document_counts, "lang string, term binary, n bigint")
    kept = found.groupBy("lang", "term").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    sorted_ = kept.select("lang", "term").repartitionByRange("lang", "term").sortWithinPartitions("lang", "term")
    most = SHARD
    built = sorted_.mapInArrow(
        lambda batches: _transducers(batches, most), "lang string, low binary, n bigint, data binary"
    )
    shards = cut(built, "transducers")
    before = Window.partitionBy("lang").orderBy("low").rowsBetween(Window.unboundedPreceding, -1)
    base = F.coalesce(F.sum("n").over(before), F.lit(0))
    places = shards.select("lang", "low", base.alias("base"))
    same = (F.col("lang") == F.col("p_lang")) & (F.col("low") == F.col("p_low"))
    named = places.toDF("p_lang", "p_low", "base")
    return cut(shards.join(named, same).select("lang", "base", "low", "n", "data"), "vocabulary")


#: Rows of counts: `places` in the transducer (32 bits each) and how often they occur (64 bits each).
COUNTS = "lang string, source string, base bigint, places binary, n binary, total bigint"


def packed(lang: str, source: str, base: int, dense: np.ndarray) -> dict:
    places = np.flatnonzero(dense)
    n = dense[places]
    return {
        "lang": lang, "source": source, "base": base, "places": places.astype("<i4").tobytes(),
        "n": n.astype("<i8").tobytes(), "total": int(n.sum()),
    }


def unpacked(places: bytes | None, n: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(places or b"", "<i4"), np.frombuffer(n or b"", "<i8")


def rows_of(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    for rows in batches:
        yield from zip(*[rows.column(c).to_pylist() for c in names])


def _routed(batches: Iterator[pa.RecordBatch], known: dict[str, tuple[list[bytes], list[int]]]):
    """Occurrences by group, packed for each transducer that is to be asked: the terms, which hold no
    blanks, joined by blanks, and their numbers."""
    lot = TaskContext.get().partitionId() % LOTS
    for rows in pieces(batches):
        found = terms(rows.column("text"))
        langs, sources = (rows.column(c).to_pylist() for c in ("lang", "source"))
        groups = {g: i for i, g in enumerate(dict.fromkeys(zip(langs, sources)))}
        names = list(groups)
        number = np.fromiter((groups[g] for g in zip(langs, sources)), np.int64, len(langs))
        group, code, n = counted(number, found)
        # Places of the terms in order, and where each transducer's range begins among them.
        order = np.asarray(pc.sort_indices(found.terms))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        by_code = found.terms.to_pylist()
        ordered = [by_code[i] for i in order.tolist()]
        base = np.full(len(code), -1, np.int64)
        for lang in {lang for lang, _ in names} & known.keys():
            lows, bases = known[lang]
            begins = [bisect.bisect_left(ordered, low) for low in lows]
            mine = np.isin(group, [g for g, (x, _) in enumerate(names) if x == lang])
            at = np.searchsorted(begins, place[code[mine]], "right") - 1
            base[mine] = np.where(at >= 0, np.asarray(bases)[at], -1)
        kept = np.flatnonzero(base >= 0)
        kept = kept[np.lexsort((base[kept], group[kept]))]
        group, base, code, n = group[kept], base[kept], code[kept].tolist(), n[kept].astype("<i8")
        ends = [*(np.flatnonzero((np.diff(group) != 0) | (np.diff(base) != 0)) + 1).tolist(), len(code)]
        out, at = [], 0
        for end in ends if len(code) else []:
            lang, source = names[group[at]]
            data = b" ".join([by_code[c] for c in code[at:end]])
            out.append((lang, int(base[at]), lot, source, data, n[at:end].tobytes()))
            at = end
        if out:
            kinds = (pa.string(), pa.int64(), pa.int32(), pa.string(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                names=["lang", "base", "lot", "source", "data", "n"],
            )


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A transducer (a row without a source) is followed by the terms of its range and lot, source by
    source."""
    machine, dense, mine = None, None, None
    types = pa.schema(
        [("lang", pa.string()), ("source", pa.string()), ("base", pa.int64()), ("places", pa.binary()),
         ("n", pa.binary()), ("total", pa.int64())]
    )
    for lang, base, source, data, n in rows_of(batches, "lang", "base", "source", "data", "n"):
        if mine is not None and mine != (lang, source, base):
            yield pa.RecordBatch.from_pylist([packed(mine[0], mine[1], mine[2], dense)], types)
            mine = None
        if source is None:
            machine = Transducer.from_bytes(data)
            continue
        if mine is None:
            mine, dense = (lang, source, base), np.zeros(machine.size, np.int64)
        place = machine.ordinals(data.split(b" "))
        # A term is in a row once, so no place comes twice.
        dense[place[place >= 0]] += np.frombuffer(n, "<i8")[place >= 0]
    if mine is not None:
        yield pa.RecordBatch.from_pylist([packed(mine[0], mine[1], mine[2], dense)], types)


def _merged(rows: pa.Table) -> pa.Table:
    """The counts of one group in one transducer, over all lots."""
    lang, source, base = (rows.column(c)[0].as_py() for c in ("lang", "source", "base"))
    parts = [unpacked(p, n) for p, n in rows_of(rows.to_batches(), "places", "n")]
    dense = np.zeros(1 + max((int(p[-1]) for p, _ in parts if len(p)), default=0), np.int64)
    for p, n in parts:
        dense[p] += n
    return pa.Table.from_pylist([packed(lang, source, base, dense)], rows.schema)


def recount(rows: DataFrame, shards: DataFrame) -> DataFrame:
    """`COUNTS` of the kept terms, one row for each group and transducer."""
    directory: dict[str, tuple[list[bytes], list[int]]] = {}
    for r in shards.select("lang", "low", "base").orderBy("lang", "base").toLocalIterator():
        lows, bases = directory.setdefault(r.lang, ([], []))
        lows.append(bytes(r.low))
        bases.append(r.base)
    known = rows.sparkSession.sparkContext.broadcast(directory)
    texts = rows.select("lang", "source", "text").mapInArrow(
        lambda batches: _routed(batches, known.value),
        "lang string, base bigint, lot int, source string, data binary, n binary",
    )
    lots = F.explode(F.sequence(F.lit(0), F.lit(LOTS - 1))).alias("lot")
    nothing = [F.lit(None).cast(k).alias(c) for c, k in (("source", "string"), ("n", "binary"))]
    machines = shards.select("lang", "base", lots, "data", *nothing)
    met = texts.unionByName(machines).repartition("lang", "base", "lot")
    met = met.sortWithinPartitions("lang", "base", "lot", F.asc_nulls_first("source"))
    return met.mapInArrow(_streamed, COUNTS).groupBy("lang", "source", "base").applyInArrow(_merged, COUNTS)


def shares(n: np.ndarray, total: int, size: int) -> np.ndarray:
    """1 + floor(10^9 (n + 1) / (total + size)), exact also where the product outgrows 64 bits."""
    if len(n) and int(n.max()) >= 9 * BILLION:
        n = n.astype(object)
    return (1 + (n + 1) * BILLION // (total + size)).astype(np.int64)


def gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / q); shares are at most a billion, so squares fit 64 bits."""
    return (p - q) ** 2 // q


def _whole(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences in a language of each term of one transducer."""
    dense = np.zeros(SHARD, np.int64)
    for places, n in rows_of(batches, "places", "n"):
        p, n = unpacked(places, n)
        if len(p) and p[-1] >= len(dense):
            dense = np.pad(dense, (0, int(p[-1]) + 1 - len(dense)))
        dense[p] += n
    row = packed(key[0].as_py(), "", key[1].as_py(), dense)
    yield pa.RecordBatch.from_pydict(
        {"lang": [row["lang"]], "base": [row["base"]], "places": pa.array([row["places"]], pa.binary()),
         "n": pa.array([row["n"]], pa.binary())}
    )


def _ahead(top: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The language's counts in a transducer (a row without a source) are followed by the groups'.
        Gives the best terms of each group among these; the best of all are among them."""
        names = ("lang", "base", "source", "places", "n", "total", "size", "lang_total")
        whole_ = np.zeros(0, np.int64)
        for lang, base, source, places, n, total, size, lang_total in rows_of(batches, *names):
            at, n = unpacked(places, n)
            if source is None:
                whole_ = np.zeros(int(at[-1]) + 1, np.int64)
                whole_[at] = n
                continue
            p, q = shares(n, total, size), shares(whole_[at], lang_total, size)
            at, value = at[p > q], gap(p, q)[p > q]
            best = np.lexsort((at, -value))[:top]
            yield pa.RecordBatch.from_pydict(
                {"lang": pa.array([lang], pa.string()), "source": pa.array([source], pa.string()),
                 "base": pa.array([base], pa.int64()), "places": pa.array([at[best].astype("<i4").tobytes()], pa.binary()),
                 "n": pa.array([value[best].astype("<i8").tobytes()], pa.binary())}
            )

    return run


def _best(top: int):
    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The best terms of a group from the best of each transducer."""
        base, place, value = (np.zeros(0, np.int64) for _ in range(3))
        for b, places, values in rows_of(batches, "base", "places", "n"):
            p, v = unpacked(places, values)
            base, place = np.append(base, np.full(len(p), b)), np.append(place, p)
            value = np.append(value, v)
            best = np.lexsort((place, base, -value))[:top]
            base, place, value = base[best], place[best], value[best]
        yield pa.RecordBatch.from_pydict(
            {"lang": pa.array([key[0].as_py()] * len(base), pa.string()),
             "source": pa.array([key[1].as_py()] * len(base), pa.string()), "base": pa.array(base),
             "place": pa.array(place.astype(np.int32)), "value": pa.array(value),
             "rank": pa.array(np.arange(1, len(base) + 1, dtype=np.int32))}
        )

    return run


def _tile(key: tuple, rows: pa.Table) -> pa.Table:
    """Sums over the terms of one transducer for all pairs of sources of two tiles."""
    lang, low, high = (key[i].as_py() for i in (0, 2, 3))
    size, width = rows.column("size")[0].as_py(), rows.column("width")[0].as_py()
    tile = rows.column("tile").to_numpy()
    p = np.empty((len(rows), width), np.int64)
    for row, (places, n, total) in zip(p, rows_of(rows.to_batches(), "places", "n", "total")):
        dense = np.zeros(width, np.int64)
        at, n = unpacked(places, n)
        dense[at] = n
        row[:] = shares(dense, total, size) if width else 0
    names = rows.column("source").to_pylist()
    first, items, values = [], [], []

    def against(one: np.ndarray, other: np.ndarray) -> None:
        for a in one.tolist():
            b = other[other != a]
            found = np.zeros(len(b), np.int64)
            for at in range(0, width, BLOCK):
                found += gap(p[a, at : at + BLOCK][None, :], p[b, at : at + BLOCK]).sum(axis=1)
            first.extend([names[a]] * len(b))
            items.extend(names[i] for i in b.tolist())
            values.extend(found.tolist())

    one, other = np.flatnonzero(tile == low), np.flatnonzero(tile == high)
    against(one, other)
    if low != high:
        against(other, one)
    return pa.table(
        {
            "lang": pa.array([lang] * len(first), pa.string()),
            "source": pa.array(first, pa.string()),
            "item": pa.array(items, pa.string()),
            "value": pa.array(values, pa.int64()),
        }
    )


def _words(machines: pa.Table, places: pa.Table) -> pa.Table:
    """Terms by their places in one transducer."""
    machine = Transducer.from_bytes(machines.column("data")[0].as_py())
    at = places.column("place").to_pylist()
    return pa.table(
        {
            "lang": places.column("lang"),
            "base": places.column("base"),
            "place": places.column("place"),
            "item": pa.array([machine.word(i).decode() for i in at], pa.string()),
        }
    )


def audit(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    least: int = 3,
    top: int = 200,
) -> DataFrame:
    """lang, source, part, item, value, rank. Part `pair`: every other source of the language by its
    divergence; part `term`: the `top` kept terms that the source has more of than its language."""
    ship(docs.sparkSession)
    plain = lambda c: whole(col(c).cast("string"))
    rows = docs.select(
        plain(lang_col).alias("lang"),
        plain(source_col).alias("source"),
        whole(col(text_col)).alias("text"),
    )
    shards = vocabulary(rows, least)
    counts = cut(recount(rows, shards), "counts")
    groups = cut(_groups(rows, shards, counts), "groups")
    return _pairs(groups, shards, counts).unionByName(_terms(groups, shards, counts, top))


def _groups(rows: DataFrame, shards: DataFrame, counts: DataFrame) -> DataFrame:
    """One row for each (lang, source): total occurrences of kept terms, the language's number of kept
    terms and their occurrences, the source's place and the number of sources."""
    sizes = shards.groupBy(F.col("lang").alias("s_lang")).agg(F.sum("n").alias("size"))
    sums = counts.groupBy(F.col("lang").alias("c_lang"), F.col("source").alias("c_source")).agg(F.sum("total").alias("total"))
    there = rows.select("lang", "source").distinct()
    groups = there.join(
        sums, (F.col("lang") == F.col("c_lang")) & (F.col("source") == F.col("c_source")), "left"
    ).join(sizes, F.col("lang") == F.col("s_lang"), "left")
    none = F.lit(0).cast("bigint")
    groups = groups.select("lang", "source", *[F.coalesce(c, none).alias(c) for c in ("total", "size")])
    by_lang = Window.partitionBy("lang")
    return groups.select(
        "*",
        F.sum("total").over(by_lang).alias("lang_total"),
        (F.row_number().over(by_lang.orderBy("source")) - 1).alias("no"),
        F.count("*").over(by_lang).alias("sources"),
    )


def _terms(groups: DataFrame, shards: DataFrame, counts: DataFrame, top: int) -> DataFrame:
    of = groups.select(
        F.col("lang").alias("g_lang"), F.col("source").alias("g_source"), F.col("total").alias("g_total"),
        "size", "lang_total",
    )
    mine = counts.join(of, (F.col("lang") == F.col("g_lang")) & (F.col("source") == F.col("g_source"))).select(
        "lang", "base", "source", "places", "n", F.col("g_total").alias("total"), "size", "lang_total"
    )
    whole_ = counts.select("lang", "base", "places", "n").groupBy("lang", "base").applyInArrow(
        _whole, "lang string, base bigint, places binary, n binary"
    )
    met = mine.unionByName(whole_, allowMissingColumns=True).repartition("lang", "base")
    met = met.sortWithinPartitions("lang", "base", F.asc_nulls_first("source"))
    ahead = met.mapInArrow(_ahead(top), "lang string, source string, base bigint, places binary, n binary")
    best = ahead.groupBy("lang", "source").applyInArrow(
        _best(top), "lang string, source string, base bigint, place int, value bigint, rank int"
    )
    best = cut(best, "best")
    places = best.select("lang", "base", "place").distinct().groupBy("lang", "base")
    named = shards.select("lang", "base", "data").groupBy("lang", "base").cogroup(places)
    words = named.applyInArrow(_words, "lang string, base bigint, place int, item string")
    return best.join(words, ["lang", "base", "place"]).select(
        "lang", "source", F.lit("term").alias("part"), "item", "value", "rank"
    )


def _pairs(groups: DataFrame, shards: DataFrame, counts: DataFrame) -> DataFrame:
    # A language without kept terms has one transducer without terms, which gives its pairs their zero.
    ranges = shards.select(F.col("lang").alias("b_lang"), F.col("base").alias("b_base"), F.col("n").alias("width"))
    none = F.lit(0).cast("bigint")
    grid = groups.filter("sources > 1").join(ranges, F.col("lang") == F.col("b_lang"), "left").select(
        "lang", "source", "no", "sources", "total", "size",
        F.coalesce("b_base", none).alias("base"), F.coalesce("width", none).alias("width"),
    )
    cells = counts.select(*[F.col(c).alias(f"x_{c}") for c in ("lang", "source", "base")], "places", "n")
    same = F.lit(True)
    for c in ("lang", "source", "base"):
        same = same & (F.col(c) == F.col(f"x_{c}"))
    mine = F.floor(F.col("no") / TILE)
    others = F.explode(F.sequence(none, F.floor((F.col("sources") - 1) / TILE))).alias("other")
    tiled = grid.join(cells, same, "left").select("*", mine.alias("mine"), others).select(
        "lang", "base", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"),
        "source", F.col("mine").alias("tile"), "total", "size", "width", "places", "n",
    )
    parts = tiled.groupBy("lang", "base", "low", "high").applyInArrow(
        _tile, "lang string, source string, item string, value bigint"
    )
    totals = parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return totals.select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(by_value).alias("rank")
    )
