"""Language identification by compression.

For every language a raw-content zstandard dictionary is made of sampled texts. A text is cut into
blocks, every block is compressed with every dictionary, and the language with the smallest total
wins. Short blocks keep the dictionary, rather than the text's own repetitions, in charge; all
blocks of the whole text count. The margin is the saving of the best total against the second one;
a text whose margin is narrow is rejected.

Letters alone carry the language: texts and dictionaries are lower-cased, and everything that is neither
a letter nor a mark on one (Unicode categories L and M) becomes one blank.

Only the dictionaries are learnt from a bounded sample: `per_language` documents of a language with a
letter, by a hash of their id, one row per id. Each gives the letters of `SLICE` characters from its
middle, cut to an equal share of the `DICTIONARY` bytes, so all of them are in the dictionary.

Defined cases: null texts and texts without a letter are `und` with score 0 and rejected; with one
language learnt the margin is 0 and nothing but `und` is rejected; with none learnt everything is
`und`; equal totals go to the language that sorts first, with margin 0; an empty table gives an
empty result; rows with null ids or languages are not learnt from; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundweave.operators.ordering import top_k

from .common import class_sample, col, fresh, ship

PER_LANGUAGE = 400
SLICE = 600
DICTIONARY = 96 * 1024
BLOCK = 2048
LEVEL = 6
#: Share of the second-best total that the best one must save.
MARGIN = 0.02
UNKNOWN = "und"

_OTHER = regex.compile(r"[^\p{L}\p{M}]+")
_LETTER = regex.compile(r"\p{L}")


def letters(text: str | None) -> str:
    """The letters of a text with their marks; empty if there is no letter."""
    kept = _OTHER.sub(" ", (text or "").lower()).strip()
    return kept if kept.isascii() or _LETTER.search(kept) else ""


def learn(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_language: int = PER_LANGUAGE,
) -> dict[str, bytes]:
    """A dictionary's content for each language of `docs`. The driver gets `per_language` slices of a
    language at most: one row for each sampled id and language."""
    rows = docs.select(
        col(id_col).alias("doc_id"), col(lang_col).alias("lang"), col(text_col).alias("text")
    )
    some = rows.filter(F.col("text").rlike(r"\p{L}") & F.col("lang").isNotNull())
    picked = class_sample(some.select("doc_id", "lang").distinct(), "doc_id", "lang", per_language)
    ids = F.broadcast(picked.select(F.col("doc_id").alias("p_id"), F.col("lang").alias("p_lang")))
    middle = F.greatest(F.lit(1), (F.length("text") / 2 - SLICE / 2).cast("int"))
    taken = some.join(ids, (F.col("doc_id") == F.col("p_id")) & (F.col("lang") == F.col("p_lang"))).select(
        "lang", "doc_id", F.substr("text", middle, F.lit(SLICE)).alias("s")
    )
    one = top_k(taken, ["lang", "doc_id"], [F.xxhash64("s"), F.col("s")], 1)
    parts: dict[str, list[tuple[int, str]]] = {}
    for lang, h, s in one.select("lang", F.xxhash64("doc_id").alias("h"), "s").toLocalIterator():
        parts.setdefault(lang, []).append((h, letters(s)))
    share = max(1, DICTIONARY // per_language - 1)
    return {
        lang: b" ".join(s.encode()[:share].decode(errors="ignore").encode() for _, s in sorted(parts[lang]))
        for lang in sorted(parts)
    }


@lru_cache(maxsize=4)
def _compressors(model: tuple[tuple[str, bytes], ...]) -> list[tuple[str, Callable[[bytes], bytes]]]:
    out = []
    for lang, content in model:
        known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        known.precompute_compress(level=LEVEL)
        one = zstandard.ZstdCompressor(
            level=LEVEL,
            dict_data=known,
            write_checksum=False,
            write_content_size=False,
            write_dict_id=False,
        )
        out.append((lang, one.compress))
    return out


def classify(text: str | None, compressors) -> tuple[str, float, float]:
    """(language, score, margin). The score is best and second total set against each other, 0.5
    for a tie and 1 for a total of nothing."""
    data = letters(text).encode()
    if not data or not compressors:
        return UNKNOWN, 0.0, 0.0
    blocks = [data[i : i + BLOCK] for i in range(0, len(data), BLOCK)]
    sizes = [sum(len(c(b)) for b in blocks) for _, c in compressors]
    if len(sizes) == 1:
        return compressors[0][0], 1.0, 0.0
    best = min(range(len(sizes)), key=sizes.__getitem__)
    second = min(s for i, s in enumerate(sizes) if i != best)
    return compressors[best][0], second / (second + sizes[best]), 1 - sizes[best] / second


def identify(
    df: DataFrame, model: dict[str, bytes], text_col: str = "text", margin: float = MARGIN
) -> tuple[DataFrame, dict[str, str]]:
    """`df` with lang_pred, score (0 to 1), margin and rejected; and the names they got."""
    names = dict(
        zip(
            ("lang_pred", "score", "margin", "rejected"),
            fresh(df, "lang_pred", "score", "margin", "rejected"),
        )
    )
    ship(df.sparkSession)
    known = df.sparkSession.sparkContext.broadcast(tuple(model.items()))
    several = len(model) > 1
    place = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = _compressors(known.value)
        for rows in batches:
            found = [classify(t.as_py(), compressors) for t in rows.column(place)]
            langs, scores, margins = zip(*found) if found else ((), (), ())
            out = [f == UNKNOWN or (several and m < margin) for f, m in zip(langs, margins)]
            yield pa.RecordBatch.from_arrays(
                [
                    *rows.columns,
                    pa.array(langs, pa.string()),
                    pa.array(scores, pa.float64()),
                    pa.array(margins, pa.float64()),
                    pa.array(out, pa.bool_()),
                ],
                names=[*rows.schema.names, *names],
            )

    # Plain names inside: mapInArrow reads a dot in a name as a path.
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    schema = T.StructType(list(plain.schema.fields))
    for name, kind in zip(names, ("string", "double", "double", "boolean")):
        schema = schema.add(name, kind)
    return plain.mapInArrow(run, schema).toDF(*df.columns, *names.values()), names


def known_documents(docs: DataFrame, train: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of `docs` whose language is told clearly, with their columns; `train` is learnt
    from."""
    found, names = identify(docs, learn(train), text_col, **options)
    return found.filter(~col(names["rejected"])).select(*[col(c) for c in docs.columns])
