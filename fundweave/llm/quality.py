"""Quality rules: base counts of a text, and a hashed n-gram likelihood ratio with a threshold.

Two multinomials over hash buckets of word n-grams are counted: one over the trusted target, one
over the whole raw corpus. A document's score is the sum of log(target / raw) over its n-grams,
divided by their number, and it is kept if the score reaches the threshold. Log ratios are held as
whole thousandths, so a score does not depend on the order of additions and every document gets the
same verdict on every run.

Everything is a DataFrame expression. Words, n-grams and scores are arrays inside a row. The counts
cross a shuffle as one row per bucket and task. All trusted ids, whose number grows with the input,
are joined to the texts by sorting both, which spills where memory ends: texts are shuffled once, at every
size alike, and the ids, which have no bound, are never broadcast. The model is `BUCKETS` integers,
whatever the corpus; they enter the scoring plan as one array constant.

Defined cases: null and empty texts have no words, score 0 and fail the base rules; the raw counts
cover every row, repeated ones as often as they occur; with no trusted document every ratio is 0;
an empty table gives an empty result; columns that are not named stay as they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, col, fresh, whole, words

#: Hash buckets of the multinomials; a power of two.
BUCKETS = 1 << 15
#: Lengths of the n-grams.
ORDERS = (1, 2)
#: Mean log ratio (in thousandths of a nat per n-gram) from which a document is kept.
THRESHOLD = -100
#: Pseudo-count of every bucket in both multinomials.
PRIOR = 1.0
SYMBOLS = "[^#*$%&|<>]+"


#: Names of what `measure` adds, in order.
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def hashes(w: Column) -> Column:
    """One 64-bit hash per word; n-grams are hashed from these."""
    return F.transform(w, lambda x: F.xxhash64(x))


def ngrams(h: Column, order: int) -> Column:
    """Hashes of the n-grams of the word-hash array column `h`."""
    if order == 1:
        return h
    heads = F.slice(h, 1, F.greatest(F.size(h) - (order - 1), F.lit(0)))
    return F.transform(heads, lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, order)]))


def buckets(h: Column, orders: Sequence[int], size: int) -> Column:
    """Hash buckets of the n-grams, all orders one after the other."""
    grams = [ngrams(h, n) for n in orders]
    return F.transform(F.concat(*grams), lambda g: g.bitwiseAND(F.lit(size - 1)).cast("int"))


def measure(df: DataFrame, text_col: str = "text") -> tuple[DataFrame, dict[str, str], str]:
    """`df` with the base counts; the names they got; the name of the word-hash array.

    Repeated windows: hashes are sorted with their places, so that equal ones are neighbours, and
    the places covered are counted in order. A text without equal hashes skips the sort."""
    names = dict(zip(COUNTS, fresh(df, *COUNTS)))
    w, h, text, windows, placed, places = fresh(
        df, "_words", "_hashes", "_text", "_windows", "_placed", "_places"
    )
    lines = F.filter(F.split(col(text), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = df.withColumn(text, whole(col(text_col))).withColumns(
        {
            w: words(col(text)),
            names["n_symbols"]: F.length(F.regexp_replace(col(text), SYMBOLS, "")).cast("long"),
            names["n_dup_lines"]: (
                F.when(F.instr(col(text), "\n") == 0, F.lit(0)).otherwise(
                    F.size(lines) - F.size(F.array_distinct(lines))
                )
            ).cast("long"),
        }
    )
    n = F.size(col(w))
    df = df.withColumns(
        {
            names["n_words"]: n.cast("long"),
            names["word_chars"]: F.length(F.concat_ws("", col(w))).cast("long"),
            h: hashes(col(w)),
        }
    ).drop(text, w)
    df = df.withColumn(windows, ngrams(col(h), 3))
    again = F.size(F.array_distinct(col(windows))) < F.size(col(windows))
    pair = F.transform(col(windows), lambda h, i: F.struct(h.alias("h"), i.alias("p")))
    df = df.withColumn(placed, F.when(again, F.sort_array(pair))).drop(windows)
    equal = F.filter(
        col(placed),
        lambda x, i: F.coalesce(F.get(col(placed), i - 1)["h"] == x["h"], F.lit(False))
        | F.coalesce(F.get(col(placed), i + 1)["h"] == x["h"], F.lit(False)),
    )
    df = df.withColumn(places, F.sort_array(F.transform(equal, lambda x: x["p"]))).drop(placed)
    covered = F.aggregate(
        col(places),
        F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
        lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n")),
        lambda a: a["n"],
    )
    df = df.withColumn(names["n_repeat_words"], F.coalesce(covered, F.lit(0)).cast("long"))
    n, repeated = col(names["n_words"]), col(names["n_repeat_words"])
    df = df.drop(places).withColumn(names["base_failed"], (n < 50) | (100 * repeated > 50 * n))
    return df, names, h


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids of the trusted target: all documents labelled as good."""
    return labels.filter((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select("doc_id").distinct()


def fit(
    docs: DataFrame,
    trusted: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    orders: Sequence[int] = ORDERS,
    size: int = BUCKETS,
    prior: float = PRIOR,
) -> str:
    """Log ratios of all buckets in thousandths, comma separated. `trusted` (doc_id) may be of any
    size; the counts cover every row of `docs`, and of the target every row with a trusted id."""
    rows = docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text"))
    good = trusted.select(F.col("doc_id").alias("t_id")).distinct().hint("merge")
    # Words are hashed above the join: where it shuffles, texts are smaller than their hashes.
    flagged = rows.join(good, F.col("doc_id") == F.col("t_id"), "left").select(
        F.col("t_id").isNotNull().cast("long").alias("good"), hashes(words(F.col("text"))).alias("h")
    )
    counts = (
        flagged.select("good", F.explode(buckets(F.col("h"), orders, size)).alias("bucket"))
        .groupBy("bucket")
        .agg(F.count("*").alias("raw"), F.sum("good").alias("target"))
    )
    every = docs.sparkSession.range(size).select(F.col("id").cast("int").alias("b"))
    filled = every.join(counts, F.col("b") == F.col("bucket"), "left").select(
        "b",
        (F.coalesce("raw", F.lit(0)) + F.lit(prior)).alias("raw"),
        (F.coalesce("target", F.lit(0)) + F.lit(prior)).alias("target"),
    )
    table = filled.agg(
        F.sort_array(F.collect_list(F.struct("b", "raw", "target"))).alias("t"),
        F.sum("raw").alias("raw"),
        F.sum("target").alias("target"),
        F.sum(F.col("target") - F.lit(prior)).alias("seen"),
    ).withColumn("shift", F.log(F.col("raw") / F.col("target")))
    ratio = F.transform(
        "t",
        lambda x: F.when(F.col("seen") <= 0, F.lit(0))
        .otherwise(F.round(1000 * (F.log(x["target"] / x["raw"]) + F.col("shift"))))
        .cast("int"),
    )
    return table.select(F.array_join(ratio.cast("array<string>"), ",")).first()[0]


def rate(
    df: DataFrame,
    model: str,
    text_col: str = "text",
    orders: Sequence[int] = ORDERS,
    size: int = BUCKETS,
    threshold: int = THRESHOLD,
) -> tuple[DataFrame, dict[str, str]]:
    """`df` with the base counts, `score` (mean log ratio in thousandths, rounded down) and `kept`;
    and the names these columns got."""
    df, names, h = measure(df, text_col)
    grams, total = fresh(df, "_grams", "_total")
    names["score"], names["kept"] = fresh(df, "score", "kept")
    weights = F.split(F.lit(model), ",").cast("array<int>")
    df = df.withColumn(grams, F.concat(*[ngrams(col(h), n) for n in orders])).drop(h)
    summed = F.aggregate(
        col(grams),
        F.lit(0).cast("long"),
        lambda a, g: a + F.get(weights, g.bitwiseAND(F.lit(size - 1)).cast("int")),
    )
    count = F.greatest(F.size(col(grams)), F.lit(1))
    df = df.withColumn(total, F.floor(summed / count)).drop(grams)
    # Row numbers are not deterministic for the optimiser, so a later filter on the verdict stays above
    # these projections; pushed down, it would repeat every array expression many times over.
    held = F.monotonically_increasing_id() >= 0
    kept = ~col(names["base_failed"]) & (col(total) >= threshold) & held
    return df.withColumns({names["score"]: col(total), names["kept"]: kept}).drop(total), names


def rules(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options):
    """Fits the ratio on `df` and the labels, then rates every row of `df`."""
    return rate(df, fit(df, trusted_ids(labels), id_col, text_col), text_col, **options)


def good_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that the rules keep, with their columns."""
    rated, names = rules(docs, labels, id_col, text_col)
    return rated.filter(col(names["kept"])).select(*[col(c) for c in docs.columns])
