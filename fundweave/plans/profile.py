"""Quality profile of the raw tables: one row per metric.

Each raw table is read once. A row gives one entry for each grain that a metric is about: its marks
as bits of one number, its (key, version), each value it refers to, each element of its nested lists.
Entries are counted by grain and value in one grouped pass, within the tasks first, and the counts are
stored; every metric, and every check of a reference, is a sum over them. A frequent value is one row
by then.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions import text as T
from ..functions import variant as V
from ..operators.quality import union_all
from ..sources import workspace

# Metric id, then table, dimension and problem, as the published profile words them.
LABELS = {
    "A00": ("awards", "-", "Filas en Bronze"),
    "A01": ("awards", "Completitud", "Sin award_id"),
    "A02": ("awards", "Unicidad", "Copias exactas de (award_id, updated_date) por recarga"),
    "A03": ("awards", "Unicidad", "Awards con más de una versión (updated_date distinta)"),
    "A04": ("awards", "Completitud", "Sin description (no se puede vectorizar)"),
    "A05": ("awards", "Completitud", "Sin amount"),
    "A06": ("awards", "Validez", "amount <= 0"),
    "A07": ("awards", "Consistencia", "Monto en moneda distinta de USD"),
    "A08": ("awards", "Validez", "end_date anterior a start_date"),
    "A09": ("awards", "Completitud", "Sin start_date ni start_year"),
    "A10": ("awards", "Consistencia", "description con etiquetas HTML"),
    "A11": ("awards", "Completitud", "Sin funder identificado"),
    "A12": ("awards", "Consistencia", "funder_id que no existe en funders cargados"),
    "A13": ("awards", "Completitud", "Sin publicaciones enlazadas (funded_outputs = 0)"),
    "A14": ("awards", "Completitud", "Sin primary_topic (no se puede filtrar por dominio)"),
    "A15": ("awards", "Precisión", "Fecha de inicio solo con año (sin mes ni día)"),
    "A16": ("awards", "Precisión", "Monto en USD inverosímil (>= USD 1.000 M en un award)"),
    "W00": ("works", "-", "Filas en Bronze"),
    "W01": ("works", "Completitud", "Sin work_id"),
    "W02": ("works", "Unicidad", "Copias exactas de (work_id, updated_date) por recarga"),
    "W03": ("works", "Completitud", "Sin título"),
    "W04": ("works", "Completitud", "Sin abstract"),
    "W05": ("works", "Validez", "publication_year fuera de rango"),
    "W06": ("works", "Completitud", "Mención de award sin award_id"),
    "W07": ("works", "Completitud", "Autoría sin author_id"),
    "W08": ("works", "Unicidad", "Autor repetido dentro del mismo work"),
    "W09": ("works", "Consistencia", "Enlace a un award que no está cargado"),
    "W10": ("works", "Validez", "Publicaciones retractadas"),
    "W11": ("works", "Precisión", "Fecha de publicación el 1 de enero (en realidad, solo el año)"),
    "F01": ("funders", "Completitud", "Sin funder_id"),
    "F02": ("funders", "Unicidad", "funder_id repetido entre cargas"),
    "F03": ("funders", "Completitud", "Sin nombre"),
    "T01": ("topics", "Completitud", "Sin topic_id"),
    "T02": ("topics", "Unicidad", "topic_id repetido entre cargas"),
}
IMPLAUSIBLE_USD = 1_000_000_000


def _texts(raw: DataFrame, *names: str, nodes: dict[str, str] | None = None, **paths: str) -> DataFrame:
    return V.extract(raw, {**{n: n for n in names}, **paths}, nodes or {}, [])


Metrics = dict[str, tuple[Column, Column]]


def _report(df: DataFrame, **metrics: tuple[Column, Column]) -> DataFrame:
    """One aggregate over `df`; metric id -> (affected, total) become long rows."""
    one_row = df.agg(
        *[e.alias(f"{m}_{side}") for m, pair in metrics.items() for side, e in zip("at", pair)]
    )
    cells = [
        F.struct(
            F.lit(m).alias("metric_id"),
            *[F.lit(v).alias(n) for v, n in zip(LABELS[m], ("entidad", "dimension", "problema"))],
            F.coalesce(F.col(f"{m}_a"), F.lit(0)).cast("long").alias("n_afectados"),
            F.coalesce(F.col(f"{m}_t"), F.lit(0)).cast("long").alias("n_total"),
        )
        for m in metrics
    ]
    return one_row.select(F.inline(F.array(*cells)))


def _entry(grain: str, a: Column, b: Column | None = None) -> Column:
    """What a row adds to a grain: up to two texts that it is counted by."""
    second = F.lit(None).cast("string") if b is None else b.cast("string")
    return F.struct(F.lit(grain).alias("grain"), a.cast("string").alias("a"), second.alias("b"))


def _each(node: str, entry) -> Column:
    """An entry for each element of a nested list, none where there is no list."""
    none = F.array().cast("array<struct<grain:string,a:string,b:string>>")
    return F.coalesce(F.transform(V.elements(F.col(node)), entry), none)


class Grains:
    """Counts (grain, a, b, n) of one raw table, stored, and the metrics over its rows."""

    def __init__(self, rows: DataFrame, marks: Metrics, *entries: Column, lists: tuple[Column, ...] = ()):
        """`marks`: metric id -> (which rows it affects, out of which rows), as conditions. `entries` are
        one for each row, `lists` several. Every table has a grain `version` of (key, updated date)."""
        self.marks = marks
        conditions = [c for pair in marks.values() for c in pair]
        bits = [F.coalesce(c, F.lit(False)).cast("long") * F.lit(1 << i) for i, c in enumerate(conditions)]
        row = _entry("row", sum(bits[1:], bits[0]))
        found = F.concat(F.array(row, *entries), *lists)
        counted = (
            rows.select(F.explode(found).alias("e"))
            .groupBy("e.grain", "e.a", "e.b")
            .agg(_rows().alias("n"))
        )
        self.counts = workspace.cut(counted, "grains")

    def of(self, grain: str, a: str, b: str = "b") -> DataFrame:
        known = self.counts.filter(F.col("grain") == grain)
        return known.select(F.col("a").alias(a), F.col("b").alias(b), "n")

    def row_metrics(self) -> DataFrame:
        """Each mark is a bit of the number that rows are counted by."""
        number = F.col("marks").cast("long")
        bit = lambda i: F.sum(F.when(number.bitwiseAND(F.lit(1 << i)) != 0, F.col("n")))
        sides = {m: (bit(2 * i), bit(2 * i + 1)) for i, m in enumerate(self.marks)}
        return _report(self.of("row", "marks"), **sides)

    def versions(self) -> DataFrame:
        """Per key: rows, distinct versions with a missing one counted as '', distinct dated versions."""
        per_version = (
            self.of("version", "key", "date").filter(F.col("key").isNotNull())
            .groupBy("key", F.coalesce("date", F.lit("")).alias("v"))
            .agg(F.sum("n").alias("n"), F.max(F.col("date").isNotNull().cast("int")).alias("dated"))
        )
        return per_version.groupBy("key").agg(
            F.sum("n").alias("n"), _rows().alias("versions"), F.sum("dated").alias("dated")
        )

    def repeats(self, metric: str) -> DataFrame:
        per_id = self.versions()
        return _report(per_id, **{metric: (F.sum(F.col("n") - 1), F.sum("n"))})

    def keys(self) -> DataFrame:
        """Every key once, marked as known."""
        keys = self.of("version", "id").filter(F.col("id").isNotNull()).select("id").distinct()
        return keys.withColumn("known", F.lit(True))


def _every() -> Column:
    return F.lit(True)


def _rows() -> Column:
    return F.count(F.lit(1))


def _award_grains(raw: DataFrame) -> Grains:
    c = F.col
    rows = _texts(
        raw, "id", "updated_date", "description", "amount", "currency", "start_date", "end_date",
        "start_year", "funded_outputs_count", funder="funder.id", topic="primary_topic.id",
        nodes={"outputs": "funded_outputs"},
    ).select(
        T.short_id(c("id")).alias("id"),
        "updated_date",
        T.clean_text(c("description")).alias("description"),
        T.has_markup(c("description")).alias("markup"),
        R.safe_money(c("amount")).alias("amount"),
        T.upper_code(c("currency")).alias("currency"),
        R.safe_date(c("start_date")).alias("starts"),
        R.safe_date(c("end_date")).alias("ends"),
        c("start_year").alias("year_text"),
        R.start_from_year(R.safe_int(c("start_year"))).alias("year_start"),
        T.short_id(c("funder")).alias("funder_id"),
        T.short_id(c("topic")).alias("topic_id"),
        F.coalesce(R.safe_int(c("funded_outputs_count")), V.array_length(c("outputs")), F.lit(0)).alias("outputs"),
    )
    has_amount, positive = c("amount").isNotNull(), c("amount") > 0
    usd = c("currency") == "USD"
    no_date = c("starts").isNull()
    marks = {
        "A00": (_every(), _every()),
        "A01": (c("id").isNull(), _every()),
        "A04": (c("description").isNull(), _every()),
        "A05": (~has_amount, _every()),
        "A06": (c("amount") <= 0, has_amount),
        "A07": (positive & ~usd, positive),
        "A08": (c("ends") < c("starts"), c("ends").isNotNull() & ~no_date),
        "A09": (no_date & c("year_text").isNull(), _every()),
        "A10": (c("markup"), c("description").isNotNull()),
        "A11": (c("funder_id").isNull(), _every()),
        "A13": (c("outputs") == 0, _every()),
        "A14": (c("topic_id").isNull(), _every()),
        "A15": (no_date & c("year_start").isNotNull(), ~no_date | c("year_start").isNotNull()),
        "A16": (usd & (c("amount") >= IMPLAUSIBLE_USD), usd & positive),
    }
    return Grains(rows, marks, _entry("version", c("id"), c("updated_date")), _entry("funder", c("funder_id")))


def _work_grains(raw: DataFrame, as_of: Column) -> Grains:
    c = F.col
    rows = _texts(
        raw, "id", "updated_date", "title", "display_name", "publication_year", "publication_date",
        "is_retracted",
        nodes={"abstract": "abstract_inverted_index", "authorships": "authorships", "awards": "awards"},
    ).select(
        T.short_id(c("id")).alias("id"),
        "updated_date",
        F.coalesce(T.clean_text(c("title")), T.clean_text(c("display_name"))).alias("title"),
        (c("abstract").isNull() | F.is_variant_null("abstract")).alias("no_abstract"),
        R.safe_int(c("publication_year")).alias("year"),
        R.safe_date(c("publication_date")).alias("published"),
        F.coalesce(R.safe_bool(c("is_retracted")), F.lit(False)).alias("is_retracted"),
        "authorships",
        "awards",
    )
    new_year = (F.month("published") == 1) & (F.dayofmonth("published") == 1)
    marks = {
        "W00": (_every(), _every()),
        "W01": (c("id").isNull(), _every()),
        "W03": (c("title").isNull(), _every()),
        "W04": (c("no_abstract"), _every()),
        "W05": (~R.year_in_range(c("year"), as_of), c("year").isNotNull()),
        "W10": (c("is_retracted"), _every()),
        "W11": (new_year, c("published").isNotNull()),
    }
    mentions = _each("awards", lambda x: _entry("mention", T.short_id(V.text_at(x, "id"))))
    authors = _each("authorships", lambda x: _entry("author", c("id"), T.short_id(V.text_at(x, "author.id"))))
    return Grains(rows, marks, _entry("version", c("id"), c("updated_date")), lists=(mentions, authors))


def _catalog_grains(raw: DataFrame, marks: dict[str, str], *texts: str) -> Grains:
    """A catalog's rows by key; `marks`: metric id -> column that must be there."""
    rows = _texts(raw, "id", *texts).select(
        T.short_id(F.col("id")).alias("id"), *[T.clean_text(F.col(t)).alias(t) for t in texts]
    )
    missing = {m: (F.col(c).isNull(), _every()) for m, c in marks.items()}
    return Grains(rows, missing, _entry("version", F.col("id")))


def _looked_up(values: DataFrame, value: str, known: Grains) -> DataFrame:
    return values.join(known.keys(), F.col(value) == F.col("id"), "left")


def quality_profile(
    awards: DataFrame, works: DataFrame, funders: DataFrame, topics: DataFrame, as_of: Column | None = None
) -> DataFrame:
    today = F.current_date() if as_of is None else as_of
    c = F.col
    award, work = _award_grains(awards), _work_grains(works, today)
    funder = _catalog_grains(funders, {"F01": "id", "F03": "display_name"}, "display_name")
    topic = _catalog_grains(topics, {"T01": "id"})

    by_funder = award.of("funder", "funder_id").filter(c("funder_id").isNotNull())
    unknown = c("known").isNull()
    mentions = _looked_up(work.of("mention", "award_id"), "award_id", award)
    named = c("award_id").isNotNull()
    identified = c("author_id").isNotNull()
    repeated = c("n") - F.when(c("work_id").isNotNull(), 1).otherwise(0)
    parts = [
        *[grains.row_metrics() for grains in (award, work, funder, topic)],
        _report(
            award.versions(),
            A02=(F.sum(c("n") - c("versions")), F.sum("n")),
            A03=(F.count_if(c("dated") > 1), _rows()),
        ),
        _report(
            _looked_up(by_funder, "funder_id", funder), A12=(F.sum(F.when(unknown, c("n"))), F.sum("n"))
        ),
        _report(work.versions(), W02=(F.sum(c("n") - c("versions")), F.sum("n"))),
        _report(
            mentions,
            W06=(F.sum(F.when(~named, c("n"))), F.sum("n")),
            W09=(F.sum(F.when(named & unknown, c("n"))), F.sum(F.when(named, c("n")))),
        ),
        _report(
            work.of("author", "work_id", "author_id"),
            W07=(F.sum(F.when(~identified, c("n"))), F.sum("n")),
            W08=(F.sum(F.when(identified, repeated)), F.sum(F.when(identified, c("n")))),
        ),
        funder.repeats("F02"),
        topic.repeats("T02"),
    ]
    pct = R.percentage(F.col("n_afectados"), F.col("n_total")).alias("pct")
    return union_all(parts).select("*", pct).orderBy("metric_id")
