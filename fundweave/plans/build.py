"""The whole flow, run after run: raw files -> cleaned tables -> star -> wide table.

For every table it is noted how far it has read each of its sources, after an update is whole; so a
run that stopped halfway is built again by the next one, and a run without new files changes nothing.
How far a table itself reaches is noted with it, so no mark is looked for in the data: a raw table
reaches its last load, another one as far as the sources it was built from. Beyond a plain
"newer than the mark" filter three cases are looked after, so that loading in steps ends in the
same tables as loading everything at once: a publication whose new version lost all its children,
a link whose award arrives later, and a row whose unknown member becomes known.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import incremental as I
from ..operators import quality as K
from ..operators.lookup import UNKNOWN
from ..sources.tables import KeyedTable, SnapshotStore, append_by_name
from ..streaming import raw_load
from . import gold, reports, silver, suite

MARKS_SCHEMA = "target string, source string, mark timestamp"
#: Source under which it is noted how far a table itself reaches.
ITSELF = ""
RAW_TABLES = ("awards", "works", "funders", "topics")


class Warehouse:
    def __init__(self, spark: SparkSession, root: str, buckets: int = 64, strict_reference: bool = False):
        """`strict_reference` keeps the children of a publication whose new version has none."""
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets
        self.strict = strict_reference
        self._reached: dict[str, dict[str, object]] = {}
        self.store = SnapshotStore(spark, f"{self.root}/snapshots")

    # -- storage
    def raw(self, name: str) -> DataFrame:
        return raw_load.read_raw(self.spark, f"{self.root}/raw/{name}")

    def keyed(self, name: str, key: str) -> KeyedTable:
        return KeyedTable(self.spark, f"{self.root}/keyed/{name}", key, self.buckets)

    KEYS = {
        "slv_awards": "award_id", "slv_works": "work_id", "slv_work_authorships": "work_id",
        "slv_work_awards": "work_id", "dim_institution": "institution_key", "dim_award": "award_key",
        "dim_work": "work_key", "dim_author": "author_key", "brg_work_author": "work_key",
        "fact_awards": "award_key", "fact_award_works": "work_key",
        "slv_awards_history": "award_id", "slv_works_history": "work_id",
    }
    SNAPSHOTS = ("slv_funders", "slv_topics", "dim_date", "dim_funder", "dim_topic")

    def table(self, name: str) -> DataFrame:
        if name in self.SNAPSHOTS:
            return self.store.read(name)
        return self.keyed(name, self.KEYS[name]).read()

    def _stored(self, name: str) -> KeyedTable:
        return self.keyed(name, self.KEYS[name])

    # -- marks: how far each target has read each of its sources
    def _marks(self) -> DataFrame | None:
        path = f"{self.root}/marks"
        jvm = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        if not jvm.getFileSystem(conf).exists(jvm):
            return None
        return self.spark.read.schema(MARKS_SCHEMA).parquet(path)

    def _mark(self, target: str, source: str):
        marks = self._marks()
        if marks is None:
            return I.EPOCH_MARK
        return I.high_water(marks.filter((F.col("target") == target) & (F.col("source") == source)), "mark")

    def _note(self, target: str, reached: Mapping[str, object]) -> None:
        rows = [(target, name, mark) for name, mark in reached.items()]
        append_by_name(self.spark.createDataFrame(rows, MARKS_SCHEMA), f"{self.root}/marks", MARKS_SCHEMA)

    def _new(self, source: DataFrame | None, target: str, name: str) -> DataFrame:
        """Rows of `source` (called `name`, a raw table if no frame is given) that `target` has not taken
        in. How far that reaches is noted by `_done`, after the whole update: one that is cut short is
        built again."""
        reach, mark = self._mark(name, ITSELF), self._mark(target, name)
        if reach == I.EPOCH_MARK and source is not None:  # a table that is not kept here
            reach = I.high_water(source)
        self._reached.setdefault(target, {})[name] = reach
        if source is None:
            return raw_load.read_raw(self.spark, f"{self.root}/raw/{name}", mark)
        return I.newer_than(source, mark)

    def _done(self, target: str) -> None:
        """Rows take their load time over from the rows they are built from, so `target` reaches as far
        as the furthest of its sources."""
        reached = self._reached.pop(target, {})
        if reached:
            self._note(target, {**reached, ITSELF: max(reached.values())})

    # -- steps
    def plan(self, name: str, snapshot: str, initial_days: int, max_days: int) -> list[str]:
        """Update partitions of a raw table to load next; one row comes back."""
        path = f"{self.root}/raw/{name}"
        jvm = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        there = jvm.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(jvm)
        loaded = self.raw(name) if there else self.spark.createDataFrame([], raw_load.RAW_SCHEMA)
        days = raw_load.plan_partitions(loaded, snapshot, initial_days, max_days).first()["dates"]
        return days.split("|") if days else []

    def load(
        self,
        sources: dict[str, tuple[str, T.StructType]],
        days: Mapping[str, Sequence[str]] | None = None,
        files_per_day: int | None = None,
    ) -> None:
        """sources: raw table -> (folder of record files, their schema); days: raw table -> the update
        partitions planned for it. Tables without a plan load all new files."""
        for name, (folder, schema) in sources.items():
            planned = (days or {}).get(name)
            # Later than every load before, whatever the clocks say.
            at = max(datetime.now(), self._mark(name, ITSELF) + timedelta(microseconds=1))
            raw_load.load_new_files(
                self.spark, folder, f"{self.root}/raw/{name}", f"{self.root}/progress/{name}", schema,
                planned, None if planned is None else files_per_day, at,
            )
            self._note(name, {ITSELF: at})

    def clean(self, as_of: Column | None = None) -> None:
        self.store.overwrite(silver.funders(self.raw("funders")), "slv_funders")
        self.store.overwrite(silver.topics(self.raw("topics")), "slv_topics")
        for name, key, read in (
            ("awards", "award_id", silver.award_history),
            ("works", "work_id", lambda raw: silver.work_history(raw, as_of)),
        ):
            history = f"slv_{name}_history"
            versions = read(self._new(None, history, name))
            self._stored(history).append(
                versions, lambda new, cur, k=key: I.unseen(new, cur, k, "updated_at")
            )
            self._done(history)
        self._update_state("slv_awards", "slv_awards_history", silver.award_state, "award_id")
        self._update_state("slv_works", "slv_works_history", silver.work_state, "work_id")
        for name, read in (
            ("slv_work_authorships", silver.work_authorships), ("slv_work_awards", silver.work_awards)
        ):
            works = self._new(self.table("slv_works"), name, "slv_works")
            self._replace_children(name, read(works), works.select("work_id"), "work_id")

    def _update_state(self, name: str, history: str, latest, key: str) -> None:
        changed = latest(self._new(self.table(history), name, history))
        self._stored(name).update(
            changed, lambda cur, new: I.merge_newer(cur, new, key, "updated_at")
        )
        self._done(name)

    def _replace_children(self, name: str, children: DataFrame, parents: DataFrame, key: str) -> None:
        touched = None if self.strict else parents.distinct()
        self._stored(name).update(
            children, lambda cur, new: I.replace_children(cur, new, key, touched), touched
        )
        self._done(name)

    def _replace(self, name: str, rows: DataFrame) -> None:
        self._stored(name).update(rows, lambda cur, new: I.replace_rows(cur, new, self.KEYS[name]))
        self._done(name)

    def model(self) -> None:
        overwrite = self.store.overwrite
        overwrite(gold.calendar(self.spark), "dim_date")
        funder = overwrite(gold.dim_funder(self.table("slv_funders")), "dim_funder")
        topic = overwrite(gold.dim_topic(self.table("slv_topics")), "dim_topic")

        awards, works = self.table("slv_awards"), self.table("slv_works")
        first_run = not self._stored("dim_institution").exists()
        self._replace("dim_institution", gold.dim_institution(self._new(awards, "dim_institution", "slv_awards"), first_run))
        self._replace("dim_award", gold.dim_award(self._new(awards, "dim_award", "slv_awards")))
        self._model_works(works, topic)
        authorships = self.table("slv_work_authorships")
        self._replace("dim_author", gold.dim_author(self._new(authorships, "dim_author", "slv_work_authorships")))
        self._model_facts(awards, funder, topic)

        fresh = self._new(works, "brg_work_author", "slv_works").select(F.col("work_id").alias("work_key"))
        links = gold.bridge(authorships, fresh, self.table("dim_author"))
        self._replace_children("brg_work_author", links, fresh, "work_key")
        self._model_links(works)

    def _resolvable(self, name: str, keys: list[str], rows: DataFrame, rebuilt) -> DataFrame:
        """Stored rows with an unknown member, rebuilt, where one of them is known by now."""
        key = self.KEYS[name]
        unknown = [F.col(k) == UNKNOWN for k in keys]
        any_unknown = unknown[0]
        for u in unknown[1:]:
            any_unknown = any_unknown | u
        old = self.table(name).filter(any_unknown).select(key, *[F.col(k).alias(f"_old_{k}") for k in keys])
        source = rows.join(old.withColumnRenamed(key, rows.columns[0]).select(rows.columns[0]), rows.columns[0], "left_semi")
        again = rebuilt(source).join(old, key)
        changed = F.lit(False)
        for k in keys:
            changed = changed | (F.col(k) != F.col(f"_old_{k}"))
        return again.filter(changed).drop(*[f"_old_{k}" for k in keys])

    def _model_works(self, works: DataFrame, topic: DataFrame) -> None:
        build = lambda rows: gold.dim_work(rows, topic)
        known_before = self._stored("dim_work").exists()
        self._replace("dim_work", build(self._new(works, "dim_work", "slv_works")))
        if known_before:
            self._replace("dim_work", self._resolvable("dim_work", ["topic_key"], works, build))

    def _model_facts(self, awards: DataFrame, funder: DataFrame, topic: DataFrame) -> None:
        dims = (self.table("dim_award"), funder, topic, self.table("dim_institution"))
        build = lambda rows: gold.fact_awards(rows, *dims)
        known_before = self._stored("fact_awards").exists()
        self._replace("fact_awards", build(self._new(awards, "fact_awards", "slv_awards")))
        if known_before:
            keys = ["funder_key", "topic_key", "institution_key"]
            self._replace("fact_awards", self._resolvable("fact_awards", keys, awards, build))

    def _model_links(self, works: DataFrame) -> None:
        name = "fact_award_works"
        links, facts = self.table("slv_work_awards"), self.table("fact_awards")
        arrived = self._new(facts, name, "fact_awards").select(F.col("award_key").alias("award_id"))
        late = links.join(arrived, "award_id", "left_semi").select("work_id")
        touched = self._new(works, name, "slv_works").select("work_id").unionByName(late)
        if self._stored(name).exists():
            touched = touched.unionByName(self._resolved_links(facts))
        touched = touched.distinct()
        affected = links.join(touched, "work_id", "left_semi")
        rows = gold.fact_award_works(affected, self.table("dim_work"), facts)
        self._replace_children(
            "fact_award_works", rows, touched.withColumnRenamed("work_id", "work_key"), "work_key"
        )

    def _resolved_links(self, facts: DataFrame) -> DataFrame:
        """Works of stored links with an unknown member that their work or award knows by now."""
        members = ["topic_key", "funder_key"]
        old = self.table("fact_award_works").filter(
            (F.col("topic_key") == UNKNOWN) | (F.col("funder_key") == UNKNOWN)
        ).select("award_key", "work_key", *members)
        topics = self.table("dim_work").select("work_key", F.col("topic_key").alias("topic_now"))
        funders = facts.select("award_key", F.col("funder_key").alias("funder_now"))
        now = old.join(topics, "work_key", "left").join(funders, "award_key", "left")
        known = lambda had, has: (F.col(had) == UNKNOWN) & (F.col(has) != UNKNOWN)
        return now.filter(
            known("topic_key", "topic_now") | known("funder_key", "funder_now")
        ).select(F.col("work_key").alias("work_id"))

    CLEANED = ("slv_awards_history", "slv_works_history", "slv_awards", "slv_works", "slv_work_authorships",
               "slv_work_awards", "slv_funders", "slv_topics")

    def check(self, as_of: Column | None = None, layers: Sequence[str] = ("raw", "cleaned", "star")) -> DataFrame:
        """Report of the constraints of the named layers. A star's references are within the star."""
        names = [n for n in (*self.KEYS, *self.SNAPSHOTS) if layers != ("raw",) and ("star" in layers or n in self.CLEANED)]
        tables = {name: self.table(name) for name in names}
        checks: dict[str, list] = {}
        if "raw" in layers:
            tables |= {f"raw_{name}": self.raw(name) for name in RAW_TABLES}
            checks |= suite.raw_checks()
        if "cleaned" in layers:
            checks |= suite.cleaned_checks(tables, as_of)
        if "star" in layers:
            checks |= suite.star_checks(tables)
        return suite.run(tables, checks)

    def star(self) -> dict[str, DataFrame]:
        names = ("dim_date", "dim_topic", "dim_funder", "dim_institution", "dim_award", "dim_work",
                 "dim_author", "brg_work_author", "fact_awards", "fact_award_works")
        return {name: self.table(name) for name in names}

    def flatten(self, table: str = "obt_award_work") -> DataFrame:
        return reports.run_obt(self.star(), self.store, table, f"{self.root}/{table}_validation")

    def run(
        self,
        sources: dict[str, tuple[str, T.StructType]],
        as_of: Column | None = None,
        days: Mapping[str, Sequence[str]] | None = None,
        files_per_day: int | None = None,
    ) -> DataFrame:
        """One scheduled run; returns its row of evidence. Each layer's constraints are enforced before
        the next one is built: an error-level failure raises and nothing after it runs."""
        self.load(sources, days, files_per_day)
        K.enforce(self.check(as_of, ("raw",)))
        self.clean(as_of)
        K.enforce(self.check(as_of, ("cleaned",)))
        self.model()
        K.enforce(self.check(as_of, ("star",)))
        return self.flatten()
