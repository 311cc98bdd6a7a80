import json
import os

import pytest
from pyspark.sql import functions as F

from fundweave.operators import quality as K
from fundweave.operators.quality import ValidationError
from fundweave.plans import build, gold, obt, reports
from fundweave.sources import workspace
from fundweave.sources.tables import KeyedTable, SnapshotStore, load_split
from fundweave.streaming import raw_load

DAY = "2024-06-30"


@pytest.fixture(scope="module")
def stepwise(spark):
    """The whole flow over two loads (see LOADS): its warehouse, its sources and a row a run."""
    return run_loads(spark, LOADS)


@pytest.fixture(scope="module")
def star(stepwise):
    return stepwise[0].star()


@pytest.fixture()
def store(spark):
    return SnapshotStore(spark, workspace.new_folder(spark, "test-store"))


def flattened_in_python(star):
    """The wide table by lookups in dicts, from the same star."""
    table = {name: [r.asDict() for r in df.collect()] for name, df in star.items()}
    by = lambda name, key: {r[key]: r for r in table[name]}
    facts, awards, works = by("fact_awards", "award_key"), by("dim_award", "award_key"), by("dim_work", "work_key")
    funders, places = by("dim_funder", "funder_key"), by("dim_institution", "institution_key")
    topics, dates, people = by("dim_topic", "topic_key"), by("dim_date", "date_key"), by("dim_author", "author_key")

    def text(title, body):
        title, body = (title or "").strip(), (body or "").strip()
        if title and body:
            return f"{title} {body}" if title[-1] in ".!?:;…" else f"{title}. {body}"
        return title or body or None

    rows = {}
    for link in table["fact_award_works"]:
        fact, award, paper = facts[link["award_key"]], awards[link["award_key"]], works[link["work_key"]]
        signed = [b for b in table["brg_work_author"] if b["work_key"] == link["work_key"]]
        lead = max((b["author_key"] for b in signed if b["author_position"] == "first"), default=None)
        rows[link["award_key"], link["work_key"]] = {
            "label": 1,
            "award_title": award["award_title"],
            "funder_name": funders[fact["funder_key"]]["funder_name"],
            "lead_institution_name": places[fact["institution_key"]]["institution_name"],
            "award_topic_name": topics[fact["topic_key"]]["topic_name"],
            "award_start_date": dates[fact["start_date_key"]]["full_date"],
            "amount": fact["amount"],
            "work_title": paper["title"],
            "work_topic_key": link["topic_key"],
            "work_topic_name": topics[link["topic_key"]]["topic_name"],
            "publication_date": dates[link["publication_date_key"]]["full_date"],
            "author_keys": sorted({b["author_key"] for b in signed}),
            "linked_authors_count": len({b["author_key"] for b in signed}),
            "first_author_key": lead,
            "first_author_name": lead and people[lead]["author_name"],
            "corresponding_author_keys": sorted({b["author_key"] for b in signed if b["is_corresponding"]}),
            "author_country_codes": sorted({b["institution_country_code"] for b in signed} - {None}),
            "award_text": text(award["award_title"], award["award_description"]),
            "work_text": text(paper["title"], paper["abstract_text"]),
        }
    return rows


def test_wide_table_equals_a_plain_flatten(star, store):
    metrics = {}
    built = obt.build(star, store, "obt", metrics)
    want = flattened_in_python(star)
    assert built.columns == obt.OBT_COLUMNS
    got = {(r.award_key, r.work_key): r.asDict() for r in built.collect()}
    assert {key: {c: row[c] for c in want[key]} for key, row in got.items()} == want
    assert metrics["base_rows"] == metrics["obt_rows"] == len(want)
    # the cases the star is meant to hold
    assert want["G4", "W5"]["author_keys"] == [] and want["G1", "W1"]["first_author_key"] == "A2"
    assert got["G4", "W5"]["funder_key"] == got["G4", "W5"]["award_topic_key"] == "UNKNOWN"


def test_rows_meet_names_last_and_digests_at_their_own_grain(star):
    shown = {"abstract_text": F.md5, "work_text": F.md5}
    full, got = obt.published(obt.flatten(star)), obt.published(obt.flatten(star, shown)).drop("_obt_built_at")
    want = full.withColumns({c: f(F.col(c)) for c, f in shown.items()}).drop("_obt_built_at")
    assert got.columns == want.columns
    plain = lambda df: sorted(map(str, df.collect()))
    assert plain(got) == plain(want) and got.filter("abstract_text IS NOT NULL").count() > 0
    # topics of both roles and both days are looked up above the joins that shuffle links
    tree = full._jdf.queryExecution().optimizedPlan().toString().splitlines()
    joins = [line for line in tree if "Join " in line]
    assert ["strategy=broadcast" in j for j in joins[:5]] == [True] * 4 + [False]
    # no text is carried to the links where its digest is shown
    tree = got._jdf.queryExecution().optimizedPlan().toString()
    links = tree[: tree.index("struct(work_key")]
    assert "md5(" not in links and "regexp" not in links.lower().replace("award_", "")


def test_a_version_finds_repeated_texts_in_a_whole_page(spark, store):
    """Texts of 40,000 characters that differ between publications and are the same for their links."""
    text = F.concat_ws("", F.transform(F.sequence(F.lit(1), F.lit(1250)), lambda i: F.md5(F.concat_ws(" ", F.col("w"), i))))
    texts = spark.range(60).select(F.col("id").alias("w")).select("w", text.alias("t"))
    wide = texts.crossJoin(spark.range(10)).coalesce(1).sortWithinPartitions("w")
    version = store.stage(wide, "wide")
    stored = sum(n for _, n in workspace.files(spark, f"{store.root}/wide/{version}"))
    assert stored < 60 * 40_000 * 2 and store.read_version("wide", version).count() == 600


def twice(df):
    return df.unionByName(df)


@pytest.mark.parametrize(
    "table, edit, message",
    [
        ("dim_topic", twice, "dim_topic"),
        ("brg_work_author", twice, "brg_work_author"),
        ("dim_institution", lambda df: df.filter("institution_key <> 'IG1'"), "'orphans_dim_institution': 2"),
        ("fact_awards", lambda df: df.filter("award_key <> 'G2'"), "'orphans_fact_awards': 2"),
        ("dim_date", lambda df: df.filter("date_key <> 20200505"), "'orphans_publication_date': 6"),
        ("fact_award_works", lambda df: df.limit(0), "nothing to flatten"),
    ],
)
def test_gates_stop_before_anything_is_published(star, store, table, edit, message):
    with pytest.raises(ValidationError, match=message):
        obt.build({**star, table: edit(star[table])}, store, "obt", {})
    assert store.read("obt") is None


def test_hot_keys_are_split(spark, star):
    """A third of the links on one award and a third on one work: both joins split them."""
    mixed = lambda hot, other: F.when(hot, "hot").otherwise(F.concat(F.lit("k"), other.cast("string")))
    n = F.col("id")
    links = spark.range(0, 30_000, 1, 8).select(
        mixed(n % 3 == 0, n % 2000).alias("award_key"), mixed(n % 3 == 1, n % 3000).alias("work_key"),
        F.lit("T1").alias("topic_key"), F.lit(20200505).alias("publication_date_key"),
    )

    def grown(name, key):
        keys = links.select(F.col(key)).distinct()
        return workspace.cut(keys.crossJoin(star[name].limit(1).drop(key)), name)  # one row on the right

    big = {**star, "fact_award_works": workspace.cut(links, "links"), "dim_work": grown("dim_work", "work_key")}
    big |= {t: grown(t, "award_key") for t in ("fact_awards", "dim_award")}
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.files.maxPartitionBytes": "32k", "spark.sql.files.openCostInBytes": "1k",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        wide = obt.flatten(big).select("award_key", "work_key", "award_title", "work_title", "first_author_name")
        assert len(wide.collect()) == 30_000
        assert wide._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("skew=true") >= 2
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_every_run_leaves_evidence_and_failures_reach_the_caller(spark, star, store):
    log = workspace.new_folder(spark, "log")
    reports.run_obt(star, store, "obt", log)
    published = store.read("obt").count()
    with pytest.raises(ValidationError, match="nothing to flatten"):
        reports.run_obt({**star, "fact_award_works": star["fact_award_works"].limit(0)}, store, "obt", log)
    rows = {r.status: r for r in spark.read.parquet(log).collect()}
    assert rows["OK"].orphans_total == 0 and json.loads(rows["OK"].metrics_json)["base_rows"] == published
    assert (rows["FAILED"].obt_rows, rows["FAILED"].orphans_total) == (-1, -1) and "nothing to flatten" in rows["FAILED"].error
    assert store.read("obt").count() == published


def test_evidence_that_cannot_be_written_hides_nothing(star, store, caplog):
    row = reports.run_obt(star, store, "obt", "no-such-scheme://nowhere/log")
    assert row.first().status == "OK" and "evidence not written" in caplog.text


def test_planned_days_and_corrupt_files(spark):
    root = workspace.new_folder(spark, "planned")
    rows = spark.createDataFrame([(f"r{d}{i}", f"2024-01-0{d}") for d in range(1, 5) for i in range(d)], "id string, updated_date string")
    rows.coalesce(1).write.partitionBy("updated_date").parquet(f"{root}/in")
    schema = rows.select("id").schema
    load = lambda days=None, parts=None: raw_load.load_new_files(
        spark, f"{root}/in", f"{root}/raw", f"{root}/progress", schema, days, parts)
    ids = lambda: sorted(r[0] for r in raw_load.read_raw(spark, f"{root}/raw").selectExpr("variant_get(raw, '$.id', 'string')").collect())
    load(["2024-01-02", "2024-01-04"])
    assert ids() == sorted([f"r2{i}" for i in range(2)] + [f"r4{i}" for i in range(4)])
    load([])
    load(["2024-01-01"], 3)  # the only file there is not called part_000N
    assert len(ids()) == 6
    load()  # older days than the newest one loaded, and nothing twice
    assert len(ids()) == 10
    broken = f"{root.removeprefix('file:')}/in/updated_date=2024-01-05"
    os.makedirs(broken)
    with open(f"{broken}/part_0000.parquet", "w") as out:
        out.write("not a table")
    spark.createDataFrame([("new",)], "id string").coalesce(1).write.mode("append").parquet(f"{root}/in/updated_date=2024-01-06")
    with pytest.raises(Exception, match="(?i)parquet"):
        load()
    assert len(ids()) == 10


def test_keyed_table_rewrites_and_empties_partitions(spark):
    table = KeyedTable(spark, workspace.new_folder(spark, "keyed"), "k", buckets=4)
    table.create(spark.createDataFrame([(f"k{i}", i) for i in range(20)], "k string, v int"))
    gone = spark.createDataFrame([(f"k{i}",) for i in range(20)], "k string")
    none = spark.createDataFrame([], "k string, v int")
    table.update(spark.createDataFrame([("k1", 100), ("new", 5)], "k string, v int"),
                 lambda cur, new: cur.join(new, "k", "left_anti").unionByName(new))
    got = {r.k: r.v for r in table.read().collect()}
    assert got["k1"] == 100 and got["new"] == 5 and got["k7"] == 7 and len(got) == 21
    table.update(none, lambda cur, new: cur.join(gone, "k", "left_anti"), gone)
    assert [r.k for r in table.read().collect()] == ["new"]


def test_partition_plan(spark):
    loaded = spark.createDataFrame([("works/updated_date=2024-01-05/part_0000.parquet",), ("no date",)], "_source_file string")
    plan = lambda *args, **kw: raw_load.plan_partitions(*args, **kw).first()
    r = plan(loaded, "2024-01-08", 3, 2)
    assert (r.last_loaded, r.n_days, r.dates, r.truncated) == ("2024-01-05", 2, "2024-01-06|2024-01-07", True)
    r = plan(loaded, "2024-01-05", 3, 2)
    assert (r.n_days, r.dates, r.truncated) == (0, "", False)
    r = plan(loaded.limit(0), "2024-01-08", 3, 9)
    assert (r.last_loaded, r.dates) == (None, "2024-01-06|2024-01-07|2024-01-08")


def test_split_names(spark):
    with pytest.raises(ValueError):
        load_split(spark, "anywhere", "validation")
    with pytest.raises(FileNotFoundError):
        load_split(spark, None, "test", spark.range(1))
    assert load_split(spark, None, "train", spark.range(3)).count() == 3


# ---------------------------------------------------------------- the whole flow in steps
RECORDS = {
    "awards": "id string, updated_date string, display_name string, amount string, currency string, start_date string, "
    "end_date string, funder struct<id:string>, primary_topic struct<id:string>, "
    "institution_awarded array<struct<id:string,display_name:string,country_code:string,type:string,ror:string>>",
    "works": "id string, updated_date string, title string, publication_date string, primary_topic struct<id:string>, "
    "abstract_inverted_index string, awards array<struct<id:string,funder_id:string,funder_award_id:string>>, "
    "authorships array<struct<author:struct<id:string,display_name:string,orcid:string>,author_position:string,"
    "is_corresponding:boolean,institutions:array<struct<id:string,display_name:string,country_code:string>>>>",
    "funders": "id string, display_name string, country_code string, updated_date string",
    "topics": "id string, display_name string, updated_date string, subfield struct<id:string,display_name:string>, "
    "field struct<id:string,display_name:string>, domain struct<id:string,display_name:string>",
}


def award(k, day, amount, funder="F1", topic="T1"):
    return (f"https://x/{k}", f"{day} 00:00:00", f"Award {k}", amount, " usd ", "2020-01-01", "2021-01-01",
            (f"https://x/{funder}",), (f"https://x/{topic}",), [(f"https://x/I{k}", "Place", "us", "Company", None)])


def work(k, day, awards, authors, title="Paper", topic="T1"):
    people = [((f"https://x/{a}", f"Name {a}", None), "first", True, [("https://x/I1", "Place", "us")]) for a in authors]
    return (f"https://x/{k}", f"{day} 00:00:00", title, "2020-05-05", (f"https://x/{topic}",), '{"b": [1], "a": [0]}',
            [(f"https://x/{a}", None, None) for a in awards], people)


def topic(k):
    return (f"https://x/{k}", f"Topic {k}", "2024-01-01 00:00:00", ("s", "S"), ("f", "F"), ("d", "D"))


LOADS = [
    {
        # a funder that comes later, a funder and a topic that never come
        "awards": [award("G1", "2024-01-01", "10"), award("G2", "2024-01-01", "-1", funder="F2"),
                   award("G4", "2024-01-01", "5", funder="F9", topic="T9")],
        "works": [work("W1", "2024-01-01", ["G1", "G3"], ["A1", "A2"]), work("W2", "2024-01-05", ["G2"], ["A1"]),
                  work("W3", "2024-01-01", ["G1"], ["A3"]), work("W5", "2024-01-01", ["G4"], [], title=None),
                  work("W6", "2024-01-01", ["G1"], ["A1"], topic="T2")],
        "funders": [("https://x/F1", "First", "us", "2024-01-01 00:00:00")],
        "topics": [topic("T1")],
    },
    {
        # a newer award, one that links were waiting for, a work that lost everything, an older version arriving late
        "awards": [award("G1", "2024-02-01", "20"), award("G3", "2024-02-01", "30", topic="T2")],
        "works": [work("W3", "2024-02-01", [], []), work("W2", "2024-01-02", ["G1"], ["A9"], title="Stale"),
                  work("W4", "2024-02-01", ["G2"], ["A1"])],
        "funders": [("https://x/F2", "Second", "cl", "2024-02-01 00:00:00")],
        "topics": [topic("T2")],
    },
]


def run_loads(spark, loads):
    folder = workspace.new_folder(spark, "flow")
    house = build.Warehouse(spark, f"{folder}/house", buckets=2)
    sources = {name: (f"{folder}/in/{name}", spark.createDataFrame([], ddl).schema) for name, ddl in RECORDS.items()}
    rows = []
    for load in loads:
        for name, records in load.items():
            spark.createDataFrame(records, RECORDS[name]).coalesce(1).write.mode("append").parquet(f"{folder}/in/{name}")
        rows.append(house.run(sources, F.lit("2024-06-30").cast("date")).first())
    return house, sources, rows


def contents(house, name):
    df = house.table(name)
    hidden = {"_loaded_at", "_source_file", "authorships", "awards", "institutions_awarded", "funded_outputs", "keywords"}
    return sorted(map(str, df.select(*[c for c in sorted(df.columns) if c not in hidden]).collect()))


def wide_contents(house):
    return sorted(map(str, house.store.read("obt_award_work").drop("_obt_built_at").collect()))


@pytest.mark.slow
def test_loading_in_steps_equals_loading_at_once(spark, stepwise):
    stepwise, sources, rows = stepwise
    together = {name: LOADS[0][name] + LOADS[1][name] for name in LOADS[0]}
    at_once, _, _ = run_loads(spark, [together])
    assert [r.status for r in rows] == ["OK", "OK"]
    for name in (*stepwise.KEYS, *stepwise.SNAPSHOTS):
        ours, theirs = contents(stepwise, name), contents(at_once, name)
        if name == "dim_author":  # a member stays known when the last work that named it drops it
            ours = [row for row in ours if "'A3'" not in row]
        assert ours == theirs, name
    assert wide_contents(stepwise) == wide_contents(at_once)
    links = {(r.award_key, r.work_key) for r in stepwise.table("fact_award_works").collect()}
    assert links == {("G1", "W1"), ("G3", "W1"), ("G2", "W2"), ("G2", "W4"), ("G4", "W5"), ("G1", "W6")}
    facts = {r.award_key: r for r in stepwise.table("fact_awards").collect()}
    assert facts["G2"].funder_key == "F2" and facts["G1"].amount == 20 and facts["G2"].is_amount_invalid
    works = {r.work_key: r for r in stepwise.table("dim_work").collect()}
    assert works["W2"].title == "Paper" and works["W1"].abstract_text == "a b"

    before = {name: contents(stepwise, name) for name in ("slv_awards_history", "fact_awards", "brg_work_author")}
    raw_rows = stepwise.raw("works").count()
    again = stepwise.run(sources, F.lit("2024-06-30").cast("date")).first()
    assert again.status == "OK" and stepwise.raw("works").count() == raw_rows
    assert before == {name: contents(stepwise, name) for name in before}


def test_failing_constraint_stops_the_flow(spark, monkeypatch):
    """An error-level failure among the cleaned tables: nothing of the star is built. Warnings pass."""
    house, steps = build.Warehouse(spark, workspace.new_folder(spark, "stopped")), []
    for step in ("load", "clean", "model", "flatten"):
        monkeypatch.setattr(house, step, lambda *args, step=step: steps.append(step))
    works = spark.createDataFrame([("Paper",)], "title string")

    def check(as_of, layers):
        severity = K.ERROR if layers == ("cleaned",) else K.WARN
        return K.check_table("slv_works", works, [K.relationship("title", works.limit(0), "title", severity)])

    monkeypatch.setattr(house, "check", check)
    with pytest.raises(ValidationError, match="slv_works.title relationship=1"):
        house.run({})
    assert steps == ["load", "clean"]


def test_interrupted_update_is_built_again(spark, monkeypatch):
    """An update that stops after half of its partitions were swapped leaves its mark where it was."""
    house = build.Warehouse(spark, workspace.new_folder(spark, "house"), buckets=4)
    source = spark.range(60).select(
        F.col("id").cast("string").alias("award_key"),
        F.lit(1).alias("amount"),
        F.timestamp_seconds(F.lit(100)).alias("_loaded_at"),
    )
    later = source.withColumns({"amount": F.lit(2), "_loaded_at": F.timestamp_seconds(F.lit(200))})
    house._replace("dim_award", house._new(source, "dim_award", "src"))
    table = house._stored("dim_award")
    whole = KeyedTable._write

    def half(self, df):
        whole(self, df.filter("_bucket < 2"))
        raise RuntimeError("stopped")

    monkeypatch.setattr(KeyedTable, "_write", half)
    with pytest.raises(RuntimeError):
        house._replace("dim_award", house._new(later, "dim_award", "src"))
    monkeypatch.setattr(KeyedTable, "_write", whole)
    assert table.read().groupBy("amount").count().count() == 2
    house._replace("dim_award", house._new(later, "dim_award", "src"))
    assert [tuple(r) for r in table.read().groupBy("amount").count().collect()] == [(2, 60)]
    assert house._new(later, "dim_award", "src").count() == 0


def test_keyed_table_without_rows_reads_and_grows(spark):
    table = KeyedTable(spark, workspace.new_folder(spark, "keyed"), "k", buckets=4)
    none = spark.createDataFrame([], "k bigint, v string")
    table.update(none, lambda cur, new: new)
    assert table.read().count() == 0 and table.read().columns == ["k", "v"]
    wide = spark.createDataFrame([(1, "a", 5)], "k bigint, v string, w int")
    table.update(wide, lambda cur, new: cur.unionByName(new, allowMissingColumns=True))
    assert [tuple(r) for r in table.read().collect()] == [(1, "a", 5)]


def test_null_label_breaks_the_pair_contract(spark):
    from fundweave.plans import pairs

    rows = [("a", "w", 1), ("b", "w", 0), ("c", "w", None)]
    df = spark.createDataFrame(rows, "award_key string, work_key string, label int")
    for c in pairs.TEXT_COLUMNS:
        df = df.withColumn(c, F.lit("t"))
    df = df.withColumn("publication_year", F.lit(pairs.TRAIN_YEARS[0]))
    assert not pairs.contract(df).first()["labels_binary"]


def test_the_contract_takes_as_many_tasks_as_there_are_pairs(spark, monkeypatch):
    from fundweave.plans import pairs

    rows = [(f"w{i // 4}", f"a{i}", int(i % 4 == 0), 2020) for i in range(200)]
    df = spark.createDataFrame(rows, "work_key string, award_key string, label int, publication_year int")
    df = df.withColumns({c: F.lit("t") for c in pairs.TEXT_COLUMNS})
    monkeypatch.setattr(pairs, "BLOCK_ROWS", 10)
    kept = pairs.contract(df)
    assert "REPARTITION_BY_NUM" in kept._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(work_key" in (plan := kept._jdf.queryExecution().executedPlan().toString()) and ", 21)" in plan
    assert list(kept.first()) == [True] * 5
    again = pairs.contract(df.unionByName(df.limit(1)))
    assert not again.first()["keys_unique"] and again.first()["groups_have_both"]
    alone = pairs.contract(df.filter("label = 1"))
    assert alone.first()["keys_unique"] and not alone.first()["groups_have_both"]


def test_compact_awards_are_the_same_rows(spark, star):
    """Empty and blank texts, negative and missing numbers come out of the list as they went in."""
    odd = {
        "award_title": F.lit(""), "award_description": F.lit(' "q", \\ ñ\n\x00'), "amount": F.lit("-0.10").cast("decimal(18,2)"),
        "duration_days": F.lit(-2_147_483_648), "currency": F.lit(None).cast("string"),
    }
    edited = {t: star[t].withColumns({c: e.cast(star[t].schema[c].dataType) for c, e in odd.items() if c in star[t].columns}) for t in ("fact_awards", "dim_award")}
    for tables in (star, {**star, **edited}):
        plain, got = (obt.published(obt.flatten(tables, compact=c)).drop("_obt_built_at") for c in (False, True))
        assert got.schema.simpleString() == plain.schema.simpleString()
        assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect())) and got.count() > 0
    # above the join that brings the award, links carry one column of it
    tree = got._jdf.queryExecution().optimizedPlan().toString().splitlines()
    at = next(i for i, line in enumerate(tree) if "Join LeftOuter, (struct(award_key" in line)
    assert "_packed" in tree[at - 1] and "funder_name" not in tree[at - 1]


def test_authors_are_listed_where_the_works_left_them(star):
    """The bridge meets works last, so its rows need no further shuffle to be listed by work."""
    session = star["brg_work_author"].sparkSession
    rows = workspace.cut(star["brg_work_author"].withColumnsRenamed({"work_key": "work_id", "author_key": "author_id"}), "authorships")
    works, authors = (workspace.cut(star[n], n) for n in ("dim_work", "dim_author"))
    before = session.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        session.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        lists = gold.bridge(rows, works, authors).groupBy("work_key").agg(F.collect_set("author_key"))
        plan = lists._jdf.queryExecution().executedPlan().toString()
    finally:
        session.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") == 4


def test_a_wide_table_of_few_columns(star):
    wanted = ["work_key", "award_key", "funder_name", "award_topic_name", "publication_year"]
    rows = lambda df: sorted(map(str, df.select(*wanted).collect()))
    want = rows(obt.flatten(star))
    assert rows(obt.flatten(star, columns=wanted)) == want == rows(obt.flatten(star, columns=wanted, compact=True))
    assert "award_text" not in obt.flatten(star, columns=wanted).columns
