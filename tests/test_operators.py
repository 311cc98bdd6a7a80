import math
import random

import pytest
from pyspark.sql import functions as F

from fundweave.operators import encode as E
from fundweave.operators import incremental as I
from fundweave.operators import ordering as O
from fundweave.operators import quality as K
from fundweave.operators import ranking as M
from fundweave.operators import sampling as S


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


# ---------------------------------------------------------------- ordering
def test_running_totals_match_a_plain_sum_for_a_hot_group(spark):
    rng = random.Random(1)
    data = [("hot" if rng.random() < 0.4 else f"g{rng.randrange(5)}", i, rng.randrange(9)) for i in range(600)]
    df = spark.createDataFrame(data, "g string, k int, v int").withColumn("block", F.floor(F.col("k") / 50))
    got = {(r.g, r.k): (r.total, r.size) for r in O.running_totals(
        df, ["g"], "block", [F.col("k")], {"total": F.col("v"), "n": F.lit(1)}, {"size": "n"}).collect()}
    for g in {d[0] for d in data}:
        total, members = 0, sorted(d for d in data if d[0] == g)
        for _, k, v in members:
            total += v
            assert got[g, k] == (total, len(members))


def test_quantiles_interpolate(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, None), (4.0, 5.0), (10.0, 5.0)], "a double, b double")
    got = {r.name: r for r in O.quantiles(df, ["a", "b"], [0.25, 0.5]).collect()}
    assert (got["a"].n, got["a"].q25, got["a"].q50) == (4, 1.75, 3.0)
    assert (got["b"].n, got["b"].q50) == (3, 5.0)


def test_top_k_is_limited_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), "id")
    plan = O.top_k(df, ["g"], [F.desc("id")], 2)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


# ---------------------------------------------------------------- incremental upkeep
def versions(spark, data):
    return spark.createDataFrame(data, "id string, v int, x string")


def test_merge_newer(spark):
    current = versions(spark, [("a", 2, "old"), ("b", 2, "old"), ("c", None, "old"), ("d", 2, "old"), ("e", None, "old")])
    changes = versions(spark, [("a", 3, "new"), ("b", 1, "new"), ("c", 1, "new"), ("d", None, "new"), ("e", None, "new"),
                               ("f", None, "new")])
    got = {r.id: (r.v, r.x) for r in I.merge_newer(current, changes, "id", "v").collect()}
    assert got == {"a": (3, "new"), "b": (2, "old"), "c": (1, "new"), "d": (2, "old"), "e": (None, "new"), "f": (None, "new")}


def test_append_is_idempotent_with_null_versions(spark):
    current = versions(spark, [("a", 1, "x"), ("a", None, "x")])
    batch = versions(spark, [("a", 1, "again"), ("a", None, "again"), ("a", 2, "new")])
    once = I.append_new(current, batch, "id", "v")
    assert rows(once) == rows(I.append_new(once, batch, "id", "v"))
    assert once.count() == 3


def test_replace_children(spark):
    current = spark.createDataFrame([("p", "a"), ("q", "b"), ("r", "c")], "parent string, child string")
    new = spark.createDataFrame([("p", "z")], "parent string, child string")
    changed = spark.createDataFrame([("p",), ("q",)], "parent string")
    assert rows(I.replace_children(current, new, "parent", changed)) == [("p", "z"), ("r", "c")]
    assert rows(I.replace_children(current, new, "parent")) == [("p", "z"), ("q", "b"), ("r", "c")]


def test_schema_drift(spark):
    ids = spark.createDataFrame([(0,)], "id long")
    merged = I.union_by_name(ids, ids.withColumn("extra", F.lit("e")))
    assert rows(merged) == [(0, "e"), (0, None)]


# ---------------------------------------------------------------- quality
def test_suite_counts_failures(spark):
    parent = spark.createDataFrame([("x",)], "k string")
    df = spark.createDataFrame([("a", 1, "x"), ("a", -1, "y"), (None, None, None)], "k string, n int, p string")
    report = K.check_table("t", df, [K.not_null("k"), K.unique("k"), K.unique("k", "n"), K.accepted_range("n", low=0),
                                     K.accepted_values("p", ["x"]), K.relationship("p", parent, "k", K.WARN)])
    got = {(r.check_name, r.column_name): r.failures for r in report.collect()}
    assert got == {("not_null", "k"): 1, ("unique", "k"): 1, ("unique_combination", "k,n"): 0, ("accepted_range", "n"): 1,
                   ("accepted_values", "p"): 1, ("relationship", "p"): 1}
    with pytest.raises(K.ValidationError, match="unique=1"):
        K.enforce(report)
    assert [r.check_name for r in K.enforce(report.filter("severity = 'warn'"))] == ["relationship"]


# ---------------------------------------------------------------- sampling
def in_python(links):
    received = {}
    for w, a in links:
        received.setdefault(w, set()).add(a)
    return received


def test_random_negatives_keep_the_ratio_even_for_a_hot_work(spark):
    links = [("W0", f"G{i}") for i in range(40)] + [(f"W{i}", f"G{i}") for i in range(1, 30)]
    positives = spark.createDataFrame(links, "work_key string, award_key string")
    awards = spark.createDataFrame([(f"G{i}",) for i in range(400)], "award_key string")
    drawn = rows(S.random_negatives(positives, awards))
    received = in_python(links)
    assert len(set(drawn)) == len(drawn) and not set(drawn) & set(links)
    for work, got in received.items():
        assert sum(w == work for w, _ in drawn) == 4 * len(got)
    assert drawn == rows(S.random_negatives(positives.repartition(3), awards.repartition(5)))


def test_random_negatives_give_all_there_are_when_supply_is_short(spark):
    positives = spark.createDataFrame([("W1", "G1"), ("W1", "G2")], "work_key string, award_key string")
    awards = spark.createDataFrame([(f"G{i}",) for i in range(1, 6)], "award_key string")
    assert rows(S.random_negatives(positives, awards)) == [("W1", "G3"), ("W1", "G4"), ("W1", "G5")]


def test_hard_negatives_are_in_force_and_half_hard(spark):
    rng = random.Random(3)
    awards = [(f"G{i}", 2000 + i % 4, None if i % 7 == 0 else 2002 + i % 5, f"T{i % 3}", f"C{i % 2}") for i in range(300)]
    links = [(f"W{w}", f"G{rng.randrange(300)}") for w in range(25) for _ in range(1 + 10 * (w == 0))]
    year, topic = {f"W{w}": 2001 + w % 3 for w in range(25)}, {f"W{w}": f"T{w % 3}" for w in range(25)}
    by_key = {a[0]: a for a in awards}
    links = sorted(set(links))
    positives = spark.createDataFrame([(w, a, year[w], topic[w], by_key[a][4]) for w, a in links],
                                      "work_key string, award_key string, year int, topic string, country string")
    pool = spark.createDataFrame(awards, "award_key string, first_year int, last_year int, topic string, country string")
    got = S.hard_negatives(positives, pool).collect()
    assert len({(r.work_key, r.award_key) for r in got}) == len(got)
    assert not {(r.work_key, r.award_key) for r in got} & set(links)
    countries = {}
    for w, a in links:
        countries.setdefault(w, set()).add(by_key[a][4])
    for r in got:
        _, first, last, t, c = by_key[r.award_key]
        assert first <= year[r.work_key] and (last is None or year[r.work_key] <= last)
        if r.kind == "hard":
            assert t == topic[r.work_key] or c in countries[r.work_key]
    for work in countries:
        n = sum(w == work for w, _ in links)
        kinds = [r.kind for r in got if r.work_key == work]
        assert len(kinds) == 4 * n and kinds.count("hard") == 2 * n


def test_draws_cross_the_shuffle_twice_and_large_works_get_the_same(spark):
    links = [("W0", f"G{i}", 2001, "T0", "C0") for i in range(70)] + [
        (f"W{w}", f"G{w + 7 * i}", 2001 + w % 3, None if w % 5 == 0 else f"T{w % 3}", f"C{w % 2}")
        for w in range(1, 20) for i in range(1 + w % 4)
    ]
    links += links[-2:]  # a pair that comes twice counts twice
    positives = spark.createDataFrame(links, "work_key string, award_key string, year int, topic string, country string")
    awards = spark.createDataFrame(
        [(f"G{i}", 2000 + i % 3, None, f"T{i % 3}", f"C{i % 2}") for i in range(220)],
        "award_key string, first_year int, last_year int, topic string, country string")
    once = S.hard_negatives(positives, awards)
    # 147 awards are in force for W0, which received 47 of them: it gets all others, spare hard ones too
    assert sum(r.work_key == "W0" for r in once.collect()) == 100
    assert rows(once) == rows(S.hard_negatives(positives, awards, work_rows=2)) == rows(S.hard_negatives(positives, awards, work_rows=0))
    # the candidates are stored, the draws are not
    assert {f.split("/")[-2].rsplit("-", 1)[0] for f in once.inputFiles()} == {"candidates"}


# ---------------------------------------------------------------- ranking
def test_precision_at_k_against_the_definition(spark):
    rng = random.Random(11)
    data = [(rng.randrange(2), rng.randrange(6) / 5, f"g{rng.randrange(30)}", i) for i in range(240)]
    df = spark.createDataFrame(data, "label int, score double, g string, i int")
    for k in (1, 3, 4):
        shares = []
        for g in {d[2] for d in data}:
            best = sorted((d for d in data if d[2] == g), key=lambda d: (-d[1], d[3]))[:k]
            shares.append(sum(d[0] for d in best) / len(best))
        assert M.precision_at_k(df, "g", k=k, tie=[F.col("i")]).first()[0] == pytest.approx(sum(shares) / len(shares))


def test_equal_scores_are_broken_by_the_pair_alone(spark):
    df = spark.range(90).select((F.col("id") % 4 == 0).cast("int").alias("label"), F.lit(2.5).alias("score"),
                                F.lit("one").alias("g"), F.col("id").alias("i"))
    pick = lambda d: {r.i for r in M.top_k_per_group(d, ["g"], tie=[M.tie_break("i")]).collect()}
    chosen = pick(df)
    assert chosen == pick(df.orderBy(F.desc("i"))) == pick(df.repartition(7)) and chosen != {0, 1, 2}


def test_small_groups_divide_by_their_own_size(spark):
    df = spark.createDataFrame([(1, 0.5, 1), (0, 0.4, 1)], "label int, score double, g int")
    assert M.precision_at_k(df, "g").first()[0] == 0.5


def test_average_precision_against_the_definition(spark):
    rng = random.Random(7)
    data = [(rng.randrange(2), rng.randrange(40) / 10, "ab"[rng.randrange(2)]) for _ in range(400)]
    df = spark.createDataFrame(data, "label int, score double, g string")
    got = {r.g: r.ap for r in M.average_precision(df, by=["g"]).collect()}
    for g in "ab":
        mine = [(y, s) for y, s, k in data if k == g]
        positives, expected, before = sum(y for y, _ in mine), 0.0, 0.0
        for cut in sorted({s for _, s in mine}, reverse=True):
            tp, n = sum(y for y, s in mine if s >= cut), sum(s >= cut for _, s in mine)
            expected += (tp / positives - before) * tp / n
            before = tp / positives
        assert math.isclose(got[g], expected, rel_tol=1e-9)


def test_folds_are_disjoint_by_group(spark):
    df = M.with_fold(spark.range(200).select(F.concat(F.lit("W"), F.col("id") % 40).alias("g")), "g")
    per_group = df.groupBy("g").agg(F.countDistinct("fold").alias("n"))
    assert per_group.filter("n > 1").count() == 0
    assert df.select("fold").distinct().count() == 5


# ---------------------------------------------------------------- encoding
def test_encoder_uses_training_statistics_only(spark):
    train = spark.createDataFrame([(1.0, None, "a")] * 20 + [(3.0, None, None)] * 20 + [(None, None, "r")],
                                  "x double, empty double, c string")
    fitted = E.FeatureEncoder(["x", "empty"], ["c"]).fit(train)
    s = fitted.statistics
    assert s.medians == {"x": 2.0} and s.categories == {"c": ["a", "desconocido", "infrequent"]}
    test = spark.createDataFrame([(None, 9.0, "unseen"), (3.0, 9.0, "a")], "x double, empty double, c string")
    got = [r.features.toArray().tolist() for r in fitted.transform(test).collect()]
    std = math.sqrt(sum((v - s.means["x"]) ** 2 for v in [1.0] * 20 + [3.0] * 20 + [2.0]) / 41)
    assert got[0] == pytest.approx([0.0, 0.0, 0.0, 1.0]) and got[1] == pytest.approx([1 / std, 1.0, 0.0, 0.0])


def test_unseen_category_without_rare_bucket_is_all_zeros(spark):
    train = spark.createDataFrame([(1.0, "a")] * 20 + [(1.0, "b")] * 20, "x double, c string")
    fitted = E.FeatureEncoder(["x"], ["c"]).fit(train)
    row = fitted.transform(spark.createDataFrame([(1.0, "z")], "x double, c string")).first()
    assert row.features.toArray().tolist() == [0.0, 0.0, 0.0]


def test_runs_are_the_candidates_of_consecutive_slots(spark):
    """Rings of one to a thousand candidates, runs that wrap around them, and more slots than candidates."""
    sizes = [1, 2, 3, 255, 256, 257, 512, 1000]
    start = {"u": 0, "v": 12_345_678, "w": S.STRIDE - 1}
    number = F.create_map(*[x for w, n in start.items() for x in (F.lit(w), F.lit(n).cast("long"))])
    pool = [(f"b{n}", f"a{n}-{i}", i, n) for n in sizes for i in range(n)]
    candidates = spark.createDataFrame(pool, "bucket string, award_key string, _number long, _size long")
    asked = [(w, f"b{n}", k) for w in start for n in sizes for k in (1, 300, 5000)]
    for k in (1, 300, 5000):
        want = {(w, f"b{n}", i): f"a{n}-{(start[w] + i * S.STRIDE) % n}" for w in start for n in sizes for i in range(min(k, n))}
        runs = S._runs(spark.createDataFrame([a for a in asked if a[2] == k], "work_key string, bucket string, _slots long"), candidates, lambda c: number[c])
        got = [((r.work_key, r.bucket, r.slot + i), a) for r in runs.collect() for i, a in enumerate(r.awards)]
        assert len(got) == len(want) and dict(got) == want


def test_hard_draws_travel_as_lists(spark):
    """As many rows go to the works as there are runs and positives, not as many as draws."""
    positives = spark.range(300).selectExpr("concat('W', id % 3) AS work_key", "concat('A', id) AS award_key", "2000 AS year", "'T' AS topic", "'C' AS country")
    awards = spark.range(5000).selectExpr("concat('A', id) AS award_key", "1999 AS first_year", "CAST(NULL AS INT) AS last_year", "'T' AS topic", "'C' AS country")
    found = S.hard_negatives(positives, awards)
    assert found.count() == 4 * 300
    tree = found._jdf.queryExecution().optimizedPlan().toString()
    above = tree[: tree.index("RepartitionByExpression [work_key")]
    assert "Generate posexplode(awards" in above


def test_awards_are_dealt_out_before_they_are_members_of_buckets(spark):
    """The same numbers either way, and no shuffle by block carries a row for each bucket of an award."""
    awards = spark.range(400).selectExpr("concat('A', id) AS award_key", "id % 3 AS x")
    members = lambda df: df.select("award_key", F.explode(F.array(F.lit("any"), F.concat(F.lit("t"), "x"))).alias("bucket"), *[c for c in df.columns if c[0] == "_"])
    got = S.numbered(awards, ["bucket"], "award_key", S.seeded_hash, members)
    assert rows(got.select("bucket", "award_key", "_number", "_size")) == rows(
        S.numbered(members(awards), ["bucket"], "award_key", S.seeded_hash).select("bucket", "award_key", "_number", "_size"))
    tree = got._jdf.queryExecution().optimizedPlan().toString()
    assert tree.index("Generate explode") < tree.index("RepartitionByExpression [_b")
