"""The audits and the quality network against plain versions, on the corpus and on odd rows."""

from __future__ import annotations

import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fundweave.llm import common, divergence, interaction, qualitynet
from fundweave.llm.transducer import Transducer

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, score string, part string, n string"


def odd_rows():
    r = random.Random(9)
    word = lambda: "".join(r.choice("abcdEF#é") for _ in range(r.randint(1, 3)))
    base = [" ".join(word() for _ in range(r.randint(1, 300))) for _ in range(30)]
    texts = [None, "", " \n\t ", "one", "A", "a\x85b c", "x y z " * 30_000, "q" * 200_000, *base, *base[:6], base[0], ""]
    rows = [(i, t, r.choice(["en", "de", None, "", "a.b"]), r.choice(["s", "t", None, ""]), "x", "y", "z") for i, t in enumerate(texts)]
    rows += [rows[12], rows[12], (None, base[1], "en", "s", None, None, None), (None, None, None, None, None, None, None)]
    rows += [(3, "one", "en", "s", "", "", ""), (900, "lone words", "only", "here", "", "", "")]
    return rows


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SMALL}/labels.parquet")


@pytest.fixture(scope="module")
def odd_labels(spark):
    rows = [(i, i % 3 != 0, i % 4 == 1) for i in range(0, 40, 2)] + [(4, True, True), (4, False, False), (None, True, True)]
    rows = [(i, None if i == 6 else int(q), int(t)) for i, q, t in rows]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


# ---------------------------------------------------------------- filter interaction


def plain_masks(rows):
    """(part, set of failed filters) of every row."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", r.text or "") for r in rows]
    key = lambda r: (r.doc_id is None, r.doc_id or 0)
    least = {}
    for r in rows:
        least[r.text or ""] = min(least.get(r.text or "", key(r)), key(r))
    out = []
    for r, w in zip(rows, words):
        text = r.text or ""
        fails = {
            "A": len(w) < 200,
            "B": 100 * len(set(w)) < 50 * len(w),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text),
            "D": bool(set(text) & set("#$%&*|")),
            "E": key(r) > least[text],
        }
        out.append((r.lang or "", {f for f, bad in fails.items() if bad}))
    return out


def plain_audit(rows, marks):
    found = {}
    masks = plain_masks(rows)
    for (part, fails), r in zip(masks, rows):
        good, toxic = marks.get(r.doc_id, (False, False))
        for order in itertools.permutations("ABCDE"):
            gone = False
            for step, f in enumerate(order, 1):
                c = found.setdefault((part, "".join(order), step), Counter())
                removed = f in fails and not gone
                c["redundant"] += f in fails and gone
                c["removed"] += removed
                c["unique_fails"] += fails == {f}
                c["good_lost"] += removed and good
                c["toxic_lost"] += removed and toxic
                gone = gone or f in fails
                c["kept"] += not gone
    total = Counter()
    for (part, order, step), c in found.items():
        total[(part, order[step - 1])] += c["removed"]
    for (part, order, step), c in found.items():
        c["shapley"] = total[(part, order[step - 1])]
    return found


def marks_of(labels):
    out = {}
    for r in labels.collect():
        if r.doc_id is not None:
            good, toxic = out.get(r.doc_id, (False, False))
            out[r.doc_id] = (good or r.quality == 1, toxic or r.toxic == 1)
    return out


@pytest.mark.parametrize("which", ["odd", "docs"])
def test_audit_equals_plain(request, which, labels, odd_labels):
    df, known = request.getfixturevalue(which), odd_labels if which == "odd" else labels
    counted = interaction.verdicts(df, known, interaction.text_filters(F.col("text")))
    got = interaction.audit(counted, "ABCDE").collect()
    want = plain_audit(df.collect(), marks_of(known))
    assert len(got) == len(want)
    for r in got:
        assert {c: r[c] for c in (*interaction.OUTCOMES, "shapley")} == dict(want[(r.part, r.filter_order, r.step)])


def test_audit_of_nothing_and_of_many_copies(spark, empty, labels):
    filters = interaction.text_filters(F.col("text"))
    assert interaction.audit(interaction.verdicts(empty, labels, filters), "ABCDE").count() == 0
    copies = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("same").alias("text"), F.lit("en").alias("lang"))
    counted = interaction.verdicts(copies, labels.filter("false"), filters)
    assert sorted(r.n for r in counted.collect()) == [1, 4999]
    last = interaction.audit(counted, "ABCDE").filter("filter_order = 'EABCD' AND step = 1").first()
    assert (last.removed, last.kept, last.unique_fails) == (4999, 1, 0)


@settings(max_examples=20, deadline=None, derandomize=True)
@given(st.lists(st.tuples(st.integers(0, 31), st.integers(1, 2**61 // 20)), max_size=20))
def test_fields_do_not_carry(masks):
    counters = interaction.Counters("ABCDE")
    total = sum(n * counters.wide(mask << 2) for mask, n in masks)
    want = np.zeros((120, 5, len(interaction.OUTCOMES)), object)
    for mask, n in masks:
        want = want + counters.pattern(mask, 0).astype(object) * n
    assert (counters.unpack(total) == want.astype(np.int64)).all()


# ---------------------------------------------------------------- transducer and source divergence


@settings(max_examples=200, deadline=None, derandomize=True)
@given(st.sets(st.binary(max_size=6), max_size=60), st.lists(st.binary(max_size=7), max_size=20))
def test_transducer_numbers_words_in_order(words, others):
    ordered = sorted(words)
    machine = Transducer.from_bytes(Transducer.build(ordered).to_bytes())
    asked = ordered + others
    want = [ordered.index(w) if w in words else -1 for w in asked]
    assert machine.ordinals(asked).tolist() == want
    assert [machine.word(i) for i in range(len(ordered))] == ordered


def test_transducer_is_minimal():
    """As many states as there are distinct sets of endings."""
    words = sorted({a + b + c for a in (b"ta", b"to", b"re") for b in (b"", b"x", b"yy") for c in (b"ing", b"ed", b"")})
    endings = {frozenset(w[i:] for w in words if w.startswith(p[:i])) for p in words for i in range(len(p) + 1)}
    assert len(Transducer.build(words).final) == len(endings)
    with pytest.raises(ValueError):
        Transducer.build([b"b", b"a"])


def plain_divergence(rows, least=3, top=200):
    cut = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    docs = [(r.lang or "", r.source or "", cut.findall((r.text or "").translate(lower))) for r in rows]
    seen = Counter((lang, t) for lang, _, ts in docs for t in set(ts))
    out = []
    for lang in {d[0] for d in docs}:
        kept = [t for (x, t), n in seen.items() if x == lang and n >= least]
        sources = sorted({s for x, s, _ in docs if x == lang}, key=str.encode)
        counts = {s: Counter(t for x, y, ts in docs if (x, y) == (lang, s) for t in ts) for s in sources}
        counts[None] = sum(counts.values(), Counter())
        p = {}
        for s, c in counts.items():
            n = sum(c[t] for t in kept)
            p[s] = {t: 1 + 10**9 * (c[t] + 1) // (n + len(kept)) for t in kept}
        f = lambda a, b: (a - b) ** 2 // b
        for s in sources:
            pairs = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in sources if o != s]
            ahead = [(f(p[s][t], p[None][t]), t) for t in kept if counts[s][t] and p[s][t] > p[None][t]]
            for part, found, upto in (("pair", pairs, None), ("term", ahead, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, v, i) for i, (v, item) in enumerate(found[:upto], 1)]
    return out


@pytest.mark.parametrize("which,shard,block,tile", [("odd", 1 << 14, 2048, 64), ("docs", 50, 7, 3), ("docs", 1 << 14, 2048, 64)])
def test_divergence_equals_plain(request, monkeypatch, which, shard, block, tile):
    df = request.getfixturevalue(which)
    for name, value in (("SHARD", shard), ("BLOCK", block), ("TILE", tile)):
        monkeypatch.setattr(divergence, name, value)
    names = ("lang", "source", "part", "item", "value", "rank")
    got = divergence.audit(df).select(*names).collect()
    assert Counter(tuple(r) for r in got) == Counter(plain_divergence(df.collect()))


def test_divergence_of_nothing(empty, spark):
    assert divergence.audit(empty).count() == 0
    alone = spark.createDataFrame([(1, "a b", "en", "s")], "doc_id bigint, text string, lang string, source string")
    assert divergence.audit(alone).count() == 0


def test_shares_are_exact_beyond_64_bits():
    n, total, size = [0, 4 * 10**12 + 7, 9 * 10**12], 9 * 10**13 + 1, 12_345_678
    for some in (n, n[:1]):
        got = divergence.shares(np.asarray(some, np.int64), total, size)
        assert got.tolist() == [1 + 10**9 * (x + 1) // (total + size) for x in some]


def test_texts_are_cut_in_pieces(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(divergence, "PIECE", 10)
    rows = pa.RecordBatch.from_pydict({"text": ["a" * 9, "b", "c" * 50, "", "", "d e"]})
    assert [len(x) for x in divergence.pieces(iter([rows, rows.slice(5)]))] == [2, 1, 3, 1]
    assert pa.concat_tables([pa.Table.from_batches([x]) for x in divergence.pieces(iter([rows]))])["text"].to_pylist() == rows["text"].to_pylist()
    found = divergence.terms(rows.slice(4)["text"])
    assert (found.document.tolist(), [found.terms[c].as_py() for c in found.code]) == ([1, 1], [b"d", b"e"])


# ---------------------------------------------------------------- quality network

TEXTS = ["", None, "a", "short text", "é中\U0001f600" * 90, "word " * 400, "x" * 5000, "ab\ncd" * 700]


def test_scorer_equals_plain_forward():
    m = qualitynet.train(TEXTS, [i % 2 for i in range(len(TEXTS))], seen=64)
    data = [(t or "").encode() for t in TEXTS]
    fast = qualitynet.Scorer(m).score(data)
    w, s = qualitynet.WIDTH, qualitynet.SEGMENT
    for text, got in zip(data, fast):
        text = text or b"\0"
        x = m.bytes_[list(text + b"\0" * (w - 1))]
        z = np.stack([np.einsum("we,wef->f", x[i : i + w], m.filters) for i in range(len(text))])
        starts = range(0, max(1, len(text) - s), s)
        top = np.stack([np.maximum(z[a : a + 2 * s].max(axis=0) + m.shift, 0) for a in starts])
        want = np.concatenate([top.max(axis=0), top.mean(axis=0)]) @ m.out + m.bias
        assert got == pytest.approx(float(qualitynet.sigmoid(want)[0]), abs=1e-4)


def test_gradients_equal_differences():
    texts, y = [b"some words here", b"### more ###" * 60, b""], np.array([1, 0, 1], np.float32)
    m = qualitynet.blank()
    for name in ("bytes_", "filters", "shift", "out", "bias"):
        setattr(m, name, getattr(m, name).astype(np.float64))
    weight = np.array([0.7, 1.5, 0.7])

    def loss():
        p = qualitynet.Scorer(m).score(texts)
        return float((weight * -(y * np.log(p) + (1 - y) * np.log(1 - p))).mean())

    r = np.random.default_rng(1)
    for value, g in zip(m.values(), qualitynet.Trainer(m).gradients(texts, y, weight)):
        for at in r.choice(np.flatnonzero(g.ravel()), 4) if g.any() else []:
            place = np.unravel_index(at, value.shape)
            kept = value[place]
            sides = []
            for step in (1e-3, -1e-3):
                value[place] = kept + step
                sides.append(loss())
            value[place] = kept
            assert (sides[0] - sides[1]) / 2e-3 == pytest.approx(g[place], rel=0.05, abs=2e-4)


def test_quality_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    held = common.fold(F.col("doc_id"), 3) == 1
    model = qualitynet.learn(docs.filter(~held), labels.filter(~held))
    scored, names = qualitynet.score(docs.filter(held), model)
    rows = scored.join(labels, "doc_id").collect()
    for k in (0, 1):
        mine = [r for r in rows if r.quality == k]
        assert sum(r[names["predicted"]] == k for r in mine) / len(mine) >= 0.9
    assert all(0 <= r[names["score"]] <= 1 for r in rows)


def test_quality_odd_rows(odd, empty, odd_labels):
    model = qualitynet.learn(odd, odd_labels, per_class=10)
    assert model.constant is None
    out, names = qualitynet.score(odd, model)
    assert names["score"] == "score_" and out.columns[: len(odd.columns)] == odd.columns
    rows = out.collect()
    assert len(rows) == odd.count() and all(0 <= r[names["score"]] <= 1 for r in rows)
    same = {}
    for r in rows:
        assert same.setdefault(r.text or "", r[names["score"]]) == pytest.approx(r[names["score"]], abs=1e-6)
        assert r[names["predicted"]] == int(r[names["score"]] >= 0.5)
    assert qualitynet.score(empty, model)[0].count() == 0
    none = qualitynet.learn(odd, odd_labels.filter("false"))
    assert {r[names["score"]] for r in qualitynet.score(odd, none)[0].collect()} == {0.0}
    dotted = odd.withColumnRenamed("source", "so.urce")
    assert qualitynet.score(dotted, none)[0].columns[:7] == dotted.columns


def test_quality_sample_is_bounded_by_rows(spark):
    """One id with many rows, and many ids: no more than one row an id and `per_class` a class."""
    docs = spark.range(4000).select(F.when(F.col("id") < 3000, 1).otherwise(F.col("id")).alias("doc_id"), F.col("id").cast("string").alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    rows = qualitynet.sample(docs, labels, 100).collect()
    assert len(rows) <= 200 and len({r.doc_id for r in rows}) == len(rows)
