"""Text operators against plain versions, round trips and held-out accuracy.

`odd` is a small table with null, empty and very long texts, ties, repeated rows, null ids and extra
columns whose names clash with those the operators add.
"""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fundweave.sources import workspace
from fundweave.llm import (
    bytebpe,
    chat,
    common,
    components,
    exact,
    language,
    licenses,
    packing,
    quality,
    simhash,
    tokenfile,
    toxicity,
)

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, kept string"


def rows_of_odd():
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdeio") for _ in range(r.randint(2, 6)))
    base = [" ".join(word() for _ in range(r.randint(1, 120))) for _ in range(40)]
    texts = [None, "", " \n\t ", "one", "one", "a b", "a b c", *base]
    texts += [base[0], base[0] + " ", base[0].replace(" ", "  "), base[1].upper(), "x y z " * 9000]
    texts += ["line one\nline one\n\nline two", "\x1c \x85   odd blanks", "é́ Ünïcode \U0001f600"]
    out = [(i, t, "en", "s", 1, "mine", "mine") for i, t in enumerate(texts)]
    out += [out[10], out[10], (None, base[2], None, None, None, None, None), (None, None, None, None, None, None, None)]
    return out


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(rows_of_odd(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SMALL}/labels.parquet")


# ---------------------------------------------------------------- chat


def turns(spark, rows):
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, valid string")


def test_chat_round_trip_and_machine(spark):
    bad = ["\\### Assistant: </turn> ok", "####<</turn></turn>\n### user: ", "\\\\b\\l\\h", "", None, "plain"]
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", t, "x") for i, t in enumerate(bad)]
    rows += [(2, 0, "assistant", "early", "x"), (2, 1, "user", "late", "x")]
    rows += [(3, 0, "we:ird\\role</turn>", "a", "x"), (None, None, None, None, None), (4, 0, "system", "s", "x")]
    rows += [(5, 0, "user", "b", "x"), (5, 0, "user", "a", "x"), (5, 0, "user", "a", "x")]
    out = chat.formatted(turns(spark, rows))
    got = {
        r.conv_id: r
        for r in out.select(
            "*", chat.read_turns(F.col("formatted")).alias("t"), chat.loss_text(F.col("segments")).alias("l")
        ).collect()
    }
    assert [(t.role, t.text) for t in got[1].t] == [(r[2], r[3] or "") for r in rows[:6]]
    assert got[1].l == "".join(r[3] or "" for r in rows[:6] if r[2] == "assistant")
    assert "".join(s.text for s in got[1].segments) == got[1].formatted
    assert got[1].valid and got[1].complete
    assert not got[2].valid and got[2].bad_turn == 0 and got[2].state == chat.ERROR
    assert got[3].t[0].role == "we:ird\\role</turn>"
    assert got[None].t[0].asDict() == {"role": "", "text": ""}
    assert got[4].valid and not got[4].complete
    assert [t.text for t in got[5].t] == ["a", "a", "b"] and got[5].bad_turn == 1
    assert chat.formatted(turns(spark, [])).count() == 0


CHATML = chat.Template(header="<|im|>", colon="\n", end="<|end|>\n")
LETTERS = chat.Template(header="[b]", colon="=c", end="l/")


@pytest.mark.parametrize("template", [chat.DEFAULT, CHATML, LETTERS])
def test_chat_round_trip_with_any_template(spark, template):
    marks = [template.header, template.colon, template.end, template.header.strip(), template.end.strip()]
    r = random.Random(4)
    pieces = [*marks, "\\", "\\b", "\\l", "\\h", "x", "\n", "#", "<", "|", "b", "l", "/", "=", ":", ""]
    texts = ["".join(r.choice(pieces) for _ in range(r.randint(0, 9))) for _ in range(150)]
    roles = ["user", "assistant", "b" + template.colon + "x", "\\c" + template.end, ":", ""]
    rows = [(i // 3, i, r.choice(roles), t, "x") for i, t in enumerate(texts)]
    out = chat.formatted(turns(spark, rows), template)
    back = out.select(
        "conv_id", "segments",
        chat.read_turns(F.col("formatted"), template).alias("t"),
        chat.loss_text(F.col("segments"), template).alias("l"),
    ).collect()
    for r in back:
        mine = [x for x in rows if x[0] == r.conv_id]
        assert [(t.role, t.text) for t in r.t] == [(x[2], x[3]) for x in mine]
        assert r.l == "".join(x[3] for x in mine if x[2] == "assistant")
        for s in r.segments[1::3]:
            assert template.end.strip() not in s.text and template.header.strip() not in s.text


@pytest.mark.parametrize("marks", [{"end": "aXa"}, {"end": "  "}, {"header": "\\h"}, {"colon": ""}])
def test_chat_refuses_templates_that_cannot_be_read_back(marks):
    with pytest.raises(ValueError):
        chat.Template(**marks)


# ---------------------------------------------------------------- packing


@settings(max_examples=60, deadline=None, derandomize=True)
@given(st.lists(st.integers(0, 64), max_size=80))
def test_joint_packing_is_never_dearer(sizes):
    sizes = sorted(sizes, reverse=True)
    lengths = (16, 32, 64)
    bins, shrunk = packing.pack_jointly(sizes, lengths)
    filled = Counter()
    for b, s in zip(bins, sizes):
        filled[b] += s
    assert all(filled[b] <= length for b, length in enumerate(shrunk)) and len(bins) == len(sizes)
    assert sum(map(packing.cost, shrunk)) <= sum(map(packing.cost, packing.pack(sizes, lengths)[1])) + 1e-9


def test_joint_packing_opens_long_and_short_bins():
    """Some mix of sizes where bins of two lengths, side by side, beat every single opening length."""
    r, lengths, gained = random.Random(2), (16, 32, 64), 0
    for _ in range(300):
        sizes = sorted((r.choice((3, 9, 11, 17, 25, 40)) for _ in range(12)), reverse=True)
        joint, one = (sum(map(packing.cost, p(sizes, lengths)[1])) for p in (packing.pack_jointly, packing.pack))
        gained += joint < one - 1e-9
    assert gained > 0


def test_packing_groups_follow_chunks(spark):
    """Few rows with long texts make many groups."""
    got = packing.packed(spark.range(10).select(F.col("id").alias("doc_id")), F.lit(64_000), lengths=(16, 64), group=500)
    assert got.count() == 10_000
    assert len({r.bin_id.split("-")[0] for r in got.select("bin_id").collect()}) >= 15


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 64), max_size=80))
def test_packing_fits_and_shrinks(sizes):
    sizes = sorted(sizes, reverse=True)
    lengths = (16, 32, 64)
    bins, shrunk = packing.pack(sizes, lengths)
    filled = Counter()
    for b, s in zip(bins, sizes):
        filled[b] += s
    assert len(bins) == len(sizes)
    for b, length in enumerate(shrunk):
        assert filled[b] <= length
        assert length == min(c for c in lengths if c >= filled[b])
    one_size = [packing.best_fit(sizes, lengths, c)[1] for c in lengths]
    costs = [sum(packing.cost(packing.fitting(lengths, f)) for f in filled) for filled in one_size]
    assert sum(map(packing.cost, shrunk)) == pytest.approx(min(costs))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=40))
def test_best_fit_equals_the_plain_rule(sizes):
    sizes = sorted(sizes, reverse=True)
    room: list[int] = []
    for s in sizes:
        fits = [r for r in room if r >= s]
        if fits:
            room[room.index(min(fits))] -= s
        else:
            room.append(32 - s)
    filled = packing.best_fit(sizes, (32,), 32)[1]
    assert sorted(filled) == sorted(32 - r for r in room)


def test_packing_covers_every_row(spark, odd, empty):
    n = F.size(common.words(F.col("text")))
    lengths = (8, 16, 64)
    got = packing.packed(odd, n, lengths=lengths, group=20).collect()
    want = Counter()
    for r in odd.select("doc_id", n.alias("n")).collect():
        for c in range(max(1, -(-r.n // 64))):
            want[(r.doc_id, c, c * 64, min(64, r.n - c * 64))] += 1
    assert Counter((r.doc_id, r.chunk, r.start, r.length) for r in got) == want
    assert len({(r.doc_id, r.copy, r.chunk, r.start, r.length) for r in got}) == len(got)
    for _, rows in itertools.groupby(sorted(got, key=lambda r: (r.bin_id, r.position, r.length)), lambda r: r.bin_id):
        at = 0
        for r in rows:
            assert r.position == at and r.bin_length in lengths
            at += r.length
        assert at <= r.bin_length
    assert packing.packed(empty, n).count() == 0


def test_packing_splits_many_copies(spark):
    df = spark.range(2500).select(F.lit(7).cast("long").alias("doc_id"))
    got = packing.packed(df, F.lit(100), lengths=(512,), group=500).collect()
    assert sorted(r.copy for r in got) == list(range(2500))
    assert len({r.bin_id.split("-")[0] for r in got}) > 1


def test_packing_counts_token_ids(spark, odd, empty):
    from tokenizers import Tokenizer

    from fundweave.llm import queries

    path = public_tokenizers.path("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    count = lambda text: len(plain.encode(text or "", add_special_tokens=False).ids) + 1
    got = Counter((r.doc_id, r.n_ids) for r in tokenfile.sizes(odd, path).collect())
    assert got == Counter((r.doc_id, count(r.text)) for r in odd.collect())
    assert tokenfile.sizes(empty, path).count() == 0
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    total = Counter()
    for r in queries.op2_best_fit_packing(spark, SMALL).collect():
        total[r.doc_id] += r.length
    assert total == {i: count(text) for i, text in docs.items()}


# ---------------------------------------------------------------- toxicity


def test_toxicity_held_out(spark):
    big = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{big}/{t}.parquet") for t in ("documents", "labels"))
    held = common.fold(F.col("doc_id"), 5) == 0
    model = toxicity.learn(docs.filter(~held), labels.filter(~held))
    scored, names = toxicity.score(docs.filter(held), model)
    rows = scored.join(labels, "doc_id").collect()
    right = sum(r[names["predicted"]] == r.toxic for r in rows)
    assert right / len(rows) >= 0.9
    assert all(0 <= r[names["score"]] <= 1 for r in rows)


def test_toxicity_scorer_equals_plain_forward(docs):
    texts = [r.text for r in docs.limit(30).collect()] + [None, "", "one", "two words"]
    model = toxicity.train(texts, [i % 2 for i in range(len(texts))], epochs=1)
    fast = toxicity.Scorer(model).score(texts)
    for text, score in zip(texts, fast):
        words = np.asarray([toxicity.features(w) for w in toxicity.tokens(text)] or [(0, 0, 0, 0)])
        x = np.concatenate([toxicity.embed(model, words), np.zeros((2, toxicity.WIDTH))])
        top = []
        for k, f, shift in zip(toxicity.SPANS, model.filters, model.shifts):
            z = [sum(x[i + j] @ f[j] for j in range(k)) for i in range(len(words))]
            top.append(np.maximum(np.max(z, axis=0) + shift, 0))
        assert score == pytest.approx(toxicity.sigmoid(np.concatenate(top) @ model.out + model.bias), abs=1e-4)


def test_toxicity_odd_rows_with_a_trained_model(spark, odd, docs, labels):
    model = toxicity.learn(docs.unionByName(docs), labels)
    assert model.constant is None
    out, names = toxicity.score(odd, model)
    rows = out.collect()
    assert len(rows) == odd.count() and out.columns[: len(odd.columns)] == odd.columns
    same = {}
    for r in rows:
        s = r[names["score"]]
        assert 0 <= s <= 1 and r[names["predicted"]] == int(s >= 0.5) and r[names["flagged"]] == (s >= r[names["threshold"]])
        assert same.setdefault(" ".join(toxicity.tokens(r.text)), s) == pytest.approx(s, abs=1e-6)


def test_toxicity_learns_from_every_labelled_row(spark):
    """Two common words, two in the rows that come last by a hash of their id, two in texts of over
    20,000 characters: the embedding of each is trained, though no class has fewer than 2,000 short texts."""
    last = F.row_number().over(Window.partitionBy(F.col("doc_id") % 2).orderBy(F.xxhash64("doc_id"))) > 2200
    toxic = F.col("doc_id") % 2 == 1
    few = F.when(toxic, "frzzt").otherwise("bloomy")
    rare = F.when(toxic, "glimpz").otherwise("kindly")
    text = F.when(F.col("doc_id") < 40, F.repeat(F.when(toxic, "zorgle ").otherwise("softly "), 3001)).when(last, rare)
    docs = spark.range(4600).withColumnRenamed("id", "doc_id").withColumn("lang", F.lit("en"))
    docs = docs.withColumn("text", text.otherwise(few))
    model = toxicity.learn(docs, docs.select("doc_id", toxic.cast("int").alias("toxic")))
    fresh = toxicity.blank().table
    for word in ("frzzt", "bloomy", "glimpz", "kindly", "zorgle", "softly"):
        at = toxicity.features(word)[0]
        assert (model.table[at] != fresh[at]).any(), word
    marks = toxicity.Scorer(model).score(["frzzt", "glimpz", "zorgle", "bloomy", "kindly", "softly"])
    assert (marks[:3] > 0.5).all() and (marks[3:] < 0.5).all()


def test_toxicity_packs_hold_every_labelled_row_whatever_the_tasks(spark, odd, docs, labels):
    plenty = docs.select("doc_id", "lang", "text").unionByName(odd.select("doc_id", "lang", "text"))
    marks = labels.unionByName(labels.withColumn("toxic", F.lit(0))).unionByName(
        odd.select("doc_id", F.lit(0).alias("quality"), F.lit(1).alias("toxic"))
    )
    known = {r.doc_id: r.t for r in marks.groupBy("doc_id").agg(F.max("toxic").alias("t")).collect() if r.doc_id is not None}
    found = {}
    for parts in (2, 7):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        packs = toxicity.packed(plenty.repartition(parts), marks, 5).collect()
        found[parts] = sorted((r.shard, r.part, r.held, *[bytes(r[b]) for b in toxicity.BLOBS], r.langs) for r in packs)
    spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert found[2] == found[7]
    want = Counter((len(toxicity.tokens(r.text)), float(known[r.doc_id])) for r in plenty.collect() if r.doc_id in known)
    got = Counter()
    for r in packs:
        lengths, toxic = np.frombuffer(r.lengths, np.int32), np.frombuffer(r.labels, np.float32)
        got.update(zip(lengths.tolist(), toxic.tolist()))
        assert len(lengths) == len(r.langs) == r.docs and toxic.sum() == r.ones
    assert got == want


def test_toxicity_rounds_average_the_packs(spark, docs, labels):
    packs = toxicity.packed(docs.select("doc_id", "lang", "text"), labels, 3).filter("NOT held").cache()
    start = toxicity.opening(3, (0.6, 3.0))
    got = start
    want, total, n = start, {}, Counter()
    for r in packs.collect():
        blobs = pa.RecordBatch.from_pylist([{b: bytes(r[b]) for b in toxicity.BLOBS}])
        ((_, p),) = toxicity.unpacked(blobs)
        keys, steps = toxicity.advance(start, p, np.random.default_rng([3, 0, r.shard, r.part]))
        assert len(set(keys.tolist())) == len(keys)
        for k, x in zip(keys.tolist(), steps.astype(object)):
            total[k] = total.get(k, 0) + x
            n[k] += 1
    assert max(n.values()) == packs.count() == 3 and min(n.values()) == 1
    keys = np.array(sorted(total))
    want = toxicity.averaged(start, keys, np.array([total[k] / n[k] for k in keys.tolist()], float) / toxicity.UNIT)
    got = toxicity.one_round(packs, start, 0)
    for name in ("rows", "values", "past", "dense", "dense_past"):
        assert np.allclose(getattr(got, name), getattr(want, name), atol=1e-7), name
    assert (got.rows > 0).all() and not np.allclose(got.dense, start.dense)
    model = toxicity.closing(got)
    scored = toxicity.rated(packs, got).collect()
    one = docs.join(labels, "doc_id").filter(F.pmod(F.xxhash64("doc_id", F.lit("held")), F.lit(5)) != 0).collect()
    plain = toxicity.Scorer(model).score([r.text for r in one])
    assert np.allclose(sorted(r.score for r in scored), sorted(plain), atol=1e-5)
    packs.unpersist()


def test_toxicity_blocks_of_places_give_the_same_peaks(docs, monkeypatch):
    texts = [toxicity.tokens(r.text) for r in docs.limit(20).collect()] + [[], ["one"], ["a"] * 300]
    p = toxicity.pack(texts, [i % 2 for i in range(len(texts))])
    state = toxicity.opening(3)
    steps, some = toxicity.Steps(p, state.local(p.rows)[0], state.dense), np.arange(len(texts))
    top = steps.forward(some)
    where = steps.where
    for block in (1, 7, 64):
        monkeypatch.setattr(toxicity, "PLACES", block)
        assert np.allclose(steps.forward(some), top, atol=1e-6)
        # Equal responses, such as those of repeated words, may be found at another of their places.
        assert (steps.where == where).mean() > 0.99


def test_toxicity_cuts_equal_plain_ones(spark):
    r = random.Random(3)
    rows = [(r.choice(["en", "de", None]), r.randint(0, 60) / 60, float(r.random() < 0.4)) for _ in range(900)]
    rows += [("fr", 0.5, 0.0), ("fr", 0.7, 0.0), ("es", 0.25, 1.0), ("es", 0.125, 0.0), ("it", 0.5, 1.0), ("it", 0.75, 0.0)]
    got = toxicity.cuts(spark.createDataFrame(rows, "lang string, score double, toxic float"))
    plain = lambda some: toxicity.best_cut(np.array([x[1] for x in some]), np.array([x[2] for x in some]))
    assert set(got) == {None, "en", "de", "es", "it"}
    assert got.pop(None) == pytest.approx(plain(rows))
    for lang, cut in got.items():
        assert cut == pytest.approx(plain([x for x in rows if x[0] == lang])), lang
    assert toxicity.cuts(spark.createDataFrame([], "lang string, score double, toxic float")) == {}


def test_toxicity_odd_rows(odd, empty, labels):
    none = toxicity.learn(odd, labels.filter("false"))
    out, names = toxicity.score(odd, none)
    assert [r[names["score"]] for r in out.collect()] == [0.0] * odd.count()
    assert names["score"] == "score_" and out.columns[: len(odd.columns)] == odd.columns
    assert toxicity.score(empty, none)[0].count() == 0
    assert toxicity.best_cut(np.array([0.9, 0.8, 0.1]), np.array([1, 1, 0])) == pytest.approx(0.45)


# ---------------------------------------------------------------- tokenizers

MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORD = public_tokenizers.path("word_bpe_49k.json")
ALPHABET = "aAzZéÉñßÀ'’.,!<|endoftext|>019  \n\t\r ́İςﬁ中\U0001f600\x1c\x85-_#$"


@settings(max_examples=300, deadline=None)
@given(st.text(ALPHABET, max_size=40))
def test_byte_bpe_equals_the_rank_format(text):
    import tiktoken

    codec = bytebpe.codec(MULTI, public_tokenizers.PATTERN)
    plain = _plain(tiktoken)
    ids = codec.encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == plain.encode_ordinary(text)
    assert codec.decode(ids) == text.encode()


_ENCODING = []


def _plain(tiktoken):
    if not _ENCODING:
        ranks = bytebpe.read_ranks(MULTI)
        _ENCODING.append(
            tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        )
    return _ENCODING[0]


def test_byte_bpe_table(odd, empty):
    encoded, ids = bytebpe.encode(odd, MULTI, public_tokenizers.PATTERN, keep_text=True)
    back, raw = bytebpe.decode(encoded, MULTI, public_tokenizers.PATTERN, ids)
    for r in back.collect():
        assert bytes(r[raw]).decode() == (r.text or "")
    assert bytebpe.encode(empty, MULTI, public_tokenizers.PATTERN)[0].count() == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(ALPHABET, max_size=40), min_size=1, max_size=4))
def test_word_ids_equal_the_library(texts):
    encoder = tokenfile.word_encoder(WORD)
    ids, sizes = encoder.encode(pa.array(texts))
    ends = np.cumsum(sizes)
    for text, a, b in zip(texts, ends - sizes, ends):
        assert ids[a:b].tolist() == encoder.full.encode(text, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 400), st.integers(0, 5))
def test_index_is_minimal_and_perfect(n, seed):
    keys = [tokenfile.key_of(i * 7 + seed, i % 3) for i in range(n)]
    index = tokenfile.Index.build(keys, np.arange(n) * 3, np.arange(n), 2)
    again = tokenfile.Index.from_bytes(index.to_bytes())
    slots = again.slots(keys)
    assert sorted(slots.tolist()) == list(range(n))
    assert again.offsets[slots].tolist() == [3 * i for i in range(n)]
    foreign = again.slots([b"other%d" % i for i in range(500)])
    assert (foreign >= 0).sum() <= 1


def test_token_files_read_back(spark, odd, empty):
    folder = tokenfile.folder_for(spark)
    ledger = tokenfile.write(odd, folder, WORD, end_id=2)
    back = tokenfile.read(ledger, folder, lambda ids: (ids.astype("<u4").tobytes(),), "raw binary").collect()
    rows = odd.collect()
    model = tokenfile.word_encoder(WORD).full
    want = Counter(
        (r.doc_id, tuple([*model.encode(r.text or "", add_special_tokens=False).ids, 2])) for r in rows
    )
    assert Counter((r.doc_id, tuple(np.frombuffer(r.raw, "<u4").tolist())) for r in back) == want
    at = 0
    for r in sorted(back, key=lambda r: r.start):
        assert r.start == at
        at += r.n_ids
    ids = [r.doc_id for r in sorted(back, key=lambda r: r.start)]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    none = tokenfile.write(empty, tokenfile.folder_for(spark), WORD, end_id=2)
    assert tokenfile.read(none, folder, lambda ids: (b"",), "raw binary").count() == 0


def test_token_files_tell_no_id_from_any_id(spark):
    rows = [(None, "one two"), ("None", "three"), ("", "four"), ("-", "five"), ("None", "six seven eight")]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    folder = tokenfile.folder_for(spark)
    back = tokenfile.read(tokenfile.write(df, folder, WORD, end_id=2), folder, lambda ids: (ids.astype("<u4").tobytes(),), "raw binary")
    model = tokenfile.word_encoder(WORD).full
    want = Counter((i, tuple([*model.encode(t, add_special_tokens=False).ids, 2])) for i, t in rows)
    assert Counter((r.doc_id, tuple(np.frombuffer(r.raw, "<u4").tolist())) for r in back.collect()) == want


def test_token_files_go_to_the_cluster_default_store(spark):
    """A folder without a scheme is the default store's, as Spark reads it."""
    assert tokenfile.qualified(spark, "/shared/x").startswith("file:/")
    assert tokenfile.qualified(spark, "hdfs://h:1/x") == "hdfs://h:1/x"


# ---------------------------------------------------------------- quality


def plain_counts(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = list(zip(w, w[1:], w[2:]))
    times = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if times[x] > 1 for k in range(3)}
    n, rep = len(w), len(covered)
    return (
        n,
        sum(map(len, w)),
        sum(c in "#*$%&|<>" for c in text or ""),
        len(lines) - len(set(lines)),
        rep,
        n < 50 or 100 * rep > 50 * n,
    )


@pytest.mark.parametrize("which", ["odd", "docs"])
def test_quality_equals_plain(spark, request, labels, which):
    df = request.getfixturevalue(which)
    size, good = 1 << 10, {r.doc_id for r in quality.trusted_ids(labels).collect()}
    model = quality.fit(df, quality.trusted_ids(labels), size=size)
    rows = df.collect()

    def h(*x):
        out = 42
        for part in x:
            data = part.encode() if isinstance(part, str) else part.to_bytes(8, "little")
            out = xxhash.xxh64_intdigest(data, out)
        return out

    def grams(text):
        w = [h(x) for x in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
        return [x & size - 1 for x in w] + [h(a, b) & size - 1 for a, b in zip(w, w[1:])]

    raw, target = Counter(), Counter()
    for r in rows:
        raw.update(grams(r.text))
        if r.doc_id in good:
            target.update(grams(r.text))
    weights = [int(x) for x in model.split(",")]
    if target:
        t, s = sum(target.values()) + size, sum(raw.values()) + size
        for b, w in enumerate(weights):
            exact_ = 1000 * (np.log((target[b] + 1) / t) - np.log((raw[b] + 1) / s))
            assert abs(w - exact_) <= 0.5001
    else:
        assert set(weights) == {0}
    rated, names = quality.rate(df, model, size=size)
    for r in rated.collect():
        assert tuple(r[names[c]] for c in quality.COUNTS) == plain_counts(r.text)
        g = grams(r.text)
        score = sum(weights[x] for x in g) // max(1, len(g))
        assert r[names["score"]] == score
        assert r[names["kept"]] == (not r[names["base_failed"]] and score >= quality.THRESHOLD)


def test_quality_counts_every_trusted_document(spark):
    """More trusted documents than any sample: half of all texts, and nothing but `good` in them."""
    n, size = 50_000, 1 << 10
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "good").otherwise("bad").alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 2 == 0).cast("int").alias("quality"))
    assert quality.trusted_ids(labels.union(labels)).count() == n // 2
    b = docs.limit(1).select(quality.buckets(quality.hashes(F.array(F.lit("good"))), (1,), size)[0]).first()[0]
    want = 1000 * (np.log((n / 2 + 1) / (n / 2 + size)) - np.log((n / 2 + 1) / (n + size)))
    got = int(quality.fit(docs, quality.trusted_ids(labels), size=size).split(",")[b])
    assert abs(got - want) <= 0.5001


def test_quality_filter_and_empty(empty, docs, labels):
    kept = quality.good_documents(docs, labels)
    assert kept.columns == docs.columns
    rated, names = quality.rules(docs, labels)
    want = {r.doc_id for r in rated.collect() if r[names["kept"]]}
    assert {r.doc_id for r in kept.collect()} == want
    assert quality.good_documents(empty, labels).count() == 0


# ---------------------------------------------------------------- licences


def test_licenses(spark, odd, empty, docs):
    model = licenses.learn(docs)
    lines = {
        "Released under the MIT License.": "mit",
        "Licensed under CC BY-NC 4.0.": "cc-by-nc",
        "Licensed under the Apache License, Version 2.0.": "apache-2.0",
        "This work is licensed under the GNU General Public License, version 3.": "gpl",
        "Licensed under the Walnut Meadow Private License, edition 12.": None,
        "The driver had to renew his license at the public office.": None,
    }
    rows = [(i, f"some words before\n{x}\nand after it") for i, x in enumerate(lines)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r for r in licenses.scan(df, model, spans=True).collect()}
    for i, (line, family) in enumerate(lines.items()):
        assert got[i].license == family, line
        assert got[i].n_paragraphs == 3
        for s in got[i].spans:
            assert rows[i][1][s.start : s.end] == line
    # Accuracy on the corpus's own notices, and silence elsewhere.
    found = licenses.scan(docs, model).collect()
    truth = {
        r.doc_id: {f for x, f in lines.items() if f and x in r.text} for r in docs.collect()
    }
    named = {"mit", "cc-by-nc", "apache-2.0", "gpl"}
    assert all(truth[r.doc_id] == set(r.families.split("|")) & named for r in found)
    out = licenses.scan(odd, model).collect()
    assert len(out) == odd.count() and {r.n_paragraphs for r in out if r.doc_id in (0, 1, 2)} == {0}
    assert licenses.scan(empty, licenses.learn(empty, lines=5)).count() == 0


def test_licenses_in_few_words_and_unlisted_ones(docs):
    model = licenses.learn(docs)
    listed = {
        "MIT License": "mit",
        "License: MIT": "mit",
        "// SPDX-License-Identifier: MIT": "mit",
        "Apache License 2.0": "apache-2.0",
        "GNU GPL v3": "gpl",
        "License: GPL-3.0": "gpl",
        "CC BY-NC 4.0": "cc-by-nc",
    }
    unlisted = [*licenses.OTHERS, "SPDX-License-Identifier: ISC", "License: WTFPL", "Walnut Public License", "Apache License 1.1"]
    scanner = licenses.Scanner(model)
    kinds = lambda lines: [[f[3] for f in found] for _, found in scanner.scan(lines)]
    assert kinds(list(listed)) == [[f] for f in listed.values()]
    assert kinds(unlisted) == [["unknown"]] * len(unlisted)
    assert kinds(list(licenses.PLAIN)) == [[]] * len(licenses.PLAIN)
    df = docs.sparkSession.createDataFrame([(i, x) for i, x in enumerate(unlisted)], "doc_id bigint, text string")
    assert {(r.n_license, r.n_unknown) for r in licenses.scan(df, model).collect()} == {(0, 1)}


# Paragraphs as they stand in files, none of them calibrated on.
WRAPPED_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:"""
WRAPPED_GPL = """This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details."""
WRAPPED_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""
FOUND = {
    WRAPPED_MIT: "mit",
    "The above copyright notice and this permission notice shall be included in all\ncopies or substantial portions of the Software.": "mit",
    WRAPPED_WARRANTY: "mit",
    "Neither the name of the University nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.": "bsd",
    WRAPPED_GPL: "gpl",
    "Licensed under the Eclipse Public License, version 2.0.": "unknown",
    "Distributed under the Boost Software License, Version 1.0.": "unknown",
    "The driver lost his license after the accident.": None,
    "He needs a license to sell fish in the old harbour.": None,
    "10.2": None,
}


def test_licence_paragraphs_as_they_stand_in_files(docs):
    scanner = licenses.Scanner(licenses.learn(docs))
    for text, family in FOUND.items():
        before = "A line before.\n\n"
        ((n, found),) = scanner.scan([before + text + "\n\nA line after."])
        assert n == 3
        assert [f[3] for f in found] == ([family] if family else []), text
        assert all((before + text)[f[1] : f[2]] == text for f in found)


def test_licence_paragraphs_of_wrapped_lines():
    long = "w" * 60
    cases = {
        None: [], "": [], " \n\t\n": [], "a\nb": ["a", "b"], f"{long}\nb\nc": [f"{long}\nb", "c"],
        f"{long}.\nb": [f"{long}.", "b"], f"{long}\n\nb": [long, "b"], f"{'w' * 200}\nb": ["w" * 200, "b"],
        f"x\n{long}\n{long}\n{long};\n\nb": ["x", f"{long}\n{long}\n{long};", "b"],
    }
    for text, want in cases.items():
        assert [(text or "")[a:b] for a, b in licenses.paragraphs(text)] == want


def test_licence_likeness_equals_plain(docs):
    """Weighted word pairs in common, of the lighter side's; pairs weigh 1 / families that have them."""
    scanner = licenses.Scanner(licenses.learn(docs.limit(50)))
    pair = lambda t: set(zip(licenses.words_of(t), licenses.words_of(t)[1:]))
    families = {f: set().union(*map(pair, lines)) for f, lines in licenses.NOTICES.items()}
    weigh = lambda pairs: sum(1 / max(1, sum(p in have for have in families.values())) for p in pairs)
    text = "You may redistribute it under the terms of the GNU General Public License as published by the Free Software Foundation in any form you like"
    for f, lines in licenses.NOTICES.items():
        want = max(weigh(pair(text) & pair(n)) / min(weigh(pair(text)), weigh(pair(n))) for n in lines if len(pair(n)) >= 3)
        assert scanner.similarity(text, f) == pytest.approx(want)


def test_licences_odd_rows(spark, odd):
    clash = odd.withColumnsRenamed({"score": "license", "kept": "n_unknown"}).withColumn("text", F.when(F.col("doc_id") == 4, F.lit("MIT License\n" + "word " * 60_000)).otherwise(F.col("text")))
    model = licenses.learn(clash.unionByName(clash))
    out = licenses.scan(clash, model)
    assert out.columns[-6:] == ["n_paragraphs", "n_license", "n_unknown_", "families", "license_", "probability"]
    assert [(r.license_, r.n_paragraphs) for r in out.filter("doc_id = 4").collect()] == [("mit", 2)]


# ---------------------------------------------------------------- exact duplicates


def plain_groups(rows):
    groups = {}
    for r in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", r.text or ""), []).append(r)
    return groups


@pytest.mark.parametrize("parts", [1, 13])
def test_exact_equals_plain(spark, odd, parts):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        got = exact.dedup(odd).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    groups = plain_groups(odd.collect())
    assert len(got) == sum(map(len, groups.values()))
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert set(kept.values()) == {1} and len(kept) == len(groups)
    by = {hashlib.sha256(k.encode()).hexdigest(): g for k, g in groups.items()}
    for r in got:
        g = by[r.text_sha256]
        best = min(g, key=lambda x: (-len(x.text or ""), x.doc_id is None, x.doc_id or 0))
        assert (r.keep_id, r.group_size) == (best.doc_id, len(g))


def test_exact_group_over_many_partitions(spark):
    df = spark.range(0, 4000, 1, 8).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 4 > 0, F.lit("same  text")).otherwise(F.col("id").cast("string")).alias("text")
    )
    got = exact.dedup(df)
    assert got.filter("kept").count() == 1001
    assert {(r.keep_id, r.group_size) for r in got.filter("group_size > 1").collect()} == {(1, 3000)}


def test_exact_keeps_whole_rows(odd, empty):
    kept = exact.distinct_documents(odd)
    assert kept.columns == odd.columns
    assert kept.count() == len(plain_groups(odd.collect()))
    assert exact.dedup(empty).count() == 0 and exact.distinct_documents(empty).count() == 0


# ---------------------------------------------------------------- SimHash


def plain_fingerprint(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    grams = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs)) if hs else 0


def plain_components(points, radius=2):
    left, out = set(points), {}
    while left:
        todo = [left.pop()]
        mine = set(todo)
        while todo:
            x = todo.pop()
            near = {y for y in left if (x ^ y).bit_count() <= radius}
            left -= near
            mine |= near
            todo += near
        for x in mine:
            out[x] = min(mine)
    return out


def clouds(seed, n):
    r = random.Random(seed)
    points = []
    for _ in range(n // 20):
        x = r.getrandbits(64)
        for _ in range(20):
            points.append(x)
            for bit in r.sample(range(64), r.randint(1, 3)):
                x ^= 1 << bit
    return points


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@settings(max_examples=8, deadline=None)
@given(st.integers(0, 1000))
def test_tree_search_equals_plain(seed):
    points = sorted(set(clouds(seed, 600)))
    forest = simhash.search(np.asarray(points, np.uint64), np.ones(len(points), bool), 2)
    want = plain_components(points)
    first = {}
    for x, root in zip(points, forest.root.tolist()):
        assert first.setdefault(want[x], root) == root
    assert len(set(forest.root.tolist())) == len(set(want.values()))


@settings(max_examples=20, deadline=None)
@given(st.integers(0, 1000), st.integers(0, 9))
def test_routing_loses_no_pair(seed, levels):
    points = np.asarray(sorted(set(clouds(seed, 200))), np.uint64)
    blocks = simhash.vantage_blocks(levels)
    cuts = [m.bit_count() // 2 for m, _ in blocks]
    index, shard, home = simhash.route(points, blocks, cuts, 2)
    where = dict(zip(index[home].tolist(), shard[home].tolist()))
    asked = set(zip(index.tolist(), shard.tolist()))
    assert len(where) == len(points)
    for a in range(len(points)):
        for b in range(len(points)):
            if (int(points[a]) ^ int(points[b])).bit_count() <= 2:
                assert (a, where[b]) in asked


@pytest.mark.parametrize("shard,dense", [(8192, 1 << 20), (40, 1 << 20), (40, 60), (40, 0)])
def test_links_connect_what_they_should(spark, shard, dense):
    points = sorted(set(clouds(3, 800)))
    nodes = spark.createDataFrame([(signed(x),) for x in points], "fp bigint")
    edges = simhash.links(nodes, 2, shard, dense)
    root = {r.node: r.root for r in components.roots(edges).collect()}
    want = plain_components(points)
    sizes = Counter(want.values())
    got = {}
    for x in points:
        assert (signed(x) in root) == (sizes[want[x]] > 1)
        assert got.setdefault(want[x], root.get(signed(x), x)) == root.get(signed(x), x)


def ball(r, center, n):
    """n points at most 2 bits from the center: a cloud that no threshold splits well."""
    near = [center ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(a)]
    return r.sample(near, n)


@pytest.mark.parametrize("dense", [30, 400, 5000])
def test_crowded_shards_are_split_without_losing_a_link(spark, dense):
    """Loose clouds gain from further levels, balls do not and are dealt into cells."""
    r = random.Random(8)
    center = r.getrandbits(64)
    loose = [center ^ sum(1 << b for b in r.sample(range(64), 9)) for _ in range(700)]
    points = sorted({*loose, *ball(r, center ^ (0xFFFF << 20), 500), *clouds(5, 300)})
    nodes = spark.createDataFrame([(signed(x),) for x in points], "fp bigint")
    edges = simhash.links(nodes, 2, 200, dense)
    root = {r.node: r.root for r in components.roots(edges).collect()}
    want, got = plain_components(points), {}
    sizes = Counter(want.values())
    for x in points:
        assert (signed(x) in root) == (sizes[want[x]] > 1)
        assert got.setdefault(want[x], root.get(signed(x), x)) == root.get(signed(x), x)


def test_cells_bring_every_member_to_every_query(spark):
    rows = [(s, f, f % 3 > 0) for s, n in ((1, 40), (2, 3)) for f in range(100 * s, 100 * s + n)]
    dealt = spark.createDataFrame(rows, "shard bigint, fp bigint, home boolean")
    cells = {}
    for r in simhash.celled(dealt, 8).collect():
        cells.setdefault((r.shard, r.row, r.column), []).append((r.fp, r.home))
    met = {(s, x, q) for (s, _, _), c in cells.items() for x, home in c if home for q, _ in c}
    assert met >= {(s, x, q) for s, x, home in rows if home for t, q, _ in rows if s == t}
    assert all(len(c) == len({f for f, _ in c}) for c in cells.values())
    assert len(cells) > 10 and sum(s == 2 for s, _, _ in cells) == 1


def test_hubs_are_split(spark):
    """All pairs of a large star hang on one node: Spark must be able to split its side of the join."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "20",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        star = workspace.cut(spark.range(1, 300_000).select(F.col("id").alias("u"), F.lit(0).cast("bigint").alias("v")))
        found = components._stars(star.select(F.col("v").alias("u"), F.col("u").alias("v")))
        assert found.count() == 299_999
        found.write.format("noop").mode("overwrite").save()
        plan = found._jdf.queryExecution().executedPlan()
        found.collect()
        assert "skew=true" in plan.toString()
        assert {r.root for r in components.roots(star.select(F.col("u").alias("a"), F.col("v").alias("b"))).select("root").distinct().collect()} == {0}
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_simhash_equals_plain(spark, odd, empty, docs):
    for df in (odd, docs):
        rows = df.collect()
        fps = [plain_fingerprint(r.text) for r in rows]
        roots = plain_components(set(fps))
        least = {}
        for r, f in zip(rows, fps):
            if r.doc_id is not None:
                least[roots[f]] = min(least.get(roots[f], r.doc_id), r.doc_id)
        want = Counter((r.doc_id, format(f, "016x"), least.get(roots[f])) for r, f in zip(rows, fps))
        found = simhash.classes(df).select("doc_id", simhash.as_hex(F.col("fp")).alias("f"), "component_id")
        assert Counter(tuple(r) for r in found.collect()) == want
        kept = simhash.one_per_class(df)
        assert kept.columns == df.columns
        assert kept.count() == len(set(roots.values()))
    assert simhash.classes(empty).count() == 0 and simhash.one_per_class(empty).count() == 0


def test_components_of_a_long_chain(spark):
    edges = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r.root for r in components.roots(edges).collect()} == {0}
    assert components.roots(edges.filter("false")).count() == 0


# ---------------------------------------------------------------- language


def test_language_held_out(docs):
    held = common.fold(F.col("doc_id"), 3) == 1
    model = language.learn(docs.filter(~held))
    found, names = language.identify(docs.filter(held), model)
    rows = [r for r in found.collect() if len(r.text.split()) >= 50]
    assert sum(r[names["lang_pred"]] == r.lang for r in rows) / len(rows) >= 0.9
    assert sum(r[names["rejected"]] for r in rows) / len(rows) <= 0.05


def test_language_odd_rows(spark, odd, empty, docs):
    model = language.learn(docs)
    found, names = language.identify(odd, model)
    rows = found.collect()
    assert len(rows) == odd.count() and found.columns[: len(odd.columns)] == odd.columns
    for r in rows:
        none = not any(c.isalpha() for c in r.text or "")
        assert (r[names["lang_pred"]] == language.UNKNOWN) == none
        assert 0 <= r[names["score"]] <= 1 and (not none or r[names["rejected"]])
    assert language.learn(empty) == {}
    assert {r.lang_pred for r in language.identify(docs, {})[0].collect()} == {language.UNKNOWN}
    assert language.identify(empty, model)[0].count() == 0
    dotted = docs.withColumnRenamed("source", "so.urce")
    assert language.known_documents(dotted, docs).columns == dotted.columns


def test_language_letters_by_category():
    assert language.letters("हिन्दी भाषा ½ Ⅷ x²") == "हिन्दी भाषा x"
    assert language.letters("½ ²³ Ⅷ ① _ 12 ́ ्") == "" and language.letters(None) == ""
    assert language.letters("ÀB\u0301c-d’e") == "àb\u0301c d e"


def test_language_equals_plain(docs):
    """Sizes by one compressor for each text and language, with the dictionary's raw content."""
    import zstandard

    model = {k: v for k, v in sorted({"en": b"the and of to in that", "de": b"der die und das nicht", "fr": b"le la les et des"}.items())}
    compressors = language._compressors(tuple(model.items()))
    texts = [r.text for r in docs.limit(40).collect()] + ["the and of", "und das nicht", "zzz", "the", "½ ²", "हिन्दी", None]
    for text in texts:
        data = language.letters(text).encode()
        if not data:
            assert language.classify(text, compressors) == ("und", 0.0, 0.0)
            continue
        sizes = {}
        for lang, content in model.items():
            known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            one = lambda b: zstandard.ZstdCompressor(
                level=language.LEVEL, dict_data=known, write_checksum=False, write_content_size=False, write_dict_id=False
            ).compress(b)
            sizes[lang] = sum(len(one(data[i : i + language.BLOCK])) for i in range(0, len(data), language.BLOCK))
        (a, best), (b, second) = sorted(((n, lang) for lang, n in sizes.items()))[:2]
        assert language.classify(text, compressors) == (best, pytest.approx(b / (a + b)), pytest.approx(1 - a / b))


def test_language_samples_rows_and_uses_all_of_them(spark):
    rows = [(i % 50 if i < 300 else i, "en" if i % 2 else "de", f"wort{chr(97 + i % 26)}{chr(97 + i // 26 % 26)} " * 200) for i in range(600)]
    rows += [(1000 + i, "en", "½ 12") for i in range(50)] + [(5000, None, "text"), (None, "en", "text")]
    model = language.learn(spark.createDataFrame(rows, "doc_id bigint, lang string, text string"), per_language=60)
    assert sorted(model) == ["de", "en"]
    for content in model.values():
        assert len(content) <= language.DICTIONARY
        assert 50 <= len({w for w in content.decode().split() if len(w) == 6}) <= 60
    one = language.learn(spark.createDataFrame(rows[:1], "doc_id bigint, lang string, text string"))
    found, names = language.identify(spark.createDataFrame([("a",), ("½",)], "text string"), one)
    assert {(r[names["lang_pred"]], r[names["rejected"]]) for r in found.collect()} == {("de", False), ("und", True)}


# ---------------------------------------------------------------- samples and pipeline


def test_class_sample_is_the_first_by_hash(spark):
    df = spark.range(5000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 10 == 0, "b").otherwise("a").alias("k")
    )
    got = common.class_sample(df, "doc_id", "k", 37).collect()
    hashed = df.select("doc_id", "k", F.xxhash64("doc_id").alias("h")).collect()
    for k in "ab":
        want = sorted((r.h, r.doc_id) for r in hashed if r.k == k)[:37]
        assert {r.doc_id for r in got if r.k == k} == {d for _, d in want}


def test_pipeline_stage_by_stage(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "language_id", "exact_dedup", "simhash_dedup", "best_fit_packing"]
    for _, stage in corpus_pipeline.STAGES[:2]:
        docs = stage(spark, docs, SMALL).cache()
    rows = docs.collect()
    best = [
        min(g, key=lambda x: (-len(x.text), x.doc_id)) for g in plain_groups(rows).values()
    ]
    docs = corpus_pipeline.exact_dedup(spark, docs, SMALL).cache()
    assert {r.doc_id for r in docs.collect()} == {r.doc_id for r in best}
    fps = {r.doc_id: plain_fingerprint(r.text) for r in best}
    roots = plain_components(set(fps.values()))
    least = {}
    for d in sorted(fps):
        least.setdefault(roots[fps[d]], d)
    docs = corpus_pipeline.simhash_dedup(spark, docs, SMALL).cache()
    assert {r.doc_id for r in docs.collect()} == set(least.values())
    packed = corpus_pipeline.run(spark, SMALL).collect()
    words = Counter()
    for r in packed:
        words[r.doc_id] += r.length
    assert words == {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in docs.collect()}


def test_folds_are_crc32_of_the_id_as_text(spark):
    rows = spark.range(50).select("id", common.fold(F.col("id"), 5).alias("f")).collect()
    assert all(r.f == zlib.crc32(str(r.id).encode()) % 5 for r in rows)
