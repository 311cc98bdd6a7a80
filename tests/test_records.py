"""Raw records built from the driver's tables."""

from fundweave.workload import records


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def documents(spark, folder, data):
    rows = spark.createDataFrame(data, "doc_id long, text string")
    rows.write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def test_word_positions_of_odd_texts(spark, tmp_path):
    sf = documents(spark, tmp_path, [
        (1, "  b a\tb\n c a "), (2, None), (3, ""), (4, "x y"), (4, "y"), (5, " ".join(f"w{i % 400}" for i in range(1200)))])
    got = {r.doc_id: r.positions for r in records.word_positions(spark, sf).collect()}
    assert got == {
        1: {"a": [1, 4], "b": [0, 2], "c": [3]}, 3: {"": [0]}, 4: {"x": [0], "y": [0, 1]},
        5: {f"w{i}": [i, i + 400, i + 800] for i in range(400)},
    }


def test_words_are_placed_inside_their_row(spark, tmp_path):
    """No table of words: it was sorted by (document, word) and spilled many times the texts' size."""
    sf = documents(spark, tmp_path, [(1, "a b a")])
    assert "Generate" not in plan(records.word_positions(spark, sf))


def test_flatten_map_counts_documents_of_repeated_words(spark, tmp_path):
    sf = documents(spark, tmp_path, [(1, "a b a"), (2, "a"), (3, "b c"), (3, "c")])
    found = records.flatten_map(spark, sf)
    got = {r.word: (r.occurrences, r.docs, r.position_sum) for r in found.collect()}
    assert got == {"a": (3, 2, 2), "b": (2, 2, 1), "c": (2, 1, 1)}
    assert plan(found).count("Aggregate [word") == 1


def test_orders_are_dealt_out_before_records_are_made(spark):
    """As many tasks as the size asks for, and narrow rows: 12 tasks each read a twelfth of the wide records."""
    found = plan(records.raw_awards.__wrapped__(spark, "/root/testdata/sf0.001"))
    after = found[found.index("RebalancePartitions"):]
    assert "Repartition " not in found and "o_orderkey" in after and "funder_award_id" not in after


def test_positions_are_made_once_a_document(spark):
    """Records of a document share its positions, and documents that no record shows have none made."""
    found = plan(records.raw_works.__wrapped__(spark, "/root/testdata/sf0.001"))
    assert found.index("Generate inline(records") < found.index("map_from_entries")
    assert "exists(records" in found[found.index("map_from_entries"):]
