"""Decontamination, the pipeline and the registered queries."""

import os

import pytest

import __spark_entry__ as entry
from pulsegrid.llm import decontamination
from pulsegrid.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
ITEM = "Tom has 12 apples and he gives 5 kg of them to Mary Ann before the long walk home begins. How many does Tom have?"
NEW = "Jim has 30 apples and he gives 7 lb of them to Sue before the long walk home begins. How many does {} have?"


def test_templates(spark):
    docs = [(0, "Before. " + ITEM + " After that."), (1, "Everyone knows " + NEW.format("Jim")), (2, "So then " + NEW.format("Sue")),
            (3, "And Jim has 30 apples and he takes 7 lb of those from Sue"), (4, None), (5, ""), (None, ITEM), (0, ITEM),
            (6, "x " * 50_000 + ". " + ITEM.lower())]
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame([(1, ITEM), (2, "too short"), (3, None), (4, "Eight plain words are enough for an item")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["exact"] for r in decontamination.matches(rows, items).collect()}
    assert got[0, 1] and got[None, 1] and got[1, 1] is False and not {(2, 1), (3, 1), (4, 1), (5, 1)} & set(got)
    kept = {r["doc_id"] for r in decontamination.keep_uncontaminated(rows, items).collect()}
    assert {2, 3, 4, 5} <= kept and not kept & {0, 1, None}
    assert decontamination.matches(rows, items.limit(0)).count() == 0 and decontamination.matches(rows.limit(0), items).count() == 0


def test_join_without_shared_hashes_is_the_same(spark, monkeypatch):
    rows = spark.createDataFrame([(1, "Well. " + ITEM), (2, "other words")], "doc_id long, text string")
    items = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    want = decontamination.matches(rows, items).collect()
    monkeypatch.setattr(decontamination, "SHARED_HASHES", 0)
    assert decontamination.matches(rows, items).collect() == want


tables = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


@tables
@pytest.mark.parametrize("name", QUERIES)
def test_queries_give_a_row_a_document(spark, name):
    df = QUERIES[name](spark, SF)
    n = df.count()
    if name in ("op11_source_divergence", "op12_prefix_trie"):  # rows of groups and nodes: tested in files of their own
        assert n > 0
        return
    table, key = {"op1_embeddings": ("embeddings", "vec_id"), "op5_extraction": ("pages", "page_id")}.get(name, ("documents", "doc_id"))
    rows = spark.read.parquet(f"{SF}/{table}.parquet").count()
    if name == "op6_decontamination":
        assert df.columns[:2] == ["doc_id", "item_id"]
    else:
        assert df.select(key).distinct().count() == rows and (n == rows or name == "op4_packing")


@tables
def test_pipeline(spark):
    import corpus_pipeline

    assert len(corpus_pipeline.STAGES) == 5
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == columns
    kept = docs.count()
    assert 0 < kept < before
    packed = corpus_pipeline.run(spark, SF)
    assert packed.select("doc_id").distinct().count() == kept


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def found(spark, docs, items):
    rows = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    table = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {(r["doc_id"], r["item_id"]) for r in decontamination.matches(rows, table).collect()}


def test_one_edit_or_equal_numbers_lose_no_match(spark):
    passage = ("there were 5 boats on the wide river when the old man woke up and went down to the water to look for his lost "
               "dog and he saw that {} boats had already left the small harbour before the sun rose over the green hills")
    sums = "if there are {} red marbles in the first bag and {} blue marbles in the other bag then how many marbles are there"
    assert found(spark, [passage.format(6), sums.format(4, 4)], [passage.format(5), sums.format(3, 5)]) == {(0, 0), (1, 1)}


def test_case_and_first_words_of_sentences_hide_nothing(spark):
    names = "Tom met Ann and Bob told Sue that Max likes Eva and Jim"
    first = "Alice has 12 apples and gives some of them to her best friend. How many are left?"
    docs = [names.lower(), "so " + names.upper() + " ok", first.replace("Alice", "Bob").replace("12", "30"),
            'He asked, "' + first.replace("Alice", "Bob").replace("12", "30"), "Well, Bob has 30 apples and gives some of them to her best friend, how many are left"]
    assert found(spark, docs, [names, first]) == {(0, 0), (1, 0), (2, 1), (3, 1), (4, 1)}


def test_short_and_wordless_items_are_found(spark):
    items = ["What is the sum of 12 and 35?", "Name it", "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15", "Gone With The Wind And The Sea And The Sun And The Moon Again"]
    docs = ["x. " + items[0] + " y", "please name it now", "so " + items[2], "z " + items[3] + " w", "what is the sum of 12 and 36"]
    assert found(spark, docs, items) == {(0, 0), (1, 1), (2, 2), (3, 3)}
