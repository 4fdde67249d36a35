"""Language and toxicity: held-out accuracy, rows that are hard to learn from, and what must not enter a prediction."""

import random
import zlib

from pyspark.sql import functions as F

from tarifa.llm import language, toxicity
from tests.llm.tables import docs_of, needs_tables


def is_held_out(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 4 == 2


SYLLABLES = {"en": "the and ing er thou of wh", "de": "ung sch heit lich ein der äu", "fr": "eux que tion aire le ç ê", "es": "ción ado mente el os ñ ue"}


def word(chance, lang):
    return "".join(chance.choices(SYLLABLES[lang].split(), k=chance.randrange(1, 4)))


def labelled_texts(n, seed=1):
    chance = random.Random(seed)
    rows = []
    for i in range(n):
        lang = chance.choice(list(SYLLABLES))
        rows.append((i, " ".join(word(chance, lang) for _ in range(chance.randrange(5, 60))), lang))
    return rows


def test_languages(spark):
    rows = labelled_texts(600)
    extra = [(10_000, None, "en"), (10_001, "", "de"), (10_002, "123 !?", "fr"), (10_003, "ung " * 60_000, None), (None, "the and of thou", "en"), (7, rows[7][1], rows[7][2])]
    frame = spark.createDataFrame(rows + extra, "doc_id long, text string, lang string").selectExpr("*", "'x' AS lang_pred", "1 AS score", "2 AS rank")
    result = language.languages(frame).collect()
    assert len(result) == len(rows) + len(extra)
    lang = {i: x for i, _, x in rows}
    held = [r for r in result if r["held_out"] and r["doc_id"] in lang]
    assert len(held) > 100 and sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.97 * len(held)
    assert all(r["held_out"] == is_held_out(r["doc_id"]) and 0 <= r["score"] <= 1 for r in result)
    by = {r["doc_id"]: r for r in result}
    assert [by[10_000 + k]["lang_pred"] for k in range(4)] == ["und", "und", "und", "de"]
    assert [by[10_000 + k]["score"] for k in range(3)] == [0, 0, 0]


def test_language_of_held_out_rows_is_never_learnt(spark):
    rows = [(i, t, "xx" if is_held_out(i) else x) for i, t, x in labelled_texts(200)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r["lang_pred"] for r in language.languages(frame).collect()} <= set(SYLLABLES)


def test_languages_without_examples(spark):
    frame = spark.createDataFrame([(1, "some words", None)], "doc_id long, text string, lang string")
    assert [(r["lang_pred"], r["score"]) for r in language.languages(frame).collect()] == [("und", 0.0)]
    assert language.languages(frame.limit(0)).count() == 0


def toxic_texts(n):
    chance = random.Random(2)
    rows, labels = [], []
    for i, text, _ in labelled_texts(n, seed=4):
        bad = chance.random() < 0.2
        words = text.split()
        for _ in range(2 * bad):
            words.insert(chance.randrange(len(words)), chance.choice(["blaggard", "scoundrel", "nitwit"]) + chance.choice(["", "s", "ly"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return rows, labels


def test_toxicity(spark):
    rows, labels = toxic_texts(800)
    more = [(9000, None), (9001, ""), (9002, "of the " * 50_000 + "nitwits nitwit scoundrels"), (None, "a nitwit and a scoundrel"), (3, rows[3][1])]
    known = spark.createDataFrame([*labels, (9001, None), (None, 1), (5, labels[5][1]), (77_777, 1)], "doc_id long, toxic int").withColumn("label", F.lit("x"))
    result = toxicity.toxicity(docs_of(spark, rows + more), known).collect()
    assert len(result) == len(rows) + len(more)
    truth = dict(labels)
    held = [r for r in result if r["held_out"] and r["doc_id"] in truth]
    right = sum(r["predicted"] == truth[r["doc_id"]] for r in held)
    assert len(held) > 150 and right >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) and r["held_out"] == is_held_out(r["doc_id"]) for r in result)
    by = {r["doc_id"]: r for r in result}
    assert by[9000]["score"] == by[9001]["score"] and by[9000]["predicted"] == 0 and by[9002]["predicted"] == 1


def test_toxicity_without_labels_or_with_one_class(spark):
    rows = [(i, f"text {i}") for i in range(6)]
    none = spark.createDataFrame([], "doc_id long, toxic int")
    one = spark.createDataFrame([(i, 0) for i in range(6)], "doc_id long, toxic int")
    assert {round(r["score"], 6) for r in toxicity.toxicity(docs_of(spark, rows), none).collect()} == {0.0}
    assert {r["predicted"] for r in toxicity.toxicity(docs_of(spark, rows), one).collect()} == {0}
    assert toxicity.toxicity(docs_of(spark, rows).limit(0), one).count() == 0


@needs_tables
def test_queries_over_the_tables(spark):
    from tarifa.llm import queries
    from tests.llm.tables import SF_DIR

    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = queries.op1_language(spark, SF_DIR).collect()
    assert len(rows) == len(truth) and sum(truth[r["doc_id"]] == r["lang_pred"] for r in rows) >= 0.95 * len(rows)
