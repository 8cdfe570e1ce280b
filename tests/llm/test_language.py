import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import language

SYLLABLES = {"aa": ["the", "ing", "and", "wh"], "bb": ["ich", "sch", "ung", "ver"], "cc": ["eau", "oi", "tion", "le"]}


def sample(n, seed=0, length=30):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(list(SYLLABLES))
        rows.append((i, " ".join("".join(rng.choices(SYLLABLES[lang], k=3)) for _ in range(length)), lang))
    return rows


@pytest.fixture(scope="module")
def model():
    rows = sample(300)
    return language.fit([r[1] for r in rows], [r[2] for r in rows])


def test_held_out_accuracy_and_rejection(model):
    held = sample(200, seed=9)
    answers = [model.predict(text) for _, text, _ in held]
    assert np.mean([a[0] == lang for a, (_, _, lang) in zip(answers, held)]) > 0.98
    assert not any(rejected for _, _, rejected in answers)
    assert all(0 <= score <= 1 for _, score, _ in answers)


def test_buckets_are_those_of_every_subword_of_the_whole_text(monkeypatch):
    text = "Thé end, of 12 it all—no?" * 40
    whole = language.buckets(text)
    blanked = re.sub(rb" +", b" ", b" " + bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in text.lower().encode()) + b" ")
    brute = sum(b" " not in blanked[i + 1 : i + n - 1] for n in (3, 4) for i in range(len(blanked) - n + 1))
    assert whole.sum() == brute
    monkeypatch.setattr(language, "CHUNK", 64)
    assert (language.buckets(text) == whole).all()


def test_undetermined(model):
    for text in (None, "", " \n", "123 !? ٣"):
        assert model.predict(text) == ("und", 0.0, True)
    assert language.fit([], []).predict("words") == ("und", 0.0, True)


def test_few_labels_still_give_a_model():
    assert language.fit(["abc"], ["xx"]).predict("abc")[0] == "xx"


def test_wrong_labels_do_not_raise_the_bar():
    rows = sample(300)
    labels = [r[2] for r in rows]
    labels[0] = labels[1] = "cc" if labels[0] != "cc" else "aa"
    noisy = language.fit([r[1] for r in rows], labels)
    assert sum(noisy.predict(t)[2] for _, t, _ in sample(100, seed=5)) <= 2


def test_tables(spark, clash):
    rows = [(i, t, lang) for i, t, lang in sample(200)] + [(None, "the ing", None), (1, None, "aa"), (7, "wh" * 100_000, None)]
    docs = clash(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    fitted = language.train(docs, F.lit(True), sample=100)
    found = language.predict(docs, fitted)
    assert found.count() == len(rows)
    assert found.where("text IS NULL").first()["lang_pred"] == "und"
    kept = language.keep_known(docs, fitted)
    assert kept.schema == docs.schema and kept.count() == len(rows) - 1
    assert kept.first()["score"] == "x"
    empty = docs.where("false")
    assert language.predict(empty, language.train(empty, F.lit(True))).count() == 0
    assert language.predict(empty, fitted).count() == 0


def test_training_is_the_same_for_any_order_of_rows(spark):
    docs = spark.createDataFrame(sample(120), "doc_id bigint, text string, lang string")
    a = language.train(docs, F.lit(True), sample=50)
    b = language.train(docs.orderBy(F.desc("doc_id")), F.lit(True), sample=50)
    assert np.array_equal(a.table, b.table) and a.threshold == b.threshold


def test_labels_of_predicted_rows_are_no_input(spark):
    docs = spark.createDataFrame(sample(120), "doc_id bigint, text string, lang string")
    fitted = language.train(docs, F.lit(True))
    a = language.predict(docs, fitted).orderBy("doc_id").select("lang_pred", "score").collect()
    b = language.predict(docs.withColumn("lang", F.lit("zz")), fitted).orderBy("doc_id").select("lang_pred", "score").collect()
    assert a == b


def test_numerals_are_no_letters():
    model = language.fit(["the cat and the dog"] * 20 + ["der hund und die katze"] * 20, ["en"] * 20 + ["de"] * 20)
    assert [model.predict(text)[0] for text in ("½ ²", "12 %", "", None, "Ⅻ ①")] == ["und"] * 5
    assert model.predict("² the dog")[0] == "en"
