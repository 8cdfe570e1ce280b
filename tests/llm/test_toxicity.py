import math
import random

import pytest
from pyspark.sql import functions as F

from millrace.llm import toxicity


def text(rng, bad=()):
    words = ["".join(rng.choices(["ba", "lo", "mi", "ru", "te"], k=3)) for _ in range(60)] + list(bad)
    rng.shuffle(words)
    return " ".join(words)


@pytest.fixture(scope="module")
def model():
    rng = random.Random(1)
    bad = [text(rng, rng.choices(["idiot", "zorkan", "zorkel", "zorkum", "scum"], k=2)) for _ in range(150)]
    return toxicity.fit(bad, [text(rng) for _ in range(150)])


def test_lexicon_holds_words_and_beginnings(model):
    assert " idiot " in model.entries and " scum " in model.entries
    assert any(entry.startswith(" zork") and not entry.endswith(" ") for entry in model.entries)


def test_held_out(model):
    rng = random.Random(2)
    machine = model.automaton()
    assert all(model.score(text(rng, [w]), machine) >= toxicity.PREDICT_AT for w in ["idiot", "zorkimu", "SCUM!", "1d10t", "іdіоt", "i​diot"])
    assert all(model.score(text(rng, [w]), machine) < toxicity.PREDICT_AT for w in ["idiotic", "pond scum", "x"] for _ in range(5))
    assert all(model.score(empty, machine) < toxicity.PREDICT_AT for empty in (None, "", "  "))


def test_long_texts_are_read_to_the_end(model):
    machine = model.automaton()
    rng = random.Random(3)
    start = " ".join(text(rng) for _ in range(3000))
    assert model.score(start + " idiot scum idiot", machine) > model.score(start, machine)


def test_fold():
    assert toxicity.fold("Mor0n, $cum! the*** Straße ÑANDÚ 5 10") == " moron scum the strasse nandu "
    assert toxicity.fold("") == "  "


def test_signal_against_plain_search(model):
    rng = random.Random(4)
    machine = model.automaton()
    for _ in range(50):
        sample = text(rng, rng.choices(["idiot", "scum", "pond scum", "zorka"], k=3))
        folded = toxicity.fold(sample)
        total = 0.0
        for entry, weight in model.entries.items():
            for at in range(len(folded)):
                if folded.startswith(entry, at) and not any(
                    folded.startswith(f" {p} ", k) and k <= at and at + len(entry) <= k + len(p) + 2
                    for p in model.exceptions
                    for k in range(max(0, at - 30), at + 1)
                ):
                    total += weight
        assert model.signal(sample, machine) * (1 + math.log1p(folded.count(" "))) == pytest.approx(total)


def test_tables(spark, clash):
    rng = random.Random(5)
    rows = [(i, text(rng, ["idiot", "scum"] if i % 2 else [])) for i in range(80)] + [(None, None), (3, ""), (1, "idiot")]
    docs = clash(spark.createDataFrame(rows, "doc_id bigint, text string"))
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)] + [(None, 1), (200, None)], "doc_id bigint, toxic int")
    fitted = toxicity.train(docs, labels, F.lit(True))
    found = toxicity.score(docs, fitted, ["doc_id"])
    assert found.count() == len(rows)
    assert found.where("doc_id IS NULL").first()["predicted"] == 0
    assert {r["doc_id"] % 2 for r in found.where("doc_id BETWEEN 4 AND 79 AND predicted = 1").collect()} == {1}
    nothing = toxicity.train(docs, labels.where("false"), F.lit(True))
    assert toxicity.score(docs, nothing, ["doc_id"]).where("predicted = 1").count() == 0
    assert toxicity.score(docs.where("false"), fitted, ["doc_id"]).count() == 0


def test_held_out_rows_teach_nothing(spark):
    rng = random.Random(6)
    docs = spark.createDataFrame([(i, text(rng, ["idiot"] if i % 2 else [])) for i in range(60)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id bigint, toxic int")
    allowed = F.col("doc_id") < 40
    flipped = labels.withColumn("toxic", F.when(allowed, F.col("toxic")).otherwise(1 - F.col("toxic")))
    assert toxicity.train(docs, labels, allowed) == toxicity.train(docs, flipped, allowed)
