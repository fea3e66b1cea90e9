"""Every pipeline stage on odd tables, and the language stage on planted texts."""

import random
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quantelle.llm import language

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, `a.b` int, copies int, mixed_id string, place int, _gone int, `copy` int"


def words(rng, letters):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(60)).capitalize() + "."


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(4)
    rows = [(i, words(rng, "etaoinshr" if i % 2 else "äöüßenrsd"), "en" if i % 2 else "de", f"s{i % 3}") for i in range(60)]
    rows += [(100, rows[0][1], "de", "s0"), (101, rows[0][1] + " Und.", "de", None), (5, rows[5][1], "en", "s2"), (None, rows[7][1], None, "s1"),
             (None, rows[7][1], None, "s1"), (102, None, "en", "s1"), (103, "", None, None), (104, " 12 ...", "en", "s1")]
    rows += [(200, words(rng, "日本語文字列例題"), None, "s1"), (201, "".join(rng.choice("qxzjkvwQXZJ#@~^") for _ in range(400)), None, "s1")]
    return spark.createDataFrame([(*r, 3, 1, 2, "m", 4, 5, 6) for r in rows], SCHEMA)


def test_language_rejects_noise_and_foreign_texts(spark, docs):
    kept = {r.doc_id for r in corpus_pipeline.identify_language(spark, docs, SF).collect()}
    assert not kept & {102, 103, 104, 200, 201} and set(range(60)) | {100, 101, None} <= kept


def test_stages_keep_columns_and_decide(spark, docs):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "decontamination", "mixing", "token_files"]
    for given in (docs, docs.where("false")):
        now, counts = given, []
        for name, stage in corpus_pipeline.STAGES:
            now = stage(spark, now, SF).checkpoint()
            counts.append(now.count())
            if name != "token_files":
                assert now.columns == docs.columns
            if name == "near_duplicates":
                ids = [r.doc_id for r in now.collect()]
                assert len(ids) == len(set(ids)) and (not ids or not {100, 101} & set(ids))
        assert counts[-1] == counts[-2] and (counts[-1] > 0) == (not given.isEmpty())


def test_texts_do_not_come_back_from_the_language_stage(spark, docs):
    plan = corpus_pipeline.identify_language(spark, docs.withColumn("text", F.col("text")), SF)._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "MapInArrow" not in plan


def test_model_and_thresholds_are_of_all_labelled_rows(spark, monkeypatch):
    rng = random.Random(6)
    texts = [f"{words(rng, 'etaoinshr')} {i}" for i in range(1700)]
    rows = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string").repartition(5)
    starts = [("\n\n\n" + t).encode() for t in texts]
    want = {}
    for raw in starts:
        for i in range(3, len(raw)):
            want[raw[i - 3:i + 1]] = want.get(raw[i - 3:i + 1], 0) + 1
    full = language.build(["en"], {"en": (np.array([int.from_bytes(k, "big") for k in want], np.uint32), np.array(list(want.values()), float))})
    for held in (language.MAX_HELD, 10):  # counts sent on at the end, and early
        monkeypatch.setattr(language, "MAX_HELD", held)
        model = language.train(rows)
        assert all((a == b).all() for a, b in zip(model.keys + model.bits, full.keys + full.bits))
    usual = language.bits_per_byte(rows, spark.sparkContext.broadcast(full))
    assert usual["en"] == pytest.approx(language.code_lengths(full, texts).sum() / sum(len(t.encode()) for t in texts), rel=1e-6)


def test_batches_for_python_are_bounded_by_bytes(spark):
    import pyarrow as pa

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"rows": [batch.num_rows], "bytes": [batch.nbytes]})

    corpus_pipeline._small_batches(spark)
    long = spark.range(0, 200, 1, 1).select(F.repeat(F.lit("x"), 100_000).alias("text"))
    found = long.mapInArrow(sizes, "rows long, bytes long").collect()
    assert sum(r["rows"] for r in found) == 200 and max(r["bytes"] for r in found) < 1_500_000


def test_driver_holds_counted_strings_in_arrays(spark):
    rng = random.Random(8)
    rows = spark.createDataFrame([(bytes(rng.choices(range(33, 126), k=20_000)).decode(), x) for x in ("de", "en") for _ in range(4)], "text string, lang string")
    language.train(rows.limit(1))  # what is imported and sent once
    tracemalloc.start()
    model = language.train(rows)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(model.keys[-1]) > 150_000 and peak < 250 * len(model.keys[-1])
