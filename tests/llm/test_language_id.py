import numpy as np
from pyspark.sql import functions as F

from hazardlens.llm import language_id as L

from . import data


def test_held_out_accuracy_and_calibration(spark, queries):
    sf = "/root/testdata/sf0.1"
    docs = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    got = queries["op2_language_id"](spark, sf).collect()
    assert len(got) == len(docs)
    apart = [r for r in got if r.held_out]
    right = np.array([r.lang_pred == docs[r.doc_id] for r in apart])
    assert right.mean() >= 0.99
    assert abs(np.mean([r.score for r in apart]) - right.mean()) < 0.01


def test_odd_rows(spark):
    rows = data.odd_rows() + [(901, "12 34 !?", "en", None), (902, "ǅ", "en", None)]
    df = data.frame(spark, rows).drop("score")
    model = L.fit(df)
    got = L.predict(df, model)
    assert got.columns == [*df.columns, "lang_pred", "score"]
    got = got.collect()
    assert len(got) == len(rows)
    for r in got:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letters) and (r.score == 0.0) == (not letters) and 0 <= r.score <= 1
    assert L.predict(df.limit(0), model).collect() == []


def test_nothing_to_learn_from(spark):
    rows = [(1, "words", None, None), (2, None, "en", None), (3, "123", "en", None)]
    for some in (rows[:2], rows):
        df = data.frame(spark, some, clashes=False)
        assert L.fit(df) is None
        assert {(r.lang_pred, r.score) for r in L.predict(df, None).collect()} == {("und", 0.0)}


def test_weights_are_sparse_and_copies_count_once(spark):
    rows = [(i, f"der die das und ist nicht ein {i}", "de", None) for i in range(40)]
    rows += [(100 + i, f"the and is not a one of them {i}", "en", None) for i in range(40)]
    rows += [(1000 + i, "the same copy", "en", None) for i in range(500)]
    model = L.fit(data.frame(spark, rows, clashes=False), L.Settings(sample_rows=60))
    assert 0 < (model.weights != 0).mean() < 0.1
    assert L.predict_text(model, "und das ist nicht die")[0] == "de" and L.predict_text(model, "THE AND OF")[0] == "en"


def test_document_frequencies_match_a_plain_count(spark):
    texts = [t for _, t, *_ in data.odd_rows() if t]
    seen, n = L.document_frequencies(spark.createDataFrame([(t,) for t in texts], "text string"))
    want = np.zeros(L.BUCKETS, int)
    for t in texts:
        want[L.term_counts(t)[0]] += 1
    assert n == len(texts) and (seen == want).all()


def test_term_counts_are_those_of_the_collapsed_text():
    def plain(text):
        return L.term_counts(text)[1].sum()

    collapsed = " ab c "
    assert L.code_points("--Ab\n\n1 c!").tolist() == [ord(c) if c != " " else 0 for c in collapsed]
    assert plain("--Ab\n\n1 c!") == sum(len(collapsed) - n + 1 for n in L.ORDERS)
    assert plain("a") == 3 + 2 + 1


def test_held_out_rule(spark):
    import zlib
    got = spark.range(200).select("id", L.held_out(F.col("id")).alias("h")).collect()
    assert [r.h for r in got] == [zlib.crc32(str(r.id).encode()) % 4 == 2 for r in got]
    assert spark.sql("select cast(null as long) id").select(L.held_out(F.col("id"))).first()[0] is None
