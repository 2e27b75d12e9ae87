"""Edge cases of the complaint pipeline on tiny hand-written records."""

import math

import pytest
from pyspark.sql import functions as F

from tessera.functions.text import STOP_WORDS, clean_text, field
from tessera.plans import text


def complaints(spark, lines):
    return spark.createDataFrame(list(enumerate(lines)), "doc_id long, line string")


def test_stop_words_list():
    assert len(STOP_WORDS) == 184
    assert STOP_WORDS[:3] == ["i", "me", "my"] and STOP_WORDS[-5:] == ["xxxx", "xxx", "", "xx", "x"]


def test_record_validity(spark):
    lines = [
        "2015-01-01,Mortgage,a fine comment",
        "2015-01-01,Mortgage,a,b",  # comma inside the comment: 4 fields
        "2009-01-01,Mortgage,old",  # date not 201x
        "2015-01-01,Mortgage,",  # empty comment
        "date,label,comment",  # header line
    ]
    rows = text.valid_records(complaints(spark, lines)).collect()
    assert [(r.doc_id, r.label, r.comment) for r in rows] == [(0, "Mortgage", "a fine comment")]


def test_clean_and_stop_words(spark):
    df = spark.createDataFrame([("  XXXX paid $12!! late ",)], "c string")
    assert df.select(clean_text("c")).first()[0] == "xxxx paid late"
    toks = text.content_tokens(complaints(spark, ["2015-01-01,L,  XXXX paid $12!! late "]))
    assert [r.word for r in toks.orderBy("pos").collect()] == ["paid", "late"]


def test_lexicon_tie_goes_to_alphabetical_first(spark):
    lines = ["2015-01-01,A,zeta alpha beta beta", "2015-01-01,B,zeta alpha gamma beta"]
    lex = text.lexicon(complaints(spark, lines), k=2).collect()
    # beta 3, then alpha/zeta tie at 2: alpha wins
    assert [(r.idx, r.word, r.n) for r in lex] == [(0, "beta", 3), (1, "alpha", 2)]


def test_idf_counts_documents_without_lexicon_words(spark):
    lines = [
        "2015-01-01,A,apple apple pear pear pear",
        "2015-01-01,A,apple",
        "2015-01-01,B,kiwi",  # no lexicon word (k=2): counts in N, no feature row
    ]
    c = complaints(spark, lines)
    idf = {r.word: r.idf for r in text.idf(c, k=2).collect()}
    assert idf == pytest.approx({"apple": math.log(3 / 2), "pear": math.log(3 / 1)})
    vec = text.tfidf_vectors(c, k=2).orderBy("doc_id").collect()
    assert [r.doc_id for r in vec] == [0, 1]
    # apple and pear tie at 3 (apple first); doc 0: tf 2 and 3 of max 3
    assert vec[0].features.toArray().tolist() == pytest.approx(
        [(0.5 + 0.5 * 2 / 3) * math.log(1.5), 1.0 * math.log(3)])
    assert vec[1].features.toArray().tolist() == pytest.approx([math.log(1.5), 0.0])


def test_word_in_every_document_has_zero_weight(spark):
    lines = ["2015-01-01,A,apple pear", "2015-01-01,B,apple"]
    rows = text.tfidf(complaints(spark, lines), k=2).where(F.col("word") == "apple").collect()
    assert [r.weight for r in rows] == [0.0, 0.0]


def test_whole_long_text_is_tokenised(spark):
    body = " ".join(["word"] * 30000)
    toks = text.tokens(complaints(spark, ["2015-01-01,A," + body]))
    assert toks.count() == 30000


def test_records_of_odd_lines(spark):
    lines = [
        "", ",", ",,", ",,x", "201", "201,a", "201,a,", "201,a,b", "201,a,b,", "201,a,b,,", "201,,b", "201,a,b\n", "201,a\nb,\nc\n",
        "2015,é,,", " 201,a,b", "201,a, ", "201,a,K İ", ",201,a", "201\x00,a,b", "2015-01-01,A," + "w " * 5000, None,
    ]
    rows = text.valid_records(complaints(spark, lines)).collect()
    parts = [(i, x.split(",")) for i, x in enumerate(lines) if x is not None]
    want = [(i, p[1], p[2]) for i, p in parts if len(p) == 3 and p[2] and p[0].startswith("201")]
    assert sorted((r.doc_id, r.label, r.comment) for r in rows) == want and len(want) == 8
    got = spark.createDataFrame([("a|b",), ("",), (None,)], "x string").select(*[field("x", i, "|").alias(f"f{i}") for i in range(3)]).collect()
    assert [tuple(r) for r in got] == [("a", "b", "b"), ("", "", ""), (None, None, None)]


def test_records_are_cut_without_bytewise_searches(spark):
    plan = text.valid_records(complaints(spark, ["2015-01-01,A,b"]))._jdf.queryExecution().optimizedPlan().toString()
    assert "split(" in plan and "substring_index" not in plan and "replace(" not in plan
