"""Fill-in-middle: the SQL twin, a brute force over tokens, round trips, edge cases."""

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from compare import database, same
from sluice.llm import fim
from sluice.llm.queries import op12_fill_in_middle

DOCS = "doc_id long, text string"


def by_hand(doc_id, text, forms=fim.Forms()):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    h = hashlib.sha256(f"{forms.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    if not n or any(m in text for m in forms.marks) or h3 % 100 >= 100 - forms.plain:
        return n, "plain", text, None, None
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = ("".join(units[x:y]) for x, y in ((0, a), (a, b), (b, n)))
    p, s, m = forms.marks
    form = "spm" if h4 % 100 < forms.suffix_first else "psm"
    return n, form, f"{s}{suf}{p}{pre}{m}{mid}" if form == "spm" else f"{p}{pre}{s}{suf}{m}{mid}", len(pre), len(mid)


def check(spark, rows, forms=fim.Forms()):
    out = fim.transform(spark.createDataFrame(rows, DOCS), forms).withColumn("back", fim.restored(F.col("output"), F.col("form"), forms))
    got = sorted((str(r.doc_id), r.text or "", r.n, r.form, r.output, r.prefix_chars, r.middle_chars) for r in out.collect())
    assert got == sorted((str(i), t or "", *by_hand(i, t, forms)) for i, t in rows)
    assert out.filter("back <> coalesce(text, '')").count() == 0


def test_op12_equals_its_sql(spark, sf):
    same(op12_fill_in_middle(spark, sf), database(sf), fim.ORACLE_SQL)


def test_all_documents_by_hand(spark, sf):
    check(spark, [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()])


def test_edges(spark):
    texts = [None, "", "a", " ", "\n", "\r\n \u0085", "😀é́", "has <S> in it", "$1 \\ {2}", "<P", "P><S", "x" * 100_000, "\0a"]
    check(spark, [(i, t) for i in range(25) for t in texts] + [(None, "no id at all"), (None, "no id at all")])
    assert fim.cut_and_restore(spark.createDataFrame([], DOCS)).count() == 0


def test_other_sentinels_and_shares(spark):
    check(spark, [(i, "some words, here $ there") for i in range(60)], fim.Forms("$p\\", "|s|", "[m]", 0, 50, 7))
    for marks in (("<P>", "<P>", "<M>"), ("<P>", "<", "<M>"), ("", "<S>", "<M>")):
        with pytest.raises(ValueError):
            fim.Forms(*marks)


def test_clashing_columns(spark):
    rows = spark.createDataFrame([(1, "ab cd", "old", 7, 3)], DOCS + ", Form string, n int, source int")
    out = fim.transform(rows)
    assert [c.lower() for c in out.columns] == ["doc_id", "text", "source", "n", "form", "output", "prefix_chars", "middle_chars"]
    assert out.first().n == 3


def test_long_text_of_many_units(spark):
    text = "ab é 😀\n<" * 80_000
    path = spark.createDataFrame([(5, text)], DOCS)
    row = fim.cut_and_restore(path).first()
    n, form, output, prefix, middle = by_hand(5, text)
    assert (row.n, row.form, row.prefix_chars, row.middle_chars) == (n, form, prefix, middle)
    assert row.output_sha256 == hashlib.sha256(output.encode()).hexdigest() and row.restored_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_plan_is_one_stage_of_the_jvm(spark, sf):
    plan = op12_fill_in_middle(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 2**31), st.text(max_size=40))
def test_model_round_trip(doc_id, text):
    n, form, output, pre, mid = by_hand(doc_id, text)
    if form == "psm":
        p, rest = output[3:].split("<S>", 1)
        s, m = rest.split("<M>", 1)
        assert p + m + s == text and (len(p), len(m)) == (pre, mid)
