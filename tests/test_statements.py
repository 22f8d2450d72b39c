"""Statement templates."""

import pytest
from pyspark.sql import functions as F

from quern.functions.statements import literal_kinds, statement_template, tokens
from quern.plans.telemetry import template_rollup


def templates(spark, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(statement_template(F.col("t"))).collect()]


@pytest.mark.parametrize("left, right", [
    ("select a from t where b = 'it''s'", "SELECT a\nFROM t WHERE b = 'x'"),
    ("select a from t where b = N'x'", "select a from t where b = 'y'"),
    ("select a from t where b = 5 -- 7 of 9", "select a from t where b = 6"),
    ("select /* 'q' */ a from t", "select a from t"),
    ("select /* a ** b **/ a from t", "select a /*/ */ from t"),
    ("select a from t where b = 1e5", "select a from t where b = .5"),
    ("select a from t where b = 1.5E-3", "select a from t where b = 0xAF"),
    ("select a from t where b = -5", "select a from t where b = + 5"),
    ("select a from t where b in (1, 2, 3)", "select a from t where b in ('x')"),
    ("select a from t where b in (-1, @p)", "select a from t where b in (?)"),
    ("insert t values (1, 'a'), (2, 'b')", "insert t values (3, N'c')"),
    ("select a from t where b = 5", "select a from t where b = @p"),
    ("select a from t where b = 5", "(@p int)select a from t where b = @p"),
    ("select a from t where b = 5", "(@0 varchar(8000), @1 decimal(10, 2) output)SELECT a FROM t WHERE b = @0"),
    ("select [a] from [dbo].[T]", "select a from dbo.t"),
    ('select "a" from t', "select a from t"),
    ("select a from t;", "select a from t ; ;"),
    ("select a from t where b>=5", "select a from t where b >= 6"),
])
def test_spellings_of_one_statement(spark, left, right):
    a, b = templates(spark, left, right)
    assert a == b


@pytest.mark.parametrize("left, right", [
    ("select [a b] from t", "select a b from t"),
    ("select a from t where b = 5", "select a from t where c = 5"),
    ("select a - 5 from t", "select 5 from t"),
    ("select a from t where b = '-- x' and c = 1", "select a from t where b = '"),
    ("select a from t where b <> 5", "select a from t where b < > 5 + 1"),
    ("exec p @a", "exec q @a"),
])
def test_different_statements(spark, left, right):
    a, b = templates(spark, left, right)
    assert a != b


def test_no_text(spark):
    assert templates(spark, None, "", "-- only a comment") == [None, "", ""]


def test_kinds_in_order(spark):
    df = spark.createDataFrame([("a = 'x' and b = 0x1F and c = 2 and d = @p -- 3",)], "t string")
    assert df.select(literal_kinds(F.col("t"))).first()[0] == ["text", "binary", "number", "parameter"]


def test_tokens_lose_nothing_but_blanks_and_comments(spark):
    text = "SELECT [a]]b], \"c\"\"d\", N'e''f' FROM #t WHERE x<>@@y AND z|=1.e2 -- g"
    df = spark.createDataFrame([(text,)], "t string")
    found = df.select(tokens(F.col("t"))).first()[0]
    assert "".join(found) == text.split(" --")[0].replace(" ", "")
    assert "[a]]b]" in found and "N'e''f'" in found and "1.e2" in found


def test_rollup_counts_texts_and_executions(spark):
    rows = [("select 1",)] * 3 + [("select 2",)] * 2 + [("select a",)]
    found = template_rollup(spark.createDataFrame(rows, "t string"), "t").collect()
    assert {(r.template, r.executions, r.texts) for r in found} == {("select ?", 5, 2), ("select a", 1, 1)}
