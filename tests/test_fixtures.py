"""Small tables whose answers follow from how they are built."""

from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from quern.operators.aggregates import prefix_density, selectivity, value_histogram
from quern.operators.changes import (
    delete_where,
    guarded_update,
    retype,
    soft_delete,
    split_fund,
    update_where,
)
from quern.operators.loads import checked_load
from quern.sources.generators import generate, numbers, skewed_pair, with_dense_id
from quern.sources.literals import append_rows, literal_rows


def n():
    return F.col("n")


def count_where(df, condition):
    return df.filter(condition).count()


def test_sequence_of_ten_thousand(spark):
    seq = generate(spark, 10_000, c1=n(), c2=n(), c3=F.lit("C3"))
    assert seq.count() == 10_000
    assert count_where(seq, "c2 = 1") == 1


@pytest.mark.parametrize("follows, last", [(False, 2), (True, 21)])
def test_twenty_rows(spark, follows, last):
    made = generate(spark, 20, c1=n(), c2=n() + 1 if follows else F.lit(2))
    assert made.count() == 20
    assert made.agg(F.max("c2")).first()[0] == last


def test_dense_id_before_and_after_growth(spark):
    base = numbers(spark, 1500, "c1")
    assert count_where(base, "c1 = 2") == 1
    grown = base.unionByName(generate(spark, 1500, c1=F.lit(2).cast("bigint")))
    tagged = with_dense_id(grown.withColumn("seq", F.monotonically_increasing_id()), ["seq"])
    assert count_where(tagged, "c1 = 2") == 1501
    ids = sorted(r[0] for r in tagged.select("id").collect())
    assert ids == list(range(1, 3001))


def test_opposite_skew_join(spark):
    a, b = skewed_pair(spark, 10_000, 1, 2), skewed_pair(spark, 10_000, 2, 1)
    a, b = a.select(F.col("value").alias("x")), b.select(F.col("value").alias("y"))
    joined = a.join(b, F.col("x") == F.col("y"))
    assert count_where(joined, "x = 2") == 10_000
    assert count_where(joined, "x = 1") == 10_000


def test_skew_of_one_value(spark):
    skew = skewed_pair(spark, 10_000, 1, 2)
    assert count_where(skew, "value = 1") == 1
    assert count_where(skew, "value = 2") == 10_000
    found = {r[0]: (r[1], r[2]) for r in prefix_density(skew, ["value", "id"]).collect()}
    assert found["value"] == (2, Decimal("0.50000000"))
    assert found["value, id"] == (10_001, Decimal("0.00009999"))
    exact = selectivity(skew, "value").first()
    assert (exact.distinct_values, exact.n_rows) == (2, 10_001)
    assert exact.density == Decimal("0.50000000")
    assert selectivity(skew, "value", approximate=True).first().distinct_values == 2


def test_modulo_with_two_extra_rows(spark):
    base = generate(
        spark, 10_000, c1=(n() % 50).cast("int"), c2=n().cast("int"), c3=F.lit("C3")
    )
    table = append_rows(base, ["c1", "c2"], [(51, 1), (52, 1)])
    assert count_where(table, "c2 = 1") == 3
    assert count_where(table, "c1 = 51") == 1
    sizes = table.filter("c1 < 50").groupBy("c1").count()
    assert rows(sizes) == [(i, 200) for i in range(50)]
    assert table.filter("c1 = 52").first().c3 is None


def test_two_opposite_sequences(spark):
    table = generate(spark, 10_000, c1=n()).unionByName(generate(spark, 100, c1=41 - n()))
    assert table.count() == 10_100
    assert table.filter(F.col("c1").between(21, 23)).count() == 6
    assert table.filter(F.col("c1").between(1, 10_000)).count() == 10_040


def test_overlapping_sequences(spark):
    table = generate(spark, 21, c1=n()).unionByName(generate(spark, 21, c1=41 - n()))
    assert table.count() == 42 and table.distinct().count() == 40
    twice = table.groupBy("c1").count().filter("count = 2")
    assert rows(twice.select("c1")) == [(20,), (21,)]


def test_hundreds_with_late_rows(spark):
    table = generate(spark, 24, c1=(n() * 100).cast("int"), c2=F.lit("C2"))
    grown = append_rows(table, ["c1", "c2"], [(110, "C2"), (120, "C2"), (130, "C2")])
    assert (table.count(), grown.count()) == (24, 27)


def test_eight_rows_changed_and_extended(spark):
    table = literal_rows(
        spark, "c1 int, c2 string, c3 string", [(i, "C2", "") for i in range(100, 900, 100)]
    )
    table = update_where(table, {"c3": "Add data"}, F.col("c1") == 200)
    for late in ([(410, "C2", "")], [(900, "C2", "")], [(900, "C2", "")],
                 [(110, "C2", "")], [(910, "C2", "")]):
        table = append_rows(table, ["c1", "c2", "c3"], late)
    assert table.count() == 13
    assert rows(table.filter("c3 = 'Add data'").select("c1")) == [(200,)]


def test_keyed_text_with_either_literal(spark):
    from quern.operators.filters import equals_literal

    table = generate(spark, 10_000, id=n(), key=F.concat(F.lit("UniqueKey"), n().cast("string")))
    assert equals_literal(table, "key", "UniqueKey333").count() == 1
    assert equals_literal(table, "id", "333").count() == 1


def test_modulo_256(spark):
    sizes = dict(
        generate(spark, 10_000, c=(n() % 256).cast("smallint")).groupBy("c").count().collect()
    )
    assert len(sizes) == 256
    assert (sizes[0], sizes[16], sizes[17]) == (39, 40, 39)


def test_price_changes(spark):
    price = literal_rows(
        spark, "product int, price decimal(19,4)", [(1, Decimal("15.0000"))]
    )
    amount = F.col("price")
    cheaper = guarded_update(price, "price", amount - 10, F.col("product") == 1, amount > 10)
    assert cheaper.first().price == Decimal("5.0000")
    again = guarded_update(cheaper, "price", amount - 10, F.col("product") == 1, amount > 10)
    assert again.first().price == Decimal("5.0000")
    discounted = update_where(
        price, {"price": amount * F.lit("0.6").cast("decimal(2,1)")}, amount > 10
    )
    assert discounted.first().price == Decimal("9.0000")


def test_bonus_from_a_fund(spark):
    staff = literal_rows(
        spark,
        "employee int, team int, salary decimal(19,4)",
        [(i, g, Decimal(1000)) for i, g in ((1, 10), (2, 10), (3, 20), (4, 9))],
    )
    changed, balance = split_fund(staff, "salary", "100", F.col("team") == 10)
    assert [int(r.salary) for r in changed.orderBy("employee").collect()] == [
        1050, 1050, 1000, 1000,
    ]
    assert tuple(balance.first()) == (2, Decimal("50.0000"), Decimal("0.0000"))
    unchanged, empty = split_fund(staff, "salary", "100", F.col("team") == 99)
    assert rows(unchanged) == rows(staff)
    assert tuple(empty.first()) == (0, None, None)


def test_delete_keeps_unknown(spark):
    table = literal_rows(spark, "g int", [(1,), (None,), (30,)])
    kept = delete_where(table, F.col("g") > 10).collect()
    assert [r.g for r in kept] == [1, None]


def test_soft_delete_twice(spark):
    table = literal_rows(spark, "k int", [(1,), (2,), (3,)])
    once = soft_delete(table, F.col("k") == 1)
    twice = soft_delete(once, F.col("k") == 3)
    assert rows(twice) == [(1, True), (2, False), (3, True)]


def test_retype_pads(spark):
    table = literal_rows(spark, "c1 int", [(7,)])
    assert retype(table, "c1", "string", 5).first().c1 == "7    "
    assert retype(table, "c1", "string").first().c1 == "7"


def _checked(spark, batches, mode):
    def table(values):
        return literal_rows(spark, "product int", [(v,) for v in values])

    return checked_load(
        table([]), [table(b) for b in batches], {"is one": F.col("product") == 1}, mode
    )


def test_statement_mode_refuses_the_batch_and_goes_on(spark):
    alone = _checked(spark, [[1, 2, 3]], "statement")
    assert alone.table.count() == 0 and alone.violations == [2]
    both = _checked(spark, [[1, 2, 3], [1]], "statement")
    assert rows(both.table) == [(1,)]
    assert rows(both.violators) == [(2, 1), (3, 1)]
    assert rows(both.log()) == [(1, 2, False), (2, 0, True)]


def test_all_or_nothing_mode(spark):
    load = _checked(spark, [[1, 2, 3], [1]], "all")
    assert load.table.count() == 0
    assert load.message == "2 of 2 batches were refused"
    assert [r.loaded for r in load.log().orderBy("batch").collect()] == [False, False]
    clean = _checked(spark, [[1], [1]], "all")
    assert clean.table.count() == 2 and clean.message is None


def test_unknown_rule_passes(spark):
    load = _checked(spark, [[1, None]], "all")
    assert load.table.count() == 2


def test_check_domain_join(spark):
    first = literal_rows(spark, "c1 int, c2 int", [(11, 12)])
    second = literal_rows(spark, "d1 int, d2 int", [(101, 102)])
    for value in (20, 30):
        on = (F.col("c1") == F.col("d2")) & (F.col("c2") == value)
        assert first.join(second, on).count() == 0


def test_histogram_covers_all_rows(spark):
    bins = value_histogram(numbers(spark, 1000), "n", 10).orderBy("bin").collect()
    assert [b.bin for b in bins] == list(range(1, 11))
    assert sum(b.n_rows for b in bins) == sum(b.n_distinct for b in bins) == 1000
    assert (bins[0].lowest, bins[-1].highest) == (1, 1000)
    single = literal_rows(spark, "v int", [(5,), (5,), (None,)])
    assert rows(value_histogram(single, "v", 4)) == [(1, 2, 1, 5, 5)]
    assert value_histogram(single.limit(0), "v", 4).count() == 0
