import pytest

from tessera.operators.columns import column_max, column_sum


def ints(spark, values):
    return spark.createDataFrame([(v,) for v in values], "v int")


def test_sum(spark):
    assert column_sum(ints(spark, [1, 2, 0]), "v").first()[0] == 3


def test_max(spark):
    assert column_max(ints(spark, [3, 7, 2]), "v").first()[0] == 7


def test_sum_empty_is_zero(spark):
    assert column_sum(ints(spark, []), "v").first()[0] == 0


def test_max_empty_fails(spark):
    with pytest.raises(Exception):
        column_max(ints(spark, []), "v").collect()


def test_sum_does_not_wrap(spark):
    assert column_sum(ints(spark, [2147483647, 1]), "v").first()[0] == 2147483648


def test_local_frame_round_trip(spark):
    from tessera.session import local_frame
    rows = [(1, -2.5, "a'b\\c", None, True), (2, float("inf"), "", 7, False), (3, 1e300, "x", -1, None)]
    df = local_frame(spark, rows, "i INT, d DOUBLE, s STRING, n BIGINT, b BOOLEAN")
    assert [tuple(r) for r in df.collect()] == rows
    assert df.schema.simpleString() == "struct<i:int,d:double,s:string,n:bigint,b:boolean>"
    empty = local_frame(spark, [], "i INT, d DOUBLE")
    assert empty.collect() == [] and empty.columns == ["i", "d"]


def test_sum_and_max_match_python(spark):
    import random
    rnd = random.Random(17)
    for _ in range(3):
        values = [rnd.randint(-1000, 1000) for _ in range(rnd.randint(1, 300))]
        df = ints(spark, values + [None])              # NULLs take no part
        assert column_sum(df, "v").first()[0] == sum(values)
        assert column_max(df, "v").first()[0] == max(values)
