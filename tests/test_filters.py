import pytest
from pyspark.sql import functions as F

from canonix.operators.filters import filter_by_value
from conftest import rows


@pytest.fixture()
def df(spark):
    return spark.createDataFrame(
        [(7, 7, "7", 7.0), (0, 0, "007", None), (-5, None, "-5", 1.5), (None, 2 ** 40, None, 1e7)],
        "a int, b bigint, s string, d double")


@pytest.mark.parametrize("col,value", [
    ("a", "7"), ("a", "007"), ("a", "-0"), ("a", "0"), ("a", "-5"), ("a", "99999999999"), ("a", "+7"),
    ("b", str(2 ** 40)), ("b", "7"), ("b", " 7"), ("s", "007"), ("s", "7"), ("d", "7.0"), ("d", "1.5"),
])
def test_typed_filter_equals_string_filter(df, col, value):
    typed = filter_by_value(df, col, value)
    text = df.where(F.col(col).cast("string") == F.lit(value))
    assert rows(typed) == rows(text)


def test_missing_column_keeps_schema(df):
    with pytest.warns(UserWarning):
        out = filter_by_value(df, "nope", "1")
    assert out.columns == df.columns and out.count() == 0


def test_scope_any(spark):
    m = spark.createDataFrame([(1, "F", "O"), (2, "O", "F"), (3, "O", "O")],
                              "k int, status string, status_from_b_csv string")
    assert [r.k for r in filter_by_value(m, "status", "F").collect()] == [1]
    assert sorted(r.k for r in filter_by_value(m, "status", "F", scope="any").collect()) == [1, 2]


def test_typed_filter_property(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    data = [(v,) for v in (-(2 ** 63), -129, -1, 0, 1, 7, 10, 127, 2 ** 31, 2 ** 63 - 1)] + [(None,)]
    df = spark.createDataFrame(data, "b bigint").cache()
    texts = st.one_of(
        st.integers(min_value=-(2 ** 64), max_value=2 ** 64).map(str),
        st.sampled_from(["007", "-0", "+1", " 1", "1 ", "1.0", "", "1e3", "0x10", "٣"]),
        st.text(alphabet="-0123456789", max_size=4),
    )

    @settings(max_examples=25, deadline=None)
    @given(texts)
    def check(value):
        typed = sorted(r.b for r in filter_by_value(df, "b", value).collect())
        text = sorted(r.b for r in df.where(F.col("b").cast("string") == F.lit(value)).collect())
        assert typed == text

    check()


def test_key_filter_uses_the_physical_key_type(spark):
    from canonix.model import HarmonizationMap
    from canonix.operators.filters import merge_then_filter

    m = HarmonizationMap.from_obj([{"canonical_name": "t", "data_type": "Integer",
                                    "original_columns": {"a.csv": ["t"], "b.csv": ["t"]}}])
    df = spark.sql("SELECT TIMESTAMP '2024-01-05 00:00:00' AS t")
    ds = {"a.csv": df, "b.csv": df}
    assert merge_then_filter(m, ds, "t", "F").count() == 0
    assert merge_then_filter(m, ds, "t", "2024-01-05 00:00:00").count() == 1
