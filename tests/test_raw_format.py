import string

from hypothesis import given, settings
from hypothesis import strategies as st

from tidelake.sinks.raw import write_raw
from tidelake.sources.raw import read_raw

# any text the format can carry: no separator, no line break
ALPHABET = string.ascii_letters + string.digits + " \"'\\,;|#\t-_.:"
cell = st.one_of(st.none(), st.text(alphabet=ALPHABET, max_size=12))


def _roundtrip(spark, path, rows, **kw):
    df = spark.createDataFrame(rows, "k int, a string, b string")
    write_raw(df, path)
    return sorted(tuple(r) for r in read_raw(spark, path, schema="k int, a string, b string", **kw).collect())


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(cell, cell), min_size=1, max_size=20))
def test_roundtrip_keeps_null_empty_and_text(spark, tmp_path_factory, cells):
    rows = [(i, a, b) for i, (a, b) in enumerate(cells)]
    out = _roundtrip(spark, str(tmp_path_factory.mktemp("rt")), rows)
    assert out == sorted(rows)


def test_csv_mode_maps_empty_to_null(spark, tmp):
    out = _roundtrip(spark, tmp + "/t", [(1, "", "x"), (2, None, "")], exact=False)
    assert out == [(1, None, "x"), (2, None, None)]


def test_null_marker_off_keeps_marker_text(spark, tmp):
    out = _roundtrip(spark, tmp + "/t", [(1, None, "x")], null_marker=None)
    assert out == [(1, "\\N", "x")]


def test_trailing_empty_fields_survive(spark, tmp):
    p = tmp + "/t/part-0.txt"
    import os
    os.makedirs(os.path.dirname(p))
    with open(p, "w") as f:
        f.write("1\u0007a\u0007\u0007\n2\u0007\\N\u0007\u0007x\n")
    rows = sorted(tuple(r) for r in read_raw(spark, tmp + "/t").collect())
    assert rows == [("1", "a", "", ""), ("2", None, "", "x")]


def test_bad_values_become_null_not_failures(spark, tmp):
    import os
    os.makedirs(tmp + "/t")
    with open(tmp + "/t/p.txt", "w") as f:
        f.write("1\u0007x\nnot-a-number\u0007y\n")
    rows = sorted(read_raw(spark, tmp + "/t", schema="k int, v string").collect(), key=str)
    assert [tuple(r) for r in rows] == [(1, "x"), (None, "y")]


def test_partition_column_is_discovered_and_typed(spark, tmp):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    write_raw(df, tmp + "/t/date_part=2024-01-01")
    out = read_raw(spark, tmp + "/t", schema="k int, v string")
    assert dict(out.dtypes)["date_part"] == "date"


def test_other_separator_is_taken_literally(spark, tmp):
    df = spark.createDataFrame([(1, "a.b", None), (2, "", "c")], "k int, a string, b string")
    write_raw(df, tmp + "/t", sep="|")
    out = sorted(tuple(r) for r in read_raw(spark, tmp + "/t", schema="k int, a string, b string", sep="|").collect())
    assert out == [(1, "a.b", None), (2, "", "c")]
