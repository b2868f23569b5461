import datetime as dt

import pytest

from cartwright.sources import typed


def put(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text)


HEADER = "order_id, user_id,order_dow,when,at,share,fresh,note,blank,code\n"


@pytest.fixture
def folder(tmp_path):
    place = tmp_path / "orders"
    put(place, "a.csv", HEADER + '1,7,3,2024-01-05,2024-01-05 10:00:00,0.5,true,"a, b",,12\n2,8,,2024-02-01,2024-02-01 11:30:00,3,FALSE,x,,x7\n')
    put(
        place,
        "b.csv",
        HEADER
        + "3,7,4,2023-12-31,2023-12-31 00:00:00,1e-3,true,NaN,,13\n"
        + "4,7\n"
        + "5,7,1,2024-01-01,2024-01-01 00:00:00,1,true,y,,14,more\n"
        + "six,7,1,2024-01-01,2024-01-01 00:00:00,1,true,y,,15\n"
        + "7,u,1.5,2024-01-01,2024-01-01 00:00:00,1,true,y,,16\n",
    )
    return str(place)


def test_types_and_malformed_rows(spark, folder):
    got = typed.scan(spark, folder, "orders")
    assert got.types == {
        "order_id": "bigint", "user_id": "bigint", "order_dow": "int", "when": "date", "at": "timestamp",
        "share": "double", "fresh": "boolean", "note": "string", "blank": "string", "code": "string",
    }
    assert dict(got.rows.dtypes) == got.types
    rows = {r.order_id: r for r in got.rows.collect()}
    assert set(rows) == {1, 2, 3}
    assert rows[1].when == dt.date(2024, 1, 5) and rows[1].note == "a, b" and rows[1].blank is None
    assert rows[2].order_dow is None and rows[2].fresh is False and rows[3].share == 0.001 and rows[3].note == "NaN"
    bad = {(r.file, r.text.split(",")[0], r.reason) for r in got.malformed.collect()}
    assert bad == {
        ("b.csv", "4", "not 10 fields"),
        ("b.csv", "5", "not 10 fields"),
        ("b.csv", "six", "order_id: not bigint"),
        ("b.csv", "7", "user_id: not bigint, order_dow: not int"),
    }
    assert got.malformed.where("text LIKE '4,7%'").first().text == "4,7"


def test_every_row_is_in_one_of_the_tables(spark, folder):
    got = typed.scan(spark, folder, "orders")
    # Counting and pruned reads see the same rows as whole ones.
    assert got.rows.count() == 3 and got.malformed.count() == 4
    assert sorted(r.user_id for r in got.rows.select("user_id").collect()) == [7, 7, 8]
    assert got.malformed.select("reason").distinct().count() == 3


def test_unknown_table(spark, folder):
    got = typed.scan(spark, folder)
    # Values of every well-formed row count, so ids with a word in them are text.
    assert got.types["order_id"] == "string" and got.types["order_dow"] == "double"
    assert got.rows.count() == 5 and {r.reason for r in got.malformed.collect()} == {"not 10 fields"}


def test_edge_cases(spark, tmp_path):
    put(tmp_path / "e", "e.csv", "a,b\n")
    got = typed.scan(spark, str(tmp_path / "e"))
    assert got.types == {"a": "string", "b": "string"} and got.rows.isEmpty() and got.malformed.isEmpty()
    put(tmp_path / "t", "t.csv", "a, a\n1,2\n")
    with pytest.raises(ValueError, match="one name: a"):
        typed.scan(spark, str(tmp_path / "t"))
    long = 9_223_372_036_854_775_807
    put(tmp_path / "n", "n.csv", f"x.y,big,bigger,inf,padded\n1,{long},{long}1,Infinity, 4\n2,-1,1,1,5 \n")
    got = typed.scan(spark, str(tmp_path / "n"))
    assert got.types == {"x.y": "bigint", "big": "bigint", "bigger": "double", "inf": "string", "padded": "bigint"}
    assert sorted(r.padded for r in got.rows.collect()) == [4, 5] and got.rows.agg({"big": "max"}).first()[0] == long
    put(tmp_path / "one", "one.csv", "only\n2024-01-01\n\n2024-02-30\n")
    assert typed.scan(spark, str(tmp_path / "one")).types == {"only": "string"}
