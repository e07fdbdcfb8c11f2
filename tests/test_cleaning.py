"""Raw CSV reading and cleaning."""

import datetime as dt

import pytest

from rentscope.operators import cleaning, metrics
from rentscope.plans import jobs
from rentscope.sinks import files, warehouse
from rentscope.sources import documents, rent_csv

HEADER = "DISTRICT, BUITYPE,FAREA,TPRICE,UPRICE,SDATE,CASE_T,RENT_TYPE\n"
ROWS = (
    '大安區,公寓,"1,0.5",,"2,000",1150427,租賃,\n'
    "信義區,,20,3.5,,1150427.0,租賃,\n"
    "中山區,套房,10,2,NA,1150427,買賣,整戶租\n"
    "中山區,套房,10,2,1500,1150427,買賣,\n"
    "北投區,套房,10,1.8,,1150231,租賃,\n"
    "NULL,套房,10,1.8,,1150427,租賃,\n"
    "文山區,套房,400,1.8,,1150427,租賃,\n"
)


def write(folder, name, text, encoding):
    path = folder / name
    path.write_bytes(text.encode(encoding))
    return str(path)


@pytest.mark.parametrize("encoding", ["utf-8", "utf-8-sig", "big5", "cp950"])
def test_read_and_clean(spark, tmp_path, encoding):
    path = write(tmp_path, "a file.csv", HEADER + ROWS, encoding)
    raw = rent_csv.read_rent_csv(spark, path)
    assert raw.columns[:2] == ["DISTRICT", "BUITYPE"]
    rent = cleaning.clean_rent(cleaning.rental_rows(raw))
    got = {r.district: r for r in rent.collect()}
    assert set(got) == {"大安區", "信義區", "中山區"}
    assert got["大安區"].area_ping == 10.5 and got["大安區"].rent_total_ntd == 21000
    assert got["大安區"].transaction_date == dt.date(2026, 4, 27)
    assert got["信義區"].rent_total_ntd == 35000 and got["信義區"].rent_per_ping_ntd == 1750.0
    assert got["信義區"].building_type is None and got["信義區"].has_elevator is None
    assert got["中山區"].rent_per_ping_ntd == 2000.0
    ingest = {r.district: r for r in cleaning.to_ingest(rent).collect()}
    assert ingest["信義區"].building_type == "unknown"


def test_mixed_encodings_and_undecodable(spark, tmp_path):
    rare = HEADER.replace(" ", "") + "大安區,碁銹裏墻恒粧嫺,10,2,2000,1150427,租賃,\n"
    paths = [
        write(tmp_path, "u.csv", HEADER + ROWS, "utf-8"),
        write(tmp_path, "b.csv", HEADER + ROWS, "big5"),
        write(tmp_path, "c.csv", rare, "cp950"),
    ]
    found = rent_csv.file_formats(rent_csv.raw_lines(spark, paths))
    assert sorted(r.encoding for r in found.collect()) == ["big5", "utf-8", "x-windows-950"]
    raw = rent_csv.read_rent_csv(spark, *paths)
    assert raw.count() == 15
    assert raw.filter("BUITYPE = '碁銹裏墻恒粧嫺'").count() == 1
    bad = tmp_path / "bad.csv"
    bad.write_bytes(b"A,B\n\xff\xff\xfe,1\n")
    with pytest.raises(ValueError, match="cannot decode"):
        rent_csv.read_rent_csv(spark, str(bad))


def test_each_file_has_its_own_columns_and_encoding(spark, tmp_path):
    """Orders, gaps and encodings differ from file to file; small pieces split the files."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    paths, wanted = [], []
    try:
        for k, encoding in enumerate(["utf-8", "utf-8-sig", "big5", "cp950"] * 3):
            names = ["DISTRICT", " FAREA ", "BUITYPE", f"ONLY_{k}"]
            names = names[k % 4 :] + names[: k % 4]
            lines = [",".join(names)]
            for i in range(40):
                cells = {"DISTRICT": "大安區", "FAREA": str(i), "BUITYPE": f'"華, ""廈{i}"""', "only": "許功蓋"}
                lines.append(",".join(cells.get(n.strip(), cells["only"]) for n in names))
                wanted.append(("大安區", str(i), f'華, "廈{i}"', k))
            end = "\r\n" if k % 2 else "\n"
            folder = tmp_path / f"{k} é+%"
            folder.mkdir()
            paths.append(write(folder, "x.csv", end.join([*lines, "", ""]), encoding))
        raw = rent_csv.read_rent_csv(spark, *paths)
        assert set(raw.columns) == {"DISTRICT", "FAREA", "BUITYPE", *(f"ONLY_{k}" for k in range(12))}
        got = []
        for r in raw.collect():
            only = [k for k in range(12) if r[f"ONLY_{k}"] is not None]
            assert [r[f"ONLY_{k}"] for k in only] == ["許功蓋"]
            got.append((r.DISTRICT, r.FAREA, r.BUITYPE, only[0]))
        assert sorted(got) == sorted(wanted)
        assert sorted(r.DISTRICT for r in rent_csv.read_rent_csv(spark, *paths, multi_line=True).collect()) == ["大安區"] * 480
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_csv_odd_files(spark, tmp_path):
    empty, only_header = write(tmp_path, "e.csv", "\n \n", "utf-8"), write(tmp_path, "h.csv", "A,B\n", "utf-8")
    raw = rent_csv.read_rent_csv(spark, empty, only_header)
    assert raw.columns == ["A", "B"] and raw.count() == 0
    with pytest.raises(FileNotFoundError):
        rent_csv.read_rent_csv(spark, empty)
    odd = write(tmp_path, "o.csv", "A,B,A,\n1,2,3,4,5\n6\nA,B,A,\n,\"\",null,x\n", "big5")
    rows = [tuple(r) for r in rent_csv.read_rent_csv(spark, odd).select("A", "B").collect()]
    assert sorted(rows, key=repr) == sorted([("1", "2"), ("6", None), ("A", "B"), (None, None)], key=repr)


def test_undecodable_files_are_named(spark, tmp_path):
    good = write(tmp_path, "good.csv", "A,B\n1,2\n", "utf-8")
    bad = []
    for k in range(7):
        path = tmp_path / f"bad {k}.csv"
        path.write_bytes(b"A,B\n1,2\n\xff\xff\xfe,1\n")
        bad.append(str(path))
    with pytest.raises(ValueError, match=r"cannot decode 7 files, .*bad \d\.csv"):
        rent_csv.read_rent_csv(spark, good, *bad)


def test_filter_errors(spark):
    df = spark.createDataFrame([("x",)], "CASE_T string")
    assert cleaning.rental_rows(df).isEmpty()
    with pytest.raises(ValueError, match="no rental row"):
        cleaning.rental_rows(df, require_rows=True)
    with pytest.raises(ValueError, match="no rental column"):
        cleaning.rental_rows(df.withColumnRenamed("CASE_T", "A"))


def test_missing_raw_columns_get_defaults(spark):
    df = spark.createDataFrame([("大安區", "10", "1.5")], "DISTRICT string, FAREA string, TPRICE string")
    row = cleaning.normalise(df).first()
    assert row.building_type == "unknown" and row.rent_total_ntd == 15000
    assert row.transaction_date is None and row.rent_per_ping_ntd is None
    assert rent_csv.with_columns(df).columns[3:] == [
        "BUITYPE", "UPRICE", "SDATE", "CASE_T", "CASE_F", "RENT_TYPE", "RENT_PERIOD", "ELEVATOR",
    ]


def test_normalise_transactions(spark):
    df = spark.createDataFrame(
        [("a", "b", "10", "20000", None, "2026-04-27", "3"), ("a", "b", "5", "9000", 1700.0, "2026-04-28", None)],
        "district string, building_type string, area_ping string, rent_total_ntd string, "
        "rent_per_ping_ntd double, transaction_date string, floor string",
    )
    first, second = cleaning.normalise_transactions(df).orderBy("transaction_date").collect()
    assert (first.rent_per_ping, first.floor, first.building_age_years) == (2000.0, 3, None)
    assert (second.rent_per_ping, second.floor) == (1700.0, None)
    assert first.source == "taipei_open_data_real_price_weekly"
    with pytest.raises(ValueError, match="transaction_date"):
        cleaning.normalise_transactions(df.drop("transaction_date"))


def test_load_job_and_null_check(spark, tmp_path):
    path = write(tmp_path, "r.csv", HEADER + ROWS, "utf-8")
    raw = rent_csv.read_rent_csv(spark, path)
    table = str(tmp_path / "table")
    told = jobs.clean_and_load(raw, str(tmp_path / "out"), table)
    assert (told["ingested"], told["districts"]) == (3, 3)
    rows = rent_csv.read_ingest_csv(spark, told["ingest_csv"])
    assert rows.columns[0] == "district" and rows.count() == 3
    assert warehouse.save_transactions(rows, table, replace=False) == 3
    assert documents.stored_rows(spark, table).count() == 6
    summary = metrics.transactions_summary(documents.stored_rows(spark, table)).first()
    assert summary.total_transactions == 6 and summary.districts == ["中山區", "信義區", "大安區"]
    with pytest.raises(Exception, match="district is missing"):
        warehouse.save_transactions(rows.selectExpr("* except (district)", "null as district"), table)


def test_csv_fields_with_quotes_commas_and_breaks(spark, tmp_path):
    cells = ['a "b", c', "back\\slash", "two\nlines", "plain"]
    df = spark.createDataFrame([(c, str(i)) for i, c in enumerate(cells)], "district string, area_ping string")
    files.write_csv(df, str(tmp_path / "q"))
    got = rent_csv.read_ingest_csv(spark, str(tmp_path / "q"), multi_line=True).collect()
    assert sorted((r.area_ping, r.district) for r in got) == [(str(i), c) for i, c in enumerate(cells)]
    one = tmp_path / "one.csv"
    one.write_text('DISTRICT,BUITYPE\n"a ""b"", c",x\n', encoding="utf-8")
    row = rent_csv.read_rent_csv(spark, str(one)).first()
    assert (row.DISTRICT, row.BUITYPE) == ('a "b", c', "x")
