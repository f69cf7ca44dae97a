import pytest
from pyspark.sql import functions as F

from tidegate.functions import rules
from tidegate.functions.dates import elapsed_units
from tidegate.functions.text import blank_to_null, landing_directory, stage_table_name
from tidegate.sources.reference_lists import read_json_list

ROLES = list(rules.ROLE_NAMES)


def flags(spark, **fields):
    schema = ", ".join(f"{c} string" for c in ROLES)
    df = spark.createDataFrame([tuple(fields.get(c) for c in ROLES)], schema)
    return rules.with_flags(df).first().asDict()


@pytest.mark.parametrize(
    "fields, flag, value",
    [
        ({"email": None}, "email_flag", 0),
        ({"email": "contest@x.org"}, "email_flag", 1),
        ({"email": "JOE@EXAMPLE.ORG"}, "email_flag", 1),
        ({"email": "joe@mail.org"}, "email_flag", 0),
        ({"phone": "9115551234"}, "phone_flag", 0),
        ({"phone": "911"}, "phone_flag", 1),
        ({"phone": "0000000000"}, "phone_flag", 1),
        ({"first_name": "Mickey"}, "name_flag", 1),
        ({"first_name": None, "last_name": "Mouse"}, "name_flag", 1),
        ({"first_name": None, "last_name": "Smith"}, "name_flag", 0),
        ({"date_of_birth": "1/1/1900"}, "dob_flag", 1),
        ({"date_of_birth": "1/1/19001"}, "dob_flag", 0),
        ({"address": "9 Unknown Rd"}, "address_flag", 1),
        ({"address": "N/A"}, "address_flag", 1),
        ({"zip_code": "00000"}, "zip_flag", 1),
        ({"zip_code": "0"}, "zip_flag", 0),
        ({"company_name": "DemoCorp"}, "company_flag", 1),
    ],
)
def test_flags(spark, fields, flag, value):
    assert flags(spark, **fields)[flag] == value


def test_score_is_the_sum(spark):
    out = flags(spark, email="a@test.com", phone="411", first_name="Demo", zip_code="12345")
    assert out["synthetic_score"] == 4 == sum(out[f] for f in rules.FLAGS)


def test_roles_found_in_file_order():
    assert rules.find_roles(["Customer_ID", "FIRST", "firstname", "postal", "zip"]) == {"first_name": "FIRST", "zip_code": "postal"}


def test_missing_role_still_scored(spark):
    df = spark.createDataFrame([(1, "a@test.com")], "customer_id int, email string")
    row = rules.with_flags(df).first()
    assert (row["email_flag"], row["phone_flag"], row["synthetic_score"]) == (1, 0, 1)


def test_given_mapping_wins(spark):
    df = spark.createDataFrame([("911", "x")], "contact string, phone string")
    row = rules.with_flags(df, {"contact": "phone"}).first()
    assert row["phone_flag"] == 1 and row["phone"] == "x"


def test_numbers_compare_as_text(spark):
    df = spark.createDataFrame([(911, 12345)], "phone long, zip_code int")
    row = rules.with_flags(df).first()
    assert (row["phone_flag"], row["zip_flag"]) == (1, 1)


def test_hybrid_score(spark):
    df = spark.createDataFrame([("Ann", "01794"), ("ann", "1794"), (None, None)], "first_name string, zip_code string")
    names = spark.createDataFrame([("Ann",), ("Ann",), (None,)], "n string")
    zips = spark.createDataFrame([("01794",)], "z string")
    out = rules.with_valid_flags(rules.with_flags(df), names, zips).collect()
    assert sorted((r["first_name"] or "", r["valid_name_flag"], r["valid_zip_flag"], r["hybrid_score"]) for r in out) == [
        ("", 0, 0, 0), ("Ann", 1, 1, 2), ("ann", 0, 0, 0),
    ]


def test_labels_and_marks(spark):
    df = spark.createDataFrame([(0,), (1,), (None,)], "label int")
    out = df.select("label", rules.binary_label(F.col("label")).alias("s"), rules.binary_label(F.col("label"), "real").alias("r"))
    assert {r["label"]: (r["s"], r["r"]) for r in out.collect()} == {0: (0, 1), 1: (1, 0), None: (1, 0)}
    with pytest.raises(ValueError):
        rules.binary_label(F.col("label"), "maybe")
    marks = df.filter("label IS NOT NULL").select("label", rules.real_mark(F.col("label")), rules.real_mark(F.col("label"), "real"))
    assert {tuple(r) for r in marks.collect()} == {(0, "Y", "N"), (1, "N", "Y")}


def test_score_rounds_half_up(spark):
    df = spark.createDataFrame([(0.025,), (0.995,), (1.0,)], "c double")
    assert [round(r[0], 1) for r in df.select(rules.customer_score(F.col("c"))).collect()] == [0.3, 10.0, 10.0]
    texts = df.limit(1).select(*[c.alias(n) for n, c in rules.display_columns(F.col("c")).items()]).first()
    assert tuple(texts) == ("0.0250000000", "0.25")


def test_stage_table_name(spark):
    df = spark.createDataFrame([("stg_x", 1), ("stg_x", 12345678)], "s string, id long")
    assert [r[0] for r in df.select(stage_table_name(F.col("s"), F.col("id"))).collect()] == ["STG_X_0000001", "STG_X_2345678"]


@pytest.mark.parametrize(
    "frequency, since, until, units",
    [
        ("DAILY", "2001-01-01 23:00", "2001-01-02 01:00", 0),
        ("daily", "2001-01-01 01:00", "2001-01-02 01:00", 1),
        ("Weekly", "2001-01-01 00:00", "2001-01-14 23:59", 1),
        ("MONTHLY", "2001-01-31 00:00", "2001-02-28 00:00", 0),
        ("MONTHLY", "2001-01-31 00:00", "2001-03-31 00:00", 2),
        ("QUARTERLY", "2001-01-15 00:00", "2001-07-15 00:00", 2),
        ("YEARLY", "2001-01-01 00:00", "2009-01-01 00:00", None),
    ],
)
def test_elapsed_units(spark, frequency, since, until, units):
    df = spark.range(1).select(elapsed_units(F.lit(frequency), F.to_timestamp_ntz(F.lit(since + ":00")), F.to_timestamp_ntz(F.lit(until + ":00"))))
    assert df.first()[0] == units


def test_text_helpers(spark):
    df = spark.createDataFrame([(" None ",), ("n/a",), ("NA",), ("",), ("x",), (None,)], "t string")
    assert [r[0] for r in df.select(blank_to_null(F.col("t"))).collect()] == [None, None, None, None, "x", None]
    paths = ["abfss://lake/Files/a/b/f.csv", "/lake/Files/f.csv", "/Files/x/Files/f.csv"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    assert [r[0] for r in df.select(landing_directory(F.col("p"))).collect()] == ["/Files/a/b", "/Files", "/Files/x/Files"]


def test_json_list(spark, tmp_path, rows):
    path = tmp_path / "names.json"
    path.write_text('["Ann",\n "Bob", "Ann", null]')
    assert rows(read_json_list(spark, str(path), "name")) == [("Ann",), ("Bob",)]
