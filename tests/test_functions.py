from datetime import date

import pytest
from pyspark.sql import functions as F

from casemart import functions as fn
from casemart.functions.names import DENOMINATOR_RULES
from casemart.operators.columns import standardize_by_table


def apply(spark, function, values, kind="string"):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, raw {kind}")
    return [row.out for row in frame.orderBy("i").select(function(F.col("raw")).alias("out")).collect()]


def test_numbers_accept_separators_and_reject_text(spark):
    texts = ["1,234", " 12.50 ", "abc", "-3", "1 000", "", None, "1.", "1e3", "٣"]
    assert apply(spark, fn.to_numeric, texts) == [1234.0, 12.5, None, -3.0, 1000.0, None, None, None, None, None]


def test_years_move_to_the_buddhist_calendar_once(spark):
    assert apply(spark, fn.buddhist_year, ["2025", "2568", "1900", "2200", "2201", "x", None, "99999999999"]) == [
        2568, 2568, 2443, 2743, 2201, None, None, None]


def test_dates_in_both_calendars_and_three_shapes(spark):
    texts = ["1/6/2025", "01-06-2568", "2025-06-01", "2025/06/01", "2025-06-01 10:00:00", "31/2/2025", "29/2/2567",
             "2025-1-6", "2025-13-01", "x", "", None]
    expected = [date(2025, 6, 1)] * 5 + [None, date(2024, 2, 29)] + [None] * 5
    assert apply(spark, fn.parse_report_date, texts) == expected


def test_district_spellings(spark, domain):
    texts = ["เขตบางกะปิ", "ข. ลาดพร้าว", "ป้อมปราบฯ กทม.", "เขตดินเเดง", "วัังทองหลาง", "ป้อมปราบ ศัตรูพ่าย", "บางเเค",
             "บางรัก กรุงเทพมหานคร", None]
    assert apply(spark, domain.district, texts) == [
        "บางกะปิ", "ลาดพร้าว", "ป้อมปราบศัตรูพ่าย", "ดินแดง", "วังทองหลาง", "ป้อมปราบศัตรูพ่าย", "บางแค", "บางรัก", None]


def test_denominator_spellings_also_drop_the_local_office(spark):
    texts = ["ท้องถิ่นเขตบางรัก", "﻿เขต ดุสิต ", "ป้อมปราบ"]
    assert apply(spark, lambda c: fn.standardize_name(c, DENOMINATOR_RULES), texts) == [
        "บางรัก", "ดุสิต", "ป้อมปราบศัตรูพ่าย"]


def test_disease_spellings(spark, domain):
    texts = ["โรคไข้เลือดออก", "Dengue Fever", "COVID-19", "โควิด-19 (COVID-19)", "ติดเชื้อไวรัสโคโรนา 2019 (covid-19)",
             "ไข้เลือดออกช็อค (DSS)", "Pneumonia", "อุจจาระร่วง", " Something Else "]
    assert apply(spark, domain.disease, texts) == [
        "ไข้เลือดออก", "ไข้เลือดออก", "โควิด-19", "โควิด-19", "โควิด-19", "ไข้เลือดออก", "ปอดบวม", "อุจจาระร่วงเฉียบพลัน",
        "Something Else"]


def test_sex_codes(spark, domain):
    assert apply(spark, domain.sex, ["ชาย", "Female", "ไม่ระบุ", None, " 2 ", "M"]) == ["M", "F", "U", "U", "F", "M"]


def test_age_band_edges(spark, domain):
    ages = [0.0, 4.0, 4.9, 5.0, 14.0, 15.0, 64.0, 65.0, 98.0, None, -1.0]
    assert apply(spark, domain.age_band, ages, "double") == [1, 1, 1, 2, 3, 4, 8, 9, 9, 10, 10]


def test_month_labels_and_rates(spark):
    row = spark.range(1).select(
        fn.month_label(F.lit(1), F.lit(2568)).alias("january"), fn.month_label(F.lit(13), F.lit(2568)).alias("none"),
        fn.month_key(F.lit(date(2025, 3, 9))).alias("key"),
        fn.incidence(F.lit(3), F.lit(150_000)).alias("rate"), fn.incidence(F.lit(3), F.lit(0)).alias("no_rate"),
        fn.safe_ratio(F.lit(1), F.lit(0)).alias("ratio"),
    ).first()
    assert tuple(row) == ("ม.ค. 2568", None, 202503, 2.0, None, None)


def test_alias_dicts_and_tables_of_any_size_agree(spark, rows):
    aliases = {f"Spelling {i}": f"name{i % 7}" for i in range(500)}
    data = spark.createDataFrame([(f" spelling-{i}",) for i in range(0, 900, 90)] + [(None,)], "raw string")
    table = spark.createDataFrame(list(aliases.items()) + [(None, "nothing")], "spelling string, name string")
    by_table = standardize_by_table(data, "raw", table, "name")
    assert rows(by_table) == rows(data.withColumn("name", fn.standardize_alias(F.col("raw"), aliases)))
    assert by_table.where("name = 'name6'").count() == 1
