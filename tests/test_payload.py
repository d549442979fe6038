"""Payload typing edge cases (FIXTURES §2 rows 1-11)."""

import json

import pytest
from pyspark.sql import functions as F

from tidepool.functions import payload as P

ROWS = {
    "detail_ok": {"source_mode": "html_fallback", "detail_status": "ok", "detail_title": "T",
                  "title": "card", "detail_employer": "E", "experience": "3 years",
                  "description": "desc", "skills": ["a", "b"], "url": "u"},
    "captcha": {"source_mode": "html_fallback", "detail_status": "captcha", "title": "card",
                "employer": "E2", "experience_card": "Опыт 1–3 года", "salary": "100"},
    "http": {"source_mode": "html_fallback", "detail_status": "http_404", "title": "x"},
    "no_status": {"source_mode": "html_fallback", "title": "x"},
    "api": {"name": "api title", "employer": {"name": "Nested"},
            "salary": {"from": 100, "to": 200, "currency": "RUR"},
            "experience": {"id": "between1And3"}, "alternate_url": "a"},
    "wrong_types": {"source_mode": "html_fallback", "employer": 5, "title": "",
                    "name": "fallback name", "detail_employer": None},
    "skills_mixed": {"skills": ["a", 5, None, "b", ""]},
    "skills_string": {"skills": "a"},
    "skills_null": {"skills": None},
    "salary_float": {"salary": {"from": 100.5, "to": "200"}},
    "unknown_mode": {"source_mode": "rss", "title": "x"},
}
RAW = {k: json.dumps(v, ensure_ascii=False) for k, v in ROWS.items()}
RAW["unparsable"] = "{not json"


@pytest.fixture(scope="module")
def staged(spark):
    df = spark.createDataFrame(list(RAW.items()), "case string, raw_json string")
    return {r["case"]: r for r in P.staging(df).collect()}


def test_quality_and_has_detail(staged):
    assert (staged["detail_ok"]["quality_score"], staged["detail_ok"]["has_detail"]) == (4, True)
    assert staged["captcha"]["quality_score"] == 3
    assert (staged["http"]["quality_score"], staged["http"]["has_detail"]) == (2, False)
    assert (staged["no_status"]["quality_score"], staged["no_status"]["has_detail"]) == (2, None)
    assert (staged["api"]["quality_score"], staged["api"]["has_detail"]) == (1, False)
    assert staged["unknown_mode"]["quality_score"] == 0


def test_coalesce_chain_priority(staged):
    r = staged["detail_ok"]
    assert (r["title"], r["employer_name"], r["experience"]) == ("T", "E", "3 years")
    assert staged["captcha"]["experience"] == "Опыт 1–3 года"
    assert staged["captcha"]["salary_text"] == "100"


def test_api_nested_and_objects_are_not_strings(staged):
    r = staged["api"]
    assert r["source_mode"] == "api"
    assert r["employer_name"] == "Nested"
    assert r["salary_text"] is None          # an object is not text
    assert r["experience"] is None
    assert (r["salary_from"], r["salary_to"], r["salary_currency"]) == (100, 200, "RUR")
    assert r["vacancy_url"] == "a"


def test_wrong_types_fall_through(staged):
    r = staged["wrong_types"]
    assert r["employer_name"] is None
    assert r["title"] == "fallback name"


def test_unparsable(staged):
    r = staged["unparsable"]
    assert r["source_mode"] == "api" and r["title"] is None and r["skills"] == []


def test_skills_policy(staged):
    assert staged["detail_ok"]["skills"] == ["a", "b"]
    assert staged["skills_mixed"]["skills"] == ["a", "b", ""]
    assert staged["skills_string"]["skills"] == []
    assert staged["skills_null"]["skills"] == []
    assert staged["http"]["skills"] == []


def test_strict_integers(staged):
    r = staged["salary_float"]
    assert (r["salary_from"], r["salary_to"]) == (None, None)


def test_byte_length_decides_best_row(spark):
    from tidepool.operators.silver import best_row, best_row_fused
    rows = [("s", "v", json.dumps({"source_mode": "html_fallback", "detail_status": "ok",
                                   "description": d}, ensure_ascii=False), "msk", p)
            for p, d in enumerate(["abcd", "жжжж"])]
    df = P.staging(spark.createDataFrame(rows, "snapshot_id string, vacancy_id string, "
                                         "raw_json string, search_area string, page_num int"))
    assert {r["description"]: r["description_length"] for r in df.collect()} == {"abcd": 4, "жжжж": 8}
    order = ["quality_score", "description_length", "page_num"]
    w1 = best_row(df, ["snapshot_id", "vacancy_id"], order).collect()
    w2 = best_row_fused(df, ["snapshot_id", "vacancy_id"], order, ["description"],
                        {"matched_areas": "search_area"}).collect()
    assert w1[0]["description"] == w2[0]["description"] == "жжжж"


def test_ordered_pattern_and_markers(spark):
    from tidepool.functions import text as X
    df = spark.createDataFrame([("Без опыта, Опыт 3–6 лет, Гибрид, Полный день",), ("",)], "t string")
    r = df.select(X.first_match("t").alias("e"), X.markers("t").alias("m")).collect()
    assert r[0]["e"] == "Опыт 3–6 лет"          # list order wins over position
    assert r[0]["m"] == "Гибрид, Полный день"
    assert r[1]["e"] is None and r[1]["m"] is None


def test_url_helpers(spark):
    from tidepool.functions import text as X
    df = spark.createDataFrame([("https://x.ru/vacancy/123?from=a",), ("https://x.ru/a/b?c=1",)], "u string")
    r = df.select(X.id_from_url("u").alias("i"), X.canonical_url("u", "https://jobs.example.com/").alias("c"),
                  X.resolve_url(F.lit("/p"), F.col("u")).alias("abs"),
                  X.resolve_url(F.lit("q"), F.col("u")).alias("rel")).collect()
    assert (r[0]["i"], r[0]["c"]) == ("123", "https://jobs.example.com/vacancy/123")
    assert (r[1]["i"], r[1]["c"]) == ("https://x.ru/a/b?c=1", "https://x.ru/a/b")
    assert r[1]["abs"] == "https://x.ru/p" and r[1]["rel"] == "https://x.ru/a/q"
