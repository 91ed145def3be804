"""Readers, dictionaries and writers on files in temporary folders."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from signalweave import session
from signalweave.catalog import files
from signalweave.sources import dictionaries as D
from signalweave.sources import readers as R
from signalweave.sources import schemas as S
from signalweave.sources import writers as W

HEADER = "created_at,lang,id,text_processed,negative,netural,positive,label,Country\n"


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_csv_folder_with_category_and_malformed_rows(spark, tmp_path):
    write(tmp_path / "posts" / "nonmarket_2020.csv", HEADER + "2020-01-01,en,1,\"a, \"\"b\"\"\nc\",0,0,1,2,\"['x']\"\n2020,en,2,t,0,0,1,2,[],surplus\n")
    write(tmp_path / "posts" / "market_2020.csv", HEADER + "2020-01-02,en,3,t,1,0,0,0,[]\n")
    write(tmp_path / "posts" / "deep" / "market_2021.csv", HEADER + "2021-01-02,en,4,t,1,0,0,0,[]\n")
    write(tmp_path / "posts" / "deep" / "notes.txt", "no")
    flat = R.read_csv(spark, str(tmp_path / "posts"), S.SENTIMENT_POSTS).withColumn("category", R.category_from_file())
    assert {(r.id, r.category, r.text_processed) for r in flat.collect()} == {("1", "nonmarket", 'a, "b"\nc'), ("3", "market", "t")}
    deep = R.read_csv(spark, str(tmp_path / "posts"), S.SENTIMENT_POSTS, recursive=True, suffix=".csv")
    assert {r.id for r in deep.collect()} == {"1", "3", "4"}
    named = R.read_csv(spark, str(tmp_path / "posts" / "*.csv"), S.SENTIMENT_POSTS).select(R.name_part("market_").alias("y")).distinct()
    assert {r.y for r in named.collect()} == {"2020"}


def test_result_pages(spark, tmp_path):
    pages = [
        {"data": [{"id": "1", "text": "a", "public_metrics": {"reply_count": 2}, "referenced_tweets": [{"type": "quoted", "id": "9"}]},
                  {"id": "2", "text": "b"}], "meta": {"result_count": 2, "next_token": "n"}},
        {"meta": {"result_count": 0}},
    ]
    path = write(tmp_path / "pages.json", "\n".join(map(json.dumps, pages)))
    rows = R.read_result_pages(spark, path).collect()
    assert [(r.id, r.public_metrics and r.public_metrics.reply_count) for r in rows] == [("1", 2), ("2", None)]
    assert R.total_results(spark, path).first().total_count == 2


def test_gazetteer(spark, tmp_path):
    xml = (
        "<root><Country><CountryName>Cote_dIvoire</CountryName><Nationality>Ivorian\nIvorians</Nationality><Capital></Capital>"
        "<MajorCities>\nAbidjan\nSan_Pedro\n</MajorCities></Country><Country><CountryName>Iran</CountryName></Country></root>"
    )
    gazetteer = R.read_gazetteer(spark, write(tmp_path / "g.xml", xml))
    assert D.gazetteer_groups(gazetteer) == {
        "cote divoire": ["cote divoire", "ivorian", "ivorians", "abidjan", "san pedro"], "iran": ["iran"],
    }


def test_text_documents(spark, tmp_path):
    write(tmp_path / "docs" / "d1.v2.txt", "First 12 line\nHEADER x\nDownload skip me\nlast\n")
    docs = R.read_text_documents(spark, str(tmp_path / "docs"), boilerplate=("HEADER",), stop_phrases=("skip",))
    (row,) = docs.collect()
    assert row.doc_id == "d1" and row.paras == ["First line", " x", "last"]


def test_ids_and_accounts(spark, tmp_path):
    path = write(tmp_path / "meta.csv", "a,b,c,file id\n1,2,3,x\n4,5,6,y\n")
    assert {r.doc_id for r in R.read_ids(spark, path).collect()} == {"x", "y"}
    path = write(tmp_path / "acc.csv", "Name,n\n ann ,1\nann,2\n,3\nbob,4\n")
    assert {r.username for r in R.read_accounts(spark, path).collect()} == {"ann", "bob"}


def test_keyword_sheets(spark, tmp_path):
    path = write(tmp_path / "keys.csv", "﻿market,nonmarket\n Tax ,codes\n,standards\n Levy ,\n")
    assert D.keyword_groups(D.read_keyword_sheet(spark, path)) == {"market": ["Tax", " Levy "], "nonmarket": ["codes", "standards"]}
    lowered = D.read_search_sheet(spark, path, sheet="s", clean_keys=lambda k: F.trim(k))
    groups = D.keyword_groups(lowered)
    assert groups == {"market": ["tax", "levy"], "nonmarket": ["codes", "standards"]}
    assert D.all_keywords(groups | {"more": ["tax"]}) == ["tax", "levy", "codes", "standards"]
    assert lowered.select("sheet").distinct().first().sheet == "s"


def test_large_sheets_are_refused(spark):
    with pytest.raises(ValueError, match="more than"):
        D.keyword_groups(spark.range(D.MAX_ENTRIES + 1).selectExpr("'g' AS group", "id AS pos", "'k' AS keyword"))


def test_rule_sheets(spark, tmp_path):
    write(tmp_path / "rules" / "tax.csv", "anchor,include,exclude\nCarbon Tax,Energy | fuel||,\n,x,y\nlevy,,Import\ncarbon tax,Coal,\n")
    write(tmp_path / "rules" / "README.csv", "anchor,include,exclude\nnot,a,policy\n")
    book = D.rulebook(D.read_rule_sheet(spark, str(tmp_path / "rules")))
    assert book == {"tax": [D.Rule("carbon tax", ("coal",)), D.Rule("levy", (), ("import",))]}
    cased = D.rulebook(D.read_rule_sheet(spark, str(tmp_path / "rules" / "tax.csv"), policy="p", lower=False), join_anchor=True)
    assert [r.anchor for r in cased["p"]] == ["Carbon_Tax", "levy", "carbon_tax"]


def test_country_map_with_byte_order_mark(spark, tmp_path):
    path = write(tmp_path / "map.csv", "﻿2_Code,Identified_Country_Name,3_Code,Country_Code,IMF_Country_Name\nIR,iran,IRN,429,\"Iran, I.R. of\"\n")
    assert R.read_csv(spark, path, S.COUNTRY_MAP).first().asDict()["IMF_Country_Name"] == "Iran, I.R. of"


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([("p", 2020, "é, \"x\"", {"a": 1}), ("q", 2021, "b", None)], "policy STRING, year INT, v STRING, m MAP<STRING, INT>")
    W.write_table(df, str(tmp_path / "t"), ["policy", "year"])
    assert (tmp_path / "t" / "policy=p" / "year=2020").is_dir()
    back = spark.read.parquet(str(tmp_path / "t"))
    assert back.filter("policy = 'p'").first().v == 'é, "x"' and back.count() == 2
    W.write_table(df, str(tmp_path / "plain"))
    assert spark.read.parquet(str(tmp_path / "plain")).count() == 2
    W.write_csv(df.drop("m"), str(tmp_path / "csv"), one_file=True)
    again = R.read_csv(spark, str(tmp_path / "csv"), "policy STRING, year INT, v STRING")
    assert {r.v for r in again.collect()} == {'é, "x"', "b"}
    dated = W.add_year(spark.createDataFrame([("2020-05-01",)], "time STRING").withColumn("time", F.to_date("time")))
    assert dated.first().year == 2020


def test_failed_ids(spark):
    requested = spark.createDataFrame([("1",), ("2",), ("2",), ("3",)], "id STRING")
    result = spark.createDataFrame([("1",), ("1",)], "id STRING")
    assert sorted(r.id for r in W.without_result(requested, result).collect()) == ["2", "3"]


def test_pages_are_gathered_in_tasks_of_bounded_rows(spark, tmp_path, monkeypatch):
    """The rows of a task do not follow the number of shuffle partitions, and rows without a customer stay out."""
    monkeypatch.setattr(session, "ROWS_A_TASK", 100)
    order = ("id AS o_orderkey", "IF(id % 10 = 9, NULL, id % 37) AS o_custkey", "'p' AS o_orderpriority", "DATE'2020-01-01' AS o_orderdate")
    spark.range(3000).selectExpr(*order).write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(40).selectExpr("IF(id = 39, NULL, id) AS c_custkey").write.parquet(f"{tmp_path}/customer.parquet")
    pages = spark.read.json(files._pages(spark, str(tmp_path))).select("*", F.input_file_name().alias("file"))
    rows = pages.groupBy("file").agg(F.sum("meta.result_count").alias("n")).collect()
    assert sum(r["n"] for r in rows) == 2700 and max(r["n"] for r in rows) <= 300
    assert pages.filter("meta.result_count = 0").count() == 3
    assert files.announced_results(spark, str(tmp_path)).collect()[0][0] == 2700
