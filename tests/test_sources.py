"""CSV layouts, round trips through the sinks, and the streaming form."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from metaferry.operators import profiling
from metaferry.sources import sinks, tables
from metaferry.streaming import status


def write(tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_pairs_and_single(spark, tmp_path, rows):
    path = write(tmp_path, "map.csv", 'source-env,target-env\n"ledger-PROD_DB", ledger-DEV_DB\n a ,\nonly\n,b\n"x\ny","p,""q"""\n')
    assert rows(tables.read_pairs(spark, path)) == [("ledger-PROD_DB", "ledger-DEV_DB"), ("x\ny", 'p,"q"')]
    assert rows(tables.read_single(spark, path)) == [("a",), ("ledger-PROD_DB",), ("only",), ("x\ny",)]
    empty = write(tmp_path, "empty.csv", "source-env,target-env\n")
    assert rows(tables.read_pairs(spark, empty)) == []


def test_mapping_with_and_without_type(spark, tmp_path, rows):
    five = write(tmp_path, "five.csv", "source_id,source_uid,target_id,target_uid,tags\n1,s1,11,t1,tag\n2,s2,12,t2,\n")
    assert rows(tables.read_mapping(spark, five), "source_id") == [("1",)]
    six = write(tmp_path, "six.csv", "source_id,source_uid,target_id,target_uid,tags,type\n1,s1,11,t1,,VIEW\n2,s2,12,t2,,COLUMN\n")
    assert rows(tables.read_mapping(spark, six), "source_id") == [("1",)]


def test_ordinals_follow_the_file(spark, tmp_path):
    path = write(tmp_path, "o.csv", "k,v\n" + "".join(f"a,{n}\n" for n in range(500)))
    got = tables.read_ordered(spark, path).orderBy("ordinal").collect()
    assert [int(r.v) for r in got] == list(range(500))


@pytest.mark.parametrize(
    "text,source",
    [
        ('target_uid,config_json\nu1,"{""a"":1}"\n ,x\nu2,\n', "Unknown"),
        ('target_uid,config_json,source_uid\nu1,"{""a"":1}",s1\n', "s1"),
        ('u1,"{""a"":1}"\n', "Unknown"),
        ('target_uid,config_json,profile_anomaly_json,a,b,source_uid\nu1,"{""a"":1}",{},{},{},s1\n', "s1"),
    ],
)
def test_config_layouts(spark, tmp_path, rows, text, source):
    found = tables.read_config_rows(spark, write(tmp_path, "c.csv", text))
    assert rows(found, "target_uid", "config_json", "source_uid") == [("u1", '{"a":1}', source)]


def test_required_header(spark, tmp_path, rows):
    path = write(tmp_path, "h.csv", "target-env,segments_json\nu,{}\n")
    assert rows(tables.read_checked(spark, path, ["target-env", "segments_json"])) == [("u", "{}")]
    with pytest.raises(ValueError):
        tables.read_checked(spark, path, ["target-env", "profile_json"])


def test_policy_list_rows_have_the_width_of_the_header(spark, tmp_path, rows):
    path = write(tmp_path, "p.csv", 'id,type,names\n1,A,"x,y"\n2,B\n3,C,z,extra\n4,D,w\n')
    found = tables.read_policy_list(spark, path, ["id", "type", "names"])
    assert rows(found, "id", "names") == [("1", "x,y"), ("4", "w")]
    assert [r.id for r in found.orderBy("ordinal").collect()] == ["1", "4"]


def test_quoted_csv_round_trip(spark, tmp_path, rows):
    data = [("a,b", 'q"q', None, 1), ("line\nbreak", "", "é", 2)]
    df = spark.createDataFrame(data, "x string, y string, z string, n int")
    path = str(tmp_path / "out")
    sinks.write_quoted_csv(df.coalesce(1), path)
    text = "".join(r.value for r in spark.read.text(path, wholetext=True).collect())
    assert text.startswith('"x","y","z","n"') and '"a,b","q""q","","1"' in text
    back = tables.read_headed(spark, path).fillna("")
    assert rows(back) == [("a,b", 'q"q', "", "1"), ("line\nbreak", "", "é", "2")]


def test_tag_sinks(spark, tmp_path, rows):
    enriched = spark.createDataFrame(
        [(1, "a,b", 5, 7, "uid", "name", "place")],
        "tag_id int, tag_name string, asset_id int, assembly_id int, asset_uid string, asset_name string, assembly_name string",
    )
    path = str(tmp_path / "tags")
    sinks.write_csv(sinks.tag_list(enriched), path, sinks.TAG_COLUMNS)
    assert rows(tables.read_headed(spark, path)) == [("1", "a,b")]
    assert sinks.enriched_tags(enriched).columns == list(sinks.ENRICHED_TAG_COLUMNS)


def test_documents_sink(spark, tmp_path, rows):
    df = spark.createDataFrame([("b1", "m1", '{"a":"é"}'), ("b1", "m2", "1\n"), ("b2", "m1", "[1]")], "bundle string, member string, text string")
    path = str(tmp_path / "docs")
    sinks.write_documents(df, path)
    assert rows(spark.read.parquet(path), "bundle", "member", "text") == rows(df)


def test_status_stream_equals_batch(spark, tmp_path, rows):
    events = spark.createDataFrame(
        [(n % 7, ["running", "SUCCESS", "failed"][n % 3], n) for n in range(100)], "asset_id long, status string, ts long"
    )
    folder = str(tmp_path / "log")
    events.repartition(5).write.parquet(folder)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    query = status.watch_status(stream, str(tmp_path / "checkpoint"), "states")
    query.processAllAvailable()
    query.stop()
    assert rows(spark.table("states")) == rows(profiling.latest_status(events))


def test_headless_values_stay_text(spark, tmp_path, rows):
    path = write(tmp_path, "n.csv", "id,x\n007,1.50\n")
    assert rows(tables.read_headed(spark, path).select(F.concat("id", "x"))) == [("0071.50",)]


def test_order_over_a_folder_follows_the_paths(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a b.csv").write_text("x\nfirst\n")
    (tmp_path / "b.csv").write_text("x\n" + "".join(f"b{k}\n" for k in range(3000)))
    (tmp_path / "sub" / "c.CSV").write_text("x\nlast\n")
    (tmp_path / "note.txt").write_text("x\nno\n")
    found = [row.x for row in tables.read_ordered(spark, str(tmp_path), recursive=True).orderBy("ordinal").collect()]
    assert found == ["first", *[f"b{k}" for k in range(3000)], "last"]
