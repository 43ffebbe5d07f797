"""Decoding lines to the fields that are asked for gives what the map of all fields gives."""

from pyspark.sql import functions as F

ODD = [
    "", " a=1 ", ":", " :a=1", "name=x::y=1", "x::y=1", "start=b:c::d=e", "start=b:::", "name=b::::c", "start=b:c::", "start=:name=", "=v", "start=1:b", "start=\x01:name=2", "start=\x7f:name=2::3", "start= x :name =y",
    "name=v=w:name=z::", "start=b::c=d", "::=::", 'start=a"b:name=\\n', "start=a\tb:name=　x", "name =1:start=2", "name=1:start=2:end=3", "name=1:name=2:start=:start=4:time=5", "hash=h:name=1:start=2:end=3",
    "type=t:name=1:start=2:time=3:v=�é", "name==1:start:end=3", "name=1==2:start:=:end=3", "a=1==2:b", "name=x:y:start=2", "name=1:start=2:end=3:", "name=1:start=2:end=3::", "name=1:start=2:end= ", "a:name=1",
]


def test_fields_of_odd_lines(spark):
    from loamline.operators import parse

    wanted = ["name", "start", "end", "time", "type", "v", "a", "b"]
    lines = spark.createDataFrame([(k, line, "cao") for k, line in enumerate(ODD)], "k int, line string, src string")
    want = parse.marked(lines).select("k", "hash", "cause", *[F.col("fields")[w].alias(w) for w in wanted])
    got = parse.decoded(lines, wanted).select("k", "hash", "cause", *[F.col("__f")[w].alias(w) for w in wanted])
    assert sorted(map(tuple, got.collect()), key=lambda r: r[0]) == sorted(map(tuple, want.collect()), key=lambda r: r[0])
    plan = parse.decoded(lines, wanted)._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json" in plan


def test_long_rules_are_cut_into_methods_that_are_compiled(spark):
    from loamline.sources import workspace

    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    with workspace.compiled(spark):
        assert int(spark.conf.get(name)) == 8000
    assert spark.conf.get(name) == before


def test_normalized_lines_go_by_no_map_of_all_fields(spark, monkeypatch):
    from loamline.plans import records

    before = records.normalize.normalized(records.records(spark, "/root/testdata/sf0.001"), records.BOOK, ("i", "src", "hash"))
    monkeypatch.setattr(records, "records", None)
    got = records.normalize_log(spark, "/root/testdata/sf0.001")
    want = before.select(*got.columns)
    assert got.count() > 0 and got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
