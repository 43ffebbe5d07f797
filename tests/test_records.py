"""Decoding, single expressions, scans and deduplication on small inputs."""

import pytest
from pyspark.sql import functions as F


def one(spark, rows, column, use):
    df = spark.createDataFrame([(r,) for r in rows], f"{column} string")
    return [r[0] for r in df.select(use(F.col(column))).collect()]


def test_decoding(spark):
    from loamline.operators import parse

    lines = {"  cow =moo ": {"cow": "moo"}, "place=D::::$:br=D": {"place": "D::$", "br": "D"}, "a=b:::c=d": {"a": "b:", "c": "d"}, "a=b::": {"a": "b:"}, "a=b:": {"a": "b"}, "a=x=y:b=": {"a": "x=y", "b": ""}, "a=1:a=2": {"a": "2"}, "a=b:c:d=e": {"a": "b", "c:d": "e"}, "": {}}
    assert one(spark, list(lines), "l", parse.fields_of) == list(lines.values())
    assert one(spark, ["cow:boy", "moo=foo:cow", "a=b"], "l", parse.malformed) == [True, True, False]


def test_version_numbers(spark):
    from loamline.functions import version

    known = {"0.1.7": 100799000000, "0.8.0-a0": 800001000000, "0.8.0-rc1": 800018010000, "0.9": 900099000000, "0.10.4": 1000499000000}
    assert one(spark, list(known), "v", version.number) == list(known.values())
    order = one(spark, ["0.15.0", "0.15.0-9-gabc", "0.15.0-34-gabc", "0.15.1"], "v", version.number)
    assert order == sorted(order)


def test_killers(spark):
    from loamline.functions import killer

    known = {"a two-headed hydra": "a hydra", "Bob's ghost": "a player ghost", "a red draconian": "a draconian", "an ugly thing": "an ugly thing", "a rat (shapeshifter)": "a shapeshifter"}
    assert one(spark, list(known), "k", killer.rewritten) == list(known.values())
    assert one(spark, ["spectral rat", "spectral warrior", "a bat skeleton"], "k", killer.modifier) == ["spectre", "", "skeleton"]


def test_scan_offsets_and_resume(spark, tmp_path):
    from loamline.sources import xlog

    data = "a=1\r\n\nä=2\nb=3\nhalf".encode()
    (tmp_path / "f").write_bytes(data)
    for split in (3, 5, 1000):
        rows = {(r.offset, r.line.rstrip("\r")) for r in xlog.scan(spark, str(tmp_path), splitBytes=split).collect()}
        assert rows == {(0, "a=1"), (6, "ä=2"), (11, "b=3")}
    rows = xlog.scan(spark, str(tmp_path), offsets='{"%s": 6}' % (tmp_path / "f")).collect()
    assert [(r.offset, r.line) for r in rows] == [(11, "b=3")]
    with pytest.raises(Exception, match="shrunk"):
        xlog.scan(spark, str(tmp_path), offsets='{"%s": 600}' % (tmp_path / "f")).collect()


def test_dedup(spark):
    from loamline.operators import tables

    batch = spark.createDataFrame([("abc", "f", 1), ("def", "f", 2), ("abc", "f", 3), ("xyz", "f", 4)], "hash string, file string, offset bigint")
    kept = tables.first_of_hash(batch)
    assert sorted(r.offset for r in kept.collect()) == [1, 2, 4]
    assert tables.not_known(batch, kept).count() == 0


def test_tail_appends(spark, tmp_path):
    from loamline.streaming import tail

    (tmp_path / "in").mkdir()
    f, out, point = tmp_path / "in" / "f", str(tmp_path / "out"), str(tmp_path / "point")
    f.write_text("a=1\nhal")
    tail.caught_up(spark, str(tmp_path / "in"), out, point)
    with f.open("a") as x:
        x.write("f=2\nb=3\n")
    tail.caught_up(spark, str(tmp_path / "in"), out, point)
    assert sorted(r.line for r in spark.read.parquet(f"{out}/batch=*").collect()) == ["a=1", "b=3", "half=2"]


def test_entry_without_the_optional_part():
    import __spark_entry__

    assert __spark_entry__._optional("loamline.llm.queries_that_are_gone") is None


def test_queries_are_listed_without_a_session():
    import subprocess
    import sys
    from pathlib import Path

    code = "import __spark_entry__ as e; print(set(e.oracle_sql()) <= set(e.queries()))"
    got = subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).resolve().parents[1], capture_output=True, text=True, timeout=120)
    assert got.stdout.strip() == "True", got.stderr


def test_one_file_a_source_is_written_by_ranges(spark, tmp_path):
    """In order, whatever the number of ranges that are sorted apart; one without rows of a source changes nothing."""
    from loamline.plans import records
    from loamline.sources import xlog

    rows = spark.createDataFrame([("ab"[k % 7 > 4], (k * 37) % 101, f"line {(k * 37) % 101}") for k in range(101)], "src string, i bigint, value string").repartition(5)
    records.one_file_each(spark, rows, "i", str(tmp_path / "out"), most=9)
    want = {s: [r.value for r in rows.where(F.col("src") == s).orderBy("i").collect()] for s in "ab"}
    files = list(xlog.listed(str(tmp_path / "out")))
    assert len(files) == 2
    assert {f.split("src=")[1][0]: open(f).read().splitlines() for f in files} == want


def test_malformed_lines_are_told_without_decoding(spark):
    from loamline.operators import parse

    lines = spark.createDataFrame([("a=1:b", "s"), ("a=1", "s"), ("name=x:start=1:end=2", "s"), (":", "s")], "line string, src string")
    bad = parse.malformed_lines(lines)
    assert bad.collect() == parse.sorted_out(lines)[1].where("cause = 'malformed'").select("line", "src").collect()
    assert [r.line for r in bad.collect()] == ["a=1:b"]
    assert "regexp_extract_all" not in bad._jdf.queryExecution().optimizedPlan().toString()
