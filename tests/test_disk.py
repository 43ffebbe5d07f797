"""Room on disk: tables between jobs and shuffled files go when a load or repair is done, and large loads shuffle in parts."""

import os
import time

import pytest
from pyspark.sql import functions as F

LINE = "v=0.{v}:name=n{n}:race=Naga:cls=Wizard:char=XxYy:start=20140001000000S:end=20140001010000S:place=D::1:sc={s}:ntv=1"


def loaded(spark, star, design, rows, **how):
    from loamline.plans import fixtures, load

    lines = spark.createDataFrame([(f, o, x, "cao", "") for f, o, x in rows], "file string, offset bigint, line string, src string, game string")
    return load.load(lines.repartition(4), star, fixtures.BOOK, fixtures.servers(spark), design, **how)


@pytest.fixture
def design():
    from loamline.plans import load

    return load.Design({"logrecord": ["nameS?^", "race", "char^", "cv^", "scIB"]})


@pytest.fixture
def made(monkeypatch):
    """Folders of tables between jobs."""
    from loamline.sources import workspace

    paths, folder = [], workspace.folder
    monkeypatch.setattr(workspace, "folder", lambda spark: paths.append(folder(spark)) or paths[-1])
    return paths


def shuffled(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(k).getName().startswith("shuffle_") for k in range(files.size()))


def test_loads_and_repairs_leave_no_table_and_no_shuffled_file(spark, tmp_path, design, made):
    from loamline.plans import load, repairs

    star, before = load.Star(str(tmp_path / "star")), shuffled(spark)
    for lot in (range(20), range(10, 30)):
        loaded(spark, star, design, [(f"f{k % 2}", k, LINE.format(v=15, n=k % 7, s=k)) for k in lot])
    repairs.delete_files(spark, star, design, ["f0"])
    assert repairs.compacted(spark, star, design, least=2)
    assert made and not [p for p in made if os.path.exists(p.removeprefix("file:"))]
    until = time.monotonic() + 20  # they are removed in the background
    while shuffled(spark) > before and time.monotonic() < until:
        time.sleep(0.2)
    assert shuffled(spark) <= before
    assert star.facts(spark, "logrecord", design).count() == 15


def test_what_is_stored_outside_stays(spark, made):
    from loamline.sources import workspace

    name = workspace.CLEANUP
    kept = workspace.stored(spark.range(3))
    with pytest.raises(ZeroDivisionError), workspace.passing(spark):
        workspace.stored(spark.range(4), spark.range(4, 6))
        with workspace.passing(spark):
            assert workspace.stored(spark.range(5)).count() == 5
        assert spark.conf.get(name) == "true" and [os.path.exists(p.removeprefix("file:")) for p in made] == [True, True, False]
        raise ZeroDivisionError
    assert [os.path.exists(p.removeprefix("file:")) for p in made] == [True, False, False]
    assert kept.count() == 3 and spark.conf.get(name, None) is None


def test_large_loads_in_parts_keep_the_same(spark, tmp_path, design, monkeypatch):
    from loamline.operators import hashruns
    from loamline.plans import load, repairs
    from loamline.sources import workspace

    mile = "v=0.15:name=a:start=20140001000000S:time=20140001010000S:type=unique:milestone=killed Grum.:place=D::1:sc={s}"  # a kind without facts here
    rows = [(f"f{k % 2}", k, LINE.format(v=15 + k % 50 % 3, n=k % 50 % 7, s=k % 50)) for k in range(60)]
    rows += [("m", k, mile.format(s=k % 3)) for k in range(5)]
    got, widest = [], []
    join = load.with_ids
    monkeypatch.setattr(load, "with_ids", lambda facts, *rest: widest.append(facts.count()) or join(facts, *rest))
    for small in (False, True):
        if small:
            monkeypatch.setattr(workspace, "PART_ROWS", 10)
            monkeypatch.setattr(workspace, "MOST_PARTS", 4)
            monkeypatch.setattr(hashruns, "BROADCAST_ROWS", 0)
            monkeypatch.setattr(hashruns, "FILE_ROWS", 10)
            monkeypatch.setattr(load.tables, "BROADCAST_ROWS", 0)
            widest.clear()
        star = load.Star(str(tmp_path / f"star{small}"))
        first = loaded(spark, star, design, rows[:40]).collect()
        second = loaded(spark, star, design, rows[20:]).collect()
        repairs.delete_files(spark, star, design, ["f0"])
        repairs.compacted(spark, star, design, least=2)
        third = loaded(spark, star, design, rows).collect()
        facts = star.facts(spark, "logrecord", design).join(star.dimension(spark, "name", design), F.col("pname_id") == F.col("id"))
        hashes = star.log.read(spark, star.log.snapshot(spark), "hashes", hashruns.RUN)
        got.append([sorted(map(str, x)) for x in (first, second, third, facts.select("hash", "table", "sc", "value").collect(), hashes.select("hash", "key").collect())])
    assert got[0] == got[1] and len(got[0][3]) == 50 and len(got[0][4]) == 53 and len(set(got[0][4])) == 53
    assert len(widest) > 6 and max(widest) < 40  # in parts


def test_a_stream_of_loads_leaves_no_table(spark, tmp_path, design, made):
    from loamline.plans import fixtures, load
    from loamline.sources import workspace
    from loamline.streaming import loading

    star, source = load.Star(str(tmp_path / "star")), tmp_path / "in"
    source.mkdir()
    attribute = lambda batch: batch.select("file", "offset", "line", F.lit("cao").alias("src"), F.lit("").alias("game"))
    for k in range(2):  # the second time there are ranges to pass over, as the checkpoint is lost
        (source / f"f{k}").write_text("".join(LINE.format(v=15, n=j, s=10 * k + j) + "\n" for j in range(3)))
        loading.followed_load(spark, str(source), star, str(tmp_path / f"point{k}"), attribute, fixtures.BOOK, fixtures.servers(spark), design).awaitTermination()
    assert made and not [p for p in made if os.path.exists(p.removeprefix("file:"))]
    assert sorted(r.sc for r in star.facts(spark, "logrecord", design).collect()) == [0, 1, 2, 10, 11, 12]
    with workspace.passing(spark):
        with workspace.passing(spark):
            kept = workspace.stored(spark.range(3), outlives=True)
        assert kept.count() == 3
    assert not os.path.exists(made[-1].removeprefix("file:"))
