"""Repairs of a loaded star, deletion, concurrent loads, compaction and runs of hashes."""

import threading

import pytest
from pyspark.sql import functions as F

LINE = "v=0.{v}:name={n}:race=Naga:cls=Wizard:char=XxYy:start=20140001000000S:end=20140001010000S:place=D::1:sc={s}:ntv=1"


@pytest.fixture(scope="module")
def design():
    from loamline.plans import load

    return load.Design({"logrecord": ["nameS?^", "race", "cls", "char^", "place", "cv^", "scIB", "ntvIB", "game_key", "rend"], "milestone": ["nameS?^"]}, derived={"cv": ("cvnumIB",)})


def lines_of(spark, rows):
    return spark.createDataFrame([(f, o, x, "cao", "") for f, o, x in rows], "file string, offset bigint, line string, src string, game string")


def loaded(spark, star, design, rows, **how):
    from dataclasses import replace

    from loamline.plans import fixtures, load

    return load.load(lines_of(spark, rows), star, replace(fixtures.BOOK, species={}, jobs={}), fixtures.servers(spark), design, **how)


def test_repairs_touch_only_files_with_such_rows(spark, tmp_path, design):
    from loamline.operators.rules import Rule
    from loamline.plans import fixtures, load, repairs

    star = load.Star(str(tmp_path / "star"))
    for k, name in enumerate("abc"):  # three loads, so three files
        loaded(spark, star, design, [(f"f{k}", 10 * j, LINE.format(v=15 + k, n=name, s=100 * k + j)) for j in range(4)])
    facts = lambda: star.facts(spark, "logrecord", design)
    before = star.log.snapshot(spark)
    assert repairs.fix_field(spark, star, design, Rule("name", exact=[("b", "bee")])) == 1
    names = star.dimension(spark, "name", design)
    assert {r.value for r in facts().join(names, F.col("pname_id") == F.col("id")).select("value").collect()} == {"a", "bee", "c"}
    assert repairs.fix_field(spark, star, design, Rule("name", exact=[("b", "bee")])) == 0  # b stays in the dimension, but no fact has it
    assert repairs.fix_field(spark, star, design, Rule("place", exact=[("D:9", "X")])) == 0
    abbr = lambda d: spark.createDataFrame(list(d.items()), "name string, abbr string")
    assert repairs.fix_char(spark, star, design, abbr(fixtures.BOOK.species), abbr(fixtures.BOOK.jobs)) == 3
    assert repairs.fix_char(spark, star, design, abbr(fixtures.BOOK.species), abbr(fixtures.BOOK.jobs)) == 0
    chars = star.dimension(spark, "char", design)
    assert {r.value for r in facts().join(chars, F.col("char_id") == F.col("id")).select("value").collect()} == {"NaWz"}
    key = facts().where("sc = 201").select("game_key", "rend").first()
    updates = spark.createDataFrame([(key.game_key, key.rend, 9), ("none", key.rend, 5)], "game_key string, rowtime string, ntv bigint")
    assert repairs.import_tv(spark, star, design, updates) == 1
    assert {r.ntv for r in facts().where("sc >= 200").collect()} == {9} and {r.ntv for r in facts().where("sc < 200").collect()} == {1}
    assert repairs.renumber_versions(spark, star, design, "cv", "cvnum") == 0
    assert facts().count() == 12
    # who read before the repairs still sees what was there
    assert {r.value for r in star.facts(spark, "logrecord", design, before).join(star.dimension(spark, "name", design, before), F.col("pname_id") == F.col("id")).select("value").collect()} == {"a", "b", "c"}


def test_delete_and_load_again(spark, tmp_path, design):
    from loamline.plans import load, repairs

    star = load.Star(str(tmp_path / "star"))
    rows = [(f"f{k % 2}", k, LINE.format(v=15, n="a", s=k)) for k in range(8)] + [("f1", 90, "junk")]
    loaded(spark, star, design, rows[:4])
    loaded(spark, star, design, rows)
    repairs.delete_files(spark, star, design, ["f1"])
    scores = lambda: sorted(r.sc for r in star.facts(spark, "logrecord", design).collect())
    assert scores() == [0, 2, 4, 6] and {r.file for r in star.offsets(spark).collect()} == {"f0"} and star.rejected(spark).count() == 0
    report = loaded(spark, star, design, rows).first()
    assert (report.rows_in, report.rows_kept) == (8, 4) and scores() == list(range(8))
    assert loaded(spark, star, design, rows).first().rows_kept == 0
    # merged runs leave out what was forgotten, and know what came back
    repairs.delete_files(spark, star, design, ["f0"])
    assert "hashes" in repairs.compacted(spark, star, design, least=2)
    assert scores() == [1, 3, 5, 7] and loaded(spark, star, design, rows).first().rows_kept == 4 and scores() == list(range(8))
    assert loaded(spark, star, design, rows).first().rows_kept == 0


def test_two_loads_at_once(spark, tmp_path, design):
    """Both begin on one snapshot: the later commit is done again, and no row and no id comes twice."""
    from loamline.plans import load
    from loamline.sources import commits

    star = load.Star(str(tmp_path / "star"))
    loaded(spark, star, design, [("f", 0, LINE.format(v=15, n="z", s=0))])
    gate, waits, put = threading.Barrier(2), [True, True], commits.Log.put
    tried, errors = [], []

    def held(self, session, seen, commit):
        if commit.what == "load" and waits:
            waits.pop()
            gate.wait(60)
        tried.append(out := put(self, session, seen, commit))
        return out

    def run(rows):
        try:
            loaded(spark, star, design, rows)
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    commits.Log.put = held
    try:
        both = [("f", 5, LINE.format(v=15, n="both", s=5))]
        jobs = [threading.Thread(target=run, args=([*both, (f"g{k}", 0, LINE.format(v=16 + k, n=f"own{k}", s=10 + k))],)) for k in range(2)]
        [j.start() for j in jobs]
        [j.join() for j in jobs]
    finally:
        commits.Log.put = put
    assert not errors and sorted(tried) == [False, True, True]
    assert sorted(r.sc for r in star.facts(spark, "logrecord", design).collect()) == [0, 5, 10, 11]
    names = star.dimension(spark, "name", design).collect()
    assert sorted(r.value for r in names) == ["both", "own0", "own1", "z"] and sorted(r.id for r in names) == [1, 2, 3, 4]


def test_commit_log(spark, tmp_path):
    from loamline.sources import commits, sinks

    log = commits.Log(str(tmp_path))
    first = log.snapshot(spark)
    for k in range(65):
        seen = log.snapshot(spark)
        assert seen.version == k and log.put(spark, seen, commits.Commit("x", {"t": [f"load={k}"]}, {"t": [f"load={k - 2}"]} if k > 1 else {}, done=("s", k)))
        assert not log.put(spark, seen, commits.Commit("late"))
    seen = log.snapshot(spark)
    assert list(seen.folders["t"]) == ["load=63", "load=64"] and seen.has("s", 64) and not seen.has("s", 65)
    assert len(sinks.names_in(spark, f"{tmp_path}/log")) < 50
    assert not log.put(spark, first, commits.Commit("very late"))
    folder = tmp_path / "t" / "load=64"
    folder.mkdir(parents=True)
    for name in ("part-1", "part-2", "_SUCCESS"):
        (folder / name).write_text("")
    log.put(spark, seen, commits.Commit("y", drop={"t": ["load=63", "load=64/part-1"]}))
    assert [p.rsplit("/", 1)[1] for p in log.paths(spark, log.snapshot(spark), "t")] == ["part-2"]


def test_vacuum_leaves_what_is_named_or_young(spark, tmp_path):
    import os

    from loamline.sources import commits

    log = commits.Log(str(tmp_path))
    log.put(spark, log.snapshot(spark), commits.Commit("load", {"t": ["load=live", "load=old"]}))
    log.put(spark, log.snapshot(spark), commits.Commit("compact", {}, {"t": ["load=old"]}))
    for name, age in (("load=live", 9e6), ("load=old", 9e6), ("load=left", 9e6), ("load=young", 0), ("other", 9e6)):
        folder = tmp_path / "t" / name
        folder.mkdir(parents=True)
        (folder / "part-0").write_text("x")
        os.utime(folder, (folder.stat().st_mtime - age,) * 2)
    assert commits.vacuumed(log, spark) == ["t/load=left", "t/load=old"]
    assert sorted(p.name for p in (tmp_path / "t").iterdir()) == ["load=live", "load=young", "other"]


def test_compaction_and_loads_pass_each_other(spark, tmp_path):
    from loamline.sources import commits

    log, calls = commits.Log(str(tmp_path)), []
    log.put(spark, log.snapshot(spark), commits.Commit("load", {"t": ["load=a", "load=b"]}))

    def work(what, other):
        def run(seen):
            calls.append(what)
            if len(calls) == 1:  # another writer is first
                log.put(spark, log.snapshot(spark), other)
            return commits.Commit(what, {"t": [f"load={what}"]}, {"t": ["load=a", "load=b"]} if what == "compact" else {})

        return run

    log.transact(spark, work("compact", commits.Commit("load", {"t": ["load=c"]})))
    assert calls == ["compact"] and list(log.snapshot(spark).folders["t"]) == ["load=c", "load=compact"]
    for what, other, n in (("load", "compact", 1), ("load", "load", 2), ("compact", "delete files", 2), ("load", "fix char", 2), ("fix char", "load", 2)):
        calls.clear()
        log.transact(spark, work(what, commits.Commit(other)))
        assert calls == [what] * n


@pytest.mark.parametrize("bound", [1_000_000, 0])
def test_hash_runs(spark, tmp_path, bound):
    """A search reads the same by either way, and most of a run is passed over."""
    from loamline.operators import hashruns

    hashes = spark.range(20_000).select(F.sha2(F.col("id").cast("string"), 256).alias("hash"), F.lit("f").alias("file"), "id")
    for k in range(2):
        hashruns.written(hashes.where(f"id % 2 = {k}"), f"{tmp_path}/runs/load=r{k}", 10_000)
    runs = spark.read.schema(hashruns.RUN + ", load string").parquet(f"{tmp_path}/runs")
    gone = hashes.where("id in (5, 6)").select("hash", F.lit("r1").alias("of"))
    path = str(tmp_path / "new")
    hashes.where("id < 10").select("hash").unionByName(spark.range(30_000, 30_500).select(F.sha2(F.col("id").cast("string"), 256).alias("hash"))).write.parquet(path)
    new, old = spark.read.parquet(path), hashruns.BROADCAST_ROWS
    try:
        hashruns.BROADCAST_ROWS = bound
        found = hashruns.found(runs, gone, new, 510)
        assert sorted(r.hash for r in found.collect()) == sorted(r.hash for r in hashes.where("id < 10 and id <> 5").collect())
    finally:
        hashruns.BROADCAST_ROWS = old
    assert hashruns.to_merge({"a": 1, "b": 2, "c": 3, "d": 3, "e": 1000}) == ["a", "b", "c", "d"]
    assert hashruns.to_merge({"a": 1, "b": 2}) == []


def test_rules_by_distinct_values_give_the_same(spark, monkeypatch):
    from loamline.operators import normalize
    from loamline.plans import fixtures, records
    from loamline.sources import workspace

    sf = "/root/testdata/sf0.001"
    logs, miles = (records.records(spark, sf, which) for which in (fixtures.LOG, fixtures.MILESTONE))
    some = workspace.stored(logs.unionByName(miles).limit(4000))
    want = normalize.normalized(some, fixtures.BOOK)
    monkeypatch.setattr(normalize, "DISTINCT_FROM", 0)
    for bound in (500_000, 0):
        monkeypatch.setattr(normalize, "BROADCAST_DISTINCT", bound)
        got = normalize.normalized(some, fixtures.BOOK, rows=4000)
        plan = got._jdf.queryExecution().analyzed().toString()
        assert plan.count("__out_ckiller") and set(got.columns) == set(want.columns)
        got = got.select(*want.columns)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def bytes_read(spark, make):
    """What the session's JVM reads from files while make() runs."""
    pid = spark._jvm.java.lang.ProcessHandle.current().pid()
    now = lambda: int(open(f"/proc/{pid}/io").read().split()[1])  # noqa: E731, SIM115
    before = now()
    out = make()
    return out, now() - before


def test_a_small_load_reads_few_pages_of_dimensions(spark, tmp_path, monkeypatch):
    from loamline.operators import dictionary, hashruns
    from loamline.sources import workspace

    values = spark.range(300_000).select(F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("dimension"), F.md5(F.col("id").cast("string").cast("binary")).alias("key"), "id")
    dictionary.written(values.coalesce(1), str(tmp_path / "new"))
    values.where("id < 1000").withColumn("slot", F.lit(None).cast("long")).withColumn("id", F.col("id") + 10**6).write.partitionBy("dimension").parquet(str(tmp_path / "old"))
    keys = workspace.stored(values.where("id % 10000 = 3").select("dimension", "key").unionByName(spark.createDataFrame([("c", "x"), ("a", "none")], "dimension string, key string")))
    schema = f"dimension string, key string, id bigint, {dictionary.SLOT}"
    size = sum(f.stat().st_size for f in (tmp_path / "new").rglob("*.parquet"))
    for table, want in (("new", range(3, 300_000, 10_000)), ("old", [10**6 + 3])):  # files without slots are read whole
        stored = spark.read.schema(schema).parquet(str(tmp_path / table))
        for few in (hashruns.FEW_KEYS, 0):
            monkeypatch.setattr(hashruns, "FEW_KEYS", few)
            found, read = bytes_read(spark, lambda: dictionary.known(stored, keys, 32))  # noqa: B023
            assert found.columns == ["dimension", "key", "id"] and sorted(r.id for r in found.collect()) == list(want)
            assert (read < size / 3) == bool(few) or table == "old"
        monkeypatch.undo()
    before = spark.conf.get("spark.sql.parquet.pushdown.inFilterThreshold")
    assert dictionary.known(spark.read.schema(schema).parquet(str(tmp_path / "new")), keys.limit(0), 0).count() == 0
    assert spark.conf.get("spark.sql.parquet.pushdown.inFilterThreshold") == before


def test_few_hashes_are_looked_up_in_few_pages(spark, tmp_path):
    from loamline.operators import hashruns
    from loamline.sources import workspace

    hashes = spark.range(300_000).select(F.sha2(F.col("id").cast("string"), 256).alias("hash"), F.lit("f").alias("file"), "id")
    hashruns.written(hashes, f"{tmp_path}/runs/load=r", 300_000)
    runs = spark.read.schema(hashruns.RUN + ", load string").parquet(f"{tmp_path}/runs")
    new = workspace.stored(hashes.where("id % 10000 = 3").select("hash"))
    size = sum(f.stat().st_size for f in (tmp_path / "runs").rglob("*.parquet"))
    found, read = bytes_read(spark, lambda: hashruns.found(runs, spark.createDataFrame([], hashruns.GONE), new, 30))
    assert found.count() == 30 and read < size / 3


def test_many_values_are_told_by_lists(spark, tmp_path):
    from loamline.operators import hashruns

    path = str(tmp_path / "t")
    spark.range(0, 40_000, 2).coalesce(1).write.parquet(path)
    values = list(range(0, 4_500, 3))  # sixteen lists and a half of them
    with hashruns.told(spark):
        rows = spark.read.parquet(path).where(hashruns.among(F.col("id"), values))
        assert sorted(r.id for r in rows.collect()) == [v for v in values if v % 2 == 0]
        plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(" in plan
    assert spark.read.parquet(path).where(hashruns.among(F.col("id"), [])).count() == 0
