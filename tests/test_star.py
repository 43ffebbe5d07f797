"""Times, names of files and tables, rules, dimensions, numbering, repair jobs, sinks and the load."""

import pytest
from pyspark.sql import functions as F


def one(spark, rows, column, use):
    df = spark.createDataFrame([(r,) for r in rows], f"{column} string")
    return [r[0] for r in df.select(use(F.col(column))).collect()]


def test_times(spark):
    from loamline.functions import clock

    assert one(spark, ["20140127094533S", "20110002175502D", "bad", ""], "t", clock.raw_digits) == ["20140227094533", "20110102175502", None, None]
    epochs = one(spark, ["200808070330+0000", "200808070530+0200", "200808070330", "x"], "t", lambda t: clock.shown(clock.epoch_moment(t)))
    assert epochs == ["2008-08-07 03:30:00"] * 3 + [None]
    assert one(spark, ["-0500", "+01:00", "Z", "bad"], "z", clock.zone_offset) == [-18000, 3600, 0, None]
    known = {"20061125235309S": "2006-12-26 04:53:09", "20061125235309D": "2006-12-26 03:53:09", "20091125235309S": "2009-12-25 23:53:09"}
    epoch = lambda: clock.epoch_moment(F.lit("200808070330+0000"))
    got = one(spark, list(known), "t", lambda t: clock.shown(clock.to_utc(t, epoch(), F.lit(-18000), F.lit(-14400))))
    assert got == list(known.values())


def test_table_names(spark):
    from loamline.plans.fixtures import BOOK
    from loamline.sources import registry

    rows = [("", "logrecord", "logrecord"), ("sprint", "milestone", "spr_milestone"), ("zotdef", "logrecord", "zot_logrecord"), ("nostalgia", "logrecord", "nostalgia_logrecord"), ("new", "logrecord", "new_logrecord")]
    df = spark.createDataFrame(rows, "game string, base string, want string")
    assert df.where(registry.table_name(F.col("base"), F.col("game"), BOOK.prefixes) != F.col("want")).count() == 0


def test_brace_groups(spark):
    from loamline.sources import registry, xlog

    known = {
        "yoda": ["yoda"], "": [""], "yak{}cow": ["yakcow"], "foo{bar,}bletch": ["foobarbletch", "foobletch"],
        "a{b,c,d,x{e,f,g}}h{i,j}": ["abhi", "abhj", "achi", "achj", "adhi", "adhj", "axehi", "axehj", "axfhi", "axfhj", "axghi", "axghj"],
        "{a,b}{c,d}{e,f}{g,h}{i,j}": [a + c + e + g + i for a in "ab" for c in "cd" for e in "ef" for g in "gh" for i in "ij"],
    }
    assert one(spark, list(known), "s", lambda s: registry.expanded(s, 5)) == [sorted(v) for v in known.values()]
    assert all(sorted(xlog.expand_braces(k)) == sorted(v) for k, v in known.items() if k)
    servers = spark.createDataFrame([("s", "http://h.example.org", [("{a,b}{c,d}{e,f}{g,h}{i,j}", "")])], "name string, base string, logs array<struct<spec: string, qualifier: string>>")
    assert registry.source_dim(servers, []).count() == 32


def test_file_names(spark):
    from loamline.functions import filename

    known = {"logfile-GIT": "git", "logfile-svn": "git", "milestones-Trunk-x": "git", "logfile15": "0.15", "logfile08": "0.8", "logfile-0.27.1": "0.27", "logfile": "any", "gitter": "any"}
    assert one(spark, list(known), "n", filename.version) == list(known.values())
    assert one(spark, ["remote.cao-logfile-0.15", "cao-logfile", "remote.x"], "n", filename.forced_server) == ["cao", "", ""]


def test_decoding_of_odd_lines(spark):
    from loamline.operators import parse

    lines = ["", " a=1 ", ":", "x::y=1", "a=b:c::d=e", "a=b:::", "a=b::::c", "a=b:c::", "a=:b=", "=v", "a=1:b", "a=\x01:b=2", "a= x :b =y", "k=v=w:k=z::", "a=b::c=d", "::=::"]
    want = [{}, {"a": "1"}, None, {"x::y": "1"}, {"a": "b", "c::d": "e"}, {"a": "b:"}, {"a": "b::c"}, None, {"a": "", "b": ""}, {"": "v"}, None, {"a": "\x01", "b": "2"}, {"a": " x ", "b": "y"}, {"k": "z:"}, {"a": "b:c=d"}, {"::": ":"}]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, line string")
    rows = df.select("i", parse.malformed(F.col("line")).alias("bad"), parse.fields_of(F.col("line")).alias("f")).orderBy("i").collect()
    assert [None if r.bad else r.f for r in rows] == want
    # the plain cut and the pattern agree
    by_pattern = df.select("i", (F.regexp_replace(F.trim("line"), parse.PAIR, "") != "").alias("bad")).orderBy("i").collect()
    assert [r.bad for r in by_pattern if r.i != 1] == [r.bad for r in rows if r.i != 1]


def test_branches_and_declared_fields(spark):
    from loamline.operators import normalize, rules
    from loamline.plans.fixtures import BOOK

    rows = spark.createDataFrame([({"explbr": x, "name": "n", "props": "p_7", "odd": "27"},) for x in ("HEAD", "release-0.16", "0.17", "direcows")], "fields map<string, string>")
    rows = rows.withColumns({"src": F.lit("s"), "hash": F.lit("h")})
    fields = rules.declared(["explbr", "odd", "props", "lotI", "oddIB", "gone"])
    out = rules.typed_select(normalize.normalized(rows, BOOK, more=tuple(f.name for f in fields)), fields[:4] + fields[5:]).collect()
    assert [r.explbr for r in out] == ["", "", "", "direcows"]
    assert {(r.odd, r.props, r.lot, r.gone) for r in out} == {("27", "p 7", 7, "")}
    with pytest.raises(ValueError, match="not a field"):
        rules.Declared.of("Bad Field")


def test_numbering(spark):
    from loamline.operators import tables

    values = spark.createDataFrame([(g, f"{k:03}") for g, n in (("a", 300), ("b", 7), ("c", 1)) for k in range(n)], "dimension string, key string")
    tops = spark.createDataFrame([("a", 10)], "dimension string, top bigint")
    ids = {}
    for r in tables.numbered_within(values, "dimension", tops, parts=5).collect():
        ids.setdefault(r.dimension, []).append((r.key, r.id))
    assert {g: [i for _, i in sorted(x)] for g, x in ids.items()} == {"a": list(range(11, 311)), "b": list(range(1, 8)), "c": [1]}
    assert [r.id for r in tables.numbered(values.where("dimension = 'b'"), after=5, parts=3).orderBy("key").collect()] == list(range(6, 13))


def test_first_of_stored(spark):
    from loamline.operators import tables

    rows = [("abc", "f", 3, "x"), ("def", "f", 2, "y"), ("abc", "f", 1, "z"), ("abc", "e", 9, "w")]
    batch = spark.createDataFrame(rows, "hash string, file string, offset bigint, v string")
    want = [("abc", "w"), ("def", "y")]
    assert sorted((r.hash, r.v) for r in tables.first_of_stored(batch).collect()) == want
    assert sorted((r.hash, r.v) for r in tables.first_of_hash(batch).collect()) == want


def test_repairs_and_sinks(spark, tmp_path):
    from loamline.operators import maintenance, rules
    from loamline.sources import sinks

    dimension = spark.createDataFrame([(1, "shoal:1", "shoal:1"), (2, "d:1", "D:1")], "id bigint, key string, value string")
    facts = spark.createDataFrame([(7, 1), (8, 2)], "id bigint, place_id bigint")
    fixed, grown = maintenance.fixed_field(facts, dimension, rules.Rule("place", regexp=[("^shoal", "Shoals")]), "place_id")
    assert {r.id: r.place_id for r in fixed.collect()} == {7: 3, 8: 2}
    assert (3, "Shoals:1") in {(r.id, r.value) for r in grown.collect()}
    path = str(tmp_path / "t")
    dimension.write.parquet(path)
    assert sinks.replaced(spark.read.parquet(path).where("id = 2"), path).count() == 1
    assert spark.read.parquet(path).count() == 1


def lines_of(spark, rows):
    return spark.createDataFrame([(f, o, x, "cao", "") for f, o, x in rows], "file string, offset bigint, line string, src string, game string")


LINE = "v=0.{v}:name={n}:start=20140001000000S:end=20140001010000S:place=D::1:sc={s}"


def test_load_twice_and_after_a_failure(spark, tmp_path):
    from loamline.plans import fixtures, load
    from loamline.plans.fixtures import BOOK

    design = load.Design({"logrecord": ["idPK%", "nameS?^", "cv^", "place^", "scIB", "extraI"], "milestone": ["nameS?^", "oplace^", "verb^"]}, shared={"place": ("place", "oplace")}, derived={"cv": ("cvnumIB",)})
    star, servers = load.Star(str(tmp_path / "star")), fixtures.servers(spark)
    first = [("f", 0, LINE.format(v=15, n="a", s=1)), ("f", 9, LINE.format(v=16, n="b", s=2) + ":extra=5"), ("f", 20, "junk"), ("f", 30, LINE.format(v=15, n="a", s=1)), ("f", 40, "name=x"), ("g", 5, "v=0.16-a0:name=b:start=20140001000000S:time=20140001010000S:type=ghost:milestone=moo:place=Snake::2")]
    report = {r.table: (r.rows_in, r.rows_kept, r.skipped) for r in load.load(lines_of(spark, first), star, BOOK, servers, design).collect()}
    assert report == {"logrecord": (3, 2, 1), "milestone": (1, 1, 0)}
    assert {(r.file, r.offset, r.cause) for r in star.rejected(spark).collect()} == {("f", 20, "malformed"), ("f", 40, "invalid")}
    assert {r.file: r.file_offset for r in star.offsets(spark).collect()} == {"f": 40, "g": 5}
    second = lines_of(spark, [*first, ("f", 50, LINE.format(v=17, n="c", s=3))])
    (tmp_path / "star" / "hashes" / "load=left").mkdir()  # by a load that failed
    assert [(r.rows_in, r.rows_kept) for r in load.load(second, star, BOOK, servers, design, name="again").orderBy("table").collect()] == [(4, 1), (1, 0)]
    assert [r.rows_kept for r in load.load(second, star, BOOK, servers, design, name="again").orderBy("table").collect()] == [1, 0]  # complete: not run again
    # the last commit is lost: what the load left isn't read, and a rerun does it anew
    max((tmp_path / "star" / "log").glob("*.json")).unlink()
    assert star.facts(spark, "logrecord", design).count() == 2
    load.load(second, star, BOOK, servers, design, name="again")
    facts = star.facts(spark, "logrecord", design)
    assert sorted((r.file_offset, r.sc, r.extra) for r in facts.collect()) == [(0, 1, 0), (9, 2, 5), (50, 3, 0)]
    names = star.dimension(spark, "name", design)
    assert sorted((r.id, r.value) for r in names.collect()) == [(1, "a"), (2, "b"), (3, "c")]
    assert {r.value: r.cvnum for r in star.dimension(spark, "cv", design).collect()}["0.15"] == 1500099000000
    assert {r.value for r in star.dimension(spark, "place", design).collect()} == {"D:1", "Snake:2"}
    assert facts.join(names, facts.pname_id == names.id).count() == 3
    with pytest.raises(ValueError, match="rejected"):
        load.load(lines_of(spark, [("f", 60, "junk")]), star, BOOK, servers, design, strict=True)
    with pytest.raises(ValueError, match="shared"):
        load.Design({"logrecord": []}, shared={"a": ("a", "b")}, derived={"a": ("x",)})


def test_stream_into_the_star(spark, tmp_path):
    from loamline.plans import fixtures, load
    from loamline.plans.fixtures import BOOK
    from loamline.streaming import loading

    design = load.Design({"logrecord": ["nameS?^", "scIB"]})
    star, source = load.Star(str(tmp_path / "star")), tmp_path / "in"
    source.mkdir()
    attribute = lambda batch: batch.select("file", "offset", "line", F.lit("cao").alias("src"), F.lit("").alias("game"))
    run = lambda: loading.followed_load(spark, str(source), star, str(tmp_path / "point"), attribute, BOOK, fixtures.servers(spark), design).awaitTermination()
    (source / "f").write_text(LINE.format(v=15, n="a", s=1) + "\n" + LINE.format(v=15, n="b", s=2) + "\nhalf")
    run()
    with (source / "f").open("a") as x:
        x.write("=1\n" + LINE.format(v=15, n="a", s=1) + "\n" + LINE.format(v=15, n="c", s=4) + "\n")
    run()
    assert sorted(r.sc for r in star.facts(spark, "logrecord", design).collect()) == [1, 2, 4]
    assert [r.cause for r in star.rejected(spark).collect()] == ["invalid"]
