"""Joins of the load: each dimension by its own size, and spellings told before rows are sorted for them."""


def test_a_large_dimension_sorts_no_facts(spark):
    from loamline.operators import rules
    from loamline.plans.load import Design, with_ids

    design = Design({"logrecord": ["src^", "char^"]})
    facts = spark.createDataFrame([("h1", "a", "X"), ("h2", "a", "y"), ("h3", None, "z")], "hash string, src string, char string")
    ids = spark.createDataFrame([("src", "a", 1), ("char", "x", 1), ("char", "y", 2)], "dimension string, key string, id bigint")
    out = with_ids(facts, ids, rules.declared(["src^", "char^"]), design, {"src": 1, "char": 10_000_000})
    assert sorted(map(tuple, out.select("hash", "src_id", "char_id").collect())) == [("h1", 1, 1), ("h2", 1, 2), ("h3", None, None)]
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("BroadcastHashJoin") == 1 and plan.count("ShuffledHashJoin") == 1 and "SortMergeJoin" not in plan


def test_first_of_stored_sorts_no_rows(spark):
    from loamline.operators import tables

    rows = spark.createDataFrame([("a", "f", 2), ("a", "f", 1), ("b", "f", 3), (None, "f", 4), (None, "f", 5)], "hash string, file string, offset bigint")
    out = tables.first_of_stored(rows)
    assert sorted(r.offset for r in out.collect()) == [1, 3, 4, 5]
    assert "SortMergeJoin" not in out._jdf.queryExecution().sparkPlan().toString()


def test_lines_are_asked_for_no_field_that_nobody_reads(spark):
    from loamline.operators import normalize, parse
    from loamline.plans.fixtures import BOOK

    keep, only = ("src", "hash"), ("cv", "game_key", "char", "ckiller", "gold")
    asked = normalize.wanted(keep, BOOK, (), only)
    assert {"v", "name", "start", "crace", "race", "cls", "killer", "goldspent"} <= set(asked) and not {"tmsg", "title", "vsav", "map"} & set(asked)
    line = "v=0.15-a0:name=Cust_1:race=Ghoul:cls=Wizard:start=20140001000000S:end=20140001000000S:gold=3:killer=a bat:ktyp=mon:tmsg=x"
    lines = spark.createDataFrame([(line, "cao"), (line.replace("gold=3", "gold=-1"), "cdo")], "line string, src string")
    few = normalize.normalized(parse.decoded(lines, asked), BOOK, keep, only=only)
    every = normalize.normalized(parse.decoded(lines, normalize.wanted(keep, BOOK)), BOOK, keep)
    assert sorted(map(tuple, few.select(*only).collect())) == sorted(map(tuple, every.select(*only).collect()))


def test_stored_keys_are_asked_for_as_text(spark):
    from loamline.operators import hashruns

    rows = spark.range(1000).withColumnRenamed("id", "key")
    assert rows.where(hashruns.among("key", list(range(5, 405)))).count() == 400 and rows.where(hashruns.among("key", [])).count() == 0
