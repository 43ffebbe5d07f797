"""Streams: fair admission, quiet times, truncation, and loads that lose their checkpoint or get new rules."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F


def reader(path, **options):
    from loamline.sources.xlog import XlogStreamReader

    return XlogStreamReader({"path": str(path)} | {k: str(v) for k, v in options.items()})


def lines(r, start, end):
    return [(p.file.rsplit("/", 1)[-1], row) for p in r.partitions(start, end) for b in r.read(p) for row in b.column(2).to_pylist()]


def test_a_busy_file_keeps_no_other_out(tmp_path):
    (tmp_path / "a").write_text("x" * 49 + "\n")
    (tmp_path / "b").write_text("".join(f"line {k}\n" for k in range(40)))
    (tmp_path / "c").write_text("one\n")
    r, at, seen, batches = reader(tmp_path, maxbytespertrigger=100), {}, [], 0
    while sum(f == "b" for f, _ in seen) < 40 and batches < 30:
        with (tmp_path / "a").open("a") as f:
            f.write(("y" * 49 + "\n") * 4)  # grows faster than the limit
        end = r.latestOffset()
        got = lines(r, at, end)
        assert 0 < sum(len(x) + 1 for _, x in got) <= 150
        assert {f for f, _ in got} >= {"a"} and (batches or {f for f, _ in got} == {"a", "b", "c"})
        seen, at, batches = seen + got, end, batches + 1
    assert [x for f, x in seen if f == "b"] == [f"line {k}" for k in range(40)] and batches < 12
    assert [x for f, x in seen if f == "c"] == ["one"]
    again = reader(tmp_path, maxbytespertrigger=100)  # goes on from stored offsets
    again.partitions({}, at)
    assert {f for f, _ in lines(again, at, again.latestOffset())} == {"a"}


def test_files_that_spark_still_writes_are_not_read(tmp_path):
    from loamline.sources import xlog

    attempt = tmp_path / "in" / "name=a" / "_temporary" / "0" / "attempt_1"
    attempt.mkdir(parents=True)
    (attempt / "part-0").write_text("one\ntwo\n")
    source = tmp_path / "in"
    r = reader(source)
    for pattern in (source, f"{source}/*", f"{source}/name=a/*", f"{source}/*/*"):
        assert xlog.listed(str(pattern)) == {}
    at = r.latestOffset()
    assert at == {}
    (attempt / "part-0").rename(source / "name=a" / "part-0")  # as the commit of a job does
    assert lines(r, at, r.latestOffset()) == [("part-0", "one"), ("part-0", "two")]
    assert list(xlog.listed(f"{source}/name=a")) == list(xlog.listed(f"{source}/*/part-*")) == [str(source / "name=a" / "part-0")]
    (tmp_path / "_kept").mkdir()
    (tmp_path / "_kept" / "f").write_text("x\n")
    assert list(xlog.listed(str(tmp_path / "_kept"))) == [str(tmp_path / "_kept" / "f")]  # a hidden folder that is named


def test_a_burst_arrives_whole(spark, tmp_path, monkeypatch):
    """Lots that take longer to write than the interval still make fewer batches than lots."""
    import time

    from loamline.plans import streams

    slow = streams.put

    def put(spark, sf_dir, path, which="event"):
        slow(spark, sf_dir, path, which)
        time.sleep(7)

    monkeypatch.setattr(streams, "put", put)
    rows = streams.stream_debounce(spark, "/root/testdata/sf0.001")
    assert [tuple(r) for r in rows.select("fewer").distinct().collect()] == [(True,)]


def test_truncation_is_told_from_growth(tmp_path):
    f = tmp_path / "f"
    f.write_text("first\nsecond\n")
    r = reader(tmp_path, generation="true")
    at = r.latestOffset()
    assert [x for _, x in lines(r, {}, at)] == ["first", "second"]
    f.write_text("first\nsecond\nthird\n")
    more = r.latestOffset()
    assert [x for _, x in lines(r, at, more)] == ["third"] and more[str(f)][1] == at[str(f)][1]
    for text in ("", "new\n", "other first line\nwhich is longer than what was\n"):
        f.write_text(text)
        fresh = reader(tmp_path, truncated="raise")
        fresh.partitions({}, more)
        with pytest.raises(ValueError, match="shrunk"):
            fresh.latestOffset()
        skip = reader(tmp_path, truncated="skip")
        skip.partitions({}, more)
        assert skip.latestOffset() == more
        anew = reader(tmp_path, truncated="anew", generation="true")
        anew.partitions({}, more)
        end = anew.latestOffset()
        assert [x for _, x in lines(anew, more, end)] == text.splitlines()
        assert not text or end[str(f)][1] != more[str(f)][1]
    f.write_text("first\n")  # shorter, with the first line that it had
    anew = reader(tmp_path, truncated="anew", generation="true")
    anew.partitions({}, more)
    assert anew.latestOffset()[str(f)] == [6, more[str(f)][1] + "+1"]
    with pytest.raises(ValueError, match="truncated"):
        reader(tmp_path, truncated="maybe")


def test_a_quiet_time_is_no_interval(tmp_path, monkeypatch):
    from loamline.sources import xlog

    now = [100.0]
    monkeypatch.setattr(xlog.time, "monotonic", lambda: now[0])
    busy, calm = tmp_path / "busy", tmp_path / "calm"
    calm.write_text("c\n")
    busy.write_text("b\n")
    r, taken = reader(tmp_path, quietseconds=5, maxwaitseconds=20), {}
    for k in range(30):
        now[0] += 1
        with busy.open("a") as f:
            f.write(f"{k}\n")
        end = r.latestOffset()
        for name in ("busy", "calm"):
            if str(tmp_path / name) in end:
                taken.setdefault(name, k)
    assert taken == {"calm": 5, "busy": 20}  # quiet, and overdue


LINE = "v=0.15:name={n}:god=okawaru:start=20140001000000S:end=20140001010000S:place=D::1:sc={s}"


def test_loads_lose_no_line_with_their_checkpoint(spark, tmp_path):
    from loamline.plans import fixtures, load
    from loamline.sources import rulebooks
    from loamline.streaming import loading

    design = load.Design({"logrecord": ["nameS?^", "scIB", "god"]})
    star, source, books = load.Star(str(tmp_path / "star")), tmp_path / "in", rulebooks.RuleBooks(spark, str(tmp_path / "rules"))
    source.mkdir()
    attribute = lambda batch: batch.select("file", "offset", "line", F.lit("cao").alias("src"), F.lit("").alias("game"))
    assert books.put(fixtures.BOOK) == 1 == books.put(fixtures.BOOK) and rulebooks.from_json(rulebooks.to_json(fixtures.BOOK)) == fixtures.BOOK

    def run(checkpoint, **options):
        loading.followed_load(spark, str(source), star, str(tmp_path / checkpoint), attribute, books, fixtures.servers(spark), design, **options).awaitTermination()

    def add(name, *rows):
        with (source / name).open("a") as f:
            f.write("".join(x + "\n" for x in rows))

    add("f", LINE.format(n="a", s=0), "junk", LINE.format(n="a", s=1))
    run("one")
    add("f", LINE.format(n="b", s=2), "more junk")
    add("g", LINE.format(n="b", s=3))
    assert books.put(replace(fixtures.BOOK, gods={"okawaru": "Oka"})) == 2
    run("two", maxBytesPerTrigger=200)  # the checkpoint is lost, with new lines between and another limit
    add("g", LINE.format(n="c", s=4))
    run("two", maxBytesPerTrigger=200)
    run("three")
    rows = star.facts(spark, "logrecord", design).collect()
    assert sorted(r.sc for r in rows) == [0, 1, 2, 3, 4]
    assert {r.sc: r.god for r in rows} == {0: "Okawaru", 1: "Okawaru", 2: "Oka", 3: "Oka", 4: "Oka"}
    assert sorted(r.line for r in star.rejected(spark).collect()) == ["junk", "more junk"]
    from loamline.plans import repairs

    ranges = repairs.joined_ranges(star.read(spark, "ranges", load.RANGES)).collect()
    assert sorted((r.file.rsplit("/", 1)[1], r.first, r.rules) for r in ranges) == sorted([("f", 0, 1), *((f, a, 2) for f, a in (("f", min(r.first for r in ranges if r.rules == 2 and r.file.endswith("f"))), ("g", 0)))])


def test_ranges(spark):
    from loamline.plans import load

    scanned = spark.createDataFrame([("f", "a", k) for k in range(10)] + [("g", "b", 3), ("h", "c", 1)], "file string, generation string, offset bigint")
    ranges = spark.createDataFrame([("f", "a", 0, 2), ("f", "a", 5, 6), ("f", "old", 7, 9), ("g", "b+1", 0, 9), ("g", "b", 0, 9), ("i", "a", 0, 9)], "file string, generation string, first bigint, last bigint")
    left = sorted(tuple(r) for r in load.unread(scanned, ranges).collect())
    assert left == [*(("f", "a", k) for k in (3, 4, 7, 8, 9)), ("g", "b", 3), ("h", "c", 1)]
    assert sorted(tuple(r) for r in load.ranges_of(scanned.where("offset > 6 or file <> 'f'"), ranges).collect()) == [("f", "a", 7, 9), ("g", "b", 3, 3), ("h", "c", 1, 1)]


def test_places_in_a_log_are_those_of_plain_offsets(tmp_path, monkeypatch):
    import json
    import os
    import random

    from loamline.sources import offsetlog

    monkeypatch.setattr(offsetlog, "EVERY", 5)
    monkeypatch.setattr(offsetlog, "KEEP", 2)
    source, log, rng = tmp_path / "in", tmp_path / "log", random.Random(3)
    for d in range(4):
        (source / f"d{d}").mkdir(parents=True)
    options = {"truncated": "anew", "generation": "true", "maxbytespertrigger": 400}
    plain, logged = reader(source, **options), reader(source, offsetlog=log, **options)
    a, b, k = {}, {}, 0
    for step in range(60):
        for _ in range(3):
            f = source / f"d{rng.randrange(4)}" / f"f{rng.randrange(12)}"
            with f.open("w" if rng.random() < 0.1 else "a") as out:
                out.write(f"line {k} of {f.name}\n" * rng.randrange(1, 4))
            k += 1
        if step == 30:  # a stream that began without a log goes on with one
            logged, b = reader(source, offsetlog=tmp_path / "second", **options), a
            logged.partitions(a, a)
        elif step % 7 == 0:  # both begin anew from where Spark says they are
            plain, logged = reader(source, **options), reader(source, offsetlog=log if step < 30 else tmp_path / "second", **options)
            plain.partitions(a, a)
            logged.partitions(b, b)
        if step % 11 == 0:
            logged.latestOffset()  # a place that Spark never stored
            logged.partitions(b, b)
        c, d = plain.latestOffset(), logged.latestOffset()
        assert sorted(lines(plain, a, c)) == sorted(lines(logged, b, d))
        assert c == a or len(json.dumps(d)) < 60
        logged.commit(d)
        assert logged._state(d) == c
        a, b = c, d
    held = os.listdir(tmp_path / "second")
    assert 0 < len(held) < 30  # old places were removed
    with pytest.raises(ValueError, match="no place"):
        reader(source, offsetlog=tmp_path / "third", **options).partitions(b, b)
    with pytest.raises(ValueError, match="offsetLog"):
        reader(source, **options).partitions(b, b)


def test_a_change_of_one_file_of_many_writes_one_change(tmp_path):
    from loamline.sources import xlog

    source, log = tmp_path / "in", tmp_path / "log"
    for d in range(30):
        (source / str(d)).mkdir(parents=True)
        for n in range(100):
            (source / str(d) / f"{n}").write_text(f"{d} {n}\n")
    r = reader(source, offsetlog=log)
    at = r.latestOffset()
    parts = r.partitions({}, at)
    assert len(parts) <= xlog.TASKS + 1 and sum(isinstance(p, xlog.Ranges) for p in parts) == len(parts)
    rows = [x for p in parts for b in r.read(p) for x in b.column(2).to_pylist()]
    assert sorted(rows) == sorted(f"{d} {n}" for d in range(30) for n in range(100))
    with (source / "7" / "70").open("a") as f:
        f.write("more\n")
    new = r.latestOffset()
    assert lines(r, at, new) == [("70", "more")] and r.latestOffset() == new
    assert (log / f"{new[r.PLACE]}.json").stat().st_size < 500
    batch = xlog.XlogReader({"path": str(source)})
    assert sorted(x for p in batch.partitions() for b in batch.read(p) for x in b.column(2).to_pylist()) == sorted([*rows, "more"])
