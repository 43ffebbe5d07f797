"""Queries of joins, deduplication, dimensions, sinks, repair jobs and the batch load."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamline.functions import version
from loamline.operators import maintenance, rules, tables
from loamline.plans import fixtures, load, repairs
from loamline.plans.fixtures import BOOK
from loamline.plans.records import LOGS, NOUN, log_lines, records
from loamline.plans.registry import GOOD, LOG_T, query
from loamline.sources import commits, sinks, workspace

c = F.col


def log_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns that log lines are made of, with a name."""
    rows = spark.sql(LOGS, orders=fixtures.table(spark, sf_dir, "orders"), customer=fixtures.table(spark, sf_dir, "customer"))
    return rows.withColumn("name", F.concat(F.lit("Cust_"), c("k").cast("string")))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.table(spark, sf_dir, "documents").select(c("doc_id").alias("i"), F.md5(F.encode("text", "UTF-8")).alias("hash"), c("source").alias("file"), c("doc_id").alias("offset"), c("lang").alias("table"))


def names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.numbered(tables.distinct_values(log_rows(spark, sf_dir), "name", ("i",)))


# -- dimensions ----------------------------------------------------------------------------------------------------

SPELLED = "select case i % 2 when 0 then 'Cust_' else 'CUST_' end || k as name, i from t"


@query("dim_distinct", f"{LOG_T} select lower(replace(name, '_', ' ')) as key, arg_max(replace(name, '_', ' '), i) as value from ({SPELLED}) group by 1")
def dim_distinct(spark, sf_dir):
    rows = log_rows(spark, sf_dir).withColumn("name", F.when(c("i") % 2 == 0, c("name")).otherwise(F.concat(F.lit("CUST_"), c("k").cast("string"))))
    return tables.distinct_values(rows, "name", ("i",))


VNUM = "(i % 25) * 100000000000 + case i % 4 when 0 then 99000000 when 1 then 1000000 when 2 then 18010000 else 399000000 end"


@query("dim_derived", f"{LOG_T} select distinct lower(v) as key, v as value, {VNUM} as vnum from t")
def dim_derived(spark, sf_dir):
    return tables.distinct_values(log_rows(spark, sf_dir), "v", ("i",), derived={"vnum": version.number(c("value"))})


@query("dim_existing", f"{LOG_T} select distinct 'cust ' || k as key, 'Cust ' || k as value from t where k % 2 = 0")
def dim_existing(spark, sf_dir):
    return tables.existing_values(tables.distinct_values(log_rows(spark, sf_dir), "name", ("i",)), tables.distinct_values(log_rows(spark, sf_dir).where("k % 2 = 0"), "name", ("i",)))


@query("dim_new", f"{LOG_T} select distinct 'cust ' || k as key, 'Cust ' || k as value from t where k % 2 <> 0")
def dim_new(spark, sf_dir):
    return tables.new_values(tables.distinct_values(log_rows(spark, sf_dir), "name", ("i",)), tables.distinct_values(log_rows(spark, sf_dir).where("k % 2 = 0"), "name", ("i",)))


@query("dim_ids", f"{LOG_T} select key, value, 1000 + row_number() over (order by key) as id from (select distinct 'cust ' || k as key, 'Cust ' || k as value from t)")
def dim_ids(spark, sf_dir):
    return tables.numbered(tables.distinct_values(log_rows(spark, sf_dir), "name", ("i",)), after=1000)


@query("resolve_dim", f"{LOG_T} select i, dense_rank() over (order by 'cust ' || k) as name_id from t")
def resolve_dim(spark, sf_dir):
    return tables.resolved(log_rows(spark, sf_dir), names(spark, sf_dir), "name", "name_id").select("i", "name_id")


@query("resolve_shared_dim", f"{LOG_T}, d as (select key, row_number() over (order by key) as id from (select lower(race) as key from t union select lower(cls) from t)) select i, a.id as race_id, b.id as cls_id from t join d a on a.key = lower(race) join d b on b.key = lower(cls)")
def resolve_shared_dim(spark, sf_dir):
    rows = log_rows(spark, sf_dir)
    dimension = tables.numbered(tables.shared_values(rows, ["race", "cls"], ("i",)))
    return tables.resolved_all(rows, dimension, {"race": "race_id", "cls": "cls_id"}).select("i", "race_id", "cls_id")


# -- deduplication and reports -------------------------------------------------------------------------------------


@query("dedup_first", "select min(doc_id) as i, md5(text) as hash from documents group by 2")
def dedup_first(spark, sf_dir):
    rows = documents(spark, sf_dir).withColumn("file", F.lit("f"))
    return tables.first_of_hash(rows).select("i", "hash")


@query("dedup_known", "select doc_id as i, md5(text) as hash from documents where md5(text) not in (select md5(text) from documents where doc_id % 3 = 0)")
def dedup_known(spark, sf_dir):
    rows = documents(spark, sf_dir)
    return tables.not_known(rows, rows.where("i % 3 = 0")).select("i", "hash")


@query("load_report", "select lang as \"table\", count(*) as rows_in, count(*) filter (f) as rows_kept, count(*) filter (not f) as skipped from (select lang, doc_id = min(doc_id) over (partition by md5(text)) as f from documents) group by 1")
def load_report(spark, sf_dir):
    rows = documents(spark, sf_dir).withColumn("file", F.lit("f"))
    return tables.load_report(rows, tables.first_of_hash(rows))


@query("last_offset", "select source as file, max(doc_id) as file_offset from documents group by 1")
def last_offset(spark, sf_dir):
    return tables.last_offsets(documents(spark, sf_dir))


@query("file_offsets", "with n as (select source as file, max(doc_id) as a, max(doc_id) filter (lang <> 'en') as b from documents where source <> 'src1' group by 1), o as (select source as file, min(doc_id) as m from documents group by 1) select o.file, coalesce(n.b, o.m) as file_offset from o left join n on o.file = n.file")
def file_offsets(spark, sf_dir):
    old = documents(spark, sf_dir).groupBy("file").agg(F.min("offset").alias("file_offset"))
    path = workspace.folder(spark)
    old.write.parquet(path)
    batch = documents(spark, sf_dir).where("table <> 'en' and file <> 'src1'")
    return sinks.replaced(tables.merged_offsets(spark.read.parquet(path), batch), path)


@query("field_drift", f"{LOG_T}, n as (select count(*) as n from t where i % 97 <> 0) select field, n, 'A' as status from n, (select unnest(['vlong', 'char', 'tiles', 'place', 'start', 'end', 'gold', 'goldfound', 'goldspent', 'sc', 'ktyp', 'killer', 'kaux']) as field) union all select unnest(['god', 'banisher']), 0, 'D'")
def field_drift(spark, sf_dir):
    declared = spark.createDataFrame([(x,) for x in ("v", "name", "race", "cls", "god", "banisher")], "field string")
    return tables.field_drift(records(spark, sf_dir), declared)


@query("last_update", "select l_orderkey as game_key, l_suppkey % 3 as part, arg_max(l_partkey, cast(l_linenumber as bigint) * 1000000000 + l_partkey) as ntv from lineitem group by 1, 2")
def last_update(spark, sf_dir):
    rows = fixtures.table(spark, sf_dir, "lineitem").select(c("l_orderkey").alias("game_key"), (c("l_suppkey") % 3).alias("part"), c("l_partkey").alias("ntv"), (c("l_linenumber").cast("long") * 1000000000 + c("l_partkey")).alias("at"))
    return tables.last_updates(rows, ["game_key", "part"], "ntv", "at")


@query("list_files", "select distinct source as file from documents")
def list_files(spark, sf_dir):
    return documents(spark, sf_dir).select("file").distinct().orderBy("file")


@query("union_variants", "select o_orderkey as id, 'logrecord' as \"table\", o_totalprice as sc, cast(null as varchar) as verb from orders union all select event_id, 'spr_milestone', null, event_type from events")
def union_variants(spark, sf_dir):
    log = fixtures.table(spark, sf_dir, "orders").select(c("o_orderkey").alias("id"), c("o_totalprice").alias("sc"))
    mile = fixtures.table(spark, sf_dir, "events").select(c("event_id").alias("id"), c("event_type").alias("verb"))
    return tables.all_variants({"logrecord": log, "spr_milestone": mile})


# -- joins and repairs ---------------------------------------------------------------------------------------------


def verbs_and_gods(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Events as milestones with ids of verb, god and noun."""
    facts = fixtures.table(spark, sf_dir, "events").select(c("event_id").alias("id"), (c("event_id") % 5 + 1).alias("verb_id"), (c("user_id") % 4 + 1).alias("god_id"), F.lit(1).cast("long").alias("noun_id"))
    dim = lambda values: spark.createDataFrame([(k + 1, v.lower(), v) for k, v in enumerate(values)], "id bigint, key string, value string")
    return facts, dim(["god.ecumenical", "rune", "uniq", "ghost", "orb"]), dim(["Okawaru", "Trog", "Xom", "Zin"])


GODS = "case user_id % 4 when 0 then 'Okawaru' when 1 then 'Trog' when 2 then 'Xom' else 'Zin' end"


@query("join_star3", f"select event_id as id, {GODS} as god, 'god.ecumenical' as verb from events where event_id % 5 = 0")
def join_star3(spark, sf_dir):
    facts, verbs, gods = verbs_and_gods(spark, sf_dir)
    return maintenance.god_of_verb(facts, gods, verbs, "god.ecumenical").select("id", "god", "verb")


@query("fix_ecumenical", f"select event_id as id, case when event_id % 5 = 0 then {GODS} else '?' end as noun from events")
def fix_ecumenical(spark, sf_dir):
    facts, verbs, gods = verbs_and_gods(spark, sf_dir)
    nouns = spark.createDataFrame([(1, "?", "?")], "id bigint, key string, value string")
    fixed, grown = maintenance.fixed_ecumenical(facts, gods, verbs, workspace.stored(nouns))
    return fixed.join(workspace.stored(grown).select(c("id").alias("noun_id"), c("value").alias("noun")), "noun_id").select("id", "noun")


CHAR = "case i % 5 when 0 then 'Dr' when 1 then 'Gh' when 2 then 'Gn' when 3 then 'Na' end || case i % 4 when 0 then 'Fi' when 1 then 'Wz' when 2 then 'Sk' end"


def chars(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Log rows with a char that is wrong for each sixth, and abbreviations."""
    abbr = lambda d: spark.createDataFrame(list(d.items()), "name string, abbr string")
    rows = log_rows(spark, sf_dir).select(c("i").alias("id"), c("race").alias("crace"), "cls", F.when(c("i") % 6 == 0, F.lit("XxYy")).otherwise(F.expr(f"coalesce({CHAR}, 'QqQq')")).alias("char"))
    return rows, abbr(BOOK.species), abbr(BOOK.jobs)


@query("join_mismatch", f"{LOG_T}, r as (select i as id, case when i % 5 < 4 and i % 4 < 3 then {CHAR} end as good, case when i % 6 = 0 then 'XxYy' when i % 5 = 4 or i % 4 = 3 then 'QqQq' else {CHAR} end as char, i from t) select id, char, coalesce(good, char) as \"right\" from r where char <> coalesce(good, '') and not (i % 5 = 4 and i % 4 = 3)")
def join_mismatch(spark, sf_dir):
    rows, species, jobs = chars(spark, sf_dir)
    return maintenance.mismatched(rows, species, jobs).select("id", "char", "right")


@query("fix_char", f"{LOG_T} select i as id, case when i % 5 < 4 and i % 4 < 3 then {CHAR} when i % 6 = 0 then 'XxYy' else 'QqQq' end as char from t")
def fix_char(spark, sf_dir):
    rows, species, jobs = chars(spark, sf_dir)
    dimension = workspace.stored(tables.numbered(tables.distinct_values(rows, "char", ("id",))).select("id", "key", "value"))
    facts = tables.resolved(rows, dimension, "char", "char_id").drop("char")
    fixed, grown = maintenance.fixed_char(facts, dimension, species, jobs)
    return fixed.join(workspace.stored(grown).select(c("id").alias("char_id"), c("value").alias("char")), "char_id").select("id", "char")


@query("fix_field", "select event_id as id, case event_id % 5 when 0 then 'Shoals:1' when 1 then 'Vaults' else 'D:' || (event_id % 7) end as place from events")
def fix_field(spark, sf_dir):
    place = F.when(c("event_id") % 5 == 0, F.lit("shoal:1")).when(c("event_id") % 5 == 1, F.lit("V")).otherwise(F.concat(F.lit("D:"), (c("event_id") % 7).cast("string")))
    rows = fixtures.table(spark, sf_dir, "events").select(c("event_id").alias("id"), place.alias("place"))
    dimension = workspace.stored(tables.numbered(tables.distinct_values(rows, "place", ("id",))).select("id", "key", "value"))
    facts = tables.resolved(rows, dimension, "place", "place_id").select("id", "place_id")
    fixed, grown = maintenance.fixed_field(facts, dimension, rules.Rule("place", exact=[("V", "Vaults")], regexp=[("^shoal\\b", "Shoals")]), "place_id")
    return fixed.join(workspace.stored(grown).select(c("id").alias("place_id"), c("value").alias("place")), "place_id").select("id", "place")


@query("renumber_versions", f"{LOG_T} select distinct v as value, {VNUM} as vnum from t")
def renumber_versions(spark, sf_dir):
    path = workspace.folder(spark)
    tables.distinct_values(log_rows(spark, sf_dir), "v", ("i",), derived={"vnum": F.lit(0).cast("long")}).write.parquet(path)
    return sinks.replaced(maintenance.renumbered(spark.read.parquet(path), "vnum"), path).select("value", "vnum")


@query("update_from_values", "select o_orderkey as id, case when o_orderkey % 10 = 0 then -1.0 else o_totalprice end as sc, o_orderstatus as status from orders")
def update_from_values(spark, sf_dir):
    facts = fixtures.table(spark, sf_dir, "orders").select(c("o_orderkey").alias("id"), c("o_totalprice").alias("sc"), c("o_orderstatus").alias("status"))
    return tables.updated(facts, facts.where("id % 10 = 0").select("id", F.lit(-1.0).alias("sc")), ["id"], ["sc"])


GAMES = "select o_orderkey as id, 'Cust_' || o_custkey || ':cao:' || o_orderkey as game_key, 'e' || o_orderkey % 3 as rend, o_orderkey % 4 as ntv from orders"


def games(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders as games with ntv, and their dimension of game keys, which count case and keep underscores as spaces."""
    key = F.concat(F.lit("Cust_"), c("o_custkey").cast("string"), F.lit(":cao:"), c("o_orderkey").cast("string"))
    rows = fixtures.table(spark, sf_dir, "orders").select(c("o_orderkey").alias("id"), key.alias("game_key"), F.concat(F.lit("e"), (c("o_orderkey") % 3).cast("string")).alias("rend"), (c("o_orderkey") % 4).alias("ntv"), F.lit("logrecord").alias("table"), F.lit(None).cast("string").alias("rtime"))
    keys = workspace.stored(tables.numbered(tables.distinct_values(rows, "game_key", ("id",), True)).select("id", "key", "value"))
    return tables.resolved(rows, keys, "game_key", "game_key_id", True), keys


@query("merge_composite", f"select id, case when id % 6 = 0 then 77 else ntv end as ntv from ({GAMES})")
def merge_composite(spark, sf_dir):
    facts, keys = games(spark, sf_dir)
    updates = facts.where("id % 2 = 0").select("game_key", F.lit("e0").alias("rowtime"), F.lit(77).cast("long").alias("ntv"))
    return maintenance.merged_by_game(facts, keys, updates, "rend").select("id", "ntv")


@query("export_tv", f"select 'logrecord' || chr(9) || replace(game_key, '_', ' ') || chr(9) || rend || chr(9) || ntv as value from ({GAMES}) where ntv > 0")
def export_tv(spark, sf_dir):
    facts, keys = games(spark, sf_dir)
    path = workspace.folder(spark)
    sinks.tv_lines(facts, keys).write.text(path)
    return spark.read.text(path)


@query("import_tv", f"select id, case when id % 6 = 0 then 9 else ntv end as ntv from ({GAMES})")
def import_tv(spark, sf_dir):
    facts, keys = games(spark, sf_dir)
    line = F.concat_ws("\t", F.lit("logrecord"), F.replace("game_key", F.lit("_"), F.lit(" ")), F.lit("e0"), c("x").cast("string"))
    some = facts.where("id % 2 = 0").select("*", F.explode(F.array(F.lit(8), F.lit(9))).alias("x"))
    lines = some.select(F.when(c("id") % 4 == 0, line).otherwise(line).alias("value"), (c("id") * 10 + c("x")).alias("position"))
    broken = facts.select(F.lit("no tabs").alias("value"), c("id").alias("position"))
    good, _ = sinks.tv_parsed(lines.unionByName(broken))
    last = tables.last_updates(good, ["game_key", "rowtime"], "ntv", "position").withColumn("ntv", c("ntv").cast("long"))
    return maintenance.merged_by_game(facts, keys, last, "rend").select("id", "ntv")


@query("cascade_delete", "select doc_id as i, source as file from documents where source not in ('src1', 'src2')")
def cascade_delete(spark, sf_dir):
    return tables.without(documents(spark, sf_dir), spark.createDataFrame([("src1",), ("src2",)], "file string"), "file").select("i", "file")


@query("delete_files", "select 'fact' as kind, count(*) as n from documents where source <> 'src3' union all select 'file', count(distinct source) from documents where source <> 'src3' union all select 'offset', count(distinct source) from documents where source <> 'src3'")
def delete_files(spark, sf_dir):
    rows = documents(spark, sf_dir)
    files = workspace.stored(tables.numbered(tables.distinct_values(rows, "file", ("i",), True)).select("id", "key", "value"))
    facts = tables.resolved(rows, files, "file", "file_id", True)
    left = maintenance.without_files(facts, files, tables.last_offsets(rows), ["src3"])
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(k).alias("kind"), "n") for k, df in zip(("fact", "file", "offset"), left, strict=True)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# -- sinks and the load --------------------------------------------------------------------------------------------


@query("write_facts", "select o_orderkey as id, 'logrecord' as \"table\", o_totalprice as sc from orders")
def write_facts(spark, sf_dir):
    path = workspace.folder(spark)
    sinks.write_facts(fixtures.table(spark, sf_dir, "orders").select(c("o_orderkey").alias("id"), c("o_totalprice").alias("sc"), F.lit("logrecord").alias("table")), path)
    return spark.read.parquet(path).select("id", c("table").cast("string").alias("table"), "sc")


@query("route_tables", "select case event_id % 3 when 0 then 'milestone' when 1 then 'spr_milestone' else 'zot_milestone' end as \"table\", count(*) as n from events group by 1")
def route_tables(spark, sf_dir):
    path = workspace.folder(spark)
    table = F.when(c("event_id") % 3 == 0, F.lit("milestone")).when(c("event_id") % 3 == 1, F.lit("spr_milestone")).otherwise(F.lit("zot_milestone"))
    sinks.write_facts(fixtures.table(spark, sf_dir, "events").select("event_id", table.alias("table")), path)
    return spark.read.parquet(path).groupBy(c("table").cast("string").alias("table")).agg(F.count(F.lit(1)).alias("n"))


@query("write_dims", f"{LOG_T} select key, value, row_number() over (order by odd, key) as id from (select distinct k % 2 as odd, 'cust ' || k as key, 'Cust ' || k as value from t)")
def write_dims(spark, sf_dir):
    path = workspace.folder(spark)
    first = tables.numbered(tables.distinct_values(log_rows(spark, sf_dir).where("k % 2 = 0"), "name", ("i",))).select("id", "key", "value")
    sinks.write_dimension(first, path)
    old = spark.read.parquet(path)
    top = old.agg(F.max("id")).first()[0]
    sinks.write_dimension(tables.numbered(tables.new_values(tables.distinct_values(log_rows(spark, sf_dir), "name", ("i",)), old), after=top).select("id", "key", "value"), path)
    return spark.read.parquet(path)


LOGS_ONLY = load.Design({"logrecord": fixtures.LOG_FIELDS})
#: Both kinds of records, each with fields of its own; two fields share the dimension of places, and versions keep their number.
BOTH = load.Design({"logrecord": fixtures.LOG_FIELDS, "milestone": fixtures.MILESTONE_FIELDS}, shared={"place": ("place", "oplace")}, derived={"cv": ("cvnumIB",)})


def log_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log lines as if scanned, a file for each server and game."""
    lines = log_lines(spark, sf_dir).withColumn("game", F.when(c("i") % 4 == 0, F.lit("sprint")).otherwise(F.lit("")))
    return lines.select(F.concat("src", F.lit("/meta/git/logfile"), F.when(c("game") == "", F.lit("")).otherwise(F.lit("-sprint"))).alias("file"), c("i").alias("offset"), "line", "src", "game")


def milestone_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = fixtures.lines(spark, sf_dir, fixtures.MILESTONE)
    return lines.select(F.lit("cszo/meta/git/milestones").alias("file"), c("i").alias("offset"), "line", "src", F.lit("").alias("game"))


def loaded(spark: SparkSession, sf_dir: str) -> tuple[load.Star, DataFrame]:
    """Log lines loaded in two batches that overlap."""
    star, lines = load.Star(workspace.folder(spark)), log_files(spark, sf_dir)
    load.load(lines.where("offset % 3 < 2"), star, BOOK, fixtures.servers(spark), LOGS_ONLY)
    return star, load.load(lines.where("offset % 3 > 0"), star, BOOK, fixtures.servers(spark), LOGS_ONLY)


def named(spark: SparkSession, star: load.Star, facts: DataFrame, design: load.Design, **columns: str) -> DataFrame:
    """facts with the values of id columns: column=dimension."""
    for column, dimension in columns.items():
        values = star.dimension(spark, dimension, design).select(c("id").alias(f"{column}_id"), c("value").alias(column))
        facts = facts.join(tables.joinable(values), f"{column}_id")
    return facts


LOADED = GOOD.format("select i as file_offset, 'Cust ' || k as pname, '0.' || (i % 25) || case when i % 4 in (1, 2) then '-a' else '' end as cv, case when i % 4 = 0 then 'spr_logrecord' else 'logrecord' end as \"table\", cast(floor(p) as bigint) as sc from t")


@query("load_batch", LOADED)
def load_batch(spark, sf_dir):
    star, _ = loaded(spark, sf_dir)
    facts = named(spark, star, star.facts(spark, "logrecord", LOGS_ONLY), LOGS_ONLY, pname="name", cv="cv")
    return facts.select("file_offset", "pname", "cv", "table", "sc")


@query("load_batch_report", LOG_T + " select case when i % 4 = 0 then 'spr_logrecord' else 'logrecord' end as \"table\", count(*) as rows_in, count(*) filter (i % 3 = 2) as rows_kept, count(*) filter (i % 3 = 1) as skipped from t where i % 97 <> 0 and i % 3 > 0 group by 1")
def load_batch_report(spark, sf_dir):
    return loaded(spark, sf_dir)[1]


VERSION_NUMBER = "(i % 25) * 100000000000 + case when i % 4 in (1, 2) then 1000000 else 99000000 end"
KINDS_SQL = GOOD.format(f"""select i as file_offset, case when i % 4 = 0 then 'spr_logrecord' else 'logrecord' end as "table", 'Cust ' || k as pname, '0.' || (i % 25) || case when i % 4 in (1, 2) then '-a' else '' end as cv,
    {VERSION_NUMBER} as cvnum, 'D:' || (i % 15 + 1) as place, cast(floor(p) as bigint) as sc, cast(null as varchar) as noun, cast(null as varchar) as props, cast(null as int) as lot from t""")
KINDS_SQL += """ union all select event_id, 'milestone', 'user ' || user_id, '0.16-a', 16 * 100000000000 + 1000000, 'Snake:' || (event_id % 5 + 1), null, {noun}, replace(props, '_', ' '),
    coalesce(try_cast(regexp_extract(props, '^.*?(\\d+)', 1) as int), 0) from events"""


@query("load_both_kinds", KINDS_SQL.replace("{noun}", NOUN.replace("'user_'", "'user '")))
def load_both_kinds(spark, sf_dir):
    """One load of logs and milestones: a field list each, a shared dimension, one with a derived column, and fields that no rule of the library reads."""
    star = load.Star(workspace.folder(spark))
    load.load(log_files(spark, sf_dir).unionByName(milestone_files(spark, sf_dir)), star, BOOK, fixtures.servers(spark), BOTH)
    facts = load.all_facts(spark, star, BOTH)
    # a log's place is plain text, a milestone's is in the dimension that it shares
    places = star.dimension(spark, "place", BOTH)
    versions = star.dimension(spark, "cv", BOTH).select(c("id").alias("cv_id"), c("value").alias("cv"), "cvnum")
    facts = facts.join(versions, "cv_id").join(places.select(c("id").alias("oplace_id"), c("value").alias("__place")), "oplace_id", "left")
    facts = named(spark, star, facts, BOTH, pname="name")
    return facts.select("file_offset", "table", "pname", "cv", "cvnum", F.coalesce("__place", "place").alias("place"), "sc", "noun", "props", "lot")


@query("games_by_version", GOOD.format("select '0.' || (i % 25) || case when i % 4 in (1, 2) then '-a' else '' end as cv, count(*) as games, max(cast(floor(p) as bigint)) as best_score from t") + " group by 1")
def games_by_version(spark, sf_dir):
    """The flagship: lines to records to a report by version."""
    rows = records(spark, sf_dir)
    f = c("fields")
    return rows.groupBy(version.canonical(f["v"]).alias("cv")).agg(F.count(F.lit(1)).alias("games"), F.max(f["sc"].cast("long")).alias("best_score"))


# -- repairs of a loaded star --------------------------------------------------------------------------------------


def one_load(spark: SparkSession, sf_dir: str, design: load.Design, book=BOOK, lines: DataFrame | None = None) -> load.Star:
    star = load.Star(workspace.folder(spark))
    load.load(log_files(spark, sf_dir) if lines is None else lines, star, book, fixtures.servers(spark), design)
    return star


@query("star_fix_char", GOOD.format("select i as file_offset, case when i % 5 < 4 and i % 4 < 3 then {} else 'XxYy' end as char from t").replace("{}", CHAR))
def star_fix_char(spark, sf_dir):
    """Lines loaded without abbreviations, which are learnt afterwards; chars are in a dimension."""
    fields = [f"{f}^" if f == "char" else f for f in fixtures.LOG_FIELDS]
    design = load.Design({"logrecord": fields})
    star = one_load(spark, sf_dir, design, replace(BOOK, species={}, jobs={}))
    _, species, jobs = chars(spark, sf_dir)
    repairs.fix_char(spark, star, design, species, jobs)
    return named(spark, star, star.facts(spark, "logrecord", design), design, char="char").select("file_offset", "char")


@query("star_fix_field", GOOD.format("select i as file_offset, 'Dungeon:' || (i % 15 + 1) as place from t") + " union all select event_id, 'Serpent:' || (event_id % 5 + 1) from events")
def star_fix_field(spark, sf_dir):
    """A rule for a plain column, and one for a dimension that two fields share."""
    lines = log_files(spark, sf_dir).unionByName(milestone_files(spark, sf_dir))
    star = one_load(spark, sf_dir, BOTH, lines=lines)
    repairs.fix_field(spark, star, BOTH, rules.Rule("place", regexp=[("^D:", "Dungeon:")]))
    repairs.fix_field(spark, star, BOTH, rules.Rule("place", regexp=[("^Snake:", "Serpent:")]), "milestone")
    logs, miles = star.facts(spark, "logrecord", BOTH).select("file_offset", "place"), star.facts(spark, "milestone", BOTH)
    return logs.unionByName(named(spark, star, miles, BOTH, place="place").select("file_offset", "place"))


@query("star_fix_ecumenical", f"select event_id as file_offset, case when event_type = 'signup' then 'Okawaru' else {NOUN.replace(chr(39) + 'user_' + chr(39), chr(39) + 'user ' + chr(39))} end as noun from events")
def star_fix_ecumenical(spark, sf_dir):
    """The noun of one verb's milestones is their god."""
    design = load.Design({"milestone": fixtures.MILESTONE_FIELDS})
    star = one_load(spark, sf_dir, design, lines=milestone_files(spark, sf_dir))
    repairs.fix_ecumenical(spark, star, design, verb="rune")
    return star.facts(spark, "milestone", design).select("file_offset", "noun")


@query("star_import_tv", GOOD.format("select i as file_offset, case when i % 2 = 0 then 77 else 0 end as ntv from t"))
def star_import_tv(spark, sf_dir):
    star = one_load(spark, sf_dir, LOGS_ONLY)
    facts = star.facts(spark, "logrecord", LOGS_ONLY).where("file_offset % 2 = 0")
    updates = workspace.stored(facts.select("game_key", c("rend").alias("rowtime"), F.lit(77).cast("long").alias("ntv")).distinct())
    repairs.import_tv(spark, star, LOGS_ONLY, updates)
    return star.facts(spark, "logrecord", LOGS_ONLY).select("file_offset", "ntv")


@query("star_renumber_versions", GOOD.format(f"select distinct '0.' || (i % 25) || case when i % 4 in (1, 2) then '-a' else '' end as value, {VERSION_NUMBER} as cvnum from t"))
def star_renumber_versions(spark, sf_dir):
    """Numbers of an older rule in a loaded dimension, put right."""
    design = load.Design({"logrecord": fixtures.LOG_FIELDS}, derived={"cv": ("cvnumIB",)})
    star = one_load(spark, sf_dir, design)

    def older(edit: repairs.Edit) -> None:
        schema = load.dimension_schema(design)
        edit.rewrite("dimensions", schema, edit.read("dimensions", schema).where("dimension = 'cv'").select("load", "__file").distinct(), lambda rows: rows.withColumn("cvnum", F.lit(-1).cast("long")), "dimension")

    repairs._edited(spark, star, design, "older numbers", older)
    repairs.renumber_versions(spark, star, design, "cv", "cvnum")
    return star.dimension(spark, "cv", design).select("value", "cvnum")


@query("reload_deleted", LOADED)
def reload_deleted(spark, sf_dir):
    """Two loads, of which one file is deleted, the loads compacted, and all lines loaded again: each line is there once."""
    star, _ = loaded(spark, sf_dir)
    repairs.delete_files(spark, star, LOGS_ONLY, ["cszo/meta/git/logfile"])
    repairs.compacted(spark, star, LOGS_ONLY, least=2)
    commits.vacuumed(star.log, spark, hours=0)  # nobody else reads this star: what it no longer names is removed at once
    load.load(log_files(spark, sf_dir), star, BOOK, fixtures.servers(spark), LOGS_ONLY)
    facts = named(spark, star, star.facts(spark, "logrecord", LOGS_ONLY), LOGS_ONLY, pname="name", cv="cv")
    return facts.select("file_offset", "pname", "cv", "table", "sc")
