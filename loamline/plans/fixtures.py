"""Log lines made from the given tables, by SQL that Spark and DuckDB both run, and small rule tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loamline.functions.killer import Names
from loamline.operators.normalize import RuleBook
from loamline.operators.rules import Rule

LOG = """
with b as (
  select o.o_orderkey as i, o.o_custkey as k, o.o_orderdate as d, o.o_totalprice as p
  from {orders} o join {customer} c on o.o_custkey = c.c_custkey),
t as (
  select i, k, p,
    case i % 3 when 0 then 'cao' when 1 then 'cdo' else 'cszo' end as src,
    '0.' || cast(i % 25 as string) || case i % 4 when 0 then '' when 1 then '-a0' when 2 then '-rc1' else '.3' end as v,
    cast(year(d) as string) || lpad(cast(month(d) - 1 as string), 2, '0') || lpad(cast(day(d) as string), 2, '0') as ymd,
    case i % 2 when 0 then 'S' else 'D' end as z,
    case i % 5 when 0 then 'Draconian' when 1 then 'Ghoul' when 2 then 'Gnoll' when 3 then 'Naga' else 'Gherkin' end as race,
    case i % 4 when 0 then 'Fighter' when 1 then 'Wizard' when 2 then 'Skald' else 'Yak' end as cls,
    case i % 8 when 0 then 'a two-headed hydra' when 1 then 'Foobar' || chr(39) || 's ghost' when 2 then 'a red draconian shifter'
      when 3 then 'a yak (shapeshifter)' when 4 then 'a green very ugly thing' when 5 then 'Bogdan the orc'
      when 6 then 'Grum' else 'a bat skeleton' end as killer,
    case i % 5 when 0 then 'a +2 sling (mu)' when 1 then 'Hit by a dart thrown by a horse' when 2 then 'an elven crossbow'
      when 3 then 'a cursed dagger' else '' end as kaux,
    case i % 4 when 0 then '1' when 1 then '0' when 2 then 'f' else '' end as tiles
  from b)
select i, src,
  concat_ws('', 'v=', v, ':vlong=', v, '-', cast(i % 500 as string), '-gabc123:name=Cust_', cast(k as string),
    ':race=', race, ':cls=', cls, ':char=XxYy:tiles=', tiles,
    ':place=D::', cast(i % 15 + 1 as string), ':start=', ymd, '120000', z, ':end=', ymd, '130000', z,
    ':gold=', cast(i % 7 - 1 as string), ':goldfound=', cast(i % 50 as string), ':goldspent=', cast(i % 11 as string),
    ':sc=', cast(cast(floor(p) as bigint) as string), ':ktyp=mon:killer=', killer, ':kaux=', kaux,
    case when i % 97 = 0 then ':junk' else '' end) as line
from t
"""

MILESTONE = """
select event_id as i, 'cszo' as src,
  concat_ws('', 'v=0.16-a0:name=user_', cast(user_id as string),
    ':start=', cast(year(ts) as string), lpad(cast(month(ts) - 1 as string), 2, '0'), lpad(cast(day(ts) as string), 2, '0'), '000000S',
    ':time=', cast(year(ts) as string), lpad(cast(month(ts) - 1 as string), 2, '0'), lpad(cast(day(ts) as string), 2, '0'),
    lpad(cast(hour(ts) as string), 2, '0'), lpad(cast(minute(ts) as string), 2, '0'), lpad(cast(second(ts) as string), 2, '0'), 'S',
    ':place=Snake::', cast(event_id % 5 + 1 as string), ':god=okawaru:props=', replace(props, ':', '::'),
    ':type=', case event_type when 'click' then 'unique' when 'view' then 'br.enter' when 'purchase' then 'god.worship' when 'signup' then 'rune' else 'ghost' end,
    ':milestone=', case event_type
       when 'click' then (case event_id % 3 when 0 then 'pacified Sigmund.' when 1 then 'slimified Maurice.' else 'killed Grum.' end)
       when 'view' then 'entered the Snake Pit.'
       when 'purchase' then 'became a worshipper of Okawaru.'
       when 'signup' then 'found a serpentine rune of Zot.'
       else 'banished the ghost of user_' || cast(user_id as string) || ' the Ruffian.' end) as line
from {events}
"""

DOC = """
select doc_id as i, 'cszo' as src,
  'v=0.15:name=' || lang || ':start=20140001000000S:end=20140001000000S:n_chars=' || cast(n_chars as string)
  || ':tmsg=' || replace(replace(replace(text, chr(10), ' '), chr(13), ' '), ':', '::') as line
from {documents}
"""

BOOK = RuleBook(
    places=[(r"^shoal\b", "Shoals"), (r"^V\b", "Vaults"), (r"^ice\z", "IceCv"), (r"^Labyrinth\z", "Lab")],
    gods={"okawaru": "Okawaru"},
    species={"Draconian": "Dr", "Ghoul": "Gh", "Gnoll": "Gn", "Naga": "Na"},
    jobs={"Fighter": "Fi", "Wizard": "Wz", "Skald": "Sk"},
    fields=[Rule("lot", "props", regexp=[('^.*?(\\d+).*\\z', "$1")])],
    branches="^(?:HEAD|release-)",
    games=[("sprint", ["sprint", "spr"]), ("zotdef", ["zotdef", "zd"]), ("nostalgia", ["nostalgia"])],
    prefixes={"sprint": "spr_", "zotdef": "zot_", "nostalgia": "nostalgia_"},
    names=Names(uniques=frozenset({"Grum", "Sigmund", "Maurice", "Ijyb", "Urug", "Blork"}), orcs=frozenset({"Hawl"}), lord="a pandemonium lord", special=("you", "miscasting", "unwield"), verbs={"unique": "uniq"}),
)

#: name, aliases, base, standard and daylight zone, epoch to which times are local.
SERVERS = [("cao", ["cao2"], "http://cao.example.org/", "-0500", "-0400", "200808070330Z"), ("cdo", [], "http://cdo.example.org/", "+0100", "+0200", "200808070330Z"), ("cszo", ["cßo"], "http://cszo.example.org/", None, None, None)]

#: Declared fields of the fact tables.
LOG_FIELDS = ["idPK%", "hash?[uuid]", "src^", "game_key", "v", "cv^", "vnumIB", "nameS?^", "race", "cls", "char", "place", "scIB", "goldIB", "tiles!", "ktyp", "ckiller^", "kmod", "ckaux", "ntvIB", "rstart", "rend", "start", "end"]

MILESTONE_FIELDS = ["idPK%", "hash?[uuid]", "src^", "nameS?^", "cv^", "place^", "oplace^", "god", "verb^", "noun", "props", "lotI", "start", "time"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lines(spark: SparkSession, sf_dir: str, which: str) -> DataFrame:
    """Rows (i, src, line) of LOG, MILESTONE or DOC."""
    names = [n for n in ("orders", "customer", "events", "documents") if "{" + n + "}" in which]
    return spark.sql(which, **{n: table(spark, sf_dir, n) for n in names})


def in_sql(which: str) -> str:
    """The same for DuckDB."""
    return which.format(**{n: n for n in ("orders", "customer", "events", "documents")})


def servers(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SERVERS, "name string, aliases array<string>, base string, zone_s string, zone_d string, utc_epoch string")
