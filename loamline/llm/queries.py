"""The queries of this subpackage's operators over their whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import alignment, decontaminate, html, jaccard, langid, merkle, packing, pii, preferences, quality, secrets, sharding, urls
from .common import table

#: The rules of the URL query.
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fitted(docs, ~langid.held_out())
    found = langid.predicted(docs.select("doc_id", "text"), model)
    return found.select(found.doc_id.cast("long").alias("doc_id"), langid.held_out().alias("held_out"), "lang_pred", "score")


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.classes(table(spark, sf_dir, "documents"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secrets.scanned(docs, secrets.fitted(docs))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extracted(table(spark, sf_dir, "pages"))


def op5_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preferences.formatted(preferences.paired(table(spark, sf_dir, "conversations")))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.verdicts(table(spark, sf_dir, "pages"), URL_RULES)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_line_cleaning(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.cleaned(table(spark, sf_dir, "documents"))


def op9_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.curve_shards(table(spark, sf_dir, "documents"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"))


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.scanned(docs, pii.fitted(docs))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.aligned(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_language_id, op2_jaccard_join, op3_secret_scan, op4_html_text, op5_preferences, op6_url_filter, op7_decontamination, op8_line_cleaning, op9_hilbert_shards, op10_best_fit_packing, op11_merkle_manifest, op12_personal_data, op13_token_alignment)}


def oracle_sql() -> dict[str, str]:
    return {"op6_url_filter": OP6, "op5_preferences": OP5, "op11_merkle_manifest": op11_sql()}


OP6 = r"""
with u as (
  select page_id, url, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
s as (
  select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from u),
r(rh, rp, v) as (values ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
b as (
  select s.*, (select {'rule': rh || rp, 'v': v} from r where (host = rh or ends_with(host, '.' || rh)) and starts_with(path, rp)
    order by length(rh) desc, length(rp) desc limit 1) as m from s)
select page_id, host, path, m.rule as rule, coalesce(m.v, 'allow') as verdict from b
"""

OP5 = r"""
with t as (
  select distinct conv_id, turn, coalesce(role, 'user') as role, coalesce(text, '') as text from conversations where conv_id is not null),
c as (
  select conv_id, list({'role': role, 'text': text} order by turn nulls first, role, text) as turns from t group by 1),
k as (
  select conv_id, turns, turns[1] as opening, conv_id % (64 * (1 + (select count(*) from conversations) // 64000000)) as part from c),
n as (
  select conv_id, turns, opening, row_number() over (partition by opening order by part, conv_id) - 1 as rnk, count(*) over (partition by opening) as al from k),
p as (
  select x.conv_id as xc, y.conv_id as yc, x.turns as a, y.turns as b, x.rnk = x.al - 1 as alone
  from n x left join n y on x.opening = y.opening and y.rnk = x.rnk + 1 where x.rnk % 2 = 0),
q as (
  select least(xc, coalesce(yc, xc)) as xc, case when yc is null then null else greatest(xc, yc) end as yc, alone,
    case when yc < xc then b else a end as a, case when yc < xc then a else b end as b from p),
w as (
  select *, not alone and len(b) > len(a) as swap,
    coalesce(list_max(list_transform(a, lambda t, i: case when t.role = 'assistant' then i else 0 end)), 0) as la from q),
z as (
  select case when swap then yc else xc end as chosen_conv, case when alone then null when swap then xc else yc end as rejected_conv,
    case when swap then b else a end as ch,
    case when alone then list_transform(a, lambda t, i: {'role': t.role, 'text': case when i = la then substr(t.text, 1, length(t.text) // 2) else t.text end})
      when swap then a else b end as rj from w),
l as (
  select *, coalesce(list_min(list_filter(list_transform(range(1, least(len(ch), len(rj)) + 1), lambda i: case when ch[i] = rj[i] then null else i end), lambda x: x is not null)) - 1,
    least(len(ch), len(rj))) as np from z),
e as (
  select chosen_conv, rejected_conv, np, ch[1:np] as pr, ch[np + 1:] as ca, rj[np + 1:] as rb from l),
m as (
  select *, list_transform(ca, lambda t: '<|im_start|>' || t.role || chr(10) || t.text || '<|im_end|>' || chr(10)) as cs,
    list_transform(rb, lambda t: '<|im_start|>' || t.role || chr(10) || t.text || '<|im_end|>' || chr(10)) as rs from e)
select chosen_conv, rejected_conv, cast(np as bigint) as n_prompt_turns,
  coalesce(array_to_string(list_transform(pr, lambda t: '<|im_start|>' || t.role || chr(10) || t.text || '<|im_end|>' || chr(10)), ''), '') as prompt,
  coalesce(array_to_string(cs, ''), '') as chosen,
  coalesce(array_to_string(list_filter(list_transform(ca, lambda t, i: case when t.role = 'assistant' then
    (length(array_to_string(cs[1:i - 1], '')) + 13 + length(t.role)) || ':' || (length(array_to_string(cs[1:i], '')) - 1) end), lambda x: x is not null), ','), '') as chosen_mask,
  coalesce(array_to_string(rs, ''), '') as rejected,
  coalesce(array_to_string(list_filter(list_transform(rb, lambda t, i: case when t.role = 'assistant' then
    (length(array_to_string(rs[1:i - 1], '')) + 13 + length(t.role)) || ':' || (length(array_to_string(rs[1:i], '')) - 1) end), lambda x: x is not null), ','), '') as rejected_mask
from m
"""


def op11_sql(levels: int = 8) -> str:
    """DuckDB SQL of the manifest for up to 8 to the power of `levels` documents a language, and as many languages."""
    framed = lambda c, text: f"coalesce(strlen({text}) || ':' || {text}, '-')"
    leaf = lambda text: "sha256(" + " || ".join(framed(c, text if c == "text" else f"cast({c} as varchar)") for c in ("doc_id", "source", "lang", "n_chars", "text")) + ")"
    crc = "xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(cast(doc_id as varchar), ''), lambda x: ord(x)::bigint)), lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda c, d: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)), 4294967295)"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    out = [f"k as (select doc_id, lang, {leaf('text')} as leaf, case when {crc} % 3 = 0 then {leaf(lower)} end as changed from documents)"]
    out.append("b as (select *, dense_rank() over (order by lang nulls first) - 1 as g, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as i, count(*) over (partition by lang) as n from k)")

    def tree(name: str, first: str) -> str:
        """Levels name0 and on of nodes (g, i, n, d) with what stands left and right in their runs; the last has the roots."""
        source = first
        for level in range(levels):
            both = [f"coalesce(string_agg(d, '') over (partition by g, i // 8 order by i rows between {rows}), '')" for rows in ("unbounded preceding and 1 preceding", "1 following and unbounded following")]
            out.append(f"{name}{level} as (select g, i, n, d, {both[0]} as l, {both[1]} as r from {source})")
            source = f"(select g, i // 8 as i, (n + 7) // 8 as n, case when n = 1 then any_value(d) else sha256(string_agg(d, '' order by i)) end as d from {name}{level} group by g, i // 8, n)"
        out.append(f"{name}{levels} as (select g, d from {source})")
        return name

    tree("s", "(select g, i, n, leaf as d from b)")
    tree("t", f"(select 0 as g, g as i, count(*) over () as n, d from s{levels})")
    path = [f"s{k}" for k in range(levels)] + [f"t{k}" for k in range(levels)]
    joins = [f"join s{k} on s{k}.g = b.g and s{k}.i = b.i // {8**k}" for k in range(levels)] + [f"join t{k} on t{k}.i = b.g // {8**k}" for k in range(levels)]
    out.append(f"p as (select b.doc_id, b.leaf, s{levels}.d as subroot, t{levels}.d as root, coalesce(b.changed, b.leaf) as x, [{', '.join(f'{{n: {p}.n, l: {p}.l, r: {p}.r}}' for p in path)}] as path from b {' '.join(joins)} join s{levels} on s{levels}.g = b.g cross join t{levels})")
    fold = f"list_reduce(list_prepend({{n: 0::bigint, l: x, r: ''}}, list_filter(path, lambda y: y.n > 1)), lambda a, y: {{n: 0::bigint, l: sha256(y.l || a.l || y.r), r: ''}}).l"
    out.append(f"f as (select *, {fold} as folded_root, sha256(array_to_string(list_transform(path, lambda y: y.l || y.r), '')) as proof_sha256 from p)")
    return f"with {', '.join(out)} select doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root as verified from f"
