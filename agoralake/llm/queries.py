"""The queries of this folder, each over its whole table, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from agoralake.llm import (
    decontaminate, embedding_dups, fuzzy_lines, hard_negatives, html_text, mixing, prefix_trie, quality, sharding, simhash,
    substring_dedup, suffix_dedup, token_counts)
from agoralake.session import configure, new_work_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn: Callable[[SparkSession, Callable[[str], DataFrame]], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(spark, lambda name: spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))
        QUERIES[fn.__name__] = run
        if sql:
            ORACLES[fn.__name__] = sql
        return fn
    return add


OP2_SQL = r"""
with d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
b as (select cast(item_id as varchar) as item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
bw as (select item_id, least(10, len(w)) as n, w, unnest(range(0, greatest(len(w) - 9, 1))) as s from b where len(w) > 0),
win as (select distinct item_id, n, list_slice(w, s + 1, s + n) as g from bw),
lens as (select distinct n from win),
dp as (select doc_id, w, n, unnest(range(0, len(w) - n + 1)) as s from d, lens where len(w) >= n),
dg as (select doc_id, s, n, list_slice(w, s + 1, s + n) as g from dp),
m as (select doc_id, s, dg.n, item_id from dg join win on dg.g = win.g and dg.n = win.n),
hit as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(s, s + n)) as p from m) group by doc_id),
its as (select doc_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as ids from (select distinct doc_id, item_id from m) group by doc_id)
select d.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit, cast(coalesce(n_items, 0) as bigint) as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join hit using (doc_id) left join its using (doc_id)
"""

OP3_SQL = r"""
with recursive d as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size, md5(coalesce(cast(doc_id as varchar), '')) as h from documents),
src as (select source, sum(size)::double as s, ([5, 2, 1])[1 + (row_number() over (order by source nulls last) - 1) % 3]::double as w from d group by source),
fill as (select 0 as step, source, s, w, 2 * s as cap, false as capped, 0::double as t from src
  union all
  select step + 1, source, s, w, cap, capped or share >= cap, least(cap, share) from (
    select *, case when capped then cap else w * (1.5 * sum(s) over () - coalesce(sum(case when capped then cap end) over (), 0)) / sum(case when not capped then w end) over () end as share from fill where step < (select count(*) from src))),
goal as (select source, s, t, case when s > 0 then cast(round(t / s * 512) as bigint) else 0 end as q from fill where step = (select count(*) from src)),
run as (select d.*, cast(s as bigint) as s, t,
  cast(sum(size) over (partition by d.source order by h, doc_id, size rows unbounded preceding) as bigint) - size as pos
  from d join goal on d.source is not distinct from goal.source),
u0 as (select source, 0 as shard, unnest(range(q)) as draw from goal),
u1 as (select source, draw, shard * 2 + (row_number() over (partition by shard order by md5('7:0:' || draw || coalesce('=' || source, '')), source nulls first, draw)
  > ceil(count(*) over (partition by shard) / 2))::int as shard from u0),
u2 as (select source, draw, shard * 2 + (row_number() over (partition by shard order by md5('7:1:' || draw || coalesce('=' || source, '')), source nulls first, draw)
  > ceil(count(*) over (partition by shard) / 2))::int as shard from u1),
u3 as (select source, draw, shard * 2 + (row_number() over (partition by shard order by md5('7:2:' || draw || coalesce('=' || source, '')), source nulls first, draw)
  > ceil(count(*) over (partition by shard) / 2))::int as shard from u2),
u4 as (select source, draw, shard * 2 + (row_number() over (partition by shard order by md5('7:3:' || draw || coalesce('=' || source, '')), source nulls first, draw)
  > ceil(count(*) over (partition by shard) / 2))::int as shard from u3),
u5 as (select source, draw, shard * 2 + (row_number() over (partition by shard order by md5('7:4:' || draw || coalesce('=' || source, '')), source nulls first, draw)
  > ceil(count(*) over (partition by shard) / 2))::int as shard from u4),
hit as (select run.doc_id, run.h, u5.draw, u5.shard, least(pos + size, (u5.draw % 512 + 1) * s // 512) - greatest(pos, (u5.draw % 512) * s // 512) as words
  from run join u5 on run.source is not distinct from u5.source
    and (u5.draw % 512) between ((pos + 1) * 512 - 1) // s and ((pos + size) * 512 - 1) // s where size > 0),
own as (select doc_id, cast(sum(words) as bigint) as taken, string_agg(draw || ':' || shard || ':' || words, ',' order by draw) as draws,
    arg_min(shard, draw) as shard, arg_min(md5('place' || h || draw), draw) as place from hit where words > 0 group by doc_id)
select run.doc_id, cast(size as bigint) as size, s as source_size, round(t, 6) as target, coalesce(taken, 0) as taken,
  cast(own.shard as int) as shard, own.place, coalesce(draws, '') as draws
from run left join own using (doc_id)
"""


OP1_SQL = r"""
with recursive v as (select vec_id, label, cast(embedding as double[]) as e from embeddings
    where label is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
l as (select a.vec_id as a, b.vec_id as b from v a join v b on a.label = b.label and len(a.e) = len(b.e) and a.vec_id <> b.vec_id
    where list_cosine_similarity(a.e, b.e) >= 0.93),
reach as (select vec_id as a, vec_id as b from embeddings union select r.a, l.b from reach r join l on r.b = l.a)
select e.vec_id, (select count(*) from l where l.a = e.vec_id) as n_links, min(reach.b) as component_id, e.vec_id = min(reach.b) as kept
from embeddings e join reach on reach.a = e.vec_id group by e.vec_id
"""


@query(OP1_SQL)
def op1_embedding_near_dups(spark, table):
    return embedding_dups.near_vectors(table("embeddings"))


@query(OP2_SQL)
def op2_benchmark_decontamination(spark, table):
    return decontaminate.decontaminate(table("documents"), table("benchmark")).drop(*decontaminate.KEY)


@query(OP3_SQL)
def op3_source_mixing(spark, table):
    first = F.get("draws", F.lit(0))
    return mixing.mix(table("documents")).select(
        "doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken", first["shard"].alias("shard"), first["place"].alias("place"),
        F.array_join(F.transform("draws", lambda x: F.concat_ws(":", x["draw"], x["shard"], x["words"])), ",").alias("draws"))


@query()
def op4_quality_classifier(spark, table):
    return quality.score_documents(table("documents"), table("labels"))


@query()
def op5_token_rollups(spark, table):
    return token_counts.maintained_counts(table("documents"), new_work_path(spark, "token-ledger"))


@query()
def op6_virtual_slot_sharding(spark, table):
    return sharding.shard_documents(table("documents"), new_work_path(spark, "slots"))


@query()
def op7_html_main_text(spark, table):
    return html_text.extract_pages(table("pages"))


@query()
def op8_fuzzy_line_dedup(spark, table):
    return fuzzy_lines.dedup_lines(table("documents").select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


OP9_SQL = r"""
with d as (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
w as (select doc_id, i, substr(h, 2 * i + 1, 100) as s from (select doc_id, h, unnest(range(0, len(h) // 2 - 49)) as i from d)),
m as (select s, min(doc_id) as f from w group by s),
hit as (select w.doc_id, w.i from w join m using (s) where m.f < w.doc_id),
j as (select doc_id, i, max(i + 50) over (partition by doc_id order by i rows between unbounded preceding and 1 preceding) as e from hit),
g as (select doc_id, i, sum(case when e is null or i > e then 1 else 0 end) over (partition by doc_id order by i) as k from j),
r as (select doc_id, k, min(i) as a, max(i) + 50 as b from g group by doc_id, k),
kept as (select doc_id, coalesce(lag(b) over w, 0) as a, a as b from r window w as (partition by doc_id order by a) union all select doc_id, max(b), null from r group by doc_id),
t as (select kept.doc_id, string_agg(substr(h, 2 * a + 1, 2 * (coalesce(b, len(h) // 2) - a)), '' order by a) as h from kept join d using (doc_id) group by kept.doc_id),
c as (select doc_id, sum(b - a) as n_removed, count(*) as n_spans from r group by doc_id)
select d.doc_id, cast(len(d.h) // 2 as bigint) as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed, cast(coalesce(n_spans, 0) as bigint) as n_spans,
  sha256(unhex(coalesce(t.h, d.h))) as kept_sha256
from d left join t using (doc_id) left join c using (doc_id)
"""


@query(OP9_SQL)
def op9_column_wise_suffix_dedup(spark, table):
    return suffix_dedup.remove_repeats(table("documents")).drop("kept")


@query()
def op10_simhash_anchor_covering(spark, table):
    return simhash.near_duplicates(table("documents"))


# The checksum is CRC-32, bit by bit.
OP11_SQL = r"""
with t as (select conv_id, coalesce(role, '') as role, coalesce(text, '') as text, row_number() over (partition by conv_id order by turn nulls first) as idx
    from conversations where conv_id is not null),
c as (select conv_id, count(*) as n, conv_id - conv_id % 100 as base, (4294967295 - list_reduce(list_concat([4294967295::bigint],
    list_transform(split(cast(conv_id as varchar), ''), lambda x: ascii(x)::bigint)), lambda a, b: list_reduce(list_concat([xor(a, b)], range(8)),
    lambda x, i: xor(x >> 1, 3988292384::bigint * (x & 1))))) % 6 as h from t group by conv_id),
r as (select c.conv_id, t.idx as depth, role, text from c join t on t.conv_id = c.base and t.idx <= c.h
  union all select c.conv_id, t.idx - c.h + least(c.h, coalesce(b.n, 0)), role, text from c join t using (conv_id) left join c b on b.conv_id = c.base where t.idx > c.h),
p as (select conv_id, depth, string_agg(length(role) || ':' || role || length(text) || ':' || text, '|') over (partition by conv_id order by depth rows unbounded preceding) as k, length(text) as chars from r
  union all select conv_id, 0, '', 0 from c),
e as (select conv_id, max(depth) as n from p group by conv_id),
nodes as (select depth, k, min(conv_id) as conv_id, count(*) as n_convs, (count(*) - 1) * any_value(chars) as saved,
    coalesce(string_agg(case when n = depth then cast(conv_id as varchar) end, ',' order by conv_id), '') as ends from p join e using (conv_id) group by depth, k),
up as (select a.depth, a.k, b.conv_id as parent_conv_id, b.k as pk from nodes a join p q on q.conv_id = a.conv_id and q.depth = a.depth - 1 join nodes b on b.depth = q.depth and b.k = q.k),
ch as (select depth - 1 as depth, pk as k, count(*) as n_children from up group by 1, 2),
w as (select nodes.*, coalesce(n_children, 0) as n_children from nodes left join ch using (depth, k)),
s as (select q.depth, q.k, count_if(w.n_children = 0) as n_leaves, sum(w.saved) as saved_tokens from w join p q on q.conv_id = w.conv_id and q.depth <= w.depth group by 1, 2)
select w.conv_id, w.depth, up.parent_conv_id, w.n_convs, w.n_children, s.n_leaves, cast(s.saved_tokens as bigint) as saved_tokens, sha256(w.ends) as ends_sha256
from w join s using (depth, k) left join up using (depth, k)
"""


@query(OP11_SQL)
def op11_conversation_prefix_trie(spark, table):
    return prefix_trie.prefix_trie(table("conversations"))


OP12_SQL = r"""
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
v as (select doc_id, i, array_to_string(list_slice(w, i + 1, i + 50), ' ') as s from (select doc_id, w, unnest(range(0, len(w) - 49)) as i from d)),
m as (select s, min(doc_id) as f from v group by s),
gone as (select distinct doc_id, unnest(range(i, i + 50)) as p from v join m using (s) where f < doc_id),
x as (select doc_id, unnest(w) as word, generate_subscripts(w, 1) - 1 as p from d),
k as (select doc_id, string_agg(word, ' ' order by p) as t from x anti join gone using (doc_id, p) group by doc_id),
g as (select doc_id, count(*) as n from gone group by doc_id)
select d.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n, 0) as bigint) as n_removed, sha256(coalesce(t, '')) as kept_sha256
from d left join k using (doc_id) left join g using (doc_id)
"""


@query(OP12_SQL)
def op12_relative_lz_substring_dedup(spark, table):
    return substring_dedup.remove_passages(table("documents")).drop("kept")


OP13_SQL = r"""
with v as (select row_number() over () as r, vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * cast(x as double))) as e from embeddings where vec_id is not null and label is not null
    and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select a.r as ar, a.vec_id as anchor_id, v.r, v.vec_id, a.label = v.label as alike, cast(list_inner_product(a.e, v.e) as bigint) as score
    from v a join v on len(a.e) = len(v.e) and a.r <> v.r where a.vec_id % 100 = 0),
p as (select ar, anchor_id, r, vec_id, score from s where alike qualify row_number() over (partition by ar order by score desc, vec_id) <= 5)
select p.anchor_id, p.vec_id as positive_id, cast(row_number() over w as int) as rank, s.vec_id as negative_id, p.score as positive_score, s.score as negative_score
from p join s on s.ar = p.ar and not s.alike and 80 * p.score <= 100 * s.score and s.score <= p.score
window w as (partition by p.ar, p.r order by s.score desc, s.vec_id) qualify row_number() over w <= 5
"""


@query(OP13_SQL)
def op13_four_russians_hard_negatives(spark, table):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(table("embeddings"), label=label)
