"""Queries over the documents, embeddings and conversations, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estatelake.llm import (
    backoff,
    cutting_stock,
    line_alignment,
    mixing,
    one_permutation,
    prefix_trie,
    snapshots,
    spelling,
    subspace_join,
    suffix_dedup,
    url_filter,
    weak_labels,
    weighted_sampling,
)
from estatelake.llm.url_filter import ALPHABET, BINS, CALIBRATION_OF, MILLION, ORDER, Rule
from estatelake.staging import stage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(build):
    QUERIES[build.__name__] = build
    return build


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """A public tokenizer's file, as installed beside the Python packages."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).drop("source")


@_query
def op2_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backoff.score(_table(spark, sf_dir, "documents"))


@_query
def op3_line_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_alignment.remove_shared_lines(_table(spark, sf_dir, "documents")).drop("kept_text")


@_query
def op4_subspace_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subspace_join.linked_vectors(_table(spark, sf_dir, "embeddings"))


ORACLE["op4_subspace_join"] = """
with recursive vectors as (
  select vec_id, [cast(x as double) for x in embedding] as v from embeddings
  where embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as (
  select a.vec_id as a, b.vec_id as b from vectors a join vectors b
  on a.vec_id <> b.vec_id and len(a.v) = len(b.v)
  where list_cosine_similarity(a.v, b.v) >= 0.9),
reached as (
  select vec_id as a, vec_id as b from embeddings
  union
  select r.a, l.b from reached r join links l on r.b = l.a),
components as (select a as vec_id, min(b) as component_id from reached group by a),
degrees as (select a as vec_id, count(*) as n_links from links group by a)
select c.vec_id, coalesce(d.n_links, 0) as n_links, c.component_id, c.vec_id = c.component_id as kept
from components c left join degrees d on c.vec_id = d.vec_id
"""


@_query
def op5_weak_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_labels.classify(_table(spark, sf_dir, "documents"))


@_query
def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"))
    return found.drop("removed")


@_query
def op7_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = snapshots.collapse(_table(spark, sf_dir, "conversations"))
    return found.withColumn("rendered_sha256", F.sha2(F.encode("rendered", "utf-8"), 256)).drop("rendered")


ORACLE["op7_snapshots"] = """
with turns as (select distinct conv_id, turn, role, text from conversations),
ordered as (
  select conv_id, row_number() over (partition by conv_id order by turn nulls first, role nulls first, text nulls first) as place,
         concat(coalesce(length(role), -1), ':', coalesce(role, ''), coalesce(length(text), -1), ':', coalesce(text, '')) as content,
         concat('<|', coalesce(role, 'unknown'), '|>', chr(10), coalesce(text, ''), chr(10), '<|end|>', chr(10)) as rendered
  from turns),
prefixes as (
  select a.conv_id, a.place, string_agg(b.content, '' order by b.place) as prefix, string_agg(b.rendered, '' order by b.place) as rendered
  from ordered a join ordered b on a.conv_id = b.conv_id and b.place <= a.place
  group by a.conv_id, a.place),
sizes as (select conv_id, max(place) as n_turns from ordered group by conv_id),
whole as (select p.conv_id, s.n_turns, p.prefix, p.rendered from prefixes p join sizes s on p.conv_id = s.conv_id and p.place = s.n_turns),
inner_ones as (select distinct p.prefix from prefixes p join sizes s on p.conv_id = s.conv_id where p.place < s.n_turns),
firsts as (select prefix, min(conv_id) as first_id from whole group by prefix),
judged as (
  select w.conv_id, w.n_turns, w.rendered, f.first_id = w.conv_id and i.prefix is null as kept
  from whole w join firsts f on w.prefix = f.prefix left join inner_ones i on w.prefix = i.prefix)
select conv_id, n_turns, kept, case when kept then length(rendered) end as n_chars,
       case when kept then sha256(rendered) end as rendered_sha256
from judged
"""


@_query
def op8_cutting_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cutting_stock.pack(_table(spark, sf_dir, "documents"), vocabulary())


@_query
def op9_weighted_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted_sampling.fingerprints(_table(spark, sf_dir, "documents"))


@_query
def op10_one_permutation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one_permutation.near_duplicates(_table(spark, sf_dir, "documents")).drop("keeper")


ORACLE["op10_one_permutation"] = r"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents),
numbered as (select doc_id, w, unnest(range(1, greatest(len(w) - 2, least(len(w), 1)) + 1)) as i from words),
shingles as (select distinct doc_id, array_to_string(w[i:least(i + 2, len(w))], ' ') as s from numbered),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
shared as (
  select a.doc_id as a, b.doc_id as b, count(*) as n_shared from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id
  group by a.doc_id, b.doc_id),
links as (
  select a, b from shared join sizes x on x.doc_id = a join sizes y on y.doc_id = b
  where 100 * n_shared >= 85 * (x.n + y.n - n_shared)),
reached as (
  select doc_id as a, doc_id as b from documents
  union
  select r.a, l.b from reached r join links l on r.b = l.a),
components as (select a as doc_id, min(b) as component_id from reached group by a)
select c.doc_id, coalesce(s.n, 0) as n_shingles, c.component_id, c.doc_id = c.component_id as kept
from components c left join sizes s on c.doc_id = s.doc_id
"""


# crc32 of the UTF-8 bytes of a text, from the table of the reflected polynomial.
CRC_SQL = """
crc_bits(i, k, v) as (
  select i, 0, i from range(256) t(i)
  union all
  select i, k + 1, case when v & 1 = 1 then xor(v >> 1, 3988292384) else v >> 1 end from crc_bits where k < 8),
crc_table as (select list(v order by i) as crcs from crc_bits where k = 8)"""


def _crc_sql(text: str) -> str:
    """An expression; ``crcs`` is in reach."""
    codes = f"list_transform(range(1, octet_length(encode({text})) + 1), lambda i: cast('0x' || substring(hex(encode({text})), cast(2 * i - 1 as int), 2) as bigint))"
    step = "xor(c >> 8, crcs[cast((xor(c, b) & 255) + 1 as int)])"
    return f"xor(list_reduce(list_prepend(4294967295, {codes}), lambda c, b: {step}), 4294967295)"


LEAST_WORD, LEAST_COUNT, DELETE_EVERY = 7, 2, 31


@_query
def op11_asymmetric_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.counted_runs(_table(spark, sf_dir, "documents"), LEAST_WORD, LEAST_COUNT, DELETE_EVERY))


ORACLE["op11_asymmetric_chunks"] = rf"""
with recursive {CRC_SQL.strip()},
runs as (
  select doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run
  from documents),
distinct_runs as (select doc_id, run, count(*) as times from runs where length(run) >= {LEAST_WORD} group by doc_id, run),
hashed as (select run, times, {_crc_sql("concat(doc_id, ':', run)")} as h from distinct_runs, crc_table),
changed as (
  select case when h % {DELETE_EVERY} = 0 then substring(run, 1, cast(h % length(run) as int)) || substring(run, cast(h % length(run) as int) + 2) else run end as word, times
  from hashed),
words as (select word, cast(sum(times) as bigint) as n from changed where length(word) >= {LEAST_WORD} group by word having sum(times) >= {LEAST_COUNT}),
cut as (select word, n, i, substring(word, 1, cast(i as int)) || substring(word, cast(i as int) + 2) as rest from (select word, n, unnest(range(0, length(word))) as i from words) w),
near as (
  select a.word, b.word as near, b.n as near_n from cut a join cut b on a.i = b.i and a.rest = b.rest and a.word <> b.word and length(a.word) = length(b.word)
  union select a.word, b.word, b.n from cut a join words b on a.rest = b.word
  union select b.word, a.word, a.n from cut a join words b on a.rest = b.word),
best as (select word, count(*) as n_near, arg_max(near, (near_n, -place)) as near, max(near_n) as near_n
         from (select *, row_number() over (order by near) as place from near) p group by word),
forms as (
  select w.word, w.n, coalesce(b.n_near, 0) as n_near, case when b.near_n >= 10 * w.n then b.near end as form, case when b.near_n >= 10 * w.n then b.near_n end as form_n
  from words w left join best b on w.word = b.word),
chains as (
  select word, word as at from forms
  union
  select c.word, f.form from chains c join forms f on c.at = f.word where f.form is not null)
select f.word, f.form, c.at as root, f.n, f.n_near, f.form_n
from forms f join chains c on f.word = c.word join forms e on c.at = e.word and e.form is null
"""


FAMILY, PREFIXES = 20, 4


def rebuilt_turns(numbered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rebuilt turns (conv_id, depth, content, words), and all conversations.

    A conversation's first h turns are those of the first one of its family of ``FAMILY`` ids.
    """
    longest = PREFIXES - 1
    turn = F.struct("depth", "content", "words")
    heads = numbered.where(F.col("depth") <= longest).groupBy(F.col("conv_id").alias("base")).agg(F.array_sort(F.collect_list(turn)).alias("head"))
    ids = numbered.where("depth = 1").select(
        "conv_id", (F.crc32(F.encode(F.col("conv_id").cast("string"), "utf-8")) % PREFIXES).cast("int").alias("h"),
        (F.col("conv_id") - F.pmod("conv_id", F.lit(FAMILY))).alias("base"),
    )
    head = F.slice(F.coalesce("head", F.array().cast("array<struct<depth:bigint,content:string,words:bigint>>")), F.lit(1), F.col("h"))
    known = stage(ids.join(heads, "base", "left").select("conv_id", "h", head.alias("head")), "rebuilt-heads")
    borrowed = known.select("conv_id", F.inline("head"))
    own = numbered.join(known.select("conv_id", "h", F.size("head").alias("n")), "conv_id").where("depth > h")
    own = own.select("conv_id", (F.col("depth") - F.col("h") + F.col("n")).alias("depth"), "content", "words")
    return stage(borrowed.union(own), "rebuilt-turns"), known.select("conv_id")


@_query
def op12_euler_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns, conversations = rebuilt_turns(prefix_trie.numbered_turns(_table(spark, sf_dir, "conversations")))
    return prefix_trie.prefix_trie(turns, conversations).drop("enter", "exit")


ORACLE["op12_euler_trie"] = rf"""
with recursive {CRC_SQL.strip()},
ordered as (
  select conv_id, row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), md5(concat(length(coalesce(role, '')), ':', role, text))) as place,
         concat(length(coalesce(role, '')), ':', role, length(coalesce(text, '')), ':', text) as content,
         length(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as words
  from conversations where conv_id is not null),
sizes as (select conv_id, max(place) as n from ordered group by conv_id),
ids as (select conv_id, ((conv_id % {FAMILY}) + {FAMILY}) % {FAMILY} as off, {_crc_sql("cast(conv_id as varchar)")} % {PREFIXES} as h from sizes, crc_table),
heads as (select i.conv_id, i.conv_id - i.off as base, i.h, least(i.h, coalesce(s.n, 0)) as n from ids i left join sizes s on s.conv_id = i.conv_id - i.off),
rebuilt as (
  select h.conv_id, o.place as depth, o.content, o.words from heads h join ordered o on o.conv_id = h.base and o.place <= h.h
  union all
  select o.conv_id, o.place - h.h + h.n, o.content, o.words from ordered o join heads h on o.conv_id = h.conv_id where o.place > h.h),
prefixes as (
  select a.conv_id, a.depth, a.words, string_agg(b.content, '' order by b.depth) as prefix
  from rebuilt a join rebuilt b on a.conv_id = b.conv_id and b.depth <= a.depth group by a.conv_id, a.depth, a.words
  union all select conv_id, 0, 0, '' from ids),
lasts as (select conv_id, max(depth) as depth from prefixes group by conv_id),
nodes as (select depth, prefix, min(conv_id) as conv_id, count(*) as n_convs, max(words) as words from prefixes group by depth, prefix),
above as (
  select n.*, p.prefix as parent, m.conv_id as parent_conv_id
  from nodes n left join prefixes p on p.conv_id = n.conv_id and p.depth = n.depth - 1 left join nodes m on m.depth = p.depth and m.prefix = p.prefix),
children as (select depth - 1 as depth, parent as prefix, count(*) as n from above where depth > 0 group by all),
sums as (
  select v.depth, v.prefix, count(*) filter (where c.n is null) as n_leaves, sum((e.n_convs - 1) * e.words) as saved_tokens
  from nodes v join prefixes p on p.depth = v.depth and p.prefix = v.prefix join nodes e on e.conv_id = p.conv_id and e.depth >= v.depth
  left join children c on c.depth = e.depth and c.prefix = e.prefix
  group by v.depth, v.prefix),
ends as (
  select p.depth, p.prefix, string_agg(cast(p.conv_id as varchar), ',' order by p.conv_id) as ids
  from prefixes p join lasts l on p.conv_id = l.conv_id and p.depth = l.depth group by p.depth, p.prefix)
select a.conv_id, a.depth, a.parent_conv_id, a.n_convs, coalesce(c.n, 0) as n_children, s.n_leaves, cast(s.saved_tokens as bigint) as saved_tokens,
       sha256(coalesce(e.ids, '')) as ends_sha256
from above a join sums s on a.depth = s.depth and a.prefix = s.prefix
left join children c on a.depth = c.depth and a.prefix = c.prefix left join ends e on a.depth = e.depth and a.prefix = e.prefix
"""


RULES = [
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
]


@_query
def op13_url_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge(_table(spark, sf_dir, "pages"), RULES)
    return judged.withColumn("score", F.round("score", 6))


def _fitting_sql(value: Callable[[Rule], str]) -> str:
    longest_first = sorted(RULES, key=lambda r: -len(r.host + r.path))
    return "case " + " ".join(
        f"when (host = '{r.host}' or host like '%.{r.host}') and starts_with(path, '{r.path}') then '{value(r)}'" for r in longest_first
    ) + " end"


def _probability_sql(side: str) -> str:
    text = f"1.0::double / {ALPHABET}"
    for k in range(1, ORDER + 2):
        text = f"(case when {side}_all[{k}] > 0 then ({side}[{k}] + {side}_kinds[{k}] * {text}) / ({side}_all[{k}] + {side}_kinds[{k}]) else {text} end)"
    return text


ORACLE["op13_url_ratio"] = rf"""
with rests as (select page_id, regexp_extract(coalesce(url, ''), '(?s)\A.*?://(.*)\z', 1) as rest from pages),
split as (
  select page_id, translate(regexp_extract(rest, '(?s)\A([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(rest, '(?s)\A[^/?#]*([^?#]*)', 1) as path
  from rests),
fitted as (select distinct host, path, concat(host, path) as text, {_fitting_sql(lambda r: r.host + r.path)} as rule, {_fitting_sql(lambda r: r.verdict)} as ruled from split),
texts as (
  select *, ruled is not null and cast('0x' || substring(md5(text), 1, 8) as bigint) % {CALIBRATION_OF} = 0 as calibrates from fitted),
places as (
  select host, path, case when not calibrates then ruled end as side,
         substring(repeat(chr(2), {ORDER}) || text || chr(3), cast(unnest(range(1, length(text) + 2)) as int), {ORDER + 1}) as string
  from texts),
counted as (
  select string, count(*) filter (where side = 'allow') as allow, count(*) filter (where side = 'block') as block from places group by string),
ends as (select string, allow, block, unnest(range(1, {ORDER + 2})) as size from counted),
grams as (select string, size, substring(string, cast({ORDER + 2} - size as int), cast(size as int)) as gram, allow, block from ends),
by_gram as (select gram, sum(allow) as allow, sum(block) as block from grams group by gram),
by_context as (
  select substring(gram, 1, length(gram) - 1) as context, sum(allow) as allow_all, sum(block) as block_all,
         count(*) filter (where allow > 0) as allow_kinds, count(*) filter (where block > 0) as block_kinds
  from by_gram group by 1),
listed as (
  select g.string, {", ".join(f"list({t}.{s}{kind}::double order by g.size) as {s}{kind}" for s in ("allow", "block") for t, kind in (("m", ""), ("c", "_all"), ("c", "_kinds")))}
  from grams g join by_gram m on g.gram = m.gram join by_context c on substring(m.gram, 1, length(m.gram) - 1) = c.context
  group by g.string),
valued as (select string, round((ln({_probability_sql("allow")}) - ln({_probability_sql("block")})) * {MILLION}) as value from listed),
scores as (select host, path, sum(value) / (count(*) * {MILLION}) as score from places join valued using (string) group by host, path),
scored as (select * from texts join scores using (host, path)),
bins as (
  select floor(score * {BINS}) as bin, count(*) filter (where ruled = 'allow') as allow, count(*) filter (where ruled = 'block') as block
  from scored where calibrates group by 1),
edges as (
  select (bin + coalesce(lag(bin) over (order by bin) + 1, bin)) / (2 * {BINS}) as edge,
         sum(allow) over (order by bin rows between current row and unbounded following) * sum(block) over ()
         + coalesce(sum(block) over (order by bin rows between unbounded preceding and 1 preceding), 0) * sum(allow) over () as good
  from bins),
best as (select coalesce((select edge from edges where good > 0 order by good desc, abs(edge), edge limit 1), 0) as edge)
select page_id, host, path, rule, coalesce(ruled, case when score >= edge then 'allow' else 'block' end) as verdict, round(score, 6) as score
from split join scored using (host, path) cross join best
"""
