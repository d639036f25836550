"""One registered query per operator, over its whole table, with production
parameters; and the SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op2_jump_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sharding import shard_documents

    return shard_documents(_read(spark, sf_dir, "documents"))


def op1_column_generation_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack, public_definition

    return pack(_read(spark, sf_dir, "documents"), public_definition())


def op3_nn_descent_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ann import nearest

    return nearest(_read(spark, sf_dir, "embeddings"))


def op4_ftrl_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import classify

    return classify(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op5_minhash_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontamination import contained_items

    return contained_items(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op6_anchor_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .substring_dedup import remove_repeats

    out = remove_repeats(_read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op7_cuckoo_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .line_dedup import dedup_lines

    out = dedup_lines(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op8_link_graph_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .url_filter import Rule, judge

    rules = [
        Rule("allow", "com"), Rule("block", "example.com", "/en/"), Rule("allow", "www.example.com", "/en/"),
        Rule("block", "net", "/es/"), Rule("block", "net", "/fr/"),
    ]
    return judge(_read(spark, sf_dir, "pages"), rules)


def op9_rare_first_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ngram_join import join_documents

    return join_documents(_read(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_tree_model_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .html_extract import main_text

    return main_text(_read(spark, sf_dir, "pages"))


def op11_reduced_alphabet_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .spelling import thinned, variants

    return variants(_read(spark, sf_dir, "documents"), change=thinned)


def op12_b_bit_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .near_dedup import near_duplicates

    return near_duplicates(_read(spark, sf_dir, "documents"))


def op13_dense_blocked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lexical_search import search

    return search(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_column_generation_packing": op1_column_generation_packing,
    "op2_jump_sharding": op2_jump_sharding,
    "op3_nn_descent_search": op3_nn_descent_search,
    "op4_ftrl_toxicity": op4_ftrl_toxicity,
    "op5_minhash_containment": op5_minhash_containment,
    "op6_anchor_substring_dedup": op6_anchor_substring_dedup,
    "op7_cuckoo_line_dedup": op7_cuckoo_line_dedup,
    "op8_link_graph_url_filter": op8_link_graph_url_filter,
    "op9_rare_first_jaccard_join": op9_rare_first_jaccard_join,
    "op10_tree_model_html": op10_tree_model_html,
    "op11_reduced_alphabet_spelling": op11_reduced_alphabet_spelling,
    "op12_b_bit_minhash": op12_b_bit_minhash,
    "op13_dense_blocked_search": op13_dense_blocked_search,
    "pipeline": pipeline,
}

#: Distinct five-word shingles of {table}'s texts, words as runs of letters and digits.
_SHINGLES = r"""
  select {id}, n, array_to_string(w[i:i + 4], ' ') as shingle
  from (select {id}, row_number() over () as n, regexp_extract_all(lower(coalesce(text, '')), '[\p{{L}}\p{{N}}]+') as w
        from (select distinct {id}, text from {table})) t, unnest(range(1, len(w) - 3)) as u(i)
  group by all"""

ORACLES: dict[str, str] = {
    "op5_minhash_containment": f"""
with d as ({_SHINGLES.format(table="documents", id="doc_id")}),
b as ({_SHINGLES.format(table="benchmark", id="item_id")}),
size as (select n, count(*) as m from b group by n)
select d.doc_id, b.item_id, max(m)::bigint as n_shingles, count(*)::bigint as n_common, count(*)::double / max(m) as containment
from b join size using (n) join d using (shingle)
group by d.doc_id, d.n, b.item_id, b.n
having count(*) >= ceil(max(m) * 0.8 - 1e-9)""",
    "op6_anchor_substring_dedup": r"""
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
win as (select doc_id, s, md5(array_to_string(w[s:s + 19], ' ')) as key from d, unnest(range(1, len(w) - 18)) as u(s)),
later as (select doc_id, s from (select *, row_number() over (partition by key order by doc_id, s) as n from win) where n > 1),
gone as (select distinct doc_id, p from later, unnest(range(s, s + 20)) as u(p)),
words as (select doc_id, p, w[p] as word from d, unnest(range(1, len(w) + 1)) as u(p)),
kept as (select doc_id, string_agg(word, ' ' order by p) as text from words anti join gone using (doc_id, p) group by doc_id),
lost as (select doc_id, count(*) as n from gone group by doc_id)
select d.doc_id, len(w)::bigint as n_words, coalesce(lost.n, 0)::bigint as n_removed, sha256(coalesce(kept.text, '')) as kept_sha256
from d left join kept using (doc_id) left join lost using (doc_id)""",
    "op7_cuckoo_line_dedup": f"""
with l as (select doc_id, i, lines[i] as line from (select doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents) t,
             unnest(range(1, len(lines) + 1)) as u(i)),
k as (select *, translate(trim(line, {" || ".join(f"chr({c})" for c in (32, 9, 10, 11, 12, 13))}),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from l),
r as (select key, min(doc_id) as keeper from k where length(key) >= 10 group by key having count(distinct doc_id) > 1),
j as (select k.*, coalesce(keeper <> doc_id, false) as dropped from k left join r using (key))
select doc_id, count(*)::bigint as n_lines, count(*) filter (dropped)::bigint as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by i) filter (not dropped), '')) as kept_sha256
from j group by doc_id""",
    "op11_reduced_alphabet_spelling": r"""
with recursive
crc(i, c, k) as (  -- the table of the checksum's 256 byte values
  select i, i, 0 from range(256) t(i)
  union all select i, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, k + 1 from crc where k < 8),
lookup as (select list(c order by i) as t from crc where k = 8),
runs as (
  select doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run, count(*) as n
  from (select doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{00C0}-\x{00FF}]+')) as run from documents) group by all),
bytes as (
  select doc_id, run, n, flatten(list_transform(string_split(coalesce(doc_id::varchar, '') || ':' || run, ''),
    lambda ch: case when unicode(ch) < 128 then [unicode(ch)::bigint] else [192 + (unicode(ch) >> 6)::bigint, 128 + (unicode(ch) & 63)::bigint] end)) as b
  from runs where length(run) >= 7),
hashed as (
  select run, n, xor(4294967295, list_reduce(b, lambda h, x: xor(h >> 8, t[(xor(h, x) & 255) + 1]), 4294967295::bigint)) as h
  from bytes, lookup),
words as (
  select case when h % 31 = 0 then left(run, (h % length(run))::int) || substr(run, (h % length(run))::int + 2) else run end as word, sum(n)::bigint as n
  from hashed group by word having length(word) >= 7 and sum(n) >= 2),
cut as (select word, n, length(word) as len, i, left(word, i::int) || substr(word, i::int + 2) as rest from words, unnest(range(length(word))) as u(i)),
near as (
  select a.word, b.word as other, b.n as other_n from cut a join cut b on a.rest = b.rest and a.i = b.i and a.len = b.len and a.word <> b.word
  union select a.word, b.word, b.n from cut a join words b on a.rest = b.word
  union select b.word, a.word, a.n from cut a join words b on a.rest = b.word),
best as (select word, count(*) as n_near, first(other order by other_n desc, other) as other, max(other_n) as other_n from near group by word),
formed as (
  select words.word, words.n, coalesce(n_near, 0)::bigint as n_near, case when other_n >= 10 * n then other end as form, case when other_n >= 10 * n then other_n end as form_n
  from words left join best using (word)),
way(word, reached, steps) as (
  select word, word, 0 from formed
  union all select way.word, form, steps + 1 from way join formed on reached = formed.word where form is not null)
select formed.word, form, root, n, n_near, form_n
from formed join (select word, last(reached order by steps) as root from way group by word) using (word)""",
    "op12_b_bit_minhash": r"""
with recursive
d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
s as (
  select distinct doc_id, md5(array_to_string(w[i:i + 4], ' ')) as shingle
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) as i from d where len(w) > 0)),
size as (select doc_id, count(*) as n from s group by doc_id),
links as (
  select a.doc_id as x, b.doc_id as y from s a join s b using (shingle) join size p on p.doc_id = a.doc_id join size q on q.doc_id = b.doc_id
  group by a.doc_id, b.doc_id having 100 * count(*) >= 85 * (max(p.n) + max(q.n) - count(*))),
reach(x, y) as (select x, y from links union select reach.x, links.y from reach join links on reach.y = links.x),
least as (select x as doc_id, min(y) as component_id from reach group by x)
select d.doc_id, coalesce(n, 0)::bigint as n_shingles, coalesce(component_id, d.doc_id) as component_id, coalesce(component_id, d.doc_id) = d.doc_id as kept
from d left join size using (doc_id) left join least using (doc_id)""",
    "op13_dense_blocked_search": r"""
with terms as (
  select kind, id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from (select 'doc' as kind, doc_id as id, text from documents union all select 'item', item_id, text from benchmark)),
tf as (select id as doc_id, term, count(*)::bigint as tf from terms where kind = 'doc' group by all),
docs as (select doc_id, sum(tf)::bigint as n from tf group by doc_id),
all_docs as (select count(*)::bigint as N_docs, sum(n)::bigint as L from docs),
items as (select distinct id as item_id, term from terms where kind = 'item'),
weight as (select term, floor(1000 * ln((2 * max(N_docs) + 2) / (2 * count(*) + 1)))::bigint as w from tf, all_docs group by term),
scored as (
  select item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * N_docs) // L))))::bigint as score
  from items join tf using (term) join weight using (term) join docs using (doc_id), all_docs
  group by item_id, doc_id)
select item_id, row_number() over (partition by item_id order by score desc, doc_id)::int as rank, doc_id, score
from scored where score > 0
qualify rank <= 10""",
}
