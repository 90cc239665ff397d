"""Registered queries of the corpus operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import langid, lattice_lm, licenses, merkle, mixing, near_dup, packing, pii, prefix_trie, quality_zip, rules, simhash, vafile
from tidemark.llm.common import held_out, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_va_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return vafile.top_k(rows, F.col("vec_id") % 100 == 0)


OP1_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)) as v
  from embeddings
  where len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score
  from v q join v c on q.vec_id <> c.vec_id and len(q.v) = len(c.v)
  where q.vec_id % 100 = 0
)
select query_id, rank, vec_id, score from (
  select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from s
) where rank <= 10
"""


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mix_documents(table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken")


OP2_SQL = r"""
with d as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size from documents
), s as (
  select source, sum(size)::bigint as source_size from d group by source
), w as (
  select *, (row_number() over (order by source nulls last) - 1) % 3 + 1 as weight from s
), r as (
  select *, (source_size * 3)::double / weight as reach, sum(source_size) over () as total, sum(weight) over () as weights from w
), l as (
  select *, (total::double - coalesce(sum(source_size * 3) over b, 0)) / (weights - coalesce(sum(weight) over b, 0))::double as level
  from r window b as (order by reach, source nulls last rows between unbounded preceding and 1 preceding)
), t as (
  select source, source_size,
    case when reach > level then least(max(case when reach > level then level end) over () * weight, (source_size * 3)::double)
         else (source_size * 3)::double end as target
  from l
), p as (
  select d.*, t.source_size, t.target,
    row_number() over (partition by d.source order by d.size, d.doc_id nulls first) as pos,
    case when t.source_size > 0 then t.target / t.source_size else 0 end as rate,
    ('0x' || substr(md5(coalesce(d.source, '')), 1, 5))::int / 1048576.0::double as u
  from d join t on d.source is not distinct from t.source
)
select doc_id, size, source_size, target,
  ((floor(pos * rate + u) - floor((pos - 1) * rate + u)) * size)::bigint as taken
from p
"""

def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def _joined(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["first"], s["end"])), ",")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = pii.find(docs, pii.train(docs))
    counts = [
        F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
        for kind in pii.KINDS
    ]
    digest = F.sha2(_joined("base_spans").cast("binary"), 256).alias("base_sha256")
    return rows.select("doc_id", *counts, digest, _joined("spans").alias("spans"))


def op5_quality_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = held_out(F.col("doc_id"), 5, 0)
    model = quality_zip.train(docs.where(~out), table(spark, sf_dir, "labels").where(~out))
    rows = quality_zip.predict(docs.select("doc_id", out.alias("held_out"), "text"), model)
    return rows.select("doc_id", "held_out", "score", "predicted")


def op6_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.classes(table(spark, sf_dir, "documents"))


def op7_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = held_out(F.col("doc_id"), 5, 1)
    return lattice_lm.score_documents(docs.select("doc_id", out.alias("held_out"), "text"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("doc_id", *counts, "base_failed", "kept")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = held_out(F.col("doc_id"), 4, 2)
    model = langid.train(docs.where(~out))
    rows = langid.predict(docs.select("doc_id", out.alias("held_out"), "text"), model)
    return rows.select("doc_id", "held_out", "lang_pred", "score")


def op11_simhash_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"), held_out(F.col("doc_id"), 5, 0))


def _crc32_sql(value: str) -> str:
    """Unsigned crc32 of an integer's decimal digits."""
    steps = f"flatten(list_transform(string_split({value}::varchar, ''), lambda x: [ascii(x)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))"
    turn = "case when x >= 0 then xor(c, x) when c & 1 = 1 then xor(c >> 1, 3988292384::bigint) else c >> 1 end"
    return f"xor(list_reduce(list_prepend(4294967295::bigint, {steps}), lambda c, x: {turn}), 4294967295::bigint)"


def _trie_sql() -> str:
    """Rebuilds the conversations and groups their prefixes as lists of turns."""
    return f"""
with t as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
    row_number() over (partition by conv_id order by turn nulls first,
      sha256(strlen(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, ''))) as pos
  from conversations where conv_id is not null
), c as (
  select conv_id, list({{'role': role, 'text': text}} order by pos) as turns, {_crc32_sql('conv_id')} % 6 as h from t group by conv_id
), r as (
  select c.conv_id, list_concat(coalesce(b.turns[:c.h], []), c.turns[c.h + 1:]) as turns
  from c left join c b on b.conv_id = c.conv_id - c.conv_id % 100
), p as (
  select conv_id, d, turns[:d] as prefix, d = len(turns) as ends
  from (select conv_id, turns, unnest(range(0, len(turns) + 1)) as d from r)
), n as (
  select d, prefix, min(conv_id) as conv_id, count(*) as n_convs,
    sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (ends), '')) as ends_sha256
  from p group by d, prefix
), k as (
  select d - 1 as d, prefix[:d - 1] as prefix, count(*) as n_children from n where d > 0 group by all
), w as (
  select n.*, coalesce(n_children, 0) as n_children,
    case when n.d = 0 then 0 else (n_convs - 1) * length(n.prefix[n.d].text) end as saved
  from n left join k on k.d = n.d and k.prefix = n.prefix
), s as (
  select a.d, a.prefix, count(*) filter (u.n_children = 0) as n_leaves, sum(u.saved)::bigint as saved_tokens
  from w u join p x on x.conv_id = u.conv_id and x.d <= u.d join w a on a.d = x.d and a.prefix = x.prefix
  group by a.d, a.prefix
)
select w.conv_id, w.d as depth, parent.conv_id as parent_conv_id, w.n_convs, w.n_children, s.n_leaves, s.saved_tokens, w.ends_sha256
from w join s on s.d = w.d and s.prefix = w.prefix left join n parent on w.d > 0 and parent.d = w.d - 1 and parent.prefix = w.prefix[:w.d - 1]
"""


def _merkle_sql() -> str:
    """A plain tree: nodes level by level, then each document's run at each level."""
    fields = ("doc_id", "source", "lang", "n_chars", "{text}")
    leaf = " || ".join(f"coalesce(strlen({c}::varchar)::varchar || ':' || {c}, '-')" for c in fields)
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

    def tree(name: str, base: str) -> str:
        return f"""{name} as (
  select s, 0 as level, p, node, count(*) over (partition by s) as n from {base}
  union all
  select s, level + 1, p // 16, sha256(string_agg(node, '' order by p)), any_value((n + 15) // 16)
  from {name} where n > 1 group by s, level, p // 16
)"""

    def climb(name: str, start: str, nodes: str) -> str:
        return f"""{name} as (
  select doc, s, 0 as level, p, fold, proof from {start}
  union all
  select c.doc, c.s, c.level + 1, c.p // 16,
    sha256(string_agg(case when x.p = c.p then c.fold else x.node end, '' order by x.p)),
    any_value(c.proof) || string_agg(case when x.p = c.p then '' else x.node end, '' order by x.p)
  from {name} c join {nodes} x on x.s = c.s and x.level = c.level and x.p // 16 = c.p // 16
  where x.n > 1 group by c.doc, c.s, c.level, c.p
)"""

    return f"""
with recursive d as (
  select row_number() over () as doc, doc_id, source, sha256({leaf.format(text='text')}) as leaf,
    case when {_crc32_sql('doc_id')} % 5 = 0 then sha256({leaf.format(text=lower)}) end as altered
  from documents
), sources as (
  select source, row_number() over (order by source is not null, source) - 1 as s from (select distinct source from d)
), base as (
  select doc, s, leaf as node, altered, row_number() over (partition by s order by doc_id nulls first, leaf) - 1 as p
  from d join sources on d.source is not distinct from sources.source
), {tree('nodes', 'base')}, subroots as (
  select s as p, 0 as s, node from nodes where n = 1
), {tree('above', 'subroots')}, start as (
  select doc, s, p, coalesce(altered, node) as fold, '' as proof from base
), {climb('inside', 'start', 'nodes')}, half as (
  select doc, 0 as s, s as p, fold, proof from inside qualify row_number() over (partition by doc order by level desc) = 1
), {climb('outside', 'half', 'above')}, done as (
  select * from outside qualify row_number() over (partition by doc order by level desc) = 1
)
select d.doc_id, d.leaf, r.node as subroot, t.node as root, sha256(done.proof) as proof_sha256,
  done.fold as folded_root, done.fold = t.node as verified
from d join done using (doc) join base using (doc) join subroots r on r.p = base.s cross join (select node from above where n = 1) t
"""


QUERIES: dict[str, Query] = {
    "op1_va_file": op1_va_file,
    "op2_mixing": op2_mixing,
    "op3_license_scan": op3_license_scan,
    "op4_pii": op4_pii,
    "op5_quality_zip": op5_quality_zip,
    "op6_near_dup": op6_near_dup,
    "op7_lattice_lm": op7_lattice_lm,
    "op8_packing": op8_packing,
    "op9_quality_rules": op9_quality_rules,
    "op10_language_id": op10_language_id,
    "op11_simhash_tiles": op11_simhash_tiles,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_merkle": op13_merkle,
}

ORACLES: dict[str, str] = {
    "op1_va_file": OP1_SQL,
    "op2_mixing": OP2_SQL,
    "op12_prefix_trie": _trie_sql(),
    "op13_merkle": _merkle_sql(),
}
