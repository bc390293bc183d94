"""The operators as registered queries, with their production parameters, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import chat_format, decontaminate, embedding_dedup, jaccard_join, language_id, line_dedup, token_counts, toxicity, word_bpe
from .common import held_out, table


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_lines(table(spark, sf_dir, "documents")).select("doc_id", "n_dropped", "text")


def op1_page_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over the text of raw pages, by the host of their URL."""
    pages = table(spark, sf_dir, "pages").select("page_id", line_dedup.host_of("url").alias("host"), line_dedup.page_text("html").alias("text"))
    return line_dedup.drop_lines(pages, "host").select("page_id", "host", "n_dropped", "text")


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return language_id.predict(docs.select("doc_id", "text"), language_id.fit(docs)).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_bpe.encode_digest(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    net = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.toxicity(docs, net).select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.embedding_dedup(table(spark, sf_dir, "embeddings"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_bpe.token_files(table(spark, sf_dir, "documents"))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(probe)
    return chat_format.read_chats(chat_format.format_chats(rows))


QUERIES = {f.__name__: f for f in (op1_line_dedup, op1_page_lines, op2_ngram_jaccard, op3_decontaminate, op4_token_counts, op5_language_id, op6_bpe, op7_toxicity, op8_embedding_dedup, op9_token_files, op10_chat_format)}
_PAGES = f"""(select page_id as doc_id, regexp_replace(regexp_replace(regexp_replace(html, '{line_dedup._HIDDEN}', '', 'g'), '{line_dedup._ENDS}', chr(10), 'g'), '{line_dedup._TAG}', '', 'g') as text,
  lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1)) as source from pages)"""
#: Exact joins; the components by walking all links.
_SHINGLES = r"""with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
 s as (select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')] else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) end) as x from w),
 n as (select doc_id, count(*) as n from s group by 1),
 e as (select a.doc_id as a, b.doc_id as b from s a join s b on a.x = b.x and a.doc_id <> b.doc_id join n p on p.doc_id = a.doc_id join n q on q.doc_id = b.doc_id group by a.doc_id, b.doc_id, p.n, q.n having 100 * count(*) >= 75 * (p.n + q.n - count(*))),
 reach as (select doc_id as a, doc_id as b from documents union select r.a, e.b from reach r join e on r.b = e.a)
select d.doc_id, coalesce(n.n, 0) as n_shingles, r.low as component_id from documents d left join n on n.doc_id = d.doc_id join (select a, min(b) as low from reach group by 1) r on r.a = d.doc_id"""
_COSINES = """with recursive v as (select vec_id, cast(embedding as double[]) as x from embeddings where embedding is not null and len(list_filter(embedding, lambda z: z is null or not isfinite(z))) = 0 and len(list_filter(embedding, lambda z: z <> 0)) > 0),
 e as (select a.vec_id as a, b.vec_id as b from v a join v b on a.vec_id <> b.vec_id and len(a.x) = len(b.x) where list_cosine_similarity(a.x, b.x) >= 0.9),
 reach as (select vec_id as a, vec_id as b from embeddings union select r.a, e.b from reach r join e on r.b = e.a)
select m.vec_id, (select count(*) from e where e.a = m.vec_id) as n_links, r.low as component_id, m.vec_id = r.low as kept from embeddings m join (select a, min(b) as low from reach group by 1) r on r.a = m.vec_id"""
#: Each control string in a text or a free role takes one sign more; the rest is the template's.
_CHATS = r"""with c as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]' union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
 f as (select *, len(regexp_extract_all(text, '<s>|</s>|\[/?(?:SYS|INST|OUT|TURN)\]|\[/ROLE\]')) as more, len(regexp_extract_all(role, '<s>|</s>|\[/?(?:SYS|INST|OUT|TURN)\]|\[/ROLE\]')) as roles from c)
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn)) as turns_sha256,
       cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars, sha256(coalesce(string_agg(text, '' order by turn) filter (where role = 'assistant'), '')) as loss_sha256,
       cast(sum(length(text) + more + case role when 'system' then 20 when 'assistant' then 20 when 'user' then 22 else 31 + length(role) + roles end) as bigint) as formatted_chars from f group by conv_id"""
ORACLE_SQL = {
    "op1_line_dedup": line_dedup.ORACLE % ("documents", line_dedup.RATIO),
    "op2_ngram_jaccard": _SHINGLES,
    "op8_embedding_dedup": _COSINES,
    "op10_chat_format": _CHATS,
    "op1_page_lines": f"select q.doc_id as page_id, d.source as host, q.n_dropped, q.text from ({line_dedup.ORACLE.replace("%s", _PAGES, 1).replace("%s", str(line_dedup.RATIO))}) q join {_PAGES} d using (doc_id)",
}
