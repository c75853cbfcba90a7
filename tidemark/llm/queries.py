"""The thin queries over whole tables, one for each text operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.chat import format_conversations, masked_text, read_turns, threads
from tidemark.llm.decontaminate import find_overlap, word_total
from tidemark.llm.html_text import extract_text
from tidemark.llm.importance import resample
from tidemark.llm.lexical import search
from tidemark.llm.licenses import scan_licenses
from tidemark.llm.neighbours import nearest
from tidemark.llm.packing import pack
from tidemark.llm.quality_model import score_quality
from tidemark.llm.quality_model import train as train_quality
from tidemark.llm.quality_rules import quality_report
from tidemark.llm.simhash import near_duplicates
from tidemark.llm.token_files import read_checks, token_files
from tidemark.llm.toxicity import score_toxicity, train, training_fold


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_signature_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrases and license labels of every document."""
    found = scan_licenses(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score",
    )


def op2_crf_marginals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by a chain trained on the labelled fold."""
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"))
    return score_toxicity(docs, model).select(
        "doc_id",
        (~training_fold()).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
        "spans",
    )


def op3_host_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = extract_text(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"), "n_covered", "n_cut")


def op4_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality counts and the compression-band verdict of every document."""
    return quality_report(table(spark, sf_dir, "documents"))


def op5_aho_corasick(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows of ten words found in every document."""
    found = find_overlap(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    ids = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select(
        "doc_id",
        "n_words",
        word_total("spans").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def op6_fourier_ridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by a kernel ridge fit on the labelled fold."""
    docs, fold = table(spark, sf_dir, "documents"), training_fold(folds=3, held=1)
    model = train_quality(docs, table(spark, sf_dir, "labels"), fold)
    return score_quality(docs, model).select("doc_id", (~fold).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations in the template, and what is read back from it."""
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("\\### Assistant: </turn> ok").alias("text"),
    )
    made = format_conversations(threads(given.unionByName(own)))
    read = made.select("conv_id", "formatted", read_turns().alias("turns"), masked_text().alias("masked"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.char_length("masked").cast("long").alias("loss_chars"),
        F.sha2("masked", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def op8_deficit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1024 ids, one row a piece."""
    return pack(table(spark, sf_dir, "documents"), with_ids=False)


def op9_bit_sliced_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints of every document and their components."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op10_fixed_size_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents, written to Arrow files and read back."""
    _, index = token_files(table(spark, sf_dir, "documents"))
    return read_checks(index)


def op11_payload_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's weight towards the benchmark, and the tenth that is drawn by it."""
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select("doc_id", "n_features", "weight", "score", "rank")


def op12_collision_counting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every fiftieth one."""
    return nearest(table(spark, sf_dir, "embeddings"))


def op13_bag_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fifty best documents of every benchmark item."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_signature_rules": op1_signature_rules,
    "op2_crf_marginals": op2_crf_marginals,
    "op3_host_suffix_array": op3_host_suffix_array,
    "op4_compression_bands": op4_compression_bands,
    "op5_aho_corasick": op5_aho_corasick,
    "op6_fourier_ridge": op6_fourier_ridge,
    "op7_reply_trees": op7_reply_trees,
    "op8_deficit_packing": op8_deficit_packing,
    "op9_bit_sliced_simhash": op9_bit_sliced_simhash,
    "op10_fixed_size_lists": op10_fixed_size_lists,
    "op11_payload_automaton": op11_payload_automaton,
    "op12_collision_counting": op12_collision_counting,
    "op13_bag_classes": op13_bag_classes,
}

WORDS_SQL = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

#: SQL for the contracts that it can express.
ORACLES: dict[str, str] = {
    "op5_aho_corasick": f"""
with b as (select item_id, {WORDS_SQL} as w from benchmark),
wins as (select distinct item_id, least(10, len(w)) as n, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') as k
  from b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as t(i) where len(w) > 0),
d as (select row_number() over () as rid, doc_id, {WORDS_SQL} as w from documents),
places as (select rid, i, n, array_to_string(w[i : i + n - 1], ' ') as k
  from d, (select distinct n from wins) s, unnest(range(1, len(w) - n + 2)) as t(i)),
hits as (select rid, i, n, item_id from places join wins using (n, k)),
words as (select rid, count(distinct p) as n_hit from (select rid, unnest(range(i, i + n)) as p from hits) group by rid),
items as (select rid, count(distinct item_id) as n_items, sha256(string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar))) as h from hits group by rid)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, coalesce(h, sha256('')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join words using (rid) left join items using (rid)
""",
    "op7_reply_trees": r"""
with c as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e as (
  select *, replace(replace(replace(replace(text, '\', '\b'), '</turn>', '\e'), '### ', '\h'), ': ', '\c') as body,
    replace(replace(replace(replace(role, '\', '\b'), '</turn>', '\e'), '### ', '\h'), ': ', '\c') as head
  from c)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  coalesce(sum(case when role = 'assistant' then length(text) end), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
  sum(length(head) + length(body) + 14)::bigint as formatted_chars
from e group by conv_id
""",
    "op11_payload_automaton": f"""
with t as (select list_transform(range(256), lambda i: list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, x: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as t),
d as (select row_number() over () as rid, doc_id, {WORDS_SQL} as w from documents),
dw as (select rid, unnest(w) as word from d), bw as (select unnest({WORDS_SQL}) as word from benchmark),
h as (select word, hex(encode(word)) as x from (select word from dw union select word from bw)),
u as (select word, list_transform(range(length(x) // 2), lambda i: (instr('0123456789ABCDEF', x[2 * i + 1]) - 1) * 16 + instr('0123456789ABCDEF', x[2 * i + 2]) - 1) as b from h),
c as (select word, xor(list_reduce(list_prepend(4294967295::bigint, b), lambda c, y: xor(c >> 8, t[(xor(c, y) & 255) + 1])), 4294967295) % 10000 as bucket from u, t),
s as (select bucket, count(*) as s from dw join c using (word) group by 1), q as (select bucket, count(*) as t from bw join c using (word) group by 1),
g as (select bucket, floor(1000 * ln((coalesce(t, 0) + 1)::double * ((select count(*) from dw) + 10000)::double / ((s + 1)::double * ((select count(*) from bw) + 10000)::double)))::bigint as gain from s left join q using (bucket)),
w as (select rid, sum(gain)::bigint as weight from dw join c using (word) join g using (bucket) group by 1),
r as (select doc_id, len(w)::bigint as n_features, coalesce(weight, 0) as weight, ('0x' || left(sha256('2024:' || coalesce(doc_id::varchar, '')), 8))::bigint as h from d left join w using (rid)),
z as (select doc_id, n_features, weight, weight + floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296::double)))::bigint as score from r),
k as (select *, row_number() over (partition by n_features >= 20 order by score desc, doc_id) as k, count(*) over (partition by n_features >= 20) as n from z)
select doc_id, n_features, weight, score, case when n_features >= 20 and k <= 10 * n // 100 then k end as rank from k
""",
    "op13_bag_classes": f"""
with b as (select distinct item_id, unnest({WORDS_SQL}) as term from benchmark),
d as (select row_number() over () as rid, doc_id, {WORDS_SQL} as w from documents),
tot as (select count(*) as n_docs, sum(len(w))::bigint as n_terms from d where len(w) > 0),
m as (select rid, doc_id, 50 + (50 * len(w) * n_docs) // n_terms as m from d, tot where len(w) > 0),
f as (select rid, term, count(*) as tf from (select rid, unnest(w) as term from d) where term in (select term from b) group by all),
w as (select term, floor(1000 * ln((2 * n_docs + 2)::double / (2 * count(*) + 1)))::bigint as w from f, tot group by term, n_docs),
s as (select item_id, rid, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::bigint as score from b join w using (term) join f using (term) join m using (rid) group by all),
r as (select item_id, doc_id, score, row_number() over (partition by item_id order by score desc, doc_id, rid) as rank from s join m using (rid) where score > 0)
select item_id, rank::int as rank, doc_id, score from r where rank <= 50
""",
}
