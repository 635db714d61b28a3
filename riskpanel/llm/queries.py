"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskpanel.llm import (approximate_neighbours, collocations, exact_topk, language_id, line_dedup, mixing, near_dedup, packing,
                           sharding, token_counts, token_files, toxicity, whitening)
from riskpanel.llm.common import fold, is_held_out, scratch_folder, table


def _tokenizer(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _pattern() -> str:
    import public_tokenizers
    return public_tokenizers.PATTERN


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the documents outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    langs, prototypes = language_id.collect_prototypes(language_id.learn_prototypes(docs.filter(fold() != 0)))
    return language_id.predict_language(
        docs.select("doc_id", is_held_out().alias("held_out"), "text"), langs, prototypes)


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents: shingle set size, component and whether kept."""
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards of near equal bytes; equal texts stay together."""
    a = sharding.assign_shards(table(spark, sf_dir, "documents").select("doc_id", "text"), 8)
    return a.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document before and after line dedup, with the digest of what is kept."""
    d = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), min_docs=3, min_chars=20)
    return d.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


OP4_SQL = """
with lines as (
  select doc_id, text, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) as pos
  from documents),
keyed as (
  select doc_id, line, pos,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k
  from lines),
repeated as (
  select k, max(doc_id) as last_doc from keyed where length(k) >= 20
  group by k having count(distinct doc_id) >= 3),
marked as (
  select y.doc_id, line, pos, coalesce(y.doc_id < last_doc, false) as dropped
  from keyed y left join repeated r on y.k = r.k)
select doc_id, count(*) as n_lines, count(*) filter (where dropped) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not dropped), '')) as kept_sha256
from marked group by doc_id
"""


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from labels outside the held-out fold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").filter(fold() != 0)
    lexicon, w = toxicity.learn(docs, labels)
    return toxicity.score_toxicity(docs.select("doc_id", is_held_out().alias("held_out"), "text"), lexicon, w)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Histogram of encoded lengths of all documents with the sums that answer every context limit."""
    return token_counts.length_histogram(table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.tiktoken"), _pattern())


def op7_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five rows with the largest integer inner product for every 50th vector."""
    return exact_topk.exact_top_k(table(spark, sf_dir, "embeddings"), every=50, k=5, scale=256)


OP7_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as e
  from embeddings
  where embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
pairs as (
  select q.vec_id as query_id, c.vec_id,
         cast(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])) as bigint) as score
  from v q join v c on q.vec_id % 50 = 0 and c.vec_id <> q.vec_id and len(q.e) = len(c.e)),
ranked as (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as r from pairs)
select query_id, cast(r as integer) as rank, vec_id, score from ranked where r <= 5
"""


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest rows found for every 100th vector, by Euclidean distance."""
    return approximate_neighbours.nearest_neighbours(table(spark, sf_dir, "embeddings"), every=100, k=10)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the weighted mix takes of every document."""
    m = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return m.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 4096 tokens, with digests of their ids."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    pieces = packing.cut_documents(docs, _tokenizer("word_bpe_49k.json"), window=4096, end_id=2, with_ids=False, with_crc=True)
    digests = packing.written(pieces, "piece-digests")
    return packing.place(digests, 4096).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                                               "offset")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 phrases of two and three words of every language, by the weakest of their cuts."""
    return collocations.mine_phrases(table(spark, sf_dir, "documents").select("lang", "text"), least=10, max_words=3, top=2000)


OP11_SQL = r"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece from documents),
words as (
  select lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') as ws from pieces),
total as (select lang, cast(sum(len(ws)) as bigint) as n from words group by lang),
grams as (
  select lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: ws[i:i + k - 1])) as w
  from words, (values (1), (2), (3)) as sizes(k) where len(ws) >= k),
counts as (select lang, w, cast(count(*) as bigint) as f from grams group by lang, w having count(*) >= 10),
phrases as (select lang, w, f as a from counts where len(w) > 1),
inside as (
  select lang, w, max(a) as longer from (
    select lang, a, unnest([w[1:2], w[2:3]]) as w from phrases where len(w) = 3) group by lang, w),
kept as (
  select p.lang, p.w, p.a from phrases p left join inside i on p.lang = i.lang and p.w = i.w
  where i.longer is null or 100 * i.longer < 50 * p.a),
cuts as (
  select p.lang, p.w, p.a, k, l.f as l, r.f as r,
         cast((cast(1000000 as hugeint) * p.a * p.a) // (cast(l.f as hugeint) * r.f) as bigint) as score
  from (select *, unnest(range(1, len(w))) as k from kept) p
  join counts l on l.lang = p.lang and l.w = p.w[1:k]
  join counts r on r.lang = p.lang and r.w = p.w[k + 1:]),
lowest as (select *, row_number() over (partition by lang, w order by score, k) as o from cuts),
ranked as (
  select lang, array_to_string(w, ' ') as phrase, a, l, r, score,
         row_number() over (partition by lang order by score desc, a desc, encode(array_to_string(w, ' '))) as rank
  from lowest where o = 1)
select x.lang, rank, phrase, a, l, r, n, score from ranked x join total t on x.lang = t.lang where rank <= 2000
"""


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding along the four leading components of the distinct ones, whitened."""
    w = whitening.whiten(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", k=4, scale=256)
    return w.withColumn("deviation", F.col("deviation").cast("long"))


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place and checksum of every document's token ids, read back from Arrow files of equal-length sequences."""
    folder = scratch_folder(spark, "token-files")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    manifest = token_files.write_token_files(docs, folder, _tokenizer("word_bpe_49k.json"), end_id=1)
    return token_files.read_documents(manifest, folder)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline over all documents."""
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_language_id, op2_near_dedup, op3_sharding, op4_line_dedup, op5_toxicity, op6_token_counts, op7_exact_topk,
    op8_neighbours, op9_mixing, op10_packing, op11_collocations,
    op12_whitening, op13_token_files, pipeline)}
SQL: dict[str, str] = {"op4_line_dedup": OP4_SQL, "op7_exact_topk": OP7_SQL,
                       "op11_collocations": OP11_SQL}
