"""The operators applied to their whole tables, by query name; and their SQL, where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks.llm import (
    bpe, centroids, embedding_itq, html_consensus, licences, mixing, packing, periodic_runs, quality, simhash, syncmers,
    toxicity, warc,
)
from tapeworks.llm.columns import WORDS, table
from tapeworks.session import workspace

# A public vocabulary; the driver reads the file and broadcasts it.
WORD_BPE = str(public_tokenizers.path("word_bpe_49k.json"))

Query = Callable[[SparkSession, str], DataFrame]


def quality_model(spark: SparkSession, sf_dir: str) -> quality.Trees:
    """Fitted on the labelled rows of the tables, whatever the rows that it then scores."""
    return quality.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.Model:
    return toxicity.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.judged(docs, quality_model(spark, sf_dir))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs)


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, WORD_BPE)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.taken_words(mixing.mix(docs)).select("doc_id", "size", "source_size", "target", "taken")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.judged(docs, toxicity_model(spark, sf_dir))


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_consensus.extracted(pages, keep=["page_id", "url"]).withColumn("n_chars", F.length("text").cast("long"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = workspace(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), folder)
    return warc.read(spark, folder, payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.compared(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_itq.near_duplicates(table(spark, sf_dir, "embeddings"))


def op6_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licences.found(docs, licences.train(docs)).drop("text")


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = packing.pieces(table(spark, sf_dir, "documents"), WORD_BPE)
    return packing.packed(cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clusters(table(spark, sf_dir, "embeddings"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text; where crc32 of the id divides by ten, the words from some place on repeat with some period."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    g = F.floor(h / 10)

    def repeated(words: Column) -> Column:
        n = F.size(words)
        start = g % n
        period = 1 + F.floor((n - start) / (3 + g % 8))
        place = F.transform(F.sequence(F.lit(0).cast("long"), n - F.lit(1).cast("long")),
                            lambda i: F.when(i < start, i).otherwise(start + (i - start) % period).cast("int"))
        return F.concat_ws(" ", F.transform(place, lambda i: F.get(words, i)))

    # Bound as an element of an array, the words are found once.
    words = F.array(F.regexp_extract_all("text", F.lit(WORDS), F.lit(0)))
    edited = F.get(F.transform(words, lambda w: F.when(F.size(w) > 0, repeated(w)).otherwise(F.lit(""))), 0)
    return docs.select("doc_id", F.when(h % 10 == 0, edited).otherwise(F.col("text")).alias("text"))


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.with_runs(with_planted_runs(table(spark, sf_dir, "documents")), keep=["doc_id"])
    best = F.array_max(F.transform("runs", lambda r: F.struct(r.length, -r.start, -r.period)))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    longest = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
                           F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
                           F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
    start, length, period = -F.col("best.col2"), F.col("best.length"), -F.col("best.col3")
    return longest.select("doc_id", "n_runs", start.alias("start"), length.alias("length"), period.alias("period"),
                          F.floor(1000 * length / period).alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


def llm_queries() -> dict[str, Query]:
    return {
        "op1_quality": op1_quality,
        "op2_simhash": op2_simhash,
        "op3_warc": op3_warc,
        "op4_bpe": op4_bpe,
        "op5_embeddings": op5_embeddings,
        "op6_licences": op6_licences,
        "op7_syncmers": op7_syncmers,
        "op8_mixing": op8_mixing,
        "op9_toxicity": op9_toxicity,
        "op10_html": op10_html,
        "op11_packing": op11_packing,
        "op12_centroids": op12_centroids,
        "op13_runs": op13_runs,
    }


# Base32 of a SHA-1: five hexadecimal digits make four of its characters.
_OP3 = """
with hashed as (
  select page_id, strlen(coalesce(html, '')) as payload_bytes, upper(sha1(coalesce(html, ''))) as hex from pages
), spelt as (
  select page_id, payload_bytes,
         array_to_string(list_transform(range(0, 8), lambda g: array_to_string(list_transform([15, 10, 5, 0], lambda b:
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[((cast('0x' || hex[5 * g + 1 : 5 * g + 5] as bigint) >> b) & 31) + 1]
         ), '')), '') as payload_digest
  from hashed
), firsts as (select *, min(page_id) over (partition by payload_digest) as first from spelt)
select page_id, cast(payload_bytes as bigint) as payload_bytes, payload_digest,
       case when page_id = first then 'response' else 'revisit' end as record_type,
       case when page_id <> first then first end as refers_to
from firsts"""

_OP5 = """
with recursive vectors as (
  select vec_id, list_transform(embedding, lambda x: cast(x as double)) as v from embeddings
), usable as (
  select vec_id, v, sqrt(list_dot_product(v, v)) as norm from vectors
  where v is not null and len(v) = 64 and len(list_filter(v, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(v, lambda x: x <> 0)) > 0
), links as (
  select a.vec_id as a, b.vec_id as b from usable a join usable b
    on a.vec_id <> b.vec_id and list_dot_product(a.v, b.v) / (a.norm * b.norm) >= 0.9
), reach as (
  select vec_id, vec_id as other from embeddings
  union
  select reach.vec_id, links.b from reach join links on reach.other = links.a
), least as (select vec_id, min(other) as component_id from reach group by vec_id)
select vec_id, (select count(*) from links where links.a = vec_id) as n_links, component_id,
       vec_id = component_id as kept
from least"""


def _op12(rounds: int = 10) -> str:
    """Every round spelt out: vectors go to their nearest centroid, centroids to the floors of the means."""
    steps = ["""
with v as materialized (
  select row_number() over () as nth, vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as x
  from embeddings
  where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), c0 as materialized (
  select row_number() over (order by sha256('3:' || vec_id), x) - 1 as c, x from v
  qualify row_number() over (order by sha256('3:' || vec_id), x) <= 8
)"""]
    for r in range(rounds + 1):
        steps.append(f"""a{r} as materialized (
  select nth, vec_id, c, v.x,
         list_sum(list_transform(list_zip(v.x, k.x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) as d
  from v cross join c{r} k qualify row_number() over (partition by nth order by d, c) = 1
)""")
        if r < rounds:
            steps.append(f"""s{r} as materialized (
  select c, i, sum(e) as s, count(*) as n
  from (select c, unnest(x) as e, unnest(range(1, 65)) as i from a{r}) group by c, i
), c{r + 1} as materialized (
  select k.c, coalesce(m.x, k.x) as x from c{r} k left join (
    select c, list(cast((s - ((s % n) + n) % n) // n as bigint) order by i) as x from s{r} group by c) m on k.c = m.c
)""")
    return ", ".join(steps) + f"""
select vec_id, cast(a.c as int) as cluster, cast(d as bigint) as distance,
       cast(sum(d) over (partition by a.c) as bigint) as cluster_inertia, cast(sum(d) over () as bigint) as inertia,
       sha256(array_to_string(k.x, ',')) as centroid_sha256
from a{rounds} a join c{rounds} k on a.c = k.c"""


def llm_oracles() -> dict[str, str]:
    """The others are beyond SQL: trained models, seeded hashes, tokenizers, parsers."""
    return {"op3_warc": _OP3, "op5_embeddings": _OP5, "op12_centroids": _op12()}
