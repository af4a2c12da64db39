"""Registered queries ``opN_<name>``: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trajlake.llm import (
    decontaminate,
    embed_pstable,
    hyper_shuffle,
    lang_backoff,
    ngram_trie,
    pii_transducer,
    pivot_clusters,
    pivotal_mix,
    quality_rff,
    simhash_bits,
    spectrum_whiten,
    suffix_doubling,
    token_rans,
)
from trajlake.llm.shared import table

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
SHARDS = 24


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op1_pigeonhole_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a near copy of a benchmark item, with the item and the edits between them."""
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "edits", "ends_at")


def op2_rans_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents, written as rANS blocks and read back."""
    decoded = token_rans.encode_documents(table(spark, sf_dir, "documents"), tokenizer_path(), END_ID)
    return decoded.select("doc_id", "start", "n_tokens", "ids_crc32")


def op3_bit_sliced_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    groups = simhash_bits.simhash_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", "fingerprint", "component_id")


def op4_deobfuscated_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document, plain and disguised."""
    found = pii_transducer.find_personal_data(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2(F.col("base_spans").cast("binary"), 256).alias("base_sha256"),
                        "spans", "n_disguised")


def op5_word_backoff_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned from two folds of three."""
    docs = table(spark, sf_dir, "documents")
    held_out = lang_backoff.fold(F.col("doc_id"), 3) == 1
    found = lang_backoff.identify(docs, lang_backoff.learn(docs.where(~held_out)))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op6_rff_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from four folds of five."""
    measured = quality_rff.measure(table(spark, sf_dir, "documents"))
    model = quality_rff.fit(quality_rff.training_rows(measured), table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return quality_rff.score(measured, model).select(
        "doc_id", (lang_backoff.fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
        (F.col("score") >= quality_rff.CUT).cast("int").alias("predicted"))


def op7_hypergeometric_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of equal row counts, uniformly shuffled."""
    dealt = hyper_shuffle.shard_documents(table(spark, sf_dir, "documents"), SHARDS)
    return dealt.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                        F.lit(None).cast("int").alias("grown_shard"))


def op8_prefix_doubling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of 100-byte strings that also start earlier."""
    cut = suffix_doubling.remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op9_pstable_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of embeddings at cosine 0.98 within a label."""
    return embed_pstable.near_vectors(table(spark, sf_dir, "embeddings"), cosine=0.98)


def op10_pivotal_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of all sources takes of each document."""
    mixed = pivotal_mix.mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", "size", "source_size", "target", "copies", "taken")


def op11_spectrum_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened leading components of every embedding."""
    white = spectrum_whiten.whiten(table(spark, sf_dir, "embeddings"))
    each = white.select("vec_id", "n", F.expr("try_cast(deviation as bigint)").alias("deviation"), "identity_error",
                        F.posexplode(F.arrays_zip("whitened", "explained")).alias("place", "of"))
    return each.select("vec_id", (F.col("place") + 1).cast("int").alias("component"), "n", "deviation", "of.whitened", "of.explained", "identity_error")


def op12_ptolemaic_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster and distance of every embedding of 64 components."""
    placed = pivot_clusters.cluster_vectors(table(spark, sf_dir, "embeddings"))
    return placed.select("vec_id", "cluster", "distance", F.col("cluster_inertia").cast("long").alias("cluster_inertia"),
                         F.col("inertia").cast("long").alias("inertia"), "centroid_sha256")


def op13_trie_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model scores of every document, learned from six folds of seven."""
    return ngram_trie.score_documents(table(spark, sf_dir, "documents"), lang_backoff.fold(F.col("doc_id"), 7) != 2)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pigeonhole_decontamination": op1_pigeonhole_decontamination,
    "op2_rans_token_files": op2_rans_token_files,
    "op3_bit_sliced_simhash": op3_bit_sliced_simhash,
    "op4_deobfuscated_pii": op4_deobfuscated_pii,
    "op5_word_backoff_language": op5_word_backoff_language,
    "op6_rff_quality": op6_rff_quality,
    "op7_hypergeometric_shards": op7_hypergeometric_shards,
    "op8_prefix_doubling": op8_prefix_doubling,
    "op9_pstable_neighbours": op9_pstable_neighbours,
    "op10_pivotal_mix": op10_pivotal_mix,
    "op11_spectrum_whitening": op11_spectrum_whitening,
    "op12_ptolemaic_clusters": op12_ptolemaic_clusters,
    "op13_trie_scores": op13_trie_scores,
}


def _clusters_sql(clusters: int, rounds: int) -> str:
    """The clustering without pivots: every distance, round by round."""
    parts = [f"""kept as (
  select row_number() over () as rid, vec_id, list_transform(embedding, lambda c: floor(64 * c::double)::bigint) as v
  from embeddings where len(embedding) = 64 and list_bool_and(list_transform(embedding, lambda c: coalesce(isfinite(c::double) and abs(floor(64 * c::double)) <= {1 << 27}, false)))),
c0 as (select (row_number() over (order by h, v) - 1)::int as k, v as c
  from (select rid, v, sha256('1:' || coalesce(vec_id::varchar, '')) as h from kept order by h, v limit {clusters}))"""]
    for r in range(rounds + 1):
        parts.append(f"""a{r} as (
  select rid, any_value(vec_id) as vec_id, any_value(v) as v, min(d * {clusters} + k) as m from (
    select rid, vec_id, v, k, list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::hugeint as d from kept, c{r}) group by rid)""")
        if r < rounds:
            parts.append(f"""c{r + 1} as (
  select k, list(x order by i) as c from (
    select k, i, ((s - ((s % n) + n) % n) // n)::bigint as x from (
      select (m % {clusters})::int as k, i, sum(x) as s, count(*) as n from (
        select m, unnest(v) as x, generate_subscripts(v, 1) as i from a{r}) group by 1, 2)) group by k
  union all select k, c from c{r} where k not in (select (m % {clusters})::int from a{r}))""")
    return "with " + ", ".join(parts) + f"""
select vec_id, c{rounds}.k as cluster, (m // {clusters})::bigint as distance, sum((m // {clusters})::bigint) over (partition by c{rounds}.k)::bigint as cluster_inertia,
  sum((m // {clusters})::bigint) over ()::bigint as inertia, sha256(array_to_string(c, ',')) as centroid_sha256
from a{rounds} join c{rounds} on c{rounds}.k = (m % {clusters})::int"""


#: DuckDB SQL where it can express a query; the others are tested against brute force.
ORACLE: dict[str, str] = {
    "op12_ptolemaic_clusters": _clusters_sql(pivot_clusters.CLUSTERS, pivot_clusters.ROUNDS),
}
