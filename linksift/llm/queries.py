"""The operators over their whole tables: one query each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linksift.llm import ann, collocations, decontaminate, jaccard_join, license_scan, line_dedup, packing, pieces, quality, sharding, token_counts, url_filter, whitening
from linksift.llm.common import fresh_path, table, tokenizer_file

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str):
    def put(f):
        QUERIES[name] = f
        return f

    return put


@query("op6_bit_packing")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as packed token files; per document what the files hold."""
    return packing.token_files(
        table(spark, sf_dir, "documents"), fresh_path(spark, "packed"), tokenizer_file("byte_bpe_50k.json"), end_id=2
    )


@query("op1_token_counts")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document, each document encoded once."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    return token_counts.attribute_tokens(docs, tokenizer_file("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, rule="most")


@query("op10_quality")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its quality score."""
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.3)


URL_RULES = (
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"),
)


@query("op9_url_filter")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL by the rules, else by its template's purity; the rules label the pages."""
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


ORACLE["op9_url_filter"] = url_filter.oracle_sql(URL_RULES)


@query("op8_jaccard_join")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of all documents by shared word shingles."""
    return jaccard_join.similar_groups(table(spark, sf_dir, "documents"))


@query("op3_decontaminate")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, as it stands or with other values."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op4_label_propagation")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of equal counts, equal texts together."""
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


@query("op2_license_scan")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every license notice in every document."""
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


@query("op5_hnsw")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest of each row whose id is divisible by 100, by a graph per shard."""
    return ann.nearest(table(spark, sf_dir, "embeddings"), every=100, k=10)


@query("op7_merge_dropout")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of every document with merge dropout, decoded again as a check."""
    return pieces.encode_pieces(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"), seed=17)


@query("op11_line_dedup")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that ten documents or more share."""
    kept = line_dedup.dedup_lines(table(spark, sf_dir, "documents"), min_docs=10, min_chars=1)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


ORACLE["op11_line_dedup"] = line_dedup.oracle_sql(min_docs=10, min_chars=1)


@query("op12_collocations")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 phrases of each language by their weakest cut."""
    return collocations.collocations(table(spark, sf_dir, "documents"), least=100, longest=5, top=2000)


ORACLE["op12_collocations"] = collocations.oracle_sql(least=100, longest=5, top=2000)


@query("op13_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors projected on their 32 leading components at unit variance."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=32)
