"""The registered corpus queries and their SQL."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import contentsort, decontamination, htmltext, mixing, mtree, quality, quotes, secrets, simhash, spelling, substrings, tokencount, wordruns
from .common import table


#: Vocabulary of the token counts.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def op1_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.link(table(spark, sf_dir, "conversations"))


def op3_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(table(spark, sf_dir, "documents"), MODEL)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("items", ","), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op5_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.repeated_substrings(table(spark, sf_dir, "documents"))
    removed = F.aggregate(F.zip_with("starts", "ends", lambda s, e: e - s), F.lit(0).cast("long"), lambda a, x: a + x)
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("starts").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))


def op6_mtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", mtree.whole_numbers(F.col("embedding")).alias("x"))
    return mtree.top_k(vectors, vectors.filter("vec_id % 50 = 0"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.secrets(table(spark, sf_dir, "documents"))

    def count(kind: int):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")

    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                        F.sha2(secrets.listing(F.col("found"), base_only=True), 256).alias("base_sha256"),
                        secrets.listing(F.col("found")).alias("spans"))


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(table(spark, sf_dir, "pages"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def runs_of(docs: DataFrame) -> DataFrame:
    """Figures and digests of the runs of documents with planted ones."""
    found = wordruns.periodic_runs(wordruns.with_planted_runs(docs)).withColumn("top", wordruns.strongest(F.col("runs")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "top.start", "top.length", "top.period",
        F.expr("(1000 * top.length) div top.period").alias("exponent_milli"),
        F.sha2(wordruns.listing(F.col("runs")), 256).alias("runs_sha256"), F.col("text_sha256").alias("collapsed_sha256"))


def op11_wordruns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs_of(table(spark, sf_dir, "documents"))


def variants_of(docs: DataFrame) -> DataFrame:
    """Spelling variants among the words of documents with planted deletions."""
    return spelling.variants(spelling.word_counts(docs, spelling.with_planted_deletions))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants_of(table(spark, sf_dir, "documents"))


def op13_contentsort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contentsort.copies(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_quotes": op1_quotes,
    "op2_decontamination": op2_decontamination,
    "op3_tokens": op3_tokens,
    "op4_mixing": op4_mixing,
    "op5_substrings": op5_substrings,
    "op6_mtree": op6_mtree,
    "op7_secrets": op7_secrets,
    "op8_html": op8_html,
    "op9_quality": op9_quality,
    "op10_simhash": op10_simhash,
    "op11_wordruns": op11_wordruns,
    "op12_spelling": op12_spelling,
    "op13_contentsort": op13_contentsort,
}

ORACLES = {
    "op2_decontamination": decontamination.ORACLE,
    "op4_mixing": mixing.ORACLE,
    "op5_substrings": substrings.ORACLE,
    "op6_mtree": mtree.ORACLE,
    "op12_spelling": spelling.ORACLE,
    "op13_contentsort": contentsort.ORACLE,
}
