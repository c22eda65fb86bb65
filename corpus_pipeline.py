"""The corpus pipeline: documents through five stages, each written and read again.

quality: documents the classifier rejects go. near_copies: of documents linked by Jaccard
similarity of five-word shingles (0.8), one stays. decontaminate: benchmark passages are cut out,
documents that consist of them go. mix: documents are taken as often as the mix of
sources wants. tokens: the ids are written to seekable files and read back.

Every stage but the last returns the columns of its documents, extra ones and such with names that the
operators use themselves among them. Defined results:

* null and empty texts: quality scores them by the bias of its model; near_copies keeps them all (they have no
  shingles and link with nothing); decontaminate keeps them; mix gives them size 0 and takes them by the whole
  part of their source's rate; tokens writes their end id. Null ids and sources are values of their own; null labels don't count.
* very long texts are worked on whole, some characters or chunks at a time.
* ties and repeated rows: equal rows have one score; of a group of near copies the row of the smallest id (null
  ids last, then the first such row) stays; repeated rows that reach the mix are taken as evenly as can be.
* empty tables: without labels every score is 0.5, below the threshold, so nothing is kept; without benchmark items
  nothing is cut; without documents every stage returns none.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clutchforge.llm import decontaminate, jaccard_join, quality, source_mix, token_output
from clutchforge.llm.common import materialise, prepare, table

ORACLE_SQL = None  # no stage but the last could be told in SQL; tests/llm/test_pipeline.py has a brute-force version


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose score reaches the threshold, as they are."""
    score = quality.fitted_scorer(docs, table(prepare(spark), sf_dir, "labels"))
    return docs.filter(score(F.col("text")) >= quality.THRESHOLD)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, as it is."""
    prepare(spark)
    return jaccard_join.drop_near_copies(docs, shingle=5, percent=80)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages; ``n_chars`` follows the texts that were cut."""
    prepare(spark)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"), chars_col="n_chars")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it (not at all, once or twice)."""
    prepare(spark)
    return source_mix.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, read back from the files."""
    prepare(spark)
    return token_output.token_output(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_quality),
    ("near_copies", drop_near_copies),
    ("decontaminate", decontaminated),
    ("mix", mix),
    ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
