"""A corpus pipeline: quality rules, near-duplicates, decontamination, mixing, token output.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next stage's ``docs``. All but the last return the columns of ``documents``:

* ``quality`` keeps documents that pass the base rules and their language's perplexity band;
* ``near_duplicates`` keeps one document of each group;
* ``decontaminate`` keeps documents without any benchmark window;
* ``mix`` keeps every row and writes the rows in mixing order;
* ``tokens`` writes token ids in that order (file number, then row in the file) and returns
  ``doc_id, start, n_tokens, ids_crc32`` read back from the token files.

Null and empty texts fail the base rules and end there; an empty table gives empty results; further
columns of ``documents`` are carried along up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm import decontaminate as _decontaminate
from kestrel.llm import minhash_odd, pfair_mix, quality_kn, token_output
from kestrel.llm.common import materialize, table
from kestrel.session import configure, shared_folder


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    return quality_kn.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    return minhash_odd.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    return _decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    return pfair_mix.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in the row order of ``docs``' files, which is the mixing order."""
    configure(spark)
    part = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("long")
    placed = docs.select("doc_id", "text", part.alias("_part"), F.col("_metadata.row_index").alias("_row"))
    path = shared_folder(spark, "tokens")
    token_output.write_tokens(placed, path, token_output.tokenizer_path(), order=[F.col("_part"), F.col("_row")])
    return token_output.token_digest(spark, path)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate),
          ("mix", mix), ("tokens", tokens)]

# Trained models, MinHash and a tokenizer cannot be written in SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
