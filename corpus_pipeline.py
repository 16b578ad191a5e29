"""From raw documents to packed sequences: the stages of a training corpus.

Each stage takes what its predecessor kept, whole texts and all columns of
documents; the last one returns where each piece of a document is packed.

Verdicts on single documents travel with the document: it is not joined again.
Where a verdict comes from elsewhere (near duplicates), rows are told apart by a
key that is made when the stage writes its input.  So missing and repeated
doc_ids are documents like any other.

Defined cases, in each stage: a missing, empty or word-less text is rejected by
the quality rules; should it reach a later stage, language ID rejects what has
no letter, near duplicates and repeated passages leave it as it is, and packing
gives it one row without a bin.  Very long texts are processed whole.  Of equal
documents the one with the least doc_id stays, a missing one being greater than
all, and of rows with the same doc_id the first.  Missing languages and sources
are values like others.  An empty table gives an empty result.  Columns of
documents beyond the five are dropped by ``run`` and kept by the stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.llm.common import MADE, discard, written
from ledgerspark.llm.jaccard_join import similar_groups
from ledgerspark.llm.language_id import UNKNOWN, language_id
from ledgerspark.llm.packing import best_fit_packing
from ledgerspark.llm.quality_rules import quality_verdicts
from ledgerspark.llm.substring_dedup import substring_dedup

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
LEAST_SCORE = 0.5
#: So many keys are broadcast; more are joined by a shuffle.
HOLD = 1 << 19


def _named(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the outlier test reject go."""
    return quality_verdicts(docs, with_doc=True).filter("kept").select("doc.*")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no known language, or of a doubtful one, go."""
    out = language_id(docs, with_row=True).filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    return out.select(*[F.col(c) if c in ("doc_id", "text") else F.col("rest").getField(c).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one document with the least doc_id stays; a missing one is greater than all."""
    before = list(MADE)
    rows = written(docs.select(F.struct(*_named(docs)).alias("doc"), F.monotonically_increasing_id().alias("row")), "rows")
    groups = similar_groups(rows.select(F.col("row").alias("doc_id"), F.col("doc.text").alias("text"), F.col("doc.doc_id").cast("long").alias("own")), carry=("own",))
    groups = written(groups.select(F.col("doc_id").alias("row"), "own", F.col("component_id").alias("group")), "groups")
    keep = [*before, rows.written_to]
    discard(spark, [x for x in MADE if x not in keep and x != groups.written_to])
    # the first of a group by an aggregate, which combines before the shuffle; a group is named by one of its rows
    first = groups.groupBy("group").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(F.col("own").isNull().alias("none"), "own", "row"))["row"].alias("first")).filter("n > 1")
    first = written(first, "first")
    small = first.limit(HOLD + 1).count() <= HOLD
    gone = groups.join(F.broadcast(first) if small else first, "group").filter("row <> first").select("row")
    gone = written(gone, "gone")
    discard(spark, [x for x in MADE if x not in keep and x != gone.written_to])
    if gone.limit(HOLD + 1).count() <= HOLD:
        gone = F.broadcast(gone)
    return rows.join(gone, "row", "left_anti").select("doc.*")


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more that an earlier document has go; a document that loses all its words goes too."""
    out = substring_dedup(docs, with_text=True).filter("n_words = 0 OR n_removed < n_words")
    rest = {c: F.col("rest").getField(c) for c in docs.columns if c not in ("doc_id", "text", "n_chars")}
    own = {"doc_id": F.col("doc_id"), "text": F.col("kept_text"), "n_chars": F.when(F.col("n_removed") > 0, F.length("kept_text").cast("long")).otherwise(F.col("rest.n_chars"))}
    return out.select(*[(own | rest)[c].alias(c) for c in docs.columns])


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of a document goes."""
    return best_fit_packing(docs)


STAGES = [("quality rules", quality), ("language ID", language), ("n-gram Jaccard join", near_duplicates), ("substring dedup", repeated_passages), ("best-fit packing", packed)]

#: The outlier test, the classifier and the packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage keeps is written and read again, and what it needed is removed."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*COLUMNS), list(MADE)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        discard(spark, [x for x in MADE if x not in before and x != docs.written_to])
    return STAGES[-1][1](spark, docs, sf_dir)
