"""The corpus pipeline: toxicity, near-dedup, decontamination, mixing, sharding.

Each stage gets all that the stage before it kept, as a table, and all but the last return the
columns of documents.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.llm.common import quoted, saved, small_side, table
from assay.llm.decontaminate import contaminated
from assay.llm.mixing import mixed
from assay.llm.near_dedup import near_duplicates
from assay.llm.sharding import shard_documents
from assay.llm.toxicity import toxicity

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


#: Most ids that are broadcast to all documents, as those that stand for several texts; more are joined by a shuffle.
FEW_CLASHES = 1_000_000


def packed(docs: DataFrame, *needed: str, but: tuple[str, ...] = ()) -> DataFrame:
    """All columns of ``docs`` in one column ``row`` and the ``needed`` ones beside it.

    So no column of the documents meets a name that an operator uses, and any type passes.
    """
    row = F.struct(*[quoted(c) for c in docs.columns if c not in but])
    return docs.select(row.alias("row"), *needed)


def identified(docs: DataFrame) -> DataFrame:
    """``row, doc_id, text`` with a doc_id that stands for one text only.

    That is the document's own id; where it is null or stands for several texts, a hash of id and text.
    """
    rows = packed(docs, F.col("doc_id").cast("long").alias("doc_id"), "text")
    print_ = F.xxhash64(F.col("doc_id").isNull(), "doc_id", F.col("text").isNull(), "text")
    ids = rows.select("doc_id", print_.alias("print")).groupBy("doc_id").agg(F.min("print").alias("low"), F.max("print").alias("high"))
    unlike = saved(ids.where("low <> high OR doc_id IS NULL").select(F.col("doc_id").alias("_id"), F.lit(True).alias("_unlike")), "unlike")
    n = unlike.count()
    if not n:
        return rows
    marked = rows.join(small_side(unlike, n, FEW_CLASHES), F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    return marked.select("row", F.when(F.col("_unlike"), print_).otherwise(F.col("doc_id")).alias("doc_id"), "text")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls toxic go. Null and empty texts, and repeated rows, are judged like others."""
    scored = toxicity(packed(docs, "doc_id", "text"), table(spark, sf_dir, "labels"))
    return scored.where("predicted = 0").select("row.*")


def listed(ids: DataFrame, name: str) -> DataFrame:
    """Saved ``ids``, broadcast if few, so that the documents that they are looked up for are not shuffled."""
    ids = saved(ids, name)
    return small_side(ids, ids.count(), FEW_CLASHES)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class stays, the one with the smallest id; of rows equal in id and text, one.

    Rows without id, and rows that share an id but not the text, take part on their own. Null and
    empty texts are alike to none.
    """
    rows = identified(docs)
    classes = saved(near_duplicates(rows.select("doc_id", "text")), "classes")
    copies = listed(classes.where("doc_id <> class_id").select("doc_id").distinct(), "copies")
    kept = rows.join(copies, "doc_id", "left_anti")
    repeated = listed(classes.where("doc_id = class_id").groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated")
    single = kept.join(repeated, "doc_id", "left_anti").select("row.*")
    once = kept.join(repeated, "doc_id", "left_semi").groupBy("doc_id").agg(F.first("row").alias("row")).select("row.*")
    return single.unionByName(once)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go; rows of one id are judged by their own text."""
    rows = identified(docs)
    leaks = contaminated(rows.select("doc_id", "text"), table(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    return rows.join(leaks, "doc_id", "left_anti").select("row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it; null sources are one source, texts without words weigh nothing."""
    return mixed(packed(docs, "doc_id", "source", "text")).select("row.*")


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with ``size``, ``shard`` and ``slot``; own columns of these names are replaced. Null ids and texts count."""
    placed = shard_documents(packed(docs, "doc_id", "text", but=("size", "shard", "slot")))
    return placed.select("row.*", "size", "shard", "slot")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: Learned weights and sketches can't be expressed in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
