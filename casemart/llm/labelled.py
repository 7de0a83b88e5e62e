"""What the two classifiers share: held-out rows and bounded samples of labelled texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(id_column: str) -> Column:
    """Whether labels of a row are never learned from: CRC-32 of its id as text is a multiple of five (null id: false)."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def usable_labels(labels: DataFrame, label: str, values: list[int]) -> DataFrame:
    """`id, label` of the ids that may be learned from: not held out, not null, labelled with one of `values` and nothing else."""
    return (
        labels.select(F.col("doc_id").alias("id"), F.col(label).cast("int").alias("label"))
        .where(F.col("id").isNotNull() & F.col("label").isin(values)).where(~held_out("id"))
        .groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("other")).where("label = other").drop("other")
    )


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, most: dict[int, int], longest: int = 1 << 18,
) -> tuple[dict[int, list[str]], dict[int, int]]:
    """For each label value: at most `most[value]` texts of rows that aren't held out, and how many such ids there are.

    Rows are drawn by a hash of their id, so reruns agree. Only one text of each drawn id comes to the driver, and none of more than `longest` characters
    (such texts are scored like all others, they only don't teach): both bounds are parameters. Of repeated ids, the smallest text is taken.
    Rows without a label or an id take no part, nor do ids whose rows contradict each other.
    """
    usable = usable_labels(labels, label, list(most))
    counts = {row["label"]: row["count"] for row in usable.groupBy("label").count().collect()}
    order = F.xxhash64("id", F.lit(label))
    drawn = None
    for value, bound in most.items():
        part = usable.where(F.col("label") == value).orderBy(order, "id").limit(bound)
        drawn = part if drawn is None else drawn.unionAll(part)
    texts = docs.select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text")).where(F.length("text") <= longest)
    # the drawn ids are bounded by `most`, so this side can be sent to all tasks
    found = texts.join(F.broadcast(drawn), "id").groupBy("id", "label").agg(F.min("text").alias("text")).toArrow().to_pylist()
    found.sort(key=lambda row: (row["label"], row["id"]))
    sample = {value: [row["text"] for row in found if row["label"] == value] for value in most}
    return sample, {value: counts.get(value, 0) for value in most}
