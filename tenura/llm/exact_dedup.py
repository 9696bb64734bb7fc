"""Exact duplicates by two passes over a Bloom filter: only rows whose hash may repeat are shuffled.

First pass: every task sets bits for its rows' hashes in a filter that keeps two facts for each bit, "set" and "set by
more than one row". A segment of the filter is merged in one small group. Second pass: a row all of whose bits were set
more than once may be a copy and goes to an exact group-by on its hash; any other row is alone and passes straight through.

The filter's size is bounded (``bloom``). Beyond some rows it lets more single rows through to the exact step, up to all of
them; the result is the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.llm import bloom
from tenura.llm.tables import free_name, same
from tenura.session import stage

# A text with this share of the rows that may be copies, or more, is hot.
ONE_IN = 1000


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its group of equal texts and whether it stays.

    Columns: ``id_col``; ``keep_id`` (largest id of the group); ``group_size`` (rows); ``kept``; ``text_sha256``; and
    ``n_same`` (rows with this id and this text). A null text is empty. A null id is the smallest id. Rows that repeat id
    and text are copies of one document: all carry ``kept``; ``keep_one`` leaves one of them. No rows: no rows.
    """
    sha = F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256)
    hashed = stage(docs.select(F.col(id_col).alias("id"), F.unhex(sha).alias("sha")), "hashes")
    hashed = hashed.withColumn("hash", F.conv(F.hex(F.substring("sha", 1, 8)), 16, -10).cast("bigint"))
    filter_, segments = bloom.build(hashed.select("hash"), hashed.count(), 2)
    flagged = bloom.marked(hashed, F.col("hash"), filter_, segments, "may_repeat")
    alone = flagged.where(~F.col("may_repeat")).select(
        "id", "sha", F.col("id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"), F.lit(1).cast("bigint").alias("n_same")
    )
    again = flagged.where("may_repeat").select("id", "sha")
    each = stage(again.groupBy("sha", "id").agg(F.count(F.lit(1)).alias("n_same")), "each")
    groups = each.groupBy(F.col("sha").alias("_sha")).agg(F.max("id").alias("keep_id"), F.sum("n_same").alias("group_size"), F.count(F.lit(1)).alias("_ids"))
    groups = stage(groups, "groups")
    # A row for each (text, id) meets the row of its text; rows that repeat both are laid out again by their count. Texts with one in
    # ``ONE_IN`` of these rows, or more, are at most as many; they are broadcast, and what is left is spread evenly.
    large = F.col("_ids") * ONE_IN >= F.lit(each.count())
    hot, rest = F.broadcast(groups.where(large)), groups.where(~large)
    by_text = F.col("sha") == F.col("_sha")
    met = each.join(hot, by_text).unionByName(each.join(hot.select("_sha"), by_text, "left_anti").join(rest, by_text))
    copies = met.select(F.explode(F.sequence(F.lit(1).cast("bigint"), "n_same")).alias("_copy"), "id", "sha", "keep_id", "group_size", "n_same")
    out = alone.unionByName(copies.drop("_copy"))
    return out.select(
        F.col("id").alias(id_col), "keep_id", "group_size", same(F.col("id"), F.col("keep_id")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"), "n_same"
    )


def keep_one(docs: DataFrame, groups: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one of each group, with the columns of ``docs``.

    ``groups`` is what ``exact_groups`` says of ``docs``. A filter of the ids that go lets most other rows pass straight through, so
    that about the texts that go are shuffled and no more.
    """
    odd = groups.where(~F.col("kept") | (F.col("n_same") > 1))
    key, own, kept = (free_name(docs, n) for n in ("__key", "__sha", "__kept"))
    gone = stage(odd.select(F.col(id_col).alias(key), F.col("text_sha256").alias(own), F.col("kept").alias(kept)).distinct(), "gone")
    sha = F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256)
    meets = same(F.col(id_col), F.col(key)) & (sha == F.col(own))
    stays = bloom.without(docs, gone, F.col(id_col), key, meets)
    # Rows that repeat id and text: the few that must be counted against each other.
    again = gone.where(kept)
    if not again.limit(1).count():
        return stays
    return stays.unionByName(docs.join(again, meets).dropDuplicates([key, own]).select(docs.columns))
