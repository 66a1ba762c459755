"""Cross-site line deduplication by distinct-site spread.

Every document's lines (trimmed, empty ones aside) are hashed once into a narrow table in the shared folder. One HyperLogLog
sketch of the sites per line hash is built and merged by aggregation, so a line seen a billion times still costs one small sketch.
Lines whose estimate is clearly at or above ``min_sites`` are boilerplate, those clearly below are not; for the band around
the threshold the exact number of distinct sites decides. A boilerplate line stays only in the document with the smallest id
that has it; everywhere else each of its occurrences goes. Texts are read once to hash and once to rewrite; where few
documents change, adaptive execution joins their line lists without moving the texts.

Results for edge cases: a NULL text stays NULL, an empty one empty. A NULL site counts as no site. Rows with a NULL id lose boilerplate
lines like any other and are never the document that keeps one, unless no other has it, in which case all of them keep it.
Rows that share an id count as one document. Lines compare after trimming spaces, tabs and carriage returns; the lines that
stay are unchanged. Empty lines never go. An empty table gives an empty result. Further columns are ignored by ``boilerplate`` and kept by
``remove_boilerplate``, whatever their names; where one has the name ``removed``, the count takes the next free name. Texts of any length are worked on whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import free_name, materialise

MIN_SITES = 10
SKETCH_BITS = 11
#: Half-width of the band in which exact counts decide, relative to the threshold: over eight standard errors of the sketch.
BAND = 0.2

_TRIM = " \t\r"


def line_table(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", site_column: str = "source") -> DataFrame:
    """``line, id, site`` of each non-empty line occurrence; lines and sites as 64-bit hashes."""
    line = F.col("part")
    lines = docs.select(F.col(id_column).alias("id"), F.when(F.col(site_column).isNotNull(), F.xxhash64(F.col(site_column).cast("string"))).alias("site"), F.explode(F.split(F.col(text_column), "\n")).alias("part"))
    trimmed = F.trim(line, F.lit(_TRIM))
    return lines.where(trimmed != "").select(F.xxhash64(trimmed).alias("line"), "id", "site")


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """``line, keeper`` of lines on at least ``min_sites`` distinct sites; ``lines`` must be materialised."""
    sketched = lines.where("site is not null").groupBy("line").agg(F.hll_sketch_agg("site", F.lit(SKETCH_BITS)).alias("sketch")).select("line", F.hll_sketch_estimate("sketch").alias("estimate"))
    wide = materialise(sketched.where(F.col("estimate") >= min_sites * (1 - BAND)))
    clear = wide.where(F.col("estimate") > min_sites * (1 + BAND)).select("line")
    near = wide.where(F.col("estimate") <= min_sites * (1 + BAND)).select("line")
    exact = lines.join(near, "line", "left_semi").where("site is not null").groupBy("line").agg(F.count_distinct("site").alias("sites")).where(F.col("sites") >= min_sites).select("line")
    return clear.unionAll(exact)


def remove_boilerplate(docs: DataFrame, min_sites: int = MIN_SITES, id_column: str = "doc_id", text_column: str = "text", site_column: str = "source", removed: str | None = None, drop_emptied: bool = False) -> DataFrame:
    """The documents with boilerplate lines taken out of their texts, and their number in the column ``removed`` if named.

    With ``drop_emptied`` the documents go of which only blank lines are left.
    """
    lines = materialise(line_table(docs, id_column, text_column, site_column))
    hits = materialise(lines.join(boilerplate(lines, min_sites), "line", "left_semi").select("line", "id").distinct())
    keeper = hits.groupBy("line").agg(F.min("id").alias("keeper"))
    gone = hits.join(keeper, "line").where(~F.col("id").eqNullSafe(F.col("keeper"))).groupBy("id").agg(F.collect_set("line").alias("gone"))
    clash = {c: f"__c{i}" for i, c in enumerate(docs.columns)}
    plain = docs.select([F.col(f"`{c}`").alias(a) for c, a in clash.items()])
    own_id, own_text = clash[id_column], clash[text_column]
    joined = plain.join(gone.withColumnRenamed("id", "__id").withColumnRenamed("gone", "__gone"), F.col(own_id).eqNullSafe(F.col("__id")), "left")
    trimmed = lambda x: F.trim(x, F.lit(_TRIM))
    stays = lambda x: (trimmed(x) == "") | ~F.array_contains(F.col("__gone"), F.xxhash64(trimmed(x)))
    parts = F.split(F.col(own_text), "\n")
    rest = F.filter(parts, stays)
    text = F.when(F.col("__gone").isNull() | F.col(own_text).isNull(), F.col(own_text)).otherwise(F.array_join(rest, "\n"))
    out = [text.alias(f"__n{i}") if c == text_column else F.col(a) for i, (c, a) in enumerate(clash.items())]
    if removed:
        out.append(F.when(F.col("__gone").isNull() | F.col(own_text).isNull(), F.lit(0)).otherwise(F.size(parts) - F.size(rest)).cast("bigint").alias("__removed"))
    if drop_emptied:
        joined = joined.where(F.col("__gone").isNull() | F.col(own_text).isNull() | F.exists(rest, lambda x: trimmed(x) != ""))
    return joined.select(out).toDF(*docs.columns, *([free_name(removed, docs.columns)] if removed else []))
