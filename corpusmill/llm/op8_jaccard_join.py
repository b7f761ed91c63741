"""N-gram Jaccard join: linked documents and their components, exactly."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.kernels import lower_ascii, shingles, slices, span_hashes, utf8, words
from corpusmill.llm.postings import Sets, cross_lists, hub_links, least_overlap, prefix_pairs, shared_sets, slice_bytes
from corpusmill.llm.shared import components, stored


def document_sets(k: int, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[Sets]:
        for batch in slices(batches, limit=limit):
            buf, off = utf8(batch.column("text"))
            buf = lower_ascii(buf)
            starts, ends, doc = words(buf, off)
            ids = batch.column("id").to_numpy().astype(np.int64)
            yield ids, *[np.zeros(len(ids), np.int64)] * 2, *shingles(span_hashes(buf, starts, ends), doc, k)

    return run


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, num: int = 3, den: int = 4) -> DataFrame:
    """(id, n_shingles, component_id) of each document; documents link at den * |A & B| >= num * |A | B| over sets of
    `k`-word shingles (words lower-cased in A-Z; fewer than k words: the whole sequence as one; none: the empty set,
    linked with nothing).

    Set relations save the work. A set's answers start as those of the set that holds most of its tokens: each shared
    token names its first set, and counts by first set are lower bounds of the overlap, so that near copies join one
    leader without any pair of theirs being listed. Copies share one class. From then on a set is asked only about
    tokens that sets of another component hold too; if too few are left for any partner, its answers are its leader's.
    Then the heaviest set that holds a token, the one that near copies vary, leads in the same way. The rest meet in posting lists that are skipped by block, by size and position, and are verified exactly.

    A null id: n_shingles and component_id null, no links. Null text: as empty. Rows that repeat an id: one row each,
    one component, by the links of all their texts. Columns of any other name are ignored. An empty table: no rows.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    found = stored(shared_sets(rows.where("id is not null"), document_sets(k, slice_bytes(docs.sparkSession)), num, den, keep_all=True), "sets", "zstd")
    alive = found.where("tokens is not null")
    lead = alive.selectExpr("batch as lead_batch", "idx as lead_idx", "key1 as b", "n as nb")
    star = alive.join(lead, ["lead_batch", "lead_idx"]).where(f"{den} * lead_overlap >= {num} * (n + nb - lead_overlap) and {least_overlap(num, den, 'lead_overlap')}").selectExpr("key1 as a", "b")
    # A class is asked under an id of its own: one document id may stand for the classes of several texts.
    equal = ["digest", "digest2", "n"]
    first = alive.groupBy(*equal).agg(F.min(F.struct("key1", "batch", "idx")).alias("m")).selectExpr(*equal, "m.key1 as b", "m.batch as batch", "m.idx as idx")
    first = stored(first.withColumn("id", F.monotonically_increasing_id()), "classes")
    same = alive.join(first.select(*equal, "b"), equal).selectExpr("key1 as a", "b").where("a <> b")
    near = stored(components(star.union(same)), "near")
    # Classes get their labels without tokens, and tokens by the place of their first set: token lists are dealt out once.
    named = first.join(near.withColumnRenamed("id", "b"), "b", "left").selectExpr("batch", "idx", "id", "b as doc", "coalesce(component, b) as label")
    asked = stored(alive.select("batch", "idx", "n", "tokens", "weight").join(named, ["batch", "idx"]).select("id", "doc", "label", "n", "tokens", "weight"), "asked", "zstd")
    listed = cross_lists(asked, num, den)
    wide = components(hub_links(listed, asked, num, den), "label", "other").selectExpr("id as label", "component as wider")
    left = listed.join(wide, "label", "left").selectExpr("id", "coalesce(wider, label) as label", "n", "transform(s, x -> x.tok) as tokens", "cast(0 as float) as weight")
    left = cross_lists(left, num, den).selectExpr("id", "label", "n", "transform(s, x -> x.tok) as tokens")
    far = components(prefix_pairs(left, num, den).selectExpr("la as label", "lb as other").unionByName(wide.selectExpr("label", "wider as other")), "label", "other").selectExpr("id as component", "component as wider")
    merged = near.unionByName(asked.selectExpr("doc as id", "label as component")).distinct().join(far, "component", "left").selectExpr("id as key1", "coalesce(wider, component) as component_id")
    out = found.select("key1", "n").join(merged, "key1", "left").selectExpr(f"key1 as {id_col}", "n as n_shingles", "coalesce(component_id, key1) as component_id")
    lost = rows.where("id is null").selectExpr(f"id as {id_col}", "cast(null as long) as n_shingles", "cast(null as long) as component_id")
    return out.unionByName(lost)
