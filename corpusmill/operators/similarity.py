"""TF-IDF retrieval, deduplication, hard negatives."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.operators.packed import packed, runs, unpacked
from corpusmill.operators.terms import read_batch, term_batches
from corpusmill.sources.scratch import dealt_by, written


def tf_idf(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, term, weight, df): terms of two or more word characters, lower case, smooth idf ln((1 + n) / (1 + df)) + 1, rows of
    length one; df, how many documents have the term."""
    terms = F.regexp_extract_all(F.lower(F.col(text_col)), F.lit("(?U)(\\b\\w\\w+\\b)"), F.lit(1))
    tf = dealt_by(docs.select(id_col, text_col), id_col).select(id_col, F.explode(terms).alias("term")).groupBy(id_col, "term").agg(F.count("*").alias("tf"))
    df = tf.groupBy("term").agg(F.count("*").alias("df"))
    n = docs.agg(F.count("*").alias("n"))
    raw = tf.join(df, "term").crossJoin(F.broadcast(n)).withColumn("w", F.col("tf") * (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1))
    length = raw.groupBy(id_col).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("len"))
    return raw.join(length, id_col).select(id_col, "term", (F.col("w") / F.col("len")).alias("weight"), "df")


def retrieve(queries: DataFrame, docs: DataFrame, query_id: str, doc_id: str, text_col: str, k: int = 5, digits: int = 9) -> DataFrame:
    """(query, doc, sim, rank): the k documents of highest cosine for each query, ties by the smaller id; the idf is that of
    the documents, queries weighed by it. Similarities are compared to `digits` digits, which is where sums in another
    order may differ. Documents without a common term don't appear.

    Documents are split into words once. Queries are a stated set and small beside the documents: their terms with weights
    are joined to the documents' words, so that only words that some query has go on; of each query a task keeps the k best
    of its own documents, and these alone are shuffled to the query."""
    terms = F.regexp_extract_all(F.lower(F.col(text_col)), F.lit("(?U)(\\b\\w\\w+\\b)"), F.lit(1))
    tf = dealt_by(docs.select(doc_id, text_col), doc_id).select(doc_id, F.explode(terms).alias("term")).groupBy(doc_id, "term").agg(F.count("*").alias("tf"))
    df = tf.groupBy("term").agg(F.count("*").alias("df"))
    n = docs.agg(F.count("*").alias("n"))
    idf = df.join(n, how="cross").select("term", (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1).alias("idf"))
    raw = tf.join(idf, "term").withColumn("w", F.col("tf") * F.col("idf"))
    # A document's length needs all of its words, its dot products only those that queries have.
    qtf = queries.select(query_id, F.explode(terms).alias("term")).groupBy(query_id, "term").agg(F.count("*").alias("tf"))
    qw = qtf.join(idf, "term").withColumn("w", F.col("tf") * F.col("idf"))
    qlen = qw.groupBy(query_id).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("len"))
    asked = qw.join(qlen, query_id).groupBy("term").agg(F.collect_list(F.struct(F.col(query_id).alias("q"), (F.col("w") / F.col("len")).alias("x"))).alias("asked"))
    per_doc = raw.join(asked, "term", "left").groupBy(doc_id).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("len"), F.collect_list(F.when(F.col("asked").isNotNull(), F.struct("w", "asked"))).alias("hits"))
    each = per_doc.where(F.size("hits") > 0).select(doc_id, "len", F.explode("hits").alias("h")).select(doc_id, "len", F.col("h.w").alias("w"), F.explode("h.asked").alias("a"))
    sims = each.groupBy(doc_id, F.col("a.q").alias(query_id)).agg(F.round(F.sum(F.col("w") / F.col("len") * F.col("a.x")), digits).alias("sim"))
    order = Window.partitionBy(query_id).orderBy(F.col("sim").desc(), F.col(doc_id))
    return sims.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def drop_exact(df: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of each value, by `order`."""
    first = df.groupBy(key).agg(F.min(order).alias(order))
    return df.join(first.select(order), order, "left_semi")


#: Links that one task decides; more go in rounds.
LINKS = 1_000_000


def _gone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The ids that a pass in order drops, of all links at once."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    links = pa.Table.from_batches(held).sort_by([("b", "ascending"), ("a", "ascending")])
    gone = set()
    for a, b in zip(links.column("a").to_pylist(), links.column("b").to_pylist(), strict=True):
        if a not in gone:
            gone.add(b)
    yield pa.RecordBatch.from_arrays([pa.array(sorted(gone), links.schema.field("b").type)], names=["id"])


def greedy_keep(pairs: DataFrame, ids: DataFrame, id_col: str, links: int = LINKS) -> DataFrame:
    """Ids that a pass in order keeps: one goes if a kept earlier one is paired with it. `pairs` is (a, b), a < b.

    Pairs are made once. In a round, ids that no undecided earlier one is paired with stay, and their neighbours go; only
    pairs among undecided ids go on to the next round, and each round settles at least the first id of every chain. When at
    most `links` pairs are left, one task, bounded by that number, passes over them."""
    known = ids.select(F.col(id_col).alias("a")).distinct()
    edges = written(pairs.select("a", "b").distinct().join(known, "a", "left_semi"), "links")
    kind = dict(edges.dtypes)["b"]
    parts = []
    while (left := edges.count()) > links:
        first = edges.select("a").distinct().join(edges.selectExpr("b as a").distinct(), "a", "left_anti")
        parts.append(written(edges.join(first, "a", "left_semi").select(F.col("b").alias("id")).distinct(), "gone"))
        edges = written(edges.join(parts[-1].selectExpr("id as a"), "a", "left_anti").join(parts[-1].selectExpr("id as b"), "b", "left_anti").select("a", "b"), "links")
    if left:
        parts.append(edges.coalesce(1).mapInArrow(_gone, f"id {kind}"))
    kept = ids.select(F.col(id_col))
    for part in parts:
        kept = kept.join(part.select(F.col("id").alias(id_col)), id_col, "left_anti")
    return kept


#: Slots of the table that marks texts by hash: a megabyte, which every task gets.
SLOTS = 1 << 23
#: Parts of one that bounds of weights are rounded up to.
FINE = 60_000


def _marked(ids: DataFrame) -> np.ndarray:
    """Of SLOTS slots, whether one of the ids (column x) has its hash there: a table of fixed size. Others may share a slot."""
    slot = F.pmod(F.xxhash64("x"), F.lit(SLOTS)).alias("s")
    bits = ids.select(slot).selectExpr("s div 64 as at", "shiftleft(1L, int(s % 64)) as bit").groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()
    held = np.zeros(SLOTS // 64, np.int64)
    held[bits.column("at").to_numpy()] = bits.column("bits").to_numpy()
    return np.unpackbits(held.view(np.uint8), bitorder="little").astype(bool)


def cosine_pairs(docs: DataFrame, id_col: str, text_col: str, threshold: float = 0.92) -> DataFrame:
    """(a, b, sim) with a < b and cosine of TF-IDF rows >= threshold.

    A document's terms are put in order of rarity, which is the same for all; its prefix ends where what is left is shorter
    than the threshold. Two documents that have no term of both prefixes in common have all that they share in the rest of
    one of them, and can't reach the threshold: so they meet by rare terms only. Where they meet first, what their weights
    there and the lengths of what follows can still make bounds the cosine (Anastasiu and Karypis, 2014); a meeting that
    is bounded below the threshold gives no candidate. Documents of equal term counts are compared once, by the one of
    smallest id. Candidates are verified in groups by their smallest neighbours, so that a document's terms go to a group
    once, however many partners it has there."""
    batches_of = term_batches(docs, id_col, text_col).withColumn("slots", F.transform("ids", lambda x: F.pmod(F.xxhash64(x), F.lit(SLOTS))))
    n, kind = docs.count(), dict(docs.dtypes)[id_col]

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import blake2b

        for batch in batches:
            for ids, size, body in zip(batch.column("ids"), batch.column("size").to_pylist(), batch.column("body").to_pylist(), strict=True):
                ids, terms, _, text, code, tf = read_batch(ids.values, size, body)
                entry = np.column_stack([terms[code], tf.astype(np.uint64)])
                ends = np.searchsorted(text, np.arange(len(ids) + 1))
                some = np.flatnonzero(np.diff(ends))
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(some)), pa.array([blake2b(entry[ends[i] : ends[i + 1]].tobytes(), digest_size=16).digest() for i in some], pa.binary())], names=["x", "d"])

    # Texts of equal counts, where there are several: each with the one that stands for it, itself included.
    digest = batches_of.mapInArrow(digests, f"x {kind}, d binary").where("x is not null")
    same = digest.groupBy("d").agg(F.min("x").alias("rep"), F.count("*").alias("n")).where("n > 1").select(F.col("d").alias("e"), "rep")
    copies = written(digest.join(same, F.col("d") == F.col("e")).select("x", "rep"), "copies")
    dropped = copies.where("x <> rep").select("x")

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((ids.values, size, body) for batch in batches for ids, size, body in zip(batch.column("ids"), batch.column("size").to_pylist(), batch.column("body").to_pylist(), strict=True))
        for ids, terms, df, text, code, tf in (read_batch(*row) for row in rows):
            w = tf * (np.log((1 + n) / (1 + df)) + 1)[code]
            w /= np.sqrt(np.bincount(text, w * w, len(ids)))[text]
            by = np.lexsort((terms[code], df[code], text))
            text, code, w = text[by], code[by], w[by]
            start = np.searchsorted(text, text)
            total = np.concatenate([[0.0], np.cumsum(w * w)])
            before = total[:-1] - total[start]
            keep = 1 - before >= threshold * threshold - 1e-9
            rest = np.sqrt(np.maximum(1 - before - w * w, 0.0))
            # What a text has behind its prefix: the least of the rests there.
            end = np.full(len(ids), np.inf)
            np.minimum.at(end, text[keep], rest[keep])
            # A term of one text meets none.
            keep &= df[code] > 1
            text, code = text[keep], code[keep]
            size, body = packed([text.astype(np.uint32), terms[code], *[np.ceil(x * FINE).astype(np.uint16) for x in (w[keep], np.sqrt(np.maximum(before[keep], 0.0)), rest[keep])], np.ceil(np.where(np.isfinite(end), end, 0.0) * FINE).astype(np.uint16)])
            yield pa.RecordBatch.from_arrays([pa.array([ids.to_pylist()], pa.list_(ids.type)), pa.array([size], pa.int64()), pa.array([body], pa.binary())], names=["ids", "size", "body"])

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Candidates of two batches. A slice of the texts of one meets all texts of the other, HELD meetings at a time on the average."""
        for batch in batches:
            for row in range(batch.num_rows):
                (text, t, w, past, rest, ahead), (text2, t2, w2, past2, rest2, ahead2) = (
                    [x if x.dtype.itemsize != 2 else x.astype(np.float32) / np.float32(FINE) for x in unpacked(batch.column(f"body{s}")[row].as_py(), batch.column(f"size{s}")[row].as_py(), [np.uint32, np.uint64, np.uint16, np.uint16, np.uint16, np.uint16])] for s in "ab"
                )
                ids, ids2 = batch.column("idsa")[row].values, batch.column("idsb")[row].values
                by = np.argsort(t2, kind="stable")
                t2, text2, w2, past2, rest2 = t2[by], text2[by], w2[by], past2[by], rest2[by]
                low = np.searchsorted(t2, t, "left")
                count = np.searchsorted(t2, t, "right") - low
                until = np.cumsum(count)
                # Slices end with a text.
                closes = np.flatnonzero(np.diff(text.astype(np.int64), append=-1) != 0)
                group = until[closes] // HELD if len(closes) else closes
                for x, y in runs(group):
                    first = closes[x - 1] + 1 if x else 0
                    some = slice(first, closes[y - 1] + 1)
                    n = count[some]
                    one = np.repeat(np.arange(some.start, some.stop), n)
                    two = np.arange(len(one)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low[some], n)
                    fits = past[one] * past2[two] + w[one] * w2[two] + rest[one] * rest2[two] >= least
                    if batch.column("a")[row].as_py() == batch.column("b")[row].as_py():
                        fits &= text[one] < text2[two]
                    one, two = one[fits], two[fits]
                    key = text[one].astype(np.int64) * len(ids2) + text2[two]
                    order = np.argsort(key, kind="stable")
                    key, one, two = key[order], one[order], two[order]
                    starts = np.flatnonzero(np.diff(key, prepend=-1))
                    if not len(starts):
                        continue
                    shared = np.add.reduceat(w[one].astype(np.float64) * w2[two], starts)
                    final = np.append(starts[1:], len(key)) - 1
                    i, j = one[final], two[final]
                    near = shared + np.maximum(ahead[text[i]] * rest2[j], ahead2[text2[j]] * rest[i]) >= least
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(text[i][near])), ids2.take(pa.array(text2[j][near]))], names=["x", "y"])

    # A meeting parts what two texts share into what is before, the term, and what is behind; each part has a bound. Past the last
    # meeting one of two has no more than what follows its prefix. Bounds are rounded up to FINE parts. Batches meet two by two
    # as they are stored: meetings are neither shuffled nor kept.
    least = threshold - 3 / FINE
    prefix = written(batches_of.mapInArrow(prefixes, f"ids array<{kind}>, size long, body binary").withColumn("at", F.xxhash64("body", "ids")), "prefixes")
    side = lambda s: prefix.select(F.col("at").alias(s), *[F.col(c).alias(f"{c}{s}") for c in ("ids", "size", "body")])
    seen = side("a").crossJoin(side("b")).where("a <= b").mapInArrow(met, f"x {kind}, y {kind}").where("x <> y")
    ordered = seen.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    cand = written(ordered.join(dropped.selectExpr("x as a"), "a", "left_anti").join(dropped.selectExpr("x as b"), "b", "left_anti").select("a", "b"), "candidates")
    # Only the terms of texts of some candidate are shuffled, and those of few others.
    wanted = _marked(cand.select(F.explode(F.array("a", "b")).alias("x")))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, size, body, slots in zip(batch.column("ids"), batch.column("size").to_pylist(), batch.column("body").to_pylist(), batch.column("slots"), strict=True):
                ids, terms, df, text, code, tf = read_batch(ids.values, size, body)
                some = np.flatnonzero(wanted[np.asarray(slots.values)])
                ends = np.searchsorted(text, np.arange(len(ids) + 1))
                rows = [packed([np.diff(terms[at], prepend=np.uint64(0)), df[at], tf[x:y]]) for x, y in zip(ends[some], ends[some + 1], strict=True) for at in (code[x:y],)]
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(some)), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], names=["x", "size", "body"])

    # Texts that resemble each other have one smallest neighbour, for the most part: pairs are grouped by those of their two texts.
    label = cand.select("a", "b").unionByName(cand.selectExpr("b as a", "a as b")).groupBy("a").agg(F.min(F.least("a", "b")).alias("label"))
    grouped = cand.join(label.selectExpr("a", "label as la"), "a").join(label.selectExpr("a as b", "label as lb"), "b")
    grouped = written(grouped.select("a", "b", F.xxhash64("la", "lb").alias("cell")), "grouped")
    body = batches_of.mapInArrow(vectors, f"x {kind}, size long, body binary")
    sent = grouped.select("cell", F.explode(F.array("a", "b")).alias("x")).distinct().join(body, "x").select(F.col("cell").alias("at"), "x", "size", "body")

    def verified(pairs: pa.Table, texts: pa.Table) -> pa.Table:
        ids, term, weight = texts.column("x").combine_chunks(), [], []
        for body, size in zip(texts.column("body").to_pylist(), texts.column("size").to_pylist(), strict=True):
            steps, df, tf = unpacked(body, size, [np.uint64, np.int64, np.uint32])
            w = tf * (np.log((1 + n) / (1 + df)) + 1)
            term.append(np.cumsum(steps, dtype=np.uint64))
            weight.append(w / np.sqrt((w * w).sum()))
        one, two = (pc.index_in(pairs.column(c).combine_chunks(), ids).to_numpy() for c in "ab")
        sims = np.zeros(len(one))
        # A text meets its partners one after the other: what it has is looked up in their terms.
        by = np.argsort(one, kind="stable")
        for x, y in runs(one[by].astype(np.int64)):
            t, w = term[one[by[x]]], weight[one[by[x]]]
            for i in by[x:y]:
                other = term[two[i]]
                at = np.minimum(np.searchsorted(t, other), len(t) - 1)
                sims[i] = (w[at] * weight[two[i]])[t[at] == other].sum()
        keep = pa.array(np.flatnonzero(sims >= threshold))
        return pa.table([pairs.column("a").take(keep), pairs.column("b").take(keep), pa.array(sims).take(keep)], names=["a", "b", "sim"])

    found = grouped.groupBy("cell").cogroup(sent.groupBy("at")).applyInArrow(verified, f"a {kind}, b {kind}, sim double")
    # Copies have what the text has that stands for them, and each other.
    stand = lambda r, x: copies.select(F.col("rep").alias(r), F.col("x").alias(x))
    spread = found.join(stand("a", "xa"), "a", "left").join(stand("b", "xb"), "b", "left").select(F.coalesce("xa", "a").alias("a"), F.coalesce("xb", "b").alias("b"), "sim")
    within = stand("r", "a").join(stand("r", "b"), "r").where("a < b").select("a", "b", F.lit(1.0).alias("sim"))
    return spread.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "sim").unionByName(within if threshold <= 1 else within.limit(0))


def ratio(a: Column, b: Column) -> Column:
    """Ratcliff-Obershelp similarity of two texts, lower case and stripped."""

    @F.pandas_udf("double")
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        from difflib import SequenceMatcher

        return pd.Series([SequenceMatcher(None, (p or "").lower().strip(), (q or "").lower().strip()).ratio() for p, q in zip(x, y, strict=True)], dtype="float64")

    return run(a, b)


def fuzzy_pairs(df: DataFrame, id_col: str, text_col: str, threshold: float = 0.85, block: Column | None = None) -> DataFrame:
    """(a, b) with a < b whose texts' ratio reaches the threshold; with `block` only pairs of equal blocks.

    The matching blocks of two texts are a common part of their multisets of characters, so 2 * |A & B| / (|A| + |B|) over
    multisets bounds the ratio from above. Characters, each numbered by its occurrence, are ordered by rarity; a pair that
    can reach the threshold shares one in the prefixes that this leaves, and is of fitting lengths. Candidates are counted
    exactly, and only those within the bound are compared by sequence."""
    base = df.select(F.col(id_col).alias("i"), F.lower(F.trim(text_col)).alias("t"), F.col(text_col).alias("raw"), (block if block is not None else F.lit(0)).alias("k")).where("t <> ''").withColumn("n", F.length("t"))
    chars = base.select("i", "k", "n", F.explode(F.split("t", "")).alias("c")).where("c <> ''").groupBy("i", "k", "n", "c").agg(F.count("*").alias("m"))
    marks = chars.select("i", "k", "n", F.explode(F.sequence(F.lit(1), F.col("m").cast("int"))).alias("o"), "c").select("i", "k", "n", F.concat("c", F.col("o").cast("string")).alias("g"))
    rare = marks.groupBy("k", "g").agg(F.count("*").alias("f"))
    ordered = marks.join(rare, ["k", "g"]).groupBy("i", "k", "n").agg(F.transform(F.array_sort(F.collect_list(F.struct("f", "g"))), lambda x: x["g"]).alias("s"))
    # Overlap of at least threshold * (n + m) / 2, with the smallest partner that fits: m >= n * threshold / (2 - threshold).
    need = F.ceil(F.col("n") * threshold / (2 - threshold) - 1e-9)
    prefix = ordered.select("i", "k", "n", F.explode(F.slice("s", F.lit(1), F.greatest(F.lit(1), (F.size("s") - need + 1).cast("int")))).alias("g"))
    other = prefix.select(F.col("i").alias("j"), "k", F.col("n").alias("m"), "g")
    fits = (F.col("i") < F.col("j")) & (F.least("n", "m") * 2 >= threshold * (F.col("n") + F.col("m")) - 1e-9)
    met = prefix.join(other, ["k", "g"]).where(fits).select("i", "j").distinct()
    sides = lambda at, s: ordered.select(F.col("i").alias(at), F.col("s").alias(s))
    close = met.join(sides("i", "sa"), "i").join(sides("j", "sb"), "j").where(2 * F.size(F.array_intersect("sa", "sb")) >= threshold * (F.size("sa") + F.size("sb")) - 1e-9).select("i", "j")
    texts = lambda at, t: base.select(F.col("i").alias(at), F.col("raw").alias(t))
    both = close.join(texts("i", "ta"), "i").join(texts("j", "tb"), "j")
    return both.where(ratio(F.col("ta"), F.col("tb")) >= threshold).select(F.col("i").alias("a"), F.col("j").alias("b"))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


#: Anchors that one pass over the corpus compares: the bound of what is broadcast. Similarities that a task holds at once.
ANCHORS, HELD = 4096, 1 << 20


def _unit_rows(batch: pa.RecordBatch, vector: str) -> tuple[np.ndarray, np.ndarray]:
    """Places and unit vectors of the rows whose vector has a direction; vectors are of one length."""
    lists = batch.column(vector)
    size = np.asarray(pc.fill_null(pc.list_value_length(lists), 0))
    at = np.flatnonzero(size > 0)
    if not len(at):
        return at, np.zeros((0, 0))
    v = np.asarray(lists.take(pa.array(at)).flatten(), np.float64).reshape(len(at), -1)
    norm = np.linalg.norm(v, axis=1)
    fine = np.isfinite(norm) & (norm > 0)
    return at[fine], v[fine] / norm[fine, None]


def hard_negatives(anchors: DataFrame, corpus: DataFrame, id_col: str, vector: str, label: str, n: int = 3, skip: int = 0, least: float = -1.0, most: float = 1.0, margin: float = 0.0, digits: int = 9) -> DataFrame:
    """(anchor, negative, sim, rank): the `n` most similar vectors of other labels after the first `skip`, of those with a
    similarity from `least` to `most`, and with a `margin` only those that are less similar than the anchor's best vector of
    its own label by as much or more. Similarities count to `digits` digits, ties go to the smaller id. Vectors that are null,
    empty, zero or not finite, and null labels, take no part.

    A stated set of anchors against the whole corpus, in blocks of ANCHORS on the average: a block is a matrix that all tasks
    get, bounded by that number. A task multiplies its rows with it, HELD similarities at a time, and keeps the best of each
    anchor, which alone are shuffled."""
    blocks = max(1, -(-anchors.count() // ANCHORS))
    scale = 10.0**digits
    rounded = lambda x: np.floor(np.abs(x) * scale + 0.5) / scale * np.sign(x)
    names = ["anchor", "negative", "sim"]
    kinds = f"anchor {dict(anchors.dtypes)[id_col]}, negative {dict(corpus.dtypes)[id_col]}, sim double"
    out = None
    for block in range(blocks):
        mine = anchors.where(F.pmod(F.xxhash64(id_col), F.lit(blocks)) == block).where(F.col(label).isNotNull()).select(id_col, vector, label).toArrow().combine_chunks()
        batch = mine.to_batches()[0] if mine.num_rows else None
        if batch is None:
            continue
        at, a = _unit_rows(batch, vector)
        ids, labels = batch.column(id_col).take(pa.array(at)), batch.column(label).take(pa.array(at)).to_numpy(zero_copy_only=False)
        keys = ids.to_numpy(zero_copy_only=False)

        def compared(batches: Iterator[pa.RecordBatch], a=a, keys=keys, labels=labels, held=HELD) -> Iterator[tuple]:
            for rows in batches:
                at, v = _unit_rows(rows, vector)
                if not len(at):
                    continue
                other, kind = (rows.column(c).take(pa.array(at)).to_numpy(zero_copy_only=False) for c in (id_col, label))
                step = max(1, held // max(1, len(keys)))
                for s in (slice(i, i + step) for i in range(0, len(at), step)):
                    yield rounded(a @ v[s].T), (keys[:, None] != other[None, s]), (labels[:, None] == kind[None, s]), other[s]

        def own_best(batches: Iterator[pa.RecordBatch], compared=compared, n_anchors=len(keys)) -> Iterator[pa.RecordBatch]:
            best = np.full(n_anchors, -np.inf)
            for sims, unlike, same, _ in compared(batches):
                best = np.maximum(best, np.where(unlike & same, sims, -np.inf).max(axis=1, initial=-np.inf))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(n_anchors)), pa.array(best)], names=["at", "best"])

        rows = corpus.where(F.col(label).isNotNull()).select(id_col, vector, label)
        limit = np.full(len(keys), most)
        if margin > 0:
            best = rows.mapInArrow(own_best, "at long, best double").groupBy("at").agg(F.max("best").alias("best")).toArrow()
            own = np.full(len(keys), -np.inf)
            own[best.column("at").to_numpy()] = best.column("best").to_numpy()
            limit = np.where(np.isfinite(own), np.minimum(limit, own - margin), limit)

        def nearest(batches: Iterator[pa.RecordBatch], compared=compared, keys=keys, ids=ids, limit=limit) -> Iterator[pa.RecordBatch]:
            held = None
            for sims, unlike, same, other in compared(batches):
                ok = unlike & ~same & (sims >= least) & (sims <= limit[:, None])
                sims = np.where(ok, sims, -np.inf)
                k = min(n + skip, sims.shape[1])
                kth = np.partition(sims, -k, axis=1)[:, -k]
                i, j = np.nonzero(ok & (sims >= kth[:, None]))
                new = (i, sims[i, j], other[j])
                held = new if held is None else tuple(np.concatenate(x) for x in zip(held, new, strict=True))
                order = np.lexsort((held[2], -held[1], held[0]))
                held = tuple(x[order] for x in held)
                first = np.searchsorted(held[0], held[0])
                keep = np.arange(len(first)) - first < n + skip
                held = tuple(x[keep] for x in held)
            if held is not None:
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(held[0])), pa.array(held[2]), pa.array(held[1])], names=names)

        w = Window.partitionBy("anchor").orderBy(F.col("sim").desc(), "negative")
        part = rows.mapInArrow(nearest, kinds).withColumn("rank", F.row_number().over(w)).where((F.col("rank") > skip) & (F.col("rank") <= skip + n))
        out = part if out is None else out.unionByName(part)
    return out if out is not None else anchors.sparkSession.createDataFrame([], kinds + ", rank int")


def triplet_accuracy(triplets: DataFrame, anchor: str, positive: str, negative: str) -> DataFrame:
    hit = cosine(F.col(anchor), F.col(positive)) > cosine(F.col(anchor), F.col(negative))
    return triplets.agg(F.avg(hit.cast("int")).alias("accuracy"), F.count("*").alias("n"))


def rouge_l(pred: Column, ref: Column) -> Column:
    """F-measure of the longest common subsequence of lower-case alphanumeric tokens, found a row of its table at a time: bits
    stand for the places of one text, of which those that are 0 in the end are matched (Hyyrö, 2004)."""

    @F.pandas_udf("double")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        import re

        word = re.compile(r"[a-z0-9]+")
        for x, y in batches:
            out = []
            for p, r in zip(x, y, strict=True):
                a, b = word.findall((p or "").lower()), word.findall((r or "").lower())
                places: dict[str, int] = {}
                for j, t in enumerate(b):
                    places[t] = places.get(t, 0) | 1 << j
                every = (1 << len(b)) - 1
                open_bits = every
                for s in a:
                    hit = open_bits & places.get(s, 0)
                    open_bits = ((open_bits + hit) | (open_bits - hit)) & every
                m = len(b) - open_bits.bit_count()
                out.append(2 * m / (len(a) + len(b)) if a and b and m else 0.0)
            yield pd.Series(out, dtype="float64")

    return run(pred, ref)


def sari(source: Column, pred: Column, ref: Column) -> Column:
    """SARI (Xu et al., 2016) for one reference, 0 to 100: n-grams to 4 kept, added and deleted."""

    @F.pandas_udf("double")
    def run(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        from collections import Counter

        def f1(p: float, r: float) -> float:
            return 2 * p * r / (p + r) if p + r else 0.0

        for xs, ys, zs in batches:
            out = []
            for x, y, z in zip(xs, ys, zs, strict=True):
                parts = [(t or "").lower().split() for t in (x, y, z)]
                total = 0.0
                for n in range(1, 5):
                    s, c, r = (Counter(tuple(t[i : i + n]) for i in range(len(t) - n + 1)) for t in parts)
                    keep, keep_good, keep_all = s & c, s & c & r, s & r
                    gone, gone_good = s - c, (s - c) - r
                    add, add_good, add_all = set(c) - set(s), (set(c) & set(r)) - set(s), set(r) - set(s)
                    kp = sum(keep_good[g] / keep[g] for g in keep_good) / len(keep) if keep else 1.0
                    kr = sum(keep_good[g] / keep_all[g] for g in keep_good) / len(keep_all) if keep_all else 1.0
                    dp = sum(gone_good[g] / gone[g] for g in gone_good) / len(gone) if gone else 1.0
                    ap = len(add_good) / len(add) if add else 1.0
                    ar = len(add_good) / len(add_all) if add_all else 1.0
                    total += (f1(kp, kr) + dp + f1(ap, ar)) / 3
                out.append(100 * total / 4)
            yield pd.Series(out, dtype="float64")

    return run(source, pred, ref)
