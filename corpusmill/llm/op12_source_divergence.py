"""Source divergence audit: how far the terms of each source lie from those of its language and of its other sources."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.kernels import lower_ascii, release, slices, utf8
from corpusmill.llm.shared import stored

#: Parts into which probability 1 is cut.
SCALE = 1_000_000_000
#: Documents of a language that a term is in at least.
LEAST_DOCS = 3
#: Counts below this have a bucket each; above it there are eight to a doubling.
FINE = 32
#: Bytes of text whose terms are counted together, and pairs of sources that a task compares at once.
COUNT_BYTES, PAIRS = 8 << 20, 1 << 20


def term_arrays(batch: pa.RecordBatch) -> tuple[np.ndarray, pa.DictionaryArray]:
    """The row of each term in `text` and the terms: runs of ASCII letters, lower-cased, and of anything beyond ASCII."""
    buf, off = utf8(batch.column("text"))
    buf = lower_ascii(buf)
    inside = ((buf >= 97) & (buf <= 122)) | (buf >= 128)
    edge = np.zeros(len(buf) + 1, bool)
    edge[:-1] = inside
    first, last = edge.copy(), np.zeros(len(buf) + 1, bool)
    first[1:] &= ~edge[:-1]
    last[1:] = edge[:-1] & ~edge[1:]
    # A text that ends inside a run is followed by one that starts a run of its own.
    cuts = off[:-1][(off[:-1] < off[1:]) & (off[:-1] > 0)]
    both = cuts[edge[cuts] & edge[cuts - 1]]
    first[both] = True
    last[both] = True
    starts, ends = np.flatnonzero(first), np.flatnonzero(last)
    at = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
    terms = pa.StringArray.from_buffers(len(starts), pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(buf[inside])))
    return np.searchsorted(off, starts, side="right") - 1, pc.dictionary_encode(terms)


def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs) by slice: occurrences, and documents that have the term. Each group also has a row of null
    term."""
    for batch in slices(batches, limit=COUNT_BYTES):
        lang, source = (pc.dictionary_encode(batch.column(c)) for c in ("lang", "source"))
        both = lang.indices.to_numpy().astype(np.int64) * max(1, len(source.dictionary)) + source.indices.to_numpy()
        _, first_row, of_row = np.unique(both, return_index=True, return_inverse=True)
        row, terms = term_arrays(batch)
        size = max(1, len(terms.dictionary))
        # One entry for each document and term, then one for each group and term.
        pair, n = np.unique(row * size + terms.indices.to_numpy(), return_counts=True)
        key = of_row[pair // size] * size + pair % size
        order = np.argsort(key, kind="stable")
        cut = np.flatnonzero(np.diff(key[order], prepend=-1))
        key, docs = key[order][cut], np.diff(np.append(cut, len(order)))
        n = np.add.reduceat(n[order], cut) if len(cut) else np.zeros(0, np.int64)
        at = pa.array(np.concatenate([first_row[key // size], first_row]))
        none = len(first_row)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("lang").take(at),
                batch.column("source").take(at),
                pa.concat_arrays([terms.dictionary.take(pa.array(key % size)), pa.nulls(none, pa.string())]),
                pa.array(np.concatenate([n, np.zeros(none, np.int64)])),
                pa.array(np.concatenate([docs, np.zeros(none, np.int64)])),
            ],
            names=["lang", "source", "term", "n", "docs"],
        )
    release()


def share(count: str, total: str) -> str:
    """p = 1 + floor(SCALE * (count + 1) / total), exact for counts of any size; null where total is 0."""
    return f"1 + (cast({SCALE} as decimal(20,0)) * (cast({count} as decimal(18,0)) + 1)) div nullif(cast({total} as decimal(18,0)), 0)"


def gain(p: str, q: str) -> str:
    """f = floor((p - q)^2 / q): below 2^63, as p and q are at most SCALE + 1."""
    return f"(({p}) - ({q})) * (({p}) - ({q})) div ({q})"


def pair_gains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, item, value): over the terms of a posting list, what each ordered pair of its sources adds to the sum
    that both would have if the other lacked the term. Sums are kept by task and given out when there are many."""
    held: dict[tuple[str, str, str], int] = {}

    def out() -> pa.RecordBatch:
        keys = list(held)
        columns = [pa.array([k[i] for k in keys], pa.string()) for i in range(3)]
        return pa.RecordBatch.from_arrays([*columns, pa.array(list(held.values()), pa.int64())], names=["lang", "source", "item", "value"])

    for batch in batches:
        lang = pc.dictionary_encode(batch.column("lang"))
        posts = batch.column("posts")
        flat = posts.flatten()
        source = pc.dictionary_encode(flat.field("source"))
        p, p0 = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("p", "p0"))
        code = source.indices.to_numpy().astype(np.int64)
        size = np.diff(posts.offsets.to_numpy()).astype(np.int64)
        start = np.cumsum(size) - size
        names, langs, width = source.dictionary.to_pylist(), lang.dictionary.to_pylist(), max(1, len(source.dictionary))
        by_lang = lang.indices.to_numpy().astype(np.int64)
        # Rows of one length together, so many that their pairs are PAIRS; a longer list by blocks of its own sources.
        for s in np.unique(size[size > 1]):
            rows = np.flatnonzero(size == s)
            step = max(1, PAIRS // int(s * s))
            block = int(min(s, max(1, PAIRS // s)))
            for at in range(0, len(rows), step):
                entry = start[rows[at : at + step], None] + np.arange(s)
                for x in range(0, int(s), block):
                    i, j = entry[:, x : x + block, None], entry[:, None, :]
                    pi, qi, pj, qj = p[i], p0[i], p[j], p0[j]
                    value = (pi - pj) ** 2 // pj - (pi - qj) ** 2 // qj - (qi - pj) ** 2 // pj + (qi - qj) ** 2 // qj
                    key = (by_lang[rows[at : at + step], None, None] * width + code[i]) * width + code[j]
                    key, value = key.ravel(), value.ravel()
                    order = np.argsort(key, kind="stable")
                    key = key[order]
                    cut = np.flatnonzero(np.diff(key, prepend=-1))
                    sums = np.add.reduceat(value[order], cut)
                    for k, v in zip(key[cut].tolist(), sums.tolist(), strict=True):
                        a, b = k // width % width, k % width
                        if a != b:
                            name = (langs[k // width // width], names[a], names[b])
                            held[name] = held.get(name, 0) + v
                    if len(held) > PAIRS:
                        yield out()
                        held.clear()
    if held:
        yield out()


def best_terms(kept: DataFrame, top: int) -> DataFrame:
    """(lang, source, term, value, rank) of the `top` terms of each group by value, then by term, of those with p > q.

    Terms of a group lie in buckets by their count. The largest count and the smallest share in the language bound what any
    term of a bucket can reach. Buckets are read in the order of their bounds, more with each round, until those unread
    are bounded strictly below the last term that is in: terms that tie with it have all been read.
    """
    # The bound of a bucket without p > q anywhere is below 0.
    bound = f"case when max(p) > min(q) then {gain('max(p)', 'min(q)')} else -1 end"
    buckets = stored(kept.groupBy("lang", "source", "bucket").agg(F.count("*").alias("terms"), F.expr(bound).alias("bound")).where("bound >= 0"), "buckets")
    group = ["lang", "source"]
    order = "partition by lang, source order by bound desc, bucket"
    queue = stored(buckets.selectExpr("*", f"sum(terms) over ({order}) - terms as before"), "queue")
    best, done, reach = None, None, top
    while True:
        if best is None:
            ask = queue.where(f"before < {reach}")
        else:
            last = best.where(f"rank = {top}").selectExpr(*group, "value as least")
            left = queue.join(done, [*group, "bucket"], "left_anti").join(last, group, "left").where("least is null or bound >= least").drop("least")
            ask = left.where(f"before < {reach}")
            if ask.isEmpty():
                if left.isEmpty():
                    return best
                # Only buckets beyond the reach can still matter: go to the first of them.
                reach = max(reach, left.agg(F.min("before")).first()[0] + 1)
                ask = left.where(f"before < {reach}")
        ask = stored(ask.select(*group, "bucket"), "asked")
        read = kept.join(ask, [*group, "bucket"], "left_semi").where("p > q").selectExpr(*group, "term", f"{gain('p', 'q')} as value")
        both = read if best is None else read.unionByName(best.drop("rank"))
        best = stored(both.selectExpr("*", "row_number() over (partition by lang, source order by value desc, term) as rank").where(f"rank <= {top}"), "best")
        done = ask if done is None else done.union(ask)
        reach *= 4


def divergence(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", top: int = 200, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(lang, source, part, item, value, rank): part `term` has, for each source of a language, the `top` terms by which it
    exceeds its language; part `pair` how far it lies from each other source of the language.

    Terms are runs of letters and of characters beyond ASCII, lower-cased in A-Z; a language keeps those that are in
    `least_docs` of its rows. With N occurrences of kept terms in a group and V kept terms, a term of n occurrences has
    p = 1 + floor(SCALE * (n + 1) / (N + V)), and against q weighs f = floor((p - q)^2 / q). `pair` sums f over all kept
    terms, those that neither source has included; a language that keeps none has 0. `term` lists terms that the source has,
    with p > q of the language. Ranks count from 1 by value descending, then by item as UTF-8 bytes ascending. All exact.

    Sums of pairs come from histograms of each source's counts, as if no two sources shared a term, and from postings,
    which set right the terms that they do share.

    Null text, language and source count as ''. Rows that repeat count as that many documents. A source without terms has
    its pairs. Very long texts are whole; an empty table gives no rows; columns of other names are ignored.
    """
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    part = rows.mapInArrow(count_terms, "lang string, source string, term string, n long, docs long")
    counts = stored(part.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "counts")
    entry = F.struct("source", "n")
    posts = counts.where("term is not null").groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"), F.collect_list(entry).alias("posts"))
    posts = stored(posts.where(f"docs >= {least_docs}").drop("docs"), "posts")
    flat = posts.selectExpr("lang", "term", "lang_n", "inline(posts)")
    by_source = flat.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("own"))
    by_lang = posts.groupBy("lang").agg(F.sum("lang_n").alias("lang_total"), F.count("*").alias("v"))
    # A row for each group that occurs; p0 is the share of a term that it lacks.
    groups = counts.where("term is null").select("lang", "source").join(by_source, ["lang", "source"], "left").join(by_lang, "lang", "left")
    groups = groups.selectExpr("lang", "source", "coalesce(total, 0L) as total", "coalesce(own, 0L) as own", "coalesce(lang_total, 0L) as lang_total", "coalesce(v, 0L) as v")
    groups = stored(groups.selectExpr("*", f"{share('0L', 'total + v')} as p0"), "groups")

    bucket = f"case when n < {FINE} then cast(n as int) else {FINE} + cast(floor(8 * log2(n / {FINE}.0D)) as int) end as bucket"
    shares = [f"{share('n', 'total + v')} as p", f"{share('lang_n', 'lang_total + v')} as q"]
    # Keys as new expressions: adaptive execution can then split a source that has a third of all entries.
    kept = flat.selectExpr("lang", "concat(source, '') as source", "term", "lang_n", "n").join(groups, ["lang", "source"])
    kept = stored(kept.selectExpr("lang", "source", "term", "n", "p0", *shares, bucket), "kept")
    terms = best_terms(kept, top).selectExpr("lang", "source", "'term' as part", "term as item", "value", "cast(rank as int) as rank")

    lists = kept.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "p", "p0")).alias("posts")).where("size(posts) > 1").select("lang", "posts")
    shared = lists.mapInArrow(pair_gains, "lang string, source string, item string, value long").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    histogram = kept.groupBy("lang", "source", "p").agg(F.count("*").alias("terms")).groupBy("lang", "source").agg(F.collect_list(F.struct("p", "terms")).alias("bars"))
    sides = stored(groups.join(histogram, ["lang", "source"], "left").selectExpr("lang", "source", "own", "v", "p0", "coalesce(bars, array()) as bars"), "sides")
    one = sides.selectExpr("lang", "source", "own as own_a", "v", "p0 as p0_a", "bars as bars_a")
    two = sides.selectExpr("lang", "source as item", "own as own_b", "p0 as p0_b", "bars as bars_b")
    alone = f"aggregate(bars_a, 0L, (s, x) -> s + x.terms * ({gain('x.p', 'p0_b')})) + aggregate(bars_b, 0L, (s, x) -> s + x.terms * ({gain('p0_a', 'x.p')}))"
    sums = one.join(two, "lang").where("source <> item").selectExpr("lang", "source", "item", f"coalesce({alone} + (v - own_a - own_b) * ({gain('p0_a', 'p0_b')}), 0L) as alone")
    value = sums.join(shared, ["lang", "source", "item"], "left").selectExpr("lang", "source", "item", "alone + coalesce(value, 0L) as value")
    pairs = value.selectExpr("lang", "source", "'pair' as part", "item", "value", "cast(row_number() over (partition by lang, source order by value desc, item) as int) as rank")
    return terms.unionByName(pairs)
