"""An interpolated Kneser-Ney n-gram model of words, and the perplexity of texts under it."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.arrays import once
from corpusmill.functions.text import word_list
from corpusmill.operators.packed import packed, ranges, runs, unpacked
from corpusmill.sources.scratch import dealt_by, written

START, END = "<s>", "</s>"
#: Words that two bytes name, bounded for being sent to all tasks; tokens packed together; tokens of a part on the average.
COMMON, BATCH, PART = 65_535, 2_000_000, 2_000_000
#: Words of a batch that are counted as candidates for COMMON occur so often in it.
SEEN = 4


@dataclass(frozen=True)
class NgramModel:
    """For each order, from the highest to 1: (context, word, share), and (context, rest), what is left for the next lower one.
    `words` is the vocabulary's size, the end of a text included; one more, for all other words, shares the last rest."""

    order: int
    words: int
    shares: list[DataFrame]
    rests: list[DataFrame]


def _grams(texts: DataFrame, keep: list[str], text_col: str, order: int, tokens: Callable[[Column], Column]) -> DataFrame:
    """(keep, context, word): each word of a text and its end, with the order - 1 words before it, starts before the first."""
    body = F.concat(F.array_repeat(F.lit(START), order - 1), tokens(F.coalesce(F.col(text_col), F.lit(""))), F.array(F.lit(END)))
    split = texts.select(*keep, once(body).alias("__t"))
    gram = lambda i: F.struct(F.array_join(F.slice("__t", i, order - 1), " ").alias("context"), F.get("__t", i + order - 2).alias("word"))
    return split.select(*keep, F.explode(F.transform(F.sequence(F.lit(1), F.size("__t") - (order - 1)), gram)).alias("g")).select(*keep, "g.context", "g.word")


def _shorter(context: str) -> Column:
    """A context without its first word."""
    return F.when(F.instr(context, " ") > 0, F.expr(f"substring({context}, instr({context}, ' ') + 1)")).otherwise(F.lit(""))


def fit_ngrams(texts: DataFrame, text_col: str, order: int = 3, discount: float = 0.75, tokens: Callable[[Column], Column] = word_list) -> NgramModel:
    """The model of all texts (Kneser and Ney, 1995; Chen and Goodman, 1999): the highest order counts its n-grams, each lower one
    the different words before an n-gram of its length. A count gives up `discount`, which goes to the next lower order.

    Counts are taken by groups with map-side sums; no table of the model goes through the driver. The probabilities of all
    words, and of one more for those not seen, add up to one in every context. Null texts count as empty.
    """
    counts = written(_grams(texts, [], text_col, order, tokens).groupBy("context", "word").agg(F.count("*").alias("n")), "ngrams")
    shares, rests = [], []
    words = counts.select("word").distinct().count()
    for k in range(order, 0, -1):
        totals = counts.groupBy("context").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
        one = counts.join(totals.selectExpr("concat(context, '') as context", "total"), "context")
        shares.append(written(one.select("context", "word", (F.greatest(F.col("n") - discount, F.lit(0.0)) / F.col("total")).alias("share")), "shares"))
        rests.append(written(totals.select("context", (discount * F.col("kinds") / F.col("total")).alias("rest")), "rests"))
        if k > 1:
            counts = written(counts.select(_shorter("context").alias("context"), "word").groupBy("context", "word").agg(F.count("*").alias("n")), "ngrams")
    return NgramModel(order, words, shares, rests)


def gram_probabilities(model: NgramModel, grams: DataFrame) -> DataFrame:
    """(context, word, p) of distinct (context, word): shares of each order, times what the higher ones left. A context that was
    not seen leaves all to the next lower order."""
    at = grams.select("context", "word").distinct().withColumns({"c": F.col("context"), "p": F.lit(0.0), "left": F.lit(1.0)})
    for k in range(model.order):
        share, rest = model.shares[k].selectExpr("context as c", "word", "share"), model.rests[k].selectExpr("context as c", "rest")
        step = at.join(share, ["c", "word"], "left").join(rest, "c", "left")
        p = F.col("p") + F.col("left") * F.coalesce("share", F.lit(0.0))
        at = step.select(_shorter("c").alias("c"), "context", "word", p.alias("p"), (F.col("left") * F.coalesce("rest", F.lit(1.0))).alias("left"))
    return at.select("context", "word", (F.col("p") + F.col("left") / (model.words + 1)).alias("p"))


def text_nll(model: NgramModel, texts: DataFrame, keep: list[str], text_col: str, tokens: Callable[[Column], Column] = word_list) -> DataFrame:
    """(keep, n_words, nll) of texts, seen or not: negative log probability, the end of the text included. `keep` names a text;
    rows that repeat it are added up. Null texts count as empty, and have their end alone; an empty table gives no rows."""
    # Made twice from the texts, which is less than to store them.
    grams = _grams(dealt_by(texts.select(*keep, text_col), *keep), keep, text_col, model.order, tokens).groupBy(*keep, "context", "word").agg(F.count("*").alias("m"))
    p = gram_probabilities(model, _grams(texts, [], text_col, model.order, tokens))
    by_text = grams.join(p.selectExpr("concat(context, '') as context", "word", "p"), ["context", "word"])
    return by_text.groupBy(*keep).agg(F.sum("m").alias("n_words"), F.sum(-F.log("p") * F.col("m")).alias("nll"))


def _named(words: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two bytes a word, its place in `common` from 1 on, or 0 and the word in the second array."""
    if not len(common):
        return np.zeros(len(words), np.uint16), words
    at = np.minimum(np.searchsorted(common, words), len(common) - 1)
    code = np.where(common[at] == words, at + 1, 0).astype(np.uint16)
    return code, words[code == 0]


def _words(code: np.ndarray, others: np.ndarray, common: np.ndarray) -> np.ndarray:
    out = np.concatenate([np.zeros(1, np.uint64), common])[code]
    out[code == 0] = others
    return out


def fitted_nll(texts: DataFrame, keep: list[str], text_col: str, fitted: Column, order: int = 3, discount: float = 0.75, tokens: Callable[[Column], Column] = word_list) -> DataFrame:
    """(keep, n_words, nll) of all texts under the model of those for which `fitted` is true: the same as text_nll of fit_ngrams,
    for an order of two or more, without a table of the model.

    The context of each order but the lowest ends in the word before the last one: grams that are dealt by it have all counts
    of these orders in one part. Each token is dealt once, as a few packed bytes: words are 64-bit hashes, of which the COMMON
    most frequent ones are named by two bytes. Only the lowest order's counts cross parts, once for a part and word, and
    each text gets a sum from each part: both packed, the sums by the batch that the text came in. The positions after one word lie in one part, whatever their number."""
    if order < 2:
        raise ValueError("an order of two or more")
    key = F.xxhash64(F.to_json(F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)]), {"ignoreNullFields": "false"}))
    body = F.concat(F.array_repeat(F.lit(START), order - 1), tokens(F.coalesce(F.col(text_col), F.lit(""))), F.array(F.lit(END)))
    hashed = texts.select(key.alias("text"), F.coalesce(fitted, F.lit(False)).alias("fitted"), F.transform(body, lambda w: F.xxhash64(w)).alias("words"))
    seen, batch_tokens, others = SEEN, BATCH, [k for k in range(order) if k != 1]

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column("words").flatten().to_numpy(zero_copy_only=False)
            word, n = np.unique(flat, return_counts=True)
            often = n >= seen
            yield pa.RecordBatch.from_arrays([pa.array([None, *word[often].tolist()], pa.int64()), pa.array(np.concatenate([[len(flat)], n[often]]), pa.int64())], names=["word", "n"])

    # The most frequent words only make the bytes few: which ones they are has no bearing on the result.
    counted = hashed.select("words").mapInArrow(frequent, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.col("word").isNotNull(), F.desc("n"), "word").limit(COMMON + 1).toArrow()
    total = counted.column("n")[0].as_py() if counted.num_rows else 0
    common = np.sort(counted.column("word").slice(1).to_numpy().astype(np.int64).view(np.uint64))[:COMMON]
    parts = max(1, -(-total // PART))

    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
    schema = "part long, batch long, size long, body binary"

    def rows_of(rows: list[tuple]) -> pa.Table:
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows), kinds, strict=True)] if rows else [pa.array([], t) for t in kinds], names=["part", "batch", "size", "body"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            ends = np.cumsum(np.diff(batch.column("words").offsets.to_numpy()).astype(np.int64))
            group = np.maximum.accumulate(np.maximum((ends - 1) // batch_tokens, np.arange(len(ends)) // 60_000))
            for a, b in runs(group):
                some = batch.slice(a, b - a)
                flat = some.column("words").flatten().to_numpy(zero_copy_only=False).view(np.uint64)
                size = np.diff(some.column("words").offsets.to_numpy()).astype(np.int64)
                place = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
                at = np.flatnonzero(place >= order - 1)
                owner = np.repeat(np.arange(len(size)), size)[at]
                by = np.lexsort((flat[at], flat[at - 1]))
                at, owner = at[by], owner[by].astype(np.uint16)
                last = flat[at - 1]
                words = [_named(flat[at - k], common)[0] for k in others]
                fits = some.column("fitted").to_numpy(zero_copy_only=False).astype(np.uint8)[owner]
                rows = [(-1 - number, number, *packed([some.column("text").to_numpy().view(np.uint64)]))]
                for x, y in runs(part := ranges(last, parts)):
                    planes = [last[x:y], owner[x:y], fits[x:y]]
                    for k, code in zip(others, words, strict=True):
                        planes += [code[x:y], flat[at[x:y] - k][code[x:y] == 0]]
                    rows.append((int(part[x]), number, *packed(planes)))
                number += 1
                yield from rows_of(rows).to_batches()

    def opened(table: pa.Table) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], list[np.ndarray]]:
        """Of all positions of a part: how many each batch has, the text's number in the batch, whether it is fitted, and the codes of
        the words, the last one and those before it, by distance; the words by code."""
        n, text, fits, words = [], [], [], [[] for _ in range(order)]
        for body, size in zip(table.column("body").to_pylist(), table.column("size").to_pylist(), strict=True):
            last, at, fit, *rest = unpacked(body, size, [np.uint64, np.uint16, np.uint8, *[np.uint16, np.uint64] * (order - 1)])
            n.append(len(at))
            text.append(at)
            fits.append(fit.astype(bool))
            words[1].append(last)
            for i, k in enumerate(others):
                words[k].append(_words(rest[2 * i], rest[2 * i + 1], common))
        coded = [np.unique(np.concatenate(w), return_inverse=True) for w in words]
        return np.array(n), np.concatenate(text), np.concatenate(fits), [c for _, c in coded], [w for w, _ in coded]

    def followed(table: pa.Table) -> pa.Table:
        """The words of a part by range, each with the number of different words before it in fitted texts."""
        me = table.column("part")[0].as_py()
        if me < 0:
            return rows_of([])
        _, _, fits, code, words = opened(table)
        pair = np.unique(code[1][fits] * len(words[0]) + code[0][fits])
        n = np.bincount(pair % len(words[0]), minlength=len(words[0]))
        at = ranges(words[0], parts)
        return rows_of([(int(at[x]), me, *packed([np.diff(words[0][x:y], prepend=np.uint64(0)), n[x:y]])) for x, y in runs(at)])

    def added(table: pa.Table) -> pa.Table:
        """What the parts of a range sent, with sums over all parts in the place of their own; first, for no part, the sum of all words
        and the number of those that have one."""
        sent = [unpacked(body, size, [np.uint64, np.int64]) for body, size in zip(table.column("body").to_pylist(), table.column("size").to_pylist(), strict=True)]
        sent = [(np.cumsum(steps, dtype=np.uint64), n) for steps, n in sent]
        word, code = np.unique(np.concatenate([w for w, _ in sent]), return_inverse=True)
        total = np.zeros(len(word), np.int64)
        np.add.at(total, code, np.concatenate([n for _, n in sent]))
        edges = np.cumsum([len(w) for w, _ in sent])
        answers = [(part, table.column("part")[0].as_py(), *packed([total[c]])) for part, c in zip(table.column("batch").to_pylist(), np.split(code, edges[:-1]), strict=True)]
        return rows_of([(None, int(total.sum()), int((total > 0).sum()), b""), *answers])

    def scored(table: pa.Table, lowest: pa.Table) -> pa.Table:
        if not table.num_rows or table.column("part")[0].as_py() < 0:
            # What texts a batch has: goes on as it is.
            return table.select(["part", "batch", "size", "body"])
        per_batch, text, fits, code, words = opened(table)
        # The lowest order: a word's share, and what is left to all words alike.
        lowest = lowest.sort_by("range")
        n1 = np.concatenate([unpacked(body, size, [np.int64])[0] for body, size in zip(lowest.column("body").to_pylist(), lowest.column("size").to_pylist(), strict=True)])
        total, kinds = lowest.column("total")[0].as_py(), lowest.column("kinds")[0].as_py()
        base = np.maximum(n1 - discount, 0.0) / max(total, 1) + (discount * kinds / total if total else 1.0) / (kinds + 1)
        # Grams and contexts of each order from two on, as numbers; of a gram, that of the next lower order and its context.
        context, gram = code[1], code[1] * len(words[0]) + code[0]
        shorter, within = [], []
        for k in range(2, order + 1):
            if k > 2:
                context, gram = context * len(words[k - 1]) + code[k - 1], gram * len(words[k - 1]) + code[k - 1]
            context = np.unique(context, return_inverse=True)[1]
            _, first, grams = np.unique(gram, return_index=True, return_inverse=True)
            shorter.append(code[0][first] if k == 2 else gram_before[first])
            within.append(context[first])
            gram = gram_before = grams
        counts = [np.bincount(gram[fits], minlength=len(shorter[-1]))]
        for below in shorter[:0:-1]:
            counts.append(np.bincount(below[counts[-1] > 0], minlength=below.max() + 1))
        p = base
        for n, below, inside in zip(counts[::-1], shorter, within, strict=True):
            total, kinds = np.bincount(inside, n), np.bincount(inside, n > 0)
            got = np.maximum(total, 1)[inside]
            p = np.maximum(n - discount, 0.0) / got + np.where(total[inside] > 0, discount * kinds[inside] / got, 1.0) * p[below]
        rows, nll, end = [], -np.log(p)[gram], np.cumsum(per_batch)
        for batch, x, y in zip(table.column("batch").to_pylist(), end - per_batch, end, strict=True):
            m, sums = np.bincount(text[x:y]), np.bincount(text[x:y], nll[x:y])
            rows.append((0, batch, *packed([m.astype(np.uint32), sums[m > 0]])))
        return rows_of(rows)

    def summed(table: pa.Table) -> pa.Table:
        """The sums of a batch's texts, all parts together."""
        bodies = list(zip(table.column("part").to_pylist(), table.column("size").to_pylist(), table.column("body").to_pylist(), strict=True))
        names = next(unpacked(body, size, [np.uint64])[0] for part, size, body in bodies if part < 0)
        n, nll = np.zeros(len(names), np.int64), np.zeros(len(names))
        for m, sums in (unpacked(body, size, [np.uint32, np.float64]) for part, size, body in bodies if part >= 0):
            n[: len(m)] += m
            nll[np.flatnonzero(m)] += sums
        return pa.table([pa.array(names.view(np.int64)), pa.array(n), pa.array(nll)], names=["text", "n", "nll"])

    # One query: the exchange of the pieces is made once and read for both steps, as is that of the words.
    pieces = hashed.mapInArrow(deal, schema)
    by_range = pieces.groupBy("part").applyInArrow(followed, schema).groupBy("part").applyInArrow(added, schema)
    sums = by_range.where("part is null").agg(F.coalesce(F.sum("batch"), F.lit(0)).alias("total"), F.coalesce(F.sum("size"), F.lit(0)).alias("kinds"))
    lowest = by_range.where("part is not null").select(F.col("part").alias("at"), F.col("batch").alias("range"), "size", "body").crossJoin(F.broadcast(sums))
    sent = pieces.groupBy("part").cogroup(lowest.groupBy("at")).applyInArrow(scored, schema)
    by_text = sent.groupBy("batch").applyInArrow(summed, "text long, n long, nll double").groupBy("text").agg(F.sum("n").alias("n_words"), F.sum("nll").alias("nll"))
    names = texts.select(*keep, key.alias("text")).distinct()
    return names.join(by_text, "text").select(*keep, "n_words", "nll")


def perplexity(n_words: Column, nll: Column) -> Column:
    return F.exp(nll / n_words)
