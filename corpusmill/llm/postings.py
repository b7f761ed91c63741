"""Token postings of sets, dealt in packed blocks: which tokens of a set do other sets hold, and which set holds most of them.

A set (a document, a line) is a list of distinct 48-bit token hashes. Two sets of Jaccard similarity t or more share at
least ceil(t * n) tokens of either one's n, so a set with fewer tokens that any other set holds has no partner and is
done with after one pass. On text most sets end here; what goes on is the few that share nearly everything.

Pass 1 (`deal`) packs a batch's (token, set) entries into sorted 64-bit words and cuts them by token range: one row per
batch and range. Pass 2 (`match`) merges a range's rows, drops tokens of one set, and sends the rest back to their
batches, each entry with the first set of its token. Pass 3 (`gather`) counts per set its shared tokens and, by first
set, a lower bound of the overlap with it.

Bounds: a row per batch and non-empty range, at most one per token. A token that more than HOT sets of a batch hold is
known to be shared: but for its first entry its batch keeps it, so that a range gets at most HOT + 1 entries of a token
from a batch.

Sets are called equal by a digest of 128 bits: sums of two independent, finalised 64-bit hashes of each token. The 48 bits
only count overlaps of unequal sets, which need t / (1 - t) common tokens or more (`least_overlap`; three at 3/4), so one
wrong match makes no link of its own: it takes a pair that is one token short, and then has a chance of a * b / 2^48.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm.kernels import K1, K3, SLICE_BYTES, mix, ranges, release, spans, stable_order
from corpusmill.llm.shared import stored

ENTRIES, DIRECTORY, KEPT, HOTS = 0, 1, 2, 3
#: Sets of a batch: a set's number in it has 16 bits.
MOST_SETS = 60_000
HOT = 64
#: Level of tokens that some batch holds more often than HOT.
MOST_COMMON = 255
_IDX = np.uint64(0xFFFF)
_ROW = "part long, kind int, batch long, body binary"
_ROW_PA = pa.schema([("part", pa.int64()), ("kind", pa.int32()), ("batch", pa.int64()), ("body", pa.binary())])


def planes(x: np.ndarray, width: int) -> bytes:
    """Little-endian bytes of x by place: all lowest bytes, then the next. Places that are zero throughout compress to nothing."""
    return np.ascontiguousarray(np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.dtype.itemsize)[:, :width].T).tobytes()


def unplanes(body: memoryview | bytes, n: int, width: int, dtype: type) -> np.ndarray:
    out = np.zeros((n, np.dtype(dtype).itemsize), np.uint8)
    out[:, :width] = np.frombuffer(body, np.uint8, n * width).reshape(width, n).T
    return out.view(dtype).ravel()


def packed(tokens: np.ndarray, idx: np.ndarray, cuts: np.ndarray) -> list[bytes]:
    """Runs of ascending tokens with their set numbers, a run from each of `cuts` on: token steps and numbers by place, 8
    bytes an entry before compression."""
    steps = np.diff(tokens, prepend=np.uint64(0))
    steps[cuts] = tokens[cuts]
    # By place for all runs at once: a run is then eight pieces, each of them in one part of memory.
    table = np.empty((8, len(tokens)), np.uint8)
    table[:6] = steps.view(np.uint8).reshape(-1, 8).T[:6]
    table[6:] = idx.astype(np.uint16).view(np.uint8).reshape(-1, 2).T
    return [np.ascontiguousarray(table[:, x:y]).tobytes() for x, y in spans(cuts, len(tokens))]


def unpacked(bodies: list[bytes | memoryview]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens and set numbers of such runs, one after the other, and the number of entries of each."""
    count = np.array([len(x) // 8 for x in bodies], np.int64)
    table = np.concatenate([np.frombuffer(x, np.uint8).reshape(8, -1) for x in bodies] or [np.zeros((8, 0), np.uint8)], axis=1)
    steps = np.zeros((table.shape[1], 8), np.uint8)
    for place in range(6):
        steps[:, place] = table[place]
    total = np.cumsum(steps.view(np.uint64).ravel(), dtype=np.uint64)
    starts = np.cumsum(count) - count
    before = np.where(starts > 0, total[np.maximum(starts, 1) - 1] if len(total) else np.uint64(0), np.uint64(0))
    return total - np.repeat(before, count), np.ascontiguousarray(table[6:].T).view(np.uint16).ravel(), count


def batch_name(number: int, *arrays: np.ndarray) -> int:
    """A batch's name, from its own keys and its place in the input: the same whenever a task runs again."""
    import xxhash
    from pyspark import TaskContext

    task = TaskContext.get()
    h = xxhash.xxh64(f"{task.partitionId() if task else 0}:{number}".encode())
    for a in arrays:
        h.update(np.ascontiguousarray(a).view(np.uint8))
    return h.intdigest() - (1 << 63)


Sets = tuple[np.ndarray, ...]


def deal(sets: Callable[[Iterator[pa.RecordBatch]], Iterator[Sets]], parts: int, sized: bool = False) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For mapInArrow. `sets` yields (key1, key2, key3, token hashes, other hashes of the same tokens, set number of each): keys by
    set number, all int64.
    With `sized` the second key is the number of tokens that a set has in all, those not given included, and `sets` yields
    two more arrays: sets come in ascending order of these two and the first key, over all batches, and a token's first set is
    the first in that order."""

    def part_of(entries: np.ndarray) -> np.ndarray:
        return ((entries >> np.uint64(16)) * np.uint64(parts)) >> np.uint64(48) if parts < 1 << 16 else (entries >> np.uint64(32)) % np.uint64(parts)

    def one(number: int, key1: np.ndarray, key2: np.ndarray, key3: np.ndarray, tokens: np.ndarray, other: np.ndarray, owner: np.ndarray, *order: np.ndarray) -> pa.RecordBatch:
        # One plain sort of all entries. Sets that hold a token twice are few: only theirs are looked up again for the digests.
        every = (tokens & ~_IDX) | owner.astype(np.uint64)
        entries, by = np.sort(every), slice(None)
        if (again := entries[1:] == entries[:-1]).any():
            twice = np.zeros(len(key1), bool)
            twice[(entries[1:][again] & _IDX).astype(np.int64)] = True
            slow = twice[owner]
            at = np.flatnonzero(slow)
            by = np.concatenate([np.flatnonzero(~slow), at[np.unique(every[at], return_index=True)[1]]])
            entries = entries[np.concatenate([[True], ~again])]
        idx = (entries & _IDX).astype(np.int64)
        size = key2 if sized else np.bincount(idx, minlength=len(key1)).astype(np.int64)
        digests = []
        with np.errstate(over="ignore"):
            for h, seed in () if sized else ((tokens, K1), (other, K3)):
                digests.append(np.zeros(len(key1), np.uint64))
                np.add.at(digests[-1], owner[by], mix(h[by] + seed))
        digest, digest2 = digests or [np.zeros(len(key1), np.uint64)] * 2
        name = batch_name(number, key1, key2, key3)
        head = np.array([x[0] for x in (*order, key1)] if order else [name, 0, 0], np.int64).tobytes()
        tok = entries >> np.uint64(16)
        rows = [(parts + name % parts, DIRECTORY, name, np.concatenate([key1, key2, key3, size, digest.view(np.int64), digest2.view(np.int64)]).tobytes())]
        first = np.flatnonzero(np.concatenate([[True], tok[1:] != tok[:-1]])) if len(tok) else np.zeros(0, np.int64)
        count = np.diff(np.concatenate([first, [len(tok)]]))
        if (hot := count > HOT).any():
            at = ranges(first[hot], count[hot])
            lead = np.repeat(entries[first[hot]] & _IDX, count[hot]).astype(np.uint16)
            mine = entries[at]
            rows.append((parts + name % parts, KEPT, name, packed(mine >> np.uint64(16), mine & _IDX, np.zeros(1, np.int64))[0] + lead.tobytes()))
            gone = np.zeros(len(entries), bool)
            gone[at] = True
            gone[first[hot]] = False
            entries = entries[~gone]
            known = tok[first[hot]]
            where = part_of(known << np.uint64(16))
            rows += [(int(p), HOTS, name, known[where == p].tobytes()) for p in np.unique(where)]
        part = part_of(entries)
        if parts >= 1 << 16:
            order = np.argsort(part, kind="stable")
            entries, part = entries[order], part[order]
        cut = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else np.zeros(0, np.int64)
        rows += [(int(p), ENTRIES, name, head + body) for p, body in zip(part[cut], packed(entries >> np.uint64(16), entries & _IDX, cut), strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _ROW_PA.types, strict=True)], schema=_ROW_PA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        release()
        for key1, key2, key3, tokens, other, owner, *more in sets(batches):
            if len(key1) > MOST_SETS:
                order = np.argsort(owner, kind="stable")
                tokens, other, owner = tokens[order], other[order], owner[order]
            for a in range(0, len(key1), MOST_SETS):
                lo, hi = np.searchsorted(owner, [a, a + MOST_SETS]) if len(key1) > MOST_SETS else (0, len(owner))
                cut = slice(a, a + MOST_SETS)
                yield one(number, key1[cut], key2[cut], key3[cut], tokens[lo:hi], other[lo:hi], owner[lo:hi] - a, *[x[cut] for x in more])
                number += 1
        release()

    return run


def match(rows: pa.Table) -> pa.Table:
    """For applyInArrow by part: entries of tokens that two or more sets hold, by batch, each with its token's first set."""
    kinds = rows.column("kind").to_numpy()
    through = rows.filter(pa.array((kinds == DIRECTORY) | (kinds == KEPT)))
    hots = [np.frombuffer(x.as_py(), np.uint64) for x in rows.filter(pa.array(kinds == HOTS)).column("body")]
    mine = rows.filter(pa.array(kinds == ENTRIES))
    if not mine.num_rows:
        return through.cast(_ROW_PA)
    heads = np.array([np.frombuffer(x.as_py(), np.int64, 3) for x in mine.column("body")])
    mine = mine.take(pa.array(np.lexsort((mine.column("batch").to_numpy(), *heads.T[::-1]))))
    names = mine.column("batch").to_numpy()
    tok, idx, count = unpacked([memoryview(x.as_py())[24:] for x in mine.column("body")])
    row = np.repeat(np.arange(len(count)), count)
    order = stable_order(tok - tok.min()) if len(tok) else np.zeros(0, np.int64)  # ties stay in the order of batch and set
    tok = tok[order]
    same = tok[1:] == tok[:-1]
    shared = np.concatenate([[False], same]) | np.concatenate([same, [False]])
    lead = np.maximum.accumulate(np.where(np.concatenate([[True], ~same]), np.arange(len(tok)), 0))
    keep = np.flatnonzero(shared)
    lead, tok, src = order[lead[keep]], tok[keep], order[keep]
    # How many sets hold the token, as 8 * log2 in a byte; the same for all sets that hold it.
    heads = np.flatnonzero(np.concatenate([[True], tok[1:] != tok[:-1]])) if len(tok) else np.zeros(0, np.int64)
    runs = np.diff(np.concatenate([heads, [len(tok)]]))
    level = np.repeat(np.minimum(8 * np.log2(np.maximum(runs, 1)), MOST_COMMON - 1).astype(np.uint8), runs)
    if hots:
        level[np.isin(tok, np.unique(np.concatenate(hots)))] = MOST_COMMON
    at = stable_order(row[src])
    lead, tok, src, level = lead[at], tok[at], src[at], level[at]
    out_row, cuts = np.unique(row[src], return_index=True)
    bodies = []
    for (a, b), body in zip(spans(cuts, len(src)), packed(tok, idx[src], cuts), strict=True):
        lead_batch, code = np.unique(names[row[lead[a:b]]], return_inverse=True)
        bodies.append(np.int64(b - a).tobytes() + body + planes(code.astype(np.uint32), 4) + idx[lead[a:b]].astype(np.uint16).tobytes() + level[a:b].tobytes() + lead_batch.tobytes())
    back = pa.table([pa.array(names[out_row]), pa.array(np.full(len(bodies), ENTRIES, np.int32)), pa.array(names[out_row]), pa.array(bodies, pa.binary())], schema=_ROW_PA)
    return pa.concat_tables([through.cast(_ROW_PA), back])


_SETS = "batch long, idx int, key1 long, key2 long, key3 long, n long, digest long, digest2 long, tokens array<long>, lead_batch long, lead_idx int, lead_overlap long, weight float"
_SETS_PA = pa.schema([("batch", pa.int64()), ("idx", pa.int32()), ("key1", pa.int64()), ("key2", pa.int64()), ("key3", pa.int64()), ("n", pa.int64()), ("digest", pa.int64()), ("digest2", pa.int64()), ("tokens", pa.list_(pa.int64())), ("lead_batch", pa.int64()), ("lead_idx", pa.int32()), ("lead_overlap", pa.int64()), ("weight", pa.float32())])


def gather(num: int, den: int, keep_all: bool) -> Callable[[pa.Table], pa.Table]:
    """For applyInArrow by batch: its sets that share den*m >= num*n of their n tokens, with these tokens and the best first set; with keep_all also the others, with tokens null."""

    def run(rows: pa.Table) -> pa.Table:
        kinds, name = rows.column("kind").to_numpy(), rows.column("batch")[0].as_py()
        bodies = rows.column("body")
        head = np.frombuffer(bodies[int(np.flatnonzero(kinds == DIRECTORY)[0])].as_py(), np.int64)
        key1, key2, key3, size, digest, digest2 = head.reshape(6, len(head) // 6)
        # Of a token that came both ways the wider search's answer counts: it comes first.
        found = [bodies[int(i)].as_py() for i in np.flatnonzero(kinds == ENTRIES)]
        kept = [bodies[int(i)].as_py() for i in np.flatnonzero(kinds == KEPT)]
        sizes = [int.from_bytes(x[:8], "little") for x in found] + [len(x) // 10 for x in kept]
        tok, idx, _ = unpacked([x[8 : 8 + 8 * n] for x, n in zip(found, sizes, strict=False)] + [x[: 8 * n] for x, n in zip(kept, sizes[len(found) :], strict=True)])
        names, batches, leads, levels = {name: 0}, [], [], []
        for x, n in zip(found, sizes, strict=False):
            known = np.array([names.setdefault(int(b), len(names)) for b in np.frombuffer(x, np.int64, -1, 8 + 15 * n)], np.int64)
            batches.append(known[unplanes(memoryview(x)[8 + 8 * n :], n, 4, np.uint32)])
            leads.append(np.frombuffer(x, np.uint16, n, 8 + 12 * n))
            levels.append(np.frombuffer(x, np.uint8, n, 8 + 14 * n))
        for x, n in zip(kept, sizes[len(found) :], strict=True):
            batches.append(np.zeros(n, np.int64))
            leads.append(np.frombuffer(x, np.uint16, n, 8 * n))
            levels.append(np.full(n, MOST_COMMON, np.uint8))
        lead_batch, lead, level = (np.concatenate(c or [np.zeros(0, np.int64)]) for c in (batches, leads, levels))
        key = (idx.astype(np.uint64) << np.uint64(48)) | tok.astype(np.uint64)
        order = np.argsort(key)
        twice = np.flatnonzero(key[order[1:]] == key[order[:-1]])  # a token comes both ways at most
        order[twice], order[twice + 1] = np.minimum(order[twice], order[twice + 1]), np.maximum(order[twice], order[twice + 1])
        tok, idx, lead_batch, lead, level = tok[order], idx[order].astype(np.int64), lead_batch[order], lead[order], level[order]
        if len(tok):
            once = np.concatenate([[True], (tok[1:] != tok[:-1]) | (idx[1:] != idx[:-1])])
            tok, idx, lead_batch, lead, level = tok[once], idx[once], lead_batch[once], lead[once], level[once]
        shared = np.bincount(idx, minlength=len(size))
        alive = (den * shared >= num * size) & (size > 0)
        weight = np.bincount(idx, level.astype(float), minlength=len(size)) / np.maximum(size, 1)
        take = alive[idx] if len(idx) else np.zeros(0, bool)
        tok, idx, lead_batch, lead, level = tok[take], idx[take], lead_batch[take], lead[take], level[take]
        order = stable_order((idx << 8) | level)  # rarest first, then as before: by token
        tok, idx, lead_batch, lead = tok[order], idx[order], lead_batch[order], lead[order]
        # Overlap with each first set but the set itself; the best one, ties to the smaller reference.
        ref = (lead_batch.astype(np.int64) << 16) | lead.astype(np.int64)
        other = ref != idx  # names[name] is 0
        # A set's number has 16 bits, a batch's here fewer than 32.
        pair, many = np.unique((idx[other].astype(np.uint64) << np.uint64(48)) | ref[other].astype(np.uint64), return_counts=True)
        pair = np.stack([pair >> np.uint64(48), pair & np.uint64(2**48 - 1)]).astype(np.int64)
        best = np.lexsort((pair[1], -many, pair[0]))
        lead_of = np.full(len(size), -1, np.int64)
        lead_n = np.zeros(len(size), np.int64)
        if len(best):
            top = best[np.concatenate([[True], pair[0][best][1:] != pair[0][best][:-1]])]
            lead_of[pair[0][top]], lead_n[pair[0][top]] = pair[1][top], many[top]
        by_code = np.array(list(names), np.int64)
        out = np.flatnonzero(alive | keep_all)
        starts = np.zeros(len(size) + 1, np.int64)
        np.cumsum(np.bincount(idx, minlength=len(size)), out=starts[1:])
        counts = (starts[1:] - starts[:-1])[out]
        flat = tok[ranges(starts[:-1][out], counts)].astype(np.int64)
        tokens = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(flat), mask=pa.array(~alive[out]))
        has = lead_of[out] >= 0
        return pa.table(
            [
                pa.array(np.full(len(out), name)), pa.array(out.astype(np.int32)), pa.array(key1[out]), pa.array(key2[out]), pa.array(key3[out]), pa.array(size[out]), pa.array(digest[out]), pa.array(digest2[out]), tokens,
                pa.array(by_code[np.maximum(lead_of[out], 0) >> 16], mask=~has), pa.array((np.maximum(lead_of[out], 0) & 0xFFFF).astype(np.int32), mask=~has), pa.array(lead_n[out], mask=~has), pa.array(weight[out].astype(np.float32)),
            ],
            schema=_SETS_PA,
        )

    return run


def slice_bytes(spark: SparkSession) -> int:
    """Bytes of text of a batch: they grow with the number of ranges, so that a row, of which there is one for each batch and
    range, keeps many tokens; up to what a Python worker can hold."""
    return min(12 * SLICE_BYTES, max(SLICE_BYTES, 2048 * int(spark.conf.get("spark.sql.shuffle.partitions"))))


def shared_sets(docs: DataFrame, sets: Callable[[Iterator[pa.RecordBatch]], Iterator[Sets]], num: int, den: int, keep_all: bool = False, sized: bool = False) -> DataFrame:
    """Sets of `docs` of whose n tokens num/den or more are in other sets too; columns as _SETS, tokens
    from the rarest to the most common.

    Ranges: four for each of spark.sql.shuffle.partitions, so that the setting that bounds a Spark task bounds a range.
    """
    parts = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = docs.mapInArrow(deal(sets, parts, sized), _ROW)
    back = dealt.groupBy("part").applyInArrow(match, _ROW)
    return back.groupBy("batch").applyInArrow(gather(num, den, keep_all), _SETS)


def least_overlap(num: int, den: int, overlap: str = "overlap") -> str:
    """What the overlap of two unequal sets must meet, whatever their sizes: |A | B| is larger by one at least."""
    return f"{den - num} * {overlap} >= {num}"


def cross_lists(sets: DataFrame, num: int, den: int) -> DataFrame:
    """(id, label, n, s): sets of `sets` (id, label, n, tokens, weight) that hold num/den of their n tokens in common with sets
    of other labels, s listing these tokens as (df, tok, hub): their document frequency and, of the sets that hold the
    token, the heaviest. Stored."""
    each = sets.select("id", "label", "n", "weight", F.explode("tokens").alias("tok"))
    # Most tokens are those of one label: what they need is no more than its bounds, and they are gone before the others are counted.
    mixed = each.groupBy("tok").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi")
    entry = stored(each.join(mixed.selectExpr("tok + 0L as tok"), "tok"), "entries")
    freq = entry.groupBy("tok").agg(F.count("*").alias("df"), F.max(F.struct("weight", "id")).alias("hub"))
    entry = entry.select("id", "label", "n", "tok").join(freq.selectExpr("tok + 0L as tok", "df", "hub.id as hub"), "tok")
    listed = entry.groupBy("id", "label", "n").agg(F.sort_array(F.collect_list(F.struct("df", "tok", "hub"))).alias("s"))
    return stored(listed.where(f"{den} * size(s) >= {num} * n"), "listed")


def hub_links(listed: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """(label, other): labels that a link joins, by the overlaps of `cross_lists` sets with their tokens' hubs. The counts are
    lower bounds, so every link is one; a hub of many near copies is found without listing their pairs."""
    counts = listed.select("id", "label", "n", F.explode("s.hub").alias("hub")).where("hub <> id").groupBy("id", "label", "n", "hub").agg(F.count("*").alias("overlap"))
    close = counts.where(f"{den} * overlap >= {num} * n and {least_overlap(num, den)}")
    other = sets.selectExpr("id as hub", "label as other", "n as nh")
    return close.join(other, "hub").where(f"{den} * overlap >= {num} * (n + nh - overlap)").select("label", "other")


#: Entries of a posting list that one task takes at most, on the average: longer lists are cut into a grid of comparisons.
SPLIT = 512


def _keys(listed: DataFrame, num: int, den: int) -> DataFrame:
    """Keys of `listed`, one row each: prefix tokens, and of sets of which `paired` is true pairs of them. Unequal sets have two
    tokens or more in common, the first two of which are in prefixes that are one longer."""
    cols = set(listed.columns)
    extra = ["o1", "o2"] if {"o1", "o2"} <= cols else ["-id as o1", "0L as o2"]
    paired = "paired" if "paired" in cols else "false"
    pre = listed.selectExpr("id", "label", "n", *extra, "size(tokens) as c", f"{paired} as paired", f"slice(tokens, 1, greatest(0, size(tokens) - cast(ceil(n * {num} / {den}D) as int) + 1 + cast({paired} as int))) as pre")
    single = "transform(pre, (t, i) -> struct(i as at, t as tok))"
    double = "flatten(transform(pre, (t, i) -> transform(slice(pre, i + 2, greatest(0, size(pre) - i - 1)), u -> struct(i as at, xxhash64(t, u) as tok))))"
    return pre.selectExpr("id", "label", "n", "o1", "o2", "c", f"inline(case when paired then {double} else {single} end)").selectExpr("id", "label", "n", "o1", "o2", "tok", "cast(at as long) + n - c as pos")


def shared_keys(listed: DataFrame, num: int, den: int) -> DataFrame:
    """Keys of `listed` (id, label, n, tokens, maybe o1, o2 and paired) that sets of two labels or more have, one row for each
    set, with the blocks of SPLIT keys that a list takes. Most keys are of one set and make no pair. Stored."""
    keys = _keys(listed, num, den)
    counts = keys.groupBy("tok").agg(F.count("*").alias("f"), F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi")
    return stored(keys.join(counts.selectExpr("tok + 0L as tok", f"cast(ceil(f / {SPLIT}D) as int) as blocks"), "tok"), "keys")


def _postings(keys: DataFrame) -> DataFrame:
    """Keys of `shared_keys`, one row for each of their cells, with the part of the cell.

    A key's sets are cut into blocks of SPLIT, and a pair of blocks is a cell (ci, cj): a set of block m goes to each cell
    that has m on either side, and is compared with the sets of the other block there."""
    is_open = "open" if "open" in keys.columns else "true as open"
    dealt = keys.selectExpr("id", "label", "n", is_open, "o1", "o2", "tok", "pos", "blocks", "cast(pmod(xxhash64(id, 5), blocks) as int) as m")
    dealt = dealt.withColumn("j", F.explode(F.expr("sequence(0, blocks - 1)"))).selectExpr("id", "label", "n", "open", "o1", "o2", "tok", "pos", "m", "least(m, j) as ci", "greatest(m, j) as cj")
    parts = 4 * int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.withColumn("part", F.expr(f"pmod(xxhash64(tok, ci, cj), {parts}L)"))


def _verified(found: DataFrame, listed: DataFrame, num: int, den: int) -> DataFrame:
    body = listed.select("id", "label", "n", "tokens")
    both = found.join(body.selectExpr("id as a", "label as la", "n as na", "tokens as ta"), "a").join(body.selectExpr("id as b", "label as lb", "n as nb", "tokens as tb"), "b")
    return both.selectExpr("a", "b", "la", "lb", "na", "nb", "cast(size(array_intersect(ta, tb)) as long) as overlap").where(f"{den} * overlap >= {num} * (na + nb - overlap) and {least_overlap(num, den)}").select("a", "b", "la", "lb")


def prefix_pairs(listed: DataFrame, num: int, den: int, keys: DataFrame | None = None) -> DataFrame:
    """Pairs (a, b, la, lb) of `listed` (id, label, n, tokens) with unequal labels and
    den * |intersection| >= num * |union|, verified; a < b.

    `tokens` are those that sets of other labels hold too, in order of rarity, which is the same for all sets; n counts the
    others as well, which are rarer still. Sets are unequal, as sets of tokens. A set's prefix has n - ceil(num/den n) + 1 tokens, the uncommon ones first.
    Posting lists of prefix tokens are sorted by size and cut into blocks; a block is skipped for a block whose length
    filter or positional bound its sizes and positions can't meet. `listed` should be a stored table; `keys` are its
    `shared_keys`.

    If `listed` has columns o1, o2, an order (ties by id), a is the later one of a pair. If `keys` have a column open, the same for all
    keys of a set, only pairs whose later one is open are looked for. If `listed` has a column paired, sets of it meet by two common tokens; sets of unlike `paired` don't meet.
    """
    posted = _postings(shared_keys(listed, num, den) if keys is None else keys)
    found = posted.groupBy("part").applyInArrow(_candidates(num, den), "a long, b long, many long").select("a", "b").distinct()
    return _verified(found, listed, num, den)


def best_partners(listed: DataFrame, num: int, den: int, keys: DataFrame | None = None, k: int = 8) -> DataFrame:
    """As `prefix_pairs`, but of each open set only the pairs with the `k` earlier sets that seem to have most prefix tokens in
    common with it: by the sum over parts of the tokens, of which each names its own `k`."""
    posted = _postings(shared_keys(listed, num, den) if keys is None else keys)
    found = posted.groupBy("part").applyInArrow(_candidates(num, den, best=k), "a long, b long, many long")
    sums = found.groupBy("a", "b").agg(F.sum("many").alias("many"))
    top = sums.groupBy("a").agg(F.slice(F.sort_array(F.collect_list(F.struct("many", "b")), asc=False), 1, k).alias("t"))
    return _verified(top.selectExpr("a + 0L as a", "explode(t.b) as b"), listed, num, den)


#: Entries of a block of a posting list.
BLOCK = 128
#: Pairs of short lists that are looked at together, about.
PAIRS = 1 << 18


def _candidates(num: int, den: int, best: int = 0) -> Callable[[pa.Table], pa.Table]:
    """For applyInArrow by part: pairs that may reach the threshold, each with the number of its tokens here. Of two sets the
    smaller one meets the other within the shorter prefix that a partner of its size or more needs. With `best` so
    many partners of each later set."""
    out_schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("many", pa.int64())])

    def fold(pairs: list[np.ndarray]) -> np.ndarray:
        both = np.concatenate(pairs, axis=1)
        order = np.lexsort((both[1], both[0]))
        both = both[:, order]
        first = np.flatnonzero(np.concatenate([[True], (both[0, 1:] != both[0, :-1]) | (both[1, 1:] != both[1, :-1])]))
        return np.stack([both[0, first], both[1, first], np.add.reduceat(both[2], first)])

    def run(rows: pa.Table) -> pa.Table:
        tok, ids, label, n, pos, is_open, o1, o2, m, ci, cj = (rows.column(c).to_numpy() for c in ("tok", "id", "label", "n", "pos", "open", "o1", "o2", "m", "ci", "cj"))
        # The order as a number within these rows; sets that tie in it stand by id.
        by = np.lexsort((ids, o2, o1))
        step = np.concatenate([[False], (ids[by][1:] != ids[by][:-1]) | (o2[by][1:] != o2[by][:-1]) | (o1[by][1:] != o1[by][:-1])])
        place = np.empty(len(by), np.int64)
        place[by] = np.cumsum(step)
        order = np.lexsort((ids, n, cj, ci, tok))
        tok, ids, label, n, pos, is_open, place, m, ci, cj = (x[order] for x in (tok, ids, label, n, pos, is_open, place, m, ci, cj))
        near = pos <= n + (-2 * num * n) // (num + den)  # n - ceil(2t / (1 + t) n)
        cut = np.flatnonzero(np.concatenate([[True], (tok[1:] != tok[:-1]) | (ci[1:] != ci[:-1]) | (cj[1:] != cj[:-1])]))
        ends = np.append(cut[1:], len(tok))
        live = (ends - cut > 1) & (np.minimum.reduceat(label, cut) < np.maximum.reduceat(label, cut)) & np.logical_or.reduceat(is_open, cut)
        left = n - pos  # tokens of the set from here on, this one included
        pairs: list[np.ndarray] = []
        held = 0

        def add(i: np.ndarray, j: np.ndarray) -> None:
            nonlocal pairs, held
            if not len(i):
                return
            u, v = ids[i], ids[j]
            swap = place[i] < place[j]
            pairs.append(np.stack([np.where(swap, v, u), np.where(swap, u, v), np.ones(len(i), np.int64)]))
            held += len(i)
            if held > 1 << 20:
                pairs = [fold(pairs)]
                held = pairs[0].shape[1]

        # Lists of one block, of which there are most, together: each entry with those after it.
        short = live & (ends - cut <= BLOCK)
        at = ranges(cut[short], (ends - cut)[short])
        after = np.repeat(ends[short], (ends - cut)[short]) - at - 1
        use = near[at] & (after > 0)
        at, after = at[use], after[use]
        before = (np.cumsum(after) - after) // PAIRS
        for lo, hi in spans(np.flatnonzero(np.diff(before, prepend=-1)), len(at)):
            i, j = np.repeat(at[lo:hi], after[lo:hi]), ranges(at[lo:hi] + 1, after[lo:hi])
            ok = (den * n[i] >= num * n[j]) & ((num + den) * np.minimum(left[i], left[j]) >= num * (n[i] + n[j]))
            i, j = i[ok], j[ok]
            ok = (label[i] != label[j]) & ((ci[i] == cj[i]) | (m[i] != m[j])) & np.where(place[i] > place[j], is_open[i], is_open[j])
            add(i[ok], j[ok])
        for lo, hi in zip(cut[live & ~short], ends[live & ~short], strict=True):
            for a in range(lo, hi, BLOCK):
                a2 = min(a + BLOCK, hi)
                if not near[a:a2].any():
                    continue
                for b in range(a, hi, BLOCK):
                    b2 = min(b + BLOCK, hi)
                    # Length: sizes rise, so all later blocks fail too. Position: o >= t / (1 + t) * (na + nb) at least.
                    if den * n[a2 - 1] < num * n[b]:
                        break
                    if (num + den) * min(left[a:a2].max(), left[b:b2].max()) < num * (n[a] + n[b]):
                        continue
                    x, y = slice(a, a2), slice(b, b2)
                    ok = near[x][:, None] & (label[x][:, None] != label[y][None, :]) & (den * n[x][:, None] >= num * n[y][None, :])
                    ok &= (num + den) * np.minimum(left[x][:, None], left[y][None, :]) >= num * (n[x][:, None] + n[y][None, :])
                    if ci[lo] != cj[lo]:
                        ok &= m[x][:, None] != m[y][None, :]
                    second = place[x][:, None] > place[y][None, :]
                    ok &= np.where(second, is_open[x][:, None], is_open[y][None, :])
                    i, j = np.nonzero(ok)
                    if a == b:
                        i, j = i[i < j], j[i < j]
                    add(a + i, b + j)
        if not pairs:
            return out_schema.empty_table()
        u = fold(pairs)
        if best:
            u = u[:, np.lexsort((u[1], -u[2], u[0]))]
            first = np.maximum.accumulate(np.where(np.concatenate([[True], u[0, 1:] != u[0, :-1]]), np.arange(u.shape[1]), 0))
            u = u[:, np.arange(u.shape[1]) - first < best]
        return pa.table([pa.array(c) for c in u], schema=out_schema)

    return run
