"""Exact dedup: composable polynomial fingerprints name groups of equal texts, and a chunkwise streaming comparison confirms them."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.kernels import ranges, release, slices, utf8
from corpusmill.llm.shared import stored

#: Modulus of the fingerprints, a Mersenne prime. A row of CELL bytes times powers below it, summed, stays below 2^53.
PRIME = (1 << 31) - 1
CELL = 1024
#: Bytes of normalised text in a chunk that is compared, and bytes from which a text is hashed in pieces by several tasks.
CHUNK, HUGE = 1 << 16, 8 << 20
#: Copies of one text that one comparison takes, and the most groups that get more than one comparison.
COPIES, MOST_HOT = 256, 100_000
#: Bits of the map of repeated fingerprints: its size doesn't grow with the data.
MAP_BITS = 1 << 26


@dataclass(frozen=True)
class Base:
    """Four numbers that make up a fingerprint of 124 bits; texts that meet by chance meet again under others only by chance."""

    numbers: tuple[int, int, int, int]

    @staticmethod
    def of_round(r: int) -> Base:
        return Base(tuple(int(x) for x in np.random.default_rng(7919 + r).integers(1 << 20, PRIME, 4)))


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n - 1) by doubling."""
    out = np.ones(1, np.uint64)
    while len(out) < n:
        step = np.uint64(pow(base, len(out), PRIME))
        out = np.concatenate([out, out * step % np.uint64(PRIME)])
    return out[:n]


def polynomials(buf: np.ndarray, off: np.ndarray, base: Base) -> np.ndarray:
    """(texts, 4): sum of byte * base^(bytes after it) of each text, the texts cut at `off`.

    Texts are cut into cells of CELL bytes, the first one short and padded in front, where zeros weigh nothing. One matrix
    product hashes all cells; a text's cells are then combined, each shifted by the cells after it.
    """
    size = np.diff(off)
    cells = -(-size // CELL)
    owner = np.repeat(np.arange(len(size)), cells)
    first = np.cumsum(cells) - cells
    after = (first + cells)[owner] - 1 - np.arange(len(owner))
    end = off[1:][owner] - after * CELL
    start = np.maximum(end - CELL, off[:-1][owner])
    out = np.zeros((len(size), 4), np.uint64)
    if not len(owner):
        return out
    weights = np.stack([powers(b, CELL)[::-1] for b in base.numbers], axis=1).astype(np.float64)
    hashes = np.empty((len(owner), 4), np.uint64)
    for at in range(0, len(owner), 4096):
        part = slice(at, at + 4096)
        width = end[part] - start[part]
        table = np.zeros((len(width), CELL), np.float64)
        table.ravel()[ranges(np.arange(len(width)) * CELL + CELL - width, width)] = buf[ranges(start[part], width)]
        hashes[part] = (table @ weights).astype(np.uint64) % np.uint64(PRIME)
    most = int(after.max()) + 1
    shift = np.stack([powers(pow(b, CELL, PRIME), most) for b in base.numbers], axis=1)
    shifted = hashes * shift[after] % np.uint64(PRIME)
    used = np.flatnonzero(cells)
    out[used] = np.add.reduceat(shifted, first[used], axis=0) % np.uint64(PRIME)
    return out


def combined(left: tuple[np.ndarray, int], right: tuple[np.ndarray, int], base: Base) -> tuple[np.ndarray, int]:
    """The fingerprint and length of two pieces put together, from those of each."""
    shift = np.array([pow(b, right[1], PRIME) for b in base.numbers], np.uint64)
    return (left[0] * shift + right[0]) % np.uint64(PRIME), left[1] + right[1]


def packed(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Four numbers of 31 bits as two of 62."""
    return tuple(((h[:, i] << np.uint64(31)) | h[:, i + 1]).astype(np.int64) for i in (0, 2))


def normalised(buf: np.ndarray, off: np.ndarray, blank_before: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets after each run of `[\\x20\\x09-\\x0D]` in a text has become one space. `blank_before`: the first text
    goes on after a piece that ended with such a run."""
    blank = (buf == 32) | ((buf >= 9) & (buf <= 13))
    keep = np.ones(len(buf), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    starts = off[:-1][off[:-1] < off[1:]]
    keep[starts] = True
    if blank_before and len(buf) and blank[0]:
        keep[0] = False
    at = np.concatenate([[0], np.cumsum(keep)])
    return np.where(blank, np.uint8(32), buf)[keep], at[off]


def pieces(raw: pa.Buffer | memoryview, step: int = HUGE) -> Iterator[np.ndarray]:
    """The normalised bytes of one long text, some at a time."""
    data, blank = np.frombuffer(raw, np.uint8), False
    for at in range(0, len(data), step):
        part = data[at : at + step]
        out, _ = normalised(part, np.array([0, len(part)]), blank)
        blank = bool(part[-1] == 32 or 9 <= part[-1] <= 13)
        if len(out):
            yield out


def split_long(batches: Iterator[pa.RecordBatch], huge: int) -> Iterator[tuple[pa.RecordBatch, bool]]:
    """Slices of texts below `huge` bytes, and rows of one text each of the others."""
    for batch in slices(batches):
        long = pc.fill_null(pc.greater_equal(pc.binary_length(batch.column("text")), huge), False)
        if not pc.any(long).as_py():
            yield batch, False
            continue
        short = batch.filter(pc.invert(long))
        if short.num_rows:
            yield short, False
        for i in np.flatnonzero(long.to_numpy(zero_copy_only=False)):
            yield batch.slice(int(i), 1), True


_HASHED = "rid long, id long, f1 long, f2 long, size long, sha string, no int, piece binary"
_HASHED_PA = pa.schema([("rid", pa.int64()), ("id", pa.int64()), ("f1", pa.int64()), ("f2", pa.int64()), ("size", pa.int64()), ("sha", pa.string()), ("no", pa.int32()), ("piece", pa.binary())])


def hashed(base: Base, huge: int, sha: bool):
    """A row with the fingerprint of each short text. Of a huge text: its pieces, to be hashed by other tasks, numbered from 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, long in split_long(batches, huge):
            rid, ids = batch.column("rid"), batch.column("id")
            if long:
                whole, size, n = hashlib.sha256(), 0, 0
                for n, part in enumerate(pieces(batch.column("text")[0].as_buffer(), huge), 1):
                    whole.update(part)
                    size += len(part)
                    yield pa.RecordBatch.from_arrays([rid, ids, *[pa.nulls(1, pa.int64())] * 3, pa.nulls(1, pa.string()), pa.array([n - 1], pa.int32()), pa.array([part.tobytes()], pa.binary())], schema=_HASHED_PA)
                # The last row has what only the text as a whole has.
                yield pa.RecordBatch.from_arrays([rid, ids, *[pa.nulls(1, pa.int64())] * 2, pa.array([size]), pa.array([whole.hexdigest()]), pa.array([n], pa.int32()), pa.nulls(1, pa.binary())], schema=_HASHED_PA)
                continue
            buf, off = normalised(*utf8(batch.column("text")))
            f1, f2 = packed(polynomials(buf, off, base))
            data, cut = buf.tobytes(), off.tolist()
            digest = pa.array([hashlib.sha256(data[a:b]).hexdigest() for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.string()) if sha else pa.nulls(len(rid), pa.string())
            yield pa.RecordBatch.from_arrays([rid, ids, pa.array(f1), pa.array(f2), pa.array(np.diff(off)), digest, pa.nulls(len(rid), pa.int32()), pa.nulls(len(rid), pa.binary())], schema=_HASHED_PA)
        release()

    return run


def hash_pieces(base: Base):
    """Pieces give way to their fingerprints, as 16 bytes, and their sizes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "piece"):
            body = pc.fill_null(batch.column("piece"), b"")
            _, offsets, data = body.buffers()
            off = np.frombuffer(offsets, np.int32, len(body) + 1 + body.offset)[body.offset :].astype(np.int64)
            buf = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if off[-1] > off[0] else np.zeros(0, np.uint8)
            h = polynomials(buf, off - off[0], base)
            has = np.asarray(batch.column("piece").is_valid())
            f1, f2 = (pa.array(x, mask=~has) for x in packed(h))
            size = pc.if_else(batch.column("piece").is_valid(), pa.array(np.diff(off)), batch.column("size"))
            yield pa.RecordBatch.from_arrays([batch.column("rid"), batch.column("id"), f1, f2, size, batch.column("sha"), batch.column("no")], names=["rid", "id", "f1", "f2", "size", "sha", "no"])

    return run


def combine_pieces(base: Base):
    """One row of each huge text, from the list of its pieces in order; the last entry has the whole's size and digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mask = (1 << 31) - 1
        for batch in batches:
            out = []
            for rid, id_, parts in zip(batch.column("rid").to_pylist(), batch.column("id").to_pylist(), batch.column("parts").to_pylist(), strict=True):
                whole = (np.zeros(4, np.uint64), 0)
                for p in parts[:-1]:
                    piece = np.array([p["f1"] >> 31, p["f1"] & mask, p["f2"] >> 31, p["f2"] & mask], np.uint64)
                    whole = combined(whole, (piece, p["size"]), base)
                f1, f2 = packed(whole[0][None])
                out.append({"rid": rid, "id": id_, "f1": int(f1[0]), "f2": int(f2[0]), "size": parts[-1]["size"], "sha": parts[-1]["sha"]})
            yield pa.RecordBatch.from_pylist(out, pa.schema([f for f in _HASHED_PA if f.name in ("rid", "id", "f1", "f2", "size", "sha")]))

    return run


def fingerprints(rows: DataFrame, base: Base, huge: int = HUGE, sha: bool = True) -> DataFrame:
    """(rid, id, f1, f2, size, sha) of each row (rid, id, text) of `rows`: fingerprint, bytes and SHA-256 of its normalised text.
    Texts of `huge` bytes and more go to other tasks piece by piece, whose hashes are combined."""
    first = stored(rows.mapInArrow(hashed(base, huge, sha), _HASHED), "hashed")
    short = first.where("no is null").drop("no", "piece")
    long = first.where("no is not null")
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    done = long.repartition(tasks, "rid", "no").mapInArrow(hash_pieces(base), "rid long, id long, f1 long, f2 long, size long, sha string, no int")
    parts = done.groupBy("rid", "id").agg(F.array_sort(F.collect_list(F.struct("no", "f1", "f2", "size", "sha"))).alias("parts"))
    return short.unionByName(parts.mapInArrow(combine_pieces(base), "rid long, id long, f1 long, f2 long, size long, sha string"))

_KEY = ["f1", "f2", "size", "no"]


def prints(batch: pa.RecordBatch, long: bool, base: Base, huge: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """f1, f2 and size of the texts of a batch; of a long text piece by piece."""
    if not long:
        buf, off = normalised(*utf8(batch.column("text")))
        return *packed(polynomials(buf, off, base)), np.diff(off)
    whole = (np.zeros(4, np.uint64), 0)
    for part in pieces(batch.column("text")[0].as_buffer(), huge):
        whole = combined(whole, (polynomials(part, np.array([0, len(part)]), base)[0], len(part)), base)
    return *packed(whole[0][None]), np.array([whole[1]])


def chunks(base: Base, huge: int, bitmap: np.ndarray):
    """(f1, f2, size, no, deal, piece): chunks of the texts whose fingerprint is marked in `bitmap`."""
    names = ["f1", "f2", "size", "no", "deal", "piece"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, long in split_long(batches, huge):
            f1, f2, size = prints(batch, long, base, huge)
            deal = batch.column("deal").to_numpy()
            use = np.flatnonzero(marked(bitmap, f1))
            if long and len(use):
                for no, body in enumerate(even_chunks(pieces(batch.column("text")[0].as_buffer(), huge))):
                    yield pa.RecordBatch.from_arrays([pa.array(f1), pa.array(f2), pa.array(size), pa.array([no]), pa.array(deal), pa.array([body], pa.binary())], names=names)
                continue
            if not len(use):
                continue
            buf, off = normalised(*utf8(batch.column("text")))
            count = size[use] // CHUNK + 1
            owner = np.repeat(use, count)
            no = ranges(np.zeros(len(count), np.int64), count)
            a = off[:-1][owner] + no * CHUNK
            b = np.minimum(a + CHUNK, off[1:][owner])
            data = buf.tobytes()
            body = pa.array([data[x:y] for x, y in zip(a.tolist(), b.tolist(), strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(f1[owner]), pa.array(f2[owner]), pa.array(size[owner]), pa.array(no), pa.array(deal[owner]), body], names=names)
        release()

    return run


def with_text(base: Base, huge: int):
    """Texts beside their fingerprints."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, long in split_long(batches, huge):
            f1, f2, size = prints(batch, long, base, huge)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("text"), pa.array(f1), pa.array(f2), pa.array(size)], names=["id", "text", *_KEY[:3]])

    return run


def even_chunks(parts: Iterator[np.ndarray]) -> Iterator[bytes]:
    """Bytes that come in parts, cut into chunks of CHUNK; the last one is shorter, or empty."""
    held = b""
    for part in parts:
        data = held + part.tobytes()
        end = len(data) // CHUNK * CHUNK
        for at in range(0, end, CHUNK):
            yield data[at : at + CHUNK]
        held = data[end:]
    yield held


def marked(bitmap: np.ndarray, f1: np.ndarray) -> np.ndarray:
    bit = (f1 % (len(bitmap) * 64)).astype(np.uint64)
    return (bitmap[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) > 0


def unlike(carry: list[str]):
    """Over rows sorted by `carry`: the first row of each run of equal keys, and whether all of the run have its piece. A task
    holds a batch and the first piece of the run that it is in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple | None = None
        piece, ok = None, True

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*[pa.array([x], pa.int64()) for x in last[:4]], pa.array([piece], pa.binary()), pa.array([ok])], names=[*_KEY, "piece", "same"])

        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in carry], axis=1)
            new = np.concatenate([[last is None or tuple(key[0]) != last], (key[1:] != key[:-1]).any(axis=1)])
            body = batch.column("piece")
            head = np.flatnonzero(new)
            lead = int(head[0]) if len(head) else len(key)
            if lead:  # goes on with the run before
                ok = ok and pc.all(pc.equal(body.slice(0, lead), pa.scalar(piece, pa.binary()))).as_py()
            if not len(head):
                continue
            if last is not None:
                yield row()
            run_of = np.cumsum(new) - 1
            same = np.asarray(pc.equal(body.slice(lead), body.take(pa.array(head[run_of[lead:]]))).to_numpy(zero_copy_only=False), bool)
            alike = np.logical_and.reduceat(same, head - lead)
            # The last run may go on in the next batch; the others are whole.
            if len(head) > 1:
                done = head[:-1]
                yield pa.RecordBatch.from_arrays([*[pa.array(key[done, i]) for i in range(4)], body.take(pa.array(done)), pa.array(alike[:-1])], names=[*_KEY, "piece", "same"])
            last, piece, ok = tuple(key[head[-1]]), body[int(head[-1])].as_py(), bool(alike[-1])
        if last is not None:
            yield row()

    return run


_COMPARED = "f1 long, f2 long, size long, no long, piece binary, same boolean"


def clashes(rows: DataFrame, base: Base, groups: DataFrame, total: int, huge: int = HUGE) -> DataFrame:
    """(f1, f2, size) of the groups of equal fingerprint that hold unlike texts.

    The repeated fingerprints mark a bitmap of fixed size; chunks of texts that it names are sorted by fingerprint and place and
    streamed past the first one. Groups of more copies than a task should get, of which there are MOST_HOT at most, are
    compared in shares, and the first ones of the shares with each other.
    """
    spark = rows.sparkSession
    words = groups.selectExpr(f"pmod(f1, {MAP_BITS}L) as bit").selectExpr("bit div 64 as word", "shiftleft(1L, cast(bit % 64 as int)) as mask")
    bits = words.groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
    bitmap = np.zeros(MAP_BITS // 64, np.uint64)
    bitmap[bits.column("word").to_numpy()] = bits.column("mask").to_numpy().view(np.uint64)
    # At most MOST_HOT groups can be as large as this.
    least = max(COPIES, -(-total // MOST_HOT))
    hot = groups.where(f"n > {least}").selectExpr("f1", "f2", "size", f"cast(ceil(n / {COPIES}D) as int) as shares")
    shared = spark.sparkContext.broadcast(bitmap)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from chunks(base, huge, shared.value)(batches)

    cut_rows = rows.selectExpr("text", "xxhash64(id, monotonically_increasing_id()) as deal").mapInArrow(cut, "f1 long, f2 long, size long, no long, deal long, piece binary")
    dealt = cut_rows.join(F.broadcast(hot), ["f1", "f2", "size"], "left").withColumn("share", F.expr("coalesce(pmod(deal, shares), 0L)")).select(*_KEY, "share", "piece")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    by_share = [*_KEY, "share"]
    once = dealt.repartition(tasks, *by_share).sortWithinPartitions(*by_share).mapInArrow(unlike(by_share), _COMPARED)
    once = stored(once.join(F.broadcast(hot.drop("shares").withColumn("split", F.lit(True))), ["f1", "f2", "size"], "left").where("split or not same"), "compared")
    again = once.where("same").repartition(tasks, *_KEY).sortWithinPartitions(*_KEY).mapInArrow(unlike(_KEY), _COMPARED)
    return once.where("not same").select(*_KEY[:3]).union(again.where("not same").select(*_KEY[:3])).distinct()


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most_rounds: int = 60, huge: int = HUGE, base_of=Base.of_round) -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256) of each row. Texts are equal when they are identical after each run of
    `[\\x20\\x09-\\x0D]` has become one space; of equal texts the row of the smallest id stays.

    Round 0 names each text by a fingerprint of 124 bits and its length, and compares the texts of each name. Names under
    which unlike texts meet go to another round under new numbers, until none is left; copies always stay together.

    Null text counts as empty. Rows that repeat an id are rows of their own: of several that tie at the smallest id one stays.
    A row of null id comes after all others: it stays only if its group has no other row that could, and keep_id is then
    null. Long texts are whole. An empty table gives no rows; columns of other names are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    key, out = ["f1", "f2", "size"], None
    for r in range(most_rounds):
        base = base_of(r)
        named = stored(fingerprints(rows.withColumn("rid", F.monotonically_increasing_id()), base, huge), "named")
        # Ids in order, null ones last; the row's own number breaks ties.
        groups = named.groupBy(*key).agg(F.count("*").alias("n"), F.min(F.expr("struct(id is null, id, rid)")).alias("first"))
        groups = stored(groups.selectExpr(*key, "n", "first.id as keep_id", "first.rid as keep_rid"), "groups")
        bad = stored(clashes(rows, base, groups.where("n > 1"), named.count(), huge), "clashes")
        met = bad.count()
        facts = named.selectExpr("f1 + 0L as f1", "f2", "size", "id", "rid", "sha").join(groups.join(bad, key, "left_anti") if met else groups, key)
        part = facts.selectExpr(f"id as {id_col}", "keep_id", "n as group_size", "rid = keep_rid as kept", "sha as text_sha256")
        out = part if out is None else out.unionByName(part)
        if not met:
            return out
        rows = stored(rows.mapInArrow(with_text(base, huge), "id long, text string, f1 long, f2 long, size long").join(bad, key, "left_semi").select("id", "text"), "open")
    raise RuntimeError(f"exact_duplicates: unlike texts met in each of {most_rounds} rounds")
