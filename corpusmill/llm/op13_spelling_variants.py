"""Spelling variant grouping: words one edit apart are found by merging the light subtrees of a trie with one character skipped or
replaced, and each word follows its far more frequent neighbours to a root."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.kernels import lower_ascii, ranges, release, slices, utf8
from corpusmill.llm.shared import stored

#: Code points of a word, and its occurrences, at least; how many times more often its form occurs.
LEAST_CHARS, LEAST_COUNT, RATIO = 7, 2, 10
#: A run whose checksum with its document's id this divides loses one code point.
DROP_EVERY = 31
#: Words of one part of the trie, and light entries that are written out together.
PART_WORDS, ENTRIES = 50_000, 1 << 16
#: Bytes of text whose words are counted together; runs longer than this are checked one by one.
COUNT_BYTES, LONG_RUN = 8 << 20, 64
#: Stands for any one character: no word has it.
ANY = ord("*")


def crc_table() -> np.ndarray:
    """The 256 steps of CRC-32, from its polynomial."""
    x = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        x = np.where(x & 1, (x >> np.uint32(1)) ^ np.uint32(0xEDB88320), x >> np.uint32(1))
    return x


def checksums(before: np.ndarray, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """CRC-32 of each span, going on from the checksum `before` it: a byte of all spans at a time, long ones by themselves."""
    out = before ^ np.uint32(0xFFFFFFFF)
    size = ends - starts
    live = np.flatnonzero(size <= LONG_RUN)
    k = 0
    while len(live := live[size[live] > k]):
        out[live] = steps[(out[live] ^ buf[starts[live] + k]) & np.uint32(0xFF)] ^ (out[live] >> np.uint32(8))
        k += 1
    out ^= np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(size > LONG_RUN):
        out[i] = zlib.crc32(buf[starts[i] : ends[i]].tobytes(), int(before[i]))
    return out


def word_counts(least: int, every: int):
    """(word, n) by slice: the runs of letters of each text, of which some lose a code point; those of `least` and more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = crc_table()
        for batch in slices(batches, limit=COUNT_BYTES):
            buf, off = utf8(batch.column("text"))
            buf = lower_ascii(buf)
            # U+00C0 to U+00FF are the characters of lead byte C3.
            lead = buf == 0xC3
            inside = ((buf >= 97) & (buf <= 122)) | lead
            inside[1:] |= lead[:-1]
            first, last = inside.copy(), inside.copy()
            first[1:] &= ~inside[:-1]
            last[:-1] &= ~inside[1:]
            used = off[:-1] < off[1:]
            head, tail = off[:-1][used], off[1:][used] - 1
            first[head], last[tail] = inside[head], inside[tail]
            starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
            chars = np.concatenate([[0], np.cumsum(inside & ~np.concatenate([[False], lead[:-1]]))])
            long = np.flatnonzero(chars[ends] - chars[starts] >= least)
            starts, ends = starts[long], ends[long]
            row = np.searchsorted(off, starts, side="right") - 1
            size = ends - starts
            at = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
            body = buf[ranges(starts, size)]
            terms = pc.dictionary_encode(pa.StringArray.from_buffers(len(starts), pa.py_buffer(at), pa.py_buffer(body)))
            width = max(1, len(terms.dictionary))
            # What becomes of a run depends on its document's id and itself: one check for each text and word.
            pair, once, n = np.unique(row * width + terms.indices.to_numpy(), return_index=True, return_counts=True)
            ids = pc.fill_null(pc.cast(batch.column("id"), pa.string()), "").to_pylist()
            before = np.array([zlib.crc32(f"{i}:".encode()) for i in ids], np.uint32)[row[once]]
            h = checksums(before, body, at[:-1][once].astype(np.int64), at[1:][once].astype(np.int64), steps)
            hit = h % np.uint32(every) == 0
            count = np.bincount((pair % width)[~hit], n[~hit], width).astype(np.int64)
            cut: dict[str, int] = {}
            for word, crc, m in zip(terms.dictionary.take(pa.array((pair % width)[hit])).to_pylist(), h[hit].tolist(), n[hit].tolist(), strict=True):
                if len(word) > least:
                    k = crc % len(word)
                    word = word[:k] + word[k + 1 :]
                    cut[word] = cut.get(word, 0) + m
            some = np.flatnonzero(count)
            words = pa.concat_arrays([terms.dictionary.take(pa.array(some)), pa.array(list(cut), pa.string())])
            yield pa.RecordBatch.from_arrays([words, pa.array(np.concatenate([count[some], np.array(list(cut.values()), np.int64)]))], names=["word", "n"])
        release()

    return run


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n
    while hi - lo > 1:  # a and b agree in the first lo, and not in the first hi
        mid = (lo + hi) // 2
        lo, hi = (mid, hi) if a[:mid] == b[:mid] else (lo, mid)
    return lo


def spines(bounds: list[tuple[int, bytes, bytes]]) -> dict[int, tuple[bytes, bytes]]:
    """For each part of the sorted words, given its first and last word: the heavy child, at each depth, of the nodes that it
    shares with the part before, and with the part after.

    Such a node is cut by some range bounds. Its heavy child is the one that its middle bound cuts or begins: any other child
    lies on one side of it, so that no more than about half the node's words are light. All parts choose alike, by the bounds
    alone. Bounds are as many as parts.
    """
    n = len(bounds)
    shared = [common_prefix(bounds[i][2], bounds[i + 1][1]) for i in range(n - 1)]
    within = [common_prefix(first, last) for _, first, last in bounds]
    heavy = [bytearray(depth + 1) for depth in shared]
    for i in range(n - 1):
        # Nodes that the bound before cuts as well have been settled with it.
        known = min(shared[i - 1], within[i], shared[i]) + 1 if i else 0
        heavy[i][:known] = heavy[i - 1][:known] if i else b""
        end = i
        for d in range(shared[i], known - 1, -1):
            while end + 1 < n - 1 and min(within[end + 1], shared[end + 1]) >= d:
                end += 1
            word = bounds[(i + end) // 2 + 1][1]
            heavy[i][d] = word[d] if len(word) > d else 0
    return {p: (bytes(heavy[i - 1]) if i else b"", bytes(heavy[i]) if i < n - 1 else b"") for i, (p, _, _) in enumerate(bounds)}


def light_entries(buf: np.ndarray, off: np.ndarray, left: bytes, right: bytes) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
    """For sorted distinct words, by depth d: the words that lie in a light child of their node at depth d, or end there, and
    the first character of the node's heavy child. `left` and `right`: heavy children of the nodes shared with other parts.

    The heavy child of a node is its largest one; a word has no more light nodes than the logarithm of the words.
    """
    n = len(off) - 1
    if not n:
        return
    size = np.diff(off)
    # lcp[i]: characters that word i has in common with the one before it.
    lcp = np.zeros(n + 1, np.int64)
    live, d = np.arange(1, n), 0
    while len(live):
        fits = live[(size[live] > d) & (size[live - 1] > d)]
        live = fits[buf[off[fits] + d] == buf[off[fits - 1] + d]]
        d += 1
        lcp[live] = d
    lcp[0], lcp[n] = len(left) - 1, len(right) - 1
    depths = np.unique(np.concatenate([lcp[1:n], np.arange(len(left)), np.arange(len(right))]))
    live = np.arange(n)
    for d in depths.tolist():
        live = live[np.maximum(lcp[live], lcp[live + 1]) >= d]
        if not len(live):
            break
        before = lcp[live]
        before[live == 0] = -1
        node_starts, child_starts = np.flatnonzero(before < d), np.flatnonzero(before <= d)
        char = np.where(size[live] > d, buf[np.minimum(off[live] + d, len(buf) - 1)].astype(np.int64), -1)
        child_size = np.diff(np.append(child_starts, len(live)))
        child_char = char[child_starts]
        child_size[child_char < 0] = 0
        node_of_child = np.searchsorted(node_starts, child_starts, side="right") - 1
        # The first of the largest children of each node.
        order = np.lexsort((np.arange(len(child_starts)), -child_size, node_of_child))
        heavy = child_char[order[np.searchsorted(node_of_child[order], np.arange(len(node_starts)))]]
        if len(left) > d and live[0] == 0:
            heavy[0] = left[d]
        if len(right) > d and live[-1] == n - 1:
            heavy[-1] = right[d]
        heavy_of = np.repeat(heavy, np.diff(np.append(node_starts, len(live))))
        light = char != heavy_of
        if light.any():
            yield live[light], d, heavy_of[light]


def edits(buf: np.ndarray, off: np.ndarray, word: np.ndarray, at: np.ndarray, heavy: np.ndarray, least: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, bool]]:
    """Bytes, sizes and words of what the light entries (word, place, heavy character) are looked up by: with the character
    replaced by the heavy one, skipped, or preceded by the heavy one, as words; with any character in its place, as keys."""
    size = np.diff(off)[word]
    inner = at < size
    has_heavy = heavy > 0
    padded = np.append(buf, np.zeros(2, buf.dtype))
    char, following = padded[off[word] + at], padded[off[word] + at + 1]

    def replaced(pick: np.ndarray, by: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        s = size[pick]
        out = buf[ranges(off[word[pick]], s)]
        out[np.cumsum(s) - s + at[pick]] = by
        return out, s

    pick = np.flatnonzero(inner & has_heavy)
    yield *replaced(pick, heavy[pick]), word[pick], False
    pick = np.flatnonzero(inner)
    yield *replaced(pick, np.full(len(pick), ANY)), word[pick], True
    # Of a run of one character the last one is skipped: there the two words part.
    pick = np.flatnonzero(inner & ((at + 1 == size) | (following != char)) & (size > least))
    s = size[pick]
    whole = ranges(off[word[pick]], s)
    whole = np.delete(whole, np.cumsum(s) - s + at[pick])
    yield buf[whole], s - 1, word[pick], False
    pick = np.flatnonzero(has_heavy)
    s = size[pick] + 1
    out = np.empty(int(s.sum()), buf.dtype)
    place = np.cumsum(s) - s + at[pick]
    old = np.ones(len(out), bool)
    old[place] = False
    out[old] = buf[ranges(off[word[pick]], s - 1)]
    out[place] = heavy[pick]
    yield out, s, word[pick], False


def lookups(parts: dict[int, tuple[bytes, bytes]], least: int):
    """(probe, merged, word, n): what the words of one part of the trie are looked up by, as ISO-8859-1."""

    def run(table: pa.Table) -> Iterator[pa.RecordBatch]:
        table = table.combine_chunks().sort_by("key")
        keys = table.column("key").combine_chunks()
        _, offsets, data = keys.buffers()
        off = np.frombuffer(offsets, np.int32, len(keys) + 1 + keys.offset)[keys.offset :].astype(np.int64)
        buf = np.frombuffer(data, np.uint8)
        n = table.column("n").to_numpy()
        held, many = [], 0

        def out() -> Iterator[pa.RecordBatch]:
            word, at, heavy = (np.concatenate(x) for x in zip(*held, strict=True))
            for body, size, owner, merged in edits(buf, off, word, at, heavy, least):
                ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
                probe = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(body, np.uint8))])
                yield pa.RecordBatch.from_arrays([probe, pa.array(np.full(len(size), merged)), keys.take(pa.array(owner)), pa.array(n[owner])], names=["probe", "merged", "word", "n"])

        for word, d, heavy in light_entries(buf, off, *parts[table.column("part")[0].as_py()]):
            held.append((word, np.full(len(word), d), heavy))
            many += len(word)
            if many >= ENTRIES:
                yield from out()
                held, many = [], 0
        if held:
            yield from out()
        release()

    return run


def near_words(words: DataFrame, part_words: int = PART_WORDS, least: int = LEAST_CHARS) -> DataFrame:
    """(key, n_near, best) of each word (key, n), as ISO-8859-1, that has a word one insertion, deletion or replacement away: how
    many, and of those the most frequent one, ties by code points, as (-n, key).

    Two such words part at one node of the trie, and at most one of them goes on in its heavy child. So every pair is found,
    once, from a light subtree: by looking up the other word as it must be, where it is in the heavy child, or ends, or is the
    shorter one; or by the key that both have with that character replaced by any, where both are light. Words are dealt to
    parts by ranges; nodes that are cut by a range's bounds have the same heavy child in all parts (`spines`).
    """
    words = words.withColumn("n", F.col("n").cast("long"))
    parts = max(1, -(-words.count() // part_words))
    ranged = words.repartitionByRange(parts, "key").withColumn("part", F.spark_partition_id())
    ranged = stored(ranged, "ranges")
    bounds = ranged.groupBy("part").agg(F.min("key").alias("a"), F.max("key").alias("b")).orderBy("a").collect()
    edges = spines([(r.part, bytes(r.a), bytes(r.b)) for r in bounds])
    rows = stored(ranged.groupBy("part").applyInArrow(by_part(edges, least), "probe binary, merged boolean, word binary, n long"), "lookups")
    pairs = rows.where("not merged").join(words.selectExpr("key as probe", "n as m"), "probe")
    found = pairs.selectExpr("inline(array(struct(word as key, 1L as near, struct(-m as neg, probe as key) as best), struct(probe as key, 1L as near, struct(-n as neg, word as key) as best)))")
    # Words of one key differ in its one place: as many as there are letters, at most.
    met = rows.where("merged").groupBy("probe").agg(F.array_sort(F.collect_list(F.expr("struct(-n as neg, word as key)"))).alias("all")).where("size(all) > 1")
    merged = met.selectExpr("explode(all) as x", "all", "size(all) - 1L as near").selectExpr("x.key as key", "near", "if(x.key = all[0].key, all[1], all[0]) as best")
    return found.union(merged).groupBy("key").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))


def by_part(edges: dict[int, tuple[bytes, bytes]], least: int):
    read = lookups(edges, least)

    def run(table: pa.Table) -> pa.Table:
        return pa.Table.from_batches(list(read(table)), pa.schema([("probe", pa.binary()), ("merged", pa.bool_()), ("word", pa.binary()), ("n", pa.int64())]))

    return run


def roots(forms: DataFrame, most_rounds: int = 40) -> DataFrame:
    """(key, root): where following forms (key, form) ends. A form occurs RATIO times as often as its word, so chains are short
    and have no circle; each round doubles the steps."""
    hops = stored(forms.selectExpr("key", "form as root"), "hops")
    for _ in range(most_rounds):
        jump = hops.join(hops.selectExpr("key as root", "root as further"), "root", "left")
        # As soon as no root has a form of its own, all are at the end.
        hops = stored(jump.selectExpr("key", "coalesce(further, root) as root", "further is not null as moved"), "hops")
        if hops.where("moved").isEmpty():
            return hops.select("key", "root")
        hops = hops.select("key", "root")
    raise RuntimeError(f"roots: no end after {most_rounds} rounds")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_CHARS, least_count: int = LEAST_COUNT, ratio: int = RATIO, every: int = DROP_EVERY, part_words: int = PART_WORDS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each word: a run `[A-Za-z\\u00C0-\\u00FF]+` of the texts, lower-cased in A-Z, of
    `least` code points and `least_count` occurrences n. If `every` divides h, the unsigned CRC-32 of UTF-8 `<id>:<run>`, the
    run first loses its code point h % length.

    Words are near if they differ by one inserted, deleted or replaced code point. A word's form is its near word of largest
    n, ties by code points, if that is `ratio` times its own n or more, else null; form_n is that n. root is where following
    forms ends: the word itself if it has none.

    Null texts have no words; a null id counts as the empty string. Rows that repeat count each. Runs of any length take part.
    An empty table gives no rows; columns of other names are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    counted = rows.mapInArrow(word_counts(least, every), "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(f"n >= {least_count}")
    words = stored(counted.select(F.encode("word", "ISO-8859-1").alias("key"), "n"), "words")
    near = stored(near_words(words, part_words, least), "near")
    known = words.join(near, "key", "left").selectExpr("key", "n", "coalesce(n_near, 0L) as n_near", f"-best.neg >= {ratio} * n as has", "best")
    known = stored(known.selectExpr("key", "n", "n_near", "if(has, best.key, null) as form", "if(has, -best.neg, null) as form_n"), "known")
    ends = roots(known.where("form is not null").select("key", "form"))
    out = known.join(ends, "key", "left").withColumn("root", F.coalesce("root", "key"))
    text = [F.decode(c, "ISO-8859-1").alias(n) for c, n in (("key", "word"), ("form", "form"), ("root", "root"))]
    return out.select(*text, "n", "n_near", "form_n")
