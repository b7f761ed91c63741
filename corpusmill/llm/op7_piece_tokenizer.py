"""SentencePiece encoding and decoding: Viterbi over piece scores for many words at once."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.kernels import K1, ranges, release, slices, utf8

#: Where the public vocabulary lies; a parameter of every call, never part of the repository.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Fixed value: what an unknown character costs beyond the worst piece, as the public format defines it.
UNKNOWN_PENALTY = 10.0
#: Words whose pieces a task remembers, and characters of a word up to which words advance together in one matrix row.
CACHE_WORDS, CELLS = 250_000, 1 << 16
_P = np.uint64(0x100000001B3)
HEAD_BITS = 18


@dataclass
class Pieces:
    """A piece model: sorted hashes of the pieces' characters with scores and ids; bytes of each id."""

    keys: np.ndarray
    scores: np.ndarray
    ids: np.ndarray
    longest: int
    unknown_score: float
    unknown_id: int
    byte_ids: np.ndarray | None
    text: np.ndarray
    text_off: np.ndarray
    dummy_prefix: bool

    def __post_init__(self) -> None:
        self.head = np.searchsorted(self.keys, np.arange(1 << HEAD_BITS, dtype=np.uint64) << np.uint64(64 - HEAD_BITS)).astype(np.int32)
        self.deep = int(np.diff(self.head, append=len(self.keys)).max())
        self.scores = np.concatenate([self.scores, np.zeros(self.deep + 1)])
        self.ids = np.concatenate([self.ids, np.zeros(self.deep + 1, np.int32)])
        self.padded = np.concatenate([self.keys, np.full(self.deep + 1, 2**64 - 1, np.uint64)])

    def probe(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of hashes among the sorted keys and whether they are there: a hash's first bits give where its like begin."""
        at = self.head[key >> np.uint64(64 - HEAD_BITS)]
        for _ in range(self.deep - 1):
            at = at + (self.padded[at] < key)
        hit = self.padded[at] == key
        return at, hit


def load(path: str = MODEL) -> Pieces:
    """Read a model file. Pieces of control, unknown and byte kind match no text. A piece that had a space after another
    character would cross words; such models are refused, as are normalisers other than the identity."""
    from sentencepiece import SentencePieceProcessor
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    with open(path, "rb") as f:
        proto.ParseFromString(f.read())
    if proto.normalizer_spec.precompiled_charsmap or proto.normalizer_spec.remove_extra_whitespaces:
        raise ValueError("only identity normalisation is supported")
    sp = SentencePieceProcessor(model_proto=proto.SerializeToString())
    n = sp.get_piece_size()
    normal = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    names = [sp.id_to_piece(i) for i in normal]
    if any(SPACE in x.lstrip(SPACE) for x in names):
        raise ValueError("pieces must not cross words")
    keys = np.array([_hash_of(x) for x in names], np.uint64)
    order = np.argsort(keys)
    if len(np.unique(keys)) < len(keys):
        raise ValueError("piece hashes collide")
    scores = np.array([sp.get_score(i) for i in normal])
    keep = set(normal)
    bytes_of = [bytes([int(sp.id_to_piece(i)[3:-1], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace(SPACE, " ").encode() if i in keep else b"" for i in range(n)]
    by_byte = None
    if any(sp.is_byte(i) for i in range(n)):
        by_byte = np.zeros(256, np.int32)
        for i in range(n):
            if sp.is_byte(i):
                by_byte[bytes_of[i][0]] = i
    return Pieces(
        keys[order], scores[order], np.array(normal, np.int32)[order], max(map(len, names)), float(scores.min()) - UNKNOWN_PENALTY, sp.unk_id(), by_byte,
        np.frombuffer(b"".join(bytes_of), np.uint8), np.concatenate([[0], np.cumsum([len(b) for b in bytes_of])]), bool(proto.normalizer_spec.add_dummy_prefix),
    )


def _hash_of(piece: str) -> int:
    h = np.zeros(1, np.uint64)
    with np.errstate(over="ignore"):
        for c in piece:
            h = h * _P + np.uint64(ord(c) + 1)
        return int((h * K1)[0])


def viterbi(codes: np.ndarray, m: Pieces) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best segmentations of words of one length, all rows at once: (ids, starts, row offsets) of their pieces, in order.

    Row i of `codes` holds a word's characters. All words advance by one end position at a time; substrings that end there
    probe the sorted piece keys, and the maximum over their starts is kept with its start as back pointer. Ties go to the
    longest piece. A character that no piece covers is the unknown piece."""
    n, size = codes.shape
    chars = np.ascontiguousarray(codes.T).astype(np.uint64) + np.uint64(1)
    best = np.full((size + 1, n), -np.inf)
    best[0] = 0
    back = np.zeros((size + 1, n), np.int32)
    piece = np.zeros((size + 1, n), np.int32)
    rolling = np.zeros((size, n), np.uint64)  # of the substring from each start to the end position
    each = np.arange(n)
    with np.errstate(over="ignore"):
        for end in range(1, size + 1):
            lo = max(0, end - m.longest)
            part = rolling[lo:end]
            part *= _P
            part += chars[end - 1]
            at, hit = m.probe(part * K1)
            total = m.scores[at]
            total[~hit] = -np.inf
            total[-1][~hit[-1]] = m.unknown_score
            total += best[lo:end]
            arg = total.argmax(axis=0)
            best[end] = total[arg, each]
            back[end] = arg + lo
            piece[end] = np.where(hit[arg, each], m.ids[at[arg, each]], m.unknown_id)
    rows, ids, starts = [], [], []
    row, end = np.arange(n), np.full(n, size)
    while len(row):
        rows.append(row)
        ids.append(piece[end, row])
        end = back[end, row]
        starts.append(end)
        row, end = row[end > 0], end[end > 0]
    rows, ids, starts = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (rows, ids, starts))
    order = np.lexsort((starts, rows))
    return ids[order], starts[order], np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=n))])


def encode_words(units: list[str], m: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of each unit, flat, and their offsets; units of equal length go through `viterbi` together, in blocks of at
    most CELLS characters. Unknown characters become bytes if the model has them."""
    length = np.array([len(u) for u in units], np.int64)
    flat_ids, flat_at, flat_n = [], np.zeros(len(units), np.int64), np.zeros(len(units), np.int64)
    base = 0
    for size in np.unique(length):
        who = np.flatnonzero(length == size)
        step = max(1, CELLS // int(size))
        for lo in range(0, len(who), step):
            mine = who[lo : lo + step]
            joined = "".join([units[i] for i in mine])
            codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(mine), int(size))
            ids, starts, off = viterbi(codes, m)
            if m.byte_ids is not None and (lost := ids == m.unknown_id).any():
                chars = codes[np.repeat(np.arange(len(mine)), np.diff(off)), starts]
                some, inv = np.unique(chars[lost], return_inverse=True)
                raw = [np.frombuffer(chr(c).encode("utf-8", "surrogatepass"), np.uint8) for c in some]
                many = np.ones(len(ids), np.int64)
                many[lost] = np.array([len(x) for x in raw])[inv]
                wide = np.repeat(ids, many)
                wide[ranges((np.cumsum(many) - many)[lost], many[lost])] = m.byte_ids[np.concatenate([raw[i] for i in inv])]
                off = np.concatenate([[0], np.cumsum(many)])[off]
                ids = wide
            flat_ids.append(ids.astype(np.int32))
            flat_at[mine], flat_n[mine] = base + off[:-1], np.diff(off)
            base += len(ids)
    flat = np.concatenate(flat_ids) if flat_ids else np.zeros(0, np.int32)
    return flat[ranges(flat_at, flat_n)], np.concatenate([[0], np.cumsum(flat_n)])


#: A unit: spaces and what follows up to the next space. No piece crosses from one to the next.
_UNIT = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


class Encoder:
    """Encodes texts, remembering the pieces of up to CACHE_WORDS distinct words."""

    def __init__(self, m: Pieces) -> None:
        self.m = m
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.flat, self.off = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and offsets by text. Null and empty texts have none."""
        if len(self.known) > CACHE_WORDS:
            self.clear()
        known, units, count = self.known, [], []
        for text in texts:
            n = len(units)
            if text:
                text = text.replace(" ", SPACE)
                units += _UNIT.findall(SPACE + text if self.m.dummy_prefix else text)
            count.append(len(units) - n)
        new = [u for u in dict.fromkeys(units) if u not in known]
        known.update(zip(new, range(len(known), len(known) + len(new)), strict=True))
        if new:
            ids, off = encode_words(new, self.m)
            self.off = np.concatenate([self.off, self.off[-1] + off[1:]])
            self.flat = np.concatenate([self.flat, ids])
        unit = np.fromiter(map(known.__getitem__, units), np.int64, len(units))
        each = (self.off[1:] - self.off[:-1])[unit]
        ends = np.concatenate([[0], np.cumsum(each)])[np.concatenate([[0], np.cumsum(count)]).astype(np.int64)]
        return self.flat[ranges(self.off[:-1][unit], each)], ends


def decode(ids: np.ndarray, off: np.ndarray, m: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets by row; the dummy prefix goes. The unknown piece gives nothing."""
    starts, sizes = m.text_off[:-1][ids], np.diff(m.text_off)[ids]
    ends = np.concatenate([[0], np.cumsum(sizes)])[off]
    body = m.text[ranges(starts, sizes)]
    if m.dummy_prefix:
        first = ends[:-1][ends[1:] > ends[:-1]]
        first = first[body[first] == 32]
        keep = np.ones(len(body), bool)
        keep[first] = False
        ends = ends - np.searchsorted(first, ends, side="left")
        body = body[keep]
    return body, ends


def encode_documents(docs: DataFrame, model: str = MODEL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, token_ids, round_trip) of each text, whole: the pieces of highest total score, by word.

    The file's scores are taken as unigram scores whatever model kind it was trained for. round_trip: decoding the ids gave
    the text's bytes. Null text: null ids, 0 tokens, round_trip true. Empty text: no ids. Other columns are ignored.
    The model file must be at `model` on every executor."""
    schema = f"{id_col} long, n_tokens int, token_ids array<int>, round_trip boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = load(model)
        encoder = Encoder(m)
        for batch in slices(batches, limit=2 << 20):
            release()
            column = batch.column("text")
            ids, off = encoder.encode(column.to_pylist())
            body, ends = decode(ids, off, m)
            raw, raw_off = utf8(column)
            same = np.diff(ends) == np.diff(raw_off)
            if len(body) == len(raw) and same.all():
                bad = np.searchsorted(raw_off, np.flatnonzero(body != raw), side="right") - 1
                same[bad] = False
            else:
                for i in np.flatnonzero(same):
                    same[i] = np.array_equal(body[ends[i] : ends[i + 1]], raw[raw_off[i] : raw_off[i + 1]])
            lists = pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(ids, pa.int32()), mask=column.is_null())
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(np.diff(off), pa.int32()), lists, pa.array(same)], names=[x.split()[0] for x in schema.split(", ")])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def decode_documents(tokens: DataFrame, model: str = MODEL, id_col: str = "doc_id", ids_col: str = "token_ids") -> DataFrame:
    """(id, text) of each row's ids; null ids give null text."""
    schema = f"{id_col} long, text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = load(model)
        for batch in batches:
            rows = batch.column("ids").to_pylist()
            count = [len(r or ()) for r in rows]
            body, ends = decode(np.array([x for r in rows for x in r or ()], np.int64), np.concatenate([[0], np.cumsum(count)]).astype(np.int64), m)
            texts = [None if r is None else body[a:b].tobytes().decode("utf-8", "replace") for r, a, b in zip(rows, ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(texts, pa.string())], names=[id_col, "text"])

    return tokens.select(F.col(id_col).cast("long").alias("id"), F.col(ids_col).alias("ids")).mapInArrow(run, schema)
