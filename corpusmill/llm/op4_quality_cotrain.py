"""Quality classifier by co-training: a view of the text and a view of the page's metadata teach each other."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.kernels import K1, K3, lower_ascii, mix, release, slices, span_hashes, utf8, words

#: Bounds of training, as documented parameters: labelled and unlabelled documents of the sample, rounds, and pseudo-labels
#: that a view hands over in a round.
LABELLED, POOL, ROUNDS, HANDED = 4000, 2000, 4, 150
N_SOURCE, N_LANG, N_LEN = 64, 16, 14
#: Keeps the slopes of small calibration sets from running away.
CALIBRATION_RIDGE = 1.0
META = ("source", "lang", "n_chars")


def text_features(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """A row for each text: shares of its bytes by value (logarithmic), and form: word lengths, repeated words, adjacent
    repeats, repeated lines, capitals at and within words, line and sentence lengths."""
    n = len(off) - 1
    size = np.maximum(np.diff(off), 1).astype(float)
    doc = np.repeat(np.arange(n), np.diff(off))
    share = np.bincount(doc * 256 + buf, minlength=n * 256).reshape(n, 256) / size[:, None]
    starts, ends, owner = words(buf, off)
    h = span_hashes(lower_ascii(buf), starts, ends)
    many = np.bincount(owner, minlength=n)
    count = np.maximum(many, 1).astype(float)
    length = (ends - starts).astype(float)
    total = np.bincount(owner, length, n)
    key = np.sort((h & ~np.uint64(0xFFFFFFFF)) | owner.astype(np.uint64)) if len(h) else h
    fresh = np.concatenate([[True], key[1:] != key[:-1]]) if len(h) else np.zeros(0, bool)
    kinds = np.bincount((key[fresh] & np.uint64(0xFFFFFFFF)).astype(np.int64), minlength=n)
    again = np.bincount(owner[1:][(h[1:] == h[:-1]) & (owner[1:] == owner[:-1])], minlength=n) if len(h) else np.zeros(n)
    upper = (buf >= 65) & (buf <= 90)
    cap = np.bincount(owner[upper[starts]], minlength=n) if len(starts) else np.zeros(n)
    odd = ~(((buf | 32) >= 97) & ((buf | 32) <= 122) | (buf >= 128))
    tail = np.bincount(owner[odd[ends - 1]], minlength=n) if len(ends) else np.zeros(n)
    ups = np.bincount(doc[upper], minlength=n)
    lines = np.bincount(doc[buf == 10], minlength=n) + 1
    stops = np.bincount(doc[(buf == 46) | (buf == 33) | (buf == 63)], minlength=n) + 1
    form = np.stack(
        [
            np.log1p(total / count), np.log1p(np.bincount(owner, length**2, n) / count), kinds / count, again / count, cap / count, (ups - cap) / size, tail / count,
            np.log1p(many / lines), np.log1p(many / stops), np.log1p(many),
        ],
        axis=1,
    )
    return np.concatenate([np.log1p(share * 200), form], axis=1)


def meta_features(source: list, lang: list, n_chars: list) -> np.ndarray:
    """A row for each page: source and language by hashed name, length by size class; null is a name of its own."""
    out = np.zeros((len(source), N_SOURCE + N_LANG + N_LEN + 1))
    for values, base, width in ((source, 0, N_SOURCE), (lang, N_SOURCE, N_LANG)):
        names = {v: int(_name_hash(v)) % width for v in set(values)}
        out[np.arange(len(values)), base + np.array([names[v] for v in values], np.int64)] = 1
    chars = np.array([max(0.0, float(x)) if x is not None else 0.0 for x in n_chars])
    level = np.minimum(np.log2(chars + 1), N_LEN - 1)
    out[np.arange(len(chars)), N_SOURCE + N_LANG + level.astype(int)] = 1
    out[:, -1] = level / N_LEN
    return out


def _name_hash(v: object) -> np.uint64:
    raw = np.frombuffer(("-" if v is None else "+" + str(v)).encode(), np.uint8)
    return span_hashes(raw, np.array([0]), np.array([len(raw)]))[0]


@dataclass
class View:
    """A calibrated linear classifier: logit = slope * (features @ weights + bias) + shift."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def raw(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) / self.scale @ self.weights + self.bias

    def logit(self, x: np.ndarray) -> np.ndarray:
        return self.slope * self.raw(x) + self.shift


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit_linear(x: np.ndarray, y: np.ndarray, w: np.ndarray, ridge: float, steps: int = 25) -> tuple[np.ndarray, float]:
    """Weighted logistic regression with a ridge penalty, by Newton steps; the bias isn't penalised."""
    a = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    penalty = np.full(a.shape[1], ridge)
    penalty[-1] = 1e-6
    beta = np.zeros(a.shape[1])
    for _ in range(steps):
        p = sigmoid(a @ beta)
        r = w * np.maximum(p * (1 - p), 1e-6)
        move = np.linalg.solve((a * r[:, None]).T @ a + np.diag(penalty), a.T @ (w * (y - p)) - penalty * beta)
        beta += move
        if np.abs(move).max() < 1e-7:
            break
    return beta[:-1], float(beta[-1])


def fit_view(x: np.ndarray, y: np.ndarray, w: np.ndarray, ridge: float = 3.0) -> View:
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    weights, bias = fit_linear((x - mean) / scale, y, w, ridge)
    return View(mean, scale, weights, bias)


@dataclass
class Model:
    text: View
    meta: View
    blend: np.ndarray  # of the two calibrated logits and one

    def score(self, xt: np.ndarray, xm: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        a, b = self.text.logit(xt), self.meta.logit(xm)
        return sigmoid(a), sigmoid(b), sigmoid(self.blend[0] * a + self.blend[1] * b + self.blend[2])


def co_train(xt: np.ndarray, xm: np.ndarray, y: np.ndarray, pt: np.ndarray, pm: np.ndarray, rounds: int = ROUNDS, handed: int = HANDED, confident: float = 0.9) -> Model:
    """Labelled rows (xt, xm, y) and a pool (pt, pm) without labels. A quarter of the labelled rows is kept for calibration.

    In a round each view labels the pool; the rows it is surest of (probability `confident` or more, by its calibration, at
    most `handed`, as many of either class as its base rate says) go to the other view with that label at half weight.
    """
    keep = np.arange(len(y)) % 4 == 0
    if len(set(y[keep])) < 2 or len(set(y[~keep])) < 2:
        keep[:] = False
    cal = keep if keep.any() else ~keep
    base = float(y[~keep].mean())
    given: list[dict[int, float]] = [{}, {}]
    views: list[View] = []
    data = ((xt, pt), (xm, pm))
    for turn in range(rounds + 1):
        views = []
        for v, (x, p) in enumerate(data):
            at = np.array(sorted(given[v]), np.int64)
            rows = np.concatenate([x[~keep], p[at]])
            view = fit_view(rows, np.concatenate([y[~keep], [given[v][i] for i in at]]), np.concatenate([np.ones((~keep).sum()), np.full(len(at), 0.5)]))
            slope, shift = fit_linear(view.raw(x[cal])[:, None], y[cal], np.ones(cal.sum()), CALIBRATION_RIDGE)
            view.slope, view.shift = float(max(slope[0], 0.0)), shift
            views.append(view)
        if turn == rounds or not len(pt):
            break
        for v, (_, p) in enumerate(data):
            prob = sigmoid(views[v].logit(p))
            other = given[1 - v]
            for label, n in ((1.0, round(handed * base)), (0.0, max(1, round(handed * (1 - base))))):
                sure = prob if label else 1 - prob
                order = [int(i) for i in np.argsort(-sure, kind="stable") if sure[i] >= confident and int(i) not in other]
                for i in order[:n]:
                    other[i] = label
    z = np.stack([views[0].logit(xt[cal]), views[1].logit(xm[cal])], axis=1)
    w, b = fit_linear(z, y[cal], np.ones(cal.sum()), CALIBRATION_RIDGE)
    return Model(views[0], views[1], np.array([*np.maximum(w, 0), b]))


def _features(docs: DataFrame, extra: list[str], id_col: str, text_col: str) -> DataFrame:
    """Both views' features of each row, with the columns `extra`."""
    kept = docs.select(*extra, F.col(text_col).cast("string").alias("text"), *[F.col(c).cast("string").alias(f"m_{c}") for c in META])
    fields = [f for f in kept.schema.fields if f.name in extra]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), "xt array<double>, xm array<double>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            xt, xm = batch_features(batch)
            lists = [pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel())) for x in (xt, xm)]
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in fields], *lists], names=[*[f.name for f in fields], "xt", "xm"])

    return kept.mapInArrow(run, schema)


def batch_features(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    def number(x: str | None) -> float | None:
        try:
            return float(x) if x is not None else None
        except ValueError:
            return None

    xm = meta_features(batch.column("m_source").to_pylist(), batch.column("m_lang").to_pylist(), [number(x) for x in batch.column("m_n_chars").to_pylist()])
    return text_features(*utf8(batch.column("text"))), xm


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", labelled: int = LABELLED, pool: int = POOL) -> Model | None:
    """Fit on a bounded sample: about `labelled` labelled documents and `pool` others, by the hashes of their ids. Rows that
    repeat an id count as one, the least by text, source, language and length. Labels that
    are null, other than 0 and 1, or contradict each other don't count. None if only one class has labels."""
    own = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("double").alias("y")).where("id is not null and y in (0, 1)")
    own = own.groupBy("id").agg(F.min("y").alias("y"), F.max("y").alias("top")).where("y = top").select("id", "y")
    h = "xxhash64(id, 4)"
    n_own, n_docs = own.count(), docs.count()

    def below(n: int, of: int) -> str:
        return f"{h} <= {min(2**63 - 1, int(-(2**63) + min(1.0, n / max(of, 1)) * 2**64))}L"

    sample = F.broadcast(own.where(below(labelled, n_own)))  # about `labelled` rows: the bound
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), *META).where("id is not null")
    # Of rows that repeat an id the least one counts, found before anything is gathered: an id brings one row.
    least = F.min(F.struct("text", *META)).alias("row")
    first = _features(rows.join(sample, "id").groupBy("id", "y").agg(least).select("id", "y", "row.*"), ["id", "y"], "id", "text").collect()
    rest = _features(rows.where(below(pool, n_docs)).join(sample, "id", "left_anti").groupBy("id").agg(least).select("id", "row.*"), ["id"], "id", "text").collect()
    order = lambda r: (int(mix(np.array([r["id"]], np.int64).view(np.uint64) * K1 + K3)[0]), r["id"])
    first, rest = sorted(first, key=order), sorted(rest, key=order)
    if len({r["y"] for r in first}) < 2:
        return None
    width = [len(first[0]["xt"]), len(first[0]["xm"])]
    table = lambda rs, c, k: np.array([r[c] for r in rs], float).reshape(len(rs), width[k])
    return co_train(table(first, "xt", 0), table(first, "xm", 1), np.array([r["y"] for r in first]), table(rest, "xt", 0), table(rest, "xm", 1))


SCORES = "p_text double, p_meta double, score double, accepted boolean"


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", threshold: float = 0.5, carry: list[str] | None = None) -> DataFrame:
    """(id, p_text, p_meta, score, accepted) of each document, by its whole text and its columns source, lang and n_chars.

    score is the combined probability of good quality; accepted, score >= threshold. Null and empty texts have features of
    an empty text; null metadata are values of their own; rows that repeat are scored alike. Labels of a single class, or
    none, give score null and accepted true: nothing is known against a document. `carry` names columns of `docs` that come
    along; without it no other columns do.
    """
    model = train(docs, labels, id_col, text_col, label_col)
    own = [f for f in docs.schema.fields if f.name in (carry or ())]
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), *[F.col(c).cast("string").alias(f"m_{c}") for c in META], *[F.col(f.name).alias(f"c_{f.name}") for f in own])
    names = [id_col, *[f.name for f in own if f.name != id_col], "p_text", "p_meta", "score", "accepted"]
    if model is None:
        return rows.selectExpr(f"id as {id_col}", *[f"c_{f.name} as `{f.name}`" for f in own if f.name != id_col], "cast(null as double) as p_text", "cast(null as double) as p_meta", "cast(null as double) as score", "true as accepted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            release()
            a, b, c = model.score(*batch_features(batch))
            yield pa.RecordBatch.from_arrays([batch.column("id"), *[batch.column(f"c_{f.name}") for f in own if f.name != id_col], pa.array(a), pa.array(b), pa.array(c), pa.array(c >= threshold)], names=names)

    return rows.mapInArrow(run, ", ".join([f"{id_col} long", *[f"`{f.name}` {f.dataType.simpleString()}" for f in own if f.name != id_col], SCORES]))
