"""Quality classifier: a factorisation machine over hashed words, statistics of the text's structure, and its size.

A document is a sparse vector x: its words hashed into `BUCKETS` places, and for each statistic one of `BINS` places by the
quantiles of the training sample, with the statistic itself beside it. The machine's value is

    w0 + sum_i w_i x_i + 1/2 sum_f [ (sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2 ]

which takes account of all pairs of features in time linear in their number. It is trained by AdaGrad on log loss.
"""

from __future__ import annotations

import base64
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.llm import rows
from vitrine.llm.labelled import sample, sigmoid

#: Documented bound of the sample: so many labelled documents of each class.
PER_CLASS = 2500
FOLD = (5, 0)
PREDICT_FROM = 0.3
BUCKETS = 1 << 15
BINS = 16
FACTORS = 8
EPOCHS = 12
BATCH = 64
RATE = 0.05
KNOWN = 500_000

_WORD = re.compile(rb"\S+")
_RUNS = re.compile(rb"([!-/:-@\[-`{-~])\1")
STATISTICS = 14


def statistics(data: bytes, words: list[bytes], counts: Counter) -> list[float]:
    """Shares and means that do not depend on the language much; all zero for the empty text."""
    n, k = len(data), len(words)
    if not k:
        return [0.0] * STATISTICS
    upper = n - len(data.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    digit = n - len(data.translate(None, b"0123456789"))
    sign = n - len(data.translate(None, b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"))
    odd = n - len(data.translate(None, b"#$%&*+/<=>@[\\]^_`{|}~"))
    stop = data.count(b".") + data.count(b"?")
    lines = [x for x in data.split(b"\n") if x.strip()]
    same = 1 - len(set(lines)) / len(lines) if lines else 0.0
    size = sum(map(len, words)) / k
    most = max(counts.values())
    pairs = len(set(zip(words, words[1:])))
    return [
        math.log1p(k), size, len(counts) / k, most / k, pairs / max(1, k - 1), upper / n, digit / n, sign / n, odd / n,
        stop / k, same, len(lines) / k, len(_RUNS.findall(data)) / k, data.count(b"!") / k,
    ]


class Machine:
    """Features and value of the machine; `edges` are the bins' borders, mean and spread those of the statistics."""

    def __init__(self, edges: np.ndarray, mean: np.ndarray, spread: np.ndarray, w0: float, w: np.ndarray, v: np.ndarray):
        self.edges, self.mean, self.spread, self.w0, self.w, self.v = edges, mean, spread, w0, w, v
        self.known: dict[bytes, int] = {}

    @staticmethod
    def parts(text: str | None) -> tuple[Counter, list[float]]:
        data = (text or "").encode("utf-8", "surrogatepass")
        words = data.split()
        counts = Counter(words)
        return counts, statistics(data, words, counts)

    def vector(self, counts: Counter, stats: list[float]) -> tuple[np.ndarray, np.ndarray]:
        known = self.known
        if len(known) > KNOWN:
            known.clear()
        for word in counts:
            if word not in known:
                known[word] = zlib.crc32(word) % BUCKETS
        place = np.fromiter(map(known.__getitem__, counts), np.int64, len(counts))
        value = np.sqrt(np.fromiter(counts.values(), np.float64, len(counts)))
        if len(value):
            value /= np.sqrt((value**2).sum())
        z = np.clip((np.array(stats) - self.mean) / self.spread, -4, 4)
        bins = (self.edges <= np.array(stats)[:, None]).sum(1) + BINS * np.arange(STATISTICS)
        place = np.concatenate([place, BUCKETS + bins, BUCKETS + BINS * STATISTICS + np.arange(STATISTICS)])
        return place, np.concatenate([value, np.full(STATISTICS, 0.5), z / 4])

    def value(self, place: np.ndarray, x: np.ndarray) -> float:
        vx = self.v[place] * x[:, None]
        s = vx.sum(0)
        return self.w0 + float(self.w[place] @ x) + 0.5 * float(s @ s - (vx * vx).sum())

    def scores(self, texts: list[str | None]) -> list[float]:
        return sigmoid(np.array([self.value(*self.vector(*self.parts(t))) for t in texts])).tolist()


def fit(texts: list[str | None], labels: list[int], weights: list[float]) -> Machine:
    """Trained with the documents' weights; the result does not depend on the order of the rows."""
    parts = [Machine.parts(t) for t in texts]
    stats = np.array([s for _, s in parts])
    edges = np.quantile(stats, np.arange(1, BINS) / BINS, axis=0).T
    size = BUCKETS + (BINS + 1) * STATISTICS
    draw = np.random.default_rng(7)
    y, weight = np.array(labels, float), np.array(weights) / np.mean(weights)
    p = float(np.clip((y * weight).sum() / weight.sum(), 1e-3, 1 - 1e-3))
    m = Machine(edges, stats.mean(0), stats.std(0) + 1e-9, math.log(p / (1 - p)), np.zeros(size), draw.normal(0, 0.02, (size, FACTORS)))
    vectors = [m.vector(*x) for x in parts]
    gw, gv = np.full(size, 1e-2), np.full((size, FACTORS), 1e-2)
    for _ in range(EPOCHS):
        order = draw.permutation(len(texts))
        for i in range(0, len(order), BATCH):
            rows_ = order[i : i + BATCH]
            place = np.concatenate([vectors[r][0] for r in rows_])
            x = np.concatenate([vectors[r][1] for r in rows_])
            at = np.cumsum([0] + [len(vectors[r][0]) for r in rows_])[:-1]
            lengths = np.diff(np.append(at, len(x)))
            vx = m.v[place] * x[:, None]
            s = np.add.reduceat(vx, at)
            value = m.w0 + np.add.reduceat(m.w[place] * x, at) + 0.5 * ((s * s).sum(1) - np.add.reduceat((vx * vx).sum(1), at))
            slope = np.repeat((sigmoid(value) - y[rows_]) * weight[rows_], lengths)
            dw = np.bincount(place, slope * x, size)
            used = np.unique(place)
            dv = np.zeros((size, FACTORS))
            each = (slope * x)[:, None] * (np.repeat(s, lengths, axis=0) - vx)
            for f in range(FACTORS):
                dv[:, f] = np.bincount(place, each[:, f], size)
            dw, dv = dw[used] / len(rows_) + 1e-5 * m.w[used], dv[used] / len(rows_) + 1e-5 * m.v[used]
            gw[used] += dw**2
            gv[used] += dv**2
            m.w[used] -= RATE * dw / np.sqrt(gw[used])
            m.v[used] -= RATE * dv / np.sqrt(gv[used])
            m.w0 -= RATE * 0.1 * float(((sigmoid(value) - y[rows_]) * weight[rows_]).mean())
    return m


def _pack(m: Machine | float) -> dict:
    if isinstance(m, float):
        return {"prior": m}
    put = lambda a: base64.b64encode(np.asarray(a, np.float32).tobytes()).decode()
    return {"w0": m.w0, **{k: put(getattr(m, k)) for k in ("edges", "mean", "spread", "w", "v")}}


def _unpack(model: dict) -> Machine:
    get = lambda k: np.frombuffer(base64.b64decode(model[k]), np.float32).astype(np.float64)
    return Machine(get("edges").reshape(STATISTICS, BINS - 1), get("mean"), get("spread"), model["w0"], get("w"), get("v").reshape(-1, FACTORS))


def train(documents: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "quality",
          per_class: int = PER_CLASS, fold: tuple[int, int] = FOLD) -> dict:
    """The model, of fixed size (about 1.6 MB), from a bounded sample of labelled documents that are not held out. It is fitted
    in one task. Without both classes the score is the share of good ones (0 without any label)."""
    rows.importable(documents.sparkSession)
    taken = sample(documents, labels, label, per_class, fold, text, doc_id)

    def run(batches):
        import json

        texts, given, weights = [], [], []
        for batch in batches:
            texts += batch.column(0).to_pylist()
            given += batch.column(1).to_pylist()
            weights += batch.column(2).to_pylist()
        order = sorted(range(len(texts)), key=lambda i: (texts[i] or "", given[i]))
        one = len(set(given)) < 2
        model = (float(np.mean(given)) if given else 0.0) if one else fit(*([x[i] for i in order] for x in (texts, given, weights)))
        yield pa.RecordBatch.from_arrays([pa.array([json.dumps(_pack(model))])], ["model"])

    import json

    fitted = taken.repartition(1).mapInArrow(run, "model string").first()
    return json.loads(fitted["model"]) if fitted else {"prior": 0.0}  # no labelled row, no task


_built: dict[str, Machine] = {}


def score(documents: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """`documents` with `score` (0 to 1) and `predicted` (1 from 0.3 on).

    Null counts as the empty text, which has a score like any other. Every row gives one row; an empty table gives an empty one. Input
    columns with the name of a result column are replaced. Labels, language, source and id are not used.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)  # of fixed size

    def process(texts):
        given = shared.value
        if "prior" in given:
            return ([given["prior"]] * len(texts),)
        key = f"{given['w0']}{given['w'][:64]}{given['v'][:64]}{given['edges'][:64]}"
        if key not in _built:
            _built.clear()
            _built[key] = _unpack(given)
        return (_built[key].scores(texts),)

    scored = rows.with_columns(documents.drop("predicted"), text, [("score", T.DoubleType())], process)
    return scored.withColumn("predicted", (F.col("score") >= PREDICT_FROM).cast("int"))
