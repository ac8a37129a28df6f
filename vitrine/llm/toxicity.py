"""Toxicity by compression distance: two zstandard dictionaries, one from toxic and one from ordinary text.

**Dictionaries.** Most of a toxic text is ordinary language, which compresses alike with either dictionary. So each dictionary
is trained on the stretches that set its class apart: character grams that much more documents of one class than of the other have, or
have several times, mark them (a common stem that toxic texts of one language repeat is in few ordinary ones as often), and the stretches make up the dictionary, the most frequent ones last,
where they are cheapest to refer to.

**Windows.** A window is a word with the blanks around it (long ones are cut). Both dictionaries end in the same `PRIMER`,
and every window begins with it, so that a window is always coded with matches and a stretch found in a dictionary shows in
the length at once. The difference of the two lengths tells which text the window resembles.

**Threshold.** What the differences of a document come to (the largest, how many reach the threshold, their share) is turned
into a probability by logistic regression. For it, every sampled document is measured with dictionaries made from the other half
of the sample.
"""

from __future__ import annotations

import json
import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.llm import rows
from vitrine.llm.labelled import logistic, sample, sigmoid

#: Documented bound of the sample: so many labelled documents of each class.
PER_CLASS = 2000
FOLD = (4, 2)
PREDICT_FROM = 0.3
GRAM = 5
#: A gram sets a class apart if it is e**APART times as frequent there, in `LEAST_SHARE` of its documents and in `LEAST_DOCUMENTS`
#: (fewer if the sample is tiny) at least.
APART = 2.3
LEAST_SHARE, LEAST_DOCUMENTS = 0.005, 6
#: Up to so many occurrences of a gram in a document are told apart.
OFTEN = 4
STRETCHES = 300
WINDOW = 64
#: Bytes of difference from which a window counts as resembling toxic text.
STEP = 3
PRIMER = b"0123456789#abcdefghijklmnopqrstuvwxyz#"
#: Follows every window: the coder looks for no matches in the last bytes of its input.
TRAILER = b"\x01\x02\x03\x04\x05\x06\x07\x08\x0b\x0c\x0e\x0f"
#: Words whose difference a worker keeps.
KNOWN = 500_000


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def windows_of(word: bytes) -> list[bytes]:
    return [b" " + word[i : i + WINDOW] + b" " for i in range(0, len(word), WINDOW)]


def grams_of(word: bytes) -> list[bytes]:
    word = b" " + word + b" "
    return [word[i : i + GRAM] for i in range(max(1, len(word) - GRAM + 1))]


def counted(docs: list[Counter]) -> Counter:
    """How many documents have a gram once at least, or 2, 3, … `OFTEN` times."""
    found: Counter = Counter()
    known: dict[bytes, list[bytes]] = {}
    for words in docs:
        grams: Counter = Counter()
        for word, n in words.items():
            parts = known.get(word)
            if parts is None:
                parts = known[word] = list(set(grams_of(word)))
            if n == 1:
                grams.update(parts)
            else:
                for g in parts:
                    grams[g] += n
        found.update([(g, min(n, OFTEN)) for g, n in grams.items()])
    for times in range(OFTEN, 1, -1):  # who has it so often has it less often, too
        for g in [g for g, n in found if n == times]:
            found[g, times - 1] += found[g, times]
    return found


def distinctive(own: tuple[Counter, int], other: tuple[Counter, int]) -> set[bytes]:
    """Grams that set the first class apart, by the documents that have them and by those that have them often; (counts, documents) of both."""
    (found, n_own), (known, n_other) = own, other
    least = max(min(LEAST_DOCUMENTS, 1 + n_own // 8), LEAST_SHARE * n_own)
    share = lambda n, docs: math.log((n + 0.5) / (docs + 1))
    return {k[0] for k, n in found.items() if n >= least and share(n, n_own) - share(known[k], n_other) > APART}


def stretches(docs: list[Counter], marks: set[bytes]) -> bytes:
    """The parts of words that the grams cover, the most frequent last."""
    found: Counter = Counter()
    for words in docs:
        for word in words:
            hits = [i for i, g in enumerate(grams_of(word)) if g in marks]
            word = b" " + word + b" "
            begin = end = -1
            for i in [*hits, len(word) + GRAM]:
                if i > end:
                    if end > begin:
                        found[word[begin:end]] += 1
                    begin = i
                end = min(i + GRAM, len(word))
    kept = sorted(sorted(found, key=lambda s: (-found[s], s))[:STRETCHES], key=lambda s: (found[s], s))
    return b"".join(kept)


class Lengths:
    """Difference of the compressed lengths of a word: ordinary dictionary less toxic dictionary."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        import zstandard as zs

        settings = zs.ZstdCompressionParameters(
            format=zs.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_checksum=False, write_dict_id=False,
            window_log=14, hash_log=12, chain_log=12, search_log=4, min_match=5, target_length=32, strategy=zs.STRATEGY_LAZY,
        )
        def coder(content: bytes):
            data = zs.ZstdCompressionDict(content + PRIMER, dict_type=zs.DICT_TYPE_RAWCONTENT)
            return zs.ZstdCompressor(compression_params=settings, dict_data=data)

        self.toxic, self.ordinary = coder(toxic), coder(ordinary)
        self.known: dict[bytes, int] = {}

    def difference(self, word: bytes) -> int:
        found = self.known.get(word)
        if found is None:
            found = max(
                len(self.ordinary.compress(w)) - len(self.toxic.compress(w))
                for w in (PRIMER + w + TRAILER for w in windows_of(word))
            )
            if len(word) <= WINDOW:
                if len(self.known) >= KNOWN:
                    self.known.clear()
                self.known[word] = found
        return found

    def features(self, words: list[bytes]) -> list[float]:
        """Of a document's words: the largest difference, how many reach `STEP` (all, different ones), their share."""
        counts = Counter(words)
        reached, different, largest = 0, 0, 0
        for word, n in counts.items():
            d = self.difference(word)
            if d >= STEP:
                reached += n
                different += 1
            if d > largest:
                largest = d
        share = reached / len(words) if words else 0.0
        return [float(largest), math.log1p(reached), math.log1p(different), 100 * share, math.sqrt(share) * 10]


def fit(texts: list[str | None], labels: list[int], weights: list[float]) -> dict:
    """Dictionaries and weights; without both classes the score is the share of toxic ones (0 without any label)."""
    words = [Counter(words_of(t)) for t in texts]
    y, weight = np.array(labels, float), np.array(weights, float)
    if len(set(labels)) < 2:
        return {"prior": float(y.mean()) if len(y) else 0.0}

    def dictionaries(rows_: list[int]) -> tuple[bytes, bytes]:
        own = [[words[i] for i in rows_ if labels[i] == k] for k in (1, 0)]
        counts = [(counted(docs), len(docs)) for docs in own]
        return tuple(stretches(docs, distinctive(a, b)) for docs, a, b in zip(own, counts, counts[::-1]))

    order: Counter = Counter()
    half = []
    for label in labels:  # every other document of each class
        order[label] += 1
        half.append(order[label] % 2)
    x = np.zeros((len(texts), 5))
    for part in (0, 1):
        lengths = Lengths(*dictionaries([i for i in range(len(texts)) if half[i] != part]))
        for i in range(len(texts)):
            if half[i] == part:
                x[i] = lengths.features(words_of(texts[i]))
    toxic, ordinary = dictionaries(list(range(len(texts))))
    mean, spread = x.mean(0), x.std(0) + 1e-9
    w = logistic((x - mean) / spread, y, weight)
    return {"toxic": toxic.hex(), "ordinary": ordinary.hex(), "mean": mean.tolist(), "spread": spread.tolist(), "weights": w.tolist()}


def train(documents: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "toxic",
          per_class: int = PER_CLASS, fold: tuple[int, int] = FOLD) -> dict:
    """The model, of a few KB, from a bounded sample of labelled documents that are not held out. It is fitted in one task."""
    rows.importable(documents.sparkSession)
    taken = sample(documents, labels, label, per_class, fold, text, doc_id)

    def run(batches):
        texts, given, weights = [], [], []
        for batch in batches:
            texts += batch.column(0).to_pylist()
            given += batch.column(1).to_pylist()
            weights += batch.column(2).to_pylist()
        order = sorted(range(len(texts)), key=lambda i: (texts[i] or "", given[i]))  # whatever order the rows came in
        model = fit(*([x[i] for i in order] for x in (texts, given, weights)))
        yield pa.RecordBatch.from_arrays([pa.array([json.dumps(model)])], ["model"])

    fitted = taken.repartition(1).mapInArrow(run, "model string").first()
    return json.loads(fitted["model"]) if fitted else {"prior": 0.0}  # no labelled row, no task


_built: dict[str, Lengths] = {}


def scores(model: dict, texts: list[str | None]) -> list[float]:
    if "prior" in model:
        return [model["prior"]] * len(texts)
    rows.only("toxicity", _built.clear)
    key = model["toxic"] + "/" + model["ordinary"]
    if key not in _built:
        _built.clear()
        _built[key] = Lengths(bytes.fromhex(model["toxic"]), bytes.fromhex(model["ordinary"]))
    x = np.array([_built[key].features(words_of(t)) for t in texts]).reshape(len(texts), 5)
    w = np.array(model["weights"])
    return sigmoid((x - model["mean"]) / model["spread"] @ w[:-1] + w[-1]).tolist()


def score(documents: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """`documents` with `score` (0 to 1) and `predicted` (1 from 0.3 on).

    Null counts as the empty text, which has a score like any other. Every row gives one row; an empty table gives an empty one. Input
    columns with the name of a result column are replaced. Labels, language, source and id are not used.
    """
    scored = rows.with_columns(documents.drop("predicted"), text, [("score", T.DoubleType())], lambda texts: (scores(model, texts),))
    return scored.withColumn("predicted", (F.col("score") >= PREDICT_FROM).cast("int"))


def keep_ordinary(documents: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """The documents that are not predicted toxic, columns as they are."""
    return rows.filtered(documents, text, lambda texts: [s < PREDICT_FROM for s in scores(model, texts)])
