"""Operator 5: language identification.

Model: letters are lower-cased, everything else separates words; each word's character
n-grams (its edges marked) are hashed to rows of an embedding table; a text's vector is the
mean of its rows, and a linear softmax gives the language. Table and softmax are trained
together by stochastic gradient descent in numpy.

Every label of the table is learned. Training takes a bounded, deterministic sample: about
SAMPLE_DOCS documents per language, and of each up to SAMPLE_WORDS words in stretches spread
over the whole text. With many languages there are fewer documents of each, then fewer
stretches, but never fewer than LEAST_DOCS and one (or all, if a language has less). One in five sampled documents of
a language is not trained on and calibrates the scores (temperature) and rejection.

Rejection has two signals. The stronger one is strangeness: how much of a text are subwords that
training never saw, beyond what chance gives a short text. Its limit is where KNOWN_REJECT of the
calibration documents lie above it, unless leaving labels out shows that a higher one does as well: a document's
subwords that only its own label showed count as unseen then, which is how strange it would
be to a model without that label. The limit may rise as long as FOREIGN_PASS of such
documents of every label lie below it, but no further than it takes to spare all known ones. The
other signal is the score, whose limit is halfway between an even guess and the least score of
a right answer (REJECT_RATE of them aside).

Prediction is one pass over whole texts without a shuffle. The fitted table (at most
2^BUCKET_BITS rows of DIM numbers, 16 MB) is broadcast: its size is fixed.
"""
from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from adlake.llm.common import fresh, slices, text_column

SAMPLE_DOCS, SAMPLE_WORDS, STRETCH = 500, 400, 40
#: Documents of all languages together, unless LEAST_DOCS of each are more.
SAMPLE_TOTAL, LEAST_DOCS = 16_000, 40
#: Longer words are cut, as text without white space is; characters of a stretch.
WORD_CHARS, STRETCH_CHARS = 40, 600
BUCKET_BITS, DIM, ORDERS = 18, 16, (2, 3, 4)
EPOCHS, RATE, TABLE_RATE, SEED = 5, 0.5, 5.0, 20
REJECT_RATE, FOREIGN_PASS, KNOWN_REJECT = 0.001, 0.05, 0.01
UNKNOWN = "und"
#: Characters whose subwords are held at once (about 200 bytes each).
PIECE_CHARS = 400_000
_GAP = re.compile(r"[\W\d_]")
_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Whether each code point is a letter. Made once per process."""
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, count=0x110000))
    return _LETTER[0]


def subwords(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(row of the embedding table, index of the text) of every subword, texts in order."""
    lower = [t.lower() for t in texts]  # may lengthen a text, so lengths are taken after it
    points = np.frombuffer("\n".join(["", *lower, ""]).encode("utf-32-le"), "<u4")
    letter = _letters()[points]
    text = np.r_[0, np.repeat(np.arange(len(texts)), [len(t) + 1 for t in lower])] if texts else np.zeros(1, np.int64)
    keep = letter | np.r_[True, letter[:-1]]  # one separator after each word
    c, text, edge = np.where(letter, points, 0)[keep].astype(np.uint64), text[keep], ~letter[keep]
    rows, owner, hashed = [], [], c * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1)
    whole = np.ones(len(c), dtype=bool)
    for n in range(2, max(ORDERS) + 1):
        if len(c) < n:
            break
        m = len(c) - n + 1
        hashed = (hashed[:m] ^ (hashed[:m] >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + c[n - 1:]
        if n > 2:
            whole = whole[:m] & ~edge[n - 2:n - 2 + m]
        else:
            whole = whole[:m]
        if n in ORDERS:
            at = np.flatnonzero(whole)
            mixed = (hashed[at] ^ (hashed[at] >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
            rows.append((mixed >> np.uint64(64 - BUCKET_BITS)).astype(np.int64))
            owner.append(text[at + edge[at]])
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    rows, owner = np.concatenate(rows), np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return rows[order], owner[order]


def _sums(values: np.ndarray, owner: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Sum of the rows of each text, and how many rows it has."""
    n = np.bincount(owner, minlength=count)
    total = np.zeros((count, values.shape[1]), dtype=np.float64)
    some = np.flatnonzero(n)
    if len(some):
        total[some] = np.add.reduceat(values, (np.cumsum(n) - n)[some], axis=0, dtype=np.float64)
    return total, n


def _pieces(texts: list[str]) -> Iterator[tuple[list[str], list[int]]]:
    """Groups of about PIECE_CHARS characters of text, with the index of the text each part is
    of. A longer text is cut where a word ends, so that its subwords stay the same (a word
    of that length anywhere)."""
    parts, owners, held = [], [], 0
    for k, text in enumerate(texts):
        at = 0
        while at < len(text) or not at:
            end = at + PIECE_CHARS
            if end < len(text) and (gap := _GAP.search(text, end)):
                end = gap.end()
            parts.append(text[at:end] if at or end < len(text) else text)
            owners.append(k)
            held += len(parts[-1])
            at = max(end, 1)
            if held >= PIECE_CHARS:
                yield parts, owners
                parts, owners, held = [], [], 0
    if parts:
        yield parts, owners


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


class Model:
    """Languages, embedding table, softmax, temperature and rejection level."""

    def __init__(self, languages: list[str], table: np.ndarray, weights: np.ndarray, bias: np.ndarray):
        self.languages, self.bias, self.temperature, self.level = languages, bias, 1.0, 0.0
        #: Labels whose training texts showed a subword's row: 0, one (its number and 1), or several (-1).
        self.seen = np.full(1 << BUCKET_BITS, -1, dtype=np.int32)
        self.strangest = 1.0
        # The mean of rows times weights is the mean of (rows times weights): keep the narrower table.
        narrow = weights.shape[1] <= weights.shape[0]
        self.table = (table @ weights if narrow else table).astype(np.float32)
        self.weights = None if narrow else weights

    def logits(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        logits, n, _ = self._read(texts, [0] * len(texts))
        return logits, n

    def _read(self, texts: list[str], without: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each text's logits, number of subwords, and how many no training text showed; what
        only the label of number ``without`` - 1 showed counts as unseen too."""
        total, n = np.zeros((len(texts), self.table.shape[1])), np.zeros(len(texts), dtype=np.int64)
        unseen, without = np.zeros(len(texts), dtype=np.int64), np.asarray(without)
        for parts, owners in _pieces(texts):
            rows, owner = subwords(parts)
            sums, counts = _sums(self.table[rows], owner, len(parts))
            np.add.at(total, owners, sums)
            np.add.at(n, owners, counts)
            shown = self.seen[rows]
            new = shown == 0
            if without.any():
                new |= shown == without[np.asarray(owners)[owner]]
            np.add.at(unseen, owners, np.bincount(owner[new], minlength=len(parts)))
        mean = total / np.maximum(n, 1)[:, None]
        return (mean if self.weights is None else mean @ self.weights) + self.bias, n, unseen

    def predict(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the language, calibrated score, and whether the text has a letter."""
        return self.judge(texts)[:3]

    def judge(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """As ``predict``, and whether the text is accepted as one of the languages."""
        logits, n, unseen = self._read(texts, [0] * len(texts))
        p = _softmax(logits / self.temperature)
        accepted = (n > 0) & (p.max(axis=1) >= self.level) & (strangeness(unseen, n) <= self.strangest)
        return p.argmax(axis=1), p.max(axis=1), n > 0, accepted


def strangeness(unseen: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Unseen subwords, less two standard deviations of such a count, as a share of all."""
    return np.maximum(unseen - 2 * np.sqrt(unseen), 0) / np.maximum(n, 1)


def train(texts: list[str], languages: list[str], epochs: int = EPOCHS, rate: float = RATE, seed: int = SEED) -> Model:
    """Fit on (text, language) pairs: half the stretches whole, the rest cut short, so that
    short texts are recognised too. Then calibrate on every fifth text of each language."""
    names = sorted(set(languages))
    label = {name: k for k, name in enumerate(names)}
    rng = np.random.default_rng(seed)
    table = np.zeros((1 << BUCKET_BITS, DIM))
    weights, bias = rng.normal(0, 1 / np.sqrt(DIM), (DIM, len(names))), np.zeros(len(names))
    examples, seen, check = [], dict.fromkeys(names, 0), []
    for k, text in enumerate(texts):
        seen[languages[k]] += 1
        if seen[languages[k]] % 5 == 0:
            check.append(k)
        elif len(names) > 1:
            words = text.split()
            for at in range(0, len(words), STRETCH):
                stretch = words[at:at + STRETCH]
                if rng.random() < 0.5:
                    stretch = stretch[:rng.integers(1, len(stretch) + 1)]
                rows, _ = subwords([" ".join(stretch)])
                if len(rows):
                    found, times = np.unique(rows, return_counts=True)
                    examples.append(((found.astype(np.int32), times.astype(np.int32)), len(rows), label[languages[k]]))
    steps = max(1, epochs * len(examples))
    for step, e in enumerate(itertools.chain.from_iterable(rng.permutation(len(examples)) for _ in range(epochs))):
        (rows, counts), n, y = examples[e]
        share = counts / n
        hidden = share @ table[rows]
        error = _softmax(hidden @ weights + bias)
        error[y] -= 1
        lr = rate * (1 - step / steps)
        table[rows] -= lr * TABLE_RATE * np.outer(share, weights @ error)
        weights -= lr * np.outer(hidden, error)
        bias -= 0.01 * lr * error
    model = Model(names, table, weights, bias)
    if examples:
        model.seen[:] = 0
        for (rows, _), _, y in examples:
            shown = model.seen[rows]
            model.seen[rows] = np.where((shown == 0) | (shown == y + 1), y + 1, -1)
    check = check or list(range(len(texts)))
    calibrate(model, [texts[k] for k in check], np.array([label[languages[k]] for k in check]))
    return model


def calibrate(model: Model, texts: list[str], y: np.ndarray) -> None:
    """The temperature of least log loss, then the limits of score and strangeness."""
    logits, n, unseen = model._read(texts, [0] * len(texts))
    some = n > 0
    if not some.any():
        return
    foreign = strangeness(model._read(texts, list(y + 1))[2], n)[some]
    logits, y, own = logits[some], y[some], strangeness(unseen, n)[some]
    losses = {}
    for t in np.geomspace(0.05, 20, 60):
        p = _softmax(logits / t)[np.arange(len(y)), y]
        losses[t] = -np.log(np.maximum(p, 1e-12)).mean() + 1e-4 * abs(np.log(t))
    model.temperature = min(losses, key=losses.get)
    p = _softmax(logits / model.temperature)
    right, even = p.max(axis=1)[p.argmax(axis=1) == y], 1 / len(model.languages)
    model.level = (even + float(np.quantile(right, REJECT_RATE))) / 2 if len(right) else 0.0
    if len(model.languages) > 1:
        stranger = min(float(np.quantile(foreign[y == k], FOREIGN_PASS)) for k in np.unique(y))
        known = float(np.quantile(own, 1 - KNOWN_REJECT))
        model.strangest = max(known, min(stranger / 2, float(own.max())))


def held_out(doc_id: Column) -> Column:
    """Documents never learned from: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def last_place(count: int, sample_docs: int) -> int:
    """Of hashes in 0..2^63-1, the largest that is sampled so that about ``sample_docs`` of ``count`` are."""
    return min(1 << 63, (sample_docs << 63) // count) - 1


def sample_sizes(languages: int, sample_docs: int = SAMPLE_DOCS) -> tuple[int, int]:
    """Documents per language, and stretches of each, so that the sample of all languages stays bounded."""
    docs = min(sample_docs, max(LEAST_DOCS, SAMPLE_TOTAL // languages))
    most = SAMPLE_WORDS // STRETCH
    return docs, min(most, max(1, SAMPLE_TOTAL * most // (languages * docs)))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang",
        sample_docs: int = SAMPLE_DOCS) -> Model | None:
    """Train on the bounded sample, which has every label; None if no document has a usable label and text.

    Rows with a null id, null label or null text, and held-out rows, are not learned from.
    Rows that repeat an id and its text count once."""
    rows = docs.select(docs[id_col].alias("id"), text_column(docs, text_col).alias("text"), docs[label_col].cast("string").alias("lang"),
                       docs[text_col].isNotNull().alias("known"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("lang").isNotNull() & F.col("known") & ~held_out(F.col("id")))
    place = F.shiftrightunsigned(F.xxhash64("id", "text"), 1)
    counts = rows.groupBy("lang").agg(F.approx_count_distinct(place).alias("count")).collect()
    if not counts:
        return None
    sample_docs, parts = sample_sizes(len(counts), sample_docs)
    last = docs.sparkSession.createDataFrame([(r["lang"], last_place(r["count"], sample_docs)) for r in counts], "lang string, last long")
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]{1,%d}" % WORD_CHARS), F.lit(0))
    total, joined = F.size("words"), F.array_join("words", " ")
    stretches = F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda k: F.substring(F.array_join(F.slice(
        "words", (k * F.greatest(total - STRETCH, F.lit(0)) / max(1, parts - 1)).cast("int") + 1, F.lit(STRETCH)), " "), 1, STRETCH_CHARS))
    whole = (total <= parts * STRETCH) & (F.length(joined) <= parts * STRETCH_CHARS)
    sample = rows.join(F.broadcast(last), "lang").filter(place <= F.col("last")).withColumn("words", words).select(
        place.alias("place"), "lang", F.when(whole, joined).otherwise(F.array_join(F.array_distinct(stretches), " ")).alias("text"))
    taken = sorted((r["place"], r["lang"], r["text"]) for r in sample.dropDuplicates(["place", "lang"]).collect())
    return train([r[2] for r in taken], [r[1] for r in taken]) if taken else None


def _predictor(spark, model: Model | None):
    shared = spark.sparkContext.broadcast(model)

    def predict(texts: list[str | None]) -> tuple[list[str], list[float], list[bool]]:
        """Language, score, accepted."""
        model = shared.value
        if model is None:
            return [UNKNOWN] * len(texts), [0.0] * len(texts), [False] * len(texts)
        best, score, known, accepted = model.judge([t or "" for t in texts])
        return ([model.languages[b] if k else UNKNOWN for b, k in zip(best, known)],
                [float(s) if k else 0.0 for s, k in zip(score, known)], accepted.tolist())
    return predict


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, accepted.

    Null texts and texts without a letter, and all texts if there is no model, get ``und``,
    score 0 and are not accepted. Repeated rows are predicted one by one; an empty table
    gives an empty result. Only id and text are read."""
    predict = _predictor(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            lang, score, accepted = predict(part.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(lang, pa.string()),
                                              pa.array(score, pa.float64()), pa.array(accepted, pa.bool_())],
                                             names=["doc_id", "held_out", "lang_pred", "score", "accepted"])

    source = docs.select(docs[id_col].cast("long").alias("doc_id"), held_out(docs[id_col]).alias("held_out"),
                         text_column(docs, text_col).alias("text"))
    return source.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, accepted boolean")


def keep_identified(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """The rows whose language is accepted, with their own columns unchanged, whatever those are named.

    Null texts, texts without a letter, and all texts if there is no model, are not accepted. Repeated rows
    are judged alike, one by one; an empty table gives an empty result."""
    predict, copy = _predictor(docs.sparkSession, model), fresh(docs, "__text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, copy):
            _, _, accepted = predict(part.column(copy).to_pylist())
            yield part.drop_columns([copy]).filter(pa.array(accepted, pa.bool_()))

    return docs.withColumn(copy, text_column(docs, text_col)).mapInArrow(run, docs.schema)
