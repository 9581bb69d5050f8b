"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of 100 words. Every passage is encoded by surface
statistics and hashed words, a hidden layer turns the encoding into a vector, and
gated attention decides how much each passage counts:

    h_k = tanh(W x_k + b)      a_k = softmax_k(w . (tanh(V h_k) * sigmoid(U h_k)))
    score = sigmoid(c . sum_k a_k h_k + d)

Only documents have labels; which passages matter is learned with the rest. The
model is fitted on the driver on a bounded sample of labelled documents and is a
few thousand numbers; encoding and scoring run in tasks over whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from flowtables.llm.common import id_text, ship_functions, with_id

PASSAGE_WORDS = 100
HASHED = 32
#: Fitting uses at most so many documents, of at most so many passages each.
SAMPLE_DOCUMENTS, SAMPLE_PASSAGES = 8192, 256

# Character classes by byte value: upper, lower, digit, sentence marks, each symbol
# on its own, other ASCII marks, bytes of non-ASCII characters.
_CLASSES = ["ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789", ".,;:?'\"", "!", "#", "$", "%", "&", "*", "|", "()[]{}<>/\\=+-_@^~`"]


def _class_table() -> np.ndarray:
    table = np.zeros((256, len(_CLASSES) + 1), np.float32)
    for k, chars in enumerate(_CLASSES):
        for c in chars:
            table[ord(c), k] = 1
    table[128:, -1] = 1
    return table


FEATURES = len(_CLASSES) + 1 + 7 + HASHED


def passages(text: str | None) -> list[list[bytes]]:
    """Words in runs of ``PASSAGE_WORDS``; one empty run for no words."""
    found = text.encode("utf-8", "surrogatepass").split() if text else []
    return [found[i : i + PASSAGE_WORDS] for i in range(0, len(found), PASSAGE_WORDS)] or [[]]


def encode(text: str | None, table: np.ndarray, places: dict) -> np.ndarray:
    """One row of features per passage of the whole text. ``places`` remembers words' hashes."""
    bags = passages(text)
    out = np.zeros((len(bags), FEATURES), np.float32)
    k = table.shape[1]
    for row, found in zip(out, bags, strict=True):
        n = len(found)
        if not n:
            continue
        raw = b" ".join(found)
        counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256).astype(np.float32)
        row[:k] = counts @ table / len(raw)
        distinct = set(found)
        repeats = sum(map(bytes.__eq__, found[1:], found[:-1]))
        row[k : k + 7] = (
            n / PASSAGE_WORDS, (len(raw) - n + 1) / n / 10, len(distinct) / n, repeats / n,
            max(map(found.count, distinct)) / n if len(distinct) < 20 else 0.0,
            sum(w[:1].isupper() for w in found) / n, sum(map(bytes.isalpha, found)) / n)
        if len(places) > 500_000:
            places.clear()
        spots = [places.get(w) or places.setdefault(w, xxhash.xxh32_intdigest(w) % HASHED + 1) for w in found]
        row[k + 7 :] = np.bincount(spots, minlength=HASHED + 1)[1:] / n
    return out


def forward(x: np.ndarray, starts: np.ndarray, m: dict) -> dict:
    """Scores of bags; bag i has the rows of ``x`` from starts[i] on."""
    sizes = np.diff(np.append(starts, len(x)))
    h = np.tanh(((x - m["mean"]) / m["scale"]) @ m["W"] + m["b"])
    t, g = np.tanh(h @ m["V"]), 1 / (1 + np.exp(-(h @ m["U"])))
    e = (t * g) @ m["w"]
    e = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), sizes))
    a = e / np.repeat(np.add.reduceat(e, starts), sizes)
    z = np.add.reduceat(a[:, None] * h, starts)
    return {"h": h, "t": t, "g": g, "a": a, "z": z, "sizes": sizes, "score": 1 / (1 + np.exp(-np.clip(z @ m["c"] + m["d"], -30, 30)))}


def fit(bags: list[np.ndarray], labels: np.ndarray, hidden: int = 16, attention: int = 8, epochs: int = 40, batch: int = 256, rate: float = 0.01, decay: float = 1e-4) -> dict:
    """Model from bags and their labels (0 or 1), by Adam on the log loss; the same input gives the same model."""
    rng = np.random.default_rng(7)
    everything = np.concatenate(bags) if bags else np.zeros((1, FEATURES), np.float32)
    m = {
        "mean": everything.mean(0), "scale": everything.std(0) + 1e-3,
        "W": rng.normal(0, FEATURES**-0.5, (FEATURES, hidden)), "b": np.zeros(hidden),
        "V": rng.normal(0, hidden**-0.5, (hidden, attention)), "U": rng.normal(0, hidden**-0.5, (hidden, attention)),
        "w": rng.normal(0, attention**-0.5, attention), "c": np.zeros(hidden), "d": np.zeros(())}
    share = (labels.sum() + 1) / (len(labels) + 2)
    m["d"] = np.array(np.log(share / (1 - share)))
    names = ["W", "b", "V", "U", "w", "c", "d"]
    first, second, step = {n: np.zeros_like(m[n]) for n in names}, {n: np.zeros_like(m[n]) for n in names}, 0
    for epoch in range(epochs if 0 < labels.sum() < len(labels) else 0):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), batch):
            chosen = order[at : at + batch]
            x = np.concatenate([bags[i] for i in chosen])
            starts = np.concatenate([[0], np.cumsum([len(bags[i]) for i in chosen])[:-1]])
            r = forward(x, starts, m)
            wrong = (r["score"] - labels[chosen]) / len(chosen)
            dz = np.repeat(wrong[:, None] * m["c"], r["sizes"], axis=0)
            da = (dz * r["h"]).sum(1)
            de = r["a"] * (da - np.repeat(np.add.reduceat(r["a"] * da, starts), r["sizes"]))
            dt, dg = de[:, None] * m["w"] * r["g"] * (1 - r["t"] ** 2), de[:, None] * m["w"] * r["t"] * r["g"] * (1 - r["g"])
            dh = (dz * r["a"][:, None] + dt @ m["V"].T + dg @ m["U"].T) * (1 - r["h"] ** 2)
            scaled = (x - m["mean"]) / m["scale"]
            slopes = {"W": scaled.T @ dh + decay * m["W"], "b": dh.sum(0), "V": r["h"].T @ dt, "U": r["h"].T @ dg, "w": (r["t"] * r["g"]).T @ de, "c": r["z"].T @ wrong + decay * m["c"], "d": wrong.sum()}
            step += 1
            for n in names:
                first[n] = 0.9 * first[n] + 0.1 * slopes[n]
                second[n] = 0.999 * second[n] + 0.001 * slopes[n] ** 2
                m[n] = m[n] - rate * (1 - epoch / epochs) * (first[n] / (1 - 0.9**step)) / (np.sqrt(second[n] / (1 - 0.999**step)) + 1e-8)
    return {n: np.asarray(v, np.float32) for n, v in m.items()}


def is_held_out(doc_id) -> F.Column:
    """crc32 of the id as text divides by 5; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_DOCUMENTS) -> dict:
    """Model from ``labels`` (doc_id, quality) on ``docs``, never from held-out ids.

    Labels that are null or not 0 or 1 are passed over; of several labels for an id
    the lowest counts. The ``sample`` ids of smallest hash are used, and of those
    the documents of up to ``SAMPLE_PASSAGES`` passages: what comes to the driver is bounded.
    """
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~is_held_out("doc_id"))
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    table = _class_table()

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        places: dict = {}
        for frame in frames:
            found = [encode(t, table, places) for t in frame["text"]]
            few = np.array([len(x) <= SAMPLE_PASSAGES for x in found], bool)
            yield pd.DataFrame({"doc_id": frame["doc_id"], "quality": frame["quality"], "x": [x.tobytes() for x in found]})[few]

    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select(F.col("doc_id").cast("long"), F.col("quality").cast("int"), "text")
    got = sorted(tuple(r) for r in rows.mapInPandas(work, "doc_id long, quality int, x binary").collect())
    seen, bags, marks = set(), [], []
    for doc_id, quality, x in got:
        if doc_id not in seen:
            seen.add(doc_id)
            bags.append(np.frombuffer(x, np.float32).reshape(-1, FEATURES))
            marks.append(quality)
    return fit(bags, np.array(marks, np.float32))


def with_score(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, score for every row of ``docs``; the whole text of each is encoded."""
    table = _class_table()

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        places: dict = {}
        for frame in frames:
            scores = []
            for at in range(0, len(frame), 256):
                bags = [encode(t, table, places) for t in frame["text"].iloc[at : at + 256]]
                starts = np.concatenate([[0], np.cumsum([len(b) for b in bags])[:-1]]).astype(np.int64)
                scores.append(forward(np.concatenate(bags), starts, model)["score"])
            yield pd.DataFrame({"doc_id": frame["doc_id"], "score": np.concatenate(scores).astype(float) if scores else np.empty(0)})

    rows = docs.select(id_text(), F.col("text").cast("string").alias("text"))
    return with_id(rows.mapInPandas(work, "doc_id string, score double"))


def scored(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted: one row per row of ``docs`` (doc_id, text).

    ``score`` is between 0 and 1; null, empty and blank texts are one empty passage
    and are scored too. Without usable labels every text gets about 0.5. Rows
    that repeat an id are scored each; a null id is not held out. Other columns are
    never read. An empty table gives an empty table.
    """
    rows = with_score(docs, train(docs, labels))
    return rows.select("doc_id", is_held_out("doc_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs``, with all columns, whose score reaches ``threshold``."""
    model, table = train(docs, labels), _class_table()

    def good(texts: pd.Series) -> pd.Series:
        places: dict = {}
        found = []
        for text in texts:
            bag = encode(text, table, places)
            found.append(forward(bag, np.zeros(1, np.int64), model)["score"][0] >= threshold)
        return pd.Series(found, dtype=bool)

    return docs.where(F.pandas_udf(good, "boolean")(F.col("text")))


ship_functions(__name__)
