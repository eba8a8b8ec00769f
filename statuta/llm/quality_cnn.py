"""Quality classifier: a byte-level convolutional network in numpy.

Bytes are embedded and learned filters slide over every document: windows of
``WIDTH`` bytes every ``STRIDE`` bytes, multiplied by ``FILTERS`` filters and
passed through a ReLU. Overlapping chunks of two halves (``HALF`` windows
each, 256 bytes in all, a new chunk every 128 bytes, to the document's end)
take each filter's maximum and mean; a dense layer turns these into chunk
features, whose maximum and mean over all chunks give one probability. Bytes
of a document are the only input: the score reads no label, language, source
or id.

The network is fitted on the driver on a bounded sample of labelled rows
(``TRAIN_ROWS`` rows, whole texts); fitting and scoring cover every byte of a
document, block by block where it is long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import pieces, ship

TRAIN_ROWS = 3000
WIDTH, STRIDE, EMBED, FILTERS, HALF, HIDDEN = 8, 4, 8, 32, 32, 24
EPOCHS, BATCH, RATE, SEED = 8, 32, 0.01, 5
#: Small samples are gone through more often, up to so many steps.
LEAST_STEPS = 800
#: Halves multiplied at once.
BLOCK = 512
#: Bytes of a batch up to which its gradient is taken at once.
AT_ONCE = 1 << 18
THRESHOLD = 0.3

Model = dict[str, np.ndarray]


def initial(seed: int = SEED) -> Model:
    r = np.random.default_rng(seed)
    f = lambda *shape, scale: (r.standard_normal(shape) * scale).astype(np.float32)
    return {
        "embed": f(256, EMBED, scale=0.5),
        "conv": f(WIDTH * EMBED, FILTERS, scale=(2 / (WIDTH * EMBED)) ** 0.5),
        "conv_b": np.zeros(FILTERS, np.float32),
        "dense": f(2 * FILTERS + 1, HIDDEN, scale=(1 / FILTERS) ** 0.5),
        "dense_b": np.zeros(HIDDEN, np.float32),
        "out": f(2 * HIDDEN, scale=(1 / HIDDEN) ** 0.5),
        "out_b": np.zeros(1, np.float32),
    }


def windows(text: bytes) -> tuple[np.ndarray, int]:
    """(halves, HALF, WIDTH) windows, padded with zero bytes, and how many are real; an empty text has one."""
    n = max(1, -(-max(0, len(text) - WIDTH + STRIDE) // STRIDE))
    full = -(-n // HALF) * HALF
    padded = np.zeros((full - 1) * STRIDE + WIDTH, np.uint8)
    padded[: len(text)] = np.frombuffer(text, np.uint8)
    w = np.lib.stride_tricks.sliding_window_view(padded, WIDTH)[::STRIDE]
    return w.reshape(-1, HALF, WIDTH), n


def activations(m: Model, w: np.ndarray, real: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Inputs and ReLU outputs (halves, HALF, FILTERS); windows past a document's end give 0."""
    x = m["embed"][w].reshape(-1, WIDTH * EMBED)
    a = x @ m["conv"]
    a += m["conv_b"]
    np.maximum(a, 0, out=a)
    a = a.reshape(-1, HALF, FILTERS)
    if real[-1] < HALF or (real < HALF).any():
        a *= (np.arange(HALF) < real[:, None])[:, :, None]
    return x, a


def chunk_features(top: np.ndarray, total: np.ndarray, real: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Maximum, mean and fill of the chunks made of halves first and second (the same half where there is one only)."""
    n = (real[first] + np.where(first == second, 0, real[second])).astype(np.float32)[:, None]
    both = total[first] + np.where((first == second)[:, None], 0, total[second])
    return np.concatenate([np.maximum(top[first], top[second]), both / n, n / (2 * HALF)], 1)


def pooled(m: Model, text: bytes) -> np.ndarray:
    """Maximum and mean of the chunk features over the whole document."""
    w, n = windows(text)
    halves = len(w)
    real = np.full(halves, HALF)
    real[-1] = n - (halves - 1) * HALF
    best, sums, count = np.zeros(HIDDEN, np.float32), np.zeros(HIDDEN), 0
    for k in range(0, max(1, halves - 1), BLOCK):
        part = slice(k, min(halves, k + BLOCK + 1))
        _, a = activations(m, w[part], real[part])
        first = np.arange(max(1, a.shape[0] - 1))
        second = np.minimum(first + 1, a.shape[0] - 1)
        h = np.maximum(chunk_features(a.max(1), a.sum(1), real[part], first, second) @ m["dense"] + m["dense_b"], 0)
        best, sums, count = np.maximum(best, h.max(0)), sums + h.sum(0), count + len(h)
    return np.concatenate([best, (sums / count).astype(np.float32)])


def score_texts(m: Model, texts: list[bytes]) -> np.ndarray:
    if not texts:
        return np.zeros(0)
    z = (np.stack([pooled(m, t) for t in texts]) @ m["out"] + m["out_b"]).astype(np.float64)
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def fit(texts: list[bytes], labels: list[int], epochs: int = EPOCHS, seed: int = SEED) -> Model:
    """Adam on the log loss; both classes weigh the same. Without both classes the score is the share of ones."""
    m = initial(seed)
    y = np.asarray(labels, np.float32)
    if len(y) == 0 or y.min() == y.max():
        m["out"][:] = 0
        m["out_b"][:] = 0 if len(y) == 0 else (4 if y[0] else -4)
        return m
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean())).astype(np.float32)
    r = np.random.default_rng(seed)
    first = {k: np.zeros_like(v) for k, v in m.items()}
    second = {k: np.zeros_like(v) for k, v in m.items()}
    each = -(-len(y) // BATCH)
    epochs = max(epochs, -(-LEAST_STEPS // each))
    step, steps = 0, epochs * each
    for _ in range(epochs):
        order = r.permutation(len(y))
        for k in range(0, len(order), BATCH):
            rows = order[k : k + BATCH]
            g = _gradient(m, [texts[i] for i in rows], y[rows], weight[rows])
            step += 1
            rate = RATE * min(1.0, step / 50) * (1 - step / (steps + 1))
            for name, d in g.items():
                first[name] += 0.1 * (d - first[name])
                second[name] += 0.001 * (d * d - second[name])
                m[name] -= rate * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)
    return m


def _gradient(m: Model, texts: list[bytes], y: np.ndarray, weight: np.ndarray) -> Model:
    views = [windows(t) for t in texts]
    halves = np.array([len(v) for v, _ in views])
    parts = [(v, np.append(np.full(len(v) - 1, HALF), n - (len(v) - 1) * HALF)) for v, n in views]
    if sum(map(len, texts)) <= AT_ONCE:
        blocks, owner = [_forward(m, parts)], [np.arange(len(texts))]
        best, mean, ties = _pool(blocks[0])
    else:  # the forward pass of a block is done again when its turn comes
        blocks, owner, best, mean, ties = [], [], [], [], []
        for i, (w, real) in enumerate(parts):
            cuts = [slice(k, min(len(w), k + BLOCK + 1)) for k in range(0, max(1, len(w) - 1), BLOCK)]
            most, sums, tied = np.full(HIDDEN, -np.inf, np.float32), np.zeros(HIDDEN), np.zeros(HIDDEN, np.float32)
            for cut in cuts:
                h = _forward(m, [(w[cut], real[cut])])["h"]
                top, count = h.max(0), (h == h.max(0)).sum(0).astype(np.float32)
                tied = np.where(top > most, count, np.where(top == most, tied + count, tied))
                most, sums = np.maximum(most, top), sums + h.sum(0)
            blocks += [(w[cut], real[cut]) for cut in cuts]
            owner += [np.array([i])] * len(cuts)
            best.append(most)
            mean.append(sums / max(1, len(w) - 1))
            ties.append(tied)
        best, mean, ties = np.stack(best), np.stack(mean), np.stack(ties)
    pool = np.concatenate([best, mean], 1).astype(np.float32)
    p = 1 / (1 + np.exp(-np.clip(pool @ m["out"] + m["out_b"], -30, 30)))
    dz = ((p - y) * weight / len(y)).astype(np.float32)
    g: Model = {"out": pool.T @ dz, "out_b": dz.sum(keepdims=True)}
    dpool = np.outer(dz, m["out"])
    dmean = dpool[:, HIDDEN:] / np.maximum(1, halves - 1)[:, None]
    dbest = dpool[:, :HIDDEN] / ties
    for block, i in zip(blocks, owner, strict=True):
        f = block if isinstance(block, dict) else _forward(m, [block])
        for name, d in _backward(m, f, dmean[i], dbest[i], best[i]).items():
            g[name] = g[name] + d if name in g else d
    return g


def _forward(m: Model, parts: list[tuple[np.ndarray, np.ndarray]]) -> dict:
    """What _backward needs of texts, or of a block of one, given as windows and how many of each half are real."""
    w, real = np.concatenate([v for v, _ in parts]), np.concatenate([n for _, n in parts])
    halves = np.array([len(v) for v, _ in parts])
    base = np.cumsum(halves) - halves
    x, a = activations(m, w, real)
    top = a.max(1)
    each = np.maximum(1, halves - 1)
    start = np.cumsum(each) - each
    first = np.repeat(base - start, each) + np.arange(each.sum())
    second = np.minimum(first + 1, np.repeat(base + halves - 1, each))
    feats = chunk_features(top, a.sum(1), real, first, second)
    pre = feats @ m["dense"] + m["dense_b"]
    return {"w": w, "x": x, "a": a, "top": top, "each": each, "start": start, "first": first, "second": second, "feats": feats, "pre": pre, "h": np.maximum(pre, 0)}


def _pool(f: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximum and mean over each text's chunks, and how many chunks have the maximum."""
    best = np.maximum.reduceat(f["h"], f["start"])
    ties = np.add.reduceat((f["h"] == np.repeat(best, f["each"], 0)).astype(np.float32), f["start"])
    return best, np.add.reduceat(f["h"], f["start"]) / f["each"][:, None], ties


def _backward(m: Model, f: dict, dmean: np.ndarray, dbest: np.ndarray, best: np.ndarray) -> Model:
    g: Model = {}
    a, top, each, first, second, feats = f["a"], f["top"], f["each"], f["first"], f["second"], f["feats"]
    dh = np.repeat(dmean, each, 0) + (f["h"] == np.repeat(best, each, 0)) * np.repeat(dbest, each, 0)
    dpre = (dh * (f["pre"] > 0)).astype(np.float32)
    g["dense"], g["dense_b"] = feats.T @ dpre, dpre.sum(0)
    df = dpre @ m["dense"].T
    dtop, dtotal = np.zeros_like(top), np.zeros_like(top)
    up = df[:, :FILTERS]
    left = top[first] >= top[second]
    np.add.at(dtop, first, up * left)
    np.add.at(dtop, second, up * ~left)
    n = feats[:, -1:] * (2 * HALF)
    np.add.at(dtotal, first, df[:, FILTERS : 2 * FILTERS] / n)
    np.add.at(dtotal, second, np.where((first == second)[:, None], 0, df[:, FILTERS : 2 * FILTERS] / n))
    at = a.argmax(1)
    da = np.repeat(dtotal[:, None, :], HALF, 1)
    rows, cols = np.indices(at.shape)
    da[rows, at, cols] += dtop
    da = (da * (a > 0)).reshape(-1, FILTERS)
    g["conv"], g["conv_b"] = f["x"].T @ da, da.sum(0)
    dx = (da @ m["conv"].T).reshape(-1, EMBED)
    flat = f["w"].reshape(-1)
    g["embed"] = np.stack([np.bincount(flat, dx[:, j], 256) for j in range(EMBED)], 1).astype(np.float32)
    return g


def remainder(doc_id, modulus: int):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus, F.lit(-1))


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, seed: int = SEED) -> Model:
    """Fits on at most ``rows`` labelled rows that aren't held out, those of the least seeded hash.

    Of several documents with one id the smallest text stands for it, so that
    the sample is bounded by the labels. Null ids and labels other than 0 and
    1 are left out; a document labelled both 0 and 1 counts as both.
    """
    known = labels.where("quality in (0, 1)").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).distinct()
    known = known.where("doc_id is not null").where(remainder("doc_id", 5) != 0)
    chosen = known.orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id", "quality").limit(rows)
    # a bounded dimension (``rows`` ids), so broadcast
    b = F.encode(F.coalesce("text", F.lit("")), "utf-8")
    joined = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")
    got = joined.groupBy("doc_id", "quality").agg(F.min(b).alias("text")).orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id", "quality").collect()
    return fit([bytes(r["text"]) for r in got], [r["quality"] for r in got], seed=seed)


def classify(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """docs (doc_id, text, ...) with all its columns, and _score (0 to 1) and _predicted (1 if _score >= threshold).

    Null texts count as empty; every text has a score. Repeated rows stay;
    earlier columns of these two names are replaced. An empty table gives no
    rows.
    """
    spark = docs.sparkSession
    docs = docs.drop("_score", "_predicted")
    ship(spark)
    shared = spark.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from statuta.llm import quality_cnn

        for batch in pieces(batches):
            texts = [(x or "").encode("utf-8", "replace") for x in batch.column(batch.schema.get_field_index("text")).to_pylist()]
            got = pa.array(quality_cnn.score_texts(shared.value, texts), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, got], names=[*batch.schema.names, "_score"])

    s = docs.mapInArrow(scored, StructType([*docs.schema.fields, StructField("_score", DoubleType())]))
    return s.withColumn("_predicted", F.when(F.col("_score") >= threshold, 1).otherwise(0))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return classify(docs.select("doc_id", "text"), model).select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), F.col("_score").alias("score"), F.col("_predicted").alias("predicted"))
