"""Quality classifier by compression with labelled dictionaries.

Two zstandard dictionaries are built, one from good and one from bad
labelled text.  A whole text is compressed under both, in pieces of
``PIECE`` bytes so that the dictionary counts throughout; how much shorter it
gets under the good one, per byte and relative to its compressed size, is the
evidence, and a logistic calibration fitted on further labelled texts turns
it into a probability.  Scores see nothing but the text.

Training reads a bounded sample of the labelled rows (the only bound here):
at most ``train_rows`` texts of each label, one piece of each, for the
dictionaries, and at most ``calibration_rows`` whole texts, which Spark
scores, for the calibration; both are chosen by a hash of the id.  Scoring
covers every row.

Defined results: a null text counts as empty; empty texts get the
calibration's value at no evidence; without labels of both kinds every score
is the share of label 1 (0.5 without labels); repeated labels of an id count
once each; repeated rows give a row each; empty tables work; further columns
are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bucket_of, id_text, ship

PIECE = 4096
DICT_BYTES = 256 << 10
TRAIN_ROWS = 3000
CALIBRATION_ROWS = 12000
LEVEL = 3
THRESHOLD = 0.3


@dataclass
class QualityModel:
    bad: bytes
    good: bytes
    weights: tuple[float, ...]

    def score(self, evidence: np.ndarray) -> np.ndarray:
        z = np.clip(evidence @ np.array(self.weights), -35, 35)
        return 1 / (1 + np.exp(-z))


class Evidence:
    """Compresses texts under both dictionaries."""

    def __init__(self, bad: bytes, good: bytes):
        self.codecs = []
        for d in (bad, good):
            if not d:
                continue
            held = zstandard.ZstdCompressionDict(d)
            held.precompute_compress(level=LEVEL)
            self.codecs.append(zstandard.ZstdCompressor(dict_data=held, level=LEVEL, write_checksum=False,
                                                        write_content_size=False, write_dict_id=False))

    def of(self, text: str) -> tuple[float, ...]:
        """1, size difference per byte, the same relative to the smaller
        compressed size, and bits of logarithm of the compression rate."""
        b = text.encode("utf-8", "surrogatepass")
        if not b or len(self.codecs) < 2:
            return 1.0, 0.0, 0.0, 0.0
        bad, good = (sum(len(c.compress(b[k:k + PIECE])) for k in range(0, len(b), PIECE)) for c in self.codecs)
        floor = 6 * -(-len(b) // PIECE)  # what a frame takes with nothing in it
        bad, good = max(bad - floor, 1), max(good - floor, 1)
        return 1.0, 10 * (bad - good) / len(b), 10 * (bad - good) / min(bad, good), math.log2(min(bad, good) / len(b))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[float, ...]:
    """Weights of a logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        grad = x.T @ (y - p) - ridge * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), grad)
        norm = float(np.abs(step).max())
        w += step * min(1.0, 5 / max(norm, 1e-9))
        if norm < 1e-8:
            break
    return tuple(float(v) for v in w)


def _dictionary(samples: list[bytes]) -> bytes:
    total = sum(map(len, samples))
    if not samples:
        return b""
    try:
        return zstandard.train_dictionary(min(DICT_BYTES, max(1024, total // 4)), samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: the text itself serves as raw content
        return b"\n".join(samples)[-DICT_BYTES:].ljust(8, b"\n")


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, calibration_rows: int = CALIBRATION_ROWS,
        id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id", label_col: str = "quality",
        folds: int = 5, held_fold: int = 0) -> QualityModel:
    """Fit on labelled rows outside the held fold (crc32 of the id's text)."""
    marked = (labels.where(bucket_of(label_id, folds) != held_fold)
              .select(F.col(f"`{label_id}`").cast("long").alias("lid"), F.col(f"`{label_col}`").cast("int").alias("y"))
              .where(F.col("y").isin(0, 1) & F.col("lid").isNotNull())
              .withColumn("at", F.xxhash64("lid")).withColumn("half", F.expr("pmod(xxhash64(lid, 1), 2)")))
    # bounded samples of ids, chosen before any text is read
    train = marked.where("half = 0").where("y = 0").orderBy("at", "lid").limit(train_rows).unionByName(
        marked.where("half = 0").where("y = 1").orderBy("at", "lid").limit(train_rows))
    check = marked.where("half = 1").orderBy("at", "lid").limit(calibration_rows)
    texts = id_text(docs, id_col, text_col)
    piece = F.expr(f"substring(text, 1 + cast(pmod(at, greatest(length(text) - {PIECE} + 1, 1)) as int), {PIECE})")
    rows = texts.join(F.broadcast(train), F.col("id") == F.col("lid")).select("id", "y", piece.alias("p")) \
        .groupBy("id", "y").agg(F.min("p").alias("p")).orderBy("id", "y").collect()  # at most 2 * train_rows pieces
    parts = [[r["p"].encode("utf-8", "surrogatepass")[:PIECE] for r in rows if r["y"] == y and r["p"]] for y in (0, 1)]
    dicts = [_dictionary(p) for p in parts]
    shared = docs.sparkSession.sparkContext.broadcast(tuple(dicts))

    def measure(batches):
        evidence = Evidence(*shared.value)
        for batch in batches:
            found = [evidence.of(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("y"),
                                              pa.array(found, pa.list_(pa.float64()))], ["id", "y", "e"])
    seen = (texts.join(F.broadcast(check), F.col("id") == F.col("lid")).select("id", "y", "text")
            .mapInArrow(measure, "id long, y int, e array<double>").groupBy("id", "y").agg(F.min("e").alias("e"))
            .orderBy("id", "y").collect() if all(dicts) else [])  # at most calibration_rows rows of four numbers
    y = np.array([r["y"] for r in seen], float)
    if len(set(y)) < 2:
        every = [r["y"] for r in rows] or [0, 1]
        share = min(max(sum(every) / len(every), 0.001), 0.999)
        return QualityModel(b"", b"", (math.log(share / (1 - share)), 0.0, 0.0, 0.0))
    return QualityModel(*dicts, fit_logistic(np.array([r["e"] for r in seen]), y))


def score(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, score`` of every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        evidence = Evidence(shared.value.bad, shared.value.good)
        for batch in batches:
            found = np.array([evidence.of(t.as_py()) for t in batch.column("text")]).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(shared.value.score(found))], ["id", "score"])
    return id_text(docs, id_col, text_col).mapInArrow(run, "id long, score double")


def drop_rejected(docs: DataFrame, model: QualityModel, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` scored ``threshold`` or higher, with all their
    columns: texts are scored where they stand and nothing is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    ship(docs.sparkSession)
    at = docs.columns.index(text_col)

    def run(batches):
        evidence = Evidence(shared.value.bad, shared.value.good)
        for batch in batches:
            found = np.array([evidence.of(t.as_py() or "") for t in batch.column(at)]).reshape(-1, 4)
            yield batch.filter(pa.array(shared.value.score(found) >= threshold))
    return docs.mapInArrow(run, docs.schema)


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score(docs, fit(docs, labels))
    return scored.select(F.col("id").alias("doc_id"), (bucket_of("id", 5) == 0).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
