"""Language ID by multilingual mixture inference.

Training counts hashed byte n-grams per language over a bounded sample of the
labelled rows: about ``max_train`` rows shared evenly by the languages (at least
``MIN_TRAIN`` each, all rows of a rarer one), chosen by a hash of doc_id against
a threshold per language, so every labelled language is learned at every size.
A document's language proportions are the mixture weights that expectation-
maximisation finds over the n-gram likelihoods of its whole text; languages
are dropped from the set while the penalised likelihood (BIC) improves, and
the largest proportion of the set that is left names the language.

Rows: a null text or one without a letter is ``und`` with score 0; a null
doc_id is predicted and not held out; with nothing to learn from every row is
``und``.  Repeated rows give one row each; an empty table gives an empty result;
of equal shares the language that sorts first is named; other columns are not
read.  Texts of any length are judged whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import flat_bytes

BUCKETS = 1 << 14
MAX_TRAIN = 20_000
MIN_TRAIN = 200
EM_STEPS = 12

SCHEMA = "doc_id long, lang_pred string, score double, languages array<struct<lang:string,share:double>>"
LANGS_T = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))


def grams(data: np.ndarray) -> np.ndarray:
    """Hashed byte trigrams, A-Z folded."""
    d = data.astype(np.uint32)
    d = d + 32 * ((d >= 65) & (d <= 90)).astype(np.uint32)
    d = np.concatenate([[32], d, [32]]).astype(np.uint32)
    x = (d[:-2] << 16) | (d[1:-1] << 8) | d[2:]
    return ((x * np.uint32(2654435761)) >> np.uint32(32 - 14)).astype(np.int64)


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def threshold(n: int, most: int) -> int:
    """Largest 63-bit hash that is taken of a language with n rows, so that
    about ``most`` rows are, however many there are."""
    return (1 << 63) - 1 if n <= most else (most << 63) // n


def train(docs: DataFrame, max_train: int = MAX_TRAIN) -> tuple[list[str], np.ndarray]:
    """(languages, log p(gram | language)) from the labelled rows that are not
    held out.  The model has one row of ``BUCKETS`` numbers per language."""
    rows = docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (F.octet_length("text") > 0) & ~held_out(F.col("doc_id")))
    rows = rows.select("doc_id", "lang", "text")
    size = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not size:
        return [], np.zeros((0, BUCKETS))
    spark = docs.sparkSession
    share = [(lang, threshold(n, max(MIN_TRAIN, max_train // len(size)))) for lang, n in sorted(size.items())]
    # one row per language, as the model has
    rows = rows.join(F.broadcast(spark.createDataFrame(share, "lang string, most long")), "lang")
    rows = rows.filter(F.shiftrightunsigned(F.xxhash64("doc_id"), 1) <= F.col("most")).select("lang", "text")

    def count(batches):
        total: dict[str, np.ndarray] = {}
        for b in batches:
            data, offs = flat_bytes(b.column("text"))
            for i, lang in enumerate(b.column("lang").to_pylist()):
                got = total.setdefault(lang, np.zeros(BUCKETS, np.int64))
                got += np.bincount(grams(data[offs[i] : offs[i + 1]]), minlength=BUCKETS)
        for lang, c in total.items():
            nz = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(nz), pa.string()), pa.array(nz.astype(np.int32)), pa.array(c[nz])], names=["lang", "g", "n"]
            )

    counts = rows.mapInArrow(count, "lang string, g int, n long").groupBy("lang", "g").agg(F.sum("n").alias("n"))
    got = counts.toPandas()
    langs = sorted(got["lang"].unique())
    if langs != sorted(size):
        raise ValueError(f"no training row was taken of {sorted(set(size) - set(langs))}")
    table = np.zeros((len(langs), BUCKETS))
    for i, lang in enumerate(langs):
        own = got[got["lang"] == lang]
        table[i, own["g"].to_numpy()] = own["n"].to_numpy()
    table += 0.5
    return langs, np.log(table / table.sum(axis=1, keepdims=True))


def mixture(like: np.ndarray, weight: np.ndarray, steps: int = EM_STEPS) -> tuple[np.ndarray, float]:
    """Mixture shares of the columns of ``like`` (grams x languages) by EM and
    the log-likelihood they reach."""
    share = np.full(like.shape[1], 1.0 / like.shape[1])
    n = weight.sum()
    for _ in range(steps):
        share = share * (like.T @ (weight / (like @ share))) / n
    return share, float(weight @ np.log(like @ share))


def infer(counts: np.ndarray, model: np.ndarray) -> tuple[list[int], np.ndarray]:
    """The language set of least penalised likelihood and its shares."""
    at = np.flatnonzero(counts)
    weight = counts[at].astype(float)
    logp = model[:, at].T
    like = np.exp(logp - logp.max(axis=1, keepdims=True))
    penalty = 0.5 * np.log(max(2.0, weight.sum()))
    keep = list(range(model.shape[0]))
    share, best = mixture(like, weight)
    while len(keep) > 1:
        drop = int(np.argmin(share))
        rest = keep[:drop] + keep[drop + 1 :]
        s, ll = mixture(like[:, rest], weight)
        if ll + penalty < best:
            break
        keep, share, best = rest, s, ll
    return keep, share


def judge(texts: pa.Array, langs: list[str], model: np.ndarray) -> tuple[list, list, list]:
    """Predicted language, its share and the mixture of each text."""
    data, offs = flat_bytes(texts)
    pred, score, mix = [], [], []
    for i, t in enumerate(texts.to_pylist()):
        if not langs or t is None or not any(map(str.isalpha, t)):
            pred.append("und"), score.append(0.0), mix.append([])
            continue
        keep, share = infer(np.bincount(grams(data[offs[i] : offs[i + 1]]), minlength=BUCKETS), model)
        top = int(np.argmax(share))
        pred.append(langs[keep[top]])
        score.append(min(1.0, float(share[top])))
        mix.append([{"lang": langs[k], "share": float(s)} for k, s in zip(keep, share, strict=True)])
    return pred, score, mix


def predict(docs: DataFrame, langs: list[str], model: np.ndarray) -> DataFrame:
    """lang_pred, score (share of that language) and the inferred mixture."""

    def run(batches):
        for b in batches:
            pred, score, mix = judge(b.column("text"), langs, model)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(mix, LANGS_T)],
                names=["doc_id", "lang_pred", "score", "languages"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def identify(docs: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    langs, model = train(docs, max_train)
    got = predict(docs, langs, model)
    return got.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "languages")


def keep_identified(docs: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """The rows of ``docs`` whose language is not ``und``, all columns."""
    langs, model = train(docs, max_train)

    def run(batches):
        for b in batches:
            pred, _, _ = judge(b.column("text"), langs, model)
            yield b.filter(pa.array([p != "und" for p in pred], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
