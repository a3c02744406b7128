"""Toxicity by a classifier chain of linear models.

The chain's categories are learned one after the other: the text names a marker of toxicity, names
several, is toxic. Each model gets, besides the terms of the text, the probabilities of all earlier
categories. In training these are out-of-fold predictions, so that a later model sees earlier ones as
wrong as they will be on new texts. Terms are hashes of words and of word beginnings; the models keep
those whose presence goes with toxic labels. Prediction counts nothing else than which terms occur.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketmill.llm.arrays import (
    LOWER,
    mixed,
    owners,
    range_hashes,
    runs,
    slices,
    text_bytes,
)

#: Labelled documents that a model is fitted on at most; beyond, a random sample of this size.
TRAINING_ROWS = 8_000
#: Terms that the models keep at most.
TERMS = 512
#: Documents of the training sample that a term occurs in at least.
TERM_DOCS = 3
#: Standard errors by which a term's share in toxic documents exceeds that in others.
TERM_Z = 4.0
FOLDS = 5
RIDGE = 1.0
THRESHOLD = 0.5
#: Lengths in bytes of word beginnings that are terms, besides whole words.
BEGINNINGS = (4, 5, 6, 7, 8)
CATEGORIES = ("marked", "severe", "toxic")
#: Distinct markers of a severe text.
SEVERE = 3

#: Letters a-z and all bytes of characters beyond ASCII.
LETTER = np.zeros(256, bool)
LETTER[97:123] = LETTER[128:] = True


def term_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(term, text) for every word and word beginning, in no order, repeats included."""
    data, offsets = text_bytes(column)
    data = LOWER[data]
    starts, ends = runs(data, offsets, LETTER)
    owner = owners(offsets[:-1], starts)
    terms, texts = [range_hashes(data, starts, ends)], [owner]
    for n in BEGINNINGS:
        longer = np.flatnonzero(ends - starts > n)
        hashes = range_hashes(data, starts[longer], starts[longer] + n)
        terms.append(hashes ^ np.uint64(n))  # a beginning is another term than the same word
        texts.append(owner[longer])
    return np.concatenate(terms), np.concatenate(texts)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE, rounds: int = 25) -> np.ndarray:
    """Weights and, last, the bias of a logistic regression, by Newton steps. Equal rows, of which most
    have no term at all, count as one row with a weight."""
    x = np.ascontiguousarray(np.hstack([x, np.ones((len(x), 1))]))
    rows = x.view([("", f"V{x.shape[1] * 8}")]).ravel()
    _, one, which = np.unique(rows, return_index=True, return_inverse=True)
    n = np.bincount(which).astype(float)
    positive = np.bincount(which, weights=y)
    x = x[one]
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = sigmoid(x @ w)
        gradient = x.T @ (n * p - positive) + penalty * w
        curve = (x * (n * p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class Chain:
    terms: np.ndarray  # sorted hashes
    weights: list[np.ndarray]  # of category k: terms, k earlier probabilities, bias

    def present(self, column: pa.Array) -> np.ndarray:
        """(texts, terms) 0 or 1: which terms each text has."""
        return presence(self.terms, *term_hashes(column), len(column))

    def probabilities(self, present: np.ndarray) -> np.ndarray:
        """(texts, categories), each category fed by those before it."""
        x = present
        for w in self.weights:
            x = np.hstack([x, sigmoid(x @ w[:-1] + w[-1])[:, None]])
        return x[:, present.shape[1] :]


def presence(terms: np.ndarray, hashes: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros((n, len(terms)))
    if len(terms) and len(hashes):
        at = np.searchsorted(terms, hashes)
        at[at == len(terms)] = 0
        hit = terms[at] == hashes
        out[owner[hit], at[hit]] = 1
    return out


def distinct_terms(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(term, text) of each term that a text has, once; a slice of the texts at a time."""
    at = 0
    for part in slices(column):
        hashes, owner = term_hashes(part)
        both = mixed(hashes + (owner.astype(np.uint64) << np.uint64(32)))
        _, one = np.unique(both, return_index=True)
        yield hashes[one], owner[one] + at
        at += len(part)


def clearly_toxic(there: np.ndarray, bad: np.ndarray, n: int, n_bad: int) -> np.ndarray:
    """How many standard errors a term's share in toxic texts exceeds that in others; 0 if the term is
    rare or the shares differ less than tenfold. Added halves keep few counts from certainty."""
    share, other = (bad + 0.5) / (n_bad + 1), (there - bad + 0.5) / (n - n_bad + 1)
    spread = np.sqrt(share * (1 - share) / n_bad + other * (1 - other) / (n - n_bad))
    z = (share - other) / np.maximum(spread, 1e-12)
    return np.where((there >= TERM_DOCS) & (share > 10 * other) & (z > TERM_Z), z, 0.0)


def candidates(column: pa.Array, toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sorted terms of TERM_DOCS toxic texts or more; the place among them and the text of each one there is). Only
    toxic texts are counted term by term; of all texts, only what these terms hit is held, in 8 bytes each."""
    seen = [terms for terms, _ in distinct_terms(column.filter(pa.array(toxic)))]
    terms, counts = np.unique(np.concatenate([np.zeros(0, np.uint64), *seen]), return_counts=True)
    terms = terms[counts >= TERM_DOCS]
    where, texts = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
    for found, owner in distinct_terms(column) if len(terms) else ():
        at = np.searchsorted(terms, found)
        at[at == len(terms)] = 0
        hit = terms[at] == found
        where.append(at[hit].astype(np.int32))
        texts.append(owner[hit].astype(np.int32))
    return terms, np.concatenate(where), np.concatenate(texts)


def informative(n_terms: int, where: np.ndarray, texts: np.ndarray, toxic: np.ndarray, own: np.ndarray) -> np.ndarray:
    """The places of the TERMS candidates that go clearest with toxic labels, as the texts `own` alone show it."""
    mine = own[texts]
    there = np.bincount(where[mine], minlength=n_terms)
    bad = np.bincount(where[mine & toxic[texts]], minlength=n_terms)
    z = clearly_toxic(there, bad, int(own.sum()), int(toxic[own].sum()))
    return np.sort(np.argsort(-z, kind="stable")[: min(TERMS, int((z > 0).sum()))])


def columns_of(chosen: np.ndarray, n_terms: int, where: np.ndarray, texts: np.ndarray, n: int) -> np.ndarray:
    """(texts, chosen) 0 or 1, in a byte each."""
    column = np.full(n_terms, -1)
    column[chosen] = np.arange(len(chosen))
    hit = column[where] >= 0
    out = np.zeros((n, len(chosen)), np.uint8)
    out[texts[hit], column[where[hit]]] = 1
    return out


def targets_of(x: np.ndarray, toxic: np.ndarray) -> list[np.ndarray]:
    """The categories, made from the one label there is: toxic texts with any of the terms, those with SEVERE or
    more of them, and all toxic ones."""
    named = x.sum(axis=1)
    return [toxic & (named > 0), toxic & (named >= SEVERE), toxic]


def fit(texts: list[str | None], toxic: list[bool]) -> Chain:
    """The chain for labelled texts. Without texts of both kinds, it finds nothing toxic.

    What a model gets of earlier categories comes from models that have not seen the text: for each fold, terms are
    chosen, categories made and weights fitted on the other folds alone."""
    y, n = np.array(toxic, bool), len(texts)
    column = pa.array(texts, pa.large_string())
    if not y.any() or y.all():
        return Chain(np.zeros(0, np.uint64), [np.append(np.zeros(k), -30.0) for k in range(3)])
    terms, *held = candidates(column, y)
    fold, folds = np.arange(n) % FOLDS, []
    for k in range(FOLDS):
        others = fold != k
        if y[others].any() and not y[others].all():
            x = columns_of(informative(len(terms), *held, y, others), len(terms), *held, n)
            folds.append((others, x, targets_of(x, y)))
    chosen = informative(len(terms), *held, y, np.ones(n, bool))
    x = columns_of(chosen, len(terms), *held, n)
    weights, earlier = [], np.zeros((n, 0))
    for k, target in enumerate(targets_of(x, y)):
        weights.append(logistic(np.hstack([x, earlier]), target))
        out_of_fold = np.zeros(n)
        for others, own, targets in folds:
            both = np.hstack([own, earlier])
            w = logistic(both[others], targets[k][others])
            out_of_fold[~others] = sigmoid(both[~others] @ w[:-1] + w[-1])
        earlier = np.hstack([earlier, out_of_fold[:, None]])
    return Chain(terms[chosen], weights)


def train(docs: DataFrame, labels: DataFrame, text: str = "text", id: str = "doc_id",
          label: str = "toxic", rows: int = TRAINING_ROWS) -> Chain:
    """A chain fitted on labelled documents: all, or a random sample of about `rows` of them. One task
    fits it; the driver gets the weights alone.

    Rows with a null id, label or text don't take part. An id that has both labels is trained with
    both; of several texts under one id, the smallest is used. The sample goes by a hash of the id, so that
    it is the same in each run.
    """
    known = labels.select(F.col(id).alias("id"), (F.col(label) > 0).alias("toxic")).dropna()
    share = min(1.0, rows / max(1, known.count()))
    drawn = F.pmod(F.xxhash64("id", F.lit("train")), F.lit(1 << 30)) < share * (1 << 30)
    sampled = known.filter(drawn).distinct()
    found = (
        docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
        .filter("text is not null")
        .join(F.broadcast(sampled), "id")
        .groupBy("id", "toxic")
        .agg(F.min("text").alias("text"))
        .select("id", "text", "toxic")
        .repartition(1)
    )

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(
            row for b in batches for row in zip(*(b.column(c).to_pylist() for c in range(3)))
        )
        chain = fit([r[1] for r in rows], [r[2] for r in rows])
        yield pa.record_batch([pa.array([pickle.dumps(chain)], pa.binary())], ["chain"])

    row = found.mapInArrow(fitted, "chain binary").first()
    return pickle.loads(row["chain"]) if row else fit([], [])


def toxicity(docs: DataFrame, chain: Chain, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """docs with the probabilities p_marked, p_severe, p_toxic and is_toxic (p_toxic >= threshold).

    Columns of these names are replaced. Whole texts count. Null and empty texts have no terms, and get
    what the chain gives for none. Repeated rows get equal results, null ids and further columns do no
    harm, an empty table stays empty.
    """
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    fields = [f"p_{name}" for name in CATEGORIES]

    @F.arrow_udf("struct<" + ", ".join(f"{f}: double" for f in fields) + ">")
    def predicted(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = shared.value
        for column in columns:
            parts = [own.probabilities(own.present(part)) for part in slices(column)]
            p = np.concatenate([np.zeros((0, len(fields))), *parts])
            yield pa.StructArray.from_arrays([pa.array(p[:, k]) for k in range(len(fields))], fields)

    rows = docs.withColumn("_toxicity", predicted(F.col(text)))
    rows = rows.withColumns({f: F.col(f"_toxicity.{f}") for f in fields}).drop("_toxicity")
    return rows.withColumn("is_toxic", F.col("p_toxic") >= threshold)
