"""Rates that mix documents to target weights of soft domains.

A classifier learnt from the label table gives each document the posterior of each domain, so
a document counts for several domains in part. Nonnegative rates (expected copies) near one
are fitted so that the expected tokens of each domain meet their targets: least squares, solved
through its dual by damped Newton steps on one multiplier per domain. Each pass sums gradient
and curvature over all documents; only vectors and matrices of the number of domains reach the
driver.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txflow.llm.common import labelled_sample, stored, texts_in_bites
from txflow.llm.jaccard import _LOWERED
from txflow.llm.substrings import _word_hashes

#: Bounds of the fitted part: labelled rows and hashed word features.
EXAMPLES, FEATURES = 4000, 1 << 15
#: Pull of the rates towards one, against a unit share of tokens.
PULL = 1e-4
#: Share of all tokens wanted of each domain: quality 0 or 1, toxic 0 or 1.
TARGETS = {"q0t0": 0.05, "q0t1": 0.01, "q1t0": 0.88, "q1t1": 0.06}


def _features(text: str | None) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of words, and the text's hashed lower-cased words with root shares."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    _, h = _word_hashes(_LOWERED[data])
    at, n = np.unique((h & np.uint64(FEATURES - 1)).astype(np.int32), return_counts=True)
    return len(h), at, np.sqrt(n / max(1, len(h))).astype(np.float32)


class Classifier:
    """Multinomial logistic regression on hashed words, fitted by accelerated gradient steps."""

    def __init__(self, rows: list, domains: list[str], steps: int = 200, penalty: float = 1e-4):
        self.domains = domains
        k = len(domains)
        at = {d: i for i, d in enumerate(domains)}
        y = np.array([at[r.domain] for r in rows], np.int64)
        terms = [np.frombuffer(r.terms, np.int32) for r in rows]
        values = [np.frombuffer(r.shares, np.float32) for r in rows]
        self.idf = np.ones(FEATURES)
        if rows:
            df = np.bincount(np.concatenate(terms), minlength=FEATURES)
            self.idf = np.where(df > 0, np.log((1 + len(rows)) / (1 + df)) + 0.1, 0.0)
        n = np.bincount(y, minlength=k) + 1.0
        self.bias = np.log(n / n.sum())
        self.weight = np.zeros((FEATURES, k))
        if not rows:
            return
        # Only features of the sample have weights; gather them densely numbered.
        used, column = np.unique(np.concatenate([*terms, np.zeros(0, np.int32)]), return_inverse=True)
        row = np.repeat(np.arange(len(rows)), [len(t) for t in terms])
        x = np.concatenate(values) * self.idf[used][column]
        norm = np.sqrt(np.bincount(row, x * x, len(rows)))
        x /= np.maximum(norm, 1e-9)[row]
        goal = np.eye(k)[y]
        w, b = np.zeros((len(used), k)), self.bias.copy()
        ahead, momentum, step = w.copy(), 1.0, 4.0
        for _ in range(steps):
            margin = np.stack([np.bincount(row, x * ahead[column, j], len(rows)) for j in range(k)], 1) + b
            p = _softmax(margin)
            error = (p - goal) / len(rows)
            slope = np.stack([np.bincount(column, x * error[row, j], len(used)) for j in range(k)], 1) + penalty * ahead
            new = ahead - step * slope
            b = b - step * error.sum(0)
            faster = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
            ahead = new + (momentum - 1) / faster * (new - w)
            w, momentum = new, faster
        self.weight[used], self.bias = w, b

    def posteriors(self, texts: list) -> tuple[list[int], np.ndarray]:
        tokens, margins = [], np.tile(self.bias, (len(texts), 1))
        for i, text in enumerate(texts):
            n, at, share = _features(text)
            tokens.append(n)
            x = share * self.idf[at]
            norm = np.sqrt(x @ x)
            if norm:
                margins[i] += (x / norm) @ self.weight[at]
        return tokens, _softmax(margins)


#: A share of the tokens that the fit may be off by.
SETTLED = 1e-6


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def fit(docs: DataFrame, labels: DataFrame, domains: list[str], examples: int = EXAMPLES) -> Classifier:
    """Learn domains ``q<quality>t<toxic>`` from at most ``examples`` labelled rows that are not
    held out, those whose ids hash lowest; features are computed where the texts are."""
    domain = F.concat(F.lit("q"), F.col("quality").cast("string"), F.lit("t"), F.col("toxic").cast("string"))
    known = F.when(domain.isin(domains), domain)
    sample = labelled_sample(docs, labels, known, examples).select("text", F.col("y").alias("domain"))

    def run(batches):
        for part, texts in texts_in_bites(batches, "text"):
            found = [_features(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(1),
                    pa.array([at.tobytes() for _, at, _ in found], pa.binary()),
                    pa.array([share.tobytes() for _, _, share in found], pa.binary()),
                ],
                ["domain", "terms", "shares"],
            )

    return Classifier(sample.mapInArrow(run, "domain string, terms binary, shares binary").collect(), domains)


def predict(docs: DataFrame, model: Classifier) -> DataFrame:
    """``docs`` without text, with n_tokens (words) and posteriors (in the order of domains)."""
    rest = [c for c in docs.columns if c not in ("text", "n_tokens", "posteriors")]
    added = T.StructType.fromDDL("n_tokens long, posteriors array<double>")
    schema = T.StructType([*docs.select(*rest).schema.fields, *added.fields])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for part, texts in texts_in_bites(batches, "text"):
            tokens, p = shared.value.posteriors(texts)
            kept = [part.column(i) for i, c in enumerate(part.schema.names) if c != "text"]
            kept += [pa.array(tokens, pa.int64()), pa.array(list(p), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(kept, names=schema.names)

    return docs.select(*rest, "text").mapInArrow(run, schema)


def fit_rates(parts: DataFrame, shares: list[float], pull: float = PULL, passes: int = 40, close: float = 1e-9) -> np.ndarray:
    """The multipliers ``m`` of the domains: a document's rate is max(0, 1 - posteriors . m).

    ``parts`` has n_tokens and posteriors. The fit minimises half the squared distance of the
    expected domain shares to ``shares`` plus ``pull`` / 2 times the token-weighted squared
    distance of the rates to one, over rates of at least zero. Each pass projects every rate,
    sums the domains' gradient and the curvature of the documents with positive rates, and
    takes a Newton step on the multipliers, halved until it gains. A fit whose slope is above
    ``SETTLED`` in the end is an error.
    """
    k = len(shares)
    total = parts.agg(F.sum("n_tokens")).first()[0] or 0
    if not total:
        return np.zeros(k)
    goal = np.array(shares)

    def look(m: np.ndarray):
        p = [F.col("posteriors")[i] for i in range(k)]
        rate = F.greatest(F.lit(0.0), 1 - sum(x * float(y) for x, y in zip(p, m, strict=True)))
        w = F.col("n_tokens") / float(total)
        sums = [F.sum(w * rate * x) for x in p]
        curve = [F.sum(F.when(rate > 0, w * p[i] * p[j]).otherwise(0.0)) for i in range(k) for j in range(i + 1)]
        row = parts.agg(F.sum(w * rate * rate), *sums, *curve).first()
        s, c = np.array(row[1 : k + 1]), np.zeros((k, k))
        c[np.tril_indices(k)] = row[k + 1 :]
        c = c + np.tril(c, -1).T
        value = pull / 2 * m @ m + goal @ m + row[0] / 2
        return value, pull * m + goal - s, c

    m = np.zeros(k)
    value, slope, curve = look(m)
    for _ in range(passes):
        if np.abs(slope).max() < close:
            break
        step = np.linalg.solve(curve + pull * np.eye(k), slope)
        size = 1.0
        while True:
            new = look(m - size * step)
            if new[0] <= value - 1e-4 * size * (slope @ step) or size < 1e-6:
                break
            size /= 2
        if new[0] >= value:
            break
        m, (value, slope, curve) = m - size * step, new
    if np.abs(slope).max() > SETTLED:
        raise RuntimeError(f"rates did not settle in {passes} passes: the slope is still {np.abs(slope).max():.3g}")
    return m


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, examples: int = EXAMPLES) -> DataFrame:
    """``docs`` (doc_id, text; other columns but text kept, own results replaced) with n_tokens,
    domain (the likeliest), posteriors and rate.

    ``targets`` are the wanted shares of all tokens by domain; they need not sum to one. Null
    and empty texts have no tokens and the sample's domain shares; their rate follows the same
    rule. Without labelled rows posteriors are even. Without tokens all rates are one. Repeated
    rows stay and have equal rates. The fit runs on numbers written once, not on texts.
    """
    targets = targets or TARGETS
    domains = sorted(targets)
    model = fit(docs, labels, domains, examples)
    parts = stored(predict(docs.drop("n_tokens", "posteriors", "domain", "rate"), model), "posteriors")
    m = fit_rates(parts, [targets[d] for d in domains])
    p = [F.col("posteriors")[i] for i in range(len(domains))]
    best = F.array_position("posteriors", F.array_max("posteriors")).cast("int")
    return parts.withColumn("domain", F.element_at(F.array(*map(F.lit, domains)), best)).withColumn(
        "rate", F.greatest(F.lit(0.0), 1 - sum(x * float(y) for x, y in zip(p, m, strict=True)))
    )
