"""Quality classifier with hierarchical empirical Bayes over sites.

Document evidence: a logistic regression on a dozen figures of the text (length, letter, case, digit and symbol shares,
repetition).  It is fitted by Newton's method on a bounded sample of labelled documents (about ``FIT_ROWS``, chosen by the
hash of their id): the only rows that reach the driver.

Site evidence: every document adds its label, or else its own probability, to its path (section of a host) and host.  A
path's mean is shrunk toward its host's and a host's toward the global mean, each with the prior strength that the spread
of means at that level supports (method of moments from grouped sums), so sparse sites fall back on the level above.  A
labelled document's own label is taken out of its site's sums before it is judged.

A document's final log-odds are its own plus the shift of its site's from the global mean; it is kept at ``threshold``.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regfuse.llm.common import ascii_words, sampled, texts_of, written

FIT_ROWS, RIDGE, THRESHOLD = 20_000, 1.0, 0.5
_SYMBOLS, _STOPS, _MARKUP = list(b"#$%&*"), list(b",.:;?"), list(b"<=>/_{}")


def figures(text: bytes | None) -> list[float]:
    """The figures the document classifier sees; for null or empty text all are zero."""
    text = text or b""
    words = ascii_words(text)
    if not words:
        return [0.0] * N_FIGURES
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    n, chars, lines = len(words), len(text), text.split(b"\n")
    upper, letters = counts[65:91].sum(), counts[65:91].sum() + counts[97:123].sum() + counts[128:].sum()
    seen = Counter(words)
    return [
        float(x)
        for x in (
            np.log1p(n), chars / n, upper / max(1, letters), counts[48:58].sum() / chars, counts[33] / n, counts[124] / n,
            counts[_SYMBOLS].sum() / n, counts[_STOPS].sum() / n, counts[10] / n, len(seen) / n, len(set(lines)) / len(lines),
            counts[128:].sum() / chars, max(seen.values()) / n, counts[_MARKUP].sum() / chars,
        )
    ]


N_FIGURES = 14


def _measure(batches):
    for batch in batches:
        found = [figures(t) for t in texts_of(batch.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("doc_id", "host", "path")), pa.array(found, pa.list_(pa.float64()))],
            names=["doc_id", "host", "path", "x"],
        )


def fit(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE) -> list[float]:
    """Ridge-penalised logistic regression; the intercept first, weights for the raw figures.  Without both classes the
    log-odds of the (smoothed) share of good documents alone."""
    good = (y.sum() + 0.5) / (len(y) + 1.0)
    if len(y) == 0 or y.min() == y.max():
        return [float(np.log(good / (1 - good)))] + [0.0] * N_FIGURES
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.c_[np.ones(len(x)), (x - mean) / scale]
    penalty = np.diag([1e-6] + [ridge] * N_FIGURES)
    w = np.zeros(N_FIGURES + 1)
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + penalty, z.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    raw = w[1:] / scale
    return [float(w[0] - (raw * mean).sum()), *map(float, raw)]


def _logit(p):
    p = F.greatest(F.least(p, F.lit(1 - 1e-6)), F.lit(1e-6))
    return F.log(p / (1 - p))


def prior_strength(groups: DataFrame, n: str, s: str, parent: str):
    """Method-of-moments strength of a Beta prior about each group's parent mean: how many documents the parent counts
    for.  One row of sums, whatever the number of groups; strong (little shrinking evidence) when groups do not differ."""
    m, spread = F.col(parent), F.col(parent) * (1 - F.col(parent))
    row = groups.where(F.col(n) > 1).agg(
        F.sum(F.col(n) * F.pow(F.col(s) / F.col(n) - m, 2)).alias("between"),
        F.sum(spread).alias("noise"), F.sum(F.col(n) * spread).alias("weight"),
    ).first()
    if row.between is None or not row.weight:
        return 1e6
    # E[n (mean - m)^2] = spread + (n - 1) * spread / (strength + 1)
    excess = row.between - row.noise
    return 1e6 if excess <= 0 else max(0.1, min(1e6, (row.weight - row.noise) / excess - 1))


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host=None, path=None,
          label_col: str = "quality", threshold: float = THRESHOLD, fit_rows: int = FIT_ROWS) -> DataFrame:
    """One row per input row: doc_id, host, path, doc_score (probability from the text alone), site_score (the site's
    shrunk mean), score (both together), kept (score >= ``threshold``).

    ``host`` and ``path`` are columns of ``docs`` (default: null, one site for all).  ``labels``: id and 0/1 label; a row
    with a null id or a label other than 0 or 1 is ignored, of several for an id the mean counts, and 0.5 counts as
    none.  Null or empty text: all figures zero, judged like any other.  Rows that share a doc_id are judged each by its
    own text; a null doc_id has no label.  No labels at all: every score is about 0.5.  Other columns are ignored; an
    empty table gives an empty result.
    """
    none = F.lit(None).cast("string")
    docs = docs.select(
        docs[id_col].cast("bigint").alias("doc_id"), docs[text_col].alias("text"),
        (none if host is None else host.cast("string")).alias("host"), (none if path is None else path.cast("string")).alias("path"),
    )
    measured = written(docs.mapInArrow(_measure, "doc_id bigint, host string, path string, x array<double>"))
    label = labels[label_col].cast("int")
    labels = labels.where(labels[id_col].isNotNull() & label.isin(0, 1)).groupBy(labels[id_col].cast("bigint").alias("doc_id"))
    labels = labels.agg(F.avg(label).alias("y")).where("y <> 0.5").select("doc_id", F.round("y").alias("y"))
    known = written(measured.join(labels, "doc_id", "left"))
    sample = sorted(sampled(known.where("y is not null"), fit_rows, "doc_id").select("x", "y").collect())
    w = fit(np.array([r.x for r in sample]).reshape(-1, N_FIGURES), np.array([r.y for r in sample]))

    logit = F.aggregate(
        F.zip_with("x", F.array(*map(F.lit, w[1:])), lambda a, b: a * b), F.lit(w[0]), lambda acc, v: acc + v
    )
    judged = known.withColumn("logit", logit).withColumn("doc_score", 1 / (1 + F.exp(-F.col("logit"))))
    judged = written(judged.withColumn("evidence", F.coalesce("y", "doc_score")).drop("x"))
    paths = written(
        judged.groupBy("host", "path").agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum("evidence").alias("s"))
    )
    hosts = written(paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("s").alias("host_s")))
    total = hosts.agg(F.sum("host_n").alias("n"), F.sum("host_s").alias("s")).first()
    base = (total.s + 0.5) / (total.n + 1.0) if total.n else 0.5
    hosts = hosts.withColumn("base", F.lit(base))
    k_host = prior_strength(hosts, "host_n", "host_s", "base")
    host_mean = (F.col("host_s") + k_host * base) / (F.col("host_n") + k_host)
    same = paths.alias("p").join(hosts.alias("h"), F.col("p.host").eqNullSafe(F.col("h.host"))).select("p.*", "host_n", "host_s")
    sites = written(same.withColumn("host_mean", host_mean))
    k_path = prior_strength(sites, "n", "s", "host_mean")

    j, s = judged.alias("j"), sites.alias("s")
    rows = j.join(s, F.col("j.host").eqNullSafe(F.col("s.host")) & F.col("j.path").eqNullSafe(F.col("s.path")))
    own, one = F.coalesce("y", F.lit(0.0)), F.when(F.col("y").isNotNull(), 1.0).otherwise(0.0)
    host_mean = (F.col("host_s") - own + k_host * base) / (F.col("host_n") - one + k_host)
    site = (F.col("s") - own + k_path * host_mean) / (F.col("n") - one + k_path)
    rows = rows.withColumn("site_score", site)
    joint = F.col("logit") + _logit(F.col("site_score")) - _logit(F.lit(base))
    rows = rows.withColumn("score", 1 / (1 + F.exp(-joint)))
    return rows.select(
        "doc_id", "j.host", "j.path", "doc_score", "site_score", "score", (F.col("score") >= threshold).alias("kept")
    )
