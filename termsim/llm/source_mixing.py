"""Mixing sources to target weights by soft membership (DataFrame functions only).

1. Labelled-table classifier. A text's features are the shares of the letters
   a-z and of bytes beyond ASCII, in steps of ``BIN_WIDTH``. A table of
   (feature, step, domain) counts over the labelled documents gives log
   likelihoods; a document's domain posteriors are their softmax, the sum being
   divided by ``TEMPERATURE`` because letter shares are not independent.
2. Targets. ``target weight x total`` tokens per domain. By default the total is
   the smallest one at which no domain would need fewer expected tokens than it
   has, so that a mixture is reached by repeating and not by throwing away.
3. Projected-gradient least squares. The rates ``r`` minimise the squared
   distance between the expected domain totals ``sum r_d n_d p_d`` and the targets
   under ``r >= least_rate >= 0``, starting from 1. A step goes along the gradient
   at its own end point (an implicit step, hence of any length): ``r`` becomes
   ``max(least_rate, r - p . step)`` where ``step`` is the distance of the new
   totals from the targets, divided by ``EPS``. The ``K`` numbers of a step solve
   a convex problem by Newton rounds with a line search; a round is one aggregate
   over the documents, the same plan each time. Steps run until the projected
   gradient is at most ``TOLERANCE``; the fit raises ``ArithmeticError`` if it does
   not get there. A rate is a closed expression of the posteriors and the (few)
   steps, hence rounds neither join nor store rates. ``Mixture.residual`` is the
   distance that is left, as a share of the tokens wanted: more than 0 only where
   no rates meet the targets.

Scale: texts are read where they lie (no shuffle of texts); the rounds run over a
written table of a few numbers per document. What reaches the driver are the
label table (features x steps x domains) and sums of ``K`` and ``K x K`` numbers.

Defined cases: NULL or empty text has no tokens, the prior as posteriors and a
rate like any other; a domain without labelled documents has a flat likelihood;
labels of domains without a target are ignored; repeated rows each get the rate;
a NULL id gets a rate but cannot be labelled; an empty table gives no rows;
columns of ``docs`` other than ``doc_id`` and ``text`` are carried by
:func:`apply_rates` and ignored elsewhere.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termsim.llm.storage import table, written

LETTERS = "abcdefghijklmnopqrstuvwxyz"
BINS = 16
BIN_WIDTH = 0.01
TEMPERATURE = 4.0
#: Bounds of the steps and of the Newton rounds of one; what does not end within raises.
STEPS, ROUNDS = 8, 100
#: Root mean square per token of the projected gradient, as a share of the tokens wanted.
TOLERANCE = 1e-6
#: Inverse length of a step, as a share of the trace of ``sum n_d p_d p_d^T``.
EPS = 1e-6
#: Words as everywhere in this package.
WORD = r"[^\x20\x09-\x0D]+"


def _with_features(docs: DataFrame) -> DataFrame:
    """All columns plus ``_n`` (tokens) and ``_f`` (the step of each feature)."""
    low = docs.withColumn("_low", F.lower(F.coalesce("text", F.lit(""))))
    size = F.greatest(F.char_length("_low"), F.lit(1)).cast("double")

    def step(count: Column) -> Column:
        return F.least(F.floor(count / size / F.lit(BIN_WIDTH)), F.lit(BINS - 1)).cast("int")

    n = F.octet_length("_low")
    shares = [step(n - F.octet_length(F.replace("_low", F.lit(c), F.lit("")))) for c in LETTERS]
    shares.append(step((n - F.char_length("_low"))))
    return low.withColumns(
        {"_n": F.regexp_count("_low", F.lit(WORD)).cast("long"), "_f": F.array(*shares)}
    ).drop("_low")


def label_table(features: DataFrame, labelled: DataFrame, domains: list[str]) -> tuple[list, list]:
    """``(priors, likelihoods)``: log priors per domain and, per domain, one log
    likelihood per (feature, step), from ``labelled(doc_id, domain)``."""
    known = labelled.where(F.col("domain").isin(domains) & F.col("doc_id").isNotNull())
    marked = features.join(known.select("doc_id", "domain"), "doc_id").select("domain", F.posexplode("_f").alias("j", "b"))
    counts = {(r["domain"], r["j"], r["b"]): r["c"] for r in marked.groupBy("domain", "j", "b").agg(F.count(F.lit(1)).alias("c")).collect()}
    k = len(LETTERS) + 1
    size = {d: sum(counts.get((d, 0, b), 0) for b in range(BINS)) for d in domains}
    total = sum(size.values())
    priors = [math.log((size[d] + 1) / (total + len(domains))) for d in domains]
    likelihoods = [
        [math.log((counts.get((d, j, b), 0) + 0.5) / (size[d] + 0.5 * BINS)) for j in range(k) for b in range(BINS)]
        for d in domains
    ]
    return priors, likelihoods


def _with_posteriors(df: DataFrame, priors: list, likelihoods: list, steps: str = "_f", out: str = "p") -> DataFrame:
    """``df`` plus ``out``: an array of one probability per domain. Every step is
    a column of its own, so that none is computed twice."""
    scores = []
    for prior, row in zip(priors, likelihoods, strict=True):
        # one constant array; the place of feature j in step b is j * BINS + b
        values = "cast(split('" + ",".join(f"{x:.9f}" for x in row) + "', ',') as array<double>)"
        found = f"aggregate(_at, 0D, (a, i) -> a + get({values}, i))"
        scores.append(f"{found} / {TEMPERATURE}D + ({prior:.9f}D)")
    return (
        df.withColumn("_at", F.transform(steps, lambda b, j: b + j * F.lit(BINS)))
        .withColumn("_z", F.expr(f"array({', '.join(scores)})"))
        .withColumn("_top", F.array_max("_z"))
        .withColumn("_e", F.expr("transform(_z, x -> exp(x - _top))"))
        .withColumn("_sum", F.expr("aggregate(_e, 0D, (a, x) -> a + x)"))
        .withColumn(out, F.expr("transform(_e, x -> x / _sum)"))
        .drop("_at", "_z", "_top", "_e", "_sum")
    )


def rate(p: Column, steps: list[list[float]], least: float) -> Column:
    """The rate after the given steps: start at 1, subtract ``p . step``, project."""
    r = F.lit(1.0)
    for s in steps:
        moved = reduce(add, [F.get(p, F.lit(k)) * F.lit(x) for k, x in enumerate(s)])
        r = F.greatest(r - moved, F.lit(float(least)))
    return r


def _solve(a: list[list[float]], b: list[float]) -> list[float]:
    """Gaussian elimination for a system of one row per domain."""
    n = len(b)
    m = [[*row, y] for row, y in zip(a, b, strict=True)]
    for i in range(n):
        p = max(range(i, n), key=lambda r: abs(m[r][i]))
        m[i], m[p] = m[p], m[i]
        for r in range(i + 1, n):
            f = m[r][i] / m[i][i]
            m[r] = [x - f * y for x, y in zip(m[r], m[i], strict=True)]
    x = [0.0] * n
    for i in reversed(range(n)):
        x[i] = (m[i][n] - sum(m[i][j] * x[j] for j in range(i + 1, n))) / m[i][i]
    return x


def _dot(p: Column, x: list[float]) -> Column:
    """``p . x``; ``x`` stays out of the generated code, so that all rounds share it."""
    products = F.zip_with(p, F.lit([float(v) for v in x]), lambda a, b: a * b)
    return F.aggregate(products, F.lit(0.0), lambda a, b: a + b)


def solve_rates(stats: DataFrame, weights: list[float], total: float | None = None, least: float = 0.0,
                rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> tuple[list[list[float]], float, float]:
    """``(steps, residual, gradient)``: the steps of :func:`rate` for ``stats(n, p)``,
    the distance from the targets and the projected gradient there, both as shares
    of the tokens wanted; ``weights`` sum to 1."""
    k, n, p = len(weights), F.col("n"), F.col("p")
    at = [F.get(p, F.lit(i)) for i in range(k)]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    row = stats.agg(F.sum(n), *[F.sum(n * x) for x in at], *[F.sum(n * at[i] * at[i]) for i in range(k)]).first()
    size, have, trace = float(row[0] or 0.0), [float(x or 0.0) for x in row[1 : k + 1]], sum(float(x or 0.0) for x in row[k + 1 :])
    if size <= 0:
        return [], 0.0, 0.0
    want = total or max(h / w for h, w in zip(have, weights, strict=True) if w > 0)
    target = [w * want for w in weights]
    eps = EPS * trace

    def look(steps: list[list[float]], x: list[float]):
        """At the step ``x``: the convex function, its gradient and its second derivatives."""
        u = rate(p, steps, least) - _dot(p, x)
        d = stats.select("n", "p", u.alias("u"))
        free, low = F.col("u") > least, float(least)
        value = F.when(free, F.col("u") * F.col("u") / 2).otherwise(F.col("u") * low - low * low / 2)
        r = d.agg(
            F.sum(n * value), *[F.sum(n * y * F.greatest("u", F.lit(low))) for y in at],
            *[F.sum(F.when(free, n * at[i] * at[j]).otherwise(0.0)) for i, j in pairs],
        ).first()
        total_of = [float(y) for y in r[1 : k + 1]]
        h = {ij: float(y) for ij, y in zip(pairs, r[k + 1 :], strict=True)}
        f = float(r[0]) + sum(eps / 2 * v * v + t * v for v, t in zip(x, target, strict=True))
        g = [eps * v + t - y for v, t, y in zip(x, target, total_of, strict=True)]
        return f, g, [[h[min(i, j), max(i, j)] + (eps if i == j else 0.0) for j in range(k)] for i in range(k)]

    def length(v: list[float]) -> float:
        return math.sqrt(sum(x * x for x in v))

    def step_from(steps: list[list[float]]) -> list[float]:
        x = [0.0] * k
        f, g, h = look(steps, x)
        for _ in range(rounds):
            if length(g) <= tolerance * 1e-2 * want:
                break
            move, t = _solve(h, [-y for y in g]), 1.0
            slope = sum(a * b for a, b in zip(move, g, strict=True))
            while True:
                new = [a + t * b for a, b in zip(x, move, strict=True)]
                found = look(steps, new)
                # less by enough, or as near as the sums are exact
                if found[0] <= f + 1e-4 * t * slope + 1e-13 * abs(f) or t < 1e-6:
                    break
                t /= 2
            x, (f, g, h) = new, found
        return x

    def state(steps: list[list[float]]) -> tuple[float, float]:
        """``(residual, gradient)``, from the rates themselves."""
        d = stats.select("n", "p", rate(p, steps, least).alias("r"))
        off = [float(y) / want - w for y, w in zip(d.agg(*[F.sum(n * y * F.col("r")) for y in at]).first(), weights, strict=True)]
        slope = _dot(p, off)
        downhill = F.when(F.col("r") > least, slope).otherwise(F.least(slope, F.lit(0.0)))
        return length(off), math.sqrt(d.agg(F.sum(n * downhill * downhill)).first()[0] / size)

    steps: list[list[float]] = []
    residual, gradient = state(steps)
    while gradient > tolerance:
        if len(steps) == STEPS:
            raise ArithmeticError(f"rates: projected gradient {gradient:.3g} over {tolerance:.3g} after {STEPS} steps, residual {residual:.3g}")
        steps = [*steps, step_from(steps)]
        residual, gradient = state(steps)
    return steps, residual, gradient


def fit_rates(stats: DataFrame, weights: list[float], total: float | None = None, least: float = 0.0,
              rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> list[list[float]]:
    """The steps of :func:`solve_rates` alone."""
    return solve_rates(stats, weights, total, least, rounds, tolerance)[0]


class Mixture:
    """A fitted mixture: everything a document's rate is computed from."""

    def __init__(self, domains: list[str], priors: list, likelihoods: list, steps: list, least: float,
                 residual: float = 0.0, gradient: float = 0.0):
        self.domains, self.priors, self.likelihoods, self.steps, self.least = domains, priors, likelihoods, steps, least
        self.residual, self.gradient = residual, gradient

    def with_posteriors(self, features: DataFrame, out: str) -> DataFrame:
        return _with_posteriors(features, self.priors, self.likelihoods, out=out)

    def of_posteriors(self, p: Column) -> Column:
        return rate(p, self.steps, self.least)


def fit(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], total: float | None = None,
        least: float = 0.0) -> tuple[Mixture, DataFrame]:
    """``(mixture, stats)``; ``stats(doc_id, n, p)`` holds a row per document.
    ``targets``: weight per domain (scaled to sum 1)."""
    domains = list(targets)
    weights = [targets[d] / sum(targets.values()) for d in domains]
    features = written(_with_features(docs.select("doc_id", "text")).select("doc_id", "_n", "_f"), "letter-shares")
    priors, likelihoods = label_table(features, labelled, domains)
    stats = written(
        _with_posteriors(features, priors, likelihoods).select("doc_id", F.col("_n").alias("n"), "p"), "posteriors"
    )
    steps, residual, gradient = solve_rates(stats, weights, total, least)
    return Mixture(domains, priors, likelihoods, steps, least, residual, gradient), stats


def rates(mixture: Mixture, stats: DataFrame) -> DataFrame:
    """``(doc_id, n_tokens, p_<domain>..., rate)``, one row per document."""
    p = [F.round(F.get("p", F.lit(i)), 9).alias(f"p_{d}") for i, d in enumerate(mixture.domains)]
    return stats.select(
        "doc_id", F.col("n").alias("n_tokens"), *p, F.round(mixture.of_posteriors(F.col("p")), 9).alias("rate")
    )


def apply_rates(docs: DataFrame, mixture: Mixture) -> DataFrame:
    """``docs`` mixed: each row ``floor(rate)`` times and once more with the
    remaining probability, drawn by a hash of id and text (the same in every run).
    Reads the texts once, without a join or shuffle."""
    rows = docs.select("doc_id", "text", F.struct(*docs.columns).alias("_row"))
    with_p = mixture.with_posteriors(_with_features(rows), "_p")
    with_r = with_p.withColumn("_r", mixture.of_posteriors(F.col("_p")))
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    # the row id is there to keep the optimizer from copying the whole chain of
    # expressions into a filter on the number of copies
    copies = F.floor(F.col("_r") + draw).cast("int") + (F.monotonically_increasing_id() * 0).cast("int")
    return with_r.withColumn("_c", copies).withColumn("_i", F.explode(F.expr("array_repeat(0, _c)"))).select("_row.*")


#: The production mixture: domains are the languages, and English gives way.
TARGETS = {"en": 0.52, "de": 0.16, "fr": 0.16, "es": 0.16}
LEAST_RATE = 1.0


def labelled_domains(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, domain)``: the language of the documents that have been labelled."""
    known = labels.select("doc_id").distinct()
    return docs.select("doc_id", F.col("lang").alias("domain")).join(known, "doc_id", "left_semi")


def op2_source_mixing(spark, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    mixture, stats = fit(docs, labelled_domains(docs, labels), TARGETS, least=LEAST_RATE)
    return rates(mixture, stats)
