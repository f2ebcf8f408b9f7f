"""Mixing documents to target domain weights, with DataFrame and SQL functions only.

Membership is soft. Labelled documents give each domain a naive Bayes model over informative words
and a few marks of shape (length, share of different words, share of symbols); it predicts every
document's posterior over the domains. Only what is present is evidence: the absence of the words of
one language says nothing about a text in another.

Rates are then fitted by projected gradient. With n_i tokens and posterior p_i, a rate r_i >= 0 for
each document gives the domains sum_i r_i n_i p_i tokens, which shall be the targets t. The least
squares are taken in the metric of the domains' token overlap G = sum_i n_i p_i p_i' over the
documents of rate above 0, so that a step of length 1 suffices whatever the domains' sizes:

    r_i <- max(0, r_i - a p_i' G^-1 (sum_j r_j n_j p_j - t)),    r_i = 1 and a = 1 at first.

A step that does not bring the totals closer is taken back and a halved. A step needs one aggregate
with a number of sums that depends on the domains only. A document's rate depends only on its
posterior and the steps' few numbers, so rates are an expression over each row: nothing is joined or
shuffled for them, and the table of (tokens, posterior) is the only thing that is written.

Bounds: LABELS labelled documents (the first by hash) train the model; it keeps WORDS words. All
documents are scored and all take part in every sum.

Defined results: a null or empty text has no tokens and no words; its posterior follows from the
rest. Labels without a document, documents without label and null ids in either table train nothing;
of repeated labels the larger values count. Repeated rows are documents of their own. Without labels
all domains are equally likely. If targets cannot be met, for a domain without mass, the others are
still fitted. An empty table gives no rows. Other columns stay; those of a result's name are replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffin.llm.common import fold_ascii, hash_sample, staged, table

#: Target shares of all tokens.
TARGETS = {"good": 0.82, "poor": 0.12, "toxic": 0.06}
LABELS = 8192
WORDS = 256
LEAST_DOCUMENTS = 5
SMOOTHING = 0.5
#: Words of a text depend on each other; a document's evidence counts by this power.
TEMPER = 0.5
STEPS = 40
TOLERANCE = 1e-5
_SPACE = r"[\t\n\x0B\f\r ]+"
_SYMBOLS = "#*$%&|<>!"


def domain_of(labels: DataFrame) -> Column:
    """The domain of a row of the label table."""
    return (
        F.when(labels["toxic"] == 1, "toxic").when(labels["quality"] == 1, "good").otherwise("poor")
    )


def _log_bucket(x: Column, name: str) -> Column:
    return F.concat(F.lit(name), F.floor(F.log2(x + 1)).cast("string"))


def _with_features(docs: DataFrame, text_col: str) -> DataFrame:
    """`docs` with __mix_tokens (their number) and __mix_words (words and marks, with repeats)."""
    text = F.coalesce(docs[text_col], F.lit(""))
    plain = text
    for symbol in _SYMBOLS:
        plain = F.replace(plain, F.lit(symbol), F.lit(""))
    words = F.filter(F.split(fold_ascii(docs[text_col]), _SPACE), lambda w: w != "")
    n = F.size("__mix_split")
    symbols = (F.octet_length(text) - F.octet_length(plain)) / F.greatest(F.octet_length(text), F.lit(1))
    variety = F.size(F.array_distinct("__mix_split")) / F.greatest(n, F.lit(1))
    marks = F.array(
        _log_bucket(n, " length "),
        _log_bucket(1000 * F.col("__mix_symbols"), " symbols "),
        F.concat(F.lit(" variety "), F.floor(10 * variety).cast("string")),
    )
    return (
        docs.withColumns({"__mix_split": words, "__mix_symbols": symbols})
        .withColumns({"__mix_tokens": n.cast("long"), "__mix_words": F.concat("__mix_split", marks)})
        .drop("__mix_split", "__mix_symbols")
    )


@dataclass
class DomainModel:
    """Log-probability of the presence of each word in a document, per domain."""

    domains: list[str]
    words: list[str]
    weights: np.ndarray  # words x domains
    bias: np.ndarray  # domains

    def posterior(self, words: Column) -> Column:
        """An array of probabilities in the order of `domains`."""
        d = len(self.domains)
        scores = F.array(*[F.lit(float(b)) for b in self.bias])
        if self.words:
            vocabulary = F.array(*[F.lit(w) for w in self.words])
            found = F.transform(F.array_intersect(words, vocabulary), lambda w: F.array_position(vocabulary, w))
            table = [F.array(*[F.lit(float(x)) for x in self.weights[:, k]]) for k in range(d)]

            def add(s: Column, i: Column) -> Column:
                return F.array(*[s[k] + F.element_at(table[k], i.cast("int")) for k in range(d)])

            scores = F.aggregate(found, scores, add)
        scaled = F.transform(scores, lambda s: F.lit(TEMPER) * s)
        shifted = F.transform(F.array(scaled), lambda s: F.transform(s, lambda x: F.exp(x - F.array_max(s))))[0]
        return F.transform(
            F.array(shifted),
            lambda e: F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, y: a + y)),
        )[0]


def train(
    docs: DataFrame,
    labelled: DataFrame,
    domains: list[str],
    id_col: str = "doc_id",
    text_col: str = "text",
    labels: int = LABELS,
) -> DomainModel:
    """A model from up to `labels` rows of `labelled` (doc_id, domain), unique by doc_id."""
    labelled = labelled.where(F.col("doc_id").isNotNull() & F.col("domain").isin(domains))
    chosen = hash_sample(
        labelled.select(F.col("doc_id").alias("__mix_id"), F.col("domain").alias("__mix_domain")),
        F.col("__mix_id"),
        F.col("__mix_id"),
        labels,
        labelled.count(),
    )
    # A bounded number of rows of two columns, so a broadcast of known size.
    known = docs.select(docs[id_col].alias("__mix_key"), docs[text_col].alias("__mix_text"))
    known = known.join(F.broadcast(chosen), F.col("__mix_key") == F.col("__mix_id"))
    known = staged(
        _with_features(known, "__mix_text").select(
            "__mix_domain", F.array_distinct("__mix_words").alias("words")
        ),
        "labelled",
    )
    sizes = dict(known.groupBy("__mix_domain").count().collect())
    per_domain = np.array([sizes.get(d, 0) for d in domains], dtype=float)
    total = per_domain.sum()
    counts = [
        F.count_if(F.col("__mix_domain") == d).cast("double").alias(f"c{k}") for k, d in enumerate(domains)
    ]

    def cell(seen: Column, word: Column, size: float) -> Column:
        """One term of the mutual information of presence and domain."""
        return F.when(seen > 0, seen * F.ln(seen * total / (word * F.lit(max(size, 1.0))))).otherwise(0.0)

    some = sum((F.col(f"c{k}") for k in range(len(domains))), F.lit(0.0))
    gain = F.lit(0.0)
    for k, size in enumerate(per_domain):
        gain = gain + cell(F.col(f"c{k}"), some, size) + cell(F.lit(size) - F.col(f"c{k}"), F.lit(total) - some, size)
    top = (
        known.select("__mix_domain", F.explode("words").alias("word"))
        .groupBy("word")
        .agg(*counts)
        .where(some >= LEAST_DOCUMENTS)
        .orderBy(gain.desc(), "word")
        .limit(WORDS)
        .collect()
    )
    seen = np.array([[r[f"c{k}"] for k in range(len(domains))] for r in top]).reshape(-1, len(domains))
    present = (seen + SMOOTHING) / (per_domain + 2 * SMOOTHING)
    prior = (per_domain + 1) / (total + len(domains))
    return DomainModel(domains, [r.word for r in top], np.log(present), np.log(prior) / TEMPER)


def _rate(posterior: Column, steps: list[np.ndarray]) -> Column:
    """The rate after all steps: each subtracts p'g and projects to what is not negative."""
    if not steps:
        return F.lit(1.0)
    d = len(steps[0])
    moves = F.array(*[F.array(*[F.lit(float(x)) for x in g]) for g in steps])

    def step(r: Column, g: Column) -> Column:
        return F.greatest(F.lit(0.0), r - sum((posterior[k] * g[k] for k in range(1, d)), posterior[0] * g[0]))

    return F.aggregate(moves, F.lit(1.0), step)


@dataclass
class Mixture:
    model: DomainModel
    steps: list[np.ndarray]
    targets: np.ndarray
    reached: np.ndarray


def _chance(id_col: Column, text: Column) -> Column:
    """A number in [0, 1) that depends on the document only."""
    return F.pmod(F.xxhash64(id_col, text), F.lit(1 << 20)) / (1 << 20)


def scored(
    docs: DataFrame, model: DomainModel, text_col: str = "text", id_col: str = "doc_id"
) -> DataFrame:
    """Per row of `docs`: doc_id, n (tokens), p (posterior), chance; written once, for the sums of
    all steps."""
    rows = docs.select(
        docs[id_col].alias("doc_id"),
        docs[text_col].alias("__mix_text"),
        _chance(docs[id_col], docs[text_col]).alias("chance"),
    )
    rows = _with_features(rows, "__mix_text")
    posterior = model.posterior(F.col("__mix_words")).alias("p")
    return staged(rows.select("doc_id", F.col("__mix_tokens").alias("n"), posterior, "chance"), "posteriors")


def fit(
    rows: DataFrame, model: DomainModel, targets: dict[str, float], total_tokens: float | None = None
) -> Mixture:
    """Steps that bring the expected tokens of each domain to its share of `total_tokens` (all of
    the input's if not given); `rows` are those of `scored`."""
    d = len(model.domains)
    rows = rows.where("n > 0")
    p = [F.col("p")[k] for k in range(d)]
    pairs = [(i, j) for i in range(d) for j in range(i, d)]

    def sums(steps: list[np.ndarray]) -> tuple[float, np.ndarray, np.ndarray]:
        """All tokens, the tokens of each domain after `steps`, and G."""
        rated = rows.select("n", "p", _rate(F.col("p"), steps).alias("r"))
        row = rated.agg(
            F.sum("n"),
            *[F.sum(F.col("n") * F.col("r") * x) for x in p],
            *[F.sum(F.when(F.col("r") > 0, F.col("n") * p[i] * p[j])) for i, j in pairs],
        ).first()
        row = [float(x or 0) for x in row]
        gram = np.zeros((d, d))
        for (i, j), x in zip(pairs, row[1 + d :], strict=True):
            gram[i, j] = gram[j, i] = x
        return row[0], np.array(row[1 : 1 + d]), gram

    tokens, reached, gram = sums([])
    total = float(tokens if total_tokens is None else total_tokens)
    share = np.array([targets[name] for name in model.domains], dtype=float)
    wanted = total * share / share.sum()
    steps: list[np.ndarray] = []
    length = 1.0
    for _ in range(STEPS):
        miss = np.abs(reached - wanted).max()
        if miss <= TOLERANCE * total or length < 1e-3:
            break
        ridge = 1e-9 * max(np.trace(gram), 1e-9) * np.eye(d)
        step = length * np.linalg.solve(gram + ridge, reached - wanted)
        _, moved, moved_gram = sums([*steps, step])
        if np.abs(moved - wanted).max() < miss:
            steps.append(step)
            reached, gram, length = moved, moved_gram, min(1.0, 2 * length)
        else:
            length /= 2
    return Mixture(model, steps, wanted, reached)


def _copies(rate: Column, chance: Column) -> Column:
    """The rate rounded up or down, so that it holds in the mean."""
    whole = F.floor(rate)
    return (whole + (chance < rate - whole).cast("long")).cast("long")


def _posterior_map(model: DomainModel, p: Column) -> Column:
    return F.map_from_arrays(F.array(*[F.lit(x) for x in model.domains]), p)


def with_rates(docs: DataFrame, mixture: Mixture, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """`docs` with n_tokens, posterior (domain -> probability), rate, and copies: the rate rounded
    down or up by a hash of id and text, so that it holds in the mean."""
    model = mixture.model
    found = _with_features(docs, text_col)
    found = found.withColumn("__mix_p", model.posterior(F.col("__mix_words")))
    found = found.withColumn("__mix_rate", _rate(F.col("__mix_p"), mixture.steps))
    new = {
        "n_tokens": F.col("__mix_tokens"),
        "posterior": _posterior_map(model, F.col("__mix_p")),
        "rate": F.col("__mix_rate"),
        "copies": _copies(F.col("__mix_rate"), _chance(docs[id_col], docs[text_col])),
    }
    old = [F.col(f"`{c}`") for c in docs.columns if c not in new]
    return found.select(*old, *[c.alias(name) for name, c in new.items()])


def _labelled(labels: DataFrame) -> DataFrame:
    labels = labels.groupBy("doc_id").agg(
        F.max("quality").alias("quality"), F.max("toxic").alias("toxic")
    )
    return labels.select("doc_id", domain_of(labels).alias("domain"))


def rates(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS) -> DataFrame:
    """Per row of `docs`: doc_id, n_tokens, posterior, rate, copies; texts are read once."""
    model = train(docs, _labelled(labels), sorted(targets))
    rows = scored(docs, model)
    mixture = fit(rows, model, targets)
    found = rows.withColumn("rate", _rate(F.col("p"), mixture.steps))
    return found.select(
        "doc_id",
        F.col("n").alias("n_tokens"),
        _posterior_map(model, F.col("p")).alias("posterior"),
        "rate",
        _copies(F.col("rate"), F.col("chance")).alias("copies"),
    )


def mixed(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS) -> DataFrame:
    """`docs`, whole rows, with their rates, from the label table (doc_id, quality, toxic)."""
    model = train(docs, _labelled(labels), sorted(targets))
    return with_rates(docs, fit(scored(docs, model), model, targets))


def drawn(found: DataFrame, columns: list[str]) -> DataFrame:
    """The rows of `with_rates`, each as often as its copies say, with `columns` only."""
    # An outer explode and a filter on what it makes: a filter on the copies would be pushed down
    # to the scan and compute every rate, and the posteriors in it, many times over.
    copies = F.array_repeat(F.lit(True), F.col("copies").cast("int"))
    repeated = found.withColumn("__mix_copy", F.explode_outer(copies)).where("__mix_copy")
    return repeated.select(*[F.col(f"`{c}`") for c in columns])


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rates(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select(
        "doc_id", "n_tokens", *[F.col("posterior")[d].alias(f"p_{d}") for d in sorted(TARGETS)], "rate", "copies"
    )
