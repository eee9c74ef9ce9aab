"""Mixing documents to target weights of softly assigned domains, in DataFrame functions only.

A naive Bayes classifier is fitted on the labelled table: the words that tell
the domains apart best, and two shares of a text in bins (different words,
marks). Its temperature is chosen on held-out labelled documents, so that the
posteriors are memberships rather than verdicts. Rates then solve

    least squares of (expected tokens of each domain - target), each relative
    to the domain's present tokens, plus RIDGE * (rate - 1)^2 weighted by tokens,
    over all rates >= 0

by projected gradient steps with momentum. Scaled by the documents' tokens, the largest
eigenvalue of the problem is 1 + RIDGE (the memberships of a document add up
to one), so the step 1 / (1 + RIDGE) is safe for every corpus. A step is one
aggregation of a number per domain; a document's rate follows from its
memberships and the residuals seen so far, so no state is shuffled.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import stored, text_or_empty

#: Domains of the labelled table and the share of tokens each should have.
DOMAINS = ("plain", "junk", "toxic")
TARGETS = {"plain": 0.95, "junk": 0.01, "toxic": 0.04}

MAX_LABELLED = 10_000  # labelled documents that the classifier is fitted on (a hash sample of about so many)
VOCABULARY = 1024      # words that the classifier knows
BINS = 12
TEMPERATURES = (1.0, 0.5, 0.25, 0.1, 0.05)
RIDGE = 1e-3
STEPS = 45
TOLERANCE = 1e-6       # of a domain's present tokens, between two steps
WRITTEN = 3            # steps after which the rates are stored, so that plans stay small

MARKS = "!|#*$%&<>"


def domain_of_labels() -> Column:
    """The domain's number from ``quality`` and ``toxic``; null labels are no label."""
    return F.when(F.col("quality") == 0, 1).when(F.col("toxic") == 1, 2).when((F.col("quality") == 1) & (F.col("toxic") == 0), 0)


def _documents(docs: DataFrame) -> DataFrame:
    text = text_or_empty("text")
    own = [F.col("doc_id").isNull(), F.col("doc_id"), F.col("text").isNull(), text]
    words = F.filter(F.split(F.translate(text, "\t\n\x0b\x0c\r", "     "), " "), lambda w: w != "")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(*own).alias("d1"),
                       F.xxhash64(F.lit(1), *own).alias("d2"), text.alias("text"), words.alias("words"))


def _shape(rows: DataFrame) -> DataFrame:
    """``n`` words, and the bins of the shares of different words and of marks."""
    n = F.size("words")
    marks = F.length("text") - F.length(F.translate("text", MARKS, ""))
    fresh = F.size(F.array_distinct("words")) / F.greatest(n, F.lit(1))
    # long texts repeat words as a matter of course; the bin is of the excess over their square root
    expected = F.least(F.lit(1.0), 8.0 / F.sqrt(F.greatest(n, F.lit(1))))
    return rows.withColumns({
        "n": n, "fresh": F.least(F.floor(fresh / expected * 6), F.lit(BINS - 1)).cast("int"),
        "marked": F.least(F.floor(F.sqrt(marks / F.greatest(F.length("text"), F.lit(1))) * 24), F.lit(BINS - 1)).cast("int")})


def _likelihoods(counts: list[list[float]]) -> list[list[float]]:
    """log P(bin | domain) for each bin and domain, smoothed."""
    totals = [sum(c[k] for c in counts) + len(counts) for k in range(len(DOMAINS))]
    return [[math.log((c[k] + 1) / totals[k]) for k in range(len(DOMAINS))] for c in counts]


class Classifier:
    """What is learned: small tables of numbers."""

    def __init__(self, vocabulary: DataFrame | None, fresh, marked, prior, temperature=1.0):
        self.vocabulary, self.fresh, self.marked, self.prior, self.temperature = vocabulary, fresh, marked, prior, temperature


def _logits(rows: DataFrame, learned: Classifier) -> DataFrame:
    """``doc_id, d1, d2, n`` and the log likelihoods of each domain, of every row:
    ``s0..`` of the text's shape, ``w0..`` of its words."""
    ks = range(len(DOMAINS))
    shape = _shape(rows).drop("words", "text")
    pick = lambda col, table, k: F.element_at(F.array(*[F.lit(b[k]) for b in table]), F.col(col) + 1)
    shape = shape.withColumns({f"s{k}": pick("fresh", learned.fresh, k) + pick("marked", learned.marked, k) for k in ks})
    # at most VOCABULARY rows, whatever the data
    seen = rows.select("d1", "d2", F.explode(F.array_distinct("words")).alias("word")).join(F.broadcast(learned.vocabulary), "word")
    told = seen.groupBy("d1", "d2").agg(*[F.sum(f"w{k}").alias(f"w{k}") for k in ks], F.count(F.lit(1)).alias("hits"))
    # equal rows share a key, and their words were summed together
    copies = rows.groupBy("d1", "d2").agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    told = told.join(copies, ["d1", "d2"], "left").withColumn("copies", F.coalesce("copies", F.lit(1)))
    joined = shape.join(told, ["d1", "d2"], "left")
    return joined.select("doc_id", "d1", "d2", F.col("n").cast("long").alias("n"),
                         *[f"s{k}" for k in ks],
                         *[F.coalesce(F.col(f"w{k}") / F.col("copies"), F.lit(0.0)).alias(f"w{k}") for k in ks])


def _posteriors(learned: Classifier, temperature: float | None = None) -> list[Column]:
    t = learned.temperature if temperature is None else temperature
    # words of a text are far from independent: their evidence is tempered
    z = [F.col(f"w{k}") * t + F.col(f"s{k}") + F.lit(learned.prior[k]) for k in range(len(DOMAINS))]
    top = F.greatest(*z)
    parts = [F.exp(x - top) for x in z]
    return [p / sum(parts[1:], parts[0]) for p in parts]


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Classifier | None:
    """The classifier, or None if no document is labelled."""
    ks = range(len(DOMAINS))
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), domain_of_labels().alias("domain"))
    known = known.filter("doc_id is not null and domain is not null").groupBy("doc_id").agg(F.max("domain").alias("domain"))
    n = known.count()
    draw = F.pmod(F.xxhash64("doc_id", F.lit("labelled")), F.lit(1_000_000)) < math.ceil(1_000_000 * min(1.0, max_labelled / max(n, 1)))
    # bounded by max_labelled
    rows = stored(_documents(docs).join(F.broadcast(known.filter(draw)), "doc_id"), "labelled")
    held = F.pmod(F.xxhash64("doc_id", F.lit("held out")), F.lit(5)) == 0
    used = rows.filter(~held)
    per = [F.sum((F.col("domain") == k).cast("double")).alias(f"c{k}") for k in ks]
    shape = _shape(used)
    docs_of = [x or 0.0 for x in shape.agg(*per).first()]
    if not sum(docs_of):
        return None
    bins = {}
    for col in ("fresh", "marked"):
        found = {r[col]: [r[f"c{k}"] for k in ks] for r in shape.groupBy(col).agg(*per).collect()}  # at most BINS rows
        bins[col] = _likelihoods([found.get(b, [0.0] * len(DOMAINS)) for b in range(BINS)])
    # how many documents hold a word: the log share in each domain, drawn towards
    # the share overall, and how far from chance it lies
    words = used.select("domain", F.explode(F.array_distinct("words")).alias("word")).groupBy("word").agg(*per, F.count(F.lit(1)).alias("all"))
    words = words.filter("all >= 5")
    usual = F.col("all") / sum(docs_of)
    rate = [F.log((F.col(f"c{k}") + 2 * usual) / (docs_of[k] + 2) / usual) for k in ks]
    odd = [F.abs(F.col(f"c{k}") - docs_of[k] * usual) / F.sqrt(docs_of[k] * usual + 1) for k in ks]
    best = words.withColumn("odd", F.greatest(*odd)).filter("odd > 4").orderBy(F.desc("odd"), "word").limit(VOCABULARY)
    vocabulary = stored(best.select("word", *[rate[k].alias(f"w{k}") for k in ks]), "vocabulary")
    prior = [math.log((docs_of[k] + 0.5) / (sum(docs_of) + 0.5 * len(DOMAINS))) for k in ks]
    learned = Classifier(vocabulary, bins["fresh"], bins["marked"], prior)
    trial = _logits(rows.filter(held).drop("domain"), learned).join(rows.select("d1", "d2", "domain").distinct(), ["d1", "d2"])
    losses = []
    for t in TEMPERATURES:
        p = _posteriors(learned, t)
        own = F.element_at(F.array(*p), F.col("domain") + 1)
        losses.append(F.avg(-F.log(F.greatest(own, F.lit(1e-9)))))
    loss = [x if x is not None else 0.0 for x in trial.agg(*losses).first()]
    learned.temperature = TEMPERATURES[loss.index(min(loss))]
    return learned


def memberships(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """``doc_id, d1, d2, n, p0..`` of every row: words and posteriors. Stored once."""
    ks = range(len(DOMAINS))
    learned = fit(docs, labels, max_labelled)
    rows = _documents(docs)
    if learned is None:
        even = [F.lit(1.0 / len(DOMAINS)).alias(f"p{k}") for k in ks]
        return stored(rows.select("doc_id", "d1", "d2", F.size("words").cast("long").alias("n"), *even), "memberships")
    told = _logits(rows, learned)
    return stored(told.select("doc_id", "d1", "d2", "n", *[p.alias(f"p{k}") for k, p in enumerate(_posteriors(learned))]), "memberships")


def solve(members: DataFrame, targets: list[float], ridge: float = RIDGE, steps: int = STEPS, tolerance: float = TOLERANCE) -> DataFrame:
    """``members`` with the ``rate`` of every row, a function of its memberships ``p0..``.

    A domain without tokens cannot be reached; its target is left out.
    """
    ks = range(len(targets))
    base = members.agg(*[F.sum(F.col("n") * F.col(f"p{k}")) for k in ks]).first()
    base = [float(x or 0.0) for x in base]
    total = sum(base)
    used = [k for k in ks if total and base[k] > 1e-9 * total]
    step = 1.0 / (1.0 + ridge)
    rated, rate, before, last = members, F.lit(1.0), F.lit(1.0), None
    for turn in range(1, (steps if used else 0) + 1):
        # momentum: the step starts a little beyond the present rate
        ahead = rate + (rate - before) * ((turn - 1.0) / (turn + 2.0))
        seen = rated.withColumn("ahead", ahead)
        now = seen.agg(*[F.sum(F.col("n") * F.col(f"p{k}") * F.col("ahead")) for k in used]).first()
        # gap of each domain, relative to its tokens
        gap = [(float(x) - targets[k] * total) / base[k] for k, x in zip(used, now)]
        if last is not None and max(abs(x - y) for x, y in zip(gap, last)) <= tolerance:
            break
        last = gap
        pull = sum((F.col(f"p{k}") * g for k, g in zip(used, gap)), F.lit(0.0))
        before, rate = rate, F.greatest(F.lit(0.0), ahead * (1.0 - step * ridge) + F.lit(step * ridge) - pull * step)
        if turn % WRITTEN == 0:
            rated = stored(rated.withColumns({"rate": rate, "before": before}), "rates")
            rate, before = F.col("rate"), F.col("before")
    return rated.withColumn("rate", rate).drop("before")


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """``doc_id, d1, d2, n_tokens, p_<domain>.., rate, copies`` of every row.

    ``copies`` is the rate rounded up or down by a hash of the row, so that its
    expectation is the rate. Words are set apart by ASCII white space. A null
    or empty text has no words: its rate follows from its shape alone and moves
    no total. Equal rows get equal answers; null doc_ids are never labelled;
    without labels all memberships are even and all rates are one or as near as
    the targets allow. An empty table gives no rows. Other columns are ignored.
    """
    members = solve(memberships(docs, labels, max_labelled), [targets[d] for d in DOMAINS])
    chance = F.pmod(F.xxhash64("d1", "d2", F.lit("copies")), F.lit(2**30)) / float(2**30)
    return members.select("doc_id", "d1", "d2", F.col("n").alias("n_tokens"),
                          *[F.col(f"p{k}").alias(f"p_{d}") for k, d in enumerate(DOMAINS)], "rate") \
        .withColumn("copies", F.floor(F.col("rate") + chance).cast("int"))


def resample(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS, **how) -> DataFrame:
    """``docs`` with each row as often as :func:`mix` says, all columns as they were."""
    counts = mix(docs, labels, targets, **how).select("d1", "d2", "copies").distinct()
    own = [F.col("doc_id").isNull(), F.col("doc_id"), F.col("text").isNull(), text_or_empty("text")]
    keyed = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), F.xxhash64(*own).alias("d1"), F.xxhash64(F.lit(1), *own).alias("d2"))
    times = keyed.join(counts.hint("shuffle_hash"), ["d1", "d2"]).filter("copies > 0")
    each = times.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return each.select(*[F.col("row")[c].alias(c) for c in docs.columns])
