"""Quality classifier from weak labels.

Overlapping heuristic labellers vote good, bad or abstain on three questions:
is a text full of marks and capitals, is it repetitive (either makes it junk),
is it toxic.  Labellers of one question look at the same fault, as bad rows of
another kind would pass for good ones.  Expectation-maximisation over the
counts of vote patterns of all documents estimates each labeller's accuracy
and, with it, the probability of the fault given a pattern.  Those posterior
labels train a logistic scorer over hashed words and steps of text measures; the scorer
decides about every document.

Bounded parts (documented parameters): the scorer is fitted on at most
``sample_docs`` rows, labelled ones first, with at most ``max_features``
features a question; everything else covers all documents.  Only pattern
counts, the chosen features and the fitting rows' use of them reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StructField, StructType

from fieldlens.llm.runtime import checkpoint, releasing
from fieldlens.llm.words import Words, mix64, text_runs

ABSTAIN, GOOD, BAD = 0, 1, 2
_HASH_BITS = 30  # word features; measures get ids above, word beginnings from _STEMS on
_STEMS = 1 << 31
_STEM_BYTES = 6
_SYMBOLS = np.isin(np.arange(256), [ord(c) for c in "#*$%&|<>!"])
_PUNCTUATION = np.array([0x20 < b < 0x7F and not chr(b).isalnum() for b in range(256)])
_UPPER = (np.arange(256) >= 0x41) & (np.arange(256) <= 0x5A)
_LOWER = (np.arange(256) >= 0x61) & (np.arange(256) <= 0x7A)
#: (measure, vote good up to, vote bad from); shares between 0 and 1
MEASURES = (("symbols", 0.01, 0.05), ("marked words", 0.05, 0.3), ("punctuation", 0.08, 0.12), ("capitals", 0.2, 0.5),
            ("stutter", 0.05, 0.2), ("repeated triples", 0.15, 0.4), ("repeats", 0.1, 0.3))
#: question -> the measures whose labellers vote on it
QUESTIONS = {"marks": (0, 1, 2, 3), "repetition": (4, 5, 6), "toxic": ()}
#: distinct lexicon words: (vote bad from, lexicon) -- any word, and two of the surest
_FALSE, _SURE = 0.003, 1e-5  # most chance finds among the chosen words, and among the surest of them
_CHI2 = 10.83  # a measure step enters the scorer from this chi-squared on (one in a thousand by chance)
_PRECISION = 0.8  # least share of bad rows among those with a word


def measures(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows x MEASURES shares, words per row) of a run of texts: bytes that
    are symbols, words that end in one, bytes that are punctuation, letters
    that are capitals, words equal to the one before, and 3- and 8-word
    sequences that the row has already had."""
    words = Words(data, offsets)
    n = np.diff(words.first)

    def per_row(flags: np.ndarray, edges: np.ndarray) -> np.ndarray:
        upto = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return np.diff(upto[edges])

    def share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
        return part / np.maximum(whole, 1)

    upper, lower = per_row(_UPPER[data], offsets), per_row(_LOWER[data], offsets)
    same = np.zeros(len(words), dtype=bool)
    same[1:] = (words.hash[1:] == words.hash[:-1]) & (words.row[1:] == words.row[:-1])

    def again(k: int) -> np.ndarray:
        grams = words.shingles(k)
        whole = np.flatnonzero(words.row[:len(grams)] == words.row[k - 1:k - 1 + len(grams)])
        row = words.row[whole]
        # one sortable number per sequence: its hash above, its row below
        bits = np.uint64(max(1, int(len(n)).bit_length()))
        keys = np.sort((grams[whole] << bits) | row.astype(np.uint64))
        seen = keys[1:][keys[1:] == keys[:-1]] & ((np.uint64(1) << bits) - np.uint64(1))
        return share(np.bincount(seen.astype(np.int64), minlength=len(n)), np.bincount(row, minlength=len(n)))

    size = np.diff(offsets)
    shares = np.stack([
        share(per_row(_SYMBOLS[data], offsets), size), share(per_row(_SYMBOLS[data[words.end - 1]], words.first), n),
        share(per_row(_PUNCTUATION[data], offsets), size), share(upper, upper + lower),
        share(per_row(same, words.first), n), again(3), again(8)], axis=1)
    return shares, n


def features(data: np.ndarray, offsets: np.ndarray, shares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature id), each pair once: hashed normalised words, hashed
    beginnings of longer words (a stem in many inflections), and the steps
    that each measure reaches."""
    words = Words(data, offsets, normalise=True)
    ids = (words.hash >> np.uint64(64 - _HASH_BITS)).astype(np.int64)
    reached = shares[:, :, None] >= (np.arange(1, 10) / 10) ** 2  # steps of the square root
    at, measure, step = np.nonzero(reached)
    steps = (1 << _HASH_BITS) + 10 * measure + step
    long = np.flatnonzero(words.end - words.start > _STEM_BYTES)
    begin = words.start[long]
    stem = np.zeros(len(long), dtype=np.uint64)
    for k in range(_STEM_BYTES):
        stem = (stem << np.uint64(8)) | words.data[begin + k].astype(np.uint64)
    stems = _STEMS + (mix64(stem) >> np.uint64(64 - _HASH_BITS)).astype(np.int64)
    both = np.unique((np.concatenate([words.row, words.row[long], at]) << np.int64(32)) | np.concatenate([ids, stems, steps]))
    return both >> 32, both & 0xFFFFFFFF


def _ends(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Lowest and highest hash of a row's 8-word sequences, null without any."""
    words = Words(data, offsets, normalise=True)
    grams = words.shingles(8)
    row = words.row[:len(grams)]
    whole = row == words.row[7:7 + len(grams)]
    grams, row = grams[whole].view(np.int64), row[whole]
    some, begin = np.unique(row, return_index=True)
    out = []
    for pick in (np.minimum, np.maximum):
        values = np.zeros(len(offsets) - 1, dtype=np.int64)
        if len(some):
            values[some] = pick.reduceat(grams, begin)
        out.append(pa.array(values, mask=~np.isin(np.arange(len(values)), some)))
    return out[0], out[1]


def _count_known(row: np.ndarray, ids: np.ndarray, known: np.ndarray, weight: np.ndarray, rows: int) -> np.ndarray:
    """Sum of the weights of a row's features that are known (sorted ids)."""
    if not len(known):
        return np.zeros(rows)
    at = np.minimum(np.searchsorted(known, ids), len(known) - 1)
    hit = known[at] == ids
    return np.bincount(row[hit], weights=weight[at[hit]], minlength=rows)


@dataclass
class Lexicon:
    """Features that mark labelled toxic rows; ``sure`` is the surer part."""

    words: np.ndarray
    sure: np.ndarray


def votes(data: np.ndarray, offsets: np.ndarray, lexicon: Lexicon) -> list[np.ndarray]:
    """Vote pattern of each row for each of the QUESTIONS, one base-3 digit a
    labeller; nobody votes on a text without words."""
    shares, n = measures(data, offsets)
    row, ids = features(data, offsets, shares)
    any_hit = _count_known(row, ids, lexicon.words, np.ones(len(lexicon.words)), len(n))
    sure_hit = _count_known(row, ids, lexicon.sure, np.ones(len(lexicon.sure)), len(n))
    own = {"toxic": [np.where(any_hit > 0, BAD, GOOD),
                     np.where(sure_hit > 1, BAD, np.where(any_hit > 0, ABSTAIN, GOOD)),
                     np.where(any_hit == 0, GOOD, np.where(any_hit * 200 >= n, BAD, ABSTAIN))]}
    out = []
    for question, used in QUESTIONS.items():
        code = np.zeros(len(n), dtype=np.int64)
        for i in used:
            _, good, bad = MEASURES[i]
            code = 3 * code + np.where(shares[:, i] >= bad, BAD, np.where(shares[:, i] <= good, GOOD, ABSTAIN))
        for vote in own.get(question, ()):
            code = 3 * code + vote
        out.append(np.where(n > 0, code, 0))
    return out


def estimate(patterns: dict[int, int], labellers: int, rounds: int = 200) -> dict[int, float]:
    """P(bad | pattern) by expectation-maximisation over pattern counts; each
    labeller has its own chances of voting good, bad or abstaining for either
    class.  The start trusts bad votes, as heuristics rarely fire by accident."""
    if not patterns:
        return {}
    codes = np.array(sorted(patterns))
    count = np.array([patterns[c] for c in codes.tolist()], dtype=float)
    digits = codes[:, None] // 3 ** np.arange(labellers)[None, ::-1] % 3
    chance = np.tile(np.array([[0.3, 0.65, 0.05], [0.3, 0.3, 0.4]]), (labellers, 1, 1))  # labeller, class, vote
    prior = 0.15
    bad = np.zeros(len(codes))
    for _ in range(rounds):
        logs = np.log(chance)[np.arange(labellers)[None, :], :, digits].sum(axis=1)
        odds = logs[:, 1] - logs[:, 0] + np.log(prior / (1 - prior))
        before, bad = bad, 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
        prior = float(np.clip((count * bad).sum() / count.sum(), 1e-4, 0.5))
        for v in range(3):
            for c, p in ((0, 1 - bad), (1, bad)):
                chance[:, c, v] = ((digits == v) * (count * p)[:, None]).sum(axis=0) + 0.1
        chance /= chance.sum(axis=2, keepdims=True)
        if np.abs(bad - before).max() < 1e-6:
            break
    return dict(zip(codes.tolist(), bad.tolist()))


def train(x: np.ndarray, y: np.ndarray, ridge: float = 0.5, rounds: int = 40) -> tuple[np.ndarray, float]:
    """Ridge logistic regression on soft labels by Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    keep = np.full(x.shape[1], ridge)
    keep[-1] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(keep), x.T @ (y - p) - keep * w)
        w += step * min(1.0, 4 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


@dataclass
class Scorer:
    ids: np.ndarray
    weights: np.ndarray
    bias: float

    def __call__(self, row: np.ndarray, ids: np.ndarray, rows: int) -> np.ndarray:
        logit = _count_known(row, ids, self.ids, self.weights, rows) + self.bias
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


@dataclass
class Model:
    junk: Scorer
    toxic: Scorer


def _clean_labels(labels: DataFrame, id_col: str) -> DataFrame:
    """One row a document: (doc, quality, toxic), null where not 0 or 1; of
    contradictory labels the worse one counts."""
    flag = lambda c: F.when(F.col(c).isin(0, 1), F.col(c).cast("int"))
    return (labels.select(F.col(id_col).cast("long").alias("doc"), flag("quality").alias("quality"), flag("toxic").alias("toxic"))
            .where("doc is not null").groupBy("doc").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic")))


def _is_word(feature: Column) -> Column:
    """Whether a feature is a word or a beginning of one, not a measure."""
    return (feature < (1 << _HASH_BITS)) | (feature >= _STEMS)


def _chance_shares(pairs: dict[tuple[int, int], int], bad: int, n: int) -> dict[tuple[int, int], float]:
    """Estimated share of chance finds among the words that speak for bad rows
    at least as clearly as one of ``t`` rows, ``a`` of them bad; ``pairs`` has
    the number of words by (a, t).

    Were ``bad`` of ``n`` rows dealt at random, a word's bad rows would be
    hypergeometric.  The tails of all words, rare ones with the few tails that
    they can have, give the number that chance brings below a p-value; so there
    is no fixed count that a word has to reach."""
    logs = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, n + 1)))])
    choose = lambda m, k: logs[m] - logs[k] - logs[m - k]
    words_of: dict[int, int] = {}
    for (_, t), words in pairs.items():
        words_of[t] = words_of.get(t, 0) + words
    limits = 10.0 ** np.arange(-30, -0.99, 0.1)
    expected, p_value = np.zeros(len(limits)), {}
    for t, words in words_of.items():
        k = np.arange(max(0, t - (n - bad)), min(t, bad) + 1)
        tails = np.cumsum(np.exp(choose(bad, k) + choose(n - bad, t - k) - choose(n, t))[::-1])
        tails = tails[:int((k >= _PRECISION * t).sum())]  # ascending: all bad first
        if len(tails):
            at = np.searchsorted(tails, limits, side="right")
            expected += words * np.where(at > 0, tails[np.maximum(at, 1) - 1], 0.0)
            p_value.update({(int(k[-1 - i]), t): float(p) for i, p in enumerate(tails.tolist())})
    found = {pair: max(p_value[pair], float(limits[0])) for pair in pairs if pair in p_value and p_value[pair] <= limits[-1]}
    upto = np.zeros(len(limits))
    for pair, p in found.items():
        upto += pairs[pair] * (limits >= p)
    share = np.minimum.accumulate((expected / np.maximum(upto, 1))[::-1])[::-1]
    return {pair: float(share[np.searchsorted(limits, p)]) for pair, p in found.items()}


def _chosen(counts: DataFrame, totals: tuple[float, float], limit: int, fill: bool = False) -> dict[int, float]:
    """Features that tell bad from good rows by (bad, good) row weights, with
    their estimated share of chance finds: words that nearly only bad rows have,
    and measure steps that speak for either; of more than ``limit`` those with
    the highest chi-squared.  If no word stands out, no word is among them, or with
    ``fill`` all that nearly only bad rows have."""
    bad, good = (float(t) for t in totals)
    n = bad + good
    if bad <= 0 or good <= 0:
        return {}
    a, b = F.col("bad"), F.col("good")
    cross = a * good - b * bad
    chi2 = n * cross * cross / (bad * good * (a + b) * (F.lit(n) - a - b + 1e-9))
    whole = counts.select("id", "bad", "good", chi2.alias("chi2"), F.round(a).cast("int").alias("a"), F.round(a + b).cast("int").alias("t"))
    words = whole.where(_is_word(F.col("id")))
    pairs = {(r["a"], r["t"]): r["n"] for r in words.groupBy("a", "t").agg(F.count("*").alias("n")).collect()}
    shares = [(*pair, share) for pair, share in _chance_shares(pairs, round(bad), round(n)).items() if share <= _FALSE]
    precise = words.where(a >= _PRECISION * (a + b))
    passing = F.broadcast(counts.sparkSession.createDataFrame(shares, "a int, t int, share double"))
    found = precise.join(passing, ["a", "t"]).select("id", "chi2", "share").union(
        whole.where(~_is_word(F.col("id")) & (F.col("chi2") >= _CHI2)).select("id", "chi2", F.lit(0.0).alias("share")))
    best = lambda rows: {r["id"]: r["share"] for r in rows.orderBy(F.desc("chi2"), "id").limit(limit).collect()}
    if fill and not shares:
        found = found.union(precise.select("id", "chi2", F.lit(1.0)))
    return best(found)


def _matrix(sample: DataFrame, value: str, ids: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(rows x ids use of the features, ``value``) of the fitting rows."""
    chosen = F.array(*[F.lit(i) for i in ids])
    used = sample.select("doc", F.col(value).cast("double").alias("y"), F.array_intersect("ids", chosen).alias("ids")).toArrow()
    used = used.take(np.argsort(used["doc"].to_numpy(), kind="stable"))
    x = np.zeros((used.num_rows, len(ids)))
    for r, mine in enumerate(used["ids"].to_pylist()):
        x[r, np.searchsorted(ids, mine)] = 1
    return x, used["y"].to_numpy()


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        sample_docs: int = 8000, max_features: int = 1024) -> Model:
    """Fit the classifier on a document table and its (partial) labels.

    Null texts and texts without words are junk; rows with a null id take part
    unlabelled; a repeated id is fitted once, by its smallest text.  Without
    toxic labels no row is called toxic; if no word stands out in the labelled
    toxic rows, the lexicon stays empty and the scorer learns from these rows
    alone; without documents every score is the constant 0.5 or less."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    known = checkpoint(_clean_labels(labels, id_col))
    picked = (rows.select("doc").where("doc is not null").distinct().join(known, "doc", "left")
              .orderBy(F.coalesce("quality", "toxic").isNull(), F.xxhash64("doc"), "doc").limit(sample_docs))
    picked = checkpoint(picked)  # at most sample_docs rows of three numbers
    sample = rows.join(F.broadcast(picked), "doc").groupBy("doc").agg(
        F.min("text").alias("text"), F.first("quality").alias("quality"), F.first("toxic").alias("toxic"))

    def list_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in text_runs(batch.column(1)):
                row, ids = features(data, offsets, measures(data, offsets)[0])
                edges = np.searchsorted(row, np.arange(j - i + 1)).astype(np.int32)
                low, high = _ends(data, offsets)
                yield pa.record_batch(
                    [batch.column(0)[i:j], pa.ListArray.from_arrays(pa.array(edges), pa.array(ids)), batch.column(2)[i:j],
                     batch.column(3)[i:j], low, high], names=["doc", "ids", "quality", "toxic", "low", "high"])

    sample = checkpoint(sample.select("doc", "text", "quality", "toxic").mapInArrow(
        releasing(list_features), "doc long, ids array<long>, quality int, toxic int, low long, high long"))
    # Copies of one bad text would make all of its words look bad: of the rows
    # that share their lowest or highest 8-word hash, one is fitted.
    for end in ("low", "high"):
        first = F.row_number().over(Window.partitionBy(F.coalesce(end, "doc"), F.col(end).isNull()).orderBy("doc"))
        sample = sample.withColumn("nth", first).where("nth = 1").drop("nth")
    sample = checkpoint(sample)
    marked = sample.where("toxic is not null")
    by_word = marked.select("toxic", F.explode("ids").alias("id")).where(_is_word(F.col("id"))).groupBy("id").agg(
        F.sum("toxic").cast("double").alias("bad"), F.sum(1 - F.col("toxic")).cast("double").alias("good"))
    totals = marked.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.coalesce(F.sum(1 - F.col("toxic")), F.lit(0))).first()
    strong = _chosen(by_word, totals, max_features)
    lexicon = Lexicon(np.array(sorted(strong), dtype=np.int64),
                      np.array(sorted(i for i, c in strong.items() if c <= _SURE), dtype=np.int64))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in text_runs(batch.column(1)):
                codes = [pa.array(code.astype(np.int32)) for code in votes(data, offsets, lexicon)]
                yield pa.record_batch([batch.column(0)[i:j], *codes], names=["doc", *QUESTIONS])

    # The human labels are one more labeller each, which abstains on most rows.
    said = {"marks": 2 - F.col("quality"), "repetition": 2 - F.col("quality"), "toxic": 1 + F.col("human_toxic")}
    people = known.withColumnRenamed("toxic", "human_toxic")
    ballots = rows.mapInArrow(releasing(vote), "doc long, " + ", ".join(f"{q} int" for q in QUESTIONS)).join(people, "doc", "left").select(
        "doc", *[(3 * F.col(q) + F.coalesce(said[q], F.lit(0))).alias(q) for q in QUESTIONS])
    ballots = checkpoint(ballots)
    patterns: dict[str, dict[int, int]] = {q: {} for q in QUESTIONS}
    for r in ballots.groupBy(*QUESTIONS).count().collect():
        for q in QUESTIONS:
            patterns[q][r[q]] = patterns[q].get(r[q], 0) + r["count"]
    posterior = {q: estimate(patterns[q], (len(used) or 3) + 1) for q, used in QUESTIONS.items()}
    if not len(lexicon.words):
        posterior["toxic"] = {code: float(code % 3 == BAD) for code in posterior["toxic"]}  # what people said is all there is

    own = ballots.join(F.broadcast(picked.select("doc")), "doc").groupBy("doc").agg(*[F.max(q).alias(q) for q in QUESTIONS])
    soft: dict[str, dict[int, float]] = {"junk": {}, "toxic": {}}
    for r in own.collect():  # at most sample_docs rows
        soft["junk"][r["doc"]] = 1 - (1 - posterior["marks"][r["marks"]]) * (1 - posterior["repetition"][r["repetition"]])
        soft["toxic"][r["doc"]] = posterior["toxic"][r["toxic"]]
    fitted = {name: _scorer(spark, sample, labels_of, max_features) for name, labels_of in soft.items()}
    return Model(**fitted)


def _scorer(spark: SparkSession, sample: DataFrame, soft: dict[int, float], limit: int) -> Scorer:
    """Scorer over the strongest features for the posterior labels ``soft``."""
    none = Scorer(np.zeros(0, np.int64), np.zeros(0), -5.0)
    if not soft:
        return none
    labelled = sample.join(F.broadcast(spark.createDataFrame(list(soft.items()), "doc long, p double")), "doc")
    counts = labelled.select("p", F.explode("ids").alias("id")).groupBy("id").agg(
        F.sum("p").alias("bad"), F.sum(1 - F.col("p")).alias("good"))
    # copies left the sample: totals and counts are of the rows that stayed
    totals = labelled.agg(F.coalesce(F.sum("p"), F.lit(0.0)), F.coalesce(F.sum(1 - F.col("p")), F.lit(0.0))).first()
    ids = sorted(_chosen(counts, totals, limit, fill=True))
    if not ids:
        return none
    weights, bias = train(*_matrix(labelled, "p", ids))
    return Scorer(np.array(ids, dtype=np.int64), weights, bias)


def score(docs: DataFrame, model: Model, text_col: str = "text", carry: list[str] | None = None,
          threshold: float = 0.5) -> DataFrame:
    """The ``carry`` columns (default: all) of every row with ``junk_score``,
    ``toxic_score`` and ``kept`` (both below ``threshold``).  Texts without
    words are never kept.  Input columns called like an output are replaced."""
    added = ("junk_score", "toxic_score", "kept")
    carry = [c for c in (docs.columns if carry is None else carry) if c not in added]
    schema = StructType([docs.schema[c] for c in carry] + [StructField("junk_score", DoubleType()), StructField("toxic_score", DoubleType()), StructField("kept", BooleanType())])

    at = carry.index(text_col) if text_col in carry else len(carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for _, _, data, offsets in text_runs(batch.column(at)):
                shares, n = measures(data, offsets)
                row, ids = features(data, offsets, shares)
                parts.append((model.junk(row, ids, len(n)), model.toxic(row, ids, len(n)), n > 0))
            junk, toxic, some = (np.concatenate(p) for p in zip(*parts)) if parts else (np.zeros(0), np.zeros(0), np.zeros(0, bool))
            junk = np.where(some, junk, 1.0)
            yield pa.record_batch([*batch.columns[:len(carry)], pa.array(junk), pa.array(toxic), pa.array((junk < threshold) & (toxic < threshold))],
                                  names=[*carry, *added])

    extra = [] if text_col in carry else [F.col(text_col).alias("__text")]
    return docs.select(*[F.col(f"`{c}`") for c in carry], *extra).mapInArrow(releasing(run), schema)
