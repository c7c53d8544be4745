"""Toxicity by weak supervision: many voters, a generative label model, a linear classifier.

1. Voters. Lexicon voters count terms of a lexicon (whole words or beginnings of words)
   that set toxic texts apart in a bounded labelled sample, or that stand in a fixed list.
   Pattern voters look at pairs of neighbouring words, insults aimed at a person, and
   density. A voter says toxic (1) or abstains (0): a lexicon knows few languages, so
   its silence alone speaks for nothing.
2. Label model. Sums of votes and of pairs of votes over all documents give each voter's
   hit rates in both classes (from triplets of covariances) and, from what covariance the
   classes leave unexplained, the correlations between voters. A document's posterior adds
   the voters' log-likelihood ratios, each divided by how many voters repeat its evidence.
3. Classifier. Logistic regression over hashed words and word beginnings, fitted to the
   posteriors of a bounded sample, scores every whole text.

Only rows outside the held-out fold are learned from. Defined results: a null or empty
text has no terms and gets the score of the bias; repeated rows get equal scores; without
any usable label the fixed voters alone decide. Extra columns are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm.features import LinearModel, fit_ftrl, labelled_sample, one_text_each, remainder, sigmoid
from wayfare.llm.words import Words, bound_batches, combine, hash_words, word_chunks

FOLDS = 3
HELD_OUT = 1
THRESHOLD = 0.7
# Bounds of the samples that are collected: labelled rows for the lexicons, and rows with
# posterior labels for the classifier.
LEXICON_ROWS = 6_000
TRAINING_ROWS = 6_000
BITS = 20

PREFIXES = (4, 5, 6, 7)
# (least toxic texts with the term, least share of toxic texts among texts with it)
STRENGTHS = ((10, 0.92), (5, 0.9))
_LEAST_RATE, _PRIOR_SMOOTHING = 1e-4, 10
_LEAST_TEXTS = 3

# Common insults and the words that aim them at a person.
_INSULTS = """
idiot idiots moron morons stupid imbecile trash scum loser losers clown pathetic worthless disgusting garbage retard
dumb dumbass asshole bastard bitch fool jerk filth vermin scumbag subhuman
trottel dummkopf arschloch abschaum widerlich dreck versager schwachkopf vollidiot
crétin connard salope ordure abruti débile racaille minable
idiota imbécil estúpido basura escoria payaso inútil cabrón gilipollas
"""
_AIMING = "you your youre du ihr dein tu vous ton eres usted son are"


def _hashes(words: str) -> np.ndarray:
    data = np.frombuffer(" ".join(words.split()).encode(), np.uint8)
    return np.unique(hash_words(data, np.array([0, len(data)])).hashes)


@dataclass(frozen=True)
class Lexicon:
    """Terms of one stream: 0 whole words, k beginnings of k bytes, -2 pairs of neighbours."""

    stream: int
    terms: np.ndarray

    def hits(self, hashes: np.ndarray) -> np.ndarray:
        """Whether each hash is a term; a small table first rules out nearly all."""
        found = np.zeros(len(hashes), bool)
        if len(self.terms) and len(hashes):
            table = np.zeros(1 << 16, bool)
            table[self.terms >> np.uint64(48)] = True
            maybe = np.flatnonzero(table[hashes >> np.uint64(48)])
            found[maybe] = np.isin(hashes[maybe], self.terms)
        return found


def _streams(words: Words) -> dict[int, np.ndarray]:
    h = words.hashes
    pairs = np.zeros(len(h), np.uint64)
    if len(h) > 1:
        pairs[:-1] = combine(h[:-1], h[1:])
        ends = words.first[1:] - 1
        pairs[ends[(ends >= 0) & (np.diff(words.first) > 0)]] = 0
    return {0: h, -2: pairs} | words.prefixes


_WORDS = {"lower": True, "signs": True, "prefixes": PREFIXES}


def _per_text(words: Words, marks: np.ndarray) -> np.ndarray:
    """Sum of marks of each text's words."""
    sums = np.concatenate([[0], np.cumsum(marks)])
    return sums[words.first[1:]] - sums[words.first[:-1]]


@dataclass(frozen=True)
class Voters:
    """All voters: lexicons, each voting at one and at two hits, and the patterns."""

    lexicons: tuple[Lexicon, ...]

    @property
    def count(self) -> int:
        return 2 * len(self.lexicons) + 3

    def votes(self, words: Words) -> np.ndarray:
        """0 or 1 per text and voter."""
        streams, columns = _streams(words), []
        any_hit = np.zeros(len(words.hashes), bool)
        insults = np.zeros(len(words.hashes), bool)
        for k, lexicon in enumerate(self.lexicons):
            hit = lexicon.hits(streams[lexicon.stream])
            hits = _per_text(words, hit)
            columns += [hits >= 1, hits >= 2]
            any_hit |= hit
            if k == 0:
                insults = hit
        size = np.maximum(np.diff(words.first), 1)
        found = _per_text(words, any_hit)
        aiming = Lexicon(0, _hashes(_AIMING)).hits(words.hashes)
        aimed = np.zeros(len(words.hashes), bool)
        inside = np.ones(len(words.hashes), bool)
        inside[words.first[:-1][np.diff(words.first) > 0]] = False
        for gap in (1, 2):
            aimed[gap:] |= aiming[:-gap] & any_hit[gap:] & inside[gap:] & (inside[1 : len(inside) - gap + 1] if gap > 1 else True)
        columns += [_per_text(words, aimed) >= 1, found * 100 >= size, _per_text(words, insults) >= 4]
        return np.stack(columns, axis=1).astype(np.int64)


def learn_lexicons(sample: DataFrame) -> Voters:
    """Lexicons from a bounded labelled sample (doc_id, text, label); the first is the fixed list."""
    streams = (0, *PREFIXES, -2)

    def terms(batches):
        for batch in batches:
            out = {s: [] for s in streams}
            for _, _, words in word_chunks(batch.column(0), **_WORDS):
                own = _streams(words)
                for a, b in zip(words.first, words.first[1:]):
                    for s in streams:
                        out[s].append(np.unique(own[s][a:b]).view(np.int64))
            for s in streams:
                flat = [pa.array(np.concatenate(out[s]) if out[s] else np.empty(0, np.int64))]
                sizes = [len(x) for x in out[s]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(sum(sizes), s), pa.int32()),
                        flat[0],
                        pa.array(np.repeat(batch.column(1).to_numpy(), sizes), pa.int32()),
                    ],
                    names=["stream", "term", "label"],
                )

    least = min(count for count, _ in STRENGTHS)
    counted = (
        sample.select("text", F.col("label").cast("int"))
        .mapInArrow(terms, "stream int, term long, label int")
        .groupBy("stream", "term")
        .agg(F.sum("label").alias("toxic"), F.count(F.lit(1)).alias("all"))
        .where((F.col("toxic") >= least) & (F.col("toxic") >= (F.col("all") + 0.5) * min(s for _, s in STRENGTHS)))
    )
    got = counted.toArrow().sort_by([("stream", "ascending"), ("term", "ascending")])
    stream, term = got["stream"].to_numpy(), got["term"].to_numpy().view(np.uint64)
    toxic, every = got["toxic"].to_numpy(), got["all"].to_numpy()
    lexicons = [Lexicon(0, _hashes(_INSULTS))]
    for s in streams:
        for count, share in STRENGTHS:
            kept = (stream == s) & (toxic >= count) & (toxic >= (every + 0.5) * share) & (term != 0)
            lexicons.append(Lexicon(s, np.sort(term[kept])))
    return Voters(tuple(lexicons))


@dataclass(frozen=True)
class LabelModel:
    """Hit rates of each voter in both classes, its share of independent evidence, and the prior."""

    toxic_rate: np.ndarray
    clean_rate: np.ndarray
    evidence: np.ndarray
    prior: float

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        yes = np.log(self.toxic_rate / self.clean_rate) * self.evidence
        # All voters silent: that happens to toxic texts no more often than the best voter misses them.
        silent = np.log(1 - self.toxic_rate.max(initial=0)) * (votes.sum(axis=1) == 0)
        return sigmoid(votes @ yes + silent + np.log(self.prior / (1 - self.prior)))


def vote_sums(documents: DataFrame, voters: Voters) -> np.ndarray:
    """Numbers of documents with both votes, for each pair of voters; the last row and column count documents.

    Each task adds up its documents, so that a matrix of fixed size per task is moved.
    """
    size = voters.count + 1

    def sums(batches):
        total = np.zeros((size, size), np.int64)
        for batch in batches:
            for _, _, words in word_chunks(batch.column(0), **_WORDS):
                votes = voters.votes(words)
                votes = np.concatenate([votes, np.ones((len(votes), 1), np.int64)], axis=1)
                total += votes.T @ votes
        i, j = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], names=["i", "j", "n"])

    rows = documents.select("text").mapInArrow(sums, "i int, j int, n long").groupBy("i", "j").agg(F.sum("n").alias("n")).collect()
    out = np.zeros((size, size))
    for i, j, n in rows:
        out[i, j] = n
    return out


def fit_label_model(sums: np.ndarray, prior: float) -> LabelModel:
    """Accuracies from triplets, correlations from the covariance that the classes leave.

    With hit rates a (toxic) and b (clean) and independent voters, the covariance of two
    voters is prior (1 - prior) (a - b)(a' - b'). Any two others give a voter's a - b; the
    median over them is robust to pairs that are correlated for other reasons.
    """
    total = max(sums[-1, -1], 1)
    rate = (sums[:-1, -1] + 1e-9) / total
    covariance = sums[:-1, :-1] / total - np.outer(rate, rate)
    spread, m = prior * (1 - prior), len(rate)
    usable = rate * total >= 3
    gap = np.zeros(m)
    for i in np.flatnonzero(usable):
        # The two votes of one lexicon are never used together.
        others = [j for j in np.flatnonzero(usable) if j // 2 != i // 2]
        found = [
            covariance[i, j] * covariance[i, k] / covariance[j, k]
            for n, j in enumerate(others)
            for k in others[n + 1 :]
            if j // 2 != k // 2 and covariance[j, k] > 1e-9
        ]
        gap[i] = np.sqrt(max(np.median(found) if found else spread * rate[i], 0) / spread)
    toxic = np.clip(rate + (1 - prior) * gap, _LEAST_RATE, 1 - 1e-2)
    clean = np.clip(rate - prior * gap, 1e-3, 1 - 1e-2)
    toxic = np.where(usable, np.maximum(toxic, clean), clean)
    within = np.sqrt(prior * toxic * (1 - toxic) + (1 - prior) * clean * (1 - clean))
    rest = (covariance - spread * np.outer(toxic - clean, toxic - clean)) / np.outer(within, within)
    rest = np.clip(rest, 0, 1)
    np.fill_diagonal(rest, 1)
    return LabelModel(toxic, clean, np.where(usable, 1 / rest.sum(axis=1), 0.0), prior)


def _feature_indices(words: Words) -> list[np.ndarray]:
    streams = _streams(words)
    shift = np.uint64(64 - BITS)
    return [(streams[s] >> shift).astype(np.int32) for s in (0, *PREFIXES)]


_FTRL = {"alpha": 1.0, "l1": 4.0, "l2": 0.01, "passes": 5}


def fit(documents: DataFrame, labels: DataFrame, lexicon_rows: int = LEXICON_ROWS, training_rows: int = TRAINING_ROWS) -> LinearModel:
    """Voters, label model and classifier, from documents outside the held-out fold."""
    bound_batches(documents.sparkSession)
    learned = remainder(F.col("doc_id"), FOLDS) != HELD_OUT
    used = labels.where(learned)
    voters = learn_lexicons(labelled_sample(documents, used, "toxic", lexicon_rows))
    toxic, known = used.agg(F.sum(F.col("toxic").cast("int")), F.count("toxic")).first()
    prior = ((toxic or 0) + 1) / (known + _PRIOR_SMOOTHING)
    model = fit_label_model(vote_sums(documents, voters), prior)
    ids = documents.where(learned).select("doc_id").dropDuplicates()
    drawn = ids.orderBy(F.xxhash64("doc_id", F.lit("toxic")), "doc_id").limit(training_rows)
    sample = one_text_each(documents, drawn)

    def examples(batches):
        for batch in batches:
            vectors, targets = [], []
            for _, _, words in word_chunks(batch.column(1), **_WORDS):
                targets.append(model.posterior(voters.votes(words)))
                own = _feature_indices(words)
                vectors += [np.unique(np.concatenate([x[a:b] for x in own])) for a, b in zip(words.first, words.first[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.concatenate(targets) if targets else []), pa.array(vectors, pa.list_(pa.int32()))],
                names=["doc_id", "target", "indices"],
            )

    def train(batches):
        """All examples are in one task: they are ``training_rows`` at most, as distinct features."""
        parts = list(batches)
        if not parts:
            return
        got = pa.Table.from_batches(parts).sort_by("doc_id")
        target = got["target"].to_numpy()
        texts = np.zeros(1 << BITS, np.int32)
        for own in got["indices"]:
            texts[np.asarray(own.values)] += 1
        # Terms of one or two texts teach nothing; without them little of the sample stays in memory.
        lists = [i[texts[i] >= _LEAST_TEXTS] for i in (np.asarray(own.values) for own in got["indices"])]
        one = np.ones(max(map(len, lists), default=0), np.float32)
        model = fit_ftrl([(i, one[: len(i)]) for i in lists], target, BITS, **_FTRL)
        columns = [pa.array([model.indices], pa.list_(pa.int32())), pa.array([model.weights], pa.list_(pa.float32())), pa.array([model.bias])]
        yield pa.RecordBatch.from_arrays(columns, names=["indices", "weights", "bias"])

    kind = sample.schema["doc_id"].dataType.simpleString()
    made = sample.mapInArrow(examples, f"doc_id {kind}, target double, indices array<int>")
    # An executor trains, so that the driver gets the weights alone.
    fitted = made.repartition(1).mapInArrow(train, "indices array<int>, weights array<float>, bias double").toArrow()
    if not fitted.num_rows:
        return fit_ftrl([], np.empty(0), BITS, **_FTRL)
    row = fitted.slice(0, 1)
    indices, weights = (np.asarray(row[c].combine_chunks().values) for c in ("indices", "weights"))
    return LinearModel(BITS, indices, weights, row["bias"][0].as_py())


def _scores(texts: pa.Array, model: LinearModel, table: np.ndarray) -> np.ndarray:
    """Sum of the weights of the different terms that each text has, as a probability."""
    scores = np.zeros(len(texts))
    for row, until, words in word_chunks(texts, **_WORDS):
        owner = np.repeat(np.arange(until - row), np.diff(words.first))
        keys = []
        for indices in _feature_indices(words):
            at = np.flatnonzero(table[indices])
            keys.append(owner[at] << BITS | indices[at])
        keys = np.unique(np.concatenate(keys))
        weights = table[keys & ((1 << BITS) - 1)]
        scores[row:until] = sigmoid(np.bincount(keys >> BITS, weights, until - row) + model.bias)
    return scores


def score(documents: DataFrame, model: LinearModel, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""

    def run(batches):
        table = model.dense()
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(_scores(batch.column(1), model, table))], names=["doc_id", "score"]
            )

    kind = documents.schema["doc_id"].dataType.simpleString()
    scored = documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")
    return scored.select(
        "doc_id",
        F.coalesce(remainder(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_accepted(documents: DataFrame, model: LinearModel, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score below the threshold, with their columns; each is judged by its own text."""

    def run(batches):
        table = model.dense()
        for batch in batches:
            yield batch.filter(pa.array(_scores(batch.column("text"), model, table) < threshold))

    return documents.mapInArrow(run, documents.schema)
