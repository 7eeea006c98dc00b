"""Quality classifier: weak labellers weighed by expectation-maximisation, then a hashed linear scorer.

Two facets are judged apart, `junk` (low quality) and `toxic`, each with its own overlapping labellers;
a document is kept when neither scorer calls it bad.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from eventloom.llm import kernels as K
from eventloom.llm.repetition import SYMBOLS

BITS = 24
GOOD, BAD, ABSTAIN = 0, 1, 2
#: Labellers that look at the text alone, in the order of their columns.  On top come an annotator, who gave the
#: labels, and for `toxic` two lexicons mined in the two halves of the labelled sample: insults of languages, or of
#: one community, that no fixed list has.
JUNK = ("length", "symbols", "repeats", "variety", "word_length", "lines", "pipes")
TOXIC = ("insults", "contempt", "swearing")

# Words that mark each toxic labeller's lexicon, and what may stand after them.
LEXICONS = (
    "idiot idiots moron morons loser losers clown clowns scum trash imbecile fool fools jerk creep dumbass bastard vermin parasite pig swine cretin lunatic "
    "crétin imbécile abruti ordure connard salaud dummkopf trottel abschaum arschloch schwein versager imbécil estúpidos basura payaso cabrón perdedor",
    "stupid pathetic disgusting worthless dumb useless ugly filthy repulsive vile despicable idiotic moronic brainless ridiculous revolting hateful "
    "stupide pathétique dégoûtant minable répugnant dumm erbärmlich ekelhaft wertlos widerlich estúpido estúpida patético patética asqueroso asquerosa inútil",
    "damn crap shit fuck fucking bitch asshole bullshit piss screw hell merde putain foutre scheiße scheisse verdammt mierda joder puta",
)
SUFFIXES = ("", ".", ",", "!", "?", ";", ":", "!!", "...", "'s")


def _hashes(words: str) -> np.ndarray:
    """Hashes of the words with each suffix, sorted."""
    raw = [(w + x).encode() for w in words.split() for x in SUFFIXES]
    ends = np.cumsum([len(x) for x in raw])
    return np.unique(K.span_hashes(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], ends[:-1]]), ends))


_MARKS = [_hashes(x) for x in LEXICONS]


def statistics(part: K.Texts) -> tuple[dict[str, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """Counts for each row, and its distinct hashed words as (row, bucket)."""
    rows, buf = len(part), part.buf
    starts, ends, first = part.words()
    n = np.diff(first)
    row = np.repeat(np.arange(rows), n)
    h = K.span_hashes(K.LOWER[buf], starts, ends)
    per_row = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[part.offsets])
    three = K.combine(h, 3)
    same_row = row[2:] == row[:-2] if len(row) > 2 else np.zeros(0, bool)

    def distinct(r: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.lexsort((x, r))
        r, x = r[order], x[order]
        new = np.ones(len(r), bool)
        new[1:] = (r[1:] != r[:-1]) | (x[1:] != x[:-1])
        return r[new], x[new]

    r3, _ = distinct(row[:-2][same_row], three[same_row]) if len(same_row) else (row[:0], three)
    rw, words = distinct(row, h)
    a, b, line_first = part.lines()
    line_row = np.repeat(np.arange(rows), np.diff(line_first))
    rl, _ = distinct(line_row, K.span_hashes(buf, a, b))
    count = lambda r: np.bincount(r, minlength=rows)[:rows]
    marks = np.stack([count(row[np.isin(h, x)]) for x in _MARKS], axis=1)
    out = {
        "marks": marks, "words": n, "chars": per_row(~K.SEPARATOR[buf] & ((buf & 0xC0) != 0x80)), "symbols": per_row(SYMBOLS[buf]), "pipes": per_row(buf == ord("|")),
        "triples": np.maximum(n - 2, 0), "distinct_triples": count(r3), "distinct_words": count(rw), "lines": np.diff(line_first), "distinct_lines": count(rl),
    }
    return out, (rw, (words >> np.uint64(64 - BITS)).astype(np.int64))


def junk_votes(s: dict[str, np.ndarray]) -> np.ndarray:
    """A column of votes for each of JUNK."""
    n = np.maximum(s["words"], 1)
    share = lambda x, of: x / np.maximum(of, 1)

    def vote(bad: np.ndarray, good: np.ndarray) -> np.ndarray:
        return np.where(bad, BAD, np.where(good, GOOD, ABSTAIN))

    again = 1 - share(s["distinct_triples"], s["triples"])
    again = np.where(s["triples"] > 0, again, 0)
    variety = share(s["distinct_words"], n)
    length = share(s["chars"], n)
    lines = np.where(s["lines"] > 0, 1 - share(s["distinct_lines"], s["lines"]), 0)
    return np.stack([
        vote(s["words"] < 5, s["words"] >= 20),
        vote(s["symbols"] > 0.25 * n, s["symbols"] < 0.02 * n),
        vote(again > 0.35, again < 0.12),
        vote((variety < 0.12) & (s["words"] >= 50), variety > 0.3),
        vote((length < 2) | (length > 14), (length > 3) & (length < 9)),
        vote(lines > 0.4, lines < 0.2),
        vote(s["pipes"] > 0.2 * n, s["pipes"] < 0.02 * n),
    ], axis=1).astype(np.int8)


def toxic_votes(s: dict[str, np.ndarray]) -> np.ndarray:
    """A column of votes for each of TOXIC."""
    long = (s["words"] >= 5)[:, None]
    return np.where(s["marks"] > 0, BAD, np.where(long, GOOD, ABSTAIN)).astype(np.int8)


def all_votes(s: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([junk_votes(s), toxic_votes(s)], axis=1)


def vote_features(votes: np.ndarray) -> np.ndarray:
    """Feature numbers (above the hashed words) of the votes."""
    return (1 << BITS) + np.arange(votes.shape[1]) * 3 + votes


CONSTANT = (1 << BITS) + 3 * (len(JUNK) + len(TOXIC))
#: Words in fewer sampled documents, or of weaker log-odds, have no weight.
LEAST_DOCUMENTS, LEAST_ODDS = 4, 2.0


@dataclass
class WeakModel:
    """Accuracies of labellers: P(vote | class) for each, and the share of bad documents."""

    prior: float
    tables: np.ndarray = field(repr=False)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """P(bad | votes), the labellers independent given the class."""
        logs = np.log([1 - self.prior, self.prior])[None, :].repeat(len(votes), 0)
        for k in range(votes.shape[1]):
            logs += np.log(self.tables[k][:, votes[:, k]]).T
        return 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -50, 50)))


def expectation_maximisation(votes: np.ndarray, weight: np.ndarray, rounds: int = 100, smooth: float = 1.0) -> WeakModel:
    """Fits a WeakModel to vote patterns and how often each occurs.

    Every labeller's accuracy is estimated.  What ties the two classes to their meaning is where all start:
    as cautious labellers, whose bad votes are rare and seldom wrong.
    """
    k = votes.shape[1]
    tables = np.empty((k, 2, 3))
    tables[:] = np.array([[0.65, 0.03, 0.32], [0.35, 0.40, 0.25]])
    model = WeakModel(0.15, tables)
    for _ in range(rounds if len(votes) else 0):
        bad = model.posterior(votes)
        tables = model.tables.copy()
        for j in range(k):
            for c, p in ((0, 1 - bad), (1, bad)):
                tables[j, c] = np.bincount(votes[:, j], weights=p * weight, minlength=3) + smooth
        tables /= tables.sum(axis=2, keepdims=True)
        model = WeakModel(float(np.clip((bad * weight).sum() / weight.sum(), 1e-4, 0.9)), tables)
    return model


@dataclass
class Linear:
    """Weights of the features that occur in the sample often enough; others weigh nothing.

    A feature's value is the size of its log-odds between the classes in the sample, so words that tell
    the classes apart lead, and words that merely occur don't drown them."""

    features: np.ndarray = field(repr=False)
    weights: np.ndarray = field(repr=False)

    def score(self, rows: np.ndarray, features: np.ndarray, n: int) -> np.ndarray:
        at = np.searchsorted(self.features, features).clip(max=len(self.features) - 1)
        w = np.where(self.features[at] == features, self.weights[at], 0)
        return 1 / (1 + np.exp(-np.clip(np.bincount(rows, weights=w, minlength=n), -30, 30)))


def train_linear(rows: np.ndarray, features: np.ndarray, target: np.ndarray, rounds: int = 300, rate: float = 0.05, penalty: float = 1e-3) -> Linear:
    """Logistic regression on soft targets over sparse features, valued by log-odds; AdaGrad on whole batches.

    Hashed words are kept if they occur in LEAST_DOCUMENTS rows and lean to a class by LEAST_ODDS."""
    n = len(target)
    names, at, often = np.unique(features, return_inverse=True, return_counts=True)
    bad = np.bincount(at, weights=target[rows], minlength=len(names)) if n else np.zeros(0)
    n_bad = float(target.sum())
    odds = np.log((bad + 0.5) / (n_bad + 1)) - np.log((often - bad + 0.5) / (n - n_bad + 1))
    use = ((often >= LEAST_DOCUMENTS) & (np.abs(odds) >= LEAST_ODDS)) | (names >= 1 << BITS)
    value_of = np.where(names == CONSTANT, 1.0, np.abs(odds))[use]
    kept = use[at]
    rows, at, names = rows[kept], (np.cumsum(use) - 1)[at[kept]], names[use]
    if not len(names):
        return Linear(np.array([CONSTANT]), np.zeros(1, np.float32))
    value, weights, squares = value_of[at], np.zeros(len(names)), np.full(len(names), 1e-8)
    share = float(np.clip(target.mean(), 1e-3, 1 - 1e-3))
    balance = np.where(target > 0.5, 0.5 / share, 0.5 / (1 - share))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(rows, weights=weights[at] * value, minlength=n), -30, 30)))
        g = np.bincount(at, weights=((p - target) * balance)[rows] * value, minlength=len(names)) / n + penalty * weights
        squares += g * g
        weights -= rate * g / np.sqrt(squares)
    return Linear(names, (weights * value_of).astype(np.float32))


@dataclass
class Classifier:
    junk: Linear
    toxic: Linear
    junk_labellers: WeakModel
    toxic_labellers: WeakModel

    def scores(self, part: K.Texts) -> np.ndarray:
        """P(junk), P(toxic) for each row."""
        rows, features = row_features(part)
        return np.stack([x.score(rows, features, len(part)) for x in (self.junk, self.toxic)], axis=1)


def row_features(part: K.Texts) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of hashed words, votes and a constant."""
    s, (rows, words) = statistics(part)
    extra = np.concatenate([vote_features(all_votes(s)), np.full((len(part), 1), CONSTANT)], axis=1)
    return np.concatenate([rows, np.repeat(np.arange(len(part)), extra.shape[1])]), np.concatenate([words, extra.ravel()])


def lexicon(rows: np.ndarray, words: np.ndarray, bad: np.ndarray, least: int = 4) -> np.ndarray:
    """The hashed words that mark bad rows: in `least` of them at least, and nine of ten rows that have them are bad."""
    names, at = np.unique(words, return_inverse=True)
    in_bad, in_all = np.bincount(at[bad[rows]], minlength=len(names)), np.bincount(at, minlength=len(names))
    return names[(in_bad >= least) & (in_bad >= 0.9 * in_all)]


def fit(df: DataFrame, labels: DataFrame, sample_rows: int = 6_000, sample_features: int = 20_000, key: str = "doc_id", text: str = "text") -> Classifier:
    """Fits on the texts of at most `sample_rows` labelled rows (those of least hash of the key), of each its
    `sample_features` greatest feature numbers at most (votes, then hashed words; hashes make that a sample).
    The labellers' accuracies, the annotator's and the mined lexicons' too, are estimated by EM from the votes on all rows of `df`.

    Labels (key, quality, toxic: 1 or 0, null for unknown) are the votes of an annotator, one labeller among
    others.  Of several label rows of a key the worse values count; labels without a key or without a text
    don't.  Of several rows of a sampled key one is taken; rows of null key vote without an annotator.  The
    driver sees the sample's feature numbers, in size bounded by the two parameters, and counts of vote
    patterns, bounded by the number of labellers.  Without rows or labels all scores are what the votes give.
    """
    chosen = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).cast("long").alias(key)).agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    sampled = chosen.orderBy(F.xxhash64(key), key).limit(sample_rows).toPandas()
    wanted = np.sort(sampled[key].to_numpy(np.int64)) if len(sampled) else np.zeros(0, np.int64)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(batch.column(0).is_valid())
            batch = batch.filter(pa.array(np.isin(batch.column(0).to_numpy(), wanted)))
            for part in K.blocks(batch.column(1)):
                rows, found = row_features(part)
                order = np.lexsort((-found, rows))
                rows, found = rows[order], found[order]
                keep = np.arange(len(rows)) - np.searchsorted(rows, rows) < sample_features
                rows, found = rows[keep], found[keep]
                offsets = np.searchsorted(rows, np.arange(len(part) + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(found.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(part.first, len(part)), lists], [key, "features"])

    source = df.select(F.col(key).cast("long").alias(key), text)
    sample = source.mapInArrow(features, f"`{key}` long, features array<int>").groupBy(key).agg(F.min("features").alias("features"))
    sample = sample.toPandas().merge(sampled, on=key).sort_values(key).reset_index(drop=True)
    counts = sample["features"].map(len).to_numpy(np.int64) if len(sample) else np.zeros(0, np.int64)
    rows = np.repeat(np.arange(len(sample), dtype=np.int32), counts)
    found = np.concatenate(sample.pop("features").tolist()) if len(sample) else np.zeros(0, np.int32)
    said_toxic = sample["toxic"].to_numpy(float) == 1 if len(sample) else np.zeros(0, bool)
    is_word, half = found < 1 << BITS, np.arange(len(sample)) % 2 == 0
    lexicons = [lexicon(rows[use], found[use], said_toxic) for use in (is_word & half[rows], is_word & ~half[rows])]

    def mined(r: np.ndarray, words: np.ndarray, n: int) -> np.ndarray:
        return np.stack([np.where(np.bincount(r[np.isin(words, x)], minlength=n) > 0, BAD, GOOD) for x in lexicons], axis=1).astype(np.int8)

    def votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in K.blocks(batch.column(1)):
                s, (r, words) = statistics(part)
                both = np.concatenate([all_votes(s), mined(r, words, len(part))], axis=1)
                code = (both.astype(np.int64) * 3 ** np.arange(both.shape[1])).sum(axis=1)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(part.first, len(part)), pa.array(code)], [key, "code"])

    said = F.coalesce(F.col("quality"), F.lit(-1)).alias("quality"), F.coalesce(F.col("toxic"), F.lit(-1)).alias("toxic")
    judged = source.mapInArrow(votes, f"`{key}` long, code long").join(chosen, key, "left")
    patterns = judged.groupBy("code", *said).count().toPandas()  # at most 3 to the power of labellers rows
    n_junk, n_fixed = len(JUNK), len(JUNK) + len(TOXIC)
    width = n_fixed + len(lexicons)
    table = (patterns["code"].to_numpy(np.int64)[:, None] // 3 ** np.arange(width)) % 3 if len(patterns) else np.zeros((0, width), np.int64)
    weight = patterns["count"].to_numpy(float)

    def annotated(values: np.ndarray, bad: int) -> np.ndarray:
        return np.where(values == bad, BAD, np.where((values == 0) | (values == 1), GOOD, ABSTAIN)).astype(np.int64)

    own = np.full((len(sample), width), ABSTAIN, np.int64)
    own[:, n_fixed:] = mined(rows[is_word], found[is_word], len(sample))
    vote = (found >= 1 << BITS) & (found < CONSTANT)
    own[rows[vote], (found[vote] - (1 << BITS)) // 3] = (found[vote] - (1 << BITS)) % 3
    models, scorers = [], []
    for facet, column, bad in ((slice(0, n_junk), "quality", 0), (slice(n_junk, width), "toxic", 1)):
        model = expectation_maximisation(np.column_stack([table[:, facet], annotated(patterns[column].to_numpy(), bad)]), weight)
        target = model.posterior(np.column_stack([own[:, facet], annotated(sample[column].to_numpy(float) if len(sample) else np.zeros(0), bad)]))
        models.append(model)
        scorers.append(train_linear(rows, found, target))
    return Classifier(*scorers, *models)


def classify(df: DataFrame, model: Classifier, threshold: float = 0.5, text: str = "text") -> DataFrame:
    """Adds junk_score, toxic_score (both 0 to 1) and kept: neither is over `threshold`.

    Null and empty texts have no words and get what the votes on them say; equal texts get equal scores, whatever their keys.
    Existing columns of these names are replaced.  No shuffle; the model, whose size the sample bounds,
    goes with the tasks.
    """
    df = df.drop("junk_score", "toxic_score", "kept")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [model.scores(p) for p in K.blocks(batch.column(batch.schema.names.index(text)))]
            scores = np.concatenate(parts) if parts else np.zeros((0, 2))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores[:, 0]), pa.array(scores[:, 1]), pa.array((scores <= threshold).all(axis=1))], [*batch.schema.names, "junk_score", "toxic_score", "kept"])

    fields = ", ".join(f"`{x.name}` {x.dataType.simpleString()}" for x in df.schema)
    return df.mapInArrow(run, f"{fields}, junk_score double, toxic_score double, kept boolean")
