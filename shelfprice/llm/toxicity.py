"""Toxicity by a subsequence string-kernel SVM with Nystroem landmarks.

Kernel. Two words are compared by their common subsequences of three letters, gaps
allowed: each occurrence counts DECAY ** (letters from its first to its last), and the
kernel is normalised. So ``stuxpid`` or ``st-u-pid`` stays near ``stupid``. Before that
a word is folded: lower case, only letters and digits kept, digits and signs that stand
for letters read as such; runs of one-letter words are also read as one word
(``i d i o t``). Words of over ``WIDE`` letters are read in overlapping windows.

Model. ``m`` landmark words give each word the Nystroem features
K(landmarks, landmarks) ** -1/2 · k(word, landmarks), on which a linear SVM is trained
by dual coordinate descent. Its decision is then one weighted sum over a word's
subsequences, because a landmark's kernel row is one too: the weights fold into a table
of one number for each letter triple. So scoring costs the same for any m.

Labels. Documents carry labels, sentences don't, and no sentence is cut out: the SVM's
rows are single words. A *witness* is a word that documents of the toxic class hold much
oftener than the others. Witnesses, also with letters put in or set apart, are the positive
words, words of clean documents the negative ones. A document's decision comes from its
``TOP`` highest word decisions; a logistic curve fitted to the training documents turns it
into a score between 0 and 1. So insults made of several ordinary words are not seen, nor
words set apart into pieces of two letters (``id iot``).

Fixed cut-offs of the mining: beginnings of 4 letters or more in 5 or more toxic documents
(and 0.4 % of them), 12 times as common as among clean ones; 1,500 witnesses; landmarks
from the first 600; the 4,000 commonest clean words and 16,000 drawn from all.

Training reads a bounded sample: ``sample`` documents of either class (those with the
smallest hash of their id; only documents of up to ``LONGEST`` characters are taken for
training). Near copies within the sample are left out, as their words aren't
independent. Only this sample comes to the driver. Scoring reads every whole text.

Defined results: null and empty texts, and texts without a word of three letters, get
the score of a document without any toxic word. Repeated rows score alike. Of several
labels of a document the largest counts; null labels are ignored. Without training
rows of both classes every score is 0. Input columns named like an output are replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from heapq import nlargest
from itertools import combinations
from sys import intern
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table

DECAY = 0.6
WIDE = 16
LETTERS = 64
LONGEST = 20_000
TOP = 3
FOLDED = str.maketrans("013457@$!|", "oleastasil")
JUNK = re.compile(r"[\W_]+")


def fold(word: str) -> str:
    """Letters of a lower-case word; signs within it are read as letters, those around
    it are dropped."""
    if word.isalpha():
        return word
    return JUNK.sub("", word.strip(".,;:!?\"'()[]{}<>*%&#~|-").translate(FOLDED))


def words_of(text: str) -> set[str]:
    """The distinct folded words of a text, windows of long ones, and joined runs of
    one-letter words."""
    raw = text.lower().split()
    found = {fold(w) for w in set(raw)}
    run: list[str] = []
    for w in [*raw, "--"]:
        if len(w) == 1 and w.isalnum():
            run.append(w)
        elif run:
            if len(run) > 2:
                found.add("".join(run).translate(FOLDED))
            run = []
    for w in [w for w in found if len(w) > WIDE]:
        found.discard(w)
        found.update(w[at:at + WIDE] for at in range(0, len(w) - WIDE // 2, WIDE // 2))
    return {w for w in found if len(w) > 2}


def codes(words: list[str]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By length: (positions in the list, letter numbers). a to z have numbers of their
    own, other letters share the rest."""
    by: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        by.setdefault(len(w), []).append(i)
    out = {}
    for n, at in by.items():
        c = np.frombuffer("".join(words[i] for i in at).encode("utf-32-le", "surrogatepass"), np.uint32)
        c = c.reshape(-1, n).astype(np.int64)
        c = np.where((c >= 97) & (c < 123), c - 97, 26 + c % (LETTERS - 27))
        # a mark before the first letter: beginnings weigh more than what follows
        out[n] = np.array(at), np.hstack([np.full((len(at), 1), LETTERS - 1), c])
    return out


_triples: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def triples(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of all three-letter subsequences of a word of ``n`` letters, their weights."""
    if n not in _triples:
        at = np.array(list(combinations(range(n), 3)), np.int64).reshape(-1, 3)
        _triples[n] = at, DECAY ** (at[:, 2] - at[:, 0] + 1.0)
    return _triples[n]


def subsequences(c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words x triples) triple numbers and the weights of their places."""
    at, weight = triples(c.shape[1])
    return (c[:, at[:, 0]] * LETTERS + c[:, at[:, 1]]) * LETTERS + c[:, at[:, 2]], weight


def norms(c: np.ndarray) -> np.ndarray:
    """Square root of each word's kernel with itself, by the kernel's recursion."""
    b, n = c.shape
    same = [[c[:, i] == c[:, j] for j in range(n)] for i in range(n)]
    inner = np.ones((n + 1, n + 1, b))
    for _ in range(2):
        step = np.zeros((n + 1, n + 1, b))
        for i in range(1, n + 1):
            row = np.zeros(b)
            for j in range(1, n + 1):
                row = DECAY * row + np.where(same[i - 1][j - 1], DECAY ** 2 * inner[i - 1, j - 1], 0.0)
                step[i, j] = DECAY * step[i - 1, j] + row
        inner = step
    total = np.zeros(b)
    for i in range(1, n + 1):
        for j in range(1, n + 1):
            total += np.where(same[i - 1][j - 1], DECAY ** 2 * inner[i - 1, j - 1], 0.0)
    return np.sqrt(total)


def kernel(words: list[str], landmarks: list[str]) -> np.ndarray:
    """Normalised subsequence kernel, words x landmarks."""
    out = np.zeros((len(words), len(landmarks)))
    groups = [(at, *subsequences(c), norms(c)) for at, c in codes(words).values()]
    for l, w in enumerate(landmarks):
        (_, c), = codes([w]).values()
        number, weight = subsequences(c)
        row = np.zeros(LETTERS ** 3)
        np.add.at(row, number[0], weight)
        row /= norms(c)[0]
        for at, numbers, weights, norm in groups:
            out[at, l] = (row[numbers] @ weights) / norm
    return out


class Model:
    """A folded decision function, and a logistic curve over a document's highest
    decisions."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights.astype(np.float32), bias
        self.curve = np.array([1.0] + [0.0] * TOP)

    def decide(self, words: list[str], block: int = 4096) -> np.ndarray:
        out = np.full(len(words), self.bias)
        for at, c in codes(words).values():
            for k in range(0, len(at), block):
                numbers, weights = subsequences(c[k:k + block])
                out[at[k:k + block]] += (self.weights[numbers] @ weights) / norms(c[k:k + block])
        return out

    def highest(self, bags: list[set[str]], decided: dict[str, float]) -> np.ndarray:
        """(documents x TOP) highest decisions, falling; the bias where words are few."""
        out = np.full((len(bags), TOP), self.bias)
        for i, bag in enumerate(bags):
            best = nlargest(TOP, map(decided.__getitem__, bag))
            out[i, :len(best)] = best
        return out

    def score(self, highest: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(highest @ self.curve[:-1] + self.curve[-1], -60, 60)))


def svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray, rounds: int = 40, seed: int = 0) -> np.ndarray:
    """Weights (the last one is the bias) of a linear hinge-loss SVM, by dual
    coordinate descent."""
    x = np.hstack([x, np.ones((len(x), 1))])
    square, alpha, w = (x * x).sum(1), np.zeros(len(x)), np.zeros(x.shape[1])
    rng = np.random.default_rng(seed)
    for _ in range(rounds):
        most = 0.0
        for i in rng.permutation(len(x)):
            slope = y[i] * (w @ x[i]) - 1
            new = min(max(alpha[i] - slope / square[i], 0.0), cost[i])
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x[i]
                most = max(most, abs(new - alpha[i]))
                alpha[i] = new
        if most < 1e-3:
            break
    return w


def gapped(word: str, rng: np.random.Generator) -> str:
    """The word with one letter put in."""
    at = int(rng.integers(1, len(word)))
    return word[:at] + chr(97 + int(rng.integers(26))) + word[at:]


def fit(texts: list[str], toxic: list[int], prior: float | None = None, m: int = 96,
        seed: int = 0) -> Model | None:
    """Train on labelled texts; None without texts of both classes. ``prior``: the share
    of toxic documents among all labelled ones (in the sample, if None)."""
    # of a text's five-word shingles one in eight is kept, the same ones of every text:
    # a text half of whose kept shingles came before is a near copy and left out
    seen: set[int] = set()
    bags, labels = [], []
    for t, y in zip(texts, toxic):
        w = t.split()
        shingles = {h for h in (crc32(" ".join(w[i:i + 5]).encode("utf-8", "surrogatepass"))
                                for i in range(max(1, len(w) - 4))) if h % 8 == 0}
        if len(shingles & seen) * 2 <= len(shingles):
            bags.append({intern(x) for x in words_of(t)})
            labels.append(y)
        seen |= shingles
    del seen
    y = np.array(labels)
    if len(set(labels)) < 2:
        return None
    count = [Counter(), Counter()]
    for bag, label in zip(bags, labels):
        count[label].update(bag)
    n0, n1 = int((y == 0).sum()), int((y == 1).sum())
    # beginnings of words: those of enough toxic documents, then how many clean ones have them
    begin = [Counter(), Counter()]
    for bag, label in zip(bags, labels):
        if label:
            begin[1].update({w[:k] for w in bag for k in range(4, len(w) + 1)})
    begin[1] = Counter({w: c for w, c in begin[1].items() if c >= 5})
    for bag, label in zip(bags, labels):
        if not label:
            begin[0].update({w[:k] for w in bag for k in range(4, len(w) + 1) if w[:k] in begin[1]})
    telling = {w for w, c in begin[1].items()
               if c >= 5 and c >= 0.004 * n1 and c / n1 > 12 * (begin[0][w] + 0.5) / n0}
    witnesses = sorted((w for w in count[1] if any(w[:k] in telling for k in range(4, len(w) + 1))
                        and count[1][w] / n1 > 4 * count[0][w] / n0), key=lambda w: (-count[1][w], w))
    if not witnesses:
        return None
    rng = np.random.default_rng(seed)
    witnesses = witnesses[:1500]
    clean = sorted(count[0], key=lambda w: (-count[0][w], w))
    clean = clean[:4000] + [clean[i] for i in sorted(rng.choice(len(clean), min(len(clean), 16000), replace=False))]
    clean = [w for w in dict.fromkeys(clean) if w not in set(witnesses)]
    # landmarks: the commonest witnesses that no chosen one is close to, and clean words
    landmarks: list[str] = []
    for w in witnesses[:600]:
        if len(landmarks) < m * 2 // 3 and (not landmarks or kernel([w], landmarks).max() < 0.8):
            landmarks.append(w)
    landmarks += clean[:max(8, m - len(landmarks))]
    values, vectors = np.linalg.eigh(kernel(landmarks, landmarks))
    root = vectors * (1 / np.sqrt(np.maximum(values, 1e-6))) @ vectors.T
    # letters put into every witness; sets apart by signs fold away
    positive = witnesses + [gapped(w, rng) for w in witnesses for _ in range(2 if count[1][w] > 0.05 * n1 else 1)
                            if 4 < len(w) < WIDE]
    near = kernel(clean, landmarks[:-1] if len(landmarks) > 1 else landmarks).max(1)
    hard = np.argsort(-near, kind="stable")[:4000]
    negative = list(dict.fromkeys([clean[i] for i in hard] + clean[:6000]))
    x = kernel(positive + negative, landmarks) @ root
    target = np.concatenate([np.ones(len(positive)), -np.ones(len(negative))])
    # a word counts by how many documents hold it, one with a letter put in for less
    cost = np.array([np.log1p(1000 * count[1][w] / n1) for w in positive[:len(witnesses)]]
                    + [0.6] * (len(positive) - len(witnesses))
                    + [2 * np.log1p(1000 * count[0][w] / n0) for w in negative]) * 4
    w = svm(x, target, cost, seed=seed)
    beta = root @ w[:-1]
    folded = np.zeros(LETTERS ** 3)
    for l, b in zip(landmarks, beta):
        (_, c), = codes([l]).values()
        numbers, weight = subsequences(c)
        np.add.at(folded, numbers[0], b * weight / norms(c)[0])
    model = Model(folded, float(w[-1]))
    # the curve: logistic regression of the label on a document's highest decisions
    words = sorted(set().union(*bags))
    d = model.highest(bags, dict(zip(words, model.decide(words).tolist())))
    d = np.hstack([d, np.ones((len(d), 1))])
    prior = n1 / (n0 + n1) if prior is None else prior
    weight = np.where(y == 1, prior / n1, (1 - prior) / n0)
    curve, ridge = model.curve.copy(), np.diag([1e-4] * TOP + [1e-9])
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(d @ curve, -60, 60)))
        slope = d.T @ ((p - y) * weight) + ridge @ curve
        step = np.linalg.solve((d * (p * (1 - p) * weight)[:, None]).T @ d + ridge, slope)
        curve -= np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-6:
            break
    model.curve = curve
    return model


def held_out(id_col: str = "doc_id"):
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(5)) == 0


def train(docs: DataFrame, labels: DataFrame, sample: int = 2000, id_col: str = "doc_id",
          text: str = "text") -> Model | None:
    """Fit on ``sample`` labelled documents of either class at most, none held out."""
    known = (labels.where(F.col("toxic").isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
             .groupBy(id_col).agg((F.max("toxic") > 0).cast("int").alias("_y")))
    chosen = known.where("_y = 0").orderBy(F.xxhash64(id_col), id_col).limit(sample) \
        .union(known.where("_y = 1").orderBy(F.xxhash64(id_col), id_col).limit(sample))
    rows = (docs.select(id_col, F.col(text).alias("_t")).where(F.length("_t") <= LONGEST)
            .join(F.broadcast(chosen), id_col)  # 2 * sample ids at most
            .orderBy(F.xxhash64(id_col), id_col).limit(4 * sample).collect())
    rows.sort(key=lambda r: (r._y, r[id_col], r._t))
    return fit([r._t for r in rows], [r._y for r in rows], known.agg(F.avg("_y")).first()[0])


def score(df: DataFrame, model: Model | None, text: str = "text", keep_text: bool = False) -> DataFrame:
    """``df`` with ``score`` and ``predicted``, without ``text`` unless ``keep_text``."""
    kept = [c for c in df.columns if c not in ("score", "predicted") and (keep_text or c != text)]
    schema = T.StructType([df.schema[c] for c in kept] + [T.StructField("score", T.DoubleType()),
                                                         T.StructField("predicted", T.IntegerType())])
    KNOWN = 200_000  # words whose decision a task keeps; then it starts afresh

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, float] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                if model is None:
                    scores = np.zeros(part.num_rows)
                else:
                    bags = [words_of(t.as_py() or "") for t in part.column(text)]
                    fresh = [w for w in set().union(*bags) if w not in known]
                    if len(known) + len(fresh) > KNOWN:
                        known, fresh = {}, list(set().union(*bags))
                    known.update(zip(fresh, model.decide(fresh).tolist()))
                    scores = model.score(model.highest(bags, known))
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in kept]
                    + [pa.array(scores, pa.float64()), pa.array((scores >= 0.5).astype(np.int32))],
                    names=kept + ["score", "predicted"])

    return df.select(*kept, *([] if keep_text else [text])).mapInArrow(run, schema)


def keep_clean(docs: DataFrame, labels: DataFrame, sample: int = 2000) -> DataFrame:
    """``docs``, its columns in order, without the rows scored as toxic."""
    made = [F.col(c).alias(f"_{i}") for i, c in enumerate(docs.columns)]
    at = docs.columns.index("text")
    scored = score(docs.select(*made), train(docs, labels, sample), f"_{at}", keep_text=True)
    return scored.where("predicted = 0").select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(docs.columns)])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2: the toxicity score of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"),
                                     "score", "predicted")
