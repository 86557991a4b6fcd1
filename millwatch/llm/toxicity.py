"""Toxicity by a subsequence string kernel: Nyström landmarks, a support vector machine on them, the worst word of a text."""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from millwatch.llm.common import table
from millwatch.session import ship

#: The kernel: subsequences of 2 to 4 letters that span no more than ``SPAN``, each weighted by ``DECAY`` to the power of its span.
LENGTHS, SPAN, DECAY = (2, 3, 4), 6, 0.65
#: Letters: a to z, four for all others, one for digits, one for the rest.
LETTERS = 32
#: Longer words are looked at in pieces of ``PIECE`` letters, every ``STEP``.
PIECE, STEP = 24, 12
#: Bounds of the sample that the classifier is fitted on: labelled documents of each class, and landmarks.
MAX_DOCS, LANDMARKS = 2000, 384
FOLDS, ROUNDS, COST = 4, 3, 1.0
#: Words of each text that may be its witness.
TOPS = 8
#: Standard deviations above chance from which a word of toxic texts is taken for a toxic word.
SURE = 4.0
#: Disguised forms of each witness that are learnt along with it, see ``disguises``.
DISGUISES = 3
#: Sightings that a subsequence must outweigh before the first guess believes it.
FAITH = 5.0
#: Words a task remembers, and words scored at once.
MEMORY_WORDS, BATCH_WORDS = 400000, 8192
EDGES = ".,;:!?\"'()[]{}<>|*#-_=+~`/\\$%&^"


@functools.lru_cache(1)
def _letters() -> np.ndarray:
    """Letter of each code point of the basic plane: without case and accents."""
    out = np.full(1 << 16, LETTERS - 1, "uint8")
    for point in range(1 << 16):
        char = chr(point)
        if char.isdigit():
            out[point] = LETTERS - 2
        elif char.isalpha():
            base = unicodedata.normalize("NFKD", char).lower()[:1]
            out[point] = ord(base) - 97 if "a" <= base <= "z" else 26 + point % 4
    return out


def spell(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letters of the words' pieces as rows filled up with zeros, their lengths, and the word of each."""
    pieces, owner = pieces_of(words)
    lengths = np.fromiter(map(len, pieces), "int64", len(pieces))
    points = np.frombuffer("".join(pieces).encode("utf-32-le", "surrogatepass"), "<u4")
    flat = np.where(points < 1 << 16, _letters()[np.minimum(points, (1 << 16) - 1)], LETTERS - 1)
    # Letters that go on and on count twice at most, so that they tell no more than they should.
    word = np.repeat(np.arange(len(pieces)), lengths)
    again = np.zeros(len(flat), bool)
    again[2:] = (flat[2:] == flat[1:-1]) & (flat[1:-1] == flat[:-2]) & (word[2:] == word[:-2])
    flat, lengths = flat[~again], np.bincount(word[~again], minlength=len(pieces))
    width = int(lengths.max(initial=1)) + SPAN
    rows = np.zeros((len(pieces), width), "int32")
    rows[np.arange(width) < lengths[:, None]] = flat
    return rows, lengths, owner


@functools.lru_cache(1)
def _shapes() -> list[tuple[tuple[int, ...], float, int]]:
    """Offsets of the letters of a subsequence, its weight, and where codes of its length begin."""
    out, start = [], 0
    for n in LENGTHS:
        def grow(offsets):
            if len(offsets) == n:
                out.append((tuple(offsets), DECAY ** (offsets[-1] + 1), start))
            else:
                for o in range(offsets[-1] + 1, SPAN):
                    grow([*offsets, o])

        grow([0])
        start += LETTERS ** n
    return out


N_CODES = sum(LETTERS ** n for n in LENGTHS)


def subsequences(rows: np.ndarray, lengths: np.ndarray, most: int = max(LENGTHS)) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """For each shape of up to ``most`` letters: codes at all places, which of them are inside the word, and the weight."""
    width = rows.shape[1] - SPAN
    at = np.arange(width)
    for offsets, weight, start in _shapes():
        if len(offsets) > most:
            continue
        code = rows[:, :width]
        for o in offsets[1:]:
            code = code * LETTERS + rows[:, o:o + width]
        yield code + start, at + offsets[-1] < lengths[:, None], weight


def norms(rows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Square root of the kernel of each word with itself.

    A subsequence that occurs once adds its squared weight, so most words have the norm of their length.
    Where one of two letters occurs again, the codes of the word are sorted and the weights of
    equal ones added before they are squared; only then can a longer one occur again.
    """
    total = sum(np.maximum(lengths - offsets[-1], 0) * weight ** 2 for offsets, weight, _ in _shapes()).astype("float64")
    # Words of like length go together, so that short ones are not filled up to the longest.
    by_length = np.argsort(lengths, kind="stable")
    for at in range(0, len(by_length), 1024):
        own = by_length[at:at + 1024]
        width = int(lengths[own[-1]]) + SPAN
        part, size = rows[own, :width], lengths[own]
        pairs = [np.where(inside, code, -1) for code, inside, _ in subsequences(part, size, 2)]
        pairs = np.sort(np.concatenate(pairs, axis=1), axis=1)
        again = np.flatnonzero(((pairs[:, 1:] == pairs[:, :-1]) & (pairs[:, 1:] >= 0)).any(axis=1))
        if not len(again):
            continue
        found = [(np.where(inside, code, -1), np.where(inside, weight, 0.0)) for code, inside, weight in subsequences(part[again], size[again])]
        code, weight = (np.concatenate(c, axis=1) for c in zip(*found))
        order = np.argsort(code, axis=1)
        code, weight = np.take_along_axis(code, order, 1), np.take_along_axis(weight, order, 1)
        # Sum of squared sums over runs of equal codes, row by row.
        start = np.flatnonzero(np.c_[np.ones(len(again), bool), code[:, 1:] != code[:, :-1]].ravel())
        sums = np.add.reduceat(weight.ravel(), start)
        total[own[again]] = np.bincount(start // code.shape[1], sums ** 2, len(again))
    return np.sqrt(np.maximum(total, 1e-12))


def pieces_of(words: list[str]) -> tuple[list[str], np.ndarray]:
    """Each word, a long one in pieces, and the word of each piece."""
    pieces, owner = [], []
    for i, word in enumerate(words):
        cut = [word] if len(word) <= PIECE else [word[at:at + PIECE] for at in range(0, len(word) - PIECE + STEP, STEP)]
        pieces += cut
        owner += [i] * len(cut)
    return pieces, np.array(owner, "int64")


def kernel(left: list[str], right: list[str]) -> np.ndarray:
    """Normalised kernel values between words of one piece each (see ``pieces_of``)."""
    rows, lengths, _ = spell(right)
    parts = [(code[inside], np.broadcast_to(np.arange(len(right))[:, None], inside.shape)[inside], weight) for code, inside, weight in subsequences(rows, lengths)]
    codes, column = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    weights = np.concatenate([np.full(len(p[0]), p[2]) for p in parts])
    known, spot = np.unique(codes, return_inverse=True)
    features = np.zeros((len(known) + 1, len(right)), "float32")
    np.add.at(features, (spot, column), weights.astype("float32"))
    features /= norms(rows, lengths).astype("float32")
    place = np.full(N_CODES, len(known), "int32")
    place[known] = np.arange(len(known))
    out = np.zeros((len(left), len(right)), "float32")
    for at in range(0, len(left), 2048):
        rows, lengths, _ = spell(left[at:at + 2048])
        for code, inside, weight in subsequences(rows, lengths):
            spot = np.where(inside, place[code], len(known))
            for column in spot.T:
                hit = np.flatnonzero(column < len(known))
                out[at + hit] += features[column[hit]] * np.float32(weight)
        out[at:at + 2048] /= norms(rows, lengths)[:, None]
    return out


def words_of(text: str | None) -> set[str]:
    """Words of a text in lower case, without marks at their edges; three or more lone characters in a row also make a word."""
    words = (text or "").lower().split()
    found = {w.strip(EDGES) for w in set(words)}
    lone = [i for i, w in enumerate(words) if len(w) == 1]
    run: list[int] = []
    for i in [*lone, -1]:
        if run and i == run[-1] + 1:
            run.append(i)
            continue
        if len(run) > 2:
            found.add("".join(words[k] for k in run))
        run = [i]
    found.discard("")
    return found


@dataclass
class ToxicityModel:
    """The decision function as one weight for each subsequence.

    The machine's function is a weighted sum of kernels to landmarks, and a kernel is a sum over
    subsequences, so the sums are exchanged once after fitting: scoring a word looks up its own
    subsequences, and the landmarks are no longer needed.
    """

    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def margins(self, words: list[str]) -> np.ndarray:
        out = np.full(len(words), -np.inf)
        for at in range(0, len(words), BATCH_WORDS):
            part = words[at:at + BATCH_WORDS]
            rows, lengths, owner = spell(part)
            total = np.zeros(len(rows))
            for code, inside, weight in subsequences(rows, lengths):
                total += np.where(inside, self.weights[code], 0).sum(1) * weight
            np.maximum.at(out, at + owner, total / norms(rows, lengths) + self.bias)
        return out

    def probability(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.offset, -50, 50)))


def disguises(word: str, rng: np.random.Generator) -> list[str]:
    """A word as it is written to slip through: a letter put in, a mark put in, marks between all letters."""
    if len(word) < 3:
        return []
    a, b = rng.integers(1, len(word), 2)
    return [word[:a] + chr(97 + int(rng.integers(26))) + word[a:], word[:b] + "*" + word[b:], ".".join(word)]


def _svm(x: np.ndarray, y: np.ndarray, c: np.ndarray, start: tuple[np.ndarray, float] | None = None) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss, by Newton steps: the problem has a few hundred unknowns."""
    x1 = np.c_[x, np.ones(len(x))].astype("float64")
    ridge = np.r_[np.ones(x.shape[1]), 1e-6]
    w = np.r_[start[0], start[1]] if start else np.zeros(x1.shape[1])

    def loss(v):
        return 0.5 * (ridge * v * v).sum() + (c * np.maximum(1 - y * (x1 @ v), 0) ** 2).sum()

    for _ in range(30):
        gap = 1 - y * (x1 @ w)
        on = gap > 0
        gradient = ridge * w - 2 * x1[on].T @ (c[on] * y[on] * gap[on])
        step = np.linalg.solve(np.diag(ridge) + 2 * (x1[on] * c[on, None]).T @ x1[on], -gradient)
        size, now = 1.0, loss(w)
        while size > 1e-6 and loss(w + size * step) > now + 1e-4 * size * gradient @ step:
            size /= 2
        w = w + size * step
        if np.abs(step).max() * size < 1e-4:
            break
    return w[:-1], float(w[-1])


def _platt(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset that turn margins into probabilities, with targets pulled in from 0 and 1."""
    n1, n0 = (y > 0).sum(), (y <= 0).sum()
    t = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x, w = np.c_[margin, np.ones(len(margin))], np.array([1.0, 0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-6 * np.eye(2), x.T @ (t - p) - 1e-6 * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return max(float(w[0]), 1e-3), float(w[1])


def _first_guess(counts: np.ndarray, share: float) -> ToxicityModel:
    """Log odds of each subsequence in words of toxic texts, drawn to the mean where it is rare."""
    rate = (counts[1] + FAITH * share) / (counts.sum(0) + FAITH)
    return ToxicityModel((np.log(rate / (1 - rate)) - np.log(share / (1 - share))).astype("float32"), 0.0, 1.0, 0.0)


def _sightings(vocabulary: list[str], df: np.ndarray) -> np.ndarray:
    """Weighted sightings of each subsequence, from document counts of words (any number of rows)."""
    counts = np.zeros((len(df), N_CODES), "float32")
    for at in range(0, len(vocabulary), 8 * BATCH_WORDS):
        rows, lengths, owner = spell(vocabulary[at:at + 8 * BATCH_WORDS])
        for code, inside, weight in subsequences(rows, lengths):
            i, codes = at + owner[np.nonzero(inside)[0]], code[inside]
            for k in range(len(df)):
                counts[k] += np.bincount(codes, df[k, i] * weight, N_CODES).astype("float32") if df[k, i].any() else 0
    return counts


def fit(bags: Iterable[list[str]], labels: list[int], seed: int = 5) -> ToxicityModel:
    """Learn from the words (see ``words_of``) of labelled texts which of them make a text toxic.

    A toxic text has a toxic word somewhere, a clean one none. Which word that is, its witness, is
    settled in rounds: the machine is trained on the witnesses against the worst-looking and random
    words of clean texts, and names new ones; a text without any word that looks toxic then teaches nothing, as its
    label may be wrong. A text's witness and margin always come from
    texts of the other folds, so a rare word is not believed because of its own text alone. The
    first guess weighs subsequences by how much more often words of toxic texts have them. With one
    class only, or no words, the score is the rate of toxic texts.
    """
    rng = np.random.default_rng(seed)
    y = np.array([1 if label else 0 for label in labels], "int64")
    first: dict[str, int] = {}
    bags = [np.array([first.setdefault(w, len(first)) for w in sorted(bag)], "int64") for bag in bags]
    vocabulary = sorted(first)
    if not vocabulary or len(set(y.tolist())) < 2 or min(y.sum(), len(y) - y.sum()) < FOLDS:
        rate = (y.sum() + 1) / (len(y) + 2)
        return ToxicityModel(np.zeros(N_CODES, "float32"), 0.0, 1.0, float(np.log(rate / (1 - rate))))
    place = np.empty(len(vocabulary), "int64")
    place[[first.pop(w) for w in vocabulary]] = np.arange(len(vocabulary))
    bags = [np.sort(place[bag]) for bag in bags]
    fold = np.empty(len(y), "int64")
    for label in (0, 1):  # each fold has its part of either class
        fold[y == label] = rng.permutation(int((y == label).sum())) % FOLDS

    df = np.zeros((2 * FOLDS, len(vocabulary)))
    for bag, label, f in zip(bags, y, fold):
        df[2 * f + label, bag] += 1
    counts = _sightings(vocabulary, df)
    share = df[1::2].sum() / df.sum()
    tops: list[np.ndarray] = [np.zeros(0, "int64")] * len(y)
    for f in range(FOLDS):
        others = [i for i in range(2 * FOLDS) if i // 2 != f]
        guess = _first_guess(np.stack([counts[[i for i in others if i % 2 == k]].sum(0) for k in (0, 1)]), share)
        mine = np.flatnonzero(fold == f)
        seen = np.unique(np.concatenate([bags[i] for i in mine] or [np.zeros(0, "int64")]))
        score = np.full(len(vocabulary), -np.inf)
        score[seen] = guess.margins([vocabulary[i] for i in seen])
        for i in mine:
            tops[i] = bags[i][np.argsort(-score[bags[i]], kind="stable")[:TOPS]]

    # From here on, only the words that look worst in some text, and some at random.
    general = rng.choice(len(vocabulary), min(4000, len(vocabulary)), replace=False)
    words = np.unique(np.concatenate([*tops, general]))
    place = np.full(len(vocabulary), -1)
    place[words] = np.arange(len(words))
    tops = [place[t] for t in tops]
    general = place[general[df[::2].sum(0)[general] > 0]]
    # A word that clean texts have as well is no witness, whatever the label of the text.
    rate = (df[1::2].sum(0)[words] / y.sum(), df[::2].sum(0)[words] / (1 - y).sum())
    telling = rate[0] > 4 * rate[1]
    # One that far more toxic texts have than chance would give is a witness in any round.
    seen = df[:, words].sum(0)
    sure = telling & (df[1::2].sum(0)[words] - seen * y.mean() > SURE * np.sqrt(seen * y.mean() * (1 - y.mean()) + 1))
    # Landmarks: half of them words that tell toxic texts, the most frequent first, the others from the worst-looking of clean texts and at random.
    lead, often = np.unique(np.concatenate([t[telling[t]][:4] for t, label in zip(tops, y) if label]), return_counts=True)
    lead = lead[np.argsort(-often, kind="stable")][:LANDMARKS // 2]
    worst = rng.permutation(np.concatenate([t[:2] for t, label in zip(tops, y) if not label]))[:LANDMARKS // 4]
    rest = rng.permutation(np.r_[general, np.concatenate(tops)])
    landmarks = list(dict.fromkeys(pieces_of([vocabulary[words[i]] for i in dict.fromkeys([*lead, *worst, *rest])])[0]))[:LANDMARKS]
    values, vectors = np.linalg.eigh(kernel(landmarks, landmarks).astype("float64"))
    root = vectors[:, values > 1e-4] / np.sqrt(values[values > 1e-4])
    # A long word is as many rows as it has pieces, in the fit as in scoring; the worst piece speaks for it.
    pieces, owner = pieces_of([vocabulary[i] for i in words])
    x = kernel(pieces, landmarks) @ root
    of_word = np.split(np.arange(len(pieces)), np.flatnonzero(np.diff(owner)) + 1)
    broken: dict[int, np.ndarray] = {}
    last: list[tuple[np.ndarray, float]] = []

    def train(docs: np.ndarray, witness: list[np.ndarray]) -> tuple[np.ndarray, float]:
        bad, times = np.unique(np.concatenate([witness[i] for i in docs if y[i]]), return_counts=True)
        fine, seen = np.unique(np.concatenate([general, *(tops[i] for i in docs if not y[i])]), return_counts=True)
        for i in bad:
            if i not in broken:
                broken[i] = kernel(pieces_of(disguises(vocabulary[words[i]], rng))[0], landmarks) @ root
        more = [broken[i] for i in bad]
        rows = np.concatenate([x[of_word[i]] for i in bad] + more + [x[of_word[i]] for i in fine])
        half = times / max(times.sum(), 1) * COST * (len(bad) + len(fine)) / 2
        sizes = [np.array([len(of_word[i]) for i in k], "int64") for k in (bad, fine)]
        share = [np.repeat(half / np.maximum(n, 1), n) for n in (sizes[0], np.array([len(m) for m in more], "int64"))]
        light = seen / seen.sum() * COST * (len(bad) + len(fine))
        weight = np.concatenate([*share, np.repeat(light, sizes[1])])
        n_fine = int(sizes[1].sum())
        last.append(_svm(rows, np.r_[np.ones(len(rows) - n_fine), -np.ones(n_fine)], weight, last[-1] if last else None))
        return last[-1]

    everyone = np.arange(len(y))
    witness = [np.union1d(t[telling[t]][:1], t[sure[t]]) for t in tops]
    margin = np.zeros(len(y))
    for _ in range(ROUNDS):
        new = list(witness)
        for f in range(FOLDS):
            w, bias = train(everyone[fold != f], witness)
            score = np.full(len(words), -np.inf)
            np.maximum.at(score, owner, x @ w + bias)
            for i in everyone[fold == f]:
                margin[i] = score[tops[i]].max() if len(tops[i]) else bias
                # All words that look toxic now, so that a text with several teaches all of them.
                able = tops[i][telling[tops[i]]]
                new[i] = able[(score[able] > 0) | sure[able]]
        if sum(len(new[i]) > 0 for i in everyone[y == 1]) * 3 < y.sum():
            break
        witness = new
    w, bias = train(everyone, witness)
    slope, offset = _platt(margin, y)
    return ToxicityModel(_collapsed(landmarks, root @ w), bias, slope, offset)


def _collapsed(landmarks: list[str], alpha: np.ndarray) -> np.ndarray:
    """The weighted sum of kernels to the landmarks as one weight for each subsequence."""
    rows, lengths, _ = spell(landmarks)
    out, scale = np.zeros(N_CODES), alpha / norms(rows, lengths)
    for code, inside, weight in subsequences(rows, lengths):
        np.add.at(out, code[inside], np.broadcast_to(scale[:, None], inside.shape)[inside] * weight)
    return out.astype("float32")


def learn(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS) -> ToxicityModel:
    """Fit on at most ``max_docs`` labelled documents of each class, those of the smallest hashes.

    Rows without a text, an id or a label, and ids with contradicting labels, are left out.
    """
    told = (labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
            .agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("other")).where("toxic = other").select("doc_id", F.col("toxic").cast("int").alias("toxic")))
    texts = docs.where("text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    order = [F.md5(F.col("doc_id").cast("string")), F.col("doc_id")]
    # The bound holds for each class by itself; ids come first, so that only the texts of the sample are moved.
    chosen = [told.where(f"toxic = {k}").orderBy(*order).limit(max_docs) for k in (0, 1)]
    sample = texts.join(chosen[0].unionByName(chosen[1]), "doc_id").dropDuplicates(["doc_id"])
    ship(docs.sparkSession)

    @F.pandas_udf("string")
    def bag(text: pd.Series) -> pd.Series:
        return text.map(lambda t: "\n".join(words_of(t)))

    # The driver gets the distinct words of the sample, not its texts.
    told = sample.select("doc_id", "toxic", bag("text").alias("words")).orderBy(*order).toPandas()
    return fit((w.split("\n") if w else [] for w in told.words), told.toxic.tolist())


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """Add ``score``, the probability that a document is toxic, and ``predicted`` (1 from 0.5).

    The score is that of the worst word of the whole text; words that a task has met are remembered. A null
    or empty text has the score of a word that shares nothing with the landmarks. Columns of these
    names are replaced; all others, nulls and repeated rows pass as they are. No rows, no output.
    """
    spark = ship(docs.sparkSession)
    sent = spark.sparkContext.broadcast(model)  # a few MB: N_CODES weights, whatever the input
    rest = docs.drop("score", "predicted")

    def run(parts):
        import pyarrow as pa

        model, memory = sent.value, {}
        for whole in parts:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                bags = [words_of(t) for t in batch.column("_text").to_pylist()]
                new = list({w for bag in bags for w in bag}.difference(memory))
                if len(memory) + len(new) > MEMORY_WORDS:
                    memory.clear()
                    new = list({w for bag in bags for w in bag})
                memory.update(zip(new, model.margins(new).tolist()))
                margins = np.array([max(map(memory.__getitem__, bag), default=model.bias) for bag in bags])
                p = model.probability(margins)
                columns = [batch.column(i) for i in range(batch.num_columns - 1)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(p), pa.array((p >= 0.5).astype("int32"))], names=[*batch.schema.names[:-1], "score", "predicted"])

    schema = T.StructType([*rest.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return rest.withColumn("_text", docs["text"].cast("string")).mapInArrow(run, schema)


def held_out() -> Column:
    """Whether a document's label may not be learnt from."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0


def op1_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = learn(docs, table(spark, sf_dir, "labels").where(~held_out()))
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")
