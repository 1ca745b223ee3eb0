"""Toxicity by a subsequence-kernel support vector machine with Nyström landmarks.

Kernel: two words are alike if they share gapped subsequences of three characters; a
subsequence counts ``DECAY ** span``, its span (from first to last character) at most
``SPAN``, so inserted characters cost a little instead of breaking the match.  The
kernel is normalised by each word's own length in that feature space.

Nyström: kernel values against a set of landmark words, turned by the inverse square
root of the landmarks' own kernel matrix, are the features of a linear SVM (squared
hinge).  A trained machine is then one weight for each subsequence of a landmark, so a
word's margin costs one lookup for each of its subsequences.

Texts are labelled, their sentences and words are not.  A sentence machine learns from labelled
sentences: kernel of two sentences is the sum of the kernel over their pairs of words, the examples
are each toxic text's worst sentence under the machine before (at first under the words that tell the
classes apart best) against the worst and the first sentence of clean texts.  It needs no word to be
toxic in itself.  A word machine learns from words that occur almost only in texts marked toxic against words
of clean texts, then again with the clean words that it scored worst; without such words it stays silent.

A text's evidence is the margin of its worst word, the number and sum of the positive margins of
its distinct words, the margin of its worst sentence, all seen against its length; a logistic curve
turns that into the score.  It is fitted on labelled texts that the sentence machine did not learn from.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import Memo, bounded_batches, map_batches, pack_scratch, split_words, worker_state
from panelcast.llm.language_id import sample_labelled

SPAN, DECAY, BINS = 7, 0.7, 1 << 20
#: Bounds of the training sample: labelled texts of each class, words of each class, landmarks.
TEXTS, WORDS, LANDMARKS = 4000, 20_000, 160
#: A word of toxic texts is an example if it is in so many of them and so many times likelier there.
MIN_TEXTS, MIN_RATIO = 4, 12.0
#: Longest word of a training example in characters (all words are scored).
LONGEST = 48
KEPT = 300_000
#: Words whose subsequences are held in memory at a time.
STEP = 20_000
NO_WORD = -9.0
#: Words of a sentence (longer ones are cut), weight of each class of sentences, rounds that pick them anew.
SENTENCE, SENTENCE_COST, SENTENCE_ROUNDS = 24, 200.0, 3

_MUL = np.array([2654435761, 2246822519, 3266489917], np.uint32)
_STEPS = [(j, k) for j in range(1, SPAN - 1) for k in range(j + 1, SPAN)]


def cleaned(word: str) -> str:
    """A word's letters and digits."""
    return word if word.isalnum() else "".join(filter(str.isalnum, word))


def tokens(texts: list[str | None]):
    """Lower-cased parts of the texts between white space: (code of each part, distinct parts cleaned
    to letters and digits, first part of each text and the end, words spelled out in single characters
    ("i d i o t") as (text, word, place of the first part), which distinct parts end a sentence)."""
    low = pa.array([(t or "").lower() for t in texts], pa.large_string())
    for blank in "\n\t\r\x0b\x0c":
        low = pc.replace_substring(low, blank, " ")
    code, raw, first = split_words(low)
    words = [cleaned(w) for w in raw]
    spelled = []
    single = np.fromiter((len(w) == 1 for w in raw), bool, len(raw))[code] if len(code) else np.zeros(0, bool)
    at = np.flatnonzero(single)
    if len(at) > 2:
        owner = np.searchsorted(first, at, side="right") - 1
        new = np.r_[True, (at[1:] != at[:-1] + 1) | (owner[1:] != owner[:-1])]
        start = np.flatnonzero(new)
        size = np.diff(np.r_[start, len(at)])
        for s, n in zip(start[size > 2].tolist(), size[size > 2].tolist()):
            spelled.append((int(owner[s]), "".join(words[c] for c in code[at[s] : at[s] + n]), int(at[s])))
    ends = np.fromiter((not w[-1:].isalnum() and any(c in ".!?" for c in w[-4:]) for w in raw), bool, len(raw))
    return code, words, first, spelled, ends


def sentence_starts(code: np.ndarray, first: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first part of each sentence, its text): sentences end behind a full stop or such and after ``SENTENCE`` parts."""
    new = np.zeros(len(code), bool)
    new[first[:-1]] = True
    new[1:] |= ends[code[:-1]]
    start = np.flatnonzero(new)
    at = np.arange(len(code)) - np.repeat(start, np.diff(np.r_[start, len(code)]))
    start = np.flatnonzero(at % SENTENCE == 0)
    return start, np.searchsorted(first, start, side="right") - 1


def sentence_sums(add: np.ndarray, add_spelled: np.ndarray, code: np.ndarray, start: np.ndarray, spelled: list) -> np.ndarray:
    """Sum over each sentence's words, a word spelled out counting where it starts."""
    total = np.add.reduceat(add[code], start)
    if spelled:
        np.add.at(total, np.searchsorted(start, [at for _, _, at in spelled], side="right") - 1, add_spelled)
    return total


def words_of(text: str | None) -> list[str]:
    """Distinct cleaned words of one text."""
    _, words, _, spelled, _ = tokens([text])
    return list({*words, *(w for _, w, _ in spelled)} - {""})


def subsequences(words: list[str]):
    """Gapped three-character subsequences of the words between two end marks: (bin, weight, word)
    of each, in flat arrays."""
    words = [f"\x02{w}\x03" if w else "" for w in words]
    n = np.array([len(w) for w in words], np.int64)
    c = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    left = np.repeat(np.cumsum(n), n) - np.arange(len(c))  # characters from here to the word's end
    owner = np.repeat(np.arange(len(words)), n)
    m = [c * k for k in _MUL]
    bins, weights, own = [], [], []
    for j, k in _STEPS:
        at = np.flatnonzero(left > k)
        if not len(at):
            continue
        h = m[0][at] ^ (m[1][at + j] + np.uint32(0x9E3779B9)) * np.uint32(5) ^ m[2][at + k] * np.uint32(9)
        bins.append(((h ^ (h >> np.uint32(15))) * np.uint32(2246822519) >> np.uint32(12)).astype(np.int64))
        weights.append(np.full(len(at), DECAY ** (k + 1), np.float32))
        own.append(owner[at])
    if not bins:
        return np.zeros(0, np.int64), np.zeros(0, np.float32), np.zeros(0, np.int64)
    return np.concatenate(bins), np.concatenate(weights), np.concatenate(own)


def lengths(weights, own, n: int) -> np.ndarray:
    """Length of each word in the feature space (1 for words without a subsequence)."""
    return np.sqrt(np.maximum(np.bincount(own, weights * weights, minlength=n), 1e-12))


@dataclass
class Machine:
    weight: np.ndarray  # by subsequence bin
    bias: float
    tag: str = ""  # tells machines apart in a worker
    curve: tuple[float, ...] = (1.0, 0.0, 0.0, 0.0, 0.0, 0.0)  # slopes of the evidence, then the shift
    sentence: np.ndarray | None = None  # the sentence machine's weights by bin
    shift: float = -3.0  # and its bias

    def margins(self, words: list[str]) -> np.ndarray:
        """Each word's margin (real part) and what it adds to its sentence's (imaginary part, so that one small
        object is remembered for a word)."""
        parts = [self._margins(words[i : i + STEP]) for i in range(0, len(words), STEP)]
        return np.concatenate(parts) if parts else np.zeros(0, complex)

    def _margins(self, words: list[str]) -> np.ndarray:
        bins, weights, own = subsequences(words)
        if not len(bins):
            return np.full(len(words), NO_WORD, complex)
        size = lengths(weights, own, len(words))
        total = np.bincount(own, weights * self.weight[bins], minlength=len(words)) / size
        some = np.bincount(own, minlength=len(words)) > 0
        out = np.where(some, total + self.bias, NO_WORD).astype(complex)
        if self.sentence is not None:
            out.imag = np.bincount(own, weights * self.sentence[bins], minlength=len(words)) / size
        return out

    def score(self, evidence: np.ndarray) -> np.ndarray:
        z = evidence @ np.array(self.curve[:-1]) + self.curve[-1]
        return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


class Scorer:
    """Margins of whole texts, remembering the words seen (bounded)."""

    def __init__(self, machine: Machine):
        self.machine, self.seen = machine, Memo(KEPT)

    def of_words(self, words: list[str]) -> np.ndarray:
        fresh = self.seen.unseen(set(words))
        for a in range(0, len(fresh), STEP):
            part = fresh[a : a + STEP]
            self.seen.update(zip(part, self.machine.margins(part).tolist()))
        out = np.array([self.seen[w] for w in words])
        self.seen.forget_long(fresh)
        return out

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        """The evidence of each text: (largest margin, log of 1 + positive words, root of their sum, log of 1 + words,
        largest margin of a sentence)."""
        out = np.zeros((len(texts), 5))
        if not len(texts):
            return out
        code, words, first, spelled, ends = tokens(texts)
        both = np.r_[self.of_words(words), self.of_words([w for _, w, _ in spelled])]
        m = both.real
        start, of = sentence_starts(code, first, ends)
        total = sentence_sums(both.imag[: len(words)], both.imag[len(words) :], code, start, spelled)
        out[:, 4] = -3
        np.maximum.at(out[:, 4], of, np.minimum(total + self.machine.shift, 3))
        owner = np.repeat(np.arange(len(texts)), np.diff(first))
        code = np.r_[code, len(words) + np.arange(len(spelled))].astype(np.int64)
        owner = np.r_[owner, [i for i, _, _ in spelled]].astype(np.int64)
        most = np.full(len(texts), -np.inf)
        np.maximum.at(most, owner, m[code])
        out[:, 0] = np.clip(most, -3, 3)
        out[most <= NO_WORD, 4] = -3
        hit = np.flatnonzero(m[code] > 0)
        pair = np.unique(owner[hit] * len(m) + code[hit])
        out[:, 1] = np.log1p(np.bincount(pair // len(m), minlength=len(texts)))
        out[:, 2] = np.sqrt(np.bincount(pair // len(m), m[pair % len(m)], minlength=len(texts)))
        out[:, 3] = np.log1p(np.diff(first))
        return out


def kernel(a: list[str], landmarks: list[str]) -> np.ndarray:
    """Normalised subsequence kernel between words and landmarks."""
    lb, lw, lo = subsequences(landmarks)
    used, place = np.unique(lb, return_inverse=True)
    phi = np.zeros((len(used) + 1, len(landmarks)), np.float32)
    np.add.at(phi, (place, lo), lw)
    phi /= lengths(lw, lo, len(landmarks))
    out = np.zeros((len(a), len(landmarks)), np.float32)
    for i in range(0, len(a), 2000):
        part = a[i : i + 2000]
        b, w, o = subsequences(part)
        at = np.minimum(np.searchsorted(used, b), max(len(used) - 1, 0))
        hit = used[at] == b if len(used) else np.zeros(len(b), bool)
        np.add.at(out, i + o[hit], w[hit, None] * phi[at[hit]])
        out[i : i + len(part)] /= lengths(w, o, len(part))[:, None]
    return out


def witnesses(texts: list[list[int]], n: int, least: float = 1.0) -> np.ndarray:
    """Which of ``n`` candidate words explain the toxic texts: each text shares one vote among the
    candidates in it, and a word needs ``least`` votes.  Insults get many votes; the words of a text
    with many copies stand beside dozens of other such candidates and get next to none."""
    votes = np.zeros(n)
    for words in texts:
        if words:
            votes[words] += 1 / len(words)
    return np.where(votes >= least, votes, 0.0)


def spread_out(words: list[str], most: int, weight: np.ndarray | None = None) -> list[str]:
    """Landmarks: farthest-first words under the kernel, the weightiest word first."""
    if len(words) <= most:
        return list(words)
    picked = [int(np.argmax(weight)) if weight is not None else 0]
    near = kernel(words, [words[picked[0]]])[:, 0]
    while len(picked) < most:
        nxt = int(np.argmin(near))
        picked.append(nxt)
        near = np.maximum(near, kernel(words, [words[nxt]])[:, 0])
    return [words[i] for i in picked]


def linear_svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray, rounds: int = 40) -> tuple[np.ndarray, float]:
    """Squared-hinge SVM by Newton steps on the examples inside the margin (the bias is free)."""
    z = np.hstack([x, np.ones((len(x), 1))])
    reg = np.eye(z.shape[1])
    reg[-1, -1] = 1e-6
    w = np.zeros(z.shape[1])
    for _ in range(rounds):
        act = y * (z @ w) < 1
        za, ca = z[act], cost[act]
        new = np.linalg.solve(reg + (za * ca[:, None]).T @ za, (za * ca[:, None]).T @ y[act])
        if np.allclose(new, w, atol=1e-8):
            break
        w = new
    return w[:-1], float(w[-1])


def inserted(bad: list[str], good: list[str], rng, each: int = 4) -> list[str]:
    """Copies of the longer toxic words with one character put in, as examples; the characters are those of clean words."""
    chars = sorted({ch for w in good for ch in w})
    out = []
    for w in bad:
        for at in rng.permutation(np.arange(1, len(w)))[:each] if len(w) > 4 else ():
            out.append(w[:at] + chars[rng.integers(len(chars))] + w[at:])
    return out


def nystroem(marks: list[str]) -> np.ndarray:
    """Turns kernel values against the landmarks into features whose products are the kernel."""
    k = kernel(marks, marks).astype(float)
    value, vec = np.linalg.eigh((k + k.T) / 2)
    keep = value > 1e-6 * value[-1]
    return vec[:, keep] / np.sqrt(value[keep])


def folded(marks: list[str], w: np.ndarray) -> np.ndarray:
    """A linear machine's weights ``w`` on the landmarks as one weight for each subsequence bin."""
    lb, lw, lo = subsequences(marks)
    weight = np.zeros(BINS)
    np.add.at(weight, lb, lw * w[lo] / lengths(lw, lo, len(marks))[lo])
    return weight.astype(np.float32)


def train_words(bad: list[str], bad_weight: np.ndarray, good: list[str], landmarks: int = LANDMARKS, c: float = 200.0) -> Machine:
    """A machine from toxic example words and clean words (two rounds: the second adds the clean words
    that the first put on the wrong side or near it)."""
    rng = np.random.default_rng(3)
    marks = spread_out(bad, landmarks * 3 // 4, bad_weight)
    base = [good[i] for i in rng.permutation(len(good))[:4000]]
    marks += spread_out(base, landmarks - landmarks * 3 // 4)
    turn = nystroem(marks)
    bad = bad + inserted(bad, good, rng)
    kb, kg = kernel(bad, marks) @ turn, kernel(good, marks) @ turn
    hard = np.zeros(len(good), bool)
    hard[rng.permutation(len(good))[:4000]] = True
    for _ in range(3):
        g = kg[hard]
        x, y = np.vstack([kb, g]), np.r_[np.ones(len(kb)), -np.ones(len(g))]
        cost = np.r_[np.full(len(kb), c * len(x) / (2 * len(kb))), np.full(len(g), c * len(x) / (2 * len(g)))] / len(x) * 100
        w, b = linear_svm(x, y, cost)
        hard |= kg @ w + b > -1
    return Machine(folded(marks, turn @ w), b)


def picked_sentences(sample: DataFrame, value) -> list[tuple[int, list[str]]]:
    """(label, words) of the worst sentence of every text of ``sample`` (``text, label``), of clean texts also of the first.

    ``value``: what words add to a sentence, a dict or a machine.
    """
    shared = sample.sparkSession.sparkContext.broadcast(value)

    def run(batch):
        label = batch.column(1).to_numpy()
        code, words, first, spelled, ends = tokens(batch.column(0).to_pylist())
        if not len(code):
            return
        v, every = shared.value, [*words, *(w for _, w, _ in spelled)]
        add = v.margins(every).imag if isinstance(v, Machine) else np.array([v.get(w, 0.0) for w in every])
        start, of = sentence_starts(code, first, ends)
        stop = np.r_[start[1:], len(code)]
        total = sentence_sums(add[: len(words)], add[len(words) :], code, start, spelled)
        out = {}
        for _, w, at in spelled:
            out.setdefault(int(np.searchsorted(start, at, side="right")) - 1, []).append(w)
        order = np.lexsort((start, -total, of))
        worst = order[np.r_[True, of[order][1:] != of[order][:-1]]]
        opening = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
        at = np.r_[worst, opening[label[of[opening]] == 0]]
        every = [[*(words[c] for c in code[start[i] : stop[i]]), *out.get(i, ())] for i in at.tolist()]
        yield {"label": label[of[at]], "words": [[w for w in ws if 0 < len(w) <= LONGEST] for ws in every]}

    rows = map_batches(sample.select("text", "label"), run, "label int, words array<string>").collect()
    return sorted((r["label"], r["words"]) for r in rows if r["words"])


def train_sentences(sample: DataFrame, telling: dict[str, float], plain: list[str], landmarks: int = LANDMARKS) -> tuple[np.ndarray, float] | None:
    """(weights by bin, bias) of the sentence machine, or None without sentences of both classes.

    ``sample`` (``text, label``) is bounded; ``telling`` words start the search for toxic sentences and are landmarks
    beside words spread out over ``plain``.
    """
    marks = [*telling, *spread_out([w for w in plain if w not in telling], max(1, landmarks - len(telling)))]
    turn, seen, value = nystroem(marks), {}, telling
    out = None
    for _ in range(SENTENCE_ROUNDS):
        examples = picked_sentences(sample, value)
        y = np.array([1.0 if label else -1.0 for label, _ in examples])
        if len(set(y)) < 2:
            return None
        fresh = sorted({w for _, ws in examples for w in ws} - seen.keys())
        seen.update(zip(fresh, (kernel(fresh, marks) @ turn).astype(np.float32)))
        x = np.array([sum(seen[w] for w in ws) for _, ws in examples])
        w, b = linear_svm(x, y, SENTENCE_COST / np.where(y > 0, (y > 0).sum(), (y < 0).sum()))
        out = folded(marks, turn @ w), b
        value = Machine(np.zeros(BINS, np.float32), 0.0, sentence=out[0])
    return out


def logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, ...]:
    """Slopes and shift of the logistic curve (Newton; the classes' weights as they are, a light ridge)."""
    z, w = np.c_[x, np.ones(len(x))], np.zeros(x.shape[1] + 1)
    target = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / ((y == 0).sum() + 2))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -40, 40)))
        h = (z * (p * (1 - p))[:, None]).T @ z + 1e-3 * np.eye(len(w))
        step = np.linalg.solve(h, z.T @ (target - p) - 1e-3 * w)
        w += step * min(1.0, 5.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return tuple(w.tolist())


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        texts: int = TEXTS, words: int = WORDS) -> Machine:
    """Learn from a bounded sample of labelled texts (``texts`` of each class, ``words`` words of each class).

    Rows with a null label or without a text are left out; a text labelled both ways counts for both.
    Examples hold words of at most ``LONGEST`` characters.  Without examples of both classes the machine scores
    everything 0; without a word that stands out the sentence machine decides alone.
    """
    spark = docs.sparkSession
    lab = labels.where(F.col(label_col).isin(0, 1)).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).distinct()
    chosen = pack_scratch(sample_labelled(lab, "id", "label", texts), "toxicity-ids")  # at most 2 x texts ids
    sample = pack_scratch(
        docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        .join(F.broadcast(chosen), "id").dropDuplicates(["text", "label"]), "toxicity-sample")

    def split(batch):
        for t, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            w = words_of(t)
            yield {"word": w, "label": [y] * len(w)}

    by_word = pack_scratch(
        map_batches(sample.select("text", "label"), split, "word string, label int").where(F.length("word") <= LONGEST)
        .groupBy("word").agg(F.sum("label").alias("bad"), F.sum(1 - F.col("label")).alias("good")), "toxicity-words")
    n = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    none = Machine(np.zeros(BINS, np.float32), -1.0, "none", (0.0, 0.0, 0.0, 0.0, 0.0, -40.0))
    if not n.get(0) or not n.get(1):
        return none
    ratio = ((F.col("bad") + 0.5) / n[1]) / ((F.col("good") + 0.5) / n[0])
    bad = (by_word.where((F.col("bad") >= MIN_TEXTS) & (ratio >= MIN_RATIO) & (F.length("word") >= 3))
           .orderBy(F.desc("bad"), "word").limit(words // 5).collect())
    good = by_word.where((F.col("good") > 0) & (ratio <= 2)).orderBy(F.xxhash64("word"), "word").limit(words).collect()
    plain = [r["word"] for r in good]
    machine = Machine(np.zeros(BINS, np.float32), -1.0)
    if bad and good:
        place = {r["word"]: i for i, r in enumerate(bad)}

        def held(batch):
            yield {"w": [sorted(place[w] for w in words_of(t) if w in place) for t in batch.column(0).to_pylist()]}

        toxic = map_batches(sample.where("label = 1").select("text"), held, "w array<int>").orderBy("w").collect()
        picked = witnesses([r["w"] for r in toxic], len(bad), max(1.0, 0.0015 * n[1]))
        chosen_bad = [r["word"] for r, k in zip(bad, picked) if k]
        if chosen_bad:
            machine = train_words(chosen_bad, picked[picked > 0], plain)

    # the words whose shares of toxic and clean texts differ most for their counts, whatever the counts are
    share = (F.col("bad") + F.col("good")) / (n[0] + n[1])
    z = (F.col("bad") / n[1] - F.col("good") / n[0]) / F.sqrt(share * (1 - share) + 1e-9)
    telling = by_word.where(F.length("word") > 0).select("word", z.alias("z")).orderBy(F.desc("z"), "word").limit(LANDMARKS * 5 // 8).collect()
    half = F.pmod(F.xxhash64("text"), F.lit(2)) == 0
    if sample.where(half).select("label").distinct().count() == 2 and sample.where(~half).select("label").distinct().count() == 2:
        learn, weigh = sample.where(half), sample.where(~half)
    else:
        learn = weigh = sample
    if plain and telling and (found := train_sentences(learn, {r["word"]: r["z"] for r in telling if r["z"] > 0}, plain[:4000])):
        machine.sentence, machine.shift = found
    machine.tag = hashlib.md5(machine.weight.tobytes() + (b"" if machine.sentence is None else machine.sentence.tobytes())).hexdigest()
    m = evidence(weigh.select("text", "label"), machine).collect()
    machine.curve = logistic(np.array([r["evidence"] for r in m]), np.array([r["label"] for r in m]))
    return machine


def _scorer(shared) -> Scorer:
    """One scorer for each machine and Python worker, so that its words are kept between tasks."""
    machine = shared.value
    return worker_state(("toxicity", machine.tag), lambda: Scorer(machine))


def evidence(df: DataFrame, machine: Machine) -> DataFrame:
    """The evidence of the texts of a labelled sample (``text, label``)."""
    shared = df.sparkSession.sparkContext.broadcast(machine)

    def run(batch):
        yield {"label": batch.column(1), "evidence": _scorer(shared)(batch.column(0).to_pylist()).tolist()}

    return map_batches(df.select("text", "label"), run, "label int, evidence array<double>")


def predict(df: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, score`` (0 to 1, higher: toxic likelier) and ``predicted`` (1 if score >= 0.5) of every
    whole text, one output row for each input row, no shuffle.

    A null or empty text has no word and gets the lowest score.  Null ids and repeated rows pass
    through; further columns are not read; an empty table gives an empty result.
    """
    shared = df.sparkSession.sparkContext.broadcast(machine)

    def run(batch):
        score = shared.value.score(_scorer(shared)(batch.column(1).to_pylist()))
        yield {id_col: batch.column(0), "score": score, "predicted": (score >= 0.5).astype(np.int32)}

    kind = df.schema[id_col].dataType.simpleString()
    return map_batches(df.select(id_col, text_col), run, f"`{id_col}` {kind}, score double, predicted int")


def keep_clean(df: DataFrame, machine: Machine, text_col: str = "text", most: float = 0.5) -> DataFrame:
    """The rows (all columns) whose text scores under ``most``.  Null and empty texts score as texts without a word (and
    stay); ids are not looked at, repeated rows are judged alike, columns may have any names, and an empty table stays empty."""
    shared = df.sparkSession.sparkContext.broadcast(machine)
    at = df.columns.index(text_col)
    bounded_batches(df.sparkSession)

    def run(batches):
        score = _scorer(shared)
        for b in batches:
            yield b.filter(pa.array(shared.value.score(score(b.column(at).to_pylist())) < most))

    return df.mapInArrow(run, df.schema)
