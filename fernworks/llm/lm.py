"""Language-model scoring: a log-bilinear model of words, trained by noise-contrastive estimation in numpy.

Words are split at ASCII white space, A-Z lower-cased. The VOCABULARY most frequent words that training has seen twice
or more are symbols of their own, whatever the size of the corpus, which bounds the model that is sent to all tasks. In
the order of their spelling from the end they are cut into classes of one size (about as many as the square root of the
symbols); each class has one symbol more for the rarer words of one hash of the last two bytes, and two classes hold one
symbol each, the end of a text and the words seen once or never. Symbols are numbered class by class.

P(word | words before) = P(class | h) * P(symbol | class, h) * P(word | symbol). h, the prediction, is the sum of the
vectors of the CONTEXT symbols before, each weighted by its position. Its products with the vectors of all classes, and
with those of all symbols of the class, in batches of tokens, give the first two factors, normalised. The last one is 1
for frequent words, the share by count for a rarer word among its class's rarer ones, and for the last class what
Good-Turing leaves to words seen once, all unseen words together being one outcome, as in the base score.

Training is by sampled noise: for each batch NOISE classes, drawn evenly along the cumulated frequencies, and for each
class of the batch IN_NOISE of its symbols. It is one pass over all positions of all training texts, at every size, in
ROUNDS parts: each task learns from its own texts, in batches that grow as it goes on, and after a part every vector is
averaged over the tasks that touched it. A batch is a run of tokens, so that a vector is looked up once for all the
positions that see it. Counts, classes and shares come from all training texts, words meet their counts through the
distinct-word table, and texts are split once and go on as numbers of their pack's words.

Defined cases. Null text: as empty; empty text: the end alone is its token. Null id: remainder of the empty text.
Repeated rows and ids: each row is scored, and learnt from, by itself. No training text: no word is known. Empty
table: no rows. Ties among frequent words: by the words' bytes. Texts of any length are whole. Other columns are left
out. A row's score depends on how the training texts were cut into tasks, not on other runs.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words as W
from .common import give_back, passing, prepare, remainder, text_of, written

D, CONTEXT, NOISE, IN_NOISE = 16, 5, 64, 4
ROUNDS, RATE, VOCABULARY = 2, 0.08, 1 << 15
#: Tokens of a task's first batches, and of its largest ones; a batch is a quarter of the tokens before it.
FIRST, LAST = 128, 1 << 12
#: Tokens held at once in learning and in scoring, tokens whose scores of all classes are, and rows of a matrix that
#: are averaged together.
HELD, BLOCK, ROWS = 1 << 17, 1 << 10, 1024
#: Rows of D numbers that are multiplied by one line of weights.
LANE = 64
END, RARE, TAILS = 0, 1, 2
#: What a pack learns of each of its words.
MET = np.dtype([("count", np.int64), ("symbol", np.uint16)])


@dataclass
class Words:
    """The symbols in the order of their classes: END, RARE, then of each class the one for its rarer words and the
    frequent words."""

    classes: int
    frequent: list[bytes]  # words in the order of their spelling from the end
    frequent_counts: list[int]
    mass: np.ndarray  # tokens of the rarer words of each class
    tokens: int
    types: int
    once: int
    twice: int
    end: int
    number: dict[bytes, int] = field(init=False)  # symbols of frequent words
    tail: np.ndarray = field(init=False)  # symbols for the rarer words of each class
    counts: np.ndarray = field(init=False)  # of symbols, in training
    klass: np.ndarray = field(init=False)
    start: np.ndarray = field(init=False)  # first symbol of each class
    shares: np.ndarray = field(init=False)  # counts, but those of nothing a little, and of rarer words that there are none of hardly anything

    def __post_init__(self):
        n = len(self.frequent)
        own = np.arange(n) * self.classes // max(1, n)
        symbol = TAILS + own + 1 + np.arange(n)
        self.number = dict(zip(self.frequent, symbol.tolist(), strict=True))
        self.tail = TAILS + np.arange(self.classes) + np.searchsorted(own, np.arange(self.classes))
        self.klass = np.zeros(TAILS + self.classes + n, np.int32)
        self.klass[RARE] = 1
        self.klass[self.tail], self.klass[symbol] = TAILS + np.arange(self.classes), TAILS + own
        self.counts = np.zeros(len(self.klass))
        self.counts[[END, RARE]] = self.end, self.once
        self.counts[self.tail], self.counts[symbol] = self.mass, self.frequent_counts
        self.shares = np.maximum(self.counts, 0.5)
        self.shares[self.tail[self.mass == 0]] = 1e-6
        if len(self.klass) > 1 << 16:
            raise ValueError("symbols are numbered in two bytes: a smaller vocabulary is needed")
        self.start = np.searchsorted(self.klass, np.arange(TAILS + self.classes + 1))


def suffix_class(w: bytes, classes: int) -> int:
    """The class of a rarer word."""
    return zlib.crc32(w[-2:]) % classes


def _by_symbol(symbols: np.ndarray) -> np.ndarray:
    """The order of symbols; two bytes hold them (see Words), which makes it fast."""
    return np.argsort(symbols.astype(np.uint16), kind="stable")


def _spaced(symbols: np.ndarray, since: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(symbols with CONTEXT times END before each text, where each of the symbols stands there). since: tokens of a token's
    text before it. What is before a text's first tokens is thus END, and no text reaches another."""
    first = since == 0
    place = np.arange(len(symbols)) + CONTEXT * np.cumsum(first)
    out = np.full(len(symbols) + CONTEXT * int(first.sum()), END, symbols.dtype)
    out[place] = symbols
    return out, place


class _Shifted:
    """Rows of D, laid one after another, and as they stand up to CONTEXT rows earlier (before) or later: as matrices of
    LANE rows to a line, so that a weight for each component is a line too and products run along it. Outside is zero."""

    def __init__(self, n: int, kind, before: bool):
        self.lines = -(-n // LANE)
        self.rows = np.zeros((self.lines * LANE + CONTEXT, D), kind)
        self.first = CONTEXT if before else 0  # of the rows themselves
        self.own = self.rows[self.first : self.first + n]

    def by(self, distance: int) -> np.ndarray:
        first = self.first - distance if self.first else distance
        return self.rows[first : first + self.lines * LANE].reshape(self.lines, LANE * D)


class Model:
    """context and weight make the prediction; klass and symbol have a bias as their last column."""

    NAMES = ("context", "weight", "klass", "symbol")

    def __init__(self, words: Words, seed: int = 7):
        counts = words.shares
        of_class = np.bincount(words.klass, counts)
        self.context = np.random.default_rng(seed).normal(0, 0.1, (len(counts), D)).astype(np.float32)
        self.weight = np.ones((CONTEXT, D), np.float32)
        self.klass = np.zeros((len(of_class), D + 1), np.float32)
        self.symbol = np.zeros((len(counts), D + 1), np.float32)
        self.klass[:, D] = np.log(of_class / of_class.sum())
        self.symbol[:, D] = np.log(counts / of_class[words.klass])

    def predicted(self, spaced: np.ndarray) -> tuple[np.ndarray, _Shifted, np.ndarray]:
        """(h, the vectors of symbols, the weights as lines); spaced: see _spaced."""
        vectors = _Shifted(len(spaced), self.context.dtype, True)
        vectors.own[:] = np.take(self.context, spaced, axis=0)
        weights = np.tile(self.weight, LANE)
        h = vectors.by(1) * weights[0]
        one = np.empty_like(h)
        for k in range(1, CONTEXT):
            h += np.multiply(vectors.by(k + 1), weights[k], out=one)
        return h.reshape(-1, D)[: len(spaced)], vectors, weights

    def log_probabilities(self, words: Words, symbols: np.ndarray, since: np.ndarray) -> np.ndarray:
        """log10 P(symbol | symbols before) of whole texts' tokens, normalised over all symbols. since: tokens of a token's
        text before it."""
        spaced, place = _spaced(symbols, since)
        kind, c = self.context.dtype, words.klass[symbols]
        every = np.empty((len(spaced), D), kind)
        for k in range(0, len(spaced), LAST):
            lead = min(k, CONTEXT)
            every[k : k + LAST] = self.predicted(spaced[k - lead : k + LAST])[0][lead:]
        scores = np.empty(BLOCK * int(max(len(self.klass), np.diff(words.start).max())), kind)

        def picked(h, vectors, share, which):
            """Of a block; the biases' exponentials are given as share."""
            size, n = h.shape[0], len(vectors)
            s = scores[: size * n].reshape(size, n)
            np.matmul(h, vectors[:, :D].T, out=s)
            own = s.ravel().take(np.arange(0, size * n, n) + which) + vectors[which, D]
            with np.errstate(over="ignore"):
                total = np.exp(s, out=s) @ share
            if not 1e-25 < total.min() <= total.max() < 1e35:  # near the ends of single precision
                np.matmul(h, vectors[:, :D].T, out=s)
                s += vectors[:, D]
                top = s.max(1)
                s -= top[:, None]
                return own - top - np.log(np.exp(s, out=s).sum(1))
            return own - np.log(total)

        out, share = np.empty(len(symbols)), np.exp(self.klass[:, D])
        for k in range(0, len(out), BLOCK):
            out[k : k + BLOCK] = picked(np.take(every, place[k : k + BLOCK], axis=0), self.klass, share, c[k : k + BLOCK])
        order, share = _by_symbol(symbols), np.exp(self.symbol[:, D])
        cuts = np.append(np.flatnonzero(np.diff(c[order], prepend=-1)), len(order))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            klass = int(c[order[a]])
            first, stop = words.start[klass], words.start[klass + 1]
            if stop - first > 1:
                for k in range(a, b, BLOCK):
                    rows = order[k : min(b, k + BLOCK)]
                    out[rows] += picked(np.take(every, place[rows], axis=0), self.symbol[first:stop], share[first:stop], symbols[rows] - first)
        return out / np.log(10)


class Learner:
    """Noise-contrastive estimation with AdaGrad steps, from one task's tokens."""

    def __init__(self, model: Model, words: Words, rate: float, rng: np.random.Generator):
        self.model, self.words, self.rng, self.rate = model, words, rng, np.float32(rate)
        self.squares = {n: np.full(getattr(model, n).shape, 0.01, np.float32) for n in Model.NAMES}
        self.touched = {n: np.zeros(len(getattr(model, n)), bool) for n in Model.NAMES}
        counts = words.shares
        of_class = np.bincount(words.klass, counts)
        self.class_ends = np.cumsum(of_class)
        self.log_class = (np.log(of_class / of_class.sum()) + np.log(NOISE)).astype(np.float32)
        self.log_symbol = (np.log(counts / of_class[words.klass]) + np.log(IN_NOISE)).astype(np.float32)
        self.ends = np.concatenate([[0], np.cumsum(counts)])
        self.several = np.diff(words.start) > 1
        self.slot = np.zeros(len(words.klass), np.int32)  # where a symbol's gradient stands among a batch's

    def _step(self, name: str, index: np.ndarray, grad: np.ndarray) -> None:
        squares = np.take(self.squares[name], index, axis=0)
        squares += grad * grad
        self.squares[name][index] = squares
        np.sqrt(squares, out=squares)
        np.divide(grad, squares, out=squares)
        squares *= self.rate
        values = getattr(self.model, name)
        squares += np.take(values, index, axis=0)
        values[index] = squares
        self.touched[name][index] = True

    def noise(self, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Classes for a whole batch, and symbols of each of these classes; evenly along the cumulated counts."""
        drawn = np.searchsorted(self.class_ends, (self.rng.random() + np.arange(NOISE)) * (self.class_ends[-1] / NOISE), side="right")
        first, stop = self.words.start[classes][:, None], self.words.start[classes + 1][:, None]
        low, high = self.ends[first], self.ends[stop]
        inside = np.searchsorted(self.ends, low + (high - low) * ((self.rng.random((len(classes), 1)) + np.arange(IN_NOISE)) / IN_NOISE), side="right") - 1
        return np.minimum(drawn, len(self.class_ends) - 1), np.clip(inside, first, stop - 1)

    def gradients(self, symbols: np.ndarray, since: np.ndarray, lead: int, noise=None) -> dict[str, tuple[np.ndarray, np.ndarray]]:
        """For each matrix the rows that a run of tokens touches, and the gradient of its log-likelihood against noise
        there. The first `lead` tokens are context alone. noise: as `noise` gives it, else drawn."""
        m, w = self.model, self.words
        kind = m.context.dtype
        spaced, place = _spaced(symbols, since)
        every, vectors, weights = m.predicted(spaced)
        order = lead + _by_symbol(symbols[lead:])
        s, at = symbols[order], place[order]
        h, c = np.ones((len(s), D + 1), kind), w.klass[s]
        h[:, :D] = np.take(every, at, axis=0)
        s_first, c_first = np.flatnonzero(np.diff(s, prepend=-1)), np.flatnonzero(np.diff(c, prepend=-1))
        of_s, of_c = s[s_first], c[c_first]
        drawn, inside = self.noise(of_c) if noise is None else noise

        # the class: each token's own against those drawn for all
        own, other = np.take(m.klass, c, axis=0), m.klass[drawn]
        right = (1 / (1 + np.exp(np.einsum("ij,ij->i", h, own) - self.log_class[c]))).astype(kind)
        less = -other
        less[:, D] += self.log_class[drawn]  # the noise's logarithm less the score
        back, total = np.empty_like(h), np.zeros_like(other)
        for k in range(0, len(s), BLOCK):  # what is at work stays in the processor's cache
            x = h[k : k + BLOCK]
            y = x @ less.T
            np.exp(y, out=y)
            y += 1
            np.divide(-1, y, out=y)
            np.matmul(y, other, out=back[k : k + BLOCK])
            total += y.T @ x
        own *= right[:, None]
        back += own
        klass = np.zeros(m.klass.shape, kind)
        first = np.flatnonzero(np.diff(drawn, prepend=-1))  # they are drawn in order
        klass[drawn[first]] += np.add.reduceat(total, first, axis=0)
        # the symbol: each token's own against those drawn for its class
        many, own, of_class = self.several[c], np.take(m.symbol, s, axis=0), right
        right = (many / (1 + np.exp(np.einsum("ij,ij->i", h, own) - self.log_symbol[s]))).astype(kind)
        own *= right[:, None]
        back += own
        both = np.zeros(len(m.symbol), bool)
        both[of_s] = both[inside] = True
        touched = np.flatnonzero(both)
        self.slot[touched] = np.arange(len(touched))
        symbol = np.zeros((len(touched), D + 1), kind)
        symbol[self.slot[of_s]] = np.add.reduceat(h * right[:, None], s_first, axis=0)
        cuts, other = np.append(c_first, len(s)).tolist(), m.symbol[inside]
        runs = [slice(a, b) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        own, y = [h[run] for run in runs], np.empty((len(s), IN_NOISE), kind)
        for run, x, o in zip(runs, own, other.transpose(0, 2, 1), strict=True):
            np.dot(x, o, out=y[run])
        each = np.empty((len(s), IN_NOISE + 1), kind)  # of the class itself, then of the symbols drawn in it
        each[:, 0] = of_class
        np.subtract(np.repeat(self.log_symbol[inside], np.diff(cuts), axis=0), y, out=y)
        np.exp(y, out=y)
        y += 1
        np.divide(-many[:, None].astype(kind), y, out=each[:, 1:])
        sums = np.empty((len(runs), IN_NOISE + 1, D + 1), kind)
        noisy, part = each[:, 1:], np.empty_like(back)
        for run, x, o, total in zip(runs, own, other, sums, strict=True):
            np.dot(noisy[run], o, out=part[run])
            np.dot(each[run].T, x, out=total)
        back += part
        klass[of_c] += sums[:, 0]
        for j in range(IN_NOISE):  # of different classes, so no symbol comes up twice
            symbol[self.slot[inside[:, j]]] += sums[:, j + 1]
        # the context: what comes back to a token from the positions after it
        to, weight = _Shifted(len(spaced), kind, False), np.empty((CONTEXT, D), kind)
        to.own[at] = back[:, :D]
        context, lines = np.zeros((to.lines, LANE * D), kind), np.ones(to.lines, kind)
        one = np.empty_like(context)
        for k in range(CONTEXT):
            context += np.multiply(to.by(k + 1), weights[k], out=one)
            weight[k] = (lines @ np.multiply(to.by(0), vectors.by(k + 1), out=one)).reshape(LANE, D).sum(0)
        order = _by_symbol(spaced)
        first = np.flatnonzero(np.diff(spaced[order], prepend=-1))
        seen, sums = spaced[order[first]], np.add.reduceat(np.take(context.reshape(-1, D), order, axis=0), first, axis=0)
        of_c = np.union1d(of_c, drawn)
        return {"klass": (of_c, klass[of_c]), "symbol": (touched, symbol), "context": (seen, sums), "weight": (np.arange(CONTEXT), weight)}

    def batch(self, symbols: np.ndarray, since: np.ndarray, lead: int) -> None:
        for name, (index, grad) in self.gradients(symbols, since, lead).items():
            self._step(name, index, grad)


def batches_of(n: int, before: int):
    """(from, to, lead) of the batches of a run of n tokens, `before` tokens having come before: their sizes depend on
    nothing else. lead: the tokens before `from` that are its context."""
    at = 0
    while at < n:
        to = min(n, at + min(LAST, max(FIRST, (before + at) // 4)))
        yield at, to, min(at, CONTEXT)
        at = to


def _held(texts: list[bytes]):
    """(symbols, tokens before each in its text) of whole texts, of a bounded size but for one longer text."""
    held, size = [], 0
    for k, t in enumerate(texts):
        held.append(np.frombuffer(t, np.uint16).astype(np.int32))
        size += len(held[-1])
        if size >= HELD or k + 1 == len(texts):
            n = np.array([len(x) for x in held])
            yield np.concatenate(held), np.arange(size) - np.repeat(np.cumsum(n) - n, n), n
            held, size = [], 0


def _words(totals: DataFrame, end: int, vocabulary: int = VOCABULARY) -> Words:
    """The symbols, and sums over all training words, from the distinct-word table."""

    def each(batches):
        for batch in batches:
            for ws, cs in zip(batch.column("words").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                yield ws, np.frombuffer(cs, np.int64)

    def sums(batches):
        total, sizes = np.zeros(4, np.int64), np.zeros(64, np.int64)
        for _, c in each(batches):
            total += [c.sum(), len(c), (c == 1).sum(), (c == 2).sum()]
            sizes += np.bincount(np.frexp(c.astype(float))[1], minlength=64)
        total = np.concatenate([total, sizes])
        yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total)], names=["i", "n"])

    total = np.zeros(4 + 64, np.int64)
    for r in totals.mapInArrow(sums, "i int, n long").groupBy("i").agg(F.sum("n").alias("n")).collect():
        total[r["i"]] = r["n"]
    tokens, types, once, twice = total[:4].tolist()
    at_least = np.cumsum(total[4:][::-1])[::-1]  # words with a count of 2 ** (k - 1) or more
    least = max([2, *(1 << (k - 1) for k in range(2, 64) if at_least[k] >= vocabulary)])

    def frequent(batches):
        for ws, c in each(batches):
            at = np.flatnonzero(c >= least)
            if len(at):
                ws = ws.split(b"\n")
                yield pa.RecordBatch.from_arrays([pa.array([ws[i] for i in at], pa.binary()), pa.array(c[at])], names=["word", "n"])

    found = totals.mapInArrow(frequent, "word binary, n long").orderBy(F.desc("n"), "word").limit(vocabulary).toArrow()
    found = list(zip(found.column("word").to_pylist(), found.column("n").to_pylist(), strict=True))
    last_word, last_n = found[-1] if found else (b"", 1)
    classes = 16 + round(len(found) ** 0.5)

    def tails(batches):
        mass = np.zeros(classes, np.int64)
        for ws, c in each(batches):
            ws = ws.split(b"\n")
            at = [i for i in np.flatnonzero((c > 1) & (c <= last_n)).tolist() if c[i] < last_n or ws[i] > last_word]
            mass += np.bincount(np.fromiter((suffix_class(ws[i], classes) for i in at), np.int64, len(at)), c[at], classes).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(range(classes), pa.int32()), pa.array(mass)], names=["class", "n"])

    mass = np.zeros(classes, np.int64)
    for r in totals.mapInArrow(tails, "class int, n long").groupBy("class").agg(F.sum("n").alias("n")).collect():
        mass[r["class"]] = r["n"]
    found.sort(key=lambda x: x[0][::-1])
    return Words(classes, [w for w, _ in found], [n for _, n in found], mass, tokens + end, types + (end > 0), once, twice, end)


def _tagged(packed: DataFrame, vocabulary: DataFrame, totals: DataFrame, words: Words, id_type) -> DataFrame:
    """Each document with its counts, base score, the last factor of its score, and its symbols."""
    shared = packed.sparkSession.sparkContext.broadcast(words)

    def begin():
        """A bucket's words, each looked at once, get their symbols; a pack's get counts and symbols."""
        words, at = shared.value, {}
        known = [np.array([(0, RARE)], MET)]  # first: of words that training has not seen

        def answer(ws, c, total):
            if total:
                symbol = np.fromiter((words.number.get(w, -1) for w in ws), np.int32, len(ws))
                tail = np.flatnonzero((symbol < 0) & (c > 1))
                symbol[tail] = words.tail[np.fromiter((suffix_class(ws[i], words.classes) for i in tail.tolist()), np.int64, len(tail))]
                symbol[c <= 1] = RARE
                at.update(zip(ws, range(len(at) + 1, len(at) + 1 + len(ws)), strict=True))
                known.append(np.empty(len(ws), MET))
                known[-1]["count"], known[-1]["symbol"] = c, symbol
                return b""
            if len(known) > 1:
                known[:] = [np.concatenate(known)]
            return known[0][np.fromiter((at.get(w, 0) for w in ws), np.int64, len(ws))].tobytes()

        return answer

    def finish(table, met):
        words = shared.value
        c, symbol = np.append(met["count"], words.end), np.append(met["symbol"], np.uint16(END))  # and the end of a text
        new = (words.once + 1) / (words.once + 2 * words.twice + 2) if words.once else 1.0
        mass = np.zeros(len(words.klass))
        mass[words.tail] = words.mass
        share, tail = np.zeros(len(c)), np.flatnonzero(mass[symbol] > 0)
        share[tail] = np.log10(c[tail] / mass[symbol[tail]])
        rare = symbol == RARE
        if words.once:
            share[rare & (c == 1)] = np.log10((1 - new) / words.once)
        share[rare & (c == 0)] = np.log10(new)
        base = np.log10((c + 1) / (words.tokens + words.types + 1))
        # every text's words, and its end, which has the number after theirs
        numbers = table.column("numbers").combine_chunks()
        n = pc.list_value_length(numbers).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        stop = np.cumsum(n)
        here = np.full(n.sum(), len(c) - 1, np.int32)
        word = np.ones(len(here), bool)
        word[stop - 1] = False
        here[word] = numbers.flatten().to_numpy(zero_copy_only=False)
        start = stop - n
        total = lambda each: np.add.reduceat(each[here], start)
        small = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(np.append(0, 2 * stop).astype(np.int32)), pa.py_buffer(symbol[here])])
        cols = (pa.array(n), pa.array(total((c > 0).astype(np.int64))), pa.array(total(base)), pa.array(total(share)), small)
        return pa.table([table.column("k0"), table.column("k1"), *cols], names=["k0", "k1", "n_tokens", "n_known", "base_score", "share", "symbols"])

    schema = T.StructType([T.StructField("k0", id_type), *T._parse_datatype_string("k1 boolean, n_tokens long, n_known long, base_score double, share double, symbols binary").fields])
    replies = W.answers(vocabulary.unionByName(totals), begin)
    return written(W.met(packed, replies, MET, finish, schema), "tagged")


def train(tagged: DataFrame, words: Words, rounds: int = ROUNDS) -> Model:
    """The model, learnt in one pass from all positions of the rows of tagged that are not held out. Each of the rounds
    takes every so-many-th batch."""
    spark = tagged.sparkSession
    model = Model(words)
    rows = tagged.filter("not k1").select("symbols")
    for r in range(rounds if words.tokens else 0):
        shared = spark.sparkContext.broadcast((model, words))

        def run(batches, r=r, shared=shared):
            import copy

            from pyspark import TaskContext

            learner, before, number = None, 0, 0
            for batch in batches:
                for symbols, since, _ in _held(batch.column("symbols").to_pylist()):
                    if learner is None:
                        learner = Learner(copy.deepcopy(shared.value[0]), shared.value[1], RATE / (r + 1), np.random.default_rng([r, TaskContext.get().partitionId()]))
                    for at, to, lead in batches_of(len(symbols), before):
                        if number % rounds == r:
                            learner.batch(symbols[at - lead : to], since[at - lead : to], lead)
                        number += 1
                    before += len(symbols)
            for name in Model.NAMES if learner else ():
                values, touched = getattr(learner.model, name), learner.touched[name]
                for k in range(0, len(values), ROWS):
                    t = touched[k : k + ROWS]
                    yield pa.RecordBatch.from_arrays([pa.array([f"{name} {k}"]), pa.array([t.astype(np.int32).tobytes()], pa.binary()), pa.array([(values[k : k + ROWS] * t[:, None]).astype(np.float64).tobytes()], pa.binary())], names=["part", "n", "total"])
            give_back()

        def added(batches):
            part, n, total = None, None, None
            out = lambda: pa.RecordBatch.from_arrays([pa.array([part]), pa.array([n.tobytes()], pa.binary()), pa.array([total.tobytes()], pa.binary())], names=["part", "n", "total"])
            for batch in batches:
                for p, c, t in zip(*(batch.column(x).to_pylist() for x in ("part", "n", "total")), strict=True):
                    c, t = np.frombuffer(c, np.int32), np.frombuffer(t, np.float64)
                    if p != part:
                        if part is not None:
                            yield out()
                        part, n, total = p, c.copy(), t.copy()
                    else:
                        n += c
                        total += t
            if part is not None:
                yield out()

        kind = "part string, n binary, total binary"
        for row in W.in_turn(rows.mapInArrow(run, kind), "part").mapInArrow(added, kind).collect():  # the model once
            name, k = row["part"].split()
            n, part = np.frombuffer(row["n"], np.int32), slice(int(k), int(k) + ROWS)
            total = np.frombuffer(row["total"], np.float64).reshape(len(n), -1)
            values = getattr(model, name)
            values[part] = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], values[part])
        shared.unpersist()
    return model


def fitted(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", folds: int = 7, held_out: int = 2, pack_bytes: int = W.PACK_BYTES, rounds: int = ROUNDS, most: int = VOCABULARY) -> tuple[DataFrame, Words, Model]:
    """The tagged documents, the symbols and the model."""
    prepare(docs.sparkSession)
    flagged = docs.select(F.col(id_col).alias("id"), text_of(docs, text_col).alias("text"), (remainder(F.col(id_col), folds) == held_out).alias("out"))
    with passing(docs.sparkSession) as keep:
        size, end = flagged.agg(F.sum(F.octet_length("text").cast("long")), F.count_if(~F.col("out"))).first()
        n = W.bucket_count(size or 0)
        source = W.pack_source(flagged, ["id", "out"], "text")
        both = written(W.numbered(source, n, lower=True, pack_bytes=pack_bytes, counted=lambda t: [not x for x in t.column("k1").to_pylist()]), "packs")
        packed, vocabulary = both.filter("bucket < 0").select("pack", "body"), both.filter("bucket >= 0").drop("body")
        totals = written(W.totals(vocabulary), "totals")
        words = _words(totals, end, most)
        tagged = keep(_tagged(packed, vocabulary, totals, words, docs.schema[id_col].dataType))
    return tagged, words, train(tagged, words, rounds)


def score(docs: DataFrame, *, id_col: str = "doc_id", **how) -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10) for each document.

    Texts whose crc32(id as text) modulo folds is held_out are not learnt from. how: see fitted.
    """
    tagged, words, model = fitted(docs, id_col=id_col, **how)
    shared = docs.sparkSession.sparkContext.broadcast((model, words))

    def run(batches):
        model, words = shared.value
        for batch in batches:
            total = []
            for symbols, since, n in _held(batch.column("symbols").to_pylist()):
                p = np.empty(len(symbols))
                for k in range(0, len(symbols), HELD):  # one long text is scored in parts, with the tokens before each
                    lead = min(k, CONTEXT)
                    part = slice(k - lead, k + HELD)
                    p[k : k + HELD] = model.log_probabilities(words, symbols[part], since[part])[lead:]
                total += np.add.reduceat(p, np.cumsum(n) - n).tolist()  # every text has its end
            out = np.array(total) + batch.column("share").to_numpy()
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in ("k0", "k1", "n_tokens", "n_known", "base_score")), pa.array(out, pa.float64())], names=["k0", "k1", "n_tokens", "n_known", "base_score", "score"])
        give_back()

    kind = T.StructType([*tagged.schema.fields[:5], T.StructField("score", T.DoubleType())])
    out = tagged.mapInArrow(run, kind)
    return out.select(F.col("k0").alias(id_col), F.col("k1").alias("held_out"), "n_tokens", "n_known", F.lit(words.tokens).cast("long").alias("train_tokens"), "base_score", "score")


def op4_lm_scoring(spark, sf_dir: str) -> DataFrame:
    """The model's and the base score of every document."""
    return score(spark.read.parquet(f"{sf_dir}/documents.parquet"))
