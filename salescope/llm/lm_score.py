"""Language-model scores: a gated recurrent network over word classes.

Training documents (all rows whose id hashes so) give the counts of every
word, by one aggregate over the corpus. The most frequent words, a number that
does not grow, are put into classes of as many words each; the frequent words
after them into a few bands of like frequency, and all others share one more
band. The network reads the last word and keeps a state; one softmax gives the
class or band of the next word, a second one, over the words of a class, gives
the word, so that P(word) = P(class | state) * P(word | class, state). Both are
learnt in the same backpropagation. Only within the bands, the tail, a word's
share comes from the counts.

Every task trains on all training documents it reads, by truncated
backpropagation with the state carried from window to window, starting from
the same weights; the weights are then averaged over tasks by their tokens. So
the weights, and by some per cent the scores, depend on how the table is split.
Scoring carries the state through each whole document. Words outside the
frequent ones find their counts by a join; none of them can be a hot key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, signed, slices, staged, text_column

#: frequent words whose counts every task holds
FREQUENT = 60_000
#: learnt classes, the words of each, and the bands of the frequent words after them; one more holds all others
CLASSES, WIDTH, BANDS = 32, 64, 8
#: words that the network tells apart, and the classes and bands of the first softmax
INPUTS, KINDS = CLASSES * WIDTH, CLASSES + BANDS + 1
#: units of the state, lanes and steps of a training window, learning rate
UNITS, LANES, STEPS, RATE = 8, 1024, 16, 0.1
#: the key of the end token, which no word's hash stands for
END = np.uint64(1)
#: a document is held out where the crc32 of its id modulo this is the second number
FOLDS, HELD_OUT = 7, 2


def tokens_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(keys, row offsets): the words of each text, then the end token."""
    w = Words(texts, lower=True)
    return np.insert(w.hash, w.first[1:], END), w.first + np.arange(len(w.first))


def held_out(doc_id: F.Column) -> F.Column:
    """Whether a document is kept from learning; a null id is not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over the training rows of ``docs`` (doc_id, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.sort(np.concatenate([tokens_of(p.column("text"))[0] for p in slices(batch)] or [np.zeros(0, np.uint64)]))
            if len(keys):
                edge = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(keys[edge])), pa.array(np.diff(np.append(edge, len(keys))), pa.int64())], ["word", "n"])

    train = docs.filter(~held_out(F.col("doc_id"))).select("text")
    return train.mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Vocabulary:
    """The frequent words with their counts, classes and input numbers."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, total: int, distinct: int):
        order = np.argsort(words)
        rank = np.arange(len(words))[order]
        self.word, self.count = words[order], counts[order]
        self.total, self.distinct = total, distinct
        tail = counts[INPUTS:]
        mass = np.cumsum(np.sqrt(tail))
        band = np.minimum((mass - np.sqrt(tail)) / max(mass[-1], 1) * BANDS, BANDS - 1).astype(np.int64) if len(tail) else np.zeros(0, np.int64)
        of_rank = np.concatenate([np.arange(min(len(words), INPUTS)) // WIDTH, CLASSES + band])
        size = np.bincount(of_rank, weights=counts, minlength=KINDS)
        # share of its band by the counts; of a learnt class, the network gives it
        inside = np.concatenate([np.zeros(min(len(words), INPUTS)), np.log10(tail / size[CLASSES + band])])
        self.inside = inside[rank]
        self.input = np.where(rank < INPUTS, rank, INPUTS - CLASSES + of_rank[rank]).astype(np.uint16)
        # class or band of each input number; the last input is any other word
        self.class_of = np.concatenate([np.arange(INPUTS) // WIDTH, np.arange(CLASSES, KINDS)])
        self.other = INPUTS + BANDS
        known = int(self.count.sum())
        self.rare_tokens, self.rare_words = total - known, distinct - len(words)
        size[-1] = self.rare_tokens
        self.log_prior = np.log((size + 1.0) / (size + 1.0).sum()).astype(np.float32)
        each = np.full(INPUTS, 1e-9)
        each[:len(counts[:INPUTS])] = counts[:INPUTS]
        each = each.reshape(CLASSES, WIDTH)
        self.log_share = np.log(each / each.sum(axis=1, keepdims=True)).astype(np.float32)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place among the frequent words, whether it is one) of each key."""
        if not len(self.word):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.word, keys), len(self.word) - 1)
        return at, self.word[at] == keys


class Network:
    """A gated recurrent unit from input numbers to the logits of classes and
    of the words of each class; without training it gives the counts' shares."""

    names = ("inputs", "bias", "gates", "cand", "out", "out_bias", "word", "word_bias")

    def __init__(self, log_prior: np.ndarray, log_share: np.ndarray):
        rng = np.random.default_rng(7)
        n = len(log_prior)
        small = lambda *s: rng.normal(0, 0.15, s).astype(np.float32)
        self.inputs, self.bias = small(INPUTS + BANDS + 1, 3 * UNITS), np.zeros(3 * UNITS, np.float32)
        self.gates, self.cand = small(UNITS, 2 * UNITS), small(UNITS, UNITS)
        self.out, self.out_bias = small(UNITS, n), log_prior.astype(np.float32)
        self.word, self.word_bias = np.zeros((CLASSES, UNITS, WIDTH), np.float32), log_share.astype(np.float32)

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, k).reshape(-1) for k in self.names])

    def load(self, flat: np.ndarray) -> "Network":
        at = 0
        for k in self.names:
            a = getattr(self, k)
            setattr(self, k, flat[at:at + a.size].reshape(a.shape).astype(np.float32))
            at += a.size
        return self

    def step(self, x: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(new state, update and reset gates, candidate) of a row of inputs."""
        g = x[:, :2 * UNITS] + h @ self.gates
        np.negative(g, out=g)
        np.exp(np.minimum(g, 60, out=g), out=g)
        g += 1
        np.reciprocal(g, out=g)
        c = np.tanh(x[:, 2 * UNITS:] + (g[:, UNITS:] * h) @ self.cand)
        return h + g[:, :UNITS] * (c - h), g, c

    def class_logs(self, h: np.ndarray, klass: np.ndarray) -> np.ndarray:
        """log P(class | state) of one class a state."""
        return _picked_logs(h @ self.out + self.out_bias, klass)

    def word_logits(self, h: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list]:
        """(logits within the class, place of each of its rows in ``h``, place
        of the word in its class, (class, first row, end)) of those ids that
        have a learnt class, class by class."""
        at = np.flatnonzero(ids < INPUTS)
        klass = (ids[at] // WIDTH).astype(np.uint8)
        at = at[np.argsort(klass, kind="stable")]
        ends = np.cumsum(np.bincount(klass, minlength=CLASSES))
        runs = [(k, lo, hi) for k, (lo, hi) in enumerate(zip([0, *ends[:-1]], ends)) if hi > lo]
        rows, z = h[at], np.empty((len(at), WIDTH), np.float32)
        for k, lo, hi in runs:
            np.matmul(rows[lo:hi], self.word[k], out=z[lo:hi])
            z[lo:hi] += self.word_bias[k]
        return z, at, ids[at] % WIDTH, runs

    def token_logs(self, h: np.ndarray, ids: np.ndarray, class_of: np.ndarray) -> np.ndarray:
        """log P of what the network gives of each id: its class or band, and
        in a learnt class the word."""
        logs = self.class_logs(h, class_of[ids])
        z, at, place, _ = self.word_logits(h, ids)
        logs[at] += _picked_logs(z, place)
        return logs


def _picked_logs(z: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The log of the softmax at one place a row; ``z`` is used up."""
    if len(z):
        z -= z.max(axis=1, keepdims=True)
    picked = z[np.arange(len(z)), place].astype(np.float64)
    return picked - np.log(np.exp(z, out=z).sum(axis=1, dtype=np.float64))


def _errors(z: np.ndarray, place: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Gradient of the loss by the logits ``z``, in place."""
    if len(z):
        z -= z.max(axis=1, keepdims=True)
    np.exp(z, out=z)
    z *= (weight / z.sum(axis=1))[:, None]
    z[np.arange(len(z)), place] -= weight
    return z


class Trainer:
    """Truncated backpropagation with Adagrad on lanes of a token stream."""

    def __init__(self, net: Network, class_of: np.ndarray, end: int):
        self.net, self.class_of, self.end = net, class_of, end
        self.seen = {k: np.full_like(getattr(net, k), 1e-6) for k in net.names}
        self.tokens = 0

    def learn(self, stream: np.ndarray) -> None:
        """One pass over all tokens of a stream of documents that end in the end token."""
        lanes = max(1, min(LANES, len(stream) // (4 * STEPS)))
        size = -(-len(stream) // lanes)
        # lanes are filled up with end tokens, which carry no weight
        ids = np.full(lanes * size, self.end, np.int64)
        ids[:len(stream)] = stream
        weight = (np.arange(lanes * size) < len(stream)).reshape(lanes, size).T.astype(np.float32)
        ids = ids.reshape(lanes, size).T
        before = np.vstack([np.full((1, lanes), self.end), ids[:-1]])
        h = np.zeros((lanes, UNITS), np.float32)
        for t in range(0, size, STEPS):
            h = self._window(before[t:t + STEPS], ids[t:t + STEPS], weight[t:t + STEPS], h)
        self.tokens += len(stream)

    def _window(self, before: np.ndarray, ids: np.ndarray, weight: np.ndarray, h: np.ndarray) -> np.ndarray:
        net, u = self.net, UNITS
        n, lanes = ids.shape
        x = net.inputs[before] + net.bias
        starts, gates, cands, states = [], [], [], []
        for t in range(n):
            h = h * (before[t] != self.end)[:, None].astype(np.float32)       # a document starts from nothing
            starts.append(h)
            h, g, c = net.step(x[t], h)
            gates.append(g)
            cands.append(c)
            states.append(h)
        s = np.concatenate(states)
        flat = ids.reshape(-1)
        share = weight.reshape(-1) / max(1.0, float(weight.sum()))
        z = _errors(s @ net.out + net.out_bias, self.class_of[flat], share)
        grad = {"out": s.T @ z, "out_bias": z.sum(axis=0), "word": np.zeros_like(net.word), "word_bias": np.zeros_like(net.word_bias)}
        ds = z @ net.out.T
        z, at, place, runs = net.word_logits(s, flat)
        z, rows, back = _errors(z, place, share[at]), s[at], np.empty((len(at), u), np.float32)
        for k, lo, hi in runs:
            np.matmul(z[lo:hi], net.word[k].T, out=back[lo:hi])
            grad["word"][k], grad["word_bias"][k] = rows[lo:hi].T @ z[lo:hi], z[lo:hi].sum(axis=0)
        ds[at] += back
        ds = ds.reshape(n, lanes, u)
        dx = np.empty((n, lanes, 3 * u), np.float32)
        grad["gates"], grad["cand"] = np.zeros_like(net.gates), np.zeros_like(net.cand)
        back = np.zeros((lanes, u), np.float32)
        for t in range(n - 1, -1, -1):
            dh = ds[t] + back
            h0, g, c = starts[t], gates[t], cands[t]
            up, re = g[:, :u], g[:, u:]
            dc = dh * up * (1 - c * c)
            dr = dc @ net.cand.T
            dg = np.concatenate([dh * (c - h0) * up * (1 - up), dr * h0 * re * (1 - re)], axis=1)
            dx[t, :, :2 * u], dx[t, :, 2 * u:] = dg, dc
            grad["gates"] += h0.T @ dg
            grad["cand"] += (re * h0).T @ dc
            back = (dh * (1 - up) + dr * re + dg @ net.gates.T) * (before[t] != self.end)[:, None]
        flat, dx = before.reshape(-1), dx.reshape(-1, 3 * u)
        order = np.argsort(flat, kind="stable")
        edge = np.flatnonzero(np.concatenate([[True], np.diff(flat[order]) > 0]))
        rows, sums = flat[order][edge], np.add.reduceat(dx[order], edge, axis=0)
        grad["bias"] = dx.sum(axis=0)
        for k, d in grad.items():
            self._apply(getattr(net, k), self.seen[k], slice(None), d)
        self._apply(net.inputs, self.seen["inputs"], rows, sums)
        return h

    @staticmethod
    def _apply(value: np.ndarray, seen: np.ndarray, rows, d: np.ndarray) -> None:
        d = np.clip(d, -1, 1)
        now = seen[rows] + d * d
        seen[rows] = now
        value[rows] -= RATE * d / np.sqrt(now)


def document_logs(net: Network, class_of: np.ndarray, docs: list[np.ndarray], end: int) -> np.ndarray:
    """Sum of the network's log10 P over each whole document, in lockstep: the
    longest documents first, so that those at work are a prefix."""
    size = np.array([len(d) for d in docs], np.int64)
    out = np.zeros(len(docs))
    order = np.argsort(-size, kind="stable")
    size = size[order]
    at = np.concatenate([[0], np.cumsum(size)])
    flat = np.concatenate([docs[i] for i in order]).astype(np.int64) if len(docs) else np.zeros(0, np.int64)
    total = np.zeros(len(docs))
    work = np.searchsorted(-size, -np.arange(1, (size[0] if len(size) else 0) + 1), "right")
    h = np.zeros((len(docs), UNITS), np.float32)
    last = np.full(len(docs), end, np.int64)
    table = net.inputs + net.bias
    held, who, what, room = [], [], [], 0

    def flush() -> None:
        rows = np.concatenate(who)
        logs = net.token_logs(np.concatenate(held), np.concatenate(what), class_of)
        np.add.at(total, rows, logs)
        held.clear(), who.clear(), what.clear()

    for t, n in enumerate(work):
        h, _, _ = net.step(table[last[:n]], h[:n])
        last = flat[at[:n] + t]
        held.append(h)
        who.append(np.arange(n))
        what.append(last)
        room += n
        if room >= 1 << 16:
            flush()
            room = 0
    if held:
        flush()
    out[order] = total / np.log(10)
    return out


def score_documents(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, held_out, n_tokens,
    n_known, train_tokens, base_score, score (both log10).

    A null or empty text is the end token alone; a null id is not held out;
    repeated rows are learnt from and scored each; a text of any length is read
    whole, its state carried through; words of equal counts are ranked by their
    hash; other columns are ignored; an empty table gives an empty table, and
    without training rows all words are unknown.
    """
    spark = docs.sparkSession
    docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_column(docs).alias("text"))
    counts = staged(word_counts(docs), "lm-counts")
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    top = counts.orderBy(F.desc("n"), "word").limit(FREQUENT).collect()       # at most FREQUENT rows
    vocabulary = Vocabulary(np.array([r["word"] for r in top], np.int64).view(np.uint64), np.array([r["n"] for r in top], np.int64), total, distinct)
    shared = spark.sparkContext.broadcast(vocabulary)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        for batch in batches:
            for part in slices(batch):
                keys, at = tokens_of(part.column("text"))
                place, known = v.find(keys)
                ids = np.full(len(keys), v.other, np.uint16)
                ids[known] = v.input[place[known]]
                logs, inside = np.zeros(len(keys)), np.zeros(len(keys))
                logs[known] = np.log10(v.count[place[known]] + 1.0)
                inside[known] = v.inside[place[known]]
                row = np.repeat(np.arange(len(at) - 1), np.diff(at))
                rare = np.concatenate([[0], np.cumsum(~known)])[at]
                raw, n = ids.tobytes(), len(at) - 1
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(np.diff(at), pa.int64()),
                     pa.array(np.bincount(row, known, n).astype(np.int64)), pa.array(np.bincount(row, logs, n)), pa.array(np.bincount(row, inside, n)),
                     pa.array([raw[2 * a:2 * b] for a, b in zip(at[:-1], at[1:])], pa.binary()),
                     pa.ListArray.from_arrays(pa.array(rare, pa.int32()), pa.array(signed(keys[~known])))],
                    ["doc_id", "held_out", "n_tokens", "n_frequent", "logs", "inside", "ids", "rare"])

    read = docs.withColumn("held_out", held_out(F.col("doc_id"))).mapInArrow(
        encode, "doc_id long, held_out boolean, n_tokens long, n_frequent long, logs double, inside double, ids binary, rare array<long>")
    encoded = staged(read.withColumn("row", F.monotonically_increasing_id()), "lm-ids")
    place, known = vocabulary.find(np.array([END]))
    end = int(vocabulary.input[place[0]]) if known[0] else vocabulary.other

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        trainer = Trainer(Network(v.log_prior, v.log_share), v.class_of, end)
        for batch in batches:
            ids = batch.column("ids").to_pylist()
            lo = 0
            while lo < len(ids):
                hi, room = lo, 0
                while hi < len(ids) and room < 1 << 21:
                    room += len(ids[hi])
                    hi += 1
                trainer.learn(np.frombuffer(b"".join(ids[lo:hi]), np.uint16).astype(np.int64))
                lo = hi
        if trainer.tokens:
            flat = trainer.net.flat().astype(np.float64) * trainer.tokens
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(flat) + 1), pa.int32()), pa.array(np.append(flat, trainer.tokens))], ["i", "value"])

    learnt = encoded.filter(~F.col("held_out")).select("ids").mapInArrow(train, "i int, value double").groupBy("i").agg(F.sum("value").alias("value"))
    net = Network(vocabulary.log_prior, vocabulary.log_share)
    rows = learnt.collect()                                                    # one row a weight, whatever the corpus
    if rows:
        flat = np.zeros(len(rows))
        flat[[r["i"] for r in rows]] = [r["value"] for r in rows]
        net.load(flat[:-1] / flat[-1])
    model = spark.sparkContext.broadcast(net)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [np.frombuffer(x, np.uint16) for x in batch.column("ids").to_pylist()]
            logs = document_logs(model.value, shared.value.class_of, ids, end)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(logs)], [*batch.schema.names[:-1], "class_logs"])

    scored = encoded.select("row", "doc_id", "held_out", "n_tokens", "n_frequent", "logs", "inside", "ids").mapInArrow(
        score, "row long, doc_id long, held_out boolean, n_tokens long, n_frequent long, logs double, inside double, class_logs double")
    rare = encoded.select("row", F.explode("rare").alias("word")).groupBy("row", "word").agg(F.count("*").alias("tf")).join(counts, "word", "left")
    n = F.coalesce("n", F.lit(0))
    share = F.log10((n + 1.0) / float(vocabulary.rare_tokens + vocabulary.rare_words + 1))
    of_row = rare.groupBy("row").agg(
        F.sum(F.col("tf") * F.log10(n + 1.0)).alias("rare_logs"), F.sum(F.when(n > 0, F.col("tf")).otherwise(0)).alias("rare_known"),
        F.sum(F.col("tf") * share).alias("rare_inside"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    norm = float(np.log10(total + distinct + 1))
    return scored.join(of_row, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_frequent") + zero("rare_known")).cast("long").alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("logs") + zero("rare_logs") - F.col("n_tokens") * F.lit(norm)).alias("base_score"),
        (F.col("class_logs") + F.col("inside") + zero("rare_inside")).alias("score"))
