"""Toxicity of texts by a bidirectional gated recurrent network with attention pooling.

Each word enters as a vector of its own, for words known from training, and as
the mean of vectors of its character trigrams.  Two gated recurrent layers read
a window of words forwards and backwards, attention weighs the places, and a
logistic unit judges the window.  A document is as toxic as its worst window;
windows overlap by half and cover the whole text.

The network is trained in numpy on a bounded sample of labelled documents.  A
label says only that some part of a document is toxic, so training begins with
windows drawn from all parts and then goes on with the windows of each toxic
document, and some of the others, that score highest so far.  A document that
is labelled toxic but has no window that looks so by then is taken for
mislabelled and left out.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.llm.common import forget, written

WINDOW, STEP = 32, 16  # words
HIDDEN, WORD_DIM, CHAR_DIM = 8, 8, 8
BUCKETS = 4096  # of character trigrams
TRIGRAMS = 24  # of a word that are used, one for each character; longer words are cut
PIECE_STEP = 16  # characters from one piece of a long word to the next
STRIP = ".,;:!?\"'()[]{}<>*_#$%&|-–—«»„“”…"


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def words_of(text: str | None) -> list[str]:
    """Words of a text in lower case; longer ones than TRIGRAMS as overlapping pieces, so that each character is read."""
    words = text.lower().split() if text else []
    return [piece for w in words for piece in pieces(w)] if any(len(w) > TRIGRAMS for w in words) else words


def pieces(word: str) -> list[str]:
    plain = word if len(word) <= TRIGRAMS else word.strip(STRIP) or word
    if len(plain) <= TRIGRAMS:
        return [word]
    starts = [*range(0, len(plain) - TRIGRAMS, PIECE_STEP), len(plain) - TRIGRAMS]
    return [plain[i : i + TRIGRAMS] for i in starts]


def window_starts(n: int) -> np.ndarray:
    """Starts of overlapping windows that cover n words; the last one ends with the text."""
    return np.array([*range(0, max(1, n - WINDOW), STEP), *([n - WINDOW] if n > WINDOW else [])])


def trigrams(word: str) -> np.ndarray:
    marked = f"<{word}>"
    found = [xxhash.xxh32_intdigest(marked[i : i + 3]) % BUCKETS for i in range(min(len(marked) - 2, TRIGRAMS))]
    return np.array(found + [BUCKETS] * (TRIGRAMS - len(found)))  # the last vector is always zero


def _summed(at: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sums of rows by their place."""
    return np.stack([np.bincount(at, c, n) for c in rows.T], axis=1).astype(rows.dtype)


@dataclass
class Network:
    """Parameters by name, and the number of each known word; 0 stands for any other word."""

    known: dict[str, int]
    p: dict[str, np.ndarray]
    shift: float = 0.0

    @classmethod
    def new(cls, vocabulary: Sequence[str], rng: np.random.Generator) -> Network:
        def normal(*shape, scale=0.3):
            return rng.normal(0, scale, shape).astype(np.float32)

        depth = WORD_DIM + CHAR_DIM
        p = {"words": normal(len(vocabulary) + 1, WORD_DIM, scale=0.1), "chars": normal(BUCKETS + 1, CHAR_DIM, scale=0.1)}
        p["words"][0] = 0
        p["chars"][BUCKETS] = 0
        for d in ("f", "b"):
            p |= {f"W{d}": normal(depth, 3 * HIDDEN), f"B{d}": np.zeros(3 * HIDDEN, np.float32)}
            p |= {f"U{d}": normal(HIDDEN, 3 * HIDDEN), f"N{d}": np.zeros(HIDDEN, np.float32)}
        p |= {"attend": normal(2 * HIDDEN), "out": normal(2 * HIDDEN), "bias": np.zeros(1, np.float32)}
        return cls({w: i + 1 for i, w in enumerate(vocabulary)}, p)

    def features(self, words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Number and trigrams of words."""
        plain = [w.strip(STRIP) or w for w in words]
        ids = np.array([self.known.get(w, 0) for w in plain], np.int64)
        return ids, np.array([trigrams(w) for w in plain]).reshape(len(plain), TRIGRAMS)

    def inputs(self, ids: np.ndarray, grams: np.ndarray) -> np.ndarray:
        counts = np.maximum((grams < BUCKETS).sum(1, keepdims=True), 1).astype(np.float32)
        return np.hstack([self.p["words"][ids], self.p["chars"][grams].sum(1) / counts])

    def project(self, x: np.ndarray) -> np.ndarray:
        """What words add to the gates of both directions."""
        return np.hstack([x @ self.p["Wf"] + self.p["Bf"], x @ self.p["Wb"] + self.p["Bb"]])

    def _read(self, gates: np.ndarray, mask: np.ndarray, d: str, keep: list | None) -> np.ndarray:
        """States of one direction; gates: (time, 3 * HIDDEN, windows), mask: (time, windows)."""
        U, N, H = self.p[f"U{d}"].T, self.p[f"N{d}"][:, None], HIDDEN
        n_time, _, n = gates.shape
        h, out = np.zeros((H, n), gates.dtype), np.empty((n_time, H, n), gates.dtype)
        for t in range(n_time) if d == "f" else range(n_time - 1, -1, -1):
            g = U @ h
            zr = 1 / (1 + np.exp(-(gates[t, : 2 * H] + g[: 2 * H])))
            z, r, inner = zr[:H], zr[H:], g[2 * H :] + N
            new = 2 / (1 + np.exp(-2 * (gates[t, 2 * H :] + r * inner))) - 1  # the hyperbolic tangent
            if keep is not None:
                keep.append((t, h, z, r, inner, new))
            h = (new + z * (h - new)) * mask[t]
            out[t] = h
        return out

    def logits(self, gates: np.ndarray, mask: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """One number a window; gates: (time, 6 * HIDDEN, windows), mask: (time, windows)."""
        steps = ([], []) if keep is not None else (None, None)
        H = 3 * HIDDEN
        states = np.concatenate([self._read(gates[:, :H], mask, "f", steps[0]), self._read(gates[:, H:], mask, "b", steps[1])], 1)
        e = np.where(mask > 0, self.p["attend"] @ states, np.float32(-1e9))
        weights = np.exp(e - e.max(0))
        weights /= weights.sum(0)
        pooled = (weights[:, None] * states).sum(0)
        if keep is not None:
            keep |= {"steps": steps, "states": states, "weights": weights, "pooled": pooled}
        return self.p["out"] @ pooled + self.p["bias"]

    def gradients(self, ids, grams, where, mask, labels) -> tuple[float, dict[str, np.ndarray]]:
        """Loss of a batch and its gradients; ids and grams are of distinct words, where is (time, windows)."""
        x, keep = self.inputs(ids, grams), {}
        gates = np.ascontiguousarray(self.project(x)[where].transpose(0, 2, 1))
        prob = sigmoid(self.logits(gates, mask, keep))
        loss = float(-np.where(labels > 0, np.log(prob + 1e-7), np.log(1 - prob + 1e-7)).mean())
        d_out = ((prob - labels) / len(labels)).astype(gates.dtype)
        states, weights = keep["states"], keep["weights"]
        grads = {"out": keep["pooled"] @ d_out, "bias": d_out.sum(keepdims=True)}
        d_pooled = self.p["out"][:, None] * d_out
        d_weights = (states * d_pooled).sum(1)
        d_e = weights * (d_weights - (weights * d_weights).sum(0))
        grads["attend"] = (d_e[:, None] * states).sum((0, 2))
        d_states = weights[:, None] * d_pooled + d_e[:, None] * self.p["attend"][:, None]
        d_gates = np.empty_like(gates)
        H = HIDDEN
        for i, d in enumerate("fb"):
            U, at = self.p[f"U{d}"], slice(3 * H * i, 3 * H * (i + 1))
            dU, dN, dh = np.zeros_like(U), np.zeros(H, gates.dtype), 0
            for t, h, z, r, inner, new in reversed(keep["steps"][i]):
                dh = (dh + d_states[t, H * i : H * (i + 1)]) * mask[t]
                d_new = dh * (1 - z) * (1 - new * new)
                d_z = dh * (h - new) * z * (1 - z)
                d_r = d_new * inner * r * (1 - r)
                dg = np.vstack([d_z, d_r, d_new * r])
                d_gates[t, at] = np.vstack([d_z, d_r, d_new])
                dU += h @ dg.T
                dN += dg[2 * H :].sum(1)
                dh = dh * z + U @ dg
            grads |= {f"U{d}": dU, f"N{d}": dN}
        flat, order = where.ravel(), np.argsort(where.ravel(), kind="stable")
        first = np.flatnonzero(np.diff(flat[order], prepend=-1))
        d_project = np.zeros((len(ids), 6 * H), gates.dtype)
        d_project[flat[order][first]] = np.add.reduceat(d_gates.transpose(0, 2, 1).reshape(-1, 6 * H)[order], first)
        f, b = d_project[:, : 3 * H], d_project[:, 3 * H :]
        grads |= {"Wf": x.T @ f, "Bf": f.sum(0), "Wb": x.T @ b, "Bb": b.sum(0)}
        dx = f @ self.p["Wf"].T + b @ self.p["Wb"].T
        counts = np.maximum((grams < BUCKETS).sum(1, keepdims=True), 1)
        grads["words"] = _summed(ids, dx[:, :WORD_DIM], len(self.p["words"]))
        grads["chars"] = _summed(grams.ravel(), np.repeat(dx[:, WORD_DIM:] / counts, TRIGRAMS, axis=0), len(self.p["chars"]))
        grads["words"][0] = 0
        grads["chars"][BUCKETS] = 0
        return loss, grads


class Scorer:
    """Scores texts with a trained network; remembers what at most ``limit`` words add to the gates."""

    def __init__(self, network: Network, limit: int = 300_000, batch: int = 1024):
        self._net, self._limit, self._batch = network, limit, batch
        self._row: dict[str, int] = {}
        self._table = np.zeros((1024, 6 * HIDDEN), np.float32)  # row 0 stands for no word

    def _rows(self, words: list[str]) -> np.ndarray:
        found = [*map(self._row.get, words)]
        new = list({w for w, i in zip(words, found, strict=True) if i is None}) if None in found else []
        if new:
            n = len(self._row) + 1
            if n + len(new) > len(self._table):
                more = np.zeros((max(2 * len(self._table), n + len(new)), 6 * HIDDEN), np.float32)
                more[:n] = self._table[:n]
                self._table = more
            self._table[n : n + len(new)] = self._net.project(self._net.inputs(*self._net.features(new)))
            self._row.update((w, n + i) for i, w in enumerate(new))
            found = map(self._row.__getitem__, words)
        return np.fromiter(found, np.int64, len(words))

    def window_logits(self, texts: Sequence[list[str]]) -> list[np.ndarray]:
        """For each text, given as words, one number a window."""
        if len(self._row) > self._limit:
            self._row.clear()
        found, counts, out, waiting = [], [], [], 0

        def judge() -> None:
            at = np.concatenate(found)
            for i in range(0, len(at), self._batch):
                part = np.ascontiguousarray(at[i : i + self._batch].T)
                gates = np.ascontiguousarray(self._table[part].transpose(0, 2, 1))
                out.append(self._net.logits(gates, (part > 0).astype(np.float32)))
            found.clear()

        for words in texts:
            rows = self._rows(words)
            starts = window_starts(len(rows))
            counts.append(len(starts))
            for i in range(0, len(starts), 4096):
                places = starts[i : i + 4096, None] + np.arange(WINDOW)
                padded = np.append(rows, 0)  # places behind the end of a short text hold no word
                found.append(padded[np.minimum(places, len(rows))])
                waiting += len(places)
                if waiting >= 8192:
                    judge()
                    waiting = 0
        if found:
            judge()
        return np.split(np.concatenate(out), np.cumsum(counts)[:-1]) if counts else []

    def scores(self, texts: Sequence[list[str]]) -> np.ndarray:
        return np.array([sigmoid(np.float64(x.max() - self._net.shift)) for x in self.window_logits(texts)])


class _Windows:
    """Windows of documents as numbers of their words; 0 stands for no word."""

    def __init__(self, texts: Sequence[Sequence[str]]):
        number: dict[str, int] = {}
        self.owner = np.repeat(np.arange(len(texts)), [len(doc) for doc in texts])
        self.places = np.zeros((len(self.owner), WINDOW), np.int32)
        for row, window in zip(self.places, (w for doc in texts for w in doc), strict=True):
            found = [number.setdefault(w, len(number) + 1) for w in window.split(" ")] if window else []
            row[: len(found)] = found
        order = sorted(number)
        moved = np.zeros(len(order) + 1, np.int32)
        moved[[number[w] for w in order]] = np.arange(1, len(order) + 1)
        self.places, self.words = moved[self.places], order

    def informative(self, labels: np.ndarray, apart: np.ndarray, limit: int) -> list[str]:
        """Words, without punctuation around them, whose share of documents differs most between the labels."""
        plain = sorted({w.strip(STRIP) or w for w in self.words})
        at = {w: i + 1 for i, w in enumerate(plain)}
        to = np.array([0, *(at[w.strip(STRIP) or w] for w in self.words)])
        seen = np.zeros((2, len(plain) + 1))
        ends = np.searchsorted(self.owner, np.arange(len(labels) + 1))
        for d in np.flatnonzero(~apart):
            seen[int(labels[d]), np.unique(to[self.places[ends[d] : ends[d + 1]]])] += 1
        n = [max(1, int((labels[~apart] == y).sum())) for y in (0, 1)]
        odds = np.abs(np.log((seen[1] + 0.5) / (n[1] + 1)) - np.log((seen[0] + 0.5) / (n[0] + 1)))
        common = 1 + np.flatnonzero(seen[:, 1:].sum(0) > 2)
        return [plain[i - 1] for i in sorted(common, key=lambda i: (-odds[i], plain[i - 1]))[:limit]]


def train(
    texts: Sequence[Sequence[str]], labels: np.ndarray, toxic_share: float = 0.5, *,
    seed: int = 7, steps: int = 900, batch: int = 128, vocabulary: int = 4000,
) -> Network:
    """Fit a network to documents, each given as windows of words between single spaces, and their labels.

    Every fifth document of each label is kept from the training and sets the cut between the two answers, for which
    the labels are taken to stand to each other as ``toxic_share`` says.
    """
    labels = np.asarray(labels)
    rng = np.random.default_rng(seed)
    rank = np.zeros(len(labels), int)
    for y in (0, 1):
        rank[labels == y] = np.arange((labels == y).sum())
    apart = rank % 5 == 4
    if len(labels) < 50:  # too few to keep any apart
        apart[:] = False
    data = _Windows(texts)
    places, owner = data.places, data.owner
    fit = ~apart[owner] if len(owner) else np.zeros(0, bool)
    net = Network.new(data.informative(labels, apart, vocabulary), rng)
    truth = labels[owner] if len(owner) else np.empty(0)
    if not fit.any() or truth[fit].min() == truth[fit].max():
        net.shift = 0.0 if len(owner) and truth.max() else 2.0  # one label only: nothing to learn
        return net
    # Word 0 stands for no word.  Words are taken in parts, as the vectors of all trigrams at once would be large.
    all_ids, all_grams = np.zeros(len(data.words) + 1, np.int64), np.full((len(data.words) + 1, TRIGRAMS), BUCKETS, np.int16)
    for i in range(0, len(data.words), 8192):
        all_ids[1 + i : 8193 + i], all_grams[1 + i : 8193 + i] = net.features(data.words[i : i + 8192])

    def judge_all() -> np.ndarray:
        x = np.concatenate([net.inputs(all_ids[i : i + 8192], all_grams[i : i + 8192]) for i in range(0, len(all_ids), 8192)])
        table, out = net.project(x), []
        for i in range(0, len(places), 2048):
            part = places[i : i + 2048].T
            out.append(net.logits(np.ascontiguousarray(table[part].transpose(0, 2, 1)), (part > 0).astype(np.float32)))
        return np.concatenate(out)

    mean, square = ({k: np.zeros_like(v) for k, v in net.p.items()} for _ in range(2))
    pools = {y: np.flatnonzero((truth == y) & fit) for y in (0, 1)}
    hard = pools
    for step in range(1, steps + 1):
        if step in (steps // 3, steps * 2 // 3):
            logit = judge_all()
            best = np.lexsort((-logit, owner))
            rank = np.empty(len(best), np.int64)
            rank[best] = np.arange(len(best)) - np.searchsorted(owner[best], owner[best])
            hard = {y: np.flatnonzero((truth == y) & fit & (rank < 2) & ((logit > 0) | (y == 0))) for y in (0, 1)}
            if not len(hard[1]):
                hard[1] = np.flatnonzero((truth == 1) & fit & (rank < 1))
        half = batch // 2
        chosen = np.concatenate([rng.choice(hard[1], half), rng.choice(hard[0], half // 2), rng.choice(pools[0], half - half // 2)])
        distinct, where = np.unique(places[chosen].T, return_inverse=True)
        ids, grams = all_ids[distinct], all_grams[distinct]
        ids[rng.random(len(ids)) < 0.1] = 0  # some words are read by their characters alone
        mask = (places[chosen].T > 0).astype(np.float32)
        _, grads = net.gradients(ids, grams, where.reshape(WINDOW, batch), mask, truth[chosen].astype(np.float32))
        rate = 0.02 * (1 - 0.9 * step / steps)
        for k, g in grads.items():
            g = np.clip(g, -1, 1)
            mean[k] = 0.9 * mean[k] + 0.1 * g
            square[k] = 0.99 * square[k] + 0.01 * g * g
            net.p[k] -= (rate * mean[k] / (1 - 0.9**step) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    top = np.full(len(labels), -np.inf)
    np.maximum.at(top, owner, judge_all())
    judged = np.isfinite(top) & (apart if apart.any() and len(set(labels[apart])) == 2 else True)
    net.shift = _cut(top[judged], labels[judged], toxic_share)
    return net


def _cut(scores: np.ndarray, labels: np.ndarray, toxic_share: float) -> float:
    """The score at which both labels are equally likely, by a logistic curve through the scores.

    A label's documents together weigh as much as its share.  A weak pull to 0 keeps the curve apart from a step where
    the scores divide the labels.
    """
    weight = np.where(labels == 1, toxic_share / max(1, (labels == 1).sum()), (1 - toxic_share) / max(1, (labels == 0).sum()))
    weight = weight * len(labels)
    middle, spread = scores.mean(), max(scores.std(), 1e-6)
    x = np.stack([(scores - middle) / spread, np.ones(len(scores))], 1)
    at = np.zeros(2)
    for _ in range(200):
        p = sigmoid(x @ at)
        gradient = x.T @ (weight * (p - labels)) + 0.01 * at
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(2)
        step = np.linalg.solve(curve, gradient)
        at = at - step / max(1.0, np.abs(step).max())
    return float(middle - spread * at[1] / max(at[0], 0.1))


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def toxic_share(labels: DataFrame) -> float:
    """Share of toxic among the labels that may be learnt from."""
    found = _labelled(labels).agg(F.avg("toxic")).first()[0]
    return 0.5 if found is None else min(max(found, 0.01), 0.99)


def _labelled(labels: DataFrame) -> DataFrame:
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out())
    return usable.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))


def sample(docs: DataFrame, labels: DataFrame, per_label: int = 1200, windows: int = 64) -> tuple[list, np.ndarray]:
    """Training windows: of each label the documents with the smallest hash of doc_id, never held-out ones.

    ``per_label`` bounds the documents of a label, ``windows`` the windows taken, evenly spread, from one document.
    Of rows that share a doc_id, the one whose text has the smallest hash is taken.
    """
    labelled = _labelled(labels)
    known = docs.select("doc_id").distinct()
    chosen = None
    for label in (0, 1):
        part = labelled.filter(F.col("toxic") == label).join(known, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_label)
        chosen = part if chosen is None else chosen.unionByName(part)
    chosen = F.broadcast(written(chosen, "labelled"))  # at most 2 * per_label rows

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        best: dict[int, tuple[int, int, list[str]]] = {}  # of each doc_id the text with the smallest hash
        for batch in batches:
            for row in range(batch.num_rows):
                doc_id, toxic, order = (batch.column(c)[row].as_py() for c in (0, 2, 3))
                if doc_id in best and best[doc_id][0] <= order:
                    continue
                words = words_of(batch.column(1)[row].as_py())
                starts = window_starts(len(words))
                if len(starts) > windows:
                    starts = starts[np.linspace(0, len(starts) - 1, windows).astype(int)]
                best[doc_id] = order, toxic, [" ".join(words[i : i + WINDOW]) for i in starts]
        for doc_id, (order, toxic, found) in best.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([doc_id], pa.int64()), pa.array([toxic], pa.int32()), pa.array([order], pa.int64()), pa.array([found], pa.list_(pa.string()))],
                ["doc_id", "toxic", "order", "windows"],
            )

    found = docs.select("doc_id", "text").join(chosen, "doc_id").select("doc_id", "text", "toxic", F.xxhash64("text").alias("order"))
    cuts = found.mapInArrow(cut, "doc_id long, toxic int, order long, windows array<string>")
    one = F.min(F.struct("order", "windows"))
    rows = cuts.groupBy("doc_id", "toxic").agg(one.alias("one")).select("doc_id", "toxic", "one.windows").toArrow()
    rows = rows.sort_by("doc_id")
    return rows.column("windows").to_pylist(), rows.column("toxic").to_numpy()


def score(docs: DataFrame, network: Network, *, keep_columns: bool = False) -> DataFrame:
    """doc_id, held_out, score and predicted for every whole text of ``docs`` (doc_id, text).

    One row for every input row; a null or empty text is one window without words and has a score like any other.
    A null doc_id is not held out.  An empty table gives no rows.  With ``keep_columns`` the result has the columns of
    ``docs`` and then held_out, score and predicted, which replace columns of those names; otherwise further columns
    are not read.
    """
    added = T.StructType().add("score", T.DoubleType()).add("predicted", T.IntegerType())
    rest = [c for c in (docs.columns if keep_columns else ["doc_id"]) if c not in ("held_out", "score", "predicted")]
    n = len(rest) + 1
    # A kept text is scored where it stands: sent twice, it would double the batches on both sides.
    at_text = rest.index("text") if "text" in rest else n
    source = docs.select(*rest, held_out().alias("held_out"), *([F.col("text").alias("text_to_score")] if at_text == n else []))
    schema = T.StructType([*source.schema.fields[:n], *added.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        scorer = Scorer(network)  # one a task, gone with it: later operators need the memory
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                found = scorer.scores([words_of(t) for t in part.column(at_text).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:n], pa.array(found, pa.float64()), pa.array((found >= 0.5).astype(np.int32))],
                    [*part.schema.names[:n], "score", "predicted"],
                )

    return source.mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Train on labelled documents that are not held out and score all; see ``sample``, ``train`` and ``score``."""
    return score(docs, train(*sample(docs, labels), toxic_share(labels), **options))
