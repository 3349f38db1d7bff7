"""Problem 10: subject areas of documents.

For every subject an interpolated bigram language model is trained from hand-labelled
documents; a sentence belongs to the subject whose model beats the background model by the
most bits per sentence, and a document has the subjects that take up enough of its
sentences. Models are refined by re-assigning the training sentences among their document's
labels, so a document about two areas teaches each area its own sentences. The shares from
which a second subject is accepted are calibrated on labels held out from training.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkit as K
from .neardup import chunks

# Weights of bigram and unigram, chosen on held-out labels; the rest goes to the background.
L2, L1 = 0.05, 0.87
MARGIN = 1.5  # nats by which a sentence's best subject must lead the next


def sentence_tokens(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(word hash, bigram hash, sentence number, text of every sentence).

    A sentence ends at . ? ! after a word of two letters or more and before a blank, at an
    empty line, and at the end of the text.
    """
    cp, starts = K.codes(texts)
    kind, _ = K.tables()
    k = kind[cp]
    s, e, h, _ = K.words(cp)
    if not len(s):
        return np.empty(0, K.U64), np.empty(0, K.U64), np.empty(0, np.int64), np.empty(0, np.int64)
    doc = np.searchsorted(starts, s, "right") - 1
    nxt = np.minimum(e, len(cp) - 1)
    stop = np.isin(cp[nxt], [46, 63, 33]) & ((k[np.minimum(e + 1, len(cp) - 1)] & K.SPACE) != 0) & (e - s >= 2)
    # an empty line between this word and the next
    blank = np.zeros(len(cp) + 1, np.int64)
    blank[2:] = np.cumsum((cp[1:] == 10) & (cp[:-1] == 10))
    gap = np.zeros(len(s), bool)
    gap[:-1] = blank[s[1:]] > blank[e[:-1]]
    new = np.ones(len(s), bool)
    new[1:] = stop[:-1] | gap[:-1] | (doc[1:] != doc[:-1])
    sent = np.cumsum(new) - 1
    prev = np.empty_like(h)
    prev[1:] = h[:-1]
    prev[new] = 1
    return h, K.mix(prev * K.BASE + h), sent, doc[new]


class Table:
    """Sorted hashes of the terms in at least ``least`` texts; others get the last row. Names
    that fill one text say nothing about others, however often they stand in it."""

    def __init__(self, h: np.ndarray, owner: np.ndarray, least: int) -> None:
        o = np.lexsort((owner, h))
        h, owner = h[o], owner[o]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
        u, n = np.unique(h[new], return_counts=True)
        self.h = u[n >= least]

    def ids(self, h: np.ndarray) -> np.ndarray:
        if not len(self.h):
            return np.zeros(len(h), np.int64)
        i = np.searchsorted(self.h, h)
        i[i == len(self.h)] = 0
        return np.where(self.h[i] == h, i, len(self.h))


class SubjectModel:
    def __init__(self, texts: list[str], labels: list[set[str]], subjects: list[str], rounds: int = 4) -> None:
        """Fit on labelled texts. Subjects without a label are never assigned."""
        self.subjects = sorted(subjects)
        m = len(self.subjects)
        h, g, sent, owner = sentence_tokens(texts)
        n_sent = len(owner)
        of = owner[sent] if n_sent else sent
        least = max(2, min(5, len(texts) // 40))
        self.uni, self.bi = Table(h, of, least), Table(g, of, least)
        w, b = self.uni.ids(h), self.bi.ids(g)
        V, B = len(self.uni.h) + 1, len(self.bi.h) + 1
        allowed = np.zeros((len(texts), m), bool)
        for i, ls in enumerate(labels):
            for s in ls:
                if s in self.subjects:
                    allowed[i, self.subjects.index(s)] = True
        ok = allowed[owner] if n_sent else np.zeros((0, m), bool)
        # context of a bigram: counted by the hash of the word before it
        prev = np.empty(len(w), np.int64)
        prev[1:] = w[:-1]
        if len(w):
            first = np.diff(sent, prepend=-1) != 0
            prev[first] = V - 1
        self.context = np.zeros(B, np.int64)
        self.context[b] = prev
        self.word = np.zeros(B, np.int64)
        self.word[b] = w
        bg_u = np.bincount(w, minlength=V) + 0.5
        bg_b = np.bincount(b, minlength=B).astype(float)
        bg_c = np.bincount(prev, minlength=V).astype(float)
        bg_u /= bg_u.sum()
        base_b = L2 * bg_b / np.maximum(bg_c[self.context], 1) + (1 - L2) * bg_u[self.word]
        resp = ok / np.maximum(ok.sum(1, keepdims=True), 1)
        self.wu, self.wb = np.zeros((V, m), np.float32), np.zeros((B, m), np.float32)
        for _ in range(rounds):
            for j in range(m):
                r = resp[sent, j] if n_sent else np.zeros(0)
                cu, cb, cc = np.bincount(w, r, V), np.bincount(b, r, B), np.bincount(prev, r, V)
                total = cu.sum()
                if total == 0:
                    self.wu[:, j] = self.wb[:, j] = -5
                    continue
                pu = L1 / (1 - L2) * cu / total + (1 - L1 / (1 - L2)) * bg_u
                self.wu[:, j] = np.log(pu / bg_u)
                pb = L2 * cb / np.maximum(cc[self.context], 1) + (1 - L2) * pu[self.word]
                self.wb[:, j] = np.log(np.maximum(pb, 1e-12) / np.maximum(base_b, 1e-12))
            self.wu[V - 1] = 0
            self.wb[B - 1] = 0
            if n_sent:
                score = self._scores(w, b, sent)
                x = np.where(ok, score, -1e9)
                x = np.exp(np.clip(x - x.max(1, keepdims=True), -50, 0)) * ok
                resp = x / np.maximum(x.sum(1, keepdims=True), 1e-9)
        self.theta = np.full(m, 0.25)

    def calibrate(self, texts: list[str], labels: list[set[str]], least: int = 30) -> None:
        """Set the shares from which a second subject is accepted on texts that were not trained
        on: one for all, the nearest to a quarter among those that do equally well; and one of
        its own for a subject that is second in ``least`` texts or more and gains by it."""
        allowed = np.array([[s in ls for s in self.subjects] for ls in labels], bool).reshape(len(texts), len(self.subjects))
        share = self.shares(texts)[0]
        grid = np.arange(0.12, 0.42, 0.01)
        scores = {}
        for theta in grid:
            pred = self._accept(share, np.full(len(self.subjects), theta))
            scores[float(theta)] = 2 * (pred & allowed).sum() / max(1, pred.sum() + allowed.sum())
        self.held_out_f1 = max(scores.values())
        one = min((t for t, f in scores.items() if f >= self.held_out_f1 - 0.002), key=lambda t: abs(t - 0.25))
        self.theta[:] = one
        if share.shape[1] < 2:
            return
        second = np.argsort(-share, axis=1, kind="stable")[:, 1]
        for j in range(len(self.subjects)):
            at = np.flatnonzero((second == j) & (share[:, j] > 0))
            if len(at) < least:
                continue
            right = {float(t): ((share[at, j] >= t) == allowed[at, j]).mean() for t in grid}
            best = max(right.values())
            if best > ((share[at, j] >= one) == allowed[at, j]).mean() + 0.01:
                self.theta[j] = min((t for t, r in right.items() if r >= best - 1e-9), key=lambda t: abs(t - one))

    def _scores(self, w: np.ndarray, b: np.ndarray, sent: np.ndarray) -> np.ndarray:
        st = np.flatnonzero(np.diff(sent, prepend=-1))
        out = np.empty((len(st), self.wu.shape[1]), np.float32)
        step = 4096  # sentences at a time
        for i in range(0, len(st), step):
            lo, hi = st[i], st[i + step] if i + step < len(st) else len(w)
            known = b[lo:hi] < len(self.bi.h)
            per = np.where(known[:, None], self.wb[b[lo:hi]], self.wu[w[lo:hi]])
            out[i : i + step] = np.add.reduceat(per, st[i : i + step] - lo, axis=0)
        return out

    def shares(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(share of each text's sentences by subject, number of sentences with a subject)."""
        h, g, sent, owner = sentence_tokens(texts)
        m = len(self.subjects)
        out = np.zeros((len(texts), m))
        if len(owner):
            s = self._scores(self.uni.ids(h), self.bi.ids(g), sent)
            top = s.argmax(1)
            lead = np.sort(s, axis=1)
            clear = lead[:, -1] > 1.0
            if m > 1:
                clear &= lead[:, -1] - lead[:, -2] > MARGIN
            np.add.at(out, (owner[clear], top[clear]), 1)
        n = out.sum(1)
        return out / np.maximum(n, 1)[:, None], n

    @staticmethod
    def _accept(share: np.ndarray, theta: np.ndarray) -> np.ndarray:
        """The leading subject, and the second where its share is at least its theta."""
        order = np.argsort(-share, axis=1, kind="stable")
        pred = np.zeros(share.shape, bool)
        rows = np.arange(len(share))
        if share.shape[1]:
            pred[rows, order[:, 0]] = share[rows, order[:, 0]] > 0
        if share.shape[1] > 1:
            pred[rows, order[:, 1]] = share[rows, order[:, 1]] >= theta[order[:, 1]]
        return pred

    def predict(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        share, n = self.shares(texts)
        return self._accept(share, self.theta), n


def fit(docs: DataFrame, labels: DataFrame, areas: DataFrame, max_docs: int = 3000) -> SubjectModel:
    """Train on at most ``max_docs`` labelled documents, the first by hash of their id. A model of
    two thirds of them sets the thresholds on the rest; the model returned has learned from all.
    ``areas`` is the list of subjects in use, which every task holds."""
    names = sorted(r[0] for r in areas.where("subject IS NOT NULL").select("subject").distinct().collect())
    lab = labels.where("doc_id IS NOT NULL AND subject IS NOT NULL").groupBy("doc_id").agg(F.collect_set("subject").alias("subjects"))
    lab = lab.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs)  # bounds what the driver holds
    rows = docs.where("text IS NOT NULL").select("doc_id", "text").join(F.broadcast(lab), "doc_id").select("doc_id", "text", "subjects").toPandas().sort_values("doc_id")
    texts, sets = rows["text"].tolist(), [set(x) for x in rows["subjects"]]
    kept = np.arange(len(texts)) % 3 == 2
    trial = SubjectModel([t for t, k in zip(texts, kept) if not k], [x for x, k in zip(sets, kept) if not k], names)
    if kept.any():
        trial.calibrate([t for t, k in zip(texts, kept) if k], [x for x, k in zip(sets, kept) if k])
    theta = trial.theta
    del trial
    model = SubjectModel(texts, sets, names)
    model.theta = theta
    return model


def subjects_of(docs: DataFrame, model: SubjectModel) -> DataFrame:
    """(doc_id, subject, n_subjects, sentences): null, empty and wordless texts have no subject."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = held.value
        for f in chunks(frames, "t"):
            pred, n = m.predict(f["t"].tolist())
            i, j = np.nonzero(pred)
            yield pd.DataFrame({"doc_id": f["doc_id"].to_numpy()[i], "subject": np.array(m.subjects, dtype=object)[j], "n_subjects": pred.sum(1)[i].astype(np.int32), "sentences": n[i].astype(np.int32)})

    src = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", F.col("text").alias("t"))
    return src.mapInPandas(run, "doc_id long, subject string, n_subjects int, sentences int")
