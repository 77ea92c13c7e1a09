"""Toxicity scores by a bidirectional gated recurrent network in numpy.

Each word is its word embedding (zero, unless a share ``SEEN_IN`` of the texts
learned from has it) beside the mean of its hashed character pairs' embeddings. A text is covered by overlapping windows of words; a gated
recurrent network reads each both ways, attention pools its states, and a
logistic unit scores it. A text's score is that of its worst window,
calibrated with the number of windows (the more there are, the higher the worst
of a harmless text). Everything is trained in numpy on a bounded sample of
labelled texts, by Adam and Adagrad. Windows bear the label of their text, which most windows
of a toxic text do not deserve; so in the second half of training the loss is
the generalised cross-entropy, which trusts a label less the less likely it looks.

Edge cases: a null or empty text, or one without a word, has no window and gets
the share of toxic texts among the labelled. With labels of one class only, or
none, every text gets that share (0 without labels). Repeated rows get equal
scores. A label that is neither 0 nor 1, or has no key, is not used; of
repeated labels of a key the larger is. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import by_hash, codepoints, cut_text, letters, mix, passages, text_runs

WINDOW, STRIDE = 64, 32
PAIR_BITS = 12
SEEN_IN = 0.01  # of the texts, and in three at least
TRUST = 0.7
DROP = 0.2
WORD_DIM, PAIR_DIM, HIDDEN = 12, 8, 8
_POWERS = np.cumprod(np.concatenate(([1], np.full(255, 0x100000001B3, np.uint64))), dtype=np.uint64)


@dataclass
class Words:
    """The words of a run of texts: distinct ones, and which stands where."""

    key: np.ndarray  # 64-bit hash of each distinct word, rising
    pair: np.ndarray  # buckets of all character pairs, distinct word by distinct word
    pair_at: np.ndarray  # where each distinct word's pairs begin; one more at the end
    which: np.ndarray  # distinct word at each place
    text_at: np.ndarray  # where each text's words begin; one more at the end


def read_words(texts: list[str]) -> Words:
    lower = [t.lower() for t in texts]
    cp = codepoints("\n".join([*lower, ""]))
    edges = np.cumsum([0, *(len(t) + 1 for t in lower)])
    inside = letters()[cp]
    inside[(cp >= 48) & (cp <= 57)] = True
    step = np.diff(inside.astype(np.int8), prepend=0, append=0)
    start, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    text_at = np.searchsorted(start, edges)
    if not len(start):
        none = np.empty(0, np.int64)
        return Words(none.astype(np.uint64), none, np.zeros(1, np.int64), none, text_at)
    size = end - start
    at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)  # place in the word
    own = cp[np.repeat(start, size) + at].astype(np.uint64)
    first = np.cumsum(size) - size
    with np.errstate(over="ignore"):
        key = mix(np.add.reduceat((own + np.uint64(1)) * _POWERS[at & 255], first))
    key, sample, which = np.unique(key, return_index=True, return_inverse=True)
    count = size[sample]
    pair_at = np.concatenate(([0], np.cumsum(count)))
    place = np.arange(pair_at[-1]) - np.repeat(pair_at[:-1], count)
    here = np.repeat(first[sample], count) + place
    before = np.where(place > 0, own[np.maximum(here - 1, 0)], np.uint64(0))
    with np.errstate(over="ignore"):
        pair = mix(before * np.uint64(0x1F35BD) + own[here] + np.uint64(7)) >> np.uint64(64 - PAIR_BITS)
    return Words(key, pair.astype(np.int64), pair_at, which.reshape(-1), text_at)


def windows(text_at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word, words) of all overlapping windows, none for a text without a word."""
    n = np.diff(text_at)
    k = np.where(n > 0, 1 + np.maximum(0, -(-(n - WINDOW) // STRIDE)), 0)
    text = np.repeat(np.arange(len(n)), k)
    begin = (np.arange(len(text)) - np.repeat(np.cumsum(k) - k, k)) * STRIDE
    return text, text_at[text] + begin, np.minimum(WINDOW, n[text] - begin)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Network:
    known: np.ndarray  # keys of the words with an embedding, rising
    words: np.ndarray  # one row for each, and one of zeros
    pairs: np.ndarray
    p: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def new(cls, known: np.ndarray, seed: int) -> Network:
        r = np.random.default_rng(seed)
        draw = lambda *s, scale=1.0: (r.normal(0, scale, s)).astype(np.float32)
        dim = WORD_DIM + PAIR_DIM
        p = {}
        for d in "fb":
            p |= {f"W{d}": draw(dim, 3 * HIDDEN, scale=dim**-0.5), f"U{d}": draw(HIDDEN, 3 * HIDDEN, scale=HIDDEN**-0.5), f"g{d}": np.zeros(3 * HIDDEN, np.float32)}
        p |= {"A": draw(2 * HIDDEN, 2 * HIDDEN, scale=0.3), "a": np.zeros(2 * HIDDEN, np.float32), "v": draw(2 * HIDDEN, scale=0.3), "w": draw(2 * HIDDEN, scale=0.3), "c": np.zeros(1, np.float32)}
        words = np.vstack([draw(len(known), WORD_DIM, scale=0.1), np.zeros((1, WORD_DIM), np.float32)])
        return cls(known, words, draw(1 << PAIR_BITS, PAIR_DIM, scale=0.1), p)

    def rows(self, key: np.ndarray) -> np.ndarray:
        """Row of each word's embedding; that of zeros for unknown ones."""
        if not len(self.known):
            return np.zeros(len(key), np.int64)
        at = np.minimum(np.searchsorted(self.known, key), len(self.known) - 1)
        return np.where(self.known[at] == key, at, len(self.known))

    def inputs(self, words: Words) -> np.ndarray:
        """Input vector of each distinct word."""
        if not len(words.key):
            return np.zeros((0, WORD_DIM + PAIR_DIM), np.float32)
        sums = np.add.reduceat(self.pairs[words.pair], words.pair_at[:-1], axis=0)
        return np.hstack([self.words[self.rows(words.key)], sums / np.diff(words.pair_at)[:, None].astype(np.float32)])

    def _read(self, gates: np.ndarray, seen: np.ndarray, live: np.ndarray, d: str, tape: list | None) -> np.ndarray:
        """States after each word of windows sorted by falling length."""
        h, u = HIDDEN, self.p[f"U{d}"]
        state = np.zeros((len(seen), h), np.float32)
        out = np.zeros((len(seen), seen.shape[1], h), np.float32)
        for t in range(seen.shape[1])[:: 1 if d == "f" else -1]:
            n = live[t]
            g, before = gates[seen[:n, t]], state[:n]
            m = before @ u
            zr = _sigmoid(g[:, : 2 * h] + m[:, : 2 * h])
            z, r, un = zr[:, :h], zr[:, h:], m[:, 2 * h :]
            new = np.tanh(g[:, 2 * h :] + r * un)
            after = new + z * (before - new)
            if tape is not None:
                tape.append((t, n, before.copy(), z, r, un, new))
            state[:n] = after
            out[:n, t] = after
        return out

    def forward(self, x: np.ndarray, seen: np.ndarray, size: np.ndarray, tape: dict | None = None) -> np.ndarray:
        """Logit of each window; ``seen`` has distinct words, windows by falling size."""
        live = (size[:, None] > np.arange(seen.shape[1])).sum(axis=0)
        tapes = {"f": [], "b": []} if tape is not None else {"f": None, "b": None}
        both = np.concatenate([self._read(x @ self.p[f"W{d}"] + self.p[f"g{d}"], seen, live, d, tapes[d]) for d in "fb"], axis=2)
        e = np.tanh(both @ self.p["A"] + self.p["a"])
        s = e @ self.p["v"]
        s[np.arange(seen.shape[1]) >= size[:, None]] = -1e9
        s = np.exp(s - s.max(axis=1, keepdims=True))
        s /= s.sum(axis=1, keepdims=True)
        pooled = np.einsum("bt,bth->bh", s, both)
        if tape is not None:
            tape |= {"live": live, "tapes": tapes, "both": both, "e": e, "s": s, "pooled": pooled}
        return pooled @ self.p["w"] + self.p["c"][0]

    def backward(self, x: np.ndarray, seen: np.ndarray, tape: dict, dlogit: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Gradients of the parameters, and of each distinct word's input."""
        p, h, grad = self.p, HIDDEN, {}
        both, e, s = tape["both"], tape["e"], tape["s"]
        grad["w"], grad["c"] = tape["pooled"].T @ dlogit, dlogit.sum(keepdims=True)
        dpool = dlogit[:, None] * p["w"]
        ds = np.einsum("bh,bth->bt", dpool, both)
        ds = s * (ds - (s * ds).sum(axis=1, keepdims=True))
        grad["v"] = np.einsum("bt,bth->h", ds, e)
        de = ds[:, :, None] * p["v"] * (1 - e * e)
        grad["A"] = np.einsum("bth,btk->hk", both, de)
        grad["a"] = de.sum(axis=(0, 1))
        dboth = s[:, :, None] * dpool[:, None, :] + de @ p["A"].T
        dx = np.zeros_like(x)
        for k, d in enumerate("fb"):
            u, dout = p[f"U{d}"], dboth[:, :, k * h : (k + 1) * h]
            du, dgates = np.zeros_like(u), np.zeros((len(x), 3 * h), np.float32)
            dstate = np.zeros((len(seen), h), np.float32)
            at, back = [], []
            for t, n, before, z, r, un, new in reversed(tape["tapes"][d]):
                dh = dstate[:n] + dout[:n, t]
                dnew = dh * (1 - z) * (1 - new * new)
                dz = dh * (before - new) * z * (1 - z)
                dr = dnew * un * r * (1 - r)
                dm = np.concatenate([dz, dr, dnew * r], axis=1)
                du += before.T @ dm
                at.append(seen[:n, t])
                back.append(np.concatenate([dz, dr, dnew], axis=1))
                dstate[:n] = dh * z + dm @ u.T
            np.add.at(dgates, np.concatenate(at), np.concatenate(back))
            grad[f"U{d}"], grad[f"W{d}"], grad[f"g{d}"] = du, x.T @ dgates, dgates.sum(axis=0)
            dx += dgates @ p[f"W{d}"].T
        return grad, dx


def _laid_out(words: Words, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order by falling size, distinct words of each window, sizes)."""
    order = np.argsort(-size, kind="stable")
    begin, size = begin[order], size[order]
    place = begin[:, None] + np.arange(int(size[0]))
    return order, words.which[np.minimum(place, len(words.which) - 1)], size


@dataclass
class Model:
    network: Network | None
    scale: np.ndarray  # of the worst window's logit, the log of the windows, and 1
    share: float  # of toxic texts

    def worst(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Logit of each text's worst window (-inf without one), and how many it has."""
        words = read_words(texts)
        text, begin, size = windows(words.text_at)
        logit = np.empty(len(text), np.float32)
        x = self.network.inputs(words)
        for a in range(0, len(text), 4096):
            order, seen, n = _laid_out(words, begin[a : a + 4096], size[a : a + 4096])
            logit[a + order] = self.network.forward(x, seen, n)
        out = np.full(len(texts), -np.inf)
        np.maximum.at(out, text, logit)
        return out, np.bincount(text, minlength=len(texts))

    def score(self, texts: list[str | None]) -> np.ndarray:
        out = np.full(len(texts), self.share)
        if self.network is None:
            return out
        worst, count = np.full(len(texts), -np.inf), np.zeros(len(texts), np.int64)
        for a, b in text_runs(texts, 1 << 19):
            parts, owner = [], []
            for i in range(a, b):
                tail = ""
                for part in cut_text(texts[i] or "", 1 << 19):  # parts of a very long text share a window
                    parts.append(f"{tail} {part}" if tail else part)
                    owner.append(i)
                    tail = " ".join(part[-40 * WINDOW :].split()[-WINDOW:])
            w, n = self.worst(parts)
            np.maximum.at(worst, owner, w)
            np.add.at(count, owner, n)
        has = count > 0
        out[has] = _sigmoid(_platt(worst[has], count[has]) @ self.scale)
        return out


def _platt(worst: np.ndarray, count: np.ndarray) -> np.ndarray:
    return np.stack([np.clip(worst, -30, 30), np.log(count), np.ones(len(worst))], axis=1)


def _fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Newton's method with a small ridge."""
    b = np.array([1.0] + [0.0] * (x.shape[1] - 1))
    prior = b.copy()
    loss = lambda c: (weight * np.logaddexp(0, np.where(y > 0, -1, 1) * (x @ c))).sum() + ridge / 2 * ((c - prior) ** 2).sum()
    for _ in range(50):
        q = _sigmoid(x @ b)
        grad = x.T @ (weight * (q - y)) + ridge * (b - prior)
        hess = (x * (weight * q * (1 - q))[:, None]).T @ x + ridge * np.eye(len(b))
        step, now = np.linalg.solve(hess, grad), loss(b)
        while loss(b - step) > now and np.abs(step).max() > 1e-9:
            step /= 2
        b = b - step
        if np.abs(step).max() < 1e-6:
            break
    return b


def _read_in_runs(texts: list[str], most: int = 1 << 18) -> Words:
    """``read_words`` of all texts, with the characters of one run held at a time."""
    runs = [read_words(texts[a:b]) for a, b in text_runs(texts, most)] or [read_words([])]
    key, sample, number = np.unique(np.concatenate([r.key for r in runs]), return_index=True, return_inverse=True)
    number = np.split(number.reshape(-1).astype(np.int32), np.cumsum([len(r.key) for r in runs])[:-1])
    size = np.concatenate([np.diff(r.pair_at) for r in runs])
    first, count = (np.cumsum(size) - size)[sample], size[sample]
    pair_at = np.concatenate(([0], np.cumsum(count)))
    where = np.repeat(first - pair_at[:-1], count) + np.arange(pair_at[-1])
    text_at = np.concatenate(([0], np.cumsum(np.concatenate([np.diff(r.text_at) for r in runs]))))
    which = np.concatenate([n[r.which] for n, r in zip(number, runs)])
    return Words(key, np.concatenate([r.pair for r in runs])[where], pair_at, which, text_at)


def train(texts: list[str], toxic: np.ndarray, weight: np.ndarray | None = None, share: float | None = None, steps: int = 300, batch: int = 128, seed: int = 11) -> Model:
    """Fit the network on four texts in five, and the calibration on the fifth.

    ``weight`` says how many labelled texts each stands for; a step of Adam takes
    ``batch`` of all windows of the texts learned from, a quarter of them of toxic texts: what is as frequent in
    both kinds of text then looks harmless.
    """
    toxic = np.asarray(toxic, int)
    weight = np.ones(len(toxic)) if weight is None else np.asarray(weight, float)
    share = float(share if share is not None else (weight * toxic).sum() / max(weight.sum(), 1))
    if len(set(toxic.tolist())) < 2:
        return Model(None, np.zeros(3), share)
    rng = np.random.default_rng(seed)
    at_first = {t: i for i, t in reversed(list(enumerate(texts)))}
    first = np.isin(np.arange(len(texts)), list(at_first.values()))  # copies teach nothing more
    held = rng.random(len(texts)) < 0.2
    learned = np.flatnonzero(~held & first)
    words = _read_in_runs([texts[i] for i in learned])
    text, begin, size = windows(words.text_at)
    label = toxic[learned][text]
    sides = [np.flatnonzero(label == y) for y in (0, 1)]
    if not all(len(s) for s in sides):
        return Model(None, np.zeros(3), share)
    # words in several of the texts learned from get an embedding
    text_of = np.repeat(np.arange(len(learned)), np.diff(words.text_at))
    pairs = np.unique(words.which.astype(np.int64) * len(learned) + text_of) // len(learned)
    net = Network.new(words.key[np.bincount(pairs, minlength=len(words.key)) >= max(3, SEEN_IN * (~held).sum())], seed)
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    seen_g = np.zeros_like(net.words), np.zeros_like(net.pairs)  # Adagrad's sums, for the embeddings
    for step in range(1, steps + 1):
        pick = np.concatenate([rng.choice(sides[0], batch - batch // 4), rng.choice(sides[1], batch // 4)])
        order, seen, n = _laid_out(words, begin[pick], size[pick])
        y = label[pick][order]
        part, seen = np.unique(seen, return_inverse=True)  # only this batch's words
        seen = seen.reshape(len(n), -1)
        pair_n = np.diff(words.pair_at)[part]
        where = np.repeat(words.pair_at[part], pair_n) + np.arange(int(pair_n.sum())) - np.repeat(np.cumsum(pair_n) - pair_n, pair_n)
        few = Words(words.key[part], words.pair[where], np.concatenate(([0], np.cumsum(pair_n))), part, words.text_at)
        x = net.inputs(few)
        x[rng.random(len(x)) < DROP, :WORD_DIM] = 0  # so that no one window is known by its words
        tape: dict = {}
        logit = net.forward(x, seen, n, tape)
        p = _sigmoid(logit)
        right = np.where(y > 0, p, 1 - p) ** (TRUST if 2 * step > steps else 0)  # a label that looks wrong counts for little
        grad, dx = net.backward(x, seen, tape, (right * (p - y) / len(y)).astype(np.float32))
        rate = 0.01 * min(1, 2 * (1 - step / (steps + 1)))
        for k, g in grad.items():
            m, v = moment[k]
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            net.p[k] -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
        own = net.rows(few.key)
        real = own < len(net.known)
        back = np.zeros_like(net.pairs)
        np.add.at(back, few.pair, np.repeat(dx[:, WORD_DIM:] / pair_n[:, None], pair_n, axis=0))
        for table, squares, rows, g in ((net.words, seen_g[0], own[real], dx[real, :WORD_DIM]), (net.pairs, seen_g[1], np.unique(few.pair), None)):
            g = back[rows] if g is None else g
            squares[rows] += g * g
            table[rows] -= 5 * rate * g / np.sqrt(squares[rows] + 1e-12) + 0.002 * table[rows]
    model = Model(net, np.array([1.0, 0.0, 0.0]), share)
    worst, count = model.worst([t for t, h in zip(texts, held) if h])
    ok = count > 0
    if ok.any():
        model.scale = _fit_logistic(_platt(worst[ok], count[ok]), toxic[held][ok], weight[held][ok] / weight[held][ok].mean())
    return model


def fit(docs: DataFrame, labels: DataFrame, eligible: Column, text: str = "text", key: str = "doc_id", label: str = "toxic", sample_rows: int = 2_000, **options) -> Model:
    """Train on about ``sample_rows`` labelled rows that ``eligible`` (a condition
    on the key) admits, half of each class where there are so many: the keys with
    the smallest hashes, and of a key with several texts the one with the smallest.
    Of a text of more than 20,000 characters ten passages from all over it are
    learned from, which bounds what reaches the driver; whole texts are scored."""
    spark = docs.sparkSession
    known = labels.where(eligible & F.col(key).isNotNull() & F.col(label).isin(0, 1)).groupBy(F.col(key).alias("key")).agg(F.max(label).cast("int").alias("y"))
    count = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = by_hash(known, [F.col("key")], sample_rows, 0, "toxic", "y", {y: (sample_rows // 2, n) for y, n in count.items()})
    few = spark.createDataFrame([(r["key"], r["y"]) for r in chosen.collect()], known.schema)
    rows = docs.where(F.col(text).isNotNull()).select(F.col(key).alias("key"), F.col(text).alias("text")).join(F.broadcast(few), "key")
    one = rows.groupBy("key", "y").agg(F.min_by(passages(F.col("text")), F.xxhash64(F.lit("toxic"), "text")).alias("text"))
    got = one.toPandas().sort_values(["key", "text"])
    taken = got["y"].value_counts().to_dict()
    weight = got["y"].map({y: count[y] / n for y, n in taken.items()}).to_numpy(float)
    share = count.get(1, 0) / max(sum(count.values()), 1)
    return train(got["text"].tolist(), got["y"].to_numpy(int), weight, share, **options)


def toxicity(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """Score (0 to 1) of ``docs``' whole texts."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # hashed tables of fixed size

    @F.arrow_udf("double")
    def run(batch: pa.Array) -> pa.Array:
        return pa.array(shared.value.score(batch.to_pylist()))

    return run(F.col(text))
