"""A character tagger in numpy: bidirectional LSTM below a linear-chain CRF, trained from labelled spans.

The training texts are made here: invented words around invented personal data in many spellings, with look-alikes
(dates, versions, digests, prices, amounts) left unlabelled. Training is deterministic and takes seconds.
"""

from __future__ import annotations

from functools import cache

import numpy as np

KINDS = ("email", "ip", "card", "phone")
LABELS = len(KINDS) + 1  # 0 is outside

_SINGLES = ".@+-()_%\n\"=:/|,$#"
CLASSES = 5 + len(_SINGLES)
_CLASS = np.full(129, 4, np.int8)
_CLASS[48:58] = 0
_CLASS[97:123] = 1
_CLASS[65:91] = 2
_CLASS[128] = 3
for _k, _c in enumerate(_SINGLES):
    _CLASS[ord(_c)] = 5 + _k


def classes_of(text: str) -> np.ndarray:
    """Class of each code point: digit, small letter, capital, beyond ASCII, other, or one of a few signs."""
    return _CLASS[np.minimum(np.frombuffer(text.encode("utf-32-le"), np.uint32), 128)]


def labelled_texts(n: int, seed: int) -> list[tuple[str, list[tuple[str, int, int]]]]:
    rng = np.random.default_rng(seed)

    def letters(low: int, high: int) -> str:
        return "".join(rng.choice(list("aeinorstlhdu"), rng.integers(low, high + 1)))

    def digits(pattern: str) -> str:
        return "".join(str(rng.integers(0, 10)) if c == "0" else c for c in pattern)

    def pick(*options: str) -> str:
        return options[rng.integers(len(options))]

    def octets() -> str:
        return ".".join(str(rng.integers(0, 256)) for _ in range(4))

    makers = {
        "email": lambda: letters(2, 8)
        + pick("", ".", "_", "-", ".")
        + pick("", letters(1, 6), digits("00"), digits("0000"))
        + "@"
        + letters(2, 8)
        + pick("", digits("0"), "-" + letters(2, 4))
        + pick("", "." + letters(3, 8))
        + pick(".com", ".org", ".net", ".de", ".co.uk"),
        "ip": octets,
        "card": lambda: digits(
            pick("0" * 16, "0" * 16, "0000 0000 0000 0000", "0000-0000-0000-0000", "0000 000000 00000", "0" * 15, "0" * 19)
        ),
        "phone": lambda: digits(
            pick("+0 (000) 000-0000", "+00 000 0000 000", "(000) 000-0000", "000-000-0000", "+0-000-000-0000", "+00 00 00000000")
        ),
        "": lambda: pick(
            digits("2000-00-00"),
            digits("0.0"),
            digits("0.0.0"),
            digits("$0,000.00"),
            digits("00:00"),
            digits("0000"),
            digits("000"),
            digits("0000000000"),
            digits("0" * 24),
            "".join(rng.choice(list("0123456789abcdef"), 40)),
            "@" + letters(3, 9),
            letters(3, 6) + digits("00"),
            digits("00%"),
            digits("0000/00"),
            digits("0-0"),
        ),
    }
    kinds = [*KINDS, "", ""]
    out = []
    for _ in range(n):
        text, spans = "", []
        for _ in range(rng.integers(3, 7)):
            for _ in range(rng.integers(0, 4)):
                word = letters(1, 9)
                word = word.capitalize() if rng.random() < 0.15 else word
                word = word.replace("o", "é") if rng.random() < 0.2 else word
                text += word + pick(" ", " ", " ", ", ", ". ", "\n", " | ")
            kind = kinds[rng.integers(len(kinds))]
            before, after = pick(("", ""), ("", ""), ('"', '"'), ("(", ")"), ("", "."), ("", ","), ("= ", ""), (": ", ""))
            text += before
            value = makers[kind]()
            if kind:
                spans.append((kind, len(text), len(text) + len(value)))
            text += value + after + pick(" ", " ", "\n")
        out.append((text, spans))
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis)) + np.squeeze(top, axis)


class Tagger:
    """Weights for both directions are stacked on a first axis of two; the second reads backwards."""

    def __init__(self, hidden: int = 16, seed: int = 1):
        rng = np.random.default_rng(seed)
        f = np.float32
        self.hidden = hidden
        self.w = {
            "x": rng.normal(0, 0.3, (2, CLASSES, 4 * hidden)).astype(f),
            "h": rng.normal(0, 0.25, (2, hidden, 4 * hidden)).astype(f),
            "o": rng.normal(0, 0.3, (2 * hidden, LABELS)).astype(f),
            "b": np.zeros(LABELS, f),
            "t": np.zeros((LABELS, LABELS), f),
        }
        self.w["x"][:, :, hidden : 2 * hidden] += 1.0  # gates forget little at first

    def _run(self, x: np.ndarray, keep: bool):
        """x (texts, places) of classes -> hidden states (2, places, texts, hidden), each direction in its own order."""
        n, size = x.shape
        both = np.stack([x.T, x.T[::-1]])
        inputs = self.w["x"]
        h = np.zeros((2, n, self.hidden), np.float32)
        c = np.zeros_like(h)
        hs = np.empty((2, size, n, self.hidden), np.float32)
        trace = []
        for t in range(size):
            z = h @ self.w["h"]
            z[0] += inputs[0][both[0, t]]
            z[1] += inputs[1][both[1, t]]
            i, f, g, o = np.split(z, 4, axis=2)
            i, f, g, o = _sigmoid(i), _sigmoid(f), np.tanh(g), _sigmoid(o)
            last_h, last_c = h, c
            c = f * c + i * g
            s = np.tanh(c)
            h = o * s
            hs[:, t] = h
            if keep:
                trace.append((i, f, g, o, last_c, s, last_h))
        return both, hs, trace

    def emissions(self, x: np.ndarray) -> np.ndarray:
        _, hs, _ = self._run(x, False)
        return self._out(hs)

    def _out(self, hs: np.ndarray) -> np.ndarray:
        return np.concatenate([hs[0], hs[1][::-1]], axis=2) @ self.w["o"] + self.w["b"]  # (places, texts, labels)

    def marginals(self, e: np.ndarray):
        """(forward, backward, log partition) of the chain over emissions e."""
        t = self.w["t"]
        a, b = np.empty_like(e), np.zeros_like(e)
        a[0] = e[0]
        for k in range(1, len(e)):
            a[k] = _logsumexp(a[k - 1][:, :, None] + t, 1) + e[k]
        for k in range(len(e) - 2, -1, -1):
            b[k] = _logsumexp((e[k + 1] + b[k + 1])[:, None, :] + t, 2)
        return a, b, _logsumexp(a[-1], 1)

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best label path and the marginal probability of its labels, both (texts, places)."""
        e = self.emissions(x)
        size, n, _ = e.shape
        score, back = e[0], np.empty((size, n, LABELS), np.int8)
        for k in range(1, size):
            ways = score[:, :, None] + self.w["t"]
            back[k] = ways.argmax(1)
            score = ways.max(1) + e[k]
        path = np.empty((size, n), np.int64)
        path[-1] = score.argmax(1)
        for k in range(size - 1, 0, -1):
            path[k - 1] = back[k][np.arange(n), path[k]]
        a, b, z = self.marginals(e)
        p = np.exp(np.minimum(a + b - z[:, None], 0))
        return path.T, np.take_along_axis(p, path[:, :, None], 2)[:, :, 0].T

    def gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean negative log likelihood of the label paths y (texts, places)."""
        n, size = x.shape
        both, hs, trace = self._run(x, True)
        e = self._out(hs)
        a, b, z = self.marginals(e)
        de = np.exp(a + b - z[:, None])
        dt = np.zeros_like(self.w["t"])
        for k in range(1, size):
            dt += np.exp(a[k - 1][:, :, None] + self.w["t"] + (e[k] + b[k])[:, None, :] - z[:, None, None]).sum(0)
        np.subtract.at(dt, (y[:, :-1].ravel(), y[:, 1:].ravel()), 1)
        de -= np.eye(LABELS, dtype=np.float32)[y.T]
        de /= n
        states = np.concatenate([hs[0], hs[1][::-1]], axis=2)
        g = {
            "t": dt / n,
            "b": de.sum((0, 1)),
            "o": np.einsum("tnh,tnl->hl", states, de),
            "x": np.zeros_like(self.w["x"]),
            "h": np.zeros_like(self.w["h"]),
        }
        ds = de @ self.w["o"].T
        ds = np.stack([ds[:, :, : self.hidden], ds[::-1, :, self.hidden :]])
        dh = np.zeros((2, n, self.hidden), np.float32)
        dc = np.zeros_like(dh)
        turned = self.w["h"].transpose(0, 2, 1)
        for t in range(size - 1, -1, -1):
            i, f, gg, o, last_c, s, last_h = trace[t]
            dh = dh + ds[:, t]
            dc = dc + dh * o * (1 - s * s)
            dz = np.concatenate(
                [dc * gg * i * (1 - i), dc * last_c * f * (1 - f), dc * i * (1 - gg * gg), dh * s * o * (1 - o)], axis=2
            )
            for d in range(2):
                np.add.at(g["x"][d], both[d, t], dz[d])
            g["h"] += last_h.transpose(0, 2, 1) @ dz
            dh, dc = dz @ turned, dc * f
        return g


def examples(texts, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows of `size` places with their labels; the texts' ends are filled with line breaks."""
    xs, ys = [], []
    for text, spans in texts:
        label = np.zeros(len(text), np.int64)
        for kind, start, end in spans:
            label[start:end] = KINDS.index(kind) + 1
        x = classes_of(text)
        for low in range(0, len(x), size):
            fill = size - len(x[low : low + size])
            xs.append(np.r_[x[low : low + size], np.full(fill, _CLASS[10])])
            ys.append(np.r_[label[low : low + size], np.zeros(fill, np.int64)])
    return np.array(xs), np.array(ys)


@cache
def trained(steps: int = 360, batch: int = 48, size: int = 72, seed: int = 7) -> Tagger:
    """A tagger fitted by Adam on made texts (a bounded sample: at most steps * batch windows)."""
    x, y = examples(labelled_texts(2500, seed), size)
    rng = np.random.default_rng(seed)
    tagger = Tagger()
    m = {k: np.zeros_like(v) for k, v in tagger.w.items()}
    v = {k: np.zeros_like(w) for k, w in tagger.w.items()}
    for step in range(1, steps + 1):
        at = rng.integers(0, len(x), batch)
        g = tagger.gradients(x[at], y[at])
        norm = np.sqrt(sum(float((d * d).sum()) for d in g.values()))
        rate = 0.03 * min(1.0, 2.0 * (1 - step / (steps + 1)))
        for k, d in g.items():
            d = d * min(1.0, 5.0 / (norm + 1e-9))
            m[k] += 0.1 * (d - m[k])
            v[k] += 0.01 * (d * d - v[k])
            tagger.w[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)
    return tagger
