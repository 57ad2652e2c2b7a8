"""Personal data: base patterns, and a character-level bidirectional LSTM with CRF transitions in numpy.

The model is trained on windows around labelled spans: those of the base patterns in a bounded sample of documents,
with variants of them that the patterns miss (phone numbers without +, grouped card numbers, spelt-out at signs).
Texts are cut into overlapping windows on a fixed grid; each is decoded by Viterbi; complete spans of all windows of a
text are reconciled together: base spans stay, longer spans go before shorter ones, none overlap.

A span that the model adds must be possible for its kind: digits that pass Luhn's check for a card, parts up to 255 for
an ip, 9 to 15 digits for a phone, and for an e-mail a name, an at (sign or spelt out) and a domain with a dot. So every
span holds a digit, an at sign or a spelt-out at before a domain, and windows without any of these are not run through
the network: whatever it gave there would be dropped.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_bytes, smallest_hashes, text_bytes

KINDS = ("email", "ip", "card", "phone")
TAGS = 1 + 2 * len(KINDS)  # 0: none; 1 + 2k: first character of kind k; 2 + 2k: inside it
SYMBOLS = 130  # ASCII, other characters, padding
OTHER, PAD = 128, 129
WINDOW, STRIDE = 96, 48
#: Documents with base spans that training windows come from (smallest hash of doc_id), and windows of each.
SAMPLE_DOCS, WINDOWS_EACH = 1500, 3
DECODED = 2048  # windows run at once

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_HINT = np.zeros(256, bool)
_HINT[[*range(48, 58), 64]] = True
_EMAIL = re.compile(r"(?is)[A-Z0-9._%+-]+\W{0,3}(@|at)\W{0,3}[A-Z0-9.-]+\.[A-Z0-9-]+")
#: In every text that holds an e-mail with a spelt-out at.
_SPELT = re.compile(r"(?is)[A-Z0-9._%+-]\W{0,3}at\W{0,3}[A-Z0-9.-]+\.[A-Z0-9-]")
#: What may follow the dot of a domain: letters, digits, hyphens, and other characters, some of which fold to letters.
_AFTER_DOT = np.zeros(256, bool)
_AFTER_DOT[[*range(48, 58), *range(65, 91), *range(97, 123), 45, *range(128, 256)]] = True


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base patterns, leftmost and without overlap within a kind, by kind and start.

    E-mails are found from their at sign, which no local part holds: the local part is the run before it, back to the
    end of the match before. The other patterns use possessive repeats; what these give up can never match."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            done = found.end()
            out.append((0, start, done))
        at = text.find("@", max(at + 1, done))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-3:] if not p.lstrip("0") else p.lstrip("0")) <= 255 for p in m[0].split(".")):
            out.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((3, m.start(), m.end()))
    return out


# ----------------------------------------------------------------------- model

@dataclass
class Tagger:
    """One LSTM in each direction over characters, a linear layer over both states, and CRF transitions."""
    params: dict[str, np.ndarray]

    def states(self, x: np.ndarray, side: str, cache: list | None = None) -> np.ndarray:
        """Hidden states (time, windows, hidden) of character codes (time, windows)."""
        table, u = self.params["w" + side], self.params["u" + side]
        hidden = u.shape[0]
        h, c = np.zeros((2, x.shape[1], hidden), np.float32)
        out = np.empty((*x.shape, hidden), np.float32)
        for t in range(len(x)) if side == "f" else range(len(x) - 1, -1, -1):
            z = table[x[t]] + h @ u
            gates = 1 / (1 + np.exp(-z[:, : 3 * hidden]))
            new = np.tanh(z[:, 3 * hidden:])
            i, f, o = gates[:, :hidden], gates[:, hidden: 2 * hidden], gates[:, 2 * hidden:]
            before, h_before = c, h
            c = f * c + i * new
            th = np.tanh(c)
            h = o * th
            out[t] = h
            if cache is not None:
                cache.append((t, i, f, o, new, before, th, h_before))
        return out

    def emissions(self, x: np.ndarray, caches=(None, None)) -> tuple[np.ndarray, np.ndarray]:
        h = np.concatenate([self.states(x, s, c) for s, c in zip("fb", caches)], 2)
        return h @ self.params["v"] + self.params["bias"], h

    def decode(self, x: np.ndarray) -> np.ndarray:
        """Best tags (time, windows) by Viterbi."""
        e, _ = self.emissions(x)
        step = self.params["trans"] + LEGAL
        score = e[0] + self.params["first"] + FIRST
        back = np.empty((len(x), x.shape[1], TAGS), np.int8)
        for t in range(1, len(x)):
            paths = score[:, :, None] + step
            back[t] = paths.argmax(1)
            score = paths.max(1) + e[t]
        tags = np.empty(x.shape, np.int8)
        tags[-1] = score.argmax(1)
        rows = np.arange(x.shape[1])
        for t in range(len(x) - 1, 0, -1):
            tags[t - 1] = back[t, rows, tags[t]]
        return tags


def _legal() -> tuple[np.ndarray, np.ndarray]:
    """Inside tags follow only the first or inside tag of their kind."""
    step, first = np.zeros((TAGS, TAGS), np.float32), np.zeros(TAGS, np.float32)
    for k in range(len(KINDS)):
        step[:, 2 + 2 * k] = -1e4
        step[[1 + 2 * k, 2 + 2 * k], 2 + 2 * k] = 0
        first[2 + 2 * k] = -1e4
    return step, first


LEGAL, FIRST = _legal()


def codes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.minimum(points, OTHER).astype(np.int16)


def _log_sum(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis, keepdims=True)
    return (np.log(np.exp(a - top).sum(axis, keepdims=True)) + top).squeeze(axis)


def crf_gradient(e, y, trans, first):
    """Negative log likelihood a character, and its gradients by emissions, transitions and first scores."""
    n, width, _ = e.shape
    step, start = trans + LEGAL, first + FIRST
    alpha, beta = np.empty_like(e), np.zeros_like(e)
    alpha[0] = e[0] + start
    for t in range(1, n):
        alpha[t] = _log_sum(alpha[t - 1][:, :, None] + step, 1) + e[t]
    for t in range(n - 2, -1, -1):
        beta[t] = _log_sum(step + (e[t + 1] + beta[t + 1])[:, None, :], 2)
    z = _log_sum(alpha[-1], 1)
    de = np.exp(alpha + beta - z[None, :, None])
    dtrans = np.zeros_like(trans)
    rows, gold = np.arange(width), np.zeros(width, e.dtype)
    for t in range(n):
        gold += e[t, rows, y[t]] + (start[y[0]] if t == 0 else step[y[t - 1], y[t]])
        if t:
            both = alpha[t - 1][:, :, None] + step + (e[t] + beta[t])[:, None, :] - z[:, None, None]
            dtrans += np.exp(both).sum(0)
            np.add.at(dtrans, (y[t - 1], y[t]), -1)
        de[t, rows, y[t]] -= 1
    scale = 1 / (n * width)
    return float((z - gold).sum() * scale), de * scale, dtrans * scale, de[0].sum(0) * scale


def gradients(tagger: Tagger, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    p, caches = tagger.params, ([], [])
    e, h = tagger.emissions(x, caches)
    loss, de, dtrans, dfirst = crf_gradient(e, y, p["trans"], p["first"])
    g = {"trans": dtrans, "first": dfirst, "bias": de.sum((0, 1)), "v": np.einsum("tbh,tbk->hk", h, de)}
    dh_all = de @ p["v"].T
    hidden = p["uf"].shape[0]
    for s, (side, cache) in enumerate(zip("fb", caches)):
        table, u = np.zeros_like(p["w" + side]), np.zeros_like(p["u" + side])
        dh, dc = np.zeros((2, x.shape[1], hidden), np.float32)
        for t, i, f, o, new, before, th, h_before in reversed(cache):
            dh = dh + dh_all[t, :, s * hidden: (s + 1) * hidden]
            dc = dc + dh * o * (1 - th * th)
            dz = np.concatenate([dc * new * i * (1 - i), dc * before * f * (1 - f), dh * th * o * (1 - o),
                                 dc * i * (1 - new * new)], 1)
            np.add.at(table, x[t], dz)
            u += h_before.T @ dz
            dh, dc = dz @ p["u" + side].T, dc * f
        g["w" + side], g["u" + side] = table, u
    return loss, g


def train(x: np.ndarray, y: np.ndarray, hidden: int = 20, steps: int = 220, batch: int = 96, seed: int = 5) -> Tagger:
    """Fit by Adam to windows x (windows, time) with tags y."""
    rng = np.random.default_rng(seed)
    p = {f"w{s}": rng.normal(0, 0.3, (SYMBOLS, 4 * hidden)).astype(np.float32) for s in "fb"}
    p |= {f"u{s}": rng.normal(0, 0.2, (hidden, 4 * hidden)).astype(np.float32) for s in "fb"}
    p |= {"v": rng.normal(0, 0.2, (2 * hidden, TAGS)).astype(np.float32), "bias": np.zeros(TAGS, np.float32),
          "trans": np.zeros((TAGS, TAGS), np.float32), "first": np.zeros(TAGS, np.float32)}
    for s in "fb":
        p["w" + s][:, hidden: 2 * hidden] += 1  # remember at first
    tagger = Tagger(p)
    one, two = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    order = np.zeros(0, np.int64)
    for step in range(1, steps + 1):
        if len(order) < batch:
            order = np.concatenate([order, rng.permutation(len(x))])
        take, order = order[:batch], order[batch:]
        _, g = gradients(tagger, x[take].T, y[take].T)
        norm = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
        rate = 0.03 * min(1, 2 * (1 - step / (steps + 1)))
        for k, v in g.items():
            v = v * min(1.0, 1.0 / (norm + 1e-8))
            one[k] = 0.9 * one[k] + 0.1 * v
            two[k] = 0.99 * two[k] + 0.01 * v * v
            p[k] -= (rate * one[k] / (1 - 0.9 ** step) / (np.sqrt(two[k] / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)
    return tagger


# ------------------------------------------------------------------- training

def _variant(kind: int, span: str, rng) -> str:
    """A form of a labelled span that the base patterns need not match."""
    if kind == 0:
        return span.replace("@", [" at ", " (at) ", "[at]"][rng.integers(3)])
    if kind == 2:
        digits = re.sub(r"\D", "", span)
        return [".", "  ", "/", "_"][rng.integers(4)].join(digits[i: i + 4] for i in range(0, len(digits), 4))
    if kind == 3:
        digits = re.sub(r"\D", "", span)[-10:]
        return [f"({digits[:3]}) {digits[3:6]}-{digits[6:]}", f"{digits[:3]}-{digits[3:6]}-{digits[6:]}",
                f"{digits[:3]}.{digits[3:6]}.{digits[6:]}"][rng.integers(3)]
    return span


def training_windows(rows: list[tuple[str, list]], seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Windows and tags from (text, base spans): every span as it is, once more as a variant, and windows of the
    same texts without spans but with digits of other kinds left in."""
    rng = np.random.default_rng(seed)
    xs, ys = [], []

    def add(text: str, spans: list, centre: int) -> None:
        lo = max(0, centre - int(rng.integers(8, WINDOW - 8)))
        x = np.full(WINDOW, PAD, np.int16)
        y = np.zeros(WINDOW, np.int64)
        own = codes(text[lo: lo + WINDOW])
        x[: len(own)] = own
        for kind, s, e in spans:
            a, b = max(s - lo, 0), min(e - lo, WINDOW)
            if s >= lo and a < b:
                y[a:b] = 2 + 2 * kind
                y[a] -= 1
            elif b > 0 and a < b:
                x[a:b] = ord("a")  # a span cut at the left edge is seen whole by another window
        xs.append(x)
        ys.append(y)
    for text, spans in rows:
        taken, flat = 0, []
        for span in sorted(spans, key=lambda s: (s[1], -s[2])):  # spans of different kinds may overlap
            if span[1] >= taken:
                flat.append(span)
                taken = span[2]
        for kind, s, e in flat[:WINDOWS_EACH]:
            add(text, flat, (s + e) // 2)
            other = _variant(kind, text[s:e], rng)
            lo, hi = max(0, s - WINDOW), e + WINDOW
            near = [(k, a - lo + (len(other) - e + s) * (a >= e), b - lo + (len(other) - e + s) * (a >= e))
                    for k, a, b in flat if lo <= a and b <= hi and (a, b) != (s, e)]
            add(text[lo:s] + other + text[e:hi], [*near, (kind, s - lo, s - lo + len(other))], s - lo + len(other) // 2)
            number = "".join(map(str, rng.integers(0, 10, int(rng.integers(1, 8)))))
            add(text[lo:s] + number + text[e:hi], near and [
                (k, a + (len(number) - len(other)) * (a >= s - lo), b + (len(number) - len(other)) * (a >= s - lo)) for k, a, b in near],
                s - lo)
    return (np.stack(xs), np.stack(ys)) if xs else (np.zeros((0, WINDOW), np.int16), np.zeros((0, WINDOW), np.int64))


def fit(docs: DataFrame, sample: int = SAMPLE_DOCS, **options) -> Tagger | None:
    """The tagger from the ``sample`` documents with base spans whose doc_id hashes smallest; null if none has any.
    Only the surroundings of each document's first spans come to the driver."""
    def work(batches):
        for batch in by_bytes(batches, "text"):
            for doc, text in zip(batch.column("doc_id").to_pylist(), _hinted(batch)):
                spans = base_spans(text) if text else []
                if spans:
                    spans = sorted(spans, key=lambda s: s[1])[:WINDOWS_EACH]
                    lo, hi = max(0, spans[0][1] - WINDOW), spans[0][1] + 8 * WINDOW
                    yield pa.RecordBatch.from_pydict({"doc_id": [doc], "text": [text[lo:hi]]})
    found = lambda df: df.mapInArrow(work, "doc_id long, text string")
    rows = smallest_hashes(docs.select("doc_id", "text"), "doc_id", sample, 30, found).collect()
    x, y = training_windows([(r["text"], base_spans(r["text"])) for r in rows])
    return train(x, y, **options) if len(x) else None


def _hinted(batch: pa.RecordBatch) -> list[str | None]:
    """The texts of a batch, null where there is no digit, no at sign, and no spelt-out at with a dot as in domains."""
    data, bounds = text_bytes(batch.column("text"))
    sign, at, dot = (np.concatenate([[0], np.cumsum(x)]) for x in (_HINT[data], *_spelt(data)))
    live = np.zeros(len(bounds) - 1, bool)
    for hits in ((sign,), (at, dot)):
        live |= np.all([h[bounds[1:]] > h[bounds[:-1]] for h in hits], 0)
    column = batch.column("text")
    return [column[i].as_py() if n else None for i, n in enumerate(live.tolist())]


def _spelt(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where ``data``, bytes or codes, has an at in letters, and where a dot that a domain can go on after."""
    low, at, dot = data | 32, np.zeros(len(data), bool), np.zeros(len(data), bool)
    at[:-1] = (low[:-1] == 97) & (low[1:] == 116)
    dot[:-1] = (data[:-1] == 46) & _AFTER_DOT[data[1:]]
    return at, dot


# -------------------------------------------------------------------- decoding

def window_starts(n: int) -> np.ndarray:
    return np.arange(0, max(1, n - (WINDOW - STRIDE)), STRIDE)


def model_spans(tagger: Tagger, texts: list[str], gate: bool = True) -> list[list[tuple[int, int, int]]]:
    """For each text, the complete spans of its windows: those that touch no window edge but an edge of the text."""
    out: list[list] = [[] for _ in texts]
    jobs, held = [], []

    def run() -> None:
        tags = tagger.decode(np.stack(held).T).T
        for (i, lo, n), row in zip(jobs, tags):
            at = 0
            while at < WINDOW:
                if row[at] % 2 == 1:
                    end = at + 1
                    while end < WINDOW and row[end] == row[at] + 1:
                        end += 1
                    if (at > 0 or lo == 0) and (end < WINDOW or lo + end == n) and lo + end <= n:
                        out[i].append((int(row[at]) // 2, lo + at, lo + end))
                    at = end
                else:
                    at += 1
        jobs.clear()
        held.clear()
    for i, text in enumerate(texts):
        own = codes(text)
        hint, at, dot = (np.concatenate([[0], np.cumsum(x)]) for x in (_HINT[own], *_spelt(own)))
        for lo in window_starts(len(own)).tolist():
            hi = min(lo + WINDOW, len(own))
            if gate and hint[hi] == hint[lo] and not (
                    at[hi] > at[lo] and dot[hi] > dot[lo] and _SPELT.search(text, lo, hi)):
                continue
            x = np.full(WINDOW, PAD, np.int16)
            x[: hi - lo] = own[lo:hi]
            jobs.append((i, lo, len(own)))
            held.append(x)
            if len(held) == DECODED:
                run()
    if held:
        run()
    return out


def possible(kind: int, span: str) -> bool:
    """Whether a span of the model can be of its kind; all need a digit, an at sign or a spelt-out at."""
    digits = re.sub("[^0-9]", "", span)
    if kind == 0:
        return bool(_EMAIL.fullmatch(span))
    if kind == 1:
        parts = re.findall("[0-9]+", span)
        return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == 2:
        return 13 <= len(digits) <= 19 and luhn(digits)
    return 9 <= len(digits) <= 15


def reconcile(text: str, base: list, found: list) -> list[tuple[int, int, int]]:
    """Base spans, and those of the model that are possible and overlap no other: longer ones first, then the leftmost,
    then by kind. By kind and start."""
    taken = np.zeros(len(text) + 1, bool)
    for _, s, e in base:
        taken[s:e] = True
    out = list(base)
    for kind, s, e in sorted(set(found), key=lambda x: (x[1] - x[2], x[1], x[0])):
        if not taken[s:e].any() and possible(kind, text[s:e]):
            taken[s:e] = True
            out.append((kind, s, e))
    return sorted(out)


def named(spans: list) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


def masked(text: str, spans: list) -> str:
    """``text`` with each maximal stretch of overlapping spans replaced by the kind of its first, in angle brackets."""
    parts, at = [], 0
    for kind, s, e in sorted(spans, key=lambda x: (x[1], -x[2], x[0])):
        if s >= at:
            parts += [text[at:s], f"<{KINDS[kind].upper()}>"]
        at = max(at, e)
    return "".join(parts) + text[at:]


RESULT = ", ".join(["doc_id long", *[f"n_{k} long" for k in KINDS], "base_sha256 string", "spans string"])


def detect(docs: DataFrame, tagger: Tagger | None = None, mask: bool = False, carry: list[str] | None = None,
           **options) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) for each row of ``docs`` (doc_id, text), with
    ``mask`` the text with its spans replaced, ``masked``, and the columns that ``carry`` names as they are.

    The counts and base_sha256 are of the base spans; spans lists these and what the model adds, as kind:start:end in
    code points, by kind and start, joined by commas. ``tagger`` is fitted on ``docs`` unless given; without a base span
    in any document there is no model.

    A null text is empty and is masked as null. Null doc_ids and repeated rows are each returned. Other columns are
    ignored; an empty table gives an empty result."""
    carry = carry or []
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *carry)
    tagger = tagger or fit(docs, **options)
    nothing = hashlib.sha256(b"").hexdigest()
    names = [x.split()[0] for x in RESULT.split(", ")]

    def work(batches):
        for batch in by_bytes(batches, "text"):
            texts = _hinted(batch)
            live = [i for i, t in enumerate(texts) if t is not None]
            extra = dict(zip(live, model_spans(tagger, [texts[i] for i in live]))) if tagger and live else {}
            counts = [[0] * len(KINDS) for _ in texts]
            sha, spans = [nothing] * len(texts), [""] * len(texts)
            cover = batch.column("text").to_pylist() if mask else []
            for i in live:
                base = base_spans(texts[i])
                for kind, _, _ in base:
                    counts[i][kind] += 1
                every = reconcile(texts[i], base, extra.get(i, []))
                sha[i] = hashlib.sha256(named(base).encode()).hexdigest()
                spans[i] = named(every)
                if mask:
                    cover[i] = masked(texts[i], every)
            columns = [batch.column("doc_id"), *[pa.array([c[k] for c in counts], pa.int64()) for k in range(len(KINDS))],
                       pa.array(sha), pa.array(spans)]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(cover, pa.string())] * mask + [batch.column(c) for c in carry],
                                             names + ["masked"] * mask + carry)
    more = "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in docs.select(*carry).schema.fields)
    return docs.mapInArrow(work, RESULT + ", masked string" * mask + more)
