"""Operator 9: personal data by a character BiLSTM with CRF transitions.

Base spans come from four patterns with checks (e-mail, IPv4, card, phone). They also
label the training windows of the tagger: a bidirectional LSTM over characters gives a
score per tag (outside, or begin / inside of a kind), a linear-chain CRF scores tag
sequences; both are trained in numpy by gradient descent on the CRF's likelihood, over
windows cut by other widths and offsets and with characters altered, so that it learns
shapes rather than the patterns' exact limits.

Long texts are cut into overlapping windows on a fixed grid. Each window is decoded by
Viterbi; a character takes the tag of the window in whose middle it lies, and spans are
read off the joined tags of the whole text. A span found so is widened to whole tokens
and added if it touches no base span and passes the check of its kind (address parts,
octets, Luhn, number of digits) whatever the separators, which the patterns fix. Every check
asks for a digit or an @: decoding begins with the windows that own one, or a character of
the token around it, and goes on to the next window while tags reach the edge of what was
decoded. The result is that of all windows.

The tagger is fitted on a bounded sample: at most ``train_windows`` windows of each kind
and as many without personal data, those of the lowest hash among all windows of the table.

Defined results: a null or empty text has no spans; repeated rows are scanned alike; an
empty table gives an empty result; without any base span in the table nothing is added;
texts of any length are scanned whole, in linear time. Spans that begin together are in the
order of their kinds; windows of one hash are ranked by their content. Other columns,
whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import slices, text_bytes

KINDS = ("email", "ip", "card", "phone")
TRIGGER = re.compile(rb"[0-9@]")
MARKS = re.compile(r"[0-9]+|@")
TOKEN = re.compile(r"[^\W_]*")  # alphanumeric characters, as of str.isalnum

# ---- base patterns --------------------------------------------------------------------
# Digit runs are matched whole and left to right; a match that fails inside a run fails
# from every digit of it, so runs are entered at their first digit only.
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        a = at
        while a > end and text[a - 1] in LOCAL_CHARS:
            a -= 1
        m = DOMAIN.match(text, at + 1) if a < at else None
        if m:
            yield a, m.end()
            end = m.end()
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind number) by start, then kind."""
    out = [(a, b, 0) for a, b in emails(text)]
    for m in IP.finditer(text):
        if all(len(g.lstrip("0")) <= 3 and int(g.lstrip("0") or 0) <= 255 for g in m.groups()):
            out.append((*m.span(), 1))
    for m in CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((*m.span(), 2))
    for m in PHONE.finditer(text):
        if 10 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
            out.append((*m.span(), 3))
    return sorted(out, key=lambda s: (s[0], s[2]))


def plausible(text: str, kind: int) -> bool:
    """The check of a kind for a span in any notation."""
    digits = re.sub("[^0-9]", "", text)
    if kind == 0:
        name, _, host = text.partition("@")
        return bool(name) and re.search(r"[A-Za-z0-9]\W{0,3}\.\W{0,3}[A-Za-z]", host) is not None
    if kind == 1:
        parts = re.findall("[0-9]+", text)
        return len(parts) == 4 and all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts)
    if kind == 2:
        return 14 <= len(digits) <= 19 and luhn(digits)
    return 10 <= len(digits) <= 15 and re.search(r"[^\W\d_]", text) is None


# ---- tagger ---------------------------------------------------------------------------
WINDOW, STRIDE = 96, 48
TAGS = 1 + 2 * len(KINDS)  # 0 outside, 1 + 2k begin, 2 + 2k inside
SYMBOLS, PAD = 130, 129  # ASCII, any other character, padding


def symbols(text: str) -> np.ndarray:
    return np.minimum(np.frombuffer(text.encode("utf-32-le"), np.uint32), 128).astype(np.uint8)


def tags_of(length: int, spans: list[tuple[int, int, int]]) -> np.ndarray:
    out = np.zeros(length, np.uint8)
    for a, b, k in reversed(spans):
        out[a:b] = 2 + 2 * k
        out[a] = 1 + 2 * k
    return out


class Tagger:
    """Character BiLSTM with CRF transitions."""

    def __init__(self, hidden: int = 12, seed: int = 1):
        rng = np.random.default_rng(seed)
        h = self.hidden = hidden
        self.p = {"trans": np.zeros((TAGS, TAGS), np.float32), "first": np.zeros(TAGS, np.float32),
                  "out": rng.normal(0, 0.3, (2 * h, TAGS)).astype(np.float32), "bias": np.zeros(TAGS, np.float32)}
        for d in "fb":
            self.p["in_" + d] = rng.normal(0, 0.3, (SYMBOLS, 4 * h)).astype(np.float32)  # gates: input, forget, output, cell
            self.p["in_" + d][:, h:2 * h] += 1
            self.p["rec_" + d] = rng.normal(0, 0.3 / np.sqrt(h), (h, 4 * h)).astype(np.float32)

    def _run(self, x: np.ndarray, d: str, keep: bool):
        """Hidden states (time x batch x hidden) of one direction."""
        n, t_max, h = len(x), x.shape[1], self.hidden
        rec, gates_in = self.p["rec_" + d], self.p["in_" + d]
        state, cell = np.zeros((n, h), np.float32), np.zeros((n, h), np.float32)
        out = np.empty((t_max, n, h), np.float32)
        trace = []
        for t in range(t_max) if d == "f" else range(t_max - 1, -1, -1):
            z = gates_in[x[:, t]] + state @ rec
            g = 0.5 + 0.5 * np.tanh(0.5 * z[:, :3 * h])
            c = np.tanh(z[:, 3 * h:])
            new = g[:, h:2 * h] * cell + g[:, :h] * c
            squashed = np.tanh(new)
            if keep:
                trace.append((t, state, cell, g, c, squashed))
            state, cell = g[:, 2 * h:] * squashed, new
            out[t] = state
        return out, trace

    def emissions(self, x: np.ndarray, keep: bool = False):
        f, tf = self._run(x, "f", keep)
        b, tb = self._run(x, "b", keep)
        hid = np.concatenate([f, b], axis=2)
        return hid @ self.p["out"] + self.p["bias"], hid, tf, tb

    def _back(self, x, d, trace, dout, grad):
        h, rec = self.hidden, self.p["rec_" + d]
        dstate = np.zeros_like(trace[0][1])
        dcell = np.zeros_like(dstate)
        for t, state, cell, g, c, squashed in reversed(trace):
            ds = dout[t] + dstate
            i, f, o = g[:, :h], g[:, h:2 * h], g[:, 2 * h:]
            dnew = dcell + ds * o * (1 - squashed**2)
            dz = np.concatenate([dnew * c * i * (1 - i), dnew * cell * f * (1 - f), ds * squashed * o * (1 - o), dnew * i * (1 - c**2)], axis=1)
            np.add.at(grad["in_" + d], x[:, t], dz)
            grad["rec_" + d] += state.T @ dz
            dstate, dcell = dz @ rec.T, dnew * f

    def loss_and_grad(self, x: np.ndarray, y: np.ndarray):
        """Mean negative log-likelihood per window of the tag sequences, and its gradient."""
        e, hid, tf, tb = self.emissions(x, True)
        t_max, n, _ = e.shape
        trans = self.p["trans"]
        a = np.empty_like(e)
        a[0] = e[0] + self.p["first"]
        for t in range(1, t_max):
            a[t] = e[t] + _lse(a[t - 1][:, :, None] + trans, 1)
        z = _lse(a[-1], 1)
        b = np.zeros_like(e)
        grad = {k: np.zeros_like(v) for k, v in self.p.items()}
        rows = np.arange(n)
        for t in range(t_max - 2, -1, -1):
            pair = a[t][:, :, None] + trans + (e[t + 1] + b[t + 1])[:, None, :]
            grad["trans"] += np.exp(pair - z[:, None, None]).sum(0)
            b[t] = _lse(trans + (e[t + 1] + b[t + 1])[:, None, :], 2)
        de = np.exp(a + b - z[:, None])
        gold = self.p["first"][y[:, 0]].sum()
        grad["first"] += de[0].sum(0)
        for t in range(t_max):
            gold += e[t][rows, y[:, t]].sum()
            de[t][rows, y[:, t]] -= 1
            if t:
                gold += trans[y[:, t - 1], y[:, t]].sum()
                np.add.at(grad["trans"], (y[:, t - 1], y[:, t]), -1)
        np.add.at(grad["first"], y[:, 0], -1)
        grad["out"] = np.einsum("tnh,tnk->hk", hid, de)
        grad["bias"] = de.sum((0, 1))
        dh = de @ self.p["out"].T
        self._back(x, "f", tf, dh[:, :, :self.hidden], grad)
        self._back(x, "b", tb, dh[:, :, self.hidden:], grad)
        return float(z.sum() - gold) / n, {k: v / n for k, v in grad.items()}

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 10, batch: int = 128, rate: float = 0.03, seed: int = 2) -> list[float]:
        rng = np.random.default_rng(seed)
        m, v = ({k: np.zeros_like(p) for k, p in self.p.items()} for _ in range(2))
        step, losses = 0, []
        total = epochs * -(-len(x) // batch)
        for _ in range(epochs):
            order, loss = rng.permutation(len(x)), 0.0
            for i in range(0, len(x), batch):
                part = order[i:i + batch]
                value, grad = self.loss_and_grad(x[part], y[part])
                loss += value * len(part)
                step += 1
                norm = np.sqrt(sum(float((g**2).sum()) for g in grad.values()))
                lr = rate * (1 - step / (total + 1)) * min(1.0, 5 / (norm + 1e-9))
                for k, g in grad.items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.99 * v[k] + 0.01 * g**2
                    self.p[k] -= (lr * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
            losses.append(loss / len(x))
        return losses

    def decode(self, x: np.ndarray) -> np.ndarray:
        """Best tag sequences (batch x time) by Viterbi."""
        e, trans = self.emissions(x)[0], self.p["trans"]
        t_max, n, _ = e.shape
        best, back = e[0] + self.p["first"], np.empty((t_max, n, TAGS), np.uint8)
        for t in range(1, t_max):
            s = best[:, :, None] + trans
            back[t] = s.argmax(1)
            best = e[t] + s.max(1)
        out = np.empty((n, t_max), np.uint8)
        out[:, -1] = best.argmax(1)
        rows = np.arange(n)
        for t in range(t_max - 1, 0, -1):
            out[:, t - 1] = back[t][rows, out[:, t]]
        return out


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis, keepdims=True)
    return np.log(np.exp(x - m).sum(axis)) + m.squeeze(axis)


def window_starts(length: int) -> range:
    """Grid of overlapping windows that covers a text: each half stride beyond the last."""
    return range(0, max(1, length - (WINDOW - STRIDE)), STRIDE)


def marked_windows(text: str) -> set[int]:
    """Starts of the windows that own a digit or @, a character of the token around it or one next to that token."""
    last, margin = window_starts(len(text))[-1], (WINDOW - STRIDE) // 2
    out: set[int] = set()
    end = 0
    for m in MARKS.finditer(text):
        a, b = m.span()
        if b <= end:
            continue
        if text[a] != "@":
            while a > end and text[a - 1].isalnum():
                a -= 1
            b = TOKEN.match(text, b).end()
        end = b
        low, high = (min(max(p - margin, 0) // STRIDE * STRIDE, last) for p in (a - 1, b))
        out.update(range(low, high + 1, STRIDE))
    return out


def added_spans(tagger: Tagger, texts: list[str], base: list[list], batch: int = 1024) -> list[list[tuple[int, int, int]]]:
    """Spans that the tagger adds to the base spans of each text."""
    codes = [symbols(t) for t in texts]
    tags = [np.zeros(len(c), np.uint8) for c in codes]
    margin = (WINDOW - STRIDE) // 2
    known = [marked_windows(t) for t in texts]
    jobs = [(i, s) for i, starts in enumerate(known) for s in sorted(starts)]
    while jobs:
        further = []
        for k in range(0, len(jobs), batch):
            part = jobs[k:k + batch]
            x = np.full((len(part), WINDOW), PAD, np.uint8)
            for r, (i, s) in enumerate(part):
                piece = codes[i][s:s + WINDOW]
                x[r, :len(piece)] = piece
            for (i, s), y in zip(part, tagger.decode(x)):
                # the middle belongs to this window; so does the margin at either end of the text
                a = 0 if s == 0 else margin
                b = WINDOW if s + WINDOW >= len(codes[i]) else margin + STRIDE
                own = y[a:b][:len(codes[i]) - s - a]
                tags[i][s + a:s + b] = own
                for edge, near in ((own[0], s - STRIDE), (own[-1], s + STRIDE)):
                    if edge and near not in known[i] and 0 <= near <= window_starts(len(codes[i]))[-1]:
                        known[i].add(near)
                        further.append((i, near))
        jobs = further
    out = []
    for text, t, known in zip(texts, tags, base):
        taken = np.zeros(len(text) + 1, bool)
        for a, b, _ in known:
            taken[a:b] = True
        new = []
        kind = (t.astype(np.int16) - 1) // 2  # -1 outside
        cut = np.flatnonzero(np.concatenate([[True], (kind[1:] != kind[:-1]) | ((t[1:] % 2 == 1) & (t[1:] > 0)), [True]])) if len(t) else []
        for a, b in zip(cut[:-1], cut[1:]):
            if kind[a] < 0:
                continue
            a, b, k = int(a), int(b), int(kind[a])
            while a and text[a - 1].isalnum():
                a -= 1
            while b < len(text) and text[b].isalnum():
                b += 1
            if not taken[a:b].any() and plausible(text[a:b], k):
                new.append((a, b, k))
                taken[a:b] = True
        out.append(new)
    return out


def stray_marks(text: str, spans: list[tuple[int, int, int]]) -> list[int]:
    """Where runs of digits or @ begin that belong to no base span."""
    inside = np.zeros(len(text) + 1, bool)
    for a, b, _ in spans:
        inside[a:b] = True
    return [m.start() for m in re.finditer(r"[0-9@]+", text) if not inside[m.start()]]


def labelled_windows(text: str) -> list[tuple[str, bytes, bytes]]:
    """Windows around the base spans and stray digits of a text, at offsets fixed by a hash."""
    spans = base_spans(text)
    codes, tags = symbols(text), tags_of(len(text), spans)
    out = []
    for kind, a in [(KINDS[k], a) for a, _, k in spans] + [("none", a) for a in stray_marks(text, spans)]:
        shift = int.from_bytes(hashlib.md5(text[max(0, a - 20):a + 20].encode()).digest()[:2], "big") % (WINDOW - 40)
        s = max(0, min(a - shift, len(text) - WINDOW))
        out.append((kind, codes[s:s + WINDOW].tobytes(), tags[s:s + WINDOW].tobytes()))
    return out


def training_set(docs: DataFrame, train_windows: int) -> tuple[np.ndarray, np.ndarray]:
    """Characters and tags of labelled windows: of each kind the ``train_windows`` of least hash in the table. docs: one column, t.

    All marked documents are cut, so a rare kind is learnt however large the table; a task keeps
    no more windows of a kind than the table does.
    """

    def cut(batches: Iterator) -> Iterator:
        import pyarrow as pa
        kept: dict[str, dict] = {}
        for b in slices(batches):
            for raw in text_bytes(b, "t"):
                for kind, x, y in labelled_windows(raw.decode()):
                    kept.setdefault(kind, {})[hashlib.blake2b(x, digest_size=8, salt=b"9").digest(), x, y] = None
            for kind, own in kept.items():
                kept[kind] = dict.fromkeys(sorted(own)[:train_windows])
        rows = [(kind, *w) for kind, own in kept.items() for w in own]
        kinds, h, x, y = zip(*rows) if rows else ([], [], [], [])
        yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), *(pa.array(c, pa.binary()) for c in (h, x, y))], ["kind", "h", "x", "y"])

    marked = docs.where(F.col("t").rlike("[0-9@]"))
    found = marked.mapInArrow(cut, "kind string, h binary, x binary, y binary").distinct()
    rank = F.row_number().over(Window.partitionBy("kind").orderBy("h", "x", "y"))
    rows = found.withColumn("n", rank).where(F.col("n") <= train_windows).orderBy("kind", "n").collect()
    x = np.full((len(rows), WINDOW), PAD, np.uint8)
    y = np.zeros((len(rows), WINDOW), np.uint8)
    for i, r in enumerate(rows):
        x[i, :len(r.x)] = np.frombuffer(r.x, np.uint8)
        y[i, :len(r.y)] = np.frombuffer(r.y, np.uint8)
    return x, y


def train(x: np.ndarray, y: np.ndarray, seed: int = 4, steps: int = 240) -> Tagger | None:
    """A tagger for labelled windows, half of them with digits redrawn, after about ``steps`` batches; None
    without any span."""
    if not y.any():
        return None
    rng = np.random.default_rng(seed)
    digit = (x >= 48) & (x <= 57)
    redrawn = np.where(digit, rng.integers(48, 58, x.shape), x).astype(np.uint8)
    tagger = Tagger()
    tagger.fit(np.concatenate([x, redrawn]), np.concatenate([y, y]), epochs=-(-steps // -(-2 * len(x) // 128)))
    return tagger


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_windows: int = 250) -> DataFrame:
    """Per document: doc_id, base and added spans as arrays of (start, end, kind)."""
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("t"))
    tagger = train(*training_set(d.select("t"), train_windows))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))
        for b in slices(batches, 256):
            texts = [raw.decode() if raw is not None and TRIGGER.search(raw) else "" for raw in text_bytes(b, "t")]
            base = [base_spans(t) for t in texts]
            more = added_spans(tagger, texts, base) if tagger else [[]] * len(texts)
            cols = [pa.array([[{"start": a, "end": e, "kind": KINDS[k]} for a, e, k in spans] for spans in part], kind) for part in (base, more)]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], ["doc_id", "base", "added"])

    span = "array<struct<start:long,end:long,kind:string>>"
    return d.mapInArrow(run, f"doc_id long, base {span}, added {span}")


def joined(spans):
    """kind:start:end of a span column, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def pii_digest(docs: DataFrame, **options) -> DataFrame:
    """Per document: doc_id, counts of base spans by kind, base_sha256, spans (base and added)."""
    found = find_pii(docs, **options)
    order = F.create_map(*[F.lit(x) for k, name in enumerate(KINDS) for x in (name, k)])
    every = F.transform(F.concat("base", "added"), lambda s: F.struct(
        s["start"].alias("start"), order[s["kind"]].alias("k"), s["end"].alias("end"), s["kind"].alias("kind")))

    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
                        joined(F.array_sort(every)).alias("spans"), F.size("added").cast("long").alias("n_added"))


def redact(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with each span replaced by its kind in angle brackets; overlapping spans fall to the first."""
    out, end = [], 0
    for a, b, kind in sorted(spans):
        if a >= end:
            out += [text[end:a], f"<{kind}>"]
            end = b
    return "".join([*out, text[end:]])
