"""Secret scans: fixed patterns, and a small character network over every candidate with its context."""

from __future__ import annotations

import hashlib
import random
import re
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

KINDS = ("assign", "access", "hex", "model")

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
#: Candidates besides the fixed patterns' matches: long runs of the characters that keys are made of, of any kind, and
#: what is assigned to a name that speaks of access, also if it is short.
_RUN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
_VALUE = re.compile(r"""(?:pass|pwd|secret|token|key|auth|bearer|credential|login)[A-Za-z_]{0,12}["']?\x20{0,4}[:=]\x20{0,4}["']?([^\s"',;<>]{6,})""", re.I | re.A)

#: Characters of context on each side, and of the candidate, that the network sees.
SIDE, BODY = 16, 48
#: Characters from one view of a longer candidate to the next; a key of BODY - STEP is whole in some view.
STEP = 12
WIDTH, FILTERS = 5, 16

_CLASSES = {c: i + 2 for i, c in enumerate(string.ascii_letters + string.digits + "+/_=-.:'\"@ \n#,;()<>{}[]")}
_VOCAB = len(_CLASSES) + 2


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, in order."""
    out = []
    if ":" in text or "=" in text:
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    if any(len(w) >= 16 for w in text.split()):
        out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Spans for the network, in order: what the fixed patterns match (of an assignment its value), all long runs of key
    characters, letters or digits alone as well, and the values of names that speak of access."""
    out = {(_ASSIGN.match(text, s).start(2) if kind == 0 else s, e) for s, kind, e in base}
    if any(len(w) >= 16 for w in text.split()):
        out.update(m.span() for m in _RUN.finditer(text))
    if ":" in text or "=" in text:
        out.update(m.span(1) for m in _VALUE.finditer(text))
    return sorted(out)


def encoded(text: str, start: int, end: int) -> np.ndarray:
    """Character classes of the context before, the candidate (BODY characters at most, see views), and the context after."""
    body = text[start:end]
    whole = text[max(0, start - SIDE) : start].rjust(SIDE, "\0") + body.ljust(BODY, "\0") + text[end : end + SIDE].ljust(SIDE, "\0")
    return np.fromiter((0 if c == "\0" else _CLASSES.get(c, 1) for c in whole), np.int64, 2 * SIDE + BODY)


def views(start: int, end: int) -> list[tuple[int, int]]:
    """Overlapping spans of BODY characters over a candidate, the last one at its end; itself if it is no longer."""
    return [(i, i + BODY) for i in (*range(start, end - BODY, STEP), end - BODY)] if end - start > BODY else [(start, end)]


class Network:
    """One convolution over characters, maximum and mean over places, and a logistic output."""

    def __init__(self, seed: int = 5):
        r = np.random.default_rng(seed)
        self.kernel = r.normal(0, 0.15, (WIDTH, _VOCAB, FILTERS))
        self.bias, self.out, self.shift = np.zeros(FILTERS), r.normal(0, 0.2, 2 * FILTERS), np.zeros(1)
        self.scale, self.offset, self.threshold = 1.0, 0.0, 0.5

    def layers(self, x: np.ndarray):
        n = x.shape[1] - WIDTH + 1
        conv = sum(self.kernel[o][x[:, o : o + n]] for o in range(WIDTH)) + self.bias
        act = np.maximum(conv, 0)
        top = act.argmax(axis=1)
        pooled = np.concatenate([np.take_along_axis(act, top[:, None, :], 1)[:, 0], act.mean(axis=1)], 1)
        return act, top, pooled, pooled @ self.out + self.shift[0]

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([self.layers(x[i : i + 512])[3] for i in range(0, len(x), 512)]) if len(x) else np.zeros(0)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * self.logits(x) + self.offset, -30, 30)))

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 8, rate: float = 0.01, seed: int = 6) -> Network:
        r, params = np.random.default_rng(seed), [self.kernel, self.bias, self.out, self.shift]
        m, v, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
        for _ in range(epochs):
            order = r.permutation(len(x))
            for i in range(0, len(x), 64):
                b = order[i : i + 64]
                act, top, pooled, z = self.layers(x[b])
                d = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[b]) / len(b)
                back = d[:, None] * self.out
                grad = (act > 0) * (back[:, None, FILTERS:] / act.shape[1])
                rows, cols = np.ogrid[: len(b), :FILTERS]
                grad[rows, top, cols] += back[:, :FILTERS] * (act[rows, top, cols] > 0)
                kernel = np.zeros_like(self.kernel)
                n = act.shape[1]
                flat = grad.reshape(-1, FILTERS)
                hot = np.eye(_VOCAB)[x[b]]
                for o in range(WIDTH):
                    kernel[o] = hot[:, o : o + n].reshape(-1, _VOCAB).T @ flat
                t += 1
                for p, g, m_, v_ in zip(params, (kernel, flat.sum(0), pooled.T @ d, np.array([d.sum()])), m, v):
                    m_ += 0.1 * (g - m_)
                    v_ += 0.001 * (g * g - v_)
                    p -= rate * (m_ / (1 - 0.9**t)) / (np.sqrt(v_ / (1 - 0.999**t)) + 1e-8)
        return self

    def calibrate(self, x: np.ndarray, y: np.ndarray, recall: float) -> Network:
        """Scale and offset by Newton steps on held-out findings; the highest threshold that keeps the recall."""
        z = self.logits(x)
        goal = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
        w = np.array([1.0, 0.0])
        a = np.stack([z, np.ones_like(z)], 1)
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
            w -= np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + 1e-3 * np.eye(2), a.T @ (p - goal) + 1e-3 * (w - [1.0, 0.0]))
        self.scale, self.offset = float(w[0]), float(w[1])
        hits = np.sort(self.score(x[y > 0]))
        self.threshold = float(hits[int((1 - recall) * len(hits))]) if len(hits) else 0.5
        return self


def made_findings(n: int, seed: int = 11) -> list[tuple[str, int, int, int]]:
    """(text, start, end, label): findings of known kind in made-up prose.

    Secrets are random keys in common formats and random passwords behind a name; the others are what such keys are
    mistaken for: long words, identifiers, paths, dates, version and account numbers, ids in parts, repeated characters,
    and plain words or numbers behind a name.
    """
    r = random.Random(seed)
    pick = lambda chars, k: "".join(r.choices(chars, k=k))
    onsets, codas = "b c ch cl d f g gr h k l m n p pf pr qu r s sch sh st str t th tr tz v w wh z".split(), "n ng nt r rst s ss st t th ch cht l ld m nd tz x".split()
    parts = [r.choice(onsets) + pick("aeiou", r.randint(1, 2)) + r.choice([*codas, *[""] * 12]) for _ in range(600)]
    word = lambda: "".join(r.choices(parts, k=r.randint(1, 4)))
    long_word = lambda: "".join(r.choices(parts, k=r.randint(6, 12)))
    digits, low = string.digits, string.ascii_lowercase
    full, url = string.ascii_letters + digits, string.ascii_letters + digits + "-_"
    group = lambda k: pick(digits, k)
    secret = [lambda: "ghp_" + pick(full, 36), lambda: "sk_live_" + pick(full, 24), lambda: "xoxb-" + group(11) + "-" + pick(full, 24), lambda: "eyJ" + pick(url, 60), lambda: pick(full + "+/", 40), lambda: pick(url, r.randint(24, 64)), lambda: pick(full, r.randint(20, 44)) + "==", lambda: pick(string.ascii_uppercase + digits, r.randint(20, 32)), lambda: "AIza" + pick(url, 35), lambda: pick(string.ascii_letters, r.randint(20, 48)), lambda: pick(low + digits, r.randint(20, 40)), lambda: pick("0123456789abcdef", r.choice((32, 40, 64)))]
    plain = [lambda: "_".join(word() for _ in range(r.randint(3, 5))) + group(2), lambda: "/".join([word(), word(), word(), group(4)]), lambda: "-".join(["20" + group(2), "0" + group(1), group(2), word(), word()]), lambda: "".join(word().title() for _ in range(4)) + group(1), lambda: word() + "x" * 16 + group(2), lambda: "=" * 14 + word() + group(3), lambda: group(r.randint(16, 20)), lambda: word() + "-" + word() + "-" + group(9), lambda: "v" + "-".join(group(3) for _ in range(4)), long_word, lambda: long_word().title(), lambda: long_word().upper(), lambda: "-".join(word() for _ in range(5)), lambda: "-".join(pick("0123456789abcdef", k) for k in (8, 4, 4, 4, 12)), lambda: r.choice("-=_") * r.randint(16, 60), lambda: "/".join(word() for _ in range(r.randint(3, 6))), lambda: word() + group(12)]
    names = ["password", "secret", "token", "api_key", "auth_key", "login", "pwd", "credential"]
    hidden = [lambda: pick(full + "!$%.", r.randint(8, 14)), lambda: word().title() + group(3) + pick("!$%", 1), lambda: pick(full, r.randint(10, 16))]
    shown = [lambda: long_word()[: r.randint(6, 12)], lambda: "required", lambda: "optional", lambda: group(6), lambda: word() + word(), lambda: "true;" + word()]
    out = []
    for i in range(n):
        label, named = i % 2, r.random() < 0.2
        before = " ".join(word() for _ in range(r.randint(0, 6)))
        before += f" {r.choice(names)}{r.choice((': ', '=', ' = ', '=' + chr(34)))}" if named else r.choice([" ", " ", " ", "\n", " (", " id ", ' = "', " key: ", " auth "])
        body = r.choice(((shown, plain)[r.random() < 0.3], (hidden, secret)[r.random() < 0.3])[label] if named else (plain, secret)[label])()
        out.append((before + body + r.choice([" ", " ", '"', ",", "\n", ")", ". "]) + " ".join(word() for _ in range(r.randint(0, 5))), len(before), len(before) + len(body), label))
    return out


#: Pieces of the corpus that hold findings: from a fixed pattern's start, or from a long word, with what follows.
_PIECES = r"""(?s)(?:(?:(?i:password|passwd|secret|token|api_?key))["']?\x20{0,4}[:=]|AKIA[A-Z0-9]{16}|(?<![A-Za-z0-9+/_=-])[0-9a-f]{24}|(?<![A-Za-z0-9+/_=-])[A-Za-z]{16,48}(?![A-Za-z0-9+/_=-])).{0,64}"""


def corpus_findings(df: DataFrame, most: int) -> list[tuple[str, int, int, int]]:
    """Labelled findings of df: matches of the fixed patterns are secrets, long words of one case outside them are none.

    At most `most` pieces of under 200 characters, those with the smallest hashes over all rows, come to the driver, so
    the sample does not depend on how rows are dealt.
    """
    pieces = df.select(F.explode(F.regexp_extract_all(common.text_of(), F.lit(_PIECES), F.lit(0))).alias("piece")).distinct()
    out = []
    for (text,) in pieces.orderBy(F.xxhash64("piece"), "piece").limit(most).collect():
        base = base_spans(text)
        for s, kind, e in base:
            out.append((text, _ASSIGN.match(text, s).start(2) if kind == 0 else s, e, 1))
        for m in _RUN.finditer(text):
            if re.fullmatch("[A-Z]?[a-z]+", m[0]) and not any(s < m.end() and m.start() < e for s, _, e in base):
                out.append((text, *m.span(), 0))
    return out


def trained(found: list[tuple[str, int, int, int]], *, made: int = 6000, recall: float = 0.98) -> Network:
    """A network fitted to made findings and those given; every fifth is held out for calibration and threshold."""
    found = made_findings(made) + found
    seen = [(t, *v, label, i) for i, (t, s, e, label) in enumerate(found) for v in views(s, e)]
    x, y = np.stack([encoded(t, s, e) for t, s, e, *_ in seen]), np.array([f[3] for f in seen], float)
    held = np.array([f[4] for f in seen]) % 5 == 4
    return Network().fit(x[~held], y[~held]).calibrate(x[held], y[held], recall)


def _scanner(df: DataFrame, sample_pieces: int, recall: float):
    """Broadcast network for df, and a function that gives, for each of a list of texts, all its spans, how many
    candidates the network has judged, and how many of the fixed patterns' matches it finds as well."""
    net = df.sparkSession.sparkContext.broadcast(trained(corpus_findings(df, sample_pieces), recall=recall))

    def spans(texts: list[str]) -> list[tuple[list[tuple[int, int, int]], int, int]]:
        base = [base_spans(t) for t in texts]
        more = [(i, s, e) for i, t in enumerate(texts) for s, e in candidates(t, base[i])]
        seen = [(n, i, *v) for n, (i, s, e) in enumerate(more) for v in views(s, e)]
        hit, judged = set(), [0] * len(texts)
        for at in range(0, len(seen), 4096):
            part = seen[at : at + 4096]
            score = net.value.score(np.stack([encoded(texts[i], s, e) for _, i, s, e in part]))
            hit.update(part[j][0] for j in np.flatnonzero(score >= net.value.threshold))
        found, agreed = [list(x) for x in base], [0] * len(texts)
        for n, (i, s, e) in enumerate(more):
            judged[i] += 1
            if n in hit:
                inside = [b for b in base[i] if b[0] <= s and e <= b[2]]
                agreed[i] += len(inside)
                if not inside:
                    found[i].append((s, 3, e))
        return [(sorted(x), a, b) for x, a, b in zip(found, judged, agreed)]

    return spans


def written_spans(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


SCHEMA = "n_assign long, n_access long, n_hex long, n_model long, n_judged long, n_agreed long, base_sha256 string, spans string"


def scan(df: DataFrame, *, sample_pieces: int = 2000, recall: float = 0.98) -> DataFrame:
    """Secret spans of every row of df (doc_id, text; others are ignored), in code points.

    The fixed patterns give assign, access and hex spans. A character network judges every candidate from itself and its
    context: those spans, every other run of 16 or more key characters, and every value of 6 or more characters behind a
    name that speaks of access; a candidate over 48 characters counts by the best of overlapping views of 48. What scores
    above a threshold and lies in no fixed span is a model span. n_judged: candidates; n_agreed: fixed spans that the
    network finds, too. The network is fitted on the driver to made findings and to those in at most sample_pieces short
    pieces of the corpus; its scores are calibrated on held-out findings, and the threshold keeps `recall` of the secrets
    among them. Null and empty texts have no spans. Very long texts are read whole. Equal starts come in the order of
    kinds. Repeated rows are each returned. An empty table gives an empty one.
    """
    spans, kind = _scanner(df, sample_pieces, recall), df.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.chunks_by_bytes(batches, 1, 4 << 20):
            rows = spans(b.column(1).to_pylist())
            found = [x for x, *_ in rows]
            counts = [[sum(k == i for _, k, _ in x) for x in found] for i in range(4)] + [[x[i] for x in rows] for i in (1, 2)]
            base = [hashlib.sha256(written_spans([y for y in x if y[1] < 3]).encode()).hexdigest() for x in found]
            arrays = [*(pa.array(c, pa.int64()) for c in counts), pa.array(base, pa.string()), pa.array(map(written_spans, found), pa.string())]
            yield pa.RecordBatch.from_arrays([b.column(0), *arrays], ["doc_id", *(x.split()[0] for x in SCHEMA.split(", "))])

    return common.map_arrow(df.select("doc_id", common.text_of().alias("text")), run, f"doc_id {kind}, {SCHEMA}")


def redact(df: DataFrame, *, mark: str = "[secret]", sample_pieces: int = 2000, recall: float = 0.98) -> DataFrame:
    """All rows of df with each secret span replaced by `mark`; n_chars, where there is such a column, follows the text.

    Other columns, whatever their names, stay as they are. Null texts stay null, empty ones empty; very long ones are read
    whole. Spans that overlap or touch are one mark each from where the one before ends. Repeated rows give repeated
    rows. An empty table gives an empty one. The spans are those of scan(), by the same network.
    """
    spans = _scanner(df, sample_pieces, recall)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(at).to_pylist()
            out = []
            for text, (found, *_) in zip(texts, spans([t or "" for t in texts])):
                if found:
                    parts, end = [], 0
                    for s, _, e in found:
                        if s >= end:
                            parts += [text[end:s], mark]
                        end = max(end, e)
                    text = "".join((*parts, text[end:]))
                out.append(text)
            yield b.set_column(at, b.schema.field(at), pa.array(out, b.schema.field(at).type))

    at = df.columns.index("text")
    done = common.map_arrow(df, run, df.schema)
    if "n_chars" in df.columns:
        done = done.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text")).cast(df.schema["n_chars"].dataType))
    return done


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(common.documents(spark, sf_dir))
