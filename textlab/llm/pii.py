"""Personal data: fixed patterns, and a skip-chain conditional random field that extends them.

Nodes are the white-space tokens with a digit or an at sign; all other tokens
are outside any entity.  Potentials: each node's form and neighbouring words,
chain edges between nodes that stand next to each other, and skip edges between
repeated or similar nodes of a document however far apart (each to the one
before it with the same normal form, so a token repeated a thousand times has a
thousand edges).  Loopy sum-product message passing gives each node's label
probabilities, which carries a label to nodes of a similar form.  Nodes under a
pattern's span are held to its kind: those spans always stay.  Nodes that repeat a
whole span of a card, phone number or e-mail address in another way of writing
(numbers by their digits, also across spaces) are held to it as well, so that an
entity found once is found wherever it is repeated, however far away.
Weights are fitted by pseudo-likelihood on a bounded sample of documents whose
labels are the patterns' spans.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")

#: Documents that the fit uses at most: those with the smallest hashes among documents with a digit or an at sign.
FIT_DOCS = 4_000
#: Nodes that one fitted document gives at most to the fit; all nodes are labelled when documents are read.
FIT_NODES = 200
#: Hashed node features.
WIDTH = 1 << 13
#: Message passing ends when no message changes by more than this, or after rounds that grow with the longest skip path.
TOLERANCE, ROUNDS = 1e-7, 50
#: The probability from which a token is added.
SURE = 0.9

# The patterns. A match of the first three cannot begin within a run of
# the characters it begins with, so look-behinds keep long runs linear.
_AT = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_REGION = re.compile(r"[0-9+][\x20().0-9+-]*")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_MARK = re.compile(r"[0-9@]")
_SPACES = frozenset(" \t\n\x0b\x0c\r")
_NEXT_GAP = re.compile(r"[ \t-\r]")
#: A token that is a number or a part of one, with signs around it.
_NUMBER = re.compile(r"[^\w\s]*+[0-9][0-9().+/-]*+[^\w\s]*+")
_CORE = re.compile(r"[^\W_](?:.*[^\W_])?", re.S)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def only_digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the patterns' matches, by kind and start; code points, end exclusive."""
    out, done = [], 0
    for m in _AT.finditer(text) if "@" in text else ():
        start = m.start()
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            done = m.end()
            out.append((0, start, done))
    ips, cards, phones = [], [], []
    for region in _REGION.finditer(text):
        a, b = region.span()
        if b - a < 7:
            continue
        for m in _IP.finditer(text, a, b):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
                ips.append((1, *m.span()))
        for m in _CARD.finditer(text, a, b):
            d = only_digits(m[0]) if m.end() - m.start() < 64 else ""
            if 16 <= len(d) <= 19 and luhn(d):
                cards.append((2, *m.span()))
        if "+" in region[0]:
            for m in _PHONE.finditer(text, a, b):
                if 8 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                    phones.append((3, *m.span()))
    return out + ips + cards + phones


def nodes(text: str) -> list[tuple[int, int]]:
    """White-space tokens with a digit or an at sign."""
    out, end = [], 0
    for m in _MARK.finditer(text):
        at = m.start()
        if at < end:
            continue
        start = at
        while start > end and text[start - 1] not in _SPACES:
            start -= 1
        gap = _NEXT_GAP.search(text, at)
        end = gap.start() if gap else len(text)
        out.append((start, end))
    return out


def core(token: str) -> tuple[int, int]:
    m = _CORE.search(token)
    return m.span() if m else (0, len(token))


def normal(token: str) -> str | None:
    """The form under which tokens count as repeated or similar; none for those too short to mean anything."""
    digits = only_digits(token)
    if "@" not in token and len(digits) >= 7:
        return digits
    a, b = core(token)
    return token[a:b].lower() if b - a >= 6 else None


def form(token: str) -> str:
    """Character kinds of a token's first 48 characters, runs of a kind longer than four cut short."""
    kinds = re.sub(r"[0-9]", "9", re.sub(r"[^\W\d_]", "a", token[:48]))
    return re.sub(r"(.)\1{4,}", r"\1\1\1\1\1", kinds)


def features(text: str, spans: list[tuple[int, int]]) -> list[list[int]]:
    """Hashed features of each node: its form, its kind of length and signs, and the words beside it."""
    out = []
    for start, end in spans:
        token = text[start:end]
        a, b = core(token)
        inner = token[a:b]
        digits = len(only_digits(inner))
        before = text[max(0, start - 24) : start].split(" ")
        after = text[end : end + 24].split(" ")
        marks = (
            "form " + form(inner),
            f"sizes {min(digits, 20)} {min(len(inner) - digits, 9)}",
            f"signs {'@' in inner} {min(inner.count('.'), 4)} {inner.count('-') > 0} {token[:1] == '+'} {min(digits, 4)}",
            "before " + form(before[-2] if len(before) > 1 else ""),
            "after " + form(after[1] if len(after) > 1 else ""),
            "bias",
        )
        out.append([zlib.crc32(m.encode("utf-8", "replace")) % WIDTH for m in marks])
    return out


def graph(text: str, spans: list[tuple[int, int]]) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Chain edges and skip edges between a document's nodes."""
    chain, skip, last = [], [], {}
    for i, (start, end) in enumerate(spans):
        if i and start - spans[i - 1][1] <= 2:
            chain.append((i - 1, i))
        key = normal(text[start:end])
        if key is not None:
            if key in last:
                skip.append((last[key], i))
            last[key] = i
    return chain, skip


def held(spans: list[tuple[int, int]], base: list[tuple[int, int, int]]) -> list[int]:
    """1 + kind of the base span that a node overlaps (the first listed), 0 without one."""
    labels = [0] * len(spans)
    starts = [s for s, _ in spans]
    for kind, a, b in reversed(base):
        i = max(0, int(np.searchsorted(starts, a, "right")) - 1)
        while i < len(spans) and spans[i][0] < b:
            if spans[i][1] > a:
                labels[i] = 1 + kind
            i += 1
    return labels


def repeated(text: str, spans: list[tuple[int, int]], base: list[tuple[int, int, int]]) -> list[int]:
    """`held`, and for a node outside the base spans 1 + kind of the base span that it repeats, alone or with the numbers beside it."""
    labels = held(spans, base)
    entities: dict[str, int] = {}
    for kind, a, b in base:
        whole = text[a:b]
        key = whole.lower() if KINDS[kind] == "email" else only_digits(whole) if KINDS[kind] in ("card", "phone") else None
        if key is not None:
            entities.setdefault(key, 1 + kind)
    if not entities or all(labels):
        return labels
    longest = max(map(len, entities))
    tokens = [text[a:b] for a, b in spans]
    numbers = [only_digits(t) if _NUMBER.fullmatch(t) else "" for t in tokens]
    i = 0
    while i < len(spans):
        step = 1
        if not labels[i]:
            a, b = core(tokens[i])
            found, run, j = entities.get(tokens[i][a:b].lower(), 0), "", i
            while j < len(spans) and not labels[j] and numbers[j] and (j == i or spans[j][0] - spans[j - 1][1] <= 1):
                run += numbers[j]
                if len(run) > longest:
                    break
                if run in entities:  # the longest run counts
                    found, step = entities[run], j - i + 1
                j += 1
            labels[i : i + step] = [found] * step
        i += step
    return labels


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(x: np.ndarray, y: np.ndarray, around: np.ndarray, rounds: int = 300, rate: float = 0.5, decay: float = 1e-4) -> np.ndarray:
    """Pseudo-likelihood weights: (WIDTH + 15, 5).

    The last 15 rows are the potentials with a left, a right and a skip
    neighbour's label; `around` counts those neighbours' labels per node.
    """
    n, k = len(y), 5
    w = np.zeros((WIDTH + 15, k))
    if n == 0:
        w[zlib.crc32(b"bias") % WIDTH, 0] = 5.0
        return w
    used, inverse = np.unique(x, return_inverse=True)
    inverse = inverse.reshape(x.shape)
    v, u = np.zeros((len(used), k)), np.zeros((15, k))
    gv, gu = np.full(v.shape, 1e-8), np.full(u.shape, 1e-8)
    target = np.eye(k)[y]
    for _ in range(rounds):
        p = softmax(v[inverse].sum(axis=1) + around @ u)
        d = (p - target) / n
        step_v = decay / n * v
        for j in range(x.shape[1]):
            np.add.at(step_v, inverse[:, j], d)
        step_u = around.T @ d + decay / n * u
        gv += step_v**2
        gu += step_u**2
        v -= rate * step_v / np.sqrt(gv)
        u -= rate * step_u / np.sqrt(gu)
    w[used], w[WIDTH:] = v, u
    return w


def marginals(w: np.ndarray, x: np.ndarray, hold: np.ndarray, chain: np.ndarray, skip: np.ndarray, rounds: int | None = None) -> np.ndarray:
    """Label probabilities of all nodes by loopy sum-product, in log space with damping.

    Without `rounds` as many are done at most as the longest path of skip edges asks for.
    """
    unary = w[x].sum(axis=1)
    fixed = np.flatnonzero(hold)
    unary[fixed] = -1e3
    unary[fixed, hold[fixed]] = 0.0
    if len(chain) + len(skip) == 0:
        return softmax(unary)
    left, right, far = w[WIDTH : WIDTH + 5], w[WIDTH + 5 : WIDTH + 10], w[WIDTH + 10 :]
    near = (left + right.T) / 2  # [left node's label, right node's label]
    same = (far + far.T) / 2
    a = np.concatenate([chain[:, 0], skip[:, 0], chain[:, 1], skip[:, 1]])
    b = np.concatenate([chain[:, 1], skip[:, 1], chain[:, 0], skip[:, 0]])
    m, half = len(a), len(a) // 2
    pot = np.empty((m, 5, 5))
    pot[: len(chain)], pot[len(chain) : half] = near, same
    pot[half : half + len(chain)], pot[half + len(chain) :] = near.T, same
    back = (np.arange(m) + half) % m
    msg = np.zeros((m, 5))
    if rounds is None:
        depth: dict[int, int] = {}
        for i, j in skip.tolist():
            depth[j] = max(depth.get(j, 0), depth.get(i, 0) + 1)
        rounds = ROUNDS + 4 * max(depth.values(), default=0)
    for _ in range(rounds):
        belief = unary.copy()
        np.add.at(belief, b, msg)
        out = (belief[a] - msg[back])[:, :, None] + pot
        top = out.max(axis=1)
        new = top + np.log(np.exp(out - top[:, None, :]).sum(axis=1))
        new -= new.max(axis=1, keepdims=True)
        moved = np.abs(new - msg).max()
        msg = 0.5 * msg + 0.5 * new
        if moved < TOLERANCE:
            break
    belief = unary.copy()
    np.add.at(belief, b, msg)
    return softmax(belief)


def added(text: str, base: list[tuple[int, int, int]], spans: list[tuple[int, int]], p: np.ndarray, sure: float) -> list[tuple[int, int, int]]:
    """Spans of sure tokens that no base span touches; touching tokens of a kind make one span."""
    out: list[tuple[int, int, int]] = []
    free = np.array(held(spans, base)) == 0
    for i in np.flatnonzero(free & (1 - p[:, 0] >= sure)):
        kind = int(p[i, 1:].argmax())
        if p[i, 1 + kind] < sure:
            continue
        start, end = spans[i]
        a, b = core(text[start:end])
        if out and out[-1][0] == kind and start - spans[i - 1][1] <= 1 and out[-1][2] > spans[i - 1][0]:
            out[-1] = (kind, out[-1][1], start + b)
        else:
            out.append((kind, start + a, start + b))
    return out


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def train(docs: DataFrame, fit_docs: int = FIT_DOCS) -> np.ndarray:
    """Weights from at most `fit_docs` documents of `docs` (text)."""
    place = F.xxhash64("text")
    marked = docs.filter(F.col("text").rlike("[0-9@]")).select(place.alias("place"))
    edge = marked.orderBy("place").limit(fit_docs).agg(F.max("place")).first()[0]
    if edge is None:
        return fit(np.zeros((0, 6), int), np.zeros(0, int), np.zeros((0, 15)))

    def examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for value in batch.column(0):
                text = value.as_py()
                spans = nodes(text)[:FIT_NODES]
                y, chain, skip = repeated(text, spans, base_spans(text)), *graph(text, spans)
                around = np.zeros((len(spans), 15), np.float32)
                for i, j in chain:
                    around[j, y[i]] += 1
                    around[i, 5 + y[j]] += 1
                for i, j in skip:
                    around[i, 10 + y[j]] += 1
                    around[j, 10 + y[i]] += 1
                x = np.array(features(text, spans), np.int32).reshape(-1, 6)
                rows.append((x.tobytes(), np.array(y, np.int32).tobytes(), around.tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), *(pa.array([r[i] for r in rows], pa.binary()) for i in range(3))], ["place", "x", "y", "around"]
            )

    chosen = docs.filter(F.col("text").rlike("[0-9@]")).select("text", place.alias("place")).filter(F.col("place") <= edge)
    chosen = chosen.dropDuplicates(["place"])  # repeated texts teach nothing new, and the bound holds
    found = chosen.mapInArrow(examples, "place long, x binary, y binary, around binary")

    def solve(table):
        table = table.sort_by("place")
        join = lambda c, t: np.frombuffer(b"".join(v.as_py() for v in table[c]), t)
        w = fit(join("x", np.int32).reshape(-1, 6), join("y", np.int32), join("around", np.float32).reshape(-1, 15).astype(np.float64))
        return pa.table({"w": [w.astype(np.float32).tobytes()]})

    got = found.groupBy(F.lit(0).alias("all")).applyInArrow(solve, "w binary").first()
    return np.frombuffer(got["w"], np.float32).reshape(-1, 5).astype(np.float64)


def find_pii(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: tuple[str, ...] = (),
    fit_docs: int = FIT_DOCS,
    sure: float = SURE,
) -> DataFrame:
    """(doc_id, base, spans, redacted, *keep): one row per input row.

    `base` and `spans` are arrays of (kind, start, end) in code points, end
    exclusive, by kind and start; `spans` holds `base` and what the field adds.
    `redacted` is the text with every span's characters replaced by its kind in
    angle brackets; where spans overlap, the one that starts first is taken,
    then the longer, and what is left of the other is dropped.  A null text is
    empty (no spans); null or repeated ids and repeated rows are kept as they
    are; an empty table gives no rows.  `keep` names columns that are handed on.
    No shuffle but of the bounded fit sample.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        F.struct(F.lit(0).alias("_"), *(F.col(c).alias(f"c{i}") for i, c in enumerate(keep))).alias("rest"),
    )
    shared = docs.sparkSession.sparkContext.broadcast(train(rows.select("text"), fit_docs))  # WIDTH + 15 rows of 5

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        dicts = lambda found: [{"kind": KINDS[k], "start": a, "end": b} for k, a, b in found]
        for batch in batches:
            texts = [v.as_py() for v in batch.column(1)]
            bases, tokens = [base_spans(t) for t in texts], [nodes(t) for t in texts]
            # one graph for the batch: documents are not linked with each other
            x, hold, chain, skip, first = [], [], [], [], [0]
            for t, base, spans in zip(texts, bases, tokens, strict=True):
                x += features(t, spans)
                hold += repeated(t, spans, base)
                for edges, found in zip((chain, skip), graph(t, spans), strict=True):
                    edges += [(first[-1] + i, first[-1] + j) for i, j in found]
                first.append(first[-1] + len(spans))
            if x:
                p = marginals(w, np.array(x), np.array(hold), np.array(chain, int).reshape(-1, 2), np.array(skip, int).reshape(-1, 2))
            alls = [
                sorted(base + (added(t, base, spans, p[a:b], sure) if b > a else []))
                for t, base, spans, a, b in zip(texts, bases, tokens, first[:-1], first[1:], strict=True)
            ]
            red = [redact(t, found) for t, found in zip(texts, alls, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(map(dicts, bases), span), pa.array(map(dicts, alls), span), pa.array(red, pa.string()), batch.column(2)],
                ["doc_id", "base", "spans", "redacted", "rest"],
            )

    kept, spans = rows.schema["rest"].dataType.simpleString(), "array<struct<kind:string,start:int,end:int>>"
    out = rows.mapInArrow(label, f"doc_id long, base {spans}, spans {spans}, redacted string, rest {kept}")
    return out.select("doc_id", "base", "spans", "redacted", *(F.col(f"rest.c{i}").alias(c) for i, c in enumerate(keep)))


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"<{KINDS[kind]}>"]
            at = b
        elif b > at:
            at = b
    return "".join(out) + text[at:] if out else text
