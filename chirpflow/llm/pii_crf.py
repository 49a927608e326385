"""Personal data by rules and a skip-chain conditional random field.

Rules find e-mail addresses, IP addresses, card and phone numbers.  Then every
white-space token with a digit or ``@`` is a node of a conditional random field
with the labels none, email, ip, card and phone.  Neighbouring tokens share a
chain potential, and tokens that are alike anywhere in the document share a skip
potential.  Alike are tokens that are equal but for case and separators; numbers
with the same first or last nine digits, in one token or in groups, so a country or
trunk prefix does not matter; and, in numbers written in groups, groups with the
same group beside them.  Each token is linked to the previous one for each of
these, so edges grow with the tokens.  Loopy sum-product message passing then carries what the rules
know about one mention to the others, and tokens whose label is sure enough
become further spans.  Rule spans always stay.  A token without any edge becomes
no span, in whatever document: its shape alone is no evidence against the rules.

The potentials are fitted piecewise, on counts over all documents: a
multinomial logistic regression of the rules' label on the token's shape, and
smoothed pointwise mutual information for the two edge kinds.  Where a rule
matched one of two alike tokens and not the other, the other's label is unknown,
not none; such pairs say nothing about the skip potential and are left out of it.

Edge cases: a NULL or empty text has no spans; very long texts are read whole
and in linear time; equal rows get equal results; an empty table gives an empty
result (and flat potentials); bytes that are not UTF-8 count as U+FFFD; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

KINDS = ("email", "ip", "card", "phone")
SURE, LIKELY = 0.8, 0.5  # a span needs one token of the first belief, and all of the second
EVIDENCE = 20.0          # log potential of a rule's own label
LEAST_DIGITS = (0, 4, 13, 7)  # in a span of each kind
ROUNDS, DAMPING = 12, 0.3
SHAPES = 18
BATCH_BYTES = 2 << 20    # of text; graphs and messages take several times as much
SMOOTH = (0.1, 0.001)    # added to the counts of chain and skip pairs

# The rules.  The possessive forms match what the plain ones do, in linear time.
LOCAL_CHARS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
HINT = re.compile(r"[0-9@]\S*+")
NOT_DIGIT = re.compile(r"[^0-9]+")
LETTER = re.compile(r"[^\W\d_]")
TRIM = ".,;:!?()[]{}<>\"'"
Span = tuple[int, int]

SCHEMA = ("doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, "
          "n_added long")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def email_spans(text: str) -> list[Span]:
    out, end, seen, at = [], 0, 0, text.find("@")
    while at >= 0:
        low = max(end, seen)
        start = low + len(text[low:at].rstrip(LOCAL_CHARS))
        if start < at and (m := DOMAIN.match(text, at + 1)):
            out.append((start, m.end()))
            end = m.end()
        seen = at + 1
        at = text.find("@", max(seen, end))
    return out


def small_part(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


def rule_spans(text: str) -> list[list[Span]]:
    """Spans per kind, in order of start."""
    cards, phones = [], []
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = NOT_DIGIT.sub("", m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                cards.append(m.span())
    if "+" in text:
        phones = [m.span() for m in PHONE.finditer(text) if 9 <= len(NOT_DIGIT.sub("", m[0])) <= 15]
    return [email_spans(text), [m.span() for m in IP.finditer(text) if all(map(small_part, m.groups()))],
            cards, phones]


def tokens(text: str) -> list[Span]:
    """White-space tokens with a digit or ``@``, trimmed of punctuation."""
    out, last = [], 0
    for m in HINT.finditer(text):
        head = text[last:m.start()]
        start = m.start()
        if head and not head[-1].isspace():
            start -= len(head.split()[-1])
        last = m.end()
        raw = text[start:last]
        left = len(raw) - len(raw.lstrip(TRIM))
        core = raw.strip(TRIM)
        if core:
            out.append((start + left, start + left + len(core)))
    return out


def shape(token: str) -> int:
    """Bits of a token's shape."""
    digits = sum(map(token.count, "0123456789"))
    dots, letters = token.count("."), LETTER.search(token) is not None
    flags = ("@" in token, "@" in token and "." in token.rpartition("@")[2], digits == 0, 1 <= digits <= 2,
             3 <= digits <= 4, 5 <= digits <= 6, 7 <= digits <= 9, 10 <= digits <= 12, 13 <= digits <= 19,
             digits > 19, token[0] == "+", dots == 3, dots in (1, 2), letters, digits == len(token),
             "-" in token, any(c in token for c in "/:=$#%"), "(" in token)
    return sum(1 << i for i, f in enumerate(flags) if f)


SAME_ENDS = 9     # digits in which numbers must agree at either end


def likenesses(own: list[str], joint: list[bool]) -> list[list[tuple]]:
    """For each token what makes it alike to others; ``joint`` tells whether it and
    the next are groups of a number.  Tokens too plain to be told apart have nothing."""
    digits = [NOT_DIGIT.sub("", t) for t in own]
    bare = [d.lstrip("0") for d in digits]
    out = []
    for i, token in enumerate(own):
        keys: list[tuple] = []
        key = "".join(c for c in token.lower() if c.isalnum() or c == "@")
        if len(key) >= 5 and (len(digits[i]) >= 4 or "@" in key):
            keys.append(("same", key))
        if len(digits[i]) == len(key):  # a number or a group of one
            back = ahead = digits[i]
            j = i
            while j and joint[j - 1] and len(back) < SAME_ENDS:
                j -= 1
                back = digits[j] + back
            j = i
            while j < len(joint) and joint[j] and len(ahead) < SAME_ENDS:
                j += 1
                ahead += digits[j]
            if len(back) >= SAME_ENDS:
                keys.append(("end", back[-SAME_ENDS:]))
            if len(ahead) >= SAME_ENDS:
                keys.append(("start", ahead[:SAME_ENDS]))
        for kind, j in (("with next", i), ("with last", i - 1)):
            if 0 <= j < len(joint) and joint[j] and bare[j] and bare[j + 1] and len(bare[j]) + len(bare[j + 1]) >= 5:
                keys.append((kind, bare[j], bare[j + 1]))
        out.append(keys)
    return out


def graph(text: str, rules: list[list[Span]]):
    """Nodes ``(span, shape, label)`` and edges ``(i, j, kind)``; kind 0 is a chain, 1 a skip."""
    spans = tokens(text)
    labels = np.zeros(len(spans), np.int64)
    for kind in range(len(KINDS), 0, -1):
        i = 0
        for a, b in rules[kind - 1]:
            while i < len(spans) and spans[i][1] <= a:
                i += 1
            k = i
            while k < len(spans) and spans[k][0] < b:
                labels[k] = kind
                k += 1
    own = [text[a:b] for a, b in spans]
    near = [a - z <= 3 and "\n" not in text[z:a] for (_, z), (a, _) in zip(spans, spans[1:])]
    number = [not LETTER.search(t) and "@" not in t for t in own]
    joint = [x and number[i] and number[i + 1] for i, x in enumerate(near)]
    edges, last = [(i, i + 1, 0) for i, x in enumerate(near) if x], {}
    for i, keys in enumerate(likenesses(own, joint)):
        linked = set()
        for key in keys:
            if key in last and last[key] not in linked:
                linked.add(last[key])
                edges.append((last[key], i, 1))
            last[key] = i
    return spans, [shape(t) for t in own], labels, edges


# ------------------------------------------------------------------ fitting

def count_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    """``(kind, a, b, n)``: kind 2 counts (shape, label), kinds 0 and 1 label pairs on edges."""
    C.kept_by("pii_crf", dict)  # drops what another operator left in this worker
    counts: dict[tuple[int, int, int], int] = {}
    for data in batch.column("text").to_pylist():
        text = (data or b"").decode(errors="replace")
        _, shapes, labels, edges = graph(text, rule_spans(text))
        for s, y in zip(shapes, labels.tolist()):
            counts[2, s, y] = counts.get((2, s, y), 0) + 1
        for i, j, kind in edges:
            key = (kind, int(labels[i]), int(labels[j]))
            counts[key] = counts.get(key, 0) + 1
    rows = [(*k, n) for k, n in counts.items()] or [(2, 0, 0, 0)]
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows)], names=["kind", "a", "b", "n"])


def fit_potentials(rows: list[tuple[int, int, int, int]], steps: int = 400) -> dict:
    """Unary weights and edge potentials from the counts."""
    k = len(KINDS) + 1
    edges = []
    for kind in (0, 1):
        n = np.full((k, k), SMOOTH[kind])
        for t, a, b, c in rows:
            if t == kind and (kind == 0 or (a > 0) == (b > 0)):
                n[a, b] += c
        p = n / n.sum()
        pmi = np.log(p / (p.sum(1, keepdims=True) * p.sum(0, keepdims=True)))
        edges.append(np.clip(pmi, -2.0, 2.0) if kind == 0 else pmi)
    shapes = sorted({a for t, a, _, c in rows if t == 2 and c})
    if not shapes:
        return {"unary": np.zeros((SHAPES + 1, k)), "edges": edges}
    x = np.array([[1.0, *((s >> i) & 1 for i in range(SHAPES))] for s in shapes])
    y, place = np.zeros((len(shapes), k)), {s: i for i, s in enumerate(shapes)}
    for t, a, b, c in rows:
        if t == 2 and c:
            y[place[a], b] += c
    total = y.sum()
    w = np.zeros((SHAPES + 1, k))
    for _ in range(steps):
        z = x @ w
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        w += 2.0 * (x.T @ (y - p * y.sum(1, keepdims=True)) / total - 1e-4 * w)
    return {"unary": w, "edges": edges}


def fit(docs: DataFrame) -> dict:
    """Potentials from the ``text`` of all documents.  Only counts of shapes and
    label pairs reach the driver (at most a few thousand numbers)."""
    counts = (docs.select("text")
              .mapInArrow(C.per_batch(count_batch, BATCH_BYTES), "kind long, a long, b long, n long")
              .groupBy("kind", "a", "b").agg(F.sum("n").alias("n")))
    return fit_potentials([tuple(r) for r in counts.collect()])


# ---------------------------------------------------------------- inference

def beliefs(unary: np.ndarray, edges: np.ndarray, potentials: list[np.ndarray]) -> np.ndarray:
    """Marginals by loopy sum-product in log space, all documents of a batch at once."""
    if len(edges):
        src = np.r_[edges[:, 0], edges[:, 1]]
        dst = np.r_[edges[:, 1], edges[:, 0]]
        back = np.r_[np.arange(len(edges)) + len(edges), np.arange(len(edges))]
        psi = np.stack([*potentials, *(p.T for p in potentials)])
        table = psi[np.r_[edges[:, 2], edges[:, 2] + len(potentials)]]
        msg = np.zeros((len(src), unary.shape[1]))
        for _ in range(ROUNDS):
            total = unary.copy()
            np.add.at(total, dst, msg)
            out = (total[src] - msg[back])[:, :, None] + table
            top = out.max(1)
            new = top + np.log(np.exp(out - top[:, None, :]).sum(1))
            new -= new.max(1, keepdims=True)
            msg = DAMPING * msg + (1 - DAMPING) * new
        unary = unary.copy()
        np.add.at(unary, dst, msg)
    p = np.exp(unary - unary.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def find_spans(texts: list[str], model: dict) -> list[tuple[list[list[Span]], list[list[Span]]]]:
    """Per text: the rules' spans, and the field's further spans, both per kind."""
    C.kept_by("pii_crf", dict)  # drops what another operator left in this worker
    found, graphs, n = [], [], 0
    for text in texts:
        if HINT.search(text) is None:
            found.append(([[] for _ in KINDS], [[] for _ in KINDS]))
            continue
        rules = rule_spans(text)
        found.append((rules, [[] for _ in KINDS]))
        spans, shapes, labels, edges = graph(text, rules)
        if edges:  # without an edge no token becomes a span, as below
            graphs.append((len(found) - 1, n, spans, shapes, labels, edges))
            n += len(spans)
    if not graphs:
        return found
    shapes = np.concatenate([np.asarray(g[3], np.int64) for g in graphs])
    labels = np.concatenate([g[4] for g in graphs])
    edges = np.concatenate([np.asarray(g[5], np.int64) + np.array([g[1], g[1], 0]) for g in graphs])
    x = np.c_[np.ones(n), (shapes[:, None] >> np.arange(SHAPES)) & 1]
    unary = x @ model["unary"]
    unary[np.arange(n), labels] += EVIDENCE * (labels > 0)
    belief = beliefs(unary, edges, model["edges"])
    best, top = belief.argmax(1), belief.max(1)
    degree = np.bincount(edges[:, :2].ravel(), minlength=n)
    likely = (labels == 0) & (best > 0) & (top >= LIKELY) & (degree > 0)
    for doc, first, spans, _, _, _ in graphs:
        runs: list[list[int]] = []  # a mention of several tokens is one span
        for i in np.flatnonzero(likely[first:first + len(spans)]).tolist():
            last = runs[-1][-1] if runs else None
            if (last == i - 1 and best[first + last] == best[first + i]
                    and not texts[doc][spans[last][1]:spans[i][0]].strip(" ()")):
                runs[-1].append(i)
            else:
                runs.append([i])
        for run in runs:
            kind, a, b = best[first + run[0]] - 1, spans[run[0]][0], spans[run[-1]][1]
            long_enough = len(NOT_DIGIT.sub("", texts[doc][a:b])) >= LEAST_DIGITS[kind]
            if long_enough and max(top[first + i] for i in run) >= SURE:
                found[doc][1][kind].append((a, b))
    return found


def joined(spans: list[list[Span]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, own in zip(KINDS, spans) for a, b in own)


def personal_data(docs: DataFrame, model: dict | None = None) -> DataFrame:
    """One row per document: rule counts, the digest of the rules' spans, all
    spans as ``kind:start:end`` in code points, and how many the field added.
    Fitted on ``docs`` unless a model is given; the second pass is a narrow map."""
    rows = C.texts(docs)
    model = model or fit(rows)

    def run(batch):
        found = find_spans([(t or b"").decode(errors="replace") for t in batch.column("text").to_pylist()], model)
        counts = [[len(r[k]) for r, _ in found] for k in range(len(KINDS))]
        digests = [hashlib.sha256(joined(r).encode()).hexdigest() for r, _ in found]
        every = [joined([sorted(x + y) for x, y in zip(r, more)]) for r, more in found]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests), pa.array(every),
             pa.array([sum(map(len, more)) for _, more in found], pa.int64())],
            names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"])
    return rows.mapInArrow(C.per_batch(run, BATCH_BYTES), SCHEMA)


def mask(text: str, rules: list[list[Span]], more: list[list[Span]]) -> str:
    """The text with each span replaced by its kind, as ``<EMAIL>``.  Overlapping
    spans become one, of the kind that starts first."""
    spans = sorted((a, -b, k) for k in range(len(KINDS)) for a, b in rules[k] + more[k])
    out, at = [], 0
    for a, b, k in spans:
        if a >= at:
            out += [text[at:a], f"<{KINDS[k].upper()}>"]
        at = max(at, -b)
    return "".join([*out, text[at:]])


def masked(docs: DataFrame, text_col: str = "text", model: dict | None = None) -> DataFrame:
    """``docs`` with its columns, spans in ``text_col`` masked.  NULL stays NULL."""
    model = model or fit(docs.select(F.col(text_col).cast("binary").alias("text")))

    def run(batch):
        data = batch.column(text_col).to_pylist()
        found = find_spans([t or "" for t in data], model)
        new = [None if t is None else mask(t, *f) if any(f[0]) or any(f[1]) else t for t, f in zip(data, found)]
        at = batch.schema.get_field_index(text_col)
        return batch.set_column(at, batch.schema.field(at), pa.array(new, batch.schema.field(at).type))
    return docs.mapInArrow(C.per_batch(run, BATCH_BYTES), docs.schema)
